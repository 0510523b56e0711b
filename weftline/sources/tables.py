"""Reading the Parquet tables of a data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weftline.session import prepare


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The table `name` of `folder`; one Parquet file or a folder of them."""
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def distinct_rows(df: DataFrame, key: str, *cols: str) -> DataFrame:
    """Key and columns once per delivered row.

    A copy has the id and the values of the row it copies, so distinct values of the
    selected columns are distinct rows; only the selected columns are shuffled. Rows of
    a null key are kept as they are told apart by their other columns.
    """
    return df.select(key, *cols).distinct()
