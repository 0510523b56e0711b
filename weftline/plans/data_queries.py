"""Queries of the general data problems."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.operators import units
from weftline.sources.tables import table


def _common(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "export_llm_data")
    return units.to_common_units(e, "export_id", "own_size", "own_unit_label", "own_product", "main_category", "own_price_thb", "own_unit_price_thb")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Rows that weren't plainly in ml, g or pcs, in common units."""
    x = _common(spark, d).where("not uncertain and base_size > 0")
    plain = F.col("_label").isin("ml", "g", "pcs") & F.col("_size").isNotNull() & F.col("price_base").isin(0, 1)
    return x.where(~F.coalesce(plain, F.lit(False))).select("export_id", "base_unit", "base_size", "price_base").distinct()


def p6_ways(spark: SparkSession, d: str) -> DataFrame:
    """How many rows each way of telling the unit decides, and how many of them are uncertain."""
    x = _common(spark, d).select("export_id", "way", "uncertain", "base_unit").distinct()
    return x.groupBy("way", "base_unit").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("uncertain").cast("int")).alias("n_uncertain"))


def p6_masked(spark: SparkSession, d: str) -> DataFrame:
    """The mixture graded on rows whose unit is known but kept from it."""
    e = table(spark, d, "export_llm_data")
    return units.masked_units(e, "export_id", "own_size", "own_unit_label", "own_product", "main_category", "own_price_thb")


QUERIES = {"p6_found": p6_found, "p6_ways": p6_ways, "p6_masked": p6_masked}
SQL: dict[str, str] = {}
