"""Streams of events: windows with watermarks, latest state, custom state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def windowed(events: DataFrame, time: str, keys: list[str], value: str, width: str = "1 day", late: str = "1 day") -> DataFrame:
    """Count and mean by key and window; events later than the watermark are left out."""
    g = events.withWatermark(time, late).groupBy(F.window(time, width), *keys).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(value), 6).alias("mean"))
    return g.select(F.col("window.start").alias("start"), *keys, "n", "mean")


def once_only(events: DataFrame, time: str, key: str, late: str = "1 day") -> DataFrame:
    """Events without those of a key seen before within the watermark."""
    return events.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def run_totals(events: DataFrame, key: str, value: str) -> DataFrame:
    """(key, n, total, top) of each key so far, kept in state between batches."""

    def update(k, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n, total, top = state.get if state.exists else (0, 0.0, float("-inf"))
        for p in parts:
            v = p[value].dropna()
            n, total, top = n + len(p), total + float(v.sum()), max(top, float(v.max())) if len(v) else top
        state.update((n, total, top))
        yield pd.DataFrame({key: [k[0]], "n": [n], "total": [total], "top": [top]})

    return events.groupBy(key).applyInPandasWithState(update, f"{key} string, n long, total double, top double", "n long, total double, top double", "update", GroupStateTimeout.NoTimeout)


def run_once(stream: DataFrame, name: str, mode: str, checkpoint: str) -> DataFrame:
    """The result of everything that is there now, as a table in memory; for small results."""
    q = stream.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return stream.sparkSession.table(name)


def run_to_files(stream: DataFrame, folder: str, checkpoint: str) -> DataFrame:
    """The rows that everything that is there now appends, as Parquet files in `folder`; for results of any
    size. A batch that is run again replaces its files. State is kept in RocksDB, so it may exceed memory."""
    spark, kind = stream.sparkSession, "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(kind)
    spark.conf.set(kind, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        q = stream.writeStream.format("parquet").option("path", folder).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    finally:
        spark.conf.set(kind, before)
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(folder)
