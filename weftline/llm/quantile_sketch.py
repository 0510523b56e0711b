"""Percentiles of large numeric columns from signed logarithmic buckets.

A value v falls in bucket ceil(ln|v| / ln g) of its sign, g = (1 + a) / (1 - a) for the
relative error a; the middle 2 g^k / (g + 1) of a bucket is within a of each value in
it. Counts of equal buckets add, so sketches of partitions, days or files merge exactly
and an answer doesn't depend on how the rows were split.

Defined results: null and NaN are left out; 0 has a bucket of its own and is returned
exactly; infinities get the two outermost buckets and are returned as such; a group
without a number has no row; a null group is a group; an empty table gives no rows;
percentile p is the value at rank floor(p * (n - 1)) of the sorted values.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Values beyond every finite bucket.
INFINITE = 1 << 30


def gamma(error: float) -> float:
    return (1 + error) / (1 - error)


def bucket(value: Column, error: float) -> Column:
    """Position of value's bucket: 0 for zero, else sign * (k + OFFSET)."""
    size = F.abs(value)
    k = F.ceil(F.log(size) / F.lit(math.log(gamma(error)))) + F.lit(offset(error))
    k = F.when(size == float("inf"), F.lit(INFINITE)).otherwise(k)
    return F.when(value == 0, F.lit(0)).otherwise(F.signum(value) * k).cast("long")


def offset(error: float) -> int:
    """Makes k positive for the smallest double, so that sign and order agree."""
    return math.ceil(750 / math.log(gamma(error)))


def centre(at: Column, error: float) -> Column:
    """The value that stands for a bucket."""
    g = gamma(error)
    size = F.pow(F.lit(g), F.abs(at) - F.lit(offset(error))) * F.lit(2 / (g + 1))
    size = F.when(F.abs(at) == INFINITE, F.lit(float("inf"))).otherwise(size)
    return F.when(at == 0, F.lit(0.0)).otherwise(F.signum(at) * size)


def sketch(df: DataFrame, groups: list[str], value: str, error: float = 0.01) -> DataFrame:
    """Rows (*groups, bucket, n). The count is combined before the shuffle, so a group
    that holds a third of all rows sends one row a bucket and task."""
    v = F.col(value).cast("double")
    return (
        df.where(v.isNotNull() & ~F.isnan(v))
        .select(*groups, bucket(v, error).alias("bucket"))
        .groupBy(*groups, "bucket")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def merge(sketches: DataFrame, groups: list[str]) -> DataFrame:
    """Add the counts of equal buckets of many sketches (union them first)."""
    return sketches.groupBy(*groups, "bucket").agg(F.sum("n").alias("n"))


def percentiles(sketches: DataFrame, groups: list[str], wanted: list[float], error: float = 0.01) -> DataFrame:
    """Rows (*groups, percentile, value, n). The window runs over buckets, of which a
    group has a few thousand at most, not over values."""
    by = Window.partitionBy(*groups)
    upto = F.sum("n").over(by.orderBy("bucket"))
    ranked = sketches.withColumns({"upto": upto, "total": F.sum("n").over(by)})
    at = F.explode(F.array(*(F.lit(p) for p in wanted))).alias("percentile")
    rank = F.floor(F.col("percentile") * (F.col("total") - 1))
    return (
        ranked.select(*groups, "bucket", "n", "upto", "total", at)
        .where((rank >= F.col("upto") - F.col("n")) & (rank < F.col("upto")))
        .select(*groups, "percentile", centre(F.col("bucket"), error).alias("value"), F.col("total").alias("n"))
    )
