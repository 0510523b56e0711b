"""Running sums and ranks within groups of any size.

A window keeps a group's rows in one task. That is the right plan for groups that fit, and
wrong for one that holds a third of a large table. So the largest group is counted first: up
to HOT rows the sum is a window; beyond, rows are range-partitioned by group and order, summed
within each slice of a group, and the sums of the slices before are added. Both ways give the
same result wherever the order is total.

Defined results: null groups are groups; null sizes count as 0; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.session import cut

#: Rows of a group that one task may sort.
HOT = 1_000_000


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def largest(df: DataFrame, groups: list[str]) -> int:
    """Rows of the largest group."""
    if not groups:
        return df.count()
    return df.groupBy(*groups).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()[0] or 0


def running(df: DataFrame, groups: list[str], order: list[Column | str], size: str | None, name: str, hot: int | None = None) -> DataFrame:
    """df with `name`: the sum of size (or the number of rows) up to and with each row of its group."""
    amount = F.lit(1).cast("long") if size is None else F.coalesce(F.col(size), F.lit(0))
    of = [F.col(g) for g in groups]
    upto = lambda *by: F.sum(amount).over(Window.partitionBy(*by).orderBy(*map(_column, order)).rowsBetween(Window.unboundedPreceding, 0))
    if largest(df, groups) <= (HOT if hot is None else hot):
        return df.withColumn(name, upto(*(of or [F.lit(0)])))
    slices = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = cut(df.repartitionByRange(slices, *of, *map(_column, order)).withColumn("_slice", F.spark_partition_id()))
    sums = ranged.groupBy(*of, "_slice").agg(F.sum(amount).alias("_sum"))
    # One row a group and slice: a group spans many slices only if it is large.
    before = F.sum("_sum").over(Window.partitionBy(*(of or [F.lit(0)])).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.withColumn("_before", F.coalesce(before, F.lit(0))).drop("_sum")
    inner = ranged.withColumn(name, upto(*of, F.col("_slice"))).alias("r")
    same = F.col("r._slice") == F.col("s._slice")
    for g in groups:
        same = same & F.col(f"r.{g}").eqNullSafe(F.col(f"s.{g}"))
    out = inner.join(sums.alias("s"), same, "left")
    kept = [F.col(f"r.`{c}`") for c in df.columns if c != name]
    return out.select(*kept, (F.col(f"r.{name}") + F.col("_before")).alias(name))


def with_total(df: DataFrame, groups: list[str], name: str, value: Column | None = None) -> DataFrame:
    """df with `name`: the number of rows (or of non-null values) of its group, by a join with the group's sum."""
    of = [F.col(g) for g in groups]
    n = df.groupBy(*of).agg(F.count(F.lit(1) if value is None else value).alias(name))
    if not groups:
        return df.crossJoin(F.broadcast(n))  # one row
    keys = [f"_k{i}" for i in range(len(groups))]
    same = None
    for k, g in zip(keys, groups, strict=True):
        n = n.withColumnRenamed(g, k)
        one = F.col(g).eqNullSafe(F.col(k))
        same = one if same is None else same & one
    return df.join(n, same).drop(*keys)


def average_rank(df: DataFrame, groups: list[str], value: str, name: str) -> DataFrame:
    """df with `name`: the average rank of ties over the number of values of the group, in (0, 1];
    null without a value. Ranks come from running counts over distinct values."""
    of = [F.col(g) for g in groups]
    per = df.where(F.col(value).isNotNull()).groupBy(*of, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    n = per.groupBy(*of).agg(F.sum("_c").alias("_n"))
    per = running(per, groups, ["_v"], "_c", "_cum")
    join = lambda a, b, more=None: a.join(b.select(*(F.col(g).alias(f"_k{i}") for i, g in enumerate(groups)), *(c for c in b.columns if c not in groups)), _same(groups, more), "left").drop(*(f"_k{i}" for i in range(len(groups))))
    both = join(df, per, F.col(value) == F.col("_v"))
    both = join(both, n) if groups else both.crossJoin(F.broadcast(n))
    rank = (F.col("_cum") - F.col("_c") + 1 + (F.col("_c") - 1) / 2).cast("double") / F.col("_n")
    return both.withColumn(name, F.when(F.col(value).isNotNull(), rank)).drop("_v", "_c", "_cum", "_n")


def _same(groups: list[str], more: Column | None) -> Column:
    out = more
    for i, g in enumerate(groups):
        one = F.col(g).eqNullSafe(F.col(f"_k{i}"))
        out = one if out is None else out & one
    return out if out is not None else F.lit(True)
