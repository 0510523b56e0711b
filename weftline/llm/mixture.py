"""Mixing sources to target weights by weighted fair queueing.

Each source's documents stand in a shuffled order, again for every repeat. A document's
virtual finish time is the sum of its source's tokens up to and with it, divided by the
source's weight. All drawings are ranged by finish time and cut where their tokens reach
the budget, so at any cut the sources stand at their weights to within one document.

Prefix sums are taken in two steps - sums of slices of the shuffled order or of the finish
times, then rows within a slice. The slices grow in number with the rows, so a source with a
third of all rows is spread over many tasks and none holds more than about ROWS of them.

Defined results: documents without a source, or of a source without a target, belong to
none and are left out; a document of no tokens takes no share and is not drawn; a source
of the targets without documents reaches 0; repeated rows of one id are separate
documents; without a budget the largest is taken that all sources with documents can
fill within their caps; beyond it a source that runs out stays short, the others keep
to their weights, and the actual shares show it; an empty table gives no drawings.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftline.session import cut

#: Rows of a slice of a prefix sum.
ROWS = 50_000


def _running(df: DataFrame, groups: list[str], slice_: str, order: list[str], size: str) -> DataFrame:
    """df with `upto`, the sum of size up to each row by (slice, order) within groups."""
    sums = df.groupBy(*groups, slice_).agg(F.sum(size).alias("_sum"))
    over = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    earlier = F.coalesce(F.sum("_sum").over(over.orderBy(slice_).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    base = sums.select(*groups, slice_, earlier.alias("_base"))
    inner = Window.partitionBy(*groups, slice_).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("_in", F.sum(size).over(inner)).join(base, [*groups, slice_]).withColumn("upto", F.col("_base") + F.col("_in")).drop("_base", "_in")


def draw(docs: DataFrame, targets: DataFrame, key: str, source: str, size: str, budget: int | None = None, seed: int = 7) -> DataFrame:
    """Rows (key, source, size, repeats): how often each drawn document is taken.

    targets: a short list (source, target_share, max_repeats), one row a source. Sizes are
    read three times; cut() keeps them from being computed again.
    """
    stock = cut(docs.select(key, source, size).where(F.col(source).isNotNull() & (F.col(size) > 0)).join(F.broadcast(targets.select(source, "target_share", "max_repeats").where("target_share > 0 and max_repeats > 0")), source))
    slices = max(1, math.ceil(stock.count() / ROWS))
    totals = stock.groupBy(source).agg(F.sum(size).alias("_total"), F.first("target_share").alias("_share"), F.first("max_repeats").alias("_cap"))
    if budget is None:
        least = F.min(F.col("_total") * F.col("_cap") / F.col("_share"))
        totals = totals.crossJoin(F.broadcast(totals.agg(least.alias("_budget"))))  # one row
    else:
        totals = totals.withColumn("_budget", F.lit(float(budget)))
    rounds = F.least(F.col("_cap"), F.ceil(F.col("_share") * F.col("_budget") / F.col("_total")))
    totals = totals.select(source, "_total", "_budget", F.greatest(rounds, F.lit(1)).cast("int").alias("_rounds"))
    once = stock.join(F.broadcast(totals), source)
    turns = once.withColumn("_round", F.explode(F.sequence(F.lit(0), F.col("_rounds") - 1)))
    mixed = F.xxhash64(F.lit(seed), F.col("_round"), F.col(key))
    turns = turns.withColumns({"_mix": mixed, "_slice": F.col("_round") * slices + F.floor((F.shiftright(mixed, 34) + (1 << 29)) * slices / (1 << 30))})
    queued = _running(turns, [source], "_slice", ["_mix", key], size)
    queued = queued.select(key, source, size, "_budget", (F.col("upto") / F.col("target_share")).alias("_finish"))
    queued = queued.withColumn("_slice", F.floor(F.col("_finish") / F.col("_budget") * slices)).where(F.col("_finish") <= F.col("_budget") * (1 + 1e-12))
    ranged = _running(queued, [], "_slice", ["_finish", source, key], size).where(F.col("upto") <= F.col("_budget"))
    return ranged.groupBy(key, source, size).agg(F.count(F.lit(1)).cast("int").alias("repeats"))


def shares(drawn: DataFrame, targets: DataFrame, source: str, size: str) -> DataFrame:
    """Rows (source, target_share, actual_share, drawn, tokens) of every target source."""
    sums = drawn.groupBy(source).agg(F.sum("repeats").alias("drawn"), F.sum(F.col(size) * F.col("repeats")).alias("tokens"))
    all_ = targets.select(source, "target_share").join(sums, source, "left").fillna(0, ["drawn", "tokens"])
    total = F.sum("tokens").over(Window.partitionBy(F.lit(0)))
    return all_.select(source, "target_share", F.try_divide(F.col("tokens"), total).alias("actual_share"), "drawn", "tokens")
