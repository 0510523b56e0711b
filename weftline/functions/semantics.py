"""Rules that look like a built-in but are not quite one, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F


def log_growth(new: Column, old: Column) -> Column:
    """ln((new + 1) / (old + 1))."""
    return F.log((new + 1) / (old + 1))


def pct_change(new: Column, old: Column) -> Column:
    """Growth in percent by log_growth, one decimal."""
    return F.round((F.exp(log_growth(new, old)) - 1) * 100, 1)


def pct_rank_avg(value: str, *groups: str) -> Column:
    """Average rank of ties over the number of rows, in (0, 1]; null values stay null and uncounted."""
    by = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    rank = F.rank().over(by.orderBy(F.col(value).asc_nulls_last()))
    ties = F.count(F.lit(1)).over(by.partitionBy(*groups, value) if groups else Window.partitionBy(value))
    return F.when(F.col(value).isNotNull(), (rank + (ties - 1) / 2).cast("double") / F.count(value).over(by))


def grade(score: Column) -> Column:
    """4, 3, 2, 1 from the floors 0.8, 0.5 and 0.2; null stays null."""
    return F.when(score >= 0.8, 4).when(score >= 0.5, 3).when(score >= 0.2, 2).when(score.isNotNull(), 1)


def top_percent_cut(n: Column, percent: float) -> Column:
    """Rows of the best percent: truncated, at least 1."""
    return F.greatest(F.lit(1), (n * percent / 100).cast("int"))


def pool_size(n: Column, share: float = 0.01) -> Column:
    """Half-even share of n, at least 1."""
    return F.greatest(F.lit(1), F.rint(n * share).cast("int"))


def tier_of(value: Column, cuts: Column) -> Column:
    """Tier from 1; a value equal to a cut is in the lower tier."""
    return F.size(F.filter(cuts, lambda c: value > c)) + 1


def canonical_tier(tier: Column, k: Column, n: int) -> Column:
    """Tier 1..k spread over 1..n: half-even; a single tier is the middle one."""
    return F.when(k <= 1, F.lit((n + 1) // 2)).otherwise(F.rint((tier - 1) * (n - 1) / F.greatest(k - 1, F.lit(1))).cast("int") + 1)


def cagr_pct(cumulative_pct: Column, years: int) -> Column:
    """Yearly growth in percent that makes the cumulative percent."""
    return (F.pow(1 + cumulative_pct / 100, F.lit(1 / years)) - 1) * 100


def status(delta: Column) -> Column:
    return F.when(delta > 0.8, "Major Breakout").when(delta > 0.2, "Rising").when(delta < -0.2, "Fading").otherwise("Stable")


def rows(order: str, low: int, high: int, *groups: str) -> WindowSpec:
    return Window.partitionBy(*groups).orderBy(order).rowsBetween(low, high)


def full(value: Column, over: WindowSpec, n: int, agg=F.avg) -> Column:
    """agg over a frame that must hold n rows, else null."""
    return F.when(F.count(value).over(over) == n, agg(value).over(over))
