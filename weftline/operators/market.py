"""Market facts: wide tables made long, sizes, movers, channels, launches, and the questions they raise."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions.semantics import cagr_pct


def wide_years(columns: list[str]) -> dict[int, str]:
    """year -> column of the columns named like 2016 or 2016 (%)."""
    return {int(m[1]): c for c in columns if (m := re.fullmatch(r"\s*((?:19|20)\d\d)(?:\s*\(.*\))?\s*", c))}


def tidy(df: DataFrame, ids: list[str], value: str = "value") -> DataFrame:
    """Wide year columns as rows (ids, year, value); nulls stay as rows."""
    years = wide_years(df.columns)
    x = df.select(*ids, *(F.col(f"`{c}`").cast("double").alias(str(y)) for y, c in years.items()))
    return x.unpivot(ids, [str(y) for y in years], "year", value).withColumn("year", F.col("year").cast("int"))


def size_facts(market: DataFrame, category: str, base: int, last: int, ahead: int) -> DataFrame:
    """Values at three years, growth a year before and after, and share of the whole at `last`; market (category, year, value)."""
    at = lambda y: F.max(F.when(F.col("year") == y, F.col("value")))
    g = market.groupBy(category).agg(at(base).alias("base"), at(last).alias("last"), at(ahead).alias("ahead"))
    grow = lambda a, b, n: F.round(cagr_pct((F.col(b) / F.nullif(F.col(a), F.lit(0.0)) - 1) * 100, n), 4)
    total = F.sum("last").over(Window.partitionBy(F.lit(0)))
    return g.select(category, "base", "last", "ahead", grow("base", "last", last - base).alias("cagr"), grow("last", "ahead", ahead - last).alias("cagr_ahead"), F.round(F.col("last") / total * 100, 4).alias("share"))


def brand_shares(df: DataFrame, keys: list[str], owner: str, value: str) -> DataFrame:
    """One row a brand and year: its first owner by name and the sum, null where every part is null."""
    return df.groupBy(*keys).agg(F.min(owner).alias("owner"), F.sum(value).alias("share"))


def brand_facts(shares: DataFrame, category: str, brand: str, base: int, last: int, top: int = 5) -> DataFrame:
    """(category, kind, brand, base, last, change): top, new, dropped, gaining and losing brands."""
    at = lambda y: F.max(F.when(F.col("year") == y, F.col("share")))
    g = shares.groupBy(category, brand).agg(at(base).alias("base"), at(last).alias("last"))
    g = g.withColumn("change", F.round(F.coalesce("last", F.lit(0.0)) - F.coalesce("base", F.lit(0.0)), 6))
    by = lambda o: Window.partitionBy(category).orderBy(o, brand)
    g = g.withColumns({"_t": F.row_number().over(by(F.col("last").desc_nulls_last())), "_u": F.row_number().over(by(F.col("change").desc())), "_d": F.row_number().over(by(F.col("change").asc()))})
    kinds = F.array_compact(
        F.array(
            F.when((F.col("_t") <= top) & F.col("last").isNotNull(), "top"),
            F.when(F.col("base").isNull() & F.col("last").isNotNull(), "new"),
            F.when(F.col("base").isNotNull() & F.col("last").isNull(), "dropped"),
            F.when((F.col("_u") <= top) & (F.col("change") > 0), "gaining"),
            F.when((F.col("_d") <= top) & (F.col("change") < 0), "losing"),
        )
    )
    return g.select(category, F.explode(kinds).alias("kind"), brand, "base", "last", "change")


def concentration(shares: DataFrame, category: str, brand: str, top: int = 5) -> DataFrame:
    """Sum of the largest shares and number of named brands per category and year."""
    r = F.row_number().over(Window.partitionBy(category, "year").orderBy(F.col("share").desc_nulls_last(), brand))
    return shares.withColumn("_r", r).groupBy(category, "year").agg(F.round(F.sum(F.when(F.col("_r") <= top, F.col("share"))), 6).alias("top_share"), F.count("share").alias("n_brands"))


def succession(shares: DataFrame, category: str, brand: str, owner: str, words: str, least: float = 0.5) -> DataFrame:
    """(category, brand, into): a brand that ends and one of its owner that shares a word of
    its name and gains at least half of the loss in the next year; the largest gain wins."""
    last = shares.where("share is not null").groupBy(category, owner, brand).agg(F.max("year").alias("_y"), F.max_by("share", "year").alias("_loss"), F.first(words).alias("_w"))
    end = last.crossJoin(F.broadcast(shares.agg(F.max("year").alias("_end")))).where("_y < _end")  # one row
    by = Window.partitionBy(category, owner, brand).orderBy("year")
    gain = shares.withColumn("_g", F.col("share") - F.coalesce(F.lag("share").over(by), F.lit(0.0))).select(category, owner, F.col(brand).alias("into"), F.col("year").alias("_next"), "_g", F.col(words).alias("_v"))
    pair = end.join(gain, [category, owner]).where((F.col("into") != F.col(brand)) & (F.col("_next") == F.col("_y") + 1) & F.arrays_overlap("_w", "_v") & (F.col("_g") >= least * F.col("_loss")))
    return pair.groupBy(category, brand).agg(F.min_by("into", F.struct(-F.col("_g"), F.col("into"))).alias("into"))


def channel_facts(channels: DataFrame, category: str, channel: str, base: int, last: int) -> DataFrame:
    """Change of each channel's share, largest first."""
    at = lambda y: F.max(F.when(F.col("year") == y, F.col("value")))
    g = channels.groupBy(category, channel).agg(at(base).alias("base"), at(last).alias("last")).withColumn("change", F.round(F.col("last") - F.col("base"), 4))
    return g.withColumn("place", F.row_number().over(Window.partitionBy(category).orderBy(F.abs("change").desc_nulls_last(), channel)))


def complete_through(events: DataFrame, date: str, least: float = 0.5) -> DataFrame:
    """The last month with at least half of the median monthly count."""
    m = events.where(F.col(date).isNotNull()).groupBy(F.trunc(date, "MM").alias("month")).agg(F.count(F.lit(1)).alias("n"))
    line = m.agg((F.median("n") * least).alias("_l"))
    return m.crossJoin(F.broadcast(line)).where("n >= _l").agg(F.max("month").alias("through"))  # one row


def launches_by_year(df: DataFrame, date: str, imported: Column, tracked: Column) -> DataFrame:
    return df.groupBy(F.year(date).alias("year")).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(imported.cast("int")), 6).alias("import_share"), F.round(1 - F.avg(tracked.cast("int")), 6).alias("untracked_share"))


def new_brands(df: DataFrame, brand: str, date: str) -> DataFrame:
    """Brands by the year they are first seen."""
    return df.where(F.col(brand).isNotNull()).groupBy(brand).agg(F.min(F.year(date)).alias("year")).groupBy("year").agg(F.count(F.lit(1)).alias("n_new"))


def trajectory(df: DataFrame, key: str, year: str, years: list[int]) -> DataFrame:
    """Count of each key in every listed year, zero where there is none."""
    keys = df.select(key).where(F.col(key).isNotNull()).distinct()
    grid = keys.select(key, F.explode(F.array(*(F.lit(y) for y in years))).alias(year))
    n = df.groupBy(key, year).agg(F.count(F.lit(1)).alias("n"))
    return grid.join(n, [key, year], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def brand_tiers(df: DataFrame, brand: str, premium: Column) -> DataFrame:
    p, m = F.max(premium.cast("int")), F.max((~premium).cast("int"))
    return df.where(F.col(brand).isNotNull()).groupBy(brand).agg(F.when((p == 1) & (m == 1), "both").when(p == 1, "premium").otherwise("mass").alias("tier"))


def most_common(df: DataFrame, key: str, value: str) -> DataFrame:
    """The most common value of each key; the smaller one on ties."""
    c = df.where(F.col(key).isNotNull() & F.col(value).isNotNull()).groupBy(key, value).agg(F.count(F.lit(1)).alias("n"))
    return c.groupBy(key).agg(F.min_by(value, F.struct(-F.col("n"), F.col(value))).alias(value), F.max("n").alias("n"))


def factors(facts: DataFrame, category: str, rules: dict[str, Column]) -> DataFrame:
    """(category, factor) for each threshold rule a category's facts meet."""
    hits = F.array_compact(F.array(*(F.when(c, F.lit(n)) for n, c in rules.items())))
    return facts.select(category, F.explode(hits).alias("factor"))


def questions(hits: DataFrame, category: str, templates: dict[str, str]) -> DataFrame:
    """A question for each factor of a category, from its template."""
    text = F.create_map(*(F.lit(x) for kv in templates.items() for x in kv))[F.col("factor")]
    return hits.withColumn("question", F.replace(text, F.lit("{}"), F.col(category)))


def mark_leaves(df: DataFrame, group: str, position: str, level: str, has_data: str, depth: int = 8) -> DataFrame:
    """Rows of an ordered hierarchy that have data and no deeper row with data before the
    next row of the same or a higher level.

    For each of the few levels, windows over the following rows give the next row that ends
    a subtree of that level and the next deeper one with data; levels beyond depth - 1 are errors.
    """
    after = Window.partitionBy(group).orderBy(position).rowsBetween(1, Window.unboundedFollowing)
    lv, p = F.col(level), F.col(position)
    ends, deeper = (F.array(*(F.min(F.when(c(n), p)).over(after) for n in range(depth))) for c in (lambda n: lv <= n, lambda n: F.col(has_data) & (lv > n)))
    x = df.withColumns({"_end": F.element_at(ends, lv + 1), "_deep": F.element_at(deeper, lv + 1)})
    inside = F.col("_deep").isNotNull() & (F.col("_end").isNull() | (F.col("_deep") < F.col("_end")))
    return x.withColumn("leaf", F.col(has_data) & ~inside).drop("_end", "_deep")


def with_total(df: DataFrame, dims: list[str], fixed: list[str], label: str, aggs: list[Column]) -> DataFrame:
    """Group by dims and by fixed alone, whose rows get `label` in the other dims: a rollup by grouping sets in one pass."""
    loose = [c for c in dims if c not in fixed]
    x = df.groupingSets([dims, fixed], *dims).agg(F.grouping(loose[0]).alias("_g"), *aggs)
    return x.withColumns({c: F.when(F.col("_g") == 1, F.lit(label)).otherwise(F.col(c)) for c in loose}).drop("_g")


def facets(df: DataFrame, columns: list[str], top: int) -> DataFrame:
    """(facet, value, n, place): the most common values of each column, in one pass."""
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("facet"), F.col(c).cast("string").alias("value")) for c in columns))).alias("p")
    c = df.select(pairs).select("p.*").where("value is not null").groupBy("facet", "value").agg(F.count(F.lit(1)).alias("n"))
    r = F.row_number().over(Window.partitionBy("facet").orderBy(F.col("n").desc(), "value"))
    return c.withColumn("place", r).where(F.col("place") <= top)
