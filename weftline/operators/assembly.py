"""Tables put together for reports and runs: lookups in order of preference, overrides, talk, figures, backtests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_found(wanted: DataFrame, key: str, sources: dict[str, DataFrame], value: str) -> DataFrame:
    """(key, value, how): the value of the first source that has the key, in the order given, and
    that source's name; keys that none has are left out. A source has one row a key."""
    out = wanted.select(key).distinct()
    for name, s in sources.items():
        out = out.join(s.select(key, F.col(value).alias(f"_{name}")), key, "left")
    cols = [f"_{n}" for n in sources]
    how = F.coalesce(*(F.when(F.col(c).isNotNull(), F.lit(c[1:])) for c in cols))
    return out.select(key, F.coalesce(*cols).alias(value), how.alias("how")).where("how is not null")


def overridden(df: DataFrame, keys: list[str], override: DataFrame, columns: list[str]) -> DataFrame:
    """df with the columns an override has for its key, and `overridden`; nulls of an override don't count."""
    o = override.select(*keys, *(F.col(c).alias(f"_o_{c}") for c in columns), F.lit(True).alias("_has"))
    x = df.join(o, keys, "left")
    x = x.withColumns({c: F.coalesce(f"_o_{c}", c) for c in columns}).withColumn("overridden", F.coalesce("_has", F.lit(False)))
    return x.drop("_has", *(f"_o_{c}" for c in columns))


def search_talk(searches: DataFrame, category: str, query: str, place: str, fed: str) -> DataFrame:
    """A category's searches: how many, in which place only or in both, how many feed a trend."""
    q = searches.groupBy(category, query).agg(F.collect_set(place).alias("_p"), F.max(F.col(fed).cast("int")).alias("_f"))
    only = lambda p: F.sum(((F.size("_p") == 1) & F.array_contains("_p", p)).cast("int"))
    return q.groupBy(category).agg(F.count(F.lit(1)).alias("n"), only("th").alias("th"), only("ww").alias("ww"), F.sum((F.size("_p") > 1).cast("int")).alias("both"), F.sum("_f").alias("fed"))


def growth_box(global_ratio: Column, local_ratio: Column, rising: float = 1.5) -> Column:
    """Which of the four boxes two growth ratios fall in."""
    g, t = global_ratio >= rising, local_ratio >= rising
    return F.when(global_ratio.isNull() | local_ratio.isNull(), None).when(g & t, "both grow").when(g, "window").when(t, "local only").otherwise("both flat")


def growth_points(series: DataFrame, entity: str, month: str, far: str, near: str, cutoffs: list[str], ahead: int = 24, ratio: float = 1.5, level: float = 5.0) -> DataFrame:
    """(cutoff, entity, box, future_ratio, future_level, rose) at each cut-off: growth of the far and the near
    series over the last 12 months against the 12 before, and what the near one did afterwards.
    Series (entity, month, far, near) have a row for every month."""
    c = series.sparkSession.createDataFrame([(x,) for x in cutoffs], "cutoff string").select(F.to_date("cutoff").alias("cutoff"))
    x = series.join(F.broadcast(c))  # a handful of cut-offs
    at = F.months_between(F.trunc(month, "MM"), F.trunc("cutoff", "MM")).cast("int")
    mean = lambda v, a, b: F.avg(F.when((at >= a) & (at <= b), F.col(v)))
    n = lambda a, b: F.count(F.when((at >= a) & (at <= b), 1))
    g = x.groupBy("cutoff", entity).agg(mean(far, -11, 0).alias("f1"), mean(far, -23, -12).alias("f0"), mean(near, -11, 0).alias("n1"), mean(near, -23, -12).alias("n0"), mean(near, 1, ahead).alias("after"), n(-23, ahead).alias("months"))
    up = lambda a, b: (F.col(a) + 1) / (F.col(b) + 1)
    g = g.where(F.col("months") == ahead + 24).withColumns({"future_ratio": up("after", "n1"), "box": growth_box(up("f1", "f0"), up("n1", "n0"), ratio)})
    return g.select("cutoff", entity, "box", F.round("future_ratio", 3).alias("future_ratio"), F.round("after", 2).alias("future_level"), ((F.col("future_ratio") >= ratio) & (F.col("after") >= level)).alias("rose"))


def hit_rates(points: DataFrame) -> DataFrame:
    """(box, n, rate) and the difference of each box's rate to the one where both are flat."""
    r = points.groupBy("box").agg(F.count(F.lit(1)).alias("n"), F.avg(F.col("rose").cast("double")).alias("rate"))
    flat = r.where("box = 'both flat'").select(F.col("rate").alias("_flat"))
    return r.join(F.broadcast(flat), how="left").select("box", "n", F.round("rate", 4).alias("rate"), F.round(F.col("rate") - F.col("_flat"), 4).alias("difference"))  # one row


def backfill(stored: DataFrame, fresh: DataFrame, key: str, rank: str, item: str) -> DataFrame:
    """(key, stored_item, fresh_item, same): whether recomputed first places are the stored ones. A
    backfill is written only where all are."""
    s = stored.where(F.col(rank) == 1).select(key, F.col(item).alias("stored_item"))
    f = fresh.where(F.col(rank) == 1).select(key, F.col(item).alias("fresh_item"))
    return s.join(f, key, "full").withColumn("same", F.col("stored_item").eqNullSafe(F.col("fresh_item")))


def label_slots(points: DataFrame, group: str, x: str, y: str, key: str, height: float) -> DataFrame:
    """points with `slot`, the place of each label: by y, and pushed up where it would touch the one below. The
    least shift is the running maximum of y less the height of the labels below."""
    by = Window.partitionBy(group).orderBy(y, x, key)
    i = F.row_number().over(by) - 1
    p = points.withColumn("_b", F.col(y) - i * height)
    return p.withColumn("slot", F.max("_b").over(by.rowsBetween(Window.unboundedPreceding, 0)) + i * height).drop("_b")


def hoisted(wrapped: Column, fields: list[str]) -> dict[str, Column]:
    """The fields of a JSON text whether they stand at its top or in one object below it, lists as text."""
    inner = F.map_values(F.from_json(wrapped, "map<string, string>"))
    below = lambda f: F.filter(F.transform(inner, lambda v: F.get_json_object(v, f"$.{f}")), lambda v: v.isNotNull())
    return {f: F.coalesce(F.get_json_object(wrapped, f"$.{f}"), F.try_element_at(below(f), F.lit(1))) for f in fields}


def synthesis_status(questions: DataFrame, cache: DataFrame, passages: DataFrame, key: str, digest: str) -> DataFrame:
    """(key, status): cached where the cache has the same digest, no evidence without a passage, else to ask."""
    c = cache.select(key, F.col(digest).alias("_d"))
    n = passages.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    x = questions.join(c, key, "left").join(n, key, "left")
    return x.select(key, F.when(F.col("_d") == F.col(digest), "cached").when(F.coalesce("_n", F.lit(0)) == 0, "no evidence").otherwise("ask").alias("status"))
