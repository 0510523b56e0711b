"""Products scored against trends: ranks, price tiers, category fit, breakdown, sales level."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions.semantics import canonical_tier, pool_size, tier_of
from weftline.operators.ranking import average_rank, running, with_total
from weftline.session import cut


def rank_in(df: DataFrame, groups: list[str], score: str, key: str, name: str = "rank") -> DataFrame:
    """Rank by score, best first, nulls last, ids break ties."""
    return running(df, groups, [F.col(score).desc_nulls_last(), key], None, name)


def top_per_group(df: DataFrame, groups: list[str], score: str, key: str, k: int) -> DataFrame:
    """The first k of each group; Spark cuts each task to k rows a group before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*groups).orderBy(F.col(score).desc_nulls_last(), key))
    return df.withColumn("rank", rank).where(F.col("rank") <= k)


def percentile_at_most(df: DataFrame, groups: list[str], score: str) -> DataFrame:
    """Percent of the group's scores that are at most this one, one decimal; 50 in a group of
    one. Counts run over distinct scores."""
    x = df.where(F.col(score).isNotNull())
    per = running(x.groupBy(*groups, F.col(score).alias("_v")).agg(F.count(F.lit(1)).alias("_c")), groups, ["_v"], "_c", "_upto")
    per = with_total_of(per, groups, "_c", "_n")
    same = F.col(score) == F.col("_v")
    for i, g in enumerate(groups):
        per = per.withColumnRenamed(g, f"_g{i}")
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    out = x.join(per, same).withColumn("percentile", F.when(F.col("_n") <= 1, 50.0).otherwise(F.round(F.col("_upto") / F.col("_n") * 100, 1)))
    return out.drop("_v", "_c", "_upto", "_n", *(f"_g{i}" for i in range(len(groups))))


def with_total_of(df: DataFrame, groups: list[str], size: str, name: str) -> DataFrame:
    """df with the sum of size of its group, by a join with the group's sum; null groups are groups."""
    n = df.groupBy(*(F.col(g).alias(f"_t{i}") for i, g in enumerate(groups))).agg(F.sum(size).alias(name))
    same = F.lit(True)
    for i, g in enumerate(groups):
        same = same & F.col(g).eqNullSafe(F.col(f"_t{i}"))
    return df.join(n, same).drop(*(f"_t{i}" for i in range(len(groups))))


def opportunity(percentile: Column) -> Column:
    return F.when(percentile < 33, "gap").when(percentile < 67, "partial").otherwise("covered")


def coverage(df: DataFrame, trend: str, score: str, key: str, k: int = 3) -> DataFrame:
    """Mean of a trend's k best scores."""
    return top_per_group(df.where(F.col(score).isNotNull()), [trend], score, key, k).groupBy(trend).agg(F.round(F.avg(score), 6).alias("coverage"))


def price_cuts(df: DataFrame, groups: list[str], value: str, tiers: int, between: bool = False) -> DataFrame:
    """(*groups, cuts, n_values): up to tiers - 1 cut lines of each group, strictly rising and
    below its maximum: the value at half-even n i / k, or midway to the next one.

    Positions are found on the running counts of distinct values, so no group is ever
    gathered: a value that repeats a million times is one row.
    """
    c = df.where(F.col(value).isNotNull()).groupBy(*groups, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    of = [F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)]
    same = F.lit(True)
    for i, g in enumerate(groups):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    c = running(c, groups, ["_v"], "_c", "_cum")
    c = c.join(c.groupBy(*of).agg(F.sum("_c").alias("_n"), F.max("_v").alias("_top")), same).drop(*(f"_g{i}" for i in range(len(groups))))
    k = F.greatest(F.lit(1), F.least(F.lit(tiers), F.floor(F.col("_n") / 2))) if between else F.lit(tiers)
    c = c.withColumn("_k", k.cast("int"))
    at = c.withColumn("_i", F.explode(F.sequence(F.lit(1), F.lit(max(1, tiers - 1))))).where(F.col("_i") < F.col("_k"))
    at = at.withColumn("_j", F.rint(F.col("_n") * F.col("_i") / F.col("_k"))).where("_j > 0 and _j < _n and _cum >= _j and _cum - _c < _j")
    line = F.col("_v")
    if between:  # the next value is the one whose running count begins where this one's ends
        after = c.select(*of, F.col("_v").alias("_next"), (F.col("_cum") - F.col("_c")).alias("_from"))
        at = at.join(after, same & (F.col("_cum") == F.col("_from")), "left").drop(*(f"_g{i}" for i in range(len(groups))))
        line = (F.col("_v") + F.when(F.col("_cum") > F.col("_j"), F.col("_v")).otherwise(F.col("_next"))) / 2
    lines = at.withColumn("_cut", line).where("_cut < _top").groupBy(*groups).agg(F.array_sort(F.collect_set("_cut")).alias("cuts"))
    sizes = c.groupBy(*groups).agg(F.first("_n").alias("n_values"))
    return sizes.join(lines, groups, "left").withColumn("cuts", F.coalesce("cuts", F.array().cast("array<double>")))


def assign_tiers(df: DataFrame, groups: list[str], value: str, tiers: int, between: bool = False) -> DataFrame:
    """tier of each row's value within its group; null without a value."""
    cuts = price_cuts(df, groups, value, tiers, between)
    return df.join(F.broadcast(cuts) if not groups else cuts, groups, "left").withColumn("tier", F.when(F.col(value).isNotNull(), tier_of(F.col(value), F.col("cuts"))))


def unit_price(price: Column, size: Column, usable: Column) -> Column:
    """Price of one base unit where size and price are positive."""
    return F.when(usable & (size > 0) & (price > 0), F.round(price / size, 8))


def unit_tiers(df: DataFrame, levels: list[str], value: str, size: str, tiers: int = 3, least: int = 30, mini: float = 0.25) -> DataFrame:
    """Unit-price tier within the finest level with `least` rows, else the coarsest.

    levels: columns from fine to coarse. Sizes under a quarter of their cohort's median are
    minis and left out of the cut lines unless fewer rows than tiers remain. Fewer tiers
    than asked are spread over the scale.
    """
    df = cut(df.where(F.col(value).isNotNull()))  # read once for each level below
    ok = df
    for lv in levels:
        n = df.groupBy(F.col(lv).alias("_l")).agg(F.count(F.lit(1)).alias(f"_n_{lv}"))
        ok = ok.join(n, F.col(lv).eqNullSafe(F.col("_l"))).drop("_l")
    level = F.coalesce(*(F.when(F.col(lv).isNotNull() & (F.col(f"_n_{lv}") >= least), F.lit(lv)) for lv in levels[:-1]), F.lit(levels[-1]))
    ok = ok.withColumn("cohort_level", level)
    name = F.coalesce(*(F.when(F.col("cohort_level") == lv, F.concat_ws(":", F.lit(lv), F.col(lv))) for lv in levels))
    ok = ok.withColumn("cohort", name).drop(*(f"_n_{lv}" for lv in levels))
    # A cohort holds all rows of its level, not only those that fell back to it.
    members = None
    for lv in levels:
        part = df.select(F.concat_ws(":", F.lit(lv), F.col(lv)).alias("cohort"), F.col(value).alias("_v"), F.col(size).alias("_s"))
        members = part if members is None else members.unionByName(part)
    members = members.join(ok.select("cohort").distinct(), "cohort", "left_semi")
    median = members.groupBy("cohort").agg((F.median("_s") * mini).alias("_line"))
    members = members.join(median, "cohort").withColumn("_mini", F.coalesce(F.col("_s") < F.col("_line"), F.lit(False)))
    rest = members.groupBy("cohort").agg(F.sum((~F.col("_mini")).cast("int")).alias("_rest"))
    cuts = price_cuts(members.join(rest, "cohort").withColumn("_use", F.when((~F.col("_mini")) | (F.col("_rest") < tiers), F.col("_v"))), ["cohort"], "_use", tiers)
    out = ok.join(cuts, "cohort", "left").join(median, "cohort", "left")
    raw = tier_of(F.col(value), F.col("cuts"))
    return out.withColumns({"is_mini_size": F.coalesce(F.col(size) < F.col("_line"), F.lit(False)), "unit_tier": canonical_tier(raw, F.size("cuts") + 1, tiers)}).drop("_line")


def group_ranges(df: DataFrame, groups: list[str], unit: str, value: str, least: int = 5) -> DataFrame:
    """10th, 50th and 90th percentile of unit prices on each group's dominant unit; ml and g count together where each has a quarter."""
    u = F.col(unit)
    n = df.where(F.col(value).isNotNull()).groupBy(*groups).agg(F.sum((u == "ml").cast("int")).alias("_ml"), F.sum((u == "g").cast("int")).alias("_g"), F.sum((u == "pcs").cast("int")).alias("_p"), F.count(F.lit(1)).alias("_n"))
    both = (F.col("_ml") >= 0.25 * F.col("_n")) & (F.col("_g") >= 0.25 * F.col("_n"))
    pick = F.when(both, "ml+g").when((F.col("_ml") >= F.col("_g")) & (F.col("_ml") >= F.col("_p")), "ml").when(F.col("_g") >= F.col("_p"), "g").otherwise("pcs")
    x = df.where(F.col(value).isNotNull()).join(n.select(*groups, pick.alias("unit_kind")), groups).where((u == F.col("unit_kind")) | ((F.col("unit_kind") == "ml+g") & u.isin("ml", "g")))
    p = x.groupBy(*groups, "unit_kind").agg(F.percentile(value, F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9))).alias("_q"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    return p.select(*groups, "unit_kind", "n", *(F.round(F.col("_q")[i], 6).alias(c) for i, c in enumerate(("p10", "p50", "p90"))))


def sales_level(df: DataFrame, groups: list[str], sold: str, reviews: str, least: int = 10) -> DataFrame:
    """Sales percentile within (group, tier): average rank of sold counts; rows without one
    take the mid rank of their reviews among the reviews of rows with one; pools under
    `least` are unknown."""
    df = cut(df)  # read several times below
    has = F.col(sold).isNotNull()
    x = average_rank(with_total(df, groups, "_have", F.col(sold)), groups, sold, "_direct").withColumn("_k", has.cast("int"))
    # Rows with counts on the review scale: running counts over distinct values.
    per = x.where(F.col(reviews).isNotNull()).groupBy(*groups, reviews).agg(F.sum("_k").alias("_same"))
    per = with_total_of(running(per, groups, [reviews], "_same", "_upto"), groups, "_same", "_all")
    per = per.withColumn("_mid", F.when(F.col("_all") > 0, (F.col("_upto") - F.col("_same") / 2) / F.nullif(F.col("_all"), F.lit(0)))).drop("_same", "_upto", "_all")
    x = x.join(per, [*groups, reviews], "left")
    level = F.when(F.col("_have") >= least, F.coalesce("_direct", "_mid"))
    return x.withColumns({"sales_percentile": F.round(level, 6), "estimated": (~has) & level.isNotNull()}).drop("_have", "_direct", "_k", "_mid")


def pool_of(df: DataFrame, trend: str, score: str, key: str, share: float = 0.01) -> DataFrame:
    """Each trend's best 1 % (half-even, at least 1 row) with ranks."""
    return rank_in(with_total(df, [trend], "_n"), [trend], score, key).where(F.col("rank") <= pool_size(F.col("_n"), share)).drop("_n")


def category_breakdown(df: DataFrame, trend: str, category: str, score: str, key: str, share: float = 0.01, n_categories: int = 4, least: int = 3) -> DataFrame:
    """Columns of a trend's pool: categories by pool count, then best score, with rank of the column and their share of the category."""
    pool = pool_of(df, trend, score, key, share)
    sizes = df.groupBy(category).agg(F.countDistinct(key).alias("category_size"))
    g = pool.where(F.col(category).isNotNull()).groupBy(trend, category).agg(F.count(F.lit(1)).alias("n_pool"), F.max(score).alias("best"))
    g = g.withColumn("place", F.row_number().over(Window.partitionBy(trend).orderBy(F.col("n_pool").desc(), F.col("best").desc_nulls_last(), category)))
    return g.where((F.col("place") <= n_categories) & (F.col("n_pool") >= least)).join(sizes, category)


def type_distribution(pool: DataFrame, trend: str, kind: str, keep: int = 5) -> DataFrame:
    """Counts of a pool's kinds: the first `keep` and the rest under null."""
    c = pool.groupBy(trend, kind).agg(F.count(F.lit(1)).alias("n"))
    r = F.row_number().over(Window.partitionBy(trend).orderBy(F.col("n").desc(), F.col(kind).asc_nulls_last()))
    c = c.withColumn("_r", r).withColumn("kind", F.when(F.col("_r") <= keep, F.col(kind)))
    return c.groupBy(trend, "kind").agg(F.sum("n").alias("n"))


def category_fit(df: DataFrame, trend: str, category: str, brand: str, score: str, price: str, key: str, tiers: int = 3) -> DataFrame:
    """Every product's tier within (trend, category) and its ranks in the category and the tier."""
    x = cut(assign_tiers(cut(df), [trend, category], price, tiers).where(F.col("tier").isNotNull()))
    x = cut(rank_in(x, [trend, category], score, key, "category_rank"))
    return with_total(rank_in(x, [trend, category, "tier"], score, key, "tier_rank"), [trend, category, "tier"], "tier_size")


def brand_best(fit: DataFrame, trend: str, category: str, brand: str) -> DataFrame:
    """A brand's best row in each category and tier by rank."""
    key = F.struct("tier_rank", "category_rank")
    best = F.min_by(F.struct("id", "tier_rank", "category_rank", "tier_size"), key).alias("b")
    return fit.groupBy(trend, category, "tier", brand).agg(best).select(trend, category, "tier", brand, "b.*")


def fit_level(rank: Column, n: Column, cuts: tuple[float, ...] = (1, 5, 20)) -> Column:
    """4 to 1: whether a rank is within the best percents, each cut truncated and at least 1."""
    out = F.lit(1)
    for level, p in zip((2, 3, 4), reversed(cuts), strict=True):
        out = F.when(rank <= F.greatest(F.lit(1), (n * p / 100).cast("int")), level).otherwise(out)
    return out


def category_agreement(top: DataFrame, trend: str, category: str, main: str, k: int = 5) -> DataFrame:
    """How many of a trend's first k products are in its main category; under 2 means no close product."""
    n = F.sum((F.col(category) == F.col(main)).cast("int"))
    return top.where(F.col("rank") <= k).groupBy(trend).agg(F.coalesce(n, F.lit(0)).alias("n_close")).withColumn("no_close_product", F.col("n_close") < 2)


def main_category(pool: DataFrame, trend: str, category: str) -> DataFrame:
    """The most common category of a pool; the name breaks ties."""
    c = pool.where(F.col(category).isNotNull()).groupBy(trend, category).agg(F.count(F.lit(1)).alias("n"))
    return c.groupBy(trend).agg(F.min_by(F.struct(category, "n"), F.struct(-F.col("n"), F.col(category))).alias("m")).select(trend, "m.*")


def overall_level(counts: DataFrame, group: str, level: str, n: str) -> DataFrame:
    """The highest level that strictly more than half reach."""
    by = Window.partitionBy(group)
    reach = F.sum(n).over(by.orderBy(F.col(level).desc()))
    total = F.sum(n).over(by)
    return counts.withColumns({"_r": reach, "_t": total}).where("_r * 2 > _t").groupBy(group).agg(F.max(level).alias("overall_level"))


def compare_runs(old: DataFrame, new: DataFrame, trend: str, key: str, k: int = 10) -> DataFrame:
    """(trend, n_old, n_new, kept, entered) of two runs' first k (trend, key, rank)."""
    o = old.where(F.col("rank") <= k).select(trend, key, F.lit(1).alias("o"))
    n = new.where(F.col("rank") <= k).select(trend, key, F.lit(1).alias("n"))
    g = o.join(n, [trend, key], "full").groupBy(trend)
    both = (F.col("o") == 1) & (F.col("n") == 1)
    return g.agg(F.count("o").alias("n_old"), F.count("n").alias("n_new"), F.sum(F.coalesce(both.cast("int"), F.lit(0))).alias("kept")).withColumn("entered", F.col("n_new") - F.col("kept"))


def cosine(a: Column, b: Column) -> Column:
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)
    size = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x))
    return dot / F.nullif(size(a) * size(b), F.lit(0.0))


def nearest(queries: DataFrame, items: DataFrame, k: int, most: int = 100_000) -> DataFrame:
    """(query, item, similarity, rank): the k items nearest to each query, exactly.

    queries (query, qv) is the stated set. It is shipped to the item partitions in blocks of about
    `most`; a task keeps its k best a query, so the shuffle moves k rows a query and task.
    """
    blocks = max(1, -(-queries.count() // most))
    out = None
    for b in range(blocks):
        part = queries if blocks == 1 else queries.where(F.pmod(F.xxhash64("query"), F.lit(blocks)) == b)
        x = items.crossJoin(F.broadcast(part)).select("query", "item", F.round(cosine(F.col("qv"), F.col("iv")), 6).alias("similarity"))
        best = top_per_group(x, ["query"], "similarity", "item", k)
        out = best if out is None else out.unionByName(best)
    return out
