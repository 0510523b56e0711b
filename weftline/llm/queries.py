"""Registered queries of the operators for training data, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm import byte_bpe, canonical, look, mixture, products, quantile_sketch, reading, topn
from weftline.operators.ranking import running
from weftline.session import cut
from weftline.sources.tables import distinct_rows, table

def _products(spark: SparkSession, d: str) -> DataFrame:
    v = table(spark, d, "validate_at_scale_nvidia").select(F.col("listing_id").alias("id"), F.col("product_name").alias("name"), "brand", "subgroup", F.col("pack_size").alias("size"), F.col("unit_label").alias("unit"), F.col("sale_price_thb").alias("price"))
    prices = table(spark, d, "export_llm_data").select(F.col("own_listing_id").alias("id"), F.col("own_price_thb").alias("price"))
    return products.same_product(v, prices)


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Every two listings that sell the same product."""
    return products.pairs_of(_products(spark, d)).select(F.col("a").alias("listing_id_a"), F.col("b").alias("listing_id_b"))


def p1_groups(spark: SparkSession, d: str) -> DataFrame:
    """Each listing with its product."""
    return _products(spark, d).select(F.col("id").alias("listing_id"), "product").distinct()


#: Percentiles of the problem's report, and the relative error they are given within.
WANTED, ERROR = [0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99], 0.01


def _measures(spark: SparkSession, d: str) -> DataFrame:
    """(measure, grp, day, value) of both tables, each row once."""
    v = distinct_rows(table(spark, d, "validate_at_scale_nvidia"), "listing_id", "product_group", "scored_at", "similarity")
    e = distinct_rows(table(spark, d, "export_llm_data"), "export_id", "main_category", "exported_at", "own_top_pct_in_category")
    parts = [
        t.select(F.lit(name).alias("measure"), F.col(g).alias("grp"), F.to_date(at).alias("day"), F.col(name).alias("value"))
        for t, name, g, at in ((v, "similarity", "product_group", "scored_at"), (e, "own_top_pct_in_category", "main_category", "exported_at"))
    ]
    return parts[0].unionAll(parts[1])


def p2_percentiles(spark: SparkSession, d: str) -> DataFrame:
    """Median and other percentiles of both measures for each group."""
    s = quantile_sketch.sketch(_measures(spark, d), ["measure", "grp"], "value", ERROR)
    return quantile_sketch.percentiles(s, ["measure", "grp"], WANTED, ERROR).withColumn("value", F.round("value", 6))


def p2_merged_days(spark: SparkSession, d: str) -> DataFrame:
    """The same from sketches of single days, merged."""
    days = quantile_sketch.sketch(_measures(spark, d), ["measure", "grp", "day"], "value", ERROR)
    s = quantile_sketch.merge(days, ["measure", "grp"])
    return quantile_sketch.percentiles(s, ["measure", "grp"], WANTED, ERROR).withColumn("value", F.round("value", 6))


def p2_day_sketches(spark: SparkSession, d: str) -> DataFrame:
    """The sketches themselves, by day: counts that add up over days, files and runs."""
    return quantile_sketch.sketch(_measures(spark, d), ["measure", "grp", "day"], "value", ERROR)


def p2_bound(spark: SparkSession, d: str) -> DataFrame:
    """Each percentile beside the exact one, and whether it lies within the stated error of it."""
    m = _measures(spark, d).where("value is not null and not isnan(value)")
    s = quantile_sketch.percentiles(quantile_sketch.sketch(m, ["measure", "grp"], "value", ERROR), ["measure", "grp"], WANTED, ERROR)
    values = m.groupBy("measure", "grp", "value").agg(F.count(F.lit(1)).alias("k"))
    upto = running(values, ["measure", "grp"], ["value"], "k", "upto").withColumnRenamed("value", "exact")
    at = F.floor(F.col("percentile") * (F.col("n") - 1))
    both = s.alias("s").join(upto.alias("e"), F.col("s.measure").eqNullSafe(F.col("e.measure")) & F.col("s.grp").eqNullSafe(F.col("e.grp")) & (at < F.col("upto")) & (at >= F.col("upto") - F.col("k")))
    return both.select("s.measure", "s.grp", "s.percentile", "s.n", "e.exact", (F.abs(F.col("s.value") - F.col("e.exact")) <= ERROR * F.abs(F.col("e.exact")) + 1e-12).alias("within"))


_MEASURES = """
with m as (
  select 'similarity' measure, product_group grp, scored_at::date d, similarity v from (select distinct listing_id, product_group, scored_at, similarity from validate_at_scale_nvidia)
  union all
  select 'own_top_pct_in_category', main_category, exported_at::date, own_top_pct_in_category from (select distinct export_id, main_category, exported_at, own_top_pct_in_category from export_llm_data)),
f as (select * from m where v is not null and not isnan(v))"""

#: Buckets of ratio 1.01 / 0.99, as for an error of 1 %; 750 / ln(1.01 / 0.99) rounded up is 37499.
_BUCKET = "case when v = 0 then 0 else sign(v) * (ceil(ln(abs(v)) / ln(1.01::double / 0.99::double)) + 37499) end::bigint"

P2_DAYS_SQL = f"""{_MEASURES}
select measure, grp, d as "day", {_BUCKET} as bucket, count(*) as n from f group by all"""

P2_SQL = f"""{_MEASURES},
b as (select measure, grp, {_BUCKET} b, count(*) n from f group by all),
c as (select *, sum(n) over (partition by measure, grp order by b) upto, sum(n) over (partition by measure, grp) total from b),
p as (select unnest([{", ".join(map(str, WANTED))}]::double[]) percentile)
select measure, grp, percentile, round(case when b = 0 then 0 else sign(b) * pow(1.01::double / 0.99::double, abs(b) - 37499) * 0.99::double end, 6) as value, total::bigint as n
from c, p where floor(percentile * (total - 1)) >= upto - n and floor(percentile * (total - 1)) < upto"""

#: Exact values by rank; the claim is that every answer lies within the error.
P2_BOUND_SQL = f"""{_MEASURES},
r as (select *, row_number() over (partition by measure, grp order by v) - 1 r, count(*) over (partition by measure, grp) n from f),
p as (select unnest([{", ".join(map(str, WANTED))}]::double[]) percentile)
select measure, grp, percentile, n, v as exact, true as within from r, p where r = floor(percentile * (n - 1))"""


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """The three best rows of each customer by own_similarity."""
    e = table(spark, d, "export_llm_data").where("own_similarity between 0 and 1")
    order = [("own_similarity", False), ("own_rank_in_category", True), ("leader_similarity", False)]
    return topn.top_n(e, "customer", order, "export_id", 3).select("customer", "export_id")


P3_SQL = """
select customer, export_id from (
  select customer, export_id, row_number() over (partition by customer order by own_similarity desc, own_rank_in_category asc nulls last,
    case when isnan(leader_similarity) then 1 else 0 end, leader_similarity desc nulls last, export_id) r
  from (select distinct customer, export_id, own_similarity, own_rank_in_category, leader_similarity from export_llm_data)
  where customer is not null and own_similarity between 0 and 1)
where r <= 3"""


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """The brand meant by each typed leader_brand, 0 where the list has none."""
    e, names, others = (table(spark, d, t) for t in ("export_llm_data", "brand_list", "brand_aliases"))
    return canonical.map_rows(e, "export_id", "leader_brand", names, others, "brand_id", "brand_name", "alias_text")


def p4_unmatched(spark: SparkSession, d: str) -> DataFrame:
    """The typed values without an entry, and how many rows have them."""
    e, names, others = (table(spark, d, t) for t in ("export_llm_data", "brand_list", "brand_aliases"))
    values = canonical.map_values(e, "leader_brand", names, others, "brand_id", "brand_name", "alias_text").where("id = 0")
    n = e.select("export_id", "leader_brand").distinct().groupBy("leader_brand").agg(F.count(F.lit(1)).alias("n_rows"))
    return n.join(values, n.leader_brand == values.value).select("leader_brand", "n_rows", F.round("score", 6).alias("best_score"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Keywords that look like a listed one, and names that look like another's."""
    words = look.same_look_in_list(table(spark, d, "pmc_timeseries"), "series_id", "keyword", table(spark, d, "pmc_keywords"), "keyword_id", "keyword")
    names = look.same_look(table(spark, d, "validate_at_scale_nvidia"), "listing_id", "product_name")
    return words.select(F.lit("keyword").alias("field_name"), "left_id", "right_id").unionAll(names.select(F.lit("product_name"), "left_id", "right_id"))


def p5_classes(spark: SparkSession, d: str) -> DataFrame:
    """Each listing whose name looks like another text's, with the class of its look."""
    return look.look_classes(table(spark, d, "validate_at_scale_nvidia"), "listing_id", "product_name")


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    """Token ids of every document."""
    return table(spark, d, "documents").select("doc_id", byte_bpe.token_ids(F.col("text")).alias("ids"))


def _drawn(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    docs = table(spark, d, "documents").select("doc_id", "source", byte_bpe.token_count(F.col("text")).cast("long").alias("tokens"))
    targets = table(spark, d, "mix_targets")
    return mixture.draw(docs, targets, "doc_id", "source", "tokens"), targets


def p8_mix(spark: SparkSession, d: str) -> DataFrame:
    """Each drawn document with its repeats."""
    return _drawn(spark, d)[0]


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    """The share each source really reaches."""
    drawn, targets = _drawn(spark, d)
    return mixture.shares(drawn, targets, "source", "tokens")


def p8_capped_shares(spark: SparkSession, d: str) -> DataFrame:
    """The shares reached where the budget is the size of the corpus, so that small sources run out at their caps."""
    docs = table(spark, d, "documents").select("doc_id", "source", byte_bpe.token_count(F.col("text")).cast("long").alias("tokens"))
    docs, targets = cut(docs), table(spark, d, "mix_targets")
    budget = docs.agg(F.sum("tokens")).first()[0] or 0
    return mixture.shares(mixture.draw(docs, targets, "doc_id", "source", "tokens", budget), targets, "source", "tokens")


def _levels(spark: SparkSession, d: str) -> DataFrame:
    return reading.levels(table(spark, d, "documents"), "doc_id", "text", table(spark, d, "reading_labels"), "doc_id", "rater", "reading_level")


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """The level most of each document's sentences are written at."""
    return _levels(spark, d).select("doc_id", F.col("reading_level").cast("long"))


def p9_profile(spark: SparkSession, d: str) -> DataFrame:
    """Documents and mean difficulty of each source and level."""
    x = reading.joined(_levels(spark, d), table(spark, d, "documents").select("doc_id", "source"), "doc_id")
    return x.groupBy("source", "reading_level").agg(F.count(F.lit(1)).alias("n_docs"), F.round(F.avg("difficulty"), 4).alias("mean_difficulty"))


QUERIES = {
    "p1_found": p1_found,
    "p1_groups": p1_groups,
    "p2_percentiles": p2_percentiles,
    "p2_merged_days": p2_merged_days,
    "p2_day_sketches": p2_day_sketches,
    "p2_bound": p2_bound,
    "p3_found": p3_found,
    "p4_found": p4_found,
    "p4_unmatched": p4_unmatched,
    "p5_found": p5_found,
    "p5_classes": p5_classes,
    "p7_ids": p7_ids,
    "p8_mix": p8_mix,
    "p8_shares": p8_shares,
    "p8_capped_shares": p8_capped_shares,
    "p9_found": p9_found,
    "p9_profile": p9_profile,
}

SQL = {"p2_percentiles": P2_SQL, "p2_merged_days": P2_SQL, "p2_day_sketches": P2_DAYS_SQL, "p2_bound": P2_BOUND_SQL, "p3_found": P3_SQL}
