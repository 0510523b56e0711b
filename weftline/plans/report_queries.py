"""Queries of gates, views and whole analyses, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftline.functions import semantics as S
from weftline.operators import evidence as V
from weftline.operators import growth, learn, series
from weftline.operators import market as M
from weftline.operators import report as R
from weftline.operators import supply as U
from weftline.plans.growth_queries import ROLL_SQL
from weftline.plans.market_queries import SHARES_SQL, SIZES_SQL, searches, shares, sizes
from weftline.plans.supply_queries import LISTINGS_SQL, RANKED, listings
from weftline.sources import sinks
from weftline.sources.standins import mapping, monthly, predictions
from weftline.sources.tables import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


@query("i10_exact_evidence", "select doc_id, length(trim(coalesce(matched_keyword, ''))) >= 12 and contains(trim(regexp_replace(lower(coalesce(title, '')), '\\s+', ' ', 'g')), trim(regexp_replace(lower(coalesce(matched_keyword, '')), '\\s+', ' ', 'g'))) as found from documents")
def i10(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", V.fragments_in(F.col("matched_keyword"), F.col("title")).alias("found"))


@query("i11_report_names", "with n as (select trend_id, list_distinct(regexp_extract_all(coalesce(trend_name, ''), '\\b([A-Z][\\w''-]+(?: [A-Z][\\w''-]+)+)\\b', 1)) n, lower(coalesce(keywords, '')) s from trends) select trend_id, len(list_filter(n, lambda x: not contains(s, lower(x)))) as n_unknown from n")
def i11(spark, d):
    return table(spark, d, "trends").select("trend_id", F.size(R.names_not_in(F.col("trend_name"), F.col("keywords"))).alias("n_unknown"))


@query("i14_check_finding", "select trend_id, case when stream_name is null or stream_name not in ('Paper', 'Search') then 'unknown factor' when trim(coalesce(trend_name, '')) = '' then 'empty' when regexp_matches(trend_name, '[฀-๿]') then 'wrong language' when keywords is null or not (length(trim(split_part(keywords, ';', 1))) >= 3) then 'quote not in source' else 'ok' end as result from trends")
def i14(spark, d):
    t = table(spark, d, "trends")
    return t.select("trend_id", R.check_finding(F.col("stream_name"), F.col("trend_name"), F.split("keywords", ";")[0], F.col("keywords"), ["Paper", "Search"]).alias("result"))


@query("i15_validate_links", "select p_partkey, case when p_size % 5 in (0, 1, 2) then p_size % 5 else 0 end::int as level, p_name as evidence from part")
def i15(spark, d):
    return table(spark, d, "part").select("p_partkey", R.validate_links((F.col("p_size") % 5).cast("int"), F.col("p_name")).alias("x")).select("p_partkey", "x.*")


@query("i16_topic_points", "with f as (select p_brand, p_name, min(p_partkey) k from part group by all) select p_brand, p_name, k as p_partkey from f qualify row_number() over (partition by p_brand order by k, p_name) <= 9")
def i16(spark, d):
    return R.first_use(table(spark, d, "part").select("p_brand", "p_name", "p_partkey"), "p_brand", "p_partkey", "p_name", 9)


@query("i21_comparative", "select trend_id, case when rank_short >= 70 and n_keywords / 60.0::double >= 0.6 then rank_short - case when growth_score_y1 > .5 then 22 else 12 end else rank_short end as score from trends where rank_short is not null")
def i21(spark, d):
    t = table(spark, d, "trends").where("rank_short is not null")
    return t.select("trend_id", R.comparative_delta(F.col("rank_short"), F.col("growth_score_y1"), F.col("n_keywords") / 60).alias("score"))


@query("i26_match_text", "with k as (select trend_id, trend_name, array_to_string(list_filter(list_transform(string_split(keywords, ';'), lambda x: trim(x)), lambda x: x <> ''), ' | ') q from trends) select trend_id, concat_ws(' | ', trend_name, q) as text from k")
def i26(spark, d):
    return table(spark, d, "trends").select("trend_id", R.match_text(F.col("trend_name"), F.split("keywords", ";")).alias("text"))


@query("i36_flatten", "select event_id, coalesce(json_extract_string(props, '$.value'), json_extract_string(props, '$.text'), regexp_replace(props, '^\"|\"$', '', 'g')) as text from events")
def i36(spark, d):
    return table(spark, d, "events").select("event_id", R.flatten_value(F.col("props")).alias("text"))


@query("i30_quadrant", "with m as (select median(growth_score_y1) a, median(growth_score_y3) b from trends) select trend_id, case when growth_score_y1 >= a and growth_score_y3 >= b then 'defend' when growth_score_y1 >= a then 'maintain' when growth_score_y3 >= b then 'build' else 'monitor' end as quadrant from trends, m")
def i30(spark, d):
    t = table(spark, d, "trends")
    m = t.agg(F.median("growth_score_y1").alias("a"), F.median("growth_score_y3").alias("b"))
    return t.crossJoin(F.broadcast(m)).select("trend_id", R.quadrant(F.col("growth_score_y1"), F.col("growth_score_y3"), F.col("a"), F.col("b")).alias("quadrant"))  # one row


@query("k01_growth_run", f"with {ROLL_SQL}, h as (select cluster, month, avg(value) v, row_number() over (partition by cluster order by month desc) r from mapping join monthly using (keyword) group by 1, 2) select cluster, score_y1, past_growth_pct, count(h.month) as history_months, round(max(v) filter (r = 1), 2) as last_level from roll join h using (cluster) where r <= 60 group by all")
def k01(spark, d):
    g = growth.roll_up(predictions(spark, d), mapping(spark, d), "keyword", "cluster", (1, 3)).select("cluster", "score_y1", "past_growth_pct")
    h = mapping(spark, d).join(monthly(spark, d), "keyword").groupBy("cluster", "month").agg(F.avg("value").alias("v"))
    h = h.withColumn("r", F.row_number().over(Window.partitionBy("cluster").orderBy(F.col("month").desc()))).where("r <= 60")
    h = h.groupBy("cluster").agg(F.count(F.lit(1)).alias("history_months"), F.round(F.max(F.when(F.col("r") == 1, F.col("v"))), 2).alias("last_level"))
    return g.join(h, "cluster")


@query("k07_market_facts", f"with {SHARES_SQL}, {SIZES_SQL}, z as (select category, max(case when year = 1996 then value end) a, max(case when year = 2000 then value end) b from sizes group by 1), r as (select category, brand, share, row_number() over (partition by category order by share desc, brand) k from shares where year = 2000), t as (select category, round(sum(share), 6) top5, string_agg(brand, ', ' order by k) brands from r where k <= 5 group by 1) select category, a as base, b as last, top5 as top_share, brands from z join t using (category)")
def k07(spark, d):
    z = M.size_facts(sizes(spark, d), "category", 1996, 2000, 2001).select("category", "base", "last")
    r = shares(spark, d).where("year = 2000").withColumn("k", F.row_number().over(Window.partitionBy("category").orderBy(F.col("share").desc(), "brand"))).where("k <= 5")
    names = F.transform(F.array_sort(F.collect_list(F.struct("k", "brand"))), lambda s: s["brand"])
    return z.join(r.groupBy("category").agg(F.round(F.sum("share"), 6).alias("top_share"), F.array_join(names, ", ").alias("brands")), "category")


@query("k10_brand_category", f"with {LISTINGS_SQL}, r as (select *, row_number() over (partition by trend, grp order by sim desc nulls last, id) rk, count(*) over (partition by trend, grp) n from lst where trend is not null and grp is not null) select brand, grp, count(*) as n_products, min(rk) as best_rank, sum((rk <= greatest(1, trunc(n * .05::double)))::int)::bigint as in_best_5pct from r where brand is not null group by all")
def k10(spark, d):
    x = listings(spark, d).where("trend is not null and grp is not null")
    x = U.with_total(U.rank_in(x, ["trend", "grp"], "sim", "id"), ["trend", "grp"], "n").where("brand is not null")
    return x.groupBy("brand", "grp").agg(F.count(F.lit(1)).alias("n_products"), F.min("rank").alias("best_rank"), F.sum((F.col("rank") <= S.top_percent_cut(F.col("n"), 5)).cast("int")).alias("in_best_5pct"))


@query("l35_product_view", f"with {LISTINGS_SQL} select trend, id, pname, brand, grp, sub, sim, price from (select *, {RANKED} k from lst where trend is not null) where k <= 3")
def l35(spark, d):
    return U.top_per_group(listings(spark, d).where("trend is not null"), ["trend"], "sim", "id", 3).select("trend", "id", "pname", "brand", "grp", "sub", "sim", "price")


@query("j06_forecast_run")
def j06(spark, d):
    m = series.trim_zero_runs(monthly(spark, d), "keyword", "month", "value")
    z = series.rolling_z(m, "keyword", "month", "value")
    f = learn.forecast_series(z.select("keyword", "month", "z_score"), "keyword", "month", "z_score")
    ahead = f.select(F.col("keyword").alias("cluster_id"), "model", F.col("month").alias("date"), F.lit("Forecast").alias("type"), F.col("value").alias("z_score"))
    fit = ahead.select("cluster_id", "model").distinct().join(z.select(F.col("keyword").alias("cluster_id"), F.col("month").alias("date"), "z_score"), "cluster_id")
    return growth.master_report(fit.select("cluster_id", "model", "date", F.lit("Fit").alias("type"), "z_score").unionByName(ahead))


@query("b02_closed_export", "select distinct trend_id, trend_name, main_category, null::varchar as glossary from trends")
def b02(spark, d):
    t = table(spark, d, "trends").select("trend_id", "trend_name", "main_category").distinct()
    return sinks.closed(t, ["trend_id", "trend_name", "main_category", "glossary"])


