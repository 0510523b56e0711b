"""Queries of catalogues, labels and report views, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftline.functions import semantics as S
from weftline.functions import text as T
from weftline.operators import catalogue as C
from weftline.operators.series import onset
from weftline.plans.supply_queries import LISTINGS_SQL, listings
from weftline.sources import readers, sinks
from weftline.sources.standins import MONTHLY_SQL, monthly
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


@query("c01_catalogue_rows", "select distinct on (product_id) product_id, listing_id, sale_price_thb as price from (select * from validate_at_scale_nvidia order by listing_id)")
def c01(spark: SparkSession, d: str) -> DataFrame:
    v = table(spark, d, "validate_at_scale_nvidia").select("product_id", "listing_id", "product_name", F.col("sale_price_thb").cast("string").alias("price_text"))
    return C.to_catalogue(v, "product_id", "listing_id", ["product_name"], "price_text").select("product_id", "listing_id", "price")


@query("c04_accent_key", "select distinct listing_id, upper(strip_accents(brand)) as key from validate_at_scale_nvidia where brand is not null")
def c04(spark, d):
    v = table(spark, d, "validate_at_scale_nvidia").where("brand is not null")
    return v.select("listing_id", F.upper(C.fold_accents(F.col("brand"))).alias("key")).distinct()


_BOILER = "cookies|all rights reserved|reproduction prohibited|subscribe|หน้าแรก"


@query("c13_clean_documents", f"with l as (select doc_id, text, list_filter(list_transform(regexp_split_to_array(text, '\\r?\\n'), lambda x: trim(x, ' ')), lambda x: x <> '' and not regexp_matches(x, '^[=_*#\\t\\n\\f\\r\\x0b -]+$') and not regexp_matches(lower(x), '{_BOILER}')) k from documents where text is not null), o as (select doc_id, text, trim(regexp_replace(array_to_string(k, ' '), '[\\t\\n\\f\\r\\x0b ]+', ' ', 'g'), ' ') o from l) select doc_id, case when length(o) < 50 then trim(text, ' ') else o end as clean from o")
def c13(spark, d):
    return table(spark, d, "documents").where("text is not null").select("doc_id", C.clean_document(F.col("text"), _BOILER).alias("clean"))


@query("c20_worldwide_query", "select trend_id, trim(regexp_replace(trend_name, '(?i)\\b(in|for)?\\s*thailand\\b', '', 'g')) || ' worldwide' as query from trends where trend_name is not null")
def c20(spark, d):
    t = table(spark, d, "trends").where("trend_name is not null")
    return t.select("trend_id", F.concat(F.trim(T.rewrite(F.col("trend_name"), [(r"(?i)\b(in|for)?\s*thailand\b", "")])), F.lit(" worldwide")).alias("query"))


@query("i06_pick_label", "select p_partkey, case when p_brand = b2 then p_brand when p_brand = r then p_brand when b2 = r then b2 when p_size > 25 then p_brand else b2 end as label from (select *, 'Brand#' || (p_size % 3 + 1) b2, 'Brand#' || (p_partkey % 5 + 1) r from part)")
def i06(spark, d):
    p = table(spark, d, "part")
    b2, r = (F.concat(F.lit("Brand#"), x.cast("string")) for x in (F.col("p_size") % 3 + 1, F.col("p_partkey") % 5 + 1))
    return p.select("p_partkey", C.pick_label(F.col("p_brand"), b2, r, F.col("p_size").cast("double"), F.lit(25.0)).alias("label"))


@query("a08_label_variants", "select p_name as key, arg_max(p_size, p_partkey) filter (p_type = 'PROMO') as \"PROMO\", arg_max(p_size, p_partkey) filter (p_type = 'ECONOMY') as \"ECONOMY\" from part group by 1 having count(*) filter (p_type in ('PROMO', 'ECONOMY')) >= 0")
def a08(spark, d):
    p = table(spark, d, "part").select(F.col("p_name").alias("key"), F.col("p_type").alias("variant"), "p_partkey", "p_size")
    return C.latest_by_variant(p, "key", "variant", "p_partkey", ["p_size"], ["PROMO", "ECONOMY"])


@query("i17_theme_assignment", "with m as (select p_brand k, p_partkey m from part), t as (select k, m, min(case when m % 3 = 0 then 1 when m % 2 = 0 then 2 end) pl from m group by all) select k, m as member, case when pl = 1 then 'threes' when pl = 2 then 'evens' else 'Other' end as theme from t")
def i17(spark, d):
    m = table(spark, d, "part").select(F.col("p_brand").alias("k"), F.col("p_partkey").alias("member"))
    ids = lambda n, place, name: m.where(F.col("member") % n == 0).groupBy("k").agg(F.collect_list("member").alias("ids")).select("k", F.lit(place).alias("place"), F.lit(name).alias("theme"), "ids")
    return C.assign_once(ids(3, 1, "threes").unionByName(ids(2, 2, "evens")), m, "k", "theme", "ids", least=0.0)


@query("a10_category_tree", "select distinct product_group as name, 1 as level from validate_at_scale_nvidia where product_group is not null union select distinct subgroup, 2 from validate_at_scale_nvidia where subgroup is not null and product_group is not null and subgroup not in (select product_group from validate_at_scale_nvidia where product_group is not null)")
def a10(spark, d):
    v = table(spark, d, "validate_at_scale_nvidia").select("product_group", "subgroup").distinct().where("product_group is not null")
    tree = v.groupBy(F.col("product_group").alias("id")).agg(F.transform(F.collect_set("subgroup"), lambda s: F.struct(s.alias("id"), s.alias("name"))).alias("kids")).withColumn("name", F.col("id"))
    return readers.flatten_tree(tree, "id", "name", "kids").select("name", "level")


@query("a14_source_priority", "with u as (select doc_id, title, case source when 'paper' then 0 when 'news' then 1 else 2 end p from documents where source in ('paper', 'news', 'social') and title is not null) select title, first(doc_id order by p, doc_id) as doc_id from u group by 1")
def a14(spark, d):
    x = table(spark, d, "documents").where("title is not null").select("title", "doc_id", "source")
    one = lambda s: x.where(F.col("source") == s).groupBy("title").agg(F.min("doc_id").alias("doc_id"))
    return C.by_priority([one("paper"), one("news"), one("social")], "title")


@query("a20_videos", "with v as (select event_id, event_type, (user_id % 90) * 60 + 13 s from events), o as (select *, row_number() over (partition by event_type order by event_id) r from v where s between 240 and 1200) select event_id, s::int as seconds from o where r <= 20")
def a20(spark, d):
    e = table(spark, d, "events").withColumn("t", F.concat(F.lit("PT"), (F.col("user_id") % 90).cast("string"), F.lit("M13S")))
    v = e.select("event_id", "event_type", T.iso_duration(F.col("t")).alias("seconds")).where("seconds between 240 and 1200")
    return v.withColumn("r", F.row_number().over(Window.partitionBy("event_type").orderBy("event_id"))).where("r <= 20").select("event_id", "seconds")


@query("f21_cagr", "select trend_id, round((pow(1 + expected_pct_y1 / 100, 1 / 3.0::double) - 1) * 100, 6) as cagr from trends where expected_pct_y1 > -100")
def f21(spark, d):
    return table(spark, d, "trends").where("expected_pct_y1 > -100").select("trend_id", F.round(S.cagr_pct(F.col("expected_pct_y1"), 3), 6).alias("cagr"))


@query("f22_above_market", "select trend_id, growth_score_y1 > (select median(growth_score_y1) from trends) as above_y1, growth_score_y3 > (select median(growth_score_y3) from trends) as above_y3 from trends")
def f22(spark, d):
    t = table(spark, d, "trends")
    m = t.agg(F.median("growth_score_y1").alias("m1"), F.median("growth_score_y3").alias("m3"))
    return t.crossJoin(F.broadcast(m)).select("trend_id", (F.col("growth_score_y1") > F.col("m1")).alias("above_y1"), (F.col("growth_score_y3") > F.col("m3")).alias("above_y3"))  # one row


@query("f23_growth_pages", "with r as (select trend_id, row_number() over (order by growth_score_y1 desc nulls last, trend_id) s, row_number() over (order by growth_score_y3 desc nulls last, trend_id) l from trends) select trend_id, s as short_rank, l as long_rank, s <= 10 and l <= 10 as on_both from r where s <= 10 or l <= 10")
def f23(spark, d):
    by = lambda c: F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.col(c).desc_nulls_last(), "trend_id"))
    t = table(spark, d, "trends").select("trend_id", by("growth_score_y1").alias("short_rank"), by("growth_score_y3").alias("long_rank")).where("short_rank <= 10 or long_rank <= 10")
    return t.withColumn("on_both", (F.col("short_rank") <= 10) & (F.col("long_rank") <= 10))


_ONSET = "case when count(*) over w3 = 3 then avg(value) over w3 end m"


_BOX = f"""{MONTHLY_SQL}, g as (select keyword, month, value, case when count(*) over a = 12 then avg(value) over a end l, case when count(*) over b = 12 then avg(value) over b end p, case when count(*) over f = 12 then avg(value) over f end nx
  from monthly window a as (partition by keyword order by month rows between 11 preceding and current row), b as (partition by keyword order by month rows between 23 preceding and 12 preceding), f as (partition by keyword order by month rows between 1 following and 12 following)),
pt as (select keyword, month, round((l + 1) / (p + 1), 6) r, round((nx + 1) / (l + 1), 6) f from g where month in (date '1998-06-01', date '1999-06-01', date '2000-06-01') and l is not null and p is not null and nx is not null)"""


def _points(spark, d):
    v = F.col("value")
    over = lambda a, b: S.rows("month", a, b, "keyword")
    x = monthly(spark, d).withColumns({"l": S.full(v, over(-11, 0), 12), "p": S.full(v, over(-23, -12), 12), "nx": S.full(v, over(1, 12), 12)})
    x = x.where(F.col("month").isin([F.lit(s).cast("date") for s in ("1998-06-01", "1999-06-01", "2000-06-01")]) & F.col("l").isNotNull() & F.col("p").isNotNull() & F.col("nx").isNotNull())
    return x.select("keyword", "month", F.round((F.col("l") + 1) / (F.col("p") + 1), 6).alias("r"), F.round((F.col("nx") + 1) / (F.col("l") + 1), 6).alias("f"))


@query("f26_growth_boxes", f"with {_BOX} select keyword, month, r as growth_ratio, case when r >= 1.05 then 'rising' else 'still' end as box from pt")
def f26(spark, d):
    return _points(spark, d).select("keyword", "month", F.col("r").alias("growth_ratio"), F.when(F.col("r") >= 1.05, "rising").otherwise("still").alias("box"))


@query("f27_hit_rates", f"with {_BOX}, h as (select line, case when r >= line then 'rising' else 'still' end as box, count(*) as n, avg((f >= 1.02)::int) as h from pt, (select unnest([1.0, 1.05, 1.1])::double line) group by all) select line, box, n, round(h, 6) as hit_rate, round(h - min(case when box = 'still' then h end) over (partition by line), 6) as difference from h")
def f27(spark, d):
    """How often what grew went on growing, by where the line is drawn, and the difference to what stood still."""
    grid = F.explode(F.array(*(F.lit(x) for x in (1.0, 1.05, 1.1)))).alias("line")
    p = _points(spark, d).select("r", "f", grid).withColumn("box", F.when(F.col("r") >= F.col("line"), "rising").otherwise("still"))
    h = p.groupBy("line", "box").agg(F.count(F.lit(1)).alias("n"), F.avg((F.col("f") >= 1.02).cast("int")).alias("h"))
    still = h.where("box = 'still'").select("line", F.col("h").alias("s"))
    return h.join(still, "line", "left").select("line", "box", "n", F.round("h", 6).alias("hit_rate"), F.round(F.col("h") - F.col("s"), 6).alias("difference"))


@query("g04_column_plan", f"with {LISTINGS_SQL}, k as (select trend, grp, sub, count(*) n, max(sim) b from lst where trend is not null and grp is not null and sub is not null group by all), c as (select trend, grp, sum(n) n, max(b) b, sum(n) / sum(sum(n)) over (partition by trend)::double sh from k group by trend, grp), u as (select k.trend, k.grp, k.sub shown, k.n, k.b from k join c on k.trend = c.trend and k.grp = c.grp where sh > .5 union all select trend, grp, null, n, b from c where sh <= .5), r as (select *, row_number() over (partition by trend order by n desc, b desc nulls last, grp, shown nulls first) place from u where n >= 2) select trend, grp, shown, n::bigint as n, place from r where place <= 4")
def g04(spark, d):
    k = listings(spark, d).where("trend is not null and grp is not null and sub is not null").groupBy("trend", "grp", "sub").agg(F.count(F.lit(1)).alias("n"), F.max("sim").alias("b"))
    return C.column_plan(k, "trend", "grp", "sub", "n", "b", 4, 2)


@query("i40_search_parameters", "select keyword_id, keyword || ' -site:a.invalid -site:b.invalid' as q, 'after:2024-01-01' as since from pmc_keywords")
def i40(spark, d):
    q = F.concat_ws(" ", "keyword", *(F.lit(f"-site:{s}.invalid") for s in "ab"))
    return table(spark, d, "pmc_keywords").select("keyword_id", q.alias("q"), F.lit("after:2024-01-01").alias("since"))


@query("i41_display_names", "select trend_id, replace(replace(trend_name, 'Skin Repair', 'Repairing Care'), 'Skin', 'Face') as shown from trends where trend_name is not null")
def i41(spark, d):
    return table(spark, d, "trends").where("trend_name is not null").select("trend_id", C.display_names(F.col("trend_name"), {"Skin": "Face", "Skin Repair": "Repairing Care"}).alias("shown"))


@query("i44_input_hash", "select p_partkey, sha256('{\"c0\":\"' || p_name || '\",\"c1\":' || p_size || '}') as digest from part")
def i44(spark, d):
    return table(spark, d, "part").select("p_partkey", T.input_hash(F.col("p_name"), F.col("p_size")).alias("digest"))


@query("b04_compact", "select p_partkey, case when p_size > 25 then '{\"a\":' || p_size || '}' else '{\"a\":' || p_size || ',\"b\":0}' end as j from part")
def b04(spark, d):
    return table(spark, d, "part").select("p_partkey", sinks.compact_json(F.col("p_size").alias("a"), F.when(F.col("p_size") <= 25, 0).alias("b")).alias("j"))


@query("b08_top_subset", "select l.l_orderkey, l.l_linenumber from lineitem l where l.l_partkey in (select p_partkey from part order by p_retailprice desc, p_partkey limit 10)")
def b08(spark, d):
    top = table(spark, d, "part").orderBy(F.col("p_retailprice").desc(), "p_partkey").limit(10).select(F.col("p_partkey").alias("l_partkey"))
    return table(spark, d, "lineitem").join(top, "l_partkey", "left_semi").select("l_orderkey", "l_linenumber")


@query("d02_left_join", "select p.keyword_id, count(t.series_id) as n from pmc_keywords p left join (select distinct series_id, keyword from pmc_timeseries) t on p.keyword = t.keyword group by 1")
def d02(spark, d):
    t = table(spark, d, "pmc_timeseries").select("series_id", "keyword").distinct().groupBy("keyword").agg(F.count(F.lit(1)).alias("n"))
    return table(spark, d, "pmc_keywords").join(t, "keyword", "left").select("keyword_id", F.coalesce("n", F.lit(0)).alias("n"))


@query("d11_value_at_offset", f"with {MONTHLY_SQL} select keyword, month, lag(value, 11) over w as back_11, lag(value, 23) over w as back_23 from monthly window w as (partition by keyword order by month)")
def d11(spark, d):
    w = Window.partitionBy("keyword").orderBy("month")
    return monthly(spark, d).select("keyword", "month", F.lag("value", 11).over(w).alias("back_11"), F.lag("value", 23).over(w).alias("back_23"))


@query("e01_keyword_month_mean", "select event_type as keyword, year(ts) * 12 + month(ts) - 1 as month_index, round(avg(value), 6) as value from events group by all")
def e01(spark, d):
    e = table(spark, d, "events").select(F.col("event_type").alias("keyword"), (F.year("ts") * 12 + F.month("ts") - 1).alias("month_index"), "value")
    return e.groupBy("keyword", "month_index").agg(F.round(F.avg("value"), 6).alias("value"))


@query("e02_model_means", "select p_type as cluster, p_brand as model, p_size % 2 as kind, round(avg(p_retailprice), 6) as z from part group by all")
def e02(spark, d):
    return table(spark, d, "part").groupBy(F.col("p_type").alias("cluster"), F.col("p_brand").alias("model"), (F.col("p_size") % 2).alias("kind")).agg(F.round(F.avg("p_retailprice"), 6).alias("z"))


@query("l06_reuse", "select p_partkey, case when p_size % 2 = 0 then 'kept ' || p_name end as text from part")
def l06(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.sha2("p_name", 256).alias("digest"), "p_name", "p_size")
    old = p.select("p_partkey", F.when(F.col("p_size") % 2 == 0, F.col("digest")).otherwise("stale").alias("digest"), F.concat(F.lit("kept "), "p_name").alias("text"))
    return C.reuse(p.select("p_partkey", "digest"), old, ["p_partkey"], "digest", "text").select("p_partkey", "text")


@query("l32_keyword_mapping", "with k as (select trend_name t, stream_name s, unnest(string_split(keywords, '; ')) keyword from trends where trend_name is not null) select keyword, string_agg(distinct t, ' | ' order by t) as trends from k group by 1")
def l32(spark, d):
    k = table(spark, d, "trends").where("trend_name is not null").select(F.col("trend_name").alias("t"), F.explode(F.split("keywords", "; ")).alias("keyword"))
    return k.groupBy("keyword").agg(F.array_join(F.array_sort(F.collect_set("t")), " | ").alias("trends"))


