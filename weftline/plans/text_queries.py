"""Queries of the text and evidence operators, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftline.functions import text as T
from weftline.operators import evidence as V
from weftline.operators.ranking import running, with_total
from weftline.plans.supply_queries import LISTINGS_SQL, listings
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


def docs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents")


@query("c03_parse_price", "select doc_id, try_cast(nullif(regexp_replace(regexp_extract(text, '฿[0-9,.]+'), '[^0-9.]', '', 'g'), '') as double) as price from documents where regexp_matches(text, '฿[0-9]')")
def c03(spark, d):
    return docs(spark, d).where(F.col("text").rlike("฿[0-9]")).select("doc_id", T.parse_price(F.regexp_extract("text", "฿[0-9,.]+", 0)).alias("price"))


@query("c05_brand_key", "select distinct listing_id, regexp_replace(lower(brand), '[^0-9a-z฀-๿]', '', 'g') as key from validate_at_scale_nvidia where brand is not null")
def c05(spark, d):
    return table(spark, d, "validate_at_scale_nvidia").where("brand is not null").select("listing_id", T.brand_key(F.col("brand")).alias("key")).distinct()


@query("c07_alias_lookup", "with k as (select distinct leader_brand v from export_llm_data where leader_brand is not null), a as (select upper(alias_text) al, min(brand_id) b from brand_aliases group by 1), n as (select upper(brand_name) nm, min(brand_id) b from brand_list group by 1) select v, coalesce(a.b, n.b, 0) as brand_id from k left join a on upper(v) = al left join n on upper(v) = nm")
def c07(spark, d):
    v = table(spark, d, "export_llm_data").select(F.col("leader_brand").alias("v")).where("v is not null").distinct()
    a = table(spark, d, "brand_aliases").groupBy(F.upper("alias_text").alias("u")).agg(F.min("brand_id").alias("a"))
    n = table(spark, d, "brand_list").groupBy(F.upper("brand_name").alias("u")).agg(F.min("brand_id").alias("n"))
    return v.withColumn("u", F.upper("v")).join(a, "u", "left").join(n, "u", "left").select("v", F.coalesce("a", "n", F.lit(0)).alias("brand_id"))


@query("c10_clean_terms", "with t as (select trend_id, unnest(string_split(keywords, ';')) k, generate_subscripts(string_split(keywords, ';'), 1) i from trends where keywords is not null), c as (select trend_id, trim(regexp_replace(lower(replace(k, ',', ' ')), '\\s+', ' ', 'g')) k, i from t), f as (select trend_id, k, min(i) i from c where k <> '' and len(string_split(k, ' ')) <= 4 group by all), r as (select *, row_number() over (partition by trend_id order by i) n from f) select trend_id, string_agg(k, '|' order by n) as terms from r where n <= 5 group by 1")
def c10(spark, d):
    t = table(spark, d, "trends").where("keywords is not null")
    return t.select("trend_id", F.array_join(T.clean_terms(F.split("keywords", ";"), 5), "|").alias("terms")).where("terms != ''")


@query("c11_singular", "select distinct trend_name, case when length(trim(lower(trend_name))) >= 4 and trim(lower(trend_name)) like '%s' and not regexp_matches(lower(trend_name), '(ss|us|is|ous)$') then left(trim(lower(trend_name)), length(trim(lower(trend_name))) - 1) else trim(lower(trend_name)) end as entity from trends")
def c11(spark, d):
    return table(spark, d, "trends").select("trend_name", T.singular(F.col("trend_name")).alias("entity")).distinct()


@query("c14_strip_thai", "select doc_id, trim(regexp_replace(regexp_replace(title, '[฀-๿]+', ' ', 'g'), '\\s+', ' ', 'g')) as title from documents where title is not null")
def c14(spark, d):
    return docs(spark, d).where("title is not null").select("doc_id", T.strip_thai(F.col("title")).alias("title"))


@query("c15_clean_url", "with q as (select doc_id, link, array_to_string(list_filter(string_split(regexp_extract(link, '\\?([^#]*)', 1), '&'), lambda p: p <> '' and not starts_with(p, 'utm_')), '&') q from documents where link is not null) select doc_id, regexp_replace(link, '[?#].*$', '') || case when q <> '' then '?' || q else '' end as url, regexp_replace(lower(regexp_extract(link, '^[a-z]+://([^/?#:]+)', 1)), '^www\\.', '') as domain from q")
def c15(spark, d):
    return docs(spark, d).where("link is not null").select("doc_id", T.clean_url(F.col("link")).alias("url"), T.domain(F.col("link")).alias("domain"))


@query("c16_junk", "select doc_id, coalesce(regexp_matches(text, '(?i)(https?:|www\\.|\\.com\\b|^com\\.[a-z]+\\.|\\.apk\\b)'), false) as junk from documents")
def c16(spark, d):
    return docs(spark, d).select("doc_id", T.is_junk(F.col("text")).alias("junk"))


@query("c17_rewrite", "select trend_id, regexp_replace(regexp_replace(trend_name, 'Skin', 'skin care', 'g'), 'Tints?', 'tinted balm', 'g') as plain from trends where trend_name is not null")
def c17(spark, d):
    return table(spark, d, "trends").where("trend_name is not null").select("trend_id", T.rewrite(F.col("trend_name"), [("Skin", "skin care"), ("Tints?", "tinted balm")]).alias("plain"))


@query("c18_banned", "select doc_id, array_to_string(list_distinct(regexp_extract_all(lower(text), '\\b(really|amazing|robust|resilient)\\b', 1)).list_sort(), '|') as found from documents where regexp_matches(lower(text), '\\b(really|amazing|robust|resilient)\\b')")
def c18(spark, d):
    f = T.banned_words(F.col("text"), ["really", "amazing", "robust", "resilient"])
    return docs(spark, d).where(F.size(f) > 0).select("doc_id", F.array_join(F.array_sort(f), "|").alias("found"))


@query("c22_slug", "with s as (select trend_id, regexp_replace(regexp_replace(lower(trim(display_name)), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') s from trends where display_name is not null) select trend_id, case when row_number() over (partition by s order by trend_id) = 1 then s else s || '-' || row_number() over (partition by s order by trend_id) end as slug from s")
def c22(spark, d):
    x = table(spark, d, "trends").where("display_name is not null").select("trend_id", T.slug(F.col("display_name")).alias("s"))
    r = F.row_number().over(Window.partitionBy("s").orderBy("trend_id"))
    return x.select("trend_id", F.when(r == 1, F.col("s")).otherwise(F.concat_ws("-", "s", r.cast("string"))).alias("slug"))


@query("c24_minimum_evidence", "select source, count(*) as n_docs, count(distinct matched_keyword) as n_keywords, count(*) >= 5 and count(distinct matched_keyword) >= 1 as enough from documents group by 1")
def c24(spark, d):
    g = docs(spark, d).groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.countDistinct("matched_keyword").alias("n_keywords"))
    return g.withColumn("enough", (F.col("n_docs") >= 5) & (F.col("n_keywords") >= 1))


@query("c25_candidates", f"with {LISTINGS_SQL} select id from lst where not coalesce(grp is null and sub is null, false)")
def c25(spark, d):
    return listings(spark, d).where(~(F.col("grp").isNull() & F.col("sub").isNull())).select("id")


@query("d06_merge_catalogues", """with l as (select distinct listing_id id, seller, regexp_replace(lower(brand), '[^0-9a-z฀-๿]', '', 'g') b, list_sort(list_distinct(regexp_extract_all(lower(product_name), '[a-z0-9฀-๿]+'))) t, pack_size s, unit_label u, sale_price_thb p from validate_at_scale_nvidia),
pr as (select r.id right_id, min(k.id) left_id from l k join l r on k.b = r.b and k.t = r.t and k.s = r.s and k.u = r.u where k.seller = 'Konvia' and r.seller <> 'Konvia' and coalesce(not (k.p > 0 and r.p > 0) or greatest(k.p, r.p) / least(k.p, r.p) <= 3, true) group by 1) select left_id, right_id from pr""")
def d06(spark, d):
    x = table(spark, d, "validate_at_scale_nvidia").select(F.col("listing_id").alias("id"), "seller", T.brand_key(F.col("brand")).alias("b"), T.tokens(F.col("product_name")).alias("t"), F.col("pack_size").alias("s"), F.col("unit_label").alias("u"), F.col("sale_price_thb").alias("p")).distinct()
    return V.merge_catalogues(x.where("seller = 'Konvia'"), x.where("seller != 'Konvia'"), ["b", "t", "s", "u"], "id", "p")[1].select("left_id", "right_id")


@query("d14_mentions", "with t as (select doc_id, ' ' || trim(regexp_replace(lower(title), '[^\\p{L}\\p{M}\\p{N}_]+', ' ', 'g')) || ' ' t from documents where title is not null), n as (select brand_id, ' ' || trim(regexp_replace(lower(brand_name), '[^\\p{L}\\p{M}\\p{N}_]+', ' ', 'g')) || ' ' b from brand_list) select doc_id, brand_id from t join n on contains(t, b)")
def d14(spark, d):
    return V.mentions(docs(spark, d).where("title is not null"), "title", table(spark, d, "brand_list"), "brand_id", "brand_name", "doc_id")


@query("d13_text_in_document", "select doc_id, length(trim(title)) >= 12 and contains(trim(regexp_replace(lower(coalesce(text, '')), '\\s+', ' ', 'g')), trim(regexp_replace(lower(title), '\\s+', ' ', 'g'))) as found from documents where title is not null")
def d13(spark, d):
    return docs(spark, d).where("title is not null").select("doc_id", V.fragments_in(F.col("title"), F.col("text")).alias("found"))


@query("d15_resolve_brand", "with w as (select distinct upper(brand) b from validate_at_scale_nvidia where brand is not null) select b, brand_id from w left join brand_list on upper(brand_name) = b")
def d15(spark, d):
    w = table(spark, d, "validate_at_scale_nvidia").where("brand is not null").select(F.upper("brand").alias("b")).distinct()
    return w.join(table(spark, d, "brand_list").select("brand_id", F.upper("brand_name").alias("b")), "b", "left")


@query("d05_composite_lookup", "select p.p_partkey, coalesce(m.n, 0) as n from part p left join (select l_partkey, count(*) n from lineitem where l_returnflag = 'R' group by 1) m on p.p_partkey = m.l_partkey")
def d05(spark, d):
    m = table(spark, d, "lineitem").where("l_returnflag = 'R'").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count(F.lit(1)).alias("n"))
    return table(spark, d, "part").select("p_partkey").join(m, "p_partkey", "left").withColumn("n", F.coalesce("n", F.lit(0)))


@query("d03_nominal_real", "select p_brand, year(l_shipdate) as year, round(sum(l_extendedprice), 4) as nominal, round(sum(l_extendedprice * (1 - l_discount)), 4) as real from lineitem join part on l_partkey = p_partkey group by all")
def d03(spark, d):
    p = table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    li = table(spark, d, "lineitem").groupBy("l_partkey", F.year("l_shipdate").alias("year")).agg(F.sum("l_extendedprice").alias("a"), F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("b"))
    return li.join(p, "l_partkey").groupBy("p_brand", "year").agg(F.round(F.sum("a"), 4).alias("nominal"), F.round(F.sum("b"), 4).alias("real"))


@query("d04_rmse", "with f as (select c_custkey, c_nationkey, c_acctbal f, avg(c_acctbal) over (partition by c_nationkey) a from customer) select c_nationkey, round(sqrt(avg((f - a) ** 2)), 4) as rmse from f group by 1")
def d04(spark, d):
    c = table(spark, d, "customer").withColumn("a", F.avg("c_acctbal").over(Window.partitionBy("c_nationkey")))
    return c.groupBy("c_nationkey").agg(F.round(F.sqrt(F.avg(F.pow(F.col("c_acctbal") - F.col("a"), 2))), 4).alias("rmse"))


@query("d07_anti_semi", "select o_custkey, count(*) as n from orders where o_custkey in (select c_custkey from customer where c_mktsegment = 'MACHINERY') and o_custkey not in (select c_custkey from customer where c_acctbal < 0) group by 1")
def d07(spark, d):
    c = table(spark, d, "customer").withColumnRenamed("c_custkey", "o_custkey")
    o = table(spark, d, "orders").join(c.where("c_mktsegment = 'MACHINERY'"), "o_custkey", "left_semi").join(c.where("c_acctbal < 0"), "o_custkey", "left_anti")
    return o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))


@query("d09_cluster_jaccard", "with s as (select p_type k, list(distinct p_name) s from part group by 1), t as (select p_brand k, list(distinct p_name) s from part group by 1), j as (select s.k a, t.k b, len(list_intersect(s.s, t.s)) / len(list_distinct(list_concat(s.s, t.s)))::double j from s, t) select a, first(b order by round(j, 9) desc, b) as b, round(max(j), 6) as best from j group by 1")
def d09(spark, d):
    """The cluster each one shares most with, found through shared members; who shares none gets the first at 0."""
    p = table(spark, d, "part")
    sets = lambda c, n: p.select(F.col(c).alias(n), "p_name").distinct()
    left, right = sets("p_type", "a"), sets("p_brand", "b")
    size = lambda x, n: x.groupBy(n).agg(F.count(F.lit(1)).alias(f"n_{n}"))
    both = left.join(right, "p_name").groupBy("a", "b").agg(F.count(F.lit(1)).alias("i"))
    j = both.join(size(left, "a"), "a").join(size(right, "b"), "b").withColumn("j", F.col("i") / (F.col("n_a") + F.col("n_b") - F.col("i")))
    best = j.groupBy("a").agg(F.min_by("b", F.struct(-F.round("j", 9), F.col("b"))).alias("b"), F.round(F.max("j"), 6).alias("best"))
    first = right.agg(F.min("b").alias("first"))
    return left.select("a").distinct().join(best, "a", "left").crossJoin(F.broadcast(first)).select("a", F.coalesce("b", "first").alias("b"), F.coalesce("best", F.lit(0.0)).alias("best"))  # one row


@query("d18_catalogue_index", "with i as (select p_brand, p_name, min(p_partkey) k from part group by all) select l.l_orderkey, l.l_linenumber, i.k as first_partkey from lineitem l join part p on l.l_partkey = p.p_partkey left join i on i.p_brand = p.p_brand and i.p_name = p.p_name")
def d18(spark, d):
    p = table(spark, d, "part")
    i = V.first_by(p, ["p_brand", "p_name"], ["p_partkey"]).select("p_brand", "p_name", F.col("p_partkey").alias("first_partkey"))
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("p_partkey"))
    return li.join(p.select("p_partkey", "p_brand", "p_name"), "p_partkey").join(i, ["p_brand", "p_name"], "left").select("l_orderkey", "l_linenumber", "first_partkey")


@query("d19_round_robin", "with l as (select doc_id, link, source, row_number() over (partition by source order by doc_id) p, dense_rank() over (order by source) n from documents where source is not null and link is not null), f as (select * from l qualify row_number() over (partition by link order by p, n) = 1) select doc_id, row_number() over (order by p, n) as place from f")
def d19(spark, d):
    x = docs(spark, d).where("source is not null and link is not null").select("doc_id", "link", "source")
    n = x.select("source").distinct().withColumn("n", F.dense_rank().over(Window.partitionBy(F.lit(0)).orderBy("source")))
    x = running(x, ["source"], ["doc_id"], None, "p").join(n, "source")
    return V.round_robin(x, "n", "p", "link").select("doc_id", "place")


@query("f34_budget", "with l as (select l_orderkey k, l_linenumber p, l_returnflag || '-' || l_linestatus || '-' || l_linenumber t from lineitem), u as (select *, sum(length(t) + 1) over (partition by k order by p, t rows unbounded preceding) u from l) select k, p from u where u <= 20")
def f34(spark, d):
    x = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("p"), F.concat_ws("-", "l_returnflag", "l_linestatus", F.col("l_linenumber").cast("string")).alias("t"))
    return V.excerpt(x, "k", "p", "t", 20).select("k", "p")


@query("f35_citations", "with f as (select l_orderkey k, l_suppkey % 5 item, min(l_linenumber) p from lineitem group by all) select k, item, row_number() over (partition by k order by p, item) as number from f")
def f35(spark, d):
    x = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), (F.col("l_suppkey") % 5).alias("item"), F.col("l_linenumber").alias("p"))
    return V.number_by_first_use(x, "k", "item", "p")


@query("f28_auc", "with r as (select event_type, value, (user_id % 2)::int y, rank() over (partition by event_type order by value) + (count(*) over (partition by event_type, value) - 1) / 2.0::double rk from events) select event_type, round((sum(rk) filter (y = 1) - sum(y) * (sum(y) + 1) / 2.0::double) / nullif(sum(y) * sum(1 - y), 0)::double, 6) as auc from r group by 1")
def f28(spark, d):
    return V.auc(table(spark, d, "events").withColumn("y", F.col("user_id") % 2 == 1), ["event_type"], "value", "y")


@query("h01_union_catalogues", "select 'a-' || p_partkey as id, p_name as name, p_retailprice as price, null::double as acctbal from part union all select 'b-' || s_suppkey, s_name, null, s_acctbal from supplier")
def h01(spark, d):
    a = table(spark, d, "part").select(F.concat(F.lit("a-"), F.col("p_partkey").cast("string")).alias("id"), F.col("p_name").alias("name"), F.col("p_retailprice").alias("price"))
    b = table(spark, d, "supplier").select(F.concat(F.lit("b-"), F.col("s_suppkey").cast("string")).alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("acctbal"))
    return a.unionByName(b, allowMissingColumns=True)


@query("h04_except_keywords", "select distinct lower(matched_keyword) as keyword from documents where matched_keyword is not null except select lower(keyword) from pmc_keywords")
def h04(spark, d):
    return docs(spark, d).where("matched_keyword is not null").select(F.lower("matched_keyword").alias("keyword")).subtract(table(spark, d, "pmc_keywords").select(F.lower("keyword")))


@query("h05_jaccard", "with t as (select trend_id, list_filter(list_distinct(regexp_extract_all(lower(coalesce(trend_name, '')), '[a-z0-9฀-๿]+')), lambda w: w <> 'care') a, list_filter(list_distinct(regexp_extract_all(lower(coalesce(keywords, '')), '[a-z0-9฀-๿]+')), lambda w: w <> 'care') b from trends) select trend_id, round(case when len(a) = 0 or len(b) = 0 then 0 else len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b)))::double end, 6) as jaccard from t")
def h05(spark, d):
    t = lambda c: T.tokens(F.col(c), ["care"])
    return table(spark, d, "trends").select("trend_id", F.round(T.jaccard(t("trend_name"), t("keywords")), 6).alias("jaccard"))


@query("g07_detail_set", "with a as (select trend_id from trends where above_market_line = 1), b as (select trend_id from trends order by growth_score_y1 desc nulls last, trend_id limit 5), c as (select trend_id from trends order by growth_score_y3 desc nulls last, trend_id limit 5) select trend_id from a union select trend_id from b union select trend_id from c")
def g07(spark, d):
    t = table(spark, d, "trends")
    best = lambda c: t.orderBy(F.col(c).desc_nulls_last(), "trend_id").limit(5).select("trend_id")
    return t.where("above_market_line = 1").select("trend_id").union(best("growth_score_y1")).union(best("growth_score_y3")).distinct()


@query("g14_preselect", "with n as (select doc_id, title, count(*) over () n from documents where source = 'news'), f as (select * from n where n <= 30 or regexp_matches(lower(coalesce(title, '')), 'skin|hair|lip')) select doc_id from f order by doc_id limit 30")
def g14(spark, d):
    n = docs(spark, d).where("source = 'news'").select("doc_id", "title")
    n = with_total(n, [], "n")
    return n.where((F.col("n") <= 30) | F.lower(F.coalesce("title", F.lit(""))).rlike("skin|hair|lip")).select("doc_id").orderBy("doc_id").limit(30)


@query("i18_keyword_match", "with w as (select doc_id, lower(coalesce(title, '') || ' ' || coalesce(text, '')) t, list_distinct(regexp_extract_all(lower(matched_keyword), '[a-z0-9฀-๿]+')) k from documents where matched_keyword is not null), u as (select doc_id, t, unnest(k) w from w) select doc_id, round(avg(contains(t, w)::int), 3) as match from u group by 1")
def i18(spark, d):
    x = docs(spark, d).where("matched_keyword is not null")
    s = T.word_match(F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("text", F.lit(""))), F.col("matched_keyword"))
    return x.where(F.size(T.tokens(F.col("matched_keyword"))) > 0).select("doc_id", s.alias("match"))


@query("i23_signal", "select trend_id, case when expected_pct_y1 is null or abs(expected_pct_y1) > 20 then 'Monitor' when expected_pct_y1 > 0.2 then 'Invest Now' when expected_pct_y1 < -0.2 then 'Wait' else 'Monitor' end as signal from trends")
def i23(spark, d):
    return table(spark, d, "trends").select("trend_id", V.investment_signal(F.col("expected_pct_y1")).alias("signal"))


@query("i35_midpoint", "select o_custkey, (min(o_orderdate)::date + (date_diff('day', min(o_orderdate), max(o_orderdate)) // 2)::int)::date as middle from orders group by 1")
def i35(spark, d):
    g = table(spark, d, "orders").groupBy("o_custkey").agg(F.min(F.to_date("o_orderdate")).alias("a"), F.max(F.to_date("o_orderdate")).alias("b"))
    return g.select("o_custkey", T.midpoint(F.col("a"), F.col("b")).alias("middle"))


@query("i43_token_budget", "select doc_id, greatest(256, ceil(length(text) / 4.0::double))::int as budget from documents where text is not null")
def i43(spark, d):
    return docs(spark, d).where("text is not null").select("doc_id", T.token_budget(F.col("text")).alias("budget"))


@query("i47_clean_query", "select trend_id, trim(regexp_replace(lower(coalesce(trend_name, '')), '\\s+', ' ', 'g')) as query from trends")
def i47(spark, d):
    return table(spark, d, "trends").select("trend_id", T.glued_thai(F.col("trend_name")).alias("query"))


@query("l33_complete_paths", "select trend_id, growth_score_y1 is not null and growth_score_y3 is not null and expected_pct_y1 is not null as complete from trends")
def l33(spark, d):
    parts = F.array("growth_score_y1", "growth_score_y3", "expected_pct_y1")
    return table(spark, d, "trends").select("trend_id", F.forall(parts, lambda x: x.isNotNull()).alias("complete"))


@query("k12_trend_export", "select t.trend_id, t.trend_name, t.main_category, count(distinct e.export_id) as n_exports, count(distinct e.customer) as n_customers from trends t left join export_llm_data e on e.trend_id = t.trend_id group by all")
def k12(spark, d):
    e = table(spark, d, "export_llm_data").select("trend_id", "export_id", "customer")
    n = e.groupBy("trend_id").agg(F.countDistinct("export_id").alias("n_exports"), F.countDistinct("customer").alias("n_customers"))
    return table(spark, d, "trends").select("trend_id", "trend_name", "main_category").join(n, "trend_id", "left").fillna(0, ["n_exports", "n_customers"])


@query("k09_customer_quadrants", "with x as (select distinct export_id, customer, quadrant, fit_level, own_rank_in_category r from export_llm_data where customer is not null) select customer, count(*) as n, sum((quadrant = 'defend')::int)::bigint as defend, sum((quadrant = 'build')::int)::bigint as build, min(r) as best_rank from x group by 1")
def k09(spark, d):
    x = table(spark, d, "export_llm_data").select("export_id", "customer", "quadrant", "fit_level", F.col("own_rank_in_category").alias("r")).where("customer is not null").distinct()
    n = lambda q: F.sum((F.col("quadrant") == q).cast("int"))
    return x.groupBy("customer").agg(F.count(F.lit(1)).alias("n"), n("defend").alias("defend"), n("build").alias("build"), F.min("r").alias("best_rank"))


@query("k15_trend_categories", f"with {LISTINGS_SQL}, c as (select trend, grp, count(*) n from lst where trend is not null and grp is not null group by all), r as (select *, row_number() over (partition by trend order by n desc, grp) k from c) select trend, string_agg(grp || ' ' || n, ', ' order by k) as categories from r where k <= 3 group by 1")
def k15(spark, d):
    c = listings(spark, d).where("trend is not null and grp is not null").groupBy("trend", "grp").agg(F.count(F.lit(1)).alias("n"))
    c = c.withColumn("k", F.row_number().over(Window.partitionBy("trend").orderBy(F.desc("n"), "grp"))).where("k <= 3")
    texts = F.transform(F.array_sort(F.collect_list(F.struct("k", F.concat_ws(" ", "grp", F.col("n").cast("string")).alias("t")))), lambda s: s["t"])
    return c.groupBy("trend").agg(F.array_join(texts, ", ").alias("categories"))
