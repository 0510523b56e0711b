"""Queries of report assembly, runs, lookups and backtests, with their SQL."""

from __future__ import annotations

from pyspark.sql import SparkSession, Window
from pyspark.sql import functions as F

from weftline.operators import assembly as A
from weftline.operators import gates as G
from weftline.operators import supply as U
from weftline.operators.evidence import numbers_supported, quotes_supported
from weftline.plans.run_queries import place
from weftline.plans.supply_queries import LISTINGS_SQL, listings
from weftline.sources import sinks
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


def docs(spark: SparkSession, d: str):
    return table(spark, d, "documents")


# -- vectors and backfills -----------------------------------------------------------------


@query("j11_score_list", f"with {LISTINGS_SQL} select trend, id, grp as category, sub as subgroup, round(sim, 4) as similarity, price, sold from lst where trend is not null and sim is not null")
def j11(spark, d):
    """Every product's score for a trend with what a report shows of it; sold counts that are missing stay null."""
    return listings(spark, d).where("trend is not null and sim is not null").select("trend", "id", F.col("grp").alias("category"), F.col("sub").alias("subgroup"), F.round("sim", 4).alias("similarity"), "price", "sold")


_TOP = "select trend, id, row_number() over (partition by trend order by sim desc nulls last, id) r from lst where trend is not null"


@query("j12_backfill_check", f"with {LISTINGS_SQL}, a as ({_TOP} and scored < timestamp '2026-01-01'), b as ({_TOP}) select trend, x.id as stored_item, y.id as fresh_item, x.id is not distinct from y.id as same from (select * from a where r = 1) x full join (select * from b where r = 1) y using (trend)")
def j12(spark, d):
    """First places of stored scores against those recomputed on all of them."""
    x = listings(spark, d).where("trend is not null")
    stored = U.top_per_group(x.where("scored < timestamp_ntz'2026-01-01 00:00:00'"), ["trend"], "sim", "id", 1)
    return A.backfill(stored, U.top_per_group(x, ["trend"], "sim", "id", 1), "trend", "rank", "id")


@query("j13_retry_batch", "with w as (select distinct listing_id from validate_at_scale_nvidia where subgroup is null), a as (select listing_id, count(*)::int n, max((brand is not null and seller = 'x')::int) ok from validate_at_scale_nvidia where product_group is null group by 1) select listing_id, coalesce(n, 0) + 1 as round from w left join a using (listing_id) where coalesce(ok, 0) = 0 and coalesce(n, 0) < 3")
def j13(spark, d):
    """What is still to be classified: rows without an accepted answer, each asked at most three times."""
    v = table(spark, d, "validate_at_scale_nvidia")
    tries = v.where("product_group is null").groupBy("listing_id").agg(F.count(F.lit(1)).cast("int").alias("round"), F.max(F.coalesce(F.col("brand").isNotNull() & (F.col("seller") == "x"), F.lit(False))).alias("accepted"))
    return G.retry(v.where("subgroup is null").select("listing_id").distinct(), tries, "listing_id", "round")


@query("l27_bullets", "with b as (select trend_id, unnest(string_split(keywords, '; ')) t from trends where keywords is not null) select sha256(trim(t)) as digest, min(trim(t)) as bullet, count(*)::bigint as n_uses from b where trim(t) <> '' group by 1")
def l27(spark, d):
    """Bullets to embed: each text once, by its digest, whoever uses it."""
    b = table(spark, d, "trends").where("keywords is not null").select(F.explode(F.split("keywords", "; ")).alias("t")).select(F.trim("t").alias("t")).where("t != ''")
    return b.groupBy(F.sha2("t", 256).alias("digest")).agg(F.min("t").alias("bullet"), F.count(F.lit(1)).alias("n_uses"))


# -- search stream -------------------------------------------------------------------------

_TALK = "select source as category, lower(matched_keyword) as q, case when source_region = 'TH' then 'th' else 'ww' end as place, matched_keyword in (select unnest(string_split(keywords, '; ')) from trends) as fed from documents where source is not null and matched_keyword is not null"


@query("k14_search_talk", f"with x as ({_TALK}), g as (select category, q, count(distinct place) n, min(place) p, max(fed::int) f from x group by 1, 2) select category, count(*) as n, sum((n = 1 and p = 'th')::int)::bigint as th, sum((n = 1 and p = 'ww')::int)::bigint as ww, sum((n > 1)::int)::bigint as both, sum(f)::bigint as fed from g group by 1")
def k14(spark, d):
    fed = table(spark, d, "trends").where("keywords is not null").select(F.explode(F.split("keywords", "; ")).alias("matched_keyword")).distinct().withColumn("fed", F.lit(True))
    x = docs(spark, d).where("source is not null and matched_keyword is not null").join(fed, "matched_keyword", "left")
    x = x.select(F.col("source").alias("category"), F.lower("matched_keyword").alias("q"), F.when(F.col("source_region") == "TH", "th").otherwise("ww").alias("place"), F.coalesce("fed", F.lit(False)).alias("fed"))
    return A.search_talk(x, "category", "q", "place", "fed")


@query("k14_category_dive", f"with x as ({_TALK}), g as (select category, q, count(*) n from x group by 1, 2), r as (select *, row_number() over (partition by category order by n desc, q) k from g) select category, k::int as place, ((k - 1) // 2)::int as page, q as query, n from r where k <= 8")
def k14_dive(spark, d):
    """A category's eight searches of most documents, two a page."""
    g = docs(spark, d).where("source is not null and matched_keyword is not null").groupBy(F.col("source").alias("category"), F.lower("matched_keyword").alias("query")).agg(F.count(F.lit(1)).alias("n"))
    k = F.row_number().over(Window.partitionBy("category").orderBy(F.desc("n"), "query"))
    return g.withColumn("place", k).where("place <= 8").withColumn("page", F.floor((F.col("place") - 1) / 2).cast("int"))


@query("k19_fetch_plan", "with l as (select source, link, row_number() over (partition by source order by doc_id) p from documents where source is not null and link is not null), o as (select link, min(p) p from l group by 1), c as (select distinct link from documents where lang = 'en' and link is not null) select o.link, p as place, c.link is not null as cached from o left join c using (link) where p <= 200")
def k19(spark, d):
    """Pages to fetch for all questions: merged in turns, each address once, the first 200 turns, and which the cache holds."""
    x = docs(spark, d).where("source is not null and link is not null")
    p = U.running(x, ["source"], ["doc_id"], None, "p").groupBy("link").agg(F.min("p").alias("place")).where("place <= 200")
    have = docs(spark, d).where("lang = 'en' and link is not null").select("link").distinct().withColumn("cached", F.lit(True))
    return p.join(have, "link", "left").withColumn("cached", F.coalesce("cached", F.lit(False)))


@query("l17_synthesis_status", "with q as (select trend_id, sha256(coalesce(keywords, '')) g from trends), c as (select trend_id, sha256(coalesce(keywords, '')) c from trends where stream_name = 'Paper'), p as (select t.trend_id, count(*) n from trends t join documents d on d.matched_keyword = t.trend_name group by 1) select q.trend_id, case when c = g then 'cached' when coalesce(n, 0) = 0 then 'no evidence' else 'ask' end as status from q left join c using (trend_id) left join p using (trend_id)")
def l17(spark, d):
    t = table(spark, d, "trends")
    digest = F.sha2(F.coalesce("keywords", F.lit("")), 256).alias("digest")
    passages = t.select("trend_id", F.col("trend_name").alias("matched_keyword")).join(docs(spark, d).select("matched_keyword"), "matched_keyword")
    return A.synthesis_status(t.select("trend_id", digest), t.where("stream_name = 'Paper'").select("trend_id", digest), passages, "trend_id", "digest")


_SAID = "list_transform(regexp_extract_all({}, '([0-9][0-9,.]*%?)'), lambda x: regexp_replace(x, '[.,]+$', ''))"


@query("l18_rejected_topics", f"with t as (select export_id, {_SAID.format('own_product')} a, list_transform({_SAID.format('own_reason_en')}, lambda x: regexp_replace(x, '%$', '')) b from (select distinct export_id, own_product, own_reason_en from export_llm_data) where own_product is not null and own_reason_en is not null and not contains(own_product, chr(39))) select export_id from t where len(list_filter(a, lambda x: (length(regexp_replace(x, '[^0-9]', '', 'g')) >= 2 or x[-1] = '%') and not list_contains(b, regexp_replace(x, '%$', '')))) > 0")
def l18(spark, d):
    """Topics to ask again: those whose numbers or quotes don't stand in their evidence."""
    x = table(spark, d, "export_llm_data").where("own_product is not null and own_reason_en is not null").where(~F.contains("own_product", F.lit("'"))).select("export_id", "own_product", "own_reason_en").distinct()
    return x.where(~(numbers_supported(F.col("own_product"), F.col("own_reason_en")) & quotes_supported(F.col("own_product"), F.col("own_reason_en")))).select("export_id")


@query("l21_query_terms", "select keyword_id, '(\"' || replace(lower(trim(keyword)), '\"', '') || '\"[Title/Abstract]) AND (\"2024/01/01\"[dp] : \"2025/12/31\"[dp])' as term, (keyword_id // 20)::bigint as batch from pmc_keywords")
def l21(spark, d):
    """Search terms of the literature source, in batches."""
    k = table(spark, d, "pmc_keywords")
    term = F.concat(F.lit('("'), F.replace(F.lower(F.trim("keyword")), F.lit('"'), F.lit("")), F.lit('"[Title/Abstract]) AND ("2024/01/01"[dp] : "2025/12/31"[dp])'))
    return k.select("keyword_id", term.alias("term"), F.floor(F.col("keyword_id") / 20).alias("batch"))


@query("l22_news_pool", "with n as (select doc_id, link, matched_keyword k, regexp_extract(published_at, '(20[0-9]{2})', 1) y, row_number() over (partition by outlet order by doc_id) r from documents where source = 'news' and link is not null), p as (select link, doc_id, case when r <= 15 then 'feed' else 'query' end how from n where r <= 15 or (k is not null and y in ('2024', '2025', '2026'))) select link, arg_min(how, (how <> 'feed')::int * 1000000000 + doc_id) as how, count(*)::bigint as n from p group by 1")
def l22(spark, d):
    """The news pool: the first fifteen of each feed and what the dated queries find, each link once, feeds first."""
    r = F.row_number().over(Window.partitionBy("outlet").orderBy("doc_id"))
    n = docs(spark, d).where("source = 'news' and link is not null").select("doc_id", "link", "matched_keyword", F.regexp_extract("published_at", "(20[0-9]{2})", 1).alias("y"), r.alias("r"))
    p = n.where("r <= 15 or (matched_keyword is not null and y in ('2024', '2025', '2026'))").withColumn("how", F.when(F.col("r") <= 15, "feed").otherwise("query"))
    return p.groupBy("link").agg(F.min_by("how", F.struct(F.col("how") != "feed", "doc_id")).alias("how"), F.count(F.lit(1)).alias("n"))


@query("l23_reviewed", "with r as (select trend_id, row_number() over (order by growth_score_y1 desc nulls last, trend_id) k from trends) select trend_id, k::int as rank from r where k <= 120 and trend_id not in (select trend_id from trends where main_category is null)")
def l23(spark, d):
    """Candidates written with a flag for the first 120, reviewed by striking those without a category, read again."""
    path = place(spark, "l23_candidates")
    t = table(spark, d, "trends")
    r = U.running(t, [], [F.col("growth_score_y1").desc_nulls_last(), "trend_id"], None, "rank")
    sinks.write_csv(r.select(F.when((F.col("rank") <= 120) & F.col("main_category").isNotNull(), 1).otherwise(0).alias("keep"), "rank", "trend_id"), path, ["keep", "rank", "trend_id"])
    return spark.read.option("header", True).csv(path).where("keep not in ('', '0')").select("trend_id", F.col("rank").cast("int").alias("rank"))


@query("l25_runs", "select run_id, max(exported_at)::date as newest, 'Run ' || run_id as label from export_llm_data group by 1 having count(distinct quadrant) >= 2 and count(own_reason_en) > 0")
def l25(spark, d):
    """Runs that have all the parts a report needs, with their newest day."""
    e = table(spark, d, "export_llm_data").groupBy("run_id").agg(F.to_date(F.max("exported_at")).alias("newest"), F.countDistinct("quadrant").alias("q"), F.count("own_reason_en").alias("n"))
    return e.where("q >= 2 and n > 0").select("run_id", "newest", F.concat(F.lit("Run "), "run_id").alias("label"))


@query("l28_category_keys", "select distinct category, trim(regexp_replace(lower(category), '[^a-z0-9]+', '_', 'g'), '_') as key from (select product_group category from validate_at_scale_nvidia union select subgroup from validate_at_scale_nvidia) where category is not null")
def l28(spark, d):
    v = table(spark, d, "validate_at_scale_nvidia")
    c = v.select(F.col("product_group").alias("category")).union(v.select("subgroup")).where("category is not null").distinct()
    return c.select("category", F.regexp_replace(F.regexp_replace(F.lower("category"), "[^a-z0-9]+", "_"), "^_+|_+$", "").alias("key"))


# -- brand coverage ------------------------------------------------------------------------


@query("l08_trend_grade", f"with {LISTINGS_SQL}, b as (select trend, grp, brand, max(sim) s from lst where trend is not null and brand is not null and grp is not null and sim is not null group by 1, 2, 3) select brand, trend, arg_max(grp, s * 1000 - ascii(grp) / 1000.0::double - ascii(substr(grp, 2)) / 1000000.0::double - ascii(substr(grp, 6)) / 100000000.0::double) as category, case when max(s) >= 0.8 then 'top' when max(s) >= 0.5 then 'fair' else 'below_average' end as level from b group by 1, 2")
def l08(spark, d):
    """A brand's grade in a trend by its best category."""
    b = listings(spark, d).where("trend is not null and brand is not null and grp is not null and sim is not null").groupBy("trend", "grp", "brand").agg(F.max("sim").alias("s"))
    g = b.groupBy("brand", "trend").agg(F.max_by("grp", F.col("s") * 1000 - F.ascii("grp") / 1000 - F.ascii(F.substring("grp", 2, 1)) / 1e6 - F.ascii(F.substring("grp", 6, 1)) / 1e8).alias("category"), F.max("s").alias("m"))
    return g.select("brand", "trend", "category", F.when(F.col("m") >= 0.8, "top").when(F.col("m") >= 0.5, "fair").otherwise("below_average").alias("level"))


@query("l08_price_labels", f"with {LISTINGS_SQL} select grp, unit_tier_label as tier, case when min(p) = max(p) then unit_tier_label || ' ' || round(min(p))::bigint || ' baht' else unit_tier_label || ' ' || round(min(p))::bigint || '-' || round(max(p))::bigint || ' baht' end as label from (select product_group grp, case unit_tier when 1 then 'low' when 2 then 'mid' when 3 then 'high' else 'all' end unit_tier_label, floor(sale_price_thb) p from validate_at_scale_nvidia where sale_price_thb is not null and product_group is not null) group by 1, 2")
def l08_labels(spark, d):
    """Labels of price groups with their span, or the one price."""
    v = table(spark, d, "validate_at_scale_nvidia").where("sale_price_thb is not null and product_group is not null")
    tier = F.when(F.col("unit_tier") == 1, "low").when(F.col("unit_tier") == 2, "mid").when(F.col("unit_tier") == 3, "high").otherwise("all")
    g = v.groupBy(F.col("product_group").alias("grp"), tier.alias("tier")).agg(F.min(F.floor("sale_price_thb")).alias("a"), F.max(F.floor("sale_price_thb")).alias("b"))
    return g.select("grp", "tier", F.concat("tier", F.lit(" "), F.col("a").cast("string"), F.when(F.col("a") != F.col("b"), F.concat(F.lit("-"), F.col("b").cast("string"))).otherwise(""), F.lit(" baht")).alias("label"))


# -- report assembly -----------------------------------------------------------------------


@query("l10_overrides", "with o as (select trend_id, stream_name, growth_score_y3 s, case when growth_score_y3 >= 0.5 then 'durable' else 'fad' end b from trends where growth_score_y3 is not null and above_market_line = 1) select trend_id, coalesce(o.s, growth_score_y1) as score, coalesce(o.b, 'unknown') as band, o.b is not null as overridden from trends t left join o using (trend_id)")
def l10(spark, d):
    """Durability from the cross-source result where that has one, else the stream's own."""
    t = table(spark, d, "trends")
    o = t.where("growth_score_y3 is not null and above_market_line = 1").select("trend_id", F.col("growth_score_y3").alias("score"), F.when(F.col("growth_score_y3") >= 0.5, "durable").otherwise("fad").alias("band"))
    return A.overridden(t.select("trend_id", F.col("growth_score_y1").alias("score"), F.lit("unknown").alias("band")), ["trend_id"], o, ["score", "band"])


@query("l11_master_rows", f"with {LISTINGS_SQL}, p as (select trend, count(*) n, max(sim) best from lst where trend is not null group by 1), e as (select trend_id trend, count(distinct customer) c from export_llm_data group by 1) select t.trend_id, coalesce(display_name, trend_name) as name, coalesce(p.n, 0)::bigint as n_products, round(p.best, 6) as best, coalesce(e.c, 0)::bigint as n_customers from trends t left join p on p.trend = t.trend_id left join e on e.trend = t.trend_id")
def l11(spark, d):
    """The master report's row of each trend out of trends, scores and exports."""
    p = listings(spark, d).where("trend is not null").groupBy(F.col("trend").alias("trend_id")).agg(F.count(F.lit(1)).alias("n"), F.max("sim").alias("best"))
    e = table(spark, d, "export_llm_data").groupBy("trend_id").agg(F.countDistinct("customer").alias("c"))
    t = table(spark, d, "trends").join(p, "trend_id", "left").join(e, "trend_id", "left")
    return t.select("trend_id", F.coalesce("display_name", "trend_name").alias("name"), F.coalesce("n", F.lit(0)).alias("n_products"), F.round("best", 6).alias("best"), F.coalesce("c", F.lit(0)).alias("n_customers"))


@query("l12_hoisted_fields", "select trend_id, trend_name as topic, main_category as category from trends")
def l12(spark, d):
    """Fields of answers that some models wrap in one more object, taken to the top."""
    t = table(spark, d, "trends")
    flat = F.to_json(F.struct(F.col("trend_name").alias("topic"), F.col("main_category").alias("category")))
    deep = F.to_json(F.struct(F.struct(F.col("trend_name").alias("topic"), F.col("main_category").alias("category")).alias("result")))
    x = t.select("trend_id", F.when(F.col("n_keywords") % 2 == 0, flat).otherwise(deep).alias("raw"))
    return x.select("trend_id", *(c.alias(f) for f, c in A.hoisted(F.col("raw"), ["topic", "category"]).items()))


@query("l13_label_slots", "with p as (select stream_name, trend_id, growth_score_y1 x, round(growth_score_y3 * 100, 3) y, row_number() over (partition by stream_name order by round(growth_score_y3 * 100, 3), growth_score_y1, trend_id) - 1 i from trends where growth_score_y1 is not null and growth_score_y3 is not null and stream_name is not null) select trend_id, round(max(y - i * 4.0::double) over (partition by stream_name order by i rows unbounded preceding) + i * 4.0::double, 6) as slot from p")
def l13(spark, d):
    """Places of labels beside points so that none lies over another."""
    p = table(spark, d, "trends").where("growth_score_y1 is not null and growth_score_y3 is not null and stream_name is not null").select("stream_name", "trend_id", F.col("growth_score_y1").alias("x"), F.round(F.col("growth_score_y3") * 100, 3).alias("y"))
    return A.label_slots(p, "stream_name", "x", "y", "trend_id", 4.0).select("trend_id", F.round("slot", 6).alias("slot"))


@query("l14_report_tiles", f"with {LISTINGS_SQL}, s as (select matched_keyword k, count(*) n, count(distinct outlet) o from documents where matched_keyword is not null group by 1), p as (select trend, count(distinct grp) c, count(*) n from lst where trend is not null group by 1) select trend_id, coalesce(s.n, 0)::bigint as n_documents, coalesce(s.o, 0)::bigint as n_outlets, coalesce(p.c, 0)::bigint as n_categories, coalesce(p.n, 0)::bigint as n_products, case when coalesce(s.n, 0) = 0 then 'no source' when s.n < 5 then 'few' else 'many' end as evidence from trends t left join s on s.k = t.trend_name left join p on p.trend = t.trend_id")
def l14(spark, d):
    """Tiles of a trend's page: source documents, outlets, categories, products and how much evidence there is."""
    s = docs(spark, d).where("matched_keyword is not null").groupBy(F.col("matched_keyword").alias("trend_name")).agg(F.count(F.lit(1)).alias("s"), F.countDistinct("outlet").alias("o"))
    p = listings(spark, d).where("trend is not null").groupBy(F.col("trend").alias("trend_id")).agg(F.countDistinct("grp").alias("c"), F.count(F.lit(1)).alias("n"))
    t = table(spark, d, "trends").join(s, "trend_name", "left").join(p, "trend_id", "left")
    zero = lambda c: F.coalesce(c, F.lit(0))
    return t.select("trend_id", zero("s").alias("n_documents"), zero("o").alias("n_outlets"), zero("c").alias("n_categories"), zero("n").alias("n_products"), F.when(zero("s") == 0, "no source").when(F.col("s") < 5, "few").otherwise("many").alias("evidence"))


@query("l29_lint_corpus", "with allow as (select distinct lower(w) w from (select unnest(regexp_extract_all(brand_name, '[A-Za-z]+')) w from brand_list union all select unnest(regexp_extract_all(alias_text, '[A-Za-z]+')) from brand_aliases)), t as (select doc_id, unnest(list_distinct(regexp_extract_all(title, '[A-Z][A-Za-z]+'))) w from documents where title is not null) select w as word, count(*)::bigint as n_texts from t where lower(w) not in (select w from allow) group by 1")
def l29(spark, d):
    """Capitalised words of the texts that no allow list has, and in how many texts each stands."""
    letters = lambda c, p: F.explode(F.array_distinct(F.regexp_extract_all(c, F.lit(f"({p})"), F.lit(1))))
    names = table(spark, d, "brand_list").select(F.col("brand_name").alias("n")).union(table(spark, d, "brand_aliases").select("alias_text"))
    allow = names.select(letters("n", "[A-Za-z]+").alias("w")).select(F.lower("w").alias("_w")).distinct()
    t = docs(spark, d).where("title is not null").select("doc_id", letters("title", "[A-Z][A-Za-z]+").alias("word"))
    return t.withColumn("_w", F.lower("word")).join(allow, "_w", "left_anti").groupBy("word").agg(F.count(F.lit(1)).alias("n_texts"))


_TITLES = "select title, min(link) as link from documents where title is not null and link is not null and source = '{}' group by 1"


@query("l30_title_links", f"with n as ({_TITLES.format('news')}), p as ({_TITLES.format('paper')}), s as ({_TITLES.format('social')}), w as (select distinct title from documents where title is not null) select title, coalesce(n.link, p.link, s.link) as link, case when n.link is not null then 'news' when p.link is not null then 'paper' else 'social' end as how from w left join n using (title) left join p using (title) left join s using (title) where coalesce(n.link, p.link, s.link) is not null")
def l30(spark, d):
    """A title's link from the first store that knows it."""
    x = docs(spark, d)
    stores = {s: x.where(F.col("title").isNotNull() & F.col("link").isNotNull() & (F.col("source") == s)).groupBy("title").agg(F.min("link").alias("link")) for s in ("news", "paper", "social")}
    return A.first_found(x.where("title is not null"), "title", stores, "link")


@query("l31_cluster_lines", "with l as (select trend_id, stream_name, lower(concat_ws(' | ', trend_name, keywords, main_category)) line from trends where stream_name is not null) select trend_id, line, list_sort(list_distinct(list_filter(regexp_split_to_array(line, '[^a-z0-9฀-๿]+'), lambda w: w <> ''))) as tokens from l")
def l31(spark, d):
    """A cluster's text line and its tokens, by stream."""
    line = F.lower(F.concat_ws(" | ", "trend_name", "keywords", "main_category"))
    t = table(spark, d, "trends").where("stream_name is not null").select("trend_id", line.alias("line"))
    return t.select("trend_id", "line", F.array_sort(F.array_distinct(F.filter(F.split("line", "[^a-z0-9฀-๿]+"), lambda w: w != ""))).alias("tokens"))


# -- market report and backtest ------------------------------------------------------------


@query("k18_market_rows", "with y as (select o_orderpriority c, year(o_orderdate) y, round(sum(o_totalprice::double), 2) v from orders group by 1, 2), a as (select c, max(v) filter (y = 1997) l, max(v) filter (y = 1993) b from y group by 1) select c as name, round(l / 1e6, 2) as value_m, round(100 * l / sum(l) over (), 2) as share, round((pow(l / b, 0.25::double) - 1) * 100, 2) as growth, round(100 * l / max(l) over (), 1) as bar from a")
def k18(spark, d):
    """Rows of the market table: value, share, yearly growth and bar of each category, from a handful of totals."""
    o = table(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("name")).agg(*(F.round(F.sum(F.when(F.year("o_orderdate") == y, F.col("o_totalprice").cast("double"))), 2).alias(c) for y, c in ((1997, "l"), (1993, "b"))))
    all_ = o.agg(F.sum("l").alias("s"), F.max("l").alias("m"))
    x = o.crossJoin(F.broadcast(all_))  # one row
    return x.select("name", F.round(F.col("l") / 1e6, 2).alias("value_m"), F.round(100 * F.col("l") / F.col("s"), 2).alias("share"), F.round((F.pow(F.col("l") / F.col("b"), F.lit(0.25)) - 1) * 100, 2).alias("growth"), F.round(100 * F.col("l") / F.col("m"), 1).alias("bar"))


_PAIRS = """m as (select l_partkey entity, cast(date_trunc('month', l_shipdate) as date) as month, count(*) far, sum((l_quantity::double > 25)::int)::bigint near from lineitem group by 1, 2),
e as (select distinct entity from m), s as (select cast(unnest(generate_series(date '1995-01-01', date '2001-12-01', interval 1 month)) as date) as month),
f as (select entity, month, coalesce(far, 0) far, coalesce(near, 0) near from e cross join s left join m using (entity, month)),
c as (select unnest([date '1998-01-01', date '1999-06-01']) cutoff),
g as (select cutoff, entity, avg(far) filter (k between -11 and 0) f1, avg(far) filter (k between -23 and -12) f0, avg(near) filter (k between -11 and 0) n1, avg(near) filter (k between -23 and -12) n0, avg(near) filter (k between 1 and 24) af from (select *, date_diff('month', cutoff, month) k from f, c) group by 1, 2),
p as (select cutoff, entity, case when (f1 + 1) / (f0 + 1) >= 1.05 and (n1 + 1) / (n0 + 1) >= 1.05 then 'both grow' when (f1 + 1) / (f0 + 1) >= 1.05 then 'window' when (n1 + 1) / (n0 + 1) >= 1.05 then 'local only' else 'both flat' end as box, round((af + 1) / (n1 + 1), 3) as future_ratio, round(af, 2) as future_level, (af + 1) / (n1 + 1) >= 1.05 and af >= 0.15 as rose from g)"""


def _points(spark, d):
    """Two series of each part on a spine of all months, and their points at two cut-offs."""
    li = table(spark, d, "lineitem").select(F.col("l_partkey").alias("entity"), F.to_date(F.trunc("l_shipdate", "MM")).alias("month"), (F.col("l_quantity").cast("double") > 25).cast("int").alias("near"))
    m = li.groupBy("entity", "month").agg(F.count(F.lit(1)).alias("far"), F.sum("near").alias("near"))
    months = F.explode(F.sequence(F.lit("1995-01-01").cast("date"), F.lit("2001-12-01").cast("date"), F.expr("interval 1 month"))).alias("month")
    full = m.select("entity").distinct().select("entity", months).join(m, ["entity", "month"], "left").fillna(0, ["far", "near"])
    return A.growth_points(full, "entity", "month", "far", "near", ["1998-01-01", "1999-06-01"], 24, 1.05, 0.15)


@query("k16_backtest_points", f"with {_PAIRS} select cutoff, entity, box, future_ratio, future_level, rose from p")
def k16(spark, d):
    """Where a far series grows and the near one doesn't yet: points and what came of them."""
    return _points(spark, d)


@query("k16_backtest_rates", f"with {_PAIRS}, r as (select box, count(*) as n, avg(rose::int) rate from p group by 1) select box, n, round(rate, 4) as rate, round(rate - (select rate from r where box = 'both flat'), 4) as difference from r")
def k16_rates(spark, d):
    return A.hit_rates(_points(spark, d))
