"""Queries of parsers, gates, caches and run files, with their SQL."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftline.functions import quantity
from weftline.functions import text as T
from weftline.operators import gates as G
from weftline.session import checkpoint_dir
from weftline.sources import markup, readers, sinks
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


def docs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents")


def place(spark: SparkSession, name: str) -> str:
    """A folder for what a query writes, in the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def escaped(c: Column) -> Column:
    """A column's text as it stands in markup."""
    x = F.coalesce(c, F.lit(""))
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        x = F.replace(x, F.lit(a), F.lit(b))
    return x


# -- sources -------------------------------------------------------------------------------


@query("a03_pool_checked", f"with {MONTHLY_SQL} select keyword, month, value from monthly")
def a03(spark, d):
    """The pool of monthly series, written as gzip CSV with its manifest and read again against it."""
    path = place(spark, "a03_pool")
    sinks.write_pool(monthly(spark, d), path, ["keyword", "month", "value"])
    return readers.checked_pool(spark, path, "keyword string, month date, value double")


@query("b12_pool_manifest", f"with {MONTHLY_SQL} select count(*) as n_rows, count(distinct keyword) as n_keywords, min(month) as first_month, max(month) as last_month from monthly")
def b12(spark, d):
    path = place(spark, "b12_pool")
    sinks.write_pool(monthly(spark, d), path, ["keyword", "month", "value"])
    return spark.read.json(f"{path}/manifest").select("n_rows", "n_keywords", F.to_date("first_month").alias("first_month"), F.to_date("last_month").alias("last_month"))


@query("a05_workbook_sheets", "select 'region' as sheet, r_regionkey::varchar as key, r_name as name from region union all select 'nation', n_nationkey::varchar, n_name from nation")
def a05(spark, d):
    """A workbook of several sheets scanned into one tidy table a sheet, through a cache keyed by the file's size and time."""
    path = place(spark, "a05_book").removeprefix("file:")
    sheets = {"region": table(spark, d, "region").select(F.col("r_regionkey").alias("key"), F.col("r_name").alias("name")), "nation": table(spark, d, "nation").select(F.col("n_nationkey").alias("key"), F.col("n_name").alias("name"))}
    sinks.write_workbook(sheets, f"{path}/book.xlsx")
    tidy = readers.cached_sheets(spark, f"{path}/book.xlsx", list(sheets), f"{path}/cache")
    tidy = readers.cached_sheets(spark, f"{path}/book.xlsx", list(sheets), f"{path}/cache")  # the second read is the cache's
    parts = [t.select(F.lit(n).alias("sheet"), "key", "name") for n, t in tidy.items()]
    return parts[0].unionByName(parts[1])


@query("a06_register", "select s_suppkey::bigint as s_suppkey, s_name, round(s_acctbal::double, 2) as s_acctbal from supplier")
def a06(spark, d):
    """A register whose every column is text, typed in one select; what can't be typed is null."""
    path = place(spark, "a06_register")
    table(spark, d, "supplier").select("s_suppkey", "s_name", "s_acctbal").write.option("header", True).csv(path)
    raw = readers.register(spark, path, ["s_suppkey", "s_name", "s_acctbal"])
    return raw.select(F.expr("try_cast(s_suppkey as bigint)").alias("s_suppkey"), "s_name", F.round(F.expr("try_cast(s_acctbal as double)"), 2).alias("s_acctbal"))


_RISING = "select source_region as geo, source as cat, coalesce(matched_keyword, '') as q from documents where source_region is not null and source is not null and matched_keyword is not null"


@query("a09_rising_rows", f"with r as ({_RISING}) select geo, cat, q as query, count(*)::bigint as n, any_value(m.max_repeats)::int as level from r join mix_targets m on m.source = r.cat group by 1, 2, 3")
def a09(spark, d):
    """Cached answers, one JSON file a place and category, as flat rows joined to their category."""
    path = place(spark, "a09_cache")
    r = docs(spark, d).where("source_region is not null and source is not null and matched_keyword is not null").groupBy(F.col("source_region").alias("geo"), F.col("source").alias("cat"), F.col("matched_keyword").alias("query")).agg(F.count(F.lit(1)).alias("value"))
    r.select("geo", "cat", F.array(F.struct("query", "value")).alias("rising")).write.json(path)
    return readers.rising_rows(spark, path, table(spark, d, "mix_targets").select(F.col("source").alias("cat"), F.col("max_repeats").alias("level"))).select("geo", "cat", "query", F.col("value").alias("n"), "level")


@query("a13_feed_config", "select d.source, coalesce(m.max_repeats, 1)::int as most, coalesce(m.target_share, 0.05)::double as share from (select distinct source from documents where source is not null) d left join (select * from mix_targets where source <> 'news') m using (source)")
def a13(spark, d):
    """A source's settings, or the defaults where the configuration doesn't name it."""
    config = table(spark, d, "mix_targets").where("source <> 'news'").select("source", "max_repeats", "target_share")
    x = docs(spark, d).where("source is not null").select("source").distinct()
    return readers.with_defaults(x, config, "source", {"max_repeats": 1, "target_share": 0.05}).select("source", F.col("max_repeats").alias("most"), F.col("target_share").alias("share"))


_TITLED = "title is not null and link is not null and not regexp_matches(title, '[\\x00\\r]')"


@query("a21_result_stubs", f"select doc_id // 10 as page, row_number() over (partition by doc_id // 10 order by doc_id)::int as place, title, link from documents where {_TITLED}")
def a21(spark, d):
    """Result pages of ten hits each, read into article stubs."""
    x = docs(spark, d).where("title is not null and link is not null").where(~F.col("title").rlike("[\\x00\\r]"))
    hit = F.concat(F.lit('<div class="hit"><a class="title-link" href="'), escaped(F.col("link")), F.lit('">'), escaped(F.col("title")), F.lit('</a><span class="journal">'), escaped(F.col("outlet")), F.lit("</span></div>"))
    pages = x.groupBy(F.floor(F.col("doc_id") / 10).alias("page")).agg(F.sort_array(F.collect_list(F.struct("doc_id", hit.alias("h")))).alias("hits"))
    html = F.concat(F.lit("<html><body>"), F.array_join("hits.h", "\n"), F.lit("</body></html>"))
    return pages.select("page", F.posexplode(markup.stubs_column(html))).select("page", (F.col("pos") + 1).alias("place"), "col.title", "col.link")


@query("a22_article_records", f"select doc_id, title, published_at as day, length(text) as n_chars, (outlet is not null)::int as n_captions from documents where {_TITLED} and text is not null and trim(text, chr(32) || chr(9) || chr(10)) <> '' and not regexp_matches(text, '[\\x00\\r]')")
def a22(spark, d):
    """Article pages read into records: meta tags, body, captions, references."""
    x = docs(spark, d).where("title is not null and link is not null and text is not null").where(~F.col("title").rlike("[\\x00\\r]") & ~F.col("text").rlike("[\\x00\\r]") & (F.regexp_replace("text", "[ \t\n]", "") != ""))
    meta = lambda n, c: F.concat(F.lit(f'<meta name="{n}" content="'), escaped(c), F.lit('"/>'))
    caption = F.when(F.col("outlet").isNotNull(), F.concat(F.lit("<figcaption>"), escaped(F.col("outlet")), F.lit("</figcaption>"))).otherwise("")
    html = F.concat(F.lit("<html><head>"), meta("citation_title", F.col("title")), F.when(F.col("published_at").isNotNull(), meta("citation_publication_date", F.col("published_at"))).otherwise(""), F.lit("</head><body><p>"), escaped(F.col("text")), F.lit("</p>"), caption, F.lit('<ul><li class="reference">'), escaped(F.col("link")), F.lit("</li></ul></body></html>"))
    r = x.select("doc_id", markup.article_column(html).alias("r"))
    return r.select("doc_id", "r.title", F.col("r.date").alias("day"), F.length("r.body").cast("long").alias("n_chars"), F.size("r.captions").alias("n_captions"))


@query("a23_journal_xml", "select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as day, 'Dept ' || o_custkey as author, 3 as n_lines, 1 as n_references from orders")
def a23(spark, d):
    """Journal XML with dates of several kinds, nested sections and references, read into records."""
    o = table(spark, d, "orders")
    part = lambda f: F.date_format("o_orderdate", f)
    date = lambda kind, y: F.concat(F.lit(f'<pub-date pub-type="{kind}"><day>'), part("d"), F.lit("</day><month>"), part("M"), F.lit("</month><year>"), y, F.lit("</year></pub-date>"))
    xml = F.concat(
        F.lit("<article><front><article-meta><title-group><article-title>"), escaped(F.col("o_orderpriority")), F.lit("</article-title></title-group><contrib-group><contrib><name><surname>"), F.col("o_custkey").cast("string"), F.lit("</surname><given-names>Dept</given-names></name></contrib></contrib-group>"),
        date("collection", F.lit("1900")), date("epub", part("yyyy")), F.lit("</article-meta></front><body><sec><title>Aim</title><sec><title>Part</title><p>"), escaped(F.col("o_orderstatus")), F.lit("</p></sec></sec></body><back><ref-list><ref>one</ref></ref-list></back></article>"),
    )
    r = o.select("o_orderkey", markup.jats_column(xml).alias("r"))
    return r.select("o_orderkey", F.col("r.date").alias("day"), F.col("r.authors")[0].alias("author"), F.size(F.split("r.body", "\n\n")).alias("n_lines"), F.size("r.references").alias("n_references"))


@query("l20_conclusions", "select doc_id, length(trim(text, chr(32) || chr(9) || chr(10))) as n_chars from documents where text is not null and not regexp_matches(text, '(^|\\n)#') and regexp_matches(text, '^[A-Za-z0-9]') and regexp_matches(text, '[A-Za-z0-9.]$')")
def l20(spark, d):
    """Conclusions under their heading, of papers made of real texts."""
    x = docs(spark, d).where(~F.col("text").rlike("(^|\\n)#") & F.col("text").rlike("^[A-Za-z0-9]") & F.col("text").rlike("[A-Za-z0-9.]\\z"))
    paper = F.concat(F.lit("## 1. Methods\n\nWe did.\n\n## 5. Conclusions\n\n"), F.col("text"), F.lit("\n\n## References\n\n1"))
    return x.select("doc_id", F.length(markup.conclusions_column(paper)).cast("long").alias("n_chars"))


@query("a26_cached_pages", "with w as (select distinct link from documents where link is not null), c as (select link, min(doc_id) id from documents where link is not null and lang = 'en' group by 1) select w.link, case when c.link is not null then 'cached' when length(w.link) % 7 = 0 then 'failed' else 'fetched' end as status from w left join c using (link)")
def a26(spark, d):
    """Pages by the hash of their address: from the cache, else fetched; failures aren't kept."""
    wanted = docs(spark, d).where("link is not null").select("link").distinct()
    cache = docs(spark, d).where("link is not null and lang = 'en'").groupBy(F.sha1("link").alias("key")).agg(F.min("doc_id").cast("string").alias("page"))

    def fetch(urls: pd.Series) -> pd.Series:
        return urls.map(lambda u: None if len(u) % 7 == 0 else f"page of {u}")

    return readers.cached_fetch(wanted, "link", cache, F.pandas_udf(fetch, "string")).select("link", "status")


@query("a27_key_pool", "with k as (select r_regionkey, sum(n) over (order by r_regionkey) t, n from (select n_regionkey r_regionkey, count(*) * 40 n from nation group by 1)), c as (select c_custkey, row_number() over (order by c_custkey) i from customer) select c_custkey, k.r_regionkey as served_by from c left join k on i > t - n and i <= t")
def a27(spark, d):
    """Requests served by keys that are used up one after the other."""
    keys = table(spark, d, "nation").groupBy(F.col("n_regionkey").alias("key")).agg((F.count(F.lit(1)) * 40).alias("quota"))
    return G.key_for_request(keys, table(spark, d, "customer").select("c_custkey"), "quota", "key", "c_custkey").select("c_custkey", "served_by")


# -- sinks ---------------------------------------------------------------------------------


@query("b07_map_file", "select product_group, count(distinct listing_id) as n, round(max(similarity), 6) as best from (select distinct listing_id, product_group, similarity from validate_at_scale_nvidia where similarity between 0 and 1 and not isnan(similarity) and product_group is not null) group by 1")
def b07(spark, d):
    """A map by category, written compressed and partitioned and read again."""
    path = place(spark, "b07_map")
    x = table(spark, d, "validate_at_scale_nvidia").where("similarity between 0 and 1 and product_group is not null").select("listing_id", "product_group", "similarity").distinct()
    sinks.write_star({"map": x}, path, {"map": ["product_group"]})
    return spark.read.parquet(f"{path}/map").groupBy("product_group").agg(F.countDistinct("listing_id").alias("n"), F.round(F.max("similarity"), 6).alias("best"))


@query("b09_brand_workbooks", "with l as (select distinct listing_id, brand, sale_price_thb p from validate_at_scale_nvidia where brand is not null), r as (select *, row_number() over (partition by brand order by p desc nulls last, listing_id) k from l) select brand, least(count(*), 20)::bigint as n_products, min(listing_id) filter (k = 1)::varchar as first_product from r group by 1")
def b09(spark, d):
    """A workbook a brand, with a sheet of totals and one of its twenty dearest products, written and read again."""
    l = table(spark, d, "validate_at_scale_nvidia").where("brand is not null").select("listing_id", "brand", F.col("sale_price_thb").alias("p")).distinct()  # noqa: E741
    k = F.row_number().over(Window.partitionBy("brand").orderBy(F.col("p").desc_nulls_last(), "listing_id"))
    top = l.withColumn("k", k).where("k <= 20")
    rows = top.groupBy("brand").agg(F.sort_array(F.collect_list(F.struct("k", F.col("listing_id").cast("string").alias("id"), F.col("p").cast("string").alias("p")))).alias("rows"))

    def both(brand: pd.Series, rows: pd.Series) -> pd.DataFrame:
        out = []
        for b, r in zip(brand, rows, strict=True):
            book = sinks.workbook_bytes({"totals": [["brand", "products"], [b, str(len(r))]], "products": [["id", "price"], *([x["id"], x["p"]] for x in r)]})
            back = readers.cell_rows(book, 2)
            out.append((len(back) - 1, back[1][0]))
        return pd.DataFrame(out, columns=["n", "first"])

    read = rows.select("brand", F.pandas_udf(both, "n long, first string")("brand", "rows").alias("r"))
    return read.select("brand", F.col("r.n").alias("n_products"), F.col("r.first").alias("first_product"))


@query("b10_checkpoint", "select listing_id, max(similarity) as v from (select distinct listing_id, similarity from validate_at_scale_nvidia where similarity is not null and not isnan(similarity)) group by 1")
def b10(spark, d):
    """A checkpoint that is replaced whole: written beside the old one, then renamed."""
    path = place(spark, "b10_checkpoint")
    x = table(spark, d, "validate_at_scale_nvidia").where("similarity is not null and not isnan(similarity)").groupBy("listing_id").agg(F.max("similarity").alias("v"))
    sinks.replace_whole(x.limit(0), path)
    sinks.replace_whole(x, path)
    return spark.read.parquet(path)


# -- projections ---------------------------------------------------------------------------


@query("c02_second_retailer", "select distinct listing_id::bigint::varchar as product_id, product_id as product_group_code, coalesce(sold_count, 0) > 0 as in_stock, coalesce(regexp_matches(lower(product_name), 'contact *lens|คอนแทค') or regexp_matches(product_name, ' -[0-9]{1,2}([.][0-9]{1,2})? *$') or lower(trim(category)) = 'eye care', false) as is_lens, 'second' as retailer from validate_at_scale_nvidia")
def c02(spark, d):
    v = table(spark, d, "validate_at_scale_nvidia").withColumn("id", F.col("listing_id").cast("double"))
    lens = F.lower("product_name").rlike("contact *lens|คอนแทค") | F.col("product_name").rlike(" -[0-9]{1,2}([.][0-9]{1,2})? *$") | (F.lower(F.trim("category")) == "eye care")
    return v.select(F.col("id").cast("long").cast("string").alias("product_id"), F.col("product_id").alias("product_group_code"), (F.coalesce("sold_count", F.lit(0.0)) > 0).alias("in_stock"), F.coalesce(lens, F.lit(False)).alias("is_lens"), F.lit("second").alias("retailer")).distinct()


@query("c09_query_norm", "select distinct keyword, regexp_replace(regexp_replace(trim(regexp_replace(lower(keyword), '[ \\t\\n\\r\\f\\v]+', ' ', 'g')), '([฀-๿]) ([฀-๿])', '\\1\\2', 'g'), '([฀-๿]) ([฀-๿])', '\\1\\2', 'g') as norm from pmc_timeseries where keyword is not null and regexp_matches(keyword, '^[ -~฀-๿]*$')")
def c09(spark, d):
    k = table(spark, d, "pmc_timeseries").where("keyword is not null").where(F.col("keyword").rlike("^[ -~฀-๿]*\\z")).select("keyword").distinct()
    return k.select("keyword", F.regexp_replace(F.trim(F.regexp_replace(F.lower("keyword"), r"\s+", " ")), "(?<=[฀-๿]) (?=[฀-๿])", "").alias("norm"))


@query("c19_horizon_tokens", "select trend_id, list_transform(string_split(keywords, '; '), lambda k: 'In 3 years ' || k || ' up, 5y') as lines from trends where keywords is not null")
def c19(spark, d):
    """Tokens of the horizons replaced in every text of a nested value."""
    t = table(spark, d, "trends").where("keywords is not null")
    nested = t.select("trend_id", F.transform(F.split("keywords", "; "), lambda k: F.concat(F.lit("In {short} years "), k, F.lit(" up, {long}y"))).alias("lines"))
    return T.with_tokens(nested, {"short": "3", "long": "5"})


@query("c21_wide_years", "with n as (select o_orderpriority as priority, year(o_orderdate)::int y, count(*) c from orders group by 1, 2) select priority, y as year, round(c * 100.0::double / sum(c) over (partition by y), 4) as pct from n")
def c21(spark, d):
    """A table with a column a year, named like `1995 (%)`, turned long; other columns stay."""
    o = table(spark, d, "orders").select(F.col("o_orderpriority").alias("priority"), F.year("o_orderdate").alias("y"))
    n = o.groupBy("priority", "y").agg(F.count(F.lit(1)).alias("c"))
    total = o.groupBy("y").agg(F.count(F.lit(1)).alias("t"))
    pct = n.join(total, "y").withColumn("pct", F.round(F.col("c") * 100.0 / F.col("t"), 4))
    years = [r["y"] for r in total.select("y").orderBy("y").collect()]  # a handful
    wide = pct.groupBy("priority").pivot("y", years).agg(F.first("pct"))
    wide = wide.select("priority", *(F.col(str(y)).alias(f"{y} (%)") for y in years))
    return readers.long_years(wide, "year", "pct").where("pct is not null")


# -- joins, scalars ------------------------------------------------------------------------


@query("d15_close_brands")
def d15(spark, d):
    """Typed brands: the listed one but for case, else up to five that are at least half alike."""
    typed = table(spark, d, "export_llm_data").select(F.col("leader_brand").alias("typed")).where("typed is not null and trim(typed) != ''").distinct()
    return readers.close_names(typed, "typed", table(spark, d, "brand_list").select(F.col("brand_name").alias("name")), "name")


@query("d15_exact_brands", "with t as (select distinct leader_brand typed from export_llm_data where leader_brand is not null and trim(leader_brand) <> '') select typed, brand_name as exact from t join brand_list on lower(typed) = lower(brand_name)")
def d15_exact(spark, d):
    return d15(spark, d).where("exact is not null").select("typed", "exact")


@query("i01_standard_size")
def i01(spark, d):
    """Each listing's size in g, ml or pieces with dimension, pack and flag."""
    v = table(spark, d, "validate_at_scale_nvidia").select("listing_id", "product_name", "pack_size", "unit_label").distinct()

    def read(name: pd.Series, size: pd.Series, unit: pd.Series) -> pd.DataFrame:
        rows = [quantity.standard_size(a, b if b == b else None, c) for a, b, c in zip(name, size, unit, strict=True)]
        return pd.DataFrame(rows, columns=["size_std", "dimension", "pack", "flag"])

    return v.select("listing_id", F.pandas_udf(read, "size_std double, dimension string, pack int, flag string")("product_name", "pack_size", "unit_label").alias("r")).select("listing_id", "r.*")


@query("i01_unsized", "with l as (select distinct listing_id, product_name, pack_size, unit_label from validate_at_scale_nvidia) select listing_id from l where unit_label is null or pack_size is null or isnan(pack_size) or pack_size <= 0")
def i01_unsized(spark, d):
    return i01(spark, d).where("flag = 'no_size'").select("listing_id")


@query("i13_dimension_gate", "select trend_id, case when keywords is null then 'no quote' when not contains(lower(coalesce(display_name, '') || ' ' || keywords), lower(string_split(keywords, '; ')[1])) then 'quote not in evidence' when n_keywords is not null and not contains(keywords, n_keywords::varchar) and n_keywords >= 10 then 'number not in evidence' else 'ok' end as topic from trends")
def i13(spark, d):
    """A dimension's field passes with a quote that stands in the evidence and no number that doesn't."""
    from weftline.operators.evidence import gate

    t = table(spark, d, "trends")
    said = F.concat(F.lit("It has "), F.coalesce(F.col("n_keywords").cast("string"), F.lit("some")), F.lit(" words"))
    return t.select("trend_id", gate(said, F.split("keywords", "; ")[0], F.concat_ws(" ", F.coalesce("display_name", F.lit("")), "keywords"), "worried").alias("topic"))


@query("i22_cross_source", "with w as (select trend_id, stream_name, unnest(string_split(keywords, '; ')) k from trends where keywords is not null), s as (select a.trend_id, count(distinct b.stream_name) n from w a join w b using (k) where b.stream_name is not null group by 1) select t.trend_id, coalesce(n, 0)::int as n_streams, coalesce(n, 0) > 1 and coalesce(t.above_market_line, 0) <> 1 as applied from trends t left join s using (trend_id)")
def i22(spark, d):
    t = table(spark, d, "trends").select("trend_id", "stream_name", "keywords", "above_market_line")
    words = t.where("keywords is not null").select("trend_id", "stream_name", F.explode(F.split("keywords", "; ")).alias("k"))
    return G.cross_source(t.drop("keywords", "stream_name"), words, "trend_id", "stream_name", "k", "above_market_line").select("trend_id", "n_streams", "applied")


@query("i25_allowed_numbers", "select trend_id, (round(abs(expected_pct_y1), 1) is not null) as has_path, abs(round(expected_pct_y1) - expected_pct_y1) < 0.051 or abs(round(expected_pct_y1, 1) - expected_pct_y1) < 0.051 as exact_ok from trends where expected_pct_y1 is not null")
def i25(spark, d):
    """Which percents a trend's text may cite: a text that states the figure itself passes, to half its last decimal."""
    t = table(spark, d, "trends").where("expected_pct_y1 is not null")
    allowed = G.allowed_numbers(F.array("expected_pct_y1"))
    said = F.concat(F.lit("about "), F.abs(F.col("expected_pct_y1")).cast("decimal(20,8)").cast("string"), F.lit("% expected"))
    return t.select("trend_id", (F.size(allowed) > 0).alias("has_path"), G.percents_allowed(said, allowed).alias("exact_ok"))


@query("i25_trend_facts", "select trend_id, trend_name as trend, string_split(keywords, '; ') as keywords, round(expected_pct_y1, 1) as expected_y1, case when growth_score_y1 >= 0.5 then 'above' when growth_score_y1 is not null then 'below' end as market, 'Search interest in ' || trend_name || ' is expected to change ' || case when round(expected_pct_y1) >= 0 then '+' else '' end || round(expected_pct_y1)::bigint || '% in year 1.' as summary from trends where expected_pct_y1 is not null and trend_name is not null")
def i25_facts(spark, d):
    """The facts of a trend as one row, with the sentence that stands in where no text passes."""
    t = table(spark, d, "trends").where("expected_pct_y1 is not null and trend_name is not null")
    p = F.round("expected_pct_y1").cast("long")
    said = F.concat(F.lit("Search interest in "), "trend_name", F.lit(" is expected to change "), F.when(p >= 0, "+").otherwise(""), p.cast("string"), F.lit("% in year 1."))
    return t.select("trend_id", F.col("trend_name").alias("trend"), F.split("keywords", "; ").alias("keywords"), F.round("expected_pct_y1", 1).alias("expected_y1"), F.when(F.col("growth_score_y1") >= 0.5, "above").when(F.col("growth_score_y1").isNotNull(), "below").alias("market"), said.alias("summary"))


_PURPOSE_SQL = "(in order to|so that|because|due to|as a result|therefore|(to|for) prepare|prepar(e|es|ing|ation) for|in preparation|get(ting)? ready|to plan|planning|plans? ahead|feel(s|ing|ings)?|confident|confidence|worr(y|ies|ied)|anxious|relief|peace of mind)"


@query("i45_purpose_guard", f"with t as (select doc_id, regexp_replace(lower(coalesce(title, '') || ' ' || coalesce(text, '')), '''[^'']*''', ' ', 'g') t from documents) select doc_id from t where regexp_matches(t, '(^|[^a-z0-9_]){_PURPOSE_SQL}($|[^a-z0-9_])') or regexp_matches(t, 'เตรียม|เนื่องจาก|เพราะ|ดังนั้น|ส่งผลให้|ทำให้|วางแผน|รู้สึก|มั่นใจ|กังวล|สบายใจ')")
def i45(spark, d):
    x = docs(spark, d).select("doc_id", F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("text", F.lit(""))).alias("t"))
    return x.where(G.states_purpose(F.col("t"))).select("doc_id")


@query("i46_text_validators", "with t as (select doc_id, trim(coalesce(title, '')) t from documents), q as (select *, regexp_replace(t, '''[^'']*''', ' ', 'g') u from t) select doc_id, case when t = '' then 'empty' when regexp_matches(u, '[฀-๿]') then 'language' when len(string_split(regexp_replace(t, ' +', ' ', 'g'), ' ')) > 8 then 'too long' else 'ok' end as english from q")
def i46(spark, d):
    return docs(spark, d).select("doc_id", G.valid_text(F.col("title"), "en", 8).alias("english"))


@query("i46_same_shape", "with p as (select listing_id, [product_name, brand, subgroup] a, [coalesce(product_name, ''), coalesce(seller, ''), coalesce(subgroup, '')] b from (select distinct listing_id, product_name, brand, subgroup, seller from validate_at_scale_nvidia)) select listing_id, list_transform(a, lambda x: trim(coalesce(x, '')) = '') = list_transform(b, lambda x: trim(x) = '') as same from p")
def i46_shape(spark, d):
    v = table(spark, d, "validate_at_scale_nvidia").select("listing_id", "product_name", "brand", "subgroup", "seller").distinct()
    return v.select("listing_id", G.same_shape(F.array("product_name", "brand", "subgroup"), F.array("product_name", "seller", "subgroup")).alias("same"))


@query("g13_pack_columns")
def g13(spark, d):
    """Report blocks packed into columns, a report being one customer's trends in order."""
    e = table(spark, d, "export_llm_data").where("customer is not null").select("customer", "trend_id", F.length(F.coalesce("own_reason_en", F.lit(""))).alias("h")).groupBy("customer", "trend_id").agg((F.max("h") + 20.0).alias("h"))
    blocks = e.groupBy("customer").agg(F.sort_array(F.collect_list(F.struct("trend_id", "h"))).alias("b"))  # at most 300 trends a customer

    def pack(b: pd.Series) -> pd.Series:
        return b.map(lambda rows: G.pack_columns([r["h"] for r in rows], 900.0, 12.0))

    return blocks.select("customer", F.posexplode(F.pandas_udf(pack, "array<int>")(F.col("b")))).select("customer", F.col("pos").alias("block"), F.col("col").alias("column"))
