"""Queries over dirty columns, in full: gates, caches, answers, pages, windows and labels, with their SQL."""

from __future__ import annotations

from pyspark.sql import SparkSession, Window
from pyspark.sql import functions as F

from weftline.functions import text as T
from weftline.operators import assembly as A
from weftline.operators import catalogue as C
from weftline.operators import evidence as V
from weftline.operators import supply as U
from weftline.operators import series
from weftline.operators.gates import MONTHS
from weftline.operators.ranking import running
from weftline.plans.supply_queries import LISTINGS_SQL, listings
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


def docs(spark: SparkSession, d: str):
    return table(spark, d, "documents")


# -- sources -------------------------------------------------------------------------------


@query("a16_year_windows", "with y as (select keyword, min(try_cast(regexp_extract(pub_month, '((19|20)[0-9]{2})', 1) as int)) a, max(try_cast(regexp_extract(pub_month, '((19|20)[0-9]{2})', 1) as int)) b from pmc_timeseries where keyword is not null and regexp_matches(pub_month, '(19|20)[0-9]{2}') group by 1) select keyword, y as year, make_date(y, 1, 1) as since, make_date(y, 12, 31) as until from (select keyword, unnest(generate_series(a, b))::int y from y)")
def a16(spark, d):
    """One dated window a year between the first and the last year a keyword has papers in."""
    y = F.regexp_extract("pub_month", "((19|20)[0-9]{2})", 1)
    k = table(spark, d, "pmc_timeseries").where("keyword is not null").where(F.col("pub_month").rlike("(19|20)[0-9]{2}")).groupBy("keyword").agg(F.min(y.cast("int")).alias("a"), F.max(y.cast("int")).alias("b"))
    k = k.select("keyword", F.explode(F.sequence("a", "b")).alias("year"))
    return k.select("keyword", "year", F.make_date("year", F.lit(1), F.lit(1)).alias("since"), F.make_date("year", F.lit(12), F.lit(31)).alias("until"))


@query("a19_nested_posts", "select event_id, user_id::bigint as author, event_type as kind, cast(json_extract(props, '$.k') as bigint) as k from events where json_extract(props, '$.k') is not null")
def a19(spark, d):
    """Post rows out of nested answers: data, a list of children, each with an object of its own."""
    e = table(spark, d, "events").where("props is not null")
    answer = F.concat(F.lit('{"data":{"children":[{"data":{"id":'), F.col("event_id").cast("string"), F.lit(',"author":'), F.col("user_id").cast("string"), F.lit(',"kind":"'), "event_type", F.lit('","more":'), "props", F.lit("}}]}}"))
    shape = "data struct<children: array<struct<data: struct<id: bigint, author: bigint, kind: string, more: struct<k: bigint>>>>>"
    x = e.select(F.explode(F.from_json(answer, shape)["data"]["children"]).alias("c"))
    return x.select(F.col("c.data.id").alias("event_id"), F.col("c.data.author").alias("author"), F.col("c.data.kind").alias("kind"), F.col("c.data.more.k").alias("k")).where("k is not null")


@query("a25_cached_search", "with k as (select keyword_id, sha1('{\"page\":\"1\",\"q\":\"' || replace(replace(keyword, '\\', '\\\\'), '\"', '\\\"') || '\"}') as key from pmc_keywords), a as (select *, keyword_id % 5 e from k) select keyword_id, key, case when keyword_id % 3 = 0 and e <> 2 then 'cached' else 'ask' end as status from a")
def a25(spark, d):
    """Searches by the digest of their sorted parameters; an answer that was a transient error is asked again."""
    k = table(spark, d, "pmc_keywords").select("keyword_id", F.sha1(F.to_json(F.struct(F.lit("1").alias("page"), F.col("keyword").alias("q")))).alias("key"))
    cache = k.where("keyword_id % 3 = 0").select("key", F.when(F.col("keyword_id") % 5 == 2, "quota").alias("error")).where("error is null")
    return k.join(cache.select("key", F.lit("cached").alias("status")), "key", "left").select("keyword_id", "key", F.coalesce("status", F.lit("ask")).alias("status"))


@query("a30_title_links", "with s as (select lower(trim(title)) t, source s, min(link) link from documents where source in ('news', 'paper') and title is not null and link is not null group by 1, 2), w as (select distinct lower(trim(title)) t from documents where source = 'social' and title is not null), n as (select t, link from s where s = 'news'), p as (select t, link from s where s = 'paper'), c as (select left(t, 40) h, min(link) link from s where length(t) >= 40 group by 1) select w.t as title, coalesce(n.link, p.link, c.link) as link, case when n.link is not null then 'news' when p.link is not null then 'paper' else 'cut' end as how from w left join n using (t) left join p using (t) left join c on c.h = left(w.t, 40) and length(w.t) >= 40 where coalesce(n.link, p.link, c.link) is not null")
def a30(spark, d):
    """A title's link by the whole title in one store after the other, else by its first forty characters in any."""
    x = docs(spark, d).withColumn("title", F.lower(F.trim("title"))).where("title is not null")
    of = lambda s: x.where((F.col("source") == s) & F.col("link").isNotNull()).groupBy("title").agg(F.min("link").alias("link"))
    wanted = x.where("source = 'social'").select("title").distinct()
    heads = x.where("source in ('news', 'paper') and link is not null and length(title) >= 40").groupBy(F.substring("title", 1, 40).alias("h")).agg(F.min("link").alias("link"))
    cut_ = wanted.where("length(title) >= 40").withColumn("h", F.substring("title", 1, 40)).join(heads, "h").select("title", "link")
    return A.first_found(wanted, "title", {"news": of("news"), "paper": of("paper"), "cut": cut_}, "link")


# -- projections and answers ---------------------------------------------------------------


@query("c08_in_stock", "select distinct listing_id, coalesce(sold_count, 0) > 0 or coalesce(trend_id in (select trend_id from trends where above_market_line = 1), false) as kept from validate_at_scale_nvidia where product_group is not null and subgroup is not null and not coalesce(regexp_matches(lower(product_name), 'contact *lens'), false)")
def c08(spark, d):
    """Listings in stock or on the keep list; unlabelled ones and lenses are dropped."""
    keep = table(spark, d, "trends").where("above_market_line = 1").select("trend_id", F.lit(True).alias("on_list"))
    v = table(spark, d, "validate_at_scale_nvidia").where("product_group is not null and subgroup is not null").where(~F.coalesce(F.lower("product_name").rlike("contact *lens"), F.lit(False)))
    return v.join(keep, "trend_id", "left").select("listing_id", ((F.coalesce("sold_count", F.lit(0.0)) > 0) | F.coalesce("on_list", F.lit(False))).alias("kept")).distinct()


@query("c23_present_streams", "with e as (select unnest(['Paper', 'News', 'Social', 'Search', 'Video']) stream) select e.stream, count(t.trend_id) > 0 as present, count(t.trend_id) as n from e left join trends t on t.stream_name = e.stream group by 1")
def c23(spark, d):
    """Which of the streams a run may have are there, by their results."""
    e = spark.createDataFrame([(s,) for s in ("Paper", "News", "Social", "Search", "Video")], "stream string")
    t = table(spark, d, "trends").groupBy(F.col("stream_name").alias("stream")).agg(F.count("trend_id").alias("n"))
    return e.join(t, "stream", "left").select("stream", (F.coalesce("n", F.lit(0)) > 0).alias("present"), F.coalesce("n", F.lit(0)).alias("n"))


_ANSWER = "'Sure: [[' || (doc_id % 97) || ', \"' || title || '\", 0.5], [broken'"


@query("i07_answer_triples", f"with a as (select doc_id, {_ANSWER} t from documents where title is not null) select doc_id, unnest(list_transform(regexp_extract_all(t, '\\[\\s*([0-9]+)\\s*,\\s*\"([^\"\\]]*)\"\\s*,\\s*([0-9.]+)\\s*\\]', 1), lambda x: x::int)) as n, unnest(regexp_extract_all(t, '\\[\\s*([0-9]+)\\s*,\\s*\"([^\"\\]]*)\"\\s*,\\s*([0-9.]+)\\s*\\]', 2)) as path from a")
def i07(spark, d):
    """Triples out of answers about real titles; a title with a quotation mark or bracket breaks its triple."""
    text = F.concat(F.lit("Sure: [["), (F.col("doc_id") % 97).cast("string"), F.lit(', "'), "title", F.lit('", 0.5], [broken'))
    return docs(spark, d).where("title is not null").select("doc_id", F.explode(C.answer_triples(text)).alias("t")).select("doc_id", "t.n", "t.path")


_PLAIN = "title is not null and not regexp_matches(title, '[\"\\\\\\x00-\\x1f]')"


@query("i08_tolerant_json", f"select doc_id, title, (doc_id % 4 <> 3) as ok from documents where {_PLAIN}")
def i08(spark, d):
    """Answers in fences, with trailing commas, with literals of another language or cut off before they end."""
    x = docs(spark, d).where("title is not null").where(~F.col("title").rlike('["\\\\\\x00-\\x1f]'))
    kind = F.col("doc_id") % 4
    head = F.concat(F.lit('{"title": "'), "title", F.lit('", "ok": '))
    text = F.when(kind == 0, F.concat(F.lit("```json\n"), head, F.lit("true}\n```"))).when(kind == 1, F.concat(F.lit("So: "), head, F.lit('True, "x": [1, 2,],} done'))).when(kind == 2, F.concat(head, F.lit('true, "x": [[1, 2'))).otherwise(F.concat(head, F.lit("False,")))
    j = F.from_json(C.repaired_json(text), "title string, ok boolean")
    return x.select("doc_id", j.alias("j")).select("doc_id", "j.*")


_TRIPLE = '\\["([^"]*)",\\s*"([^"]*)",\\s*"([^"]*)"\\]'


@query("l02_triplet_recovery", f"with a as (select doc_id, '[[\"' || title || '\", \"is in\", \"' || outlet || '\"], [\"cut' t from documents where title is not null and outlet is not null) select doc_id, unnest(regexp_extract_all(t, '{_TRIPLE}', 1)) as s, unnest(regexp_extract_all(t, '{_TRIPLE}', 3)) as o from a")
def l02(spark, d):
    """Triplets of a list that breaks off, about real titles and outlets; one with a quotation mark inside is lost."""
    text = F.concat(F.lit('[["'), "title", F.lit('", "is in", "'), "outlet", F.lit('"], ["cut'))
    parts = F.arrays_zip(*(F.regexp_extract_all(text, F.lit(_TRIPLE), F.lit(i)).alias(n) for i, n in ((1, "s"), (3, "o"))))
    return docs(spark, d).where("title is not null and outlet is not null").select("doc_id", F.explode(parts).alias("t")).select("doc_id", "t.*")


@query("i09_number_gate", "with p as (select trend_id, n_keywords, round(expected_pct_y1)::bigint x from trends where expected_pct_y1 is not null and n_keywords is not null) select trend_id, n_keywords < 10 or n_keywords = abs(x) as ok from p")
def i09(spark, d):
    """A text's numbers against its evidence: that of the growth stands there, that of the words only if it is the same or too short to check."""
    t = table(spark, d, "trends").where("expected_pct_y1 is not null and n_keywords is not null")
    x = F.round("expected_pct_y1").cast("long").cast("string")
    said = F.concat(F.lit("It grows "), x, F.lit("% with "), F.col("n_keywords").cast("string"), F.lit(" words"))
    return t.select("trend_id", V.numbers_supported(said, F.concat(F.lit("expected "), x, F.lit("%"))).alias("ok"))


@query("i34_dates", "with t as (select doc_id, trim(regexp_replace(published_at, '\\s*(B\\.?E\\.?|พ\\.ศ\\.)\\s*', ' ', 'g')) t from documents where published_at is not null), p as (select doc_id, case when regexp_matches(t, '^[0-9]{4}-[0-9]{2}-[0-9]{2}') then left(t, 10) when regexp_matches(t, '^[0-9]{2}/[0-9]{2}/[0-9]{4}$') then substr(t, 7, 4) || '-' || substr(t, 4, 2) || '-' || substr(t, 1, 2) end s from t) select doc_id, cast(case when left(s, 4)::int >= 2400 then (left(s, 4)::int - 543)::varchar || substr(s, 5) else s end as date) as day from p where s is not null and try_cast((left(s, 4)::int - case when left(s, 4)::int >= 2400 then 543 else 0 end)::varchar || substr(s, 5) as date) is not null")
def i34(spark, d):
    """Days of the two commonest notations, also with Buddhist years."""
    x = docs(spark, d).where("published_at is not null").withColumn("t", F.trim(F.regexp_replace("published_at", r"\s*(B\.?E\.?|พ\.ศ\.)\s*", " ")))
    x = x.where(F.col("t").rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}") | F.col("t").rlike("^[0-9]{2}/[0-9]{2}/[0-9]{4}\\z"))
    return x.select("doc_id", T.any_date(F.col("published_at")).alias("day")).where("day is not null")


@query("i42_country", "select s_suppkey, trim(n_name) as country from supplier join nation on s_nationkey = n_nationkey")
def i42(spark, d):
    """The country at the end of an affiliation as suppliers write their addresses, with or without a full stop."""
    s = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    where = F.concat_ws(", ", "s_name", F.lit("Dept. of Skin; Univ. Hosp."), F.concat(F.lit(" "), "n_name", F.when(F.col("s_suppkey") % 2 == 0, ". ").otherwise(";")))
    return s.select("s_suppkey", C.country_of(F.trim(where)).alias("country"))


@query("i24_labels", "select trend_id, case when l <= -5 then 'Declining' when l < 5 then 'Stable' when l <= s then 'Peaking' when s >= 10 then 'Growing' else 'Emerging' end as stage, case when s is null then 'none' when abs(s) < 5 then 'steady' when l > s then 'structural' else 'short-lived' end as driver, case when growth_score_y3 >= .7 then 'years' when growth_score_y3 >= .4 then 'a year or two' else 'months' end as duration, case when growth_score_y1 >= .5 then 'above the market' else 'below the market' end as market from (select *, expected_pct_y1 s, expected_pct_y1 * growth_score_y3 * 2 l from trends where expected_pct_y1 is not null and growth_score_y3 is not null and growth_score_y1 is not null)")
def i24(spark, d):
    """Stage, driver, duration and place in the market of each trend."""
    t = table(spark, d, "trends").where("expected_pct_y1 is not null and growth_score_y3 is not null and growth_score_y1 is not null")
    s, long = F.col("expected_pct_y1"), F.col("expected_pct_y1") * F.col("growth_score_y3") * 2
    driver = F.when(F.abs(s) < 5, "steady").when(long > s, "structural").otherwise("short-lived")
    duration = F.when(F.col("growth_score_y3") >= 0.7, "years").when(F.col("growth_score_y3") >= 0.4, "a year or two").otherwise("months")
    return t.select("trend_id", V.trend_stage(s, long, 5, 10).alias("stage"), driver.alias("driver"), duration.alias("duration"), F.when(F.col("growth_score_y1") >= 0.5, "above the market").otherwise("below the market").alias("market"))


@query("i24_seasonality", f"with {MONTHLY_SQL}, c as (select keyword, month(month)::int m, avg(value) v from monthly group by 1, 2), p as (select keyword, avg(v) a, max(v) hi, min(v) lo, arg_max(m, v * 100 - m) k from c group by 1) select keyword, [{', '.join(repr(x) for x in MONTHS)}][k] as peak, round((hi - lo) / nullif(a, 0) * 100)::bigint as swing_pct, coalesce((hi - lo) / nullif(a, 0) >= 0.5, false) as strong from p")
def i24_season(spark, d):
    """Peak month and swing of a keyword's year."""
    c = monthly(spark, d).groupBy("keyword", F.month("month").alias("m")).agg(F.avg("value").alias("v"))
    p = c.groupBy("keyword").agg(F.avg("v").alias("a"), F.max("v").alias("hi"), F.min("v").alias("lo"), F.max_by("m", F.col("v") * 100 - F.col("m")).alias("k"))
    swing = (F.col("hi") - F.col("lo")) / F.nullif(F.col("a"), F.lit(0.0))
    return p.select("keyword", F.element_at(F.array(*map(F.lit, MONTHS)), F.col("k")).alias("peak"), F.round(swing * 100).cast("long").alias("swing_pct"), F.coalesce(swing >= 0.5, F.lit(False)).alias("strong"))


@query("i33_bar_geometry", "with e as (select least(min(expected_pct_y1), 0) a, greatest(max(expected_pct_y1), 0) b from trends) select trend_id, round((least(expected_pct_y1, 0) - a) / nullif(b - a, 0) * 100, 4) as left_pct, round(abs(expected_pct_y1) / nullif(b - a, 0) * 100, 4) as width_pct from trends, e where expected_pct_y1 is not null")
def i33(spark, d):
    """Where a bar that starts at zero begins and how wide it is, in percent of the axis."""
    t = table(spark, d, "trends").where("expected_pct_y1 is not null")
    e = t.agg(F.least(F.min("expected_pct_y1"), F.lit(0.0)).alias("a"), F.greatest(F.max("expected_pct_y1"), F.lit(0.0)).alias("b"))
    x, span = t.crossJoin(F.broadcast(e)), F.nullif(F.col("b") - F.col("a"), F.lit(0.0))  # one row
    return x.select("trend_id", F.round((F.least("expected_pct_y1", F.lit(0.0)) - F.col("a")) / span * 100, 4).alias("left_pct"), F.round(F.abs("expected_pct_y1") / span * 100, 4).alias("width_pct"))


# -- joins, windows, ranking ---------------------------------------------------------------


@query("d20_attribution", "select t.trend_id, coalesce(list_sort(list(distinct d.source) filter (d.source is not null)), []) as streams, count(distinct d.source) = 0 as unmatched from trends t left join documents d on d.matched_keyword = t.trend_name group by 1")
def d20(spark, d):
    """All streams whose documents name a trend exactly, and the trends that none names."""
    x = docs(spark, d).where("matched_keyword is not null and source is not null").select(F.col("matched_keyword").alias("trend_name"), "source").distinct()
    t = table(spark, d, "trends").select("trend_id", "trend_name").join(x, "trend_name", "left")
    g = t.groupBy("trend_id").agg(F.array_sort(F.collect_set("source")).alias("streams"))
    return g.withColumn("unmatched", F.size("streams") == 0)


_HELD = "case when count(*) over w3 = 3 then avg(value) over w3 end m"


@query("f25_onset_lag", f"with {MONTHLY_SQL}, a as (select *, {_HELD} from monthly window w3 as (partition by keyword order by month rows between 2 preceding and current row)), b as (select *, (m >= max(m) over (partition by keyword) * 0.75)::int x, (m >= max(m) over (partition by keyword) * 0.9)::int y from a), c as (select *, min(x) over w6 = 1 and count(x) over w6 = 2 hx, min(y) over w6 = 1 and count(y) over w6 = 2 hy from b window w6 as (partition by keyword order by month rows between current row and 1 following)), o as (select keyword, min(month) filter (hx) ox, min(month) filter (hy) oy, count(*) filter (value > 0) n, min(month) f from c group by 1), l as (select keyword, case when n < 24 then 'too little' when ox is null or oy is null then 'no onset' when date_diff('month', f, ox) < 3 or date_diff('month', f, oy) < 3 then 'before the series' else 'ok' end status, date_diff('month', ox, oy) lag from o) select status, count(*) as n, round(median(case when status = 'ok' then lag end), 4) as median_lag, round(quantile_cont(case when status = 'ok' then lag end, .75) - quantile_cont(case when status = 'ok' then lag end, .25), 4) as iqr from l group by 1")
def f25(spark, d):
    """The lag between two onsets, by whether it can be told: median and quartile range of those that can."""
    m = monthly(spark, d)
    a = series.onset(m, "keyword", "month", "value", 0.75, 2).withColumnRenamed("onset", "a")
    b = series.onset(m, "keyword", "month", "value", 0.9, 2).withColumnRenamed("onset", "b")
    n = m.groupBy("keyword").agg(F.count(F.when(F.col("value") > 0, 1)).alias("n"), F.min("month").alias("f"))
    early = (F.months_between("a", "f") < 3) | (F.months_between("b", "f") < 3)
    status = F.when(F.col("n") < 24, "too little").when(F.col("a").isNull() | F.col("b").isNull(), "no onset").when(early, "before the series").otherwise("ok")
    x = n.join(a, "keyword").join(b, "keyword").select(status.alias("status"), F.months_between("b", "a").alias("lag"))
    p = F.percentile(F.when(F.col("status") == "ok", F.col("lag")), F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    return x.groupBy("status").agg(F.count(F.lit(1)).alias("n"), p.alias("p")).select("status", "n", F.round(F.col("p")[1], 4).alias("median_lag"), F.round(F.col("p")[2] - F.col("p")[0], 4).alias("iqr"))


@query("f30_best_lag", f"with {MONTHLY_SQL}, a as (select month, avg(value) v from monthly group by 1), b as (select month, max(value) v from monthly group by 1), c as (select lag, round(corr(a.v, b.v), 5) as corr from (select unnest(range(-12, 13))::int lag) join a on true join b on b.month = cast(a.month + to_months(lag) as date) group by 1), t as (select lag best_lag, corr from c order by abs(corr) desc, lag limit 1) select best_lag, t.corr, round(abs(t.corr) - abs(m.corr), 4) as lead, case when best_lag = 0 then 'together' when abs(t.corr) < 0.3 then 'no relation' when abs(t.corr) - abs(m.corr) < 0.05 then 'symmetric' when best_lag > 0 then 'first leads' else 'second leads' end as verdict from t join c m on m.lag = -best_lag")
def f30(spark, d):
    """The lag of the highest correlation, how far it lies above that of the opposite lag, and what this says."""
    m = monthly(spark, d)
    a, b = (m.groupBy("month").agg(f("value").alias("value")) for f in (F.avg, F.max))
    c = series.lag_correlation(a, b, "month").withColumn("corr", F.round("corr", 5))
    best = c.orderBy(F.abs("corr").desc(), "lag").limit(1).select(F.col("lag").alias("best_lag"), "corr")
    x = best.join(c.select((-F.col("lag")).alias("best_lag"), F.col("corr").alias("other")), "best_lag")
    lead = F.abs("corr") - F.abs("other")
    verdict = F.when(F.col("best_lag") == 0, "together").when(F.abs("corr") < 0.3, "no relation").when(lead < 0.05, "symmetric").when(F.col("best_lag") > 0, "first leads").otherwise("second leads")
    return x.select("best_lag", "corr", F.round(lead, 4).alias("lead"), verdict.alias("verdict"))


@query("f32_period_labels", f"with {MONTHLY_SQL}, l as (select keyword, max(month) m from monthly group by 1) select keyword, y as year, strftime(cast(m + to_months(1 + 12 * (y - 1)) as date), '%b %Y') as first_month, strftime(cast(m + to_months(12 * y) as date), '%b %Y') as last_month from l, (select unnest([1, 2, 3, 4, 5])::int y)")
def f32(spark, d):
    """The months each year ahead of a series runs from and to."""
    l = monthly(spark, d).groupBy("keyword").agg(F.max("month").alias("m")).select("keyword", "m", F.explode(F.sequence(F.lit(1), F.lit(5))).alias("year"))  # noqa: E741
    at = lambda n: F.date_format(F.add_months("m", n), "MMM yyyy")
    return l.select("keyword", "year", at(1 + 12 * (F.col("year") - 1)).alias("first_month"), at(12 * F.col("year")).alias("last_month"))


@query("g06_top_with_promotion", "with r as (select trend_id, row_number() over (order by rank_short, trend_id) k, main_category is null x from trends where rank_short is not null), s as (select *, row_number() over (order by k) place from r where not x) select trend_id, place, k as rank, k > 20 as promoted from s where place <= 20 and (select count(*) from s) >= 20")
def g06(spark, d):
    """The first 20 of a ranking that aren't excluded; who stands below the line of 20 is promoted. Fewer than 20 give none."""
    r = running(table(spark, d, "trends").where("rank_short is not null"), [], ["rank_short", "trend_id"], None, "rank")
    s = running(r.where("main_category is not null"), [], ["rank"], None, "place").where("place <= 20").select("trend_id", "place", "rank", (F.col("rank") > 20).alias("promoted"))
    enough = s.agg((F.count(F.lit(1)) >= 20).alias("enough"))
    return s.crossJoin(F.broadcast(enough)).where("enough").drop("enough")  # one row


@query("g10_pick_pages", "with l as (select source, doc_id, link, row_number() over (partition by source order by doc_id) p from documents where source is not null and link is not null and not regexp_matches(link, '(facebook|youtube|pinterest)[.]')) select source, doc_id from l where p <= 3")
def g10(spark, d):
    """The first three links of each source that the skip list doesn't have."""
    x = docs(spark, d).where("source is not null and link is not null").where(~F.col("link").rlike("(facebook|youtube|pinterest)[.]")).select("source", "doc_id")
    return running(x, ["source"], ["doc_id"], None, "p").where("p <= 3").drop("p")


@query("g11_passages", "with b as (select distinct lower(brand_name) b from brand_list), x as (select doc_id, source, case when length(text) > 500 then 1 else 2 end kind, lower(text) t from documents where text is not null and source is not null and regexp_matches(published_at, '^202[456]-')), f as (select * from x where not exists (select 1 from b where contains(t, b))) select source, doc_id, kind from f qualify row_number() over (partition by source order by kind, doc_id) <= 12")
def g11(spark, d):
    """Twelve passages a source, whole texts before snippets, of the last years and without a listed brand."""
    names = [r[0] for r in table(spark, d, "brand_list").select(F.lower("brand_name")).distinct().collect()]  # a fixed list of about 180
    t = F.lower("text")
    x = docs(spark, d).where("text is not null and source is not null").where(F.col("published_at").rlike("^202[456]-"))
    x = x.where(~F.exists(F.array(*map(F.lit, names)), lambda b: F.contains(t, b))).select("source", "doc_id", F.when(F.length("text") > 500, 1).otherwise(2).alias("kind"))
    return running(x, ["source"], ["kind", "doc_id"], None, "p").where("p <= 12").drop("p")


@query("g12_paginate", "with t as (select trend_id, rank_short, coalesce(n_keywords, 0) >= 6 big from trends), b as (select trend_id, row_number() over (order by rank_short nulls last, trend_id) p from t where big), s as (select trend_id, (row_number() over (order by rank_short nulls last, trend_id) - 1) // 2 + 1 + (select count(*) from b) p from t where not big) select trend_id, p::bigint as page from b union all select trend_id, p::bigint from s")
def g12(spark, d):
    """Large blocks have a page each, then small ones stand two to a page."""
    t = table(spark, d, "trends").select("trend_id", "rank_short", (F.coalesce("n_keywords", F.lit(0)) >= 6).alias("big"))
    at = running(t, ["big"], [F.col("rank_short").asc_nulls_last(), "trend_id"], None, "i")
    n = at.agg(F.count(F.when(F.col("big"), 1)).alias("n"))
    return at.crossJoin(F.broadcast(n)).select("trend_id", F.when(F.col("big"), F.col("i")).otherwise(F.floor((F.col("i") - 1) / 2) + 1 + F.col("n")).cast("long").alias("page"))  # one row


@query("h02_first_by_link", "with u as (select link, doc_id p, 1 l from documents where source = 'news' and link is not null union all select link, doc_id, 2 from documents where source <> 'news' and link is not null), f as (select link, min(l * 10000000000 + p) k from u group by 1) select link, row_number() over (order by k) as place from f")
def h02(spark, d):
    """The union of two lists, each link once, in the order in which it is first seen."""
    x = docs(spark, d).where("link is not null and source is not null").select("link", F.struct(F.when(F.col("source") == "news", 1).otherwise(2).alias("l"), F.col("doc_id").alias("p")).alias("k"))
    return running(x.groupBy("link").agg(F.min("k").alias("k")), [], ["k", "link"], None, "place").select("link", "place")


@query("h06_row_concat", f"with {LISTINGS_SQL}, a as (select grp, count(*) n from lst where grp is not null group by 1), b as (select trend, count(*) n from lst where trend is not null group by 1), x as (select row_number() over (order by n desc, grp) i, grp, n from a), y as (select row_number() over (order by n desc, trend) i, trend, n from b) select i as line, grp, x.n as n_grp, trend, y.n as n_trend from x full join y using (i)")
def h06(spark, d):
    """Two tables side by side, line by line; the shorter one ends in nulls."""
    l = listings(spark, d)  # noqa: E741
    side = lambda c, n: running(l.where(f"{c} is not null").groupBy(c).agg(F.count(F.lit(1)).alias(n)), [], [F.desc(n), c], None, "line")
    return side("grp", "n_grp").join(side("trend", "n_trend"), "line", "full")


@query("j07_naive_contest", f"with {MONTHLY_SQL}, r as (select keyword, value, row_number() over (partition by keyword order by month desc) k, count(*) over (partition by keyword) n from monthly), a as (select keyword, max(value) filter (k = 7) v, max(value) filter (k = n) f, max(n) n from r group by 1), e as (select r.keyword, r.value, a.v, s.value s, a.v + (a.v - a.f) / (a.n - 7)::double * (7 - r.k) d from r join a using (keyword) join r s on s.keyword = r.keyword and s.k = r.k + 12 where r.k <= 6 and a.n >= 24), m as (select keyword, round(sqrt(avg((value - v) ** 2)), 6) persistence, round(sqrt(avg((value - s) ** 2)), 6) seasonal, round(sqrt(avg((value - d) ** 2)), 6) drift from e group by 1) select *, case when persistence <= seasonal and persistence <= drift then 'persistence' when seasonal <= drift then 'seasonal' else 'drift' end as winner from m")
def j07(spark, d):
    """Three naive forecasts of a series' last six months and which of them errs least."""
    by = Window.partitionBy("keyword")
    r = monthly(spark, d).withColumns({"k": F.row_number().over(by.orderBy(F.col("month").desc())), "n": F.count(F.lit(1)).over(by)})
    a = r.groupBy("keyword").agg(F.max(F.when(F.col("k") == 7, F.col("value"))).alias("v"), F.max(F.when(F.col("k") == F.col("n"), F.col("value"))).alias("f"))
    year = r.select("keyword", (F.col("k") - 12).alias("k"), F.col("value").alias("s"))
    e = r.where("k <= 6 and n >= 24").join(a, "keyword").join(year, ["keyword", "k"])
    e = e.withColumn("d", F.col("v") + (F.col("v") - F.col("f")) / (F.col("n") - 7) * (7 - F.col("k")))
    rmse = lambda c, n: F.round(F.sqrt(F.avg(F.pow(F.col("value") - F.col(c), 2))), 6).alias(n)
    m = e.groupBy("keyword").agg(rmse("v", "persistence"), rmse("s", "seasonal"), rmse("d", "drift"))
    return m.withColumn("winner", F.when((F.col("persistence") <= F.col("seasonal")) & (F.col("persistence") <= F.col("drift")), "persistence").when(F.col("seasonal") <= F.col("drift"), "seasonal").otherwise("drift"))


@query("l01_largest_clusters", "with g as (select p_name, count(*) size, array_to_string(list_sort(list(distinct p_brand)), ', ') members, count(distinct p_type) t from part group by 1) select p_name, size, members, case when t >= 5 then 'broad' else 'narrow' end as verdict, row_number() over (order by size desc, p_name) as place from g qualify place <= 10")
def l01(spark, d):
    """The ten largest clusters with their members' text and a verdict."""
    g = table(spark, d, "part").groupBy("p_name").agg(F.count(F.lit(1)).alias("size"), F.array_join(F.array_sort(F.collect_set("p_brand")), ", ").alias("members"), F.when(F.countDistinct("p_type") >= 5, "broad").otherwise("narrow").alias("verdict"))
    return running(g, [], [F.desc("size"), "p_name"], None, "place").where("place <= 10")


@query("l07_run_lookup", f"with {LISTINGS_SQL}, r as (select *, row_number() over (partition by trend order by sim desc nulls last, id) k from lst where trend is not null), c as (select r.trend, sum((r.grp = t.main_category)::int) n from r join trends t on t.trend_id = r.trend where k <= 5 group by 1), m as (select trend, count(*) n, max(case when k = 1 then id end) top from r group by 1) select t.trend_id, coalesce(c.n, 0) < 2 as no_close, m.top, coalesce(m.n, 0) as market_size, t.rank_short as rank from trends t left join c on c.trend = t.trend_id left join m on m.trend = t.trend_id")
def l07(spark, d):
    """What a report looks up for a trend: no close product, first product, size of the market, rank."""
    r = U.rank_in(listings(spark, d).where("trend is not null"), ["trend"], "sim", "id")
    t = table(spark, d, "trends").select("trend_id", "main_category", "rank_short")
    c = r.where("rank <= 5").join(t, F.col("trend") == F.col("trend_id")).groupBy("trend_id").agg(F.sum((F.col("grp") == F.col("main_category")).cast("int")).alias("c"))
    m = r.groupBy(F.col("trend").alias("trend_id")).agg(F.count(F.lit(1)).alias("n"), F.max(F.when(F.col("rank") == 1, F.col("id"))).alias("top"))
    x = t.join(c, "trend_id", "left").join(m, "trend_id", "left")
    return x.select("trend_id", (F.coalesce("c", F.lit(0)) < 2).alias("no_close"), "top", F.coalesce("n", F.lit(0)).alias("market_size"), F.col("rank_short").alias("rank"))


@query("l15_run_date", "select run_id, coalesce(min(case when own_reason_en is not null then exported_at end)::date, try_cast(regexp_extract(run_id, '([0-9]{4}-?[0-9]{2}-?[0-9]{2})', 1) as date), min(loaded_at)::date) as run_day from export_llm_data group by 1")
def l15(spark, d):
    """A run's day: of its first finished row, else in its name, else of its first delivery."""
    named = F.expr("try_cast(nullif(regexp_extract(run_id, '([0-9]{4}-?[0-9]{2}-?[0-9]{2})', 1), '') as date)")
    e = table(spark, d, "export_llm_data").groupBy("run_id").agg(F.to_date(F.min(F.when(F.col("own_reason_en").isNotNull(), F.col("exported_at")))).alias("a"), F.to_date(F.min("loaded_at")).alias("c"))
    return e.select("run_id", F.coalesce("a", named, "c").alias("run_day"))


@query("l19_content_waterfall", "with x as (select doc_id, nullif(trim(text), '') a, nullif(trim(title), '') b from documents), y as (select *, length(a) - length(replace(a, ' ', '')) sp from x) select doc_id, case when a is not null and length(a) >= 200 and sp * 1.0::double / length(a) >= 0.05 then 'text' when a is not null and length(a) >= 200 then 'text without spaces' when b is not null then 'title' else 'none' end as how from y")
def l19(spark, d):
    """Where a document's content comes from: its text if long enough, told from one whose spaces are lost, else its title."""
    x = docs(spark, d).select("doc_id", F.nullif(F.trim("text"), F.lit("")).alias("a"), F.nullif(F.trim("title"), F.lit("")).alias("b"))
    long = F.col("a").isNotNull() & (F.length("a") >= 200)
    ratio = (F.length("a") - F.length(F.replace(F.col("a"), F.lit(" "), F.lit("")))) / F.length("a")
    return x.select("doc_id", F.when(long & (ratio >= 0.05), "text").when(long, "text without spaces").when(F.col("b").isNotNull(), "title").otherwise("none").alias("how"))


# -- exports, gates and contexts -----------------------------------------------------------


@query("b03_star_export", "with c as (select distinct customer from export_llm_data where customer is not null and checked = 1) select 'briefs' as name, count(*) as n from c union all select 'trends', count(*) from trends union all select 'brands', count(*) from brand_list union all select 'aliases', count(*) from brand_aliases union all select 'rows', count(distinct export_id) from export_llm_data")
def b03(spark, d):
    """A star of four tables and a brief for each customer; briefs of customers who are gone go with the next export."""
    from weftline.plans.run_queries import place
    from weftline.sources import sinks

    path = place(spark, "b03_star")
    e = table(spark, d, "export_llm_data")
    rows = e.select("export_id", "customer", "trend_id", "checked").distinct()
    star = {"trends": table(spark, d, "trends"), "brands": table(spark, d, "brand_list"), "aliases": table(spark, d, "brand_aliases"), "rows": rows.select("export_id").distinct()}
    sinks.write_star(star, path)
    brief = lambda x: x.where("customer is not null").groupBy("customer").agg(F.countDistinct("trend_id").alias("n_trends"))
    for part in (rows, rows.where("checked = 1")):  # the second export replaces the first whole
        sinks.replace_whole(brief(part), f"{path}/briefs")
    out = None
    for name in (*star, "briefs"):
        n = spark.read.parquet(f"{path}/{name}").agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
        out = n if out is None else out.unionByName(n)
    return out


@query("i12_profile_gate", "with t as (select trend_id, keywords k, trend_name tn, n_keywords n from trends where trend_name is not null) select trend_id, case when k is null then 'no quote' when length(trim(split_part(tn, ' ', 1))) < 3 or not contains(lower(k), lower(split_part(tn, ' ', 1))) then 'quote not in evidence' when n >= 10 and not regexp_matches(k, '(^|[^0-9])' || n || '([^0-9]|$)') then 'number not in evidence' when trend_id like '%7' and not contains(lower(k), 'planning') then 'unsupported wording' else 'ok' end as result from t")
def i12(spark, d):
    """A profile's field against its evidence: quote, then numbers, then wording."""
    t = table(spark, d, "trends").where("trend_name is not null")
    q = F.when(F.col("keywords").isNotNull(), F.split("trend_name", " ")[0])
    said = F.concat(F.lit("People search for it"), F.when(F.col("trend_id").endswith("7"), F.lit(" when planning")).otherwise(""), F.lit(", with "), F.coalesce(F.col("n_keywords").cast("string"), F.lit("some")), F.lit(" words"))
    return t.select("trend_id", V.gate(said, q, F.col("keywords"), "worried|planning").alias("result"))


@query("i19_durability", "with v as (select trend_id, case when above_market_line = 1 then 1 when expected_pct_y1 > 5 then 1 when expected_pct_y1 < -5 then -1 else 0 end a, case when growth_score_y3 >= 0.6 then 1 when growth_score_y3 < 0.3 then -1 else 0 end b, (expected_pct_y1 < 0)::int + (growth_score_y3 < growth_score_y1)::int h, (trim(coalesce(trend_name, '')) <> '')::int + (trim(coalesce(keywords, '')) <> '')::int c from trends where expected_pct_y1 is not null and growth_score_y3 is not null and growth_score_y1 is not null), s as (select trend_id, c, greatest(5, least(95, 50 + a * 25 + b * 20 - h * 10))::int score from v) select trend_id, score, case when score >= 90 then 'durable' when score >= 70 then 'likely_durable' when score >= 55 then 'leaning_durable' when score >= 40 then 'undetermined' when score >= 25 then 'leaning_fad' else 'likely_fad' end as band, c::int as coverage, c <= 2 as insufficient from s")
def i19(spark, d):
    """Durability from the expected path and the long score; a trend confirmed across sources has its first verdict turned to +1."""
    t = table(spark, d, "trends").where("expected_pct_y1 is not null and growth_score_y3 is not null and growth_score_y1 is not null")
    sign = lambda c, hi, lo: F.when(F.col(c) >= hi, 1).when(F.col(c) < lo, -1).otherwise(0)
    first = F.when(F.col("expected_pct_y1") > 5, 1).when(F.col("expected_pct_y1") < -5, -1).otherwise(0)
    winds = F.filter(F.array(F.when(F.col("expected_pct_y1") < 0, "falling"), F.when(F.col("growth_score_y3") < F.col("growth_score_y1"), "fading")), lambda x: x.isNotNull())
    s = V.durability([(first, 25), (sign("growth_score_y3", 0.6, 0.3), 20)], [F.col("trend_name"), F.col("keywords")], winds, F.coalesce(F.col("above_market_line") == 1, F.lit(False)), 0)
    return t.select("trend_id", s.alias("s")).select("trend_id", F.col("s.score").cast("int").alias("score"), "s.band", F.col("s.coverage").cast("int").alias("coverage"), "s.insufficient")


@query("l03_keyword_columns", "with k as (select trend_id, unnest(string_split(keywords, '; ')) k, generate_subscripts(string_split(keywords, '; '), 1) i from trends where keywords is not null), f as (select trend_id, lower(trim(k)) k, min(i) i from k where trim(k) <> '' group by all) select trend_id, string_agg(k, ', ' order by i) as words, count(*) as n from f group by 1")
def l03(spark, d):
    """A trend's keywords, each once, in their order, as one column."""
    k = F.filter(F.transform(F.split("keywords", "; "), lambda x: F.lower(F.trim(x))), lambda x: x != "")
    return table(spark, d, "trends").where("keywords is not null").select("trend_id", F.array_distinct(k).alias("k")).where("size(k) > 0").select("trend_id", F.array_join("k", ", ").alias("words"), F.size("k").cast("long").alias("n"))


@query("l04_batches", "with b as (select source, (row_number() over (partition by source order by doc_id) - 1) // 8 batch, doc_id, coalesce(length(text), 0) n from documents where source is not null), m as (select source, batch, count(*) c, sum(n) n, min(doc_id) f, max(n) longest from b group by all) select source, count(*) as n_batches, sum(c)::bigint as n_docs, sum(n)::bigint as n_chars, sha256(string_agg(f || ':' || longest, ',' order by batch)) as digest from m group by 1")
def l04(spark, d):
    """Two levels of summaries: documents in batches of eight, then the batches of a source, in order."""
    x = running(docs(spark, d).where("source is not null").select("source", "doc_id", F.coalesce(F.length("text"), F.lit(0)).alias("n")), ["source"], ["doc_id"], None, "i")
    m = x.groupBy("source", F.floor((F.col("i") - 1) / 8).alias("batch")).agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("n"), F.min("doc_id").alias("f"), F.max("n").alias("longest"))
    line = F.struct("batch", F.concat(F.col("f").cast("string"), F.lit(":"), F.col("longest").cast("string")).alias("t"))
    g = m.groupBy("source").agg(F.count(F.lit(1)).alias("n_batches"), F.sum("c").alias("n_docs"), F.sum("n").alias("n_chars"), F.sort_array(F.collect_list(line)).alias("l"))
    return g.select("source", "n_batches", "n_docs", "n_chars", F.sha2(F.array_join("l.t", ","), 256).alias("digest"))


@query("k11_trend_context", f"with {LISTINGS_SQL}, r as (select *, row_number() over (partition by trend order by sim desc nulls last, id) k from lst where trend is not null), p as (select trend, count(*) n, count(distinct brand) b, string_agg(id::varchar, ' ' order by k) filter (k <= 3) top, round(max(sim), 4) best from r group by 1), e as (select trend_id, count(distinct customer) c, min(own_rank_in_category) best_rank from export_llm_data group by 1) select t.trend_id, coalesce(display_name, trend_name) as name, main_category, coalesce(p.n, 0)::bigint as n_listings, coalesce(p.b, 0)::bigint as n_brands, p.top as top_products, p.best, coalesce(e.c, 0)::bigint as n_customers, e.best_rank, len(string_split(keywords, '; '))::int as n_words from trends t left join p on p.trend = t.trend_id left join e on e.trend_id = t.trend_id")
def k11(spark, d):
    """What a trend's page needs: name, category, market, first products, customers, words."""
    l = listings(spark, d).where("trend is not null")  # noqa: E741
    top = U.top_per_group(l, ["trend"], "sim", "id", 3).groupBy("trend").agg(F.sort_array(F.collect_list(F.struct("rank", F.col("id").cast("string").alias("i")))).alias("t"))
    p = l.groupBy("trend").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("brand").alias("b"), F.round(F.max("sim"), 4).alias("best")).join(top, "trend").select(F.col("trend").alias("trend_id"), "n", "b", "best", F.array_join("t.i", " ").alias("top_products"))
    e = table(spark, d, "export_llm_data").groupBy("trend_id").agg(F.countDistinct("customer").alias("c"), F.min("own_rank_in_category").alias("best_rank"))
    t = table(spark, d, "trends").join(p, "trend_id", "left").join(e, "trend_id", "left")
    zero = lambda c: F.coalesce(c, F.lit(0))
    return t.select("trend_id", F.coalesce("display_name", "trend_name").alias("name"), "main_category", zero("n").alias("n_listings"), zero("b").alias("n_brands"), "top_products", "best", zero("c").alias("n_customers"), "best_rank", F.array_size(F.split("keywords", "; ")).alias("n_words"))


@query("k17_growth_facts_json", "select trend_id, json_object('name', trend_name, 'stream', stream_name, 'rank', rank_short, 'expected', round(expected_pct_y1)::bigint, 'words', string_split(keywords, '; '))::varchar as facts from trends where trend_name is not null and stream_name is not null and rank_short is not null and expected_pct_y1 is not null and keywords is not null")
def k17(spark, d):
    """A trend's growth facts as JSON."""
    t = table(spark, d, "trends").where("trend_name is not null and stream_name is not null and rank_short is not null and expected_pct_y1 is not null and keywords is not null")
    facts = F.to_json(F.struct(F.col("trend_name").alias("name"), F.col("stream_name").alias("stream"), F.col("rank_short").alias("rank"), F.round("expected_pct_y1").cast("long").alias("expected"), F.split("keywords", "; ").alias("words")))
    return t.select("trend_id", facts.alias("facts"))


@query("l24_refresh", "with y as (select source, try_cast(regexp_extract(published_at, '(20[0-9]{2})', 1) as int) y, lower(trim(matched_keyword)) k, loaded_at from documents where source is not null) select source as topic, min(y) as first_year, max(y) as last_year, least(count(distinct k), 25)::bigint as top_n, left(max(loaded_at)::varchar, 10) as as_of from y group by 1")
def l24(spark, d):
    """What a refresh of each source starts from: years, how many keywords to take, and as of which day."""
    y = docs(spark, d).where("source is not null").select("source", F.expr("try_cast(nullif(regexp_extract(published_at, '(20[0-9]{2})', 1), '') as int)").alias("y"), F.lower(F.trim("matched_keyword")).alias("k"), "loaded_at")
    return y.groupBy(F.col("source").alias("topic")).agg(F.min("y").alias("first_year"), F.max("y").alias("last_year"), F.least(F.countDistinct("k"), F.lit(25)).alias("top_n"), F.substring(F.max("loaded_at").cast("string"), 1, 10).alias("as_of"))


# -- word lists (fixed values) -------------------------------------------------------------

#: Phrases of bullets about delivery rather than products.
LOGISTICS = ("does not ship", "ship to", "shipping", "delivery to", "not available in", "access may be", "access to the", "eligible-order threshold")
#: Ingredients proven for decades, those still unproven, and words of novelty in names.
MATURE = (
    "niacinamide", "retinol", "retinoid", "retinal", "retinaldehyde", "tretinoin", "adapalene", "vitamin c", "ascorbic", "ascorbyl", "hyaluronic", "sodium hyaluronate", "ceramide",
    "salicylic", "bha", "glycolic", "lactic", "mandelic", "aha", "pha", "benzoyl peroxide", "azelaic", "zinc", "zinc oxide", "titanium dioxide", "panthenol", "peptide", "collagen",
    "spf", "sunscreen", "uv filter", "avobenzone", "octocrylene", "tinosorb", "mexoryl", "urea", "glycerin", "squalane", "allantoin", "centella", "cica", "madecassoside", "aloe",
    "kojic", "arbutin", "tranexamic", "shea", "argan", "jojoba", "clay", "charcoal", "amino acid", "vitamin e", "vitamin b5", "caffeine", "green tea", "witch hazel",
)
NOVEL = (
    "pdrn", "polydeoxyribonucleotide", "polynucleotide", "salmon dna", "exosome", "growth factor", "epidermal growth factor", "egf", "postbiotic", "probiotic", "prebiotic", "lysate", "ferment filtrate",
    "spermidine", "nad", "nmn", "ectoin", "ectoine", "encapsulat", "n-capsule", "nanocapsule", "microbiome", "copper tripeptide", "bioregulator", "stem cell", "pdt", "blue light",
)
SIGNALS = ("regenerativ", "innovation", "next-gen", "next gen", "breakthrough", "encapsulat", "biotech", "microbiome-first")
_list = lambda words: "[" + ", ".join(f"'{w}'" for w in words) + "]"


@query("c12_logistics_noise", f"with b as (select doc_id, unnest(string_split(text, chr(10))) t from documents where text is not null), n as (select doc_id, t, len(list_filter({_list(LOGISTICS)}, lambda w: contains(lower(t), w))) > 0 x from b where trim(t) <> '') select doc_id, count(*) filter (not x) as kept, count(*) filter (x) as noise from n group by 1")
def c12(spark, d):
    """Bullets of each document without those about delivery."""
    b = docs(spark, d).where("text is not null").select("doc_id", F.explode(F.split("text", "\n")).alias("t")).where("trim(t) != ''")
    noise = F.exists(F.array(*map(F.lit, LOGISTICS)), lambda w: F.contains(F.lower("t"), w))
    return b.groupBy("doc_id").agg(F.count(F.when(~noise, 1)).alias("kept"), F.count(F.when(noise, 1)).alias("noise"))


@query("i20_novelty", f"with t as (select doc_id, lower(coalesce(title, '')) n, lower(coalesce(title, '')) || ' | ' || lower(coalesce(text, '')) b from documents), h as (select doc_id, len(list_filter({_list(NOVEL + SIGNALS)}, lambda w: contains(n, w))) > 0 and len(list_filter({_list(MATURE)}, lambda w: contains(n, w))) = 0 by_name, len(list_filter({_list(NOVEL)}, lambda w: contains(b, w))) nov, len(list_filter({_list(MATURE)}, lambda w: contains(b, w))) mat from t) select doc_id, by_name or (nov >= 2 and mat <= nov + 1) as novel from h")
def i20(spark, d):
    """Whether a text rests on unproven ingredients."""
    return docs(spark, d).select("doc_id", V.novelty(F.col("title"), F.array(F.coalesce("text", F.lit(""))), list(MATURE), list(NOVEL), list(SIGNALS)).alias("novel"))


@query("i32_growth_helpers", "select trend_id, case when growth_score_y3 is null then null when growth_score_y3 >= .8 then 4 when growth_score_y3 >= .5 then 3 when growth_score_y3 >= .2 then 2 else 1 end as long_grade, case when expected_pct_y1 > 0 then '+' else '' end || round(expected_pct_y1)::bigint || '%' as growth, (floor(expected_pct_y1 / 10) * 10)::bigint as tick from trends where expected_pct_y1 is not null")
def i32(spark, d):
    """A trend's long grade, its growth as text and the tick of the axis it lies above."""
    from weftline.functions.semantics import grade

    t = table(spark, d, "trends").where("expected_pct_y1 is not null")
    p = F.col("expected_pct_y1")
    return t.select("trend_id", grade(F.col("growth_score_y3")).alias("long_grade"), F.concat(F.when(p > 0, "+").otherwise(""), F.round(p).cast("long").cast("string"), F.lit("%")).alias("growth"), (F.floor(p / 10) * 10).cast("long").alias("tick"))


@query("f26_boxes", f"with {MONTHLY_SQL}, c as (select p_name keyword, p_type cluster from part group by all), g as (select cluster, month, avg(value) far from monthly join c using (keyword) group by 1, 2), s as (select m.keyword, c.cluster, m.month, g.far, m.value near from monthly m join c using (keyword) join g using (cluster, month)), k as (select unnest([date '1998-06-01', date '1999-06-01']) cutoff), w as (select cutoff, keyword || '/' || cluster entity, avg(far) filter (x between -11 and 0) f1, avg(far) filter (x between -23 and -12) f0, avg(near) filter (x between -11 and 0) n1, avg(near) filter (x between -23 and -12) n0, count(*) filter (x between -23 and 24) n from (select *, date_diff('month', cutoff, month) x from s, k) group by 1, 2) select cutoff, entity, case when (f1 + 1) / (f0 + 1) >= 1.02 and (n1 + 1) / (n0 + 1) >= 1.02 then 'both grow' when (f1 + 1) / (f0 + 1) >= 1.02 then 'window' when (n1 + 1) / (n0 + 1) >= 1.02 then 'local only' else 'both flat' end as box from w where n = 48")
def f26(spark, d):
    """The box of each keyword at two cut-offs: whether its cluster grows, and whether it does itself."""
    from weftline.sources.standins import mapping

    m = monthly(spark, d).join(mapping(spark, d), "keyword")
    far = m.groupBy("cluster", "month").agg(F.avg("value").alias("far"))
    s = m.join(far, ["cluster", "month"]).select(F.concat_ws("/", "keyword", "cluster").alias("entity"), "month", "far", F.col("value").alias("near"))
    return A.growth_points(s, "entity", "month", "far", "near", ["1998-06-01", "1999-06-01"], 24, 1.02, 0.0).select("cutoff", "entity", "box")


@query("f36_spearman", "with r as (select event_type, rank() over (partition by event_type order by value) + (count(*) over (partition by event_type, value) - 1) / 2.0::double a, rank() over (partition by event_type order by user_id) + (count(*) over (partition by event_type, user_id) - 1) / 2.0::double b, row_number() over (partition by event_type order by value desc, event_id) p, row_number() over (partition by event_type order by user_id desc, event_id) q, count(*) over (partition by event_type) n from events where value is not null and user_id is not null) select event_type, count(*) as n, round(corr(a, b), 6) as spearman, round(sum((p <= floor(n * 0.2) and q <= floor(n * 0.2))::int) / max(floor(n * 0.2))::double, 6) as top_hit_rate from r group by 1")
def f36(spark, d):
    """Rank correlation of a prediction with what came, and how much of its best fifth was among the best fifth."""
    from weftline.operators.learn import spearman
    from weftline.operators.ranking import with_total

    e = table(spark, d, "events").where("value is not null and user_id is not null").select("event_id", "event_type", "value", "user_id")
    r = running(e, ["event_type"], [F.desc("value"), "event_id"], None, "p")
    r = with_total(running(r, ["event_type"], [F.desc("user_id"), "event_id"], None, "q"), ["event_type"], "m")
    k = F.floor(F.col("m") * 0.2)
    hits = r.groupBy("event_type").agg((F.sum(((F.col("p") <= k) & (F.col("q") <= k)).cast("int")) / F.max(k)).alias("h"))
    return spearman(e, ["event_type"], "value", "user_id").join(hits.select("event_type", F.round("h", 6).alias("top_hit_rate")), "event_type")


@query("l05_ranked_reader", "with n as (select greatest(1, least(count(*), 25)) n from trends where rank_short is not null) select trend_id, rank_short, place::int as place from (select trend_id, rank_short, row_number() over (order by rank_short, trend_id) place from trends where rank_short is not null), n where place <= n")
def l05(spark, d, environment: dict | None = None):
    """The ranked list in order. How many are read is said by TREND_TOP_N: a number, or all; 25 where nothing or nonsense is said."""
    import os

    said = (os.environ if environment is None else environment).get("TREND_TOP_N", "").strip().lower()
    n = None if said == "all" else int(said) if said.isdigit() and int(said) else 25
    r = running(table(spark, d, "trends").where("rank_short is not null"), [], ["rank_short", "trend_id"], None, "place").select("trend_id", "rank_short", F.col("place").cast("int").alias("place"))
    return r if n is None else r.where(F.col("place") <= n)


@query("l16_question_keywords", "with t as (select term_of, unnest(terms) w from (values ('Skin Care', ['serum', 'moisturiser', 'ครีม']), ('Hair Care', ['shampoo', 'conditioner', 'แชมพู']), ('Fragrances', ['perfume', 'น้ำหอม'])) v(term_of, terms)), w as (select trend_id, unnest(regexp_split_to_array(lower(regexp_replace(replace(trend_name || ' -site:a.invalid', '\"', ' '), '-site:[^ ]+', ' ', 'g')), ' +')) w from trends where trend_name is not null union select trend_id, w from trends join t on t.term_of = main_category) select trend_id, string_agg(distinct w, ' ' order by w) as keywords from w where length(w) >= 3 and w not in ('and', 'care', 'the', 'for', 'rising') group by 1")
def l16(spark, d):
    """A question's keywords: the terms of its category and the words of its query, without sites, short words and stop words."""
    terms = {"Skin Care": ["serum", "moisturiser", "ครีม"], "Hair Care": ["shampoo", "conditioner", "แชมพู"], "Fragrances": ["perfume", "น้ำหอม"]}
    t = table(spark, d, "trends")
    of = F.lit(None).cast("array<string>")
    for c, words in terms.items():
        of = F.when(F.col("main_category") == c, F.array(*map(F.lit, words))).otherwise(of)
    q = F.regexp_replace(F.replace(F.concat("trend_name", F.lit(" -site:a.invalid")), F.lit('"'), F.lit(" ")), "-site:[^ ]+", " ")
    words = F.concat(F.coalesce(F.split(F.lower(q), " +"), F.array().cast("array<string>")), F.coalesce(of, F.array().cast("array<string>")))
    kept = F.filter(F.array_distinct(words), lambda w: (F.length(w) >= 3) & ~w.isin("and", "care", "the", "for", "rising"))
    return t.select("trend_id", F.array_join(F.array_sort(kept), " ").alias("keywords")).where("keywords != ''")


@query("l34_evidence_lines", "with p as (select matched_keyword k, list_sort(list(distinct source)) s, count(*) n from documents where matched_keyword is not null and source is not null group by 1) select k as keyword, n || ' documents from ' || case when len(s) = 1 then s[1] else array_to_string(s[1:len(s) - 1], ', ') || ' and ' || s[-1] end as line from p")
def l34(spark, d):
    """What a keyword rests on: how many documents, from which sources."""
    from weftline.operators.report import place_phrase

    p = docs(spark, d).where("matched_keyword is not null and source is not null").groupBy(F.col("matched_keyword").alias("keyword")).agg(F.array_sort(F.collect_set("source")).alias("s"), F.count(F.lit(1)).alias("n"))
    return p.select("keyword", F.concat(F.col("n").cast("string"), F.lit(" documents from "), place_phrase(F.col("s"))).alias("line"))


# -- catalogue and caches ------------------------------------------------------------------


@query("e33_models_used", "with e as (select distinct export_id, run_id, quadrant, fit_level from export_llm_data where run_id is not null), s as (select run_id, quadrant as model, fit_level as stage, count(*) n from e where quadrant is not null and fit_level is not null group by all) select run_id, model, sum(n)::bigint as calls, count(*) as stages from s group by 1, 2")
def e33(spark, d):
    """How often each model was called in a run, summed over its stages."""
    e = table(spark, d, "export_llm_data").where("run_id is not null and quadrant is not null and fit_level is not null").select("export_id", "run_id", "quadrant", "fit_level").distinct()
    s = e.groupBy("run_id", F.col("quadrant").alias("model"), "fit_level").agg(F.count(F.lit(1)).alias("n"))
    return s.groupBy("run_id", "model").agg(F.sum("n").alias("calls"), F.count(F.lit(1)).alias("stages"))


@query("g09_type_distribution", f"with {LISTINGS_SQL}, m as (select trend, count(*) n from lst group by 1), r as (select lst.*, m.n, row_number() over (partition by lst.trend order by sim desc nulls last, id) k from lst join m on m.trend is not distinct from lst.trend), pool as (select * from r where k <= greatest(1, round_even(n * 0.05::double, 0)::int)), c as (select trend, sub, count(*) n from pool group by all), q as (select trend, sub, n, row_number() over (partition by trend order by n desc, sub nulls last) k, sum(n) over (partition by trend) t from c) select trend, case when k <= 5 then sub end as kind, k > 5 as rest, sum(n)::bigint as n, round(sum(n) / max(t)::double, 6) as share from q group by all")
def g09(spark, d):
    """The five commonest kinds of a trend's pool and the rest, with their shares."""
    c = U.pool_of(listings(spark, d), "trend", "sim", "id", 0.05).groupBy("trend", "sub").agg(F.count(F.lit(1)).alias("n"))
    k = F.row_number().over(Window.partitionBy("trend").orderBy(F.col("n").desc(), F.col("sub").asc_nulls_last()))
    c = c.withColumns({"k": k, "t": F.sum("n").over(Window.partitionBy("trend"))})  # a row a kind
    g = c.groupBy("trend", F.when(F.col("k") <= 5, F.col("sub")).alias("kind"), (F.col("k") > 5).alias("rest")).agg(F.sum("n").alias("n"), F.max("t").alias("t"))
    return g.select("trend", "kind", "rest", "n", F.round(F.col("n") / F.col("t"), 6).alias("share"))


@query("i04_classify", "select distinct listing_id, case when regexp_matches(lower(product_name), 'wax strip|eye patch') then 'Tools' when regexp_matches(lower(product_name), 'sunscreen|sunblock|spf ?[0-9]') then 'Sun Care' when regexp_matches(lower(product_name), 'shampoo|conditioner|แชมพู') then 'Hair Care' when regexp_matches(lower(product_name), 'serum|toner|moistur') then 'Skin Care' when product_group is not null then product_group when subgroup is not null then 'by ' || subgroup else 'rest' end as class, case when regexp_matches(lower(product_name), 'professional|paris') then 'premium' when sale_price_thb >= 1000 then 'premium' when sale_price_thb is null then null else 'mass' end as segment from validate_at_scale_nvidia")
def i04(spark, d):
    """Class by ordered rules on the name, then the catalogue's labels; the segment by an override in the name, else by price."""
    n = F.lower("product_name")
    has = lambda p: F.coalesce(n.rlike(p), F.lit(False))
    rules = [(has("wax strip|eye patch"), "Tools"), (has("sunscreen|sunblock|spf ?[0-9]"), "Sun Care"), (has("shampoo|conditioner|แชมพู"), "Hair Care"), (has("serum|toner|moistur"), "Skin Care")]
    rest = F.coalesce("product_group", F.concat(F.lit("by "), "subgroup"), F.lit("rest"))
    segment = F.when(has("professional|paris"), "premium").when(F.col("sale_price_thb") >= 1000, "premium").when(F.col("sale_price_thb").isNull(), None).otherwise("mass")
    return table(spark, d, "validate_at_scale_nvidia").select("listing_id", C.classify(rules, rest).alias("class"), segment.alias("segment")).distinct()


@query("i05_taxonomy_resolve", "with v as (select distinct listing_id, product_group g, subgroup sub, lower(coalesce(product_name, '')) nm, sale_price_thb p from validate_at_scale_nvidia), t as (select g, sub, count(*) n from (select distinct listing_id, g, sub from v where g is not null and sub is not null) group by all), b as (select sub, first(g order by n desc, g) parent from t group by 1), s as (select sub from t group by 1) select distinct v.listing_id, case when v.g is null and regexp_matches(nm, '(^|[^a-z])(men|for men|homme)([^a-z]|$)') then 'Grooming' else coalesce(v.g, b.parent) end as grp, coalesce(v.sub, (select min(sub) from s where contains(v.nm, rtrim(lower(sub), 's')))) as sub, case when p is null then null when p >= 1000 then 'premium' else 'mass' end as tier from v left join b on v.sub = b.sub")
def i05(spark, d):
    """Parent of a subgroup by majority, or by words of gender where it is missing; a missing subgroup by its name in the text; premium or mass by price."""
    v = table(spark, d, "validate_at_scale_nvidia").select("listing_id", F.col("product_group").alias("g"), F.col("subgroup").alias("sub"), F.lower(F.coalesce("product_name", F.lit(""))).alias("nm"), F.col("sale_price_thb").alias("p")).distinct()
    n = v.where("g is not null and sub is not null").select("listing_id", "g", "sub").distinct().groupBy("sub", "g").agg(F.count(F.lit(1)).alias("n"))
    parent = n.groupBy("sub").agg(F.min_by("g", F.struct(-F.col("n"), F.col("g"))).alias("parent"))
    names = sorted(r[0] for r in n.select("sub").distinct().limit(5000).collect())  # the subgroups of a taxonomy
    if len(names) == 5000:
        raise ValueError("more than 5,000 subgroups: join them by their words")
    told = F.array_min(F.filter(F.array(*map(F.lit, names)), lambda s: F.contains(F.col("nm"), F.rtrim(F.lower(s), F.lit("s")))))
    grp = F.when(F.col("g").isNull() & F.col("nm").rlike("(^|[^a-z])(men|for men|homme)([^a-z]|$)"), "Grooming").otherwise(F.coalesce("g", "parent"))
    tier = F.when(F.col("p").isNull(), None).when(F.col("p") >= 1000, "premium").otherwise("mass")
    return v.join(parent, "sub", "left").select("listing_id", grp.alias("grp"), F.coalesce("sub", told).alias("sub"), tier.alias("tier")).distinct()


@query("i27_product_text", "with r as (select own_listing_id listing_id, min(own_reason_en) reason from export_llm_data where own_reason_en is not null group by 1), p as (select distinct v.listing_id, concat_ws(' | ', product_name, brand, product_group, subgroup, left(reason, 500)) t from validate_at_scale_nvidia v left join r using (listing_id)) select listing_id, sha256(t) as digest, length(t) as n_chars from p")
def i27(spark, d):
    """The text a product is embedded by: name, brand, labels and the start of what is said of it."""
    r = table(spark, d, "export_llm_data").where("own_reason_en is not null").groupBy(F.col("own_listing_id").alias("listing_id")).agg(F.min("own_reason_en").alias("reason"))
    v = table(spark, d, "validate_at_scale_nvidia").select("listing_id", "product_name", "brand", "product_group", "subgroup").distinct().join(r, "listing_id", "left")
    t = F.concat_ws(" | ", "product_name", "brand", "product_group", "subgroup", F.substring("reason", 1, 500))
    return v.select("listing_id", F.sha2(t, 256).alias("digest"), F.length(t).cast("long").alias("n_chars")).distinct()


@query("j10_embedding_cache", "with t as (select distinct sha256(product_name) digest, length(product_name) n from validate_at_scale_nvidia where product_name is not null), c as (select distinct sha256(own_product) digest from export_llm_data where own_product is not null) select t.digest, case when c.digest is not null then 'cached' when n % 50 = 7 then 'failed' else 'embedded' end as status from t left join c using (digest)")
def j10(spark, d):
    """Texts to embed: known digests come from the cache, equal texts are embedded once, failures are told and
    not kept; more than a tenth of failures stops the run."""
    from weftline.plans.run_queries import place
    from weftline.sources.readers import embedded

    def embed(texts):
        return texts.map(lambda t: None if len(t) % 50 == 7 else [float(len(t)), 1.0])

    path = place(spark, "j10_cache")
    known = table(spark, d, "export_llm_data").where("own_product is not null").select(F.sha2("own_product", 256).alias("digest"), F.array(F.lit(1.0)).alias("vector")).dropDuplicates(["digest"])
    known.write.parquet(path)
    texts = table(spark, d, "validate_at_scale_nvidia").where("product_name is not null").select(F.col("product_name").alias("text"))
    return embedded(texts, "text", spark.read.parquet(path), path, F.pandas_udf(embed, "array<double>")).select("digest", "status")


_WS = "[\\t\\n\\f\\r\\x0b ]+"
_LONG = "len(list_filter(string_split(regexp_replace(t, '([{}])" + _WS + "', '\\1' || chr(1), 'g'), chr(1)), lambda s: len(regexp_split_to_array(trim(s, ' '), '" + _WS + "')) > {}))"


@query("i37_lint", f"with d as (select doc_id, coalesce(text, '') t from documents) select doc_id, {_LONG.format('.!?', 25)} as n_long, {_LONG.format('.!?,;:', 15)} as n_clauses, case when regexp_matches(t, '[฀-๿]') then len(regexp_extract_all(t, '[A-Za-z]{{4,}}')) else 0 end as n_foreign, len(regexp_extract_all(t, '\\{{[A-Za-z_]+\\}}|https?://|<\\|')) as n_leaks from d")
def i37(spark, d):
    """Faults of a text that a reader would stumble over."""
    from weftline.operators.report import lint

    return docs(spark, d).select("doc_id", lint(F.col("text"), 25).alias("l")).select("doc_id", "l.*")


@query("k13_search_stream", "with s as (select source l1, lower(matched_keyword) q, coalesce(source_region, '?') place, doc_id from documents where source is not null and matched_keyword is not null), t as (select l1, split_part(q, ' ', 1) theme, count(distinct q) n_searches, count(distinct place) n_places, count(*) n_documents, count(distinct case when q in (select lower(trend_name) from trends where trend_name is not null) then q end) n_trends from s group by all) select *, row_number() over (partition by l1 order by n_places desc, n_searches desc, n_documents desc, theme)::int as place from t")
def k13(spark, d):
    """Searches of each category by theme - the first word -, with places, documents and the trends they are, in the order of candidates."""
    trends = table(spark, d, "trends").where("trend_name is not null").select(F.lower("trend_name").alias("q"), F.lit(1).alias("is_trend")).distinct()
    s = docs(spark, d).where("source is not null and matched_keyword is not null").select(F.col("source").alias("l1"), F.lower("matched_keyword").alias("q"), F.coalesce("source_region", F.lit("?")).alias("p")).join(trends, "q", "left")
    t = s.groupBy("l1", F.split("q", " ")[0].alias("theme")).agg(F.countDistinct("q").alias("n_searches"), F.countDistinct("p").alias("n_places"), F.count(F.lit(1)).alias("n_documents"), F.countDistinct(F.when(F.col("is_trend") == 1, F.col("q"))).alias("n_trends"))
    return running(t, ["l1"], [F.desc("n_places"), F.desc("n_searches"), F.desc("n_documents"), "theme"], None, "place").withColumn("place", F.col("place").cast("int"))
