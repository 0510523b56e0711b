"""Queries of the market operators, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftline.operators import market as M
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


SHARES_SQL = """rev as (select p_type category, p_brand brand, year(l_shipdate) as year, round(sum(l_extendedprice * (1 - l_discount)), 4) r from lineitem join part on l_partkey = p_partkey group by all),
shares as (select category, brand, 'Owner ' || (cast(substr(brand, 7) as int) % 5) as owner, year, round(r / sum(r) over (partition by category, year) * 100, 6) as share from rev)"""
SIZES_SQL = "sizes as (select category, year, round(sum(r), 4) as value from rev group by all)"


def shares(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").select(F.col("p_partkey").alias("k"), F.col("p_type").alias("category"), F.col("p_brand").alias("brand"))
    li = table(spark, d, "lineitem").select(F.col("l_partkey").alias("k"), F.year("l_shipdate").alias("year"), (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("r"))
    rev = li.groupBy("k", "year").agg(F.sum("r").alias("r")).join(p, "k").groupBy("category", "brand", "year").agg(F.round(F.sum("r"), 4).alias("r"))
    share = F.round(F.col("r") / F.sum("r").over(Window.partitionBy("category", "year")) * 100, 6)
    owner = F.concat(F.lit("Owner "), (F.substring("brand", 7, 9).cast("int") % 5).cast("string"))
    return rev.withColumns({"owner": owner, "share": share})


def sizes(spark, d):
    return shares(spark, d).groupBy("category", "year").agg(F.round(F.sum("r"), 4).alias("value"))


@query("e21_size_facts", f"with {SHARES_SQL}, {SIZES_SQL}, g as (select category, max(case when year = 1996 then value end) b, max(case when year = 1999 then value end) l, max(case when year = 2000 then value end) a from sizes group by 1) select category, b as base, l as last, a as ahead, round((pow(l / b, 1 / 3.0::double) - 1) * 100, 4) as cagr, round((a / l - 1) * 100, 4) as cagr_ahead, round(l / sum(l) over () * 100, 4) as share from g")
def e21(spark, d):
    return M.size_facts(sizes(spark, d), "category", 1996, 1999, 2000)


@query("k08_tidy_unpivot", f"with {SHARES_SQL}, {SIZES_SQL} select category, year, value from sizes where year between 1996 and 2000")
def k08(spark, d):
    wide = sizes(spark, d).groupBy("category").pivot("year", [1996, 1997, 1998, 1999, 2000]).agg(F.first("value"))
    return M.tidy(wide.toDF("category", *(f"{y} (%)" for y in range(1996, 2001))), ["category"])


@query("e19_brand_shares", f"with {SHARES_SQL} select category, brand, year, min(owner) as owner, sum(share) as share from shares group by all")
def e19(spark, d):
    return M.brand_shares(shares(spark, d), ["category", "brand", "year"], "owner", "share")


_CUTSHARES = "s as (select category, brand, owner, year, share from shares where not (brand in ('Brand#3', 'Brand#7') and year <= 1997) and not (brand in ('Brand#8', 'Brand#4') and year >= 1999))"


def _cut_shares(spark, d):
    s = shares(spark, d).drop("r")
    return s.where(~(F.col("brand").isin("Brand#3", "Brand#7") & (F.col("year") <= 1997)) & ~(F.col("brand").isin("Brand#8", "Brand#4") & (F.col("year") >= 1999)))


@query("e20_brand_facts", f"""with {SHARES_SQL}, {_CUTSHARES}, g as (select category, brand, max(case when year = 1996 then share end) b, max(case when year = 2000 then share end) l from s group by all), c as (select *, round(coalesce(l, 0) - coalesce(b, 0), 6) ch from g),
r as (select *, row_number() over (partition by category order by l desc nulls last, brand) t, row_number() over (partition by category order by ch desc, brand) u, row_number() over (partition by category order by ch, brand) dn from c)
select category, kind, brand, b as base, l as last, ch as change from (select *, 'top' kind from r where t <= 5 and l is not null union all select *, 'new' from r where b is null and l is not null union all select *, 'dropped' from r where b is not null and l is null union all select *, 'gaining' from r where u <= 5 and ch > 0 union all select *, 'losing' from r where dn <= 5 and ch < 0)""")
def e20(spark, d):
    return M.brand_facts(_cut_shares(spark, d), "category", "brand", 1996, 2000)


@query("e20_concentration", f"with {SHARES_SQL}, {_CUTSHARES}, r as (select *, row_number() over (partition by category, year order by share desc nulls last, brand) k from s) select category, year, round(sum(share) filter (k <= 5), 6) as top_share, count(share) as n_brands from r group by all")
def e20c(spark, d):
    return M.concentration(_cut_shares(spark, d), "category", "brand")


@query("d16_succession", f"""with {SHARES_SQL}, {_CUTSHARES}, l as (select category, owner, brand, max(year) y, arg_max(share, year) loss from s group by all), e as (select * from l where y < (select max(year) from s)),
g as (select category, owner, brand, year, share - coalesce(lag(share) over (partition by category, owner, brand order by year), 0) g from s), p as (select e.category, e.brand, g.brand into_, g.g from e join g on e.category = g.category and e.owner = g.owner and g.brand <> e.brand and g.year = e.y + 1 and g.g >= 0.02 * loss)
select category, brand, first(into_ order by g desc, into_) as "into" from p group by all""")
def d16(spark, d):
    x = _cut_shares(spark, d).withColumn("words", F.split(F.regexp_replace("brand", "#", " "), " "))
    return M.succession(x, "category", "brand", "owner", "words", 0.02)


CHANNEL_SQL = "ch as (select p_type category, l_returnflag channel, year(l_shipdate) as year, count(*) n from lineitem join part on l_partkey = p_partkey group by all), chs as (select category, channel, year, round(n / sum(n) over (partition by category, year)::double * 100, 4) as value from ch)"


def channels(spark, d):
    p = table(spark, d, "part").select(F.col("p_partkey").alias("k"), F.col("p_type").alias("category"))
    li = table(spark, d, "lineitem").select(F.col("l_partkey").alias("k"), F.col("l_returnflag").alias("channel"), F.year("l_shipdate").alias("year"))
    n = li.groupBy("k", "channel", "year").agg(F.count(F.lit(1)).alias("n")).join(p, "k").groupBy("category", "channel", "year").agg(F.sum("n").alias("n"))
    return n.withColumn("value", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("category", "year")) * 100, 4))


@query("e22_channel_facts", f"with {CHANNEL_SQL}, g as (select category, channel, max(case when year = 1996 then value end) b, max(case when year = 2000 then value end) l from chs group by all) select category, channel, b as base, l as last, round(l - b, 4) as change, row_number() over (partition by category order by abs(round(l - b, 4)) desc nulls last, channel) as place from g")
def e22(spark, d):
    return M.channel_facts(channels(spark, d), "category", "channel", 1996, 2000)


@query("e23_premium_share", "select p_type as category, year(l_shipdate) as year, round(sum(case when p_retailprice > 1200 then l_quantity else 0 end) / sum(l_quantity), 6) as premium_share from lineitem join part on l_partkey = p_partkey group by all")
def e23(spark, d):
    p = table(spark, d, "part").select(F.col("p_partkey").alias("k"), F.col("p_type").alias("category"), (F.col("p_retailprice") > 1200).alias("hi"))
    li = table(spark, d, "lineitem").select(F.col("l_partkey").alias("k"), F.year("l_shipdate").alias("year"), "l_quantity").groupBy("k", "year").agg(F.sum("l_quantity").alias("q"))
    return li.join(p, "k").groupBy("category", "year").agg(F.round(F.sum(F.when(F.col("hi"), F.col("q")).otherwise(0.0)) / F.sum("q"), 6).alias("premium_share"))


@query("e24_launches_by_year", "select year(o_orderdate) as year, count(*) as n, round(avg((o_orderstatus <> 'F')::int), 6) as import_share, round(1 - avg((o_custkey % 3 = 0)::int), 6) as untracked_share from orders group by 1")
def e24(spark, d):
    return M.launches_by_year(table(spark, d, "orders"), "o_orderdate", F.col("o_orderstatus") != "F", F.col("o_custkey") % 3 == 0)


@query("e24_new_brands", "select year, count(*) as n_new from (select o_custkey, min(year(o_orderdate)) as year from orders group by 1) group by 1")
def e24b(spark, d):
    return M.new_brands(table(spark, d, "orders"), "o_custkey", "o_orderdate")


@query("e25_complete_through", "with m as (select cast(date_trunc('month', o_orderdate) as date) as month, count(*) n from orders group by 1) select max(month) as through from m where n >= (select median(n) * 0.5 from m)")
def e25(spark, d):
    return M.complete_through(table(spark, d, "orders"), "o_orderdate")


@query("e26_brand_tiers", "select p_brand, case when bool_or(p_retailprice > 1200) and bool_or(p_retailprice <= 1200) then 'both' when bool_or(p_retailprice > 1200) then 'premium' else 'mass' end as tier from part group by 1")
def e26(spark, d):
    return M.brand_tiers(table(spark, d, "part"), "p_brand", F.col("p_retailprice") > 1200)


@query("e27_most_common_name", "with c as (select p_brand, p_name, count(*) n from part group by all) select p_brand, first(p_name order by n desc, p_name) as p_name, max(n) as n from c group by 1")
def e27(spark, d):
    return M.most_common(table(spark, d, "part"), "p_brand", "p_name")


@query("c06_canonical_spelling", "with b as (select distinct listing_id, brand from validate_at_scale_nvidia where brand is not null), k as (select upper(regexp_replace(brand, '[^0-9A-Za-z]', '', 'g')) as key, brand from b), c as (select key, brand, count(*) n from k group by all) select key, first(brand order by n desc, brand) as brand, max(n) as n from c group by 1")
def c06(spark, d):
    b = table(spark, d, "validate_at_scale_nvidia").select("listing_id", "brand").where("brand is not null").distinct()
    return M.most_common(b.withColumn("key", F.upper(F.regexp_replace("brand", "[^0-9A-Za-z]", ""))), "key", "brand")


@query("e28_trajectory", "with y as (select o_custkey % 50 key, year(o_orderdate) as year from orders), g as (select key, year from (select distinct key from y), (select unnest([1996, 1997, 2010]) as year)) select g.key, g.year, count(y.key) as n from g left join y on g.key = y.key and g.year = y.year group by all")
def e28(spark, d):
    x = table(spark, d, "orders").select((F.col("o_custkey") % 50).alias("key"), F.year("o_orderdate").alias("year"))
    return M.trajectory(x, "key", "year", [1996, 1997, 2010])


_FACTS = f"with {CHANNEL_SQL}, g as (select category, max(case when year = 1996 and channel = 'A' then value end) b, max(case when year = 2000 and channel = 'A' then value end) l from chs group by 1), f as (select category, round(l - b, 4) change, l from g), h as (select category, 'channel up' factor from f where change > 0 union all select category, 'channel down' from f where change < 0 union all select category, 'channel large' from f where l > 33)"


def _factors(spark, d):
    f = M.channel_facts(channels(spark, d), "category", "channel", 1996, 2000).where("channel = 'A'")
    return M.factors(f, "category", {"channel up": F.col("change") > 0, "channel down": F.col("change") < 0, "channel large": F.col("last") > 33})


@query("i39_factors", f"{_FACTS} select category, factor from h")
def i39(spark, d):
    return _factors(spark, d)


@query("i38_questions", f"{_FACTS} select category, factor, case factor when 'channel up' then 'Why do shops gain in ' || category || '?' when 'channel down' then 'Why do shops lose in ' || category || '?' else 'Who leads the shops of ' || category || '?' end as question from h")
def i38(spark, d):
    return M.questions(_factors(spark, d), "category", {"channel up": "Why do shops gain in {}?", "channel down": "Why do shops lose in {}?", "channel large": "Who leads the shops of {}?"})


@query("g05_mark_leaves", """with h as (select p_brand g, p_partkey pos, p_partkey % 3 lv, p_size > 20 has from part), p as (select a.g, a.pos, a.lv, a.has, b.pos q, b.lv m, b.has bh from h a join h b on a.g = b.g and b.pos > a.pos), s as (select g, pos, min(q) stop from p where m <= lv group by all),
d as (select distinct p.g, p.pos from p left join s on p.g = s.g and p.pos = s.pos where bh and m > lv and (stop is null or q < stop)) select h.g, h.pos, h.has and d.pos is null as leaf from h left join d on h.g = d.g and h.pos = d.pos""")
def g05(spark, d):
    h = table(spark, d, "part").select(F.col("p_brand").alias("g"), F.col("p_partkey").alias("pos"), (F.col("p_partkey") % 3).cast("int").alias("lv"), (F.col("p_size") > 20).alias("has"))
    return M.mark_leaves(h, "g", "pos", "lv", "has").select("g", "pos", "leaf")


PMC = "pmc as (select distinct series_id, pub_month, keyword, journal_slug, papers, full_text, words from pmc_timeseries)"


def pmc(spark, d):
    return table(spark, d, "pmc_timeseries").select("series_id", "pub_month", "keyword", "journal_slug", "papers", "full_text", "words").distinct()


@query("e16_literature_rollup", f"with {PMC} select pub_month, case when grouping(keyword) = 1 then '__all__' else keyword end as keyword, sum(papers)::bigint as papers, sum(words)::bigint as words, round(sum(words) / nullif(sum(papers), 0)::double, 6) as words_per_paper from pmc where keyword is not null and keyword <> '__all__' group by grouping sets ((pub_month, keyword), (pub_month))")
def e16(spark, d):
    x = pmc(spark, d).where("keyword is not null and keyword <> '__all__'")
    g = M.with_total(x, ["pub_month", "keyword"], ["pub_month"], "__all__", [F.sum("papers").alias("papers"), F.sum("words").alias("words")])
    return g.withColumn("words_per_paper", F.round(F.try_divide(F.col("words"), F.col("papers")), 6))


@query("e17_facets", f"with {PMC}, c as (select 'journal_slug' facet, journal_slug as value, count(*) n from pmc group by all union all select 'keyword', keyword, count(*) from pmc group by all union all select 'pub_month', pub_month, count(*) from pmc group by all), r as (select *, row_number() over (partition by facet order by n desc, value) as place from c where value is not null) select facet, value, n, place from r where place <= 10")
def e17(spark, d):
    return M.facets(pmc(spark, d), ["journal_slug", "keyword", "pub_month"], 10)


@query("e18_harvest_summary", f"with {PMC} select substr(pub_month, 1, 4) as year, count(*) as n, count(distinct journal_slug) as n_journals, count(distinct keyword) as n_keywords, sum((full_text < papers)::int)::bigint as thin from pmc where regexp_matches(pub_month, '^[0-9]{{4}}-[0-9]{{2}}$') group by 1")
def e18(spark, d):
    x = pmc(spark, d).where(F.col("pub_month").rlike("^[0-9]{4}-[0-9]{2}$"))
    return x.groupBy(F.substring("pub_month", 1, 4).alias("year")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("journal_slug").alias("n_journals"), F.countDistinct("keyword").alias("n_keywords"), F.sum((F.col("full_text") < F.col("papers")).cast("int")).alias("thin"))


EV = "ev as (select event_type l1, 'p' || (user_id % 3) place, json_extract_string(props, '$.k') q, value from events)"


def searches(spark, d):
    e = table(spark, d, "events")
    return e.select(F.col("event_type").alias("l1"), F.concat(F.lit("p"), (F.col("user_id") % 3).cast("string")).alias("place"), F.get_json_object("props", "$.k").alias("q"), "value", "event_id")


@query("e11_query_places", "with " + EV + " select l1, q, count(distinct place) as n_places, max(value) as top from ev where q is not null group by all")
def e11(spark, d):
    return searches(spark, d).where("q is not null").groupBy("l1", "q").agg(F.countDistinct("place").alias("n_places"), F.max("value").alias("top"))


@query("e12_theme_stats", "with " + EV + ", t as (select *, 'theme ' || (cast(q as int) % 7) theme from ev where q is not null) select theme, count(*) as n, count(distinct place) as n_places, sum((value > 50)::int)::bigint as n_breakout, round(avg((value > 50)::int), 6) as share from t group by 1")
def e12(spark, d):
    t = searches(spark, d).where("q is not null").withColumn("theme", F.concat(F.lit("theme "), (F.col("q").cast("int") % 7).cast("string")))
    hot = (F.col("value") > 50).cast("int")
    return t.groupBy("theme").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("place").alias("n_places"), F.sum(hot).alias("n_breakout"), F.round(F.avg(hot), 6).alias("share"))


@query("e13_place_pivot", "with " + EV + " select l1, count(*) filter (place = 'p0') as p0, count(*) filter (place = 'p1') as p1, count(*) filter (place = 'p2') as p2 from ev group by 1")
def e13(spark, d):
    return searches(spark, d).groupBy("l1").pivot("place", ["p0", "p1", "p2"]).agg(F.count(F.lit(1))).fillna(0)


@query("e14_trend_sources", "with " + EV + " select q as trend, count(distinct l1) as n_categories, array_to_string(list_sort(list(distinct l1)), ', ') as categories from ev where q is not null group by 1")
def e14(spark, d):
    return searches(spark, d).where("q is not null").groupBy(F.col("q").alias("trend")).agg(F.countDistinct("l1").alias("n_categories"), F.array_join(F.array_sort(F.collect_set("l1")), ", ").alias("categories"))


@query("e15_source_documents", "with " + EV + " select l1, place, count(*) as n from ev group by all order by n desc, l1, place limit 10")
def e15(spark, d):
    return searches(spark, d).groupBy("l1", "place").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "l1", "place").limit(10)


@query("g08_candidates", "with " + EV + ", g as (select l1, q, count(distinct place) places, max((place = 'p1')::int) has_home, count(*) n, avg((value > 50)::int) hot from ev where q is not null group by all) select l1, q, row_number() over (partition by l1 order by places desc, has_home desc, n desc, round(hot, 6) desc, q) as place from g")
def g08(spark, d):
    g = searches(spark, d).where("q is not null").groupBy("l1", "q").agg(F.countDistinct("place").alias("places"), F.max((F.col("place") == "p1").cast("int")).alias("home"), F.count(F.lit(1)).alias("n"), F.round(F.avg((F.col("value") > 50).cast("int")), 6).alias("hot"))
    o = Window.partitionBy("l1").orderBy(F.desc("places"), F.desc("home"), F.desc("n"), F.desc("hot"), "q")
    return g.select("l1", "q", F.row_number().over(o).alias("place"))


@query("e39_market_without", "select count(*) as n_trends, round(median(growth_score_y1), 6) as median_score, sum((growth_score_y1 >= .5)::int)::bigint as n_above from trends t where not exists (select 1 from (select trend_name from trends where n_keywords < 10) x where x.trend_name = t.trend_name)")
def e39(spark, d):
    t = table(spark, d, "trends")
    kept = t.join(t.where("n_keywords < 10").select("trend_name"), "trend_name", "left_anti")
    return kept.agg(F.count(F.lit(1)).alias("n_trends"), F.round(F.median("growth_score_y1"), 6).alias("median_score"), F.sum((F.col("growth_score_y1") >= 0.5).cast("int")).alias("n_above"))


@query("e40_data_sources", "select source, source_region, count(distinct doc_id) as n from documents group by all")
def e40(spark, d):
    return table(spark, d, "documents").groupBy("source", "source_region").agg(F.countDistinct("doc_id").alias("n"))


@query("e36_links_summary", "select p_type, sum((p_size % 3 = 2)::int)::bigint as n_main, sum((p_size % 3 >= 1)::int)::bigint as n_any from part group by 1")
def e36(spark, d):
    lv = F.col("p_size") % 3
    return table(spark, d, "part").groupBy("p_type").agg(F.sum((lv == 2).cast("int")).alias("n_main"), F.sum((lv >= 1).cast("int")).alias("n_any"))


@query("e29_findings_per_factor", f"{_FACTS} select factor, count(distinct category) as n_categories, count(*) as n from h group by 1")
def e29(spark, d):
    return _factors(spark, d).groupBy("factor").agg(F.countDistinct("category").alias("n_categories"), F.count(F.lit(1)).alias("n"))


@query("e34_collected_window", "select min(d) as first_day, max(d) as last_day from (select try_strptime(regexp_extract(published_at, '[0-9]{2}/[0-9]{2}/[0-9]{4}'), '%d/%m/%Y')::date d from documents)")
def e34(spark, d):
    day = F.try_to_timestamp(F.regexp_extract("published_at", "[0-9]{2}/[0-9]{2}/[0-9]{4}", 0), F.lit("dd/MM/yyyy")).cast("date")
    return table(spark, d, "documents").select(day.alias("d")).agg(F.min("d").alias("first_day"), F.max("d").alias("last_day"))


@query("e35_reader_score", "select event_type as question, round(avg((value > 50)::int) * 100, 4) as right_pct, count(*) as n, avg((value > 50)::int) >= 0.5 as passed from events group by 1")
def e35(spark, d):
    ok = (F.col("value") > 50).cast("int")
    return table(spark, d, "events").groupBy(F.col("event_type").alias("question")).agg(F.round(F.avg(ok) * 100, 4).alias("right_pct"), F.count(F.lit(1)).alias("n"), (F.avg(ok) >= 0.5).alias("passed"))


