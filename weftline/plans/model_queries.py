"""Queries of models, graphs, streams, readers and writers."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.operators import graph, growth, learn, series
from weftline.session import checkpoint_dir, cut
from weftline.sources import readers, sinks
from weftline.sources.standins import MONTHLY_SQL, mapping, monthly, predictions
from weftline.sources.tables import table
from weftline.streaming import events as stream

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def place(spark: SparkSession, d: str, name: str) -> str:
    """A folder for what a query writes, in the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _samples(spark, d) -> tuple[DataFrame, str]:
    """Training rows of the monthly series, and their last month."""
    m = monthly(spark, d)
    last = m.agg(F.max("month")).first()[0]
    return cut(series.samples(m, "1900-01-01")), str(last)


@query("j01_forest_predictions")
def j01(spark, d) -> DataFrame:
    """Each keyword's growth one to five years ahead of its last month, by a pooled forest a year."""
    s, last = _samples(spark, d)
    now = s.where(F.col("month") == F.lit(last).cast("date"))
    return learn.pooled_predictions(s, now, last, place(spark, d, "j01_models")).select("keyword", "month", *(f"pred_y{h}" for h in range(1, 6)))


@query("j02_frozen_model")
def j02(spark, d):
    """A model is fitted once for its data and parameters: asked again, it is loaded and says the same."""
    s, last = _samples(spark, d)
    folder = place(spark, d, "j02_models")
    now = s.where(F.col("month") == F.lit(last).cast("date"))
    told = [learn.predict(learn.frozen(s, 1, 12, last, folder), now, learn.BASE).select("keyword", F.col("prediction").alias(c)) for c in ("fitted", "loaded")]
    return told[0].join(told[1], "keyword")


def _cutoffs(last: str, n: int = 13, step: int = 2) -> list[str]:
    """n months, step apart, the last a year before the end of the series."""
    end = pd.Period(last, "M") - 12
    return [str((end - step * i).to_timestamp().date()) for i in range(n)][::-1]


@query("j03_walk_forward")
def j03(spark, d):
    """How well 13 cut-offs' forests tell the years after them, with the band of their errors."""
    s, last = _samples(spark, d)
    return learn.calibration(cut(learn.walk_forward(s, _cutoffs(last))))


@query("j04_contest")
def j04(spark, d):
    """The forests against momentum, mean reversion and a blend, walking forward."""
    s, last = _samples(spark, d)
    return learn.contest(cut(learn.walk_forward(s, _cutoffs(last))))


@query("growth_score_model")
def growth_score_model(spark, d):
    """The whole growth analysis with the forests' predictions in place of a share of momentum."""
    s, last = _samples(spark, d)
    m = monthly(spark, d)
    levels = predictions(spark, d).drop(*(f"pred_y{h}" for h in range(1, 6)))
    rows = series.features(m).where(F.col("month") == F.lit(last).cast("date")).drop("value")
    told = learn.pooled_predictions(s, rows, last, place(spark, d, "growth_models"), years=(1, 3))
    kw = levels.join(told.select("keyword", "pred_y1", "pred_y3"), "keyword", "left")
    g = growth.roll_up(kw, mapping(spark, d), "keyword", "cluster", (1, 3))
    return growth.rerank(g, "score_y1", "cluster").select("cluster", "score_y1", "past_growth_pct", "rank")


@query("j05_series_forecasts")
def j05(spark, d):
    return learn.forecast_series(monthly(spark, d), "keyword", "month", "value")


@query("f29_bootstrap")
def f29(spark, d):
    return learn.bootstrap_mean(table(spark, d, "events"), "user_id", "value")


def _triplets(spark, d):
    p = table(spark, d, "part")
    return p.select(F.col("p_brand").alias("s"), F.col("p_type").alias("r"), F.col("p_name").alias("o"))


@query("j08_graph_edges", "with t as (select lower(p_brand) s, case when length(p_name) >= 4 and p_name like '%s' and not regexp_matches(p_name, '(ss|us|is|ous)$') then left(p_name, length(p_name) - 1) else p_name end o, p_type r from part) select least(s, o) as a, greatest(s, o) as b, count(*) as weight, count(distinct r) as relations from t group by 1, 2")
def j08(spark, d):
    return graph.edges(_triplets(spark, d), "s", "r", "o")


@query("j08_components", "select distinct (select least(min(lower(p_brand)), min(p_name)) from part) as component, (select count(distinct lower(p_brand)) + count(distinct p_name) from part) as n from part")
def j08c(spark, d):
    c = graph.components(graph.edges(_triplets(spark, d), "s", "r", "o"))
    return c.groupBy("component").agg(F.count(F.lit(1)).alias("n"))


@query("j08_consensus_communities")
def j08l(spark, d):
    return graph.consensus(graph.edges(_triplets(spark, d), "s", "r", "o"))


@query("j08_label_propagation")
def j08p(spark, d):
    return graph.label_propagation(graph.edges(_triplets(spark, d), "s", "r", "o"))


@query("s01_windowed_stream", "select time_bucket(interval 1 day, ts) as start, event_type, count(*) as n, round(avg(value), 6) as mean from events group by 1, 2")
def s01(spark, d):
    e = table(spark, d, "events")
    s = spark.readStream.schema(e.schema).option("pathGlobFilter", "events.parquet").parquet(d)
    name = f"w{uuid.uuid4().hex}"
    w = stream.windowed(s.withColumn("ts", F.col("ts").cast("timestamp")), "ts", ["event_type"], "value")
    return stream.run_once(w, name, "complete", place(spark, d, name)).withColumn("start", F.col("start").cast("timestamp_ntz"))


@query("s02_stateful_totals", "select event_type, count(*) as n, round(sum(value), 2) as total, max(value) as top from events group by 1")
def s02(spark, d):
    e = table(spark, d, "events")
    s = spark.readStream.schema(e.schema).option("pathGlobFilter", "events.parquet").parquet(d)
    name = f"t{uuid.uuid4().hex}"
    # A type may hold a third of all events, so its state is kept in 32 parts.
    s = s.withColumn("part", F.concat_ws("|", "event_type", F.pmod(F.xxhash64("event_id"), F.lit(32)).cast("string")))
    t = stream.run_once(stream.run_totals(s, "part", "value"), name, "update", place(spark, d, name))
    last = t.groupBy("part").agg(F.max("n").alias("n"), F.max_by("total", "n").alias("total"), F.max("top").alias("top"))
    of = F.regexp_extract("part", r"^(.*)\|\d+$", 1).alias("event_type")
    return last.groupBy(of).agg(F.sum("n").alias("n"), F.round(F.sum("total"), 2).alias("total"), F.max("top").alias("top"))


@query("s03_once_only_stream", "select event_type, count(distinct event_id) as n from events group by 1")
def s03(spark, d):
    """A stream in which some events are delivered twice, each counted once."""
    e = table(spark, d, "events")
    s = spark.readStream.schema(e.schema).option("pathGlobFilter", "events.parquet").parquet(d).withColumn("ts", F.col("ts").cast("timestamp"))
    twice = s.select("*", F.explode(F.when(F.col("event_id") % 7 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
    once = stream.once_only(twice, "ts", "event_id", "4000 days").select("event_type")
    return stream.run_to_files(once, place(spark, d, "once"), place(spark, d, "once-state")).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("b02_sqlite_star", "select trend_id, trend_name, n_keywords::bigint as n_keywords, growth_score_y1 from trends")
def b02_sqlite(spark, d):
    """A small database with a trend table, a glossary and the run's facts, written and read again."""
    import sqlite3

    path = place(spark, d, "star").removeprefix("file:") + ".db"
    t = table(spark, d, "trends").select("trend_id", "trend_name", "n_keywords", "growth_score_y1")
    glossary = spark.createDataFrame([("growth_score_y1", "percentile of the expected growth one year ahead")], "term string, meaning string")
    sinks.write_sqlite({"trends": t, "glossary": glossary, "run_info": t.agg(F.count(F.lit(1)).alias("n_trends"))}, path)
    with sqlite3.connect(path) as con:
        if con.execute("select n_trends from run_info").fetchone()[0] != con.execute("select count(*) from trends").fetchone()[0] or not con.execute("select * from glossary").fetchall():
            raise ValueError("the database doesn't hold what was written")
        rows = con.execute("select trend_id, trend_name, n_keywords, growth_score_y1 from trends").fetchall()  # the size of a hand-over
    return spark.createDataFrame(rows, "trend_id string, trend_name string, n_keywords long, growth_score_y1 double")


@query("a02_csv_round_trip", "select p_partkey, p_name, p_retailprice from part")
def a02(spark, d):
    path = place(spark, d, "csv")
    sinks.write_csv(table(spark, d, "part").select("p_partkey", "p_name", "p_retailprice"), path, ["p_partkey", "p_name", "p_retailprice"], gzip=True)
    return readers.csv_table(spark, path, ["p_partkey", "p_name", "p_retailprice"], "p_partkey bigint, p_name string, p_retailprice double")


@query("a04_newest_series", "with r as (select l_partkey % 50 k, l_suppkey % 3 run, cast(l_shipdate as date) m from lineitem), s as (select k, run, max(m) l, count(*) n from r group by all), b as (select k, first(run order by l desc, n desc, run) run from s group by 1) select r.k, r.run, count(*) as n from r join b on r.k = b.k and r.run = b.run group by all")
def a04(spark, d):
    r = table(spark, d, "lineitem").select((F.col("l_partkey") % 50).alias("k"), (F.col("l_suppkey") % 3).alias("run"), F.to_date("l_shipdate").alias("m"))
    return readers.newest_series(r, "k", "m", "run").groupBy("k", "run").agg(F.count(F.lit(1)).alias("n"))


@query("a07_jsonl_last", "select o_custkey, max(o_orderkey) as o_orderkey from orders group by 1")
def a07(spark, d):
    path = place(spark, d, "json")
    table(spark, d, "orders").select("o_custkey", "o_orderkey").write.json(path)
    return readers.jsonl_last(spark, path, "o_custkey bigint, o_orderkey bigint", "o_custkey", "o_orderkey")


@query("a11_plan_jobs", "select r_name as place, p_type as category from region, (select distinct p_type from part) where r_regionkey < 2 or p_type in ('ECONOMY', 'PROMO')")
def a11(spark, d):
    places = table(spark, d, "region").select(F.col("r_name").alias("place"), F.when(F.col("r_regionkey") < 2, "deep").otherwise("top").alias("kind"))
    cats = table(spark, d, "part").select(F.col("p_type").alias("category")).distinct().withColumn("level", F.when(F.col("category").isin("ECONOMY", "PROMO"), 1).otherwise(2))
    return readers.plan_jobs(places, cats)


@query("a12_missing_jobs", "select c_custkey from customer where c_custkey not in (select o_custkey from orders where o_custkey is not null)")
def a12(spark, d):
    return readers.missing_jobs(table(spark, d, "customer").select("c_custkey"), table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


@query("a15_inverted_abstract", "select doc_id, title as text from documents where title is not null")
def a15(spark, d):
    x = table(spark, d, "documents").where("title is not null").select("doc_id", F.posexplode(F.split("title", " ")).alias("p", "w"))
    m = x.groupBy("doc_id", "w").agg(F.collect_list("p").alias("ps")).groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("w", "ps"))).alias("m"))
    return m.select("doc_id", readers.inverted_abstract(F.col("m")).alias("text"))


@query("a17_dedupe_posts", "with s as (select doc_id, title, row_number() over (partition by lower(trim(title)) order by doc_id) k from documents where source = 'social' and title is not null) select doc_id from s where k = 1 order by doc_id % 97 desc, doc_id limit 50")
def a17(spark, d):
    from weftline.operators.evidence import first_by

    x = table(spark, d, "documents").where("source = 'social' and title is not null").select("doc_id", F.lower(F.trim("title")).alias("t"))
    return first_by(x, ["t"], ["doc_id"]).orderBy((F.col("doc_id") % 97).desc(), "doc_id").limit(50).select("doc_id")


@query("a18_comment_budget", "with c as (select l_orderkey post, l_linenumber p, (case when l_linenumber % 4 = 1 then 1 else 2 end) lv, l_returnflag || l_linestatus || l_linenumber || '-' || l_suppkey b, l_suppkey from (select * from lineitem qualify row_number() over (partition by l_orderkey, l_linenumber order by l_suppkey, l_partkey, l_extendedprice) = 1)), r as (select *, sum((lv = 1)::int) over (partition by post order by p rows unbounded preceding) root from c), k as (select *, row_number() over (partition by post, root, lv order by p) k from r), u as (select *, sum(length(b) + 1) over (partition by post order by p rows unbounded preceding) u from k where lv = 1 or k <= 2) select post, p from u where u <= 25")
def a18(spark, d):
    from weftline.operators.evidence import first_by

    x = first_by(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_suppkey", "l_partkey", "l_extendedprice"])
    x = x.select(F.col("l_orderkey").alias("post"), F.col("l_linenumber").alias("p"), F.when(F.col("l_linenumber") % 4 == 1, 1).otherwise(2).alias("lv"), F.concat("l_returnflag", "l_linestatus", F.col("l_linenumber").cast("string"), F.lit("-"), F.col("l_suppkey").cast("string")).alias("b"))
    return readers.comments_within(x, "post", "p", "lv", "b", 25, 2).select("post", "p")


@query("a24_page_text")
def a24(spark, d):
    html = F.concat(F.lit("<html><nav>Home Beauty Trends</nav><time datetime='2026-01-02'></time><p>"), "text", F.lit("</p></html>"))
    return table(spark, d, "documents").where("text is not null").select("doc_id", readers.page_column(html).alias("p")).select("doc_id", "p.text", "p.date")


@query("a29_timeline", "select event_type, cast(date_trunc('month', ts) as date) as month, round(avg(value), 6) as value from events where value <= 90 group by all")
def a29(spark, d):
    e = table(spark, d, "events").select("event_type", F.array(F.struct(F.to_date("ts").alias("date"), (F.col("value") > 90).alias("partial"), F.array("value").alias("values"))).alias("e"))
    return readers.timeline(e, "event_type", "e").withColumn("value", F.round("value", 6))


@query("b01_closed_schema", "select n_nationkey, n_name, null::varchar as note from nation")
def b01(spark, d):
    return sinks.closed(table(spark, d, "nation").select("n_name", "n_nationkey"), ["n_nationkey", "n_name", "note"])


@query("b05_flat_rows", "select p_brand, string_agg(distinct p_type, ' | ' order by p_type) as types from part group by 1")
def b05(spark, d):
    return sinks.flat(table(spark, d, "part").groupBy("p_brand").agg(F.array_sort(F.collect_set("p_type")).alias("types")))


@query("b06_latest_record", "select o_custkey, max(o_orderkey) as o_orderkey from orders group by 1")
def b06(spark, d):
    return sinks.latest(table(spark, d, "orders").select("o_custkey", "o_orderkey"), "o_custkey", "o_orderkey")


@query("b11_stale_inputs", "select 'nation' as input, true as stale union all select 'region', false")
def b11(spark, d):
    """Inputs whose digest is no longer what their producer wrote: one of two is written anew with other rows."""
    path = place(spark, d, "manifest")
    rows = {n: table(spark, d, n).coalesce(1) for n in ("nation", "region")}
    for n, x in rows.items():
        x.write.parquet(f"{path}/{n}")

    def digests():
        parts = [sinks.manifest(spark, f"{path}/{n}").where("path like '%.parquet'").agg(F.array_join(F.array_sort(F.collect_list("digest")), ",").alias("digest")).select(F.lit(n).alias("path"), "digest") for n in rows]
        return cut(parts[0].unionByName(parts[1]))

    produced = digests()
    rows["nation"].where("n_nationkey > 0").write.mode("overwrite").parquet(f"{path}/nation")
    stale = sinks.stale_inputs(digests(), produced).select("path", F.lit(True).alias("stale"))
    return produced.join(stale, "path", "left").select(F.col("path").alias("input"), F.coalesce("stale", F.lit(False)).alias("stale"))


