"""Queries of the series and growth operators, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftline.functions import semantics as S
from weftline.operators import growth, series
from weftline.sources.standins import MAPPING_SQL, MONTHLY_SQL, PREDICTIONS_SQL, mapping, monthly, predictions
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


def r6(df: DataFrame, *cols: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in cols})


W = "window w as (partition by keyword order by month)"


@query("a01_monthly_mapping", f"with {MONTHLY_SQL} select keyword, month, value from monthly where value > 0")
def a01(spark: SparkSession, d: str) -> DataFrame:
    return monthly(spark, d).where("value > 0")


@query("a28_monthly_mean", "select event_type as key, cast(date_trunc('month', ts) as date) as month, round(avg(value), 6) as value from events group by all")
def a28(spark, d):
    return r6(series.monthly_mean(table(spark, d, "events").withColumnRenamed("event_type", "key"), "key", "ts", "value"), "value")


def _f(a: int, b: int) -> str:
    return f"case when count(*) over (w rows between {a} preceding and {b} preceding) = {a - b + 1} then avg(value) over (w rows between {a} preceding and {b} preceding) end"


FEATURES_SQL = f"""{MONTHLY_SQL},
x0 as (select *, row_number() over w - 1 i, ln(value + 1) l, ln(value + 1) - lag(ln(value + 1)) over w dl from monthly {W}),
x1 as (select *, {_f(11, 0)} y0, {_f(23, 12)} y1, {_f(35, 24)} y2, {_f(47, 36)} y3, {_f(59, 48)} y4, {_f(71, 60)} y5,
  {_f(5, 0)} a6, {_f(11, 6)} b6, {_f(2, 0)} a3, {_f(5, 3)} b3, {_f(14, 12)} c3, {_f(17, 12)} c6,
  max(value) over (w rows unbounded preceding) peak, min(case when value > 0 then i end) over (w rows unbounded preceding) seen,
  sum(case when value > 0 then 1 else 0 end) over (w rows between 11 preceding and current row) pos,
  case when count(*) over (w rows between 11 preceding and current row) = 12 then stddev_samp(value) over (w rows between 11 preceding and current row) end sd,
  case when count(dl) over (w rows between 11 preceding and current row) = 12 then stddev_pop(dl) over (w rows between 11 preceding and current row) end vol,
  case when count(*) over (w rows between 23 preceding and current row) = 24 then avg(case when value > 0 then 1.0::double else 0 end) over (w rows between 23 preceding and current row) end nz,
  case when count(*) over (w rows between 23 preceding and current row) = 24 then regr_slope(l, i) over (w rows between 23 preceding and current row) end s24,
  case when count(*) over (w rows between 59 preceding and current row) = 60 then regr_slope(l, i) over (w rows between 59 preceding and current row) end s60
  from x0 {W}),
feat as (select keyword, month, value, ln((y0 + 1) / (y1 + 1)) growth_past_12m, ln((a6 + 1) / (b6 + 1)) growth_past_6m, ln((a3 + 1) / (b3 + 1)) growth_past_3m, s24 slope_24m, y0 / greatest(peak, 1) level_vs_peak,
  vol volatility_12m, nz pct_nonzero_24m, case when sd > 0 then (value - y0) / sd when sd is not null then 0 end z_now, (case when seen is null then i else i - seen end)::double months_since_first_search,
  ln((y0 + 1) / (y3 + 1)) growth_past_36m, case when y5 is not null then ((y0 > y1)::int + (y1 > y2)::int + (y2 > y3)::int + (y3 > y4)::int + (y4 > y5)::int)::double end years_up_of_5, s60 slope_60m,
  ln((a3 + 1) / (c3 + 1)) yoy_3m, ln((a6 + 1) / (c6 + 1)) yoy_6m, ln((y0 + 1) / (y1 + 1)) - ln((y1 + 1) / (y2 + 1)) accel_12m, y0 past12,
  coalesce(i >= 23 and pos >= 6 and y0 >= 1, false) enough from x1)"""
FEATURES = ["growth_past_12m", "growth_past_6m", "growth_past_3m", "slope_24m", "level_vs_peak", "volatility_12m", "pct_nonzero_24m", "z_now", "months_since_first_search", "growth_past_36m", "years_up_of_5", "slope_60m", "yoy_3m", "yoy_6m", "accel_12m"]
_R = ", ".join(f"round({c}, 8) as {c}" for c in FEATURES)


@query("f03_features", f"with {FEATURES_SQL} select keyword, month, {_R}, enough from feat")
def f03(spark, d):
    return r6(series.features(monthly(spark, d)), *FEATURES, digits=8).select("keyword", "month", *FEATURES, "enough")


def _t(a: int, b: int) -> str:
    return f"case when count(*) over (w rows between {a} following and {b} following) = 12 then avg(value) over (w rows between {a} following and {b} following) end"


_TARGETS = f"{MONTHLY_SQL}, t as (select keyword, month, {_f(11, 0)} y0, " + ", ".join(f"{_t(a, b)} n{h}" for h, (a, b) in series.YEARS.items()) + f" from monthly {W})"


@query("f04_targets", f"with {_TARGETS} select keyword, month, " + ", ".join(f"round(ln((n{h} + 1) / (y0 + 1)), 5) as t_y{h}" for h in series.YEARS) + " from t")
def f04(spark, d):
    return r6(series.targets(monthly(spark, d)), *(f"t_y{h}" for h in series.YEARS), digits=5).drop("value")


@query("f05_samples", f"with {FEATURES_SQL} select keyword, month, round(past12, 6) as past12, round(growth_past_12m, 6) as growth_past_12m from feat where enough and month >= date '1998-01-01'")
def f05(spark, d):
    return r6(series.samples(monthly(spark, d), "1998-01-01"), "past12", "growth_past_12m").select("keyword", "month", "past12", "growth_past_12m")


@query("f06_running_peak", f"with {MONTHLY_SQL} select keyword, month, round(case when p > 0 then value * 100 / p else value end, 4) as scaled from (select *, max(value) over (partition by keyword order by month rows unbounded preceding) p from monthly)")
def f06(spark, d):
    return r6(series.running_peak_scaled(monthly(spark, d), "keyword", "month", "value"), "scaled", digits=4).select("keyword", "month", "scaled")


Z_SQL = f"""{MONTHLY_SQL}, z as (select keyword, month, value, coalesce(case when n >= 4 and sd > 0 then (value - m) / sd end, 0) z_score from (select *, count(*) over v n, avg(value) over v m, stddev_samp(value) over v sd
  from monthly window v as (partition by keyword order by month rows between 11 preceding and current row)))"""


@query("f08_rolling_z", f"with {Z_SQL} select keyword, month, round(z_score, 6) as z_score from z")
def f08(spark, d):
    return r6(series.rolling_z(monthly(spark, d), "keyword", "month", "value"), "z_score").select("keyword", "month", "z_score")


@query(
    "f09_lag_features",
    f"""with {Z_SQL}, g as (select *, lag(z_score, 1) over w l1, lag(z_score, 3) over w l3, lag(z_score, 12) over w l12,
  case when count(*) over b = 3 then avg(z_score) over b end rm, case when count(*) over b = 3 then stddev_samp(z_score) over b end zv, case when count(*) over b = 3 then stddev_samp(value) over b end sv
  from z window w as (partition by keyword order by month), b as (partition by keyword order by month rows between 3 preceding and 1 preceding))
select keyword, month, round(coalesce(l1, 0), 5) as lag_1, round(coalesce(l3, 0), 5) as lag_3, round(coalesce(l12, 0), 5) as lag_12, round(coalesce(rm, 0), 5) as rolling_mean_3m, round(coalesce(zv, 0), 5) as z_volatility_3m, round(coalesce(l1 - l3, 0), 5) as z_velocity,
  coalesce((zv < 0.5)::int, 0) as is_stable, coalesce((sv < (select median(sv) from g))::int, 0) as is_search_stable, round(sin(2 * pi() * month(month) / 12), 6) as month_sin, round(cos(2 * pi() * month(month) / 12), 6) as month_cos, (month(month) in (6, 7, 8))::int as is_summer from g""",
)
def f09(spark, d):
    x = series.lag_features(series.rolling_z(monthly(spark, d), "keyword", "month", "value"), "keyword", "month", "z_score", "value")
    return r6(r6(x, "lag_1", "lag_3", "lag_12", "rolling_mean_3m", "z_volatility_3m", "z_velocity", digits=5), "month_sin", "month_cos").drop("value", "z_score")


SPARSE_SQL = f"{MONTHLY_SQL}, sparse as (select keyword, month, case when value < 60 then 0 else value end as value from monthly)"


@query(
    "f10_zero_runs",
    f"""with {SPARSE_SQL}, a as (select *, value = 0 z, coalesce(((value = 0) <> lag(value = 0) over (partition by keyword order by month))::int, 0) c from sparse),
b as (select *, sum(c) over (partition by keyword order by month rows unbounded preceding) run from a), c as (select *, row_number() over (partition by keyword, run order by month desc) k from b)
select keyword, month, value from c where not z or k <= 3""",
)
def f10(spark, d):
    x = monthly(spark, d).withColumn("value", F.when(F.col("value") < 60, 0.0).otherwise(F.col("value")))
    return series.trim_zero_runs(x, "keyword", "month", "value", 3)


@query("e03_data_quality", f"with {SPARSE_SQL}, {MAPPING_SQL}, k as (select keyword, avg((value <> 0)::int) * 100 p from sparse group by 1), g as (select cluster, round(avg(p), 1) as pct_nonzero_mean, round(min(p), 1) as pct_nonzero_min, count(*) as n_keywords from mapping join k using (keyword) group by 1) select *, case when pct_nonzero_mean < 15 then 'low' when pct_nonzero_mean < 20 then 'medium' else 'good' end as data_quality from g")
def e03(spark, d):
    x = monthly(spark, d).withColumn("value", F.when(F.col("value") < 60, 0.0).otherwise(F.col("value")))
    return series.data_quality(x, mapping(spark, d), "keyword", "value", "cluster")


@query("e07_cluster_history", f"with {MONTHLY_SQL}, {MAPPING_SQL}, c as (select cluster, month, avg(value) v, row_number() over (partition by cluster order by month desc) r from mapping join monthly using (keyword) group by 1, 2) select cluster, month, round(v, 2) as value from c where r <= 60")
def e07(spark, d):
    x = mapping(spark, d).join(monthly(spark, d), "keyword").groupBy("cluster", "month").agg(F.avg("value").alias("v"))
    x = x.withColumn("r", F.row_number().over(Window.partitionBy("cluster").orderBy(F.col("month").desc())))
    return x.where("r <= 60").select("cluster", "month", F.round("v", 2).alias("value"))


SEASON_SQL = f"""{MONTHLY_SQL}, s0 as (select *, row_number() over (partition by keyword order by month desc) back from monthly where month <= date '2001-06-01'),
s1 as (select *, count(*) over (partition by keyword) n from s0 where back <= 48), s2 as (select *, (n - back) // 12 blk from s1 where n >= 24),
s3 as (select *, value / nullif(avg(value) over (partition by keyword, blk), 0) r from s2 where blk < n // 12),
s4 as (select keyword, month(month) as calendar_month, avg(r) f from s3 where r is not null group by 1, 2),
season as (select keyword, calendar_month, round(f / avg(f) over (partition by keyword), 4) as factor from s4)"""


SEASON_ONLY = "s0" + SEASON_SQL.split(", s0", 1)[1]


@query("e08_seasonal_factors", f"with {SEASON_SQL} select * from season")
def e08(spark, d):
    return series.seasonal_factors(monthly(spark, d), "keyword", "month", "value", "2001-06-01")


LEVELS_SQL = f"""{PREDICTIONS_SQL}, {MAPPING_SQL},
lv as (select cluster, avg(last12_mean) base, """ + ", ".join(f"avg((last12_mean + 1) * exp(pred_y{h}) - 1) l{h}" for h in range(1, 6)) + """ from mapping join pred using (keyword) where not thin group by 1),
levels as (""" + " union all ".join(f"select cluster, base, {h} as year, l{h} as level, {a}::double lo, {b}::double hi from lv" for h, (a, b) in growth.BAND_80.items()) + ")"


@query("e06_expected_levels", f"with {LEVELS_SQL} select cluster, round(base, 2) as base, year, round(level, 2) as level, round(((level + 1) / (base + 1) - 1) * 100, 1) as change_pct, round((level + 1) * (1 + lo) - 1, 2) as low, round((level + 1) * (1 + hi) - 1, 2) as high from levels")
def e06(spark, d):
    return growth.expected_levels(predictions(spark, d), mapping(spark, d), "keyword", "cluster")


@query("f31_monthly_path", f"with {LEVELS_SQL}, {SEASON_ONLY}, cs as (select cluster, calendar_month, round(avg(factor), 4) as factor from season join mapping using (keyword) group by 1, 2), p as (select cluster, year, level, cast(date '2001-11-01' + to_months((k + (year - 1) * 12)::int) as date) as month from levels, (select unnest(range(1, 13)) k)) select p.cluster, month, round(level * coalesce(factor, 1), 2) as value from p left join cs on cs.cluster = p.cluster and calendar_month = month(month)")
def f31(spark, d):
    levels = growth.expected_levels(predictions(spark, d), mapping(spark, d), "keyword", "cluster")
    exact = _levels(spark, d)
    season = series.seasonal_factors(monthly(spark, d), "keyword", "month", "value", "2001-06-01").join(mapping(spark, d), "keyword").groupBy("cluster", "calendar_month").agg(F.round(F.avg("factor"), 4).alias("factor"))
    return series.monthly_path(levels.drop("level").join(exact, ["cluster", "year"]), season, "cluster", "2001-11-01")


def _levels(spark, d):
    x = mapping(spark, d).join(predictions(spark, d).where("not thin"), "keyword").groupBy("cluster").agg(*(F.avg((F.col("last12_mean") + 1) * F.exp(f"pred_y{h}") - 1).alias(str(h)) for h in range(1, 6)))
    return x.unpivot("cluster", [str(h) for h in range(1, 6)], "year", "level").withColumn("year", F.col("year").cast("int"))


SCORES_SQL = f"""{PREDICTIONS_SQL}, sc as (select keyword, thin, {", ".join(f"case when not thin then (rank() over (partition by thin order by pred_y{h}) + (count(*) over (partition by thin, pred_y{h}) - 1) / 2.0::double) / count(*) over (partition by thin) end s{h}" for h in (1, 2, 3))} from pred)"""


@query("f01_scores", f"with {SCORES_SQL} select keyword, thin, round(s1, 6) as score_y1, round(s2, 6) as score_y2, round(s3, 6) as score_y3 from sc")
def f01(spark, d):
    return r6(growth.scores(predictions(spark, d), (1, 2, 3)), "score_y1", "score_y2", "score_y3").select("keyword", "thin", "score_y1", "score_y2", "score_y3")


@query("f01_scores_blended", f"""with {PREDICTIONS_SQL}, a as (select keyword, (rank() over (order by pred_y1) + (count(*) over (partition by pred_y1) - 1) / 2.0::double) / count(*) over () p, (rank() over (order by momentum) + (count(*) over (partition by momentum) - 1) / 2.0::double) / count(*) over () m from pred where not thin),
b as (select keyword, (p + m) / 2 s from a) select keyword, round((rank() over (order by s) + (count(*) over (partition by s) - 1) / 2.0::double) / count(*) over (), 6) as score_y1 from b""")
def f01b(spark, d):
    return r6(growth.scores(predictions(spark, d), (1,), blend=True).where("not thin"), "score_y1").select("keyword", "score_y1")


@query("f02_grades", f"with {SCORES_SQL} select keyword, case when s1 >= .8 then 4 when s1 >= .5 then 3 when s1 >= .2 then 2 when s1 is not null then 1 end as grade from sc")
def f02(spark, d):
    return growth.scores(predictions(spark, d), (1,)).select("keyword", S.grade(F.col("score_y1")).alias("grade"))


@query("f07_latest_rows", f"with {PREDICTIONS_SQL} select keyword, thin, momentum, last12_mean, prev12_mean, recent_mean, year_ago_mean from pred")
def f07(spark, d):
    return predictions(spark, d).select("keyword", "thin", "momentum", "last12_mean", "prev12_mean", "recent_mean", "year_ago_mean")


def _mid(h: int) -> str:
    return f"round((select sum((p.pred_y{h} < x.g{h})::int + 0.5 * (p.pred_y{h} = x.g{h})::int) / count(*) from pred p where not p.thin), 4)"


ROLL_SQL = f"""{PREDICTIONS_SQL}, {MAPPING_SQL}, ag as (select cluster, count(*) n_keywords, sum((not thin)::int) n_scored, {", ".join(f"avg({c}) filter (not thin) {c}" for c in ("last12_mean", "prev12_mean", "recent_mean", "year_ago_mean"))},
  {", ".join(f"avg((last12_mean + 1) * exp(pred_y{h}) - 1) filter (not thin) l{h}" for h in (1, 3))} from mapping join pred using (keyword) group by 1),
x as (select *, ln((l1 + 1) / (last12_mean + 1)) g1, ln((l3 + 1) / (last12_mean + 1)) g3 from ag),
roll as (select cluster, n_keywords, n_scored, {_mid(1)} score_y1, {_mid(3)} score_y3, round(((last12_mean + 1) / (prev12_mean + 1) - 1) * 100, 1) past_growth_pct, round(((recent_mean + 1) / (year_ago_mean + 1) - 1) * 100, 1) recent_change_pct from x)"""


@query("e05_trend_rollup", f"with {ROLL_SQL} select cluster, n_keywords, n_scored, score_y1, score_y3, case when score_y1 >= .8 then 4 when score_y1 >= .5 then 3 when score_y1 >= .2 then 2 else 1 end as grade_y1, past_growth_pct, recent_change_pct, coalesce(recent_change_pct < -10, false) as recent_decline from roll")
def e05(spark, d):
    return growth.roll_up(predictions(spark, d), mapping(spark, d), "keyword", "cluster", (1, 3)).select("cluster", "n_keywords", "n_scored", "score_y1", "score_y3", "grade_y1", "past_growth_pct", "recent_change_pct", "recent_decline")


@query("growth_score", f"with {ROLL_SQL} select cluster, score_y1, past_growth_pct, row_number() over (order by score_y1 desc, cluster) as rank from roll")
def flagship(spark, d):
    """The whole growth analysis: series, features, prediction, roll-up and rank of every trend."""
    g = growth.roll_up(predictions(spark, d), mapping(spark, d), "keyword", "cluster", (1, 3))
    return growth.rerank(g, "score_y1", "cluster").select("cluster", "score_y1", "past_growth_pct", "rank")


@query("e10_market_snapshot", f"with {ROLL_SQL} select count(*) as n_trends, round(median(score_y1), 4) as median_score_y1, round(avg((past_growth_pct > 0)::int), 4) as share_growing, sum((score_y1 >= 0.5)::int) as n_above_line, round(median(past_growth_pct), 2) as median_past_growth from roll")
def e10(spark, d):
    return growth.market_snapshot(growth.roll_up(predictions(spark, d), mapping(spark, d), "keyword", "cluster", (1, 3)))


@query("e09_market_expected", f"with {PREDICTIONS_SQL} select round((exp(median(pred_y1)) - 1) * 100, 2) as expected_pct from pred where not thin")
def e09(spark, d):
    return growth.market_expected_pct(predictions(spark, d), 1)


@query("d01_bridge_join", f"with {PREDICTIONS_SQL}, {MAPPING_SQL} select cluster, keyword, momentum from mapping join pred using (keyword)")
def d01(spark, d):
    return mapping(spark, d).join(predictions(spark, d).select("keyword", "momentum"), "keyword").select("cluster", "keyword", "momentum")


@query("d12_lag_correlation", f"with {MONTHLY_SQL}, a as (select month, avg(value) v from monthly group by 1), b as (select month, max(value) v from monthly group by 1) select lag, round(corr(a.v, b.v), 5) as corr, count(*) as n from (select unnest(range(-12, 13))::int lag) join a on true join b on b.month = cast(a.month + to_months(lag) as date) group by 1")
def d12(spark, d):
    m = monthly(spark, d)
    a, b = (m.groupBy("month").agg(f("value").alias("value")) for f in (F.avg, F.max))
    return r6(series.lag_correlation(a, b, "month"), "corr", digits=5)


@query("f24_onset", f"""with {MONTHLY_SQL}, a as (select *, case when count(*) over w3 = 3 then avg(value) over w3 end m from monthly window w3 as (partition by keyword order by month rows between 2 preceding and current row)),
b as (select *, (m >= max(m) over (partition by keyword) * 0.75)::int ok from a), c as (select *, min(ok) over w6 = 1 and count(ok) over w6 = 3 held from b window w6 as (partition by keyword order by month rows between current row and 2 following))
select keyword, min(month) filter (held) as onset from c group by 1""")
def f24(spark, d):
    return series.onset(monthly(spark, d), "keyword", "month", "value", 0.75, 3)


@query("f37_level_index", f"with {MONTHLY_SQL} select month, round(median(value / m), 5) as index from (select *, nullif(avg(value) filter (month between date '1997-01-01' and date '1998-06-01') over (partition by keyword), 0) m from monthly) group by 1")
def f37(spark, d):
    return r6(series.level_index(monthly(spark, d), "keyword", "month", "value", ("1997-01-01", "1998-06-01")), "index", digits=5)


def _rank_inputs(spark, d):
    o = table(spark, d, "trends")
    kw = o.select(F.coalesce("stream_name", F.lit("None")).alias("stream"), F.col("trend_name").alias("trend"), F.explode(F.split("keywords", "; ")).alias("keyword")).where("trend_name is not null")
    tr = o.where("trend_name is not null").select(F.coalesce("stream_name", F.lit("None")).alias("stream"), F.col("trend_name").alias("trend"), F.col("n_keywords").alias("size"), F.when(F.col("rank_short") % 2 == 0, F.col("growth_score_y1")).alias("growth"))
    return tr, kw


RANK_SQL = """o as (select coalesce(stream_name, 'None') stream, trend_name trend, n_keywords size, case when rank_short % 2 = 0 then growth_score_y1 end growth, keywords from trends where trend_name is not null),
k as (select stream, trend, unnest(string_split(keywords, '; ')) keyword from o), s as (select keyword, count(distinct stream) s from k group by 1), n as (select stream, trend, max(s) n_streams from k join s using (keyword) group by 1, 2),
x as (select o.stream, o.trend, size, growth, coalesce(n_streams, 1) n_streams, growth is not null final, round(coalesce(growth, size / max(size) over (partition by o.stream)::double * (1 + 0.2 * (coalesce(n_streams, 1) - 1))), 4) rank_score from o left join n on n.stream = o.stream and n.trend = o.trend)"""


@query("f13_rank_score", f"with {RANK_SQL} select stream, trend, n_streams, final, rank_score from x")
def f13(spark, d):
    return growth.rank_trends(*_rank_inputs(spark, d)).select("stream", "trend", "n_streams", "final", "rank_score")


@query("f14_overall_rank", f"with {RANK_SQL} select stream, trend, row_number() over (order by final desc, rank_score desc, n_streams desc, trend, stream) as overall_rank from x")
def f14(spark, d):
    return growth.rank_trends(*_rank_inputs(spark, d)).select("stream", "trend", "overall_rank")


@query("f15_rerank", "select trend_id, row_number() over (order by growth_score_y3 desc nulls last, trend_id) as rank from trends")
def f15(spark, d):
    return growth.rerank(table(spark, d, "trends"), "growth_score_y3", "trend_id").select("trend_id", "rank")


def _forecasts(spark, d):
    m = series.rolling_z(monthly(spark, d), "keyword", "month", "value")
    kind = F.when(F.col("month") < F.lit("2000-07-01").cast("date"), "Fit").otherwise("Forecast")
    models = F.explode(F.array(F.lit("RandomForest"), F.lit("LinearRegression"))).alias("model")
    x = m.select(F.col("keyword").alias("cluster_id"), F.col("month").alias("date"), kind.alias("type"), models, F.round("z_score", 6).alias("z_score"))
    return x.where("model <> 'RandomForest' or cluster_id like '%ing'").withColumn("z_score", F.when(F.col("model") == "RandomForest", F.col("z_score") * 0.5).otherwise(F.col("z_score")))


FORECAST_SQL = f"{Z_SQL}, fc as (select keyword cluster_id, month as date, case when month < date '2000-07-01' then 'Fit' else 'Forecast' end as type, model, case when model = 'RandomForest' then round(z_score, 6) * 0.5 else round(z_score, 6) end z_score from z, (select unnest(['RandomForest', 'LinearRegression']) model) where model <> 'RandomForest' or keyword like '%ing')"


@query("f12_best_model", f"with {FORECAST_SQL}, act as (select keyword cluster_id, month as date, round(z_score, 6) actual from z), e as (select cluster_id, model, sqrt(avg((z_score - actual) ** 2)) rmse from fc join act using (cluster_id, date) where type = 'Fit' group by all), h as (select distinct cluster_id, model from fc where type = 'Forecast'), r as (select *, row_number() over (partition by cluster_id order by (model <> 'RandomForest')::int, rmse nulls last, model) k from h left join e using (cluster_id, model)) select cluster_id, model, round(rmse, 6) as rmse from r where k = 1")
def f12(spark, d):
    act = series.rolling_z(monthly(spark, d), "keyword", "month", "value").select(F.col("keyword").alias("cluster_id"), F.col("month").alias("date"), F.round("z_score", 6).alias("actual"))
    return growth.best_model(_forecasts(spark, d), act)


@query("f11_master_report", f"with {FORECAST_SQL}, g as (select cluster_id, model, coalesce(arg_max(z_score, date) filter (type = 'Fit'), 0) c, avg(z_score) filter (type = 'Forecast') a, first(date order by z_score desc, date) filter (type = 'Forecast') p from fc group by all) select cluster_id, model, case when a - c > .8 then 'Major Breakout' when a - c > .2 then 'Rising' when a - c < -.2 then 'Fading' else 'Stable' end as status, round(c, 2) as current_z, round(a, 2) as forecast_avg_z, round(a - c, 2) as z_delta, strftime(p, '%b %Y') as peak_month from g where a is not null")
def f11(spark, d):
    return growth.master_report(_forecasts(spark, d))


@query("e04_category_level", "with r as (select p_type category, p_brand stream, round(avg(p_size) / 25 - 1, 7) z_delta from part group by p_type, p_brand, p_name), p as (select category, stream, avg(z_delta) m from r group by all), t as (select stream, avg(z_delta) m from r group by 1), u as (select category, avg(m) z, count(*) n from p group by 1 union all select null, avg(m), count(*) from t) select category, n as n_streams, round(z, 6) as z_delta, case when z > .8 then 'Major Breakout' when z > .2 then 'Rising' when z < -.2 then 'Fading' else 'Stable' end as status from u")
def e04(spark, d):
    r = table(spark, d, "part").groupBy(F.col("p_type").alias("category"), F.col("p_brand").alias("stream"), "p_name").agg(F.round(F.avg("p_size") / 25 - 1, 7).alias("z_delta"))
    return growth.category_level(r)


@query("f20_yoy_series", "with g as (select p_brand k, unnest([1, 2, 3, 4, 5]) as year, count(*) n from part group by 1), c as (select k, year, case when year = 3 then null else round(n * year / 10.0::double, 2) end cum from g) select k as brand, year, round(((100 + cum) / nullif(100 + coalesce(last_value(cum ignore nulls) over (partition by k order by year rows between unbounded preceding and 1 preceding), 0), 0) - 1) * 100, 2) as yoy_pct, round((pow(1 + cum / 100, 1.0::double / year) - 1) * 100, 2) as cagr_pct from c")
def f20(spark, d):
    g = table(spark, d, "part").groupBy(F.col("p_brand").alias("brand")).agg(F.count(F.lit(1)).alias("n")).select("brand", "n", F.explode(F.sequence(F.lit(1), F.lit(5))).alias("year"))
    g = g.withColumn("cum", F.when(F.col("year") != 3, F.round(F.col("n") * F.col("year") / 10, 2)))
    return growth.yearly_view(g, "brand", "year", "cum")
