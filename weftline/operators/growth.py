"""Scores, trend roll-up and ranking of growth predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions.semantics import cagr_pct, grade, log_growth, pct_change, status
from weftline.operators.ranking import average_rank, running
from weftline.session import cut

#: 80 % band of each year ahead (fixed values).
BAND_80 = {1: (-0.10, 0.12), 2: (-0.15, 0.19), 3: (-0.21, 0.26), 4: (-0.25, 0.35), 5: (-0.27, 0.48)}


def scores(kw: DataFrame, years: tuple[int, ...] = (1, 2, 3, 4, 5), blend: bool = False) -> DataFrame:
    """score_y* of the rows that are not thin: percentile of the prediction, or of the mean
    of the percentiles of prediction and momentum."""
    x = cut(kw)  # a row a keyword; each year below reads it again
    ok = ~F.col("thin")
    for h in years:
        x = x.withColumn("_p", F.when(ok, F.col(f"pred_y{h}")))
        if blend:
            x = x.withColumn("_m", F.when(ok, F.col("momentum")))
            x = average_rank(average_rank(x, [], "_p", "_pp"), [], "_m", "_mp").withColumn("_p", (F.col("_pp") + F.col("_mp")) / 2).drop("_pp", "_mp", "_m")
        x = average_rank(x, [], "_p", f"score_y{h}").drop("_p")
    return x


def expected_levels(kw: DataFrame, mapping: DataFrame, key: str, group: str, band: dict = BAND_80) -> DataFrame:
    """(group, base, year, level, change_pct, low, high): mean over a group's keywords of
    (last12 + 1) e^pred - 1; none if one of its scored keywords has no prediction."""
    cols = [f"pred_y{h}" for h in band]
    lost = F.greatest(*(F.col(c).isNull().cast("int") for c in cols), F.col("last12_mean").isNull().cast("int"))
    g = mapping.join(kw.where(~F.col("thin")), key).groupBy(group).agg(
        F.max(lost).alias("_lost"), F.avg("last12_mean").alias("base"), *(F.avg((F.col("last12_mean") + 1) * F.exp(f"pred_y{h}") - 1).alias(f"_l{h}") for h in band)
    )
    rows = F.explode(F.array(*(F.struct(F.lit(h).alias("year"), F.col(f"_l{h}").alias("level"), F.lit(a).alias("_a"), F.lit(b).alias("_b")) for h, (a, b) in band.items()))).alias("r")
    g = g.where("_lost = 0").select(group, "base", rows).select(group, "base", "r.*")
    edge = lambda c: F.round((F.col("level") + 1) * (1 + F.col(c)) - 1, 2)
    return g.select(group, F.round("base", 2).alias("base"), "year", F.round("level", 2).alias("level"), pct_change(F.col("level"), F.col("base")).alias("change_pct"), edge("_a").alias("low"), edge("_b").alias("high"))


def roll_up(kw: DataFrame, mapping: DataFrame, key: str, group: str, years: tuple[int, ...] = (1, 2, 3, 4, 5)) -> DataFrame:
    """A row for each group: keyword counts, mid-rank score and grade of its expected growth
    against all scored keywords, past and recent change, decline flag."""
    kw = cut(kw)  # a row a keyword; each year below reads it again
    ok = ~F.col("thin")
    cols = [f"pred_y{h}" for h in years]
    lost = F.max(F.when(ok, F.greatest(*(F.col(c).isNull().cast("int") for c in cols))))
    mean = lambda c: F.avg(F.when(ok, F.col(c)))
    g = mapping.join(kw, key).groupBy(group).agg(
        F.count(F.lit(1)).alias("n_keywords"), F.sum(ok.cast("int")).alias("n_scored"), lost.alias("_lost"), *(mean(c).alias(f"_{c}") for c in ("last12_mean", "prev12_mean", "recent_mean", "year_ago_mean")),
        *(F.avg(F.when(ok, (F.col("last12_mean") + 1) * F.exp(f"pred_y{h}") - 1)).alias(f"_l{h}") for h in years),
    )
    g, market = cut(g), kw.where(ok)
    for h in years:
        growth = F.when(F.col("_lost") == 0, log_growth(F.col(f"_l{h}"), F.col("_last12_mean")))
        g = g.withColumn("_g", growth)
        # Rank of a few hundred groups among all keywords: counts by joining on the ordered union, not on pairs.
        pool = market.where(F.col(f"pred_y{h}").isNotNull()).select(F.col(f"pred_y{h}").alias("_v"), F.lit(1).alias("_k"))
        both = pool.unionByName(g.where("_g is not null").select(F.col("_g").alias("_v"), F.lit(0).alias("_k")))
        at = running(both.groupBy("_v").agg(F.sum("_k").alias("_same")), [], ["_v"], "_same", "_upto")
        at = at.crossJoin(F.broadcast(at.agg(F.sum("_same").alias("_all"))))  # one row
        share = (F.col("_upto") - F.col("_same") / 2) / F.col("_all")
        at = at.select(F.col("_v").alias("_g"), F.round(share, 4).alias(f"score_y{h}"))
        g = g.join(at, "_g", "left").drop("_g").withColumn(f"grade_y{h}", grade(F.col(f"score_y{h}")))
    g = g.withColumns({"past_growth_pct": pct_change(F.col("_last12_mean"), F.col("_prev12_mean")), "recent_change_pct": pct_change(F.col("_recent_mean"), F.col("_year_ago_mean"))})
    decline = F.coalesce(F.col("recent_change_pct") < -10, F.lit(False))
    return g.withColumn("recent_decline", decline).drop(*(c for c in g.columns if c.startswith("_")))


def market_snapshot(trends: DataFrame, line: float = 0.5) -> DataFrame:
    return trends.agg(
        F.count(F.lit(1)).alias("n_trends"), F.round(F.median("score_y1"), 4).alias("median_score_y1"), F.round(F.avg((F.col("past_growth_pct") > 0).cast("int")), 4).alias("share_growing"),
        F.sum((F.col("score_y1") >= line).cast("int")).alias("n_above_line"), F.round(F.median("past_growth_pct"), 2).alias("median_past_growth"),
    )


def market_expected_pct(kw: DataFrame, year: int) -> DataFrame:
    return kw.where(~F.col("thin")).agg(F.round((F.exp(F.median(f"pred_y{year}")) - 1) * 100, 2).alias("expected_pct"))


def rank_trends(trends: DataFrame, keywords: DataFrame, stream: str = "stream", trend: str = "trend", score: str | None = "growth") -> DataFrame:
    """Overall rank: a growth score where there is one, else cluster size over the largest
    of its stream times 1 + 0.2 per further stream that shares a keyword; final scores
    first, then score, streams and name.

    trends: (stream, trend, size[, growth]); keywords: (stream, trend, keyword)."""
    seen = keywords.groupBy("keyword").agg(F.countDistinct(stream).alias("_s"))
    streams = keywords.join(seen, "keyword").groupBy(stream, trend).agg(F.max("_s").alias("n_streams"))
    x = trends.join(streams, [stream, trend], "left").withColumn("n_streams", F.coalesce("n_streams", F.lit(1)))
    base = F.col("size") / F.max("size").over(Window.partitionBy(stream)) * (1 + 0.2 * (F.col("n_streams") - 1))
    final = F.col(score).isNotNull() if score else F.lit(False)
    x = x.withColumns({"final": final, "rank_score": F.round(F.when(final, F.col(score)).otherwise(base) if score else base, 4)})
    order = Window.partitionBy(F.lit(0)).orderBy(F.col("final").desc(), F.col("rank_score").desc(), F.col("n_streams").desc(), trend, stream)
    return x.withColumn("overall_rank", F.row_number().over(order))


def rerank(ranked: DataFrame, score: str, trend: str = "trend") -> DataFrame:
    """Another year's score, nulls last, names break ties."""
    return ranked.withColumn("rank", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.col(score).desc_nulls_last(), trend)))


def master_report(forecasts: DataFrame, group: str = "cluster_id") -> DataFrame:
    """Forecasts (group, model, date, type, z_score) of one model a group -> current z, mean
    forecast, their difference, status and peak month."""
    z = F.col("z_score")
    fit, ahead = F.col("type") == "Fit", F.col("type") == "Forecast"
    g = forecasts.where(z.isNotNull()).groupBy(group, "model").agg(
        F.coalesce(F.max_by(F.when(fit, z), F.when(fit, F.col("date"))), F.lit(0.0)).alias("_c"),
        F.avg(F.when(ahead, z)).alias("_a"),
        F.min_by(F.col("date"), F.when(ahead, F.struct(-z, F.col("date")))).alias("peak"),
    ).where("_a is not null")
    d = F.col("_a") - F.col("_c")
    return g.select(group, "model", status(d).alias("status"), F.round("_c", 2).alias("current_z"), F.round("_a", 2).alias("forecast_avg_z"), F.round(d, 2).alias("z_delta"), F.date_format("peak", "MMM yyyy").alias("peak_month"))


def best_model(forecasts: DataFrame, actual: DataFrame, group: str = "cluster_id") -> DataFrame:
    """(group, model): the forest where it has a forecast, else the least error of fit, else the first by name."""
    err = forecasts.where("type = 'Fit'").join(actual, [group, "date"]).groupBy(group, "model").agg(F.sqrt(F.avg(F.pow(F.col("z_score") - F.col("actual"), 2))).alias("rmse"))
    has = forecasts.where("type = 'Forecast'").select(group, "model").distinct().join(err, [group, "model"], "left")
    order = Window.partitionBy(group).orderBy((F.col("model") != "RandomForest").cast("int"), F.col("rmse").asc_nulls_last(), "model")
    return has.withColumn("_r", F.row_number().over(order)).where("_r = 1").select(group, "model", F.round("rmse", 6).alias("rmse"))


def category_level(reports: DataFrame, category: str = "category", stream: str = "stream") -> DataFrame:
    """Mean of the streams' means, so that every stream weighs the same; the overall level is the row of a null category."""
    per = reports.groupBy(category, stream).agg(F.avg("z_delta").alias("_m"))
    cat = per.groupBy(category).agg(F.avg("_m").alias("_z"), F.count(F.lit(1)).alias("n_streams"))
    top = reports.groupBy(stream).agg(F.avg("z_delta").alias("_m")).agg(F.avg("_m").alias("_z"), F.count(F.lit(1)).alias("n_streams"))
    both = cat.unionByName(top.withColumn(category, F.lit(None).cast("string")))
    return both.select(category, "n_streams", F.round("_z", 6).alias("z_delta"), status(F.col("_z")).alias("status"))


def yearly_view(growth: DataFrame, key: str, year: str, cumulative: str) -> DataFrame:
    """(key, year, yoy, cagr): growth over the last year that has a value, and the yearly mean so far, from cumulative percent."""
    by = Window.partitionBy(key).orderBy(year)
    before = F.coalesce(F.last(cumulative, ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    yoy = ((100 + F.col(cumulative)) / F.nullif(100 + before, F.lit(0.0)) - 1) * 100
    cagr = (F.pow(1 + F.col(cumulative) / 100, 1 / F.col(year)) - 1) * 100
    return growth.select(key, year, F.round(yoy, 2).alias("yoy_pct"), F.round(cagr, 2).alias("cagr_pct"))


__all__ = ["cagr_pct", "scores", "expected_levels", "roll_up", "market_snapshot", "market_expected_pct", "rank_trends", "rerank", "master_report", "best_model", "category_level", "yearly_view"]
