"""Monthly series: point-in-time features, targets, noise, seasons and lags.

All operators take a long table (key, month DATE at month start, value) and use windows
partitioned by key, so one shuffle on the key serves a whole chain.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions.semantics import full, log_growth, rows

YEARS = {1: (1, 12), 2: (13, 24), 3: (25, 36), 4: (37, 48), 5: (49, 60)}


def dense_months(df: DataFrame, key: str, month: str, value: str) -> DataFrame:
    """A row for each month between a key's first and last; missing values are 0."""
    span = df.groupBy(key).agg(F.min(month).alias("_a"), F.max(month).alias("_b"))
    spine = span.select(key, F.explode(F.sequence("_a", "_b", F.expr("interval 1 month"))).alias(month))
    return spine.join(df, [key, month], "left").withColumn(value, F.coalesce(value, F.lit(0.0)))


def monthly_mean(df: DataFrame, key: str, date: str, value: str) -> DataFrame:
    return df.groupBy(key, F.trunc(date, "MM").alias("month")).agg(F.avg(value).alias("value"))


def _slope(y: Column, key: str, month: str, n: int) -> Column:
    """Least-squares slope over the last n rows: sums against the row number, as the
    frame's own positions have a known mean and spread."""
    over = rows(month, -(n - 1), 0, key)
    i = F.col("_i")
    mean_i = F.avg(i).over(over)
    spread = n * (n * n - 1) / 12
    s = (F.sum(i * y).over(over) - mean_i * F.sum(y).over(over)) / spread
    return F.when(F.count(y).over(over) == n, s)


def features(df: DataFrame, key: str = "keyword", month: str = "month", value: str = "value") -> DataFrame:
    """15 features at each month from that month and earlier ones only, plus the flag
    `enough` (24 months of history, 6 of the last 12 above 0, their mean at least 1)."""
    v = F.col(value)
    to = lambda a, b: rows(month, a, b, key)
    mean = lambda a, b: full(v, to(a, b), b - a + 1)
    x = df.withColumn("_i", F.row_number().over(Window.partitionBy(key).orderBy(month)).cast("double") - 1).withColumn("_l", F.log(v + 1))
    x = x.withColumn("_d", F.col("_l") - F.lag("_l").over(Window.partitionBy(key).orderBy(month)))
    last, std = mean(-11, 0), full(v, to(-11, 0), 12, F.stddev_samp)
    years = [mean(-12 * k - 11, -12 * k) for k in range(6)]
    ups = sum(((years[k] > years[k + 1]).cast("double") for k in range(5)), F.lit(0.0))
    seen = F.min(F.when(v > 0, F.col("_i"))).over(to(Window.unboundedPreceding, 0))
    f = {
        "growth_past_12m": log_growth(last, years[1]),
        "growth_past_6m": log_growth(mean(-5, 0), mean(-11, -6)),
        "growth_past_3m": log_growth(mean(-2, 0), mean(-5, -3)),
        "slope_24m": _slope(F.col("_l"), key, month, 24),
        "level_vs_peak": last / F.greatest(F.max(v).over(to(Window.unboundedPreceding, 0)), F.lit(1.0)),
        "volatility_12m": full(F.col("_d"), to(-11, 0), 12, F.stddev_pop),
        "pct_nonzero_24m": full((v > 0).cast("double"), to(-23, 0), 24),
        "z_now": F.when(std > 0, (v - last) / std).when(std.isNotNull(), 0.0),
        "months_since_first_search": F.when(seen.isNull(), F.col("_i")).otherwise(F.col("_i") - seen),
        "growth_past_36m": log_growth(last, years[3]),
        "years_up_of_5": F.when(years[5].isNotNull(), ups),
        "slope_60m": _slope(F.col("_l"), key, month, 60),
        "yoy_3m": log_growth(mean(-2, 0), mean(-14, -12)),
        "yoy_6m": log_growth(mean(-5, 0), mean(-17, -12)),
        "accel_12m": log_growth(last, years[1]) - log_growth(years[1], years[2]),
    }
    above = F.sum((v > 0).cast("int")).over(to(-11, 0))
    enough = (F.col("_i") >= 23) & (above >= 6) & (last >= 1)
    return x.withColumns(f | {"past12": last, "enough": F.coalesce(enough, F.lit(False))}).drop("_i", "_l", "_d")


def targets(df: DataFrame, key: str = "keyword", month: str = "month", value: str = "value") -> DataFrame:
    """t_y1..t_y5: growth of the mean of a later year over the last 12 months; null where the year is not complete."""
    v = F.col(value)
    last = full(v, rows(month, -11, 0, key), 12)
    return df.withColumns({f"t_y{h}": log_growth(full(v, rows(month, a, b, key), 12), last) for h, (a, b) in YEARS.items()})


def samples(df: DataFrame, start: str, key: str = "keyword", month: str = "month", value: str = "value") -> DataFrame:
    """Training rows: features and targets of every month from start with enough data."""
    return targets(features(df, key, month, value), key, month, value).where(F.col("enough") & (F.col(month) >= F.lit(start).cast("date")))


def running_peak_scaled(df: DataFrame, key: str, month: str, value: str) -> DataFrame:
    """value as it would have been scaled then: its own peak so far is 100."""
    peak = F.max(value).over(rows(month, Window.unboundedPreceding, 0, key))
    return df.withColumn("scaled", F.when(peak > 0, F.col(value) * 100 / peak).otherwise(F.col(value)))


def rolling_z(df: DataFrame, key: str, month: str, value: str) -> DataFrame:
    """z of the last 12 rows with this one, from 4 rows on; no spread or too few rows gives 0."""
    over = rows(month, -11, 0, key)
    sd = F.stddev_samp(value).over(over)
    z = F.when((F.count(value).over(over) >= 4) & (sd > 0), (F.col(value) - F.avg(value).over(over)) / sd)
    return df.withColumn("z_score", F.coalesce(z, F.lit(0.0)))


def lag_features(df: DataFrame, key: str, month: str, target: str, volume: str, global_median: bool = True) -> DataFrame:
    """Lags 1, 3 and 12, mean and spread of the three rows before, velocity, stability
    flags and the calendar. Missing values become 0. The search-stability line is the
    median over all keys, or of each key."""
    by = Window.partitionBy(key).orderBy(month)
    before = rows(month, -3, -1, key)
    x = df.withColumns({f"lag_{n}": F.lag(target, n).over(by) for n in (1, 3, 12)})
    x = x.withColumns({"rolling_mean_3m": full(F.col(target), before, 3), "z_volatility_3m": full(F.col(target), before, 3, F.stddev_samp), "_vol": full(F.col(volume), before, 3, F.stddev_samp)})
    if global_median:
        x = x.crossJoin(F.broadcast(x.agg(F.median("_vol").alias("_line"))))  # one row
    else:
        x = x.join(x.groupBy(key).agg(F.median("_vol").alias("_line")), key)
    m = F.month(month)
    turn = m * F.lit(2 * math.pi / 12)
    x = x.withColumns(
        {
            "z_velocity": F.col("lag_1") - F.col("lag_3"),
            "is_stable": F.coalesce((F.col("z_volatility_3m") < 0.5).cast("int"), F.lit(0)),
            "is_search_stable": F.coalesce((F.col("_vol") < F.col("_line")).cast("int"), F.lit(0)),
            "month_sin": F.sin(turn),
            "month_cos": F.cos(turn),
            "is_summer": m.isin(6, 7, 8).cast("int"),
        }
    ).drop("_vol", "_line")
    return x.fillna(0.0, ["lag_1", "lag_3", "lag_12", "rolling_mean_3m", "z_volatility_3m", "z_velocity"])


def trim_zero_runs(df: DataFrame, key: str, month: str, value: str, keep: int = 30) -> DataFrame:
    """In each run of zeros only the last `keep` rows stay."""
    by = Window.partitionBy(key).orderBy(month)
    zero = F.coalesce(F.col(value) == 0, F.lit(False))
    x = df.withColumn("_z", zero).withColumn("_new", F.coalesce((F.col("_z") != F.lag("_z").over(by)).cast("int"), F.lit(0)))
    x = x.withColumn("_run", F.sum("_new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    x = x.withColumn("_back", F.row_number().over(Window.partitionBy(key, "_run").orderBy(F.col(month).desc())))
    return x.where(~F.col("_z") | (F.col("_back") <= keep)).drop("_z", "_new", "_run", "_back")


def seasonal_factors(df: DataFrame, key: str, month: str, value: str, end: str, years: int = 4) -> DataFrame:
    """(key, calendar_month, factor): month over its 12-row block's mean, averaged over the
    last full blocks up to `end`, brought to mean 1. Keys with under 24 rows have none."""
    x = df.where(F.col(month) <= F.lit(end).cast("date"))
    back = F.row_number().over(Window.partitionBy(key).orderBy(F.col(month).desc()))
    x = x.withColumn("_back", back).where(F.col("_back") <= 12 * years).withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(key)))
    x = x.where("_n >= 24").withColumn("_block", F.floor((F.col("_n") - F.col("_back")) / 12))
    x = x.where(F.col("_block") < F.floor(F.col("_n") / 12))
    mean = F.avg(value).over(Window.partitionBy(key, "_block"))
    x = x.withColumn("_ratio", F.when(mean > 0, F.col(value) / mean)).where("_ratio is not null")
    each = x.groupBy(key, F.month(month).alias("calendar_month")).agg(F.avg("_ratio").alias("_f"))
    return each.select(key, "calendar_month", F.round(F.col("_f") / F.avg("_f").over(Window.partitionBy(key)), 4).alias("factor"))


def monthly_path(levels: DataFrame, seasonal: DataFrame, key: str, as_of: str) -> DataFrame:
    """(key, month, value): a yearly level (key, year, level) spread by the season."""
    months = levels.select(key, "level", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("_k"), "year")
    months = months.withColumn("month", F.add_months(F.lit(as_of).cast("date"), F.col("_k") + (F.col("year") - 1) * 12))
    joined = months.withColumn("calendar_month", F.month("month")).join(seasonal, [key, "calendar_month"], "left")
    return joined.select(key, "month", F.round(F.col("level") * F.coalesce("factor", F.lit(1.0)), 2).alias("value"))


def onset(df: DataFrame, key: str, month: str, value: str, share: float = 0.25, hold: int = 6) -> DataFrame:
    """(key, onset): first month whose 3-month mean reaches a share of its peak and stays there for the next months."""
    x = df.withColumn("_m", full(F.col(value), rows(month, -2, 0, key), 3))
    line = F.max("_m").over(Window.partitionBy(key)) * share
    x = x.withColumn("_ok", (F.col("_m") >= line).cast("int"))
    ahead = rows(month, 0, hold - 1, key)
    held = (F.min("_ok").over(ahead) == 1) & (F.count("_ok").over(ahead) == hold)
    return x.withColumn("_held", held).groupBy(key).agg(F.min(F.when(F.col("_held"), F.col(month))).alias("onset"))


def lag_correlation(a: DataFrame, b: DataFrame, month: str, lags: int = 12) -> DataFrame:
    """(lag, corr, n): correlation of a's value with b's value lag months later."""
    shifts = a.sparkSession.range(-lags, lags + 1).select(F.col("id").cast("int").alias("lag"))
    x = a.select(F.col(month).alias("_a"), F.col("value").alias("x")).crossJoin(F.broadcast(shifts))
    x = x.withColumn(month, F.add_months("_a", F.col("lag")))
    return x.join(b.select(month, F.col("value").alias("y")), month).groupBy("lag").agg(F.corr("x", "y").alias("corr"), F.count(F.lit(1)).alias("n"))


def level_index(df: DataFrame, key: str, month: str, value: str, base: tuple[str, str]) -> DataFrame:
    """(month, index): median over keys of value over its own mean in the base window."""
    inside = F.col(month).between(F.lit(base[0]).cast("date"), F.lit(base[1]).cast("date"))
    mean = F.avg(F.when(inside, F.col(value))).over(Window.partitionBy(key))
    return df.withColumn("_r", F.col(value) / F.nullif(mean, F.lit(0.0))).groupBy(month).agg(F.median("_r").alias("index"))


def data_quality(df: DataFrame, mapping: DataFrame, key: str, value: str, group: str) -> DataFrame:
    """Share of non-zero months of a group's keys, banded at 15 and 20 percent."""
    k = df.groupBy(key).agg((F.avg((F.col(value) != 0).cast("int")) * 100).alias("_p"))
    g = mapping.join(k, key).groupBy(group).agg(F.round(F.avg("_p"), 1).alias("pct_nonzero_mean"), F.round(F.min("_p"), 1).alias("pct_nonzero_min"), F.count(F.lit(1)).alias("n_keywords"))
    p = F.col("pct_nonzero_mean")
    return g.withColumn("data_quality", F.when(p < 15, "low").when(p < 20, "medium").otherwise("good"))
