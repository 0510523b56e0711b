"""Models over series: pooled forests, walk-forward checks, forecasts of single series."""

from __future__ import annotations

import hashlib
import json
import math

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftline.operators.ranking import average_rank

BASE = ["growth_past_12m", "growth_past_6m", "growth_past_3m", "slope_24m", "level_vs_peak", "volatility_12m", "pct_nonzero_24m", "z_now", "months_since_first_search", "yoy_3m", "yoy_6m", "accel_12m"]
LONG = [*BASE, "growth_past_36m", "years_up_of_5", "slope_60m"]


def forest(features: list[str], target: str, trees: int = 300, leaf: int = 20, seed: int = 42) -> Pipeline:
    """Median imputation with a flag for what was missing, then a random forest."""
    made = [f"_{c}" for c in features]
    return Pipeline(stages=[Imputer(strategy="median", inputCols=features, outputCols=made), VectorAssembler(inputCols=[*made, *(f"_no_{c}" for c in features)], outputCol="_x"), RandomForestRegressor(featuresCol="_x", labelCol=target, predictionCol="prediction", numTrees=trees, minInstancesPerNode=leaf, seed=seed)])


def flagged(df: DataFrame, features: list[str]) -> DataFrame:
    x = df.withColumns({c: F.when(F.col(c).isNotNull() & ~F.isnan(c), F.col(c).cast("double")).otherwise(F.lit(float("nan"))) for c in features})
    return x.withColumns({f"_no_{c}": F.isnan(c).cast("double") for c in features})


def train(samples: DataFrame, year: int, end: int, last: str, trees: int = 300, features: list[str] | None = None) -> PipelineModel:
    """Forest of one horizon, from samples whose outcome ends by the last trusted month."""
    features = features or (BASE if year == 1 else LONG)
    known = samples.where(F.col(f"t_y{year}").isNotNull() & (F.add_months("month", end) <= F.lit(last).cast("date")))
    x = flagged(known, features)
    # A feature that no sample has yet can't tell anything: it is one value while the forest grows.
    has = x.agg(*(F.count(F.when(~F.isnan(c), 1)).alias(c) for c in features)).first()
    return forest(features, f"t_y{year}", trees).fit(x.withColumns({c: F.lit(0.0) if not has[c] else F.col(c) for c in features}))


def predict(model: PipelineModel, rows: DataFrame, features: list[str]) -> DataFrame:
    keep = rows.columns
    return model.transform(flagged(rows, features)).select(*keep, F.round("prediction", 6).alias("prediction"))


def frozen_path(folder: str, digest: str, parameters: dict) -> str:
    """Where the model of these data and parameters lies."""
    return f"{folder}/{hashlib.sha256((digest + json.dumps(parameters, sort_keys=True)).encode()).hexdigest()[:24]}"


def digest_of(df: DataFrame) -> str:
    """A digest of a table's rows, whatever their order; repeated rows count."""
    row = F.xxhash64(*df.columns)
    n, a, b = df.agg(F.count(F.lit(1)), F.sum(F.pmod(row, F.lit(1 << 31))), F.sum(F.pmod(F.shiftright(row, 31), F.lit(1 << 31)))).first()
    return f"{n}-{a}-{b}"


def frozen(samples: DataFrame, year: int, end: int, last: str, folder: str, trees: int = 300) -> PipelineModel:
    """The forest of these data and parameters: loaded where it has been fitted before, else fitted and kept."""
    spark = samples.sparkSession
    path = frozen_path(folder, digest_of(samples), {"year": year, "end": end, "last": last, "trees": trees})
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/metadata/_SUCCESS")
    if at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return PipelineModel.load(path)
    model = train(samples, year, end, last, trees)
    model.write().overwrite().save(path)
    return model


#: Samples below which a horizon isn't fitted.
ENOUGH = 100


def known_by(samples: DataFrame, year: int, end: int, last: str) -> int:
    """Samples whose outcome of that year is known by the month `last`."""
    return samples.where(F.col(f"t_y{year}").isNotNull() & (F.add_months("month", end) <= F.lit(last).cast("date"))).count()


def pooled_predictions(samples: DataFrame, rows: DataFrame, last: str, folder: str, key: str = "keyword", years: tuple[int, ...] = (1, 2, 3, 4, 5), trees: int = 300) -> DataFrame:
    """rows (key, features) with pred_y1 to pred_y5 from one frozen forest a year ahead; a year whose
    outcomes are known for under ENOUGH samples has null predictions."""
    out = rows
    for h in years:
        if known_by(samples, h, 12 * h, last) < ENOUGH:
            out = out.withColumn(f"pred_y{h}", F.lit(None).cast("double"))
            continue
        p = predict(frozen(samples, h, 12 * h, last, folder, trees), rows, BASE if h == 1 else LONG)
        out = out.join(p.select(key, F.col("prediction").alias(f"pred_y{h}")), key, "left")
    return out


def walk_forward(samples: DataFrame, cutoffs: list[str], years: tuple[int, ...] = (1, 2, 3, 4, 5), key: str = "keyword", trees: int = 300) -> DataFrame:
    """(cutoff, year, key, y, prediction, momentum, reversion): what each cut-off's forests say of
    the samples of its month. A forest sees outcomes known by the cut-off and none of the keys
    it is asked about: keys are cut in two halves, each told by the other's forest. Years without ENOUGH known
    samples or without outcomes are left out."""
    half = F.pmod(F.xxhash64(key), F.lit(2))
    x, out = samples.withColumn("_half", half), None
    for c in cutoffs:
        for h in years:
            test = x.where((F.col("month") == F.lit(c).cast("date")) & F.col(f"t_y{h}").isNotNull())
            if test.limit(1).count() == 0:
                continue
            for side in (0, 1):
                known = x.where(F.col("_half") != side)
                if known_by(known, h, 12 * h, c) < ENOUGH // 2:
                    continue
                p = predict(train(known, h, 12 * h, c, trees), test.where(F.col("_half") == side), BASE if h == 1 else LONG)
                p = p.select(F.lit(c).alias("cutoff"), F.lit(h).alias("year"), key, F.col(f"t_y{h}").alias("y"), "prediction", F.col("growth_past_12m").alias("momentum"), (-F.col("z_now")).alias("reversion"))
                out = p if out is None else out.unionByName(p)
    if out is None:
        raise ValueError("no cut-off has outcomes")
    return out


def calibration(told: DataFrame) -> DataFrame:
    """(cutoff, year, n, spearman, error, low, high): rank correlation, median error and the 10 to 90 % band of the
    ratio of outcome to prediction."""
    ratio = F.exp(F.col("y") - F.col("prediction")) - 1
    band = told.groupBy("cutoff", "year").agg(F.round(F.median(F.abs(ratio)), 4).alias("error"), F.percentile(ratio, F.array(F.lit(0.1), F.lit(0.9))).alias("_p"))
    return spearman(told, ["cutoff", "year"], "prediction", "y").join(band.select("cutoff", "year", "error", F.round(F.col("_p")[0], 4).alias("low"), F.round(F.col("_p")[1], 4).alias("high")), ["cutoff", "year"])


def contest(told: DataFrame) -> DataFrame:
    """(year, method, n, spearman): the forests against momentum, mean reversion and the blend of the
    percentiles of forest and momentum, over all cut-offs."""
    x = told.where("momentum is not null and reversion is not null")
    x = average_rank(average_rank(x, ["cutoff", "year"], "prediction", "_a"), ["cutoff", "year"], "momentum", "_b").withColumn("blend", (F.col("_a") + F.col("_b")) / 2)
    out = None
    for m in ("prediction", "momentum", "reversion", "blend"):
        r = spearman(x, ["cutoff", "year"], m, "y").groupBy("year").agg(F.sum("n").alias("n"), F.round(F.avg("spearman"), 6).alias("spearman")).select("year", F.lit({"prediction": "model"}.get(m, m)).alias("method"), "n", "spearman")
        out = r if out is None else out.unionByName(r)
    return out


def spearman(df: DataFrame, groups: list[str], a: str, b: str) -> DataFrame:
    """Rank correlation with average ranks."""
    x = df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    return average_rank(average_rank(x, groups, a, "_a"), groups, b, "_b").groupBy(*groups).agg(F.count(F.lit(1)).alias("n"), F.round(F.corr("_a", "_b"), 6).alias("spearman"))


def holt_winters(y: np.ndarray, ahead: int, season: int = 12) -> np.ndarray:
    """Additive level, trend and season, smoothing chosen from a small grid by the one-step error."""
    n = len(y)
    if n < 2 * season:
        season = 1
    best = None
    for a in (0.1, 0.3, 0.6):
        for b in (0.01, 0.1):
            for g in (0.05, 0.2) if season > 1 else (0.0,):
                level, trend = y[:season].mean(), (y[season : 2 * season].mean() - y[:season].mean()) / season if season > 1 else 0.0
                s = (y[:season] - level).tolist() if season > 1 else [0.0]
                err = 0.0
                for t in range(n):
                    k = t % season
                    guess = level + trend + s[k]
                    err += (y[t] - guess) ** 2
                    before = level
                    level = a * (y[t] - s[k]) + (1 - a) * (level + trend)
                    trend = b * (level - before) + (1 - b) * trend
                    s[k] = g * (y[t] - level) + (1 - g) * s[k] if season > 1 else 0.0
                if best is None or err < best[0]:
                    best = (err, level, trend, list(s))
    _, level, trend, s = best
    return np.array([level + trend * (h + 1) + s[(n + h) % len(s)] for h in range(ahead)])


def least_squares(y: np.ndarray, ahead: int, lags: tuple[int, ...] = (1, 3, 12)) -> np.ndarray:
    """Linear model on lags, applied step by step."""
    m = max(lags)
    if len(y) <= m + 4:
        return np.repeat(y[-1], ahead)
    x = np.column_stack([np.ones(len(y) - m), *(y[m - k : len(y) - k] for k in lags)])
    w = np.linalg.lstsq(x.T @ x + 1e-6 * np.eye(x.shape[1]), x.T @ y[m:], rcond=None)[0]
    out = y.tolist()
    for _ in range(ahead):
        out.append(float(w @ [1.0, *(out[-k] for k in lags)]))
    return np.array(out[-ahead:])


class RegressionTree:
    """A regression tree over a few columns, by least squares."""

    def __init__(self, x: np.ndarray, y: np.ndarray, depth: int, leaf: int, rng: np.random.Generator | None = None, part: float = 1.0) -> None:
        self.nodes: list[tuple] = []
        self.part, self.rng, self.leaf = part, rng, leaf
        self._grow(x, y, depth)

    def _grow(self, x: np.ndarray, y: np.ndarray, depth: int) -> int:
        at = len(self.nodes)
        self.nodes.append((-1, float(y.mean()), 0, 0))
        n, width = x.shape
        if depth and n >= 2 * self.leaf:
            columns = range(width) if self.rng is None else self.rng.permutation(width)[: max(1, round(self.part * width))]
            best = (1e-12, -1, 0.0)
            for c in columns:
                order = np.argsort(x[:, c], kind="stable")
                v, t = x[order, c], np.cumsum(y[order])
                k = np.arange(self.leaf, n - self.leaf + 1)
                k = k[v[k - 1] < v[np.minimum(k, n - 1)]]
                if len(k):
                    gain = t[k - 1] ** 2 / k + (t[-1] - t[k - 1]) ** 2 / (n - k) - t[-1] ** 2 / n
                    i = int(gain.argmax())
                    if gain[i] > best[0]:
                        best = (float(gain[i]), int(c), float((v[k[i] - 1] + v[k[i]]) / 2))
            if best[1] >= 0:
                low = x[:, best[1]] <= best[2]
                left = self._grow(x[low], y[low], depth - 1)
                right = self._grow(x[~low], y[~low], depth - 1)
                self.nodes[at] = (best[1], best[2], left, right)
        return at

    def value(self, row: np.ndarray) -> float:
        c, v, left, right = self.nodes[0]
        while c >= 0:
            c, v, left, right = self.nodes[left if row[c] <= v else right]
        return v


#: Lags and length of the mean that single-series trees look at.
LAGS, MEAN = (1, 2, 3, 6, 12), 3


def _lagged(y: np.ndarray) -> np.ndarray:
    return np.array([*(y[-k] for k in LAGS), y[-MEAN:].mean(), y[-MEAN:].std(), len(y) % 12])


def stepwise(y: np.ndarray, ahead: int, kind: str, seed: int = 42, trees: int = 60) -> np.ndarray:
    """A forest or boosted trees on lags of one series, applied step by step."""
    first = max(LAGS)
    if len(y) < first + 8:
        return np.repeat(y[-1], ahead)
    x = np.array([_lagged(y[:i]) for i in range(first, len(y))])
    t, rng = y[first:], np.random.default_rng(seed)
    if kind == "forest":
        grown = []
        for _ in range(trees):
            draw = rng.integers(0, len(t), len(t))
            grown.append(RegressionTree(x[draw], t[draw], 8, 2, rng, 0.5))
        told = lambda r: sum(g.value(r) for g in grown) / len(grown)
    else:
        base, rate, grown = float(t.mean()), 0.1, []
        rest = t - base
        for _ in range(trees):
            g = RegressionTree(x, rest, 3, 3)
            rest = rest - rate * np.array([g.value(r) for r in x])
            grown.append(g)
        told = lambda r: base + rate * sum(g.value(r) for g in grown)
    out = y.tolist()
    for _ in range(ahead):
        out.append(told(_lagged(np.array(out))))
    return np.array(out[-ahead:])


def naive(y: np.ndarray, ahead: int) -> dict[str, np.ndarray]:
    drift = (y[-1] - y[0]) / max(1, len(y) - 1)
    year = np.resize(y[-12:], ahead) if len(y) >= 12 else np.repeat(y[-1], ahead)
    return {"persistence": np.repeat(y[-1], ahead), "seasonal": year, "drift": y[-1] + drift * np.arange(1, ahead + 1)}


def stable(f: np.ndarray, y: np.ndarray) -> bool:
    """Whether a forecast stays within the larger of 15 and 20 spans of its series."""
    return bool(np.isfinite(f).all() and np.abs(f).max() <= max(15.0, 20 * (y.max() - y.min())))


def _models(y: np.ndarray, ahead: int) -> dict[str, np.ndarray]:
    return {"Holt-Winters": holt_winters(y, ahead), "RandomForest": stepwise(y, ahead, "forest"), "LinearRegression": least_squares(y, ahead), "BoostedTrees": stepwise(y, ahead, "boosted"), **naive(y, ahead)}


def forecast_series(df: DataFrame, key: str, month: str, value: str, ahead: int = 36, least: int = 8, holdout: int = 6) -> DataFrame:
    """(key, model, month, value, holdout_rmse) of each series, by smoothing, a forest, linear lags, boosted
    trees and the naive forecasts; unstable forecasts and series of under eight rows give none.
    holdout_rmse is the error over the last `holdout` months of the model that doesn't know
    them; null where too few are left. A series is a few hundred months, so a group is of bounded size."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(month)
        y = pdf[value].to_numpy(dtype=float)
        rows = []
        if len(y) >= least:
            months = pd.date_range(pd.Timestamp(pdf[month].iloc[-1]), periods=ahead + 1, freq="MS")[1:]
            short = _models(y[:-holdout], holdout) if len(y) - holdout >= least else {}
            for name, f in _models(y, ahead).items():
                rmse = float(np.sqrt(np.mean((short[name] - y[-holdout:]) ** 2))) if name in short else None
                if stable(f, y):
                    rows += [(pdf[key].iloc[0], name, d.date(), float(v), rmse) for d, v in zip(months, f, strict=True)]
        return pd.DataFrame(rows, columns=[key, "model", "month", "value", "holdout_rmse"])

    return df.groupBy(key).applyInPandas(run, f"{key} string, model string, month date, value double, holdout_rmse double")


def bootstrap_mean(df: DataFrame, entity: str, value: str, rounds: int = 200, seed: int = 42) -> DataFrame:
    """Mean and its 2.5 to 97.5 % range when whole entities are drawn again: each draw takes
    an entity a Poisson number of times, from sums by entity (beyond 17 times the chance is under 1e-16)."""
    e = df.groupBy(entity).agg(F.sum(value).alias("_s"), F.count(value).alias("_n"))
    draws = e.select("*", F.explode(F.sequence(F.lit(1), F.lit(rounds))).alias("_d"))
    u = (F.pmod(F.xxhash64(F.lit(seed), entity, "_d"), F.lit(1 << 53)) + 0.5) / float(1 << 53)
    w = sum(((u > p).cast("int") for p in np.cumsum([np.exp(-1.0) / math.factorial(k) for k in range(18)]).tolist()), F.lit(0))
    each = draws.withColumn("_w", w).groupBy("_d").agg((F.sum(F.col("_w") * F.col("_s")) / F.nullif(F.sum(F.col("_w") * F.col("_n")), F.lit(0))).alias("m"))
    p = each.agg(F.percentile("m", F.array(F.lit(0.025), F.lit(0.975))).alias("p"))
    return df.agg(F.round(F.avg(value), 6).alias("mean")).crossJoin(p).select("mean", F.round(F.col("p")[0], 6).alias("low"), F.round(F.col("p")[1], 6).alias("high"))  # one row each
