import math
import random

import pytest
from pyspark.sql import functions as F

from weftline.llm import quantile_sketch as Q
from weftline.llm.topn import LoserTree, top_n

ORDER = [("s", False), ("r", True), ("l", False)]
SCHEMA = "g string, id long, s double, r int, l double, _run string, _at string, position string"


def brute(data, n):
    def key(t):
        null = lambda v, sign: (2, 0) if v is None else (1, 0) if v != v else (0, sign * v)
        return (null(t[2], -1), null(t[3], 1), null(t[4], -1), t[1])

    out = set()
    for g in {t[0] for t in data} - {None}:
        for k, t in enumerate(sorted({tuple(map(str, t)): t for t in data if t[0] == g}.values(), key=key)[:n]):
            out.add((g, t[1], k + 1))
    return out


def test_equals_brute_force_over_many_runs(spark):
    rnd = random.Random(2)
    data = []
    for i in range(3000):
        g = rnd.choice(["hot"] * 8 + [f"g{rnd.randrange(60)}", None])
        row = (g, i, rnd.choice([None, float("nan"), rnd.randrange(20) / 20]), rnd.choice([None, rnd.randrange(5)]), rnd.choice([None, 0.5, 0.7]), "x", "y", "z")
        data += [row] * rnd.choice([1, 1, 2])
    df = spark.createDataFrame(data, SCHEMA).repartition(13)
    got = {(r.g, r.id, r.position) for r in top_n(df, "g", ORDER, "id", 3).collect()}
    assert got == brute(data, 3)


def test_empty_and_small(spark):
    assert top_n(spark.createDataFrame([], SCHEMA), "g", ORDER, "id", 3).count() == 0
    one = spark.createDataFrame([("a", 1, None, None, None, "", "", "")] * 3, SCHEMA)
    assert [(r.id, r.position) for r in top_n(one, "g", ORDER, "id", 3).collect()] == [(1, 1)]


def test_loser_tree_merges_and_seeks():
    import numpy as np

    for k in (1, 2, 3, 5, 8):
        rnd = random.Random(k)
        runs = [sorted((g, rnd.randrange(100), i * 1000 + j) for j, g in enumerate(rnd.choices("abcd", k=30))) for i in range(k)]
        skip = []
        for r in runs:
            ends = [j + 1 for j in range(len(r)) if j + 1 == len(r) or r[j + 1][0] != r[j][0]]
            skip.append(np.array([next(e for e in ends if e > j) for j in range(len(r))]))
        got = [runs[i][j] for i, j in LoserTree(runs, skip).top(4)]
        allr = sorted(x for r in runs for x in r)
        assert got == [x for g in "abcd" for x in [y for y in allr if y[0] == g][:4]]


@pytest.mark.parametrize("error", [0.01, 0.05])
def test_percentiles_are_within_the_error_and_merge(spark, error):
    rnd = random.Random(3)
    vals = [(rnd.choice(["a", "a", "a", "b", None]), rnd.choice([None, float("nan"), 0.0, -rnd.random(), rnd.lognormvariate(0, 3), 0.5])) for _ in range(4000)]
    df = spark.createDataFrame([(g, v, 1, 2) for g, v in vals], "g string, v double, bucket int, n int").repartition(7)
    wanted = [0.0, 0.05, 0.5, 0.9, 1.0]
    whole = Q.sketch(df, ["g"], "v", error)
    parts = Q.sketch(df.where("v < 0.4"), ["g"], "v", error).unionAll(Q.sketch(df.where("not (v < 0.4) or v is null"), ["g"], "v", error))
    got = {(r.g, r.percentile): (r.value, r.n) for r in Q.percentiles(whole, ["g"], wanted, error).collect()}
    assert got == {(r.g, r.percentile): (r.value, r.n) for r in Q.percentiles(Q.merge(parts, ["g"]), ["g"], wanted, error).collect()}
    for g in ("a", "b", None):
        real = sorted(v for h, v in vals if h == g and v is not None and v == v)
        for p in wanted:
            exact = real[math.floor(p * (len(real) - 1))]
            value, n = got[g, p]
            assert n == len(real) and abs(value - exact) <= error * abs(exact) + 1e-12


def test_extremes(spark):
    inf = float("inf")
    df = spark.createDataFrame([(x,) for x in (-inf, -5e-324, 0.0, 5e-324, 1.7e308, inf)] + [(None,)], "v double")
    b = {r.v: r.b for r in df.where("v is not null").select("v", Q.bucket(F.col("v"), 0.01).alias("b")).collect()}
    order = [b[x] for x in (-inf, -5e-324, 0.0, 5e-324, 1.7e308, inf)]
    assert order == sorted(order) and b[0.0] == 0
    assert Q.percentiles(Q.sketch(df.limit(0).withColumn("g", F.lit("x")), ["g"], "v"), ["g"], [0.5]).count() == 0
