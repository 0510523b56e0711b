import math

from pyspark.sql import functions as F

from weftline.functions import semantics as S
from weftline.operators import evidence, market, series, supply


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_percentile_rank_averages_ties(spark):
    df = spark.createDataFrame([(1, 0.2), (2, 0.0), (3, 0.1), (4, -0.2), (5, 0.1), (6, None)], "id int, v double")
    got = dict(rows(df.select("id", S.pct_rank_avg("v")), "id"))
    assert got == {1: 1.0, 2: 0.4, 3: 0.7, 4: 0.2, 5: 0.7, 6: None}


def test_grades(spark):
    df = spark.createDataFrame([(1.0,), (0.8,), (0.79,), (0.5,), (0.49,), (0.2,), (0.19,), (0.0,), (None,)], "s double")
    assert [r[0] for r in df.select(S.grade(F.col("s"))).collect()] == [4, 4, 3, 3, 2, 2, 1, 1, None]


def test_growth_features_at_a_point(spark):
    v = [10.0] * 12 + [20.0] * 12 + [40.0] * 12
    df = spark.createDataFrame([("k", f"{2000 + i // 12}-{i % 12 + 1:02d}-01", x) for i, x in enumerate(v)], "keyword string, m string, value double").withColumn("month", F.to_date("m")).drop("m")
    f = series.features(df).orderBy("month").collect()
    assert math.isclose(f[35].yoy_3m, math.log(41 / 21)) and math.isclose(f[35].yoy_6m, math.log(41 / 21))
    assert math.isclose(f[35].accel_12m, math.log(41 / 21) - math.log(21 / 11)) and f[30].accel_12m is None
    assert f[22].enough is False and f[35].enough is True


def test_features_do_not_see_the_future(spark):
    v = [float(3 + i * 7 % 11) for i in range(80)]
    make = lambda x: spark.createDataFrame([("k", f"{1990 + i // 12}-{i % 12 + 1:02d}-01", y) for i, y in enumerate(x)], "keyword string, m string, value double").withColumn("month", F.to_date("m")).drop("m")
    a, b = (series.features(make(x)).orderBy("month").collect() for x in (v, v[:60] + [99.0] * 20))
    assert [tuple(r) for r in a[:60]] == [tuple(r) for r in b[:60]]
    assert a[40].years_up_of_5 is None and a[79].years_up_of_5 is not None


def test_targets(spark):
    v = [10.0] * 24 + [20.0] * 12 + [30.0] * 12
    df = spark.createDataFrame([("k", f"{2000 + i // 12}-{i % 12 + 1:02d}-01", x) for i, x in enumerate(v)], "keyword string, m string, value double").withColumn("month", F.to_date("m")).drop("m")
    r = series.targets(df).orderBy("month").collect()[23]
    assert math.isclose(r.t_y1, math.log(21 / 11)) and math.isclose(r.t_y2, math.log(31 / 11)) and r.t_y3 is None


def test_zero_runs_keep_their_end(spark):
    df = spark.createDataFrame([("k", i, 0.0 if 2 <= i <= 6 else 1.0) for i in range(9)], "k string, m int, v double")
    assert [r.m for r in series.trim_zero_runs(df, "k", "m", "v", 2).orderBy("m").collect()] == [0, 1, 5, 6, 7, 8]


def test_cuts_and_tiers(spark):
    df = spark.createDataFrame([("a", x) for x in (1.0, 2.0, 3.0, 4.0, 5.0, 6.0)] + [("b", 5.0)] * 4 + [("c", None)], "g string, p double")
    cuts = {r.g: list(r.cuts) for r in supply.price_cuts(df, ["g"], "p", 3).collect()}
    assert cuts == {"a": [2.0, 4.0], "b": []}
    mid = {r.g: list(r.cuts) for r in supply.price_cuts(df, ["g"], "p", 3, between=True).collect()}
    assert mid == {"a": [2.5, 4.5], "b": []}
    tiers = rows(supply.assign_tiers(df.where("g = 'a'"), ["g"], "p", 3).select("p", "tier"), "p")
    assert [t for _, t in tiers] == [1, 1, 2, 2, 3, 3]


def test_leaves(spark):
    df = spark.createDataFrame([("g", 0, 0, True), ("g", 1, 1, True), ("g", 2, 2, False), ("g", 3, 1, True), ("g", 4, 2, True), ("g", 5, 0, False), ("g", 6, 1, True)], "g string, p int, l int, h boolean")
    got = {r.p: r.leaf for r in market.mark_leaves(df, "g", "p", "l", "h").collect()}
    assert got == {0: False, 1: True, 2: False, 3: False, 4: True, 5: False, 6: True}


def test_evidence_gates(spark):
    e = "Rising searches: mint cream 45% in 169 shops"
    df = spark.createDataFrame([("It grew 45%", "mint cream"), ("It grew 7%", "mint cream"), ("fine", ""), ("fine", "gold cream")], "t string, q string")
    got = [r[0] for r in df.select(evidence.gate(F.col("t"), F.col("q"), F.lit(e), "worried")).collect()]
    assert got == ["ok", "number not in evidence", "no quote", "quote not in evidence"]


def test_auc_of_one_class_is_null(spark):
    df = spark.createDataFrame([("a", 1.0, True), ("a", 2.0, True), ("b", 1.0, False), ("b", 2.0, True), ("b", 2.0, False)], "g string, s double, y boolean")
    assert dict(rows(evidence.auc(df, ["g"], "s", "y"), "g")) == {"a": None, "b": 0.75}
