import random

from pyspark.sql import functions as F

from weftline.operators import ranking


def rows(n=400):
    rnd = random.Random(3)
    return [(i, rnd.choice(["hot", "hot", "hot", "b", None]), rnd.choice([None, 1.0, 2.0, 2.5, 3.0]), rnd.randrange(5)) for i in range(n)]


def test_both_ways_are_equal(spark):
    data = rows()
    df = spark.createDataFrame(data, "id long, g string, v double, size long")
    for groups in (["g"], []):
        for size in (None, "size"):
            order = [F.col("v").desc_nulls_last(), "id"]
            one = {r.id: r.at for r in ranking.running(df, groups, order, size, "at").collect()}
            two = {r.id: r.at for r in ranking.running(df, groups, order, size, "at", hot=10).collect()}
            assert one == two and len(one) == len(data)
            for i, g, v, s in data[:40]:
                upto = [x for x in data if (not groups or x[1] == g) and (-(x[2] or 0), x[0]) <= (-(v or 0), i)]
                assert one[i] == (len(upto) if size is None else sum(x[3] for x in upto))


def test_average_rank(spark):
    data = rows()
    got = {r.id: r.p for r in ranking.average_rank(spark.createDataFrame(data, "id long, g string, v double, size long"), ["g"], "v", "p").collect()}
    assert len(got) == len(data)
    for i, g, v, _ in data:
        if v is None:
            assert got[i] is None
            continue
        all_ = [x[2] for x in data if x[1] == g and x[2] is not None]
        less, ties = sum(x < v for x in all_), sum(x == v for x in all_)
        assert abs(got[i] - (less + 1 + (ties - 1) / 2) / len(all_)) < 1e-12


def test_empty(spark):
    df = spark.createDataFrame([], "id long, g string, v double")
    assert ranking.running(df, ["g"], ["id"], None, "at").count() == 0 and ranking.average_rank(df, ["g"], "v", "p").count() == 0
    assert ranking.with_total(df, [], "n").count() == 0
