import random
import statistics

from pyspark.sql import functions as F

from weftline.llm import canonical, look, mixture, queries, reading, topn


def test_copies_are_told_apart_by_the_order_columns(spark):
    # Equal ids with other values are other rows, in one partition or in several.
    rows = [("g", 1, 0.9), ("g", 1, 0.8), ("g", 2, 0.7), ("g", 2, 0.7), ("g", 3, None), ("g", 3, None), ("g", 4, float("nan")), ("g", 4, float("nan"))]
    for parts in (1, 3, 8):
        df = spark.createDataFrame(rows, "g string, id long, v double").repartition(parts)
        got = [(r.id, r.position) for r in topn.top_n(df, "g", [("v", False)], "id", 6).orderBy("position").collect()]
        assert got == [(1, 1), (1, 2), (2, 3), (4, 4), (3, 5)]


def test_large_integers_do_not_tie(spark):
    big = 1 << 60
    df = spark.createDataFrame([("g", 1, big + 1), ("g", 2, big + 3), ("g", 3, big + 2)], "g string, id long, v long")
    assert [r.id for r in topn.top_n(df, "g", [("v", False)], "id", 3).orderBy("position").collect()] == [2, 3, 1]
    assert [r.id for r in topn.top_n(df, "g", [("v", True)], "id", 2).orderBy("position").collect()] == [1, 3]


def test_many_groups_in_parts(spark):
    rnd = random.Random(5)
    rows = [(f"g{rnd.randrange(300)}", i, float(rnd.randrange(50))) for i in range(5000)]
    got = {(r.g, r.id) for r in topn.top_n(spark.createDataFrame(rows, "g string, id long, v double").repartition(7), "g", [("v", False)], "id", 2).collect()}
    want = set()
    for g in {r[0] for r in rows}:
        want |= {(g, i) for _, i in sorted((-v, i) for x, i, v in rows if x == g)[:2]}
    assert got == want


def test_shares_do_not_depend_on_slices(spark, monkeypatch):
    rnd = random.Random(6)
    docs = spark.createDataFrame([(i, "a" if i % 10 else "b", rnd.randrange(1, 40)) for i in range(3000)], "id long, source string, n long")
    targets = spark.createDataFrame([("a", 0.7, 1), ("b", 0.3, 3)], "source string, target_share double, max_repeats int")
    for rows in (50_000, 100):
        monkeypatch.setattr(mixture, "ROWS", rows)
        s = {r.source: r for r in mixture.shares(mixture.draw(docs, targets, "id", "source", "n"), targets, "source", "n").collect()}
        assert abs(s["a"].actual_share - 0.7) < 0.01 and abs(s["b"].actual_share - 0.3) < 0.01
    # A budget beyond what b can fill leaves it at its cap; a keeps to its weight.
    s = {r.source: r for r in mixture.shares(mixture.draw(docs, targets, "id", "source", "n", 60_000), targets, "source", "n").collect()}
    total = {r.source: r.t for r in docs.groupBy("source").agg(F.sum("n").alias("t")).collect()}
    assert s["b"].tokens == 3 * total["b"] and s["a"].tokens <= min(total["a"], 0.7 * 60_000)


def test_all_leading_words_are_tried():
    ix = canonical.Index([(1, "Korvale Japan"), (2, "Mirudo Skin"), (3, "Mirudo Hair")], [])
    cases = {"Korvale Japan Haircare Outlet Megamall Branch": 1, "KorvaleJapanMegamall": 1, "Mirudo Hair " + "and more " * 5000: 3, "k" * 100_000: 0, "Mirudo Outlet": 0}
    for value, want in cases.items():
        assert ix.best(value, 0.25, 0.02)[0] == want, value[:60]


def test_levels_follow_most_sentences(spark):
    rnd = random.Random(2)
    easy, hard = (["the cat ran to me", "we had a big red ball", "it is hot in the sun", "my dog is so good"], ["stratified covariance attenuates keratinocyte expression", "polymorphic recrystallisation mitigates confounding phototype", "histomorphometric endpoints corroborate filaggrin", "supersaturating vehicles modulate permeation kinetics"])
    docs, labels, truth = [], [], {}
    for i in range(240):
        level = 4 if i % 2 else 1
        parts = rnd.choices(hard if level == 4 else easy, k=5) + rnd.choices(easy if level == 4 else hard, k=2)
        rnd.shuffle(parts)
        docs.append((i, ". ".join(parts) + "."))
        truth[i] = level
        if i < 24:
            labels.append((i, "r", level))
    d, lab = spark.createDataFrame(docs, "id long, text string"), spark.createDataFrame(labels, "id long, rater string, reading_level int")
    got = {r.id: r for r in reading.levels(d, "id", "text", lab, "id", "rater", "reading_level").collect()}
    assert {i: r.reading_level for i, r in got.items()} == truth
    assert statistics.mean(r.difficulty for i, r in got.items() if truth[i] == 4) > statistics.mean(r.difficulty for i, r in got.items() if truth[i] == 1)


def test_levels_send_nothing_through_the_driver(spark, tmp_path, monkeypatch):
    rnd = random.Random(4)
    docs = [(i, ". ".join(rnd.choices(["the cat ran to me", "we had a big red ball"] if i % 2 else ["stratified covariance attenuates expression", "endpoints corroborate filaggrin"], k=5)), "s") for i in range(40)]
    spark.createDataFrame(docs, "doc_id long, text string, source string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, "r", 1 if i % 2 else 4) for i in range(8)], "doc_id long, rater string, reading_level int").coalesce(1).write.parquet(f"{tmp_path}/reading_labels.parquet")
    plans, real = [], reading.cut

    def watched(df):
        out = real(df)
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(reading, "cut", watched)
    found = queries.p9_profile(spark, str(tmp_path))
    assert {r.reading_level: r.n_docs for r in found.collect()} == {1: 20, 4: 20}
    plans.append(found._jdf.queryExecution().executedPlan().toString())
    assert "SortMergeJoin" in "".join(plans) and not [p for p in plans if "Broadcast" in p]


def test_look_classes(spark):
    df = spark.createDataFrame([(1, "Cream A"), (2, "Cream\u00a0A"), (2, "Cream\u00a0A"), (3, "Ｃream A"), (4, "Cream B"), (5, "Cream B"), (6, None), (7, " ")], "id long, t string")
    got = {r.id: (r.look, r.n_texts) for r in look.look_classes(df, "id", "t").collect()}
    assert set(got) == {1, 2, 3} and len({x for x, _ in got.values()}) == 1 and got[1][1] == 3
    assert {(r.left_id, r.right_id) for r in look.same_look(df, "id", "t").collect()} == {(1, 2), (1, 3), (2, 3)}
