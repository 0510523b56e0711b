import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from weftline.llm import byte_bpe, look, mixture, reading

RANKS = f"{byte_bpe.FOLDER}/{byte_bpe.VOCABULARY}"


def test_bpe_equals_the_library():
    tiktoken = pytest.importorskip("tiktoken")
    e = byte_bpe.Encoder(RANKS)
    t = tiktoken.Encoding("own", pat_str=byte_bpe.PATTERN, mergeable_ranks=e.ranks, special_tokens={})
    rnd = random.Random(4)
    texts = ["", " ", "<|endoftext|> don't", "ครีมบำรุงผิว 50 มล.", "𝔘😀👩‍🔬 á\n\n\t x", "a" * 5000, "".join(rnd.choices("abะ กé!#@1", k=20_000)), "x" + " " * 3000 + "y"]
    texts += ["".join(rnd.choices("the anin gไทย ", k=40)) for _ in range(300)]
    for x in texts:
        assert e.encode(x) == t.encode_ordinary(x) and e.count(x) == len(e.encode(x))
        assert b"".join({i: b for b, i in e.ranks.items()}[j] for j in e.encode(x[:50])) == x[:50].encode()


def test_bpe_columns(spark):
    df = spark.createDataFrame([(1, "a b"), (2, ""), (3, None), (3, None)], "ids long, text string")
    got = [(r.ids, r.x, r.n) for r in df.select("ids", byte_bpe.token_ids(F.col("text")).alias("x"), byte_bpe.token_count(F.col("text")).alias("n")).orderBy("ids").collect()]
    assert [(i, len(x), n) for i, x, n in got] == [(1, 2, 2), (2, 0, 0), (3, 0, 0), (3, 0, 0)]
    assert df.limit(0).select(byte_bpe.token_ids(F.col("text"))).count() == 0


def test_forms():
    f = look.transducer().form
    same = [("maté leaf", "maté leaf"), ("น้ำหอม", "น้ําหอม"), ("น้ำหอม", "นํ้าหอม"), ("แป้ง", "เเป้ง"), ("é", "е​́"), ("è", "ѐ"), ("fluid", "ﬂuiԁ"), ("a b", "　a b﻿ "), ("A1(", "Ａ１（"), ("", "​͏")]
    for a, b in same:
        assert f(a) == f(b) == unicodedata.normalize("NFC", a)
    for a, b in [("mate", "maté"), ("a b", "a-b"), ("a b", "a  b"), ("a", "A"), ("a", "α"), ("3x5", "3×5")]:
        assert f(a) != f(b)
    rnd = random.Random(5)
    for _ in range(2000):
        s = "".join(rnd.choice("aéе​เแํา้่ิＡ 　ﬁx") for _ in range(8))
        assert f(f(s)) == f(s), ascii(s)


def test_pairs_equal_brute_force(spark):
    rnd = random.Random(6)
    names = ["mint gel", "mint gel", "mіnt gel", "mint-gel", "Mint gel", "ｍｉｎｔ gel", "mint gel ", "", None, "​", "x" * 100_000]
    data = [(i, rnd.choice(names), "c", 1) for i in range(120)]
    data += data[:30]
    got = {tuple(r) for r in look.same_look(spark.createDataFrame(data, "id long, t string, f string, l1 long"), "id", "t").collect()}
    f, rows = look.transducer().form, {i: t for i, t, *_ in data if t}
    assert got == {(a, b) for a in rows for b in rows if a < b and rows[a] != rows[b] and f(rows[a]) == f(rows[b]) != ""}
    entries = spark.createDataFrame([(7, "mint gel"), (8, "mint-gel"), (9, None)], "k long, w string")
    hits = {tuple(r) for r in look.same_look_in_list(spark.createDataFrame(data, "id long, t string, f string, l1 long"), "id", "t", entries, "k", "w").collect()}
    assert hits == {(i, k) for i, t in rows.items() for k, w in ((7, "mint gel"), (8, "mint-gel")) if t != w and f(t) == w}
    empty = spark.createDataFrame([], "id long, t string")
    assert look.same_look(empty, "id", "t").count() == 0 and look.same_look_in_list(empty, "id", "t", entries, "k", "w").count() == 0


def _mix(spark, docs, targets, **how):
    d = mixture.draw(spark.createDataFrame(docs, "id long, src string, tokens long, upto long, _mix long"), spark.createDataFrame(targets, "src string, target_share double, max_repeats int"), "id", "src", "tokens", **how)
    return {r.id: r.repeats for r in d.collect()}, d


def test_mixture_reaches_its_shares(spark):
    rnd = random.Random(7)
    docs = [(i, rnd.choice(["a"] * 8 + ["b", "c", None, "z"]), rnd.randrange(0, 60), 0, 0) for i in range(3000)]
    targets = [("a", 0.5, 1), ("b", 0.3, 4), ("c", 0.2, 3), ("none", 0.0, 2)]
    got, df = _mix(spark, docs, targets)
    size = {i: (s, n) for i, s, n, *_ in docs}
    total = sum(size[i][1] * r for i, r in got.items())
    for s, share, cap in targets[:3]:
        assert abs(sum(size[i][1] * r for i, r in got.items() if size[i][0] == s) / total - share) < 0.01
        assert all(r <= cap for i, r in got.items() if size[i][0] == s)
    assert all(size[i][0] in "abc" and size[i][1] > 0 for i in got) and got == _mix(spark, docs[::-1], targets)[0]
    caps = {s: sum(n for _, t, n, *_ in docs if t == s) * c / w for s, w, c in targets[:3]}
    assert 0.98 * min(caps.values()) < total <= min(caps.values())
    shares = {r.source: r for r in mixture.shares(df.withColumnRenamed("src", "source"), spark.createDataFrame(targets, "source string, target_share double, max_repeats int"), "source", "tokens").collect()}
    assert shares["none"].tokens == 0 and abs(sum(r.actual_share for r in shares.values()) - 1) < 1e-9


def test_mixture_budget_and_empty(spark):
    docs = [(i, "ab"[i % 2], 10, 0, 0) for i in range(400)]
    got, _ = _mix(spark, docs, [("a", 0.75, 2), ("b", 0.25, 2)], budget=1000)
    assert 970 <= sum(10 * r for r in got.values()) <= 1000 and abs(sum(r for i, r in got.items() if i % 2 == 0) - 75) <= 1
    assert _mix(spark, [], [("a", 1.0, 1)])[0] == {}


EASY, HARD = "we like the red ball a lot . the dog runs to me . my cat sat on it . mum got us some milk . it is so hot now . he put on his hat . ", "pharmacokinetic heterogeneity necessitated stratified randomisation . immunohistochemical quantification precluded attribution . "


def test_reading_levels_of_held_out_documents(spark):
    rnd = random.Random(8)
    docs, labels, truth = [], [], {}
    for i in range(300):
        hard = i % 2
        parts = rnd.choices((HARD if hard else EASY).split(" . ")[:-1], k=6) + (rnd.choices(EASY.split(" . ")[:-1]) if hard else [])
        docs.append((i, ". ".join(parts) + ".", 0, "n"))
        truth[i] = 4 if hard else 1
        if i < 60:
            labels += [(i, "r1", truth[i]), (i, "r1", truth[i]), (i, "r2", truth[i])]
    docs += [(900, None, 0, ""), (901, " ", 0, ""), (902, "#sale ฿90", 0, ""), (903, "https://a.b/c d", 0, ""), (904, EASY * 3000, 0, "")]
    d = spark.createDataFrame(docs, "doc long, text string, id int, nodes string")
    lab = spark.createDataFrame([*labels, (1, "x", 9), (2, "x", None)], "doc long, rater string, reading_level int")
    got = {r.doc: r.reading_level for r in reading.levels(d, "doc", "text", lab, "doc", "rater", "reading_level").collect()}
    assert got.pop(904) == 1 and got == truth
    assert reading.levels(d.limit(0), "doc", "text", lab, "doc", "rater", "reading_level").count() == 0
    assert reading.levels(d, "doc", "text", lab.limit(0), "doc", "rater", "reading_level").count() == 0
