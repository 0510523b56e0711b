from pyspark.sql import functions as F

from weftline.operators import assembly, gates
from weftline.operators.catalogue import balanced
from weftline.sources import markup, sinks
from weftline.sources.readers import cell_rows


def one(spark, *cols):
    return tuple(spark.range(1).select(*(c.alias(f"c{i}") for i, c in enumerate(cols))).first())


def test_purpose(spark):
    said = ["People plan ahead.", "They search 'how to prepare hair' often.", "Growing in June", None, "ซื้อเพราะชอบ", "ค้นหาครีม"]
    got = one(spark, *(gates.states_purpose(F.lit(s).cast("string")) for s in said), gates.states_purpose(F.lit("about feeling dry skin"), F.lit("feeling dry skin")))
    assert got == (True, False, False, False, True, False, False)


def test_valid_text(spark):
    got = one(spark, *(gates.valid_text(F.lit(t).cast("string"), lang, 3) for t, lang in ((None, "en"), ("  ", "en"), ("a 'ครีม' b", "en"), ("ครีม", "en"), ("a b c d", "en"), ("ครีม", "th"), ("cream", "th"))))
    assert got == ("empty", "empty", "ok", "language", "too long", "ok", "language")
    lists = [F.array(F.lit("a"), F.lit("")), F.array(F.lit("x"), F.lit(" ")), F.array(F.lit("x"), F.lit("y")), F.array(F.lit("x"))]
    assert one(spark, *(gates.same_shape(lists[0], x) for x in lists[1:])) == (True, False, False)


def test_percents(spark):
    allowed = gates.allowed_numbers(F.array(F.lit(-12.34), F.lit(None).cast("double")))
    assert one(spark, allowed, *(gates.percents_allowed(F.lit(t), allowed) for t in ("up 12%", "12.3 % down", "13%", "12 cases"))) == ([12.0, 12.3], True, True, False, True)


def test_columns_are_packed_best():
    import itertools

    def cost(heights, capacity, gap, columns):
        return sum(max(0.0, capacity - sum(h) - gap * (len(h) - 1)) ** 2 for h in ([x for x, c in zip(heights, columns) if c == k] for k in range(max(columns) + 1)))

    for heights in ([3.0, 4.0, 5.0, 2.0, 1.0], [10.0, 1.0, 9.0], [2.0] * 6, [50.0], []):
        got = gates.pack_columns(heights, 10.0, 1.0)
        assert len(got) == len(heights)
        if len(heights) < 2:
            continue
        every = []
        for cuts in itertools.product((0, 1), repeat=len(heights) - 1):
            c = [0, *itertools.accumulate(cuts)]
            groups = [[h for h, k in zip(heights, c) if k == g] for g in range(c[-1] + 1)]
            if all(len(g) == 1 or sum(g) + len(g) - 1 <= 10 for g in groups):
                every.append(cost(heights, 10.0, 1.0, c))
        assert abs(cost(heights, 10.0, 1.0, got) - min(every)) < 1e-9


def test_keys_are_used_up(spark):
    keys = spark.createDataFrame([("a", 2), ("b", 0), ("c", 1)], "key string, quota long")
    requests = spark.createDataFrame([(i,) for i in range(5)], "r long")
    got = {x.r: x.served_by for x in gates.key_for_request(keys, requests, "quota", "key", "r").collect()}
    assert got == {0: "a", 1: "a", 2: "c", 3: None, 4: None}


def test_markup():
    page = '<div><a class="title-link" href="/x?a=1&amp;b=2">A &lt;b&gt; title</a><span class="journal">J</span></div><a class="title-link big" href="/y">Second</a>'
    assert markup.result_stubs(page) == [("A <b> title", "/x?a=1&b=2", "J"), ("Second", "/y", None)]
    assert markup.result_stubs(None) == [] and markup.result_stubs("<p>") == []
    r = markup.article_record('<meta name="citation_title" content="T"/><meta name="citation_author" content="Q, R"><h2>Aim</h2><p>One.</p><figcaption>F1</figcaption><ol><li class="reference">R1</li><li>no</li></ol>')
    assert (r["title"], r["authors"], r["body"], r["captions"], r["references"]) == ("T", ["Q, R"], "## Aim\n\nOne.", ["F1"], ["R1"])
    assert markup.jats_record("<broken") is None and markup.jats_record(None) is None
    x = markup.jats_record('<article><front><article-title>T <i>x</i></article-title><pub-date pub-type="ppub"><year>2020</year></pub-date><pub-date pub-type="epub"><month>3</month><year>2019</year></pub-date></front><body><sec><title>A</title><p>p</p><sec><title>B</title><p>q</p></sec></sec></body></article>')
    assert (x["title"], x["date"], x["body"]) == ("T x", "2019-03", "## A\n\np\n\n### B\n\nq")


def test_conclusions():
    assert markup.conclusions("# Intro\nx\n## 4. Conclusions\nDone.\n\nWell.\n# References\n1") == "Done.\n\nWell."
    assert markup.conclusions("Long text. Conclusion: it works.") == "it works."
    assert markup.conclusions("nothing here") is None and markup.conclusions(None) is None


def test_open_json_is_closed():
    assert balanced('say {"a": [1, 2') == '{"a": [1, 2]}' and balanced('{"a": "b') == '{"a": "b"}' and balanced('{"a": 1} tail {') == '{"a": 1}'
    assert balanced("none") is None and balanced(None) is None and balanced('{"a": "}", ') == '{"a": "}"}'


def test_workbook_round_trip():
    book = sinks.workbook_bytes({"one": [["a", "b"], ["x <&> y", None], [None, "ครีม"]], "two": [["c"]]})
    assert cell_rows(book, 1) == [["a", "b"], ["x <&> y"], [None, "ครีม"]] and cell_rows(book, 2) == [["c"]]


def test_lookups(spark):
    w = spark.createDataFrame([("a",), ("b",), ("c",), ("a",)], "k string")
    one_, two = spark.createDataFrame([("b", 1)], "k string, v int"), spark.createDataFrame([("a", 2), ("b", 3)], "k string, v int")
    assert {tuple(r) for r in assembly.first_found(w, "k", {"one": one_, "two": two}, "v").collect()} == {("a", 2, "two"), ("b", 1, "one")}
    own = spark.createDataFrame([("a", 9), ("z", 8)], "k string, v int")
    assert {tuple(r) for r in assembly.overridden(own, ["k"], two, ["v"]).collect()} == {("a", 2, True), ("z", 8, False)}


def test_labels_do_not_touch(spark):
    p = spark.createDataFrame([("g", 0.0, y, i) for i, y in enumerate([1.0, 1.5, 2.0, 9.0, 9.1])], "g string, x double, y double, id long")
    slots = [r.slot for r in assembly.label_slots(p, "g", "x", "y", "id", 2.0).orderBy("slot").collect()]
    assert slots == [1.0, 3.0, 5.0, 9.0, 11.0]
