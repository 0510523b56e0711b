from weftline.llm import products
from weftline.llm.canonical import Index, distance, map_rows, map_values
from weftline.llm.products import read_name

NAMES = [(1, "Korvale Japan"), (2, "Mirudo Skin"), (3, "Mirudo Hair"), (4, "TEBRISO"), (5, "QRX"), (6, "Élanvo"), (7, "Dr.Sunabel (Derma)")]
ALIASES = [(1, "KORVALE PREP"), (5, "Quenra Ruvo Xilem"), (6, "เอลานโว")]


def test_matches():
    ix = Index(NAMES, ALIASES)
    cases = {
        "korvale japan": 1, "KorvaleJapan": 1, "Kovrale Japan": 1, "Korvale": 1, "Korvale Ja": 1, "KORVALE PREP Official Store": 1, "Korvale Japan x TONIC 2026": 1, "Mirudo": 0, "Mirudo  Skin®": 2, "Mirudo Hiar (TH)": 3, "ＴＥＢＲＩＳＯ": 4,
        "TEBRSIO - Flagship": 4, "QRX Baby": 5, "QRY": 0, "Elanvo": 6, "เอลานโว Thailand": 6, "Doctor Sunabel Derma": 7, "N/A": 0, "???": 0, "Zubatel Japan": 0, "Ganlovi Skin": 0, "z" * 5000: 0,
    }
    for value, want in cases.items():
        assert ix.best(value, 0.25, 0.02)[0] == want, value


def test_distance_against_brute_force():
    import random

    def slow(a, b):
        from functools import cache

        @cache
        def d(i, j):
            if not i or not j:
                return i + j
            v = min(d(i - 1, j) + 1, d(i, j - 1) + 1, d(i - 1, j - 1) + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                v = min(v, d(i - 2, j - 2) + 1)
            return v

        return d(len(a), len(b))

    rnd = random.Random(9)
    for _ in range(500):
        a, b = ("".join(rnd.choices("abc", k=rnd.randrange(8))) for _ in "ab")
        assert distance(a, b, 99) == slow(a, b)


def test_rows(spark):
    data = [(1, "korvale japan", 0), (1, "korvale japan", 0), (2, None, 0), (3, " ", 0), (4, "Korvale Japan", 0), (5, "no brand", 0), *((100 + i, "KORVALE PREP", 0) for i in range(200))]
    df = spark.createDataFrame(data, "row long, v string, value int")
    names, others = spark.createDataFrame(NAMES, "id long, name string"), spark.createDataFrame(ALIASES, "id long, alias string")
    got = {tuple(r) for r in map_rows(df, "row", "v", names, others, "id", "name", "alias").collect()}
    assert got == {(1, 1), (5, 0), *((100 + i, 1) for i in range(200))}
    assert map_rows(df.limit(0), "row", "v", names, others, "id", "name", "alias").count() == 0
    assert {r.id for r in map_values(df, "v", names.limit(0), None, "id", "name", "").collect()} == {0}


def test_names_are_read():
    words, numbers, size = read_name("🔥Sale🔥 [Zorvani Lab] Pelumira Dew Cusion #05 Mocha 50% (2 x 15กรัม) + แถม ซอง 4 g")
    assert words == ["50%", "cusion", "dew", "lab", "mocha", "pelumira", "sale", "zorvani"]
    assert (numbers, size) == ([("5", "cusion")], ("g", 15.0, 2))
    assert read_name("") == ([], [], None)


SCHEMA = "id long, name string, brand string, subgroup string, size double, unit string, price double"
#: Words of no list: brands, lines, kinds with their spellings, scents, benefits and selling phrases.
BRANDS = ["Zorvani Lab", "Hatoniri", "Quolem Bros", "Tirrez"]
LINES = [a + b for a in ("pelu", "vasto", "iri", "moka", "bruno", "yarti", "dulca", "eken") for b in ("mira", "genta", "dolan", "sfelo", "vorri")]
KINDS = {"Lanterns": ["lantern", "hand lamp", "โคมไฟ"], "Pickles": ["pickle jar", "pickled mix", "ผักดอง"]}
SCENTS = ["walnut", "ginger", "saffron", "clove"]
PROMISED, SELLING = ["keeps warm", "อุ่นนาน", "crunchy", "กรอบ"], ["only today", "ของดี", "in 3 days", "as seen on tv", "best 100 gifts"]


def corpus():
    """Listings of known products, each written in many ways. As in a catalogue, few products of
    one line and kind have the same content."""
    import random

    rnd, rows, of = random.Random(4), [], {}
    for li, line in enumerate(LINES):
        brand = BRANDS[li % 4]
        for kind, spelt in KINDS.items():
            for ml in rnd.sample([30, 50, 75, 100, 150, 250], 4) + [100] * (li % 4 == 0):
                scent, number = rnd.choice(SCENTS), rnd.randrange(1, 9)
                for _ in range(6):
                    parts = [rnd.choice([brand, brand, brand.upper()]) if rnd.random() < 0.9 else "", line, rnd.choice(spelt), scent, rnd.choice(["no. {}", "#0{}", "แบบ {}"]).format(number), rnd.choice([f"{ml} ml", f"({ml}มล.)", f"{ml / 1000} L"])]
                    parts += [rnd.choice(PROMISED)] * (rnd.random() < 0.4) + [rnd.choice(SELLING)] * (rnd.random() < 0.4)
                    rnd.shuffle(parts)
                    i = len(rows) + 1
                    rows.append((i, " ".join(p for p in parts if p), brand if rnd.random() < 0.9 else None, kind if rnd.random() < 0.95 else None, None, None, 100.0 + ml))
                    of[i] = (line, kind, scent, number, ml)
    return rows, of


def test_groups_of_unlisted_words(spark):
    rows, of = corpus()
    want = {(a, b) for a in of for b in of if a < b and of[a] == of[b]}
    odd = [(9001, None, None, None, None, None, None), (9002, "", None, None, None, None, None), (9003, "Zorvani Lab " + "x" * 60_000, None, "Lanterns", 1.0, "ml", float("nan")), (9004, "... ###", None, None, None, None, 0.0)]
    df = spark.createDataFrame([*rows, *odd, *rows[:50]], SCHEMA)
    got = {(r.a, r.b) for r in products.pairs_of(products.same_product(df)).collect()}
    assert len(got & want) >= 0.95 * len(want) and len(got & want) >= 0.95 * len(got)
    assert not any(i > 9000 for p in got for i in p)
    hint = spark.createDataFrame([(1, 200.0), (99_999, 1.0), (10, None)], "id long, price double")
    assert {(r.a, r.b) for r in products.pairs_of(products.same_product(df, hint)).collect()} == got
    assert products.pairs_of(products.same_product(df.limit(0))).count() == 0


def test_weights_equal_counted_pairs(spark):
    rows = [(i, f"w{i % 3} shared w{i % 2}x n {i % 2}", "g%d" % (i % 4)) for i in range(24)]
    x = spark.createDataFrame([(i, name.split()[:3], [(name.split()[4], "n")], g) for i, name, g in rows], "key long, words array<string>, numbers array<struct<value: string, before: string>>, g string")
    words, numbers = products._weights(x)
    got = {r.term: r.w for r in words.collect()} | {"number": numbers.first().w}
    data = [(set(n.split()[:3]), n.split()[4], g) for _, n, g in rows]
    def rate(holds, shares):
        one = both = 0
        for i, a in enumerate(data):
            for j, b in enumerate(data):
                if i != j and a[2] == b[2] and holds(a):
                    one, both = one + 1, both + shares(a, b)
        return both / (one + products.DOUBT)
    for t in ("w0", "shared", "w1x"):
        assert abs(got[t] - rate(lambda a: t in a[0], lambda a, b: t in b[0])) < 1e-12
    assert abs(got["number"] - rate(lambda a: True, lambda a, b: a[1] == b[1])) < 1e-12


def test_torn_records_stay_apart(spark):
    t = lambda *x: list(x)
    rows = [(1, 2, t(), t(7), t(5)), (1, 3, t(), t(8), t(5)), (4, 5, t(), t(7), t(5)), (4, 6, t(), t(7, 9), t(5)), (5, 6, t(), t(9), t(5)), (10, 11, t(), t(), t())]
    rows += [(20, 21, t(), t(7), t(5)), (20, 22, t(), t(8), t(6)), (20, 23, t(), t(9), t()), (30, 31, t(), t(7), t()), (30, 32, t(), t(8), t())]
    m = spark.createDataFrame(rows, "a long, b long, more_a array<long>, more_b array<long>, shared array<long>")
    assert {tuple(r) for r in products._links(m).collect()} == {(4, 5), (4, 6), (5, 6), (10, 11), (20, 21), (20, 22)}


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40) if i != 20] + [(50, 3)]
    nodes = spark.createDataFrame([(i,) for i in [*range(42), 50, 60]], "rid long")
    got = {r.rid: r.family for r in products.components(nodes, spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 if i <= 20 else 21 for i in range(41)}, 41: 41, 50: 0, 60: 60}


RECORDS = "rid long, kind string, terms array<string>, strong array<string>, n map<long, long>"


def test_every_record_of_a_group_is_compared(spark):
    # One hot line, spelt right everywhere; stray words and brand words differ.
    rows = [(i, "k", ["zorvaline", *(["lab"] if i % 2 else []), *([f"stray{i}"] if i % 4 == 0 else [])], ["zorvaline"], {1: 3}) for i in range(60)]
    start = spark.createDataFrame([(f"stray{i}", 0.0) for i in range(60)], "term string, w double")
    pairs = products.reinforce(spark.createDataFrame(rows, RECORDS), start)
    assert {(r.a, r.b) for r in pairs.collect()} == {(a, b) for b in range(60) for a in range(b)}


def test_a_stray_word_does_not_hide_the_line(spark):
    # "irce" occurs twice, "zorvaline" is 20 times as common.
    rows = [(i, "k", ["zorvaline", *(["lab"] if i % 2 else ["rice"] if i % 3 else [])], ["zorvaline"], {1: 9}) for i in range(40)]
    rows += [(200 + i, "k", [f"line{i // 2}", "lab" if i % 2 else "rice"], [f"line{i // 2}"], {1: 9}) for i in range(160)]
    rows += [(100, "k", ["irce", "lab", "zorvaline"], ["irce", "zorvaline"], {1: 1}), (101, "other", ["irce", "mirudo"], ["irce"], {1: 1})]
    start = spark.createDataFrame([("irce", 0.0)], "term string, w double")
    got = {(r.a, r.b) for r in products.reinforce(spark.createDataFrame(rows, RECORDS), start).collect()}
    assert all((i, 100) in got for i in range(1, 40, 2)) and not any(101 in p or (p[0] < 200 <= p[1]) for p in got)
