"""Listings that describe the same product, by term-pair reinforcement.

No word is known beforehand but units, multipacks and gifts: which terms tell products apart
is learned from the listings. A name is read once into its content and its terms - words,
and numbers with the word before them. Then, in turns:

* A term's weight is how reliably the listings that match one holding it hold it as well: the
  sum of the scores of the matching pairs of which both hold it over that of those of which
  one does. Words of line, brand, shade or scent gain weight, selling phrases, benefits and the
  many ways to name a kind of product lose it. A number's weight is that of the word before it.
* A pair's score is one less the weight of the terms that only one of them holds, the
  lighter of both sides: a term that is just missing costs nothing, two that stand against
  each other cost both matches. Pairs that share no discriminative term - one whose
  holders mostly agree in brand and kind - score 0, so pairs are joined through these terms.

The first turns take every two listings of one discriminative term, kind and content as
a pair; all their sums follow from counts by group and term, so none is enumerated. Groups are
split by the terms of weight until these stay the same; listings of equal kind and equal
terms of weight then fall together in records. From there pairs of records are
explicit, weighted by the listings behind them, and the turns go on until the weights settle.
Pairs at or above the threshold are clustered into families by connected components. A
record that lacks a term by which its richer matches differ is torn between them and
stays apart.

The kind is the catalogue's subgroup; where that is missing, the likeliest by the name's
terms (naive Bayes over counts of all listings).

Contents are compared last: a listing whose name states none takes, by its whole content
and its price, that of a stated one of its family, or else goes with listings of the same
whole content and a like price.

Hot groups: sums over listings run with map-side combining, records don't grow with repeated
listings, and a group of many records is paired in slices by several tasks; only the
asked-for pairs of equal products are ever expanded.

Defined results: a null or blank name, or one without terms, matches nothing; NaN or
non-positive prices and sizes count as missing; copies of a listing count once; equal
listings under two ids match; ties among candidate contents go to the nearest price, then
the fewer items; an empty table gives no rows; very long names are read whole; where no
listing has a subgroup there is one kind; turns that don't settle raise a warning.
"""

from __future__ import annotations

import math
import re
import warnings
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions.sizes import contents, folded, unit_of, without_gifts
from weftline.llm.look import transducer
from weftline.session import cut

#: Logarithms of prices of one product lie no further apart.
PRICE_GAP = 0.33
#: Weight from which a term tells products apart; pairs a weight must rest on to count in full.
TELLING, DOUBT = 0.85, 8
#: Weight of a word from which the number after it tells products apart.
NUMBER = 0.7
#: Part of a term's pairs that agree in brand and kind from which it is discriminative.
DISCRIMINATIVE = 0.2
_TERM = re.compile(r"[^\W\d_฀-๿]+(?:['.&][^\W\d_฀-๿]+)*|[ก-๎]+|\d+(?: ?%)?")


def read_name(name: str) -> tuple[list[str], list[tuple[str, str]], tuple[str, float, int] | None]:
    """(words, numbers with the word before each, content) of a listing's name."""
    s = without_gifts(folded(transducer().form(name)))
    found = contents(s)
    if found:
        s = f"{s[: found[0][3]]} | {s[found[0][4] :]}"
    words, numbers, before = set(), set(), ""
    for t in _TERM.findall(s):
        if t.isdigit():
            numbers.add((t.lstrip("0") or "0", before))
            before = "0"
        else:
            words.add(t.replace(" ", ""))
            before = t
    return sorted(words), sorted(numbers), found[0][:3] if found else None


def _read(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for p in parts:
        rows = []
        for k, i, name, brand, sub, size, unit, price in zip(p["key"], p["id"], p["name"], p["brand"], p["subgroup"], p["size"], p["unit"], p["price"], strict=True):
            words, numbers, c = read_name(name)
            if not words:
                continue
            u = unit_of(unit.lower()) if unit else None
            base, each, items, whole = (*c, c[1] * c[2]) if c else (None, None, None, None)
            if not c and u and size and size > 0:
                base, whole = u[0], float(round(size * u[1]))
            maker = "".join(x for x in folded(brand) if x.isalnum()) if brand else None
            rows.append((k, i, words, numbers, maker, sub, base, each, items, whole, math.log(price) if price and price > 0 else None))
        yield pd.DataFrame(rows, columns=["key", "id", "words", "numbers", "maker", "subgroup", "base", "each", "items", "whole", "price"])


def _discriminative(words: DataFrame) -> DataFrame:
    """(term, n, d): how many names hold a word, and which part of their pairs agree in maker and subgroup."""
    both = F.when(F.col("maker").isNotNull() & F.col("subgroup").isNotNull(), F.xxhash64("maker", "subgroup"))
    by = words.groupBy("term", both.alias("both")).agg(F.count(F.lit(1)).alias("k"))
    n, agree = F.sum("k"), F.sum(F.when(F.col("both").isNotNull(), F.col("k") * (F.col("k") - 1.0)).otherwise(0.0))
    return by.groupBy("term").agg(n.alias("n"), (agree / (n * (n - 1.0) + 3)).alias("d")).where("n > 1")


def _kinds(x: DataFrame, words: DataFrame) -> DataFrame:
    """(key, kind) of names without a subgroup: the likeliest by their words."""
    of = x.where("subgroup is not null").groupBy("subgroup").agg(F.count(F.lit(1)).cast("double").alias("c"))
    table = words.where("subgroup is not null").groupBy("term", "subgroup").agg(F.count(F.lit(1)).alias("k"))
    bare = words.where("subgroup is null").select("key", "term")
    length = bare.groupBy("key").agg(F.count(F.lit(1)).alias("words"))
    seen = bare.join(table, "term").groupBy("key", "subgroup").agg(F.sum(F.log((F.col("k") + 0.1) / 0.1)).alias("told"))
    likely = F.col("told") + F.log("c") + F.col("words") * (F.log(F.lit(0.1)) - F.log(F.col("c") + 0.2))
    return seen.join(of, "subgroup").join(length, "key").groupBy("key").agg(F.max_by("subgroup", F.struct(likely, "subgroup")).alias("kind"))


def _weights(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(term, w) of the words of rows (g, words, numbers) and of the words
    before their numbers, every two listings of a group g being a pair. n listings hold a term in a
    group of m: n (n - 1) ordered pairs share it, of n (m - 1) the first holds it."""
    size = rows.groupBy("g").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    rate = lambda both, one: (F.sum(both) / (F.sum(one) + DOUBT)).alias("w")
    one = F.col("n") * (F.col("m") - 1.0)
    n = rows.select("g", F.explode("words").alias("term")).groupBy("g", "term").agg(F.count(F.lit(1)).alias("n"))
    words = n.join(size, "g").groupBy("term").agg(rate(F.col("n") * (F.col("n") - 1.0), one))
    number = rows.select("g", "numbers", F.explode(F.array_distinct("numbers.value")).alias("value"))
    held = number.groupBy("g", "value").agg(F.count(F.lit(1)).alias("held"))
    before = F.transform(F.filter("numbers", lambda c: c["value"] == F.col("value")), lambda c: c["before"])
    n = number.select("g", "value", F.explode(before).alias("term")).groupBy("g", "value", "term").agg(F.count(F.lit(1)).alias("n"))
    numbers = n.join(held, ["g", "value"]).join(size, "g").groupBy("term").agg(rate(F.col("n") * (F.col("held") - 1.0), one))
    return words, numbers


#: Terms that are tested row by row; more of them are joined.
MANY = 20_000


def _keep(rows: DataFrame, above: DataFrame) -> DataFrame:
    """rows (key, g, words, numbers, ...) with only those words and numbers that are among the terms above (number, term)."""
    if above.limit(MANY + 1).count() <= MANY:
        terms = above.collect()
        of = lambda number: ", ".join(f"{r['term']}L" for r in terms if r["number"] == number) or "null"
        return rows.withColumns({"words": F.expr(f"filter(words, t -> t in ({of(False)}))"), "numbers": F.expr(f"filter(numbers, c -> c.before in ({of(True)}))")})
    each = F.concat(F.transform("words", lambda t: F.struct(F.lit(False).alias("number"), t.alias("term"), F.lit(0).cast("long").alias("value"))), F.transform("numbers", lambda c: F.struct(F.lit(True).alias("number"), c["before"].alias("term"), c["value"].alias("value"))))
    kept = rows.select("key", F.explode(each).alias("t")).select("key", "t.*").join(above, ["number", "term"], "left_semi")
    number = F.struct("value", F.col("term").alias("before"))
    kept = kept.groupBy("key").agg(F.collect_list(F.when(~F.col("number"), F.col("term"))).alias("words"), F.collect_list(F.when(F.col("number"), number)).alias("numbers"))
    joined = rows.drop("words", "numbers").join(kept, "key", "left")
    return joined.withColumns({"words": F.coalesce("words", F.array().cast("array<bigint>")), "numbers": F.coalesce("numbers", F.array().cast("array<struct<value: bigint, before: bigint>>"))})


def _telling(x: DataFrame, rounds: int, settled: float) -> tuple[DataFrame, DataFrame]:
    """(key, kept) of rows (key, g, words, numbers, strong), their terms of weight besides the
    discriminative ones, and the weights (term, w). A word that half of the pairs lack in the
    first turn isn't weighed again."""
    above = lambda words, numbers, w, n: cut(words.where(F.col("w") >= w).select(F.lit(False).alias("number"), "term").unionAll(numbers.where(F.col("w") >= n).select(F.lit(True), "term")))
    words, numbers = map(cut, _weights(x))
    # Discriminative terms stand for the group itself: they part nothing in it.
    strong = cut(x.select(F.explode("strong").alias("term")).distinct())
    first, words = words, cut(words.join(strong, "term", "left_anti"))
    rows = cut(_keep(x.drop("strong"), above(words, numbers, 0.5, 0.35)))
    before = None
    for _ in range(rounds):
        now = above(words, numbers, TELLING, NUMBER)
        kept = _keep(rows, now).select("key", F.sort_array(F.array_distinct(F.concat("words", "numbers.value"))).alias("kept"))
        if before is not None:
            moved = now.join(before, ["number", "term"], "left_anti").count() + before.join(now, ["number", "term"], "left_anti").count()
            if moved <= settled * max(1, now.count()):
                break
        before = now
        part = _keep(rows.withColumns({"all": F.col("words"), "every": F.col("numbers")}), now)
        part = part.select(F.xxhash64("g", F.sort_array("words"), F.sort_array("numbers.value")).alias("g"), F.col("all").alias("words"), F.col("every").alias("numbers"))
        words, numbers = map(cut, _weights(part))
    else:
        warnings.warn(f"the terms of weight still move after {rounds} turns", stacklevel=2)
    return kept, first.join(words.withColumnRenamed("w", "now"), "term", "left").select("term", F.coalesce("now", "w").alias("w"))


#: Records of a group that one task pairs with the rest of it.
SLICE = 500


def _meet(terms: DataFrame) -> DataFrame:
    """(a, b), a < b: every two records that share one of terms (rid, kind, term). One side of
    a large group is cut in slices, each with a copy of the other side."""
    slices = terms.groupBy("term", "kind").agg(F.ceil(F.count(F.lit(1)) / SLICE).alias("slices"))
    x = terms.join(slices, ["term", "kind"])
    left = x.select("term", "kind", F.col("rid").alias("a"), F.pmod(F.xxhash64("rid"), "slices").alias("slice"))
    right = x.select("term", "kind", F.col("rid").alias("b"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)).alias("slice"))
    return left.join(right, ["term", "kind", "slice"]).where("a < b").select("a", "b").distinct()


def reinforce(records: DataFrame, start: DataFrame, threshold: float = 0.5, rounds: int = 20, settled: float = 0.005) -> DataFrame:
    """(a, b, score, more_a, more_b, shared) of the matching pairs of records (rid, kind, terms, strong,
    n: listings by content). start: first weights (term, w), others being 1. more_a: the
    terms at or above the threshold's weight that only a holds; shared: contents of both."""
    sides = records.select("rid", "terms", "n")
    pairs = _meet(records.select("rid", "kind", F.explode("strong").alias("term")))
    both = pairs.join(sides.select(F.col("rid").alias("a"), F.col("terms").alias("p"), F.col("n").alias("m")), "a").join(sides.select(F.col("rid").alias("b"), F.col("terms").alias("q"), F.col("n").alias("o")), "b")
    together = F.aggregate(F.map_entries("m"), F.lit(0.0), lambda s, e: s + e["value"] * F.coalesce(F.try_element_at("o", e["key"]), F.lit(0)))
    of = lambda c, side: F.transform(c, lambda t: F.struct(t.alias("term"), F.lit(side).alias("side")))
    terms = F.concat(of(F.array_except("p", "q"), "a"), of(F.array_except("q", "p"), "b"), of(F.array_intersect("p", "q"), "ab"))
    both = cut(both.select("a", "b", together.alias("m"), F.array_intersect(F.map_keys("m"), F.map_keys("o")).alias("shared"), terms.alias("terms")))
    differ = F.filter("terms", lambda t: t["side"] != "ab")
    apart = cut(both.select("a", "b", F.explode_outer(differ).alias("t")).select("a", "b", "t.*"))
    alone = F.aggregate(F.map_values("n"), F.lit(0.0), lambda s, v: s + v * (v - 1.0))
    own = cut(records.select(F.explode("terms").alias("term"), alone.alias("same")).groupBy("term").agg(F.sum("same").alias("same")))

    def scores(weights: DataFrame) -> DataFrame:
        w = apart.join(weights, "term", "left").withColumn("w", F.coalesce("w", F.lit(1.0)))
        loss = lambda s: F.coalesce(F.max(F.when(F.col("side") == s, F.col("w"))), F.lit(0.0))
        more = lambda s: F.collect_list(F.when((F.col("side") == s) & (F.col("w") >= threshold), F.col("term")))
        return w.groupBy("a", "b").agg((1 - F.least(loss("a"), loss("b"))).alias("score"), more("a").alias("more_a"), more("b").alias("more_b"))

    weights = start
    for _ in range(rounds):
        at = both.where("m > 0").join(scores(weights).where(F.col("score") >= threshold).select("a", "b", "score"), ["a", "b"])
        at = at.select((F.col("score") * F.col("m")).alias("mass"), F.explode("terms").alias("t")).select("mass", "t.*")
        shared = F.col("side") == "ab"
        sums = at.groupBy("term").agg(F.sum(F.when(shared, 2 * F.col("mass")).otherwise(0.0)).alias("both"), F.sum(F.when(shared, 2 * F.col("mass")).otherwise(F.col("mass"))).alias("one"))
        all_ = own.join(sums, "term", "left").fillna(0.0, ["both", "one"])
        new = cut(all_.select("term", ((F.col("both") + F.col("same")) / (F.col("one") + F.col("same") + DOUBT)).alias("w")))
        moved = new.join(weights.withColumnRenamed("w", "old"), "term", "left").agg(F.sum(F.abs(F.col("w") - F.coalesce("old", F.lit(1.0)))) / F.sum("w")).first()[0]
        weights = new
        if moved is None or moved <= settled:
            break
    else:
        warnings.warn(f"the weights still move by {moved:.3f} after {rounds} turns", stacklevel=2)
    return scores(weights).where(F.col("score") >= threshold).join(both.select("a", "b", "shared"), ["a", "b"])


def _links(matches: DataFrame) -> DataFrame:
    """(a, b) of the matching pairs that join families: those of equal terms of weight, and of a
    record with richer ones that don't stand against each other. The richest of these holds
    all that the others have more; else the record is torn between them. Records are held
    against each other by content, for products of several contents are told apart by these;
    only a record that shares no content with a richer one is held against all of them."""
    m = cut(matches)
    like = m.where("size(more_a) = 0 and size(more_b) = 0").select("a", "b")
    poor = m.where("size(more_a) = 0 and size(more_b) > 0").select("a", "b", F.col("more_b").alias("more"), "shared").unionAll(m.where("size(more_b) = 0 and size(more_a) > 0").select(F.col("b").alias("a"), F.col("a").alias("b"), F.col("more_a").alias("more"), "shared"))
    shares = poor.groupBy("a").agg(F.max(F.size("shared")).alias("most"))
    poor = poor.join(shares, "a").where("size(shared) > 0 or most = 0").select("a", "b", "more", F.explode_outer("shared").alias("content"))
    poor = cut(poor.withColumn("content", F.coalesce("content", F.lit(0))))
    richest = poor.groupBy("a", "content").agg(F.max_by("more", F.struct(F.size("more"), "b")).alias("richest"))
    torn = poor.join(richest, ["a", "content"]).where(F.size(F.array_except("more", "richest")) > 0).select("a", "content").distinct()
    return like.unionAll(poor.join(torn, ["a", "content"], "left_anti").select("a", "b").distinct())


def components(nodes: DataFrame, edges: DataFrame, rounds: int = 100) -> DataFrame:
    """(rid, family): the least rid each node is connected with. Labels halve their
    distance each round by taking the neighbours' least label and that label's own label;
    edges that still differ after the given rounds raise an error."""
    both = cut(edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    label = nodes.select("rid", F.col("rid").alias("family"))
    linked = cut(label.join(both.select(F.col("a").alias("rid")).distinct(), "rid", "left_semi"))
    for _ in range(rounds):
        least = both.join(linked.select(F.col("rid").alias("b"), "family"), "b").groupBy("a").agg(F.min("family").alias("low"))
        step = linked.join(least.withColumnRenamed("a", "rid"), "rid").select("rid", "family", F.least("family", "low").alias("low"))
        jump = step.select(F.col("rid").alias("low"), F.col("low").alias("far"))
        new = cut(step.join(jump, "low", "left").select("rid", F.col("family").alias("old"), F.least("low", F.coalesce("far", "low")).alias("family")))
        linked = new.select("rid", "family")
        if new.where("old != family").limit(1).count() == 0:
            break
    else:
        raise RuntimeError(f"components are not settled after {rounds} rounds")
    return label.join(linked.select("rid", F.col("family").alias("f")), "rid", "left").select("rid", F.coalesce("f", "family").alias("family"))


def _contents(x: DataFrame) -> DataFrame:
    """x (id, family, base, each, items, whole, price) -> (id, family, content)."""
    stated = x.where("each is not null").withColumn("content", F.format_string("%s %s x %s", "base", F.col("each").cast("string"), F.col("items").cast("string")))
    known = stated.groupBy("family", "base", "whole", "content", "items").agg(F.avg("price").alias("like"))
    open_ = x.where("each is null and whole is not null").drop("each", "items")
    near = F.abs(F.col("price") - F.col("like"))
    fits = open_.alias("o").join(known.alias("k"), (F.col("o.family") == F.col("k.family")) & (F.col("o.base") == F.col("k.base")) & (F.abs(F.col("o.whole") - F.col("k.whole")) <= F.greatest(F.lit(0.5), 0.011 * F.col("o.whole"))))
    fits = fits.select("o.id", near.alias("gap"), "k.items", "k.content").where(f"gap is null or gap <= {PRICE_GAP}")
    # Without a price only a single stated content can be meant.
    best = fits.groupBy("id").agg(F.min_by("content", F.struct(F.coalesce("gap", F.lit(0.0)), "items")).alias("content"), F.count(F.lit(1)).alias("n"), F.count("gap").alias("priced")).where("n = 1 or priced = n")
    rest = open_.join(best.select("id"), "id", "left_anti")
    # Prices a gap apart part a group into islands. Within a bucket as wide as the gap there is
    # none, so it shows between the highest and the lowest prices of neighbouring buckets.
    rest = rest.withColumn("bucket", F.floor(F.col("price") / PRICE_GAP))
    ends = rest.where("price is not null").groupBy("family", "base", "whole", "bucket").agg(F.min("price").alias("low"), F.max("price").alias("high"))
    of = Window.partitionBy("family", "base", "whole")
    apart = F.coalesce((F.col("low") - F.lag("high").over(of.orderBy("bucket")) > PRICE_GAP).cast("int"), F.lit(0))
    islands = ends.withColumn("apart", apart).withColumn("island", F.sum("apart").over(of.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)))
    islands = islands.select("family", "base", "whole", "bucket", "island")
    several = islands.groupBy("family", "base", "whole").agg(F.max("island").alias("last"))
    rest = rest.join(islands, ["family", "base", "whole", "bucket"], "left").join(several, ["family", "base", "whole"], "left")
    alone = F.when(F.col("price").isNull() & (F.col("last") > 0), F.col("id"))
    rest = rest.withColumn("content", F.concat_ws(" ", F.lit("whole"), "base", F.col("whole").cast("string"), F.coalesce("island", F.lit(0)).cast("string"), alone.cast("string")))
    return stated.select("id", "family", "content").unionAll(open_.join(best.select("id", "content"), "id").select("id", "family", "content")).unionAll(rest.select("id", "family", "content"))


def same_product(listings: DataFrame, prices: DataFrame | None = None, rounds: int = 10, settled: float = 0.01) -> DataFrame:
    """(id, product): listings (id, name, brand, subgroup, size, unit, price) with the product
    each belongs to. prices (id, price) fills in for listings without a price."""
    schema = "key long, id long, words array<string>, numbers array<struct<value: string, before: string>>, maker string, subgroup string, base string, each double, items int, whole double, price double"
    listed = listings.where("name is not null").select("id", "name", "brand", "subgroup", "size", "unit", "price").distinct()
    read = listed.withColumn("key", F.xxhash64(*listed.columns)).mapInPandas(_read, schema)
    # From here on only narrow rows of hashed terms move.
    value = lambda c: F.struct(F.xxhash64(F.lit("#"), c["value"]).alias("value"), F.xxhash64(c["before"]).alias("before"))
    x = cut(read.withColumns({"words": F.transform("words", lambda t: F.xxhash64(t)), "numbers": F.transform("numbers", value), "maker": F.when(F.col("maker").isNotNull(), F.xxhash64("maker"))}))
    words = x.select("key", "maker", "subgroup", F.explode("words").alias("term"))
    d = _discriminative(words)
    # The anchor is the rarest discriminative term, else the most discriminative one.
    clear = F.col("d") >= DISCRIMINATIVE
    best = words.select("key", "term").join(d, "term").groupBy("key").agg(F.coalesce(F.min_by("term", F.when(clear, F.struct("n", "term"))), F.max_by("term", F.struct("d", "term"))).alias("anchor"), F.collect_set(F.when(clear, F.col("term"))).alias("strong"))
    # Without any term of two names a listing has no partner.
    x = x.join(best, "key", "left").withColumn("anchor", F.coalesce("anchor", "key")).join(_kinds(x, words), "key", "left")
    x = x.withColumn("strong", F.array_distinct(F.concat(F.coalesce("strong", F.array().cast("array<bigint>")), F.array("anchor")))).withColumn("kind", F.coalesce("subgroup", "kind", F.lit("")))
    x = cut(x.drop("maker", "subgroup"))
    kept, words = _telling(x.select("key", F.xxhash64("kind", "anchor", "base", "whole").alias("g"), "words", "numbers", "strong"), rounds, settled)
    held = x.drop("words", "numbers", "anchor").join(kept, "key", "left")
    held = held.withColumn("terms", F.sort_array(F.array_distinct(F.concat("strong", F.coalesce("kept", F.array().cast("array<bigint>"))))))
    held = cut(held.withColumn("rid", F.xxhash64("kind", "terms")).drop("kept", "key"))
    counts = held.groupBy("rid", F.xxhash64("base", "whole").alias("content")).agg(F.count(F.lit(1)).alias("n")).groupBy("rid").agg(F.map_from_entries(F.collect_list(F.struct("content", "n"))).alias("n"))
    records = cut(held.groupBy("rid").agg(F.first("kind").alias("kind"), F.first("terms").alias("terms"), F.array_distinct(F.flatten(F.collect_set("strong"))).alias("strong")).join(counts, "rid"))
    family = components(records.select("rid"), _links(reinforce(records, words)))
    told = held.select("id", "rid", "base", "each", "items", "whole", "price").distinct()
    if prices is not None:
        hint = prices.where("price > 0 and not isnan(price)").groupBy("id").agg(F.log(F.avg("price")).alias("hint"))
        told = told.join(hint, "id", "left").withColumn("price", F.coalesce("price", "hint")).drop("hint")
    placed = _contents(told.join(family, "rid").drop("rid"))
    return placed.select("id", F.xxhash64("family", "content").alias("product"))


def pairs_of(products: DataFrame) -> DataFrame:
    """(a, b), a < b: every two listings of one product."""
    p = cut(products.distinct())
    several = p.groupBy("product").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("product")
    p = p.join(several, "product", "left_semi")
    return p.select(F.col("id").alias("a"), "product").join(p.select(F.col("id").alias("b"), "product"), "product").where("a < b").select("a", "b")
