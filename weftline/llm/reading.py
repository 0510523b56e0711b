"""Reading level of documents by harmonic propagation on a word-sentence-document graph.

Documents are joined to their sentences, sentences to the words they hold (single and in
pairs; Thai in runs of five signs). Graded documents are clamped to their grades. In turns, a word's
difficulty is the mean of that of the documents whose sentences hold it, a sentence's the
mean of its words', and a document's the mean of its sentences', each at the level it is
nearest to; so difficulty spreads from graded to ungraded documents and back until hardly any
sentence moves. It is carried as the four shares of levels 1 to 4, each a harmonic
function of its own, divided by their shares among the graded documents (class mass
normalisation); a word counts the more in its sentences the further its shares are from even ones.

Equal sentences are one node, so a turn costs as much as there are different ones. Every
step is a join or sum over edges keyed by 64-bit hashes: nothing is broadcast and no two
words share a node, however large the corpus.

A document's level is that of most of its sentences - stretches between sentence signs, or
of about a dozen words where there are none; a tie goes to the level with more text.

Defined results: null, empty and blank texts, and texts of at most three words once tags,
addresses and symbols are taken off, give no row; grades other than 1 to 4 are ignored,
repeated grades of one rater count once, several raters' grades are averaged; with no
grade at all there are no rows; a document that shares no word with a graded one, however
far around, has the commonest grade; a repeated document gives a row each time; very long
texts are read whole; turns that don't settle raise a warning.
"""

from __future__ import annotations

import re
import warnings
from collections.abc import Iterator
from functools import cache, lru_cache
from hashlib import blake2b

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.look import transducer
from weftline.session import cut

#: Words of a stretch without sentence signs that count as one sentence.
STRETCH = 12
#: Stretches, sentences and words a worker remembers.
MEMORY = 200_000
_JUNK = re.compile(r"https?://\S+|<\|[^|>]*\|>|</?[a-z][^>]*>|&[a-z]+;|[#@]\w+", re.I)
_SENTENCE = re.compile(r"(?<=[.!?;:])\s+|\s*\n+\s*|\s{2,}|\s+(?=[•*]|\d+\) )|,? (?:and|so|but) (?=[A-Z])|(?<=[฀-๿])\s+(?=[฀-๿])")
_WORD = re.compile(r"[^\W\d_฀-๿]+|[฀-๿]+|\d+|[^\s\w]")


@cache
def _odd() -> re.Pattern:
    """Characters that have another form of their own."""
    return re.compile("[" + "".join(map(re.escape, sorted(transducer().one))) + "]")


def stretches(text: str) -> list[str]:
    """A text without tags and addresses, cut at sentence signs. Odd characters are brought to
    their form first; where there are none it suffices to do so with each stretch."""
    if not text.isascii() and _odd().search(text):
        text = transducer().form(text)
    return [s for s in _SENTENCE.split(_JUNK.sub(" ", text)) if s]


def sentences_of(stretch: str) -> list[list[str]]:
    """Words of each sentence of a stretch; long ones are cut."""
    words = _WORD.findall((stretch if stretch.isascii() else transducer().form(stretch)).lower())
    if len(words) > 2.5 * STRETCH:
        return [words[i : i + STRETCH] for i in range(0, len(words), STRETCH)]
    return [words] if words else []


def sentences(text: str) -> list[list[str]]:
    """Words of each sentence of a text."""
    return [w for s in stretches(text) for w in sentences_of(s)]


def extent(words: list[str]) -> tuple[int, int]:
    """How many words and how many Thai signs a sentence has."""
    thai = [w for w in words if "฀" <= w[0] <= "๿"]
    return sum(w[0].isalpha() for w in words) - sum(w[0].isalpha() for w in thai), sum(map(len, thai))


def has_sentence(parts: list[list[str]]) -> bool:
    found = [extent(p) for p in parts]
    return sum(w for w, _ in found) > 3 or sum(s for _, s in found) >= 8


@lru_cache(MEMORY)
def _key(text: str) -> int:
    return int.from_bytes(blake2b(text.encode(), digest_size=8).digest(), "little", signed=True)


def nodes(words: list[str]) -> list[int]:
    """Word nodes of a sentence."""
    out, before = set(), "^"
    for w in words:
        if "฀" <= w[0] <= "๿":
            out.update(w[i : i + 5] for i in range(max(1, len(w) - 4)))
            before = w[-3:]
        else:
            w = "0" if w.isdigit() else w
            out.update((f"1{w}", f"{before} {w}"))
            before = w
    return sorted(map(_key, out))


#: What this worker has worked out: a stretch's sentences, a sentence's nodes, a word's node. Pure
#: functions of their keys, so it doesn't matter which task filled them.
_STRETCHES: dict[str, tuple] = {}
_SENTENCES: dict[str, tuple] = {}


def _sentence(words: list[str]) -> tuple[int, list[int], int, int]:
    """(node, word nodes, words, Thai signs) of a sentence; numbers are alike."""
    masked = " ".join("0" if w.isdigit() else w for w in words)
    if (got := _SENTENCES.get(masked)) is None:
        got = (_key(masked), nodes(words), *extent(words))
        if len(_SENTENCES) < MEMORY:
            _SENTENCES[masked] = got
    return got


def _stretch(text: str) -> tuple:
    if (got := _STRETCHES.get(text)) is None:
        got = tuple(map(_sentence, sentences_of(text)))
        if len(_STRETCHES) < MEMORY:
            _STRETCHES[text] = got
    return got


def _read(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(id, s, size, new): sentence nodes of a document with their number of word nodes, and
    those this task meets for the first time as (s, words)."""
    seen: set[int] = set()
    for p in parts:
        rows = []
        for key, text in zip(p["id"], p["text"], strict=True):
            found = [x for s in stretches(text) for x in _stretch(s)]
            new = []
            for k, n, _, _ in found:
                if k not in seen:
                    seen.add(k)
                    new.append({"s": k, "words": n})
            if sum(x[2] for x in found) > 3 or sum(x[3] for x in found) >= 8:
                rows.append((key, [x[0] for x in found], [len(x[1]) for x in found], new))
            elif new:  # another document may hold the sentence
                rows.append((None, [], [], new))
        yield pd.DataFrame(rows, columns=["id", "s", "size", "new"])


def joined(a: DataFrame, b: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """a and b joined by merging. Sizes behind Python and explode are guessed far too small, so left to
    itself Spark sends the words of the whole corpus through the driver."""
    return a.join(b.hint("merge"), on, how)


def levels(docs: DataFrame, key: str, text: str, labels: DataFrame, label_key: str, rater: str, level: str, trust: float = 0.5, doubt: float = 0.05, rounds: int = 12, settled: float = 0.01) -> DataFrame:
    """(key, reading_level, difficulty) of each document that holds sentences. trust: weight of
    an ungraded document against a graded one. doubt: documents' worth of the mean that a
    word starts with. The turns end when at most the part `settled` of the sentences moves."""
    grades = labels.where(F.col(level).between(1, 4)).select(F.col(label_key).cast("long").alias("id"), rater, F.col(level).cast("int").alias("g")).distinct()
    grades = grades.groupBy("id").agg(F.array(*(F.avg((F.col("g") == k).cast("double")) for k in (1, 2, 3, 4))).alias("grade"))
    read = docs.where(F.col(text).isNotNull()).select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).mapInPandas(_read, "id long, s array<long>, size array<int>, new array<struct<s: long, words: array<long>>>")
    read = cut(read)
    # A repeated document has rows of its own, so they are numbered.
    body = cut(read.where("id is not null").select("id", "s", "size").withColumn("row", F.monotonically_increasing_id()))
    graded = cut(joined(body.select("id", "row"), grades, "id").select("row", "grade"))
    prior = graded.agg(*(F.avg(F.col("grade")[k]) + 1e-3 for k in range(4))).first()
    if prior[0] is None:
        return body.limit(0).select(F.col("id").alias(key), F.lit(0).alias("reading_level"), F.lit(0.0).alias("difficulty"))
    prior = [p / sum(prior) for p in prior]
    edges = body.select("row", F.size("s").alias("of"), F.explode(F.arrays_zip("s", "size")).alias("e"))
    edges = cut(edges.groupBy("row", "of", "e.s", "e.size").agg(F.count(F.lit(1)).alias("n")))
    words = cut(read.select(F.explode("new").alias("e")).select("e.*").dropDuplicates(["s"]).select("s", F.explode("words").alias("w")))

    def sentence_levels(values: DataFrame) -> DataFrame:
        """(s, level) from documents (row, a, b, c, d, weight)."""
        part = F.col("n") / F.col("of") * F.col("weight")
        # Shares sum to one, so the weight behind a word is the sum of its four.
        at = joined(edges, values, "row").groupBy("s").agg(*(F.sum(F.col(c) * part).cast("float").alias(c) for c in "abcd"))
        w = joined(words, at, "s").groupBy("w").agg(*(F.sum(c).alias(c) for c in "abcd")).withColumn("m", F.col("a") + F.col("b") + F.col("c") + F.col("d"))
        # Shares divided by the mean ones, brought to sum to one.
        q = w.select("w", *(((F.col(c) + doubt * p) / (F.col("m") + doubt) / p).alias(c) for c, p in zip("abcd", prior, strict=True)))
        q = q.select("w", *((F.col(c) / (F.col("a") + F.col("b") + F.col("c") + F.col("d"))).alias(c) for c in "abcd"))
        tells = sum(((F.col(c) - 0.25) * (F.col(c) - 0.25) for c in "abcd"), F.lit(0.0))
        q = q.select("w", *((F.col(c) * tells).cast("float").alias(c) for c in "abcd")).where("a + b + c + d > 1e-9")
        s = joined(words, q, "w").groupBy("s").agg(*(F.sum(c).alias(c) for c in "abcd"))
        most = F.greatest(*"abcd")
        return s.select("s", F.when(F.col("a") == most, 1).when(F.col("b") == most, 2).when(F.col("c") == most, 3).otherwise(4).alias("level"))

    def documents(found: DataFrame) -> DataFrame:
        """(row, a, b, c, d): shares of a document's sentences at each level. Scraps count only
        where there is nothing else, and the amount of text settles ties."""
        at = joined(edges, found, "s", "left")
        is_ = [(F.col("level") == k).cast("double") for k in (1, 2, 3, 4)]
        real = F.col("n") * (F.col("size") >= 4).cast("double")
        sums = at.groupBy("row").agg(*(F.sum(real * F.coalesce(i, F.lit(0.0))).alias(f"r{k}") for k, i in enumerate(is_)), *(F.sum(F.col("n") * F.col("size") * F.coalesce(i, F.lit(0.0))).alias(f"t{k}") for k, i in enumerate(is_)))
        text = F.greatest(sum(F.col(f"t{k}") for k in range(4)), F.lit(1.0))
        votes = sums.select("row", *((F.col(f"r{k}") + 0.5 * F.col(f"t{k}") / text).alias(c) for k, c in enumerate("abcd")))
        # Without a sentence near any graded one a document has the mean level.
        every = F.col("a") + F.col("b") + F.col("c") + F.col("d")
        return votes.select("row", *(F.when(every > 0, F.col(c) / every).otherwise(F.lit(p)).alias(c) for c, p in zip("abcd", prior, strict=True)))

    clamped = graded.select("row", *(F.col("grade")[k].alias(c) for k, c in enumerate("abcd")), F.lit(1.0).alias("weight"))
    values, found = clamped, None
    for _ in range(rounds):
        new = cut(sentence_levels(values))
        if found is not None:
            moved, total = joined(new, found.withColumnRenamed("level", "was"), "s", "left").agg(F.sum((~F.col("level").eqNullSafe(F.col("was"))).cast("long")), F.count(F.lit(1))).first()
            found = new
            if not total or moved <= settled * total:
                break
        found = new
        values = clamped.unionByName(joined(documents(found), graded, "row", "left_anti").withColumn("weight", F.lit(trust)))
    else:
        warnings.warn(f"levels of sentences still move after {rounds} turns", stacklevel=2)
    out = joined(documents(found), body.select("row", "id"), "row")
    most = F.greatest(*"abcd")
    level_ = F.when(F.col("a") == most, 1).when(F.col("b") == most, 2).when(F.col("c") == most, 3).otherwise(4)
    return out.select(F.col("id").alias(key), level_.alias("reading_level"), (F.col("a") + 2 * F.col("b") + 3 * F.col("c") + 4 * F.col("d")).alias("difficulty"))
