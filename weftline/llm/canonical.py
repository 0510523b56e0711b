"""Mapping freely typed values to the entries of a canonical list.

Distinct values are normalised (one look, no case, accents, blanks or signs); besides the
whole value each run of its leading words is a form of its own, words being parted at
blanks and signs and where capitals or another script begin. An inverted index of
character 2- and 3-grams over the entries' names, known other names and unique first words
gives the candidates of each form, scored by the cosine of idf-weighted gram vectors; a form
of leading words counts a little less, and only if it is a name in full. The best entry above
the threshold that beats the best entry of another id by the margin is taken, else the value is
reported unmatched. A candidate that more than a few typing errors part from the form is
refused beforehand, so that words that many entries share ("Professional") can't carry a match alone.

Defined results: null and blank values, and values that are an entry's name character for
character, are left out; an unmatched value gets id 0; a value that fits two entries
equally (a first word they share) is unmatched; repeated rows of one id and value count
once; very long values are read whole (a form longer than every entry and its typing errors
has no candidate); an empty list maps every value to 0. The list is shipped to all workers and
must not be longer than `most` names; a longer one is refused.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.look import transducer
from weftline.session import cut

#: A joint edition: an x glued between a name and capitals, to the end.
EDITION = re.compile(r"(?<=[a-z])x[A-Z]{3,}\S*$")
#: Where a word ends: blanks and signs, before capitals that begin a word, between scripts.
_WORD = re.compile(r"(?<=[A-Z])(?=[A-Z][a-z]{2})|(?<=[a-z])(?=[A-Z])|(?<=[฀-๿])(?=[^฀-๿])|(?<=[^฀-๿\W])(?=[฀-๿])|[\s_\-–/|,]+")
#: Most typing errors of a match, and what a form of leading words counts.
EDITS, LEADING = 6, 0.98


def plain(text: str) -> str:
    s = unicodedata.normalize("NFD", transducer().form(text))
    return unicodedata.normalize("NFC", "".join(c for c in s if not "̀" <= c <= "ͯ")).lower()


def letters(text: str) -> str:
    return "".join(c for c in text if c.isalnum() or unicodedata.category(c) == "Mn")


def _key(text: str) -> str:
    return letters(re.sub(r"\bdoctor\b", "dr", plain(text)))


def variants(value: str, longest: int) -> list[tuple[str, bool]]:
    """Normalised forms of a value of at most `longest` characters, and whether a form is only the value's leading words."""
    form = transducer().form(value)
    out = {_key(form): False, _key(EDITION.sub("", form)): False}
    lead = ""
    for w in _WORD.split(form):
        lead += _key(w)
        if len(lead) > longest:
            break
        out.setdefault(lead, True)
    return [(k, short) for k, short in out.items() if k and len(k) <= longest]


def grams(key: str) -> Counter:
    k = f"^{key}$"
    return Counter(k[i : i + n] for n in (2, 3) for i in range(len(k) - n + 1))


def distance(a: str, b: str, most: float) -> float:
    """Edits between a and b, swapped neighbours being one; more than `most` gives inf."""
    if abs(len(a) - len(b)) > most:
        return math.inf
    two, one = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            v = min(one[j] + 1, row[j - 1] + 1, one[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                v = min(v, two[j - 2] + 1)
            row.append(v)
        if min(row) > most:
            return math.inf
        two, one = one, row
    return one[-1] if one[-1] <= most else math.inf


class Index:
    """Inverted gram index over entries (key, id, length of the part of its own)."""

    def __init__(self, names: list[tuple[int, str]], others: list[tuple[int, str]]):
        entries = {(letters(plain(n)), i) for i, n in [*names, *others]}
        firsts, tails = defaultdict(set), defaultdict(set)
        for i, n in names:
            words = [letters(w) for w in re.split(r"[\s.]+", plain(n)) if letters(w)]
            if len(words) > 1:
                firsts[words[0]].add(i)
                tails["".join(words[1:])].add(i)
        whole = {k for k, _ in entries}
        entries |= {(w, next(iter(ids))) for w, ids in firsts.items() if len(ids) == 1 and len(w) > 2}
        self.entries = sorted(e for e in entries if e[0])
        self.whole = [k in whole for k, _ in self.entries]
        shared = sorted((t for t, ids in tails.items() if len(ids) > 1), key=len, reverse=True)
        self.own = [len(k) - next((len(t) for t in shared if k.endswith(t) and len(k) > len(t)), 0) for k, _ in self.entries]
        seen = Counter(g for k, _ in self.entries for g in grams(k))
        self.weight = {g: math.log((len(self.entries) + 1) / (n + 0.5)) for g, n in seen.items()}
        self.rare = math.log((len(self.entries) + 1) / 0.5)
        lists = defaultdict(list)
        for at, (k, _) in enumerate(self.entries):
            for g, x in self.vector(k).items():
                lists[g].append((at, x))
        self.lists = {g: (np.array([a for a, _ in p]), np.array([x for _, x in p])) for g, p in lists.items()}
        self.longest = max((len(k) for k, _ in self.entries), default=0) + EDITS
        self.ids = np.array([i for _, i in self.entries], dtype=np.int64)

    def vector(self, key: str) -> dict[str, float]:
        v = {g: (1 + math.log(n)) * self.weight.get(g, self.rare) for g, n in grams(key).items()}
        size = math.sqrt(sum(x * x for x in v.values())) or 1.0
        return {g: x / size for g, x in v.items()}

    def scores(self, key: str) -> np.ndarray:
        parts = [(self.lists[g], x) for g, x in self.vector(key).items() if g in self.lists]
        if not parts:
            return np.zeros(len(self.entries))
        return np.bincount(np.concatenate([p[0] for p, _ in parts]), np.concatenate([p[1] * x for p, x in parts]), len(self.entries))

    def edits(self, key: str, at: int) -> float:
        """Edits to entry `at`, inf beyond what its length and its own part allow. A key
        that stops short of an entry is held against the entry's beginning, for half an edit."""
        name, own = self.entries[at][0], self.own[at]
        most = min(0.3 * len(name), 0.45 * own, EDITS)
        if len(name) <= 3:
            most = 0
        elif not name.isascii():  # syllables of other scripts share more signs
            most = 0.2 * len(name)
        d = distance(key, name, most)
        if d > 0 and own + 1 < len(key) < len(name):
            d = min(d, 0.5 + distance(key, name[: len(key)], most - 0.5))
        return d

    def best(self, value: str, threshold: float, margin: float) -> tuple[int, float]:
        """(id or 0, score)."""
        found: dict[int, float] = {}
        top = 0.0
        for key, lead in variants(value, self.longest):
            s = self.scores(key)
            top = max(top, float(s.max(initial=0.0)))
            for at in np.flatnonzero(s >= threshold):
                if lead and not self.whole[at] and self.entries[at][0] != key:
                    continue
                if self.edits(key, at) < math.inf:
                    i = int(self.ids[at])
                    found[i] = max(found.get(i, 0.0), float(s[at]) * (LEADING if lead else 1.0))
        ranked = sorted(((s, i) for i, s in found.items()), reverse=True)
        if not ranked or (len(ranked) > 1 and ranked[0][0] - ranked[1][0] < margin):
            return 0, ranked[0][0] if ranked else top
        return ranked[0][1], ranked[0][0]


def map_values(values: DataFrame, value: str, names: DataFrame, others: DataFrame | None, key: str, name: str, other: str, threshold: float = 0.25, margin: float = 0.02, most: int = 200_000) -> DataFrame:
    """(value, id, score) of each distinct non-blank value that is not itself a name."""
    rows = [names.select(F.col(key).cast("long"), name)] + ([others.select(F.col(key).cast("long"), other)] if others is not None else [])
    got = [r.where(F.col(r.columns[1]).isNotNull() & F.col(r.columns[0]).isNotNull()).limit(most + 1).collect() for r in rows]
    if sum(map(len, got)) > most:
        raise ValueError(f"a list of more than {most} names can't be shipped to all workers")
    index = values.sparkSession.sparkContext.broadcast(Index([tuple(r) for r in got[0]], [tuple(r) for r in got[1]] if len(got) > 1 else []))

    def match(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ix = index.value
        for p in parts:
            p = p[p["value"].map(lambda v: bool(v.strip()))]
            r = [ix.best(v, threshold, margin) for v in p["value"]]
            yield pd.DataFrame({"value": p["value"], "id": [i for i, _ in r], "score": [s for _, s in r]})

    distinct = values.select(F.col(value).alias("value")).where("value is not null").distinct()
    unlisted = distinct.join(names.select(F.col(name).alias("value")).distinct(), "value", "left_anti")
    # As many tasks as set, however few bytes the values are: matching is work, not volume.
    tasks = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return unlisted.repartition(tasks, F.col("value")).mapInPandas(match, "value string, id long, score double")


def map_rows(df: DataFrame, row_key: str, value: str, names: DataFrame, others: DataFrame | None, key: str, name: str, other: str, **how) -> DataFrame:
    """(row_key, id): the mapping at every row; unmatched rows get 0."""
    mapped = cut(map_values(df, value, names, others, key, name, other, **how))
    rows = df.select(row_key, F.col(value).alias("value")).where("value is not null").join(mapped, "value")
    return rows.select(row_key, F.col("id").alias(key)).distinct()
