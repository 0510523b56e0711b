"""One consistent form for texts that look the same.

A transducer over grapheme clusters is compiled once: its pattern takes, at each
place, the longest of a letter with combining marks (invisible characters between them
included), a Thai sign written as several, or one mapped character; its output comes from
a precomputed mapping of widths, blanks, invisible characters, accents and look-alike
letters, checked for conflicts when it is built. One pass over a text gives its form;
blanks at either end are then taken off. Letter case, accents, hyphens and the number of
blanks inside stay, since they show.

Defined results: a null text has a null form; an empty or invisible one has the empty
form, which matches nothing; texts of any length are read whole; applying it twice
changes nothing; repeated rows of one id count once; texts are told apart by 128 bits of
hash, so groups of a million equal texts move ids and hashes only.
"""

from __future__ import annotations

import re
import unicodedata
from functools import cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions.unicode_map import singles
from weftline.session import cut

#: Thai vowel signs above a letter, tone marks and the parts of composed vowels (fixed values).
ABOVE, TONES, NIKHAHIT, AA, AM, E, AE = "ัิีึืํ็", "่้๊๋์", "ํ", "า", "ำ", "เ", "แ"


def thai(signs: str) -> str:
    """A run of Thai signs in the order in which they are written: vowel, tone, and the
    vowel that is composed of two."""
    if signs == E + E:
        return AE
    above, tones = ("".join(c for c in signs if c in of) for of in (ABOVE, TONES))
    if signs.endswith(AA):
        if NIKHAHIT in above:
            return above.replace(NIKHAHIT, "", 1) + tones + AM
        return above + tones + AA
    return above + tones


THAI_SIGNS = ABOVE + TONES


class Transducer:
    def __init__(self) -> None:
        one = singles()
        if bad := [c for c in ABOVE + TONES + AA + AM + E + AE if c in one or any(c in m for m in one.values())]:
            raise ValueError(f"conflicting rules for {bad}")
        self.one = one
        self.none = frozenset(c for c, m in one.items() if not m)
        hidden = "[" + "".join(re.escape(c) for c in sorted(self.none)) + "]*"
        signs = f"[{ABOVE}{TONES}](?:{hidden}[{ABOVE}{TONES}])*(?:{hidden}{AA})?|{E}{hidden}{E}"
        mark = "[̀-ͯ᪰-᫿᷀-᷿⃐-⃰]"
        mark = f"(?![͏]){mark}"
        precomposed = "".join(c for c in map(chr, range(0x100, 0x2000)) if self._split(c))
        mapped = "".join(re.escape(c) for c in sorted(set(one) | set(precomposed)))
        self.pattern = re.compile(f"[^\\W\\d_](?:{hidden}{mark})+|{signs}|[{mapped}]")
        self.memo: dict[str, str] = {}

    def _split(self, c: str) -> bool:
        """Whether c is a look-alike letter with an accent in one character."""
        d = unicodedata.normalize("NFD", c)
        return len(d) > 1 and d[0] in self.one

    def _out(self, m: re.Match) -> str:
        key = m[0]
        got = self.memo.get(key)
        if got is None:
            kept = "".join(c for c in key if c not in self.none)
            if kept == E + E or (len(kept) > 1 and kept[0] in THAI_SIGNS):
                got = thai(kept)
            else:
                parts = unicodedata.normalize("NFD", kept) if len(kept) > 1 or self._split(kept) else kept
                got = unicodedata.normalize("NFC", "".join(self.one.get(c, c) for c in parts)) if len(parts) > 1 else self.one.get(parts, parts)
            if len(self.memo) < 100_000:
                self.memo[key] = got
        return got

    def form(self, text: str) -> str:
        if text.isascii() and text.isprintable():
            return text.strip()
        return self.pattern.sub(self._out, text).strip(" ")


@cache
def transducer() -> Transducer:
    return Transducer()


def _forms(s: pd.Series) -> pd.Series:
    f = transducer().form
    return s.map(lambda x: None if x is None else f(x))


def form(text: Column) -> Column:
    """The form of each text."""
    return F.pandas_udf(_forms, "string")(text)


def _hash(c: Column) -> list[Column]:
    return [F.xxhash64(c), F.xxhash64(c, F.lit(1))]


def _keyed(df: DataFrame, key: str, text: str) -> DataFrame:
    """(id, l1, l2, t1, t2): hashes of form and text."""
    f = df.where(F.col(text).isNotNull()).select(F.col(key).alias("id"), F.col(text).alias("t"), form(F.col(text)).alias("f")).where("f != ''")
    l1, l2 = _hash(F.col("f"))
    t1, t2 = _hash(F.col("t"))
    return f.select("id", l1.alias("l1"), l2.alias("l2"), t1.alias("t1"), t2.alias("t2"))


def same_look_in_list(df: DataFrame, key: str, text: str, entries: DataFrame, entry_key: str, entry_text: str) -> DataFrame:
    """(left_id, right_id): rows whose text looks like an entry but isn't equal to it. The
    list is joined on the form, so it may be of any size."""
    a = _keyed(df, key, text)
    b = _keyed(entries, entry_key, entry_text).select(F.col("id").alias("right_id"), "l1", "l2", F.col("t1").alias("e1"), F.col("t2").alias("e2"))
    hits = a.join(b, ["l1", "l2"]).where("t1 != e1 or t2 != e2")
    return hits.select(F.col("id").alias("left_id"), "right_id").distinct()


def same_look(df: DataFrame, key: str, text: str) -> DataFrame:
    """(left_id, right_id), left_id < right_id: rows whose texts look the same but aren't
    equal. Forms of a single text are left out before anything is paired."""
    a = cut(_keyed(df, key, text).distinct())
    text_id = F.struct("t1", "t2")
    several = a.groupBy("l1", "l2").agg(F.min(text_id).alias("lo"), F.max(text_id).alias("hi")).where("lo != hi").select("l1", "l2")
    m = a.join(several, ["l1", "l2"], "left_semi")
    left = m.select(F.col("id").alias("left_id"), "l1", "l2", F.col("t1").alias("a1"), F.col("t2").alias("a2"))
    right = m.select(F.col("id").alias("right_id"), "l1", "l2", "t1", "t2")
    return left.join(right, ["l1", "l2"]).where("left_id < right_id and (a1 != t1 or a2 != t2)").select("left_id", "right_id").distinct()


def look_classes(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, look, n_texts) of the rows whose look is written in several ways: one class a look,
    with the number of its different texts. No pair is expanded."""
    a = cut(_keyed(df, key, text).distinct())
    texts = a.select("l1", "l2", "t1", "t2").distinct().groupBy("l1", "l2").agg(F.count(F.lit(1)).alias("n_texts")).where("n_texts > 1")
    return a.join(texts, ["l1", "l2"]).select(F.col("id").alias(key), F.xxhash64("l1", "l2").alias("look"), "n_texts").distinct()
