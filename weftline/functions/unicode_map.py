"""Characters that look like others: the tables behind text normalisation.

Widths, blanks and invisible characters follow from the Unicode data; only look-alike
letters are listed.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import cache

#: Letters of other scripts that look the same as a Latin letter (fixed values).
LOOK_ALIKE = {
    "а": "a", "с": "c", "ԁ": "d", "е": "e", "ɡ": "g", "һ": "h", "і": "i", "ј": "j", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "ѵ": "v", "ԝ": "w", "х": "x", "у": "y", "ӏ": "l",
    "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I", "Ј": "J", "К": "K", "М": "M", "О": "O", "Р": "P", "Ѕ": "S", "Т": "T", "Ѵ": "V", "Ԝ": "W", "Х": "X", "Ү": "Y", "Ӏ": "I", "Ԛ": "Q",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "ο": "o", "ν": "v", "ϲ": "c", "ϳ": "j",
}

#: Characters that show nothing, besides those of category Cf (fixed values).
INVISIBLE = "͏ᅟᅠ឴឵᠋᠌᠍ㅤﾠ"


def single(ch: str) -> str | None:
    """What one character becomes, or None where it stays."""
    if ch in LOOK_ALIKE:
        return LOOK_ALIKE[ch]
    if ch in INVISIBLE or "︀" <= ch <= "️" or unicodedata.category(ch) == "Cf":
        return ""
    if ch in "\t\n\r\v\f\x85" or (ch != " " and unicodedata.category(ch) in ("Zs", "Zl", "Zp")):
        return " "
    kind = unicodedata.decomposition(ch).split(" ")[0]
    if kind in ("<wide>", "<narrow>") or "ﬀ" <= ch <= "ﬆ":
        return unicodedata.normalize("NFKC", ch)
    return None


@cache
def singles() -> dict[str, str]:
    """The single-character mapping over all of Unicode; its outputs are mapped no further."""
    out = {c: m for c in map(chr, range(sys.maxunicode + 1)) if not "\ud800" <= c <= "\udfff" and (m := single(c)) is not None}
    if bad := [c for c, m in out.items() if any(x in out for x in m)]:
        raise ValueError(f"mapped twice: {bad}")
    return out


@cache
def _table() -> dict[int, str]:
    return {ord(c): m for c, m in singles().items()}


def plain(text: str) -> str:
    """text in one width, with plain blanks, without invisible and look-alike characters;
    accents stay as they are."""
    if text.isascii():
        return text.replace("\t", " ").replace("\n", " ").replace("\r", " ")
    # signs that are written as two
    return text.translate(_table()).replace("เเ", "แ").replace("ํา", "ำ")
