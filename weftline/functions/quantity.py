"""What a catalogue row's size comes to: pack, bundle and gift aware, with a flag for its trust.

The name is scanned once into quantities and multipliers; what stands between two of them says
how they belong together: a cross multiplies, a plus or ampersand adds.

Flags (fixed values): ok, no_size, not_a_quantity, ambiguous_x, bundle_summed,
bundle_unresolved, pieces_unverified.
"""

from __future__ import annotations

import re
from typing import NamedTuple

#: spelling -> (dimension, how much of g, ml or pieces it is); fixed values.
DIMENSIONS = {
    "g": ("mass", 1.0), "gm": ("mass", 1.0), "gms": ("mass", 1.0), "gram": ("mass", 1.0), "grams": ("mass", 1.0), "กรัม": ("mass", 1.0), "kg": ("mass", 1000.0), "oz": ("mass", 28.3495),
    "ml": ("volume", 1.0), "cc": ("volume", 1.0), "มล": ("volume", 1.0), "l": ("volume", 1000.0), "ltr": ("volume", 1000.0), "litre": ("volume", 1000.0), "ลิตร": ("volume", 1000.0), "floz": ("volume", 29.5735),
    "pc": ("count", 1.0), "pcs": ("count", 1.0), "piece": ("count", 1.0), "pieces": ("count", 1.0), "ชิ้น": ("count", 1.0), "แผ่น": ("count", 1.0), "sheet": ("count", 1.0), "sheets": ("count", 1.0), "pads": ("count", 1.0), "patches": ("count", 1.0),
    "capsules": ("count", 1.0), "tablets": ("count", 1.0), "sachets": ("count", 1.0), "ct": ("count", 1.0), "pair": ("count", 2.0), "pairs": ("count", 2.0), "คู่": ("count", 2.0),
    "mg": ("other", 1.0), "m": ("other", 1.0), "cm": ("other", 1.0), "mm": ("other", 1.0), "inch": ("other", 1.0),
}
_SPELLED = "|".join(sorted((r"fl\.? ?oz" if u == "floz" else re.escape(u) for u in DIMENSIONS), key=len, reverse=True))
_PART = re.compile(rf"(?<![\w.])(?P<n>\d+(?:[.,]\d+)?) ?(?P<u>{_SPELLED})(?![a-z])|(?P<x>[x×*]) ?(?P<k>\d{{1,3}})(?![\d.] ?|\w)|(?<![\w.])(?P<j>\d{{1,3}}) ?(?=[x×*])", re.I)
_GIFT = re.compile(r"\b(?:free|gift)\b|แถม|ฟรี", re.I)
_SET = re.compile(r"\b(?:set|kit|duo|trio|bundle|value pack|twin pack)\b|เซ็ต|แพ็คคู่|ยกกล่อง|buy ?\d ?get", re.I)
_SHADE = re.compile(r"#\S+|\bno\.? ?\d+\S*", re.I)


class Quantity(NamedTuple):
    amount: float
    dimension: str
    start: int
    end: int


class Size(NamedTuple):
    size: float | None
    dimension: str | None
    pack: int | None
    flag: str


def unit(spelled: str | None) -> tuple[str, float] | None:
    return DIMENSIONS.get(re.sub(r"[\s.]", "", spelled).lower()) if spelled else None


def _scan(name: str) -> tuple[list[Quantity], list[tuple[int, int, int]]]:
    """Quantities, and multipliers as (times, start, end)."""
    found, times = [], []
    for m in _PART.finditer(name):
        if m["u"]:
            kind, factor = unit(m["u"])
            found.append(Quantity(float(m["n"].replace(",", ".")) * factor, kind, *m.span()))
        else:
            times.append((int(m["k"] or m["j"]), *m.span()))
    return found, times


def _near(a: float, b: float) -> bool:
    return abs(a - b) <= 0.01 * abs(b)


def _joined(name: str, found: list[Quantity]) -> list[list[Quantity]]:
    """Runs of quantities with a plus or ampersand, and no other number, between neighbours."""
    runs: list[list[Quantity]] = []
    for q in found:
        if runs:
            between = name[runs[-1][-1].end : q.start]
            if len(between) <= 60 and re.search("[+&]", between) and not re.search(r"\d", _SHADE.sub(" ", between)):
                runs[-1].append(q)
                continue
        runs.append([q])
    return [r for r in runs if len(r) > 1]


def standard_size(name: str | None, size: float | None, spelled: str | None, pieces: float | None = None) -> Size:
    """The size of what is paid for, in g, ml or pieces."""
    known = unit(spelled)
    if known is None or size is None or not size > 0:
        return Size(None, None, None, "no_size")
    kind, factor = known
    if kind == "other":
        return Size(None, None, None, "not_a_quantity")
    stated, text = size * factor, name or ""
    gift = _GIFT.search(text)
    if gift and _scan(text[: gift.start()])[0]:
        text = text[: gift.start()]
    found, times = _scan(text)
    between = [(a, b, text[a.end : b.start].strip().lower()) for a, b in zip(found, found[1:], strict=False)]
    if any(sign in ("x", "×", "*") and {a.dimension, b.dimension} == {"mass", "volume"} for a, b, sign in between):
        return Size(None, None, None, "ambiguous_x")
    for run in _joined(text, found):
        kinds, total = {q.dimension for q in run}, sum(q.amount for q in run)
        if "other" in kinds or not ((run[0].dimension == kind and _near(run[0].amount, stated)) or _near(total, stated)):
            continue
        if "count" in kinds and len(kinds) > 1:
            return Size(None, None, None, "bundle_unresolved")
        return Size(total, kinds.pop() if len(kinds) == 1 else "mixed", None, "bundle_summed")
    # A multiplier is a bare number beside a cross, or a count of pieces beside one.
    packs = [(q, k) for q in found if q.dimension == kind for k, a, b in times if k > 1 and (text[q.end : a].strip() == "" if a >= q.end else text[b : q.start].strip(" x×*X") == "")]
    packs += [(a, b.amount) for a, b, s in between if s in ("x", "×", "*") and b.dimension == "count" and a.dimension == kind and b.amount > 1]
    packs += [(b, a.amount) for a, b, s in between if s in ("x", "×", "*") and a.dimension == "count" and b.dimension == kind and a.amount > 1 and kind != "count"]
    for q, k in packs:
        if _near(q.amount, stated):
            return Size(stated * k, kind, int(k), "ok")
        if _near(q.amount * k, stated):
            return Size(stated, kind, int(k), "ok")
    if pieces and pieces > 1 and not (kind == "count" and _near(pieces, stated)) and not any(q.dimension == "count" and _near(q.amount, pieces) for q in found):
        return Size(stated, kind, 1, "pieces_unverified")
    return Size(stated, kind, 1, "bundle_unresolved" if _SET.search(text) else "ok")
