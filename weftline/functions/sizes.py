"""Quantities in texts: units, contents and multipacks."""

from __future__ import annotations

import math
import re

from weftline.functions.unicode_map import plain

#: spelling -> (base unit, how many of it); fixed values.
UNITS = {
    "ml": ("ml", 1.0), "มล": ("ml", 1.0), "cc": ("ml", 1.0), "ซีซี": ("ml", 1.0), "มิลลิลิตร": ("ml", 1.0), "cl": ("ml", 10.0),
    "l": ("ml", 1000.0), "litre": ("ml", 1000.0), "liter": ("ml", 1000.0), "ลิตร": ("ml", 1000.0), "floz": ("ml", 29.5735),
    "g": ("g", 1.0), "gm": ("g", 1.0), "gram": ("g", 1.0), "กรัม": ("g", 1.0), "kg": ("g", 1000.0), "กก": ("g", 1000.0), "กิโลกรัม": ("g", 1000.0), "mg": ("g", 0.001), "oz": ("g", 28.3495), "ounce": ("g", 28.3495),
    "pcs": ("pcs", 1.0), "pc": ("pcs", 1.0), "piece": ("pcs", 1.0), "sheet": ("pcs", 1.0), "แผ่น": ("pcs", 1.0), "ชิ้น": ("pcs", 1.0), "pair": ("pcs", 2.0), "คู่": ("pcs", 2.0), "dozen": ("pcs", 12.0), "โหล": ("pcs", 12.0),
}

UNIT = r"fl\.? ?oz|fluid ounces?|ounces?|oz|pieces?|sheets?|pairs?|dozen|pcs|pc|grams?|gm|kg|mg|g|ml|cc|cl|lit(?:re|er)s?|l|มิลลิลิตร|มล|ซีซี|ลิตร|กิโลกรัม|กรัม|กก|แผ่น|ชิ้น|คู่|โหล"
NUMBER = r"\d+(?:,\d{3})*(?:\.\d+)?"
TWO = r"twin pack|แพ็คคู่"
#: A content with what multiplies it, before or after: groups 1 n x, 2 twin, 3 pack of n, 4 number, 5 unit, 6 x n, 7 pack of n, 8 twin.
CONTENT = rf"(?<![\w#.])(?:(\d+) ?[x×] ?|({TWO}) ?[\[(]? ?|(?:pack of|แพ็ค) ?(\d+) ?[\[(]? ?)?(?<![\d.])({NUMBER}) ?({UNIT})(?=x ?\d|[^a-z฀-๿]|$)\.?(?: ?[x×] ?(\d+)(?![\d.]* ?(?:{UNIT})\b)| ?[\[(]? ?(?:pack of|แพ็ค) ?(\d+)| ?[\[(]? ?({TWO}))?"
#: Contents that are given away with the product.
GIFT = rf"(?:\+ ?(?:free|แถม)|free gift|free mini|แถมฟรี|แถม (?:ซอง|ตัวอย่าง)|ตัวอย่าง|ซอง)[^\d\[\]()|]{{0,20}}{NUMBER} ?(?:{UNIT})(?=[^a-z฀-๿]|$)"


_CONTENT, _GIFT, _BLANK = re.compile(CONTENT), re.compile(GIFT), re.compile(r"\s+")
#: A label that states a quantity: lone x, items, number, unit.
_STATED = re.compile(r"^(?:~ ?|([x×]) ?)?(?:(\d+) ?[x×] ?)?(\d+(?:\.\d+)?) ?([^\d\s].*?)\.?$")


def folded(text: str) -> str:
    """Lower case without disguise, blanks single."""
    return _BLANK.sub(" ", plain(text).lower()).strip()


def unit_of(written: str) -> tuple[str, float] | None:
    """(base unit, how many of it) of a unit as written, folded."""
    t = written.replace(" ", "").replace(".", "")
    t = "floz" if t.startswith("fluid") else t
    return UNITS.get(t) or (UNITS.get(t[:-1]) if t.endswith("s") else None)


def contents(text: str) -> list[tuple[str, float, int, int, int]]:
    """(base, content of each, items, start, end) of every content in a folded text; the
    content of an item is brought to the nearest whole number where it is 1 or more."""
    out = []
    for m in _CONTENT.finditer(text):
        base, factor = unit_of(m[5])
        each = float(m[4].replace(",", "")) * factor
        n = 2 if m[2] or m[8] else next((int(m[i]) for i in (1, 3, 6, 7) if m[i]), 1)
        out.append((base, float(math.floor(each + 0.5)) if each >= 1 else each, n, m.start(), m.end()))
    return out


def without_gifts(text: str) -> str:
    return _GIFT.sub(" ", text)


def content(text: str | None) -> tuple[str, float, int] | None:
    """(base, content of each, items) of the first content of a text, gifts left out."""
    found = contents(without_gifts(folded(text))) if text else None
    return found[0][:3] if found else None


def stated(label: str) -> tuple[str, float, bool] | None:
    """(base, quantity, whether it is of a single item) of a folded label such as 3 x 50 ml."""
    m = _STATED.match(label)
    if not m or not (u := unit_of(m[4])):
        return None
    return u[0], float(m[3]) * u[1] * int(m[2] or 1), bool(m[1])
