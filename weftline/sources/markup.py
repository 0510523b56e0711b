"""Records out of markup: result pages, article pages, journal XML, conclusions of a paper.

Each parser takes one text and gives plain values; the columns below run them over Arrow batches.
Markup that can't be read gives null, missing parts give nulls or empty lists.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Elements that never close.
_VOID = frozenset(("meta", "link", "br", "img", "hr", "input"))


class _Tree(HTMLParser):
    """Calls back with each finished element: (tag, attributes, own text)."""

    def __init__(self, done) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, dict, list[str]]] = []
        self.done = done

    def handle_starttag(self, tag, attrs):
        if tag in _VOID:
            self.done(tag, dict(attrs), "")
        else:
            self.open.append((tag, dict(attrs), []))

    def handle_startendtag(self, tag, attrs):
        self.done(tag, dict(attrs), "")

    def handle_endtag(self, tag):
        while self.open:
            name, attrs, text = self.open.pop()
            whole = "".join(text)
            self.done(name, attrs, whole)
            if name == tag:
                break

    def handle_data(self, data):
        if self.open:
            self.open[-1][2].append(data)


def result_stubs(html: str | None, title: str = "title-link", journal: str = "journal") -> list[tuple[str, str, str | None]]:
    """(title, link, journal) of each result of a page; classes name the parts. A result begins with its title."""
    out: list[list] = []

    def done(tag, attrs, text):
        kinds = (attrs.get("class") or "").split()
        if title in kinds:
            out.append([text, attrs.get("href") or "", None])
        elif journal in kinds and out and out[-1][2] is None:
            out[-1][2] = text

    if html:
        p = _Tree(done)
        p.feed(html)
        p.close()
    return [tuple(x) for x in out]


def article_record(html: str | None) -> dict | None:
    """title, date, authors, body as markdown, captions and references of an article's page."""
    if not html:
        return None
    got = {"title": None, "date": None, "authors": [], "body": [], "captions": [], "references": []}

    def done(tag, attrs, text):
        name, kinds = (attrs.get("name") or "").lower(), (attrs.get("class") or "").split()
        if tag == "meta":
            said = attrs.get("content")
            if name == "citation_title":
                got["title"] = got["title"] or said
            elif name in ("citation_publication_date", "citation_online_date"):
                got["date"] = got["date"] or said
            elif name == "citation_author" and said:
                got["authors"].append(said)
        elif re.fullmatch("h[1-6]", tag):
            got["body"].append("#" * int(tag[1]) + " " + text)
        elif tag == "p" and text.strip():
            got["body"].append(text)
        elif tag == "figcaption":
            got["captions"].append(text)
        elif tag == "li" and "reference" in kinds:
            got["references"].append(text)

    p = _Tree(done)
    p.feed(html)
    p.close()
    return got | {"body": "\n\n".join(got["body"])}


#: Kinds of publication dates, the best first (fixed values).
DATE_KINDS = ("epub", "ppub", "pub", "collection")


def jats_record(xml: str | None) -> dict | None:
    """title, date, authors, nested sections as markdown and references of an article in journal XML."""
    if not xml:
        return None
    try:
        root = ElementTree.fromstring(xml)
    except ElementTree.ParseError:
        return None
    text = lambda e: "" if e is None else " ".join("".join(e.itertext()).split())
    dates = {}
    for d in root.iter("pub-date"):
        y, m, day = (text(d.find(c)) for c in ("year", "month", "day"))
        if y:
            dates[d.get("pub-type") or d.get("date-type") or ""] = "-".join([y, *([m.zfill(2)] if m else []), *([day.zfill(2)] if m and day else [])])
    best = next((dates[k] for k in DATE_KINDS if k in dates), next(iter(dates.values()), None))
    authors = [" ".join(x for x in (text(c.find("name/given-names")), text(c.find("name/surname"))) if x) for c in root.iter("contrib")]
    lines: list[str] = []

    def section(s, depth: int) -> None:
        if (t := text(s.find("title"))):
            lines.append("#" * min(depth, 6) + " " + t)
        for child in s:
            if child.tag == "p":
                lines.append(text(child))
            elif child.tag == "sec":
                section(child, depth + 1)

    body = root.find("body")
    for s in body.findall("sec") if body is not None else ():
        section(s, 2)
    return {"title": text(root.find(".//article-title")) or None, "date": best, "authors": [a for a in authors if a], "body": "\n\n".join(lines), "references": [text(r) for r in root.iter("ref")]}


_HEADING = re.compile(r"^#{1,6} +(?:\d+\.? *)?(?P<h>.*)$", re.M)
_ENDS = re.compile(r"\b(?:conclusions?|concluding remarks|summary)\b", re.I)
_LABEL = re.compile(r"\bconclusions?\s*[:.]\s*(.+)", re.I | re.S)


def conclusions(text: str | None) -> str | None:
    """A paper's conclusions: the blocks under headings that say so, else what follows a label."""
    if not text:
        return None
    heads = list(_HEADING.finditer(text))
    blocks = [text[h.end() : n.start() if n else len(text)].strip() for h, n in zip(heads, [*heads[1:], None], strict=False) if _ENDS.search(h["h"])]
    if any(blocks):
        return "\n\n".join(b for b in blocks if b)
    said = _LABEL.search(text)
    return said[1].strip() or None if said else None


def stubs_column(html: Column) -> Column:
    def read(s: pd.Series) -> pd.Series:
        return s.map(lambda x: [{"title": t, "link": u, "journal": j} for t, u, j in result_stubs(x)])

    return F.pandas_udf(read, "array<struct<title: string, link: string, journal: string>>")(html)


def _records(parse, fields: list[str]):
    def read(s: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([[r[f] for f in fields] if (r := parse(x)) else [None] * len(fields) for x in s], columns=fields)

    return read


def article_column(html: Column) -> Column:
    return F.pandas_udf(_records(article_record, ["title", "date", "authors", "body", "captions", "references"]), "title string, date string, authors array<string>, body string, captions array<string>, references array<string>")(html)


def jats_column(xml: Column) -> Column:
    return F.pandas_udf(_records(jats_record, ["title", "date", "authors", "body", "references"]), "title string, date string, authors array<string>, body string, references array<string>")(xml)


def conclusions_column(text: Column) -> Column:
    def read(s: pd.Series) -> pd.Series:
        return s.map(conclusions)

    return F.pandas_udf(read, "string")(text)
