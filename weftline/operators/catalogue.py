"""Catalogues, labels, answers of models and cached records."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions.text import parse_price, percent_off


def fold_accents(text: Column) -> Column:
    """Latin letters without their accents, by one translate over a table made from the Unicode data."""
    pairs = [(c, b[0]) for c in map(chr, range(0xC0, 0x250)) if len(b := unicodedata.normalize("NFD", c)) > 1 and b[0].isascii()]
    return F.translate(text, "".join(a for a, _ in pairs), "".join(b for _, b in pairs))


def to_catalogue(df: DataFrame, key: str, order: str, required: list[str], price: str, discount: str | None = None) -> DataFrame:
    """First row of each id, price as a number, discount as percent; missing columns are an error."""
    if lost := sorted(set([key, order, price, *required]) - set(df.columns)):
        raise ValueError(f"missing columns: {lost}")
    x = df.where(F.col(key).isNotNull()).withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(order))).where("_r = 1").drop("_r")
    x = x.withColumn("price", parse_price(F.col(price).cast("string")))
    return x.withColumn("discount_pct", percent_off(F.col(discount))) if discount else x


def classify(rules: list[tuple[Column, str]], fallback: Column) -> Column:
    """The first rule that holds names the class."""
    out = fallback
    for cond, name in reversed(rules):
        out = F.when(F.coalesce(cond, F.lit(False)), F.lit(name)).otherwise(out)
    return out


def pick_label(first: Column, second: Column, rule: Column, sure_first: Column, sure_second: Column) -> Column:
    """Two votes that agree win; else the one the rule agrees with; else the surer one; else the rule's."""
    return F.when(first.eqNullSafe(second), first).when(first == rule, first).when(second == rule, second).when(F.coalesce(sure_first, F.lit(0.0)) > F.coalesce(sure_second, F.lit(0.0)), first).when(second.isNotNull(), second).otherwise(F.coalesce(first, rule))


def latest_by_variant(labels: DataFrame, key: str, variant: str, order: str, values: list[str], variants: list[str]) -> DataFrame:
    """(key, <variant>_<value>...): the last record of each key and variant, side by side."""
    last = labels.groupBy(key, variant).agg(*(F.max_by(v, order).alias(v) for v in values))
    return last.groupBy(key).pivot(variant, variants).agg(*(F.first(v).alias(v) for v in values))


def answer_triples(text: Column) -> Column:
    """ARRAY<STRUCT(n, path, conf)> of the [n, "path", conf] triples in a model's answer."""
    p = F.lit(r'\[\s*(\d+)\s*,\s*"([^"\]]*)"\s*,\s*([\d.]+)\s*\]')
    n, path, conf = (F.regexp_extract_all(text, p, F.lit(i)) for i in (1, 2, 3))
    return F.transform(F.arrays_zip(n.alias("a"), path.alias("b"), conf.alias("c")), lambda t: F.struct(t["a"].cast("int").alias("n"), t["b"].alias("path"), t["c"].try_cast("double").alias("conf")))


def tolerant_json(text: Column) -> Column:
    """The first object or list of a text as strict JSON text: fences and trailing commas go, Python literals become JSON's; null where nothing parses."""
    t = F.regexp_extract(F.regexp_replace(text, r"```[a-z]*", ""), r"(?s)(\{.*\}|\[.*\])", 1)
    t = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(t, r",\s*([\]}])", "$1"), r"\bNone\b", "null"), r"\bTrue\b", "true"), r"\bFalse\b", "false")
    return F.to_json(F.try_parse_json(F.nullif(t, F.lit(""))))


def assign_once(answers: DataFrame, members: DataFrame, key: str, theme: str, ids: str, other: str = "Other", least: float = 0.9) -> DataFrame:
    """(member, theme): each member's first theme by place; the rest go to `other`; an answer that covers too few members is refused whole.

    answers (key, place, theme, ids ARRAY), members (key, member)."""
    first = answers.select(key, "place", theme, F.explode(ids).alias("member")).groupBy(key, "member").agg(F.min_by(theme, "place").alias("_t"))
    x = members.join(first, [key, "member"], "left")
    share = F.avg(F.col("_t").isNotNull().cast("int")).over(Window.partitionBy(key))
    return x.withColumn("_s", share).select(key, "member", F.when(F.col("_s") >= least, F.coalesce("_t", F.lit(other))).alias(theme))


def by_priority(sources: list[DataFrame], key: str) -> DataFrame:
    """Union of sources; the earliest that has a key supplies its row."""
    all_ = None
    for i, s in enumerate(sources):
        s = s.withColumn("_p", F.lit(i))
        all_ = s if all_ is None else all_.unionByName(s, allowMissingColumns=True)
    return all_.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy("_p"))).where("_r = 1").drop("_r", "_p")


def reuse(new: DataFrame, old: DataFrame, keys: list[str], digest: str, value: str) -> DataFrame:
    """Earlier results for rows whose input is unchanged; the others get null and are to be made."""
    o = old.select(*keys, F.col(digest).alias("_d"), F.col(value).alias("_v"))
    return new.join(o, keys, "left").withColumn(value, F.when(F.col("_d") == F.col(digest), F.col("_v"))).drop("_d", "_v")


def clean_document(text: Column, boilerplate: str, least: int = 50) -> Column:
    """Lines without separators, headings and boilerplate, joined; texts that lose nearly everything stay as they are."""
    lines = F.transform(F.split(text, r"\r?\n"), lambda x: F.trim(x))
    kept = F.filter(lines, lambda x: (x != "") & ~x.rlike(r"^[=\-_*#\s]+$") & ~F.lower(x).rlike(boilerplate))
    out = F.trim(F.regexp_replace(F.array_join(kept, " "), r"\s+", " "))
    return F.when(F.length(out) < least, F.trim(text)).otherwise(out)


def display_names(text: Column, names: dict[str, str]) -> Column:
    """Names replaced by those shown to readers, the longest first."""
    for old in sorted(names, key=len, reverse=True):
        text = F.replace(text, F.lit(old), F.lit(names[old]))
    return text


def country_of(affiliation: Column) -> Column:
    return F.trim(F.regexp_replace(F.element_at(F.split(affiliation, ","), -1), r"[.;]+$", ""))


def column_plan(df: DataFrame, group: str, category: str, kind: str, n: str, best: str, columns: int = 4, least: int = 3, dominant: float = 0.5) -> DataFrame:
    """Columns of a page: the largest categories with enough rows; one that holds more than
    `dominant` of all is shown by its kinds instead. (group, category, kind) counts in, place out."""
    c = df.groupBy(group, category).agg(F.sum(n).alias("_n"), F.max(best).alias("_b"))
    c = c.withColumn("_share", F.col("_n") / F.sum("_n").over(Window.partitionBy(group)))
    split = df.join(c.where(F.col("_share") > dominant).select(group, category), [group, category]).select(group, category, F.col(kind).alias("shown"), F.col(n).alias("_n"), F.col(best).alias("_b"))
    whole = c.where(F.col("_share") <= dominant).select(group, category, F.lit(None).cast("string").alias("shown"), "_n", "_b")
    r = F.row_number().over(Window.partitionBy(group).orderBy(F.col("_n").desc(), F.col("_b").desc_nulls_last(), category, "shown"))
    return split.unionByName(whole).where(F.col("_n") >= least).withColumn("place", r).where(F.col("place") <= columns).select(group, category, "shown", F.col("_n").alias("n"), "place")


def balanced(text: str | None) -> str | None:
    """A text from its first brace or bracket, with what is still open at its end closed."""
    if not text:
        return None
    start = min((i for i in (text.find("{"), text.find("[")) if i >= 0), default=-1)
    if start < 0:
        return None
    open_, quoted, skip, end = [], False, False, None
    for i, c in enumerate(text[start:], start):
        if skip:
            skip = False
        elif quoted:
            skip, quoted = c == "\\", c != '"'
        elif c == '"':
            quoted = True
        elif c in "{[":
            open_.append("}" if c == "{" else "]")
        elif c in "}]" and open_ and c == open_[-1]:
            open_.pop()
            if not open_:
                end = i + 1
                break
    body = text[start:end]
    return body if end else (body + ('"' if quoted else "")).rstrip().rstrip(",") + "".join(reversed(open_))


def repaired_json(text: Column) -> Column:
    """tolerant_json of a text whose open braces, brackets and quotes are closed first."""

    def close(s):
        return s.map(balanced)

    return tolerant_json(F.pandas_udf(close, "string")(text))
