"""Gates of written findings and views of reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions.text import norm
from weftline.operators.evidence import numbers_supported, quoted


def check_finding(factor: Column, text: Column, quote: Column, source: Column, factors: list[str], language: str = r"[฀-๿]") -> Column:
    """ok, or the first reason against a finding: factor, empty, language, quote, number."""
    return (
        F.when(~F.coalesce(factor.isin(*factors), F.lit(False)), "unknown factor")
        .when(norm(text) == "", "empty")
        .when(text.rlike(language), "wrong language")
        .when(~F.coalesce(quoted(quote, source), F.lit(False)), "quote not in source")
        .when(~numbers_supported(text, source), "number not in source")
        .otherwise("ok")
    )


def names_not_in(report: Column, source: Column) -> Column:
    """Capitalised names of two words or more that the source doesn't hold."""
    found = F.array_distinct(F.regexp_extract_all(F.coalesce(report, F.lit("")), F.lit(r"\b([A-Z][\w'-]+(?: [A-Z][\w'-]+)+)\b"), F.lit(1)))
    s = F.lower(F.coalesce(source, F.lit("")))
    return F.filter(found, lambda n: ~F.contains(s, F.lower(n)))


def validate_links(levels: Column, evidence: Column, allowed: tuple[int, ...] = (0, 1, 2), words: int = 30) -> Column:
    """STRUCT(level, evidence): a level outside the closed set counts as 0; evidence is cut to 30 words."""
    cut = F.array_join(F.slice(F.split(F.trim(F.coalesce(evidence, F.lit(""))), r"\s+"), 1, words), " ")
    return F.struct(F.when(levels.isin(*allowed), levels).otherwise(0).alias("level"), cut.alias("evidence"))


def first_use(points: DataFrame, group: str, place: str, item: str, most: int) -> DataFrame:
    """Points whose item no earlier point of the group has used, the first `most` of each."""
    r = F.row_number().over(Window.partitionBy(group, item).orderBy(place))
    x = points.withColumn("_r", r).where("_r = 1").drop("_r")
    return x.withColumn("_k", F.row_number().over(Window.partitionBy(group).orderBy(place, item))).where(F.col("_k") <= most).drop("_k")


def comparative_delta(score: Column, peers: Column, matched: Column) -> Column:
    """A high score is taken down by 12, or by 22 where most of its peers are ahead; only from 70 on and with 60 % of the peers known."""
    return F.when((score >= 70) & (matched >= 0.6), score - F.when(peers > 0.5, 22).otherwise(12)).otherwise(score)


def lint(text: Column, longest: int, clause: int = 15) -> Column:
    """STRUCT(n_long, n_clauses, n_foreign, n_leaks): sentences of more words than `longest`, clauses of
    more than `clause`, Latin words of four letters or more in a Thai text, and traces of templates or addresses."""
    t = F.coalesce(text, F.lit(""))
    more = lambda parts, n: F.size(F.filter(parts, lambda s: F.size(F.split(F.trim(s), r"\s+")) > n))
    sentences = F.split(t, r"(?<=[.!?])\s+")
    clauses = F.split(t, r"(?<=[.!?,;:])\s+")
    foreign = F.when(t.rlike("[฀-๿]"), F.size(F.regexp_extract_all(t, F.lit("([A-Za-z]{4,})"), F.lit(1)))).otherwise(0)
    leaks = F.size(F.regexp_extract_all(t, F.lit(r"(\{[A-Za-z_]+\}|https?://|<\|)"), F.lit(1)))
    return F.struct(more(sentences, longest).alias("n_long"), more(clauses, clause).alias("n_clauses"), foreign.alias("n_foreign"), leaks.alias("n_leaks"))


def match_text(need: Column, evidence: Column, most: int = 12) -> Column:
    """Text a trend is matched by: what people need, then up to twelve distinct quotes."""
    quotes = F.slice(F.array_distinct(F.filter(F.transform(evidence, lambda e: F.trim(e)), lambda e: e != "")), 1, most)
    return F.concat_ws(" | ", need, F.array_join(quotes, " | "))


def flatten_value(value: Column) -> Column:
    """Text of a JSON value: a wrapper's "value" or "text", else the value itself without quotation marks."""
    return F.coalesce(F.get_json_object(value, "$.value"), F.get_json_object(value, "$.text"), F.regexp_replace(value, r'^"|"$', ""))


def place_phrase(places: Column) -> Column:
    """a, b and c."""
    n = F.size(places)
    return F.when(n <= 1, F.array_join(places, "")).otherwise(F.concat(F.array_join(F.slice(places, F.lit(1), F.greatest(n - 1, F.lit(1))), ", "), F.lit(" and "), F.element_at(places, -1)))


def quadrant(strength: Column, growth: Column, line_s: Column, line_g: Column) -> Column:
    return F.when((strength >= line_s) & (growth >= line_g), "defend").when(strength >= line_s, "maintain").when(growth >= line_g, "build").otherwise("monitor")
