"""Text rules as built-in column expressions; Thai is U+0E00 to U+0E7F."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

THAI = "฀-๿"


def parse_price(text: Column) -> Column:
    """Number of a money text such as 1,290.00; null where there is none."""
    return F.nullif(F.regexp_replace(text, "[^0-9.]", ""), F.lit("")).try_cast("double")


def percent_off(text: Column) -> Column:
    return F.regexp_extract(text, r"-?(\d+)\s*%", 1).try_cast("int")


def brand_key(text: Column) -> Column:
    """Lower case letters and digits, Latin or Thai."""
    return F.regexp_replace(F.lower(text), f"[^0-9a-z{THAI}]", "")


def norm(text: Column) -> Column:
    """Trimmed, lower case, blanks single; null counts as empty."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"\s+", " "))


def glued_thai(text: Column) -> Column:
    """norm, with Thai words joined that were split by blanks."""
    return F.regexp_replace(norm(text), f"(?<=[{THAI}]) (?=[{THAI}])", "")


def clean_terms(terms: Column, limit: int, words: int = 4) -> Column:
    """Lower case terms without commas, of at most four words, distinct, the first `limit`."""
    t = F.transform(terms, lambda x: F.trim(F.regexp_replace(F.lower(F.regexp_replace(x, ",", " ")), r"\s+", " ")))
    return F.slice(F.array_distinct(F.filter(t, lambda x: (x != "") & (F.size(F.split(x, " ")) <= words))), 1, limit)


def singular(text: Column) -> Column:
    """Lower case; a final s goes from words of four letters or more that don't end in ss, us, is or ous."""
    t = F.trim(F.lower(text))
    return F.when((F.length(t) >= 4) & t.endswith("s") & ~t.rlike("(ss|us|is|ous)$"), F.substring(t, F.lit(1), F.length(t) - 1)).otherwise(t)


def strip_thai(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(text, f"[{THAI}]+", " "), r"\s+", " "))


def first_sentences(text: Column, most: int) -> Column:
    """Whole sentences from the start while they fit in `most` characters."""
    parts = F.split(text, r"(?<=[.!?]) +")
    fits = lambda a, s: F.length(a) + F.length(s) + F.when(a == "", 0).otherwise(1) <= most
    join = lambda a, s: F.when(a == "", s).otherwise(F.concat(a, F.lit(" "), s))
    step = lambda acc, s: F.when(acc["open"] & fits(acc["t"], s), F.struct(join(acc["t"], s).alias("t"), F.lit(True).alias("open"))).otherwise(F.struct(acc["t"].alias("t"), F.lit(False).alias("open")))
    return F.aggregate(parts, F.struct(F.lit("").alias("t"), F.lit(True).alias("open")), step, lambda acc: acc["t"])


def clean_url(url: Column) -> Column:
    """The address without its utm_ parameters."""
    query = F.array_join(F.filter(F.split(F.regexp_extract(url, r"\?([^#]*)", 1), "&"), lambda p: (p != "") & ~p.startswith("utm_")), "&")
    base = F.regexp_replace(url, r"[?#].*$", "")
    return F.when(url.isNotNull(), F.concat(base, F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")))


def domain(url: Column) -> Column:
    return F.regexp_replace(F.lower(F.regexp_extract(url, r"^[a-z]+://([^/?#:]+)", 1)), r"^www\.", "")


def is_junk(text: Column) -> Column:
    """Addresses and application ids that were typed as searches."""
    return F.coalesce(text.rlike(r"(?i)(https?:|www\.|\.com\b|^com\.[a-z]+\.|\.apk\b)"), F.lit(False))


def rewrite(text: Column, rules: list[tuple[str, str]]) -> Column:
    """Ordered replacements."""
    for pattern, by in rules:
        text = F.regexp_replace(text, pattern, by)
    return text


def banned_words(text: Column, words: list[str]) -> Column:
    """Listed words found, in order of place, once each whatever their case."""
    found = F.regexp_extract_all(F.lower(text), F.lit(rf"\b({'|'.join(words)})\b"), F.lit(1))
    return F.array_distinct(found)


def slug(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(text)), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def tokens(text: Column, stop: list[str] = ()) -> Column:
    """Distinct lower case words without stop words, sorted."""
    t = F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(f"([a-z0-9{THAI}]+)"), F.lit(1)))
    return F.array_sort(F.filter(t, lambda w: ~w.isin(*stop)) if stop else t)


def jaccard(a: Column, b: Column) -> Column:
    """Shared over all tokens; 0 where one side is empty."""
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b)))


def word_match(text: Column, keyword: Column, stop: list[str] = ()) -> Column:
    """Share of a keyword's significant words that the text contains, 3 decimals."""
    words = tokens(keyword, stop)
    t = F.lower(F.coalesce(text, F.lit("")))
    return F.when(F.size(words) == 0, 0.0).otherwise(F.round(F.size(F.filter(words, lambda w: F.contains(t, w))) / F.size(words), 3))


def iso_duration(text: Column) -> Column:
    """Seconds of PT1H4M13S."""
    part = lambda u: F.coalesce(F.regexp_extract(text, rf"(\d+){u}", 1).try_cast("int"), F.lit(0))
    return F.when(text.rlike(r"^PT(\d+H)?(\d+M)?(\d+S)?$"), part("H") * 3600 + part("M") * 60 + part("S"))


def any_date(text: Column) -> Column:
    """A date in one of the usual notations; years from 2400 on are Buddhist ones."""
    forms = ["yyyy-MM-dd", "dd/MM/yyyy", "d MMM yyyy", "d MMMM yyyy", "MMM d, yyyy", "MMMM d, yyyy", "yyyy/MM/dd"]
    head = F.regexp_extract(F.trim(text), r"^(\d{4}-\d{2}-\d{2})", 1)
    t = F.when(head != "", head).otherwise(F.trim(F.regexp_replace(text, r"\s*(B\.?E\.?|พ\.ศ\.)\s*", " ")))
    d = F.coalesce(*(F.try_to_timestamp(t, F.lit(f)) for f in forms)).cast("date")
    return F.when(F.year(d) >= 2400, F.add_months(d, -543 * 12)).otherwise(d)


def midpoint(a: Column, b: Column) -> Column:
    return F.date_add(a, F.floor(F.datediff(b, a) / 2).cast("int"))


def token_budget(text: Column, ratio: float = 4.0, least: int = 256) -> Column:
    return F.greatest(F.lit(least), F.ceil(F.length(text) / ratio).cast("int"))


def input_hash(*cols: Column) -> Column:
    """Digest of the values in their order; null and empty differ."""
    return F.sha2(F.to_json(F.struct(*(c.alias(f"c{i}") for i, c in enumerate(cols)))), 256)


def with_tokens(df, tokens: dict[str, str]):
    """df with {name} replaced by its value in every text, also in lists and structures."""

    def apply(c: Column, kind) -> Column:
        name = kind.typeName()
        if name == "string":
            for k, v in tokens.items():
                c = F.replace(c, F.lit("{" + k + "}"), F.lit(v))
            return c
        if name == "array":
            return F.transform(c, lambda x: apply(x, kind.elementType))
        if name == "struct":
            return F.when(c.isNotNull(), F.struct(*(apply(c[f.name], f.dataType).alias(f.name) for f in kind.fields)))
        return c

    return df.select(*(apply(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields))
