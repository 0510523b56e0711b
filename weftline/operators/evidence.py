"""Gates that hold generated text against its evidence, and durability scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions.text import norm
from weftline.operators.ranking import running

#: Floors of the durability bands (fixed values).
BANDS = ((90, "durable"), (70, "likely_durable"), (55, "leaning_durable"), (40, "undetermined"), (25, "leaning_fad"), (0, "likely_fad"))


def quoted(snippet: Column, evidence: Column, least: int = 3) -> Column:
    """Whether a snippet of at least three characters stands in the evidence, case and blanks aside."""
    s = norm(snippet)
    return (F.length(s) >= least) & F.contains(norm(evidence), s)


def fragments_in(quote: Column, document: Column, least: int = 12) -> Column:
    """Whether every fragment of a quote, cut at ellipses and with plain quotation marks,
    stands in the document; a quote shorter than `least` fails."""
    plain = lambda c: F.translate(norm(c), "“”‘’", "\"\"''")
    parts = F.filter(F.transform(F.split(plain(quote), r"\.\.\.|…"), lambda p: F.trim(p)), lambda p: p != "")
    d = plain(document)
    return (F.length(plain(quote)) >= least) & (F.size(parts) > 0) & F.forall(parts, lambda p: F.contains(d, p))


def numbers_supported(text: Column, evidence: Column) -> Column:
    """Whether each number of two digits or more, or with a percent sign, is a whole number of the evidence."""
    found = lambda c: F.transform(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"(\d[\d,.]*%?)"), F.lit(1)), lambda t: F.regexp_replace(t, r"[.,]+$", ""))
    said, known = found(text), F.transform(found(evidence), lambda t: F.regexp_replace(t, "%$", ""))
    told = F.filter(said, lambda t: (F.length(F.regexp_replace(t, r"\D", "")) >= 2) | t.endswith("%"))
    return F.forall(told, lambda t: F.array_contains(known, F.regexp_replace(t, "%$", "")))


def quotes_supported(text: Column, evidence: Column) -> Column:
    """Whether everything in single quotation marks stands in the evidence."""
    said = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"(?<!\w)'([^'\n]{3,80}?)'(?!\w)"), F.lit(1))
    e = norm(evidence)
    return F.forall(said, lambda q: F.contains(e, norm(q)))


def gate(text: Column, quote: Column, evidence: Column, banned: str) -> Column:
    """ok, or the first reason against a field: no quote, quote, number, wording."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(f"({banned})"), F.lit(1))
    e = norm(evidence)
    return (
        F.when(norm(quote) == "", "no quote")
        .when(~quoted(quote, evidence), "quote not in evidence")
        .when(~numbers_supported(text, evidence), "number not in evidence")
        .when(F.exists(words, lambda w: ~F.contains(e, w)), "unsupported wording")
        .otherwise("ok")
    )


def durability(verdicts: list[tuple[Column, int]], evidence: list[Column], headwinds: Column, confirmed: Column | None = None, confirms: int = 0) -> Column:
    """STRUCT(score, band, coverage, insufficient): 50 plus weighted verdicts of +1, 0 or -1,
    less 10 for one kind of headwind and 20 for more, within 5 to 95. `confirmed` turns the
    verdict at position `confirms` to +1."""
    parts = []
    for i, (v, w) in enumerate(verdicts):
        v = F.when(confirmed, 1).otherwise(v) if confirmed is not None and i == confirms else v
        parts.append(v * w)
    raw = sum(parts, F.lit(0))
    n = F.size(F.array_distinct(F.coalesce(headwinds, F.array().cast("array<string>"))))
    score = F.greatest(F.lit(5), F.least(F.lit(95), 50 + raw + F.when(n == 0, 0).when(n == 1, -10).otherwise(-20)))
    band = F.lit(None).cast("string")
    for floor, name in reversed(BANDS):
        band = F.when(score >= floor, name).otherwise(band)
    covered = sum(((F.trim(F.coalesce(e, F.lit(""))) != "").cast("int") for e in evidence), F.lit(0))
    return F.struct(score.alias("score"), band.alias("band"), covered.alias("coverage"), (covered <= 2).alias("insufficient"))


def novelty(name: Column, ingredients: Column, mature: list[str], novel: list[str], signals: list[str]) -> Column:
    """Whether a trend rests on unproven ingredients: its name says so without a proven one,
    or two or more novel ones are not outnumbered by more than one."""
    n = F.lower(F.coalesce(name, F.lit("")))
    blob = F.concat_ws(" | ", n, F.lower(F.array_join(F.coalesce(ingredients, F.array().cast("array<string>")), " , ")))
    hits = lambda words, t: F.size(F.filter(F.array(*(F.lit(w) for w in words)), lambda w: F.contains(t, w)))
    by_name = (hits([*novel, *signals], n) > 0) & (hits(mature, n) == 0)
    return by_name | ((hits(novel, blob) >= 2) & (hits(mature, blob) <= hits(novel, blob) + 1))


def investment_signal(z: Column, bound: float = 20.0) -> Column:
    return F.when(z.isNull() | (F.abs(z) > bound), "Monitor").when(z > 0.2, "Invest Now").when(z < -0.2, "Wait").otherwise("Monitor")


def trend_stage(short: Column, long: Column, band: float, strong: float) -> Column:
    """Stage of an expected path from its short and long change in percent."""
    return F.when(long <= -band, "Declining").when(long < band, "Stable").when(long <= short, "Peaking").when(short >= strong, "Growing").otherwise("Emerging")


def mentions(df: DataFrame, text: str, names: DataFrame, name: str, alias: str, key: str) -> DataFrame:
    """(key, name): rows whose text holds a name or one of its aliases as words.

    Names are found through their first word: the text's words are joined to the names'
    first words, and only those candidates are searched for in the text."""
    word = r"([^\W_]+)"
    n = names.select(name, F.lower(alias).alias("_a")).where("_a != ''").withColumn("_w", F.regexp_extract("_a", f"(?U){word}", 1))
    t = df.select(key, F.lower(text).alias("_t"))
    words = t.select(key, F.explode(F.array_distinct(F.regexp_extract_all("_t", F.lit(f"(?U){word}"), F.lit(1)))).alias("_w"))
    cand = words.join(n, "_w").select(key, name, "_a").distinct()
    hit = cand.join(t, key).where(F.contains(F.concat(F.lit(" "), F.regexp_replace("_t", r"(?U)[^\w]+", " "), F.lit(" ")), F.concat(F.lit(" "), F.trim(F.regexp_replace("_a", r"(?U)[^\w]+", " ")), F.lit(" "))))
    return hit.select(key, name).distinct()


def excerpt(lines: DataFrame, key: str, position: str, text: str, most: int) -> DataFrame:
    """A key's lines from the start while they fit, each with a line end, in `most` characters."""
    used = F.sum(F.length(text) + 1).over(Window.partitionBy(key).orderBy(position, text).rowsBetween(Window.unboundedPreceding, 0))
    return lines.withColumn("_u", used).where(F.col("_u") <= most).drop("_u")


def number_by_first_use(df: DataFrame, key: str, item: str, position: str) -> DataFrame:
    """(key, item, number): citation numbers in the order items are first used."""
    first = df.groupBy(key, item).agg(F.min(position).alias("_p"))
    return first.select(key, item, F.row_number().over(Window.partitionBy(key).orderBy("_p", item)).alias("number"))


def auc(df: DataFrame, groups: list[str], score: str, label: str) -> DataFrame:
    """Chance that a positive scores above a negative, by average ranks; null for one class only."""
    y = F.col(label).cast("int")
    x = df.groupBy(*groups, F.col(score).alias("_v")).agg(F.sum(y).alias("_y"), F.count(F.lit(1)).alias("_c"), F.sum(1 - y).alias("_o"))
    x = running(x, groups, [F.col("_v").asc_nulls_first()], "_c", "_upto")
    rank = F.col("_upto") - F.col("_c") + 1 + (F.col("_c") - 1) / 2
    g = x.groupBy(*groups).agg(F.sum(F.col("_y") * rank).alias("_s"), F.sum("_y").alias("_p"), F.sum("_o").alias("_n"))
    value = (F.col("_s") - F.col("_p") * (F.col("_p") + 1) / 2) / F.nullif(F.col("_p") * F.col("_n"), F.lit(0)).cast("double")
    return g.select(*groups, F.round(value, 6).alias("auc"))


def round_robin(df: DataFrame, list_no: str, position: str, url: str) -> DataFrame:
    """Several ranked lists merged turn by turn, each address once; place from 1."""
    first = df.withColumn("_k", F.row_number().over(Window.partitionBy(url).orderBy(position, list_no))).where("_k = 1").drop("_k")
    return running(first, [], [position, list_no], None, "place").withColumn("place", F.col("place").cast("int"))


def first_by(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The first row of each key in the given order."""
    return df.withColumn("_k", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_k = 1").drop("_k")


def merge_catalogues(left: DataFrame, right: DataFrame, keys: list[str], key: str, price: str, ratio: float = 3.0) -> tuple[DataFrame, DataFrame]:
    """(merged, pairs): right rows that equal a left one in all keys at a price within
    `ratio` are dropped in favour of the first such left row; rows with a null key never match."""
    a = left.select(*keys, F.col(key).alias("left_id"), F.col(price).alias("_a"))
    b = right.select(*keys, F.col(key).alias("right_id"), F.col(price).alias("_b"))
    near = ~((F.col("_a") > 0) & (F.col("_b") > 0)) | (F.greatest("_a", "_b") / F.least("_a", "_b") <= ratio)
    pairs = a.join(b, keys).where(F.coalesce(near, F.lit(True)) & (F.col("left_id") != F.col("right_id"))).groupBy("right_id").agg(F.min("left_id").alias("left_id"))
    rest = right.join(pairs.select(F.col("right_id").alias(key)), key, "left_anti")
    return left.unionByName(rest, allowMissingColumns=True), pairs
