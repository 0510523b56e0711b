"""Gates for written texts and profiles: what they may say, how long, in which language and shape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Words of reason, purpose, planning and feeling that searches can't show (fixed values).
PURPOSE_EN = r"\b(in order to|so that|because|due to|as a result|therefore|(?:to|for) prepare|prepar(?:e|es|ing|ation) for|in preparation|get(?:ting)? ready|to plan|planning|plans? ahead|feel(?:s|ing|ings)?|confident|confidence|worr(?:y|ies|ied)|anxious|relief|peace of mind)\b"
PURPOSE_TH = "เตรียม|เนื่องจาก|เพราะ|ดังนั้น|ส่งผลให้|ทำให้|วางแผน|รู้สึก|มั่นใจ|กังวล|สบายใจ"
#: Names of the months of a season, in order (fixed values).
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")


def without_quoted(text: Column) -> Column:
    """A text without what stands in single quotation marks."""
    return F.regexp_replace(text, "'[^']*'", " ")


def states_purpose(text: Column, search: Column | None = None) -> Column:
    """Whether a text says why, what for or with which feeling, outside the searches it cites."""
    t = F.lower(F.coalesce(text, F.lit("")))
    if search is not None:
        s = F.lower(F.coalesce(search, F.lit("")))
        t = F.when(s == "", t).otherwise(F.replace(t, s, F.lit(" ")))
    t = without_quoted(t)
    return t.rlike(PURPOSE_EN) | t.rlike(PURPOSE_TH)


def valid_text(text: Column, language: str, most: int) -> Column:
    """ok, or the first reason against a text: empty, language, too long. Words are parted by blanks."""
    t = F.trim(F.coalesce(text, F.lit("")))
    thai = without_quoted(t).rlike("[฀-๿]") if language == "en" else ~t.rlike("[฀-๿]")
    return F.when(t == "", "empty").when(thai, "language").when(F.size(F.split(F.regexp_replace(t, " +", " "), " ")) > most, "too long").otherwise("ok")


def same_shape(a: Column, b: Column) -> Column:
    """Whether two lists have equally many entries that are blank at the same places."""
    blank = lambda c: F.transform(c, lambda x: F.trim(F.coalesce(x, F.lit(""))) == "")
    return (F.size(a) == F.size(b)) & (blank(a) == blank(b))


def allowed_numbers(values: Column) -> Column:
    """The percents a text may cite: the absolute values to whole numbers and to one decimal."""
    return F.array_distinct(F.flatten(F.transform(F.filter(values, lambda v: v.isNotNull()), lambda v: F.array(F.round(F.abs(v)), F.round(F.abs(v), 1)))))


def percents_allowed(text: Column, allowed: Column) -> Column:
    """Whether each percent of a text is one of the allowed ones, to half the last decimal."""
    said = F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"(\d+(?:\.\d+)?) ?%"), F.lit(1)), lambda x: x.cast("double"))
    return F.forall(said, lambda x: F.exists(allowed, lambda a: F.abs(x - a) < 0.051))


def cross_source(trends: DataFrame, words: DataFrame, trend: str, stream: str, word: str, d2: str) -> DataFrame:
    """trends with n_streams, the streams that hold one of its keywords, and applied: whether it
    is newly confirmed, for it is in several streams and wasn't confirmed before."""
    by = words.groupBy(word).agg(F.collect_set(stream).alias("_in"))
    n = words.select(trend, word).distinct().join(by, word).groupBy(trend).agg(F.array_distinct(F.flatten(F.collect_set("_in"))).alias("_all"))
    out = trends.join(n, trend, "left").withColumn("n_streams", F.coalesce(F.array_size("_all"), F.lit(0))).drop("_all")
    return out.withColumn("applied", (F.col("n_streams") > 1) & (F.coalesce(F.col(d2), F.lit(0)) != 1))


def retry(wanted: DataFrame, answers: DataFrame, key: str, rounds: str, most: int = 3) -> DataFrame:
    """What is still to be asked: wanted rows without an accepted answer, each at most `most` times."""
    done = answers.where("accepted").select(key).distinct()
    tried = answers.groupBy(key).agg(F.max(rounds).alias("_n"))
    return wanted.join(done, key, "left_anti").join(tried, key, "left").where(F.coalesce("_n", F.lit(0)) < most).withColumn("round", F.coalesce("_n", F.lit(0)) + 1).drop("_n")


def key_for_request(keys: DataFrame, requests: DataFrame, quota: str, key: str, order: str) -> DataFrame:
    """requests with the key that serves each: keys are used up one after the other, in their
    order; requests beyond the sum of all quotas have none. keys: a short list."""
    k = keys.withColumn("_to", F.sum(quota).over(Window.partitionBy(F.lit(0)).orderBy(key).rowsBetween(Window.unboundedPreceding, 0)))
    k = k.select(F.col(key).alias("served_by"), (F.col("_to") - F.col(quota)).alias("_from"), "_to")
    from weftline.operators.ranking import running

    r = running(requests, [], [order], None, "_i")
    return r.join(k, (F.col("_i") > F.col("_from")) & (F.col("_i") <= F.col("_to")), "left").drop("_i", "_from", "_to")


def pack_columns(heights: list[float], capacity: float, gap: float) -> list[int]:
    """Column of each block, in order, so that no column is over capacity and the unused rest,
    squared, is least; a block higher than a column has one of its own."""
    n = len(heights)
    best: list[tuple[float, int]] = [(0.0, 0)]
    for end in range(1, n + 1):
        options = []
        used = -gap
        for start in range(end, 0, -1):
            used += heights[start - 1] + gap
            if used > capacity and start < end:
                break
            rest = max(0.0, capacity - used)
            options.append((best[start - 1][0] + rest * rest, start - 1))
        best.append(min(options))
    column, out, cuts, at = 0, [], [], n
    while at:
        cuts.append(best[at][1])
        at = best[at][1]
    starts = set(cuts)
    for i in range(n):
        if i in starts and i:
            column += 1
        out.append(column)
    return out
