"""Quantities recorded in different units, brought to ml, g or pcs.

A size with a readable unit is read from the label where that states a quantity, else from
size and label; a row without a size is read from the text of the product. A size without a
unit is assigned one by a mixture: its logarithm is held against the known log sizes of its
category - a normal component for each base unit, shifted by the logarithm of every known
conversion factor - and, where there is a price, the log price per base unit likewise. Weights of
the components are fitted by expectation maximisation, the unit is the likeliest component, and
`uncertain` flags a posterior below the threshold. Where the text states a content as well,
it is the exact check: an assignment it bears out is certain (way `mixture`), another gives
way to it (way `text`).

Defined results: a null or NaN size counts as missing; sizes of 0 or less give no
quantity; rows of a null category form one; a row from which nothing can be told is left out; repeated
rows count once; price_base is 0 where a price is null, NaN or the product's price is 0; very long
texts are searched whole; an empty table gives no rows; weights that don't settle raise a warning.
"""

from __future__ import annotations

import math
import warnings

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions.sizes import UNITS, content, folded, stated, unit_of
from weftline.session import cut

def _real(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def read_quantity(size: float | None, label: str | None, text: str | None) -> tuple[str, float, str] | None:
    """(base, whole content, way) as told by size, label and text."""
    short = folded(label) if label else ""
    said = stated(short)
    if said and size:
        return said[0], said[1] * size, "counted label"
    in_text = content(text)
    whole = (in_text[0], in_text[1] * in_text[2], "text") if in_text else None
    if said:
        return whole if said[2] and whole and whole[0] == said[0] else (said[0], said[1], "label")
    unit = unit_of(short) if short and size else None
    if unit:
        # A size rounded in its own unit is exact to the whole number in the text.
        if whole and whole[0] == unit[0] and abs(whole[1] / (size * unit[1]) - 1) < 0.03:
            return whole
        return unit[0], size * unit[1], "size"
    return whole


def _read_rows(size: pd.Series, label: pd.Series, text: pd.Series) -> pd.DataFrame:
    rows = []
    for a, b, c in zip(size, label, text, strict=True):
        short = folded(b) if b else ""
        open_ = a == a and a is not None and not stated(short) and not unit_of(short)
        rows.append((*(read_quantity(a if a == a else None, b, c) or (None, None, None)), open_))
    return pd.DataFrame(rows, columns=["base", "size", "way", "open"])


def unit_mixture(known: DataFrame, unknown: DataFrame, rounds: int = 50) -> DataFrame:
    """Rows of `unknown` (id, category, size, price) with (base, factor, posterior).

    known: (category, base, size in base units, price). Sums over rows are all that is kept
    between rounds, so each round is one aggregation of `unknown` with the few components.
    """
    name = F.coalesce("category", F.lit("")).alias("category")
    x = known.where("size > 0").select(name, "base", F.log("size").alias("x"), F.when(F.col("price") > 0, F.log(F.col("price") / F.col("size"))).alias("y"))
    spread = lambda c: F.greatest(F.coalesce(F.stddev_samp(c), F.lit(0.5)), F.lit(0.25))
    shape = x.groupBy("category", "base").agg(F.avg("x").alias("mu"), spread("x").alias("sd"), F.avg("y").alias("mu_y"), spread("y").alias("sd_y"), F.count(F.lit(1)).cast("double").alias("n"))
    shape = shape.groupBy("category").agg(F.map_from_entries(F.collect_list(F.struct("base", F.struct("mu", "sd", "mu_y", "sd_y", "n")))).alias("shape"), F.sum("n").alias("all"))
    factors = list(dict.fromkeys(UNITS.values()))

    def likelihood(base: str, factor: float) -> Column:
        s = F.try_element_at("shape", F.lit(base))
        whole = F.col("size") * factor
        z = (F.log(whole) - s["mu"]) / s["sd"]
        zy = (F.log(F.col("price") / whole) - s["mu_y"]) / s["sd_y"]
        priced = F.when((F.col("price") > 0) & s["mu_y"].isNotNull(), F.exp(-zy * zy / 2) / s["sd_y"]).otherwise(F.lit(1.0))
        return F.coalesce(F.exp(-z * z / 2) / s["sd"] * s["n"] / F.col("all") * priced, F.lit(0.0))

    # A row holds the likelihoods of all components, so a round moves one row of sums a task.
    rows = unknown.where("size > 0").select("id", name, "size", "price").join(shape, "category")
    rows = cut(rows.select("id", "size", F.array(*(likelihood(b, f) for b, f in factors)).alias("like")))
    weight = [1.0 / len(factors)] * len(factors)

    def weighed(weight: list[float]) -> DataFrame:
        w = F.zip_with("like", F.array(*map(F.lit, weight)), lambda x, y: x * y)
        x = rows.select("id", "size", w.alias("w"))
        return x.withColumn("all", F.aggregate("w", F.lit(0.0), lambda s, v: s + v)).where(F.col("all") > 0)

    for _ in range(rounds):
        sums = weighed(weight).agg(*(F.sum(F.col("w")[i] / F.col("all")) for i in range(len(factors)))).first()
        if sums[0] is None:
            break
        total = sum(sums)
        new = [(v + 0.01) / (total + 0.01 * len(factors)) for v in sums]
        done = max(abs(math.log(n / w)) for n, w in zip(new, weight, strict=True)) < 1e-2
        weight = new
        if done:
            break
    else:
        warnings.warn(f"the weights of units still move after {rounds} rounds", stacklevel=2)
    best = weighed(weight).withColumn("i", F.array_position("w", F.array_max("w")).cast("int"))
    of = lambda values: F.element_at(F.array(*map(F.lit, values)), F.col("i"))
    return best.select("id", "size", of([b for b, _ in factors]).alias("base"), of([f for _, f in factors]).alias("factor"), (F.array_max("w") / F.col("all")).alias("posterior"))


def _rows(df: DataFrame, key: str, size: str, label: str, text: str, category: str, price: str, unit_price: str) -> tuple[DataFrame, DataFrame]:
    """Rows told by label or text, and those of a size without a unit; a: (base, size, way)."""
    s = _real(F.col(size))
    src = df.select(F.col(key).alias("id"), s.alias("size"), F.col(label).alias("label"), F.col(text).alias("text"), F.col(category).alias("category"), _real(F.col(price)).alias("price"), _real(F.col(unit_price)).alias("unit_price"))
    src = src.withColumn("size", F.when(F.col("size") > 0, F.col("size")))
    exact = F.coalesce(F.col("label").isin("ml", "g", "pcs") & F.col("size").isNotNull(), F.lit(False))
    columns = ["id", "category", "size", "label", "price", "unit_price"]
    told_exact = src.where(exact).select(*columns, F.struct(F.col("label").alias("base"), F.col("size"), F.lit("exact").alias("way")).alias("a"))
    # Only the other rows' texts are read and sent to Python.
    read = src.where(~exact).select(*columns, F.pandas_udf(_read_rows, "base string, size double, way string, open boolean")("size", "label", "text").alias("a"))
    read = cut(read.select(*columns, F.when(F.col("a.base").isNotNull(), F.struct("a.base", "a.size", "a.way")).alias("a"), F.col("a.open").alias("open")))
    return told_exact.unionByName(read.where("not open and a is not null").drop("open")), read.where("open").drop("open")


def _known(told: DataFrame) -> DataFrame:
    return told.where("a.way = 'exact'").select("category", F.col("a.base").alias("base"), F.col("a.size").alias("size"), "price")


def to_common_units(df: DataFrame, key: str, size: str, label: str, text: str, category: str, price: str, unit_price: str, sure: float = 0.95) -> DataFrame:
    """Rows (key, base_unit, base_size DOUBLE, price_base BIGINT, way, posterior, uncertain)."""
    told, bare = _rows(df, key, size, label, text, category, price, unit_price)
    bare = cut(bare.distinct())
    guessed = unit_mixture(_known(told), bare.groupBy("id", "size").agg(F.max("category").alias("category"), F.max("price").alias("price")))
    guessed = guessed.select("id", "size", "base", "factor", "posterior")
    both = bare.join(guessed, ["id", "size"], "left").where("a is not null or base is not null")
    whole = F.col("size") * F.col("factor")
    borne_out = F.coalesce((F.col("base") == F.col("a.base")) & (F.abs(whole / F.col("a.size") - 1) < 0.03), F.lit(False))
    way = F.when(F.col("a").isNull() | borne_out, "mixture").otherwise("text")
    chosen = F.struct(F.coalesce("a.base", "base").alias("base"), F.coalesce("a.size", whole).alias("size"), way.alias("way"))
    certain = F.when(F.col("a").isNull(), F.col("posterior")).otherwise(F.lit(1.0))
    columns = ["id", "label", "price", "unit_price", "size"]
    out = told.select(*columns, "a", F.lit(1.0).alias("posterior")).unionByName(both.select(*columns, chosen.alias("a"), certain.alias("posterior")))
    whole_size = F.round(F.col("a.size"))
    base = F.when(F.col("price").isNull() | F.col("unit_price").isNull() | (F.col("price") == 0), F.lit(0.0)).otherwise(F.round(F.col("unit_price") * whole_size / F.nullif(F.col("price"), F.lit(0.0))))
    return out.select(
        F.col("id").alias(key), F.col("label").alias("_label"), F.col("size").alias("_size"), F.col("a.base").alias("base_unit"), whole_size.cast("long").alias("base_size"), base.cast("long").alias("price_base"), F.col("a.way").alias("way"), "posterior", (F.col("posterior") < sure).alias("uncertain")
    )


def masked_units(df: DataFrame, key: str, size: str, label: str, text: str, category: str, price: str, sure: float = 0.95) -> DataFrame:
    """How well the mixture tells units that are known: rows (category, unit, n, base_right,
    unit_right, n_sure, sure_right). Each row whose label is a known unit is put to the mixture
    with its size and price only; its own part in its category's shape is one row of it."""
    told, _ = _rows(df, key, size, label, text, category, price, price)
    labels = told.where("size is not null and label is not null").select("id", "category", "size", "price", F.pandas_udf(_unit_of_label, "base string, factor double")("label").alias("of")).where("of.base is not null").distinct()
    labels = cut(labels.groupBy("id", "size").agg(F.max("category").alias("category"), F.max("price").alias("price"), F.max("of").alias("of")))
    got = unit_mixture(_known(told), labels.select("id", "category", "size", "price")).join(labels.select("id", "size", "category", "of"), ["id", "size"])
    same_base = (F.col("base") == F.col("of.base")).cast("int")
    same = ((F.col("base") == F.col("of.base")) & (F.col("factor") == F.col("of.factor"))).cast("int")
    is_sure = (F.col("posterior") >= sure).cast("int")
    unit = F.concat_ws(" x ", F.col("of.factor").cast("string"), "of.base")
    return got.groupBy("category", unit.alias("unit")).agg(F.count(F.lit(1)).alias("n"), F.sum(same_base).alias("base_right"), F.sum(same).alias("unit_right"), F.sum(is_sure).alias("n_sure"), F.sum(is_sure * same).alias("sure_right"))


def _unit_of_label(label: pd.Series) -> pd.DataFrame:
    units = [unit_of(folded(x)) or (None, None) for x in label]
    return pd.DataFrame(units, columns=["base", "factor"])
