"""The inputs of the analyses, taken from star-schema tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftline.sources.tables import table


def monthly(spark: SparkSession, d: str) -> DataFrame:
    """(keyword, month, value): revenue of each part name and month, scaled to a maximum of 100, with
    a row for every month between a keyword's first and last, so that rows are months."""
    from weftline.operators.series import dense_months

    p = table(spark, d, "part").select("p_partkey", F.col("p_name").alias("keyword"))
    li = table(spark, d, "lineitem").select(F.col("l_partkey").alias("p_partkey"), F.trunc("l_shipdate", "MM").alias("month"), (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("r"))
    # Partial sums by part before the join: rows shrink before they are moved.
    pre = li.groupBy("p_partkey", "month").agg(F.sum("r").alias("r"))
    m = dense_months(pre.join(p, "p_partkey").groupBy("keyword", "month").agg(F.round(F.sum("r").cast("double"), 4).alias("r")), "keyword", "month", "r")
    return m.select("keyword", "month", F.round(F.col("r") * 100 / F.max("r").over(Window.partitionBy("keyword")), 4).alias("value"))


def mapping(spark: SparkSession, d: str) -> DataFrame:
    """(keyword, cluster), many to many."""
    return table(spark, d, "part").select(F.col("p_name").alias("keyword"), F.col("p_type").alias("cluster")).distinct()


def predictions(spark: SparkSession, d: str) -> DataFrame:
    """Keyword rows at the last month: thin flag, momentum, level means, and predictions
    that stand for a model's: a share of the last year's growth, fading by year."""
    from weftline.operators.series import features

    v = F.col("value")
    by = Window.partitionBy("keyword").orderBy("month")
    mean = lambda a, b: F.avg(v).over(by.rowsBetween(a, b))
    x = features(monthly(spark, d)).withColumns({"last12_mean": mean(-11, 0), "prev12_mean": mean(-23, -12), "recent_mean": mean(-5, 0), "year_ago_mean": mean(-17, -12)})
    x = x.withColumn("_r", F.row_number().over(Window.partitionBy("keyword").orderBy(F.col("month").desc()))).where("_r = 1")
    g = F.round("growth_past_12m", 6)
    cols = ["last12_mean", "prev12_mean", "recent_mean", "year_ago_mean"]
    return x.select("keyword", (~F.col("enough")).alias("thin"), g.alias("momentum"), *(F.round(c, 9).alias(c) for c in cols), *(F.round(g * F.lit(0.6**h), 6).alias(f"pred_y{h}") for h in range(1, 6)))


#: The same inputs in SQL, for checks.
MONTHLY_SQL = """m0 as (select p_name keyword, cast(date_trunc('month', l_shipdate) as date) as month, round(sum(l_extendedprice * (1 - l_discount)), 4) r
  from lineitem join part on l_partkey = p_partkey group by 1, 2),
m1 as (select keyword, cast(unnest(generate_series(min(month), max(month), interval 1 month)) as date) as month from m0 group by 1),
m2 as (select keyword, month, coalesce(r, 0) r from m1 left join m0 using (keyword, month)),
monthly as (select keyword, month, round(r * 100 / max(r) over (partition by keyword), 4) as value from m2)"""
MAPPING_SQL = "mapping as (select distinct p_name keyword, p_type cluster from part)"
PREDICTIONS_SQL = MONTHLY_SQL + """,
f0 as (select keyword, month, value, row_number() over w - 1 i,
    avg(value) over (w rows between 11 preceding and current row) l12, avg(value) over (w rows between 23 preceding and 12 preceding) p12,
    avg(value) over (w rows between 5 preceding and current row) r6, avg(value) over (w rows between 17 preceding and 12 preceding) y6,
    sum(case when value > 0 then 1 else 0 end) over (w rows between 11 preceding and current row) pos,
    row_number() over (partition by keyword order by month desc) back
  from monthly window w as (partition by keyword order by month)),
f1 as (select *, case when i >= 23 then round(ln((l12 + 1) / (p12 + 1)), 6) end g from f0 where back = 1),
pred as (select keyword, not (i >= 23 and pos >= 6 and l12 >= 1) thin, g momentum, round(l12, 9) last12_mean, round(p12, 9) prev12_mean, round(r6, 9) recent_mean, round(y6, 9) year_ago_mean,
  round(g * 0.6::double, 6) pred_y1, round(g * 0.36::double, 6) pred_y2, round(g * 0.216::double, 6) pred_y3, round(g * 0.1296::double, 6) pred_y4, round(g * 0.07776::double, 6) pred_y5 from f1)"""
