"""Queries of the product operators, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftline.operators import supply as U
from weftline.plans.growth_queries import r6
from weftline.sources.tables import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = f"with {LISTINGS_SQL}{sql}" if sql.startswith(("select", ",")) else sql
            if sql.startswith("select"):
                SQL[name] = f"with {LISTINGS_SQL} {sql}"
        return f

    return add


LISTINGS_SQL = """lst as (select distinct listing_id id, trend_id trend, product_group grp, subgroup sub, upper(trim(brand)) brand, case when isnan(similarity) then null else similarity end sim, sale_price_thb price, sold_count sold,
  case unit_label when 'L' then pack_size * 1000 when 'kg' then pack_size * 1000 else pack_size end size, case unit_label when 'L' then 'ml' when 'kg' then 'g' else unit_label end unit, product_name pname, scored_at as scored from validate_at_scale_nvidia)"""


def listings(spark: SparkSession, d: str) -> DataFrame:
    """Each listing once: id, trend, grp, sub, brand, sim, price, sold, size in base units, unit, pname."""
    u, s = F.col("unit_label"), F.col("pack_size")
    big = u.isin("L", "kg")
    return (
        table(spark, d, "validate_at_scale_nvidia")
        .select(
            F.col("listing_id").alias("id"), F.col("trend_id").alias("trend"), F.col("product_group").alias("grp"), F.col("subgroup").alias("sub"), F.upper(F.trim("brand")).alias("brand"), F.when(~F.isnan("similarity"), F.col("similarity")).alias("sim"), F.col("sale_price_thb").alias("price"),
            F.col("sold_count").alias("sold"), F.when(big, s * 1000).otherwise(s).alias("size"), F.when(u == "L", "ml").when(u == "kg", "g").otherwise(u).alias("unit"), F.col("product_name").alias("pname"), F.col("scored_at").alias("scored"),
        )
        .distinct()
    )


RANKED = "row_number() over (partition by trend order by sim desc nulls last, id)"


@query("g01_top_products", f"select trend, id, rank from (select *, {RANKED} as rank from lst) where rank <= 15")
def g01(spark, d):
    return U.top_per_group(listings(spark, d), ["trend"], "sim", "id", 15).select("trend", "id", "rank")


@query("f18_brand_best", f", r as (select *, {RANKED} rk, count(*) over (partition by trend) n from lst) select trend, brand, min(rk) as best_rank, round((min(n) - (min(rk) - 1)) / min(n)::double * 100) as percentile from r where brand is not null group by all")
def f18(spark, d):
    x = U.with_total(U.rank_in(listings(spark, d), ["trend"], "sim", "id"), ["trend"], "n")
    g = x.where("brand is not null").groupBy("trend", "brand").agg(F.min("rank").alias("best_rank"), F.min("n").alias("n"))
    return g.select("trend", "brand", "best_rank", F.round((F.col("n") - (F.col("best_rank") - 1)) / F.col("n") * 100).alias("percentile"))


@query("f16_coverage", f"select trend, round(avg(sim), 6) as coverage from (select *, {RANKED} k from lst where sim is not null) where k <= 3 group by 1")
def f16(spark, d):
    return U.coverage(listings(spark, d), "trend", "sim", "id")


COVER = f", c as (select trend, round(avg(sim), 6) s from (select *, {RANKED} k from lst where sim is not null) where k <= 3 group by 1), p as (select trend, s, case when count(*) over () <= 1 then 50 else round(cume_dist() over (order by s) * 100, 1) end pc from c)"


@query("f17_opportunity", f"{COVER} select trend, pc as percentile, case when pc < 33 then 'gap' when pc < 67 then 'partial' else 'covered' end as opportunity from p")
def f17(spark, d):
    x = U.percentile_at_most(U.coverage(listings(spark, d), "trend", "sim", "id").withColumn("g", F.lit(0)), ["g"], "coverage")
    return x.select("trend", "percentile", U.opportunity(F.col("percentile")).alias("opportunity"))


def _cuts(groups: str, k: int, value: str = "price", src: str = "lst") -> str:
    return f"""vals as (select {groups}, {value} v, row_number() over (partition by {groups} order by {value}) p, count(*) over (partition by {groups}) n, max({value}) over (partition by {groups}) top from {src} where {value} is not null),
cut as (select {groups}, list_sort(list_distinct(list(v))) cuts from vals, (select unnest(range(1, {k})) i) where p = round_even(n * i / {k}.0::double, 0) and p < n and v < top group by {groups})"""


@query("d10_price_tiers", f", {_cuts('grp', 3)} select id, 1 + coalesce(len(list_filter(cuts, lambda c: price > c)), 0)::int as tier from lst left join cut on lst.grp is not distinct from cut.grp where price is not null and lst.grp is not null")
def d10(spark, d):
    return U.assign_tiers(listings(spark, d).where("grp is not null"), ["grp"], "price", 3).where("price is not null").select("id", "tier")


@query("i03_cut_lines", f", {_cuts('grp', 3)} select grp, cuts from cut where grp is not null")
def i03c(spark, d):
    return U.price_cuts(listings(spark, d).where("grp is not null"), ["grp"], "price", 3).where(F.size("cuts") > 0).select("grp", "cuts")


@query(
    "k03_brand_tiers",
    """, b as (select brand, price from lst where brand is not null and price is not null), v as (select *, row_number() over (partition by brand order by price) p, count(*) over (partition by brand) n, lead(price) over (partition by brand order by price) nx, max(price) over (partition by brand) top from b),
c as (select brand, i, (price + nx) / 2 cut, top from (select *, greatest(1, least(3, n // 2)) k from v), (select unnest([1, 2]) i) where i < k and p = round_even(n * i / k::double, 0) and p < n)
select brand, list_sort(list_distinct(list(cut))) as cuts from c where cut < top group by brand""",
)
def k03(spark, d):
    return U.price_cuts(listings(spark, d).where("brand is not null"), ["brand"], "price", 3, between=True).where(F.size("cuts") > 0).select("brand", "cuts")


UNIT = ", up as (select *, case when price > 0 and size > 0 and unit in ('ml', 'g', 'pcs') then round(price / size, 8) end u from lst)"


def unit_prices(spark, d):
    return listings(spark, d).withColumn("u", U.unit_price(F.col("price"), F.col("size"), F.col("unit").isin("ml", "g", "pcs")))


@query("i02_unit_price", f"{UNIT} select id, u as unit_price from up where u is not null")
def i02(spark, d):
    return unit_prices(spark, d).where("u is not null").select("id", F.col("u").alias("unit_price"))


@query(
    "i03_unit_tiers",
    f"""{UNIT}, a as (select *, count(*) over (partition by sub) ns, count(*) over (partition by grp) ng from up where u is not null), o as (select *, case when sub is not null and ns >= 30 then 'sub' else 'grp' end cohort_level, case when sub is not null and ns >= 30 then 'sub:' || sub else concat_ws(':', 'grp', grp) end cohort from a),
m as (select concat_ws(':', 'sub', sub) cohort, u, size from up where u is not null union all select concat_ws(':', 'grp', grp), u, size from up where u is not null), md as (select cohort, median(size) * 0.25 line from m where cohort in (select cohort from o) group by 1),
mm as (select cohort, u, coalesce(size < line, false) mini, sum((not coalesce(size < line, false))::int) over (partition by cohort) rest from m join md using (cohort)), us as (select cohort, u from mm where not mini or rest < 3), {_cuts("cohort", 3, "u", "us")}
select id, cohort_level, coalesce(size < line, false) as is_mini_size, case when coalesce(len(cuts), 0) = 0 then 2 else round_even(len(list_filter(cuts, lambda c: u > c)) * 2.0::double / len(cuts), 0)::int + 1 end as unit_tier from o left join cut using (cohort) left join md using (cohort)""",
)
def i03(spark, d):
    return U.unit_tiers(unit_prices(spark, d), ["sub", "grp"], "u", "size").select("id", "cohort_level", "is_mini_size", "unit_tier")


@query(
    "e31_group_ranges",
    f"""{UNIT}, t as (select *, id % 3 + 1 tier from up where u is not null and grp is not null), n as (select grp, tier, sum((unit = 'ml')::int) a, sum((unit = 'g')::int) b, sum((unit = 'pcs')::int) c, count(*) n from t group by all),
k as (select grp, tier, case when a >= .25 * n and b >= .25 * n then 'ml+g' when a >= b and a >= c then 'ml' when b >= c then 'g' else 'pcs' end uk from n)
select grp, tier, uk as unit_kind, count(*) as n, round(quantile_cont(u, .1), 6) as p10, round(quantile_cont(u, .5), 6) as p50, round(quantile_cont(u, .9), 6) as p90 from t join k using (grp, tier) where unit = uk or (uk = 'ml+g' and unit in ('ml', 'g')) group by all having count(*) >= 5""",
)
def e31(spark, d):
    return U.group_ranges(unit_prices(spark, d).where("grp is not null").withColumn("tier", F.col("id") % 3 + 1), ["grp", "tier"], "unit", "u")


@query("e37_subgroup_sizes", "select grp, sub, count(*) as n from lst group by all")
def e37(spark, d):
    return listings(spark, d).groupBy("grp", "sub").agg(F.count(F.lit(1)).alias("n"))


@query("e38_similarity_stats", "select trend, max(sim) as top, min(sim) as low, round(avg(sim), 9) as mean from lst group by 1")
def e38(spark, d):
    return r6(listings(spark, d).groupBy("trend").agg(F.max("sim").alias("top"), F.min("sim").alias("low"), F.avg("sim").alias("mean")), "mean", digits=9)


@query(
    "f19_sales_level",
    """, s as (select id, grp, sold, round(price) rv from lst where grp is not null), a as (select *, count(sold) over (partition by grp) n, (rank() over (partition by grp order by sold nulls last) + (count(*) over (partition by grp, sold) - 1) / 2.0::double) / nullif(count(sold) over (partition by grp), 0) dr from s),
per as (select grp, rv, count(sold) same from s where rv is not null group by all), m as (select grp, rv, (coalesce(sum(same) over (partition by grp order by rv rows between unbounded preceding and 1 preceding), 0) + same / 2.0::double) / nullif(sum(same) over (partition by grp), 0) mid from per)
select id, round(case when n >= 10 then case when sold is not null then dr else mid end end, 6) as sales_percentile, sold is null and n >= 10 and mid is not null as estimated from a left join m using (grp, rv)""",
)
def f19(spark, d):
    x = listings(spark, d).where("grp is not null").withColumn("rv", F.round("price"))
    return U.sales_level(x, ["grp"], "sold", "rv").select("id", "sales_percentile", "estimated")


POOL = f", pool as (select * from (select *, {RANKED} rk, count(*) over (partition by trend) n from lst) where rk <= greatest(1, round_even(n * 0.05::double, 0)))"


@query("k02_category_breakdown", f"{POOL}, g as (select trend, grp, count(*) n_pool, max(sim) best from pool where grp is not null group by all), r as (select *, row_number() over (partition by trend order by n_pool desc, best desc nulls last, grp) place from g), z as (select grp, count(distinct id) category_size from lst group by 1) select trend, grp, n_pool, best, place, category_size from r join z using (grp) where place <= 4 and n_pool >= 1")
def k02(spark, d):
    return U.category_breakdown(listings(spark, d), "trend", "grp", "sim", "id", 0.05, least=1)


@query("g03_category_order", f"{POOL} select trend, grp, count(*) as n_pool, row_number() over (partition by trend order by count(*) desc, max(sim) desc nulls last, grp) as place from pool where grp is not null group by trend, grp")
def g03(spark, d):
    return U.category_breakdown(listings(spark, d), "trend", "grp", "sim", "id", 0.05, 1000, 1).select("trend", "grp", "n_pool", "place")


FIT = f", b as (select * from lst where grp is not null and trend is not null), {_cuts('trend, grp', 3, 'price', 'b')}, fit as (select b.*, 1 + coalesce(len(list_filter(cuts, lambda c: price > c)), 0)::int tier from b left join cut on b.trend = cut.trend and b.grp = cut.grp where price is not null), fr as (select *, row_number() over (partition by trend, grp order by sim desc nulls last, id) category_rank, row_number() over (partition by trend, grp, tier order by sim desc nulls last, id) tier_rank, count(*) over (partition by trend, grp, tier) tier_size from fit)"


def _fit(spark, d):
    return U.category_fit(listings(spark, d).where("grp is not null and trend is not null"), "trend", "grp", "brand", "sim", "price", "id")


@query("k04_category_fit", f"{FIT} select trend, grp, tier, id, category_rank, tier_rank, tier_size from fr")
def k04(spark, d):
    return _fit(spark, d).select("trend", "grp", "tier", "id", "category_rank", "tier_rank", "tier_size")


@query("g02_top_per_tier", f"{FIT} select trend, grp, tier, id, tier_rank from fr where tier_rank <= 3")
def g02(spark, d):
    return _fit(spark, d).where("tier_rank <= 3").select("trend", "grp", "tier", "id", "tier_rank")


@query("k04_brand_best", f"{FIT}, o as (select *, row_number() over (partition by trend, grp, tier, brand order by tier_rank, category_rank) k from fr where brand is not null) select trend, grp, tier, brand, id, tier_rank, category_rank, tier_size from o where k = 1")
def k04b(spark, d):
    return U.brand_best(_fit(spark, d).where("brand is not null"), "trend", "grp", "brand")


@query("i30_fit_level", f"{FIT} select id, case when tier_rank <= greatest(1, trunc(tier_size * .01::double)) then 4 when tier_rank <= greatest(1, trunc(tier_size * .05::double)) then 3 when tier_rank <= greatest(1, trunc(tier_size * .2::double)) then 2 else 1 end as fit_level from fr")
def i30(spark, d):
    return _fit(spark, d).select("id", U.fit_level(F.col("tier_rank"), F.col("tier_size")).alias("fit_level"))


@query("i31_best_in_tier", f"{FIT}, o as (select *, row_number() over (partition by trend, grp order by tier_rank / tier_size::double, category_rank) k from fr) select trend, grp, id as best_id from o where k = 1")
def i31(spark, d):
    key = F.struct(F.col("tier_rank") / F.col("tier_size"), "category_rank")
    return _fit(spark, d).groupBy("trend", "grp").agg(F.min_by("id", key).alias("best_id"))


@query("k05_l2_ranks", "select t.trend_id as trend, l.id, row_number() over (partition by t.trend_id order by sim desc nulls last, l.id) as rank from lst l join trends t on l.trend = t.trend_id and l.grp = t.main_category")
def k05(spark, d):
    t = table(spark, d, "trends").select(F.col("trend_id").alias("trend"), F.col("main_category").alias("grp")).where("grp is not null")
    return U.rank_in(listings(spark, d).join(t, ["trend", "grp"]), ["trend"], "sim", "id").select("trend", "id", "rank")


@query("f33_l2_grid", ", r as (select l.*, row_number() over (partition by trend order by sim desc nulls last, id) rk, count(*) over (partition by trend) n from lst l), g as (select trend, id, rk, case when rk <= greatest(1, trunc(n * .01::double)) then 4 when rk <= greatest(1, trunc(n * .05::double)) then 3 when rk <= greatest(1, trunc(n * .2::double)) then 2 else 1 end lv from r) select trend, lv as level, count(*) as n, arg_min(id, rk) as first_id from g group by all")
def f33(spark, d):
    x = U.with_total(U.rank_in(listings(spark, d), ["trend"], "sim", "id"), ["trend"], "n")
    x = x.withColumn("level", U.fit_level(F.col("rank"), F.col("n")))
    return x.groupBy("trend", "level").agg(F.count(F.lit(1)).alias("n"), F.min_by("id", "rank").alias("first_id"))


@query("i28_category_agreement", f", r as (select l.trend, l.grp, t.main_category m, {RANKED.replace('trend order', 'l.trend order')} k from lst l join trends t on l.trend = t.trend_id), c as (select trend, coalesce(sum((grp = m)::int), 0)::bigint n from r where k <= 5 group by 1) select trend, n as n_close, n < 2 as no_close_product from c")
def i28(spark, d):
    t = table(spark, d, "trends").select(F.col("trend_id").alias("trend"), F.col("main_category").alias("main"))
    x = U.rank_in(listings(spark, d), ["trend"], "sim", "id").join(t, "trend")
    return U.category_agreement(x, "trend", "grp", "main")


@query("i29_main_category", f"{POOL}, c as (select trend, grp, count(*) n from pool where grp is not null group by all), o as (select *, row_number() over (partition by trend order by n desc, grp) k from c) select trend, grp, n from o where k = 1")
def i29(spark, d):
    return U.main_category(U.pool_of(listings(spark, d), "trend", "sim", "id", 0.05), "trend", "grp")


@query("e32_overall_level", f"{FIT}, lv as (select grp, case when tier_rank <= greatest(1, trunc(tier_size * .01::double)) then 4 when tier_rank <= greatest(1, trunc(tier_size * .05::double)) then 3 when tier_rank <= greatest(1, trunc(tier_size * .2::double)) then 2 else 1 end level from fr), c as (select grp, level, count(*) n from lv group by all), r as (select *, sum(n) over (partition by grp order by level desc) r, sum(n) over (partition by grp) t from c) select grp, max(level) as overall_level from r where r * 2 > t group by 1")
def e32(spark, d):
    c = _fit(spark, d).select("grp", U.fit_level(F.col("tier_rank"), F.col("tier_size")).alias("level")).groupBy("grp", "level").agg(F.count(F.lit(1)).alias("n"))
    return U.overall_level(c, "grp", "level", "n")


@query("e30_portfolio", ", c as (select brand, grp, count(*) n from lst where brand is not null and grp is not null group by all), t as (select brand, list(grp order by n desc, grp)[1:4] top_groups from c group by 1), p as (select brand, count(*) n_products, min(price) low, median(price) mid, max(price) high from lst where brand is not null group by 1) select brand, n_products, low, mid, high, array_to_string(top_groups, ' | ') as top_groups from p left join t using (brand)")
def e30(spark, d):
    x = listings(spark, d).where("brand is not null")
    c = x.where("grp is not null").groupBy("brand", "grp").agg(F.count(F.lit(1)).alias("n"))
    c = c.withColumn("k", F.row_number().over(Window.partitionBy("brand").orderBy(F.col("n").desc(), "grp"))).where("k <= 4")
    t = c.groupBy("brand").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "grp"))), lambda s: s["grp"]), " | ").alias("top_groups"))
    p = x.groupBy("brand").agg(F.count(F.lit(1)).alias("n_products"), F.min("price").alias("low"), F.median("price").alias("mid"), F.max("price").alias("high"))
    return p.join(t, "brand", "left")


@query("d17_compare_runs", f", o as (select trend, id, {RANKED} k from lst where scored < timestamp '2026-01-01'), n as (select trend, id, {RANKED} k from lst), j as (select coalesce(a.trend, b.trend) trend, a.id x, b.id y from (select * from o where k <= 10) a full join (select * from n where k <= 10) b on a.trend is not distinct from b.trend and a.id = b.id) select trend, count(x) as n_old, count(y) as n_new, count(*) filter (x is not null and y is not null) as kept, count(y) - count(*) filter (x is not null and y is not null) as entered from j where trend is not null group by 1")
def d17(spark, d):
    x = listings(spark, d).where("trend is not null")
    old = U.rank_in(x.where("scored < timestamp_ntz'2026-01-01 00:00:00'"), ["trend"], "sim", "id")
    return U.compare_runs(old, U.rank_in(x, ["trend"], "sim", "id"), "trend", "id")


@query("h03_intersect_topk", f", o as (select trend, id, {RANKED} k from lst where trend is not null), c as (select trend, id, row_number() over (partition by trend order by price nulls last, id) k from lst where trend is not null) select a.trend, count(*) as n_both from o a join c b on a.trend = b.trend and a.id = b.id where a.k <= 20 and b.k <= 20 group by 1")
def h03(spark, d):
    x = listings(spark, d).where("trend is not null")
    a = U.top_per_group(x, ["trend"], "sim", "id", 20).select("trend", "id")
    b = x.withColumn("k", F.row_number().over(Window.partitionBy("trend").orderBy(F.col("price").asc_nulls_last(), "id"))).where("k <= 20").select("trend", "id")
    return a.intersect(b).groupBy("trend").agg(F.count(F.lit(1)).alias("n_both"))


@query("d08_vector_topk", "with q as (select vec_id query, embedding qv from embeddings where vec_id % 100 = 0), s as (select query, vec_id item, round(list_cosine_similarity(embedding::double[], qv::double[]), 6) similarity from embeddings, q) select query, item, similarity, row_number() over (partition by query order by similarity desc, item) as rank from s qualify rank <= 10")
def d08(spark, d):
    e = table(spark, d, "embeddings")
    q = e.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query"), F.col("embedding").alias("qv"))
    return U.nearest(q, e.select(F.col("vec_id").alias("item"), F.col("embedding").alias("iv")), 10)


@query("j09_cosine", "with a as (select vec_id, embedding::double[] e, lead(embedding::double[]) over (order by vec_id) f from embeddings) select vec_id, round(list_cosine_similarity(e, f), 6) as similarity from a where f is not null")
def j09(spark, d):
    e = table(spark, d, "embeddings")
    n = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("f"))
    return e.join(n, "vec_id").select("vec_id", F.round(U.cosine(F.col("embedding"), F.col("f")), 6).alias("similarity"))


@query("k06_brand_coverage", f", r as (select *, {RANKED} rk from lst) select trend, brand, count(*) as n_products, max(sim) as best_similarity, min(rk) as best_rank, count(*) filter (rk <= 5) as in_top5 from r where brand is not null and trend is not null group by all")
def k06(spark, d):
    x = U.rank_in(listings(spark, d), ["trend"], "sim", "id").where("brand is not null and trend is not null")
    return x.groupBy("trend", "brand").agg(F.count(F.lit(1)).alias("n_products"), F.max("sim").alias("best_similarity"), F.min("rank").alias("best_rank"), F.count(F.when(F.col("rank") <= 5, 1)).alias("in_top5"))


@query("l09_supply_ranking", "select trend, max(sim) as top, row_number() over (order by max(sim) desc nulls last, trend) as place from lst where trend is not null group by trend")
def l09(spark, d):
    g = listings(spark, d).where("trend is not null").groupBy("trend").agg(F.max("sim").alias("top"))
    return g.withColumn("place", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.col("top").desc_nulls_last(), "trend")))


@query("l26_tier_records", "select distinct listing_id, case when isnan(similarity) then null else similarity end as similarity, unit_tier::int as unit_tier from validate_at_scale_nvidia")
def l26(spark, d):
    return table(spark, d, "validate_at_scale_nvidia").select("listing_id", F.when(~F.isnan("similarity"), F.col("similarity")).alias("similarity"), F.col("unit_tier").cast("int")).distinct()


SQL["l26_tier_records"] = "select distinct listing_id, case when isnan(similarity) then null else similarity end as similarity, unit_tier::int as unit_tier from validate_at_scale_nvidia"
