"""Operator-level registered queries: one small query per
projection / filter / join / aggregate / window / scalar-function row, each
over the whole bound tables, each with its DuckDB oracle right beside it.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from staylens.checks import oracle_queries as oq
from staylens.checks.oracle_sql import exact_avg_sql, pct_sql, ratio_sql, round_avg_money_sql, round_ratio_sql, with_layers
from staylens.functions.expressions import (
    active_available,
    active_booked,
    active_flagged,
    concat_key,
    decode_flag,
    is_true,
    md5_key,
    month_of,
    normalize_text,
    pct_change,
    revenue,
    safe_ratio,
    stays,
    year_of,
)
from staylens.operators import aggregates as A
from staylens.operators import distinct as D
from staylens.operators.joins import (
    full_outer_small_right,
    join_concat_key,
    left_join_normalized,
    left_join_null_safe,
    scalar_of,
    semi_join_in,
)
from staylens.operators.ranking import lag_over, latest_per_key, top_bottom_n, top_k, with_dense_ranks
from staylens.plans import adhoc, marts, silver
from staylens.plans.registry import register, warehouse as model
from staylens.sources import bindings
from staylens.sources.tables import read_table, wall_clock

ORACLE = oq.ORACLE
REV = "(30 - availability_30) * price"


def _sql(name: str, body: str) -> None:
    ORACLE[name] = with_layers(body)


def _exact(c):
    """A DOUBLE from a double-valued average, rounded to 6 places through
    DECIMAL so last-bit summation-order noise cannot leak into results."""
    return F.round(c.cast("decimal(38,10)"), 6).cast("double")


def _exact_sql(expr: str) -> str:
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(38,10)), 6) AS DOUBLE)"


# --- 2.3 projections and filters -------------------------------------------
@register("measure_revenue")
def _measure_revenue(spark, sf_dir):
    """Stays, revenue and annualised revenue per snapshot (exact decimal)."""
    f = model(spark, sf_dir).fact
    return f.select(
        "listing_id", "scraped_date", stays().alias("number_of_stays"),
        revenue().alias("estimated_revenue"), (revenue() * F.lit(12)).alias("annual_estimated_revenue"),
    )


_sql("measure_revenue", f"""
SELECT CAST(listing_id AS BIGINT) AS listing_id, strftime(scraped_date, '%Y-%m-%d') AS scraped_date,
    CAST(30 - availability_30 AS BIGINT) AS number_of_stays, CAST({REV} AS DOUBLE) AS estimated_revenue,
    CAST({REV} * 12 AS DOUBLE) AS annual_estimated_revenue
FROM fact_pit""")


@register("filter_not_null")
def _filter_not_null(spark, sf_dir):
    """listings with a host and a review score, counted per year."""
    s = model(spark, sf_dir).listings
    kept = s.where(F.col("host_id").isNotNull() & F.col("review_scores_rating").isNotNull())
    return kept.groupBy(year_of("scraped_date").alias("year")).agg(F.count(F.lit(1)).alias("n_rows"))


_sql("filter_not_null", """
SELECT CAST(extract(year FROM scraped_date) AS BIGINT) AS year, CAST(COUNT(*) AS BIGINT) AS n_rows
FROM listings_clean WHERE host_id IS NOT NULL AND review_scores_rating IS NOT NULL GROUP BY 1""")


@register("filter_active")
def _filter_active(spark, sf_dir):
    """The three meanings of "active", counted per year."""
    f = model(spark, sf_dir).fact
    return f.groupBy(year_of("scraped_date").alias("year")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        A.count_if(active_available()).alias("n_available"),
        A.count_if(active_booked()).alias("n_booked"),
        A.count_if(active_flagged()).alias("n_flagged"),
    )


_sql("filter_active", """
SELECT CAST(extract(year FROM scraped_date) AS BIGINT) AS year, CAST(COUNT(*) AS BIGINT) AS n_rows,
    CAST(COUNT(CASE WHEN availability_30 > 0 THEN 1 END) AS BIGINT) AS n_available,
    CAST(COUNT(CASE WHEN availability_30 < 30 THEN 1 END) AS BIGINT) AS n_booked,
    CAST(COUNT(CASE WHEN has_availability = TRUE THEN 1 END) AS BIGINT) AS n_flagged
FROM fact_pit GROUP BY 1""")


@register("filter_flag")
def _filter_flag(spark, sf_dir):
    """F8: ``WHERE has_availability = TRUE`` (NULL is not true), per room type."""
    f = model(spark, sf_dir).fact
    return f.where(is_true("has_availability")).groupBy("room_type").agg(F.count(F.lit(1)).alias("n_rows"))


_sql("filter_flag", """
SELECT room_type, CAST(COUNT(*) AS BIGINT) AS n_rows FROM fact_pit WHERE has_availability = TRUE GROUP BY 1""")


@register("last_12_months")
def _last_12_months(spark, sf_dir):
    """Rows within 12 months of the global max date."""
    f = model(spark, sf_dir).fact
    return f.where(adhoc.last_months(f)).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("scraped_date").alias("first_date"),
        F.max("scraped_date").alias("last_date"),
    )


_sql("last_12_months", """
SELECT CAST(COUNT(*) AS BIGINT) AS n_rows, strftime(min(scraped_date), '%Y-%m-%d') AS first_date,
    strftime(max(scraped_date), '%Y-%m-%d') AS last_date
FROM fact_pit WHERE scraped_date >= (SELECT cut FROM max_date)""")


@register("semi_join_in")
def _semi_join_in(spark, sf_dir):
    """Rows whose host has exactly one listing (IN subquery), per LGA."""
    f = model(spark, sf_dir).fact
    single = f.groupBy("host_key").agg(F.countDistinct("listing_id").alias("n")).where(F.col("n") == 1)
    return semi_join_in(f, single, "host_key").groupBy("lga_code").agg(F.count(F.lit(1)).alias("n_rows"))


_sql("semi_join_in", """
SELECT lga_code, CAST(COUNT(*) AS BIGINT) AS n_rows FROM fact_pit
WHERE host_key IN (SELECT host_key FROM fact_pit GROUP BY host_key HAVING COUNT(DISTINCT listing_id) = 1)
GROUP BY 1""")


def _temporal(closed: bool):
    def fn(spark, sf_dir):
        m = model(spark, sf_dir)
        joined = marts.with_superhost_flag(m.fact, m.dm_host, m.as_of, closed)
        return joined.select("listing_id", "scraped_date", "host_key", "host_is_superhost")

    return fn


register("join_temporal_closed")(_temporal(True))
register("join_temporal_half_open")(_temporal(False))
for _k, _src in (("join_temporal_closed", "fact_pit_host_closed"), ("join_temporal_half_open", "fact_pit_host")):
    _sql(_k, f"""
SELECT CAST(listing_id AS BIGINT) AS listing_id, strftime(scraped_date, '%Y-%m-%d') AS scraped_date,
    host_key, host_is_superhost FROM {_src}""")


# --- 2.4 joins ----------------------------------------------------------------
@register("join_left_dims")
def _join_left_dims(spark, sf_dir):
    """Fact LEFT JOIN the LGA dimension on its code, rows per LGA name."""
    m = model(spark, sf_dir)
    j = m.fact.join(m.dm_lga.select("lga_code", "lga_name"), "lga_code", "left")
    return j.groupBy("lga_name").agg(F.count(F.lit(1)).alias("n_rows"))


_sql("join_left_dims", """
SELECT l.lga_name, CAST(COUNT(*) AS BIGINT) AS n_rows
FROM fact_pit f LEFT JOIN dm_lga l ON f.lga_code = l.lga_code GROUP BY 1""")


@register("join_left_normalized")
def _join_left_normalized(spark, sf_dir):
    """Listings LEFT JOIN suburbs on lower(trim()) of both names."""
    m = model(spark, sf_dir)
    j = left_join_normalized(m.listings, m.dm_suburb, "listing_neighbourhood", "suburb_name", ["suburb_key", "lga_code"])
    return j.groupBy("suburb_key", "lga_code").agg(F.count(F.lit(1)).alias("n_rows"))


_sql("join_left_normalized", """
SELECT s.suburb_key, s.lga_code, CAST(COUNT(*) AS BIGINT) AS n_rows
FROM listings_clean f LEFT JOIN dm_suburb s ON lower(trim(f.listing_neighbourhood)) = lower(trim(s.suburb_name))
GROUP BY 1, 2""")


def _per_lga_revenue(spark, sf_dir):
    f = model(spark, sf_dir).fact
    return f.where(active_booked()).groupBy("lga_code").agg(A.exact_avg(revenue()).alias("avg_revenue"))


_PER_LGA_SQL = f"""
, per_lga AS (
    SELECT lga_code, {exact_avg_sql(REV)} AS avg_revenue FROM fact_pit WHERE availability_30 < 30 GROUP BY lga_code
)"""


@register("join_concat_key")
def _join_concat_key(spark, sf_dir):
    """Per-LGA revenue LEFT JOIN census on 'LGA' || code."""
    m = model(spark, sf_dir)
    j = join_concat_key(_per_lga_revenue(spark, sf_dir), m.dm_census, "LGA", "lga_code", "lga_code", "left")
    return j.select("lga_code", "avg_revenue", "total_population")


_sql("join_concat_key", _PER_LGA_SQL + """
SELECT r.lga_code, r.avg_revenue, CAST(c.total_population AS BIGINT) AS total_population
FROM per_lga r LEFT JOIN dm_census c ON 'LGA' || r.lga_code = c.lga_code""")


@register("join_inner_concat")
def _join_inner_concat(spark, sf_dir):
    """Per-LGA revenue INNER JOIN census G02 on 'LGA' || code."""
    m = model(spark, sf_dir)
    j = join_concat_key(_per_lga_revenue(spark, sf_dir), m.dm_census_g02, "LGA", "lga_code", "lga_code", "inner")
    return j.select("lga_code", "avg_revenue", "median_age_persons")


_sql("join_inner_concat", _PER_LGA_SQL + """
SELECT r.lga_code, r.avg_revenue, CAST(c.median_age_persons AS DOUBLE) AS median_age_persons
FROM per_lga r INNER JOIN dm_census_g02 c ON 'LGA' || r.lga_code = c.lga_code""")


@register("join_full_outer")
def _join_full_outer(spark, sf_dir):
    """Distinct listing neighbourhoods FULL OUTER JOIN official suburbs,
    coalesced name (planned as broadcastable left join + unmatched rows)."""
    m = model(spark, sf_dir)
    neigh = m.listings.select(normalize_text("listing_neighbourhood").alias("listing_neighbourhood")).distinct()
    official = silver.official_suburbs(m.bronze["lga_suburb"], m.bronze["lga_code"])
    j = full_outer_small_right(neigh, official, "listing_neighbourhood", "suburb_name")
    return j.select(
        F.coalesce("listing_neighbourhood", "suburb_name").alias("name"), "listing_neighbourhood", "suburb_name", "lga_code"
    )


_sql("join_full_outer", """
SELECT name, CASE WHEN used THEN name END AS listing_neighbourhood, suburb AS suburb_name, home.code AS lga_code
FROM (SELECT name, used, suburb, unnest(areas) AS home FROM place_names)""")


# --- 2.5 aggregations -----------------------------------------------------------
def _by_lga(name: str, doc: str, spark_aggs, sql_aggs: str):
    def fn(spark, sf_dir):
        return model(spark, sf_dir).fact.groupBy("lga_code").agg(*spark_aggs())

    fn.__doc__ = doc
    register(name)(fn)
    _sql(name, f"SELECT lga_code, {sql_aggs} FROM fact_pit GROUP BY lga_code")


_by_lga("agg_count", "A1: COUNT(*) per LGA.", lambda: [F.count(F.lit(1)).alias("n_rows")],
        "CAST(COUNT(*) AS BIGINT) AS n_rows")
_by_lga("agg_count_col", "A2: COUNT(review score), NULLs skipped, per LGA.",
        lambda: [F.count("review_scores_rating").alias("n_rated")],
        "CAST(COUNT(review_scores_rating) AS BIGINT) AS n_rated")
_by_lga("agg_count_if", "A3: conditional COUNT per LGA.", lambda: [A.count_if(active_available()).alias("active_listings")],
        "CAST(COUNT(CASE WHEN availability_30 > 0 THEN 1 END) AS BIGINT) AS active_listings")
_by_lga("agg_count_distinct", "A4: COUNT(DISTINCT host) per LGA.", lambda: [F.countDistinct("host_key").alias("distinct_hosts")],
        "CAST(COUNT(DISTINCT host_key) AS BIGINT) AS distinct_hosts")
_by_lga(
    "agg_sum_if", "A6: conditional SUMs (stays, revenue) per LGA.",
    lambda: [A.sum_if(active_available(), stays()).alias("total_stays"),
             A.sum_if(active_available(), revenue()).alias("total_estimated_revenue")],
    f"CAST(SUM(CASE WHEN availability_30 > 0 THEN 30 - availability_30 END) AS BIGINT) AS total_stays, "
    f"CAST(SUM(CASE WHEN availability_30 > 0 THEN {REV} END) AS DOUBLE) AS total_estimated_revenue",
)
_by_lga(
    "agg_avg_if", "A7: conditional AVGs (price, review score) per LGA, exact.",
    lambda: [A.exact_avg(F.when(active_available(), F.col("price"))).alias("avg_price"),
             A.exact_avg(F.when(active_available(), F.col("review_scores_rating"))).alias("avg_review_score")],
    f"{exact_avg_sql('CASE WHEN availability_30 > 0 THEN price END')} AS avg_price, "
    f"{exact_avg_sql('CASE WHEN availability_30 > 0 THEN review_scores_rating END')} AS avg_review_score",
)
_by_lga(
    "agg_min_max_if", "A8: conditional MIN / MAX price per LGA.",
    lambda: [A.min_if(active_available(), "price").alias("min_price"), A.max_if(active_available(), "price").alias("max_price")],
    "CAST(MIN(CASE WHEN availability_30 > 0 THEN price END) AS DOUBLE) AS min_price, "
    "CAST(MAX(CASE WHEN availability_30 > 0 THEN price END) AS DOUBLE) AS max_price",
)
_by_lga(
    "agg_string_distinct", "A12: STRING_AGG(DISTINCT room type, ', ') per LGA, sorted.",
    lambda: [A.string_agg_distinct("room_type").alias("room_types")],
    "CASE WHEN COUNT(room_type) > 0 THEN array_to_string(list_sort(list_distinct(list(room_type))), ', ') END AS room_types",
)
_by_lga(
    "agg_ratio", "A13: revenue per active listing, zero-guarded, per LGA.",
    lambda: [safe_ratio(A.sum_if(active_available(), revenue()), A.count_if(active_available())).alias("revenue_per_active")],
    ratio_sql(f"SUM(CASE WHEN availability_30 > 0 THEN {REV} END)", "COUNT(CASE WHEN availability_30 > 0 THEN 1 END)")
    + " AS revenue_per_active",
)
_by_lga(
    "agg_share", "A19: percent of active snapshots per LGA, rounded to 2 (exact).",
    lambda: [A.round_ratio(A.count_if(active_available()), F.count(F.lit(1))).alias("pct_active")],
    round_ratio_sql("COUNT(CASE WHEN availability_30 > 0 THEN 1 END)", "COUNT(*)") + " AS pct_active",
)
_by_lga(
    "fn_round", "X11: ROUND(AVG(price), 2) per LGA, half away from zero, exact.",
    lambda: [A.round_avg("price", 2).alias("avg_price_2dp")],
    round_avg_money_sql("price") + " AS avg_price_2dp",
)


def _host_sets(spark, sf_dir, *keys):
    """Bitmaps of the hosts, and of the superhosts with free nights, per LGA and period."""
    fact = model(spark, sf_dir).fact.withColumn("year", year_of("scraped_date")).withColumn("month", month_of("scraped_date"))
    numbers = D.dense_numbers(fact, "host_id", "host_number")
    rows = fact.select("lga_code", "year", "month", "host_id", "availability_30", "host_is_superhost").join(numbers, "host_id", "left")
    sets = {"distinct_hosts": None, "superhost_hosts": active_available() & is_true("host_is_superhost")}
    return D.distinct_bitmaps(rows, keys, "host_number", sets), list(sets)


@register("agg_multi_distinct")
def _agg_multi_distinct(spark, sf_dir):
    """A5: two COUNT(DISTINCT)s, one conditional, in one group (bitmaps over
    dense host numbers: no Expand)."""
    bitmaps, names = _host_sets(spark, sf_dir, "lga_code", "year")
    return D.count_bitmaps(bitmaps, ["lga_code", "year"], names)


_sql("agg_multi_distinct", """
SELECT lga_code, CAST(extract(year FROM scraped_date) AS BIGINT) AS year,
    CAST(COUNT(DISTINCT host_key) AS BIGINT) AS distinct_hosts,
    CAST(COUNT(DISTINCT CASE WHEN availability_30 > 0 AND host_is_superhost THEN host_key END) AS BIGINT) AS superhost_hosts
FROM fact_pit_host GROUP BY 1, 2""")


@register("agg_distinct_rollup")
def _agg_distinct_rollup(spark, sf_dir):
    """A4/A5 rolled up: the months' host sets merged to years and to the whole
    period (year NULL), exactly, without another look at the rows."""
    months, names = _host_sets(spark, sf_dir, "lga_code", "year", "month")
    years = D.merge_bitmaps(months, ["lga_code", "year"], names)
    whole = D.merge_bitmaps(years, ["lga_code"], names)
    total = D.count_bitmaps(whole, ["lga_code"], names).withColumn("year", F.lit(None).cast("int"))
    return D.count_bitmaps(years, ["lga_code", "year"], names).unionByName(total)


_sql("agg_distinct_rollup", """
SELECT lga_code, CAST(extract(year FROM scraped_date) AS BIGINT) AS year,
    CAST(COUNT(DISTINCT host_key) AS BIGINT) AS distinct_hosts,
    CAST(COUNT(DISTINCT host_key) FILTER (availability_30 > 0 AND host_is_superhost) AS BIGINT) AS superhost_hosts
FROM fact_pit_host GROUP BY GROUPING SETS ((1, 2), (1))""")


@register("agg_median")
def _agg_median(spark, sf_dir):
    """A10: exact median of active prices per LGA and year."""
    f = model(spark, sf_dir).fact
    rows = f.where(active_available()).select("lga_code", year_of("scraped_date").alias("year"), "price")
    groups = f.select("lga_code", year_of("scraped_date").alias("year")).distinct()
    # groups without an active price keep a NULL median, as the aggregate does
    return left_join_null_safe(groups, A.median_by(rows, ["lga_code", "year"], "price", "median_price"),
                               ["lga_code", "year"])


_sql("agg_median", """
SELECT lga_code, CAST(extract(year FROM scraped_date) AS BIGINT) AS year,
    quantile_cont(CASE WHEN availability_30 > 0 THEN CAST(price AS DOUBLE) END, 0.5) AS median_price
FROM fact_pit GROUP BY 1, 2""")


@register("agg_corr")
def _agg_corr(spark, sf_dir):
    """Pearson correlation of reviews and availability per room type,
    rounded to 3 (NULL when undefined)."""
    f = model(spark, sf_dir).fact
    r = A.corr_safe("number_of_reviews", "availability_30")
    return f.groupBy("room_type").agg(F.round(r.cast("decimal(38,10)"), 3).cast("double").alias("correlation"))


_sql("agg_corr", """
SELECT room_type, CAST(ROUND(CAST(corr(CAST(number_of_reviews AS DOUBLE), CAST(availability_30 AS DOUBLE))
    AS DECIMAL(38,10)), 3) AS DOUBLE) AS correlation
FROM fact_pit GROUP BY 1""")


@register("agg_two_level")
def _agg_two_level(spark, sf_dir):
    """Per LGA, the average over hosts of each host's average revenue."""
    f = model(spark, sf_dir).fact
    per_host = f.where(active_booked()).groupBy("lga_code", "host_key").agg(A.exact_avg(revenue()).alias("r"))
    return per_host.groupBy("lga_code").agg(_exact(F.avg("r")).alias("avg_revenue_per_host"))


_sql("agg_two_level", f"""
, per_host AS (
    SELECT lga_code, host_key, {exact_avg_sql(REV)} AS r FROM fact_pit WHERE availability_30 < 30 GROUP BY 1, 2
)
SELECT lga_code, {_exact_sql("AVG(r)")} AS avg_revenue_per_host FROM per_host GROUP BY 1""")


@register("agg_having")
def _agg_having(spark, sf_dir):
    """Hosts with more than one available snapshot (HAVING)."""
    f = model(spark, sf_dir).fact
    return (
        f.where(active_flagged() & F.col("host_key").isNotNull())
        .groupBy("host_key")
        .agg(F.count("listing_id").alias("total_listings"), F.countDistinct("lga_code").alias("num_lgas"))
        .where(F.col("total_listings") > 1)
    )


_sql("agg_having", """
SELECT host_key, CAST(COUNT(listing_id) AS BIGINT) AS total_listings, CAST(COUNT(DISTINCT lga_code) AS BIGINT) AS num_lgas
FROM fact_pit WHERE has_availability = TRUE AND host_key IS NOT NULL GROUP BY 1 HAVING COUNT(listing_id) > 1""")


@register("distinct_rows")
def _distinct_rows(spark, sf_dir):
    """SELECT DISTINCT property type, room type, capacity."""
    return model(spark, sf_dir).listings.select("property_type", "room_type", "accommodates").distinct()


_sql("distinct_rows", """
SELECT DISTINCT property_type, room_type, CAST(accommodates AS BIGINT) AS accommodates FROM listings_clean""")


# --- 2.6 windows, sorts, limits -----------------------------------------------
@register("win_dense_rank")
def _win_dense_rank(spark, sf_dir):
    """Twin DENSE_RANKs of per-LGA revenue (one row per LGA)."""
    return with_dense_ranks(_per_lga_revenue(spark, sf_dir), "avg_revenue").select(
        "lga_code", "avg_revenue", "rank_top", "rank_bottom"
    )


_sql("win_dense_rank", _PER_LGA_SQL + """
SELECT lga_code, avg_revenue,
    CAST(DENSE_RANK() OVER (ORDER BY avg_revenue DESC NULLS FIRST) AS BIGINT) AS rank_top,
    CAST(DENSE_RANK() OVER (ORDER BY avg_revenue ASC NULLS LAST) AS BIGINT) AS rank_bottom
FROM per_lga""")


@register("top_bottom_n")
def _top_bottom_n(spark, sf_dir):
    """Top-3 / bottom-3 LGAs by revenue, labelled."""
    return top_bottom_n(_per_lga_revenue(spark, sf_dir), "avg_revenue", 3)


_sql("top_bottom_n", _PER_LGA_SQL + """
, ranked AS (
    SELECT *, DENSE_RANK() OVER (ORDER BY avg_revenue DESC NULLS FIRST) AS t,
        DENSE_RANK() OVER (ORDER BY avg_revenue ASC NULLS LAST) AS b FROM per_lga
)
SELECT lga_code, avg_revenue, CASE WHEN t <= 3 THEN 'Top 3' WHEN b <= 3 THEN 'Bottom 3' END AS performance_group
FROM ranked WHERE t <= 3 OR b <= 3""")


def _monthly_counts(spark, sf_dir):
    f = model(spark, sf_dir).fact
    g = F.coalesce(F.col("lga_key"), F.lit("Unknown")).alias("lga")
    return f.groupBy(g, year_of("scraped_date").alias("year"), month_of("scraped_date").alias("month")).agg(
        F.count(F.lit(1)).alias("total_listings"), A.count_if(active_available()).alias("active_listings")
    )


_MONTHLY_SQL = """
, m AS (
    SELECT COALESCE(lga_key, 'Unknown') AS lga, extract(year FROM scraped_date) AS year,
        extract(month FROM scraped_date) AS month, COUNT(*) AS total_listings,
        COUNT(CASE WHEN availability_30 > 0 THEN 1 END) AS active_listings
    FROM fact_pit GROUP BY 1, 2, 3
)"""
_W = "OVER (PARTITION BY lga ORDER BY year, month)"


@register("win_lag")
def _win_lag(spark, sf_dir):
    """Previous month's active count per LGA (previous row)."""
    m = _monthly_counts(spark, sf_dir)
    return m.select("lga", "year", "month", "active_listings",
                    lag_over("active_listings", ["lga"], ["year", "month"]).alias("prev_active"))


_sql("win_lag", _MONTHLY_SQL + f"""
SELECT lga, CAST(year AS BIGINT) AS year, CAST(month AS BIGINT) AS month,
    CAST(active_listings AS BIGINT) AS active_listings, CAST(LAG(active_listings) {_W} AS BIGINT) AS prev_active
FROM m""")


@register("win_lag_expr")
def _win_lag_expr(spark, sf_dir):
    """LAG of an expression (inactive = total - active)."""
    m = _monthly_counts(spark, sf_dir)
    inactive = F.col("total_listings") - F.col("active_listings")
    return m.select("lga", "year", "month", inactive.alias("inactive"),
                    lag_over(inactive, ["lga"], ["year", "month"]).alias("prev_inactive"))


_sql("win_lag_expr", _MONTHLY_SQL + f"""
SELECT lga, CAST(year AS BIGINT) AS year, CAST(month AS BIGINT) AS month,
    CAST(total_listings - active_listings AS BIGINT) AS inactive,
    CAST(LAG(total_listings - active_listings) {_W} AS BIGINT) AS prev_inactive
FROM m""")


@register("win_pct_change")
def _win_pct_change(spark, sf_dir):
    """Percent change of active listings vs the previous row, zero-guarded."""
    m = _monthly_counts(spark, sf_dir)
    prev = lag_over("active_listings", ["lga"], ["year", "month"])
    return m.select("lga", "year", "month", pct_change(F.col("active_listings"), prev).alias("pct_change_active"))


_sql("win_pct_change", _MONTHLY_SQL + f"""
SELECT lga, CAST(year AS BIGINT) AS year, CAST(month AS BIGINT) AS month,
    {pct_sql(f"(active_listings - LAG(active_listings) {_W})", f"LAG(active_listings) {_W}")} AS pct_change_active
FROM m""")


@register("latest_per_key")
def _latest_per_key(spark, sf_dir):
    """The latest snapshot of every listing (DISTINCT ON)."""
    f = model(spark, sf_dir).fact
    latest = latest_per_key(f, ["listing_id"], [F.col("scraped_date").desc_nulls_last()])
    return latest.select("listing_id", "scraped_date", "price", "availability_30")


_sql("latest_per_key", """
SELECT CAST(listing_id AS BIGINT) AS listing_id, strftime(scraped_date, '%Y-%m-%d') AS scraped_date,
    CAST(price AS DOUBLE) AS price, CAST(availability_30 AS BIGINT) AS availability_30
FROM fact_pit QUALIFY row_number() OVER (PARTITION BY listing_id ORDER BY scraped_date DESC NULLS LAST) = 1""")


@register("best_per_group")
def _best_per_group(spark, sf_dir):
    """Per neighbourhood, the property mix with the most stays on the
    latest snapshots (every neighbourhood)."""
    m = model(spark, sf_dir)
    latest = latest_per_key(m.fact, ["listing_id"], [F.col("scraped_date").desc_nulls_last()])
    by_prop = latest.groupBy("suburb_key", "property_type", "room_type", "accommodates").agg(
        F.sum(stays()).cast("long").alias("total_stays")
    )
    order = [F.col("total_stays").desc_nulls_first(), F.col("property_type").asc_nulls_last(),
             F.col("room_type").asc_nulls_last(), F.col("accommodates").asc_nulls_last()]
    return latest_per_key(by_prop, ["suburb_key"], order)


_sql("best_per_group", """
, latest AS (
    SELECT * FROM fact_pit QUALIFY row_number() OVER (PARTITION BY listing_id ORDER BY scraped_date DESC NULLS LAST) = 1
), bp AS (
    SELECT suburb_key, property_type, room_type, accommodates, SUM(30 - availability_30) AS total_stays
    FROM latest GROUP BY 1, 2, 3, 4
)
SELECT suburb_key, property_type, room_type, CAST(accommodates AS BIGINT) AS accommodates,
    CAST(total_stays AS BIGINT) AS total_stays
FROM bp QUALIFY row_number() OVER (PARTITION BY suburb_key ORDER BY total_stays DESC NULLS FIRST,
    property_type ASC NULLS LAST, room_type ASC NULLS LAST, accommodates ASC NULLS LAST) = 1""")


@register("sort_multi")
def _sort_multi(spark, sf_dir):
    """O1: multi-key, mixed-direction presentation sort of a mart."""
    mart = model(spark, sf_dir).mart_host_neighbourhood()
    return mart.orderBy(F.col("host_neighbourhood_lga").desc_nulls_first(), F.col("year").asc(), F.col("month").asc())


ORACLE["sort_multi"] = ORACLE["mart_host_neighbourhood"]


@register("top_k")
def _top_k(spark, sf_dir):
    """O2: the 5 neighbourhoods with the highest mean revenue per booked
    listing (ties broken by name)."""
    f = model(spark, sf_dir).fact
    per = f.where(active_booked()).groupBy("suburb_key").agg(A.exact_avg(revenue()).alias("avg_revenue"))
    return top_k(per, [F.col("avg_revenue").desc_nulls_first(), F.col("suburb_key").asc_nulls_last()], 5)


_sql("top_k", f"""
SELECT suburb_key, {exact_avg_sql(REV)} AS avg_revenue FROM fact_pit WHERE availability_30 < 30
GROUP BY 1 ORDER BY avg_revenue DESC NULLS FIRST, suburb_key ASC NULLS LAST LIMIT 5""")


# --- 2.8 scalar functions -------------------------------------------------------
@register("fn_normalize_text")
def _fn_normalize_text(spark, sf_dir):
    """lower(trim()) of each raw neighbourhood spelling."""
    s = model(spark, sf_dir).listings
    return s.groupBy("listing_neighbourhood").agg(
        F.first(normalize_text("listing_neighbourhood")).alias("normalized"), F.count(F.lit(1)).alias("n_rows")
    )


_sql("fn_normalize_text", """
SELECT listing_neighbourhood, lower(trim(listing_neighbourhood)) AS normalized, CAST(COUNT(*) AS BIGINT) AS n_rows
FROM listings_clean GROUP BY 1""")


@register("fn_md5_key")
def _fn_md5_key(spark, sf_dir):
    """md5 surrogate key of every host id."""
    s = model(spark, sf_dir).listings
    return s.select("host_id").distinct().select("host_id", md5_key("host_id").alias("host_key"))


_sql("fn_md5_key", """
SELECT CAST(host_id AS BIGINT) AS host_id, md5(CAST(host_id AS VARCHAR)) AS host_key
FROM (SELECT DISTINCT host_id FROM listings_clean)""")


@register("fn_coalesce")
def _fn_coalesce(spark, sf_dir):
    """COALESCE(lga_key, 'Unknown') as a grouping value."""
    f = model(spark, sf_dir).fact
    return f.groupBy(F.coalesce(F.col("lga_key"), F.lit("Unknown")).alias("lga")).agg(F.count(F.lit(1)).alias("n_rows"))


_sql("fn_coalesce", """
SELECT COALESCE(lga_key, 'Unknown') AS lga, CAST(COUNT(*) AS BIGINT) AS n_rows FROM fact_pit GROUP BY 1""")


@register("fn_nullif")
def _fn_nullif(spark, sf_dir):
    """Price per free night, NULL where availability is 0 (x / nullif(y, 0))."""
    f = model(spark, sf_dir).fact
    return f.select("listing_id", "scraped_date", safe_ratio("price", "availability_30").alias("price_per_free_night"))


_sql("fn_nullif", f"""
SELECT CAST(listing_id AS BIGINT) AS listing_id, strftime(scraped_date, '%Y-%m-%d') AS scraped_date,
    {ratio_sql("price", "availability_30")} AS price_per_free_night FROM fact_pit""")


@register("fn_flag")
def _fn_flag(spark, sf_dir):
    """X7: 't' / 'f' / other -> TRUE / FALSE / NULL, per raw token."""
    raw = bindings.listings_raw(spark, sf_dir)
    return raw.groupBy("host_is_superhost").agg(
        F.first(decode_flag("host_is_superhost")).alias("decoded"), F.count(F.lit(1)).alias("n_rows")
    )


_sql("fn_flag", """
SELECT host_is_superhost, CASE WHEN host_is_superhost = 't' THEN TRUE WHEN host_is_superhost = 'f' THEN FALSE END AS decoded,
    CAST(COUNT(*) AS BIGINT) AS n_rows FROM listings_raw GROUP BY 1""")


@register("fn_case")
def _fn_case(spark, sf_dir):
    """Searched CASE with and without ELSE (availability band; the
    performance label leaves non-matching rows NULL)."""
    f = model(spark, sf_dir).fact
    band = F.when(F.col("availability_30") == 0, "full").when(F.col("availability_30") < 15, "busy").otherwise("quiet")
    label = F.when(F.col("availability_30") >= 30, "vacant")
    return f.groupBy(band.alias("band"), label.alias("label")).agg(F.count(F.lit(1)).alias("n_rows"))


_sql("fn_case", """
SELECT CASE WHEN availability_30 = 0 THEN 'full' WHEN availability_30 < 15 THEN 'busy' ELSE 'quiet' END AS band,
    CASE WHEN availability_30 >= 30 THEN 'vacant' END AS label, CAST(COUNT(*) AS BIGINT) AS n_rows
FROM fact_pit GROUP BY 1, 2""")


@register("fn_cast")
def _fn_cast(spark, sf_dir):
    """Text <-> number casts of the LGA code and the census key."""
    m = model(spark, sf_dir)
    codes = m.fact.select("lga_code").distinct()
    return codes.select(
        "lga_code", F.col("lga_code").cast("long").alias("code_number"), concat_key("LGA", "lga_code").alias("census_code")
    )


_sql("fn_cast", """
SELECT lga_code, CAST(lga_code AS BIGINT) AS code_number, 'LGA' || lga_code AS census_code
FROM (SELECT DISTINCT lga_code FROM fact_pit)""")


@register("fn_year_month")
def _fn_year_month(spark, sf_dir):
    """extract(year / month) as grouping keys."""
    f = model(spark, sf_dir).fact
    return f.groupBy(year_of("scraped_date").alias("year"), month_of("scraped_date").alias("month")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


_sql("fn_year_month", """
SELECT CAST(extract(year FROM scraped_date) AS BIGINT) AS year, CAST(extract(month FROM scraped_date) AS BIGINT) AS month,
    CAST(COUNT(*) AS BIGINT) AS n_rows FROM fact_pit GROUP BY 1, 2""")


# --- the generic operators on the denser events table (FIXTURES §2) -----------
def _events(spark, sf_dir):
    e = read_table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value")
    return e.withColumn("ts", wall_clock(e, "ts"))


@register("scd2_rebuild_events")
def _scd2_rebuild_events(spark, sf_dir):
    """S14 on events: each user's event-type history, versions keyed by the
    event time (the operator is generic over key, timestamp and attributes)."""
    from staylens.operators.scd2 import scd2_rebuild

    return scd2_rebuild(_events(spark, sf_dir), ["user_id"], "ts", ["event_type"])


_sql("scd2_rebuild_events", """
, v AS (SELECT DISTINCT user_id, event_type, ts FROM events WHERE user_id IS NOT NULL)
SELECT CAST(user_id AS BIGINT) AS user_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts,
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS valid_from,
    strftime(lead(ts) OVER (PARTITION BY user_id ORDER BY ts ASC NULLS FIRST, event_type ASC NULLS LAST),
             '%Y-%m-%d %H:%M:%S') AS valid_to
FROM v""")


@register("latest_per_key_events")
def _latest_per_key_events(spark, sf_dir):
    """W7 on events: each user's latest event (ties broken by event id)."""
    e = _events(spark, sf_dir)
    return latest_per_key(e, ["user_id"], [F.col("ts").desc_nulls_last(), F.col("event_id").desc_nulls_last()])


_sql("latest_per_key_events", """
SELECT CAST(event_id AS BIGINT) AS event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, CAST(user_id AS BIGINT) AS user_id,
    event_type, value
FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) = 1""")


@register("win_lag_events")
def _win_lag_events(spark, sf_dir):
    """W4/W5 on events: each event's previous event type and value per user."""
    e = _events(spark, sf_dir)
    order = [F.col("ts").asc_nulls_first(), F.col("event_id").asc_nulls_first()]
    from pyspark.sql import Window

    w = Window.partitionBy("user_id").orderBy(*order)
    return e.select(
        "event_id", "user_id", F.lag("event_type").over(w).alias("prev_event_type"),
        (F.col("value") - F.lag("value").over(w)).alias("value_change"),
    )


_sql("win_lag_events", """
SELECT CAST(event_id AS BIGINT) AS event_id, CAST(user_id AS BIGINT) AS user_id,
    LAG(event_type) OVER w AS prev_event_type, value - LAG(value) OVER w AS value_change
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts ASC NULLS FIRST, event_id ASC NULLS FIRST)""")


# --- data-quality checks (S9, Q24, SCD2 invariants) -----------------------------
@register("dq_unique_lga_code")
def _dq_unique_lga_code(spark, sf_dir):
    """LGA codes that occur more than once (the list's key) after a second
    delivery of the list, which repeats every third code, is appended."""
    from staylens.operators import quality

    codes = bindings.lga_code_raw(spark, sf_dir)
    again = codes.where(F.col("lga_code").cast("int") % 30 == 0)
    return quality.duplicate_keys(codes.unionByName(again), ["lga_code"])


_sql("dq_unique_lga_code", """
SELECT lga_code, CAST(COUNT(*) AS BIGINT) AS n_rows
FROM (SELECT lga_code FROM lga_code_raw UNION ALL SELECT lga_code FROM lga_code_raw WHERE CAST(lga_code AS INTEGER) % 30 = 0)
GROUP BY lga_code HAVING COUNT(*) > 1""")


@register("dq_suburb_many_lgas")
def _dq_suburb_many_lgas(spark, sf_dir):
    """Q24: official suburbs listed under more than one LGA (each would
    multiply the as-is fact), after a second delivery of the suburb list puts
    those whose name ends in 0 under the first LGA."""
    from staylens.operators import quality

    m = model(spark, sf_dir)
    listed, codes = m.bronze["lga_suburb"], m.bronze["lga_code"]
    first = scalar_of(codes.agg(F.min("lga_name")))
    again = listed.where(F.col("suburb_name").endswith("0")).select(first.alias("lga_name"), "suburb_name")
    official = silver.official_suburbs(listed.unionByName(again), codes)
    return quality.names_in_many_groups(official, "suburb_name", "lga_code")


_sql("dq_suburb_many_lgas", """
SELECT name AS suburb_name, CAST(len(list_distinct(codes)) AS BIGINT) AS n_groups
FROM (SELECT name, list_transform(areas, lambda x: x.code) || CASE WHEN suffix(name, '0') THEN [(SELECT min_by(lga_code, lga_name) FROM lga_code_raw)] ELSE [] END AS codes
      FROM place_names WHERE suburb IS NOT NULL)
WHERE len(list_distinct(codes)) > 1""")


@register("dq_scd2_invariants")
def _dq_scd2_invariants(spark, sf_dir):
    """SCD2 invariants of the host history: versions, hosts, open versions,
    hosts without exactly one open version, overlapping version pairs."""
    from staylens.operators import quality

    h = model(spark, sf_dir).host_snapshot
    summary = h.agg(
        F.count(F.lit(1)).alias("n_versions"),
        F.countDistinct("host_id").alias("n_hosts"),
        A.count_if(F.col("valid_to").isNull()).alias("n_open"),
    )
    bad_open = quality.open_version_violations(h, ["host_id"]).agg(F.count(F.lit(1)))
    overlaps = quality.interval_overlaps(h.where(F.col("valid_from").isNotNull()), ["host_id"]).agg(
        F.count(F.lit(1))
    )
    # the two violation counts are scalar subqueries next to the summary row
    return summary.select(
        "*", scalar_of(bad_open).alias("n_bad_open"), scalar_of(overlaps).alias("n_overlaps")
    )


_sql("dq_scd2_invariants", """
, o AS (
    SELECT host_id, valid_from, valid_to,
        lead(valid_from) OVER (PARTITION BY host_id ORDER BY valid_from ASC NULLS FIRST, valid_to ASC NULLS LAST) AS nf
    FROM host_snapshot WHERE valid_from IS NOT NULL
), b AS (
    SELECT host_id FROM host_snapshot GROUP BY host_id HAVING COUNT(CASE WHEN valid_to IS NULL THEN 1 END) <> 1
)
SELECT CAST((SELECT COUNT(*) FROM host_snapshot) AS BIGINT) AS n_versions,
    CAST((SELECT COUNT(DISTINCT host_id) FROM host_snapshot) AS BIGINT) AS n_hosts,
    CAST((SELECT COUNT(*) FROM host_snapshot WHERE valid_to IS NULL) AS BIGINT) AS n_open,
    CAST((SELECT COUNT(*) FROM b) AS BIGINT) AS n_bad_open,
    CAST((SELECT COUNT(*) FROM o WHERE nf IS NOT NULL AND (valid_to IS NULL OR valid_to > nf)) AS BIGINT) AS n_overlaps""")
