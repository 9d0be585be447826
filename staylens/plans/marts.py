"""Monthly marts.

The two listing marts share one measure set; only the grouping differs.
Each mart is: fact (which carries the point-in-time host flag) -> aggregation
to (group, year, month) -> LAG over the (small) monthly series of each group.

Scale notes: distinct-host counts come from a per-(group, month, host)
pre-aggregation (map-side combine collapses a hot host) instead of an
Expand; the exact median is selected over ranges of prices.  The LAG window runs on the aggregated output (one row per
group and month), never on fact rows.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.functions.expressions import (
    active_available,
    is_true,
    month_of,
    pct_change,
    percent,
    revenue,
    safe_ratio,
    stays,
    year_of,
)
from staylens.operators.aggregates import count_copies, count_if, exact_avg, median_by, sum_if, times
from staylens.operators.joins import left_join_null_safe
from staylens.operators.ranking import lag_over
from staylens.operators.temporal import temporal_left_join
from staylens.operators.scd2 import VALID_FROM
from staylens.plans.gold import COPIES, SUPERHOST, with_superhost_flag

# The open end of a host version is the run's date, as in the source system.
# Pass an ``as_of`` date for reproducible runs over old snapshots.
DEFAULT_AS_OF: _dt.date | None = None


def listing_measures(base: DataFrame, group_cols: Sequence[str], copies: str | None = None) -> DataFrame:
    """Shared measure set of the listing-neighbourhood and property-type marts,
    month by month: no measure needs another month's rows.

    Planned as three aggregations instead of one with two COUNT(DISTINCT)s
    and a percentile (Expand x3 of every row, a percentile buffer per
    expanded key, sort-based fallback):

    1. per (group, month): counts, sums and min/max — partial aggregation
       leaves a row per task and group to shuffle, whatever the fact's size;
    2. per (group, month, host): whether it is a superhost, and nothing else,
       rolled up to distinct hosts and superhosts;
    3. per (group, month): the exact median, on its own, by selection over
       ranges of prices (no task sees a hot group's prices);
    then joined on the group keys — each one row per group and month.

    With ``copies`` a row stands for that many; its reviews come as
    ``review_sum`` and ``n_reviews``.
    """
    keys = [*group_cols, "year", "month"]
    active = active_available("availability_30")
    price_a = F.when(active, F.col("price"))
    if copies is None:
        review, n_reviews = F.col("review_scores_rating"), F.when(F.col("review_scores_rating").isNotNull(), F.lit(1))
    else:
        review, n_reviews = F.col("review_sum"), F.col("n_reviews")
    totals = base.groupBy(*keys).agg(
        count_copies(F.lit(1), copies).alias("total_listings"),
        count_if(active, copies).alias("active_listings"),
        F.min(price_a).alias("min_price"),
        F.max(price_a).alias("max_price"),
        exact_avg(price_a, copies).alias("avg_price"),
        (
            sum_if(active, review).cast("double") / F.nullif(F.coalesce(sum_if(active, n_reviews), F.lit(0)), F.lit(0)).cast("double")
        ).alias("avg_review_score"),
        sum_if(active, times(stays(), copies)).alias("total_stays"),
        sum_if(active, times(revenue(), copies)).alias("total_estimated_revenue"),
    )
    # a host's id says the same as its md5 key, in a quarter of the bytes
    host = F.col("host_id" if "host_id" in base.columns else "host_key")
    if {"host_id", "host_key"} <= set(base.columns):
        host = F.when(F.col("host_key").isNotNull(), host)
    per_host = base.groupBy(*keys, host.alias("__host")).agg(F.max(active & is_true("host_is_superhost")).alias("super"))
    has_host = F.col("__host").isNotNull()
    hosts = per_host.groupBy(*keys).agg(
        F.count(F.when(has_host, F.lit(1))).alias("distinct_hosts"),
        F.count(F.when(has_host & F.col("super"), F.lit(1))).alias("superhost_hosts"),
    )
    prices = base.where(active).select(*keys, "price", *([copies] if copies else []))
    medians = median_by(prices, keys, "price", "median_price", copies, few_groups=True)
    return left_join_null_safe(left_join_null_safe(totals, hosts, keys), medians, keys)


def with_changes(agg: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    """The mart's columns out of ``listing_measures``: rates, and the changes
    against the group's month before."""
    inactive = F.col("total_listings") - F.col("active_listings")
    order = ["year", "month"]
    with_prev = agg.withColumn(
        "prev_active", lag_over("active_listings", group_cols, order)
    ).withColumn("prev_inactive", lag_over(inactive, group_cols, order))
    return with_prev.select(
        *group_cols,
        "year",
        "month",
        percent("active_listings", "total_listings").alias("active_listings_rate"),
        "min_price",
        "max_price",
        "median_price",
        "avg_price",
        "distinct_hosts",
        percent("superhost_hosts", "distinct_hosts").alias("superhost_rate"),
        "avg_review_score",
        "total_stays",
        pct_change("active_listings", "prev_active").alias("pct_change_active"),
        pct_change(inactive, "prev_inactive").alias("pct_change_inactive"),
        "total_estimated_revenue",
        safe_ratio("total_estimated_revenue", "active_listings").alias(
            "avg_estimated_revenue_per_listing"
        ),
    )


def monthly_listing_measures(base: DataFrame, group_cols: Sequence[str], copies: str | None = None) -> DataFrame:
    return with_changes(listing_measures(base, group_cols, copies), group_cols)


def _with_period(df: DataFrame) -> DataFrame:
    return df.withColumn("year", year_of("scraped_date")).withColumn("month", month_of("scraped_date"))


def by_listing_lga(df: DataFrame) -> DataFrame:
    return _with_period(df).withColumn("listing_neighbourhood_lga", F.coalesce(F.col("lga_key"), F.lit("Unknown")))


def mart_listing_neighbourhood(fact: DataFrame) -> DataFrame:
    """M18 on the point-in-time fact: per listing LGA (md5 key, 'Unknown' when
    unmapped) and month."""
    return monthly_listing_measures(by_listing_lga(fact), ["listing_neighbourhood_lga"])


def mart_listing_neighbourhood_closed(fact: DataFrame, host: DataFrame, as_of=DEFAULT_AS_OF) -> DataFrame:
    """M18 with the source's closed BETWEEN: a boundary date matches two
    versions, so the host history is joined here."""
    base = with_superhost_flag(fact, host, as_of, closed=True)
    return monthly_listing_measures(by_listing_lga(base), ["listing_neighbourhood_lga"])


def by_property(df: DataFrame) -> DataFrame:
    return (
        _with_period(df)
        .withColumn("property_type", F.coalesce(F.col("property_type"), F.lit("Unknown")))
        .withColumn("room_type", F.coalesce(F.col("room_type"), F.lit("Unknown")))
        .withColumn("accommodates", F.coalesce(F.col("accommodates"), F.lit(0)))
    )


def mart_property_type(fact: DataFrame) -> DataFrame:
    """M19 on the point-in-time fact: per property type x room type x
    capacity and month."""
    return monthly_listing_measures(by_property(fact), ["property_type", "room_type", "accommodates"])


def mart_host_neighbourhood(fact: DataFrame, copies: str | None = None) -> DataFrame:
    """M17 on the point-in-time fact: distinct hosts and revenue per listing
    LGA and month.  The source joins the host history here but reads no column
    from it; with non-overlapping versions that join cannot change a row, so
    it is omitted."""
    base = _with_period(fact).withColumn(
        "host_neighbourhood_lga", F.coalesce(F.col("lga_key"), F.lit("Unknown"))
    )
    agg = base.groupBy("host_neighbourhood_lga", "year", "month").agg(
        F.countDistinct("host_key").alias("distinct_hosts"),
        F.sum(times(revenue(), copies)).alias("total_estimated_revenue"),
    )
    return agg.withColumn(
        "estimated_revenue_per_host", safe_ratio("total_estimated_revenue", "distinct_hosts")
    )


#: M17 as the SQL of a catalog view over the written fact.
HOST_NEIGHBOURHOOD_SQL = """
SELECT coalesce(lga_key, 'Unknown') AS host_neighbourhood_lga, year(scraped_date) AS year, month(scraped_date) AS month,
    count(DISTINCT host_key) AS distinct_hosts,
    sum((30 - availability_30) * price) AS total_estimated_revenue,
    CAST(sum((30 - availability_30) * price) AS DOUBLE) / nullif(count(DISTINCT host_key), 0) AS estimated_revenue_per_host
FROM gold.fact_listings
GROUP BY coalesce(lga_key, 'Unknown'), year(scraped_date), month(scraped_date)"""


# --- verbatim ("as-is") variants --------------------------------------------
# The source's own mart joins on the as-is fact: every host version whose
# closed interval contains the date (joined on the shared host_key) and every
# property row of the listing (joined on property_key).  Each fan-out counts,
# so counts and sums are the source's, but as a number: no row is copied.  For
# parity checks; the point-in-time marts above are the defaults.


def _with_host_matches(fact: DataFrame, host: DataFrame, as_of) -> DataFrame:
    """The fact's copies times the host versions that hold on the date (one
    row stays where none does), and whether one of them is a superhost."""
    dates = fact.where("host_id is not null").select("host_id", "scraped_date").distinct()
    met = temporal_left_join(dates, host, "host_id", "host_id", "scraped_date", [SUPERHOST, VALID_FROM], as_of, closed=True)
    matches = met.groupBy("host_id", "scraped_date").agg(F.count(VALID_FROM).alias("__m"), F.max(SUPERHOST).alias(SUPERHOST))
    out = fact.join(matches, ["host_id", "scraped_date"], "left")
    return out.withColumn(COPIES, F.col(COPIES) * F.greatest(F.coalesce("__m", F.lit(1)), F.lit(1))).drop("__m")


#: What tells a listing's property rows apart in the as-is marts.
OFFER_COLUMNS = ["property_type", "room_type", "accommodates"]


def _with_property_rows(base: DataFrame, prop: DataFrame) -> DataFrame:
    """The copies times the listing's property rows, told apart by
    ``OFFER_COLUMNS``, with the sum and number of their review scores."""
    rows = prop.groupBy(F.col("listing_id").alias("__listing"), *OFFER_COLUMNS).agg(
        F.count(F.lit(1)).alias("__p"), F.sum("review_scores_rating").alias("__r"), F.count("review_scores_rating").alias("__nr")
    )
    out = base.join(rows, F.col("listing_id") == F.col("__listing"), "left")
    out = out.withColumn("review_sum", F.col("__r") * F.col(COPIES)).withColumn("n_reviews", F.col("__nr") * F.col(COPIES))
    return out.withColumn(COPIES, F.col(COPIES) * F.coalesce("__p", F.lit(1))).drop("__listing", "__p", "__r", "__nr")


def asis_offers(fact: DataFrame, host: DataFrame, prop: DataFrame, as_of=DEFAULT_AS_OF) -> DataFrame:
    """The rows that both as-is listing marts add up: ``gold.fact_copies`` with
    the host versions that hold on the date and the listing's property rows.
    A model writes them once, so that the joins run once and not again for
    each of a mart's aggregations.  The md5 keys of host and property say the
    same as the ids that they are made of, where they are not NULL: the joins
    and the marts use these."""
    base = fact.select(
        F.when(F.col("property_key").isNotNull(), F.col("listing_id")).alias("listing_id"),
        F.when(F.col("host_key").isNotNull(), F.col("host_id")).alias("host_id"),
        "scraped_date", "price", "availability_30", "lga_key", COPIES,
    )
    return _with_property_rows(_with_host_matches(base, host, as_of), prop).drop("listing_id")


def mart_listing_neighbourhood_asis(offers: DataFrame) -> DataFrame:
    """M18 verbatim, on ``asis_offers``: a row per kind of offer adds up to
    what one row per listing would."""
    return monthly_listing_measures(by_listing_lga(offers), ["listing_neighbourhood_lga"], COPIES)


def mart_property_type_asis(offers: DataFrame) -> DataFrame:
    """M19 verbatim, on ``asis_offers``."""
    return monthly_listing_measures(by_property(offers), OFFER_COLUMNS, COPIES)


def mart_host_neighbourhood_asis(fact: DataFrame, host, as_of=DEFAULT_AS_OF) -> DataFrame:
    """M17 verbatim: the host-version join counts, duplicating revenue on
    boundary dates exactly as the source does."""
    return mart_host_neighbourhood(_with_host_matches(fact, host, as_of), COPIES)
