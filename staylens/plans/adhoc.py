"""Ad-hoc questions a-e over the gold star schema.

All run on the point-in-time fact.  "Active" has three meanings in these
questions and they are kept apart (SURVEY Q6): a-c use "at least one stay"
(``availability_30 < 30``), d the listing's own availability flag, e "has free
nights" (``availability_30 > 0``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.functions.expressions import (
    active_available,
    active_booked,
    active_flagged,
    months_before,
    revenue,
    stays,
)
from staylens.operators.aggregates import (
    corr_safe,
    count_copies,
    count_if,
    exact_avg,
    round_avg,
    round_ratio,
    string_agg_distinct,
)
from staylens.operators.joins import join_concat_key, scalar_of, semi_join_in
from staylens.operators.ranking import latest_per_key, top_bottom_n, top_k


def pct_rounded(part: Column, total: Column, digits: int = 2) -> Column:
    """``round(part * 100.0 / nullif(total, 0), digits)`` exactly."""
    return round_ratio(part, total, digits)


def last_months(fact: DataFrame, months: int = 12) -> Column:
    """``scraped_date >= (SELECT max(scraped_date) - interval) ``.

    On a fact laid out by (year, month) the latest month comes from the
    partition values, its date from that month's folder alone, and a predicate
    on the same columns prunes the folders that are read."""
    if not {"year", "month"} <= set(fact.columns):
        max_date = scalar_of(fact.agg(F.max("scraped_date")))
        return F.col("scraped_date") >= months_before(max_date, months)
    period = F.col("year") * 12 + F.col("month")
    latest = scalar_of(fact.agg(F.max(period)))
    max_date = scalar_of(fact.where(period == latest).agg(F.max("scraped_date")))
    return (period >= latest - months) & (F.col("scraped_date") >= months_before(max_date, months))


def question_a(fact: DataFrame, census: DataFrame, n: int = 3, copies: str | None = None) -> DataFrame:
    """Top-n and bottom-n LGAs by the average over hosts of each host's mean
    monthly revenue in the last 12 months, with their age mix and household
    size (two-level average, twin dense ranks, census join)."""
    recent = fact.where(last_months(fact) & active_booked("availability_30"))
    host_revenue = recent.groupBy("lga_code", "host_key").agg(
        exact_avg(revenue(), copies).alias("revenue_per_host")
    )
    # one row per LGA from here on: the whole-set ranking window is bounded
    per_lga = host_revenue.groupBy("lga_code").agg(F.avg("revenue_per_host").alias("avg_revenue_per_host"))
    groups = top_bottom_n(per_lga, "avg_revenue_per_host", n).select("lga_code", "performance_group")
    demo = join_concat_key(groups, census, "LGA", "lga_code", "lga_code", "left").select(
        "performance_group",
        "lga_code",
        F.col("total_population"),
        (F.col("age_0_4") + F.col("age_5_14")).alias("age_0_14"),
        (
            F.col("age_15_19") + F.col("age_20_24") + F.col("age_25_34")
            + F.col("age_35_44") + F.col("age_45_54") + F.col("age_55_64")
        ).alias("age_15_64"),
        (F.col("age_65_74") + F.col("age_75_84") + F.col("age_85_plus")).alias("age_65_plus"),
        F.col("average_household_size"),
    )
    return demo.groupBy("performance_group").agg(
        pct_rounded(F.sum("age_0_14"), F.sum("total_population")).alias("pct_age_0_14"),
        pct_rounded(F.sum("age_15_64"), F.sum("total_population")).alias("pct_age_15_64"),
        pct_rounded(F.sum("age_65_plus"), F.sum("total_population")).alias("pct_age_65_plus"),
        round_avg("average_household_size", 2).alias("avg_household_size"),
        string_agg_distinct("lga_code").alias("lgas_in_group"),
    )


def question_b(fact: DataFrame, census_g02: DataFrame, copies: str | None = None) -> DataFrame:
    """Correlation of an LGA's median age and its mean revenue per active
    listing, rounded to 3 places (NULL when undefined)."""
    per_lga = (
        fact.where(active_booked("availability_30"))
        .groupBy("lga_code")
        .agg(exact_avg(revenue(), copies).alias("avg_revenue_per_active_listing"))
    )
    joined = join_concat_key(per_lga, census_g02, "LGA", "lga_code", "lga_code", "inner").where(
        F.col("median_age_persons").isNotNull()
    )
    r = corr_safe("median_age_persons", "avg_revenue_per_active_listing")
    return joined.agg(
        F.round(r.cast("decimal(38,10)"), 3).cast("double").alias("correlation_coefficient")
    )


def question_c(fact: DataFrame, suburb: DataFrame, k: int = 5, prop: DataFrame | None = None) -> DataFrame:
    """For the k neighbourhoods with the highest mean revenue per active
    listing (latest snapshot per listing), the property type / room type /
    capacity with the most stays.  With ``prop`` (the property dimension)
    the attributes come from joining it on ``property_key``, as the source
    does (every property row of the listing and every row of its suburb
    counts); otherwise from the point-in-time fact's own snapshot."""
    latest = latest_per_key(fact, ["listing_id"], [F.col("scraped_date").desc_nulls_last()])
    name = F.col("suburb_name").alias("listing_neighbourhood")
    if prop is None:
        names = suburb.groupBy("suburb_key").agg(F.min(name).alias("listing_neighbourhood"), F.lit(1).cast("long").alias("entries"))
    else:
        # every row of a suburb that is listed under several LGAs counts
        names = suburb.groupBy("suburb_key", name).agg(F.count(F.lit(1)).alias("entries"))
    latest = latest.join(names, "suburb_key", "left")
    per_neigh = (
        latest.where(active_booked("availability_30"))
        .groupBy("listing_neighbourhood")
        .agg(exact_avg(revenue()).alias("avg_revenue_per_active_listing"))
    )
    top = top_k(
        per_neigh,
        [
            F.col("avg_revenue_per_active_listing").desc_nulls_first(),
            F.col("listing_neighbourhood").asc_nulls_last(),
        ],
        k,
    )
    # k rows by construction: a size-bounded semi join
    in_top = semi_join_in(latest, F.broadcast(top), "listing_neighbourhood")
    if prop is not None:
        # only the stays step reads the property dimension (its fan-out
        # weights stays, never the neighbourhood ranking)
        # (by the listing, where it is given: the key is made of it, and the
        # dimension is written in buckets of it)
        at = "listing_id" if "listing_id" in prop.columns else "property_key"
        offers = prop.groupBy(at, "property_type", "room_type", "accommodates").agg(F.count(F.lit(1)).alias("offers"))
        known = F.when(F.col("property_key").isNotNull(), F.col(at)).alias(at)
        in_top = in_top.select("listing_neighbourhood", known, "availability_30", "entries").join(offers, at, "left")
        in_top = in_top.withColumn("entries", F.col("entries") * F.coalesce("offers", F.lit(1)))
    by_property = in_top.groupBy(
        "listing_neighbourhood", "property_type", "room_type", "accommodates"
    ).agg(F.sum(stays() * F.coalesce("entries", F.lit(1))).cast("long").alias("total_stays"))
    best = latest_per_key(
        by_property,
        ["listing_neighbourhood"],
        [
            F.col("total_stays").desc_nulls_first(),
            F.col("property_type").asc_nulls_last(),
            F.col("room_type").asc_nulls_last(),
            F.col("accommodates").asc_nulls_last(),
        ],
    )
    return best.select("listing_neighbourhood", "property_type", "room_type", "accommodates", "total_stays")


def question_d(fact: DataFrame, copies: str | None = None) -> DataFrame:
    """Among hosts with more than one available listing-snapshot, the share
    whose listings all lie in one LGA."""
    host_listings = fact.where(
        active_flagged("has_availability") & F.col("host_key").isNotNull() & F.col("lga_key").isNotNull()
    )
    summary = (
        host_listings.groupBy("host_key")
        .agg(
            F.countDistinct("lga_code").alias("num_lgas"),
            count_copies("listing_id", copies).alias("total_listings"),
        )
        .where(F.col("total_listings") > 1)
    )
    concentrated = count_if(F.col("num_lgas") == 1)
    return summary.agg(
        F.count("host_key").alias("total_multi_listing_hosts"),
        concentrated.alias("concentrated_hosts_count"),
        count_if(F.col("num_lgas") > 1).alias("distributed_hosts_count"),
        pct_rounded(concentrated, F.count("host_key")).alias("percent_concentrated_hosts"),
    )


def question_e(
    fact: DataFrame, census_g02: DataFrame, lga: DataFrame, min_hosts: int = 10, copies: str | None = None
) -> DataFrame:
    """The LGA where the largest share of single-listing hosts' annualised
    revenue covers the annual median mortgage (LGAs with more than
    ``min_hosts`` qualifying rows)."""
    available = fact.where(active_available("availability_30"))
    single_hosts = (
        available.groupBy("host_key")
        .agg(F.countDistinct("listing_id").alias("n"))
        .where(F.col("n") == 1)
        .select("host_key")
    )
    rows = semi_join_in(
        available.where(
            F.col("host_key").isNotNull() & F.col("lga_code").isNotNull() & last_months(fact)
        ),
        single_hosts,
        "host_key",
    ).select("host_key", "lga_code", (revenue() * F.lit(12)).alias("annual_estimated_revenue"), *([copies] if copies else []))
    coverage = join_concat_key(rows, census_g02, "LGA", "lga_code", "lga_code", "inner").select(
        "host_key",
        "lga_code",
        "annual_estimated_revenue",
        (F.col("median_mortgage_repay_monthly") * F.lit(12)).alias("annual_median_mortgage"),
        *([copies] if copies else []),
    )
    summary = coverage.groupBy("lga_code").agg(
        count_copies("host_key", copies).alias("total_single_hosts"),
        count_if(F.col("annual_estimated_revenue") >= F.col("annual_median_mortgage"), copies).alias(
            "covered_hosts_count"
        ),
    )
    names = lga.select("lga_code", "lga_name")
    result = (
        summary.where(F.col("total_single_hosts") > min_hosts)
        .join(names, "lga_code", "left")
        .select(
            "lga_name",
            "lga_code",
            pct_rounded(F.col("covered_hosts_count"), F.col("total_single_hosts")).alias("percent_covered"),
            "total_single_hosts",
        )
    )
    return top_k(
        result,
        [
            F.col("percent_covered").desc_nulls_first(),
            F.col("total_single_hosts").desc_nulls_first(),
            F.col("lga_code").asc_nulls_last(),
            F.col("lga_name").asc_nulls_last(),
        ],
        1,
    )
