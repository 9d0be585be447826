"""Gold layer: star-schema dimensions and the listing fact.

Two fact builds (SURVEY 2.9 Q1):

* ``fact_copies`` — the source system's joins verbatim.  Its property and host
  dimensions have several rows per natural key (changing review scores, host
  versions), so a fact row multiplies; the row is kept once, with the number
  of its copies.  ``fact_asis`` writes them out, for parity checks.
* ``fact_pit``  — one row per (listing, date): property attributes from the
  same snapshot row, host/property surrogate keys taken straight from the
  natural key (the dimensions are built from the same listings, so the lookup
  would be the identity), suburb/LGA resolved through ONE join against a
  pre-joined, one-row-per-name lookup.  Marts and questions use this one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.functions.expressions import md5_key, normalize_text
from staylens.operators.scd2 import VALID_FROM, VALID_TO, scd2_rebuild
from staylens.operators.temporal import temporal_left_join
from staylens.plans.silver import HOST_COLUMNS

CENSUS_G01_COLUMNS = [
    "lga_code", "age_0_4", "age_5_14", "age_15_19", "age_20_24", "age_25_34", "age_35_44",
    "age_45_54", "age_55_64", "age_65_74", "age_75_84", "age_85_plus", "total_population",
    "indigenous_population", "born_overseas_population",
]
CENSUS_G02_COLUMNS = [
    "lga_code", "median_age_persons", "median_mortgage_repay_monthly",
    "median_tot_prsnl_inc_weekly", "median_rent_weekly", "median_tot_fam_inc_weekly",
    "average_num_psns_per_bedroom", "median_tot_hhd_inc_weekly", "average_household_size",
]

FACT_COLUMNS = [
    "listing_id", "scraped_date", "price", "number_of_reviews", "availability_30",
    "host_key", "suburb_key", "lga_key", "lga_code", "property_key",
    # not in the source fact, but read by question d
    "has_availability",
]
# Extra columns carried by the point-in-time fact so marts need no
# re-join against the multi-row property dimension.
PIT_EXTRA_COLUMNS = ["host_id", "property_type", "room_type", "accommodates", "review_scores_rating"]
SUPERHOST = "host_is_superhost"


def host_snapshot(host_clean: DataFrame) -> DataFrame:
    """SCD2 history of hosts keyed by ``host_id``, ``host_since`` as the
    version timestamp (the source's choice; see SURVEY Q7)."""
    tracked = [c for c in HOST_COLUMNS if c not in ("host_id", "host_since")]
    return scd2_rebuild(host_clean, ["host_id"], "host_since", tracked)


def dm_host(snapshot: DataFrame) -> DataFrame:
    """M9: host versions with the md5 key shared by all versions."""
    return snapshot.select(
        F.col("host_id"),
        md5_key("host_id").alias("host_key"),
        F.col("host_name"),
        F.col("host_is_superhost").cast("boolean").alias("host_is_superhost"),
        F.col(VALID_FROM),
        F.col(VALID_TO),
    )


def dm_lga(lga_code_clean: DataFrame) -> DataFrame:
    """M10."""
    return lga_code_clean.select(md5_key("lga_code").alias("lga_key"), "lga_code", "lga_name")


def dm_suburb(lga_suburb_clean: DataFrame) -> DataFrame:
    """Distinct (suburb, LGA) rows keyed by md5 of the normalised name.
    A suburb listed under two LGAs keeps two rows (SURVEY Q24)."""
    name = F.coalesce(F.col("listing_neighbourhood"), F.col("suburb_name"))
    return (
        lga_suburb_clean.where(name.isNotNull())
        .select(
            md5_key(normalize_text(name)).alias("suburb_key"),
            name.alias("suburb_name"),
            F.col("lga_code"),
            F.col("lga_name"),
        )
        .distinct()
    )


def dm_property(property_clean: DataFrame) -> DataFrame:
    """Distinct property tuples with md5(listing_id) as key."""
    return property_clean.select(md5_key("listing_id").alias("property_key"), *property_clean.columns).distinct()


def dm_census_g01(census_g01_clean: DataFrame) -> DataFrame:
    """M13."""
    return census_g01_clean.select(*CENSUS_G01_COLUMNS)


def dm_census_g02(census_g02_clean: DataFrame) -> DataFrame:
    """M14."""
    return census_g02_clean.select(*CENSUS_G02_COLUMNS)


def dm_census(g01: DataFrame, g02: DataFrame) -> DataFrame:
    """G01 LEFT JOIN G02 on the LGA code (one row per LGA each side)."""
    return g01.join(g02, "lga_code", "left").select(*CENSUS_G01_COLUMNS, *CENSUS_G02_COLUMNS[1:])


COPIES = "copies"


def fact_copies(
    listings: DataFrame,
    suburb: DataFrame,
    lga: DataFrame,
    prop: DataFrame,
    host: DataFrame,
) -> DataFrame:
    """M16 verbatim without its blow-up: four LEFT JOINs on natural keys, of
    which the property and the host join only multiply a row.  They become a
    number, ``copies`` (property rows times host versions), that the as-is
    marts and questions weigh their sums and counts with.  The suburb join stays
    a join: a suburb under two LGAs gives rows that differ.  ``prop`` holds
    the rows of the property dimension, with or without their key.

    Every join of the listing rows but that one is on the listing: listings
    that are written in buckets of it are not shuffled.  The versions of the
    hosts reach them by the pairs of listing and host, as a map of the few
    hosts that a listing had.  Rows without a listing are at most one a day
    and meet the versions themselves."""
    f = listings.select(
        "listing_id", "scraped_date", "price", "number_of_reviews", "availability_30", "has_availability", "host_id",
        normalize_text("listing_neighbourhood").alias("__nk"),
    )
    s = suburb.select(
        normalize_text("suburb_name").alias("__nk"), "suburb_key", F.col("lga_code").alias("__s_lga")
    )
    l = lga.select(F.col("lga_code").alias("__s_lga"), "lga_key", "lga_code")
    p = prop.where("listing_id is not null").groupBy(F.col("listing_id").alias("__p_listing")).agg(F.count(F.lit(1)).alias("__p"))
    versions = host.where("host_id is not null").groupBy("host_id").agg(F.count(F.lit(1)).alias("__h"))
    pairs = listings.where("listing_id is not null and host_id is not null").select("listing_id", "host_id").distinct()
    h = pairs.join(versions, "host_id").groupBy(F.col("listing_id").alias("__h_listing")).agg(
        F.map_from_entries(F.collect_list(F.struct("host_id", "__h"))).alias("__hosts")
    )
    listed = (
        f.where("listing_id is not null")
        .join(p, F.col("listing_id") == F.col("__p_listing"), "left")
        .join(h, F.col("listing_id") == F.col("__h_listing"), "left")
        .withColumn("__h", F.col("__hosts")[F.col("host_id")])
    )
    unlisted = f.where("listing_id is null").join(versions, "host_id", "left").withColumn("__p", F.lit(None).cast("long"))
    counted = listed.select(*f.columns, "__p", "__h").unionByName(unlisted.select(*f.columns, "__p", "__h"))
    # the counts first: no shuffle carries the md5 keys
    mapped = counted.join(s.join(l, "__s_lga", "left"), "__nk", "left")
    mapped = mapped.withColumn("property_key", F.when(F.col("__p").isNotNull(), md5_key("listing_id")))
    mapped = mapped.withColumn("host_key", F.when(F.col("__h").isNotNull(), md5_key("host_id")))
    copies = F.coalesce("__p", F.lit(1)) * F.coalesce("__h", F.lit(1))
    return mapped.select(*FACT_COLUMNS, "host_id", copies.alias(COPIES))


def fact_asis(copies: DataFrame) -> DataFrame:
    """M16 verbatim, fan-out included: every row of ``fact_copies`` as often as
    it says."""
    rows = copies.select(*FACT_COLUMNS, F.explode(F.sequence(F.lit(1).cast("long"), F.col(COPIES))).alias("__copy"))
    return rows.drop("__copy")


def suburb_lookup(suburb: DataFrame, lga: DataFrame) -> DataFrame:
    """One row per normalised suburb name: the smallest LGA code it is listed
    under, and that LGA's key.  (Its own key is the md5 of the name, as
    ``dm_suburb`` makes it.)  Small x small joins only; the result is what the
    fact is joined against (once)."""
    by_name = suburb.groupBy(normalize_text("suburb_name").alias("__nk")).agg(F.min("lga_code").alias("lga_code"))
    one_lga = lga.groupBy("lga_code").agg(F.min("lga_key").alias("lga_key"))
    return by_name.join(one_lga, "lga_code", "left").select("__nk", "lga_key", "lga_code")


def with_superhost_flag(fact: DataFrame, host: DataFrame, as_of=None, closed: bool = False) -> DataFrame:
    """The host's superhost flag valid on the snapshot date (J6), in place of
    one that ``fact`` may carry."""
    return temporal_left_join(
        fact.drop(SUPERHOST), host, "host_id", "host_id", "scraped_date", [SUPERHOST], as_of, closed
    )


def fact_pit(listings: DataFrame, suburb: DataFrame, lga: DataFrame, host: DataFrame, as_of=None) -> DataFrame:
    """Point-in-time fact: exactly one row per silver listing row."""
    return with_keys(fact_ids(listings, suburb, lga, host, as_of))


def fact_ids(listings: DataFrame, suburb: DataFrame, lga: DataFrame, host: DataFrame, as_of=None) -> DataFrame:
    """The point-in-time fact before its md5 keys: natural keys, of which the
    surrogates are functions (``with_keys``), so that no shuffle carries them.

    One join is against ``suburb_lookup`` (bounded by the number of distinct
    neighbourhood names); AQE broadcasts it when its measured size is under
    the threshold, otherwise it is a sort-merge join whose skewed partitions
    AQE splits.  The other attaches the host's superhost flag of the snapshot
    date: half-open versions make it a function of host and date, so it is
    resolved once here and no mart joins the host history for it.
    """
    f = listings.select(
        "listing_id", "scraped_date", "price", "number_of_reviews", "availability_30",
        "listing_neighbourhood", "has_availability", *PIT_EXTRA_COLUMNS,
    )
    # the host first: snapshots of a listing still lie side by side, which
    # makes the first shuffle small
    f = with_superhost_flag(f, host, as_of)
    lookup = suburb_lookup(suburb, lga).withColumnRenamed("__nk", "suburb_nk")
    out = f.join(lookup, normalize_text("listing_neighbourhood") == F.col("suburb_nk"), "left")
    return out.select(
        "listing_id", "scraped_date", "price", "number_of_reviews", "availability_30",
        "suburb_nk", "lga_code", F.col("lga_key").isNotNull().alias("has_lga"), "has_availability", *PIT_EXTRA_COLUMNS, SUPERHOST,
    )


def lookup_keys() -> dict[str, Column]:
    """The fact's lookup keys as functions of ``fact_ids``."""
    return {"host_key": md5_key("host_id"), "suburb_key": md5_key("suburb_nk"), "property_key": md5_key("listing_id")}


def with_keys(ids: DataFrame) -> DataFrame:
    """``fact_ids`` with the md5 keys in place of the suburb's name (a name
    that no suburb has is NULL there) and of ``has_lga``."""
    key = lookup_keys()
    return ids.select(
        "listing_id", "scraped_date", "price", "number_of_reviews", "availability_30",
        key["host_key"].alias("host_key"),
        key["suburb_key"].alias("suburb_key"),
        F.when(F.col("has_lga"), md5_key("lga_code")).alias("lga_key"),
        "lga_code",
        key["property_key"].alias("property_key"),
        "has_availability",
        *PIT_EXTRA_COLUMNS,
        SUPERHOST,
    )
