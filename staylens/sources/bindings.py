"""Bind the bronze shapes to the driver's TPC-H-ish test tables.

The rental pipeline's inputs (monthly listing snapshots, census G01/G02, LGA
codes, the LGA-suburb map) are derived from ``lineitem``, ``orders``,
``customer``, ``supplier`` and ``nation`` so every operator runs on data whose
volume grows with the scale factor.  The mapping (see FIXTURES.md §2):

* an order is a listing, one of its lines is a monthly snapshot;
* host = (customer, order mod 8) — several hosts per customer, and the
  order date plays ``host_since`` so a host has several attribute versions;
* the line's supplier is the listing's neighbourhood; the supplier's nation
  is the LGA; census figures are aggregated from customers per nation.

Every frame returned here has exactly the bronze schema of
``sources.schemas``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.sources import schemas
from staylens.sources.tables import read_table, spread_if_narrow, wall_date

# Fixed binding parameters (FIXTURES.md §2).
HOSTS_PER_CUSTOMER = 8
NOWHERE_EVERY = 13            # every 13th order lists an unknown neighbourhood
SUPERHOST_BALANCE = 5000      # c_acctbal above -> 't'; above 0 -> 'f'; else NULL
LGA_CODE_BASE = 10000
LGA_CODE_STEP = 10
AGE_BAND_MODULUS = 11         # customer falls in band c_custkey % 11
MEDIAN_AGE_MODULUS = 80
# Offsets added to review_scores_rating for the five other review scores.
REVIEW_SCORE_OFFSETS = {
    "review_scores_accuracy": 1,
    "review_scores_cleanliness": 2,
    "review_scores_checkin": 3,
    "review_scores_communication": 4,
    "review_scores_value": 5,
}

#: The test tables end in 2001: open host versions hold up to this date.
AS_OF = _dt.date(2002, 1, 1)


def _conform(df: DataFrame, schema) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def listings_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze listing snapshots, one row per lineitem (duplicate keys kept)."""
    li = read_table(
        spark, sf_dir, "lineitem",
        "l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
    )
    o = read_table(
        spark, sf_dir, "orders",
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority",
    )
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey", "c_acctbal")
    n = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    s = read_table(spark, sf_dir, "supplier", "s_suppkey", "s_name")

    # A scan narrower than the cluster is spread (skew-free) first.
    li = spread_if_narrow(li, ["l_orderkey", "l_linenumber"])
    rating = F.when(F.col("l_returnflag") == "R", F.lit(None)).otherwise(
        (F.col("l_discount") * 100).cast(schemas.MONEY)
    )
    # the line's own columns in their final types: only these are shuffled
    li = li.select(
        "l_orderkey",
        "l_suppkey",
        "l_linenumber",
        wall_date(li, "l_shipdate").alias("shipdate"),
        F.col("l_extendedprice").cast(schemas.MONEY).alias("price"),
        F.when(F.col("l_linestatus") == "O", "t").otherwise("f").alias("has_availability"),
        (F.col("l_quantity").cast("int") % 31).alias("availability_30"),
        (F.col("l_tax") * 100).cast("int").alias("number_of_reviews"),
        rating.alias("rating"),
    )
    # Left joins: a snapshot is never dropped for a missing dimension row.
    # Join strategy is left to AQE: nation and supplier stay far below the
    # broadcast threshold; orders and customer are broadcast while small and
    # sort-merge joined on their keys beyond it (skewed keys split by AQE).
    # Orders of more than one split: the order's own columns are gathered
    # before the lines meet it, so the lines are shuffled once, on the order,
    # and that partitioning also serves the silver de-duplication, whose key
    # begins with the listing.
    at_order, at_customer, at_nation = F.col("l_orderkey") == F.col("o_orderkey"), F.col("o_custkey") == F.col("c_custkey"), F.col("c_nationkey") == F.col("n_nationkey")
    orderdate = wall_date(o, "o_orderdate").alias("orderdate")
    superhost = F.when(F.col("c_acctbal") > SUPERHOST_BALANCE, "t").when(F.col("c_acctbal") > 0, "f").alias("superhost")
    if o.rdd.getNumPartitions() > 1:
        o = o.join(c, at_customer, "left").join(n, at_nation, "left")
        o = o.select("o_orderkey", "o_custkey", "o_orderstatus", orderdate, "o_orderpriority", "c_name", superhost, "n_name")
        df = li.join(o, at_order, "left")
    else:
        df = li.join(o, at_order, "left").join(c, at_customer, "left").join(n, at_nation, "left").select("*", orderdate, superhost)
    # the names of the suppliers last: the lines' shuffle does not carry them
    df = df.join(s, F.col("l_suppkey") == F.col("s_suppkey"), "left")
    cols = {
        "listing_id": F.col("l_orderkey"),
        "scrape_id": F.col("l_linenumber"),
        "scraped_date": F.col("shipdate"),
        "host_id": F.col("o_custkey") * HOSTS_PER_CUSTOMER + F.col("o_orderkey") % HOSTS_PER_CUSTOMER,
        "host_name": F.col("c_name"),
        "host_since": F.col("orderdate"),
        "host_is_superhost": F.col("superhost"),
        "host_neighbourhood": F.col("n_name"),
        "listing_neighbourhood": F.when(
            F.col("o_orderkey") % NOWHERE_EVERY == 0, F.lit("Nowhere")
        ).otherwise(F.concat(F.lit(" "), F.col("s_name"), F.lit(" "))),
        "property_type": F.col("o_orderpriority"),
        "room_type": F.col("o_orderstatus"),
        "accommodates": F.col("o_orderkey") % 4 + 1,
        "price": F.col("price"),
        "has_availability": F.col("has_availability"),
        "availability_30": F.col("availability_30"),
        "number_of_reviews": F.col("number_of_reviews"),
        "review_scores_rating": F.col("rating"),
    }
    for name, offset in REVIEW_SCORE_OFFSETS.items():
        cols[name] = F.col("rating") + F.lit(offset)
    return _conform(df.select(*[v.alias(k) for k, v in cols.items()]), schemas.LISTINGS_RAW)


def lga_code_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    code = (F.lit(LGA_CODE_BASE) + F.col("n_nationkey") * LGA_CODE_STEP).cast("string")
    return _conform(n.select(code.alias("lga_code"), F.col("n_name").alias("lga_name")), schemas.LGA_CODE)


def lga_suburb_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier", "s_name", "s_nationkey")
    n = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    df = s.join(n, s.s_nationkey == n.n_nationkey, "left")
    return _conform(
        df.select(F.col("n_name").alias("lga_name"), F.col("s_name").alias("suburb_name")),
        schemas.LGA_SUBURB,
    )


def _census_code() -> F.Column:
    return F.concat(
        F.lit("LGA"),
        (F.lit(LGA_CODE_BASE) + F.col("c_nationkey") * LGA_CODE_STEP).cast("string"),
    )


def census_g01_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Person counts per LGA aggregated from customers (one group per nation,
    so the output is bounded by the nation domain)."""
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    male = F.col("c_custkey") % 2 == 0
    female = F.col("c_custkey") % 2 == 1
    aggs = {
        "Tot_P_M": F.count(F.when(male, 1)),
        "Tot_P_F": F.count(F.when(female, 1)),
        "Tot_P_P": F.count(F.lit(1)),
        "Indigenous_P_Tot_P": F.count(F.when(F.col("c_acctbal") < 0, 1)),
        "Birthplace_Elsewhere_P": F.count(F.when(F.col("c_mktsegment") == "BUILDING", 1)),
    }
    for k, (band, _) in enumerate(schemas.AGE_BANDS):
        in_band = F.col("c_custkey") % AGE_BAND_MODULUS == k
        aggs[f"{band}_M"] = F.count(F.when(in_band & male, 1))
        aggs[f"{band}_F"] = F.count(F.when(in_band & female, 1))
        aggs[f"{band}_P"] = F.count(F.when(in_band, 1))
    g = c.groupBy(_census_code().alias("LGA_CODE_2016")).agg(
        *[v.alias(k) for k, v in aggs.items()]
    )
    # Measures the test tables have no counterpart for stay NULL.
    return g.select(
        *[
            (F.col(f.name) if f.name in aggs or f.name == "LGA_CODE_2016" else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in schemas.CENSUS_G01_RAW.fields
        ]
    )


def census_g02_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    k = F.col("c_nationkey")
    g = c.groupBy(_census_code().alias("LGA_CODE_2016"), k.alias("nk")).agg(
        F.median(F.col("c_custkey") % MEDIAN_AGE_MODULUS).alias("Median_age_persons")
    )
    nk = F.col("nk")
    measures = {
        "Median_age_persons": F.col("Median_age_persons"),
        "Median_mortgage_repay_monthly": F.lit(100000) + nk * 40000,
        "Median_tot_prsnl_inc_weekly": F.lit(500) + nk * 10,
        "Median_rent_weekly": F.lit(300) + nk * 5,
        "Median_tot_fam_inc_weekly": F.lit(1500) + nk * 20,
        "Average_num_psns_per_bedroom": F.lit(0.5) + (nk % 4) * F.lit(0.25),
        "Median_tot_hhd_inc_weekly": F.lit(1200) + nk * 15,
        "Average_household_size": F.lit(2.5) + nk % 3,
    }
    return _conform(
        g.select(F.col("LGA_CODE_2016"), *[v.alias(n) for n, v in measures.items()]),
        schemas.CENSUS_G02_RAW,
    )


def bronze(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All five bronze tables, lazily (the source registry, S10)."""
    return {
        "listings_raw": listings_raw(spark, sf_dir),
        "census_g01_raw": census_g01_raw(spark, sf_dir),
        "census_g02_raw": census_g02_raw(spark, sf_dir),
        "lga_code": lga_code_raw(spark, sf_dir),
        "lga_suburb": lga_suburb_raw(spark, sf_dir),
    }


class LazyBronze(dict):
    """The bronze registry with each table built on first access."""

    _BUILDERS = {
        "listings_raw": listings_raw,
        "census_g01_raw": census_g01_raw,
        "census_g02_raw": census_g02_raw,
        "lga_code": lga_code_raw,
        "lga_suburb": lga_suburb_raw,
    }

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self._spark, self._sf_dir = spark, sf_dir

    def __missing__(self, name: str) -> DataFrame:
        df = self._BUILDERS[name](self._spark, self._sf_dir)
        self[name] = df
        return df
