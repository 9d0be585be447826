"""Silver layer: typed, de-duplicated, normalised tables (M1-M7)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.functions.expressions import decode_flag, md5_key, normalize_text
from staylens.operators.joins import full_outer_small_right
from staylens.operators.upsert import dedupe_batch
from staylens.sources import schemas

LISTING_KEY = list(schemas.LISTING_KEY)

HOST_COLUMNS = ["host_id", "host_name", "host_since", "host_is_superhost", "host_neighbourhood"]

PROPERTY_COLUMNS = [
    "listing_id", "property_type", "room_type", "accommodates", "number_of_reviews",
    "review_scores_rating", "review_scores_accuracy", "review_scores_cleanliness",
    "review_scores_checkin", "review_scores_communication", "review_scores_value",
]


def listing_order() -> list[Column]:
    """Which row wins when a batch repeats a (listing_id, scraped_date) key:
    the latest scrape, then a fixed total order over the remaining columns."""
    return [
        F.col("scrape_id").desc_nulls_last(),
        F.col("price").desc_nulls_last(),
        F.col("availability_30").desc_nulls_last(),
        F.col("host_id").asc_nulls_last(),
        F.col("listing_neighbourhood").asc_nulls_last(),
        F.col("number_of_reviews").asc_nulls_last(),
        F.col("review_scores_rating").asc_nulls_last(),
        F.col("has_availability").asc_nulls_last(),
        *[
            F.col(c).asc_nulls_last()
            for c in (
                "host_name", "host_since", "host_is_superhost", "host_neighbourhood", "property_type", "room_type", "accommodates",
                "review_scores_accuracy", "review_scores_cleanliness", "review_scores_checkin", "review_scores_communication", "review_scores_value",
            )
        ],
    ]


def clean_listings(raw: DataFrame) -> DataFrame:
    """M1 projection: decode the two 't'/'f' flags, pin numeric types."""
    money = schemas.MONEY
    return raw.select(
        F.col("listing_id").cast("long").alias("listing_id"),
        F.col("scrape_id").cast("long").alias("scrape_id"),
        F.col("scraped_date").cast("date").alias("scraped_date"),
        F.col("host_id").cast("long").alias("host_id"),
        F.col("host_name"),
        F.col("host_since").cast("date").alias("host_since"),
        decode_flag("host_is_superhost").alias("host_is_superhost"),
        F.col("host_neighbourhood"),
        F.col("listing_neighbourhood"),
        F.col("property_type"),
        F.col("room_type"),
        F.col("accommodates").cast("int").alias("accommodates"),
        F.col("price").cast(money).alias("price"),
        decode_flag("has_availability").alias("has_availability"),
        F.col("availability_30").cast("int").alias("availability_30"),
        F.col("number_of_reviews").cast("int").alias("number_of_reviews"),
        *[
            F.col(c).cast(money).alias(c)
            for c in (
                "review_scores_rating", "review_scores_accuracy", "review_scores_cleanliness",
                "review_scores_checkin", "review_scores_communication", "review_scores_value",
            )
        ],
    )


def silver_listings(raw: DataFrame) -> DataFrame:
    """Listings cleaned and reduced to one row per (listing_id, scraped_date) —
    the state an incremental upsert of all batches converges to."""
    return dedupe_batch(clean_listings(raw), LISTING_KEY, listing_order())


def silver_host(listings: DataFrame) -> DataFrame:
    """M2: distinct host attribute tuples (several per host over time)."""
    return listings.select(*HOST_COLUMNS).where(F.col("host_id").isNotNull()).distinct()


def silver_property(listings: DataFrame) -> DataFrame:
    """M3: distinct property attribute tuples (several per listing)."""
    return (
        listings.select(
            *[
                F.col(c).cast("int").alias(c) if c == "number_of_reviews" else F.col(c)
                for c in PROPERTY_COLUMNS
            ]
        )
        .where(F.col("listing_id").isNotNull())
        .distinct()
    )


def silver_lga_code(lga_code: DataFrame) -> DataFrame:
    """M4: trimmed code, lower-trimmed name, distinct, code not NULL."""
    return (
        lga_code.where(F.col("lga_code").isNotNull())
        .select(F.trim("lga_code").alias("lga_code"), normalize_text("lga_name").alias("lga_name"))
        .distinct()
    )


def official_suburbs(lga_suburb: DataFrame, lga_code: DataFrame) -> DataFrame:
    """Official suburb list with its LGA, joined on the normalised LGA name."""
    s = lga_suburb.where(F.col("suburb_name").isNotNull()).select(
        normalize_text("suburb_name").alias("suburb_name"),
        normalize_text("lga_name").alias("_lga_norm"),
    )
    l = lga_code.select(
        F.trim("lga_code").alias("lga_code"),
        normalize_text("lga_name").alias("lga_name"),
        normalize_text("lga_name").alias("_lga_norm"),
    )
    return s.join(l, "_lga_norm", "left").select("suburb_name", "lga_code", "lga_name")


def silver_lga_suburb(
    lga_suburb: DataFrame, lga_code: DataFrame, listings: DataFrame, per_listing: bool = True
) -> DataFrame:
    """M5: every listing neighbourhood (once per listing, as the source keeps
    it) matched to the official suburbs, plus official suburbs no listing
    names; coalesced name and its md5 key.

    The FULL OUTER JOIN is planned as listing-side LEFT JOIN (the small
    official list can be broadcast; the big side is never shuffled on the
    neighbourhood name, so a neighbourhood holding a third of all listings
    does not land in one task) plus the unmatched official rows.

    ``per_listing=False`` keeps one row per neighbourhood instead of one per
    listing: the same distinct rows, for consumers that de-duplicate anyway
    (the suburb dimension).
    """
    cols = [normalize_text("listing_neighbourhood").alias("listing_neighbourhood")]
    if per_listing:
        cols.append(F.col("listing_id"))
    listing_neigh = listings.select(*cols).distinct()
    joined = full_outer_small_right(
        listing_neigh, official_suburbs(lga_suburb, lga_code), "listing_neighbourhood", "suburb_name"
    )
    name = F.coalesce(F.col("listing_neighbourhood"), F.col("suburb_name"))
    return joined.select(
        name.alias("listing_neighbourhood"),
        F.col("suburb_name"),
        F.col("lga_name"),
        F.col("lga_code"),
        md5_key(name).alias("suburb_key"),
    )


def silver_census_g01(raw: DataFrame) -> DataFrame:
    """M6: age bands = male + female (NULL if either is NULL), totals."""
    bands = [
        (F.col(f"{band}_M") + F.col(f"{band}_F")).alias(out) for band, out in schemas.AGE_BANDS
    ]
    return raw.where(F.col("LGA_CODE_2016").isNotNull()).select(
        F.col("LGA_CODE_2016").cast("string").alias("lga_code"),
        *bands,
        F.col("Tot_P_P").alias("total_population"),
        F.col("Indigenous_P_Tot_P").alias("indigenous_population"),
        F.col("Birthplace_Elsewhere_P").alias("born_overseas_population"),
    )


def silver_census_g02(raw: DataFrame) -> DataFrame:
    """M7: medians and averages passed through, code not NULL."""
    return raw.where(F.col("LGA_CODE_2016").isNotNull()).select(
        F.col("LGA_CODE_2016").cast("string").alias("lga_code"),
        *[F.col(m).alias(m.lower()) for m in schemas.CENSUS_G02_MEASURES],
    )
