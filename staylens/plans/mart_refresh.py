"""Listing marts kept up to date month by month.

The measures of a month need that month's fact rows alone, so they are kept as
a table by (year, month), and a drop computes only the months that it touches;
the mart is a view over it that adds each group's change against its month
before - one row per group and month, whatever the fact's size.

A drop touches the months of its own rows and, where it changes host versions,
the months in which these hosts have snapshots from the changed version's date
on (``months_of_hosts``).  A month never loses all of its rows (drops add and
replace), so its folder is always written anew.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.plans import marts

#: The kept marts: how the fact is grouped.
MARTS = {
    "listing_neighbourhood": (marts.by_listing_lga, ["listing_neighbourhood_lga"]),
    "property_type": (marts.by_property, ["property_type", "room_type", "accommodates"]),
}


def of_months(months: Iterable[tuple[int, int]]) -> Column:
    """A predicate on the partition columns."""
    return reduce(or_, [(F.col("year") == y) & (F.col("month") == m) for y, m in months], F.lit(False))


def months_of_hosts(listings: DataFrame, changed: DataFrame) -> list[tuple[int, int]]:
    """Months whose rows the changed host versions (host_id, valid_from) can
    alter.  Months: metadata."""
    since = changed.groupBy("host_id").agg(F.min("valid_from").alias("since"))
    met = listings.select("host_id", "scraped_date").join(since, "host_id").where("since is null or scraped_date >= since")
    months = met.select(F.year("scraped_date").alias("y"), F.month("scraped_date").alias("m")).distinct()
    return sorted((r.y, r.m) for r in months.where("y is not null").collect())


def month_measures(fact: DataFrame, mart: str, months: Iterable[tuple[int, int]]) -> DataFrame:
    """The measures of some months, out of those months' folders of the fact."""
    group, columns = MARTS[mart]
    return marts.listing_measures(group(fact.where(of_months(months))), columns)


def refresh(fact: DataFrame, mart: str, months: Iterable[tuple[int, int]], path: str) -> None:
    """Compute the months again in the measures table at ``path``; running it
    again writes the same."""
    rows = month_measures(fact, mart, months)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year", "month").parquet(path)


def read_mart(spark: SparkSession, mart: str, path: str) -> DataFrame:
    """The mart over its measures table."""
    return marts.with_changes(spark.read.parquet(path), MARTS[mart][1])
