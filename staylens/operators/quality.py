"""Data-quality checks (S9 and the SCD2 invariants).

Each check returns a DataFrame of violations (empty = pass) or a one-row
summary, computed with aggregations — nothing is collected to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staylens.operators.scd2 import VALID_FROM, VALID_TO


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count (the primary-key
    constraint the source database enforced).  Partial aggregation runs
    before the shuffle, so a hot key costs one row per map task."""
    return (
        df.groupBy(*key)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .where(F.col("n_rows") > 1)
    )


def null_key_counts(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row: total rows and, per key column, how many rows have it NULL."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count(F.when(F.col(c).isNull(), 1)).alias(f"null_{c}") for c in key],
    )


def open_version_violations(history: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys whose number of open versions is not exactly one."""
    return (
        history.groupBy(*key)
        .agg(F.count(F.when(F.col(VALID_TO).isNull(), 1)).alias("n_open"))
        .where(F.col("n_open") != 1)
    )


def interval_overlaps(history: DataFrame, key: Sequence[str]) -> DataFrame:
    """Versions whose interval overlaps the next version of the same key."""
    w = Window.partitionBy(*key).orderBy(F.col(VALID_FROM).asc_nulls_first(), F.col(VALID_TO).asc_nulls_last())
    nxt = F.lead(VALID_FROM).over(w)
    return (
        history.withColumn("next_from", nxt)
        .where(
            F.col("next_from").isNotNull()
            & (F.col(VALID_TO).isNull() | (F.col(VALID_TO) > F.col("next_from")))
        )
    )


def names_in_many_groups(df: DataFrame, name_col: str, group_col: str) -> DataFrame:
    """Names mapped to more than one group (a suburb listed under two LGAs)."""
    return (
        df.where(F.col(name_col).isNotNull())
        .groupBy(name_col)
        .agg(F.countDistinct(group_col).alias("n_groups"))
        .where(F.col("n_groups") > 1)
    )
