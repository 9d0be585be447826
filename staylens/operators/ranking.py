"""Ranking, first-row-per-key and top-k.

Orders are always total: callers pass tie-breakers, and every sort key states
its NULL placement (engines disagree on the defaults).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RN = "__rn"


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key under ``order`` (DISTINCT ON / keep-latest).

    Planned as a shuffle on ``keys`` plus a per-partition sort; Spark pushes a
    partial ``WindowGroupLimit`` below the shuffle, so duplicate rows are
    dropped map-side before they are sent.  A hot key is fine: its rows are
    sorted in one task but never held in memory as a group.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RN, F.row_number().over(w)).where(F.col(_RN) == 1).drop(_RN)


best_per_group = latest_per_key


def with_dense_ranks(
    df: DataFrame, measure: str, top_col: str = "rank_top", bottom_col: str = "rank_bottom"
) -> DataFrame:
    """Twin DENSE_RANKs over the whole frame: descending (NULLs first, as the
    source database sorts them) and ascending (NULLs last).

    A window without PARTITION BY runs in a single task: only call this on
    frames already reduced to a bounded number of rows (one per LGA here).
    """
    w_top = Window.orderBy(F.col(measure).desc_nulls_first())
    w_bottom = Window.orderBy(F.col(measure).asc_nulls_last())
    return df.withColumn(top_col, F.dense_rank().over(w_top)).withColumn(
        bottom_col, F.dense_rank().over(w_bottom)
    )


def top_bottom_n(
    df: DataFrame,
    measure: str,
    n: int = 3,
    label_col: str = "performance_group",
    top_label: str | None = None,
    bottom_label: str | None = None,
) -> DataFrame:
    """Keep rows ranked in the top-n or bottom-n by ``measure`` and label them;
    a row in both keeps the top label (W3)."""
    top_label = top_label or f"Top {n}"
    bottom_label = bottom_label or f"Bottom {n}"
    ranked = with_dense_ranks(df, measure)
    label = F.when(F.col("rank_top") <= n, F.lit(top_label)).when(
        F.col("rank_bottom") <= n, F.lit(bottom_label)
    )
    return (
        ranked.where((F.col("rank_top") <= n) | (F.col("rank_bottom") <= n))
        .withColumn(label_col, label)
        .drop("rank_top", "rank_bottom")
    )


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """ORDER BY ... LIMIT k -> TakeOrderedAndProject (per-partition top-k, then
    a k-row merge; never a global sort of the input)."""
    return df.orderBy(*order).limit(k)


def lag_over(col: Column | str, partition: Sequence[str], order: Sequence[str], offset: int = 1) -> Column:
    """LAG(x) over (PARTITION BY ... ORDER BY ...) — previous *row*, not
    previous calendar period (W4, W5)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.lag(c, offset).over(Window.partitionBy(*partition).orderBy(*order))
