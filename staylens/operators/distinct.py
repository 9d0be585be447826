"""Exact distinct counts that can be merged (A4, A5).

A value gets a dense number; a group's set of values is then a few bitmaps of
4 KB, one per 32,768 numbers that occur.  Bitmaps are built with a map-side
combine, several conditional sets in one pass (no copy of the rows per set),
and merge by OR: months roll up to years without a look at the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BUCKET = "bitmap_bucket"


def dense_numbers(df: DataFrame, column: str, out: str = "number", buckets: int = 256) -> DataFrame:
    """``column, out``: every distinct value but NULL, numbered from 1 without
    gaps.  Values are numbered inside ``buckets`` hash buckets, whose sizes
    give the offsets, so no task orders them all; the same values get the
    same numbers whenever they are computed."""
    values = df.select(column).where(F.col(column).isNotNull()).distinct()
    values = values.withColumn("__b", F.pmod(F.xxhash64(column), F.lit(buckets)))
    inside = Window.partitionBy("__b").orderBy(column)
    # one row per bucket
    sizes = values.groupBy("__b").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__b", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    ranked = values.withColumn("__at", F.row_number().over(inside))
    return ranked.join(F.broadcast(offsets), "__b").select(column, (F.col("__offset") + F.col("__at")).alias(out))


def distinct_bitmaps(df: DataFrame, keys: Sequence[str], number: str, sets: dict[str, Column | None]) -> DataFrame:
    """``keys, bitmap_bucket`` and a bitmap per set: the numbers of the rows
    for which the set's condition holds (None: all rows).  Rows without a
    number keep their group, with nothing in its sets."""
    position = F.bitmap_bit_position(number)
    bitmaps = [F.bitmap_construct_agg(position if cond is None else F.when(cond, position)).alias(name) for name, cond in sets.items()]
    return df.groupBy(*keys, F.coalesce(F.bitmap_bucket_number(number), F.lit(0).cast("long")).alias(BUCKET)).agg(*bitmaps)


def merge_bitmaps(bitmaps: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """The sets of coarser groups."""
    return bitmaps.groupBy(*keys, BUCKET).agg(*[F.bitmap_or_agg(n).alias(n) for n in names])


def count_bitmaps(bitmaps: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Distinct counts per ``keys``, which the bitmaps must be for."""
    return bitmaps.groupBy(*keys).agg(*[F.sum(F.bitmap_count(n)).alias(n) for n in names])
