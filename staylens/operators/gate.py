"""The key constraint of a load, acting.

``write_gated`` judges every row and writes accepted and rejected rows side by
side in one pass, with the counts taken in that pass (``observe``).  A row is
rejected because a cell could not be read, a key column is NULL, its key is in
the table already, or another row of the load has its key: of those the first
under ``order`` is accepted.  What follows from a rejection is the caller's
choice: the rows go to quarantine, or the load stops with the counts and nothing
is published.

A key that a third of all rows repeat is decided in two rounds: among the rows
of one input task, then among the tasks' winners.  No window sees more of it
than one task's rows or one row per task.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from staylens.operators.upsert import split_by_keys, write_repeated_keys
from staylens.session import drop_path, shared_path
from staylens.sources.sinks import CODEC

REASON = "_reason"
#: Why a row is rejected, the first that holds.
REASONS = ("unreadable", "null key", "key exists", "duplicate key")


class RejectedRows(ValueError):
    """A load was stopped; ``counts`` has its rows by reason."""

    def __init__(self, counts: dict[str, int]):
        self.counts = counts
        super().__init__(", ".join(f"{n} {k}" for k, n in counts.items() if k in REASONS and n))


@dataclass(frozen=True)
class Gate:
    """A judged load: ``counts`` (rows, accepted, and each reason) and where
    its rows lie."""

    path: str
    counts: dict[str, int]

    def accepted(self, spark: SparkSession) -> DataFrame:
        return self._rows(spark, "accepted").drop(REASON)

    def rejected(self, spark: SparkSession) -> DataFrame:
        """The quarantine: the rows as far as they could be read, and why."""
        return self._rows(spark, "rejected")

    def _rows(self, spark: SparkSession, verdict: str) -> DataFrame:
        return spark.read.parquet(self.path).where(F.col("_verdict") == verdict).drop("_verdict")


def judged(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[Column],
    unreadable: Column | None = None,
    existing: DataFrame | None = None,
    repeated: DataFrame | None = None,
) -> DataFrame:
    """``df`` with the column ``_reason``, NULL for accepted rows.  With
    ``repeated``, the keys that more than one row has, only the rows of these
    are shuffled to be compared."""
    bad = F.lit(False) if unreadable is None else F.coalesce(unreadable, F.lit(False))
    no_key = reduce(or_, [F.col(k).isNull() for k in key])
    rows, alone = (df, None) if repeated is None else split_by_keys(df, repeated)
    rows = rows.withColumn("__task", F.spark_partition_id()).withColumn("__open", ~bad & ~no_key)
    in_task = Window.partitionBy(*key, "__open", "__task").orderBy(*order)
    rows = rows.withColumn("__first", F.row_number().over(in_task) == 1)
    # winners meet under -1; the others stay with their task
    round_two = F.when(F.col("__first"), F.lit(-1)).otherwise(F.col("__task"))
    rows = rows.withColumn("__round", round_two)
    between = Window.partitionBy(*key, "__open", "__round").orderBy(*order)
    won = F.col("__first") & (F.row_number().over(between) == 1)
    rows = rows.withColumn("__won", won).drop("__task", "__open", "__first", "__round")
    if alone is not None:
        rows = rows.unionByName(alone.withColumn("__won", F.lit(True)))
    known = F.lit(False)
    if existing is not None:
        there = existing.select(*key).distinct().withColumn("__there", F.lit(True))
        rows = rows.join(there, list(key), "left")
        known = F.col("__there").isNotNull()
    reason = F.when(bad, REASONS[0]).when(no_key, REASONS[1]).when(known, REASONS[2]).when(~F.col("__won"), REASONS[3])
    return rows.withColumn(REASON, reason).drop("__won", "__there")


def write_gated(
    df: DataFrame,
    path: str,
    key: Sequence[str],
    order: Sequence[Column],
    unreadable: Column | None = None,
    existing: DataFrame | None = None,
    stop: bool = False,
) -> Gate:
    """Judge the rows of ``df`` and write them under the new folder ``path``.
    With ``stop`` any rejected row raises ``RejectedRows`` and ``path`` does
    not come into being.

    The rows are computed once, into scratch files: the keys are read first, to
    tell those that repeat."""
    spark = df.sparkSession
    scratch = shared_path(spark, "gate")
    df.write.option("compression", CODEC).parquet(f"{scratch}/rows")
    df = spark.read.schema(df.schema).parquet(f"{scratch}/rows")
    with_key = reduce(and_, [F.col(k).isNotNull() for k in key])
    repeated = write_repeated_keys(df.where(with_key), key, f"{scratch}/keys")
    seen = Observation()
    rows = judged(df, key, order, unreadable, existing, repeated)
    counts = [F.count_if(F.col(REASON) == r).alias(r) for r in REASONS]
    rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.col(REASON).isNull()).alias("accepted"), *counts)
    verdict = F.when(F.col(REASON).isNull(), F.lit("accepted")).otherwise(F.lit("rejected"))
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    target = fs_path(path.rstrip("/"))
    staged = fs_path(target.getParent(), f"_{target.getName()}-{uuid.uuid4().hex[:8]}")
    rows.withColumn("_verdict", verdict).write.option("compression", CODEC).partitionBy("_verdict").parquet(staged.toString())
    drop_path(spark, scratch)
    fs = staged.getFileSystem(spark._jsc.hadoopConfiguration())
    found = {k: int(v) for k, v in seen.get.items()}
    if stop and found["rows"] > found["accepted"]:
        fs.delete(staged, True)
        raise RejectedRows(found)
    if fs.exists(target) or not fs.rename(staged, target):
        raise FileExistsError(path)
    return Gate(path, found)
