"""Keyed upsert (S13) on plain parquet.

Without a table format there is no MERGE; the upsert is
``target ANTI-JOIN batch-keys UNION batch-latest``, and on disk only the
partitions the batch touches are rewritten (dynamic partition overwrite).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.operators.ranking import latest_per_key
from staylens.session import drop_path, path_exists, shared_path
from staylens.sources.sinks import CODEC


def dedupe_batch(batch: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first under ``order`` (a total order)."""
    return latest_per_key(batch, key, order)


def write_repeated_keys(rows: DataFrame, key: Sequence[str], path: str) -> DataFrame:
    """The keys (NULLs compare equal) that more than one row has, written at
    ``path``: joins with them know their size.  Only keys are shuffled."""
    counted = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")
    counted.select(*key).write.mode("overwrite").option("compression", CODEC).parquet(path)
    return rows.sparkSession.read.schema(rows.select(*key).schema).parquet(path)


def split_by_keys(rows: DataFrame, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows that have one of the (distinct) ``keys``, and the others."""
    named = keys.select(*[F.col(k).alias(f"__{k}") for k in keys.columns])
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys.columns])
    return rows.join(named, same, "left_semi"), rows.join(named, same, "left_anti")


def dedupe_written(batch: DataFrame, key: Sequence[str], order: Sequence[Column], scratch: str) -> DataFrame:
    """``dedupe_batch`` of a batch that is written already, so that reading it
    again is cheap: rows whose key no other row has are not shuffled.  The
    repeated keys go to the folder ``scratch``."""
    repeated, single = split_by_keys(batch, write_repeated_keys(batch, key, scratch))
    return single.unionByName(dedupe_batch(repeated, key, order))


def upsert(
    target: DataFrame, batch: DataFrame, key: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """Rows of ``batch`` replace rows of ``target`` with the same key.

    Both sides are shuffled once on ``key``; the batch is de-duplicated before
    it meets the target so the result has at most one row per key among the
    batch's keys.  Rows with a NULL key component never match and are kept.
    """
    latest = dedupe_batch(batch, key, order)
    keep = target.join(latest.select(*key), list(key), "left_anti")
    return keep.unionByName(latest)


def upsert_partitions(
    spark: SparkSession,
    target_path: str,
    batch: DataFrame,
    key: Sequence[str],
    order: Sequence[Column],
    partition_cols: Sequence[str],
) -> None:
    """Upsert ``batch`` into the parquet table at ``target_path`` partitioned by
    ``partition_cols``.

    Only the partitions present in the batch are read and rewritten; the batch
    must carry the partition columns.  The partition list is a distinct over
    the partition columns (calendar months: bounded, metadata-sized).

    The batch is read several times: give a written table.  Its rows are
    shuffled only where keys repeat or the target has rows to replace.
    """
    touched = [tuple(r) for r in batch.select(*partition_cols).distinct().collect()]
    # no target yet on the first load; any other failure to read it must
    # stop the run, or the overwrite below would drop the target's rows
    existing = spark.read.parquet(target_path) if path_exists(spark, target_path) else None
    scratch = shared_path(spark, "repeated-keys")
    out = dedupe_written(batch if existing is None else batch.select(*existing.columns), key, order, scratch)
    if existing is not None and touched:
        cond = None
        for values in touched:
            c = None
            for name, v in zip(partition_cols, values):
                term = F.col(name).eqNullSafe(F.lit(v))
                c = term if c is None else (c & term)
            cond = c if cond is None else (cond | c)
        current = existing.where(cond)
        # The job reads the partitions it replaces.  Dynamic partition
        # overwrite writes to a staging folder and swaps each partition in
        # only at commit, after every task (and any retried task) has read
        # the old files — so no intermediate copy of the partitions is needed.
        if not current.isEmpty():
            out = current.join(batch.select(*key), list(key), "left_anti").unionByName(out)
    (
        out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", CODEC)
        .partitionBy(*partition_cols)
        .parquet(target_path)
    )
    drop_path(spark, scratch)
