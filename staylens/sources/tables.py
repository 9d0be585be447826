"""Reading the parquet inputs.

Always select the columns an operator needs right after the scan so the
parquet ReadSchema is pruned even when a plan is later unioned or cached.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylens.session import session_key


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


_scans: dict[tuple[str, str], DataFrame] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """Scan of one input table, pruned to ``cols``.  The unpruned relation is
    resolved once per session and path (file listing and footer reads are
    not repeated for every query that reads the table)."""
    key = (session_key(spark), table_path(sf_dir, name))
    if key not in _scans:
        _scans[key] = spark.read.parquet(table_path(sf_dir, name))
    df = _scans[key]
    return df.select(*cols) if cols else df


def spread_if_narrow(df: DataFrame, unique_key: list[str]) -> DataFrame:
    """Spread a scan that yields fewer tasks than the cluster has cores (a
    file with one large row group) before heavy per-row work.

    Rows are hash-partitioned on their unique identity (``unique_key``): no
    key holds more than one row, so the spread is skew-free, and unlike
    round-robin it is deterministic without a pre-sort (safe on task retry).
    Inputs that already split into enough tasks — every input at scale — pass
    through untouched, so this never adds a shuffle there."""
    spark = df.sparkSession
    target = spark.sparkContext.defaultParallelism
    narrow = df.rdd.getNumPartitions() < target
    return df.repartition(target, *unique_key) if narrow else df


def wall_clock(df: DataFrame, name: str) -> Column:
    """A zone-less timestamp column as written (its wall-clock value).

    The test tables store timestamps without a zone; Spark reads them as
    TIMESTAMP_NTZ by default and every conversion is exact.  If a session
    reads them as zoned TIMESTAMP instead, shift back from the session zone
    so dates do not move with ``spark.sql.session.timeZone``."""
    c = F.col(name)
    if isinstance(df.schema[name].dataType, T.TimestampType):
        tz = df.sparkSession.conf.get("spark.sql.session.timeZone")
        return F.to_utc_timestamp(c, tz).cast("timestamp_ntz")
    return c


def wall_date(df: DataFrame, name: str) -> Column:
    """The calendar date of a zone-less timestamp column."""
    return wall_clock(df, name).cast("date")
