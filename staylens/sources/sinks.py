"""Sinks: layer tables, views, full reloads and the partitioned fact
(S8, S11, S12, S15, S16).

Tables are written as parquet under a base folder that the caller passes —
on a cluster a shared location (``session.shared_path`` derives one from
``spark.checkpoint.dir``); never a machine-local temp dir.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: The layer of tables that name none.
DEFAULT_LAYER = "public"


def quoted(name: str) -> str:
    """An identifier as SQL takes it, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def qualified_name(layer: str | None, name: str) -> str:
    """``layer.name``, quoted: a layer is a database (schema) of its own, and
    tables without one go to ``DEFAULT_LAYER`` (S15)."""
    return f"{quoted(layer or DEFAULT_LAYER)}.{quoted(name)}"


def ensure_layer(spark: SparkSession, layer: str | None, base_path: str) -> None:
    """CREATE DATABASE for a layer, located under ``base_path``."""
    layer = layer or DEFAULT_LAYER
    place = f"{base_path.rstrip('/')}/{layer}.db".replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(layer)} LOCATION '{place}'")


def write_table(
    df: DataFrame,
    layer: str | None,
    name: str,
    base_path: str,
    partition_by: Sequence[str] = (),
    bucket_by: tuple[int, str] | None = None,
) -> DataFrame:
    """Materialise ``df`` as the catalog table ``layer.name`` (S11), replacing
    it; returns the table as read back.  ``bucket_by=(n, col)`` co-locates a
    join key so later joins on it skip the shuffle."""
    spark = df.sparkSession
    ensure_layer(spark, layer, base_path)
    # an explicit path: a layer that exists already keeps its first location
    w = df.write.mode("overwrite").format("parquet").option("path", f"{base_path.rstrip('/')}/{layer or DEFAULT_LAYER}.db/{name}")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if bucket_by:
        w = w.bucketBy(bucket_by[0], bucket_by[1]).sortBy(bucket_by[1])
    w.saveAsTable(qualified_name(layer, name))
    return spark.table(qualified_name(layer, name))


def register_table(spark: SparkSession, layer: str | None, name: str, path: str, base_path: str) -> DataFrame:
    """The catalog table ``layer.name`` over Parquet files that are written
    already (no copy), with their partitions."""
    ensure_layer(spark, layer, base_path)
    table = qualified_name(layer, name)
    spark.sql(f"DROP TABLE IF EXISTS {table}")  # an external table: its files stay
    created = spark.catalog.createTable(table, path=path, source="parquet")
    if set(created.columns) and any(c.isPartition for c in spark.catalog.listColumns(table)):
        spark.catalog.recoverPartitions(table)
    return spark.table(table)


def publish_view(spark: SparkSession, layer: str | None, name: str, select: str, base_path: str) -> DataFrame:
    """The catalog view ``layer.name`` (S12): nothing is computed until it is
    read, and any session of the catalog can read it.  ``select`` is its SQL,
    over catalog tables."""
    ensure_layer(spark, layer, base_path)
    spark.sql(f"CREATE OR REPLACE VIEW {qualified_name(layer, name)} AS {select}")
    return spark.table(qualified_name(layer, name))


def full_reload(tables: dict[str, DataFrame], base_path: str) -> dict[str, DataFrame]:
    """Empty and reload every bronze table (S8): each is overwritten in full
    at ``base_path/<name>``; returns the reloaded tables as read back."""
    out = {}
    for name, df in tables.items():
        path = f"{base_path.rstrip('/')}/{name}"
        df.write.mode("overwrite").parquet(path)
        out[name] = df.sparkSession.read.parquet(path)
    return out


#: Written tables hold md5 keys in hexadecimal: half their bytes, entropy-coded.
CODEC = "zstd"


def write_bucketed(df: DataFrame, path: str, key: str) -> DataFrame:
    """``df`` written at ``path`` in as many buckets of ``key`` as a shuffle has
    partitions, and the table as read back: distinct rows, groups and joins on
    ``key`` need no shuffle of it.  For rows that come partitioned by ``key``
    (each task then writes its own buckets only) and of which no key has many.

    The buckets are known to the session's catalog alone, under a name of its
    own; the files are plain Parquet."""
    spark = df.sparkSession
    table = f"default.{quoted(f'bucketed_{uuid.uuid4().hex}')}"
    writer = df.write.mode("overwrite").format("parquet").option("compression", CODEC).option("path", path)
    writer.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), key).sortBy(key).saveAsTable(table)
    return spark.table(table)


def write_fact_partitioned(
    fact: DataFrame, path: str, date_col: str = "scraped_date", host_key: Column | None = None, finish: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """The fact laid out for month filters (S16): partitioned by
    (year, month) so a month predicate prunes whole folders, each folder's
    files sorted by host for tight parquet min/max statistics.

    Rows are range-partitioned on (year, month, host_key) plus the fact's
    unique key before the write: each task writes one or a few folders (no
    small-file explosion), and a month — even a single host in a month —
    holding a third of all rows is cut into many sampled ranges instead of
    landing in one task.

    Columns that are functions of a row need not be shuffled: ``finish`` adds
    them to the shuffled rows, and ``host_key`` then is the expression that it
    makes the column of that name with."""
    period = {"year": F.year(date_col), "month": F.month(date_col)}
    laid = fact.repartitionByRange(*period.values(), F.col("host_key") if host_key is None else host_key, "listing_id", date_col)
    laid = (finish(laid) if finish else laid).withColumns(period)
    laid = laid.sortWithinPartitions("year", "month", "host_key", "listing_id", date_col)
    laid.write.mode("overwrite").option("compression", CODEC).partitionBy("year", "month").parquet(path)
    return fact.sparkSession.read.parquet(path)


#: The keys that lookups on the fact name besides its month.
LOOKUP_KEYS = ("host_key", "suburb_key", "property_key")


def interleaved(keys: Sequence[str | Column], bits: int = 10) -> Column:
    """A place on the Z-order curve over md5 keys: their leading bits in turn,
    the first bit of every key, then the second, and so on.  (md5 spreads the
    values evenly, so no quantiles are needed; NULL counts as 0.)"""
    leading = [F.conv(F.substring(F.coalesce(F.col(k) if isinstance(k, str) else k, F.lit("0000")), 1, 4), 16, 10).cast("long") for k in keys]
    place = F.lit(0).cast("long")
    for b in range(bits):
        for i, number in enumerate(leading):
            bit = F.shiftright(number, 15 - b).bitwiseAND(F.lit(1).cast("long"))
            place = place.bitwiseOR(F.shiftleft(bit, len(keys) * bits - 1 - b * len(keys) - i))
    return place


def write_fact_clustered(
    fact: DataFrame,
    path: str,
    keys: Sequence[str] | Mapping[str, Column] = LOOKUP_KEYS,
    date_col: str = "scraped_date",
    row_group_bytes: int = 16 << 20,
    finish: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """The fact laid out for lookups by any of ``keys`` inside a month (S16,
    in place of an index per key): partitioned by (year, month), a month's rows
    along the Z-order curve of the keys.  Each row group then covers a small
    range of every key, and its statistics rule it out for most lookups.

    The ranges are sampled on the curve and the fact's unique key, so a month,
    or one host in it, that holds a third of the rows is cut into many.

    As in ``write_fact_partitioned``, ``finish`` adds columns that need not be
    shuffled; ``keys`` then maps each key to the expression that it is made
    with."""
    order = ["year", "month", "__place", "listing_id", date_col]
    period = {"year": F.year(date_col), "month": F.month(date_col)}
    place = interleaved(list(keys.values()) if isinstance(keys, Mapping) else keys)
    # the place is made again of the shuffled rows: it is a function of them
    laid = fact.repartitionByRange(*period.values(), place, "listing_id", date_col)
    laid = (finish(laid) if finish else laid).withColumns(period).withColumn("__place", interleaved(list(keys)))
    laid = laid.sortWithinPartitions(*order).drop("__place")
    writer = laid.write.mode("overwrite").option("compression", CODEC).option("parquet.block.size", str(row_group_bytes))
    writer.partitionBy("year", "month").parquet(path)
    return fact.sparkSession.read.parquet(path)
