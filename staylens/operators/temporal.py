"""Point-in-time (temporal) join against an SCD2 history.

``fact LEFT JOIN history ON key = key AND date within [valid_from, valid_to]``
with the open end replaced by an explicit ``as_of`` date (the source system
used the wall clock; a parameter keeps runs reproducible).

Planned as an equi-join on the key with the interval as a residual
condition: the number of versions per key is small, so the residual is
checked against a handful of rows per fact row.  A hot key on the fact side
is split by AQE's skew-join handling (left side of a left outer join).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.operators.scd2 import VALID_FROM, VALID_TO


def open_end(as_of: _dt.date | str | None) -> Column:
    """The date up to which open versions hold; None is the run's date."""
    return F.current_date() if as_of is None else F.lit(as_of).cast("date")


def interval_condition(
    date_col, valid_from, valid_to, as_of: _dt.date | str | None, closed: bool = False
):
    """``closed``: ``d BETWEEN from AND coalesce(to, as_of)`` — the source
    system's form; a date equal to a boundary matches two versions.
    half-open (default): ``from <= d < to``, and ``d <= as_of`` for the open
    version — each date matches at most one version."""
    as_of_lit = open_end(as_of)
    if closed:
        return date_col.between(valid_from, F.coalesce(valid_to, as_of_lit))
    return (date_col >= valid_from) & F.when(
        valid_to.isNull(), date_col <= as_of_lit
    ).otherwise(date_col < valid_to)


def temporal_left_join(
    fact: DataFrame,
    history: DataFrame,
    fact_key: str,
    history_key: str,
    date_col: str,
    columns: Sequence[str],
    as_of: _dt.date | str | None,
    closed: bool = False,
    bucket: str | None = "year",
) -> DataFrame:
    """Attach ``columns`` of the version valid at ``fact[date_col]``.

    ``bucket`` ('year', 'quarter', 'month' or None) bucketizes the range: each
    version is listed once per calendar bucket its interval overlaps, and the
    join is an equi-join on (key, bucket) plus the interval check.  A fact row
    is then only compared with the versions overlapping its own bucket, so a
    key with thousands of versions costs (facts x versions per bucket), not
    (facts x all versions) — a range join without all-pairs work.  The version
    list grows by at most the number of buckets a version spans.
    """
    h = history.select(
        F.col(history_key).alias("__h_key"),
        F.col(VALID_FROM).alias("__h_from"),
        F.col(VALID_TO).alias("__h_to"),
        *[F.col(c).alias(c) for c in columns],
    )
    as_of_lit = open_end(as_of)
    cond = (F.col(fact_key) == F.col("__h_key")) & interval_condition(
        F.col(date_col), F.col("__h_from"), F.col("__h_to"), as_of, closed
    )
    if bucket is None:
        return fact.join(h, cond, "left").drop("__h_key", "__h_from", "__h_to")
    step = {"year": "1 year", "quarter": "3 months", "month": "1 month"}[bucket]
    # the last day a version can match: its end (closed) / the day before it
    # (half-open; the end's own bucket is kept, the check decides), or as_of
    last = F.coalesce(F.col("__h_to"), as_of_lit)
    buckets = F.sequence(
        F.date_trunc(bucket, F.col("__h_from")).cast("date"),
        F.date_trunc(bucket, F.greatest(last, F.col("__h_from"))).cast("date"),
        F.expr(f"interval {step}"),
    )
    # versions without a start never match (the interval check is NULL)
    hb = h.where(F.col("__h_from").isNotNull()).withColumn("__bucket", F.explode(buckets))
    fb = fact.withColumn("__bucket", F.date_trunc(bucket, F.col(date_col)).cast("date"))
    cond = cond & (F.col("__bucket_f") == F.col("__bucket"))
    joined = fb.withColumnRenamed("__bucket", "__bucket_f").join(hb, cond, "left")
    return joined.drop("__h_key", "__h_from", "__h_to", "__bucket", "__bucket_f")
