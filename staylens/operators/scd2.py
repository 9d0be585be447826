"""Type-2 slowly changing dimension, timestamp strategy.

A version is the tracked attributes of a key plus a validity interval
``[valid_from, valid_to)``; the open (current) version has ``valid_to`` NULL.
A source row opens a new version when its ``updated_at`` is later than the
open version's; the open version is then closed at that instant.  Keys missing
from a batch stay open.  A NULL ``updated_at`` is never "later".

Three entry points:

* ``scd2_merge``   — apply one batch to the current history (incremental run);
* ``scd2_splice``  — apply one batch that may hold late versions;
* ``scd2_rebuild`` — build the whole history from every observed attribute
  tuple at once (``lead`` over the versions of a key).

All shuffle once on the key.  Closed versions are never rewritten by a merge;
only open versions meet the batch.  A splice reads the closed versions too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

VALID_FROM = "valid_from"
VALID_TO = "valid_to"


def _tiebreak(tracked: Sequence[str]):
    return [F.col(c).asc_nulls_last() for c in tracked]


def scd2_rebuild(
    rows: DataFrame,
    key: Sequence[str],
    updated_at: str,
    tracked: Sequence[str],
) -> DataFrame:
    """History from all distinct (key, tracked..., updated_at) tuples.

    Versions of a key are ordered by ``updated_at`` (NULLs first, then the
    tracked columns as a tie-breaker); each closes where the next one opens.
    """
    cols = list(dict.fromkeys([*key, *tracked, updated_at]))
    versions = rows.select(*cols).where(F.col(key[0]).isNotNull()).distinct()
    w = Window.partitionBy(*key).orderBy(
        F.col(updated_at).asc_nulls_first(), *_tiebreak([c for c in tracked if c != updated_at])
    )
    return versions.withColumn(VALID_FROM, F.col(updated_at)).withColumn(
        VALID_TO, F.lead(F.col(updated_at)).over(w)
    )


def scd2_merge(
    current: DataFrame | None,
    batch: DataFrame,
    key: Sequence[str],
    updated_at: str,
    tracked: Sequence[str],
) -> DataFrame:
    """Apply one batch to the history ``current`` (None = first run).

    Every version in the batch is applied, in ``updated_at`` order: the ones
    later than the open version each close their predecessor, so the history
    is the same however rows are dealt to batches, as long as none comes late.
    Rows of a key with one ``updated_at`` are one version (the first by the
    tracked columns); an undated row opens a version only for a key that has
    no other row.
    """
    cols = list(dict.fromkeys([*key, *tracked, updated_at]))
    fresh = batch.select(*cols).where(F.col(key[0]).isNotNull()).distinct()
    rows = fresh.withColumn(VALID_FROM, F.col(updated_at)).withColumn("__new", F.lit(1))
    if current is not None:
        held = current.where(F.col(VALID_TO).isNull()).select(*cols, VALID_FROM)
        rows = rows.unionByName(held.withColumn("__new", F.lit(0)))

    # open versions and new ones meet in one shuffle; all windows share it
    order = _tiebreak([c for c in tracked if c != updated_at])
    of_date = Window.partitionBy(*key, "__new", VALID_FROM).orderBy(*order)
    rows = rows.repartition(*key).withColumn("__nth", F.row_number().over(of_date))
    rows = rows.where((F.col("__new") == 0) | (F.col("__nth") == 1)).drop("__nth")
    of_key = Window.partitionBy(*key)
    opened = F.when(F.col("__new") == 0, F.col(VALID_FROM))
    met = rows.select(
        "*",
        F.min("__new").over(of_key).alias("__first_seen"),
        F.max(opened).over(of_key).alias("__open"),
        F.count(VALID_FROM).over(of_key).alias("__dated"),
    )
    later = F.coalesce(F.col(VALID_FROM) > F.col("__open"), F.lit(False))
    fresh = (F.col("__first_seen") == 1) & (F.col(VALID_FROM).isNotNull() | (F.col("__dated") == 0))
    in_order = of_key.orderBy("__new", VALID_FROM)
    out = met.where((F.col("__new") == 0) | later | fresh).select(
        *cols, VALID_FROM, F.lead(VALID_FROM).over(in_order).alias(VALID_TO)
    )
    if current is None:
        return out
    return out.unionByName(current.where(F.col(VALID_TO).isNotNull()).select(*out.columns))


def scd2_splice(
    current_open: DataFrame | None,
    current_closed: DataFrame | None,
    batch: DataFrame,
    key: Sequence[str],
    updated_at: str,
    tracked: Sequence[str],
) -> DataFrame:
    """What one batch makes of a history, late versions included: every open
    version after it, and the closed versions that are new or end earlier than
    before.  A version that is older than the open one is placed into the
    closed history, where it splits the interval that holds its date.

    A version is a distinct (key, tracked..., updated_at) tuple, as in
    ``scd2_rebuild``, to which any order of batches leads: overlay the closed
    rows on the earlier ones of the same version.  ``current_closed`` may hold
    those earlier ones too: of a version's rows the highest ``step`` counts.
    """
    cols = list(dict.fromkeys([*key, *tracked, updated_at]))
    order = [F.col(updated_at).asc_nulls_first(), *_tiebreak([c for c in tracked if c != updated_at])]
    no_end = F.lit(None).cast(batch.schema[updated_at].dataType)

    def seen(df: DataFrame, kind: str, end=no_end, step=F.lit(0)) -> DataFrame:
        flags = [F.lit(k == kind).alias(f"__{k}") for k in ("fresh", "open", "closed")]
        return df.select(*cols, end.alias("__end"), step.cast("int").alias("__step"), *flags)

    rows = seen(batch.select(*cols).where(F.col(key[0]).isNotNull()).distinct(), "fresh", step=F.lit(None))
    if current_open is not None:
        rows = rows.unionByName(seen(current_open, "open", step=F.lit(None)))
    if current_open is not None and current_closed is not None:
        step = F.col("step") if "step" in current_closed.columns else F.lit(0)
        rows = rows.unionByName(seen(current_closed, "closed", F.col(VALID_TO), step))
    # one shuffle, on the key; one row per version: what the history had of it
    versions = rows.repartition(*key).groupBy(*cols).agg(
        *[F.max(f"__{k}").alias(f"__{k}") for k in ("fresh", "open", "closed")], F.max_by("__end", "__step").alias("__end")
    )
    # late: not after the open version of its key, and not that version (a key
    # that the history does not know has no open version; undated versions may
    # be open beside a dated one)
    of_key = Window.partitionBy(*key)
    opened = F.max(F.when(F.col("__open"), F.col(updated_at))).over(of_key)
    others = F.count(F.when(F.col("__open"), F.lit(1))).over(of_key) - F.col("__open").cast("int")
    before = ~F.col("__open") & F.coalesce(F.col(updated_at) <= opened, F.lit(False))
    late = F.col("__fresh") & F.when(F.col(updated_at).isNull(), others > 0).otherwise(before)
    met = versions.withColumn("__late_row", late).withColumn("__late", F.max("__late_row").over(of_key))
    # only keys with a late version take part with their closed history
    met = met.where(F.col("__fresh") | F.col("__open") | F.col("__late"))
    held = F.col("__open") | (F.col("__late") & F.col("__closed"))
    w = of_key.orderBy(*order)
    out = met.withColumn(VALID_FROM, F.col(updated_at)).withColumn(VALID_TO, F.lead(F.col(updated_at)).over(w))
    end = F.when(F.col("__late"), F.col("__end"))
    changed = F.col(VALID_TO).isNull() | ~held | ~F.col(VALID_TO).eqNullSafe(end)
    return out.where(changed).select(*cols, VALID_FROM, VALID_TO)
