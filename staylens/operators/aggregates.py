"""Aggregate expressions the built-ins do not give directly.

All are declarative ``Column`` aggregates, so Spark plans them as partial
(map-side) + final hash aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from staylens.functions.expressions import ColumnOrName, _c


def times(c: ColumnOrName, copies: ColumnOrName | None) -> Column:
    """``c``, once for each of the row's ``copies`` (None: one)."""
    return _c(c) if copies is None else _c(c) * _c(copies)


def count_copies(c: ColumnOrName, copies: ColumnOrName | None = None) -> Column:
    """COUNT(c) over rows that stand for ``copies`` equal ones (None: one)."""
    if copies is None:
        return F.count(_c(c))
    return F.coalesce(F.sum(F.when(_c(c).isNotNull(), _c(copies))), F.lit(0).cast("long"))


def exact_avg(c: ColumnOrName, copies: ColumnOrName | None = None) -> Column:
    """AVG of a DECIMAL without decimal-division rounding: exact decimal SUM
    over the non-NULL count, divided once in DOUBLE.  NULL for no values."""
    return F.sum(times(c, copies)).cast("double") / F.nullif(count_copies(c, copies), F.lit(0)).cast("double")


def median(c: ColumnOrName) -> Column:
    """Exact continuous median (PERCENTILE_CONT(0.5)), NULLs skipped, as an
    aggregate expression.

    Spark's ``percentile`` buffers a value -> count map per group and merges
    maps across partitions in one task, so it suits groups with a bounded
    number of distinct values; for groups that may hold a large share of all
    rows use ``median_by``."""
    return F.percentile(_c(c).cast("double"), F.lit(0.5))


def corr_safe(x: ColumnOrName, y: ColumnOrName) -> Column:
    """Pearson correlation that is NULL (not an error) for zero variance or a
    single pair.  Pairs with a NULL side are skipped, as CORR does."""
    x, y = _c(x).cast("double"), _c(y).cast("double")
    both = x.isNotNull() & y.isNotNull()
    xx, yy = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_pop(xx, yy), F.stddev_pop(xx) * F.stddev_pop(yy))


def string_agg_distinct(c: ColumnOrName, sep: str = ", ") -> Column:
    """STRING_AGG(DISTINCT x, sep) with a deterministic (sorted) order; NULL
    when the group has no non-NULL value.  Only for groups whose distinct
    values are bounded (a handful of LGAs or room types)."""
    c = _c(c)
    return F.when(F.count(c) > 0, F.array_join(F.array_sort(F.collect_set(c)), sep))


def round_ratio(part: ColumnOrName, total: ColumnOrName, digits: int = 2, scale: int = 100) -> Column:
    """``round(part * scale / nullif(total, 0), digits)`` for integer-valued
    operands, half away from zero, as exact NUMERIC arithmetic does.

    Operands are narrowed to DECIMAL(20,0) so the quotient keeps 16 fraction
    digits (no double rounding before the final ROUND), then DOUBLE."""
    num = _c(part).cast("decimal(18,0)") * F.lit(scale)
    den = F.nullif(_c(total), F.lit(0)).cast("decimal(20,0)")
    return F.round(num / den, digits).cast("double")


def round_avg(c: ColumnOrName, digits: int = 2) -> Column:
    """``round(avg(x), digits)`` of a DECIMAL(12,2), exact: decimal sum over
    the count with 18 fraction digits, then one half-up rounding."""
    c = _c(c)
    q = F.sum(c).cast("decimal(22,2)") / F.nullif(F.count(c), F.lit(0)).cast("decimal(20,0)")
    return F.round(q, digits).cast("double")


def count_if(cond: Column, copies: ColumnOrName | None = None) -> Column:
    """COUNT(CASE WHEN cond THEN 1 END)."""
    return count_copies(F.when(cond, F.lit(1)), copies)


def sum_if(cond: Column, value: ColumnOrName) -> Column:
    return F.sum(F.when(cond, _c(value)))


def min_if(cond: Column, value: ColumnOrName) -> Column:
    return F.min(F.when(cond, _c(value)))


def max_if(cond: Column, value: ColumnOrName) -> Column:
    return F.max(F.when(cond, _c(value)))


#: Ranges of values per natural logarithm: a range is 1.6 % of its values wide.
RANGES_PER_E = 64


def value_range(value: Column) -> Column:
    """The number of the range that a value lies in, ascending with it; ranges
    grow with the values, so they need no bounds of the data."""
    v = value.cast("double")
    # magnitudes from 1e-12 up; whatever is smaller shares the range of zero
    size = F.floor(F.ln(F.greatest(F.abs(v), F.lit(1e-12))) * RANGES_PER_E) + F.lit(2048)
    return F.when(v < 0, -size).otherwise(size)


def median_by(df, keys, value: str, out: str = "median", copies: str | None = None, few_groups: bool = False):
    """Exact continuous median of ``value`` per ``keys`` (PERCENTILE_CONT(0.5),
    NULLs skipped), as a DataFrame (keys..., out).  With ``copies`` a row
    stands for that many equal ones.

    By selection, in two passes: counts per range of values find the range or
    ranges with the two middle positions; only their values are then put in
    order.  So no task sees a group's values: the first pass gives it a count
    per range, the second one range in a hundred or fewer.  Both passes read
    the distinct (keys, value) counts, a map-side combine that they share;
    with ``few_groups`` (as many as a mart has rows, whatever the input's size)
    they read ``df`` itself instead: the middle ranges, two a group at most,
    are broadcast, and no row outside them is shuffled.
    Interpolation is ``(1 - d) * lo + d * hi`` with d = 0.5, the form Spark's
    ``percentile`` and DuckDB's ``quantile_cont`` use, bit for bit (``lo``
    exactly for an odd count).
    """
    from pyspark.sql import Window

    one = F.lit(1).cast("long") if copies is None else F.col(copies)
    rows = df.where(F.col(value).isNotNull())
    counts = rows.select(*keys, value, one.alias("__c")) if few_groups else rows.groupBy(*keys, value).agg(F.sum(one).alias("__c"))
    ranged = counts.withColumn("__range", value_range(F.col(value)))
    per_range = ranged.groupBy(*keys, "__range").agg(F.sum("__c").alias("__c"))
    run = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*keys)
    placed = per_range.withColumn("__cum", F.sum("__c").over(run)).withColumn("__n", F.sum("__c").over(whole))
    placed = placed.withColumn("__lo", F.floor((F.col("__n") - 1) / 2)).withColumn("__hi", F.ceil((F.col("__n") - 1) / 2))
    first = F.col("__cum") - F.col("__c")  # 0-based position of the range's first value
    middle = placed.where((first <= F.col("__hi")) & (F.col("__cum") > F.col("__lo")))
    middle = middle.select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col("__range").alias("__r"), first.alias("__first"), "__lo", "__hi"
    )
    on = F.col("__range") == F.col("__r")
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    values = F.struct(F.col(value).alias("v"), F.col("__c").alias("c"))
    of_range = [*keys, "__range", "__first", "__lo", "__hi"]
    if few_groups:
        met = ranged.join(F.broadcast(middle), on).groupBy(*of_range, value).agg(F.sum("__c").alias("__c"))
    else:
        met = ranged.join(middle, on)
    ranges = met.groupBy(*of_range).agg(F.array_sort(F.collect_list(values)).alias("__values"))

    def at(position: str) -> Column:
        """The value at a position of the group, if it lies in the range."""
        state = F.struct(F.col("__first").alias("seen"), F.lit(None).cast("double").alias("hit"))
        step = lambda s, x: F.struct(
            (s["seen"] + x["c"]).alias("seen"),
            F.when((s["seen"] <= F.col(position)) & (F.col(position) < s["seen"] + x["c"]), x["v"].cast("double")).otherwise(s["hit"]).alias("hit"),
        )
        return F.aggregate("__values", state, step, lambda s: s["hit"])

    picked = ranges.select(*keys, at("__lo").alias("__low"), at("__hi").alias("__high"))
    picked = picked.groupBy(*keys).agg(F.max("__low").alias("__low"), F.max("__high").alias("__high"))
    return picked.select(*keys, (F.col("__low") * F.lit(0.5) + F.col("__high") * F.lit(0.5)).alias(out))
