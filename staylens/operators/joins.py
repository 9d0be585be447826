"""Join shapes beyond a plain equi-join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.functions.expressions import concat_key, normalize_text


def left_join_normalized(
    left: DataFrame, right: DataFrame, left_col: str, right_col: str, right_cols: list[str]
) -> DataFrame:
    """``LEFT JOIN ON lower(trim(l.x)) = lower(trim(r.y))`` with the key
    computed once per side as a column (J2)."""
    r = right.select(normalize_text(right_col).alias("__nk"), *right_cols)
    return left.withColumn("__nk", normalize_text(left_col)).join(r, "__nk", "left").drop("__nk")


def join_concat_key(
    left: DataFrame,
    right: DataFrame,
    prefix: str,
    code_col: str,
    right_key: str,
    how: str = "left",
) -> DataFrame:
    """``JOIN ON prefix || l.code = r.key`` (J3 left, J4 inner); a NULL code
    never matches."""
    r = right.withColumnRenamed(right_key, "__ck")
    return left.withColumn("__ck", concat_key(prefix, code_col)).join(r, "__ck", how).drop("__ck")


def full_outer_small_right(
    big: DataFrame, small: DataFrame, big_key: str, small_key: str
) -> DataFrame:
    """``big FULL OUTER JOIN small ON big.k = small.k`` for a small right side.

    Same rows as the full outer join, planned as
    ``big LEFT JOIN small`` (broadcastable: the big side is not shuffled, so a
    hot key cannot pile up in one task) ``UNION ALL`` the small rows whose key
    no big row has (anti join against the *distinct* big keys, which partial
    aggregation shrinks before the shuffle).
    """
    small_cols = [c for c in small.columns]
    left_part = big.join(small, big[big_key] == small[small_key], "left")
    big_keys = big.select(F.col(big_key).alias("__k")).where(F.col("__k").isNotNull()).distinct()
    unmatched = small.join(big_keys, small[small_key] == big_keys["__k"], "left_anti")
    big_nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in big.schema.fields]
    right_part = unmatched.select(*big_nulls, *[F.col(c) for c in small_cols])
    return left_part.unionByName(right_part)


def semi_join_in(df: DataFrame, subquery: DataFrame, key: str, sub_key: str | None = None) -> DataFrame:
    """``WHERE key IN (SELECT sub_key ...)`` as a LEFT SEMI join.
    NULL keys never match, as with IN."""
    sub_key = sub_key or key
    s = subquery.select(F.col(sub_key).alias("__sk"))
    return df.join(s, df[key] == s["__sk"], "left_semi")


def scalar_of(one_value: DataFrame):
    """A one-row, one-column aggregate as a scalar-subquery ``Column``.

    Spark runs the subquery once and substitutes its value; no join, no
    broadcast of anything that grows with the data."""
    return one_value.scalar()


def left_join_null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """LEFT JOIN on ``keys`` where NULL matches NULL (``<=>``): joining two
    aggregates of the same frame back together, a NULL group key is a real
    group.  Spark plans null-safe equality as an ordinary equi-join key."""
    r = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    on = [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys]
    return left.join(r, on, "left").drop(*[f"__r_{k}" for k in keys])
