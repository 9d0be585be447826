"""Shard assignment by jump consistent hashing, in DataFrame functions alone.

A document's id decides its shard together with the number of shards; no ring
or table is kept.  With one more shard, a document either stays or moves to
the new shard, and only the fraction that the new shard needs moves.

Defined cases: an id that is no integer counts by its 64-bit hash; a null id hashes as its own key and so shares one shard; the
size of a null text is 1 and its checksum that of the empty text; repeated
rows share a shard and take slots of their own; other columns are left alone;
an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from staylens.llm.common import conf_int, cut

_LOW32 = 0xFFFFFFFF
#: Fixed value: the multiplier of the published generator.
MULTIPLIER = 2862933555777941757
#: Slots that one array holds.
RUN = 10_000


def _times32(x: Column, y: int) -> Column:
    """x * y modulo 2^32 for x, y below 2^32 (no step reaches 2^63)."""
    high = (x * F.lit(y >> 16)).bitwiseAND(F.lit(0xFFFF)) * F.lit(1 << 16)
    return (high + x * F.lit(y & 0xFFFF)).bitwiseAND(F.lit(_LOW32))


def _next(high: Column, low: Column) -> tuple[Column, Column]:
    """key * MULTIPLIER + 1 modulo 2^64, on halves of 32 bits."""
    m_high, m_low = MULTIPLIER >> 32, MULTIPLIER & _LOW32
    p = low * F.lit(m_low & 0xFFFF) + F.lit(1)
    q = low * F.lit(m_low >> 16)
    part = p.bitwiseAND(F.lit(_LOW32)) + q.bitwiseAND(F.lit(0xFFFF)) * F.lit(1 << 16)
    carry = F.shiftright(p, 32) + F.shiftright(q, 16) + F.shiftright(part, 32)
    new_high = (carry + _times32(low, m_high) + _times32(high, m_low)).bitwiseAND(F.lit(_LOW32))
    return new_high, part.bitwiseAND(F.lit(_LOW32))


def jump_shard(key: Column, shards: int) -> Column:
    """The shard (0 to ``shards`` - 1) of a 64-bit integer key, as an int.
    The published loop jumps ahead while the next bucket is below ``shards``;
    it ends after at most ``shards`` jumps, which bounds the fold here."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    key = F.coalesce(key.cast("long"), F.lit(-1).cast("long"))
    start = F.struct(
        F.shiftrightunsigned(key, 32).alias("high"),
        key.bitwiseAND(F.lit(_LOW32)).alias("low"),
        F.lit(-1).cast("long").alias("b"),
        F.lit(0).cast("long").alias("j"),
    )

    def jump(s: Column, _: Column) -> Column:
        high, low = _next(s["high"], s["low"])
        ratio = F.lit(float(1 << 31)) / (F.shiftright(high, 1) + F.lit(1)).cast("double")
        ahead = F.floor((s["j"] + F.lit(1)).cast("double") * ratio).cast("long")
        moved = F.struct(high.alias("high"), low.alias("low"), s["j"].alias("b"), ahead.alias("j"))
        return F.when(s["j"] < F.lit(shards), moved).otherwise(s)

    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, jump, lambda s: s["b"].cast("int"))


def shard_key(docs: DataFrame, id_col: str) -> Column:
    """The id as a 64-bit key: an integer itself, any other type by its hash."""
    whole = isinstance(docs.schema[id_col].dataType, T.IntegralType)
    return F.col(id_col) if whole else F.when(F.col(id_col).isNotNull(), F.xxhash64(id_col))


def with_shard(docs: DataFrame, shards: int, id_col: str = "doc_id", out: str = "shard") -> DataFrame:
    """``docs`` with the column ``out`` (a column of that name is replaced)."""
    return docs.withColumn(out, jump_shard(shard_key(docs, id_col), shards))


def shard_slots(docs: DataFrame, shards: int, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, size, text_crc32, law, shard, slot, grown_shard`` per row.

    Equal rows are counted before the shuffle and expanded at the end, so a
    hot id is one row in between.  Slots come from running sums inside slices
    of a shard (by a hash of the id; as many slices as shuffle partitions)
    plus the totals of the slices before."""
    slices = conf_int(docs.sparkSession, "spark.sql.shuffle.partitions", 200)
    digest = docs.select(
        F.col(id_col).alias("id"),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1).alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    # written once: both uses below would read the texts again
    counted = cut(digest.groupBy("id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("n")), "digests")
    placed = counted.select(
        "*",
        jump_shard(shard_key(counted, "id"), shards).alias("shard"),
        jump_shard(shard_key(counted, "id"), shards + 1).alias("grown_shard"),
        F.pmod(F.xxhash64("id", "text_crc32"), F.lit(slices)).alias("slice"),
    )
    inside = Window.partitionBy("shard", "slice").orderBy("id", "text_crc32", "size").rowsBetween(Window.unboundedPreceding, -1)
    numbered = placed.withColumn("own", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    before = Window.partitionBy("shard").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("shard", "slice").agg(F.sum("n").alias("total"))
    bases = totals.select("shard", "slice", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    # a row that is repeated very often is expanded in runs, so that no array is long
    runs = numbered.join(bases, ["shard", "slice"]).select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / RUN))).alias("run")
    )
    first = F.col("base") + F.col("own") + F.col("run") * RUN
    last = F.least(first + RUN, F.col("base") + F.col("own") + F.col("n")) - 1
    return runs.select(
        F.col("id").alias(id_col), "size", "text_crc32", F.lit("key").alias("law"), "shard",
        F.explode(F.sequence(first, last)).alias("slot"), "grown_shard",
    )
