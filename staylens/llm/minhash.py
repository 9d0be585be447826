"""Near-duplicate documents by circulant MinHash.

A document's set holds its distinct five-word shingles.  Signature coordinate
k is the smallest value, over the set, of one permutation pi applied to
``sigma(shingle) + k``: two permutations in all, the second one circularly
shifted from coordinate to coordinate.  Bands of ``ROWS`` coordinates give
bucket keys, as many that a pair just similar enough for a link shares none
with a probability of at most ``MISSED`` (16 bands at 85 %, 22 at 80 %).  Links
are confirmed on full sets.

Equal sets are folded into one representative first.  A bucket is never
expanded into all its pairs: its members meet one leader, then the member with
the largest share of frequent shingles, and members that links have joined with each other need no
further look.  The pairs still open are those that share a rare shingle, or
that frequent shingles alone could link; set sizes and the triangle inequality
of the Jaccard distance exclude more of them, and the rest is compared.  So no
link between two components is lost.

Defined cases: a text that is null or has no words has an empty set and links
with nothing; with fewer than five words the whole sequence is one shingle;
every row of the input gives a row (repeated ids and rows stay); a null id
takes part by its text and is never ``kept``; an empty table gives an empty
result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from staylens.llm.common import LOWER, components, cut, fresh_name, mix64, text_chunks, tidy, word_spans

SHINGLE_WORDS = 5
COORDINATES = 64
ROWS = 4
#: Links need 100 * intersection >= percent * union; this unless given.
PERCENT = 85
#: Largest share of just similar pairs that may meet in no band.
MISSED = 1e-5
#: A shingle that at most so many open sets hold is rare.
RARE = 64
#: Bytes of text hashed at once (about 54 bytes of memory for each).
CHUNK_BYTES = 1 << 20

WORD = np.ones(256, bool)
WORD[0x20] = False
WORD[0x09:0x0E] = False

_ODD = np.uint64(0x9E3779B97F4A7C15)
_BYTE = mix64((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _ODD)
_BASE, _INVERSE = 0x5851F42D4C957F2D, pow(0x5851F42D4C957F2D, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """Per text its distinct shingles, as sorted 64-bit hashes."""
    for _, _, data, offsets in text_chunks(texts, CHUNK_BYTES):
        low = LOWER[data]
        starts, ends, before = word_spans(low, offsets, WORD)
        n = len(low) + 1
        up, down = _powers(_BASE, n), _powers(_INVERSE, n)
        total = np.zeros(n, np.uint64)
        np.cumsum(_BYTE[low] * up[:-1], out=total[1:])
        words = mix64((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64) * _ODD)
        k = SHINGLE_WORDS
        if len(words) >= k:
            m = len(words) - k + 1
            grams = np.full(m, 7, np.uint64)
            for j in range(k):
                grams = mix64(grams * _ODD + words[j : j + m])
        for a, b in zip(before[:-1].tolist(), before[1:].tolist(), strict=True):
            if b - a >= k:
                yield np.unique(grams[a : b - k + 1])
            elif b > a:
                whole = np.full(1, 11 + b - a, np.uint64)
                for j in range(a, b):
                    whole = mix64(whole * _ODD + words[j : j + 1])
                yield whole
            else:
                yield np.zeros(0, np.uint64)


def bands_for(percent: int) -> int:
    """Bands that miss a pair of that similarity in ``MISSED`` of cases at most."""
    return math.ceil(math.log(MISSED) / math.log1p(-((percent / 100) ** ROWS))) if percent < 100 else 1


def signature(shingles: np.ndarray, coordinates: int = COORDINATES) -> np.ndarray:
    """The circulant MinHash coordinates of one set (32-bit universe)."""
    sigma = (mix64(shingles ^ np.uint64(0xA5A5A5A5A5A5A5A5)) >> np.uint64(32)).astype(np.uint32)
    shifts = np.arange(coordinates, dtype=np.uint32)[:, None]
    least = np.full(coordinates, 0xFFFFFFFF, np.uint32)
    for a in range(0, len(sigma), 1024):
        x = sigma[None, a : a + 1024] + shifts  # the circular shift: addition modulo 2^32
        x ^= x >> np.uint32(16)  # pi: a bijection of the universe
        x *= np.uint32(0x85EBCA6B)
        x ^= x >> np.uint32(13)
        x *= np.uint32(0xC2B2AE35)
        x ^= x >> np.uint32(16)
        np.minimum(least, x.min(axis=1), out=least)
    return least


def _bands(coords: np.ndarray) -> list[int]:
    key = np.arange(len(coords) // ROWS, dtype=np.uint64)
    for j in range(ROWS):
        key = mix64(key * _ODD + coords[j::ROWS].astype(np.uint64))
    return key.view(np.int64).tolist()


def _set_key(shingles: np.ndarray) -> str:
    a = int(np.sum(mix64(shingles), dtype=np.uint64))
    b = int(np.sum(mix64(shingles ^ _ODD), dtype=np.uint64))
    return f"{a:016x}{b:016x}"


def _describe(coordinates: int) -> Callable[[Iterator[pa.Array]], Iterator[pa.Array]]:
    def describe(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in parts:
            n, keys, bands = [], [], []
            for s in shingle_sets(texts):
                n.append(len(s))
                keys.append(_set_key(s) if len(s) else None)
                bands.append(_bands(signature(s, coordinates)) if len(s) else [])
            yield pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(keys, pa.string()), pa.array(bands, pa.list_(pa.int64()))], ["n", "key", "bands"])

    return describe


def _full_set(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in parts:
        keys, sets = [], []
        for s in shingle_sets(texts):
            keys.append(_set_key(s) if len(s) else None)
            sets.append(s.view(np.int64))
        yield pa.StructArray.from_arrays([pa.array(keys, pa.string()), pa.array(sets, pa.list_(pa.int64()))], ["key", "shingles"])


def _fits(a: str, b: str, percent: int):
    """Set sizes that allow a link."""
    return F.lit(100) * F.least(a, b) >= F.lit(percent) * F.greatest(a, b)


def _compare(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``a, b, similar (double), linked`` of the pairs of set keys."""
    right = pairs.join(sets.select(F.col("key").alias("b"), F.col("shingles").alias("sb")), "b")
    both = right.join(sets.select(F.col("key").alias("a"), F.col("shingles").alias("sa")), "a")
    common = F.size(F.array_intersect("sa", "sb")).cast("long")
    union = F.size("sa") + F.size("sb") - common
    return both.select("a", "b", common.alias("i"), union.alias("u")).select(
        "a", "b", (F.col("i") / F.col("u")).alias("similar"), (F.lit(100) * F.col("i") >= F.lit(percent) * F.col("u")).alias("linked")
    )


def _grouped(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Members of the buckets that still hold several components, with ``root``."""
    placed = members.join(roots.select(F.col("node").alias("key"), "root"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    open_ = placed.groupBy("bucket").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x < y").select("bucket")
    return cut(placed.join(open_, "bucket"), "open")


def _apart(x: str, y: str, percent: int):
    """Distances to the bucket's first leader that exclude a link."""
    return F.coalesce(F.abs(F.col(x) - F.col(y)) > F.lit(1 - percent / 100 + 1e-9), F.lit(False))


def _open_shingles(left: DataFrame, full: DataFrame) -> DataFrame:
    """``key, n, shingle, sets`` of the open sets: the shingles that more than
    one of them holds, and how many do."""
    nodes = left.select("key", "n").distinct()
    flat = full.join(nodes, "key").select("key", "n", F.explode("shingles").alias("shingle"))
    counts = flat.groupBy("shingle").agg(F.count(F.lit(1)).alias("sets")).where("sets > 1")
    return cut(flat.join(counts, "shingle"), "shingles")


def _open_pairs(left: DataFrame, first: DataFrame, flat: DataFrame, frequent: DataFrame, percent: int) -> DataFrame:
    """``a, b``: every pair of open sets, in different components of a bucket,
    that may still have a link.

    With the shingles of each set in order of the number of open sets that
    hold them, linked sets have a common shingle among the first
    ``n - percent n / 100 + 1`` of both.  Either that shingle is rare (at most
    ``RARE`` sets hold it: few pairs per shingle), or both sets have enough
    frequent ones for the intersection that their sizes ask for; of the
    latter, the triangle inequality excludes more."""
    # a set's shingles that no other one holds come first
    of_set = Window.partitionBy("key")
    alone = F.col("n") - F.count(F.lit(1)).over(of_set)
    place = F.row_number().over(of_set.orderBy("sets", "shingle")) + alone
    first_ones = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    early = flat.withColumn("early", place <= first_ones).where("early").where(F.col("sets") <= RARE)

    def side(df: DataFrame, by: str, suffix: str, *cols: str) -> DataFrame:
        return df.select(by, *[F.col(c).alias(f"{c}_{suffix}") for c in cols])

    ordered = (F.col("key_x") < F.col("key_y")) & (F.col("root_x") != F.col("root_y")) & _fits("n_x", "n_y", percent)
    pair = [F.col("key_x").alias("a"), F.col("key_y").alias("b")]
    rare = early.join(left.select("key", "root").distinct(), "key")
    cols = ("key", "root", "n")
    met = side(rare, "shingle", "x", *cols).join(side(rare, "shingle", "y", *cols).withColumnRenamed("shingle", "s"), (F.col("shingle") == F.col("s")) & ordered).select(*pair)

    near = left.join(frequent, "key").join(first.select(F.col("a").alias("leader"), F.col("b").alias("key"), "similar"), ["leader", "key"], "left")
    near = near.withColumn("similar", F.when(F.col("key") == F.col("leader"), 1.0).otherwise(F.col("similar")))
    # a link needs an intersection of percent / (100 + percent) of both sizes together
    enough = F.lit(100 + percent) * F.least("frequent_x", "frequent_y") >= F.lit(percent) * (F.col("n_x") + F.col("n_y"))
    near = near.where(F.lit(100 + percent) * F.col("frequent") >= F.lit(percent) * (F.col("n") + F.ceil(F.col("n") * percent / 100)))
    cols = ("key", "root", "n", "similar", "frequent")
    alike = side(near, "bucket", "x", *cols).join(side(near, "bucket", "y", *cols).withColumnRenamed("bucket", "s"), (F.col("bucket") == F.col("s")) & ordered & enough & ~_apart("similar_x", "similar_y", percent)).select(*pair)
    return met.union(alike).distinct()


def _joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``(node, root)`` with more links: components found before go in as one
    link from each node to its root, so few rounds are left."""
    return components(roots.where("node <> root").select(F.col("root").alias("a"), F.col("node").alias("b")).union(links.select("a", "b")))


def _roots(sets: DataFrame, docs: DataFrame, id_col: str, text: str, percent: int) -> DataFrame:
    """``(node, root)``: the components of the set keys that have links."""
    buckets = sets.select("key", "n", F.explode("bands").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.min("key").alias("leader"), F.min_by("n", "key").alias("leader_n")).where("size > 1")
    members = cut(buckets.join(shared.drop("size"), "bucket"), "members")

    # the full sets of the members: one text each
    wanted = members.select("key").distinct().join(sets.select("key", F.col("label").alias("w")), "key")
    texts = docs.select(F.col(id_col).alias("i"), F.col(text).alias("t"))
    found = texts.join(wanted, F.col("i").eqNullSafe(F.col("w"))).select("key", F.arrow_udf(tidy(_full_set), "key string, shingles array<long>")("t").alias("s"))
    full = cut(found.where("s.key = key").select("key", F.col("s.shingles").alias("shingles")).dropDuplicates(["key"]), "sets")

    pairs = members.where("key <> leader").where(_fits("n", "leader_n", percent)).select(F.col("leader").alias("a"), F.col("key").alias("b")).distinct()
    first = cut(_compare(pairs, full, percent), "compared")
    roots = components(first.where("linked").select("a", "b"))
    left = _grouped(members, roots)
    if left.isEmpty():
        return roots
    flat = _open_shingles(left, full)
    frequent = flat.where(F.col("sets") > RARE).groupBy("key").agg(F.count(F.lit(1)).alias("frequent"))
    # in a group of edited copies the original has the largest share of frequent shingles
    share = F.struct(F.coalesce(F.col("frequent"), F.lit(0)) / F.col("n"), "key")
    nearest = left.join(frequent, "key", "left").groupBy("bucket").agg(F.max_by(F.struct(F.col("key").alias("a"), F.col("n").alias("an"), F.col("root").alias("ar")), share).alias("l"))
    pairs = left.join(nearest.select("bucket", "l.*"), "bucket").where("root <> ar").where(_fits("n", "an", percent))
    pairs = pairs.select(F.least("a", "key").alias("a"), F.greatest("a", "key").alias("b")).distinct().join(first.select("a", "b"), ["a", "b"], "left_anti")
    new = cut(_compare(pairs, full, percent), "compared")
    done = first.select("a", "b").union(new.select("a", "b"))
    roots = _joined(roots, new.where("linked"))
    left = _grouped(members, roots)
    if left.isEmpty():
        return roots
    pairs = _open_pairs(left, first, flat, frequent, percent).join(done.select("a", "b"), ["a", "b"], "left_anti")
    return _joined(roots, _compare(pairs, full, percent).where("linked"))


def _placed(docs: DataFrame, id_col: str, text: str, percent: int) -> DataFrame:
    """``id, digest (of the text), n, key, component_id, stays (the one key of
    the component that its smallest id stands for)`` for every row of ``docs``."""
    describe = _describe(bands_for(percent) * ROWS)
    described = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("digest"), F.arrow_udf(tidy(describe), "n long, key string, bands array<long>")(text).alias("s"))
    sigs = cut(described.select("id", "digest", "s.*"), "signatures")
    sets = cut(sigs.where("n > 0").groupBy("key", "n", "bands").agg(F.min("id").alias("label")), "classes")
    roots = _roots(sets, docs, id_col, text, percent)
    grouped = sets.select("key", "label").join(roots.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    least = F.min(F.when(F.col("label").isNotNull(), F.struct("label", "key")))["key"]
    labels = grouped.groupBy("root").agg(F.min("label").alias("component_id"), least.alias("stays"))
    of_set = grouped.join(labels, "root").select("key", "component_id", "stays")
    # rows with an empty set would all share the null key: a key of their own keeps them apart
    return sigs.select("id", "digest", "n", "key").join(of_set, "key", "left")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """``id_col, n_shingles, component_id, kept`` for every row of ``docs``."""
    rows = _placed(docs, id_col, text, percent)
    component = F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component_id"))
    return rows.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(False))
    )


def remove_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row of ``docs`` for each group of near-duplicates: of its smallest
    id, where several rows have that, one of them.  Rows are judged by id and
    text, so another text under the same id is judged by itself.  Rows with
    an empty set or a null id (it cannot stand for a group) are never dropped."""
    rows = _placed(docs, id_col, text, percent).where((F.col("n") > 0) & F.col("id").isNotNull())
    texts = rows.groupBy("id", "key", "digest", "component_id", "stays").agg(F.count(F.lit(1)).alias("copies"))
    least = F.min("digest").over(Window.partitionBy("id", "key"))
    stays = (F.col("id") == F.col("component_id")) & (F.col("key") == F.col("stays")) & (F.col("digest") == least)
    # names that no column of the rows has
    row_id, row_digest, row_n = (fresh_name(c, docs.columns) for c in ("_id", "_digest", "_n"))
    judged = texts.select(F.col("id").alias(row_id), F.col("digest").alias(row_digest), "copies", stays.alias("stays"))
    judged = cut(judged.where("not stays or copies > 1"), "judged")
    of_row = (F.col(id_col) == F.col(row_id)) & (F.xxhash64(text) == F.col(row_digest))
    out = docs.join(judged.where("not stays").select(row_id, row_digest), of_row, "left_anti")
    several = judged.where("stays").select(row_id, row_digest)
    if several.isEmpty():
        return out
    order = F.xxhash64(*[c for c, kind in docs.dtypes if "map<" not in kind])
    first = F.row_number().over(Window.partitionBy(id_col, F.xxhash64(text)).orderBy(order))
    one = out.join(several, of_row, "left_semi").withColumn(row_n, first).where(F.col(row_n) == 1).drop(row_n)
    return out.join(several, of_row, "left_anti").unionByName(one)
