"""Prefix trie of conversations, as balanced parentheses per shard.

Conversations that begin with the same turns share a prefix; every distinct
prefix is a node.  ``trie`` gives each node's members, children, leaves and
the bytes that sharing saves in its subtree.

1. Each conversation's turns are chained in order: the key of a prefix is a
   hash of its parent's key and its last turn.  Texts never leave their scan.
2. Equal keys are counted (map-side first), which gives the nodes.
3. Nodes are range-partitioned in depth-first order and cut into shards of at
   most ``SHARD_NODES``.  A shard writes its part of the trie as balanced
   parentheses, with the spine that leads to its first node; the excess has
   minima per block in a tree (range min-max), by which findclose skips to a
   node's end.  Between open and close, leaf pairs are counted by rank, savings
   taken from cumulative sums.
4. A spine node's parts from several shards are added to its own shard's.

Paths for the depth-first order are kept to ``TIER_DEPTH`` levels: deeper nodes
hang off the node at the tier's end as a trie of their own, whose totals reach
the nodes above by pointer doubling over the tiers.  So neither a sort key nor
a spine grows with the longest conversation.

One conversation is chained by one task, which streams its turns and holds one
key per level of a tier.  A node's list of ended conversations is packed in
parallel and then hashed in one stream, as SHA-256 asks.

Defined cases: a null role or text counts as empty; a null turn comes first and
equal turns go by the SHA-256 of role and text; repeated rows are repeated
turns; rows without a ``conv_id`` belong to no conversation; a conversation
without turns is a member of the root; other columns are left alone; an empty
table has no node.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from staylens.llm.common import cut

#: Nodes that one shard encodes, levels of a tier, positions of one minimum.
SHARD_NODES = 1 << 16
TIER_DEPTH = 64
BLOCK = 64
#: Characters of packed ids handed on at once.
PACKED_CHARS = 1 << 16

_KEY = 16
ROOT = bytes(_KEY)


# --- conversations ----------------------------------------------------------------


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, part, pos, digest, n_bytes`` of every turn, ``pos`` from 1."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turn_digest = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", turn_digest.alias("digest"), F.octet_length(text).cast("long").alias("n_bytes")
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "digest")
    return rows.select("conv_id", F.lit(1).alias("part"), F.row_number().over(order).cast("long").alias("pos"), "digest", "n_bytes")


def rebuilt_turns(turns: DataFrame) -> DataFrame:
    """From ``ordered_turns``, with a head row (part -1) per conversation: the
    first h turns of conversation c - c % 5, then c's own after its first h;
    h is the CRC-32 of c in decimal, modulo 9."""
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
    convs = turns.select("conv_id").distinct().select("conv_id", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % 5).alias("first"))
    heads = turns.where("pos <= 8").select(F.col("conv_id").alias("first"), "pos", "digest", "n_bytes")
    borrowed = convs.join(heads, "first").where("pos <= h").select("conv_id", F.lit(0).alias("part"), "pos", "digest", "n_bytes")
    own = turns.where(F.col("pos") > h)
    marks = convs.select("conv_id", F.lit(-1).alias("part"), F.lit(0).cast("long").alias("pos"), F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("n_bytes"))
    return marks.unionByName(borrowed).unionByName(own)


# --- nodes --------------------------------------------------------------------


def chained(turns: DataFrame, tier_depth: int = TIER_DEPTH) -> DataFrame:
    """One row per conversation and prefix, the empty one included: its key,
    its parent's, the tier's top (``frag``), the keys from there to it
    (``path``), and whether the conversation ends there."""

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, depth, key, frag, path, held = None, 0, ROOT, b"", b"", None
        for batch in batches:
            out = []
            for c, part, digest, n in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3, 4)), strict=True):
                if held is not None:
                    out.append((*held, c != conv))
                if part < 0:
                    conv, depth, parent, key, frag, path = c, 0, None, ROOT, b"", ROOT
                else:
                    if depth % tier_depth == 0:
                        frag, path = key, b""
                    parent, depth = key, depth + 1
                    key = hashlib.blake2b(parent + digest, digest_size=_KEY).digest()
                    path += key
                held = (c, depth, key, parent, frag, path, n)
            yield _rows(out)
        if held is not None:
            yield _rows([(*held, True)])

    def _rows(out: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.bool_())
        columns = zip(*out, strict=True) if out else [[]] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(list(x), k) for x, k in zip(columns, kinds, strict=True)], ["conv_id", "depth", "key", "parent", "frag", "path", "n_bytes", "ends"])

    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "part", "pos").select("conv_id", "part", "pos", "digest", "n_bytes")
    return ordered.mapInArrow(chain, "conv_id long, depth long, key binary, parent binary, frag binary, path binary, n_bytes long, ends boolean")


def nodes_of(prefixes: DataFrame) -> DataFrame:
    """One row per node: smallest and number of members, whether it is a leaf
    (all members end there), its own saving."""
    own = prefixes.groupBy("key", "parent", "frag", "path", "depth", "n_bytes")
    rows = own.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.count_if("ends").alias("n_ends"))
    return rows.select("key", "parent", "frag", "path", "depth", "conv_id", "n_convs", (F.col("n_ends") == F.col("n_convs")).alias("leaf"), ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved"))


def ended(prefixes: DataFrame) -> DataFrame:
    """``key, ends_sha256``: the SHA-256 of the comma-joined ids, in ascending
    order, of the conversations that end at the node."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, ids, chars = None, None, [], 0
        for batch in batches:
            out = []
            for k, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if k != key or chars >= PACKED_CHARS:
                    if ids:
                        out.append((key, first, ",".join(ids)))
                    key, first, ids, chars = k, c, [], 0
                ids.append(str(c))
                chars += len(ids[-1])
            yield _packed(out)
        yield _packed([(key, first, ",".join(ids))] if ids else [])

    def _packed(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate((pa.binary(), pa.int64(), pa.string()))], ["key", "first", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha = None, hashlib.sha256()
        for batch in batches:
            out = []
            for k, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if k == key:
                    sha.update(b"," + ids.encode())
                    continue
                if key is not None:
                    out.append((key, sha.hexdigest()))
                key, sha = k, hashlib.sha256(ids.encode())
            yield _digests(out)
        yield _digests([(key, sha.hexdigest())] if key is not None else [])

    def _digests(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate((pa.binary(), pa.string()))], ["key", "ends_sha256"])

    rows = prefixes.where("ends").select("key", "conv_id").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    packed = rows.mapInArrow(pack, "key binary, first long, ids string")
    return packed.repartition("key").sortWithinPartitions("key", "first").mapInArrow(digest, "key binary, ends_sha256 string")


def totals_below(nodes: DataFrame, tiers: int) -> DataFrame:
    """``key, below_leaves, below_saved`` of every node at a tier's end that
    has children: the totals of all deeper tiers under it."""
    tops = nodes.where("depth > 0").groupBy("frag").agg(F.count_if("leaf").alias("leaves"), F.sum("saved").alias("saved"))
    above = nodes.select(F.col("key").alias("frag"), F.col("frag").alias("up"))
    tops = cut(tops.join(above, "frag"), "trie-tiers")
    for _ in range(math.ceil(math.log2(tiers))):
        under = tops.groupBy("up").agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved")).withColumnRenamed("up", "frag")
        far = tops.select(F.col("frag").alias("up"), F.col("up").alias("far"))
        rows = tops.join(under, "frag", "left").join(far, "up", "left")
        leaves, saved = (F.col(c) + F.coalesce(f"more_{c}", F.lit(0)) for c in ("leaves", "saved"))
        tops = cut(rows.select("frag", leaves.alias("leaves"), saved.alias("saved"), F.col("far").alias("up")), "trie-tiers")
    return tops.select(F.col("frag").alias("key"), F.col("leaves").alias("below_leaves"), F.col("saved").alias("below_saved"))


# --- balanced parentheses -------------------------------------------------------


class Parentheses:
    """A forest, given by its nodes' depths in depth-first order, as balanced
    parentheses: ``bits`` (1 opens), ``opens`` of the nodes, and the excess
    with its minima per block and per pair of blocks, upwards."""

    def __init__(self, depths: np.ndarray):
        n = len(depths)
        closes = np.append(0, depths[:-1] - depths[1:] + 1) if n else np.zeros(0, np.int64)
        self.opens = np.arange(n) + np.cumsum(closes)
        self.bits = np.zeros(2 * n, np.int8)
        self.bits[self.opens] = 1
        self.excess = np.cumsum(2 * self.bits.astype(np.int64) - 1)
        blocks = 1
        while blocks * BLOCK < 2 * n:
            blocks *= 2
        padded = np.full(blocks * BLOCK, np.iinfo(np.int64).max)
        padded[: 2 * n] = self.excess
        self.padded = padded
        self.minima = [padded.reshape(blocks, BLOCK).min(axis=1)]
        while len(self.minima[-1]) > 1:
            self.minima.append(self.minima[-1].reshape(-1, 2).min(axis=1))

    def _in_block(self, at: np.ndarray, goal: np.ndarray) -> np.ndarray:
        """The first position from ``at`` to its block's end with an excess of
        ``goal`` or less, or -1."""
        found = np.full(len(at), -1)
        lane, pos = np.arange(len(at)), at
        while len(lane):
            hit = self.padded[pos] <= goal[lane]
            found[lane[hit]] = pos[hit]
            on = ~hit & ((pos + 1) % BLOCK != 0)
            lane, pos = lane[on], pos[on] + 1
        return found

    def find_close(self) -> np.ndarray:
        """The matching close of every open."""
        goal = self.excess[self.opens] - 1
        close = np.full(len(self.opens), -1)
        # the close lies in the open's block, ...
        here = (self.opens + 1) % BLOCK != 0
        close[here] = self._in_block(self.opens[here] + 1, goal[here])
        # ... or under the first block, upwards and to the right, that dips to the goal
        lane = np.flatnonzero(close < 0)
        block, level = self.opens[lane] // BLOCK, 0
        stopped = [(np.zeros(0, np.int64),) * 2 for _ in self.minima]
        while len(lane):
            left = block % 2 == 0
            dips = np.zeros(len(lane), bool)
            dips[left] = self.minima[level][block[left] + 1] <= goal[lane[left]]
            stopped[level] = (lane[dips], block[dips] + 1)
            lane, block, level = lane[~dips], block[~dips] // 2, level + 1
        lane, block = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for level in range(len(self.minima) - 1, -1, -1):
            lane, block = np.concatenate([lane, stopped[level][0]]), np.concatenate([block, stopped[level][1]])
            if level:
                block = 2 * block
                block += self.minima[level - 1][block] > goal[lane]
        if len(lane):
            close[lane] = self._in_block(block * BLOCK, goal[lane])
        return close

    def sums(self, close: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Sums of the nodes' weights in their subtrees."""
        at = np.zeros(len(self.bits) + 1, np.int64)
        at[self.opens + 1] = weights
        cumulative = np.cumsum(at)
        return cumulative[close + 1] - cumulative[self.opens]

    def leaf_pairs(self) -> np.ndarray:
        """Which nodes open and close at once."""
        return self.bits[self.opens + 1] == 0


_SHARD = "key binary, home boolean, parent binary, conv_id long, depth long, parent_conv_id long, n_convs long, children long, leaves long, saved long"


def encode_shard(rows: list[tuple]) -> pa.RecordBatch:
    """The sums of one shard's nodes (key, parent, frag, path, depth, conv_id,
    n_convs, leaf, saved, below_leaves, below_saved; in depth-first order) and
    their parts for the nodes of its spine."""
    keys, depths, source = [], [], []
    frag = None
    for i, row in enumerate(rows):
        path = row[3]
        if row[2] != frag:
            frag = row[2]
            spine = [frag] if frag else []
            spine += [path[j : j + _KEY] for j in range(0, len(path) - _KEY, _KEY)]
            keys += spine
            depths += range(len(spine))
            source += [-1] * len(spine)
        keys.append(row[0])
        depths.append(len(path) // _KEY - (not frag))  # the root has no tier above it
        source.append(i)
    depth, at = np.array(depths, np.int64), np.array(source, np.int64)
    tree = Parentheses(depth)
    close = tree.find_close()
    home = at >= 0

    def column(i: int) -> np.ndarray:
        out = np.zeros(len(at), np.int64)
        out[home] = [r[i] for r in rows]
        return out

    # a pair whose node has children in another shard or tier is no leaf
    leaves = (tree.leaf_pairs() & (column(7) > 0)).astype(np.int64) + column(9)
    parent = np.full(len(at), -1)
    for d in np.unique(depth):
        below, own = np.flatnonzero(depth == d), np.flatnonzero(depth == d - 1)
        place = np.searchsorted(own, below) - 1
        if d:
            parent[below] = own[place]
    known = (parent >= 0) & home[parent]
    ids = column(5)
    # a tier's top has the tier's totals in its own row already, but for the root
    top = ~home & (depth == 0) & np.array([k != ROOT for k in keys])
    sums = [np.where(top, 0, tree.sums(close, w)) for w in (leaves, column(8) + column(10))]
    columns = [
        pa.array(keys, pa.binary()),
        pa.array(home),
        pa.array([rows[i][1] if i >= 0 else None for i in source], pa.binary()),
        pa.array(ids, mask=~home),
        pa.array(column(4), mask=~home),
        pa.array(ids[parent], mask=~known),
        pa.array(column(6), mask=~home),
        pa.array(np.bincount(parent[home & (parent >= 0)], minlength=len(at)).astype(np.int64)),
        pa.array(sums[0]),
        pa.array(sums[1]),
    ]
    return pa.RecordBatch.from_arrays(columns, ["key", "home", "parent", "conv_id", "depth", "parent_conv_id", "n_convs", "children", "leaves", "saved"])


def _shards(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            rows += zip(*(c.to_pylist() for c in batch.columns), strict=True)
            while len(rows) >= size:
                yield encode_shard(rows[:size])
                rows = rows[size:]
        if rows:
            yield encode_shard(rows)

    return encode


def trie(conversations: DataFrame, shard_nodes: int = SHARD_NODES, tier_depth: int = TIER_DEPTH) -> DataFrame:
    """One row per node of the trie of rebuilt conversations: ``conv_id`` (its
    smallest member), ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``."""
    turns = cut(ordered_turns(conversations), "trie-turns")
    prefixes = cut(chained(rebuilt_turns(turns), tier_depth), "trie-prefixes")
    nodes = cut(nodes_of(prefixes), "trie-nodes")
    deepest = nodes.agg(F.max("depth")).collect()[0][0] or 0
    tiers = math.ceil(deepest / tier_depth)
    if tiers > 1:
        below = totals_below(nodes, tiers)
        # the root leads the first tier: its own row takes no totals of deeper ones
        below = below.where(F.col("key") != F.lit(ROOT))
        weighted = nodes.join(below, "key", "left")
    else:
        weighted = nodes.withColumn("below_leaves", F.lit(0).cast("long")).withColumn("below_saved", F.lit(0).cast("long"))
    weighted = weighted.select(
        "key", "parent", "frag", "path", "depth", "conv_id", "n_convs", F.col("leaf").cast("long").alias("leaf"), "saved",
        F.coalesce("below_leaves", F.lit(0)).alias("below_leaves"), F.coalesce("below_saved", F.lit(0)).alias("below_saved"),
    )
    shards = weighted.repartitionByRange("frag", "path").sortWithinPartitions("frag", "path").mapInArrow(_shards(shard_nodes), _SHARD)
    shards = cut(shards, "trie-shards")
    home = shards.where("home").drop("home")
    # one spine a shard: far fewer rows than nodes
    spine = shards.where("not home").groupBy("key").agg(*[F.sum(c).alias(f"more_{c}") for c in ("children", "leaves", "saved")])
    spine = cut(spine.join(home.select("key", F.col("conv_id").alias("spine_conv_id")), "key"), "trie-spine")
    parents = spine.select(F.col("key").alias("parent"), F.col("spine_conv_id").alias("above"))
    rows = home.join(spine.drop("spine_conv_id"), "key", "left").join(parents, "parent", "left").join(ended(prefixes), "key", "left")
    return rows.select(
        "conv_id",
        "depth",
        F.coalesce("parent_conv_id", "above").alias("parent_conv_id"),
        "n_convs",
        (F.col("children") + F.coalesce("more_children", F.lit(0))).alias("n_children"),
        (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"),
        (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
