"""Benchmark decontamination by Wu-Manber multi-pattern search.

Every window of ten consecutive benchmark words (a shorter item is one window)
is a pattern.  Texts and patterns are brought to one form: words between
single spaces.  Patterns of similar length form a class with a table of block
shifts; the scan jumps ahead by the shift of the block at its window's end, and
where that is zero the block's bucket lists the patterns to compare, first by
their first eight bytes, then byte by byte.  A batch of texts is cut into lanes
that numpy advances together, so the skip loop costs a few array operations.

The benchmark is the stated query set.  It is split by a hash into blocks of
about ``BLOCK_BYTES`` of text, each broadcast alone, and every document is held
against every block, one pass per block.

Defined cases: a null text has no words; an item without words or without an
id is no pattern; repeated items or ids count once per id; repeated documents
give repeated rows; other columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.llm.common import LOWER, cut, fresh_name, text_chunks, tidy, word_spans, worker_cache

WINDOW_WORDS = 10
#: Benchmark text in one broadcast block, in bytes.
BLOCK_BYTES = 1 << 20
#: Smallest pattern length of a class; a class's block takes the size beside it.
CLASSES = ((3, 2), (8, 4), (16, 6), (32, 8), (64, 8))
LANE_BYTES = 2048

WORD = np.ones(256, bool)
WORD[:0x30] = False
WORD[0x3A:0x61] = False
WORD[0x7B:0x80] = False


def normal_form(data: np.ndarray, offsets: np.ndarray):
    """``(bytes, positions of word starts, words before each row)``: of every
    row a space, then each lower-case word and a space; eight zero bytes are
    in front of all."""
    low = LOWER[data]
    starts, ends, before = word_spans(low, offsets, WORD)
    lengths = ends - starts
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(before))
    written = np.cumsum(lengths) - lengths
    at = 8 + written + np.arange(len(starts)) + row + 1
    out = np.full(8 + int(lengths.sum()) + len(starts) + len(offsets) - 1 + 8, 32, np.uint8)
    out[:8] = 0
    src = np.flatnonzero(WORD[low])
    out[np.arange(len(src)) + np.repeat(at - written, lengths)] = low[src]
    return out, at, before


def _u64(data: np.ndarray) -> np.ndarray:
    """The little-endian 64-bit integer at every byte position."""
    return np.ndarray((len(data) - 7,), "<u8", buffer=data, strides=(1,))


class PatternClass:
    """Shift table and buckets of the patterns of one length class."""

    def __init__(self, patterns: list[bytes], numbers: list[int], block: int):
        self.m = min(map(len, patterns))
        self.block = min(block, self.m)
        span = self.m - self.block + 1
        self.bits = int(np.clip(np.ceil(np.log2(4 * len(patterns) * span)), 12, 22))
        heads = np.frombuffer(b"".join(p[: self.m] for p in patterns), np.uint8).reshape(len(patterns), self.m)
        self.shift = np.full(1 << self.bits, min(span, 65535), np.uint16)
        for end in range(self.block, self.m + 1):
            at = self.hash(self._column(heads, end))
            np.minimum.at(self.shift, at, min(self.m - end, 65535))
        suffix = self.hash(self._column(heads, self.m))
        order = np.argsort(suffix, kind="stable")
        self.suffix = suffix[order]
        self.patterns = [patterns[i] for i in order]
        self.numbers = [numbers[i] for i in order]
        self.prefix = np.array([int.from_bytes(p[:8].ljust(8, b"\0"), "little") for p in self.patterns], np.uint64)
        self.prefix_mask = np.array([(1 << 8 * min(8, len(p))) - 1 for p in self.patterns], np.uint64)

    def _column(self, heads: np.ndarray, end: int) -> np.ndarray:
        value = np.zeros(len(heads), np.uint64)
        for k in range(self.block):
            value |= heads[:, end - self.block + k].astype(np.uint64) << np.uint64(8 * k)
        return value

    def hash(self, blocks: np.ndarray) -> np.ndarray:
        return ((blocks * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def scan(self, data: np.ndarray, raw: bytes, words: np.ndarray) -> Iterator[tuple[int, int]]:
        """``(start, pattern number)`` of every occurrence; ``data`` has the
        eight zero bytes in front, ``words`` its 64-bit words."""
        n = len(data)
        first = 8 + self.m - 1  # the last byte of the first window
        if n <= first:
            return
        low = np.arange(first, n, LANE_BYTES, dtype=np.int64)
        high = np.minimum(low + LANE_BYTES, n)
        pos, cut = low, np.uint64(8 * (8 - self.block))
        found_at, found_hash = [], []
        while len(pos):
            block = self.hash(words[pos - 7] >> cut)
            step = self.shift[block].astype(np.int64)
            zero = step == 0
            if zero.any():
                found_at.append(pos[zero])
                found_hash.append(block[zero])
                step[zero] = 1
            pos = pos + step
            on = pos < high
            if not on.all():
                pos, high = pos[on], high[on]
        if not found_at:
            return
        at, block = np.concatenate(found_at) - self.m + 1, np.concatenate(found_hash)
        left, right = np.searchsorted(self.suffix, block, "left"), np.searchsorted(self.suffix, block, "right")
        sizes = right - left
        if not sizes.any():
            return
        which = np.repeat(left, sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        at = np.repeat(at, sizes)
        padded = np.minimum(at, len(words) - 1)
        same = (words[padded] & self.prefix_mask[which]) == self.prefix[which]
        for start, k in zip(at[same].tolist(), which[same].tolist(), strict=True):
            if raw.startswith(self.patterns[k], start):
                yield start, self.numbers[k]


class Matcher:
    """All patterns of one block of benchmark items."""

    def __init__(self, items: list[tuple[str, str]]):
        owners: dict[bytes, set[str]] = {}
        sizes: dict[bytes, int] = {}
        for a, b, data, offsets in text_chunks(pa.array([t for _, t in items], pa.string())):
            form, at, before = normal_form(data, offsets)
            raw = form.tobytes()
            at = np.append(at, 0)
            for i in range(a, b):
                lo, hi = int(before[i - a]), int(before[i - a + 1])
                if lo == hi:
                    continue
                last = int(at[hi - 1])
                end_of_row = raw.index(b" ", last) + 1
                k = min(WINDOW_WORDS, hi - lo)
                for w in range(lo, hi - k + 1):
                    end = int(at[w + k]) if w + k < hi else end_of_row
                    p = raw[int(at[w]) - 1 : end]
                    owners.setdefault(p, set()).add(items[i][0])
                    sizes[p] = k
        self.texts = list(owners)
        self.owners = [sorted(owners[p]) for p in self.texts]
        self.sizes = [sizes[p] for p in self.texts]
        self.classes = []
        bounds = [*CLASSES, (1 << 62, 0)]
        for (least, block), (upper, _) in zip(bounds[:-1], bounds[1:], strict=True):
            own = [i for i, p in enumerate(self.texts) if least <= len(p) < upper]
            if own:
                self.classes.append(PatternClass([self.texts[i] for i in own], own, block))

    def search(self, texts: pa.Array) -> pa.StructArray:
        """Per text: number of words, hit word numbers, ids of items with an
        occurring window."""
        n_words, hits, items = [], [], []
        for _, _, data, offsets in text_chunks(texts):
            form, at, before = normal_form(data, offsets)
            rows = len(offsets) - 1
            n_words.extend(np.diff(before).tolist())
            row_hits: dict[int, set[int]] = {}
            row_items: dict[int, set[str]] = {}
            if len(at):
                words, raw = _u64(form), form.tobytes()
                for c in self.classes:
                    for start, number in c.scan(form, raw, words):
                        w = int(np.searchsorted(at, start + 1))
                        r = int(np.searchsorted(before, w, side="right")) - 1
                        lo = w - int(before[r])
                        row_hits.setdefault(r, set()).update(range(lo, lo + self.sizes[number]))
                        row_items.setdefault(r, set()).update(self.owners[number])
            for r in range(rows):
                hits.append(sorted(row_hits.get(r, ())))
                items.append(sorted(row_items.get(r, ())))
        return pa.StructArray.from_arrays(
            [pa.array(n_words, pa.int64()), pa.array(hits, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string()))],
            ["n_words", "hits", "items"],
        )


def _matcher(shared, number: int) -> Matcher:
    """The block's matcher, made once per worker; only one block's is kept."""
    cache = worker_cache("decontam")
    if number not in cache:
        cache.clear()
        cache[number] = Matcher(shared.value)
    return cache[number]


_numbers = iter(range(1 << 62))


def _blocks_of(benchmark: DataFrame, item_id: str, text: str) -> Iterator:
    """The number of blocks, then each block's items."""
    items = benchmark.where(F.col(item_id).isNotNull() & F.col(text).isNotNull()).select(F.col(item_id).cast("string").alias("i"), F.col(text).alias("t")).distinct()
    size = items.agg(F.sum(F.octet_length("t"))).collect()[0][0] or 0
    n = size // BLOCK_BYTES + 1
    yield n
    for k in range(n):
        own = items if n == 1 else items.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k)
        yield [(r.i, r.t) for r in own.collect()]


def _search_column(shared, number: int, text: str) -> Column:
    def search(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in parts:
            yield _matcher(shared, number).search(texts)

    return F.arrow_udf(tidy(search), "n_words long, hits array<int>, items array<string>")(text)


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with a number for each row, written so that it stays."""
    return cut(docs.select("*", F.monotonically_increasing_id().alias(fresh_name("_row", docs.columns))), "decontam-rows")


def matches(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``docs`` with ``n_words, n_hit, items`` (sorted distinct item ids) as
    the struct ``found`` (lengthened by underscores if a column has the name).

    A benchmark of one block is searched in one pass over the rows.  Of more
    blocks each has a pass of its own, so that a worker holds one block's
    tables at a time; only rows with a hit leave a pass, and the hits of a row
    are put together by its number."""
    sc = docs.sparkSession.sparkContext
    found = fresh_name("found", docs.columns)
    blocks = _blocks_of(benchmark, item_id, item_text)
    n = next(blocks)
    first = _search_column(sc.broadcast(next(blocks)), next(_numbers), text)
    if n == 1:
        return docs.withColumn(found, F.struct(first["n_words"].alias("n_words"), F.size(first["hits"]).cast("long").alias("n_hit"), first["items"].alias("items")))
    rows = _numbered(docs)
    row = rows.columns[-1]
    passes = [rows.select(row, first.alias("f"))]
    passes += [rows.select(row, _search_column(sc.broadcast(b), next(_numbers), text).alias("f")) for b in blocks]
    counts = cut(passes[0].select(row, "f.*"), "decontam-pass")
    hits = [counts.where(F.size("hits") > 0).select(row, "hits", "items")]
    hits += [cut(p.where(F.size("f.hits") > 0).select(row, "f.hits", "f.items"), "decontam-pass") for p in passes[1:]]
    # hits of one row: at most one array per block
    together = reduce(DataFrame.unionByName, hits).groupBy(row).agg(F.flatten(F.collect_list("hits")).alias("hits"), F.flatten(F.collect_list("items")).alias("items"))
    together = together.select(row, F.size(F.array_distinct("hits")).cast("long").alias("n_hit"), F.array_sort(F.array_distinct("items")).alias("items"))
    none = F.array().cast("array<string>")
    of_row = counts.select(row, "n_words").join(together, row, "left").select(
        row, F.struct("n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("items", none).alias("items")).alias(found)
    )
    return rows.join(of_row, row).select(*docs.columns, found)


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``id_col, n_words, n_hit, items, contaminated`` for every row of ``docs``."""
    rows = matches(docs.select(F.col(id_col), F.col(text)), benchmark, text)
    rows = rows.select(F.col(id_col), f"{rows.columns[-1]}.*")
    return rows.withColumn("contaminated", F.col("n_hit") > 0)


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no benchmark window occurs."""
    rows = matches(docs, benchmark, text)
    return rows.where(F.col(rows.columns[-1])["n_hit"] == 0).select(*docs.columns)
