"""Helpers shared by the operators: table access, lineage cuts, byte-level
text views for numpy, and distributed connected components."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.session import shared_path

#: Texts handed to numpy at once, in bytes (a longer text goes alone).
CHUNK_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` once into the shared folder that the
    cluster names in ``spark.checkpoint.dir`` and read it back.  A lost
    executor then costs a re-read, never a recomputation."""
    spark = df.sparkSession
    path = shared_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def conf_int(spark: SparkSession, key: str, default: int) -> int:
    return int(spark.conf.get(key, str(default)))


# --- worker memory ------------------------------------------------------------

_caches: dict[str, dict] = {}


def worker_cache(owner: str) -> dict:
    """What an operator keeps in a worker between its tasks.  Workers outlive a
    stage: another operator's first task there empties it."""
    for other in [k for k in _caches if k != owner]:
        _caches.pop(other)
    return _caches.setdefault(owner, {})


def release_freed() -> None:
    """Hand this process's freed memory back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # not every C library trims
        ctypes.CDLL(None).malloc_trim(0)


def tidy(work: Callable[[Iterator[pa.Array]], Iterator[pa.Array]]) -> Callable[[Iterator[pa.Array]], Iterator[pa.Array]]:
    """The same work on batches; after it the worker hands freed memory back to
    the system, so that what one stage took is not held through the next."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        try:
            yield from work(batches)
        finally:
            release_freed()

    return run


def fresh_name(name: str, taken: Iterable[str]) -> str:
    """``name``, lengthened until no column has it (in any case)."""
    taken = {t.lower() for t in taken}
    while name.lower() in taken:
        name += "_"
    return name


# --- texts as bytes -----------------------------------------------------------


def text_chunks(texts: pa.Array, chunk_bytes: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Slices of an Arrow string array as ``(first row, end row, UTF-8 bytes,
    offsets of rows in them)``, each of about ``chunk_bytes``; a null is an
    empty text."""
    arr = texts.cast(pa.large_binary())
    if arr.null_count:
        arr = arr.fill_null(b"")
    n = len(arr)
    offsets = np.frombuffer(arr.buffers()[1], dtype=np.int64)[arr.offset : arr.offset + n + 1] if n else np.zeros(1, np.int64)
    buf = arr.buffers()[2]
    data = np.frombuffer(buf, dtype=np.uint8) if buf is not None and buf.size else np.zeros(0, np.uint8)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + chunk_bytes, side="right")) - 1)
        b = min(b, n)
        yield a, b, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        a = b


def word_spans(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(starts, ends, words before each row)`` of the maximal runs of bytes
    for which the 256-entry table ``is_word`` holds; a run never crosses a
    row's end."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    mask = is_word[data]
    first = np.empty(n + 1, bool)
    first[0] = True
    first[1:n] = ~mask[:-1]
    first[n] = False
    inner = offsets[:-1]
    first[inner[inner < n]] = True
    starts = np.flatnonzero(first[:n] & mask)
    last = np.empty(n, bool)
    last[n - 1] = True
    last[:-1] = ~mask[1:]
    ends_of = offsets[1:] - 1
    last[ends_of[ends_of >= 0]] = True
    ends = np.flatnonzero(last & mask) + 1
    return starts, ends, np.searchsorted(starts, offsets)


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit integers (multiply and xor-shift)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


# --- connected components -----------------------------------------------------


def _sum_of(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).collect()[0]


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``: root is the
    smallest node of its connected component.

    Alternates the large-star and small-star steps: each joins the edges with
    the smallest neighbour of every node (a partially aggregated minimum, so
    a node with very many links is folded map-side).  Every round is written
    to the shared folder; only two numbers per round reach the driver.  Null
    or equal ends are ignored.
    """
    edges = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()
    edges = cut(edges, "edges")
    before = _sum_of(edges)
    for _ in range(max_rounds):
        if not before[0]:
            break
        both = edges.union(edges.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("m").alias("a"), "b").where("a < b").distinct()
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        small = (
            large.join(low, "b")
            .select(F.explode(F.array(F.struct(F.col("m").alias("a"), F.col("a").alias("b")), F.struct(F.col("m").alias("a"), "b"))).alias("e"))
            .select("e.a", "e.b")
            .where("a < b")
            .distinct()
        )
        edges = cut(small, "edges")
        after = _sum_of(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"connected components did not settle in {max_rounds} rounds")
    roots = edges.select("a").distinct()
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).union(roots.select("a", "a"))
