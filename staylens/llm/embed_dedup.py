"""Near-duplicate vectors by an inverted multi-index.

Vectors are scaled to unit length and cut into two halves; a codebook per half
spans a product grid of cells, each with the list of its vectors.  A vector
visits the grid's cells in the order of their distance (the multi-sequence
order: sums of the two halves' distances) and as many of them as the target
recall needs.  That number is measured, not guessed: synthetic neighbours at
exactly the threshold, the hardest case, must fall into a visited cell of one
side or the other.  Candidates are verified by their cosine in double
precision.

Work is dealt out by the first half's codeword and, within it, by blocks of
``BLOCK`` list entries and ``BLOCK`` visitors, so a crowded cell becomes many
small units.  A unit sends counts and a spanning forest, never its pairs.

The codebooks are fitted on a sample of about ``SAMPLE`` vectors (drawn by a
hash); every vector is indexed and visits.

Defined cases: a vector that is null, empty, zero, or holds null or non-finite
components links with nothing; vectors of different length do not link, those
of each length are searched by themselves; vectors of one component link by
their sign; equal vectors are folded into one before the search and counted as links of
each other; repeated ids are vectors of their own; a null id is never
``kept``; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.llm.common import components, cut

THRESHOLD = 0.95
RECALL = 0.995
SAMPLE = 8192
PER_CELL = 48
MAX_CODEWORDS = 256
BLOCK = 2048


def _doubles(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """A usable vector as little-endian doubles, else null.  It is scaled by a
    power of two (which rounds nothing) so that its square neither vanishes nor
    overflows; of one component only the sign is kept."""
    for vectors in parts:
        out = []
        for v in vectors:
            v = v.as_py()
            x = None
            if v and None not in v:
                x = np.array(v, "<f8")
                most = float(np.abs(x).max()) if np.isfinite(x).all() else 0.0
                x = np.ldexp(x, -int(np.frexp(most)[1])) if most > 0 else None
                x = np.sign(x) if x is not None and len(x) == 1 else x
            out.append(None if x is None else x.astype("<f8").tobytes())
        yield pa.array(out, pa.binary())


def unit_matrix(raws: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(raws), "<f8").reshape(len(raws), -1)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _squares(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ book.T + (book * book).sum(1)[None, :], 0)


def fit_codebook(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    """Lloyd's algorithm from k distinct sample rows."""
    book = x[rng.choice(len(x), size=min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        own = _squares(x, book).argmin(1)
        n = np.bincount(own, minlength=len(book))
        total = np.zeros_like(book)
        np.add.at(total, own, x)
        book[n > 0] = total[n > 0] / n[n > 0, None]
    return book


class MultiIndex:
    """Two codebooks and the number of cells to visit."""

    def __init__(self, first: np.ndarray, second: np.ndarray, visits: int = 1):
        self.first, self.second, self.visits = first, second, visits
        self.half = first.shape[1]

    @property
    def cells(self) -> int:
        return len(self.first) * len(self.second)

    def order(self, x: np.ndarray, t: int) -> np.ndarray:
        """The ``t`` nearest cells of each row, nearest first.  The cell of
        ranks (a, b) can be among them only if (a + 1)(b + 1) <= t."""
        d1, d2 = _squares(x[:, : self.half], self.first), _squares(x[:, self.half :], self.second)
        o1, o2 = d1.argsort(1, kind="stable"), d2.argsort(1, kind="stable")
        d1, d2 = np.take_along_axis(d1, o1, 1), np.take_along_axis(d2, o2, 1)
        k1, k2 = d1.shape[1], d2.shape[1]
        a, b = np.array([(a, b) for a in range(min(k1, t)) for b in range(min(k2, t // (a + 1)))]).T
        sums = d1[:, a] + d2[:, b]
        best = sums.argsort(1, kind="stable")[:, :t]
        return o1[np.arange(len(x))[:, None], a[best]] * k2 + o2[np.arange(len(x))[:, None], b[best]]

    def visited(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([self.order(x[i : i + 256], self.visits) for i in range(0, len(x), 256)])

    def calibrate(self, x: np.ndarray, threshold: float, recall: float, rng: np.random.Generator) -> None:
        """Smallest number of visits with which neighbours at the threshold
        are met from one side or the other at the target recall."""
        noise = rng.standard_normal(x.shape)
        noise -= (noise * x).sum(1)[:, None] * x
        noise /= np.sqrt((noise * noise).sum(1))[:, None]
        y = threshold * x + np.sqrt(1 - threshold**2) * noise
        ranks = []
        for i in range(0, len(x), 32):
            ox, oy = self.order(x[i : i + 32], self.cells), self.order(y[i : i + 32], self.cells)
            ranks.append(np.minimum((ox == oy[:, :1]).argmax(1), (oy == ox[:, :1]).argmax(1)))
        self.visits = int(np.quantile(np.concatenate(ranks), recall, method="higher")) + 1


def fit_index(sample: np.ndarray, vectors: int, threshold: float = THRESHOLD, recall: float = RECALL) -> MultiIndex:
    rng = np.random.default_rng(7)
    k = int(np.clip(round((vectors / PER_CELL) ** 0.5), 2, MAX_CODEWORDS))
    half = max(1, sample.shape[1] // 2)
    index = MultiIndex(fit_codebook(sample[:, :half], k, rng), fit_codebook(sample[:, half:], k, rng))
    index.calibrate(sample[rng.choice(len(sample), size=min(len(sample), 400), replace=False)], threshold, recall, rng)
    return index


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For nodes 0..n-1 the smallest node that the edges a-b connect them with."""
    low = np.arange(n)
    while True:
        old = low.copy()
        m = np.minimum(low[a], low[b])
        np.minimum.at(low, a, m)
        np.minimum.at(low, b, m)
        low = low[low]
        if (low == old).all():
            return low


def compare_unit(list_cells, list_probes, list_x, list_size, query_cells, query_probes, query_x, query_size, same, threshold: float):
    """Links between the visitors and the list entries of one unit.

    Returns ``(weights of list entries, weights of visitors, a, b)``: the
    weights sum the sizes of linked vectors, a-b (visitors counted from 0,
    list entries behind them) are edges that connect all linked ones.  A pair
    that only one side meets counts for both there; one that both sides meet
    counts for the visitor, once on each side."""
    nq, nl = len(query_x), len(list_x)
    wq, wl = np.zeros(nq), np.zeros(nl)
    edges_a, edges_b = [], []
    by_cell = np.argsort(list_cells, kind="stable")
    cells, first = np.unique(list_cells[by_cell], return_index=True)
    last = np.append(first[1:], nl)
    for cell, lo, hi in zip(cells, first, last, strict=True):
        ls = by_cell[lo:hi]
        visitors = np.flatnonzero((query_probes == cell).any(1))
        for q0 in range(0, len(visitors), 512):
            qs = visitors[q0 : q0 + 512]
            hit_q, hit_l = np.nonzero(query_x[qs] @ list_x[ls].T >= threshold)
            hit_q, hit_l = qs[hit_q], ls[hit_l]
            other = same[0][hit_q] != same[1][hit_l]
            hit_q, hit_l = hit_q[other], hit_l[other]
            if not len(hit_q):
                continue
            wq += np.bincount(hit_q, list_size[hit_l], nq)
            for h in range(0, len(hit_q), 50_000):
                x, y = hit_q[h : h + 50_000], hit_l[h : h + 50_000]
                once = ~(list_probes[y] == query_cells[x][:, None]).any(1)
                wl += np.bincount(y[once], query_size[x[once]], nl)
            low = forest(hit_q, nq + hit_l, nq + nl)
            nodes = np.flatnonzero(low != np.arange(nq + nl))
            edges_a.append(nodes)
            edges_b.append(low[nodes])
    none = np.zeros(0, np.int64)
    return wl, wq, np.concatenate(edges_a or [none]), np.concatenate(edges_b or [none])


def _search(classes: DataFrame, index: MultiIndex, threshold: float) -> DataFrame:
    """``uid, links, root``: partial sums and forest edges of all units."""
    spark = classes.sparkSession
    shared = spark.sparkContext.broadcast(index)
    k2 = len(index.second)

    @F.arrow_udf("array<int>")
    def probes(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for raws in parts:
            cells = shared.value.visited(unit_matrix(raws.to_pylist())) if len(raws) else np.zeros((0, 1))
            yield pa.array(list(cells.astype(np.int32)), pa.list_(pa.int32()))

    placed = cut(classes.select("uid", "raw", "size", probes("raw").alias("probes")), "placed")
    own = F.floor(F.col("probes")[0] / k2).cast("int")
    visits = F.array_distinct(F.transform("probes", lambda p: F.floor(p / k2).cast("int")))
    lists = placed.withColumn("part", own)
    visitors = placed.withColumn("part", F.explode(visits))
    blocks = lambda df: {r["part"]: -(-r["n"] // BLOCK) for r in df.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}  # noqa: E731  one number per codeword
    nl, nq = blocks(lists), blocks(visitors)
    as_map = lambda d: F.create_map(*[F.lit(x) for kv in d.items() for x in kv])
    n_lists, n_visits = as_map(nl)[F.col("part")], as_map(nq)[F.col("part")]
    salt = F.xxhash64("uid")
    many = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    lists = lists.where(n_visits.isNotNull()).withColumn("lb", F.pmod(salt, n_lists).cast("int")).withColumn("qb", many(n_visits)).withColumn("side", F.lit(0))
    visitors = visitors.where(n_lists.isNotNull()).withColumn("qb", F.pmod(salt, n_visits).cast("int")).withColumn("lb", many(n_lists)).withColumn("side", F.lit(1))

    def unit(rows: pa.Table) -> pa.Table:
        side = rows["side"].to_numpy()
        got = []
        for s in (0, 1):
            t = rows.filter(pa.array(side == s)).combine_chunks()
            n = t.num_rows
            p = np.array(t["probes"].to_pylist(), np.int32).reshape(n, -1) if n else np.zeros((0, 1), np.int32)
            got.append((t["uid"].to_numpy(), p, unit_matrix(t["raw"].to_pylist()) if n else None, t["size"].to_numpy().astype(float)))
        (lu, lp, lx, lsize), (qu, qp, qx, qsize) = got
        schema = pa.schema([("uid", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])
        if not len(lu) or not len(qu):
            return schema.empty_table()
        wl, wq, a, b = compare_unit(lp[:, 0], lp, lx, lsize, qp[:, 0], qp, qx, qsize, (qu, lu), threshold)
        ids = np.concatenate([qu, lu])
        uid = np.concatenate([qu, lu, ids[a]])
        links = np.concatenate([wq, wl, np.zeros(len(a))]).astype(np.int64)
        root = np.concatenate([qu, lu, ids[b]])
        keep = (links > 0) | (uid != root)
        return pa.table([uid[keep], links[keep], root[keep]], schema=schema)

    cols = ["part", "lb", "qb", "side", "uid", "raw", "size", "probes"]
    return lists.select(cols).union(visitors.select(cols)).groupBy("part", "lb", "qb").applyInArrow(unit, "uid long, links long, root long")


def near_duplicate_vectors(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """``id, n_links, component_id, kept`` for every row of ``vectors``."""
    rows = cut(vectors.select(F.col(id_col).alias("id"), F.arrow_udf(_doubles, "binary")(vector).alias("raw")), "vectors")
    classes = rows.where("raw is not null").groupBy("raw").agg(F.count(F.lit(1)).alias("size"), F.min("id").alias("label"))
    classes = cut(classes.withColumn("uid", F.monotonically_increasing_id()), "classes")
    found = classes.select("uid", F.lit(0).cast("long").alias("links"), F.col("uid").alias("root")).where("false")
    # vectors of different length link with none of each other: a search per length
    # (one row per length; one component is folded already)
    for width, n in classes.groupBy(F.octet_length("raw")).count().orderBy(F.octet_length("raw")).collect():
        if n < 2 or width <= 8:
            continue
        own = classes.where(F.octet_length("raw") == width)
        part = int(min(1.0, SAMPLE / n) * (1 << 20)) + 1
        sample = own.where(F.pmod(F.xxhash64("raw"), F.lit(1 << 20)) < part).select("raw").collect()
        sample = sample if len(sample) > 1 else own.select("raw").limit(SAMPLE).collect()
        index = fit_index(unit_matrix(sorted(bytes(r.raw) for r in sample)), n, threshold, recall)
        found = found.unionByName(cut(_search(own, index, threshold), "found"))
    links = found.groupBy("uid").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("uid").alias("a"), F.col("root").alias("b")))
    placed = classes.join(links, "uid", "left").join(roots.withColumnRenamed("node", "uid"), "uid", "left").withColumn("root", F.coalesce("root", "uid"))
    labels = placed.groupBy("root").agg(F.min("label").alias("component"))
    of_class = placed.join(labels, "root").select("raw", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("links"), "component")
    alone = rows.where("raw is null").select("id", F.lit(0).cast("long").alias("links"), F.col("id").alias("component"))
    out = rows.where("raw is not null").join(of_class, "raw").select("id", "links", "component").union(alone)
    return out.select(F.col("id").alias(id_col), F.col("links").alias("n_links"), F.col("component").alias("component_id")).withColumn(
        "kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(False))
    )
