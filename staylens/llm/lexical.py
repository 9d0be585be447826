"""Ranked lexical search by pipelined term partitioning.

The terms of a stated set of items are dealt to owners, the rare ones first.
An item's bundle carries sparse document accumulators from owner to owner: each
stage cogroups the bundles with that owner's postings, adds the integer
contributions of the owner's terms and hands the bundles on; after the last
owner the scores are whole and the best documents are selected.

Documents lie in blocks of a bounded number of rows and postings, formed where
they are scanned, and both sides of a cogroup are keyed by the block.  So a
term that every document holds, or a crowd of equal documents, is spread over
as many groups as there are blocks, and a group's size does not grow with the
table.

Stages pass on only what can still be selected.  With ``rest`` the sum of an
item's largest possible contributions from the owners to come, an accumulator
whose score plus ``rest`` is below the ``k``-th best score so far is let go,
and documents that no earlier owner touched are taken up only while ``rest``
alone reaches it.  Contributions are never negative, so this loses nothing, and
equal scores all stay until the selection.

Items are searched in passes of about ``PASS_BYTES`` of text, which bounds what
is broadcast (a pass's terms and weights) and what the driver holds (their
counts and bounds).

Defined cases: a null text has no terms; an item without terms, or whose terms
no document holds, has no row; every row of the items is an item of its own and
every row of the documents a document of its own, so repeated rows give
repeated results (equal scores in ascending id order, null ids first); other
columns are left alone; an empty table gives an empty result.  One term or text
may be as long as it likes; texts are split in slices.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from staylens.llm.common import cut
from staylens.session import shared_path

#: Term owners, so stages of the pipeline.
OWNERS = 4
#: A block of documents is full with so many rows or postings.
BLOCK_DOCS, BLOCK_POSTINGS = 4096, 1 << 19
#: Item text searched in one pass, in bytes.
PASS_BYTES = 1 << 20
#: A text is split into terms in slices of about so many bytes.
SLICE = 1 << 20

#: ASCII other than letters and digits separates terms; only A-Z are lower-cased.
_FORM = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

_BUNDLES = "block long, item int, slots array<int>, scores array<long>, best array<long>"


def term_counts(text: bytes) -> Counter:
    """Every term of a UTF-8 text and how often it occurs."""
    counts: Counter = Counter()
    form, at = text.translate(_FORM), 0
    while at < len(form):
        end = form.find(b" ", at + SLICE)
        end = len(form) if end < 0 else end
        counts.update(form[at:end].split())
        at = end
    return counts


def _lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(arrays) if arrays else [], kind))


def document_blocks(docs: DataFrame, vocabulary, id_col: str, text: str) -> DataFrame:
    """One row per block: the ids and numbers of terms of its documents; the
    postings (term, slot, tf) of the vocabulary's terms, by term; each such
    term's number of documents; how many documents have terms."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = vocabulary.value
        part, made = TaskContext.get().partitionId(), 0
        ids, lengths, terms, slots, tfs = [], [], [], [], []

        def block() -> pa.RecordBatch:
            term, slot, tf = (np.array(x, np.int64) for x in (terms, slots, tfs))
            order = np.lexsort((slot, term))
            held, df = np.unique(term, return_counts=True)
            own = pa.concat_arrays(ids)
            columns = [
                pa.array([part << 32 | made], pa.int64()),
                pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), own),
                _lists([np.array(lengths, np.int64)], pa.int64()),
                _lists([term[order]], pa.int32()),
                _lists([slot[order]], pa.int32()),
                _lists([tf[order]], pa.int64()),
                _lists([held], pa.int32()),
                _lists([df], pa.int64()),
                pa.array([sum(map(bool, lengths))], pa.int64()),
                pa.array([sum(lengths)], pa.int64()),
            ]
            for x in (ids, lengths, terms, slots, tfs):
                x.clear()
            return pa.RecordBatch.from_arrays(columns, ["block", "ids", "n", "term", "slot", "tf", "held", "df", "docs", "words"])

        for batch in batches:
            first = 0
            for i, value in enumerate(batch.column(1)):
                counts = term_counts(value.as_py() or b"")
                for t, c in counts.items():
                    k = numbers.get(t)
                    if k is not None:
                        terms.append(k)
                        slots.append(len(lengths))
                        tfs.append(c)
                lengths.append(sum(counts.values()))
                if len(lengths) >= BLOCK_DOCS or len(terms) >= BLOCK_POSTINGS:
                    ids.append(batch.column(0).slice(first, i + 1 - first))
                    first = i + 1
                    yield block()
                    made += 1
            if first < len(batch):
                ids.append(batch.column(0).slice(first))
        if lengths:
            yield block()

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(
        pack,
        f"block long, ids array<{kind}>, n array<long>, term array<int>, slot array<int>, tf array<long>, held array<int>, df array<long>, docs long, words long",
    )


def owner_postings(blocks: DataFrame, owner_of, n_docs: int, n_words: int) -> DataFrame:
    """``owner, block``, the postings (term, slot, impact) of the owner's terms
    in the block, and the largest impact of each such term."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owners = owner_of.value
        for batch in batches:
            for row in range(len(batch)):
                n, term, slot, tf = (np.asarray(batch.column(c)[row].values) for c in range(1, 5))
                m = np.array([75 + 25 * int(x) * n_docs // n_words for x in n], np.int64)
                impact = 1_000_000_000 * tf // (1000 * tf + 12 * m[slot]) if len(term) else tf
                owner = owners[term]
                for o in np.unique(owner[owner >= 0]):
                    own = owner == o
                    t, x = term[own], impact[own]
                    held, at = np.unique(t, return_index=True)
                    columns = [pa.array([int(o)], pa.int32()), batch.column(0).slice(row, 1), _lists([t], pa.int32()), _lists([slot[own]], pa.int32())]
                    columns += [_lists([x], pa.int64()), _lists([held], pa.int32()), _lists([np.maximum.reduceat(x, at)], pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, ["owner", "block", "term", "slot", "impact", "held", "most"])

    rows = blocks.select("block", "n", "term", "slot", "tf")
    return rows.mapInArrow(deal, "owner int, block long, term array<int>, slot array<int>, impact array<long>, held array<int>, most array<long>")


def _advance(bundles: DataFrame, postings: DataFrame, shared, k: int) -> DataFrame:
    """One stage: the bundles after this owner's contributions.  ``shared``
    has, per item, the owner's terms and weights, ``rest`` before and after
    this owner and the ``k``-th best score so far."""

    def add(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        plan, before, after, least = shared.value
        term, slot, impact = (np.concatenate([np.asarray(x.values) for x in right.column(c)] or [np.zeros(0, np.int64)]) for c in ("term", "slot", "impact"))
        held, low = np.unique(term, return_index=True)
        high = np.append(low[1:], len(term))
        carried = {i.as_py(): (np.asarray(s.values), np.asarray(x.values)) for i, s, x in zip(left["item"], left["slots"], left["scores"], strict=True)}
        size = 1 + max([int(slot.max(initial=-1)), *(int(s.max()) for s, _ in carried.values())])
        items, out_slots, out_scores, out_best = [], [], [], []
        for item in sorted(carried.keys() | set(np.flatnonzero((before >= least) & (before > 0)).tolist())):
            score = np.zeros(size, np.int64)
            if item in carried:
                at, value = carried[item]
                score[at] = value
            terms, weights = plan.get(item, ((), ()))
            place = np.searchsorted(held, terms)
            for t, p, w in zip(terms, place, weights, strict=True):
                if p < len(held) and held[p] == t:
                    x, y = low[p], high[p]
                    score[slot[x:y]] += w * impact[x:y]
            seen = np.flatnonzero(score) if before[item] >= least[item] else carried[item][0]
            value = score[seen]
            best = np.sort(value)[::-1][:k]
            bar = max(int(least[item]), int(best[-1]) if len(best) == k else 0)
            stay = value + after[item] >= bar
            if stay.any():
                items.append(item)
                out_slots.append(seen[stay])
                out_scores.append(value[stay])
                out_best.append(best)
        columns = [pa.array([key[0].as_py()] * len(items), pa.int64()), pa.array(items, pa.int32()), _lists(out_slots, pa.int32())]
        return pa.Table.from_arrays([*columns, _lists(out_scores, pa.int64()), _lists(out_best, pa.int64())], ["block", "item", "slots", "scores", "best"])

    return bundles.groupBy("block").cogroup(postings.groupBy("block")).applyInArrow(add, _BUNDLES)


def _least(bundles: DataFrame, n_items: int, k: int) -> np.ndarray:
    """Per item, the ``k``-th best score so far (0 with fewer documents)."""
    ranked = bundles.select("item", F.explode("best").alias("score"))
    ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score")))).where(F.col("rank") <= k)
    rows = ranked.where(F.col("rank") == k).select("item", "score").collect()
    out = np.zeros(n_items, np.int64)
    for r in rows:
        out[r.item] = r.score
    return out


def _search_pass(docs: DataFrame, items: list, k: int, id_col: str, text: str) -> DataFrame | None:
    """``item`` (place in ``items``), rank, id, score for the items of one pass."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    wanted = [term_counts((t or "").encode()) for _, t in items]
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*wanted)))}
    if not vocabulary:
        return None
    blocks = cut(document_blocks(docs, sc.broadcast(vocabulary), id_col, text), "lexical-blocks")
    n_docs, n_words = blocks.agg(F.sum("docs"), F.sum("words")).collect()[0]
    if not n_words:
        return None
    counted = blocks.select(F.explode(F.arrays_zip("held", "df")).alias("x")).groupBy("x.held").agg(F.sum("x.df").alias("df"))
    df = {r.held: r.df for r in counted.collect()}
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * c + 1))) for t, c in df.items()}

    # owners hold about equally many postings, the rarest terms first
    owner_of, dealt, total = np.full(len(vocabulary), -1, np.int32), 0, sum(c for t, c in df.items() if weight[t])
    for c, t in sorted((c, t) for t, c in df.items() if weight[t]):
        owner_of[t] = OWNERS * dealt // total
        dealt += c
    path = shared_path(spark, "llm-lexical-postings")
    owner_postings(blocks, sc.broadcast(owner_of), n_docs, n_words).write.partitionBy("owner").parquet(path)
    postings = spark.read.schema("block long, term array<int>, slot array<int>, impact array<long>, held array<int>, most array<long>, owner int").parquet(path)
    bounds = postings.select(F.explode(F.arrays_zip("held", "most")).alias("x")).groupBy("x.held").agg(F.max("x.most").alias("most"))
    most = {r.held: r.most for r in bounds.collect()}

    plans: list[dict] = [{} for _ in range(OWNERS)]
    rest = np.zeros((OWNERS + 1, len(items)), np.int64)
    for i, counts in enumerate(wanted):
        for t, c in counts.items():
            number = vocabulary[t]
            if owner_of[number] >= 0:
                terms, weights = plans[owner_of[number]].setdefault(i, ([], []))
                terms.append(number)
                weights.append(c * weight[number])
                rest[: owner_of[number] + 1, i] += c * weight[number] * most[number]
    bundles, least = spark.createDataFrame([], _BUNDLES), np.zeros(len(items), np.int64)
    for o in range(OWNERS):
        shared = sc.broadcast((plans[o], rest[o], rest[o + 1], least))
        bundles = cut(_advance(bundles, postings.where(F.col("owner") == o), shared, k), "lexical-bundles")
        least = np.maximum(least, _least(bundles, len(items), k))
    # (a pass's items bound what is joined by broadcast)
    bar = F.broadcast(spark.createDataFrame([(i, int(x)) for i, x in enumerate(least)], "item int, bar long"))
    found = bundles.join(bar, "item").join(blocks.select("block", "ids"), "block")
    pairs = F.transform(F.arrays_zip("slots", "scores"), lambda x: F.struct(F.get("ids", x["slots"]).alias("id"), x["scores"].alias("score")))
    rows = found.select("item", "bar", F.explode(pairs).alias("x")).where(F.col("x.score") >= F.greatest("bar", F.lit(1))).select("item", "x.id", "x.score")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("id").asc_nulls_first())
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``item_id, rank, id_col, score``: the ``k`` best documents of each item
    with a score above 0, the highest first, equal scores by ascending id."""
    spark = docs.sparkSession
    wanted = items.select(F.col(item_id).alias("i"), F.col(item_text).alias("t")).where("t is not null")
    size = wanted.agg(F.sum(F.octet_length("t"))).collect()[0][0] or 0
    passes = size // PASS_BYTES + 1
    id_type, item_type = docs.schema[id_col].dataType.simpleString(), items.schema[item_id].dataType.simpleString()
    out = [spark.createDataFrame([], f"{item_id} {item_type}, rank int, {id_col} {id_type}, score long")]
    for p in range(passes):
        own = wanted if passes == 1 else wanted.where(F.pmod(F.xxhash64("i", "t"), F.lit(passes)) == p)
        rows = [(r.i, r.t) for r in own.collect()]
        found = _search_pass(docs, rows, k, id_col, text) if rows else None
        if found is not None:
            names = F.broadcast(spark.createDataFrame([(n, i) for n, (i, _) in enumerate(rows)], f"item int, item_id {item_type}"))
            out.append(found.join(names, "item").select(F.col("item_id").alias(item_id), "rank", F.col("id").alias(id_col), "score"))
    return reduce(DataFrame.unionByName, out)
