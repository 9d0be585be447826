"""Token counts by a map-side two-tier lookup of pre-token lengths.

A SentencePiece BPE model whose pieces hold the space mark only at their
front never merges across the border between a word and the following space,
so a text's count is the sum over its pre-tokens (a run of spaces and the word
behind it).  Tier one is a compact broadcast table with the lengths of
frequent pre-tokens; tier two is a cache in each Python worker that the
library fills on a miss.  No pre-token is shuffled.

Defined cases: a null text counts as empty, an empty text has 0 tokens; every
input row gives one output row (repeated rows stay repeated); other columns
are left alone; an empty table gives an empty table.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Tier one: at most so many pre-tokens, the most frequent ones.  They decide
#: what is looked up where, never a count.
FREQUENT = 20_000
#: Tier two: entries held by one worker before it starts anew, and the longest
#: pre-token that is kept.
CACHE_ENTRIES = 400_000
CACHED_CHARS = 48
MARK = "▁"


class TwoTier:
    """Counts of one model; ``frequent`` maps pre-tokens to lengths."""

    def __init__(self, model_file: str, frequent: dict[str, int]):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.frequent = frequent
        self.cache = dict(frequent)
        # a text with the mark itself, or a model that normalises or has pieces with an inner
        # mark, cannot be split at spaces: such texts go to the library whole
        pieces = [self.sp.id_to_piece(i) for i in range(self.sp.get_piece_size())]
        self.has_mark = MARK in pieces
        self.splits = all(MARK not in p.lstrip(MARK) for p in pieces) and self.has_mark and self._plain()

    def _plain(self) -> bool:
        """The model keeps spaces and characters as they are."""
        probe = "a  ﬁ b　é\nc "
        return self.sp.decode(self.sp.encode(probe)) == probe

    def library(self, text: str) -> int:
        return len(self.sp.encode(text, num_threads=1))

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if not self.splits or MARK in text:
            return self.library(text)
        words = text.split(" ")
        total, missed, get = 0, [], self.cache.get
        for k in map(get, words, words):
            if k.__class__ is int:
                total += k
            else:
                missed.append(k)
        if not missed:
            return total
        if "" in missed:  # runs of spaces: the pre-token takes the spaces before its word
            return self._with_runs(words)
        for w in missed:
            total += self._miss(w)
        return total

    def _with_runs(self, words: list[str]) -> int:
        if not words[-1]:  # spaces at the end are a pre-token without a word
            words = words[:-1]
            spaces = 0
            while words and not words[-1]:
                words = words[:-1]
                spaces += 1
            total = self.library(" " * spaces) if spaces else 1
        else:
            total = 0
        spaces = 0
        for w in words:
            if not w:
                spaces += 1
                continue
            w = " " * spaces + w
            spaces = 0
            total += self.cache.get(w) or self._miss(w)
        return total

    def _miss(self, word: str) -> int:
        k = self.library(word)
        if len(word) <= CACHED_CHARS:
            if len(self.cache) >= CACHE_ENTRIES:
                self.cache.clear()
                self.cache.update(self.frequent)
            self.cache[word] = k
        return k


_counters: dict[tuple, TwoTier] = {}


def _counter(model_file: str, shared) -> TwoTier:
    key = (model_file, shared.id if hasattr(shared, "id") else id(shared))
    if key not in _counters:
        _counters.clear()
        _counters[key] = TwoTier(model_file, shared.value)
    return _counters[key]


def frequent_lengths(docs: DataFrame, text: str, model_file: str, top: int = FREQUENT) -> dict[str, int]:
    """Lengths of the most frequent pre-tokens of all documents.  Every task
    counts its own, letting the rare ones go when its table is full, and sends
    at most ``top`` counts."""

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for b in batches:
            for t in b.column(0):
                seen.update(w for w in (t.as_py() or "").split(" ") if len(w) <= CACHED_CHARS)
                if len(seen) > 20 * top:
                    seen = Counter(dict(seen.most_common(5 * top)))
        seen.pop("", None)
        words = seen.most_common(top)
        yield pa.RecordBatch.from_pydict({"w": pa.array([w for w, _ in words], pa.string()), "n": pa.array([n for _, n in words], pa.int64())})

    part = docs.select(F.col(text).alias("t"))
    total: Counter[str] = Counter()
    for r in part.mapInArrow(counts, "w string, n long").groupBy("w").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "w").limit(top).collect():
        total[r.w] = r.n
    counter = TwoTier(model_file, {})
    return {w: counter.library(w) for w in total} if counter.splits else {}


def count_column(docs: DataFrame, text: str, model_file: str) -> Column:
    """A long column: the number of tokens of ``text``."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, text, model_file))

    @F.arrow_udf("long")
    def n_tokens(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = _counter(model_file, shared)
        for texts in parts:
            yield pa.array([counter.count(t.as_py()) for t in texts], pa.int64())

    return n_tokens(F.col(text))


def count_tokens(docs: DataFrame, model_file: str, limit: int = 4096, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``id_col, n_bytes, n_tokens, over_limit`` for every row of ``docs``."""
    tokens = docs.select(
        F.col(id_col),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
        count_column(docs, text, model_file).alias("n_tokens"),
    )
    return tokens.withColumn("over_limit", F.col("n_tokens") > limit)
