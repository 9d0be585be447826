"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on ordinary text, one on what
toxic texts hold in excess of it; both share the ordinary part, so ordinary
words compress alike with either.  A window is one word between spaces with a
fixed ordinary tail behind it (zstandard looks for no match in a block's last
bytes).  Its distance is the difference of its compressed lengths.  Evidence
of a text: the log-likelihood ratios of its windows' distances (learned on
labelled texts that the dictionaries have not seen), their largest distance,
and how many reach the upper threshold.  A logistic calibration makes a score
from 0 to 1 of it.

Learning uses a bounded sample of labelled rows, ``SAMPLE_ROWS`` by a hash of
the id and of each text the first ``SAMPLE_CHARS`` characters (documented
parameters); scoring covers every row and whole texts.

Defined cases: a null or empty text scores as one without evidence; labels
that are null are left out, conflicting ones count as toxic; with too few
labels of either kind every score is the share of toxic labels; repeated rows
get equal scores; other columns are left alone.
"""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.llm.common import release_freed, tidy, worker_cache

THRESHOLD = 0.3
#: Bound of the labelled sample, and of one text in it, in characters.
SAMPLE_ROWS, SAMPLE_CHARS = 10_000, 20_000
SHARED_BYTES, OWN_BYTES, TAIL_BYTES = 65_536, 8_192, 48
#: A word is typical of toxic texts if so many times as frequent there, with
#: enough texts to tell.
EXCESS, LEAST_EVIDENCE = 10.0, 12.0
#: Window distances that count as evidence.
LOWER_DISTANCE, UPPER_DISTANCE, CLIP = 2, 3, 20
CACHE_ENTRIES = 200_000
#: More than the entropy tables at a trained dictionary's start take.
TABLE_BYTES = 2_000

_WORD = re.compile(r"\w+")


def held_out(id_: Column) -> Column:
    """Rows kept from learning: crc32 of the id as text modulo 4 is 2."""
    return F.coalesce(F.pmod(F.crc32(id_.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def _key(word: str) -> bytes:
    return b" " + word.encode("utf-8", "replace") + b" "


@dataclass
class Model:
    """Dictionary contents, ratios by distance and calibration weights;
    without dictionaries every score is ``prior``."""

    prior: float
    ordinary: bytes = b""
    toxic: bytes = b""
    ratios: list[float] = field(default_factory=list)
    weights: list[float] = field(default_factory=list)


class Scorer:
    def __init__(self, model: Model):
        self.model = model
        self.cache: dict[str, int] = {}
        if model.ordinary:
            self.tail = model.ordinary[-TAIL_BYTES:]
            self.by_ordinary, self.by_toxic = self._compressor(model.ordinary), self._compressor(model.toxic)

    @staticmethod
    def _compressor(content: bytes):
        import zstandard

        params = zstandard.ZstdCompressionParameters(
            compression_level=3, min_match=4, strategy=zstandard.STRATEGY_BTLAZY2, window_log=18, hash_log=17, chain_log=17, search_log=6,
            write_content_size=False, write_checksum=False, write_dict_id=False, format=zstandard.FORMAT_ZSTD1_MAGICLESS,
        )
        words = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        words.precompute_compress(compression_params=params)
        return zstandard.ZstdCompressor(dict_data=words, compression_params=params).compress

    def distance(self, word: str) -> int:
        window = _key(word) + self.tail
        d = len(self.by_ordinary(window)) - len(self.by_toxic(window))
        return max(-CLIP, min(CLIP, d))

    def distances(self, text: str | None) -> np.ndarray:
        words = _WORD.findall(text.lower()) if text else []
        get, cache = self.cache.get, self.cache
        out = list(map(get, words))
        if None in out:
            for i, d in enumerate(out):
                if d is None:
                    w = words[i]
                    d = cache.get(w)
                    if d is None:
                        if len(cache) >= CACHE_ENTRIES:
                            cache.clear()
                        d = cache[w] = self.distance(w)
                    out[i] = d
        return np.array(out, np.int64)

    def features(self, d: np.ndarray) -> list[float]:
        n = max(len(d), 1)
        seen = d[d >= LOWER_DISTANCE]
        evidence = float(np.take(self.model.ratios, seen + CLIP).sum()) if len(seen) else 0.0
        return [1.0, evidence / n**0.5, evidence / 10, float(max(seen.max(), 0)) if len(seen) else 0.0, float(np.log1p((seen >= UPPER_DISTANCE).sum())), float(np.log1p(n))]

    def score(self, text: str | None) -> float:
        if not self.model.weights:
            return self.model.prior
        z = float(np.dot(self.features(self.distances(text)), self.model.weights))
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def _whole_words(content: bytes, size: int) -> bytes:
    """The last ``size`` bytes, from a word's start."""
    if len(content) <= size:
        return content
    content = content[-size:]
    return content[max(content.find(b" "), 0) :]


def _trained(samples: list[bytes], size: int, k: int, d: int) -> bytes:
    """The content of a zstandard dictionary of ``size`` bytes trained on the
    samples, which are words; the words themselves, the most frequent last,
    where all fit in (nothing is to be chosen then)."""
    import zstandard

    counts = Counter(samples)
    every = b"".join(w for w, _ in sorted(counts.items(), key=lambda x: (x[1], x[0])))
    if len(every) <= size:
        return every
    # the trained bytes begin with tables of the format, and the content's end
    # is what is kept: train a larger one, so that the tables are cut off
    trained = zstandard.train_dictionary(size + TABLE_BYTES, samples, k=k, d=d).as_bytes()
    if len(trained) < size + TABLE_BYTES // 2:
        return _whole_words(every, size)
    return _whole_words(trained, size)


def _padded(key: bytes) -> bytes:
    return key if len(key) >= 8 else key + key[1:] * -(-(8 - len(key)) // max(1, len(key) - 1))


def _without_copies(rows: list[tuple[str, int]]) -> list[tuple[str, int]]:
    """One of each crowd of near copies, whose words would pass for typical:
    texts go that share the least hash of three words in a row with an earlier
    one of their label, by any of three hashes."""
    for seed in range(3):
        first: dict[tuple, tuple[str, int]] = {}
        for t, y in rows:
            w = _WORD.findall(t.lower())
            least = min((zlib.crc32(" ".join(w[i : i + 3]).encode("utf-8", "replace"), seed) for i in range(len(w) - 2)), default=t)
            first.setdefault((y, least), (t, y))
        rows = list(first.values())
    return rows


def _dictionaries(rows: list[tuple[str, int]], rng: random.Random) -> tuple[bytes, bytes]:
    rows = _without_copies(rows)
    by_label: tuple[Counter, Counter] = (Counter(), Counter())
    for text, y in rows:
        by_label[y].update(set(_WORD.findall(text.lower())))
    n_toxic = sum(y for _, y in rows)
    n_ordinary = len(rows) - n_toxic
    ordinary = []
    for w, n in sorted(by_label[0].items(), key=lambda x: (-x[1], x[0]))[:60_000]:
        ordinary += [_padded(_key(w))] * min(n, 50)
    rng.shuffle(ordinary)
    shared = _trained(ordinary[:300_000], SHARED_BYTES + OWN_BYTES, 64, 8)
    typical = []
    for w, n in sorted(by_label[1].items()):
        excess = (n / n_toxic) / ((by_label[0][w] + 0.5) / n_ordinary)
        if excess > EXCESS and n * np.log(excess) >= LEAST_EVIDENCE:
            typical += [_padded(_key(w))] * n
    if not typical:
        return b"", b""
    rng.shuffle(typical)
    own = _trained(typical, OWN_BYTES, 16, 6)
    # both end in the shared part, and the ordinary one fills the same length
    split = shared.find(b" ", min(len(own), len(shared) // 8))
    return shared, own + shared[max(split, 0) :]


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Newton's method for ridge-penalised logistic regression."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (y - p) - ridge * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(rows: list[tuple[str, int]]) -> Model:
    """Learn from (text, label) pairs: two thirds of the distinct texts make
    the dictionaries, the rest the ratios and the calibration."""
    rows = sorted(dict.fromkeys((t, int(y)) for t, y in rows))
    model = Model(prior=float(np.mean([y for _, y in rows])) if rows else 0.0)
    parts: tuple[list, list] = ([], [])
    for t, y in rows:
        parts[zlib.crc32(t.encode("utf-8", "replace")) % 3 == 0].append((t, y))
    if any(len({y for _, y in p}) < 2 for p in parts):
        return model
    model.ordinary, model.toxic = _dictionaries(parts[0], random.Random(0))
    if not model.ordinary:
        return Model(model.prior)
    scorer = Scorer(model)
    seen = [(scorer.distances(t), y) for t, y in parts[1]]
    counts = [np.bincount(np.concatenate([d for d, y in seen if y == k]) + CLIP, minlength=2 * CLIP + 1).astype(float) for k in (0, 1)]
    shares = [(c + 0.2) / (c.sum() + 0.2 * len(c)) for c in counts]
    # a larger distance is never weaker evidence
    ratios = np.maximum.accumulate(np.maximum(np.log(shares[1] / shares[0]), 0.0))
    model.ratios = np.where(np.arange(-CLIP, CLIP + 1) >= LOWER_DISTANCE, ratios, 0.0).tolist()
    x = np.array([scorer.features(d) for d, _ in seen])
    model.weights = _logistic(x, np.array([y for _, y in seen], float)).tolist()
    return model


def train(docs: DataFrame, labels: DataFrame, learn_from: Column | None = None, id_col: str = "doc_id", text: str = "text", label: str = "toxic", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on at most about ``sample_rows`` labelled rows for which
    ``learn_from`` (over the id column) holds."""
    known = labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull())
    if learn_from is not None:
        known = known.where(learn_from)
    known = known.groupBy(F.col(id_col).alias("k")).agg(F.max(label).cast("int").alias("y"))
    part = int(min(1.0, sample_rows / max(1, known.count())) * (1 << 20))
    known = known.where(F.pmod(F.xxhash64("k"), F.lit(1 << 20)) < part)
    # the sample's bound is the broadcast's
    rows = docs.select(F.col(id_col).alias("k"), F.substring(text, 1, SAMPLE_CHARS).alias("t")).where("t is not null").join(F.broadcast(known), "k")
    sample = rows.select("t", "y").toArrow()
    pairs = list(zip(sample["t"].to_pylist(), sample["y"].to_pylist(), strict=True))
    del sample
    try:
        return fit(pairs)
    finally:
        del pairs
        release_freed()


_models = iter(range(1 << 62))


def score_column(spark, model: Model, text: str = "text") -> Column:
    shared, number = spark.sparkContext.broadcast(model), next(_models)

    def score(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        cache = worker_cache("toxicity")
        if number not in cache:
            cache.clear()
            cache[number] = Scorer(shared.value)
        scorer = cache[number]
        for texts in parts:
            yield pa.array([scorer.score(t.as_py()) for t in texts], pa.float64())

    return F.arrow_udf(tidy(score), "double")(F.col(text))


def scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, score`` for every row of ``docs``."""
    return docs.select(F.col(id_col), score_column(docs.sparkSession, model, text).alias("score"))


def remove_toxic(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below the threshold."""
    return docs.where(score_column(docs.sparkSession, model, text) < threshold)
