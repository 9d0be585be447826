"""Token-id files in ORC: stripes of run-length coded integers, row indexes
and Bloom filters on the document id.

``write_token_files`` range-partitions the texts by id, encodes each with the
``tokenizers`` library inside the sorted partitions and writes one ORC file per
partition, so the files are in ascending id order and so are the rows of each.
ORC codes the ids with its integer run-length encoding; readers prune stripes
and row groups by the id's statistics and Bloom filters, and read stripes in
parallel.

Defined cases: a null text counts as empty and yields the end id alone; null
ids come first; rows with equal ids stay, in no stated order among themselves,
and may lie in two adjacent files; other columns are not written; an empty
table gives an empty folder's schema.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator, Sequence
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from staylens.llm.common import cut

ORC_OPTIONS = {
    "orc.compress": "ZSTD",
    "orc.stripe.size": str(64 << 20),
    "orc.row.index.stride": "1000",
    "orc.create.index": "true",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
}
#: Entries of a worker's two caches (they keep what came first: frequent words
#: come early), and the longest piece of text kept.
CACHED_PIECES, CACHED_WORDS, CACHED_CHARS = 300_000, 600_000, 40
#: Separators that Python splits at but the tokenizer's pattern does not.
_ODD = regex.compile("[\x1c-\x1f]")
#: Characters for which Python and the library agree on case and normal form.
_COMMON = regex.compile("[\x00-\u024f]*+")


def byte_characters() -> dict[int, str]:
    """Byte-level vocabularies write each byte as a character: printable
    Latin-1 as itself, the others as the characters from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return {b: chr(b) if b in plain else chr(next(others)) for b in range(256)}


class _Words(dict):
    """Ids of pre-tokens; one that is absent is encoded."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        return self.encode(word)


class CachedEncoder:
    """Ids of whole texts, as little-endian 32-bit integers.

    For the pattern and normaliser that this class knows, a text of common
    characters is cut into pre-tokens in one go; the library's model encodes
    each distinct one once.

    Where the tokenizer's pre-tokens never hold white space, a text's ids are
    those of its white-space separated pieces one after the other; other texts
    are split there, their common pieces cut into pre-tokens, the rest given to
    the library, and pieces are cached.  All short cuts are tried on a probe
    first and not used if it differs."""

    #: Fixed value: the pre-token pattern of the vocabularies with word ends.
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    #: The same for the lower case of characters up to U+024F, all of whose
    #: letters and numbers it lists (no look-up of properties: twice as fast).
    LETTERS, NUMBERS = "a-zªµºß-öø-ʯⱥⱦ", "0-9²³¹¼-¾"
    PLAIN = rf"'(?:s|t|re|ve|m|ll|d)|[{LETTERS}]+|[{NUMBERS}]|[^\s{LETTERS}{NUMBERS}]+"
    PLAIN_PROBE = "Ab, c'd's  é 12\n\tß xy . Été NAÏVE-Wörter DON'T 1a2¼ $$$ ÀÉ ªº µ×÷ Ǆx\xa0ŉ\x85'rex 'v"
    PROBE = "Ab, c'd  é 12\n\tß x y　z . Été naïve—Wörter don't 1a2 $$$ ÀÉ"

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.model = self.tok.model
        self.pieces: dict[str, bytes] = {}
        self.words = _Words(self._word)
        self.plain = re.compile(self.PLAIN)
        self.characters = byte_characters()
        self.pattern = regex.compile(self.PATTERN)
        added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        # special strings are found in the raw text, so they must reach the library
        self.special = regex.compile("|".join(map(regex.escape, added)) or "(?!)")
        self.added = added
        whole = self._library([self.PROBE])[0]
        self.by_words = whole == b"".join(map(self._by_words, self.PROBE.split()))
        self.by_text = self.by_words and self._library([self.PLAIN_PROBE])[0] == self._plain(self.PLAIN_PROBE)
        self.splits = self.by_words or whole == b"".join(self._library(self.PROBE.split()))

    def _library(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<i4").tobytes() for e in self.tok.encode_batch(texts, add_special_tokens=False)] if texts else []

    def _by_words(self, piece: str) -> bytes:
        return b"".join(map(self.words.__getitem__, self.pattern.findall(piece.lower())))

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self.words.__getitem__, self.plain.findall(text.lower())))

    def _is_plain(self, text: str) -> bool:
        """Whether the text has common characters only and no special string."""
        if any(a in text for a in self.added) or _ODD.search(text):
            return False
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            # one capital becomes two characters in lower case
            return bool(_COMMON.fullmatch(text)) and "\u0130" not in text
        return True

    def _word(self, word: str) -> bytes:
        written = word if word.isascii() and word.isalnum() else word.encode().decode("latin-1").translate(self.characters)
        ids = array("i", [t.id for t in self.model.tokenize(written)]).tobytes()
        if len(self.words) < CACHED_WORDS and len(word) <= CACHED_CHARS:
            self.words[word] = ids
        return ids

    def _new(self, pieces: list[str]) -> dict[str, bytes]:
        plain = [w for w in pieces if self.by_words and _COMMON.fullmatch(w) and not self.special.search(w)]
        out = {w: self._by_words(w) for w in plain}
        rest = [w for w in pieces if w not in out]
        out.update(zip(rest, self._library(rest), strict=True))
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.splits:
            return self._library(texts)
        out = [self._plain(t) if self.by_text and self._is_plain(t) else None for t in texts]
        rest = [i for i, x in enumerate(out) if x is None]
        for i, x in zip(rest, self._by_pieces([texts[i] for i in rest]) if rest else (), strict=True):
            out[i] = x
        return out

    def _by_pieces(self, texts: list[str]) -> list[bytes]:
        odd = [i for i, t in enumerate(texts) if _ODD.search(t)]
        whole = dict(zip(odd, self._library([texts[i] for i in odd]), strict=True))
        parts = [() if i in whole else t.split() for i, t in enumerate(texts)]
        new = self._new(list(set().union(*parts) - self.pieces.keys()))
        room = CACHED_PIECES - len(self.pieces)
        kept = dict(islice(((w, x) for w, x in new.items() if len(w) <= CACHED_CHARS), max(room, 0)))
        self.pieces.update(kept)
        if len(kept) == len(new):
            find = self.pieces.__getitem__
            return [whole[i] if i in whole else b"".join(map(find, p)) for i, p in enumerate(parts)]
        old = self.pieces
        return [whole[i] if i in whole else b"".join([old[w] if w in old else new[w] for w in p]) for i, p in enumerate(parts)]


_encoders: dict[str, CachedEncoder] = {}


def _encoder(path: str) -> CachedEncoder:
    if path not in _encoders:
        _encoders[path] = CachedEncoder(path)
    return _encoders[path]


def _some(texts: pa.Array, max_chars: int = 2 << 20) -> Iterator[list[str]]:
    part, chars = [], 0
    for t in texts:
        t = t.as_py() or ""
        part.append(t)
        chars += len(t)
        if chars >= max_chars:
            yield part
            part, chars = [], 0
    if part:
        yield part


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text: str = "text") -> None:
    """Write ``doc_id, ids array<int>`` of every row of ``docs`` to ORC files
    under ``path`` in ascending id order (file by file, then row by row)."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = _encoder(tokenizer), np.array([end_id], "<i4").tobytes()
        for batch in batches:
            at = 0
            for texts in _some(batch.column(1)):
                ids = [x + end for x in enc.encode(texts)]
                ends = np.cumsum([0] + [len(x) // 4 for x in ids])
                values = pa.array(np.frombuffer(b"".join(ids), "<i4"), pa.int32())
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), lists], ["doc_id", "ids"])
                at += len(texts)

    # the tie-break lets rows with equal ids spread over partitions
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"), F.monotonically_increasing_id().alias("tie"))
    ordered = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    kind = docs.schema[id_col].dataType.simpleString()
    writer = ordered.mapInArrow(encode, f"doc_id {kind}, ids array<int>").write
    writer.options(**ORC_OPTIONS).orc(path)


def read_token_files(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    """``doc_id, ids, file`` (its number) as written, and the ``block`` of the
    file that a row was read from."""
    rows = spark.read.schema(f"doc_id {id_type}, ids array<int>").orc(path)
    name = F.element_at(F.split(F.input_file_name(), "/"), -1)
    # the writer numbers its files: "part-99999-..." comes before "part-100000-..."
    # (names of files that are read apart, and where a part of a file begins)
    return rows.select("*", F.regexp_extract(name, r"^part-(\d+)", 1).cast("long").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def find_documents(spark: SparkSession, path: str, ids: Sequence, id_type: str = "bigint") -> DataFrame:
    """The rows of some documents.  The filter reaches the files: stripes and
    row groups whose statistics or Bloom filters exclude the ids are not read."""
    rows = spark.read.schema(f"doc_id {id_type}, ids array<int>").orc(path)
    return rows.where(F.col("doc_id").isin(list(ids)))


def token_index(rows: DataFrame) -> DataFrame:
    """From rows of ``read_token_files``: ``doc_id, start, n_tokens,
    ids_crc32``.  Starts are running sums inside each file (bounded by a
    file's rows) plus the totals of the files before it."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(1)
            ends = np.asarray(lists.offsets).astype(np.int64)
            values = np.asarray(lists.values).astype("<u4", copy=False)
            crc = [zlib.crc32(values[x:y]) for x, y in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.diff(ends)), pa.array(crc, pa.int64()), *b.columns[2:]], ["doc_id", "n_tokens", "ids_crc32", "file", "block", "row"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    # a task reads the parts of a file in their order, rows in theirs
    placed = rows.select("doc_id", "ids", "file", "block", F.monotonically_increasing_id().alias("row"))
    flat = placed.mapInArrow(digest, f"doc_id {kind}, n_tokens long, ids_crc32 long, file long, block long, row long")
    # digests of the rows, written once: the files are read once
    flat = cut(flat, "token-digests")
    in_file = Window.partitionBy("file").orderBy(F.col("doc_id").asc_nulls_first(), "block", "row")
    ranked = flat.withColumn("own", F.sum("n_tokens").over(in_file) - F.col("n_tokens"))
    # one row per file: its number in the name gives its place
    totals = flat.groupBy("file").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("file", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    return ranked.join(totals, "file").select("doc_id", (F.col("base") + F.col("own")).alias("start"), "n_tokens", "ids_crc32")
