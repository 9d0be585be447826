"""The training-data operators against brute force on small, awkward tables:
nulls, empty and long texts, ties, repeated rows, empty tables, clashing
columns."""

from __future__ import annotations

import hashlib
import random
import re
import tracemalloc
import warnings
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from staylens.llm import common, decontam, embed_dedup, minhash, pii, queries, raking, revisit, sharding, token_counts, token_orc, toxicity
from staylens.session import shared_path
from tests.conftest import SF_SMALL

LONG = "lorem ipsum dolor sit amet " * 4000
TEXTS = [
    "the quick brown fox jumps over the lazy dog and runs far away from here today",
    "The Quick brown fox jumps over the lazy dog and runs far away from here TODAY",
    None, "", "   \n\t ", "one two", "One  TWO", "été à la plage", LONG, LONG + "end", "a", "a",
    "x the quick brown fox jumps over the lazy dog and runs y",
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words string, score string, key string, probability string"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None if i % 3 == 0 else "en", None if i % 4 == 0 else "s", None, "n", "s", "k", "p") for i, t in enumerate(TEXTS)]
    rows += [rows[0], (None, TEXTS[0], None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _words(text, pattern):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(pattern, low)


# --- decontamination ----------------------------------------------------------
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _brute_contamination(text, items):
    words = _words(text, WORD)
    hit, ids = set(), set()
    for item, t in items:
        w = _words(t, WORD)
        k = min(10, len(w))
        if item is None or not k:
            continue
        grams = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}
        for i in range(len(words) - k + 1):
            if tuple(words[i : i + k]) in grams:
                hit |= set(range(i, i + k))
                ids.add(str(item))
    return len(words), len(hit), sorted(ids)


def test_decontamination_against_brute_force(spark, docs, empty, monkeypatch):
    items = [(1, TEXTS[0]), (2, "two"), (10, "over the lazy dog"), (3, None), (None, "fox"), (4, ""), (2, "plage"), (5, "à"), (6, "ipsum dolor sit amet lorem ipsum dolor sit amet lorem ipsum")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = [_brute_contamination(t, items) for t in [*TEXTS, TEXTS[0], TEXTS[0], None]]
    for block in (decontam.BLOCK_BYTES, 40):  # one block, several blocks
        monkeypatch.setattr(decontam, "BLOCK_BYTES", block)
        got = decontam.contamination(docs, bench).collect()
        assert sorted((r.n_words, r.n_hit, list(r["items"])) for r in got) == sorted(want)
        assert decontam.contamination(empty, bench).count() == 0
    assert all(r.n_hit == 0 for r in decontam.contamination(docs, bench.where("false")).collect())
    kept = decontam.remove_contaminated(docs, bench)
    assert kept.columns == docs.columns and kept.count() == sum(not w[1] for w in want)


def test_pattern_classes_find_every_occurrence():
    rng = np.random.default_rng(0)
    letters = ["a", "b", "ab", "ba", "aab"]
    text = " ".join(rng.choice(letters, 5000))
    items = [(str(i), " ".join(rng.choice(letters, int(n)))) for i, n in enumerate(rng.integers(1, 14, 40))]
    got = decontam.Matcher(items).search(pa.array([text, None, text[:50]])).to_pylist()
    for g, t in zip(got, [text, None, text[:50]], strict=True):
        assert (g["n_words"], len(g["hits"]), g["items"]) == _brute_contamination(t, items)


# --- near duplicates ------------------------------------------------------------
def _brute_near(rows, percent=85):
    def shingles(t):
        w = _words(t, r"[^\x20\x09-\x0D]+")
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())

    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return [(d, len(s), low.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))]


def test_near_duplicates_against_brute_force(spark, docs, empty):
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2] is None, r[2] or 0)
    base = "w0 w1 w2 w3 w4 w5 w6 w7 w8 w9".split()
    rng = np.random.default_rng(1)
    words = [f"u{i}" for i in rng.integers(0, 40, 120)]
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    for i in range(150):  # a crowd of edited copies, many of which are no links of each other
        copy = list(words)
        for j in rng.integers(0, len(copy), int(rng.integers(0, 5))):
            copy[j] = base[int(rng.integers(0, 10))]
        rows.append((1000 + i, " ".join(copy)))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in minhash.near_duplicates(table).collect()]
    assert sorted(got, key=key) == sorted(_brute_near(rows), key=key)
    assert minhash.near_duplicates(empty).count() == 0
    kept = minhash.remove_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, _, c in _brute_near([(r.doc_id, r.text) for r in docs.collect()]) if d == c or d is None}


def test_near_duplicates_grow_components_from_those_before(spark, monkeypatch):
    words = [f"g{i}" for i in range(120)]
    seen = []
    grow = minhash.components
    monkeypatch.setattr(minhash, "components", lambda edges: seen.append(edges.count()) or grow(edges))
    rows = [(i, " ".join([*words, f"end{i}"])) for i in range(4)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.component_id for r in minhash.near_duplicates(table).collect()} == {0}
    assert seen == [3]  # the first links settle every bucket: they are grouped once
    rng = np.random.default_rng(1)
    words, rows, seen[:] = [f"u{i}" for i in rng.integers(0, 40, 120)], [], []
    for i in range(150):
        copy = list(words)
        for j in rng.integers(0, len(copy), int(rng.integers(0, 5))):
            copy[j] = f"w{rng.integers(0, 10)}"
        rows.append((i, " ".join(copy)))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in minhash.near_duplicates(table).collect()]
    assert sorted(got) == sorted(_brute_near(rows))
    assert 1 < len(seen) <= 3


def test_pipeline_drops_near_copies_from_80_percent(spark):
    words = [f"v{i}" for i in range(50)]
    rows = []
    for k in range(30):  # 41 of 51 shingles: 0.804; with 49 words 40 of 50: 0.8; with 48 words below
        for i, n in enumerate((50, 49, 48)):
            text = [f"{w}_{k}_{n}" for w in words[:n]]
            changed = text[:20] + ["other"] + text[21:]
            rows += [(1000 * k + 10 * i, " ".join(text), 80), (1000 * k + 10 * i + 1, " ".join(changed), n)]
    table = spark.createDataFrame(rows, "doc_id long, text string, words long")
    kept = sorted(r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, table, SF_SMALL).collect())
    assert kept == sorted(d for d, _, n in rows if n not in (49, 50))
    at_85 = minhash.remove_near_duplicates(table, percent=85)
    assert at_85.count() == len(rows)
    assert (minhash.bands_for(85), minhash.bands_for(80)) == (16, 22)


def test_repeated_ids_are_judged_by_row(spark):
    text = lambda k: " ".join(f"{k}{i}" for i in range(60))
    near = lambda k: text(k) + " more"
    rows = [(1, text("a")), (1, text("a")), (2, near("a")), (3, text("a")), (3, text("b")), (4, text("c")), (4, text("c").upper()), (5, None), (5, None), (6, text("d")), (6, near("d")), (7, text("e")), (7, text("f")), (None, text("a"))]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [(r.doc_id, (r.text or "")[:2].lower()) for r in minhash.remove_near_duplicates(table).collect()]
    want = [(1, "a0"), (3, "b0"), (4, "c0"), (5, ""), (5, ""), (6, "d0"), (7, "e0"), (7, "f0"), (None, "a0")]
    assert sorted(kept, key=str) == sorted(want, key=str)


def test_circulant_signature_estimates_similarity():
    a = np.arange(4000, dtype=np.uint64)
    errors = []
    for shift in (200, 1000, 2000):
        x, y = common.mix64(a), common.mix64(a + np.uint64(shift))
        errors.append((minhash.signature(x) == minhash.signature(y)).mean() - (4000 - shift) / (4000 + shift))
    assert max(map(abs, errors)) < 0.2


def test_components(spark):
    edges = [(1, 2), (2, 3), (5, 4), (7, 7), (9, 8), (8, 10), (None, 3)] + [(100 + i, 101 + i) for i in range(60)]
    got = {r.node: r.root for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 8: 8, 9: 8, 10: 8, **{100 + i: 100 for i in range(61)}}


# --- sharding --------------------------------------------------------------------
def _jump(key, n):
    key, b, j = key % 2**64, -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_hash_equals_the_published_loop(spark):
    keys = [0, 1, 2, -1, 10**18, -(2**63), 2**63 - 1, *range(1000, 1400)]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    for n in (1, 2, 8, 9, 100):
        assert [r[0] for r in df.select(sharding.jump_shard(F.col("k"), n)).collect()] == [_jump(k, n) for k in keys]


def test_shard_slots(docs, empty):
    rows = sharding.shard_slots(docs, 3).collect()
    assert len(rows) == docs.count() and sharding.shard_slots(empty, 3).count() == 0
    for s in range(3):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    assert all(r.grown_shard in (r.shard, 3) for r in rows)
    text = {r.doc_id: r.text or "" for r in docs.collect()}
    assert all(r.size == len(text[r.doc_id].encode()) + 1 and r.text_crc32 == zlib.crc32(text[r.doc_id].encode()) for r in rows if r.doc_id is not None)
    assert sharding.with_shard(docs, 3).drop("shard").columns == docs.columns


def test_other_ids_are_hashed(spark):
    docs = spark.createDataFrame([(f"doc {i}", "t", "k") for i in range(300)] + [(None, "t", "k")], "doc_id string, text string, key string")
    slots = sharding.shard_slots(docs, 4).collect()
    assert len(slots) == 301 and {r.shard for r in slots} == {0, 1, 2, 3} and all(r.grown_shard in (r.shard, 4) for r in slots)
    assert {r.doc_id: r.shard for r in slots} == {r.doc_id: r.shard for r in sharding.with_shard(docs, 4).collect()}


def test_very_often_repeated_rows_take_slots_in_runs(spark, monkeypatch):
    monkeypatch.setattr(sharding, "RUN", 7)
    docs = spark.createDataFrame([(1, "t")] * 50 + [(2, "u")] * 3, "doc_id long, text string")
    rows = sharding.shard_slots(docs, 1).collect()
    assert sorted(r.slot for r in rows) == list(range(53)) and sum(r.doc_id == 1 for r in rows) == 50


# --- mixture ----------------------------------------------------------------------
def test_mixture_meets_its_margins(spark, docs, empty):
    rows = [(i, "w " * (1 + i % 7), ["en", "de", None][i % 3], f"s{i % 4 if i % 2 else 0}") for i in range(600)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    targets = {"lang": {"en": 2.0, "de": 1.0, "(none)": 1.0, "absent": 5.0}}
    out = raking.mixture(table, targets).toPandas()
    weighted = out.assign(w=out.n_tokens * out.weight).groupby("lang").w.sum()
    assert np.allclose(weighted / weighted.sum(), {"(none)": 0.25, "de": 0.25, "en": 0.5}.values() and [0.25, 0.25, 0.5], atol=1e-6)
    assert out.probability.max() == pytest.approx(1.0) and 0 < out.kept.mean() < 1
    kept = {r.doc_id for r in raking.sample_mixture(table, targets).collect()}
    assert kept == set(out[out.kept].doc_id)
    assert raking.mixture(docs).count() == docs.count() and raking.mixture(empty).count() == 0
    assert raking.sample_mixture(docs).columns == docs.columns and raking.sample_mixture(empty).count() == 0


def test_mixture_reports_contradicting_targets(spark):
    rows = [(i, "w w w", *(("en", "s0") if i < 80 else ("de", "s1" if i < 90 else "s2"))) for i in range(100)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    with pytest.warns(RuntimeWarning, match="source by up to"):
        raking.mixture(table)


def test_mixture_gives_unlisted_and_zero_targets_no_weight(spark):
    rows = [(i, "" if i % 11 == 0 else "w " * (1 + i % 7), ["en", "de", None, "fr"][i % 4], "only fr" if i % 4 == 3 else f"s{i % 3}") for i in range(600)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    targets = {"lang": {"en": 3.0, "de": 1.0, "(none)": 0.0}}
    with warnings.catch_warnings():
        warnings.simplefilter("error", RuntimeWarning)
        out = raking.mixture(table, targets).toPandas()
    away = out.lang.isin(["(none)", "fr"])
    assert (out[away].weight == 0).all() and (out[away].probability == 0).all() and not out[away].kept.any() and out[~away].kept.any()
    weighted = out.assign(w=out.n_tokens * out.weight).groupby("lang").w.sum()
    assert weighted["en"] / weighted.sum() == pytest.approx(0.75, abs=1e-6)


# --- token files and counts ---------------------------------------------------------
def test_token_files_round_trip(spark, docs, empty):
    from tokenizers import Tokenizer

    name = queries.tokenizer_path("word_bpe_49k.json")
    tok = Tokenizer.from_file(name)
    odd = ["<|endoftext|> a", "x<|startoftext|>y", "İstanbul Σας ΑΣ", "a\x1cb \x85 c", "é é", "　 ", "ＦＵＬＬ ﬁ ½ don't 12"]
    table = docs.select("doc_id", "text").union(spark.createDataFrame([(100 + i, t) for i, t in enumerate(odd)], "doc_id long, text string"))
    path = shared_path(spark, "test-orc")
    token_orc.write_token_files(table, path, name, end_id=1)
    back = token_orc.read_token_files(spark, path)
    want = sorted(([*tok.encode(r.text or "", add_special_tokens=False).ids, 1] for r in table.collect()))
    assert sorted(list(r.ids) for r in back.collect()) == want
    index = sorted(token_orc.token_index(back).collect(), key=lambda r: r.start)
    ids = [r.doc_id for r in index if r.doc_id is not None]
    assert ids == sorted(ids)
    assert [r.start for r in index] == np.cumsum([0] + [r.n_tokens for r in index])[:-1].tolist()
    assert sorted(r.ids_crc32 for r in index) == sorted(zlib.crc32(np.array(x, "<u4").tobytes()) for x in want)
    token_orc.write_token_files(empty, path + "-empty", name, end_id=1)
    assert token_orc.token_index(token_orc.read_token_files(spark, path + "-empty")).count() == 0


def test_a_lookup_skips_row_groups(spark):
    name = queries.tokenizer_path("word_bpe_49k.json")
    docs = spark.range(0, 20_000, numPartitions=1).selectExpr("id * 2 as doc_id", "concat('word ', id) as text")
    path = shared_path(spark, "test-orc")
    token_orc.write_token_files(docs, path, name, end_id=1)
    for wanted, found in ((31_000, 1), (31_001, 0)):  # within the statistics' range either way
        df = token_orc.find_documents(spark, path, [wanted])
        plan = df._jdf.queryExecution()
        assert df.count() == found and "PushedFilters: [In(doc_id" in plan.toString().replace("EqualTo(doc_id", "In(doc_id").replace("IsNotNull(doc_id), ", "")
        with_plan = df.select("doc_id")
        assert len(with_plan.collect()) == found
        leaves = with_plan._jdf.queryExecution().executedPlan().collectLeaves()
        read = sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))
        assert read <= 1000, read  # one row group of an index stride, not the file's 20,000 rows


def test_repeated_ids_keep_their_places(spark):
    name = queries.tokenizer_path("word_bpe_49k.json")
    docs = spark.range(3000).selectExpr("id % 3 as doc_id", "repeat('ab ', cast(id % 7 as int)) as text")
    path = shared_path(spark, "test-orc")
    token_orc.write_token_files(docs, path, name, end_id=1)
    rows = token_orc.read_token_files(spark, path)
    index = sorted(token_orc.token_index(rows).collect(), key=lambda r: r.start)
    assert [r.start for r in index] == np.cumsum([0] + [r.n_tokens for r in index])[:-1].tolist()
    # the files' own order: file by file, then row by row
    import pyarrow.orc as orc
    from pathlib import Path

    stream = [ids for f in sorted(Path(path).glob("part-*.orc")) for ids in orc.read_table(f)["ids"].to_pylist()]
    assert [r.ids_crc32 for r in index] == [zlib.crc32(np.array(x, "<u4").tobytes()) for x in stream]


def test_token_counts_equal_the_library(spark, docs, empty):
    import sentencepiece

    name = queries.tokenizer_path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=name)
    odd = [" ", "  ", " a", "a ", "a  b", "  a  b  ", "a\nb\tc", "<s> a</s>", "a▁b", "▁", "ﬁ é x　y", "日本 語", " \n ", "a   "]
    table = docs.select("doc_id", "text").union(spark.createDataFrame([(100 + i, t) for i, t in enumerate(odd)], "doc_id long, text string"))
    rows = table.withColumn("n", token_counts.count_column(table, "text", name)).collect()
    assert [r.n for r in rows] == [len(sp.encode(r.text or "")) for r in rows]
    assert token_counts.count_tokens(empty, name).count() == 0
    assert token_counts.count_tokens(docs, name, limit=5).where("over_limit").count() > 0


# --- personal data ---------------------------------------------------------------------
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _brute_pii(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            ok = {"email": True, "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else True, "card": 16 <= len(digits) <= 19 and pii.luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]
            if ok:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


def test_personal_data_against_the_plain_patterns(spark, docs, empty):
    rng = np.random.default_rng(3)
    alphabet = list("ab1.2@+-_ 0459é(") + ["4111 1111 1111 1111", "1.2.3.4", "x@y.z", "+1 (988) 555-2485"]
    texts = ["".join(rng.choice(alphabet, 60)) for _ in range(800)] + ["a@b.c_d@e.f", "@a.b@c.d", "9" * 5000, "1.2.3.0000004", "1.2.3.4.5.6.7.8", "a" * 3000 + "@", *TEXTS]
    table = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, spans string")
    got = {r.doc_id: r for r in pii.span_digests(pii.personal_data(table)).collect()}
    for i, t in enumerate(texts):
        want = _brute_pii(t)
        assert got[i].base_sha256 == hashlib.sha256(want.encode()).hexdigest(), t
        base = ",".join(s for s in got[i].spans.split(",") if s.split(":")[0] in BASE)
        assert base == want and got[i].n_email == want.count("email:")
    assert pii.personal_data(empty).count() == 0 and pii.personal_data(docs).count() == docs.count()


def test_added_kinds_need_checksum_and_context():
    find = lambda t: {k: [t[a:b] for a, b in v] for k, v in pii.find_spans(t).items() if v}
    assert find("IBAN DE89 3704 0044 0532 0130 00 THE END")["iban"] == ["DE89 3704 0044 0532 0130 00"]
    assert "iban" not in find("IBAN DE88 3704 0044 0532 0130 00")
    assert find("amex card 378282246310005")["short_card"] == ["378282246310005"]
    assert find("number 378282246310005") == {}
    assert find("SSN: 123-45-6789")["ssn"] == ["123-45-6789"] and find("item 123-45-6789") == {}


def test_ibans_before_words_and_of_every_country():
    find = lambda t: [t[a:b] for a, b in pii.find_spans(t)["iban"]]
    de, gb = "DE89370400440532013000", "GB29NWBK60161331926819"
    for after in ("", " now", " Please", " Account 3", " IS MY ACCOUNT NUMBER HERE", " 12 items", ".", ", Please", "  X", "\nX", " X" * 3000):
        assert find(f"pay {de}{after}") == [de], after
        assert find(f"IBAN {gb}{after}") == [gb], after
    assert find(f"{de} {gb} GB29 NWBK 6016 1331 9268 19 And {de}") == [de, gb, "GB29 NWBK 6016 1331 9268 19", de]
    assert find(f"REF AB12 {de} OK") == [de] and find(f"DE12 {de}") == [de]
    for wrong in (f"x{de}", f"{de}7", f"{de}x", de[:-1], "DE88" + de[4:], "ZZ" + de[2:], de[:8] + "  " + de[8:]):
        assert find(wrong) == [], wrong
    published = "BR1800360305000010009795493C1 KW81CBKU0000000000001234560101 LC55HEMM000100010012001200023015 MU17BOMM0101101030300200000MUR PK36SCBL0000001123456702 UA213223130000026007233566001 EG380019000500000000263180002 NO9386011117947 MT84MALT011000012345MTLCAST001S"
    assert find(published.replace(" ", " Then ")) == published.split()
    for country, n in pii.IBAN_LENGTH.items():
        bban = "7" * (n - 4)
        check = 98 - int("".join(str(int(c, 36)) for c in f"{bban}{country}00")) % 97
        assert find(f"to {country}{check:02d}{bban} Next") == [f"{country}{check:02d}{bban}"]


# --- revisits -----------------------------------------------------------------------------
def test_revisits(spark):
    rows = [
        (1, "response", "http://www.A.org/x?utm_source=q#top", 10, "d1", {"etag": "e1", "date": "1", "server": "s"}),
        (2, "revisit", "https://a.org/x/", 20, "d1", {"etag": "e1", "date": "2", "server": "t"}),
        (3, "response", "a.org/x", 90_000, "d2", None),
        (4, "revisit", "a.org/x", 90_000, "d2", {}),  # tie: the smaller id is earlier
        (5, "revisit", "a.org/x", 400_000, "d9", None),  # digest differs, found slices before
        (6, "revisit", "a.org/none", 5, "d", None),
        (7, "revisit", None, 5, "d", None),
        (8, "revisit", "a.org/x", None, "d", None),
        (9, "revisit", "a.org/x", 5, "d1", None),  # before any response
        (6, "revisit", "a.org/none", 5, "d", None),
    ]
    table = spark.createDataFrame([(*r, "c") for r in rows], "record_id long, kind string, url string, ts long, digest string, headers map<string,string>, status string")
    got = sorted((r.record_id, r.target_id, r.status) for r in revisit.resolve(table).fillna(-1, ["target_id"]).collect())
    orphan = lambda i: (i, -1, "orphan")
    assert got == [(2, 1, "resolved"), (4, 3, "resolved"), (5, 3, "mismatch"), orphan(6), orphan(6), orphan(7), orphan(8), orphan(9)]
    head = revisit.resolve(table).where("record_id = 2").collect()[0].headers
    assert head == {"etag": "e1", "date": "2", "server": "s"}
    assert revisit.resolve(table.where("false")).count() == 0
    assert revisit.resolve(table, slice_seconds=7).count() == 8


def test_weak_validators_do_not_decide(spark):
    rows = []
    cases = [({"etag": 'W/"1"'}, {"etag": '"1"'}, "resolved"), ({"etag": '"2"'}, {"etag": '"1"'}, "mismatch"), ({"etag": "W/x", "last-modified": "b"}, {"etag": "y", "last-modified": "a"}, "mismatch"),
             ({"last-modified": "a"}, {"last-modified": "a"}, "resolved"), ({"last-modified": "b"}, {"last-modified": "a"}, "mismatch"), ({"last-modified": "b"}, {}, "resolved"), ({}, {"etag": "1"}, "resolved")]
    for i, (asked, had, _) in enumerate(cases):
        rows += [(2 * i, "response", f"a.org/{i}", 1, "d", had), (2 * i + 1, "revisit", f"a.org/{i}", 2, "d", asked)]
    table = spark.createDataFrame(rows, "record_id long, kind string, url string, ts long, digest string, headers map<string,string>")
    got = {r.record_id: r.status for r in revisit.resolve(table).collect()}
    assert [got[2 * i + 1] for i in range(len(cases))] == [c[2] for c in cases]


# --- vectors ---------------------------------------------------------------------------------
def test_vector_links_against_brute_force(spark):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((400, 16))
    x[200:300] = x[0] + 0.12 * rng.standard_normal((100, 16))  # a crowd around one vector, near the threshold
    x[300:350] = x[1]
    rows = [(i, v.astype(np.float32).astype(float).tolist()) for i, v in enumerate(x)]
    rows += [(1000, None), (1001, [0.0] * 16), (1002, [float("nan")] * 16), (1003, [None, *[1.0] * 15]), (1004, [1.0, 2.0]), (1005, [])]
    table = spark.createDataFrame([(*r, "c") for r in rows], "vec_id long, embedding array<double>, raw string")
    got = {r.vec_id: r for r in embed_dedup.near_duplicate_vectors(table).collect()}
    v = np.array([r[1] for r in rows[:400]])
    u = v / np.linalg.norm(v, axis=1)[:, None]
    links = (u @ u.T >= 0.95) & ~np.eye(400, dtype=bool)
    n = links.sum(1)
    found = sum(got[i].n_links for i in range(400))
    assert found >= 0.9 * n.sum() and all(got[i].n_links <= n[i] for i in range(400))
    assert all(got[i].n_links == 0 and got[i].component_id == i and got[i].kept for i in range(1000, 1006))
    assert all(got[i].component_id == 1 for i in range(300, 350))
    empty = embed_dedup.near_duplicate_vectors(table.where("false"))
    assert empty.count() == 0


def test_vectors_of_any_length_and_scale(spark):
    base = [0.3, -0.2, 0.9]
    scaled = lambda k: [x * k for x in base]
    rows = [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [2.0, 4.0]), (4, [-1.0, -2.0]), (10, base), (11, scaled(1e-170)), (12, scaled(1e160)), (13, scaled(-1.0)),
            (20, [1.0]), (21, [2.5]), (22, [-3.0]), (23, [1e-300]), (24, [0.0])]
    got = {r.vec_id: (r.n_links, r.component_id) for r in embed_dedup.near_duplicate_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    want = {1: (2, 1), 2: (2, 1), 3: (2, 1), 4: (0, 4), 10: (2, 10), 11: (2, 10), 12: (2, 10), 13: (0, 13), 20: (2, 20), 21: (2, 20), 22: (0, 22), 23: (2, 20), 24: (0, 24)}
    assert got == want


def test_multi_index_visits_cells_in_order_and_reaches_its_recall():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((1500, 24))
    x /= np.linalg.norm(x, axis=1)[:, None]
    index = embed_dedup.fit_index(x, 1500)
    d1 = embed_dedup._squares(x[:5, :12], index.first)
    d2 = embed_dedup._squares(x[:5, 12:], index.second)
    sums = (d1[:, :, None] + d2[:, None, :]).reshape(5, -1)
    t = min(9, index.cells)
    got = np.take_along_axis(sums, index.order(x[:5], t), 1)
    assert np.allclose(got, np.sort(sums, 1)[:, :t])


# --- toxicity ----------------------------------------------------------------------------------
def test_toxicity_on_held_out_texts(spark, docs, empty):
    rng = np.random.default_rng(4)
    plain = ["".join(rng.choice(list("abcdefghij"), int(n))) for n in rng.integers(4, 9, 400)]
    bad = ["worthless", "disgusting", "pathetic"]

    def text(toxic):
        w = list(rng.choice(plain, 60))
        for _ in range(4 * toxic):
            w[int(rng.integers(60))] = str(rng.choice(bad))
        return " ".join(w)

    rows = [(i, text(i % 4 == 0), int(i % 4 == 0)) for i in range(1200)]
    table = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(5, None), (None, 1), (10**6, 1)], "doc_id long, toxic int")
    model = toxicity.train(table, labels, learn_from=~toxicity.held_out(F.col("doc_id")))
    got = {r.doc_id: r.score for r in toxicity.scores(table, model).collect()}
    held = [(got[i] >= 0.3, y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert np.mean([p for p, y in held if y]) > 0.85 and np.mean([p for p, y in held if not y]) < 0.1
    scores = toxicity.scores(docs, model).collect()
    assert len(scores) == docs.count() and all(0 <= r.score <= 1 for r in scores)
    assert len({r.score for r in scores if r.doc_id in (2, 3)}) == 1  # null and empty
    assert toxicity.scores(empty, model).count() == 0
    nothing = toxicity.train(table, labels.where("toxic = 0"))
    assert {r.score for r in toxicity.scores(table, nothing).collect()} == {0.0}
    assert toxicity.remove_toxic(docs, model).columns == docs.columns


def test_toxicity_learns_in_little_memory(spark, monkeypatch):
    released = []
    monkeypatch.setattr(toxicity, "release_freed", lambda: released.append(1))
    table = spark.createDataFrame([(1, "a b"), (2, "c d")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    assert toxicity.train(table, labels).prior == 0.5
    assert released
    # a word that many texts hold is one object, however often it is a sample
    rows = [(" ".join([f"first{k}", f"then{k}", *(f"word{i:05d}longer" for i in range(8_000))][:: 1 if k % 2 else -1]), 0) for k in range(50)]
    rows += [(f"bad{k} bad words here{k}", 1) for k in range(40)]
    monkeypatch.setattr(toxicity, "_without_copies", lambda rows: rows)
    monkeypatch.setattr(toxicity, "_trained", lambda samples, size, k, d: b" x ")
    tracemalloc.start()
    try:
        toxicity._dictionaries(rows, random.Random(0))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 16 << 20
