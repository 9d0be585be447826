"""Every registered operator query against its SQL on the smallest tables, and
the pipeline's stages against brute force."""

from __future__ import annotations

import hashlib

import pytest

import corpus_pipeline
from staylens.checks.compare import compare
from staylens.llm import queries, raking
from staylens.llm.common import table
from tests.conftest import SF_SMALL
from tests.llm.test_operators import _brute_contamination, _brute_near, _jump


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_matches_oracle(spark, duck, name):
    out = compare(name, queries.QUERIES[name](spark, SF_SMALL), duck, queries.ORACLE[name], float_digits=None)
    assert out.ok, f"{name}: rows {out.rows_spark}/{out.rows_oracle} {out.detail}"


def test_one_query_per_operator():
    assert sorted(int(k[2:].split("_")[0]) for k in queries.QUERIES) == list(range(1, 14))


def test_pipeline_stages(spark):
    docs = table(spark, SF_SMALL, "documents")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_SMALL).cache()
        assert (out.columns == docs.columns) or name == "sharding"
        assert out.join(docs, "doc_id", "left_anti").count() == 0 and out.count() > 0
        seen[name] = out
        docs = out
    # each stage against brute force on its own input
    ids = {name: {r.doc_id for r in out.collect()} for name, out in seen.items()}
    texts = {r.doc_id: r.text for r in table(spark, SF_SMALL, "documents").collect()}
    toxic = {r.doc_id: r.toxic for r in table(spark, SF_SMALL, "labels").collect()}
    gone = texts.keys() - ids["toxicity"]
    assert len(gone) < 0.1 * len(texts) and not any(toxic.get(i) == 0 for i in gone)
    near = _brute_near([(i, texts[i]) for i in sorted(ids["toxicity"])], percent=corpus_pipeline.NEAR_PERCENT)
    assert ids["near_duplicates"] == {d for d, n, c in near if d == c}
    items = [(r.item_id, r.text) for r in table(spark, SF_SMALL, "benchmark").collect()]
    assert ids["decontamination"] == {i for i in ids["near_duplicates"] if not _brute_contamination(texts[i], items)[1]}
    weights = {r.doc_id: r for r in raking.mixture(seen["decontamination"], temper=corpus_pipeline.TEMPER).collect()}
    draw = lambda i: int(hashlib.md5(f"{i}:20240229".encode()).hexdigest()[:12], 16) / 2**48
    assert ids["mixture"] == {i for i, r in weights.items() if draw(i) < r.probability} and len(weights) == len(ids["decontamination"])
    assert {r.doc_id: r.shard for r in seen["sharding"].collect()} == {i: _jump(i, corpus_pipeline.SHARDS) for i in ids["mixture"]}
    ran = corpus_pipeline.run(spark, SF_SMALL)
    assert sorted(r.doc_id for r in ran.collect()) == sorted(r.doc_id for r in seen["sharding"].collect())


def test_pipeline_on_awkward_rows(spark, tmp_path):
    """Nulls, empty and repeated rows and columns with clashing names."""
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text, "en", "s", 3), (1, text, "en", "s", 3), (2, text + " more", None, None, None), (3, None, "en", "s", 0), (4, "", "en", "s", 0), (None, "a b c d e f", None, None, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars int"
    docs = spark.createDataFrame(rows, schema).selectExpr("*", "'x' as _id", "'y' as _digest", "1 as _n", "2 as found", "0 as shard")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_SMALL)
        assert out.columns == docs.columns
        empty = stage(spark, docs.where("false"), SF_SMALL)
        assert empty.count() == 0, name
        docs = spark.createDataFrame(out.collect(), out.schema)
    kept = sorted((r.doc_id is not None, r.doc_id or 0) for r in docs.collect())
    assert (True, 2) not in kept and kept.count((True, 1)) <= 1
