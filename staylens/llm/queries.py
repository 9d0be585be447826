"""One registered query per operator, each over its whole table with the
parameters meant for production; ``ORACLE`` has DuckDB SQL where SQL can
express the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.llm import blob_ledger, decontam, embed_dedup, lexical, minhash, pii, prefix_trie, raking, revisit, sharding, token_counts, token_orc, toxicity
from staylens.llm.common import table
from staylens.llm.oracles import ORACLE  # noqa: F401
from staylens.session import shared_path

#: Folder or function that gives a vocabulary file's place.
SHARDS = 8


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated"
    )


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels, learn_from=~toxicity.held_out(F.col("doc_id")))
    scored = toxicity.scores(docs, model)
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_slots(table(spark, sf_dir, "documents"), SHARDS)


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op5_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = raking.mixture(table(spark, sf_dir, "documents"))
    return out.withColumn("weight", F.round("weight", 6)).withColumn("probability", F.round("probability", 6))


def op6_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "llm-token-orc")
    token_orc.write_token_files(table(spark, sf_dir, "documents"), path, tokenizer_path("word_bpe_49k.json"), end_id=1)
    return token_orc.token_index(token_orc.read_token_files(spark, path))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.span_digests(pii.personal_data(table(spark, sf_dir, "documents")))


def op8_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = revisit.resolve(revisit.records_of_pages(table(spark, sf_dir, "pages")))
    return out.withColumn("headers", F.to_json("headers"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = blob_ledger.BlobLedger(spark, shared_path(spark, "llm-blob-ledger"))
    ledger.push(table(spark, sf_dir, "documents"), 0, keys=["doc_id"])
    return blob_ledger.span_digests(ledger.findings())


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_decontamination, op2_toxicity, op3_sharding, op4_minhash, op5_mixture, op6_token_orc, op7_pii, op8_revisits, op9_token_counts, op10_embedding_dedup,
        op11_lexical_search, op12_prefix_trie, op13_secret_scan,
    )
}
