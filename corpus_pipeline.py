"""A training corpus out of ``documents`` in five stages.

Each stage takes (spark, docs, sf_dir), works on every row that its
predecessor kept and returns a DataFrame, which ``run`` writes as Parquet into
the shared folder and reads again for the next one:

1. toxicity          - rows that the compression-distance score rejects go;
2. near_duplicates   - one document of each near-duplicate group stays;
3. decontamination   - rows that hold a benchmark window go;
4. mixture           - rows are sampled to source, language and topic weights;
5. sharding          - rows get their shard by jump consistent hashing.

All stages but the last return the columns of ``documents``.

Defined cases, in every stage: a null text counts as empty; empty texts and
rows without an id stay where nothing speaks against them (no word is toxic, no
shingle or window occurs, a cell without tokens keeps weight 1); of rows that
repeat an id and text one stays; extra columns pass through, whatever their
names (but for ``shard``, which the last stage sets); an empty table gives an
empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.llm import decontam, minhash, raking, sharding, toxicity
from staylens.llm.common import cut, table

#: Natural shares to this power are the mixture's targets: mild, so that the
#: sample keeps most of the clean documents.
TEMPER = 0.95
SHARDS = 8
#: Documents as similar as this (five-word shingles, Jaccard) are near duplicates.
NEAR_PERCENT = 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The model learns from the labelled rows of the whole table that are not
    held out; it scores every row of ``docs``."""
    known, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train(known, labels, learn_from=~toxicity.held_out(F.col("doc_id")))
    return toxicity.remove_toxic(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.remove_near_duplicates(docs, percent=NEAR_PERCENT)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return raking.sample_mixture(docs, temper=TEMPER)


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.with_shard(docs, SHARDS)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixture", mix_sources),
    ("sharding", assign_shards),
]

#: The first stage's model is trained, which SQL cannot express; tests/llm
#: holds each stage against brute force on its own input instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
