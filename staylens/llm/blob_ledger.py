"""Secret scans over the history of a corpus, kept in a ledger of blobs.

Every historical version of a path is content-addressed: its blob is the
SHA-256 of the text.  A push brings new versions; each distinct blob is scanned
once per version of a rule, so only pairs of blob and rule version that no
earlier push has scanned cost work, and findings are joined back to all paths
and versions that carry the blob.

The ledger is three Parquet tables under one folder, one ``push=N`` folder per
push in each:

* ``findings`` (blob, kind, rule_version, start, end): spans in code points;
* ``scans`` (blob, rules): which rule versions were run, also without a finding;
* ``versions`` (the key columns, blob), written last: it commits the push.

A push reads only earlier pushes and overwrites its own folders, so it can be
run again after a failure.  Copies collapse before the shuffle (a partial
aggregate per blob); a blob that a third of all versions carry is scanned once.

Positions come from lengths alone: the texts between matches and the matches
are cut out in one pass each, and a running sum of their lengths gives the
spans, in time linear in the text and its matches.

Defined cases: a null text counts as empty; key columns may be null; repeated
rows give repeated rows; equal spans of different kinds all stay; other columns
are left alone (keys may not be named ``_blob``, ``push`` or ``spans``); an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from staylens.session import path_exists


@dataclass(frozen=True)
class Rule:
    """A kind of secret: the leftmost, non-overlapping matches of ``pattern``
    whose ``group`` has ``min_chars`` characters or more.  A changed pattern
    needs a new ``version``; it is then run over every blob again.  Every match
    must hold one of the ``hints``, if there are any (in lower case where
    ``any_case``): a text without them is not searched."""

    kind: str
    pattern: str
    group: int = 0
    min_chars: int = 1
    hints: tuple[str, ...] = ()
    any_case: bool = False
    version: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}:{self.version}"


BASE_RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, ("passw", "secret", "token", "api"), True),
    Rule("access", r"AKIA[A-Z0-9]{16,}", hints=("AKIA",)),
    Rule("hex", r"[0-9a-f]{24,}"),
)
ADDED_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", hints=("-----BEGIN ",)),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", hints=("eyJ",)),
    Rule("host_token", r"gh[pousr]_[A-Za-z0-9]{36,}", hints=("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}", hints=("xox",)),
)
RULES = BASE_RULES + ADDED_RULES

_FINDINGS = "blob binary, kind string, rule_version int, start long, end long, push int"
_SCANS = "blob binary, rules array<string>, push int"


def blob_of(text: str) -> Column:
    """The content address of a text."""
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256))


def _pieces(rule: Rule, number: int) -> Column:
    """Per match, in order: the lengths of the text before it, of the match and
    of its counted group."""
    text, pattern = F.col("text"), F.lit(rule.pattern)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    counted = whole if not rule.group else F.regexp_extract_all(text, pattern, F.lit(rule.group))
    zipped = F.arrays_zip(F.split(text, rule.pattern, -1).alias("gap"), whole.alias("match"), counted.alias("counted"))
    lengths = F.transform(
        zipped,
        lambda x, i: F.struct(
            F.lit(number).alias("rule"),
            i.alias("i"),
            F.char_length(x["gap"]).cast("long").alias("gap"),
            F.char_length(x["match"]).cast("long").alias("size"),
            F.char_length(x["counted"]).alias("counted"),
        ),
    )
    return F.when(_may_hit(rule), lengths)


def _may_hit(rule: Rule) -> Column:
    text = F.col("text")
    found = text.rlike(rule.pattern)
    if rule.hints:
        where = F.lower(text) if rule.any_case else text
        found = reduce(or_, [F.contains(where, F.lit(h)) for h in rule.hints]) & found
    return F.array_contains("todo", rule.name) & found


def scan(blobs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``blob, kind, rule_version, start, end`` of every finding in ``blobs``
    (blob, text, todo: the names of the rules to run)."""
    nothing = F.array().cast("array<struct<rule: int, i: int, gap: bigint, size: bigint, counted: int>>")
    pieces = F.concat(*[F.coalesce(_pieces(r, k), nothing) for k, r in enumerate(rules)])
    # most blobs hit nothing: they are left out before anything is cut to pieces
    hits = blobs.where(reduce(or_, [_may_hit(r) for r in rules]))
    rows = hits.select("blob", pieces.alias("pieces"))
    rows = rows.select("blob", F.explode("pieces").alias("p")).select("blob", "p.*").where("size is not null")
    before = Window.partitionBy("blob", "rule").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(before))
    least = F.array(*[F.lit(r.min_chars) for r in rules])
    kind = F.array(*[F.lit(r.kind) for r in rules])
    version = F.array(*[F.lit(r.version) for r in rules])
    rows = rows.where(F.col("counted") >= F.get(least, F.col("rule")))
    return rows.select("blob", F.get(kind, "rule").alias("kind"), F.get(version, "rule").alias("rule_version"), (F.col("end") - F.col("size")).alias("start"), "end")


class BlobLedger:
    """The ledger under ``path``, a folder that driver and executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _table(self, name: str, schema: str) -> DataFrame:
        if not path_exists(self.spark, f"{self.path}/{name}"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")

    def todo(self, blobs: DataFrame, number: int, rules: Sequence[Rule] = RULES) -> DataFrame:
        """``blobs`` with the column ``todo``: the names of the rule versions
        that no push before ``number`` ran on the blob; blobs without any go."""
        names = F.array(*[F.lit(r.name) for r in rules])
        if number == 0 or not path_exists(self.spark, f"{self.path}/scans"):
            return blobs.withColumn("todo", names)
        scans = self._table("scans", _SCANS).where(F.col("push") < number)
        seen = scans.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("seen"))
        rows = blobs.join(seen, "blob", "left")
        rows = rows.withColumn("todo", F.when(F.col("seen").isNull(), names).otherwise(F.array_except(names, F.col("seen"))))
        return rows.drop("seen").where(F.size("todo") > 0)

    def push(self, versions: DataFrame, number: int, keys: Sequence[str], text: str = "text", rules: Sequence[Rule] = RULES) -> None:
        """Take push ``number`` (0, 1, ...): ``versions`` has one row per path
        and version, named by ``keys``, and its whole text."""
        if reserved := {"_blob", "push", "spans"} & set(keys):
            raise ValueError(f"key columns may not be named {sorted(reserved)}")
        rows = versions.select(*[F.col(k) for k in keys], blob_of(text).alias("_blob"))
        texts = versions.select(blob_of(text).alias("blob"), F.coalesce(F.col(text), F.lit("")).alias("text"))
        texts = texts.groupBy("blob").agg(F.first("text").alias("text"))
        found = scan(self.todo(texts, number, rules), rules)
        found.write.mode("overwrite").parquet(f"{self.path}/findings/push={number}")
        blobs = self.todo(rows.select(F.col("_blob").alias("blob")).distinct(), number, rules)
        blobs.select("blob", F.col("todo").alias("rules")).write.mode("overwrite").parquet(f"{self.path}/scans/push={number}")
        rows.write.mode("overwrite").parquet(f"{self.path}/versions/push={number}")

    def versions(self) -> DataFrame:
        """The key columns, ``_blob`` and ``push`` of every committed version."""
        return self.spark.read.parquet(f"{self.path}/versions")

    def findings(self, rules: Sequence[Rule] = RULES) -> DataFrame:
        """Every committed version with ``spans``: the findings (start, rank of
        its rule, end) of ``rules`` in its blob, in that order, or an empty
        array."""
        versions = self.versions()
        ranks = self.spark.createDataFrame([(r.kind, r.version, k) for k, r in enumerate(rules)], "kind string, rule_version int, rank int")
        found = self._table("findings", _FINDINGS).join(F.broadcast(ranks), ["kind", "rule_version"])
        found = found.where(F.col("push") <= versions.agg(F.max("push")).scalar())
        by_blob = found.groupBy(F.col("blob").alias("_blob")).agg(F.array_sort(F.collect_list(F.struct("start", "rank", "end"))).alias("spans"))
        rows = versions.join(by_blob, "_blob", "left")
        none = F.array().cast("array<struct<start: bigint, rank: int, end: bigint>>")
        return rows.withColumn("spans", F.coalesce("spans", none))


def span_digests(found: DataFrame, rules: Sequence[Rule] = RULES, base: Sequence[Rule] = BASE_RULES) -> DataFrame:
    """From ``BlobLedger.findings``: counts of the base kinds, the digest of
    the base spans and all spans as text, by start, then kind as listed."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    base_ranks = [k for k, r in enumerate(rules) if r in base]

    def written(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))), ",")

    def of_ranks(*ranks: int) -> Column:
        return F.filter("spans", lambda s: s["rank"].isin(*ranks))

    counts = [F.size(of_ranks(k)).cast("long").alias(f"n_{rules[k].kind}") for k in base_ranks]
    others = [c for c in found.columns if c not in ("spans", "_blob", "push")]
    return found.select(*others, *counts, F.sha2(written(of_ranks(*base_ranks)), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))
