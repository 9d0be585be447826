"""Mixing to target weights by iterative proportional fitting, in DataFrame
functions alone.

Tokens are summed per cell (source, language, topic).  The cells are then
raked: scaled to the source shares, the language shares and the topic shares
in turn until all three margins agree with their targets, or ``MAX_SWEEPS``
times: targets can contradict each other (tempered shares do where one
dimension decides another), and then the last dimension scaled, the topic, is
on target and a warning names the margins that are not.  A document of a
cell is kept with the cell's calibrated weight over the largest one, so the
expected tokens of the sample have the target margins.  The draw is a hash of
the id: the same rows stay on every run.

Defined cases: null sources or languages are the value "(none)"; a null text
has no tokens; a cell without tokens has weight 1 before scaling; target
values without documents are left out and the rest is brought to 1; where a
dimension's targets are given, values that are not listed or have target 0 get
weight 0 and their tokens count for no margin; repeated
rows share a draw; a null id draws as the text "null"; an empty table gives an
empty result; other columns are left alone.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from staylens.llm.common import cut

DIMENSIONS = ("source", "lang", "topic")
#: Natural shares are tempered to this power where no targets are given.
TEMPER = 0.7
SWEEPS_PER_JOB, MAX_SWEEPS, TOLERANCE = 4, 60, 1e-9
SEED = 20240229


def n_tokens(text: Column) -> Column:
    """Runs of characters other than space, tab and line breaks."""
    return F.coalesce(F.regexp_count(text, F.lit("[^ \\t\\n\\r]+")), F.lit(0)).cast("long")


def topic_of(text: Column) -> Column:
    """A plain topic by rule: what a text holds, else how long it is."""
    t = F.coalesce(text, F.lit(""))
    return (
        F.when(F.lower(t).contains("license"), "license")
        .when(t.contains("@"), "contact")
        .when(F.length(t) < 1000, "note")
        .when(F.length(t) < 4000, "article")
        .otherwise("long read")
    )


def draw(id_: Column, seed: int = SEED) -> Column:
    """A number in [0, 1) that the id decides."""
    text = F.concat(F.coalesce(id_.cast("string"), F.lit("null")), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def cells_of(rows: DataFrame) -> DataFrame:
    """Documents and tokens per cell; one row per combination that occurs."""
    return rows.groupBy(*DIMENSIONS).agg(F.count(F.lit(1)).alias("docs"), F.sum("tokens").alias("tokens"))


def _sum(df: DataFrame, column: str) -> float:
    return float(df.agg(F.sum(column)).collect()[0][0] or 0.0)


def _wanted(targets: dict[str, dict[str, float]] | None) -> Column:
    """Cells whose every value has a target above 0, where targets are given."""
    out = F.lit(True)
    for d in DIMENSIONS:
        if targets and d in targets:
            out = out & F.col(d).isin(sorted(v for v, s in targets[d].items() if s > 0))
    return out


def with_targets(cells: DataFrame, targets: dict[str, dict[str, float]] | None, temper: float) -> DataFrame:
    """``t_<dimension>``: the target tokens of the value's margin (the sums
    that bring shares to 1 are single numbers)."""
    out = cells.where("tokens > 0").where(_wanted(targets))
    margins = {}
    for d in DIMENSIONS:
        if targets and d in targets:
            share = F.lit(None).cast("double")
            for value, s in sorted(targets[d].items()):
                share = F.when(F.col(d) == value, F.lit(float(s))).otherwise(share)
            margins[d] = out.select(d).distinct().withColumn("s", share)
        else:
            margins[d] = out.groupBy(d).agg(F.pow(F.sum("tokens").cast("double"), F.lit(temper)).alias("s"))
    for d in DIMENSIONS:
        out = out.join(margins[d].select(d, F.col("s").alias(f"s_{d}")), d)
    total = F.lit(_sum(out, "tokens"))
    scaled = [(F.col(f"s_{d}") / F.lit(_sum(margins[d], "s") or 1.0) * total).alias(f"t_{d}") for d in DIMENSIONS]
    return out.select(*DIMENSIONS, "docs", "tokens", *scaled)


def _sweep(cells: DataFrame) -> DataFrame:
    for d in DIMENSIONS:
        cells = cells.withColumn("w", F.col("w") * F.col(f"t_{d}") / F.sum("w").over(Window.partitionBy(d)))
    return cells


def rake(cells: DataFrame) -> DataFrame:
    """Cells with ``w``, the calibrated tokens.  The cells are as many as
    values combine, whatever the number of documents; each job does a few
    sweeps and sends one number, the largest deviation, to the driver."""
    cells = cells.withColumn("w", F.col("tokens").cast("double"))
    for _ in range(0, MAX_SWEEPS, SWEEPS_PER_JOB):
        for _ in range(SWEEPS_PER_JOB):
            cells = _sweep(cells)
        cells = cut(cells, "cells")
        off = [F.max(F.abs(F.col(f"m_{d}") / F.col(f"t_{d}") - 1)).alias(d) for d in DIMENSIONS]
        margins = cells.select("*", *[F.sum("w").over(Window.partitionBy(d)).alias(f"m_{d}") for d in DIMENSIONS])
        unmet = {d: x for d, x in margins.agg(*off).collect()[0].asDict().items() if (x or 0.0) >= TOLERANCE}
        if not unmet:
            break
    else:
        said = ", ".join(f"{d} by up to {x:.3g}" for d, x in unmet.items())
        warnings.warn(f"after {MAX_SWEEPS} sweeps margins are off their targets, relative to them: {said}; targets may contradict each other", RuntimeWarning, stacklevel=2)
    return cells


def _cell(text: str) -> Column:
    none = F.lit("(none)")
    return F.struct(
        F.coalesce(F.col("source").cast("string"), none).alias("source"),
        F.coalesce(F.col("lang").cast("string"), none).alias("lang"),
        topic_of(F.col(text)).alias("topic"),
        n_tokens(F.col(text)).alias("tokens"),
    )


def calibrated(rows: DataFrame, targets, temper: float) -> DataFrame:
    """The cells of ``rows`` (the dimensions and tokens) with their raked
    ``weight`` and ``probability``."""
    cells = cut(cells_of(rows), "cells")
    raked = rake(with_targets(cells, targets, temper)).select(*DIMENSIONS, (F.col("w") / F.col("tokens")).alias("weight"))
    weight = F.when(_wanted(targets), F.coalesce("weight", F.lit(1.0))).otherwise(F.lit(0.0))
    every = cells.select(*DIMENSIONS).join(raked, list(DIMENSIONS), "left").withColumn("weight", weight)
    top = every.agg(F.max("weight")).collect()[0][0] or 1.0
    return every.withColumn("probability", F.col("weight") / F.lit(top))


def mixture(docs: DataFrame, targets: dict[str, dict[str, float]] | None = None, temper: float = TEMPER, seed: int = SEED, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, source, lang, topic, n_tokens, weight, probability, kept`` for
    every row of ``docs``."""
    slim = cut(docs.select(F.col(id_col).alias("id"), _cell(text).alias("cell")).select("id", "cell.*"), "slim")
    out = slim.join(calibrated(slim, targets, temper), list(DIMENSIONS))
    kept = draw(F.col("id"), seed) < F.col("probability")
    return out.select(F.col("id").alias(id_col), *DIMENSIONS, F.col("tokens").alias("n_tokens"), "weight", "probability", kept.alias("kept"))


def sample_mixture(docs: DataFrame, targets: dict[str, dict[str, float]] | None = None, temper: float = TEMPER, seed: int = SEED, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the draw keeps, with their columns."""
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("doc"), _cell(text).alias("cell"))
    cells = calibrated(docs.select(_cell(text).alias("cell")).select("cell.*"), targets, temper)
    chance = cells.select(*[F.col(d).alias(f"cell_{d}") for d in DIMENSIONS], "probability")
    same = [F.col(f"cell.{d}") == F.col(f"cell_{d}") for d in DIMENSIONS]
    return rows.join(chance, same).where(draw(F.col(f"doc.{id_col}"), seed) < F.col("probability")).select("doc.*")
