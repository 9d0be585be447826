"""Hand-made edge cases (FIXTURES §3) for the generic operators."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from staylens.functions.expressions import decode_flag, months_before, normalize_dmy_date, pct_change
from staylens.operators import aggregates as A
from staylens.operators import quality
from staylens.operators.joins import full_outer_small_right
from staylens.operators.ranking import top_bottom_n
from staylens.operators.scd2 import scd2_merge, scd2_rebuild
from staylens.operators.temporal import temporal_left_join
from staylens.operators.upsert import upsert

D = dt.date


def test_normalize_dmy_date(spark):
    cases = {
        "05/09/2020": "2020-09-05",
        "5/9/2020": "2020-09-05",
        " 05/09/2020 ": "2020-09-05",
        "31/02/2020": "31/02/2020",   # not a date: unchanged
        "05/09/20": "05/09/20",       # two-digit year: unchanged
        "a/b": "a/b",
        "2020-09-05": "2020-09-05",   # ISO: untouched (no '/')
        "1/2/2020 x": "1/2/2020 x",
    }
    df = spark.createDataFrame([(k,) for k in cases], "s string")
    got = {r.s: r.n for r in df.select("s", normalize_dmy_date("s").alias("n")).collect()}
    assert got == cases


def test_decode_flag(spark):
    df = spark.createDataFrame([("t",), ("f",), ("",), ("T",), (None,)], "s string")
    got = [r.b for r in df.select(decode_flag("s").alias("b")).collect()]
    assert got == [True, False, None, None, None]


def test_months_before_clamps_month_end(spark):
    df = spark.createDataFrame([(D(2020, 2, 29),), (D(2021, 3, 31),)], "d date")
    got = [r.x for r in df.select(months_before("d", 12).alias("x")).collect()]
    assert got == [D(2019, 2, 28), D(2020, 3, 31)]


def test_round_ratio_is_exact_half_up(spark):
    # 2469 / 20000 * 100 = 12.345 exactly -> 12.35 (a DOUBLE division gives 12.34)
    df = spark.createDataFrame([(2469, 20000), (1, 3), (2, 3), (5, 0)], "p long, t long")
    got = [r.x for r in df.select(A.round_ratio("p", "t").alias("x")).collect()]
    assert got == [12.35, 33.33, 66.67, None]


def test_median_exact(spark):
    rows = [("even", 1.0), ("even", 2.0), ("even", 10.0), ("even", 11.0),
            ("odd", 1.0), ("odd", 5.0), ("odd", 7.0), ("nulls", None), ("one", 3.0)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {r.g: r.m for r in df.groupBy("g").agg(A.median("x").alias("m")).collect()}
    assert got == {"even": 6.0, "odd": 5.0, "nulls": None, "one": 3.0}


def test_median_by_matches_percentile(spark):
    rows = [("even", 1.0), ("even", 2.0), ("even", 10.0), ("even", 11.0),
            ("odd", 1.0), ("odd", 5.0), ("odd", 7.0), ("one", 3.0),
            ("dups", 2.0), ("dups", 2.0), ("dups", 2.0), ("dups", 9.0),
            ("tie_mid", 0.1), ("tie_mid", 0.2), ("nulls", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {r.g: r.median for r in A.median_by(df, ["g"], "x").collect()}
    want = {r.g: r.m for r in df.groupBy("g").agg(A.median("x").alias("m")).collect() if r.m is not None}
    assert got == want  # bit-for-bit, groups with no values produce no row
    assert got["even"] == 6.0 and got["dups"] == 2.0


def test_median_by_of_few_groups_is_the_same(spark):
    rows = [("a", float(x), 1 + i % 3) for i, x in enumerate([5, -3, 0, 900, 901, 902, 1e6, 5, 5])]
    rows += [("b", 0.1, 1), ("b", 0.2, 1), (None, 7.0, 2), (None, 8.0, 2), ("nulls", None, 1)]
    df = spark.createDataFrame(rows, "g string, x double, n long")
    for copies in (None, "n"):
        want = sorted(map(str, A.median_by(df, ["g"], "x", copies=copies).collect()))
        few = A.median_by(df, ["g"], "x", copies=copies, few_groups=True)
        assert sorted(map(str, few.collect())) == want and len(want) == 3


def test_corr_safe(spark):
    rows = [("zero_var", 1.0, 1.0), ("zero_var", 1.0, 2.0), ("one", 1.0, 2.0),
            ("pos", 1.0, 2.0), ("pos", 2.0, 4.0), ("pos", 3.0, 6.0), ("pos", None, 9.0)]
    df = spark.createDataFrame(rows, "g string, x double, y double")
    got = {r.g: r.c for r in df.groupBy("g").agg(A.corr_safe("x", "y").alias("c")).collect()}
    assert got["zero_var"] is None and got["one"] is None
    assert got["pos"] == pytest.approx(1.0)


def test_string_agg_distinct_sorted(spark):
    df = spark.createDataFrame([("a", "b"), ("a", "a"), ("a", "b"), ("n", None)], "g string, x string")
    got = {r.g: r.s for r in df.groupBy("g").agg(A.string_agg_distinct("x").alias("s")).collect()}
    assert got == {"a": "a, b", "n": None}


def test_pct_change_zero_previous(spark):
    df = spark.createDataFrame([(5, 0), (6, 4), (3, None)], "c long, p long")
    got = [r.x for r in df.select(pct_change("c", "p").alias("x")).collect()]
    assert got == [None, 50.0, None]


def test_top_bottom_ties_and_top_wins(spark):
    df = spark.createDataFrame(
        [("a", 10.0), ("b", 9.0), ("c", 9.0), ("d", 8.0), ("e", 1.0)], "k string, v double"
    )
    got = {r.k: r.performance_group for r in top_bottom_n(df, "v", 3).collect()}
    # dense ranks: top a=1, b=c=2, d=3; bottom e=1, d=2, b=c=3 -> top wins
    assert got == {"a": "Top 3", "b": "Top 3", "c": "Top 3", "d": "Top 3", "e": "Bottom 3"}


def test_full_outer_small_right_equals_full_outer(spark):
    big = spark.createDataFrame([("x", 1), ("x", 2), ("y", 3), (None, 4)], "k string, id int")
    small = spark.createDataFrame([("x", "X"), ("z", "Z")], "s string, name string")
    got = sorted(map(tuple, full_outer_small_right(big, small, "k", "s").collect()), key=str)
    want = sorted(map(tuple, big.join(small, big.k == small.s, "full_outer").collect()), key=str)
    assert got == want


def test_upsert_replaces_and_dedupes(spark):
    target = spark.createDataFrame([(1, "old", 0), (2, "keep", 0)], "k int, v string, s int")
    # same key twice in the batch (latest scrape wins), key in batch and
    # target (batch wins), new key (added)
    batch = spark.createDataFrame([(1, "new_a", 1), (1, "new_b", 2), (3, "add", 1)], "k int, v string, s int")
    out = upsert(target, batch, ["k"], [F.col("s").desc()])
    got = sorted((r.k, r.v) for r in out.collect())
    assert got == [(1, "new_b"), (2, "keep"), (3, "add")]


def test_upsert_idempotent(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    batch = spark.createDataFrame([(2, "c")], "k int, v string")
    once = upsert(target, batch, ["k"], [F.col("v").asc()])
    twice = upsert(once, batch, ["k"], [F.col("v").asc()])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


@pytest.mark.parametrize("bucket", [None, "year", "quarter", "month"])
def test_temporal_join_boundaries(spark, bucket):
    hist = spark.createDataFrame(
        [(1, D(2020, 1, 1), D(2020, 6, 1), False), (1, D(2020, 6, 1), None, True)],
        "host_id int, valid_from date, valid_to date, host_is_superhost boolean",
    )
    fact = spark.createDataFrame(
        [(1, D(2019, 12, 31)), (1, D(2020, 6, 1)), (1, D(2021, 1, 1)), (1, D(2030, 1, 1))],
        "host_id int, d date",
    )

    def run(closed):
        out = temporal_left_join(
            fact, hist, "host_id", "host_id", "d", ["host_is_superhost"], D(2025, 1, 1), closed, bucket
        )
        return sorted((r.d, r.host_is_superhost) for r in out.collect())

    half_open = run(False)
    assert half_open == [(D(2019, 12, 31), None), (D(2020, 6, 1), True), (D(2021, 1, 1), True), (D(2030, 1, 1), None)]
    closed = run(True)  # the boundary date matches both versions
    assert closed.count((D(2020, 6, 1), False)) == 1 and closed.count((D(2020, 6, 1), True)) == 1


# --- SCD2: the incremental merge against a brute-force model ----------------


def _brute_merge(history, batch):
    """Pure-Python model of the timestamp strategy on dict rows."""
    versions: dict = {}
    for r in batch:
        at = versions.setdefault(r["k"], {})
        at[r["u"]] = min(at.get(r["u"], "~"), r["a"])
    out = [dict(h) for h in history if h["valid_to"] is not None]
    open_ = {h["k"]: dict(h) for h in history if h["valid_to"] is None}
    for k, at in versions.items():
        dated = sorted(u for u in at if u is not None)
        for u in dated or [None]:
            cur = open_.get(k)
            if cur is not None:
                # not later, or no date to compare with: the open version stays
                if u is None or cur["valid_from"] is None or u <= cur["valid_from"]:
                    continue
                out.append({**cur, "valid_to": u})
            open_[k] = {"k": k, "a": at[u], "u": u, "valid_from": u, "valid_to": None}
    return out + list(open_.values())


def _rows(df):
    return sorted(
        (r.k, r.a, r.u, r.valid_from, r.valid_to) for r in df.select("k", "a", "u", "valid_from", "valid_to").collect()
    )


def test_scd2_merge_matches_brute_force(spark):
    rnd = random.Random(7)
    schema = "k int, a string, u date"
    history_py: list[dict] = []
    history_df = None
    for _ in range(4):
        batch = []
        for _ in range(rnd.randint(3, 8)):
            day = rnd.choice([None, *range(1, 20)])
            batch.append({"k": rnd.randint(1, 4), "a": rnd.choice(["x", "y"]),
                          "u": None if day is None else D(2020, 1, day)})
        bdf = spark.createDataFrame([Row(**b) for b in batch], schema)
        history_df = scd2_merge(history_df, bdf, ["k"], "u", ["a"])
        history_df = spark.createDataFrame(history_df.collect(), history_df.schema)  # cut lineage
        history_py = _brute_merge(history_py, batch)
        want = sorted((h["k"], h["a"], h["u"], h["valid_from"], h["valid_to"]) for h in history_py)
        assert _rows(history_df) == want
    assert quality.open_version_violations(history_df, ["k"]).count() == 0
    assert quality.interval_overlaps(history_df.where(F.col("valid_from").isNotNull()), ["k"]).count() == 0


def test_scd2_merge_does_not_depend_on_batch_size(spark):
    """Updates that arrive in order give the rebuilt history, however they are
    dealt to batches."""
    rows = [Row(k=k, a=f"{k}{d % 3}", u=D(2020, 1, d)) for d in range(1, 13) for k in range(1, 4) if (d * k) % 5]
    schema = "k int, a string, u date"
    want = _rows(scd2_rebuild(spark.createDataFrame(rows, schema), ["k"], "u", ["a"]))
    for size in (4, 9, len(rows)):
        history = None
        for i in range(0, len(rows), size):
            history = scd2_merge(history, spark.createDataFrame(rows[i : i + size], schema), ["k"], "u", ["a"])
            history = spark.createDataFrame(history.collect(), history.schema)
        assert _rows(history) == want


def test_scd2_rebuild_versions_chain(spark):
    rows = spark.createDataFrame(
        [(1, "x", D(2020, 1, 1)), (1, "y", D(2020, 3, 1)), (1, "x", D(2020, 1, 1)), (2, "z", None)],
        "k int, a string, u date",
    )
    got = _rows(scd2_rebuild(rows, ["k"], "u", ["a"]))
    assert got == [
        (1, "x", D(2020, 1, 1), D(2020, 1, 1), D(2020, 3, 1)),
        (1, "y", D(2020, 3, 1), D(2020, 3, 1), None),
        (2, "z", None, None, None),
    ]


def test_duplicate_and_null_keys(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (2, None), (None, 3)], "a int, b int")
    assert [tuple(r) for r in quality.duplicate_keys(df, ["a", "b"]).collect()] == [(1, 1, 2)]
    r = quality.null_key_counts(df, ["a", "b"]).first()
    assert (r.n_rows, r.null_a, r.null_b) == (4, 1, 1)


def test_upsert_partitions_on_disk(spark):
    """Rows in touched partitions are replaced/added; untouched partitions
    are neither read nor rewritten; the job reads the partitions it
    overwrites (dynamic partition overwrite)."""
    from staylens.operators.upsert import upsert_partitions
    from staylens.session import shared_path

    path = shared_path(spark, "t-upsert")
    schema = "k int, v string, s int, m int"
    first = spark.createDataFrame([(1, "a", 0, 1), (2, "b", 0, 1), (3, "c", 0, 2)], schema)
    upsert_partitions(spark, path, first, ["k"], [F.col("s").desc()], ["m"])
    batch = spark.createDataFrame([(1, "a2", 1, 1), (4, "d", 1, 1), (4, "d_old", 0, 1)], schema)
    upsert_partitions(spark, path, batch, ["k"], [F.col("s").desc()], ["m"])
    got = sorted((r.k, r.v, r.m) for r in spark.read.parquet(path).collect())
    assert got == [(1, "a2", 1), (2, "b", 1), (3, "c", 2), (4, "d", 1)]
    # applying the same batch again changes nothing
    upsert_partitions(spark, path, batch, ["k"], [F.col("s").desc()], ["m"])
    assert sorted((r.k, r.v, r.m) for r in spark.read.parquet(path).collect()) == got


# --- work that shuffles only what must meet ------------------------------------------
def _keyed(spark):
    import random

    rng = random.Random(3)
    rows = [(rng.choice([None, *range(30)]), rng.choice([None, 1, 2]), rng.choice(["x", "y", None])) for _ in range(60)]
    return spark.createDataFrame([*rows, *rows[:5]], "k long, d int, v string")


def test_a_written_batch_is_deduplicated_by_its_repeated_keys(spark, tmp_path):
    from pyspark.sql import functions as F

    from staylens.operators.upsert import dedupe_batch, dedupe_written

    rows, order = _keyed(spark), [F.col("v").desc_nulls_last()]
    want = sorted(map(str, dedupe_batch(rows, ["k", "d"], order).collect()))
    assert sorted(map(str, dedupe_written(rows, ["k", "d"], order, str(tmp_path / "keys")).collect())) == want
    assert len(want) > spark.read.parquet(str(tmp_path / "keys")).count() > 0


def test_a_splice_takes_the_rows_that_every_step_closed(spark):
    import datetime as dt

    from staylens.operators.scd2 import scd2_splice

    d = lambda n: dt.date(2020, 1, n)
    schema = "k long, a string, u date, valid_from date, valid_to date"
    open_ = spark.createDataFrame([(1, "c", d(9), d(9), None), (2, "z", d(1), d(1), None)], schema)
    # step 1 closed version "a" anew
    closed = spark.createDataFrame([(1, "a", d(1), d(1), d(9), 0), (1, "a", d(1), d(1), d(5), 1), (1, "b", d(5), d(5), d(9), 1)], f"{schema}, step int")
    batch = spark.createDataFrame([(1, "n", d(3)), (2, "z", d(1))], "k long, a string, u date")
    out = scd2_splice(open_, closed, batch, ["k"], "u", ["a"])
    got = sorted((r.k, r.a, r.valid_to.day if r.valid_to else None) for r in out.collect())
    assert got == [(1, "a", 3), (1, "c", None), (1, "n", 5), (2, "z", None)]
    # the history meets the batch in one shuffle on the key (the other: distinct)
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert plan.count("Exchange hashpartitioning") == 2


def test_a_gate_compares_only_rows_of_repeated_keys(spark, tmp_path):
    from pyspark.sql import functions as F

    from staylens.operators.gate import judged
    from staylens.operators.upsert import write_repeated_keys

    rows, key, order = _keyed(spark), ["k", "d"], [F.col("v").desc_nulls_last()]
    repeated = write_repeated_keys(rows.where("k is not null and d is not null"), key, str(tmp_path / "keys"))
    there = rows.where("k < 4").limit(3)
    for existing in (None, there):
        whole, split = (judged(rows, key, order, F.col("v") == "y", existing, r) for r in (None, repeated))
        assert sorted(map(str, split.collect())) == sorted(map(str, whole.select(*split.columns).collect()))
