"""CSV ingest edge cases (hand-made files) and the incremental run's
invariants on the smallest bound tables."""

from __future__ import annotations

import datetime as dt

import pytest

from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylens.operators import quality
from staylens.plans import monthly_run
from staylens.plans.model import RentalModel
from staylens.session import shared_path
from staylens.sources import schemas
from staylens.sources.csv_ingest import cast_to_schema, load_csv, load_monthly, null_tokens_to_null
from tests.conftest import SF_SMALL

SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("since", T.DateType()),
        T.StructField("n", T.IntegerType()),
    ]
)


def _write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_csv_by_name_blank_headers_and_quoting(spark, tmp_path):
    a = _write(
        tmp_path / "a" / "m1.csv",
        'ID,Name,Since,N,\n1,"Smith, Jo",05/09/2020,5.0,\n2,"say ""hi""",2020-01-02,NA,\n',
    )
    b = _write(
        tmp_path / "b" / "m2.csv",
        'Unnamed: 0,n,since,name,id\n0,7,1/2/2021,"two\nlines",3\n1,,31/02/2020,null,4\n',
    )
    strict = load_csv(spark, [a, b], SCHEMA.add("x", T.StringType()), strict=False)
    got = sorted(tuple(r) for r in strict.select("id", "name", "since", "n", "_rejected").collect())
    assert got == [
        (1, "Smith, Jo", dt.date(2020, 9, 5), 5, False),
        (2, 'say "hi"', dt.date(2020, 1, 2), None, False),
        (3, "two\nlines", dt.date(2021, 2, 1), 7, False),
        # an impossible day-first date stays text, so the typed cast rejects it
        (4, None, None, None, True),
    ]


def test_null_tokens_and_float_integers(spark):
    df = spark.createDataFrame([("5.0", "NA"), ("", "x"), ("N/A", "null"), ("12", "None")], "n string, s string")
    typed = cast_to_schema(null_tokens_to_null(df), T.StructType([T.StructField("n", T.IntegerType()),
                                                                     T.StructField("s", T.StringType())]))
    assert [tuple(r) for r in typed.collect()] == [(5, None), (None, "x"), (None, None), (12, None)]


def test_incremental_run_invariants(spark):
    from staylens.plans.registry import landing

    root = landing(spark, SF_SMALL, "drift", batch="year")
    state = monthly_run.RunState(shared_path(spark, "t-silver"), shared_path(spark, "t-history"))
    monthly_run.run_drops(spark, root, state, batch_col="year")
    silver = state.silver(spark)
    expected = RentalModel.from_tables(spark, SF_SMALL).listings
    assert silver.count() == expected.count()
    assert silver.exceptAll(expected.select(*silver.columns)).count() == 0
    assert quality.duplicate_keys(silver, list(schemas.LISTING_KEY)).count() == 0

    hist = state.history(spark)
    assert quality.open_version_violations(hist, ["host_id"]).count() == 0
    assert quality.interval_overlaps(hist.where(F.col("valid_from").isNotNull()), ["host_id"]).count() == 0
    # every host seen in silver has a history
    assert silver.select("host_id").distinct().join(hist, "host_id", "left_anti").where("host_id IS NOT NULL").count() == 0

    # re-applying the same drops changes nothing (idempotent upsert)
    before = silver.count()
    monthly_run.run_drops(spark, root, state, batch_col="year")
    assert state.silver(spark).count() == before


def test_pit_fact_has_one_row_per_listing_snapshot(spark):
    m = RentalModel.from_tables(spark, SF_SMALL)
    assert m.fact.count() == m.listings.count()
    assert quality.duplicate_keys(m.fact, ["listing_id", "scraped_date"]).count() == 0


def test_replayed_batch_is_a_no_op(spark):
    """A restarted stream replays its last micro-batch: applying the same
    batch (same step) twice must leave silver and host history unchanged."""
    from staylens.plans.registry import landing

    root = landing(spark, SF_SMALL, "drift", batch="year")
    state = monthly_run.RunState(shared_path(spark, "r-silver"), shared_path(spark, "r-history"))
    drops = monthly_run.batches(spark, root, "year")
    for step, (_, files) in enumerate(drops[:3]):
        rows = load_csv(spark, files, schemas.LISTINGS_RAW, base_path=root)
        monthly_run.apply_batch(spark, state, rows, step)
    before_s = sorted(map(tuple, state.silver(spark).collect()), key=str)
    before_h = sorted(map(tuple, state.history(spark).collect()), key=str)
    step, (_, files) = 2, drops[2]
    monthly_run.apply_batch(spark, state, load_csv(spark, files, schemas.LISTINGS_RAW, base_path=root), step)
    assert sorted(map(tuple, state.silver(spark).collect()), key=str) == before_s
    assert sorted(map(tuple, state.history(spark).collect()), key=str) == before_h


def test_a_file_outside_the_batch_folders_is_an_error(spark, tmp_path):
    (tmp_path / "month=2020-05").mkdir()
    (tmp_path / "month=2020-05" / "a.csv").write_text("listing_id\n1\n")
    assert [k for k, _ in monthly_run.batches(spark, str(tmp_path), "month")] == ["2020-05"]
    (tmp_path / "extra.CSV").write_text("listing_id\n2\n")
    with pytest.raises(ValueError, match="extra"):
        monthly_run.batches(spark, str(tmp_path), "month")


def test_files_named_by_month_are_batches_in_date_order(spark, tmp_path):
    (tmp_path / "01_2021.csv").write_text("id,name\n3,c\n")
    (tmp_path / "05_2020.csv").write_text("id,name\n1,a\n")
    (tmp_path / "12_2020.CSV").write_text("name,id\nb,2\n")
    assert [k for k, _ in monthly_run.batches(spark, str(tmp_path), "month")] == ["2020-05", "2020-12", "2021-01"]
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
    rows = load_monthly(spark, str(tmp_path), schema).collect()
    assert sorted(map(tuple, rows)) == [(1, "a", "2020-05"), (2, "b", "2020-12"), (3, "c", "2021-01")]
    with pytest.raises(ValueError):
        monthly_run.batches(spark, str(tmp_path), "year")
    (tmp_path / "other.csv").write_text("id,name\n9,z\n")
    with pytest.raises(ValueError, match="other"):
        load_monthly(spark, str(tmp_path), schema)


def test_a_differing_header_in_a_folder_never_shifts_columns(spark, tmp_path):
    from pyspark.sql import types as T

    from staylens.sources.csv_ingest import list_csv_files, load_csv

    (tmp_path / "a.csv").write_text("listing_id,host_id\n1,2\n")
    (tmp_path / "b.csv").write_text("host_id,listing_id\n4,3\n")
    schema = T.StructType([T.StructField("LISTING_ID", T.LongType()), T.StructField("host_id", T.LongType())])
    files = list_csv_files(spark, str(tmp_path))
    with pytest.raises(Exception, match="(?i)header"):
        load_csv(spark, files, schema).collect()
    rows = load_csv(spark, files, schema, header_per_file=True).collect()
    assert sorted(tuple(r) for r in rows) == [(1, 2), (3, 4)]  # mixed-case schema names bind too


def test_a_strict_cast_never_loses_digits(spark):
    from pyspark.sql import types as T

    from staylens.sources.csv_ingest import cast_to_schema

    schema = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("m", T.DecimalType(12, 2))])
    df = spark.createDataFrame([("5.0", "4.50"), (None, None)], "n string, m string")
    assert [tuple(map(str, r)) for r in cast_to_schema(df, schema).collect()] == [("5", "4.50"), ("None", "None")]
    for bad in (("5.7", "1"), ("5", "4.857")):
        df = spark.createDataFrame([bad], "n string, m string")
        with pytest.raises(Exception, match="loses digits"):
            cast_to_schema(df, schema).collect()
        assert cast_to_schema(df, schema, strict=False).collect()[0]["_rejected"]


def test_a_failed_read_of_the_target_stops_the_upsert(spark, tmp_path):
    from staylens.operators.upsert import upsert_partitions

    target = tmp_path / "t"
    batch = spark.createDataFrame([(1, "a", 2020)], "k long, v string, year int")
    upsert_partitions(spark, str(target), batch, ["k"], [F.col("v")], ["year"])
    part = next((target / "year=2020").glob("*.parquet"))
    part.write_bytes(b"broken")
    for crc in (target / "year=2020").glob(".*.crc"):
        crc.write_bytes(b"")
    with pytest.raises(Exception):
        upsert_partitions(spark, str(target), spark.createDataFrame([(2, "b", 2020)], "k long, v string, year int"), ["k"], [F.col("v")], ["year"])
    assert part.read_bytes() == b"broken"


def test_a_second_run_extends_the_history(spark, tmp_path):
    state = monthly_run.RunState(str(tmp_path / "silver"), str(tmp_path / "history"))
    assert state.next_step(spark) == 0
    spark.range(1).write.parquet(state.step_path(4) + "/kind=open")
    assert state.next_step(spark) == 5


# --- headers, and one log of drops for batch and stream --------------------------
HOSTS = T.StructType([T.StructField("listing_id", T.LongType()), T.StructField("host_id", T.LongType())])


def test_a_reordered_file_beside_a_blank_header_stops_the_load(spark, tmp_path):
    folder = tmp_path / "month=2020-05"
    first = _write(folder / "a.csv", ",listing_id,host_id\n0,1,10\n")
    second = _write(folder / "b.csv", ",host_id,listing_id\n0,2,200\n")
    with pytest.raises(ValueError, match="b.csv"):
        load_csv(spark, [first, second], HOSTS)
    rows = load_csv(spark, [first, second], HOSTS, header_per_file=True).collect()
    assert sorted(map(tuple, rows)) == [(1, 10), (200, 2)]


def test_a_missing_column_stops_a_strict_load(spark, tmp_path):
    path = _write(tmp_path / "a.csv", "listing_id\n1\n")
    with pytest.raises(ValueError, match="host_id"):
        load_csv(spark, [path], HOSTS)
    assert load_csv(spark, [path], HOSTS, optional=["host_id"]).collect()[0].host_id is None
    with pytest.raises(ValueError, match="host_id"):
        cast_to_schema(spark.createDataFrame([("1",)], "listing_id string"), HOSTS)


def test_files_with_newlines_in_fields_are_found(spark, tmp_path):
    from staylens.sources.csv_ingest import files_spanning_lines

    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    plain = _write(tmp_path / "my plain.csv", 'a,b\n1,"say ""x"", y"\n2,z\n')
    broken = _write(tmp_path / "over lines.csv", 'a,b\n3,"two\nlines"\n')
    from staylens.sources.csv_ingest import list_csv_files

    files = list_csv_files(spark, str(tmp_path))
    assert [f.rsplit("/", 1)[1] for f in files_spanning_lines(spark, files)] == ["over lines.csv"]
    want = [(1, 'say "x", y'), (2, "z"), (3, "two\nlines")]
    assert sorted(map(tuple, load_csv(spark, files, schema).collect())) == want
    assert sorted(map(tuple, load_csv(spark, [plain, broken], schema).collect())) == want


def _drop(root, month, rows, reverse=False, file="a"):
    names = [f.name for f in schemas.LISTINGS_RAW.fields]
    names = names[::-1] if reverse else names
    lines = [",".join(names)]
    for listing, host, since in rows:
        known = {"listing_id": str(listing), "host_id": str(host), "host_name": f"h{host}", "host_since": since, "scraped_date": f"{month}-15", "price": "5"}
        lines.append(",".join(known.get(n, "") for n in names))
    _write(root / f"month={month}" / f"{file}.csv", "\n".join(lines) + "\n")


def test_batch_and_stream_share_one_log(spark, tmp_path):
    from staylens.streaming.drops import stream_drops

    root = tmp_path / "landing"
    state = monthly_run.RunState(str(tmp_path / "silver"), str(tmp_path / "history"))
    _drop(root, "2020-05", [(1, 10, "2020-01-01")])
    _drop(root, "2020-06", [(2, 11, "2020-02-01")])
    monthly_run.run_drops(spark, str(root), state)
    _drop(root, "2020-07", [(3, 12, "2020-03-01")], reverse=True)  # another header, bound by name
    stream_drops(spark, str(root), state, str(tmp_path / "ckpt"))
    listings = lambda: sorted((r.listing_id, r.host_id) for r in state.silver(spark).collect())
    hosts = lambda: sorted((r.host_id, str(r.valid_from), str(r.valid_to)) for r in state.history(spark).collect())
    assert listings() == [(1, 10), (2, 11), (3, 12)]
    assert [h[0] for h in hosts()] == [10, 11, 12]
    log = state.ledger(spark).entries()
    assert [(e.step, e.source, e.drop) for e in log] == [(0, "batch", "2020-05"), (1, "batch", "2020-06"), (2, "stream", "2020-07")]
    # a stream with a new checkpoint and a batch run find nothing to do
    before = (listings(), hosts())
    stream_drops(spark, str(root), state, str(tmp_path / "ckpt2"))
    monthly_run.run_drops(spark, str(root), state)
    assert (listings(), hosts(), len(state.ledger(spark).entries())) == (*before, 3)
    # another part of a drop that was applied: the drop is read again whole
    _drop(root, "2020-06", [(4, 11, "2020-06-01")], file="b")
    stream_drops(spark, str(root), state, str(tmp_path / "ckpt2"))
    assert listings() == [(1, 10), (2, 11), (3, 12), (4, 11)]
    assert hosts()[1:3] == [(11, "2020-02-01", "2020-06-01"), (11, "2020-06-01", "None")]
    # a step that was cut off before its entry in the log is not part of the state
    spark.read.parquet(state.step_path(3)).write.parquet(state.step_path(4))
    assert state.next_step(spark) == 4 and len(hosts()) == 4
    with pytest.raises(Exception, match="(?i)exist"):
        state.ledger(spark).commit(log[0])


@pytest.mark.parametrize("seed", [0, 1])
def test_any_order_of_drops_gives_the_rebuilt_history(spark, seed):
    import random

    from staylens.operators.scd2 import scd2_rebuild, scd2_splice

    schema = "k long, a string, b string, u date"
    rng = random.Random(seed)
    day = lambda: rng.choice([None, *(dt.date(2020, 1, d) for d in range(1, 9))])
    rows = [(rng.choice([None, 1, 2, 3, 4, 5]), rng.choice(["x", "y", None]), "c", day()) for _ in range(60)]
    rows = [r for r in rows if r[3] is not None or r[0] in (4, 5)]
    cols = ["k", "a", "b", "u", "valid_from", "valid_to"]
    want = sorted(map(str, scd2_rebuild(spark.createDataFrame(rows, schema), ["k"], "u", ["a", "b"]).select(*cols).collect()))
    held: dict = {}
    for i in range(0, len(rows), 12):
        old = [r for r in held.values()]
        frame = lambda open_: spark.createDataFrame([r for r in old if (r[5] is None) == open_], f"{schema}, valid_from date, valid_to date")
        current = (frame(True), frame(False)) if old else (None, None)
        out = scd2_splice(*current, spark.createDataFrame(rows[i : i + 12], schema), ["k"], "u", ["a", "b"]).select(*cols).collect()
        held = {k: r for k, r in held.items() if r[5] is not None}  # open rows are given anew
        held |= {tuple(r)[:5]: tuple(r) for r in out}
    assert sorted(str(spark.createDataFrame([r], f"{schema}, valid_from date, valid_to date").collect()[0]) for r in held.values()) == want


# --- the acting key constraint ------------------------------------------------------
def test_a_gate_quarantines_or_stops(spark, tmp_path):
    from staylens.operators.gate import RejectedRows, write_gated
    from staylens.plans.full_run import load_with_rejects

    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("day", T.DateType()), T.StructField("n", T.IntegerType())])
    first = _write(tmp_path / "a.csv", "id,day,n\n1,2020-01-01,5\n1,2020-01-01,7\n2,,1\n3,2020-01-03,many\n4,2020-01-04,1\n")
    second = _write(tmp_path / "b.csv", "id,day,n\n1,2020-01-01,6\n4,2020-01-05,2\n4,2020-01-04,1\n")
    order = [F.col("n").desc()]
    gate = load_with_rejects(spark, [first, second], schema, ["id", "day"], order, str(tmp_path / "out"))
    assert gate.counts == {"rows": 8, "accepted": 3, "unreadable": 1, "null key": 1, "key exists": 0, "duplicate key": 3}
    assert sorted((r.id, r.n) for r in gate.accepted(spark).collect()) == [(1, 7), (4, 1), (4, 2)]
    rejected = {(r.id, r.n, r._reason, r._raw) for r in gate.rejected(spark).collect()}
    raw = '{"id":"3","day":"2020-01-03","n":"many"}'
    assert rejected == {(1, 5, "duplicate key", None), (1, 6, "duplicate key", None), (4, 1, "duplicate key", None), (2, 1, "null key", None), (3, None, "unreadable", raw)}
    with pytest.raises(RejectedRows, match="1 unreadable, 1 null key, 3 duplicate key"):
        load_with_rejects(spark, [first, second], schema, ["id", "day"], order, str(tmp_path / "stopped"), stop=True)
    assert not (tmp_path / "stopped").exists() and not list(tmp_path.glob("_stopped*"))
    # against the rows that a table holds already
    again = load_with_rejects(spark, [second], schema, ["id", "day"], order, str(tmp_path / "again"), existing=gate.accepted(spark))
    assert again.counts["key exists"] == 3 and again.counts["accepted"] == 0
    # a hot key: one row wins, whichever tasks hold the others
    hot = spark.range(20_000, numPartitions=8).selectExpr("if(id % 3 = 0, 1, id) as k", "id as v")
    counts = write_gated(hot, str(tmp_path / "hot"), ["k"], [F.col("v").desc()]).counts
    n = hot.select("k").distinct().count()
    assert counts["accepted"] == n and counts["duplicate key"] == 20_000 - n


# --- drops at size ------------------------------------------------------------------
def test_drops_are_compressed_and_their_rows_are_not_shuffled(spark, tmp_path):
    from staylens.sources import landing

    fields = [f"cast(null as {f.dataType.simpleString()}) as {f.name}" for f in schemas.LISTINGS_RAW.fields[3:]]
    rows = spark.range(40, numPartitions=4).selectExpr("id as listing_id", "id as scrape_id", "date_add(date'2020-01-20', cast(id % 3 as int) * 12) as scraped_date", *fields)
    rows = rows.select(*[F.col(f.name).cast(f.dataType) for f in schemas.LISTINGS_RAW.fields]).withColumn("host_name", F.lit("A, B"))
    root, drifted = tmp_path / "drops", landing.CsvStyle(reverse_columns=True, index_column=True, null_value="NA", dmy_dates=True)
    landing.write_drops(rows, str(root), drift_from="2020-02", drift_style=drifted)
    parts = [p for p in root.glob("month=*/*") if not p.name.startswith((".", "_"))]
    # every task wrote its own rows of both months
    assert len(parts) == 8 and all(p.name.endswith(".csv.gz") for p in parts)
    want = sorted((r.listing_id, str(r.scraped_date)[:7]) for r in rows.collect())
    got = load_monthly(spark, str(root), schemas.LISTINGS_RAW)
    assert sorted((r.listing_id, r.month) for r in got.collect()) == want and {r.host_name for r in got.collect()} == {"A, B"}
    landing.write_named_months(rows, str(tmp_path / "named"))
    assert sorted(p.name for p in (tmp_path / "named").glob("[!.]*")) == ["01_2020.csv.gz", "02_2020.csv.gz"]
    named = load_monthly(spark, str(tmp_path / "named"), schemas.LISTINGS_RAW)
    assert sorted((r.listing_id, r.month) for r in named.collect()) == want


def test_a_csv_file_holds_a_bounded_number_of_rows(spark, tmp_path):
    from staylens.sources.csv_ingest import list_csv_files, write_csv

    write_csv(spark.range(10, numPartitions=1).selectExpr("cast(id as string) as id"), str(tmp_path / "t"), rows_per_file=4)
    files = list_csv_files(spark, str(tmp_path / "t"))
    schema = T.StructType([T.StructField("id", T.LongType())])
    assert len(files) == 3 and sorted(r.id for r in load_csv(spark, files, schema).collect()) == list(range(10))
