"""Physical-plan properties the design relies on at scale."""

from __future__ import annotations

import contextlib
import io
import re

from staylens.plans.model import RentalModel
from staylens.plans.registry import warehouse
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_silver_dedup_is_skew_safe(spark):
    df = RentalModel.from_tables(spark, SF_SMALL).listings
    lines = [ln.strip() for ln in _plan(df).splitlines()]
    exch = [i for i, ln in enumerate(lines) if "Exchange hashpartitioning(listing_id" in ln]
    # the de-dup shuffles on its full key ...
    assert len(exch) == 1 and "scraped_date" in lines[exch[0]]
    # ... after a map-side partial limit (plan text lists parents first)
    assert any("WindowGroupLimit" in ln for ln in lines[exch[0] + 1:])
    # the narrow-scan spread hashes on the rows' unique identity only
    assert not any("RoundRobinPartitioning" in ln for ln in lines)
    assert all("l_linenumber" in ln for ln in lines if "Exchange hashpartitioning(l_orderkey" in ln)


def test_marts_have_no_expand(spark):
    w = warehouse(spark, SF_SMALL)
    for df in (w.mart_listing_neighbourhood(), w.mart_property_type()):
        assert "Expand" not in _plan(df)
        # the superhost flag is in the fact: no scan of the host history
        assert "host_snapshot" not in _formatted(df)


def test_fact_scan_is_column_pruned(spark):
    w = warehouse(spark, SF_SMALL)
    text = _formatted(w.question_d())
    schema_lines = [ln for ln in text.splitlines() if ln.startswith("ReadSchema")]
    assert schema_lines
    # question d reads 5 of the fact's 17 columns
    assert all("review_scores_rating" not in ln and "price" not in ln for ln in schema_lines)


def test_recent_window_is_a_scalar_subquery_not_a_join(spark):
    w = warehouse(spark, SF_SMALL)
    plan = _plan(w.question_a())
    assert "Subquery" in plan or "subquery" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_no_python_udfs_in_headline_plans(spark):
    w = warehouse(spark, SF_SMALL)
    for df in (w.mart_listing_neighbourhood(), w.question_a(), w.question_c(), w.fact):
        plan = _plan(df)
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


def test_no_cross_joins_or_python_in_any_registered_query(spark):
    import __spark_entry__ as entry

    bad = {}
    for name, q in ((k, f) for k, f in entry.queries().items() if k not in entry.LLM_QUERIES):
        plan = _plan(q(spark, SF_SMALL))
        hits = [f for f in FORBIDDEN if f in plan]
        if hits:
            bad[name] = hits
    assert bad == {}


def test_partitioned_fact_prunes_months(spark):
    """A month predicate on the (year, month)-partitioned fact reaches
    the scan as a partition filter and reads one folder."""
    from pyspark.sql import functions as F

    from staylens.session import shared_path
    from staylens.sources.sinks import write_fact_partitioned

    laid = write_fact_partitioned(warehouse(spark, SF_SMALL).fact, shared_path(spark, "t-fact"))
    one = laid.where((F.col("year") == 2000) & (F.col("month") == 6))
    text = _formatted(one)
    assert "PartitionFilters: [isnotnull(year" in text and "(year#" in text and "(month#" in text
    fact = warehouse(spark, SF_SMALL).fact
    want = fact.where((F.year("scraped_date") == 2000) & (F.month("scraped_date") == 6)).count()
    assert one.count() == want > 0


def test_recent_questions_prune_fact_folders(spark):
    """The last-12-months filter reaches the fact scan as a partition filter."""
    from staylens.plans.adhoc import last_months

    fact = warehouse(spark, SF_SMALL).fact
    for df in (warehouse(spark, SF_SMALL).question_a(), fact.where(last_months(fact))):
        scans = re.findall(r"/fact\], PartitionFilters: \[(.).*?, PushedFilters: .*?ReadSchema: struct<(.)", _plan(df))
        # a scan of no column reads the partition values only (the latest month)
        first = [filters for filters, columns in scans if columns != ">"]
        assert first and "]" not in first
    flat = fact.drop("year", "month")
    assert fact.where(last_months(fact)).count() == flat.where(last_months(flat)).count() > 0


def test_distinct_counts_and_medians_spread_hot_groups(spark):
    """No Expand for two distinct counts; no window over a group's prices."""
    from staylens.plans.registry import QUERIES

    assert "Expand" not in _plan(QUERIES["agg_multi_distinct"](spark, SF_SMALL))
    windows = [ln for ln in _plan(QUERIES["agg_median"](spark, SF_SMALL)).splitlines() if "Window [" in ln]
    assert windows and all("price" not in ln for ln in windows)


def test_views_last_and_names_are_quoted(spark, tmp_path):
    from staylens.sources import sinks

    base = str(tmp_path / "ca talog's")
    spark.range(3).write.partitionBy().parquet(str(tmp_path / "plain"))
    spark.range(4).selectExpr("id", "id % 2 as part").write.partitionBy("part").parquet(str(tmp_path / "parted"))
    assert sinks.register_table(spark, "order", "select", str(tmp_path / "parted"), base).where("part = 1").count() == 2
    view = sinks.publish_view(spark, None, "view", f"SELECT max(id) AS m FROM {sinks.qualified_name('order', 'select')}", base)
    assert view.collect()[0].m == 3
    # another session of the catalog answers, and sees what the table sees now
    assert spark.newSession().table("`public`.`view`").collect()[0].m == 3
    sinks.register_table(spark, "order", "select", str(tmp_path / "plain"), base)
    assert spark.table("`public`.`view`").collect()[0].m == 2
    assert sinks.write_table(spark.range(5), None, "t", base).count() == 5
    for name in ("`public`.`t`", "`order`.`select`"):
        spark.sql(f"DROP TABLE {name}")
    spark.sql("DROP VIEW `public`.`view`")


def test_question_c_counts_every_row_of_a_suburb(spark):
    """A suburb listed under two LGAs: as-is its stays count twice."""
    from staylens.plans import adhoc

    fact = spark.createDataFrame([(1, "2020-01-01", "k", "p1", 5, 10)], "listing_id long, scraped_date string, suburb_key string, property_key string, availability_30 int, price int")
    fact = fact.selectExpr("*", "cast(scraped_date as date) d").drop("scraped_date").withColumnRenamed("d", "scraped_date")
    fact = fact.selectExpr("listing_id", "scraped_date", "suburb_key", "property_key", "availability_30", "cast(price as decimal(12,2)) price", "'House' property_type", "'Room' room_type", "2 accommodates")
    suburb = spark.createDataFrame([("k", "here", "1"), ("k", "here", "2")], "suburb_key string, suburb_name string, lga_code string")
    prop = spark.createDataFrame([("p1", "House", "Room", 2)], "property_key string, property_type string, room_type string, accommodates int")
    asis = fact.drop("property_type", "room_type", "accommodates")
    assert adhoc.question_c(asis, suburb, prop=prop).collect()[0].total_stays == 50
    assert adhoc.question_c(fact, suburb).collect()[0].total_stays == 25


def test_asis_marts_write_no_copies(spark):
    """The as-is fact keeps each listing row once per suburb row."""
    w = warehouse(spark, SF_SMALL).materialize_asis()
    assert w.fact_copies.count() <= w.listings.count() * w.dm_suburb.groupBy("suburb_key").count().agg({"count": "max"}).collect()[0][0]
    assert w.fact_copies.agg({"copies": "sum"}).collect()[0][0] == w.fact_asis.count() > w.fact_copies.count()


def test_lookups_by_any_key_skip_most_row_groups(spark, tmp_path):
    """The clustered fact's footers rule out three quarters of a month's row
    groups for a lookup by each key."""
    import pyarrow.parquet as pq

    from staylens.sources.sinks import LOOKUP_KEYS, write_fact_clustered

    rows = spark.range(120_000).selectExpr(
        "id as listing_id", "date'2020-05-01' as scraped_date", "md5(cast(id % 3001 as string)) as host_key",
        "md5(concat('s', id * 7 % 211)) as suburb_key", "md5(concat('p', id * 13 % 20011)) as property_key", "1 as availability_30",
    )
    laid = write_fact_clustered(rows, str(tmp_path / "f"), row_group_bytes=8_192)
    assert laid.count() == 120_000
    files = [pq.ParquetFile(f).metadata for f in (tmp_path / "f").rglob("*.parquet")]
    groups = [m.row_group(g) for m in files for g in range(m.num_row_groups)]
    assert len(groups) >= 64
    one = laid.where("listing_id = 31337").collect()[0]
    for key in LOOKUP_KEYS:
        at = files[0].schema.names.index(key)
        stats = [g.column(at).statistics for g in groups]
        may_hold = sum(s.min <= one[key] <= s.max for s in stats)
        assert 0 < may_hold < 0.25 * len(groups), (key, may_hold, len(groups))


def test_a_refresh_reads_its_months_alone(spark):
    from pyspark.sql import functions as F

    from staylens.plans import mart_refresh
    from staylens.session import shared_path

    w = warehouse(spark, SF_SMALL)
    months = sorted((r.year, r.month) for r in w.fact.select("year", "month").distinct().collect())
    plan = _plan(mart_refresh.month_measures(w.fact, "property_type", months[:2]))
    scans = re.findall(r"/fact\], PartitionFilters: \[(.*?)\], PushedFilters", plan)
    assert scans and all("year" in s and "month" in s for s in scans)
    path = shared_path(spark, "t-measures")
    for part in (months[:30], months[30:], months[10:12]):
        mart_refresh.refresh(w.fact, "property_type", part, path)
    kept, full = mart_refresh.read_mart(spark, "property_type", path), w.mart_property_type()
    rows = lambda df: sorted(map(str, df.select(*full.columns).collect()))
    assert rows(kept) == rows(full)
    # a changed host version touches its host's months from its date on
    row = w.listings.where("host_id is not null").orderBy("scraped_date", "listing_id").select("host_id", "scraped_date").first()
    changed = spark.createDataFrame([(row.host_id, row.scraped_date)], "host_id long, valid_from date")
    want = {(r.d.year, r.d.month) for r in w.listings.where(F.col("host_id") == row.host_id).select(F.col("scraped_date").alias("d")).collect()}
    assert set(mart_refresh.months_of_hosts(w.listings, changed)) == want


def test_lines_are_shuffled_once_without_broadcasts(spark):
    """Joining and de-duplicating the listings
    takes one shuffle of the lines, and the fact's shuffles carry no md5 key."""
    small = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.files.maxPartitionBytes": "4096", "spark.sql.files.openCostInBytes": "64"}
    before = {k: spark.conf.get(k) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        m = RentalModel.from_tables(spark, SF_SMALL)
        shuffles = [ln for ln in _plan(m.listings).splitlines() if "Exchange hashpartitioning(" in ln]
        assert not [ln for ln in shuffles if "listing_id" in ln]
        assert sum("(o_custkey" in ln for ln in shuffles) == 1
        assert not re.search(r"md5\(cast\((listing|host)_id", _plan(m.fact_ids))
        assert m.fact.columns == warehouse(spark, SF_SMALL).fact.drop("year", "month").columns
        same = ["listing_id", "scraped_date", "suburb_key", "lga_key", "host_key", "property_key", "host_is_superhost"]
        rows = lambda df: sorted(map(str, df.select(*same).collect()))
        assert rows(m.fact) == rows(warehouse(spark, SF_SMALL).fact)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_marts_shuffle_no_measures_by_host(spark):
    """per host only its flag, and of the prices those of middle ranges."""
    text = _formatted(warehouse(spark, SF_SMALL).mart_property_type())
    per_host = [ln for ln in text.splitlines() if ln.startswith("Keys [6]")]
    assert per_host and not [ln for ln in text.splitlines() if ln.startswith("Keys [6]") and "price" in ln and "__range" not in ln]
    assert "max_p#" not in text and "sum_p#" not in text


def test_asis_marts_join_once(spark):
    """the as-is listing marts read one written table, joined once."""
    w = warehouse(spark, SF_SMALL).materialize_asis()
    for df in (w.mart_listing_neighbourhood_asis(), w.mart_property_type_asis()):
        text = _formatted(df)
        assert "asis_offers" in text and "dm_property" not in text and "host_snapshot" not in text


def test_asis_offers_keep_unknown_hosts_and_listings(spark):
    """A row without host or property row counts once, and its host not at all."""
    import datetime as dt

    from staylens.plans import marts

    day = dt.date(2020, 5, 1)
    fact = spark.createDataFrame(
        [(1, 7, day, 10, 5, "hk", "l", "pk", 2), (2, 8, day, 20, 6, None, "l", None, 1), (3, None, day, 30, 7, None, None, "p3", 1)],
        "listing_id long, host_id long, scraped_date date, p int, availability_30 int, host_key string, lga_key string, property_key string, copies long",
    ).selectExpr("*", "cast(p as decimal(12,2)) as price")
    host = spark.createDataFrame([(7, True, dt.date(2020, 1, 1), day), (7, False, day, None)], "host_id long, host_is_superhost boolean, valid_from date, valid_to date")
    prop = spark.createDataFrame(
        [(1, "pk", "House", "Room", 2, 4), (1, "pk", "House", "Room", 2, 6), (1, "pk", "Flat", "Room", 2, None)],
        "listing_id long, property_key string, property_type string, room_type string, accommodates int, review_scores_rating int",
    )
    offers = marts.asis_offers(fact, host, prop, dt.date(2021, 1, 1))
    got = sorted((r.price, r.property_type or "", r.copies, r.review_sum, r.n_reviews, r.host_id) for r in offers.collect())
    # a boundary date holds two versions; two House rows
    assert got == [(10, "Flat", 4, None, 0, 7), (10, "House", 8, 40, 8, 7), (20, "", 1, None, None, None), (30, "", 1, None, None, None)]
    mart = {r.listing_neighbourhood_lga: r for r in marts.mart_listing_neighbourhood_asis(offers).collect()}
    assert (mart["l"].distinct_hosts, mart["l"].superhost_rate, mart["l"].avg_review_score, mart["l"].median_price) == (1, 100.0, 5.0, 10.0)
    assert mart["Unknown"].distinct_hosts == 0


def test_asis_fact_is_joined_in_the_listings_buckets(spark):
    """no shuffle carries the listing rows to the counts of
    their property rows and host versions, nor the property dimension."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    w = warehouse(spark, SF_SMALL).materialize_asis()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = [x for x in _formatted(w.recompute("fact_copies")).split("\n\n") if re.match(r"\(\d+\) Exchange", x.strip())]
        rows = [re.search(r"hashpartitioning\((\w+)#", x).group(1) for x in shuffled if "price" in x]
        # by the host go the rows without a listing alone
        assert sorted(rows) == ["__nk", "host_id"]
        assert "Exchange" not in _plan(w.recompute("dm_property"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_fact_copies_of_odd_keys(spark):
    """Copies where a listing changes its host, or has none, and of rows
    without a listing."""
    import datetime as dt

    from staylens.plans import gold

    day = [dt.date(2020, m, 1) for m in range(1, 7)]
    rows = [(1, 7, day[0]), (1, 8, day[1]), (1, None, day[2]), (None, 7, day[3]), (None, None, day[4]), (2, 9, day[5])]
    listings = spark.createDataFrame(rows, "listing_id long, host_id long, scraped_date date").selectExpr(
        "*", "cast(5 as decimal(12,2)) as price", "1 as number_of_reviews", "2 as availability_30", "true as has_availability", "' Here ' as listing_neighbourhood"
    )
    suburb = spark.createDataFrame([("k", "here", "1"), ("k", "here", "2")], "suburb_key string, suburb_name string, lga_code string")
    lga = spark.createDataFrame([("l", "1", "one")], "lga_key string, lga_code string, lga_name string")
    prop = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "listing_id long, property_type string")
    host = spark.createDataFrame([(7,), (7,), (7,), (8,), (None,)], "host_id long")
    got = gold.fact_copies(listings, suburb, lga, prop, host).collect()
    assert len(got) == 2 * len(rows)
    found = {(r.listing_id, r.host_id): (r.copies, r.property_key is not None, r.host_key is not None) for r in got}
    assert found == {
        (1, 7): (6, True, True), (1, 8): (2, True, True), (1, None): (2, True, False),
        (None, 7): (3, False, True), (None, None): (1, False, False), (2, 9): (1, False, False),
    }


def test_question_c_asis_shuffles_no_property_rows(spark):
    """F16: the property dimension is counted and joined in its buckets."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    w = warehouse(spark, SF_SMALL).materialize_asis()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = [x for x in _formatted(w.question_asis("c")).split("\n\n") if re.match(r"\(\d+\) Exchange", x.strip())]
        assert shuffled and not [x for x in shuffled if "offers" in x or "hashpartitioning(property_key" in x]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_clustered_fact_makes_its_keys_of_the_shuffled_rows(spark, tmp_path):
    from staylens.plans import gold
    from staylens.plans.registry import warehouse
    from staylens.sources.sinks import write_fact_clustered

    ids = warehouse(spark, SF_SMALL).fact_ids
    plain = write_fact_clustered(gold.with_keys(ids), str(tmp_path / "plain"))
    laid = write_fact_clustered(ids, str(tmp_path / "ids"), gold.lookup_keys(), finish=gold.with_keys)
    assert laid.columns == plain.columns and laid.count() == plain.count() > 0
    assert laid.exceptAll(plain).count() == 0
    assert all(".zstd." in f for f in laid.inputFiles())
