"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator / model of the inventory (SURVEY §2), each over the whole bound
tables.  Outputs go through ``present`` (engine-neutral types)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from staylens.session import session_key

from staylens.checks.present import present
from staylens.plans.model import RentalModel

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return present(fn(spark, sf_dir))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn

    return deco


def model(spark: SparkSession, sf_dir: str) -> RentalModel:
    """The lazy model: every table computed from the bronze bindings."""
    return RentalModel.from_tables(spark, sf_dir)


_warehouses: dict[tuple, RentalModel] = {}


def warehouse(spark: SparkSession, sf_dir: str) -> RentalModel:
    """The model whose silver and gold tables are written under the shared
    checkpoint folder (as the source project materialises them), each the
    first time a query needs it, once per session; marts and questions are
    views over these tables."""
    from staylens.session import shared_path

    key = (session_key(spark), sf_dir)
    if key not in _warehouses:
        _warehouses[key] = RentalModel.from_tables(spark, sf_dir, base_path=shared_path(spark, "warehouse"))
    return _warehouses[key]


def layer(spark: SparkSession, sf_dir: str, attr: str) -> DataFrame:
    """Table ``attr`` computed fresh, reading its upstream layers as the
    written warehouse tables (a model reads its inputs as tables)."""
    return warehouse(spark, sf_dir).recompute(attr)


def _model_table(name: str, attr: str, doc: str):
    def fn(spark, sf_dir):
        return layer(spark, sf_dir, attr)

    fn.__doc__ = doc
    register(name)(fn)


# --- silver / gold tables (M1-M16) ------------------------------------------
for _name, _attr, _doc in [
    ("silver_listings", "listings", "M1 + S13: cleaned listings, one row per (listing, date)."),
    ("silver_host", "host_clean", "M2: distinct host attribute tuples."),
    ("silver_property", "property_clean", "M3: distinct property attribute tuples."),
    ("silver_lga_code", "lga_code_clean", "M4: cleaned LGA codes."),
    ("silver_lga_suburb", "lga_suburb_clean", "M5: neighbourhood-suburb bridge (full outer)."),
    ("silver_census_g01", "census_g01_clean", "M6: census age bands."),
    ("silver_census_g02", "census_g02_clean", "M7: census medians."),
    ("scd2_rebuild", "host_snapshot", "S14/M8: host SCD2 history rebuilt with lead()."),
    ("gold_dm_host", "dm_host", "M9: host dimension (versions)."),
    ("gold_dm_lga", "dm_lga", "M10: LGA dimension."),
    ("gold_dm_suburb", "dm_suburb", "M11: suburb dimension."),
    ("gold_dm_property", "dm_property", "M12: property dimension."),
    ("gold_census_g01", "dm_census_g01", "M13: census G01 dimension."),
    ("gold_census_g02", "dm_census_g02", "M14: census G02 dimension."),
    ("gold_dm_census", "dm_census", "M15 / F1 / J1: G01 left join G02."),
    ("gold_fact_asis", "fact_asis", "M16 verbatim (with the source's fan-out)."),
    ("gold_fact_pit", "fact", "M16 point-in-time: one row per listing snapshot."),
]:
    _model_table(_name, _attr, _doc)


# --- marts (M17-M19) and questions (M20-M24) --------------------------------
@register("mart_host_neighbourhood")
def _mart_host_neighbourhood(spark, sf_dir):
    """Hosts and revenue per listing LGA and month."""
    return warehouse(spark, sf_dir).mart_host_neighbourhood()


@register("mart_listing_neighbourhood")
def _mart_listing_neighbourhood(spark, sf_dir):
    """Monthly measures per listing LGA (half-open host versions)."""
    return warehouse(spark, sf_dir).mart_listing_neighbourhood()


@register("mart_property_type")
def _mart_property_type(spark, sf_dir):
    """Monthly measures per property type x room type x capacity."""
    return warehouse(spark, sf_dir).mart_property_type()


@register("mart_listing_neighbourhood_closed")
def _mart_listing_neighbourhood_closed(spark, sf_dir):
    """M18 with the source's closed BETWEEN on host versions (boundary dates
    match two versions)."""
    return warehouse(spark, sf_dir).mart_listing_neighbourhood(closed=True)


@register("mart_host_neighbourhood_asis")
def _mart_host_neighbourhood_asis(spark, sf_dir):
    """M17 verbatim on the as-is fact (fan-out and closed host join kept)."""
    return warehouse(spark, sf_dir).materialize_asis().mart_host_neighbourhood_asis()


@register("mart_listing_neighbourhood_asis")
def _mart_listing_neighbourhood_asis(spark, sf_dir):
    """M18 verbatim on the as-is fact (fan-out, closed host join, property join)."""
    return warehouse(spark, sf_dir).materialize_asis().mart_listing_neighbourhood_asis()


@register("mart_property_type_asis")
def _mart_property_type_asis(spark, sf_dir):
    """M19 verbatim on the as-is fact."""
    return warehouse(spark, sf_dir).materialize_asis().mart_property_type_asis()


def _question_asis(q: str):
    def fn(spark, sf_dir):
        return warehouse(spark, sf_dir).materialize_asis().question_asis(q)

    fn.__doc__ = f"Question {q} as the source runs it, on the as-is fact."
    return fn


for _q in "abcde":
    register(f"adhoc_{_q}_asis")(_question_asis(_q))


@register("adhoc_a")
def _adhoc_a(spark, sf_dir):
    """Top-3 / bottom-3 LGAs by host revenue and their demographics."""
    return warehouse(spark, sf_dir).question_a()


@register("adhoc_b")
def _adhoc_b(spark, sf_dir):
    """Correlation of median age and revenue per active listing."""
    return warehouse(spark, sf_dir).question_b()


@register("adhoc_c")
def _adhoc_c(spark, sf_dir):
    """Best property mix in each of the top-5 neighbourhoods."""
    return warehouse(spark, sf_dir).question_c()


@register("adhoc_d")
def _adhoc_d(spark, sf_dir):
    """Share of multi-listing hosts concentrated in one LGA."""
    return warehouse(spark, sf_dir).question_d()


@register("adhoc_e")
def _adhoc_e(spark, sf_dir):
    """LGA where single-listing hosts best cover the median mortgage."""
    return warehouse(spark, sf_dir).question_e()


# --- sources and sinks (S1-S16) ---------------------------------------------
# Each ingest query writes the bound bronze listings out as CSV drops in a
# given style (under the shared checkpoint folder) and reads them back
# through the ingest path; the result must equal the bronze rows.
from pyspark.sql import functions as F  # noqa: E402

from staylens.operators import quality  # noqa: E402
from staylens.operators.joins import scalar_of  # noqa: E402
from staylens.plans import full_run, gold, mart_refresh, marts, monthly_run, silver  # noqa: E402
from staylens.session import shared_path  # noqa: E402
from staylens.sources import bindings, schemas, sinks  # noqa: E402
from staylens.sources.csv_ingest import cast_to_schema, list_csv_files, load_csv, load_monthly, write_csv  # noqa: E402
from staylens.sources.landing import CsvStyle, write_drops, write_named_months  # noqa: E402
from staylens.streaming.drops import stream_drops  # noqa: E402

_DRIFT_FROM = "1999-01"  # drops from this month on use the drifted layout
_DRIFTED = CsvStyle(reverse_columns=True, index_column=True, null_value="NA", dmy_dates=True, float_ints=True)
_STYLES = {
    "plain": (CsvStyle(), None),
    "by_name": (CsvStyle(), CsvStyle(reverse_columns=True)),
    "blank_cols": (CsvStyle(), CsvStyle(index_column=True)),
    "null_tokens": (CsvStyle(null_value="NA"), CsvStyle(null_value="null")),
    "dmy_dates": (CsvStyle(), CsvStyle(dmy_dates=True)),
    "drift": (CsvStyle(), _DRIFTED),
}
_landings: dict[tuple, str] = {}


def landing(spark: SparkSession, sf_dir: str, style: str, batch: str = "month") -> str:
    """Write (once per session) the bronze listings as CSV drops."""
    key = (session_key(spark), sf_dir, style, batch)
    if key not in _landings:
        root = shared_path(spark, f"landing-{style}-{batch}")
        base, drift = _STYLES[style]
        fmt = "yyyy-MM" if batch == "month" else "yyyy"
        write_drops(
            bindings.listings_raw(spark, sf_dir), root, batch_col=batch, batch_format=fmt,
            style=base, drift_from=_DRIFT_FROM[: len(fmt)] if drift else None, drift_style=drift,
        )
        _landings[key] = root
    return _landings[key]


def _ingest(style: str, doc: str):
    def fn(spark, sf_dir):
        return load_monthly(spark, landing(spark, sf_dir, style), schemas.LISTINGS_RAW).drop("month")

    fn.__doc__ = doc
    return fn


for _name, _style, _doc in [
    ("csv_roundtrip", "plain", "S1: CSV drops read back into typed bronze."),
    ("csv_by_name", "by_name", "S2: drops with a reordered header bound by name."),
    ("drop_blank_cols", "blank_cols", "S3: 'Unnamed: 0' index columns dropped."),
    ("null_tokens", "null_tokens", "S4: 'NA' / 'null' cells read as NULL."),
    ("normalize_date", "dmy_dates", "S5: d/m/Y dates rewritten to ISO."),
]:
    register(_name)(_ingest(_style, _doc))


@register("monthly_append")
def _monthly_append(spark, sf_dir):
    """All month drops (with header drift, index columns, NA tokens,
    d/m/Y dates, float-formatted integers) appended with their source month."""
    return load_monthly(spark, landing(spark, sf_dir, "drift"), schemas.LISTINGS_RAW)


@register("csv_one_folder_months")
def _csv_one_folder_months(spark, sf_dir):
    """Month files named ``05_1998.csv.gz`` in one folder, appended."""
    folder = shared_path(spark, "landing-named")
    write_named_months(bindings.listings_raw(spark, sf_dir), folder)
    return load_monthly(spark, folder, schemas.LISTINGS_RAW)


def csv_static(spark: SparkSession, sf_dir: str, name: str, schema) -> DataFrame:
    """A static bronze table written out as CSV and loaded again."""
    path = shared_path(spark, f"landing-{name}")
    write_csv(bindings.bronze(spark, sf_dir)[name], path)
    return load_csv(spark, list_csv_files(spark, path), schema)


for _name, _table_name, _schema, _clean in [
    ("csv_census_g01", "census_g01_raw", schemas.CENSUS_G01_RAW, silver.silver_census_g01),
    ("csv_census_g02", "census_g02_raw", schemas.CENSUS_G02_RAW, silver.silver_census_g02),
    ("csv_lga_code", "lga_code", schemas.LGA_CODE, None),
    ("csv_lga_suburb", "lga_suburb", schemas.LGA_SUBURB, None),
]:

    def _static(spark, sf_dir, table=_table_name, schema=_schema, clean=_clean):
        """A static table loaded from CSV (census: and cleaned)."""
        df = csv_static(spark, sf_dir, table, schema)
        return clean(df) if clean else df

    register(_name)(_static)


@register("bronze_typed")
def _bronze_typed(spark, sf_dir):
    """All-string rows (integers float-formatted, as pandas wrote them)
    cast to the bronze schema."""
    raw = bindings.listings_raw(spark, sf_dir)
    as_text = raw.select(
        *[
            (F.concat(F.col(f.name).cast("string"), F.lit(".0")) if f.name in ("accommodates", "availability_30")
             else F.col(f.name).cast("string")).alias(f.name)
            for f in raw.schema.fields
        ]
    )
    return cast_to_schema(as_text, schemas.LISTINGS_RAW)


@register("full_reload")
def _full_reload(spark, sf_dir):
    """All five bronze tables emptied and reloaded (twice: idempotent);
    returns the reloaded listing snapshots."""
    base = shared_path(spark, "bronze")
    tables = bindings.bronze(spark, sf_dir)
    sinks.full_reload(tables, base)
    return sinks.full_reload(tables, base)["listings_raw"]


@register("dq_unique_key")
def _dq_unique_key(spark, sf_dir):
    """Bronze (listing_id, scraped_date) keys that occur more than once."""
    return quality.duplicate_keys(bindings.listings_raw(spark, sf_dir), list(schemas.LISTING_KEY))


@register("dq_not_null")
def _dq_not_null(spark, sf_dir):
    """NULL counts of the bronze key columns."""
    return quality.null_key_counts(bindings.listings_raw(spark, sf_dir), list(schemas.LISTING_KEY))


@register("sink_table")
def _sink_table(spark, sf_dir):
    """The suburb dimension materialised as table gold.dm_suburb."""
    return sinks.write_table(model(spark, sf_dir).dm_suburb, "gold", "dm_suburb", shared_path(spark, "warehouse"))


@register("sink_view")
def _sink_view(spark, sf_dir):
    """The host-neighbourhood mart as a lasting catalog view over the
    written fact."""
    base = shared_path(spark, "catalog")
    house = warehouse(spark, sf_dir).build(["fact"])
    sinks.register_table(spark, "gold", "fact_listings", house.path_of("fact"), base)
    return sinks.publish_view(spark, "datamart", "dm_host_neighbourhood", marts.HOST_NEIGHBOURHOOD_SQL, base)


@register("fact_partitioned")
def _fact_partitioned(spark, sf_dir):
    """The fact written partitioned by (year, month), read back and
    counted per partition.  Its md5 keys are made of the shuffled rows."""
    ids, host_key = warehouse(spark, sf_dir).fact_ids, gold.lookup_keys()["host_key"]
    laid = sinks.write_fact_partitioned(ids, shared_path(spark, "fact"), host_key=host_key, finish=gold.with_keys)
    return laid.groupBy("year", "month").agg(F.count(F.lit(1)).alias("n_rows"))


@register("fact_clustered")
def _fact_clustered(spark, sf_dir):
    """The fact along the Z-order curve of its lookup keys, read back by
    each of them: snapshots and stays of the least host, suburb and property."""
    ids = warehouse(spark, sf_dir).fact_ids
    laid = sinks.write_fact_clustered(ids, shared_path(spark, "fact-clustered"), gold.lookup_keys(), finish=gold.with_keys)
    found = []
    for key in sinks.LOOKUP_KEYS:
        least = scalar_of(laid.agg(F.min(key)))
        rows = laid.where(F.col(key) == least).agg(F.count(F.lit(1)).alias("n_rows"), F.sum(30 - F.col("availability_30")).alias("stays"))
        found.append(rows.select(F.lit(key).alias("key"), "n_rows", "stays"))
    return found[0].unionByName(found[1]).unionByName(found[2])


_runs: dict[tuple, monthly_run.RunState] = {}


def _year(month: str) -> str:
    return month[:4]


def incremental_run(spark: SparkSession, sf_dir: str) -> monthly_run.RunState:
    """The monthly drops (with header drift) applied in order, a year's months
    to a step; run once per session, its written state shared by the queries."""
    key = (session_key(spark), sf_dir, "batch")
    if key not in _runs:
        root = landing(spark, sf_dir, "drift")
        state = monthly_run.RunState(shared_path(spark, "silver"), shared_path(spark, "history"))
        _runs[key] = monthly_run.run_drops(spark, root, state, together=_year)
    return _runs[key]


def shared_run(spark: SparkSession, sf_dir: str) -> monthly_run.RunState:
    """One state that a batch run, a stream in several micro-batches and a
    second batch run extend in turn; late host versions are placed into the
    history, so that it does not depend on who came when.  Once per session."""
    key = (session_key(spark), sf_dir, "stream")
    if key not in _runs:
        root = landing(spark, sf_dir, "drift")
        state = monthly_run.RunState(shared_path(spark, "silver"), shared_path(spark, "history"), late_versions=True)
        drops = monthly_run.batches(spark, root, "month")
        monthly_run.run_drops(spark, root, state, until=drops[len(drops) // 4][0], together=_year)
        n_files = sum(len(files) for _, files in drops)
        stream_drops(spark, root, state, shared_path(spark, "stream-ckpt"), files_per_batch=n_files // 2 + 1, together=_year)
        _runs[key] = monthly_run.run_drops(spark, root, state)
    return _runs[key]


@register("upsert_listings")
def _upsert_listings(spark, sf_dir):
    """Monthly drops applied a year at a time - silver upserted on
    (listing_id, scraped_date), touched partitions only."""
    return incremental_run(spark, sf_dir).silver(spark)


@register("scd2_merge")
def _scd2_merge(spark, sf_dir):
    """Host history built by merging the drops in order (open
    versions rewritten, closed ones appended)."""
    return incremental_run(spark, sf_dir).history(spark)


@register("stream_upsert_listings")
def _stream_upsert_listings(spark, sf_dir):
    """S13 as a stream: monthly drops picked up in several micro-batches and
    upserted into a silver table that a batch run began."""
    return shared_run(spark, sf_dir).silver(spark)


@register("stream_scd2")
def _stream_scd2(spark, sf_dir):
    """S14 as a stream: the host history that batch run, stream and batch run
    build over one state and one log of drops."""
    return shared_run(spark, sf_dir).history(spark)


@register("scd2_merge_late")
def _scd2_merge_late(spark, sf_dir):
    """S14 with late versions: the drops applied in reverse order, each older
    version placed into the closed history; equals the rebuild."""
    root = landing(spark, sf_dir, "drift")
    state = monthly_run.RunState(shared_path(spark, "silver"), shared_path(spark, "history"), late_versions=True)
    drops = monthly_run.batches(spark, root, "month")
    monthly_run.apply_drops(spark, root, state, drops[::-1], "batch", together=_year)
    return state.history(spark)


@register("pipeline_mart_listing")
def _pipeline_mart_listing(spark, sf_dir):
    """M1-M18 as one run from files: static CSV files, monthly drops, merged
    host history, gold tables, and the listing mart over them."""
    folders = {name: shared_path(spark, f"landing-{name}") for name in full_run.STATIC}
    bronze = bindings.bronze(spark, sf_dir)
    for name, folder in folders.items():
        write_csv(bronze[name], folder)
    model = full_run.run_from_files(
        spark, folders, landing(spark, sf_dir, "drift"), shared_run(spark, sf_dir), shared_path(spark, "warehouse"), as_of=bindings.AS_OF
    )
    return model.mart_listing_neighbourhood()


@register("mart_listing_refreshed")
def _mart_listing_refreshed(spark, sf_dir):
    """M18 kept up to date: two thirds of the months, then the rest, then some
    of the first again, each computed from its own months of the fact."""
    fact, path = warehouse(spark, sf_dir).fact, shared_path(spark, "mart-measures")
    months = sorted((r.year, r.month) for r in fact.select("year", "month").distinct().collect())
    cut = 2 * len(months) // 3
    for part in (months[:cut], months[cut:], months[cut // 2 : cut // 2 + 3]):
        mart_refresh.refresh(fact, "listing_neighbourhood", part, path)
    return mart_refresh.read_mart(spark, "listing_neighbourhood", path)


@register("load_with_rejects")
def _load_with_rejects(spark, sf_dir):
    """A load with unreadable prices, missing dates and repeated keys:
    accepted and quarantined rows, with the reason."""
    raw = bindings.listings_raw(spark, sf_dir)
    price = F.when(F.col("listing_id") % 101 == 0, F.lit("twelve")).otherwise(F.col("price").cast("string"))
    date = F.when(F.col("listing_id") % 97 != 0, F.col("scraped_date"))
    folder = shared_path(spark, "landing-faulty")
    write_csv(raw.withColumn("price", price).withColumn("scraped_date", date), folder)
    gate = full_run.load_with_rejects(
        spark, list_csv_files(spark, folder), schemas.LISTINGS_RAW, list(schemas.LISTING_KEY), silver.listing_order(), shared_path(spark, "gate")
    )
    cols = ["listing_id", "scraped_date", "scrape_id", "price"]
    accepted = gate.accepted(spark).select(F.lit("accepted").alias("verdict"), F.lit(None).cast("string").alias("reason"), *cols)
    return accepted.unionByName(gate.rejected(spark).select(F.lit("rejected").alias("verdict"), F.col("_reason").alias("reason"), *cols))


# Operator-level queries register themselves on import.
from staylens.plans import operator_queries  # noqa: E402,F401
