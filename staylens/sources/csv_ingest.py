"""CSV ingest into typed bronze.

The load job this replaces read each monthly CSV whole into one process,
bound its columns by (lower-cased) header name, dropped ``Unnamed:`` index
columns, turned the usual missing-value spellings into NULL, rewrote
``d/m/Y`` dates to ISO, and inserted row by row.  Here the same steps are
column expressions over a distributed CSV scan:

1. list the files and read the header line of each delivery folder (one
   tiny job per folder, run concurrently) — only metadata reaches the driver;
2. group files by header and read each group in ONE multi-file scan with an
   all-string schema in that header's order (a multi-file read binds columns
   by position, so files with different headers must not share a scan);
3. rename to lower case, drop blank-header columns, ``unionByName``;
4. NULL tokens -> NULL, ``d/m/Y`` -> ISO, cast to the bronze schema.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylens.functions.expressions import normalize_dmy_date

# The strings pandas' CSV reader treats as missing by default
# (its ``na_values`` defaults), which the source load job relied on.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# A blank header cell: pandas names it "Unnamed: <i>", Spark "_c<i>".
BLANK_HEADER = re.compile(r"^(unnamed:.*|_c\d+)$", re.IGNORECASE)

# Values keep their surrounding spaces both ways (Spark's writer trims them
# unless told otherwise; the source reader kept them).
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


CSV_GLOB = "*.[cC][sS][vV]{,.gz,.GZ,.bz2,.zst}"


def list_csv_files(spark: SparkSession, root: str) -> list[str]:
    """Every ``*.csv`` file under ``root`` (recursively; in any case, also
    compressed, as ``.csv.gz``), via the binaryFile
    source with only the ``path`` column selected (file contents are not
    read).  The list is metadata: one row per file."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", CSV_GLOB)
        .option("recursiveFileLookup", "true")
        .load(root)
        .select("path")
    )
    return sorted(r.path for r in files.collect())


POSITIONAL = re.compile(r"_c\d+")

# A month in a file's own name: "05_2020.csv".
MONTH_FILE = r"(?i)(?:^|/)(\d{1,2})_(\d{4})\.csv(?:\.\w+)?$"


def month_of_file(path: str) -> str | None:
    """``2020-05`` for a file named ``05_2020.csv``."""
    m = re.search(MONTH_FILE, path)
    return f"{m.group(2)}-{int(m.group(1)):02d}" if m else None


def _same_path(path: str) -> str:
    """The path without its store, in one spelling for the forms it comes in."""
    return re.sub(r"^\w+:(//[^/]*)?", "", unquote(path))


def files_spanning_lines(spark: SparkSession, paths: Sequence[str]) -> set[str]:
    """The files in which a quoted field runs over a line's end: some line
    holds an odd number of quotes.  One split scan; only file names come
    back."""
    if not paths:
        return set()
    lines = spark.read.text(list(paths)).select("value", F.col("_metadata.file_path").alias("file")).where(F.contains("value", F.lit('"')))
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    odd = {_same_path(r.file) for r in lines.where(quotes % 2 == 1).select("file").distinct().collect()}
    return {p for p in paths if _same_path(p) in odd}


def _header_of(spark: SparkSession, path: str, multiline: bool) -> tuple[str, ...]:
    reader = spark.read.options(**CSV_OPTIONS).option("multiLine", str(multiline).lower())
    return tuple(reader.csv(path).columns)


def read_headers(
    spark: SparkSession, paths: Sequence[str], whole: set[str], per_file: bool = False
) -> dict[str, tuple[str, ...]]:
    """Header of each file (first record only).

    By default one file per folder is read and its header applies to the
    folder: a folder is one delivery (a month's drop, possibly split into
    many part files by the exporter), so the number of header reads grows
    with deliveries, not files.  ``per_file`` reads every file's header."""
    if per_file:
        probes = {p: p for p in paths}
    else:
        first_in_folder: dict[str, str] = {}
        for p in sorted(paths):
            first_in_folder.setdefault(p.rsplit("/", 1)[0], p)
        probes = {p: first_in_folder[p.rsplit("/", 1)[0]] for p in paths}
    unique = sorted(set(probes.values()))
    with ThreadPoolExecutor(max_workers=8) as pool:
        heads = dict(zip(unique, pool.map(lambda p: _header_of(spark, p, p in whole), unique)))
    return {p: heads[probe] for p, probe in probes.items()}


def _blank_headers(spark: SparkSession, headers: dict[str, tuple[str, ...]], whole: set[str]) -> dict[str, tuple[str, ...]]:
    """Own headers of the files in folders whose header has a blank cell.
    Spark names such a cell by its position and then compares no header of the
    folder, so a file with other columns would come back with its values under
    the wrong names: it stops the load here."""
    folders = [p for p, header in headers.items() if any(POSITIONAL.fullmatch(h) for h in header)]
    own = read_headers(spark, folders, whole, per_file=True) if folders else {}
    for p, header in own.items():
        if header != headers[p]:
            raise ValueError(f"the header of {p} is not its folder's: {', '.join(header)}")
    return own


def bind_by_name(df: DataFrame) -> DataFrame:
    """Lower-case every header name and drop blank-header columns."""
    keep = [c for c in df.columns if not BLANK_HEADER.match(c)]
    return df.select(*[F.col(f"`{c}`").alias(c.lower()) for c in keep])


def read_csv_by_name(
    spark: SparkSession,
    paths: Sequence[str],
    base_path: str | None = None,
    multiline: bool | None = None,
    header_per_file: bool = False,
    file_name: str | None = None,
    required: Sequence[str] = (),
) -> DataFrame:
    """All files as one all-string frame, columns bound by header name.
    ``file_name`` names a column for each row's source file; a file whose
    header lacks a ``required`` column is an error.

    ``base_path`` enables partition discovery (``month=2020-05/`` folders
    become a column).  Files with newlines inside quoted fields are read whole,
    one task each, all others in splits: ``multiline`` None finds out by one
    scan of the lines, True or False says it for all files.
    """
    whole = files_spanning_lines(spark, paths) if multiline is None else set(paths) if multiline else set()
    headers = read_headers(spark, paths, whole, per_file=header_per_file)
    if not header_per_file:
        headers |= _blank_headers(spark, headers, whole)
    for p in paths:
        absent = {r.lower() for r in required} - {h.lower() for h in headers[p]}
        if absent:
            raise ValueError(f"{p} has no column {', '.join(sorted(absent))}")
    groups: dict[tuple, list[str]] = {}
    for p in paths:
        groups.setdefault((headers[p], p in whole), []).append(p)
    frames = []
    for (header, is_whole), files in groups.items():
        # blank header cells get positional names, so the schema is built
        # from the header as Spark reads it
        schema = T.StructType([T.StructField(h, T.StringType()) for h in header])
        reader = (
            spark.read.options(**CSV_OPTIONS)
            .option("multiLine", str(is_whole).lower())
            # every file's header is held against the one read for its folder:
            # a differing one stops the load instead of shifting its columns
            # (positional names stand for blank cells, which Spark cannot
            # compare: those headers were read file by file)
            .option("enforceSchema", str(any(POSITIONAL.fullmatch(h) for h in header)).lower())
            .schema(schema)
        )
        if base_path:
            reader = reader.option("basePath", base_path)
        rows = reader.csv(files)
        if file_name:
            rows = rows.withColumn(file_name, F.col("_metadata.file_name"))
        frames.append(bind_by_name(rows))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def null_tokens_to_null(df: DataFrame, tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """Missing-value spellings -> NULL in every string column."""
    toks = list(tokens)
    return df.select(
        *[
            F.when(F.col(f.name).isin(toks), F.lit(None)).otherwise(F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def normalize_dates(df: DataFrame) -> DataFrame:
    """``d/m/Y`` -> ISO in every string column, as the load job did."""
    return df.select(
        *[
            normalize_dmy_date(f.name).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _cast(c: Column, t: T.DataType, strict: bool) -> Column:
    if isinstance(t, T.IntegerType | T.LongType | T.ShortType | T.DecimalType):
        # "5.0": integer columns arrive float-formatted from the pandas era;
        # a value that the type would round is as wrong as one it cannot read
        via = "decimal(38,10)"
        wide = c.cast(via) if strict else c.try_cast(via)
        narrow = wide.cast(t) if strict else wide.try_cast(t)
        kept = F.when(wide.isNull() | (wide == narrow.cast(via)), narrow)
        if not strict:
            return kept
        return kept.otherwise(F.raise_error(F.concat(F.lit(f"loses digits as {t.simpleString()}: "), c.cast("string"))).cast(t))
    if strict:
        return c.cast(t)
    return c.try_cast(t)


def cast_to_schema(
    df: DataFrame, schema: T.StructType, strict: bool = True, keep: Sequence[str] = (), optional: Sequence[str] = ()
) -> DataFrame:
    """Typed bronze (S6).  ``strict``: a value that does not parse fails the
    job (ANSI cast), as the typed INSERT did, and so does a schema column that
    ``df`` lacks, unless it is ``optional``; otherwise the value becomes NULL
    and the row is flagged in ``_rejected`` for quarantine.  ``keep`` columns
    (e.g. a discovered partition column) pass through unchanged."""

    actual = {c.lower(): c for c in df.columns}
    absent = [f.name for f in schema.fields if f.name.lower() not in actual and f.name not in optional]
    if strict and absent:
        raise ValueError(f"no column {', '.join(absent)}")

    def src(name: str) -> Column:
        # headers are bound in lower case, whatever the schema's spelling
        c = actual.get(name.lower())
        return F.col(f"`{c}`") if c is not None else F.lit(None).cast("string")

    cols = [_cast(src(f.name), f.dataType, strict).alias(f.name) for f in schema.fields]
    cols += [F.col(k) for k in keep]
    if strict:
        return df.select(*cols)
    bad = F.lit(False)
    for f in schema.fields:
        if f.name.lower() in actual:
            raw = src(f.name)
            bad = bad | (raw.isNotNull() & _cast(raw, f.dataType, False).isNull())
    return df.select(*cols, bad.alias("_rejected"))


def load_csv(
    spark: SparkSession,
    paths: Sequence[str],
    schema: T.StructType,
    base_path: str | None = None,
    extra_columns: Sequence[str] = (),
    multiline: bool | None = None,
    strict: bool = True,
    header_per_file: bool = False,
    optional: Sequence[str] = (),
) -> DataFrame:
    """S1-S6 end to end: files -> typed bronze rows (+ ``extra_columns``
    such as a discovered partition column).  Every file must have every column
    of the schema but the ``optional`` ones (``strict``)."""
    required = [f.name for f in schema.fields if f.name not in optional] if strict else ()
    raw = read_csv_by_name(spark, paths, base_path, multiline, header_per_file, required=required)
    clean = normalize_dates(null_tokens_to_null(raw))
    return cast_to_schema(clean, schema, strict, keep=extra_columns, optional=optional)


def load_monthly(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    partition_column: str = "month",
    multiline: bool | None = None,
    header_per_file: bool = False,
) -> DataFrame:
    """Every month file under ``root`` appended into one typed frame that
    keeps its source month (``YYYY-MM``) as a column: from a folder
    ``<partition_column>=YYYY-MM/``, or from a file's own name
    (``05_2020.csv``).  A file with neither is an error.  Order is a column
    value, not task order."""
    files = list_csv_files(spark, root)
    named = [f for f in files if f"/{partition_column}=" not in f]
    stray = [f for f in named if month_of_file(f) is None]
    if stray:
        raise ValueError(f"no month in the folder or name of {stray[0]}")
    frames = []
    foldered = sorted(set(files) - set(named))
    if foldered:
        frames.append(
            load_csv(spark, foldered, schema, base_path=root, extra_columns=[partition_column], multiline=multiline, header_per_file=header_per_file)
        )
    if named:
        # every named file is a delivery of its own, with its own header
        required = [f.name for f in schema.fields]
        raw = read_csv_by_name(spark, named, multiline=multiline, header_per_file=True, file_name="__file", required=required)
        parts = [F.regexp_extract("__file", MONTH_FILE, i) for i in (2, 1)]
        month = F.concat_ws("-", parts[0], F.lpad(parts[1], 2, "0"))
        clean = normalize_dates(null_tokens_to_null(raw)).withColumn(partition_column, month)
        frames.append(cast_to_schema(clean, schema, keep=[partition_column]))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


#: A compressed file is read by one task: what one file holds at most.
ROWS_PER_FILE = 1_000_000


def write_csv(
    df: DataFrame, path: str, null_value: str = "", partition_by: Sequence[str] = (), mode: str = "overwrite", rows_per_file: int = ROWS_PER_FILE
) -> None:
    """CSV sink with a header row, RFC-4180 quoting (doubled quotes), written
    as ``.csv.gz`` (a fifth of the text's bytes) in files of at most
    ``rows_per_file`` rows (0: any number)."""
    w = df.write.mode(mode).options(**CSV_OPTIONS).option("nullValue", null_value)
    # the fastest level: the slower ones save little more on such text
    w = w.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").option("maxRecordsPerFile", rows_per_file)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)
