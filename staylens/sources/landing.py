"""Write bronze rows out as monthly CSV drops, the way the upstream source
delivers them, so the CSV ingest path runs on data derived from the test
tables.

A drop is a folder ``<root>/<batch>=<value>/part-*.csv.gz`` per batch (month or
year).  ``CsvStyle`` reproduces the quirks the ingest must absorb: column
order drift, a pandas index column with a blank header, a missing-value
token, day-first dates and float-formatted integers.  Writing is a normal
distributed CSV write.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylens.sources.csv_ingest import write_csv


@dataclass(frozen=True)
class CsvStyle:
    reverse_columns: bool = False
    index_column: bool = False      # leading "Unnamed: 0" row-number column
    null_value: str = ""            # how a missing cell is spelled
    dmy_dates: bool = False         # dates as d/m/Y instead of ISO
    float_ints: bool = False        # integers as "5.0"


PLAIN = CsvStyle()


def _render(df: DataFrame, style: CsvStyle, keep: list[str]) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.name in keep:
            cols.append(c)
            continue
        if isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "d/M/yyyy" if style.dmy_dates else "yyyy-MM-dd")
        elif isinstance(f.dataType, T.IntegerType | T.LongType) and style.float_ints and f.name not in (
            "listing_id",
            "scrape_id",
            "host_id",
        ):
            c = F.when(c.isNotNull(), F.concat(c.cast("string"), F.lit(".0")))
        else:
            c = c.cast("string")
        cols.append(c.alias(f.name))
    out = df.select(*cols)
    data_cols = [c for c in out.columns if c not in keep]
    if style.reverse_columns:
        data_cols = data_cols[::-1]
    if style.index_column:
        out = out.withColumn("Unnamed: 0", F.monotonically_increasing_id().cast("string"))
        data_cols = ["Unnamed: 0", *data_cols]
    return out.select(*data_cols, *keep)


def write_drops(
    raw: DataFrame,
    root: str,
    batch_col: str = "month",
    batch_format: str = "yyyy-MM",
    date_col: str = "scraped_date",
    style: CsvStyle = PLAIN,
    drift_from: str | None = None,
    drift_style: CsvStyle | None = None,
) -> None:
    """One CSV folder per batch of ``date_col``.  Batches at or after
    ``drift_from`` are written in ``drift_style`` (header drift over time)."""
    df = raw.withColumn(batch_col, F.date_format(F.col(date_col), batch_format))
    parts = [(df, style)]
    if drift_from is not None and drift_style is not None:
        parts = [
            (df.where(F.col(batch_col) < drift_from), style),
            (df.where(F.col(batch_col) >= drift_from), drift_style),
        ]
    # No shuffle of the rows: each task writes its rows of every batch, as the
    # delivery's parts.  A month that holds a third of all rows is then spread
    # over all tasks, and a part's size does not change with the table's.
    for i, (part, st) in enumerate(parts):
        rendered = _render(part, st, [batch_col])
        write_csv(rendered, root, st.null_value, partition_by=[batch_col], mode="append" if i else "overwrite")


def write_named_months(raw: DataFrame, folder: str, date_col: str = "scraped_date", style: CsvStyle = PLAIN) -> None:
    """One file per month, named ``05_2020.csv.gz``, all in one folder.  The
    files are written by month folder and then moved (metadata only)."""
    spark = raw.sparkSession
    # the typed rows are shuffled, their text is made after
    df = raw.withColumn("month", F.date_format(F.col(date_col), "MM_yyyy")).repartition("month")
    staged = f"{folder.rstrip('/')}-staged"
    write_csv(_render(df, style, ["month"]), staged, style.null_value, partition_by=["month"], rows_per_file=0)
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(staged).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path(folder))
    for month in fs.globStatus(path(f"{staged}/month=*")):
        name = month.getPath().getName().removeprefix("month=")
        for part in fs.globStatus(path(f"{staged}/month={name}/*.csv.gz")):
            fs.rename(part.getPath(), path(f"{folder}/{name}.csv.gz"))
