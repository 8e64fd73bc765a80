"""Raw page files and daily tables: sources SRC-1..7 and sinks SNK-1..3, SNK-9.

Pages are CSV files named ``page<N>_rows<R>_<start>to<end>.csv``; the name
carries the page number and its time span.  A multi-file read takes every page
once (no per-day re-reading): the task that has a file reads its header and its
rows, and numbers them.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.csv as pacsv
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.functions import timeaxis as tx
from gridloom.sources.schemas import COMPLETENESS, GRID_INFO, STATION_PAGE
from gridloom.sources.storage import filesystem, qualified

PAGE_NAME = r"^page(\d+)_rows(\d+)_(\d{8}_\d{6})to(\d{8}_\d{6})\.csv$"

# Header text of the grid dimension file and the names they map to (SRC-5).
GRID_HEADERS = {
    "格网ID（唯一）": "GRIDID",
    "格网左下角经度（度）": "LON_MIN",
    "格网左下角纬度（度）": "LAT_MIN",
    "格网右上角经度（度）": "LON_MAX",
    "格网右上角纬度（度）": "LAT_MAX",
    "格网编码": "GRID_CODE",
    "格网相对X坐标": "X_IDX",
    "格网相对Y坐标": "Y_IDX",
}


def page_name(page: F.Column, start: F.Column, end: F.Column, rows_per_page: int = 10000) -> F.Column:
    """SNK-9: ``page<N>_rows<R>_<yyyyMMdd_HHmmss>to<yyyyMMdd_HHmmss>.csv``."""
    return F.concat(F.lit("page"), page.cast("string"), F.lit(f"_rows{rows_per_page}_"),
                    tx.compact_time(start), F.lit("to"), tx.compact_time(end), F.lit(".csv"))


def parse_page_name(name: F.Column) -> list[F.Column]:
    """SRC-2: page, span_start, span_end from a file name (NULLs when the name does not match)."""
    ok = name.rlike(PAGE_NAME)
    return [F.when(ok, F.regexp_extract(name, PAGE_NAME, 1).cast("bigint")).alias("page"),
            F.when(ok, tx.parse_compact_time(F.regexp_extract(name, PAGE_NAME, 3))).alias("span_start"),
            F.when(ok, tx.parse_compact_time(F.regexp_extract(name, PAGE_NAME, 4))).alias("span_end")]


def list_pages(spark: SparkSession, folder: str) -> DataFrame:
    """SRC-2: the page files of a folder with their parsed names (file contents are not read)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(folder).select("path", "length")
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    return files.select(name.alias("file_name"), "length", *parse_page_name(name))


#: what became of a file: its rows, or one row with the reason
READ, STRAY, NO_TIME, UNREADABLE = "read", "not a page", "no time column", "unreadable"
_MARKS = "file_name string, status string, row_ord long, skipped long"


def _parse_files(columns: list[str], time_col: str):
    """Whole CSV files to rows of text, taken by header name; a file that is no page gives one row with its status.

    So does a page without rows.  ``skipped`` counts the file's lines that have another number of fields than the
    header (on its first row).  Spark passes no file of no bytes on.
    """
    fields = [("file_name", pa.string()), ("status", pa.string()), ("row_ord", pa.int64()), ("skipped", pa.int64())]
    schema = pa.schema(fields + [(c, pa.string()) for c in columns])

    def marked(name: str, status: str, rows: int, skipped: int, found: dict) -> pa.RecordBatch:
        if not rows:
            found = {}
        order = list(range(rows)) if status == READ and rows else [None]
        n = len(order)
        cols = [pa.array([name] * n), pa.array([status] * n), pa.array(order, pa.int64()),
                pa.array([skipped] * min(n, 1) + [0] * (n - 1), pa.int64())]
        return pa.RecordBatch.from_arrays(cols + [found.get(c, pa.nulls(n, pa.string())) for c in columns], schema=schema)

    def one(name: str, content: bytes) -> pa.RecordBatch:
        if not re.match(PAGE_NAME, name):
            return marked(name, STRAY, 1, 0, {})
        skipped = 0

        def skip(row) -> str:
            nonlocal skipped
            skipped += 1
            return "skip"

        content = content.removeprefix(b"\xef\xbb\xbf")
        try:
            names = [c.strip() for c in next(csv.reader([content.split(b"\n", 1)[0].decode("utf-8").rstrip("\r")]), [])]
            if time_col not in names:
                return marked(name, NO_TIME, 1, 0, {})
            at = {c: k for k, c in reversed(list(enumerate(names)))}  # the first of two equal names
            plain = [f"c{k}" for k in range(len(names))]
            table = pacsv.read_csv(
                pa.BufferReader(content), pacsv.ReadOptions(column_names=plain, skip_rows=1, use_threads=False),
                pacsv.ParseOptions(newlines_in_values=True, invalid_row_handler=skip),
                pacsv.ConvertOptions(column_types={c: pa.string() for c in plain}, null_values=[""], strings_can_be_null=True)) \
                if b"\n" in content.rstrip(b"\r\n") else pa.table({c: pa.array([], pa.string()) for c in plain})
        except (pa.ArrowInvalid, UnicodeDecodeError, csv.Error):
            return marked(name, UNREADABLE, 1, 0, {})
        table = table.combine_chunks()
        found = {c: table.column(at[c]).combine_chunks() for c in columns if c in at}
        return marked(name, READ, table.num_rows, skipped, found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):  # one file at a time
                yield one(batch.column("file_name")[k].as_py(), batch.column("content")[k].as_py())
    return run


def scan_pages(spark: SparkSession, folder: str, columns: list[str], time_col: str = "DDATETIME") -> DataFrame:
    """Every CSV file of a folder read once, by the task that has it: its rows as text, or why it has none.

    Columns: file_name, status, row_ord (place in the file), skipped, and ``columns`` as text.  A page
    is bounded by its number of rows, so a task holds one page.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(folder)
    named = files.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"), "content")
    text = ", ".join(f"`{c}` string" for c in columns)
    return named.mapInArrow(_parse_files(columns, time_col), f"{_MARKS}, {text}")


def file_report(spark: SparkSession, folder: str, time_col: str = "DDATETIME") -> DataFrame:
    """Per CSV file of a folder: status (``read``, ``no time column``, ``not a page``, ``unreadable``), rows read, lines
    skipped because they don't have the header's number of fields, and rows without a usable time."""
    rows = scan_pages(spark, folder, [time_col], time_col)
    return rows.groupBy("file_name", "status").agg(
        F.count("row_ord").alias("rows"), F.sum("skipped").alias("skipped"),
        F.count_if(F.col("row_ord").isNotNull() & tx.try_parse_exact(F.col(time_col)).isNull()).alias("rows_without_time"))


def read_pages(spark: SparkSession, folder: str, schema: T.StructType = STATION_PAGE,
               time_col: str = "DDATETIME") -> DataFrame:
    """SRC-1: all page CSVs of a folder with page, span and row order attached, every file read once.

    Columns are taken by header name, so a page may order them differently, lack some (NULL) or
    have more.  Files whose name is not a page name and pages without the time column are left
    out; ``file_report`` lists them.  A value that doesn't fit its type is NULL; the time text is
    parsed exactly (DT-10), NULL when it can't be.
    """
    rows = scan_pages(spark, folder, schema.names, time_col).filter(F.col("row_ord").isNotNull())
    typed = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields]
    out = rows.select(*typed, "file_name", *parse_page_name(F.col("file_name")), "row_ord")
    return out.withColumn("ts", tx.try_parse_exact(F.col(time_col)))


def write_daily(df: DataFrame, path: str, ts: str = "ts", order: list[str] | None = None, fmt: str = "parquet") -> None:
    """SNK-1 / SNK-3 / SRT-1: one partition folder per day, rows sorted by (time, grid) inside files.

    ``rebalance`` lets AQE split a day that holds many rows over several tasks;
    re-runs replace only the days they write (dynamic partition overwrite).
    """
    d = df.withColumn("date", F.to_date(ts))
    if order:
        d = d.select(*order, "date")
    d = d.hint("rebalance", "date").sortWithinPartitions("date", ts, *[c for c in ("GRIDID", "grid_id") if c in d.columns])
    (d.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date")
     .format(fmt).option("header", True).save(path))


def read_daily(spark: SparkSession, path: str, keep: list[str], days: list[str] | None = None) -> DataFrame:
    """SRC-4: the daily table with a keep-list; a day filter prunes partitions."""
    df = spark.read.parquet(path)
    if days:
        df = df.filter(F.col("date").isin(days))
    return df.select(*keep)


def write_completeness(report: DataFrame, path: str) -> None:
    """SNK-2: the scalar fields of the completeness report, day-sorted (range-partitioned part files)."""
    scalar = [f.name for f in COMPLETENESS.fields]
    out = report.withColumn("date", F.date_format("date", "yyyyMMdd")).select(*scalar)
    out.orderBy("date").write.mode("overwrite").option("header", True).csv(path)


def read_completeness(spark: SparkSession, path: str) -> DataFrame:
    """SRC-6: the completeness report with the date kept as text."""
    return spark.read.schema(COMPLETENESS).option("header", True).csv(path)


def read_grid_info(spark: SparkSession, path: str) -> DataFrame:
    """SRC-5: grid dimension CSV, headers mapped to names, five columns kept, ids ascending."""
    raw = spark.read.option("header", True).csv(path)
    named = raw.withColumnsRenamed({k: v for k, v in GRID_HEADERS.items() if k in raw.columns})
    cols = [(f.name, GRID_HEADERS_OUT[f.name]) for f in GRID_INFO.fields]
    return named.select(*[F.col(src).cast(GRID_INFO[dst].dataType).alias(dst) for dst, src in cols]) \
                .orderBy("grid_id")


# output name -> renamed source column
GRID_HEADERS_OUT = {"grid_id": "GRIDID", "lon_min": "LON_MIN", "lat_min": "LAT_MIN",
                    "lon_max": "LON_MAX", "lat_max": "LAT_MAX"}


def read_reanalysis(spark: SparkSession, path: str, keep: list[str]) -> DataFrame:
    """SRC-7: day CSVs, only the configured columns that exist (header names, values as double)."""
    raw = spark.read.option("header", True).csv(path)
    present = [c for c in keep if c in raw.columns]
    return raw.select(*[F.col(c) for c in present])


def parse_json_pages(payloads: DataFrame, row_schema: T.StructType, col: str = "value") -> DataFrame:
    """SRC-3: ``{"data": [rows]}`` payloads to rows; an empty or malformed page yields nothing."""
    page_schema = T.StructType([T.StructField("data", T.ArrayType(row_schema))])
    parsed = payloads.select("*", F.from_json(F.col(col), page_schema).alias("__p"))
    rest = [c for c in payloads.columns if c != col]
    return parsed.select(*rest, F.inline("__p.data"))


def read_json_pages(spark: SparkSession, path: str, row_schema: T.StructType) -> DataFrame:
    """SRC-3 from files: one JSON document per file."""
    docs = spark.read.option("wholetext", True).text(path).withColumn("file_name", F.col("_metadata.file_name"))
    return parse_json_pages(docs, row_schema)


def write_pages(df: DataFrame, folder: str, page: str, order: str, columns: list[str],
                time_text: str = "DDATETIME", rows_per_page: int = 10000) -> DataFrame:
    """Write one CSV per page, named after its page number and time span (SNK-9 names).

    One group is one page (at most ``rows_per_page`` rows); each task writes its
    pages with pyarrow's filesystem layer, so any shared store Spark can reach
    works.  Returns (page, file_name, rows) per written file; nothing is written
    until an action runs on it.
    """
    import pandas as pd

    out_schema = "page bigint, file_name string, rows bigint"
    folder = qualified(df.sparkSession, folder)

    def write(pdf: pd.DataFrame) -> pd.DataFrame:
        fs, root = filesystem(folder)
        fs.create_dir(root, recursive=True)
        pdf = pdf.sort_values(order, kind="stable")
        n = int(pdf[page].iloc[0])
        compact = lambda t: t.replace("-", "").replace(":", "").replace(" ", "_")
        name = f"page{n}_rows{rows_per_page}_{compact(pdf[time_text].min())}to{compact(pdf[time_text].max())}.csv"
        with fs.open_output_stream(f"{root}/{name}") as f:
            f.write(pdf[columns].to_csv(index=False).encode("utf-8"))
        return pd.DataFrame({"page": [n], "file_name": [name], "rows": [len(pdf)]})

    return df.groupBy(page).applyInPandas(write, out_schema)
