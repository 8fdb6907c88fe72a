"""Listing files: CSV with a header, all text, quotes doubled, values may span lines.

A result set is one file ``<source>_<yyyyMMdd_HHmm>.csv``. Spark writes a
"file" as a folder of part files; such a folder named ``*.csv`` (``file_name=
X.csv``) counts as one listing file, like a flat ``X.csv``.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import file_name_of_path, in_result_set_folder, metadata_file_path, path_dir, result_set_file_name
from ..schema import LISTING_COLUMNS, LISTING_TEXT_SCHEMA, TIME_TEXT_FORMAT
from ..session import cut_lineage

CSV_READ_OPTIONS = {
    "header": "true",
    "multiLine": "true",  # scraped text may hold line breaks inside quotes
    "escape": '"',  # quotes are doubled inside quoted values
    "encoding": "UTF-8",
    "mode": "PERMISSIVE",
}

#: Distinct headers among the files of one read that are read one by one; beyond, the files go through ``_by_name``.
HEADERS = 16
#: Columns of a file that ``_by_name`` looks at.
FIELDS = 256

CSV_WRITE_OPTIONS = {
    "header": "true",
    "escape": '"',
    "emptyValue": "",  # None and '' are both written as an empty field
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def literal_path(p: str) -> str:
    """Escape glob characters so a file name is read as it is."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", p)


def top_level_csv(folder: str) -> str:
    """Glob of the listing files directly in ``folder`` (case-sensitive ``.csv``;
    sub-folders such as ``Processed/`` and ``Errors/`` are not matched)."""
    return f"{folder.rstrip('/')}/*.csv"


def read_listings_csv(spark: SparkSession, path, with_file: bool = True, multi_line: bool = True,
                      empty_if_no_match: bool = False) -> DataFrame:
    """Listing files as 8 text columns (+ ``file_name``, ``file_time``, ``file_error``).

    Columns are taken by the names in each file's header, in whatever order and
    among however many others; rows of a file that lacks one, and rows with more
    fields than the header (a value after the last named column, which a plain read would
    drop unseen), say so in ``file_error``. The distinct header lines are read first; all files of one
    header are then one JVM-side read. No schema inference: every
    column is a string, as the files are text. A
    multi-line CSV file is read by one task, so parallelism comes from the
    number of files (result sets Spark writes are split into several part
    files). Files known to hold no line break inside a value, and known to have
    the 8 columns in order (else the read fails), can be read with
    ``multi_line=False``, which makes each file splittable.

    A path that does not exist is an error; with ``empty_if_no_match`` a glob
    that matches no file gives no rows (Spark cannot tell a missing folder from
    an empty one through a glob, so both read as empty then).
    """
    paths = [path] if isinstance(path, str) else list(path)
    opts = dict(CSV_READ_OPTIONS, multiLine="false", enforceSchema="false")
    try:
        heads = _header_lines(spark, paths) if multi_line else None
        df = None if multi_line else spark.read.schema(LISTING_TEXT_SCHEMA).options(**opts).csv(paths)
    except AnalysisException as e:
        if not (empty_if_no_match and not_found(e)):
            raise
        heads, df = {}, None
    if df is not None:
        named = df.select(*LISTING_COLUMNS, *_file_columns(F.lit(None).cast("string"))) if with_file else df
    elif not heads:
        empty = spark.createDataFrame([], LISTING_TEXT_SCHEMA)
        named = empty.select(*LISTING_COLUMNS, *[F.lit(None).cast(t).alias(c) for c, t in _FILE_COLUMNS])
    elif len(heads) > HEADERS or any(header_columns(line) is None for line in heads):
        named = _read_by_name(spark, paths)
    else:
        named = None
        for line, files in heads.items():
            part = _read_header(spark, paths if len(heads) == 1 else [literal_path(f) for f in files], header_columns(line))
            named = part if named is None else named.unionByName(part)
    return named if with_file else named.select(*LISTING_COLUMNS)


def _file_columns(error: Column) -> list[Column]:
    return [file_name_of_path(metadata_file_path()).alias("file_name"), F.col("_metadata.file_modification_time").alias("file_time"),
            error.alias("file_error")]


def _header_lines(spark: SparkSession, paths: list[str]) -> dict[str, list[str]]:
    """The files of each distinct first line (the paths only where there are several, and at most HEADERS, of them)."""
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"))
    first = (lines.filter("at = 0").withColumn("row", F.monotonically_increasing_id()).groupBy("path")
             .agg(F.min_by("value", "row").alias("line")))
    first = cut_lineage(first)
    found = {r["line"]: [] for r in first.select("line").distinct().limit(HEADERS + 1).collect()}
    if 1 < len(found) <= HEADERS:
        for r in first.collect():  # one path per file, as the listing of the read holds them
            found[r["line"]].append(unquote(r["path"]))
    return found


def header_columns(line: str) -> list[str] | None:
    """The column names of a header line; None where a quoted name goes on in the next line."""
    if line.count('"') % 2:
        return None
    return [h.strip() for h in next(csv.reader([line.lstrip("\ufeff")]), [])]


def _read_header(spark: SparkSession, paths: list[str], names: list[str]) -> DataFrame:
    """Files of one header: its columns by position, the 8 by name, and one field beyond for surplus values."""
    places = {h: i for i, h in reversed(list(enumerate(names)))}
    missing = [c for c in LISTING_COLUMNS if c not in places]
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names) + 1)])
    df = spark.read.schema(schema).options(**CSV_READ_OPTIONS).csv(paths)
    if missing:
        error = F.lit(f"no column {', '.join(missing)}")
    else:
        error = F.when(F.col(f"c{len(names)}").isNotNull(), F.lit("more fields than the header"))
    return df.select(*((F.col(f"c{places[c]}") if c in places else F.lit(None).cast("string")).alias(c) for c in LISTING_COLUMNS),
                     *_file_columns(error))


def _read_by_name(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Files of many headers, or of headers over several lines: every row passes ``_by_name``."""
    schema = ", ".join(f"c{i} string" for i in range(FIELDS))
    df = spark.read.schema(schema).options(**dict(CSV_READ_OPTIONS, header="false")).csv(paths)
    raw = df.select(F.col("_metadata.file_path").alias("_path"), *_file_columns(F.lit(None).cast("string"))[:2], *[f"c{i}" for i in range(FIELDS)])
    return raw.mapInArrow(_by_name, ", ".join([*(f"{c} string" for c in LISTING_COLUMNS), *(f"{c} {t}" for c, t in _FILE_COLUMNS)]))


_FILE_COLUMNS = (("file_name", "string"), ("file_time", "timestamp"), ("file_error", "string"))


def _by_name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Raw fields to the columns by name; the first row of each file is its header.

    A file that is read with line breaks in values is never split, so its rows
    reach one task together and in order. A row of a file without all columns,
    or with more fields than its header, carries what is wrong as ``file_error``.
    """
    path, places, width, error = None, {}, 0, None
    for batch in batches:
        paths = batch.column(0).to_pylist()
        cuts = [0, *(i for i in range(1, len(paths)) if paths[i] != paths[i - 1]), len(paths)]
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            if lo == hi:
                continue
            part = batch.slice(lo, hi - lo)
            if paths[lo] != path:
                path = paths[lo]
                header = [part.column(3 + i)[0].as_py() for i in range(FIELDS)]
                width = max((i + 1 for i, h in enumerate(header) if h is not None), default=0)
                places = {h.lstrip("\ufeff").strip(): i for i, h in reversed(list(enumerate(header))) if h is not None}
                missing = [c for c in LISTING_COLUMNS if c not in places]
                error = f"no column {', '.join(missing)}" if missing else None
                part = part.slice(1)
            n = part.num_rows
            if not n:
                continue
            errors = [error] * n
            if error is None:
                for i in range(width, FIELDS):
                    if part.column(3 + i).null_count < n:
                        errors = ["more fields than the header" if v is not None else e
                                  for v, e in zip(part.column(3 + i).to_pylist(), errors, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*(part.column(3 + places[c]) if c in places else pa.nulls(n, pa.string()) for c in LISTING_COLUMNS),
                 part.column(1), part.column(2), pa.array(errors, pa.string())],
                names=[*LISTING_COLUMNS, *(c for c, _ in _FILE_COLUMNS)])


_FILES_SCHEMA = "file_name string, file_time timestamp, n_bytes bigint"


def not_found(e: AnalysisException) -> bool:
    return "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e)


def list_listing_files(spark: SparkSession, folder: str) -> DataFrame:
    """``(file_name, file_time, n_bytes)`` of the listing files in ``folder``, from
    the file listing alone (``binaryFile`` with path, time and length selected:
    no file content is read). A folder without listing files gives no rows (as
    does a missing folder: through a glob Spark cannot tell them apart).
    ``file_time`` is the earliest modification time of the file's parts."""
    try:
        listed = spark.read.format("binaryFile").load(top_level_csv(folder))
    except AnalysisException as e:
        if not_found(e):
            return spark.createDataFrame([], _FILES_SCHEMA)
        raise
    return (listed
            .select(file_name_of_path(F.col("path")).alias("file_name"),
                    F.col("modificationTime").alias("mtime"), F.col("length"))
            .groupBy("file_name")
            .agg(F.min("mtime").alias("file_time"), F.sum("length").alias("n_bytes")))


def list_parts(spark: SparkSession, folder: str) -> DataFrame:
    """``(lpath, path, time, length)`` of every physical file of the listing files in
    ``folder``; ``lpath`` is the listing file it belongs to: the result-set folder for
    a part file Spark wrote, else the file itself."""
    try:
        listed = spark.read.format("binaryFile").load(top_level_csv(folder))
    except AnalysisException as e:
        if not not_found(e):
            raise
        return spark.createDataFrame([], "lpath string, path string, time timestamp, length bigint")
    path = F.col("path")
    logical = F.when(in_result_set_folder(path), path_dir(path)).otherwise(path)
    return listed.select(logical.alias("lpath"), "path", F.col("modificationTime").alias("time"), "length")


def listing_paths(spark: SparkSession, folder: str) -> list[str]:
    """The paths of the listing files in ``folder``."""
    return sorted(r["lpath"] for r in list_parts(spark, folder).select("lpath").distinct().collect())


def discover_listing_files(spark: SparkSession, folder: str) -> DataFrame:
    """``(file_name, file_time, n_bytes, n_rows)`` for every listing file in ``folder``.

    The listing comes from the ``binaryFile`` source with only path, time and
    length selected, so no file content is read for it; header-only files are
    kept with ``n_rows = 0``. Row counts are a grouped count over the CSV read.
    """
    files = list_listing_files(spark, folder)
    rows = (read_listings_csv(spark, top_level_csv(folder), empty_if_no_match=True).groupBy("file_name")
            .agg(F.count(F.lit(1)).alias("n_rows")))
    return (files.join(rows, "file_name", "left")
            .select("file_name", "file_time", "n_bytes", F.coalesce("n_rows", F.lit(0).cast("bigint")).alias("n_rows")))


def as_listing_text(df: DataFrame) -> DataFrame:
    """The 8 columns as text in file order (time as ``yyyy-MM-dd HH:mm:ss``)."""
    ts = F.col("time_when_scraped")
    if dict(df.dtypes)["time_when_scraped"] != "string":
        ts = F.date_format(ts, TIME_TEXT_FORMAT)
    return df.select(*[ts.alias(c) if c == "time_when_scraped" else F.col(c).cast("string")
                       for c in LISTING_COLUMNS], *[c for c in df.columns if c == "file_name"])


def write_result_set_csv(df: DataFrame, folder: str, run_time_col: str | None = None) -> None:
    """Write listings as result-set files under ``folder``.

    Each result set (``file_name``, or S6 of source and ``run_time_col``) becomes
    ``folder/file_name=<name>.csv/part-*.csv`` with a header and the 8 columns
    in file order. The rows are rebalanced by file (AQE splits a hot result set
    over several writers) instead of being forced into one task per file. A
    result set written again replaces its earlier file, as a scraper rewriting
    a file does.
    """
    if "file_name" not in df.columns:
        df = df.withColumn("file_name", result_set_file_name(F.col("source"), F.col(run_time_col)))
    out = as_listing_text(df).hint("rebalance", "file_name")
    # a result set written again replaces its file (other files in the folder stay)
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("file_name")
     .options(**CSV_WRITE_OPTIONS).csv(folder.rstrip("/")))


def write_empty_result_sets(names: DataFrame, folder: str) -> None:
    """Header-only listing files (searches that found nothing), one per ``file_name``
    in ``names``, written by one job: the header line goes out through the text
    writer partitioned by file, so each result set's folder holds just a header."""
    header = ",".join(LISTING_COLUMNS)
    (names.select("file_name", F.lit(header).alias("value")).distinct()
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("file_name")
     .text(folder.rstrip("/")))
