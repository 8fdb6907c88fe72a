"""Listing volume per day, week and year, and a cheap table size.

Each report is a grouped count: partial aggregation on the map side, so only
one row per group and task is shuffled, however skewed the dates are.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import calendar_year, iso_week, iso_week_year, padded_day_name

COUNT_COL = "number_of_jobs_posted"


def jobs_per_day(df: DataFrame, ts_col: str = "time_when_scraped", sort: bool = True,
                 as_date: bool = False) -> DataFrame:
    """A1: day, blank-padded day name, count; by day.

    ``date_only`` is the day's start as TIMESTAMP_NTZ (midnight), the type the
    tables use for dates (``as_date=True`` gives a DATE). The day name is
    derived from the day after the aggregation: one name per day, not per row.
    """
    day = F.to_date(F.col(ts_col))
    out = (df.groupBy(day.alias("_day")).agg(F.count(F.lit(1)).alias(COUNT_COL))
           .select((F.col("_day") if as_date else F.col("_day").cast("timestamp_ntz")).alias("date_only"),
                   padded_day_name(F.col("_day")).alias("day_of_week"), COUNT_COL))
    return out.orderBy("date_only") if sort else out


def jobs_per_week(df: DataFrame, ts_col: str = "time_when_scraped", iso_year: bool = False,
                  sort: bool = True) -> DataFrame:
    """A2: (year, ISO week, count).

    By default the year is the calendar year, as in the report this mirrors
    (2024-12-30 is week 1 of calendar year 2024); ``iso_year=True`` uses the
    year the ISO week belongs to instead.
    """
    ts = F.col(ts_col)
    year = iso_week_year(ts) if iso_year else calendar_year(ts)
    out = df.groupBy(year.alias("year"), iso_week(ts).alias("week")).agg(F.count(F.lit(1)).alias(COUNT_COL))
    return out.orderBy("year", "week") if sort else out


def jobs_per_year(df: DataFrame, ts_col: str = "time_when_scraped", sort: bool = True) -> DataFrame:
    """A3: (year, count)."""
    out = df.groupBy(calendar_year(F.col(ts_col)).alias("year")).agg(F.count(F.lit(1)).alias(COUNT_COL))
    return out.orderBy("year") if sort else out


def estimated_row_count(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """A4: row count of a parquet table from file metadata.

    The scan reads no column (``ReadSchema: struct<>``): row counts come from
    the row-group footers, no page is decoded.
    """
    try:
        table = spark.read.parquet(*([path] if isinstance(path, str) else path))
    except AnalysisException as e:
        if "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        return spark.createDataFrame([(0,)], "estimate bigint")  # a table with no data files yet
    return table.agg(F.count(F.lit(1)).alias("estimate"))


def estimated_table_rows(spark: SparkSession, table: str) -> DataFrame:
    """A4 for a catalog table: its row count from the catalog's statistics, without any scan.

    The statistics are those of the last ``ANALYZE TABLE ... COMPUTE STATISTICS`` and are not kept up by
    later writes, as an estimate's are not. A table that has none is counted from its file footers, and
    so is one of 0 rows (what a ``NOSCAN`` analysis, which takes sizes only, reports).
    """
    info = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    rows = re.search(r"(\d+) rows", info.get("Statistics") or "")
    if rows and int(rows.group(1)):
        return spark.createDataFrame(pa.table({"estimate": pa.array([int(rows.group(1))], pa.int64())}))
    return spark.table(table).agg(F.count(F.lit(1)).alias("estimate"))
