"""Calendar expressions for the trend reports."""

from pyspark.sql import Column
from pyspark.sql import functions as F


# --- Fixed values: English day names, padded to 9 like TO_CHAR(ts, 'Day'), by dayofweek (1 = Sunday). ---
DAY_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]


def padded_day_name(ts: Column) -> Column:
    """Full English day name blank-padded to 9 characters ('Monday   '), from the
    calendar date (no session time zone is involved)."""
    dow = F.dayofweek(F.to_date(ts))
    out = None
    for i, name in enumerate(DAY_NAMES, 1):
        out = F.when(dow == i, F.lit(name.ljust(9))) if out is None else out.when(dow == i, F.lit(name.ljust(9)))
    return out


def calendar_year(ts: Column) -> Column:
    return F.year(ts).cast("bigint")


def iso_week(ts: Column) -> Column:
    """ISO-8601 week number (week 1 holds the year's first Thursday)."""
    return F.weekofyear(ts).cast("bigint")


def iso_week_year(ts: Column) -> Column:
    """The year an ISO week belongs to (2024-12-30 -> 2025): ``EXTRACT(YEAROFWEEK ...)``."""
    return F.extract(F.lit("YEAROFWEEK"), ts).cast("bigint")
