"""Screening: which stored listings are worth a look.

All predicates are built-in Column expressions, so the whole screen is one
scan + filter stage (whole-stage codegen); only the final sort exchanges data,
and that sort is range-partitioned.
"""

from __future__ import annotations

import datetime as _dt
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import rules
from ..functions.text import has_whole_word, ilike_any, work_mode, work_mode_allowed
from ..schema import KEY, SCREEN_COLUMNS
from ..session import cut_lineage
from .joins import bounded_broadcast


def company_not_blocked(company="company", fix_list: bool = False) -> Column:
    """``company NOT IN (...)``: exact, case-sensitive; NULL company is not kept."""
    names = rules.BLOCKED_COMPANIES_INTENDED if fix_list else rules.BLOCKED_COMPANIES
    c = F.col(company) if isinstance(company, str) else company
    return ~c.isin(list(dict.fromkeys(names)))


def title_has_excluded_substring(title="title") -> Column:
    return ilike_any(title, rules.TITLE_EXCLUDED_SUBSTRINGS)


def title_has_excluded_word(title="title") -> Column:
    return has_whole_word(title, rules.TITLE_EXCLUDED_WORDS)


def title_not_excluded(title="title") -> Column:
    """``NOT (title ILIKE ... OR title ~* '\\yml\\y' ...)``: one predicate, NULL title not kept."""
    return ~(title_has_excluded_substring(title) | title_has_excluded_word(title))


def location_included(location="location") -> Column:
    return ilike_any(location, rules.LOCATION_INCLUDED_SUBSTRINGS)


def junior_title(title="title") -> Column:
    return ilike_any(title, rules.JUNIOR_TITLE_SUBSTRINGS)


#: Names of a blocklist table up to which it is broadcast.
BLOCKLIST_BROADCAST_LIMIT = 1_000_000


def company_blocklist_table(df: DataFrame, names: DataFrame, name_col: str = "name", company: str = "company") -> DataFrame:
    """P4 with the list as data: ``company NOT IN (SELECT name FROM names)``, exact and case-sensitive.

    The null-aware rules of ``NOT IN``: a NULL company is dropped, a NULL name in the list drops
    everything, an empty list drops nothing. The list is counted, broadcast within
    BLOCKLIST_BROADCAST_LIMIT and joined by a shuffle (anti join) beyond.
    """
    listed = cut_lineage(names.select(F.col(name_col).cast("string").alias("_name")).distinct())
    if listed.limit(1).count() == 0:
        return df
    if listed.filter(F.col("_name").isNull()).limit(1).count():
        return df.limit(0)
    return df.filter(F.col(company).isNotNull()).join(bounded_broadcast(listed, BLOCKLIST_BROADCAST_LIMIT), F.col(company) == F.col("_name"), "left_anti")


def company_blocklist(df: DataFrame, fix_list: bool = False) -> DataFrame:
    """Drop listings of blocked companies (becomes an INSET filter, pushed to parquet)."""
    return df.filter(company_not_blocked("company", fix_list))


def title_pattern_exclusion(df: DataFrame) -> DataFrame:
    """P5: drop titles holding any excluded substring (case-insensitive)."""
    return df.filter(~title_has_excluded_substring("title"))


def title_word_exclusion(df: DataFrame) -> DataFrame:
    """Drop titles holding 'ml', 'ai' or 'rpa' as a whole word."""
    return df.filter(~title_has_excluded_word("title"))


def location_inclusion(df: DataFrame) -> DataFrame:
    """Keep Columbus or remote listings; NULL location is dropped."""
    return df.filter(location_included("location"))


def screen_condition(fix_list: bool = False, junior_only: bool = False) -> Column:
    # the cheap tests first: most rows never reach the title's patterns
    cond = location_included("location") & company_not_blocked("company", fix_list) & title_not_excluded("title")
    if junior_only:
        cond = cond & junior_title("title")
    return cond


def screen_listings(df: DataFrame, fix_list: bool = False, junior_only: bool = False,
                    sort: bool = True) -> DataFrame:
    """The screening report: P4 and P5/P6 and P7, screen column order, newest first.

    The key breaks ties in the sort: the order is deterministic, and the range
    partitioner can split a timestamp shared by a large share of the rows.
    """
    out = df.filter(screen_condition(fix_list, junior_only)).select(*SCREEN_COLUMNS)
    if not sort:
        return out
    return out.orderBy(F.col("time_when_scraped").desc_nulls_first(), *[F.col(c).asc_nulls_first() for c in KEY])


def junior_quick_search(df: DataFrame, sort: bool = True) -> DataFrame:
    """The screen narrowed to junior titles."""
    return screen_listings(df, junior_only=True, sort=sort)


def recency_filter(df: DataFrame, as_of, ts_col: str = "time_when_scraped", hours: int = 24) -> DataFrame:
    """P10: rows of the ``hours`` before ``as_of`` (``as_of - hours < ts <= as_of``).

    ``as_of`` is a literal, so both bounds are plain comparisons with constants
    and reach the parquet scan as pushed filters.
    """
    if isinstance(as_of, str):
        as_of = _dt.datetime.fromisoformat(as_of)
    elif isinstance(as_of, _dt.date) and not isinstance(as_of, _dt.datetime):
        as_of = _dt.datetime.combine(as_of, _dt.time())
    if as_of.tzinfo is not None:
        raise ValueError("as_of must be a wall-clock time (no zone), like the timestamps it is compared with")
    lo = as_of - _dt.timedelta(hours=hours)

    def wall_clock(t):  # a TIMESTAMP_NTZ literal from text: no time zone is involved
        return F.lit(t.isoformat(sep=" ")).cast(T.TimestampNTZType())

    ts = F.col(ts_col)
    return df.filter((ts > wall_clock(lo)) & (ts <= wall_clock(as_of)))


def with_work_mode(df: DataFrame, location: str = "location") -> DataFrame:
    return df.withColumn("work_mode", work_mode(F.col(location)))


def work_mode_filter(df: DataFrame, search_location, source: str = "source") -> DataFrame:
    """Keep the listings a site's search for ``search_location`` returns, by work mode.

    ``search_location`` is a literal or a column (after a join with the search terms).
    """
    sl = F.lit(search_location) if isinstance(search_location, str) else search_location
    out = df if "work_mode" in df.columns else with_work_mode(df)
    return out.filter(work_mode_allowed(F.col(source), sl, F.col("work_mode")))


def newest_first(df: DataFrame, ts_col: str = "time_when_scraped", rank_col: str | None = "rank",
                 tie_break=KEY) -> DataFrame:
    """O1: newest first (NULLs first, as a descending PostgreSQL sort).

    The sort is range-partitioned. With ``rank_col`` the global 1-based
    position is attached without a single-partition window and without a copy of the
    table: time and key alone are range-partitioned first, which gives the ranges' first
    rows and sizes (one row per range reaches the driver); each row of the table then
    finds its range by comparing with those first rows, and its rank is the
    range's start plus its place there. Rows equal in time and key share a range.
    """
    order = [F.col(ts_col).desc_nulls_first()] + [F.col(c).asc_nulls_first() for c in tie_break]
    if not rank_col:
        return df.orderBy(*order)
    keys = df.select(F.col(ts_col).alias("t"), F.struct(*tie_break).alias("k"))
    by = [F.col("t").desc_nulls_first(), F.col("k").asc_nulls_first()]
    dealt = keys.repartitionByRange(*by).sortWithinPartitions(*by)
    found = dealt.groupBy(F.spark_partition_id().alias("p")).agg(F.first(F.struct("t", "k")).alias("first"), F.count(F.lit(1)).alias("n"))
    ranges = sorted(found.collect(), key=lambda r: r["p"])
    starts = [0]
    for r in ranges:
        starts.append(starts[-1] + r["n"])
    placed = df.withColumn("_range", _range_of([r["first"] for r in ranges], keys, ts_col, tie_break))
    window = Window.partitionBy("_range").orderBy(*order)
    start = F.element_at(F.array(*[F.lit(n).cast("bigint") for n in starts]), F.col("_range") + 1)
    # ranges in order over the partitions, each sorted once for the window: the output is in order as well
    return (placed.repartitionByRange(max(1, len(ranges)), "_range").withColumn(rank_col, start + F.row_number().over(window))
            .drop("_range"))


def _range_of(firsts: list, keys: DataFrame, ts_col: str, tie_break) -> Column:
    """The number (from 0) of the last range whose first row is not after this row: a search in two steps of about
    the square root of the ranges each."""
    if len(firsts) < 2:
        return F.lit(0)
    kind = keys.schema
    edges = [F.struct(F.lit(f["t"]).cast(kind["t"].dataType).alias("t"),
                      F.struct(*[F.lit(v).cast(c.dataType).alias(c.name) for v, c in zip(f["k"], kind["k"].dataType.fields, strict=True)]).alias("k"))
             for f in firsts[1:]]
    step = max(1, math.isqrt(len(edges)))
    t, k = F.col(ts_col), F.struct(*tie_break)

    def not_after(edge: Column) -> Column:
        e = edge["t"]
        before = (e.isNull() & t.isNotNull()) | F.coalesce(e > t, F.lit(False))
        return before | (e.eqNullSafe(t) & (edge["k"] <= k))

    coarse = F.size(F.filter(F.array(*edges[::step]), not_after))
    blocks = F.array(*[F.array(*edges[i:i + step]) for i in range(0, len(edges), step)])
    fine = F.size(F.filter(F.element_at(blocks, F.greatest(coarse, F.lit(1))), not_after))
    return F.when(coarse == 0, F.lit(0)).otherwise((coarse - 1) * step + fine).cast("int")
