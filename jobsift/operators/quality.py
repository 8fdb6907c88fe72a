"""Data-quality rules of the stored table, applied before a load."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import non_numeric
from .dedupe import load_order
from .joins import bounded_broadcast
from ..session import cut_lineage
from ..schema import KEY, LISTING_COLUMNS, REQUIRED_COLUMNS


def conform_listing(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The 8 columns in file order, text time cast to TIMESTAMP_NTZ.

    A time that does not parse becomes NULL (and then fails the NOT NULL rule)
    rather than failing the whole job.
    """
    ts = F.col("time_when_scraped")
    kind = dict(df.dtypes)["time_when_scraped"]
    if kind == "string":
        ts = ts.try_cast("timestamp_ntz")
    elif kind != "timestamp_ntz":  # a zoned timestamp or a date: its wall-clock time
        ts = ts.cast("timestamp_ntz")
    cols = [ts.alias(c) if c == "time_when_scraped" else F.col(c) for c in LISTING_COLUMNS]
    return df.select(*cols, *(keep or []))


def numeric_id_ok(listing_id="listing_id", source="source") -> Column:
    """P2 predicate: LinkedIn ids must be all digits (NULL id fails); other sites pass."""
    lid = F.col(listing_id) if isinstance(listing_id, str) else listing_id
    src = F.col(source) if isinstance(source, str) else source
    return F.when(F.coalesce(src == "LinkedIn", F.lit(False)), ~non_numeric(lid)).otherwise(F.lit(True))


def numeric_listing_id(df: DataFrame) -> DataFrame:
    """Drop LinkedIn rows whose id is not all digits."""
    return df.filter(numeric_id_ok())


def null_violations(columns=REQUIRED_COLUMNS) -> Column:
    """Array of the required columns that are NULL in this row (empty when none)."""
    return F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns]))


def violates_not_null(columns=REQUIRED_COLUMNS) -> Column:
    cond = None
    for c in columns:
        cond = F.col(c).isNull() if cond is None else cond | F.col(c).isNull()
    return cond


def not_null_check(df: DataFrame, columns=REQUIRED_COLUMNS) -> DataFrame:
    """One row per (listing, NULL required column). Narrow: no shuffle."""
    return (df.select(*KEY, F.explode(null_violations(columns)).alias("column_name")))


def primary_key_check(df: DataFrame, key=KEY) -> DataFrame:
    """Keys held by more than one row, with their row count.

    A grouped count with map-side partial aggregation: a hot key costs one
    row per task in the shuffle, not its whole weight.
    """
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def file_flags(new_rows: DataFrame, file_col: str = "file_name", file_time_col: str | None = None) -> DataFrame:
    """Per file: new rows and bad new rows.

    ``new_rows`` survived P2 and J1 and carry ``null_bad`` (a required column
    is NULL). A new row is bad if it is NULL-bad or its key occurs twice among
    the file's new rows (the insert would break the primary key).

    With ``file_time_col`` the result is that of loading the files one at a
    time in load order (file time, then name): a row whose key an earlier
    *good* file supplies is known by then, so it counts neither as new nor as
    bad. Only contested rows (an earlier file has a clean row of their key) can be
    known; all others are counted once. Which files are good is settled over the
    contested bad rows of the files that nothing else makes bad (``bad_files_in_order``).
    """
    agg = [F.count(F.lit(1)).alias("n"), F.count_if(F.col("null_bad")).alias("n_null_bad")]
    if file_time_col:
        agg.append(F.min(file_time_col).alias("_ft"))
    per_key = new_rows.groupBy(file_col, *KEY).agg(*agg)
    bad = F.when(F.col("n") > 1, F.col("n")).otherwise(F.col("n_null_bad"))
    if not file_time_col:
        return per_key.groupBy(file_col).agg(F.sum("n").alias("n_new"), F.sum(bad).alias("n_bad"))
    per_key = per_key.select(file_col, *KEY, "n", bad.alias("_bad"), load_order("_ft", file_col).alias("_order"))
    per_key = cut_lineage(per_key)
    first = per_key.filter(F.col("_bad") == 0).groupBy(*KEY).agg(F.min("_order").alias("_first"))
    contested = F.coalesce(F.col("_first") < F.col("_order"), F.lit(False))
    rows = cut_lineage(per_key.join(first, KEY, "left").select(*per_key.columns, contested.alias("_contested")))
    dirty = bad_files_in_order(rows, file_col)
    supply = (rows.filter(F.col("_bad") == 0).join(dirty, file_col, "left_anti")
              .join(rows.filter("_contested").select(*KEY).distinct(), KEY, "left_semi").groupBy(*KEY).agg(F.min("_order").alias("_first")))
    known = rows.filter("_contested").join(supply, KEY).filter(F.col("_first") < F.col("_order")).groupBy(file_col).agg(
        F.sum("n").alias("_n"), F.sum("_bad").alias("_b"))
    whole = rows.groupBy(file_col).agg(F.sum("n").alias("n_new"), F.sum("_bad").alias("n_bad"))
    return cut_lineage(whole.join(known, file_col, "left").select(
        file_col, (F.col("n_new") - F.coalesce("_n", F.lit(0))).alias("n_new"), (F.col("n_bad") - F.coalesce("_b", F.lit(0))).alias("n_bad")))


#: Up to this many undecided rows (file, key) one task walks the files in load order; more are first thinned by rounds.
WALK_ROWS = 1_000_000


def bad_files_in_order(rows: DataFrame, file_col: str) -> DataFrame:
    """The files with a bad row that no earlier good file supplies.

    ``rows``: per (file, key) ``_bad`` (bad rows), ``_order`` and ``_contested`` (an earlier file has
    a clean row of the key). A file with an uncontested bad row is bad, one without bad rows is good. The
    others are undecided: of them only bad rows whose key no surely good file supplies earlier, and
    clean rows of such keys, are looked at. Within ``WALK_ROWS`` of these, one task takes the files in
    order and keeps the keys supplied so far. Beyond, each round settles the files all of whose keys have settled
    suppliers, and settled files leave.
    """
    has = F.col("_bad") > 0
    files = cut_lineage(rows.filter(has).groupBy(file_col).agg(F.count_if(~F.col("_contested")).alias("_sure")))
    dirty = files.filter("_sure > 0").select(file_col)
    undecided = files.filter("_sure = 0").select(file_col)
    bad = cut_lineage(rows.filter(has).join(undecided, file_col, "left_semi").select(file_col, *KEY, "_order"))
    clean = cut_lineage(rows.filter(~has).join(bad.select(*KEY).distinct(), KEY, "left_semi").join(dirty, file_col, "left_anti")
                        .select(file_col, *KEY, "_order"))
    while True:
        open_clean = clean.join(undecided, file_col, "left_semi")
        good = clean.join(undecided, file_col, "left_anti").groupBy(*KEY).agg(F.min("_order").alias("_good"))
        waiting = open_clean.groupBy(*KEY).agg(F.min("_order").alias("_open"))
        left = cut_lineage(bad.join(good, KEY, "left").filter(~F.coalesce(F.col("_good") < F.col("_order"), F.lit(False)))
                           .select(file_col, *KEY, "_order"))
        # a file without such a row is good (the events below still hold what it brings)
        undecided = cut_lineage(left.select(file_col).distinct())
        if left.limit(1).count() == 0:
            return dirty
        events = left.withColumn("_is_bad", F.lit(True)).unionByName(
            open_clean.join(left.select(*KEY).distinct(), KEY, "left_semi").withColumn("_is_bad", F.lit(False)))
        events = cut_lineage(events)
        if events.count() <= WALK_ROWS:
            one = events.select(F.col(file_col).alias("file"), *KEY, "_is_bad", "_order").repartition(1).sortWithinPartitions("_order")
            found = one.select("file", *KEY, "_is_bad").mapInPandas(_walk, "file string")
            return cut_lineage(dirty.unionByName(found.withColumnRenamed("file", file_col)))
        sure = left.join(waiting, KEY, "left").filter(~F.coalesce(F.col("_open") < F.col("_order"), F.lit(False))).select(file_col).distinct()
        dirty = cut_lineage(dirty.unionByName(sure))
        undecided = cut_lineage(undecided.join(sure, file_col, "left_anti"))
        bad = cut_lineage(left.join(sure, file_col, "left_anti"))
        clean = cut_lineage(clean.join(sure, file_col, "left_anti"))


def _walk(batches):
    """Files in load order with their undecided rows: the bad ones. Keys that good files supply are kept."""
    supplied: set = set()
    file, wanted, brings = None, [], []
    for pdf in batches:
        bad = []
        for name, listing_id, source, is_bad in pdf.itertuples(index=False):
            if name != file:
                if wanted and any(k not in supplied for k in wanted):
                    bad.append(file)
                else:
                    supplied.update(brings)
                file, wanted, brings = name, [], []
            (wanted if is_bad else brings).append((listing_id, source))
        yield pd.DataFrame({"file": pd.Series(bad, dtype=object)})
    if wanted and any(k not in supplied for k in wanted):
        yield pd.DataFrame({"file": [file]})


def outcome(n_rows: Column, n_new: Column, n_bad: Column) -> Column:
    return (F.when(F.coalesce(n_rows, F.lit(0)) == 0, F.lit("EMPTY"))
            .when(F.coalesce(n_new, F.lit(0)) == 0, F.lit("NO_NEW"))
            .when(n_bad > 0, F.lit("ERROR"))
            .otherwise(F.lit("LOADED")))


def ingest_outcome(rows: DataFrame, new_rows: DataFrame, files: DataFrame | None = None,
                   file_col: str = "file_name", flags: DataFrame | None = None) -> DataFrame:
    """Per file ``EMPTY`` / ``NO_NEW`` / ``ERROR`` / ``LOADED`` with its counts.

    ``rows`` are all rows read, ``new_rows`` those left after P2 and J1 (with
    ``null_bad``). ``files`` lists every file (header-only ones included);
    files holding rows are reported in any case. ``flags`` may pass
    ``file_flags(new_rows)`` already computed. All inputs are reduced to one
    row per file before they meet.
    """
    counts = rows.groupBy(file_col).agg(F.count(F.lit(1)).alias("n_rows"))
    stats = flags if flags is not None else file_flags(
        new_rows, file_col, "file_time" if "file_time" in new_rows.columns else None)
    # every listed file, and every file that has rows even if the listing missed it
    base = counts.select(file_col)
    if files is not None:
        base = files.select(file_col).union(base).distinct()
    zero = F.lit(0).cast("bigint")
    return (base.join(counts, file_col, "left").join(stats, file_col, "left")
            .select(file_col,
                    F.coalesce("n_rows", zero).alias("n_rows"),
                    F.coalesce("n_new", zero).alias("n_new"),
                    F.coalesce("n_bad", zero).alias("n_bad"),
                    outcome(F.col("n_rows"), F.col("n_new"), F.col("n_bad")).alias("outcome")))


def file_quarantine(new_rows: DataFrame, bad_files: DataFrame, file_col: str = "file_name",
                    broadcast_limit: int = 100_000) -> DataFrame:
    """Drop every row of a file that has a bad row (the whole file goes to Errors).

    ``bad_files`` is one row per file, so its size is bounded by the number of
    files in the batch; it is broadcast when that count is within
    ``broadcast_limit``, else joined by a shuffle.
    """
    bad = bounded_broadcast(bad_files.select(file_col).distinct(), broadcast_limit)
    return new_rows.join(bad, file_col, "left_anti")
