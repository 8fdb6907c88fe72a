"""Loading listing files into the stored table.

Rule order (a bad row that is already stored is no error):
P1 conform -> P2 numeric LinkedIn ids -> J1 anti join with the store ->
C1/C2 flags -> P3 per-file outcome -> C3 quarantine of ERROR files ->
D2 first file wins among the good files -> S4 append.

Bulk mode handles many files in one pass (set-based, the store is never
shuffled for a small batch); the faithful one-file-at-a-time order is the
drop-folder ingest with one file per step, which loads the same rows.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedupe import first_file_wins, new_listings
from ..operators.quality import (conform_listing, file_flags, file_quarantine, ingest_outcome, numeric_id_ok,
                                 violates_not_null)
from ..schema import LISTING_COLUMNS
from ..session import cut_lineage
from ..sources.listing_csv import list_listing_files, list_parts, listing_paths, literal_path, not_found, read_listings_csv, top_level_csv
from ..sources.store import append_listings, batch_dir, batch_outcomes, bucket_of, holds_batch, read_known_keys, store_buckets


#: What a file that cannot be read raises, from a query or from a checkpoint.
READ_ERRORS = (PySparkException, Py4JJavaError)


def plan_batch(rows: DataFrame, known: DataFrame, files: DataFrame | None = None, checkpoint: bool = True,
               unreadable: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """``(to_append, outcomes)`` for a batch of listing-file rows.

    ``rows``: the 8 text columns + ``file_name`` (+ ``file_time``, ``file_error``).
    ``known``: the stored keys. With ``checkpoint`` the conformed rows are
    materialised once in the shared folder (the listing files are parsed once,
    not once per use), and so are the new rows, which feed both the outcome
    and the append (the store is probed once). Both cut the lineage: a lost
    executor does not send the batch back to the files and the store. Rows with
    a ``file_error`` are bad whatever is stored; files named in ``unreadable``
    gave no rows and end in ``ERROR``.
    """
    if files is not None and checkpoint:
        files = cut_lineage(files)  # one listing of the folder, however often the file list is used
    for name, kind in (("file_time", "timestamp"), ("file_error", "string")):
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast(kind))
    conformed = conform_listing(rows, keep=["file_name", "file_time", "file_error"])
    if checkpoint:
        conformed = cut_lineage(conformed)
    conformed = with_file_times(conformed, files)
    broken = F.col("file_error").isNotNull()
    new = new_listings(conformed.filter(numeric_id_ok() & ~broken), known).unionByName(conformed.filter(broken))
    new = new.withColumn("null_bad", violates_not_null() | broken).drop("file_error")
    if checkpoint:
        new = cut_lineage(new)
    # per-file flags (one row per file, from the checkpointed new rows); the
    # quarantine comes from them, not from the file list, so a file the listing
    # missed still has its bad rows caught
    flags = file_flags(new, file_time_col="file_time")
    stats = ingest_outcome(conformed, new, files, flags=flags)
    if unreadable:
        outcome = F.when(F.col("file_name").isin(unreadable), F.lit("ERROR")).otherwise(F.col("outcome"))
        stats = stats.withColumn("outcome", outcome)
    bad_files = flags.filter(F.col("n_bad") > 0).select("file_name")
    good = file_quarantine(new.drop("null_bad"), bad_files)
    to_append = first_file_wins(good, "file_time", "file_name").select(*LISTING_COLUMNS, "file_name")
    if checkpoint:
        to_append = cut_lineage(to_append)  # appended, and counted per file
    return to_append, with_loaded_counts(stats, to_append)


def with_file_times(rows: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """One load time per file: the listing's earliest time for the file, else the
    earliest time among its rows (a multi-part file has one time, not one per
    part; a file the listing missed keeps its own)."""
    own = rows.groupBy("file_name").agg(F.min("file_time").alias("_own"))
    if files is not None and "file_time" in files.columns:
        listed = files.groupBy("file_name").agg(F.min("file_time").alias("_listed"))
        own = own.join(listed, "file_name", "left").select(
            "file_name", F.coalesce("_listed", "_own").alias("_own"))
    return rows.join(own, "file_name", "left").withColumn("file_time", F.col("_own")).drop("_own")


def with_loaded_counts(stats: DataFrame, to_append: DataFrame) -> DataFrame:
    """Add ``n_loaded`` (rows each file actually contributes after first-file-wins);
    a good file whose new rows all went to an earlier file is NO_NEW, as it would
    be when files load one at a time."""
    loaded = to_append.groupBy("file_name").agg(F.count(F.lit(1)).alias("n_loaded"))
    n_loaded = F.coalesce(F.col("n_loaded"), F.lit(0).cast("bigint"))
    return (stats.join(loaded, "file_name", "left")
            .select("file_name", "n_rows", "n_new", "n_bad", n_loaded.alias("n_loaded"),
                    F.when((F.col("outcome") == "LOADED") & (n_loaded == 0), F.lit("NO_NEW"))
                    .otherwise(F.col("outcome")).alias("outcome")))


# A batch that names more sites than this probes the whole store instead of their partitions.
MAX_SITES = 64


def known_keys_or_empty(spark: SparkSession, store: str, sources=None, buckets=None) -> DataFrame:
    try:
        return read_known_keys(spark, store, sources, buckets=buckets)
    except AnalysisException as e:
        if not not_found(e):
            raise
        return spark.createDataFrame([], "listing_id string, source string")  # no store yet


def readable_rows(spark: SparkSession, paths: list[str]) -> tuple[DataFrame, list[str]]:
    """The rows of the listing files ``paths``, stored, and the paths that cannot be read.

    One read for all; only if a file breaks it are the paths halved, down to the
    files that are broken.
    """
    try:
        return cut_lineage(read_listings_csv(spark, [literal_path(p) for p in paths])), []
    except READ_ERRORS as e:
        if "FAILED_READ_FILE" not in str(e):
            raise
        if len(paths) == 1:
            return read_listings_csv(spark, f"{paths[0]}/none/*.csv", empty_if_no_match=True), paths
    half = len(paths) // 2
    (one, bad_one), (two, bad_two) = readable_rows(spark, paths[:half]), readable_rows(spark, paths[half:])
    return one.unionByName(two), bad_one + bad_two


def write_outcomes(outcomes: DataFrame, path: str, batch_id) -> None:
    """The batch's outcome rows, replacing its own ``load_batch=<id>`` folder."""
    outcomes.write.mode("overwrite").parquet(batch_dir(path, batch_id))


def touched_partitions(spark: SparkSession, rows: DataFrame, store: str) -> tuple[list | None, list | None]:
    """The sites and key buckets of the batch (None: too many sites to name, or a store without buckets)."""
    buckets = store_buckets(spark, store)
    bucket = bucket_of(F.col("listing_id"), buckets) if buckets else F.lit(None).cast("int")
    # at most sites x buckets rows, both bounded
    found = rows.select("source", bucket.alias("bucket")).distinct().limit((MAX_SITES + 1) * (buckets or 1)).collect()
    sites = {r["source"] for r in found if r["source"] is not None}
    hit = {r["bucket"] for r in found}
    many = len(sites) > MAX_SITES
    return None if many else sorted(sites), None if many or not buckets or len(hit) == buckets else sorted(hit)


def finish_batch(spark: SparkSession, store: str, batch_id, outcomes_path: str | None) -> None:
    """Copy the outcomes kept with a stored batch to ``outcomes_path`` (again, if a run ended before it)."""
    outcomes = batch_outcomes(spark, store, batch_id) if outcomes_path else None
    if outcomes is not None:
        write_outcomes(outcomes, outcomes_path, batch_id)


def load_batch(spark: SparkSession, rows: DataFrame, store: str, batch_id, outcomes_path: str | None = None,
               files: DataFrame | None = None, identity: str | None = None, unreadable: list[str] | None = None) -> None:
    """Plan and write one batch: its rows go to ``load_batch=<batch_id>``.

    An id that the store holds already is an error; with the same ``identity`` it is
    the same batch again, which stays as it is. The store is probed in the
    partitions (site, key bucket) of the batch's keys only. The outcomes are published with the
    rows, so a run that ends before they reach ``outcomes_path`` is finished from the store.
    """
    if not holds_batch(spark, store, batch_id, identity):
        sites, buckets = touched_partitions(spark, rows, store)
        known = known_keys_or_empty(spark, store, sites, buckets)
        to_append, outcomes = plan_batch(rows, known, files, unreadable=unreadable)
        append_listings(to_append.drop("file_name"), store, batch_id, identity, outcomes)
    finish_batch(spark, store, batch_id, outcomes_path)


def folder_identity(spark: SparkSession, folder: str) -> str:
    """What a bulk batch is made from: the files (path, time, length) the folder holds now."""
    one = F.xxhash64("path", "time", "length").cast("decimal(38,0)")
    r = list_parts(spark, folder).agg(F.count("*").alias("n"), F.coalesce(F.sum(one), F.lit(0)).cast("string").alias("value")).first()
    return f"{r['n']}:{r['value']}"


def load_folder(spark: SparkSession, folder: str, store: str, batch_id, outcomes_path: str | None = None) -> None:
    """Bulk load of every listing file in ``folder`` (header-only files reported as EMPTY).

    A batch id is used once: with the same files it is done, with others, or where the store holds it without
    knowing its files, it is an error and nothing is written.
    """
    identity = folder_identity(spark, folder)
    if holds_batch(spark, store, batch_id, identity):
        finish_batch(spark, store, batch_id, outcomes_path)
        return
    files = list_listing_files(spark, folder).select("file_name", "file_time")
    unreadable: list[str] = []
    try:
        rows = cut_lineage(read_listings_csv(spark, top_level_csv(folder), empty_if_no_match=True))
    except READ_ERRORS as e:
        if "FAILED_READ_FILE" not in str(e):
            raise
        rows, bad = readable_rows(spark, listing_paths(spark, folder))
        unreadable = [p.rstrip("/").rsplit("/", 1)[-1].removeprefix("file_name=") for p in bad]
    load_batch(spark, rows, store, batch_id, outcomes_path, files, identity, unreadable)
