"""The loader over the drop folder.

The work is what the folder lists and the read log does not: a physical file
is known by path, modification time and length, so a file that is corrected
and put back under its name, or that arrives with an old date, is read. The
waiting listing files are taken in load order (file time, then name), a
bounded number per step; each is read whole, all part files of a result set
Spark wrote included, and every one of them, a header-only or unreadable one
included, gets an outcome row.

A step's batch id is made from its files: ``load_batch=<tag>-<hash>`` (store,
outcomes and read log). The step's files are recorded before anything is stored.
Rows and outcomes are published together, so a step that was cut off is either
finished from the store (its outcomes and its read log are written, whatever files
have come since) or, if nothing was published, forgotten: its files wait again. The
read log is compacted to what the folder still holds. As a service the ingest is a Structured Streaming query whose
micro-batches are the schedule: each looks for waiting files.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import file_name_of_path
from ..operators.dedupe import load_order
from ..plans.load import finish_batch, load_batch, readable_rows
from ..session import cut_lineage
from ..sources import batches
from ..sources.batches import batch_dir
from ..sources.listing_csv import list_parts
from ..sources.store import holds_batch

#: Listing files of one step at most: the driver names that many paths to the reader.
FILES_PER_STEP = 10_000
#: Folders of the read log, each of one step, from which on it is compacted.
LOG_FOLDERS = 32
_PARTS = "path string, time timestamp, length bigint"


def stream_tag(checkpoint: str) -> str:
    """Names this ingest's store partitions: stable across restarts (same checkpoint),
    distinct from other ingests and from bulk loads writing the same store."""
    return "stream-" + hashlib.sha1(checkpoint.rstrip("/").encode()).hexdigest()[:10]


def read_log_path(outcomes_path: str) -> str:
    """Where the ingest records which physical files each step read."""
    return outcomes_path.rstrip("/") + "_files_read"


def steps_path(outcomes_path: str) -> str:
    """Where a step's files are recorded while it runs."""
    return outcomes_path.rstrip("/") + "_steps"


def read_log(spark: SparkSession, outcomes_path: str) -> DataFrame:
    """The physical files that have been read: path, time, length."""
    found = [f.path for f in batches.live(batches.folders(spark, read_log_path(outcomes_path)))]
    return spark.read.schema(_PARTS).parquet(*found) if found else spark.createDataFrame([], _PARTS)


def compact_read_log(spark: SparkSession, drop: str, outcomes_path: str, keep_hours: float = 24.0) -> None:
    """Rewrite the log of many steps as one folder, without files that have left the drop folder.

    Such a file can only come back as a new one (with its own time), so nothing is read twice; what a run
    reads of the log is bounded by the folder and LOG_FOLDERS steps, not by the history.
    """
    root = read_log_path(outcomes_path)
    batches.remove_replaced(spark, root, keep_hours)
    found = batches.folders(spark, root)
    now = batches.live(found)
    if len(now) < LOG_FOLDERS:
        return
    name = batches.next_compacted(found)
    staged = batches.staging(root, name)
    kept = read_log(spark, outcomes_path).join(list_parts(spark, drop), ["path", "time", "length"], "left_semi").distinct()
    kept.write.parquet(staged)
    batches.publish(spark, staged, root, name, {"replaces": [f.batch for f in now]})


def waiting_files(spark: SparkSession, drop: str, outcomes_path: str) -> DataFrame:
    """One row per listing file with a part that has not been read as it is now: lpath,
    file_name, file_time, parts (path, time, length)."""
    parts = list_parts(spark, drop)
    log = read_log(spark, outcomes_path)
    fresh = parts.join(log, ["path", "time", "length"], "left_anti").select("lpath").distinct()
    return (parts.join(fresh, "lpath", "left_semi").groupBy("lpath")
            .agg(F.min("time").alias("file_time"), F.sort_array(F.collect_list(F.struct("path", "time", "length"))).alias("parts"))
            .withColumn("file_name", file_name_of_path(F.col("parts")[0]["path"])))


def _move(spark: SparkSession, paths: list[str], folder: str) -> None:
    """Move files that have been read below ``folder``, each in its result set's folder; a corrected file replaces
    the one archived before."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        source = jvm.org.apache.hadoop.fs.Path(p)
        if not batches.exists(spark, p):
            continue  # moved by the run that this one finishes
        above = source.getParent()
        to = jvm.org.apache.hadoop.fs.Path(folder, above.getName() if above.getName().endswith(".csv") else ".")
        source.getFileSystem(conf).mkdirs(to)
        batches.rename(spark, p, jvm.org.apache.hadoop.fs.Path(to, source.getName()).toString(), replace=True)


def _finish_step(spark: SparkSession, batch: str, store: str, outcomes_path: str, archive_dir: str | None) -> None:
    """What follows once a step's batch is stored: its outcomes, its read log, the archive."""
    finish_batch(spark, store, batch, outcomes_path)
    record = batch_dir(steps_path(outcomes_path), batch)
    parts = spark.read.schema(_PARTS).parquet(record)
    parts.write.mode("overwrite").parquet(batch_dir(read_log_path(outcomes_path), batch))
    if archive_dir:
        _move(spark, [r["path"] for r in parts.select("path").collect()], archive_dir)  # at most a step's files
    batches.delete(spark, record)


def finish_steps(spark: SparkSession, store: str, outcomes_path: str, tag: str, archive_dir: str | None = None) -> None:
    """Finish the steps of this ingest that were cut off after their rows were published; forget the others."""
    for f in batches.folders(spark, steps_path(outcomes_path)):
        if not f.batch.startswith(tag + "-"):
            continue
        if holds_batch(spark, store, f.batch, f.batch):
            _finish_step(spark, f.batch, store, outcomes_path, archive_dir)
        else:
            batches.delete(spark, f.path)


def ingest_waiting(spark: SparkSession, drop: str, store: str, outcomes_path: str, tag: str,
                   files_per_step: int = FILES_PER_STEP, archive_dir: str | None = None) -> int:
    """Load all waiting files, ``files_per_step`` at a time in load order; how many there were."""
    finish_steps(spark, store, outcomes_path, tag, archive_dir)
    compact_read_log(spark, drop, outcomes_path)
    waiting = cut_lineage(waiting_files(spark, drop, outcomes_path).withColumn("at", load_order("file_time", "file_name")))
    done, last = 0, None
    while True:
        left = waiting if last is None else waiting.where(F.col("at") > last)
        step = left.orderBy("at").limit(files_per_step).drop("at").collect()  # metadata of at most files_per_step files
        if not step:
            return done
        newest = step[-1]
        last = F.struct(F.lit(newest["file_time"] is None), F.lit(newest["file_time"]).cast("timestamp"), F.lit(newest["file_name"]))
        parts = [(p["path"], p["time"], p["length"]) for f in step for p in f["parts"]]
        batch = f"{tag}-{hashlib.sha1(repr(sorted(parts)).encode()).hexdigest()[:16]}"
        listing = spark.createDataFrame([(f["file_name"], f["file_time"]) for f in step], "file_name string, file_time timestamp")
        rows, bad = readable_rows(spark, [f["lpath"] for f in step])
        names = {f["lpath"]: f["file_name"] for f in step}
        (spark.createDataFrame(parts, _PARTS).coalesce(1).write.mode("overwrite").parquet(batch_dir(steps_path(outcomes_path), batch)))
        load_batch(spark, rows, store, batch, None, files=listing, identity=batch, unreadable=[names[p] for p in bad])
        _finish_step(spark, batch, store, outcomes_path, archive_dir)
        done += len(step)


def ingest_drop_folder(spark: SparkSession, drop: str, store: str, checkpoint: str, outcomes_path: str,
                       max_files_per_trigger: int | None = None, available_now: bool = True,
                       processing_time: str = "4 hours", archive_dir: str | None = None):
    """Run the ingest; with ``available_now`` it loads what is there and returns None.

    Else it returns the running query: every ``processing_time`` a micro-batch
    of a clock stream (its rows are not used) loads what is waiting then.
    ``max_files_per_trigger=1`` loads one file at a time (a file sees the rows
    of every earlier file as stored); otherwise waiting files load in set-based
    steps, with the same result. ``checkpoint`` names the ingest. With
    ``archive_dir`` files that have been read are moved there.
    """
    tag, n = stream_tag(checkpoint), max_files_per_trigger or FILES_PER_STEP
    if available_now:
        ingest_waiting(spark, drop, store, outcomes_path, tag, n, archive_dir)
        return None
    clock = spark.readStream.format("rate").option("rowsPerSecond", 1).load()

    def tick(df: DataFrame, _: int) -> None:
        ingest_waiting(df.sparkSession, drop, store, outcomes_path, tag, n, archive_dir)

    return (clock.writeStream.foreachBatch(tick).option("checkpointLocation", checkpoint)
            .trigger(processingTime=processing_time).start())
