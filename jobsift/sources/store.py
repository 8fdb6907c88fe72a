"""The stored listing table: parquet, partitioned by load batch, site and key bucket.

Layout: ``<store>/load_batch=<id>/source=<site>/bucket=<n>/part-*.parquet`` with
the batch's manifest beside it (``sources.batches``). The bucket is a hash of the
listing id modulo the store's number of buckets, so a load reads the keys of the
buckets it brings only. The store only grows: a load publishes its own folder,
and an id that is taken stays as it is. Batches written before there were buckets or
manifests are read as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import batches
from .batches import BatchExists, batch_dir  # noqa: F401
from ..schema import KEY, LISTING_COLUMNS, LISTING_SCHEMA
from ..operators.quality import conform_listing

#: Key buckets of a store, fixed when it is begun (``<store>/_layout.json``). A bucket of the keys of a site
#: should stay near a gigabyte: raise it for a store that will grow far.
BUCKETS = 16
_LAYOUT = "_layout.json"

# The store as read: the 8 columns, the batch a compacted row came with, and the
# partition columns, all typed explicitly (partition discovery would otherwise
# infer ``load_batch=0`` as a number and break comparisons with named batches).
_PLAIN_SCHEMA = T.StructType(
    [T.StructField(f.name, f.dataType, True) for f in LISTING_SCHEMA.fields]
    + [T.StructField("member", T.StringType(), True), T.StructField("load_batch", T.StringType(), True)])
STORE_SCHEMA = T.StructType([*_PLAIN_SCHEMA.fields, T.StructField("bucket", T.IntegerType(), True)])


def bucket_of(listing_id: Column, buckets: int) -> Column:
    """The bucket of a key."""
    return F.pmod(F.xxhash64(listing_id), F.lit(buckets)).cast("int")


def store_buckets(spark: SparkSession, store: str) -> int | None:
    """The store's number of buckets (None before its first batch, or where it has none)."""
    layout = batches.read_json(spark, f"{store.rstrip('/')}/{_LAYOUT}")
    return layout["buckets"] if layout else None


def _bucketed(f: batches.Folder) -> bool:
    return f.manifest is not None


def live_paths(spark: SparkSession, store: str) -> list[str]:
    """The folders the store consists of now."""
    return [f.path for f in batches.live(batches.folders(spark, store))]


def _read(spark: SparkSession, store: str, found: list[batches.Folder], whole: bool) -> DataFrame:
    """The 8 columns, load_batch and bucket of some batch folders of one layout (all of the store: ``whole``)."""
    bucketed = _bucketed(found[0])
    reader = spark.read.schema(STORE_SCHEMA if bucketed else _PLAIN_SCHEMA)
    df = reader.parquet(store) if whole else reader.option("basePath", store).parquet(*[f.path for f in found])
    batch = F.coalesce("member", "load_batch") if any(f.batch.startswith(batches.COMPACTED) for f in found) else F.col("load_batch")
    return df.select(*LISTING_COLUMNS, batch.alias("load_batch"), "bucket" if bucketed else F.lit(None).cast("int").alias("bucket"))


def read_store(spark: SparkSession, store: str, exclude_batch: str | None = None, buckets=None, sources=None) -> DataFrame:
    """The 8 columns and ``load_batch`` of the store.

    ``sources`` and ``buckets`` cut the scan to the partitions that can hold their keys; a batch
    without buckets is read for its sites. A store that is not there is an error.
    """
    store = store.rstrip("/")
    found = batches.folders(spark, store)
    now = batches.live(found)
    if not now:
        df = spark.read.schema(_PLAIN_SCHEMA).parquet(store).withColumn("bucket", F.lit(None).cast("int"))
        return df.select(*LISTING_COLUMNS, "load_batch")
    out = None
    for bucketed in (True, False):
        part = [f for f in now if _bucketed(f) == bucketed]
        if not part:
            continue
        df = _read(spark, store, part, whole=len(part) == len(found))
        if sources is not None:
            df = df.filter(F.col("source").isin(list(sources)))
        if buckets is not None and bucketed:
            df = df.filter(F.col("bucket").isin([int(b) for b in buckets]))
        out = df if out is None else out.unionByName(df)
    if exclude_batch is not None:
        out = out.filter(F.col("load_batch") != F.lit(str(exclude_batch)))
    return out.select(*LISTING_COLUMNS, "load_batch")


def read_known_keys(spark: SparkSession, store: str, sources=None, exclude_batch: str | None = None, buckets=None) -> DataFrame:
    """S3: the stored keys only: ``ReadSchema`` holds ``listing_id`` (``source``, ``bucket``
    and ``load_batch`` are partition columns); lists of sites and of buckets prune partitions."""
    return read_store(spark, store, exclude_batch, buckets, sources).select(*KEY)


def read_listings(spark: SparkSession, store: str) -> DataFrame:
    return read_store(spark, store).select(*LISTING_COLUMNS)


def _in_buckets(df: DataFrame, buckets: int) -> DataFrame:
    """One writer per site and bucket (large ones are split), whatever the partitions before."""
    return df.withColumn("bucket", bucket_of(F.col("listing_id"), buckets)).hint("rebalance", "source", "bucket")


def append_listings(df: DataFrame, store: str, batch_id, identity: str | None = None, outcomes: DataFrame | None = None,
                    buckets: int = BUCKETS) -> bool:
    """Add a batch of listings to the store (8 columns); whether it was added now.

    Rows once stored stay. The batch is published whole, with its manifest, by one rename. An id that the
    store holds is an error and nothing is written, unless both have the same ``identity`` (what the
    batch was made from): then it is the same batch again and stays as it is (False). ``outcomes``
    (per-file results) are kept inside the batch. ``buckets`` counts for a new store only.
    """
    spark, store = df.sparkSession, store.rstrip("/")
    if str(batch_id).startswith(batches.COMPACTED):
        raise ValueError(f"batch ids beginning with {batches.COMPACTED!r} are kept for compaction")
    batch_dir(store, batch_id)  # a plain name
    if holds_batch(spark, store, batch_id, identity):
        return False
    batches.write_json(spark, f"{store}/{_LAYOUT}", {"buckets": buckets})
    staged = batches.staging(store, batch_id)
    rows = _in_buckets(conform_listing(df), store_buckets(spark, store))
    rows.write.partitionBy("source", "bucket").parquet(staged)
    if outcomes is not None:
        outcomes.write.parquet(f"{staged}/_outcomes")
    batches.publish(spark, staged, store, batch_id, {"identity": identity})
    return True


def holds_batch(spark: SparkSession, store: str, batch_id, identity: str | None) -> bool:
    """Whether the store holds this very batch; an error if the id is taken by another one or by one without identity."""
    found = batches.find(spark, store, batch_id)
    if found is None:
        return False
    if identity is None or (found.manifest or {}).get("identity") != identity:
        raise BatchExists(store, batch_id)
    return True


def batch_outcomes(spark: SparkSession, store: str, batch_id) -> DataFrame | None:
    """The per-file outcomes kept with a batch, if any."""
    found = batches.find(spark, store, batch_id)
    if found is None or not batches.exists(spark, f"{found.path}/_outcomes"):
        return None
    df = spark.read.parquet(f"{found.path}/_outcomes")
    return df.filter(F.col("batch") == str(batch_id)).drop("batch") if "batch" in df.columns else df


def compact_store(spark: SparkSession, store: str, small_bytes: int = 1 << 30, keep_hours: float = 24.0) -> str | None:
    """Rewrite the batches of less than ``small_bytes`` each as one folder; its batch name (None if fewer than two).

    The new folder appears by one rename and stands for the old ones from then on: a run that is
    killed leaves either all old folders or the new one in force. Batch ids and identities stay known (a
    compacted batch is recognised when it is loaded again) and every row keeps its ``load_batch``. Rows are sorted by
    key within a bucket, so row groups can be skipped by key. Replaced folders are deleted by a later
    compaction, ``keep_hours`` after, for readers that began before. Of two compactions at once one fails.
    """
    store = store.rstrip("/")
    batches.remove_replaced(spark, store, keep_hours)
    found = batches.folders(spark, store)
    path_size = lambda p: batches._path(spark, p)[1].getContentSummary(batches._path(spark, p)[0]).getLength()
    chosen = [f for f in batches.live(found) if path_size(f.path) < small_bytes]
    if len(chosen) < 2:
        return None
    batches.write_json(spark, f"{store}/{_LAYOUT}", {"buckets": BUCKETS})
    name, members, kept, rows = batches.next_compacted(found), {}, None, None
    for f in chosen:
        manifest = f.manifest if f.batch.startswith(batches.COMPACTED) else batches.read_json(spark, f"{f.path}/{batches.MANIFEST}")
        members |= (manifest or {}).get("members") or {f.batch: (manifest or {}).get("identity")}
        if batches.exists(spark, f"{f.path}/_outcomes"):
            part = spark.read.parquet(f"{f.path}/_outcomes")
            part = part if "batch" in part.columns else part.withColumn("batch", F.lit(f.batch))
            kept = part if kept is None else kept.unionByName(part)
    for bucketed in (True, False):
        part = [f for f in chosen if _bucketed(f) == bucketed]
        if part:
            df = _read(spark, store, part, whole=False).drop("bucket")
            rows = df if rows is None else rows.unionByName(df)
    staged = batches.staging(store, name)
    out = _in_buckets(rows.withColumnRenamed("load_batch", "member"), store_buckets(spark, store))
    out.sortWithinPartitions("source", "bucket", "listing_id").write.partitionBy("source", "bucket").parquet(staged)
    if kept is not None:
        kept.write.parquet(f"{staged}/_outcomes")
    wrote = spark.read.schema(STORE_SCHEMA).parquet(staged).count()  # from the footers
    if wrote != rows.count():
        raise RuntimeError(f"compaction of {store} wrote {wrote} rows; nothing was replaced")
    batches.publish(spark, staged, store, name, {"members": members, "replaces": [f.batch for f in chosen]})
    return name


def read_known_keys_jdbc(spark: SparkSession, url: str, table: str, properties: dict, sources=None) -> DataFrame:
    """S3 over JDBC: the two key columns only. With ``sources``, one read partition
    per site (``WHERE source = '<site>'``), read in parallel; without, the whole
    table in one query."""
    if sources is None:
        return spark.read.jdbc(url=url, table=table, properties=properties).select(*KEY)
    sources = list(sources)
    if not sources:
        return spark.createDataFrame([], "listing_id string, source string")
    preds = ["source = '" + s.replace("'", "''") + "'" for s in sources]
    return spark.read.jdbc(url=url, table=table, predicates=preds, properties=properties).select(*KEY)


def append_listings_jdbc(df: DataFrame, url: str, table: str, properties: dict) -> None:
    """S4 over JDBC: append the 8 conformed columns (one insert stream per partition)."""
    conform_listing(df).write.jdbc(url=url, table=table, mode="append", properties=properties)
