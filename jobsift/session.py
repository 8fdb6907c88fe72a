"""Session and shared-folder helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "jobsift", shuffle_partitions: int | None = None,
                  extra: dict | None = None, input_bytes: int | None = None, cores: int | None = None) -> SparkSession:
    """Session with the settings the operators are tuned for (AQE on, UI off).

    With ``input_bytes`` (and the cluster's ``cores``) the split and shuffle
    sizes come from ``scale_settings``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # page parsing ships whole HTML pages to Python: keep Arrow batches small
        "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
        # checkpoints of a finished batch are removed once nothing refers to them
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if input_bytes:
        if not cores:
            raise ValueError("input_bytes needs the cluster's total executor cores to size partitions")
        conf.update(scale_settings(input_bytes, cores))
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scale_settings(input_bytes: int, cores: int, partition_bytes: int = 128 << 20,
                   shuffle_fraction: float = 0.25, max_tasks_per_core: int = 25) -> dict:
    """Settings sized to the input.

    Scan splits of ``partition_bytes``. Shuffle partitions follow the bytes a
    shuffle carries (``shuffle_fraction`` of the input after projection, filters
    and partial aggregation), at least two per core and at most
    ``max_tasks_per_core`` per core, so the map-output bookkeeping stays
    bounded; AQE coalesces small ones and splits skewed ones.
    """
    wanted = int(input_bytes * shuffle_fraction) // partition_bytes
    parts = max(2 * cores, min(wanted, max_tasks_per_core * cores))
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
    }


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, from ``spark.checkpoint.dir``.

    Only when the session names none (a bare test session) is a folder of our
    own set as the checkpoint dir.
    """
    sc = spark.sparkContext
    base = sc.getCheckpointDir()
    if not base:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            base = tempfile.mkdtemp(prefix="jobsift-ckpt-")
        sc.setCheckpointDir(base)
        base = sc.getCheckpointDir() or base
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared folder."""
    return f"{shared_dir(spark)}/jobsift/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder (survives executor loss)."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
