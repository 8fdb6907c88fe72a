"""Hot-key probe: one key holds a third of the rows.

Runs the grouped operators and both anti-join paths on such data with an event
log in a fresh scratch folder, then prints per stage the largest shuffle read
of one task next to the stage total.

Usage: python tools/skew_probe.py [rows]
"""

from __future__ import annotations

import glob
import io
import json
import sys
import tempfile
import time

sys.path.insert(0, ".")

import zstandard  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from jobsift.operators import dedupe as D  # noqa: E402
from jobsift.operators import quality as Q  # noqa: E402
from jobsift.session import build_session  # noqa: E402


def main():
    n = int(sys.argv[1]) if len(sys.argv) > 1 else 900_000
    ev = tempfile.mkdtemp(prefix="jobsift-events-")
    spark = build_session("local[8]", shuffle_partitions=16,
                          extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": ev})
    hot = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
    base = spark.range(n).select(
        hot.alias("listing_id"), F.lit("LinkedIn").alias("source"), F.lit("r").alias("run_time"),
        F.col("id").cast("int").alias("seq"), F.concat(F.lit("t"), F.col("id").cast("string")).alias("title"),
        F.concat(F.lit("f"), (F.col("id") % 50).cast("string"), F.lit(".csv")).alias("file_name"),
        F.col("id").cast("timestamp").alias("file_time"))
    known = spark.range(n).select(F.col("id").cast("string").alias("listing_id"), F.lit("LinkedIn").alias("source"))
    runs = [
        ("latest_per_listing", D.latest_per_listing(base.select("listing_id", "source", "run_time", "seq", "title"))),
        ("first_file_wins", D.first_file_wins(base.select("listing_id", "source", "title", "file_name", "file_time"),
                                              "file_time")),
        ("primary_key_check", Q.primary_key_check(base)),
        ("new_listings (shuffle path)", D.new_listings(base, known, broadcast_key_limit=10)),
        ("new_listings (broadcast path)", D.new_listings(base, known)),
    ]
    for label, df in runs:
        t0 = time.time()
        spark.sparkContext.setJobDescription(label)
        rows = df.count()
        print(f"{label}: {rows} rows in {time.time() - t0:.2f}s")
    spark.stop()
    for f in glob.glob(ev + "/*/events*"):
        raw = open(f, "rb").read()
        text = (zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read().decode()
                if f.endswith(".zstd") else raw.decode())
        per_stage: dict[int, list[int]] = {}
        for line in text.splitlines():
            e = json.loads(line)
            if e.get("Event") == "SparkListenerTaskEnd":
                m = e.get("Task Metrics") or {}
                per_stage.setdefault(e["Stage ID"], []).append(
                    (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0))
        for sid in sorted(per_stage):
            v = per_stage[sid]
            if sum(v) > 0:
                print(f"stage {sid}: {len(v)} tasks, largest task read {max(v)} of {sum(v)} shuffled records")


if __name__ == "__main__":
    main()
