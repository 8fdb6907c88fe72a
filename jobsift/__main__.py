"""Command line: the runs a user of the original tool makes.

  python -m jobsift load DROP STORE --batch ID [--outcomes DIR]
  python -m jobsift ingest DROP STORE --checkpoint DIR --outcomes DIR [--one-file-at-a-time] [--archive DIR]
  python -m jobsift screen STORE [--junior] [--fix-list] [--out DIR]
  python -m jobsift report STORE {day,week,year,estimate} [--out DIR]
  python -m jobsift extract PAGES DROP --run-time "2024-07-01 04:00:00"
  python -m jobsift compact STORE [--small-bytes N] [--keep-hours H]
  python -m jobsift sql STORE "SELECT ... FROM job_listings ..." [--out DIR]

Reports are written to ``--out`` (parquet) or shown on the console.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import functions as F

from .functions.text import result_set_file_name
from .operators import cards, dedupe, screen, trends
from .plans.load import load_folder
from .plans.sql import register_store
from .session import build_session
from .sources import listing_csv, store
from .streaming.ingest import ingest_drop_folder


def _emit(df, out, show):
    if out:
        df.write.mode("overwrite").parquet(out)
    else:
        df.show(show, truncate=False)


def extract_to_drop(spark, pages_path: str, drop: str, run_time: str) -> None:
    """Result pages (parquet ``source, page_id, url, html``) of one run -> listing files.

    Each site's pages form one result set ``<source>_<run time>.csv``; within it
    the last card seen of a listing wins (D1). Pages of separate searches are
    extracted as separate runs (their own ``--run-time``), as each search wrote
    its own file."""
    pages = spark.read.parquet(pages_path)
    found = cards.extract_listing_cards(pages.select("source", "page_id", "url", "html"))
    ts = F.lit(dt.datetime.fromisoformat(run_time).isoformat(sep=" ")).cast("timestamp_ntz")
    # cards in the order seen: page, then position on the page
    rows = found.withColumn("time_when_scraped", ts).withColumn("run_time", ts).withColumn(
        "seq", F.struct("page_id", "card_no"))
    latest = dedupe.latest_per_listing(rows.drop("page_id", "card_no"))
    listing_csv.write_result_set_csv(
        latest.withColumn("file_name", result_set_file_name(F.col("source"), F.col("run_time")))
        .drop("run_time", "seq"), drop)


def main(argv=None, spark=None):
    ap = argparse.ArgumentParser(prog="jobsift")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("load")
    p.add_argument("drop"), p.add_argument("store"), p.add_argument("--batch", required=True)
    p.add_argument("--outcomes")
    p = sub.add_parser("ingest")
    p.add_argument("drop"), p.add_argument("store")
    p.add_argument("--checkpoint", required=True), p.add_argument("--outcomes", required=True)
    p.add_argument("--one-file-at-a-time", action="store_true"), p.add_argument("--archive")
    p = sub.add_parser("screen")
    p.add_argument("store"), p.add_argument("--junior", action="store_true")
    p.add_argument("--fix-list", action="store_true"), p.add_argument("--out"), p.add_argument("--show", type=int, default=50)
    p = sub.add_parser("report")
    p.add_argument("store"), p.add_argument("kind", choices=["day", "week", "year", "estimate"])
    p.add_argument("--out"), p.add_argument("--show", type=int, default=100)
    p = sub.add_parser("sql")
    p.add_argument("store"), p.add_argument("statement"), p.add_argument("--out")
    p.add_argument("--show", type=int, default=50)
    p = sub.add_parser("compact")
    p.add_argument("store"), p.add_argument("--small-bytes", type=int, default=1 << 30)
    p.add_argument("--keep-hours", type=float, default=24.0)
    p = sub.add_parser("extract")
    p.add_argument("pages"), p.add_argument("drop"), p.add_argument("--run-time", required=True)
    ap.add_argument("--input-bytes", type=int, help="data volume, to size splits and shuffle partitions")
    ap.add_argument("--cores", type=int, help="total executor cores of the cluster")
    a = ap.parse_args(argv)
    if a.input_bytes and not a.cores:
        ap.error("--input-bytes needs --cores (the cluster's total executor cores)")
    spark = spark or build_session(input_bytes=a.input_bytes, cores=a.cores)

    if a.cmd == "load":
        load_folder(spark, a.drop, a.store, a.batch, a.outcomes)
    elif a.cmd == "ingest":
        ingest_drop_folder(spark, a.drop, a.store, a.checkpoint, a.outcomes,
                           max_files_per_trigger=1 if a.one_file_at_a_time else None, archive_dir=a.archive)
    elif a.cmd == "screen":
        _emit(screen.screen_listings(store.read_listings(spark, a.store), a.fix_list, a.junior), a.out, a.show)
    elif a.cmd == "report":
        if a.kind == "estimate":
            df = trends.estimated_row_count(spark, store.live_paths(spark, a.store) or a.store)
        else:
            fn = {"day": trends.jobs_per_day, "week": trends.jobs_per_week, "year": trends.jobs_per_year}[a.kind]
            df = fn(store.read_listings(spark, a.store))
        _emit(df, a.out, a.show)
    elif a.cmd == "sql":
        register_store(spark, a.store)
        _emit(spark.sql(a.statement), a.out, a.show)
    elif a.cmd == "compact":
        print(store.compact_store(spark, a.store, a.small_bytes, a.keep_hours) or "nothing to compact")
    elif a.cmd == "extract":
        extract_to_drop(spark, a.pages, a.drop, a.run_time)


if __name__ == "__main__":
    main()
