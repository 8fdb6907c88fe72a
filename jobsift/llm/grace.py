"""Exact deduplication by Grace hash partitioning.

1. Each task passes its rows through an open-addressing table of bounded size
   that compares complete texts. It writes one record per row (row number,
   id, the number of its text's entry) and one per entry (hash, text, count,
   best row): a group of copies leaves a task as one text, however many rows.
2. The entries are partitioned by bits of their hash into buckets (files of
   Spark's shuffle), as many as the bytes of the entries ask for.
3. Each bucket passes through the same table. Entries of texts that no longer
   fit are spilled to files in the shared folder and partitioned again by
   other bits of the hash, until every bucket fits.
4. The groups found go back to the rows through the entry numbers: each entry
   has rows of one task only, so no key of this join is hot.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, stored

#: Bytes of distinct texts that one table holds.
TABLE_BYTES = 48 << 20
#: Bytes of entries that a bucket is planned for.
BUCKET_BYTES = 24 << 20
_MEMBER = "row_no long, id long, entry long, sha256 binary, text binary, n long, best_id long, best_row long"


class OpenTable:
    """Open addressing with linear probing; a slot matches if the complete contents are equal."""

    def __init__(self, max_bytes: int):
        self.max_bytes, self.bytes = max_bytes, 0
        self.slots = np.full(1024, -1, dtype=np.int64)
        self.hashes: list[int] = []
        self.texts: list[bytes] = []

    def find(self, h: int, text: bytes) -> int:
        """The number of the text's entry; a new one if it fits, else -1."""
        mask = len(self.slots) - 1
        at = h & mask
        while (e := self.slots[at]) >= 0:
            if self.hashes[e] == h and self.texts[e] == text:
                return int(e)
            at = (at + 1) & mask
        if self.texts and self.bytes + len(text) > self.max_bytes:
            return -1
        self.slots[at] = e = len(self.texts)
        self.hashes.append(h)
        self.texts.append(text)
        self.bytes += len(text) + 64
        if 2 * len(self.texts) > len(self.slots):
            self._grow()
        return int(e)

    def _grow(self) -> None:
        self.slots = np.full(2 * len(self.slots), -1, dtype=np.int64)
        mask = len(self.slots) - 1
        for e, h in enumerate(self.hashes):
            at = h & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = e


def _better(a: tuple, b: tuple) -> tuple:
    """The larger (id, row number); null ids come before all others, equal ids fall to the smaller row number."""
    return max(a, b, key=lambda x: (x[0] is not None, x[0] if x[0] is not None else 0, -x[1]))


def _gather(table_bytes: int):
    """Rows (id, normalised text) to member records and entry records."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 40
        row, entry = base, base
        table, shas, counts, best = OpenTable(table_bytes), [], [], []

        def flush() -> Iterator[pa.RecordBatch]:
            for lo in range(0, len(shas), 2000):
                hi = min(lo + 2000, len(shas))
                none = pa.nulls(hi - lo, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [none, none, pa.array(range(entry + lo, entry + hi), pa.int64()), pa.array(shas[lo:hi], pa.binary()),
                     pa.array(table.texts[lo:hi], pa.binary()), pa.array(counts[lo:hi], pa.int64()),
                     pa.array([b[0] for b in best[lo:hi]], pa.int64()), pa.array([b[1] for b in best[lo:hi]], pa.int64())],
                    names=names)

        names = [f.split()[0] for f in _MEMBER.split(", ")]
        for batch in batches:
            ids, entries, digests, first = batch.column(0).to_pylist(), [], [], row
            for i, text in zip(ids, batch.column(1).cast(pa.binary()), strict=True):
                text = text.as_py()
                sha = hashlib.sha256(text).digest()
                e = table.find(int.from_bytes(sha[:8], "big"), text)
                if e < 0:  # full: what it holds is written, a new one begins
                    yield from flush_members(names, first, ids, entries, digests)
                    ids, first, entries, digests = ids[len(entries):], row, [], []
                    yield from flush()
                    entry += len(shas)
                    table, shas, counts, best = OpenTable(table_bytes), [], [], []
                    e = table.find(int.from_bytes(sha[:8], "big"), text)
                if e == len(shas):
                    shas.append(sha)
                    counts.append(0)
                    best.append((i, row))
                counts[e] += 1
                best[e] = _better(best[e], (i, row))
                entries.append(entry + e)
                digests.append(sha)
                row += 1
            yield from flush_members(names, first, ids, entries, digests)
        yield from flush()

    return run


def flush_members(names: list[str], first: int, ids: list, entries: list[int], digests: list[bytes]) -> Iterator[pa.RecordBatch]:
    n = len(entries)
    if n:
        none = pa.nulls(n, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(first, first + n), pa.int64()), pa.array(ids[:n], pa.int64()), pa.array(entries, pa.int64()),
             pa.array(digests, pa.binary()), pa.nulls(n, pa.binary()), none, none, none], names=names)


def _match(table_bytes: int):
    """One bucket's entries to their groups; what does not fit comes back with its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, counts, best = OpenTable(table_bytes), [], []
        entries: list[int] = []
        slots: list[int] = []
        names = ["entry", "sha256", "text", "n", "best_id", "best_row", "fits"]
        for batch in batches:
            spilled = []
            cols = [batch.column(k) for k in range(6)]
            for k, (entry, sha, n, i, r) in enumerate(zip(*(cols[c].to_pylist() for c in (0, 1, 3, 4, 5)), strict=True)):
                e = table.find(int.from_bytes(sha[:8], "big"), cols[2][k].as_py())
                if e < 0:
                    spilled.append(k)
                    continue
                if e == len(counts):
                    counts.append(0)
                    best.append((i, r))
                counts[e] += n
                best[e] = _better(best[e], (i, r))
                entries.append(entry)
                slots.append(e)
            if spilled:
                out = batch.take(pa.array(spilled))
                yield pa.RecordBatch.from_arrays([*out.columns, pa.array([False] * len(spilled))], names=names)
        for lo in range(0, len(entries), 10000):
            part = slots[lo:lo + 10000]
            none = pa.nulls(len(part), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(entries[lo:lo + 10000], pa.int64()), none, none, pa.array([counts[e] for e in part], pa.int64()),
                 pa.array([best[e][0] for e in part], pa.int64()), pa.array([best[e][1] for e in part], pa.int64()),
                 pa.array([True] * len(part))], names=names)

    return run


def grace_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", table_bytes: int = TABLE_BYTES,
                 bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; null counts as
    empty. The row with the largest id stays (null ids lose to all others); if
    that id is repeated within the group, one of its rows stays, so ``kept`` is
    true for exactly one row of each group. Other columns are not read; an
    empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), ascii_lower(F.col(text_col).cast("string")).alias("text"))
    members = stored(rows.mapInArrow(_gather(table_bytes), _MEMBER), "grace-entries")
    entries = members.where(F.col("row_no").isNull()).select("entry", "sha256", "text", "n", "best_id", "best_row")
    todo, level, groups = entries, 0, None
    left = entries.agg(F.sum(F.length("text")), F.count("*")).first()
    while left[1]:
        buckets = max(1, ceil(int(left[0] or 0) / bucket_bytes))
        # each level deals by its own salt of the hash, so a bucket too large falls apart at the next one
        dealt = todo.repartition(buckets, F.xxhash64("sha256", F.lit(level)))
        done = stored(dealt.mapInArrow(_match(table_bytes), "entry long, sha256 binary, text binary, n long, best_id long, "
                                       "best_row long, fits boolean"), f"grace-level{level}")
        found = done.where("fits").select("entry", F.col("n").alias("group_size"), F.col("best_id").alias("keep_id"),
                                          F.col("best_row").alias("keep_row"))
        groups = found if groups is None else groups.unionAll(found)
        todo, level = done.where("NOT fits").drop("fits"), level + 1
        left = todo.agg(F.sum(F.length("text")), F.count("*")).first()
    if groups is None:
        groups = spark.createDataFrame([], "entry long, group_size long, keep_id long, keep_row long")
    return (members.where(F.col("row_no").isNotNull()).select("row_no", "id", "entry", "sha256").join(groups, "entry")
            .select("id", "keep_id", "group_size", (F.col("row_no") == F.col("keep_row")).alias("kept"),
                    F.lower(F.hex("sha256")).alias("text_sha256")))


def exact_groups_of(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of all documents."""
    return grace_groups(docs).withColumnRenamed("id", "doc_id")


def kept_documents(docs: DataFrame) -> DataFrame:
    """One document of each group of equal texts, columns unchanged.

    A row is known by its id and content; of rows that repeat both, one stays.
    """
    cols = docs.columns
    kept = grace_groups(docs).where("kept").select(F.col("id").alias("_id"), F.col("text_sha256").alias("_sha"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("_row"), F.col("doc_id").cast("long").alias("_doc"),
                       F.sha2(ascii_lower(F.col("text").cast("string")).cast("binary"), 256).alias("_hash"))
    one = Window.partitionBy("_doc", "_hash").orderBy(F.xxhash64("_row"))
    return (rows.join(kept, F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_sha")), "left_semi")
            .withColumn("_n", F.row_number().over(one)).where("_n = 1").select("_row.*"))
