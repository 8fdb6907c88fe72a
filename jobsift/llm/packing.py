"""Mixture-controlled packing by deficit round-robin over source queues.

Every source is a queue of its documents' tokens. The output stream is filled
window by window: in each window the queues take turns, and a queue may send
its quantum (target share x window) plus the deficit carried from the windows
before; the whole part of that is sent, the fraction is carried on. Documents
are cut where a quantum ends. What a queue has sent before a window is
therefore the whole part of its exact share, so the carry at *any* window is
known from the queues' totals alone: each partition starts its round-robin
with the carries at its own first window, and no pass runs over all windows
one by one. The stream is then cut into sequences of fixed length, and its
end into sequences of powers of two, which need no padding.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored
from .tokens import encoder

SEQUENCE = 2048
#: Tokens of a window, over which the mixture holds.
WINDOW = 32 * SEQUENCE
END_OF_TEXT = 1
#: Queues at most: beyond that many sources, sources share queues by hash (the totals are broadcast).
MAX_QUEUES = 4096


class RoundRobin:
    """How many tokens each queue has sent at each window, and where they stand in the stream."""

    def __init__(self, totals: dict[str, int], weights: dict[str, float] | None = None, window: int = WINDOW):
        self.names = sorted(q for q, n in totals.items() if n > 0)
        self.at = {q: k for k, q in enumerate(self.names)}
        self.totals = [totals[q] for q in self.names]
        self.total = sum(self.totals)
        self.window = window
        share = [Fraction(totals[q]) if weights is None else Fraction(weights.get(q, 0)).limit_denominator(10**6)
                 for q in self.names]
        if any(s <= 0 for s in share):
            raise ValueError("every queue with tokens needs a positive weight")
        # phases: all queues send at their shares until one runs empty; the others then share its part
        self.starts: list[Fraction] = []
        self.phases: list[list[tuple[Fraction, Fraction]]] = []
        sent, active, begin = [Fraction(0)] * len(share), set(range(len(share))), Fraction(0)
        while active:
            whole = sum(share[k] for k in active)
            self.starts.append(begin)
            self.phases.append([(sent[k], share[k] / whole if k in active else Fraction(0)) for k in range(len(share))])
            turn = min((self.totals[k] - sent[k]) / share[k] for k in active)
            begin += turn * whole
            for k in active:
                sent[k] += share[k] * turn
            active = {k for k in active if sent[k] < self.totals[k]}
        self.cache: dict[int, list[int]] = {}

    def sent(self, w: int) -> list[int]:
        """Tokens each queue has sent before window ``w``: the whole part of its share, the rest is its deficit."""
        if w not in self.cache:
            if len(self.cache) > 64:
                self.cache.clear()
            g = min(w * self.window, self.total)
            p = max(0, bisect_right(self.starts, g) - 1)
            if g == self.total:
                self.cache[w] = self.totals
            else:
                step = g - self.starts[p]
                self.cache[w] = [(x + s * step).__floor__() for x, s in self.phases[p]]
        return self.cache[w]

    def first_window(self, k: int, x: int) -> int:
        """The window in which queue ``k`` sends its token ``x``."""
        lo, hi = 0, -(-self.total // self.window)
        while hi - lo > 1:
            mid = (lo + hi) // 2
            lo, hi = (mid, hi) if self.sent(mid)[k] <= x else (lo, mid)
        return lo

    def turns(self, k: int, x: int, n: int, w: int) -> Iterator[tuple[int, int, int, int]]:
        """Tokens ``x`` to ``x + n`` of queue ``k`` from window ``w`` on: (window, token, count, place in the stream)."""
        end = x + n
        while x < end:
            before, after = self.sent(w), self.sent(w + 1)
            if after[k] <= x:
                w += 1
                continue
            take = min(end, after[k]) - x
            place = sum(before) + sum(after[:k]) - sum(before[:k]) + x - before[k]
            yield w, x, take, place
            x += take


def sequences(place: int, n: int, total: int, length: int = SEQUENCE) -> Iterator[tuple[int, int, int]]:
    """Cut a stretch of the stream into (sequence, offset, count)."""
    full = total // length
    while n:
        if place < full * length:
            seq, off, room = place // length, place % length, length - place % length
        else:
            off, seq, left = place - full * length, full, total - full * length
            size = 1 << (left.bit_length() - 1)
            while off >= size:
                off, left, seq = off - size, left - size, seq + 1
                size = 1 << (left.bit_length() - 1)
            room = size - off
        take = min(n, room)
        yield seq, off, take
        place, n = place + take, n - take


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        pid, sent = TaskContext.get().partitionId(), {}
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                sources = part.column(1).to_pylist()
                before, counts, ids = [], [], []
                for q, text in zip(sources, part.column(2).to_pylist(), strict=True):
                    t = np.append(enc.ids(text), np.uint32(END_OF_TEXT))
                    before.append(sent.get(q, 0))
                    counts.append(len(t))
                    sent[q] = before[-1] + len(t)
                    ids.append((t.astype("<u2") if t.max() < 1 << 16 else t.astype("<u4")).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([pid] * len(ids), pa.int32()), pa.array(before, pa.int64()),
                     pa.array(counts, pa.int64()), pa.array(ids, pa.binary())], names=["doc_id", "source", "pid", "before", "n", "ids"])

    return run


def token_table(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source") -> DataFrame:
    """Each row's token ids, the end token last, with its place among its partition's tokens of that source; stored."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return stored(rows.mapInArrow(_encode(vocabulary), "doc_id long, source string, pid int, before long, n long, ids binary"), "tokens")


_PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
           "source string, window_id long")


def pack(docs: DataFrame, vocabulary: str, weights: dict[str, float] | None = None, id_col: str = "doc_id", text_col: str = "text",
         source_col: str = "source", window: int = WINDOW, length: int = SEQUENCE, with_ids: bool = False) -> DataFrame:
    """Pack every row's tokens; one row per piece.

    ``weights`` are the target shares of the sources; without them, the shares
    they have in the corpus, so that all queues last to the end. With others, a
    queue that runs empty leaves its share to the rest. Null texts are empty
    (one end token); a null source is a queue named ''. Repeated rows are
    packed as often as they occur. An empty table gives no pieces. With
    ``with_ids`` each piece carries its ids.
    """
    spark = docs.sparkSession
    tokens = token_table(docs, vocabulary, id_col, text_col, source_col)
    parts = tokens.groupBy("source", "pid").agg(F.sum("n").alias("n"))
    sums = parts.groupBy("source").agg(F.sum("n").alias("n"))
    queue = F.col("source")
    if sums.count() > MAX_QUEUES:
        if weights is not None:
            raise ValueError(f"target shares need at most {MAX_QUEUES} sources")
        queue = F.format_string("%04d", F.pmod(F.xxhash64("source"), F.lit(MAX_QUEUES)))
        sums = sums.groupBy(queue.alias("source")).agg(F.sum("n").alias("n"))
    totals = {r["source"]: r["n"] for r in sums.toArrow().to_pylist()}  # at most MAX_QUEUES numbers
    order = Window.partitionBy("queue").orderBy("pid", "source").rowsBetween(Window.unboundedPreceding, -1)
    bases = (parts.withColumn("queue", queue)
             .select("source", "pid", "queue", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("base")))
    shared = spark.sparkContext.broadcast((totals, weights))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan, cursor = RoundRobin(*shared.value, window=window), {}
        for batch in batches:
            out: list[tuple] = []
            names = batch.schema.names
            rows = zip(*(batch.column(names.index(c)).to_pylist() for c in ("doc_id", "source", "queue", "base", "before", "n", "ids")), strict=True)
            for doc, source, q, base, before, n, raw in rows:
                ids = np.frombuffer(raw, dtype="<u2" if len(raw) == 2 * n else "<u4").astype("<u4")
                k, x0 = plan.at[q], base + before
                w, x = cursor.get(k, (None, 0))
                w = w if w is not None and x <= x0 else plan.first_window(k, x0)
                for w, x, take, place in plan.turns(k, x0, n, w):
                    start = x - x0
                    for seq, off, count in sequences(place, take, plan.total, length):
                        piece = ids[start:start + count].tobytes()
                        out.append((doc, start, count, zlib.crc32(piece), n, seq, off, source, w) + ((piece,) if with_ids else ()))
                        start += count
                    cursor[k] = (w, x)
                if len(out) >= 20000:
                    yield to_batch(out)
                    out = []
            if out:
                yield to_batch(out)

    schema = _PIECES + (", ids binary" if with_ids else "")
    names = [f.split()[0] for f in schema.split(", ")]
    types = [{"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[f.split()[1]] for f in schema.split(", ")]

    def to_batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    return tokens.join(bases, ["source", "pid"]).select("doc_id", "source", "queue", "base", "before", "n", "ids").mapInArrow(cut, schema)


def packed_documents(docs: DataFrame) -> DataFrame:
    """All documents packed into sequences of 2048 tokens of the 50k byte-level vocabulary."""
    import public_tokenizers

    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
