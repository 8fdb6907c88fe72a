"""Text quality: naive Bayes support vectors over n-gram indicators.

Indicators (presence, not counts) of byte n-grams, word n-grams and n-grams of word shapes are hashed
to BUCKETS columns. As Spark jobs:

0. One row stands for every distinct labelled text: ids and text hashes meet the labels first, the texts
   are moved once, for the chosen ids.
1. Documents per class and bucket, counted over all distinct labelled texts (partial counts per task,
   summed by bucket), give the class log-count ratios that scale the indicators.
2. Labelled texts are dealt by a hash of the text to shards of about SHARD_DOCS texts and SHARD_BYTES
   bytes. In each shard a linear hinge-loss model is fitted by dual coordinate descent over all of its
   texts; the shards' models are averaged by their numbers of texts. No labelled row is left out and no
   task sees more than a shard.
3. One text in CALIBRATION is kept from the fit. The margins of these turn a logistic curve
   (slope and offset), fitted on a histogram, so that scores are probabilities.
4. Every text is scored whole against the broadcast weights (BUCKETS numbers).
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import STEP, mix, span_hashes, stored, text_chunks, word_spans
from .langid import fold

BITS = 18
#: Columns of the model; the ratios and the weights are broadcast as this many float64 numbers (2 MB each).
BUCKETS = 1 << BITS
BYTE_ORDERS = (1, 2, 3, 4)
#: Size of a shard of the fit: so many texts, or so many bytes of text, whichever asks for more shards.
SHARD_DOCS, SHARD_BYTES = 4096, 32 << 20
#: One labelled text in so many is kept for the calibration.
CALIBRATION = 5
#: Bound of a dual variable (per class, balanced), passes at most, and the stopping gap of projected gradients.
COST, EPOCHS, GAP = 1.0, 60, 0.05
#: Bits of the map of ids that are learned from (1 MB broadcast, whatever the input; a wrong hit costs a row's shuffle).
MAP_BITS = 23
#: Margins are counted in bins of this width, up to this many on either side of zero.
_BIN, _BINS = 0.02, 2000
_SHIFT = np.uint64(64 - BITS)


class Model(NamedTuple):
    """Weights per bucket (log-count ratio times hinge weight), bias, slope and offset of the logistic curve."""

    weights: np.ndarray
    bias: float
    slope: float
    offset: float


def _shape_classes() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[48:58] = 48
    table[65:91] = 65
    table[97:123] = 97
    table[128:] = 97
    return table


_SHAPES = _shape_classes()


def _gram_hashes(raw: np.ndarray, offs: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per kind of n-gram: the bucket at every place of the concatenated texts and each text's [first, end) in it."""
    for n in BYTE_ORDERS:
        if len(raw) >= n:
            h = np.zeros(len(raw) - n + 1, dtype=np.uint32)
            for i in range(n):
                h = (h << np.uint32(8)) | raw[i:i + len(h)]
            yield _bucket(h.astype(np.uint64), n), np.stack([offs[:-1], np.maximum(offs[:-1], offs[1:] - n + 1)])
    starts, ends, first = word_spans(raw, offs)
    if not len(starts):
        return
    words = span_hashes(raw, starts, ends)
    # shape of a word: its runs of character classes; a word that repeats the one before it is marked
    classes = _SHAPES[raw]
    keep = np.ones(len(raw), dtype=bool)
    keep[1:] = classes[1:] != classes[:-1]
    keep[starts] = True
    kept = np.concatenate([[0], np.cumsum(keep)])
    shapes = span_hashes(classes[keep], kept[starts], kept[ends])
    again = np.zeros(len(words), dtype=bool)
    again[1:] = words[1:] == words[:-1]
    again[first[:-1][first[:-1] < len(words)]] = False
    shapes = np.where(again, mix(shapes), shapes)
    for kind, (units, orders) in enumerate(((words, (1, 2)), (shapes, (1, 2, 3)))):
        for n in orders:
            if len(units) >= n:
                h = np.zeros(len(units) - n + 1, dtype=np.uint64)
                for i in range(n):
                    h += units[i:i + len(h)] * STEP[i]
                yield _bucket(h, 8 * (kind + 1) + n), np.stack([first[:-1], np.maximum(first[:-1], first[1:] - n + 1)])


def _bucket(h: np.ndarray, kind: int) -> np.ndarray:
    return (mix(h + STEP[kind]) >> _SHIFT).astype(np.int64)


def indicators(column: pa.Array) -> Iterator[np.ndarray]:
    """Per text the sorted distinct buckets of its n-grams; none for null and empty texts."""
    seen = np.zeros(BUCKETS, dtype=bool)
    for lo, hi, raw, offs in text_chunks(column):
        grams = list(_gram_hashes(raw, offs))
        for k in range(hi - lo):
            for h, spans in grams:
                seen[h[spans[0, k]:spans[1, k]]] = True
            found = np.flatnonzero(seen)
            seen[found] = False
            yield found


def dual_descent(rows: list[np.ndarray], values: np.ndarray, labels: np.ndarray, cost: float = COST,
                 epochs: int = EPOCHS, gap: float = GAP, seed: int = 7) -> tuple[np.ndarray, float]:
    """Linear hinge-loss model by dual coordinate descent: weights per column and the bias.

    ``rows`` holds each example's columns, ``values`` a column's value wherever it is present; examples
    are scaled to length 1 with a constant 1 beside them. ``labels`` are +1 and -1; the cost is balanced
    between the classes. Dual variables stay within 0 and their class's cost.
    """
    w, bias = np.zeros(len(values)), 0.0
    n = len(rows)
    if not n:
        return w, bias
    scale = np.array([1.0 / math.sqrt(s) if (s := float((values[r] ** 2).sum())) > 0 else 0.0 for r in rows])
    square = np.where(scale > 0, 2.0, 1.0)
    of_class = {s: max(1, int((labels == s).sum())) for s in (1, -1)}
    bound = np.where(labels > 0, cost * n / (2 * of_class[1]), cost * n / (2 * of_class[-1]))
    alpha = np.zeros(n)
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        worst = 0.0
        for i in rng.permutation(n):
            r, y = rows[i], labels[i]
            x = values[r]
            g = y * (scale[i] * float(w[r] @ x) + bias) - 1.0
            a = alpha[i]
            projected = min(g, 0.0) if a <= 0 else max(g, 0.0) if a >= bound[i] else g
            if projected:
                worst = max(worst, abs(projected))
                alpha[i] = min(max(a - g / square[i], 0.0), bound[i])
                step = (alpha[i] - a) * y
                w[r] += (step * scale[i]) * x
                bias += step
        if worst < gap:
            break
    return w, bias


def _margins(rows: Iterator[np.ndarray], ratios: np.ndarray, weights: np.ndarray, bias: float) -> Iterator[float]:
    for r in rows:
        x = ratios[r]
        norm = math.sqrt(float(x @ x))
        yield (float(weights[r] @ x) / norm if norm > 0 else 0.0) + bias


def _id_map(marks: DataFrame) -> np.ndarray:
    """A bit per id of the rows (by hash, MAP_BITS of them): one row per 32,768 bits reaches the driver."""
    at = marks.select((F.pmod(F.crc32(F.col("id").cast("string")), F.lit(1 << MAP_BITS)) + 1).alias("b"))
    rows = (at.groupBy(F.bitmap_bucket_number("b").alias("slice")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("b")).alias("bits"))
            .toArrow().to_pylist())
    out = np.zeros(1 << (MAP_BITS - 3), dtype=np.uint8)
    for r in rows:
        out[(r["slice"] - 1) * 4096:][:len(r["bits"])] = np.frombuffer(r["bits"], dtype=np.uint8)
    return out


def _first_of_map(chosen) -> Callable:
    """Rows whose id is on the map, each (id, text) once per task: a repeated row is not sent on again."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = chosen.value
        seen: set[tuple] = set()
        for batch in batches:
            ids = batch.column(0).to_pylist()
            at = np.fromiter((zlib.crc32(str(i).encode()) for i in ids), dtype=np.int64, count=len(ids)) & ((1 << MAP_BITS) - 1)
            keep = []
            for k in np.flatnonzero((bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1):
                digest = (ids[k], hashlib.blake2b(batch.column(1)[k].as_buffer(), digest_size=16).digest())
                if digest not in seen:
                    seen.add(digest)
                    keep.append(k)
            if keep:
                yield batch.take(pa.array(keep))

    return run


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals = np.zeros((2, BUCKETS), dtype=np.int64)
    for batch in batches:
        labels = batch.column(0).to_numpy(zero_copy_only=False)
        for y, r in zip(labels, indicators(batch.column(1)), strict=True):
            totals[int(y), r] += 1
    at = np.flatnonzero(totals.any(axis=0))
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(totals[0, at]), pa.array(totals[1, at])],
                                     names=["bucket", "n0", "n1"])


def _shard_fit(ratios):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = ratios.value
        shard, rows, labels, keys = None, [], [], []

        def fitted() -> pa.RecordBatch:
            order = np.argsort(np.array(keys, dtype=np.int64), kind="stable")
            w, bias = dual_descent([rows[i] for i in order], values, np.array(labels)[order])
            at = np.flatnonzero(w)
            at, w = np.append(at, BUCKETS), np.append(w[at], bias) * len(rows)
            return pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(w)], names=["bucket", "w"])

        for batch in batches:
            shards, ys, hs = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            for s, y, h, r in zip(shards, ys, hs, indicators(batch.column(3)), strict=True):
                if shard is not None and s != shard:
                    yield fitted()
                    rows, labels, keys = [], [], []
                shard = s
                rows.append(r.astype(np.int32))
                labels.append(1 if y else -1)
                keys.append(h)
        if rows:
            yield fitted()

    return run


def _histogram(ratios, weights, bias):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, 2 * _BINS + 1), dtype=np.int64)
        for batch in batches:
            labels = batch.column(0).to_numpy(zero_copy_only=False)
            for y, m in zip(labels, _margins(indicators(batch.column(1)), ratios.value, weights.value, bias), strict=True):
                counts[int(y), min(max(round(m / _BIN), -_BINS), _BINS) + _BINS] += 1
        for y in (0, 1):
            at = np.flatnonzero(counts[y])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), y, np.int32)), pa.array((at - _BINS).astype(np.int32)),
                                              pa.array(counts[y, at])], names=["y", "bin", "n"])

    return run


def logistic_curve(margins: np.ndarray, positive: np.ndarray, negative: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve through counts of both classes at ``margins`` (damped Newton steps).

    Targets are drawn in by one count a class, so separated classes have a finite slope.
    """
    n1, n0 = positive.sum(), negative.sum()
    t1, t0 = (n1 + 1) / (n1 + 2), 1 / (n0 + 2)
    total = positive + negative
    wanted = positive * t1 + negative * t0
    a, b = 0.0, math.log((n1 + 1) / (n0 + 1))

    def loss(a: float, b: float) -> float:
        z = a * margins + b
        return float((total * np.logaddexp(0, z) - wanted * z).sum())

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -500, 500)))
        d, q = total * p - wanted, total * p * (1 - p) + 1e-12
        g = np.array([(d * margins).sum(), d.sum()])
        h = np.array([[(q * margins ** 2).sum() + 1e-9, (q * margins).sum()], [(q * margins).sum(), q.sum() + 1e-9]])
        step = np.linalg.solve(h, g)
        size, now = 1.0, loss(a, b)
        while size > 1e-6 and loss(a - size * step[0], b - size * step[1]) > now:
            size /= 2
        a, b = a - size * step[0], b - size * step[1]
        if np.abs(size * step).max() < 1e-8:
            break
    return float(a), float(b)


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality") -> Model:
    """Fit on every labelled text of ``docs`` (joined on doc_id; all must be allowed for learning).

    A label is positive from 0.5 up; null labels, labels without a document and null texts are left out. A
    text counts once per label, however many rows repeat it. With one class only, or none, every
    text gets that class's smoothed share as its score.
    """
    marked = labels.select(F.col("doc_id").alias("id"), (F.col(label_col).cast("double") >= 0.5).cast("int").alias("y")).dropna()
    texts = docs.select(F.col("doc_id").alias("id"), F.col("text").cast("string").alias("text")).dropna()
    # one id stands for a text and label; the texts themselves move once, and only those of such ids
    marks = texts.select("id", F.xxhash64("text").alias("h")).join(marked.hint("merge"), "id").groupBy("y", "h").agg(F.min("id").alias("id"))
    marks = stored(marks, "nbsvm-marks")
    chosen = docs.sparkSession.sparkContext.broadcast(_id_map(marks))
    at = texts.schema["id"].dataType.simpleString()
    found = texts.mapInArrow(_first_of_map(chosen), f"id {at}, text string").withColumn("h", F.xxhash64("text"))
    rows = stored(found.join(marks.hint("merge"), ["id", "h"]).groupBy("id", "h", "y").agg(F.any_value("text").alias("text")), "nbsvm-rows")
    size = rows.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes"), F.sum("y").alias("n1")).first()
    n, n1 = size["n"], size["n1"] or 0
    if not n1 or n1 == n:
        return Model(np.zeros(BUCKETS), 0.0, 0.0, math.log((n1 + 1) / (n - n1 + 1)))

    found = (rows.select("y", "text").mapInArrow(_counts, "bucket int, n0 long, n1 long")
             .groupBy("bucket").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toArrow())
    of = np.ones((2, BUCKETS))
    at = found["bucket"].to_numpy()
    of[0, at] += found["n0"].to_numpy()
    of[1, at] += found["n1"].to_numpy()
    context = docs.sparkSession.sparkContext
    ratio = np.log(of[1] / of[1].sum()) - np.log(of[0] / of[0].sum())
    ratios = context.broadcast(ratio)

    held = F.pmod(F.shiftright("h", 3), F.lit(CALIBRATION)) == 0
    apart = rows.where(held).agg(F.count("*").alias("n"), F.sum("y").alias("n1")).first()
    split = bool(apart["n1"]) and apart["n1"] < apart["n"] and 0 < n1 - apart["n1"] < n - apart["n"]
    fit = rows.where(~held) if split else rows
    shards = max(1, -(-n // SHARD_DOCS), -(-size["bytes"] // SHARD_BYTES))
    dealt = (fit.select(F.pmod(F.xxhash64("h"), F.lit(shards)).alias("shard"), "y", "h", "text")
             .repartition(shards, "shard").sortWithinPartitions("shard"))
    found = (dealt.mapInArrow(_shard_fit(ratios), "bucket int, w double")
             .groupBy("bucket").agg(F.sum("w").alias("w")).toArrow())
    w = np.zeros(BUCKETS + 1)
    w[found["bucket"].to_numpy()] = found["w"].to_numpy()
    w /= n - apart["n"] if split else n
    weights = context.broadcast(w[:BUCKETS])
    bias = float(w[BUCKETS])

    bins = ((rows.where(held) if split else rows).select("y", "text")
            .mapInArrow(_histogram(ratios, weights, bias), "y int, bin int, n long")
            .groupBy("y", "bin").agg(F.sum("n").alias("n")).toArrow())
    where, counts = bins["bin"].to_numpy() * _BIN, bins["n"].to_numpy()
    positive = bins["y"].to_numpy() == 1
    slope, offset = logistic_curve(where, np.where(positive, counts, 0), np.where(positive, 0, counts))
    return Model(np.stack([ratio, w[:BUCKETS]]), bias, slope, offset)


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Every row with ``score`` (0 to 1, higher: the positive label likelier) added.

    A null text counts as empty, an empty one has no indicators and gets the score of the bias alone. Texts
    are scored whole, one of any length by itself. A column of ``docs`` named ``score`` is replaced.
    """
    docs = docs.drop("score")
    at = docs.columns.index(text_col)
    constant = model.weights.ndim == 1
    shared = docs.sparkSession.sparkContext.broadcast(model.weights)
    _, bias, slope, offset = model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if constant:
                margins = np.zeros(batch.num_rows)
            else:
                margins = np.fromiter(_margins(indicators(batch.column(at)), shared.value[0], shared.value[1], bias), dtype=float,
                                      count=batch.num_rows)
            scores = 1 / (1 + np.exp(-np.clip(slope * margins + offset, -500, 500)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], names=[*batch.schema.names, "score"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())]))


def quality_of(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted of all documents; fold 2 of 4 is not learned from.

    Repeated rows give repeated results, null ids are scored like any other, an empty table gives an
    empty result. Without labels every score is 0.5.
    """
    held = fold(F.col("doc_id"), 4) == 2
    model = train(docs.where(~held), labels)
    rows = docs.select("doc_id", held.alias("held_out"), F.col("text").cast("string").alias("text"))
    return score(rows, model).select("doc_id", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
