"""Mixing sources to target weights by iterative proportional fitting.

Token counts per (source, language, topic) are raked until their marginals
over source, language and topic are the targets of a sample. What is raked are
the cells' inclusion probabilities, never above 1: the tokens of the sample
have the target marginals in expectation, and no document is taken twice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import lower_bytes, stored, text_chunks, word_hashes

DIMENSIONS = ("source", "lang", "topic")
TOPICS = 8
#: Hashed word counts that stand for a text when topics are told.
FEATURES = 256
#: Distinct texts that the first centres are chosen from, and the cosine from which two are too near to be both taken.
STARTS, NEAR = 256, 0.95
#: Rounds of k-means at most; fewer where the mean cosine gains less than GAIN of itself.
TOPIC_ROUNDS, GAIN = 20, 1e-4
#: Targets are present shares to this power, scaled to 1: smaller ones gain, larger ones lose.
TEMPERATURE = 0.7
#: Share of all tokens that the sample takes, if the targets leave that much of every source, language and topic.
RATE = 0.5
#: Largest gap between a marginal and its target, as a share of all tokens.
TOLERANCE = 1e-3
#: Sweeps from one stored table to the next; a round that leaves more than this share of the gap stands still.
SWEEPS, STILL = 4, 0.98


def _counts(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per run of texts: hashed word counts and numbers of words."""
    for lo, hi, raw, offs in text_chunks(column):
        words, first = word_hashes(lower_bytes(raw), offs)
        counts = np.diff(first)
        at = np.repeat(np.arange(hi - lo), counts) * FEATURES + (words >> np.uint64(56)).astype(np.int64)
        yield np.bincount(at, minlength=(hi - lo) * FEATURES).reshape(hi - lo, FEATURES), counts


def _scaled(counts: np.ndarray) -> np.ndarray:
    """Word counts, damped and scaled to length 1."""
    x = np.log1p(counts)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def _features(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per run of texts: hashed word counts, damped and scaled to length 1, and numbers of words."""
    for x, counts in _counts(column):
        yield _scaled(x), counts


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (text) to the word counts, as bytes, of those with words."""
    for batch in batches:
        for x, n in _counts(batch.column(0)):
            yield pa.RecordBatch.from_arrays([pa.array([v.tobytes() for v in x[n > 0].astype(np.uint32)], pa.binary())], names=["v"])


def _unpacked(vectors: list[bytes]) -> np.ndarray:
    return _scaled(np.frombuffer(b"".join(vectors), dtype=np.uint32).reshape(-1, FEATURES))


def _starts(candidates: np.ndarray, topics: int) -> np.ndarray:
    """The first of the candidates that are not near one another, then the others."""
    taken: list[int] = []
    for k, x in enumerate(candidates):
        if len(taken) < topics and (not taken or (candidates[taken] @ x).max() < NEAR):
            taken.append(k)
    rest = [k for k in range(len(candidates)) if k not in set(taken)]
    return candidates[taken + rest[:max(0, topics - len(taken))]]


def _sums(centres: np.ndarray):
    """Rows (v) to the sums, in whole steps of 2**-20, of those nearest each centre, by place; place FEATURES has their cosines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(centres), FEATURES + 1), dtype=np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, 2000):
                x = _unpacked(batch.column(0).slice(lo, 2000).to_pylist())
                cosine = x @ centres.T
                near = cosine.argmax(axis=1)
                steps = np.rint(np.hstack([x, cosine.max(axis=1, keepdims=True)]) * (1 << 20)).astype(np.int64)
                for k in range(len(centres)):
                    total[k] += steps[near == k].sum(axis=0)
        topic, place = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(topic.astype(np.int32)), pa.array(place.astype(np.int32)), pa.array(total[topic, place])],
                                         names=["topic", "place", "s"])

    return run


def topic_centres(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", topics: int = TOPICS) -> np.ndarray:
    """Centres of spherical k-means over all documents with words.

    Each round is a Spark job that sums up the vectors nearest each centre, in
    whole numbers, so that the order of the rows does not matter. The first
    centres are distinct texts, by their hashes, so that copies are one.
    """
    rows = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    vectors = stored(rows.mapInArrow(_vectors, "v binary"), "topic-vectors")
    hashed = vectors.select("v", F.xxhash64("v").alias("h"))
    first = [r.h for r in hashed.select("h").distinct().orderBy("h").limit(STARTS).collect()]
    if not first:
        return np.zeros((1, FEATURES))
    found = hashed.where(F.col("h").isin(first)).groupBy("h").agg(F.min("v").alias("v")).orderBy("h").collect()
    centres = _starts(_unpacked([bytes(r.v) for r in found]), topics)
    before = 0.0
    for _ in range(TOPIC_ROUNDS):
        sums = vectors.mapInArrow(_sums(centres), "topic int, place int, s long").groupBy("topic", "place").agg(F.sum("s").alias("s")).collect()
        total = np.zeros((len(centres), FEATURES + 1))
        for r in sums:
            total[r.topic, r.place] = r.s
        moved = np.where(total.any(axis=1, keepdims=True), total, np.hstack([centres, np.zeros((len(centres), 1))]))[:, :FEATURES]
        centres = moved / np.maximum(np.linalg.norm(moved, axis=1, keepdims=True), 1e-12)
        gained, before = total[:, FEATURES].sum() - before, total[:, FEATURES].sum()
        if gained < GAIN * before:
            break
    return centres


def with_topics(rows: DataFrame, centres: np.ndarray, text_col: str) -> DataFrame:
    """``rows`` with n_tokens (words) and topic (the nearest centre) in place of the text."""
    keep = [c for c in rows.columns if c != text_col]
    shared = rows.sparkSession.sparkContext.broadcast(centres)
    rows = rows.select(*keep, F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias(text_col))
    fields = [*rows.schema.fields[:-1], T.StructField("n_tokens", T.LongType()), T.StructField("topic", T.IntegerType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told = [((x @ shared.value.T).argmax(axis=1), n) for x, n in _features(batch.column(len(keep)))]
            topic = np.concatenate([t for t, _ in told]) if told else np.zeros(0)
            count = np.concatenate([n for _, n in told]) if told else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(count.astype(np.int64)), pa.array(topic.astype(np.int32))],
                                             names=[*keep, "n_tokens", "topic"])

    return rows.mapInArrow(run, T.StructType(fields))


def unit_hash(key: Column, seed: str) -> Column:
    """A number from 0 to 1 that hangs on the key and the seed alone."""
    return F.shiftrightunsigned(F.xxhash64(key, F.lit(seed)), 11) / F.lit(float(1 << 53))


def rake(cells: DataFrame, targets: dict[str, DataFrame], rate: float = RATE, dims: tuple[str, ...] = DIMENSIONS) -> DataFrame:
    """Cells (dims, mass) with the ``probability`` by which their mass meets the targets.

    Targets are shares per value of a dimension. The sample has ``rate`` of all
    tokens, or less where a target asks for more of a value than there is. Each
    sweep scales the cells to one marginal after the other; a cell is never
    scaled above 1, the others of its marginal then take over. It ends when
    every marginal is met within TOLERANCE, or when two rounds running stand
    still: targets that contradict each other, as on cells that do not occur,
    cannot be met. ``gap`` is the largest gap that is left. Cells and targets are Spark tables; each round reads
    the stored table of the round before. Cells without mass keep the rate.
    """
    total = float(cells.agg(F.sum("mass")).first()[0] or 0.0) or 1.0
    for d in dims:
        share = F.sum("mass").over(Window.partitionBy(d)) / F.lit(total)
        cells = (cells.join(targets[d].withColumnRenamed("target", f"t_{d}"), d)
                 .withColumn(f"room_{d}", F.when(F.col(f"t_{d}") > 0, share / F.col(f"t_{d}")).otherwise(1.0)))
    cells = stored(cells, "rake-0")
    room = cells.agg(F.min(F.least(*[F.col(f"room_{d}") for d in dims]))).first()[0]
    rate = min(rate, 1.0 if room is None else room)
    cells = cells.withColumn("probability", F.lit(rate))

    def now(d: str) -> Column:
        return F.sum(F.col("mass") * F.col("probability")).over(Window.partitionBy(d)) / F.lit(total)

    k, still, least = 0, 0, float("inf")
    while True:
        k += 1
        for d in dims * SWEEPS:
            scaled = F.least(F.lit(1.0), F.col("probability") * F.col(f"t_{d}") * F.lit(rate) / F.col("now"))
            cells = cells.withColumn("now", now(d)).withColumn(
                "probability", F.when(F.col("now") > 0, scaled).otherwise(F.col("probability"))).drop("now")
        gap = F.greatest(*[F.abs(F.col(f"n_{d}") - F.col(f"t_{d}") * F.lit(rate)) for d in dims])
        cells = stored(cells.withColumns({f"n_{d}": now(d) for d in dims}).withColumn("gap", gap)
                       .drop(*[f"n_{d}" for d in dims]), f"rake-{k}")
        left = cells.agg(F.max("gap")).first()[0] or 0.0
        still = 0 if left < STILL * least else still + 1
        least = min(least, left)
        if left < TOLERANCE or still == 2:
            break
        cells = cells.drop("gap")
    return cells.select(*dims, "mass", "probability", (F.col("probability") / F.lit(rate)).alias("weight"), F.lit(left).alias("gap"))


def tempered(cells: DataFrame, d: str, temperature: float = TEMPERATURE, rate: float = RATE) -> DataFrame:
    """Target shares of one dimension: the present ones to a power, scaled to sum 1.

    No value is asked for more than a sample of ``rate`` can take of it.
    """
    sums = cells.groupBy(d).agg(F.sum("mass").alias("mass"))
    whole, powers = sums.agg(F.sum("mass"), F.sum(F.pow("mass", F.lit(temperature)))).first()
    if not whole:
        return sums.select(d, F.lit(0.0).alias("target"))
    asked = sums.select(d, F.least(F.pow("mass", F.lit(temperature)) / F.lit(powers), F.col("mass") / F.lit(whole * rate)).alias("p"))
    return asked.select(d, (F.col("p") / F.lit(asked.agg(F.sum("p")).first()[0])).alias("target"))


def weighted(facts: DataFrame, targets: dict[str, DataFrame] | None = None, rate: float = RATE) -> DataFrame:
    """Facts (dims, n_tokens, ...) with ``weight`` and ``probability`` of their cells."""
    cells = stored(facts.groupBy(*DIMENSIONS).agg(F.sum("n_tokens").cast("double").alias("mass")), "cells")
    return facts.join(rake(cells, targets or {d: tempered(cells, d) for d in DIMENSIONS}, rate).drop("mass", "gap"), list(DIMENSIONS))


def _facts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       *[F.coalesce(F.col(d).cast("string"), F.lit("")).alias(d) for d in DIMENSIONS[:2]], F.col("text").alias("text"))


def mixture_of(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """One row per document: doc_id, source, lang, topic, n_tokens, weight, probability, kept.

    Null sources and languages count as ''; null texts as empty (no tokens, but
    the weight of their cell); a null id is kept with the probability of its
    hash like any other, so rows that repeat an id are kept or left together.
    An empty table gives an empty result.
    """
    facts = stored(with_topics(_facts(docs), topic_centres(docs), "text"), "facts")
    return (weighted(facts).withColumn("kept", unit_hash(F.col("doc_id"), seed) < F.col("probability"))
            .select("doc_id", "source", "lang", "topic", "n_tokens", "weight", "probability", "kept"))


def mixed_documents(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """The sample itself: documents kept with their cells' probabilities, columns unchanged."""
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        *[F.coalesce(F.col(d).cast("string"), F.lit("")).alias(d) for d in DIMENSIONS[:2]], F.col("text").alias("text"))
    facts = with_topics(rows, topic_centres(docs), "text")
    return (weighted(facts).where(unit_hash(F.col("row.doc_id").cast("long"), seed) < F.col("probability")).select("row.*"))
