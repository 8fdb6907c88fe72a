"""Toxic spans by a linear-chain conditional random field.

Labels are per document; the tokens are labelled by them: a token of a toxic
document is toxic if one of its features (the word, or how it begins) stands
in far more toxic than clean training documents, by a likelihood-ratio test.
The CRF is trained on these tokens, two labels in a chain over segments of a
document. Forward-backward marginals then give every token of every document
its probability; their largest and their sum make the document's score through
a logistic fitted on the training documents, and runs of likely tokens are the
offending spans.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import lower_bytes, span_hashes, stored, text_chunks, word_spans
from .langid import fold

#: The bound of the training sample, per label and in bytes of text; texts are taken by their hashes.
TRAIN_DOCS = 1000
TRAIN_BYTES = 4 << 20
#: Feature weights are hashed to this many; the broadcast model is that large.
BUCKETS = 1 << 18
#: Bytes by which a word begins that are features beside the word itself.
BEGINNINGS = (4, 5, 6, 7, 8)
#: Tokens of one chain.
SEGMENT = 128
#: Share of chance among the features that mark toxic tokens, at most, and their least ratio of document rates.
FALSE_RATE, MIN_RATIO = 0.01, 8.0
_EPOCHS, _RATE, _L2 = 40, 0.3, 1e-4

_BREAK = np.ones(256, dtype=bool)
_BREAK[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


@dataclass
class Model:
    """Weights for a token to be toxic, transitions (from, to), and the logistic over document marginals."""

    weights: np.ndarray
    transitions: np.ndarray
    logistic: np.ndarray


def _lower(raw: np.ndarray) -> np.ndarray:
    """Lower-case A-Z and the capitals of Latin-1, whose UTF-8 forms differ from the small ones by one bit."""
    out = lower_bytes(raw)
    if len(out) > 1:
        after = np.zeros(len(out), dtype=bool)
        after[1:] = out[:-1] == 0xC3
        out = out + ((after & (out >= 0x80) & (out <= 0x9E) & (out != 0x97)).astype(np.uint8) << 5)
    return out


def _tokens(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends, first token per text, and 64-bit features (0: none) of the tokens."""
    raw = _lower(raw)
    starts, ends, first = word_spans(raw, offs, _BREAK)
    feats = np.zeros((len(starts), 1 + len(BEGINNINGS)), dtype=np.uint64)
    if len(starts):
        feats[:, 0] = span_hashes(raw, starts, ends)
        for k, n in enumerate(BEGINNINGS, 1):
            long = ends - starts > n
            feats[long, k] = span_hashes(raw, starts[long], starts[long] + n) + np.uint64(n)
    return starts, ends, first, feats


def _emissions(weights: np.ndarray, feats: np.ndarray) -> np.ndarray:
    at = (feats >> np.uint64(46)).astype(np.int64)
    return np.where(feats != 0, weights[at], 0.0).sum(axis=1) + weights[BUCKETS]


def _chains(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the segments that the texts' tokens are cut into."""
    pieces = -(-np.diff(first) // SEGMENT)
    text = np.repeat(np.arange(len(pieces)), pieces)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    starts = first[:-1][text] + nth * SEGMENT
    return starts, np.minimum(SEGMENT, first[1:][text] - starts)


def _forward_backward(score: np.ndarray, transitions: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
    """Marginals of label 1 per token and of the transitions, all chains side by side."""
    n, width = len(starts), int(lengths.max()) if len(lengths) else 0
    live = np.arange(width)[:, None] < lengths
    at = np.where(live, starts + np.arange(width)[:, None], 0)
    on = np.exp(np.clip(np.where(live, score[at] if len(score) else 0.0, 0.0), -30, 30))
    move = np.exp(transitions)
    forth = np.empty((width, n, 2))
    for t in range(width):
        if t:
            a = forth[t - 1] @ move
            a[:, 1] *= on[t]
        else:
            a = np.stack([np.ones(n), on[0]], axis=1)
        a /= a.sum(axis=1, keepdims=True)
        forth[t] = np.where(live[t][:, None], a, forth[t - 1] if t else a)
    back = np.ones((n, 2))
    marginal = np.zeros(len(score))
    pair = np.zeros((2, 2))
    for t in range(width - 1, -1, -1):
        m = forth[t] * back
        m /= m.sum(axis=1, keepdims=True)
        marginal[at[t][live[t]]] = m[live[t], 1]
        if t:
            b = back.copy()
            b[:, 1] *= on[t]
            joint = forth[t - 1][:, :, None] * move[None] * b[:, None, :]
            joint /= joint.sum(axis=(1, 2), keepdims=True)
            pair += joint[live[t]].sum(axis=0)
            back = np.where(live[t][:, None], b @ move.T, back)
            back /= back.sum(axis=1, keepdims=True)
    return marginal, pair


def _document_features(marginal: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per text: 1, log odds of its largest marginal, log of 1 + the sum of its marginals."""
    n = len(first) - 1
    out = np.zeros((n, 3))
    out[:, 0] = 1
    has = np.flatnonzero(np.diff(first))
    top, total = np.zeros(n), np.zeros(n)
    if len(has):
        top[has] = np.maximum.reduceat(marginal, first[has])
        total[has] = np.add.reduceat(marginal, first[has])
    top = np.clip(top, 1e-4, 1 - 1e-4)
    out[:, 1], out[:, 2] = np.log(top / (1 - top)), np.log1p(total)
    return out


def _logistic(x: np.ndarray, y: np.ndarray, prior: float) -> np.ndarray:
    """Newton steps on the penalised likelihood; the labels weigh as often as all labelled rows have them."""
    w = np.zeros(x.shape[1])
    weight = np.where(y == 1, prior / max(1, (y == 1).sum()), (1 - prior) / max(1, (y == 0).sum())) * len(y)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (y - p)) - w
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + np.eye(len(w))
        w += np.linalg.solve(hess, grad)
    return w


def _marking(evidence: np.ndarray, possible: np.ndarray, apart: np.ndarray) -> np.ndarray:
    """Features that mark toxic tokens: those ``apart`` whose evidence (nats) leaves FALSE_RATE of chance at most.

    Chance has a feature's evidence with a probability below exp(-evidence). The
    smallest of these count as long as the number expected among all features
    stays below FALSE_RATE of those taken (Benjamini and Hochberg). Features in
    so few documents that none could count even alone are not among them.
    """
    tried = int((possible >= -np.log(FALSE_RATE)).sum())
    found = np.sort(evidence[apart])[::-1]
    fits = np.flatnonzero(np.exp(-found) * tried <= FALSE_RATE * np.arange(1, len(found) + 1))
    return apart & (evidence >= found[fits[-1]]) if len(fits) else np.zeros(len(evidence), dtype=bool)


def fit(texts: list[str], toxic: list[int], prior: float = 0.5) -> Model:
    """Train on documents and their labels; ``prior`` is the share of toxic ones where the sample comes from."""
    y = np.array(toxic, dtype=np.int64)
    parts = [_tokens(raw, offs) for _, _, raw, offs in text_chunks(pa.array(texts, pa.string()))]
    feats = np.concatenate([p[3] for p in parts]) if parts else np.zeros((0, 1 + len(BEGINNINGS)), np.uint64)
    counts = np.concatenate([np.diff(p[2]) for p in parts]) if parts else np.zeros(0, np.int64)
    first = np.concatenate([[0], np.cumsum(counts)])
    doc = np.repeat(np.arange(len(y)), counts)
    # document rates of each feature
    names, inverse = np.unique(feats.ravel(), return_inverse=True)
    held = np.unique(inverse * np.int64(max(1, len(y))) + np.repeat(doc, feats.shape[1]))
    name, owner = held // max(1, len(y)), held % max(1, len(y))
    n1, n0 = max(1, (y == 1).sum()), max(1, (y == 0).sum())
    k1 = np.bincount(name, weights=y[owner] == 1, minlength=len(names))
    k0 = np.bincount(name, weights=y[owner] == 0, minlength=len(names))
    r1, r0 = (k1 + 0.5) / (n1 + 1), (k0 + 0.5) / (n0 + 1)
    share = n1 / (n1 + n0)
    k = np.maximum(k1 + k0, 1)
    evidence = (np.where(k1 > 0, k1 * np.log(np.maximum(k1, 1) / (k * share)), 0)
                + np.where(k0 > 0, k0 * np.log(np.maximum(k0, 1) / (k * (1 - share))), 0))
    known = names != 0
    marks = _marking(evidence, np.where(known, -k * np.log(share), 0), known & (r1 / r0 >= MIN_RATIO) & (evidence >= -np.log(FALSE_RATE)))
    label = (marks[inverse].reshape(feats.shape).any(axis=1) & (y[doc] == 1)).astype(np.float64)
    # gradient ascent on the conditional likelihood, all chains at once
    at = np.where(feats != 0, (feats >> np.uint64(46)).astype(np.int64), BUCKETS + 1).ravel()
    starts, lengths = _chains(first)
    ends_chain = np.zeros(len(label) + 1, dtype=bool)
    ends_chain[starts] = True
    linked = np.flatnonzero(~ends_chain[1:len(label)]) if len(label) else np.zeros(0, np.int64)
    seen = np.zeros((2, 2))
    np.add.at(seen, (label[linked].astype(int), label[linked + 1].astype(int)), 1)
    weights, transitions = np.zeros(BUCKETS + 2), np.zeros((2, 2))
    weights[BUCKETS] = -2.0
    steps = [[np.zeros_like(weights), np.zeros_like(weights)], [np.zeros((2, 2)), np.zeros((2, 2))]]
    for epoch in range(1, _EPOCHS + 1):
        if not label.any():
            break
        marginal, pair = _forward_backward(_emissions(weights, feats), transitions, starts, lengths)
        gap = label - marginal
        grad = np.bincount(at, weights=np.repeat(gap, feats.shape[1]), minlength=BUCKETS + 2)
        grad[BUCKETS] = gap.sum()
        grad[BUCKETS + 1] = 0
        for value, g, (m, v) in ((weights, grad - _L2 * len(label) * weights / BUCKETS, steps[0]), (transitions, seen - pair - transitions, steps[1])):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            value += _RATE * (m / (1 - 0.9 ** epoch)) / (np.sqrt(v / (1 - 0.99 ** epoch)) + 1e-8)
    marginal, _ = _forward_backward(_emissions(weights, feats), transitions, starts, lengths)
    return Model(weights.astype(np.float32), transitions, _logistic(_document_features(marginal, first), y, prior) if len(y) else np.array([-9.0, 0, 0]))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Fit on a bounded sample of the labelled documents.

    Per label, the TRAIN_DOCS texts with the smallest hashes; a text that is
    repeated counts once. Where these have more than TRAIN_BYTES, the longest
    are learned from by a stretch each, of one size, that begins anywhere. Null
    labels, and ids without a document, are left out. Of an id's or a text's
    differing labels the largest counts.
    """
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("toxic")).dropna().groupBy("_id").agg(F.max("toxic").alias("toxic"))
    rows = (docs.select(F.col(id_col).alias("_doc"), F.col(text_col).cast("string").alias("text")).where("text IS NOT NULL")
            .withColumn("h", F.xxhash64("text")))
    met = (rows.select("_doc", "h", F.octet_length("text").alias("bytes")).join(known, F.col("_doc") == F.col("_id"))
           .groupBy("h").agg(F.max("toxic").alias("toxic"), F.min("_id").alias("_id"), F.max("bytes").alias("bytes"), F.count("*").alias("rows")))
    met = stored(met, "toxic-labelled")
    ranked = [met.where(f"toxic = {y}").orderBy("h").limit(TRAIN_DOCS) for y in (1, 0)]
    # at most 2 * TRAIN_DOCS rows: small enough to hold, and to send to every task
    picked = ranked[0].unionAll(ranked[1]).select("h", "_id", "toxic", "bytes").collect()
    stretch = _stretch([r.bytes for r in picked])
    wanted = docs.sparkSession.createDataFrame([(r.h, r._id, r.toxic) for r in picked], T.StructType(
        [T.StructField("_h", T.LongType()), known.schema["_id"], T.StructField("toxic", T.IntegerType())]))
    size = F.length("text")
    # code points, as many as the share of the bytes that is taken
    take = F.when(F.octet_length("text") <= stretch, size).otherwise(F.floor(size * F.lit(float(stretch)) / F.octet_length("text"))).cast("int")
    start = F.pmod(F.xxhash64("h", F.lit("stretch")), size - take + 1).cast("int") + 1
    sample = (rows.join(F.broadcast(wanted), (F.col("_doc") == F.col("_id")) & (F.col("h") == F.col("_h")))
              .select("h", "toxic", F.substring("text", start, take).alias("text")).groupBy("h").agg(F.first("text"), F.first("toxic"))
              .orderBy("h").toArrow())
    prior = met.agg(F.sum(F.col("toxic") * F.col("rows")) / F.sum("rows")).first()[0]
    return fit(sample.column(1).to_pylist(), sample.column(2).to_pylist(), prior if prior is not None else 0.5)


def _stretch(sizes: list[int], limit: int = TRAIN_BYTES) -> int:
    """The largest bound that, put on each size, leaves ``limit`` together at most."""
    left, sizes = limit, sorted(sizes)
    for k, n in enumerate(sizes):
        if n * (len(sizes) - k) > left:
            return left // (len(sizes) - k)
        left -= n
    return max(sizes, default=0)


_SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("p", T.DoubleType())]))


def tag(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """``docs`` with ``score``, ``predicted`` and ``toxic_spans`` added (columns of these names are replaced).

    A span is a run of tokens with a marginal of ``threshold`` or more: code
    points, end exclusive, and its largest marginal. Null and empty texts have
    no tokens and no spans; their score is that of the smallest evidence. Whole
    texts are tagged, in chains of SEGMENT tokens.
    """
    docs = docs.drop("score", "predicted", "toxic_spans")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            scores, spans = [np.zeros(0)], []
            for _, _, raw, offs in text_chunks(batch.column(at)):
                starts, ends, first, feats = _tokens(raw, offs)
                marginal, _ = _forward_backward(_emissions(m.weights, feats), m.transitions, *_chains(first))
                scores.append(1 / (1 + np.exp(-np.clip(_document_features(marginal, first) @ m.logistic, -30, 30))))
                points = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
                base, mine = points[offs[:-1]], [[] for _ in range(len(offs) - 1)]
                hits = np.flatnonzero(marginal >= threshold)
                owner = np.searchsorted(first, hits, side="right") - 1
                last = -2
                for i, d in zip(hits.tolist(), owner.tolist(), strict=True):
                    end = int(points[ends[i]] - base[d])
                    if i == last + 1 and mine[d]:
                        mine[d][-1] |= {"end": end, "p": max(mine[d][-1]["p"], float(marginal[i]))}
                    else:
                        mine[d].append({"start": int(points[starts[i]] - base[d]), "end": end, "p": float(marginal[i])})
                    last = i
                spans += mine
            score = np.concatenate(scores)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(score), pa.array((score >= 0.5).astype(np.int32)), pa.array(spans, pa.list_(pa.struct(
                    [("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())])))],
                names=[*batch.schema.names, "score", "predicted", "toxic_spans"])

    added = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()), T.StructField("toxic_spans", _SPANS)]
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *added]))


def toxicity_of(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, toxic_spans of all documents; fold 0 of 5 is not learned from.

    Without labels all scores are near 0. Repeated rows give repeated results.
    """
    model = train(docs, labels.where(fold(F.col("doc_id"), 5) != 0))
    rows = docs.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), F.col("text").cast("string").alias("text"))
    return tag(rows, model).select("doc_id", "held_out", "score", "predicted", "toxic_spans")
