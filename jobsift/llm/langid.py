"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNDETERMINED = "und"
#: Hash buckets of n-grams: the broadcast matrix has BUCKETS x languages numbers.
BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
#: The matrix is broadcast only up to this many languages (256 MB); more is an error, not a cut.
MAX_LANGUAGES = 2048
_CHARS = 1 << 20
_MULTIPLIERS = [np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35)]
_ALPHA: list[np.ndarray] = []


def _alpha() -> np.ndarray:
    if not _ALPHA:
        _ALPHA.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000))
    return _ALPHA[0]


def _codes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased letters of the texts, each run of other characters as one blank.

    Every text begins and ends with a blank. Returns the code points, the
    texts' offsets and their numbers of letters.
    """
    parts = [f" {t.lower() if t else ''} ".encode("utf-32-le", "replace") for t in texts]
    lengths = np.fromiter((len(p) // 4 for p in parts), dtype=np.int64, count=len(parts))
    codes = np.frombuffer(b"".join(parts), dtype=np.uint32).copy()
    letter = _alpha()[codes]
    ends = np.cumsum(lengths)
    starts = ends - lengths
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[starts] = True
    letters = np.add.reduceat(letter.astype(np.int64), starts) if len(starts) else np.zeros(0, np.int64)
    kept = np.concatenate([[0], np.cumsum(keep)])
    codes[~letter] = 32
    return codes[keep], np.concatenate([kept[starts], kept[-1:]]), letters


def _grams(codes: np.ndarray, offs: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order, the hashed n-gram at every position and the texts' offsets among them."""
    for n in ORDERS:
        h = np.zeros(max(0, len(codes) - n + 1), dtype=np.uint32)
        for i in range(n):
            h = (h ^ codes[i:i + len(h)]) * _MULTIPLIERS[i]
            h ^= h >> np.uint32(15)
        h = (h * np.uint32(0x27D4EB2F)) >> np.uint32(17)
        yield h, offs


def _runs(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    lo, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t) if t else 0
        if size >= _CHARS:
            yield lo, i + 1
            lo, size = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per language of a partition, how often each bucket occurs."""
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = np.array(batch.column(0).to_pylist(), dtype=object)
        texts = batch.column(1).to_pylist()
        for lo, hi in _runs(texts):
            for lang in dict.fromkeys(langs[lo:hi]):
                codes, offs, _ = _codes([t for t, g in zip(texts[lo:hi], langs[lo:hi], strict=True) if g == lang])
                total = counts.setdefault(lang, np.zeros(BUCKETS, dtype=np.int64))
                for grams, _ in _grams(codes, offs):
                    total += np.bincount(grams, minlength=BUCKETS)
    for lang, total in counts.items():
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)),
                                          pa.array(total[at])], names=["lang", "bucket", "n"])


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """Count n-grams of all labelled rows; languages in order and the log-probability matrix.

    Rows with null text or language are left out. Counting is a pass over the
    partitions, summed per (language, bucket) with map-side combine; only the
    BUCKETS x languages sums reach the driver. The prior is uniform, the
    smoothing add-half.
    """
    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).dropna()
    sums = rows.mapInArrow(_count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    sums = sums.groupBy("lang").agg(F.collect_list("bucket").alias("bucket"), F.collect_list("n").alias("n"))
    found = sums.limit(MAX_LANGUAGES + 1).toArrow().to_pylist()
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages: the matrix would be too large to broadcast")
    found.sort(key=lambda r: r["lang"])
    counts = np.full((BUCKETS, len(found)), 0.5)
    for j, r in enumerate(found):
        counts[r["bucket"], j] += r["n"]
    return [r["lang"] for r in found], np.log(counts / counts.sum(axis=0)).astype(np.float32)


def _score(langs: list[str], matrix: np.ndarray, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    names: list[str] = []
    scores = np.zeros(len(texts))
    for lo, hi in _runs(texts):
        codes, offs, letters = _codes(texts[lo:hi])
        total = np.zeros((hi - lo, len(langs)))
        for grams, at in _grams(codes, offs):
            for j in range(len(langs)):
                sums = np.concatenate([[0.0], np.cumsum(matrix[:, j][grams], dtype=np.float64)])
                # n-grams that begin in a text; the last ones are the blank before the next text
                total[:, j] += sums[np.minimum(at[1:] - 1, len(grams))] - sums[np.minimum(at[:-1], len(grams))]
        if langs:
            total -= total.max(axis=1, keepdims=True)
            odds = np.exp(total)
            best = total.argmax(axis=1)
            known = letters > 0
            scores[lo:hi] = np.where(known, 1.0 / odds.sum(axis=1), 0.0)
            names += [langs[b] if k else UNDETERMINED for b, k in zip(best, known, strict=True)]
        else:
            names += [UNDETERMINED] * (hi - lo)
    return names, scores


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray], text_col: str = "text") -> DataFrame:
    """Every row with ``lang_pred`` and ``score`` (the posterior of that language) added.

    Null texts, texts without a letter, and every text when nothing was
    learned, get ``und`` and 0.0. Ties go to the language first in alphabetical
    order. Whole texts are scored; a column of docs with one of the two new names is replaced.
    """
    docs = docs.drop("lang_pred", "score")
    langs = model[0]
    shared = docs.sparkSession.sparkContext.broadcast(model[1])
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = _score(langs, shared.value, batch.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(scores)],
                                             names=[*batch.schema.names, "lang_pred", "score"])

    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *added]))


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(folds).cast("long"))


def language_of(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of all documents; fold 2 of 4 is not learned from.

    Repeated rows give repeated results. An empty table gives an empty result.
    """
    held = fold(F.col("doc_id"), 4) == 2
    model = train(docs.where(~held))
    rows = docs.select("doc_id", held.alias("held_out"), F.col("text").alias("text"))
    return identify(rows, model).select("doc_id", "held_out", "lang_pred", "score")


def accepted(docs: DataFrame, min_score: float = 0.5) -> DataFrame:
    """The documents whose language is told with at least ``min_score``, columns unchanged.

    Rejected are texts that are null or have no letter, and those whose best
    language is less likely than all others together. Without any labelled row
    nothing can be rejected for its score; texts with a letter then stay.
    """
    cols = docs.columns
    model = train(docs.where(fold(F.col("doc_id"), 4) != 2))
    if not model[0]:
        return docs.where(F.coalesce(F.regexp_like(F.col("text"), F.lit(r"\p{L}")), F.lit(False)))
    probe = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("row"), F.col("text").alias("text"))
    return (identify(probe, model).where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= min_score))
            .select("row.*"))
