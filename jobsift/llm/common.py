"""Helpers shared by the corpus operators: shared-folder tables and vectorised words of text batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: Bytes of text that one vectorised step handles at a time (a longer text is one step of its own).
CHUNK_BYTES = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: list[np.ndarray] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the cluster's shared folder and read it back.

    Cuts the lineage: later jobs start from the files and outlive executors.
    """
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*frames: DataFrame) -> None:
    """Delete tables of ``stored`` that nothing reads any more."""
    for df in frames:
        spark = df.sparkSession
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if "/jobsift/llm-" not in path:
                raise ValueError(f"{path} is no stored table")
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, nothing else; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def strings(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column, null as empty, and the offsets of its rows."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = column.buffers()
    offs = np.frombuffer(off, dtype=np.int64)[column.offset:column.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0]:offs[-1]], offs - offs[0]


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows of a string column in runs of about ``limit`` bytes: (first, end, bytes, offsets)."""
    raw, offs = strings(column)
    lo, n = 0, len(offs) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, side="right")) - 1)
        yield lo, hi, raw[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
        lo = hi


def lower_bytes(raw: np.ndarray) -> np.ndarray:
    """A-Z to a-z on UTF-8 bytes."""
    return raw + (((raw >= 65) & (raw <= 90)).astype(np.uint8) << 5)


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter the bits of 64-bit values (a finaliser of shifts and odd multipliers)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 of an odd base and of its inverse modulo 2**64."""
    if not _POWERS or len(_POWERS[0]) < n:
        out = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.full(max(n, CHUNK_BYTES + 1), base, dtype=np.uint64)
            p[0] = 1
            out.append(np.cumprod(p, dtype=np.uint64))
        _POWERS[:] = out
    return _POWERS[0], _POWERS[1]


def prefix_hash(raw: np.ndarray) -> np.ndarray:
    """Running polynomial sums of bytes modulo 2**64, with a leading zero."""
    power, _ = powers(len(raw) + 1)
    out = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * power[:len(raw)], out=out[1:])
    return out


def word_spans(raw: np.ndarray, offs: np.ndarray, breaks: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words (runs of bytes other than ``breaks``, ASCII white space) of concatenated texts.

    Returns their starts, their ends and, per text, the index of its first word
    (one more entry at the end).
    """
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    space = breaks[raw]
    cut = np.ones(len(raw) + 1, dtype=bool)
    cut[1:-1] = space[:-1]
    cut[offs[offs < len(raw)]] = True
    starts = np.flatnonzero(cut[:-1] & ~space)
    cut[:-1] = space
    cut[offs] = True
    cut[-1] = True
    ends = np.flatnonzero(cut[1:] & ~space) + 1
    return starts, ends, np.searchsorted(starts, offs)


def word_hashes(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of concatenated texts, and each text's first index."""
    starts, ends, first = word_spans(raw, offs)
    return span_hashes(raw, starts, ends), first


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans; equal bytes have equal hashes wherever they stand."""
    sums = prefix_hash(raw)
    _, inverse = powers(len(raw) + 1)
    return mix((sums[ends] - sums[starts]) * inverse[starts])


STEP = [np.uint64(pow(0xC2B2AE3D27D4EB4F, i + 1, 1 << 64) | 1) for i in range(64)]


def shingle_sets(raw: np.ndarray, offs: np.ndarray, n: int) -> Iterator[np.ndarray]:
    """Per text the sorted distinct hashes of its ``n``-word shingles.

    With fewer words the whole sequence is one shingle; no words, no shingle.
    """
    words, first = word_hashes(raw, offs)
    rolled = np.zeros(max(0, len(words) - n + 1), dtype=np.uint64)
    for i in range(n):
        rolled += words[i:i + len(rolled)] * STEP[i]
    rolled = mix(rolled)
    for k in range(len(offs) - 1):
        lo, hi = first[k], first[k + 1]
        if hi - lo >= n:
            yield np.unique(rolled[lo:hi - n + 1])
        elif hi > lo:
            short = words[lo:hi] * np.array(STEP[n:n + hi - lo], dtype=np.uint64)
            yield mix(short.sum(dtype=np.uint64, keepdims=True))
        else:
            yield np.zeros(0, dtype=np.uint64)
