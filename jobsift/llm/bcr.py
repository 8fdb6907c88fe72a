"""Repeated strings by column-wise construction of collections' Burrows-Wheeler transforms.

Equal strings of LENGTH bytes must meet in one collection. Each string has an
anchor, the ANCHOR bytes in it with the smallest hash; neighbouring strings
mostly share it and make a run. Runs meet by their anchors' hashes:

1. A run whose anchor stands nowhere else repeats nothing. A run that stands at
   several places with the same bytes repeats all its strings.
2. What is left are runs that share an anchor but not all bytes. Their bytes
   are dealt out by anchor; a task builds the transform and the common prefixes
   of its runs, a collection of short documents, one symbol per document and
   round, and strings whose common prefix is LENGTH or more are repeated.
3. The ranges found go back to the documents, whose covered bytes are removed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import mix, powers, prefix_hash, span_hashes, stored, text_chunks

#: Bytes of a string that is removed if it occurs again, and of the anchors by which its places meet.
LENGTH = 200
ANCHOR = 64
#: Bytes of runs whose transform is built at a time; runs with the same anchor stay together.
COLLECTION_BYTES = 2 << 20
#: An anchor with more different runs than this is split by the bytes beside it.
HOT_RUNS = 4096


def _slide_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by running minima of blocks from both sides."""
    n = len(x) - width + 1
    pad = (-len(x)) % width
    blocks = np.concatenate([x, np.full(pad, np.iinfo(x.dtype).max, dtype=x.dtype)]).reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[width - 1:width - 1 + n])


def anchors(raw: np.ndarray, offs: np.ndarray, length: int = LENGTH, anchor: int = ANCHOR):
    """Which ``anchor`` bytes stand for each string of ``length`` bytes: those with the smallest hash in it, leftmost.

    Returns per run of strings with the same anchor: text, first start, number of
    strings, place of the anchor (relative to the text), hash of the anchor, hash
    of all bytes of the run. Equal strings have equal anchors at equal places.
    """
    none = np.zeros(0, np.int64)
    if len(raw) < length:
        return none, none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    sums = prefix_hash(raw)
    _, inverse = powers(len(raw) + 1)
    h = (sums[anchor:] - sums[:-anchor]) * inverse[:len(raw) - anchor + 1]
    bits = np.uint64(max(1, int(len(h)).bit_length()))
    h = (mix(h) >> bits << bits) | np.arange(len(h), dtype=np.uint64)
    at = (_slide_min(h, length - anchor + 1) & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    # strings within one text only
    text = np.searchsorted(offs, np.arange(len(at)), side="right") - 1
    fits = np.arange(len(at)) + length <= offs[text + 1]
    head = fits.copy()
    head[1:] &= ~(fits[:-1] & (at[1:] == at[:-1]) & (text[1:] == text[:-1]))
    first = np.flatnonzero(head)
    last = np.flatnonzero(fits & np.concatenate([head[1:] | ~fits[1:], [True]]))
    spot = at[first]
    base = offs[text[first]]
    return (text[first], first - base, last - first + 1, spot - base, span_hashes(raw, spot, spot + anchor),
            span_hashes(raw, first, last + length))


_END = 0xFF  # no byte of UTF-8


def _insert(sequence: np.ndarray, kept: np.ndarray, place: np.ndarray, fresh: np.ndarray) -> np.ndarray:
    """Write a sequence anew with insertions: ``kept`` marks the old entries' places."""
    out = np.empty(len(kept), dtype=sequence.dtype)
    out[kept] = sequence
    out[place] = fresh
    return out


def transform(strings: list[bytes], cap: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All suffixes of a collection in order: (symbol before, common prefix with the one above, string, start).

    Column by column from the right, each round inserts one more suffix of
    every string that still has a symbol. The symbol c to come stands in the
    transform at the suffix inserted last; its rank among the c's there is the
    new suffix's rank among those that begin with c. What a new suffix has in
    common with its neighbours is one more than the least common prefix
    between their tails; prefixes count up to ``cap``. The transform is kept as
    the sorted sequence of (symbol, place), so that ranks are places in it, and
    the common prefixes as a second sequence. Each round reads both from front
    to end and writes them anew with the insertions.
    """
    m = len(strings)
    lengths = np.array([len(s) for s in strings], dtype=np.int64)
    total = int(lengths.sum()) + m
    kind, low = (np.uint32, 24) if total < 1 << 24 else (np.uint64, 56)
    mask = kind((1 << low) - 1)
    data = np.frombuffer(b"".join(strings), dtype=np.uint8)
    begin = np.cumsum(lengths) - lengths
    by_length = np.argsort(-lengths, kind="stable")  # the strings still active are always the first ones
    begin, left = begin[by_length], lengths[by_length].copy()

    def symbols(which: np.ndarray) -> np.ndarray:
        out = np.full(len(which), _END, dtype=kind)
        some = left[which] > 0
        out[some] = data[begin[which[some]] + left[which[some]] - 1]
        return out

    at = np.arange(m, dtype=kind)  # where each string's last inserted suffix stands
    coming = symbols(np.arange(m))
    bwt = np.sort(coming << kind(low) | at)
    common = np.zeros(m, dtype=np.uint8 if cap < 255 else np.uint16)
    while True:
        active = int(np.searchsorted(-left, 0, side="left"))
        if not active:
            break
        n = len(bwt)
        who = np.argsort(at[:active], kind="stable")  # in the order of their places
        here, c = at[who].astype(np.int64), coming[who]
        rank = np.searchsorted(bwt, c << kind(low) | at[who])
        # least common prefix from the symbol's occurrence above (exclusive) to here, and from here (exclusive) to the one below
        above, below = bwt[np.maximum(rank - 1, 0)], bwt[np.minimum(rank + 1, n - 1)]
        joined, follows = (rank > 0) & (above >> kind(low) == c), (rank + 1 < n) & (below >> kind(low) == c)
        padded = np.append(common, common.dtype.type(0))

        def least(lo: np.ndarray, hi: np.ndarray, ok: np.ndarray) -> np.ndarray:
            out = np.zeros(len(lo), dtype=common.dtype)
            if ok.any():
                ends = np.stack([lo[ok], hi[ok]], axis=1).ravel()
                out[ok] = np.minimum(np.minimum.reduceat(padded, ends)[::2], cap - 1) + 1
            return out

        up = least((above & mask).astype(np.int64) + 1, here + 1, joined)
        down = least(here + 1, (below & mask).astype(np.int64) + 1, follows)
        place = rank + m  # in the new order
        left[who] -= 1
        at[who] = place
        coming[:active] = symbols(np.arange(active))
        # places of the old entries in the new order, then the sequences anew
        order = np.sort(place)
        cuts = order - np.arange(active)
        shift = np.repeat(np.arange(active + 1, dtype=kind), np.diff(np.concatenate([[0], cuts, [n]])))
        bwt += shift[bwt & mask]
        fresh = np.sort(coming[:active] << kind(low) | at[:active])
        where = np.searchsorted(bwt, fresh) + np.arange(active)
        kept = np.ones(n + active, dtype=bool)
        kept[where] = False
        bwt = _insert(bwt, kept, where, fresh)
        kept[where] = True
        kept[order] = False
        common = _insert(common, kept, place, up)
        after = place[follows] + 1
        common[after] = down[follows]
    # read the order of the suffixes off the transform, string by string from their ends
    n = len(bwt)
    places = (bwt & mask).astype(np.int64)
    symbol = np.empty(n, dtype=np.uint8)
    symbol[places] = (bwt >> kind(low)).astype(np.uint8)
    next_place = np.empty(n, dtype=np.int64)
    next_place[places] = np.arange(n) + m
    owner, start = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64)
    spot, who = np.arange(m), np.arange(m)
    remains = lengths[by_length].copy()
    while len(spot):
        owner[spot], start[spot] = by_length[who], remains[who]
        on = remains[who] > 0
        spot, who = next_place[spot[on]], who[on]
        remains[who] -= 1
    return symbol, common, owner, start


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, hash, text) to their runs."""
    for batch in batches:
        ids, hashes = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)
        for lo, hi, raw, offs in text_chunks(batch.column(2)):
            text, first, n, spot, anchor, body = anchors(raw, offs)
            if len(text):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[lo:hi][text]), pa.array(hashes[lo:hi][text]), pa.array(first.astype(np.int32)), pa.array(n.astype(np.int32)),
                     pa.array(spot.astype(np.int32)), pa.array(anchor.view(np.int64)), pa.array(body.view(np.int64))],
                    names=["id", "hash", "first", "n", "spot", "anchor", "body"])


_PIECE = "id long, hash long, first int, open boolean, key long, bytes binary"


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, hash, text, runs) to the bytes of the runs, those of hot anchors split in two.

    Every string with the anchor has at least half of its other bytes on one
    side of it; a hot anchor's strings meet by the anchor and that half.
    """
    half = (LENGTH - ANCHOR) // 2
    names = [f.split()[0] for f in _PIECE.split(", ")]
    for batch in batches:
        out: list[tuple] = []
        size = 0
        for i, h, text, runs in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary()), batch.column(3).to_pylist(), strict=True):
            raw = text.as_py()
            for r in runs:
                first, end, spot = r["first"], r["first"] + r["n"], r["spot"]
                parts = [(first, end, b"")]
                if r["hot"]:
                    cut = min(max(spot - half + 1, first), end)
                    parts = [(first, cut, b"<" + raw[spot - half:spot]), (cut, end, b">" + raw[spot + ANCHOR:spot + ANCHOR + LENGTH - ANCHOR - half + 1])]
                for lo, hi, beside in parts:
                    if lo < hi:
                        key = r["anchor"]
                        if beside:
                            key = int.from_bytes(hashlib.blake2b(beside + key.to_bytes(8, "big", signed=True), digest_size=8).digest(), "big", signed=True)
                        out.append((i, h, lo, r["open"], key, raw[lo:hi - 1 + LENGTH]))
                        size += hi - lo + LENGTH
            if size > 4 << 20:
                yield _batch(out, names)
                out, size = [], 0
        if out:
            yield _batch(out, names)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def repeated(strings: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """For each string of a collection, the starts whose next ``length`` bytes occur at another start, in whichever string."""
    _, common, owner, start = transform(strings, length)
    hit = common >= length
    hit[:-1] |= hit[1:]
    order = np.lexsort((start[hit], owner[hit]))
    owners, starts = owner[hit][order], start[hit][order]
    cuts = np.searchsorted(owners, np.arange(len(strings) + 1))
    return [starts[cuts[k]:cuts[k + 1]] for k in range(len(strings))]


def _collections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces, sorted by key, to the ranges of repeated strings in the open ones: (id, hash, start, n)."""
    held: list[tuple] = []
    size, last = 0, None

    def settle() -> pa.RecordBatch:
        out: list[tuple] = []
        for (i, h, first, is_open, _), starts in zip(held, repeated([x[4] for x in held]), strict=True):
            if is_open and len(starts):
                heads = np.flatnonzero(np.concatenate([[True], np.diff(starts) > 1]))
                counts = np.diff(np.concatenate([heads, [len(starts)]]))
                out += [(i, h, first + int(starts[k]), int(n)) for k, n in zip(heads, counts, strict=True)]
        cols = list(zip(*out, strict=True)) if out else [(), (), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int32()),
                                           pa.array(cols[3], pa.int32())], names=["id", "hash", "start", "n"])

    for batch in batches:
        for i, h, first, is_open, key, raw in zip(*(batch.column(k).to_pylist() for k in range(6)), strict=True):
            if size >= COLLECTION_BYTES and key != last:
                yield settle()
                held, size = [], 0
            held.append((i, h, first, is_open, raw))
            size += len(raw)
            last = key
    if held:
        yield settle()


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, text, ranges) to what is left of them."""
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    for batch in batches:
        for lo in range(0, batch.num_rows, 500):
            part = batch.slice(lo, 500)
            out: list[tuple] = []
            for text, ranges in zip(part.column(1).cast(pa.binary()), part.column(2).to_pylist(), strict=True):
                raw, kept, spans, at = text.as_py(), [], 0, 0
                for start, n in sorted((r["start"], r["n"]) for r in ranges or []):
                    if start > at or not spans:  # the next removed run
                        kept.append(raw[at:start])
                        spans += 1
                    at = max(at, start + n - 1 + LENGTH)
                kept = b"".join([*kept, raw[at:]])
                out.append((len(raw), len(raw) - len(kept), spans, hashlib.sha256(kept).hexdigest(), kept))
            cols = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string()),
                                              pa.array(cols[4], pa.binary())], names=names)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (bytes).

    Texts are UTF-8 bytes, null as empty. Every byte covered by a string of
    LENGTH bytes that also starts elsewhere, in this or another row, is
    removed; a cut may fall inside a character. Rows that repeat id and text
    repeat each other's strings. Null ids stay null. Only the two columns named
    are read; an empty table gives an empty result.
    """
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("id"), F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).withColumn("hash", F.xxhash64("text"))
    same, anchor = Window.partitionBy("anchor", "body"), Window.partitionBy("anchor")
    long = rows.where(F.octet_length("text") >= LENGTH)
    runs = (long.select("id", "hash", "text").mapInArrow(_runs, "id long, hash long, first int, n int, spot int, anchor long, body long")
            .withColumn("nth", F.row_number().over(same.orderBy("id", "hash", "first"))).withColumn("copies", F.count("*").over(same))
            .withColumn("kinds", F.sum((F.col("nth") == 1).cast("int")).over(anchor)).withColumn("rarest", F.min("copies").over(anchor))
            .where((F.col("copies") > 1) | (F.col("kinds") > 1)))
    runs = stored(runs, "runs")
    # runs with one place are open; of the others one place each stands for all, where an open one needs it
    wanted = runs.where((F.col("rarest") == 1) & (F.col("kinds") > 1) & (F.col("nth") == 1)).groupBy("id", "hash").agg(
        F.collect_list(F.struct("first", "n", "spot", "anchor", (F.col("copies") == 1).alias("open"), (F.col("kinds") > HOT_RUNS).alias("hot"))).alias("runs"))
    pieces = long.select("id", "hash", "text").join(wanted, ["id", "hash"]).mapInArrow(_pieces, _PIECE)
    found = pieces.repartition("key").sortWithinPartitions("key").mapInArrow(_collections, "id long, hash long, start int, n int")
    settled = runs.where("copies > 1").select("id", "hash", F.col("first").alias("start"), "n")
    ranges = stored(found.unionAll(settled).groupBy("id", "hash").agg(F.collect_list(F.struct("start", "n")).alias("ranges")), "ranges")
    return (rows.join(ranges, ["id", "hash"], "left").select("doc_id", "text", "ranges")
            .mapInArrow(_cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"))


def repeats_of(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of all documents."""
    return remove_repeats(docs).drop("kept")
