"""Ranked lexical search: exact dual-tree top-k over items and documents.

As Spark jobs, for each block of items (bounded texts, so that what is broadcast is bounded):

1. One pass over the documents' whole texts stores, per document with a term, its length and the
   places of the block's terms in the vocabulary with their frequencies; each task adds one row with its
   document frequencies and totals.
2. From the sums follow the terms' weights. A document is then a sparse vector of term impacts and an
   item a sparse vector of repeats; the score is their product, and no coordinate is negative.
3. Each task builds, from up to TREE_DOCS documents at a time, a hierarchy whose nodes hold coordinate
   maxima; the items' hierarchy is broadcast. A pair of nodes is bounded by the product of their maxima;
   where that is below the weakest k-th score of the node's items, the whole batch is left. Equal
   bounds are followed, as an equal score may win by its smaller id.
4. The k-th scores start from those of a part of the documents (SEED_PART), searched first: a part's
   k-th score is never above the whole's, so nothing is lost. The tasks' best are merged by a ranked window.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import lower_bytes, stored, text_chunks, word_spans

#: Items of a block: at most so many and about so many bytes of text (one longer item is a block's worst case).
BLOCK_ITEMS, BLOCK_BYTES = 1024, 1 << 20
#: Documents and vector entries per hierarchy, documents per leaf and children per inner node; items per lowest node.
TREE_DOCS, TREE_ENTRIES, LEAF, FAN = 8192, 1 << 21, 16, 8
ITEM_LEAF, ITEM_FAN = 4, 4
#: One document in so many is searched first for the starting k-th scores.
SEED_PART = 64

_BREAKS = np.zeros(256, dtype=bool)
_BREAKS[:0x80] = True
for _lo, _hi in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A)):
    _BREAKS[_lo:_hi + 1] = False

VECTORS = "doc_id long, n long, ids array<int>, tfs array<int>, stats boolean"


class Level(NamedTuple):
    """One level of a hierarchy: sparse rows of coordinate maxima; ``child`` bounds each node's range one level below."""

    start: np.ndarray
    terms: np.ndarray
    values: np.ndarray
    child: np.ndarray


def terms_of(column: pa.Array) -> Iterator[tuple[int, int, pa.Array, np.ndarray]]:
    """Runs of rows: (first, end, the terms of their texts one after another, first term index of each text)."""
    for lo, hi, raw, offs in text_chunks(column):
        raw = lower_bytes(raw)
        starts, ends, first = word_spans(raw, offs, _BREAKS)
        data = raw[~_BREAKS[raw]]
        bounds = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
        words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))])
        yield lo, hi, words, first


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _vectors(vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = pa.array(vocabulary.value, pa.large_binary())
        size = len(vocab)
        df, docs, length = np.zeros(size, dtype=np.int64), 0, 0
        schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("ids", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int32())),
                            ("stats", pa.bool_())])
        for batch in batches:
            for lo, hi, words, first in terms_of(batch.column(1)):
                at = pc.index_in(words, vocab)
                known = np.flatnonzero(~np.asarray(at.is_null()))
                term = at.drop_null().to_numpy().astype(np.int64)
                doc = np.searchsorted(first, known, side="right") - 1
                keys, tf = np.unique(doc * max(size, 1) + term, return_counts=True)
                doc, term = keys // max(size, 1), keys % max(size, 1)
                df += np.bincount(term, minlength=size) if size else 0
                n = np.diff(first)
                docs += int((n > 0).sum())
                length += int(n.sum())
                some = np.flatnonzero(np.bincount(doc, minlength=hi - lo))
                cut = np.searchsorted(doc, np.append(some, hi - lo)).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(cut), pa.array(term.astype(np.int32)))
                tfs = pa.ListArray.from_arrays(pa.array(cut), pa.array(tf.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo).take(pa.array(some)), pa.array(n[some]), ids, tfs,
                                                  pa.array(np.zeros(len(some), dtype=bool))], schema=schema)
        # the task's own sums: documents with a term (as n of the row), all terms (in doc_id), document frequencies
        found = np.flatnonzero(df)
        big = pa.array([[]], pa.list_(pa.int32()))
        for k in range(0, max(len(found), 1), 1 << 16):
            part = found[k:k + (1 << 16)]
            ids = pa.array([part.astype(np.int32)], pa.list_(pa.int32())) if len(part) else big
            tfs = pa.array([df[part].astype(np.int32)], pa.list_(pa.int32())) if len(part) else big
            yield pa.RecordBatch.from_arrays([pa.array([length if k == 0 else 0]), pa.array([docs if k == 0 else 0]), ids, tfs,
                                              pa.array([True])], schema=schema)

    return run


def _maxima(group: np.ndarray, terms: np.ndarray, values: np.ndarray, child: np.ndarray, size: int) -> Level:
    """Sparse rows (group ascending) with the largest value per term."""
    key = group * size + terms
    order = np.argsort(key, kind="stable")
    key, values = key[order], values[order]
    new = np.ones(len(key), dtype=bool)
    new[1:] = key[1:] != key[:-1]
    at = np.flatnonzero(new)
    key = key[at]
    values = np.maximum.reduceat(values, at)
    return Level(np.searchsorted(key // size, np.arange(len(child))), key % size, values, child)


def hierarchy(start: np.ndarray, terms: np.ndarray, values: np.ndarray, size: int, leaf: int, fan: int) -> tuple[np.ndarray, list[Level]]:
    """Hierarchy over non-empty sparse rows: their order, and levels from single rows to the root.

    Rows with the same strongest coordinates lie side by side, so that maxima stay near the rows' own.
    """
    n = len(start) - 1
    row = np.repeat(np.arange(n), np.diff(start))
    order = np.lexsort((-values, row))
    lead = np.stack([terms[order[np.minimum(start[:-1] + k, start[1:] - 1)]] for k in range(3)])
    rows = np.lexsort(lead[::-1])
    take, new_start = _gather(start, rows)
    levels = [Level(new_start, terms[take], values[take], np.arange(n + 1))]
    while len(levels[-1].start) > 2:
        low = levels[-1]
        count = len(low.start) - 1
        width = leaf if len(levels) == 1 else fan
        child = np.append(np.arange(0, count, width), count)
        group = np.repeat(np.arange(count) // width, np.diff(low.start))
        levels.append(_maxima(group, low.terms, low.values, child, size))
    return rows, levels


def _gather(start: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the entries of ``rows`` of a sparse matrix, and where each row begins among them."""
    sizes = start[rows + 1] - start[rows]
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    return np.arange(bounds[-1]) + np.repeat(start[rows] - bounds[:-1], sizes), bounds


class Search:
    """Best documents per item over the hierarchies given to ``add``; ``visited`` counts scored pairs."""

    def __init__(self, levels: list[Level], size: int, k: int, floor: np.ndarray):
        self.levels, self.size, self.k = levels, size, k
        self.floor = np.maximum(floor, 1)  # a score of zero never counts
        n = len(floor)
        self.scores = [np.zeros(0, np.int64) for _ in range(n)]
        self.ids: list[np.ndarray] = [np.zeros(0, np.int64) for _ in range(n)]
        self.scratch = np.zeros(size, dtype=np.int64)
        self.visited = 0

    def _bounds(self, item_level: int, node: int, low: Level, nodes: np.ndarray) -> np.ndarray:
        items = self.levels[item_level]
        lo, hi = items.start[node], items.start[node + 1]
        terms = items.terms[lo:hi]
        self.scratch[terms] = items.values[lo:hi]
        take, bounds = _gather(low.start, nodes)
        product = self.scratch[low.terms[take]] * low.values[take]
        self.scratch[terms] = 0
        return np.add.reduceat(product, bounds[:-1])

    def _items(self, level: int, node: int) -> tuple[int, int]:
        lo, hi = node, node + 1
        while level > 0:
            lo, hi = self.levels[level].child[lo], self.levels[level].child[hi]
            level -= 1
        return lo, hi

    def add(self, docs: list[Level], ids: np.ndarray) -> None:
        """Search one hierarchy of documents; ``ids`` in its order (the smallest id wins a tie)."""
        self._walk(len(self.levels) - 1, 0, docs, len(docs) - 1, np.zeros(1, np.int64), ids)

    def _walk(self, level: int, node: int, docs: list[Level], depth: int, nodes: np.ndarray, ids: np.ndarray) -> None:
        lo, hi = self._items(level, node)
        bounds = self._bounds(level, node, docs[depth], nodes)
        keep = bounds >= self.floor[lo:hi].min()
        if not keep.any():
            return
        nodes, bounds = nodes[keep], bounds[keep]
        if depth == 0 and level == 0:
            self.visited += len(nodes)
            self._offer(lo, bounds, ids[nodes])
            return
        if depth > 0:
            # children, those of the best nodes first
            child = docs[depth].child
            nodes = nodes[np.argsort(-bounds, kind="stable")]
            first, sizes = child[nodes], child[nodes + 1] - child[nodes]
            ends = np.cumsum(sizes)
            below = np.arange(ends[-1]) + np.repeat(first - (ends - sizes), sizes)
            depth -= 1
        else:
            below = nodes
        if level == 0:
            # a single item: the best batch alone first, so that its scores prune the others
            head = min(len(below), LEAF)
            self._walk(0, node, docs, depth, below[:head], ids)
            if head < len(below):
                self._walk(0, node, docs, depth, below[head:], ids)
            return
        c = self.levels[level].child
        for j in range(c[node], c[node + 1]):
            self._walk(level - 1, j, docs, depth, below, ids)

    def _offer(self, item: int, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores[item], scores]), np.concatenate([self.ids[item], ids])
        best = np.lexsort((ids, -scores))[:self.k]
        self.scores[item], self.ids[item] = scores[best], ids[best]
        if len(best) == self.k:
            self.floor[item] = max(self.floor[item], self.scores[item][-1])


_NULL_ID = np.iinfo(np.int64).min


def _search(shared, k: int, n_docs: int, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels, places, weights, floor = shared.value
        size = len(weights)
        search = Search(levels, size, k, floor)
        held: list[pa.RecordBatch] = []
        rows = entries = 0

        def build() -> None:
            t = pa.Table.from_batches(held).combine_chunks()
            ids, tfs = t["ids"].combine_chunks(), t["tfs"].combine_chunks()
            start = ids.offsets.to_numpy().astype(np.int64)
            terms, tf = ids.values.to_numpy()[start[0]:start[-1]].astype(np.int64), tfs.flatten().to_numpy().astype(np.int64)
            start = start - start[0]
            m = 100 - 75 + (75 * t["n"].to_numpy() * n_docs) // length
            impact = weights[terms] * ((1_000_000_000 * tf) // (1000 * tf + 8 * np.repeat(m, np.diff(start))))
            doc_ids = t["doc_id"].combine_chunks().fill_null(_NULL_ID).to_numpy()
            order, docs = hierarchy(start, terms, impact, size, LEAF, FAN)
            search.add(docs, doc_ids[order])

        for batch in batches:
            sums = np.concatenate([[0], np.cumsum(pc.list_value_length(batch.column(2)).to_numpy(zero_copy_only=False))])
            at = 0
            while at < batch.num_rows:
                room = int(np.searchsorted(sums, sums[at] + TREE_ENTRIES - entries, side="right")) - 1
                end = max(min(at + TREE_DOCS - rows, room, batch.num_rows), at + (rows == 0))
                if end > at:
                    held.append(batch.slice(at, end - at))
                    rows, entries, at = rows + end - at, entries + int(sums[end] - sums[at]), end
                if at < batch.num_rows:
                    build()
                    held, rows, entries = [], 0, 0
        if rows:
            build()
        for i, (scores, ids) in enumerate(zip(search.scores, search.ids, strict=True)):
            if len(ids):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ids), places[i], np.int32)), pa.array(ids, mask=ids == _NULL_ID), pa.array(scores)],
                    names=["place", "doc_id", "score"])

    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("place").orderBy(F.desc("score"), F.asc("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _block(docs: DataFrame, items: pa.Table, k: int) -> DataFrame | None:
    """place, rank, doc_id, score for one block of items (``place``: their position in ``items``)."""
    spark = docs.sparkSession
    parts = [(lo, words, first) for lo, _, words, first in terms_of(items["text"].combine_chunks())]
    vocab = pc.unique(pa.concat_arrays([w for _, w, _ in parts])) if parts else pa.array([], pa.large_binary())
    if not len(vocab):
        return None
    size = len(vocab)
    shared = spark.sparkContext.broadcast(vocab.to_pylist())
    vectors = stored(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_vectors(shared), VECTORS), "dualtree-vectors")
    sums = vectors.where("stats")
    total = sums.agg(F.sum("n").alias("n"), F.sum("doc_id").alias("length")).first()
    n_docs, length = total["n"] or 0, total["length"] or 0
    if not n_docs:
        return None
    counts = (sums.select(F.explode(F.arrays_zip("ids", "tfs")).alias("t")).groupBy(F.col("t.ids").alias("id"))
              .agg(F.sum("t.tfs").alias("df")).toArrow())
    df = np.zeros(size, dtype=np.int64)
    df[counts["id"].to_numpy()] = counts["df"].to_numpy()
    weights = np.array([weight(n_docs, int(d)) for d in df], dtype=np.int64)

    group, term = [], []
    for lo, words, first in parts:
        group.append(lo + np.repeat(np.arange(len(first) - 1), np.diff(first)))
        term.append(pc.index_in(words, vocab).to_numpy().astype(np.int64))
    keys, repeats = np.unique(np.concatenate(group) * size + np.concatenate(term), return_counts=True)
    some = np.unique(keys // size)
    start = np.searchsorted(keys // size, np.append(some, some[-1] + 1))
    # laid out by what a term can bring at most, with its own repeats as the value
    order, _ = hierarchy(start, keys % size, repeats * weights[keys % size] + 1, size, ITEM_LEAF, ITEM_FAN)
    take, begin = _gather(start, order)
    levels = [Level(begin, (keys % size)[take], repeats[take].astype(np.int64), np.arange(len(order) + 1))]
    while len(levels[-1].start) > 2:
        low, count = levels[-1], len(levels[-1].start) - 1
        width = ITEM_LEAF if len(levels) == 1 else ITEM_FAN
        child = np.append(np.arange(0, count, width), count)
        levels.append(_maxima(np.repeat(np.arange(count) // width, np.diff(low.start)), low.terms, low.values, child, size))

    places = some[order]
    rows = vectors.where("NOT stats").select("doc_id", "n", "ids", "tfs")
    schema = "place int, doc_id long, score long"
    floor = np.zeros(len(places), dtype=np.int64)
    start_from = spark.sparkContext.broadcast((levels, places, weights, floor))
    first = rows.where(F.pmod(F.xxhash64("doc_id", "n"), F.lit(SEED_PART)) == 0).mapInArrow(_search(start_from, k, n_docs, length), schema)
    at = {int(p): i for i, p in enumerate(places)}
    for r in _best(first, k).where(F.col("rank") == k).collect():  # one number per item
        floor[at[r["place"]]] = r["score"]
    go_on = spark.sparkContext.broadcast((levels, places, weights, floor))
    return _best(rows.mapInArrow(_search(go_on, k, n_docs, length), schema), k)


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents with a score above 0 for each item.

    Null and empty texts have no terms: such documents are not counted, such items find nothing. Rows of
    ``items`` that repeat an id with the same text are one item; the same id with other texts is several,
    ranked each by itself. Rows of ``docs`` are ranked each, also under repeated ids; equal scores go by
    ascending id, a null id first. Texts are read whole, of any length; other columns are not read. An
    empty table on either side gives an empty result. Items are handled in blocks, each a run over the documents.
    """
    spark = docs.sparkSession
    asked = items.select(F.col("item_id"), F.col("text").cast("string").alias("text")).distinct()
    size = asked.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    blocks = max(-(-size["n"] // BLOCK_ITEMS), -(-(size["bytes"] or 0) // BLOCK_BYTES))
    if blocks > 1:
        asked = stored(asked.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)).cast("int")), "dualtree-items")
    out = None
    for b in range(blocks):
        table = (asked.where(F.col("block") == b) if blocks > 1 else asked).select("item_id", "text").orderBy("item_id", "text").toArrow()
        found = _block(docs, table, k) if table.num_rows else None
        if found is None:
            continue
        names = spark.createDataFrame(pa.table({"at": pa.array(np.arange(table.num_rows, dtype=np.int32)), "item_id": table["item_id"]}))
        part = found.join(F.broadcast(names), F.col("place") == F.col("at")).select("item_id", "rank", "doc_id", "score")
        if blocks > 1:
            part = stored(part, "dualtree-best")
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = items.select("item_id").limit(0).select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"),
                                                      F.lit(0).cast("long").alias("score"))
    return out
