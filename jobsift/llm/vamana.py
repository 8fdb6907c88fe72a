"""Approximate nearest neighbours by robust-pruned directed graphs, one per shard.

Vectors are dealt to shards by hash. A shard's graph is grown in batches: a
greedy beam search for each new vector over the graph so far proposes
neighbours; of these, nearest first, one is kept unless a kept one is closer
to it, by a factor ``ALPHA``, than the new vector is; the reverse edges are
added, and lists that grow too long are pruned by the same rule. Queries run
through every shard in blocks, by beam search over its graph, and the shards'
best are merged. For the largest inner product, vectors are given one more
component that makes them all the same length: the nearest by distance then
is the one with the largest product.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: Distinct vectors of a shard, about: what one task holds.
SHARD_ROWS = 16384
#: Out-degree, width of the beam when building and when searching, slack of the pruning rule.
DEGREE, BUILD_BEAM, SEARCH_BEAM, ALPHA = 32, 64, 160, 1.15
_EXPAND = 4
_BATCH = 1024


class Graph:
    """A robust-pruned directed graph over the rows of ``x``, nearness by inner product."""

    def __init__(self, x: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA, seed: int = 7):
        norms = (x * x).sum(axis=1)
        rest = np.sqrt(np.maximum(norms.max(initial=0.0) - norms, 0.0))
        self.x = np.concatenate([x, rest[:, None]], axis=1).astype(np.float32)
        scale = float(np.sqrt(norms.max(initial=0.0))) or 1.0
        self.x /= scale  # keeps squares of large or small components in range
        self.square = (self.x * self.x).sum(axis=1)
        self.degree, self.alpha2 = degree, np.float32(alpha * alpha)
        n = len(x)
        self.out = np.full((n, degree), -1, dtype=np.int32)
        order = np.random.default_rng(seed).permutation(n)
        if not n:
            return
        mean = self.x.mean(axis=0)
        self.start = int(((self.x - mean) ** 2).sum(axis=1).argmin())
        order = np.concatenate([[self.start], order[order != self.start]])
        done, size = 1, 1
        while done < n:
            batch = order[done:done + size]
            found, near = self._search(self.x[batch], beam)
            self._connect(batch, found, near)
            done += len(batch)
            size = min(_BATCH, 2 * size)

    def _distance(self, q: np.ndarray, q2: np.ndarray, ids: np.ndarray) -> np.ndarray:
        dots = np.matmul(self.x[ids], q[:, :, None])[:, :, 0]
        return q2[:, None] + self.square[ids] - 2 * dots

    def _search(self, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Beam search of all rows of ``q`` side by side: ids (-1: none) and squared distances, nearest first."""
        n = len(q)
        ids = np.full((n, beam), -1, dtype=np.int32)
        dist = np.full((n, beam), np.inf, dtype=np.float32)
        open_ = np.zeros((n, beam), dtype=bool)
        q2 = (q * q).sum(axis=1)
        ids[:, 0] = self.start
        dist[:, 0] = self._distance(q, q2, ids[:, :1])[:, 0]
        open_[:, 0] = True
        live = np.arange(n)
        while len(live):
            o = open_[live]
            # the nearest vectors of each beam that are not expanded yet
            rank = np.cumsum(o, axis=1)
            pick = o & (rank <= _EXPAND)
            row, col = np.nonzero(pick)
            open_[live[row], col] = False
            slot = rank[row, col] - 1
            new = np.full((len(live), _EXPAND, self.degree), -1, dtype=np.int32)
            new[row, slot] = self.out[ids[live[row], col]]
            new = np.sort(new.reshape(len(live), -1), axis=1)
            new[:, 1:][new[:, 1:] == new[:, :-1]] = -1
            known = np.sort(ids[live], axis=1)
            # members of the beam are not met again; what fell out of it is farther than all in it
            width = np.int64(len(self.x)) + 1
            lines = np.arange(len(live), dtype=np.int64)[:, None] * width + 1
            hit = np.searchsorted((known + lines).ravel(), (new + lines).ravel())
            flat = (known + lines).ravel()
            same = flat[np.minimum(hit, len(flat) - 1)] == (new + lines).ravel()
            new[same.reshape(new.shape)] = -1
            some = (new >= 0).any(axis=0)
            new = new[:, some]
            d = self._distance(q[live], q2[live], np.maximum(new, 0))
            d[new < 0] = np.inf
            all_d = np.concatenate([dist[live], d], axis=1)
            top = np.argpartition(all_d, beam - 1, axis=1)[:, :beam] if all_d.shape[1] > beam else np.tile(np.arange(beam), (len(live), 1))
            top = np.take_along_axis(top, np.argsort(np.take_along_axis(all_d, top, axis=1), axis=1, kind="stable"), axis=1)
            dist[live] = np.take_along_axis(all_d, top, axis=1)
            ids[live] = np.take_along_axis(np.concatenate([ids[live], new], axis=1), top, axis=1)
            open_[live] = np.take_along_axis(np.concatenate([open_[live], new >= 0], axis=1), top, axis=1) & np.isfinite(dist[live])
            live = live[open_[live].any(axis=1)]
        ids[~np.isfinite(dist)] = -1
        return ids, dist

    def _prune(self, ids: np.ndarray, dist: np.ndarray) -> np.ndarray:
        """Of each row's candidates (nearest first) the diverse ones."""
        kept = np.full((len(ids), self.degree), -1, dtype=np.int32)
        live = ids >= 0
        points = self.x[np.maximum(ids, 0)]
        square = self.square[np.maximum(ids, 0)]
        rows = np.arange(len(ids))
        for k in range(self.degree):
            some = live.any(axis=1)
            if not some.any():
                break
            first = live.argmax(axis=1)
            kept[some, k] = ids[rows, first][some]
            chosen = points[rows, first]
            between = square + square[rows, first][:, None] - 2 * np.matmul(points, chosen[:, :, None])[:, :, 0]
            live &= self.alpha2 * between > dist
            live[rows, first] = False
        return kept

    def _connect(self, batch: np.ndarray, found: np.ndarray, near: np.ndarray) -> None:
        found[found == batch[:, None]] = -1
        order = np.argsort(np.where(found < 0, np.inf, near), axis=1, kind="stable")
        found, near = np.take_along_axis(found, order, axis=1), np.take_along_axis(near, order, axis=1)
        self.out[batch] = self._prune(found, near)
        # reverse edges: lists with room take them, the others are pruned together with them
        to = self.out[batch]
        source = np.repeat(batch, self.degree)[to.ravel() >= 0]
        to = to.ravel()[to.ravel() >= 0]
        order = np.argsort(to, kind="stable")
        to, source = to[order], source[order]
        heads = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1]])) if len(to) else np.zeros(0, np.int64)
        counts = np.diff(np.concatenate([heads, [len(to)]]))
        nodes = to[heads]
        for lo in range(0, len(nodes), _BATCH):
            mine, n = nodes[lo:lo + _BATCH], counts[lo:lo + _BATCH]
            more = np.full((len(mine), int(n.max())), -1, dtype=np.int32)
            row = np.repeat(np.arange(len(mine)), n)
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            first = heads[lo]
            more[row, at] = source[first:first + n.sum()]
            lists = np.concatenate([self.out[mine], more], axis=1)
            d = self._distance(self.x[mine], self.square[mine], np.maximum(lists, 0))
            d[lists < 0] = np.inf
            order = np.argsort(d, axis=1, kind="stable")
            lists, d = np.take_along_axis(lists, order, axis=1), np.take_along_axis(d, order, axis=1)
            full = (lists >= 0).sum(axis=1) > self.degree
            self.out[mine[~full]] = lists[~full, :self.degree]
            if full.any():
                self.out[mine[full]] = self._prune(lists[full], d[full])

    def nearest(self, q: np.ndarray, k: int, beam: int = SEARCH_BEAM) -> np.ndarray:
        """For each query about ``k`` or more rows of largest inner product (-1: none); all rows if there are no more."""
        n = len(self.x)
        beam = max(beam, 2 * k)
        length = np.sqrt((q * q).sum(axis=1, keepdims=True))
        q = np.concatenate([q / np.maximum(length, 1e-300), np.zeros((len(q), 1))], axis=1).astype(np.float32)
        ids = np.concatenate([self._search(q[lo:lo + _BATCH], beam)[0] for lo in range(0, len(q), _BATCH)])
        short = (ids >= 0).sum(axis=1) < min(k, n)
        if short.any():  # parts of the graph out of reach: these few queries look at all rows
            for i in np.flatnonzero(short):
                best = np.argsort(-(self.x @ q[i]), kind="stable")[:beam]
                ids[i, :len(best)] = best
        return ids


def _shard_search(k: int, beam: int):
    """Rows of a shard (vectors, then queries) to each query's best there."""

    def answers(x: dict[int, tuple], queries: list[tuple[int, list]]) -> pa.RecordBatch:
        out: list[tuple] = []
        by_size: dict[int, list] = {}
        for q in queries:
            by_size.setdefault(len(q[1]), []).append(q)
        for size, mine in by_size.items():
            if size not in x:
                continue
            graph, vectors, owners = x[size]
            q = np.array([v for _, v in mine], dtype=np.float64)
            for (qid, vector), found, point in zip(mine, graph.nearest(q, k + 1, beam), q, strict=True):
                found = found[found >= 0]
                scores = (vectors[found] * point).sum(axis=1)
                hits = [(-s, i) for s, f in zip(scores.tolist(), found.tolist(), strict=True) for i in owners[f] if i != qid]
                out += [(qid, vector, i, -s) for s, i in sorted(hits)[:k]]
        cols = list(zip(*out, strict=True)) if out else [(), (), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.list_(pa.float64())),
                                           pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.float64())],
                                          names=["query_id", "q", "vec_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, graphs = None, [], None
        for batch in batches:
            queries: list[tuple[int, list]] = []
            for s, qid, vector, ids in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if s != shard:
                    if queries:
                        yield answers(graphs, queries)
                        queries = []
                    shard, held, graphs = s, [], None
                if ids is not None:
                    held.append((vector, ids))
                    continue
                if graphs is None:
                    sizes = {len(v) for v, _ in held}
                    graphs = {}
                    for size in sizes:
                        vectors = np.array([v for v, _ in held if len(v) == size], dtype=np.float64)
                        graphs[size] = (Graph(vectors), vectors, [i for v, i in held if len(v) == size])
                    held = []
                queries.append((qid, vector))
            if queries:
                yield answers(graphs, queries)

    return run


def search(index: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
           shard_rows: int = SHARD_ROWS, beam: int = SEARCH_BEAM) -> DataFrame:
    """Each query's ``k`` rows of largest inner product found: query_id, rank, vec_id, score.

    The query's own id is no candidate; ties go to the smaller id; fewer
    candidates give fewer rows. Vectors that are null, empty, zero, or hold a
    null or non-finite component take no part. A vector that many rows share is
    one point of the graph, with its k + 1 smallest ids: no other could be
    among k nearest. Rows that repeat id and vector count once. Vectors of
    other lengths than the query's are no candidates. Empty tables give no rows.
    """
    def usable(df: DataFrame) -> DataFrame:
        v = F.col(vec_col).cast("array<double>")
        fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        return df.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull()).where(fine & F.exists(v, lambda x: x != 0)).select(
            F.col(id_col).cast("long").alias("id"), v.alias("v")).distinct()

    spark = index.sparkSession
    first = Window.partitionBy("v").orderBy("id")
    points = stored(usable(index).withColumn("r", F.row_number().over(first)).where(F.col("r") <= k + 1)
                    .groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")), "points")
    shards = max(1, -(-points.count() // shard_rows))
    dealt = points.select(F.pmod(F.xxhash64("v"), F.lit(shards)).cast("int").alias("shard"), F.lit(None).cast("long").alias("qid"), "v", "ids")
    asked = usable(queries).select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.col("id").alias("qid"), "v",
                                   F.lit(None).cast("array<long>").alias("ids"))
    per_shard = (dealt.unionAll(asked).repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", F.col("ids").isNull(), "qid")
                 .mapInArrow(_shard_search(k, beam), "query_id long, q array<double>, vec_id long, score double"))
    best = Window.partitionBy("query_id", "q").orderBy(F.desc("score"), "vec_id")
    return (stored(per_shard, "found").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def neighbours_of(embeddings: DataFrame) -> DataFrame:
    """The 20 nearest of every vector whose id is divisible by 20, against all vectors."""
    return search(embeddings, embeddings.where(F.col("vec_id") % 20 == 0))
