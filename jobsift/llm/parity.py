"""N-gram Jaccard join by parity sketches.

A text's set of shingles is XOR-ed into a sketch of segments: each shingle's
64-bit hash goes to one segment and is XOR-ed into it. Segments of two sketches
differ only where the sets do. The folded sketch flips one bit per shingle, of
4 to 8 times as many bits as shingles; the Hamming distance of two, the longer
folded to the length of the shorter, never exceeds the symmetric difference.

With J = |A and B| / |A or B| at least p percent, |A xor B| is at most
D = (100 - p)(|A| + |B|) / (100 + p). In a band of sizes with the bound D the
sketch has D + 1 + s segments, so linked texts agree in s + 1 segments at
least (pigeonhole), and each may leave out the s of its segments whose values
most texts have: one that both keep is still common. Most texts so lose all
values that many share. Texts that keep *large* ones, as those of big groups
of similar texts, are paired with a pivot per value first, and then block by
block within a task, by their folded sketches, with texts of other components.
All candidates are verified on the texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, lower_bytes, mix, shingle_sets, stored, text_chunks
from .components import components

#: Texts that share a segment are paired within it up to this many; beyond, the segment is large.
SMALL = 16
#: Texts of a block that are compared in one task, in large segments.
BLOCK = 4096
_BAND = np.uint64(63)


class Bands:
    """Bands of set sizes, the segments of their sketches and the spare ones among them."""

    def __init__(self, percent: int):
        self.percent = percent
        low = 1
        while self.bound(2 * low) < 1:
            low += 1
        self.low = [low]
        while self.low[-1] < 1 << 40:
            self.low.append(-(-self.low[-1] * 8 // 5))
        self.spare, self.segments = [], []
        for top in self.low[1:]:
            d = self.bound(2 * (top - 1))
            self.spare.append(4 + d // 8)
            self.segments.append(d + 1 + self.spare[-1])

    def bound(self, sizes: int) -> int:
        """The largest symmetric difference of linked sets with ``sizes`` members together."""
        return (100 - self.percent) * sizes // (100 + self.percent)

    def of(self, n: int) -> list[int]:
        """The bands in which a set of ``n`` meets partners: its own, and the next if a set there may be linked."""
        own = int(np.searchsorted(self.low, n, side="right")) - 1
        out = [own] if own >= 0 else []
        if 100 * n >= self.percent * self.low[own + 1]:
            out.append(own + 1)
        return out


def _digest(members: np.ndarray) -> bytes:
    return hashlib.blake2b(members.tobytes(), digest_size=16).digest()


def _profiles(n: int):
    """Rows (id, text, hash) to (doc_id, hash of the text, n_shingles, digest of the set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests = [], []
            for _, _, raw, offs in text_chunks(batch.column(1)):
                for members in shingle_sets(lower_bytes(raw), offs, n):
                    sizes.append(len(members))
                    digests.append(_digest(members))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary())],
                                             names=["doc_id", "hash", "n_shingles", "digest"])

    return run


def _segment_keys(members: np.ndarray, bands: Bands, band: int) -> np.ndarray:
    """One key per segment of the band's sketch: its number and what was XOR-ed into it. The low bits name the band."""
    m = bands.segments[band]
    segment = (members >> np.uint64(20)) % np.uint64(m)
    order = np.argsort(segment, kind="stable")
    at = segment[order].astype(np.int64)
    heads = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    sketch = np.zeros(m, dtype=np.uint64)
    sketch[at[heads]] = np.bitwise_xor.reduceat(members[order], heads)
    number = (np.arange(m, dtype=np.uint64) + np.uint64(1)) << np.uint64(6) | np.uint64(band)
    return mix(sketch ^ mix(number * np.uint64(0x9FB21C651E98DF25))) & ~_BAND | np.uint64(band)


def _keys(n: int, percent: int):
    """Rows (id, text) to (key, node); a set is met once per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, seen = Bands(percent), set()
        for batch in batches:
            keys: list[np.ndarray] = []
            nodes: list[int] = []
            for _, _, raw, offs in text_chunks(batch.column(1)):
                for members in shingle_sets(lower_bytes(raw), offs, n):
                    digest = _digest(members)
                    if len(members) and digest not in seen:
                        seen.add(digest)
                        node = int.from_bytes(digest[:8], "big", signed=True)
                        for band in bands.of(len(members)):
                            keys.append(_segment_keys(members, bands, band))
                            nodes.append(node)
                if sum(map(len, keys)) > 200_000:
                    yield _key_batch(keys, nodes)
                    keys, nodes = [], []
            if keys:
                yield _key_batch(keys, nodes)

    return run


def _key_batch(keys: list[np.ndarray], nodes: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)),
                                       pa.array(np.repeat(np.array(nodes, dtype=np.int64), [len(k) for k in keys]))], names=["key", "node"])


def _folds(n: int):
    """Rows (node, digest, text) with the size of the set and its folded sketch, each set once per task (rows that
    repeat an id and its text lie in one)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            new = [d not in seen and not seen.add(d) for d in batch.column(1).to_pylist()]
            batch = batch.filter(pa.array(new, pa.bool_()))
            sizes, folds = [], []
            for _, _, raw, offs in text_chunks(batch.column(2)):
                for members in shingle_sets(lower_bytes(raw), offs, n):
                    width = 64 << max(3, (len(members) // 16).bit_length())
                    bits = np.bincount((members & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
                    folds.append(np.packbits(bits.astype(np.uint8)).view(np.int64))
                    sizes.append(len(members))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sizes, pa.int64()), pa.array(folds, pa.list_(pa.int64()))],
                                             names=["node", "digest", "text", "n", "fold"])

    return run


def _to_width(fold: np.ndarray, width: int) -> np.ndarray:
    return np.bitwise_xor.reduce(fold.reshape(-1, width), axis=0)


def _near_in_blocks(percent: int, forest: bool):
    """Rows (key, lo, hi, block, digest, root, n, fold), sorted by the first three, to pairs that may be linked.

    Texts of block ``lo`` meet those of block ``hi``; texts of one component are not compared. With ``forest`` only
    pairs that join components not yet joined by the block's pairs before: fewer than there are components.
    """

    def pairs(rows: list[tuple]) -> Iterator[tuple[bytes, bytes]]:
        lo, hi = rows[0][1], rows[0][2]
        width = min(len(r[7]) for r in rows)
        fold = np.array([_to_width(np.array(r[7], dtype=np.int64), width) for r in rows]).view(np.uint64)
        n = np.array([r[6] for r in rows], dtype=np.int64)
        roots = np.unique([r[5] for r in rows], return_inverse=True)[1]
        above = list(range(len(rows)))

        def find(k: int) -> int:
            while above[k] != k:
                above[k] = k = above[above[k]]
            return k

        one = [k for k, r in enumerate(rows) if r[3] == lo]
        two = [k for k, r in enumerate(rows) if r[3] == hi]
        step = max(1, (1 << 22) // (width * max(1, len(two))))
        for at in range(0, len(one), step):
            x = np.array(one[at:at + step])
            y = np.array(two)
            apart = np.bitwise_count(fold[x][:, None, :] ^ fold[y][None, :, :]).sum(axis=2, dtype=np.int64)
            both, least = n[x][:, None] + n[y][None, :], np.minimum(n[x][:, None], n[y][None, :])
            fits = (apart * (100 + percent) <= (100 - percent) * both) & (100 * least >= percent * (both - least))
            fits &= roots[x][:, None] != roots[y][None, :]
            if lo == hi:
                fits &= x[:, None] < y[None, :]
            for i, j in zip(*np.nonzero(fits), strict=True):
                if forest:
                    p, q = find(roots[x[i]]), find(roots[y[j]])
                    if p == q:
                        continue
                    above[p] = q
                a, b = rows[x[i]][4], rows[y[j]][4]
                yield min(a, b), max(a, b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        out: list[tuple[bytes, bytes]] = []
        for batch in batches:
            for r in zip(*(batch.column(k).to_pylist() for k in range(8)), strict=True):
                if held and held[0][:3] != r[:3]:
                    out += pairs(held)
                    held = []
                held.append(r)
            if len(out) > 50_000:
                yield _pair_batch(out)
                out = []
        out += pairs(held) if held else []
        yield _pair_batch(out)

    return run


def _pair_batch(pairs: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.binary()) for k in (0, 1)], names=["da", "db"])


def _verified(n: int, percent: int):
    """Rows (a, b, text a, text b): those linked, without the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 200):
                part = batch.slice(lo, 200)
                one = [s for _, _, raw, offs in text_chunks(part.column(2)) for s in shingle_sets(lower_bytes(raw), offs, n)]
                two = [s for _, _, raw, offs in text_chunks(part.column(3)) for s in shingle_sets(lower_bytes(raw), offs, n)]
                keep = []
                for x, y in zip(one, two, strict=True):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(100 * both >= percent * (len(x) + len(y) - both))
                yield part.select(["a", "b"]).filter(pa.array(keep))

    return run


def _folded(x: str, size: Column) -> Column:
    """A folded sketch folded further to ``size`` words."""
    less = F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.aggregate(
        F.sequence(i, F.size(x) - 1, size), F.lit(0).cast("long"), lambda s, j: s.bitwiseXOR(F.get(x, j))))
    return F.when(F.size(x) == size, F.col(x)).otherwise(less)


def _hamming(x: str, y: str) -> Column:
    size = F.least(F.size(x), F.size(y))
    return F.aggregate(F.zip_with(_folded(x, size), _folded(y, size), lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda s, v: s + v)


def linked_classes(docs: DataFrame, profiles: DataFrame, n: int, percent: int) -> DataFrame:
    """(digest, root) of all sets that are linked with another set: components of the join's links."""
    bands = Bands(percent)
    rows = docs.select("doc_id", "text", "hash")
    key = Window.partitionBy("key")
    # copies of a set from several tasks fall together here; keys of one set only are dropped
    buckets = (rows.mapInArrow(_keys(n, percent), "key long, node long")
               .withColumn("before", F.lag("node").over(key.orderBy("node"))).where("before IS NULL OR before != node").drop("before")
               .withColumn("size", F.count("*").over(key)).where("size > 1"))
    buckets = stored(buckets, "segments")

    listed = buckets.where(F.col("size") <= SMALL).groupBy("key").agg(F.sort_array(F.collect_list("node")).alias("x"))
    pairs = (listed.select(F.explode(F.expr("flatten(transform(x, (a, i) -> transform(slice(x, i + 2, size(x)), b -> struct(a, b))))")).alias("p"))
             .select(F.col("p.a").alias("a"), F.col("p.b").alias("b")).distinct())

    spares = docs.sparkSession.createDataFrame(list(enumerate(bands.spare)), "band long, spare long")
    most = Window.partitionBy("node", "band").orderBy(F.desc("size"), "key")
    met = stored(buckets.where(F.col("size") > SMALL).withColumn("band", F.col("key").bitwiseAND(F.lit(63)))
                 .withColumn("nth", F.row_number().over(most)).join(F.broadcast(spares), "band")
                 .where(F.col("nth") > F.col("spare")).select("key", "node"), "large")

    # texts of the sets that may be linked, one each; an id may stand at several texts, so the text's hash tells which
    wanted = pairs.select(F.col("a").alias("node")).unionAll(pairs.select("b")).unionAll(met.select("node")).distinct()
    classes = (profiles.where("n_shingles > 0").groupBy("digest").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "hash")).alias("row"))
               .select("digest", F.col("row.doc_id").alias("_id"), F.col("row.hash").alias("_hash"))
               .withColumn("node", F.conv(F.hex(F.substring("digest", 1, 8)), 16, -10).cast("long")).join(wanted, "node"))
    texts = (rows.join(classes, (F.col("hash") == F.col("_hash")) & F.col("doc_id").eqNullSafe(F.col("_id")))
             .select("node", "digest", F.coalesce("text", F.lit("")).alias("text")))
    texts = stored(texts.mapInArrow(_folds(n), "node long, digest binary, text string, n long, fold array<long>"), "texts")

    def near(pairs: DataFrame) -> DataFrame:
        """Pairs of nodes to pairs of sets whose sizes and folded sketches allow a link."""
        sketch = texts.select("node", "digest", "n", "fold")
        x = pairs.join(sketch.select(F.col("node").alias("a"), F.col("digest").alias("da"), F.col("n").alias("na"), F.col("fold").alias("fa")), "a")
        x = x.join(sketch.select(F.col("node").alias("b"), F.col("digest").alias("db"), F.col("n").alias("nb"), F.col("fold").alias("fb")), "b")
        most = F.floor(F.lit(100 - percent) * (F.col("na") + F.col("nb")) / F.lit(100 + percent))
        fits = (F.lit(100) * F.least("na", "nb") >= F.lit(percent) * F.greatest("na", "nb")) & (_hamming("fa", "fb") <= most)
        return x.where(fits).drop("fa", "fb", "na", "nb")

    def verify(pairs: DataFrame, name: str) -> DataFrame:
        one = texts.select(F.col("digest").alias("da"), F.col("text").alias("ta"))
        two = texts.select(F.col("digest").alias("db"), F.col("text").alias("tb"))
        full = pairs.select("da", "db").join(one, "da").join(two, "db").select(F.col("da").alias("a"), F.col("db").alias("b"), "ta", "tb")
        return stored(full.mapInArrow(_verified(n, percent), "a binary, b binary"), name)

    def joined(links: DataFrame, roots: DataFrame | None = None) -> DataFrame:
        out = components(links, roots)
        discard(links)
        return out

    roots = joined(verify(near(pairs), "links"))
    discard(buckets)

    def mixed(name: str) -> DataFrame:
        """Large segments' rows whose sets are not all in one component; their sketches are joined where they are compared."""
        at = (met.join(texts.select("node", "digest"), "node")
              .join(roots.withColumnRenamed("node", "digest"), "digest", "left").withColumn("root", F.coalesce("root", "digest")))
        several = at.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("size")).where("lo != hi")
        return stored(at.join(several.select("key", "size"), "key"), name)

    at = mixed("large-0")
    pivot = at.groupBy("key").agg(F.min_by(F.struct("node", "root"), F.xxhash64("digest")).alias("p"))
    found = (at.join(pivot, "key").where("root != p.root")
             .select(F.least("node", "p.node").alias("a"), F.greatest("node", "p.node").alias("b")).distinct())
    roots = joined(verify(near(found), "links-pivot"), roots)
    discard(at)

    # blocks of large segments: first pairs that would join their components, then, with what held of these, all pairs left
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    for forest in (True, False):
        at = mixed(f"large-{1 if forest else 2}")
        blocks = at.withColumn("blocks", F.ceil(F.col("size") / F.lit(BLOCK)).cast("int"))
        blocks = blocks.withColumn("block", F.pmod(F.xxhash64("digest"), F.col("blocks")).cast("int"))
        dealt = blocks.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
            "key", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "digest", "root")
        dealt = dealt.join(texts.select("digest", "n", "fold"), "digest").select("key", "lo", "hi", "block", "digest", "root", "n", "fold")
        found = (dealt.repartition(parts, "key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
                 .mapInArrow(_near_in_blocks(percent, forest), "da binary, db binary").distinct())
        roots = joined(verify(found, f"links-blocks-{1 if forest else 2}"), roots)
        discard(at)
    discard(texts, met)
    return roots.select(F.col("node").alias("digest"), "root")


def near_duplicate_groups(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id.

    Words are runs of bytes other than ASCII white space, A-Z in lower case;
    the set holds a text's distinct ``n``-word shingles (with fewer words the
    whole sequence). Texts are linked when ``percent`` of the union is common;
    equal sets always are. ``component_id`` is the smallest id that links reach
    (null ids do not count; null where there is no other). Texts without words
    are linked with nothing. Rows that repeat an id are linked as texts; an
    empty table gives an empty result. Only the two columns named are read.
    """
    return _groups(docs, n, percent, id_col, text_col).drop("hash")


def _groups(docs: DataFrame, n: int, percent: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``near_duplicate_groups`` with the hash of their text."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).withColumn("hash", F.xxhash64("text"))
    profiles = stored(docs.mapInArrow(_profiles(n), "doc_id long, hash long, n_shingles long, digest binary"), "profiles")
    roots = linked_classes(docs, profiles, n, percent)
    # digests to their components' smallest ids, summed up before any row of a group is joined
    sets = profiles.where("n_shingles > 0").groupBy("digest").agg(F.min("doc_id").alias("low")).join(roots, "digest", "left")
    sets = sets.withColumn("root", F.coalesce("root", "digest"))
    lows = sets.groupBy("root").agg(F.min("low").alias("component_id"))
    named = stored(sets.join(lows, "root").select("digest", "component_id"), "components")
    return (profiles.join(named, "digest", "left")
            .select("doc_id", "hash", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")))


def jaccard_groups_of(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of all documents, by 4-word shingles and a similarity of 0.85."""
    return near_duplicate_groups(docs, n=4, percent=85)


def kept_documents(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group (the one with the smallest id), columns unchanged.

    Texts without words are in no group and stay. Rows with a null id stay. Of
    an id that stands at several texts, those in a group with a smaller id go.
    """
    groups = _groups(docs, n, percent)
    # stored first: its size is then known, and the texts are shuffled for this join only if it is large
    gone = stored(groups.where(F.col("component_id") != F.col("doc_id"))
                  .select(F.col("doc_id").alias("_gone"), F.col("hash").alias("_text")).distinct(), "gone")
    # by aliases: the documents may have columns of these names
    this = (F.col("d.doc_id").cast("long") == F.col("g._gone")) & (F.xxhash64(F.col("d.text").cast("string")) == F.col("g._text"))
    return docs.alias("d").join(gone.alias("g"), this, "left_anti")
