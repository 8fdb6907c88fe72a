import random
import re

import numpy as np
import pytest
from jobsift.llm import common, components, parity

from .helpers import frame, odd_rows, words

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, n, percent):
    def members(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        return frozenset(tuple(w[k:k + n]) for k in range(max(1, len(w) - n + 1))) if w else frozenset()

    sets = [members(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for x in range(len(rows)):
        for y in range(x):
            both = len(sets[x] & sets[y])
            if sets[x] and sets[y] and 100 * both >= percent * (len(sets[x]) + len(sets[y]) - both):
                root[find(x)] = find(y)
    out = []
    for k, (i, _) in enumerate(rows):
        near = [rows[j][0] for j in range(len(rows)) if find(j) == find(k) and rows[j][0] is not None]
        out.append((i, len(sets[k]), min(near) if near else None))
    return sorted(out, key=str)


def edited(rng, text, n):
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = words(rng, 1)
    return " ".join(w)


def groups():
    rng = random.Random(11)
    rows = [(i, words(rng, rng.randint(1, 120))) for i in range(60)]
    rows += [(100 + i, edited(rng, rows[i][1].upper(), rng.randint(0, 3))) for i in range(60)]
    base = words(rng, 150)  # a large group of near copies, and a chain
    rows += [(300 + i, edited(rng, base, rng.randint(1, 3))) for i in range(70)]
    step = words(rng, 200)
    for i in range(30):
        step = edited(rng, step, 2)
        rows.append((500 + i, step))
    shared = words(rng, 40)  # many texts that share a passage only
    rows += [(600 + i, shared + " " + words(rng, 60)) for i in range(40)]
    return rows + [(700 + i, " ".join(["w"] * (i + 1))) for i in range(8)]


@pytest.mark.parametrize("n,percent", [(4, 85), (5, 80)])
def test_groups_equal_brute_force(spark, n, percent):
    rows = groups()
    got = parity.near_duplicate_groups(frame(spark, rows), n, percent).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, n, percent)


def test_sketches_bound_the_difference():
    rng = np.random.default_rng(3)
    bands = parity.Bands(85)
    for n in (7, 30, 300):
        a = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[n // 20:], rng.integers(0, 1 << 62, n // 20).astype(np.uint64)]))
        band = bands.of(n)[0]
        one, two = (parity._segment_keys(x, bands, band) for x in (a, b))
        difference = len(np.setxor1d(a, b))
        assert (one != two).sum() <= difference <= bands.bound(len(a) + len(b))
        assert (one == two).sum() >= bands.spare[band] + 1


def test_odd_rows(spark):
    rows = odd_rows() + [(7, odd_rows()[9][1])]
    docs = frame(spark, rows)
    got = parity.near_duplicate_groups(docs).collect()
    assert sorted((r[0], r[2]) for r in got if r[1] and r[0]) == sorted((r[0], r[2]) for r in brute([x[:2] for x in rows], 5, 80) if r[1] and r[0])
    assert all(r.component_id == r.doc_id for r in got if not r.n_shingles)
    kept = parity.kept_documents(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 0, 1, 2, 3, 4, 4, 6, 8, 9]
    assert parity.near_duplicate_groups(docs.limit(0)).count() == 0


def test_ids_at_several_texts(spark):
    rng = random.Random(21)
    rows = []
    for i in range(12):  # ids 0 to 3, and none, each at several texts that are linked with texts of other ids
        text = words(rng, 80)
        rows += [((0, 1, 2, 3, None)[i % 5], text), (100 + i, edited(rng, text, 1))]
    rows += [(None, words(rng, 80)), (3, words(rng, 80)), (101, words(rng, 80))]
    docs = frame(spark, rows)
    got = parity.near_duplicate_groups(docs, 5, 80).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, 5, 80)
    # a text goes by its own group, not by that of another text with its id
    kept = {(r.doc_id, r.text) for r in parity.kept_documents(docs).collect()}
    stays = {rows[2 * i] for i in range(12)} | {rows[2 * i + 1] for i in range(12) if rows[2 * i][0] is None}
    assert kept == stays | set(rows[-3:])


@pytest.mark.parametrize("shuffled", [False, True])
def test_components_of_long_chains_read_few_rows_a_round(spark, monkeypatch, shuffled):
    rng = random.Random(31)
    n = 600
    names = list(range(n))
    if shuffled:
        rng.shuffle(names)
    edges = [(names[k], names[k + 1]) for k in range(n - 1) if k % 200 != 199] + [(1000, 1001), (1002, 1002)]
    read = []

    def stored(df, name):
        out = common.stored(df, name)
        if name == "edges":
            read.append(out.count())
        return out

    monkeypatch.setattr(components, "stored", stored)
    frame_of = lambda rows: spark.createDataFrame(rows, "a long, b long")
    got = {r.node: r.root for r in components.components(frame_of(edges)).collect()}
    least = [min(names[k:k + 200]) for k in (0, 200, 400)]
    assert got == {**{names[k]: least[k // 200] for k in range(n)}, 1000: 1000, 1001: 1000}
    assert sum(read) <= 4 * len(edges)
    start = components.components(frame_of(edges))
    joined = {r.node: r.root for r in components.components(frame_of([(names[0], names[599]), (1001, 2000)]), start).collect()}
    assert joined == {**got, **{x: min(least[0], least[2]) for x, r in got.items() if r in (least[0], least[2])}, 2000: 1000}
    assert components.components(frame_of([])).count() == 0
