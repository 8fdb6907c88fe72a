import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from jobsift.llm import dualtree
from tests.llm.helpers import SCHEMA, frame, odd_rows, words

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string, score long, rank int, doc_id long"


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def naive(docs, items, k=10):
    """Every item against every document, by the formula."""
    of = [(d, Counter(terms(t)), len(terms(t))) for d, t, *_ in docs]
    n_docs, length = sum(n > 0 for _, _, n in of), sum(n for _, _, n in of)
    df = Counter(t for _, c, _ in of for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        scored = []
        for d, c, n in of:
            score = 0
            for t, r in Counter(terms(text)).items():
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += r * w * ((1000000000 * c[t]) // (1000 * c[t] + 8 * (25 + (75 * n * n_docs) // length)))
            if score > 0:
                scored.append((-score, d if d is not None else -10**9, d))
        out += [(item, i + 1, d, -s) for i, (s, _, d) in enumerate(sorted(scored, key=lambda x: x[:2])[:k])]
    return Counter(out)


def found(spark, docs, items, **kw):
    frame_items = spark.createDataFrame([(i, t, 5, 1, 2) for i, t in items], ITEMS)
    got = dualtree.search(frame(spark, docs), frame_items, **kw)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return Counter(map(tuple, got.collect()))


def corpus(seed, n_docs=400, n_items=23):
    rng = random.Random(seed)
    vocab = words(rng, 300).split()

    def text(n):
        return " ".join(vocab[min(int(rng.expovariate(0.02)), 299)] + rng.choice(["", ".", ",", "-x"]) for _ in range(n))

    items = [(i, text(rng.randint(1, 30))) for i in range(n_items)]
    docs = [(i * 3, text(rng.randint(0, 60))) for i in range(n_docs)]
    docs += [(5000 + i, items[i][1] + " " + text(20)) for i in range(10)]
    docs += [(9000 - i, docs[7][1]) for i in range(15)]  # ties among copies
    return docs, items


def test_against_brute_force(spark, monkeypatch):
    docs, items = corpus(1)
    monkeypatch.setattr(dualtree, "TREE_DOCS", 64)
    assert found(spark, docs, items) == naive(docs, items)
    assert found(spark, docs, items, k=3) == naive(docs, items, 3)


def test_many_blocks_and_small_trees(spark, monkeypatch):
    docs, items = corpus(2, 150)
    monkeypatch.setattr(dualtree, "BLOCK_ITEMS", 9)
    monkeypatch.setattr(dualtree, "TREE_ENTRIES", 100)
    assert found(spark, docs, items) == naive(docs, items)


@pytest.mark.parametrize("seed", range(5))
def test_hierarchies_are_exact_and_prune(seed):
    rng = np.random.default_rng(seed)
    size, n, k = 200, 3000, 5
    rows = [np.sort(rng.choice(size, rng.integers(1, 12), replace=False, p=np.arange(1, size + 1) / (size * (size + 1) / 2))) for _ in range(n)]
    values = [rng.integers(0, 1000, len(r)) * (1 + 20 * (r < 60)) for r in rows]
    asked = [np.sort(rng.choice(size, 6, replace=False)) for _ in range(17)]
    dense = np.zeros((n, size), dtype=np.int64)
    for i, (r, v) in enumerate(zip(rows, values)):
        dense[i, r] = v
    start = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    order, docs = dualtree.hierarchy(start, np.concatenate(rows), np.concatenate(values), size, 16, 8)
    q = np.concatenate([[0], np.cumsum([len(a) for a in asked])])
    item_order, levels = dualtree.hierarchy(q, np.concatenate(asked), np.ones(q[-1], dtype=np.int64), size, 4, 4)
    # every node's maxima are those of the rows below it
    for low, high in zip(docs, docs[1:]):
        for node in range(len(high.start) - 1):
            lo, hi = low.start[high.child[node]], low.start[high.child[node + 1]]
            best = defaultdict(int)
            for t, v in zip(low.terms[lo:hi], low.values[lo:hi]):
                best[t] = max(best[t], v)
            assert dict(zip(high.terms[high.start[node]:high.start[node + 1]], high.values[high.start[node]:high.start[node + 1]])) == best
    search = dualtree.Search(levels, size, k, np.zeros(len(asked), dtype=np.int64))
    search.add(docs, order)
    for i, item in enumerate(item_order):
        scores = dense[:, asked[item]].sum(axis=1)
        want = np.lexsort((np.arange(n), -scores))[:k]
        want = want[scores[want] > 0]
        assert list(zip(search.scores[i], search.ids[i])) == list(zip(scores[want], want))
    assert search.visited < 0.5 * n * len(asked)


def test_odd_rows_long_texts_and_empty_tables(spark):
    long = "needle " + "hay stack " * 300_000
    docs = odd_rows() + [(30, long), (31, "Needle\x00needle\x7fNEEDLE é"), (31, "Needle\x00needle\x7fNEEDLE é")]
    items = [(1, "needle"), (1, "needle"), (1, "one word"), (2, None), (3, ""), (None, "text é"), (4, "12345 日本"), (5, "unknownterm")]
    assert found(spark, docs, items) == naive(docs, items)
    assert found(spark, docs, []) == Counter()
    assert found(spark, [(1, None), (2, "..")], items) == Counter()
    empty = spark.createDataFrame([], SCHEMA)
    assert dualtree.search(empty, spark.createDataFrame([(1, "a", 1, 1, 1)], ITEMS)).collect() == []
