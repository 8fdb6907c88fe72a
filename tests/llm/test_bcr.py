import hashlib
import random
from collections import Counter

import numpy as np
from jobsift.llm import bcr

from .helpers import frame, odd_rows, words


def brute(rows, length=bcr.LENGTH):
    seen = Counter(raw[k:k + length] for _, t in rows for raw in [(t or "").encode()] for k in range(len(raw) - length + 1))
    out = []
    for i, t in rows:
        raw = (t or "").encode()
        gone = np.zeros(len(raw) + 1, dtype=np.int8)
        for k in range(len(raw) - length + 1):
            if seen[raw[k:k + length]] > 1:
                gone[k:k + length] = 1
        kept = bytes(b for b, g in zip(raw, gone, strict=False) if not g)
        out.append((i, len(raw), len(raw) - len(kept), int((np.diff(np.concatenate([[0], gone])) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def check(spark, rows):
    got = bcr.repeats_of(frame(spark, rows)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute([r[:2] for r in rows])


def test_transform_orders_all_suffixes():
    rng = random.Random(1)
    for _ in range(20):
        strings = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 25))) for _ in range(10)] + [b"abab" * 4] * 2
        symbol, common, owner, start = bcr.transform(strings, 8)
        suffixes = [strings[o][s:] for o, s in zip(owner, start, strict=True)]
        assert suffixes == sorted(suffixes) and len(suffixes) == sum(map(len, strings)) + len(strings)
        for k in range(1, len(suffixes)):
            a, b = suffixes[k - 1], suffixes[k]
            n = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
            assert common[k] == min(n, 8)
        assert all(y == (strings[o][s - 1] if s else 255) for y, o, s in zip(symbol, owner, start, strict=True))


def repeats():
    rng = random.Random(5)
    base = [words(rng, rng.randint(30, 200)) for _ in range(12)]
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(20 + i, words(rng, 40) + " " + base[i][50:50 + rng.randint(150, 400)] + " " + words(rng, 40)) for i in range(12)]
    rows += [(40, base[3]), (41, base[3].replace("a", "b", 1)), (42, "x" * 700), (43, "ab" * 300), (44, base[0] + base[0]), (45, "é" * 250)]
    return rows + [(50 + i, words(rng, 20) + base[5][:260] + words(rng, 20)) for i in range(12)]


def test_repeats_equal_brute_force(spark):
    check(spark, repeats())


def test_hot_anchors_are_split(spark, monkeypatch):
    monkeypatch.setattr(bcr, "HOT_RUNS", 1)
    check(spark, repeats())


def test_odd_rows(spark):
    check(spark, odd_rows() + [(70, "same " * 100), (70, "same " * 100), (None, "none " * 100), (None, "none " * 100)])
    assert bcr.repeats_of(frame(spark, odd_rows()).limit(0)).count() == 0
