"""Bulk flags of files against loading the files one at a time, in plain Python."""

import random
from collections import Counter

import pytest

from jobsift.operators import quality

ROWS = "file_name string, file_time timestamp, listing_id string, source string, null_bad boolean"


def naive(rows):
    """Per file (n_new, n_bad), the files taken in load order, a good file's keys known from then on."""
    files = {}
    for name, time, lid, source, bad in rows:
        files.setdefault(name, (time, []))[1].append(((lid, source), bad))
    known, out = set(), {}
    for name, (_, content) in sorted(files.items(), key=lambda f: (f[1][0] is None, f[1][0] or 0, f[0])):
        new = [(k, bad) for k, bad in content if k not in known]
        n = Counter(k for k, _ in new)
        wrong = sum(n[k] > 1 or bad for k, bad in new)
        out[name] = (len(new), wrong)
        if not wrong:
            known |= {k for k, _ in new if None not in k}
    return out


def flags(spark, rows):
    import datetime as dt
    df = spark.createDataFrame([(f, None if t is None else dt.datetime(2024, 1, 1) + dt.timedelta(minutes=t), i, s, b)
                                for f, t, i, s, b in rows], ROWS)
    return {r.file_name: (r.n_new, r.n_bad) for r in quality.file_flags(df, file_time_col="file_time").collect()}


def delivery(seed, n_files=25, n_keys=20):
    rng = random.Random(seed)
    rows = []
    for f in range(n_files):
        time = None if rng.random() < 0.1 else rng.randint(0, 12)
        name = f"f{rng.randint(0, 10**6)}-{f}"
        for _ in range(rng.randint(1, 5)):
            key = (str(rng.randint(0, n_keys)), rng.choice(["a", "b"])) if rng.random() > 0.05 else (None, "a")
            rows.append((name, time, *key, rng.random() < 0.25 or key[0] is None))
    return rows


@pytest.mark.parametrize("walk", [1_000_000, 3, 0])
def test_random_deliveries(spark, monkeypatch, walk):
    monkeypatch.setattr(quality, "WALK_ROWS", walk)
    for seed in range(5 if walk == 1_000_000 else 2):
        rows = delivery(seed)
        assert flags(spark, rows) == naive(rows), seed


def chain(n):
    """File k has a bad copy of what file k - 1 supplies and supplies the next: all are good; the last one fails."""
    rows = [("f000", 0, "0", "s", False)]
    for k in range(1, n):
        rows += [(f"f{k:03}", k, str(k - 1), "s", True), (f"f{k:03}", k, str(k), "s", False)]
    return rows + [("last", n, "none", "s", True), ("last", n, "0", "s", False)]


def test_a_chain_of_200_files_takes_no_round_per_file(spark, monkeypatch):
    cuts = []
    real = quality.cut_lineage
    monkeypatch.setattr(quality, "cut_lineage", lambda df: cuts.append(1) or real(df))
    rows = chain(200)
    got = flags(spark, rows)
    assert got == naive(rows)
    assert got["last"] == (1, 1) and all(got[f"f{k:03}"] == (1, 0) for k in range(200))
    assert len(cuts) < 15


def test_a_chain_by_rounds_over_undecided_rows(spark, monkeypatch):
    monkeypatch.setattr(quality, "WALK_ROWS", 0)
    rows = chain(8) + [(f"g{i}", 3, f"x{i}", "s", False) for i in range(50)]
    assert flags(spark, rows) == naive(rows)


def test_no_bad_rows_and_no_rows(spark):
    assert flags(spark, [("a", 1, "1", "s", False), ("b", 2, "1", "s", False)]) == {"a": (1, 0), "b": (0, 0)}
    assert flags(spark, []) == {}
