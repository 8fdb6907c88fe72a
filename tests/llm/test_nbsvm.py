import math
import zlib

import numpy as np
import pyarrow as pa
import pytest

from jobsift.llm import nbsvm
from jobsift.llm.common import table
from tests.conftest import SF_SMALL
from tests.llm.helpers import SCHEMA, frame, odd_rows

LABELS = "doc_id long, quality int, toxic int, text string, score double"


def naive_words(text):
    return [w for w in text.replace("\n", " ").replace("\t", " ").split(" ") if w]


def test_indicators_follow_whole_texts_one_by_one():
    texts = ["", None, "a", "Er Er Er Er", "one TWO 333 %%% one", "é ß 日本 \U0001F600", "x" * 3000 + " tail"]
    together = list(nbsvm.indicators(pa.array(texts, pa.string())))
    alone = [next(iter(nbsvm.indicators(pa.array([t], pa.string())))) for t in texts]
    for a, b in zip(together, alone, strict=True):
        assert np.array_equal(a, b)
    assert not len(together[0]) and not len(together[1])
    # presence: a repeated passage adds only what is new where it joins
    one, two = (next(iter(nbsvm.indicators(pa.array([t])))) for t in ("ab cd ef", "ab cd ef ab cd ef"))
    assert set(one) <= set(two)
    # the number of distinct byte n-grams, word n-grams and shape n-grams, up to hash collisions
    text = "one TWO 333 %%% one"
    raw, words = text.encode(), naive_words(text)
    grams = {raw[i:i + n] for n in (1, 2, 3, 4) for i in range(len(raw) - n + 1)}
    pairs = {tuple(words[i:i + n]) for n in (1, 2) for i in range(len(words) - n + 1)}
    shapes = ["a", "A", "0", "%", "a"]
    shaped = {tuple(shapes[i:i + n]) for n in (1, 2, 3) for i in range(len(shapes) - n + 1)}
    assert len(together[4]) in range(len(grams) + len(pairs) + len(shaped) - 2, len(grams) + len(pairs) + len(shaped) + 1)


def test_dual_descent_reaches_the_hinge_optimum():
    rng = np.random.default_rng(1)
    rows = [np.sort(rng.choice(40, 8, replace=False)) for _ in range(200)]
    values = rng.normal(size=40)
    truth = rng.normal(size=40)
    labels = np.array([1 if truth[r] @ values[r] > 0.3 * rng.normal() else -1 for r in rows])
    w, bias = nbsvm.dual_descent(rows, values, labels, epochs=3000, gap=1e-4)
    n, n1 = len(rows), (labels > 0).sum()
    cost = np.where(labels > 0, n / (2 * n1), n / (2 * (n - n1)))
    x = np.zeros((n, 41))
    for i, r in enumerate(rows):
        x[i, r] = values[r] / math.sqrt((values[r] ** 2).sum())
        x[i, 40] = 1

    def loss(v):
        return 0.5 * v @ v + (cost * np.maximum(0, 1 - labels * (x @ v))).sum()

    best = np.append(w, bias)
    slow = np.zeros(41)  # plain subgradient steps
    least = loss(slow)
    for t in range(1, 20001):
        bad = labels * (x @ slow) < 1
        slow = slow - (slow - (cost[bad] * labels[bad]) @ x[bad]) / (t + 10)
        least = min(least, loss(slow))
    assert loss(best) <= least * 1.001
    assert ((labels * (x @ best)) > 0).mean() > 0.8


def test_logistic_curve_meets_the_shares():
    margins = np.array([-2.0, -1, 0, 1, 2])
    share = 1 / (1 + np.exp(-(1.2 * margins - 0.4)))
    a, b = nbsvm.logistic_curve(margins, 1e6 * share, 1e6 * (1 - share))
    assert abs(a - 1.2) < 1e-3 and abs(b + 0.4) < 1e-3
    a, b = nbsvm.logistic_curve(np.array([-1.0, 1]), np.array([0.0, 50]), np.array([50.0, 0]))
    assert 0 < a < 50


def test_ratios_are_the_naive_counts(spark, monkeypatch):
    rows = [(i, t) for i, t in enumerate(["aa bb", "aa cc", "dd!!", "dd!! ee!!", "aa bb"])]
    labels = spark.createDataFrame([(0, 1, 0, "", 0.0), (1, 1, 0, "", 0.0), (2, 0, 0, "", 0.0), (3, 0, 0, "", 0.0), (4, 1, 0, "", 0.0)], LABELS)
    model = nbsvm.train(frame(spark, rows), labels)
    texts = {"aa bb": 1, "aa cc": 1, "dd!!": 0, "dd!! ee!!": 0}  # a repeated text counts once
    of = np.ones((2, nbsvm.BUCKETS))
    for t, y in texts.items():
        of[y, next(iter(nbsvm.indicators(pa.array([t]))))] += 1
    want = np.log(of[1] / of[1].sum()) - np.log(of[0] / of[0].sum())
    assert np.allclose(model.weights[0], want)


def test_held_out_accuracy(spark):
    docs, labels = table(spark, SF_SMALL.replace("0.001", "0.01"), "documents"), table(spark, SF_SMALL.replace("0.001", "0.01"), "labels")
    got = nbsvm.quality_of(docs, labels)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = got.collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    held = got.where("held_out").join(labels, "doc_id").collect()
    assert sum(r.predicted == r.quality for r in held) >= 0.95 * len(held)


def test_labels_of_the_held_out_fold_change_nothing(spark):
    docs, labels = table(spark, SF_SMALL, "documents"), table(spark, SF_SMALL, "labels")
    turned = labels.selectExpr("doc_id", "CASE WHEN pmod(crc32(CAST(doc_id AS STRING)), 4) = 2 THEN 1 - quality ELSE quality END AS quality")
    one = {r.doc_id: r.score for r in nbsvm.quality_of(docs, labels).collect()}
    two = {r.doc_id: r.score for r in nbsvm.quality_of(docs, turned).collect()}
    assert one == pytest.approx(two, abs=1e-9)


def test_shards_of_any_number_agree(spark, monkeypatch):
    docs, labels = table(spark, SF_SMALL.replace("0.001", "0.01"), "documents"), table(spark, SF_SMALL.replace("0.001", "0.01"), "labels")
    monkeypatch.setattr(nbsvm, "SHARD_DOCS", 60)
    held = nbsvm.quality_of(docs, labels).where("held_out").join(labels, "doc_id").collect()
    assert sum(r.predicted == r.quality for r in held) >= 0.9 * len(held)


def test_odd_rows_and_empty_tables(spark):
    rows = odd_rows() + [(20, "word " * 1_000_000, "en", "a")]
    docs = frame(spark, rows)
    labels = spark.createDataFrame([(4, 1, 0, "t", 0.1), (5, None, 0, "t", 0.1), (6, 0, 0, "t", 0.1), (None, 1, 1, "t", 0.1), (777, 1, 1, "t", 0.1),
                                    (8, 1, 0, None, None), (9, 0, 0, None, None), (1, 0, 0, None, None)], LABELS)
    got = nbsvm.quality_of(docs, labels).collect()
    assert len(got) == len(rows)
    assert len({r.score for r in got if r.doc_id in (1, 2)}) == 1  # null is as empty
    empty = spark.createDataFrame([], SCHEMA)
    assert nbsvm.quality_of(empty, labels).collect() == []
    assert {r.score for r in nbsvm.quality_of(docs, labels.limit(0)).collect()} == {0.5}
    one_class = nbsvm.quality_of(docs, labels.where("quality = 1")).collect()
    assert len({r.score for r in one_class}) == 1 and one_class[0].score > 0.5
