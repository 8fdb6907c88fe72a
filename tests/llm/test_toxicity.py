import itertools
import random

import numpy as np
from jobsift.llm import toxicity
from pyspark.sql import functions as F

from .helpers import frame, odd_rows, words

SF = "/root/testdata/sf0.01"


def test_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.toxicity_of(docs, labels).join(labels, "doc_id").where("held_out").select("toxic", "predicted", "score").collect()
    assert sum(r.predicted for r in rows if r.toxic == 0) <= 0.05 * len(rows)
    pos, neg = [r.score for r in rows if r.toxic == 1], [r.score for r in rows if r.toxic == 0]
    assert np.mean([p > n for p in pos for n in neg]) > 0.8


def test_marginals_equal_the_sum_over_all_labellings():
    rng = np.random.default_rng(1)
    for n in (1, 2, 5, 8):
        score, move = rng.normal(size=n), rng.normal(size=(2, 2))
        weights = {y: np.exp(sum(s for s, v in zip(score, y, strict=True) if v) + sum(move[a, b] for a, b in itertools.pairwise(y)))
                   for y in itertools.product((0, 1), repeat=n)}
        total = sum(weights.values())
        want = [sum(w for y, w in weights.items() if y[k]) / total for k in range(n)]
        got, pair = toxicity._forward_backward(np.concatenate([score, score]), move, np.array([0, n]), np.array([n, n]))
        assert np.allclose(got, want + want) and np.isclose(pair.sum(), 2 * (n - 1))


def test_planted_spans(spark):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(300):
        bad = i % 3 == 0
        text = f"{words(rng, 20)} you {'GRUMPLET ' if bad else ''}{words(rng, 20)}"
        rows.append((i, text))
        labels.append((i, int(bad), 0))
    rows += [(1000, "éé grumplet!"), (1001, "a clean text here"), (1002, None)]
    got = {r.doc_id: r for r in toxicity.toxicity_of(frame(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int, quality int")).collect()}
    assert got[1000].predicted == 1 and [(s.start, s.end) for s in got[1000].toxic_spans] == [(3, 11)]
    assert got[1001].predicted == 0 and got[1002].predicted == 0 and got[1002].toxic_spans == []
    assert all(got[i].predicted == int(i % 3 == 0) for i in range(300))


def test_odd_rows(spark):
    docs = frame(spark, odd_rows())
    none = spark.createDataFrame([(1, None), (None, 1), (77, 1)], "doc_id long, toxic int")
    for labels in (none, none.limit(0)):
        got = toxicity.toxicity_of(docs, labels).collect()
        assert len(got) == len(odd_rows()) and all(r.score < 0.5 and r.predicted == 0 for r in got)
    assert toxicity.toxicity_of(docs.limit(0), none).count() == 0


def test_a_long_text_and_labels_without_documents_leave_the_sample_whole(spark):
    rng = random.Random(5)
    first = spark.range(100000).orderBy(F.xxhash64("id")).first().id
    rows = [(200000 + i, f"{words(rng, 20)} you {'GRUMPLET ' if i % 3 == 0 else ''}{words(rng, 20)}") for i in range(300)]
    labels = [(200000 + i, int(i % 3 == 0)) for i in range(300)] + [(first, 0)] + [(300000 + i, i % 2) for i in range(10000)]
    rows += [(first, "filler " * 700000), (7, "a grumplet!"), (8, "a clean text")]
    got = {r.doc_id: r.predicted for r in toxicity.tag(frame(spark, rows), toxicity.train(
        frame(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int"))).select("doc_id", "predicted").collect()}
    assert got[7] == 1 and got[8] == 0 and got[first] == 0
    assert all(got[200000 + i] == int(i % 3 == 0) for i in range(300))


def test_the_bound_is_dealt_out_by_text():
    assert toxicity._stretch([5, 5, 1000], 30) == 20 and toxicity._stretch([5, 6, 7], 30) == 7 and toxicity._stretch([10] * 4, 30) == 7
    assert toxicity._stretch([], 30) == 0


def test_rare_toxic_words_are_learned():
    rng = random.Random(9)
    texts = [f"{words(rng, 15)} {'GRUMPLET ' if i < 600 else 'Snorvak ' if i < 614 else ''}{words(rng, 15)}" for i in range(1600)]
    model = toxicity.fit(texts, [int(i < 800) for i in range(1600)])

    def likely(text):
        raw = np.frombuffer(text.encode(), np.uint8)
        _, _, first, feats = toxicity._tokens(raw, np.array([0, len(raw)]))
        return toxicity._forward_backward(toxicity._emissions(model.weights, feats), model.transitions, *toxicity._chains(first))[0]

    assert likely("such a snorvak here")[2] > 0.5 and likely("such a grumplet here")[2] > 0.5
    assert max(likely(" ".join(words(rng, 1) for _ in range(50)))) < 0.5
