import random

import numpy as np
import pyarrow as pa
from jobsift.llm import mixing
from pyspark.sql import functions as F

from .helpers import frame, odd_rows, words


def test_raked_marginals_meet_their_targets(spark):
    rng = random.Random(2)
    cells = spark.createDataFrame([(f"s{a}", f"l{b}", c, float(rng.randint(500, 1500))) for a in range(4) for b in range(3) for c in range(3)],
                                  "source string, lang string, topic int, mass double")
    targets = {d: mixing.tempered(cells, d, 0.5) for d in mixing.DIMENSIONS}
    got = mixing.rake(cells, targets)
    total = cells.agg(F.sum("mass")).first()[0]
    assert got.agg(F.max("probability")).first()[0] <= 1
    taken = got.agg(F.sum(F.col("mass") * F.col("probability"))).first()[0]
    for d in mixing.DIMENSIONS:
        want = {r[0]: r[1] for r in targets[d].collect()}
        for r in got.groupBy(d).agg(F.sum(F.col("mass") * F.col("probability")).alias("m")).collect():
            assert abs(r.m / taken - want[r[0]]) < 2 * mixing.TOLERANCE
    assert taken <= mixing.RATE * total * 1.01


def test_the_sample_has_the_target_tokens(spark):
    got = mixing.mixture_of(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    rows = got.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("probability")).alias("want"),
                                     F.sum(F.when(F.col("kept"), F.col("n_tokens")).otherwise(0)).alias("have")).collect()
    want, have = sum(r.want for r in rows), sum(r.have for r in rows)
    assert abs(have - want) < 0.15 * want and len(rows) == 20


def test_odd_rows(spark):
    docs = frame(spark, odd_rows())
    got = mixing.mixture_of(docs).collect()
    assert len(got) == len(odd_rows()) and all(0 <= r.probability <= 1 and r.topic is not None for r in got)
    assert len({r.kept for r in got if r.doc_id == 4}) == 1
    kept = mixing.mixed_documents(docs)
    assert kept.columns == docs.columns
    # cells that a float sum puts on the edge aside, both forms take the same documents
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in got if r.kept and r.doc_id is not None} | (
        {None} if any(r.kept and r.doc_id is None for r in got) else set())
    assert mixing.mixture_of(docs.limit(0)).count() == 0


def test_copies_take_one_centre_and_all_documents_count(spark):
    rng = random.Random(6)
    kinds = [words(rng, 40).split() for _ in range(8)]
    rows = [(i, " ".join(rng.choices(kinds[i % 8], k=60))) for i in range(160)]
    copy = rows[0][1]
    rows += [(1000 + i, copy) for i in range(3000)]
    docs = frame(spark, rows)
    centres = mixing.topic_centres(docs)
    assert (centres @ centres.T - np.eye(8)).max() < 0.95
    again = mixing.topic_centres(docs.repartition(7, "text"))
    assert np.array_equal(centres, again)
    got = mixing.with_topics(docs.select("doc_id", "text"), centres, "text").collect()
    assert len({r.topic for r in got if r.doc_id >= 1000}) == 1 and len({r.topic for r in got}) > 4
    # the centre of the copies is the mean of all texts that are nearest to it
    texts, topic = dict(rows), {r.doc_id: r.topic for r in got}
    x = {i: next(mixing._features(pa.array([t])))[0][0] for i, t in texts.items() if topic[i] == topic[1000]}
    mean = sum(x.values())
    assert mean @ centres[topic[1000]] / np.linalg.norm(mean) > 0.99999


def test_raking_goes_on_until_the_targets_are_met(spark):
    # two by two cells whose mass lies on one diagonal: slow to move to the targets
    cells = spark.createDataFrame([("a", "x", 0, 1000.0), ("b", "y", 0, 1000.0), ("a", "y", 0, 4.0), ("b", "x", 0, 4.0)],
                                  "source string, lang string, topic int, mass double")
    table = lambda d, shares: spark.createDataFrame(list(shares.items()), f"{d} {'int' if d == 'topic' else 'string'}, target double")
    targets = {"source": table("source", {"a": 0.52, "b": 0.48}), "lang": table("lang", {"x": 0.517, "y": 0.483}), "topic": table("topic", {0: 1.0})}
    got = mixing.rake(cells, targets, rate=0.4).collect()
    taken = sum(r.mass * r.probability for r in got)
    gap = abs(sum(r.mass * r.probability for r in got if r.source == "a") / taken - 0.52)
    assert gap < 2 * mixing.TOLERANCE / 0.4 and got[0].gap < mixing.TOLERANCE
    targets["lang"] = table("lang", {"x": 0.4, "y": 0.6})
    assert mixing.rake(cells.where("mass > 10"), targets, rate=0.4).first().gap > mixing.TOLERANCE
