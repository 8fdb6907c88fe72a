import numpy as np
from jobsift.llm import vamana


def brute(vectors, queries, k=20):
    out = {}
    for q, v in queries:
        near = sorted((-float(np.dot(np.array(v), np.array(w))), i) for i, w in vectors if i != q and len(w) == len(v))
        out[q] = near[:k]
    return out


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, score string")


def test_recall_against_brute_force(spark):
    got = vamana.neighbours_of(spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")).collect()
    t = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()
    want = brute([(r.vec_id, r.embedding) for r in t], [(r.vec_id, r.embedding) for r in t if r.vec_id % 20 == 0])
    vectors = {r.vec_id: np.array(r.embedding) for r in t}
    hits = 0
    for q, near in want.items():
        mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [r for r, _, _ in mine] == list(range(1, 21))
        assert all(abs(s - float(vectors[i] @ vectors[q])) < 1e-12 for _, i, s in mine)
        hits += len({i for _, i, _ in mine} & {i for _, i in near})
    assert hits >= 0.9 * 20 * len(want)


def test_recall_over_shards_and_unequal_lengths(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 16)) * rng.uniform(0.2, 5, size=(3000, 1))
    df = table(spark, [(i, [float(np.float32(c)) for c in v], 0, "") for i, v in enumerate(x)])
    got = vamana.search(df, df.where("vec_id % 20 = 0"), shard_rows=700).collect()
    x = x.astype(np.float32).astype(np.float64)
    hits = n = 0
    for q in range(0, 3000, 20):
        s = x @ x[q]
        s[q] = -np.inf
        hits += len(set(np.argsort(-s, kind="stable")[:20]) & {r.vec_id for r in got if r.query_id == q})
        n += 20
    assert hits >= 0.9 * n


def test_copies_ties_and_vectors_that_take_no_part(spark):
    rows = [(i, [1.0, 0.0], 0, "") for i in range(60)] + [(100, [0.0, 1.0], 0, ""), (101, None, 0, ""), (102, [0.0, 0.0], 0, ""),
            (103, [None, 1.0], 0, ""), (104, [float("nan"), 1.0], 0, ""), (105, [float("inf"), 1.0], 0, ""), (106, [], 0, ""),
            (107, [1.0, 2.0, 3.0], 0, ""), (None, [3.0, 3.0], 0, ""), (0, [1.0, 0.0], 0, "")]
    df = table(spark, rows)
    got = {}
    for r in vamana.neighbours_of(df).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == {0, 20, 40, 100}
    assert sorted(got[0]) == [(k, k, 1.0) for k in range(1, 21)]
    assert [i for _, i, _ in sorted(got[20])] == list(range(20))
    assert [(i, s) for _, i, s in sorted(got[100])] == [(i, 0.0) for i in range(20)]
    few = table(spark, rows[58:61])
    assert vamana.search(few, few).count() == 6
    assert vamana.neighbours_of(df.limit(0)).count() == 0
