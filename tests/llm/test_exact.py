import hashlib
import random

from jobsift.llm import grace

from .helpers import frame, odd_rows, words

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault((t or "").translate(LOWER), []).append(i)
    out = []
    for i, t in rows:
        g = groups[(t or "").translate(LOWER)]
        known = [x for x in g if x is not None]
        out.append((i, max(known) if known else None, len(g), hashlib.sha256((t or "").translate(LOWER).encode()).hexdigest()))
    return sorted(out, key=str)


def check(spark, rows, **kw):
    got = grace.grace_groups(frame(spark, rows), **kw).collect()
    assert sorted(((r.id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == brute([r[:2] for r in rows])
    kept = [r for r in got if r.kept]
    assert len(kept) == len({r.text_sha256 for r in got}) and all(r.id == r.keep_id for r in kept)


def test_odd_rows(spark):
    check(spark, odd_rows())


def test_small_tables_recurse(spark):
    rng = random.Random(1)
    texts = [words(rng, rng.randint(1, 40)) for _ in range(120)]
    rows = [(i, rng.choice([str.upper, str.lower])(rng.choice(texts))) for i in range(400)] + [(1000 + i, "copy " * 50) for i in range(200)]
    check(spark, rows, table_bytes=2000, bucket_bytes=1 << 20)


def test_equal_hashes_are_told_apart_by_content():
    t = grace.OpenTable(1 << 20)
    assert [t.find(7, b"a"), t.find(7, b"b"), t.find(7, b"a"), t.find(1031, b"c")] == [0, 1, 0, 2]


def test_empty_and_kept(spark):
    assert grace.grace_groups(frame(spark, odd_rows()).limit(0)).count() == 0
    docs = frame(spark, odd_rows())
    kept = grace.kept_documents(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 2, 3, 5, 6, 7, 8, 9]
