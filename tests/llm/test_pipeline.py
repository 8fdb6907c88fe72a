import random

import corpus_pipeline
import public_tokenizers
from jobsift.llm.tokens import encoder
from pyspark.sql import types as T

from .helpers import words
from .test_parity import edited

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents():
    rng = random.Random(21)
    rows = [(i, words(rng, 60), "en", f"s{i % 3}") for i in range(40)]
    rows += [(100 + i, rows[i][1].upper(), "en", "s0") for i in range(8)]  # equal after lower-casing
    rows += [(200 + i, edited(rng, rows[10 + i][1], 1), "en", "s1") for i in range(6)]  # near copies
    rows += [(300, None, "en", "s0"), (301, "", None, None), (302, "123 -- 456", "en", "s0"), (303, "short text", None, "s2"),
             (None, "a text without an id", "en", "s2"), (304, "same row", "en", "s0"), (304, "same row", "en", "s0")]
    return [(*r, None if r[1] is None else len(r[1])) for r in rows]


def test_stages(spark, tmp_dir):
    spark.createDataFrame(documents(), SCHEMA).write.parquet(f"{tmp_dir}/documents.parquet")
    docs, left = spark.read.parquet(f"{tmp_dir}/documents.parquet"), {}
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "exact_dedup", "near_dedup", "mixing", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, tmp_dir)
        if name != "packing":
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_dir}/{name}")
        docs = spark.read.parquet(f"{tmp_dir}/{name}")
        left[name] = docs.collect()
    ids = {n: sorted(r.doc_id if r.doc_id is not None else -1 for r in rows) for n, rows in left.items() if n != "packing"}
    all_ids = sorted(r[0] if r[0] is not None else -1 for r in documents())
    assert ids["language_id"] == [i for i in all_ids if i not in (300, 301, 302)]
    assert ids["exact_dedup"] == sorted(set(ids["language_id"]) - set(range(8)))
    assert ids["near_dedup"] == sorted(set(ids["exact_dedup"]) - set(range(200, 206)))
    assert set(ids["mixing"]) <= set(ids["near_dedup"]) and 0 < len(ids["mixing"]) < len(ids["near_dedup"])
    enc = encoder(public_tokenizers.path("byte_bpe_50k.json"))
    assert sum(r.length for r in left["packing"]) == sum(len(enc.ids(r.text)) + 1 for r in left["mixing"])
    assert {r.doc_id for r in left["packing"]} == {r.doc_id for r in left["mixing"]}


def test_run_on_an_empty_table(spark, tmp_dir):
    spark.createDataFrame([], T.StructType.fromDDL(SCHEMA)).write.parquet(f"{tmp_dir}/documents.parquet")
    assert corpus_pipeline.run(spark, tmp_dir).count() == 0
