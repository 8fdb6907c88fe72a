import pyarrow.parquet as pq

from jobsift.llm import langid

from .helpers import frame, odd_rows

SF = "/root/testdata/sf0.001"


def test_held_out_accuracy(spark):
    got = langid.language_of(spark.read.parquet(f"{SF}/documents.parquet")).collect()
    true = dict(zip(*(pq.read_table(f"{SF}/documents.parquet").column(c).to_pylist() for c in ("doc_id", "lang")), strict=True))
    held = [r for r in got if r.held_out]
    assert len(got) == len(true) and len(held) > 20
    assert sum(r.lang_pred == true[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def test_labels_of_the_held_out_fold_are_not_used(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    other = docs.withColumn("lang", langid.F.when(langid.fold(langid.F.col("doc_id"), 4) == 2, "zz").otherwise(docs.lang))
    one, two = (sorted(map(tuple, langid.language_of(d).collect())) for d in (docs, other))
    assert one == two


def test_odd_rows(spark):
    docs = frame(spark, odd_rows())
    got = langid.language_of(docs).collect()
    assert len(got) == len(odd_rows())
    by = {r.doc_id: r for r in got}
    assert [by[i].lang_pred for i in (1, 2, 3, 9)] == ["und"] * 4 and [by[i].score for i in (1, 2, 3, 9)] == [0.0] * 4
    assert by[8].lang_pred != "und"
    kept = langid.accepted(docs)
    assert kept.columns == docs.columns and not {1, 2, 3, 9} & {r.doc_id for r in kept.collect()}
    assert langid.language_of(docs.limit(0)).count() == 0
