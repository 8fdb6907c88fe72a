"""Lists as tables: many search terms, a blocklist, catalog tables."""

import random

import pytest

from jobsift.operators import screen as S
from jobsift.operators import search as J
from jobsift.operators import trends as A

LISTINGS = "listing_id string, source string, title string, location string"
TERMS = "source string, idx long, keyword string, location string"


def _listings(spark, n, seed, hot=0):
    rng = random.Random(seed)
    words = ["Data", "Engineer", "AI", "ML", "C", "Go", "Senior", "Jr.", "Développeur", "Ingénieur", "Analyst", "x1", "QA", "(remote)", "İstanbul"]
    rows = [(str(i), rng.choice(["LinkedIn", "Indeed", "BuiltIn", "Dice"]), None if rng.random() < 0.03 else " ".join(rng.choices(words, k=rng.randint(0, 4))),
             rng.choice(["Remote", "Columbus, OH", "Columbus, OH (Hybrid)", None])) for i in range(n)]
    rows += [(f"h{i}", "Indeed", "Hot Data Title", "Remote") for i in range(hot)]
    return spark.createDataFrame(rows, LISTINGS)


def _terms(spark, seed, n):
    rng = random.Random(seed)
    parts = ["data", "Engineer", "ai", "ML", "c", "go", "gineer", "ata", "Ana", "é", "ngéni", "zzz", "QA", "x1", "(re", "r.", "hot", "title"]
    rows = [(rng.choice(["LinkedIn", "Indeed", "BuiltIn", "Dice"]), i, " ".join(rng.choices(parts, k=rng.randint(1, 3))),
             rng.choice(["Remote", "Columbus, OH"])) for i in range(n)]
    rows += [("Indeed", 9000, "", "Remote"), ("Dice", 9001, "   ", "Remote"), ("Indeed", 9002, None, "Remote"), (None, 9003, "data", "Remote"),
             ("Indeed", 9004, " data  data ", "Remote"), ("Indeed", 5, "data", "Remote"), ("Indeed", 5, "data", "Remote")]
    return spark.createDataFrame(rows, TERMS)


@pytest.mark.parametrize("seed", [1, 2])
def test_terms_by_index_equal_broadcast_terms(spark, seed):
    listings, terms = _listings(spark, 400, seed, hot=60), _terms(spark, seed, 150)
    want = sorted(map(tuple, J.search_term_match(listings, terms).collect()), key=str)
    got = sorted(map(tuple, J.search_term_match(listings, terms, broadcast_limit=0).collect()), key=str)
    assert len(want) > 300 and got == want
    assert J.search_term_match(listings.limit(0), terms, broadcast_limit=0).collect() == []
    assert J.search_term_match(listings, terms.limit(0), broadcast_limit=-1).collect() == []


def test_200_000_terms_and_a_hot_title(spark):
    """No task of the join with the listings holds a quarter of them, though half share one title."""
    n = 40_000
    listings = spark.range(n).selectExpr("CAST(id AS STRING) AS listing_id", "'Indeed' AS source",
                                         "CASE WHEN id % 2 = 0 THEN 'Hot Data Title' ELSE concat('Role ', lpad(CAST(id AS STRING), 6, '0')) END AS title",
                                         "'Remote' AS location")
    terms = spark.range(200_000).selectExpr("'Indeed' AS source", "id AS idx", "concat('role ', lpad(CAST(id AS STRING), 6, '0')) AS keyword", "'Remote' AS location")
    terms = terms.unionByName(spark.createDataFrame([("Indeed", 300_000, "hot title", "Remote")], TERMS))
    old = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for c, v in zip(old, ("false", "64", "-1")):
            spark.conf.set(c, v)
        out = J.search_term_match(listings, terms)  # beyond the broadcast limit by itself
        from pyspark.sql import functions as F
        sizes = [r["n"] for r in out.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
        assert sum(sizes) == n // 2 + n // 2 and max(sizes) < n / 4
        assert out.filter("term_idx = 300000").count() == n // 2
        assert out.filter("term_idx < 300000 AND lpad(listing_id, 6, '0') != substring(keyword, 6, 6)").count() == 0
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)


def test_blocklist_as_a_table(spark, monkeypatch):
    from jobsift.functions import rules
    df = spark.createDataFrame([(i, c) for i, c in enumerate([*sorted(rules.BLOCKED_COMPANIES_INTENDED)[:20], "Acme", "acme", None, "", "Canonical "])], "i int, company string")
    names = spark.createDataFrame([(n,) for n in rules.BLOCKED_COMPANIES] * 2, "name string")
    want = sorted(r.i for r in S.company_blocklist(df).collect())
    assert sorted(r.i for r in S.company_blocklist_table(df, names).collect()) == want
    monkeypatch.setattr(S, "BLOCKLIST_BROADCAST_LIMIT", 3)
    assert sorted(r.i for r in S.company_blocklist_table(df, names).collect()) == want
    assert S.company_blocklist_table(df, names.limit(0)).count() == df.count()  # NOT IN of nothing
    assert S.company_blocklist_table(df, names.unionByName(spark.createDataFrame([(None,)], "name string"))).count() == 0
    df.createOrReplaceTempView("bl_df"), names.createOrReplaceTempView("bl_names")
    assert sorted(r.i for r in spark.sql("SELECT * FROM bl_df WHERE company NOT IN (SELECT name FROM bl_names)").collect()) == want


def test_catalog_estimate_reads_no_file(spark, tmp_dir):
    spark.range(1234).write.parquet(tmp_dir + "/t")
    spark.sql(f"CREATE TABLE est USING parquet LOCATION '{tmp_dir}/t'")
    try:
        assert [r.estimate for r in A.estimated_table_rows(spark, "est").collect()] == [1234]  # footers: nothing analysed
        spark.sql("ANALYZE TABLE est COMPUTE STATISTICS NOSCAN")
        assert [r.estimate for r in A.estimated_table_rows(spark, "est").collect()] == [1234]
        spark.sql("ANALYZE TABLE est COMPUTE STATISTICS")
        df = A.estimated_table_rows(spark, "est")
        assert [r.estimate for r in df.collect()] == [spark.table("est").count()] and df.dtypes == [("estimate", "bigint")]
        assert "FileScan" not in df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.sql("DROP TABLE est")
