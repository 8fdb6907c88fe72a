import datetime as dt

from pyspark.sql import functions as F

from jobsift.operators import screen as S
from jobsift.schema import LISTING_SCHEMA

T0 = dt.datetime(2024, 1, 1)


def _rows(spark, items):
    data = [(str(i), "LinkedIn", title, company, f"https://x/{i}", T0 + dt.timedelta(hours=i), loc, None)
            for i, (title, company, loc) in enumerate(items)]
    return spark.createDataFrame(data, LISTING_SCHEMA.simpleString().replace("not null", ""))


def test_whole_word_and_substring_rules(spark):
    df = _rows(spark, [("AI Engineer", "X", "Remote"), ("Email Developer", "X", "Remote"),
                       ("ML Developer", "X", "Remote"), ("Developer, HTML Tools", "X", "Remote"),
                       ("rpa bot builder", "X", "Remote"), ("Curiosity Developer", "X", "Remote"),
                       ("Junior Developer", "X", None), ("Junior Developer", "X", "Columbus, OH")])
    kept = [r.title for r in S.screen_listings(df).collect()]
    assert "AI Engineer" not in kept and "ML Developer" not in kept and "rpa bot builder" not in kept
    assert "Email Developer" in kept and "Developer, HTML Tools" in kept
    assert "Curiosity Developer" not in kept  # 'ios' is a substring rule
    assert kept.count("Junior Developer") == 1  # NULL location is not kept


def test_fused_literal_leaves_two_companies_unblocked(spark):
    df = _rows(spark, [("Developer", "Opinion Focus Panel LLC", "Remote"),
                       ("Developer", "Boeing Intelligence & Analytics", "Remote"),
                       ("Developer", "Canonical", "Remote"), ("Developer", None, "Remote")])
    assert {r.company for r in S.company_blocklist(df).collect()} == {
        "Opinion Focus Panel LLC", "Boeing Intelligence & Analytics"}
    assert S.company_blocklist(df, fix_list=True).count() == 0


def test_word_boundary_is_unicode_aware(spark):
    df = _rows(spark, [("éai tools", "X", "Remote"), ("ai-tools", "X", "Remote")])
    assert [r.title for r in S.title_word_exclusion(df).collect()] == ["éai tools"]


def test_screen_plan_is_one_scan_and_a_sort(spark):
    from jobsift import fixtures
    df = S.screen_listings(fixtures.listings(spark, "/root/testdata/sf0.001"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" not in plan
    assert plan.count("Scan parquet") == 1


def test_recency_bounds(spark):
    df = _rows(spark, [("a", "X", "Remote")] * 30)
    out = S.recency_filter(df, "2024-01-02 00:00:00")
    hours = sorted(r.time_when_scraped.hour + 24 * (r.time_when_scraped.day - 1) for r in out.collect())
    assert hours == list(range(1, 25))


def test_work_mode_rules(spark):
    df = _rows(spark, [("a", "X", "Remote"), ("a", "X", "Columbus, OH (Hybrid)"), ("a", "X", "Columbus, OH"),
                       ("a", "X", None)])
    for src in ("LinkedIn", "Indeed", "BuiltIn"):
        d = df.withColumn("source", F.lit(src))
        remote = {r.location for r in S.work_mode_filter(d, "Remote").collect()}
        local = {r.location for r in S.work_mode_filter(d, "Columbus, OH").collect()}
        assert remote == {"Remote"}
        if src == "Indeed":
            assert local == {"Remote", "Columbus, OH (Hybrid)", "Columbus, OH", None}
        else:
            assert local == {"Columbus, OH (Hybrid)", "Columbus, OH"}


def test_newest_first_rank_is_dense(spark):
    df = _rows(spark, [("a", "X", "Remote")] * 50).repartition(7)
    out = S.newest_first(df).collect()
    assert sorted(r["rank"] for r in out) == list(range(1, 51))
    by_rank = sorted(out, key=lambda r: r["rank"])
    assert [r.time_when_scraped for r in by_rank] == sorted((r.time_when_scraped for r in out), reverse=True)


def test_blocklist_is_pushed_to_the_parquet_scan(spark, tmp_dir):
    from jobsift import fixtures
    from jobsift.sources import store as st

    st.append_listings(fixtures.listings(spark, "/root/testdata/sf0.001"), tmp_dir + "/store", "0")
    df = S.screen_listings(st.read_listings(spark, tmp_dir + "/store"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Not(In(company" in plan
    assert df.count() == S.screen_listings(fixtures.listings(spark, "/root/testdata/sf0.001")).count()


def test_recency_accepts_dates_and_rejects_zoned_instants(spark):
    import pytest
    df = _rows(spark, [("a", "X", "Remote")] * 30)
    assert S.recency_filter(df, dt.date(2024, 1, 2)).count() == 24
    with pytest.raises(ValueError):
        S.recency_filter(df, dt.datetime(2024, 1, 2, tzinfo=dt.timezone.utc))


def test_ranks_over_many_ranges_with_nulls_and_ties(spark):
    """Every range count, hot times, NULL times and keys, repeated rows; the output is in order and only time and key are dealt."""
    import datetime as dt
    import random
    rng = random.Random(4)
    rows = [(None if rng.random() < 0.05 else dt.datetime(2024, 1, 1) + dt.timedelta(days=min(int(rng.expovariate(1)), 5)),
             None if rng.random() < 0.05 else f"k{rng.randint(0, 400)}", rng.choice(["a", "b", None]), i) for i in range(1500)]
    df = spark.createDataFrame(rows, "time_when_scraped timestamp_ntz, listing_id string, source string, n int").repartition(7)

    def place(r):
        t = r["time_when_scraped"]
        return (t is not None, -t.timestamp() if t else 0, r["listing_id"] is not None, r["listing_id"] or "", r["source"] is not None, r["source"] or "")

    old = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        for n in (1, 2, 3, 17, 40):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            got = S.newest_first(df).collect()
            assert [r["rank"] for r in got] == list(range(1, 1501)), n
            assert [place(r) for r in got] == sorted(map(place, df.collect())), n
            assert len({r["n"] for r in got}) == 1500
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
    assert S.newest_first(df.limit(0)).collect() == []
