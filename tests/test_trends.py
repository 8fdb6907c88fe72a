import datetime as dt

from jobsift.operators import trends as A


def _df(spark, days):
    return spark.createDataFrame([(d,) for d in days], "time_when_scraped timestamp_ntz")


def test_iso_week_at_year_end(spark):
    df = _df(spark, [dt.datetime(2024, 12, 30, 9), dt.datetime(2024, 12, 29, 9), dt.datetime(2021, 1, 1)])
    got = {(r.year, r.week): r.number_of_jobs_posted for r in A.jobs_per_week(df).collect()}
    assert got == {(2024, 1): 1, (2024, 52): 1, (2021, 53): 1}
    iso = {(r.year, r.week) for r in A.jobs_per_week(df, iso_year=True).collect()}
    assert iso == {(2025, 1), (2024, 52), (2020, 53)}


def test_padded_day_names(spark):
    df = _df(spark, [dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 3), dt.datetime(2024, 1, 3, 5)])
    rows = A.jobs_per_day(df).collect()
    assert [(r.day_of_week, r.number_of_jobs_posted) for r in rows] == [("Monday   ", 1), ("Wednesday", 2)]


def test_estimated_row_count_reads_no_columns(spark, tmp_dir):
    _df(spark, [dt.datetime(2024, 1, 1)] * 5).write.parquet(tmp_dir + "/t")
    df = A.estimated_row_count(spark, tmp_dir + "/t")
    assert df.collect()[0].estimate == 5
    assert "ReadSchema: struct<>" in df._jdf.queryExecution().executedPlan().toString()


def test_scale_settings():
    from jobsift.session import scale_settings
    s = scale_settings(100 * 2**40, cores=4000)
    assert int(s["spark.sql.shuffle.partitions"]) == 25 * 4000  # capped per core
    assert int(scale_settings(2 * 2**40, cores=1000)["spark.sql.shuffle.partitions"]) == 2 * 2**40 // 4 // (128 << 20)
    assert int(scale_settings(10 << 20, cores=8)["spark.sql.shuffle.partitions"]) == 16


def test_day_names_ignore_the_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Pacific/Apia")  # skipped 2011-12-30 entirely
    try:
        rows = A.jobs_per_day(_df(spark, [dt.datetime(2011, 12, 30, 12)])).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert [(r.date_only, r.day_of_week) for r in rows] == [(dt.datetime(2011, 12, 30), "Friday   ")]
    assert A.jobs_per_day(_df(spark, [dt.datetime(2024, 1, 1)]), as_date=True).collect()[0].date_only == \
        dt.date(2024, 1, 1)


def test_estimate_of_an_empty_store(spark, tmp_dir):
    from jobsift.sources import store as st
    from jobsift.schema import LISTING_COLUMNS
    empty = spark.createDataFrame([], ", ".join(f"{c} string" for c in LISTING_COLUMNS))
    st.append_listings(empty, tmp_dir + "/store", "0")
    assert A.estimated_row_count(spark, tmp_dir + "/store").collect()[0].estimate == 0


def test_effective_blocklist_is_the_intended_one_with_the_fused_pair():
    from jobsift.functions import rules
    i = rules.BLOCKED_COMPANIES_INTENDED.index("Boeing Intelligence & Analytics")
    fused = rules.BLOCKED_COMPANIES_INTENDED[i] + rules.BLOCKED_COMPANIES_INTENDED[i + 1]
    assert rules.BLOCKED_COMPANIES == (rules.BLOCKED_COMPANIES_INTENDED[:i] + [fused]
                                       + rules.BLOCKED_COMPANIES_INTENDED[i + 2:])
