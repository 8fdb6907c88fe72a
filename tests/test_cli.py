"""The command line end to end: pages -> listing files -> store -> screen and reports."""

from pyspark.sql import functions as F

from jobsift import fixtures
from jobsift.__main__ import main
from jobsift.sources import listing_csv as csvio
from jobsift.sources import store as st
from tests.conftest import SF_SMALL


def test_pages_to_reports(spark, tmp_dir):
    pages = fixtures.result_pages(spark, SF_SMALL)
    pages.write.parquet(tmp_dir + "/pages")
    main(["extract", tmp_dir + "/pages", tmp_dir + "/drop", "--run-time", "2024-07-01 04:00:00"], spark)
    files = {r.file_name for r in csvio.discover_listing_files(spark, tmp_dir + "/drop").collect()}
    assert files == {f"{s}_20240701_0400.csv" for s in ("LinkedIn", "Indeed", "BuiltIn", "Dice")}
    main(["load", tmp_dir + "/drop", tmp_dir + "/store", "--batch", "1", "--outcomes", tmp_dir + "/out"], spark)
    stored = st.read_listings(spark, tmp_dir + "/store")
    # LinkedIn cards without pay are skipped; 'search-N' ids are not numeric; nothing else is lost
    lst = fixtures.listings(spark, SF_SMALL)
    expected = lst.filter(~((F.col("source") == "LinkedIn") & (F.col("compensation").isNull()
                                                                 | F.col("listing_id").startswith("search-"))))
    assert stored.count() == expected.count()
    main(["screen", tmp_dir + "/store", "--out", tmp_dir + "/screen"], spark)
    main(["report", tmp_dir + "/store", "week", "--out", tmp_dir + "/week"], spark)
    main(["report", tmp_dir + "/store", "estimate", "--out", tmp_dir + "/est"], spark)
    assert spark.read.parquet(tmp_dir + "/est").collect()[0].estimate == expected.count()
    assert spark.read.parquet(tmp_dir + "/week").agg(F.sum("number_of_jobs_posted")).collect()[0][0] == expected.count()


def test_sql_over_the_store(spark, tmp_dir):
    from jobsift.plans.sql import jobs_per_year_sql, screen_sql
    from jobsift.operators import screen as S

    lst = fixtures.listings(spark, SF_SMALL)
    st.append_listings(lst, tmp_dir + "/store", "0")
    main(["sql", tmp_dir + "/store", screen_sql("job_listings"), "--out", tmp_dir + "/screen"], spark)
    got = spark.read.parquet(tmp_dir + "/screen")
    assert got.columns == S.screen_listings(lst).columns
    assert got.count() == S.screen_listings(lst).count()
    main(["sql", tmp_dir + "/store", jobs_per_year_sql("job_listings"), "--out", tmp_dir + "/years"], spark)
    assert spark.read.parquet(tmp_dir + "/years").agg(F.sum("number_of_jobs_posted")).collect()[0][0] == lst.count()
