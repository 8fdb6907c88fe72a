"""Result pages at scale."""

from pyspark.sql import functions as F

from jobsift import fixtures as fx
from jobsift.operators import cards as X


def _orders(spark, path, n):
    spark.range(n).select(F.col("id").alias("o_orderkey"), (F.col("id") % 50).alias("o_custkey"), (F.col("id") * 1.5 + 1000).alias("o_totalprice"),
                          F.lit("1997-01-01").cast("date").alias("o_orderdate")).write.parquet(f"{path}/orders.parquet")
    return path


def test_pages_of_a_site_are_not_joined_in_one_task(spark, tmp_dir):
    """As large tables are planned: nothing is small enough to be broadcast by its estimate."""
    sf = _orders(spark, tmp_dir + "/sf", 4000)
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        pages = fx.result_pages(spark, sf).filter(F.col("source") == "Dice")
        tasks = [r.n for r in pages.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
        assert sum(tasks) == 100 and len(tasks) > 1
        assert X.extract_dice_cards(pages).count() == 1000
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
