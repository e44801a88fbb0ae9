"""Derived tables are made by as many tasks as run at once, though their rows come from one file."""

from pyspark.sql import functions as F

from guildbook.plans.frames import FRAMES, SHORT, SOURCES, frame

SF = "/root/testdata/sf0.01"


def test_pages_of_one_file_are_dealt_over_the_tasks(spark):
    cores = spark.sparkContext.defaultParallelism
    for name in ("sites", "companies", "directories", "contract_records"):
        assert set(SOURCES[name]) <= set(SHORT)
        sizes = [r["n"] for r in frame(spark, SF, name).groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
        assert len(sizes) == cores and max(sizes) < 2 * min(sizes), (name, sizes)
    assert FRAMES.keys() == SOURCES.keys()
