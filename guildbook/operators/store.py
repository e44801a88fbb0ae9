"""Written intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; in a plain local session without it, a folder of its own."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not (spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    if not hasattr(spark, "_guildbook_store"):
        spark._guildbook_store = "file://" + tempfile.mkdtemp(prefix="spark-guildbook-", dir="/tmp")
    return spark._guildbook_store


def new_folder(spark: SparkSession, label: str) -> str:
    where = f"{shared_folder(spark)}/guildbook/{label}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(where)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    return where


def written(df: DataFrame, label: str) -> DataFrame:
    """df written once and read back, so that rounds don't grow one plan and a lost executor costs a file read."""
    where = new_folder(df.sparkSession, label)
    df.write.parquet(where)
    return df.sparkSession.read.schema(df.schema).parquet(where)
