"""What the operators of this subpackage share: reading tables, written intermediate tables, text as bytes."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters that separate words: the blank and U+0009 to U+000D. bytes.split() without argument splits at the same six.
BLANKS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or in a plain local session a folder of its own."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    if not hasattr(spark, "_guildbook_folder"):
        spark._guildbook_folder = "file://" + tempfile.mkdtemp(prefix="spark-guildbook-", dir="/tmp")
    return spark._guildbook_folder


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh name under the shared folder; what is there goes when the session's JVM ends."""
    where = f"{shared_folder(spark)}/guildbook/{label}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(where)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    return where


#: Spark's setting to delete an execution's shuffle files as soon as it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write df once and read it back: cuts the lineage, so that a lost executor costs a file read and not the work before it. The
    shuffle files of the writing go when it has ended, as nothing will read them again."""
    spark, where = df.sparkSession, new_folder(df.sparkSession, label)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(where)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(where)
    out._guildbook_folder = where
    return out


def discard(*tables: DataFrame) -> None:
    """Delete staged tables from which all that was made is written too, so that nothing will read them again."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._guildbook_folder)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def unused(columns: list[str], *names: str) -> list[str]:
    """The names, each with a tail where a column has it, so that working columns can't clash with those of a table."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def same(*pairs) -> F.Column:
    """Null-safe equality of all given pairs of columns."""
    out = None
    for a, b in pairs:
        out = a.eqNullSafe(b) if out is None else out & a.eqNullSafe(b)
    return out


class Remembered(dict):
    """A bounded memory: when half of it is full it becomes the old half, whose entries come back when they are asked for."""

    def __init__(self, most: int):
        super().__init__()
        self.half, self.old = most // 2, {}

    def __missing__(self, key):
        found = self[key] = self.old[key]
        return found

    def fresh(self, keys) -> list:
        """Those of the keys that are not remembered."""
        return [k for k in set(keys) if k not in self and k not in self.old]

    def trim(self) -> None:
        if len(self) > self.half:
            self.old = dict(self)
            self.clear()
