"""Tables that a job writes between its steps, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CODEC = "zstd"  # of the tables that are written: bodies and hashes take little more than half of what snappy needs
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of an action that runs inside are deleted when it ends, not when the driver's garbage is collected.

    For steps whose results are written: nothing reads their shuffles a second time.
    """
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; only a local master may leave it unset, and then gets a temporary folder."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, *partitions: str) -> DataFrame:
    """``df`` written and read back: what follows survives a lost executor without computing it again, and in the same order of parts."""
    path = new_folder(df.sparkSession, name)
    with brief_shuffles(df.sparkSession):
        df.write.option("compression", CODEC).partitionBy(*partitions).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(*frames: DataFrame) -> None:
    """Delete written() tables that nothing reads any more."""
    for df in frames:
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
        for path in df.inputFiles():
            folder = jvm.org.apache.hadoop.fs.Path(path).getParent()
            while "=" in folder.getName():
                folder = folder.getParent()
            if folder.getFileSystem(conf).delete(folder, True):
                break
