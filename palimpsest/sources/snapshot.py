"""Mirror tables published together: bucket-partitioned Parquet in a new snapshot, then one manifest naming it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS = 20_000_000  # of a bucket, about
MOST = 100_000  # buckets at most


def publish(tables: dict[str, DataFrame], root: str, version: str, key: str, buckets: int | None = None) -> None:
    """Readers see all tables of a version or none: the manifest row is written last.

    The number of buckets follows the table's rows; several tasks share a bucket where a key is hot.
    """
    spark = next(iter(tables.values())).sparkSession
    for name, df in tables.items():
        n = buckets or min(MOST, 1 + df.count() // ROWS)
        bucketed = df.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(n)))
        bucketed.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{root}/snapshots/{version}/{name}")
    last = _published(spark, root).agg(F.max("seq")).first()[0] or 0
    spark.createDataFrame([(last + 1, version)], "seq long, version string").coalesce(1).write.mode("append").parquet(f"{root}/manifest")


def _published(spark: SparkSession, root: str) -> DataFrame:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/manifest")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], "seq long, version string")
    return spark.read.schema("seq long, version string").parquet(f"{root}/manifest")


def read(spark: SparkSession, root: str, name: str, version: str | None = None) -> DataFrame:
    """A table of ``version``, or of the one published last."""
    version = version or _published(spark, root).agg(F.max_by("version", "seq")).first()[0]
    return spark.read.parquet(f"{root}/snapshots/{version}/{name}").drop("bucket")
