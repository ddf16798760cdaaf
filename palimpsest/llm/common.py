"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The separators and word pattern that the word-level operators use.
SPACES = " \t\n\x0b\x0c\r"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster shares between driver and executors (``spark.checkpoint.dir``).

    Only on one machine (a local master, as in tests) may it be unset: then a temporary folder is made and set.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


Codec = tuple[Callable[[DataFrame], DataFrame], Callable[[DataFrame], DataFrame]]


def staged(df: DataFrame, name: str, batch_rows: int | None = None, codec: Codec | None = None, **options: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    This cuts the lineage: what follows survives a lost executor without running
    the stages before it again, and several readers share one computation. ``options`` go to the writer.
    ``batch_rows`` bounds the rows of an Arrow batch while it is written, for tables with wide rows. With ``codec`` the
    first function makes what lies on disk, the second ``df`` from it again.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/staged/{name}-{uuid.uuid4().hex}"
    conf, before = "spark.sql.execution.arrow.maxRecordsPerBatch", None
    if batch_rows:
        before = spark.conf.get(conf)
        spark.conf.set(conf, batch_rows)
    pack, unpack = codec or (lambda x: x, lambda x: x)
    packed = pack(df)
    try:
        packed.write.options(**options).parquet(path)
    finally:
        if before:
            spark.conf.set(conf, before)
    return unpack(spark.read.schema(packed.schema).parquet(path))


def forget(*frames: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for df in frames:
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
        for path in {x.rpartition("/")[0] for x in df.inputFiles()}:
            found = jvm.org.apache.hadoop.fs.Path(path)
            found.getFileSystem(conf).delete(found, True)


def bit_set(bits: DataFrame, size: int) -> np.ndarray:
    """The bits of ``bits`` (column bit, from 0, below ``size``) as ``size`` / 8 bytes, whatever the input's size."""
    v = F.col("bit") + 1  # the bitmap functions count from 1: 32768 bits a bucket, buckets from 1
    found = bits.groupBy(F.bitmap_bucket_number(v).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(v)).alias("bits")).toArrow()
    out = np.zeros(size // 8, np.uint8)
    for bucket, own in zip(found.column(0).to_pylist(), found.column(1).to_pylist()):
        out[(bucket - 1) * 4096 : bucket * 4096] = np.frombuffer(own, np.uint8)
    return out


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once a row: a transform over one element.

    Unlike a column of its own, it stays so when the optimizer moves the expression into a filter.
    """
    return F.get(F.transform(F.array(value), lambda x: use(x)), F.lit(0))


def id_crc(doc_id: Column) -> Column:
    """crc32 of an id written as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def one_text(docs: DataFrame, *more: Column) -> DataFrame:
    """doc_id, text (the least by hash) and ``more`` aggregates: an id that many rows have is one row."""
    return docs.groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"), *more)


def texts_of(column: pa.Array) -> list[str]:
    """The strings of an Arrow column, null as the empty text."""
    return [x or "" for x in column.to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], text: int, most: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts in column ``text`` have about ``most`` bytes each, one row at least."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        begin = held = 0
        for k, size in enumerate(sizes.tolist()):
            if held and held + size > most:
                yield batch.slice(begin, k - begin)
                begin, held = k, 0
            held += size
        if begin < batch.num_rows:
            yield batch.slice(begin)
