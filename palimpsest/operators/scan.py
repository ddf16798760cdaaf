"""Running maxima over long histories: two passes over ranges, so that one hot scope is many tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.functions.keys import key
from palimpsest.sources.workspace import written

PART = "__part"


def running_max(df: DataFrame, scope: list[str], order: list[str], value: Column, reset: Column | None = None, name: str = "before", parts: int | None = None) -> DataFrame:
    """``df`` with ``name``: the largest ``value`` of the earlier rows of its scope, since the last earlier row where ``reset``.

    Rows are ranged by (scope, order), so a scope of any size is cut into parts of about equal size. Each part makes its
    own running maximum; what the parts before it leave behind is carried over by one row a scope and part. A row that
    resets still sees the segment it ends, and begins the next with its own value. Null values count for nothing; ``order`` must be total within a scope.
    """
    n = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = df.withColumns({"__value": value, "__reset": F.coalesce(reset, F.lit(False)).cast("long") if reset is not None else F.lit(0).cast("long")})
    by = [key(df, c) for c in scope]
    ranged = written(own.repartitionByRange(n, *by, *order).withColumn(PART, F.spark_partition_id()), "ranged")
    by = [key(ranged, c) for c in scope]
    here = Window.partitionBy(*by, PART).orderBy(*order)
    local = ranged.withColumn("__segment", F.sum("__reset").over(here))
    upto = Window.partitionBy(*by, PART, "__segment").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = local.withColumn("__upto", F.max("__value").over(upto))
    local = local.withColumn("__last", F.lag(F.struct("__segment", "__upto")).over(here))
    # One row a scope and part: how many resets it has, and the maximum of its last segment.
    ends = local.groupBy(*(c.alias(f"__k{k}") for k, c in enumerate(by)), PART, "__segment").agg(F.max("__value").alias("tail"))
    keys = [f"__k{k}" for k in range(len(scope))]
    ends = ends.groupBy(*keys, PART).agg(F.max("__segment").alias("resets"), F.max_by("tail", "__segment").alias("tail"))
    along = Window.partitionBy(*keys).orderBy(PART)
    ends = ends.withColumn("upto", F.sum("resets").over(along))
    ends = ends.withColumn("so_far", F.max("tail").over(Window.partitionBy(*keys, "upto").orderBy(PART)))
    ends = ends.withColumn("__carry", F.lag("so_far").over(along)).select(*keys, F.col(PART).alias("__p"), "__carry")
    out = local.join(ends, [*(c.eqNullSafe(F.col(k)) for c, k in zip(by, keys)), F.col(PART) == F.col("__p")])
    last = F.col("__last")  # what the row before left behind
    before = F.when(last.isNull(), F.col("__carry")).when(last["__segment"] == 0, F.array_max(F.array(last["__upto"], "__carry"))).otherwise(last["__upto"])
    return out.select(*df.columns, before.alias(name))
