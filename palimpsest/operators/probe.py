"""Profiles of raw documents: dates by shape, samples, disagreement between corpora, and what is absent, null or sent."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.functions.columns import json_shape
from palimpsest.operators import shred


def date_scan(walked: DataFrame) -> DataFrame:
    """(path, token, shape, n) of every property whose name ends in Date, whatever its case, from walk()."""
    d = walked.filter(F.lower("key").endswith("date")).withColumn("token", F.to_json("value"))
    return d.groupBy("path", "token").agg(F.count("*").alias("n")).withColumn("shape", json_shape(F.col("token")))


def samples(scanned: DataFrame, values: int = 8, paths: int = 64) -> DataFrame:
    """Of each path the first ``values`` tokens, and ``values`` more that are the first of their shape; the first ``paths`` paths."""
    first = F.row_number().over(Window.partitionBy("path", "shape").orderBy("token")) == 1
    d = scanned.withColumn("new", first).withColumn("nth", F.row_number().over(Window.partitionBy("path").orderBy("token")))
    late = F.sum((F.col("new") & (F.col("nth") > values)).cast("int")).over(Window.partitionBy("path").orderBy("token"))
    kept = d.withColumn("late", late).filter((F.col("nth") <= values) | (F.col("new") & (F.col("late") <= values)))
    listed = scanned.select("path").distinct().orderBy("path").limit(paths)
    return kept.join(listed, "path", "left_semi").select("path", "token", "shape")


def shape_disagreement(one: DataFrame, other: DataFrame) -> DataFrame:
    """Leaf names whose sets of shapes differ between two corpora."""
    leaf = F.element_at(F.split("path", r"\."), -1)
    sets = lambda d, name: d.groupBy(leaf.alias("leaf")).agg(F.array_join(F.array_sort(F.collect_set("shape")), ",").alias(name))
    return sets(one, "one").join(sets(other, "other"), "leaf").filter("one <> other")


def census(documents: DataFrame, body: str = "body") -> DataFrame:
    """Per path: documents (a row each) that send it, that send it as null, and that lack it."""
    total = documents.agg(F.count("*")).scalar()
    n = shred.profile(documents, body, by_key=False).select("path", F.col("full").alias("sent"), (F.col("docs") - F.col("full")).alias("null"))
    return n.withColumn("absent", total - F.col("sent") - F.col("null"))


def probed(summaries: DataFrame, entity: str, kind: str, seq: str, current: str) -> DataFrame:
    """Per named entity of a window: its versions (kind/seq by kind, then seq), how many rows they are, the current ones, and the deepest seq.

    Rows without an entity count in probe_totals() alone; a null kind is written as ?, and a null flag isn't current.
    """
    one = F.struct(F.coalesce(kind, F.lit("")).alias("a"), F.col(seq).alias("b"), F.concat_ws("/", F.coalesce(kind, F.lit("?")), F.col(seq).cast("string")).alias("c"))
    names = F.array_join(F.transform(F.array_sort(F.collect_list(one)), lambda x: x["c"]), ", ")
    counts = [F.count("*").alias("n_versions"), F.count_if(F.coalesce(current, F.lit(False))).alias("currents"), F.max(seq).alias("deepest")]
    return summaries.filter(F.col(entity).isNotNull()).groupBy(entity).agg(names.alias("versions"), *counts)


def probe_totals(summaries: DataFrame, entity: str, current: str) -> DataFrame:
    """One row: summaries, entities and current ones of a window."""
    return summaries.agg(F.count("*").alias("summaries"), F.count_distinct(entity).alias("entities"), F.count_if(F.coalesce(current, F.lit(False))).alias("currents"))


def deepest_histories(found: DataFrame, entity: str, most: int = 20) -> DataFrame:
    """The first ``most`` entities of probed() by deepest seq above 1, then id; a single row can name a long history."""
    return found.filter("deepest > 1").orderBy(F.desc("deepest"), entity).limit(most)
