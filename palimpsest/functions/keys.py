"""Natural keys: text keys compare without case and trailing blanks, everywhere, as the system of record compares them.

Every join, grouping and window over a natural key goes through these functions. Rows keep the text they came with;
only what is compared is folded. Folded keys are plain text, so that they are hashed in joins and groups. Key parts that
are no text compare as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, GroupedData, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def folded(text: Column) -> Column:
    """The one form of all texts that the collation UTF8_LCASE_RTRIM takes for equal."""
    return F.translate(F.lower(F.rtrim(text)), "ς", "σ")


def key(df: DataFrame, name: str, alias: str | None = None) -> Column:
    """Column ``name`` of ``df`` as a key."""
    c = F.col(f"{alias}.{name}" if alias else name)
    return folded(c) if isinstance(df.schema[name].dataType, StringType) else c


def same(left: DataFrame, right: DataFrame, keys: list[str], l: str = "t", r: str = "b") -> list[Column]:  # noqa: E741
    """The join condition of two frames aliased ``l`` and ``r`` on ``keys``."""
    return [key(left, k, l) == key(right, k, r) for k in keys]


def joined(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``left`` joined with ``right``: all columns of ``left``, then those of ``right`` that are no keys."""
    out = left.alias("__l").join(right.alias("__r"), same(left, right, keys, "__l", "__r"), how)
    return out if how in ("left_semi", "left_anti") else out.select("__l.*", *(F.col(f"__r.{c}") for c in right.columns if c not in keys))


def semi(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    return joined(left, right.select(*keys), keys, "left_semi")


def anti(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    return joined(left, right.select(*keys), keys, "left_anti")


def grouped(df: DataFrame, keys: list[str], *aggregates: Column) -> DataFrame:
    """One row per key with the ``aggregates``; of several spellings the least stands for the key."""
    by: GroupedData = df.groupBy(*(key(df, k).alias(f"__{k}") for k in keys))
    return by.agg(F.min(F.struct(*keys)).alias("__key"), *aggregates).select(F.col("__key.*"), "*").drop("__key", *(f"__{k}" for k in keys))


def over(df: DataFrame, keys: list[str]) -> WindowSpec:
    return Window.partitionBy(*(key(df, k) for k in keys))
