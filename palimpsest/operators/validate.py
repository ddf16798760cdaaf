"""Batch validation: what offends is counted or named, and nothing is silently dropped or cut."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.fieldmap import FieldMap
from palimpsest.functions.keys import grouped


class BatchRefused(ValueError):
    """A whole batch is refused, naming the first offender."""


def array_check(df: DataFrame, body: str = "body") -> DataFrame:
    """``df`` with body_state: missing, malformed, not_array or array ([] is an array).

    A body too large for a variant (Spark 4.0: 16 MB, later: 128 MB) is an array if the parser gets through it as one.
    """
    v = F.try_parse_json(body)
    large = (F.octet_length(body) > 16_000_000) & v.isNull() & F.json_array_length(body).isNotNull()
    # Of valid JSON the first character tells; a schema would be made of all elements.
    listed = F.ltrim(F.col(body), F.lit(" \t\r\n")).startswith("[")
    state = F.when(F.col(body).isNull(), "missing").when(large, "array").when(v.isNull(), "malformed").when(listed, "array").when(F.schema_of_variant(v).startswith("ARRAY"), "array").otherwise("not_array")
    return df.withColumn("body_state", state)


def incomplete_keys(df: DataFrame, keys: list[str], ordinal: str) -> DataFrame:
    """Per key part: how many rows lack it and the first of them."""
    missing = [F.struct(F.lit(k).alias("key_part"), F.col(k).isNull().alias("missing")) for k in keys]
    return df.select(ordinal, F.explode(F.array(*missing)).alias("m")).filter("m.missing").groupBy("m.key_part").agg(F.count("*").alias("n"), F.min(ordinal).alias("first_ordinal"))


def too_wide(df: DataFrame, keys: list[str], widths: dict[str, int]) -> DataFrame:
    """One row per value longer than its column (trailing blanks don't count): keys, column, length, width."""
    cells = [F.struct(F.lit(c).alias("column"), F.length(F.rtrim(F.col(c))).alias("length"), F.lit(w).alias("width")) for c, w in widths.items()]
    return df.select(*keys, F.explode(F.array(*cells)).alias("x")).filter("x.length > x.width").select(*keys, "x.*")


def declared_widths(tables: dict[str, DataFrame], fields: FieldMap) -> DataFrame:
    """too_wide() for every table of a field map: table, column, n, longest and width of the columns that have longer values."""
    widths = {fields.name: fields.widths} | {c.name: {f.column: f.width for f in c.fields if f.width} for c, *_ in fields.walk()}
    found = [too_wide(tables[name], [], own).select(F.lit(name).alias("table"), "*") for name, own in widths.items() if own]
    return reduce(DataFrame.unionByName, found).groupBy("table", "column", "width").agg(F.count("*").alias("n"), F.max("length").alias("longest"))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once; a batch with any is refused, never deduplicated."""
    return grouped(df, keys, F.count("*").alias("n")).filter("n > 1")


def refuse_duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    worst = duplicate_keys(df, keys).orderBy(F.desc("n"), *keys).limit(1).collect()
    if worst:
        raise BatchRefused(f"{worst[0].n} elements share a key: {worst[0].asDict()}")
    return df


def outside_sets(df: DataFrame, sets: dict[str, list[str]]) -> DataFrame:
    """(column, value, n) of values that their declared set lacks."""
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).alias("value"), (F.col(c).isNotNull() & ~F.col(c).isin(v)).alias("bad")) for c, v in sets.items()]
    return df.select(F.explode(F.array(*cells)).alias("x")).filter("x.bad").groupBy("x.column", "x.value").agg(F.count("*").alias("n"))


def rule_violations(df: DataFrame, ordinal: str, rules: dict[str, Column]) -> DataFrame:
    """Per rule: violating rows and the first of them."""
    found = [F.when(c, F.lit(name)) for name, c in rules.items()]
    return df.select(ordinal, F.explode(F.array_compact(F.array(*found))).alias("rule")).groupBy("rule").agg(F.count("*").alias("n"), F.min(ordinal).alias("first_ordinal"))


def foreign_windows(df: DataFrame, window: str, location: str, scope: str) -> DataFrame:
    """Windows with any element of another location (blank passes): they are refused whole."""
    c = F.upper(F.trim(F.coalesce(location, F.lit(""))))
    return df.groupBy(window).agg(F.sum(((c != "") & (c != scope)).cast("long")).alias("foreign")).filter("foreign > 0")


def foreign_entities(df: DataFrame, asked: str, named: str) -> DataFrame:
    """Requests whose reply names another entity: refused for that entity alone."""
    return df.groupBy(asked).agg(F.sum((F.col(named) != F.col(asked)).cast("long")).alias("foreign_rows")).filter("foreign_rows > 0")


def unexpected(walked: DataFrame, known: list[str]) -> DataFrame:
    """Property names at any depth that the known ones, whatever their case, don't include; reported, never fatal."""
    return walked.filter(~F.lower("key").isin(*(k.lower() for k in known))).groupBy("key").agg(F.count("*").alias("n"))


def unreadable(df: DataFrame, read: dict[str, Column]) -> DataFrame:
    """(column, value, n) of values that a lenient reading can't make out; never taken for false."""
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"), v.isNull().alias("bad")) for c, v in read.items()]
    return df.select(F.explode(F.array(*cells)).alias("x")).filter("x.bad").groupBy("x.column", "x.value").agg(F.count("*").alias("n"))


def missing_nested_codes(elements: DataFrame, key: str, nested: str) -> DataFrame:
    """(key, pos) of nested elements without a code."""
    return elements.select(key, F.posexplode(nested).alias("pos", "element")).filter("element.code is null or trim(element.code) = ''").select(key, "pos")
