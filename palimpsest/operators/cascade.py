"""One dependency tree for deletion, orphan checks and the census: records, their collections and the collections inside those.

The tree is the field map's. Every table carries the record's key, so a deletion is one semi-join per table whatever
its depth, and all rows get the same stamp.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.fieldmap import FieldMap
from palimpsest.functions.keys import anti, grouped, semi
from palimpsest.operators.merge import stamped
from palimpsest.sources.buckets import Change


def tree(fields: FieldMap, raw: bool = True) -> Iterator[tuple[str, str | None, list[str], list[str]]]:
    """(table, the table above it, its key, the key of the one above), deepest first, the record last."""
    keys = list(fields.keys)
    below = [(c.name, above.name if above else fields.name, own, own[:-1]) for c, above, own in fields.walk()]
    yield from sorted(below, key=lambda x: -len(x[2]))
    if raw:
        yield f"{fields.name}_raw", fields.name, keys, keys
    yield fields.name, None, keys, []


def deleted(tables: dict[str, DataFrame], fields: FieldMap, doomed: DataFrame, at: str, reason: str) -> dict[str, DataFrame]:
    """Every table of the tree with the live rows of the ``doomed`` records deleted, under one stamp and reason.

    Rows deleted before keep their stamp, so a second call stamps nothing; unknown records are no error.
    """
    keys = list(fields.keys)
    return {name: stamped(tables[name], doomed, keys, at, reason) for name, *_ in tree(fields) if name in tables}


def counts(before: dict[str, DataFrame], after: dict[str, DataFrame]) -> DataFrame:
    """(table, rows) that a deletion stamped."""
    one = lambda name, d, sign: d.agg((F.count_if("is_deleted") * sign).alias("rows")).select(F.lit(name).alias("table"), "rows")
    both = [one(name, d, sign) for name in after for d, sign in ((after[name], 1), (before[name], -1))]
    return reduce(DataFrame.unionByName, both).groupBy("table").agg(F.sum("rows").alias("rows"))


def changes(fields: FieldMap, doomed: DataFrame, reason: str) -> dict[str, Change]:
    """The same deletion as one commit into buckets: only the buckets of doomed live rows are written."""
    if len(reason.strip()) < 10:
        raise ValueError("a deletion needs a reason of ten characters")
    keys = list(fields.keys)
    touched = doomed.select(*keys).distinct()

    def plan(t: DataFrame) -> DataFrame:
        return semi(t.filter("not is_deleted"), touched, keys).withColumns({"is_deleted": F.lit(True), "action": F.lit("delete")})

    return {name: Change(own, touched, plan) for name, _, own, _ in tree(fields)}


def orphans(tables: dict[str, DataFrame], fields: FieldMap) -> DataFrame:
    """(table, orphans): live rows whose owner is deleted or isn't there, on every level; none after a complete cascade."""
    found = []
    for name, above, _, owner in tree(fields):
        if above and name in tables:
            lost = anti(tables[name].filter("not is_deleted"), tables[above].filter("not is_deleted"), owner)
            found.append(lost.agg(F.count("*").alias("orphans")).select(F.lit(name).alias("table"), "orphans"))
    return reduce(DataFrame.unionByName, found)


def census(tables: dict[str, DataFrame], fields: FieldMap) -> DataFrame:
    """The record's key, table, rows and live: how many rows each record has in each table of its tree, in one aggregation."""
    keys = list(fields.keys)
    rows = [tables[name].select(*keys, F.lit(name).alias("table"), "is_deleted") for name, above, *_ in tree(fields) if above and name in tables]
    return grouped(reduce(DataFrame.unionByName, rows), [*keys, "table"], F.count("*").alias("rows"), F.count_if(~F.col("is_deleted")).alias("live"))
