"""Reads: views, pages, history and ranked search. Only the requested sort is in the plan; counts are separate."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.functions.keys import semi


def history_view(records: DataFrame) -> DataFrame:
    return records.filter("not is_deleted")


def current_view(records: DataFrame) -> DataFrame:
    return history_view(records).filter("is_current")


def page(
    rows: DataFrame,
    sort: str,
    allowed: tuple[str, ...],
    tie: list,
    descending: bool = False,
    skip: int = 0,
    take: int = 50,
    equal: dict | None = None,
    between: dict | None = None,
    total: bool = False,
) -> DataFrame:
    """Rows skip+1 to skip+take of the filtered and sorted rows; nulls lowest, ties by ``tie``. skip and take are clamped.

    A filter whose value is None is no filter; ``between`` has (from, to), either may be None. ``total`` adds
    total_rows from a separate count. Unknown sort columns and inverted ranges are refused.
    """
    if sort not in allowed:
        raise ValueError(f"unknown sort column {sort}")
    for c, v in (equal or {}).items():
        rows = rows if v is None else rows.filter(F.col(c) == v)
    for c, (low, high) in (between or {}).items():
        if low is not None and high is not None and low > high:
            raise ValueError(f"the range of {c} is inverted")
        rows = rows if low is None else rows.filter(F.col(c) >= F.lit(low))
        rows = rows if high is None else rows.filter(F.col(c) <= F.lit(high))
    if total:
        rows = rows.withColumn("total_rows", rows.agg(F.count("*")).scalar())  # counted by the same query, which runs when it is read
    skip, take = min(max(skip, 0), 2_000_000_000), min(max(take, 1), 500)
    c = F.col(sort)
    return rows.orderBy(c.desc_nulls_last() if descending else c.asc_nulls_first(), *tie).offset(skip).limit(take)


HISTORY_SORTS = ("received", "seq", "kind", "amount", "current")


def history_page(rows: DataFrame, entity: str, value, kind: str | None = None, sort: str = "received", descending: bool = True, skip: int = 0, take: int = 50) -> DataFrame:
    """One entity's versions, latest received first unless told otherwise, with the total in every row (a window over one entity)."""
    if sort not in HISTORY_SORTS:
        raise ValueError(f"unknown sort column {sort}")
    own = rows.filter(F.col(entity) == value)
    own = (own if kind is None else own.filter(F.col("kind") == kind)).withColumn("total_rows", F.count("*").over(Window.partitionBy(entity)))
    c = F.col(sort)
    skip, take = min(max(skip, 0), 2_000_000_000), min(max(take, 1), 500)
    return own.orderBy(c.desc_nulls_last() if descending else c.asc_nulls_first(), "kind", "seq").offset(skip).limit(take)


def detail(records: DataFrame, ids: DataFrame, keys: list[str]) -> DataFrame:
    """The whole rows of the asked versions; unknown and deleted ones are simply absent."""
    return semi(history_view(records), ids, keys)


def matches(rows: DataFrame, term: str, ident: str, name: str, place: str) -> DataFrame:
    """Matches with match_rank 1 to 7 and match_field.

    A term shaped like an id (two letters, a digit, then letters or digits) is looked up as an id prefix
    alone; any other is contained in id, name or place. Case doesn't matter and nothing is a wildcard.
    """
    t = term.strip("\t\n\r ").lower()
    if len(t) < 2:
        raise ValueError("a search term has two characters at least")
    i, n, p = (F.lower(F.col(c)) for c in (ident, name, place))
    shaped = t.isascii() and t[:2].isalpha() and t[2:3].isdigit() and t.isalnum()
    found = rows.filter(i.startswith(t)) if shaped else rows.filter(i.contains(t) | n.contains(t) | p.contains(t))
    rank = F.when(i == t, 1).when(i.startswith(t), 2).when(i.contains(t), 3).when(n.startswith(t), 4).when(n.contains(t), 5).when(p.startswith(t), 6).otherwise(7)
    field = F.when(F.col("match_rank") <= 3, "id").when(F.col("match_rank") <= 5, "name").otherwise("place")
    return found.withColumn("match_rank", rank).withColumn("match_field", field)


def search(rows: DataFrame, term: str, ident: str, name: str, place: str, key: str, skip: int = 0, take: int = 25) -> DataFrame:
    """A page of matches() by rank, name and key, 100 rows at most, with the number of all matches."""
    found = matches(rows, term, ident, name, place)
    found = found.withColumn("total_rows", found.agg(F.count("*")).scalar())
    return found.orderBy("match_rank", F.col(name).asc_nulls_first(), key).offset(min(max(skip, 0), 2_000_000_000)).limit(min(max(take, 1), 100))
