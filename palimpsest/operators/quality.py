"""Data-quality observations and integrity reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def observed(rows: DataFrame, kind: str, severity: str, keys: list[str], value: Column) -> DataFrame:
    """``rows`` in the form of the observation table."""
    return rows.select(F.lit(kind).alias("type"), F.lit(severity).alias("severity"), *keys, value.alias("value"))


def collections_absent(sent: DataFrame, stored: dict[str, DataFrame], keys: list[str]) -> DataFrame:
    """Collections that no parent of the batch sent although live rows are stored for these parents: name and number of rows.

    ``sent``: the parents' keys and one boolean per collection.
    """
    each = [F.struct(F.lit(c).alias("collection"), F.coalesce(F.col(c), F.lit(False)).alias("sent")) for c in stored]
    none = sent.select(F.explode(F.array(*each)).alias("x")).groupBy("x.collection").agg(F.max("x.sent").alias("any")).filter("not any").select("collection")
    live = [t.filter("not is_deleted").join(sent.select(*keys).distinct(), keys, "left_semi").agg(F.count("*").alias("stored")).select(F.lit(c).alias("collection"), "stored") for c, t in stored.items()]
    return reduce(DataFrame.unionByName, live).filter("stored > 0").join(none, "collection", "left_semi")


def ambiguous_in_mirror(versions: DataFrame, pair: list[str], claim: str = "current") -> DataFrame:
    """Pairs with more than one live current version."""
    return versions.filter("not is_deleted").filter(claim).groupBy(*pair).agg(F.count("*").alias("currents")).filter("currents > 1")


def stranded_by_closed(stranded: DataFrame, runs: tuple[str, ...] = ("Succeeded", "PartiallySucceeded")) -> DataFrame:
    """Per run that closed well: how many of its rows were left behind."""
    return stranded.filter(F.col("run_status").isin(*runs)).groupBy("run", "run_status").agg(F.count("*").alias("rows"))


def conditional_required(rows: DataFrame, kind: str, kinds: tuple[str, ...], column: str) -> DataFrame:
    """Rows of the given kinds that lack a column which these kinds need."""
    return rows.filter(F.col(kind).isin(*kinds) & (F.col(column).isNull() | (F.trim(F.col(column)) == "")))


def with_status(observations: DataFrame, status: DataFrame, keys: list[str]) -> DataFrame:
    """Observations with the status row of the same run and version, where there is one."""
    return observations.join(status.groupBy("run", *keys).agg(F.max("status_id").alias("status_id")), ["run", *keys], "left")


def lineages_without_current(versions: DataFrame, entity: str, kind: str, claim: str = "current", seq: str = "seq") -> DataFrame:
    """Lineages without a current version, and whether the entity has a current one of another type."""
    claims = F.sum(F.coalesce(F.col(claim), F.lit(False)).cast("long"))
    each = versions.groupBy(entity, kind).agg(F.count("*").alias("versions"), F.max(seq).alias("last_seq"), claims.alias("claims"))
    anywhere = each.filter("claims > 0").select(entity).distinct().withColumn("elsewhere", F.lit(True))
    return each.filter("claims = 0").join(anywhere, entity, "left").select(entity, kind, "versions", "last_seq", F.coalesce("elsewhere", F.lit(False)).alias("elsewhere"))


def several_currents(versions: DataFrame, pair: list[str], claim: str = "current") -> DataFrame:
    """The current versions of lineages that have several."""
    own = versions.filter(claim)
    return own.join(own.groupBy(*pair).agg(F.count("*").alias("currents")).filter("currents > 1"), pair)


def null_audit(status: DataFrame, columns: list[str]) -> DataFrame:
    """Per status and outcome: rows, and how many lack each column."""
    return status.groupBy("status", "outcome").agg(F.count("*").alias("rows"), *(F.sum(F.col(c).isNull().cast("long")).alias(f"no_{c}") for c in columns))


def stored_and_visible(versions: DataFrame, entity: str, kind: str, synthetic: Column) -> DataFrame:
    """Per entity: live versions, lineages, rows in the default read, and whether it is a test entity."""
    live = versions.filter("not is_deleted").withColumn("synthetic", synthetic)
    return live.groupBy(entity, "synthetic").agg(F.count("*").alias("versions"), F.count_distinct(kind).alias("lineages"), F.sum(F.coalesce("current", F.lit(False)).cast("long")).alias("visible"))


def never_updated(rows: DataFrame, created: str, modified: str, keys: list[str]) -> DataFrame:
    return rows.select(*keys, F.when(F.col(created).eqNullSafe(F.col(modified)), "never updated").otherwise("modified").alias("stamp"))


#: Marks of credentials and of serialised payloads in log text, in lower case.
CREDENTIALS = ("apikey", "api_key", "api-key", "x-api-id", "x-api-key", "bearer", "authorization", "password", "pwd=", "client_secret", "secret=")
PAYLOADS = ('[{"', '"handlerid":"', '"firstname":"', '"lastname":"', '"email":"')


def privacy_scan(logs: DataFrame, keys: list[str], columns: list[str], width: int = 4000) -> DataFrame:
    """(keys, column, finding): credentials, payload text or over-long values in free-text columns."""
    cells = F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.lower(F.col(c)).alias("text")) for c in columns))).alias("x")
    has = lambda tokens: reduce(Column.__or__, (F.col("x.text").contains(t) for t in tokens))
    finding = F.array_compact(F.array(F.when(has(CREDENTIALS), "credential"), F.when(has(PAYLOADS), "payload"), F.when(F.length("x.text") > width, "too_long")))
    return logs.select(*keys, cells).select(*keys, "x.column", F.explode(finding).alias("finding"))


def diverged(stored: DataFrame, raw: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """(keys, column, stored, sent, sent_length) where a stored text isn't what the raw record says: the truncation detector."""
    s, r = stored.alias("s"), raw.alias("r")
    cells = [F.struct(F.lit(c).alias("column"), F.col(f"s.{c}").alias("stored"), F.col(f"r.{c}").alias("sent")) for c in columns]
    d = s.join(r, [F.col(f"s.{k}") == F.col(f"r.{k}") for k in keys]).select(*(F.col(f"s.{k}") for k in keys), F.explode(F.array(*cells)).alias("x"))
    return d.filter(~F.col("x.stored").eqNullSafe(F.col("x.sent"))).select(*keys, "x.*", F.length("x.sent").alias("sent_length"))
