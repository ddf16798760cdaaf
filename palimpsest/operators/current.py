"""Which version is current: the authority among claims, demotion of unlisted versions, and lineage reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.functions.keys import anti, grouped, joined, over, semi


def authority(versions: DataFrame, pair: list[str], claim: str = "current", received: str = "received", seq: str = "seq") -> DataFrame:
    """``versions`` with is_current: of those that claim it, the latest received (null last), then the highest sequence."""
    w = over(versions, [*pair, claim]).orderBy(F.col(received).desc_nulls_last(), F.col(seq).desc())
    return versions.withColumn("is_current", F.coalesce(F.col(claim), F.lit(False)) & (F.row_number().over(w) == 1))


def unlisted(mirror: DataFrame, listed: DataFrame, pair: list[str], seq: str = "seq") -> DataFrame:
    """Versions of a mentioned pair that the list lacks: they lose the flag, never the row."""
    return anti(semi(mirror, listed, pair), listed, [*pair, seq])


def ambiguous(versions: DataFrame, pair: list[str], claim: str = "current", received: str = "received", seq: str = "seq") -> DataFrame:
    """Pairs with several claims: their number, the claims as seq@date in order, and the sequence that wins."""
    own = F.array_sort(F.collect_list(F.struct(F.col(seq).alias("s"), F.coalesce(F.col(received).cast("string"), F.lit("(none)")).alias("d"))))
    wins = F.max_by(seq, F.struct(F.col(received).isNotNull(), received, seq)).alias("winner")
    found = grouped(versions.filter(claim), pair, F.count("*").alias("claims"), own.alias("x"), wins).filter("claims > 1")
    return found.withColumn("listed", F.array_join(F.transform("x", lambda c: F.concat(c["s"].cast("string"), F.lit("@"), c["d"])), ",")).drop("x")


def apply_authority(mirror: DataFrame, listed: DataFrame, pair: list[str], seq: str = "seq") -> DataFrame:
    """Live mirror versions whose flag changes: what the list's authority says, and false where a mentioned pair's list lacks them."""
    key = [*pair, seq]
    ruled = authority(listed, pair).select(*key, F.col("is_current").alias("ruled"))
    gone = unlisted(mirror, listed, pair).select(*key, F.lit(False).alias("ruled"))
    live = joined(mirror.filter("not is_deleted"), ruled.unionByName(gone), key)
    return live.filter(~F.col("current").eqNullSafe(F.col("ruled"))).select(*key, F.col("ruled").alias("current"))


def without_current(versions: DataFrame, entity: str, claim: str = "current") -> DataFrame:
    """Entities that have no current version of any type."""
    return grouped(versions, [entity], F.count("*").alias("versions"), F.max(F.coalesce(F.col(claim), F.lit(False))).alias("any")).filter("not any").drop("any")


def flags_by_lineage(versions: DataFrame, pair: list[str], claim: str = "current") -> DataFrame:
    """Per type: lineages with none, one and many current flags."""
    each = grouped(versions, pair, F.sum(F.coalesce(F.col(claim), F.lit(False)).cast("long")).alias("n"))
    n = lambda c: F.sum(c.cast("long"))
    return each.groupBy(pair[-1]).agg(n(F.col("n") == 0).alias("none"), n(F.col("n") == 1).alias("one"), n(F.col("n") > 1).alias("many"))


def density(versions: DataFrame, pair: list[str], seq: str = "seq") -> DataFrame:
    """(density, lineages): dense from 1, dense from elsewhere, or with gaps."""
    each = grouped(versions, pair, F.min(seq).alias("lo"), F.max(seq).alias("hi"), F.countDistinct(seq).alias("n"))
    kind = F.when(F.col("hi") - F.col("lo") + 1 != F.col("n"), "gaps").when(F.col("lo") == 1, "dense from 1").otherwise("dense")
    return each.groupBy(kind.alias("density")).agg(F.count("*").alias("lineages"))


def newest(versions: DataFrame, entity: str, claim: str = "current") -> DataFrame:
    """One version per entity: a current one else any; latest received, highest sequence, then the least type."""
    w = over(versions, [entity]).orderBy(F.coalesce(F.col(claim), F.lit(False)).desc(), F.col("received").desc_nulls_last(), F.col("seq").desc(), "kind")
    return versions.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn")
