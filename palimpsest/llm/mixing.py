"""Mixing sources to target weights: repetition rates per source, then whole copies and one drawn copy per document.

The only shuffles are two aggregates by source; a document's copies follow from its source's rate and a hash of
its own, so any task gives the same answer again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.llm.common import WORD_PATTERN, staged

WEIGHTS = (5, 2, 1)  # of the sources in order, repeating
SHARE = 1.5  # words of the mix, as a share of all words
CAP = 2  # the most copies of a document
SEEDS = 16  # draws that are tried for each source
UNIT = float(1 << 52)


def n_words(text: Column) -> Column:
    """Words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def draw_key(doc_id: Column, text: Column) -> Column:
    """What a row draws by: rows equal in id and text draw alike, rows that share an id (or have none) don't."""
    return F.md5(F.concat_ws("|", F.coalesce(doc_id.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit("")))))


def copies(rate: Column, seed: Column, key: Column) -> Column:
    """floor(rate) copies, and one more with the fraction's probability: a draw by hash of seed and key."""
    drawn = F.conv(F.substring(F.md5(F.concat_ws("|", seed.cast("string"), key)), 1, 13), 16, 10).cast("double")
    return (F.floor(rate) + F.when(drawn < (rate - F.floor(rate)) * UNIT, 1).otherwise(0)).cast("long")


def weighted(sources: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """``sources`` with ``weight`` by their order (code points, null last); ranks come from ranges, so no task sorts all sources."""
    last = F.col("source").isNull()
    parts = staged(sources.repartitionByRange(last, "source").withColumn("part", F.spark_partition_id()), "sources")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # over the number of ranges
    starts = parts.groupBy("part").count().withColumn("start", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
    own = F.row_number().over(Window.partitionBy("part").orderBy(last, "source")) - 1
    place = F.pmod(own + F.col("start"), F.lit(len(weights))).cast("int")
    return parts.join(starts, "part").withColumn("weight", F.get(F.array(*map(F.lit, weights)), place)).drop("part", "start")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """(source, source_size, target): ``share`` of all words dealt by weight.

    A target stops at ``cap`` times its source's size, and the excess goes to the others by weight until none is
    above: each round is one aggregate, whose level (words per unit of weight) grows until the stopped sources stay the same.
    """
    held = staged(weighted(sources, weights), "weighted")
    total, weight = held.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    most, stopped, level = F.col("source_size") * cap, 0, share * total / max(1, weight)
    while True:
        above = F.col("weight") * F.lit(level) > most
        n, size, rest = held.agg(F.count_if(above), F.coalesce(F.sum(F.when(above, most)), F.lit(0)), F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0))).first()
        if n == stopped or not rest:
            break
        stopped, level = n, (share * total - size) / rest
    return held.select("source", "source_size", F.least(F.col("weight") * F.lit(level), most.cast("double")).alias("target"))


def _rate() -> Column:
    return F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))


def plan(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: int = CAP, seeds: int = SEEDS) -> DataFrame:
    """(source, source_size, target, seed) from ``sized`` (source, size, key): the rates, and the seed each source draws with.

    Of ``seeds`` draws a source takes the one whose words come nearest its target (the first of equals), for a
    single draw over sources with few or long documents can be far off. One aggregate tries them all.
    """
    dealt = staged(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, cap), "targets")
    taken = [F.sum(copies(_rate(), F.lit(k), F.col("key")) * F.col("size")).alias(f"taken{k}") for k in range(seeds)]
    tried = _with(sized.select("source", "size", "key"), dealt).groupBy("source", "source_size", "target").agg(*taken)
    off = F.array_min(F.array(*(F.struct(F.abs(F.col(f"taken{k}") - F.col("target")).alias("off"), F.lit(k).alias("seed")) for k in range(seeds))))
    return staged(tried.select("source", "source_size", "target", off["seed"].alias("seed")), "mix-plan")


def _with(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``rows`` with what ``found`` says of their source; a null source is a source. Few sources are broadcast, many are joined."""
    r, f = rows.alias("r"), found.alias("f")
    return r.join(f, F.col("r.source").eqNullSafe(F.col("f.source"))).select("r.*", *(F.col(f"f.{c}") for c in found.columns if c != "source"))


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size and key of every row."""
    return docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), draw_key(F.col("doc_id"), F.col("text")).alias("key"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """The mixed corpus: each row of ``docs``, with all its columns, as often as its source's rate says, and ``copy`` from 1.

    Sources by code point, null last, have ``weights`` in turn. A document is never taken more than ``cap`` times.
    Null and empty texts have no words: they are taken at their source's rate and change no size; a source without
    words is left out. Repeated rows draw alike. An empty table gives an empty mix. A column ``copy`` of the input is
    replaced; others keep their names and values.
    """
    made = plan(staged(sizes(docs), "sizes"), weights, share, cap)
    held = docs.select(F.struct(*docs.columns).alias("row"), "source", draw_key(F.col("doc_id"), F.col("text")).alias("key"))
    n = copies(_rate(), F.col("seed"), F.col("key")).cast("int")
    taken = _with(held, made).withColumn("n", n).filter("n > 0")
    return taken.select(*(F.col("row")[c].alias(c) for c in docs.columns if c != "copy"), F.explode(F.sequence(F.lit(1), "n")).alias("copy"))


def report(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """doc_id, size, source_size, target, taken and copies of every row of ``docs``: what mix() takes of it. See mix()."""
    sized = staged(sizes(docs), "sizes")
    n = copies(_rate(), F.col("seed"), F.col("key"))
    return _with(sized, plan(sized, weights, share, cap)).select("doc_id", "size", "source_size", "target", (n * F.col("size")).alias("taken"), n.alias("copies"))


SQL = f"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
    md5(concat_ws('|', coalesce(doc_id::VARCHAR, ''), md5(coalesce(text, '')))) AS key
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
  FROM sized GROUP BY source),
filling AS (
  SELECT *, {SHARE} * sum(source_size) OVER () AS total,
    coalesce(sum({CAP} * source_size) OVER before, 0) AS stopped, sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS rest
  FROM sources
  WINDOW before AS (ORDER BY source_size * 1.0::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
  SELECT coalesce(min_by((total - stopped)::DOUBLE / rest::DOUBLE, source_size * 1.0::DOUBLE / weight), 1e300) AS level
  FROM filling WHERE (total - stopped)::DOUBLE / rest::DOUBLE * weight <= {CAP} * source_size),
targets AS (SELECT source, source_size, least(weight * level, ({CAP} * source_size)::DOUBLE) AS target FROM sources, level),
rates AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS rate FROM targets),
drawn AS (
  SELECT s.doc_id, s.size, r.source, r.source_size, r.target, k.seed,
    (floor(rate) + CASE WHEN ('0x' || md5(concat_ws('|', k.seed::VARCHAR, s.key))[1:13])::BIGINT::DOUBLE < (rate - floor(rate)) * {UNIT!r} THEN 1 ELSE 0 END)::BIGINT AS copies
  FROM sized s JOIN rates r ON s.source IS NOT DISTINCT FROM r.source CROSS JOIN (SELECT unnest(range({SEEDS})) AS seed) k),
best AS (
  SELECT source, seed, row_number() OVER (PARTITION BY source ORDER BY abs(sum(copies * size)::DOUBLE - any_value(target)), seed) AS place
  FROM drawn GROUP BY source, seed)
SELECT d.doc_id, d.size, d.source_size, d.target, d.copies * d.size AS taken, d.copies
FROM drawn d JOIN best b ON d.source IS NOT DISTINCT FROM b.source AND d.seed = b.seed AND b.place = 1
"""
