"""Reproducible sharding: a Feistel permutation of the global row numbers.

The rows are numbered by (doc_id, checksum, size); a balanced Feistel network over the
product a * b >= n of two near-equal moduli permutes the numbers, and numbers outside
[0, n) walk along their cycle until they are inside. Shard and slot of any row number can
then be computed without looking at any other row. Native column expressions only.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.llm.common import staged

SHARDS = 24
ROUNDS = 6
PRIME = 2_147_483_647  # products of two residues stay within a signed 64-bit number
WALK = 64  # more steps than a cycle has outside for n <= 4096; beyond, outside is rarer than 1/64 a step


def _mix(x: Column, key: Column | int) -> Column:
    """A keyed hash of x in [0, PRIME); sums and products below 2^62 only, so any engine can repeat it."""
    y = (x % PRIME * (key * 48_271 % 1_000_003 + 7_919) + (key * 69_621 + 12_345)) % PRIME
    y = (y * y + (key * 40_692 + 1)) % PRIME
    y = y.bitwiseXOR(F.shiftright(y, 15))
    return (y * 1_103_515_245 + key) % PRIME


def _key(seed: int, k: Column | int) -> Column | int:
    return k % ROUNDS + (seed * 131 + 1)


def moduli(n: int) -> tuple[int, int]:
    a = max(1, isqrt(n - 1) + 1) if n else 1
    return a, max(1, -(-n // a))


def permuted(df: DataFrame, x: str, n: int, seed: int = 42) -> DataFrame:
    """``df`` with ``place``, where row number ``x`` in [0, n) comes to stand.

    x = left * b + right; each round adds a keyed hash of one half to the other, which is a
    bijection of [0, a * b). The first pass is plain columns; the few numbers outside walk on.
    """
    a, b = moduli(n)
    d = df.withColumns({"l": F.floor(F.col(x) / b).cast("long"), "r": F.col(x) % b})
    for k in range(ROUNDS):
        moved, other, size = ("r", "l", b) if k % 2 else ("l", "r", a)
        d = d.withColumn(moved, (F.col(moved) + _mix(F.col(other), F.lit(_key(seed, k)))) % size)

    def step(s: Column, k: Column) -> Column:
        done = s["done"] | ((k % ROUNDS == 0) & (s["l"] * b + s["r"] < n))
        left = F.when(done | (k % 2 == 1), s["l"]).otherwise((s["l"] + _mix(s["r"], _key(seed, k))) % a)
        right = F.when(done | (k % 2 == 0), s["r"]).otherwise((s["r"] + _mix(s["l"], _key(seed, k))) % b)
        return F.struct(left.alias("l"), right.alias("r"), done.alias("done"))

    walk = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS * WALK)), F.struct("l", "r", F.lit(False).alias("done")), step, lambda s: F.when(s["done"], s["l"] * b + s["r"]))
    first = F.col("l") * b + F.col("r")
    lost = F.raise_error(F.lit("the permutation needs more steps")).cast("long")
    return d.withColumn("place", F.when(first < n, first).otherwise(F.coalesce(walk, lost))).drop("l", "r")


def numbered(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32 and a gapless global number from 0 in the order of these three.

    The scan position breaks ties, so that a key with a third of all rows is dealt to many tasks.
    """
    text = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    d = docs.select("doc_id", (F.length(text).cast("long") + 8).alias("size"), F.crc32(text).alias("text_crc32"), F.monotonically_increasing_id().alias("at"))
    order = ["doc_id", "text_crc32", "size", "at"]
    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    d = staged(d, "sizes")  # range bounds are sampled: what they cut must be fixed first
    d = d.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("doc_id", "size", "text_crc32", F.monotonically_increasing_id().alias("local"))
    d = staged(d, "numbered").withColumns({"part": F.shiftright("local", 33), "nth": F.col("local").bitwiseAND((1 << 33) - 1)})
    # One row per partition: the window below orders partitions, not documents.
    before = d.groupBy("part").agg(F.count("*").alias("n")).select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    return d.join(before, "part").select("doc_id", "size", "text_crc32", (F.col("before") + F.col("nth")).alias("row_number"))


def shard(docs: DataFrame, shards: int = SHARDS, seed: int = 42) -> DataFrame:
    """Deal all rows into shards under the law ``rows``: counts are at most one apart.

    Returns doc_id, size (UTF-8 bytes plus 8), text_crc32, law, shard, slot (gapless from 0 in each
    shard), grown_shard (null under this law) and row_number. Null texts count as empty, null and
    repeated ids are rows like any others, extra columns are ignored, an empty table gives no rows.
    """
    d = staged(numbered(docs), "rows")
    return permuted(d, "row_number", d.count(), seed).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        (F.col("place") % shards).cast("int").alias("shard"),
        F.floor(F.col("place") / shards).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "row_number",
    )
