"""Quality rules as a short-circuit cascade.

Each rule's cost and the share of documents that it rejects are measured on a bounded sample;
the cascade asks the rules in the order of rejections per cost and stops at the first that
rejects. The order changes what is computed, never what is kept. Native expressions only.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.llm.common import SPACES, bound, staged

SAMPLE = 500  # rows on which the rules are timed
SYMBOLS = "#*$%&|<>"


def words(text: Column) -> Column:
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, SPACES, "")) > 0)


def word_chars(text: Column) -> Column:
    return F.length(F.translate(text, SPACES, "")).cast("long")


def n_symbols(text: Column) -> Column:
    return (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long")


def n_dup_lines(text: Column) -> Column:
    return bound(lines(text), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def n_repeat_words(w: Column) -> Column:
    """Words in 3-word windows that the text has twice or more; each word counts once."""

    def ranked(w: Column) -> Column:
        """Windows sorted by hash, so that equal ones are neighbours."""
        at = F.sequence(F.lit(0), F.size(w) - 3)
        return F.sort_array(F.transform(at, lambda k: F.struct(F.xxhash64(F.get(w, k), F.get(w, k + 1), F.get(w, k + 2)).alias("h"), k.alias("k"))))

    def covered(s: Column) -> Column:
        own = lambda k: F.get(s, k)["h"]
        twice = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda k: (own(k) == own(k - 1)) | (own(k) == own(k + 1)))
        return F.size(F.array_distinct(F.flatten(F.transform(twice, lambda k: F.array(F.get(s, k)["k"], F.get(s, k)["k"] + 1, F.get(s, k)["k"] + 2)))))

    return bound(w, lambda w: F.when(F.size(w) < 4, F.lit(0)).otherwise(bound(ranked(w), covered))).cast("long")


#: name -> what it rejects, from the text and its words. The first two are the base rules.
RULES: dict[str, Callable[[Column, Column], Column]] = {
    "few_words": lambda text, w: F.size(w) < 50,
    "repeated_windows": lambda text, w: 100 * n_repeat_words(w) > 50 * F.size(w),
    "symbols": lambda text, w: 100 * n_symbols(text) > 10 * word_chars(text),
    "repeated_lines": lambda text, w: bound(lines(text), lambda x: 100 * (F.size(x) - F.size(F.array_distinct(x))) > 50 * F.size(x)),
    "long_words": lambda text, w: word_chars(text) > 40 * F.size(w),
    "short_words": lambda text, w: 10 * word_chars(text) < 15 * F.size(w),
}
BASE = ("few_words", "repeated_windows")


def cascade(text: Column, w: Column, order: list[str]) -> Column:
    """The first rule that rejects, or null: CASE computes a rule only where those before it pass."""
    out = None
    for name in order:
        out = (out.when if out is not None else F.when)(RULES[name](text, w), F.lit(name))
    return out.otherwise(F.lit(None).cast("string"))


def sampled(docs: DataFrame, sample: int) -> DataFrame:
    """``sample`` texts, the first by hash, with their words split. Hashes are chosen first, so no more texts than these are moved."""
    hashed = docs.select(F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    first = hashed.select("h").distinct().orderBy("h").limit(sample)
    texts = hashed.join(F.broadcast(first), "h", "left_semi").dropDuplicates(["h"])  # ``sample`` rows
    return staged(texts.select("text", words(F.col("text")).alias("w")), "rules-sample")


def ordered(docs: DataFrame, sample: int = SAMPLE, seconds: Callable[[], float] = time.perf_counter) -> list[tuple[str, float, float]]:
    """(rule, seconds on the sample, share rejected), in cascade order: rejections per second, descending.

    Each rule runs over the sample several times; the first run, which compiles it, isn't timed, and the
    quickest of the others less that of a rule that does nothing is its cost.
    """
    held = sampled(docs, sample).repartition(1).cache()  # bounded
    n = max(1, held.count())

    def cost(rule: Column) -> tuple[float, int]:
        took = []
        for _ in range(4):
            began = seconds()
            rejected = held.agg(F.sum(rule.cast("long"))).first()[0] or 0
            took.append(seconds() - began)
        return min(took[1:]), rejected

    nothing, _ = cost(F.length("text") < 0)
    found = []
    for name, rule in RULES.items():
        took, rejected = cost(rule(F.col("text"), F.col("w")))
        found.append((name, max(1e-4, took - nothing), rejected / n))
    held.unpersist()
    return sorted(found, key=lambda x: (-x[2] / x[1], x[0]))


def keep(docs: DataFrame, order: list[str] | None = None) -> DataFrame:
    """The rows of ``docs`` that pass all rules, with the columns they came with.

    A null text has no words and is rejected, as an empty one is. Every row gets a verdict of its own,
    so ties and repeated rows change nothing; an empty table gives no rows. ``order`` skips the sampling.
    """
    order = order or [name for name, _, _ in ordered(docs)]
    text = F.coalesce("text", F.lit(""))
    return docs.filter(bound(words(text), lambda w: cascade(text, w, order).isNull()))


def report(docs: DataFrame, order: list[str] | None = None) -> DataFrame:
    """doc_id, the base measures, base_failed and kept of every row; see keep()."""
    order = order or [name for name, _, _ in ordered(docs)]
    rest = [name for name in order if name not in BASE]
    text = F.coalesce("text", F.lit(""))

    def judged(w: Column, repeats: Column) -> Column:
        failed = (F.size(w) < 50) | (100 * repeats > 50 * F.size(w))
        kept = F.when(failed, False).otherwise(cascade(text, w, rest).isNull())
        return F.struct(F.size(w).cast("long").alias("n_words"), repeats.alias("n_repeat_words"), failed.alias("base_failed"), kept.alias("kept"))

    one = bound(words(text), lambda w: bound(n_repeat_words(w), lambda repeats: judged(w, repeats)))
    d = docs.select("doc_id", word_chars(text).alias("word_chars"), n_symbols(text).alias("n_symbols"), n_dup_lines(text).alias("n_dup_lines"), one.alias("m"))
    return d.select("doc_id", "m.n_words", "word_chars", "n_symbols", "n_dup_lines", "m.n_repeat_words", "m.base_failed", "m.kept")


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
g AS (SELECT *, list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) AS gs FROM w),
p AS (SELECT doc_id, text, unnest(gs) AS gram, unnest(range(1, len(gs) + 1)) AS i FROM g),
t AS (SELECT doc_id, text, i, count(*) OVER (PARTITION BY doc_id, text, gram) AS n FROM p),
c AS (SELECT doc_id, text, count(DISTINCT i + k) AS covered FROM t, (SELECT unnest([0, 1, 2]) AS k) WHERE n > 1 GROUP BY ALL),
m AS (SELECT g.doc_id, len(ws)::BIGINT AS n_words,
        coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
        length(regexp_replace(g.text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, len(ls) AS n_lines,
        coalesce(covered, 0)::BIGINT AS n_repeat_words
      FROM g LEFT JOIN c ON g.doc_id IS NOT DISTINCT FROM c.doc_id AND g.text = c.text)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 100 * n_symbols > 10 * word_chars
       OR 100 * n_dup_lines > 50 * n_lines OR word_chars > 40 * n_words OR 10 * word_chars < 15 * n_words) AS kept
FROM m
"""
