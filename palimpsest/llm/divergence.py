"""Source divergence audit: which sources of a language speak unlike the others, over the terms that enough documents have.

Terms are found by iceberg prefix refinement. A pass counts, for each language, the documents of every term prefix of a
few bytes; prefixes of too few documents go, and the next pass extends the others to twice the length, until all that
are left are whole terms. A prefix has at least as many documents as any term that begins with it, so none is lost;
and the long tail of rare terms is never shuffled as text. Between passes travels a bitmap of fixed size, which may let
more through, never less: the last pass counts exactly.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.llm.common import bit_set, bound, slices, staged
from palimpsest.llm.hashing import mix, span_hashes

LEAST = 10  # documents of a kept term
FIRST = 4  # bytes of the first prefixes; doubled each pass
TOP = 10
BITS = 1 << 25
SLICE = 8_000_000  # bytes of text that a task looks at together
CELLS = 1 << 20  # terms times sources computed at once
SCALE = 1_000_000_000
END = b"\0"  # ends a whole term; no term contains it
#: The bytes of a term (letters, and all beyond ASCII), A-Z as a-z; others part terms and are 0 here.
TERM_BYTES = np.array([c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 0 for c in range(256)], np.uint8)


def _bytes(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary array, end to end, and where each value begins in them (and the last ends)."""
    _, offsets, data = values.buffers()
    at = np.frombuffer(offsets, np.int32, len(values) + 1, 4 * values.offset) if offsets else np.zeros(1, np.int32)
    return np.frombuffer(data or b"", np.uint8)[at[0] : at[-1]], at - at[0]


class Terms:
    """The terms of some texts: ``term`` (each different one once), and for every occurrence its number in ``term`` and its text."""

    def __init__(self, texts: pa.Array):
        data, begin = _bytes(texts)
        letter = TERM_BYTES[data]
        inside = letter != 0
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        edge = begin[:-1][begin[:-1] < len(data)]  # a text's first term begins, and the one before it ends
        first[edge] = inside[edge]
        edge = edge[edge > 0] - 1
        last[edge] = inside[edge]
        start = np.flatnonzero(first)
        self.text = np.searchsorted(begin, start, "right") - 1
        at = np.zeros(len(start) + 1, np.int32)
        np.cumsum(np.flatnonzero(last) + 1 - start, out=at[1:])
        found = pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(at), pa.py_buffer(letter[inside])]).dictionary_encode()
        self.term, self.at = found.dictionary, found.indices.to_numpy()

    def prefix(self, size: int) -> tuple[pa.Array, np.ndarray]:
        """The different prefixes of ``size`` bytes (shorter: the whole term and END), and the number of each occurrence's."""
        found = pc.binary_slice(pc.binary_join_element_wise(self.term, END, b""), 0, size).dictionary_encode()
        return found.dictionary, found.indices.to_numpy()[self.at]


def codes(values: pa.Array) -> tuple[pa.Array, np.ndarray]:
    found = values.dictionary_encode()
    return found.dictionary, found.indices.to_numpy().astype(np.int64)


def keys(prefixes: pa.Array, at: np.ndarray, langs: pa.Array, lang: np.ndarray) -> np.ndarray:
    """64-bit hashes of the prefixes numbered ``at`` in the languages numbered ``lang``: even if to be extended, odd if whole terms.

    Their remainders modulo BITS are their places in the bitmap. Should two meet, their documents add up: more is kept, never less.
    """
    data, begin = _bytes(prefixes)
    own = span_hashes(data.astype(np.uint64), begin[:-1], begin[1:])
    ends = data[begin[1:] - 1] == END[0]
    by_lang = mix(np.array([zlib.crc32(x) for x in langs.to_pylist()], np.uint64))
    return (mix(own[at] + by_lang[lang]) >> np.uint64(2) << np.uint64(1)).astype(np.int64) + ends[at]


def has(bits: np.ndarray, key: np.ndarray) -> np.ndarray:
    at = key % BITS
    return (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def prepared(docs: DataFrame) -> DataFrame:
    """lang, source and text as bytes, null as empty."""
    return docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).cast("binary").alias(c) for c in ("lang", "source", "text")))


def prefixes(texts: DataFrame, size: int, kept: Broadcast | None) -> DataFrame:
    """(key, docs): in how many documents each prefix of ``size`` bytes begins a term that is not yet known whole.

    A prefix shorter than that is a whole term, closed by END. ``kept`` has the bits of the prefixes of half the size.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1, SLICE):
            langs, lang = codes(batch.column(0))
            t = Terms(batch.column(1))
            prefix, at = t.prefix(size)
            text = t.text
            if kept and len(at):
                half, before = t.prefix(size // 2)
                longer = np.flatnonzero((np.diff(_bytes(half)[1]) == size // 2)[before])
                key = keys(half, before[longer], langs, lang[text[longer]])
                open_ = longer[(key & 1 == 0) & has(kept.value, key)]
                text, at = text[open_], at[open_]
            n = max(1, len(prefix))
            own = np.sort(text * n + at)
            own = own[np.diff(own, prepend=-1) > 0]  # once a document
            pair, docs = np.unique(lang[own // n] * n + own % n, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys(prefix, pair % n, langs, pair // n)), pa.array(docs)], names=["key", "docs"])

    return texts.select("lang", "text").mapInArrow(counted, "key long, docs long").groupBy("key").agg(F.sum("docs").alias("docs"))


def refined(texts: DataFrame, least: int = LEAST) -> np.ndarray:
    """The bitmap of the whole terms that ``least`` documents of a language have, level by level; see the module."""
    size, whole, kept = FIRST, np.zeros(BITS // 8, np.uint8), None
    while True:
        found = prefixes(texts, size, kept).filter(F.col("docs") >= least)
        bits = bit_set(found.select((F.col("key") % BITS).alias("bit")), BITS)
        whole |= bits & 0b10101010  # bit k of a byte is its k-th lowest
        if kept:
            kept.unpersist()
        if not (bits & 0b01010101).any():
            return whole
        kept, size = texts.sparkSession.sparkContext.broadcast(bits), 2 * size


def counted_terms(texts: DataFrame, whole: np.ndarray, least: int = LEAST) -> DataFrame:
    """(lang, term, n, by_source): the terms of ``least`` documents of a language, their occurrences, and (source, n) of those that have them.

    A task adds up its own documents first, so a common term or a large source is a few rows a task.
    """
    bits = texts.sparkSession.sparkContext.broadcast(whole)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2, SLICE):
            (langs, lang), (sources, source) = codes(batch.column(0)), codes(batch.column(1))
            t = Terms(batch.column(2))
            closed = pc.binary_join_element_wise(t.term, END, b"")
            held = np.flatnonzero(has(bits.value, keys(closed, t.at, langs, lang[t.text])))
            m, n = len(sources), max(1, len(t.term))
            own, times = np.unique(t.text[held] * n + t.at[held], return_counts=True)
            text = own // n
            group, back = np.unique((lang[text] * m + source[text]) * n + own % n, return_inverse=True)
            key = group // n
            count = np.bincount(back, times, len(group)).astype(np.int64)
            columns = [langs.take(pa.array(key // m)), sources.take(pa.array(key % m)), t.term.take(pa.array(group % n)), pa.array(count), pa.array(np.bincount(back, minlength=len(group)))]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "docs"])

    found = texts.select("lang", "source", "text").mapInArrow(counted, "lang binary, source binary, term binary, n long, docs long")
    # One shuffle for both aggregates: by source, then by term.
    each = found.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    own = F.collect_list(F.struct("source", "n")).alias("by_source")  # one entry a source
    return each.groupBy("lang", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"), own).filter(F.col("docs") >= least).drop("docs")


def scaled(count: Column, whole: Column) -> Column:
    """1 + floor(10^9 (count + 2) / whole) in 64 bits: three digits of the quotient at a time."""
    whole = F.greatest(whole, F.lit(1))
    rest, out = count + 2, F.lit(0).cast("long")
    for _ in range(3):
        out = out * 1000 + F.call_function("div", rest * 1000, whole)
        rest = rest * 1000 % whole
    return out + 1


def _apart(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def sources_of(texts: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, whole, sources): for each language N + 2 V over its kept terms, and (source, whole) of each of its sources in order."""
    groups = texts.select("lang", "source").distinct()
    inside = kept.select("lang", F.inline("by_source")).groupBy("lang", "source").agg(F.sum("n").alias("n"))
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("n").alias("n"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    sized = groups.join(inside, ["lang", "source"], "left").join(langs.withColumnRenamed("n", "all"), "lang", "left")
    own = F.struct("source", (zero("n") + 2 * zero("v")).alias("whole"))
    return sized.groupBy("lang").agg(F.max(zero("all") + 2 * zero("v")).alias("whole"), F.array_sort(F.collect_list(own)).alias("sources"))


def summed(dense: DataFrame) -> DataFrame:
    """(lang, a, b, value): over all terms of ``dense`` (lang, ps), what places a and b of ``ps`` differ by."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            langs = whole.column(0).to_pylist()
            edges = [0, *(k for k in range(1, len(langs)) if langs[k] != langs[k - 1]), len(langs)]
            for begin, end in zip(edges, edges[1:]):
                own = whole.column(1).slice(begin, end - begin)
                wide = len(own[0]) if len(own) else 0
                for k in range(0, len(own), max(1, CELLS // max(1, wide))):
                    part = own.slice(k, max(1, CELLS // max(1, wide)))
                    p = part.flatten().to_numpy().reshape(-1, wide)
                    for a in range(wide - 1):
                        q, r = p[:, a, None], p[:, a + 1 :]
                        sums = ((q - r) ** 2 // (q + r)).sum(0)
                        columns = [pa.array([langs[begin]] * len(sums), pa.binary()), pa.array([a] * len(sums), pa.int32()), pa.array(range(a + 1, wide), pa.int32()), pa.array(sums)]
                        yield pa.RecordBatch.from_arrays(columns, names=["lang", "a", "b", "value"])

    half = dense.mapInArrow(made, "lang binary, a int, b int, value long").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    return half.unionByName(half.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))


def audit(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value and rank: how far each source is from each other one, and by which terms from its language.

    Part ``pair`` has each other source of the language, part ``term`` the ``top`` terms that the source has more of
    than its language. Null lang, source and text are empty ones, and an empty lang or source is a group as any other.
    A row is a document, whatever its id, so repeated rows count as often as they occur; equal values rank by the item's
    bytes. A language without kept terms has pairs of value 0 and no terms; an empty table gives no rows. Extra columns are ignored.
    """
    texts = prepared(docs)
    kept = staged(counted_terms(texts, refined(texts, least), least), "kept-terms")
    langs = staged(sources_of(texts, kept), "languages")
    share = lambda g, n: F.struct(g["source"].alias("source"), n.alias("n"), scaled(n, g["whole"]).alias("p"))
    one = lambda counts: F.transform("sources", lambda g: bound(F.coalesce(counts[g["source"]], F.lit(0)), lambda n: share(g, n)))
    own = bound(F.map_from_entries("by_source"), one)
    dense = staged(kept.join(langs, "lang").select("lang", "term", scaled(F.col("n"), F.col("whole")).alias("q"), own.alias("own")), "term-shares")

    sums = summed(dense.select("lang", F.col("own.p").alias("ps")))
    each = langs.select("lang", "sources", F.posexplode("sources").alias("a", "g")).select("lang", "a", F.col("g.source").alias("source"), F.posexplode("sources").alias("b", "o"))
    pairs = each.filter("a <> b").join(sums, ["lang", "a", "b"], "left")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), F.col("o.source").alias("item"), F.coalesce("value", F.lit(0)).alias("value"))

    more = dense.select("lang", "term", "q", F.inline("own")).filter("n > 0 and p > q")
    found = more.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _apart(F.col("p"), F.col("q")).alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    ranked = pairs.withColumn("rank", rank).unionByName(found.withColumn("rank", rank).filter(F.col("rank") <= top))
    return ranked.select(*(F.col(c).cast("string").alias(c) for c in ("lang", "source", "part", "item")), "value", "rank")


SQL = f"""
WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
found AS (
  SELECT row, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
  FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM found GROUP BY lang, term HAVING count(DISTINCT row) >= {LEAST}),
held AS (SELECT lang, source, term, count(*) AS n FROM found SEMI JOIN kept USING (lang, term) GROUP BY ALL),
langs AS (SELECT lang, count(k.term) AS v, coalesce(sum(k.n), 0) AS n FROM (SELECT DISTINCT lang FROM d) LEFT JOIN kept k USING (lang) GROUP BY lang),
groups AS (
  SELECT g.lang, g.source, coalesce(h.n, 0) + 2 * l.v AS whole, l.n + 2 * l.v AS lang_whole
  FROM (SELECT DISTINCT lang, source FROM d) g JOIN langs l ON g.lang = l.lang
  LEFT JOIN (SELECT lang, source, sum(n) AS n FROM held GROUP BY ALL) h ON g.lang = h.lang AND g.source = h.source),
dense AS (
  SELECT g.lang, g.source, k.term, coalesce(h.n, 0) AS n,
    (1 + ({SCALE}::HUGEINT * (coalesce(h.n, 0) + 2)) // g.whole::HUGEINT)::HUGEINT AS p,
    (1 + ({SCALE}::HUGEINT * (k.n + 2)) // g.lang_whole::HUGEINT)::HUGEINT AS q
  FROM groups g JOIN kept k ON g.lang = k.lang LEFT JOIN held h ON g.lang = h.lang AND g.source = h.source AND k.term = h.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM dense a JOIN dense b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
every AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON a.lang = p.lang AND a.source = p.source AND b.source = p.item
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT FROM dense WHERE n > 0 AND p > q)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM every)
WHERE part = 'pair' OR rank <= {TOP}
"""
