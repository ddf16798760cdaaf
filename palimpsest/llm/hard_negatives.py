"""Hard negatives: exact integer scores of anchors against all rows, tile by tile, and mergeable heaps of the best.

Anchors are dealt into blocks and all rows into splits; a block meets every split once, in a cell of its own, so no
task holds more than a block of anchors and a tile of rows. A cell returns the heaps of its own rows, and merging heaps
gives the heap of all rows. Two passes: the first, within each label, finds the positives; the second the window of each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.llm.common import staged

POSITIVES, NEGATIVES = 5, 10
ANCHOR_EVERY = 100
BLOCK = 8_192  # anchors of a block, about
SPLIT = 32_768  # rows of a split, about; there are at least LEAST splits
LEAST = 24
TILE = 2_048  # rows of a tile
LEAF = 64  # a product with a shorter side is multiplied directly
LARGEST = 1 << 61  # beyond it a score might not be exact in 64 bits
LOW, HIGH = -(1 << 63), (1 << 63) - 1


def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b of int64 matrices by seven half-sized products; odd sides are padded with zeros. Exact modulo 2^64."""
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) < LEAF:
        return a @ b
    a = np.pad(a, ((0, m % 2), (0, k % 2)))
    b = np.pad(b, ((0, k % 2), (0, n % 2)))
    i, j, l = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :l], b[:j, l:], b[j:, :l], b[j:, l:]
    p1 = strassen(a11 + a22, b11 + b22)
    p2 = strassen(a21 + a22, b11)
    p3 = strassen(a11, b12 - b22)
    p4 = strassen(a22, b21 - b11)
    p5 = strassen(a11 + a12, b22)
    p6 = strassen(a21 - a11, b11 + b12)
    p7 = strassen(a12 - a22, b21 + b22)
    out = np.empty((2 * i, 2 * l), np.int64)
    out[:i, :l] = p1 + p4 - p5 + p7
    out[:i, l:] = p3 + p5
    out[i:, :l] = p2 + p4
    out[i:, l:] = p1 - p2 + p3 + p6
    return out[:m, :n]


class Heaps:
    """For each of ``n`` keys the ``size`` best (score, id): highest score, ties by smaller id."""

    def __init__(self, n: int, size: int):
        self.size = size
        self.key, self.score, self.id = (np.empty(0, np.int64) for _ in range(3))
        self.floor = np.full(n, LOW)  # what a score must reach to enter

    def add(self, key: np.ndarray, score: np.ndarray, id_: np.ndarray) -> None:
        key, score, id_ = (np.concatenate(x) for x in ((self.key, key), (self.score, score), (self.id, id_)))
        by = np.lexsort((id_, -score, key))
        key, score, id_ = key[by], score[by], id_[by]
        place = np.arange(len(key)) - np.searchsorted(key, key)
        kept = place < self.size
        self.key, self.score, self.id = key[kept], score[kept], id_[kept]
        full = place[kept] == self.size - 1
        self.floor[self.key[full]] = self.score[full]

    def offer(self, score: np.ndarray, able: np.ndarray, id_: np.ndarray) -> None:
        """Scores (a row for each key) of the candidates ``id_``, where ``able``."""
        able = able & (score >= self.floor[:, None])
        if score.shape[1] > self.size:  # only what reaches the size-th best of this tile can enter
            seen = np.where(able, score, LOW)
            able &= seen >= np.partition(seen, -self.size, axis=1)[:, -self.size][:, None]
        row, at = np.nonzero(able)
        if len(row):
            self.add(row, score[row, at], id_[at])


def rows_of(embeddings: DataFrame) -> DataFrame:
    """vec_id, label and q (components as floor(256 x)) of the rows that take part; an id of several rows counts once.

    Rows without id, label or vector, or with a null or non-finite component, take no part.
    """
    x = F.transform("embedding", lambda e: e.cast("double"))
    fine = lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != float("inf"))
    d = embeddings.select("vec_id", "label", x.alias("x")).filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & F.forall("x", fine))
    label = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    q = F.transform("x", lambda e: F.floor(e * 256).cast("long"))
    one = d.select(F.col("vec_id").cast("long"), F.struct(label.alias("label"), q.alias("q")).alias("row"))
    return one.groupBy("vec_id").agg(F.min("row").alias("row")).select("vec_id", "row.label", "row.q")


def _matrix(rows: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows of a matrix, padded with zeros; refuses what 64 bits may not hold."""
    lengths = np.diff(rows.offsets.to_numpy())
    out = np.zeros((len(rows), max(width, int(lengths.max(initial=0)))), np.int64)
    out[np.arange(out.shape[1]) < lengths[:, None]] = rows.flatten().to_numpy()
    return out


def _fit(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    wide = max(a.shape[1], b.shape[1])
    a, b = (np.pad(x, ((0, 0), (0, wide - x.shape[1]))) for x in (a, b))
    top = [max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) for x in (a, b)]
    if 10 * wide * top[0] * top[1] > LARGEST:
        raise ValueError("components too large: a score would not be exact in 64 bits")
    return a, b


def dealt(anchors: DataFrame, rows: DataFrame, by: str | None) -> DataFrame:
    """Anchors and rows in cells, each cell's anchors first: a block of anchors meets each split of rows in one cell.

    Rows go to every block, anchors to every split; with ``by``, only to blocks of the same value of that column, whose
    own blocks and splits follow from its number of rows, so that a hot value has many cells.
    """
    blocks, splits = F.ceil(F.col("na") / BLOCK).cast("int"), F.greatest(F.lit(LEAST), F.ceil(F.col("nr") / SPLIT)).cast("int")
    if by:
        sizes = anchors.groupBy(by).agg(F.count("*").alias("na")).join(rows.groupBy(by).agg(F.count("*").alias("nr")), by)
        sizes = staged(sizes.select(by, blocks.alias("blocks"), splits.alias("splits")), "cells")
        with_sizes = lambda d: d.join(sizes, by)
    else:
        n = {"na": F.lit(max(1, anchors.count())), "nr": F.lit(rows.count())}
        with_sizes = lambda d: d.withColumns(n).withColumns({"blocks": blocks, "splits": splits})
    own = lambda n: F.pmod(F.xxhash64("vec_id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    group = F.col(by) if by else F.lit(0).cast("long")
    columns = ["vec_id", "label", "q", "lows", "highs"]
    none = F.lit(None).cast("array<long>")
    rows = rows.withColumns({"lows": none, "highs": none})
    a = with_sizes(anchors).withColumn("block", own("blocks")).select(group.alias("part"), "block", every("splits").alias("split"), F.lit(0).alias("side"), *columns)
    r = with_sizes(rows).withColumn("split", own("splits")).select(group.alias("part"), every("blocks").alias("block"), "split", F.lit(1).alias("side"), *columns)
    n = int(anchors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cell = ["part", "block", "split"]
    return a.unionByName(r).repartition(max(n, LEAST), *cell).sortWithinPartitions(*cell, "side")


class Cell:
    """The anchors of one block, and the heaps of the rows it has met."""

    def __init__(self, windows: bool):
        self.windows, self.parts, self.a = windows, [], None

    def anchors(self, batch: pa.RecordBatch) -> None:
        self.parts.append(batch)

    def begin(self) -> None:
        t = pa.Table.from_batches(self.parts).combine_chunks()
        self.id, self.label = (t.column(c).to_numpy() for c in ("vec_id", "label"))
        self.a = _matrix(t.column("q").combine_chunks(), 0)
        n = len(self.id)
        self.low, self.high = np.full((n, POSITIVES), HIGH), np.full((n, POSITIVES), LOW)
        if self.windows:  # one for each positive; where there are fewer, nothing is inside
            for out, c in ((self.low, "lows"), (self.high, "highs")):
                own = t.column(c).combine_chunks()
                out[np.arange(POSITIVES) < np.diff(own.offsets.to_numpy())[:, None]] = own.flatten().to_numpy()
        self.own = [np.arange(k, min(k + TILE // 4, n)) for k in range(0, n, TILE // 4)]
        places, size = (POSITIVES, NEGATIVES) if self.windows else (1, POSITIVES)
        self.heaps = [[Heaps(len(own), size) for _ in range(places)] for own in self.own]

    def rows(self, batch: pa.RecordBatch) -> None:
        if self.a is None:
            if not self.parts:
                return
            self.begin()
        id_, label = (batch.column(c).to_numpy() for c in ("vec_id", "label"))
        self.a, b = _fit(self.a, _matrix(batch.column("q"), 0))
        for own, heaps in zip(self.own, self.heaps):
            score = strassen(self.a[own], b.T)
            same = self.label[own][:, None] == label
            if not self.windows:
                heaps[0].offer(score, same & (self.id[own][:, None] != id_), id_)
                continue
            for j, heap in enumerate(heaps):
                heap.offer(score, ~same & (score >= self.low[own, j][:, None]) & (score <= self.high[own, j][:, None]), id_)

    def result(self) -> Iterator[pa.RecordBatch]:
        for own, heaps in zip(self.own, self.heaps) if self.a is not None else ():
            for j, h in enumerate(heaps):
                columns = [self.id[own[h.key]], np.full(len(h.key), j), h.score, h.id]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["anchor_id", "place", "score", "vec_id"])


def heaps(cells: DataFrame, windows: bool) -> DataFrame:
    """(anchor_id, place, score, vec_id): the heaps of every cell. A task streams its cells, one after the other."""

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, cell = None, None
        for whole in batches:
            at = np.stack([whole.column(c).to_numpy() for c in ("part", "block", "split", "side")])
            edges = [0, *(np.flatnonzero((np.diff(at) != 0).any(0)) + 1).tolist(), whole.num_rows]
            for begin, end in zip(edges, edges[1:]):
                if end == begin:
                    continue
                key = tuple(at[:3, begin].tolist())
                if key != now:
                    if cell:
                        yield from cell.result()
                    now, cell = key, Cell(windows)
                for k in range(begin, end, TILE):
                    batch = whole.slice(k, min(TILE, end - k))
                    (cell.rows if at[3, begin] else cell.anchors)(batch)
        if cell:
            yield from cell.result()

    return cells.mapInArrow(met, "anchor_id long, place long, score long, vec_id long")


def first(found: DataFrame, n: int, *keys: str) -> DataFrame:
    """Heaps merged: the ``n`` best rows of each key with their ``rank``; Spark cuts each task's rows before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def mine(embeddings: DataFrame, anchor: Column | None = None) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score: see the module.

    ``anchor`` says which rows are anchors (vec_id divisible by 100). Null or non-finite data take no part, an id of
    several rows counts once (its least label and vector), vectors of unequal lengths are padded with zeros (an empty one
    scores 0), equal scores rank by the smaller id. Anchors without positives or without negatives in a window give no
    row; an empty table gives none. Components whose scores might not be exact in 64 bits are refused. Extra columns are ignored.
    """
    rows = staged(rows_of(embeddings), "vectors")
    none = F.lit(None).cast("array<long>")
    anchors = rows.filter(anchor if anchor is not None else F.col("vec_id") % ANCHOR_EVERY == 0).withColumns({"lows": none, "highs": none})
    positives = staged(first(heaps(dealt(anchors, rows, "label"), windows=False), POSITIVES, "anchor_id"), "positives")
    # 30 p <= 100 n <= 90 p in whole numbers
    lows, highs = F.ceil(F.col("p.score") * F.lit(3).cast("decimal(2,0)") / 10).cast("long"), F.floor(F.col("p.score") * F.lit(9).cast("decimal(2,0)") / 10).cast("long")
    by_rank = F.array_sort(F.collect_list(F.struct("rank", lows.alias("low"), highs.alias("high"))))
    bounds = positives.alias("p").groupBy("anchor_id").agg(by_rank.alias("b")).select(F.col("anchor_id").alias("vec_id"), F.col("b.low").alias("lows"), F.col("b.high").alias("highs"))
    windowed = anchors.drop("lows", "highs").join(bounds, "vec_id")
    found = first(heaps(dealt(windowed, rows, None), windows=True), NEGATIVES, "anchor_id", "place")
    positive = positives.select("anchor_id", (F.col("rank") - 1).cast("long").alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    joined = found.withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"}).join(positive, ["anchor_id", "place"])
    return joined.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


SQL = f"""
WITH fine AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: coalesce(NOT isfinite(x), true))) = 0),
v AS (SELECT vec_id, r.label, r.q FROM (SELECT vec_id, min(struct_pack(label, q)) AS r FROM fine GROUP BY vec_id)),
scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
    coalesce(list_sum(list_transform(list_zip(a.q, b.q), lambda z: coalesce(z[1] * z[2], 0))), 0)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % {ANCHOR_EVERY} = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES})
SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score FROM (
  SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM positives p JOIN scores s ON p.anchor_id = s.anchor_id AND NOT s.same
    AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score)
WHERE rank <= {NEGATIVES}
"""
