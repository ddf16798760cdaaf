"""Best-fit packing of tokenised documents into sequences of fixed capacity.

What is planned is the histogram of piece lengths, which has ``capacity`` entries however
large the corpus is. Single, pair and triple sums of the available lengths are looked up by
the exact complement of a gap, combinations are consumed as often as their counts allow, and
what is left goes best-fit. The plan is a bounded list of length ranges; each piece finds its
place from its rank among the pieces of its length, so no task ever holds a group.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.llm.bpe import default_tokenizer, load
from palimpsest.llm.common import slices, staged, texts_of

CAPACITY = 2048
END = 0  # the id after each document


def _complement(left: np.ndarray, gap: int) -> tuple[int, ...] | None:
    """One, two or three available lengths that sum to ``gap`` exactly; the combination with the largest supply."""
    if gap == 0:
        return ()
    if left[gap] > 0:
        return (gap,)

    def pair(total: int, least: int) -> tuple[int, int] | None:
        a = np.arange(least, total // 2 + 1)
        if not a.size:
            return None
        supply = np.minimum(left[a], left[total - a])
        if total % 2 == 0:
            supply[-1] = left[total // 2] // 2
        k = int(supply.argmax())
        return (int(a[k]), total - int(a[k])) if supply[k] > 0 else None

    if found := pair(gap, 1):
        return found
    smallest = np.flatnonzero(left[1 : gap // 3 + 1]) + 1
    for a in smallest[np.argsort(-left[smallest], kind="stable")].tolist():
        left[a] -= 1
        rest = pair(gap - a, a)
        left[a] += 1
        if rest:
            return (a, *rest)
    return None


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of one sequence, number of such sequences); all counted pieces are used.

    Each step exhausts a length or a kind of open sequence, so the plan has O(capacity) entries.
    """
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    out = []
    for length in range(capacity, 0, -1):
        while left[length]:
            left[length] -= 1
            found = _complement(left, capacity - length)
            left[length] += 1
            if found is None:
                break
            need = Counter((length, *found))
            times = min(int(left[x]) // k for x, k in need.items())
            if not times:
                break
            for x, k in need.items():
                left[x] -= k * times
            out.append(((length, *found), times))
    open_by_gap: dict[int, list[list]] = {}
    for length in range(capacity, 0, -1):
        n = int(left[length])
        while n:
            gap = min((g for g, v in open_by_gap.items() if v and g >= length), default=capacity)
            kinds = open_by_gap.get(gap)
            lengths, bins = kinds.pop() if kinds else ((), n)
            per = min(gap // length, n)
            used = min(bins, n // per)
            if used < bins and lengths:
                open_by_gap[gap].append([lengths, bins - used])
            open_by_gap.setdefault(gap - per * length, []).append([lengths + (length,) * per, used])
            n -= used * per
    return out + [(tuple(lengths), bins) for kinds in open_by_gap.values() for lengths, bins in kinds]


def slots(found: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, copies per sequence, first sequence, offset) of each run of equal lengths."""
    out, used, sequence = [], Counter(), 0
    for lengths, times in found:
        offset = 0
        for length, copies in sorted(Counter(lengths).items(), reverse=True):
            out.append((length, used[length], used[length] + copies * times, copies, sequence, offset))
            used[length] += copies * times
            offset += copies * length
        sequence += times
    return out


def pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """The pieces of every document, numbered within their task and length (part, nth).

    Document: its ids, then END. A longer one is cut into pieces of ``capacity`` from its end, so
    only the first may be shorter. A null or empty text is one piece, the END.
    """
    path = tokenizer or default_tokenizer()
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth", "ids"][: 7 + keep_ids]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int32())]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, part, seen = load(path), TaskContext.get().partitionId(), [0] * (capacity + 1)
        for batch in slices(batches, 1):
            rows, last = [], {}
            for doc_id, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
                if (ids := last.get(text)) is None:
                    ids = last[text] = np.append(bpe.encode(text).astype("<u4"), np.uint32(END))
                first = len(ids) % capacity or capacity
                for k, start in enumerate([0, *range(first, len(ids), capacity)]):
                    own = ids[start : first if k == 0 else start + capacity]
                    row = (doc_id, k, start, len(own), zlib.crc32(own.tobytes()), part, seen[len(own)])
                    rows.append((*row, own.tolist()) if keep_ids else row)
                    seen[len(own)] += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    schema = "doc_id long, piece int, start long, length int, ids_crc32 long, part int, nth long" + (", ids array<int>" if keep_ids else "")
    return docs.select("doc_id", "text").mapInArrow(cut, schema)


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """Place every piece of every document in a sequence of at most ``capacity`` tokens.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids with ``keep_ids``);
    offsets in a sequence are gapless from 0. Repeated rows and null ids are placed like any others,
    extra columns are ignored, an empty table gives no rows. Which of several equal lengths takes
    which place is fixed by the order of the scan.
    """
    spark = docs.sparkSession
    found = staged(pieces(docs, tokenizer, capacity, keep_ids), "pieces")
    per_part = found.groupBy("part", "length").agg(F.count("*").alias("n"))
    # One row per length comes to the driver: at most ``capacity`` rows.
    counts = {r.length: r.n for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = spark.createDataFrame(slots(plan(counts, capacity)), "length int, r0 long, r1 long, copies int, seq0 long, at long")
    before = per_part.select("part", "length", (F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")).alias("before"))
    ranked = found.join(before, ["part", "length"]).withColumn("rank", F.col("before") + F.col("nth"))
    # The plan is bounded by the capacity, not by the data (see plan()), so it is broadcast.
    placed = ranked.join(F.broadcast(table), "length").filter("rank >= r0 and rank < r1")
    return placed.select(
        "doc_id",
        "piece",
        "start",
        F.col("length").cast("long").alias("length"),
        "ids_crc32",
        F.expr("seq0 + (rank - r0) div copies").alias("sequence_id"),
        F.expr("at + (rank - r0) % copies * length").alias("offset"),
        *(["ids"] if keep_ids else []),
    )


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences themselves (sequence_id, input_ids, doc_ids), from pack(..., keep_ids=True).

    A group is one sequence, so it has ``capacity`` tokens at most.
    """
    inside = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return packed.groupBy("sequence_id").agg(inside.alias("x")).select("sequence_id", F.flatten("x.ids").alias("input_ids"), F.col("x.doc_id").alias("doc_ids"))
