"""Language-model scores by subword lattices.

An existing vocabulary's scores weight every segmentation of a word into pieces; a forward
recursion in log space sums over all of them, so a text's score is its marginal probability and not
that of one segmentation. Pieces never cross words, so a word's lattice is evaluated once per batch
and for many words at a time. The piece scores are estimated again by expectation-maximisation over
the distinct words of the training fold with their counts; how often a text ends is learned from it
as well. Beside it stands a smoothed word unigram model with exact counts over the whole fold.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.llm.common import id_crc, slices, staged, texts_of
from palimpsest.llm.hashing import mix, powers, span_hashes

HEAD = 131_072  # the most frequent words, whose counts every task gets; all others are joined exactly
ZIPF = 2.7  # a piece of rank r weighs 1 / (r + ZIPF)
ITERATIONS = 3  # of expectation-maximisation over the training fold
PRIOR = 10_000.0  # pieces that the vocabulary's own weights count for beside the expected counts
BYTES = 0.01  # mass of the 256 byte pieces, which any character without a piece falls back on
MARK = 0x2581  # begins a word
_ODD = np.uint64(0x9E3779B97F4A7C15)
SLICE = 2_000_000  # bytes of text that a task has in arrays at once, unless one text is longer
WIDTHS = (*range(2, 14), 17, 25, 33, 49, 65)  # word lengths (with the mark) are padded to these, longer ones to powers of two


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _hash(points: np.ndarray) -> np.ndarray:
    return mix((points.astype(np.uint64) + np.uint64(1)) * _ODD)


class Words:
    """The words of several texts: hash, text number, and where they stand in ``points``."""

    def __init__(self, texts: list[str]):
        self.points = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), "<u4")
        upper = (self.points >= 65) & (self.points <= 90)
        self.points = self.points + 32 * upper.astype(np.uint32)
        blank = (self.points == 32) | ((self.points >= 9) & (self.points <= 13))
        edge = np.flatnonzero(np.diff(np.concatenate(([True], blank, [True])).astype(np.int8)))
        self.begin, end = edge[0::2], edge[1::2]
        self.length = end - self.begin
        self.hash = span_hashes(_hash(self.points), self.begin, end)
        begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
        self.text = np.searchsorted(begins, self.begin, "right") - 1


class Lattice:
    """Natural log marginal probabilities of words under a piece vocabulary."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        own = [k for k in range(model.get_piece_size()) if not (model.is_control(k) or model.is_byte(k) or model.is_unknown(k) or model.is_unused(k))]
        score = np.array([model.get_score(k) for k in own])
        rank = np.empty(len(own))
        rank[np.argsort(-score, kind="stable")] = np.arange(len(own))
        weight = 1 / (rank + ZIPF)
        logp = np.log(weight / weight.sum() * (1 - BYTES))
        pieces = [np.array([*map(ord, model.id_to_piece(k))], np.uint64) for k in own]
        self.most = max(map(len, pieces))
        up, _ = powers(self.most)
        keys = np.array([mix((_hash(p) * up[: len(p)]).sum(keepdims=True) + np.uint64(len(p)))[0] for p in pieces])
        by = np.argsort(keys)
        self.keys, self.logp = keys[by], logp[by]
        self.own = self.logp
        self.seen = np.zeros(1 << 20, bool)  # the keys' first 20 bits: most strings are ruled out by them
        self.seen[self.keys >> np.uint64(44)] = True

    def found(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(where in the raveled ``key`` a piece stands, which piece)."""
        flat = key.ravel()
        where = np.flatnonzero(self.seen[flat >> np.uint64(44)])
        hit = flat[where]
        at = np.minimum(np.searchsorted(self.keys, hit), len(self.keys) - 1)
        is_piece = self.keys[at] == hit
        return where[is_piece], at[is_piece]

    def learned(self, mass: np.ndarray) -> np.ndarray:
        """Log weights from expected counts, smoothed by the vocabulary's own weights."""
        weight = mass + PRIOR * np.exp(self.own)
        return np.log(weight / weight.sum() * (1 - BYTES))

    def forward(self, points: np.ndarray) -> np.ndarray:
        """alpha[j] of each row: log probability of its first j characters, over all segmentations."""
        n, width = points.shape
        up, down = powers(width + 1)
        total = np.concatenate((np.zeros((n, 1), np.uint64), np.cumsum(_hash(points) * up[:width], axis=1)), axis=1).T
        spelled = (1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)).T * math.log(BYTES / 256)
        alpha = np.full((width + 1, n), -np.inf)
        alpha[0] = 0
        for j in range(1, width + 1):
            k = np.arange(1, min(self.most, j) + 1)[:, None]
            where, at = self.found(mix((total[j] - total[j - k[:, 0]]) * down[j - k] + k.astype(np.uint64)))
            paths = np.full((len(k), n), -np.inf)
            paths[0] = spelled[j - 1]
            paths.ravel()[where] = self.logp[at]
            paths += alpha[j - k[:, 0]]
            top = paths.max(0)
            alpha[j] = top + np.log(np.exp(paths - top).sum(0))
        return alpha

    def expect(self, points: np.ndarray, alpha: np.ndarray, length: np.ndarray, times: np.ndarray, mass: np.ndarray) -> None:
        """Add to ``mass`` how often each piece is expected in the rows, whose first ``length`` characters count ``times`` times."""
        n, width = points.shape
        up, down = powers(width + 1)
        total = np.concatenate((np.zeros((n, 1), np.uint64), np.cumsum(_hash(points) * up[:width], axis=1)), axis=1).T
        spelled = (1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)).T * math.log(BYTES / 256)
        beta = np.full((width + 1, n), -np.inf)
        beta[length, np.arange(n)] = 0
        whole = alpha[length, np.arange(n)]
        for i in range(width - 1, -1, -1):
            k = np.arange(1, min(self.most, width - i) + 1)[:, None]
            inside = i < length
            where, at = self.found(mix((total[i + 1 : i + len(k) + 1] - total[i]) * down[i] + k.astype(np.uint64)))
            paths = np.full((len(k), n), -np.inf)
            paths[0] = spelled[i]
            paths.ravel()[where] = self.logp[at]
            paths += beta[i + 1 : i + len(k) + 1]
            top = np.where(inside, paths.max(0), 0.0)
            beta[i] = np.where(inside, top + np.log(np.maximum(np.exp(paths - top).sum(0), 1e-300)), beta[i])
            row = where % n
            share = np.exp(paths.ravel()[where] + np.where(inside, alpha[i] - whole, -np.inf)[row]) * times[row]
            mass += np.bincount(at, share, len(mass))

    def words(self, w: Words, at: np.ndarray, times: np.ndarray | None = None, mass: np.ndarray | None = None) -> np.ndarray:
        """Log probability of the words numbered ``at``; with ``mass``, their expected pieces are added to it."""
        out, length = np.empty(len(at)), w.length[at] + 1
        widths = np.array([*WIDTHS, *(1 << k for k in range(7, 40))])
        width = widths[np.searchsorted(widths, length)]
        for size in np.unique(width).tolist():
            members = np.flatnonzero(width == size)
            step = max(1, 200_000 // size)
            for own in (members[k : k + step] for k in range(0, len(members), step)):
                place = w.begin[at[own]][:, None] + np.arange(size - 1)
                inside = np.arange(size - 1) < w.length[at[own]][:, None]
                points = np.where(inside, w.points[np.minimum(place, len(w.points) - 1)], 0)
                points = np.concatenate((np.full((len(own), 1), MARK, points.dtype), points), axis=1)
                alpha = self.forward(points)
                out[own] = alpha[length[own], np.arange(len(own))]
                if mass is not None:
                    self.expect(points, alpha, length[own], times[own], mass)
        return out


_loaded: dict[str, Lattice] = {}


def load(path: str) -> Lattice:
    if path not in _loaded:
        _loaded[path] = Lattice(path)
    return _loaded[path]


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, spelled, n): exact counts of all words with their 64-bit hashes; each batch adds up its own first."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 0, SLICE):
            w = Words(texts_of(batch.column(0)))
            word, first, n = np.unique(w.hash, return_index=True, return_counts=True)
            spelled = [w.points[b : b + m].tobytes().decode("utf-32-le") for b, m in zip(w.begin[first].tolist(), w.length[first].tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(spelled, pa.string()), pa.array(n)], names=["word", "spelled", "n"])

    return docs.select("text").mapInArrow(counted, "word long, spelled string, n long").groupBy("word", "spelled").agg(F.sum("n").alias("n"))


def estimate(counts: DataFrame, path: str, iterations: int = ITERATIONS) -> np.ndarray:
    """Log weights of the pieces after ``iterations`` of expectation-maximisation over ``counts`` (spelled, n).

    Every distinct word counts, as often as it occurs. A task adds up its own words' expected pieces, so at
    most one row per task and piece is shuffled, and one per piece of the vocabulary comes to the driver.
    Without words the vocabulary's own weights are returned.
    """
    logp = load(path).own

    def expected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = load(path)
        lattice.logp, mass = logp, np.zeros(len(logp))
        for batch in slices(batches, 0, SLICE // 8):
            w = Words(batch.column(0).to_pylist())
            lattice.words(w, np.arange(len(w.begin)), batch.column(1).to_numpy(zero_copy_only=False), mass)
        piece = np.flatnonzero(mass)
        yield pa.RecordBatch.from_arrays([pa.array(piece, pa.int32()), pa.array(mass[piece])], names=["piece", "mass"])

    for _ in range(iterations):
        found = counts.select("spelled", "n").mapInArrow(expected, "piece int, mass double").groupBy("piece").agg(F.sum("mass").alias("mass")).collect()
        mass = np.zeros(len(logp))
        mass[[r.piece for r in found]] = [r.mass for r in found]
        logp = load(path).learned(mass)
    return logp


def most_frequent(counts: DataFrame, most: int) -> DataFrame:
    """(word, n) of the words that occur as often as the ``most`` most frequent ones or more; ``most`` rows at most.

    The count that divides them is found on the histogram of counts, so that no task sends its own candidates to the driver.
    """
    above = Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, Window.currentRow)  # over different counts
    bars = counts.groupBy("n").agg(F.count("*").alias("words")).withColumn("above", F.sum("words").over(above))
    least = bars.filter(F.col("above") <= most).agg(F.min("n")).first()[0]
    return counts.select("word", "n").filter(F.col("n") >= (least if least is not None else 1 << 62))


def score(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row of ``docs``.

    Rows whose crc32 of the id modulo 5 is 1 are held out: nothing is learned from them. Null and empty
    texts are the end token alone. Repeated rows count as often as they occur; rows with a null id are
    training rows; extra columns are ignored; an empty table gives no rows.
    """
    path = vocabulary or default_vocabulary()
    d = docs.select("doc_id", "text", (id_crc(F.col("doc_id")) % 5 == 1).alias("held_out"))
    train = d.filter(~F.col("held_out"))
    counts = staged(word_counts(train), "word-counts")
    logp = estimate(counts, path)
    ends = train.count()
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    total, distinct = total + ends, distinct + bool(ends)
    unit = total + 0.5 * (distinct + 1)
    head = most_frequent(counts, HEAD).collect()  # HEAD rows at most, without their spelling
    known = np.array([r.word for r in head], np.int64)
    by = np.argsort(known)
    known, known_n = known[by], np.array([r.n for r in head], np.int64)[by]
    end_base = math.log10((ends + 0.5) / unit)
    stop = (ends + 0.5) / (total + 1)
    names = ["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "lm", "word", "times"]
    types = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.int32()]

    def evaluated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, row = load(path), TaskContext.get().partitionId() << 33
        lattice.logp = logp
        for batch in slices(batches, 1, SLICE):
            texts = texts_of(batch.column(1))
            w, n = Words(texts), len(texts)
            word, first, back = np.unique(w.hash, return_index=True, return_inverse=True)
            lm = lattice.words(w, first)[back] / math.log(10) + math.log10(1 - stop)
            signed = word.view(np.int64)
            at = np.minimum(np.searchsorted(known, signed), max(0, len(known) - 1))
            found = known[at] == signed if len(known) else np.zeros(len(word), bool)
            base = np.where(found, np.log10((known_n[at] + 0.5) / unit) if len(known) else 0, 0)
            in_head = found[back]
            size = np.bincount(w.text, minlength=n)
            rows = [np.arange(row, row + n), None, None, size + 1, np.bincount(w.text, in_head, n).astype(np.int64) + bool(ends), np.bincount(w.text, base[back], n) + end_base, np.bincount(w.text, lm, n) + math.log10(stop)]
            columns = [batch.column(k - 1) if k == 1 else batch.column(2) if k == 2 else pa.array(c, t) for k, (c, t) in enumerate(zip(rows, types))]
            yield pa.RecordBatch.from_arrays([*columns, pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32())], names=names)
            # Rarer words: one row per text and word, for the join with the counts.
            pair = np.stack((w.text[~in_head], back[~in_head]))
            order = np.lexsort((pair[1], pair[0]))
            pair = pair[:, order]
            new = np.flatnonzero(np.concatenate(([True], (np.diff(pair) != 0).any(0)))) if pair.size else np.empty(0, np.int64)
            times = np.diff(np.append(new, pair.shape[1]))
            m = len(new)
            rare = [pa.array(pair[0][new] + row, pa.int64()), *(pa.nulls(m, t) for t in types[1:7]), pa.array(signed[pair[1][new]], pa.int64()), pa.array(times, pa.int32())]
            yield pa.RecordBatch.from_arrays(rare, names=names)
            row += n

    found = staged(d.select("doc_id", "text", "held_out").mapInArrow(evaluated, "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, lm double, word long, times int"), "evaluated")
    rare = found.filter("times is not null").select("row", "word", "times").join(counts.select("word", "n"), "word", "left")
    n = F.coalesce("n", F.lit(0))
    rare = rare.groupBy("row").agg(F.sum(F.col("times") * F.log10((n + 0.5) / unit)).alias("rare_base"), F.sum(F.when(n > 0, F.col("times")).otherwise(0)).alias("rare_known"))
    return (
        found.filter("times is null")
        .join(rare, "row", "left")
        .select(
            "doc_id",
            "held_out",
            "n_tokens",
            (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
            F.lit(total).cast("long").alias("train_tokens"),
            (F.col("base") + F.coalesce("rare_base", F.lit(0.0))).alias("base_score"),
            F.col("lm").alias("score"),
        )
    )
