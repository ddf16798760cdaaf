"""Quality classifier by positive-unlabelled learning.

Trusted positives are documents labelled good; everything else is unlabelled web text. The class
prior is estimated from how a first classifier's scores spread over both (the least ratio of their
tails), and a small network minimises the non-negative unbiased risk
pi * R_p(+) + max(0, R_u(-) - pi * R_p(-)) under the logistic loss. R_u and the tails are taken over
all unlabelled documents: texts are turned into features once, and each step of the descent is one
sum over the stored features, of which only the sums reach the driver.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.llm.common import id_crc, slices, staged, texts_of

POSITIVES = 8_000  # labelled good documents that are fitted on at most, the first by hash
START = 8_000  # unlabelled documents that the descent's starting point is fitted on, the first by hash
STEPS = 16  # steps of the descent over all unlabelled documents
THRESHOLD = 0.3
SYMBOLS = "#*$%&<>"
N_FEATURES = 16


def features(text: str) -> list[float]:
    """What the text looks like; no vocabulary, so the same in every language."""
    words, lines = text.split(), text.split("\n")
    n, chars = max(1, len(words)), max(1, len(text))
    counts, lengths = Counter(words), list(map(len, words))
    return [
        np.log1p(len(words)),
        np.log1p(len(lines)),
        sum(map(text.count, SYMBOLS)) / n,
        text.count("|") / n,
        sum(map(text.count, ".,;:!?")) / n,
        sum(map(eq, words, words[1:])) / n,
        len(counts) / n,
        max(counts.values(), default=0) / n,
        (chars - len(words)) / n,
        len(set(lines)) / len(lines),
        sum(map(str.isdigit, words)) / n,
        sum(map(str.istitle, words)) / n,
        text.count("  ") / n,
        (lengths.count(1) + lengths.count(2)) / n,
        max(lengths, default=0) / 40,
        text.count("@") / n,
    ]


def described(docs: DataFrame) -> DataFrame:
    """doc_id, held_out and x (the features, as 32-bit floats) of every row."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            x = pa.array([features(t) for t in texts_of(batch.column(1))], pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), x], names=["doc_id", "held_out", "x"])

    d = docs.select("doc_id", "text", (id_crc(F.col("doc_id")) % 5 == 0).alias("held_out"))
    return d.mapInArrow(made, "doc_id long, held_out boolean, x array<float>")


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, N_FEATURES)


def summed(rows: DataFrame, size: int, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of ``of(features)``, a vector of ``size``, over all rows; tasks add up their own rows first."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, met = np.zeros(size), False
        for batch in batches:
            if batch.num_rows:
                total, met = total + of(matrix(batch.column(0))), True
        if met:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total)], names=["k", "v"])

    out = np.zeros(size)
    for r in rows.select("x").mapInArrow(made, "k long, v double").groupBy("k").agg(F.sum("v").alias("v")).collect():  # ``size`` rows
        out[r.k] = r.v
    return out


class Network:
    """One hidden layer over standardised, cut features, and their squares."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, hidden: int = 24, seed: int = 7):
        r = np.random.default_rng(seed)
        self.mean, self.scale = mean, scale
        self.w = [r.normal(0, 0.3, (2 * N_FEATURES, hidden)), np.zeros(hidden), r.normal(0, 0.3, hidden), np.zeros(1)]

    def inputs(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -4, 4)
        return np.hstack([z, z * z / 4])

    def logits(self, z: np.ndarray) -> np.ndarray:
        return np.tanh(z @ self.w[0] + self.w[1]) @ self.w[2] + self.w[3]

    def copy(self) -> Network:
        other = Network(self.mean, self.scale)
        other.w = [w.copy() for w in self.w]
        return other

    def gradients(self, z: np.ndarray, slope: np.ndarray) -> list[np.ndarray]:
        h = np.tanh(z @ self.w[0] + self.w[1])
        back = slope[:, None] * self.w[2] * (1 - h * h)
        return [z.T @ back, back.sum(0), h.T @ slope, slope.sum(keepdims=True)]

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(self.inputs(x)), -30, 30)))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, mean: np.ndarray, scale: np.ndarray, steps: int = 400, rate: float = 0.02) -> Network:
    """Full-batch Adam on the non-negative risk; where the negative part falls below 0 its gradient is turned round."""
    net = Network(mean, scale)
    p, u = net.inputs(positive), net.inputs(unlabelled)
    first, second = [np.zeros_like(w) for w in net.w], [np.zeros_like(w) for w in net.w]
    for t in range(1, steps + 1):
        fp, fu = np.clip(net.logits(p), -30, 30), np.clip(net.logits(u), -30, 30)
        loss_u, loss_p = np.log1p(np.exp(fu)).mean(), np.log1p(np.exp(fp)).mean()
        sp, su = 1 / (1 + np.exp(-fp)), 1 / (1 + np.exp(-fu))
        if loss_u - prior * loss_p >= 0:
            slope_p, slope_u = prior * ((sp - 1) - sp) / len(p), su / len(u)
        else:
            slope_p, slope_u = prior * sp / len(p), -su / len(u)
        for k, (a, b) in enumerate(zip(net.gradients(p, slope_p), net.gradients(u, slope_u))):
            g = a + b + 1e-4 * net.w[k]
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            net.w[k] = net.w[k] - rate * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-8)
    return net


class Unlabelled:
    """Sums over all unlabelled rows (column x) that the risk and its gradient need."""

    def __init__(self, rows: DataFrame):
        self.rows = rows
        found = summed(rows, 1 + 2 * N_FEATURES, lambda x: np.concatenate(([len(x)], x.sum(0), (x * x).sum(0))))
        self.n = int(found[0])
        self.mean, square = found[1:].reshape(2, -1) / max(1, self.n)
        self.scale = np.sqrt(np.maximum(square - self.mean**2, 0)) + 1e-6

    def tails(self, net: Network, cuts: np.ndarray) -> np.ndarray:
        """The share of rows with a score of each cut or more."""

        def of(x: np.ndarray) -> np.ndarray:
            return len(x) - np.searchsorted(np.sort(net.probability(x)), cuts)

        return summed(self.rows, len(cuts), of) / self.n

    def risk(self, net: Network) -> tuple[float, list[np.ndarray]]:
        """The mean loss of calling a row negative, and its gradient by the weights of ``net``."""

        def of(x: np.ndarray) -> np.ndarray:
            z = net.inputs(x)
            f = np.clip(net.logits(z), -30, 30)
            return np.concatenate([[np.log1p(np.exp(f)).sum()], *(g.ravel() for g in net.gradients(z, 1 / (1 + np.exp(-f))))])

        ends = np.cumsum([1, *(w.size for w in net.w)])
        found = summed(self.rows, int(ends[-1]), of) / self.n
        return float(found[0]), [found[a:b].reshape(w.shape) for a, b, w in zip(ends, ends[1:], net.w)]


def descend(net: Network, positive: np.ndarray, unlabelled: Unlabelled, prior: float, steps: int = STEPS, rate: float = 0.02) -> tuple[Network, list[float]]:
    """Adam on the non-negative risk over all rows, as in fit(): (the network, the risk before each step)."""
    net, p = net.copy(), net.inputs(positive)
    first, second = [np.zeros_like(w) for w in net.w], [np.zeros_like(w) for w in net.w]
    risks = []
    for t in range(1, steps + 1):
        fp = np.clip(net.logits(p), -30, 30)
        sp = 1 / (1 + np.exp(-fp))
        loss_u, by_u = unlabelled.risk(net)
        rest = loss_u - prior * np.log1p(np.exp(fp)).mean()
        risks.append(float(prior * np.log1p(np.exp(-fp)).mean() + max(0.0, rest)))
        sign, slope = (1, prior * ((sp - 1) - sp)) if rest >= 0 else (-1, prior * sp)
        for k, (a, b) in enumerate(zip(net.gradients(p, slope / len(p)), by_u)):
            g = a + sign * b + 1e-4 * net.w[k]
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            net.w[k] = net.w[k] - rate * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-8)
    return net, risks


def class_prior(positive: np.ndarray, start: np.ndarray, unlabelled: Unlabelled) -> float:
    """The least ratio of unlabelled to positive score tails, with an allowance for their size (fitted on half of the positives and of ``start``; measured on the other half and on all unlabelled rows)."""
    net = fit(positive[::2], start[::2], 0.5, unlabelled.mean, unlabelled.scale, 200)
    p = np.sort(net.probability(positive[1::2]))
    cuts = np.quantile(p, np.linspace(0, 0.95, 96))
    tail_p, tail_u = 1 - np.searchsorted(p, cuts) / len(p), unlabelled.tails(net, cuts)
    slack = np.sqrt(1 / len(p)) + np.sqrt(1 / unlabelled.n)
    k = int(np.argmin((tail_u + slack) / np.maximum(tail_p, 1e-9)))
    return float(np.clip(tail_u[k] / max(tail_p[k], 1e-9), 0.05, 0.95))


def picked(rows: DataFrame, ids: DataFrame) -> np.ndarray:
    """Features of a bounded set of ids, one row an id, on the driver."""
    found = rows.join(F.broadcast(ids), "doc_id", "left_semi").groupBy("doc_id").agg(F.min("x").alias("x")).orderBy("doc_id").collect()
    return np.array([r.x for r in found], float).reshape(-1, N_FEATURES)


def train(rows: DataFrame, labels: DataFrame, positives: int = POSITIVES, start: int = START, steps: int = STEPS) -> tuple[Network | None, float]:
    """(classifier, estimated prior) from described rows; no classifier without a few rows of both kinds.

    Trusted positives are bounded by ``positives``. ``start`` bounds the rows that the first weights are
    fitted on, from which ``steps`` steps go down the risk over all unlabelled rows outside the held-out fold.
    """
    rows = rows.filter(F.col("doc_id").isNotNull() & ~F.col("held_out"))
    fold = F.col("doc_id").isNotNull() & (id_crc(F.col("doc_id")) % 5 != 0)
    good = labels.filter(fold & (F.col("quality") == 1)).select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(positives)
    some = rows.select("doc_id").distinct().orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id").limit(start)
    p, u = picked(rows, good), picked(rows, some)
    if len(p) < 10 or len(u) < 10:
        return None, 0.5
    unlabelled = Unlabelled(rows)
    prior = class_prior(p, u, unlabelled)
    return descend(fit(p, u, prior, unlabelled.mean, unlabelled.scale), p, unlabelled, prior, steps)[0], prior


def score(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, positives: int = POSITIVES, start: int = START) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted for every row of ``docs``.

    Labels of the held-out fold (crc32 of the id modulo 5 is 0) are never read, and lang, source and
    ids are no inputs. Null texts are scored as empty, equal texts equally; with too few rows to learn
    from, every score is the prior 0.5. Repeated rows are rows, extra columns are ignored, an empty
    table gives no rows.
    """
    rows = staged(described(docs), "quality-features")
    net, prior = train(rows, labels, positives, start)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = net.probability(matrix(batch.column(2))) if net else np.full(batch.num_rows, prior)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.float64())], names=["doc_id", "held_out", "score"])

    return rows.mapInArrow(scored, "doc_id long, held_out boolean, score double").withColumn("predicted", (F.col("score") >= threshold).cast("int"))
