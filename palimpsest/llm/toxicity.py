"""Toxicity scores after noisy-channel deobfuscation.

Spans that look disguised (leetspeak, spaced-out letters, repeated letters) are found with array
operations over whole batches. Each becomes a character lattice, in which a character may stand for
itself, for a letter it resembles, or for nothing; a Viterbi search under a character trigram model
restores the text. The score of the restored text is a lexicon of words and word beginnings learned
from labelled documents; a document is as toxic as its most toxic word.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.llm.common import id_crc, one_text, slices, staged, texts_of

TRAIN_ROWS = 20_000  # labelled documents that the lexicon is fitted on at most, the first by hash
PRECISE = 0.95  # share of toxic documents among those with a feature of the lexicon, at least
THRESHOLD = 0.7

#: What a disguise character may stand for.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "€": "e", "*": "aeiou"}
SEPARATORS = " .-_*"
COST = {"same": 0.0, "leet": -0.7, "gap": -0.1, "again": -0.2, "sign": -8.0, "mark": -0.5}
#: Disguise characters that commonly stand before or after a word as they are.
MARKS = {"before": set("*"), "after": set("!|*")}

#: Symbols of the character model: 0 is anything that is no letter; a-z; Latin letters beyond ASCII share 37 symbols.
ALPHABET = 64
_LETTERS = re.compile(r"[^\W\d_]+")


def _symbols() -> np.ndarray:
    table = np.zeros(0x250, np.uint8)
    for k in range(0x250):
        c = chr(k).lower()
        if c.isalpha():
            table[k] = ord(c) - 96 if "a" <= c <= "z" else 27 + (ord(c[0]) * 7) % (ALPHABET - 27)
    return table


SYMBOL = _symbols()
#: 1: letters, and all code points beyond the table; 2: separators; 4: disguise characters; 8: what may stand in a spaced-out run.
_KIND = np.array([bool(_LETTERS.match(c)) + 2 * (c in SEPARATORS) + 4 * (c in LEET) + 8 * (c.isalnum() or c in LEET) for c in map(chr, range(0x250))], np.uint8)
_KIND[-1] = 9


def _points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each followed by a line feed; and where each begins."""
    cp = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), "<u4")
    return cp, np.cumsum([0, *(len(t) + 1 for t in texts)])


def trigram_counts(docs: DataFrame) -> DataFrame:
    """(trigram, n) over all texts, at most ALPHABET**3 rows; each task adds up its own first."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(ALPHABET**3, np.int64)
        for batch in slices(batches, 0, 2_000_000):
            s = SYMBOL[np.minimum(_points(texts_of(batch.column(0)))[0], 0x24F)].astype(np.int32)
            total += np.bincount((s[:-2] * ALPHABET + s[1:-1]) * ALPHABET + s[2:], minlength=ALPHABET**3)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["trigram", "n"])

    return docs.select("text").mapInArrow(counted, "trigram long, n long").groupBy("trigram").agg(F.sum("n").alias("n"))


def character_model(docs: DataFrame) -> np.ndarray:
    """log P(c | a, b) as a flat array of ALPHABET**3 numbers, interpolated with bigrams."""
    n = np.zeros(ALPHABET**3)
    for r in trigram_counts(docs).collect():  # bounded by the alphabet
        n[r.trigram] = r.n
    n = n.reshape(ALPHABET, ALPHABET, ALPHABET)
    pair = n.sum(0) + 0.5
    back = pair / pair.sum(1, keepdims=True)
    return np.log((n + 4 * back[None]) / (n.sum(2, keepdims=True) + 4)).ravel().astype(np.float32)


class Restorer:
    """Finds disguised spans and decodes them."""

    def __init__(self, model: np.ndarray):
        self.model = model
        self.decode = lru_cache(100_000)(self._decode)

    def _decode(self, span: str) -> str:
        """The likeliest reading; signs before the first and after the last letter are read as letters, or stay."""
        span = span.lower()
        spaced = len(span) > 4 and all(c in SEPARATORS for c in span[1::2])
        letters = [k for k, c in enumerate(span) if c.isalpha()]
        if not letters:
            return span
        read = []
        for begin in {0, letters[0]}:
            for end in {len(span), letters[-1] + 1}:
                found = self._path(span[begin:end], spaced)
                if found:
                    cost = sum(COST["mark" if set(x) <= MARKS[side] else "sign"] for side, x in (("before", span[:begin]), ("after", span[end:])) if x)
                    read.append((found[0] + cost, span[:begin] + found[1] + span[end:]))
        return max(read)[1] if read else span

    def _path(self, span: str, spaced: bool) -> tuple[float, str] | None:
        """Viterbi over the span's lattice; states are the last two symbols, 0 before and after."""
        # A path is linked back to its beginning, so that long spans aren't copied; no state is ever cut.
        best: dict[tuple[int, int, str], tuple[float, tuple | None]] = {(0, 0, ""): (0.0, None)}
        for k, c in enumerate(span):
            run = c.isalpha() and (span[max(0, k - 2) : k + 1] == c * 3 or span[max(0, k - 1) : k + 2] == c * 3 or span[k : k + 3] == c * 3)
            arcs = [(x, COST["leet"]) for x in LEET.get(c, "")]
            if c.isalpha() or (not arcs and not spaced):
                arcs.append((c, COST["same"]))
            if spaced and k % 2:
                arcs.append(("", COST["gap"]))
            after: dict[tuple[int, int, str], tuple[float, tuple | None]] = {}
            for (a, b, last), (score, path) in best.items():
                for out, cost in arcs + ([("", COST["again"])] if run and last == c else []):
                    if out:
                        s = int(SYMBOL[min(ord(out), 0x24F)])
                        key, total = (b, s, out), score + cost + float(self.model[(a * ALPHABET + b) * ALPHABET + s])
                    else:
                        key, total = (a, b, last), score + cost
                    if key not in after or total > after[key][0]:
                        after[key] = (total, (path, out) if out else path)
            best = after
        if not best:
            return None
        score, path = max(((score + float(self.model[(a * ALPHABET + b) * ALPHABET]), path) for (a, b, _), (score, path) in best.items()), key=lambda x: x[0])
        letters = []
        while path:
            path, out = path
            letters.append(out)
        return score, "".join(reversed(letters))

    def restore(self, texts: list[str]) -> list[str]:
        """The texts with every disguised span decoded, in lower case where one was found."""
        low = [t.lower() for t in texts]
        cp, begins = _points(low)
        cp = np.concatenate((np.full(1, 10, cp.dtype), cp, np.full(6, 10, cp.dtype)))  # so that every window is whole
        kind = _KIND[np.minimum(cp, 0x24F)]
        letter, sep, leet = kind & 1 > 0, kind & 2 > 0, (kind & 4 > 0) | (cp == ord("€"))
        # Wider than SPANS: each of its matches holds a sign beside a letter, a letter three times or a spaced-out run of three.
        hit = leet[1:-1] & (letter[2:] | letter[:-2])
        hit |= letter[1:-1] & (cp[2:] == cp[1:-1]) & (cp[1:-1] == cp[:-2])
        either = kind & 9 > 0
        run = either[1:-5] & sep[2:-4] & either[3:-3] & sep[4:-2] & either[5:-1]
        run &= (letter[1:-5] | letter[3:-3] | letter[5:-1]) & ~letter[:-6] & ~letter[6:]
        hit[: len(run)] |= run
        out = list(texts)
        for k in np.unique(np.searchsorted(begins, np.flatnonzero(hit), "right") - 1).tolist():
            if k < len(out):
                out[k] = self._restored(low[k])
        return out

    #: Spaced-out characters, three or more; words with disguise characters before, in or after them; words with a letter three times in a row.
    SPANS = re.compile(
        r"(?<![^\W_])(?:[^\W_]|[@$!|€])(?:[ .\-_*](?:[^\W_]|[@$!|€])){2,}(?![^\W_])"
        r"|(?<![^\W\d_])[^\W\d_]*+(?:[0-9@$!|€*]{1,3}[^\W\d_]++)+(?:[0-9@$!|€*]{1,3}(?![0-9@$!|€*]))?"
        r"|(?<![^\W\d_])[^\W\d_]++[0-9@$!|€*]{1,3}(?![0-9@$!|€*])"
        r"|(?<![^\W\d_])[^\W\d_]*([^\W\d_])\1\1[^\W\d_]*"
    )

    def _restored(self, text: str) -> str:
        return self.SPANS.sub(lambda m: self.decode(m[0]), text)


def word_features(words: set[str]) -> set[str]:
    """Words as they are, and their beginnings of four to six letters (marked)."""
    out = set(words)
    for k in (4, 5, 6):
        out.update(w[:k] + "~" for w in words if len(w) >= k)
    return out


def training_rows(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """text, toxic and doc_id of labelled documents outside the held-out fold, one text an id; ``rows`` at most, the first by hash."""
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (id_crc(F.col("doc_id")) % 3 != 1))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    found = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")  # bounded by ``rows``
    return one_text(found, F.first("toxic").alias("toxic"))


def lexicon(docs: DataFrame, labels: DataFrame, model: np.ndarray, rows: int = TRAIN_ROWS) -> tuple[dict[str, float], float]:
    """feature -> P(toxic | feature), for features that mark toxic documents beyond chance; and the rate where none is found."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(model)
        for batch in slices(batches, 0):
            found, toxic, at = [], [], []
            for text, y, doc_id in zip(restorer.restore(texts_of(batch.column(0))), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                own = [*word_features(set(_LETTERS.findall(text.lower()))), ""]  # "" counts the documents
                found += own
                toxic += [int(bool(y))] * len(own)
                at += [doc_id if y else None] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array(toxic, pa.int64()), pa.array(at, pa.int64())], names=["feature", "toxic", "at"])

    counts = training_rows(docs, labels, rows).select("text", "toxic", "doc_id").mapInArrow(made, "feature string, toxic long, at long")
    # The lists hold documents of the bounded sample, and toxic ones alone; so the lexicon is bounded by the sample.
    counts = staged(counts.groupBy("feature").agg(F.sum("toxic").alias("t"), F.count("*").alias("n"), F.collect_set("at").alias("at")), "features")
    total = next(iter(counts.filter("feature = ''").collect()), None)
    if total is None or not 0 < total.t < total.n:
        return {}, (total.t + 0.1) / (total.n + 1) if total else 0.1
    base = total.t / total.n
    # By chance a feature is met t times among toxic documents only with probability base**t.
    # The bar rises with the number of features that could pass by chance, so that almost none does.
    tested = math.log(counts.filter("n >= 3").count() + 1) + 0.5
    passes = (F.col("t") / F.col("n") - base) * F.col("t") * -math.log(base) >= tested
    kept = counts.filter((F.col("feature") != "") & (F.col("t") >= 3) & (F.col("t") >= PRECISE * F.col("n")) & passes).collect()
    p: dict[str, float] = {}
    explained: set[int] = set()
    for r in sorted(kept, key=lambda r: (-r.t, -len(r.feature.rstrip("~")), r.feature)):
        # A feature counts where no stronger one explains the document: else rare words of a toxic text with many copies would pass.
        own = set(r.at) - explained
        if own:
            explained |= own
            p[r.feature] = (r.t + base) / (r.n + 1)
    return p, min(0.3, base / 4)


def score(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted for every row of ``docs``.

    Labels of the held-out fold (crc32 of the id modulo 3 is 1) are never read, and lang, source and ids
    are no inputs. Null texts are scored as empty; equal texts get equal scores; without labels of
    both classes every score is the rate that is known. Repeated rows are rows, extra columns are
    ignored, an empty table gives no rows.
    """
    model = character_model(docs)
    weights, rest = lexicon(docs, labels, model, rows)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer, get = Restorer(model), weights.get
        for batch in slices(batches, 1):
            out = []
            for text in restorer.restore(texts_of(batch.column(1))):
                words = set(_LETTERS.findall(text.lower()))
                found = max(map(get, words & weights.keys()), default=0.0)
                for k in (4, 5, 6):
                    own = {w[:k] for w in words if len(w) >= k} & beginnings[k]
                    found = max(found, max((get(w + "~") for w in own), default=0.0))
                out.append(max(found, rest))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(out, pa.float64())], names=["doc_id", "held_out", "score"])

    beginnings = {k: {w[:-1] for w in weights if w.endswith("~") and len(w) == k + 1} for k in (4, 5, 6)}
    d = docs.select("doc_id", "text", (id_crc(F.col("doc_id")) % 3 == 1).alias("held_out"))
    return d.mapInArrow(scored, "doc_id long, held_out boolean, score double").withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` below the threshold, with their columns; see score(). Null and empty texts stay, repeats are judged alike."""
    model = character_model(docs)
    weights, rest = lexicon(docs, labels, model)
    beginnings = {k: {w[:-1] for w in weights if w.endswith("~") and len(w) == k + 1} for k in (4, 5, 6)}
    high = {w for w, p in weights.items() if p >= threshold}
    begin = {k: {w for w in v if w + "~" in high} for k, v in beginnings.items()}
    at = docs.columns.index("text")

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(model)
        for batch in slices(batches, at):
            out = []
            for text in restorer.restore(texts_of(batch.column(at))):
                words = set(_LETTERS.findall(text.lower()))
                out.append(rest < threshold and not words & high and not any({w[:k] for w in words if len(w) >= k} & begin[k] for k in begin))
            yield batch.filter(pa.array(out, pa.bool_()))

    return docs.mapInArrow(kept, docs.schema)
