"""Byte-level BPE encoding and decoding by tree concatenation.

A text is cut into halves until the leaves are short, the leaves are encoded in
parallel, and neighbours are joined pairwise: a window around the join is encoded
again and grows until both sides agree with it exactly. Agreement is exact at two
levels. Between pre-tokens, the segmentation from a shared pre-token boundary on
depends on the text after it alone. Inside one unsplit pre-token, a token sequence
is the BPE encoding if and only if each adjacent pair encodes to itself, so one
token shared with the window on either side carries the proof over.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.llm.common import slices, texts_of

#: The pre-token pattern of this vocabulary, and its form for texts in plain Latin script.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LATIN_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"
#: Beyond these characters the Latin form and the pattern could differ.
NOT_LATIN = r"[^\x00-\x1b\x20-\x84\x86-\x9f\xa1-\xa9\xab-\xb1\xb4\xb6-\xb8\xbb\xbf-ɏ‐-‧]"

LEAF_CHARS = 32_768  # texts up to this length are one leaf
LONG_PIECE = 4_096  # pre-tokens of more bytes are encoded in halves
CACHE = 400_000  # pre-tokens whose ids a worker remembers
CERTAIN = 4  # characters after a pre-token that its end can depend on


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_alphabet() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class ByteBPE:
    """Encoder and decoder for one vocabulary file; ids are little-endian unsigned 16-bit bytes."""

    def __init__(self, path: str):
        import regex
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = _byte_alphabet()
        vocab = {bytes(alphabet[c] for c in token): k for token, k in spec["model"]["vocab"].items() if all(c in alphabet for c in token)}
        special = {x["content"]: x["id"] for x in spec.get("added_tokens", [])}
        vocab = {k: v for k, v in vocab.items() if v not in special.values()}
        self.special = {k: v.to_bytes(2, "little") for k, v in special.items()}
        self.at_special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self.bytes_of = [b""] * (max([*vocab.values(), *special.values()]) + 1)
        for token, k in [*vocab.items(), *((s.encode(), k) for s, k in special.items())]:
            self.bytes_of[k] = token
        self.decimal_of = [str(k) for k in range(len(self.bytes_of))]
        self.core = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=vocab, special_tokens={})._core_bpe
        self.latin, self.any, self.not_latin = re.compile(LATIN_PATTERN), regex.compile(PATTERN), re.compile(NOT_LATIN)
        self.cache: dict[str, bytes] = {}

    def pretokens(self, text: str) -> list[str]:
        return (self.any if self.not_latin.search(text) else self.latin).findall(text)

    def unsplit(self, piece: bytes) -> list[int]:
        """Encode one pre-token; a long one in halves that are joined by growing windows."""
        if len(piece) <= LONG_PIECE:
            return self.core.encode_single_piece(piece)
        half = len(piece) // 2
        return self.concatenate(self.unsplit(piece[:half]), self.unsplit(piece[half:]))

    def concatenate(self, left: list[int], right: list[int]) -> list[int]:
        width = 8
        while True:
            a, b = left[-width:], right[:width]
            window = self.core.encode_single_piece(b"".join(map(self.bytes_of.__getitem__, a + b)))
            from_start, to_end = len(a) == len(left), len(b) == len(right)
            if (from_start or window[:2] == a[:2]) and (to_end or window[-2:] == b[-2:]):
                return left[: len(left) - len(a)] + window + right[len(b) :]
            width *= 2

    def ids_of(self, piece: str) -> bytes:
        found = self.cache.get(piece)
        if found is None:
            found = array("H", self.unsplit(piece.encode())).tobytes()
            if len(self.cache) >= CACHE:
                self.cache.clear()
            if len(piece) < 64:
                self.cache[piece] = found
        return found

    def parts(self, text: str) -> list[str]:
        """The text cut at special tokens, which stand alone."""
        return [x for x in self.at_special.split(text) if x] if self.at_special else [text]

    def encode(self, text: str) -> np.ndarray:
        """All ids of one text, as one leaf."""
        get, out = self.cache.get, []
        for part in self.parts(text):
            if part in self.special:
                out.append(self.special[part])
            else:
                out += [get(p) or self.ids_of(p) for p in self.pretokens(part)]
        return np.frombuffer(b"".join(out), "<u2")

    def decode(self, ids: np.ndarray) -> bytes:
        """The UTF-8 of the decoded text; invalid sequences decode to U+FFFD."""
        data = b"".join(map(self.bytes_of.__getitem__, ids.tolist()))
        try:
            data.decode()
        except UnicodeDecodeError:
            return data.decode(errors="replace").encode()
        return data

    def leaf(self, text: str) -> list[tuple[str, bytes]]:
        """(pre-token, its ids) of a leaf, which is a special token or holds none."""
        return [(text, self.special[text])] if text in self.special else [(p, self.ids_of(p)) for p in self.pretokens(text)]

    def join(self, left: list[tuple[str, bytes]], right: list[tuple[str, bytes]]) -> list[tuple[str, bytes]]:
        """Join two encoded neighbours; windows grow until a pre-token boundary of the right side is met."""
        if not left or not right:
            return left or right
        keep, tail = len(left), 0
        while keep and tail <= CERTAIN:  # the last pre-tokens may end elsewhere once more text follows
            keep -= 1
            tail += len(left[keep][0])
        before = "".join(p for p, _ in left[keep:])
        ends = [0, *accumulate(len(p) for p, _ in right)]
        take = 4
        while True:
            take = min(take, len(right))
            window = self.pretokens(before + "".join(p for p, _ in right[:take]))
            at, last = 0, len(before) + ends[take]
            own = {len(before) + e: k for k, e in enumerate(ends[: take + 1])}
            for k, piece in enumerate(window):
                if at in own and (at <= last - CERTAIN or take == len(right)):
                    return left[:keep] + [(p, self.ids_of(p)) for p in window[:k]] + right[own[at] :]
                at += len(piece)
            if take == len(right):
                return left[:keep] + [(p, self.ids_of(p)) for p in window]
            take *= 2


_loaded: dict[str, ByteBPE] = {}


def load(path: str) -> ByteBPE:
    """One encoder per worker and file."""
    if path not in _loaded:
        _loaded[path] = ByteBPE(path)
    return _loaded[path]


def _digest(bpe: ByteBPE, ids: np.ndarray) -> tuple[int, str, str]:
    listed = ",".join(map(bpe.decimal_of.__getitem__, ids.tolist()))
    return len(ids), hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(bpe.decode(ids)).hexdigest()


DIGEST = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode_decode(docs: DataFrame, tokenizer: str | None = None, leaf_chars: int = LEAF_CHARS, keep_ids: bool = False) -> DataFrame:
    """Encode and decode every text; one row per row of ``docs`` (doc_id, text; other columns are ignored).

    Returns doc_id, n_tokens, ids_sha256, decoded_sha256 and, with ``keep_ids``, ids (array of int).
    Null and empty texts have no tokens. Repeated rows and null ids give a row each. Texts longer
    than ``leaf_chars`` are cut at special tokens, and what lies between them is spread over tasks in
    2^k leaves; the leaves of one document meet again in one group, never more than that.
    Special-token strings in a text are those tokens.
    """
    path = tokenizer or default_tokenizer()
    schema = DIGEST + (", ids array<int>" if keep_ids else "")
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    n = F.length("text")

    def row(bpe: ByteBPE, ids: np.ndarray) -> tuple:
        return (*_digest(bpe, ids), ids.tolist()) if keep_ids else _digest(bpe, ids)

    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"][: 4 + keep_ids]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32())]

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in slices(batches, 1):
            rows = [row(bpe, bpe.encode(t)) for t in batch.column(1).to_pylist()]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), types[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=names)

    short = d.filter(n <= leaf_chars).mapInArrow(whole, schema)

    # Special tokens stand alone, so a text is cut there first; what lies between is halved.
    special = list(load(path).special)
    at_special = "|".join(map(re.escape, special))
    segments = F.filter(F.split("text", f"(?<={at_special})|(?={at_special})"), lambda x: x != "") if special else F.array("text")
    halvings = F.greatest(F.lit(0), F.ceil(F.log2(F.length("segment") / leaf_chars)))
    leaves = F.pow(F.lit(2), F.when(F.col("segment").isin(special), 0).otherwise(halvings)).cast("int")
    each = F.ceil(F.length("segment") / F.col("leaves")).cast("int")
    cut = (
        d.filter(n > leaf_chars)
        .withColumn("row", F.monotonically_increasing_id())
        .select("row", "doc_id", F.posexplode(segments).alias("at", "segment"))
        .withColumn("leaves", leaves)
        .select("row", "doc_id", "at", F.posexplode(F.transform(F.sequence(F.lit(0), F.col("leaves") - 1), lambda k: F.substring("segment", k * each + 1, each))).alias("leaf", "part"))
        .repartition("row", "at", "leaf")
    )

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in slices(batches, 4):
            lens, ids = [], []
            for text in batch.column(4).to_pylist():
                found = bpe.leaf(text)
                lens.append(np.asarray([(len(p), len(i) // 2) for p, i in found], "<u4").tobytes())
                ids.append(b"".join(i for _, i in found))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lens, pa.binary()), pa.array(ids, pa.binary())], names=["row", "doc_id", "at", "leaf", "part", "lens", "ids"])

    def joined(pdf):
        import pandas as pd

        bpe, pdf = load(path), pdf.sort_values(["at", "leaf"])
        levels: dict[int, list] = {}
        for segment, text, lens, data in zip(pdf["at"], pdf["part"], pdf["lens"], pdf["ids"]):
            at = held = 0
            pieces = []
            for chars, tokens in np.frombuffer(lens, "<u4").reshape(-1, 2).tolist():
                pieces.append((text[at : at + chars], data[held : held + 2 * tokens]))
                at, held = at + chars, held + 2 * tokens
            levels.setdefault(segment, []).append(pieces)
        out = []
        for level in levels.values():
            while len(level) > 1:
                level = [bpe.join(level[k], level[k + 1]) if k + 1 < len(level) else level[k] for k in range(0, len(level), 2)]
            out += [i for _, i in level[0]]
        ids = np.frombuffer(b"".join(out), "<u2")
        return pd.DataFrame([(pdf.doc_id.iloc[0], *row(bpe, ids))], columns=names).astype({"doc_id": "Int64"})

    parts = cut.mapInArrow(encoded, "row long, doc_id long, at int, leaf int, part string, lens binary, ids binary")
    return short.unionByName(parts.groupBy("row").applyInPandas(joined, schema))
