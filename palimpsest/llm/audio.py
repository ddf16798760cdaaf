"""Telephony audio as media columns.

Payload bytes are kept as 8-bit G.711 samples (mu-law or A-law) or as 4-bit IMA ADPCM blocks in a
WAV container. Decoding expands mu-law and A-law by lookup tables, runs the ADPCM recursion with
numpy across all blocks of a batch at once, and resamples the PCM from 8 to 16 kHz. PCM lies on disk
losslessly coded: what interpolation gives is left out, the rest is told by G.711 codes or those of an
adaptive quantiser where they give it exactly.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.llm.common import slices, staged, texts_of

UNIT = 576  # payloads are padded with bytes 255 to a positive multiple of this
BLOCK = 36  # bytes of an ADPCM block: 4 of header, 32 of samples; 18 blocks hold a unit
RATE, PCM_RATE = 8_000, 16_000
MULAW, ALAW, ADPCM = 7, 6, 17  # WAV format tags
FORMATS = (MULAW, ALAW, ADPCM)
NAMES = {MULAW: "mulaw", ALAW: "alaw", ADPCM: "adpcm"}

#: Fixed values of IMA ADPCM: how a sample's low bits move the step index.
INDEX_MOVES = np.array([-1, -1, -1, -1, 2, 4, 6, 8], np.int32)


#: Fixed values of IMA ADPCM: the quantiser's step sizes.
STEPS = np.array(
    [7, 8, 9, 10, 11, 12, 13, 14, 16, 17, 19, 21, 23, 25, 28, 31, 34, 37, 41, 45, 50, 55, 60, 66, 73, 80, 88, 97, 107, 118]
    + [130, 143, 157, 173, 190, 209, 230, 253, 279, 307, 337, 371, 408, 449, 494, 544, 598, 658, 724, 796, 876, 963, 1060]
    + [1166, 1282, 1411, 1552, 1707, 1878, 2066, 2272, 2499, 2749, 3024, 3327, 3660, 4026, 4428, 4871, 5358, 5894, 6484]
    + [7132, 7845, 8630, 9493, 10442, 11487, 12635, 13899, 15289, 16818, 18500, 20350, 22385, 24623, 27086, 29794, 32767],
    np.int32,
)


def mulaw_table() -> np.ndarray:
    code = ~np.arange(256) & 255
    size = ((((code & 15) << 3) + 132) << ((code >> 4) & 7)) - 132
    return np.where(code & 128, -size, size).astype(np.int16)


def alaw_table() -> np.ndarray:
    code = np.arange(256) ^ 85
    exponent, base = (code >> 4) & 7, ((code & 15) << 4) + 8
    size = np.where(exponent > 0, (base + 256) << np.maximum(exponent - 1, 0), base)
    return np.where(code & 128, size, -size).astype(np.int16)


TABLES = {MULAW: mulaw_table(), ALAW: alaw_table()}


def payload(text: str) -> bytes:
    data = text.encode()
    return data + b"\xff" * (max(1, -(-len(data) // UNIT)) * UNIT - len(data))


def wav(data: bytes, tag: int) -> bytes:
    """A WAV file that holds ``data`` unchanged as samples of the format."""
    align, bits, extra = (BLOCK, 4, struct.pack("<HH", 2, 2 * (BLOCK - 4) + 1)) if tag == ADPCM else (1, 8, struct.pack("<H", 0))
    if tag == ADPCM:
        blocks = np.zeros((len(data) // (BLOCK - 4), BLOCK), np.uint8)
        blocks[:, 4:] = np.frombuffer(data, np.uint8).reshape(-1, BLOCK - 4)
        data = blocks.tobytes()
    per_second = RATE if tag != ADPCM else RATE * BLOCK // (2 * (BLOCK - 4) + 1)
    head = struct.pack("<HHIIHH", tag, 1, RATE, per_second, align, bits) + extra
    body = b"WAVEfmt " + struct.pack("<I", len(head)) + head + b"data" + struct.pack("<I", len(data)) + data
    return b"RIFF" + struct.pack("<I", len(body)) + body


def parse(media: bytes) -> tuple[int, bytes]:
    """(format tag, bytes of the data chunk) of a WAV file."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        raise ValueError("not a WAV file")
    at, tag, data = 12, 0, b""
    while at + 8 <= len(media):
        kind, size = media[at : at + 4], int.from_bytes(media[at + 4 : at + 8], "little")
        if kind == b"fmt ":
            tag = int.from_bytes(media[at + 8 : at + 10], "little")
        elif kind == b"data":
            data = media[at + 8 : at + 8 + size]
        at += 8 + size + size % 2
    return tag, data


def samples_of(tag: int, data: bytes) -> bytes:
    """The payload that the data chunk holds."""
    return np.frombuffer(data, np.uint8).reshape(-1, BLOCK)[:, 4:].tobytes() if tag == ADPCM else data


def decode_adpcm(blocks: np.ndarray) -> np.ndarray:
    """PCM of IMA ADPCM blocks (n, BLOCK): one recursion over the samples of a block, across all blocks."""
    n = len(blocks)
    value = blocks[:, :2].copy().view("<i2")[:, 0].astype(np.int32)
    index = np.minimum(blocks[:, 2].astype(np.int32), 88)
    out = np.empty((2 * (BLOCK - 4) + 1, n), np.int16)
    out[0] = value
    codes = np.empty((2 * (BLOCK - 4), n), np.int32)
    codes[0::2], codes[1::2] = (blocks[:, 4:] & 15).T, (blocks[:, 4:] >> 4).T
    for k, code in enumerate(codes):
        step = STEPS[index]
        change = (step >> 3) + np.where(code & 4, step, 0) + np.where(code & 2, step >> 1, 0) + np.where(code & 1, step >> 2, 0)
        value = np.clip(np.where(code & 8, value - change, value + change), -32_768, 32_767)
        index = np.clip(index + INDEX_MOVES[code & 7], 0, 88)
        out[k + 1] = value
    return np.ascontiguousarray(out.T)


def resample(pcm: np.ndarray) -> np.ndarray:
    """8 to 16 kHz: each sample, then the mean of it and the next (rounded down)."""
    out = np.empty(2 * len(pcm), np.int16)
    out[0::2] = pcm
    after = np.append(pcm[1:], pcm[-1:]).astype(np.int32)
    out[1::2] = (pcm.astype(np.int32) + after) >> 1
    return out


def features(tag: int, pcm: np.ndarray) -> str:
    wide = pcm.astype(np.int64)
    crossings = int(np.count_nonzero((pcm[1:] < 0) != (pcm[:-1] < 0)))
    return f"{NAMES[tag]} samples={len(pcm)} peak={int(np.abs(wide).max())} power={int(np.dot(wide, wide)) // len(pcm)} crossings={crossings} crc={zlib.crc32(pcm.tobytes())}"


PLAIN = 0  # coded PCM begins with a format tag (how its 8 kHz samples are told) or this
FRAME = 2 * (BLOCK - 4) + 1  # samples of an ADPCM block
ANEW = 16  # added to a code before which the step index is set anew

#: The 16-bit samples (as unsigned) that a G.711 table has, and for each its code: the greatest.
KNOWN = {tag: np.isin(np.arange(65_536, dtype=np.uint16), table.view(np.uint16)) for tag, table in TABLES.items()}
CODES = {tag: np.zeros(65_536, np.uint8) for tag in TABLES}
for _tag, _table in TABLES.items():
    CODES[_tag][_table.view(np.uint16)] = np.arange(256)

#: The change that each code makes at each step index, and the last index (and code) that makes a change (from -65,535; -1: none).
CHANGES = np.array([[(step >> 3) + (step if c & 4 else 0) + (step >> 1 if c & 2 else 0) + (step >> 2 if c & 1 else 0) for c in range(8)] for step in STEPS.tolist()], np.int32)
CHANGES = np.concatenate([CHANGES, -CHANGES], axis=1)
MAKING = np.full(131_071, -1, np.int32)
MAKING[CHANGES.ravel() + 65_535] = np.arange(CHANGES.size)
LARGEST = np.array([7, 15, 6, 14, 5, 13, 4, 12, 3, 11, 2, 10, 1, 9, 0, 8])  # codes by size of their change, and the changes so
BY_SIZE = np.ascontiguousarray(CHANGES[:, LARGEST])


def _clipped(x: np.ndarray) -> np.ndarray:
    return np.clip(x, -32_768, 32_767)


def _stepped(frames: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """8 kHz frames (n, FRAME) as (codes (n, FRAME - 1), indexes (n, FRAME - 1)); None where no codes give the samples.

    An adaptive quantiser follows the samples. Where its range cuts off what it did, its index is a guess: a code plus ANEW says
    that the index is to be set from ``indexes``.
    """
    n = len(frames)
    value, index = np.zeros(n, np.int32), np.zeros(n, np.int32)
    codes, anew = np.empty((n, FRAME - 1), np.uint8), np.zeros((n, FRAME - 1), np.uint8)
    if frames[:, 0].any():
        return None
    for k in range(FRAME - 1):
        target = frames[:, k + 1].astype(np.int32)
        fits = _clipped(value[:, None] + BY_SIZE[index]) == target[:, None]
        first = fits.argmax(axis=1)
        code, off = LARGEST[first], np.flatnonzero(~fits[np.arange(n), first])
        if len(off):
            made = MAKING[target[off] - value[off] + 65_535]
            for j in np.flatnonzero(made < 0):  # only at either end of the range
                every = np.flatnonzero(_clipped(value[off[j]] + CHANGES.ravel()) == target[off[j]])
                if not len(every):
                    return None
                made[j] = every[-1]
            index[off], code[off] = made >> 4, made & 15
            anew[off, k] = index[off]
        codes[:, k] = code
        codes[off, k] |= ANEW
        value = target
        index = np.clip(index + INDEX_MOVES[code & 7], 0, 88)
    return codes, anew


def _followed(codes: np.ndarray, anew: np.ndarray) -> np.ndarray:
    """The frames of _stepped()."""
    out = np.zeros((FRAME, len(codes)), np.int16)
    value, index = np.zeros(len(codes), np.int32), np.zeros(len(codes), np.int32)
    for k, (code, own) in enumerate(zip(np.ascontiguousarray(codes.T), np.ascontiguousarray(anew.T))):
        index = np.where(code & ANEW, own, index)
        code = code & 15
        value = _clipped(value + CHANGES[index, code])
        index = np.clip(index + INDEX_MOVES[code & 7], 0, 88)
        out[k + 1] = value
    return np.ascontiguousarray(out.T)


def encode_pcm(every: list[np.ndarray]) -> list[bytes]:
    """16 kHz PCM of several texts, each losslessly coded by itself.

    Samples are left out where they are what resample() makes of the others. Those are told by their G.711 codes where a
    G.711 table has them all, else by the codes of an adaptive quantiser where those give them exactly. All other PCM stays plain.
    """
    out, frames = [], {}
    for k, pcm in enumerate(every):
        own = np.ascontiguousarray(pcm[::2])
        out.append(struct.pack("<B", PLAIN) + pcm.tobytes())
        if len(own) and 2 * len(own) == len(pcm) and np.array_equal(resample(own), pcm):
            tag = next((tag for tag, known in KNOWN.items() if known[own.view(np.uint16)].all()), ADPCM)
            if tag != ADPCM:
                out[k] = struct.pack("<B", tag) + CODES[tag][own.view(np.uint16)].tobytes()
            elif len(own) % FRAME == 0 and not own[::FRAME].any():
                frames[k] = own.reshape(-1, FRAME)
    told = _stepped(np.concatenate(list(frames.values()))) if frames else None
    if told:
        ends = np.cumsum([len(x) for x in frames.values()])[:-1]
        for k, codes, anew in zip(frames, np.split(told[0], ends), np.split(told[1], ends)):
            out[k] = struct.pack("<BI", ADPCM, codes.size) + codes.tobytes() + anew[codes >= ANEW].tobytes()
    elif len(frames) > 1:  # one of them is another kind of PCM
        for k in frames:
            out[k] = encode_pcm([every[k]])[0]
    return out


def decode_pcm(every: list[bytes]) -> list[np.ndarray]:
    """The PCM that encode_pcm() was given; what an adaptive quantiser told goes through one recursion."""
    out, codes, anew = [], {}, {}
    for k, data in enumerate(every):
        tag = data[0]
        if tag == ADPCM:
            size = struct.unpack_from("<I", data, 1)[0]
            codes[k] = np.frombuffer(data, np.uint8, size, 5).reshape(-1, FRAME - 1)
            anew[k] = np.zeros_like(codes[k])
            anew[k][codes[k] >= ANEW] = np.frombuffer(data, np.uint8, offset=5 + size)
            out.append(None)
        else:
            out.append(np.frombuffer(data, np.int16, offset=1) if tag == PLAIN else resample(TABLES[tag][np.frombuffer(data, np.uint8, offset=1)]))
    if codes:
        frames = _followed(np.concatenate(list(codes.values())), np.concatenate(list(anew.values())))
        for k, own in zip(codes, np.split(frames, np.cumsum([len(x) for x in codes.values()])[:-1])):
            out[k] = resample(own.ravel())
    return out


def store(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes (unpadded) and media (a WAV per text; equal texts, equal media).

    The format goes by the text's checksum, so all three occur. Null texts are empty; a payload has
    one unit at least. Repeated rows, null ids and extra columns change nothing for the others.
    """

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            data = [payload(t) for t in texts_of(batch.column(1))]
            sizes = pa.array([len(t.encode()) for t in texts_of(batch.column(1))], pa.int64())
            media = pa.array([wav(x, FORMATS[zlib.crc32(x) % 3]) for x in data], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, media], names=["doc_id", "n_bytes", "media"])

    return docs.select("doc_id", "text").mapInArrow(made, "doc_id long, n_bytes long, media binary")


def _decoded(found: list[tuple[int, bytes]]) -> list[np.ndarray]:
    """8 kHz PCM of several data chunks; all ADPCM blocks go through one recursion."""
    all_blocks = [np.frombuffer(d, np.uint8).reshape(-1, BLOCK) for t, d in found if t == ADPCM]
    pcm = iter(np.split(decode_adpcm(np.concatenate(all_blocks)), np.cumsum([len(x) for x in all_blocks])[:-1]) if all_blocks else [])
    return [next(pcm).ravel() if t == ADPCM else TABLES[t][np.frombuffer(d, np.uint8)] for t, d in found]


PCM_COLUMNS = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, format long, pcm binary"


def resampled(media: DataFrame) -> DataFrame:
    """pcm (16-bit little-endian at 16 kHz) of stored media, with format and the digest of what was read back."""
    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "format", "pcm"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.binary()]

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2, 1_000_000):
            files = batch.column(2).to_pylist()
            found = [parse(m) for m in files]
            rows = []
            for m, (tag, data), pcm in zip(files, found, _decoded(found)):
                own = samples_of(tag, data)
                rows.append((len(own), hashlib.sha256(own).hexdigest(), zlib.crc32(own[-32:]), len(m), hashlib.sha256(m).hexdigest(), tag, resample(pcm).tobytes()))
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), types[2:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=names)

    return media.select("doc_id", "n_bytes", "media").mapInArrow(made, PCM_COLUMNS)


def described(pcm: DataFrame) -> DataFrame:
    """The digest of stored media, and features of the stored PCM."""
    kept = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256"]

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 8, 8_000_000):
            found = zip(batch.column(7).to_pylist(), batch.column(8))
            own = pa.array([features(tag, np.frombuffer(x.as_buffer(), "<i2")) for tag, x in found], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:7], own], names=[*kept, "feature"])

    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return pcm.select(*kept, "format", "pcm").mapInArrow(made, schema)


def coded(pcm: DataFrame) -> DataFrame:
    """resampled() as it lies on disk: each pcm by encode_pcm()."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 8, 8_000_000):
            data = encode_pcm([np.frombuffer(x.as_buffer(), "<i2") for x in batch.column(8)])
            yield pa.RecordBatch.from_arrays([*batch.columns[:8], pa.array(data, pa.binary())], names=batch.schema.names)

    return pcm.mapInArrow(made, PCM_COLUMNS)


def uncoded(stored: DataFrame) -> DataFrame:
    """What coded() was given."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 8, 2_000_000):
            data = [x.tobytes() for x in decode_pcm(batch.column(8).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:8], pa.array(data, pa.binary())], names=batch.schema.names)

    return stored.mapInArrow(made, PCM_COLUMNS)


#: How both tables are written: repeats are found over pages of 8 MB.
PACKED = {"compression": "zstd", "parquet.compression.codec.zstd.level": "6", "parquet.page.size": str(8 << 20)}


def telephony(docs: DataFrame) -> DataFrame:
    """Store every text as telephony audio, store the PCM of what is read back, and describe both."""
    media = staged(store(docs), "media", **PACKED)
    return described(staged(resampled(media), "pcm", codec=(coded, uncoded), **PACKED))
