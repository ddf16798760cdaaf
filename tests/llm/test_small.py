"""The operators on a fixture with nulls, empty and blank texts, repeated rows, copies, and columns with other names' values."""

import hashlib
import math
import os
import random
import re
import time
import zlib
from collections import Counter

import pytest
from tokenizers import Tokenizer

from palimpsest.llm import audio, bpe, lattice_lm, ngram_join, packing, pii, pu_quality, quality_rules, sharding, toxicity

R = random.Random(5)
VOCABULARY = ["".join(R.choice("abcdefghij") for _ in range(R.randint(2, 7))) for _ in range(300)]


def prose(n):
    return " ".join(R.choice(VOCABULARY) for _ in range(n))


LONG = prose(9000)
ROWS = [(0, None), (1, ""), (2, " \n\t"), (3, "one two"), (3, "one two"), (4, "ONE two"), (None, "no id"), (5, LONG), (6, LONG + " end"), (7, "Mail a.b@c.de or 192.168.0.1, +1 (555) 123-4567, 4111 1111 1111 1111 <|endoftext|>"), (8, "x" * 20_000), (9, "é" * 5000 + "😀 " * 500)]
ROWS += [(10 + k, prose(60)) for k in range(30)]


@pytest.fixture(scope="module")
def docs(spark):
    # Extra columns carry names that operators use inside.
    return spark.createDataFrame([(k, t, "en", "s", 1, "x") for k, t in ROWS], "doc_id long, text string, lang string, rank string, n long, part string")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(bpe.default_tokenizer())


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def test_bpe_matches_the_library(docs, tokenizer):
    want = Counter((k, len(i := ids_of(tokenizer, t)), hashlib.sha256(",".join(map(str, i)).encode()).hexdigest(), hashlib.sha256(tokenizer.decode(i, skip_special_tokens=False).encode()).hexdigest()) for k, t in ROWS)
    for leaf in (bpe.LEAF_CHARS, 700):  # the second spreads long texts over leaves
        assert Counter(map(tuple, bpe.encode_decode(docs, leaf_chars=leaf).collect())) == want


def test_packing_is_exact_and_gapless(docs, tokenizer):
    rows = packing.pack(docs, keep_ids=True).collect()
    total = sum(len(ids_of(tokenizer, t)) + 1 for _, t in ROWS)
    assert sum(r.length for r in rows) == total
    by = {}
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in r.ids))
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    assert len(by) <= -(-total // packing.CAPACITY) + 1


def test_plan_uses_every_piece():
    counts = {R.randint(1, 50): R.randint(1, 200) for _ in range(20)}
    used = Counter()
    for lengths, times in packing.plan(counts, 50):
        assert sum(lengths) <= 50
        for x in lengths:
            used[x] += times
    assert used == counts


def test_shards_are_even_and_slots_gapless(docs):
    rows = sharding.shard(docs, 5).collect()
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    assert len(rows) == len(ROWS) and max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_audio_round_trip(docs):
    for r in audio.telephony(docs).collect():
        assert r.payload_bytes % audio.UNIT == 0 and r.payload_bytes >= max(1, r.n_bytes)
    for tag in audio.FORMATS:
        data = bytes(R.randrange(256) for _ in range(576 * 3))
        found, chunk = audio.parse(audio.wav(data, tag))
        assert found == tag and audio.samples_of(tag, chunk) == data
    assert audio.TABLES[audio.MULAW][[0, 255]].tolist() == [-32124, 0] and audio.TABLES[audio.ALAW][[213, 85]].tolist() == [8, -8]
    assert audio.STEPS[:10].tolist() == [7, 8, 9, 10, 11, 12, 13, 14, 16, 17] and audio.STEPS[-1] == 32767


def test_pcm_is_stored_and_described_as_read_back(docs, monkeypatch):
    tables, write = {}, audio.staged
    monkeypatch.setattr(audio, "staged", lambda df, name, **options: tables.setdefault(name, write(df, name, **options)))
    found = {(r.doc_id, r.payload_sha256): r.feature for r in audio.telephony(docs).collect()}
    media = {(r.doc_id, hashlib.sha256(r.media).hexdigest()): r.media for r in tables["media"].collect()}
    rows = tables["pcm"].collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        tag, data = audio.parse(bytes(media[r.doc_id, r.media_sha256]))
        pcm = audio.decode_adpcm(audio.np.frombuffer(data, "u1").reshape(-1, audio.BLOCK)).ravel() if tag == audio.ADPCM else audio.TABLES[tag][list(data)]
        assert r.format == tag and bytes(r.pcm) == audio.resample(pcm).tobytes()
        assert f"crc={zlib.crc32(r.pcm)}" in found[r.doc_id, r.payload_sha256]


def test_pcm_is_stored_in_few_bytes_and_without_loss(docs, monkeypatch):
    np, sizes, encode = audio.np, Counter(), audio.encode_pcm
    text = " ".join(t for k, t in ROWS if (k or 0) >= 10).encode()
    data = text + b"\xff" * (-len(text) % audio.UNIT)
    every = [audio.resample(audio._decoded([audio.parse(audio.wav(data[k:] + data[:k], tag))])[0].ravel()) for tag in audio.FORMATS for k in (0, 1)]
    for pcm, found in zip(every, encode(every)):
        assert found[0] != audio.PLAIN and len(found) < pcm.nbytes / 3
        assert np.array_equal(audio.decode_pcm([found])[0], pcm)
    noise = np.frombuffer(bytes(R.randrange(256) for _ in range(2 * 65 * 40)), "<i2")
    framed = np.where(np.arange(len(noise)) % 65 == 0, 0, noise).astype(np.int16)
    odd = [noise, noise[:0], noise[:1], audio.resample(noise), audio.resample(framed), audio.resample(framed // 512), *every]
    assert all(np.array_equal(a, b) for a, b in zip(audio.decode_pcm(encode(odd)), odd))
    assert encode(odd)[-1][0] == encode(every)[-1][0] == audio.ADPCM  # whatever else is in the batch

    folders, write = {}, audio.staged

    def staged(df, name, **options):
        return folders.setdefault(name, write(df, name, **options))

    monkeypatch.setattr(audio, "staged", staged)
    assert audio.telephony(docs).count() == len(ROWS)
    folders["plain"] = write(audio.resampled(folders["media"]), "plain", compression="zstd")
    for name in ("pcm", "plain"):
        for path in folders[name].inputFiles():
            sizes[name] += os.path.getsize(path.removeprefix("file://"))
    assert sizes["pcm"] < 0.7 * sizes["plain"], sizes


def test_join_matches_brute_force(docs):
    def grams(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in t or ""))
        return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()

    sets = [grams(t) for _, t in ROWS]
    comp = list(range(len(ROWS)))
    for a in range(len(ROWS)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = comp[a], comp[b]
                comp = [y if c == x else c for c in comp]
    least = {c: min((ROWS[k][0] for k in range(len(ROWS)) if comp[k] == c and ROWS[k][0] is not None), default=None) for c in comp}
    want = Counter((ROWS[k][0], len(sets[k]), least[comp[k]]) for k in range(len(ROWS)))
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(docs).collect()) == want


def test_join_loses_no_link_near_the_threshold(spark):
    # Pairs of about 0.75 to 0.9, of other lengths, each in several copies over several tasks; words that many texts share.
    rows, sets = [], []
    for _ in range(250):
        w = [f"w{R.randrange(4000)}" for _ in range(R.randint(20, 120))]
        x = w[R.randint(0, 4) : len(w) - R.randint(0, 4)]
        for _ in range(R.randint(0, 1 + len(x) // 60)):
            x[R.randrange(len(x))] = f"w{R.randrange(4000)}"
        rows += [" ".join(w), " ".join(x), " ".join(w).upper()]
    for t in rows:
        w = t.lower().split()
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)})
    pairs = [(a, b) for a in range(0, len(rows), 3) for b in (a + 1, a + 2) if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    assert len(pairs) > 350
    want = {k: k for k in range(len(rows))} | {b: a for a, b in pairs}
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(4)
    assert {r.doc_id: r.component_id for r in ngram_join.near_duplicates(docs).collect()} == want


def test_join_stores_what_may_link_only(spark, monkeypatch):
    # Copies in several tasks, and a passage in texts of very different length: no other set that may link has their n-grams.
    texts = [" ".join(f"t{k}w{n}" for n in range(60)) for k in range(40)]
    rows = [t for t in texts for _ in range(4)] + [" ".join(texts[k].split()[:20]) for k in range(40)]
    folders, write = {}, ngram_join.staged

    def staged(df, name, **options):
        folders.setdefault(name, []).append(out := write(df, name, **options))
        if name == "postings":
            folders["stored"] = out.count()
        return out

    monkeypatch.setattr(ngram_join, "staged", staged)
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(4)
    assert len({r.component_id for r in ngram_join.near_duplicates(docs).collect()}) == 80
    assert folders["stored"] == 0 and "prefixes" not in folders


def test_filter_of_wanted_texts_grows_with_them():
    assert ngram_join.slots_for(0) == ngram_join.slots_for(30_000) == ngram_join.SLOTS[0]
    assert all(ngram_join.slots_for(n) >= 64 * n for n in (131_072, 131_073, 2_000_000))
    assert ngram_join.slots_for(10**9) == ngram_join.SLOTS[1]


def test_keep_one_loses_no_document(spark):
    a, b, c, d = (prose(60) for _ in range(4))
    # No ids; one id with several texts, one of them in another's group; a group without any id; repeats; no words.
    rows = [(None, a), (1, b), (2, b + " end"), (2, c), (2, d), (None, d + " end"), (3, d), (None, "x y"), (None, "x y"), (4, None), (4, None), (4, ""), (None, " "), (5, " ")]
    docs = spark.createDataFrame([(k, t, "en") for k, t in rows], "doc_id long, text string, lang string")
    want = [(None, a), (1, b), (2, c), (2, d), (None, "x y"), (4, None), (4, ""), (None, " "), (5, " ")]
    found = ngram_join.keep_one(docs)
    assert found.columns == docs.columns and Counter((r.doc_id, r.text) for r in found.collect()) == Counter(want)


def test_base_spans(docs):
    found = {r.doc_id: r for r in pii.find(docs).collect()}[7]
    assert (found.n_email, found.n_ip, found.n_card, found.n_phone) == (1, 1, 1, 1)
    redacted = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert "[EMAIL]" in redacted[7] and "a.b@c.de" not in redacted[7] and redacted[0] is None and redacted[5] == LONG


def luhn(digits):
    return sum(int(c) if k % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for k, c in enumerate(reversed(digits))) % 10 == 0


BASE = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda v: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda v: all(int(x) <= 255 for x in v.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda v: 12 <= len(d := re.sub("[^0-9]", "", v)) <= 19 and luhn(d)),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda v: 9 <= len(re.sub("[^0-9]", "", v)) <= 15),
}


def base_spans(text):
    found = [(m.start(), k, m.end()) for k, (pattern, good) in enumerate(BASE.values()) for m in re.finditer(pattern, text or "") if good(m[0])]
    return sorted(found)


def personal_texts():
    parts = ["a.b@c.de", "1.2.3.4", "1.2.3.4.5@x.org", "256.1.1.1", "4111 1111 1111 1111", "4111111111111112", "+1 (555) 123-4567", "+4111111111111111", "+12 34", "key=ghp_a1B2c3D4e5F6g7H8i9J0"]
    parts += ["token: 9f86d081884c7d659a2feaa0c55ad015", "v2", "😀é", "x@y", "a@b.c@d.e", "1.1.1.1.1.1.1.1", "on 3 May", "\n", "-", "+49 30 1.2.3.4 567"]
    out = ["".join(R.choice(parts) + R.choice([" ", "", "\n", ", "]) for _ in range(R.randint(1, 25))) for _ in range(120)]
    return [None, "", " ", *out, *out[:3], "😀" * 700 + " ".join(out[:20])]


def test_found_spans_match_brute_force(spark):
    texts = personal_texts()
    docs = spark.createDataFrame([(k, t, 1, "x") for k, t in enumerate(texts)], "doc_id long, text string, base int, `k.email` string")
    rows = pii.find(docs).collect()
    assert len(rows) == len(texts)
    spans = {}
    for r in rows:
        want, text = base_spans(texts[r.doc_id]), texts[r.doc_id] or ""
        listed = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in want)
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == j for _, k, _ in want) for j in range(4)]
        every = [(int(a), pii.KINDS.index(k), int(b)) for k, a, b in (x.split(":") for x in r.spans.split(",") if x)]
        added = [s for s in every if s[1] == 4]
        assert every == sorted(every) and [s for s in every if s[1] < 4] == want and r.n_secret == len(added)
        for a, _, b in added:  # whole words with a digit that no base span meets
            assert re.fullmatch(r"[^\x20\x09-\x0D]+", text[a:b]) and re.search("[0-9]", text[a:b]) and not any(x < b and a < y for x, _, y in want)
        spans[r.doc_id] = every
    assert any(s[1] == 4 for x in spans.values() for s in x)
    for r in pii.redact(docs).collect():
        text, out, at = texts[r.doc_id], "", 0
        for a, k, b in spans[r.doc_id]:
            out, at = out + (text[at:a] + f"[{pii.KINDS[k].upper()}]" if a >= at else ""), max(at, b)
        assert r.text == (out + text[at:] if spans[r.doc_id] else text) and r["k.email"] == "x"


def test_many_matches_take_near_linear_time(spark):
    line = "mail a.b@c.de from 10.0.0.1 with key ghp_a1B2c3D4e5F6g7H8 and more words\n"
    docs = spark.createDataFrame([(1, line * 20_000), (2, line)], "doc_id long, text string")
    started = time.perf_counter()
    found = {r.doc_id: r for r in pii.find(docs).collect()}
    assert found[1].n_email == found[1].n_ip == 20_000 and found[2].n_email == 1
    cleaned = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert cleaned[1] == cleaned[2] * 20_000 and "[EMAIL]" in cleaned[2]
    assert time.perf_counter() - started < 120


def test_rules_agree_with_each_other(docs):
    order = list(quality_rules.RULES)
    kept = Counter(r.doc_id for r in quality_rules.report(docs, order).collect() if r.kept)
    assert kept == Counter(r.doc_id for r in quality_rules.keep(docs, order[::-1]).collect()) and 12 in kept and 1 not in kept


def test_classifiers_run_without_labels(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for found in (toxicity.score(docs, none), pu_quality.score(docs, none)):
        rows = found.collect()
        assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 for r in rows)


def test_disguises_are_restored(spark, docs):
    words = spark.createDataFrame([(0, "what a stupid moron and idiot you are " * 50)], "doc_id long, text string")
    restorer = toxicity.Restorer(toxicity.character_model(words))
    assert restorer.restore(["an 1d10t", "s t u p i d", "moooron", "plain words"]) == ["an idiot", "stupid", "moron", "plain words"]


def test_toxic_documents_are_dropped(spark):
    rows = [(k, prose(8) + (" moron " if k % 2 else " ") + prose(8)) for k in range(160)] + [(None, prose(9)), (200, None), (201, "a m0ron"), (202, "m o r o n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(160)], "doc_id long, toxic int")
    want = Counter((k, t) for k, t in rows if not t or ("moron" not in t and k not in (201, 202)))
    assert Counter((r.doc_id, r.text) for r in toxicity.drop_toxic(docs, labels).collect()) == want
    assert Counter(r.doc_id for r in toxicity.score(docs, labels).collect() if not r.predicted) == Counter(k for k, _ in want.elements())


def test_each_disguise_is_restored_alone(spark):
    words = spark.createDataFrame([(0, "what a stupid moron and idiot you are, as all men say! " * 50)], "doc_id long, text string")
    restorer = toxicity.Restorer(toxicity.character_model(words))
    forms = {"you 5tupid": "you stupid", "an 1diot": "an idiot", " $tupid": " stupid", "idio7": "idiot", "m3n": "men", "m€n": "men", "€nd": "end"}
    forms |= {"a$": "as", "m e n": "men", "1 d i o t": "idiot", "s t u p 1 d": "stupid", "(m-o-r-0-n)": "(moron)", "_a_l_l_": "_all_", "MOoOron": "moron"}
    forms |= {"stupid!": "stupid!", "idiot 2024": "idiot 2024", "1 2 3": "1 2 3", "a": "a", "": ""}
    for given, want in forms.items():
        assert restorer.restore([given]) == [want]
    assert restorer.restore(list(forms)) == list(forms.values())


def test_no_span_escapes_the_prefilter():
    r, restorer = random.Random(3), toxicity.Restorer(None)
    restorer.decode = lambda span: "#"
    for _ in range(20_000):
        text = "".join(r.choice("aAbBéÉ²ı日٣_. -*15$!|€@\n") for _ in range(r.randint(1, 9)))
        whole = restorer.SPANS.sub("#", text.lower())
        assert restorer.restore([text])[0].lower() == whole or not any(c.isalpha() for m in restorer.SPANS.finditer(text.lower()) for c in m[0])


def test_word_scores(docs):
    rows = lattice_lm.score(docs).collect()
    assert len(rows) == len(ROWS) and all(r.score < 0 and r.base_score < 0 for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (0, 1, 2)} == {1}


def test_word_scores_match_brute_force(docs):
    words = {k: re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in t or "")) for k, t in enumerate(t for _, t in ROWS)}
    held = [zlib.crc32(("" if k is None else str(k)).encode()) % 5 == 1 for k, _ in ROWS]
    counts = Counter(w for k, ws in words.items() if not held[k] for w in [*ws, None])
    total, distinct = sum(counts.values()), len(counts)

    def base(ws):
        return sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in [*ws, None])

    want = Counter((ROWS[k][0], held[k], len(ws) + 1, sum(counts[w] > 0 for w in [*ws, None]), total, round(base(ws), 4)) for k, ws in words.items())
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in lattice_lm.score(docs).collect()) == want


def test_lattice_sums_over_all_segmentations():
    lattice = lattice_lm.load(lattice_lm.default_vocabulary())
    known = dict(zip(lattice.keys.tolist(), lattice.logp.tolist()))

    def piece(chars):
        points = lattice_lm.np.array([*map(ord, chars)], "u8")
        up, _ = lattice_lm.powers(len(points))
        return known.get(int(lattice_lm.mix((lattice_lm._hash(points) * up[: len(points)]).sum(keepdims=True) + lattice_lm.np.uint64(len(points)))[0]))

    def total(chars):
        if not chars:
            return 1.0
        out = 0.0
        for k in range(1, min(lattice.most, len(chars)) + 1):
            p = piece(chars[:k])
            if p is None and k == 1:
                p = len(chars[:k].encode()) * math.log(lattice_lm.BYTES / 256)
            out += math.exp(p) * total(chars[k:]) if p is not None else 0.0
        return out

    w = lattice_lm.Words(["the reading of zq€x"])
    got = lattice.words(w, lattice_lm.np.arange(len(w.begin)))
    assert [round(x, 6) for x in got] == [round(math.log(total("\u2581" + x)), 6) for x in "the reading of zq€x".split()]


def test_expected_pieces_are_those_of_all_segmentations():
    lattice = lattice_lm.Lattice(lattice_lm.default_vocabulary())
    place, np = dict(zip(lattice.keys.tolist(), range(len(lattice.keys)))), lattice_lm.np
    up, _ = lattice_lm.powers(lattice.most)

    def segmentations(chars):
        """(log probability, pieces) of each."""
        if not chars:
            yield 0.0, []
        for k in range(1, min(lattice.most, len(chars)) + 1):
            points = np.array([*map(ord, chars[:k])], "u8")
            at = place.get(int(lattice_lm.mix((lattice_lm._hash(points) * up[:k]).sum(keepdims=True) + np.uint64(k))[0]))
            if at is not None or k == 1:
                p = lattice.logp[at] if at is not None else len(chars[0].encode()) * math.log(lattice_lm.BYTES / 256)
                for q, rest in segmentations(chars[k:]):
                    yield p + q, [*([at] if at is not None else []), *rest]

    texts, times = ["reading", "of", "zq\u20acx", "the"], np.array([3, 1, 2, 5])
    want = np.zeros(len(lattice.keys))
    for text, n in zip(texts, times):
        every = list(segmentations("\u2581" + text))
        whole = sum(math.exp(p) for p, _ in every)
        for p, pieces in every:
            for at in pieces:
                want[at] += n * math.exp(p) / whole
    mass = np.zeros(len(lattice.keys))
    lattice.words(lattice_lm.Words(texts), np.arange(4), times, mass)
    assert np.allclose(mass, want, rtol=1e-9, atol=1e-12)


def test_piece_scores_learn_from_every_word(spark):
    path, np = lattice_lm.default_vocabulary(), lattice_lm.np
    counts = spark.createDataFrame([(0, "zebra", 40_000), (1, "quilt", 20_000)], "word long, spelled string, n long")
    own = lattice_lm.Lattice(path)
    likely = []
    for rounds in (0, 1, 3):
        own.logp = lattice_lm.estimate(counts, path, rounds)
        assert abs(np.exp(own.logp).sum() - (1 - lattice_lm.BYTES)) < 1e-9
        likely.append(own.words(lattice_lm.Words(["zebra", "quilt"]), np.arange(2)) @ [2, 1])
    assert likely[0] < likely[1] < likely[2]
    assert np.allclose(lattice_lm.estimate(counts.limit(0), path, 1), own.own)


def test_long_texts_take_linear_time(spark):
    started = time.perf_counter()
    restorer = toxicity.Restorer(toxicity.character_model(spark.createDataFrame([("a plain text " * 50,)], "text string")))
    for text in ("a" * 200_000, "ab" * 200_000, "s t u p 1 d " * 20_000, "1d10t " * 50_000, "x1" * 50_000):
        restorer.restore([text])
    assert time.perf_counter() - started < 60


@pytest.mark.parametrize("operator", [packing.pack, bpe.encode_decode, sharding.shard, audio.telephony, pii.find, ngram_join.near_duplicates, lattice_lm.score, quality_rules.keep])
def test_empty_tables(docs, operator):
    assert operator(docs.filter("false")).count() == 0
