"""What no bound may leave out: all unlabelled rows, special tokens within long texts, and the pipeline as a whole."""

import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from palimpsest.llm import bpe, pu_quality

WORDS = ["".join(random.Random(k).choices("abcdefghijklmnop", k=3 + k % 6)).capitalize() for k in range(200)]


def web(r, good):
    """Good rows are sentences; the others repeat a few words among signs."""
    some = r.choices(WORDS, k=60)
    return " ".join(w.lower() + ("." if k % 9 == 8 else "") for k, w in enumerate(some)) if good else " ".join(r.choice(["# buy", "$ now", "| click", "& & &", "| 1 |"]) for _ in range(60))


@pytest.fixture(scope="module")
def corpus(spark):
    r = random.Random(4)
    good = {k: r.random() < 0.6 for k in range(900)}
    docs = spark.createDataFrame([(k, web(r, g), "en", 0.5) for k, g in good.items()] + [(None, "no id", "en", 0.5), (900, None, "en", 0.5)], "doc_id long, text string, lang string, score double")
    labels = spark.createDataFrame([(k, int(g)) for k, g in good.items() if k % 3 == 0], "doc_id long, quality int")
    return docs, labels, good


def test_risk_is_taken_over_all_unlabelled_rows(corpus):
    rows = pu_quality.described(corpus[0]).repartition(7).persist()
    x = np.array([r.x for r in rows.collect()], float)
    own = pu_quality.Unlabelled(rows)
    assert own.n == len(x) == 902 and np.allclose(own.mean, x.mean(0)) and np.allclose(own.scale, x.std(0) + 1e-6)
    net = pu_quality.Network(own.mean, own.scale)
    loss, slopes = own.risk(net)
    assert np.isclose(loss, np.log1p(np.exp(net.logits(net.inputs(x)))).mean())
    for k, at in ((0, (3, 5)), (1, (2,)), (2, (4,)), (3, (0,))):  # against differences
        up, down = net.copy(), net.copy()
        up.w[k][at] += 1e-5
        down.w[k][at] -= 1e-5
        want = (np.log1p(np.exp(up.logits(net.inputs(x)))).mean() - np.log1p(np.exp(down.logits(net.inputs(x)))).mean()) / 2e-5
        assert np.isclose(slopes[k][at], want, rtol=1e-4, atol=1e-8)
    cuts = np.array([0.1, 0.5, 0.5001, 0.9])
    p = net.probability(x)
    assert np.allclose(own.tails(net, cuts), [(p >= c).mean() for c in cuts])
    rows.unpersist()


def test_descent_from_few_rows_lowers_the_risk_over_all(corpus):
    docs, _, good = corpus
    rows = pu_quality.described(docs).persist()
    own = pu_quality.Unlabelled(rows)
    x = {r.doc_id: r.x for r in rows.collect()}
    p = np.array([x[k] for k, g in good.items() if g][:40], float)
    net, risks = pu_quality.descend(pu_quality.Network(own.mean, own.scale), p, own, 0.6)
    assert len(risks) == pu_quality.STEPS and risks[-1] < risks[0] / 2
    # All rows decide: the same steps over a part of them lead elsewhere.
    part = pu_quality.Unlabelled(rows.filter("doc_id < 450"))
    assert not np.allclose(net.w[2], pu_quality.descend(pu_quality.Network(own.mean, own.scale), p, part, 0.6)[0].w[2])
    rows.unpersist()


def test_held_out_quality(corpus):
    docs, labels, good = corpus
    found = pu_quality.score(docs, labels, start=60).collect()  # the starting point sees 60 rows
    assert len(found) == 902 and all(0 <= r.score <= 1 for r in found)
    held = [r for r in found if r.held_out and r.doc_id in good]
    assert len(held) > 120 and sum(r.predicted == good[r.doc_id] for r in held) >= 0.97 * len(held)
    flipped = labels.selectExpr("doc_id", "if(crc32(cast(cast(doc_id AS string) AS binary)) % 5 = 0, 1 - quality, quality) AS quality")
    for a, b in zip(sorted(found, key=str), sorted(pu_quality.score(docs, flipped, start=60).collect(), key=str)):
        assert a.doc_id == b.doc_id and abs(a.score - b.score) < 1e-6  # labels of the held-out fold are never read


def test_special_tokens_within_long_texts(spark):
    mark = "<|endoftext|>"
    r = random.Random(8)
    prose = lambda n: " ".join(r.choices(WORDS, k=n))
    texts = [mark, mark * 3, mark + prose(400), prose(400) + mark, prose(300) + f" {mark} " + prose(3) + mark * 2 + "\n\n" + prose(500), ("ab " * 30 + mark) * 90, "x" * 5000 + mark + "é" * 3000, prose(200) + "<|endoftext" + prose(90), "<|" + mark + "|>" + "  " * 900 + mark + "  "]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    library = Tokenizer.from_file(bpe.default_tokenizer())
    want = {k: library.encode(t, add_special_tokens=False).ids for k, t in enumerate(texts)}
    for leaf in (8, 130, 2_000):
        found = {r.doc_id: r for r in bpe.encode_decode(docs, leaf_chars=leaf, keep_ids=True).collect()}
        assert {k: list(r.ids) for k, r in found.items()} == want
        for k, r in found.items():
            assert r.decoded_sha256 == hashlib.sha256(library.decode(want[k], skip_special_tokens=False).encode()).hexdigest()
