"""Mixing, hard negatives and the divergence audit against their SQL and brute force, on fixtures with the edge cases."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from palimpsest.llm import divergence, hard_negatives, mixing

R = random.Random(11)
WORDS = ["".join(R.choice("abcdefg") for _ in range(R.randint(1, 9))) for _ in range(120)] + ["Größe", "ÉCOLE", "école", "word-part", "x" * 70]


def prose(n):
    return " ".join(R.choice(WORDS) for _ in range(n))


DOCS = [(k, prose(R.randint(0, 80)), R.choice(["en", "de"]), R.choice(["a", "b", "c", "d", "ü"])) for k in range(300)]
DOCS += [(300 + k, prose(30), "en", "hot") for k in range(150)]
DOCS += [(None, "no id", "en", "a"), (None, "no id, too", "en", "b"), (1, None, None, None), (2, "", "", ""), (3, " \n\t\x1c", None, "a"), (4, prose(20_000), "de", "b"), (5, "solo words", "fr", "only"), (6, "twice", "en", "a"), (6, "twice", "en", "a"), (7, "no letters: 12 34", "xx", "e"), (8, None, "xx", "f")]
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="module")
def docs(spark):
    # Extra columns carry names that the operators use inside.
    extra = "size long, key string, seed int, rank int, docs long, term string, n long"
    return spark.createDataFrame([(*r, 1, "k", 2, 3, 4, "t", 5) for r in DOCS], f"{SCHEMA}, {extra}").repartition(5)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR)")
    c.executemany("INSERT INTO documents VALUES (?, ?, ?, ?)", DOCS)
    return c


def rows(df):
    return Counter(map(tuple, df.collect()))


def test_mix_report_equals_sql(docs, duck):
    assert rows(mixing.report(docs)) == Counter(duck.execute(mixing.SQL).fetchall())


def filled(sizes, weights, share, cap):
    """The targets by the rule as told: deal, stop what is above, deal its excess to the others."""
    most = {s: cap * n for s, n in sizes.items()}
    got, left, open_ = dict.fromkeys(sizes, 0.0), share * sum(sizes.values()), set(sizes)
    while open_ and left > 1e-9:
        whole = sum(weights[s] for s in open_)
        for s in open_:
            got[s] += left * weights[s] / whole
        left = sum(got[s] - most[s] for s in open_ if got[s] > most[s])
        for s in [s for s in open_ if got[s] >= most[s]]:
            got[s] = most[s]
            open_.discard(s)
    return got


def test_mix_targets_and_copies(docs, spark):
    sizes = defaultdict(int)
    for _, text, _, source in DOCS:
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = filled(sizes, {s: mixing.WEIGHTS[k % 3] for k, s in enumerate(order)}, 1.5, 2)
    found = mixing.report(docs).join(docs.select("doc_id", "text", "source").distinct(), "doc_id").select("source", "target").distinct().collect()
    assert found and all(any(abs(r.target - t) < 1e-6 * max(1, t) for t in want.values()) for r in found)
    assert sum(want.values()) == pytest.approx(1.5 * sum(sizes.values()))
    made = mixing.mix(docs)
    assert made.columns == [*docs.columns, "copy"]
    by_source = {r.source: r.n for r in made.groupBy("source").agg({"*": "count"}).withColumnRenamed("count(1)", "n").collect()}
    assert by_source.keys() <= sizes.keys()
    words = Counter()
    for r in made.select("source", "text", "copy").collect():
        words[r.source] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
        assert r.copy in (1, 2)
    assert sum(words.values()) == mixing.report(docs).agg({"taken": "sum"}).first()[0]
    for s in ("c", "d", "ü", "hot"):
        assert abs(words[s] - want[s]) <= 0.05 * want[s] + 40


def test_mix_of_nothing(docs, spark):
    none = docs.limit(0)
    assert mixing.report(none).count() == 0 and mixing.mix(none).count() == 0
    assert mixing.report(spark.createDataFrame([(1, None, "en", "a")], SCHEMA)).collect()[0].taken == 0


def test_strassen_is_exact():
    r = np.random.default_rng(1)
    for m, k, n in ((1, 1, 1), (64, 64, 64), (65, 129, 300), (200, 64, 333), (130, 70, 0)):
        a, b = r.integers(-(1 << 20), 1 << 20, (m, k)), r.integers(-(1 << 20), 1 << 20, (k, n))
        assert (hard_negatives.strassen(a, b) == a @ b).all()


VECTORS = [(k, [R.choice([-0.5, 0.25, 0.5, R.gauss(0, 0.3)]) for _ in range(9)], R.choice([1, 1, 1, 2, 3, 9])) for k in range(700)]
VECTORS += [(1000 + k, [0.5] * 9, 1) for k in range(120)]  # a common vector: ties
VECTORS += [(2000, None, 1), (2100, [1.0, None], 1), (2200, [float("nan")] * 9, 1), (2300, [float("inf")] * 9, 1), (2400, [1.0] * 9, None), (None, [1.0] * 9, 1), (2500, [], 1), (2600, [0.5, 0.5], 2), (2700, [0.9] * 12, 1), (300, VECTORS[300][1], VECTORS[300][2])]


def mined(spark, given, **small):
    return hard_negatives.mine(spark.createDataFrame(given, "vec_id long, embedding array<float>, label int").selectExpr("*", "1 as score", "2 as block", "'x' as part"))


@pytest.mark.parametrize("block", [hard_negatives.BLOCK, 3])
def test_mining_equals_sql(spark, monkeypatch, block):
    monkeypatch.setattr(hard_negatives, "BLOCK", block)
    c = duckdb.connect()
    c.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding FLOAT[], label INT)")
    c.executemany("INSERT INTO embeddings VALUES (?, ?, ?)", VECTORS)
    want = Counter(c.execute(hard_negatives.SQL).fetchall())
    assert want and rows(mined(spark, VECTORS)) == want


def test_mining_equals_brute_force(spark):
    q, label = {}, {}
    for k, v, own in VECTORS:
        if None in (k, v, own) or any(x is None or not np.isfinite(x) for x in v):
            continue
        q[k] = [int(np.floor(256 * float(np.float32(x)))) for x in v]
        label[k] = (own + 1) % 10 if k % 7 == 0 else own
    want = set()
    for a in (k for k in q if k % 100 == 0):
        score = {b: sum(x * y for x, y in zip(q[a], q[b])) for b in q}
        best = lambda ids: sorted(ids, key=lambda b: (-score[b], b))  # noqa: E731, B023
        for p in best(b for b in q if b != a and label[b] == label[a])[:5]:
            able = best(b for b in q if label[b] != label[a] and 30 * score[p] <= 100 * score[b] <= 90 * score[p])
            want |= {(a, p, rank, b, score[p], score[b]) for rank, b in enumerate(able[:10], 1)}
    assert set(map(tuple, mined(spark, VECTORS).collect())) == want


def test_mining_of_nothing_and_of_too_large(spark):
    assert mined(spark, []).count() == 0
    assert mined(spark, [(100, [1.0], 1), (1, [1.0], 2)]).count() == 0  # no positive
    with pytest.raises(Exception, match="components too large"):
        mined(spark, [(100, [1e30], 1), (1, [1e30], 1)]).count()


def test_audit_equals_sql(docs, duck):
    assert rows(divergence.audit(docs)) == Counter(duck.execute(divergence.SQL).fetchall())


def test_refinement_loses_no_term(docs):
    df = defaultdict(Counter)
    for _, text, lang, _ in DOCS:
        df[lang or ""].update({re.sub("[A-Z]", lambda c: c[0].lower(), t) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")})
    want = {(lang, t) for lang, own in df.items() for t, n in own.items() if n >= 10}
    texts = divergence.prepared(docs)
    found = divergence.counted_terms(texts, divergence.refined(texts)).collect()
    assert {(r.lang.decode(), r.term.decode()) for r in found} == want
    assert any(len(t) == 70 for _, t in want)  # longer than four levels


def test_audit_without_terms(docs, spark):
    assert divergence.audit(docs.limit(0)).count() == 0
    few = spark.createDataFrame([(1, "one", "en", "a"), (2, None, "en", "b"), (3, "", None, None)], SCHEMA)
    assert sorted(map(tuple, divergence.audit(few).collect())) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]
