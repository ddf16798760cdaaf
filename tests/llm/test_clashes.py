"""Columns of the input that have the names operators use inside keep their values."""

from palimpsest.llm import lattice_lm, ngram_join


def test_keep_one_keeps_every_column(spark):
    rows = [(k, f"a b c d e f g {k}", f"own{k}", k, f"row{k}") for k in range(4)] + [(9, "a b c d e f g 0", "copy", 9, "r"), (None, None, "none", 7, "r")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __key string, key long, row string")
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert {tuple(r) for r in kept.collect()} <= {tuple(r) for r in docs.collect()}
    assert {r["__key"] for r in kept.collect()} == {"own0", "own1", "own2", "own3", "none"}


def test_the_most_frequent_words(spark):
    counts = spark.createDataFrame([(k, n) for k, n in enumerate([9, 7, 7, 5, 5, 5, 1, 1])], "word long, n long")
    found = lambda most: sorted(r.n for r in lattice_lm.most_frequent(counts, most).collect())
    assert [found(k) for k in (0, 1, 2, 3, 6, 7, 8, 99)] == [[], [9], [9], [7, 7, 9], [5, 5, 5, 7, 7, 9], [5, 5, 5, 7, 7, 9], [1, 1, 5, 5, 5, 7, 7, 9], [1, 1, 5, 5, 5, 7, 7, 9]]
    assert lattice_lm.most_frequent(counts.limit(0), 5).count() == 0
