import pytest

from palimpsest.fieldmap import Collection, Field, FieldMap
from palimpsest.operators import merge, probe, reads, shred, validate
from palimpsest.plans import apply_queries, load_plan
from palimpsest.record_map import DECLARED
from palimpsest.sources import snapshot
from palimpsest.streaming import ingest


def test_merge_twice_changes_nothing_and_revives(spark):
    t = spark.createDataFrame([(1, "a", False), (2, "b", True), (3, None, False)], "k int, v string, is_deleted boolean")
    b = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, None)], "k int, v string")
    plan = merge.merge_plan(t, b, ["k"], ["v"])
    assert {r.k: r.action for r in plan.collect()} == {1: "noop", 2: "revive", 3: "update", 4: "insert"}
    after = merge.apply_plan(t, plan, ["k"], ["v"])
    assert {r.action for r in merge.merge_plan(after, b, ["k"], ["v"]).collect()} == {"noop"}


def test_absent_is_not_empty(spark):
    rows = [(1, '{"c": []}'), (2, "{}"), (3, '{"c": null}'), (4, '{"c": [1]}'), (5, "not json")]
    d = shred.parsed(spark.createDataFrame(rows, "k int, body string"))
    assert {r.k: r.sent for r in shred.presence(d, ["k"], "$.c").collect()} == {1: True, 2: False, 3: True, 4: True, 5: False}


def test_gate_retires_only_what_was_sent(spark):
    t = spark.createDataFrame([(1, 0, "x", False), (2, 0, "x", False)], "p int, pos int, v string, is_deleted boolean")
    b = spark.createDataFrame([], "p int, pos int, v string")
    sent = spark.createDataFrame([(1, True), (2, False)], "p int, sent boolean")
    assert {r.p: r.action for r in merge.child_merge(t, b, sent, ["p"], ["v"]).collect()} == {1: "retire", 2: "noop"}


def test_duplicates_refuse_the_batch(spark):
    with pytest.raises(validate.BatchRefused):
        validate.refuse_duplicates(spark.createDataFrame([(1,), (1,)], "k int"), ["k"])


def test_id_shaped_terms_are_prefixes_of_ids_only(spark):
    d = spark.createDataFrame([("MD1A", "md1 works", ""), ("XX", "md1a", "")], "i string, n string, p string")
    assert [r.i for r in reads.search(d, "md1", "i", "n", "p", "i").collect()] == ["MD1A"]
    with pytest.raises(ValueError):
        reads.search(d, " x ", "i", "n", "p", "i")


def test_snapshots_are_whole(spark, tmp_path):
    d = spark.range(10).withColumnRenamed("id", "k")
    snapshot.publish({"a": d, "b": d}, str(tmp_path), "v1", "k", 4)
    assert snapshot.read(spark, str(tmp_path), "b").count() == 10


def test_landed_files_are_merged_once(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "in"))
    seen = []
    for _ in range(2):
        ingest.landed(spark, str(tmp_path / "in"), "id long", lambda df, n: seen.append(df.count()), str(tmp_path / "cp")).awaitTermination()
    assert sum(seen) == 5


def test_probe_of_a_window(spark):
    rows = [("b", "N", 3, True), ("b", "B", 7, None), ("a", "B", 10, True), ("c", None, 1, False), (None, "B", 99, True), ("d", "B", 2, False), ("d", "B", 1, False)]
    w = spark.createDataFrame(rows, "id string, kind string, seq int, now boolean")
    found = {r.id: r for r in probe.probed(w, "id", "kind", "seq", "now").collect()}
    assert found["b"].versions == "B/7, N/3" and found["b"].currents == 1 and found["d"].versions == "B/1, B/2" and found["c"].versions == "?/1" and len(found) == 4
    # One row can name ten versions of history.
    assert [(r.id, r.deepest) for r in probe.deepest_histories(probe.probed(w, "id", "kind", "seq", "now"), "id", 2).collect()] == [("a", 10), ("b", 7)]
    assert tuple(probe.probe_totals(w, "id", "now").first()) == (7, 4, 3)
    none = w.filter("false")
    assert tuple(probe.probe_totals(none, "id", "now").first()) == (0, 0, 0) and probe.probed(none, "id", "kind", "seq", "now").count() == 0


def test_skip_rate(spark):
    ids = lambda *x: spark.createDataFrame([(k,) for k in x], "id int")
    assert tuple(load_plan.resume_summary(load_plan.resume_plan(ids(1, 2, 3, 4), ids(2, 9), ids(3, 8), ["id"])).first()) == (3, 1, 2, 25.0)
    assert tuple(load_plan.resume_summary(load_plan.resume_plan(ids(), ids(7), ids(), ["id"])).first()) == (0, 0, 1, 0.0)


def test_convergence_makes_the_versions_once(spark):
    from palimpsest.plans import queries

    plan = queries.QUERIES["i11_convergence"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Join" not in plan  # what is compared is stored


def test_profile_counts_documents_inside_their_rows(spark):
    bodies = ['{"a.b": 1, "a": {"b": null}}', '{"l": [{"x": 1}, {"x": null}, {"x": 2}]}', '{"l": [{"x": null}], "": 3}', '{"l": []}', "[{\"x\": 1}]", "no json", None]
    d = spark.createDataFrame([(b,) for b in bodies], "body string")
    found = shred.profile(d)
    got = {(r.path, r.key, r.depth): (r.n, r.docs, r.full) for r in found.collect()}
    assert got == {("$.a.b", "a.b", 1): (1, 1, 1), ("$.a.b", "b", 2): (1, 1, 0), ("$.a", "a", 1): (1, 1, 1), ("$.l", "l", 1): (3, 3, 3), ("$.l[].x", "x", 3): (4, 2, 1), ("$.", "", 1): (1, 1, 1), ("$[].x", "x", 2): (1, 1, 1)}
    walked = shred.walk(d.withColumn("k", d.body), ["k"]).groupBy("path", "key", "depth").count().collect()
    assert {(r.path, r.key, r.depth): r["count"] for r in walked} == {k: v[0] for k, v in got.items()}
    assert {r.path: (r.sent, r["null"], r.absent) for r in probe.census(d).collect()}["$.a.b"] == (1, 0, 6)
    # A document never meets another before it is counted: the groups are the paths.
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 2 and "Expand" not in plan


def test_bodies_are_made_and_read_by_many_tasks(spark):
    from palimpsest.plans import apply_queries

    assert len(apply_queries._whole_bodies(spark, "/root/testdata/sf0.001").inputFiles()) > 4


def test_widths_are_taken_of_the_columns_that_have_one(spark, monkeypatch):
    f = FieldMap(("id",), (Field("id", "$.id", "int"), Field("a", "$.a", width=1), Field("b", "$.b", "date")), (Collection("c", "$.c", (Field("x", "$.x", "date"),), (Collection("d", "$.d", (Field("y", "$", width=1),), (), "place"),)), Collection("e", "$.e", (Field("z", "$"),))))
    assert [x.column for x in f.wide().fields] == ["id", "a"] and [(c.name, c.payload) for c, *_ in f.wide().walk()] == [("c", []), ("d", ["y"])]
    body = '{"id": 1, "a": "xy", "b": "2020-01-01", "c": [{"x": "2020-01-01", "d": ["u", "vwx"]}], "e": ["many"]}'
    df = spark.createDataFrame([(body,)], "body string")
    read = [validate.declared_widths(ingest.projected(shred.parsed(df), m), m) for m in (f, f.wide())]
    assert sorted(map(tuple, read[0].collect())) == sorted(map(tuple, read[1].collect())) == [("d", "y", 1, 1, 3), ("record", "a", 1, 1, 2)]

    seen, projected = [], ingest.projected
    monkeypatch.setattr(ingest, "projected", lambda records, fields: seen.append(fields) or projected(records, fields))
    apply_queries.b5_declared_widths(spark, "/root/testdata/sf0.001")
    columns = [x for m in seen for own in (m.fields, *(c.fields for c, *_ in m.walk())) for x in own]
    assert columns and all(x.width or x.column in DECLARED.keys for x in columns)
    assert seen[0].widths == DECLARED.widths and [c.name for c, *_ in seen[0].walk()] == [c.name for c, *_ in DECLARED.walk()]
