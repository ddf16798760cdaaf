"""Collated keys, bucket commits, exactly-once landing, segmented scans and the journal's replay, against brute force."""

import json
import os
import random
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from palimpsest import code_lists
from palimpsest.fieldmap import Collection, Field, FieldMap
from palimpsest.functions import keys
from palimpsest.operators import cascade, journal, merge, scan, shred, validate
from palimpsest.plans import apply_queries
from palimpsest.sources import buckets, workspace
from palimpsest.streaming import ingest

R = random.Random(3)


def test_keys_compare_without_case_and_trailing_blanks(spark):
    t = spark.createDataFrame([("MD1", "a", True), ("MD2", "b", False), ("ΟΔΟΣ", "c", False)], "k string, v string, is_deleted boolean")
    b = spark.createDataFrame([("md1 ", "a"), ("MD2  ", "b"), (" MD2", "x"), ("οδος", "d")], "k string, v string")
    assert {r.k: r.action for r in merge.merge_plan(t, b, ["k"], ["v"]).collect()} == {"md1 ": "revive", "MD2  ": "noop", " MD2": "insert", "οδος": "update"}
    after = {r.k: r.v for r in merge.upsert_rows(t, b, ["k"], ["v"]).collect()}
    assert after == {"MD1": "a", "MD2": "b", " MD2": "x", "ΟΔΟΣ": "d"}  # the stored spelling stays
    own = [r[0] for r in t.select(buckets.bucket_of(t, ["k"], 97)).collect()]
    sent = [r[0] for r in b.select(buckets.bucket_of(b, ["k"], 97)).collect()]
    assert (own[0], own[1], own[2]) == (sent[0], sent[1], sent[3])
    with pytest.raises(validate.BatchRefused):
        validate.refuse_duplicates(spark.createDataFrame([("md1 ",), ("MD1",)], "k string"), ["k"])


def stored_files(root):
    return {str(p.relative_to(root)) for p in Path(root).rglob("data/**/*.parquet")}


@pytest.fixture
def mirror(spark, tmp_path):
    root = str(tmp_path / "m")
    t = spark.range(1000).select(F.concat(F.lit("K"), F.col("id").cast("string")).alias("k"), F.col("id").alias("v"), F.lit(False).alias("is_deleted"))
    buckets.create(spark, root, "a", t.schema, ["k"], 50)
    buckets.create(spark, root, "b", t.schema, ["k"], 3)
    whole = buckets.Change(["k"], t, lambda _: t.withColumn("action", F.lit("insert")))
    buckets.commit(spark, root, {"a": whole, "b": whole})
    return root


def change(b):
    return buckets.Change(["k"], b, lambda old: merge.upsert_rows(old, b, ["k"], ["v"]))


def test_an_increment_rewrites_only_the_buckets_it_changes(spark, mirror):
    before, m = stored_files(mirror), buckets.latest(spark, mirror)
    b = spark.createDataFrame([("k7 ", 7), ("k9", 90), ("new", 1)], "k string, v long")  # the first changes nothing
    buckets.commit(spark, mirror, {"a": change(b)})
    after = buckets.latest(spark, mirror)
    moved = [x for x, (c, d) in enumerate(zip(m.tables["a"].commits, after.tables["a"].commits)) if c != d]
    assert 1 <= len(moved) <= 2 and m.tables["b"] == after.tables["b"]
    new = stored_files(mirror) - before
    assert before <= stored_files(mirror) and {int(f.split("__bucket=")[1].split("/")[0]) for f in new} == set(moved)
    rows = {r.k: r.v for r in buckets.read(spark, mirror, "a").collect()}
    assert len(rows) == 1001 and rows["K9"] == 90 and rows["new"] == 1 and rows["K7"] == 7
    again = buckets.commit(spark, mirror, {"a": change(b)})
    assert again.tables == after.tables and stored_files(mirror) == before | new  # the same again writes nothing


def test_a_torn_commit_is_unseen_and_all_tables_move_together(spark, mirror, monkeypatch):
    b = spark.createDataFrame([("K1", -1)], "k string, v long")
    with monkeypatch.context() as m:
        m.setattr(buckets, "_publish", lambda *a: (_ for _ in ()).throw(OSError("killed")))
        with pytest.raises(OSError):
            buckets.commit(spark, mirror, {"a": change(b), "b": change(b)})
    value = lambda name: buckets.read(spark, mirror, name).filter("k = 'K1'").first().v
    assert (value("a"), value("b")) == (1, 1)
    buckets.commit(spark, mirror, {"a": change(b), "b": change(b)})
    assert (value("a"), value("b")) == (-1, -1)
    gone = buckets.vacuum(spark, mirror, keep=1)
    assert len(gone) >= 2 and value("a") == -1 and buckets.read(spark, mirror, "a").count() == 1000


def test_two_writers_from_one_manifest_conflict(spark, mirror, monkeypatch):
    old = buckets.latest(spark, mirror)
    b = spark.createDataFrame([("K1", -1)], "k string, v long")
    buckets.commit(spark, mirror, {"a": change(b)})
    monkeypatch.setattr(buckets, "latest", lambda *a: old)
    with pytest.raises(buckets.Conflict):
        buckets.commit(spark, mirror, {"a": change(spark.createDataFrame([("K2", -2)], "k string, v long"))})


MAP = FieldMap(
    ("id", "seq"),
    (Field("id", "$.id", width=12), Field("seq", "$.seq", "int"), Field("name", "$.name"), Field("on", "$.on", "date"), Field("ok", "$.ok", "boolean")),
    (Collection("owner", "$.owners", (Field("owner", "$.name"),)), Collection("waste", "$.episodic.wastes", (Field("code", "$.code"),), (Collection("waste_code", "$.codes", (Field("value", "$"),), (), "place"),))),
)


def put(folder, name, records, second=1):
    os.makedirs(folder, exist_ok=True)
    Path(folder, f"{name}.json").write_text(json.dumps([{"retrievedDateUtc": f"2024-01-01T00:00:{second:02d}Z", "handler": r} for r in records]))


def first_load():
    return [{"id": f"MD{k}", "seq": 1, "name": f"n{k}", "on": "2024-01-02T23:00:00-05:00", "ok": "1", "owners": [{"name": f"o{j}"} for j in range(k % 4)], "episodic": {"wastes": [{"code": f"w{j}", "codes": ["p", "q"][: j + 1]} for j in range(k % 3)]}} for k in range(30)]


def second_load():
    # absent, empty, null and shorter collections, and a new version
    return [{"id": "md3 ", "seq": 1, "name": "changed"}, {"id": "MD7", "seq": 1, "name": "n7", "owners": []}, {"id": "MD11", "seq": 1, "owners": None}, {"id": "MD8", "seq": 1, "episodic": {"wastes": [{"code": "w0"}, {"code": "x", "codes": []}]}}, {"id": "MD3", "seq": 2, "owners": [{"name": "z"}]}]


def tables(spark, root):
    return {name: sorted(map(tuple, buckets.read(spark, root, name).drop("retrieved").collect()), key=str) for name in buckets.latest(spark, root).tables}


@pytest.fixture(scope="module")
def wanted(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("whole")
    root = str(d / "m")
    ingest.create(spark, root, MAP, 4)
    for n, load in enumerate((first_load(), second_load()), 1):
        put(d / f"in{n}", "x", load, n)
        found = spark.read.text(str(d / f"in{n}"), wholetext=True).select(F.lit(f"in{n}").alias("path"), F.col("value").alias("body"))
        ingest.apply(found, root, MAP)
    return tables(spark, root)


def test_what_a_load_leaves(wanted):
    live = {name: {r[:-1] for r in rows if not r[-1]} for name, rows in wanted.items()}
    names = {(r[0], r[1]): r[2] for r in live["record"]}
    assert len(names) == 31 and names["MD3", 1] == "changed" and names["MD11", 1] is None
    owners = {}
    for k, seq, pos, name in live["owner"]:
        owners.setdefault((k, seq), {})[pos] = name
    assert owners["MD3", 1] == {0: "o0", 1: "o1", 2: "o2"}  # not sent: kept
    assert ("MD7", 1) not in owners and ("MD11", 1) not in owners  # sent as [] and as null: retired
    assert owners["MD3", 2] == {0: "z"}
    wastes = {r[2]: r[3] for r in live["waste"] if r[0] == "MD8"}
    codes = {r[2:] for r in live["waste_code"] if r[0] == "MD8"}
    assert wastes == {0: "w0", 1: "x"} and codes == {(0, 0, "p")}  # the first element's codes were not sent, the second's are []
    assert {str(r[3]) for r in live["record"] if r[0] == "MD5"} == {"2024-01-02"} and all(r[4] for r in live["record"] if r[0] == "MD5")


@pytest.mark.parametrize("torn", ["before", "after", None])
def test_landing_is_exactly_once(spark, tmp_path, monkeypatch, wanted, torn):
    root, folder = str(tmp_path / "m"), str(tmp_path / "in")
    ingest.create(spark, root, MAP, 4)
    put(folder, "one", first_load(), 1)
    load = lambda: ingest.land(spark, folder, root, MAP, str(tmp_path / "cp")).awaitTermination()
    load()
    put(folder, "two", second_load(), 2)
    if torn:
        publish = buckets._publish

        def killed(*a):
            if torn == "after":
                publish(*a)
            raise OSError("killed")

        with monkeypatch.context() as m:
            m.setattr(buckets, "_publish", killed)
            with pytest.raises(Exception, match="killed"):
                load()
    at = buckets.latest(spark, root).seq
    load()
    assert tables(spark, root) == wanted
    assert buckets.latest(spark, root).seq == (at if torn == "after" else at + 1)  # a replay of what was published is refused


@pytest.mark.parametrize("body, says", [("{", "malformed"), ('{"handler": {}}', "not_array"), ('[{"handler": {"seq": 1}}]', "no id"), ('[{"handler": {"id": "0123456789abc", "seq": 1}}]', "too long a id"), ('[{"handler": {"id": "a", "seq": 1}}, {"handler": {"id": "A ", "seq": 1}}]', "share a key")])
def test_a_bad_body_refuses_the_whole_batch(spark, tmp_path, body, says):
    root = str(tmp_path / "m")
    ingest.create(spark, root, MAP, 2)
    found = spark.createDataFrame([("p1", '[{"handler": {"id": "b", "seq": 1}}]'), ("p2", body)], "path string, body string")
    with pytest.raises(validate.BatchRefused, match=says):
        ingest.apply(found, root, MAP)
    assert buckets.read(spark, root, "record").count() == 0


def test_running_max_over_a_hot_scope(spark):
    rows = [(("hot", "HOT ")[k % 2] if k % 5 else f"s{k % 3}", k, R.choice([None, R.randint(0, 1000)]), R.random() < 0.004) for k in range(6000)]
    want, state = {}, {}
    for s, k, v, reset in rows:
        s = s.lower().rstrip()
        want[k] = state.get(s)
        state[s] = max((x for x in ((None if reset else state.get(s)), v) if x is not None), default=None)
    d = spark.createDataFrame(rows, "s string, k int, v int, r boolean").repartition(7)
    parts = {}
    kept, scan_written = [], scan.written

    def spy(df, name):
        kept.append(scan_written(df, name))
        return kept[-1]

    scan.written = spy
    try:
        found = scan.running_max(d, ["s"], ["k"], F.col("v"), F.col("r"), parts=16)
    finally:
        scan.written = scan_written
    assert {r.k: r.before for r in found.collect()} == want
    parts = {r[0] for r in kept[0].filter("lower(rtrim(s)) = 'hot'").select(scan.PART).distinct().collect()}
    assert len(parts) >= 8  # the hot scope is many tasks


def test_open_runs_overlap_and_targeted_ones_do_not(spark):
    r = spark.createDataFrame([(1, "MD", 10, None, "Full"), (2, "md ", 20, 25, "Full"), (3, "MD", 21, 22, "Targeted"), (4, "VA", 5, 6, "Full"), (5, "VA", 7, 8, None)], "run int, place string, a int, z int, mode string")
    found = journal.overlapping_runs(r, "place", "run", "a", "z", F.lit(30)).collect()
    assert [(x.run, x.busy_until, x.blocked_by) for x in found] == [(2, 30, 1)]


def test_retired_owners_keep_no_live_child(spark):
    t = spark.createDataFrame([("A", 0, "x", False), ("B", 0, "x", False), ("B", 1, "x", False), ("C", 0, "x", False)], "o string, pos int, v string, is_deleted boolean")
    b = spark.createDataFrame([("a ", 0, "y"), ("b", 0, "x")], "o string, pos int, v string")
    owners = spark.createDataFrame([("A", True, True), ("B", False, True), ("C", True, False)], "o string, is_deleted boolean, sent boolean")
    got = lambda full: {(r.o.strip().upper(), r.pos): r.action for r in merge.nested_code_plan(t, b, owners, ["o"], "pos", ["v"], full).collect()}
    assert got(True) == {("A", 0): "cascade", ("C", 0): "cascade", ("B", 0): "noop", ("B", 1): "retire"}
    assert got(False) == {("A", 0): "cascade", ("C", 0): "cascade", ("B", 0): "noop"}


def test_credentials_are_withheld_in_any_case(spark):
    a = spark.createDataFrame([("/API/AUTH/key1/x", "no route /API/AUTH/secret", None, "E", "1")], "path string, message string, failure string, error_code string, error_id string")
    r = journal.withheld(a).first()
    assert (r.path, r.message, r.withheld) == (journal.NOTICE, journal.NOTICE, 2)


def brute(status, events):
    rows = {r["id"].upper(): dict(r) for r in status}
    counts = {}
    held = {}
    for e in events:
        held[e["id"].upper(), e["flush"], e["mode"]] = max(e, held.get((e["id"].upper(), e["flush"], e["mode"]), e), key=lambda x: x["seq"])
    for (k, _, mode), e in sorted(held.items(), key=lambda x: (x[0][1], journal.MODES[x[0][2]])):
        r = rows.get(k)
        live = r is not None and not r["is_deleted"]
        if mode == "Enumerate":
            if not live:
                rows[k] = r = dict.fromkeys(journal.PROGRESS) | {"id": k, "status": "Pending", "attempts": 0, "first_seen": e["at"], "is_deleted": False}
            r["location"], verdict = e["location"], "written"
        elif not live or r["status"] == "Succeeded":
            verdict = "skipped_succeeded" if live else "not_found"
        else:
            verdict = "written"
            if mode == "Attempt":
                r |= {"status": "InProgress", "attempts": e["attempt"], "attempt_started": e["at"], "completed": None} | dict.fromkeys(journal.ERRORS)
            elif mode == "Fail":
                began = r["attempt_started"]
                r |= {"status": "Failed", "outcome": None, "completed": e["at"], "duration_ms": None if began is None else min(int((e["at"] - began) * 1000), journal.CAP_MS)} | {c: e[c] for c in journal.ERRORS}
            else:
                r |= {"status": "Skipped", "outcome": None, "completed": e["at"]}
        counts[mode, verdict] = counts.get((mode, verdict), 0) + 1
    return rows, counts


def test_replay_equals_one_event_after_the_other(spark):
    status = []
    for k in range(40):
        if k % 5:
            status.append({"id": f"ID{k}", "location": "XX", "status": R.choice(["Pending", "InProgress", "Failed", "Succeeded"]), "outcome": R.choice([None, "Updated"]), "attempts": R.randint(0, 3), "http": R.choice([None, 500]), "error_code": None, "error_message": "m", "error_id": None, "error_date": None, "source_id": k, "payload_sha256": "AB", "first_seen": 50, "attempt_started": R.choice([None, 60]), "completed": 70, "duration_ms": 1, "is_deleted": R.random() < 0.3})
    modes = list(journal.MODES)
    events = [{"id": f"{R.choice(['id', 'ID'])}{0 if R.random() < 0.3 else R.randint(0, 45)}", "flush": n // 60, "seq": n, "mode": R.choices(modes, (1, 4, 3, 1))[0], "at": 1000 + n, "location": R.choice(["MD", "VA"]), "attempt": n, "http": 400 + n % 100, "error_code": R.choice([None, "E"]), "error_message": f"m{n}", "error_id": None, "error_date": None} for n in range(1500)]
    events.append(events[-1] | {"seq": 9_999, "flush": 30_000, "mode": "Fail", "id": "ID1", "at": 9_999_999})  # a capped duration
    types = {"flush": "long", "seq": "long", "attempt": "int", "attempts": "int", "http": "int", "source_id": "long", "duration_ms": "int", "is_deleted": "boolean"} | dict.fromkeys(("at", "error_date", "first_seen", "attempt_started", "completed"), "long")
    frame = lambda rows: spark.createDataFrame([tuple(r.values()) for r in rows], ", ".join(f"{c} {types.get(c, 'string')}" for c in rows[0]))
    stamps = lambda d: d.withColumns({c: F.timestamp_seconds(c) for c in ("at", "error_date", "first_seen", "attempt_started", "completed") if c in d.columns})
    s, e = stamps(frame(status)), stamps(frame(events)).repartition(6)
    rows, counts = brute(status, events)
    after = journal.replayed(s, e, ["id"])
    after = after.withColumns({c: F.unix_seconds(c) for c in ("error_date", "first_seen", "attempt_started", "completed")})
    got = {r["id"].upper(): {c: r[c] for c in [*journal.PROGRESS, "is_deleted"]} for r in after.collect()}
    assert got == {k: {c: r[c] for c in [*journal.PROGRESS, "is_deleted"]} for k, r in rows.items()}
    assert {(r["mode"], r.verdict): r.n for r in journal.verdicts(s, e, ["id"]).groupBy("mode", "verdict").agg(F.count("*").alias("n")).collect()} == counts


def test_sweep_keeps_earlier_completions_and_finds_nothing_twice(spark):
    s = spark.createDataFrame([(1, "md", "Pending", None, False), (2, "MD ", "InProgress", 5, False), (3, "VA", "Pending", None, False), (9, "MD", "Pending", None, False), (1, "MD", "Pending", None, True), (1, "MD", "Succeeded", 1, False)], "run int, location string, status string, completed int, is_deleted boolean")
    runs = spark.createDataFrame([(1, "Failed", False), (2, "Abandoned", False), (3, "Failed", False), (9, "Running", False)], "run int, run_status string, is_deleted boolean")
    found = journal.swept(s, runs, "run", F.lit(77), location="MD").collect()
    assert {(r.run, r.previous_status, r.status, r.completed) for r in found} == {(1, "Pending", "Failed", 77), (2, "InProgress", "Failed", 5)}
    assert journal.swept(s.withColumn("status", F.lit("Failed")), runs, "run", F.lit(77)).count() == 0


def test_a_deletion_walks_the_tree_once(spark, tmp_path):
    root = str(tmp_path / "m")
    ingest.create(spark, root, MAP, 4)
    put(tmp_path / "in", "one", first_load())
    found = spark.read.text(str(tmp_path / "in"), wholetext=True).select(F.lit("p").alias("path"), F.col("value").alias("body"))
    ingest.apply(found, root, MAP)
    doomed = spark.createDataFrame([("md5 ", 1), ("MD8", 1), ("MD8", 1), ("none", 1)], "id string, seq int")
    rows = lambda: {name: buckets.read(spark, root, name) for name in buckets.latest(spark, root).tables}
    live = lambda: {name: {r[0] for r in t.filter("not is_deleted").select("id").collect()} for name, t in rows().items()}
    before = live()
    buckets.commit(spark, root, cascade.changes(MAP, doomed, "withdrawn by hand"))
    assert live() == {name: ids - {"MD5", "MD8"} for name, ids in before.items()}
    at = buckets.latest(spark, root).tables
    buckets.commit(spark, root, cascade.changes(MAP, doomed, "withdrawn by hand"))
    assert buckets.latest(spark, root).tables == at
    assert {r.table: r.orphans for r in cascade.orphans(rows(), MAP).collect()} == {"owner": 0, "waste": 0, "waste_code": 0, "record_raw": 0}
    torn = rows() | {"waste": rows()["waste"].withColumn("is_deleted", F.lit(True))}
    assert {r.table: r.orphans for r in cascade.orphans(torn, MAP).collect()}["waste_code"] > 0
    with pytest.raises(ValueError):
        cascade.changes(MAP, doomed, "short")


def test_everything_can_be_projected_again_from_the_raw_texts(spark, tmp_path):
    root = str(tmp_path / "m")
    ingest.create(spark, root, MAP, 2)
    put(tmp_path / "in", "one", first_load())
    found = spark.read.text(str(tmp_path / "in"), wholetext=True).select(F.lit("p").alias("path"), F.col("value").alias("body"))
    ingest.apply(found, root, MAP)
    for name, again in ingest.reprojected(spark, root, MAP).items():
        stored = buckets.read(spark, root, name).filter("not is_deleted").select(*again.columns)
        assert sorted(map(str, again.collect())) == sorted(map(str, stored.collect()))


def test_the_declared_record():
    from palimpsest.record_map import DECLARED

    tree = list(DECLARED.walk())
    assert len(DECLARED.fields) == len({f.column for f in DECLARED.fields}) == 210
    assert len(tree) == 18 and sum(len(c.fields) for c, *_ in tree) == 167 and sum(above is not None for _, above, _ in tree) == 3
    assert all(len({*own, *c.payload}) == len(own) + len(c.fields) for c, _, own in tree)


def lists(spark, **found):
    return spark.createDataFrame([(name, json.dumps(body)) for name, body in found.items()], "list_name string, body string")


def live(spark, root, table, *columns):
    return {tuple(r) for r in buckets.read(spark, root, table).filter("not is_deleted").select(*columns).collect()}


def test_code_lists_refresh_whole_or_not_at_all(spark, tmp_path):
    root = str(tmp_path / "m")
    code_lists.create(spark, root, 4)
    reasons = [{"code": c, "description": c, "active": "true"} for c in "ABC"]
    waste = [{"activityLocation": loc, "code": f"{loc}{k}"} for loc in ("MD", "VA") for k in range(3)]
    district = [{"activityLocation": "MD", "code": f"D{k}", "counties": [{"code": "1"}, {"code": "2"}]} for k in range(2)]
    code_lists.refresh(spark, root, lists(spark, HsmReason=reasons, WasteCode=waste, StateDistrict=district))
    assert len(live(spark, root, "code", *code_lists.KEYS)) == 11 and len(live(spark, root, "county", "district", "pos")) == 4

    # within the locations sent: VA stays; a district goes with its counties, another loses one; a list that isn't full loses nothing
    later = lists(spark, HsmReason=[{"code": "a "}], WasteCode=[{"activityLocation": "md", "code": "MD0"}, {"activityLocation": "MD", "code": "new"}], StateDistrict=[{"activityLocation": "MD", "code": "d0", "counties": [{"code": "9"}]}])
    code_lists.refresh(spark, root, later, full=["WasteCode", "StateDistrict"])
    assert live(spark, root, "code", *code_lists.KEYS) == {("HsmReason", "", c) for c in "ABC"} | {("WasteCode", "VA", f"VA{k}") for k in range(3)} | {("WasteCode", "MD", "MD0"), ("WasteCode", "MD", "new"), ("StateDistrict", "MD", "D0")}
    assert live(spark, root, "county", "district", "pos", "county_code") == {("D0", 0, "9")}

    before = buckets.latest(spark, root)
    for bad, says in (
        ({"WasteCode": []}, "never empty"),
        ({"WasteCode": [{"activityLocation": "VA", "code": "VA0"}]}, "would be retired"),
        ({"HsmReason": [{"code": "AB"}]}, "code_too_wide"),
        ({"Naics": [{"code": "1"}]}, "location_missing"),
        ({"HsmReason": [{"code": "A"}, {"code": "a "}]}, "share a key"),
        ({"HsmReason": {"code": "A"}}, "not_array"),
        ({"StateDistrict": [{"activityLocation": "MD", "code": "D0", "counties": [{"description": "no code"}]}]}, "county_code_missing"),
        ({"HsmReason": [{"code": "A"}], "WasteCode": []}, "never empty"),
    ):
        with pytest.raises(validate.BatchRefused, match=says):
            code_lists.refresh(spark, root, lists(spark, **bad))
    assert buckets.latest(spark, root) == before
    code_lists.refresh(spark, root, lists(spark, WasteCode=[]), full=[])  # an empty upsert does nothing
    assert buckets.latest(spark, root).tables == before.tables


def test_the_catalogue(spark):
    rows = code_lists.catalogue(spark).collect()
    assert len(rows) == len({r.address for r in rows}) == 23 and sum(not r.located for r in rows) == 7


def test_a_body_of_another_shape_is_read_as_a_variant_has_it(spark):
    odd = ['{"id": 7, "seq": "2", "owners": [{"name": 1.50}, null, 5, [1]], "episodic": {"wastes": [{"codes": ["a", null, {"b": 1}]}, {"codes": {}}, {"codes": null}, {}, 3]}}']
    odd += ['{"id": {"a": 1}, "ok": 1, "owners": {"name": "x"}, "episodic": 5}', '{"id": "a", "id": "b"}', '[{"id": "a"}]', "{", '{"owners": null, "episodic": {"wastes": [{"codes": []}, {"codes": ["z"]}]}}']
    given = shred.parsed(spark.createDataFrame([(b,) for b in odd], "body string"))
    found, keys, v = shred.read_whole(given, MAP, sent=True), ["id", "seq"], F.col("v")
    assert found.select(*(f.column for f in MAP.fields)).collect() == shred.parents(given, MAP).collect()
    for c, path in (("owner", "$.owners"), ("waste", "$.episodic.wastes")):
        own = next(x for x, *_ in MAP.walk() if x.name == c)
        want = given.select(F.posexplode(F.try_variant_get(v, path, "array<variant>")).alias("pos", "e")).select("pos", *(shred.value(F.col("e"), f) for f in own.fields))
        assert shred.rows_of(found, [], own).collect() == want.collect()
    codes = next(x for x, *_ in MAP.walk() if x.name == "waste_code")
    assert [tuple(r) for r in shred.rows_of(found, [], codes).collect()] == [(0, 0, "a"), (0, 1, None), (0, 2, '{"b":1}'), (1, 0, "z")]
    assert [tuple(r) for r in shred.sent_of(found, [], codes).collect()] == [(0, True), (1, True), (2, True), (3, False), (4, False), (0, True), (1, True)]


def test_a_leaf_carries_no_names_of_its_record(spark):
    """An element was a variant with the dictionary of its whole record; what is stored of a record is now its declared columns alone."""
    names = {f"p{k}": k for k in range(300)}
    given = shred.parsed(spark.createDataFrame([(json.dumps({"id": "a", "owners": [{"name": "x"}] * 50} | names),)], "body string"))
    found = shred.read_whole(given, MAP)
    assert "variant" not in found.schema.simpleString() and shred.rows_of(found, [], MAP.collections[0]).count() == 50


def test_keys_are_plain_text_when_they_are_compared(spark, mirror):
    t = spark.createDataFrame([("ΟΔΟΣ ", 1), ("İx", 2)], "k string, v int")
    b = spark.createDataFrame([("οδος", 1), ("i̇X  ", 2), (" İx", 3)], "k string, w int")
    both = keys.joined(t, b, ["k"])
    assert {r.v: r.w for r in both.collect()} == {1: 1, 2: 2}
    assert "collat" not in both._jdf.queryExecution().toString().lower()


def test_a_month_of_any_size_lands_as_bodies_of_bounded_size(spark, monkeypatch):
    monkeypatch.setattr(apply_queries, "BODY", 5)
    sf = "/root/testdata/sf0.001"
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    most = orders.groupBy(F.date_format("o_orderdate", "yyyyMM")).count().agg(F.max("count")).first()[0]
    sizes = [r[0] for r in apply_queries._envelopes(spark, sf, False).select(F.json_array_length("value")).collect()]
    assert most > 12 and max(sizes) < most and sum(sizes) == orders.count()
    load = apply_queries.a6_landed_load(spark, sf)
    monkeypatch.undo()
    assert load.exceptAll(apply_queries.a6_landed_load(spark, sf)).count() == 0 and load.count() == orders.count()


def test_an_array_is_told_whatever_blanks_come_first(spark):
    given = {"[]": "array", " \t\r\n[1, {}]": "array", "[1": "malformed", " {}": "not_array", '"["': "not_array", "null": "not_array", '[{"a": 1, "a": 2}]': "malformed", None: "missing"}
    df = validate.array_check(spark.createDataFrame([(b,) for b in given], "body string"))
    assert {r.body: r.body_state for r in df.collect()} == given


def parquet_below(*folders):
    return {str(p) for folder in folders for p in Path(folder).rglob("*.parquet")}


def shuffle_files(spark):
    return {p.name for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString() for p in Path(d).rglob("shuffle_*.data")}


def test_a_load_leaves_its_tables_and_nothing_else(spark, tmp_path, monkeypatch):
    """The stored records, the rows of all plans and the shuffles stayed on disk, several times what the tables take."""
    share, root, folder = (str(tmp_path / x) for x in ("share", "m", "in"))
    monkeypatch.setattr(workspace, "folder", lambda s: share)
    ingest.create(spark, root, MAP, 2)
    put(folder, "a.json", [{"id": f"a{k}", "seq": 1, "owners": [{"name": "x"}]} for k in range(50)])
    before = shuffle_files(spark)
    ingest.land(spark, folder, root, MAP, str(tmp_path / "cp")).awaitTermination()
    assert len(live(spark, root, "owner", "id")) == 50 and not parquet_below(share, f"{root}/plans")
    for _ in range(50):  # their removal isn't waited for
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.2)
    assert not left

    twice = spark.createDataFrame([("x", '[{"handler": {"id": "a", "seq": 1}}, {"handler": {"id": "a", "seq": 1}}]')], "path string, body string")
    with pytest.raises(validate.BatchRefused):
        ingest.apply(twice, root, MAP)
    assert not parquet_below(share)


def test_a_batch_reports_from_the_actions_of_its_plans_alone(spark, tmp_path, monkeypatch):
    share, root = str(tmp_path / "share"), str(tmp_path / "m")
    monkeypatch.setattr(workspace, "folder", lambda s: share)
    ingest.create(spark, root, MAP, 2)
    body = lambda n: spark.createDataFrame([("x", json.dumps([{"handler": {"id": f"a{k}", "seq": 1, "name": n, "owners": [{"name": n}]}} for k in range(9)]))], "path string, body string")
    ingest.apply(body("old"), root, MAP).drop()
    done = ingest.apply(body("new"), root, MAP)
    assert {name: p.columns for name, p in done.plans.items()}["record_raw"] == ["id", "seq", "is_deleted", "action"]
    assert len(buckets.vacuum(spark, root, keep=1)) >= 3 and len(os.listdir(f"{root}/plans")) == 1
    report = merge.merge_report(done.plans, done.sent, MAP).first()
    assert (report.elements, report.updated, report.raw_rows, report.child_rows) == (9, 9, 9, 9) and report.absent_collections == 1
    done.drop()
    assert not parquet_below(share, f"{root}/plans") and live(spark, root, "owner", "owner") == {("new",)}


@pytest.mark.parametrize("query", ["a6_landed_load", "d7_merge_report"])
def test_a_load_by_query_keeps_one_state_of_its_tables(spark, tmp_path, monkeypatch, query):
    """Bodies landed as plain text, and beside the tables stayed their earlier state, all plans, all bodies and all records."""
    monkeypatch.setattr(workspace, "folder", lambda s: str(tmp_path))
    apply_queries.QUERIES[query](spark, "/root/testdata/sf0.001").count()
    [root] = tmp_path.glob("mirror-*")
    assert not [p for name in ("given", "orders") for p in tmp_path.glob(f"{name}-*/*")]
    assert all(len(list((root / "data" / name).iterdir())) == 1 for name in ("orders", "orders_raw", "line", "line_flag"))
    if query == "a6_landed_load":
        bodies = [p for p in root.glob("landed/**/part-*") if p.is_file()]
        assert bodies and all(p.name.endswith(".txt.gz") for p in bodies) and not parquet_below(root / "plans") and not list(tmp_path.glob("landed-*/*"))
    else:
        assert len(list(tmp_path.glob("landed-*/*.parquet"))) and len(os.listdir(root / "plans")) == 1


def test_stored_rows_are_dealt_once_when_their_buckets_are_written(spark):
    """A join dealt them by key, whole bodies and all, and a second shuffle then by bucket."""
    rows = lambda found: spark.createDataFrame([(k, v, hash(k and k.strip().lower()) % 3) for k, v in found], f"k string, v int, {buckets.BUCKET} int")
    before = rows([(f"K{k}", k) for k in range(40)] + [(None, -1), (None, -2)])
    new = rows([("k7 ", 70), ("K9", 90), ("new", 1), (None, -3)])
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        after = buckets.replaced(before, new, ["k"], 3)
        assert after._jdf.queryExecution().toString().split("== Physical Plan ==")[1].count("Exchange hashpartitioning") == 1
        got = sorted((r.k or "", r.v) for r in after.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    want = keys.anti(before, new, ["k"]).unionByName(new)
    assert got == sorted((r.k or "", r.v) for r in want.collect()) and len(got) == 38 + 2 + 4 and after.columns == before.columns


@pytest.mark.parametrize("limit", ["PASS", "PASS_ROWS"])
def test_a_large_commit_deals_its_buckets_in_passes(spark, mirror, monkeypatch, limit):
    """One write dealt all rows of a table at once, however large it was."""
    b = spark.range(0, 1000, 2).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"), (-F.col("id")).alias("v"))
    dealt, replaced = [], buckets.replaced
    monkeypatch.setattr(buckets, "replaced", lambda before, new, keys, hit: dealt.append(hit) or replaced(before, new, keys, hit))
    monkeypatch.setattr(buckets, limit, 1)
    buckets.commit(spark, mirror, {"b": change(b)})
    assert dealt == [1, 1, 1]
    assert {r.k: r.v for r in buckets.read(spark, mirror, "b").collect()} == {f"K{k}": k if k % 2 else -k for k in range(1000)}
