"""Registered queries of incremental application: collated keys, bucket commits, landing, journal replay, segmented scans.

Each has SQL that gives the same rows by another way: replays step by step, self-joins, whole-table merges.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest import code_lists
from palimpsest.fieldmap import Collection, Field, FieldMap
from palimpsest.operators import cascade, current, journal, merge, probe, reads, runs, shred, validate
from palimpsest.plans import load_plan
from palimpsest.plans.queries import KEY, L, PAIR, TL, V, S, lines, status, table, target_lines, versions
from palimpsest.plans.queries import sent as lines_sent
from palimpsest.record_map import BIT, COLLECTIONS, DATE, DECLARED, FLOAT, RECORD, Shape, leaves
from palimpsest.sources import buckets, json_bodies, workspace
from palimpsest.streaming import ingest

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str):
    def register(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__], ORACLE_SQL[f.__name__] = f, sql
        return f

    return register


# ---- text keys: stored in upper case, sent in lower case and with trailing blanks where the version is current ----

NAMED = """n AS (SELECT 'MD' || entity AS entity, CASE WHEN current THEN 'md' || entity || '  ' ELSE 'Md' || entity END AS sent_as,
  kind, seq, received, current, amount, priority FROM v)"""
NT = """t AS (SELECT entity, kind, seq, received, current, CASE WHEN kind = 'F' THEN amount + 1 ELSE amount END AS amount, priority = '5-LOW' AS is_deleted
  FROM n WHERE received < '2000-01-01')"""
NB = "b AS (SELECT sent_as AS entity, lower(kind) AS kind, seq, received, current, amount FROM n WHERE received >= '1996-01-01')"
ON = "lower(rtrim(t.entity)) = lower(rtrim(b.entity)) AND lower(t.kind) = lower(b.kind) AND t.seq = b.seq"
VALUES = ["received", "current", "amount"]


def named(s: SparkSession, d: str) -> DataFrame:
    own = F.col("entity").cast("string")
    sent_as = F.when(F.col("current"), F.concat(F.lit("md"), own, F.lit("  "))).otherwise(F.concat(F.lit("Md"), own))
    return versions(s, d).withColumns({"entity": F.concat(F.lit("MD"), own), "sent_as": sent_as})


def stored(s: SparkSession, d: str) -> DataFrame:
    amount = F.when(F.col("kind") == "F", F.col("amount") + 1).otherwise(F.col("amount")).alias("amount")
    return named(s, d).filter("received < '2000-01-01'").select(*KEY, "received", "current", amount, (F.col("priority") == "5-LOW").alias("is_deleted"))


def batch(s: SparkSession, d: str) -> DataFrame:
    found = named(s, d).filter("received >= '1996-01-01'")
    return found.select(F.col("sent_as").alias("entity"), F.lower("kind").alias("kind"), "seq", *VALUES)


@query(
    f"""WITH {V}, {NAMED}, {NT}, {NB}
    SELECT b.entity, b.kind, b.seq, CASE WHEN t.is_deleted IS NULL THEN 'insert' WHEN t.is_deleted THEN 'revive'
      WHEN t.received IS DISTINCT FROM b.received OR t.current IS DISTINCT FROM b.current OR t.amount IS DISTINCT FROM b.amount THEN 'update' ELSE 'noop' END AS action
    FROM b LEFT JOIN t ON {ON}"""
)
def d1_collated_merge(s, d):
    return merge.merge_plan(stored(s, d), batch(s, d), KEY, VALUES).select(*KEY, "action")


@query(
    f"""WITH {V}, {NAMED}, x AS (SELECT sent_as AS e, kind FROM n UNION ALL SELECT entity, lower(kind) FROM n WHERE priority = '5-LOW')
    SELECT lower(rtrim(e)) AS entity, lower(kind) AS kind, count(*) AS n FROM x GROUP BY 1, 2 HAVING count(*) > 1"""
)
def b4_collated_duplicates(s, d):
    n = named(s, d)
    both = n.select(F.col("sent_as").alias("entity"), "kind").unionAll(n.filter("priority = '5-LOW'").select("entity", F.lower("kind")))
    return validate.duplicate_keys(both, ["entity", "kind"]).select(F.lower(F.rtrim("entity")).alias("entity"), F.lower("kind").alias("kind"), "n")


@query(
    f"""WITH {L}, {TL}, t AS (SELECT 'O' || order_id AS k, pos, part, quantity, is_deleted FROM tl),
    b AS (SELECT 'o' || order_id || ' ' AS k, pos, part, quantity FROM l JOIN orders ON o_orderkey = order_id WHERE flag <> 'R' AND o_orderstatus <> 'P'),
    s AS (SELECT 'o' || o_orderkey AS k, o_orderstatus <> 'P' AS sent FROM orders)
    SELECT CASE WHEN t.k IS NULL THEN 'insert' WHEN b.k IS NOT NULL AND t.is_deleted THEN 'revive'
      WHEN b.k IS NOT NULL AND (t.part <> b.part OR t.quantity <> b.quantity) THEN 'update' WHEN b.k IS NOT NULL THEN 'noop'
      WHEN s.sent AND NOT t.is_deleted THEN 'retire' ELSE 'noop' END AS action, count(*) AS n, sum(coalesce(t.pos, b.pos))::BIGINT AS places
    FROM t FULL JOIN b ON lower(t.k) = lower(rtrim(b.k)) AND t.pos = b.pos LEFT JOIN s ON lower(t.k) = s.k GROUP BY 1"""
)
def d3_collated_children(s, d):
    t = target_lines(s, d).withColumn("order_id", F.concat(F.lit("O"), F.col("order_id").cast("string")))
    own = lines(s, d).filter("flag <> 'R'").join(lines_sent(s, d).filter("sent").select("order_id"), "order_id")
    b = own.select(F.concat(F.lit("o"), F.col("order_id").cast("string"), F.lit(" ")).alias("order_id"), "pos", "part", "quantity")
    asked = lines_sent(s, d).withColumn("order_id", F.concat(F.lit("o"), F.col("order_id").cast("string")))
    return merge.child_merge(t, b, asked, ["order_id"], ["part", "quantity"]).groupBy("action").agg(F.count("*").alias("n"), F.sum("pos").cast("long").alias("places"))


@query(
    """WITH p AS (SELECT DISTINCT p_brand AS scope, p_type AS code, count(*) OVER (PARTITION BY p_brand, p_type) AS n, max(p_size) OVER (PARTITION BY p_brand, p_type) AS size FROM part),
    t AS (SELECT scope, code, CASE WHEN size > 45 THEN n + 1 ELSE n END AS n, size < 40 AS is_deleted FROM p WHERE size < 50),
    b AS (SELECT lower(scope) AS scope, upper(code) || ' ' AS code, n FROM p WHERE code <> 'ECONOMY' AND scope <> 'Brand#5')
    SELECT action, count(*) AS n FROM (
      SELECT CASE WHEN t.is_deleted IS NULL THEN 'insert' WHEN t.is_deleted THEN 'revive' WHEN t.n <> b.n THEN 'update' ELSE 'noop' END AS action
      FROM b LEFT JOIN t ON lower(t.scope) = b.scope AND lower(t.code) = lower(rtrim(b.code))
      UNION ALL SELECT 'retire' FROM t WHERE NOT is_deleted AND lower(scope) IN (SELECT scope FROM b)
        AND NOT EXISTS (SELECT 1 FROM b WHERE lower(t.scope) = b.scope AND lower(t.code) = lower(rtrim(b.code)))) GROUP BY 1"""
)
def d10_collated_codes(s, d):
    p = table(s, d, "part").groupBy(F.col("p_brand").alias("scope"), F.col("p_type").alias("code")).agg(F.count("*").alias("n"), F.max("p_size").alias("size"))
    t = p.filter("size < 50").select("scope", "code", F.when(F.col("size") > 45, F.col("n") + 1).otherwise(F.col("n")).alias("n"), (F.col("size") < 40).alias("is_deleted"))
    b = p.filter("code <> 'ECONOMY' and scope <> 'Brand#5'").select(F.lower("scope").alias("scope"), F.concat(F.upper("code"), F.lit(" ")).alias("code"), "n")
    return merge.code_list_plan(t, b, "scope", "code", ["n"], True).groupBy("action").agg(F.count("*").alias("n"))


@query(
    f"""WITH {V}, {NAMED}, {NT}, {NB},
    a AS (SELECT *, coalesce(current, false) AND row_number() OVER (PARTITION BY lower(rtrim(entity)), kind, current ORDER BY received DESC NULLS LAST, seq DESC) = 1 AS ruled FROM b)
    SELECT t.entity, t.kind, t.seq, coalesce(a.ruled, false) AS current FROM t LEFT JOIN a ON {ON.replace("b.", "a.")}
    WHERE NOT t.is_deleted AND t.current IS DISTINCT FROM coalesce(a.ruled, false)
      AND (lower(t.entity), lower(t.kind)) IN (SELECT (lower(rtrim(entity)), kind) FROM b)"""
)
def d17_collated_authority(s, d):
    return current.apply_authority(stored(s, d), batch(s, d), PAIR).select(*KEY, "current")


@query(
    f"""WITH {V}, {NAMED}, {NT}, ids AS (SELECT sent_as, kind, seq FROM n WHERE priority = '2-HIGH')
    SELECT DISTINCT t.entity, t.kind, t.seq, t.amount FROM t JOIN ids ON lower(t.entity) = lower(rtrim(ids.sent_as)) AND t.kind = ids.kind AND t.seq = ids.seq WHERE NOT t.is_deleted"""
)
def e10_collated_detail(s, d):
    ids = named(s, d).filter("priority = '2-HIGH'").select(F.col("sent_as").alias("entity"), F.lower("kind").alias("kind"), "seq")
    return reads.detail(stored(s, d), ids, KEY).select(*KEY, "amount")


# ---- nested lists: retired owners cascade whether or not they were sent, in either mode ----

OWNERS = """p AS (SELECT p_brand AS brand, p_partkey AS pos, p_name, p_size, p_type, p_retailprice FROM part),
  t AS (SELECT brand, pos, CASE WHEN p_retailprice > 950 THEN 'old' ELSE p_name END AS code, p_type = 'ECONOMY' AS is_deleted FROM p WHERE p_size <= 45),
  o AS (SELECT brand, brand IN ('Brand#7', 'Brand#9') AS is_deleted, brand NOT IN ('Brand#8', 'Brand#9') AS sent FROM p GROUP BY brand),
  b AS (SELECT lower(p.brand) AS brand, pos, p_name AS code FROM p JOIN o USING (brand) WHERE o.sent AND p_name NOT LIKE 'red%'),
  r AS (SELECT coalesce(t.brand, b.brand) AS brand, coalesce(t.pos, b.pos) AS pos, o.is_deleted AS gone, o.sent, b.pos IS NOT NULL AS here, t.pos IS NOT NULL AS there, t.is_deleted AS was, t.code AS old, b.code AS new
    FROM t FULL JOIN b ON lower(t.brand) = b.brand AND t.pos = b.pos JOIN o ON lower(o.brand) = lower(coalesce(t.brand, b.brand)))"""


def _owned(full: bool) -> str:
    retired = "WHEN NOT gone AND sent AND NOT here AND NOT was THEN 'retire'" if full else ""
    return f"""WITH {OWNERS} SELECT action, count(*) AS n FROM (
    SELECT CASE WHEN gone AND there AND NOT was THEN 'cascade' WHEN gone THEN NULL WHEN here AND NOT there THEN 'insert' WHEN here AND was THEN 'revive'
      WHEN here AND old <> new THEN 'update' WHEN here THEN 'noop' {retired} END AS action FROM r) WHERE action IS NOT NULL GROUP BY 1"""


def _nested(s: SparkSession, d: str, full: bool) -> DataFrame:
    p = table(s, d, "part").select(F.col("p_brand").alias("brand"), F.col("p_partkey").alias("pos"), "p_name", "p_size", "p_type", "p_retailprice")
    t = p.filter("p_size <= 45").select("brand", "pos", F.when(F.col("p_retailprice") > 950, F.lit("old")).otherwise(F.col("p_name")).alias("code"), (F.col("p_type") == "ECONOMY").alias("is_deleted"))
    owners = p.select("brand").distinct().select("brand", F.col("brand").isin("Brand#7", "Brand#9").alias("is_deleted"), (~F.col("brand").isin("Brand#8", "Brand#9")).alias("sent"))
    b = p.filter("p_name not like 'red%'").join(owners.filter("sent").select("brand"), "brand").select(F.lower("brand").alias("brand"), "pos", F.col("p_name").alias("code"))
    return merge.nested_code_plan(t, b, owners, ["brand"], "pos", ["code"], full).groupBy("action").agg(F.count("*").alias("n"))


@query(_owned(True))
def d12_nested_codes(s, d):
    """Parts as the nested list of their brands, in mode Full: two brands are retired, one of which is sent; one live brand isn't sent."""
    return _nested(s, d, True)


@query(_owned(False))
def d12_nested_upsert(s, d):
    return _nested(s, d, False)


# ---- commits: an increment of the last months onto what is stored ----


@query(
    f"""WITH {V}, {NAMED}, {NT}, b AS (SELECT sent_as AS entity, lower(kind) AS kind, seq, received, current, amount FROM n WHERE received >= '1999-11-01')
    SELECT coalesce(t.entity, b.entity) AS entity, coalesce(t.kind, b.kind) AS kind, coalesce(t.seq, b.seq) AS seq,
      CASE WHEN b.seq IS NULL THEN t.received ELSE b.received END AS received, CASE WHEN b.seq IS NULL THEN t.current ELSE b.current END AS current,
      CASE WHEN b.seq IS NULL THEN t.amount ELSE b.amount END AS amount, b.seq IS NULL AND t.is_deleted AS is_deleted
    FROM t FULL JOIN b ON {ON}"""
)
def a4_bucket_commit(s, d):
    """The table after two commits into buckets: all that is stored, then what was received since November 1999."""
    root, t = workspace.new_folder(s, "mirror"), stored(s, d)
    buckets.create(s, root, "record", t.schema, KEY, 64)
    buckets.commit(s, root, {"record": buckets.Change(KEY, t, lambda _: t.withColumn("action", F.lit("insert")))})
    b = named(s, d).filter("received >= '1999-11-01'").select(F.col("sent_as").alias("entity"), F.lower("kind").alias("kind"), "seq", *VALUES)
    buckets.commit(s, root, {"record": buckets.Change(KEY, b, lambda old: merge.upsert_rows(old, b, KEY, VALUES))})
    return buckets.read(s, root, "record")


# ---- landing: envelopes of orders with lines and, under each line, its dates ----

ORDER = FieldMap(
    ("order_id",),
    (
        Field("order_id", "$.id", width=12, required=True),
        Field("kind", "$.type.code", width=1),
        Field("amount", "$.amount", "double"),
        Field("received", "$.received", "date"),
    ),
    (Collection("line", "$.waste.lines", (Field("part", "$.part", "bigint"), Field("quantity", "$.quantity", "double")), (Collection("line_flag", "$.flags", (Field("flag", "$"),), (), "place"),)), Collection("note", "$.notes", (Field("note", "$"),))),
    "orders",
)


BODY = 20_000  # envelopes of a body, about


def _orders(s: SparkSession, d: str) -> DataFrame:
    """Every order with its month and its lines, in their order, as an array (null without any)."""
    line = F.struct("pos", F.struct("part", "quantity", F.array("flag", "state").alias("flags")).alias("line"))
    own = lines(s, d).groupBy("order_id").agg(F.transform(F.array_sort(F.collect_list(line)), lambda x: x["line"]).alias("lines"))
    o = table(s, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "o_orderdate")
    return o.join(own, F.col("o_orderkey") == F.col("order_id"), "left").select(F.date_format("o_orderdate", "yyyyMM").alias("month"), *o.columns, "lines")


def _envelopes(s: SparkSession, d: str, again: bool, orders: DataFrame | None = None) -> DataFrame:
    """(month, part, value): JSON arrays of about BODY envelopes each, one a month at least, whatever a month holds. ``again``: the urgent orders sent anew, without their returned lines; open ones without the property."""
    o = _orders(s, d) if orders is None else orders
    empty = F.expr("cast(array() as array<struct<part:bigint,quantity:double,flags:array<string>>>)")
    listed = F.coalesce(F.filter("lines", lambda x: x["flags"][0] != "R") if again else F.col("lines"), empty)
    listed = F.when(F.col("o_orderstatus") != "O", listed) if again else listed
    name = F.concat(F.lit("od" if again else "OD"), F.col("o_orderkey").cast("string"))
    inside = F.struct(name.alias("id"), F.struct(F.col("o_orderstatus").alias("code")).alias("type"), (F.col("o_totalprice") + int(again)).alias("amount"), F.date_format("o_orderdate", "yyyy-MM-dd'T'00:00:00'Z'").alias("received"), F.struct(listed.alias("lines")).alias("waste"))
    sent = F.struct(F.lit("2024-02-01T00:00:00Z" if again else "2024-01-01T00:00:00Z").alias("retrievedDateUtc"), inside.alias("handler"))
    parts = o.groupBy(F.col("month").alias("of")).agg(F.ceil(F.count("*") / BODY).alias("parts"))
    o = o.filter("o_orderpriority = '1-URGENT'") if again else o
    e = o.select("month", "o_orderkey", F.to_json(sent).alias("e")).join(F.broadcast(parts), F.col("month").eqNullSafe(F.col("of")))
    return e.groupBy("month", F.pmod(F.xxhash64("o_orderkey"), "parts").alias("part")).agg(F.concat(F.lit("["), F.array_join(F.collect_list("e"), ","), F.lit("]")).alias("value"))


def _given(s: SparkSession, d: str) -> list[DataFrame]:
    """The bodies of both loads, stored: lines are put in order, and under their orders, once."""
    orders = workspace.written(_orders(s, d), "orders")
    out = [workspace.written(_envelopes(s, d, again, orders), "given") for again in (False, True)]
    workspace.dropped(orders)
    return out


@query(
    f"""WITH {L}, o AS (SELECT 'OD' || o_orderkey AS order_id, o_orderkey AS k, o_orderstatus AS kind, o_totalprice + (o_orderpriority = '1-URGENT')::INT AS amount, CAST(o_orderdate AS DATE) AS received, o_orderpriority = '1-URGENT' AS again FROM orders),
    lb AS (SELECT l.*, o.kind, o.again, l.flag <> 'R' AS kept, row_number() OVER (PARTITION BY l.order_id, l.flag <> 'R' ORDER BY pos) - 1 AS newpos FROM l JOIN o ON o.k = l.order_id),
    live AS (SELECT order_id, pos, part, quantity, flag, state FROM lb WHERE NOT again OR kind = 'O'
      UNION ALL SELECT order_id, newpos, part, quantity, flag, state FROM lb WHERE again AND kind <> 'O' AND kept)
    SELECT o.order_id, o.kind, o.amount, o.received, count(live.pos) AS lines, coalesce(sum(live.quantity), 0) AS quantity, coalesce(sum(live.pos * live.part), 0)::BIGINT AS places,
      count(*) FILTER (live.flag = 'N') AS flagged FROM o LEFT JOIN live ON live.order_id = o.k GROUP BY ALL"""
)
def a6_landed_load(s, d):
    """Bodies that land as files, a month each, in two loads: records with their live lines and flags."""
    root = workspace.new_folder(s, "mirror")
    ingest.create(s, root, ORDER, 16)
    for given in _given(s, d):
        given.write.mode("append").option("compression", "gzip").partitionBy("month", "part").text(f"{root}/landed")
        workspace.dropped(given)
        ingest.land(s, f"{root}/landed", root, ORDER, f"{root}/checkpoint", 10_000).awaitTermination()
    buckets.vacuum(s, root, keep=1)
    live = lambda name: buckets.read(s, root, name).filter("not is_deleted").drop("is_deleted")
    first = live("line_flag").filter("place = 0").select("order_id", "pos", "flag")
    own = live("line").join(first, ["order_id", "pos"], "left")
    sums = own.groupBy("order_id").agg(F.count("*").alias("lines"), F.sum("quantity").alias("quantity"), F.sum(F.col("pos") * F.col("part")).alias("places"), F.count_if(F.col("flag") == "N").alias("flagged"))
    zero = lambda c, to="long": F.coalesce(c, F.lit(0)).cast(to).alias(c)
    return live("orders").join(sums, "order_id", "left").select("order_id", "kind", "amount", "received", zero("lines"), zero("quantity", "double"), zero("places"), zero("flagged"))


@query(
    f"""WITH {L}, u AS (SELECT o_orderkey AS order_id, o_orderstatus AS kind FROM orders WHERE o_orderpriority = '1-URGENT'),
    old AS (SELECT l.* FROM l JOIN u USING (order_id) WHERE u.kind <> 'O'),
    new AS (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY pos) - 1 AS newpos FROM old WHERE flag <> 'R'),
    x AS (SELECT old.pos, new.newpos, old.part <> new.part OR old.quantity <> new.quantity AS moved, (old.flag <> new.flag)::INT + (old.state <> new.state)::INT AS flags
      FROM old LEFT JOIN new ON new.order_id = old.order_id AND new.newpos = old.pos)
    SELECT (SELECT count(*) FROM u) AS elements, 0 AS inserted, (SELECT count(*) FROM u) AS updated, 0 AS unchanged, (SELECT count(*) FROM u) AS raw_rows,
      (SELECT count(*) FILTER (newpos IS NULL OR moved) + coalesce(sum(flags), 0) FROM x)::BIGINT AS child_rows, (SELECT count(*) FILTER (newpos IS NULL) FROM x) AS child_retired,
      1 AS absent_collections, (SELECT count(*) FROM u WHERE kind <> 'P') AS status_rows, (SELECT count(*) FROM u WHERE kind = 'P') AS shortfall"""
)
def d7_merge_report(s, d):
    """All counters of one merge: the urgent orders sent anew, of which those of status P were never enumerated."""
    root = workspace.new_folder(s, "mirror")
    ingest.create(s, root, ORDER, 16)
    done = None
    for given in _given(s, d):
        if done:
            done.drop()
        done = ingest.apply(given.select(F.concat_ws("-", "month", "part").alias("path"), F.col("value").alias("body")), root, ORDER)
        workspace.dropped(given)
    buckets.vacuum(s, root, keep=1)
    status = table(s, d, "orders").filter("o_orderstatus <> 'P'").select(F.concat(F.lit("OD"), F.col("o_orderkey").cast("string")).alias("order_id"), F.lit(False).alias("is_deleted"))
    return merge.merge_report(done.plans, done.sent, ORDER, status)


@query(
    f"""WITH {V}, {NAMED}, {NT}, {NB}, s AS (SELECT entity, kind, seq, priority = '4-NOT SPECIFIED' AS is_deleted FROM n WHERE priority <> '3-MEDIUM'),
    p AS (SELECT b.*, CASE WHEN t.is_deleted IS NULL THEN 'Inserted' WHEN t.is_deleted OR t.received IS DISTINCT FROM b.received OR t.current IS DISTINCT FROM b.current OR t.amount IS DISTINCT FROM b.amount THEN 'Updated' ELSE 'Unchanged' END AS outcome
      FROM b LEFT JOIN t ON {ON})
    SELECT 'merged' AS form, 'Succeeded' AS status, outcome, count(*) AS n, count(*) FILTER (p.received >= '1998-01-01') AS hashed FROM s JOIN p ON lower(s.entity) = lower(rtrim(p.entity)) AND lower(s.kind) = p.kind AND s.seq = p.seq WHERE NOT s.is_deleted GROUP BY 3
    UNION ALL SELECT 'failed', 'Failed', NULL, count(*), 0 FROM s JOIN p ON lower(s.entity) = lower(rtrim(p.entity)) AND lower(s.kind) = p.kind AND s.seq = p.seq WHERE NOT s.is_deleted"""
)
def d8_closeout_forms(s, d):
    """Status rows after a merge, and after one that failed; a third of the versions was never enumerated or is deleted."""
    own = named(s, d).filter("priority <> '3-MEDIUM'").select(*KEY, F.lit("Pending").alias("status"), F.lit("x").alias("outcome"), (F.col("priority") == "4-NOT SPECIFIED").alias("is_deleted"))
    b, now = batch(s, d), F.lit("2024-03-01").cast("timestamp")
    raw = b.filter("received >= '1998-01-01'").select(*KEY, F.lit("AB").alias("payload_sha256"))
    merged = merge.closeout(own, b, merge.upsert_rows(stored(s, d), b, KEY, VALUES), raw, KEY, now)
    failed = merge.failed_closeout(own, b, KEY, now).withColumn("payload_sha256", F.lit(None).cast("string"))
    both = [x.groupBy(F.lit(form).alias("form"), "status", "outcome").agg(F.count("*").alias("n"), F.count("payload_sha256").alias("hashed")) for form, x in (("merged", merged), ("failed", failed))]
    return both[0].unionByName(both[1])


# ---- the journal: what is stored of customers, and the events of users ----

STATUS = """s AS (SELECT 'U' || c_custkey AS id, CASE c_mktsegment WHEN 'BUILDING' THEN 'Succeeded' WHEN 'AUTOMOBILE' THEN 'Failed' WHEN 'MACHINERY' THEN 'InProgress' ELSE 'Pending' END AS status,
  'XX' AS location, CASE c_mktsegment WHEN 'BUILDING' THEN 'Inserted' END AS outcome, c_nationkey::INT AS attempts, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 500 END::INT AS http,
  CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'E0' END AS error_code, NULL::VARCHAR AS error_message, NULL::VARCHAR AS error_id, NULL::TIMESTAMP AS error_date,
  c_custkey AS source_id, 'AB' AS payload_sha256, TIMESTAMP '2023-12-01' AS first_seen, CASE c_mktsegment WHEN 'MACHINERY' THEN TIMESTAMP '2023-12-31' END AS attempt_started,
  CASE c_mktsegment WHEN 'BUILDING' THEN TIMESTAMP '2023-12-02' END AS completed, NULL::INT AS duration_ms, c_mktsegment = 'AUTOMOBILE' AS is_deleted FROM customer WHERE c_mktsegment <> 'FURNITURE')"""
EVENTS = """ev AS (SELECT 'u' || user_id AS id, dayofyear(ts)::BIGINT AS flush, event_id AS seq, CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 1 WHEN 'error' THEN 2 WHEN 'signup' THEN 3 END AS rank, ts AS at,
  CASE WHEN value > 50 THEN 'MD' ELSE 'VA' END AS location, floor(value)::INT AS attempt, 400 + floor(value)::INT AS http, 'E' || floor(value)::INT AS error_code FROM events WHERE event_type <> 'purchase'),
  lasts AS (SELECT * FROM ev QUALIFY row_number() OVER (PARTITION BY id, flush, rank ORDER BY seq DESC) = 1),
  last AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY flush, rank) AS n FROM lasts)"""
#: One step of the replay in SQL: the row r of a key after its n-th event e.
STEP = """CASE WHEN e.rank = 0 THEN e.location ELSE r.location END AS location,
  CASE WHEN e.rank = 0 THEN CASE WHEN r.is_deleted IS NOT FALSE THEN 'Pending' ELSE r.status END WHEN acts THEN ['InProgress', 'Failed', 'Skipped'][e.rank] ELSE r.status END AS status,
  CASE WHEN e.rank = 0 THEN CASE WHEN r.is_deleted IS FALSE THEN r.outcome END WHEN acts AND e.rank > 1 THEN NULL ELSE r.outcome END AS outcome,
  CASE WHEN e.rank = 0 THEN CASE WHEN r.is_deleted IS FALSE THEN r.attempts ELSE 0 END WHEN acts AND e.rank = 1 THEN e.attempt ELSE r.attempts END AS attempts,
  CASE WHEN e.rank = 0 THEN CASE WHEN r.is_deleted IS FALSE THEN r.http END WHEN acts AND e.rank = 1 THEN NULL WHEN acts AND e.rank = 2 THEN e.http ELSE r.http END AS http,
  CASE WHEN e.rank = 0 THEN CASE WHEN r.is_deleted IS FALSE THEN r.error_code END WHEN acts AND e.rank = 1 THEN NULL WHEN acts AND e.rank = 2 THEN e.error_code ELSE r.error_code END AS error_code,
  CASE WHEN e.rank = 0 AND r.is_deleted IS NOT FALSE THEN NULL ELSE r.source_id END AS source_id,
  CASE WHEN e.rank = 0 AND r.is_deleted IS NOT FALSE THEN e.at ELSE r.first_seen END AS first_seen,
  CASE WHEN e.rank = 0 AND r.is_deleted IS NOT FALSE THEN NULL WHEN acts AND e.rank = 1 THEN e.at ELSE r.attempt_started END AS attempt_started,
  CASE WHEN e.rank = 0 THEN CASE WHEN r.is_deleted IS FALSE THEN r.completed END WHEN acts THEN CASE WHEN e.rank > 1 THEN e.at END ELSE r.completed END AS completed,
  CASE WHEN e.rank = 0 THEN CASE WHEN r.is_deleted IS FALSE THEN r.duration_ms END WHEN acts AND e.rank = 2
    THEN CASE WHEN r.attempt_started IS NOT NULL THEN least(epoch_us(e.at) // 1000 - epoch_us(r.attempt_started) // 1000, 2147483647)::INT END ELSE r.duration_ms END AS duration_ms,
  CASE WHEN e.rank = 0 THEN false ELSE r.is_deleted END AS is_deleted"""
COLUMNS = "location, status, outcome, attempts, http, error_code, source_id, first_seen, attempt_started, completed, duration_ms, is_deleted"
REPLAY = f"""WITH RECURSIVE {STATUS}, {EVENTS}, keys AS (SELECT id FROM s UNION SELECT upper(id) FROM last),
  x AS (SELECT 0::BIGINT AS n, keys.id, {COLUMNS}, NULL::INT AS rank, NULL::VARCHAR AS verdict FROM keys LEFT JOIN s USING (id)
    UNION ALL SELECT n + 1, id, {COLUMNS}, rank, verdict FROM (
      SELECT r.n, r.id, {STEP}, e.rank AS rank,
        CASE WHEN e.rank = 0 OR acts THEN 'written' WHEN r.is_deleted IS FALSE THEN 'skipped_succeeded' ELSE 'not_found' END AS verdict
      FROM (SELECT *, is_deleted IS FALSE AND status <> 'Succeeded' AS acts FROM x) r JOIN last e ON upper(e.id) = r.id AND e.n = r.n + 1))"""


def status_rows(s: SparkSession, d: str) -> DataFrame:
    c, seg = table(s, d, "customer").filter("c_mktsegment <> 'FURNITURE'"), F.col("c_mktsegment")
    at = lambda when, day: F.when(seg == when, F.lit(day).cast("timestamp"))
    return c.select(
        F.concat(F.lit("U"), F.col("c_custkey").cast("string")).alias("id"),
        F.lit("XX").alias("location"),
        F.when(seg == "BUILDING", "Succeeded").when(seg == "AUTOMOBILE", "Failed").when(seg == "MACHINERY", "InProgress").otherwise("Pending").alias("status"),
        F.when(seg == "BUILDING", "Inserted").alias("outcome"),
        F.col("c_nationkey").alias("attempts"),
        F.when(seg == "AUTOMOBILE", 500).alias("http"),
        F.when(seg == "AUTOMOBILE", "E0").alias("error_code"),
        *(F.lit(None).cast("string").alias(c) for c in ("error_message", "error_id")),
        F.lit(None).cast("timestamp").alias("error_date"),
        F.col("c_custkey").alias("source_id"),
        F.lit("AB").alias("payload_sha256"),
        F.lit("2023-12-01").cast("timestamp").alias("first_seen"),
        at("MACHINERY", "2023-12-31").alias("attempt_started"),
        at("BUILDING", "2023-12-02").alias("completed"),
        F.lit(None).cast("int").alias("duration_ms"),
        (seg == "AUTOMOBILE").alias("is_deleted"),
    )


def journal_events(s: SparkSession, d: str) -> DataFrame:
    modes = F.create_map(*(F.lit(x) for x in ("view", "Enumerate", "click", "Attempt", "error", "Fail", "signup", "Skip")))
    n = F.floor("value").cast("int")
    return (
        table(s, d, "events")
        .filter("event_type <> 'purchase'")
        .select(
            F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("id"),
            F.dayofyear("ts").cast("long").alias("flush"),
            F.col("event_id").alias("seq"),
            modes[F.col("event_type")].alias("mode"),
            F.col("ts").cast("timestamp").alias("at"),
            F.when(F.col("value") > 50, "MD").otherwise("VA").alias("location"),
            n.alias("attempt"),
            (n + 400).alias("http"),
            F.concat(F.lit("E"), n.cast("string")).alias("error_code"),
            *(F.lit(None).cast(t).alias(c) for c, t in (("error_message", "string"), ("error_id", "string"), ("error_date", "timestamp"))),
        )
    )


@query(
    f"""{REPLAY} SELECT id, {COLUMNS.replace("first_seen, attempt_started, completed", "epoch_us(first_seen) // 1000 AS first_seen, epoch_us(attempt_started) // 1000 AS attempt_started, epoch_us(completed) // 1000 AS completed")}
    FROM x WHERE is_deleted IS NOT NULL QUALIFY row_number() OVER (PARTITION BY id ORDER BY n DESC) = 1"""
)
def d21_replay(s, d):
    """All progress columns of every status row after the month's events."""
    after = journal.replayed(status_rows(s, d), journal_events(s, d), ["id"])
    ms = {c: F.unix_millis(c) for c in ("first_seen", "attempt_started", "completed")}
    return after.withColumns(ms).select(F.upper("id").alias("id"), *COLUMNS.split(", "))


@query(f"{REPLAY} SELECT ['Enumerate', 'Attempt', 'Fail', 'Skip'][rank + 1] AS mode, verdict, count(*) AS n FROM x WHERE verdict IS NOT NULL GROUP BY 1, 2")
def d20_verdicts(s, d):
    return journal.verdicts(status_rows(s, d), journal_events(s, d), ["id"]).groupBy("mode", "verdict").agg(F.count("*").alias("n"))


@query(
    f"""WITH {STATUS}, r AS (SELECT n_nationkey AS run, CASE WHEN n_regionkey = 0 THEN 'Running' WHEN n_regionkey = 1 THEN 'Failed' ELSE 'Succeeded' END AS run_status, n_regionkey = 4 AS is_deleted FROM nation)
    SELECT s.id, r.run, r.run_status, s.status AS previous_status, 'Failed' AS status, epoch_us(coalesce(s.completed, TIMESTAMP '2024-03-01')) // 1000 AS completed
    FROM s JOIN r ON s.attempts = r.run WHERE NOT s.is_deleted AND NOT r.is_deleted AND s.status IN ('Pending', 'InProgress') AND r.run_status <> 'Running'"""
)
def d24_sweep(s, d):
    n = table(s, d, "nation").select(F.col("n_nationkey").alias("run"), F.when(F.col("n_regionkey") == 0, "Running").when(F.col("n_regionkey") == 1, "Failed").otherwise("Succeeded").alias("run_status"), (F.col("n_regionkey") == 4).alias("is_deleted"))
    own = status_rows(s, d).withColumn("run", F.col("attempts"))
    return journal.swept(own, n, "run", F.lit("2024-03-01").cast("timestamp")).select("id", "run", "run_status", "previous_status", "status", F.unix_millis("completed").alias("completed"))


@query(
    """SELECT path, message, withheld, count(*) AS n FROM (
      SELECT CASE event_type WHEN 'view' THEN '/API/hd/' || event_id ELSE '(withheld)' END AS path, CASE WHEN value > 20 THEN '(withheld)' ELSE 'no route /API/hd/x' END AS message,
        (event_type <> 'view')::INT + (value > 20)::INT AS withheld FROM events) GROUP BY 1, 2, 3"""
)
def d23_any_case(s, d):
    """Credentials in paths and messages of any case."""
    e = table(s, d, "events")
    path = F.when(F.col("event_type") == "view", F.concat(F.lit("/API/hd/"), F.col("event_id").cast("string"))).when(F.col("event_type") == "click", "/API/AUTH/key1/x").otherwise("HTTPS://host/x")
    message = F.when(F.col("value") > 50, "no route /API/V1/Auth").when(F.col("value") > 20, "no route /api/Auth/secret").otherwise("no route /API/hd/x")
    given = e.select(path.alias("path"), message.alias("message"), *(F.lit(None).cast("string").alias(c) for c in ("failure", "error_code", "error_id")))
    return journal.withheld(given).groupBy("path", "message", "withheld").agg(F.count("*").alias("n"))


@query(
    """SELECT event_id AS n, CASE WHEN event_type = 'view' THEN floor(value)::INT WHEN event_type <> 'error' THEN least(floor(value)::BIGINT * 86400 * 1000, 2147483647)::INT END AS duration FROM events"""
)
def d22_attempt_durations(s, d):
    """Events as attempts that took as many days as their value, some of which measured it themselves or never ended."""
    e, at = table(s, d, "events"), F.col("ts").cast("timestamp")
    done = F.when(F.col("event_type") != "error", F.timestamp_micros(F.unix_micros(at) + F.floor("value").cast("long") * 86_400_000_000))
    a = e.select(F.col("event_id").alias("n"), at.alias("started"), done.alias("completed"), F.when(F.col("event_type") == "view", F.floor("value").cast("long")).alias("duration"))
    return journal.with_duration(a).select("n", "duration")


@query(
    """SELECT event_id AS run, least(CASE WHEN event_type = 'error' THEN 1706700000 - floor(epoch_us(ts) // 1000000)::BIGINT ELSE floor(value)::BIGINT * 60 END, 2147483647)::INT AS elapsed_seconds FROM events"""
)
def e5_elapsed(s, d):
    """Events as runs of as many minutes as their value; errors run until now."""
    at = F.col("ts").cast("timestamp")
    done = F.when(F.col("event_type") != "error", F.timestamp_micros(F.unix_micros(at) + F.floor("value").cast("long") * 60_000_000))
    r = table(s, d, "events").select(F.col("event_id").alias("run"), at.alias("started"), done.alias("completed"))
    return runs.elapsed(r, F.timestamp_seconds(F.lit(1706700000))).select("run", "elapsed_seconds")


# ---- segmented scans ----

OPEN = """r AS (SELECT event_id AS run, CASE WHEN value > 50 THEN event_type ELSE upper(event_type) END AS place, epoch_us(ts) // 1000 AS a,
  CASE WHEN value <= 200 THEN epoch_us(ts) // 1000 + floor(value)::BIGINT * 6000 END AS z, CASE WHEN value < 1 THEN 'Targeted' ELSE 'Full' END AS mode FROM events)"""


@query(
    f"""WITH {OPEN}, o AS (SELECT *, coalesce(z, 1706700000000) AS until FROM r WHERE mode <> 'Targeted'),
    x AS (SELECT x.run, max((y.until, y.run)) AS m FROM o x JOIN o y ON upper(x.place) = upper(y.place) AND (y.a, y.run) < (x.a, x.run) AND y.until > x.a GROUP BY 1)
    SELECT run, m[1] AS busy_until, m[2] AS blocked_by FROM x"""
)
def d26_overlapping_runs(s, d):
    """Events as runs of their type: those of a large value never ended, those of a small one are Targeted."""
    v, at = F.col("value"), F.unix_millis(F.col("ts").cast("timestamp"))
    place = F.when(v > 50, F.col("event_type")).otherwise(F.upper("event_type"))
    r = table(s, d, "events").select(F.col("event_id").alias("run"), place.alias("place"), at.alias("a"), F.when(v <= 200, at + F.floor(v).cast("long") * 6000).alias("z"), F.when(v < 1, "Targeted").otherwise("Full").alias("mode"))
    return journal.overlapping_runs(r, "place", "run", "a", "z", F.lit(1706700000000)).select("run", "busy_until", "blocked_by")


REQUESTS = """q AS (SELECT event_id AS n, CASE WHEN value BETWEEN 3 AND 4 THEN ' ' WHEN event_type = 'click' THEN 'mark' ELSE 'MARK' END AS feed, 'L' || user_id AS place,
    CASE WHEN event_type <> 'view' OR value < 2 THEN floor(value)::BIGINT END AS mark, event_type = 'view' AND value < 30 AS clear, event_type = 'signup' AS rewind,
    CASE WHEN event_type IN ('click', 'purchase') AND value < 45 THEN dayofyear(ts)::BIGINT + (CASE WHEN value BETWEEN 10 AND 11 THEN 400 ELSE 0 END) END AS run,
    CASE WHEN event_type = 'signup' AND value > 6 OR event_type = 'view' AND value > 8 OR event_type = 'error' AND value > 60 THEN 'why' ELSE '' END AS note FROM events),
  days AS (SELECT dayofyear(ts)::BIGINT AS run, count(*) FILTER (event_type = 'error') AS e, count(*) FILTER (event_type = 'purchase') AS p, count(*) FILTER (event_type = 'view') AS v FROM events GROUP BY 1),
  runs AS (SELECT run, CASE WHEN e > p + 5 THEN 'Failed' WHEN v > p THEN 'Running' ELSE 'Succeeded' END AS run_status FROM days),
  told AS (SELECT q.*, CASE WHEN trim(feed) = '' THEN 'blank_feed' WHEN clear AND mark IS NOT NULL THEN 'clear_and_mark' WHEN clear AND note = '' THEN 'clear_without_note' WHEN rewind AND note = '' THEN 'rewind_without_note'
    WHEN mark > 110 THEN 'future' WHEN q.run IS NOT NULL AND runs.run IS NULL THEN 'run_unknown' WHEN q.run IS NOT NULL AND run_status NOT IN ('Running', 'Succeeded') THEN 'run_not_advancing' END AS alone,
    row_number() OVER (PARTITION BY upper(feed), place ORDER BY n) AS k FROM q LEFT JOIN runs USING (run))"""


@query(
    f"""WITH RECURSIVE {REQUESTS}, x AS (
      SELECT 0::BIGINT AS k, upper(feed) AS feed, place, NULL::BIGINT AS current, NULL::BIGINT AS before, NULL::BIGINT AS n, NULL::VARCHAR AS verdict FROM told GROUP BY 2, 3
      UNION ALL SELECT k, feed, place, CASE WHEN verdict = 'accepted' THEN CASE WHEN clear THEN NULL ELSE coalesce(mark, current) END ELSE current END, current, n, verdict FROM (
        SELECT t.k, x.feed, x.place, x.current, t.n, t.mark, t.clear, coalesce(t.alone, CASE WHEN NOT t.rewind AND NOT t.clear AND t.mark < x.current THEN 'rewind'
          WHEN (CASE WHEN t.clear THEN NULL ELSE coalesce(t.mark, x.current) END) IS DISTINCT FROM x.current AND t.run IS NULL AND t.note = '' THEN 'unattributed' ELSE 'accepted' END) AS verdict
        FROM x JOIN told t ON upper(t.feed) = x.feed AND t.place = x.place AND t.k = x.k + 1))
    SELECT n, before, verdict FROM x WHERE n IS NOT NULL"""
)
def d28_watermark_audit(s, d):
    """Events as requests to move the mark of their user's feed, by runs that are their days."""
    e, v, kind = table(s, d, "events"), F.col("value"), F.col("event_type")
    day = F.dayofyear("ts").cast("long")
    q = e.select(
        F.col("event_id").alias("n"),
        F.when(v.between(3, 4), " ").when(kind == "click", "mark").otherwise("MARK").alias("feed"),
        F.concat(F.lit("L"), F.col("user_id").cast("string")).alias("place"),
        F.when((kind != "view") | (v < 2), F.floor(v).cast("long")).alias("mark"),
        ((kind == "view") & (v < 30)).alias("clear"),
        (kind == "signup").alias("rewind"),
        F.when(kind.isin("click", "purchase") & (v < 45), day + F.when(v.between(10, 11), 400).otherwise(0)).alias("run"),
        F.when((kind == "signup") & (v > 6) | (kind == "view") & (v > 8) | (kind == "error") & (v > 60), "why").otherwise("").alias("note"),
    )
    n = lambda name: F.count_if(kind == name)
    status = F.when(n("error") > n("purchase") + 5, "Failed").when(n("view") > n("purchase"), "Running").otherwise("Succeeded")
    days = e.groupBy(day.alias("run")).agg(status.alias("run_status")).withColumn("is_deleted", F.lit(False))
    return journal.watermark_audit(q, days, ["feed", "place"], "n", F.lit(110)).select("n", "before", "verdict")


# ---- the tree: customers as records, their orders and, inside those, the orders' lines ----

TREE = FieldMap(("id",), (Field("id", "$.id"),), (Collection("orders", "$.orders", (), (Collection("lines", "$.lines", (), (), "pos"),), "place"),), "customers")
TREES = f"""{L}, {TL}, r AS (SELECT 'C' || c_custkey AS id, c_custkey AS k, c_mktsegment = 'BUILDING' AS is_deleted, c_nationkey < 5 AS doomed FROM customer),
  o AS (SELECT 'c' || o_custkey AS id, o_custkey AS k, o_orderkey AS place, o_orderpriority = '5-LOW' AS is_deleted FROM orders),
  x AS (SELECT o.id, o.k, o.place, tl.pos, tl.is_deleted FROM tl JOIN o ON o.place = tl.order_id)"""


def _tree(s: SparkSession, d: str) -> dict[str, DataFrame]:
    no = {"deleted_at": F.lit(None).cast("timestamp"), "deleted_reason": F.lit(None).cast("string")}
    name = lambda letter, c: F.concat(F.lit(letter), F.col(c).cast("string")).alias("id")
    r = table(s, d, "customer").select(name("C", "c_custkey"), (F.col("c_mktsegment") == "BUILDING").alias("is_deleted"))
    o = table(s, d, "orders").select(name("c", "o_custkey"), F.col("o_orderkey").alias("place"), (F.col("o_orderpriority") == "5-LOW").alias("is_deleted"))
    x = target_lines(s, d).join(o.select("id", F.col("place").alias("order_id")), "order_id").select("id", F.col("order_id").alias("place"), "pos", "is_deleted")
    return {name: t.withColumns(no) for name, t in (("customers", r), ("orders", o), ("lines", x))}


def _doomed(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "customer").filter("c_nationkey < 5").select(F.concat(F.lit("c"), F.col("c_custkey").cast("string"), F.lit(" ")).alias("id"))


@query(
    f"""WITH {TREES}, d AS (SELECT k FROM r WHERE doomed)
    SELECT * FROM (SELECT 'customers' AS "table", count(*) AS rows, 0 AS again FROM r WHERE NOT is_deleted AND k IN (FROM d)
      UNION ALL SELECT 'orders', count(*), 0 FROM o WHERE NOT is_deleted AND k IN (FROM d) UNION ALL SELECT 'lines', count(*), 0 FROM x WHERE NOT is_deleted AND k IN (FROM d))"""
)
def d13_cascade_tree(s, d):
    """Rows that a deletion stamps on three levels, and that the same deletion stamps again: none."""
    before = _tree(s, d)
    after = cascade.deleted(before, TREE, _doomed(s, d), "2024-03-01", "no longer in scope")
    again = cascade.deleted(after, TREE, _doomed(s, d), "2024-04-01", "no longer in scope")
    return cascade.counts(before, after).join(cascade.counts(after, again).withColumnRenamed("rows", "again"), "table")


@query(
    f"""WITH {TREES} SELECT 'orders' AS "table", count(*) AS orphans FROM o WHERE NOT is_deleted AND k NOT IN (SELECT k FROM r WHERE NOT is_deleted)
    UNION ALL SELECT 'lines', count(*) FROM x WHERE NOT is_deleted AND place NOT IN (SELECT place FROM o WHERE NOT is_deleted)"""
)
def i9_orphan_tree(s, d):
    return cascade.orphans(_tree(s, d), TREE)


@query(
    f"""WITH {TREES}, b AS (SELECT k, 'orders' AS "table", is_deleted FROM o UNION ALL SELECT k, 'lines', is_deleted FROM x)
    SELECT 'c' || k AS id, "table", count(*) AS rows, count(*) FILTER (NOT is_deleted) AS live FROM b GROUP BY 1, 2"""
)
def i5_census(s, d):
    return cascade.census(_tree(s, d), TREE)


# ---- the declared record: a part each, every property filled by its place in the shape, some left out ----


def _leaf(kind: int | str, i: int, k: Column) -> Column:
    """What property number ``i`` of element ``k`` holds; every seventh is absent."""
    at = k + i
    made = {BIT: at % 2 == 0, DATE: F.date_format(F.date_add(F.lit("2000-01-01").cast("date"), (at % 1000).cast("int")), "yyyy-MM-dd"), FLOAT: at + 0.5}
    text = lambda w: F.left(F.concat(F.lit(f"{i}-"), k.cast("string")), F.lit(w))
    value = text(kind + (i % 13 == 5)) if isinstance(kind, int) else made.get(kind, at)
    return F.when(at % 7 != 3, value)


def _leaf_sql(kind: int | str, i: int) -> str:
    made = {BIT: f"((k + {i}) % 2 = 0)", DATE: f"DATE '2000-01-01' + ((k + {i}) % 1000)::INT", FLOAT: f"k + {i} + 0.5"}
    value = f"left('{i}-' || k, {kind + (i % 13 == 5)})" if isinstance(kind, int) else made.get(kind, f"k + {i}")
    return f"CASE WHEN (k + {i}) % 7 <> 3 THEN {value} END"


def _shaped(shape: Shape, k: Column, count: list[int], fixed: dict[str, Column], arrays: dict[str, Column], above: str = "") -> Column:
    """The struct of a shape; ``count`` numbers its leaves, ``arrays`` are the collections by path."""
    out = []
    for name, kind in shape.items():
        path = above + name
        if isinstance(kind, dict):
            out.append(_shaped(kind, k, count, fixed, arrays, f"{path}.").alias(name))
        else:
            out.append(fixed.get(path, _leaf(kind, count[0], k)).alias(name))
            count[0] += 1
    out += [c.alias(p[len(above) :]) for p, c in arrays.items() if p.startswith(above) and "." not in p[len(above) :]]
    return F.struct(*out)


def _arrays(found: dict, k: Column) -> dict[str, Column]:
    """Collection number c has (k + c) % 3 elements."""

    def one(c: int, shape: Shape | tuple[str, int], inside: dict) -> Column:
        element = lambda j: _shaped(shape, j, [0], {}, _arrays(inside, j)) if isinstance(shape, dict) else _leaf(shape[1], 0, j)
        n = (k + c) % 3
        return F.when(n > 0, F.transform(F.sequence(F.lit(1), n), lambda j: element(k + j))).otherwise(F.array().cast("array<string>") if not isinstance(shape, dict) else None)

    return {path: one(c, shape, inside) for c, (path, (shape, inside)) in enumerate(found.items())}


def _whole_bodies(s: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey")
    fixed = {"handlerId": F.concat(F.lit("H"), k.cast("string")), "type.code": F.lit("A"), "sequence": F.lit(1)}
    # A part is a small row and makes a body of kilobytes: a split of the table would be much work for one task.
    spread = table(s, d, "part").repartition(4 * s.sparkContext.defaultParallelism, "p_partkey")
    made = spread.select(F.to_json(_shaped(RECORD, k, [0], fixed, _arrays(COLLECTIONS, k))).alias("body"))
    return workspace.written(made, "bodies")


def _tables_sql() -> list[tuple[str, str, list[tuple[str, str, int | None]]]]:
    """(table, FROM, its columns as (name, expression, width)) of every declared table."""
    fixed = {"handlerId": "'H' || k", "type.code": "'A'", "sequence": "1"}
    out = [(DECLARED.name, "(SELECT p_partkey AS k FROM part)", [(f.column, fixed.get(path, _leaf_sql(kind, i)), f.width) for i, (f, (path, kind)) in enumerate(zip(DECLARED.fields, leaves(RECORD)))])]

    def below(found: dict, declared, source: str) -> None:
        for n, (c, (shape, inside)) in enumerate(zip(declared, found.values())):
            own = f"(SELECT k + j AS k FROM {source}, unnest(range(1, (k + {n}) % 3 + 1)) AS u(j))"
            kinds = leaves(shape) if isinstance(shape, dict) else [("", shape[1])]
            out.append((c.name, own, [(f.column, _leaf_sql(kind, i), f.width) for i, (f, (_, kind)) in enumerate(zip(c.fields, kinds))]))
            below(inside, c.children, own)

    below(COLLECTIONS, DECLARED.collections, "(SELECT p_partkey AS k FROM part)")
    return out


@query(
    " UNION ALL ".join(
        f"""SELECT '{name}' AS "table", '{c}' AS "column", count(x) AS n, min(x)::VARCHAR AS least, max(x)::VARCHAR AS greatest FROM (SELECT {e} AS x FROM {source})""" for name, source, columns in _tables_sql() for c, e, _ in columns
    )
)
def c1_declared_columns(s, d):
    """All 377 declared columns of records and collections, from one reading of each body: values, least and greatest."""
    found = ingest.projected(shred.parsed(_whole_bodies(s, d)), DECLARED)
    out = None
    for name, columns in [(DECLARED.name, [f.column for f in DECLARED.fields]), *((c.name, c.payload) for c, *_ in DECLARED.walk())]:
        ends = [F.struct(F.lit(c).alias("column"), F.count(c).alias("n"), F.min(c).cast("string").alias("least"), F.max(c).cast("string").alias("greatest")) for c in columns]
        own = found[name].agg(F.array(*ends).alias("x")).select(F.lit(name).alias("table"), F.inline("x"))
        out = out.unionByName(own) if out else own
    return out


@query(
    " UNION ALL ".join(
        f"""SELECT '{name}' AS "table", '{c}' AS "column", {w} AS width, count(*) AS n, max(length(x))::INT AS longest FROM (SELECT {e} AS x FROM {source}) WHERE length(x) > {w} HAVING count(*) > 0"""
        for name, source, columns in _tables_sql()
        for c, e, w in columns
        if w
    )
)
def b5_declared_widths(s, d):
    """Columns of all declared tables that have values longer than declared."""
    wide = DECLARED.wide()
    return validate.declared_widths(ingest.projected(shred.parsed(_whole_bodies(s, d)), wide), wide)


# ---- code lists: sizes of brands as waste codes, regions as districts with their nations as counties ----

CODES = """w AS (SELECT 'B' || right(p_brand, 1) AS location, 'C' || p_size AS code, max(p_retailprice) AS top, p_size FROM part GROUP BY 1, 2, p_size),
  w2 AS (SELECT *, p_size < 45 AND location <> 'B1' AS sent, location NOT IN ('B1', 'B2') AS mentioned FROM w WHERE location <> 'B9'),
  c AS (SELECT n_regionkey AS r, n_nationkey, n_name, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS pos,
    row_number() OVER (PARTITION BY n_regionkey, n_nationkey <= 15 ORDER BY n_nationkey) - 1 AS pos2 FROM nation)"""


def _lists(s: SparkSession, d: str, again: bool) -> DataFrame:
    """Bodies of two lists. ``again``: without the large sizes and two brands, without region 0 and the later nations."""
    w = table(s, d, "part").groupBy(F.concat(F.lit("B"), F.right("p_brand", F.lit(1))).alias("activityLocation"), F.concat(F.lit("C"), F.col("p_size").cast("string")).alias("code"), "p_size").agg(F.max("p_retailprice").alias("top"))
    w = w.filter("p_size < 45 and activityLocation not in ('B1', 'B2')").withColumn("code", F.lower("code")) if again else w
    w = w.select(F.to_json(F.struct("activityLocation", "code", F.col("top").cast("string").alias("description"), F.lit("1").alias("active"))).alias("e"), F.lit("WasteCode").alias("list_name"))
    n = table(s, d, "nation")
    n = n.filter("n_nationkey <= 15 and n_regionkey <> 0") if again else n
    county = F.struct("n_nationkey", F.struct(F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("code"), F.col("n_name").alias("description")).alias("c"))
    n = n.groupBy("n_regionkey").agg(F.transform(F.array_sort(F.collect_list(county)), lambda x: x["c"]).alias("counties"))
    n = n.select(F.to_json(F.struct(F.lit("US").alias("activityLocation"), F.concat(F.lit("D"), F.col("n_regionkey").cast("string")).alias("code"), "counties")).alias("e"), F.lit("StateDistrict").alias("list_name"))
    return w.unionByName(n).groupBy("list_name").agg(F.concat(F.lit("["), F.array_join(F.collect_list("e"), ","), F.lit("]")).alias("body"))


@query(
    f"""WITH {CODES} SELECT 'code' AS "table", location AS a, 'C' || p_size AS b, 0 AS pos, top::VARCHAR AS text, location NOT IN ('B1', 'B2') AND p_size >= 45 AS is_deleted FROM w
    UNION ALL SELECT 'code', 'US', 'D' || r, 0, NULL, r = 0 FROM c GROUP BY r
    UNION ALL SELECT 'county', 'US', 'D' || old.r, old.pos, coalesce(new.n_name, old.n_name), old.r = 0 OR new.n_name IS NULL AND EXISTS (SELECT 1 FROM c x WHERE x.r = old.r AND x.n_nationkey <= 15)
      FROM c old LEFT JOIN c new ON new.r = old.r AND old.r <> 0 AND new.n_nationkey <= 15 AND new.pos2 = old.pos"""
)
def a3_code_refresh(s, d):
    """Two full refreshes in one commit each: codes that are no longer sent go, within the locations sent; retired districts take their counties."""
    root = workspace.new_folder(s, "lists")
    code_lists.create(s, root)
    for again in (False, True):
        code_lists.refresh(s, root, _lists(s, d, again))
    code = buckets.read(s, root, "code").select(F.lit("code").alias("table"), F.col("location").alias("a"), F.col("code").alias("b"), F.lit(0).alias("pos"), F.col("description").alias("text"), "is_deleted")
    return code.unionByName(buckets.read(s, root, "county").select(F.lit("county").alias("table"), F.col("location").alias("a"), F.col("district").alias("b"), "pos", F.col("county_description").alias("text"), "is_deleted"))


@query(
    """SELECT list_name, rule, count(*) AS n FROM (SELECT CASE p_brand WHEN 'Brand#1' THEN 'HsmReason' WHEN 'Brand#2' THEN 'Naics' WHEN 'Brand#3' THEN 'NoList' ELSE 'WasteCode' END AS list_name, p_size, p_brand, p_name FROM part) p,
      unnest([CASE WHEN p_size = 1 THEN 'code_missing' END, CASE WHEN p_size = 2 AND list_name <> 'HsmReason' THEN 'location_missing' END,
        CASE WHEN p_size > 1 AND length('K' || p_size) > CASE list_name WHEN 'HsmReason' THEN 1 WHEN 'NoList' THEN 0 ELSE 6 END THEN 'code_too_wide' END,
        CASE WHEN p_size = 3 THEN 'location_too_wide' END, CASE WHEN p_size = 4 AND list_name <> 'WasteCode' THEN 'description_too_wide' END, CASE WHEN p_size = 5 AND list_name <> 'WasteCode' THEN 'code_type_too_wide' END,
        CASE WHEN list_name = 'NoList' THEN 'unknown_list' END]) AS u(rule) WHERE rule IS NOT NULL GROUP BY 1, 2
    UNION ALL SELECT 'StateDistrict', 'county_code_missing', count(*) FROM nation WHERE n_regionkey = 1 UNION ALL SELECT 'StateDistrict', 'county_too_wide', count(*) FROM nation WHERE n_regionkey = 2"""
)
def b15_list_rules(s, d):
    """Parts as elements of four lists, one of which there isn't, and nations as counties, some without code or too wide."""
    size, brand = F.col("p_size"), F.col("p_brand")
    name = F.when(brand == "Brand#1", "HsmReason").when(brand == "Brand#2", "Naics").when(brand == "Brand#3", "NoList").otherwise("WasteCode")
    e = F.struct(
        F.when(size == 3, "ABC").when(size != 2, "AB").alias("activityLocation"),
        F.when(size > 1, F.concat(F.lit("K"), size.cast("string"))).alias("code"),
        F.when(size == 4, F.repeat(F.lit("x"), 300)).alias("description"),
        F.when(size == 5, F.repeat(F.lit("y"), 11)).alias("codeType"),
    )
    p = table(s, d, "part").select(name.alias("list_name"), F.to_json(e).alias("e"))
    county = F.struct(F.when(F.col("n_regionkey") != 1, F.when(F.col("n_regionkey") == 2, "TOO-WIDE").otherwise("N1")).alias("code"))
    n = table(s, d, "nation").groupBy("n_regionkey").agg(F.collect_list(county).alias("counties"))
    n = n.select(F.lit("StateDistrict").alias("list_name"), F.to_json(F.struct(F.lit("US").alias("activityLocation"), F.lit("D").alias("code"), "counties")).alias("e"))
    bodies = p.unionByName(n).groupBy("list_name").agg(F.concat(F.lit("["), F.array_join(F.collect_list("e"), ","), F.lit("]")).alias("body"))
    return code_lists.violations(code_lists.elements(bodies)).select("list_name", "rule", "n")


@query(
    """SELECT month, count(*) AS n, min(r) AS first_retrieved, max(sha) AS greatest FROM (SELECT strftime(o_orderdate, '%Y%m') AS month, epoch_us(o_orderdate::TIMESTAMP) // 1000 + 3600000 AS r,
      sha256('{"id":' || o_orderkey || ',"price":' || CAST(floor(o_totalprice) AS BIGINT) || '.5}') AS sha FROM orders) GROUP BY 1"""
)
def a1_envelopes(s, d):
    """Envelopes of orders: when each was retrieved, and the text of its record."""
    o = table(s, d, "orders")
    record = F.concat(F.lit('{ "id" : '), F.col("o_orderkey").cast("string"), F.lit(' , "price":'), F.floor("o_totalprice").cast("long").cast("string"), F.lit(".5 }"))
    e = F.concat(F.lit('{"retrievedDateUtc" : "'), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit('T00:00:00-01:00", "handler":'), record, F.lit(" }"))
    bodies = o.groupBy(F.date_format("o_orderdate", "yyyyMM").alias("month")).agg(F.concat(F.lit("["), F.array_join(F.collect_list(e), " , "), F.lit("]")).alias("body"))
    found = json_bodies.envelopes(bodies)
    return found.groupBy("month").agg(F.count("*").alias("n"), F.min(F.unix_millis("retrieved")).alias("first_retrieved"), F.max(F.sha2("record", 256)).alias("greatest"))


# ---- summary probe, resume ----

PROBED = f"""{V}, w AS (SELECT CASE WHEN amount > 900 THEN entity END AS entity, CASE WHEN priority <> '5-LOW' THEN kind END AS kind, seq, CASE WHEN priority <> '2-HIGH' THEN current END AS current FROM v),
  g AS (SELECT entity, string_agg(coalesce(kind, '?') || '/' || seq, ', ' ORDER BY coalesce(kind, ''), seq) AS versions, count(*) AS n_versions, count(*) FILTER (current) AS currents, max(seq) AS deepest
  FROM w WHERE entity IS NOT NULL GROUP BY entity)"""


def window_of(s: SparkSession, d: str) -> DataFrame:
    """Versions as a window's summaries: cheap ones name no entity, low ones no kind, high ones leave the flag out."""
    p = F.col("priority")
    return versions(s, d).select(F.when(F.col("amount") > 900, F.col("entity")).alias("entity"), F.when(p != "5-LOW", F.col("kind")).alias("kind"), "seq", F.when(p != "2-HIGH", F.col("current")).alias("current"))


@query(f"WITH {PROBED} SELECT count(*) AS summaries, count(DISTINCT entity) AS entities, count(*) FILTER (current) AS currents FROM w")
def g1_probe_totals(s, d):
    return probe.probe_totals(window_of(s, d), "entity", "current")


@query(f"WITH {PROBED} SELECT * FROM g WHERE n_versions > 1")
def g1_named_repeatedly(s, d):
    return probe.probed(window_of(s, d), "entity", "kind", "seq", "current").filter("n_versions > 1")


@query(f"WITH {PROBED} SELECT * FROM g WHERE deepest > 1 ORDER BY deepest DESC, entity LIMIT 20")
def g1_deepest_histories(s, d):
    return probe.deepest_histories(probe.probed(window_of(s, d), "entity", "kind", "seq", "current"), "entity")


@query(
    f"""WITH {S}, w AS (SELECT DISTINCT entity FROM s WHERE status IN ('Pending', 'InProgress')), c AS (SELECT DISTINCT entity FROM s WHERE status = 'Succeeded'), u AS (SELECT DISTINCT entity FROM s WHERE status = 'Failed'),
    n AS (SELECT (SELECT count(*) FROM (FROM w EXCEPT FROM c)) AS to_fetch, (SELECT count(*) FROM (FROM w INTERSECT FROM c)) AS to_skip, (SELECT count(*) FROM ((FROM c UNION FROM u) EXCEPT FROM w)) AS vanished)
    SELECT to_fetch, to_skip, vanished, CASE WHEN to_fetch + to_skip = 0 THEN 0 ELSE to_skip * 100.0::DOUBLE / (to_fetch + to_skip) END AS skip_rate FROM n"""
)
def f5_skip_rate(s, d):
    own = lambda *x: status(s, d).filter(F.col("status").isin(*x)).select("entity").distinct()
    return load_plan.resume_summary(load_plan.resume_plan(own("Pending", "InProgress"), own("Succeeded"), own("Failed"), ["entity"]))
