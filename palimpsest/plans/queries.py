"""Registered queries: each runs an operator over record versions, children and codes made from the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from palimpsest.fieldmap import Collection, Field, FieldMap
from palimpsest.functions.columns import lenient_date, shape_mask
from palimpsest.operators import current, journal, merge, quality, reads, shred, validate
from palimpsest.plans import load_plan
from palimpsest.sources import workspace

KEY = ["entity", "kind", "seq"]
PAIR = ["entity", "kind"]
VALUES = ["received", "current", "amount"]
ORDER_MAP = FieldMap(
    ("order_id",),
    (
        Field("order_id", "$.handler.id", "bigint", required=True),
        Field("kind", "$.handler.type.code", width=1),
        Field("amount", "$.handler.amount", "double"),
        Field("current", "$.handler.current", "boolean"),
        Field("received", "$.handler.received", "string"),
    ),
    (Collection("lines", "$.handler.lines"),),
)


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# ---- the tables that the operators run on, and the same in SQL -------------------------------------


def versions(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("o_custkey", "o_orderstatus").orderBy("o_orderdate", "o_orderkey")
    return table(spark, d, "orders").select(
        F.col("o_custkey").alias("entity"),
        F.col("o_orderstatus").alias("kind"),
        F.row_number().over(w).alias("seq"),
        F.to_date("o_orderdate").cast("string").alias("received"),
        (F.col("o_orderpriority") == "1-URGENT").alias("current"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderpriority").alias("priority"),
    )


def target(spark: SparkSession, d: str) -> DataFrame:
    """What is stored: the versions received before 2000, those of kind F with another amount, the least urgent ones deleted."""
    amount = F.when(F.col("kind") == "F", F.col("amount") + 1).otherwise(F.col("amount")).alias("amount")
    return versions(spark, d).filter("received < '2000-01-01'").select(*KEY, "received", "current", amount, (F.col("priority") == "5-LOW").alias("is_deleted"))


def batch(spark: SparkSession, d: str) -> DataFrame:
    """What is sent: the versions received since 1996."""
    return versions(spark, d).filter("received >= '1996-01-01'")


def lines(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    w = Window.partitionBy("l_orderkey").orderBy(*li.columns)
    return li.select(
        F.col("l_orderkey").alias("order_id"),
        (F.row_number().over(w) - 1).alias("pos"),
        F.col("l_partkey").alias("part"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_returnflag").alias("flag"),
        F.col("l_linestatus").alias("state"),
    )


LINE = ["order_id", "pos", "part", "quantity"]


def target_lines(spark: SparkSession, d: str) -> DataFrame:
    """Stored lines: all but those flagged N; open ones with another quantity, finished returned ones deleted."""
    quantity = F.when(F.col("state") == "O", F.col("quantity") + 1).otherwise(F.col("quantity")).alias("quantity")
    return lines(spark, d).filter("flag <> 'N'").select("order_id", "pos", "part", quantity, F.expr("flag = 'A' and state = 'F'").alias("is_deleted"))


def sent(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("order_id"), (F.col("o_orderstatus") != "P").alias("sent"))


def batch_lines(spark: SparkSession, d: str) -> DataFrame:
    """Sent lines: all but those flagged R, of the orders that send their lines."""
    return lines(spark, d).filter("flag <> 'R'").join(sent(spark, d).filter("sent").select("order_id"), "order_id").select(*LINE)


def payloads(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    inside = F.struct(
        F.col("o_orderkey").alias("id"),
        F.struct(F.col("o_orderstatus").alias("code")).alias("type"),
        F.col("o_totalprice").alias("amount"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority") == "1-URGENT").alias("current"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("received"),
    )
    return shred.parsed(o.select(F.to_json(F.struct(inside.alias("handler"))).alias("body")))


def bodies(spark: SparkSession, d: str) -> DataFrame:
    """Order bodies with their lines; without any, [] or, in status P, no property at all."""
    own = lines(spark, d).groupBy("order_id").agg(F.array_sort(F.collect_list(F.struct("pos", "part", "quantity"))).alias("lines"))
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("kind")).join(own, "order_id", "left")
    empty = F.expr("cast(array() as array<struct<pos:int,part:bigint,quantity:double>>)")
    listed = F.coalesce("lines", F.when(F.col("kind") != "P", empty))
    return o.select("order_id", F.to_json(F.struct(F.struct(F.col("order_id").alias("id"), listed.alias("lines")).alias("handler"))).alias("body"))


def nested(spark: SparkSession, d: str) -> DataFrame:
    return shred.parsed(bodies(spark, d))


def status(spark: SparkSession, d: str) -> DataFrame:
    """One row per event: the day is the run, the user the version, the type the status."""
    named = F.create_map(*(F.lit(x) for x in ("view", "Pending", "click", "InProgress", "purchase", "Succeeded", "error", "Failed", "signup", "Skipped")))
    return table(spark, d, "events").select(F.dayofmonth("ts").alias("run"), F.col("user_id").alias("entity"), F.col("event_id"), named[F.col("event_type")].alias("status"), "value")


def runs(spark: SparkSession, d: str) -> DataFrame:
    n = lambda x: F.sum((F.col("status") == x).cast("long"))
    return status(spark, d).groupBy("run").agg(n("Failed").alias("failed"), n("Succeeded").alias("succeeded"))


V = """v AS (SELECT o_custkey AS entity, o_orderstatus AS kind, row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderdate, o_orderkey) AS seq,
  CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS received, o_orderpriority = '1-URGENT' AS current, o_totalprice AS amount, o_orderkey AS order_id, o_orderpriority AS priority FROM orders)"""
T = """t AS (SELECT entity, kind, seq, received, current, CASE WHEN kind = 'F' THEN amount + 1 ELSE amount END AS amount, priority = '5-LOW' AS is_deleted
  FROM v WHERE received < '2000-01-01')"""
B = "b AS (SELECT * FROM v WHERE received >= '1996-01-01')"
L = """l AS (SELECT l_orderkey AS order_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) - 1 AS pos, l_partkey AS part, l_quantity AS quantity, l_returnflag AS flag, l_linestatus AS state FROM lineitem)"""
TL = """tl AS (SELECT order_id, pos, part, CASE WHEN state = 'O' THEN quantity + 1 ELSE quantity END AS quantity, flag = 'A' AND state = 'F' AS is_deleted
  FROM l WHERE flag <> 'N')"""
S = """s AS (SELECT day(ts)::INT AS run, user_id AS entity, event_id, CASE event_type WHEN 'view' THEN 'Pending' WHEN 'click' THEN 'InProgress' WHEN 'purchase' THEN 'Succeeded' WHEN 'error' THEN 'Failed' WHEN 'signup' THEN 'Skipped' END AS status, value FROM events)"""
PLAN = f"""{V}, {T}, {B}, p AS (SELECT b.entity, b.kind, b.seq, b.received, b.current, b.amount, CASE WHEN t.is_deleted IS NULL THEN 'insert' WHEN t.is_deleted THEN 'revive'
  WHEN t.received IS DISTINCT FROM b.received OR t.current IS DISTINCT FROM b.current OR t.amount IS DISTINCT FROM b.amount THEN 'update' ELSE 'noop' END AS action
  FROM b LEFT JOIN t USING (entity, kind, seq))"""
CODES_T = "SELECT r_name AS location, n_name AS code, n_nationkey AS sort_order, n_nationkey % 5 = 0 AS is_deleted FROM nation JOIN region ON n_regionkey = r_regionkey"
CODES_B = "SELECT r_name AS location, CASE WHEN n_nationkey % 7 = 3 THEN n_name || '*' ELSE n_name END AS code, n_nationkey + n_nationkey % 2 AS sort_order FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_regionkey < 3 AND n_name NOT LIKE '%1'"


def _plan(spark, d):
    return merge.merge_plan(target(spark, d), batch(spark, d), KEY, VALUES)


def _codes(spark, d, full):
    n = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    t = n.select(F.col("r_name").alias("location"), F.col("n_name").alias("code"), F.col("n_nationkey").alias("sort_order"), F.expr("n_nationkey % 5 = 0").alias("is_deleted"))
    b = n.filter("r_regionkey < 3 and n_name not like '%1'").select(F.col("r_name").alias("location"), F.expr("case when n_nationkey % 7 = 3 then n_name || '*' else n_name end").alias("code"), F.expr("n_nationkey + n_nationkey % 2").alias("sort_order"))
    return merge.code_list_plan(t, b, "location", "code", ["sort_order"], full)


def _arrays(spark, d):
    e = table(spark, d, "events")
    body = F.expr("case event_id % 4 when 0 then null when 1 then concat('[', props) when 2 then props else concat('[', props, ']') end")
    return validate.array_check(e.select("event_id", body.alias("body"))).groupBy("body_state").agg(F.count("*").alias("n"))


def _keys(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("ordinal"), F.expr("nullif(o_custkey % 50, 7)").alias("entity"), F.expr("nullif(o_orderstatus, 'P')").alias("kind"))
    return validate.incomplete_keys(o, ["entity", "kind"], "ordinal")


def _rules(spark, d):
    rules = {"quantity": F.col("l_quantity") > 45, "discount": F.col("l_discount") >= 0.09, "no_tax": F.col("l_tax") == 0}
    return validate.rule_violations(table(spark, d, "lineitem").select("*", F.col("l_orderkey").alias("ordinal")), "ordinal", rules)


def _foreign(spark, d):
    c = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    rows = c.select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("window"), F.when(F.expr("o_orderkey % 3 = 0"), " ").when(F.expr("o_orderkey % 200 = 1"), F.col("n_name")).otherwise(F.lit("MD")).alias("location"))
    return validate.foreign_windows(rows, "window", "location", "MD")


def _order_state(spark, d):
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("order_id"), (F.col("o_orderpriority") == "5-LOW").alias("is_deleted"))


def doomed_orders(spark, d):
    return table(spark, d, "orders").filter("o_orderpriority = '3-MEDIUM' or o_orderstatus = 'F'").select(F.col("o_orderkey").alias("order_id"))


def _cascade(spark, d):
    return merge.soft_delete_cascade(doomed_orders(spark, d), ["order_id"], {"parent": _order_state(spark, d), "lines": target_lines(spark, d)})


def _orphans(spark, d):
    return merge.orphan_children(_order_state(spark, d), target_lines(spark, d), ["order_id"]).select("order_id", "pos")


def _convergence(spark, d):
    t, b = workspace.written(target(spark, d), "target"), workspace.written(batch(spark, d), "batch")
    merged = lambda x, name: workspace.written(merge.apply_plan(x, workspace.written(merge.merge_plan(x, b, KEY, VALUES), "plan"), KEY, VALUES), name)
    once = merged(t, "once")
    twice = merged(once, "twice")
    first = merge.converged(t, once).select(F.lit("first run").alias("step"), "side", "n")
    return first.unionByName(merge.converged(once, twice).select(F.lit("second run").alias("step"), "side", "n"))


def _windows(spark, d):
    e = table(spark, d, "events").select("event_type", F.to_date("ts").alias("day"))
    w = load_plan.split_windows(spark, "2024-01-01", "2024-01-30", 7)
    seen = e.join(F.broadcast(w), F.col("day").between(F.col("window_start"), F.col("window_end"))).groupBy("event_type", "window_start", "window_end").agg(F.count("*").alias("n"))
    return load_plan.coverage(seen.withColumn("walked", F.col("n") % 5 != 0), "event_type").withColumn("covered_to", F.col("covered_to").cast("string"))


def _first_seen(spark, d):
    e = table(spark, d, "events")
    a = load_plan.assigned(e, "ts", "2024-01-01", 7, ["user_id", "event_type"], ["ts", "event_id"])
    return a.groupBy(F.col("window_start").cast("string").alias("window_start")).agg(F.count("*").alias("summaries"), F.sum(F.col("first_seen").cast("long")).alias("new_versions"))


def _resume(spark, d):
    s = status(spark, d)
    own = lambda x, c: s.filter(F.col("status") == x).filter(c).select("entity").distinct()
    return load_plan.resume_plan(own("Pending", "run <= 20"), own("Succeeded", "run <= 3"), own("Failed", "run <= 2"), ["entity"])


def _walk(spark, d):
    return shred.profile(bodies(spark, d)).select("path", "key", "depth", "n", "docs")


def _shapes(spark, d):
    o = table(spark, d, "orders")
    raw = F.when(F.expr("o_orderkey % 3 = 0"), F.date_format("o_orderdate", "yyyy-MM-dd")).when(F.expr("o_orderkey % 3 = 1"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise(F.col("o_orderpriority"))
    return o.select(shape_mask(raw).alias("shape"), lenient_date(raw).isNotNull().alias("readable")).groupBy("shape", "readable").agg(F.count("*").alias("n"))


def _attempts(spark, d):
    s = status(spark, d)
    known, recorded = s.filter("status = 'Pending' and run < 15"), s.filter("status = 'Failed'")
    numbered = lambda x: x.select("entity", F.col("run").alias("attempt")).distinct()
    return journal.append_attempts(known.select("entity"), numbered(s), numbered(recorded), ["entity"], "attempt")


def _stranded(spark, d):
    r = runs(spark, d).select("run", F.when(F.col("run") % 4 == 0, "Running").when(F.col("failed") > F.col("succeeded"), "Failed").otherwise("Succeeded").alias("run_status"))
    return journal.stranded(status(spark, d), r, "run").groupBy("run", "run_status").agg(F.count("*").alias("n"))


def _page(spark, d):
    v = current.authority(versions(spark, d), PAIR).filter("is_current")
    allowed = ("entity", "kind", "seq", "received", "amount", "priority")
    found = reads.page(v, "amount", allowed, KEY, True, 10, 50, {"kind": "O", "priority": None}, {"received": ("1996-01-01", "2000-12-31")}, total=True)
    return found.select("entity", "kind", "seq", "amount", "total_rows")


def _search(spark, d):
    ident = F.concat(F.lit("MD"), F.lpad(F.col("p_partkey").cast("string"), 6, "0")).alias("ident")
    c = table(spark, d, "part").select(F.col("p_partkey").alias("id"), ident, "p_name", "p_type")
    return reads.search(c, " re ", "ident", "p_name", "p_type", "id", 5, 100).select("id", "match_rank", "match_field", "total_rows")


def _probe(spark, d):
    v = versions(spark, d)
    return v.groupBy("entity").agg(F.count("*").alias("versions"), F.max("seq").alias("deepest"), F.sum(F.col("current").cast("long")).alias("currents")).filter("versions > 1")


def _children_per_version(spark, d):
    return lines(spark, d).groupBy("order_id").agg(F.count("*").alias("lines"), F.max("pos").alias("last_pos"))


def _absent_but_stored(spark, d):
    """Of the orders in status P none sends its lines; all orders of the batch send their type."""
    sent_ = sent(spark, d).filter("not sent").select("order_id", F.col("sent").alias("lines"), F.lit(True).alias("state"))
    return quality.collections_absent(sent_, {"lines": target_lines(spark, d), "state": _order_state(spark, d)}, ["order_id"])


def _unknown_codes(spark, d):
    c = table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("code"))
    known = table(spark, d, "nation").filter("n_regionkey <> 0").select(F.col("n_nationkey").alias("code"))
    return c.join(known, "code", "left_anti").groupBy("code").agg(F.count("*").alias("n"))


def _presence(spark, d):
    p = shred.presence(nested(spark, d), ["order_id"], "$.handler.lines")
    return p.groupBy("sent", (F.col("n_sent") > 0).alias("populated")).agg(F.count("*").alias("n"))


def _children(spark, d):
    g = lambda p, t: F.variant_get("element", p, t)
    return shred.children(nested(spark, d), ["order_id"], "$.handler.lines").select("order_id", "pos", g("$.part", "bigint").alias("part"), g("$.quantity", "double").alias("quantity"))


def _folded(spark, d):
    return journal.fold(status(spark, d), ["entity"], "status", "event_id").select("entity", "status", "run", "event_id")


def _parents(spark, d):
    return shred.parents(payloads(spark, d), ORDER_MAP)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "b1_array_check": _arrays,
    "b2_key_completeness": _keys,
    "b4_duplicate_keys": lambda s, d: validate.duplicate_keys(table(s, d, "lineitem"), ["l_orderkey", "l_linenumber"]),
    "b5_width_violations": lambda s, d: validate.too_wide(table(s, d, "part"), ["p_partkey"], {"p_name": 8, "p_type": 5, "p_brand": 7}),
    "b6_closed_sets": lambda s, d: validate.outside_sets(table(s, d, "events"), {"event_type": ["view", "click", "error"]}),
    "b8_foreign_windows": _foreign,
    "b14_rule_runner": _rules,
    "c1_parent_shred": _parents,
    "c2_child_explode": _children,
    "c5_presence_gate": _presence,
    "d1_merge_plan": _plan,
    "d3_child_merge": lambda s, d: merge.child_merge(target_lines(s, d), batch_lines(s, d), sent(s, d), ["order_id"], ["part", "quantity"]),
    "d7_merge_counters": lambda s, d: merge.merge_counters(_plan(s, d)),
    "d8_status_closeout": lambda s, d: merge.status_closeout(batch(s, d).select(*KEY), _plan(s, d), KEY),
    "d9_code_upsert": lambda s, d: _codes(s, d, False),
    "d10_code_full": lambda s, d: _codes(s, d, True),
    "d11_retirement_guard": lambda s, d: merge.retirement_guard(_codes(s, d, True)),
    "d13_cascade": _cascade,
    "d16_authority": lambda s, d: current.authority(versions(s, d), PAIR).select(*KEY, "is_current"),
    "d18_unlisted": lambda s, d: current.unlisted(versions(s, d), batch(s, d), PAIR).select(*KEY),
    "d21_journal_fold": _folded,
    "d22_attempt_append": _attempts,
    "d24_stranded": _stranded,
    "e2_current_view": lambda s, d: reads.current_view(current.authority(target(s, d), PAIR)).select(*KEY),
    "e3_page": _page,
    "e4_history_page": lambda s, d: reads.history_page(versions(s, d), "entity", 7).select(*KEY, "total_rows"),
    "e7_latest_only": lambda s, d: journal.latest_only(status(s, d), ["entity"], "run").select("entity", "run", "event_id"),
    "e9_search": _search,
    "e11_run_summary": lambda s, d: journal.run_summary(status(s, d), "run", "entity"),
    "f2_first_seen": _first_seen,
    "f4_coverage": _windows,
    "f5_resume_plan": _resume,
    "g1_summary_probe": _probe,
    "g2_version_choice": lambda s, d: current.newest(versions(s, d), "entity").select(*KEY),
    "g3_json_walk": _walk,
    "g4_shape_mask": _shapes,
    "h1_absent_but_stored": _absent_but_stored,
    "h2_ambiguous_in_source": lambda s, d: current.ambiguous(versions(s, d), PAIR),
    "h5_without_current": lambda s, d: current.without_current(versions(s, d), "entity"),
    "h9_unknown_codes": _unknown_codes,
    "i1_flags_by_lineage": lambda s, d: current.flags_by_lineage(versions(s, d), PAIR),
    "i2_density": lambda s, d: current.density(target(s, d).filter("not is_deleted"), PAIR),
    "i5_children_per_version": _children_per_version,
    "i9_orphans": _orphans,
    "i11_convergence": _convergence,
}

AUTHORITY = "coalesce(current, false) AND row_number() OVER (PARTITION BY entity, kind, current ORDER BY received DESC NULLS LAST, seq DESC) = 1 AS is_current"
RUNS = f"{S}, r AS (SELECT run, count(*) FILTER (status = 'Failed') AS failed, count(*) FILTER (status = 'Succeeded') AS succeeded FROM s GROUP BY run)"
CODES = f"t AS ({CODES_T}), b AS ({CODES_B}), p AS (SELECT b.location, b.code, CASE WHEN t.is_deleted IS NULL THEN 'insert' WHEN t.is_deleted THEN 'revive' WHEN t.sort_order IS DISTINCT FROM b.sort_order THEN 'update' ELSE 'noop' END AS action FROM b LEFT JOIN t USING (location, code))"
FULL = f"{CODES}, f AS (SELECT * FROM p UNION ALL SELECT location, code, 'retire' FROM t WHERE NOT is_deleted AND location IN (SELECT location FROM b) AND NOT EXISTS (SELECT 1 FROM b WHERE b.location = t.location AND b.code = t.code))"

ORACLE_SQL: dict[str, str] = {
    "b1_array_check": "SELECT CASE event_id % 4 WHEN 0 THEN 'missing' WHEN 1 THEN 'malformed' WHEN 2 THEN 'not_array' ELSE 'array' END AS body_state, count(*) AS n FROM events GROUP BY 1",
    "b2_key_completeness": "SELECT 'entity' AS key_part, count(*) AS n, min(o_orderkey) AS first_ordinal FROM orders WHERE o_custkey % 50 = 7 HAVING count(*) > 0 UNION ALL SELECT 'kind', count(*), min(o_orderkey) FROM orders WHERE o_orderstatus = 'P' HAVING count(*) > 0",
    "b4_duplicate_keys": "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
    "b5_width_violations": " UNION ALL ".join(f"SELECT p_partkey, '{c}' AS \"column\", length(rtrim({c}))::INT AS length, {w} AS width FROM part WHERE length(rtrim({c})) > {w}" for c, w in (("p_name", 8), ("p_type", 5), ("p_brand", 7))),
    "b6_closed_sets": "SELECT 'event_type' AS \"column\", event_type AS value, count(*) AS n FROM events WHERE event_type NOT IN ('view', 'click', 'error') GROUP BY 2",
    "b8_foreign_windows": "SELECT strftime(o_orderdate, '%Y-%m-%d') AS \"window\", count(*) AS \"foreign\" FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE o_orderkey % 3 <> 0 AND o_orderkey % 200 = 1 AND upper(trim(n_name)) <> 'MD' GROUP BY 1",
    "b14_rule_runner": " UNION ALL ".join(f"SELECT '{n}' AS rule, count(*) AS n, min(l_orderkey) AS first_ordinal FROM lineitem WHERE {c} HAVING count(*) > 0" for n, c in (("quantity", "l_quantity > 45"), ("discount", "l_discount >= 0.09"), ("no_tax", "l_tax = 0"))),
    "c1_parent_shred": "SELECT o_orderkey AS order_id, o_orderstatus AS kind, o_totalprice AS amount, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority = '1-URGENT' END AS current, strftime(o_orderdate, '%Y-%m-%d') AS received FROM orders",
    "c2_child_explode": f"WITH {L} SELECT order_id, pos, part, quantity FROM l JOIN orders ON o_orderkey = order_id",
    "c5_presence_gate": "SELECT o_orderstatus <> 'P' OR x AS sent, x AS populated, count(*) AS n FROM (SELECT *, o_orderkey IN (SELECT l_orderkey FROM lineitem) AS x FROM orders) GROUP BY 1, 2",
    "d1_merge_plan": f"WITH {PLAN} SELECT * FROM p",
    "d3_child_merge": f"""WITH {L}, {TL}, b AS (SELECT l.* FROM l JOIN orders ON o_orderkey = order_id WHERE flag <> 'R' AND o_orderstatus <> 'P'), t AS (SELECT tl.*, o_orderstatus <> 'P' AS sent FROM tl JOIN orders ON o_orderkey = order_id)
      SELECT coalesce(b.order_id, t.order_id) AS order_id, coalesce(b.pos, t.pos) AS pos, CASE WHEN t.pos IS NULL THEN 'insert' WHEN b.pos IS NOT NULL AND t.is_deleted THEN 'revive'
        WHEN b.pos IS NOT NULL AND (t.part IS DISTINCT FROM b.part OR t.quantity IS DISTINCT FROM b.quantity) THEN 'update' WHEN b.pos IS NOT NULL THEN 'noop'
        WHEN t.sent AND NOT t.is_deleted THEN 'retire' ELSE 'noop' END AS action FROM t FULL JOIN b ON t.order_id = b.order_id AND t.pos = b.pos""",
    "d7_merge_counters": f"WITH {PLAN} SELECT " + ", ".join(f"count(*) FILTER (action = '{a}') AS \"{a}\"" for a in ("insert", "update", "revive", "noop")) + ", count(*) AS total FROM p",
    "d8_status_closeout": f"WITH {PLAN} SELECT entity, kind, seq, 'Succeeded' AS status, CASE action WHEN 'insert' THEN 'Inserted' WHEN 'noop' THEN 'Unchanged' ELSE 'Updated' END AS outcome FROM p",
    "d9_code_upsert": f"WITH {CODES} SELECT * FROM p",
    "d10_code_full": f"WITH {FULL} SELECT * FROM f",
    "d11_retirement_guard": f"WITH {FULL} SELECT count(*) FILTER (action <> 'retire') AS supplied, count(*) FILTER (action = 'retire') AS retired, count(*) FILTER (action = 'retire') > count(*) FILTER (action <> 'retire') AS refused FROM f",
    "d13_cascade": f"""WITH {L}, {TL}, x AS (SELECT * FROM orders WHERE o_orderpriority = '3-MEDIUM' OR o_orderstatus = 'F')
      SELECT 'parent' AS "table", count(*) AS rows FROM x WHERE o_orderpriority <> '5-LOW' UNION ALL SELECT 'lines', count(*) FROM tl WHERE NOT is_deleted AND order_id IN (SELECT o_orderkey FROM x)""",
    "d16_authority": f"WITH {V} SELECT entity, kind, seq, {AUTHORITY} FROM v",
    "d18_unlisted": f"WITH {V}, x AS (SELECT * FROM v WHERE received >= '1996-01-01') SELECT entity, kind, seq FROM v WHERE (entity, kind) IN (SELECT entity, kind FROM x) AND NOT EXISTS (SELECT 1 FROM x WHERE x.entity = v.entity AND x.kind = v.kind AND x.seq = v.seq)",
    "d21_journal_fold": f"WITH {S} SELECT entity, status, arg_max(run, event_id) AS run, max(event_id) AS event_id FROM s GROUP BY 1, 2",
    "d22_attempt_append": f"WITH {S}, a AS (SELECT DISTINCT entity, run AS attempt FROM s), k AS (SELECT * FROM a WHERE entity IN (SELECT entity FROM s WHERE status = 'Pending' AND run < 15)) SELECT (SELECT count(*) FROM k WHERE (entity, attempt) NOT IN (SELECT (entity, run) FROM s WHERE status = 'Failed')) AS written, (SELECT count(*) FROM k WHERE (entity, attempt) IN (SELECT (entity, run) FROM s WHERE status = 'Failed')) AS already_recorded, (SELECT count(*) FROM a) - (SELECT count(*) FROM k) AS orphaned",
    "d24_stranded": f"WITH {RUNS}, q AS (SELECT run, CASE WHEN run % 4 = 0 THEN 'Running' WHEN failed > succeeded THEN 'Failed' ELSE 'Succeeded' END AS run_status FROM r) SELECT run, run_status, count(*) AS n FROM s JOIN q USING (run) WHERE status IN ('Pending', 'InProgress') AND run_status <> 'Running' GROUP BY 1, 2",
    "e2_current_view": f"WITH {V}, {T}, a AS (SELECT *, {AUTHORITY} FROM t) SELECT entity, kind, seq FROM a WHERE NOT is_deleted AND is_current",
    "e3_page": f"WITH {V}, a AS (SELECT *, {AUTHORITY} FROM v) SELECT entity, kind, seq, amount, count(*) OVER () AS total_rows FROM a WHERE is_current AND kind = 'O' AND received BETWEEN '1996-01-01' AND '2000-12-31' ORDER BY amount DESC NULLS LAST, entity, kind, seq LIMIT 50 OFFSET 10",
    "e4_history_page": f"WITH {V} SELECT entity, kind, seq, count(*) OVER () AS total_rows FROM v WHERE entity = 7 ORDER BY received DESC NULLS LAST, kind, seq LIMIT 50",
    "e7_latest_only": f"WITH {S} SELECT entity, run, event_id FROM s WHERE NOT EXISTS (SELECT 1 FROM s x WHERE x.entity = s.entity AND x.run > s.run)",
    "e9_search": """WITH c AS (SELECT p_partkey AS id, 'md' || lpad(p_partkey::VARCHAR, 6, '0') AS i, lower(p_name) AS n, lower(p_type) AS p, p_name FROM part),
      r AS (SELECT id, p_name, CASE WHEN i = 're' THEN 1 WHEN starts_with(i, 're') THEN 2 WHEN contains(i, 're') THEN 3 WHEN starts_with(n, 're') THEN 4 WHEN contains(n, 're') THEN 5 WHEN starts_with(p, 're') THEN 6 ELSE 7 END AS match_rank
        FROM c WHERE contains(i, 're') OR contains(n, 're') OR contains(p, 're'))
      SELECT id, match_rank, CASE WHEN match_rank <= 3 THEN 'id' WHEN match_rank <= 5 THEN 'name' ELSE 'place' END AS match_field, count(*) OVER () AS total_rows FROM r ORDER BY match_rank, p_name NULLS FIRST, id LIMIT 100 OFFSET 5""",
    "e11_run_summary": f"WITH {S} SELECT run, count(*) AS rows, count(DISTINCT entity) AS entities, " + ", ".join(f"count(*) FILTER (status = '{x}') AS {x.lower()}" for x in ("Pending", "InProgress", "Succeeded", "Failed", "Skipped")) + " FROM s GROUP BY run",
    "f2_first_seen": "WITH a AS (SELECT DATE '2024-01-01' + (date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) // 7 * 7)::INT AS w, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS k FROM events) SELECT CAST(w AS VARCHAR) AS window_start, count(*) AS summaries, count(*) FILTER (k = 1) AS new_versions FROM a GROUP BY 1",
    "f4_coverage": """WITH w AS (SELECT event_type, date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) // 7 AS k, count(*) % 5 <> 0 AS walked FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-01' AND DATE '2024-01-30' GROUP BY 1, 2),
      u AS (SELECT *, min(walked::INT) OVER (PARTITION BY event_type ORDER BY k) AS ok FROM w) SELECT event_type, CAST(max(CASE WHEN ok = 1 THEN least(DATE '2024-01-01' + (k * 7 + 6)::INT, DATE '2024-01-30') END) AS VARCHAR) AS covered_to FROM u GROUP BY 1""",
    "f5_resume_plan": f"""WITH {S}, w AS (SELECT DISTINCT entity FROM s WHERE status = 'Pending' AND run <= 20), c AS (SELECT DISTINCT entity FROM s WHERE status = 'Succeeded' AND run <= 3), u AS (SELECT DISTINCT entity FROM s WHERE status = 'Failed' AND run <= 2)
      SELECT 'fetch' AS decision, entity FROM (FROM w EXCEPT FROM c) UNION ALL SELECT 'skip', entity FROM (FROM w INTERSECT FROM c) UNION ALL SELECT 'vanished', entity FROM ((FROM c UNION FROM u) EXCEPT FROM w)""",
    "g1_summary_probe": f"WITH {V} SELECT entity, count(*) AS versions, max(seq) AS deepest, count(*) FILTER (current) AS currents FROM v GROUP BY entity HAVING count(*) > 1",
    "g2_version_choice": f"WITH {V} SELECT entity, kind, seq FROM v QUALIFY row_number() OVER (PARTITION BY entity ORDER BY coalesce(current, false) DESC, received DESC NULLS LAST, seq DESC, kind) = 1",
    "g3_json_walk": f"""WITH {L}, o AS (SELECT o_orderkey AS k, o_orderstatus AS kind FROM orders), n AS (SELECT order_id FROM l JOIN o ON k = order_id)
      SELECT '$.handler' AS path, 'handler' AS key, 1 AS depth, count(*) AS n, count(*) AS docs FROM o UNION ALL SELECT '$.handler.id', 'id', 2, count(*), count(*) FROM o
      UNION ALL SELECT '$.handler.lines', 'lines', 2, count(*), count(*) FROM o WHERE kind <> 'P' OR k IN (SELECT order_id FROM l)
      UNION ALL SELECT '$.handler.lines[].' || x, x, 4, count(*), count(DISTINCT order_id) FROM n, (SELECT unnest(['pos', 'part', 'quantity']) AS x) GROUP BY x""",
    "g4_shape_mask": "SELECT CASE o_orderkey % 3 WHEN 0 THEN '\"yyyy-MM-dd\"' WHEN 1 THEN '\"yyyy-MM-ddTHH:mm:ssZ\"' ELSE 'text(len=' || length(o_orderpriority) || ')' END AS shape, o_orderkey % 3 <> 2 AS readable, count(*) AS n FROM orders GROUP BY 1, 2",
    "h1_absent_but_stored": f"WITH {L}, {TL} SELECT 'lines' AS collection, count(*) AS stored FROM tl JOIN orders ON o_orderkey = order_id WHERE o_orderstatus = 'P' AND NOT is_deleted",
    "h2_ambiguous_in_source": f"""WITH {V} SELECT entity, kind, count(*) AS claims, arg_max(seq, (coalesce(received, ''), seq)) AS winner, string_agg(seq || '@' || coalesce(received, '(none)'), ',' ORDER BY seq) AS listed
      FROM v WHERE current GROUP BY 1, 2 HAVING count(*) > 1""",
    "h5_without_current": f"WITH {V} SELECT entity, count(*) AS versions FROM v GROUP BY 1 HAVING NOT bool_or(current)",
    "h9_unknown_codes": "SELECT c_nationkey AS code, count(*) AS n FROM customer WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey <> 0) GROUP BY 1",
    "i1_flags_by_lineage": f"WITH {V}, c AS (SELECT entity, kind, count(*) FILTER (current) AS n FROM v GROUP BY 1, 2) SELECT kind, count(*) FILTER (n = 0) AS \"none\", count(*) FILTER (n = 1) AS \"one\", count(*) FILTER (n > 1) AS \"many\" FROM c GROUP BY kind",
    "i2_density": f"WITH {V}, {T}, c AS (SELECT min(seq) AS lo, max(seq) AS hi, count(DISTINCT seq) AS n FROM t WHERE NOT is_deleted GROUP BY entity, kind) SELECT CASE WHEN hi - lo + 1 <> n THEN 'gaps' WHEN lo = 1 THEN 'dense from 1' ELSE 'dense' END AS density, count(*) AS lineages FROM c GROUP BY 1",
    "i5_children_per_version": f"WITH {L} SELECT order_id, count(*) AS lines, max(pos) AS last_pos FROM l GROUP BY 1",
    "i9_orphans": f"WITH {L}, {TL} SELECT order_id, pos FROM tl WHERE NOT is_deleted AND order_id IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '5-LOW')",
    "i11_convergence": f"""WITH {PLAN}, one AS (SELECT * FROM t WHERE (entity, kind, seq) NOT IN (SELECT (entity, kind, seq) FROM p WHERE action <> 'noop') UNION ALL SELECT entity, kind, seq, received, current, amount, false FROM p WHERE action <> 'noop'),
      q AS (SELECT b.* FROM b LEFT JOIN one o USING (entity, kind, seq) WHERE o.is_deleted IS NULL OR o.is_deleted OR o.received IS DISTINCT FROM b.received OR o.current IS DISTINCT FROM b.current OR o.amount IS DISTINCT FROM b.amount),
      two AS (SELECT * FROM one WHERE (entity, kind, seq) NOT IN (SELECT (entity, kind, seq) FROM q) UNION ALL SELECT entity, kind, seq, received, current, amount, false FROM q)
      SELECT * FROM (SELECT 'first run' AS step, 'lost' AS side, count(*) AS n FROM (FROM t EXCEPT ALL FROM one) UNION ALL SELECT 'first run', 'gained', count(*) FROM (FROM one EXCEPT ALL FROM t)
        UNION ALL SELECT 'second run', 'lost', count(*) FROM (FROM one EXCEPT ALL FROM two) UNION ALL SELECT 'second run', 'gained', count(*) FROM (FROM two EXCEPT ALL FROM one)) WHERE n > 0""",
}
