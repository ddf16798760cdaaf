"""Registered queries of the load core, the journal, planning, reads, probes and reports, each beside its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.functions.columns import lenient_boolean, lenient_date, lenient_timestamp, payload_hash
from palimpsest.operators import current, journal, merge, probe, quality, reads, rules, runs, shred, validate
from palimpsest.plans import load_plan
from palimpsest.plans.queries import KEY, LINE, PAIR, L, T, TL, V, batch, doomed_orders, lines, table, target, target_lines, versions
from palimpsest.sources import json_bodies

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str):
    def register(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__], ORACLE_SQL[f.__name__] = f, sql
        return f

    return register


def _sql_rules(table_sql: str, ordinal: str, named: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS rule, count(*) AS n, min({ordinal}) AS first_ordinal FROM {table_sql} WHERE {c} HAVING count(*) > 0" for n, c in named.items())


# ---- status, attempt, observation and run tables from events, and the same in SQL ------------------

STATUS_OF = {"view": "Pending", "click": "InProgress", "purchase": "Succeeded", "error": "Failed", "signup": "Skipped"}
ATTEMPT_OF = {"purchase": "Succeeded", "error": "Failed", "click": "Throttled", "signup": "TimedOut", "view": "Cancelled"}
SEVERITY_OF = {"error": "Error", "click": "Warning", "view": "Info", "purchase": "Info", "signup": "Info"}
HTTP_OF = {"purchase": 200, "error": 503, "click": 429}


def _case(of: dict) -> str:
    return "CASE event_type " + " ".join(f"WHEN '{k}' THEN {v!r}" for k, v in of.items()) + " END"


_RUN, _OUTCOME = "day(ts) * 24 + hour(ts)", "CASE WHEN event_type = 'purchase' THEN CASE WHEN value < 20 THEN 'Inserted' WHEN value < 45 THEN 'Updated' WHEN value < 100 THEN 'Unchanged' ELSE 'SoftDeleted' END END"


def status(s: SparkSession, d: str) -> DataFrame:
    """One row per event: the hour is the run, the user the entity, the type the status."""
    e = table(s, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    seconds = F.unix_seconds("ts")
    return e.select(
        F.col("event_id").alias("status_id"),
        F.expr(f"cast({_RUN} as bigint)").alias("run"),
        F.col("user_id").alias("entity"),
        F.col("event_id").alias("seq"),
        F.expr(_case(STATUS_OF)).alias("status"),
        F.expr(_OUTCOME).alias("outcome"),
        F.expr("cast(1 + floor(value / 50) as bigint)").alias("attempts"),
        F.expr("case when event_type <> 'view' then cast(floor(value * 10) as bigint) end").alias("duration"),
        F.expr(_case(HTTP_OF)).alias("http"),
        seconds.alias("first_seen"),
        F.when(F.col("event_type").isin("purchase", "error"), seconds + 60).alias("completed"),
        (F.col("value") > 150).alias("is_deleted"),
        F.when((F.col("event_type") == "error") & (F.col("value") < 40), F.col("event_id")).alias("execution_log"),
        "value",
        "ts",
    )


def attempts(s: SparkSession, d: str) -> DataFrame:
    e = table(s, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    whole = lambda x: f"cast(floor({x}) as bigint)"
    return e.select(
        F.expr(f"cast({_RUN} as bigint)").alias("run"),
        F.col("user_id").alias("entity"),
        F.expr(whole("1 + value / 50")).alias("attempt"),
        F.expr(_case(ATTEMPT_OF)).alias("outcome"),
        F.expr(_case(HTTP_OF)).alias("http"),
        F.expr(whole("value * 100")).alias("bytes"),
        F.expr(f"case when event_type = 'click' then {whole('value')} end").alias("retry_after"),
        (F.col("value") > 170).alias("is_deleted"),
    )


def observations(s: SparkSession, d: str) -> DataFrame:
    e = table(s, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return e.select(F.expr(f"cast({_RUN} as bigint)").alias("run"), F.col("user_id").alias("entity"), F.expr(_case(SEVERITY_OF)).alias("severity"), F.col("event_type").alias("type"), (F.col("value") > 160).alias("is_deleted"))


def run_table(s: SparkSession, d: str) -> DataFrame:
    n = lambda c, name: F.sum(c.cast("long")).alias(name)
    is_ = lambda c, v: F.coalesce(F.col(c) == v, F.lit(False))
    r = status(s, d).groupBy("run").agg(
        n(is_("status", "Failed"), "failed"),
        n(is_("status", "Skipped"), "skipped"),
        *(n(is_("outcome", o), name) for o, name in (("Inserted", "inserted"), ("Updated", "updated"), ("Unchanged", "unchanged"), ("SoftDeleted", "soft_deleted"))),
        F.count("*").alias("enumerated"),
        F.min("ts").alias("started"),
        F.max("value").alias("top"),
    )
    state = F.expr("case when failed > enumerated / 4 then 'Failed' when failed > enumerated / 5 then 'PartiallySucceeded' when skipped > enumerated / 4 then 'Running' else 'Succeeded' end")
    return r.withColumns(
        {
            "inserted": F.col("inserted") + (F.col("top") > 200).cast("long"),  # a loader that counts wrong
            "run_status": state,
            "status": state,
            "location": F.expr("case when started < timestamp'2024-01-16' then 'MD' else 'VA' end"),
            "mode": F.expr("case when top < 120 then 'Targeted' else 'Incremental' end"),
            "completed": F.when(state != "Running", F.col("started")),
            "message": F.when(F.col("top") > 130, F.lit("stopped")),
        }
    )


ST = f"""st AS (SELECT event_id AS status_id, ({_RUN})::BIGINT AS run, user_id AS entity, event_id AS seq, {_case(STATUS_OF)} AS status, {_OUTCOME} AS outcome, (1 + floor(value / 50))::BIGINT AS attempts,
  CASE WHEN event_type <> 'view' THEN floor(value * 10)::BIGINT END AS duration, {_case(HTTP_OF)} AS http, floor(epoch(ts))::BIGINT AS first_seen,
  CASE WHEN event_type IN ('purchase', 'error') THEN floor(epoch(ts))::BIGINT + 60 END AS completed, value > 150 AS is_deleted, CASE WHEN event_type = 'error' AND value < 40 THEN event_id END AS execution_log, value, ts FROM events)"""
AT = f"""att AS (SELECT ({_RUN})::BIGINT AS run, user_id AS entity, floor(1 + value / 50)::BIGINT AS attempt, {_case(ATTEMPT_OF)} AS outcome, {_case(HTTP_OF)} AS http, floor(value * 100)::BIGINT AS bytes,
  CASE WHEN event_type = 'click' THEN floor(value)::BIGINT END AS retry_after, value > 170 AS is_deleted FROM events)"""
OB = f"ob AS (SELECT ({_RUN})::BIGINT AS run, user_id AS entity, {_case(SEVERITY_OF)} AS severity, event_type AS type, value > 160 AS is_deleted FROM events)"
_N = lambda c, v: f"count(*) FILTER ({c} = '{v}')"
RN = f"""{ST}, rn0 AS (SELECT run, {_N('status', 'Failed')} AS failed, {_N('status', 'Skipped')} AS skipped, {_N('outcome', 'Inserted')} AS inserted0, {_N('outcome', 'Updated')} AS updated,
  {_N('outcome', 'Unchanged')} AS unchanged, {_N('outcome', 'SoftDeleted')} AS soft_deleted, count(*) AS enumerated, min(ts) AS started, max(value) AS top FROM st GROUP BY run),
  rn1 AS (SELECT *, inserted0 + (top > 200)::BIGINT AS inserted, CASE WHEN failed > enumerated / 4 THEN 'Failed' WHEN failed > enumerated / 5 THEN 'PartiallySucceeded' WHEN skipped > enumerated / 4 THEN 'Running' ELSE 'Succeeded' END AS status,
    CASE WHEN started < TIMESTAMP '2024-01-16' THEN 'MD' ELSE 'VA' END AS location, CASE WHEN top < 120 THEN 'Targeted' ELSE 'Incremental' END AS mode, CASE WHEN top > 130 THEN 'stopped' END AS message FROM rn0),
  rn AS (SELECT *, status AS run_status, CASE WHEN status <> 'Running' THEN started END AS completed FROM rn1)"""
NOW = "2024-01-28 00:00:00"


def _now():
    return F.lit(NOW).cast("timestamp")


# ---- sources and rules -----------------------------------------------------------------------------


@query(f"""WITH {V} SELECT entity::VARCHAR AS path, (row_number() OVER (PARTITION BY entity ORDER BY kind, seq) - 1)::INT AS pos, entity::VARCHAR AS handler_id, kind AS source_type, seq::INT AS sequence, current, received FROM v""")
def a2_summaries(s, d):
    each = F.struct(F.col("entity").cast("string").alias("handlerId"), F.col("kind").alias("sourceType"), F.col("seq").alias("sequence"), F.col("current").alias("currentRecord"), F.col("received").alias("receivedDate"))
    found = versions(s, d).groupBy(F.col("entity").cast("string").alias("path")).agg(F.to_json(F.array_sort(F.collect_list(each))).alias("body"))
    return json_bodies.summaries(found)


@query("SELECT r_name AS list_name, (row_number() OVER (PARTITION BY r_name ORDER BY n_name) - 1)::INT AS pos, r_name AS location, n_name AS code, 'nation ' || n_name AS description, n_regionkey <> 0 AS active FROM nation JOIN region ON n_regionkey = r_regionkey")
def a3_code_lists(s, d):
    n = table(s, d, "nation").join(table(s, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    each = F.struct(F.col("n_name").alias("code"), F.col("r_name").alias("activityLocation"), F.concat(F.lit("nation "), "n_name").alias("description"), (F.col("n_regionkey") != 0).alias("active"))
    found = n.groupBy("r_name").agg(F.to_json(F.array_sort(F.collect_list(each))).alias("body"))
    return json_bodies.code_list(found.select(F.concat(F.lit("lists/"), "r_name", F.lit(".json")).alias("path"), "body"))


@query(r"SELECT p_partkey, p_name AS body, upper(sha256(unhex(regexp_replace(hex(encode(p_name)), '(..)', '\100', 'g')))) AS payload_sha256 FROM part")
def a5_raw_store(s, d):
    return json_bodies.raw_store(table(s, d, "part"), ["p_partkey"], "p_name").withColumnRenamed("p_name", "body")


@query("SELECT o_custkey AS entity, count(*) AS foreign_rows FROM orders WHERE o_totalprice > 300000 GROUP BY 1")
def b9_foreign_entities(s, d):
    named = F.when(F.col("o_totalprice") > 300_000, F.col("o_custkey") + 1).otherwise(F.col("o_custkey"))
    return validate.foreign_entities(table(s, d, "orders").select(F.col("o_custkey").alias("entity"), named.alias("named")), "entity", "named")


@query(f"WITH {L} SELECT x AS key, count(*) AS n FROM l JOIN orders ON o_orderkey = order_id, (SELECT unnest(['part', 'quantity']) AS x) GROUP BY 1")
def b10_unexpected_properties(s, d):
    from palimpsest.plans.queries import bodies

    return validate.unexpected(shred.walk(bodies(s, d), ["order_id"]), ["Handler", "ID", "lines", "pos"])


@query(
    _sql_rules(
        "orders",
        "o_orderkey",
        {"handler_missing": "o_custkey = 7", "key_too_wide": "o_orderpriority = '1-URGENT'", "sequence_negative": "o_totalprice > 400000"},
    )
)
def b11_summary_rules(s, d):
    o = table(s, d, "orders").select(
        F.col("o_orderkey").alias("ordinal"),
        F.expr("nullif(cast(o_custkey as string), '7')").alias("handler_id"),
        F.expr("case when o_orderpriority = '1-URGENT' then concat(o_orderstatus, '+') else o_orderstatus end").alias("source_type"),
        F.expr("case when o_totalprice > 400000 then -1 else 1 end").alias("sequence"),
    )
    return validate.rule_violations(o, "ordinal", rules.summary_rules())


_FLAG = "CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'TRUE' WHEN '2' THEN '0' WHEN '3' THEN 'yes' WHEN '4' THEN ' 1 ' END"


@query(f"SELECT flag, CASE WHEN trim(flag) IN ('TRUE', '1') THEN true WHEN flag = '0' THEN false END AS readable, count(*) AS n FROM (SELECT {_FLAG} AS flag FROM orders) GROUP BY 1, 2")
def c7_lenient_boolean(s, d):
    o = table(s, d, "orders").select(F.expr(_FLAG).alias("flag"))
    return o.groupBy("flag", lenient_boolean(F.col("flag")).alias("readable")).agg(F.count("*").alias("n"))


@query(f"SELECT 'flag' AS \"column\", flag AS value, count(*) AS n FROM (SELECT {_FLAG} AS flag FROM orders) WHERE flag IS NULL OR flag = 'yes' GROUP BY 2")
def b12_unreadable_flags(s, d):
    return validate.unreadable(table(s, d, "orders").select(F.expr(_FLAG).alias("flag")), {"flag": lenient_boolean(F.col("flag"))})


@query(
    "SELECT 'Attempt' AS mode, x.* FROM (" + _sql_rules("events", "event_id", {"attempt_unusable": "value < 2"}) + ") x UNION ALL SELECT 'Fail', x.* FROM ("
    + _sql_rules("events", "event_id", {"no_detail": "event_type IN ('view', 'signup')"}) + ") x UNION ALL SELECT 'Enumerate', x.* FROM (" + _sql_rules("events", "event_id", {"location_missing": "value > 100"}) + ") x"
)
def b13_status_rules(s, d):
    e = table(s, d, "events").select(
        F.col("event_id").alias("ordinal"),
        F.col("user_id").alias("handler_id"),
        F.lit("A").alias("source_type"),
        F.col("event_id").alias("sequence"),
        F.expr(_case(HTTP_OF)).alias("http"),
        F.when(F.col("value") <= 100, "MD").alias("location"),
        F.expr("cast(floor(value / 2) as int)").alias("attempt"),
        F.lit(None).cast("string").alias("error_code"),
        F.lit(None).cast("string").alias("error_message"),
    )
    each = [validate.rule_violations(e, "ordinal", rules.status_rules(m)).select(F.lit(m).alias("mode"), "*") for m in ("Attempt", "Fail", "Enumerate")]
    return each[0].unionByName(each[1]).unionByName(each[2])


@query(
    _sql_rules(
        "events",
        "event_id",
        {"negative": "value < 1 OR value BETWEEN 90 AND 91", "ends_before_start": "value > 200", "success_with_error": "event_type = 'purchase' AND value > 50", "failure_without_detail": "event_type = 'signup' AND value <= 50", "outcome_unknown": "event_type = 'view'"},
    )
)
def b14_attempt_rules(s, d):
    e = table(s, d, "events").select(
        F.col("event_id").alias("ordinal"),
        F.col("user_id").alias("handler_id"),
        F.lit(1).alias("attempt"),
        F.lit(1000).alias("started"),
        F.when(F.col("value") > 200, 999).otherwise(1001).alias("completed"),
        F.when(F.col("event_type") == "view", "Lost").otherwise(F.expr(_case(ATTEMPT_OF))).alias("outcome"),
        F.expr(_case(HTTP_OF)).alias("http"),
        F.when(F.col("value") < 1, -1).otherwise(1).alias("duration"),
        F.lit(1).alias("bytes"),
        F.when(F.col("value").between(90, 91), -5).alias("retry_after"),
        F.when(F.col("value") > 50, "E1").alias("error_code"),
        F.lit(None).cast("string").alias("failure"),
    )
    return validate.rule_violations(e, "ordinal", rules.attempt_rules())


@query(_sql_rules("part", "p_partkey", {"code_missing": "p_size < 3", "code_too_wide": "p_size >= 3 AND length(p_brand) > 7", "location_too_wide": "length(p_type) > 5"}))
def b15_code_rules(s, d):
    p = table(s, d, "part").select(F.col("p_partkey").alias("ordinal"), F.when(F.col("p_size") >= 3, F.col("p_brand")).alias("code"), F.col("p_type").alias("location"))
    return validate.rule_violations(p, "ordinal", rules.code_rules(7, True, 5))


@query(f"WITH {RN} " + _sql_rules("rn", "run", {"succeeded_with_failures": "status = 'Succeeded' AND failed > 0", "failed_without_message": "status = 'Failed' AND message IS NULL"}))
def b16_run_audit(s, d):
    r = run_table(s, d).withColumn("fetched", F.col("enumerated")).withColumn("ordinal", F.col("run"))
    return validate.rule_violations(r, "ordinal", rules.run_rules())


# ---- shredding -------------------------------------------------------------------------------------


def _customers(s: SparkSession, d: str) -> DataFrame:
    """Customer bodies: orders, of which each has its lines and a bare array of its parts."""
    own = lines(s, d).groupBy("order_id").agg(F.array_sort(F.collect_list(F.struct("pos", "part", "quantity"))).alias("lines"))
    own = own.withColumn("parts", F.col("lines.part"))
    o = table(s, d, "orders").select(F.col("o_custkey").alias("entity"), F.col("o_orderkey").alias("order_id")).join(own, "order_id", "left")
    each = F.struct("order_id", "lines", "parts")
    return shred.parsed(o.groupBy("entity").agg(F.to_json(F.struct(F.array_sort(F.collect_list(each)).alias("orders"))).alias("body")))


NEST = f"{L}, n AS (SELECT o_custkey AS entity, o_orderkey AS order_id, (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1)::INT AS order_pos FROM orders)"


@query(f"WITH {NEST} SELECT entity, order_pos, l.pos::INT AS pos, part FROM n JOIN l USING (order_id)")
def c3_bare_arrays(s, d):
    o = shred.children(_customers(s, d), ["entity"], "$.orders").withColumnsRenamed({"pos": "order_pos", "element": "v"})
    return shred.children(o, ["entity", "order_pos"], "$.parts").select("entity", "order_pos", "pos", F.try_variant_get("element", "$", "bigint").alias("part"))


@query(f"WITH {NEST} SELECT entity, order_pos, l.pos::INT AS pos, part, quantity FROM n JOIN l USING (order_id)")
def c4_grandchildren(s, d):
    o = shred.children(_customers(s, d), ["entity"], "$.orders").withColumnsRenamed({"pos": "order_pos", "element": "v"})
    g = lambda p, t: F.try_variant_get("element", p, t)
    return shred.children(o, ["entity", "order_pos"], "$.lines").select("entity", "order_pos", "pos", g("$.part", "bigint").alias("part"), g("$.quantity", "double").alias("quantity"))


_MOMENT = "CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN day || 'T23:30:00-02:00' WHEN '2' THEN day || 'T23:30:00+0000' WHEN '3' THEN day WHEN '4' THEN day || 'garbage' ELSE day || ' 10:00:00' END"


@query(
    f"""WITH o AS (SELECT *, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders) SELECT o_orderkey, CASE WHEN o_orderpriority[1] <> '4' THEN day END AS day,
    CASE o_orderpriority[1] WHEN '1' THEN epoch(o_orderdate + INTERVAL 1 DAY + INTERVAL 90 MINUTE) WHEN '2' THEN epoch(o_orderdate + INTERVAL 1410 MINUTE) WHEN '3' THEN epoch(o_orderdate) WHEN '5' THEN epoch(o_orderdate + INTERVAL 10 HOUR) END::BIGINT AS moment FROM o"""
)
def c8_lenient_dates(s, d):
    o = table(s, d, "orders").withColumn("day", F.date_format("o_orderdate", "yyyy-MM-dd")).withColumn("raw", F.expr(_MOMENT))
    return o.select("o_orderkey", lenient_date(F.col("raw")).cast("string").alias("day"), F.unix_seconds(lenient_timestamp(F.col("raw"))).alias("moment"))


def _payload_text(amount: str) -> Column:
    return F.to_json(F.struct("kind", "received", "current", F.col(amount).cast("decimal(18,2)").alias("amount")))


@query(f"WITH {V}, {T}, b AS (SELECT * FROM v WHERE received >= '1996-01-01') SELECT CASE WHEN t.is_deleted IS NULL THEN 'insert' WHEN t.is_deleted OR t.amount <> b.amount THEN 'update' ELSE 'noop' END AS action, count(*) AS n FROM b LEFT JOIN t USING (entity, kind, seq) GROUP BY 1")
def d2_raw_upsert(s, d):
    hashed = lambda x, *more: x.select(*KEY, payload_hash(_payload_text("amount")).alias("payload_sha256"), *more)
    return merge.raw_plan(hashed(target(s, d), "is_deleted"), hashed(batch(s, d)), KEY).groupBy("action").agg(F.count("*").alias("n"))


# ---- merge -----------------------------------------------------------------------------------------


def _orders_under(s: SparkSession, d: str) -> DataFrame:
    """Children of customers: their orders, each with the action of its own merge."""
    o = table(s, d, "orders")
    return o.select(F.col("o_custkey").alias("entity"), F.col("o_orderkey").alias("order_id"), F.when(F.col("o_orderpriority") == "5-LOW", "retire").otherwise("noop").alias("action"), (F.col("o_totalprice") > 400_000).alias("gone"))


def _under(s: SparkSession, d: str, rows: DataFrame) -> DataFrame:
    return rows.join(table(s, d, "orders").select(F.col("o_custkey").alias("entity"), F.col("o_orderkey").alias("order_id")), "order_id")


_LIVE = "JOIN orders ON o_orderkey = order_id AND o_orderpriority <> '5-LOW' AND o_totalprice <= 400000"


@query(
    f"""WITH {L}, {TL}, t AS (SELECT o_custkey AS entity, tl.*, o_orderstatus <> 'P' AS sent FROM tl {_LIVE}), b AS (SELECT o_custkey AS entity, l.* FROM l {_LIVE} WHERE flag <> 'R' AND o_orderstatus <> 'P')
    SELECT coalesce(b.entity, t.entity) AS entity, coalesce(b.order_id, t.order_id) AS order_id, coalesce(b.pos, t.pos) AS pos, CASE WHEN t.pos IS NULL THEN 'insert' WHEN b.pos IS NOT NULL AND t.is_deleted THEN 'revive'
      WHEN b.pos IS NOT NULL AND (t.part <> b.part OR t.quantity <> b.quantity) THEN 'update' WHEN b.pos IS NOT NULL THEN 'noop' WHEN t.sent AND NOT t.is_deleted THEN 'retire' ELSE 'noop' END AS action
    FROM t FULL JOIN b ON t.order_id = b.order_id AND t.pos = b.pos"""
)
def d4_grandchild_merge(s, d):
    from palimpsest.plans.queries import batch_lines, sent

    t, b, x = (_under(s, d, r) for r in (target_lines(s, d), batch_lines(s, d), sent(s, d)))
    return merge.grandchild_merge(t, b, x, _orders_under(s, d), ["entity"], ["order_id", "pos"], ["part", "quantity"])


@query(f"WITH {V}, {T} SELECT v.entity, v.kind, v.seq FROM v LEFT JOIN t ON t.entity = v.entity AND t.kind = v.kind AND t.seq = v.seq AND NOT t.is_deleted WHERE v.received >= '1996-01-01' AND t.seq IS NULL")
def d5_missing_parents(s, d):
    return merge.missing_parents(batch(s, d), target(s, d), KEY).select(*KEY)


@query(f"WITH {L}, {TL} SELECT is_deleted OR order_id IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '3-MEDIUM' OR o_orderstatus = 'F') AS is_deleted, NOT is_deleted AND order_id IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '3-MEDIUM' OR o_orderstatus = 'F') AS stamped, count(*) AS n FROM tl GROUP BY 1, 2")
def d13_stamps(s, d):
    after = merge.stamped(target_lines(s, d), doomed_orders(s, d), ["order_id"], NOW, "withdrawn by the source")
    return after.groupBy("is_deleted", F.col("deleted_at").isNotNull().alias("stamped")).agg(F.count("*").alias("n"))


@query(f"WITH {ST} SELECT status_id, run, 'Succeeded' AS status, 'SoftDeleted' AS outcome FROM st WHERE entity IN (SELECT entity FROM st WHERE value > 300) AND NOT (status = 'Succeeded' AND coalesce(outcome, '') = 'SoftDeleted')")
def d14_deleted_status(s, d):
    st = status(s, d)
    return merge.deleted_status(st, st.filter("value > 300").select("entity"), ["entity"]).select("status_id", "run", "status", "outcome")


@query(f"WITH {V}, {T} SELECT c_custkey AS entity FROM customer WHERE c_acctbal >= 0 AND c_custkey IN (SELECT entity FROM t WHERE kind <> 'O') AND c_custkey NOT IN (SELECT entity FROM t WHERE kind = 'O' AND NOT is_deleted)")
def d15_side_rows(s, d):
    side = table(s, d, "customer").select(F.col("c_custkey").alias("entity"), (F.col("c_acctbal") < 0).alias("is_deleted"))
    doomed = target(s, d).filter("kind <> 'O'").select(*KEY)
    return merge.side_rows_to_retire(side, target(s, d), doomed, KEY, "entity").select("entity")


_AUTH = "coalesce(current, false) AND row_number() OVER (PARTITION BY entity, kind, current ORDER BY received DESC NULLS LAST, seq DESC) = 1 AS ruled"


@query(
    f"""WITH {V}, {T}, b AS (SELECT * FROM v WHERE received >= '1996-01-01'), a AS (SELECT entity, kind, seq, {_AUTH} FROM b),
    r AS (SELECT * FROM a UNION ALL SELECT entity, kind, seq, false FROM t WHERE (entity, kind) IN (SELECT (entity, kind) FROM b) AND (entity, kind, seq) NOT IN (SELECT (entity, kind, seq) FROM b))
    SELECT entity, kind, seq, ruled AS current FROM t JOIN r USING (entity, kind, seq) WHERE NOT is_deleted AND current IS DISTINCT FROM ruled"""
)
def d17_apply_authority(s, d):
    return current.apply_authority(target(s, d), batch(s, d), PAIR)


@query(f"WITH {V}, {T} SELECT entity, kind, seq, CASE WHEN coalesce(is_deleted, true) THEN 'Pending' ELSE 'Failed' END AS status, CASE WHEN coalesce(is_deleted, true) THEN 0 ELSE 2 END AS attempts, CASE WHEN is_deleted IS NULL THEN 'insert' WHEN is_deleted THEN 'revive' WHEN kind = 'F' THEN 'correct' ELSE 'noop' END AS action FROM v LEFT JOIN t USING (entity, kind, seq)")
def d19_enumerate(s, d):
    t = target(s, d).select(*KEY, "is_deleted", F.when(F.col("kind") == "F", "VA").otherwise("MD").alias("location"), F.lit("Failed").alias("status"), F.lit(None).cast("string").alias("outcome"), F.lit(2).alias("attempts"))
    e = versions(s, d).select(*KEY, F.lit("MD").alias("location"))
    return journal.enumerate_plan(t, e, KEY).select(*KEY, "status", "attempts", "action")


def _progressed(s: SparkSession, d: str, mode: str) -> DataFrame:
    st = status(s, d).withColumn("attempt_started", F.when(F.col("status") != "Pending", F.col("ts")))
    e = table(s, d, "events").select(F.col("user_id").alias("entity"), F.col("event_id").alias("seq"), F.lit(9).cast("bigint").alias("attempt"), F.lit(500).alias("http"))
    return journal.progress(st, e, ["entity", "seq"], mode, _now())


@query(f"WITH {ST} SELECT status, attempts, http, outcome, written, count(*) AS n FROM (SELECT CASE WHEN w THEN 'InProgress' ELSE status END AS status, CASE WHEN w THEN 9 ELSE attempts END AS attempts, CASE WHEN NOT w THEN http END AS http, outcome, w AS written FROM (SELECT *, status <> 'Succeeded' AS w FROM st WHERE NOT is_deleted)) GROUP BY ALL")
def d20_attempt(s, d):
    return _progressed(s, d, "Attempt").groupBy("status", "attempts", "http", "outcome", "written").agg(F.count("*").alias("n"))


@query(f"WITH {ST} SELECT entity, seq, CASE WHEN w THEN 'Failed' ELSE status END AS status, CASE WHEN w THEN 500 ELSE http END AS http, CASE WHEN w THEN CASE WHEN status <> 'Pending' THEN least(date_diff('millisecond', ts, TIMESTAMP '{NOW}'), 2147483647) END ELSE duration END::BIGINT AS duration, w AS written FROM (SELECT *, status <> 'Succeeded' AS w FROM st WHERE NOT is_deleted)")
def d20_fail(s, d):
    return _progressed(s, d, "Fail").select("entity", "seq", "status", "http", "duration", "written")


@query(f"WITH {ST} SELECT count(*) AS elements, count(*) FILTER (NOT is_deleted AND status <> 'Succeeded') AS written, count(*) FILTER (NOT is_deleted AND status = 'Succeeded') AS skipped_succeeded, count(*) FILTER (is_deleted) AS not_found FROM st")
def d20_skip_counts(s, d):
    return journal.progress_counts(table(s, d, "events"), _progressed(s, d, "Skip"))


_PATH = "CASE event_type WHEN 'view' THEN '/api/hd/' || event_id WHEN 'click' THEN '/api/hd?key=' || event_id WHEN 'error' THEN 'http://x/' || event_id ELSE '/api/auth/' || event_id END"
_TEXT = "CASE WHEN value > 100 THEN 'no route for /api/v1/auth' WHEN value > 50 THEN repeat('m', 4001) ELSE 'plain' END"


@query(f"SELECT path, message, count(*) AS n FROM (SELECT CASE WHEN event_type = 'view' THEN '/api/hd/' || event_id ELSE '(withheld)' END AS path, CASE WHEN value > 100 THEN '(withheld)' WHEN value > 50 THEN '(withheld: too long)' ELSE 'plain' END AS message FROM events) GROUP BY 1, 2")
def d23_withheld(s, d):
    none = F.lit(None).cast("string")
    e = table(s, d, "events").select(F.expr(_PATH).alias("path"), F.expr(_TEXT).alias("message"), none.alias("failure"), none.alias("error_code"), none.alias("error_id"))
    return journal.withheld(e).groupBy("path", "message").agg(F.count("*").alias("n"))


@query(f"WITH {RN} SELECT run, CASE WHEN status = 'Running' AND started < TIMESTAMP '{NOW}' - INTERVAL 60 MINUTE THEN 'Abandoned' ELSE status END AS status FROM rn")
def d25_abandoned(s, d):
    return runs.abandon_stale(run_table(s, d), _now(), 60).select("run", "status")


@query(f"WITH {ST} SELECT run, arg_max(status, seq) AS status, arg_max(duration, seq) FILTER (duration IS NOT NULL) AS duration, count(status) AS closes, count(DISTINCT status) FILTER (status <> 'Running') > 1 AS conflict FROM st GROUP BY run")
def d27_run_fold(s, d):
    return runs.fold_runs(status(s, d), "run", "seq", ["duration"])


# ---- reads -----------------------------------------------------------------------------------------


@query(f"WITH {RN} SELECT run, status, mode, count(*) OVER () AS total_rows FROM rn WHERE location = 'MD' AND started >= TIMESTAMP '2024-01-05' ORDER BY failed DESC, run DESC LIMIT 40 OFFSET 3")
def e5_runs_page(s, d):
    allowed = ("run", "started", "completed", "status", "mode", "failed")
    return reads.page(run_table(s, d), "failed", allowed, [F.desc("run")], True, 3, 40, {"location": "MD", "status": None}, {"started": ("2024-01-05", None)}, total=True).select("run", "status", "mode", "total_rows")


@query(f"WITH {ST} SELECT status_id, run, entity, outcome, count(*) OVER () AS total_rows FROM st WHERE NOT is_deleted AND status = 'Succeeded' ORDER BY attempts ASC NULLS FIRST, status_id DESC LIMIT 50 OFFSET 20")
def e6_status_page(s, d):
    allowed = ("run", "entity", "status", "outcome", "first_seen", "completed", "attempts")
    found = reads.page(reads.history_view(status(s, d)), "attempts", allowed, [F.desc("status_id")], False, 20, 50, {"status": "Succeeded", "outcome": None}, total=True)
    return found.select("status_id", "run", "entity", "outcome", "total_rows")


@query(f"WITH {V}, {T} SELECT * FROM t WHERE NOT is_deleted AND (entity, kind, seq) IN (SELECT (entity, kind, seq) FROM v WHERE priority = '1-URGENT')")
def e10_detail(s, d):
    return reads.detail(target(s, d), versions(s, d).filter("priority = '1-URGENT'"), KEY)


_SUMS = lambda t, c, prefix, values: ", ".join(f"count(*) FILTER ({c} = '{v}') AS {prefix}_{v.lower()}" for v in values)


@query(
    f"""WITH {RN}, {AT}, {OB}, s AS (SELECT run, count(*) AS status_rows, {_SUMS('st', 'status', 'status', STATUS_OF.values())}, {_SUMS('st', 'outcome', 'outcome', ('Inserted', 'Updated', 'Unchanged', 'SoftDeleted'))},
      count(*) FILTER (outcome IS NULL) AS outcome_not_set, count(DISTINCT entity) AS entities, count(*) FILTER (is_deleted) AS status_deleted, count(execution_log) AS our_failures, sum(attempts)::BIGINT AS attempts_total, count(duration) AS durations, coalesce(sum(duration), 0)::BIGINT AS duration_total,
      max(duration) AS duration_max, min(first_seen) AS first_seen, max(completed) AS last_completed FROM st GROUP BY run),
    a AS (SELECT run, count(*) AS attempt_rows, count(*) FILTER (is_deleted) AS attempts_deleted, {_SUMS('att', 'outcome', 'attempt', ATTEMPT_OF.values())}, max(attempt) AS attempt_max, sum(bytes)::BIGINT AS bytes_total, count(*) FILTER (http BETWEEN 400 AND 499) AS http_4xx, count(*) FILTER (http BETWEEN 500 AND 599) AS http_5xx, max(retry_after) AS retry_after_max FROM att GROUP BY run),
    o AS (SELECT run, count(*) AS observation_rows, count(*) FILTER (is_deleted) AS observations_deleted, {_SUMS('ob', 'severity', 'observation', ('Error', 'Warning', 'Info'))}, count(DISTINCT type) AS observation_types FROM ob GROUP BY run)
    SELECT s.*, a.* EXCLUDE (run), o.* EXCLUDE (run), rn.run_status, CASE WHEN rn.run_status <> 'Running' THEN rn.inserted <> outcome_inserted END AS drift FROM rn JOIN s USING (run) JOIN a USING (run) JOIN o USING (run)"""
)
def e11_full_summary(s, d):
    own = ["run", "run_status", "failed", "skipped", "inserted", "updated", "unchanged", "soft_deleted"]
    return runs.summary(run_table(s, d).select(*own), status(s, d), attempts(s, d), observations(s, d))


@query(f"WITH {RN} SELECT run, status FROM rn ORDER BY started DESC, run DESC LIMIT 1")
def e12_latest_run(s, d):
    return runs.latest_run(run_table(s, d)).select("run", "status")


RESUME = f"""{RN}, nw AS (SELECT location, arg_max(run, run) AS run, arg_max(status, run) AS status, arg_max(started, run) AS started FROM rn WHERE mode <> 'Targeted' GROUP BY 1),
  cand AS (SELECT * FROM nw WHERE (status IN ('Abandoned', 'Failed', 'PartiallySucceeded') OR status = 'Running' AND started < TIMESTAMP '2024-02-01' - INTERVAL 60 MINUTE) AND started >= TIMESTAMP '2024-02-01' - INTERVAL 500 HOUR)"""


def _candidates(s: SparkSession, d: str) -> DataFrame:
    return runs.resume_candidates(run_table(s, d), F.lit("2024-02-01").cast("timestamp"), 60, 500)


@query(f"WITH {RESUME} SELECT location, run, status FROM cand")
def e13_resume_candidates(s, d):
    return _candidates(s, d).select("location", "run", "status")


@query(f"WITH {RESUME} SELECT status_id, entity, st.status, location, cand.status AS run_status FROM st JOIN cand USING (run)")
def e14_resume_set(s, d):
    return runs.resume_set(status(s, d), _candidates(s, d)).select("status_id", "entity", "status", "location", "run_status")


@query("""SELECT c_custkey AS feed, CASE WHEN c_acctbal >= 0 THEN CASE WHEN m IS NULL THEN 'Full' ELSE 'Incremental' END END AS run_mode, CASE WHEN c_acctbal >= 0 THEN CAST(m - 3 AS VARCHAR) END AS from_date, CASE WHEN c_acctbal >= 0 THEN '2024-01-28' END AS to_date
    FROM customer LEFT JOIN (SELECT o_custkey AS k, CAST(max(o_orderdate) AS DATE) AS m FROM orders GROUP BY 1) ON k = c_custkey""")
def e15_watermarks(s, d):
    m = table(s, d, "orders").groupBy(F.col("o_custkey").alias("feed")).agg(F.to_date(F.max("o_orderdate")).alias("mark"))
    w = table(s, d, "customer").select(F.col("c_custkey").alias("feed"), (F.col("c_acctbal") >= 0).alias("enabled"), F.lit(3).alias("overlap")).join(m, "feed", "left")
    dated = runs.recommend(w, F.to_date(F.lit("2024-01-28")))
    return dated.select("feed", "run_mode", F.col("from_date").cast("string").alias("from_date"), F.col("to_date").cast("string").alias("to_date"))


# ---- planning --------------------------------------------------------------------------------------


def _run_facts(s: SparkSession, d: str) -> DataFrame:
    return run_table(s, d).select(
        "run",
        "failed",
        (F.col("mode") == "Targeted").alias("cancelled"),
        F.when(F.col("top") > 250, F.col("message")).alias("failure"),
        F.when(F.col("skipped") > 3, F.col("skipped")).otherwise(0).alias("unfetched"),
        (F.col("updated") < 3).alias("lookups_complete"),
        F.when(F.col("unchanged") > 0, F.col("unchanged") < 3).alias("reconcile_complete"),
        F.when(F.col("enumerated") > 3, F.col("inserted")).alias("walked"),
        F.when(F.col("soft_deleted") > 1, F.col("soft_deleted")).otherwise(0).alias("unwalked"),
        F.when(F.col("inserted") > 0, F.date_format("started", "yyyy-MM-dd")).alias("covered_to"),
    )


FACTS = f"""{RN}, f AS (SELECT run, failed, mode = 'Targeted' AS cancelled, CASE WHEN top > 250 THEN message END AS failure, CASE WHEN skipped > 3 THEN skipped ELSE 0 END AS unfetched, updated < 3 AS lookups_complete,
  CASE WHEN unchanged > 0 THEN unchanged < 3 END AS reconcile_complete, CASE WHEN enumerated > 3 THEN inserted END AS walked, CASE WHEN soft_deleted > 1 THEN soft_deleted ELSE 0 END AS unwalked, CASE WHEN inserted > 0 THEN strftime(started, '%Y-%m-%d') END AS covered_to FROM rn)"""
_WHOLE = "failure IS NULL AND NOT cancelled AND failed = 0 AND unfetched = 0"


@query(f"WITH {FACTS} SELECT run, CASE WHEN cancelled THEN 'Cancelled' WHEN walked IS NULL THEN 'Failed' WHEN {_WHOLE} AND lookups_complete AND coalesce(reconcile_complete, true) AND unwalked = 0 THEN 'Succeeded' WHEN failure IS NOT NULL AND walked = 0 THEN 'Failed' ELSE 'PartiallySucceeded' END AS outcome FROM f")
def f7_run_outcome(s, d):
    return load_plan.run_outcome(_run_facts(s, d)).select("run", "outcome")


@query(
    f"""WITH {FACTS}, g AS (SELECT *, covered_to IS NOT NULL AND {_WHOLE} AS moves FROM f) SELECT run, CASE WHEN moves THEN covered_to END AS advance_to, CASE WHEN NOT moves THEN concat_ws('; ', CASE WHEN unwalked > 0 THEN unwalked || ' windows uncovered' END,
      CASE WHEN covered_to IS NULL AND unwalked = 0 THEN 'walk not finished' END, CASE WHEN NOT ({_WHOLE}) AND NOT cancelled AND failure IS NULL THEN failed || ' failed, ' || unfetched || ' unfetched' END,
      CASE WHEN cancelled THEN 'cancelled' END, CASE WHEN failure IS NOT NULL THEN 'stopped on an error' END) END AS held FROM g"""
)
def f6_advance(s, d):
    return load_plan.advance(_run_facts(s, d)).select("run", "advance_to", "held")


@query("SELECT CAST(w AS VARCHAR) AS window_start, CAST(least(w + 6, DATE '2001-08-01') AS VARCHAR) AS window_end FROM (SELECT unnest(generate_series(DATE '1995-01-01', (SELECT max(o_orderdate)::DATE FROM orders), INTERVAL 7 DAY))::DATE AS w)")
def f1_window_split(s, d):
    last = table(s, d, "orders").agg(F.max("o_orderdate")).first()[0]
    return load_plan.split_windows(s, "1995-01-01", f"{last:%Y-%m-%d}", 7).select(F.col("window_start").cast("string"), F.col("window_end").cast("string"))


_WK = "DATE '1995-01-01' + (date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) // 7 * 7)::INT"


@query(
    f"""WITH a AS (SELECT {_WK} AS w, o_totalprice, o_orderpriority = '1-URGENT' AS current, row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderdate, o_orderkey) = 1 AS first_seen FROM orders),
    g AS (SELECT w, count(*) AS n, count(*) FILTER (first_seen) AS f, count(*) FILTER (current) AS c, max(o_totalprice) AS top, min(o_totalprice) AS low FROM a GROUP BY w),
    x AS (SELECT *, CASE WHEN top < 480000 THEN 'FetchFailed' WHEN low < 1100 THEN 'PayloadRejected' WHEN c > n / 2 THEN 'OutOfScope' ELSE 'Walked' END AS state FROM g)
    SELECT CAST(w AS VARCHAR) AS window_start, state, CASE WHEN state = 'Walked' THEN n ELSE 0 END AS summaries, CASE WHEN state = 'Walked' THEN f ELSE 0 END AS new_versions, CASE WHEN state = 'Walked' THEN c ELSE 0 END AS currents FROM x"""
)
def f3_window_report(s, d):
    o = table(s, d, "orders").withColumn("current", F.col("o_orderpriority") == "1-URGENT")
    a = load_plan.assigned(o, "o_orderdate", "1995-01-01", 7, ["o_custkey", "o_orderstatus"], ["o_orderdate", "o_orderkey"])
    g = a.groupBy("window_start").agg(F.count("*").alias("n"), F.sum(F.col("current").cast("long")).alias("c"), F.max("o_totalprice").alias("top"), F.min("o_totalprice").alias("low"))
    asked = g.select("window_start", F.when(F.col("top") < 480_000, 503).otherwise(200).alias("http"), (F.col("low") >= 1100).alias("readable"), (F.col("c") > F.col("n") / 2).cast("int").alias("foreign"))
    windows = g.select("window_start", F.date_add("window_start", 6).alias("window_end"))
    return load_plan.window_report(windows, a, asked).select(F.col("window_start").cast("string").alias("window_start"), "state", "summaries", "new_versions", "currents")


@query(f"WITH {RN} SELECT run, enumerated, inserted0 AS inserted, updated, unchanged, soft_deleted, skipped, failed, greatest(2 * failed + skipped - enumerated // 4, 0) AS retries FROM rn")
def f8_run_counters(s, d):
    st = status(s, d)
    calls = st.groupBy("run").agg((2 * F.sum((F.col("status") == "Failed").cast("long")) + F.sum((F.col("status") == "Skipped").cast("long"))).alias("requests"), F.expr("count(*) div 4").alias("logical"))
    return runs.run_counters(st, calls, "run").drop("requests", "logical")


_RICH = "SELECT c_custkey FROM customer WHERE c_acctbal > 5000"


@query(f"WITH {V} SELECT 'selected' AS part, entity, count(*) AS n FROM v WHERE current AND entity IN ({_RICH}) GROUP BY 2 UNION ALL SELECT 'none', c_custkey, 0 FROM ({_RICH}) WHERE c_custkey NOT IN (SELECT entity FROM v WHERE current)")
def f9_targeted(s, d):
    wanted = table(s, d, "customer").filter("c_acctbal > 5000").select(F.col("c_custkey").alias("entity"))
    chosen = load_plan.targeted(versions(s, d), wanted, "entity", True)
    none = load_plan.nothing_selected(wanted, chosen, "entity").select(F.lit("none").alias("part"), "entity", F.lit(0).cast("bigint").alias("n"))
    return chosen.groupBy("entity").agg(F.count("*").alias("n")).select(F.lit("selected").alias("part"), "entity", "n").unionByName(none)


_FETCH = {"purchase": "Succeeded", "error": "ServiceFailure", "click": "Throttled", "signup": "NotFound", "view": "Cancelled"}


@query(f"SELECT reply, reply IN ('ServiceFailure', 'Throttled') AS retryable, false AS fatal, CASE reply WHEN 'Succeeded' THEN 'Succeeded' WHEN 'Throttled' THEN 'Throttled' WHEN 'Cancelled' THEN 'Cancelled' ELSE 'Failed' END AS attempt_outcome, CASE WHEN reply IN ('Succeeded', 'NotFound') THEN 'Succeeded' WHEN reply = 'Cancelled' THEN 'Skipped' ELSE 'Failed' END AS fetch_status, count(*) AS n FROM (SELECT {_case(_FETCH)} AS reply FROM events) GROUP BY ALL")
def f10_outcomes(s, d):
    e = table(s, d, "events").select(F.expr(_case(_FETCH)).alias("reply"))
    return load_plan.classified(e, "reply").groupBy("reply", "retryable", "fatal", "attempt_outcome", "fetch_status").agg(F.count("*").alias("n"))


@query(
    """WITH s AS (SELECT o_custkey AS entity, count(*) AS listed, bool_or(o_totalprice > 480000) AS fp, bool_or(o_totalprice > 450000) AS fe FROM orders GROUP BY 1)
    SELECT c_custkey AS entity, CASE c_mktsegment WHEN 'BUILDING' THEN 'NoVersions' WHEN 'MACHINERY' THEN 'FetchFailed' ELSE CASE WHEN c_acctbal < 0 THEN 'PayloadRejected' WHEN fp THEN 'OutOfScope' WHEN fe THEN 'ForeignHandler' WHEN listed IS NULL THEN 'NoVersions' ELSE 'Reconciled' END END AS state,
      coalesce(listed, 0) AS listed FROM customer LEFT JOIN s ON entity = c_custkey"""
)
def f11_eligibility(s, d):
    fetch = F.expr("case c_mktsegment when 'BUILDING' then 'NotFound' when 'MACHINERY' then 'TimedOut' else 'Succeeded' end")
    replies = table(s, d, "customer").select(F.col("c_custkey").alias("entity"), fetch.alias("fetch"), (F.col("c_acctbal") >= 0).alias("readable"))
    price = F.col("o_totalprice")
    listed = table(s, d, "orders").select(F.col("o_custkey").alias("entity"), F.when(price > 450_000, F.lit(-1)).otherwise(F.col("o_custkey")).alias("named"), F.when(price > 480_000, "VA").otherwise("md ").alias("location"))
    return load_plan.reconcile_eligibility(replies, listed, "entity", "MD")


@query("SELECT p_brand AS list, CASE WHEN top > 1050 THEN 'NotAttempted' WHEN n > 90 THEN 'FetchFailed' WHEN n > 80 THEN 'PayloadRejected' WHEN m = 0 THEN 'EmptyPayload' ELSE 'Refreshed' END AS state, m AS codes FROM (SELECT p_brand, max(p_retailprice) AS top, count(*) AS n, count(*) FILTER (p_size > 45) AS m FROM part GROUP BY 1)")
def f12_lookup_report(s, d):
    p = table(s, d, "part").withColumnRenamed("p_brand", "list")
    g = p.groupBy("list").agg(F.max("p_retailprice").alias("top"), F.count("*").alias("n"))
    fetch = F.expr("case when top > 1050 then 'Cancelled' when n > 90 then 'TimedOut' else 'Succeeded' end")
    return load_plan.lookup_report(g.select("list", fetch.alias("fetch"), (F.col("n") <= 80).alias("readable")), p.filter("p_size > 45"))


# ---- probes ----------------------------------------------------------------------------------------


def _dated(s: SparkSession, d: str) -> DataFrame:
    """Order bodies with date-named properties at two depths, in several shapes."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    mixed = F.when(F.col("o_orderstatus") == "O", day).when(F.col("o_orderstatus") == "F", F.concat(day, F.lit("T00:00:00Z")))
    o = table(s, d, "orders").select("o_orderkey", "o_orderstatus", F.to_json(F.struct(day.alias("receivedDate"), F.struct(mixed.alias("closedDATE"), F.lit(1).alias("n")).alias("site"))).alias("body"))
    return shred.walk(o, ["o_orderkey", "o_orderstatus"])


_DAY = "strftime(o_orderdate, '%Y-%m-%d')"
SCAN = f"""sc AS (SELECT '$.receivedDate' AS path, '"' || {_DAY} || '"' AS token, '"yyyy-MM-dd"' AS shape FROM orders UNION ALL
  SELECT '$.site.closedDATE', '"' || {_DAY} || CASE o_orderstatus WHEN 'O' THEN '"' ELSE 'T00:00:00Z"' END, CASE o_orderstatus WHEN 'O' THEN '"yyyy-MM-dd"' ELSE '"yyyy-MM-ddTHH:mm:ssZ"' END FROM orders WHERE o_orderstatus <> 'P')"""


@query(f"WITH {SCAN} SELECT path, token, shape, count(*) AS n FROM sc GROUP BY ALL")
def g3_date_scan(s, d):
    return probe.date_scan(_dated(s, d))


@query(
    f"""WITH {SCAN}, t AS (SELECT DISTINCT path, token, shape FROM sc), r AS (SELECT *, row_number() OVER (PARTITION BY path ORDER BY token) AS nth, row_number() OVER (PARTITION BY path, shape ORDER BY token) AS in_shape FROM t)
    SELECT path, token, shape FROM r WHERE nth <= 8 OR in_shape = 1"""
)
def g5_samples(s, d):
    return probe.samples(probe.date_scan(_dated(s, d)))


@query("SELECT 'closedDATE' AS leaf, '\"yyyy-MM-dd\"' AS \"one\", '\"yyyy-MM-ddTHH:mm:ssZ\"' AS \"other\" WHERE (SELECT count(DISTINCT o_orderstatus) FROM orders WHERE o_orderstatus <> 'P') = 2")
def g6_shape_disagreement(s, d):
    w = _dated(s, d)
    return probe.shape_disagreement(probe.date_scan(w.filter("o_orderstatus = 'O'")), probe.date_scan(w.filter("o_orderstatus = 'F'")))


@query(
    f"""WITH {L}, o AS (SELECT o_orderkey AS k, o_orderstatus AS kind FROM orders), c AS (SELECT count(*) AS total FROM o), n AS (SELECT count(DISTINCT order_id) AS x FROM l JOIN o ON k = order_id), y AS (SELECT count(*) AS x FROM o WHERE kind <> 'P' OR k IN (SELECT order_id FROM l))
    SELECT path, x AS sent, 0 AS "null", total - x AS absent FROM c, (SELECT '$.handler' AS path, total AS x FROM c UNION ALL SELECT '$.handler.id', total FROM c UNION ALL SELECT '$.handler.lines', x FROM y
      UNION ALL SELECT '$.handler.lines[].' || p, x FROM n, (SELECT unnest(['pos', 'part', 'quantity']) AS p))"""
)
def g7_property_census(s, d):
    from palimpsest.plans.queries import bodies

    return probe.census(bodies(s, d))


# ---- observations and reports ----------------------------------------------------------------------


@query(f"WITH {V}, {T} SELECT 'VersionNotInSourceSummary' AS type, 'Warning' AS severity, entity, kind, seq::VARCHAR AS value FROM t WHERE NOT is_deleted AND (entity, kind) IN (SELECT (entity, kind) FROM v WHERE received >= '1996-01-01') AND (entity, kind, seq) NOT IN (SELECT (entity, kind, seq) FROM v WHERE received >= '1996-01-01')")
def h3_not_in_summary(s, d):
    gone = current.unlisted(target(s, d).filter("not is_deleted"), batch(s, d), PAIR)
    return quality.observed(gone, "VersionNotInSourceSummary", "Warning", PAIR, F.col("seq").cast("string"))


@query(f"WITH {V}, {T} SELECT entity, kind, count(*) AS currents FROM t WHERE NOT is_deleted AND current GROUP BY 1, 2 HAVING count(*) > 1")
def h4_ambiguous_in_mirror(s, d):
    return quality.ambiguous_in_mirror(target(s, d), PAIR)


@query(f"WITH {RN} SELECT run, run_status, count(*) AS rows FROM st JOIN (SELECT run, run_status FROM rn) USING (run) WHERE status IN ('Pending', 'InProgress') AND run_status IN ('Succeeded', 'PartiallySucceeded') GROUP BY 1, 2")
def h6_stranded(s, d):
    return quality.stranded_by_closed(journal.stranded(status(s, d), run_table(s, d).select("run", "run_status"), "run"))


_RETIRED = "SELECT p_brand AS list, count(*) FILTER (p_size > 25) AS supplied, count(*) FILTER (p_size <= 25) AS retired FROM part GROUP BY 1"


@query(f"SELECT 'LookupRefreshRetiredTooMany' AS type, 'Error' AS severity, list, retired::VARCHAR AS value FROM ({_RETIRED}) WHERE retired > supplied UNION ALL SELECT 'LookupCodesRetired', 'Info', list, retired::VARCHAR FROM ({_RETIRED}) WHERE retired BETWEEN 1 AND supplied")
def h7_h8_retirements(s, d):
    """Parts as codes of their brand's list: the payload has the large sizes, all sizes are stored."""
    p = table(s, d, "part").select(F.col("p_brand").alias("list"), F.col("p_partkey").alias("code"), F.col("p_size").alias("sort_order"))
    plan = merge.code_list_plan(p.withColumn("is_deleted", F.lit(False)), p.filter("sort_order > 25"), "list", "code", ["sort_order"], True)
    g = plan.groupBy("list").agg(F.sum((F.col("action") != "retire").cast("long")).alias("supplied"), F.sum((F.col("action") == "retire").cast("long")).alias("retired"))
    value = F.col("retired").cast("string")
    many = quality.observed(g.filter("retired > supplied"), "LookupRefreshRetiredTooMany", "Error", ["list"], value)
    return many.unionByName(quality.observed(g.filter("retired between 1 and supplied"), "LookupCodesRetired", "Info", ["list"], value))


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus IN ('O', 'F') AND o_orderpriority = '5-LOW'")
def h10_conditional_required(s, d):
    o = table(s, d, "orders").select("o_orderkey", "o_orderstatus", F.when(F.col("o_orderpriority") == "5-LOW", " ").otherwise(F.col("o_orderpriority")).alias("naics"))
    return quality.conditional_required(o, "o_orderstatus", ("O", "F"), "naics").select("o_orderkey")


@query(f"WITH {ST}, {OB} SELECT run, entity, type, status_id, count(*) AS n FROM ob LEFT JOIN (SELECT run, entity, max(status_id) AS status_id FROM st WHERE NOT is_deleted GROUP BY 1, 2) USING (run, entity) GROUP BY ALL")
def h11_with_status(s, d):
    found = quality.with_status(observations(s, d), reads.history_view(status(s, d)), ["entity"])
    return found.groupBy("run", "entity", "type", "status_id").agg(F.count("*").alias("n"))


@query(f"WITH {V}, c AS (SELECT entity, kind, count(*) AS versions, max(seq) AS last_seq, count(*) FILTER (current) AS n FROM v GROUP BY 1, 2) SELECT entity, kind, versions, last_seq, entity IN (SELECT entity FROM c WHERE n > 0) AS elsewhere FROM c WHERE n = 0")
def i3_without_current(s, d):
    return quality.lineages_without_current(versions(s, d), "entity", "kind")


@query(f"WITH {V} SELECT entity, kind, seq, currents FROM (SELECT *, count(*) OVER (PARTITION BY entity, kind) AS currents FROM v WHERE current) WHERE currents > 1")
def i4_several_currents(s, d):
    return quality.several_currents(versions(s, d), PAIR).select(*KEY, "currents")


@query(f"WITH {ST} SELECT status, outcome, count(*) AS rows, count(*) FILTER (outcome IS NULL) AS no_outcome, count(*) FILTER (completed IS NULL) AS no_completed, count(*) FILTER (duration IS NULL) AS no_duration FROM st GROUP BY 1, 2")
def i6_null_audit(s, d):
    st = status(s, d)
    g = quality.null_audit(st.withColumn("given", F.col("outcome")), ["given", "completed", "duration"])
    return g.withColumnRenamed("no_given", "no_outcome")


@query(f"WITH {V}, {T} SELECT entity, c_acctbal < 0 AS synthetic, count(*) AS versions, count(DISTINCT kind) AS lineages, count(*) FILTER (current) AS visible FROM t JOIN customer ON c_custkey = entity WHERE NOT is_deleted GROUP BY 1, 2")
def i7_stored_and_visible(s, d):
    own = target(s, d).join(table(s, d, "customer").select(F.col("c_custkey").alias("entity"), "c_acctbal"), "entity")
    return quality.stored_and_visible(own, "entity", "kind", F.col("c_acctbal") < 0)


@query("SELECT stamp, count(*) AS n FROM (SELECT CASE WHEN l_shipdate = o_orderdate THEN 'never updated' ELSE 'modified' END AS stamp FROM lineitem JOIN orders ON o_orderkey = l_orderkey) GROUP BY 1")
def i8_never_updated(s, d):
    x = table(s, d, "lineitem").join(table(s, d, "orders"), F.col("o_orderkey") == F.col("l_orderkey"))
    return quality.never_updated(x, "o_orderdate", "l_shipdate", ["l_orderkey"]).groupBy("stamp").agg(F.count("*").alias("n"))


_LOG = "CASE event_type WHEN 'error' THEN 'Authorization: Bearer x' WHEN 'click' THEN '[{\"HandlerId\":\"' || user_id || '\"}]' ELSE 'ok' END"


@query("SELECT event_id, 'message' AS \"column\", CASE event_type WHEN 'error' THEN 'credential' ELSE 'payload' END AS finding FROM events WHERE event_type IN ('error', 'click') UNION ALL SELECT event_id, 'note', 'too_long' FROM events WHERE value > 100")
def i10_privacy_scan(s, d):
    e = table(s, d, "events").select("event_id", F.expr(_LOG).alias("message"), F.when(F.col("value") > 100, F.repeat(F.lit("n"), 4001)).alias("note"))
    return quality.privacy_scan(e, ["event_id"], ["message", "note"])


@query("SELECT p_partkey, c AS \"column\", left(x, 6) AS stored, x AS sent, length(x)::INT AS sent_length FROM (SELECT p_partkey, 'name' AS c, p_name AS x FROM part UNION ALL SELECT p_partkey, 'type', p_type FROM part) WHERE length(x) > 6")
def i12_truncated(s, d):
    """Names and types stored in six characters, against what the raw body says."""
    p = table(s, d, "part")
    body = F.to_json(F.struct(F.col("p_name").alias("name"), F.col("p_type").alias("type")))
    raw = shred.parsed(json_bodies.raw_store(p.select("p_partkey", body.alias("body")), ["p_partkey"]))
    again = raw.select("p_partkey", *(F.try_variant_get("v", f"$.{c}", "string").alias(c) for c in ("name", "type")))
    stored = p.select("p_partkey", F.left("p_name", F.lit(6)).alias("name"), F.left("p_type", F.lit(6)).alias("type"))
    return quality.diverged(stored, again, ["p_partkey"], ["name", "type"])


@query(_sql_rules("part", "p_partkey", {"name": "length(rtrim(p_name)) > 10", "brand": "length(rtrim(p_brand)) > 7"}))
def b3_key_width(s, d):
    p = table(s, d, "part").select(F.col("p_partkey").alias("ordinal"), "p_name", "p_brand")
    return validate.rule_violations(p, "ordinal", {"name": F.length(F.rtrim("p_name")) > 10, "brand": F.length(F.rtrim("p_brand")) > 7})


def _districts(s: SparkSession, d: str) -> DataFrame:
    """Regions as districts with their nations as nested counties, and a type of two columns."""
    n = table(s, d, "nation").join(table(s, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    county = F.struct(F.when(~F.col("n_name").endswith("3"), F.col("n_name")).alias("code"), F.col("n_nationkey").alias("id"))
    kind = F.struct(F.lower("r_name").alias("code"), F.concat(F.lit("type of "), "r_name").alias("description"))
    return n.groupBy(F.col("r_name").alias("district"), kind.alias("kind")).agg(F.array_sort(F.collect_list(F.struct("n_nationkey", county.alias("c")))).alias("x")).select("district", "kind", F.col("x.c").alias("counties"))


_COUNTY = "SELECT r_name AS district, (row_number() OVER (PARTITION BY r_name ORDER BY n_nationkey) - 1)::INT AS pos, CASE WHEN n_name NOT LIKE '%3' THEN n_name END AS code FROM nation JOIN region ON n_regionkey = r_regionkey"


@query(f"SELECT district, pos FROM ({_COUNTY}) WHERE code IS NULL")
def b17_nested_codes_missing(s, d):
    return validate.missing_nested_codes(_districts(s, d), "district", "counties")


@query(_COUNTY)
def c10_counties(s, d):
    body = shred.parsed(_districts(s, d).select("district", F.to_json(F.struct("counties")).alias("body")))
    return shred.children(body, ["district"], "$.counties").select("district", "pos", F.try_variant_get("element", "$.code", "string").alias("code"))


@query("SELECT DISTINCT r_name AS district, lower(r_name) AS type_code, 'type of ' || r_name AS type_description FROM region JOIN nation ON n_regionkey = r_regionkey")
def c9_code_shred(s, d):
    body = shred.parsed(_districts(s, d).select(F.to_json(F.struct("district", "kind")).alias("body")))
    get = lambda p: F.try_variant_get("v", p, "string")
    return body.select(get("$.district").alias("district"), get("$.kind.code").alias("type_code"), get("$.kind.description").alias("type_description"))


@query("SELECT o_orderkey AS order_id, o_orderstatus AS kind, o_totalprice AS amount, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority = '1-URGENT' END AS current, strftime(o_orderdate, '%Y-%m-%d') AS received FROM orders")
def c6_reprojection(s, d):
    """All columns again from the raw store, with nothing fetched again."""
    from palimpsest.plans.queries import ORDER_MAP, payloads

    stored = json_bodies.raw_store(payloads(s, d).select("body"), [])
    return shred.parents(shred.parsed(stored), ORDER_MAP)


@query("SELECT o_orderstatus AS kind, count(*) FILTER (o_orderstatus <> 'F') AS same_text, count(*) AS same_values FROM orders GROUP BY 1")
def c12_hash_and_values(s, d):
    """Two texts of each order with the same values; those of status F are written otherwise, so that their hashes differ."""
    o = table(s, d, "orders").select("o_orderkey", F.col("o_orderstatus").alias("kind"), F.to_json(F.struct(F.col("o_orderkey").alias("a"), F.col("o_custkey").alias("b"))).alias("one"))
    o = o.withColumn("two", F.when(F.col("kind") == "F", F.replace("one", F.lit(","), F.lit(", "))).otherwise(F.col("one")))
    hashes = payload_hash(F.col("one")) == payload_hash(F.col("two"))
    values = F.lit(True)
    for c in ("$.a", "$.b"):
        values = values & F.try_variant_get(F.try_parse_json("one"), c, "bigint").eqNullSafe(F.try_variant_get(F.try_parse_json("two"), c, "bigint"))
    n = lambda c, name: F.sum(c.cast("long")).alias(name)
    return o.groupBy("kind").agg(n(hashes, "same_text"), n(values, "same_values"))


@query(f"WITH {V}, {T}, b AS (SELECT * FROM v WHERE received >= '1996-01-01') SELECT entity, kind, seq, CASE WHEN t.is_deleted IS NULL THEN 'Inserted' ELSE 'Updated' END AS outcome FROM b LEFT JOIN t USING (entity, kind, seq) WHERE t.is_deleted IS NULL OR t.is_deleted OR t.amount <> b.amount")
def d6_outcome_rows(s, d):
    return merge.outcome_rows(merge.merge_plan(target(s, d), batch(s, d), KEY, ["received", "current", "amount"]), KEY)


@query(f"WITH {L}, {TL} SELECT order_id, pos, part, quantity FROM tl WHERE NOT is_deleted")
def e1_history_view(s, d):
    return reads.history_view(target_lines(s, d)).select(*LINE)


@query("SELECT p_partkey, p_brand, p_size FROM part ORDER BY p_size NULLS FIRST, p_brand, p_partkey LIMIT 300")
def e8_type_sort(s, d):
    return reads.page(table(s, d, "part"), "p_size", ("p_size",), ["p_brand", "p_partkey"], take=300).select("p_partkey", "p_brand", "p_size")
