"""The merge family: idempotent upserts with revival, gated retirement of children, guarded code lists, cascades."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.fieldmap import FieldMap
from palimpsest.functions.columns import differs
from palimpsest.functions.keys import anti, grouped, joined, same, semi


def merge_plan(target: DataFrame, batch: DataFrame, keys: list[str], columns: list[str], deleted: str = "is_deleted") -> DataFrame:
    """Each batch row with its action: insert, revive (the stored row is deleted), update or noop.

    Matching ignores deletion; a column counts as changed where it IS DISTINCT FROM the stored one, so
    the same batch twice gives noop throughout.
    """
    t, b = target.alias("t"), batch.alias("b")
    on = same(target, batch, keys)
    action = F.when(F.col(f"t.{deleted}").isNull(), "insert").when(F.col(f"t.{deleted}"), "revive").when(differs("t", "b", columns), "update").otherwise("noop")
    return b.join(t, on, "left").select(*(F.col(f"b.{c}") for c in [*keys, *columns]), action.alias("action"))


def apply_plan(target: DataFrame, plan: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """The target after the plan: planned rows that act replace stored ones, all others stay.

    It rewrites the whole target: buckets.merge() rewrites only what an increment touches.
    """
    acting = plan.filter("action <> 'noop'").select(*keys, *columns, F.lit(False).alias("is_deleted"))
    return anti(target, acting, keys).select(*keys, *columns, "is_deleted").unionByName(acting)


def merge_counters(plan: DataFrame) -> DataFrame:
    count = lambda *a: F.coalesce(F.sum(F.col("action").isin(*a).cast("long")), F.lit(0)).alias(a[0])
    return plan.agg(count("insert"), count("update"), count("revive"), count("noop"), F.count("*").alias("total"))


def upsert_rows(target: DataFrame, batch: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """merge_plan() as the rows after it (keys, columns, is_deleted) with their action; a stored key keeps its spelling."""
    t, b = target.alias("t"), batch.alias("b")
    action = F.when(F.col("t.is_deleted").isNull(), "insert").when(F.col("t.is_deleted"), "revive").when(differs("t", "b", columns), "update").otherwise("noop")
    joined_ = b.join(t, same(target, batch, keys), "left")
    return joined_.select(*(F.coalesce(f"t.{k}", f"b.{k}").alias(k) for k in keys), *(F.col(f"b.{c}") for c in columns), F.lit(False).alias("is_deleted"), action.alias("action"))


def raw_rows(target: DataFrame, batch: DataFrame, keys: list[str], columns: list[str], digest: str = "payload_sha256") -> DataFrame:
    """raw_plan() as the rows after it: only the hash (or a deletion) makes a text change."""
    t, b = target.alias("t"), batch.alias("b")
    changed = F.col("t.is_deleted") | ~F.col(f"t.{digest}").eqNullSafe(F.col(f"b.{digest}"))
    action = F.when(F.col("t.is_deleted").isNull(), "insert").when(changed, "update").otherwise("noop")
    joined_ = b.join(t, same(target, batch, keys), "left")
    return joined_.select(*(F.coalesce(f"t.{k}", f"b.{k}").alias(k) for k in keys), *(F.col(f"b.{c}") for c in columns), F.lit(False).alias("is_deleted"), action.alias("action"))


def child_rows(target: DataFrame, batch: DataFrame, sent: DataFrame, parent: list[str], columns: list[str], ordinal: str = "pos") -> DataFrame:
    """The children of the batch's parents after the merge: keys, columns, is_deleted and action.

    Rows that the batch lacks are retired only where the parent's collection was sent; absent is not
    empty. Rows already retired stay untouched. ``sent`` has the parent key and a boolean ``sent``.
    """
    keys = [*parent, ordinal]
    own = joined(target, sent.select(*parent, "sent"), parent)
    t, b = own.alias("t"), batch.alias("b")
    here, there = F.col(f"b.{ordinal}").isNotNull(), F.col(f"t.{ordinal}").isNotNull()
    retired = F.col("t.sent") & ~F.col("t.is_deleted")
    action = (
        F.when(~there, "insert")
        .when(here & F.col("t.is_deleted"), "revive")
        .when(here & differs("t", "b", columns), "update")
        .when(here, "noop")
        .when(retired, "retire")
        .otherwise("noop")
    )
    return t.join(b, same(own, batch, keys), "full_outer").select(
        *(F.coalesce(f"t.{k}", f"b.{k}").alias(k) for k in keys),
        *(F.when(here, F.col(f"b.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in columns),
        F.when(here, False).otherwise(F.col("t.is_deleted") | F.coalesce(retired, F.lit(False))).alias("is_deleted"),
        action.alias("action"),
    )


def child_merge(target: DataFrame, batch: DataFrame, sent: DataFrame, parent: list[str], columns: list[str], ordinal: str = "pos") -> DataFrame:
    """Actions of child_rows()."""
    return child_rows(target, batch, sent, parent, columns, ordinal).select(*parent, ordinal, "action")


def code_list_plan(target: DataFrame, batch: DataFrame, scope: str, code: str, columns: list[str], full: bool) -> DataFrame:
    """Upsert of a code list; ``full`` also retires live codes that the payload lacks, within the scopes it mentions."""
    plan = merge_plan(target, batch, [scope, code], columns).select(scope, code, "action")
    if not full:
        return plan
    gone = anti(semi(target.filter("not is_deleted"), batch, [scope]), batch, [scope, code])
    return plan.unionByName(gone.select(scope, code, F.lit("retire").alias("action")))


def retirement_guard(plan: DataFrame) -> DataFrame:
    """One row: elements supplied, codes retired, and whether a full refresh is refused (it retires more than it was given)."""
    n = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0))
    counted = plan.agg(n(F.col("action") != "retire").alias("supplied"), n(F.col("action") == "retire").alias("retired"))
    return counted.withColumn("refused", F.col("retired") > F.col("supplied"))


def soft_delete_cascade(doomed: DataFrame, keys: list[str], tables: dict[str, DataFrame]) -> DataFrame:
    """(table, rows) that a deletion of the versions ``doomed`` stamps: live rows of every table that carry the key."""
    hit = [semi(t.filter("not is_deleted"), doomed, keys).agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows") for name, t in tables.items()]
    return reduce(DataFrame.unionByName, hit)


def status_closeout(status: DataFrame, outcome: DataFrame, keys: list[str]) -> DataFrame:
    """Status rows of the batch as Succeeded with the merge's outcome; a version without an action is Unchanged."""
    o = outcome.filter("action <> 'noop'").select(*keys, "action")
    named = F.when(F.col("action") == "insert", "Inserted").when(F.col("action").isNull(), "Unchanged").otherwise("Updated")
    return joined(status, o, keys, "left").select(*keys, F.lit("Succeeded").alias("status"), named.alias("outcome"))


def closeout(status: DataFrame, batch: DataFrame, plan: DataFrame, raw: DataFrame, keys: list[str], now: Column) -> DataFrame:
    """The live status rows of a merged batch as they are after it: Succeeded, the outcome, the stored text's hash and ``completed``.

    No row is inserted: a version that was never enumerated has none, and is part of the shortfall.
    """
    outcome = F.when(F.col("action") == "insert", "Inserted").when(F.col("action").isin("revive", "update"), "Updated").otherwise("Unchanged")
    own = joined(plan.select(*keys, outcome.alias("outcome")), raw.select(*keys, "payload_sha256"), keys, "left")
    found = semi(status.filter("not is_deleted"), batch, keys).drop("outcome", "payload_sha256", "status", "completed")
    return joined(found, own, keys).withColumns({"status": F.lit("Succeeded"), "completed": now})


def failed_closeout(status: DataFrame, batch: DataFrame, keys: list[str], now: Column) -> DataFrame:
    """The live status rows of a batch whose merge failed: Failed, and no outcome, for nothing was applied."""
    return semi(status.filter("not is_deleted"), batch, keys).withColumns({"status": F.lit("Failed"), "outcome": F.lit(None).cast("string"), "completed": now})


def merge_report(plans: dict[str, DataFrame], sent: DataFrame, fields: FieldMap, status: DataFrame | None = None) -> DataFrame:
    """One row of all a merge's counters, from its plans (by table) and what was ``sent`` (collection, sent).

    elements, inserted, updated (revived ones too), unchanged; raw_rows written; child_rows written on all levels and
    those of them retired; absent_collections, that no element of the batch sent; and with ``status`` the rows closed
    out and ``shortfall``, the elements without one.
    """
    keys = list(fields.keys)
    own, raw = plans[fields.name], plans[f"{fields.name}_raw"]
    n = lambda c, name: F.count_if(c).alias(name)
    acting = F.col("action") != "noop"
    count = own.agg(F.count("*").alias("elements"), n(F.col("action") == "insert", "inserted"), n(F.col("action").isin("update", "revive"), "updated"), n(~acting, "unchanged"))
    children = reduce(DataFrame.unionByName, (plans[c.name].select("action") for c, *_ in fields.walk()))
    absent = sent.groupBy("collection").agg(F.max("sent").alias("sent"))
    parts = [raw.agg(n(acting, "raw_rows")), children.agg(n(acting, "child_rows"), n(F.col("action") == "retire", "child_retired")), absent.agg(n(~F.col("sent"), "absent_collections"))]
    if status is not None:
        parts.append(semi(status.filter("not is_deleted"), own, keys).agg(F.count("*").alias("status_rows")))
    one = [x.withColumn("__one", F.lit(1)) for x in (count, *parts)]  # a row each
    out = reduce(lambda a, b: a.join(b, "__one"), one).drop("__one")
    return out.withColumn("shortfall", F.col("elements") - F.col("status_rows")) if status is not None else out


def orphan_children(parents: DataFrame, children: DataFrame, keys: list[str]) -> DataFrame:
    """Live children of deleted parents: none after a complete cascade."""
    return semi(children.filter("not is_deleted"), parents.filter("is_deleted"), keys)


def converged(before: DataFrame, after: DataFrame) -> DataFrame:
    """(side, n): rows that only one of two snapshots has; no rows where a second run changed nothing."""
    one = lambda a, b, name: a.exceptAll(b).agg(F.count("*").alias("n")).select(F.lit(name).alias("side"), "n")
    return one(before, after, "lost").unionByName(one(after, before, "gained")).filter("n > 0")


def raw_plan(target: DataFrame, batch: DataFrame, keys: list[str], digest: str = "payload_sha256") -> DataFrame:
    """Actions on the raw store: insert, or update where the text's hash differs or the row is deleted, else noop."""
    t, b = target.alias("t"), batch.alias("b")
    changed = F.col("t.is_deleted") | ~F.col(f"t.{digest}").eqNullSafe(F.col(f"b.{digest}"))
    action = F.when(F.col("t.is_deleted").isNull(), "insert").when(changed, "update").otherwise("noop")
    return b.join(t, same(target, batch, keys), "left").select(*(F.col(f"b.{k}") for k in keys), action.alias("action"))


def grandchild_merge(target: DataFrame, batch: DataFrame, sent: DataFrame, children: DataFrame, parent: list[str], ordinals: list[str], columns: list[str]) -> DataFrame:
    """child_merge() one level down: only rows under children that are live after their own merge take part."""
    own = [*parent, ordinals[0]]
    live = children.filter("action <> 'retire' and not gone").select(*own)
    return child_merge(semi(target, live, own), semi(batch, live, own), sent, own, columns, ordinals[1])


def missing_parents(elements: DataFrame, parents: DataFrame, keys: list[str]) -> DataFrame:
    """Elements for which no live parent is there after the merge: none, or the batch is refused."""
    return anti(elements, parents.filter("not is_deleted"), keys)


def nested_code_rows(target: DataFrame, batch: DataFrame, owners: DataFrame, owner: list[str], ordinal: str, columns: list[str], full: bool) -> DataFrame:
    """The list nested in code-list elements after its merge: owner, ordinal, columns, is_deleted and action.

    ``owners`` has every stored owner after its own merge (is_deleted, and whether this payload has it: ``sent``).
    Rows of the payload are upserted under live owners. ``full`` retires the ordinals that a live owner of the payload
    no longer sends. Whatever the mode, and whether or not it was sent, a retired owner keeps no live row: they cascade.
    """
    keys, live = [*owner, ordinal], owners.filter("not is_deleted")
    there, gone = target.filter("not is_deleted"), lambda d, action: d.select(*keys, *columns, F.lit(True).alias("is_deleted"), F.lit(action).alias("action"))
    out = upsert_rows(target, semi(batch, live, owner), keys, columns).unionByName(gone(semi(there, owners.filter("is_deleted"), owner), "cascade"))
    return out.unionByName(gone(anti(semi(there, live.filter("sent"), owner), batch, keys), "retire")) if full else out


def nested_code_plan(target: DataFrame, batch: DataFrame, owners: DataFrame, owner: list[str], ordinal: str, columns: list[str], full: bool) -> DataFrame:
    """Actions of nested_code_rows()."""
    return nested_code_rows(target, batch, owners, owner, ordinal, columns, full).select(*owner, ordinal, "action")


def deleted_status(status: DataFrame, doomed: DataFrame, keys: list[str]) -> DataFrame:
    """Status rows of deleted versions that change: Succeeded with outcome SoftDeleted."""
    hit = semi(status, doomed, keys)
    differs = ~(F.col("status").eqNullSafe(F.lit("Succeeded")) & F.col("outcome").eqNullSafe(F.lit("SoftDeleted")))
    return hit.filter(differs).withColumns({"status": F.lit("Succeeded"), "outcome": F.lit("SoftDeleted")})


def side_rows_to_retire(side: DataFrame, versions: DataFrame, doomed: DataFrame, keys: list[str], entity: str) -> DataFrame:
    """Live rows of a table kept per entity, for entities whose last live version is deleted."""
    left = anti(versions.filter("not is_deleted"), doomed, keys)
    return semi(side.filter("not is_deleted"), anti(doomed, left, [entity]), [entity])


def stamped(table: DataFrame, doomed: DataFrame, keys: list[str], at: str, reason: str) -> DataFrame:
    """``table`` with its live rows of the doomed versions deleted: one stamp, and a reason of ten characters at least."""
    if len(reason.strip()) < 10:
        raise ValueError("a deletion needs a reason of ten characters")
    hit = joined(table, grouped(doomed, keys, F.lit(True).alias("__hit")), keys, "left")
    now = F.coalesce("__hit", F.lit(False)) & ~F.col("is_deleted")
    at_ = F.when(now, F.lit(at).cast("timestamp"))
    return hit.withColumns({"deleted_at": at_, "deleted_reason": F.when(now, F.lit(reason)), "is_deleted": F.col("is_deleted") | now}).drop("__hit")


def outcome_rows(plan: DataFrame, keys: list[str]) -> DataFrame:
    """One row per version that the merge inserted or updated; an unchanged one has none."""
    return plan.filter("action <> 'noop'").select(*keys, F.when(F.col("action") == "insert", "Inserted").otherwise("Updated").alias("outcome"))
