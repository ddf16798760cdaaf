"""Load planning over sets: date windows, first-seen assignment, contiguous coverage, resume sets, outcomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def split_windows(spark: SparkSession, begin: str, end: str, days: int) -> DataFrame:
    """window_start, window_end (inclusive): consecutive windows of at most ``days`` days, the last one cut."""
    starts = spark.range(1).select(F.explode(F.sequence(F.to_date(F.lit(begin)), F.to_date(F.lit(end)), F.expr(f"interval {days} days"))).alias("window_start"))
    return starts.withColumn("window_end", F.least(F.date_add("window_start", days - 1), F.to_date(F.lit(end))))


def assigned(items: DataFrame, at: str, begin: str, days: int, version: list[str], order: list[str]) -> DataFrame:
    """``items`` with window_start by arithmetic (no range join) and first_seen: the first row of each version in window order."""
    w = F.date_add(F.to_date(F.lit(begin)), (F.floor(F.datediff(F.to_date(at), F.to_date(F.lit(begin))) / days) * days).cast("int"))
    d = items.withColumn("window_start", w)
    return d.withColumn("first_seen", F.row_number().over(Window.partitionBy(*version).orderBy("window_start", *order)) == 1)


def coverage(windows: DataFrame, feed: str) -> DataFrame:
    """Per feed: the last end before the first window that was not walked; a gap stops it."""
    w = Window.partitionBy(feed).orderBy("window_start").rowsBetween(Window.unboundedPreceding, 0)
    return windows.withColumn("unbroken", F.min(F.col("walked").cast("int")).over(w)).groupBy(feed).agg(F.max(F.when(F.col("unbroken") == 1, F.col("window_end"))).alias("covered_to"))


def resume_plan(walked: DataFrame, completed: DataFrame, unfinished: DataFrame, keys: list[str]) -> DataFrame:
    """(decision, key): fetch what is walked and not completed, skip what is both, report what vanished."""
    known = completed.select(*keys).union(unfinished.select(*keys)).distinct()
    tag = lambda d, s: d.select(F.lit(s).alias("decision"), *keys)
    fetch, skip = walked.join(completed, keys, "left_anti"), walked.join(completed, keys, "left_semi")
    return tag(fetch, "fetch").union(tag(skip, "skip")).union(tag(known.join(walked, keys, "left_anti"), "vanished"))


def resume_summary(plan: DataFrame) -> DataFrame:
    """One row of a resume_plan(): to_fetch, to_skip, vanished, and skip_rate, the percentage of what was walked that is skipped (0 where nothing was)."""
    n = lambda s: F.count_if(F.col("decision") == s)
    walked = n("fetch") + n("skip")
    rate = F.when(walked == 0, 0.0).otherwise(n("skip") * 100.0 / walked)
    return plan.agg(n("fetch").alias("to_fetch"), n("skip").alias("to_skip"), n("vanished").alias("vanished"), rate.alias("skip_rate"))


def window_report(windows: DataFrame, summaries: DataFrame, asked: DataFrame) -> DataFrame:
    """Per window: summaries, versions seen here first, current ones, and how it went (NotAttempted where nobody asked)."""
    n = lambda c, name: F.coalesce(F.sum(c.cast("long")), F.lit(0)).alias(name)
    seen = summaries.groupBy("window_start").agg(F.count("*").alias("summaries"), n(F.col("first_seen"), "new_versions"), n(F.col("current"), "currents"))
    d = windows.join(seen, "window_start", "left").join(asked, "window_start", "left")
    state = F.when(F.col("http").isNull(), "NotAttempted").when(F.col("http") != 200, "FetchFailed").when(~F.col("readable"), "PayloadRejected").when(F.col("foreign") > 0, "OutOfScope").otherwise("Walked")
    walked = state == "Walked"
    counts = [F.when(walked, F.coalesce(c, F.lit(0))).otherwise(0).alias(c) for c in ("summaries", "new_versions", "currents")]
    return d.select("window_start", "window_end", state.alias("state"), *counts)


def _accounted() -> Column:
    return F.col("failure").isNull() & ~F.col("cancelled") & (F.col("failed") == 0) & (F.col("unfetched") == 0)


def run_outcome(runs: DataFrame) -> DataFrame:
    """Roll-up of each run: cancelled, failed, failure (message), unfetched, lookups_complete, reconcile_complete, walked, unwalked (windows).

    Failed only where the walk never ran (walked is null), or walked nothing and stopped on an error; a run
    that got further is PartiallySucceeded unless everything is accounted for.
    """
    whole = _accounted() & F.col("lookups_complete") & F.coalesce("reconcile_complete", F.lit(True)) & (F.col("unwalked") == 0)
    stopped = F.col("failure").isNotNull() & (F.col("walked") == 0)
    o = F.when(F.col("cancelled"), "Cancelled").when(F.col("walked").isNull(), "Failed").when(whole, "Succeeded").when(stopped, "Failed").otherwise("PartiallySucceeded")
    return runs.withColumn("outcome", o)


def advance(runs: DataFrame) -> DataFrame:
    """advance_to: the contiguous coverage (covered_to) where every version is accounted for, whatever the code lists did; else why it is held."""
    moves = F.col("covered_to").isNotNull() & _accounted()
    reasons = F.array_compact(
        F.array(
            F.when(F.col("unwalked") > 0, F.concat(F.col("unwalked").cast("string"), F.lit(" windows uncovered"))),
            F.when(F.col("covered_to").isNull() & (F.col("unwalked") == 0), "walk not finished"),
            F.when(~_accounted() & ~F.col("cancelled") & F.col("failure").isNull(), F.concat(F.col("failed").cast("string"), F.lit(" failed, "), F.col("unfetched").cast("string"), F.lit(" unfetched"))),
            F.when(F.col("cancelled"), "cancelled"),
            F.when(F.col("failure").isNotNull(), "stopped on an error"),
        )
    )
    return runs.withColumns({"advance_to": F.when(moves, F.col("covered_to")), "held": F.when(~moves, F.array_join(reasons, "; "))})


def targeted(versions: DataFrame, wanted: DataFrame, entity: str, current_only: bool) -> DataFrame:
    """Versions of the wanted entities: the current-flagged ones, or all. The highest sequence is never taken for current."""
    own = versions.join(wanted.select(entity).distinct(), entity, "left_semi")
    return own.filter("current") if current_only else own


def nothing_selected(wanted: DataFrame, selected: DataFrame, entity: str) -> DataFrame:
    return wanted.select(entity).distinct().join(selected.select(entity), entity, "left_anti")


#: What a fetch outcome means: (retryable, fatal to the run, attempt outcome, status).
FETCH_OUTCOMES = {
    "Succeeded": (False, False, "Succeeded", "Succeeded"),
    "NotFound": (False, False, "Failed", "Succeeded"),
    "BadRequest": (False, True, "Failed", "Failed"),
    "Unauthorized": (False, True, "Failed", "Failed"),
    "AccessDenied": (False, True, "Failed", "Failed"),
    "Throttled": (True, False, "Throttled", "Failed"),
    "ServiceFailure": (True, False, "Failed", "Failed"),
    "Unreachable": (True, False, "Failed", "Failed"),
    "TimedOut": (True, False, "TimedOut", "Failed"),
    "Cancelled": (False, False, "Cancelled", "Skipped"),
    "Unexpected": (False, False, "Failed", "Failed"),
}


def classified(fetches: DataFrame, outcome: str = "fetch") -> DataFrame:
    """``fetches`` with retryable, fatal, attempt_outcome and fetch_status; null where the outcome is unknown."""
    rows = [(k, *v) for k, v in FETCH_OUTCOMES.items()]
    table = fetches.sparkSession.createDataFrame(rows, f"{outcome} string, retryable boolean, fatal boolean, attempt_outcome string, fetch_status string")
    return fetches.join(F.broadcast(table), outcome, "left")  # eleven rows


def reconcile_eligibility(replies: DataFrame, summaries: DataFrame, entity: str, scope: str) -> DataFrame:
    """Per entity asked for: whether its version list may be reconciled, and if not why.

    ``replies``: entity, fetch, readable; ``summaries``: entity, named (the entity it names), location.
    """
    where = F.upper(F.trim(F.coalesce("location", F.lit(""))))
    flags = summaries.groupBy(entity).agg(
        F.count("*").alias("listed"), F.max((where != "") & (where != scope)).alias("foreign_place"), F.max(F.col("named") != F.col(entity)).alias("foreign_entity")
    )
    state = (
        F.when(F.col("fetch") == "NotFound", "NoVersions")
        .when(F.col("fetch") != "Succeeded", "FetchFailed")
        .when(~F.col("readable"), "PayloadRejected")
        .when(F.col("foreign_place"), "OutOfScope")
        .when(F.col("foreign_entity"), "ForeignHandler")
        .when(F.coalesce("listed", F.lit(0)) == 0, "NoVersions")
        .otherwise("Reconciled")
    )
    return replies.join(flags, entity, "left").select(entity, state.alias("state"), F.coalesce("listed", F.lit(0)).alias("listed"))


def lookup_report(lists: DataFrame, codes: DataFrame) -> DataFrame:
    """Per code list: Refreshed, EmptyPayload, PayloadRejected, FetchFailed or NotAttempted, and its codes."""
    counted = codes.groupBy("list").agg(F.count("*").alias("codes"))
    state = (
        F.when(F.col("fetch").isNull() | (F.col("fetch") == "Cancelled"), "NotAttempted")
        .when(F.col("fetch") != "Succeeded", "FetchFailed")
        .when(~F.col("readable"), "PayloadRejected")
        .when(F.coalesce("codes", F.lit(0)) == 0, "EmptyPayload")
        .otherwise("Refreshed")
    )
    return lists.join(counted, "list", "left").select("list", state.alias("state"), F.coalesce("codes", F.lit(0)).alias("codes"))
