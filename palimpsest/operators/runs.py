"""Runs as sets: folding their events, abandonment, resume candidates, watermark recommendations, counters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RESUMABLE = ("Abandoned", "Failed", "PartiallySucceeded")


def fold_runs(events: DataFrame, run: str, order: str, counters: list[str]) -> DataFrame:
    """One row per run: the last status, each counter's last value that was given, and whether closing events disagree.

    A second close with the same status is a repeat; with another one it is a conflict.
    """
    last = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in ("status", *counters)]
    closes = F.count_distinct(F.when(F.col("status") != "Running", F.col("status")))
    return events.groupBy(run).agg(*last, F.count("status").alias("closes"), (closes > 1).alias("conflict"))


def abandon_stale(runs: DataFrame, now: Column, minutes: int) -> DataFrame:
    """``runs`` with those Abandoned that are Running, not completed and older than ``minutes`` (15 at least)."""
    if minutes < 15:
        raise ValueError("a run is stale after 15 minutes at the earliest")
    stale = (F.col("status") == "Running") & F.col("completed").isNull() & (F.col("started") < now - F.expr(f"interval {minutes} minutes"))
    note = F.when(stale, F.lit(f"no end within {minutes} minutes")).otherwise(F.col("message"))
    return runs.withColumns({"message": note, "status": F.when(stale, "Abandoned").otherwise(F.col("status"))})


def latest_run(runs: DataFrame) -> DataFrame:
    """The newest run by start, then by number."""
    return runs.orderBy(F.desc("started"), F.desc("run")).limit(1)


def resume_candidates(runs: DataFrame, now: Column, stale_minutes: int, max_age_hours: int) -> DataFrame:
    """Per location, the newest run that isn't Targeted, where it can be resumed: ended badly or stale, and not too old."""
    newest = runs.filter("mode <> 'Targeted'").groupBy("location").agg(F.max_by(F.struct("run", "status", "started"), "run").alias("r")).select("location", "r.*")
    stale = (F.col("status") == "Running") & (F.col("started") < now - F.expr(f"interval {stale_minutes} minutes"))
    return newest.filter((F.col("status").isin(*RESUMABLE) | stale) & (F.col("started") >= now - F.expr(f"interval {max_age_hours} hours")))


def resume_set(status: DataFrame, candidates: DataFrame) -> DataFrame:
    """All status rows of the candidates, with the run's location and status."""
    return status.join(candidates.select("run", "location", F.col("status").alias("run_status")), "run")


def recommend(watermarks: DataFrame, today: Column) -> DataFrame:
    """What to run next per feed: nothing where it is paused, Full where it never loaded, else Incremental with the overlap."""
    on, loaded = F.col("enabled"), F.col("mark").isNotNull()
    return watermarks.withColumns(
        {
            "run_mode": F.when(on, F.when(loaded, "Incremental").otherwise("Full")),
            "from_date": F.when(on & loaded, F.date_sub("mark", F.col("overlap"))),
            "to_date": F.when(on, today),
        }
    )


def run_counters(status: DataFrame, calls: DataFrame, run: str) -> DataFrame:
    """Counters of each run from its status rows, and retries: requests less logical calls, 0 at least. ``calls``: run, requests, logical."""
    n = lambda c, name: F.sum(c.cast("long")).alias(name)
    outcome = F.coalesce("outcome", F.lit(""))
    counted = status.groupBy(run).agg(
        F.count("*").alias("enumerated"),
        *(n(outcome == o, name) for o, name in (("Inserted", "inserted"), ("Updated", "updated"), ("Unchanged", "unchanged"), ("SoftDeleted", "soft_deleted"))),
        n(F.col("status") == "Skipped", "skipped"),
        n(F.col("status") == "Failed", "failed"),
    )
    return counted.join(calls, run, "left").withColumn("retries", F.greatest(F.coalesce(F.col("requests") - F.col("logical"), F.lit(0)), F.lit(0)))


def elapsed(runs: DataFrame, now: Column) -> DataFrame:
    """``runs`` with elapsed_seconds: to the completion, or to ``now`` while there is none; capped."""
    seconds = F.unix_seconds(F.coalesce(F.col("completed"), now)) - F.unix_seconds("started")
    return runs.withColumn("elapsed_seconds", F.when(seconds.isNotNull(), F.least(seconds, F.lit(2_147_483_647))).cast("int"))


def summary(runs: DataFrame, status: DataFrame, attempts: DataFrame, observations: DataFrame, run: str = "run") -> DataFrame:
    """One row per run: what its status, attempt and observation rows say, beside the run's own counters.

    ``drift`` is null while the run is Running, else whether any of the six counters that should agree doesn't.
    """
    n = lambda c, name: F.coalesce(F.sum(c.cast("long")), F.lit(0)).alias(name)
    is_ = lambda c, v: F.coalesce(F.col(c) == v, F.lit(False))
    named = lambda c, prefix, values: [n(is_(c, v), f"{prefix}_{v.lower()}") for v in values]
    s = status.groupBy(run).agg(
        F.count("*").alias("status_rows"),
        *named("status", "status", ("Pending", "InProgress", "Succeeded", "Failed", "Skipped")),
        *named("outcome", "outcome", ("Inserted", "Updated", "Unchanged", "SoftDeleted")),
        n(F.col("outcome").isNull(), "outcome_not_set"),
        F.count_distinct("entity").alias("entities"),
        n(F.col("is_deleted"), "status_deleted"),
        F.count("execution_log").alias("our_failures"),
        F.coalesce(F.sum("attempts"), F.lit(0)).alias("attempts_total"),
        F.count("duration").alias("durations"),
        F.coalesce(F.sum("duration"), F.lit(0)).alias("duration_total"),
        F.max("duration").alias("duration_max"),
        F.min("first_seen").alias("first_seen"),
        F.max("completed").alias("last_completed"),
    )
    a = attempts.groupBy(run).agg(
        F.count("*").alias("attempt_rows"),
        n(F.col("is_deleted"), "attempts_deleted"),
        *named("outcome", "attempt", ("Succeeded", "Failed", "Throttled", "TimedOut", "Cancelled")),
        F.max("attempt").alias("attempt_max"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes_total"),
        n(F.col("http").between(400, 499), "http_4xx"),
        n(F.col("http").between(500, 599), "http_5xx"),
        F.max("retry_after").alias("retry_after_max"),
    )
    o = observations.groupBy(run).agg(
        F.count("*").alias("observation_rows"), n(F.col("is_deleted"), "observations_deleted"), *named("severity", "observation", ("Error", "Warning", "Info")), F.count_distinct("type").alias("observation_types")
    )
    d = runs.join(s, run, "left").join(a, run, "left").join(o, run, "left")
    d = d.fillna(0, [c for x in (s, a, o) for c, kind in x.dtypes if kind == "bigint" and c != run and c not in ("first_seen", "last_completed") and not c.endswith("_max")])
    pairs = {"failed": "status_failed", "skipped": "status_skipped", "inserted": "outcome_inserted", "updated": "outcome_updated", "unchanged": "outcome_unchanged", "soft_deleted": "outcome_softdeleted"}
    differs = reduce(Column.__or__, (F.col(own) != F.col(seen) for own, seen in pairs.items()))
    return d.withColumn("drift", F.when(F.col("run_status") != "Running", F.coalesce(differs, F.lit(False)))).drop(*pairs)
