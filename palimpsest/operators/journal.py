"""Run journal: fold buffered events, append attempts, sweep stranded rows, audit runs and watermark moves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.functions.keys import folded, grouped, joined, key, over, same
from palimpsest.operators.scan import running_max


def fold(events: DataFrame, keys: list[str], kind: str, order: str) -> DataFrame:
    """The last event of each kind per key."""
    own = F.struct(*[c for c in events.columns if c not in (*keys, kind)])
    return grouped(events, [*keys, kind], F.max_by(own, order).alias("e")).select(*keys, kind, "e.*")


def new_attempts(status: DataFrame, attempts: DataFrame, recorded: DataFrame, keys: list[str], number: str) -> DataFrame:
    """The attempts to append, each with a verdict: written, already recorded, or orphaned (no status row)."""
    known = grouped(status, keys, F.lit(True).alias("known"))
    there = grouped(recorded, [*keys, number], F.lit(True).alias("there"))
    d = joined(joined(attempts, known, keys, "left"), there, [*keys, number], "left")
    verdict = F.when(F.col("known").isNull(), "orphaned").when(F.col("there"), "already_recorded").otherwise("written")
    return d.withColumn("verdict", verdict).drop("known", "there")


def with_duration(attempts: DataFrame) -> DataFrame:
    """``attempts`` with duration: the one given, or the capped time from start to completion where there is one."""
    took = F.unix_millis("completed") - F.unix_millis("started")
    derived = F.when(took.isNotNull(), F.least(took, F.lit(CAP_MS))).cast("int")  # least() passes over nulls
    return attempts.withColumn("duration", F.coalesce(F.col("duration").cast("int"), derived))


def append_attempts(status: DataFrame, attempts: DataFrame, recorded: DataFrame, keys: list[str], number: str) -> DataFrame:
    """One row: attempts written, already recorded and orphaned, in one aggregation."""
    n = lambda v: F.coalesce(F.sum((F.col("verdict") == v).cast("long")), F.lit(0)).alias(v)
    return new_attempts(status, attempts, recorded, keys, number).agg(n("written"), n("already_recorded"), n("orphaned"))


def stranded(status: DataFrame, runs: DataFrame, run: str) -> DataFrame:
    """Pending or InProgress rows whose run is no longer Running."""
    return status.filter(F.col("status").isin("Pending", "InProgress")).join(runs.filter("run_status <> 'Running'").select(run, "run_status"), run)


def swept(status: DataFrame, runs: DataFrame, run: str, now: Column, location: str | None = None, only: int | None = None) -> DataFrame:
    """The live stranded rows of a location or run (all, if none is given) as the sweep leaves them: Failed, and their ``previous_status``.

    A row that has a completion time keeps it, for it is truer than the sweep's. Rows of running or deleted runs are
    not touched, and a second sweep finds none.
    """
    found = stranded(status.filter("not is_deleted"), runs.filter("not is_deleted"), run)
    if location is not None:
        found = found.filter(key(found, "location") == folded(F.lit(location)))
    if only is not None:
        found = found.filter(F.col(run) == only)
    return found.withColumns({"previous_status": F.col("status"), "status": F.lit("Failed"), "completed": F.coalesce("completed", now)})


def overlapping_runs(runs: DataFrame, scope: str, run: str, start: str, end: str, now: Column, mode: str = "mode", parts: int | None = None) -> DataFrame:
    """Runs that begin before an earlier one of their scope has ended, with ``busy_until`` and the run that is ``blocked_by``.

    A run without an end goes on until ``now``. Targeted runs neither block nor are blocked. Of several open earlier
    runs the one that ends last is named. See running_max() for scopes with many runs.
    """
    open_ = runs.filter(~F.col(mode).eqNullSafe(F.lit("Targeted")))
    until = F.struct(F.coalesce(F.col(end), now).alias("until"), F.col(run).alias("run"))
    found = running_max(open_, [scope], [start, run], until, name="__busy", parts=parts)
    return found.filter(F.col(start) < F.col("__busy.until")).withColumns({"busy_until": F.col("__busy.until"), "blocked_by": F.col("__busy.run")}).drop("__busy")


def latest_only(status: DataFrame, version: list[str], run: str) -> DataFrame:
    """Status rows for which no later run has a row of the same version."""
    w = over(status, version).orderBy(F.col(run).desc())
    return status.withColumn("rk", F.rank().over(w)).filter("rk = 1").drop("rk")


def run_summary(status: DataFrame, run: str, entity: str) -> DataFrame:
    """Per run: rows by status, distinct entities, value totals, in one aggregation."""
    n = lambda s: F.sum((F.col("status") == s).cast("long")).alias(s.lower())
    return status.groupBy(run).agg(F.count("*").alias("rows"), F.countDistinct(entity).alias("entities"), *(n(s) for s in ("Pending", "InProgress", "Succeeded", "Failed", "Skipped")))


def watermark_audit(requests: DataFrame, runs: DataFrame, feed: list[str], order: str, today: Column, parts: int | None = None) -> DataFrame:
    """Each request to move a feed's mark, with ``before`` (the mark it found) and its verdict.

    ``requests`` has the feed, ``order``, mark (null: none asked), clear, rewind (permission to go back), run and note;
    ``runs`` has run, run_status and is_deleted. What a request alone decides is decided first: blank_feed,
    clear_and_mark, clear_without_note, rewind_without_note, future, run_unknown, run_not_advancing. Of the others,
    rewind goes back without permission and unattributed changes the mark with neither a run nor a note; the rest are
    accepted. Refused requests move nothing. A clear or a permitted mark begins a new segment of the running maximum, so
    each feed is one scan, however long its history.
    """
    noted, blank = F.length(F.trim(F.coalesce("note", F.lit("")))) > 0, lambda c: F.length(F.trim(F.coalesce(c, F.lit("")))) == 0
    known = runs.filter("not is_deleted").select(F.col("run").alias("__run"), F.col("run_status").alias("__status"))
    r = requests.join(known, F.col("run") == F.col("__run"), "left")
    clear, rewind, mark = F.coalesce("clear", F.lit(False)), F.coalesce("rewind", F.lit(False)), F.col("mark")
    alone = (
        F.when(blank(feed[0]) if len(feed) == 1 else blank(feed[0]) | blank(feed[1]), "blank_feed")
        .when(clear & mark.isNotNull(), "clear_and_mark")
        .when(clear & ~noted, "clear_without_note")
        .when(rewind & ~noted, "rewind_without_note")
        .when(mark > today, "future")
        .when(F.col("run").isNotNull() & F.col("__status").isNull(), "run_unknown")
        .when(F.col("run").isNotNull() & ~F.col("__status").isin("Running", "Succeeded"), "run_not_advancing")
    )
    r = r.withColumn("__alone", alone)
    moves = F.col("__alone").isNull() & (noted | F.col("run").isNotNull())
    reset = moves & (clear | (rewind & mark.isNotNull()))
    r = running_max(r, feed, [order], F.when(moves, mark), reset, "before", parts)
    new = F.when(clear, F.lit(None)).otherwise(F.coalesce(mark, F.col("before")))
    verdict = (
        F.when(F.col("__alone").isNotNull(), F.col("__alone"))
        .when(~rewind & (new < F.col("before")), "rewind")
        .when(~new.eqNullSafe(F.col("before")) & F.col("run").isNull() & ~noted, "unattributed")
        .otherwise("accepted")
    )
    return r.withColumn("verdict", verdict).drop("__alone", "__run", "__status")


def enumerate_plan(status: DataFrame, elements: DataFrame, keys: list[str], location: str = "location") -> DataFrame:
    """Each enumerated element with its action: insert as Pending, revive (reset to Pending), correct the location, or noop.

    A live row keeps its progress: only its location is ever corrected.
    """
    t, e = status.alias("t"), elements.alias("e")
    moved = ~F.col(f"t.{location}").eqNullSafe(F.col(f"e.{location}"))
    action = F.when(F.col("t.is_deleted").isNull(), "insert").when(F.col("t.is_deleted"), "revive").when(moved, "correct").otherwise("noop")
    fresh = F.col("t.is_deleted").isNull() | F.col("t.is_deleted")
    both = e.join(t, same(status, elements, keys, "t", "e"), "left")
    return both.select(
        *(F.col(f"e.{k}") for k in keys),
        F.col(f"e.{location}"),
        F.when(fresh, "Pending").otherwise(F.col("t.status")).alias("status"),
        F.when(~fresh, F.col("t.outcome")).alias("outcome"),
        F.when(fresh, 0).otherwise(F.col("t.attempts")).alias("attempts"),
        action.alias("action"),
    )


CAP_MS = 2_147_483_647  # of a derived duration


def progress(status: DataFrame, elements: DataFrame, keys: list[str], mode: str, now) -> DataFrame:
    """The live status rows that ``elements`` name after mode Attempt, Fail or Skip; Succeeded rows stay (written is false).

    Attempt sets the count, so that a repeat can't inflate it, and clears what the attempt before left;
    Fail derives the duration since the attempt began, if one did.
    """
    t, e = status.filter("not is_deleted").alias("t"), elements.alias("e")
    d = t.join(e, same(status, elements, keys, "t", "e"))
    open_ = F.col("t.status") != "Succeeded"
    since = F.least(F.unix_millis("__now") - F.unix_millis("t.attempt_started"), F.lit(CAP_MS)).cast("long")
    d = d.withColumn("__now", now)
    new = {
        "Attempt": {"status": F.lit("InProgress"), "attempts": F.col("e.attempt"), "http": F.lit(None).cast("int"), "outcome": F.col("t.outcome"), "duration": F.col("t.duration")},
        "Fail": {"status": F.lit("Failed"), "attempts": F.col("t.attempts"), "http": F.col("e.http"), "outcome": F.lit(None).cast("string"), "duration": F.when(F.col("t.attempt_started").isNotNull(), since)},
        "Skip": {"status": F.lit("Skipped"), "attempts": F.col("t.attempts"), "http": F.col("t.http"), "outcome": F.lit(None).cast("string"), "duration": F.col("t.duration")},
    }[mode]
    return d.select(*(F.col(f"t.{k}") for k in keys), *(F.when(open_, v).otherwise(F.col(f"t.{c}")).alias(c) for c, v in new.items()), open_.alias("written"))


def progress_counts(elements: DataFrame, after: DataFrame) -> DataFrame:
    """One row: elements, written, skipped_succeeded, not_found."""
    both = elements.select(F.lit(None).cast("boolean").alias("written")).unionByName(after.select("written"))
    n = lambda c, name: F.coalesce(F.sum(c.cast("long")), F.lit(0)).alias(name)
    found = both.agg(n(F.col("written").isNull(), "elements"), n(F.col("written"), "written"), n(~F.col("written"), "skipped_succeeded"))
    return found.withColumn("not_found", F.col("elements") - F.col("written") - F.col("skipped_succeeded"))


#: What a status row holds of its progress, besides its key.
PROGRESS = ["location", "status", "outcome", "attempts", "http", "error_code", "error_message", "error_id", "error_date", "source_id", "payload_sha256", "first_seen", "attempt_started", "completed", "duration_ms"]
ERRORS = ["http", "error_code", "error_message", "error_id", "error_date"]
MODES = {"Enumerate": 0, "Attempt": 1, "Fail": 2, "Skip": 3}  # in the order in which a flush applies them


def _ordered(events: DataFrame, keys: list[str]) -> DataFrame:
    """A journal's events as its flushes write them: of each flush the last one of a key and mode, and their place ``pos`` in the replay."""
    last = fold(events, [*keys, "flush"], "mode", "seq")
    rank = F.create_map(*(F.lit(x) for kv in MODES.items() for x in kv))[F.col("mode")]
    return last.withColumn("pos", F.col("flush") * len(MODES) + rank)


def _begun(status: DataFrame, events: DataFrame, keys: list[str]) -> DataFrame:
    """Per key: where its row's life begins (``born``: before all events if it is live, else its first Enumerate) and whether it is ``absorbed``.

    Succeeded absorbs: no later attempt, failure or skip changes a live row that has succeeded.
    """
    firsts = grouped(events, keys, F.min(F.when(F.col("mode") == "Enumerate", F.col("pos"))).alias("first_enumerated"))
    s = status.select(*keys, F.lit(True).alias("stored"), "is_deleted", F.col("status").alias("was"))
    d = joined(firsts, s, keys, "left")
    live = F.coalesce(~F.col("is_deleted"), F.lit(False))
    return d.select(*keys, live.alias("live"), F.when(live, -1).otherwise(F.col("first_enumerated")).alias("born"), (live & (F.col("was") == "Succeeded")).alias("absorbed"))


def verdicts(status: DataFrame, events: DataFrame, keys: list[str]) -> DataFrame:
    """Every event that a flush writes, with what becomes of it: written, skipped_succeeded or not_found."""
    e = _ordered(events, keys)
    d = joined(e, _begun(status, e, keys), keys)
    after = F.coalesce(F.col("pos") > F.col("born"), F.lit(False))
    enumerated = F.col("mode") == "Enumerate"
    verdict = F.when(enumerated, "written").when(~after, "not_found").when(F.col("absorbed"), "skipped_succeeded").otherwise("written")
    return d.withColumn("verdict", verdict).drop("live", "absorbed")


def replayed(status: DataFrame, events: DataFrame, keys: list[str]) -> DataFrame:
    """The status rows (key, all of PROGRESS, is_deleted) after a journal's events, as if applied one after the other.

    ``events`` has the key, flush, seq, mode, at, and what its mode brings: location, attempt, http and the error
    columns. A flush keeps the last event of a key and mode and applies Enumerate, Attempt, Fail, Skip in this order.
    Enumerate inserts a Pending row, begins a deleted one anew, and else corrects only the location. Attempt sets the
    count and start and clears the errors and the completion; Fail sets the errors, the completion and the time since the
    attempt began (capped; none without an attempt) and clears the outcome; Skip sets the completion and clears the outcome.

    Each column's value is that of the last event that sets it, so no task replays a key: all is by aggregates that
    merge in parts, and a key with very many events is never in one task. Only a failure's duration looks back, at the last
    attempt before the last failure, which a second aggregate finds.
    """
    e = _ordered(events, keys)
    begun = _begun(status, e, keys)
    d = joined(e, begun, keys).filter((F.col("pos") > F.col("born")) & ~((F.col("mode") != "Enumerate") & F.col("absorbed")) | (F.col("pos") == F.col("born")))
    m, last = F.col("mode"), lambda c, modes: F.max_by(F.when(c, F.struct("pos", "mode", "at", "attempt", *ERRORS)), F.when(c, F.col("pos"))).alias(modes)
    ends = grouped(
        d,
        keys,
        F.max("live").alias("live"),
        F.min(F.when(~F.col("live") & (F.col("pos") == F.col("born")), F.col("at"))).alias("reborn"),
        F.max_by(F.when(m == "Enumerate", F.col("location")), F.when(m == "Enumerate", F.col("pos"))).alias("new_location"),
        F.max(m == "Enumerate").alias("enumerated"),
        last(m != "Enumerate", "any"),
        last(m == "Attempt", "tried"),
        last(m.isin("Attempt", "Fail"), "told"),
        last(m == "Fail", "failed"),
        F.max(m.isin("Fail", "Skip")).alias("unset"),
    )
    tries = joined(d.filter(m == "Attempt").select(*keys, "pos", "at"), ends.select(*keys, F.col("failed.pos").alias("until")), keys).filter(F.col("pos") < F.col("until"))
    ends = joined(ends, grouped(tries, keys, F.max_by("at", "pos").alias("began")), keys, "left")

    s, x = status.alias("s"), ends.alias("x")
    kept = F.coalesce(F.col("x.live"), F.col("s.status").isNotNull())  # the stored values stay, where no event says otherwise
    old = lambda c, fresh=None: F.when(kept, F.col(f"s.{c}")).otherwise(fresh if fresh is not None else F.lit(None))
    any_, told, tried, failed = (F.col(f"x.{c}") for c in ("any", "told", "tried", "failed"))
    began = F.coalesce(F.col("x.began"), old("attempt_started"))
    taken = F.when(began.isNotNull(), F.least(F.unix_millis(failed["at"]) - F.unix_millis(began), F.lit(CAP_MS)).cast("int"))
    named = F.create_map(F.lit("Attempt"), F.lit("InProgress"), F.lit("Fail"), F.lit("Failed"), F.lit("Skip"), F.lit("Skipped"))[any_["mode"]]
    new = {
        "location": F.when(F.coalesce("x.enumerated", F.lit(False)), F.col("x.new_location")).otherwise(old("location")),
        "status": F.coalesce(named, old("status", F.lit("Pending"))),
        "outcome": F.when(~F.coalesce("x.unset", F.lit(False)), old("outcome")),
        "attempts": F.coalesce(tried["attempt"], old("attempts", F.lit(0))),
        **{c: F.when(told.isNull(), old(c)).when(told["mode"] == "Fail", told[c]) for c in ERRORS},
        "source_id": old("source_id"),
        "payload_sha256": old("payload_sha256"),
        "first_seen": old("first_seen", F.col("x.reborn")),
        "attempt_started": F.coalesce(tried["at"], old("attempt_started")),
        "completed": F.when(any_.isNull(), old("completed")).when(any_["mode"] != "Attempt", any_["at"]),
        "duration_ms": F.when(failed.isNull(), old("duration_ms")).otherwise(taken),
    }
    out = s.join(x, same(status, ends, keys, "s", "x"), "full_outer")
    deleted = F.when(F.col("x.live").isNull(), F.coalesce("s.is_deleted", F.lit(False))).otherwise(False)
    return out.select(*(F.coalesce(f"s.{k}", f"x.{k}").alias(k) for k in keys), *(v.alias(c) for c, v in new.items()), deleted.alias("is_deleted"))


#: Marks of a path that may carry more than a path.
UNSAFE_PATH = r"^[^/]|\?|#|://|@|/auth/"
NOTICE, WIDTH_NOTICE = "(withheld)", "(withheld: too long)"


def withheld(attempts: DataFrame) -> DataFrame:
    """``attempts`` with unsafe or over-wide paths and messages replaced by a notice, over-wide codes and ids nulled, and their number."""
    path, long = F.col("path"), lambda c, n: F.length(F.rtrim(F.col(c))) > n
    unsafe = F.lower(path).rlike(UNSAFE_PATH)  # whatever the case, as the system of record compares
    too_long = F.concat(F.lit("(withheld: "), F.length(F.rtrim(path)).cast("string"), F.lit(" characters)"))
    text = {c: F.when(F.lower(F.col(c)).contains("/auth/") | F.lower(F.col(c)).contains("/api/v1/auth"), NOTICE).when(long(c, 4000), WIDTH_NOTICE).otherwise(F.col(c)) for c in ("message", "failure")}
    code = {c: F.when(~long(c, n), F.col(c)) for c, n in (("error_code", 100), ("error_id", 50))}
    new = {"path": F.when(unsafe, NOTICE).when(long("path", 400), too_long).otherwise(path)} | text | code
    changed = sum((~F.col(c).eqNullSafe(v)).cast("int") for c, v in new.items())
    return attempts.select(*(c for c in attempts.columns if c not in new), changed.alias("withheld"), *(v.alias(c) for c, v in new.items()))
