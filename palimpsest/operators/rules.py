"""Rule tables for the rule runner (validate.rule_violations): a rule names what offends."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ATTEMPT_OUTCOMES = ("Succeeded", "Failed", "Throttled", "TimedOut", "Cancelled")
RUN_COUNTERS = ("enumerated", "fetched", "inserted", "updated", "unchanged", "soft_deleted", "skipped", "failed")


def _wider(widths: dict[str, int]) -> Column:
    return F.array_max(F.array(*(F.length(F.rtrim(F.col(c))) - w for c, w in widths.items()))) > 0


def summary_rules() -> dict[str, Column]:
    """Version summaries: a key that is there and fits, and a sequence of 0 or more."""
    blank = lambda c: F.col(c).isNull() | (F.trim(F.col(c)) == "")
    return {
        "handler_missing": blank("handler_id"),
        "type_missing": blank("source_type"),
        "key_too_wide": _wider({"handler_id": 12, "source_type": 1}),
        "sequence_negative": F.col("sequence").isNull() | (F.col("sequence") < 0),
    }


def status_rules(mode: str) -> dict[str, Column]:
    """Elements of one mode: Enumerate, Attempt, Fail or Skip."""
    rules = {"key_incomplete": F.col("handler_id").isNull() | F.col("source_type").isNull() | F.col("sequence").isNull()}
    rules["http_outside"] = ~F.col("http").between(100, 599)
    if mode == "Enumerate":
        rules["location_missing"] = F.col("location").isNull()
    if mode == "Attempt":
        rules["attempt_unusable"] = F.col("attempt").isNull() | (F.col("attempt") < 1)
    if mode == "Fail":
        rules["no_detail"] = F.col("http").isNull() & F.col("error_code").isNull() & F.col("error_message").isNull()
    return rules


def attempt_rules() -> dict[str, Column]:
    outcome, error = F.col("outcome"), F.col("error_code").isNotNull() | F.col("failure").isNotNull()
    return {
        "key_incomplete": F.col("handler_id").isNull() | F.col("attempt").isNull() | (F.col("attempt") < 1),
        "no_start": F.col("started").isNull(),
        "outcome_unknown": outcome.isNull() | ~outcome.isin(*ATTEMPT_OUTCOMES),
        "http_outside": ~F.col("http").between(100, 599),
        "negative": (F.col("duration") < 0) | (F.col("bytes") < 0) | (F.col("retry_after") < 0),
        "ends_before_start": F.col("completed") < F.col("started"),
        "success_with_error": (outcome == "Succeeded") & error,
        "failure_without_detail": outcome.isin("Failed", "Throttled", "TimedOut") & F.col("http").isNull() & ~error,
    }


def code_rules(width: int, located: bool, location_width: int = 2) -> dict[str, Column]:
    rules = {"code_missing": F.col("code").isNull() | (F.trim(F.col("code")) == ""), "code_too_wide": _wider({"code": width})}
    if located:
        rules |= {"location_missing": F.col("location").isNull(), "location_too_wide": _wider({"location": location_width})}
    return rules


def run_rules() -> dict[str, Column]:
    """What a closed run may not say of itself."""
    negative = F.lit(False)
    for c in RUN_COUNTERS:
        negative = negative | (F.coalesce(c, F.lit(0)) < 0)
    return {
        "succeeded_with_failures": (F.col("status") == "Succeeded") & (F.coalesce("failed", F.lit(0)) > 0),
        "failed_without_message": (F.col("status") == "Failed") & (F.coalesce(F.trim("message"), F.lit("")) == ""),
        "negative_counter": negative,
    }
