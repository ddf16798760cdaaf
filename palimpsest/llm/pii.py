"""Personal data by weak supervision.

Base spans (email, ip, card, phone) come from fixed patterns. Candidates for further spans are the
tokens with a digit. Regex, gazetteer and context labelers vote on every candidate and base span;
expectation-maximisation over the histogram of vote patterns estimates how reliable each labeler is,
and the posteriors train a naive Bayes span classifier on shape and context, which decides.
Native expressions only; what reaches the driver is bounded by the number of vote patterns and features.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.llm.common import bound, staged

#: The base patterns, written so that they scan long runs once: possessive loops, and starts inside a
#: run only right after a match (\G), as leftmost non-overlapping matching has it. A card run is matched
#: only where its digits are 12 to 19.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?+[0-9]){11,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
NEEDS = {"email": "%@%", "ip": None, "card": None, "phone": "%+%"}
KINDS = (*PATTERNS, "secret")
CANDIDATE = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*+"
CONTEXT = 24  # characters before a span that a labeler or the classifier looks at
ACCEPT = 0.5
BLOCK = 64  # matches that are summed together when positions are computed
CUT = 256  # characters of a block of the text; a substring is taken from its blocks, never by a scan from the start

#: Fixed values of the labelers: words that announce a secret, and openings of keys.
ANNOUNCE = r"(?i)(?:passwor[dt]|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|credential)"
OPENINGS = r"(?:AKIA|ASIA|ghp_|gho_|xox[bp]-|sk_live_|AIza|eyJ)"
HARMLESS = r"(?i)(?:version|v\.?|license|licence|by-nc|section|chapter|page|no\.)[\x20,:(]*$"


def spans(text: Column, kind: str) -> Column:
    """array<struct<start, end, value>> of all matches of a pattern, in code points."""
    return _located(text, PATTERNS[kind], F.contains(text, F.lit(NEEDS[kind].strip("%"))) if NEEDS[kind] else text.rlike("[0-9]"))


def _located(text: Column, pattern: str, needed: Column) -> Column:
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def placed(values: Column) -> Column:
        """Prefix sums of the lengths before and of the matches, in blocks: near-linear in the number of matches."""
        n, add = F.size(values), lambda a, x: a + x

        def with_gaps(gaps: Column) -> Column:
            steps = F.transform(values, lambda v, k: F.get(gaps, k) + F.length(v))
            return bound(steps, lambda steps: with_steps(gaps, steps))

        def with_steps(gaps: Column, steps: Column) -> Column:
            sums = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / BLOCK).cast("int")), lambda b: F.aggregate(F.slice(steps, b * BLOCK + 1, F.lit(BLOCK)), F.lit(0), add))
            firsts = F.aggregate(sums, F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<int>)").alias("out")), lambda acc, x: F.struct((acc["at"] + x).alias("at"), F.array_append(acc["out"], acc["at"]).alias("out")), lambda acc: acc["out"])
            return bound(firsts, lambda firsts: with_firsts(gaps, steps, firsts))

        def with_firsts(gaps: Column, steps: Column, firsts: Column) -> Column:
            def one(v: Column, k: Column) -> Column:
                block = F.floor(k / BLOCK).cast("int")
                start = F.get(firsts, block) + F.aggregate(F.slice(steps, block * BLOCK + 1, k % BLOCK), F.lit(0), add) + F.get(gaps, k)
                return F.struct(start.alias("start"), (start + F.length(v)).alias("end"), v.alias("value"))

            return F.transform(values, one)

        return bound(F.transform(F.split(text, pattern, -1), F.length), with_gaps)

    # The one-element transform binds the matches, so that they are looked for once.
    return F.when(needed, F.get(F.transform(F.array(found), lambda v: F.when(F.size(v) > 0, placed(v))), F.lit(0)))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    d = F.reverse(_digits(value))

    def weight(k: Column) -> Column:
        x = F.substring(d, k + 1, F.lit(1)).cast("int")
        return F.when(k % 2 == 0, x).otherwise(x * 2 - F.when(x > 4, 9).otherwise(0))

    return F.aggregate(F.transform(F.sequence(F.lit(0), F.length(d) - 1), weight), F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: str, s: Column) -> Column:
    value = s["value"]
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: F.ltrim(p, F.lit("0")).rlike(r"^(?:|[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        return F.length(_digits(value)).between(12, 19) & _luhn(value)
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def _spans_of_kind(text: Column, kind: str) -> Column:
    rank = KINDS.index(kind)
    kept = F.filter(spans(text, kind), lambda s: _valid(kind, s))
    made = F.transform(kept, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("kind"), s["end"].alias("end"), s["value"].alias("value")))
    return F.coalesce(made, F.expr("cast(array() as array<struct<start:int,kind:int,end:int,value:string>>)"))


def _upto(spans_of_kind: Column, field: str, x: Column) -> Column:
    """How many spans have ``field`` <= x, by bisection; the spans of one kind ascend in start and end alike."""

    def halved(acc: Column, _: Column) -> Column:
        mid = F.shiftright(acc["lo"] + acc["hi"], 1)
        right = F.get(spans_of_kind, mid)[field] <= x
        return F.when(acc["lo"] >= acc["hi"], acc).when(right, F.struct((mid + 1).alias("lo"), acc["hi"].alias("hi"))).otherwise(F.struct(acc["lo"].alias("lo"), mid.alias("hi")))

    n = F.size(spans_of_kind)
    return F.aggregate(F.sequence(F.lit(1), F.length(F.bin(n))), F.struct(F.lit(0).alias("lo"), n.alias("hi")), halved, lambda acc: acc["lo"])


def _cut(text: Column) -> Column:
    """The text in blocks of CUT code points."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CUT}}}"), F.lit(0))


def _part(cut: Column, start: Column, end: Column) -> Column:
    """Code points start (from 0) to end of the text whose blocks are ``cut``; its cost goes by the part's length."""
    first, last = F.floor(start / CUT).cast("int"), F.floor((end - 1) / CUT).cast("int")
    return F.when(end <= start, "").otherwise(F.substring(F.array_join(F.slice(cut, first + 1, last - first + 1), ""), start % CUT + 1, end - start))


def _votes(value: Column, before: Column, is_base: Column) -> dict[str, Column]:
    """Each labeler says 1 (personal or secret), 0 (harmless) or nothing (2)."""
    vote = lambda yes, no: F.when(yes, 1).when(no, 0).otherwise(2)
    long = value.rlike(r"[A-Za-z0-9+/]{16}")
    return {
        "regex": vote(is_base | value.rlike(r"[0-9a-f]{20}|[0-9A-Z]{16}"), value.rlike(r"^[^0-9A-Za-z]*[0-9]{1,4}[^0-9A-Za-z]*$")),
        "gazetteer": vote(value.rlike(OPENINGS) | value.rlike(ANNOUNCE) | value.rlike(r"@[a-z0-9-]+\.(?:example|com|org|net)"), F.lit(False)),
        "context": vote(before.rlike(ANNOUNCE + r"[\x20:=\"']*$"), before.rlike(HARMLESS)),
        "mixture": vote(value.rlike("[0-9].*[A-Za-z].*[0-9]") & long, ~value.rlike("[0-9].*[0-9].*[0-9].*[0-9]")),
        "length": vote(F.length(_digits(value)) >= 9, F.length(value) < 7),
    }


LABELERS = ("regex", "gazetteer", "context", "mixture", "length")


def _features(value: Column, before: Column) -> list[Column]:
    """What the classifier sees: nothing that a labeler says, only the look of the span and its surroundings."""
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace(value, "[a-z]+", "a"), "[A-Z]+", "A"), "[0-9]+", "9")
    last = F.lower(F.regexp_extract(before, r"([A-Za-z]+)[^A-Za-z]*$", 1))
    return [
        F.concat(F.lit("s"), F.pmod(F.xxhash64(F.left(shape, F.lit(12))), F.lit(64)).cast("string")),
        F.concat(F.lit("l"), F.least(F.length(value), F.lit(48)).cast("string")),
        F.concat(F.lit("d"), F.least(F.length(_digits(value)), F.lit(24)).cast("string")),
        F.concat(F.lit("c"), F.pmod(F.xxhash64(last), F.lit(64)).cast("string")),
        F.concat(F.lit("p"), F.when(F.length(value) > 0, F.left(value, F.lit(1)).rlike("[0-9]").cast("string")).otherwise("")),
    ]


def located(docs: DataFrame, *keep: str) -> DataFrame:
    """base (valid base spans, sorted) and candidates (span, votes, features) of every text, beside the columns ``keep``."""
    d = docs.select(*keep, F.coalesce("text", F.lit("")).alias("text"))
    for kind in PATTERNS:
        d = d.withColumn(f"k_{kind}", _spans_of_kind(F.col("text"), kind))
    d = d.withColumn("base", F.array_sort(F.concat(*(F.col(f"k_{k}") for k in PATTERNS))))
    d = d.withColumn("tokens", _located(F.col("text"), CANDIDATE, F.col("text").rlike("[0-9]"))).withColumn("cut", _cut(F.col("text")))

    def covered(s: Column) -> Column:
        """A base span meets ``s``: of each kind, only the first that ends behind its start can."""
        out = F.lit(False)
        for kind in PATTERNS:
            own = F.col(f"k_{kind}")
            out = out | ((F.size(own) > 0) & F.coalesce(F.get(own, _upto(own, "end", s["start"]))["start"] < s["end"], F.lit(False)))
        return out

    def judged(is_base: bool) -> Callable[[Column], Column]:
        def one(s: Column) -> Column:
            before = _part(F.col("cut"), F.greatest(s["start"] - CONTEXT, F.lit(0)), s["start"])
            votes = _votes(s["value"], before, F.lit(is_base))
            pattern = sum((votes[k] * 3**j for j, k in enumerate(LABELERS)), F.lit(0))
            return F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(is_base).alias("is_base"), pattern.alias("votes"), F.array(*_features(s["value"], before)).alias("features"))

        return one

    # Base spans stand beside the tokens, so that the labelers are judged on both.
    free = F.filter(F.coalesce("tokens", F.expr("cast(array() as array<struct<start:int,end:int,value:string>>)")), lambda s: ~covered(s))
    candidates = F.concat(F.transform("base", judged(True)), F.transform(free, judged(False)))
    return d.select(*keep, F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))).alias("base"), candidates.alias("candidates"))


def reliabilities(histogram: dict[int, int], rounds: int = 50) -> tuple[dict[int, float], dict[str, tuple[float, float]]]:
    """(posterior of each vote pattern, each labeler's share of right votes on personal and on harmless spans) by EM.

    The start takes labelers to be right in 8 of 10 votes, which also says which class is which.
    """
    right, prior = {k: [0.8, 0.8] for k in LABELERS}, 0.5
    digits = {p: [(p // 3**j) % 3 for j in range(len(LABELERS))] for p in histogram}
    posterior: dict[int, float] = {}
    for _ in range(rounds):
        for p, votes in digits.items():
            odds = math.log(prior / (1 - prior))
            for k, v in zip(LABELERS, votes):
                a, b = right[k]
                odds += math.log(a / (1 - b)) if v == 1 else math.log((1 - a) / b) if v == 0 else 0.0
            posterior[p] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
        total = sum(histogram.values())
        prior = min(0.99, max(0.01, (1 + sum(n * posterior[p] for p, n in histogram.items())) / (2 + total)))
        for j, k in enumerate(LABELERS):
            seen = [(p, n, digits[p][j]) for p, n in histogram.items() if digits[p][j] != 2]
            for c in (0, 1):
                w = [(n * (posterior[p] if c == 0 else 1 - posterior[p]), v) for p, n, v in seen]
                hits = sum(x for x, v in w if v == 1 - c)
                right[k][c] = min(0.99, max(0.51, (4 + hits) / (5 + sum(x for x, _ in w))))
    return posterior, {k: tuple(v) for k, v in right.items()}


def classifier(found: DataFrame) -> dict[str, float]:
    """Log odds by feature (and "" for the prior) of a naive Bayes classifier fitted to the posteriors of all candidates."""
    c = found.select(F.explode("candidates").alias("c")).select("c.votes", "c.features")
    # Patterns are 3**labelers at most, features a few hundred: both bounded.
    histogram = {r.votes: r.n for r in c.groupBy("votes").agg(F.count("*").alias("n")).collect()}
    if not histogram:
        return {"": -30.0}
    posterior, _ = reliabilities(histogram)
    odds = F.create_map(*(F.lit(x) for p, v in posterior.items() for x in (p, v)))
    weighted = c.select("votes", F.explode("features").alias("feature")).groupBy("votes", "feature").agg(F.count("*").alias("n")).withColumn("p", odds[F.col("votes")])
    rows = weighted.groupBy("feature").agg(F.sum(F.col("n") * F.col("p")).alias("yes"), F.sum(F.col("n") * (1 - F.col("p"))).alias("no")).collect()
    yes, no = (sum(histogram[p] * (v if c else 1 - v) for p, v in posterior.items()) for c in (1, 0))
    out = {r.feature: math.log((r.yes + 0.5) / (yes + 1)) - math.log((r.no + 0.5) / (no + 1)) for r in rows}
    return out | {"": math.log((yes + 1) / (no + 1))}


def decided(found: DataFrame, weights: dict[str, float]) -> DataFrame:
    """``found`` with all_spans in place of the candidates: the base spans, and what the classifier accepts, sorted."""
    table = F.create_map(*(F.lit(x) for k, v in weights.items() for x in (k, float(v))))
    bar = math.log(ACCEPT / (1 - ACCEPT))

    def accepted(c: Column) -> Column:
        odds = F.aggregate(c["features"], F.lit(float(weights[""])), lambda a, f: a + F.coalesce(table[f], F.lit(0.0)))
        return ~c["is_base"] & (odds > bar)

    added = F.transform(F.filter("candidates", accepted), lambda c: F.struct(c["start"].alias("start"), F.lit(KINDS.index("secret")).alias("kind"), c["end"].alias("end")))
    return found.withColumn("all_spans", F.array_sort(F.concat("base", added))).drop("candidates")


def _listed(spans_column: str) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans_column, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans and n_secret of every row of ``docs``.

    Positions count code points, ends are exclusive. Null and empty texts have no spans; repeated
    rows and null ids are rows like any others; extra columns are ignored; an empty table gives no rows.
    """
    found = staged(located(docs, "doc_id"), "spans")
    counts = [_count(k).cast("long").alias(f"n_{kind}") for k, kind in enumerate(PATTERNS)]
    listed = F.sha2(_listed("base").cast("binary"), 256).alias("base_sha256"), _listed("all_spans").alias("spans")
    return decided(found, classifier(found)).select("doc_id", *counts, *listed, F.size(_of_kind("all_spans", len(PATTERNS))).cast("long").alias("n_secret"))


def _of_kind(column: str, kind: int) -> Column:
    return F.filter(column, lambda s: s["kind"] == kind)


def _count(kind: int) -> Column:
    return F.size(_of_kind("base", kind))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; overlapping spans become one, named by the first. Null texts stay null."""
    columns = [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]
    d = docs.select(F.struct(*columns).alias("__row"), F.coalesce("text", F.lit("")).alias("text"))
    found = staged(located(d, "__row"), "located")
    d = decided(found, classifier(found)).withColumn("cut", _cut(F.coalesce("__row.text", F.lit(""))))
    for kind in range(len(KINDS)):
        d = d.withColumn(f"k{kind}", _of_kind("all_spans", kind))
    names = F.array(*map(F.lit, KINDS))

    def reached(s: Column) -> Column:
        """The end of all spans that stand before ``s`` in the list."""
        ends = []
        for kind in range(len(KINDS)):
            own = F.col(f"k{kind}")
            before = F.when(F.lit(kind) < s["kind"], s["start"]).otherwise(s["start"] - 1)
            ends.append(F.coalesce(F.get(own, _upto(own, "start", before) - 1)["end"], F.lit(0)))
        return F.greatest(*ends)

    def one(s: Column, at: Column) -> Column:
        mark = F.when(s["start"] >= at, F.concat(F.lit("["), F.upper(F.get(names, s["kind"])), F.lit("]"))).otherwise(F.lit(""))
        return F.concat(_part(F.col("cut"), at, s["start"]), mark)

    parts = F.array_join(F.transform("all_spans", lambda s: bound(reached(s), lambda at: one(s, at))), "")
    rest = _part(F.col("cut"), F.array_max(F.transform("all_spans", lambda s: s["end"])), F.length("__row.text"))
    d = d.withColumn("clean", F.when(F.size("all_spans") > 0, F.concat(parts, rest)).otherwise(F.col("__row.text")))
    quoted = {c: F.col("__row.`" + c.replace("`", "``") + "`") for c in docs.columns}
    return d.select(*(F.col("clean").alias(c) if c == "text" else v.alias(c) for c, v in quoted.items()))
