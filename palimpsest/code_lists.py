"""Code lists: the catalogue, their rules, and a refresh of any number of lists and their nested counties in one commit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StringType, StructType

from palimpsest.fieldmap import Field
from palimpsest.functions.keys import anti, semi
from palimpsest.operators import merge, shred, validate
from palimpsest.sources import buckets, workspace

# The lists, the width of their codes, and the last part of their address; whether an address takes a state.
WIDTHS = {
    **dict.fromkeys(("Accessibility", "EpisodicType", "GeneratorCategory", "HandlerSourceType", "HsmReason", "LandType", "LqgClosureType", "NonNotifier", "OtherPermit", "Relationship"), 1),
    **dict.fromkeys(("ContactType", "Country", "HsmFacilityCode", "HsmLandBasedUnit", "Language", "State"), 2),
    **{"County": 5, "EpisodicProject": 3, "Naics": 6, "StateActivity": 5, "StateDistrict": 10, "UniversalWaste": 10, "WasteCode": 6},
}
ADDRESSES = """Accessibility accessibility-codes, ContactType contact-types, Country countries, County counties, EpisodicProject episodic-projects, EpisodicType episodic-events,
    GeneratorCategory generator-categories, HandlerSourceType submittal-reasons, HsmFacilityCode hsm-facility-codes, HsmLandBasedUnit hsm-land-based-units, HsmReason hsm-reasons,
    LandType land-types, Language languages, LqgClosureType lqg-closure-types, Naics naics, NonNotifier non-notifiers, OtherPermit other-permit-types, Relationship relationships,
    State states, StateActivity state-activities, StateDistrict state-districts, UniversalWaste universal-waste-codes, WasteCode waste-codes"""
ADDRESS = dict(x.split() for x in ADDRESSES.split(","))
STATE_REQUIRED = {"ContactType", "County", "StateActivity", "StateDistrict", "UniversalWaste"}
STATE_OPTIONAL = {"GeneratorCategory", "WasteCode"}
NOT_LOCATED = {"Accessibility", "HandlerSourceType", "HsmLandBasedUnit", "HsmReason", "LandType", "LqgClosureType", "NonNotifier"}
WIDE = {"WasteCode": (4000, 50)}  # of description and code type; 255 and 10 elsewhere
DISTRICTS, COUNTY_WIDTH = "StateDistrict", 5

FIELDS = (
    Field("location", "$.activityLocation", width=2),
    Field("code", "$.code"),
    Field("description", "$.description"),
    Field("active", "$.active", "boolean"),
    Field("sort_order", "$.sortOrder", "bigint"),
    Field("industry_app", "$.industryApp", "boolean"),
    Field("br_load_active", "$.brLoadActive", "boolean"),
    Field("code_type", "$.codeType"),
    Field("acute", "$.acute", "boolean"),
    Field("episodic_location", "$.episodicType.activityLocation"),
    Field("episodic_code", "$.episodicType.code"),
    Field("episodic_description", "$.episodicType.description"),
    Field("episodic_active", "$.episodicType.active", "boolean"),
)
COUNTY = (Field("county_location", "$.activityLocation", width=2), Field("county_code", "$.code"), Field("county_description", "$.description"), Field("county_active", "$.active", "boolean"))
KEYS, OWNER = ["list_name", "location", "code"], ["location", "district"]
PAYLOAD = [f.column for f in FIELDS if f.column not in KEYS]
COUNTY_PAYLOAD = [f.column for f in COUNTY]


def _by_list(values: dict[str, int], otherwise: int) -> Column:
    return F.coalesce(F.create_map(*(F.lit(x) for kv in values.items() for x in kv))[F.col("list_name")], F.lit(otherwise))


def elements(found: DataFrame) -> DataFrame:
    """list_name, ordinal, the columns of FIELDS and ``v`` of every element of the lists' bodies (list_name, body)."""
    items = F.try_variant_get(F.try_parse_json("body"), "$", "array<variant>")
    each = found.select("list_name", F.posexplode(items).alias("ordinal", "v"))
    return each.select("list_name", "ordinal", *(shred.value(F.col("v"), f).alias(f.column) for f in FIELDS), "v")


def counties(rows: DataFrame) -> DataFrame:
    """location, district, ordinal, pos and the columns of COUNTY of the counties inside the districts."""
    own = rows.filter(F.col("list_name") == DISTRICTS).select("location", F.col("code").alias("district"), "ordinal", F.posexplode(F.try_variant_get("v", "$.counties", "array<variant>")).alias("pos", "c"))
    return own.select("location", "district", "ordinal", "pos", *(shred.value(F.col("c"), f).alias(f.column) for f in COUNTY))


def violations(rows: DataFrame) -> DataFrame:
    """(list_name, rule, n, first_ordinal): elements and nested counties that the rules of their list refuse."""
    wider = lambda c, w: F.length(F.rtrim(F.col(c))) > w
    rules = {
        "code_missing": F.col("code").isNull(),
        "location_missing": F.col("location").isNull() & ~F.col("list_name").isin(*NOT_LOCATED),
        "code_too_wide": wider("code", _by_list(WIDTHS, 0)),
        "location_too_wide": wider("location", 2),
        "description_too_wide": wider("description", _by_list({k: v[0] for k, v in WIDE.items()}, 255)),
        "code_type_too_wide": wider("code_type", _by_list({k: v[1] for k, v in WIDE.items()}, 10)),
        "unknown_list": ~F.col("list_name").isin(*WIDTHS),
    }
    nested = {"county_code_missing": F.col("county_code").isNull(), "county_too_wide": wider("county_code", COUNTY_WIDTH) | wider("county_location", 2) | wider("county_description", 255)}

    def broken(d: DataFrame, found: dict[str, Column]) -> DataFrame:
        names = F.array_compact(F.array(*(F.when(c, F.lit(name)) for name, c in found.items())))
        return d.select("list_name", "ordinal", F.explode(names).alias("rule"))

    both = broken(rows, rules).unionByName(broken(counties(rows).withColumn("list_name", F.lit(DISTRICTS)), nested))
    return both.groupBy("list_name", "rule").agg(F.count("*").alias("n"), F.min("ordinal").alias("first_ordinal"))


def create(spark: SparkSession, root: str, n: int = 16) -> None:
    """The tables of all lists and of the counties. A list's scope (list and location) is one bucket, for a full refresh looks at all of it."""
    none = spark.createDataFrame([], "v variant")
    own = {name: none.select(*(shred.value(F.col("v"), f).alias(f.column) for f in fields)).schema for name, fields in (("code", FIELDS), ("county", COUNTY))}
    deleted = StructType().add("is_deleted", BooleanType())
    code = StructType([*StructType().add("list_name", StringType()), *(own["code"][c] for c in ("location", "code", *PAYLOAD)), *deleted])
    buckets.create(spark, root, "code", code, ["list_name", "location"], n)
    county = StructType().add("location", StringType()).add("district", StringType()).add("pos", IntegerType())
    buckets.create(spark, root, "county", StructType([*county, *own["county"], *deleted]), ["location"], n)


def refresh(spark: SparkSession, root: str, found: DataFrame, full: list[str] | None = None) -> dict[str, DataFrame]:
    """Upsert the lists of ``found`` (list_name, body), all or none; those named in ``full`` (default: all) also lose what they no longer send.

    A refresh is refused whole, and nothing is published, where a body is no array, an element breaks a rule or has its key twice,
    a full list is empty, or a full list would retire more codes than it was given. Retirement is within the locations that
    the list sends; counties of retired districts go with them in either mode. Returns the plans of both tables.
    """
    bad = validate.array_check(found).filter("body_state <> 'array'").orderBy("list_name").limit(1).collect()
    if bad:
        raise validate.BatchRefused(f"{bad[0].list_name}: the body is {bad[0].body_state}")
    rows = workspace.written(elements(found), "code-elements")
    worst = violations(rows).orderBy("list_name", "rule").limit(1).collect()
    if worst:
        raise validate.BatchRefused(f"{worst[0].list_name}: {worst[0].rule}, first in element {worst[0].first_ordinal}, {worst[0].n} in all")
    whole = F.lit(True) if full is None else F.col("list_name").isin(*full)
    empty = anti(found.filter(whole).select("list_name"), rows, ["list_name"]).limit(1).collect()
    if empty:
        raise validate.BatchRefused(f"{empty[0].list_name}: a complete list is never empty")
    rows = rows.withColumn("location", F.coalesce("location", F.lit("")))  # lists without locations have one scope
    validate.refuse_duplicates(rows, KEYS)
    batch, nested = rows.select(*KEYS, *PAYLOAD), counties(rows)
    plans: dict[str, DataFrame] = {}

    def codes(t: DataFrame) -> DataFrame:
        up = merge.upsert_rows(t, batch, KEYS, PAYLOAD)
        there = semi(t.filter("not is_deleted").filter(whole), batch, ["list_name", "location"])
        gone = anti(there, batch, KEYS).withColumns({"is_deleted": F.lit(True), "action": F.lit("retire")})
        return up.unionByName(gone)

    def below(t: DataFrame) -> DataFrame:
        planned = plans["code"].filter(F.col("list_name") == DISTRICTS)
        others = anti(buckets.read(spark, root, "code").filter(F.col("list_name") == DISTRICTS), planned, KEYS)
        owner = lambda d, sent: d.select("location", F.col("code").alias("district"), "is_deleted", sent.alias("sent"))
        owners = owner(planned, F.col("action") != "retire").unionByName(owner(others, F.lit(False)))
        return merge.nested_code_rows(t, nested.drop("ordinal"), owners, OWNER, "pos", COUNTY_PAYLOAD, full is None or DISTRICTS in full)

    def guard(made: dict[str, DataFrame]) -> None:
        n = lambda c: F.count_if(c)
        over = made["code"].groupBy("list_name").agg(n(F.col("action") != "retire").alias("supplied"), n(F.col("action") == "retire").alias("retired")).filter("retired > supplied").limit(1).collect()
        if over:
            raise validate.BatchRefused(f"{over[0].list_name}: {over[0].retired} codes would be retired, {over[0].supplied} were sent")

    # Scopes, not keys, are what a full refresh may touch; a district's counties share its location.
    scopes, places = batch.select("list_name", "location").distinct(), batch.filter(F.col("list_name") == DISTRICTS).select("location").distinct()
    changes = {"code": buckets.Change(KEYS, scopes, codes), "county": buckets.Change([*OWNER, "pos"], places, below)}
    buckets.commit(spark, root, changes, counts=plans, guard=guard)
    return plans


def catalogue(spark: SparkSession) -> DataFrame:
    """list_name, address, code_width, located and state (required, optional, unsupported) of all lists: what A-3's files are named by."""
    state = lambda name: "required" if name in STATE_REQUIRED else "optional" if name in STATE_OPTIONAL else "unsupported"
    rows = [(name, ADDRESS[name], width, name not in NOT_LOCATED, state(name)) for name, width in WIDTHS.items()]
    return spark.createDataFrame(rows, "list_name string, address string, code_width int, located boolean, state string")
