"""Column functions that several operators share."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def differs(a: str, b: str, columns: list[str]) -> Column:
    """Any of the columns IS DISTINCT FROM its namesake on the other side."""
    return reduce(Column.__or__, (~F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in columns), F.lit(False))


def payload_hash(text: Column) -> Column:
    """Upper-case SHA-256 of the text in UTF-16LE, as a hash over two-byte text has it."""
    return F.upper(F.sha2(F.encode(text, "UTF-16LE"), 256))


def lenient_boolean(v: Column) -> Column:
    """true/false/1/0, quoted or not; anything else is null."""
    s = F.lower(F.trim(v.cast("string")))
    return F.when(s.isin("true", "1"), True).when(s.isin("false", "0"), False)


DATE = r"^\d{4}-\d{2}-\d{2}$"
TIMESTAMP = r"^\d{4}-\d{2}-\d{2}[Tt ]\d{2}:\d{2}:\d{2}(\.\d{1,7})?([Zz]|[+-]\d{2}:?\d{2})?$"


def lenient_date(s: Column) -> Column:
    """The literal calendar date of yyyy-MM-dd or of a timestamp text; never shifted by an offset. Anything else is null."""
    s = F.trim(s)
    return F.when(s.rlike(DATE) | s.rlike(TIMESTAMP), F.try_to_date(F.left(s, F.lit(10)), "yyyy-MM-dd"))


def lenient_timestamp(s: Column) -> Column:
    """The instant of an RFC 3339 text or one with a basic offset (+0000); without an offset it is UTC, a date is its midnight."""
    s = F.upper(F.trim(s))
    full = F.when(s.rlike(DATE), F.concat(s, F.lit("T00:00:00"))).when(s.rlike(TIMESTAMP), s)
    zoned = F.regexp_replace(F.translate(full, " ", "T"), r"([+-]\d{2})(\d{2})$", "$1:$2")
    return F.try_to_timestamp(F.when(zoned.rlike(r"(Z|[+-]\d{2}:\d{2})$"), zoned).otherwise(F.concat(zoned, F.lit("Z"))))


#: Shapes that have a name.
NAMED_SHAPES = {
    "dddd-dd-dd": "yyyy-MM-dd",
    "dddd-dd-ddTdd:dd:dd": "yyyy-MM-ddTHH:mm:ss",
    "dddd-dd-ddTdd:dd:dd.ddd": "yyyy-MM-ddTHH:mm:ss.fff",
    "dddd-dd-ddTdd:dd:ddZ": "yyyy-MM-ddTHH:mm:ssZ",
    "dddd-dd-ddTdd:dd:dd.dddZ": "yyyy-MM-ddTHH:mm:ss.fffZ",
    "dddd-dd-ddTdd:dd:dd.ddd+dddd": "yyyy-MM-ddTHH:mm:ss.fff+ZZZZ",
    "dddd-dd-ddTdd:dd:dd.ddd+dd:dd": "yyyy-MM-ddTHH:mm:ss.fff+ZZ:ZZ",
    "dddd-dd-dd dd:dd:dd": "yyyy-MM-dd HH:mm:ss",
    "dd-dd-dddd": "MM-dd-yyyy",
}


def shape_mask(s: Column) -> Column:
    """A named format, else digits as d with the structure kept; other text as text(len=n)."""
    masked = F.regexp_replace(s, "[0-9]", "d")
    named = F.coalesce(F.create_map(*(F.lit(x) for kv in NAMED_SHAPES.items() for x in kv))[masked], masked)
    dated = F.concat(F.lit('"'), named, F.lit('"'))
    return F.when(s == "", "empty text").when(s.rlike(r"^[0-9TZtz:+.\x20-]+$"), dated).otherwise(F.concat(F.lit("text(len="), F.length(s).cast("string"), F.lit(")")))


def json_shape(token: Column) -> Column:
    """The shape of a raw JSON token: null, boolean, number, object, array, or the mask of a text."""
    inner = F.substring(token, F.lit(2), F.length(token) - 2)
    plain = F.when(token == "", "empty text").when(token == "null", "null").when(token.isin("true", "false"), "boolean")
    return plain.when(token.startswith("{"), "object").when(token.startswith("["), "array").when(token.startswith('"'), shape_mask(inner)).otherwise("number")
