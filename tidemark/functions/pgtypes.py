"""Source types: target type names, Spark types and cast expressions."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Target type of each source type.
TARGET_TYPES = {
    "smallint": "Int16", "integer": "Int32", "bigint": "Int64", "character varying": "String", "varchar": "String", "text": "String",
    "real": "Float32", "double precision": "Float64", "interval": "Int32", "boolean": "UInt8", "decimal": "Decimal", "numeric": "Decimal",
    "character": "FixedString", "char": "FixedString", "jsonb": "String", "json": "String", "uuid": "UUID", "bytea": "Array(UInt8)", "inet": "Int64",
    "timestamp": "DateTime", "timestamp with time zone": "DateTime", "timestamp without time zone": "DateTime", "date": "Date",
    "time": "UInt32", "time without time zone": "UInt32", "time with time zone": "UInt32",
}

SPARK_TYPES = {
    "smallint": "smallint", "integer": "int", "bigint": "bigint", "real": "float", "double precision": "double", "interval": "bigint",
    "boolean": "smallint", "bytea": "binary", "inet": "bigint", "timestamp": "timestamp_ntz", "timestamp with time zone": "timestamp",
    "timestamp without time zone": "timestamp_ntz", "date": "date", "time": "int", "time without time zone": "int", "time with time zone": "int",
}


#: Object ids of the source's own types and, where there is one, of their arrays.
TYPE_OIDS = {
    "boolean": (16, 1000), "bytea": (17, 1001), "bigint": (20, 1016), "smallint": (21, 1005), "integer": (23, 1007), "text": (25, 1009), "json": (114, 199),
    "real": (700, 1021), "double precision": (701, 1022), "inet": (869, 1041), "character": (1042, 1014), "character varying": (1043, 1015), "date": (1082, 1182),
    "time without time zone": (1083, 1183), "timestamp without time zone": (1114, 1115), "timestamp with time zone": (1184, 1185), "interval": (1186, 1187),
    "time with time zone": (1266, 1270), "numeric": (1700, 1231), "uuid": (2950, 2951), "jsonb": (3802, 3807),
}
_OF_OID = {oid: name + "[]" * i for name, oids in TYPE_OIDS.items() for i, oid in enumerate(oids)}


def type_name(oid: int) -> str:
    """The type of an object id; of types that aren't the source's own, text."""
    return _OF_OID.get(oid, "text")


def oid_number(v: Column) -> Column:
    """An object id from text: 32 bits without sign."""
    return unsigned(v, 32)


@dataclass(frozen=True)
class SourceType:
    base: str
    args: tuple[int, ...] = ()
    is_array: bool = False


def parse_source_type(text: str) -> SourceType:
    """``numeric(10,2)[]`` and the like."""
    is_array = text.endswith("[]")
    m = re.fullmatch(r"([^(]+)(?:\(([\d,\s]+)\))?(.*)", text.removesuffix("[]").strip())
    return SourceType((m[1] + m[3]).strip().lower(), tuple(int(x) for x in (m[2] or "").split(",") if x.strip()), is_array)


def target_type(t: SourceType, nullable: bool) -> str:
    """Unknown types are strings; decimals and fixed strings need their parameters."""
    name = TARGET_TYPES.get(t.base, "String")
    if name == "Decimal":
        if len(t.args) != 2:
            raise ValueError(f"{t.base} needs precision and scale")
        name = f"Decimal({t.args[0]}, {t.args[1]})"
    elif name == "FixedString":
        if len(t.args) != 1:
            raise ValueError(f"{t.base} needs a length")
        name = f"FixedString({t.args[0]})"
    if t.is_array:
        return f"Array({name})"
    return f"Nullable({name})" if nullable and not name.startswith("Array(") else name


def parse_target_type(text: str) -> tuple[str, bool, bool]:
    """Base name without parameters, is_array, is_nullable."""
    is_array = is_nullable = False
    if m := re.fullmatch(r"LowCardinality\((.*)\)", text):
        text = m[1]
    if m := re.fullmatch(r"Array\((.*)\)", text):
        text, is_array = m[1], True
    if m := re.fullmatch(r"Nullable\((.*)\)", text):
        text, is_nullable = m[1], True
    return re.sub(r"^(FixedString|Decimal)\(.*\)$", r"\1", text), is_array, is_nullable


def spark_type(t: SourceType) -> str:
    base = f"decimal({t.args[0]},{t.args[1]})" if t.base in ("decimal", "numeric") and len(t.args) == 2 else SPARK_TYPES.get(t.base, "string")
    return f"array<{base}>" if t.is_array else base


def time_seconds(v: Column) -> Column:
    """Seconds of the day; a fraction and an offset are dropped."""
    part = lambda i: F.regexp_extract(v, r"^(\d{1,2}):(\d{2}):(\d{2})", i).cast("int")
    return part(1) * 3600 + part(2) * 60 + part(3)


def inet_number(v: Column) -> Column:
    host = F.split(F.split(v, "/")[0], r"\.")
    return F.aggregate(host, F.lit(0).cast("bigint"), lambda a, x: a * 256 + x.cast("bigint"))


def interval_seconds(v: Column) -> Column:
    """``1 day 02:03:04`` and the like; months count 30 days, years 365.25."""
    amount = lambda unit: F.coalesce(F.try_to_number(F.nullif(F.regexp_extract(v, rf"(-?\d+) {unit}", 1), F.lit("")), F.lit("S999999999")), F.lit(0)).cast("bigint")
    clock = F.regexp_extract(v, r"(-?)(\d+):(\d{2}):(\d{2})", 0)
    piece = lambda i: F.coalesce(F.nullif(F.regexp_extract(v, r"(-?)(\d+):(\d{2}):(\d{2})", i), F.lit("")), F.lit("0")).cast("bigint")
    sign = F.when(clock.startswith("-"), -1).otherwise(1)
    days = amount("year") * F.lit(31557600) + amount("mon") * 2592000 + amount("day") * 86400
    return days + sign * (piece(2) * 3600 + piece(3) * 60 + piece(4))


def boolean_number(v: Column) -> Column:
    return F.when(v == "t", 1).when(v == "f", 0).when(v.isNotNull(), F.raise_error(F.concat(F.lit("not a boolean: "), v))).cast("smallint")


def unsigned(v: Column, bits: int) -> Column:
    """An unsigned number in the next wider type; out of range is an error."""
    wide = v.cast("decimal(38,0)")
    kind = {8: "smallint", 16: "int", 32: "bigint", 64: "decimal(20,0)"}[bits]
    return F.when((wide >= 0) & (wide < F.lit(str(2**bits)).cast("decimal(38,0)")), wide.cast(kind)).when(v.isNotNull(), F.raise_error(F.concat(F.lit("out of range: "), v)).cast(kind))


#: Items of an array's text: quoted ones, with escapes, or plain ones.
_ITEMS = r'"(?:[^"\\]|\\.)*"|[^,{}"]+'


def array_items(v: Column, item: SourceType, compat: bool = False) -> Column:
    """``{1,NULL,"a,b"}``: quoted items keep what they hold; arrays of arrays are an error."""
    flat = F.when(~F.substr(v, F.lit(2)).startswith("{"), v).when(v.isNotNull(), F.raise_error(F.concat(F.lit("an array of arrays: "), v)).cast("string"))
    items = F.regexp_extract_all(F.substr(flat, F.lit(2), F.length(flat) - 2), F.lit(f"(?s){_ITEMS}"), F.lit(0))
    quoted = lambda x: F.regexp_replace(F.substr(x, F.lit(2), F.length(x) - 2), r"(?s)\\(.)", "$1")
    text = lambda x: F.when(x.startswith('"'), quoted(x)).when(F.upper(x) != "NULL", x)
    return F.transform(items, lambda x: convert(text(x), item, compat))


#: Targets that are narrower than their source type, or without sign: bits.
UNSIGNED = {"UInt8": 8, "UInt16": 16, "UInt32": 32, "UInt64": 64}
_WHOLE = ("smallint", "integer", "bigint", "numeric", "decimal")


def to_target(v: Column, t: SourceType, target: str, compat: bool = False) -> Column:
    """Text to the type of an existing target column: whole numbers take the target's range,
    other values what their own type gives."""
    base, is_array, _ = parse_target_type(target)
    if not is_array and not t.is_array and t.base in _WHOLE:
        if base in UNSIGNED:
            return unsigned(v, UNSIGNED[base])
        if base == "Int8":
            return v.cast("tinyint")
    return convert(v, t, compat)


def convert(v: Column, t: SourceType, compat: bool = False) -> Column:
    """Text to typed value. compat keeps the lossy forms: decimals by way of
    doubles, times without fraction and offset."""
    if t.is_array:
        return array_items(v, SourceType(t.base, t.args), compat)
    if t.base == "boolean":
        return boolean_number(v)
    if t.base in ("time", "time without time zone", "time with time zone"):
        return time_seconds(v)
    if t.base == "inet":
        return inet_number(v)
    if t.base == "interval":
        return interval_seconds(v)
    if t.base == "bytea":
        return F.unhex(F.substr(v, F.lit(3)))
    if t.base == "date":
        return F.to_date(F.substr(v, F.lit(1), F.lit(10)))
    if t.base.startswith("timestamp"):
        if compat:
            return F.to_timestamp_ntz(F.substr(v, F.lit(1), F.lit(19)), F.lit("yyyy-MM-dd HH:mm:ss"))
        return v.cast(SPARK_TYPES[t.base])
    kind = spark_type(t)
    if kind.startswith("decimal") and compat:
        return v.cast("double").cast(kind)
    return v if kind == "string" else v.cast(kind)


def quoted_identifier(text: str) -> str:
    return '"' + text.replace('"', '""') + '"'


def not_null(v: Column, name: str) -> Column:
    return F.coalesce(v, F.raise_error(F.lit(f"null in column {name}, which allows none")))


def quote_literal(text: str) -> str:
    """An SQL literal; with backslashes it is an escape string."""
    quoted = text.replace("'", "''")
    return f" E'{quoted.replace(chr(92), chr(92) * 2)}'" if "\\" in quoted else f"'{quoted}'"
