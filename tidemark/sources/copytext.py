"""COPY text: tab-separated fields with backslash escapes, ``\\N`` for null."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.ship import ship

#: The single-letter escapes.
ESCAPES = {"b": "\b", "f": "\f", "n": "\n", "r": "\r", "t": "\t", "v": "\v", "\\": "\\"}
_ESCAPE = re.compile(rb"\\(x[0-9A-Fa-f]{1,2}|[0-7]{1,3}|.|$)", re.DOTALL)
_SINGLE = {k.encode(): v.encode() for k, v in ESCAPES.items()}


def unescape(field: str) -> str | None:
    r"""The value of a field; \N anywhere makes it null; an unknown escape is an error.
    Hex and octal escapes are bytes of the UTF-8 text."""
    if "\\" not in field:
        return field
    found: list[bytes] = []

    def value(m: re.Match) -> bytes:
        code = m[1]
        found.append(code)
        if code == b"N":
            return b""
        if len(code) > 1 and code[:1] == b"x":
            return bytes([int(code[1:], 16)])
        if code[:1].isdigit() and code[:1] < b"8":
            return bytes([int(code, 8) & 255])
        if code not in _SINGLE:
            raise ValueError(f"unknown escape in {field!r}")
        return _SINGLE[code]

    out = _ESCAPE.sub(value, field.encode())
    return None if b"N" in found else out.decode("utf-8", "replace")


def escape(value: str | None) -> str:
    if value is None:
        return "\\N"
    for char, code in (("\\", "\\\\"), *((v, f"\\{k}") for k, v in ESCAPES.items() if k != "\\")):
        value = value.replace(char, code)
    return value


def decode_line(line: str) -> list[str | None]:
    return [unescape(f) for f in line.removesuffix("\n").split("\t")]


def plain_field(field: Column) -> Column:
    """unescape() for fields without escapes of bytes and without NUL, in SQL functions: a NUL
    stands for the escaped backslash meanwhile."""
    text = F.replace(field, F.lit("\\\\"), F.lit("\0"))
    out = text
    for code, char in ESCAPES.items():
        if code != "\\":
            out = F.replace(out, F.lit("\\" + code), F.lit(char))
    wrong = F.raise_error(F.concat(F.lit("unknown escape in "), field)).cast("string")
    return F.when(text.contains("\\N"), None).when(out.contains("\\"), wrong).otherwise(F.replace(out, F.lit("\0"), F.lit("\\")))


def decode_lines(lines: DataFrame, n_columns: int) -> DataFrame:
    """``fields`` of each row of lines (value); a wrong number of fields is an error. Lines
    with hex or octal escapes, or with a NUL, alone go to Python."""
    ship(lines.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([decode_line(x) for x in batch.column(0).to_pylist()], pa.list_(pa.string()))], ["fields"])

    of_bytes = F.replace(F.col("value"), F.lit("\\\\"), F.lit("")).rlike(r"\\[x0-7]|\x00")
    plain = lines.where(~of_bytes).select(F.transform(F.split("value", "\t"), plain_field).alias("fields"))
    both = plain.unionByName(lines.where(of_bytes).select("value").mapInArrow(run, "fields array<string>"))
    wrong = F.raise_error(F.concat(F.lit(f"a line hasn't {n_columns} fields but "), F.size("fields"))).cast("array<string>")
    return both.select(F.when(F.size("fields") == n_columns, F.col("fields")).otherwise(wrong).alias("fields"))


def read_copy(spark: SparkSession, path: str, n_columns: int) -> DataFrame:
    return decode_lines(spark.read.option("lineSep", "\n").text(path), n_columns)
