"""Log positions: 64-bit numbers, as text ``X/Y`` or as 16 hex digits; 0 is invalid."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def from_text(text: str) -> int:
    """A position outside of a query; ``X/Y``."""
    high, _, low = text.partition("/")
    return (int(high, 16) << 32) + int(low, 16)


def parse_lsn(text: Column) -> Column:
    half = lambda i: F.conv(F.split(text, "/")[i], 16, 10).cast("bigint")
    return half(0) * F.lit(4294967296) + half(1)


def format_lsn(lsn: Column) -> Column:
    return F.concat(F.hex(F.shiftrightunsigned(lsn, 32)), F.lit("/"), F.hex(lsn.bitwiseAND(F.lit(4294967295))))


def parse_hex(text: Column) -> Column:
    return F.conv(text, 16, 10).cast("bigint")


def format_hex(lsn: Column) -> Column:
    return F.lower(F.lpad(F.hex(lsn), 16, "0"))


def is_valid(lsn: Column) -> Column:
    return lsn.isNotNull() & (lsn != 0)
