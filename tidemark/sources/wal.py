"""WAL captures: a folder of segments, and a batch and a streaming source over them.

A segment is a file of frames (8-byte position, 4-byte length, message) named by the
positions of its first and last commit. Transactions never span segments, and each
segment begins with the relation messages that are known by then, so segments are
read apart: a partition each, frame by frame, with one transaction in memory. A
position is resumed by skipping the segments that end before it.

The stream's batches end at the first commit with max_buffer_length changes or more; a
committed batch is acknowledged by a file beside the segments, after Spark has made it
durable, and a restarted stream looks on from there.
"""

from __future__ import annotations

import os
import struct
import sys
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from tidemark.functions import pgtypes
from tidemark.functions.pgtypes import type_name
from tidemark.sources import pgoutput
from tidemark.sources.pgoutput import Message, decode, encode
from tidemark.sources.ship import ship

CHANGE_SCHEMA = """commit_lsn bigint, xid bigint, commit_ts timestamp, seq bigint, op string, rel_oid bigint, schema_name string, table_name string,
 key_columns array<string>, column_names array<string>, column_types array<string>, old_row array<struct<kind: string, value: string>>, new_row array<struct<kind: string, value: string>>"""


def frame(lsn: int, m: Message) -> bytes:
    data = encode(m)
    return struct.pack(">QI", lsn, len(data)) + data


def write_capture(path: str, messages: Iterator[tuple[int, Message]], per_segment: int = 1 << 24) -> None:
    """Cuts the stream into segments of about so many bytes."""
    os.makedirs(path, exist_ok=True)
    relations: dict[int, tuple[int, Message]] = {}
    parts: list[bytes] = []
    size, first, last = 0, None, 0

    def flush() -> None:
        name = os.path.join(path, f"{first:016x}-{last:016x}.wal")
        with open(name + ".tmp", "wb") as f:
            f.writelines(parts)
        os.replace(name + ".tmp", name)

    for lsn, m in messages:
        parts.append(frame(lsn, m))
        size += len(parts[-1])
        if m.op == "R":
            relations[m.oid] = (lsn, m)
        elif m.op == "C":
            first, last = m.lsn if first is None else first, m.lsn
            if size >= per_segment:
                flush()
                parts, first, size = [frame(*r) for r in relations.values()], None, 0
    if first is not None:
        flush()


@dataclass(frozen=True)
class Segment:
    path: str
    first: int
    last: int


def segments(path: str, after: int = 0) -> list[Segment]:
    """Those with a commit beyond ``after``, in stream order."""
    found = (Segment(os.path.join(path, n), *(int(x, 16) for x in n.removesuffix(".wal").split("-"))) for n in os.listdir(path) if n.endswith(".wal"))
    return sorted((s for s in found if s.last > after), key=lambda s: s.first)


def frames(path: str) -> Iterator[tuple[int, bytes]]:
    with open(path, "rb") as f:
        while head := f.read(12):
            lsn, n = struct.unpack(">QI", head)
            yield lsn, f.read(n)


def changes(messages: Iterator[tuple[int, bytes]], after: int = 0, upto: int | None = None) -> Iterator[tuple]:
    """Change rows of whole transactions whose commit position lies beyond ``after`` and not beyond ``upto``."""
    relations: dict[int, Message] = {}
    own: list[tuple] = []
    begin = Message("B")
    cells = lambda t: None if t is None else [(c.kind, c.value) for c in t]
    for _, data in messages:
        op = chr(data[0])
        if op in "IUDT" and begin.lsn <= after:  # what is skipped needs no decoding
            continue
        m = decode(data)
        if op == "B":
            if upto is not None and m.lsn > upto:
                return
            begin, own = m, []
        elif op == "R":
            relations[m.oid] = m
        elif op in "IUDT":
            for oid in m.oids if op == "T" else (m.oid,):
                r = relations.get(oid, Message("R", oid=oid))
                own.append((begin.lsn, begin.xid, begin.time, len(own), op, oid, r.schema or "public", r.name, [c.name for c in r.columns if c.is_key], [c.name for c in r.columns], [type_name(c.type_oid) for c in r.columns], cells(m.old), cells(m.new)))
        elif op == "C" and m.lsn > after:
            yield from own
            own = []


class _Part(InputPartition):
    def __init__(self, path: str, after: int, upto: int | None) -> None:
        self.path, self.after, self.upto = path, after, upto


def _parts(path: str, after: int, upto: int | None) -> list[_Part]:
    return [_Part(s.path, after, upto) for s in segments(path, after) if upto is None or s.first <= upto] or [_Part("", after, upto)]


def _read(part: _Part) -> Iterator[tuple]:
    return changes(frames(part.path), part.after, part.upto) if part.path else iter(())


class _Batch(DataSourceReader):
    def __init__(self, path: str, start: int) -> None:
        self.path, self.start = path, start

    def partitions(self) -> list[InputPartition]:
        return _parts(self.path, self.start, None)

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        return _read(partition)


class _Stream(DataSourceStreamReader):
    def __init__(self, path: str, start: int, most: int) -> None:
        self.path, self.start, self.most = path, start, most
        self.at: int | None = None

    def _acknowledged(self) -> int:
        try:
            with open(os.path.join(self.path, "acknowledged")) as f:
                return int(f.read())
        except FileNotFoundError:
            return self.start

    def initialOffset(self) -> dict:
        self.at = self.start
        return {"lsn": self.start}

    def latestOffset(self) -> dict:
        """The first commit with enough changes; only the kinds of messages are looked at."""
        at = last = self._acknowledged() if self.at is None else self.at
        n = 0
        for s in segments(self.path, at):
            own = 0
            for _, data in frames(s.path):
                op = data[:1]
                if op == b"B":
                    own = 0
                elif op in (b"I", b"U", b"D"):
                    own += 1
                elif op == b"T":
                    own += struct.unpack_from(">I", data, 1)[0]
                elif op == b"C" and (lsn := decode(data).lsn) > at:
                    last, n = lsn, n + own
                    if n >= self.most:
                        self.at = last
                        return {"lsn": last}
        self.at = last
        return {"lsn": last}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self.at = max(self.at or 0, end["lsn"])
        return _parts(self.path, start["lsn"], end["lsn"])

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        return _read(partition)

    def commit(self, end: dict) -> None:
        beside = os.path.join(self.path, "acknowledged.tmp")
        with open(beside, "w") as f:
            f.write(str(end["lsn"]))
        os.replace(beside, os.path.join(self.path, "acknowledged"))


class WalDataSource(DataSource):
    """spark.read / readStream.format("wal_capture"); options path, start_lsn, max_buffer_length."""

    @classmethod
    def name(cls) -> str:
        return "wal_capture"

    def schema(self) -> str:
        return CHANGE_SCHEMA

    def _place(self) -> tuple[str, int]:
        return self.options["path"].removeprefix("file://"), int(self.options.get("start_lsn", 0))

    def reader(self, schema: object) -> DataSourceReader:
        return _Batch(*self._place())

    def streamReader(self, schema: object) -> DataSourceStreamReader:
        return _Stream(*self._place(), int(self.options.get("max_buffer_length", 1000)))


def register(spark: SparkSession) -> None:
    """Makes the format known to the session, and its code to the executors. The driver's own
    planners of a streaming source get no files, so what they need travels by value."""
    ship(spark)
    for module in (sys.modules[__name__], pgoutput, pgtypes):
        cloudpickle.register_pickle_by_value(module)
    spark.dataSource.register(WalDataSource)
