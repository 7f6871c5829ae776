"""Applying a stream of changes to a log: idempotent batches, state, buffer, handoff.

A table's position is the last commit that its log holds for good. A batch keeps the
changes beyond it, writes them as a folder named by the last commit among them, and
moves the position last. Folders beyond the position are what an attempt that failed
has left; they are deleted before the next one writes, and no reader looks at them. So
batches may be repeated, cut otherwise, or numbered anew by another checkpoint: only
positions count, and the source is acknowledged after they have moved.

With a buffer, batches go to a staging folder first and move to the log, in arrival
order, once there are ``flush_threshold`` of them, or on a flush.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tidemark.operators.changes import with_generation
from tidemark.operators.engines import AppendEngine, CollapsingEngine, ReplacingEngine, after_truncates
from tidemark.sources.files import Files

PROTECTED = "table_lsn_"


class State:
    """Small key/value state on one file: positions of tables, the generation, user keys."""

    def __init__(self, path: str, files: Files) -> None:
        self.path, self._files = path, files

    def read(self) -> dict[str, str]:
        text = self._files.read(self.path)
        return {} if text is None else json.loads(text)

    def update(self, **values: str) -> None:
        self._files.write(self.path, json.dumps(self.read() | values))

    def table_lsn(self, table: str) -> int | None:
        lsn = self.read().get(PROTECTED + table)
        return None if lsn is None else int(lsn, 16)

    def command(self, *words: str) -> str | int | None:
        """ping, quit, set, get, keys, exists, del, pause, resume; positions can't be set or deleted."""
        name, args = words[0].lower(), words[1:]
        arity = {"ping": 0, "quit": 0, "set": 2, "get": 1, "exists": 1, "del": 1}
        if name in ("keys", "pause", "resume"):
            return "OK"
        if name not in arity:
            raise ValueError(f"there is no command {words[0]!r}")
        if len(args) != arity[name]:
            raise ValueError(f"{name} takes {arity[name]} arguments, not {len(args)}")
        values = self.read()
        if name == "ping":
            return "PONG"
        if name == "get":
            return values.get(args[0])
        if name == "exists":
            return int(args[0] in values)
        if name in ("set", "del"):
            if args[0].startswith(PROTECTED):
                raise ValueError("positions are protected")
            if name == "set":
                self.update(**{args[0]: args[1]})
                return "OK"
            found = int(values.pop(args[0], None) is not None)
            self._files.write(self.path, json.dumps(values))
            return found
        return "OK"


class LogTable:
    """The log of one table under a folder, and its current state. Counters of what was
    applied (commands, rows, flushes) are kept with the position."""

    def __init__(self, spark: SparkSession, path: str, table: str, engine: AppendEngine | ReplacingEngine | CollapsingEngine, buffered: bool = False, flush_threshold: int = 0) -> None:
        self.spark, self.path, self.table, self.engine, self.buffered, self.flush_threshold = spark, path, table, engine, buffered, flush_threshold
        self.files = Files(spark)
        self.state = State(f"{path}/state.json", self.files)

    def _put(self, df: DataFrame, name: str, through: int) -> None:
        if name == "log" and self.engine.keys:  # as the target's sort key, so that readers skip by key
            df = df.sortWithinPartitions(*self.engine.keys, "commit_lsn", "seq", "sub")
        df.write.mode("overwrite").parquet(f"{self.path}/{name}/through={through}")

    def _clear(self, name: str, beyond: int) -> None:
        for folder in self.files.names(f"{self.path}/{name}"):
            if folder.startswith("through=") and int(folder.partition("=")[2]) > beyond:
                self.files.delete(f"{self.path}/{name}/{folder}")

    def _read(self, name: str, upto: int) -> DataFrame | None:
        found = [f for f in self.files.names(f"{self.path}/{name}") if f.startswith("through=") and int(f.partition("=")[2]) <= upto]
        return self.spark.read.parquet(*(f"{self.path}/{name}/{f}" for f in found)) if found else None

    def position(self) -> int | None:
        """The last commit that is durable here, in the log or in the buffer."""
        state = self.state.read()
        found = [int(state[k], 16) for k in (PROTECTED + self.table, "buffer_lsn") if k in state]
        return max(found, default=None)

    def _move(self, to: int, **counted: int) -> None:
        state = self.state.read()
        values = {k: str(int(state.get(k, 0)) + n) for k, n in counted.items()}
        self.state.update(**{"buffer_lsn" if self.buffered else PROTECTED + self.table: f"{to:016x}"}, **values)

    def sync(self, snapshot: DataFrame, lsn: int, skip: bool = False, keep: bool = False) -> bool:
        """The initial rows, once: a table with a position isn't copied again. They are changes of
        op I with position 0 and generation 0, so the stream's versions win. skip: the position
        alone; keep: rows that the log holds already stay. They never take the way of the buffer:
        one write is as whole without it."""
        if self.position() is not None:
            return False
        if not skip:
            if not keep:
                for name in ("log", "truncates", "buffer"):
                    self.files.delete(f"{self.path}/{name}")
            zero = lambda c: F.lit(0).cast("bigint").alias(c)
            nothing = [F.lit(None).cast(snapshot.schema[c].dataType).alias(f"old_{c}") for c in self.engine.columns]
            rows = self.engine.rewrite(snapshot.select(zero("commit_lsn"), zero("seq"), F.lit("I").alias("op"), *(F.col(c).alias(f"new_{c}") for c in self.engine.columns), *nothing, *map(zero, self.engine.extra)))
            self._put(rows, "log", lsn)
        self.state.update(**{PROTECTED + self.table: f"{lsn:016x}", "generation_id": "1"})
        return True

    def apply(self, changes: DataFrame, batch_id: int | None = None) -> None:
        """One batch of whole transactions of this table. Its number doesn't matter."""
        base = self.position() or 0
        for name in ("buffer" if self.buffered else "log", "truncates"):
            self._clear(name, base)
        fresh = changes.where(F.col("commit_lsn") > base).persist()
        try:
            found = fresh.agg(F.max("commit_lsn").alias("last"), F.count_distinct("commit_lsn").alias("commits"), F.count("*").alias("n"), F.count_if(F.col("op") == "T").alias("truncates")).first()
            if not found.n:
                return
            rows = fresh
            if self.engine.extra and self.engine.extra[0] not in changes.columns:
                rows = with_generation(fresh, int(self.state.read().get("generation_id", 0))).withColumnRenamed("generation", self.engine.extra[0])
            self._put(self.engine.rewrite(rows.where("op <> 'T'")), "buffer" if self.buffered else "log", found["last"])
            if found.truncates:
                self._put(fresh.where("op = 'T'").select("commit_lsn", "seq"), "truncates", found["last"])
        finally:
            fresh.unpersist()
        self._move(found["last"], commands=found.n, generation_id=found.commits, batches=1)
        if self.buffered and len(self.files.names(f"{self.path}/buffer")) >= max(1, self.flush_threshold):
            self.flush()

    def advance(self, to: int) -> None:
        """Nothing up to this commit concerns the table."""
        if to > (self.position() or 0) and not self.files.names(f"{self.path}/buffer"):
            self.state.update(**{PROTECTED + self.table: f"{to:016x}"})

    def flush(self) -> None:
        """Moves what the buffer holds to the log, in arrival order."""
        done, upto = self.state.table_lsn(self.table) or 0, self.position() or 0
        rows = self._read("buffer", upto) if self.buffered else None
        if rows is not None:
            self._clear("log", done)
            self._put(rows.orderBy("commit_lsn", "seq", "sub"), "log", upto)
            self.state.update(**{PROTECTED + self.table: f"{upto:016x}", "flushes": str(int(self.state.read().get("flushes", 0)) + 1)})
            self.files.delete(f"{self.path}/buffer")

    def log(self) -> DataFrame:
        upto = self.state.table_lsn(self.table) or 0
        rows, truncates = self._read("log", upto), self._read("truncates", upto)
        if rows is None:
            raise ValueError("nothing has been written")
        return rows if truncates is None else after_truncates(rows, truncates)

    def current(self) -> DataFrame:
        rows = self.log()
        if isinstance(self.engine, ReplacingEngine):
            return self.engine.current(rows, "ver" if "ver" in rows.columns else self.engine.extra[0])
        return self.engine.current(rows)


def start(changes: DataFrame, target: LogTable, checkpoint: str, once: bool = True, every: str = "60 seconds") -> StreamingQuery:
    writer = changes.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda df, i: target.apply(df, i))
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)).start()
