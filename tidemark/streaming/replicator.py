"""Many tables in one stream: configured tables, their logs, one clock and one position.

A batch holds whole transactions of all tables. Each table's changes are typed by the
columns of the relation they came with, rewritten by the table's engine and appended to
its log. Generations number the transactions of the stream that concern a configured
table; they are counted from the position that the clock has reached, so a batch that
is repeated gets the same ones.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tidemark.functions.pgtypes import parse_source_type, spark_type
from tidemark.operators.changes import typed_row, with_generation
from tidemark.operators.engines import AppendEngine, CollapsingEngine, Engine, ReplacingEngine
from tidemark.plans.config import Config, TableConfig, mapping
from tidemark.sources.catalog import Catalog, Table
from tidemark.sources.copytext import read_copy
from tidemark.sources.files import Files
from tidemark.streaming.apply import LogTable, State

ENGINES = {"MergeTree": AppendEngine, "ReplacingMergeTree": ReplacingEngine, "CollapsingMergeTree": CollapsingEngine}


def seconds(text: str) -> int:
    """``1m30s``, ``10s``, ``2h``."""
    parts = re.findall(r"(\d+)([hms])", text)
    if not parts or "".join(n + u for n, u in parts) != text:
        raise ValueError(f"not a duration: {text!r}")
    return sum(int(n) * {"h": 3600, "m": 60, "s": 1}[u] for n, u in parts)


class Mapped:
    """One configured table: its mapping from source to target columns, its engine and its log."""

    def __init__(self, spark: SparkSession, name: tuple[str, str], config: TableConfig, table: Table, path: str, compat: bool) -> None:
        self.name, self.config, self.compat = name, config, compat
        names = mapping([c.name for c in table.columns], list(table.target) if table.target else list((config.columns or {c.name: c.name for c in table.columns}).values()), config.columns)
        if lost := [c.name for c in table.columns if c.pk and c.name not in names]:
            raise ValueError(f"key columns {lost} aren't mapped")
        self.columns = [c for c in table.columns if c.name in names]
        self.names, self.target = names, table.target
        keys = tuple(names[c.name] for c in sorted(self.columns, key=lambda c: c.pk) if c.pk)
        extra = (config.generation_column,) if config.generation_column else ()
        engine: Engine = ENGINES[config.engine](keys, tuple(names[c.name] for c in self.columns), compat, extra)
        self.log = LogTable(spark, path, ".".join(name), engine, bool(config.buffer_table), config.flush_threshold)

    def row(self, cells: Column, old: Column | None, names: Column | None) -> Column:
        columns = [(self.names[c.name], c.type, c.nullable) for c in self.columns]
        targets = [self.target[self.names[c.name]] for c in self.columns] if self.target else None
        return typed_row(cells, old, columns, self.compat, names, [c.name for c in self.columns], targets)

    def typed(self, changes: DataFrame) -> DataFrame:
        """commit_lsn, seq, op, old_<c> and new_<c> of this table's changes."""
        own = changes.where((F.col("schema_name") == self.name[0]) & (F.col("table_name") == self.name[1]))
        images = {"__old": F.when(F.col("old_row").isNotNull(), self.row(F.col("old_row"), None, F.col("column_names"))), "__new": F.when(F.col("new_row").isNotNull(), self.row(F.col("new_row"), F.col("old_row"), F.col("column_names")))}
        sides = [F.col(f"__{side}.{c}").alias(f"{side}_{c}") for side in ("old", "new") for c in self.log.engine.columns]
        return own.withColumns(images).select("commit_lsn", "seq", "op", *sides, *self.log.engine.extra)

    def snapshot(self, lines: DataFrame) -> DataFrame:
        """Typed rows of COPY text whose fields are this table's mapped columns, in source order;
        a null that the column doesn't allow is an error."""
        cells = F.transform("fields", lambda x: F.struct(F.when(x.isNull(), "n").otherwise("t").alias("kind"), x.alias("value")))
        return lines.select(self.row(cells, None, None).alias("r")).select("r.*")

    def empty(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([], ", ".join(f"`{self.names[c.name]}` {spark_type(parse_source_type(c.type))}" for c in self.columns))


class Replicator:
    def __init__(self, spark: SparkSession, config: Config, catalog: Catalog, compat: bool = False) -> None:
        catalog.check(config)
        self.spark, self.config, self.folder = spark, config, config.db_path
        self.tables = {name: Mapped(spark, name, t, catalog.tables[name], f"{self.folder}/{name[0]}.{name[1]}", compat) for name, t in config.tables.items()}
        self.state = State(f"{self.folder}/state.json", Files(spark))

    def min_lsn(self) -> int:
        """Where the stream has to begin: the least position of a configured table, 0 without one."""
        return min((p for t in self.tables.values() if (p := t.log.position())), default=0)

    def needs_sync(self) -> bool:
        return any(t.log.position() is None for t in self.tables.values())

    def sync(self, snapshots: dict[tuple[str, str], DataFrame | str], lsn: int) -> None:
        """The initial rows, taken at ``lsn``, of tables without a position: typed rows, or a path
        of COPY text. The clock moves on once."""
        done = False
        for name, t in self.tables.items():
            rows = snapshots.get(name, t.empty(self.spark))
            if isinstance(rows, str):
                rows = t.snapshot(read_copy(self.spark, rows, len(t.columns)))
            c = t.config
            done |= t.log.sync(rows, lsn, c.init_sync_skip, c.init_sync_skip_truncate)
        if done:
            self.state.update(generation_id=str(self.generation() + 1))

    def generation(self) -> int:
        return int(self.state.read().get("generation_id", 0))

    def apply(self, changes: DataFrame, batch_id: int | None = None) -> None:
        """One batch of whole transactions."""
        mine = F.lit(False)
        for schema, table in self.tables:
            mine = mine | ((F.col("schema_name") == schema) & (F.col("table_name") == table))
        own = changes.where(mine).persist()
        try:
            last = changes.agg(F.max("commit_lsn")).first()[0]
            if last is None:
                return
            clock_at, base = int(self.state.read().get("generation_lsn", "0"), 16), self.generation()
            dirty = {(r.schema_name, r.table_name) for r in own.select("schema_name", "table_name").distinct().collect()}  # configured tables at most
            if any(t.config.generation_column for t in self.tables.values()):
                numbered = with_generation(own.where(F.col("commit_lsn") > clock_at), base)
            else:
                numbered = own
            for name, t in self.tables.items():
                if name in dirty:
                    rows = numbered.withColumnRenamed("generation", t.config.generation_column) if t.config.generation_column else numbered
                    t.log.apply(t.typed(rows))
                t.log.advance(last)
            counted = own.where(F.col("commit_lsn") > clock_at).select("commit_lsn").distinct().count()
            self.state.update(generation_id=str(base + counted), generation_lsn=f"{max(last, clock_at):016x}")
        finally:
            own.unpersist()

    def start(self, changes: DataFrame, once: bool = True, every: str | None = None) -> StreamingQuery:
        """Streams until what is there is applied, or, unless ``once``, goes on at the configured interval."""
        writer = changes.writeStream.option("checkpointLocation", f"{self.folder}/checkpoint").foreachBatch(self.apply)
        every = every or f"{seconds(self.config.inactivity_flush_timeout)} seconds"
        return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)).start()

    def stop(self, query: StreamingQuery | None = None) -> None:
        """Ends the stream at the edge of a batch and flushes every buffer."""
        if query is not None:
            query.stop()
        for t in self.tables.values():
            t.log.flush()

    def current(self, name: tuple[str, str]) -> DataFrame:
        return self.tables[name].log.current()
