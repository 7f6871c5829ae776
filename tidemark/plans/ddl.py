"""Table definitions from the source schema: for the target store and for Spark."""

from __future__ import annotations

from dataclasses import dataclass

from tidemark.functions.pgtypes import parse_source_type, spark_type, target_type
from tidemark.plans.config import TableConfig


@dataclass(frozen=True)
class SourceColumn:
    name: str
    type: str
    nullable: bool = True
    pk: int = 0


def _columns(columns: list[SourceColumn], table: TableConfig) -> list[tuple[SourceColumn, str]]:
    chosen = table.columns or {c.name: c.name for c in columns}
    return [(c, chosen[c.name]) for c in columns if c.name in chosen]


def _special(table: TableConfig) -> list[tuple[str, str, str]]:
    out = [(table.generation_column, "UInt32", "bigint")] if table.generation_column else []
    if table.engine == "ReplacingMergeTree":
        out += [(table.ver_column, "UInt64", "bigint")] * bool(table.ver_column) + [(table.is_deleted_column, "UInt8", "smallint")]
    elif table.engine == "CollapsingMergeTree":
        out.append((table.sign_column, "Int8", "tinyint"))
    return out


def target_ddl(columns: list[SourceColumn], table: TableConfig) -> list[str]:
    """CREATE TABLE of the main table and, if there is one, of the buffer table."""
    own = _columns(columns, table)
    names = dict((c.name, n) for c, n in own)
    if lost := [c.name for c in columns if c.pk and c.name not in names]:
        raise ValueError(f"key columns {lost} aren't mapped")
    lines = [f"    {n} {target_type(parse_source_type(c.type), c.nullable)}" for c, n in own] + [f"    {n} {t}" for n, t, _ in _special(table)]
    args = {"ReplacingMergeTree": table.ver_column or table.generation_column, "CollapsingMergeTree": table.sign_column}.get(table.engine, "")
    keys = [n for _, n in sorted((c.pk, names[c.name]) for c in columns if c.pk)]
    order = f" ORDER BY ({', '.join(keys)})" if keys else " ORDER BY tuple()"
    out = [f"CREATE TABLE {table.main_table} (\n" + ",\n".join(lines) + f"\n) ENGINE = {table.engine}({args}){order}"]
    if table.buffer_table:
        rows = [*lines, f"    {table.buffer_table_row_id} UInt64"]
        out.append(f"CREATE TABLE {table.buffer_table} (\n" + ",\n".join(rows) + f"\n) ENGINE = MergeTree() ORDER BY ({table.buffer_table_row_id})")
    return out


def log_ddl(columns: list[SourceColumn], table: TableConfig) -> str:
    """The Parquet log that Spark writes for the table."""
    fields = [f"{n} {spark_type(parse_source_type(c.type))}" for c, n in _columns(columns, table)] + [f"{n} {t}" for n, _, t in _special(table)]
    return f"CREATE TABLE {table.main_table} ({', '.join([*fields, 'commit_lsn bigint', 'seq bigint', 'sub int', 'through bigint'])}) USING parquet PARTITIONED BY (through)"
