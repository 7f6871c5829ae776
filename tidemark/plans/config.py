"""Configuration: YAML with either spelling of an option; unknown keys are errors."""

from __future__ import annotations

from dataclasses import dataclass, field, fields

ENGINES = ("MergeTree", "ReplacingMergeTree", "CollapsingMergeTree")
#: Names that documents use for options that are read under another name.
SPELLINGS = {"buffer_row_id": "buffer_table_row_id", "merge_threshold": "flush_threshold", "inactivity_merge_timeout": "inactivity_flush_timeout"}


@dataclass
class TableConfig:
    main_table: str = ""
    buffer_table: str = ""
    buffer_table_row_id: str = ""
    engine: str = "CollapsingMergeTree"
    max_buffer_length: int = 1000
    flush_threshold: int = 0
    ver_column: str | None = ""
    is_deleted_column: str = ""
    sign_column: str = ""
    generation_column: str = ""
    init_sync_skip: bool = False
    #: accepted; a snapshot is one write and needs no buffer
    init_sync_skip_buffer_table: bool = False
    init_sync_skip_truncate: bool = False
    columns: dict[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        by_name = {e.lower(): e for e in ENGINES}
        if self.engine.lower() not in by_name:
            raise ValueError(f"unknown engine {self.engine}")
        self.engine = by_name[self.engine.lower()]
        if self.buffer_table and not self.buffer_table_row_id:
            self.buffer_table_row_id = "row_id"
        if self.engine == "CollapsingMergeTree":
            self.sign_column = self.sign_column or "sign"
        if self.engine == "ReplacingMergeTree":
            self.is_deleted_column = self.is_deleted_column or "is_deleted"
            if self.ver_column == "":  # an explicit null leaves versions to the generation
                self.ver_column = "ver"
            if not self.ver_column and not self.generation_column:
                raise ValueError("ReplacingMergeTree needs a version or a generation column")


@dataclass
class Config:
    tables: dict[tuple[str, str], TableConfig] = field(default_factory=dict)
    inactivity_flush_timeout: str = "1m"
    db_path: str = ""
    redis_bind: str = ""
    postgres: dict = field(default_factory=dict)
    clickhouse: dict = field(default_factory=dict)
    #: what stands for the source: catalog, capture, snapshot, snapshot_lsn
    source: dict = field(default_factory=dict)


def table_name(text: str) -> tuple[str, str]:
    """(schema, table); the schema is public where none is given."""
    parts = text.split(".")
    if not all(parts) or len(parts) > 2:
        raise ValueError(f"not a table name: {text!r}")
    return (parts[0], parts[1]) if len(parts) == 2 else ("public", parts[0])


def _known(cls: type, values: dict) -> dict:
    values = {SPELLINGS.get(k, k): v for k, v in (values or {}).items()}
    if unknown := values.keys() - {f.name for f in fields(cls)}:
        raise ValueError(f"unknown options {sorted(unknown)}")
    return values


def load(text: str) -> Config:
    import yaml

    values = _known(Config, yaml.safe_load(text))
    values["tables"] = {table_name(k): TableConfig(**_known(TableConfig, v)) for k, v in (values.get("tables") or {}).items()}
    config = Config(**values)
    config.postgres = {"host": "127.0.0.1", "port": 5432, **config.postgres}
    config.clickhouse = {"host": "127.0.0.1", "port": 9000, **config.clickhouse}
    for needed in ("replication_slot_name", "publication_name"):
        if not config.postgres.get(needed):
            raise ValueError(f"{needed} is required")
    if not config.db_path:
        raise ValueError("db_path is required")
    return config


def target_url(c: dict) -> str:
    """The target store's address, in the fixed form that its drivers take."""
    params = "".join(f"&{k}={v}" for k, v in (c.get("params") or {}).items())
    return f"tcp://{c['host']}:{c['port']}?username={c.get('username', '')}&password={c.get('password', '')}&database={c.get('database', '')}{params}"


def mapping(source: list[str], target: list[str], columns: dict[str, str]) -> dict[str, str]:
    """The configured mapping, else by name; a missing target column is an error."""
    chosen = columns or {c: c for c in source}
    if missing := [b for b in chosen.values() if b not in target]:
        raise ValueError(f"columns {missing} aren't in the target table")
    return {a: chosen[a] for a in source if a in chosen}
