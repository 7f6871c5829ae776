"""What the source says about its tables: column catalogs, publications, replica identities.

The source's catalog tables come as DataFrames (or as one JSON file with the answers), and
the questions that a replicator asks are joins over them.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.config import Config, table_name
from tidemark.plans.ddl import SourceColumn
from tidemark.sources.pgoutput import identity_letter


def column_catalog(classes: DataFrame, namespaces: DataFrame, attributes: DataFrame, types: DataFrame, keys: DataFrame) -> DataFrame:
    """schema_name, table_name, attnum, name, type, nullable, pk of every live column, in order.
    classes: oid, relname, relnamespace, relkind; namespaces: oid, nspname; attributes:
    attrelid, attnum, attname, atttypid, atttypmod, attnotnull, attisdropped; types: oid,
    typname (as the source formats it); keys: indrelid, indkey (attnums of the primary key)."""
    of = lambda df, prefix: df.select(*(F.col(c).alias(f"{prefix}_{c}") for c in df.columns))
    columns = attributes.where("attnum > 0 and not attisdropped")
    owned = columns.join(of(classes.where("relkind = 'r'"), "c"), F.col("attrelid") == F.col("c_oid")).join(of(namespaces, "n"), F.col("c_relnamespace") == F.col("n_oid"))
    typed = owned.join(of(types, "t"), F.col("atttypid") == F.col("t_oid"), "left").join(of(keys, "k"), F.col("attrelid") == F.col("k_indrelid"), "left")
    # the modifier of numbers holds precision and scale, that of strings a length, each beyond 4 bytes
    extra = F.col("atttypmod") - 4
    name = F.coalesce("t_typname", F.lit("text"))
    base = F.regexp_replace(name, r"\[\]$", "")
    args = F.when((F.col("atttypmod") > 3) & base.isin("numeric", "decimal"), F.concat(F.lit("("), F.shiftright(extra, 16), F.lit(","), extra.bitwiseAND(F.lit(65535)), F.lit(")")))
    args = args.when((F.col("atttypmod") > 3) & base.isin("character", "character varying", "char", "varchar"), F.concat(F.lit("("), extra, F.lit(")"))).otherwise("")
    kind = F.concat(base, args, F.when(name.endswith("[]"), "[]").otherwise(""))
    pk = F.coalesce(F.array_position("k_indkey", F.col("attnum")), F.lit(0)).cast("int")
    return typed.select(F.col("n_nspname").alias("schema_name"), F.col("c_relname").alias("table_name"), "attnum", F.col("attname").alias("name"), kind.alias("type"), (~F.col("attnotnull")).alias("nullable"), pk.alias("pk"))


def published_tables(classes: DataFrame, namespaces: DataFrame, published: DataFrame, publication: str) -> DataFrame:
    """rel_oid, schema_name, table_name, identity, is_full of the ordinary tables of a publication.
    published: pubname, schemaname, tablename; classes also relreplident."""
    own = published.where(F.col("pubname") == publication)
    found = own.join(namespaces.select(F.col("oid").alias("n_oid"), "nspname"), F.col("schemaname") == F.col("nspname"))
    found = found.join(classes.where("relkind = 'r'"), (F.col("relname") == F.col("tablename")) & (F.col("relnamespace") == F.col("n_oid")))
    return found.select(F.col("oid").alias("rel_oid"), F.col("schemaname").alias("schema_name"), F.col("tablename").alias("table_name"), F.col("relreplident").alias("identity"), (F.col("relreplident") == "f").alias("is_full"))


@dataclass
class Table:
    oid: int = 0
    identity: str = "f"
    columns: list[SourceColumn] = field(default_factory=list)
    n_live: int = 0
    #: types of the target's columns where it exists already
    target: dict[str, str] | None = None


@dataclass
class Catalog:
    tables: dict[tuple[str, str], Table] = field(default_factory=dict)
    publications: dict[str, list[tuple[str, str]]] = field(default_factory=dict)
    slots: list[str] = field(default_factory=list)

    def check(self, config: Config) -> None:
        """Raises where the slot or the publication is missing, or a configured table isn't
        published, is unknown or doesn't send whole old rows."""
        slot, publication = config.postgres["replication_slot_name"], config.postgres["publication_name"]
        if slot not in self.slots:
            raise ValueError(f"there is no replication slot {slot}")
        if publication not in self.publications:
            raise ValueError(f"there is no publication {publication}")
        for name in config.tables:
            if name not in self.publications[publication]:
                raise ValueError(f"table {'.'.join(name)} isn't in publication {publication}")
            if name not in self.tables:
                raise ValueError(f"table {'.'.join(name)} isn't in the catalog")
            if self.tables[name].identity != "f":
                raise ValueError(f"table {'.'.join(name)} needs replica identity full")

    def names(self) -> dict[int, tuple[str, str]]:
        return {t.oid: name for name, t in self.tables.items()}


def load_catalog(text: str) -> Catalog:
    """JSON: tables (by name: oid, identity, columns with name, type, nullable, pk; n_live,
    target), publications (lists of names by publication) and slots."""
    values = json.loads(text)
    tables = {}
    for name, t in values.get("tables", {}).items():
        columns = [SourceColumn(c["name"], c["type"], c.get("nullable", True), c.get("pk", 0)) for c in t["columns"]]
        tables[table_name(name)] = Table(t.get("oid", 0), identity_letter(t.get("identity", "full")), columns, t.get("n_live", 0), t.get("target"))
    return Catalog(tables, {k: [table_name(x) for x in v] for k, v in values.get("publications", {}).items()}, values.get("slots", []))


def target_columns(spark: SparkSession, path: str) -> dict[str, str]:
    """Names and types of the columns that a log holds, as a target's catalog."""
    return {f.name: f.dataType.simpleString() for f in spark.read.parquet(path).schema}


def from_rows(columns: DataFrame, published: DataFrame, publication: str, slots: list[str]) -> Catalog:
    """The catalog from column_catalog and published_tables: a row a column of the source."""
    tables: dict[tuple[str, str], Table] = {}
    for r in published.collect():
        tables[r.schema_name, r.table_name] = Table(r.rel_oid, r.identity)
    for r in columns.orderBy("schema_name", "table_name", "attnum").collect():
        if (name := (r.schema_name, r.table_name)) in tables:
            tables[name].columns.append(SourceColumn(r.name, r.type, r.nullable, r.pk))
    return Catalog(tables, {publication: list(tables)}, slots)
