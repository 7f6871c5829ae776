"""Changes before the engines: routing, replay filter, typing, comparison, clocks.

Everything is a DataFrame to DataFrame function, used alike in batch and stream.
``seq`` is the arrival order; (commit_lsn, seq, sub) orders output rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.pgtypes import convert, not_null, parse_source_type, to_target


def route(changes: DataFrame, tables: DataFrame) -> DataFrame:
    """Rows of configured tables alone; tables: rel_oid and what is to be added.
    There is one row a table, so Spark broadcasts it as long as it is small."""
    return changes.join(tables, "rel_oid")


def drop_replayed(changes: DataFrame, state: DataFrame) -> DataFrame:
    """state: table_name, table_lsn. Keeps what lies beyond a table's position."""
    return changes.join(state, "table_name", "left").where("commit_lsn > coalesce(table_lsn, -1)").drop("table_lsn")


def min_lsn(state: DataFrame) -> DataFrame:
    return state.agg(F.coalesce(F.min(F.when(F.col("table_lsn") != 0, F.col("table_lsn"))), F.lit(0)).alias("min_lsn"))


def project(source: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Mapped columns alone, under their target names."""
    if missing := [c for c in mapping if c not in source.columns]:
        raise ValueError(f"columns {missing} aren't in the source")
    return source.select(*(F.col(a).alias(b) for a, b in mapping.items()))


def cell_of(cells: Column, name: str, names: Column | None, i: int) -> Column:
    """The cell of a source column: by its name in the relation that the row came with, or
    by place. A column that the relation lacks is an error."""
    if names is None:
        return F.get(cells, F.lit(i))
    place = F.array_position(names, name)
    gone = F.raise_error(F.concat(F.lit(f"column {name} isn't among "), F.array_join(names, ", "))).cast("bigint")
    return F.get(cells, F.when(place > 0, place - 1).otherwise(gone).cast("int"))


def typed_row(cells: Column, old: Column | None, columns: list[tuple[str, str, bool]], compat: bool = False, names: Column | None = None, sources: list[str] | None = None, targets: list[str] | None = None) -> Column:
    """Struct of typed values. columns: target name, source type, nullable. An unchanged
    cell takes the old image's value, unless compat, where it is empty. With ``names``,
    the columns of the row's own relation, cells are found by the names in ``sources``, so
    that new and moved source columns do no harm. targets: types of existing target columns."""
    fields = []
    for i, (name, kind, nullable) in enumerate(columns):
        source = sources[i] if sources else name
        cell = cell_of(cells, source, names, i)
        text = F.when(cell["kind"] == "t", cell["value"])
        if compat:
            text = F.when(cell["kind"] == "u", "").otherwise(text)
        elif old is not None:
            text = F.when(cell["kind"] == "u", cell_of(old, source, names, i)["value"]).otherwise(text)
        t = parse_source_type(kind)
        value = to_target(text, t, targets[i], compat) if targets else convert(text, t, compat)
        fields.append((value if nullable else not_null(value, name)).alias(name))
    return F.struct(*fields)


def same(old: Column, new: Column, compat: bool = False) -> Column:
    """Null-safe equality; compat inverts it around nulls as text comparison does there."""
    if not compat:
        return old.eqNullSafe(new)
    return ~F.when(old.isNotNull(), old.cast("string") != F.coalesce(new.cast("string"), F.lit(""))).otherwise(new.isNull())


def all_same(pairs: list[tuple[str, str]], compat: bool = False) -> Column:
    out = F.lit(True)
    for a, b in pairs:
        out = out & same(F.col(a), F.col(b), compat)
    return out


#: Rows that a stretch of positions should hold.
STRETCH = 20_000


def stretch(rows: DataFrame, position: str) -> Column:
    """Numbers stretches of positions, equally wide, with STRETCH rows each on average, so that
    no window needs all rows of a table, or of the stream, in one task."""
    r = rows.agg(F.min(position).alias("low"), F.max(position).alias("high"), F.count("*").alias("n")).first()
    if not r.n:
        return F.lit(0).cast("bigint")
    return F.expr(f"({position} - {r.low}) div {max(1, -(-(r.high - r.low + 1) * STRETCH // r.n))}")


def relation_as_of(changes: DataFrame, relations: DataFrame) -> DataFrame:
    """Each change with the latest relation message of its oid before it. Both have
    rel_oid and wal_start; relations also layout. Inside a stretch of positions a window
    finds it; what a stretch begins with is carried from the last one that has a message."""
    marked = changes.withColumn("layout", F.lit(None).cast(relations.schema["layout"].dataType)).withColumn("__rel", F.lit(1))
    both = marked.unionByName(relations.select("rel_oid", "wal_start", "layout", F.lit(0).alias("__rel")), allowMissingColumns=True)
    both = both.withColumn("__stretch", stretch(both, "wal_start"))
    keys = ["rel_oid", "__stretch"]
    carry = Window.partitionBy("rel_oid").orderBy("__stretch").rowsBetween(Window.unboundedPreceding, -1)
    # a row for each table and stretch
    ends = both.groupBy(*keys).agg(F.max_by("layout", F.when(F.col("__rel") == 0, F.col("wal_start"))).alias("__end"))
    ends = ends.select(*keys, F.last("__end", ignorenulls=True).over(carry).alias("__carried"))
    upto = Window.partitionBy(*keys).orderBy("wal_start", "__rel").rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("layout", F.last("layout", ignorenulls=True).over(upto)).where("__rel = 1").join(ends, keys)
    return found.withColumn("layout", F.coalesce("layout", "__carried")).drop("__rel", "__stretch", "__carried")


def transactions(changes: DataFrame) -> DataFrame:
    """commit_lsn, n_changes, n_tables, has_truncate of every transaction that changed something."""
    return changes.groupBy("commit_lsn").agg(F.count("*").alias("n_changes"), F.count_distinct("table_name").alias("n_tables"), F.bool_or(F.col("op") == "T").alias("has_truncate"))


def transaction_effects(changes: DataFrame, state: DataFrame, threshold: int) -> DataFrame:
    """For every transaction: is_empty (nothing lies beyond its table's position, and no table is
    truncated, even one that is skipped), dirty (names of the tables that it changes) and
    wants_flush (some table gets ``threshold`` changes or more). state: table_name, table_lsn."""
    applied = F.col("commit_lsn") > F.coalesce("table_lsn", F.lit(-1))
    by_table = changes.join(state, "table_name", "left").groupBy("commit_lsn", "table_name").agg(F.count_if(applied).alias("n"), F.bool_or(F.col("op") == "T").alias("has_truncate"))
    return by_table.groupBy("commit_lsn").agg(
        (~(F.bool_or(F.col("n") > 0) | F.bool_or("has_truncate"))).alias("is_empty"),
        F.sort_array(F.collect_list(F.when(F.col("n") > 0, F.col("table_name")))).alias("dirty"),
        F.bool_or(F.col("n") >= threshold).alias("wants_flush"),
    )


def with_generation(changes: DataFrame, base: int = 0) -> DataFrame:
    """The generation before its transaction, from the number of transactions before it: those
    of earlier stretches of positions, then those of its own."""
    commits = changes.select("commit_lsn").distinct()
    commits = commits.withColumn("__stretch", stretch(commits, "commit_lsn"))
    before = Window.orderBy("__stretch").rowsBetween(Window.unboundedPreceding, -1)  # a row for each stretch
    starts = commits.groupBy("__stretch").agg(F.count("*").alias("n")).select("__stretch", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__start"))
    place = F.row_number().over(Window.partitionBy("__stretch").orderBy("commit_lsn")) - 1
    clock = commits.join(starts, "__stretch").select("commit_lsn", ((F.lit(base) + F.col("__start") + place) % 4294967296).cast("bigint").alias("generation"))
    return changes.join(clock, "commit_lsn")


def with_row_ids(rows: DataFrame) -> DataFrame:
    """The arrival number of every row of a log in its transaction."""
    return rows.withColumn("row_id", (F.row_number().over(Window.partitionBy("commit_lsn").orderBy("seq", "sub")) - 1).cast("bigint"))
