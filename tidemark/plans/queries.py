"""The registered queries, each with the SQL that answers it on the same tables."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from datetime import datetime, timedelta, timezone

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.lsn import format_hex, format_lsn, is_valid, parse_hex, parse_lsn
from tidemark.functions.pgtypes import SourceType, convert, not_null, parse_source_type, target_type, to_target
from tidemark.operators import changes as ch
from tidemark.operators.engines import AppendEngine, CollapsingEngine, Engine, ReplacingEngine, after_truncates, check_sum, compact, snapshot_and_stream
from tidemark.plans.config import Config, TableConfig, load
from tidemark.plans.ddl import SourceColumn, log_ddl
from tidemark.sources.catalog import Catalog, Table, column_catalog, load_catalog, published_tables
from tidemark.sources.copytext import decode_lines
from tidemark.sources.files import shared_folder
from tidemark.sources.pgoutput import Cell, ColumnInfo, Message
from tidemark.sources.ship import ship
from tidemark.sources import wal
from tidemark.streaming.apply import LogTable, start
from tidemark.streaming.replicator import Replicator

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

#: The change log that events tell: a user's row is absent after an error, else holds the last event.
CHANGE_LOG = """
raw as (select event_id, user_id, event_type, value, case when event_type = 'error' then 0 else 1 end as alive from events),
img as (select *, lag(alive) over w as p_alive, lag(event_type) over w as o_type, lag(value) over w as o_value
        from raw window w as (partition by user_id order by event_id)),
cl as (select event_id as seq, cast(floor(event_id / 10) as bigint) + 1 as commit_lsn, user_id,
              case when alive = 0 then 'D' when coalesce(p_alive, 0) = 1 then 'U' else 'I' end as op,
              case when coalesce(p_alive, 0) = 1 then user_id end as old_user_id, case when coalesce(p_alive, 0) = 1 then o_type end as old_event_type,
              case when coalesce(p_alive, 0) = 1 then o_value end as old_value,
              user_id as new_user_id, event_type as new_event_type, value as new_value
       from img where alive = 1 or coalesce(p_alive, 0) = 1)"""
COLUMNS = ("user_id", "event_type", "value")
KEYED = Engine(("user_id",), COLUMNS)
DEC = "cast(sum(cast({} as decimal(18,2))) as double)"


def register(name: str, sql: str | None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "events").createOrReplaceTempView("events")
    return spark.sql(f"with {CHANGE_LOG} select * from cl")


def _engine(kind: type, compat: bool = False, keys: tuple[str, ...] = ("user_id",), extra: tuple[str, ...] = ()) -> Engine:
    return kind(keys, COLUMNS, compat, extra)


def _nulled(cl: DataFrame) -> DataFrame:
    """Views become nulls, to meet the comparison rules around them."""
    return cl.withColumn("old_event_type", F.nullif("old_event_type", F.lit("view"))).withColumn("new_event_type", F.nullif("new_event_type", F.lit("view")))


NULLED = CHANGE_LOG + """,
nl as (select * replace (nullif(old_event_type, 'view') as old_event_type, nullif(new_event_type, 'view') as new_event_type) from cl)"""
SAME = "({o} is not distinct from {n})"
COMPAT = "(not case when {o} is not null then cast({o} as varchar) <> coalesce(cast({n} as varchar), '') else {n} is null end)"


def _equal(rule: str, columns: tuple[str, ...] = COLUMNS) -> str:
    return "(" + " and ".join(rule.format(o=f"old_{c}", n=f"new_{c}") for c in columns) + ")"


def _rows(side: str, marks: str, sub: int, where: str, source: str = "cl") -> str:
    return f"select {', '.join(f'{side}_{c} as {c}' for c in COLUMNS)}, {marks} commit_lsn, seq, {sub} as sub from {source} where {where}"


def _collapsing(rule: str = SAME, source: str = "cl") -> str:
    changed = f"op = 'U' and not {_equal(rule)}"
    return f"{_rows('old', 'cast(-1 as tinyint) as sign,', 0, f'op = {chr(39)}D{chr(39)} or ({changed})', source)} union all {_rows('new', 'cast(1 as tinyint) as sign,', 1, f'op = {chr(39)}I{chr(39)} or ({changed})', source)}"


def _replacing(rule: str = SAME, deleted: int = 1, keys: tuple[str, ...] = ("user_id",), source: str = "cl") -> str:
    changed = f"op = 'U' and not {_equal(rule)}"
    mark = lambda n: f"commit_lsn as ver, cast({n} as smallint) as is_deleted,"
    return " union all ".join([
        _rows("new", mark(0), 1, f"op = 'I' or ({changed})", source), _rows("old", mark(deleted), 0, "op = 'D'", source),
        _rows("old", mark(1), 0, f"{changed} and not {_equal(rule, keys)}", source),
    ])


CURRENT = f"with {CHANGE_LOG}, a as (select *, row_number() over (partition by user_id order by seq desc) as r from cl) select new_user_id as user_id, new_event_type as event_type, new_value as value from a where r = 1 and op <> 'D'"


@register("changelog_ops", f"with {CHANGE_LOG} select op, count(*) as n, count(distinct user_id) as n_users from cl group by op")
def changelog_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return change_log(spark, sf_dir).groupBy("op").agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("n_users"))


@register("tx_stats", f"with {CHANGE_LOG} select commit_lsn, count(*) as n_changes, count(distinct new_event_type) as n_tables, bool_or(op = 'T') as has_truncate from cl group by commit_lsn")
def tx_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ch.transactions(change_log(spark, sf_dir).withColumn("table_name", F.col("new_event_type")))


@register("mergetree_log", f"with {CHANGE_LOG} {_rows('new', '', 0, chr(111) + 'p = ' + chr(39) + 'I' + chr(39))}")
def mergetree_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _engine(AppendEngine).rewrite(change_log(spark, sf_dir))


@register("replacing_log", f"with {CHANGE_LOG} {_replacing()}")
def replacing_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _engine(ReplacingEngine).rewrite(change_log(spark, sf_dir))


@register("replacing_log_compat", f"with {NULLED} {_replacing(COMPAT, 0, source='nl')}")
def replacing_log_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _engine(ReplacingEngine, True).rewrite(_nulled(change_log(spark, sf_dir)))


@register("replacing_log_key_change", f"with {CHANGE_LOG} {_replacing(keys=('event_type',))}")
def replacing_log_key_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _engine(ReplacingEngine, keys=("event_type",)).rewrite(change_log(spark, sf_dir))


@register("collapsing_log", f"with {CHANGE_LOG} {_collapsing()}")
def collapsing_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _engine(CollapsingEngine).rewrite(change_log(spark, sf_dir))


@register("collapsing_log_compat", f"with {NULLED} {_collapsing(COMPAT, 'nl')}")
def collapsing_log_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _engine(CollapsingEngine, True).rewrite(_nulled(change_log(spark, sf_dir)))


@register("replacing_current", CURRENT)
def replacing_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _engine(ReplacingEngine)
    return e.current(e.rewrite(change_log(spark, sf_dir)))


@register("replacing_current_by_generation", CURRENT)
def replacing_current_by_generation(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _engine(ReplacingEngine, extra=("generation",))
    return e.current(e.rewrite(ch.with_generation(change_log(spark, sf_dir))), "generation")


@register("collapsing_current", CURRENT)
def collapsing_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _engine(CollapsingEngine).current(collapsing_log(spark, sf_dir))


@register("collapsing_checksum", f"with {CHANGE_LOG}, c as ({_collapsing()}) select {DEC.format('value * sign')} as value_sum, cast(sum(sign) as bigint) as n_rows from c")
def collapsing_checksum(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = collapsing_log(spark, sf_dir).withColumn("value", F.col("value").cast("decimal(18,2)"))
    return check_sum(log, "value").select(F.col("value_sum").cast("double").alias("value_sum"), "n_rows")


@register("compacted_current", CURRENT)
def compacted_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _engine(CollapsingEngine)
    return e.current(compact(e, collapsing_log(spark, sf_dir)))


@register("noop_updates", f"with {NULLED} select cast(count(case when {_equal(SAME, ('event_type',))} then 1 end) as bigint) as documented, cast(count(case when {_equal(COMPAT, ('event_type',))} then 1 end) as bigint) as compat from nl where op = 'U'")
def noop_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = [("old_event_type", "new_event_type")]
    return _nulled(change_log(spark, sf_dir)).where("op = 'U'").agg(F.count_if(ch.all_same(own)).alias("documented"), F.count_if(ch.all_same(own, True)).alias("compat"))


@register("key_changes", f"with {CHANGE_LOG} select commit_lsn, seq, old_event_type, new_event_type from cl where op = 'U' and old_event_type <> new_event_type")
def key_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return change_log(spark, sf_dir).where((F.col("op") == "U") & _engine(ReplacingEngine, keys=("event_type",)).key_changed()).select("commit_lsn", "seq", "old_event_type", "new_event_type")


def _state(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("I", 50), ("U", 20), ("D", 0)], "table_name string, table_lsn bigint")


STATE_SQL = "state as (select * from (values ('I', 50), ('U', 20), ('D', 0)) as t (table_name, table_lsn))"


@register("replay_filter", f"with {CHANGE_LOG}, {STATE_SQL} select op as table_name, commit_lsn, seq from cl left join state on op = table_name where commit_lsn > coalesce(table_lsn, -1)")
def replay_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ch.drop_replayed(change_log(spark, sf_dir).select(F.col("op").alias("table_name"), "commit_lsn", "seq"), _state(spark))


@register("min_lsn", "with s as (select user_id % 50 as t, case when user_id % 50 = 3 then 0 else max(event_id) end as table_lsn from events group by user_id % 50) select cast(coalesce(min(nullif(table_lsn, 0)), 0) as bigint) as min_lsn from s")
def min_lsn(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = F.when(F.col("t") == 3, 0).otherwise(F.max("event_id"))
    return ch.min_lsn(table(spark, sf_dir, "events").groupBy((F.col("user_id") % 50).alias("t")).agg(last.alias("table_lsn")))


@register("lsn_valid", "select event_id, case when event_id % 4 = 0 then false else event_id <> 0 end as is_valid from events")
def lsn_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    lsn = F.when(F.col("event_id") % 4 == 0, F.lit(None)).when(F.col("event_id") % 4 == 1, F.col("event_id")).otherwise(F.col("event_id"))
    return table(spark, sf_dir, "events").select("event_id", is_valid(lsn).alias("is_valid"))


@register("generation_ids", f"with {CHANGE_LOG} select commit_lsn, seq, cast(dense_rank() over (order by commit_lsn) - 1 as bigint) as generation from cl")
def generation_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ch.with_generation(change_log(spark, sf_dir)).select("commit_lsn", "seq", "generation")


@register("row_ids", f"with {CHANGE_LOG}, c as ({_collapsing()}) select commit_lsn, seq, sub, cast(row_number() over (partition by commit_lsn order by seq, sub) - 1 as bigint) as row_id from c")
def row_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ch.with_row_ids(collapsing_log(spark, sf_dir)).select("commit_lsn", "seq", "sub", "row_id")


@register("snapshot_union_stream", CURRENT)
def snapshot_union_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, cut = _engine(CollapsingEngine), 60
    log = collapsing_log(spark, sf_dir)
    taken = e.current(log.where(F.col("commit_lsn") <= cut))
    snapshot = taken.select(*COLUMNS, F.lit(1).cast("tinyint").alias("sign"), F.lit(0).cast("bigint").alias("commit_lsn"), F.lit(0).cast("bigint").alias("seq"), F.lit(1).alias("sub"))
    return e.current(snapshot_and_stream(snapshot, log, cut))


@register("truncate_current", f"with {CHANGE_LOG}, c as ({_rows('new', '', 0, 'op = ' + chr(39) + 'I' + chr(39))}) select user_id, event_type, value from c where commit_lsn > 40 or (commit_lsn = 40 and seq > 395)")
def truncate_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    marks = spark.createDataFrame([(12, 115), (40, 395)], "commit_lsn bigint, seq bigint")
    return _engine(AppendEngine).current(after_truncates(mergetree_log(spark, sf_dir), marks))


@register("table_routing", "select n_nationkey as rel_oid, n_name as table_name, count(*) as n from customer join nation on c_nationkey = n_nationkey where n_regionkey < 3 group by all")
def table_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    configured = table(spark, sf_dir, "nation").where("n_regionkey < 3").select(F.col("n_nationkey").alias("rel_oid"), F.col("n_name").alias("table_name"))
    rows = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("rel_oid"))
    return ch.route(rows, configured).groupBy("rel_oid", "table_name").agg(F.count("*").alias("n"))


@register("relation_asof", "select event_id as wal_start, user_id as rel_oid, (select max(r.event_id) from events r where r.user_id = e.user_id and r.event_type = 'error' and r.event_id <= e.event_id) as layout from events e where event_type <> 'error'")
def relation_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(F.col("event_id").alias("wal_start"), F.col("user_id").alias("rel_oid"), "event_type")
    relations = rows.where("event_type = 'error'").select("rel_oid", "wal_start", F.col("wal_start").alias("layout"))
    return ch.relation_as_of(rows.where("event_type <> 'error'").select("wal_start", "rel_oid"), relations).select("wal_start", "rel_oid", "layout")


@register("column_mapping", "select c_custkey as id, c_name as customer from customer")
def column_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ch.project(table(spark, sf_dir, "customer"), {"c_custkey": "id", "c_name": "customer"})


@register("toast_carry", "select event_id, cast(user_id as integer) as user_id, case when event_id % 3 = 0 then props else event_type end as props from events")
def toast_carry(spark: SparkSession, sf_dir: str) -> DataFrame:
    cell = lambda kind, v: F.struct(kind.alias("kind"), v.cast("string").alias("value"))
    unchanged = F.col("event_id") % 3 == 0
    rows = table(spark, sf_dir, "events").select("event_id", F.array(cell(F.lit("t"), F.col("user_id")), cell(F.lit("t"), F.col("props"))).alias("old"), F.array(cell(F.lit("t"), F.col("user_id")), cell(F.when(unchanged, "u").otherwise("t"), F.when(~unchanged, F.col("event_type")))).alias("new"))
    return rows.select("event_id", ch.typed_row(F.col("new"), F.col("old"), [("user_id", "integer", False), ("props", "text", True)]).alias("r")).select("event_id", "r.*")


def _cast(name: str, source: str, text: str, kind: str, sql: str, key: str) -> None:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = table(spark, sf_dir, source).select(key, F.expr(text).alias("v"))
        return rows.select(key, convert(F.col("v"), parse_source_type(kind)).alias("value"))

    register(name, f"select {key}, {sql} as value from {source}")(query)


_cast("cast_ints", "part", "cast(p_size as string)", "integer", "p_size", "p_partkey")
_cast("cast_bool", "part", "case when p_size > 25 then 't' else 'f' end", "boolean", "cast(case when p_size > 25 then 1 else 0 end as smallint)", "p_partkey")
_cast("cast_decimal", "customer", "cast(cast(c_acctbal as decimal(12,2)) as string)", "numeric(12,2)", "cast(c_acctbal as decimal(12,2))", "c_custkey")
_cast("cast_date", "orders", "date_format(o_orderdate, 'yyyy-MM-dd')", "date", "cast(o_orderdate as date)", "o_orderkey")
_cast("cast_datetime", "orders", "date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss')", "timestamp", "cast(date_trunc('second', o_orderdate) as timestamp)", "o_orderkey")
_cast("cast_time_seconds", "events", "date_format(ts, 'HH:mm:ss.SSSSSS')", "time without time zone", "cast(extract(hour from ts) * 3600 + extract(minute from ts) * 60 + extract(second from ts) as integer)", "event_id")
_cast("cast_array", "part", "concat('{', p_size, ',NULL,', p_partkey, '}')", "bigint[]", "[cast(p_size as bigint), null, p_partkey]", "p_partkey")
_cast("cast_interval", "part", "concat(p_size, ' days 01:02:03')", "interval", "cast(p_size as bigint) * 86400 + 3723", "p_partkey")
_cast("cast_inet", "part", "concat('10.0.', p_size, '.7')", "inet", "cast(167772160 + p_size * 256 + 7 as bigint)", "p_partkey")


_cast("cast_floats", "lineitem", "cast(cast(l_extendedprice as float) as string)", "real", "cast(l_extendedprice as float)", "l_orderkey")
_cast("cast_text_array", "part", """concat('{"', p_name, ', ', p_brand, '",', p_size, ',"a\\\\\\\\b",NULL,"NULL"}')""", "text[]", "[p_name || ', ' || p_brand, cast(p_size as varchar), 'a\\b', null, 'NULL']", "p_partkey")
_cast("cast_bytea", "part", "concat('\\\\x', lower(hex(p_brand)))", "bytea", "encode(p_brand)", "p_partkey")


@register("cast_unsigned", "select p_partkey, cast(p_size as tinyint) as i8, cast(p_size + 200 as integer) as u16, p_partkey + 4000000000 as u32, cast(18446744073709551615 - p_partkey as decimal(20,0)) as u64 from part")
def cast_unsigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = {"i8": ("p_size", "Int8", "smallint"), "u16": ("p_size + 200", "UInt16", "integer"), "u32": ("p_partkey + 4000000000", "UInt32", "bigint"), "u64": ("cast(18446744073709551615 as decimal(20,0)) - p_partkey", "UInt64", "numeric(20,0)")}
    return table(spark, sf_dir, "part").select("p_partkey", *(to_target(F.expr(f"cast({text} as string)"), parse_source_type(kind), target).alias(name) for name, (text, target, kind) in v.items()))


@register("not_null_rows", "select c_custkey, c_name, coalesce(c_mktsegment, 'none') as segment from customer")
def not_null_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", not_null(F.col("c_name"), "c_name").alias("c_name"), not_null(F.coalesce("c_mktsegment", F.lit("none")), "segment").alias("segment"))


@register("lsn_format", "select event_id, concat(upper(to_hex(((event_id * 7919000000) >> 32))), '/', upper(to_hex((event_id * 7919000000) & 4294967295))) as lsn, lower(lpad(to_hex(event_id * 7919000000), 16, '0')) as hex from events")
def lsn_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    lsn = F.col("event_id") * F.lit(7919000000)
    return table(spark, sf_dir, "events").select("event_id", format_lsn(lsn).alias("lsn"), format_hex(lsn).alias("hex"))


@register("lsn_parse", "select event_id, event_id * 7919000000 as lsn, event_id * 7919000000 as of_hex from events")
def lsn_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsn_format(spark, sf_dir).select("event_id", parse_lsn(F.col("lsn")).alias("lsn"), parse_hex(F.col("hex")).alias("of_hex"))


@register("copy_text_decode", "select doc_id, translate(text, 'qxz', chr(8) || chr(12) || chr(11)) as text, lang, case when doc_id % 5 = 0 then null else source end as source from documents")
def copy_text_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with every escape: the seven letters, hex and octal bytes, and nulls."""

    def field(v: F.Column) -> F.Column:
        for a, b in (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r"), ("\b", "\\b"), ("\f", "\\f"), ("\v", "\\v")):
            v = F.replace(v, F.lit(a), F.lit(b))
        return F.coalesce(v, F.lit("\\N"))

    code, rest = F.ascii(F.substring("lang", 1, 1)), field(F.expr("substr(lang, 2)"))
    of_byte = lambda k: code.between(1, 127) & (F.col("doc_id") % 3 == k)
    digits = lambda base, n: F.lpad(F.lower(F.conv(code.cast("string"), 10, base)), n, "0")
    lang = F.when(of_byte(0), F.concat(F.lit("\\x"), digits(16, 2), rest)).when(of_byte(1), F.concat(F.lit("\\"), digits(8, 3), rest)).otherwise(field(F.col("lang")))
    source = F.when(F.col("doc_id") % 5 == 0, None).otherwise(F.col("source"))
    text = F.translate("text", "qxz", "\b\f\v")
    lines = table(spark, sf_dir, "documents").select(F.concat_ws("\t", field(F.col("doc_id").cast("string")), field(text), lang, field(source)).alias("value"))
    f = F.col("fields")
    return decode_lines(lines, 4).select(f[0].cast("bigint").alias("doc_id"), f[1].alias("text"), f[2].alias("lang"), f[3].alias("source"))


_PG_NAMES = {"bigint": "bigint", "int": "integer", "string": "text", "double": "double precision", "timestamp": "timestamp with time zone", "timestamp_ntz": "timestamp"}


@register("ddl_render", "select 'orders' as table_name, 'CREATE TABLE main (' || string_agg(column_name || ' ' || case column_type when 'VARCHAR' then 'string' when 'DOUBLE' then 'double' when 'INTEGER' then 'int' when 'BIGINT' then 'bigint' else 'timestamp_ntz' end, ', ') || ', sign tinyint, commit_lsn bigint, seq bigint, sub int, through bigint) USING parquet PARTITIONED BY (through)' as ddl, 'Nullable(Decimal(12, 2))' as target_type from (describe orders)")
def ddl_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [SourceColumn(f.name, "timestamp" if f.dataType.simpleString().startswith("timestamp") else _PG_NAMES[f.dataType.simpleString()]) for f in table(spark, sf_dir, "orders").schema]
    text = log_ddl(columns, TableConfig(main_table="main"))
    return spark.createDataFrame([("orders", text, target_type(SourceType("numeric", (12, 2)), True))], "table_name string, ddl string, target_type string")


def messages(rows: Iterator[Row], drift_at: int | None = None, truncate: int | None = None) -> Iterator[tuple[int, Message]]:
    """The change rows of users as a WAL stream, a transaction for each position. With
    ``drift_at``, a table of events goes along, and from that position on the relation of users
    has another order and one column more; truncate: the position of
    a transaction that begins with a truncate of users."""
    now = datetime(2024, 1, 1, tzinfo=timezone.utc)
    key, kind, value, extra = ColumnInfo(True, "user_id", 20, -1), ColumnInfo(False, "event_type", 25, -1), ColumnInfo(False, "value", 701, -1), ColumnInfo(False, "note", 25, -1)
    users = {False: Message("R", oid=7, schema="public", name="users", identity="f", columns=(key, kind, value)), True: Message("R", oid=7, schema="public", name="users", identity="f", columns=(value, extra, key, kind))}
    events = Message("R", oid=8, schema="public", name="events", identity="f", columns=(ColumnInfo(True, "event_id", 20, -1), kind))
    cell = lambda v: Cell("n") if v is None else Cell("t", str(v))

    def cells(r: Row, side: str, drifted: bool) -> tuple[Cell, ...]:
        return tuple(cell("x" if c.name == "note" else r[f"{side}_{c.name}"]) for c in users[drifted].columns)

    last, layout = None, None
    for r in rows:
        lsn = r["commit_lsn"]
        if lsn != last:
            if last is not None:
                yield last, Message("C", lsn=last, end_lsn=last + 1, time=now)
            drifted = drift_at is not None and lsn >= drift_at
            if layout is None and drift_at is not None:
                yield lsn, events
            if layout != drifted:
                layout = drifted
                yield lsn, users[drifted]
            last = lsn
            yield lsn, Message("B", lsn=lsn, time=now + timedelta(seconds=lsn), xid=lsn)
            if lsn == truncate:
                yield lsn, Message("T", oids=(7,))
        old = cells(r, "old", layout) if r["op"] != "I" else None
        yield lsn, Message(r["op"], oid=7, old=old, old_kind="O" if old else "", new=cells(r, "new", layout) if r["op"] != "D" else None)
        if drift_at is not None:
            yield lsn, Message("I", oid=8, new=(cell(r["seq"]), cell(r["new_event_type"])))
    if last is not None:
        yield last, Message("C", lsn=last, end_lsn=last + 1, time=now)


def write_segments(rows: DataFrame, folder: str, **how: object) -> None:
    """Writes a capture from change rows, a stretch of positions in each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wal.write_capture(folder, messages((r for b in batches for r in b.to_pylist()), **how), 1 << 18)
        yield pa.RecordBatch.from_arrays([pa.array([folder])], ["folder"])

    ship(rows.sparkSession)
    os.makedirs(folder, exist_ok=True)  # without rows there may be no task
    dealt = rows.repartitionByRange("commit_lsn").sortWithinPartitions("commit_lsn", "seq")
    dealt.mapInArrow(run, "folder string").collect()  # a row a task


def _wal(spark: SparkSession, sf_dir: str, **how: object) -> str:
    folder = shared_folder(spark, "wal")
    write_segments(change_log(spark, sf_dir), folder, **how)
    wal.register(spark)
    return folder


TYPES = [("user_id", "bigint", True), ("event_type", "text", True), ("value", "double precision", True)]


def _typed(changes: DataFrame) -> DataFrame:
    old = F.when(F.col("old_row").isNotNull(), ch.typed_row(F.col("old_row"), None, TYPES))
    new = F.when(F.col("new_row").isNotNull(), ch.typed_row(F.col("new_row"), F.col("old_row"), TYPES))
    rows = changes.withColumns({"o": old, "n": new})
    return rows.select("commit_lsn", "seq", "op", *(F.col(f"o.{c}").alias(f"old_{c}") for c in COLUMNS), *(F.col(f"n.{c}").alias(f"new_{c}") for c in COLUMNS))


@register("pgoutput_roundtrip", f"with {CHANGE_LOG} select commit_lsn, op, case when op <> 'I' then old_user_id end as old_user_id, case when op <> 'I' then old_event_type end as old_event_type, case when op <> 'I' then old_value end as old_value, case when op <> 'D' then new_user_id end as new_user_id, case when op <> 'D' then new_event_type end as new_event_type, case when op <> 'D' then new_value end as new_value from cl")
def pgoutput_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _typed(spark.read.format("wal_capture").load(_wal(spark, sf_dir))).drop("seq")


@register("commit_times", f"with {CHANGE_LOG} select distinct commit_lsn, commit_lsn as xid, timestamp '2024-01-01 00:00:00' + to_seconds(commit_lsn) as commit_ts from cl where commit_lsn > 20")
def commit_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.format("wal_capture").option("start_lsn", 20).load(_wal(spark, sf_dir))
    return rows.select("commit_lsn", "xid", F.col("commit_ts").cast("timestamp_ntz").alias("commit_ts")).distinct()


def _stream(spark: SparkSession, folder: str, target: LogTable, checkpoint: str, most: int | None = None) -> None:
    reader = spark.readStream.format("wal_capture")
    changes = _typed((reader if most is None else reader.option("max_buffer_length", most)).load(folder))
    query = start(changes, target, os.path.join(folder, checkpoint), once=False, every="0 seconds")
    query.processAllAvailable()
    query.stop()


@register("stream_apply", CURRENT)
def stream_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _wal(spark, sf_dir)
    target = LogTable(spark, f"{folder}/log", "users", _engine(CollapsingEngine))
    target.sync(spark.createDataFrame([], "user_id bigint, event_type string, value double"), 0)
    _stream(spark, folder, target, "checkpoint")
    return target.current()


@register("stream_restart", CURRENT)
def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first transactions, then all again under a new checkpoint with batches of another size, by way of a buffer."""
    log, folder = change_log(spark, sf_dir), shared_folder(spark, "wal")
    write_segments(log.where("commit_lsn <= 50"), folder)
    wal.register(spark)
    target = LogTable(spark, f"{folder}/log", "users", _engine(CollapsingEngine), buffered=True, flush_threshold=2)
    _stream(spark, folder, target, "first", 1_000)
    write_segments(log.where("commit_lsn > 50"), folder)
    _stream(spark, folder, target, "second", 20_000)
    target.flush()
    return target.current()


@register("stream_generation", f"with {CHANGE_LOG}, c as ({_collapsing()}) select c.*, cast(g.generation as bigint) as generation from c join (select commit_lsn, 1 + dense_rank() over (order by commit_lsn) - 1 as generation from (select distinct commit_lsn from cl)) g using (commit_lsn) union all select 0, 'none', 0.0, cast(1 as tinyint), 0, 0, 1, 0")
def stream_generation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot row has generation 0, the pass that copied it counts, and then each transaction does."""
    folder = _wal(spark, sf_dir)
    target = LogTable(spark, f"{folder}/log", "users", _engine(CollapsingEngine, extra=("generation",)))
    target.sync(spark.createDataFrame([(0, "none", 0.0)], "user_id bigint, event_type string, value double"), 0)
    changes = _typed(spark.read.format("wal_capture").load(folder))
    # arrival in the whole stream, as in the source
    arrival = change_log(spark, sf_dir).select("commit_lsn", F.col("seq").alias("arrival"))
    place = Window.partitionBy("commit_lsn").orderBy("arrival")
    arrival = arrival.withColumn("seq", (F.row_number().over(place) - 1).cast("bigint"))
    for low, high in ((0, 100), (50, 400), (0, 1 << 62)):
        target.apply(changes.where((F.col("commit_lsn") > low) & (F.col("commit_lsn") <= high)))
    rows = target.log().join(arrival, ["commit_lsn", "seq"], "left")
    return rows.withColumn("seq", F.coalesce("arrival", F.lit(0))).drop("arrival")


@register("compact_then_truncate", f"with {CHANGE_LOG}, c as ({_collapsing()}), t as (select user_id, event_type, value, sum(sign) as n, max((commit_lsn, seq)) as mark from c where commit_lsn <= 95 and (commit_lsn > 40 or commit_lsn = 40 and seq > 395) group by all) select user_id, event_type, value, cast(n as bigint) as n, mark[1] as commit_lsn, mark[2] as seq from t where n <> 0 and (mark[1] > 80 or mark[1] = 80 and mark[2] > 795)")
def compact_then_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    marks = lambda *m: spark.createDataFrame(list(m), "commit_lsn bigint, seq bigint")
    log = collapsing_log(spark, sf_dir).where("commit_lsn <= 95")
    kept = compact(_engine(CollapsingEngine), after_truncates(log, marks((12, 115), (40, 395))))
    left = after_truncates(kept, marks((80, 795)))
    return left.groupBy(*COLUMNS, "commit_lsn", "seq").agg(F.sum("sign").alias("n"))


REPLICATION = """
tables:
  users: {main_table: users_log, engine: ReplacingMergeTree, generation_column: generation}
  events: {main_table: events_log, engine: MergeTree, columns: {event_id: id, event_type: kind}, buffer_table: events_buffer, merge_threshold: 3}
postgres: {replication_slot_name: s, publication_name: p}
db_path: %s
"""
CATALOG = """{"slots": ["s"], "publications": {"p": ["users", "events"]}, "tables": {
 "users": {"oid": 7, "columns": [{"name": "user_id", "type": "bigint", "nullable": false, "pk": 1}, {"name": "event_type", "type": "text"}, {"name": "value", "type": "double precision"}]},
 "events": {"oid": 8, "columns": [{"name": "event_id", "type": "bigint", "nullable": false, "pk": 1}, {"name": "event_type", "type": "text"}]}}}"""
DRIFT, CUT = 60, 30


def replicator(spark: SparkSession, sf_dir: str) -> Replicator:
    """Two tables in one stream, in batches: users is truncated once and its columns change, events goes through a buffer."""
    cut = change_log(spark, sf_dir).where(F.col("commit_lsn") >= CUT).agg(F.min("commit_lsn")).first()[0]
    folder = _wal(spark, sf_dir, drift_at=DRIFT, truncate=cut)
    r = Replicator(spark, load(REPLICATION % f"{folder}/db"), load_catalog(CATALOG))
    changes = spark.readStream.format("wal_capture").option("start_lsn", r.min_lsn()).option("max_buffer_length", 5_000).load(folder)
    query = r.start(changes, once=False, every="0 seconds")
    query.processAllAvailable()
    r.stop(query)
    return r


AFTER_CUT = f"a as (select *, row_number() over (partition by user_id order by seq desc) as r from cl where commit_lsn >= {CUT})"


@register("replicate_tables", f"with {CHANGE_LOG}, {AFTER_CUT} select 'users' as table_name, new_user_id as id, new_event_type as kind, new_value as value from a where r = 1 and op <> 'D' union all select 'events', seq, new_event_type, null from cl")
def replicate_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = replicator(spark, sf_dir)
    users = r.current(("public", "users")).select(F.lit("users").alias("table_name"), F.col("user_id").alias("id"), F.col("event_type").alias("kind"), "value")
    events = r.current(("public", "events")).select(F.lit("events").alias("table_name"), "id", "kind", F.lit(None).cast("double").alias("value"))
    return users.unionByName(events)


@register("schema_drift", f"with {CHANGE_LOG} select commit_lsn, op, case when op <> 'D' then new_user_id end as user_id, case when op <> 'D' then new_event_type end as event_type, case when op <> 'D' then new_value end as value, commit_lsn >= {DRIFT} as drifted from cl")
def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.format("wal_capture").load(_wal(spark, sf_dir, drift_at=DRIFT)).where("table_name = 'users'")
    names = [n for n, _, _ in TYPES]
    new = F.when(F.col("new_row").isNotNull(), ch.typed_row(F.col("new_row"), F.col("old_row"), TYPES, names=F.col("column_names"), sources=names))
    return rows.select("commit_lsn", "op", new.alias("n"), F.array_contains("column_names", "note").alias("drifted")).select("commit_lsn", "op", "n.*", "drifted")


@register("copy_snapshot", "select c_custkey as id, c_name as name, cast(c_acctbal as decimal(12,2)) as balance, cast(1 as tinyint) as sign, cast(0 as bigint) as commit_lsn, case when c_custkey % 7 = 0 then null else c_mktsegment end as segment from customer")
def copy_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """COPY files to typed rows to the log, with the not-null check of its key."""
    folder = shared_folder(spark, "copy")
    segment = F.when(F.col("c_custkey") % 7 == 0, "\\N").otherwise(F.col("c_mktsegment"))
    table(spark, sf_dir, "customer").select(F.concat_ws("\t", "c_custkey", "c_name", F.col("c_acctbal").cast("decimal(12,2)"), segment)).write.text(f"{folder}/public.customer.copy")
    columns = [SourceColumn("id", "bigint", False, 1), SourceColumn("name", "text", False), SourceColumn("balance", "numeric(12,2)"), SourceColumn("segment", "text")]
    catalog = Catalog({("public", "customer"): Table(9, "f", columns)}, {"p": [("public", "customer")]}, ["s"])
    config = Config({("public", "customer"): TableConfig(main_table="c")}, db_path=f"{folder}/db", postgres={"replication_slot_name": "s", "publication_name": "p"})
    r = Replicator(spark, config, catalog)
    r.sync({("public", "customer"): f"{folder}/public.customer.copy"}, 5)
    return r.tables["public", "customer"].log.log().drop("seq", "sub")


EFFECTS = f"with {CHANGE_LOG}, state as (select * from (values ('click', 400), ('view', 20)) as t (table_name, table_lsn)), b as (select commit_lsn, new_event_type as table_name, count(*) filter (commit_lsn > coalesce(table_lsn, -1)) as n from cl left join state on new_event_type = table_name group by all) select commit_lsn, not bool_or(n > 0) as is_empty, array_to_string(list_sort(coalesce(list(table_name) filter (n > 0), [])), ',') as dirty, bool_or(n >= 4) as wants_flush from b group by commit_lsn"


@register("transaction_effects", EFFECTS)
def transaction_effects(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = spark.createDataFrame([("click", 400), ("view", 20)], "table_name string, table_lsn bigint")
    rows = change_log(spark, sf_dir).withColumn("table_name", F.col("new_event_type"))
    return ch.transaction_effects(rows, state, 4).withColumn("dirty", F.array_join("dirty", ","))


#: A source's catalog of two tables, one of them dropped a column, and a view.
PG = {
    "classes": ("oid bigint, relname string, relnamespace bigint, relkind string, relreplident string", [(7, "users", 1, "r", "f"), (8, "events", 1, "r", "d"), (9, "seen", 1, "v", "d")]),
    "namespaces": ("oid bigint, nspname string", [(1, "public"), (2, "other")]),
    "attributes": ("attrelid bigint, attnum int, attname string, atttypid bigint, atttypmod int, attnotnull boolean, attisdropped boolean", [(7, 1, "user_id", 20, -1, True, False), (7, 2, "gone", 25, -1, False, True), (7, 3, "balance", 1700, 786438, False, False), (8, 1, "event_id", 20, -1, True, False), (8, 2, "code", 1042, 7, False, False), (8, 3, "tags", 1009, -1, False, False), (8, -1, "ctid", 27, -1, True, False), (9, 1, "x", 25, -1, False, False)]),
    "types": ("oid bigint, typname string", [(20, "bigint"), (25, "text"), (1700, "numeric"), (1042, "character"), (1009, "text[]")]),
    "keys": ("indrelid bigint, indkey array<int>", [(7, [1]), (8, [1])]),
    "published": ("pubname string, schemaname string, tablename string", [("p", "public", "users"), ("p", "public", "events"), ("q", "public", "users")]),
}


def _pg(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame(PG[name][1], PG[name][0])


def _pg_sql(*names: str) -> str:
    quote = lambda v: "null" if v is None else f"'{v}'" if isinstance(v, str) else str(v)
    return ", ".join(f"{n} as (select * from (values {', '.join('(' + ', '.join(map(quote, r)) + ')' for r in PG[n][1])}) as t ({', '.join(c.split()[0] for c in PG[n][0].split(', '))}))" for n in names)


@register("catalog_columns", f"""with {_pg_sql('classes', 'namespaces', 'attributes', 'types', 'keys')}
select nspname as schema_name, relname as table_name, attnum, attname as name,
       case typname when 'numeric' then 'numeric(' || ((atttypmod - 4) >> 16) || ',' || ((atttypmod - 4) & 65535) || ')' when 'character' then 'character(' || (atttypmod - 4) || ')' else typname end as type,
       not attnotnull as nullable, coalesce(list_position(indkey, attnum), 0) as pk
from attributes join classes c on attrelid = c.oid join namespaces n on relnamespace = n.oid left join types t on atttypid = t.oid left join keys on indrelid = attrelid
where attnum > 0 and not attisdropped and relkind = 'r'""")  # fmt: skip
def catalog_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return column_catalog(*(_pg(spark, n) for n in ("classes", "namespaces", "attributes", "types", "keys")))


@register("publication_tables", f"with {_pg_sql('classes', 'namespaces', 'published')} select c.oid as rel_oid, schemaname as schema_name, tablename as table_name, relreplident as identity, relreplident = 'f' as is_full from published join namespaces n on schemaname = nspname join classes c on relname = tablename and relnamespace = n.oid where pubname = 'p' and relkind = 'r'")
def publication_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return published_tables(*(_pg(spark, n) for n in ("classes", "namespaces", "published")), "p")
