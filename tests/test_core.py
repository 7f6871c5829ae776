import random
from datetime import datetime, timezone

import duckdb
import pytest
from pyspark.sql import functions as F

from tidemark.__main__ import main
from tidemark.functions.lsn import from_text
from tidemark.functions.pgtypes import convert, parse_source_type, parse_target_type, quote_literal, target_type, to_target, type_name
from tidemark.operators import changes as ch
from tidemark.operators.engines import AppendEngine, CollapsingEngine, ReplacingEngine, after_truncates, compact
from tidemark.plans import queries as q
from tidemark.plans.config import TableConfig, load, table_name
from tidemark.plans.ddl import SourceColumn, target_ddl
from tidemark.sources import wal
from tidemark.sources.catalog import from_rows, load_catalog
from tidemark.sources.copytext import decode_line, decode_lines, escape, unescape
from tidemark.sources.files import Files
from tidemark.sources.pgoutput import Cell, ColumnInfo, Message, decode, describe, encode, identity_letter, identity_name
from tidemark.streaming.apply import LogTable, State
from tidemark.streaming.control import Control
from tidemark.streaming.replicator import Replicator, seconds

SF = "/root/testdata/sf0.001"
NOW = datetime(2024, 5, 6, 7, 8, 9, 123456, tzinfo=timezone.utc)
SCHEMA = "commit_lsn bigint, seq bigint, op string, old_k int, old_v string, new_k int, new_v string"


@pytest.mark.parametrize("m", [
    Message("B", lsn=5, time=NOW, xid=9), Message("C", flags=1, lsn=5, end_lsn=6, time=NOW), Message("O", lsn=4, name="x"), Message("Y", oid=3, schema="s", name="n"),
    Message("R", oid=1, schema="public", name="t", identity="f", columns=(ColumnInfo(True, "a", 23, -1), ColumnInfo(False, "b", 25, 4))),
    Message("I", oid=1, new=(Cell("n"), Cell("u"), Cell("t", "é"))), Message("U", oid=1, new=(Cell("t", ""),)),
    Message("U", oid=1, old_kind="K", old=(Cell("t", "1"),), new=(Cell("t", "2"),)), Message("U", oid=1, old_kind="O", old=(Cell("n"),), new=(Cell("t", "2"),)),
    Message("D", oid=1, old_kind="K", old=(Cell("t", "1"),)), Message("D", oid=1, old_kind="O", old=(Cell("t", "1"),)),
    *(Message("T", oids=(1, 2), cascade=bool(f & 1), restart_identity=bool(f & 2)) for f in range(4)),
])
def test_codec_round_trip(m):
    assert decode(encode(m)) == m


def test_codec_rejects_unknown():
    for data in (b"Z", b"I\0\0\0\1X", b"I\0\0\0\1N\0\1z"):
        with pytest.raises(ValueError):
            decode(data)


def test_copy_text():
    assert decode_line("a\t\t\\N\tx\\ty\\x41\\101\\12\\\\\n") == ["a", "", None, "x\tyAA\n\\"]
    assert unescape("a\\N") is None
    assert unescape("\\xc3\\xa9é") == "éé"
    for bad in ("\\q", "a\\"):
        with pytest.raises(ValueError):
            unescape(bad)
    for v in (None, "", "a\tb\n\\N", "\b\f\r\v"):
        assert unescape(escape(v)) == v


def test_copy_lines_are_decoded_alike(spark):
    lines = ["a\t\t\\N", "x\\ty\\x41\\101\\12\\\\\tb\tc", "\\\\x41\t\\\\\\\\N\ta\\b\\f\\n\\r\\v", "\\\\N\tq\\N\té"]
    got = decode_lines(spark.createDataFrame([(x,) for x in lines], "value string"), 3).collect()
    assert sorted(map(str, (r.fields for r in got))) == sorted(str(decode_line(x)) for x in lines)
    for bad in ("a\tb", "\\q\tb\tc", "a\tb\tc\\"):
        with pytest.raises(Exception):
            decode_lines(spark.createDataFrame([(bad,)], "value string"), 3).collect()


def test_copy_query_on_odd_rows(spark, tmp_path):
    ids = [None, 0, 1, 2, 3, 4, 5, 6, 7, 9, 9]
    texts = ["a\0b", None, "\\\0", "\\N\\x41", "\0", "qxz\b\f\n\r\t\v", "é", "", "a\\", "x", "x"]
    langs = ["en", None, "", "\t\\", "", "漢a", "\\n", "\t7a", "a\0", "é", "é"]
    sources = ["web", None, "", "\\N", "a\tb", *"abcdef"]
    spark.createDataFrame(list(zip(ids, texts, langs, sources, strict=True)), "doc_id long, text string, lang string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    want = [(d, t and t.translate(dict(zip(map(ord, "qxz"), "\b\f\v", strict=True))), g, None if d is not None and d % 5 == 0 else s) for d, t, g, s in zip(ids, texts, langs, sources, strict=True)]
    assert sorted(map(str, map(tuple, q.copy_text_decode(spark, str(tmp_path)).collect()))) == sorted(map(str, want))


def test_types(spark):
    assert target_type(parse_source_type("numeric(10,2)"), True) == "Nullable(Decimal(10, 2))"
    assert target_type(parse_source_type("integer[]"), True) == "Array(Int32)"
    assert target_type(parse_source_type("mood"), False) == "String"
    assert parse_target_type("LowCardinality(Nullable(FixedString(3)))") == ("FixedString", False, True)
    with pytest.raises(ValueError):
        target_type(parse_source_type("numeric"), False)
    rows = [("boolean", "f", 0), ("smallint", "-32768", -32768), ("time with time zone", "01:02:03.5+02", 3723), ("interval", "1 day -00:00:01", 86399), ("inet", "1.2.3.4/8", 16909060), ("bytea", "\\x00ff", b"\x00\xff"), ("integer[]", "{1,NULL}", [1, None]), ("text[]", '{"a,b",c,NULL,"NULL","q\\"\\\\"," "}', ["a,b", "c", None, "NULL", 'q"\\', " "]), ("text[]", "{}", []), ("integer[]", None, None), ("text", None, None), ("character(3)", "a  ", "a  ")]
    for kind, text, want in rows:
        assert spark.createDataFrame([(text,)], "v string").select(convert(F.col("v"), parse_source_type(kind))).first()[0] == want, kind
    for kind, text in (("boolean", "yes"), ("smallint", "32768"), ("integer", "x"), ("integer[]", "{{1},{2}}")):
        with pytest.raises(Exception):
            spark.createDataFrame([(text,)], "v string").select(convert(F.col("v"), parse_source_type(kind))).collect()
    for target, kind, text, want in (("UInt32", "bigint", "4294967295", 4294967295), ("Nullable(Int8)", "smallint", "-128", -128), ("UInt8", "boolean", "t", 1), ("UInt16", "integer", "65536", None), ("UInt64", "bigint", "-1", None), ("Int8", "smallint", "128", None)):
        df = spark.createDataFrame([(text,)], "v string").select(to_target(F.col("v"), parse_source_type(kind), target))
        if want is None:
            with pytest.raises(Exception):
                df.collect()
        else:
            assert df.first()[0] == want
    assert [type_name(x) for x in (23, 1007, 1184, 99999)] == ["integer", "integer[]", "timestamp with time zone", "text"]
    assert quote_literal("a'b") == "'a''b'" and quote_literal("\\") == " E'\\\\'"


def history(seed, n=120):
    """A random history of a keyed table with nulls, and what it ends in."""
    r, rows, out = random.Random(seed), {}, []
    for seq in range(n):
        k, lsn = r.randrange(8), seq // 5 + 1
        if k in rows and r.random() < 0.3:
            out.append((lsn, seq, "D", k, rows.pop(k), None, None))
            continue
        v = r.choice([None, "", "a", "b"])
        new = r.choice([x for x in range(12) if x not in rows]) if k in rows and r.random() < 0.2 else k
        out.append((lsn, seq, "U" if k in rows else "I", k if k in rows else None, rows.get(k), new, v))
        rows.pop(k, None)
        rows[new] = v
    return out, sorted(rows.items())


@pytest.mark.parametrize("seed", range(3))
def test_engines_agree_with_a_model(spark, seed):
    out, end = history(seed)
    df = spark.createDataFrame(out, SCHEMA)
    for e in (ReplacingEngine(("k",), ("k", "v")), CollapsingEngine(("k",), ("k", "v"))):
        log = e.rewrite(df)
        assert sorted(map(tuple, e.current(log).collect())) == end
        assert sorted(map(tuple, e.current(compact(e, log)).collect())) == end


@pytest.mark.parametrize("compat", [False, True])
def test_null_rules(spark, compat):
    pairs = [(None, None), (None, "a"), ("", None), ("a", "a"), ("a", "b")]
    df = spark.createDataFrame([(1, i, "U", 1, a, 1, b) for i, (a, b) in enumerate(pairs)], SCHEMA)
    kept = {r.seq for r in CollapsingEngine(("k",), ("k", "v"), compat).rewrite(df).collect()}
    assert kept == ({0, 4} if compat else {1, 2, 4})


def test_deletes_are_marked(spark):
    df = spark.createDataFrame([(1, 0, "D", 1, "a", None, None)], SCHEMA)
    assert ReplacingEngine(("k",), ("k", "v")).rewrite(df).first().is_deleted == 1
    assert ReplacingEngine(("k",), ("k", "v"), True).rewrite(df).first().is_deleted == 0


def test_incomplete_log_is_reported(spark):
    df = spark.createDataFrame([(1, 0, "D", 1, "a", None, None)], SCHEMA)
    e = CollapsingEngine(("k",), ("k", "v"))
    with pytest.raises(Exception, match="incomplete"):
        e.current(e.rewrite(df)).collect()


def test_batches_may_run_twice(spark, tmp_path):
    out, end = history(7)
    target = LogTable(spark, str(tmp_path), "t", ReplacingEngine(("k",), ("k", "v")))
    assert target.sync(spark.createDataFrame([(99, "s")], "k int, v string"), 0)
    assert not target.sync(spark.createDataFrame([(98, "no")], "k int, v string"), 0)
    parts = [[x for x in out if x[0] % 2 == 1 and x[0] < 4 or x[0] == 2], [x for x in out if x[0] >= 4]]
    for i, part in enumerate(parts):
        for _ in range(2):
            target.apply(spark.createDataFrame(part, SCHEMA), i)
    target.apply(spark.createDataFrame(parts[0], SCHEMA), 0)
    assert sorted(map(tuple, target.current().collect())) == sorted([*end, (99, "s")])
    assert target.state.read()["generation_id"] == str(1 + len({x[0] for x in out}))
    target.apply(spark.createDataFrame([(90, 900, "T", None, None, None, None), (90, 901, "I", None, None, 5, "z")], SCHEMA), 2)
    assert list(map(tuple, target.current().collect())) == [(5, "z")]


@pytest.mark.parametrize("buffered", [False, True])
def test_positions_count_not_batch_numbers(spark, tmp_path, buffered):
    out, end = history(2)
    df = lambda low, high: spark.createDataFrame([x for x in out if low < x[0] <= high], SCHEMA)
    target = LogTable(spark, str(tmp_path), "t", CollapsingEngine(("k",), ("k", "v")), buffered, 3)
    target.apply(df(0, 5), 0)
    target.apply(df(5, 9), 1)
    # an attempt that failed before its position was stored, cut otherwise the next time
    left = LogTable(spark, str(tmp_path), "t", target.engine, buffered, 3)
    left._move = lambda *a, **k: None
    left.apply(df(9, 20), 2)
    for i, (low, high) in enumerate(((0, 7), (3, 12), (12, 99))):  # a new checkpoint numbers from 0
        LogTable(spark, str(tmp_path), "t", target.engine, buffered, 3).apply(df(low, high), i)
    target.flush()
    assert sorted(map(tuple, target.current().collect())) == end
    assert target.position() == max(x[0] for x in out) and int(target.state.read()["commands"]) == len(out)


def test_generation_column_in_the_stream(spark, tmp_path):
    out, _ = history(3)
    target = LogTable(spark, str(tmp_path), "t", CollapsingEngine(("k",), ("k", "v"), False, ("generation",)))
    target.sync(spark.createDataFrame([], "k int, v string"), 0)
    for low, high in ((0, 4), (2, 11), (0, 99)):
        target.apply(spark.createDataFrame([x for x in out if low < x[0] <= high], SCHEMA))
    assert {(r.commit_lsn, r.generation) for r in target.log().select("commit_lsn", "generation").collect()} <= {(n, n) for n in range(1, 25)}


def test_compaction_keeps_last_positions(spark):
    e = CollapsingEngine(("k",), ("k", "v"))
    out = [(5, 9, "I", None, None, 1, "a"), (5, 10, "D", 1, "a", None, None), (6, 0, "I", None, None, 1, "a")]
    mark = spark.createDataFrame([(6, 3)], "commit_lsn bigint, seq bigint")
    assert after_truncates(compact(e, e.rewrite(spark.createDataFrame(out, SCHEMA))), mark).count() == 0


def test_stretches_do_not_change_results(spark, monkeypatch):
    rows = [(o, w) for o in (1, 2) for w in range(0, 90, 3)]
    relations = [(1, 4, "a"), (1, 31, "b"), (1, 32, "c"), (2, 60, "d")]
    want = sorted((o, w, max(((p, x) for oo, p, x in relations if oo == o and p <= w), default=(0, None))[1]) for o, w in rows)
    for size in (3, 20_000):
        monkeypatch.setattr(ch, "STRETCH", size)
        got = ch.relation_as_of(spark.createDataFrame(rows, "rel_oid long, wal_start long"), spark.createDataFrame(relations, "rel_oid long, wal_start long, layout string"))
        assert sorted((r.rel_oid, r.wal_start, r.layout) for r in got.collect()) == want
        clock = ch.with_generation(spark.createDataFrame([(w,) for _, w in rows], "commit_lsn long"), 7)
        assert sorted({(r.commit_lsn, r.generation) for r in clock.collect()}) == [(w, 7 + i) for i, w in enumerate(range(0, 90, 3))]


def test_append_engine(spark):
    out, _ = history(1)
    e = AppendEngine(("k",), ("k", "v"))
    assert e.current(e.rewrite(spark.createDataFrame(out, SCHEMA))).count() == sum(x[2] == "I" for x in out)


def test_state_commands(spark, tmp_path):
    s = State(str(tmp_path / "s.json"), Files(spark))
    assert s.command("PING") == "PONG" and s.command("set", "a", "b") == "OK" and s.command("get", "a") == "b" and s.command("exists", "a") == 1
    assert s.command("del", "a") == 1 and s.command("get", "a") is None
    for bad in (("set", "table_lsn_x", "1"), ("del", "table_lsn_x"), ("nope",), ("get",)):
        with pytest.raises(ValueError):
            s.command(*bad)


def test_config():
    text = "tables:\n  t: {main_table: m, engine: replacingmergetree, merge_threshold: 4, buffer_table: b}\ndb_path: x\npostgres: {replication_slot_name: s, publication_name: p}\n"
    c = load(text)
    t = c.tables["public", "t"]
    assert (t.flush_threshold, t.buffer_table_row_id, t.ver_column, t.is_deleted_column, c.postgres["port"]) == (4, "row_id", "ver", "is_deleted", 5432)
    with pytest.raises(ValueError):
        load(text + "nope: 1\n")
    with pytest.raises(ValueError):
        table_name("a.b.c")


def test_target_ddl():
    cols = [SourceColumn("id", "bigint", False, 1), SourceColumn("v", "text")]
    main, buffer = target_ddl(cols, TableConfig(main_table="m", buffer_table="b", columns={"id": "key", "v": "v"}))
    assert "ENGINE = CollapsingMergeTree(sign) ORDER BY (key)" in main and "row_id UInt64" in buffer
    with pytest.raises(ValueError):
        target_ddl(cols, TableConfig(main_table="m", columns={"v": "v"}))


def test_control_endpoint(spark, tmp_path):
    import socket

    control = Control(State(str(tmp_path / "s.json"), Files(spark)), "127.0.0.1:0")
    try:
        with socket.create_connection(control.server_address) as c, c.makefile("rwb") as f:
            for sent, want in ((b"PING\r\n", b"+PONG\r\n"), (b"*3\r\n$3\r\nset\r\n$1\r\na\r\n$3\r\nx y\r\n", b"+OK\r\n"), (b"get a\r\n", b"$3\r\n"), (b"", b"x y\r\n"), (b"get b\r\n", b"$-1\r\n"), (b"exists a\r\n", b":1\r\n"), (b"del table_lsn_t\r\n", b"-ERR positions are protected\r\n"), (b"quit\r\n", b"+OK\r\n")):
                f.write(sent)
                f.flush()
                assert f.readline() == want
    finally:
        control.close()


def test_messages_as_text():
    m = Message("U", oid=7, old_kind="O", old=(Cell("n"), Cell("t", "a")), new=(Cell("u"), Cell("t", "b")))
    assert describe(m) == '{"message": "update", "oid": 7, "old": [{"kind": "null"}, "a"], "new": [{"kind": "unchanged"}, "b"]}'
    assert '"lsn": "1/2"' in describe(Message("B", lsn=(1 << 32) + 2, time=NOW, xid=9)) and from_text("1/2") == (1 << 32) + 2
    assert identity_name("f") == "full" and identity_name("?") == "default" and identity_letter("Nothing") == "n"
    with pytest.raises(ValueError):
        identity_letter("some")


def stream(n):
    yield 1, Message("R", oid=1, schema="public", name="t", identity="f", columns=(ColumnInfo(True, "k", 23, -1),))
    for i in range(1, n + 1):
        yield i * 10, Message("B", lsn=i * 10, time=NOW, xid=i)
        for k in range(i % 3):
            yield i * 10, Message("I", oid=1, new=(Cell("t", f"{i}.{k}"),))
        yield i * 10, Message("C", lsn=i * 10, end_lsn=i * 10 + 1, time=NOW)


def test_segments_are_read_apart(spark, tmp_path):
    path = str(tmp_path / "w")
    wal.write_capture(path, stream(50), 400)
    found = wal.segments(path)
    assert len(found) > 5 and all(a.last < b.first for a, b in zip(found, found[1:], strict=False)) and len(wal.segments(path, 400)) < len(found)
    rows = lambda after=0, upto=None: [r[11][0][1] if r[11] else r[-1][0][1] for s in wal.segments(path, after) for r in wal.changes(wal.frames(s.path), after, upto)]
    want = lambda low, high: [f"{i}.{k}" for i in range(1, 51) for k in range(i % 3) if low < i * 10 <= high]
    assert rows() == want(0, 500) and rows(123, 250) == want(123, 250)
    wal.register(spark)
    df = spark.read.format("wal_capture").option("start_lsn", 200).load(path)
    assert sorted(r.new_row[0].value for r in df.collect()) == sorted(want(200, 500)) and df.rdd.getNumPartitions() > 2
    assert {tuple(r.column_types) for r in df.collect()} == {("integer",)}
    reader, offsets = wal._Stream(path, 0, 7), []
    at = reader.initialOffset()
    while (now := reader.latestOffset()) != at:
        offsets.append((at["lsn"], now["lsn"]))
        at = now
        reader.commit(at)
    assert [len(want(*o)) for o in offsets[:-1]] == [7 if len(want(*o)) == 7 else 8 for o in offsets[:-1]] and sum(len(want(*o)) for o in offsets) == len(want(0, 500))
    assert wal._Stream(path, 0, 7).latestOffset() == at  # what was acknowledged


def test_catalog_checks(spark):
    config = load(q.REPLICATION % "x")
    catalog = load_catalog(q.CATALOG)
    catalog.check(config)
    assert catalog.names() == {7: ("public", "users"), 8: ("public", "events")}
    for change in ('"slots": ["s"]|"slots": []', '"p": ["users", "events"]|"p": ["users"]', '"p": |"q": ', '"oid": 7,|"oid": 7, "identity": "index",', '"users": {"oid"|"other": {"oid"'):
        with pytest.raises(ValueError):
            load_catalog(q.CATALOG.replace(*change.split("|"))).check(config)
    own = from_rows(q.catalog_columns(spark, SF), q.publication_tables(spark, SF), "p", ["s"])
    assert [(c.name, c.type, c.pk) for c in own.tables["public", "users"].columns] == [("user_id", "bigint", 1), ("balance", "numeric(12,2)", 0)]
    with pytest.raises(ValueError, match="identity"):
        own.check(config)


def test_replicator_syncs_tables_without_a_position(spark, tmp_path):
    (tmp_path / "users.copy").write_text("1\tview\t0.5\n2\t\\N\t1\n")
    (tmp_path / "bad.copy").write_text("\\N\tview\t0.5\n")
    r = Replicator(spark, load(q.REPLICATION % (tmp_path / "db")), load_catalog(q.CATALOG))
    assert r.needs_sync() and r.min_lsn() == 0
    with pytest.raises(Exception, match="allows none"):
        r.sync({("public", "users"): str(tmp_path / "bad.copy")}, 40)
    r.sync({("public", "users"): str(tmp_path / "users.copy")}, 40)
    assert not r.needs_sync() and r.min_lsn() == 40 and r.generation() == 1
    assert sorted(map(tuple, r.current(("public", "users")).collect())) == [(1, "view", 0.5), (2, None, 1.0)]
    path = str(tmp_path / "w")
    cells = lambda *v: tuple(Cell("n") if x is None else Cell("t", x) for x in v)
    columns = (ColumnInfo(True, "user_id", 20, -1), ColumnInfo(False, "event_type", 25, -1), ColumnInfo(False, "value", 701, -1))
    message = lambda lsn, *m: [(lsn, Message("B", lsn=lsn, time=NOW, xid=lsn)), *((lsn, x) for x in m), (lsn, Message("C", lsn=lsn, end_lsn=lsn, time=NOW))]
    parts = [(1, Message("R", oid=7, schema="public", name="users", identity="f", columns=columns))]
    parts += message(30, Message("D", oid=7, old_kind="O", old=cells("1", "view", "0.5")))  # the snapshot holds it
    parts += message(50, Message("U", oid=7, old_kind="O", old=cells("2", None, "1"), new=cells("2", "buy", "1")), Message("I", oid=99, new=cells("x")))
    parts += message(60) + [(61, Message("R", oid=7, schema="public", name="users", identity="f", columns=columns[:2]))]
    wal.write_capture(path, iter(parts))
    wal.register(spark)
    r.apply(spark.read.format("wal_capture").load(path))
    r.stop()
    assert sorted(map(tuple, r.current(("public", "users")).collect())) == [(1, "view", 0.5), (2, "buy", 1.0)]
    assert r.generation() == 3 and r.tables["public", "users"].log.position() == 50 == r.min_lsn()
    wal.write_capture(path, iter([parts[-1], *message(70, Message("I", oid=7, new=cells("4", "view")))]))
    with pytest.raises(Exception, match="isn't among"):  # a mapped column is gone
        r.apply(spark.read.format("wal_capture").option("start_lsn", 60).load(path))


def test_command_line_prints_definitions(tmp_path, capsys):
    (tmp_path / "c.json").write_text(q.CATALOG)
    (tmp_path / "c.yaml").write_text(q.REPLICATION % "x" + f"source: {{catalog: {tmp_path / 'c.json'}}}\n")
    assert main(["--config", str(tmp_path / "c.yaml"), "--generate-ch-ddl"]) == 0
    out = capsys.readouterr().out
    assert out.count("CREATE TABLE") == 3 and "ENGINE = ReplacingMergeTree(ver) ORDER BY (user_id)" in out and "generation UInt32" in out


def test_command_line_replicates(spark, tmp_path, monkeypatch):
    wal.write_capture(str(tmp_path / "w"), q.messages(q.change_log(spark, SF).orderBy("seq").limit(200).collect(), drift_at=12))
    (tmp_path / "c.json").write_text(q.CATALOG)
    (tmp_path / "c.yaml").write_text(q.REPLICATION % (tmp_path / "db") + f"redis_bind: '127.0.0.1:0'\nsource: {{catalog: {tmp_path / 'c.json'}, capture: {tmp_path / 'w'}}}\n")
    assert main(["--config", str(tmp_path / "c.yaml"), "--once"]) == 0
    assert LogTable(spark, str(tmp_path / "db/public.events"), "public.events", AppendEngine(("id",), ("id", "kind"))).current().count() == 200


def test_durations():
    assert [seconds(x) for x in ("1m", "90s", "1h2m3s")] == [60, 90, 3723]
    with pytest.raises(ValueError):
        seconds("10")


@pytest.mark.parametrize("name", list(q.QUERIES))
def test_query_runs(spark, name):
    df = q.QUERIES[name](spark, SF)
    assert df.columns and df.count() >= 1


ODD_EVENTS = [(1, None, "view", 2.0), (2, None, "error", 3.0), (3, 1, "view", float("nan")), (4, 1, None, None), (5, 1, "", float("inf")), (9, 2, "é\t", 1e-320), (10, 2, "error", 0.1), (11, -3, "view", 1e22), (12, None, "view", -1.0)]


@pytest.mark.parametrize("events", [ODD_EVENTS, []])
@pytest.mark.parametrize("name", ["pgoutput_roundtrip", "stream_apply"])
def test_captures_of_odd_events(spark, tmp_path, name, events):
    spark.createDataFrame(events, "event_id long, user_id long, event_type string, value double").coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    got = q.QUERIES[name](spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"create view events as select * from '{tmp_path}/events.parquet/*.parquet'")
    want = con.execute(f"select {', '.join(got.columns)} from ({q.SQL[name]})").fetchall()
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want)) and bool(want) == bool(events)
