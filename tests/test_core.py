"""Queries against DuckDB, operators on small logs, and batch against stream."""

from __future__ import annotations

import datetime
import json
import subprocess
import sys

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.conftest import ROOT
from tests.oracle import assert_same, duck
from tidelog.functions import lsn as L
from tidelog.functions import scalars as S
from tidelog.operators import events as E
from tidelog.operators import framing, frontier, project, route, state, txn
from tidelog.operators.decode import decode
from tidelog.operators.project import Field
from tidelog.plans import queries, silver
from tidelog.sources import wire
from tidelog.sources.scratch import materialise

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_oracle(spark, name):
    assert_same(queries.queries()[name](spark, SF).toPandas(), duck(SF, queries.oracle_sql()[name]))


def log(spark, messages, version=4):
    """Bronze of messages (dict, in stream)."""
    rows = [("s", k, 64 * k, 64 * k + 64, 0, wire.encode(m, version, inside) if isinstance(m, dict) else m) for k, (m, inside) in enumerate(messages)]
    return spark.createDataFrame(rows, "slot string, seq long, wal_start long, wal_end long, server_time long, data binary")


REL = {"tag": "R", "oid": 1, "namespace": "public", "name": "t", "replident": ord("d"), "columns": [(1, "id", 20, -1), (0, "v", 25, -1)]}
BEGIN = lambda x: {"tag": "B", "final_lsn": 1, "ts": 0, "xid": x}
COMMIT = {"tag": "C", "flags": 0, "commit_lsn": 1, "end_lsn": 2, "ts": 0}
PUT = lambda k, v: {"tag": "I", "oid": 1, "new": [("t", str(k).encode()), ("t", v.encode())]}


def gold(spark, messages):
    events = materialise(E.events(materialise(decode(log(spark, messages), 4), "m")), "e")
    assigned = materialise(txn.assign(events), "a")
    rows = state.net_state(txn.committed(assigned)).select("row")
    return sorted((r["id"], r["v"]) for r in project.strict(rows, [Field("id", "i64"), Field("v", "string", optional=True)]).collect()), events, assigned


def test_interleaved_streams_and_parts(spark):
    start = lambda x, first: {"tag": "S", "xid": x, "first_segment": first}
    stop = {"tag": "E"}
    put = lambda x, k: (PUT(k, "s") | {"msg_xid": x}, True)
    out, _, assigned = gold(spark, [
        (REL, False), (start(10, 1), False), put(10, 1), put(11, 2), (stop, False), (start(20, 1), False), put(20, 3), (stop, False), (start(10, 0), False), put(10, 4),
        (stop, False), ({"tag": "A", "xid": 10, "subxid": 11}, False), ({"tag": "A", "xid": 20, "subxid": 20}, False), (BEGIN(30), False), (PUT(5, "p"), False),
        (COMMIT, False), ({"tag": "c", "xid": 10, "flags": 0, "commit_lsn": 5, "end_lsn": 6, "ts": 0}, False), (BEGIN(40), False), (PUT(6, "open"), False),
    ])
    assert out == [(1, "s"), (4, "s"), (5, "p")]
    assert {r["status"]: (r["transactions"], r["changes"]) for r in txn.stats(assigned).collect()} == {"committed": (2, 4), "aborted": (1, 1), "open": (1, 1)}
    assert sorted(r["seq"] for r in txn.discarded(assigned).collect()) == [3, 6]


def test_state_key_change_toast_truncate(spark):
    move = {"tag": "U", "oid": 1, "key_type": "K", "old": [("t", b"1"), ("n", None)], "new": [("t", b"9"), ("t", b"moved")]}
    touch = {"tag": "U", "oid": 1, "new": [("t", b"2"), ("u", None)]}
    drop = {"tag": "D", "oid": 1, "key_type": "K", "old": [("t", b"3"), ("n", None)]}
    null = {"tag": "U", "oid": 1, "new": [("t", b"4"), ("n", None)]}
    cut = {"tag": "T", "flags": 3, "oids": [1, 77]}
    body = [PUT(0, "before"), cut, PUT(1, "a"), PUT(2, "b"), PUT(3, "c"), PUT(4, "d"), move, touch, drop, null, PUT(3, "again")]
    out, events, _ = gold(spark, [(REL, False), (BEGIN(1), False), *[(m, False) for m in body], (COMMIT, False)])
    assert sorted(out, key=str) == sorted([(2, "b"), (3, "again"), (4, None), (9, "moved")], key=str)
    assert events.where("tag = 'T'").first()["truncate_tables"] == ["public.t"]


def test_relation_versions_and_quarantine(spark):
    wide = REL | {"columns": [*REL["columns"], (0, "w", 25, -1)]}
    rows = [(PUT(1, "lost"), False), (REL, False), (REL, False), (PUT(2, "x"), False), (wide, False), (PUT(3, "y"), False), (b"?bad", False), (b"I\0", False)]
    messages = materialise(decode(log(spark, rows), 4), "m")
    events = E.events(messages)
    assert [r["seq"] for r in events.orderBy("seq").collect()] == [3, 4, 5]
    assert {r["seq"]: r["reason"].split(":")[0] for r in E.quarantine(messages).collect()} == {0: "protocol", 6: "protocol", 7: "buffer"}
    assert [(r["valid_from_seq"], r["valid_to_seq"], r["is_change"]) for r in E.relations(messages).orderBy("valid_from_seq").collect()] == [(1, 4, False), (4, None, True)]


def test_empty_log(spark):
    assert E.events(decode(log(spark, []), 4)).count() == 0


def test_carry_over_buckets(spark, monkeypatch):
    from tidelog.operators import carry

    rows = [("a" if k % 2 else "b", k, k if k % 10 == 3 else None, k % 4) for k in range(100)]
    frame = spark.createDataFrame(rows, "slot string, seq long, v long, g long")
    monkeypatch.setattr(carry, "STRETCH", 2)
    log = carry.with_bucket(frame, 8)
    for key, before in (("g", False), (None, False), (None, True)):
        got = {r["seq"]: r["last"] for r in carry.carry_forward(log, {"last": F.col("v"), "other": F.col("g")}, key, before).collect()}
        for slot, seq, _, g in rows:
            seen = [v for s, k, v, h in rows if s == slot and (key is None or h == g) and k <= seq - before and v is not None]
            assert got[seq] == (seen[-1] if seen else None)


def test_scalars(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first()["x"]
    lit = F.lit
    assert one(L.parse_lsn(lit("16/B374D848"))) == 0x16B374D848 and one(L.parse_lsn(lit("16B374D848"))) is None and one(L.parse_lsn(lit("x/1"))) is None
    assert [one(S.parse_signed(lit(x), "i8")) for x in ("127", "128", "-128", "+5", "", " 1", "1.0", "--1")] == [127, None, -128, 5, None, None, None, None]
    assert [one(S.parse_unsigned(lit(x), "u64")) for x in ("18446744073709551615", "18446744073709551616", "-1", "+7")] == [18446744073709551615, None, None, 7]
    assert [one(S.parse_float(lit(x))) for x in ("1.5", "-.5", "1e3", "1.5d", "inf", "-Infinity", "0x1")] == [1.5, -0.5, 1000.0, None, float("inf"), float("-inf"), None]
    assert [one(S.parse_bool(lit(x))) for x in ("t", "on", "no", "T", "y")] == [True, True, False, None, None]
    assert [one(S.server_version(lit(x))) for x in ("16", "16.1 (Debian)", "14.2.1", "x")] == [160000, 160001, 140201, 0]
    assert one(S.quote_literal(lit("a\\'"))) == " E'a\\\\'''" and one(S.quote_ident(lit('a"'))) == '"a"""'
    assert one(S.hex_decode(lit("0fF"))) is None and bytes(one(S.hex_decode(lit("0fFf")))) == b"\x0f\xff"
    assert one(S.mask_password(lit("postgresql://u:secret@h/d"))) == "postgresql://u:***@h/d" and one(S.mask_password(lit("password=x y"))) == "password=*** y"
    assert [one(S.replica_identity(lit(x))) for x in "dnfi?"] == ["default", "nothing", "full", "index", None]
    cell = lambda kind, v: F.struct(lit(kind).alias("kind"), lit(v).cast("binary").alias("value"))
    assert [one(S.display(cell(*x))) for x in (("n", None), ("t", b"hi"), ("b", b"\x01"), ("t", b"\xff"))] == ["NULL", "hi", "\\x01", "<invalid utf-8: 1 bytes>"]
    named = lambda n, k, v: F.struct(lit(n).alias("name"), lit(k).alias("kind"), lit(v).cast("binary").alias("value"))
    row = F.array(named("a", "t", b'q"\n'), named("b", "b", b"\xfe"), named("c", "n", None))
    assert one(project.row_json(row)) == '{"a":"q\\"\\n","b":{"$binary":"fe"},"c":null}' and one(project.as_map(row)) == {"a": 'q"\n', "b": None, "c": None}


def test_projection(spark):
    row = [("id", "t", b"7"), ("flag", "t", b"maybe"), ("name", "n", None), ("raw", "b", b"\x01"), ("mood", "t", b"sad")]
    frame = spark.createDataFrame([(row,)], "row array<struct<name:string,kind:string,value:binary>>")
    fields = [Field("name", "string"), Field("flag", "bool"), Field("raw", "string"), Field("id", "u8"), Field("opt", "i32", optional=True), Field("bytes", "bytes", source="raw")]
    got = project.lenient(frame, fields).first()
    assert (got["name"], got["flag"], got["raw"], got["id"], got["opt"], bytes(got["bytes"])) == ("", False, "", 7, None, b"\x01")
    assert [e["field"] for e in got["errors"]] == ["flag", "name", "raw"]
    assert got["errors"][1]["message"] == "cannot deserialize NULL as String (use Option<String>)"
    for bad in (Field("flag", "bool"), Field("name", "string"), Field("none", "i8"), Field("mood", "enum", variants=("happy",))):
        with pytest.raises(PySparkException):
            project.strict(frame, [bad]).collect()
    assert project.strict(frame, [Field("mood", "enum", variants=("happy", "sad"))]).first()["mood"] == "sad"


def test_framing(spark):
    frames = [b"w" + bytes(7) + b"\1" + bytes(7) + b"\2" + b"\xff" * 8 + b"B", b"w" + bytes(24), b"k" + bytes(7) + b"\5" + bytes(8) + b"\1", b"w", b"zz", b"", None]
    frame = spark.createDataFrame([("s", k, f) for k, f in enumerate(frames)], "slot string, seq long, frame binary")
    assert [(r["wal_start"], r["wal_end"], r["server_time"], bytes(r["data"])) for r in framing.unframe(frame).orderBy("seq").collect()] == [(1, 2, -1, b"B"), (0, 0, 0, b"")]
    assert [(r["wal_end"], r["reply_wanted"]) for r in framing.keepalives(frame).collect()] == [(5, True)]
    assert {r["seq"]: r["reason"] for r in framing.malformed(frame).collect()} == {3: "short data frame", 4: "unknown frame"}


def test_router(spark):
    seen = {}
    router = route.Router().on("orders", "insert", "old").on("orders", "insert", "typed", [Field("o_orderkey", "i64")], lambda d: seen.update(typed=d.agg(F.max("o_orderkey")).first()[0]))
    router.on("orders", "delete", "drops", None, lambda d: seen.update(drops=d.count()))
    router.run(silver.events(spark, SF))
    assert seen == {"typed": 1499, "drops": 375}
    assert route.of_tables(silver.events(spark, SF), "public.orders").where("tag = 'I'").count() == 1500


ROWS = ("seq", "tag", "txn_id")


def _frames(spark, path, low, high, mode="append"):
    silver.bronze(spark, SF).where(f"seq >= {low} and seq < {high}").coalesce(1).sortWithinPartitions("seq").write.mode(mode).parquet(str(path))


def _all(spark, high):
    return silver.committed(spark, SF).where(f"tag in ('I', 'U', 'D') and commit_seq < {high}").select(*ROWS).toPandas()


def test_stream_equals_batch(spark, tmp_path):
    """A stream that is stopped, gets more files and is started again gives the batch's rows, each once."""
    from tidelog.sources import capture
    from tidelog.streaming.replay import Replay

    for high, low in ((4300, 0), (7500, 4300), (9000, 7500)):
        _frames(spark, tmp_path / "frames", low, high)
        replay = Replay(spark, str(tmp_path / "out"), 4)
        query = replay.start(str(tmp_path / "frames"), str(tmp_path / "checkpoint"), maxFrames="1730")
        query.processAllAvailable()
        query.stop()
        got = replay.changes().where("tag in ('I', 'U', 'D')").select(*ROWS).toPandas()
        assert_same(got, _all(spark, high))
    capture.register(spark)
    batch = spark.read.format("tidelog").option("path", str(tmp_path / "frames")).option("startLsn", "16/B374D848").load()
    native = capture.frames(spark, str(tmp_path / "frames"), start_lsn="16/B374D848")
    assert batch.count() == native.count() == silver.bronze(spark, SF).where(f"seq < 9000 and wal_start >= {0x16B374D848}").count()


def test_stream_is_killed_inside_a_batch(spark, tmp_path):
    """A handler that fails is run again with the same rows, and a batch that is done is not handled twice."""
    from tidelog.streaming.replay import Replay

    _frames(spark, tmp_path / "frames", 0, 4300)
    calls, fail = [], {1: True}

    def handler(rows, number):
        calls.append((number, sorted(r["seq"] for r in rows.collect())))
        if fail.pop(number, False):
            raise RuntimeError("killed")

    run = lambda: Replay(spark, str(tmp_path / "out"), 4, handler)
    start = lambda: run().start(str(tmp_path / "frames"), str(tmp_path / "checkpoint"), maxFrames="1730")
    query = start()
    with pytest.raises(Exception, match="killed"):
        query.processAllAvailable()
    query = start()
    query.processAllAvailable()
    query.stop()
    numbers = [n for n, _ in calls]
    assert numbers.count(1) == 2 and [s for n, s in calls if n == 1][0] == [s for n, s in calls if n == 1][1]
    assert sorted(set(numbers)) == numbers[:2] + numbers[3:]
    run().batch(silver.bronze(spark, SF).where("seq < 100"), 0)
    assert [n for n, _ in calls] == numbers
    assert_same(run().changes().where("tag in ('I', 'U', 'D')").select(*ROWS).toPandas(), _all(spark, 4300))


def test_offsets_only_grow(spark, tmp_path):
    from tidelog.errors import LogError
    from tidelog.sources.capture import StreamReader

    _frames(spark, tmp_path / "frames", 0, 2000)
    options = {"path": str(tmp_path / "frames"), "maxframes": "700", "progress": str(tmp_path / "progress")}
    first = StreamReader(options)
    told = [first.latestOffset()["seq"] for _ in range(2)]
    again = StreamReader(options)
    told += [again.latestOffset()["seq"] for _ in range(4)]
    assert told == sorted(told) and told[0] < told[1] < told[2] and told[-1] == 1 + silver.bronze(spark, SF).where("seq < 2000").agg(F.max("seq")).first()[0]
    unknown = StreamReader({"path": options["path"], "maxframes": "700"})
    assert unknown.latestOffset()["seq"] == told[-1]
    _frames(spark, tmp_path / "frames", 100, 200)
    with pytest.raises(LogError, match="read already"):
        again.latestOffset()


def test_files_without_statistics(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    from tidelog.sources import capture

    rows = silver.bronze(spark, SF).where("seq < 1100").orderBy("seq").toArrow()
    (tmp_path / "frames").mkdir()
    pq.write_table(rows, tmp_path / "frames" / "a.parquet", write_statistics=False, row_group_size=70)
    pq.write_table(rows.slice(0, 0), tmp_path / "frames" / "empty.parquet")
    capture.register(spark)
    got = spark.read.format("tidelog").option("path", str(tmp_path / "frames")).load().toArrow().sort_by("seq")
    assert got.column("seq").to_pylist() == rows.column("seq").to_pylist() and got.column("data").to_pylist() == rows.column("data").to_pylist()
    assert pa.types.is_int64(got.schema.field("seq").type)


def test_many_transactions_and_blocks(spark, monkeypatch):
    """The ways for logs with many marks, versions and notes give the same events as those that send them to every worker."""
    from tidelog.operators import decode as D

    def made():
        messages = materialise(decode(silver.bronze(spark, SF, "parts").unionByName(silver.bronze(spark, SF)), 4), "m")
        return E.events(messages, txn.assign(messages)).select("slot", "seq", "txn_id", "txn_seq", "stream_xid", "table", "new_row", "truncate_tables").collect()

    few = made()
    for module, name in ((D, "FEW_MARKS"), (txn, "FEW_MARKS"), (E, "FEW_COLUMNS"), (E, "FEW_NOTED")):
        monkeypatch.setattr(module, name, 1)
    assert sorted(map(str, made())) == sorted(map(str, few)) and len(few) > 2500


FULL = REL | {"oid": 2, "name": "f", "replident": ord("f"), "columns": [(1, "id", 20, -1), (1, "v", 25, -1)]}
BARE = REL | {"oid": 3, "name": "bare", "columns": [(0, "id", 20, -1), (0, "v", 25, -1)]}


def _to(m, oid):
    return m | {"oid": oid}


def test_rows_without_a_key(spark):
    t = lambda k, v: [("t", str(k).encode()), ("u", None) if v is None else ("t", v.encode())]
    old = lambda tag, oid, k, v, new=None: {"tag": tag, "oid": oid, "key_type": "O", "old": t(k, v)} | ({"new": t(*new)} if new else {})
    body = [_to(PUT(1, "a"), 3), _to(PUT(1, "a"), 3), _to(PUT(2, "b"), 3), _to(PUT(1, "x"), 2), _to(PUT(1, "x"), 2), old("U", 2, 1, "x", (7, None)), old("D", 2, 7, "x"), _to(PUT(9, "y"), 2)]
    out, *_ = gold(spark, [(m, False) for m in [REL, FULL, BARE, BEGIN(1), *body, COMMIT]])
    assert out == [(1, "a"), (1, "a"), (1, "x"), (2, "b"), (9, "y")]
    with pytest.raises(PySparkException, match="no key and no old row"):
        gold(spark, [(m, False) for m in [BARE, BEGIN(1), {"tag": "U", "oid": 3, "new": t(1, "z")}, COMMIT]])


def test_reused_xid(spark):
    start, put = {"tag": "S", "xid": 5, "first_segment": 1}, PUT(2, "aborted") | {"msg_xid": 5}
    log = [(REL, False), (start, False), (put, True), ({"tag": "E"}, False), ({"tag": "A", "xid": 5, "subxid": 5}, False), (BEGIN(5), False), (PUT(6, "kept"), False), (COMMIT, False)]
    out, _, assigned = gold(spark, log)
    assert out == [(6, "kept")]
    assert sorted((r["txn_id"], r["txn_seq"], r["status"]) for r in txn.outcomes(assigned).collect()) == [(5, 1, "aborted"), (5, 5, "committed")]


def test_history_fills_and_ends_with_a_truncate(spark):
    touch = {"tag": "U", "oid": 1, "new": [("t", b"1"), ("u", None)]}
    first = [PUT(1, "a"), touch, PUT(2, "b")]
    cut = {"tag": "T", "flags": 0, "oids": [1]}
    second = [cut, PUT(1, "c"), touch]
    log = [(m, False) for m in [REL, BEGIN(1), *first, COMMIT, BEGIN(2), *second, COMMIT]]
    _, _, assigned = gold(spark, log)
    changes = materialise(txn.committed(assigned), "c")
    text = lambda r, n: next(bytes(c["value"]).decode() for c in r["row"] if c["name"] == n)
    got = sorted(((text(r, "id"), text(r, "v"), r["valid_from"], r["valid_to"]) for r in state.history(changes).collect()), key=str)
    assert got == sorted([("1", "a", 5, 5), ("1", "a", 5, 10), ("2", "b", 5, 10), ("1", "c", 10, 10), ("1", "c", 10, None)], key=str)
    filled = state.toast_fill(changes, ["v"]).where("tag = 'U'").orderBy("seq").collect()
    assert [bytes(r["v"]["value"]).decode() for r in filled] == ["a", "c"]


def test_typed_changes_and_json(spark):
    from tidelog.sources import fixtures as X

    ts = datetime.datetime(2024, 1, 2, 3, 4, 5, 250_000)
    events = [
        X.insert("public", "t", 1, X.row(id="1", v=None), lsn=7), X.update("public", "t", 1, None, X.row(id="1", v="b")), X.delete("public", "t", 1, X.row(id="1", v="b"), "full", ["id", "v"]),
        X.begin(5, 9, ts), X.stream_stop(), X.truncate(["public.t"]), X.message(1, 3, "p", b"\x01\xff"), X.stream_abort(5, 6), X.relation(1, "public", "t", [("id", 20, -1, True)]),
        X.prepared("r", 5, "g", ts, prepare_lsn=1, end_lsn=2), X.type_(9, "public", "mood"), X.origin(4, "far"), X.commit(ts, 1, 2), X.stream_start(5, True), X.stream_commit(5, 1, 2, ts),
    ]
    frame = X.frame(spark, events)
    said = [json.loads(r["j"]) for r in frame.orderBy("seq").select(project.event_json().alias("j")).collect()]
    assert said[0] == {"event_type": {"Insert": {"schema": "public", "table": "t", "relation_oid": 1, "data": {"id": "1", "v": None}}}, "lsn": 7, "metadata": None}
    assert said[1]["event_type"]["Update"]["old_data"] is None and said[2]["event_type"]["Delete"]["replica_identity"] == "Full"
    assert said[3]["event_type"]["Begin"] == {"transaction_id": 5, "final_lsn": 9, "commit_timestamp": "2024-01-02T03:04:05.250Z"}
    assert said[4]["event_type"] == "StreamStop" and said[5]["event_type"] == {"Truncate": ["public.t"]} and said[6]["event_type"]["Message"]["content"] == [1, 255]
    assert said[7]["event_type"]["StreamAbort"]["abort_lsn"] is None and said[8]["event_type"]["Relation"]["columns"] == [{"name": "id", "type_id": 20, "type_modifier": -1, "is_key": True}]
    assert [next(iter(x["event_type"])) for x in said[9:]] == ["RollbackPrepared", "Type", "Origin", "Commit", "StreamStart", "StreamCommit"]
    fields = [Field("id", "i64"), Field("v", "string", optional=True)]
    got = project.typed_changes(frame.where("tag = 'U'"), "update", fields).first()
    assert got["old"] is None and (got["new"]["id"], got["new"]["v"]) == (1, "b")
    assert project.typed_changes(frame.where("tag = 'D'"), "delete", fields).first()["old"]["id"] == 1
    with pytest.raises(PySparkException, match="expected Update event, got"):
        project.typed_changes(frame, "update", fields).collect()
    back = lambda text: spark.range(1).select(project.row_from_json(F.lit(text)).alias("r")).first()["r"]
    assert [tuple(c) for c in back('{"b":"x","a":null,"c":{"$binary":"00ff"},"d":"{\\"$binary\\":1}"}')] == [("b", "t", b"x"), ("a", "n", None), ("c", "b", b"\0\xff"), ("d", "t", b'{"$binary":1}')]
    assert back('{"a":1}') is None and back('{"a":{"$binary":"0"}}') is None and back("{}") == []
    lenient = project.lenient(frame.where("tag = 'I'").select(F.col("new_row").alias("row")), [Field("id", "i64"), Field("v", "string")])
    with pytest.raises(PySparkException, match="v: cannot deserialize NULL"):
        project.into_result(lenient).collect()
    assert project.into_result(lenient.withColumn("errors", F.slice("errors", 1, 0))).count() == 1


def test_handlers_by_type(spark):
    @route.wal_table("orders")
    class Order:
        o_orderkey: int
        o_orderstatus: str | None
        note: str = "none"

    seen = {}
    router = route.Router().on_table(Order, "insert", lambda d: seen.update(top=d.agg(F.max("o_orderkey")).first()[0], columns=d.columns))
    router.run(silver.events(spark, SF))
    assert seen["top"] == 1499 and seen["columns"][-3:] == ["o_orderkey", "o_orderstatus", "note"]
    with pytest.raises(ValueError, match="bound to no table"):
        route.Router().on_table(dict, "insert", print)


def test_consumer(spark, tmp_path):
    from tidelog.streaming.consumer import Consumer
    from tidelog.streaming.replay import Replay

    _frames(spark, tmp_path / "frames", 0, 3500)
    numbers = []
    consumer = Consumer(Replay(spark, str(tmp_path / "out"), 4, lambda rows, n: numbers.append(n)))
    consumer.run(str(tmp_path / "frames"), str(tmp_path / "checkpoint"), maxFrames="1800")
    top = silver.committed(spark, SF).where("commit_seq < 3500").agg(F.max("txn_end_lsn")).first()[0]
    assert consumer.tracker.applied == top and numbers == [0, 1] and not consumer.healthy()
    assert consumer.sent[-1] == wire.copy_done() and consumer.sent[-2][:25] == wire.standby_status(top, top, top, 0)[:25]
    order = [(r["commit_seq"], r["seq"]) for r in consumer.events()]
    assert order == sorted(order) and len(order) == consumer.replay.changes().count()


def test_consumer_stops_at_a_target_and_goes_on(spark, tmp_path):
    """Every change is handled once by the two runs together, and the first one ends with the commit that reaches the target."""
    from tidelog.streaming.consumer import Consumer
    from tidelog.streaming.replay import Replay

    _frames(spark, tmp_path / "frames", 0, 9000)
    at = lambda seq: 97_500_059_648 + 64 * seq
    handled: list[list[int]] = []
    run = lambda target: Consumer(Replay(spark, str(tmp_path / "out"), 4, lambda rows, n: handled.append([r["commit_seq"] for r in rows.collect()])), target=target)
    first = run(at(2700))
    first.run(str(tmp_path / "frames"), str(tmp_path / "checkpoint"), maxFrames="1000")
    stop = silver.committed(spark, SF).where(F.col("txn_end_lsn") >= at(2700)).agg(F.min("commit_seq")).first()[0]
    seen = [c for batch in handled for c in batch]
    assert first.reached.is_set() and max(seen) == stop and first.tracker.applied == at(stop + 1)
    second = run(None)
    second.run(str(tmp_path / "frames"), str(tmp_path / "checkpoint"), maxFrames="2500")
    later = [c for batch in handled for c in batch][len(seen) :]
    assert min(later) > stop and len(seen) + len(later) == silver.committed(spark, SF).where("commit_seq < 9000").count()
    assert_same(second.replay.changes().where("tag in ('I', 'U', 'D')").select(*ROWS).toPandas(), _all(spark, 9000))


def test_consumer_by_hand_confirms_only_what_is_whole(spark, tmp_path):
    """Transactions are said to be done from the last to the first: nothing is confirmed before the first one is."""
    from tidelog.streaming.consumer import Consumer
    from tidelog.streaming.replay import Replay

    _frames(spark, tmp_path / "frames", 0, 2500)
    consumer = Consumer(Replay(spark, str(tmp_path / "out"), 4), by_hand=True)
    consumer.run(str(tmp_path / "frames"), str(tmp_path / "checkpoint"))
    ends = consumer.frontier.pending()
    assert len(ends) > 4 and consumer.tracker.applied == 0
    assert [consumer.done(e) for e in reversed(ends[1:])] == [0] * (len(ends) - 1)
    assert consumer.done(ends[0]) == ends[-1] == consumer.tracker.applied


def test_consumer_recovers(spark, tmp_path):
    """Errors that are retried start the query again at the batch that failed; permanent ones and those of the code do not."""
    from tidelog.errors import LogError
    from tidelog.streaming.consumer import Consumer
    from tidelog.streaming.replay import Replay

    _frames(spark, tmp_path / "frames", 0, 2500)
    calls, waits, errors = [], [], [LogError("connection_transient", "gone"), LogError("timeout", "late")]

    def handler(rows, number):
        calls.append(number)
        if number == 1 and errors:
            raise errors.pop(0)

    def keep(replay, **kw):
        consumer = Consumer(replay)
        consumer.keep_running(str(tmp_path / "frames"), str(tmp_path / "checkpoint"), sleep=waits.append, maxFrames="900", **kw)
        return consumer

    consumer = keep(Replay(spark, str(tmp_path / "out"), 4, handler))
    assert calls[:4] == [0, 1, 1, 1] and calls == sorted(calls) and len(set(calls)) == len(calls) - 2 and len(waits) == 2
    assert consumer.tracker.applied == consumer.frontier.safe > 0 and consumer.sent[-1] == wire.copy_done()
    _frames(spark, tmp_path / "frames", 2500, 3500)
    for error in (LogError("authentication", "no"), RuntimeError("a bug")):
        errors[:] = [error]
        with pytest.raises(type(error), match=str(error)):
            keep(Replay(spark, str(tmp_path / "out"), 4, lambda rows, n: (_ for _ in ()).throw(errors[0])))
    assert len(waits) == 2


def test_frontier():
    f = frontier.Frontier(safe=10)
    for end in (10, 20, 30, 40):
        f.expect(end)
    assert [f.apply(x) for x in (30, 30, 20, 5, 50, 40)] == [10, 10, 30, 30, 30, 50] and f.pending() == []


def test_rates_and_slots_of_a_source(spark, tmp_path):
    """A bucket saves up a burst over a pause and no more; other slots of the folder do not count, even behind what was read."""
    from tidelog.sources.capture import StreamReader

    rows = spark.range(1000).selectExpr("'a' as slot", "id as seq", "id as wal_start", "id as wal_end", "0L as server_time", "unhex('42') as data")
    rows.coalesce(1).write.option("parquet.block.row.count.limit", "100").parquet(str(tmp_path / "frames"))
    now = [0.0]
    reader = StreamReader({"path": str(tmp_path / "frames"), "slot": "a", "maxframes": "800", "progress": str(tmp_path / "p"), "framespersecond": "100", "burst": "2"}, clock=lambda: now[0])
    told = []
    for at in (0.0, 0.0, 1.0, 1.5, 60.0, 60.0, 61.0, 62.0, 63.0, 64.0, 65.0):
        now[0] = at
        told.append(reader.latestOffset()["seq"])
    assert told[:8] == [200, 200, 300, 350, 550, 550, 650, 750] and told[-1] == 1000
    spark.range(50).selectExpr("'b' as slot", "id as seq", "id as wal_start", "id as wal_end", "0L as server_time", "unhex('42') as data").write.mode("append").parquet(str(tmp_path / "frames"))
    assert reader.latestOffset()["seq"] == 1000
    capture_all = StreamReader({"path": str(tmp_path / "frames"), "slot": "b"})
    assert capture_all.latestOffset()["seq"] == 50


def test_values(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first()["x"]
    cell = lambda kind, v: F.struct(F.lit(kind).alias("kind"), F.lit(v).cast("binary").alias("value"))
    assert [one(S.wire_text(cell(*x))) for x in (("t", b"hi"), ("b", b"raw"), ("t", b""), ("n", None))] == ["hi", "raw", None, None]
    assert [one(f(cell("b", b"x"))) for f in (S.is_null, S.is_text, S.is_binary, S.is_unchanged)] == [False, False, True, False]
    assert [one(S.slot_type_name(F.lit(x))) for x in (True, False)] == ["LOGICAL", "PHYSICAL"]
    big = (1 << 63) + 5
    assert int(one(L.unsigned(F.lit(big - (1 << 64)).cast("long")))) == big and one(L.from_unsigned(F.lit(str(big)).cast("decimal(20,0)"))) == big - (1 << 64)
    columns = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(20).alias("type_id")) for n in ("id", "v")])
    assert one(E.columns_by_place(columns, 1, 5)) == ["v", None] and one(E.column_by_name(columns, "v"))["type_id"] == 20


def test_imports_without_llm(tmp_path):
    """The entry module works where the llm folders and the pipeline's module are not there."""
    import shutil

    for p in ("tidelog", "__spark_entry__.py"):
        source = ROOT / p
        shutil.copytree(source, tmp_path / p, ignore=shutil.ignore_patterns("llm", "__pycache__")) if source.is_dir() else shutil.copy(source, tmp_path / p)
    code = "import __spark_entry__ as e; assert 'net_state' in e.queries() and not any(k.startswith('op') for k in e.queries()); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path), "HOME": str(tmp_path)}, check=True, timeout=120)
