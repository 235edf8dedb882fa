"""Positions of 2**63 and more: they order behind the others in every layer."""

from __future__ import annotations

import struct

from pyspark.sql import functions as F

from tidelog.functions import lsn as L
from tidelog.operators import frontier, project, sessions, txn
from tidelog.operators.decode import decode
from tidelog.operators.encode import frames
from tidelog.operators.framing import keepalives, malformed, unframe
from tidelog.sources import capture, wire
from tidelog.sources.commands import lsn_text

EDGE = 1 << 63
PLACES = (0, 1, 77, EDGE - 1, EDGE, EDGE + 1, EDGE + (1 << 40), L.MASK)
SCHEMA = "slot string, seq long, wal_start long, wal_end long, server_time long, data binary"


def test_values(spark):
    rows = spark.createDataFrame([(L.bits(a), L.bits(b)) for a in PLACES for b in PLACES], "a long, b long")
    a, b = F.col("a"), F.col("b")
    text = L.format_lsn(a)
    made = rows.select("a", "b", (L.ordered(a) < L.ordered(b)).alias("less"), text.alias("text"), L.parse_lsn(text).alias("back"), L.capped(a, b).alias("capped"), L.unsigned(a).alias("u"), *[L.at_or_past(a, p).alias(f"p{k}") for k, p in enumerate(PLACES)])
    for r in made.collect():
        x, y = L.position(r["a"]), L.position(r["b"])
        assert r["less"] == (x < y) and r["text"] == lsn_text(x) and r["back"] == r["a"] and int(r["u"]) == x
        assert L.position(r["capped"]) == (min(x, y) if x else 0)
        assert [r[f"p{k}"] for k in range(len(PLACES))] == [x >= p for p in PLACES]
    assert L.position(rows.agg(L.highest(a).alias("top")).first()["top"]) == L.MASK and rows.limit(0).agg(L.highest(a).alias("top")).first()["top"] is None
    assert spark.range(1).select(L.parse_lsn(F.lit("100000000/0")).alias("x")).first()["x"] is None


def commit(end: int) -> bytes:
    return b"C\0" + struct.pack(">QQq", end - 8, end, 0)


def log(spark, places, slot="s"):
    return spark.createDataFrame([(slot, k, L.bits(p), L.bits(p + 8), 5, bytearray(commit(p + 8))) for k, p in enumerate(places)], SCHEMA)


PATH = [EDGE - 64 + 16 * k for k in range(8)]


def test_frames_messages_and_stops(spark):
    sent = log(spark, PATH)
    framed = frames(sent).select("slot", "seq", "frame")
    assert [tuple(r) for r in unframe(framed).orderBy("seq").collect()] == [tuple(r) for r in sent.orderBy("seq").collect()]
    alive = spark.createDataFrame([("s", 1, bytearray(b"k" + struct.pack(">QqB", EDGE + 9, -3, 1)))], "slot string, seq long, frame binary")
    assert [(L.position(r["wal_end"]), r["server_time"], r["reply_wanted"]) for r in keepalives(alive).collect()] == [(EDGE + 9, -3, True)]
    assert malformed(framed).count() == 0
    messages = decode(unframe(framed), 1)
    assert [L.position(r["end_lsn"]) for r in messages.orderBy("seq").collect()] == [p + 8 for p in PATH] and messages.where("error is not null").count() == 0
    for target in (0, EDGE - 50, EDGE - 1, EDGE, EDGE + 1, EDGE + 20, L.MASK):
        want = next((k for k, p in enumerate(PATH) if p + 8 >= target), 7) + 1
        assert txn.bounded_replay(messages, target).count() == want == txn.bounded_replay_raw(sent, target).count()


def test_json_says_positions_without_sign(spark):
    columns = "commit_lsn long, end_lsn long, lsn long, tag string, event_ts timestamp, xid long, flags int, gid string, schema string, table string, relation_oid long, replica_identity string, key_columns array<string>, final_lsn long, first_segment boolean, subxid long, abort_lsn long, message_lsn long, origin_name string, prefix string, content binary, prepare_lsn long, prepare_event_ts timestamp, truncate_tables array<string>, metadata struct<a:int>, new_row array<struct<name:string,type_id:long,kind:string,value:binary>>, old_row array<struct<name:string,type_id:long,kind:string,value:binary>>, relation_columns array<struct<name:string,type_id:long,type_modifier:int,is_key:boolean>>"
    names = {"commit_lsn": EDGE + 1, "end_lsn": L.MASK, "lsn": EDGE}
    typed = [c.strip().split(" ", 1) for c in _split(columns)]
    text = spark.range(1).select(*[F.lit(L.bits(names[n]) if n in names else "C" if n == "tag" else None).cast(t).alias(n) for n, t in typed])
    got = text.select(project.event_json().alias("j")).first()["j"]
    assert f'"commit_lsn":{EDGE + 1},"end_lsn":{L.MASK}' in got and f'"lsn":{EDGE},' in got


def _split(columns: str) -> list[str]:
    """Columns of a schema's text; commas inside brackets part nothing."""
    out, depth = [""], 0
    for c in columns:
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append("")
        else:
            out[-1] += c
    return out


def test_capture(spark, tmp_path):
    path = str(tmp_path / "frames")
    log(spark, PATH).coalesce(1).sortWithinPartitions("seq").write.option("parquet.block.row.count.limit", "2").parquet(path)
    for start in (0, EDGE - 33, EDGE, EDGE + 17):
        want = [p for p in PATH if p >= start]
        assert sorted(L.position(r["wal_start"]) for r in capture.frames(spark, path, start_lsn=lsn_text(start)).collect()) == want
        reader = capture.Reader({"path": path, "startlsn": lsn_text(start)})
        assert sorted(L.position(x) for part in reader.partitions() for b in reader.read(part) for x in b.column("wal_start").to_pylist()) == want
    for stop in (EDGE - 40, EDGE, EDGE + 9, L.MASK):
        reader = capture.StreamReader({"path": path, "stopat": lsn_text(stop)})
        assert reader.latestOffset()["seq"] == next((k + 1 for k, p in enumerate(PATH) if p + 8 >= stop), 8)


def test_sessions_and_frontier(spark):
    """A session that begins again before the edge, one that leaves a hole behind it."""
    parts = {1: PATH[:5], 2: PATH[3:7], 3: [EDGE + 1000]}
    made = [log(spark, places).withColumn("session", F.lit(n).cast("long")) for n, places in parts.items()]
    captured = made[0].unionByName(made[1]).unionByName(made[2])
    assert [L.position(r["wal_start"]) for r in sessions.merged(captured).orderBy("seq").collect()] == [*PATH[:7], EDGE + 1000]
    assert [(r["session"], L.position(r["gap_from"]), L.position(r["gap_to"])) for r in sessions.gaps(captured).collect()] == [(3, PATH[6] + 8, EDGE + 1000)]
    commits = decode(log(spark, PATH), 1).select("slot", "seq", "end_lsn")
    steps = commits.where("seq < 6").select("slot", "seq", (F.col("seq") % 3).alias("step"))
    assert sorted((r["step"], L.position(r["safe_lsn"])) for r in frontier.frontier(commits, steps).collect()) == [(0, PATH[0] + 8), (1, PATH[1] + 8), (2, PATH[5] + 8)]


def test_status_bytes():
    assert wire.standby_status(L.MASK, EDGE + 1, EDGE, 0)[1:25] == struct.pack(">QQQ", L.MASK, EDGE + 1, EDGE)
