from __future__ import annotations

import random
import struct

import pytest

from tidelog.errors import CLASSES, LogError
from tidelog.operators.progress import Tracker
from tidelog.sources import commands as C
from tidelog.sources import options as O
from tidelog.sources import wire


def test_quoting():
    assert C.ident('a"b') == '"a""b"' and C.literal("it's") == "'it''s'" and C.literal("a\\b'") == " E'a\\\\b'''"
    with pytest.raises(LogError):
        C.ident("a\0")


def test_slots():
    assert C.create_slot("s") == 'CREATE_REPLICATION_SLOT "s" LOGICAL "pgoutput";'
    both = C.SlotOptions(temporary=True, two_phase=True, snapshot="nothing")
    assert C.create_slot("s", options=both) == 'CREATE_REPLICATION_SLOT "s" TEMPORARY LOGICAL "pgoutput" TWO_PHASE NOEXPORT_SNAPSHOT;'
    failover = C.SlotOptions(two_phase=True, snapshot="use", failover=True)
    assert C.create_slot("s", options=failover) == "CREATE_REPLICATION_SLOT \"s\" LOGICAL \"pgoutput\" (TWO_PHASE, SNAPSHOT 'use', FAILOVER);"
    assert C.create_slot("p", logical=False, options=C.SlotOptions(reserve_wal=True)) == 'CREATE_REPLICATION_SLOT "p" PHYSICAL RESERVE_WAL;'
    assert C.alter_slot("s", two_phase=True, failover=False) == 'ALTER_REPLICATION_SLOT "s" (TWO_PHASE true, FAILOVER false);'
    assert C.drop_slot("s", True) == 'DROP_REPLICATION_SLOT "s" WAIT;' and C.read_slot("s") == 'READ_REPLICATION_SLOT "s";'
    bad = [lambda: C.create_slot("s", options=C.SlotOptions(snapshot="x")), lambda: C.create_slot("s", plugin=None), lambda: C.alter_slot("s")]
    bad += [lambda: C.create_slot("s", options=C.SlotOptions(failover=True, temporary=True)), lambda: C.create_slot("s", False, None, C.SlotOptions(failover=True))]
    for b in bad:
        with pytest.raises(LogError):
            b()


def test_start():
    assert C.start_logical("s") == 'START_REPLICATION SLOT "s" LOGICAL 0/0'
    assert C.start_logical("s", 0x16B374D848, {"proto_version": "2"}) == "START_REPLICATION SLOT \"s\" LOGICAL 16/B374D848 (\"proto_version\" '2')"
    assert C.start_physical(None, 255, 3) == "START_REPLICATION PHYSICAL 0/FF TIMELINE 3"
    with pytest.raises(LogError):
        C.start_physical("s", timeline=0)
    assert C.lsn_number("16/b374d848") == 0x16B374D848
    for t in ("", "1", "g/0", "1/", "+1/2"):
        with pytest.raises(LogError):
            C.lsn_number(t)


def test_subscriptions():
    assert C.create_subscription("s", "host=x", "p", "sl", enabled=False) == (
        "CREATE SUBSCRIPTION \"s\" CONNECTION 'host=x' PUBLICATION \"p\" WITH (create_slot = true, slot_name = 'sl', enabled = false, copy_data = true)"
    )
    assert C.detach_subscription("s") == 'ALTER SUBSCRIPTION "s" SET (slot_name = NONE)'
    assert C.disable_subscription("s") == 'ALTER SUBSCRIPTION "s" DISABLE' and C.drop_subscription("s") == 'DROP SUBSCRIPTION "s"'


def test_preflight():
    C.preflight(0, *C.NEEDS)
    C.preflight(180_001, *C.NEEDS)
    with pytest.raises(LogError, match="PostgreSQL 17"):
        C.preflight(160_003, "two_phase", "failover")


def test_stream_options():
    assert C.StreamOptions(("a", "b"), 4, "parallel", binary=True, two_phase=True, origin="none").options() == {
        "proto_version": "4", "publication_names": '"a","b"', "binary": "on", "two_phase": "on", "streaming": "parallel", "origin": "none",
    }
    for o in (C.StreamOptions((), 5), C.StreamOptions((), 1, "on"), C.StreamOptions((), 2, "parallel"), C.StreamOptions((), 2, two_phase=True), C.StreamOptions((), origin="x")):
        with pytest.raises(LogError):
            o.options()


def test_connections(monkeypatch):
    monkeypatch.setenv("PGPASSWORD", "env")
    got = O.parse_connection("postgresql://me:p%40ss@[::1]:5433/db?sslmode=require&application_name=x%20y")
    assert (got["user"], got["password"], got["host"], got["port"], got["dbname"], got["application_name"]) == ("me", "p@ss", "::1", "5433", "db", "x y")
    got = O.parse_connection(r"host = h user='it\'s' port=1")
    assert (got["host"], got["user"], got["password"], got["dbname"]) == ("h", "it's", "env", "it's")
    for bad in ("host", "port=x", "sslmode=maybe", "postgres://h:p:q/x"):
        with pytest.raises(LogError):
            O.parse_connection(bad)
    assert O.percent_decode("%41%zz+") == "A%zz+"


def test_retry():
    waits, calls = [], []

    def act():
        calls.append(1)
        raise LogError("timeout" if len(calls) < 3 else "authentication", "no")

    with pytest.raises(LogError, match="no"):
        O.with_retry(act, waits.append, 5)
    assert len(calls) == 3 and len(waits) == 2
    assert all(0.7 <= O.backoff(0, rng=random.Random(k)) <= 1.3 for k in range(20)) and O.backoff(30, jitter=0) == 60
    assert {LogError(k, "").retried for k in CLASSES} == {True, False}


def test_tracker():
    t = Tracker()
    for a, f, r in ((5, 3, 4), (2, 9, 7), (0, 0, 0)):
        t.apply(a), t.flush(f), t.receive(r)
    assert (t.applied, t.flushed, t.received) == (5, 9, 7) and t.feedback() == (7, 5)


def test_base_backup():
    assert C.base_backup() == "BASE_BACKUP"
    every = C.BackupOptions("l'a", "server", "/tmp", True, "fast", True, True, "gzip", "level=5", 1000, True, True, "yes", "SHA256", True)
    assert C.base_backup(every) == (
        "BASE_BACKUP (LABEL 'l''a', TARGET 'server', TARGET_DETAIL '/tmp', PROGRESS true, CHECKPOINT 'fast', WAL true, WAIT true, COMPRESSION 'gzip', "
        "COMPRESSION_DETAIL 'level=5', MAX_RATE 1000, TABLESPACE_MAP true, VERIFY_CHECKSUMS true, MANIFEST 'yes', MANIFEST_CHECKSUMS 'SHA256', INCREMENTAL)"
    )
    assert C.prepare_base_backup(140_000) == "BASE_BACKUP" and C.prepare_base_backup(0, every) == C.base_backup(every)
    for version, options in ((140_005, C.BackupOptions(label="x")), (160_000, every)):
        with pytest.raises(LogError):
            C.prepare_base_backup(version, options)


def test_prepared_commands():
    assert C.prepare_create_slot(140_000, "p", False) == C.create_slot("p", False) and C.prepare_read_slot(0, "s") == C.read_slot("s")
    assert C.prepare_alter_slot(180_000, "s", two_phase=True) == C.alter_slot("s", two_phase=True)
    with pytest.raises(LogError, match=r"TWO_PHASE replication slots require PostgreSQL 15\+, but the server reports 14.2"):
        C.prepare_create_slot(140_002, "s", options=C.SlotOptions(two_phase=True))
    for act in (lambda: C.prepare_alter_slot(170_000, "s", two_phase=True), lambda: C.prepare_alter_slot(160_000, "s", failover=True), lambda: C.prepare_read_slot(140_000, "s")):
        with pytest.raises(LogError, match="requires PostgreSQL"):
            act()


def test_initialise():
    said = []
    assert C.initialise(said.append, "s") and said == ["IDENTIFY_SYSTEM", C.create_slot("s")]

    def there(sql):
        if sql.startswith("CREATE"):
            raise LogError("backend", 'replication slot "s" already exists')

    assert not C.initialise(there, "s")


def test_feedback():
    from tidelog.operators.progress import Feedback

    now, t = [0.0], Tracker()
    f = Feedback(t, interval=10, clock=lambda: now[0])
    assert f.status() is None and f.status(force=True) is None
    t.receive(9), t.apply(5)
    assert f.status() == wire.standby_status(9, 5, 5, 0) and f.status() is None
    t.flush(7)
    assert f.status() is None
    now[0] = 10.0
    assert f.status() == wire.standby_status(9, 7, 5, 0)
    now[0] = 30.0
    assert f.status() is None
    asks = lambda end, wanted: b"k" + struct.pack(">QqB", end, 0, wanted)
    assert f.keepalive(asks(12, 0)) == wire.standby_status(12, 7, 5, 0) and f.keepalive(asks(3, 1)) == wire.standby_status(12, 7, 5, 0)
    assert f.end() == [wire.standby_status(12, 7, 5, 0), b"c\0\0\0\4"] and f.end() == []
    assert wire.hot_standby_feedback(-1, 1, 2, 3, 4) == b"h" + struct.pack(">qIIII", -1, 1, 2, 3, 4)


def test_result_set():
    column = lambda name: name + b"\0" + bytes(18)
    head = struct.pack(">H", 2) + column(b"a") + column(b"b")
    row = struct.pack(">Hi", 2, 2) + b"hi" + struct.pack(">i", -1)
    empty = struct.pack(">Hii", 2, 0, 0)
    got = wire.result_set([("N", b"SNOTICE\0\0"), ("T", head), ("D", row), ("D", empty), ("C", b"SELECT 2\0"), ("Z", b"I"), ("D", row)])
    assert got == [{"a": b"hi", "b": None}, {"a": b"", "b": b""}]
    with pytest.raises(LogError, match=r"ERROR: no such slot \(42704\)"):
        wire.result_set([("E", b"SERROR\0C42704\0Mno such slot\0\0")])


def test_poll():
    from tidelog.streaming.consumer import Poll

    def of(*steps):
        for s in steps:
            if isinstance(s, str):
                raise LogError(s, s)
            yield s

    p = Poll(of(1, 2))
    assert [p.next() for _ in range(4)] == [1, 2, None, None]
    p = Poll(of(1, "stopped"))
    assert [p.next() for _ in range(3)] == [1, None, None]
    p = Poll(of("authentication"))
    with pytest.raises(LogError):
        p.next()
    assert p.next() is None


def test_sampler():
    from tidelog.operators.metrics import Sampler

    got = Sampler().sample()
    assert got["cpu_percent"] >= 0 and got["rss_mb"] > 1
