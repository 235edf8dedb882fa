"""Captures that overlap, positions that are safe, and a table that follows a stream."""

from __future__ import annotations

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.test_core import BEGIN, COMMIT, FULL, PUT, REL, log
from tidelog.operators import carry, frontier, sessions, snapshot, state, txn
from tidelog.operators import events as E
from tidelog.operators.decode import decode
from tidelog.sources.scratch import materialise
from tidelog.streaming.upsert import VALUES, UpsertSink

CAPTURE = "slot string, session int, seq long, wal_start long, wal_end long, server_time long, data binary"


def plain_merge(rows):
    """Frames of a slot in order of (session, seq), without those that an earlier session has; those without a position share the fate of the next one."""
    out, seen = [], {}
    for session in sorted({r[1] for r in rows}):
        own, count, fates = sorted((r for r in rows if r[1] == session), key=lambda r: r[2]), {}, []
        for r in own:
            key = (r[3], r[6])
            count[key] = count.get(key, 0) + (r[3] != 0)
            fates.append(None if r[3] == 0 else count[key] > seen.get(key, 0))
        for k in reversed(range(len(own))):
            if fates[k] is None:
                fates[k] = fates[k + 1] if k + 1 < len(own) else True
        out += [(r[3], r[6]) for r, new in zip(own, fates, strict=True) if new]
        for key, n in count.items():
            seen[key] = max(n, seen.get(key, 0))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_overlapping_sessions_are_one_log(spark, seed, monkeypatch):
    """Equal frames at one position, transactions whose positions go back, frames without a position, cuts anywhere."""
    rng = random.Random(seed)
    if seed == 2:
        monkeypatch.setattr(sessions, "FEW", -1)
        monkeypatch.setattr(carry, "STRETCH", 2)
    rows = []
    for slot in ("a", "b"):
        whole = []
        for k in range(200):
            at = 1000 + 10 * k - rng.choice([0, 0, 35])
            whole += [(at, bytes([k % 251, n // 2])) for n in range(rng.choice([1, 1, 3]))]
            whole += [(0, b"R")] if rng.random() < 0.2 else []
        cuts = [(1, 0, rng.randint(60, 160)), (2, rng.randint(10, 60), rng.randint(170, 220)), (3, rng.randint(100, 170), len(whole))]
        for session, low, high in cuts[: 3 if slot == "a" else 1]:
            start = rng.choice([0, 10**6])
            rows += [(slot, session, start + 9000 * k, at, at and at + 1, k, data) for k, (at, data) in enumerate(whole[low:high])]
    frame = spark.createDataFrame(rng.sample(rows, len(rows)), CAPTURE)
    got = sessions.merged(frame).orderBy("slot", "seq").collect()
    for slot in ("a", "b"):
        mine = [r for r in got if r.slot == slot]
        assert [(r.wal_start, bytes(r.data)) for r in mine] == plain_merge([r for r in rows if r[0] == slot])
        assert [r.seq for r in mine] == list(range(1, len(mine) + 1))
    assert sessions.gaps(frame).count() == 0


def test_gaps_and_odd_captures(spark):
    rows = [("s", 1, 1, 100, 101, 0, b"a"), ("s", 2, 1, 0, 0, 0, b"R"), ("s", 2, 2, 150, 151, 0, b"b"), ("s", 3, 5, 151, 160, 0, None), (None, 1, 1, 7, 8, 0, b""), ("s", 4, 1, 0, 0, 0, b"R")]
    frame = spark.createDataFrame(rows, CAPTURE)
    assert [tuple(r) for r in sessions.gaps(frame).collect()] == [("s", 2, 101, 150)]
    assert sessions.merged(frame).count() == 6 and sessions.merged(frame.limit(0)).count() == 0


def test_frontier_is_the_unbroken_run(spark):
    rng = random.Random(3)
    commits = [("s", 50 * k, 50 * k + 1) for k in range(600)]
    applied = [("s", c[1], rng.randint(0, 90)) for c in commits if c[1] < 20_000 or rng.random() < 0.9] + [("s", 0, 99), ("other", 0, 1)]
    first = {}
    for _, seq, step in applied[:-1]:
        first[seq] = min(step, first.get(seq, 10**9))
    want, top, high = {}, 0, -1
    for _, seq, end in commits:
        if seq not in first:
            break
        top = max(top, first[seq])
        want[top] = end
    a, b = spark.createDataFrame(commits, "slot string, seq long, end_lsn long"), spark.createDataFrame(applied, "slot string, seq long, step long")
    assert {r.step: r.safe_lsn for r in frontier.frontier(a, b).collect()} == want
    runs = sorted((r.first_seq, r.last_seq, r.n) for r in frontier.intervals(a, b).collect())
    assert runs[0][0] == 0 and sum(r[2] for r in runs) == len(first) and all(x[1] < y[0] for x, y in zip(runs, runs[1:], strict=False))
    live, done = frontier.Frontier(), 0
    for _, _, end in commits:
        live.expect(end)
    order = sorted((step, seq) for seq, step in first.items())
    for k, (step, seq) in enumerate(order):
        done = live.apply(seq + 1)
        if k + 1 == len(order) or order[k + 1][0] != step:
            assert done == max([e for s, e in want.items() if s <= step], default=0)


def committed(spark, body, seed, states=None):
    """Changes of random transactions on a keyed table, a table of full rows, with moves, unchanged values and truncates.

    states, a list, gets the keyed table after each transaction.
    """
    rng, messages, xid = random.Random(seed), [(REL, False), (FULL, False)], 0
    put = lambda oid, tag, k, v, **more: {"tag": tag, "oid": oid, "new": [("t", str(k).encode()), ("u", None) if v is None else ("t", v.encode())]} | more
    pair = lambda k, v: [("t", str(k).encode()), ("t", v.encode())]
    keyed, full = {}, []
    for _ in range(body):
        xid += 1
        messages.append((BEGIN(xid), False))
        for _ in range(rng.randint(1, 6)):
            k, v = rng.randint(0, 15), f"v{rng.randint(0, 99)}"
            move = rng.randint(20, 30)
            if rng.random() < 0.03:
                messages.append(({"tag": "T", "flags": 0, "oids": [1, 2]}, False))
                keyed, full = {}, []
            elif rng.random() < 0.35:
                if full and rng.random() < 0.5:
                    old = full.pop(rng.randrange(len(full)))
                    if rng.random() < 0.5:
                        messages.append(({"tag": "D", "oid": 2, "key_type": "O", "old": pair(*old)}, False))
                    else:
                        full.append((k, old[1]))
                        messages.append((put(2, "U", k, None, key_type="O", old=pair(*old)), False))
                else:
                    full.append((k, v))
                    messages.append((put(2, "I", k, v), False))
            elif k not in keyed:
                keyed[k] = v
                messages.append((PUT(k, v), False))
            elif rng.random() < 0.3:
                del keyed[k]
                messages.append(({"tag": "D", "oid": 1, "key_type": "K", "old": [("t", str(k).encode()), ("n", None)]}, False))
            elif rng.random() < 0.3 and move not in keyed:
                keyed[move] = v
                del keyed[k]
                messages.append((put(1, "U", move, v, key_type="K", old=[("t", str(k).encode()), ("n", None)]), False))
            else:
                keyed[k] = keyed[k] if rng.random() < 0.5 else v
                messages.append((put(1, "U", k, None if keyed[k] != v else v), False))
        messages.append((COMMIT, False))
        if states is not None:
            states.append(dict(keyed))
    decoded = materialise(decode(log(spark, messages), 4), "m")
    rows = materialise(txn.committed(materialise(E.events(decoded, txn.assign(decoded)), "e")), "c")
    return rows, sorted([("t", k, v) for k, v in keyed.items()] + [("f", k, v) for k, v in full])


def held(frame):
    text = lambda r, n: next((bytes(c["value"]).decode() for c in r.row if c["name"] == n), None)
    return sorted((r.table, int(text(r, "id")), text(r, "v")) for r in frame.collect())


def test_upserts_equal_the_net_state(spark, tmp_path):
    """After every batch the sink holds what the changes so far come to; a batch twice, and one that was cut off, do nothing."""
    changes, want = committed(spark, 60, 5)
    ends = sorted(r[0] for r in changes.select("commit_seq").distinct().collect())
    sink, low = UpsertSink(spark, str(tmp_path / "sink"), buckets=5), -1
    for n, high in enumerate([ends[9], ends[30], ends[31], ends[-1]]):
        part = changes.where((F.col("commit_seq") > low) & (F.col("commit_seq") <= high))
        if n == 2:
            (tmp_path / "sink" / "manifest" / "batch=2").mkdir()
            part.select("seq").write.parquet(str(tmp_path / "sink" / "data" / "batch=2" / "bucket=0"))
            assert held(sink.table()) == before
        sink(part, n)
        sink(part, n)
        before = held(sink.table())
        assert before == held(state.net_state(changes.where(F.col("commit_seq") <= high)))
        low = high
    assert before == want and sink.versions() == [0, 1, 2, 3]
    with pytest.raises(ValueError, match="older"):
        sink(changes.limit(0), -1)
    sink.vacuum()
    assert sink.versions() == [3] and held(sink.table()) == want


def test_upserts_touch_only_their_buckets(spark, tmp_path):
    """A batch of one key rewrites one bucket, the others stay files of the batch before."""
    changes, _ = committed(spark, 1, 1)
    rows = [(REL, False), (BEGIN(1), False), *[(PUT(k, "a"), False) for k in range(200)], (COMMIT, False), (BEGIN(2), False), (PUT(7, "b"), False), (COMMIT, False)]
    decoded = materialise(decode(log(spark, rows), 4), "m")
    changes = materialise(txn.committed(materialise(E.events(decoded, txn.assign(decoded)), "e")), "c")
    first = changes.agg(F.min("commit_seq")).first()[0]
    sink = UpsertSink(spark, str(tmp_path / "sink"), buckets=8)
    sink(changes.where(F.col("commit_seq") == first), 0)
    sink(changes.where(F.col("commit_seq") != first), 1)
    assert len(list((tmp_path / "sink" / "data" / "batch=0").glob("bucket=*"))) == 8 and len(list((tmp_path / "sink" / "data" / "batch=1").glob("bucket=*"))) == 1
    assert ("t", 7, "b") in held(sink.table()) and sink.table().count() == 200 and ("t", 7, "a") in held(sink.table(0))


@pytest.mark.parametrize("seed", [11, 12])
def test_chunks_read_at_any_time_give_the_state(spark, seed):
    """Every row of a chunk is read at a time of its own between the marks; the log is there from the lowest mark on."""
    rng, states = random.Random(seed), []
    changes, want = committed(spark, 50, seed, states)
    ends = sorted(r[0] for r in changes.select("commit_seq").distinct().collect())
    assert len(ends) == len(states)
    marks, rows = [], []
    for chunk, (a, b) in enumerate([(0, 6), (6, 13), (13, 31)]):
        low = rng.randint(5, 20)
        high = low + rng.randint(0, 20)
        marks.append(("s", "public", "t", chunk, ends[low], ends[high]))
        for k in range(a, b):
            at = states[rng.randint(low, high)]
            if k in at:
                rows.append(("s", "public", "t", chunk, ["id"], [("id", "t", str(k).encode()), ("v", "t", at[k].encode())]))
    chunks = spark.createDataFrame(rows, f"slot string, schema string, table string, chunk int, primary_key array<string>, row {VALUES}")
    table = spark.createDataFrame(marks, "slot string, schema string, table string, chunk int, low long, high long")
    later = changes.where(F.col("commit_seq") > min(m[4] for m in marks)).where("table = 't' or tag = 'T'")
    got = held(snapshot.chunked_state(chunks, table, later))
    assert got == [r for r in want if r[0] == "t"]
    assert held(snapshot.chunked_state(chunks.limit(0), table, later.limit(0))) == []
    with pytest.raises(PySparkException, match="without a key"):
        snapshot.chunked_state(chunks.withColumn("primary_key", F.array().cast("array<string>")), table, later).collect()


def test_hot_keys_in_segments(spark, monkeypatch):
    """History and filled values of keys whose changes are dealt out in segments and stretches are those of one piece."""
    changes, _ = committed(spark, 80, 7)
    made = lambda: (sorted(map(str, state.history(changes).collect())), sorted(map(str, state.toast_fill(changes, ["v"]).select("seq", "step", "v").collect())))
    whole = made()
    monkeypatch.setattr(state, "HOT", 3)
    monkeypatch.setattr(state, "SEGMENT", 40)
    monkeypatch.setattr(carry, "STRETCH", 2)
    assert made() == whole and len(whole[0]) > 100
    monkeypatch.setattr(carry, "FEW_HEADS", -1)
    assert made() == whole
