"""Messages out of byte streams, wherever chunks were cut."""

from __future__ import annotations

import random
import struct

import pytest

from tidelog.operators import chunks, framing
from tidelog.sources import wire


def message(tag: bytes, body: bytes) -> bytes:
    return tag + struct.pack(">I", len(body) + 4) + body


def captured(spark, streams, rng, longest):
    """Each slot's stream in chunks of random lengths, empty and null ones among them."""
    rows = []
    for slot, data in streams.items():
        at, seq = 0, 0
        while at < len(data):
            n = rng.choice([0, 1, 2, 3, rng.randint(0, longest)])
            rows.append((slot, seq, data[at : at + n] if n or rng.random() < 0.5 else None))
            at, seq = at + n, seq + rng.randint(1, 5000)
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "slot string, seq long, bytes binary")


def split(spark, frame, **kw):
    return sorted((r.slot, r.at, r.tag, None if r.body is None else bytes(r.body), r.error) for r in chunks.split_log(frame, **kw).collect())


@pytest.mark.parametrize("seed", range(4))
def test_any_cut_gives_the_whole_log(spark, seed):
    """Bodies look like messages themselves, so that blocks do not tell where they begin; messages run over many blocks."""
    rng = random.Random(seed)
    streams, want = {}, []
    for slot in ("a", "b", ""):
        data = b""
        for _ in range(rng.randint(1, 60)):
            body = rng.choice([b"", b"d\0\0\0\x05", bytes(rng.choices(b"\0\0\0\x04\x06da1 ", k=rng.randint(0, 40))), message(b"d", b"x" * rng.randint(0, 9)) * rng.randint(0, 30), b"w" * rng.randint(0, 300)])
            tag = rng.choice([b"d", b"Z", b"1"])
            want.append((slot, len(data), tag.decode(), body, None))
            data += message(tag, body)
        streams[slot] = data
    for size, fan in ((16, 2), (64, 3), (chunks.BLOCK, chunks.FAN)):
        assert split(spark, captured(spark, streams, rng, 50), size=size, fan=fan) == sorted(want)


def test_what_cannot_be_read_ends_its_slot(spark):
    good = message(b"d", b"one") + message(b"d", b"two")
    ends = {"cut": b"d\0\0\0\x09abc", "short": b"d\0\0", "length": b"d\0\0\0\x03" + good, "letter": b"\xff\0\0\0\x04" + good, "long": b"d\x7f\xff\xff\xff" + good, "whole": b""}
    streams = {k: good + v for k, v in ends.items()}
    got = split(spark, captured(spark, streams, random.Random(1), 9), size=8, fan=2)
    for slot in ends:
        own = [r[1:] for r in got if r[0] == slot]
        assert own[:2] == [(0, "d", b"one", None), (8, "d", b"two", None)]
        assert [r[-1] for r in own[2:]] == {"cut": ["message cut off after 8 bytes"], "short": ["message cut off after 3 bytes"], "length": ["message length 3"], "letter": ["unknown message 255"], "long": ["message length 2147483647"], "whole": []}[slot]
    assert split(spark, captured(spark, {}, random.Random(1), 9)) == []


def test_frames_of_a_cut_log(spark):
    """Split messages of a copy are frames, and their order is that of their places."""
    frames = [wire.frame(bytes([k]) * k, k, k + 1, 5) for k in range(40)]
    data = b"".join(message(b"d", f) for f in frames)
    parts = chunks.split_log(captured(spark, {"s": data}, random.Random(2), 70), size=32, fan=4)
    rows = framing.unframe(parts.where("tag = 'd'").selectExpr("slot", "at as seq", "body as frame")).orderBy("seq").collect()
    assert [(r.wal_start, bytes(r.data)) for r in rows] == [(k, bytes([k]) * k) for k in range(40)]
