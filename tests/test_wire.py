"""Messages as bytes: golden bytes, round trips, hostile input; and the column-wise decoder against the scalar one."""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidelog.errors import LogError
from tidelog.functions.lsn import position
from tidelog.operators.decode import POSITIONS, decode_batch
from tidelog.sources import wire

u8, u32, u64, i64 = st.integers(0, 255), st.integers(0, 2**32 - 1), st.integers(0, 2**64 - 1), st.integers(-(2**63), 2**63 - 1)
text = st.text(st.characters(exclude_characters="\0", exclude_categories=["Cs"]), max_size=12)
value = st.one_of(st.sampled_from([("n", None), ("u", None)]), st.tuples(st.sampled_from("tb"), st.binary(max_size=20)))
by_code = {
    "B": u8, "I": u32, "Q": u64, "q": i64, "z": text, "N": st.lists(value, max_size=6), "key": st.lists(value, max_size=6),
    "columns": st.lists(st.tuples(u8, text, u32, st.integers(-(2**31), 2**31 - 1)), max_size=5), "oids": st.lists(u32, max_size=5), "bytes": st.binary(max_size=30),
}


@st.composite
def message(draw):
    tag = draw(st.sampled_from(sorted(wire.FIELDS)))
    out = {"tag": tag}
    for name, code in wire.FIELDS[tag]:
        if code == "old":
            if draw(st.booleans()):
                out |= {name: draw(by_code["key"]), "key_type": draw(st.sampled_from("KO"))}
        elif code == "abort":
            if draw(st.booleans()):
                out |= {"abort_lsn": draw(u64), "ts": draw(i64)}
        else:
            out[name] = draw(by_code[code])
            if code == "key":
                out["key_type"] = draw(st.sampled_from("KO"))
            if code == "oids":
                out["flags"] = draw(u8)
    return out


@given(message(), st.booleans(), u32)
@settings(max_examples=400, deadline=None)
def test_round_trip(m, in_stream, xid):
    if in_stream and m["tag"] in wire.PREFIXED:
        m["msg_xid"] = xid
    data = wire.encode(m, 4, in_stream)
    assert wire.parse(data, 4, in_stream) == m and wire.encode(wire.parse(data, 4, in_stream), 4, in_stream) == data


@given(st.binary(max_size=60), st.booleans())
@settings(max_examples=400, deadline=None)
def test_any_bytes(data, in_stream):
    try:
        wire.parse(data, 4, in_stream)
    except LogError as e:
        assert e.kind in ("protocol", "buffer")


def test_golden_bytes():
    assert wire.encode({"tag": "B", "final_lsn": 1, "ts": -2, "xid": 3}) == b"B" + struct.pack(">QqI", 1, -2, 3)
    row = b"I\x00\x00\x40\x10N\x00\x04t\x00\x00\x00\x02hinub\x00\x00\x00\x01\xff"
    assert wire.parse(row) == {"tag": "I", "oid": 16400, "new": [("t", b"hi"), ("n", None), ("u", None), ("b", b"\xff")]}
    assert wire.parse(b"A" + struct.pack(">II", 5, 6), 4) == {"tag": "A", "xid": 5, "subxid": 6}
    assert "abort_lsn" not in wire.parse(b"A" + struct.pack(">IIQq", 5, 6, 7, 8), 3)
    assert wire.parse(b"I\x00\x00\x00\x09" + row[1:], 2, True)["msg_xid"] == 9 and "msg_xid" not in wire.parse(row, 1, True)
    for bad in (b"", b"?", b"I\0\0", b"I\0\0\0\1X\0\0", b"I\0\0\0\1N\0\1z", b"Y\0\0\0\1no end", b"O" + bytes(8) + b"\xff\0"):
        with pytest.raises(LogError):
            wire.parse(bad)


def test_frames():
    assert wire.split_frames(b"d\0\0\0\6abX\0\0\0\4Z\0\0\0\x08a") == ([("d", b"ab"), ("X", b"")], b"Z\0\0\0\x08a")
    for n in (b"\0\0\0\3", b"\xff\0\0\0"):
        with pytest.raises(LogError):
            wire.split_frames(b"d" + n)
    assert wire.keepalive(b"k" + struct.pack(">QqB", 9, -1, 1)) == (9, -1, True)
    assert wire.standby_status(3, 2, 1, 0, True) == b"r" + struct.pack(">QQQqB", 3, 2, 1, 0, 1)


@given(st.lists(st.one_of(message().map(lambda m: (m, None)), st.binary(min_size=1, max_size=40).map(lambda b: (None, b))), min_size=1, max_size=30), st.data())
@settings(max_examples=150, deadline=None)
def test_decoders_agree(rows, data):
    in_stream = np.array([data.draw(st.booleans()) for _ in rows])
    packed = []
    for (m, raw), inside in zip(rows, in_stream, strict=True):
        packed.append(raw if m is None else wire.encode(m | {"msg_xid": 7}, 4, bool(inside)))
        if m is not None and data.draw(st.integers(0, 9)) == 0:
            packed[-1] = packed[-1][: data.draw(st.integers(1, len(packed[-1])))]
    table = pa.table(decode_batch(pa.array(packed, pa.binary()), in_stream, 4)).to_pylist()
    for got, body, inside in zip(table, packed, in_stream, strict=True):
        try:
            want = wire.parse(body, 4, bool(inside))
        except (LogError, UnicodeDecodeError):
            assert got["error"]
            continue
        assert got["error"] is None and got["tag"] == want["tag"]
        for name in ("xid", "oid", "msg_xid", "key_type", "gid", "ts", "content", "oids"):
            assert got[name] == want.get(name)
        for name in POSITIONS:
            assert (got[name] is None and name not in want) or position(got[name]) == want[name]
        for name in ("old", "new"):
            assert got[name] == (None if want.get(name) is None else [{"kind": k, "value": v} for k, v in want[name]])
