"""Logical-replication messages as bytes, both ways, one message at a time.

A message is a dict with its tag and the fields of its layout. Integers are big-endian. Tags in PREFIXED carry the
transaction id of the change in front when they stand inside a stream block, from protocol version 2 on.
"""

from __future__ import annotations

import struct

from tidelog.errors import LogError

#: Fields of each tag in wire order; z is a NUL-terminated string, the others are struct codes. Fixed values.
LAYOUT = {
    "B": "final_lsn:Q ts:q xid:I",
    "C": "flags:B commit_lsn:Q end_lsn:Q ts:q",
    "R": "oid:I namespace:z name:z replident:B columns:columns",
    "I": "oid:I new:N",
    "U": "oid:I old:old new:N",
    "D": "oid:I old:key",
    "T": "oids:oids",
    "Y": "oid:I namespace:z name:z",
    "O": "message_lsn:Q name:z",
    "M": "flags:B message_lsn:Q prefix:z content:bytes",
    "S": "xid:I first_segment:B",
    "E": "",
    "c": "xid:I flags:B commit_lsn:Q end_lsn:Q ts:q",
    "A": "xid:I subxid:I abort:abort",
    "b": "prepare_lsn:Q end_lsn:Q ts:q xid:I gid:z",
    "P": "flags:B prepare_lsn:Q end_lsn:Q ts:q xid:I gid:z",
    "K": "flags:B commit_lsn:Q end_lsn:Q ts:q xid:I gid:z",
    "r": "flags:B prepare_lsn:Q end_lsn:Q prepare_ts:q ts:q xid:I gid:z",
    "p": "flags:B prepare_lsn:Q end_lsn:Q ts:q xid:I gid:z",
}
FIELDS = {tag: [tuple(f.split(":")) for f in spec.split()] for tag, spec in LAYOUT.items()}
PREFIXED = frozenset("RIUDTYM")
EPOCH_MICROS = 946_684_800_000_000


class Reader:
    """Bounds-checked cursor over bytes."""

    def __init__(self, data: bytes):
        self.data, self.at = memoryview(data), 0

    def left(self) -> int:
        return len(self.data) - self.at

    def take(self, n: int) -> bytes:
        if n < 0 or n > self.left():
            raise LogError("buffer", f"{n} bytes wanted, {self.left()} left")
        self.at += n
        return bytes(self.data[self.at - n : self.at])

    def number(self, code: str) -> int:
        return struct.unpack(f">{code}", self.take(struct.calcsize(f">{code}")))[0]

    def text(self) -> str:
        rest = bytes(self.data[self.at :])
        end = rest.find(0)
        if end < 0:
            raise LogError("buffer", "string without end")
        self.at += end + 1
        try:
            return rest[:end].decode()
        except UnicodeDecodeError as e:
            raise LogError("buffer", "string is not UTF-8") from e

    def peek(self) -> str:
        return chr(self.data[self.at]) if self.left() else ""

    def tuple(self) -> list[tuple[str, bytes | None]]:
        out: list[tuple[str, bytes | None]] = []
        for _ in range(self.number("H")):
            kind = chr(self.number("B"))
            if kind in "tb":
                out.append((kind, self.take(self.number("I"))))
            elif kind in "nu":
                out.append((kind, None))
            else:
                raise LogError("protocol", f"unknown column kind {kind!r}")
        return out


def _read(r: Reader, name: str, code: str, version: int, out: dict) -> None:
    if code == "z":
        out[name] = r.text()
    elif code == "columns":
        out[name] = [(r.number("B"), r.text(), r.number("I"), r.number("i")) for _ in range(r.number("H"))]
    elif code == "N":
        if (mark := chr(r.number("B"))) != "N":
            raise LogError("protocol", f"new tuple wanted, {mark!r} found")
        out[name] = r.tuple()
    elif code == "old":
        if r.peek() in ("K", "O"):
            out["key_type"] = chr(r.number("B"))
            out[name] = r.tuple()
    elif code == "key":
        out["key_type"] = chr(r.number("B"))
        out[name] = r.tuple()
    elif code == "oids":
        n, out["flags"] = r.number("I"), r.number("B")
        out[name] = [r.number("I") for _ in range(n)]
    elif code == "bytes":
        out[name] = r.take(r.number("I"))
    elif code == "abort":
        if version >= 4 and r.left() >= 16:
            out["abort_lsn"], out["ts"] = r.number("Q"), r.number("q")
    else:
        out[name] = r.number(code)


def parse(data: bytes, version: int = 1, in_stream: bool = False) -> dict:
    """The message in data; what follows its last field is ignored."""
    if not data:
        raise LogError("protocol", "empty message")
    r = Reader(data)
    tag = chr(r.number("B"))
    if tag not in FIELDS:
        raise LogError("protocol", f"unknown message {tag!r}")
    out: dict = {"tag": tag}
    if tag in PREFIXED and in_stream and version >= 2:
        out["msg_xid"] = r.number("I")
    for name, code in FIELDS[tag]:
        _read(r, name, code, version, out)
    return out


def _string(text: str) -> bytes:
    raw = text.encode()
    if b"\0" in raw:
        raise LogError("protocol", "NUL inside a string")
    return raw + b"\0"


def _tuple(values: list) -> bytes:
    parts = [struct.pack(">H", len(values))]
    for kind, value in values:
        parts.append(kind.encode() + (struct.pack(">I", len(value)) + bytes(value) if kind in "tb" else b""))
    return b"".join(parts)


def _write(m: dict, name: str, code: str, version: int) -> bytes:
    if code == "z":
        return _string(m[name])
    if code == "columns":
        each = [struct.pack(">B", f) + _string(n) + struct.pack(">Ii", t, k) for f, n, t, k in m[name]]
        return struct.pack(">H", len(each)) + b"".join(each)
    if code == "N":
        return b"N" + _tuple(m[name])
    if code == "old":
        return (m.get("key_type") or "K").encode() + _tuple(m[name]) if m.get(name) is not None else b""
    if code == "key":
        return (m.get("key_type") or "K").encode() + _tuple(m[name])
    if code == "oids":
        return struct.pack(">IB", len(m[name]), m.get("flags") or 0) + b"".join(struct.pack(">I", o) for o in m[name])
    if code == "bytes":
        return struct.pack(">I", len(m[name])) + bytes(m[name])
    if code == "abort":
        there = version >= 4 and m.get("abort_lsn") is not None and m.get("ts") is not None
        return struct.pack(">Qq", m["abort_lsn"], m["ts"]) if there else b""
    return struct.pack(f">{code}", m[name])


def encode(message: dict, version: int = 1, in_stream: bool = False) -> bytes:
    """The bytes of a message; parse(encode(m)) gives m back."""
    tag = message["tag"]
    lead = struct.pack(">I", message["msg_xid"]) if tag in PREFIXED and in_stream and version >= 2 else b""
    return tag.encode() + lead + b"".join(_write(message, name, code, version) for name, code in FIELDS[tag])


def frame(payload: bytes, wal_start: int, wal_end: int, sent: int) -> bytes:
    """A data frame: `w`, positions, server time, payload."""
    return b"w" + struct.pack(">QQq", wal_start, wal_end, sent) + payload


def keepalive(data: bytes) -> tuple[int, int, bool]:
    """(wal_end, server time, reply wanted) of a keepalive frame."""
    r = Reader(data)
    if (kind := chr(r.number("B"))) != "k":
        raise LogError("protocol", f"keepalive wanted, {kind!r} found")
    return r.number("Q"), r.number("q"), bool(r.number("B"))


def standby_status(received: int, flushed: int, applied: int, sent: int, reply: bool = False) -> bytes:
    return b"r" + struct.pack(">QQQqB", received, flushed, applied, sent, reply)


def split_frames(data: bytes, most: int = 128 << 20) -> tuple[list[tuple[str, bytes]], bytes]:
    """(tag, body) of the whole messages a byte log begins with, and the partial rest; lengths count themselves."""
    out, at = [], 0
    while len(data) - at >= 5:
        tag, n = chr(data[at]), struct.unpack_from(">I", data, at + 1)[0]
        if n < 4 or n > most:
            raise LogError("protocol", f"message length {n}")
        if len(data) - at < n + 1:
            break
        out.append((tag, bytes(data[at + 5 : at + 1 + n])))
        at += n + 1
    return out, bytes(data[at:])


def hot_standby_feedback(sent: int, xmin: int, xmin_epoch: int, catalog_xmin: int, catalog_epoch: int) -> bytes:
    return b"h" + struct.pack(">qIIII", sent, xmin, xmin_epoch, catalog_xmin, catalog_epoch)


def copy_done() -> bytes:
    return b"c" + struct.pack(">I", 4)


def result_set(messages: list[tuple[str, bytes]]) -> list[dict[str, bytes | None]]:
    """Rows of a query from the server's messages (tag, body) up to ready-for-query: T names columns, D is a row, C ends a command.

    Of several commands the last one with rows counts. NULL is None and differs from an empty value. An error message
    (E) raises; notices (N), status (S) and copy starts (W, H) are passed over.
    """
    rows: list[dict[str, bytes | None]] = []
    names: list[str] = []
    for tag, body in messages:
        r = Reader(body)
        if tag == "T":
            rows, names = [], []
            for _ in range(r.number("H")):
                names.append(r.text())
                r.take(18)
        elif tag == "D":
            values = []
            for _ in range(r.number("H")):
                n = r.number("i")
                values.append(None if n < 0 else r.take(n))
            rows.append(dict(zip(names, values, strict=True)))
        elif tag == "E":
            raise LogError("backend", error_text(body))
        elif tag == "Z":
            break
    return rows


def error_text(body: bytes) -> str:
    """Severity, message and code of an error or notice message."""
    r, parts = Reader(body), {}
    while r.left() and (field := chr(r.number("B"))) != "\0":
        parts[field] = r.text()
    return f"{parts.get('S', 'ERROR')}: {parts.get('M', '')} ({parts.get('C', '')})"
