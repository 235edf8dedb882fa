"""Bronze to messages: log payloads decoded batch by batch.

Row changes, which are nearly all of a log, are decoded column-wise with numpy over the batch's one byte buffer: each
step reads the k-th column of every tuple at once. Other messages go through the scalar parser. A payload that cannot
be decoded gives a row with its error and no fields, for the caller's quarantine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.errors import LogError
from tidelog.functions.lsn import bits
from tidelog.operators.carry import carry_forward, dealt, with_bucket
from tidelog.sources import wire

VALUE = "array<struct<kind:string,value:binary>>"
#: Message columns by name; LSNs are the longs of their bits (see functions.lsn).
SCALARS = {
    "xid": "long", "msg_xid": "long", "subxid": "long", "oid": "long", "flags": "int", "final_lsn": "long", "commit_lsn": "long",
    "prepare_lsn": "long", "end_lsn": "long", "message_lsn": "long", "abort_lsn": "long", "ts": "long", "prepare_ts": "long",
    "key_type": "string", "gid": "string", "namespace": "string", "name": "string", "replident": "string", "first_segment": "boolean",
    "prefix": "string", "content": "binary",
}
NESTED = {
    "oids": "array<long>",
    "columns": "array<struct<name:string,type_id:long,type_modifier:int,is_key:boolean>>",
    "old": VALUE,
    "new": VALUE,
}
#: End of no stream block.
NONE = -1
POSITIONS = ("final_lsn", "commit_lsn", "prepare_lsn", "end_lsn", "message_lsn", "abort_lsn")
_ARROW = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}
_VALUE = pa.list_(pa.struct([("kind", pa.string()), ("value", pa.binary())]))
_COLUMN = pa.list_(pa.struct([("name", pa.string()), ("type_id", pa.int64()), ("type_modifier", pa.int32()), ("is_key", pa.bool_())]))
_KIND_NAMES = pa.array(["n", "t", "b", "u"])
_KIND = np.full(256, -1, np.int32)
for _k, _c in enumerate(b"ntbu"):
    _KIND[_c] = _k


#: Stream block marks (starts and stops) up to which they are sent to every worker, as arrays of 16 bytes a mark; beyond
#: that they are carried by a window.
FEW_MARKS = 5_000_000
OUTSIDE = -1


def _marks(bronze: DataFrame) -> DataFrame:
    """(slot, seq, xid) of stream starts, and of stops with xid -1."""
    tag = F.substring("data", 1, 1)
    xid = F.when(tag == F.lit(b"S"), F.conv(F.hex(F.substring("data", 2, 4)), 16, 10).cast("long")).otherwise(F.lit(OUTSIDE).cast("long"))
    return bronze.where(tag.isin([F.lit(b"S"), F.lit(b"E")])).select("slot", "seq", xid.alias("xid"))


def stream_context(bronze: DataFrame) -> DataFrame:
    """Adds stream_xid: the transaction of the stream block a row stands in, null outside; needs slot, seq, data.

    This is the way for any number of blocks: rows are dealt out by bucket and sorted.
    """
    log = dealt(with_bucket(bronze))
    tag, xid = F.substring("data", 1, 1), F.conv(F.hex(F.substring("data", 2, 4)), 16, 10).cast("long")
    at = F.when(tag == F.lit(b"S"), xid).when(tag == F.lit(b"E"), F.lit(NONE).cast("long"))
    log = carry_forward(log, {"_block": at})
    block = F.when(_outside(tag), None).otherwise(F.nullif("_block", F.lit(NONE)))
    return log.withColumn("stream_xid", block).drop("_block")


def _outside(tag: Column) -> Column:
    return tag.isin([F.lit(b"E"), F.lit(b"c"), F.lit(b"A"), F.lit(b"p")])


def by_slot(marks: pa.Table) -> Iterator[tuple[str, pa.Table]]:
    """The marks of each slot by seq."""
    for slot in pc.unique(marks.column("slot")).to_pylist():
        yield slot, marks.filter(pc.equal(marks.column("slot"), slot)).sort_by("seq")


class _Blocks:
    """Stream block marks of each slot in order; tells by binary search in which block a row stands."""

    def __init__(self, marks: pa.Table):
        self.of = {slot: (rows.column("seq").to_numpy(), rows.column("xid").to_numpy()) for slot, rows in by_slot(marks)}

    def xids(self, slots: pa.Array, seqs: pa.Array, tags: np.ndarray) -> np.ndarray:
        """The block's transaction for each row, -1 outside one."""
        out = np.full(len(tags), OUTSIDE, np.int64)
        if not self.of:
            return out
        named, number = slots.dictionary_encode(), seqs.to_numpy(zero_copy_only=False)
        place = named.indices.to_numpy(zero_copy_only=False)
        for k, slot in enumerate(named.dictionary.to_pylist()):
            if slot in self.of:
                at, xid = self.of[slot]
                rows = np.flatnonzero(place == k)
                last = np.searchsorted(at, number[rows], "right") - 1
                out[rows] = np.where(last >= 0, xid[np.maximum(last, 0)], OUTSIDE)
        out[np.isin(tags, np.frombuffer(b"EcAp", np.uint8))] = OUTSIDE
        return out


def decode(bronze: DataFrame, version: int = 1) -> DataFrame:
    """(slot, seq, wal_start, wal_end, server_time, data) -> a row per payload: position, tag, stream_xid, message fields, error.

    Payloads that are null or empty (header-only frames) give no row. Nothing is shuffled where the protocol has no
    stream blocks (version 1) or the log has few of them; then rows stay where they are read.
    """
    rows = with_bucket(bronze.where("data is not null and length(data) > 0"))
    marks = _marks(rows) if version > 1 else None
    found = None
    if marks is not None and marks.count() > FEW_MARKS:
        rows = stream_context(rows)
    else:
        found = rows.sparkSession.sparkContext.broadcast(_Blocks(marks.toArrow() if marks is not None else pa.table({"slot": pa.array([], pa.string())})))
        rows = rows.withColumn("stream_xid", F.lit(None).cast("long"))
    rows = rows.select("slot", "seq", "wal_start", "wal_end", "server_time", "_bucket", "stream_xid", "data")
    schema = "slot string, seq long, wal_start long, wal_end long, server_time long, _bucket long, stream_xid long, tag string, " + ", ".join(
        f"{n} {t}" for n, t in (SCALARS | NESTED | {"error": "string"}).items()
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                names, lead = batch.schema.names[:-1], batch.columns[:-1]
                if found is not None:
                    xids = found.value.xids(lead[0], lead[1], first_bytes(batch.column(7)))
                    lead[6] = pa.array(xids, pa.int64(), mask=xids == OUTSIDE)
                columns = decode_batch(batch.column(7), lead[6].is_valid().to_numpy(zero_copy_only=False), version)
                yield pa.RecordBatch.from_arrays([*lead, *columns.values()], [*names, *columns])

    return rows.mapInArrow(run, schema)


def first_bytes(data: pa.Array) -> np.ndarray:
    """The first byte of each payload; none may be empty or null."""
    wide = pa.types.is_large_binary(data.type)
    bounds = np.frombuffer(data.buffers()[1], np.int64 if wide else np.int32)[data.offset : data.offset + len(data)]
    return np.frombuffer(data.buffers()[2], np.uint8)[bounds]


def decode_batch(data: pa.Array, in_stream: np.ndarray, version: int) -> dict[str, pa.Array]:
    n = len(data)
    data = data.cast(pa.large_binary()) if not pa.types.is_large_binary(data.type) else data
    buffers = data.buffers()
    bounds = np.frombuffer(buffers[1], np.int64)[data.offset : data.offset + n + 1]
    raw = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None and buffers[2].size else np.zeros(1, np.uint8)
    raw = np.concatenate([raw, np.zeros(16, np.uint8)])
    start, end = bounds[:-1], bounds[1:]
    tag = raw[start]
    row = np.flatnonzero(np.isin(tag, np.frombuffer(b"IUD", np.uint8)))
    fast = _Changes(raw, start[row], end[row], tag[row], in_stream[row] & (version >= 2))
    slow = np.ones(n, bool)
    slow[row[fast.fine]] = False
    rest, parsed, errors = np.flatnonzero(slow), [], []
    for k in rest:
        try:
            parsed.append(_checked(wire.parse(data[int(k)].as_py(), version, bool(in_stream[k]))))
            errors.append(None)
        except (LogError, UnicodeDecodeError) as e:
            parsed.append({})
            errors.append(f"{getattr(e, 'kind', 'buffer')}: {e}")
    place = np.empty(n, np.int64)
    good = row[fast.fine]
    place[good], place[rest] = np.arange(len(good)), len(good) + np.arange(len(rest))
    place = pa.array(place)
    out = {"tag": pa.DictionaryArray.from_arrays(pa.array(tag.astype(np.int32)), pa.array([chr(c) if c < 128 else "?" for c in range(256)])).cast(pa.string())}
    for name, kind in SCALARS.items():
        head = fast.column(name, _ARROW[kind])
        tail = pa.array([m.get(name) for m in parsed], _ARROW[kind])
        out[name] = pa.concat_arrays([head, tail]).take(place)
    for name, kind in (("oids", pa.list_(pa.int64())), ("columns", _COLUMN)):
        tail = pa.array([m.get(name) for m in parsed], kind)
        out[name] = pa.concat_arrays([pa.nulls(len(good), kind), tail]).take(place)
    for name in ("old", "new"):
        tail = pa.array([_values(m.get(name)) for m in parsed], _VALUE)
        out[name] = pa.concat_arrays([fast.tuples(name), tail]).take(place)
    out["error"] = pa.concat_arrays([pa.nulls(len(good), pa.string()), pa.array(errors, pa.string())]).take(place)
    return out


def _values(values: list | None) -> list | None:
    return None if values is None else [{"kind": k, "value": v} for k, v in values]


def _checked(m: dict) -> dict:
    for name in POSITIONS:
        if name in m:
            m[name] = bits(m[name])
    if "replident" in m:
        m["replident"] = chr(m["replident"]) if m["replident"] < 128 else "?"
    if "first_segment" in m:
        m["first_segment"] = m["first_segment"] != 0
    if "columns" in m:
        m["columns"] = [{"name": n, "type_id": t, "type_modifier": k, "is_key": bool(f & 1)} for f, n, t, k in m["columns"]]
    return m


class _Changes:
    """Insert, update and delete messages of a batch; fine says which of them were whole and well-formed."""

    def __init__(self, raw: np.ndarray, start: np.ndarray, end: np.ndarray, tag: np.ndarray, prefixed: np.ndarray):
        self.raw, self.end = raw, end
        at = start + 1
        self.fine = at + 4 + 4 * prefixed <= end
        self.msg_xid = np.where(prefixed, self._u32(at), -1)
        at = at + 4 * prefixed
        self.oid = self._u32(at)
        at = at + 4
        mark = self._u8(at)
        has_old = np.where(tag == ord("U"), (mark == ord("K")) | (mark == ord("O")), tag == ord("D"))
        has_old &= at < end
        self.fine &= (at < end) & (has_old | (mark == ord("N")))
        self.key_type = np.where(has_old, mark, 0)
        self.parts = {}
        at = self._tuple("old", at + 1, has_old & self.fine, at)
        has_new = tag != ord("D")
        self.fine &= ~has_new | ((at < end) & (self._u8(at) == ord("N")))
        self._tuple("new", at + 1, has_new & self.fine, at)

    def _u8(self, at: np.ndarray) -> np.ndarray:
        return self.raw[np.minimum(at, len(self.raw) - 1)]

    def _u32(self, at: np.ndarray) -> np.ndarray:
        at = np.minimum(at, len(self.raw) - 4)
        b = [self.raw[at + k].astype(np.int64) for k in range(4)]
        return b[0] << 24 | b[1] << 16 | b[2] << 8 | b[3]

    def _tuple(self, name: str, at: np.ndarray, there: np.ndarray, otherwise: np.ndarray) -> np.ndarray:
        """Reads the tuples that are there; returns where each ends, or otherwise where none is."""
        at = at.copy()
        self.fine &= ~there | (at + 2 <= self.end)
        there = there & self.fine
        # a hostile count can't make room for more columns than there are bytes
        count = np.where(there, self._u32(at) >> 16, 0)
        self.fine &= ~there | (count <= self.end - at - 2)
        there &= self.fine
        count = np.where(there, count, 0)
        at += 2
        first = np.cumsum(count) - count
        total = int(count.sum())
        kinds, starts, sizes = np.zeros(total, np.int32), np.zeros(total, np.int64), np.zeros(total, np.int64)
        live = np.flatnonzero(there)
        for k in range(int(count.max(initial=0))):
            live = live[count[live] > k]
            p = at[live]
            kind = np.where(p < self.end[live], _KIND[self._u8(p)], -1)
            sized = (kind == 1) | (kind == 2)
            size = np.where(sized, self._u32(p + 1), 0)
            stop = p + 1 + np.where(sized, 4 + size, 0)
            ok = (kind >= 0) & (stop <= self.end[live])
            self.fine[live[~ok]] = False
            live, kind, size, stop = live[ok], kind[ok], size[ok], stop[ok]
            slot = first[live] + k
            kinds[slot], sizes[slot], starts[slot] = kind, size, stop - size
            at[live] = stop
        self.parts[name] = (there, count, first, kinds, starts, sizes)
        return np.where(there, at, otherwise)

    def column(self, name: str, kind: pa.DataType) -> pa.Array:
        if name == "oid":
            return pa.array(self.oid[self.fine])
        if name == "msg_xid":
            x = self.msg_xid[self.fine]
            return pa.array(x, pa.int64(), mask=x < 0)
        if name == "key_type":
            x = self.key_type[self.fine]
            names = pa.array([chr(c) if 0 < c < 128 else None for c in range(256)], pa.string())
            return names.take(pa.array(x.astype(np.int64)))
        return pa.nulls(int(self.fine.sum()), kind)

    def tuples(self, name: str) -> pa.Array:
        there, count, first, kinds, starts, sizes = self.parts[name]
        keep = np.flatnonzero(self.fine)
        n = count[keep]
        offsets = np.concatenate([[0], np.cumsum(n)])
        at = np.repeat(first[keep] - offsets[:-1], n) + np.arange(offsets[-1])
        kind, size, start = kinds[at], sizes[at], starts[at]
        ends = np.concatenate([[0], np.cumsum(size)])
        body = self.raw[np.repeat(start - ends[:-1], size) + np.arange(ends[-1])]
        none = (kind == 0) | (kind == 3)
        valid = pa.py_buffer(np.packbits(~none, bitorder="little").tobytes())
        values = pa.Array.from_buffers(pa.binary(), len(kind), [valid, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(body.tobytes())])
        struct = pa.StructArray.from_arrays([_KIND_NAMES.take(pa.array(kind)), values], ["kind", "value"])
        valid = pa.py_buffer(np.packbits(there[keep], bitorder="little").tobytes())
        return pa.Array.from_buffers(_VALUE, len(keep), [valid, pa.py_buffer(offsets.astype(np.int32).tobytes())], children=[struct])
