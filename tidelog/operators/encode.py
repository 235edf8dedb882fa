"""Messages to bronze: the inverse of decode, so that every decoder result can be checked.

Row changes are written by expressions and never leave the JVM; other messages, and changes that are not well-formed, go
through the scalar writer, which raises where a message can't be written. encode_batch writes any messages of an Arrow
batch, changes column-wise over its buffers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions.lsn import position
from tidelog.operators.decode import NESTED, POSITIONS, SCALARS
from tidelog.sources import wire

CHANGES = ("I", "U", "D")


def encode(messages: DataFrame, version: int = 1) -> DataFrame:
    """Adds data to rows of decode's message columns; columns that are missing count as null.

    Messages inside a stream block (stream_xid not null) carry msg_xid in front where their tag does.
    """
    have = set(messages.columns)
    wanted = {"stream_xid": "long", "tag": "string"} | SCALARS | NESTED
    parts = [F.col(n) if n in have else F.lit(None).cast(t).alias(n) for n, t in wanted.items()]
    others = [c for c in messages.columns if c not in wanted and c != "error"]
    rows = messages.select(*others, *parts)
    schema = T.StructType([*[f for f in rows.schema if f.name in others], T.StructField("data", T.BinaryType())])
    fields = list(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), encode_batch(batch.select(fields), version)], [*others, "data"])

    plain = F.coalesce(_is_plain(version), F.lit(False))
    return rows.where(plain).select(*others, _change(version).alias("data")).unionByName(rows.where(~plain).mapInArrow(run, schema))


def _is_plain(version: int) -> Column:
    """_plain() as an expression; null counts as no."""
    fits = lambda c: F.col(c).between(0, (1 << 32) - 1)
    among = lambda v, *kinds: v["kind"].isin(*kinds)
    bad = lambda v: ~F.coalesce(among(v, "n", "u") | (among(v, "t", "b") & v["value"].isNotNull()), F.lit(False))
    good = lambda c: F.col(c).isNull() | ((F.size(c) < 1 << 16) & ~F.exists(c, bad))
    keyed = (F.col("tag") == "I") | F.col("key_type").isNull() | F.col("key_type").isin("K", "O")
    there = F.when(F.col("tag") == "D", F.col("old").isNotNull()).otherwise(F.col("new").isNotNull())
    led = F.col("stream_xid").isNull() | fits("msg_xid") if version >= 2 else F.lit(True)
    return F.col("tag").isin(*CHANGES) & there & keyed & fits("oid") & led & good("old") & good("new")


def _change(version: int) -> Column:
    """The bytes of a plain change, put together as hex digits."""
    number = lambda c, digits: F.lpad(F.hex(c), digits, "0")
    cell = lambda v: F.when(v["kind"].isin("t", "b"), F.concat(F.hex(v["kind"]), number(F.length(v["value"]), 8), F.hex(v["value"]))).otherwise(F.hex(v["kind"]))
    row = lambda c: F.concat(number(F.size(c), 4), F.array_join(F.transform(c, cell), ""))
    when = lambda there, c: F.when(there, c).otherwise("")
    lead = when(F.col("stream_xid").isNotNull(), number(F.col("msg_xid"), 8)) if version >= 2 else F.lit("")
    old = when((F.col("tag") != "I") & F.col("old").isNotNull(), F.concat(F.hex(F.coalesce("key_type", F.lit("K"))), row("old")))
    new = when(F.col("tag") != "D", F.concat(F.lit("4E"), row("new")))
    return F.unhex(F.concat(F.hex("tag"), lead, number(F.col("oid"), 8), old, new))


def encode_batch(batch: pa.RecordBatch, version: int) -> pa.Array:
    fine = _plain(batch, version)
    fast, rest = np.flatnonzero(fine), np.flatnonzero(~fine)
    head = _changes(batch.take(pa.array(fast)), version)
    tail = [wire.encode(_message(m), version, m["stream_xid"] is not None) for m in batch.take(pa.array(rest)).to_pylist()]
    place = np.empty(len(fine), np.int64)
    place[fast], place[rest] = np.arange(len(fast)), len(fast) + np.arange(len(rest))
    return pa.concat_arrays([head, pa.array(tail, pa.binary())]).take(pa.array(place))


def _true(mask: pa.Array) -> np.ndarray:
    return pc.fill_null(mask, False).to_numpy(zero_copy_only=False)


def _number(numbers: pa.Array, width: int = 4) -> pa.Array:
    """Big-endian bytes of numbers without a sign; zeros for null."""
    raw = pc.fill_null(numbers, 0).to_numpy(zero_copy_only=False).astype(f">u{width}").tobytes()
    bounds = pa.py_buffer(np.arange(0, width * len(numbers) + 1, width, dtype=np.int32).tobytes())
    return pa.Array.from_buffers(pa.binary(), len(numbers), [None, bounds, pa.py_buffer(raw)])


def _plain(batch: pa.RecordBatch, version: int) -> np.ndarray:
    """Inserts, updates and deletes whose fields are all there and of the right range."""
    fits = lambda c: _true(pc.and_(pc.greater_equal(c, 0), pc.less(c, 1 << 32)))
    tag, old, new = (batch.column(c) for c in ("tag", "old", "new"))
    inserts, updates, deletes = (_true(pc.equal(tag, t)) for t in "IUD")
    has_old, has_new = (c.is_valid().to_numpy(zero_copy_only=False) for c in (old, new))
    keyed = _true(pc.is_in(batch.column("key_type"), pa.array(["K", "O"]))) | ~batch.column("key_type").is_valid().to_numpy(zero_copy_only=False)
    out = ((inserts | updates) & has_new) | (deletes & has_old)
    out &= (keyed | inserts) & fits(batch.column("oid"))
    if version >= 2:
        out &= ~batch.column("stream_xid").is_valid().to_numpy(zero_copy_only=False) | fits(batch.column("msg_xid"))
    for values in (old, new):
        cells, row = values.flatten(), pc.list_parent_indices(values).to_numpy(zero_copy_only=False)
        kind, value = pc.struct_field(cells, "kind"), pc.struct_field(cells, "value")
        good = _true(pc.is_in(kind, pa.array(["n", "u"]))) | (_true(pc.is_in(kind, pa.array(["t", "b"]))) & value.is_valid().to_numpy(zero_copy_only=False))
        out[row[~good]] = False
        out &= _true(pc.less(pc.fill_null(pc.list_value_length(values), 0), 1 << 16))
    return out


def _changes(batch: pa.RecordBatch, version: int) -> pa.Array:
    """The bytes of plain changes."""
    n, tag = batch.num_rows, batch.column("tag")
    always, empty = pa.scalar(b"", pa.binary()), pa.array([b""] * n, pa.binary())
    some = lambda there, c: pc.if_else(there, c, always)
    lead = some(batch.column("stream_xid").is_valid(), _number(batch.column("msg_xid"))) if version >= 2 else empty
    has_old = pc.and_(batch.column("old").is_valid(), pc.not_equal(tag, "I"))
    key = some(has_old, pc.fill_null(batch.column("key_type"), "K").cast(pa.binary()))
    has_new = pc.not_equal(tag, "D")
    mark = some(has_new, pa.scalar(b"N", pa.binary()))
    old, new = some(has_old, _tuples(batch.column("old"))), some(has_new, _tuples(batch.column("new")))
    return pc.binary_join_element_wise(tag.cast(pa.binary()), lead, _number(batch.column("oid")), key, old, mark, new, always)


def _tuples(values: pa.Array) -> pa.Array:
    """The bytes of each tuple, empty for null."""
    cells, count = values.flatten(), pc.fill_null(pc.list_value_length(values), 0)
    kind, value = pc.struct_field(cells, "kind"), pc.struct_field(cells, "value")
    none, sized = pa.scalar(b"", pa.binary()), pc.is_in(kind, pa.array(["t", "b"]))
    value = pc.if_else(sized, value, none)
    size = pc.if_else(sized, _number(pc.binary_length(value)), none)
    each = pc.binary_join_element_wise(kind.cast(pa.binary()), size, value, none)
    bounds = np.concatenate([[0], np.cumsum(count.to_numpy(zero_copy_only=False))]).astype(np.int32)
    body = pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds), each), none)
    return pc.binary_join_element_wise(_number(count, 2), body, none)


def _message(m: dict) -> dict:
    m = {k: v for k, v in m.items() if v is not None}
    for name in POSITIONS:
        if name in m:
            m[name] = position(m[name])
    for name in ("old", "new"):
        if name in m:
            m[name] = [(x["kind"], x["value"]) for x in m[name]]
    if "columns" in m:
        m["columns"] = [(int(c["is_key"]), c["name"], c["type_id"], c["type_modifier"]) for c in m["columns"]]
    if "replident" in m:
        m["replident"] = ord(m["replident"])
    if m["tag"] not in "TM":
        m.setdefault("flags", 0)
    return m


def frames(bronze: DataFrame) -> DataFrame:
    """Adds frame: the payload behind a data frame's header, as it came over the wire."""
    number = lambda c: F.unhex(F.lpad(F.hex(c), 16, "0"))
    return bronze.withColumn("frame", F.concat(F.lit(b"w"), number(F.col("wal_start")), number(F.col("wal_end")), number(F.col("server_time")), F.col("data")))
