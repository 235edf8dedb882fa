"""A byte stream, captured in chunks cut anywhere, to its messages, in parallel.

A message is a letter or digit, a length that counts itself, and a body. Where the messages of a chunk begin depends on
all bytes before it, so a chunk by itself is a function: from the place where the first message at or behind its start
begins, to the same for its end. Chunks are laid out anew as blocks of equal size, each with the few bytes that follow
it, and the functions are composed by a prefix scan over blocks: up, groups of FAN blocks, then of FAN groups, and so on,
become functions of their own; down, the place where a group is entered gives the places where its members are. Then all
blocks are split side by side.

A function is only known where it can be asked: at places to which a length somewhere before points, few for each
block. Places are byte offsets in the stream of a slot.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.operators.carry import running, with_bucket
from tidelog.sources.scratch import materialise

#: Bytes of a block, members of a group of the scan, and the longest message.
BLOCK, FAN, LONGEST = 1 << 16, 1 << 10, 128 << 20
HEADER = 5
_KINDS = np.zeros(256, bool)
_KINDS[[c for c in range(128) if chr(c).isalnum()]] = True
#: A message: where it begins, its letter, and its body, or why there is none.
SCHEMA = "slot string, at long, tag string, body binary, error string"


def blocks(captured: DataFrame, size: int = BLOCK) -> DataFrame:
    """(slot, seq, bytes) chunks in order of seq -> (slot, block, data, total): the stream in blocks of size bytes.

    data has HEADER - 1 bytes more, those of the next block, where the stream goes on; total is the stream's length.
    Chunks of any length, empty and null ones too, make the same blocks. A null slot is an empty one.
    """
    chunks = with_bucket(captured.select("slot", "seq", F.coalesce("bytes", F.lit(b"")).alias("bytes")))
    placed = running(chunks, {"begin": ("sum", F.length("bytes").cast("long"))}, before=True)
    end = F.col("begin") + F.length("bytes")
    first = F.floor(F.greatest(F.col("begin") - (HEADER - 1), F.lit(0)) / size)  # also the block before, which wants the first bytes
    parts = placed.where(F.length("bytes") > 0).select("slot", "begin", "bytes", F.explode(F.sequence(first, F.floor((end - 1) / size))).alias("block"))
    low = F.greatest(F.col("begin"), F.col("block") * size)
    high = F.least(F.col("begin") + F.length("bytes"), (F.col("block") + 1) * size + HEADER - 1)
    piece = F.substring("bytes", (low - F.col("begin") + 1).cast("int"), (high - low).cast("int"))
    parts = parts.select("slot", "block", low.alias("low"), piece.alias("piece"), (high > low).alias("some")).where("some")
    totals = chunks.groupBy("slot").agg(F.sum(F.length("bytes").cast("long")).alias("total"))
    return parts.groupBy("slot", "block").agg(joined("low").alias("data")).join(F.broadcast(totals), "slot")


def joined(order: str) -> Column:
    """The pieces of a group in order, as one value; by texts, so that the time is in proportion to the length."""
    return F.unhex(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, "piece"))), lambda x: F.hex(x["piece"])), ""))


def _lengths(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place with a whole header: whether a message may begin there, and where it would end."""
    n = max(len(data) - HEADER + 1, 0)
    size = np.zeros(n, np.int64)
    for k in range(1, HEADER):
        size = size << 8 | data[k : k + n]
    return _KINDS[data[:n]] & (size >= 4) & (size <= LONGEST), np.arange(n) + 1 + size


def _asked(cut: DataFrame, size: int) -> DataFrame:
    """(slot, e): places behind its block to which a length in a block points, and the start of each stream."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots, places = [], []
            for slot, block, data, total in zip(*batch.columns, strict=True):
                begin = block.as_py() * size
                may, end = _lengths(np.frombuffer(data.as_buffer(), np.uint8))
                end = begin + np.unique(end[:size][may[:size] & (end[:size] >= size)])
                end = end[end < total.as_py()]
                places.append(np.append(end, 0) if begin == 0 else end)
                slots += [slot.as_py()] * len(places[-1])
            yield pa.RecordBatch.from_arrays([pa.array(slots, pa.string()), pa.array(np.concatenate(places) if places else [], pa.int64())], ["slot", "e"])

    return cut.select("slot", "block", "data", "total").mapInArrow(run, "slot string, e long").distinct()


def _crossings(cut: DataFrame, asked: DataFrame, size: int) -> DataFrame:
    """(slot, e, x): for each place asked of a block, where the first message behind the block begins; none if it comes to no message there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for slot, block, data, places in zip(*batch.columns, strict=True):
                begin = block.as_py() * size
                may, end = _lengths(np.frombuffer(data.as_buffer(), np.uint8))
                known: dict[int, int] = {}
                for place in sorted((p - begin for p in places.as_py()), reverse=True):
                    at = place
                    while at < size and at not in known and at < len(may) and may[at]:
                        at = int(end[at])
                    at = known.get(at, at)
                    if at >= size:
                        known[place] = at
                        rows.append((slot.as_py(), begin + place, begin + at))
            columns = list(zip(*rows, strict=True)) or [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.int64()), strict=True)], ["slot", "e", "x"])

    of = asked.groupBy("slot", F.floor(F.col("e") / size).alias("block")).agg(F.collect_list("e").alias("places"))
    return cut.join(of, ["slot", "block"]).select("slot", "block", "data", "places").mapInArrow(run, "slot string, e long, x long")


def _composed(steps: DataFrame, width: int) -> DataFrame:
    """Functions of groups of width bytes from those of their members: each place is followed until it leaves its group."""

    def follow(group: pd.DataFrame) -> pd.DataFrame:
        end = (group["e"].iloc[0] // width + 1) * width
        out: dict[int, int] = {}
        for e, x in sorted(zip(group["e"], group["x"], strict=True), reverse=True):
            if x >= end:
                out[e] = x
            elif x in out:
                out[e] = out[x]
        return pd.DataFrame({"slot": group["slot"].iloc[0], "e": list(out), "x": list(out.values())})

    return steps.groupBy("slot", F.floor(F.col("e") / width)).applyInPandas(follow, "slot string, e long, x long")


def _entered(real: DataFrame, steps: DataFrame, width: int) -> DataFrame:
    """(slot, e): where the members of groups of width bytes are entered, from where the groups are; places that lead nowhere are the last."""

    def follow(group: pd.DataFrame) -> pd.DataFrame:
        known = dict(zip(group["e"][~group["real"]], group["x"][~group["real"]], strict=True))
        end, found = (group["e"].iloc[0] // width + 1) * width, []
        for at in group["e"][group["real"]]:
            while at is not None and at < end:
                found.append(int(at))
                at = known.get(at)
        return pd.DataFrame({"slot": group["slot"].iloc[0], "e": pd.Series(found, dtype="int64")})

    both = steps.withColumn("real", F.lit(False)).unionByName(real.select("slot", "e", F.lit(0).cast("long").alias("x"), F.lit(True).alias("real")))
    return both.groupBy("slot", F.floor(F.col("e") / width)).applyInPandas(follow, "slot string, e long")


def entries(cut: DataFrame, size: int = BLOCK, fan: int = FAN) -> DataFrame:
    """(slot, e): for each block in which a message begins, the place of the first one."""
    asked = materialise(_asked(cut, size), "asked")
    steps, width = [materialise(_crossings(cut, asked, size), "crossings")], size * fan
    longest = cut.agg(F.max("total")).first()[0] or 0
    while width < longest:
        steps.append(materialise(_composed(steps[-1], width), "composed"))
        width *= fan
    real = asked.where("e = 0")
    for known in reversed(steps):
        real = materialise(_entered(real, known, width), "entered")
        width //= fan
    return real


def split_log(captured: DataFrame, size: int = BLOCK, fan: int = FAN) -> DataFrame:
    """(slot, seq, bytes) of captured byte logs -> SCHEMA: all messages, in the order of their places, wherever chunks were cut.

    What can't be read is the last row of its slot, with an error and no body: a length or a letter that no message has,
    or a message of which the end is not there yet. A message is put together in one task, and only one that runs over
    the end of its block is shuffled.
    """
    cut = materialise(blocks(captured, size), "blocks")
    first = entries(cut, size, fan).select("slot", F.floor(F.col("e") / size).alias("block"), "e")
    parts = materialise(cut.join(first, ["slot", "block"], "left").select("slot", "block", "data", "total", "e").mapInArrow(_splitter(size), f"{SCHEMA}, upto long"), "parts")
    whole, begun = parts.where("upto is null"), parts.where("upto is not null")
    reach = begun.select("slot", "at", "upto", "tag", F.explode(F.sequence(F.floor((F.col("at") + HEADER) / size), F.floor((F.col("upto") - 1) / size))).alias("block"))
    low, high = F.greatest(F.col("at") + HEADER, F.col("block") * size), F.least(F.col("upto"), (F.col("block") + 1) * size)
    piece = F.substring("data", (low - F.col("block") * size + 1).cast("int"), (high - low).cast("int"))
    pieces = reach.join(cut.select("slot", "block", "data"), ["slot", "block"]).select("slot", "at", "tag", "block", piece.alias("piece"))
    long = pieces.groupBy("slot", "at").agg(F.first("tag").alias("tag"), joined("block").alias("body")).withColumn("error", F.lit(None).cast("string"))
    return whole.drop("upto").unionByName(long)


def _splitter(size: int):
    """Messages that begin in a block, from its first one on; upto is the end of one that goes on behind the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for slot, block, data, total, entry in zip(*batch.columns, strict=True):
                if entry.as_py() is None:
                    continue
                slot, begin, total, data = slot.as_py(), block.as_py() * size, total.as_py(), data.as_py()
                at = entry.as_py() - begin
                while at < size and begin + at < total:
                    if len(data) - at < HEADER:
                        rows.append((slot, begin + at, None, None, f"message cut off after {len(data) - at} bytes", None))
                        break
                    tag, n = chr(data[at]), struct.unpack_from(">I", data, at + 1)[0]
                    wrong = None if _KINDS[data[at]] else f"unknown message {data[at]}"
                    wrong = f"message length {n}" if not wrong and not 4 <= n <= LONGEST else wrong
                    end = at + 1 + n
                    if not wrong and begin + end > total:
                        wrong = f"message cut off after {total - begin - at} bytes"
                    if wrong:
                        rows.append((slot, begin + at, tag, None, wrong, None))
                        break
                    inside = end <= len(data)
                    rows.append((slot, begin + at, tag, data[at + HEADER : end] if inside else None, None, None if inside else begin + end))
                    at = end
            kinds = (pa.string(), pa.int64(), pa.string(), pa.binary(), pa.string(), pa.int64())
            columns = list(zip(*rows, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["slot", "at", "tag", "body", "error", "upto"])

    return run
