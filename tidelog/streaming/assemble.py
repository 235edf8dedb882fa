"""Whole transactions out of a frame stream, on the state store.

Two stateful steps. The first, keyed by slot, reads tags and ids only and names the transaction of every frame; it keeps
the open transaction, the open stream block, where undecided transactions began and the last version of each relation.
The second, keyed by transaction, keeps the frames of an undecided one and gives them out when it commits, with the
relation versions that its changes need. So state is bounded by what is open, a batch reads and writes only what is new,
and behind it every batch is a small log of whole transactions to which the batch operators apply.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tidelog.operators import events as E
from tidelog.operators import txn
from tidelog.operators.decode import decode
from tidelog.sources import capture
from tidelog.sources.scratch import materialise

FRAME = "seq long, wal_start long, wal_end long, server_time long, data binary"
FIELDS = [f.split()[0] for f in FRAME.split(", ")]
NAMED = f"slot string, txn_id long, txn_seq long, fate int, {FRAME}"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
NONE = -1
#: What a frame does to its transaction: nothing, an end that makes it visible, or one that drops it.
OPEN, DONE, DROPPED = 0, 1, -1
#: Where a transaction's id stands in the payload of each tag that names one. Fixed values of the protocol.
XID_AT = {"B": 17, "S": 1, "c": 1, "A": 1, "b": 25, "P": 26, "K": 26, "r": 34, "p": 26}


def _u32(data: bytes, at: int) -> int:
    return struct.unpack_from(">I", data, at)[0]


class Namer(StatefulProcessor):
    """Frames of a slot, in order of seq, to frames of transactions. Payloads too short for their tag are passed over."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.at = handle.getValueState("at", "txn_id long, txn_seq long, block long")
        self.begins = handle.getMapState("begins", "xid long", "seq long")
        self.versions = handle.getMapState("versions", "oid long", FRAME)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timers) -> Iterator[pd.DataFrame]:
        frames = pd.concat(list(rows)).sort_values("seq")
        held = self.at.get() if self.at.exists() else None
        self.open, self.begun, self.block = held or (NONE, NONE, NONE)
        self.told: set[tuple] = set()
        out: list[tuple] = []
        for frame in frames[FIELDS].itertuples(index=False, name=None):
            data = bytes(frame[-1]) if frame[-1] is not None else b""
            try:
                out += self._named(frame[:-1] + (data,), data)
            except struct.error:
                continue
        self.at.update((self.open, self.begun, self.block))
        yield pd.DataFrame([(key[0], *r) for r in out], columns=["slot", "txn_id", "txn_seq", "fate", *FIELDS])

    def _named(self, frame: tuple, data: bytes) -> list[tuple]:
        tag = chr(data[0]) if data else ""
        if tag in XID_AT:
            return self._marked(frame, data, tag, _u32(data, XID_AT[tag]))
        if tag == "R":
            self.versions.updateValue((_u32(data, 5 if self.block != NONE else 1),), frame)
        xid, begun = (self.block, self._begin(self.block)) if self.block != NONE else (self.open, self.begun)
        if tag == "E":
            self.block = NONE
        elif tag == "C":
            self.open = self.begun = NONE
        if xid == NONE or begun == NONE or not tag:
            return []
        if tag == "C":
            self._forget(xid, begun)
        at = 5 if self.block != NONE else 1
        oids = [_u32(data, at)] if tag in "IUD" else [_u32(data, at + 5 + 4 * k) for k in range(_u32(data, at))] if tag == "T" else []
        return [*self._relations(xid, begun, oids), (xid, begun, DONE if tag == "C" else OPEN, *frame)]

    def _marked(self, frame: tuple, data: bytes, tag: str, xid: int) -> list[tuple]:
        """Frames that name their transaction."""
        seq = frame[0]
        if tag in "Bb" or (tag == "S" and data[5]):
            self.begins.updateValue((xid,), (seq,))
        begun = self._begin(xid)
        if tag in "Bb":
            self.open, self.begun = xid, begun
        elif tag == "P":
            self.open = self.begun = NONE
        elif tag == "S":
            self.block = xid
        whole = tag == "A" and _u32(data, 5) == xid
        fate = DONE if tag in "cK" else DROPPED if tag == "r" or whole else OPEN
        if fate != OPEN:
            self._forget(xid, begun)
        return [(xid, begun, fate, *frame)] if begun != NONE else []

    def _begin(self, xid: int) -> int:
        return int(self.begins.getValue((xid,))[0]) if self.begins.containsKey((xid,)) else NONE

    def _forget(self, xid: int, begun: int) -> None:
        if begun != NONE and self._begin(xid) == begun:
            self.begins.removeKey((xid,))

    def _relations(self, xid: int, begun: int, oids: list[int]) -> list[tuple]:
        """The versions that hold for a change, for its transaction, once in a batch."""
        out = []
        for oid in oids:
            if self.versions.containsKey((oid,)):
                frame = tuple(self.versions.getValue((oid,)))
                if (xid, begun, frame[0]) not in self.told:
                    self.told.add((xid, begun, frame[0]))
                    out.append((xid, begun, OPEN, *frame[:-1], bytes(frame[-1])))
        return out


class Holder(StatefulProcessor):
    """Frames of one transaction, held until it is decided: given out whole when it commits, forgotten when it does not.

    With a time to live, a transaction that is not decided for so long is forgotten too.
    """

    def __init__(self, ttl_ms: int | None):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getListState("held", FRAME, self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timers) -> Iterator[pd.DataFrame]:
        frames = pd.concat(list(rows)).sort_values("seq")
        fates = set(frames["fate"])
        new = [(*map(int, r[:-1]), bytes(r[-1])) for r in frames[FIELDS].itertuples(index=False, name=None)]
        if DONE in fates:
            before = [tuple(r) for r in self.held.get()] if self.held.exists() else []
            yield pd.DataFrame([(key[0], *r) for r in [*before, *new]], columns=["slot", *FIELDS])
        if fates & {DONE, DROPPED}:
            self.held.clear()
        else:
            self.held.appendList(new)


def transactions(frames: DataFrame, ttl_ms: int | None = None) -> DataFrame:
    """A stream of bronze frames -> the frames of committed transactions, each when it commits, with slot and the fields of FRAME.

    Relation frames come with every transaction that needs them, so they may come more than once. Order inside a batch
    is that of seq; the session must name the RocksDB state store.
    """
    mode = "ProcessingTime" if ttl_ms else "None"
    named = frames.select(F.coalesce("slot", F.lit("")).alias("slot"), *FIELDS).groupBy("slot").transformWithStateInPandas(Namer(), NAMED, "append", mode)
    return named.groupBy("slot", "txn_id", "txn_seq").transformWithStateInPandas(Holder(ttl_ms), f"slot string, {FRAME}", "append", mode)


class Assembly:
    """Replay on the state store: writes the committed changes of each batch under a folder, then calls the handler.

    Offsets and state are the checkpoint's, so a batch that failed is run again with the same frames; a batch that is
    noted as done is not handled twice. What relations said before is not told again as change events.
    """

    def __init__(self, spark: SparkSession, folder: str, version: int = 1, handler: Callable[[DataFrame, int], None] | None = None, ttl_ms: int | None = None):
        self.spark, self.folder, self.version, self.handler, self.ttl_ms = spark, folder.rstrip("/"), version, handler, ttl_ms

    def batch(self, frames: DataFrame, number: int) -> None:
        done = f"{self.folder}/done/batch={number}"
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{done}/_SUCCESS")
        if path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return
        frames = materialise(frames.dropDuplicates(["slot", "seq"]), "whole")
        messages = materialise(decode(frames, self.version), "messages")
        log = materialise(E.events(messages, txn.assign(messages)), "events")
        changes = txn.committed(log).drop("_bucket")
        changes.write.mode("overwrite").parquet(f"{self.folder}/changes/batch={number}")
        if self.handler:
            self.handler(self.spark.read.schema(changes.schema).parquet(f"{self.folder}/changes/batch={number}"), number)
        self.spark.createDataFrame([(number,)], "batch long").write.mode("overwrite").parquet(done)

    def start(self, path: str, checkpoint: str, **options: str) -> StreamingQuery:
        capture.register(self.spark)
        self.spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
        options = {"progress": f"{self.folder}/progress"} | options
        frames = self.spark.readStream.format("tidelog").option("path", path).options(**options).load()
        return transactions(frames, self.ttl_ms).writeStream.foreachBatch(self.batch).outputMode("append").option("checkpointLocation", checkpoint).start()

    def changes(self) -> DataFrame:
        """All committed changes of batches that are done."""
        done = self.spark.read.schema("batch long").parquet(f"{self.folder}/done").select("batch").distinct()
        return self.spark.read.parquet(f"{self.folder}/changes").join(F.broadcast(done), "batch", "left_semi").drop("batch")
