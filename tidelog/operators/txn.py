"""Transactions: which one a change belongs to, whether it becomes visible, and in which order.

A transaction is named by its xid and by the sequence number of the message that begins it, as xids come round again.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions import lsn as L
from tidelog.operators.carry import broadcast_if_few, carry_forward, dealt, with_bucket
from tidelog.operators.decode import by_slot

DATA = ("I", "U", "D", "T", "M", "R", "Y", "O")
NONE = -1
#: Columns that name a transaction.
KEY = ["slot", "txn_id", "txn_seq"]


#: Rows that begin, bound or end transactions up to which they are sent to every worker, as arrays of about 40 bytes a
#: mark; beyond that a window carries them. The same for transactions that are joined to rows.
FEW_MARKS, FEW_TXNS = 5_000_000, 2_000_000
BEGINS, CLOSES, OWN = ("B", "b"), ("C", "P"), ("B", "b", "S", "c", "A", "P", "K", "r", "p")


def assign(log: DataFrame) -> DataFrame:
    """Adds txn_id, the xid of the transaction a row belongs to, and txn_seq, the sequence number of its begin.

    Rows of a stream block name their transaction; others stand between a begin (or begin_prepare) and its end. The end
    itself, and what names a transaction, belongs to it. A row belongs to the last transaction of its xid that began at
    or before it; txn_seq is -1 if its begin is not in the log. The log has slot, seq, tag, xid, stream_xid and
    first_segment. Where few rows bound transactions nothing is shuffled; else see carried().
    """
    log = log if "_bucket" in log.columns else with_bucket(log)
    marks = log.where(F.col("tag").isin(*BEGINS, *CLOSES, "S") & (F.col("xid").isNotNull() | F.col("tag").isin(*CLOSES)))
    marks = marks.select("slot", "seq", "tag", "xid", "first_segment")
    return carried(log) if marks.count() > FEW_MARKS else looked_up(log, marks.toArrow())


def carried(log: DataFrame) -> DataFrame:
    """assign() for any number of transactions: rows are dealt out by bucket, and what a bucket inherits is joined to it."""
    tag, xid = F.col("tag"), F.col("xid")
    marks = {"_open": F.when(tag.isin(*BEGINS), xid).when(tag.isin(*CLOSES), NONE), "_block": F.when(tag == "S", xid)}
    log = carry_forward(dealt(log), marks, before=True)
    own = F.when(tag.isin(*OWN), xid).when(tag == "E", F.col("_block"))
    log = log.withColumn("txn_id", F.coalesce(own, F.col("stream_xid"), F.nullif("_open", F.lit(NONE)))).drop("_open", "_block")
    begins = tag.isin(*BEGINS) | ((tag == "S") & F.col("first_segment"))
    log = carry_forward(log, {"txn_seq": F.when(begins, F.col("seq"))}, key="txn_id")
    return log.withColumn("txn_seq", F.when(F.col("txn_id").isNotNull(), F.coalesce("txn_seq", F.lit(NONE).cast("long"))))


def looked_up(log: DataFrame, marks: pa.Table) -> DataFrame:
    """assign() where the rows that bound transactions are few: every row finds its own by binary search among them."""
    shared = log.sparkSession.sparkContext.broadcast(_Marks(marks))

    @F.arrow_udf("struct<txn_id:long,txn_seq:long>")
    def find(slot: pa.Array, seq: pa.Array, tag: pa.Array, xid: pa.Array, stream_xid: pa.Array) -> pa.Array:
        return shared.value.find(slot, seq, tag, xid, stream_xid)

    found = log.withColumn("_txn", find("slot", "seq", "tag", "xid", "stream_xid"))
    return found.select(*log.columns, "_txn.txn_id", "_txn.txn_seq")


class _Marks:
    """Begins, ends and stream starts of each slot, in order."""

    def __init__(self, marks: pa.Table):
        self.of = {slot: _Slot(rows) for slot, rows in by_slot(marks)}

    def find(self, slot: pa.Array, seq: pa.Array, tag: pa.Array, xid: pa.Array, stream_xid: pa.Array) -> pa.Array:
        known = lambda a: a.fill_null(-1).to_numpy(zero_copy_only=False)
        at, xids, streams = seq.to_numpy(zero_copy_only=False), known(xid), known(stream_xid)
        named = slot.dictionary_encode()
        place, tags = named.indices.to_numpy(zero_copy_only=False), tag.fill_null("").dictionary_encode()
        kinds, kind = tags.dictionary.to_pylist(), tags.indices.to_numpy(zero_copy_only=False)
        among = lambda some: np.isin(kind, [k for k, t in enumerate(kinds) if t in some])
        own, stops = among(OWN), among("E")
        txn, begin = np.full(len(at), NONE, np.int64), np.full(len(at), NONE, np.int64)
        for k, name in enumerate(named.dictionary.to_pylist()):
            rows, of = place == k, self.of.get(name)
            before = of.before(at[rows]) if of else (np.full(rows.sum(), NONE),) * 2
            inner = np.where(streams[rows] >= 0, streams[rows], before[0])
            inner = np.where(stops[rows] & (before[1] >= 0), before[1], inner)
            txn[rows] = np.where(own[rows] & (xids[rows] >= 0), xids[rows], inner)
            begin[rows] = of.begin(txn[rows], at[rows]) if of else NONE
        none = txn < 0
        return pa.StructArray.from_arrays([pa.array(txn, mask=none), pa.array(begin, mask=none)], ["txn_id", "txn_seq"])


class _Slot:
    def __init__(self, rows: pa.Table):
        at, xid = rows.column("seq").to_numpy(), pc.fill_null(rows.column("xid"), NONE).to_numpy()
        true = lambda mask: pc.fill_null(mask, False).to_numpy()
        among = lambda some: true(pc.is_in(rows.column("tag"), pa.array(some, pa.string())))
        opens, turns, blocks = among(BEGINS), among(BEGINS + CLOSES), among(("S",))
        self.turns = np.stack([at[turns], np.where(opens, xid, NONE)[turns]])
        self.blocks = np.stack([at[blocks], xid[blocks]])
        begins = opens | (blocks & true(rows.column("first_segment")))
        seqs, xids = at[begins], xid[begins]
        # begins by (xid, place among all begins), as one number
        self.seqs, self.xids, self.wide = seqs, np.unique(xids), len(seqs) + 1
        self.codes = np.searchsorted(self.xids, xids) * self.wide + np.arange(1, self.wide)
        order = np.argsort(self.codes)
        self.codes, self.first = self.codes[order], seqs[order]

    def before(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The open transaction and the last stream start strictly before each place, -1 for none."""
        return tuple(self._last(marks, np.searchsorted(marks[0], at, "left") - 1) for marks in (self.turns, self.blocks))

    @staticmethod
    def _last(marks: np.ndarray, k: np.ndarray) -> np.ndarray:
        return np.where(k >= 0, marks[1][np.maximum(k, 0)], NONE) if marks.shape[1] else np.full(len(k), NONE)

    def begin(self, xid: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Place of the last begin of each transaction id at or before each place, -1 for none."""
        if not len(self.seqs):
            return np.full(len(xid), NONE)
        which = np.minimum(np.searchsorted(self.xids, xid), len(self.xids) - 1)
        k = np.searchsorted(self.codes, which * self.wide + np.searchsorted(self.seqs, at, "right"), "right") - 1
        good = (self.xids[which] == xid) & (k >= 0)
        good &= np.where(good, self.codes[np.maximum(k, 0)] // self.wide == which, False)
        return np.where(good, self.first[np.maximum(k, 0)], NONE)


def outcomes(assigned: DataFrame) -> DataFrame:
    """One row per decided transaction: slot, txn_id, txn_seq, status, commit_seq, commit_lsn, end_lsn, commit_ts, gid.

    Status is committed, aborted, prepared (decided by gid later, or not yet) or rolled_back. A prepared transaction's
    commit names the same gid and xid. Transactions without a row are still open.
    """
    ends = assigned.where(F.col("tag").isin("C", "c", "P", "p", "K", "r") | ((F.col("tag") == "A") & (F.col("xid") == F.col("subxid"))))
    status = (
        F.when(F.col("tag").isin("C", "c", "K"), "committed").when(F.col("tag") == "A", "aborted").when(F.col("tag") == "r", "rolled_back").otherwise("prepared")
    )
    last = F.max_by(F.struct(status.alias("status"), F.col("seq").alias("commit_seq"), "commit_lsn", "end_lsn", F.col("event_ts").alias("commit_ts"), "gid"), "seq")
    return ends.groupBy(*KEY).agg(last.alias("x")).select(*KEY, "x.*")


def aborted_parts(assigned: DataFrame) -> DataFrame:
    """(slot, txn_id, txn_seq, msg_xid) of sub-transactions that were rolled back inside a streamed transaction."""
    parts = assigned.where("tag = 'A' and xid != subxid")
    return parts.select(*KEY, F.col("subxid").alias("msg_xid")).distinct()


def committed(assigned: DataFrame, decided: DataFrame | None = None) -> DataFrame:
    """Data events of committed transactions, without rolled-back parts, with commit_seq, commit_lsn, txn_end_lsn and commit_ts."""
    decided = outcomes(assigned) if decided is None else decided
    done = decided.where("status = 'committed'").select(*KEY, "commit_seq", F.col("commit_lsn").alias("_c"), F.col("end_lsn").alias("txn_end_lsn"), "commit_ts")
    data = assigned.where(F.col("tag").isin(*DATA)).drop("commit_lsn")
    rows = data.join(broadcast_if_few(done.withColumnRenamed("_c", "commit_lsn"), F.lit(1), FEW_TXNS), KEY)
    return rows.join(broadcast_if_few(aborted_parts(assigned), F.lit(1), FEW_TXNS), [*KEY, "msg_xid"], "left_anti")


def discarded(assigned: DataFrame) -> DataFrame:
    """Data events that never become visible: of aborted and rolled-back transactions, and rolled-back parts of others."""
    data = assigned.where(F.col("tag").isin(*DATA))
    lost = outcomes(assigned).where("status in ('aborted', 'rolled_back')").select(*KEY)
    whole = data.join(lost, KEY, "left_semi")
    parts = data.join(aborted_parts(assigned), [*KEY, "msg_xid"], "left_semi").join(lost, KEY, "left_anti")
    return whole.unionByName(parts)


def stats(assigned: DataFrame) -> DataFrame:
    """status, transactions and data events; open transactions are those with a row and no outcome."""
    per = assigned.where("txn_id is not null").groupBy(*KEY).agg(F.count(F.when(F.col("tag").isin("I", "U", "D", "T"), 1)).alias("changes"))
    status = per.join(outcomes(assigned).select(*KEY, "status"), KEY, "left").withColumn("status", F.coalesce("status", F.lit("open")))
    return status.groupBy("status").agg(F.count(F.lit(1)).alias("transactions"), F.sum("changes").alias("changes"))


def bounded_replay(log: DataFrame, target: int) -> DataFrame:
    """Events up to and with the first commit whose end is at or past the target; all of them if there is none."""
    cut = log.where(F.col("tag").isin("C", "c", "K") & L.at_or_past(F.col("end_lsn"), target)).groupBy("slot").agg(F.min("seq").alias("_cut"))
    return log.join(cut, "slot", "left").where("_cut is null or seq <= _cut").drop("_cut")


def bounded_replay_raw(bronze: DataFrame, target: int) -> DataFrame:
    """Frames up to and with the first whose end is at or past the target; may cut a transaction."""
    cut = bronze.where(L.at_or_past(F.col("wal_end"), target)).groupBy("slot").agg(F.min("seq").alias("_cut"))
    return bronze.join(cut, "slot", "left").where("_cut is null or seq <= _cut").drop("_cut")


def origins(assigned: DataFrame) -> DataFrame:
    """(slot, txn_id, txn_seq, txn_origin): transactions that came from elsewhere, by the last origin message that stands in them.

    The message may stand in any part of a streamed transaction; it holds for all parts.
    """
    said = assigned.where("tag = 'O' and txn_id is not null")
    return said.groupBy(*KEY).agg(F.max_by("origin_name", "seq").alias("txn_origin"))


def with_origin(rows: DataFrame, assigned: DataFrame) -> DataFrame:
    """Adds txn_origin to rows that have KEY: null for changes made on the server itself."""
    return rows.join(broadcast_if_few(origins(assigned), F.lit(1), FEW_TXNS), KEY, "left")


def of_origin(rows: DataFrame, assigned: DataFrame, origin: str = "none") -> DataFrame:
    """Rows by where their transaction came from: `any` keeps all, `none` those made on the server itself, another name those from there.

    Rows outside of transactions count as made here. Needed where changes go round: a node applies its neighbours'
    changes, which it must not send back.
    """
    if origin == "any":
        return rows
    marked = with_origin(rows, assigned)
    return marked.where(F.col("txn_origin").isNull() if origin == "none" else F.col("txn_origin") == origin).drop("txn_origin")
