"""Captures of one log by several connections, one after the other, as one log.

A connection that is recovered starts at a position the consumer has confirmed, so the server sends again what came after
it, under new sequence numbers. A frame is the same as one of an earlier session if position and bytes are the same and
it is the same occurrence of them in its session: a record of many rows gives frames of one position, and rows may be
equal. Frames without a position (relation and type messages are sent so) go with the next frame that has one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidelog.functions.lsn import ordered
from tidelog.operators.carry import BUCKET, broadcast_if_few, carry_forward, running
from tidelog.sources.scratch import materialise

#: Sessions, and repeated frames, up to which they are broadcast.
FEW = 1_000_000
NAMES = ("slot", "session", "seq", "wal_start", "wal_end", "server_time", "data")
#: A frame without a position.
NOWHERE = 0


def _reaches(captured: DataFrame) -> DataFrame:
    """One row a session: its lowest and highest position, the highest of the sessions before and the lowest of those after, as they order."""
    placed = F.when(F.col("wal_start") != NOWHERE, ordered(F.col("wal_start")))
    each = captured.groupBy("slot", "session").agg(F.min(placed).alias("low"), F.max(placed).alias("high"), F.max(ordered(F.col("wal_end"))).alias("end"))
    by = W.partitionBy("slot").orderBy("session")
    before, after = by.rowsBetween(W.unboundedPreceding, -1), by.rowsBetween(1, W.unboundedFollowing)
    return each.select("slot", "session", "low", "high", F.max("high").over(before).alias("reach"), F.min("low").over(after).alias("later"), F.max("end").over(before).alias("told"))


def gaps(captured: DataFrame) -> DataFrame:
    """(slot, session, gap_from, gap_to): where a session begins behind all that the ones before had been told of.

    Only positions can tell: between gap_from and gap_to nothing was captured. Whether the server had something to send
    there is known to the server alone.
    """
    each = _reaches(_read(captured)).where("low > told")
    return each.select("slot", "session", ordered(F.col("told")).alias("gap_from"), ordered(F.col("low")).alias("gap_to"))


def _read(captured: DataFrame) -> DataFrame:
    return captured.select(*NAMES).withColumn("slot", F.coalesce("slot", F.lit("")))


def repeated(captured: DataFrame) -> DataFrame:
    """(slot, session, seq) of frames that an earlier session has.

    Only frames at positions that several sessions cover are looked at, and only their names, positions and digests are
    shuffled.
    """
    rows = _read(captured)
    reaches = materialise(_reaches(rows), "reaches")
    rows = rows.join(broadcast_if_few(reaches.select("slot", "session", "reach", "later"), F.lit(1), FEW), ["slot", "session"])
    at = ordered(F.col("wal_start"))
    shared = (F.col("wal_start") != NOWHERE) & ((at <= F.col("reach")) | (at >= F.col("later")))
    same = ["slot", "wal_start", "digest"]
    zone = rows.where(shared).select("slot", "session", "seq", "wal_start", F.md5(F.coalesce("data", F.lit(b""))).alias("digest")).repartition(*same)
    zone = zone.withColumn("nth", F.row_number().over(W.partitionBy(*same, "session").orderBy("seq")))
    zone = zone.withColumn("first", F.min("session").over(W.partitionBy(*same, "nth")))
    placed = materialise(zone.where("session > first").select("slot", "session", "seq"), "repeated")
    return placed.unionByName(_followers(rows, placed))


def _followers(rows: DataFrame, placed: DataFrame) -> DataFrame:
    """Frames without a position of later sessions, in front of a frame that is repeated: carried back from it, in order of falling seq."""
    name, turned = F.concat_ws("\0", "slot", F.col("session").cast("string")), -F.col("seq")
    late = rows.where("reach is not null").select("slot", "session", "seq", "wal_start")
    marked = late.join(broadcast_if_few(placed.withColumn("there", F.lit(1)), F.lit(1), FEW), ["slot", "session", "seq"], "left")
    turned_log = marked.select(name.alias("slot"), turned.alias("seq"), F.floor(turned / BUCKET).alias("_bucket"), F.col("slot").alias("of"), "session", "wal_start", "there")
    known = carry_forward(turned_log, {"fate": F.when(F.col("wal_start") != NOWHERE, F.coalesce("there", F.lit(0)))})
    return known.where(f"wal_start = {NOWHERE} and fate = 1").select(F.col("of").alias("slot"), "session", (-F.col("seq")).alias("seq"))


def merged(captured: DataFrame) -> DataFrame:
    """(slot, session, seq, wal_start, wal_end, server_time, data) of all sessions -> bronze frames of one log, each once.

    Sessions are in order, and so are the frames of each by seq; the log's seq counts from 1. A transaction that the end
    of a session cut goes on with what the next session has new of it. A slot of one session stays as it is.
    """
    rows = _read(captured)
    again = materialise(repeated(captured), "again")
    kept = rows.join(broadcast_if_few(again, F.lit(1), FEW), ["slot", "session", "seq"], "left_anti")
    counts = kept.groupBy("slot", "session").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("slot").orderBy("session").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = materialise(counts.select("slot", "session", before.alias("_before")), "starts")
    named = kept.select(F.concat_ws("\0", "slot", F.col("session").cast("string")).alias("slot"), F.floor(F.col("seq") / BUCKET).alias("_bucket"), F.struct("slot").alias("of"), *NAMES[1:])
    placed = running(named, {"_place": ("sum", F.lit(1).cast("long"))}).withColumn("slot", F.col("of.slot"))
    placed = placed.join(broadcast_if_few(starts, F.lit(1), FEW), ["slot", "session"])
    return placed.select("slot", (F.col("_before") + F.col("_place")).alias("seq"), "wal_start", "wal_end", "server_time", "data")
