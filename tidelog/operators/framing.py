"""Frames to payloads by byte expressions: data frames, keepalives, positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def number(data: Column, at: int, n: int) -> Column:
    """Big-endian integer of n bytes from place at (from 1); of 8 bytes the long of the same bits."""
    return F.conv(F.hex(F.substring(data, at, n)), 16, -10).cast("long")


def unframe(frames: DataFrame) -> DataFrame:
    """(slot, seq, frame) -> bronze: data frames of 25 bytes or more; header-only frames have an empty payload.

    Other frames, empty and short ones are left to keepalives() and malformed().
    """
    f = F.col("frame")
    rows = frames.where((F.substring(f, 1, 1) == F.lit(b"w")) & (F.length(f) >= 25))
    return rows.select("slot", "seq", number(f, 2, 8).alias("wal_start"), number(f, 10, 8).alias("wal_end"), number(f, 18, 8).alias("server_time"), F.expr("substring(frame, 26)").alias("data"))


def keepalives(frames: DataFrame) -> DataFrame:
    f = F.col("frame")
    rows = frames.where((F.substring(f, 1, 1) == F.lit(b"k")) & (F.length(f) >= 18))
    return rows.select("slot", "seq", number(f, 2, 8).alias("wal_end"), number(f, 10, 8).alias("server_time"), (F.substring(f, 18, 1) != F.lit(b"\0")).alias("reply_wanted"))


def malformed(frames: DataFrame) -> DataFrame:
    f, kind = F.col("frame"), F.substring("frame", 1, 1)
    reason = F.when((kind == F.lit(b"w")) & (F.length(f) < 25), "short data frame").when((kind == F.lit(b"k")) & (F.length(f) < 18), "short keepalive")
    reason = reason.when((F.length(f) > 0) & ~kind.isin([F.lit(b"w"), F.lit(b"k")]), "unknown frame")
    return frames.select("slot", "seq", reason.alias("reason")).where("reason is not null")
