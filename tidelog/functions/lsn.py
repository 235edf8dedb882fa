"""Log positions and server times as Column expressions.

A position has 64 bits without a sign and is held as the long of the same bits, so one of 2**63 and more is a negative
number. Arithmetic signs do not order such longs; ordered() does, and whatever compares positions goes through it or
through at_or_past(), which scans can push down.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidelog.sources.wire import EPOCH_MICROS

#: First and last instant a timestamp column can hold here, in microseconds since 1970.
EARLIEST, LATEST = -62_135_596_800_000_000, 253_402_300_799_999_999
#: What positions are turned by, so that they order as longs: the highest bit.
BIAS = 1 << 63
MASK = (1 << 64) - 1


def bits(position: int) -> int:
    """The long that holds a position; of a long, itself."""
    return ((position + BIAS) & MASK) - BIAS


def position(lsn: int) -> int:
    """The position that a long holds; of a position, itself."""
    return lsn & MASK


def ordered(lsn: Column) -> Column:
    """A long that orders as the position does; of that long, the position again."""
    return lsn.bitwiseXOR(F.lit(-BIAS))


def highest(lsn: Column) -> Column:
    """Aggregate: the highest position."""
    return ordered(F.max(ordered(lsn)))


def at_or_past(lsn: Column, target: int) -> Column:
    """Whether a position is target or behind it, by comparisons with constants only."""
    if target < BIAS:
        return (lsn >= F.lit(target)) | (lsn < F.lit(0))
    return (lsn >= F.lit(bits(target))) & (lsn < F.lit(0))


def parse_lsn(text: Column) -> Column:
    """HI/LO in hexadecimal as the long of its bits; null for anything else."""
    hi, lo = F.regexp_extract(text, "^([0-9A-Fa-f]+)/", 1), F.regexp_extract(text, "/([0-9A-Fa-f]+)$", 1)
    fits = text.rlike("^0*[0-9A-Fa-f]{1,8}/0*[0-9A-Fa-f]{1,8}$")
    number = lambda c: F.conv(c, 16, 10).cast("long")
    return F.when(fits, F.shiftleft(number(hi), 32).bitwiseOR(number(lo)))


def format_lsn(lsn: Column) -> Column:
    """A long as upper-case HI/LO without padding."""
    return F.concat(F.hex(F.shiftrightunsigned(lsn, 32)), F.lit("/"), F.hex(lsn.bitwiseAND(F.lit((1 << 32) - 1))))


def server_time(micros: Column) -> Column:
    """Microseconds since 2000 as a timestamp, held inside what a timestamp can say."""
    known = F.least(F.greatest(micros, F.lit(EARLIEST - EPOCH_MICROS)), F.lit(LATEST - EPOCH_MICROS))
    return F.when(micros.isNotNull(), F.timestamp_micros(known + F.lit(EPOCH_MICROS)))


def server_micros(ts: Column) -> Column:
    """A timestamp as microseconds since 2000; before 1970 there is none."""
    micros = F.unix_micros(ts)
    return F.when(micros >= 0, micros - F.lit(EPOCH_MICROS))


def capped(lsn: Column, received: Column) -> Column:
    """A position never beyond what was received; 0 stays 0."""
    return F.when(lsn != 0, ordered(F.least(ordered(lsn), ordered(received)))).otherwise(lsn)


def unsigned(lsn: Column) -> Column:
    """A position of any 64 bits as decimal(20,0): positions of 2**63 and more, negative as longs, come out positive and in order."""
    wide = lsn.cast("decimal(20,0)")
    return F.when(lsn < 0, wide + F.lit(Decimal(1 << 64))).otherwise(wide).cast("decimal(20,0)")


def from_unsigned(value: Column) -> Column:
    """The long of the same 64 bits; null beyond them."""
    high = F.lit(Decimal(1 << 63))
    low = F.when((value >= 0) & (value < high), value.cast("long"))
    return F.when((value >= high) & (value < F.lit(Decimal(1 << 64))), (value - F.lit(Decimal(1 << 64))).cast("long")).otherwise(low)
