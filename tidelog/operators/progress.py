"""Progress along a log: received and applied positions."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions import lsn as L
from tidelog.operators import carry
from tidelog.sources import wire


def running(log: DataFrame) -> DataFrame:
    """Adds received (highest position so far) and applied (highest end of a commit so far, 0 before one).

    Both only grow. No task orders more than a bucket of rows, a stretch of buckets, or the stretches of a slot.
    """
    done = F.when(F.col("tag").isin("C", "c", "K"), F.col("end_lsn"))
    rows = carry.running(log, {"received": ("max", L.ordered(F.col("lsn"))), "applied": ("max", L.ordered(done))})
    return rows.withColumns({"received": L.ordered(F.col("received")), "applied": F.coalesce(L.ordered(F.col("applied")), F.lit(0).cast("long"))})


class Tracker:
    """Flushed and applied positions of a consumer: they only grow, 0 is no position, applied lifts flushed. Numbers have no sign."""

    def __init__(self):
        self.flushed = self.applied = self.received = 0

    def flush(self, lsn: int) -> None:
        self.flushed = max(self.flushed, lsn)

    def apply(self, lsn: int) -> None:
        self.applied = max(self.applied, lsn)
        self.flush(lsn)

    def receive(self, lsn: int) -> None:
        self.received = max(self.received, lsn)

    def feedback(self) -> tuple[int, int]:
        """(flushed, applied), neither beyond what was received; 0 stays 0."""
        return min(self.flushed, self.received), min(self.applied, self.received)


class Feedback:
    """What a consumer tells the server: a status message when the interval has passed and something changed, or when asked.

    Nothing is sent before something was received. Keepalives count as received and may ask for a reply. The end of the
    copy is said once, after a last status.
    """

    def __init__(self, tracker: Tracker, interval: float = 10.0, clock: Callable[[], float] = time.monotonic, now: Callable[[], int] = lambda: 0):
        self.tracker, self.interval, self.clock, self.now = tracker, interval, clock, now
        self.last: tuple[int, int, int] | None = None
        self.at, self.ended = float("-inf"), False

    def _state(self) -> tuple[int, int, int]:
        return (self.tracker.received, *self.tracker.feedback())

    def due(self) -> bool:
        return self.clock() - self.at >= self.interval and self._state() != self.last

    def status(self, force: bool = False) -> bytes | None:
        """The bytes of a status message if one is due, else None."""
        if not self.tracker.received or not (force or self.due()):
            return None
        self.last, self.at = self._state(), self.clock()
        return wire.standby_status(*self.last, self.now())

    def keepalive(self, frame: bytes) -> bytes | None:
        """Takes in a keepalive; the status it asks for, if it does."""
        end, _, wanted = wire.keepalive(frame)
        self.tracker.receive(end)
        return self.status(force=wanted)

    def end(self) -> list[bytes]:
        """A last status and the end of the copy, the first time; nothing after."""
        if self.ended:
            return []
        self.ended = True
        last = self.status(force=True)
        return [*([last] if last else []), wire.copy_done()]
