"""How far a log is safely applied where its transactions are applied out of order.

A position may be confirmed once every transaction that commits at or before it is applied, as a server never sends again
what lies before a confirmed position. So what counts is not the highest commit applied but the end of the unbroken run
of applied ones from the start of the log.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions.lsn import highest
from tidelog.operators.carry import running, with_bucket

NEVER = (1 << 63) - 1


def _stepped(commits: DataFrame, applied: DataFrame) -> DataFrame:
    """Commits (slot, seq, end_lsn) with the first step at which each was applied, NEVER for those that were not."""
    first = applied.groupBy("slot", "seq").agg(F.min("step").alias("_step"))
    rows = commits.select("slot", "seq", "end_lsn").join(first, ["slot", "seq"], "left")
    return with_bucket(rows.withColumn("_step", F.coalesce("_step", F.lit(NEVER))))


def safe_steps(commits: DataFrame, applied: DataFrame) -> DataFrame:
    """(slot, seq, end_lsn, safe_step): the step by which a commit and all before it are applied; null if they are not.

    commits are (slot, seq, end_lsn) of the log; applied are (slot, seq, step), steps in the order in which work was done.
    Of repeated applications the first counts. The highest step so far is a running maximum, which no task has whole.
    """
    rows = running(_stepped(commits, applied), {"_safe": ("max", F.col("_step"))})
    return rows.select("slot", "seq", "end_lsn", F.nullif("_safe", F.lit(NEVER)).alias("safe_step"))


def frontier(commits: DataFrame, applied: DataFrame) -> DataFrame:
    """(slot, step, safe_lsn): the steps that moved the confirmed position, and where to. It only grows."""
    moved = safe_steps(commits, applied).where("safe_step is not null")
    return moved.groupBy("slot", F.col("safe_step").alias("step")).agg(highest(F.col("end_lsn")).alias("safe_lsn"))


def intervals(commits: DataFrame, applied: DataFrame) -> DataFrame:
    """(slot, first_seq, last_seq, n): unbroken runs of applied commits, the first of a slot only where nothing before it is open."""
    rows = running(_stepped(commits, applied), {"_open": ("sum", F.when(F.col("_step") == NEVER, 1).otherwise(0).cast("long"))})
    return rows.where(F.col("_step") != NEVER).groupBy("slot", "_open").agg(F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"), F.count(F.lit(1)).alias("n")).drop("_open")


class Frontier:
    """The same for a consumer that runs: commits are expected in the log's order and applied in any.

    Only what is open or applied beyond an open one is held. safe is 0 before anything is.
    """

    def __init__(self, safe: int = 0):
        self.safe, self._order, self._open = safe, [], {}

    def expect(self, end: int) -> None:
        """A transaction that ends there was received; what is safe already is passed over."""
        if end > self.safe and end not in self._open:
            self._open[end] = False
            heapq.heappush(self._order, end)

    def apply(self, end: int) -> int:
        """Notes it as applied and gives the safe position; one that was not expected counts as received now."""
        self.expect(end)
        if end in self._open:
            self._open[end] = True
        while self._order and self._open[self._order[0]]:
            self.safe = heapq.heappop(self._order)
            del self._open[self.safe]
        return self.safe

    def pending(self) -> list[int]:
        """Ends of transactions that were received and not applied, in order."""
        return sorted(e for e, done in self._open.items() if not done)
