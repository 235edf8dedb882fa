"""Driving a replay: one event at a time, handlers, stops and health, over a running streaming query."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Iterator

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, Row

from tidelog.errors import LogError
from tidelog.functions.lsn import position
from tidelog.operators.frontier import Frontier
from tidelog.operators.progress import Feedback, Tracker
from tidelog.sources.commands import lsn_text
from tidelog.sources.options import with_retry
from tidelog.streaming.replay import Replay


class Consumer:
    """Runs a replay of one slot and acknowledges what was handled, never beyond a transaction that was not.

    A batch's transactions count as applied when the handler comes back; with by_hand=True the handler's user says so
    for each, in any order, by done(). What is acknowledged is the end of the unbroken run of applied commits.

    stop() ends after the batch that runs. target (a position) ends the stream with the first commit whose end is at or
    past it: the source plans no frame behind that commit, so a later start without a target reads on right there. A
    handler's error ends the query, and start() goes on from the batch that failed; keep_running() does so by itself.
    """

    def __init__(self, replay: Replay, feedback: Feedback | None = None, target: int | None = None, by_hand: bool = False):
        self.replay, self.tracker, self.target, self.by_hand = replay, feedback.tracker if feedback else Tracker(), target, by_hand
        self.feedback, self.frontier = feedback or Feedback(self.tracker), Frontier()
        self.sent: list[bytes] = []
        self.query, self.reached, self._user, self._lock = None, threading.Event(), replay.handler, threading.Lock()
        self.failure: Exception | None = None
        replay.handler = self._handle

    def _handle(self, changes: DataFrame, number: int) -> None:
        ends = [position(r[0]) for r in self.replay.ends(number).collect()]
        with self._lock:
            for end in ends:
                self.tracker.receive(end)
                self.frontier.expect(end)
        if self._user:
            try:
                self._user(changes, number)
            except Exception as e:
                self.failure = e
                raise
        if not self.by_hand:
            self.done(*ends)
        if self.target is not None and ends and ends[-1] >= self.target:
            self.reached.set()

    def done(self, *ends: int) -> int:
        """Transactions that end there are applied; acknowledges and gives the position up to which all are."""
        with self._lock:
            for end in ends:
                self.frontier.apply(end)
            if self.frontier.safe:
                self.tracker.apply(self.frontier.safe)
            if status := self.feedback.status():
                self.sent.append(status)
            return self.frontier.safe

    def start(self, path: str, checkpoint: str, **options: str) -> Consumer:
        bounds = {} if self.target is None else {"stopAt": lsn_text(self.target)}
        self.query = self.replay.start(path, checkpoint, **(bounds | options))
        return self

    def run(self, path: str, checkpoint: str, **options: str) -> None:
        """Handles all there is, or all up to the target, and returns; a handler's error is raised after the stream was stopped."""
        self.start(path, checkpoint, **options)
        try:
            self.query.processAllAvailable()
        finally:
            self.stop()

    def keep_running(self, path: str, checkpoint: str, attempts: int = 5, sleep: Callable[[float], None] = time.sleep, **options: str) -> None:
        """run(), with the query started again where it failed after errors of a kind that is retried, so often and ever later.

        A handler tells the kind by a LogError; any other error of a handler ends it. What the stream itself fails with,
        as when the folder can't be read for a while, is retried.
        """

        def once() -> None:
            self.failure = None
            self.start(path, checkpoint, **options)
            try:
                self.query.processAllAvailable()
            except StreamingQueryException as e:
                self.query.stop()
                raise (self.failure or LogError("io", str(e))) from e

        try:
            with_retry(once, sleep, attempts)
        finally:
            self.stop()

    def stop(self) -> None:
        """Stops the query, sends the last status and the end of the copy."""
        if self.query is not None:
            self.query.stop()
        self.sent += self.feedback.end()

    def healthy(self) -> bool:
        """True while the query runs and has not failed."""
        return self.query is not None and self.query.isActive and self.query.exception() is None

    def events(self) -> Iterator[Row]:
        """Committed changes one by one in commit order, batch by batch: for inspection, not for volume."""
        done = [r["batch"] for r in self.replay.spark.read.schema("batch long").parquet(f"{self.replay.folder}/done").distinct().orderBy("batch").collect()]
        for number in done:
            rows = self.replay.spark.read.parquet(self.replay._path("changes", number))
            yield from rows.orderBy("commit_seq", "seq").toLocalIterator()


class Poll:
    """The events of an iterator as a poll gives them: None at the end and after a stop, a permanent error once and then None, others each time they come."""

    def __init__(self, source: Iterator):
        self.source, self.over = source, False

    def next(self):
        if self.over:
            return None
        try:
            return next(self.source)
        except StopIteration:
            self.over = True
            return None
        except LogError as e:
            if e.error_class in ("cancelled", "stopped"):
                self.over = True
                return None
            self.over = e.error_class == "permanent"
            raise
