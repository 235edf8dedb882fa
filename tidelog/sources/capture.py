"""Captured frames in Parquet: a native batch scan, and the Python data source `tidelog` for streams (and batches).

Options: path (folder of bronze Parquet files, any URI pyarrow opens), slot (one slot of it), startLsn (HI/LO, frames
from there on), maxFrames (sequence numbers of a micro-batch), progress (a folder where the reader notes how far it has
planned), stopAt (HI/LO: the last batch ends with the first commit whose end is at or past it; what follows stays unread,
for a query started later without it), framesPerSecond, bytesPerSecond, burst (seconds that may be saved up). Offsets are
sequence numbers of the slot and only grow. A reader that starts anew does not know where its query stood: it reads on from
what the progress folder says or, without one, offers all there is, which is never behind.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from itertools import takewhile
from typing import NamedTuple

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pf
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from tidelog.errors import LogError
from tidelog.functions import lsn as L
from tidelog.sources.commands import lsn_number

SCHEMA = "slot string, seq long, wal_start long, wal_end long, server_time long, data binary"
NAMES = ("slot", "seq", "wal_start", "wal_end", "server_time", "data")
#: Frames of a task, and of a micro-batch unless maxFrames says otherwise.
PIECE = 250_000


def frames(spark: SparkSession, path: str, slot: str | None = None, start_lsn: str | None = None) -> DataFrame:
    """The frames of a folder as a plain Parquet scan: slot and position are pushed down to it."""
    rows = spark.read.schema(SCHEMA).parquet(path)
    rows = rows.where(F.col("slot") == slot) if slot else rows
    return rows.where(L.at_or_past(F.col("wal_start"), lsn_number(start_lsn))) if start_lsn else rows


def opened(path: str) -> tuple[pf.FileSystem, str]:
    return pf.FileSystem.from_uri(path) if "://" in path else (pf.LocalFileSystem(), path)


class Groups(InputPartition):
    """Row groups of one file, and the sequence numbers wanted of them."""

    def __init__(self, path: str, groups: tuple[int, ...], start: int, end: int):
        super().__init__((path, groups, start, end))
        self.path, self.groups, self.start, self.end = path, groups, start, end


class CaptureSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tidelog"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> Reader:
        return Reader(dict(self.options))

    def streamReader(self, schema) -> StreamReader:
        return StreamReader(dict(self.options))


class Group(NamedTuple):
    """A row group: its number in the file, first and last seq of the slot, rows, bytes, and the highest position of its frames."""

    number: int
    low: int
    high: int
    rows: int
    size: int
    reach: int


#: Where the end position stands in the payload of each kind of commit. Fixed values.
_ENDS = {ord("C"): 10, ord("K"): 10, ord("c"): 14}


def _reach(ends: tuple[int, int] | None) -> int:
    """The highest position that longs from a lowest to a highest can hold."""
    if ends is None or (ends[0] < 0 <= ends[1]):
        return L.MASK
    return L.position(ends[1])


def _at_or_past(name: str, target: int) -> pc.Expression:
    field = pc.field(name)
    return (field >= target) | (field < 0) if target < L.BIAS else (field >= L.bits(target)) & (field < 0)


def _commit_end(data: bytes | None) -> int:
    """The end of the commit that a payload is, -1 for other payloads."""
    at = _ENDS.get(data[0]) if data else None
    return int.from_bytes(data[at : at + 8], "big") if at and len(data) >= at + 8 else -1


class _Files:
    def __init__(self, options: dict[str, str]):
        if "path" not in options:
            raise LogError("config", "option path is missing")
        self.path = options["path"]
        self.slot = options.get("slot")
        self.start_lsn = lsn_number(options["startlsn"]) if options.get("startlsn") else 0
        self.progress = options.get("progress")
        self.most = int(options.get("maxframes", PIECE))
        if self.most < 1:
            raise LogError("config", "maxFrames is below 1")
        self.seen: set[str] = set()
        self.live: list[tuple[str, Group]] = []

    def look(self, told: int = 0) -> list[tuple[str, Group]]:
        """Row groups that hold the slot and are not behind what was committed, by their first number; every file's footer is read once.

        Row groups without statistics are read for their numbers. A file that comes later must lie behind what was told.
        """
        system, path = opened(self.path)
        for info in system.get_file_info(pf.FileSelector(path, recursive=True)):
            name = info.base_name
            if info.type != pf.FileType.File or name.startswith(("_", ".")) or info.path in self.seen:
                continue
            found = self._groups(system, info.path)
            if any(g.low < told for g in found):
                raise LogError("protocol", f"{info.path} holds frames before {told}, which were read already")
            self.seen.add(info.path)
            self.live += [(info.path, g) for g in found]
        self.live.sort(key=lambda x: (x[1].low, x[0], x[1].number))
        return self.live

    def _groups(self, system: pf.FileSystem, path: str) -> list[Group]:
        with system.open_input_file(path) as f:
            file = pq.ParquetFile(f)
            out = []
            for k in range(file.metadata.num_row_groups):
                group = file.metadata.row_group(k)
                stats = {c.path_in_schema: c.statistics for c in map(group.column, range(group.num_columns))}
                ends = {n: (x.min, x.max) for n, x in stats.items() if x is not None and x.has_min_max}
                if not group.num_rows or "seq" not in stats:
                    continue
                one_slot = ends.get("slot", (None, ""))
                if self.slot and one_slot[0] == one_slot[1] != self.slot:
                    continue
                if "seq" not in ends or (self.slot and one_slot[0] != one_slot[1]):
                    rows = file.read_row_group(k, columns=["slot", "seq"])
                    rows = rows.filter(pc.field("slot") == self.slot) if self.slot else rows
                    low_high = pc.min_max(rows.column("seq")).as_py()
                    ends["seq"] = (low_high["min"], low_high["max"])
                if ends["seq"][0] is not None:
                    reach = max(_reach(ends.get(n)) for n in ("wal_start", "wal_end"))
                    out.append(Group(k, *ends["seq"], group.num_rows, group.total_byte_size, reach))
        return out

    def commit_at(self, target: int, start: int, end: int) -> int | None:
        """The number of the first commit from start to before end whose end is at or past the target.

        Only row groups that reach the target are read, those with the lowest numbers first: a frame's positions are never
        below the end of the commit that it holds. So the log in front of the target is not looked at.
        """
        system, _ = opened(self.path)
        found: int | None = None
        for path, g in self.look():
            if g.reach < target or g.high < start or g.low >= end or (found is not None and g.low > found):
                continue
            with system.open_input_file(path) as f:
                for batch in pq.ParquetFile(f).iter_batches(row_groups=[g.number], columns=["slot", "seq", "wal_start", "wal_end", "data"]):
                    kept = pa.table(batch).filter(self._wanted(start, end) & (_at_or_past("wal_start", target) | _at_or_past("wal_end", target)))
                    for seq, data in zip(kept.column("seq").to_pylist(), kept.column("data").to_pylist(), strict=True):
                        if (found is None or seq < found) and _commit_end(data) >= target:
                            found = seq
        return found

    def _wanted(self, start: int, end: int) -> pc.Expression:
        keep = (pc.field("seq") >= start) & (pc.field("seq") < end)
        return keep & (pc.field("slot") == self.slot) if self.slot else keep

    def plan(self, start: int, end: int) -> list[Groups]:
        """Row groups that hold numbers from start to before end, about PIECE frames a partition."""
        out: list[Groups] = []
        held: tuple[str, list[int], int] = ("", [], 0)

        def close() -> None:
            if held[1]:
                out.append(Groups(held[0], tuple(held[1]), start, end))

        wanted = [(path, g) for path, g in takewhile(lambda x: x[1].low < end, self.look()) if g.high >= start]
        for path, g in sorted(wanted, key=lambda x: (x[0], x[1].number)):
            if held[0] != path or held[2] + g.rows > PIECE:
                close()
                held = (path, [], 0)
            held[1].append(g.number)
            held = (path, held[1], held[2] + g.rows)
        close()
        return out or [Groups("", (), start, end)]

    def read(self, part: Groups) -> Iterator[pa.RecordBatch]:
        if not part.groups:
            return
        system, _ = opened(self.path)
        keep = self._wanted(part.start, part.end) & _at_or_past("wal_start", self.start_lsn)
        with system.open_input_file(part.path) as f:
            file = pq.ParquetFile(f)
            for batch in file.iter_batches(row_groups=list(part.groups), columns=list(NAMES)):
                kept = pa.table(batch).select(list(NAMES)).filter(keep)
                yield from kept.to_batches()


class Reader(_Files, DataSourceReader):
    def partitions(self) -> list[Groups]:
        return self.plan(0, 1 << 63 - 1)


class Bucket:
    """A token bucket: so many a second flow in, at most burst seconds of them are held, and it begins full."""

    def __init__(self, rate: float, burst: float, clock: Callable[[], float] = time.monotonic):
        self.rate, self.most, self.clock = rate, rate * burst, clock
        self.tokens, self.at = self.most, clock()

    def level(self) -> float:
        now = self.clock()
        self.tokens, self.at = min(self.most, self.tokens + (now - self.at) * self.rate), now
        return self.tokens

    def take(self, n: float) -> None:
        """What is taken beyond the level is a debt, paid before anything else is let through."""
        self.tokens = self.level() - n


class StreamReader(_Files, DataSourceStreamReader):
    """Every batch is a run of sequence numbers; files that arrive later lie behind the ones before."""

    def __init__(self, options: dict[str, str], clock: Callable[[], float] = time.monotonic):
        super().__init__(options)
        self.told: int | None = None
        self.target = lsn_number(options["stopat"]) if options.get("stopat") else None
        self.cut: int | None = None
        burst = float(options.get("burst", 1))
        rates = {n: float(options[n + "persecond"]) for n in ("frames", "bytes") if n + "persecond" in options}
        if burst <= 0 or any(r <= 0 for r in rates.values()):
            raise LogError("config", "framesPerSecond, bytesPerSecond and burst are above 0")
        self.buckets = {n: Bucket(r, burst, clock) for n, r in rates.items()}

    def initialOffset(self) -> dict:
        return {"seq": 0}

    def latestOffset(self) -> dict:
        """The end of the next batch: at most maxFrames on from the last one, as the rates allow, and never before it."""
        known = self.look(self.told or 0)
        high = max((g.high + 1 for _, g in known), default=self.told or 0)
        if self.told is None:
            noted = self._noted()
            first = min((g.low for _, g in known), default=0)
            self.told = self._bounded(0, high) if self.progress is None else max(noted, first)
        end = self._bounded(self.told, max(self.told, min(high, self.told + self.most)))
        self.told = self._admitted(self.told, end)
        self._note()
        return {"seq": self.told}

    def _bounded(self, start: int, end: int) -> int:
        """end, or the place behind the commit that reaches the target, if it lies before it."""
        if self.target is not None and self.cut is None and end > start:
            found = self.commit_at(self.target, 0, end)
            self.cut = None if found is None else found + 1
        return end if self.cut is None else max(start, min(end, self.cut))

    def _admitted(self, start: int, end: int) -> int:
        """As many numbers as the buckets let through now; frames and bytes of a row group are taken to be spread evenly."""
        levels = {n: b.level() for n, b in self.buckets.items()}
        if not levels or end <= start:
            return end
        if min(levels.values()) <= 0:
            return start
        frames = size = 0.0
        at = start
        for g in (g for _, g in self.look() if g.high >= start and g.low < end):
            span = g.high - g.low + 1
            low, high = max(g.low, start, at), min(g.high + 1, end)
            share = min([1.0, *[max(levels[n] - had, 0) / max(per, 1e-9) for n, had, per in (("frames", frames, g.rows * (high - low) / span), ("bytes", size, g.size * (high - low) / span)) if n in levels]])
            upto = low + max(int((high - low) * share), 0)
            frames, size, at = frames + g.rows * (upto - low) / span, size + g.size * (upto - low) / span, max(at, upto)
            if share < 1:
                break
        else:
            at = end
        for n, used in (("frames", frames), ("bytes", size)):
            if n in self.buckets:
                self.buckets[n].take(used)
        return at

    def partitions(self, start: dict, end: dict) -> list[Groups]:
        self.told = max(self.told or 0, end["seq"])
        return self.plan(start["seq"], end["seq"])

    def _noted(self) -> int:
        """How far a reader before this one has planned: what it told Spark was noted first, so no offset is beyond it."""
        if self.progress is None:
            return 0
        system, path = opened(self.progress)
        if system.get_file_info(path).type == pf.FileType.NotFound:
            return 0
        names = [i.base_name for i in system.get_file_info(pf.FileSelector(path)) if i.type == pf.FileType.File]
        return max((int(n) for n in names if n.isdigit()), default=0)

    def _note(self) -> None:
        if self.progress is None:
            return
        system, path = opened(self.progress)
        system.create_dir(path, recursive=True)
        with system.open_output_stream(f"{path}/{self.told:020d}"):
            pass
        old = [i.path for i in system.get_file_info(pf.FileSelector(path)) if i.base_name.isdigit() and int(i.base_name) < self.told]
        for name in old:
            system.delete_file(name)

    def commit(self, end: dict) -> None:
        """What lies before the end is not looked at again, so that planning goes through what is left to read."""
        self.live = [(f, g) for f, g in self.live if g.high >= end["seq"]]


def register(spark: SparkSession) -> None:
    spark.dataSource.register(CaptureSource)
