"""Structured Streaming over captured frames: the same silver and gold as the batch path.

A micro-batch's context (the open stream block, the relations sent so far, transactions not yet decided) is a function
of the log, not of a process: each batch decides over its frames and over those an earlier batch left undecided. So a
restart, a lost executor or a replayed batch give the same tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidelog.operators import events as E
from tidelog.operators import txn
from tidelog.operators.decode import decode
from tidelog.sources import capture
from tidelog.sources.scratch import materialise


class Replay:
    """Writes committed changes of a frame stream, transaction by transaction, to gold under a folder.

    carry holds the frames later batches still need: those of undecided transactions, and of each relation the versions
    that hold from the oldest of these on. A batch writes its changes, then calls the handler, then notes that it is done: a batch that fails or is stopped
    before the note is run again with the same rows, and one that is noted is not handled twice.
    """

    def __init__(self, spark: SparkSession, folder: str, version: int = 1, handler: Callable[[DataFrame, int], None] | None = None):
        self.spark, self.folder, self.version, self.handler = spark, folder.rstrip("/"), version, handler

    def _path(self, name: str, batch: int) -> str:
        return f"{self.folder}/{name}/batch={batch}"

    def _there(self, path: str) -> bool:
        fs = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return fs.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(fs)

    def _carried(self, batch: int) -> DataFrame | None:
        """Frames carried out of the batch before; a batch that is replayed reads the same ones again."""
        path = self._path("carry", batch - 1)
        return self.spark.read.schema(capture.SCHEMA).parquet(path) if self._there(path) else None

    def batch(self, frames: DataFrame, number: int) -> None:
        """foreachBatch function: idempotent by batch number."""
        done = self._path("done", number)
        if self._there(done):
            return
        frames = frames.select(*capture.NAMES)
        carried = self._carried(number)
        frames = materialise(frames.unionByName(carried) if carried is not None else frames, "frames")
        messages = materialise(decode(frames, self.version), "messages")
        log = materialise(E.events(messages, txn.assign(messages)), "events")
        decided = txn.outcomes(log)
        final = decided.where("status != 'prepared'")
        changes = txn.committed(log, final).drop("_bucket")
        changes.write.mode("overwrite").parquet(self._path("changes", number))
        still = log.where("txn_id is not null").join(final.select(*txn.KEY), txn.KEY, "left_anti").select("slot", "seq")
        at = ["slot", "seq"]
        frames = frames.withColumn("slot", F.coalesce("slot", F.lit("")))
        needed = materialise(still.unionByName(self._versions(messages, still)).distinct(), "still")
        frames.join(needed, at, "left_semi").write.mode("overwrite").parquet(self._path("carry", number))
        ends = final.where("status = 'committed'").select("slot", "commit_seq", "end_lsn")
        ends.write.mode("overwrite").parquet(self._path("commits", number))
        if self.handler:
            self.handler(self.spark.read.schema(changes.schema).parquet(self._path("changes", number)), number)
        self.spark.createDataFrame([(number,)], "batch long").write.mode("overwrite").parquet(done)

    @staticmethod
    def _versions(messages: DataFrame, still: DataFrame) -> DataFrame:
        """(slot, seq) of the relation messages that hold at the oldest undecided change, or at the end of the batch, or come later."""
        sent = messages.where("tag = 'R' and error is null").select("slot", "oid", "seq")
        oldest = still.groupBy("slot").agg(F.min("seq").alias("_from"))
        marked = sent.join(oldest, "slot", "left").withColumn("_early", F.col("_from").isNull() | (F.col("seq") <= F.col("_from")))
        last = marked.where("_early").groupBy("slot", "oid").agg(F.max("seq").alias("seq")).select("slot", "seq")
        return last.unionByName(marked.where("not _early").select("slot", "seq"))

    def ends(self, batch: int) -> DataFrame:
        """(end_lsn) of the transactions that committed in a batch, in their order."""
        return self.spark.read.schema("slot string, commit_seq long, end_lsn long").parquet(self._path("commits", batch)).orderBy("commit_seq").select("end_lsn")

    def start(self, path: str, checkpoint: str, **options: str) -> StreamingQuery:
        """Runs until stopped; started again with the same folders it reads on where it was."""
        capture.register(self.spark)
        options = {"progress": f"{self.folder}/progress"} | options
        frames = self.spark.readStream.format("tidelog").option("path", path).options(**options).load()
        return frames.writeStream.foreachBatch(self.batch).option("checkpointLocation", checkpoint).start()

    def changes(self) -> DataFrame:
        """All committed changes of batches that are done."""
        done = self.spark.read.schema("batch long").parquet(f"{self.folder}/done").select("batch").distinct()
        return self.spark.read.parquet(f"{self.folder}/changes").join(F.broadcast(done), "batch", "left_semi").drop("batch")
