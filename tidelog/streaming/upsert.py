"""A table that follows a change stream: state in buckets of keys, of which a batch reads and writes only those it touches.

A version of the table is a manifest, a list that says for each bucket which batch wrote it last. A batch writes its
buckets beside the old ones and then its manifest, so that readers see all of a batch or nothing of it, and a batch that
was cut off leaves no trace. Batches are whole transactions in commit order, as Replay hands them to a handler.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.operators import state
from tidelog.operators.carry import broadcast_if_few
from tidelog.sources.scratch import materialise

VALUES = "array<struct<name:string,kind:string,value:binary>>"
SCHEMA = f"slot string, schema string, `table` string, key array<binary>, row {VALUES}, commit_seq long, primary_key array<string>, replica_identity string"
#: What net_state() reads of a change.
CHANGE = f"slot string, schema string, `table` string, tag string, key_type string, old_row {VALUES}, new_row {VALUES}, commit_seq long, seq long, primary_key array<string>, replica_identity string, column_names array<string>, truncate_tables array<string>"
#: Tables whose description is broadcast.
FEW_TABLES = 1_000_000
MANIFEST = "bucket int, batch long"


class UpsertSink:
    """buckets is fixed when the folder is new: more buckets mean that a batch of few keys rewrites less."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int = 64):
        self.spark, self.folder, self.buckets = spark, folder.rstrip("/"), buckets

    def __call__(self, changes: DataFrame, batch: int) -> None:
        """Handler of a Replay. A batch that is in already is passed over."""
        if self._there(f"{self._manifest(batch)}/_SUCCESS"):
            return
        versions = self.versions()
        if any(v > batch for v in versions):
            raise ValueError(f"batch {batch} is older than what the table holds")
        before = {r["bucket"]: r["batch"] for r in self.spark.read.schema(MANIFEST).parquet(self._manifest(versions[-1])).collect()} if versions else {}
        changes = materialise(changes.where("tag in ('I', 'U', 'D', 'T')").select(*[F.col(f.name) for f in _fields(CHANGE)]), "upserts")
        touched = self._touched(changes, before)
        if touched:
            held = {b: v for b, v in before.items() if b in touched}
            rows = self._applied(changes, self._read(held))
            rows.repartition("bucket").sortWithinPartitions("table", "key").write.mode("overwrite").partitionBy("bucket").parquet(self._data(batch))
            written = {r[0] for r in self.spark.read.schema(f"{SCHEMA}, bucket int").parquet(self._data(batch)).select("bucket").distinct().collect()}
            before = {b: v for b, v in before.items() if b not in touched} | dict.fromkeys(written, batch)
        listed = self.spark.createDataFrame(sorted(before.items()), MANIFEST)
        listed.coalesce(1).write.mode("overwrite").parquet(self._manifest(batch))

    def table(self, batch: int | None = None) -> DataFrame:
        """slot, schema, table, key, row, commit_seq of all rows, as of a batch (the last one)."""
        versions = [v for v in self.versions() if batch is None or v <= batch]
        listed = self.spark.read.schema(MANIFEST).parquet(self._manifest(versions[-1])).collect() if versions else []
        return self._read({r["bucket"]: r["batch"] for r in listed}).drop("primary_key", "replica_identity", "bucket")

    def versions(self) -> list[int]:
        """Batches whose manifest is whole, in order."""
        top = self._path(f"{self.folder}/manifest")
        fs = top.getFileSystem(self.spark._jsc.hadoopConfiguration())
        found = [s.getPath() for s in fs.listStatus(top)] if fs.exists(top) else []
        return sorted(int(p.getName().split("=")[1]) for p in found if "=" in p.getName() and fs.exists(self._path(f"{p}/_SUCCESS")))

    def vacuum(self, keep: int = 1) -> None:
        """Drops what only versions before the last so many need."""
        versions = self.versions()
        kept = versions[-keep:]
        needed = {r["batch"] for v in kept for r in self.spark.read.schema(MANIFEST).parquet(self._manifest(v)).select("batch").distinct().collect()}
        for name, stay in (("manifest", set(kept)), ("data", needed)):
            for v in versions:
                path = self._path(f"{self.folder}/{name}/batch={v}")
                if v not in stay:
                    path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def _manifest(self, batch: int) -> str:
        return f"{self.folder}/manifest/batch={batch}"

    def _data(self, batch: int) -> str:
        return f"{self.folder}/data/batch={batch}"

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(name)

    def _there(self, name: str) -> bool:
        path = self._path(name)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def _read(self, held: dict[int, int]) -> DataFrame:
        """The rows of buckets as their batches wrote them."""
        parts = [
            self.spark.read.schema(f"{SCHEMA}, bucket int").parquet(self._data(batch)).where(F.col("bucket").isin(*[b for b, v in held.items() if v == batch]))
            for batch in sorted(set(held.values()))
        ]
        return reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], f"{SCHEMA}, bucket int")

    def _bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64("slot", "schema", "table", key), F.lit(self.buckets)).cast("int")

    def _touched(self, changes: DataFrame, before: dict[int, int]) -> set[int]:
        """Buckets of the keys that changes name, old keys too; a truncate touches all there are."""
        rows = changes.where("tag != 'T'")
        values = lambda row: F.transform(row, lambda c: c["value"])
        whole = state.whole_changes(rows.where(state.by_value()))
        sides = F.array_compact(F.array(F.when(F.col("tag") != "I", values("old_row")), F.when(F.col("tag") != "D", values("new_row"))))
        keys = whole.select(*state.TABLE, F.explode(sides).alias("key")).unionByName(state.keyed(rows.where(~state.by_value())).select(*state.BY))
        found = {r[0] for r in keys.select(self._bucket(F.col("key")).alias("bucket")).distinct().collect()}
        return found | (set(before) if not changes.where("tag = 'T'").isEmpty() else set())

    def _applied(self, changes: DataFrame, held: DataFrame) -> DataFrame:
        """The rows of the touched buckets after the batch: what they held counts as inserts before it."""
        none = lambda kind: F.lit(None).cast(kind)
        old = held.select(
            "slot", "schema", "table", F.lit("I").alias("tag"), none("string").alias("key_type"), none(VALUES).alias("old_row"), F.col("row").alias("new_row"), "commit_seq",
            F.lit(-1).cast("long").alias("seq"), "primary_key", "replica_identity", F.transform("row", lambda c: c["name"]).alias("column_names"), none("array<string>").alias("truncate_tables"),
        )
        both = materialise(old.unionByName(changes), "merged")
        about = both.where("tag != 'T'").groupBy(*state.TABLE).agg(F.max_by(F.struct("primary_key", "replica_identity"), F.struct("commit_seq", "seq")).alias("_about"))
        about = broadcast_if_few(materialise(about, "about"), F.lit(1), FEW_TABLES)
        rows = state.net_state(both).join(about, state.TABLE).select(*state.BY, "row", "commit_seq", "_about.*")
        return rows.withColumn("bucket", self._bucket(F.col("key")))


def _fields(ddl: str):
    from pyspark.sql.types import StructType

    return StructType.fromDDL(ddl).fields
