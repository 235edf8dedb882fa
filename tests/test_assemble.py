"""Transactions on the state store: the same changes as in batch, with state that is bounded by what is open."""

from __future__ import annotations

from pyspark.sql import functions as F

from tests.oracle import assert_same
from tidelog.plans import silver
from tidelog.streaming.assemble import Assembly

SF = "/root/testdata/sf0.001"
ROWS = ("slot", "seq", "tag", "txn_id", "txn_seq", "commit_seq")


def flat(changes):
    rows = changes.where("tag in ('I', 'U', 'D')").select(*ROWS, F.to_json("new_row").alias("new"), F.to_json("old_row").alias("old"))
    return rows.toPandas()


def test_stream_on_the_state_store_equals_batch(spark, tmp_path):
    """Interleaved streams, parts that are rolled back, two-phase and ids that come round; stopped and started in between."""
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    try:
        for log, stops, most in (("parts", (40_000, 1 << 40), "40000"), ("orders", (2_720, 9_000), "2000")):
            frames, out = tmp_path / f"{log}-frames", str(tmp_path / f"{log}-out")
            low, held = -1, []
            for high in stops:
                silver.bronze(spark, SF, log).where(f"seq >= {low} and seq < {high}").coalesce(2).write.mode("append").parquet(str(frames))
                low = high
                assembly = Assembly(spark, out, 4)
                query = assembly.start(str(frames), str(tmp_path / f"{log}-checkpoint"), maxFrames=most)
                query.processAllAvailable()
                held = [sum(op.numRowsTotal for op in p.stateOperators) for p in query.recentProgress] or held
                query.stop()
                assert_same(flat(assembly.changes()), flat(silver.committed(spark, SF, log).where(f"commit_seq < {high}")))
            undecided = silver.assigned(spark, SF, log).where(f"seq < {stops[-1]} and txn_id is not null")
            total = silver.bronze(spark, SF, log).where(f"seq < {stops[-1]}").count()
            assert undecided.count() > 0 and held[-1] < total / 3, (held, total)
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
