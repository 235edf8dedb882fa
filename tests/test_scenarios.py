"""Load scenarios, and gaps and sketches of a stream."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.test_core import SF
from tidelog.operators import events as E
from tidelog.operators import metrics, state, txn
from tidelog.operators.decode import decode
from tidelog.operators.encode import encode
from tidelog.plans import silver
from tidelog.sources import changelog
from tidelog.sources.scratch import materialise
from tidelog.streaming.assemble import ROCKS

COLUMNS = ("slot", "seq", "wal_start", "wal_end", "server_time", "data")


@pytest.mark.parametrize("kind", list(changelog.SCENARIOS))
def test_scenarios_replay(spark, kind):
    n, length, batch, mixed = changelog.SCENARIOS[kind]
    bronze = materialise(encode(changelog.generated(spark, 1200, kind, whole=True), 1).select(*COLUMNS), kind)
    assert bronze.count() == bronze.select("seq").distinct().count()
    messages = materialise(decode(bronze, 1), "m")
    log = materialise(E.events(messages, txn.assign(messages)), "e")
    changes = materialise(txn.committed(log), "c")
    tags = {r["tag"]: r["n"] for r in changes.groupBy("tag").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert tags == ({"I": 1200, "U": 300, "D": 300} if mixed else {"I": 1200})
    assert log.where("tag = 'C'").count() == -(-1200 // batch) * (3 if mixed else 1)
    rows = state.net_state(changes).select("row").collect()
    assert len(rows) == (900 if mixed else 1200)
    assert {len(r["row"]) for r in rows} == {n + (1 if kind == "wide" else 2)} and {len(r["row"][1]["value"]) for r in rows} == {length}


def test_gaps_and_sketches_of_a_stream(spark, tmp_path):
    """Over batches that cut the log anywhere the windows hold the gaps of the batch, and a window is given out once, when it has passed."""
    log = silver.bronze(spark, SF).select(*COLUMNS).where("seq < 9000")
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    try:
        for low, high in ((-1, 2700), (2700, 5000), (5000, 9000)):
            log.where(f"seq >= {low} and seq < {high}").coalesce(1).write.mode("append").parquet(str(tmp_path / "frames"))
            stream = spark.readStream.schema(log.schema).parquet(str(tmp_path / "frames"))
            gaps = metrics.stream_gaps(stream)
            query = gaps.writeStream.format("parquet").option("path", str(tmp_path / "gaps")).option("checkpointLocation", str(tmp_path / "a")).trigger(availableNow=True).start()
            query.awaitTermination()
        got = spark.read.parquet(str(tmp_path / "gaps"))
        want = metrics.gaps(log)
        key = lambda rows: sorted((r["seq"], r["gap"]) for r in rows.select("seq", "gap").collect())
        assert key(got) == key(want)
        timed = spark.readStream.schema(got.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "gaps")).withWatermark("event_time", "10 minutes")
        query = metrics.sketches(timed).writeStream.format("parquet").option("path", str(tmp_path / "sketches")).option("checkpointLocation", str(tmp_path / "b")).trigger(availableNow=True).start()
        query.awaitTermination()
        shown = spark.read.parquet(str(tmp_path / "sketches"))
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    whole = {r["start"]: r["n"] for r in metrics.sketches(want).collect()}
    done = {r["start"]: r["n"] for r in shown.collect()}
    assert done == {k: n for k, n in whole.items() if k in done} and 0 <= len(whole) - len(done) <= 12
    told = metrics.quantiles(metrics.merged(shown.unionByName(metrics.sketches(want)), ["slot"]), {"p50": 0.5}).first()
    assert told["n"] == sum(whole.values()) + sum(done.values())


def test_origins_hold_for_all_parts(spark):
    from tests.test_core import BEGIN, COMMIT, PUT, REL, log

    start = lambda first: ({"tag": "S", "xid": 9, "first_segment": first}, False)
    put, stop, far = lambda k: (PUT(k, "s") | {"msg_xid": 9}, True), ({"tag": "E"}, False), lambda name: ({"tag": "O", "message_lsn": 5, "name": name}, False)
    rows = [(REL, False), start(1), put(1), stop, (BEGIN(3), False), (PUT(2, "own"), False), (COMMIT, False), start(0), far("b"), put(3), stop, (BEGIN(4), False), far("c"), (PUT(4, "far"), False), (COMMIT, False)]
    rows.append(({"tag": "c", "xid": 9, "flags": 0, "commit_lsn": 5, "end_lsn": 6, "ts": 0}, False))
    messages = materialise(decode(log(spark, rows), 4), "m")
    events = materialise(E.events(messages, txn.assign(messages)), "e")
    changes = materialise(txn.committed(events), "c")
    ids = lambda origin: sorted(int(bytes(r["new_row"][0]["value"])) for r in txn.of_origin(changes.where("tag = 'I'"), events, origin).collect())
    assert (ids("any"), ids("none"), ids("b"), ids("c"), ids("d")) == ([1, 2, 3, 4], [2], [1, 3], [4], [])
