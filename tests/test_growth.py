"""Work that is dealt out by rows, whatever the files of a table and however long the log."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidelog.functions import scalars as S
from tidelog.operators import carry, decode, encode, project, state, txn
from tidelog.plans import queries, silver
from tidelog.sources import changelog, partlog, wire

SF = "/root/testdata/sf0.01"


def _rows(frame) -> list[int]:
    """Rows of each partition."""
    return [r["n"] for r in frame.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]


@pytest.mark.parametrize("log,rows", [(changelog, 15_000), (partlog, 2_000)])
def test_a_log_is_made_in_tasks_by_rows(spark, monkeypatch, log, rows):
    """A table of one row group was one task, whatever its rows."""
    monkeypatch.setattr(changelog, "ROWS", rows // 10)
    made = _rows(log.messages(spark, SF))
    assert len(made) >= 8 and max(made) < sum(made) / 4


def test_changes_are_written_column_wise_as_by_the_scalar_writer():
    draw = random.Random(3)
    value = lambda k: {"kind": k, "value": None if k in "nu" and draw.random() < 0.8 else draw.randbytes(draw.randrange(9))}
    tuple_ = lambda: [value(draw.choice("ntbu")) for _ in range(draw.randrange(6))]
    rows = []
    for _ in range(2000):
        tag = draw.choice("IUDB")
        rows.append(
            {"stream_xid": draw.choice([None, 5]), "tag": tag, "oid": draw.choice([0, 2**32 - 1, 16_400]), "msg_xid": draw.randrange(2**32), "key_type": draw.choice([None, "K", "O"])}
            | {"old": tuple_() if tag == "D" or draw.random() < 0.5 else None, "new": tuple_() if tag != "D" or draw.random() < 0.2 else None, "final_lsn": 1, "ts": -3, "xid": 7}
        )
    kinds = {"stream_xid": pa.int64(), "tag": pa.string()} | {n: decode._ARROW[t] for n, t in decode.SCALARS.items()}
    kinds |= {"oids": pa.list_(pa.int64()), "columns": decode._COLUMN, "old": decode._VALUE, "new": decode._VALUE}
    batch = pa.RecordBatch.from_pylist(rows, schema=pa.schema(list(kinds.items())))
    for version in (1, 2, 4):
        for part in (batch, batch.slice(37, 500), batch.slice(0, 0)):
            want = [wire.encode(encode._message(m), version, m["stream_xid"] is not None) for m in part.to_pylist()]
            assert encode.encode_batch(part, version).to_pylist() == want


@pytest.mark.parametrize("bad", [{"oid": None}, {"oid": 1 << 32}, {"new": None}, {"new": [{"kind": "t", "value": None}]}])
def test_a_change_that_cannot_be_written_still_fails(bad):
    kinds = {"stream_xid": pa.int64(), "tag": pa.string()} | {n: decode._ARROW[t] for n, t in decode.SCALARS.items()} | {"old": decode._VALUE, "new": decode._VALUE}
    good = {"tag": "I", "oid": 1, "new": [{"kind": "t", "value": b"x"}]}
    with pytest.raises(Exception):  # noqa: B017
        encode.encode_batch(pa.RecordBatch.from_pylist([good, good | bad], schema=pa.schema(list(kinds.items()))), 1)


def test_a_long_log_is_sorted_in_more_tasks(spark, monkeypatch):
    """Tasks were as many as the session's shuffle partitions, so each sorted more with every row of the log."""
    monkeypatch.setattr(carry, "ROWS", 1000)
    log = silver.messages(spark, SF)
    assert len(_rows(carry.dealt(log))) > 2 and max(_rows(carry.dealt(log))) < log.count() / 2
    assert carry.dealt(log).rdd.getNumPartitions() == -(-log.count() // 1000)
    names = ["seq", "txn_id", "txn_seq"]
    assert sorted(txn.carried(log).select(names).collect()) == sorted(txn.assign(log).select(names).collect())


def test_an_event_is_parsed_a_few_times_only(spark):
    """Every path was looked for by a parse of its own, 16 and more of them an event."""
    plan = queries.event_json(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("get_json_object") <= 3 and plan.count("from_json") + plan.count("jsontostructs") >= 1


def test_texts_with_brackets_and_quotes_keep_them_in_json(spark):
    texts = ["[a]", "]", '"[', "[]", "null", "[null]", "", "\\]", "\n[", None]
    cells = [("[c]", "n" if t is None else "t", None if t is None else t.encode()) for t in texts]
    row = spark.createDataFrame([(cells,)], "row array<struct<name:string,kind:string,value:binary>>")
    back = project.row_from_json(project.row_json(F.col("row")))
    assert row.select(S.same_row(back, F.col("row")).alias("same")).first()["same"]


def test_control_messages_are_made_in_many_tasks(spark, monkeypatch):
    """A few bytes a batch are put into one task where tasks are told by bytes, and it then wrote all control messages."""
    monkeypatch.setattr(changelog, "ROWS", 1000)
    made = _rows(changelog.messages(spark, SF).where("tag not in ('I', 'U', 'D')"))
    assert len(made) >= 8 and max(made) < sum(made) / 2


def test_changes_are_written_by_expressions_as_by_the_scalar_writer(spark):
    """Only what is no plain change goes to Python; its bytes, and those of changes, are the scalar writer's."""
    draw = random.Random(4)
    value = lambda: (k := draw.choice("ntbu"), draw.randbytes(draw.randrange(300)) if k in "tb" else None)
    some = lambda: [value() for _ in range(draw.randrange(6))]
    rows = [(k, draw.choice([None, 5]), tag := draw.choice("IUD"), draw.choice([0, 2**32 - 1]), draw.randrange(2**32), draw.choice([None, "K", "O"]), some() if tag == "D" or draw.random() < 0.5 else None, some() if tag != "D" else None) for k in range(600)]
    rows.append((600, None, "I", 1, None, None, [("x", None)], [("t", b"an insert has no old row")]))
    cells = "array<struct<kind:string,value:binary>>"
    log = spark.createDataFrame(rows, f"seq long, stream_xid long, tag string, oid long, msg_xid long, key_type string, old {cells}, new {cells}")
    for version in (1, 4):
        got = {r["seq"]: bytes(r["data"]) for r in encode.encode(log, version).collect()}
        want = {r["seq"]: wire.encode(encode._message({n: v for n, v in r.asDict(True).items() if n != "seq"}), version, r["stream_xid"] is not None) for r in log.collect()}
        assert got == want
    assert log.where(~F.coalesce(encode._is_plain(4), F.lit(False))).count() == 1


def test_marks_are_held_as_arrays(spark):
    """Marks were Python objects, and beyond 500,000 of them, as at 60 times sf0.1, the whole log was shuffled and sorted."""
    marks = pa.table({"slot": ["a"] * 4 + ["b"], "seq": [4, 1, 3, 9, 2], "tag": ["C", "B", "S", "S", "b"], "xid": [None, 7, 8, 8, 5], "first_segment": [None, None, True, False, None]})
    found = txn._Marks(marks)
    assert all(isinstance(x, np.ndarray) for s in found.of.values() for x in (s.turns, s.blocks, s.codes, s.first))
    got = found.find(pa.array(["a", "a", "a", "b", "c"]), pa.array([2, 5, 10, 3, 1]), pa.array(["I"] * 5), pa.nulls(5, pa.int64()), pa.array([None, None, 8, None, None], pa.int64()))
    assert got.to_pylist() == [{"txn_id": x, "txn_seq": b} for x, b in ((7, 1), (None, None), (8, 3), (5, 2), (None, None))]


def test_changes_of_many_keys_are_ordered_in_more_tasks(spark, monkeypatch):
    """Tasks were as many as the session's shuffle partitions, so each ordered more with every change of the log."""
    changes = silver.committed(spark, SF)
    want = sorted(map(str, queries.history_scd2(spark, SF).collect()))
    monkeypatch.setattr(carry, "ROWS", 1000)
    assert state._lives(changes)[0].rdd.getNumPartitions() == -(-changes.count() // 1000)
    assert sorted(map(str, queries.history_scd2(spark, SF).collect())) == want
