"""A table read in chunks while its log runs on, and the log, as one state.

A chunk is read at some time between two marks in the log, low and high; nobody knows when, and it may differ from row to
row. Where nothing happened to a row between the marks, what was read is how it stands at high, whatever the log said
before. Where something did, the log is right about what it says, and the row that was read counts as of low: it is
superseded but for values the log left out as unchanged, which it alone may know.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.operators import state
from tidelog.operators.carry import broadcast_if_few

#: Chunks, up to which their marks are broadcast.
FEW = 1_000_000
CHUNK = ["slot", "schema", "table", "chunk"]


def superseded(rows: DataFrame, changes: DataFrame) -> DataFrame:
    """(slot, schema, table, chunk, key) of the rows that were changed, moved or wiped between the marks of their chunk.

    rows have these columns with low and high, places in commit order. Changes are looked at once, by key.
    """
    around = rows.agg(F.min("low").alias("low"), F.max("high").alias("high")).first()
    if around["low"] is None:
        return rows.select(*CHUNK, "key")
    near = changes.where((F.col("commit_seq") > around["low"]) & (F.col("commit_seq") <= around["high"]))
    touched = state.keyed(near.where(F.col("tag").isin("I", "U", "D"))).select(*state.BY, "commit_seq").distinct()
    inside = (F.col("commit_seq") > F.col("low")) & (F.col("commit_seq") <= F.col("high"))
    changed = rows.join(touched, state.BY).where(inside).select(*CHUNK, "key")
    wipes = near.where("tag = 'T'").select("slot", "commit_seq", F.explode("truncate_tables").alias("_t"))
    wiped = rows.withColumn("_t", F.concat_ws(".", "schema", "table")).join(broadcast_if_few(wipes, F.lit(1), FEW), ["slot", "_t"]).where(inside).select(*CHUNK, "key")
    return changed.unionByName(wiped).distinct()


def with_chunks(chunks: DataFrame, marks: DataFrame, changes: DataFrame) -> DataFrame:
    """Committed changes with the rows of chunks among them, as inserts at their place.

    chunks are (slot, schema, table, chunk, primary_key, row), row an array of (name, kind, value); marks are (slot,
    schema, table, chunk, low, high). A table has a key, as rows could not be told apart from what the log says of them
    otherwise. A key that two chunks hold (it moved in between) is a row of each. Changes may begin at the lowest mark.
    """
    pick = F.transform("primary_key", lambda n: F.get(F.filter("row", lambda c: c["name"] == n), F.lit(0))["value"])
    keyless = F.raise_error(F.concat(F.lit("a chunk of a table without a key: "), F.concat_ws(".", "schema", "table"))).cast("array<binary>")
    rows = chunks.withColumn("key", F.when(F.size("primary_key") > 0, pick).otherwise(keyless))
    rows = rows.join(broadcast_if_few(marks, F.lit(1), FEW), CHUNK)
    old = superseded(rows.select(*CHUNK, "key", "low", "high"), changes).withColumn("_old", F.lit(True))
    placed = rows.join(old, [*CHUNK, "key"], "left").withColumn("commit_seq", F.when(F.col("_old"), F.col("low")).otherwise(F.col("high")))
    none = {f.name: F.lit(None).cast(f.dataType) for f in changes.schema.fields}
    known = {
        "slot": F.col("slot"), "schema": F.col("schema"), "table": F.col("table"), "tag": F.lit("I"), "new_row": F.col("row"), "commit_seq": F.col("commit_seq"),
        "seq": F.lit(1 << 62), "primary_key": F.col("primary_key"), "replica_identity": F.lit("default"), "column_names": F.transform("row", lambda c: c["name"]),
    }
    return changes.unionByName(placed.select(*[known.get(n, c).cast(changes.schema[n].dataType).alias(n) for n, c in none.items()]))


def chunked_state(chunks: DataFrame, marks: DataFrame, changes: DataFrame) -> DataFrame:
    """net_state() of a table that was read in chunks while its log ran on: the same for any chunks and any time of reading."""
    return state.net_state(with_chunks(chunks, marks, changes))
