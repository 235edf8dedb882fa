"""A second deterministic change log, of the part table, with what the orders log does not send.

Parts fall into batches of 50 keys, and a batch is one transaction. Three relations: parts (replica identity full, all
columns flagged: old rows are whole), loose (no key: equal rows are copies) and bins (binary columns). Transaction ids
come round every five batches. By b % 6 a batch is sent plain (0), streamed with a part that is rolled back (1),
streamed and aborted (2), streamed and prepared (3; committed where b % 12 = 3, else rolled back), plain with its commit
in the last place of a bucket and a message outside any transaction in the first place of the next (4), or streamed and
never decided (5).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.operators.carry import BUCKET
from tidelog.operators.encode import encode
from tidelog.sources.changelog import FIELDS, _value, cells, spread

SLOT, PARTS, LOOSE, BINS, VERSION = "parts_slot", 20_001, 20_002, 20_003, 4
COLUMNS = (("p_partkey", 20), ("p_name", 25), ("p_brand", 25), ("p_size", 23), ("p_retailprice", 701))
BATCH, XIDS, FIRST_XID, PART_XID, LAST = 50, 5, 700, 10_000, BUCKET - 1
#: Relation messages at the log's start: oid, name, replica identity, columns with their key flag.
RELATIONS = (
    (PARTS, "parts", "f", [(c, kind, -1, True) for c, kind in COLUMNS]),
    (LOOSE, "loose", "n", [("brand", 25, -1, False)]),
    (BINS, "bins", "d", [("id", 23, -1, True), ("body", 17, -1, False)]),
)


def _binary(c: Column) -> Column:
    return F.struct(F.lit("b").alias("kind"), c.alias("value"))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log's messages with slot, seq, wal_start, wal_end, server_time and stream_xid."""
    part = spread(spark.read.parquet(f"{sf_dir}/part.parquet").where("p_partkey is not null"), "p_partkey")
    b, k = F.expr(f"p_partkey div {BATCH}"), F.col("p_partkey") % BATCH
    part = part.select("*", b.alias("b"), k.alias("k")).withColumns({"way": F.col("b") % 6, "xid": FIRST_XID + F.col("b") % XIDS})
    streamed = F.col("way").isin(1, 2, 3, 5)
    row = lambda size: F.array(*[_value(size if c == "p_size" else F.col(c)) for c, _ in COLUMNS])
    # what is sent of a part: 0 its insert, 1 update and 2 delete, 3 and 4 a loose row twice, 5 a binary one
    loose = k % 10 == 0
    sent = F.array(F.lit(0), F.when(k % 3 == 1, 1), F.when(k % 3 == 2, 2), F.when(loose, 3), F.when(loose, 4), F.when(k % 7 == 0, 5))
    rows = part.select("*", F.explode(F.array_compact(sent)).alias("c"))
    c, of_parts = F.col("c"), F.col("c") < 3
    xid = F.when(streamed, F.col("xid"))
    sub = F.when(streamed, F.when((F.col("way") == 1) & (k % 5 == 4), F.col("xid") + PART_XID).otherwise(F.col("xid")))
    body = F.array(_binary(F.unhex(F.lpad(F.hex("p_partkey"), 8, "0"))), _binary(F.encode("p_name", "UTF-8")))
    new = F.when(of_parts & (c != 2), row(F.col("p_size") + F.when(c == 1, 1).otherwise(0))).when(c.isin(3, 4), F.array(_value(F.col("p_brand")))).when(c == 5, body)
    changed = c.isin(1, 2)
    given = {
        "tag": F.when(c == 1, "U").when(c == 2, "D").otherwise("I"), "oid": F.when(of_parts, PARTS).when(c == 5, BINS).otherwise(LOOSE),
        "stream_xid": xid, "msg_xid": sub, "key_type": F.when(changed, "O"), "old": F.when(changed, row(F.col("p_size"))), "new": new,
    }
    place = F.when(of_parts, 100 * (c + 1) + k).when(c == 5, 600 + k).otherwise(397 + c + 2 * k)
    log = rows.select("b", F.lit(0).alias("t"), place.cast("int").alias("place"), *cells(given)).unionByName(_controls(part.select("b", "way").distinct()))
    seq = F.col("b") * BUCKET + F.col("place")
    return log.select(F.lit(SLOT).alias("slot"), seq.cast("long").alias("seq"), (64 * seq).cast("long").alias("wal_start"), (64 * seq + 64).cast("long").alias("wal_end"), F.lit(0).cast("long").alias("server_time"), *FIELDS)


#: What a batch sends beside its changes: way, place, tag. Fixed values of the recipe.
CONTROLS = [
    *[(w, p, tag) for w in (0, 4) for p, tag in ((10, "B"), (LAST, "C"))],
    *[(w, p, tag) for w in (1, 2, 3, 5) for p, tag in ((10, "S"), (800, "E"))],
    (1, 810, "A"), (1, LAST, "c"), (2, LAST, "A"), (3, 900, "p"), (3, LAST, "K"), (4, BUCKET, "M"),
]


def _controls(batches: DataFrame) -> DataFrame:
    spark = batches.sparkSession
    rows = batches.join(F.broadcast(spark.createDataFrame(CONTROLS, "way long, place int, tag string")), "way")
    back = (F.col("tag") == "K") & (F.col("b") % 12 != 3)
    rows = rows.withColumns({"tag": F.when(back, "r").otherwise(F.col("tag")), "xid": (FIRST_XID + F.col("b") % XIDS).cast("long")})
    tag, zero, at = F.col("tag"), F.lit(0).cast("long"), (64 * (F.col("b") * BUCKET + F.col("place"))).cast("long")
    part = (tag == "A") & (F.col("place") < LAST)
    known = {
        "tag": tag, "xid": F.when(~tag.isin("C", "E", "M"), F.col("xid")), "subxid": F.when(part, F.col("xid") + PART_XID).when(tag == "A", F.col("xid")),
        "flags": F.when(tag.isin("C", "c", "K", "r", "p", "M"), 0), "final_lsn": F.when(tag == "B", at), "commit_lsn": F.when(tag.isin("C", "c", "K"), at),
        "prepare_lsn": F.when(tag.isin("p", "r"), at), "end_lsn": F.when(tag.isin("C", "c", "K", "r", "p"), at + 64), "ts": F.when(~tag.isin("S", "E", "M"), zero),
        "prepare_ts": F.when(tag == "r", zero), "abort_lsn": F.when(tag == "A", at), "first_segment": F.when(tag == "S", F.lit(True)),
        "gid": F.when(tag.isin("p", "K", "r"), F.concat(F.lit("p"), F.col("b"))), "message_lsn": F.when(tag == "M", at),
        "prefix": F.when(tag == "M", "edge"), "content": F.when(tag == "M", F.lit(b"")),
    }
    rows = rows.select("b", F.lit(0).alias("t"), "place", *[known.get(n, F.lit(None)).cast(t).alias(n) for n, t in FIELDS.items()])
    first = [tuple({"tag": "R", "oid": oid, "namespace": "public", "name": name, "replident": identity, "columns": columns}.get(n) for n in FIELDS) for oid, name, identity, columns in RELATIONS]
    schema = "b long, t int, place int, " + ", ".join(f"{n} {t}" for n, t in FIELDS.items())
    return rows.unionByName(spark.createDataFrame([(0, 0, k + 1, *r) for k, r in enumerate(first)], schema))


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as captured: slot, seq, wal_start, wal_end, server_time, data."""
    return encode(messages(spark, sf_dir), VERSION).select("slot", "seq", "wal_start", "wal_end", "server_time", "data")
