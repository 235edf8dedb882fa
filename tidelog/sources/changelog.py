"""A deterministic change log of the orders table, as messages and as captured bytes.

Orders fall into batches of 100 keys. Each batch is three transactions: insert all of its orders, update those with
key % 4 = 2 (status U, customer unchanged) and, in batches with b % 7 = 3, move those with key % 4 = 1 to key + 10**7,
delete those with key % 4 = 3. By b % 7 a batch is sent plain, streamed and committed (5), streamed and aborted (6), or
two-phase (4), committed for even b and rolled back for odd. The relation is sent first, again unchanged at batch 5, and
with a fifth column at batch 10. One message, origin, type and truncate of an unknown relation stand in batch 1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.operators.encode import encode

OID, OTHER_OID = 16_400, 16_500
SLOT, BASE_LSN, SPAN, MOVED = "orders_slot", 97_500_059_648, 1000, 10_000_000
VERSION, WIDE_FROM = 4, 10
COLUMNS = (("o_orderkey", 20, True), ("o_custkey", 20, False), ("o_orderstatus", 25, False), ("o_totalprice", 701, False), ("o_orderpriority", 25, False))
TRANSACTIONS = ("insert", "update", "delete")


def _value(c: Column) -> Column:
    return F.struct(F.when(c.isNull(), "n").otherwise("t").alias("kind"), c.cast("string").cast("binary").alias("value"))


def _none(kind: str) -> Column:
    return F.struct(F.lit(kind).alias("kind"), F.lit(None).cast("binary").alias("value"))


#: Message fields the log uses, with their types.
FIELDS = {
    "tag": "string", "stream_xid": "long", "msg_xid": "long", "xid": "long", "subxid": "long", "oid": "long", "flags": "int", "final_lsn": "long",
    "commit_lsn": "long", "prepare_lsn": "long", "end_lsn": "long", "message_lsn": "long", "abort_lsn": "long", "ts": "long", "prepare_ts": "long",
    "key_type": "string", "gid": "string", "namespace": "string", "name": "string", "replident": "string", "first_segment": "boolean",
    "prefix": "string", "content": "binary", "oids": "array<bigint>",
    "columns": "array<struct<name:string,type_id:bigint,type_modifier:int,is_key:boolean>>",
    "old": "array<struct<kind:string,value:binary>>", "new": "array<struct<kind:string,value:binary>>",
}


def cells(given: dict[str, Column]) -> list[Column]:
    """All message fields as columns, those that are not given as null.."""
    return [F.lit(given.get(n)).cast(kind).alias(n) for n, kind in FIELDS.items()]


#: Rows of a source table from which one task makes its part of a log.
ROWS = 25_000


def spread(table: DataFrame, key: str) -> DataFrame:
    """The table dealt out by ranges of its key, so that a log's tasks are by its rows and not by the row groups of a file."""
    return table.repartitionByRange(tasks(table), key)


def tasks(table: DataFrame) -> int:
    return -(-table.count() // ROWS) or 1


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log's messages with slot, seq, wal_start, wal_end, server_time and stream_xid."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    n = tasks(orders)
    orders = orders.repartitionByRange(n, "o_orderkey")
    number = F.col("o_orderkey").cast("long")
    b = F.expr("o_orderkey div 100")
    orders = orders.select("*", b.alias("b"), (number % 4).alias("m"), (number % 100).alias("k")).withColumn("way", F.col("b") % 7)
    # so many tasks again, as a few bytes a batch would all be put into one
    batches = orders.select("b", "way").distinct().repartition(n, "b")
    # what happens to an order: 0 it is inserted, 1 updated, 2 moved, 3 deleted
    m, wide = F.col("m"), F.col("b") >= WIDE_FROM
    key, moved, none = _value(number), _value(number + MOVED), _none("n")
    rest = lambda cust, status: [cust, _value(status), _value(F.col("o_totalprice"))]
    as_is, changed = rest(_value(F.col("o_custkey")), F.col("o_orderstatus")), rest(_none("u"), F.lit("U"))
    row = lambda *cells: F.when(wide, F.array(*cells, _value(F.col("o_orderpriority")))).otherwise(F.array(*cells))
    old = F.when(wide, F.array(key, *[none] * 4)).otherwise(F.array(key, *[none] * 3))
    no = F.lit(None).cast(FIELDS["new"])
    happens = lambda c, old, new: F.struct(F.lit(c).alias("c"), old.alias("old"), new.alias("new"))
    steps = [happens(0, no, row(key, *as_is)), F.when(m == 2, happens(1, no, row(key, *changed)))]
    steps += [F.when((m == 1) & (F.col("way") == 3), happens(2, old, row(moved, *as_is))), F.when(m == 3, happens(3, old, no))]
    # rows are put together inside of the explode, as whatever reads a column behind it would put them together again
    rows = orders.select("b", "k", "way", F.explode(F.array(*steps)).alias("x")).where("x is not null").select("b", "k", "way", "x.*")
    c, streamed = F.col("c"), F.col("way").isin(5, 6)
    t = F.when(c == 0, 0).when(c == 3, 2).otherwise(1)
    place = F.when(streamed & (F.col("k") >= 50), F.col("k") + 30).otherwise(F.col("k") + 1)
    xid = F.when(streamed, 1000 + 3 * F.col("b") + t)
    keyed = c.isin(2, 3)
    given = {
        "tag": F.when(c == 0, "I").when(c == 3, "D").otherwise("U"), "oid": OID, "stream_xid": xid, "msg_xid": xid,
        "key_type": F.when(keyed, "K"), "old": F.col("old"), "new": F.col("new"),
    }
    log = rows.select("b", t.alias("t"), place.cast("int").alias("place"), *cells(given)).unionByName(_controls(batches))
    seq = _seq(F.col("b"), F.col("t"), F.col("place"))
    time = _time(F.col("b"), F.col("t"))
    return log.select(F.lit(SLOT).alias("slot"), seq.alias("seq"), _lsn(seq).alias("wal_start"), _lsn(seq + 1).alias("wal_end"), time.alias("server_time"), *FIELDS)


#: What a batch sends beside its changes: way, parity of b or -1, place, tag, and the places whose positions are its
#: final, commit, prepare, end and abort LSN. Fixed values of the recipe.
CONTROLS = [
    *[(w, -1, p, tag, *at) for w in range(4) for p, tag, *at in ((0, "B", 150, None, None, None, None), (150, "C", None, 150, None, 151, None))],
    *[(w, -1, p, tag, None, None, None, None, None) for w in (5, 6) for p, tag in ((0, "S"), (70, "S"), (60, "E"), (140, "E"))],
    (5, -1, 150, "c", None, 150, None, 151, None),
    (6, -1, 150, "A", None, None, None, None, 150),
    (4, -1, 0, "b", None, None, 150, 151, None),
    (4, -1, 150, "P", None, None, 150, 151, None),
    (4, 0, 160, "K", None, 160, None, 161, None),
    (4, 1, 160, "r", None, None, 151, 161, None),
]


def _controls(batches: DataFrame) -> DataFrame:
    """Message columns with b, t and place, for every batch; the sent-once messages stand in the batches that send them."""
    spark = batches.sparkSession
    kinds = "way long, parity long, place int, tag string, final_at int, commit_at int, prepare_at int, end_at int, abort_at int"
    rows = batches.withColumn("t", F.explode(F.array(*[F.lit(t) for t in range(3)]))).join(F.broadcast(spark.createDataFrame(CONTROLS, kinds)), "way")
    rows = rows.where("parity < 0 or parity = b % 2")
    tag, xid, ts = F.col("tag"), 1000 + 3 * F.col("b") + F.col("t"), _time(F.col("b"), F.col("t"))
    at = lambda c: _lsn(_seq(F.col("b"), F.col("t"), F.col(c)))
    named = tag.isin("b", "P", "K", "r")
    known = {
        "tag": tag, "xid": F.when(~tag.isin("C", "E"), xid), "subxid": F.when(tag == "A", xid), "flags": F.when(tag.isin("C", "c", "P", "K", "r"), 0),
        "final_lsn": at("final_at"), "commit_lsn": at("commit_at"), "prepare_lsn": at("prepare_at"), "end_lsn": at("end_at"), "abort_lsn": at("abort_at"),
        "ts": F.when(~tag.isin("S", "E"), ts), "prepare_ts": F.when(tag == "r", ts), "gid": F.when(named, F.concat(F.lit("g"), xid.cast("string"))),
        "first_segment": F.when(tag == "S", F.col("place") == 0),
    }
    none = lambda n: F.lit(None).cast(FIELDS[n])
    rows = rows.select("b", "t", "place", *[known.get(n, none(n)).cast(FIELDS[n]).alias(n) for n in FIELDS])

    def once(place: int, tag: str, batch: int, **fields: object) -> tuple:
        given = {"tag": tag} | fields
        return (batch, 0, place, *[given.get(n) for n in FIELDS])

    sent = [
        once(120, "M", 1, flags=1, message_lsn=BASE_LSN + 64 * (SPAN + 130), prefix="note", content=b"batch one"),
        once(121, "O", 1, message_lsn=BASE_LSN + 64 * (SPAN + 131), name="elsewhere"),
        once(122, "Y", 1, oid=9000, namespace="public", name="mood"),
        once(123, "T", 1, flags=1, oids=[OTHER_OID]),
        *[
            once(-1, "R", batch, oid=OID, namespace="public", name="orders", replident="d", columns=[(c, kind, -1, is_key) for c, kind, is_key in COLUMNS[:n]])
            for batch, n in ((0, 4), (5, 4), (WIDE_FROM, 5))
        ],
    ]
    schema = "b long, t int, place int, " + ", ".join(f"{n} {k}" for n, k in FIELDS.items())
    return rows.unionByName(spark.createDataFrame(sent, schema).join(batches.select("b"), "b", "left_semi"))


def _seq(b: Column, t: Column, place: Column) -> Column:
    return (b * SPAN + t * 300 + place + 10).cast("long")


def _lsn(seq: Column) -> Column:
    return F.lit(BASE_LSN) + 64 * seq


def _time(b: Column, t: Column) -> Column:
    return (F.lit(757_382_400_000_000) + b * 60_000_000 + t * 1_000_000).cast("long")


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as captured: slot, seq, wal_start, wal_end, server_time, data."""
    log = encode(messages(spark, sf_dir), VERSION)
    return log.select("slot", "seq", "wal_start", "wal_end", "server_time", "data")


#: Load scenarios: columns beside the id, characters of each, rows of a transaction, and whether rows are changed again.
SCENARIOS = {"narrow": (1, 100, 8000, False), "batch_100": (1, 100, 100, False), "wide": (20, 50, 500, False), "payload_2kb": (1, 2000, 500, False), "mixed": (1, 100, 500, True)}


def generated(spark: SparkSession, rows: int, kind: str = "narrow", seed: int = 42, whole: bool = False) -> DataFrame:
    """Messages of a load scenario: rows with an id, texts and (but for wide ones) a time; whole adds relation, begins and commits.

    A mixed one inserts all rows of a transaction, then updates those with id % 4 = 1 and deletes those with id % 4 = 3,
    a transaction each. Texts are letters made by a rule from the seed and the id.
    """
    n, length, batch, mixed = SCENARIOS[kind]
    letters = lambda k: F.regexp_replace(F.sha2(F.concat_ws("-", F.lit(seed), "id", F.lit(k)), 512), "[0-9]", "q")
    text = lambda j: F.substring(F.concat(*[letters(100 * j + k) for k in range(-(-length // 128))]), 1, length)
    cells = [_value(F.col("id")), *[_value(text(j)) for j in range(n)], *([_value(F.lit("2024-01-01 00:00:00"))] if kind != "wide" else [])]
    names = ["id", *[f"col{j}" for j in range(n)], *(["created_at"] if kind != "wide" else [])]
    none = [_none("n")] * (len(cells) - 1)
    step = 4 * batch  # sequence numbers of a batch: three transactions of its rows, a begin and a commit each
    b, k = F.expr(f"(id - 1) div {batch}"), (F.col("id") - 1) % batch
    number = lambda t, place: (b * step + t * (batch + 2) + place + 2).cast("long")
    row = lambda t, tag, old, new, keyed=None: F.struct(number(t, k + 1).alias("seq"), F.lit(tag).alias("tag"), F.lit(keyed).cast("string").alias("key_type"), old.alias("old"), new.alias("new"))
    gone = F.lit(None).cast(FIELDS["old"])
    sent = [row(0, "I", gone, F.array(*cells))]
    if mixed:
        fresh = F.array(cells[0], _value(F.reverse(text(0))), *cells[2:])
        sent += [F.when(F.col("id") % 4 == 1, row(1, "U", gone, fresh)), F.when(F.col("id") % 4 == 3, row(2, "D", F.array(cells[0], *none), gone, "K"))]
    ids = spark.range(1, rows + 1)
    log = ids.select(F.explode(F.array_compact(F.array(*sent))).alias("x")).select("x.*", F.lit(OID).cast("long").alias("oid"))
    if whole:
        turns = ids.where(k == 0).select(b.alias("b"), F.explode(F.array(*[F.lit(t) for t in range(3 if mixed else 1)])).alias("t"))
        zero = F.col("b") * step + F.col("t") * (batch + 2) + 2
        ends = turns.select("*", F.explode(F.array(F.lit("B"), F.lit("C"))).alias("tag"))
        at = zero + F.when(F.col("tag") == "C", batch + 1).otherwise(0)
        xid = F.when(F.col("tag") == "B", (3 * F.col("b") + F.col("t") + 1) % (1 << 32))
        commit = _lsn(zero + batch + 1)
        marks = ends.select(at.cast("long").alias("seq"), "tag", xid.alias("xid"), F.lit(0).cast("long").alias("ts"), F.lit(0).alias("flags"), commit.alias("final_lsn"), commit.alias("commit_lsn"), (commit + 64).alias("end_lsn"))
        columns = [(c, 20 if c == "id" else 25, -1, c == "id") for c in names]
        about = spark.createDataFrame([(1, "R", OID, "public", "load", "d", columns)], f"seq long, tag string, oid long, namespace string, name string, replident string, columns {FIELDS['columns']}")
        log = log.unionByName(marks, allowMissingColumns=True).unionByName(about, allowMissingColumns=True)
    return log.select(F.lit("load").alias("slot"), _lsn(F.col("seq")).alias("wal_start"), _lsn(F.col("seq") + 1).alias("wal_end"), F.lit(0).cast("long").alias("server_time"), "*")
