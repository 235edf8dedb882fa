"""Registered queries over the orders change log, replayed from encoded bytes, and their DuckDB oracles on the plain tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions import lsn as L
from tidelog.functions import scalars as S
from tidelog.operators import events as E
from tidelog.operators import chunks, frontier, metrics, progress, project, route, sessions, snapshot, state, txn
from tidelog.operators.decode import POSITIONS, decode
from tidelog.operators.encode import encode, frames
from tidelog.operators.framing import unframe
from tidelog.operators.project import Field
from tidelog.plans import silver
from tidelog.sources import changelog as C
from tidelog.sources.scratch import materialise, shared_dir
from tidelog.streaming.upsert import UpsertSink

ORDER = [Field("o_orderkey", "i64"), Field("o_custkey", "i64"), Field("o_orderstatus", "string"), Field("o_totalprice", "f64")]


_messages, _events, _assigned, _committed = silver.messages, silver.events, silver.assigned, silver.committed


def lsn_format(spark, sf_dir):
    at = F.lit(C.BASE_LSN) + F.col("event_id") * 4_294_967_296 + F.col("event_id")
    return _table(spark, sf_dir, "events").select("event_id", L.format_lsn(at).alias("lsn_text"))


def lsn_parse(spark, sf_dir):
    text = F.concat(F.hex("event_id"), F.lit("/"), F.lower(F.hex(F.col("event_id") * 7)))
    return _table(spark, sf_dir, "events").select("event_id", L.parse_lsn(text).alias("lsn"))


def pg_timestamp(spark, sf_dir):
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    back = L.server_time(L.server_micros(F.col("ts").cast("timestamp")))
    return _table(spark, sf_dir, "events").select("event_id", L.server_micros(F.col("ts").cast("timestamp")).alias("server_micros"), (F.unix_micros(back) == micros).alias("round_trip"))


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def decode_insert(spark, sf_dir):
    rows = _events(spark, sf_dir).where("tag = 'I'")
    return project.strict(rows.select("seq", "schema", "table", F.col("new_row").alias("row")), ORDER)


def decode_update(spark, sf_dir):
    rows = _events(spark, sf_dir).where("tag = 'U'")
    old, new = S.get(F.col("old_row"), "o_orderkey"), S.get(F.col("new_row"), "o_orderkey")
    return rows.select(
        "seq",
        "replica_identity",
        F.array_join("key_columns", ",").alias("key_columns"),
        S.text(old).cast("long").alias("old_key"),
        S.text(new).cast("long").alias("new_key"),
        S.text(S.get(F.col("new_row"), "o_orderstatus")).alias("status"),
        S.get(F.col("new_row"), "o_custkey").isNull().alias("customer_unchanged"),
    )


def decode_delete(spark, sf_dir):
    rows = _events(spark, sf_dir).where("tag = 'D'")
    return rows.select("seq", "key_type", S.text(S.get(F.col("old_row"), "o_orderkey")).cast("long").alias("o_orderkey"), F.size("old_row").cast("long").alias("n_columns"))


def decode_control(spark, sf_dir):
    rows = _events(spark, sf_dir).where(~F.col("tag").isin("I", "U", "D", "R", "T", "M", "O", "Y"))
    return rows.select("seq", "event_type", "xid", "commit_lsn", "end_lsn", "gid", F.col("stream_xid").isNotNull().alias("in_stream"), F.unix_seconds("event_ts").alias("event_seconds"))


def decode_other(spark, sf_dir):
    rows = _events(spark, sf_dir).where(F.col("tag").isin("T", "M", "O", "Y"))
    return rows.select("seq", "event_type", "flags", "prefix", F.decode("content", "UTF-8").alias("content"), "origin_name", F.col("table").alias("type_name"), F.size("truncate_tables").cast("long").alias("n_tables"))


def relation_changes(spark, sf_dir):
    return E.relations(_messages(spark, sf_dir)).select("oid", "valid_from_seq", "valid_to_seq", "is_change", F.size("columns").cast("long").alias("n_columns"), E.full_name(F.col("namespace"), F.col("name")).alias("full_name"))


def key_columns(spark, sf_dir):
    rows = _events(spark, sf_dir).where("tag in ('U', 'D')")
    return rows.groupBy("tag", F.array_join("key_columns", ",").alias("key_columns"), "replica_identity").agg(F.count(F.lit(1)).alias("n"))


def truncate_tables(spark, sf_dir):
    """A truncate of a known and an unknown relation behind the log: the known one is named, the other left out."""
    own = spark.createDataFrame([(C.SLOT, 10**9, 0, 0, 0, "T", 1, [C.OID, C.OTHER_OID])], "slot string, seq long, wal_start long, wal_end long, server_time long, tag string, flags int, oids array<long>")
    log = C.messages(spark, sf_dir).unionByName(own, allowMissingColumns=True)
    found = E.events(materialise(decode(encode(log, C.VERSION), C.VERSION), "truncates")).where("tag = 'T'")
    return found.select("seq", "flags", F.array_join("truncate_tables", ",").alias("tables"))


def txn_assign(spark, sf_dir):
    return _assigned(spark, sf_dir).where("tag in ('I', 'U', 'D')").select("seq", F.col("txn_id").alias("xid"))


def txn_stats(spark, sf_dir):
    return txn.stats(_assigned(spark, sf_dir))


def committed_only(spark, sf_dir):
    return _committed(spark, sf_dir).where("tag in ('I', 'U', 'D')").select("seq", "tag", F.col("txn_id").alias("xid"), "commit_seq")


def aborted_rows(spark, sf_dir):
    return txn.discarded(_assigned(spark, sf_dir)).where("tag in ('I', 'U', 'D')").select("seq", "tag", F.col("txn_id").alias("xid"))


def two_phase_visible(spark, sf_dir):
    return txn.outcomes(_assigned(spark, sf_dir)).where("gid is not null").select(F.col("txn_id").alias("xid"), "gid", "status", "commit_seq")


TARGET = C.BASE_LSN + 64 * (2 * C.SPAN)


def bounded_replay(spark, sf_dir):
    kept = txn.bounded_replay(_events(spark, sf_dir), TARGET)
    return kept.agg(F.count(F.lit(1)).alias("n_events"), F.max("seq").alias("last_seq"), F.count(F.when(F.col("tag") == "C", 1)).alias("n_commits"))


def bounded_replay_raw(spark, sf_dir):
    kept = txn.bounded_replay_raw(silver.bronze(spark, sf_dir), TARGET)
    return kept.agg(F.count(F.lit(1)).alias("n_frames"), F.max("seq").alias("last_seq"))


def net_state(spark, sf_dir):
    return project.strict(state.net_state(_committed(spark, sf_dir)).select("row"), ORDER)


def net_state_whole_rows(spark, sf_dir):
    """The fast path takes the last change's row as it was sent: a customer that it left out as unchanged is null here."""
    fields = [ORDER[0], Field("o_custkey", "i64", optional=True), *ORDER[2:]]
    return project.strict(state.latest(_committed(spark, sf_dir)).select("row"), fields)


def history_scd2(spark, sf_dir):
    rows = state.history(_committed(spark, sf_dir))
    return rows.select(F.decode(F.get("key", F.lit(0)), "UTF-8").cast("long").alias("o_orderkey"), "valid_from", "valid_to", S.text(S.get(F.col("row"), "o_orderstatus")).alias("status"))


def toast_fill(spark, sf_dir):
    rows = state.toast_fill(_committed(spark, sf_dir), ["o_custkey"]).where("tag = 'U' and key_type is null")
    return rows.select("seq", S.text(F.col("o_custkey")).cast("long").alias("o_custkey"))


def _texts(spark, sf_dir, numbers, flags):
    """A row of texts for each event: a number (+ and - before its id, or the text that is named), a flag and a word."""
    e = _table(spark, sf_dir, "events")
    k = F.col("event_id") % 6
    raw = F.when(k == 0, F.col("event_id").cast("string")).when(k == 1, F.concat(F.lit("+"), F.col("event_id"))).when(k == 2, F.concat(F.lit("-"), F.col("event_id")))
    for at, text in enumerate(numbers, 3):
        raw = raw.when(k == at, F.lit(text))
    flag = F.element_at(F.array(*[F.lit(x) for x in flags]), (k + 1).cast("int"))
    cell = lambda name, c, kind="t": F.struct(F.lit(name).alias("name"), F.lit(kind).alias("kind"), F.encode(c, "UTF-8").alias("value"))
    return e.select("event_id", F.array(cell("number", raw), cell("flag", flag), cell("word", F.col("event_type"))).alias("row"))


def typed_strict(spark, sf_dir):
    rows = _texts(spark, sf_dir, ("42", "-0007", "99999999999"), ("t", "off", "yes", "true", "0", "1"))
    return project.strict(rows, [Field("number", "i64"), Field("flag", "bool"), Field("word", "string"), Field("extra", "i32", default=7)])


def typed_lenient(spark, sf_dir):
    rows = project.lenient(_texts(spark, sf_dir, (" 42", "42.7", "99999999999"), ("t", "off", "yes", "T", "y", "1")), [Field("number", "i32"), Field("flag", "bool"), Field("word", "string")])
    return rows.select("event_id", "number", "flag", "word", F.size("errors").cast("long").alias("n_errors"), F.coalesce(F.get("errors", F.lit(0))["message"], F.lit("")).alias("first_error"))


def row_json(spark, sf_dir):
    return _events(spark, sf_dir).where("tag = 'D'").select("seq", project.row_json(F.col("old_row")).alias("json"))


def route_counts(spark, sf_dir):
    router = route.Router().on("orders", "insert", "loads").on("orders", "delete", "drops").on_default("rest")
    return router.routed(_events(spark, sf_dir)).groupBy("handler").agg(F.count(F.lit(1)).alias("n"))


def event_categories(spark, sf_dir):
    return route.categories(_events(spark, sf_dir))


def progress_lsn(spark, sf_dir):
    return progress.running(_events(spark, sf_dir).select("slot", "seq", "lsn", "tag", "end_lsn", "_bucket")).select("seq", "received", "applied")


def positions_across_edge(spark, sf_dir):
    """The log moved to where its middle stands at 2**63, from frames to progress and a stop behind the edge."""
    log = _messages(spark, sf_dir)
    middle = (log.agg(F.max("seq")).first()[0] or 0) // 2
    shift = L.BIAS - C.BASE_LSN - 64 * middle
    moved = lambda c: L.from_unsigned(L.unsigned(F.col(c)) + F.lit(Decimal(shift)))
    sent = frames(encode(log.withColumns({c: moved(c) for c in ("wal_start", "wal_end", *POSITIONS)}), C.VERSION))
    messages = materialise(decode(unframe(sent.select("slot", "seq", "frame")), C.VERSION), "edge-messages")
    events = materialise(E.events(messages, txn.assign(messages)).select("slot", "seq", "lsn", "tag", "end_lsn", "_bucket"), "edge-events")
    kept = txn.bounded_replay(events, L.BIAS + 64 * 200).select("slot", "seq", F.lit(True).alias("kept"))
    rows = progress.running(events).join(kept, ["slot", "seq"], "left")
    text = lambda c: L.unsigned(F.col(c)).cast("string").alias(c)
    return rows.select("seq", L.format_lsn(F.col("lsn")).alias("place"), text("received"), text("applied"), F.coalesce("kept", F.lit(False)).alias("kept"))


def metrics_bytes(spark, sf_dir):
    return metrics.totals(_events(spark, sf_dir))


def metrics_latency(spark, sf_dir):
    return metrics.latency(silver.bronze(spark, sf_dir).select("slot", "seq", "server_time"))


def snapshot_plus_stream(spark, sf_dir):
    """The first half of the orders as a snapshot, the changes of the other half behind it."""
    base = _table(spark, sf_dir, "orders")
    half = base.agg(F.max("o_orderkey").alias("top")).select(F.floor((F.col("top") + 1) / 200).alias("cut"))
    snapshot = base.crossJoin(F.broadcast(half)).where(F.col("o_orderkey") < F.col("cut") * 100).select("o_orderkey", "o_orderstatus")
    tail = _committed(spark, sf_dir).crossJoin(F.broadcast(half)).where(F.col("seq") >= F.col("cut") * C.SPAN)
    rows = project.strict(state.net_state(tail).select("row"), [ORDER[0], ORDER[2]])
    return snapshot.unionByName(rows)


def encode_roundtrip(spark, sf_dir):
    """Bytes, decoded and encoded again, are the same bytes."""
    first = silver.bronze(spark, sf_dir)
    again = encode(decode(first, C.VERSION), C.VERSION).select("seq", F.col("data").alias("again"))
    return first.join(again, "seq").groupBy((F.col("data") == F.col("again")).alias("same")).agg(F.count(F.lit(1)).alias("n"))


def quarantine(spark, sf_dir):
    """The log without its first relation message: changes before the next one have no relation."""
    log = silver.bronze(spark, sf_dir).where(f"seq > {C.SPAN // 100}")
    return E.quarantine(materialise(decode(log, C.VERSION), "headless")).groupBy("tag").agg(F.count(F.lit(1)).alias("n"))


def frames_header(spark, sf_dir):
    cut = unframe(frames(silver.bronze(spark, sf_dir)).select("slot", "seq", "frame"))
    return cut.select("seq", "wal_start", "wal_end", "server_time")


def typed_update(spark, sf_dir):
    rows = _events(spark, sf_dir).where("tag = 'U'")
    fields = [ORDER[0], Field("o_custkey", "i64", optional=True), Field("o_orderstatus", "string", optional=True)]
    got = project.typed_changes(rows, "update", fields)
    return got.select("seq", F.col("old.o_orderkey").alias("old_key"), F.col("new.o_orderkey").alias("new_key"), F.col("new.o_custkey").alias("customer"), F.col("new.o_orderstatus").alias("status"))


def json_roundtrip(spark, sf_dir):
    """Rows, texts and binary values, written as JSON and read back."""
    rows = _events(spark, sf_dir).unionByName(_events(spark, sf_dir, "parts")).where("tag = 'I'")
    back = project.row_from_json(project.row_json(F.col("new_row")))
    return rows.groupBy("table", S.same_row(back, F.col("new_row")).alias("same")).agg(F.count(F.lit(1)).alias("n"))


def event_json(spark, sf_dir):
    """All events as JSON, and what other readers find in it: kind, position, key, transaction, and time of a commit."""
    rows = _events(spark, sf_dir).select("seq", project.event_json().alias("json"))
    row = "struct<o_orderkey:string>"
    body = f"struct<data:{row},old_data:{row},new_data:{row},transaction_id:string,commit_timestamp:string>"
    rows = rows.select("seq", "json", F.from_json("json", f"lsn string, event_type map<string,{body}>").alias("read"))
    # a kind without fields, or with a list, is no such map
    other = F.when(F.get_json_object("json", "$.event_type") == "StreamStop", "StreamStop").otherwise(F.get(F.json_object_keys(F.get_json_object("json", "$.event_type")), F.lit(0)))
    kind = F.coalesce(F.get(F.map_keys("read.event_type"), F.lit(0)), other)
    rows = rows.select("seq", kind.alias("kind"), F.col("read.lsn").alias("lsn"), F.get(F.map_values("read.event_type"), F.lit(0)).alias("body"))
    among = lambda *kinds: F.col("kind").isin(*kinds)
    key = F.when(among("Insert"), F.col("body.data.o_orderkey")).when(among("Update"), F.col("body.new_data.o_orderkey")).when(among("Delete"), F.col("body.old_data.o_orderkey"))
    xid = F.when(among("Begin", "StreamStart", "StreamCommit", "StreamAbort", "BeginPrepare", "Prepare", "CommitPrepared", "RollbackPrepared"), F.col("body.transaction_id"))
    committed = F.when(among("Begin", "Commit"), F.col("body.commit_timestamp"))
    return rows.select("seq", "kind", F.col("lsn").cast("long"), key.cast("long").alias("o_orderkey"), xid.cast("long").alias("xid"), committed.alias("committed"))


def metrics_rates(spark, sf_dir):
    return metrics.rates(silver.bronze(spark, sf_dir)).select("slot", "second", "n_frames")


def full_identity_state(spark, sf_dir):
    """The table whose old rows are whole: rows told apart by value."""
    fields = [Field("p_partkey", "i64"), Field("p_name", "string"), Field("p_brand", "string"), Field("p_size", "i32"), Field("p_retailprice", "f64")]
    rows = state.net_state(_committed(spark, sf_dir, "parts").where("table = 'parts' or tag = 'T'"))
    return project.strict(rows.select("row"), fields)


def keyless_copies(spark, sf_dir):
    rows = state.net_state(_committed(spark, sf_dir, "parts").where("table = 'loose' or tag = 'T'"))
    return project.strict(rows.select("row"), [Field("brand", "string")]).groupBy("brand").agg(F.count(F.lit(1)).alias("n"))


def binary_columns(spark, sf_dir):
    rows = _events(spark, sf_dir, "parts").where("table = 'bins'").select("seq", F.col("new_row").alias("row"))
    got = project.strict(rows, [Field("id", "bytes"), Field("body", "bytes")])
    return got.select("seq", F.conv(F.hex("id"), 16, 10).cast("long").alias("id"), F.decode("body", "UTF-8").alias("body"))


def full_old_rows(spark, sf_dir):
    rows = _events(spark, sf_dir, "parts").where("tag in ('U', 'D')")
    size = lambda c: S.text(S.get(F.col(c), "p_size")).cast("long")
    return rows.select("seq", "tag", "key_type", "replica_identity", F.array_join("key_columns", ",").alias("key_columns"), size("old_row").alias("old_size"), size("new_row").alias("new_size"))


def reused_xids(spark, sf_dir):
    """Outcomes of transactions whose ids come round: an id names several transactions."""
    return txn.outcomes(_assigned(spark, sf_dir, "parts")).select(F.col("txn_id").alias("xid"), F.col("txn_seq").alias("begin_seq"), "status", "commit_seq", "gid")


def rolled_back_parts(spark, sf_dir):
    """Rows of transactions that committed, in parts of them that were rolled back."""
    log = _assigned(spark, sf_dir, "parts")
    done = txn.outcomes(log).where("status = 'committed'").select(*txn.KEY)
    return txn.discarded(log).join(done, txn.KEY, "left_semi").select("seq", F.col("msg_xid").alias("part_xid"))


def bucket_edges(spark, sf_dir):
    """Messages right behind a commit, in another bucket: they belong to no transaction, and the commit to its own."""
    return _assigned(spark, sf_dir, "parts").where("tag in ('M', 'C')").select("seq", "tag", F.col("txn_id").alias("xid"), F.col("txn_seq").alias("begin_seq"))


def undecided_transactions(spark, sf_dir):
    return txn.stats(_assigned(spark, sf_dir, "parts"))


def _cut_log(spark, sf_dir):
    """The log as a stream of copy messages, in chunks that end anywhere: every message is cut in two, and five such pieces make a chunk."""
    f = frames(silver.bronze(spark, sf_dir)).select("slot", "seq", "frame")
    sent = F.concat(F.lit(b"d"), F.unhex(F.lpad(F.hex(F.length("frame") + 4), 8, "0")), F.col("frame"))
    cut = F.pmod(F.col("seq") * 7, F.length(sent) + 1).cast("int")
    two = F.array(F.struct(F.lit(0).alias("k"), F.substring(sent, F.lit(1), cut).alias("piece")), F.struct(F.lit(1).alias("k"), F.substring(sent, cut + 1, F.length(sent)).alias("piece")))
    pieces = f.select("slot", "seq", F.explode(two).alias("x")).select("slot", (2 * F.col("seq") + F.col("x.k")).alias("n"), "x.piece")
    return pieces.groupBy("slot", F.floor((F.col("n") + 3) / 5).alias("seq")).agg(chunks.joined("n").alias("bytes"))


def frames_across_chunks(spark, sf_dir):
    """Headers of all frames of a stream whose chunks end inside of messages, and of lengths."""
    parts = materialise(chunks.split_log(_cut_log(spark, sf_dir)), "split")
    return unframe(parts.select("slot", F.col("at").alias("seq"), F.col("body").alias("frame"))).select("wal_start", "wal_end", "server_time")


def _sessions(spark, sf_dir, cuts):
    """The log as captured by several connections: (session, from, to) in tenths of it; later ones count anew and are sent the relations again."""
    log = silver.bronze(spark, sf_dir)
    top = F.broadcast(log.agg(F.max("seq").alias("top")))
    out = None
    for session, low, high in cuts:
        at, cut = F.col("seq"), F.expr(f"top * {low} div 10")
        rows = log.crossJoin(top).where((at > cut) & (at <= F.expr(f"top * {high} div 10")))
        rows = rows.withColumn("seq", at if session == 1 else 10**7 + 3 * at)
        if session > 1:
            again = log.crossJoin(top).where((F.substring("data", 1, 1) == F.lit(b"R")) & (at <= cut)).withColumns({"wal_start": F.lit(0).cast("long"), "wal_end": F.lit(0).cast("long")})
            rows = rows.unionByName(again)
        rows = rows.select("slot", F.lit(session).alias("session"), "seq", "wal_start", "wal_end", "server_time", "data")
        out = rows if out is None else out.unionByName(rows)
    return out


def recovered_log(spark, sf_dir):
    """Committed changes of a log that was captured three times in part, with overlaps, by their places in it."""
    log = materialise(sessions.merged(_sessions(spark, sf_dir, [(1, -1, 6), (2, 4, 8), (3, 3, 10)])), "merged")
    messages = materialise(decode(log, C.VERSION), "recovered")
    changes = txn.committed(materialise(E.events(messages, txn.assign(messages)), "recovered-events"))
    place = lambda c: F.expr(f"({c} - {C.BASE_LSN}) div 64")
    return changes.where("tag in ('I', 'U', 'D')").select(place("lsn").alias("place"), "tag", F.col("txn_id").alias("xid"), place("commit_lsn").alias("commit_place"))


def log_gaps(spark, sf_dir):
    return sessions.gaps(_sessions(spark, sf_dir, [(1, -1, 3), (2, 5, 7), (3, 6, 9)])).select("session", "gap_from", "gap_to")


def _worked(spark, sf_dir):
    """Commits of the log, and a step for each that was applied: out of order, and none for some of its last."""
    commits = txn.outcomes(_assigned(spark, sf_dir)).where("status = 'committed'").select("slot", F.col("commit_seq").alias("seq"), "end_lsn")
    late = F.col("seq") * 7 % 1000 + F.expr("seq div 4000") * 500
    return commits, commits.where("seq % 13 != 5 or seq < 9000").select("slot", "seq", late.alias("step"))


def safe_progress(spark, sf_dir):
    """The position that is safe to confirm after each step that moves it, where transactions are applied out of order."""
    return frontier.frontier(*_worked(spark, sf_dir)).select("step", "safe_lsn")


def applied_intervals(spark, sf_dir):
    return frontier.intervals(*_worked(spark, sf_dir)).select("first_seq", "last_seq", "n")


def upserted_state(spark, sf_dir):
    """The orders, kept by an upsert sink that is handed the committed changes in five batches of whole transactions."""
    changes = _committed(spark, sf_dir)
    sink = UpsertSink(spark, f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/upserts-{uuid.uuid4().hex}", buckets=16)
    top = changes.agg(F.max("commit_seq")).first()[0] or 0
    for n in range(5):
        sink(changes.where((F.col("commit_seq") > top * n // 5) & (F.col("commit_seq") <= top * (n + 1) // 5)), n)
    return project.strict(sink.table().select("row"), ORDER)


def _orders_at(spark, sf_dir, time):
    """The orders table as it stands at a place of its log (time is a column of o_orderkey), as named values; what a reader of the source sees."""
    o = _table(spark, sf_dir, "orders").select("*", F.expr("o_orderkey div 100").alias("b"), (F.col("o_orderkey") % 4).alias("m"))
    way = F.col("b") % 7
    end = lambda t: F.col("b") * C.SPAN + t * 300 + 10 + F.when(way == 4, 160).otherwise(150)
    done = (way < 4) | (way == 5) | ((way == 4) & (F.col("b") % 2 == 0))
    there = done & (end(0) <= time) & ~((F.col("m") == 3) & (end(2) <= time))
    moved = (F.col("m") == 1) & (way == 3) & (end(1) <= time)
    status = F.when((F.col("m") == 2) & (end(1) <= time), "U").otherwise(F.col("o_orderstatus"))
    o = o.where(there).withColumns({"o_orderkey": F.when(moved, F.col("o_orderkey") + C.MOVED).otherwise(F.col("o_orderkey")), "o_orderstatus": status})
    cell = lambda n: F.struct(F.lit(n).alias("name"), F.lit("t").alias("kind"), F.encode(F.col(n).cast("string"), "UTF-8").alias("value"))
    return o.select("o_orderkey", F.array(*[cell(n) for n, *_ in C.COLUMNS[:4]]).alias("row"))


def chunked_snapshot(spark, sf_dir):
    """The orders, read in five chunks while the last part of the log runs: half of a chunk's rows at its low mark, half at its high one."""
    last, top = _table(spark, sf_dir, "orders").agg(F.max("o_orderkey")).first()[0] or 0, 5
    span = (last // 100 + 1) * C.SPAN
    low = lambda c: F.lit(span) * (30 + 10 * c).cast("long") / 100
    marks = spark.range(top).select(F.lit(C.SLOT).alias("slot"), F.lit("public").alias("schema"), F.lit("orders").alias("table"), F.col("id").alias("chunk"), low(F.col("id")).cast("long").alias("low"), (low(F.col("id")) + span * 13 / 100).cast("long").alias("high"))
    part = F.least(F.expr(f"o_orderkey * {top - 1} div {last + 1}"), F.lit(top - 1))
    chunk_rows = None
    for mark in marks.collect():
        for half, at in enumerate((mark["low"], mark["high"])):
            read = _orders_at(spark, sf_dir, F.lit(at)).where((part == mark["chunk"]) & (F.col("o_orderkey") % 2 == half)).withColumn("chunk", F.lit(mark["chunk"]))
            chunk_rows = read if chunk_rows is None else chunk_rows.unionByName(read)
    chunk_rows = chunk_rows.select(F.lit(C.SLOT).alias("slot"), F.lit("public").alias("schema"), F.lit("orders").alias("table"), "chunk", F.array(F.lit("o_orderkey")).alias("primary_key"), "row")
    log = _committed(spark, sf_dir).where(F.col("commit_seq") > F.lit(span) * 3 / 10)
    return project.strict(snapshot.chunked_state(materialise(chunk_rows, "chunks"), marks, log).select("row"), ORDER)


def local_changes(spark, sf_dir):
    """Committed changes made on the server itself, of a log in which a third of the transactions say that they came from elsewhere.

    The origin message stands behind the changes, of streamed transactions in their second part.
    """
    log = C.messages(spark, sf_dir)
    begun = log.where("tag in ('B', 'b') or (tag = 'S' and first_segment)").where(F.expr(f"(seq div {C.SPAN} + seq % {C.SPAN} div 300) % 3 = 1"))
    from_afar = begun.select("slot", (F.col("seq") + 135).alias("seq"), "wal_start", "wal_end", "server_time", F.lit("O").alias("tag"), F.when(F.col("tag") == "S", F.col("xid")).alias("stream_xid"), F.col("wal_start").alias("message_lsn"), F.lit("far").alias("name"))
    sent = encode(log.unionByName(from_afar, allowMissingColumns=True), C.VERSION).select("slot", "seq", "wal_start", "wal_end", "server_time", "data")
    messages = materialise(decode(sent, C.VERSION), "origins")
    rows = materialise(E.events(messages, txn.assign(messages)), "origin-events")
    kept = txn.of_origin(txn.committed(rows), rows, "none")
    return kept.where("tag in ('I', 'U', 'D')").select("seq", "tag", F.col("txn_id").alias("xid"))


def latency_sketches(spark, sf_dir):
    """Quantiles of the gaps of each hour, from merged sketches of minutes, held against exact ones a little below and above."""
    gaps = materialise(metrics.gaps(silver.bronze(spark, sf_dir).select("slot", "seq", "server_time")), "gaps")
    hours = metrics.merged(metrics.sketches(gaps).withColumn("hour", F.date_trunc("hour", "start")), ["slot", "hour"])
    told = metrics.quantiles(hours, {"p50": 0.5, "p99": 0.99})
    hour = F.date_trunc("hour", L.server_time(F.col("server_time"))).alias("hour")
    exact = gaps.where("gap is not null").groupBy("slot", hour, "gap").agg(F.count(F.lit(1)).alias("n")).groupBy("slot", "hour")
    edge = lambda q, n: F.percentile("gap", max(0.0, min(1.0, q)), F.col("n")).alias(n)
    e = 2 * metrics.SKETCH_ERROR
    exact = exact.agg(edge(0.5 - e, "a50"), edge(0.5 + e, "b50"), edge(0.99 - e, "a99"), edge(0.99 + e, "b99"))
    both = told.join(exact, ["slot", "hour"])
    inside = lambda p: F.col(f"p{p}").between(F.floor(f"a{p}"), F.ceil(f"b{p}")).alias(f"p{p}_holds")
    return both.select("slot", F.unix_seconds("hour").alias("hour"), F.col("n").alias("n_gaps"), inside(50), inside(99))


NAMES = (
    "lsn_format", "lsn_parse", "pg_timestamp", "decode_insert", "decode_update", "decode_delete", "decode_control", "decode_other", "relation_changes",
    "key_columns", "truncate_tables", "txn_assign", "txn_stats", "committed_only", "aborted_rows", "two_phase_visible", "bounded_replay",
    "bounded_replay_raw", "net_state", "net_state_whole_rows", "history_scd2", "toast_fill", "typed_strict", "typed_lenient", "row_json", "route_counts",
    "event_categories", "progress_lsn", "metrics_bytes", "metrics_latency", "snapshot_plus_stream", "encode_roundtrip", "quarantine", "frames_header",
    "full_identity_state", "keyless_copies", "binary_columns", "full_old_rows", "reused_xids", "rolled_back_parts", "bucket_edges", "undecided_transactions",
    "typed_update", "json_roundtrip", "event_json", "metrics_rates", "frames_across_chunks", "recovered_log", "log_gaps", "safe_progress", "applied_intervals",
    "upserted_state", "chunked_snapshot", "local_changes", "latency_sketches", "positions_across_edge",
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {n: globals()[n] for n in NAMES}


def oracle_sql() -> dict[str, str]:
    from tidelog.plans.oracles import ORACLES

    return dict(ORACLES)
