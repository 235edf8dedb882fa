"""Messages to change events: relation versions, as-of resolution, named rows and key columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidelog.functions.lsn import server_time
from tidelog.functions.scalars import replica_identity
from tidelog.operators.carry import broadcast_if_few, carry_forward, with_bucket
from tidelog.sources.scratch import materialise

#: Tag and event kind. Fixed values.
EVENT_TYPES = {
    "B": "begin", "C": "commit", "R": "relation", "I": "insert", "U": "update", "D": "delete", "T": "truncate", "Y": "type", "O": "origin",
    "M": "message", "S": "stream_start", "E": "stream_stop", "c": "stream_commit", "A": "stream_abort", "b": "begin_prepare", "P": "prepare",
    "K": "commit_prepared", "r": "rollback_prepared", "p": "stream_prepare",
}
CHANGES = ("I", "U", "D")


def event_type(tag: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in EVENT_TYPES.items() for x in kv]), tag)


def _version() -> Column:
    return F.struct("namespace", "name", "replident", "columns")


def _described() -> Column:
    """A version with what every change of it is told: worked out once a version, as lambdas over its columns are dear."""
    names = lambda c: F.transform(c, lambda x: x["name"])
    identity = F.coalesce(replica_identity(F.col("replident")), F.lit("default"))
    keys = names(F.filter("columns", lambda c: c["is_key"]))
    return F.struct("namespace", "name", "columns", identity.alias("identity"), names(F.col("columns")).alias("names"), keys.alias("keys"))


def relations(messages: DataFrame) -> DataFrame:
    """Versions of each relation: slot, oid, namespace, name, replident, columns, valid_from_seq, valid_to_seq (null: still valid).

    A repeat that says the same opens no version. A relation sent inside a stream that aborts counts all the same.
    """
    sent = messages.where("tag = 'R' and error is null").select("slot", "oid", "seq", *["namespace", "name", "replident", "columns"])
    order = W.partitionBy("slot", "oid").orderBy("seq")
    before = F.lag(_version()).over(order)
    fresh = sent.withColumn("_before", before).withColumn("_first", F.row_number().over(order) == 1).where(F.col("_first") | ~F.col("_before").eqNullSafe(_version()))
    return fresh.select(
        "slot", "oid", "namespace", "name", "replident", "columns", F.col("seq").alias("valid_from_seq"), F.lead("seq").over(order).alias("valid_to_seq"), (~F.col("_first")).alias("is_change")
    )


def full_name(namespace: Column, name: Column) -> Column:
    return F.concat_ws(".", namespace, name)


def key_columns(key_type: Column, columns: Column) -> Column:
    """All columns for a full old row, else those of the key."""
    names = lambda c: F.transform(c, lambda x: x["name"])
    return F.when(key_type.eqNullSafe(F.lit("O")), names(columns)).otherwise(names(F.filter(columns, lambda x: x["is_key"])))


def named_row(values: Column, columns: Column) -> Column:
    """Values by position under the relation's names: what the relation doesn't name and what is unchanged is left out."""
    n = F.least(F.size(values), F.size(columns))
    zipped = F.zip_with(
        F.slice(values, 1, n), F.slice(columns, 1, n), lambda v, c: F.struct(c["name"].alias("name"), v["kind"].alias("kind"), v["value"].alias("value"))
    )
    return F.when(values.isNotNull(), F.filter(zipped, lambda x: x["kind"] != "u"))


#: Relation columns, in all versions together, up to which the versions are broadcast; beyond that they are joined.
FEW_COLUMNS = 2_000_000
#: Changes of a relation, and tables truncated, up to which they are broadcast.
FEW_NOTED = 1_000_000


def versioned(messages: DataFrame) -> DataFrame:
    """Adds _version: the seq of the relation message that holds for a change (or is this one), null where none was sent before."""
    log = messages if "_bucket" in messages.columns else with_bucket(messages)
    return carry_forward(log, {"_version": F.when((F.col("tag") == "R") & F.col("error").isNull(), F.col("seq"))}, key="oid")


def resolve(messages: DataFrame, rows: DataFrame | None = None, versions: DataFrame | None = None) -> DataFrame:
    """Adds relation: the version of a change's relation at its place in the log, null where none was sent before.

    rows, if given, are the rows of messages to resolve, relation messages among them. Versions of few columns altogether are broadcast and found by
    their time of validity; else rows carry the seq of theirs forward and are joined by it. versions, if given, are relations(messages).
    """
    rows = messages if rows is None else rows
    valid = (relations(messages) if versions is None else versions).select("slot", "oid", "valid_from_seq", "valid_to_seq", _described().alias("relation"))
    weight = valid.agg(F.sum(F.size("relation.columns") + 1)).first()[0] or 0
    if weight <= FEW_COLUMNS:
        names = {"slot": "_slot", "oid": "_oid"}
        same = (F.col("slot") == F.col("_slot")) & (F.col("oid") == F.col("_oid"))
        here = (F.col("seq") >= F.col("valid_from_seq")) & (F.col("valid_to_seq").isNull() | (F.col("seq") < F.col("valid_to_seq")))
        return rows.join(F.broadcast(valid.withColumnsRenamed(names)), same & here, "left").drop("_slot", "_oid", "valid_from_seq", "valid_to_seq")
    sent = messages.where("tag = 'R' and error is null").select("slot", F.col("seq").alias("_version"), _described().alias("relation"))
    return versioned(rows).join(sent, ["slot", "_version"], "left").drop("_version")


def events(messages: DataFrame, assigned: DataFrame | None = None) -> DataFrame:
    """One row per change event, in the silver schema; what cannot be one is in quarantine().

    A relation message is an event only where it changes a relation seen before. assigned, if given, is
    txn.assign(messages): the events then keep txn_id and txn_seq, and all of it is one exchange of the log.
    """
    rows = (messages if assigned is None else assigned).where("error is null")
    rows = rows if "_bucket" in rows.columns else with_bucket(rows)
    versions = materialise(relations(messages), "relations")
    fresh = versions.where("is_change").select("slot", F.col("valid_from_seq").alias("seq"))
    noted = fresh.withColumn("tables", F.array().cast("array<string>")).unionByName(truncated(messages, versions)).withColumn("_noted", F.lit(True))
    rows = rows.join(broadcast_if_few(noted, F.size("tables") + 1, FEW_NOTED), ["slot", "seq"], "left")
    out = resolve(messages, rows, versions).where("tag != 'R' or _noted")
    out = out.where(F.col("relation").isNotNull() | ~F.col("tag").isin(*CHANGES))
    rel, change = F.col("relation"), F.col("tag").isin(*CHANGES)
    named = lambda c: F.when(change, c)
    key = F.col("key_type")
    return out.select(
        "slot",
        "seq",
        "_bucket",
        F.col("wal_start").alias("lsn"),
        "tag",
        event_type(F.col("tag")).alias("event_type"),
        "stream_xid",
        "msg_xid",
        "xid",
        "subxid",
        "first_segment",
        "final_lsn",
        "commit_lsn",
        "prepare_lsn",
        "end_lsn",
        "message_lsn",
        "abort_lsn",
        server_time(F.col("ts")).alias("event_ts"),
        server_time(F.col("prepare_ts")).alias("prepare_event_ts"),
        F.col("oid").alias("relation_oid"),
        F.when(change | (F.col("tag") == "R"), rel["namespace"]).otherwise(F.when(F.col("tag") == "Y", F.col("namespace"))).alias("schema"),
        F.when(change | (F.col("tag") == "R"), rel["name"]).otherwise(F.when(F.col("tag") == "Y", F.col("name"))).alias("table"),
        F.when(change | (F.col("tag") == "R"), rel["identity"]).alias("replica_identity"),
        key.alias("key_type"),
        F.when(F.col("tag").isin("U", "D"), F.when(key.eqNullSafe(F.lit("O")), rel["names"]).otherwise(rel["keys"])).alias("key_columns"),
        named(rel["keys"]).alias("primary_key"),
        named(rel["names"]).alias("column_names"),
        F.when(F.col("tag") == "R", rel["columns"]).alias("relation_columns"),
        named_row(F.col("old"), rel["columns"]).alias("old_row"),
        named_row(F.col("new"), rel["columns"]).alias("new_row"),
        F.when(F.col("tag") == "T", F.coalesce("tables", F.array().cast("array<string>"))).alias("truncate_tables"),
        "flags",
        "gid",
        "prefix",
        "content",
        F.when(F.col("tag") == "O", F.col("name")).alias("origin_name"),
        F.lit(None).cast("map<string,string>").alias("metadata"),
        *[c for c in ("txn_id", "txn_seq") if c in rows.columns],
    )


def truncated(messages: DataFrame, versions: DataFrame | None = None) -> DataFrame:
    """(slot, seq, tables) of truncations: full names in the order sent, relations never sent left out."""
    sent = messages.where("tag = 'T' and error is null").select("slot", "seq", F.posexplode("oids").alias("_at", "oid"))
    named = (relations(messages) if versions is None else versions).select("slot", "oid", full_name(F.col("namespace"), F.col("name")).alias("_name"), "valid_from_seq", "valid_to_seq")
    found = sent.join(named, ["slot", "oid"]).where("seq >= valid_from_seq and (valid_to_seq is null or seq < valid_to_seq)")
    listed = found.groupBy("slot", "seq").agg(F.sort_array(F.collect_list(F.struct("_at", "_name"))).alias("_all"))
    return listed.select("slot", "seq", F.transform("_all", lambda x: x["_name"]).alias("tables"))


def quarantine(messages: DataFrame) -> DataFrame:
    """Payloads that could not be decoded, and changes to a relation the log has not described."""
    rows = resolve(messages)
    lost = F.col("tag").isin(*CHANGES) & F.col("relation").isNull()
    reason = F.coalesce("error", F.when(lost, F.concat(F.lit("protocol: unknown relation "), F.col("oid").cast("string"))))
    return rows.select("slot", "seq", "tag", "oid", reason.alias("reason")).where("reason is not null")


def with_metadata(log: DataFrame, metadata: dict[str, str]) -> DataFrame:
    return log.withColumn("metadata", F.create_map(*[F.lit(x) for kv in metadata.items() for x in kv]))


def columns_by_place(columns: Column, *places: int) -> Column:
    """Names of a relation's columns at these places (from 0); null for a place it does not have."""
    return F.array(*[F.get(columns, F.lit(k))["name"] for k in places])


def column_by_name(columns: Column, name: str) -> Column:
    """A relation's first column of that name: struct<name, type_id, type_modifier, is_key>, or null."""
    return F.get(F.filter(columns, lambda c: c["name"] == name), F.lit(0))
