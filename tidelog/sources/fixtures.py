"""Change events made by hand, as dicts of the silver columns they set; frame() makes a DataFrame of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

ROW = "array<struct<name:string,kind:string,value:binary>>"
SCHEMA = (
    "slot string, seq long, lsn long, tag string, event_type string, xid long, subxid long, first_segment boolean, final_lsn long, commit_lsn long, prepare_lsn long, "
    "end_lsn long, message_lsn long, abort_lsn long, event_ts timestamp, prepare_event_ts timestamp, relation_oid long, schema string, table string, replica_identity string, "
    "key_type string, key_columns array<string>, primary_key array<string>, column_names array<string>, "
    "relation_columns array<struct<name:string,type_id:long,type_modifier:int,is_key:boolean>>, "
    f"old_row {ROW}, new_row {ROW}, truncate_tables array<string>, flags int, gid string, prefix string, content binary, origin_name string, metadata map<string,string>"
)


def row(**values: str | bytes | None) -> list[tuple[str, str, bytes | None]]:
    """A row: texts are text, bytes binary, None is NULL; what is not named is unchanged."""
    kind = lambda v: ("n", None) if v is None else ("b", v) if isinstance(v, bytes) else ("t", v.encode())
    return [(name, *kind(v)) for name, v in values.items()]


def _change(tag: str, kind: str, schema: str, table: str, oid: int, **others) -> dict:
    return {"tag": tag, "event_type": kind, "schema": schema, "table": table, "relation_oid": oid, "replica_identity": "default"} | others


def insert(schema: str, table: str, oid: int, data: list, lsn: int = 0) -> dict:
    return _change("I", "insert", schema, table, oid, new_row=data, lsn=lsn)


def update(schema: str, table: str, oid: int, old: list | None, new: list, identity: str = "default", keys: list[str] = (), lsn: int = 0) -> dict:
    return _change("U", "update", schema, table, oid, old_row=old, new_row=new, replica_identity=identity, key_columns=list(keys), lsn=lsn)


def delete(schema: str, table: str, oid: int, old: list, identity: str = "default", keys: list[str] = (), lsn: int = 0) -> dict:
    return _change("D", "delete", schema, table, oid, old_row=old, replica_identity=identity, key_columns=list(keys), lsn=lsn)


def truncate(tables: list[str], flags: int = 0, lsn: int = 0) -> dict:
    return {"tag": "T", "event_type": "truncate", "truncate_tables": tables, "flags": flags, "lsn": lsn}


def begin(xid: int, final_lsn: int, ts, lsn: int = 0) -> dict:
    return {"tag": "B", "event_type": "begin", "xid": xid, "final_lsn": final_lsn, "event_ts": ts, "lsn": lsn}


def commit(ts, commit_lsn: int, end_lsn: int, lsn: int = 0) -> dict:
    return {"tag": "C", "event_type": "commit", "event_ts": ts, "commit_lsn": commit_lsn, "end_lsn": end_lsn, "lsn": lsn}


def stream_start(xid: int, first: bool, lsn: int = 0) -> dict:
    return {"tag": "S", "event_type": "stream_start", "xid": xid, "first_segment": first, "lsn": lsn}


def stream_stop(lsn: int = 0) -> dict:
    return {"tag": "E", "event_type": "stream_stop", "lsn": lsn}


def stream_commit(xid: int, commit_lsn: int, end_lsn: int, ts, lsn: int = 0) -> dict:
    return {"tag": "c", "event_type": "stream_commit", "xid": xid, "commit_lsn": commit_lsn, "end_lsn": end_lsn, "event_ts": ts, "lsn": lsn}


def stream_abort(xid: int, subxid: int, abort_lsn: int | None = None, ts=None, lsn: int = 0) -> dict:
    return {"tag": "A", "event_type": "stream_abort", "xid": xid, "subxid": subxid, "abort_lsn": abort_lsn, "event_ts": ts, "lsn": lsn}


def relation(oid: int, schema: str, table: str, columns: list[tuple], identity: str = "default", lsn: int = 0) -> dict:
    return _change("R", "relation", schema, table, oid, relation_columns=columns, replica_identity=identity, lsn=lsn)


def type_(oid: int, schema: str, name: str, lsn: int = 0) -> dict:
    return {"tag": "Y", "event_type": "type", "relation_oid": oid, "schema": schema, "table": name, "lsn": lsn}


def origin(origin_lsn: int, name: str, lsn: int = 0) -> dict:
    return {"tag": "O", "event_type": "origin", "message_lsn": origin_lsn, "origin_name": name, "lsn": lsn}


def message(flags: int, message_lsn: int, prefix: str, content: bytes, lsn: int = 0) -> dict:
    return {"tag": "M", "event_type": "message", "flags": flags, "message_lsn": message_lsn, "prefix": prefix, "content": content, "lsn": lsn}


def prepared(tag: str, xid: int, gid: str, ts, flags: int = 0, lsn: int = 0, **positions: int) -> dict:
    """begin_prepare (b), prepare (P), commit_prepared (K), rollback_prepared (r) or stream_prepare (p), with its positions."""
    kind = {"b": "begin_prepare", "P": "prepare", "K": "commit_prepared", "r": "rollback_prepared", "p": "stream_prepare"}[tag]
    return {"tag": tag, "event_type": kind, "xid": xid, "gid": gid, "event_ts": ts, "flags": flags, "lsn": lsn} | positions


def frame(spark: SparkSession, events: list[dict], slot: str = "s") -> DataFrame:
    names = [f.name for f in spark.createDataFrame([], SCHEMA).schema]
    rows = [tuple(({"slot": slot, "seq": k} | e).get(n) for n in names) for k, e in enumerate(events)]
    return spark.createDataFrame(rows, SCHEMA)
