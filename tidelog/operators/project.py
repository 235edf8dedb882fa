"""Typed rows: strict projection raises, lenient projection fills a default and lists what was wrong."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.errors import LogError
from tidelog.functions import scalars as S
from tidelog.functions.lsn import unsigned

#: Default of each target in lenient projection. Fixed values.
DEFAULTS = dict.fromkeys([*S.SIGNED, *S.UNSIGNED], 0) | {"f32": 0.0, "f64": 0.0, "bool": False, "char": "\0", "string": "", "bytes": b""}


@dataclass(frozen=True)
class Field:
    """A column of the typed row: target kind, source column, whether NULL is a value, and what a missing column becomes."""

    name: str
    kind: str
    source: str | None = None
    optional: bool = False
    default: object = None
    variants: tuple[str, ...] = ()

    @property
    def column(self) -> str:
        return self.source or self.name


def spark_type(kind: str) -> str:
    if kind in S.SIGNED:
        return S.SIGNED[kind][1]
    if kind in S.UNSIGNED:
        return S.UNSIGNED[kind][1]
    return {"f32": "float", "f64": "double", "bool": "boolean", "bytes": "binary"}.get(kind, "string")


def _parse(value: Column, text: Column, f: Field) -> Column:
    if f.kind in S.SIGNED:
        return S.parse_signed(text, f.kind)
    if f.kind in S.UNSIGNED:
        return S.parse_unsigned(text, f.kind)
    if f.kind in ("f32", "f64"):
        return S.parse_float(text, f.kind)
    if f.kind == "bool":
        return S.parse_bool(text)
    if f.kind == "char":
        return S.parse_char(text)
    if f.kind == "bytes":
        return F.when(value["kind"] != "n", S.raw_bytes(value))
    if f.kind == "enum":
        return F.when(text.isin(*f.variants), text)
    return text


def _message(value: Column, text: Column, known: Column, f: Field) -> Column:
    """Why a value is not one of the target, null if it is. Fixed formats."""
    kind = {"string": "String", "bytes": "bytes"}.get(f.kind, f.kind)
    bad = {
        "bool": F.concat(F.lit("cannot parse '"), text, F.lit("' as bool (expected t/f/true/false/1/0/on/off/yes/no)")),
        "char": F.concat(F.lit("expected single char, got '"), text, F.lit("'")),
        "enum": F.concat(F.lit("unknown variant `"), text, F.lit("`")),
    }.get(f.kind, F.concat(F.lit("failed to parse '"), text, F.lit(f"' as {kind}")))
    null = F.lit(None).cast("string") if f.optional else F.lit(f"cannot deserialize NULL as {kind} (use Option<{kind}>)")
    missing = F.lit(None).cast("string") if f.optional or f.default is not None else F.lit(f"missing field `{f.name}`")
    wrong = F.when(text.isNull(), F.lit(f"invalid UTF-8 for {kind}")).otherwise(bad)
    said = F.when(value.isNull(), missing).when(value["kind"] == "n", null)
    if f.kind != "bytes":
        said = said.when(value["kind"] == "b", F.lit(f"cannot deserialize binary column as {kind}"))
    return said.when(known.isNull(), wrong)


def _default(f: Field) -> Column:
    value = f.default if f.default is not None else DEFAULTS.get(f.kind)
    return F.lit(value).cast(spark_type(f.kind))


def _parsed(rows: DataFrame, fields: list[Field], row: str, mark: str = "") -> DataFrame:
    """Adds _v, _x and _p with a field's number: its value, text and parsed value, each found once, in steps that the optimiser keeps apart."""
    numbered = [(f"{mark}{k}", f) for k, f in enumerate(fields)]
    rows = rows.withColumns({f"_v{k}": S.get(F.col(f"`{row}`"), f.column) for k, f in numbered})
    rows = rows.withColumns({f"_x{k}": S.text(F.col(f"_v{k}")) for k, _ in numbered})
    return rows.withColumns({f"_p{k}": _parse(F.col(f"_v{k}"), F.col(f"_x{k}"), f) for k, f in numbered})


def _typed(fields: list[Field], mark: str = "") -> list[Column]:
    """Strict columns of the fields that _parsed() has gone over."""
    out = []
    for k, f in enumerate(fields):
        value, text, parsed = (F.col(f"_{c}{mark}{k}") for c in "vxp")
        known = F.when(value.isNull(), F.lit(f.default).cast(spark_type(f.kind))).otherwise(parsed)
        said = _message(value, text, parsed, f)
        fails = F.raise_error(F.concat(F.lit(f"{f.name}: "), said)).cast(spark_type(f.kind))
        out.append(F.when(parsed.isNull() & said.isNotNull(), fails).otherwise(known).alias(f.name))
    return out


def strict(rows: DataFrame, fields: list[Field], row: str = "row") -> DataFrame:
    """The other columns and one typed column per field; the first value that is not of its type fails the query."""
    return _parsed(rows, fields, row).select(*[F.col(f"`{c}`") for c in rows.columns if c != row], *_typed(fields))


def typed_changes(events: DataFrame, kind: str, fields: list[Field]) -> DataFrame:
    """slot, seq and the typed rows of events of one kind (insert, update or delete): new, and old for updates and deletes.

    old is null for an update without an old row. An event of another kind fails the query.
    """
    if kind not in ("insert", "update", "delete"):
        raise LogError("deserialize", f"no rows in {kind}")
    said = F.concat(F.lit(f"expected {kind.capitalize()} event, got "), F.coalesce("event_type", F.lit("none")))
    right = F.when(F.col("event_type").eqNullSafe(F.lit(kind)), F.col("seq")).otherwise(F.raise_error(said).cast("long"))
    rows = events.select("slot", right.alias("seq"), "old_row", "new_row")
    out = []
    for name, there in (("old", kind != "insert"), ("new", kind != "delete")):
        if there:
            rows = _parsed(rows, fields, f"{name}_row", name)
            typed = F.struct(*_typed(fields, name))
            out.append((F.when(F.col("old_row").isNotNull(), typed) if kind == "update" and name == "old" else typed).alias(name))
    return rows.select("slot", "seq", *out)


def lenient(rows: DataFrame, fields: list[Field], row: str = "row") -> DataFrame:
    """Typed columns and errors: array<struct<field, message>> in the order of the row's columns; enums fail the query all the same."""
    out, errors = [], []
    for k, f in enumerate(fields):
        value, text, parsed = (F.col(f"_{c}{k}") for c in "vxp")
        said = _message(value, text, parsed, f)
        null = F.lit(None).cast(spark_type(f.kind)) if f.optional else _default(f)
        fallback = F.raise_error(F.concat(F.lit(f"{f.name}: "), said)).cast("string") if f.kind == "enum" else _default(f)
        none = value.isNull() if f.default is not None else F.lit(False)
        good = F.when(none, _default(f)).when(value.isNull() | (value["kind"] == "n"), null).otherwise(F.coalesce(parsed, fallback))
        out.append(good.alias(f.name))
        place = F.coalesce(F.array_position(F.transform(f"`{row}`", lambda c: c["name"]), f.column), F.lit(0))
        errors.append(F.when(said.isNotNull(), F.struct(place.alias("at"), F.lit(f.name).alias("field"), said.alias("message"))))
    found = F.transform(F.array_sort(F.array_compact(F.array(*errors))), lambda e: F.struct(e["field"].alias("field"), e["message"].alias("message")))
    return _parsed(rows, fields, row).select(*[F.col(f"`{c}`") for c in rows.columns if c != row], *out, found.alias("errors"))


def is_clean(errors: Column) -> Column:
    return F.size(errors) == 0


def into_result(rows: DataFrame) -> DataFrame:
    """Lenient rows without their errors; a row that has any fails the query with the first of them."""
    first = F.get("errors", F.lit(0))
    fails = F.raise_error(F.concat(first["field"], F.lit(": "), first["message"])).cast("array<struct<field:string,message:string>>")
    return rows.withColumn("errors", F.when(is_clean(F.col("errors")), F.col("errors")).otherwise(fails)).where(F.size("errors") >= 0).drop("errors")


def data_row(tag: Column, old: Column, new: Column) -> Column:
    """The row of a change: new for inserts and updates, old for deletes."""
    return F.when(tag == "D", old).when(tag.isin("I", "U"), new)


def as_map(row: Column) -> Column:
    """Row to map<string,string>; NULL and binary values become null. Of equal names the first counts."""
    firsts = F.filter(row, lambda c, i: F.array_position(F.transform(row, lambda x: x["name"]), c["name"]) == i + 1)
    return F.map_from_entries(F.transform(firsts, lambda c: F.struct(c["name"], S.text(c))))


def row_json(row: Column) -> Column:
    """Row as a JSON object in column order: text as a string, NULL as null, other bytes as {"$binary":"hex"}."""
    read = F.transform(row, lambda c: F.struct(_quoted(c["name"]).alias("name"), c["kind"].alias("kind"), S.text(c).alias("text"), c["value"].alias("value")))

    def value(c: Column) -> Column:
        binary = F.concat(F.lit('{"$binary":"'), S.hex_encode(c["value"]), F.lit('"}'))
        return F.when(c["kind"] == "n", F.lit("null")).when(c["text"].isNotNull(), _quoted(c["text"])).otherwise(binary)

    return F.concat(F.lit("{"), F.array_join(F.transform(read, lambda c: F.concat(c["name"], F.lit(":"), value(c))), ","), F.lit("}"))


def row_from_json(json: Column) -> Column:
    """The row of a JSON object as row_json() writes it: strings are text, null is NULL, {"$binary":"hex"} is binary.

    Null for anything that is no object, and for other values. Text that was no UTF-8 comes back as binary.
    """
    entries = F.map_entries(F.from_json(json, "map<string,variant>"))

    def value(e: Column) -> Column:
        v, kind = e["value"], F.schema_of_variant(e["value"])
        digits = F.try_variant_get(v, "$['$binary']", "string")
        cell = lambda k, x: F.struct(e["key"].alias("name"), F.lit(k).alias("kind"), x.cast("binary").alias("value"))
        binary = F.when(S.hex_decode(digits).isNotNull(), cell("b", S.hex_decode(digits)))
        return F.when(v.isNull() | F.is_variant_null(v), cell("n", F.lit(None))).when(kind == "STRING", cell("t", F.try_variant_get(v, "$", "string"))).otherwise(binary)

    # as the one element of an array the row is found once for both uses
    whole = F.transform(F.array(F.transform(entries, value)), lambda r: F.when(F.forall(r, lambda c: c.isNotNull()), r))
    return F.get(whole, F.lit(0))


def _quoted(text: Column) -> Column:
    """A text in quotes, null as null. The brackets are outside of the quotes, so that trimming leaves those of the text."""
    return F.btrim(F.to_json(F.array(text)), F.lit("[]"))


def _object(fields: dict[str, Column]) -> Column:
    parts = [F.concat(F.lit(f'"{name}":'), F.coalesce(value.cast("string"), F.lit("null"))) for name, value in fields.items()]
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def _list(values: Column, one: Callable[[Column], Column]) -> Column:
    return F.concat(F.lit("["), F.array_join(F.transform(values, one), ","), F.lit("]"))


def _instant(ts: Column) -> Column:
    """A timestamp in quotes, in UTC, with no, three or six digits of a second."""
    micros = F.pmod(F.unix_micros(ts), F.lit(1_000_000))
    part = F.when(micros == 0, "").when(micros % 1000 == 0, F.format_string(".%03d", (micros / 1000).cast("long"))).otherwise(F.format_string(".%06d", micros))
    return F.concat(F.lit('"'), F.date_format(F.convert_timezone(None, F.lit("UTC"), ts.cast("timestamp_ntz")), "yyyy-MM-dd'T'HH:mm:ss"), part, F.lit('Z"'))


def event_json() -> Column:
    """A change event as JSON, from the silver columns: {"event_type":{kind:{..}},"lsn":..,"metadata":..}. Names are fixed values."""
    c, text, lsn = F.col, lambda name: _quoted(F.col(name)), lambda name: unsigned(F.col(name))
    identity = _quoted(F.initcap("replica_identity"))
    names = lambda name: _list(F.col(name), _quoted)
    row = lambda name: F.when(c(name).isNotNull(), row_json(c(name)))
    of_table = {"schema": text("schema"), "table": text("table"), "relation_oid": c("relation_oid")}
    of_key = {"replica_identity": identity, "key_columns": names("key_columns")}
    column = lambda x: _object({"name": _quoted(x["name"]), "type_id": x["type_id"], "type_modifier": x["type_modifier"], "is_key": x["is_key"]})
    content = F.transform(F.when(F.length("content") > 0, F.sequence(F.lit(1), F.length("content"))).otherwise(F.array().cast("array<int>")), lambda k: F.conv(F.hex(F.substring(c("content"), k, F.lit(1))), 16, 10))
    at, xid, flags, gid = _instant(c("event_ts")), {"transaction_id": c("xid")}, {"flags": c("flags")}, {"gid": text("gid")}
    ends = {"commit_lsn": lsn("commit_lsn"), "end_lsn": lsn("end_lsn")}
    prepared = {"prepare_lsn": lsn("prepare_lsn"), "end_lsn": lsn("end_lsn"), "prepare_timestamp": at} | gid
    kinds = {
        "I": ("Insert", of_table | {"data": row("new_row")}),
        "U": ("Update", of_table | {"old_data": row("old_row"), "new_data": row("new_row")} | of_key),
        "D": ("Delete", of_table | {"old_data": row("old_row")} | of_key),
        "B": ("Begin", xid | {"final_lsn": lsn("final_lsn"), "commit_timestamp": at}),
        "C": ("Commit", {"commit_timestamp": at} | ends),
        "S": ("StreamStart", xid | {"first_segment": c("first_segment")}),
        "c": ("StreamCommit", xid | ends | {"commit_timestamp": at}),
        "A": ("StreamAbort", xid | {"subtransaction_xid": c("subxid"), "abort_lsn": lsn("abort_lsn"), "abort_timestamp": at}),
        "R": ("Relation", {"relation_id": c("relation_oid"), "namespace": text("schema"), "relation_name": text("table"), "replica_identity": identity, "columns": _list(c("relation_columns"), column)}),
        "Y": ("Type", {"type_id": c("relation_oid"), "namespace": text("schema"), "type_name": text("table")}),
        "O": ("Origin", {"origin_lsn": lsn("message_lsn"), "origin_name": text("origin_name")}),
        "M": ("Message", flags | {"message_lsn": lsn("message_lsn"), "prefix": text("prefix"), "content": _list(content, lambda x: x)}),
        "b": ("BeginPrepare", xid | prepared),
        "P": ("Prepare", flags | xid | prepared),
        "K": ("CommitPrepared", flags | xid | ends | {"commit_timestamp": at} | gid),
        "r": ("RollbackPrepared", flags | xid | {"prepare_end_lsn": lsn("prepare_lsn"), "rollback_end_lsn": lsn("end_lsn"), "prepare_timestamp": _instant(c("prepare_event_ts")), "rollback_timestamp": at} | gid),
        "p": ("StreamPrepare", flags | xid | prepared),
    }
    body = F.when(c("tag") == "E", F.lit('"StreamStop"')).when(c("tag") == "T", _object({"Truncate": names("truncate_tables")}))
    for tag, (name, fields) in kinds.items():
        body = body.when(c("tag") == tag, _object({name: _object(fields)}))
    return _object({"event_type": body, "lsn": lsn("lsn"), "metadata": F.to_json("metadata")})
