"""Column values, rows and identifiers as Column expressions.

A value is struct<kind, value>: kind n is NULL, t text, b binary. A row is an array of struct<name, kind, value>; a
column that is not there was unchanged.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Wire byte and name. Fixed values.
REPLICA_IDENTITY = {"d": "default", "n": "nothing", "f": "full", "i": "index"}
TRUE, FALSE = ("t", "1", "true", "on", "yes"), ("f", "0", "false", "off", "no")
SIGNED = {"i8": (7, "tinyint"), "i16": (15, "smallint"), "i32": (31, "int"), "i64": (63, "bigint")}
UNSIGNED = {"u8": (8, "smallint"), "u16": (16, "int"), "u32": (32, "bigint"), "u64": (64, "decimal(20,0)")}
_FLOAT = r"^[+-]?(inf|infinity|nan|([0-9]+(\.[0-9]*)?|\.[0-9]+)(e[+-]?[0-9]+)?)$"


def replica_identity(byte: Column) -> Column:
    """Name of a wire byte; null for an unknown one."""
    out = F.lit(None).cast("string")
    for k, name in REPLICA_IDENTITY.items():
        out = F.when(byte == k, name).otherwise(out)
    return out


def replica_identity_byte(name: Column) -> Column:
    out = F.lit(None).cast("string")
    for k, n in REPLICA_IDENTITY.items():
        out = F.when(name == n, k).otherwise(out)
    return out


def text(value: Column) -> Column:
    """The string of a text value in valid UTF-8; null for any other."""
    return F.when(value["kind"] == "t", F.try_validate_utf8(value["value"].cast("string")))


def raw_bytes(value: Column) -> Column:
    return F.coalesce(value["value"], F.lit(b""))


def same_value(a: Column, b: Column) -> Column:
    """Same kind and bytes; NULL equals NULL, text never binary."""
    return a["kind"].eqNullSafe(b["kind"]) & a["value"].eqNullSafe(b["value"])


def display(value: Column) -> Column:
    said = F.coalesce(text(value), F.format_string("<invalid utf-8: %d bytes>", F.octet_length(value["value"])))
    return F.when(value["kind"] == "n", "NULL").when(value["kind"] == "t", said).when(value["kind"] == "b", F.concat(F.lit("\\x"), hex_encode(value["value"])))


def hex_encode(value: Column) -> Column:
    return F.lower(F.hex(value))


def hex_decode(digits: Column) -> Column:
    """Bytes of an even number of hexadecimal digits; null for anything else."""
    return F.when(digits.rlike("^([0-9A-Fa-f]{2})*$"), F.unhex(digits))


def get(row: Column, name: str) -> Column:
    """First value of that name; null if the row has none."""
    return F.get(F.filter(row, lambda c: c["name"] == name), F.lit(0))


def parse_signed(s: Column, kind: str) -> Column:
    """Optional sign and digits within the type's range; null for anything else."""
    bits, spark_type = SIGNED[kind]
    number = F.when(s.rlike(r"^[+-]?0*[0-9]{1,20}$"), s.try_cast("decimal(38,0)"))
    return F.when((number >= F.lit(Decimal(-(1 << bits)))) & (number <= F.lit(Decimal((1 << bits) - 1))), number.cast(spark_type))


def parse_unsigned(s: Column, kind: str) -> Column:
    bits, spark_type = UNSIGNED[kind]
    number = F.when(s.rlike(r"^\+?0*[0-9]{1,20}$"), s.try_cast("decimal(38,0)"))
    return F.when(number <= F.lit(Decimal((1 << bits) - 1)), number.cast(spark_type))


def parse_float(s: Column, kind: str = "f64") -> Column:
    """Decimal notation, or inf, infinity and nan in any case with a sign."""
    low = F.lower(s)
    word = F.regexp_extract(low, "^([+-]?)(inf|infinity|nan)$", 2)
    special = F.when(word == "nan", float("nan")).when(word != "", F.when(low.startswith("-"), float("-inf")).otherwise(float("inf")))
    number = F.when(low.rlike(_FLOAT), F.coalesce(special, low.try_cast("double")))
    return number.cast("float") if kind == "f32" else number


def parse_bool(s: Column) -> Column:
    return F.when(s.isin(*TRUE), True).when(s.isin(*FALSE), False)


def parse_char(s: Column) -> Column:
    return F.when(F.char_length(s) == 1, s)


def server_version(s: Column) -> Column:
    """16 -> 160000, 16.1 -> 160001, 14.2.1 -> 140201; parts that are no number count 0."""
    parts = F.split(F.coalesce(F.get(F.split(F.ltrim(s), r"\s+"), F.lit(0)), F.lit("")), r"\.")
    part = lambda k: F.coalesce(F.when(F.get(parts, F.lit(k)).rlike(r"^[+-]?[0-9]{1,9}$"), F.get(parts, F.lit(k)).try_cast("int")), F.lit(0))
    return F.when(F.size(parts) == 1, part(0) * 10000).when(F.size(parts) == 2, part(0) * 10000 + part(1)).otherwise(part(0) * 10000 + part(1) * 100 + part(2))


def quote_ident(s: Column) -> Column:
    return F.concat(F.lit('"'), F.replace(s, F.lit('"'), F.lit('""')), F.lit('"'))


def quote_literal(s: Column) -> Column:
    """Single quotes doubled; a backslash makes it ` E'...'` with backslashes doubled."""
    quoted = F.concat(F.lit("'"), F.replace(F.replace(s, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("''")), F.lit("'"))
    return F.when(F.contains(s, F.lit("\\")), F.concat(F.lit(" E"), quoted)).otherwise(quoted)


def mask_password(s: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(s, r"(://[^:/@]+:)[^@]*@", "$1***@"), r"(password\s*=\s*)('[^']*'|\S+)", "$1***")


def slot_type_name(logical: Column) -> Column:
    """LOGICAL or PHYSICAL. Fixed values."""
    return F.when(logical, "LOGICAL").when(~logical, "PHYSICAL")


def wire_text(value: Column) -> Column:
    """A wire column's string, of text and binary values alike, with bytes that are no UTF-8 replaced; null for an empty one."""
    some = value["kind"].isin("t", "b") & (F.octet_length(value["value"]) > 0)
    return F.when(some, F.make_valid_utf8(value["value"].cast("string")))


def is_null(value: Column) -> Column:
    return value["kind"] == "n"


def is_text(value: Column) -> Column:
    return value["kind"] == "t"


def is_binary(value: Column) -> Column:
    return value["kind"] == "b"


def is_unchanged(value: Column) -> Column:
    """Of a wire column: kind u; of a row's value: not there."""
    return value.isNull() | (value["kind"] == "u")


def row_names(row: Column) -> Column:
    return F.transform(row, lambda c: c["name"])


def is_empty(row: Column) -> Column:
    return F.size(row) == 0


def same_row(a: Column, b: Column) -> Column:
    """Equal names, kinds and bytes in the same order."""
    return a.eqNullSafe(b)
