"""Routing of events to handlers by table and kind."""

from __future__ import annotations

from collections.abc import Callable
from typing import get_args, get_type_hints

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.operators.project import Field, data_row, strict


class Router:
    """Handlers by unqualified table name and event kind; a later registration replaces an earlier one.

    Events without a handler go to the default, or nowhere if there is none.
    """

    def __init__(self):
        self.handlers: dict[tuple[str, str], str] = {}
        self.typed: dict[str, tuple[list[Field] | None, Callable[[DataFrame], None]]] = {}
        self.default: str | None = None

    def on(self, table: str, kind: str, handler: str, fields: list[Field] | None = None, run: Callable[[DataFrame], None] | None = None) -> Router:
        if kind not in ("insert", "update", "delete"):
            raise ValueError(f"no handler for {kind}")
        self.handlers[table, kind] = handler
        if run:
            self.typed[handler] = (fields, run)
        return self

    def on_default(self, handler: str, run: Callable[[DataFrame], None] | None = None) -> Router:
        self.default = handler
        if run:
            self.typed[handler] = (None, run)
        return self

    def on_table(self, row: type, kind: str, run: Callable[[DataFrame], None], handler: str | None = None) -> Router:
        """A typed handler for the table that a class is bound to by wal_table(); its rows have the class's annotations as columns."""
        if not getattr(row, "wal_table", None):
            raise ValueError(f"{row.__name__} is bound to no table")
        return self.on(row.wal_table, kind, handler or f"{row.__name__}.{kind}", fields_of(row), run)

    def handler(self) -> Column:
        """Name of an event's handler, null for none."""
        out = F.lit(self.default).cast("string")
        for (table, kind), name in self.handlers.items():
            out = F.when((F.col("table") == table) & (F.col("event_type") == kind), name).otherwise(out)
        return out

    def routed(self, events: DataFrame) -> DataFrame:
        return events.withColumn("handler", self.handler()).where("handler is not null")

    def run(self, events: DataFrame, batch_id: int | None = None) -> None:
        """Calls each handler once with its events, typed where it has fields; for foreachBatch and for batches."""
        routed = self.routed(events).persist()
        try:
            for name, (fields, act) in self.typed.items():
                rows = routed.where(F.col("handler") == name)
                if fields is not None:
                    row = data_row(F.col("tag"), F.col("old_row"), F.col("new_row"))
                    rows = strict(rows.select("slot", "seq", "event_type", row.alias("row")), fields)
                act(rows)
        finally:
            routed.unpersist()


def wal_table(name: str) -> Callable[[type], type]:
    """Class decorator that names the table whose rows a class stands for; its annotations are the fields."""
    if not name:
        raise ValueError("a table needs a name")

    def bind(cls: type) -> type:
        cls.wal_table = name
        return cls

    return bind


#: Kind of a field by its annotation.
KINDS = {int: "i64", float: "f64", bool: "bool", str: "string", bytes: "bytes"}


def fields_of(row: type) -> list[Field]:
    """The fields a class's annotations stand for; X | None is one that may be NULL, a class attribute its default."""
    out = []
    for name, kind in get_type_hints(row).items():
        some = [k for k in get_args(kind) if k is not type(None)] or [kind]
        if some[0] not in KINDS:
            raise ValueError(f"{name} has no kind for {kind}")
        out.append(Field(name, KINDS[some[0]], optional=len(some) < len(get_args(kind)), default=getattr(row, name, None)))
    return out


def categories(events: DataFrame) -> DataFrame:
    return events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


def of_tables(events: DataFrame, *names: str) -> DataFrame:
    """Events of these tables and all that concern no table; asks for schema.table or the table alone."""
    name = F.concat_ws(".", "schema", "table")
    return events.where(F.col("table").isNull() | F.col("table").isin(*names) | name.isin(*names))
