"""The layers a query reads, each written once a session to the shared folder: bytes, messages, events with transactions.

log names the change log: orders (tidelog.sources.changelog) or parts (tidelog.sources.partlog). Layers are kept by
application and folder; the folder's tables are taken not to change in between, forget() drops what is kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidelog.operators import events as E
from tidelog.operators import txn
from tidelog.operators.decode import decode
from tidelog.sources import changelog, partlog
from tidelog.sources.scratch import materialise

_WRITTEN: dict[tuple[str, str, str], DataFrame] = {}


_LOGS = {"orders": changelog, "parts": partlog}


def _layer(spark: SparkSession, sf_dir: str, name: str, log: str, make: Callable[[], DataFrame]) -> DataFrame:
    """Every layer is read by several branches of a plan; as a table it is computed once and costs a scan of the columns read."""
    key = (spark.sparkContext.applicationId, sf_dir, f"{log}-{name}")
    if key not in _WRITTEN:
        _WRITTEN[key] = materialise(make(), f"{log}-{name}")
    return _WRITTEN[key]


def forget() -> None:
    _WRITTEN.clear()


def bronze(spark: SparkSession, sf_dir: str, log: str = "orders") -> DataFrame:
    return _layer(spark, sf_dir, "bronze", log, lambda: _LOGS[log].bronze(spark, sf_dir))


def messages(spark: SparkSession, sf_dir: str, log: str = "orders") -> DataFrame:
    return _layer(spark, sf_dir, "messages", log, lambda: decode(bronze(spark, sf_dir, log), _LOGS[log].VERSION))


def events(spark: SparkSession, sf_dir: str, log: str = "orders") -> DataFrame:
    """Events with their transactions."""
    m = messages(spark, sf_dir, log)
    return _layer(spark, sf_dir, "events", log, lambda: E.events(m, txn.assign(m)))


assigned = events


def committed(spark: SparkSession, sf_dir: str, log: str = "orders") -> DataFrame:
    return _layer(spark, sf_dir, "committed", log, lambda: txn.committed(assigned(spark, sf_dir, log)))
