"""Tables written to the folder all executors share, so that a lost executor costs a reread and not a recompute."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidelog.errors import LogError

_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir.

    Where the session names none, a single-machine session (master local) gets a temporary folder that is deleted when
    the process ends; on a cluster, whose machines do not share one, that is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise LogError("config", "spark.checkpoint.dir must name a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="tidelog-")
        atexit.register(shutil.rmtree, _LOCAL[app], ignore_errors=True)
    return f"file://{_LOCAL[app]}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Writes df as Parquet under the shared folder and reads it back: lineage is cut, columns stay prunable."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(nullable(df.schema)).parquet(path)


@contextmanager
def short_lived(spark: SparkSession, name: str) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """A materialise whose tables are deleted when the block ends; what is made from them has to be written by then."""
    folder = f"{name}-{uuid.uuid4().hex}"
    try:
        yield lambda df, table: materialise(df, f"{folder}/{table}")
    finally:
        _delete(spark, f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{folder}")


def nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])


def clear_scratch(spark: SparkSession) -> None:
    """Deletes what this application materialised; call it when no result of its operators is read any more."""
    _delete(spark, f"{shared_dir(spark)}/{spark.sparkContext.applicationId}")


def _delete(spark: SparkSession, path: str) -> None:
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    root.getFileSystem(spark._jsc.hadoopConfiguration()).delete(root, True)
