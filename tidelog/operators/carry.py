"""The last known value before each row of an ordered log, without a window over the whole log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Sequence numbers in one bucket, and buckets in one stretch.
BUCKET, STRETCH = 1 << 13, 1 << 12


def with_bucket(log: DataFrame, size: int = BUCKET) -> DataFrame:
    """Adds _bucket, by which rows of a slot are dealt out; rows of a bucket are read in order of seq. A null slot becomes an empty one."""
    return log.withColumns({"slot": F.coalesce("slot", F.lit("")), "_bucket": F.floor(F.col("seq") / size)})


#: Rows of a log that one task takes in order.
ROWS = 200_000


def dealt(log: DataFrame) -> DataFrame:
    """The log by bucket, in as many partitions as its rows need, so that what a task sorts does not grow with the log."""
    least = int(log.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return log.repartition(max(-(-log.count() // ROWS), least), "slot", "_bucket")


def dealt_by_key(rows: DataFrame, n: int, *by: str) -> DataFrame:
    """n rows, dealt out by key in as many partitions as they need, so that what a task sorts does not grow with them."""
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(max(-(-n // ROWS), least), *by)


def carry_forward(log: DataFrame, values: dict[str, Column], key: str | None = None, before: bool = False) -> DataFrame:
    """Adds a column for each name: its value of the last row at or before this one (or before it) where it is not null.

    Rows of one slot count and, with a key, of one value of it; rows whose key is null get null. The log has slot, seq
    and _bucket; values are longs, so that all aggregates here are hashed. Inside a bucket this is a window over rows
    dealt out by (slot, _bucket), which calls with any key share. What a bucket inherits comes from one pre-aggregated
    row for each bucket and key that occur together, never for those that don't; these rows are ordered in stretches of
    STRETCH buckets, with one row a stretch above them. So no task orders more than a bucket of rows, a stretch of
    buckets, or the stretches of one key. With a key, a bucket inherits a map of the keys that have a value by then, so
    that it is joined by (slot, _bucket) as well.
    """
    by = ["slot", key] if key else ["slot"]
    at, known = ["slot", "_bucket"], F.col(key).isNotNull() if key else F.lit(True)
    marked = log.withColumns({f"_v_{n}": v.cast("long") for n, v in values.items()})
    last = lambda n, c, order: F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(f"_e_{n}")
    heads = marked.where(known).groupBy(*by, "_bucket").agg(*[last(n, f"_v_{n}", "seq") for n in values])
    heads = heads.withColumn("_stretch", F.floor(F.col("_bucket") / STRETCH))
    tops = heads.groupBy(*by, "_stretch").agg(*[last(n, f"_e_{n}", "_bucket") for n in values])
    earlier = lambda part, order, n: F.last(f"_e_{n}", ignorenulls=True).over(W.partitionBy(*part).orderBy(order).rowsBetween(W.unboundedPreceding, -1))
    tops = tops.select(*by, "_stretch", *[earlier(by, "_stretch", n).alias(f"_t_{n}") for n in values])
    heads = heads.withColumns({f"_b_{n}": earlier([*by, "_stretch"], "_bucket", n) for n in values}).join(tops, [*by, "_stretch"])
    inherited = {n: F.coalesce(f"_b_{n}", f"_t_{n}") for n in values}
    inside = W.partitionBy("slot", "_bucket", *by[1:]).orderBy("seq").rowsBetween(W.unboundedPreceding, -1 if before else 0)
    out = marked.withColumns({f"_h_{n}": F.last(f"_v_{n}", ignorenulls=True).over(inside) for n in values})
    if key:
        some = heads.select(*at, F.col(key).alias("_k"), *[c.alias(n) for n, c in inherited.items()]).where(F.coalesce(*[F.col(n) for n in values]).isNotNull())
        each = some.groupBy(*at).agg(F.map_from_entries(F.collect_list(F.struct("_k", F.struct(*values)))).alias("_all"))
        out = out.join(each, at, "left")
        found = {n: F.when(known, F.coalesce(f"_h_{n}", F.try_element_at("_all", F.col(key))[n])) for n in values}
    else:
        out = out.join(heads.select(*at, *[c.alias(f"_i_{n}") for n, c in inherited.items()]), at, "left")
        found = {n: F.coalesce(f"_h_{n}", f"_i_{n}") for n in values}
    return out.select(*log.columns, *[c.alias(n) for n, c in found.items()])


#: How the value of a bucket adds to what came before it.
_JOINED = {"sum": lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)), "max": F.greatest}


def running(log: DataFrame, values: dict[str, tuple[str, Column]], before: bool = False, order: str = "seq") -> DataFrame:
    """Adds a column for each name: the sum or max ("sum", "max") of its values of the slot's rows up to this one (or before it).

    The log has slot, the order's column and _bucket. As in carry_forward(), a task orders the rows of a bucket, the
    buckets of a stretch, or the stretches of a slot, and a bucket's value joins what the ones before it come to. A sum
    over nothing is 0, a max is null.
    """
    fold = lambda kind, c: getattr(F, kind)(c)
    cells = {f"_v_{n}": v for n, (_, v) in values.items()}
    heads = log.withColumns(cells).groupBy("slot", "_bucket").agg(*[fold(k, f"_v_{n}").alias(f"_e_{n}") for n, (k, _) in values.items()])
    heads = heads.withColumn("_stretch", F.floor(F.col("_bucket") / STRETCH))
    tops = heads.groupBy("slot", "_stretch").agg(*[fold(k, f"_e_{n}").alias(f"_e_{n}") for n, (k, _) in values.items()])
    earlier = lambda part, at, n, k: fold(k, f"_e_{n}").over(W.partitionBy(*part).orderBy(at).rowsBetween(W.unboundedPreceding, -1))
    tops = tops.select("slot", "_stretch", *[earlier(["slot"], "_stretch", n, k).alias(f"_t_{n}") for n, (k, _) in values.items()])
    heads = heads.withColumns({f"_b_{n}": earlier(["slot", "_stretch"], "_bucket", n, k) for n, (k, _) in values.items()}).join(tops, ["slot", "_stretch"])
    heads = heads.select("slot", "_bucket", *[_JOINED[k](F.col(f"_b_{n}"), F.col(f"_t_{n}")).alias(f"_i_{n}") for n, (k, _) in values.items()])
    inside = W.partitionBy("slot", "_bucket").orderBy(order).rowsBetween(W.unboundedPreceding, -1 if before else 0)
    rows = log.withColumns({f"_h_{n}": fold(k, v).over(inside) for n, (k, v) in values.items()}).join(heads, ["slot", "_bucket"])
    return rows.select(*log.columns, *[_JOINED[k](F.col(f"_h_{n}"), F.col(f"_i_{n}")).alias(n) for n, (k, _) in values.items()])


#: Segments' heads up to which they are broadcast.
FEW_HEADS = 1_000_000


def along_keys(rows: DataFrame, by: list[str], order: list[str], highest: dict[str, Column], lowest_after: dict[str, Column] | None = None, cut: bool = True) -> DataFrame:
    """Adds a column for each name: the highest value of the key's rows up to this one, or the lowest of those behind it.

    Values are structs led by the place of their row, so that the highest is the last known one and the lowest behind a
    row the next. That composes: what is known at the end of a segment of a key's rows is the higher of what its own rows
    say and what was known before. rows have _segment, null where a key's rows are one piece; else a task orders a
    segment of a key, STRETCH segments' heads, or a key's stretches. cut=False says that no key has segments.
    """
    after = lowest_after or {}
    both = {n: (F.max, F.greatest, W.unboundedPreceding, -1) for n in highest} | {n: (F.min, F.least, 1, W.unboundedFollowing) for n in after}
    marked = rows.withColumns({f"_v_{n}": v for n, v in (highest | after).items()})
    inside = W.partitionBy(*by, "_segment").orderBy(*order)
    frame = lambda n: inside.rowsBetween(W.unboundedPreceding, 0) if n in highest else inside.rowsBetween(1, W.unboundedFollowing)
    found = marked.withColumns({f"_h_{n}": fold(f"_v_{n}").over(frame(n)) for n, (fold, *_) in both.items()})
    if not cut:
        return found.select(*[c for c in rows.columns if c not in both], *[F.col(f"_h_{n}").alias(n) for n in both])
    heads = marked.where("_segment is not null").groupBy(*by, "_segment").agg(*[fold(f"_v_{n}").alias(f"_e_{n}") for n, (fold, *_) in both.items()]).withColumn("_stretch", F.floor(F.col("_segment") / STRETCH))
    tops = heads.groupBy(*by, "_stretch").agg(*[fold(f"_e_{n}").alias(f"_e_{n}") for n, (fold, *_) in both.items()])
    outside = lambda part, at, n: both[n][0](f"_e_{n}").over(W.partitionBy(*part).orderBy(at).rowsBetween(*both[n][2:]))
    tops = tops.select(*by, "_stretch", *[outside(by, "_stretch", n).alias(f"_t_{n}") for n in both])
    heads = heads.withColumns({f"_b_{n}": outside([*by, "_stretch"], "_segment", n) for n in both}).join(tops, [*by, "_stretch"])
    heads = heads.select(*by, "_segment", *[join(f"_b_{n}", f"_t_{n}").alias(f"_i_{n}") for n, (_, join, *_) in both.items()])
    found = found.join(broadcast_if_few(heads, F.lit(1), FEW_HEADS), [*by, "_segment"], "left")
    return found.select(*[c for c in rows.columns if c not in both], *[join(f"_h_{n}", f"_i_{n}").alias(n) for n, (_, join, *_) in both.items()])


def broadcast_if_few(frame: DataFrame, weight: Column, most: int) -> DataFrame:
    """The frame, marked for broadcast if its rows weigh at most so much together; else as it is, to be joined by a shuffle."""
    total = frame.agg(F.sum(weight)).first()[0] or 0
    return F.broadcast(frame) if total <= most else frame
