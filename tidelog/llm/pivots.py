"""Embedding near-duplicates by a pivot-permutation index.

Reference points (pivots) are vectors drawn by hash from the table, for each length of vectors a number that grows with
the root of theirs, no two of them close to each other: a group of near copies owns one pivot, however large it is, and its members' lists agree. Every
vector is described by its nearest pivots in order, by cosine. Inverted lists hold the vectors of one label that name a
pivot. Two vectors are candidates if they share enough pivots, or one that is close to both; each pair is looked at in
the list of the lowest pivot they share, and its cosine is verified in double precision.

A list that is long is dealt out again by the next pivot its vectors name, where a pair meets under the second lowest
pivot it shares, and by closeness to the list's own pivot for pairs that share no other. Only what is long even then,
vectors that agree on two pivots or lie close to one, is compared block against block. So a list is many bounded tasks,
and what leaves a task is counts and a spanning forest, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.sources.scratch import materialise

from .components import components

COSINE = 0.93
#: Nearest pivots that describe a vector, and how many two vectors must share.
NEAREST, SHARED = 6, 2
#: Pivots: the root of the number of vectors times this, within these bounds and so many bytes, as every worker has them.
PER_ROOT, FEWEST, MOST, PIVOT_BYTES = 2.0, 16, 65_536, 32 << 20
#: Cosine from which a pivot is close: no two pivots are, and vectors with a close pivot in common need no second one.
CLOSE = 0.8
#: Vectors looked at for each pivot wanted.
DRAWS = 2
#: Rows of a block of an inverted list, and rows from which on a list is dealt out again.
BLOCK, LONG = 512, 2048
#: Lists that are not dealt out again, and those of vectors close to the list's pivot.
WHOLE, NEARBY = -1, -2
#: Fill of a vector's pivots after the last one.
NOTHING = -(1 << 31)


def usable(vectors: DataFrame, vec_id: str, embedding: str, label: str) -> DataFrame:
    """(vec_id, label, v) of the rows that can link: label and vector not null, components finite, norm above zero."""
    single = vectors.schema[embedding].dataType.simpleString() == "array<float>"
    v = F.col(embedding).cast("array<float>" if single else "array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"), v.alias("v"))
    return rows.where(F.col("label").isNotNull() & F.col("v").isNotNull()).where(fine)


def draw_pivots(nodes: DataFrame) -> dict[int, tuple[int, np.ndarray]]:
    """For each frequent length of vectors: the number of its first pivot, and its pivots as unit rows.

    Pivots are of a bounded sample of the distinct vectors, by hash, those that are close to none before them; where these
    are fewer than FEWEST, the next ones of the sample too. A length is frequent with FEWEST distinct vectors; where there
    are so many lengths that their pivots would not fit, only those with LONG are, as the others' lists are short.
    """
    seen = nodes.groupBy(F.size("v").alias("length")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= FEWEST).orderBy(F.desc("n"), "length").collect()
    room = np.cumsum([8 * FEWEST * r["length"] for r in seen])
    seen = [r for r, size in zip(seen, room, strict=True) if size <= PIVOT_BYTES or r["n"] >= LONG]
    wanted = {r["length"]: int(np.clip(PER_ROOT * np.sqrt(r["n"]), FEWEST, MOST)) for r in seen}
    share = min(1.0, PIVOT_BYTES / max(1, sum(8 * length * k for length, k in wanted.items())))
    wanted = {length: max(FEWEST, int(k * share)) for length, k in wanted.items()}
    if not wanted:
        return {}
    hashes = F.xxhash64("v", F.lit("pivot")).alias("h")
    bounds = [(r["length"], int(min(1.0, 2 * DRAWS * wanted[r["length"]] / r["n"]) * ((1 << 63) - 1))) for r in seen]
    drawn = nodes.select("v", hashes, F.size("v").alias("length")).join(F.broadcast(nodes.sparkSession.createDataFrame(bounds, "length int, below long")), "length")
    table = drawn.where(F.col("h").bitwiseAND(F.lit((1 << 63) - 1)) <= F.col("below")).select("length", "h", "v").toArrow().sort_by([("length", "ascending"), ("h", "ascending")])
    out, first, lengths = {}, 0, table.column("length").to_numpy()
    for length, k in wanted.items():
        own = table.column("v").take(pa.array(np.flatnonzero(lengths == length)[: DRAWS * k]))
        out[length] = (first, _spread(_unit(_matrix(own, length)), k))
        first += len(out[length][1])
    return out


def _matrix(v: pa.ChunkedArray | pa.Array, length: int) -> np.ndarray:
    """Vectors of one length as rows of doubles."""
    whole = v.combine_chunks() if isinstance(v, pa.ChunkedArray) else v
    return whole.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, length)


def _spread(points: np.ndarray, most: int) -> np.ndarray:
    """The first points, at most so many, of which none is close to one before it; of the others the first, up to FEWEST in all."""
    taken: list[int] = []
    for at in range(0, len(points), BLOCK):
        block = points[at : at + BLOCK]
        free = (block @ points[taken].T < CLOSE).all(1) if taken else np.ones(len(block), bool)
        inner = block @ block.T
        for k in range(len(block)):
            if free[k] and len(taken) < most:
                taken.append(at + k)
                free &= inner[k] < CLOSE
    rest = np.setdiff1d(np.arange(len(points)), taken)[: max(0, min(FEWEST, most) - len(taken))]
    return points[np.append(np.array(taken, np.int64), rest)]


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.maximum(np.abs(x).max(1, keepdims=True), 1e-300)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def describe(nodes: DataFrame, pivots: dict[int, tuple[int, np.ndarray]], nearest: int = NEAREST) -> DataFrame:
    """node, label, v, weight, near: the numbers of the nearest pivots of their length, nearest first, and close: how many of them are close.

    Vectors of a length without pivots are in their length's own list.
    """
    shared = nodes.sparkSession.sparkContext.broadcast(pivots)
    step = max(1, (8 << 20) // max([1, *[len(p) for _, p in pivots.values()]]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                lengths = part.column(2).value_lengths().to_numpy(zero_copy_only=False)
                near = np.full((len(lengths), nearest), NOTHING, np.int64)
                near[:, 0] = -lengths
                close = np.zeros(len(lengths), np.int64)
                for length in np.unique(lengths).tolist():
                    if length in shared.value:
                        own = np.flatnonzero(lengths == length)
                        first, points = shared.value[length]
                        few = min(nearest, len(points))
                        cosines = _unit(_matrix(part.column(2).take(pa.array(own)), length)) @ points.T
                        top = np.argpartition(-cosines, few - 1, axis=1)[:, :few]
                        values = np.take_along_axis(cosines, top, 1)
                        order = np.lexsort((top, -values), axis=1)
                        near[own, :few] = first + np.take_along_axis(top, order, 1)
                        close[own] = (values >= CLOSE).sum(1)
                kept = near != NOTHING
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(kept.sum(1))), pa.int32()), pa.array(near[kept], pa.int32()))
                yield pa.RecordBatch.from_arrays([*part.columns, lists, pa.array(close, pa.int32())], [*part.schema.names, "near", "close"])

    kind = nodes.schema["v"].dataType.simpleString()
    return nodes.select("node", "label", "v", "weight").mapInArrow(run, f"node long, label string, v {kind}, weight long, near array<int>, close int")


def _one_hot(near: pa.Array, close: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pivots that are named, in order, and for each row which of them it names and which of those are close."""
    counts = near.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    names, at = np.unique(near.flatten().to_numpy(zero_copy_only=False), return_inverse=True)
    row = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(at)) - np.repeat(np.cumsum(counts) - counts, counts)
    hot, warm = (np.zeros((len(counts), len(names)), np.float32) for _ in range(2))
    hot[row, at] = 1
    inner = place < close[row]
    warm[row[inner], at[inner]] = 1
    return names, hot, warm


def block_links(table: pa.Table, a: np.ndarray, b: np.ndarray, pivot: int, sub: int, cosine: float, shared: int) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs (of a, of b) that are candidates of this list, verified by cosine: each pair of a label is one of one list."""
    near, close = table.column("near").combine_chunks(), table.column("close").to_numpy()
    vectors = table.column("v").combine_chunks()
    units = _unit(_matrix(vectors, len(vectors[0])))
    names, hot, warm = _one_hot(near, close)
    lower = int(np.searchsorted(names, pivot))
    mine, other = hot[a], hot[b]
    good = (mine[:, :lower] @ other[:, :lower].T) == 0
    common = mine @ other.T
    if sub == WHOLE:
        need = np.minimum(shared, np.minimum(mine.sum(1)[:, None], other.sum(1)[None]))
        good &= (common >= need) | (warm[a] @ warm[b].T > 0)
    elif sub == NEARBY:
        good &= common == 1
    else:
        upper = int(np.searchsorted(names, sub))
        good &= (mine[:, lower + 1 : upper] @ other[:, lower + 1 : upper].T) == 0
    i, j = np.nonzero(good & (units[a] @ units[b].T >= cosine))
    return a[i], b[j]


def _forest(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (lowest node, node) that connect what the pairs of node numbers connect."""
    names, flat = np.unique(np.concatenate([x, y]), return_inverse=True)
    i, j = flat[: len(x)], flat[len(x) :]
    label = np.arange(len(names))
    while (label[i] != label[j]).any():
        a, b = label[i], label[j]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label[label] != label).any():
            label = label[label]
    moved = np.flatnonzero(label != np.arange(len(names)))
    return names[label[moved]], names[moved]


def lists(described: DataFrame, block: int = BLOCK, long: int = LONG) -> DataFrame:
    """(label, pivot, sub, p, o, mine, row): the block pairs of all lists that hold two rows or more."""
    row = F.struct("node", "weight", "v", "near", "close").alias("row")
    posts = described.select("label", row, F.posexplode("near").alias("at", "pivot"))
    sizes = posts.groupBy("label", "pivot").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    posts = posts.join(sizes, ["label", "pivot"])
    again = (F.col("n") > long) & (F.size("row.near") >= SHARED)  # a list of vectors that name no other pivot stays whole, in blocks
    later = F.filter("row.near", lambda q: q > F.col("pivot"))
    nearby = F.when(F.col("at") < F.col("row.close"), F.array(F.lit(NEARBY))).otherwise(F.array().cast("array<int>"))
    dealt = posts.where(again).select("label", "pivot", "row", F.explode(F.concat(later, nearby)).alias("sub"))
    inner = dealt.groupBy("label", "pivot", "sub").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    dealt = dealt.join(inner, ["label", "pivot", "sub"])
    posts = posts.where(~again).withColumn("sub", F.lit(WHOLE)).select(dealt.columns).unionByName(dealt)
    pieces = F.ceil(F.col("n") / block)
    posts = posts.withColumn("mine", F.pmod(F.xxhash64("row.node"), pieces)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), pieces - 1)))
    return posts.select("label", "pivot", "sub", F.least("mine", "other").alias("p"), F.greatest("mine", "other").alias("o"), "mine", "row.*")


def linked(described: DataFrame, cosine: float = COSINE, shared: int = SHARED, block: int = BLOCK, long: int = LONG) -> DataFrame:
    """What block pairs found: (edge 0, node, .., n) with a node's links by weight, and (edge 1, node, other).

    A node's weight is the number of equal vectors it stands for.
    """

    def compare(table: pa.Table) -> pa.Table:
        table = table.sort_by("node")
        p, o, pivot, sub = (table.column(c)[0].as_py() for c in ("p", "o", "pivot", "sub"))
        mine, node, weight = (table.column(c).to_numpy() for c in ("mine", "node", "weight"))
        a, b = np.flatnonzero(mine == p), np.flatnonzero(mine == o)
        i, j = block_links(table, a, b, pivot, sub, cosine, shared) if len(a) and len(b) else (a[:0], b[:0])
        if p == o:
            i, j = i[node[i] < node[j]], j[node[i] < node[j]]
        counts = np.bincount(i, weight[j], len(node)) + np.bincount(j, weight[i], len(node))
        some = np.flatnonzero(counts)
        low, high = _forest(node[i], node[j])
        none = np.zeros(len(low), np.int64)
        columns = [np.repeat([0, 1], [len(some), len(low)]), np.append(node[some], low), np.append(node[some], high), np.append(counts[some].astype(np.int64), none)]
        return pa.table([pa.array(c, pa.int64()) for c in columns], ["edge", "node", "other", "n"])

    posts = lists(described, block, long)
    return posts.groupBy("label", "pivot", "sub", "p", "o").applyInArrow(compare, "edge long, node long, other long, n long")


def near_duplicates(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per input row.

    Vectors link only to vectors of the same label that is not null. Vectors that are null, empty, zero or hold a null
    or non-finite component link with nothing; so do rows with a null vec_id, whose component_id is null and which are
    kept. Equal vectors of a label are one node whose weight is their number, so repeated rows count as links of each
    other; a vec_id should not name two different vectors. Ties (equal cosines to pivots, and at the cosine asked for,
which links) go by pivot number. An empty table gives an empty table; other columns are ignored, whatever their names.
The pivots are a bounded sample; every vector is indexed.
    """
    fine = usable(vectors.where(F.col(vec_id).isNotNull()), vec_id, embedding, label)
    nodes = fine.groupBy("label", "v").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("weight"))
    nodes = materialise(nodes, "nodes")
    members = materialise(
        fine.select("vec_id", "label", "v").join(nodes, ["label", "v"]).select("vec_id", "node", "weight"), "members"
    )
    described = materialise(describe(nodes, draw_pivots(nodes)), "described")
    found = materialise(linked(described, cosine), "links")
    counts = found.where("edge = 0").groupBy("node").agg(F.sum("n").alias("n"))
    comps = components(found.where("edge = 1").select(F.col("node").alias("a"), F.col("other").alias("b")))
    members = members.join(counts, "node", "left").join(comps, "node", "left")
    result = members.select(
        "vec_id", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).cast("long").alias("n_links"), F.coalesce("component", "node").alias("component_id")
    )
    alone = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("v"), F.col(label).cast("string").alias("label"))
    v = F.col("v")
    fit = F.coalesce(
        F.col("label").isNotNull()
        & F.col("vec_id").isNotNull()
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(v, lambda x: x != 0),
        F.lit(False),
    )
    rest = alone.where(~fit).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return result.unionByName(rest).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
