"""SimHash near-duplicates by bit-sliced comparison.

Fingerprints are compared inside buckets of equal bit blocks: with a radius r and s blocks, two fingerprints within r
differ in at most r blocks, so they agree on some choice of s - r whole blocks; every choice is a table of buckets and
no link can be missed. Inside a bucket, fingerprints are turned into vertical bit planes of 64 lanes a word. Each
query word XORs one plane at a time, a carry-save ripple of counter planes (three up to radius 7, five up to 31) plus an
overflow plane keeps 64 distances at once, and a word is abandoned as soon as all of its lanes exceed the radius.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidelog.operators.carry import broadcast_if_few
from tidelog.sources.scratch import materialise

from .components import components

SEED = 42
SHINGLE = 4
RADIUS = 4
#: Rows of a bucket that one piece holds; larger buckets are compared piece against piece.
PIECE = 2048
#: Words of 64 lanes compared at a time.
CHUNK = 1 << 16
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)
#: Fingerprints, or ids, up to which they are broadcast, and salts of the join beyond that.
FEW_NAMED, SALTS = 1_000_000, 32


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """64-bit SimHash of a text: majority of the XXH64 of its word shingles, repeats included; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    digest, size = xxhash.xxh64_intdigest, min(size, len(words))
    hashes = np.fromiter(
        [digest(line[a : b - 1], SEED) for a, b in zip(starts, ends[size - 1 :], strict=False)], np.uint64, len(words) - size + 1
    )
    return majority(hashes)


def majority(hashes: np.ndarray) -> int:
    """The fingerprint of shingle hashes: bits that over half of them have."""
    n, ones = len(hashes), np.zeros(64, np.int64)
    for at in range(0, n, 1 << 14):
        bits = np.unpackbits(hashes[at : at + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int32)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, fp): the fingerprint of every whole text, as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(t.as_py()) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def block_masks(n: int, radius: int = RADIUS) -> list[int]:
    """Bit masks of the bucket tables: the fewest blocks for which n random fingerprints leave at most 64 in a bucket.

    Every choice finds all links; it only weighs rows (5 tables of each up to 256 thousand fingerprints, 70 at most, from
    some billions on) against the size of buckets.
    """
    blocks = radius + 1
    while n / 2 ** (64 * (blocks - radius) // blocks) > 64 and blocks < 2 * radius:
        blocks += 1
    edges = [64 * k // blocks for k in range(blocks + 1)]
    each = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(c) for c in combinations(each, blocks - radius)]


def near_pairs(fps: np.ndarray, groups: np.ndarray, radius: int = RADIUS, chunk: int = CHUNK) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i < j) of one group whose fingerprints differ in at most radius (0 to 31) bits; equal groups are adjacent."""
    n = len(fps)
    words = -(-n // 64)
    padded = np.zeros(words * 64, np.uint64)
    padded[:n] = fps
    bits = np.unpackbits(padded.view(np.uint8).reshape(words, 64, 8), axis=2, bitorder="little")
    planes = np.ascontiguousarray(np.packbits(bits.transpose(2, 0, 1), axis=2, bitorder="little")).view(np.uint64).reshape(64, words)
    ends = np.flatnonzero(np.append(groups[1:] != groups[:-1], True)) + 1
    end = np.repeat(ends, np.diff(np.append(0, ends)))
    query = np.flatnonzero(end - np.arange(n) > 1)
    first, last = (query + 1) // 64, (end[query] - 1) // 64
    count = last - first + 1
    until = np.cumsum(count)
    at = 0
    while at < len(query):
        stop = max(at + 1, int(np.searchsorted(until, (until[at - 1] if at else 0) + chunk, "right")))
        q = np.repeat(query[at:stop], count[at:stop])
        within = np.arange(len(q)) - np.repeat(np.cumsum(count[at:stop]) - count[at:stop], count[at:stop])
        yield from _compare(fps, planes, q, np.repeat(first[at:stop], count[at:stop]) + within, end, radius)
        at = stop


def _compare(fps, planes, q, w, end, radius) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    low = np.maximum(q + 1 - 64 * w, 0).astype(np.uint64)
    high = np.minimum(end[q] - 64 * w, 64).astype(np.uint64)
    alive = (ALL << low) & (ALL >> (np.uint64(64) - high))
    mine = fps[q]
    counter = [np.zeros(len(q), np.uint64) for _ in range(max(3, radius.bit_length()))]
    over = np.zeros(len(q), np.uint64)
    for b in range(64):
        differ = planes[b][w] ^ (np.uint64(0) - ((mine >> np.uint64(b)) & np.uint64(1)))
        carry = differ
        for k, plane in enumerate(counter):
            carry, counter[k] = plane & carry, plane ^ carry
        over |= carry
        if b % 8 == 7:
            alive &= ~(over | _above(counter, radius))
            keep = alive != 0
            if not keep.all():
                q, w, mine, alive, over, *counter = (x[keep] for x in (q, w, mine, alive, over, *counter))
            if not len(q):
                return
    lanes = np.unpackbits(np.ascontiguousarray(alive).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    row, lane = np.nonzero(lanes)
    yield q[row], w[row] * 64 + lane


def _above(counter: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose counter is over radius, by a bitwise comparator from the highest plane down."""
    more, equal = np.zeros_like(counter[0]), np.full_like(counter[0], ALL)
    for k in reversed(range(len(counter))):
        if radius >> k & 1:
            equal = equal & counter[k]
        else:
            more = more | (equal & counter[k])
            equal = equal & ~counter[k]
    return more


def _stars(fps: np.ndarray, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Edges to a lowest index that connect what the pairs connect, at most one a fingerprint."""
    label = np.arange(len(fps))
    for i, j in pairs:
        while True:
            a, b = label[i], label[j]
            if (a == b).all():
                break
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
            while (label[label] != label).any():
                label = label[label]
    moved = np.flatnonzero(label != np.arange(len(fps)))
    return fps[label[moved]], fps[moved]


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp) distinct longs -> (a, b): links between fingerprints within radius, as stars that keep all connections."""
    masks = block_masks(prints.count(), radius)
    tables = F.array(*[F.struct(F.lit(k).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for k, m in enumerate(masks)])
    rows = prints.select("fp", F.explode(tables).alias("x")).select("fp", "x.t", "x.key")
    sizes = rows.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    rows = rows.join(sizes, ["t", "key"])
    pieces = F.ceil(F.col("n") / PIECE)
    mine = F.pmod(F.xxhash64("fp", F.lit("piece")), pieces)
    other = F.explode(F.sequence(F.lit(0).cast("long"), pieces - 1)).alias("o")
    rows = rows.select("fp", "t", "key", mine.alias("p"), other).select(
        "fp", "t", "key", F.least("p", "o").alias("p"), F.greatest("p", "o").alias("o")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _whole_groups(batches):
            fps = group[0].view(np.uint64)
            ids = np.cumsum(np.append(0, (group[1:, 1:] != group[1:, :-1]).any(0)))
            a, b = _stars(fps, near_pairs(fps, ids, radius))
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    keys = ["t", "key", "p", "o"]
    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "a long, b long")


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Arrays (fp, key columns) x rows that never cut a group of equal keys, from batches in key order."""
    held: np.ndarray | None = None
    for batch in batches:
        rows = np.stack([batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(batch.num_columns)])
        if not rows.shape[1]:
            continue
        held = rows if held is None else np.concatenate([held, rows], axis=1)
        cut = int(np.flatnonzero((held[1:] != held[1:, -1:]).any(0)).max(initial=-1)) + 1
        if cut:
            yield held[:, :cut]
            held = held[:, cut:]
    if held is not None and held.shape[1]:
        yield held


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fp, component_id): component_id is the smallest doc_id reachable over links of at most radius bits.

    Null and empty texts have fingerprint 0 and link like any other. Equal fingerprints are one node, so a group of
    copies costs one row. Texts are read whole, however long; an empty table gives an empty table. A null doc_id takes part but never names a component unless its component has no other id
    (then null). Repeated rows and ids give repeated rows; other columns of the input are ignored.
    """
    prints = materialise(fingerprints(docs), "fingerprints")
    nodes = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("n")), "nodes")
    comps = components(links(nodes.select("fp"), radius))
    linked = nodes.join(comps.withColumnRenamed("node", "fp"), "fp")
    lowest = linked.groupBy("component").agg(F.min("low").alias("lowest"))
    named = linked.join(lowest, "component").select("fp", "lowest")
    copies = nodes.where("n > 1").join(named, "fp", "left_anti").select("fp", F.col("low").alias("lowest"))
    return named_rows(prints, materialise(named.unionByName(copies), "named"))


def named_rows(prints: DataFrame, named: DataFrame, on: str = "fp") -> DataFrame:
    """Fingerprints with the component of those that have one of more than a row; the others are their own.

    Components are broadcast where few; else both sides are joined salted, as one fingerprint may have very many rows.
    """
    if named.count() <= FEW_NAMED:
        out = prints.join(F.broadcast(named.withColumn("there", F.lit(True))), on, "left")
    else:
        salted = named.withColumn("there", F.lit(True)).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        out = prints.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")).join(salted, [on, "salt"], "left")
    return out.select("doc_id", on, F.when(F.col("there"), F.col("lowest")).otherwise(F.col("doc_id")).alias("component_id"))


def deduplicated(docs: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """The rows of docs that stay, columns as they are: of each component the row of the smallest doc_id.

    Components are those of found (doc_id, component_id), or else of near_duplicates.

    If that doc_id repeats, the first row by its columns as text stays. Rows without a doc_id can't be named by a
    component and all stay. Texts of any length are read whole; an empty table gives an empty table. What is decided is
    ids: texts are only moved where a doc_id repeats, and all of them where the ids to drop are too many to broadcast.
    """
    found = (near_duplicates(docs) if found is None else found).where("doc_id is not null")
    seen = found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.min("component_id").alias("c"))
    noted = seen.where("n > 1 or c != doc_id").select(F.col("doc_id").alias("_noted_id"), (F.col("c") == F.col("doc_id")).alias("_stays"))
    noted = broadcast_if_few(materialise(noted, "noted"), F.lit(1), FEW_NAMED)
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(docs.columns)])
    back = [F.col("row")[f"c{k}"].alias(c) for k, c in enumerate(docs.columns)]
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), row.alias("row")).join(noted, F.col("id") == F.col("_noted_id"), "left")
    first = F.row_number().over(W.partitionBy("id").orderBy(F.to_json("row")))
    once = rows.where("_stays").withColumn("at", first).where("at = 1").select(back)
    return rows.where("_stays is null").select(back).unionByName(once)
