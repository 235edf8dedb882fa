"""Near copies of whole texts: sets of 5-word shingles with a Jaccard similarity of 0.8 or more.

Texts of equal sets are one node. Nodes meet in buckets of equal MinHash bands; inside a bucket their SimHash
fingerprints are compared bit-sliced (see simhash), with a radius that texts of that similarity hardly ever exceed, and
what stays is checked exactly on the shingle sets (as 32-bit hashes). A pair of similarity 0.8 misses all 16 bands of 4
with a chance of 0.0002, and the radius with one below 0.001; both fall quickly above.

Buckets with the same members are compared once, and buckets that are large, by members or by shingles, piece against
piece. A bucket gives stars, never its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.operators.carry import broadcast_if_few
from tidelog.sources.scratch import materialise

from .components import components
from .langid import blocks
from .simhash import PIECE, SEED, majority, named_rows, near_pairs

SHINGLE = 5
SIMILARITY = 0.8
#: Differing bits of 64 up to which two fingerprints are checked exactly; 10 are expected at the similarity, 32 at chance.
RADIUS = 24
BANDS, ROWS = 16, 4
#: Shingles that one piece of a bucket holds on average.
PIECE_SHINGLES = 1 << 21
#: Hashes that are permuted, and words of 64 lanes that are compared, at a time.
CHUNK, WORDS = 1 << 10, 1 << 12
#: Texts whose sets are wanted, up to which their ids are broadcast.
FEW_ASKED = 4_000_000

_DRAWS = np.random.default_rng(SEED)
_MASK = _DRAWS.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)
_FACTOR = _DRAWS.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct XXH64 of a text's word shingles, A-Z lower-cased; of all its words if it has fewer, none without."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    line, size = b" ".join(words), min(size, len(words))
    ends = list(accumulate(len(w) + 1 for w in words))
    digest = xxhash.xxh64_intdigest
    hashes = (digest(line[a : b - 1], SEED) for a, b in zip([0, *ends], ends[size - 1 :], strict=False))
    return _distinct(np.fromiter(hashes, np.uint64, len(words) - size + 1))


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])]


def band_keys(hashes: np.ndarray) -> list[int]:
    """A signed key for each band of the MinHashes of a set."""
    lowest = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), CHUNK):
        lowest = np.minimum(lowest, ((hashes[None, at : at + CHUNK] ^ _MASK[:, None]) * _FACTOR[:, None]).min(1))
    rows = lowest.reshape(BANDS, ROWS)
    return np.array([xxhash.xxh64_intdigest(r.tobytes(), k) for k, r in enumerate(rows)], np.uint64).view(np.int64).tolist()


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, node, fp, size, keys): a sketch of the set of every whole text, node its digest. The sets themselves are not kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, n in blocks(batch.column(1)):
                part = batch.slice(at, n)
                yield pa.RecordBatch.from_arrays([part.column(0), *sketch(part.column(1))], names)

    def sketch(texts: pa.Array) -> list[pa.Array]:
        sets = [shingles(t.as_py()) for t in texts]
        return [
            pa.array(np.array([_digest(s) for s in sets], np.uint64).view(np.int64)),
            pa.array(np.array([majority(s) for s in sets], np.uint64).view(np.int64)),
            pa.array([len(_narrow(s)) for s in sets], pa.int64()),
            pa.array([band_keys(s) if len(s) else [] for s in sets], pa.list_(pa.int64())),
        ]

    names = ["doc_id", "node", "fp", "size", "keys"]
    return _rows(docs).mapInArrow(run, "doc_id long, node long, fp long, size long, keys array<long>")


def _digest(s: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(s.tobytes(), SEED)


def _narrow(s: np.ndarray) -> np.ndarray:
    """A set as 32-bit hashes, which sets are compared by."""
    return _distinct(s.astype(np.uint32)) if len(s) else s.astype(np.uint32)


def _sets(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """(node, shingles) of the nodes asked for (node, low), made anew from the text of their least doc_id.

    While these ids are few enough to broadcast, other texts are not looked at and none is moved; beyond that texts are
    joined to them. Where an id repeats or is null, its texts are told apart by their digest.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, n in blocks(batch.column(0)):
                sets = [shingles(t.as_py()) for t in batch.column(0).slice(at, n)]
                nodes = np.array([_digest(s) for s in sets], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array([_narrow(s).tobytes() for s in sets], pa.binary())], ["node", "shingles"])

    rows, ids = _rows(docs), asked.select(F.col("low")).distinct()
    rows = rows.join(broadcast_if_few(ids, F.lit(1), FEW_ASKED), F.col("doc_id").eqNullSafe(F.col("low")), "left_semi").select("text")
    return rows.mapInArrow(run, "node long, shingles binary").join(asked.select("node"), "node", "left_semi").dropDuplicates(["node"])


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stars of the near copies in each bucket piece, from rows (key, p, o, node, fp, shingles) in order of the first three."""
    for group in _groups(batches):
        fps = group.column("fp").to_numpy().astype(np.int64).view(np.uint64)
        sets = [np.frombuffer(x.as_buffer(), np.uint32) for x in group.column("shingles")]
        sizes, label = np.array([len(s) for s in sets]), np.arange(len(fps))
        for i, j in near_pairs(fps, np.zeros(len(fps), np.int64), RADIUS, WORDS):
            untied = (label[i] != label[j]) & (np.minimum(sizes[i], sizes[j]) >= SIMILARITY * np.maximum(sizes[i], sizes[j]))
            for a, b in zip(i[untied].tolist(), j[untied].tolist(), strict=True):
                if label[a] != label[b] and _similar(sets[a], sets[b]):
                    low, high = sorted((label[a], label[b]))
                    label[label == high] = low
        moved = np.flatnonzero(label != np.arange(len(fps)))
        nodes = group.column("node").to_numpy().astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(nodes[label[moved]]), pa.array(nodes[moved])], ["a", "b"])


def _similar(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= SIMILARITY * (len(a) + len(b) - both) - 1e-9


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Each bucket piece as a table; no more than one piece and one batch are held."""
    held: list[pa.Table] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        keys = np.stack([table.column(c).to_numpy() for c in ("key", "p", "o")])
        starts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1).tolist()]
        for a, b in zip(starts, [*starts[1:], batch.num_rows], strict=True):
            now = tuple(keys[:, a])
            if now != last and held:
                yield pa.concat_tables(held)
                held = []
            held.append(table.slice(a, b - a))
            last = now
    if held:
        yield pa.concat_tables(held)


def near_copies(docs: DataFrame) -> DataFrame:
    """(doc_id, component_id): component_id is the smallest doc_id reachable over pairs of similarity 0.8 or more.

    Texts without a word, null ones included, are copies of each other. Texts are read whole, however long; an empty
    table gives an empty table. A null doc_id takes part but never names a component unless its component has no other
    id (then null). Repeated rows and ids give repeated rows; other columns of the input are ignored.
    """
    prints = materialise(_sketches(docs), "sketches")
    light = prints.groupBy("node", "fp", "size", "keys")
    nodes = materialise(light.agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("n")), "nodes")
    rows = nodes.select("node", "size", F.explode("keys").alias("key"))
    members = [F.bit_xor("node").alias("x"), F.sum(F.shiftright("node", 24)).alias("y")]
    buckets = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("total"), *members).where("n > 1")
    once = buckets.groupBy("n", "total", "x", "y").agg(F.min("key").alias("key"))
    pieces = F.ceil(F.greatest(F.col("n") / PIECE, F.col("total") / PIECE_SHINGLES))
    other = F.explode(F.sequence(F.lit(0).cast("long"), pieces - 1)).alias("o")
    met = rows.join(once, "key").select("node", "key", F.pmod(F.xxhash64("node"), pieces).alias("p"), other)
    met = materialise(met.select("node", "key", F.least("p", "o").alias("p"), F.greatest("p", "o").alias("o")), "buckets")
    asked = materialise(nodes.join(met.select("node").distinct(), "node").select("node", "low", "fp"), "asked")
    keys = ["key", "p", "o"]
    full = met.join(_sets(docs, asked), "node").join(asked.select("node", "fp"), "node").select(*keys, "node", "fp", "shingles")
    comps = components(full.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_linked, "a long, b long"))
    linked = nodes.join(comps, "node")
    lowest = linked.groupBy("component").agg(F.min("low").alias("lowest"))
    named = linked.join(lowest, "component").select("node", "lowest")
    same = nodes.where("n > 1").join(named, "node", "left_anti").select("node", F.col("low").alias("lowest"))
    return named_rows(prints.select("doc_id", "node"), materialise(named.unionByName(same), "named"), "node").drop("node")
