"""Repeated passages: every byte that a window of so many bytes covers which also starts anywhere else.

A depth-limited radix sort of all suffixes, from the most significant digit on, in three passes. Only groups matter, not
which group comes first, so digits are compared by hashes, and buckets that are settled leave early:

1. The first digit of a window is its anchor: of its strings of GRAM bytes the one of the least hash (the first of
   equals), and where in the window it stands. Equal windows have equal anchors, and windows that follow each other
   mostly share one, so a row stands for a stretch of about 170 suffixes. A bucket is settled if all its rows have the
   same bytes all around: alone, none of its windows repeats; else all of them do.
2. Other buckets are dealt out by the next digit: the bytes that windows starting within BLOCK bytes have in common.
   Again, what is alone or the same all around is settled.
3. What is left differs in the bytes beside those in common, fewer than BLOCK on either side, which the second pass took
   along. So the full depth needs no text: windows are compared within a bucket, and groups of more than one are the
   repeated ones. Buckets of more than MANY kinds are dealt out window by window.

A pass is a count by (digit, all around) with partial sums, so a passage that a third of all documents hold is one row a
task, and of equal rows a single one goes on to the next pass. Texts stay where they are: between passes only places
move, by text. What decides that bytes are equal is 128 bits of XXH3.

Keys are looked for in the same way at every size: rows, or texts, that can't have one are told by a sieve, a table of
bits with a bounded number of rows that is sent to every worker, and only the others are shuffled to be joined exactly.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.sources.scratch import materialise, short_lived

#: Bytes of a window, of an anchor, and starts of windows that one row of the second pass stands for.
WINDOW, GRAM, BLOCK = 400, 64, 25
#: Numbers of 64 bits that a sieve of keys, and one of names of texts, has at most; so many texts with copies are broadcast.
FEW, FEW_TEXTS = 1 << 21, 1 << 21
#: Kinds of a bucket that are compared in one task.
MANY = 500
#: Window starts that are looked at together.
CHUNK = 1 << 19
#: Bytes of texts, and rows, that a task holds at a time (a single text may be longer).
PORTION, ROWS = 1 << 23, 1 << 17
SPAN = T.StructType().add("start", "long").add("stop", "long")
#: Random-looking 64-bit numbers of the bytes, and multipliers of the doublings, from a fixed seed.
_BYTES = np.random.default_rng(11).integers(1, 1 << 63, 256, np.uint64)
_MIX = np.uint64(0xC2B2AE3D27D4EB4F)
_PLACE = np.uint64((1 << 20) - 1)


def _gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of the size bytes (a power of two) from each place on."""
    h, have = _BYTES[data], 1
    while have < size:
        left = h[:-have]
        h = (left ^ (left >> np.uint64(31))) * _MIX + h[have:]
        have *= 2
    return (h ^ (h >> np.uint64(29))) * _MIX


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each stretch of width values, by minima from both ends of blocks of that width."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def anchors(data: np.ndarray, edges: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(anchor, first, last): for each anchor the windows, by start, that have it; text k is data[edges[k]:edges[k + 1]]."""
    n, width, found = len(data) - window + 1, window - gram + 1, [np.zeros((3, 0), np.int64)]
    for at in range(0, max(n, 0), CHUNK):
        h = _gram_hashes(data[at : min(at + CHUNK, n) + window - 1], gram)
        h = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)
        p = (_least(h, width) & _PLACE).astype(np.int64)
        first = np.flatnonzero(np.diff(p, prepend=-1))
        found.append(np.stack([p[first], first, np.append(first[1:], len(p)) - 1]) + at)
    p, first, last = np.concatenate(found, axis=1)
    new = np.flatnonzero(np.diff(p, prepend=-1))  # a stretch that a chunk's end cut in two is one again
    p, first, last = p[new], first[new], last[np.append(new[1:], len(p)) - 1] if len(p) else last
    text = np.searchsorted(edges, p, "right") - 1  # windows of a text have their anchor in it, so others are cut off
    first, last = np.maximum(first, edges[text]), np.minimum(last, edges[text + 1] - window)
    kept = first <= last
    return p[kept], first[kept], last[kept], text[kept]


def _around(data: memoryview, begin: int, end: int, start: int, stop: int, anchor: int) -> tuple[int, int, bytes]:
    """The bytes from start to stop, as far as the text from begin to end goes, and their key, with the anchor's place."""
    start, stop = max(start, begin), min(stop, end)
    return start, stop, xxhash.xxh3_128_digest(data[start:stop], anchor - start)


def _hash(data: memoryview) -> int:
    x = xxhash.xxh3_64_intdigest(data)
    return x - (1 << 64) if x >> 63 else x


#: Rows of a pass: a text, the anchor's place, offsets of the windows before it, digit, and what is all around with its place.
_ROW = {
    "tid": pa.binary(), "at": pa.int32(), "lo": pa.int32(), "hi": pa.int32(), "digit": pa.int64(),
    "around": pa.binary(), "start": pa.int32(), "stop": pa.int32(), "weight": pa.int32(),
}
_SCHEMA = "tid binary, at int, lo int, hi int, digit long, around binary, start int, stop int, weight int"


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(_ROW)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _ROW.values(), strict=True)], list(_ROW))


def _first_digit(window: int, gram: int) -> Callable:
    """(tid, text, weight) -> a row for each anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tids, parts, weights in _portions(batch):
                data, edges = b"".join(parts), np.cumsum([0, *map(len, parts)])
                view, ends, rows = memoryview(data), edges.tolist(), []
                for p, first, last, text in zip(*(x.tolist() for x in anchors(np.frombuffer(data, np.uint8), edges, window, gram)), strict=True):
                    begin = ends[text]
                    start, stop, around = _around(view, begin, ends[text + 1], p - window + gram, p + window, p)
                    rows.append((tids[text], p - begin, p - last, p - first, _hash(view[p : p + gram]), around, start - begin, stop - begin, weights[text]))
                yield _batch(rows)

    return run


def _portions(batch: pa.RecordBatch, most: int = PORTION) -> Iterator[tuple[list, list, list]]:
    """Rows of a batch of (tid, text, other) in lists of about so many bytes of text, one text at least."""
    rows, size = ([], [], []), 0
    for tid, text, other in zip(*batch.columns, strict=True):
        for column, x in zip(rows, (tid.as_py(), text.as_buffer(), other.as_py()), strict=True):
            column.append(x)
        size += len(rows[1][-1])
        if size >= most:
            yield rows
            rows, size = ([], [], []), 0
    if rows[0]:
        yield rows


def _next_digit(window: int, block: int) -> Callable:
    """(tid, text, places) -> a row for each block of window starts of each place.

    What is all around is 64 more bits of the digit's bytes, the number of bytes before them, and the bytes on both sides.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for portion in _portions(batch):
                rows = []
                for tid, text, places in zip(*portion, strict=True):
                    data = memoryview(text)
                    for place in places:
                        p, weight = place["at"], place["weight"]
                        for b in range(place["lo"] // block, place["hi"] // block + 1):
                            top = p - b * block  # the last window of the block starts here, the first block - 1 before
                            low = top - block + 1
                            start, stop = max(low, 0), min(top + window, len(data))
                            common = xxhash.xxh3_128_digest(data[top : low + window], b)
                            around = common[8:] + bytes([top - start]) + data[start:top] + data[low + window : stop]
                            digit = int.from_bytes(common[:8], "big", signed=True)
                            rows.append((tid, p, max(b * block, place["lo"]), min(b * block + block - 1, place["hi"]), digit, around, start, stop, weight))
                    if len(rows) >= ROWS:
                        yield _batch(rows)
                        rows = []
                yield _batch(rows)

    return run


def _windows(around: bytes, lo: int, hi: int, block: int) -> list[tuple[int, bytes]]:
    """(offset, rest) for each offset from lo to hi: what a window has besides the digit's bytes, and where in it they stand."""
    left, first = 9 + around[8], lo // block * block
    return [(o, around[:8] + bytes([o - first]) + around[left - o + first : left - o + first + block - 1]) for o in range(lo, hi + 1)]


def _compared(window: int, block: int) -> Callable:
    """(kinds of a bucket) -> a span for each kind that has windows which stand in the bucket more than once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = []
            for kinds in batch.column(0):
                kinds, seen = kinds.as_py(), Counter()
                windows = [_windows(k["around"], k["lo"], k["hi"], block) for k in kinds]
                for k, each in zip(kinds, windows, strict=True):
                    for _, rest in each:
                        seen[rest] += k["weight"]
                for k, each in zip(kinds, windows, strict=True):
                    found = [o for o, rest in each if seen[rest] > 1]
                    if found:  # windows of a block overlap
                        spans.append((k["tid"], k["at"] - found[-1], k["at"] - found[0] + window))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*spans, strict=True)) or [()] * 3, (pa.binary(), pa.int32(), pa.int32()), strict=True)], ["tid", "start", "stop"])

    return run


def _one_by_one(window: int, block: int) -> Callable:
    """(digit, around, tid, at, lo, hi, weight) -> a row for each window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for digit, around, tid, at, lo, hi, weight in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for o, rest in _windows(around, lo, hi, block):
                    rows.append((tid, at, o, o, digit, xxhash.xxh3_128_digest(rest), at - o, at - o + window, weight))
                if len(rows) >= ROWS:
                    yield _batch(rows)
                    rows = []
            yield _batch(rows)

    return run


def _parted(rows: DataFrame, keys: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """(perhaps, others): rows that may have one of the keys, with few that have none, and rows that have none for certain.

    A key sets one of 32 bits or more, as long as the sieve keeps to its bound; beyond that more rows pass.
    """
    words = 1 << (max(1, min(keys.count(), most)).bit_length() - 1)
    code = F.xxhash64(*keys.columns)
    word, bit = code.bitwiseAND(F.lit(words - 1)), F.call_function("shiftrightunsigned", code, F.lit(58)).cast("int")
    sieve = keys.groupBy(word.alias("_word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("_bits"))
    coded = rows.withColumn("_word", word).join(F.broadcast(sieve), "_word", "left")
    hit = F.call_function("shiftrightunsigned", F.coalesce("_bits", F.lit(0).cast("long")), bit).bitwiseAND(F.lit(1)) == 1
    return coded.where(hit).drop("_word", "_bits"), coded.where(~hit).drop("_word", "_bits")


def _recurring(rows: DataFrame, key: list[str], write: Callable, name: str) -> DataFrame:
    """The keys that stand for more than one row, by weight; a weight of 2 is of what stands there more than once already."""
    return write(rows.groupBy(*key).agg(F.sum("weight").alias("n")).where("n > 1").select(*key), name)


def _spans(rows: DataFrame, again: DataFrame) -> DataFrame:
    return _parted(rows, again, FEW)[0].join(again, again.columns, "left_semi").select("tid", "start", "stop")


def _settled(rows: DataFrame, name: str, more: list[str]) -> tuple[DataFrame, DataFrame]:
    """(spans, open): places, by text, of what is the same all around as something else, and one place of each kind of the buckets with several.

    A digit that stands alone is left behind by a count of digits, so that only what recurs is grouped by its
    surroundings (and the few digits that a sieve lets pass: groups of one, in buckets of one kind). The rows and groups
    are deleted once both results are written.
    """
    with short_lived(rows.sparkSession, name) as write:
        rows = write(rows, "rows")
        live, _ = _parted(rows, _recurring(rows, ["digit"], write, "digits"), FEW)
        place = F.struct("tid", "at", "lo", "hi").alias("place")
        groups = write(live.groupBy("digit", "around").agg(F.sum("weight").alias("n"), F.min(place).alias("place")), "groups")
        mixed = write(groups.groupBy("digit").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1"), "mixed")
        opened = groups.select("digit", "place.*", F.least("n", F.lit(2)).cast("int").alias("weight"), *[c for c in more if c != "kinds"])
        opened = materialise(opened.join(mixed, "digit").select("digit", "tid", "at", "lo", "hi", "weight", *more), f"{name}_open")
        return _by_text(_spans(rows, write(groups.where("n > 1").select("digit", "around"), "again")), f"{name}_spans"), opened


def _beside(texts: DataFrame, each: DataFrame, how: str) -> DataFrame:
    """Texts with the row that each, a table of one row a text, has for them; texts that have none are not shuffled ("left"), or left out ("inner")."""
    found, rest = _parted(texts, each.select("tid"), FEW_TEXTS)
    found = found.join(each, "tid", how)
    return found if how == "inner" else found.unionByName(rest, allowMissingColumns=True)


def _by_text(rows: DataFrame, name: str) -> DataFrame:
    """(tid, spans): of rows (tid, start, stop)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cuts = [merged((s["start"], s["stop"]) for s in spans.as_py()) for spans in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), _span_lists(cuts)], ["tid", "spans"])

    each = rows.groupBy("tid").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    return materialise(each.mapInArrow(run, T.StructType().add("tid", "binary").add("spans", T.ArrayType(SPAN))), name)


def _span_lists(cuts: list[list[tuple[int, int]]]) -> pa.Array:
    return pa.array([[{"start": a, "stop": b} for a, b in cut] for cut in cuts], pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))


def tid(text: Column) -> Column:
    """Name of a text: 128 bits of its SHA-256."""
    return F.substring(F.unhex(F.sha2(text, 256)), 1, 16)


def repeated(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = WINDOW, gram: int = GRAM, block: int = BLOCK) -> DataFrame:
    """(tid, spans): for each text that has any, named by tid, spans of bytes (start, stop) of windows that also start elsewhere.

    Of equal texts the one of the least doc_id is looked at, with weight 2; where that id repeats, or all are null, several are.
    """
    texts = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text")).where(F.octet_length("text") >= window)
    texts = texts.withColumn("tid", tid(F.col("text")))
    copies = texts.groupBy("tid").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("least")).where("n > 1")
    copies = materialise(copies, "copies")
    marked = texts.join(F.broadcast(copies), "tid", "left") if copies.count() <= FEW else _beside(texts, copies, "left")
    marked = marked.where("n is null or id <=> least").select("tid", "text", F.when(F.col("n") > 1, 2).otherwise(1).alias("weight"))
    first, opened = _settled(marked.mapInArrow(_first_digit(window, gram), _SCHEMA), "first", [])
    places = materialise(opened.groupBy("tid").agg(F.collect_set(F.struct("at", "lo", "hi", "weight")).alias("places")), "places")
    deeper = _beside(marked.select("tid", "text"), places, "inner").select("tid", "text", "places")
    second, opened = _settled(deeper.mapInArrow(_next_digit(window, block), _SCHEMA), "second", ["around", "kinds"])
    kinds = opened.where(F.col("kinds") <= MANY).groupBy("digit").agg(F.collect_list(F.struct("around", "tid", "at", "lo", "hi", "weight")).alias("all"))
    third = kinds.select("all").mapInArrow(_compared(window, block), "tid binary, start int, stop int")
    large = opened.where(F.col("kinds") > MANY).select("digit", "around", "tid", "at", "lo", "hi", "weight")
    with short_lived(docs.sparkSession, "third") as write:
        large = write(large.mapInArrow(_one_by_one(window, block), _SCHEMA), "windows")
        last = _by_text(third.unionByName(_spans(large, _recurring(large, ["digit", "around"], write, "repeated"))), "last_spans")
    found = first.unionByName(second).unionByName(last)
    return found.groupBy("tid").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def without_repeats(docs: DataFrame, carried: list[Column], text: str = "text", doc_id: str = "doc_id", window: int = WINDOW, gram: int = GRAM, block: int = BLOCK) -> DataFrame:
    """Carried columns, n_bytes, spans (maximal removed runs, array of start and stop) and kept (binary) of every row of docs.

    Texts are compared and cut as UTF-8 bytes, whole, and what is kept may be cut inside a character. Null texts are
    empty; texts shorter than a window keep all. Equal texts repeat each other, so nothing of them is kept if they are
    as long as a window. A null doc_id is a document like any other. Columns that are not carried are not looked at. An
    empty table gives an empty one.
    """
    spans = materialise(repeated(docs, text, doc_id, window, gram, block), "spans")
    rows = docs.select(F.struct(F.lit(0).alias("_"), *carried).alias("carried"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    rows = _beside(rows.withColumn("tid", tid(F.col("text"))), spans, "left").select("carried", "text", "spans")
    carries = rows.schema["carried"].dataType
    schema = T.StructType().add("carried", carries).add("n_bytes", "long").add("spans", T.ArrayType(SPAN)).add("kept", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, cuts, kept = [], [], []
            for text, spans in zip(batch.column(1), batch.column(2), strict=True):
                data = memoryview(text.as_buffer())
                cut = merged((s["start"], s["stop"]) for s in spans.as_py() or ())
                edges = [0, *[x for span in cut for x in span], len(data)]
                sizes.append(len(data))
                cuts.append(cut)
                kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), _span_lists(cuts), pa.array(kept, pa.binary())], ["carried", "n_bytes", "spans", "kept"])

    found = rows.mapInArrow(run, schema)
    return found.select(*[F.col("carried")[f.name].alias(f.name) for f in carries.fields[1:]], "n_bytes", "spans", "kept")


def merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order, those that touch or overlap as one."""
    out: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(stop, out[-1][1]))
        else:
            out.append((start, stop))
    return out
