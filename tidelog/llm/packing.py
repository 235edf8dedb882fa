"""Packing documents into fixed-length sequences by cutting-stock column generation.

A document of more than one sequence is cut into full sequences and one rest, so the lengths to place are 1 to 1024;
rounded up to classes of four tokens their histogram has at most 256 rows, whatever the corpus. On it the linear program
of the cutting-stock problem is solved by column generation: a basis of patterns gives each length a price, an
unbounded-knapsack dynamic program finds the best-priced pattern, and it enters the basis until the Farley bound says
that no plan can be noticeably shorter, or twice as many patterns as there are classes have hardly shortened the plan. Basis patterns are used the rounded-down number of times; what is left (less
than one use of each pattern) is filled by decreasing lengths. Pieces are ranked within their class, and the rank names
the pattern, the sequence and the place in it by binary search; offsets are running sums of the true lengths within a
sequence.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidelog.sources.scratch import materialise

LENGTH = 1024
END_ID = 0
#: Rows of a class that are ranked in one task, in expectation.
PART = 1 << 18
#: Column generation ends when the plan is within this share of the lower bound.
GAP = 5e-4
#: Lengths are planned in classes of so many tokens, rounded up: the plan's cost grows with the cube of their number.
GRAIN = 4
#: What splits a text into words before a byte-level BPE merges their bytes. Fixed value.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_of() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for: printable ones themselves, the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Encoder:
    """Ids of a tokenizer's JSON file, as its library gives them with add_special_tokens=False.

    The file's added tokens are found in a text and have their own ids, or are ordinary text if control is False. A
    plain byte-level BPE, as the file says it is, is encoded by its merges as ranks, which gives the same ids faster; any
    other file by the library itself. The word pattern's lookahead only matters where two white-space characters meet;
    other texts go without it.
    """

    _adjacent = re.compile(r"\s\s")
    _lookahead = r"|\s+(?!\S)"

    def __init__(self, path: str, control: bool = True):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        added = {t["content"]: t["id"] for t in spec["added_tokens"]} if control else {}
        ranks = self._ranks(spec)
        if ranks is None:
            from tokenizers import Tokenizer

            own = Tokenizer.from_file(path)
            own.encode_special_tokens = not control
            self._encode = self._plain = lambda text: own.encode(text, add_special_tokens=False).ids
            return
        import tiktoken

        made = lambda pattern: tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=added)
        whole, short = made(WORDS), made(WORDS.replace(self._lookahead, ""))
        marks = re.compile("|".join(map(re.escape, added))) if added else None
        pick = lambda e: lambda text: e.encode(text, allowed_special="all") if marks and marks.search(text) else e.encode_ordinary(text)
        self._encode, self._plain = pick(whole), pick(short)

    @staticmethod
    def _ranks(spec: dict) -> dict[bytes, int] | None:
        """Bytes and id of each token, if ids order the merges and nothing else shapes the ids; else None."""
        model, split = spec["model"], spec.get("pre_tokenizer") or {}
        plain = model.get("type") == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        plain &= split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and split.get("use_regex", True) and not spec.get("normalizer")
        plain &= all(not t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
        if not plain:
            return None
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = [model["vocab"].get(a + b) for a, b in merges]
        byte_of = _byte_of()
        added = {t["content"] for t in spec["added_tokens"]}
        ranks = {bytes(byte_of[c] for c in token): k for token, k in model["vocab"].items() if token not in added}
        return ranks if None not in made and made == sorted(made) and len(ranks) == len(merges) + 256 else None

    def ids(self, text: str) -> np.ndarray:
        encode = self._encode if self._adjacent.search(text) else self._plain
        return np.array(encode(text), np.uint32)


def pieces(docs: DataFrame, tokenizer: str, with_ids: bool = True, length: int = LENGTH) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens[, ids]): each document's ids and the end id, cut at multiples of length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer)
        for batch in batches:
            rows: list[tuple] = []
            held = 0
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.append(encoder.ids(text.as_py() or ""), np.uint32(END_ID)).astype("<u4")
                for start in range(0, len(ids), length):
                    piece = ids[start : start + length]
                    row = (doc, start, len(piece), zlib.crc32(piece.tobytes()), len(ids))
                    rows.append((*row, piece) if with_ids else row)
                held += len(ids) * with_ids
                if held > 1 << 22:
                    yield _batch(rows, with_ids)
                    rows, held = [], 0
            if rows:
                yield _batch(rows, with_ids)

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * with_ids
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def _batch(rows: list[tuple], with_ids: bool) -> pa.RecordBatch:
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids
    columns = list(zip(*rows, strict=True))
    arrays = [pa.array(c, pa.int64()) for c in columns[:5]]
    if with_ids:
        arrays.append(pa.array([x.astype(np.int32) for x in columns[5]], pa.list_(pa.int32())))
    return pa.RecordBatch.from_arrays(arrays, names)


@dataclass
class Plan:
    """Patterns (counts by length) with the number of sequences that use each, and the linear program's lower bound."""

    patterns: list[dict[int, int]]
    uses: list[int]
    bound: float


def plan(histogram: dict[int, int], length: int = LENGTH, gap: float = GAP) -> Plan:
    """A packing of the histogram's lengths into sequences, by column generation and rounding."""
    sizes = np.array(sorted((k for k, v in histogram.items() if v), reverse=True), np.int64)
    if not len(sizes):
        return Plan([], [], 0.0)
    demand = np.array([histogram[int(k)] for k in sizes], float)
    basis, amount, bound = _column_generation(sizes, demand, length, gap)
    left = demand.astype(np.int64)
    patterns, uses = [], []
    for j in np.argsort(-amount, kind="stable"):
        column = basis[:, j].astype(np.int64)
        used = column > 0
        times = int(min(np.floor(amount[j] + 1e-9), (left[used] // column[used]).min()))
        if times > 0:
            left -= times * column
            patterns.append({int(sizes[k]): int(column[k]) for k in np.flatnonzero(used)})
            uses.append(times)
    while left.any():
        room, column = length, {}
        for k in np.flatnonzero(left):
            fit = int(min(left[k], room // sizes[k]))
            if fit:
                column[int(sizes[k])] = fit
                room -= fit * int(sizes[k])
            if not room:
                break
        times = int(min(left[np.searchsorted(-sizes, -s)] // n for s, n in column.items()))
        for s, n in column.items():
            left[np.searchsorted(-sizes, -s)] -= times * n
        patterns.append(column)
        uses.append(times)
    return Plan(patterns, uses, bound)


def _column_generation(sizes: np.ndarray, demand: np.ndarray, length: int, gap: float) -> tuple[np.ndarray, np.ndarray, float]:
    """Basis matrix (lengths x patterns), amounts and lower bound: a revised simplex whose columns a knapsack prices."""
    m = len(sizes)
    basis, amount = _first_basis(sizes, demand, length)
    inverse, bound, before = _inverse(basis), float((demand * sizes).sum()) / length, np.inf
    for turn in range(60 * m):
        price = inverse.sum(0)
        value, column = _knapsack(sizes, price, length)
        total = amount.sum()
        bound = max(bound, total / value) if value > 0 else bound
        if value <= 1 + 1e-7 or total - bound <= gap * total:
            break
        if turn % (2 * m) == 0:
            if total > (1 - gap / 10) * before:
                break
            before = total
        used = np.flatnonzero(column)
        direction = (inverse[:, used] * column[used]).sum(1)
        ratio = np.where(direction > 1e-10, np.maximum(amount, 0) / np.where(direction > 1e-10, direction, 1), np.inf)
        out = int(ratio.argmin())
        step = ratio[out]
        amount -= step * direction
        amount[out] = step
        basis[:, out] = column
        row = inverse[out] / direction[out]
        inverse -= np.outer(direction, row)
        inverse[out] = row
        if turn % 400 == 399:
            inverse = _inverse(basis)
            amount = (inverse * demand).sum(1)
    return basis, np.maximum(amount, 0), float(bound)


def _inverse(a: np.ndarray) -> np.ndarray:
    """Gauss-Jordan with row pivots, in plain array steps: threaded LAPACK calls can stall for minutes beside a busy JVM."""
    m = len(a)
    both = np.concatenate([a.astype(float), np.eye(m)], axis=1)
    for k in range(m):
        top = k + int(np.abs(both[k:, k]).argmax())
        both[[k, top]] = both[[top, k]]
        both[k] /= both[k, k]
        rows = np.flatnonzero(both[:, k])
        rows = rows[rows != k]
        both[rows] -= np.outer(both[rows, k], both[k])
    return both[:, m:]


def _first_basis(sizes: np.ndarray, demand: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """A feasible basis by decreasing lengths: column j is made for length j and filled up with shorter ones still in demand.

    Columns hold nothing longer than their own length, so the matrix is triangular and invertible.
    """
    m = len(sizes)
    basis, amount, left = np.zeros((m, m)), np.zeros(m), demand.copy()
    for j in range(m):
        n = int(length // sizes[j])
        basis[j, j] = n
        amount[j] = times = left[j] / n
        left[j] = 0.0
        room = length - n * int(sizes[j])
        if times <= 0:
            continue
        for k in np.flatnonzero((left > times) & (sizes <= room)):
            fit = int(min(room // sizes[k], left[k] // times))
            if fit > 0:
                basis[k, j] = fit
                left[k] -= fit * times
                room -= fit * int(sizes[k])
            if room < sizes[-1]:
                break
    return basis, amount


def _knapsack(sizes: np.ndarray, price: np.ndarray, length: int) -> tuple[float, np.ndarray]:
    """Best total price of lengths that fit, and how often each is taken, by dynamic programming over the room left."""
    worth = np.full(length + 1, -np.inf)
    worth[sizes] = price
    worth[0] = 0.0
    best, pick = np.zeros(length + 1), np.zeros(length + 1, np.int64)
    smallest = int(sizes[-1])
    for room in range(smallest, length + 1):
        total = worth[smallest : room + 1] + best[room - smallest :: -1][: room - smallest + 1]
        k = int(total.argmax())
        if total[k] > best[room - 1]:
            best[room], pick[room] = total[k], smallest + k
        else:
            best[room] = best[room - 1]
    column, room, at = np.zeros(len(sizes)), length, {int(s): i for i, s in enumerate(sizes)}
    while room >= smallest:
        if pick[room]:
            column[at[int(pick[room])]] += 1
            room -= int(pick[room])
        else:
            room -= 1
    return float(best[length]), column


def parts_of(n: int) -> int:
    """Parts in which a class of n rows is ranked: about PART rows each, or for smaller classes up to 64 of about a thousand."""
    return max(-(-n // PART), min(64, -(-n // 1024)))


class Places:
    """Sequence and place in it by class and rank: the runs of ranks that each pattern takes of a class."""

    def __init__(self, done: Plan):
        runs: dict[int, list[tuple[int, int, int, int]]] = {}
        base, ranks = 0, {}
        for pattern, times in zip(done.patterns, done.uses, strict=True):
            place = 0
            for size, n in sorted(pattern.items(), reverse=True):
                first = ranks.get(size, 0)
                ranks[size] = first + n * times
                runs.setdefault(size, []).append((first, base, n, place))
                place += n
            base += times
        self.runs = {size: np.array(r, np.int64).T for size, r in runs.items()}

    def find(self, size: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, place = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
        for s in np.unique(size):
            rows = size == s
            first, base, n, at = self.runs[int(s)]
            k = np.searchsorted(first, rank[rows], "right") - 1
            inner = rank[rows] - first[k]
            sequence[rows], place[rows] = base[k] + inner // n[k], at[k] + inner % n[k]
        return sequence, place


def pack(docs: DataFrame, tokenizer: str, with_ids: bool = True, length: int = LENGTH, grain: int = GRAIN) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset [, ids].

    Null and empty texts are one piece of the end id alone; a text of any length is cut into as many pieces as it
    needs, and its ids are held by one task. Rows of one doc_id, repeated or not, are packed one by one; pieces that tie
    in rank are alike in all that is ranked. An empty table gives an empty table. Other columns of the input are
    ignored, whatever their names. A class is ranked in parts of about PART rows. What reaches the driver is the count
    of each class and of each part of the large ones; what workers get is these counts and the plan's runs, whose number
    depends on the classes alone.
    """
    spark = docs.sparkSession
    cut = materialise(pieces(docs, tokenizer, with_ids, length).withColumn("size", F.ceil(F.col("length") / grain)), "pieces")
    histogram = {r["size"]: r["n"] for r in cut.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = F.create_map(*[F.lit(x).cast("long") for s, n in histogram.items() for x in (s, parts_of(n))]) if histogram else F.create_map(F.lit(0).cast("long"), F.lit(1).cast("long"))
    cut = cut.withColumn("part", F.pmod(F.xxhash64("doc_id", "start"), F.element_at(parts, F.col("size"))))
    known = cut.groupBy("size", "part").agg(F.count(F.lit(1)).alias("n")).orderBy("size", "part").collect()
    before: dict[int, np.ndarray] = {}
    for s in histogram:
        counts = np.zeros(parts_of(histogram[s]), np.int64)
        for r in known:
            if r["size"] == s:
                counts[r["part"]] = r["n"]
        before[s] = np.cumsum(counts) - counts
    shared = spark.sparkContext.broadcast((Places(plan(histogram, length // grain)), before))

    @F.arrow_udf("struct<sequence_id:long,place:long>")
    def find(size: pa.Array, part: pa.Array, local: pa.Array) -> pa.Array:
        places, offsets = shared.value
        s, p, k = (x.to_numpy(zero_copy_only=False) for x in (size, part, local))
        rank = k.astype(np.int64)
        for one in np.unique(s):
            rank[s == one] += offsets[int(one)][p[s == one]]
        return pa.StructArray.from_arrays([pa.array(x) for x in places.find(s, rank)], ["sequence_id", "place"])

    by_rank = W.partitionBy("size", "part").orderBy("doc_id", "start", "ids_crc32")
    ranked = cut.withColumn("local", (F.row_number().over(by_rank) - 1).cast("long"))
    placed = ranked.withColumn("at", find("size", "part", "local")).select("*", "at.sequence_id", "at.place")
    within = W.partitionBy("sequence_id").orderBy("place").rowsBetween(W.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("length").over(within), F.lit(0).cast("long"))
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", offset.alias("offset"), *["ids"] * with_ids)
