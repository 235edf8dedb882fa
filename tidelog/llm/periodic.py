"""Periodic runs of words, by the runs theorem.

A run is a longest stretch with one smallest period; its root of that length holds a word that is Lyndon under the order
of the letters or under the inverse order, and that is the longest Lyndon word at its start. So all runs come from two
lists of longest Lyndon words, one for each order. The longest Lyndon word at i ends before the next suffix that is
smaller, which is a next-smaller value of the inverse suffix array. A root is extended to the right by the longest
common prefix of the suffixes at its start and its end, a range minimum over the LCP array, and to the left the same way
in the reversed text.

Documents that cannot hold a run of the asked length are told by their n-grams first: a run of length L and period q
with L >= q * exponent repeats the same L - q words, so some n-gram of that size stands there twice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Words of the shortest run, and its least length as a multiple of its period.
LENGTH, EXPONENT = 24, 3
RUN = T.StructType().add("start", "long").add("length", "long").add("period", "long")
_MIX = np.uint64(0x9E3779B97F4A7C15)
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def suffix_ranks(letters: np.ndarray) -> np.ndarray:
    """Inverse suffix array of letters (0 and up) by prefix doubling; a suffix is smaller than what it begins."""
    n = len(letters)
    rank, step = np.unique(letters, return_inverse=True)[1].astype(np.int64), 1
    while True:
        key = (rank + 1) * (n + 1)
        key[: max(n - step, 0)] += rank[step:] + 1
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        fresh = np.append(False, ordered[1:] != ordered[:-1])
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(fresh)
        if rank[order[-1]] == n - 1:
            return rank
        step *= 2


def lyndon_ends(rank: np.ndarray) -> np.ndarray:
    """For each place the end of the longest Lyndon word there: the next place of smaller rank, n without one."""
    n = len(rank)
    ends, waiting, ranks = np.full(n, n, np.int64), [], rank.tolist()
    for at, r in enumerate(ranks):
        while waiting and ranks[waiting[-1]] > r:
            ends[waiting.pop()] = at
        waiting.append(at)
    return ends


def neighbour_lcp(letters: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """For each rank but the last the longest common prefix with the suffix of the next rank, in order of places."""
    n = len(letters)
    suffix = np.empty(n, np.int64)
    suffix[rank] = np.arange(n)
    common, ranks, order, text, h = [0] * n, rank.tolist(), suffix.tolist(), letters.tolist(), 0
    for at in range(n):
        r = ranks[at]
        if r == n - 1:
            h = 0
            continue
        other = order[r + 1]
        while at + h < n and other + h < n and text[at + h] == text[other + h]:
            h += 1
        common[r] = h
        h = max(h - 1, 0)
    return np.array(common[: n - 1], np.int64)


def common_prefixes(lcp: np.ndarray, rank: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Longest common prefixes of suffixes i and j (unequal): range minima, level by level of the sparse table.

    A level serves the queries of its length and makes way for the next, so that memory stays in proportion to the text.
    """
    a, b = np.minimum(rank[i], rank[j]), np.maximum(rank[i], rank[j])
    level = np.frexp((b - a).astype(np.float64))[1] - 1
    out, table = np.zeros(len(i), np.int64), lcp
    for k in range(int(level.max(initial=-1)) + 1):
        of = np.flatnonzero(level == k)
        out[of] = np.minimum(table[a[of]], table[b[of] - (1 << k)])
        if len(table) > 1 << k:
            table = np.minimum(table[: len(table) - (1 << k)], table[1 << k :])
    return out


def runs(letters: np.ndarray, length: int = LENGTH, exponent: int = EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of at least so many letters and periods (2 or more), by start and period."""
    n = len(letters)
    if n < length or not may_repeat(letters, length, exponent):
        return []
    up = suffix_ranks(letters)
    down = suffix_ranks(letters.max() - letters)
    places = np.arange(n)
    i, j = np.tile(places, 2), np.concatenate([lyndon_ends(up), lyndon_ends(down)])
    able = (j < n) & ((j - i) * exponent <= n)
    i, j = np.unique(np.stack([i[able], j[able]]), axis=1)
    right = common_prefixes(neighbour_lcp(letters, up), up, i, j)
    back = letters[::-1]
    behind = suffix_ranks(back)
    left = np.zeros(len(i), np.int64)
    inner = np.flatnonzero(i > 0)
    left[inner] = common_prefixes(neighbour_lcp(back, behind), behind, n - i[inner], n - j[inner])
    start, period = i - left, j - i
    long = period + left + right
    kept = (long >= length) & (long >= exponent * period)
    return sorted({(int(s), int(m), int(p)) for s, m, p in zip(start[kept], long[kept], period[kept], strict=True)}, key=lambda r: (r[0], r[2]))


def may_repeat(letters: np.ndarray, length: int, exponent: int) -> bool:
    """False only if no run of that length and exponent can be there: if no n-gram of the words it repeats stands twice."""
    size = length - length // exponent
    if len(letters) <= size:
        return False
    h, have = letters.astype(np.uint64), 1
    while have < size:  # hashes of `have` letters, doubled with an overlap at the last step
        step = min(have, size - have)
        h = (h[: len(h) - step] * _MIX ^ (h[: len(h) - step] >> np.uint64(29))) + h[step:]
        have += step
    h.sort()
    return bool((h[1:] == h[:-1]).any())


def collapsed(found: list[tuple[int, int, int]], n: int) -> np.ndarray:
    """Which of n words stay: those that no run holds behind its first period."""
    edges = np.zeros(n + 1, np.int64)
    for start, length, period in found:
        edges[start + period] += 1
        edges[start + length] -= 1
    return np.cumsum(edges[:n]) == 0


def periodic_runs(docs: DataFrame, carried: list[Column], text: str = "text", length: int = LENGTH, exponent: int = EXPONENT) -> DataFrame:
    """Carried columns, n_words, runs (array of start, length, period by start and period) and collapsed, the words that stay.

    Words are runs of characters other than space and U+0009 to U+000D, compared whole. Null, empty and blank texts have
    no words and an empty collapsed text. Each row is one document, repeated or not; texts are taken whole, in memory in
    proportion to their words. Columns that are not carried are not looked at. An empty table gives an empty one.
    """
    rows = docs.select(F.col(f"`{text}`").cast("string").alias("text"), F.struct(F.lit(0).alias("_"), *carried).alias("carried"))
    carries = rows.schema["carried"].dataType
    schema = T.StructType().add("carried", carries).add("n_words", "long").add("runs", T.ArrayType(RUN)).add("collapsed", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, spans, texts = [], [], []
            for value in batch.column(0):
                words = (value.as_py() or "").encode().split()
                found = _of_words(words, length, exponent)
                stay = collapsed(found, len(words)) if found else None
                n_words.append(len(words))
                spans.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in found])
                texts.append(b" ".join(words if stay is None else [w for w, s in zip(words, stay, strict=True) if s]))
            columns = [batch.column(1), pa.array(n_words, pa.int64()), pa.array(spans, _RUNS), pa.array(texts, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["carried", "n_words", "runs", "collapsed"])

    found = rows.mapInArrow(run, schema)
    return found.select(*[F.col("carried")[f.name].alias(f.name) for f in carries.fields[1:]], "n_words", "runs", "collapsed")


def _of_words(words: list[bytes], length: int, exponent: int) -> list[tuple[int, int, int]]:
    if len(words) < length:
        return []
    hashes = np.fromiter(map(hash, words), np.int64, len(words))
    if not may_repeat(hashes, length, exponent):
        return []
    numbers: dict[bytes, int] = {}
    return runs(np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words)), length, exponent)


def strongest(found: Column) -> Column:
    """Of an array of runs the one of the greatest exact length / period, then of the smallest start, then period."""

    def better(a: Column, b: Column) -> Column:
        x, y = b["length"] * a["period"], a["length"] * b["period"]
        return F.when(a.isNull() | (x > y), b).otherwise(a)  # runs come by start and period, so ties stay with the first

    return F.aggregate(found, F.lit(None).cast(RUN), better)


def planted(text: Column, doc_id: Column) -> Column:
    """The text, or for a tenth of ids (by their CRC-32) one whose words repeat from some place on with some period."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)
    words = F.array_remove(F.split(F.coalesce(text, F.lit("")), "[ \t-\r]+"), "")
    n = F.size(words).cast("long")
    a = F.pmod(g, F.greatest(n, F.lit(1)))
    p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))
    again = lambda xs, a, p: F.transform(xs, lambda w, i: F.when(i < a, w).otherwise(F.get(xs, (a + F.pmod(i - a, p)).cast("int"))))
    made = F.transform(F.array(F.struct(words.alias("w"), a.alias("a"), p.alias("p"))), lambda x: F.array_join(again(x["w"], x["a"], x["p"]), " "))[0]
    return F.when(F.pmod(h, F.lit(10)) == 0, made).otherwise(text)


