"""Repeated windows, periodic runs and resampling: awkward rows, and the operators against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter
from fractions import Fraction
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.oracle import assert_same, duck
from tidelog.llm import periodic, queries, repeats, resample
from tidelog.sources import scratch

SF = "/root/testdata/sf0.001"
#: Names that the operators use inside, as columns of the input.
DOCS = "doc_id long, text string, tid string, spans string, carried string, row string, words string, score string, rank string"


def docs(spark, rows):
    return spark.createDataFrame([(*r, *["x"] * 7) for r in rows], DOCS)


AWKWARD = [(1, "ab " * 400), (1, "ab " * 400), (2, None), (3, ""), (4, " \n\t"), (None, "no id " + "word " * 90), (None, None), (5, "é" * 700), (6, "word " * 30_000), (7, "The one. " * 3)]


def covered(texts, window):
    """Which bytes of each text a window covers that starts twice or more, by counting all windows."""
    seen = Counter(t[i : i + window] for t in texts for i in range(len(t) - window + 1))
    out = []
    for t in texts:
        mask = bytearray(len(t))
        for i in range(len(t) - window + 1):
            if seen[t[i : i + window]] > 1:
                mask[i : i + window] = b"\1" * window
        out.append(mask)
    return out


def check_repeats(found, texts, window):
    """found: rows (n, n_bytes, spans, kept) by number of text."""
    for row, text, mask in zip(sorted(found), texts, covered(texts, window), strict=True):
        _, n_bytes, spans, kept = row
        own = bytearray(len(text))
        for a, b in spans:
            own[a:b] = b"\1" * (b - a)
        assert n_bytes == len(text) and own == mask and bytes(kept) == bytes(c for c, m in zip(text, mask, strict=True) if not m)
        assert all(b < c for (_, b), (c, _) in zip(spans, spans[1:]))


def run_repeats(spark, texts, **kw):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = repeats.without_repeats(frame, [F.col("doc_id")], **kw).collect()
    return [(r.doc_id, r.n_bytes, [tuple(s) for s in r.spans], r.kept) for r in found]


@pytest.mark.parametrize("seed", range(4))
def test_repeated_windows_are_those_of_all_pairs(spark, seed):
    """Few letters make ties of anchors, periods and passages that begin and end anywhere; small windows make many of them."""
    rng = random.Random(seed)
    text = lambda n, letters="ab": "".join(rng.choices(letters, k=n))
    shared = [text(rng.randint(20, 90), "abcdefgh") for _ in range(6)]
    texts = []
    for _ in range(60):
        parts = [rng.choice([text(rng.randint(0, 30), "abcdefgh"), rng.choice(shared), rng.choice(shared)[rng.randint(0, 9) :], "ab" * rng.randint(0, 40), "a" * rng.randint(0, 60)]) for _ in range(rng.randint(0, 7))]
        texts.append("".join(parts))
    texts += texts[:5] + ["", "a" * 31, "a" * 32, "a" * 33]
    check_repeats(run_repeats(spark, texts, window=32, gram=8, block=5), [t.encode() for t in texts], 32)


def test_repeated_windows_beyond_a_chunk(spark, monkeypatch):
    """Stretches of one anchor that chunks of the scan cut, in long texts."""
    monkeypatch.setattr(repeats, "CHUNK", 97)
    rng = random.Random(5)
    base = "".join(rng.choices("abcd ", k=3000))
    texts = [base.encode(), (base[:1500] + "#" + base[1400:]).encode()]
    data, edges = b"".join(texts), np.cumsum([0, *map(len, texts)])
    cut = repeats.anchors(np.frombuffer(data, np.uint8), edges, 40, 16)
    monkeypatch.setattr(repeats, "CHUNK", 1 << 19)
    whole = repeats.anchors(np.frombuffer(data, np.uint8), edges, 40, 16)
    assert all((a == b).all() for a, b in zip(cut, whole, strict=True))
    assert sum(last - first + 1 for _, first, last, _ in zip(*whole, strict=True)) == sum(len(t) - 39 for t in texts)


def test_repeats_of_awkward_rows(spark, monkeypatch):
    want = {}
    for few, texts in ((10**6, 10**6), (-1, 10**6), (-1, -1)):  # keys broadcast and shuffled; texts that have places shuffled, and all
        monkeypatch.setattr(repeats, "FEW", few)
        monkeypatch.setattr(repeats, "FEW_TEXTS", texts)
        found = repeats.without_repeats(docs(spark, AWKWARD), [F.col("doc_id"), F.col("spans").alias("theirs"), F.col("carried").alias("kept_name")]).collect()
        rows = sorted((r.doc_id or -1, r.n_bytes, str(r.spans), bytes(r.kept)) for r in found)
        assert len(rows) == len(AWKWARD) and all(r.theirs == "x" for r in found)
        assert want.setdefault("rows", rows) == rows
    by = {r.doc_id: r for r in found}
    assert by[2].n_bytes == 0 and by[2].spans == [] and bytes(by[2].kept) == b""
    assert len(by[1].kept) == 0 and len(by[5].kept) == 0 and by[5].n_bytes == 1400 and len(by[6].kept) == 0
    assert bytes(by[7].kept) == b"The one. " * 3
    assert repeats.without_repeats(docs(spark, []), [F.col("doc_id")]).count() == 0


def test_op11_is_brute_force(spark):
    table = queries.table(spark, SF, "documents").toPandas()
    texts = [(t or "").encode() for t in table.text]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.op11_suffix_array_dedup(spark, SF).collect()}
    for doc_id, text, mask in zip(table.doc_id, texts, covered(texts, 400), strict=True):
        kept = bytes(c for c, m in zip(text, mask, strict=True) if not m)
        spans = sum(m and not (k and mask[k - 1]) for k, m in enumerate(mask))
        assert got[doc_id] == (len(text), sum(mask), spans, hashlib.sha256(kept).hexdigest())


def test_repeated_windows_of_large_buckets(spark, monkeypatch):
    """One passage in many surroundings: its buckets have more kinds than are compared in a task, and are dealt out by window."""
    monkeypatch.setattr(repeats, "MANY", 1)
    rng = random.Random(8)
    text = lambda n: "".join(rng.choices("abcdefgh", k=n))
    shared = text(40)
    texts = [text(rng.randint(0, 40)) + shared[rng.randint(0, 7) : rng.randint(33, 40)] + text(rng.randint(0, 40)) for _ in range(50)]
    check_repeats(run_repeats(spark, texts, window=32, gram=8, block=5), [t.encode() for t in texts], 32)


def test_rows_of_a_pass_do_not_stay(spark):
    """Rows of all passes stayed on disk till the end, most of a text's size together; and 400 bytes repeat, not so many words."""
    docs = queries.table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text")
    rng = random.Random(6)
    planted, words = [], []
    for k, size in enumerate((399, 400, 520)):
        passage = " ".join("".join(rng.choices("bcdfgh", k=rng.randint(4, 6))) for _ in range(200))[:size]
        words.append(len(passage.split()))
        planted += [(-2 * k - 1, f"<{2 * k}>{passage}[{k}"), (-2 * k - 2, f"({2 * k}){passage}]{k}")]
    docs = docs.unionByName(spark.createDataFrame(planted, docs.schema))
    size = lambda: sum(f.stat().st_size for f in Path(scratch.shared_dir(spark).removeprefix("file://")).rglob("*.parquet"))
    before, total = size(), docs.agg(F.sum(F.octet_length("text"))).first()[0]
    found = repeats.without_repeats(docs, [F.col("doc_id")])
    removed = {r.doc_id: [b - a for a, b in r.spans] for r in found.where("doc_id < 0").collect()}
    assert size() - before < total / 8
    assert min(words) > 50 and removed == {-1: [], -2: [], -3: [400], -4: [400], -5: [520], -6: [520]}


def plain_runs(words, length, exponent):
    """All stretches that keep a period and end at both sides, without those that keep a smaller one too."""
    n, found = len(words), []
    for q in range(1, n // exponent + 1):
        at = 0
        while at + q < n:
            end = at
            while end + q < n and words[end] == words[end + q]:
                end += 1
            size = end - at + q
            if end > at and size >= max(length, exponent * q) and not any(s <= at and s + m >= at + size for s, m, _ in found):
                found.append((at, size, q))
            at = max(end, at) + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def test_runs_are_all_runs():
    for seed in range(300):
        rng = np.random.default_rng(seed)
        parts = [np.tile(rng.integers(0, 3, rng.integers(1, 6)), rng.integers(1, 9)) if rng.random() < 0.6 else rng.integers(0, 3, rng.integers(1, 9)) for _ in range(rng.integers(1, 9))]
        words = np.concatenate(parts)
        for length, exponent in ((2, 2), (6, 3), (24, 3)):
            assert periodic.runs(words, length, exponent) == plain_runs(words.tolist(), length, exponent)


def test_runs_of_long_texts():
    """Two periods over many words, and none in random ones; time and memory stay in proportion."""
    words = np.concatenate([np.arange(1000) + 5, np.tile(np.arange(3), 60_000), np.arange(1000) + 5])
    assert periodic.runs(words) == [(1000, 180_000, 3)]
    assert periodic.runs(np.random.default_rng(1).integers(0, 9000, 300_000)) == []


def test_runs_of_awkward_rows(spark):
    found = periodic.periodic_runs(docs(spark, AWKWARD), [F.col("doc_id"), F.col("carried").alias("odd name, or not")]).collect()
    by = {r.doc_id: r for r in found}
    assert len(found) == len(AWKWARD) and by[2].n_words == 0 and by[2].collapsed == "" and by[4].collapsed == ""
    assert [tuple(r) for r in by[1].runs] == [(0, 400, 1)] and by[1].collapsed == "ab"
    assert [tuple(r) for r in by[6].runs] == [(0, 30_000, 1)] and by[7].runs == [] and by[7].collapsed == "The one. The one. The one."
    assert periodic.periodic_runs(docs(spark, []), [F.col("doc_id")]).count() == 0


def test_op12_is_brute_force(spark):
    got = {r.doc_id: r for r in queries.op12_periodic_runs(spark, SF).collect()}
    table = queries.table(spark, SF, "documents").toPandas()
    assert len(got) == len(table)
    some = 0
    for doc_id, text in zip(table.doc_id, table.text, strict=True):
        words = (text or "").encode().split()
        n, h = len(words), zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        found = plain_runs(words, 24, 3) if n < 3000 else periodic.runs(np.unique(words, return_inverse=True)[1])
        some += bool(found)
        top = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
        dropped = {i for s, m, q in found for i in range(s + q, s + m)}
        digest = lambda x: hashlib.sha256(x).hexdigest()
        r = got[doc_id]
        assert (r.n_runs, (r.start, r.length, r.period)) == (len(found), top)
        assert r.exponent_milli == (1000 * top[1] // top[2] if found else None)
        assert r.runs_sha256 == digest("".join(f"{s},{m},{q}\n" for s, m, q in found).encode())
        assert r.collapsed_sha256 == digest(b" ".join(w for i, w in enumerate(words) if i not in dropped))
    assert some > 5


def test_op13_is_its_sql(spark):
    assert_same(queries.op13_importance_resampling(spark, SF).toPandas(), duck(SF, queries.OP13_SQL))


def plain_weights(texts, target, order, buckets):
    words = lambda t: [w for w in "".join(c if c.isdigit() and c.isascii() or "a" <= c <= "z" or ord(c) > 127 else " " for c in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")).split(" ") if w]
    grams = lambda ws: [" ".join(ws[i : i + k]) for k in range(1, order + 1) for i in range(len(ws) - k + 1)]
    code = lambda g: zlib.crc32(g.encode()) % buckets
    features = [[code(g) for g in grams(words(t))] for t in texts]
    s, t = Counter(b for f in features for b in f), Counter(code(g) for x in target for g in grams(words(x)))
    n, m = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = {b: math.floor(1000 * math.log(((t[b] + 1) * n) / ((s[b] + 1) * m))) for b in s}
    return [(len(f), sum(gain[b] for b in f)) for f in features]


@pytest.mark.parametrize("order", [1, 2, 3])
def test_resampling_of_awkward_rows(spark, order):
    """Also longer n-grams; equal rows are documents of their own, a null id is one, and ties go to the smaller id."""
    rows = [*AWKWARD, *[(100 + k, f"Some words number {k % 7} of a TEXT that is long enough to be drawn, été {k % 3} and so on: one two three four five six") for k in range(40)]]
    target = spark.createDataFrame([("some words of a text",), (None,), ("one two three",)], "text string")
    found = resample.resample(docs(spark, rows), target, order=order, buckets=97, percent=25, carried=["score", "rank"]).collect()
    want = Counter((d, *w) for (d, _), w in zip(rows, plain_weights([t for _, t in rows], ["some words of a text", "one two three"], order, 97), strict=True))
    assert Counter((r.doc_id, r.n_features, r.weight) for r in found) == want
    assert all(tuple(r.carried) == ("x", "x") for r in found)
    able = sorted((r for r in found if r.n_words >= 20), key=lambda r: (-r.score, r.doc_id is None, r.doc_id or 0))
    drawn = sorted((r for r in found if r["rank"]), key=lambda r: r["rank"])
    assert [r["rank"] for r in drawn] == list(range(1, len(able) * 25 // 100 + 1))
    assert [(r.score, r.doc_id) for r in drawn] == [(r.score, r.doc_id) for r in able[: len(drawn)]]


def test_resampling_of_nothing(spark):
    none, target = docs(spark, []), spark.createDataFrame([], "text string")
    assert resample.resample(none, target).count() == 0
    assert {r.weight for r in resample.resample(docs(spark, [(1, "one two"), (2, None)]), target).collect()} == {2 * math.floor(1000 * math.log(10_002 / (2 * 10_000))), 0}
