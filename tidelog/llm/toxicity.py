"""Toxicity by cumulative-link ordinal regression on sparse word features.

P(grade <= k) = sigmoid(threshold_k - w.x): one weight vector is shared by all ordered thresholds. Features are words and
beginnings of words that go with toxic labels or with their absence in the labelled sample, by log count. The result is
the expected grade.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.sources.scratch import materialise

from .langid import by_text

WORD = re.compile(r"[^\W\d_]+")
#: Labelled documents learned from (in expectation: they are drawn by a hash).
SAMPLE = 12_000
#: Features kept: of all words of the sample those that stand out most.
FEATURES = 2_000
#: A feature's signed root of the likelihood-ratio statistic is this at least.
STANDS_OUT = 5.0
PENALTY = 3e-4
#: Letters of a word's beginning, and the chance of a grade above 0 from which on a text counts as toxic.
PREFIX, CUT = 5, 0.25


def tokens(text: str | None) -> Counter:
    """Counts of the lower-case words of a text and, with a star, of the beginnings of longer ones."""
    found = WORD.findall((text or "").lower())
    out = Counter(found)
    out.update([w[:PREFIX] + "*" for w in found if len(w) >= PREFIX])
    return out


@dataclass
class Model:
    weights: dict[str, float]
    thresholds: np.ndarray

    def margin(self, words: Counter) -> float:
        get = self.weights.get
        return sum(w * np.log1p(n) for x, n in words.items() if (w := get(x)))

    def above(self, margins: np.ndarray) -> np.ndarray:
        """(n, thresholds): chance that the grade is above each threshold."""
        return 1 / (1 + np.exp(self.thresholds[None] - margins[:, None]))


def fit(x: list[dict[int, float]], y: np.ndarray, features: int, grades: int, penalty: float = PENALTY, steps: int = 400) -> tuple[np.ndarray, np.ndarray]:
    """Weights and increasing thresholds by full-batch Adam on the ordinal log-likelihood; gaps between thresholds are exp(.)."""
    row = np.repeat(np.arange(len(x)), [len(d) for d in x])
    col = np.fromiter((k for d in x for k in d), np.int64, len(row))
    val = np.fromiter((v for d in x for v in d.values()), float, len(row))
    share = np.clip([(y <= k).mean() for k in range(grades - 1)], 1e-3, 1 - 1e-3)
    start = np.log(share / (1 - share))
    params = np.concatenate([np.zeros(features), start[:1], np.log(np.maximum(np.diff(start), 1e-2))])
    first, second = np.zeros_like(params), np.zeros_like(params)
    sigmoid = lambda t: 1 / (1 + np.exp(-np.clip(t, -50, 50)))
    for t in range(1, steps + 1):
        w, base, gaps = params[:features], params[features], np.exp(params[features + 1 :])
        cuts = base + np.concatenate([[0.0], np.cumsum(gaps)])
        margin = np.bincount(row, w[col] * val, len(x))
        low = np.where(y > 0, sigmoid(cuts[np.maximum(y - 1, 0)] - margin), 0.0)
        high = np.where(y < grades - 1, sigmoid(cuts[np.minimum(y, grades - 2)] - margin), 1.0)
        chance = np.maximum(high - low, 1e-12)
        d_high, d_low = high * (1 - high) / chance, low * (1 - low) / chance
        d_margin = (d_high - d_low) / len(x)
        grad = np.zeros_like(params)
        grad[:features] = np.bincount(col, d_margin[row] * val, features) + penalty * w
        d_cut = np.zeros(grades - 1)
        np.add.at(d_cut, np.minimum(y, grades - 2)[y < grades - 1], -d_high[y < grades - 1] / len(x))
        np.add.at(d_cut, (y - 1)[y > 0], d_low[y > 0] / len(x))
        grad[features] = d_cut.sum()
        grad[features + 1 :] = np.cumsum(d_cut[::-1])[::-1][1:] * gaps
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad * grad
        params -= 0.05 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-9)
    return params[:features], params[features] + np.concatenate([[0.0], np.cumsum(np.exp(params[features + 1 :]))])


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model | None:
    """A model from labels (doc_id, toxic 0 or 1; nulls teach nothing) and the texts they name; None without both labels.

    The labels are binary, so severity is graded by what they imply: 0 is not toxic, toxic texts with at most the median
    amount (sum of log counts) of features that go with toxic labels are 1, those with more 2.
    """
    known = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    n = known.count()
    share = min(1.0, sample / max(n, 1))
    known = known.where(F.pmod(F.xxhash64("doc_id", F.lit("toxic")), F.lit(1 << 30)) < share * (1 << 30))
    texts = docs.where("text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = materialise(texts.join(F.broadcast(known), "doc_id").select("doc_id", "toxic", "text"), "labelled")
    # a doc_id may stand in many rows: so that the sample stays bounded these are drawn from as well
    most = min(1.0, 2 * sample / max(rows.count(), 1))
    rows = rows.where(F.pmod(F.xxhash64("doc_id", "text", F.lit("row")), F.lit(1 << 30)) < most * (1 << 30)).select("toxic", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, list[int]] = {}
        for batch in batches:
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for word in tokens(text.as_py()):
                    seen.setdefault(word, [0, 0])[toxic > 0] += 1
            if len(seen) > 500_000:
                yield _counts(seen)
                seen = {}
        yield _counts(seen)

    per = rows.mapInArrow(count, "word string, clean long, toxic long").groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    size = {r["toxic"]: r["n"] for r in rows.groupBy((F.col("toxic") > 0).alias("toxic")).agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(size) < 2:
        return None
    per = per.withColumn("z", _stands_out(F.col("clean"), F.col("toxic"), size[False], size[True]))
    table = per.orderBy(F.desc(F.abs("z")), "word").limit(FEATURES).collect()
    best = [r for r in table if abs(r["z"]) >= STANDS_OUT] or table[:20]
    place = {r["word"]: i for i, r in enumerate(best)}
    marks = {r["word"] for r in best if r["z"] > 0}

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic, at, value, amount = [], [], [], []
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = tokens(text.as_py())
                found = {place[w]: n for w, n in words.items() if w in place}
                toxic.append(label)
                at.append(list(found))
                value.append([float(np.log1p(n)) for n in found.values()])
                amount.append(float(sum(np.log1p(n) for w, n in words.items() if w in marks)))
            yield pa.RecordBatch.from_arrays([pa.array(toxic, pa.int32()), pa.array(at, pa.list_(pa.int32())), pa.array(value, pa.list_(pa.float64())), pa.array(amount, pa.float64())], ["toxic", "at", "value", "amount"])

    made = rows.mapInArrow(features, "toxic int, at array<int>, value array<double>, amount double").collect()
    made.sort(key=lambda r: (r["toxic"], r["amount"], r["at"], r["value"]))
    toxic, amount = np.array([r["toxic"] > 0 for r in made]), np.array([r["amount"] for r in made])
    grade = np.where(toxic, 1 + (amount > np.median(amount[toxic])), 0)
    x = [dict(zip(r["at"], r["value"], strict=True)) for r in made]
    weights, thresholds = fit(x, grade, len(place), 3)
    return Model({w: float(weights[i]) for w, i in place.items()}, thresholds)


def _stands_out(a: Column, b: Column, n_a: int, n_b: int) -> Column:
    """Signed root of the likelihood-ratio statistic of a of n_a texts against b of n_b."""
    share = (a + b) / F.lit(float(n_a + n_b))
    part = lambda seen, awaited: F.when(seen > 0, seen * F.log(seen / awaited)).otherwise(0.0)
    g = part(a, n_a * share) + part(n_a - a, n_a * (1 - share)) + part(b, n_b * share) + part(n_b - b, n_b * (1 - share))
    return F.sqrt(F.greatest(2 * g, F.lit(0.0))) * F.signum(b / n_b - a / n_a)


def _counts(seen: dict[str, list[int]]) -> pa.RecordBatch:
    values = list(seen.values())
    return pa.RecordBatch.from_arrays(
        [pa.array(list(seen), pa.string()), pa.array([v[0] for v in values], pa.int64()), pa.array([v[1] for v in values], pa.int64())],
        ["word", "clean", "toxic"],
    )


def grade(docs: DataFrame, model: Model | None, keep: list[Column], text: str = "text") -> DataFrame:
    """The kept columns, severity (expected grade), grade (the likeliest, of equal ones the lowest) and toxic (the chance of a grade above 0 is over CUT).

    Texts are read whole, however long. Null and empty texts score as a text without marking words. Without a model
    every severity is null and no row is toxic. A row's result depends on its text alone; an empty table gives an empty
    table. A kept column named like a result gives way to it.
    """
    results = {"severity": "double", "grade": "int", "toxic": "boolean"}
    if model is None:
        names = docs.select(*keep).columns
        kept = [c for c, n in zip(keep, names, strict=True) if n not in results]
        return docs.select(*kept, F.lit(None).cast("double").alias("severity"), F.lit(None).cast("int").alias("grade"), F.lit(False).alias("toxic"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(texts: pa.Array) -> list[pa.Array]:
        own = shared.value
        above = own.above(np.array([own.margin(tokens(t.as_py())) for t in texts]))
        chance = -np.diff(np.column_stack([np.ones(len(texts)), above, np.zeros(len(texts))]), axis=1)
        return [pa.array(above.sum(1)), pa.array(chance.argmax(1).astype(np.int32)), pa.array(above[:, 0] > CUT)]

    return by_text(docs, keep, text, results, lambda: run)
