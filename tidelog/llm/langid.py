"""Language identification: script ranges narrow the candidates, Viterbi over per-word scores labels spans.

The model is word counts and hashed character-trigram counts by language, learned from a bounded sample of labelled
texts, plus the scripts each language writes in. A word scores log-likelihood ratios against the best language, from its
own counts if it was seen and from its trigrams otherwise, and only for languages that write its script. A text's
labels are the path of highest total score, where every change of language costs a fixed penalty; equal labels in a row
are a span.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: First and last code point of the scripts that are told apart.
SCRIPTS = (
    ("latin", 0x41, 0x24F),
    ("latin", 0x1E00, 0x1EFF),
    ("greek", 0x370, 0x3FF),
    ("cyrillic", 0x400, 0x52F),
    ("armenian", 0x530, 0x58F),
    ("hebrew", 0x590, 0x5FF),
    ("arabic", 0x600, 0x77F),
    ("devanagari", 0x900, 0x97F),
    ("bengali", 0x980, 0x9FF),
    ("tamil", 0xB80, 0xBFF),
    ("thai", 0xE00, 0xE7F),
    ("georgian", 0x10A0, 0x10FF),
    ("hangul", 0x1100, 0x11FF),
    ("kana", 0x3040, 0x30FF),
    ("han", 0x3400, 0x9FFF),
    ("hangul", 0xAC00, 0xD7AF),
)
WORD = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"
#: Cost of a change of language between two words, in nats.
SWITCH = 9.0
#: A word's score never sets languages further apart than this.
WORST = -6.0
#: Labelled texts learned from, for each language (in expectation: rows are drawn by a hash).
SAMPLE = 1500
#: Words a model keeps of each language's sample, by count.
MAX_WORDS = 30_000
GRAMS = 1 << 14
#: Languages of a model, and bytes of its two score tables; with 1,000 languages or fewer words and buckets come to the figures above.
MAX_LANGUAGES, MODEL_BYTES = 8192, 256 << 20
#: Weight of a trigram score, as neighbouring trigrams say much the same.
GRAM_WEIGHT = np.float32(0.5)
#: A script counts as a language's own from this share of its words on.
OWN_SCRIPT = 0.01
#: Scored words a worker keeps.
CACHE = 200_000
#: Bytes of their scores, and of the scores of the words whose paths are found at once.
CACHE_BYTES, PATH_BYTES = 64 << 20, 64 << 20
#: Words whose paths are found at once, of few languages.
BLOCK = 400_000


def scripts_of(words: list[str]) -> np.ndarray:
    """Number of each word's script by its first letter, -1 for none: an index into SCRIPT_NAMES."""
    first = np.frombuffer("".join(w[0] for w in words).encode("utf-32-le", "surrogatepass"), np.uint32)
    out = np.full(len(words), -1)
    for name, a, b in SCRIPTS:
        out[(first >= a) & (first <= b)] = SCRIPT_NAMES.index(name)
    return out


SCRIPT_NAMES = list(dict.fromkeys(name for name, _, _ in SCRIPTS))


def grams(words: list[str], buckets: int = GRAMS) -> tuple[np.ndarray, np.ndarray]:
    """Trigram buckets of all words one after the other, and how many each word has; words carry a start and an end mark."""
    codes = np.frombuffer(("^" + "$^".join(words) + "$").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    mix = lambda h, c: (h * np.uint64(1000003) + c) & np.uint64(0xFFFFFFFF)
    h = mix(mix(codes[:-2], codes[1:-1]), codes[2:])
    count = np.fromiter(map(len, words), np.int64, len(words))
    until = np.cumsum(count + 2)
    inner = np.ones(len(codes), bool)
    inner[until - 1] = inner[until - 2] = False
    return ((h ^ (h >> np.uint64(15))) % np.uint64(buckets)).astype(np.int64)[inner[:-2]], count


@dataclass
class Model:
    """Log-likelihoods by language: seen words (row in a table), trigram buckets, and which languages write a script."""

    languages: list[str]
    words: dict[str, int] = field(default_factory=dict)
    table: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), np.float32))
    grams: np.ndarray = field(default_factory=lambda: np.zeros((GRAMS, 0), np.float32))
    scripts: np.ndarray = field(default_factory=lambda: np.zeros((len(SCRIPT_NAMES) + 1, 0), bool))

    def score(self, words: list[str]) -> np.ndarray:
        """(words, languages): 0 for a word's best language; languages that don't write its script get the worst score."""
        seen = np.fromiter((self.words.get(w.lower(), -1) for w in words), np.int64, len(words))
        out = np.zeros((len(words), len(self.languages)), np.float32)
        out[seen >= 0] = self.table[seen[seen >= 0]]
        new = np.flatnonzero(seen < 0)
        if len(new):
            at, count = grams([words[k].lower() for k in new], len(self.grams))
            out[new] = GRAM_WEIGHT * np.add.reduceat(self.grams[at], np.cumsum(count) - count, axis=0)
        out[~self.scripts[scripts_of(words)]] = -np.inf
        return np.maximum(out - out.max(1, keepdims=True), WORST)


def learn(docs: DataFrame, lang: str = "lang", text: str = "text", sample: int = SAMPLE) -> Model:
    """A model of the labelled rows; null labels and texts teach nothing, and no label at all gives a model without languages.

    Every label is a language of the model, however rare, up to MAX_LANGUAGES, the most frequent: a column of labels that
    holds more is no column of languages. The sample is drawn by a hash of doc_id and text, so that a text which repeats
    is not drawn whole or not at all. Of each language's words the most frequent of its sample are kept, MAX_WORDS or as
    many as a model of MODEL_BYTES has room for; trigrams share as many buckets as it has room for.
    """
    labelled = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    counts = labelled.groupBy(F.col(lang).alias("_lang")).agg(F.count(F.lit(1)).alias("_n")).orderBy(F.desc("_n"), "_lang").limit(MAX_LANGUAGES).collect()
    languages = sorted(r["_lang"] for r in counts)
    if not languages:
        return Model([])
    at = {x: i for i, x in enumerate(languages)}
    room = MODEL_BYTES // (4 * len(languages))
    buckets, most = min(GRAMS, 1 << max(8, (room // 2).bit_length() - 1)), min(MAX_WORDS, max(20, room // 2 // len(languages)))
    shares = F.broadcast(docs.sparkSession.createDataFrame([(r["_lang"], min(1.0, sample / r["_n"])) for r in counts], "_lang string, _share double"))
    labelled = labelled.join(shares, F.col(lang).cast("string") == F.col("_lang"))
    own = [F.col("doc_id")] if "doc_id" in docs.columns else []
    drawn = F.pmod(F.xxhash64(F.col(text), *own, F.lit("sample")), F.lit(1 << 30)) < F.col("_share") * (1 << 30)
    rows = labelled.where(drawn).select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for language, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for word, n in Counter(WORD.findall(value.as_py())).items():
                    seen[at[language], "w", word.lower()] += n
            if len(seen) > 500_000:
                yield _counted(seen)
                seen = Counter()
        yield _counted(seen)

    table = rows.mapInArrow(count, "language int, word string, n long").groupBy("language", "word").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(W.partitionBy("language").orderBy(F.desc("n"), "word"))
    kept = table.withColumn("rank", rank).where(F.col("rank") <= most).collect()
    by_word: dict[str, np.ndarray] = {}
    for r in kept:
        by_word.setdefault(r["word"], np.zeros(len(languages)))[r["language"]] = r["n"]
    if not by_word:
        return Model([])
    words = sorted(by_word, key=lambda w: (-by_word[w].sum(), w))
    counts = np.stack([by_word[w] for w in words])
    total = counts.sum(0)
    by_gram = np.full((buckets, len(languages)), 0.5)
    bucket, each = grams(words, buckets)
    np.add.at(by_gram, bucket, np.repeat(np.sqrt(counts), each, axis=0))
    scripts = np.zeros((len(SCRIPT_NAMES) + 1, len(languages)))
    np.add.at(scripts, scripts_of(words), counts)
    own = scripts >= OWN_SCRIPT * np.maximum(total, 1)
    own[-1] = True
    own[~own.any(1)] = True
    table = np.log((counts + 0.5) / (total + 0.5 * len(words)))[counts.sum(1) >= 3].astype(np.float32)
    return Model(
        languages, {w: k for k, w in enumerate([w for w, n in zip(words, counts.sum(1), strict=True) if n >= 3])}, table, np.log(by_gram / by_gram.sum(0)).astype(np.float32), own
    )


def _counted(seen: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([k[0] for k in seen], pa.int32()),
            pa.array([k[2] for k in seen], pa.string()),
            pa.array(list(seen.values()), pa.int64()),
        ],
        ["language", "word", "n"],
    )


class Scores:
    """Rows of words in a growing score table; words without a letter have row -1. A cache of bounded size."""

    def __init__(self, model: Model):
        self.model, self.rows, self.table, self.used = model, {}, np.zeros((1 << 6, len(model.languages)), np.float32), 0
        self.most = CACHE_BYTES // (4 * max(1, len(model.languages)))

    def of(self, texts: list[list[str]]) -> list[np.ndarray]:
        if self.used > min(CACHE, self.most):
            self.__init__(self.model)
        new = [w for w in set().union(*texts) if w not in self.rows]
        spelled = [w for w in new if w.isalpha() or any(map(str.isalpha, w))]
        self.rows.update(dict.fromkeys(new, -1))
        if spelled:
            need = self.used + len(spelled)
            if need > len(self.table):
                self.table = np.concatenate([self.table, np.zeros((need, self.table.shape[1]), np.float32)])
            self.table[self.used : need] = self.model.score(spelled)
            self.rows.update(zip(spelled, range(self.used, need), strict=True))
            self.used = need
        return [np.fromiter(map(self.rows.__getitem__, t), np.int64, len(t)) for t in texts]


def paths(scores: np.ndarray, lengths: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Best language of every word: scores are (words, languages) of texts one after the other, lengths their words (1 or more).

    All texts advance together, the longest first, so that those still running are a prefix.
    """
    order = np.argsort(-lengths, kind="stable")
    starts, long = (np.cumsum(lengths) - lengths)[order], lengths[order]
    running = np.searchsorted(-long, -np.arange(long[0]), side="left")
    back = np.zeros(scores.shape, bool)  # True: the word before has the best language so far
    best = np.zeros(len(scores), np.int16)  # that language, kept with the word after it
    value = scores[starts].copy()
    for t in range(1, long[0]):
        n = running[t]
        at, now = starts[:n] + t, value[:n]
        top = now.argmax(1)
        jump = now[np.arange(n), top] - switch
        moved = jump[:, None] > now
        best[at], back[at] = top, moved
        value[:n] = np.where(moved, jump[:, None], now) + scores[at]
    label = np.zeros(len(scores), np.int16)
    state = value.argmax(1).astype(np.int16)
    for t in range(long[0] - 1, -1, -1):
        n = running[t]
        at = starts[:n] + t
        label[at] = state[:n]
        state[:n] = np.where(back[at, state[:n]], best[at], state[:n])
    return label


def label(texts: list[str | None], model: Model, scores: Scores, switch: float = SWITCH) -> list[tuple[str, float, list[tuple[str, int, int]]]]:
    """(language, share of the words it labels, spans (language, start, end)) of each text; `und` without a letter or a language."""
    out: list = [(UNKNOWN, 0.0, [])] * len(texts)
    if not model.languages:
        return out
    rows = scores.of([WORD.findall(t) if t else [] for t in texts])
    spelled = [r[r >= 0] for r in rows]
    full = [k for k, r in enumerate(spelled) if len(r)]
    if not full:
        return out
    lengths = np.array([len(spelled[k]) for k in full])
    found = paths(scores.table[np.concatenate([spelled[k] for k in full])], lengths, switch)
    for k, got in zip(full, np.split(found, np.cumsum(lengths)[:-1]), strict=True):
        share = np.bincount(got, minlength=len(model.languages))
        top = int(share.argmax())
        out[k] = (model.languages[top], float(share[top] / len(got)), _spans(texts[k], rows[k] >= 0, got, model.languages))
    return out


def _spans(text: str, letters: np.ndarray, labels: np.ndarray, languages: list[str]) -> list[tuple[str, int, int]]:
    turns = np.flatnonzero(np.diff(labels)) + 1
    if not len(turns):
        return [(languages[labels[0]], 0, len(text))]
    words = [m.start() for m, ok in zip(WORD.finditer(text), letters, strict=True) if ok]
    edges = [0, *(words[t] for t in turns), len(text)]
    return [(languages[labels[t]], a, b) for t, a, b in zip([0, *turns], edges, edges[1:], strict=False)]


def identify(docs: DataFrame, model: Model, keep: list[Column], text: str = "text", switch: float = SWITCH) -> DataFrame:
    """The kept columns, lang_pred, score and spans (array of lang, start, end in code points) of every whole text.

    Null and empty texts and texts without a letter are `und` with score 0 and no span. A row's result depends on its
    text alone, whole and however long, so repeated rows agree; an empty table gives an empty table. A kept column named
    like a result gives way to it.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    results = {"lang_pred": "string", "score": "double", "spans": "array<struct<lang:string,start:int,end:int>>"}

    def made() -> Callable[[pa.Array], list[pa.Array]]:
        scores = Scores(shared.value)

        def run(texts: pa.Array) -> list[pa.Array]:
            found = label(texts.to_pylist(), shared.value, scores, switch)
            spans = [[{"lang": x, "start": a, "end": b} for x, a, b in f[2]] for f in found]
            kind = pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
            return [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()), pa.array(spans, kind)]

        return run

    size = min(6 * BLOCK, max(1, 6 * PATH_BYTES // (4 * max(1, len(model.languages)))))
    return by_text(docs, keep, text, results, made, size)


def by_text(docs: DataFrame, keep: list[Column], text: str, results: dict[str, str], made: Callable[[], Callable[[pa.Array], list[pa.Array]]], size: int = 6 * BLOCK) -> DataFrame:
    """The kept columns, but for those named like a result, and the results of each text: made() in a worker gives a function of a block of texts of so many bytes."""
    names = docs.select(*keep).columns
    some = [k for k, n in enumerate(names) if n not in results]
    row = F.struct(F.lit(0).alias("n"), *[keep[k].alias(f"c{k}") for k in some])
    rows = docs.select(F.col(f"`{text}`").cast("string").alias("text"), row.alias("kept"))
    schema = f"kept {rows.schema['kept'].dataType.simpleString()}, " + ", ".join(f"{n} {t}" for n, t in results.items())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = made()
        for batch in batches:
            for at, n in blocks(batch.column(0), size):
                part = batch.slice(at, n)
                yield pa.RecordBatch.from_arrays([part.column(1), *found(part.column(0))], ["kept", *results])

    return rows.mapInArrow(run, schema).select(*[F.col("kept")[f"c{k}"].alias(names[k]) for k in some], *results)


def blocks(texts: pa.Array, size: int = BLOCK * 6) -> Iterator[tuple[int, int]]:
    """(first row, rows) of stretches of a batch whose texts together hold about size bytes, one row at least."""
    at, held = 0, 0
    for k, value in enumerate(texts):
        n = value.as_buffer().size if value.is_valid else 0
        if k > at and held + n > size:
            yield at, k - at
            at, held = k, 0
        held += n
    if at < len(texts):
        yield at, len(texts) - at


def held_out(doc_id: Column) -> Column:
    """True for the quarter of the documents whose labels are never learned from; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))
