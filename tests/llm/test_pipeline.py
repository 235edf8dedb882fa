"""The pipeline against a plain version of every stage, and its stages on awkward rows."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from tests.llm.test_operators import SF, components
from tidelog.llm import copies, langid, packing, queries, secrets, simhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def key(*parts):
    return hashlib.md5("|".join(["mix-1", *map(str, parts)]).encode()).hexdigest()


def mixed(docs):
    """(doc_id, source, text) -> Counter of (doc_id, text) the mix takes."""
    skey = lambda s: "1" if s is None else "0" + s
    size = {d: len(WORD.findall(t or "")) for d, _, t in docs}
    per = defaultdict(list)
    for d, s, t in docs:
        per[skey(s)].append((d, t))
    total = {s: sum(size[d] for d, _ in v) for s, v in per.items()}
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sorted(per))}
    target, left = {}, 1.5 * sum(total.values())
    while True:
        free = [s for s in per if s not in target]
        level = left / max(1, sum(weight[s] for s in free))
        over = [s for s in free if weight[s] * level > 2 * total[s] + 1e-9]
        if not over:
            break
        for s in over:
            target[s], left = 2 * total[s], left - 2 * total[s]
    target |= {s: weight[s] * level for s in per if s not in target}
    out = Counter()
    for s, rows in per.items():
        words = int(target[s] + 0.5)
        whole = words // total[s] if total[s] else 0
        rest = words - whole * total[s]
        blocks = sorted(((key(s, key(d)[:3]), key(d)[:3], key(d), d, t) for d, t in rows))
        for *_, d, t in blocks:
            part = max(0, min(rest, size[d]))
            rest -= part
            out[d, t] += whole if size[d] else 0
            if part:
                out[d, t if part == size[d] else t[: list(WORD.finditer(t))[part].start()]] += 1
    return +out


def test_against_plain_stages(spark):
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.learn(frame.where(~langid.held_out(F.col("doc_id"))))
    rows = [(r["doc_id"], r["source"], r["text"]) for r in frame.collect()]
    found = langid.label([t for *_, t in rows], model, langid.Scores(model))
    rows = [r for r, (lang, share, _) in zip(rows, found, strict=True) if lang != "und" and share >= P.LEAST_SHARE]
    sets = {d: word_sets(t) for d, _, t in rows}
    comps = components({d: {e for e in sets if e != d and alike(sets[d], sets[e])} for d in sets})
    rows = [r for r in rows if comps[r[0]] == r[0]]
    clean = []
    for (d, s, t), spans in zip(rows, secrets.find([t for *_, t in rows], secrets.network()), strict=True):
        out, at = "", 0
        for kind, a, b, _ in spans:
            out += t[at:a] + f"<secret:{kind}>" if a >= at else ""
            at = max(at, b)
        clean.append((d, s, out + t[at:]))
    want = Counter()
    encoder = packing.Encoder(queries.tokenizer_path())
    for (d, t), n in mixed(clean).items():
        ids = np.append(encoder.ids(t), np.uint32(0)).astype("<u4")
        for at in range(0, len(ids), 1024):
            want[d, at, len(ids[at : at + 1024]), zlib.crc32(ids[at : at + 1024].tobytes()), len(ids)] += n
    got = P.run(spark, SF).collect()
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in got) == want
    for _, pieces in _by_sequence(got).items():
        ends = [a + n for a, n in sorted(pieces)]
        assert [a for a, _ in sorted(pieces)] == [0, *ends[:-1]] and ends[-1] <= 1024


def word_sets(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def alike(a, b):
    """5-word shingles of similarity 0.8 or more; two texts without a word are alike."""
    small, large = sorted((len(a), len(b)))
    if 5 * small < 4 * large or not large:
        return not large
    both = len(a & b)
    return 5 * both >= 4 * (len(a) + len(b) - both)


def test_near_copies(spark, monkeypatch):
    """Edited copies of every degree, chains, and hot groups cut into pieces: the classes of all pairs compared in plain Python."""
    monkeypatch.setattr(copies, "PIECE", 16)
    rng = np.random.default_rng(5)
    bases = [[f"w{k}" for k in rng.integers(0, 2000, n)] for n in (7, 30, 120, 400, 900)]
    texts = [None, "", " \n", "one", "ONE", "one two", "a b c d e", "A b c d e f"]
    for base in bases:
        now = list(base)
        for k in range(40):
            edited = list(base)
            for at in rng.integers(0, len(base), rng.integers(0, 1 + len(base) // 25)):
                edited[at] = f"x{rng.integers(0, 50)}"
            now[int(rng.integers(0, len(now)))] = f"y{k}"
            texts += [" ".join(edited), "\t".join(now).upper()]
    texts += texts[:20]
    order = rng.permutation(len(texts))
    frame = spark.createDataFrame([(int(k), texts[k], 1, "x") for k in order], "doc_id long, text string, node int, keys string").repartition(5)
    sets = {k: word_sets(t) for k, t in enumerate(texts)}
    want = components({d: {e for e in sets if e != d and alike(sets[d], sets[e])} for d in sets})
    found = copies.near_copies(frame)
    got = {r["doc_id"]: r["component_id"] for r in found.collect()}
    assert got == want and 10 < len(set(want.values())) < len(texts) - 100
    kept = simhash.deduplicated(frame, found)
    assert kept.columns == frame.columns and {r["doc_id"] for r in kept.collect()} == set(want.values())


def test_stage_keeps_5_words_at_08():
    assert (copies.SHINGLE, copies.SIMILARITY) == (5, 0.8)


def test_stages_send_small_batches_to_python(spark):
    """40 MB of texts in one partition, which went to Python in one batch, go in batches of a bounded size, whole."""
    wide = spark.range(0, 2000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), 20_000).alias("text"))

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["n", "size"])

    before = {name: spark.conf.get(name) for name in P.BATCHES}
    try:
        for _, stage in P.STAGES:
            for name, value in before.items():
                spark.conf.set(name, value)
            stage(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF)
            found = wide.mapInArrow(sizes, "n long, size long").collect()
            assert sum(r["n"] for r in found) == 2000 and max(r["size"] for r in found) < 5 << 20
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def _by_sequence(rows):
    out = defaultdict(list)
    for r in rows:
        out[r["sequence_id"]].append((r["offset"], r["length"]))
    return out


def test_texts_in_four_languages_stay(spark):
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    long = [frame.where((F.col("lang") == x) & (F.col("n_chars") > 600)).orderBy("doc_id").first()["text"] for x in ("en", "de", "fr", "es")]
    mixed = " ".join(" ".join(t.split()[:60]) for t in long)
    added = frame.limit(1).withColumn("doc_id", F.lit(10**6)).withColumn("text", F.lit(mixed)).select(frame.columns)
    assert P.language_id(spark, frame.unionByName(added), SF).where(f"doc_id = {10**6}").count() == 1


@pytest.mark.parametrize("empty", [False, True])
def test_stages_on_awkward_rows(spark, empty):
    """Nulls, clashing names, repeated rows, and no rows at all go through every stage."""
    names = "doc_id long, text string, lang string, source string, n_chars long, score int, spans string, row string, mix string, shard int, size long"
    text = "Ein Text mit token = 'abc123def456' und noch mehr Worten."
    rows = [(1, text, "de", "a", 5), (1, text, "de", "a", 5), (2, None, None, None, None), (None, "no id here", None, None, 3), (4, "", "de", "a", 0), (5, "1 2 3", "en", "b", 5)]
    frame = spark.createDataFrame([] if empty else [(*r, 1, "s", "r", "m", 2, 3) for r in rows], names)
    for name, stage in P.STAGES:
        out = stage(spark, frame, SF)
        done = out.collect()
        if name != "packing":
            assert out.columns == frame.columns
        if empty:
            assert done == []
        elif name == "language_id":
            assert Counter(r["doc_id"] for r in done) == {1: 2, None: 1}
        elif name == "simhash_near_dedup":
            assert Counter(r["doc_id"] for r in done) == {1: 1, 2: 1, 5: 1, None: 1}
        elif name == "secret_scan":
            assert [r["n_chars"] == len(r["text"]) for r in done if r["doc_id"] == 1] == [True] * 2 and "abc123" not in str(done)
