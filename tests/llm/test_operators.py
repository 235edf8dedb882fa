"""Each operator on awkward rows and against a brute-force version."""

from __future__ import annotations

import hashlib
import re
import textwrap
import time
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.oracle import assert_same, duck
from tidelog.llm import chat, langid, licenses, mixing, packing, pivots, quality, queries, secrets, simhash, toxicity

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, row string, spans string, state string"
LONG = "word " * 30_000


def docs(spark, rows):
    return spark.createDataFrame([(*r, 7, "row", "spans", "state")[:9] for r in rows], DOCS)


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls in every column, empty and long texts, repeated rows, and columns that clash with names inside operators."""
    rows = [
        (1, "The MIT one.\nReleased under the MIT License.", "en", "a", 10),
        (1, "The MIT one.\nReleased under the MIT License.", "en", "a", 10),
        (2, None, "en", None, None),
        (3, "", None, "b", 0),
        (4, " \n\t ", "en", "b", 4),
        (5, LONG, "en", "a", len(LONG)),
        (None, "a row without an id", None, None, None),
        (7, "token = 'abcdef123' and AKIA" + "A1" * 10, "en", "c", 30),
    ]
    return docs(spark, rows)


@pytest.fixture(scope="module")
def nothing(spark):
    return docs(spark, [])


APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""
MIT = """MIT License

Copyright (c) 2020 Some Body

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
BSD3 = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""
GPL3 = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.
"""
GPL2 = """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version 2 of the License, or
(at your option) any later version.
"""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at http://mozilla.org/MPL/2.0/.
"""


def test_licenses(spark, awkward, nothing):
    """Published notices as they are printed: plain, in comments, on one line, wrapped anew, behind other lines."""
    got = {r["doc_id"]: r["license_scan"] for r in licenses.scan(awkward).collect()}
    assert got[1]["licenses"] == ["MIT"] and got[2]["licenses"] == [] and got[5]["identifiers"] == []
    assert licenses.scan(nothing).count() == 0 and set(awkward.columns) < set(licenses.scan(awkward).columns)
    marked = lambda text, mark: "\n".join(f"{mark} {line}".rstrip() for line in text.splitlines())
    wrapped = lambda text, n: "\n\n".join("\n".join(textwrap.wrap(p, n)) for p in text.split("\n\n"))
    want = [(APACHE, "Apache-2.0"), (MIT, "MIT"), (BSD3, "BSD-3-Clause"), (GPL3, "GPL-3.0-or-later"), (GPL2, "GPL-2.0-or-later"), (MPL, "MPL-2.0")]
    cases = [(made, [name]) for text, name in want for made in (
        text, marked(text, "#"), marked(text, "//"), "/*\n" + marked(text, " *") + "\n */\n", wrapped(text, 40), wrapped(text, 5000), "Some title\n\n" + text + "\nint main() {}", text.replace("\n", "\r\n"),
    )]
    cases += [(f"{mark}SPDX-License-Identifier: {name}\nx = 1", [name]) for name in licenses.SPDX for mark in ("", "// ", "# ", "/* ")]
    cases += [("A line without an end\nReleased under the MIT License.", ["MIT"]), ("Copyright 2020 X. All rights reserved.", ["Proprietary"]), ("The license of the software is unknown.", []), (MIT + "\n" + APACHE, ["Apache-2.0", "MIT"])]
    rows = docs(spark, [(k, text, "en", "a", 0) for k, (text, _) in enumerate(cases)]).withColumn("license_scan", F.lit("clash"))
    seen = {r["doc_id"]: r["license_scan"] for r in licenses.scan(rows).select("doc_id", "license_scan").collect()}
    assert [(k, seen[k]["licenses"]) for k in seen] == [(k, cases[k][1]) for k in seen]
    assert all(not seen[k]["unmatched"] for k in seen)
    assert all(any(h in s for h in licenses.HINTS) for _, s in licenses.SENTENCES)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_oracles(spark, name):
    assert_same(queries.queries()[name](spark, SF).toPandas(), duck(SF, queries.oracle_sql()[name]))


def base_statistics(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    hit = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(hit)


def test_quality_counts(spark, awkward, nothing):
    repeats = "a b c d e f a b c d e g h i\nx y\nx y\n\n\n" + "é # é # é # é # é"
    frame = awkward.unionByName(docs(spark, [(9, repeats, "en", "a", 1)]))
    for row in quality.judge(frame).collect() + queries.op2_quality_rules(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text"), "doc_id").collect():
        q = row["quality"] if "quality" in row else row
        want = base_statistics(row["text"])
        assert tuple(q[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == want
        assert q["base_failed"] == (want[0] < 10 or 100 * want[4] > 20 * want[0]) and not (q["base_failed"] and q["kept"])
    assert quality.judge(nothing).count() == 0


def mcd(x):
    """The operator's estimate, in numpy: on the grid, from many random starts beside the median and the classical one."""
    step = np.array(quality.STEPS)
    cells = Counter(map(tuple, (np.floor(np.abs(x / step) + 0.5) * np.sign(x / step) * step).tolist()))
    values, n = np.array(sorted(cells)), np.array([cells[c] for c in sorted(cells)], float)

    def estimate(w):
        mean = (w[:, None] * values).sum(0) / w.sum()
        cov = ((w[:, None] * values).T @ values / w.sum() - np.outer(mean, mean)) * quality.CONSISTENT + np.diag(np.square(quality.FLOOR))
        return mean, np.linalg.cholesky(cov)

    def distance(state, v):
        return np.square(np.linalg.solve(state[1], (v - state[0]).T)).sum(0)

    def concentrate(state):
        for _ in range(quality.CONCENTRATIONS):
            d = distance(state, values)
            order = np.lexsort((*values.T[::-1], d))
            before = np.cumsum(n[order]) - n[order]
            w = np.zeros(len(n))
            w[order] = np.clip(np.ceil(n.sum() * quality.CORE) - before, 0, n[order])
            state = estimate(w)
        return state

    median = []
    for j in range(4):
        order = np.argsort(values[:, j], kind="stable")
        median.append(values[order, j][np.searchsorted(np.cumsum(n[order]), n.sum() / 2)])
    rng = np.random.default_rng(1)
    starts = [concentrate((np.array(median), np.diag(2 * np.array(quality.FLOOR)))), concentrate(estimate(n))]
    starts += [concentrate(estimate(n * (rng.random(len(n)) < 0.3) + 1e-9)) for _ in range(30)]
    return distance(min(starts, key=lambda s: np.log(np.diag(s[1])).sum()), x)


def test_quality_outliers(spark):
    rng = np.random.default_rng(5)
    words = ["alpha", "beta", "gamma", "delta", "of", "to", "running", "through"]
    text = lambda n, tail="": " ".join(str(rng.choice(words)) + str(rng.integers(999)) + tail for _ in range(n))
    rows = [(k, text(int(rng.integers(30, 300))), "en", "a", 0) for k in range(60)]
    rows += [(100 + k, text(100, "###$$$"), "en", "a", 0) for k in range(6)] + [(200, "one two three " * 5, "fr", "a", 0)]
    got = {r["doc_id"]: r["quality"] for r in quality.judge(docs(spark, rows)).collect()}
    x = {k: base_statistics(t) for k, t, *_ in rows if k < 200}
    vectors = np.array([[np.log(n), np.log(c / n), np.log1p(100 * s / n), np.log1p(100 * d / n)] for n, c, s, d, _ in x.values()])
    want = dict(zip(x, mcd(vectors), strict=True))
    assert all(abs(got[k]["distance"] - d) < 1e-6 * (1 + d) for k, d in want.items() if not got[k]["base_failed"])
    assert all(got[k]["kept"] for k in range(60) if not got[k]["base_failed"]) and not any(got[100 + k]["kept"] for k in range(6))


def plain_mcd(x, starts=200):
    """The estimate as published, without grid, weights or floor: concentration of the nearest three quarters until nothing moves."""
    rng, h, best = np.random.default_rng(2), int(np.ceil(len(x) * 0.75)), None
    for _ in range(starts):
        at = rng.choice(len(x), 8, replace=False)
        for _ in range(50):
            mean, cov = x[at].mean(0), np.cov(x[at].T, bias=True) + 1e-9 * np.eye(4)
            d = np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)
            new = np.argsort(d, kind="stable")[:h]
            if set(new) == set(at):
                break
            at = new
        det = np.linalg.det(np.cov(x[at].T, bias=True))
        if best is None or det < best[0]:
            best = (det, x[at].mean(0), np.cov(x[at].T, bias=True) * quality.CONSISTENT)
    _, mean, cov = best
    return np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)


def test_quality_against_plain_estimate(spark):
    """Where statistics spread, grid and floor change no verdict: correlated vectors, a tenth of them in a far clump."""
    rng = np.random.default_rng(3)
    mixing_matrix = np.array([[2.0, 0, 0, 0], [0.3, 0.5, 0, 0], [0.8, 0.4, 1.5, 0], [-1.0, 0.2, 0.5, 1.5]])
    x = rng.normal(size=(400, 4)) @ mixing_matrix.T
    x[:40] = x[:40] * 0.2 + np.array([9.0, -3.0, 9.0, 9.0])
    rows = [("=en", "=a", *map(float, v)) for v in x]
    state = quality.estimates(spark.createDataFrame(rows, "lang string, source string, x1 double, x2 double, x3 double, x4 double")).first()["state"]
    lower = np.array([[state[f"l{j}{k}"] if k <= j else 0.0 for k in range(4)] for j in range(4)])
    got = np.square(np.linalg.solve(lower, (x - np.array([state[f"m{j}"] for j in range(4)])).T)).sum(0)
    want = plain_mcd(x)
    assert (got[:40] > quality.CUTOFF).all() and ((got > quality.CUTOFF) == (want > quality.CUTOFF)).all()
    assert np.median(np.abs(got / want - 1)) < 0.15


def test_license_expressions(spark):
    """SPDX expressions licence by licence, versions apart, and notices in common words."""
    cases = {
        "// SPDX-License-Identifier: Apache-2.0 OR MIT\n// Copyright someone": ["Apache-2.0", "MIT"],
        "# SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0": ["GPL-2.0-only", "Classpath-exception-2.0"],
        "SPDX-License-Identifier: (MIT AND Zlib) or GPL-2.0-or-later.": ["GPL-2.0-or-later", "MIT", "Zlib"],
        "/* SPDX-License-Identifier: LGPL-2.1+ */": ["LGPL-2.1-or-later"],
        "SPDX-License-Identifier: GPL-2.0": ["GPL-2.0"],
        "SPDX-License-Identifier: Made-Up-1.0 OR ISC": ["ISC"],
        "SPDX-License-Identifier:": [],
        "This project is dual-licensed under the MIT License and the Apache License, Version 2.0.": ["Apache-2.0 OR MIT"],
        "Licensed under the MIT license (see LICENSE).": ["MIT"],
        "licensed under MIT": ["MIT"],
        "Distributed under the GNU General Public License v3.0": ["GPL-3.0"],
        "Licensed under GPLv2+": ["GPL-2.0-or-later"],
        "Boost Software License - Version 1.0 - August 17th, 2003": ["BSL-1.0"],
        "This is free and unencumbered software released into the public domain.": ["Unlicense"],
        "This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser General Public\nLicense as published by the Free Software Foundation; either\nversion 2.1 of the License, or (at your option) any later version.": ["LGPL-2.1-or-later"],
        "A gift or a loan and 1+1 with care, or later.": [],
    }
    frame = docs(spark, [(k, text, "en", "a", 0) for k, text in enumerate(cases)])
    got = {r["doc_id"]: r["license_scan"] for r in licenses.scan(frame).collect()}
    assert {text: sorted(got[k]["licenses"]) for k, text in enumerate(cases)} == {text: sorted(want) for text, want in cases.items()}
    assert all(not s["unmatched"] for s in got.values())
    con = duckdb.connect()
    con.register("documents", frame.toPandas())
    told = {r[0]: r[2] for r in con.execute(queries.oracle_sql()["op1_license_scan"]).fetchall()}
    assert {k: sorted(told[k].split(",") if told[k] else []) for k in told} == {k: sorted(s["licenses"]) for k, s in got.items()}


def test_quality_of_small_groups(spark):
    """A source per site: its documents are judged by their language, a lone language's by all documents."""
    rng = np.random.default_rng(6)
    text = lambda n, tail="": " ".join(f"word{rng.integers(9999)}{tail}" for _ in range(n))
    rows = [(k, text(int(rng.integers(30, 300))), "en", f"site{k % 25}", 0) for k in range(100)]
    rows += [(200 + k, text(100, "###$$$"), "en", f"site{k}", 0) for k in range(3)]
    rows += [(300, text(100), "fr", None, 0), (301, text(100, "###$$$"), "fr", None, 0), (302, text(100, "###$$$"), None, "a", 0)]
    got = {r["doc_id"]: r["quality"] for r in quality.judge(docs(spark, rows)).collect()}
    vectors = lambda some: np.array([[np.log(n), np.log(c / n), np.log1p(100 * s / n), np.log1p(100 * d / n)] for n, c, s, d, _ in map(base_statistics, some)])
    want = dict(zip(range(103), mcd(vectors([t for _, t, lang, *_ in rows if lang == "en"])), strict=True))
    want = {k if k < 100 else k + 100: d for k, d in want.items()}
    want |= {r[0]: d for r, d in zip(rows, mcd(vectors([r[1] for r in rows])), strict=True) if r[0] >= 300}
    assert all(abs(got[k]["distance"] - d) < 1e-6 * (1 + d) for k, d in want.items())
    assert [k for k in want if not got[k]["kept"]] == [200, 201, 202, 301, 302]


def brute_viterbi(scores, switch):
    value, paths = scores[0].copy(), [[k] for k in range(scores.shape[1])]
    for s in scores[1:]:
        new, kept = [], []
        for k in range(len(value)):
            costs = [value[j] - (switch if j != k else 0) for j in range(len(value))]
            j = k if costs[k] >= max(costs) else int(np.argmax(costs))
            new.append(costs[j] + s[k])
            kept.append(paths[j] + [k])
        value, paths = np.array(new), kept
    return max(value), paths[int(np.argmax(value))]


def test_viterbi():
    rng = np.random.default_rng(1)
    lengths = np.array([1, 7, 3, 12, 1])
    scores = rng.normal(0, 2, (lengths.sum(), 3))
    got = np.split(langid.paths(scores, lengths, 1.5), np.cumsum(lengths)[:-1])
    for label, s in zip(got, np.split(scores, np.cumsum(lengths)[:-1]), strict=True):
        total = s[np.arange(len(s)), label].sum() - 1.5 * (np.diff(label) != 0).sum()
        assert total == pytest.approx(brute_viterbi(s, 1.5)[0])


def test_language_id(spark, awkward, nothing):
    frame = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.learn(frame.where(~langid.held_out(F.col("doc_id"))))
    held = langid.identify(frame.where(langid.held_out(F.col("doc_id"))), model, [F.col("lang"), F.col("text")])
    rows = held.collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.97
    assert all(0 <= r["score"] <= 1 and r["spans"][-1]["end"] == len(r["text"]) for r in rows if r["lang_pred"] != "und")
    got = {r["doc_id"]: r for r in langid.identify(awkward, model, [F.col("doc_id")]).collect()}
    assert [got[k]["lang_pred"] for k in (2, 3, 4)] == ["und"] * 3 and got[1]["lang_pred"] in model.languages
    a, b = (next(r["text"] for r in rows if r["lang"] == x and len(r["text"]) > 500)[:500] for x in ("en", "de"))
    mixed = langid.label([a + " " + b, "", None, "123 ..."], model, langid.Scores(model))
    assert [s[0] for s in mixed[0][2]] == ["en", "de"] and [m[0] for m in mixed[1:]] == ["und"] * 3
    assert langid.identify(nothing, langid.learn(nothing), [F.col("doc_id")]).count() == 0
    assert langid.identify(awkward, langid.Model([]), [F.col("doc_id")]).where("lang_pred != 'und'").count() == 0


def test_scripts_narrow():
    model = langid.Model(["el", "ru"], {}, np.zeros((0, 2), np.float32), np.zeros((langid.GRAMS, 2), np.float32), np.ones((len(langid.SCRIPT_NAMES) + 1, 2), bool))
    model.scripts[langid.SCRIPT_NAMES.index("greek")] = [True, False]
    model.scripts[langid.SCRIPT_NAMES.index("cyrillic")] = [False, True]
    assert [x[0] for x in langid.label(["αβγ δε", "где это"], model, langid.Scores(model))] == ["el", "ru"]


def test_chat_round_trip():
    for role, text in [("user", "\\### Assistant: </turn> ok"), ("a: b", "</turn>\n### x: y </turn>\n"), ("", ""), ("\\", "\\"), ("r", "é\\\\</turn")]:
        turns, rest = chat.parse(chat.render(role, text) + chat.render("user", "next") + "### half")
        assert [t[:2] for t in turns] == [(role, text), ("user", "next")] and rest == "### half"


def test_chat_digest(spark):
    rows = spark.read.parquet(f"{SF}/conversations.parquet").collect()
    said = defaultdict(list)
    for r in sorted(rows, key=lambda r: r["turn"]):
        said[r["conv_id"]].append((r["role"], r["text"] or ""))
    said[-7] = [(x, "\\### Assistant: </turn> ok") for x in ("user", "assistant")]
    got = {r["conv_id"]: r for r in queries.op4_chat_format(spark, SF).collect()}
    assert set(got) == set(said)
    for k, turns in said.items():
        loss = "".join(t for x, t in turns if x == "assistant")
        assert got[k]["n_turns"] == len(turns) and got[k]["loss_chars"] == len(loss)
        assert got[k]["turns_sha256"] == hashlib.sha256("".join(f"{x}\n{t}\n" for x, t in turns).encode()).hexdigest()
        assert got[k]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
        assert got[k]["formatted_chars"] == sum(len(chat.render(*t)) for t in turns)


def test_chat_fold(spark):
    log = [
        (1, "m1", 0, "message", "user", "hi"), (1, "m2", 1, "message", "assistant", ""), (1, "m2", 2, "delta", None, "Hel"), (1, "m2", 3, "delta", None, "lo"),
        (1, "m2", 4, "regenerate", None, None), (1, "m2", 5, "delta", None, "Bye"), (1, "m1", 6, "edit", None, "hi there"), (1, "m3", 7, "message", "user", "gone"),
        (1, "m3", 8, "delete", None, None), (None, None, None, None, None, None), (None, None, None, None, None, None), (2, "x", 3, "delta", "assistant", "late"),
    ]
    frame = spark.createDataFrame(log, "conv_id long, message_id string, seq long, event string, role string, text string").withColumn("place", F.lit("clash"))
    got = sorted(((r["conv_id"], r["place"], r["role"], r["text"]) for r in chat.fold(frame).collect()), key=str)
    assert got == sorted([(1, 0, "user", "hi there"), (1, 1, "assistant", "Bye"), (2, 3, "assistant", "late"), (None, None, "", "")], key=str)
    text = "".join(r["fragment"] for r in chat.format_log(frame).where("conv_id = 1").orderBy("ordinal").collect())
    assert [t[:2] for t in chat.parse(text)[0]] == [("user", "hi there"), ("assistant", "Bye")]
    assert chat.digest(chat.format_log(frame.limit(0))).count() == 0


def brute_links(rows, cosine):
    usable = {k: (np.array(v), label) for k, v, label in rows if k is not None and v and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    near = lambda a, b: len(a[0]) == len(b[0]) and a[1] == b[1] and a[0] @ b[0] / np.linalg.norm(a[0]) / np.linalg.norm(b[0]) >= cosine
    links = {k: {j for j in usable if j != k and near(usable[k], usable[j])} for k in usable}
    return links, components(links)


def components(links):
    label = {k: k for k in links}
    while True:
        new = {k: min([label[k], *(label[j] for j in links[k])]) for k in links}
        if new == label:
            return label
        label = new


def test_pivots(spark):
    rng = np.random.default_rng(2)
    rows = []
    for k in range(300):
        base = rows[int(rng.integers(len(rows)))][1] if k > 60 and rng.random() < 0.6 else rng.normal(0, 1, 16).tolist()
        rows.append((k, (np.array(base) + rng.normal(0, 0.08, 16)).tolist(), int(k % 2)))
    rows += [(300, rows[3][1], rows[3][2]), (301, [2 * x for x in rows[3][1]], rows[3][2]), (302, rows[3][1], None), (303, None, 1), (304, [0.0] * 16, 1), (305, [None] * 16, 1)]
    rows += [(306, [float("nan")] * 16, 1), (307, [float("inf")] * 16, 1), (308, [], 1), (309, [1.0, 0.0], 1), (310, [1.0, 0.01], 1), (None, rows[3][1], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("node", F.lit("clash")).withColumn("n", F.lit(1))
    got = {r["vec_id"]: r for r in pivots.near_duplicates(frame).collect()}
    links, comps = brute_links(rows, pivots.COSINE)
    true = sum(map(len, links.values()))
    found = sum(got[k]["n_links"] for k in links)
    assert 0.9 * true <= found <= true
    assert np.mean([got[k]["component_id"] == c for k, c in comps.items()]) > 0.9
    assert all(got[k]["n_links"] == 0 and got[k]["kept"] for k in (302, 303, 304, 305, 306, 307, 308, None))
    assert all(got[k]["kept"] == (got[k]["component_id"] == k) for k in links) and got[309]["n_links"] == 1
    assert pivots.near_duplicates(frame.limit(0)).count() == 0


def planted(v, labels, rng):
    """Rows of near copies on top of vectors: pairs just above and below the cosine, chains, exact copies, and a hot group of a third of all rows."""
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    v = unit(v)

    def at(x, cosine):
        y = rng.normal(size=x.shape)
        y = unit(y - (y * x).sum(-1, keepdims=True) * x)
        return cosine * x + np.sqrt(1 - cosine**2) * y

    rows, names = [v], [labels]
    for cosine in (0.925, 0.9295, 0.9305, 0.935, 0.95, 0.99, 1.0):
        some = rng.integers(0, len(v), 400)
        rows.append(at(v[some], cosine))
        names.append(labels[some])
    hot = at(np.repeat(v[:1], 2000, 0), np.sqrt(0.95))
    return np.concatenate([*rows, hot]), np.concatenate([*names, np.repeat(labels[:1], 2000)])


@pytest.mark.parametrize("long", [pivots.LONG, 50])
def test_pivot_recall(spark, monkeypatch, long):
    """Links of thousands of planted near copies on top of sf0.1, many just above and below the cosine, against all pairs."""
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").where("label is not null and embedding is not null").collect()
    v, labels = planted(np.array([r["embedding"] for r in rows], float), np.array([r["label"] for r in rows]), np.random.default_rng(8))
    near = (v @ v.T >= pivots.COSINE) & (labels[:, None] == labels)
    frame = spark.createDataFrame([(k, x, int(y)) for k, (x, y) in enumerate(zip(v.tolist(), labels, strict=True))], "vec_id long, embedding array<double>, label int")
    monkeypatch.setattr(pivots.linked, "__defaults__", (*pivots.linked.__defaults__[:-1], long))
    got = {r["vec_id"]: r["n_links"] for r in pivots.near_duplicates(frame).collect()}
    true, found = near.sum(1) - 1, np.array([got[k] for k in range(len(v))])
    assert true.sum() > 1_000_000 and (found <= true).all()
    lone = true < 100
    assert found.sum() >= 0.95 * true.sum() and found[lone].sum() >= 0.9 * true[lone].sum()


def test_long_lists_give_the_same_links(spark):
    """Dealing a list out again loses no candidate and counts none twice."""
    rng = np.random.default_rng(9)
    v, labels = planted(rng.normal(size=(600, 16)), np.arange(600) % 2, rng)
    frame = spark.createDataFrame([(k, x, str(y), 1) for k, (x, y) in enumerate(zip(v.tolist(), labels, strict=True))], "node long, v array<double>, label string, weight long")
    described = pivots.describe(frame, pivots.draw_pivots(frame))
    count = lambda found: {(r["node"], r["n"]) for r in found.where("edge = 0").groupBy("node").agg(F.sum("n").alias("n")).collect()}
    few = count(pivots.linked(described, block=100, long=10**9))
    assert few == count(pivots.linked(described, block=100, long=60)) and len(few) > 2000


def test_pivots_of_several_lengths(spark):
    """Thousands of vectors of two lengths and one of a third in one label, whose lists are long: all links stay."""
    rng = np.random.default_rng(12)
    rows, want = [], 0
    for size in (16, 24):
        v, _ = planted(rng.normal(size=(900, size)), np.zeros(900, int), rng)
        unit = v / np.linalg.norm(v, axis=1, keepdims=True)
        want += int((unit @ unit.T >= pivots.COSINE).sum()) - len(v)
        rows += v.tolist()
    rows.append(rng.normal(size=17).tolist())
    frame = spark.createDataFrame([(k, x, "one") for k, x in enumerate(rows)], "vec_id long, embedding array<double>, label string")
    assert 0.95 * want <= pivots.near_duplicates(frame).agg(F.sum("n_links")).first()[0] <= want and want > 100_000


def test_pivots_of_one_narrow_bundle(spark):
    """All vectors of a label lie so close together that no two of the sample can both be pivots by distance; a few lie a little off."""
    rng = np.random.default_rng(13)
    axis = np.eye(32)[:1]
    off = rng.normal(size=(3000, 32)) * np.where(np.arange(3000) % 50 == 0, 0.16, 0.05)[:, None]
    v = axis + off
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    want = int((unit @ unit.T >= pivots.COSINE).sum()) - len(v)
    frame = spark.createDataFrame([(k, x, "one") for k, x in enumerate(v.tolist())], "vec_id long, embedding array<double>, label string")
    found = pivots.near_duplicates(frame)
    assert 0.95 * want <= found.agg(F.sum("n_links")).first()[0] <= want and want > 1_000_000
    described = pivots.describe(frame.select(F.col("vec_id").alias("node"), "label", F.col("embedding").alias("v"), F.lit(1).cast("long").alias("weight")), pivots.draw_pivots(frame.select(F.col("embedding").alias("v"))))
    assert described.select(F.size("near")).distinct().collect() == [(pivots.NEAREST,)]


def test_pivot_recall_of_a_hot_group(spark):
    rng = np.random.default_rng(4)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    group = np.sqrt(0.94) * unit(rng.normal(size=(1, 64))) + np.sqrt(0.06) * unit(rng.normal(size=(1000, 64)))
    v = unit(np.concatenate([group, rng.normal(size=(2000, 64))]))
    frame = spark.createDataFrame([(k, x, 1) for k, x in enumerate(v.tolist())], "vec_id long, embedding array<double>, label int")
    true = int((v @ v.T >= pivots.COSINE).sum()) - len(v)
    assert 0.95 * true <= pivots.near_duplicates(frame).agg(F.sum("n_links")).first()[0] <= true


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def brute_spans(text):
    out = [(m.start(), 0, f"assign:{m.start()}:{m.end()}") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, f"access:{m.start()}:{m.end()}") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, f"hex:{m.start()}:{m.end()}") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(x[2] for x in sorted(out))


def test_secret_base(spark, awkward, nothing):
    texts = ["TOKEN : 'abc' token=secret=abcdef", "é api_key=\"" + "f" * 24, "AKIAAKIA" + "Z9" * 9 + " " + "0" * 24, "passwd = short", "paſſword=longenough", "password:\nabcdefg"]
    frame = awkward.select("doc_id", "text").unionByName(spark.createDataFrame([(20 + k, t) for k, t in enumerate(texts)], "doc_id long, text string"))
    frame = frame.unionByName(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select((F.col("doc_id") + 1000).alias("doc_id"), "text"))
    found = secrets.scan(frame, secrets.network(), [F.col("doc_id"), F.col("text")])
    for r in found.select("*", secrets.digest(F.filter("spans", lambda s: s["kind"] != "model")).alias("base")).collect():
        assert r["base"] == brute_spans(r["text"] or "")
    assert secrets.scan(nothing, secrets.network(), [F.col("doc_id")]).count() == 0


def test_secret_network():
    net = secrets.network()
    windows, y = secrets.labelled_findings(800, seed=123)
    hit = net.probability(secrets.encode(windows, secrets.SIDE, secrets.MIDDLE)) >= net.threshold
    assert hit[y == 1].mean() >= 0.9 and hit[y == 0].mean() <= 0.02
    spans = secrets.find(["see ghp_a8Kq0ZtP3mXw7RbV5nLc2DyE9fUh1JsG6oTi for it", "unverantwortlicherweise gut"], net)
    assert [s[0] for s in spans[0]] == ["model"] and spans[1] == []


def test_secrets_in_long_runs_and_odd_values():
    key = "a8Kq0ZtP3mXw7RbV5nLc2DyE9fUh1JsG6oTi"
    path = "/srv/data/projects/archive/reports/{}/yearly/summary/documents/index"
    texts = [path.format(key), path.format("quarterly"), "password: p@ssw0rd!x and more", f"{'0f' * 14}_{key}", "password: abcdefg@x9!Kq2 next", "the password: (see below)"]
    found = secrets.find(texts, secrets.network())
    covered = lambda k, part: all(any(a <= i < b for _, a, b, _ in found[k]) for i in range(texts[k].index(part), texts[k].index(part) + len(part)))
    assert covered(0, key) and covered(2, "p@ssw0rd!x") and covered(3, key) and covered(4, "abcdefg@x9!Kq2")
    assert not found[1] and not found[5]
    for spans in found:
        assert all(b <= c for (_, _, b, _), (_, c, _, _) in zip(spans, spans[1:]))


def test_masking(spark):
    text = "é token = 'abcdef123456' then " + "0f" * 15 + " end"
    frame = spark.createDataFrame([(text, "s"), ("clean", "s"), (None, "s")], "text string, spans string")
    found = secrets.scan(frame, secrets.network(), [F.col("text"), F.col("spans")])
    assert found.columns == ["text", "spans", "clean"]
    assert [r["clean"] for r in found.collect()] == ["é <secret:assign>' then <secret:hex> end", "clean", None]


def test_very_many_candidates():
    """Time grows with the text, not with its square."""
    one = "token=abcdef12 " + "0a" * 13 + " a8Kq0ZtP3mXw7RbV5nLc "
    took = []
    for n in (500, 4000):
        began = time.process_time()
        text = one * n
        spans = secrets.base_spans(text)
        assert len(secrets.candidates(text, spans)) >= n
        took.append(time.process_time() - began)
    assert took[1] < 24 * took[0] + 0.2


def test_windows_of_one_very_long_run():
    """A run of 20 MB without a separator, and one with many: windows reach to the separators around them, in linear time."""
    began = time.process_time()
    text = "aB3" * 7_000_000
    found = secrets.candidates(text, [])
    assert len(found) == -(-(len(text) - secrets.MIDDLE) // (secrets.MIDDLE // 2)) + 1 and all(x[2:] == (0, len(text)) for x in found[:: len(found) // 50])
    text = ("x" * 100 + "/") * 100
    for x, y, a, b in secrets._windows(text, 0, len(text)):
        left, right = max(text.rfind("/", 0, x), text.rfind("=", 0, x)) + 1, text.find("/", y)
        assert (a, b) == (left, right if right >= 0 else len(text))
    assert time.process_time() - began < 60


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(spark, awkward, nothing):
    frame = awkward.select("doc_id", "text", F.lit(1).alias("fp")).unionByName(spark.read.parquet(f"{SF}/documents.parquet").select((F.col("doc_id") + 100).alias("doc_id"), "text", F.lit(1).alias("fp")))
    rows = simhash.near_duplicates(frame).collect()
    want = [(r["doc_id"], brute_fingerprint(r["text"])) for r in frame.collect()]
    assert Counter((r["doc_id"], r["fp"] % (1 << 64)) for r in rows) == Counter(want)
    fps = {f for _, f in want}
    comps = components({f: {g for g in fps if g != f and (f ^ g).bit_count() <= 4} for f in fps})
    lowest = {}
    for k, f in want:
        if k is not None:
            lowest[comps[f]] = min(k, lowest.get(comps[f], k))
    assert all(r["component_id"] == lowest.get(comps[r["fp"] % (1 << 64)]) for r in rows)
    assert simhash.near_duplicates(nothing).count() == 0
    kept = simhash.deduplicated(awkward).collect()
    assert sorted((r["doc_id"] for r in kept), key=str) == sorted([1, 2, 5, 7, None], key=str) and kept[0].__fields__ == awkward.columns


@pytest.mark.parametrize("radius", [0, 3, 4, 7, 8, 15, 24, 31])
def test_bit_planes(radius):
    rng = np.random.default_rng(radius)
    fps = rng.integers(0, 1 << 63, 400, np.uint64)
    for k in range(1, 400, 2):
        fps[k] = fps[k - 1] ^ np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, rng.integers(0, 10), np.uint64), initial=np.uint64(0))
    groups = np.sort(rng.integers(0, 4, 400))
    got = {(int(i), int(j)) for a, b in simhash.near_pairs(fps, groups, radius) for i, j in zip(a, b, strict=True)}
    want = {(i, j) for i in range(400) for j in range(i + 1, 400) if groups[i] == groups[j] and (int(fps[i]) ^ int(fps[j])).bit_count() <= radius}
    assert got == want


def test_hot_buckets(spark, monkeypatch):
    """Chains of neighbours in one bucket stay connected when the bucket is cut into pieces."""
    monkeypatch.setattr(simhash, "PIECE", 7)
    fps = [(k << 4) - (1 << 62) for k in range(40)] + [(1 << 20) + (5 << k) for k in range(0, 40, 9)]
    frame = spark.createDataFrame([(f,) for f in fps], "fp long")
    links = defaultdict(set)
    for r in simhash.links(frame).collect():
        links[r["a"]].add(r["b"]), links[r["b"]].add(r["a"])
    near = {f: {g for g in fps if g != f and ((f ^ g) % (1 << 64)).bit_count() <= 4} for f in fps}
    assert components({f: links[f] for f in fps}) == components(near)


def test_packing(spark, awkward, nothing, monkeypatch):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(queries.tokenizer_path())
    odd = [(90, "a <|endoftext|> b"), (91, "<|endoftext|><|endoftext|>  \n x"), (92, "<|endoftext"), (93, "  two  \u3000 gaps\n\n"), (94, "é \ud7ff 日本語\x00\t\x0b")] + [(95, "tie")] * 40
    frame = awkward.select("doc_id", "text").unionByName(spark.read.parquet(f"{SF}/documents.parquet").select((F.col("doc_id") + 100).alias("doc_id"), "text"))
    frame = frame.unionByName(spark.createDataFrame(odd, "doc_id long, text string")).withColumns({"size": F.lit("clash"), "part": F.lit("clash")})
    monkeypatch.setattr(packing, "PART", 60)
    rows = packing.pack(frame, queries.tokenizer_path()).collect()
    want = Counter()
    for r in frame.collect():
        ids = [*own.encode(r["text"] or "", add_special_tokens=False).ids, 0]
        for at in range(0, len(ids), 1024):
            piece = ids[at : at + 1024]
            want[r["doc_id"], at, len(piece), zlib.crc32(np.array(piece, "<u4").tobytes()), len(ids), tuple(piece)] += 1
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"], tuple(r["ids"])) for r in rows) == want
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in sequences.values():
        ends = [a + n for a, n in sorted(pieces)]
        assert [a for a, _ in sorted(pieces)] == [0, *ends[:-1]] and ends[-1] <= 1024
    assert len(sequences) <= 1.02 * sum(r["length"] for r in rows) / 1024 + 2
    text = packing.Encoder(queries.tokenizer_path(), control=False)
    assert text.ids("a <|endoftext|> b").tolist() == [64, 1279, 91, 437, 1659, 5239, 91, 29, 275]
    assert packing.pack(nothing, queries.tokenizer_path()).count() == 0


def test_plan_covers_demand():
    rng = np.random.default_rng(0)
    for n in (1, 3, 50, 3000):
        demand = Counter(int(x) for x in rng.integers(1, 257, n))
        done = packing.plan(demand, 256)
        used = Counter()
        for pattern, times in zip(done.patterns, done.uses, strict=True):
            assert sum(k * v for k, v in pattern.items()) <= 256
            used.update({k: v * times for k, v in pattern.items()})
        assert used == demand and sum(done.uses) <= done.bound * 1.02 + 3
    assert packing.plan({}).patterns == []


def test_toxicity(spark, awkward, nothing):
    sf = "/root/testdata/sf0.01"
    frame, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    odd = labels.unionByName(spark.createDataFrame([(None, 1, 1), (5, 1, None)], "doc_id long, quality int, toxic int"))
    fold = F.col("doc_id") % 3 != 0
    model = toxicity.learn(frame, odd.where(fold))
    rows = toxicity.grade(frame, model, [F.col("doc_id")]).join(labels.where(~fold), "doc_id").collect()
    by = lambda y, f: np.mean([f(r) for r in rows if r[-1] == y])
    assert by(1, lambda r: r["severity"]) > by(0, lambda r: r["severity"]) + 0.3
    got = toxicity.grade(awkward, model, [F.col("doc_id"), F.col("row")]).collect()
    assert len(got) == 8 and len({r["severity"] for r in got if r["doc_id"] in (2, 3, 4)}) == 1
    assert toxicity.learn(nothing, labels.limit(0)) is None and toxicity.grade(nothing, None, [F.col("doc_id")]).count() == 0
    assert toxicity.grade(awkward, None, [F.col("doc_id")]).where("toxic").count() == 0


def test_ordinal_fit():
    rng = np.random.default_rng(4)
    x = [{int(k): 1.0 for k in np.flatnonzero(rng.random(3) < 0.5)} for _ in range(3000)]
    margin = np.array([2.0 * (0 in d) - 1.0 * (1 in d) for d in x]) + rng.logistic(0, 1, 3000)
    weights, cuts = toxicity.fit(x, np.digitize(margin, [0.0, 1.5]), 3, 3, penalty=0.0, steps=800)
    assert np.allclose(weights, [2, -1, 0], atol=0.3) and np.allclose(cuts, [0, 1.5], atol=0.3)


def test_language_id_of_whole_documents(spark):
    """Every row of the query against a plain Viterbi over the same word scores."""
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.learn(frame.where(F.col("doc_id").isNotNull() & ~langid.held_out(F.col("doc_id"))))
    got = {r["doc_id"]: r for r in queries.op3_language_id(spark, SF).collect()}
    for r in frame.collect():
        words = [w for w in langid.WORD.findall(r["text"] or "") if any(map(str.isalpha, w))]
        if not words:
            assert (got[r["doc_id"]]["lang_pred"], got[r["doc_id"]]["score"]) == ("und", 0.0)
            continue
        scores = model.score(words).astype(float)
        top = brute_viterbi(scores, langid.SWITCH)[0]
        found = next(s for s in [langid.label([r["text"]], model, langid.Scores(model))[0]])
        labels = langid.paths(scores, np.array([len(words)]))
        assert scores[np.arange(len(words)), labels].sum() - langid.SWITCH * (np.diff(labels) != 0).sum() == pytest.approx(top, abs=1e-3)
        assert got[r["doc_id"]]["lang_pred"] == found[0] and got[r["doc_id"]]["score"] == pytest.approx(found[1])
        assert got[r["doc_id"]]["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)


def test_thousands_of_labels(spark):
    """A dirty column of labels: a model of bounded size that still tells the frequent ones."""
    rng = np.random.default_rng(21)
    stems = {"en": "the of and to in that was for it with".split(), "de": "der die und den von zu das mit sich auf".split()}
    rows = [(k, " ".join(rng.choice(stems[x], 30)), x) for k, x in enumerate(["en", "de"] * 300)]
    rows += [(1000 + k, f"wort{k} " + " ".join(rng.choice(stems["en"], 5)), f"label {k}") for k in range(5000)]
    model = langid.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert len(model.languages) == 5002 and model.table.nbytes + model.grams.nbytes <= langid.MODEL_BYTES
    found = langid.identify(spark.createDataFrame([(1, "der und die von zu das mit"), (2, "the of and that was for it")], "doc_id long, text string"), model, [F.col("doc_id")])
    assert {r["doc_id"]: r["lang_pred"] for r in found.collect()} == {1: "de", 2: "en"}


def test_rare_languages_are_learned(spark):
    """A hundred labelled languages, one of them in a single text."""
    rows = [(k, f"wort{k}ab wort{k}cd " * 30, f"l{k % 100}", "a", 0) for k in range(300)] + [(999, "einzig artig selten " * 5, "rare", "a", 0)]
    rows = [(k, "".join(chr(97 + int(c)) if c.isdigit() else c for c in t), *rest) for k, t, *rest in rows]
    model = langid.learn(docs(spark, rows))
    assert len(model.languages) == 101 and langid.label(["selten artig einzig"], model, langid.Scores(model))[0][0] == "rare"


def test_toxicity_of_whole_documents(spark):
    """The query's rows from the model's weights and thresholds, one by one."""
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    model = toxicity.learn(frame, spark.read.parquet(f"{SF}/labels.parquet"))
    got = {r["doc_id"]: r for r in queries.op9_toxicity(spark, SF).collect()}
    for r in frame.collect():
        words = re.findall(r"[^\W\d_]+", (r["text"] or "").lower())
        counts = Counter(words) + Counter(w[:5] + "*" for w in words if len(w) >= 5)
        margin = sum(model.weights[x] * np.log1p(n) for x, n in counts.items() if x in model.weights)
        above = [1 / (1 + np.exp(t - margin)) for t in model.thresholds]
        row = got[r["doc_id"]]
        assert row["severity"] == pytest.approx(sum(above)) and row["toxic"] == (above[0] > toxicity.CUT)


def test_results_replace_columns_of_their_name(spark, awkward):
    frame = awkward.withColumns({n: F.lit("clash") for n in ("score", "severity", "grade", "toxic", "clean", "quality", "_text", "kept", "n", "c0", "_noted_id", "id")})
    keep = [F.col(f"`{c}`") for c in frame.columns]
    model = langid.learn(frame)
    for found, names in (
        (langid.identify(frame, model, keep), ("lang_pred", "score", "spans")), (secrets.scan(frame, secrets.network(), keep), ("spans", "clean")),
        (toxicity.grade(frame, toxicity.Model({}, np.array([1.0, 2.0])), keep), ("severity", "grade", "toxic")), (quality.judge(frame), ("quality",)),
    ):
        assert sorted(found.columns) == sorted({*frame.columns, *names}) and found.select(*names, "_text", "kept").count() == 8
    assert simhash.deduplicated(frame).columns == frame.columns


def test_chat_log_of_a_service(spark):
    """Deltas, edits, regenerations and deleted messages fold back to the conversations they were made of."""
    said = [(c, t, "user" if t % 2 else "assistant", None if t == 5 else f"text {t} </turn> é" * (t % 4)) for c in (1, 2) for t in range(15)] + [(3, 0, "user", "ab")]
    frame = spark.createDataFrame(said, "conv_id long, turn long, role string, text string")
    log = chat.streamed_log(frame)
    assert {r["event"] for r in log.select("event").distinct().collect()} == set(chat.EVENTS) and log.count() > 3 * len(said)
    got = sorted((r["conv_id"], r["place"], r["role"], r["text"]) for r in chat.fold(log.repartition(5)).collect())
    assert got == sorted((c, t, r, x or "") for c, t, r, x in said)
    plain, made = (chat.digest(chat.format_log(x)).orderBy("conv_id").collect() for x in (chat.message_log(frame), log))
    assert plain == made


def test_many_components_and_groups(spark, monkeypatch, awkward):
    """The ways for more components, ids and groups than are broadcast give the same rows."""
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    made = lambda: (simhash.near_duplicates(frame), simhash.deduplicated(awkward), quality.judge(frame, carried=["doc_id"]))
    rows = lambda: [sorted(map(str, x.collect())) for x in made()]
    few = rows()
    monkeypatch.setattr(simhash, "FEW_NAMED", 0)
    monkeypatch.setattr(quality, "FEW_GROUPS", 0)
    assert rows() == few


def test_mixing(spark, awkward, nothing):
    got = mixing.assign(awkward).select("doc_id", "mix.*").collect()
    assert len(got) == 8 and all(r["taken"] == sum(c["words"] for c in r["copies"]) <= 2 * r["size"] for r in got)
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    rows = mixing.assign(frame).select("source", "doc_id", "mix.*")
    per = rows.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.first("source_size").alias("size")).collect()
    assert all(abs(r["taken"] - r["target"]) <= 0.5 and r["target"] <= 2 * r["size"] for r in per)
    assert sum(r["target"] for r in per) == pytest.approx(1.5 * sum(r["size"] for r in per))
    shards = rows.select(F.explode("copies").alias("c")).groupBy("c.shard").count().collect()
    assert len(shards) == 16
    copies = mixing.mixed_documents(frame)
    words = copies.select(F.sum(F.size(F.filter(F.split("row.text", "[ \\t-\\r]+"), lambda x: x != "")))).first()[0]
    assert words == sum(r["taken"] for r in rows.collect()) and copies.select("place").distinct().count() == copies.count()
    assert mixing.assign(nothing).count() == 0
    again = mixing.assign(frame.repartition(7)).select("doc_id", "mix").collect()
    assert {r["doc_id"]: r["mix"] for r in again} == {r["doc_id"]: r["mix"] for r in mixing.assign(frame).collect()}


def test_shard_quotas_are_exact(spark):
    draws = spark.createDataFrame([("a",)] * 40 + [("b",)] * 9 + [("c",)] * 1, "skey string")
    quotas = mixing.shard_quotas(draws, 3).collect()
    per, shard = Counter(), Counter()
    for r in quotas:
        per[r["skey"]] += r["draws"]
        shard[r["shard"]] += r["draws"]
    assert per == {"a": 40, "b": 9, "c": 1} and set(shard.values()) <= {6, 7} and len(shard) == 8
