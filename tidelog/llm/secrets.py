"""Secret scans: fixed patterns, and a character network over every other candidate with its surroundings.

A candidate is what fixed patterns leave of a long enough run of token characters, a part of one between `/` or `=`, or
what stands after a credential word, whatever its characters. The network sees the candidate and what stands left and
right of it, a long one by overlapping windows. It is trained on labelled findings made by rule (issued-looking keys in assignments, headers and prose against
names, numbers, paths and ordinary long words in like surroundings), to which a caller can add windows known to hold no
secret; its output is calibrated on held-out findings and the threshold is the highest that keeps the asked recall there.
"""

from __future__ import annotations

import base64
import bisect
import re
import string
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .charnet import CharNet, calibrate, encode, train
from .langid import by_text

KINDS = ("assign", "access", "hex", "model")
WORDS = r"(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
ASSIGN = re.compile(WORDS + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
SEPARATOR = re.compile("[/=]")
#: What stands after a credential word: quoted, or up to white space.
VALUE = re.compile(WORDS + r"""["']?[ \t]*[:=][ \t]*(?:"([^"\n]+)"|'([^'\n]+)'|([^\s"']\S*))""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
#: Characters a run, and a part of one, must have.
LEAST = 16
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{LEAST},}}")
PART = re.compile("[^/=]+")
SIDE, MIDDLE = 24, 48
RECALL = 0.97
FINDINGS = 3000


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns, by start."""
    spans = []
    if "=" in text or ":" in text:
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def candidates(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int]]:
    """(start, end, from, to): a stretch the network looks at, and what is a secret if it says so.

    Nothing a base span covers is looked at, but for values of credential words, which are seen whole.
    """
    out, cover = [], Cover(spans)
    for m in CANDIDATE.finditer(text):
        for a, b in cover.left(*m.span()):
            out += _windows(text, a, b)
            parts = [(a + p.start(), a + p.end()) for p in PART.finditer(text[a:b])]
            if parts != [(a, b)]:
                out += [w for p, q in parts if q - p >= LEAST for w in _windows(text, p, q)]
    if "=" in text or ":" in text:
        for m in VALUE.finditer(text):
            a, b = m.span(m.lastindex)
            if cover.left(a, b):
                out += [(x, y, a, b) for x, y, *_ in _windows(text, a, b)]
    return out


class Cover:
    """What spans cover, as stretches apart; tells what they leave of another one by binary search."""

    def __init__(self, spans: list[tuple[int, int, int]]):
        self.parts: list[tuple[int, int]] = []
        for a, _, b in spans:
            if self.parts and a <= self.parts[-1][1]:
                self.parts[-1] = (self.parts[-1][0], max(b, self.parts[-1][1]))
            else:
                self.parts.append((a, b))
        self.ends = [b for _, b in self.parts]

    def left(self, a: int, b: int) -> list[tuple[int, int]]:
        out = []
        for k in range(bisect.bisect_right(self.ends, a), len(self.parts)):
            s, e = self.parts[k]
            if s >= b:
                break
            if s > a:
                out.append((a, s))
            a = max(a, e)
        return [*out, (a, b)] if a < b else out


def _windows(text: str, a: int, b: int) -> list[tuple[int, int, int, int]]:
    """Overlapping stretches of MIDDLE characters, each with itself carried on to the next separator."""
    if b - a <= MIDDLE:
        return [(a, b, a, b)]
    marks = [m.start() for m in SEPARATOR.finditer(text, a, b)]  # once for the run, so that time is in proportion to it
    out = []
    for x in [*range(a, b - MIDDLE, MIDDLE // 2), b - MIDDLE]:
        before, after = bisect.bisect_left(marks, x) - 1, bisect.bisect_left(marks, x + MIDDLE)
        out.append((x, x + MIDDLE, marks[before] + 1 if before >= 0 else a, marks[after] if after < len(marks) else b))
    return out


def window(text: str, a: int, b: int) -> tuple[str, str, str]:
    return text[max(0, a - SIDE) : a], text[a:b], text[b : b + SIDE]


def labelled_findings(n: int = FINDINGS, seed: int = 11) -> tuple[list[tuple[str, str, str]], np.ndarray]:
    """n made findings, half of them secrets: windows and labels."""
    rng = np.random.default_rng(seed)
    pick = lambda xs: xs[int(rng.integers(len(xs)))]
    chars = lambda alphabet, k: "".join(pick(alphabet) for _ in range(k))
    word = lambda: chars(string.ascii_lowercase, int(rng.integers(2, 10)))
    prose = lambda: " ".join(word() for _ in range(6))
    mixed = string.ascii_letters + string.digits

    def secret() -> str:
        k = int(rng.integers(18, 60))
        return pick(
            [
                lambda: pick(["ghp_", "gho_", "glpat-", "sk_live_", "sk-", "xoxb-", "AIza", "npm_", "hf_", "eyJ"]) + chars(mixed, k),
                lambda: chars(mixed, k),
                lambda: chars(mixed + "+/", k),
                lambda: base64.b64encode(rng.bytes(k)).decode(),
                lambda: chars(string.ascii_uppercase + string.digits, k),
                lambda: chars(mixed + "_-", k),
            ]
        )()

    def harmless() -> str:
        return pick(
            [
                lambda: "".join(word() for _ in range(4)) + "abcdefghijklmnop",
                lambda: "".join(word().capitalize() for _ in range(4)) + "Controllers",
                lambda: "_".join(word() for _ in range(4)) + "_default_value",
                lambda: "-".join(word() for _ in range(5)) + "-and-others",
                lambda: "/".join(word() for _ in range(5)) + "/documents",
                lambda: (word() + word() + word() + word()).capitalize() + "schaftlichkeit",
                lambda: chars(string.digits, int(rng.integers(16, 24))),
                lambda: pick("=-_") * int(rng.integers(16, 60)),
                lambda: f"{rng.integers(1990, 2030)}-{rng.integers(10, 13)}-{rng.integers(10, 29)}-{word()}-{rng.integers(1, 999)}-{word()}",
                lambda: "".join(word().upper() for _ in range(3)) + "ABCDEFGHIJ" + pick(["", str(rng.integers(9))]),
            ]
        )()

    before = [lambda: f"{prose()} ", lambda: f"{prose()}: ", lambda: f'{word()} = "', lambda: f"{prose()}\n", lambda: f"{word()}={''}", lambda: "Bearer ", lambda: f"{prose()} ("]
    after = [lambda: f" {prose()}", lambda: f". {prose().capitalize()}", lambda: f'"\n{prose()}', lambda: f", {prose()}", lambda: f"\n{prose()}", lambda: f") {prose()}", lambda: ""]
    out, labels = [], []
    for k in range(n):
        inner = secret() if k % 2 else harmless()
        out.append((pick(before)()[-SIDE:], inner, pick(after)()[:SIDE]))
        labels.append(k % 2)
    return out, np.array(labels, float)


def placed_findings(n: int, seed: int = 12) -> tuple[list[tuple[str, str, str]], np.ndarray]:
    """n made findings, half of them secrets: values of credential words, and stretches of long paths."""
    rng = np.random.default_rng(seed)
    pick = lambda xs: xs[int(rng.integers(len(xs)))]
    chars = lambda alphabet, k: "".join(pick(alphabet) for _ in range(k))
    word = lambda: chars(string.ascii_lowercase, int(rng.integers(2, 10)))
    mixed = string.ascii_letters + string.digits
    path = lambda: "/".join(pick([word, word, lambda: f"{word()}-{word()}", lambda: f"{word()}_{word()}"])() for _ in range(9))
    out, labels = [], []
    for k in range(n):
        if k // 2 % 2:
            before = f"{word()} {pick(['password', 'passwd', 'Password', 'secret', 'token', 'api_key', 'API_KEY'])}{pick([': ', '=', ' = ', ':'])}"
            strong = lambda: pick(mixed) + chars(mixed + "!@#$%^&*?~+.", int(rng.integers(4, 30))) + pick("!@#$%^&*?~") + chars(mixed, int(rng.integers(1, 6)))
            weak = [lambda: word()[:5], lambda: f"<{word()}>", lambda: f"${{{word().upper()}}}", lambda: f"{{{word()}}}", lambda: "*" * int(rng.integers(3, 12)), lambda: f"{word()[:5]},", lambda: f"({word()[:4]})", lambda: f"%{word()[:1]}", lambda: str(rng.integers(99))]
            out.append((before[-SIDE:], strong() if k % 2 else pick(weak)(), pick([f" {word()} {word()}", f"\n{word()}", ""])))
        else:
            inner, left = chars(mixed, int(rng.integers(20, 44))), path()
            text, at = f"/{left}/{inner}/{path()}" if k % 2 else f"/{left}/{path()}/{path()}", len(left) + 2
            at = max(0, at - int(rng.integers(0, 12)) * int(rng.integers(2)))
            end = at + MIDDLE if rng.integers(2) or not k % 2 else len(left) + 2 + len(inner)
            out.append((text[max(0, at - SIDE) : at], text[at:end], text[end : end + SIDE]))
        labels.append(k % 2)
    return out, np.array(labels, float)


def fit(negatives: list[tuple[str, str, str]] = (), recall: float = RECALL, n: int = FINDINGS) -> CharNet:
    """The calibrated network; negatives are windows known to hold no secret."""
    windows, y = labelled_findings(n)
    placed, of = placed_findings(n // 2)
    windows, y = windows + placed + list(negatives), np.concatenate([y, of, np.zeros(len(negatives))])
    order = np.random.default_rng(3).permutation(len(y))
    x, y = encode([windows[k] for k in order], SIDE, MIDDLE), y[order]
    cut = len(y) * 3 // 4
    return calibrate(train(x[:cut], y[:cut], SIDE, MIDDLE), x[cut:], y[cut:], recall)


@lru_cache(maxsize=1)
def network() -> CharNet:
    return fit()


def scan(docs: DataFrame, net: CharNet, keep: list[Column], text: str = "text") -> DataFrame:
    """The kept columns, spans: array of (kind, start, end, score), in code points, by start, and clean: the text with its spans masked.

    Fixed patterns keep all of their spans, with score 1; kind `model` spans are the network's, and overlap none of
    them. Texts are looked at whole, however long. Null and empty texts have no span, and a text without one is clean as
    it is. Rows are scored one by one, so repeated rows agree; an empty table gives an empty table. A kept column named
    like a result gives way to it.
    """
    shared = docs.sparkSession.sparkContext.broadcast(net)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def run(texts: pa.Array) -> list[pa.Array]:
        rows = texts.to_pylist()
        found = find(rows, shared.value)
        spans = pa.array([[dict(zip(("kind", "start", "end", "score"), s, strict=True)) for s in f] for f in found], kind)
        return [spans, pa.array([masked(t, f) for t, f in zip(rows, found, strict=True)], pa.string())]

    return by_text(docs, keep, text, {"spans": "array<struct<kind:string,start:int,end:int,score:double>>", "clean": "string"}, lambda: run)


def masked(text: str | None, spans: list[tuple[str, int, int, float]]) -> str | None:
    """The text with every span replaced by a mark of its kind; of overlapping spans the first one's."""
    if not spans:
        return text
    out, at = [], 0
    for kind, a, b, _ in spans:
        if a >= at:
            out += [text[at:a], f"<secret:{kind}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def find(texts: list[str | None], net: CharNet) -> list[list[tuple[str, int, int, float]]]:
    """Spans of each text, by start and kind."""
    spans = [base_spans(t) if t else [] for t in texts]
    tried = [(k, *c) for k, t in enumerate(texts) if t for c in candidates(t, spans[k])]
    score = net.probability(encode([window(texts[k], a, b) for k, a, b, *_ in tried], SIDE, MIDDLE)) if tried else []
    out = [[(a, kind, b, 1.0) for a, kind, b in s] for s in spans]
    hits: dict[int, list[tuple[int, int, float]]] = {}
    for (k, *_, a, b), p in zip(tried, score, strict=True):
        if p >= net.threshold:
            hits.setdefault(k, []).append((a, b, float(p)))
    for k, found in hits.items():
        whole: list[tuple[int, int, float]] = []
        cover = Cover(spans[k])
        for a, b, p in sorted(found):
            if whole and a < whole[-1][1]:
                whole[-1] = (whole[-1][0], max(b, whole[-1][1]), max(p, whole[-1][2]))
            else:
                whole.append((a, b, p))
        out[k] += [(x, 3, y, p) for a, b, p in whole for x, y in cover.left(a, b)]
    return [[(KINDS[kind], a, b, p) for a, kind, b, p in sorted(s)] for s in out]


def digest(spans: Column) -> Column:
    """kind:start:end of the spans, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
