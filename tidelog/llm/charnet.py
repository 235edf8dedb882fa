"""A small character convolutional network in numpy: embedding by character class, convolution, max over places, logistic output."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Characters told apart; others share one class, and 0 is padding.
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_.=-\"':,; \n#$%&*|<>(){}[]@!?\\"
CLASS = {c: i + 1 for i, c in enumerate(ALPHABET)}
OTHER, CLASSES = len(ALPHABET) + 1, len(ALPHABET) + 2


def encode(windows: list[tuple[str, str, str]], side: int, middle: int) -> np.ndarray:
    """(n, side + middle + side) classes of (text before, candidate, text after); a longer candidate keeps both its ends."""
    out = np.zeros((len(windows), 2 * side + middle), np.int16)
    for row, (before, inner, after) in zip(out, windows, strict=True):
        if len(inner) > middle:
            inner = inner[: middle // 2] + inner[-(middle - middle // 2) :]
        for text, at in ((before[-side:], side - min(side, len(before))), (inner, side), (after[:side], side + middle)):
            row[at : at + len(text)] = [CLASS.get(c, OTHER) for c in text]
    return out


@dataclass
class CharNet:
    embedding: np.ndarray  # (classes, e)
    kernels: np.ndarray  # (width * e, filters)
    bias: np.ndarray
    weights: np.ndarray  # (filters * parts,)
    offset: float
    width: int
    parts: tuple[tuple[int, int], ...]
    scale: float = 1.0
    shift: float = 0.0
    threshold: float = 0.5

    def _forward(self, x: np.ndarray):
        n, length = x.shape
        emb = self.embedding[x]
        wide = np.lib.stride_tricks.sliding_window_view(emb, self.width, axis=1)  # n, places, e, width
        wide = wide.transpose(0, 1, 3, 2).reshape(n, length - self.width + 1, -1)
        act = np.maximum(wide @ self.kernels + self.bias, 0)
        tops = [act[:, a : max(a + 1, b - self.width + 1)].argmax(1) + a for a, b in self.parts]
        pooled = np.concatenate([np.take_along_axis(act, t[:, None, :], 1)[:, 0] for t in tops], axis=1)
        return wide, act, tops, pooled, pooled @ self.weights + self.offset

    def margin(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([self._forward(x[k : k + 512])[-1] for k in range(0, len(x), 512)]) if len(x) else np.zeros(0)

    def probability(self, x: np.ndarray) -> np.ndarray:
        """Calibrated probability of a finding."""
        return 1 / (1 + np.exp(-(self.scale * self.margin(x) + self.shift)))


def train(x: np.ndarray, y: np.ndarray, side: int, middle: int, seed: int = 7, epochs: int = 6, e: int = 8, filters: int = 24, width: int = 5) -> CharNet:
    """Minibatch Adam on the logistic loss; deterministic for equal input."""
    rng = np.random.default_rng(seed)
    parts = ((0, side), (side, side + middle), (side + middle, 2 * side + middle))
    net = CharNet(rng.normal(0, 0.3, (CLASSES, e)), rng.normal(0, 0.2, (width * e, filters)), np.zeros(filters), rng.normal(0, 0.2, filters * 3), 0.0, width, parts)
    net.embedding[0] = 0
    names = ("embedding", "kernels", "bias", "weights")
    first, second, t = {k: 0.0 for k in names}, {k: 0.0 for k in names}, 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(x), 128):
            k = order[at : at + 128]
            wide, act, tops, pooled, z = net._forward(x[k])
            error = (1 / (1 + np.exp(-z)) - y[k]) / len(k)
            back = error[:, None] * net.weights
            grad_act = np.zeros_like(act)
            rows, cols = np.arange(len(k))[:, None], np.arange(filters)[None]
            for p, top in enumerate(tops):
                grad_act[rows, top, cols] += back[:, p * filters : (p + 1) * filters]
            grad_act *= act > 0
            flat = grad_act.reshape(-1, filters)
            grad_wide = (grad_act @ net.kernels.T).reshape(len(k), act.shape[1], width, e)
            grad_emb = np.zeros_like(net.embedding)
            for w in range(width):
                np.add.at(grad_emb, x[k][:, w : w + act.shape[1]], grad_wide[:, :, w])
            grad_emb[0] = 0
            grads = {"embedding": grad_emb, "kernels": wide.reshape(-1, width * e).T @ flat, "bias": flat.sum(0), "weights": pooled.T @ error}
            t += 1
            for name, g in grads.items():
                first[name] = 0.9 * first[name] + 0.1 * g
                second[name] = 0.99 * second[name] + 0.01 * g * g
                step = 0.01 * (first[name] / (1 - 0.9**t)) / (np.sqrt(second[name] / (1 - 0.99**t)) + 1e-8)
                setattr(net, name, getattr(net, name) - step)
            net.offset -= 0.01 * error.sum() * 10
    return net


def calibrate(net: CharNet, x: np.ndarray, y: np.ndarray, recall: float) -> CharNet:
    """Platt scaling on held-out findings, then the highest threshold whose recall there is at least `recall`."""
    z, a, b = net.margin(x), 1.0, 0.0
    for _ in range(200):
        p = 1 / (1 + np.exp(-(a * z + b)))
        g = np.array([((p - y) * z).mean() + 1e-3 * a, (p - y).mean()])
        w = p * (1 - p) + 1e-6
        h = np.array([[(w * z * z).mean() + 1e-3, (w * z).mean()], [(w * z).mean(), w.mean()]])
        a, b = np.array([a, b]) - np.linalg.solve(h, g)
    net.scale, net.shift = float(a), float(b)
    found = np.sort(net.probability(x)[y == 1])
    net.threshold = float(found[int(np.floor((1 - recall) * len(found)))]) if len(found) else 0.5
    return net
