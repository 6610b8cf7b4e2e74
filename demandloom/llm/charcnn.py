"""A small character convolutional network in numpy: embedding, convolution, pooling by part, one score."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

WIDTH, FILTERS, EMBED = 5, 24, 8
#: code points of a window: before the candidate, its beginning, after it
LEFT, BODY, RIGHT = 32, 48, 16
SIZE = LEFT + BODY + RIGHT
_CLASSES = 100


def encoded(windows: list[str]) -> np.ndarray:
    """Rows of character classes: printable ASCII each its own, other characters one, 0 for nothing.

    A window is SIZE code points; U+0000 stands where the text has none.
    """
    points = np.frombuffer("".join(windows).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, SIZE)
    out = np.full(points.shape, _CLASSES - 1, np.int64)
    ascii_ = (points >= 32) & (points < 127)
    out[ascii_] = points[ascii_] - 31
    out[(points > 0) & (points < 32)] = 97
    out[points == 0] = 0
    return out


class CharCNN:
    def __init__(self, seed: int) -> None:
        rng = np.random.default_rng(seed)
        self.w = {
            "embed": rng.normal(0, 0.3, (_CLASSES, EMBED)),
            "conv": rng.normal(0, 1 / np.sqrt(WIDTH * EMBED), (WIDTH * EMBED, FILTERS)),
            "bias": np.zeros(FILTERS),
            "out": rng.normal(0, 0.1, 3 * FILTERS),
            "base": np.zeros(1),
        }
        #: scale and shift that turn a score into a probability; set by calibrate()
        self.scale, self.shift, self.threshold = 1.0, 0.0, 0.5

    #: positions of the convolution whose middle lies in each part of the window
    _parts = (slice(0, LEFT - 2), slice(LEFT - 2, LEFT + BODY - 2), slice(LEFT + BODY - 2, SIZE - WIDTH + 1))

    def _forward(self, x: np.ndarray):
        e = self.w["embed"][x]
        cols = np.lib.stride_tricks.sliding_window_view(e, WIDTH, axis=1).transpose(0, 1, 3, 2).reshape(len(x), SIZE - WIDTH + 1, -1)
        a = np.maximum(cols @ self.w["conv"] + self.w["bias"], 0)
        pooled = np.concatenate([a[:, p].max(axis=1) for p in self._parts], axis=1)
        return cols, a, pooled, pooled @ self.w["out"] + self.w["base"]

    def score(self, x: np.ndarray, batch: int = 2048) -> np.ndarray:
        return np.concatenate([np.empty(0), *(self._forward(x[i:i + batch])[3] for i in range(0, len(x), batch))])

    def likely(self, score: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * score + self.shift, -40, 40)))

    def probability(self, x: np.ndarray) -> np.ndarray:
        return self.likely(self.score(x))

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int, seed: int, batch: int = 128, rate: float = 0.01, weight: np.ndarray | None = None) -> None:
        """Adam on the logistic loss, both labels weighing the same if no weights are given."""
        rng = np.random.default_rng(seed)
        weight = balanced(y) * len(y) if weight is None else weight
        first = {k: np.zeros_like(v) for k, v in self.w.items()}
        second = {k: np.zeros_like(v) for k, v in self.w.items()}
        step = 0
        for _ in range(epochs):
            for rows in np.array_split(rng.permutation(len(y)), max(1, len(y) // batch)):
                step += 1
                for k, g in self._gradient(x[rows], y[rows], weight[rows]).items():
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    self.w[k] = self.w[k] - rate * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)

    def _gradient(self, x, y, weight) -> dict:
        cols, a, pooled, z = self._forward(x)
        dz = weight * (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y) / len(y)
        dpool = dz[:, None] * self.w["out"]
        da = np.zeros_like(a)
        rows, filters = np.arange(len(x))[:, None], np.arange(FILTERS)[None, :]
        for k, part in enumerate(self._parts):
            best = part.start + a[:, part].argmax(axis=1)
            da[rows, best, filters] += dpool[:, k * FILTERS:(k + 1) * FILTERS]
        da *= a > 0
        dcols = (da @ self.w["conv"].T).reshape(len(x), -1, WIDTH, EMBED)
        dembed = np.zeros_like(self.w["embed"])
        for j in range(WIDTH):
            np.add.at(dembed, x[:, j:j + dcols.shape[1]], dcols[:, :, j])
        return {"embed": dembed, "conv": np.tensordot(cols, da, ([0, 1], [0, 1])), "bias": da.sum(axis=(0, 1)),
                "out": pooled.T @ dz, "base": np.array([dz.sum()])}

    def calibrate(self, x: np.ndarray, y: np.ndarray, recall: float) -> None:
        """Platt scaling on held-out findings; the threshold is the highest that keeps the recall."""
        z = self.score(x)
        weight = balanced(y)

        def sums(a: float, b: float) -> tuple[float, ...]:
            p = 1 / (1 + np.exp(-np.clip(a * z + b, -40, 40)))
            g, h = weight * (p - y), weight * p * (1 - p)
            return (g * z).sum(), g.sum(), (h * z * z).sum(), (h * z).sum(), h.sum()

        self.scale, self.shift = platt(sums)
        found = np.sort(self.probability(x[y == 1]))
        self.threshold = float(found[int(np.floor((1 - recall) * len(found)))]) if len(found) else 1.1

    def weights(self) -> np.ndarray:
        """All weights in a row."""
        return np.concatenate([self.w[k].ravel() for k in sorted(self.w)])

    def put(self, weights: np.ndarray) -> None:
        """Takes weights in the order of weights()."""
        at = 0
        for k in sorted(self.w):
            n = self.w[k].size
            self.w[k] = weights[at:at + n].reshape(self.w[k].shape)
            at += n


def balanced(y: np.ndarray) -> np.ndarray:
    """Weights with which either label adds up to a half."""
    return np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))


def platt(sums: Callable[[float, float], tuple[float, ...]]) -> tuple[float, float]:
    """Scale and shift by Newton's method.

    sums(a, b) adds up, over the weighted findings of score z and with p for a z + b, those of
    g z, g, h z z, h z and h, where g is p less the label and h is p (1 - p).
    """
    a, b = 1.0, 0.0
    for _ in range(200):
        gz, g, hzz, hz, h = sums(a, b)
        ga, gb = gz + 1e-4 * (a - 1), g + 1e-4 * b
        haa, hbb = hzz + 1e-4, h + 1e-4
        det = haa * hbb - hz * hz
        da, db = (hbb * ga - hz * gb) / det, (haa * gb - hz * ga) / det
        size = max(1.0, abs(da), abs(db))
        a, b = a - da / size, b - db / size
        if abs(da) + abs(db) < 1e-7:
            break
    return float(max(a, 1e-3)), float(b)
