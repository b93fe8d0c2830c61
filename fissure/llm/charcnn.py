"""A small character convolutional network in numpy: embedding, one convolution, maximum over positions, logistic output."""

from __future__ import annotations

import numpy as np

#: Characters that the network tells apart: nothing, other ones, those beyond ASCII, and the printable ASCII characters one by one.
CLASSES = 98


def char_classes() -> np.ndarray:
    """Class of each code point up to 127; all higher ones are looked up at 128."""
    table = np.ones(129, np.int64)
    table[32:127] = np.arange(3, 98)
    table[128] = 2
    return table


TABLE = char_classes()


class CharCnn:
    def __init__(self, length: int, size: int = 6, filters: int = 16, width: int = 5, seed: int = 7):
        r = np.random.default_rng(seed)
        self.length, self.width = length, width
        self.p = {
            "e": r.normal(0, 0.3, (CLASSES * 2, size)),
            "w": r.normal(0, (2 / (width * size)) ** 0.5, (width * size, filters)),
            "b": np.zeros(filters),
            "v": r.normal(0, 0.3, 2 * filters),
            "c": np.zeros(1),
        }

    def _forward(self, x: np.ndarray):
        e = self.p["e"][x]
        n = x.shape[1] - self.width + 1
        wide = np.concatenate([e[:, i : i + n] for i in range(self.width)], axis=2)
        act = np.maximum(wide @ self.p["w"] + self.p["b"], 0)
        best = act.argmax(1)
        hidden = np.concatenate([np.take_along_axis(act, best[:, None], 1)[:, 0], act.mean(1)], axis=1)
        return wide, act, best, hidden, hidden @ self.p["v"] + self.p["c"][0]

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([self._forward(x[i : i + 512])[-1] for i in range(0, len(x), 512)]) if len(x) else np.zeros(0)

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int = 8, rate: float = 0.01, seed: int = 3) -> None:
        r = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        t = 0
        for _ in range(epochs):
            order = r.permutation(len(x))
            for at in range(0, len(x), 128):
                rows = order[at : at + 128]
                wide, act, best, hidden, z = self._forward(x[rows])
                d = (1 / (1 + np.exp(-z)) - y[rows]) / len(rows)
                f = act.shape[2]
                dh = d[:, None] * self.p["v"]
                da = np.repeat(dh[:, None, f:] / act.shape[1], act.shape[1], 1)
                np.put_along_axis(da, best[:, None], np.take_along_axis(da, best[:, None], 1) + dh[:, None, :f], 1)
                da *= act > 0
                dw = da @ self.p["w"].T
                ge = np.zeros_like(self.p["e"])
                size, n = ge.shape[1], act.shape[1]
                for i in range(self.width):
                    at_, part = x[rows][:, i : i + n].ravel(), dw[:, :, i * size : (i + 1) * size].reshape(-1, size)
                    ge += np.stack([np.bincount(at_, part[:, k], len(ge)) for k in range(size)], axis=1)
                g = {"e": ge, "w": np.tensordot(wide, da, ((0, 1), (0, 1))), "b": da.sum((0, 1)), "v": hidden.T @ d, "c": np.array([d.sum()])}
                t += 1
                for k in self.p:
                    m[k] = 0.9 * m[k] + 0.1 * g[k]
                    s[k] = 0.999 * s[k] + 0.001 * g[k] ** 2
                    self.p[k] = self.p[k] - rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(s[k] / (1 - 0.999**t)) + 1e-8)


def probability(a: float, b: float, z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(a * z + b, -40, 40)))


def calibrate(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset that turn scores into probabilities (damped Newton steps on the logistic loss).

    The classes aim a little off 0 and 1, as if each had one more row of either kind, so that the slope stays finite where they can be told apart entirely.
    """
    aim = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))

    def loss(a: float, b: float) -> float:
        t = a * z + b
        return float((np.logaddexp(0, t) - aim * t).sum())

    a, b = 1.0 / (np.abs(z).mean() + 1e-9), 0.0
    for _ in range(50):
        p = probability(a, b, z)
        w = p * (1 - p) + 1e-9
        g = np.array([((p - aim) * z).sum(), (p - aim).sum()])
        h = np.array([[(w * z * z).sum() + 1e-6, (w * z).sum()], [(w * z).sum(), w.sum() + 1e-6]])
        step, damp = np.linalg.solve(h, g), 1.0
        while damp > 1e-6 and loss(a - damp * step[0], b - damp * step[1]) > loss(a, b):
            damp /= 2
        a, b = a - damp * step[0], b - damp * step[1]
    return float(a), float(b)
