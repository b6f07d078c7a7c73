"""Hashed character n-grams and a small linear trainer, used inside tasks by the text classifiers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Code points that are hashed at a time, so that very long texts need bounded memory.
STEP = 1 << 20
#: Entries of the sparse rows that the trainer widens at a time.
BLOCK = 1 << 21


def code_points(text: str) -> np.ndarray:
    return np.frombuffer((" " + text + " ").encode("utf-32-le"), dtype="<u4")


def grams(codes: np.ndarray, orders: tuple[int, ...], bits: int) -> Iterator[np.ndarray]:
    """Hashed n-gram ids of a text, in pieces; every n-gram occurs in exactly one piece."""
    for n in orders:
        for begin in range(0, len(codes) - n + 1, STEP):
            part = codes[begin:begin + STEP + n - 1]
            h = np.full(len(part) - n + 1, (0x9E3779B1 * n) & 0xFFFFFFFF, dtype=np.uint32)
            for j in range(n):
                h *= np.uint32(0x85EBCA6B)
                h ^= part[j:len(part) - n + 1 + j]
                h ^= h >> np.uint32(13)
                h *= np.uint32(0xC2B2AE35)
            h ^= h >> np.uint32(16)
            yield (h >> np.uint32(32 - bits)).astype(np.int32)


class Distinct:
    """Distinct ids of a list in linear time, with one scratch array per worker."""

    def __init__(self, bits: int) -> None:
        self.seen = np.zeros(1 << bits, np.int32)

    def __call__(self, ids: np.ndarray) -> np.ndarray:
        at = np.arange(len(ids), dtype=np.int32)
        self.seen[ids] = at
        return ids[self.seen[ids] == at]


def presence(text: str, orders: tuple[int, ...], bits: int, distinct: Distinct) -> np.ndarray:
    """Distinct n-gram ids of a whole text."""
    parts = [distinct(g) for g in grams(code_points(text), orders, bits)]
    return distinct(np.concatenate(parts)) if parts else np.zeros(0, np.int32)


def fit(ids: np.ndarray, offsets: np.ndarray, values: np.ndarray | None, target: np.ndarray, weight: np.ndarray,
        size: int, loss: str, l2: float, steps: int = 150, rate: float = 0.1,
        scale: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear model on sparse rows, by full-batch Adam.

    ``loss`` is "logistic" (target 0 to 1, may be soft) or "hinge2" (target -1 or 1, squared hinge: a linear SVM).
    ``values`` stand beside ``ids``, ``scale`` beside the rows; what is not given is 1.  ``l2`` is the penalty on the
    weights, the bias is free.
    """
    scale = np.ones(len(offsets) - 1) if scale is None else scale
    value = lambda b: 1.0 if values is None else values[b]
    w = np.zeros(size + 1)
    m, v = np.zeros(size + 1), np.zeros(size + 1)
    weight = weight / weight.sum()
    rows = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
    blocks = [slice(i, i + BLOCK) for i in range(0, len(ids), BLOCK)]
    for step in range(1, steps + 1):
        margin, slope = np.zeros(len(offsets) - 1), np.zeros(size)
        for b in blocks:
            margin += np.bincount(rows[b], value(b) * w[ids[b]], len(offsets) - 1)
        margin = margin * scale + w[-1]
        if loss == "logistic":
            g = weight * (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - target)
        else:
            g = -2 * weight * target * np.maximum(0, 1 - target * margin)
        for b in blocks:
            slope += np.bincount(ids[b], value(b) * (g * scale)[rows[b]], size)
        grad = np.append(slope + l2 * w[:-1], g.sum())
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad * grad
        w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-10)
    return w[:-1], float(w[-1])


def sigmoid(x: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(x, -30, 30))))
