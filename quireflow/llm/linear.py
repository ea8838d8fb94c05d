"""Sparse rows and a full-batch optimiser for the linear models of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np


class Rows:
    """A sparse matrix by rows."""

    def __init__(self, index: np.ndarray, value: np.ndarray, first: np.ndarray, width: int):
        self.index, self.value, self.first, self.width = index.astype(np.int64), value.astype(np.float64), first, width
        self.row = np.repeat(np.arange(len(first) - 1), np.diff(first))

    @classmethod
    def of(cls, rows: list[tuple[np.ndarray, np.ndarray]], width: int) -> Rows:
        first = np.cumsum([0] + [len(i) for i, _ in rows]).astype(np.int64)
        none = [np.zeros(0)]
        return cls(np.concatenate([i for i, _ in rows] or none), np.concatenate([v for _, v in rows] or none), first, width)

    def __len__(self) -> int:
        return len(self.first) - 1

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.value * w[self.index], len(self))

    def back(self, g: np.ndarray) -> np.ndarray:
        """The transposed product."""
        return np.bincount(self.index, self.value * g[self.row], self.width)

    def take(self, rows: np.ndarray) -> Rows:
        n = np.diff(self.first)[rows]
        at = np.repeat(self.first[:-1][rows] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return Rows(self.index[at], self.value[at], np.append(0, np.cumsum(n)), self.width)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def minimise(gradient: Callable[[np.ndarray], np.ndarray], start: np.ndarray, steps: int = 300, rate: float = 0.05) -> np.ndarray:
    """Adam over the whole sample; deterministic."""
    x, m, v = start.copy(), np.zeros_like(start), np.zeros_like(start)
    for t in range(1, steps + 1):
        g = gradient(x)
        m += 0.1 * (g - m)
        v += 0.01 * (g * g - v)
        x -= rate * (1 - t / (steps + 1)) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
    return x
