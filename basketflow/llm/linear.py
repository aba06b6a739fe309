"""Linear models over hashed byte n-grams, in numpy: features of whole texts
chunk by chunk, weighted logistic fits on a bounded sample, row scores."""

from __future__ import annotations

from functools import cache

import numpy as np

from basketflow.llm.common import chunks


def gram_bins(data: np.ndarray, offs: np.ndarray, fold: np.ndarray, n: int, bins: int) -> np.ndarray:
    """Bin of the n-gram that starts at each byte; a gram that would run past
    its row ends in zero bytes.  ``fold``: uint8 by byte; ``bins``: a power
    of two."""
    size = len(data)
    if n == 2:  # every gram's bin is known
        f = np.concatenate((fold[data], np.zeros(1, np.uint8))).astype(np.uint16)
        code = f[:-1] << np.uint16(8) | f[1:]
        last = offs[1:][offs[1:] > offs[:-1]] - 1
        code[last] &= np.uint16(0xFF00)
        return _pair_bins(bins)[code]
    f = np.concatenate((fold[data], np.zeros(n, np.uint8))).astype(np.uint64)
    code = f[:size].copy()
    for k in range(1, n):
        code = code << np.uint64(8) | f[k:size + k]
    ends = offs[1:]
    for short in range(1, n):  # grams with only ``short`` bytes left in the row
        at = ends - short
        at = at[at >= offs[:-1]]
        cut = np.uint64(8 * (n - short))
        code[at] = code[at] >> cut << cut
    return _bin(code, bins)


def _bin(code: np.ndarray, bins: int) -> np.ndarray:
    return (code * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(65 - bins.bit_length())).astype(np.int32)


@cache
def _pair_bins(bins: int) -> np.ndarray:
    return _bin(np.arange(1 << 16, dtype=np.uint64), bins)


def row_counts(bins_of: np.ndarray, offs: np.ndarray, bins: int) -> np.ndarray:
    """(rows, bins) shares of the row's grams; empty rows are zero."""
    out = np.zeros((len(offs) - 1, bins), np.float32)
    for r in range(len(offs) - 1):
        if offs[r + 1] > offs[r]:
            out[r] = np.bincount(bins_of[offs[r]:offs[r + 1]], minlength=bins) / (offs[r + 1] - offs[r])
    return out


def row_means(weights: np.ndarray, bins_of: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """(rows, outputs) mean weight of the row's grams (zero for empty rows),
    which is the product of ``row_counts`` and the weights."""
    size = offs[1:] - offs[:-1]
    out = np.zeros((len(size), weights.shape[1]))
    some = np.flatnonzero(size)
    if len(some):
        if weights.shape[1] == 1:
            out[some, 0] = np.add.reduceat(weights[:, 0][bins_of], offs[some], dtype=np.float64) / size[some]
        else:
            out[some] = np.add.reduceat(weights[bins_of], offs[some], axis=0, dtype=np.float64) / size[some, None]
    return out


def text_chunks(data: np.ndarray, offs: np.ndarray):
    for i, j in chunks(offs):
        yield i, j, data[offs[i]:offs[j]], offs[i:j + 1] - offs[i]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


class Logistic:
    """Logistic regressions that share their features (one per column of
    ``y``): features are scaled to unit mean square, so rare grams count."""

    def __init__(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, l2: float = 1e-4,
                 steps: int = 300):
        weight = np.ones_like(y, np.float32) if weight is None else weight
        scale = 1 / np.sqrt((x * x).mean(0) + 1e-12)
        scale[~(x != 0).any(0)] = 0
        x = x * scale.astype(np.float32)
        share = weight / np.maximum(weight.sum(0), 1e-9)
        w = np.zeros((x.shape[1], y.shape[1]), np.float32)
        b = np.zeros(y.shape[1], np.float32)
        # Largest curvature: a power iteration on the weighted second moment.
        v = np.ones(x.shape[1], np.float32)
        for _ in range(12):
            v = x.T @ (x @ v * share.max(1))
            v /= np.linalg.norm(v) + 1e-20
        top = float(v @ (x.T @ (x @ v * share.max(1)))) + 1
        rate = 1 / (0.25 * top + l2)
        lw, lb = w.copy(), b.copy()
        for t in range(steps):  # accelerated gradient descent
            push = (t / (t + 3))
            zw, zb = w + push * (w - lw), b + push * (b - lb)
            lw, lb = w, b
            error = share * (sigmoid(x @ zw + zb) - y)
            w = zw - rate * (x.T @ error + l2 * zw)
            b = zb - rate * error.sum(0)
        self.weights, self.bias = (w * scale[:, None]).astype(np.float32), b

    def margins(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weights + self.bias


def platt(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(slope, intercept) that turn margins into calibrated log-odds."""
    z = margin.reshape(len(margin), -1)
    a = np.concatenate((z, np.ones((len(z), 1))), 1)
    w = np.zeros(a.shape[1])
    # Smoothed targets, as few rows may be separable.
    up, down = y.sum(), len(y) - y.sum()
    target = np.where(y > 0, (up + 1) / (up + 2), 1 / (down + 2))
    for _ in range(50):
        p = sigmoid(a @ w)
        h = (a * (p * (1 - p))[:, None]).T @ a + 1e-4 * np.eye(a.shape[1])
        w = w - np.linalg.solve(h, a.T @ (p - target) + 1e-4 * w)
    return tuple(w.tolist())
