"""Linear-chain conditional random fields in numpy: training by Adagrad on the
exact gradient, forward-backward and Viterbi over batches of sequences.

Emissions are sums of weights of hashed features.  Sequences of a batch advance
together; in a batch sorted by falling length, those that have ended drop out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Crf:
    labels: list[str]
    weights: np.ndarray   # features x labels
    moves: np.ndarray     # from x to, log scale
    start: np.ndarray


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis=axis, keepdims=True)
    return np.squeeze(m, axis) + np.log(np.exp(x - m).sum(axis=axis))


def _expectations(e: np.ndarray, moves: np.ndarray, start: np.ndarray) -> tuple:
    """Posteriors (batch x time x label), summed transitions, of equally long
    sequences with emissions ``e``."""
    b, t, k = e.shape
    p = np.exp(e - e.max(axis=2, keepdims=True))
    a = np.exp(moves - moves.max())
    forward, backward = np.empty((b, t, k)), np.empty((b, t, k))
    forward[:, 0] = p[:, 0] * np.exp(start - start.max())
    forward[:, 0] /= forward[:, 0].sum(axis=1, keepdims=True)
    for i in range(1, t):
        f = (forward[:, i - 1] @ a) * p[:, i]
        forward[:, i] = f / f.sum(axis=1, keepdims=True)
    backward[:, -1] = 1 / k
    for i in range(t - 2, -1, -1):
        f = (backward[:, i + 1] * p[:, i + 1]) @ a.T
        backward[:, i] = f / f.sum(axis=1, keepdims=True)
    gamma = forward * backward
    gamma /= gamma.sum(axis=2, keepdims=True)
    xi = np.einsum("btk,btl->btkl", forward[:, :-1], backward[:, 1:] * p[:, 1:]) * a
    xi /= xi.sum(axis=(2, 3), keepdims=True)
    return gamma, xi.sum(axis=(0, 1))


def train(features: np.ndarray, words: np.ndarray, truth: np.ndarray, labels: list[str], n_features: int,
          steps: int, batch: int = 64, rate: float = 0.3, decay: float = 1e-5, seed: int = 7) -> Crf:
    """``features``: words x slots, hashed features padded with 0 (feature 0 is
    unused); ``words`` and ``truth``: sequences x time, indices of words and
    labels."""
    k, rng = len(labels), np.random.default_rng(seed)
    w, moves, start = np.zeros((n_features, k)), np.zeros((k, k)), np.zeros(k)
    gw, gm, gs = np.full(w.shape, 1e-6), np.full(moves.shape, 1e-6), np.full(start.shape, 1e-6)
    one = np.eye(k)
    for _ in range(steps):
        pick = rng.integers(0, len(words), batch)
        x, y = words[pick], truth[pick]
        gamma, xi = _expectations(w[features[x]].sum(axis=2), moves, start)
        d_e = (one[y] - gamma).reshape(-1, k) / batch
        f = features[x.reshape(-1)]
        d_w = np.stack([np.bincount(f.reshape(-1), np.repeat(d_e[:, c], f.shape[1]), n_features) for c in range(k)], 1)
        d_w -= decay * w
        d_w[0] = 0
        seen = np.bincount(y[:, :-1].reshape(-1) * k + y[:, 1:].reshape(-1), minlength=k * k).reshape(k, k)
        d_m = (seen - xi) / batch
        d_s = (one[y[:, 0]] - gamma[:, 0]).mean(axis=0)
        for value, grad, g2 in ((w, d_w, gw), (moves, d_m, gm), (start, d_s, gs)):
            g2 += grad * grad
            value += rate * grad / np.sqrt(g2)
    return Crf(labels, w.astype(np.float32), moves.astype(np.float32), start.astype(np.float32))


def batches(lengths: np.ndarray, most: int) -> list[np.ndarray]:
    """Sequences with one word or more by falling length, cut so that longest x
    count stays within ``most`` (or one sequence)."""
    order = np.argsort(-lengths, kind="stable")
    order = order[lengths[order] > 0]
    out, lo = [], 0
    while lo < len(order):
        n = max(1, most // int(lengths[order[lo]]))
        out.append(order[lo:lo + n])
        lo += n
    return out


def posteriors(model: Crf, emissions: np.ndarray, ids: list[np.ndarray]) -> np.ndarray:
    """Posteriors of one batch (time x sequence x label, zero beyond the end);
    ``ids`` by falling length hold rows of ``emissions``."""
    n, t, k = len(ids), len(ids[0]), emissions.shape[1]
    lengths = np.array([len(x) for x in ids])
    alive = np.searchsorted(-lengths, -np.arange(1, t + 1), side="right")  # sequences longer than each time
    place = np.zeros((t, n), np.int64)
    for i, x in enumerate(ids):
        place[:len(x), i] = x
    p = np.exp(emissions - emissions.max(axis=1, keepdims=True)).astype(np.float32)[place]
    a = np.exp(model.moves - model.moves.max())
    f = np.zeros((t, n, k), np.float32)
    now = p[0] * np.exp(model.start - model.start.max())
    f[0] = now / now.sum(axis=1, keepdims=True)
    for i in range(1, t):
        m = alive[i]
        now = (f[i - 1, :m] @ a) * p[i, :m]
        f[i, :m] = now / now.sum(axis=1, keepdims=True)
    back = np.full((n, k), 1 / k, np.float32)
    for i in range(t - 2, -1, -1):
        m = alive[i + 1]  # the others end here or before
        now = (back[:m] * p[i + 1, :m]) @ a.T
        back[:m] = now / now.sum(axis=1, keepdims=True)
        f[i, :m] *= back[:m]
    total = f.sum(axis=2, keepdims=True)
    return np.divide(f, total, out=f, where=total > 0)


def viterbi(model: Crf, emissions: list[np.ndarray]) -> list[np.ndarray]:
    """Best label sequences of one batch, by falling length."""
    n, t, k = len(emissions), len(emissions[0]), len(model.labels)
    lengths = np.array([len(x) for x in emissions])
    alive = np.searchsorted(-lengths, -np.arange(1, t + 1), side="right")
    e = np.zeros((t, n, k), np.float32)
    for i, x in enumerate(emissions):
        e[:len(x), i] = x
    best = e[0] + model.start
    came = np.zeros((t, n, k), np.int8)
    for i in range(1, t):
        m = alive[i]
        s = best[:m, :, None] + model.moves
        came[i, :m] = s.argmax(axis=1)
        best[:m] = s.max(axis=1) + e[i, :m]
    last = best.argmax(axis=1)
    out = [np.zeros(x, np.int64) for x in lengths]
    for i in range(n):
        y = last[i]
        for j in range(lengths[i] - 1, -1, -1):
            out[i][j] = y
            y = came[j, i, y]
    return out
