"""A bidirectional gated recurrent layer in numpy: forward pass and backpropagation through time."""

from __future__ import annotations

import numpy as np


def squash(x: np.ndarray, room: np.ndarray | None = None) -> np.ndarray:
    """x / sqrt(1 + x^2) in place: the bounded activation of all gates.

    A few vector operations, where the hyperbolic tangent costs a call for each element.
    """
    root = np.multiply(x, x, out=room)
    root += 1.0
    np.sqrt(root, out=root)
    x /= root
    return x


def slope(y: np.ndarray) -> np.ndarray:
    """Derivative of ``squash`` where its value is ``y``."""
    s = 1.0 - y * y
    return s * np.sqrt(s)


def sigmoid(x: np.ndarray) -> np.ndarray:
    x = squash(0.5 * x)
    x += 1.0
    x *= 0.5
    return x


def softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=-1, keepdims=True))
    x /= x.sum(axis=-1, keepdims=True)
    return x


def states(gates, steps: int, rows: int, U: np.ndarray, b: np.ndarray, reverse: bool) -> np.ndarray:
    """Hidden states (steps, units, rows). Inference only.

    ``gates(t)`` gives the input part of the gates of step ``t`` as (3 units, rows): update,
    reset, candidate, the first two already halved (see ``halved``).
    """
    n = U.shape[0]
    # the last row of the state is 1 and carries the bias
    W = np.ascontiguousarray(np.concatenate((U, b[None, :])).T) * np.float32(0.5)
    out = np.empty((steps, n, rows), np.float32)
    state = np.zeros((n + 1, rows), np.float32)
    state[n] = 1.0
    h = state[:n]
    a, room = np.empty((3 * n, rows), np.float32), np.empty((2 * n, rows), np.float32)
    zr, inner, c = a[: 2 * n], a[2 * n :], np.empty((n, rows), np.float32)
    for t in range(steps - 1, -1, -1) if reverse else range(steps):
        g = gates(t)
        np.matmul(W, state, out=a)
        zr += g[: 2 * n]
        squash(zr, room)
        # reset and update are (1 + zr) / 2
        np.multiply(zr[n:], inner, out=c)
        c += inner
        c += g[2 * n :]
        squash(c, room[:n])
        h -= c
        h *= 0.5
        np.multiply(zr[:n], h, out=zr[:n])
        h += c
        h += zr[:n]
        out[t] = h
    return out


def halved(gates: np.ndarray) -> np.ndarray:
    """Input weights (any, 3 units) as ``states`` wants them."""
    out = gates.astype(np.float32, copy=True)
    out[:, : 2 * out.shape[1] // 3] *= 0.5
    return out


def forward(G: np.ndarray, U: np.ndarray, b: np.ndarray, reverse: bool):
    """States for input gates ``G`` (steps, rows, 3 units), and what the backward pass needs."""
    steps, rows, _ = G.shape
    n = U.shape[0]
    h = np.zeros((rows, n), np.float32)
    kept = []
    out = np.empty((steps, rows, n), np.float32)
    for t in range(steps - 1, -1, -1) if reverse else range(steps):
        a = h @ U + b
        zr = sigmoid(G[t, :, : 2 * n] + a[:, : 2 * n])
        z, r = zr[:, :n], zr[:, n:]
        c = squash(G[t, :, 2 * n :] + r * a[:, 2 * n :])
        kept.append((t, h, z, r, c, a[:, 2 * n :]))
        h = c + z * (h - c)
        out[t] = h
    return out, kept


def backward(dH: np.ndarray, kept: list, U: np.ndarray):
    """Gradients of the input gates, of ``U`` and of the bias."""
    n = U.shape[0]
    dG = np.empty((*dH.shape[:2], 3 * n), np.float32)
    dU, db = np.zeros_like(U), np.zeros(3 * n, np.float32)
    carry = np.zeros(dH.shape[1:], np.float32)
    for t, h, z, r, c, inner in reversed(kept):
        dh = dH[t] + carry
        dc = dh * (1 - z) * slope(c)
        # z and r are (1 + squash(x / 2)) / 2
        da = np.concatenate((dh * (h - c) * slope(2 * z - 1) / 4, dc * inner * slope(2 * r - 1) / 4, dc), axis=1)
        dG[t] = da
        da[:, 2 * n :] *= r
        carry = dh * z + da @ U.T
        dU += h.T @ da
        db += da.sum(axis=0)
    return dG, dU, db


class Adam:
    """Adaptive moment steps over a dictionary of parameters."""

    def __init__(self, params: dict[str, np.ndarray], rate: float):
        self.params, self.rate, self.t = params, rate, 0
        self.first = {k: np.zeros_like(v) for k, v in params.items()}
        self.second = {k: np.zeros_like(v) for k, v in params.items()}

    def step(self, grads: dict[str, np.ndarray], scale: float = 1.0) -> None:
        self.t += 1
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        clip = min(1.0, 5.0 / (norm + 1e-12))
        for k, g in grads.items():
            g = g * clip
            self.first[k] += 0.1 * (g - self.first[k])
            self.second[k] += 0.01 * (g * g - self.second[k])
            m = self.first[k] / (1 - 0.9**self.t)
            v = self.second[k] / (1 - 0.99**self.t)
            self.params[k] -= (self.rate * scale * m / (np.sqrt(v) + 1e-8)).astype(np.float32)


def scaled(rng: np.random.Generator, *shape: int) -> np.ndarray:
    return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
