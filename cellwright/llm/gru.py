"""A gated recurrent layer in numpy: forward, backpropagation through time, Adam.

Arrays are (time, units, lanes), so each step is a few operations on rows as
long as the number of lanes. Gates are clipped lines (0 .. 1) and the candidate
is a clipped line (-1 .. 1). The inputs come in already multiplied: ``x`` holds,
for every step, what the update gate, the reset gate and the candidate receive.
A step whose update gate receives PAD leaves the state as it is.
"""

from __future__ import annotations

import numpy as np

PAD = -1e4


def start(units: int, rng: np.random.Generator) -> np.ndarray:
    """Recurrent weights (3 x units, units)."""
    u = rng.standard_normal((3 * units, units)) * 0.3 / np.sqrt(units)
    u[2 * units :] += 0.5 * np.linalg.qr(rng.standard_normal((units, units)))[0]
    return u.astype(np.float32)


def forward(x, u: np.ndarray, steps: int, keep: bool = False):
    """States (steps, units, lanes); ``x(t)`` gives the inputs (3 x units, lanes) of a step.

    With ``keep`` also what ``backward`` needs.
    """
    units = u.shape[1]
    gates, cand = np.ascontiguousarray(u[: 2 * units]), np.ascontiguousarray(u[2 * units :])
    h = states = None
    saved = []
    for t in range(steps):
        own = x(t)
        if h is None:
            h = np.zeros((units, own.shape[1]), np.float32)
            states = np.empty((steps, units, own.shape[1]), np.float32)
        zr = gates @ h
        zr += own[: 2 * units]
        np.clip(zr, 0.0, 1.0, out=zr)
        rh = zr[units:] * h
        c = cand @ rh
        c += own[2 * units :]
        np.clip(c, -1.0, 1.0, out=c)
        step = c - h
        step *= zr[:units]
        new = states[t]
        np.add(h, step, out=new)
        if keep:
            saved.append((h, zr, rh, c))
        h = new
    return (states, saved) if keep else states


def backward(dstates: np.ndarray, saved: list, u: np.ndarray):
    """(gradient of the inputs (steps, 3 x units, lanes), gradient of ``u``)."""
    units = u.shape[1]
    dx = np.empty((len(saved), 3 * units, dstates.shape[2]), np.float32)
    du = np.zeros_like(u)
    dh = np.zeros(dstates.shape[1:], np.float32)
    for t in reversed(range(len(saved))):
        h, zr, rh, c = saved[t]
        z, r = zr[:units], zr[units:]
        dh = dh + dstates[t]
        dc = dh * z * (np.abs(c) < 1)
        drh = u[2 * units :].T @ dc
        dzr = np.concatenate([dh * (c - h), drh * h]) * ((zr > 0) & (zr < 1))
        dx[t, : 2 * units], dx[t, 2 * units :] = dzr, dc
        du[: 2 * units] += dzr @ h.T
        du[2 * units :] += dc @ rh.T
        dh = dh * (1 - z) + drh * r + u[: 2 * units].T @ dzr
    return dx, du


class Adam:
    """Adam over a dict of arrays, with the gradients' common norm held to ``most``."""

    def __init__(self, params: dict[str, np.ndarray], rate: float, most: float = 5.0):
        self.params, self.rate, self.most, self.n = params, rate, most, 0
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.v = {k: np.zeros_like(v) for k, v in params.items()}

    def step(self, grads: dict[str, np.ndarray]) -> None:
        self.n += 1
        norm = float(np.sqrt(sum(float((g * g).sum()) for g in grads.values())))
        scale = min(1.0, self.most / norm) if norm else 1.0
        for k, g in grads.items():
            g = g * scale
            self.m[k] = 0.9 * self.m[k] + 0.1 * g
            self.v[k] = 0.999 * self.v[k] + 0.001 * g * g
            rate = self.rate * np.sqrt(1 - 0.999**self.n) / (1 - 0.9**self.n)
            self.params[k] -= (rate * self.m[k] / (np.sqrt(self.v[k]) + 1e-8)).astype(np.float32)
