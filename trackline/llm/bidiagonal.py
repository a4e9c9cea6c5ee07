"""Singular values and right singular vectors of a small triangular matrix, to high relative accuracy.

Householder reflections make it bidiagonal, differential quotient-difference steps with shifts (dqds) find the singular
values, and twisted factorisations of the shifted product give a vector for each without touching the others.
"""

from __future__ import annotations

import numpy as np

EPS = 2.0 ** -52
#: Values closer than this, relative to their size, are a cluster: their vectors are kept at right angles.
CLUSTER = 1e-3


def bidiagonalised(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal a and superdiagonal b of B = U^T r P, and P, for a square matrix r."""
    b, size = np.array(r, float), len(r)
    p = np.eye(size)
    for k in range(size):
        v, beta = _reflector(b[k:, k])
        b[k:, k:] -= beta * np.outer(v, v @ b[k:, k:])
        if k < size - 2:
            v, beta = _reflector(b[k, k + 1:])
            b[k:, k + 1:] -= beta * np.outer(b[k:, k + 1:] @ v, v)
            p[:, k + 1:] -= beta * np.outer(p[:, k + 1:] @ v, v)
    return np.diag(b).copy(), np.diag(b, 1).copy(), p


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """v and beta with (I - beta v v^T) x along the first axis."""
    top = np.abs(x).max(initial=0.0)
    if top == 0:
        return np.zeros_like(x), 0.0
    v = x / top
    v[0] += np.copysign(np.linalg.norm(v), v[0])
    return v, 2 / (v @ v)


def _blocks(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of the diagonal that no superdiagonal entry above rounding joins; their product splits there."""
    near = np.maximum(np.abs(a[:-1]), np.abs(a[1:]))
    cuts = np.flatnonzero(np.abs(b) <= EPS * np.where(near > 0, near, np.abs(a).max(initial=0.0)))
    ends = [0, *(cuts + 1).tolist(), len(a)]
    return list(zip(ends, ends[1:], strict=False))


def _step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float] | None:
    """One differential step; None when the shift is above the smallest value left."""
    d, new_q, new_e, least = q[0] - shift, [], [], q[0] - shift
    for k, off in enumerate(e):
        if d < 0:
            return None
        now = d + off
        ratio = q[k + 1] / now if now else 0.0
        new_q.append(now)
        new_e.append(off * ratio)
        d = d * ratio - shift
        least = min(least, d)
    return (new_q + [d], new_e, least) if d >= 0 else None


def dqds(q: list[float], e: list[float]) -> list[float]:
    """The eigenvalues of the product B^T B, from squares q of B's diagonal and e of its superdiagonal."""
    found, open_ones = [], [(list(q), list(e), 0.0)]
    while open_ones:
        q, e, moved = open_ones.pop()
        failures = 0
        while len(q) > 1:
            cut = next((k for k in range(len(e) - 1, -1, -1) if e[k] <= EPS ** 2 * (q[k + 1] + moved)
                        or e[k] <= EPS ** 2 * (q[k] + moved)), None)
            if cut is not None:
                open_ones.append((q[:cut + 1], e[:cut], moved))
                q, e, failures = q[cut + 1:], e[cut + 1:], 0
                continue
            if q[0] < q[-1] and len(q) > 2 and q[0] * 1.5 < q[-1]:  # the small end goes last
                q, e = q[::-1], e[::-1]
            # the smaller eigenvalue of the last two rows is a guess from above: back off after each failure
            x, y, z = q[-2], e[-1], q[-1]
            half, product = (x + y + z) / 2, x * z
            guess = product / (half + np.sqrt(max(half * half - product, 0.0))) if half else 0.0
            shift = 0.0 if failures > 3 else float(guess) * (0.98, 0.7, 0.3, 0.05)[failures]
            done = _step(q, e, shift)
            if done is None:
                failures += 1
                continue
            q, e, _ = done
            moved += shift
            failures = max(0, failures - 1)
        found.append(max(q[0], 0.0) + moved)
    return sorted(found, reverse=True)


def _twisted(a: np.ndarray, b: np.ndarray, value: float) -> tuple[np.ndarray, ...]:
    """Top-down and bottom-up factors of B^T B - value, and the diagonal of the twist at every place."""
    d, size, tiny = a * a, len(a), EPS * max(value, float(np.max(a * a)), np.finfo(float).tiny)
    low, up = np.zeros(size), np.zeros(size)
    lower, upper = np.zeros(size - 1), np.zeros(size - 1)
    s, p = np.zeros(size), np.zeros(size)
    s[0] = -value
    for k in range(size - 1):
        low[k] = s[k] + d[k]
        low[k] = low[k] if abs(low[k]) > tiny * EPS else -tiny * EPS
        lower[k] = a[k] * b[k] / low[k]
        s[k + 1] = lower[k] * (b[k] / a[k]) * s[k] - value
    low[-1] = s[-1] + d[-1]
    p[-1] = d[-1] - value
    for k in range(size - 2, -1, -1):
        up[k + 1] = b[k] * b[k] + p[k + 1]
        up[k + 1] = up[k + 1] if abs(up[k + 1]) > tiny * EPS else -tiny * EPS
        ratio = d[k] / up[k + 1]
        upper[k] = (b[k] / a[k]) * ratio
        p[k] = p[k + 1] * ratio - value
    up[0] = p[0]
    return low, lower, up, upper, s + p + value


def _vector(lower: np.ndarray, upper: np.ndarray, twist: int) -> np.ndarray:
    z = np.zeros(len(lower) + 1)
    z[twist] = 1.0
    for k in range(twist - 1, -1, -1):
        z[k] = -lower[k] * z[k + 1]
    for k in range(twist, len(lower)):
        z[k + 1] = -upper[k] * z[k]
    return z


def _solved(factors: tuple[np.ndarray, ...], twist: int, right: np.ndarray) -> np.ndarray:
    """The solution of the twisted system for another right side (inverse iteration)."""
    low, lower, up, upper, gamma = factors
    x = right.copy()
    for k in range(twist):
        x[k + 1] -= lower[k] * x[k]
    for k in range(len(x) - 2, twist - 1, -1):
        x[k] -= upper[k] * x[k + 1]
    x[:twist] /= low[:twist]
    x[twist + 1:] /= up[twist + 1:]
    x[twist] /= gamma[twist] if gamma[twist] else EPS * max(np.abs(low).max(), np.abs(up).max())
    for k in range(twist - 1, -1, -1):
        x[k] -= lower[k] * x[k + 1]
    for k in range(twist, len(x) - 1):
        x[k + 1] -= upper[k] * x[k]
    return x


def right_vectors(a: np.ndarray, b: np.ndarray, values: list[float]) -> list[np.ndarray]:
    """A unit vector of B^T B for each of the falling eigenvalues of one unsplit block."""
    if len(a) == 1:
        return [np.ones(1) for _ in values]
    top = np.abs(a).max()
    a = np.where(np.abs(a) > EPS * top, a, EPS * top)  # a zero would split the factors, not the vectors
    out: list[np.ndarray] = []
    for at, value in enumerate(values):
        factors = _twisted(a, b, value)
        twist = int(np.argmin(np.abs(factors[4])))
        z = _vector(factors[1], factors[3], twist)
        z /= np.linalg.norm(z)
        close = [out[k] for k in range(at) if values[k] - value <= CLUSTER * values[k]]
        if close:
            others = np.array(close)
            start = z - others.T @ (others @ z)
            if np.linalg.norm(start) < 0.5:  # the same vector again: take another start
                start = np.random.default_rng(at).standard_normal(len(z))
            for _ in range(4):
                start -= others.T @ (others @ start)
                z = _solved(factors, twist, start / np.linalg.norm(start))
                z /= np.abs(z).max()
                for _ in range(2):
                    z -= others.T @ (others @ z)
                    z /= np.linalg.norm(z)
                start = z
        out.append(z)
    return out


def principal(r: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The `count` largest eigenvalues of r^T r (those that are not zero) and their unit vectors as rows."""
    scale = np.abs(r).max(initial=0.0)
    if scale == 0:
        return np.zeros(0), np.zeros((0, r.shape[1]))
    a, b, p = bidiagonalised(r / scale)
    found = []
    for low, high in _blocks(a, b):
        own = dqds((a[low:high] ** 2).tolist(), (b[low:high - 1] ** 2).tolist())
        found += [(value, low, high, k) for k, value in enumerate(own)]
    found.sort(key=lambda f: -f[0])
    least = (len(a) * EPS) ** 2 * found[0][0]
    chosen = [f for f in found[:count] if f[0] > least]
    vectors = np.zeros((len(chosen), len(a)))
    for low, high in {f[1:3] for f in chosen}:
        mine = [k for k, f in enumerate(chosen) if f[1:3] == (low, high)]
        for k, z in zip(mine, right_vectors(a[low:high], b[low:high - 1], [chosen[k][0] for k in mine]), strict=True):
            vectors[k, low:high] = z
    return np.array([f[0] for f in chosen]) * scale * scale, vectors @ p.T
