"""Singular values and right singular vectors of a small triangular matrix:
Householder bidiagonalisation, dqds for the values, twisted factorisations of
the Golub-Kahan form for the vectors.

The matrices here are as large as an embedding's dimension squared, whatever
the number of rows they were reduced from.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """Unit ``v`` and ``alpha`` with (1 - 2 v v') x = alpha e1 (v is 0 for x = 0)."""
    size = np.linalg.norm(x)
    if size == 0:
        return np.zeros_like(x), 0.0
    alpha = -size if x[0] >= 0 else size
    v = x.copy()
    v[0] -= alpha
    return v / np.linalg.norm(v), alpha


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal a, superdiagonal b, W) with R = Q B W' for orthogonal Q, W."""
    m, d = r.astype(float), len(r)
    w = np.eye(d)
    for k in range(d):
        v, alpha = _reflector(m[k:, k])
        m[k:, k:] -= 2 * np.outer(v, v @ m[k:, k:])
        m[k, k], m[k + 1:, k] = alpha, 0
        if k + 2 <= d - 1:
            v, alpha = _reflector(m[k, k + 1:])
            m[k:, k + 1:] -= 2 * np.outer(m[k:, k + 1:] @ v, v)
            m[k, k + 1], m[k, k + 2:] = alpha, 0
            w[:, k + 1:] -= 2 * np.outer(w[:, k + 1:] @ v, v)
    return np.diag(m).copy(), np.diag(m, 1).copy(), w


def _dqds(q: np.ndarray, e: np.ndarray, s: float):
    """One step with shift ``s``; None where the shift passed the smallest value."""
    q2, e2, d = np.empty_like(q), np.empty_like(e), q[0] - s
    if d < 0:
        return None
    for i in range(len(e)):
        q2[i] = d + e[i]
        if q2[i] <= 0:
            return None
        t = q[i + 1] / q2[i]
        e2[i] = e[i] * t
        d = d * t - s
        if d < 0 or not np.isfinite(d):
            return None
    q2[-1] = d
    return q2, e2


def _shift(q: np.ndarray, e: np.ndarray) -> float:
    """The smaller eigenvalue of the last two rows, by the stable quotient."""
    a, b, c = q[-2] + (e[-2] if len(e) > 1 else 0.0), q[-1] + e[-1], q[-2] * e[-1]
    half = (a - b) / 2
    big = (a + b) / 2 + np.hypot(half, np.sqrt(c))
    return max((a * b - c) / big, 0.0) if big > 0 else 0.0


def dqds_values(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Singular values, falling, of the upper bidiagonal matrix (a, b).

    Squares are found one after another at the end of a block; an off-diagonal
    that no longer matters cuts a block in two.  A shift that turns out too
    large is lowered and at last 0, which never fails.
    """
    todo, found = [(a * a, b * b, 0.0)], []
    tiny = (4 * EPS) ** 2
    while todo:
        q, e, sigma = todo.pop()
        while True:
            if len(q) == 1:
                found.append(sigma + q[0])
                break
            cut = np.flatnonzero(e <= tiny * (sigma + np.minimum(q[:-1], q[1:])))
            if len(cut) == 0 and e[-1] <= tiny * (sigma + q[-1]):
                cut = np.array([len(e) - 1])
            if len(cut):
                k = int(cut[-1])
                todo += [(q[:k + 1], e[:k], sigma), (q[k + 1:], e[k + 1:], sigma)]
                break
            if q[0] * 1.5 < q[-1]:  # large values first: the small one comes out at the end
                q, e = q[::-1].copy(), e[::-1].copy()
            s, step = _shift(q, e), None
            for _ in range(6):
                step = _dqds(q, e, s)
                if step is not None or s == 0:
                    break
                s *= 0.5
            if step is None:
                s, step = 0.0, _dqds(q, e, 0.0)
            if step is None:  # a pivot underflowed: the block is 0 beside sigma
                found += [sigma + x for x in q]
                break
            q, e = step
            sigma += s
    return np.sqrt(np.maximum(np.sort(found)[::-1], 0))


def twisted_vector(a: np.ndarray, b: np.ndarray, sigma: float) -> np.ndarray:
    """Unit right singular vector of (a, b) for ``sigma``.  The Golub-Kahan matrix has
    zero diagonal and off-diagonals a1 b1 a2 b2 ..., and holds the vectors
    interleaved; its factors from above and from below meet at the row whose
    pivot is smallest, and the vector is solved outwards from there."""
    c = np.empty(2 * len(a) - 1)
    c[0::2], c[1::2] = a, b
    n, floor = len(c) + 1, max(sigma, np.abs(c).max()) * EPS * EPS

    def pivots(off):
        p = np.empty(n)
        p[0] = -sigma
        for i in range(n - 1):
            if abs(p[i]) < floor:
                p[i] = -floor
            p[i + 1] = -sigma - off[i] * off[i] / p[i]
        return p
    down, up = pivots(c), pivots(c[::-1])[::-1]
    k = int(np.argmin(np.abs(down + up + sigma)))
    z = np.zeros(n)
    z[k] = 1.0
    for i in range(k - 1, -1, -1):
        z[i] = -c[i] / down[i] * z[i + 1] if down[i] else 0.0
    for i in range(k, n - 1):
        z[i + 1] = -c[i] / up[i + 1] * z[i] if up[i + 1] else 0.0
    v = z[0::2]
    size = np.linalg.norm(v)
    return v / size if np.isfinite(size) and size > 0 else np.eye(len(a))[:, 0]


def _together(a: np.ndarray, b: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Orthonormal vectors of values too close for separate ones: inverse
    iteration of the whole group, then the small problem inside its span."""
    m = np.diag(a) + np.diag(b, 1)
    t, mid = m.T @ m, float(np.mean(values)) ** 2
    x = np.random.default_rng(len(a)).standard_normal((len(a), len(values)))
    for k in range(4):
        x = np.linalg.qr(np.linalg.solve(t - mid * (1 + (k + 1) * 8 * EPS) * np.eye(len(a)), x))[0]
    inner = (m @ x).T @ (m @ x)
    val, vec = np.linalg.eigh(inner)
    return (x @ vec[:, np.argsort(-val)])


def right_vectors(r: np.ndarray, k: int, close: float = 1e-6) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest singular values of R (fewer where its rank is lower)
    and their right singular vectors as columns, largest entry positive."""
    a, b, w = bidiagonalise(r)
    scale = max(np.abs(a).max(initial=0), np.abs(b).max(initial=0))
    if scale == 0 or not np.isfinite(scale):
        return np.zeros(0), np.zeros((len(r), 0))
    values = dqds_values(a / scale, b / scale)
    a, b = a / scale, b / scale
    take = min(k, int((values > len(r) * EPS * values[0]).sum()))
    out, i = [], 0
    while i < take:
        j = i + 1
        while j < len(values) and values[j - 1] - values[j] <= close * values[0]:
            j += 1
        group = twisted_vector(a, b, values[i])[:, None] if j == i + 1 else _together(a, b, values[i:j])
        out.append(group)
        i = j
    v = w @ np.concatenate(out, axis=1)[:, :take]
    v /= np.linalg.norm(v, axis=0)
    v *= np.where(v[np.abs(v).argmax(axis=0), np.arange(take)] < 0, -1, 1)
    return values[:take] * scale, v
