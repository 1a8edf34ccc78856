"""Largest singular values and right singular vectors of a small square matrix.

Householder reflections bring the matrix to upper bidiagonal form, dqds (the
shifted quotient-difference iteration) finds the singular values of that, and a
twisted factorisation of B'B - s^2 I yields each right singular vector. Values
closer than ``CLUSTER`` are made orthogonal to each other; a vector that does
not survive this is found again by inverse iteration in the complement.
"""

from __future__ import annotations

import numpy as np

EPS = float(np.finfo(np.float64).eps)
CLUSTER = 1e-2  # relative distance of neighbouring squares from which on vectors are orthogonalised


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """(v, beta) with (I - beta v v') x = (+-|x|, 0, ...)."""
    scale = float(np.abs(x).max(initial=0.0))
    if scale == 0.0 or not np.any(x[1:]):
        return np.zeros_like(x), 0.0
    v = x / scale
    norm = float(np.sqrt(v @ v))
    v[0] += norm if v[0] >= 0 else -norm
    return v, 2.0 / float(v @ v)


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, superdiagonal, V) with r = U B V' for some orthogonal U."""
    b = np.array(r, np.float64)
    d = b.shape[0]
    v_all = np.eye(d)
    for k in range(d):
        v, beta = _reflector(b[k:, k])
        if beta:
            b[k:, k:] -= beta * np.outer(v, v @ b[k:, k:])
        if k < d - 2:
            v, beta = _reflector(b[k, k + 1:])
            if beta:
                b[k:, k + 1:] -= beta * np.outer(b[k:, k + 1:] @ v, v)
                v_all[:, k + 1:] -= beta * np.outer(v_all[:, k + 1:] @ v, v)
    return np.diag(b).copy(), np.diag(b, 1).copy(), v_all


def _transform(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float]] | None:
    """One dqds step; None when the shift exceeds the smallest value."""
    m = len(q)
    qq, ee = [0.0] * m, [0.0] * (m - 1)
    d = q[0] - shift
    if d < 0:
        return None
    for i in range(m - 1):
        qq[i] = d + e[i]
        if qq[i] == 0.0:  # the rows so far vanish: what follows starts anew
            ee[i], d = 0.0, q[i + 1] - shift
        else:
            t = q[i + 1] / qq[i]
            ee[i] = e[i] * t
            d = d * t - shift
        if d < 0:
            return None
    qq[m - 1] = d
    return qq, ee


def _block_values(q: list[float], e: list[float]) -> list[float]:
    """Squares of the singular values of the bidiagonal block with squared entries q and e."""
    out: list[float] = []
    work = [(q, e, 0.0)]
    tol = (4 * EPS) ** 2
    while work:
        q, e, moved = work.pop()
        steps = 0
        while q:
            m = len(q)
            if m == 1 or e[-1] <= tol * (moved + q[-1]):
                out.append(moved + q[-1])
                q, e = q[:-1], e[:-1]
                continue
            split = next((i for i in range(m - 2, -1, -1) if e[i] <= tol * (moved + min(q[i], q[i + 1]))), None)
            if split is not None:
                work.append((q[:split + 1], e[:split], moved))
                q, e = q[split + 1:], e[split + 1:]
                continue
            if 1.5 * q[0] < q[-1]:  # the small end belongs at the bottom
                q, e = q[::-1], e[::-1]
            # smaller value of the last two rows: near the least one, tried a little below it
            a, c, b = q[-1] + e[-1], q[-2], e[-1]
            root = max((a + c) ** 2 - 4 * c * q[-1], 0.0) ** 0.5
            least = 2 * c * q[-1] / (a + c + root) if c + b else 0.0
            shift = 0.0 if steps == 0 else 0.98 * least
            done = None
            while done is None:
                done = _transform(q, e, shift)
                shift, used = (shift / 4 if shift > EPS * EPS * least else 0.0), shift
            q, e = done
            moved += used
            steps += 1
            if steps > 200 * (m + 10):
                raise ArithmeticError("dqds did not converge")
    return out


def dqds(diagonal: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """Singular values of an upper bidiagonal matrix, falling."""
    scale = max(float(np.abs(diagonal).max(initial=0.0)), float(np.abs(upper).max(initial=0.0)))
    if scale == 0.0:
        return np.zeros(len(diagonal))
    q, e = ((diagonal / scale) ** 2).tolist(), ((upper / scale) ** 2).tolist()
    return np.sqrt(np.sort(np.array(_block_values(q, e)))[::-1]) * scale


def twisted_vector(diagonal: np.ndarray, upper: np.ndarray, square: float) -> np.ndarray:
    """Unit eigenvector of B'B for its eigenvalue near ``square``: the stationary factorisation from the top and the
    progressive one from the bottom meet where the twist element is least."""
    n = len(diagonal)
    big = max(float(np.abs(diagonal).max(initial=0.0)), float(np.abs(upper).max(initial=0.0)), np.finfo(float).tiny)
    tiny = (EPS * big) ** 2
    a = np.where(np.abs(diagonal) < EPS * big, EPS * big, diagonal)
    d, low, ld, lld = (a * a).tolist(), (upper / a[:-1]).tolist(), (upper * a[:-1]).tolist(), (upper ** 2).tolist()

    def safe(x: float) -> float:
        return x if abs(x) > tiny else (tiny if x >= 0 else -tiny)

    s, plus = [-square] + [0.0] * (n - 1), [0.0] * (n - 1)
    for i in range(n - 1):
        plus[i] = ld[i] / safe(s[i] + d[i])
        s[i + 1] = plus[i] * low[i] * s[i] - square
    p, minus = [0.0] * (n - 1) + [d[-1] - square], [0.0] * (n - 1)
    for i in range(n - 2, -1, -1):
        t = safe(lld[i] + p[i + 1])
        minus[i] = ld[i] / t
        p[i] = p[i + 1] * (d[i] / t) - square
    twist = int(np.argmin(np.abs(np.array(s) + np.array(p) + square)))
    z = np.zeros(n)
    z[twist] = 1.0
    for i in range(twist - 1, -1, -1):
        z[i] = -plus[i] * z[i + 1]
    for i in range(twist, n - 1):
        z[i + 1] = -minus[i] * z[i]
    z /= np.abs(z).max()
    return z / np.sqrt(z @ z)


def _inverse_iteration(t: np.ndarray, square: float, found: np.ndarray, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    shifted = t - (square * (1 + 8 * EPS) + np.abs(t).max() * EPS) * np.eye(len(t))
    z = rng.standard_normal(len(t))
    for _ in range(6):
        for _ in range(2):
            z -= found.T @ (found @ z)
        z = np.linalg.solve(shifted, z / np.sqrt(z @ z))
        z /= np.abs(z).max()
    for _ in range(2):
        z -= found.T @ (found @ z)
    return z / np.sqrt(z @ z)


def top_directions(r: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(all singular values of r, falling; the right singular vectors of the first k as columns)."""
    diagonal, upper, v = bidiagonalise(r)
    values = dqds(diagonal, upper)
    n, k = len(values), min(k, len(values))
    b = np.diag(diagonal) + np.diag(upper, 1)
    t = b.T @ b
    top = max(float(values[0]), np.finfo(float).tiny) if n else 1.0
    # a negligible superdiagonal entry splits B: a vector belongs to one of the blocks
    cuts = [0, *(np.flatnonzero(np.abs(upper) <= EPS * top) + 1).tolist(), n]
    blocks = list(zip(cuts[:-1], cuts[1:], strict=True))
    own = [dqds(diagonal[x:y], upper[x:y - 1]) for x, y in blocks] if len(blocks) > 1 else [values]
    order = sorted(((value, x, y) for (x, y), vs in zip(blocks, own, strict=True) for value in vs),
                   key=lambda row: -row[0])
    z = np.zeros((0, n))
    for j in range(k):
        value, x, y = order[j]
        w = np.zeros(n)
        w[x:y] = twisted_vector(diagonal[x:y], upper[x:y - 1], float(value) ** 2)
        near = [i for i in range(j) if order[i][0] ** 2 - value ** 2 <= CLUSTER * top ** 2]
        rest = w.copy()
        for _ in range(2):
            rest -= z[near].T @ (z[near] @ rest)
        norm = float(np.sqrt(rest @ rest))
        good = norm > 0.9 and np.abs(t @ rest / norm - value ** 2 * rest / norm).max() <= 1e-10 * top ** 2
        z = np.vstack([z, rest / norm if good else _inverse_iteration(t, float(value) ** 2, z, j)])
    return values, v @ z.T
