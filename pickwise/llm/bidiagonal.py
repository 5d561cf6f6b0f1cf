"""Right singular vectors of a triangular matrix by the bidiagonal qd method.

Householder reflections make the matrix bidiagonal, dqds finds all singular
values to high relative accuracy, and twisted factorisations of shifted qd
representations give the vectors of the largest ones. The matrix has as many
rows as vectors have components, whatever the number of vectors.
"""

from __future__ import annotations

import numpy as np

EPS = float(np.finfo(float).eps)
TINY = 1e-290
#: Values that differ by less, relatively, get a representation of their own.
CLOSE = 1e-3


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float, float]:
    """v, beta and alpha with (I - beta v v') x = alpha e1."""
    rest = float(np.linalg.norm(x[1:]))
    v = x.copy()
    if rest == 0.0:
        return v, 0.0, float(x[0])
    alpha = -float(np.copysign(np.hypot(x[0], rest), x[0]))
    v[0] -= alpha
    return v, 2.0 / float(v @ v), alpha


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """a, b and V: r = U B V' with a on the diagonal of B and b above it."""
    m = np.array(r, float)
    d = len(m)
    a, b, v = np.zeros(d), np.zeros(max(d - 1, 0)), np.eye(d)
    for i in range(d):
        u, beta, a[i] = _reflector(m[i:, i])
        m[i:, i + 1 :] -= beta * np.outer(u, u @ m[i:, i + 1 :])
        if i + 1 < d:
            w, beta, b[i] = _reflector(m[i, i + 1 :])
            m[i + 1 :, i + 1 :] -= beta * np.outer(m[i + 1 :, i + 1 :] @ w, w)
            v[:, i + 1 :] -= beta * np.outer(v[:, i + 1 :] @ w, w)
    return a, b, v


def _qd_step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float]] | None:
    """A differential qd step; None where the shift is over the least value."""
    d = q[0] - shift
    new_q, new_e = [], []
    for ei, above in zip(e, q[1:], strict=True):
        up = d + ei
        if d < 0 or up <= 0:
            return None
        ratio = above / up
        new_q.append(up)
        new_e.append(ei * ratio)
        d = d * ratio - shift
    return None if d < 0 else ([*new_q, d], new_e)


def dqds(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared singular values of the bidiagonal matrix, largest first."""
    found: list[float] = []
    todo = [([float(x) ** 2 for x in a], [float(x) ** 2 for x in b], 0.0)]
    while todo:
        q, e, sigma = todo.pop()
        for _ in range(60 * len(q) + 60):
            if len(q) <= 1:
                break
            cut = next((i for i in range(len(e) - 1, -1, -1) if e[i] <= EPS * EPS * (sigma + min(q[i], q[i + 1])) or e[i] <= TINY), None)
            if cut == len(e) - 1:
                found.append(q.pop() + sigma)
                e.pop()
                continue
            if cut is not None:
                todo.append((q[: cut + 1], e[:cut], sigma))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            if 2 * q[0] < q[-1]:  # least values converge at the end
                q, e = q[::-1], e[::-1]
            for shift in _shifts(q, e):
                step = _qd_step(q, e, shift)
                if step is not None:
                    (q, e), sigma = step, sigma + shift
                    break
        else:
            raise ArithmeticError("dqds did not converge")
        found += [x + sigma for x in q]
    return np.sort(np.array(found))[::-1]


def _shifts(q: list[float], e: list[float]) -> list[float]:
    """Shifts to try, the boldest first; no shift always succeeds."""
    t, p = q[-1] + q[-2] + e[-1], q[-1] * q[-2]
    root = float(np.sqrt(max(t * t - 4 * p, 0.0)))
    least = 2 * p / (t + root) if t > 0 else 0.0  # of the last two rows: at least the least value
    if len(q) == 2:
        return [least * (1 - 4 * EPS), least / 4, 0.0]
    link = e[-2] * q[-2]
    return [x for x in (least - link / root if root > 0 else 0.0, least - float(np.sqrt(link)), least / 4) if x > 0] + [0.0]


class _Shifted:
    """L D L' with unit lower bidiagonal L: a representation of a symmetric tridiagonal matrix."""

    def __init__(self, diagonal: np.ndarray, lower: np.ndarray):
        self.d, self.l = [float(x) for x in diagonal], [float(x) for x in lower]
        self.floor = TINY + EPS * EPS * max(map(abs, self.d))

    def down(self, x: float) -> tuple[list[float], list[float], list[float]]:
        """D+ and L+ of this matrix less x, and the remainders s."""
        s, plus, low, rest = -x, [], [], [-x]
        for d, l in zip(self.d, self.l, strict=False):
            p = d + s
            if abs(p) < self.floor:
                p = -self.floor
            plus.append(p)
            low.append(d * l / p)
            s = low[-1] * l * s - x
            rest.append(s)
        return [*plus, self.d[-1] + s], low, rest

    def below(self, x: float) -> int:
        """How many eigenvalues are less than x."""
        return sum(p < 0 for p in self.down(x)[0])

    def twisted(self, x: float) -> tuple[np.ndarray, float]:
        """A unit vector z and the remainder of (L D L' - x) z, from the best twist."""
        _, low, s = self.down(x)
        n = len(self.d)
        p, up = [0.0] * n, [0.0] * (n - 1)
        p[-1] = self.d[-1] - x
        for i in range(n - 2, -1, -1):
            minus = self.d[i] * self.l[i] * self.l[i] + p[i + 1]
            if abs(minus) < self.floor:
                minus = -self.floor
            t = self.d[i] / minus
            up[i] = self.l[i] * t
            p[i] = p[i + 1] * t - x
        gamma = [a + b + x for a, b in zip(s, p, strict=True)]
        r = min(range(n), key=lambda i: abs(gamma[i]))
        z = [0.0] * n
        z[r] = 1.0
        for i in range(r - 1, -1, -1):
            z[i] = -low[i] * z[i + 1]
        for i in range(r, n - 1):
            z[i + 1] = -up[i] * z[i]
        size = float(np.linalg.norm(z))
        return np.array(z) / size, gamma[r] / size**2

    def refined(self, rank: int, x: float, spread: float) -> float:
        """The eigenvalue that ``rank`` others exceed, near x, by bisection."""
        n, low, high = len(self.d), x - spread, x + spread
        while self.below(low) > n - 1 - rank:
            low, spread = low - spread, 2 * spread
        while self.below(high) <= n - 1 - rank:
            high, spread = high + spread, 2 * spread
        for _ in range(200):
            mid = (low + high) / 2
            if not low < mid < high or high - low <= 2 * EPS * max(abs(low), abs(high)):
                break
            if self.below(mid) > n - 1 - rank:
                high = mid
            else:
                low = mid
        return (low + high) / 2


def _vectors(rep: _Shifted, values: list[float], first: int, wanted: int, depth: int = 0) -> list[np.ndarray]:
    """Vectors of ``values``, the eigenvalues of ``rep`` from rank ``first`` on
    (largest first), as far as rank ``wanted``."""
    out: list[np.ndarray] = []
    i = 0
    while i < len(values) and first + i < wanted:
        j = i + 1
        while j < len(values) and values[j - 1] - values[j] <= CLOSE * max(abs(values[j - 1]), abs(values[j])):
            j += 1
        if j == i + 1 or depth == 5:
            for x in values[i:j]:
                z, change = rep.twisted(x)
                for _ in range(3):
                    if abs(change) <= 2 * EPS * abs(x):
                        break
                    x += change
                    z, change = rep.twisted(x)
                out.append(z)
        else:  # the difference from their largest tells close values apart
            wide = 8 * EPS * len(rep.d) * abs(values[i])
            shift = values[i] + wide
            plus, low, _ = rep.down(shift)
            near = _Shifted(np.array(plus), np.array(low))
            fine = [near.refined(first + k, values[k] - shift, wide) for k in range(i, j)]
            out += _vectors(near, fine, first + i, wanted, depth + 1)
        i = j
    return out


def largest(r: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray, float]:
    """The ``count`` largest eigenvalues of r' r (fewer if it has fewer), largest
    first, their unit vectors as columns, each with its largest entry positive,
    and the sum of all eigenvalues."""
    a, b, v = bidiagonalise(r)
    size = float(max(np.abs(a).max(), np.abs(b).max() if len(b) else 0.0))
    if size == 0.0:
        return np.zeros(min(count, len(a))), v[:, :count], 0.0
    cuts = [0, *(np.flatnonzero(np.abs(b) <= EPS * size / 100) + 1).tolist(), len(a)]
    found = []  # (value, block, vector of it)
    total = 0.0
    for at, end in zip(cuts, cuts[1:], strict=False):
        own_a, own_b = np.abs(a[at:end]), np.abs(b[at : end - 1])
        values = dqds(own_a, own_b)
        total += float(values.sum())
        if end - at == 1:
            vectors = [np.ones(1)]
        else:
            diagonal = np.maximum(own_a, EPS * EPS * size)
            vectors = _vectors(_Shifted(diagonal**2, own_b / diagonal[:-1]), values.tolist(), 0, count)
            # signs of a and b, left out so far, only turn signs in the vector
            vectors = [z * np.concatenate([[1.0], np.cumprod(np.sign(a[at : end - 1]) * np.sign(b[at : end - 1]) + (a[at : end - 1] == 0))]) for z in vectors]
        for value, z in zip(values.tolist(), vectors, strict=False):
            found.append((value, at, z))
    found.sort(key=lambda x: (-x[0], x[1]))
    values, columns = [], []
    for value, at, z in found[:count]:
        x = v[:, at : at + len(z)] @ z
        for c in columns:  # what rounding left of others
            x = x - (c @ x) * c
        x = x / np.linalg.norm(x)
        values.append(value)
        columns.append(x * np.copysign(1.0, x[np.argmax(np.abs(x))]))
    return np.array(values), np.stack(columns, axis=1), total
