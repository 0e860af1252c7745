"""Singular values and right singular vectors of a small triangular matrix, by qd transforms.

Householder reflections make it bidiagonal; dqds finds all singular values to
high relative accuracy; a twisted factorisation of BᵀB - λ at the index with the
smallest pivot gives each vector. Values too close to be told apart so are taken
together: their vectors are made orthogonal and refined by inverse iteration.
"""

from __future__ import annotations

import numpy as np

EPS = float(np.finfo(float).eps)
#: two eigenvalues nearer to each other than this share of theirs are taken together
CLOSE = 1e-3


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """(w, a): (I - 2wwᵀ) x = (a, 0, ..., 0), w a unit vector or zero."""
    scale = np.abs(x).max(initial=0.0)
    if scale == 0.0 or len(x) == 1:
        return np.zeros(len(x)), float(x[0]) if len(x) else 0.0
    w = x / scale
    a = -np.copysign(np.linalg.norm(w), w[0])
    w[0] -= a
    return w / np.linalg.norm(w), float(a * scale)


def bidiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(d, f, w): ``matrix`` = U B wᵀ with B upper bidiagonal, d on its diagonal and f above it."""
    a = np.array(matrix, float)
    p = a.shape[1]
    w = np.eye(p)
    for k in range(p):
        u, a[k, k] = _reflector(a[k:, k].copy())
        a[k + 1 :, k] = 0.0
        a[k:, k + 1 :] -= 2.0 * np.outer(u, u @ a[k:, k + 1 :])
        if k + 2 <= p - 1:
            u, first = _reflector(a[k, k + 1 :].copy())
            a[k, k + 1 :] = 0.0
            a[k, k + 1] = first
            a[k + 1 :, k + 1 :] -= 2.0 * np.outer(a[k + 1 :, k + 1 :] @ u, u)
            w[:, k + 1 :] -= 2.0 * np.outer(w[:, k + 1 :] @ u, u)
    return np.diagonal(a).copy(), np.diagonal(a, 1).copy(), w


def _transform(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float, bool]:
    """One dqds transform: new q and e, the least d, and whether only the last d fell below zero."""
    n = len(q)
    new_q, new_e = [0.0] * n, [0.0] * (n - 1)
    d = q[0] - shift
    least = d
    for i in range(n - 1):
        if d < 0.0:
            return new_q, new_e, least, False
        new_q[i] = d + e[i]
        t = q[i + 1] / new_q[i] if new_q[i] else 0.0
        new_e[i] = e[i] * t
        d = (d * t if new_q[i] else q[i + 1]) - shift
        least = min(least, d)
    new_q[-1] = d
    return new_q, new_e, least, d < 0.0


def dqds(d: np.ndarray, f: np.ndarray) -> np.ndarray:
    """Eigenvalues of BᵀB in falling order, each to high relative accuracy.

    A shift stays below the smallest eigenvalue: one that makes an early pivot
    negative is cut to a quarter, one that fails at the last pivot says how far it was off.
    """
    found: list[float] = []
    tolerance = (10.0 * EPS) ** 2
    parts = [([float(x) ** 2 for x in d], [float(x) ** 2 for x in f], 0.0, 0.0)]
    while parts:
        q, e, sigma, guess = parts.pop()
        while True:
            if len(q) == 1:
                found.append(q[0] + sigma)
                break
            if e[-1] <= tolerance * (sigma + q[-1]):
                found.append(q.pop() + sigma)
                e.pop()
                guess = 0.0
                continue
            cut = next((i for i in range(len(e)) if e[i] <= tolerance * max(q[i], sigma)), None)
            if cut is not None:
                parts.append((q[: cut + 1], e[:cut], sigma, 0.0))
                q, e, guess = q[cut + 1 :], e[cut + 1 :], 0.0
                continue
            if 1.5 * q[0] < q[-1]:  # small values are found at the end
                q, e = q[::-1], e[::-1]
                guess = 0.0
            shift = guess
            while True:
                new_q, new_e, least, late = _transform(q, e, shift)
                if least >= 0.0 or shift == 0.0:
                    break
                shift = max(0.0, (shift + least) * (1.0 - 2.0 * EPS)) if late else 0.25 * shift
                if shift < 1e-30 * max(q):
                    shift = 0.0
            # the least pivot bounds the next smallest eigenvalue from above; the coupling says how tightly
            last = new_q[-1]
            slack = np.sqrt(new_e[-1] * new_q[-2]) if last == least or last <= 2 * least else 0.75 * least
            guess = max(0.0, least - float(slack)) if last - slack > 0.5 * least else 0.25 * max(least, 0.0)
            q, e, sigma = [max(x, 0.0) for x in new_q], new_e, sigma + shift
    return np.sort(np.array(found))[::-1]


def _twisted(diagonal: np.ndarray, lower: np.ndarray, value: float, used: set[int]) -> tuple[np.ndarray, int]:
    """A vector of L D Lᵀ near ``value`` from the factorisation twisted where its pivot is least, at an index not used yet."""
    n = len(diagonal)
    tiny = EPS * EPS * max(float(np.abs(diagonal).max()), abs(value), 1e-300)
    down, up = np.zeros(max(n - 1, 0)), np.zeros(max(n - 1, 0))
    s, p = np.zeros(n), np.zeros(n)
    s[0] = -value
    for i in range(n - 1):
        pivot = diagonal[i] + s[i]
        pivot = pivot if abs(pivot) > tiny else -tiny
        down[i] = diagonal[i] * lower[i] / pivot
        s[i + 1] = down[i] * lower[i] * s[i] - value
    p[-1] = diagonal[-1] - value
    for i in range(n - 2, -1, -1):
        pivot = diagonal[i] * lower[i] ** 2 + p[i + 1]
        pivot = pivot if abs(pivot) > tiny else -tiny
        t = diagonal[i] / pivot
        up[i] = lower[i] * t
        p[i] = p[i + 1] * t - value
    gamma = np.abs(s + p + value)
    gamma[~np.isfinite(gamma)] = np.inf
    k = min((i for i in range(n) if i not in used), key=lambda i: gamma[i], default=int(gamma.argmin()))
    z = np.zeros(n)
    z[k] = 1.0
    for i in range(k - 1, -1, -1):
        z[i] = -down[i] * z[i + 1]
    for i in range(k, n - 1):
        z[i + 1] = -up[i] * z[i]
    return z / np.linalg.norm(z), k


def _close_vectors(b: np.ndarray, values: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Orthonormal vectors of eigenvalues of BᵀB that lie close together, by inverse iteration from ``start``."""
    t = b.T @ b
    scale = float(values[0])
    centre = float(values.mean()) + 4.0 * EPS * scale
    shifted = t - centre * np.eye(len(t))
    z = np.linalg.qr(start)[0]
    for _ in range(60):
        small, turn = np.linalg.eigh(z.T @ (t @ z))
        z = z @ turn[:, ::-1]
        off = np.abs(t @ z - z * small[::-1]).max()
        if off <= 8.0 * EPS * scale * len(t) ** 0.5:
            break
        z = np.linalg.qr(np.linalg.solve(shifted, z))[0]
    return z


def eigenpairs(triangle: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(all eigenvalues, values, vectors) of RᵀR: the ``count`` largest ones that are not zero to working precision."""
    d, f, w = bidiagonal(triangle)
    every = dqds(d, f)
    floor = len(every) * EPS * float(every[:1].sum())
    wanted = int(min(count, (every > floor).sum()))
    if not wanted:
        return every, every[:0], np.zeros((len(every), 0))
    norm = float(np.sqrt(every[0]))
    held = np.where(np.abs(d) > EPS * EPS * norm, d, EPS * EPS * norm)
    diagonal, lower = held**2, f / held[:-1]
    b = np.diag(held) + np.diag(f, 1)
    vectors = np.zeros((len(every), wanted))
    at = 0
    while at < wanted:
        end = at + 1
        while end < len(every) and every[end - 1] - every[end] <= CLOSE * every[end - 1]:
            end += 1
        used: set[int] = set()
        found = []
        for value in every[at:end]:
            z, k = _twisted(diagonal, lower, float(value), used)
            used.add(k)
            found.append(z)
        block = np.array(found).T
        # vectors of one value alone need no more than their factorisation
        block = block if end - at == 1 else _close_vectors(b, every[at:end], block)
        vectors[:, at : min(end, wanted)] = block[:, : min(end, wanted) - at]
        at = end
    vectors = w @ vectors
    # the larger part of a direction is positive
    big = np.abs(vectors).argmax(axis=0)
    vectors *= np.sign(vectors[big, np.arange(wanted)])
    return every, every[:wanted], vectors
