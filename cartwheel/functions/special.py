"""Vectorised special functions for the likelihood kernels (numpy only):
log-gamma (Lanczos, g=7, 9 terms) and the Gauss hypergeometric function in the
forms that the models need, each element run to convergence or an error."""

from __future__ import annotations

import numpy as np

# Lanczos coefficients for g = 7, n = 9 (published constants).
_LANCZOS_G = 7.0
_LANCZOS = np.array([
    0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313,
    -176.61502916214059, 12.507343278686905, -0.13857109526572012, 9.9843695780195716e-6,
    1.5056327351493116e-7,
])


def gammaln(x):
    """log|Gamma(x)| for x > 0 (reflection for x < 0.5)."""
    x = np.asarray(x, dtype=float)
    out = np.empty_like(x)
    small = x < 0.5
    if np.any(small):
        xs = x[small]
        out[small] = np.log(np.pi / np.abs(np.sin(np.pi * xs))) - gammaln(1.0 - xs)
    big = ~small
    if np.any(big):
        z = x[big] - 1.0
        a = np.full_like(z, _LANCZOS[0])
        for i in range(1, 9):
            a = a + _LANCZOS[i] / (z + i)
        t = z + _LANCZOS_G + 0.5
        out[big] = 0.5 * np.log(2 * np.pi) + (z + 0.5) * np.log(t) - t + np.log(a)
    return out


class NotConverged(ArithmeticError):
    """A series or a continued fraction has not reached its tolerance."""


def _each_until(step, state, shape, limit: int, what: str):
    """Run ``step(n, state of the open elements)`` -> (state, done, value) until every
    element is done. An element's value is that of its first done step; finished
    elements leave when they are a quarter of the open ones."""
    open_ = np.arange(int(np.prod(shape)))
    out = np.empty(len(open_))
    waiting = np.ones(len(open_), dtype=bool)
    for n in range(limit):
        if not waiting.any():
            return out.reshape(shape)
        state, done, value = step(n, state)
        done &= waiting
        if not done.any():
            continue
        out[open_[done]] = value[done]
        waiting &= ~done
        if 4 * np.count_nonzero(waiting) <= 3 * len(waiting):  # leave finished elements behind, in few copies
            open_, state, waiting = open_[waiting], [v[waiting] for v in state], waiting[waiting]
    if waiting.any():
        raise NotConverged(f"{what}: {np.count_nonzero(waiting)} of {len(out)} values after {limit} terms")
    return out.reshape(shape)


def hyp2f1_series(a, b, c, z, tol: float = 1e-16, limit: int = 1_000_000):
    """2F1(a, b; c; z) by its power series, 0 <= z < 1, element by element; for
    parameters whose terms don't grow (a and b small against c)."""
    a, b, c, z = np.broadcast_arrays(*(np.asarray(v, dtype=float) for v in (a, b, c, z)))

    def step(n, s):
        a_, b_, c_, z_, term, total = s
        term = term * (a_ + n) * (b_ + n) / ((c_ + n) * (n + 1.0)) * z_
        total = total + term
        ratio = np.abs((a_ + n + 1) * (b_ + n + 1) / ((c_ + n + 1) * (n + 2.0)) * z_)
        done = (np.abs(term) <= tol * np.abs(total) * np.maximum(1 - ratio, 1e-8)) & (ratio < 1) | (term == 0)
        return [a_, b_, c_, z_, term, total], done, total
    start = [v.ravel().copy() for v in (a, b, c, z)]
    ones = np.ones(z.size)
    return _each_until(step, [*start, ones, ones.copy()], z.shape, limit, "hypergeometric series")


def log_hyp2f1_next(a, b, z, tol: float = 1e-15, limit: int = 100_000):
    """log 2F1(a, b; a + 1; z) for a > 0, b > 0 and 0 <= z < 1 without overflow:
    Euler's transformation gives (1 - z)^(1 - b) 2F1(1, a + 1 - b; a + 1; z), and
    Gauss's continued fraction of the latter (modified Lentz steps) converges
    for every z below 1."""
    a, b, z = np.broadcast_arrays(*(np.asarray(v, dtype=float) for v in (a, b, z)))
    c, p = a + 1.0, a + 1.0 - b

    def step(n, s):
        p_, c_, z_, f, d, e = s
        k = n // 2
        # coefficients of 1 / (1 - t1 z / (1 - t2 z / (1 - ...)))
        t = (p_ + k) * (c_ + k - 1) / ((c_ + 2 * k - 1) * (c_ + 2 * k)) if n % 2 == 0 \
            else (k + 1) * (c_ - p_ + k) / ((c_ + 2 * k) * (c_ + 2 * k + 1))
        x = -t * z_
        d = 1.0 + x * d
        e = 1.0 + x / e
        d = 1.0 / np.where(np.abs(d) < 1e-300, 1e-300, d)
        e = np.where(np.abs(e) < 1e-300, 1e-300, e)
        f = f * d * e
        return [p_, c_, z_, f, d, e], np.abs(d * e - 1.0) < tol, f
    start = [v.ravel().copy() for v in (p, c, z)]
    ones = np.ones(z.size)
    # the denominator 1 - t1 z / (...) starts at 1
    fraction = _each_until(step, [*start, ones, np.zeros(z.size), ones.copy()], z.shape, limit, "continued fraction")
    return (1.0 - b) * np.log1p(-z) - np.log(fraction)


def logsubexp(a, b):
    """log(exp(a) - exp(b)) for a >= b."""
    return a + np.log1p(-np.exp(b - a))
