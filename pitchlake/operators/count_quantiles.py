"""Quantiles of Poisson and negative-binomial counts at any mean, per row.

The smallest k whose CDF reaches p.  Where the terms are few, the CDF is summed
(:func:`summed`).  Elsewhere it is a regularised incomplete gamma or beta function: a power series or a continued fraction, whose number of
terms follows the square root of the mean (or of the size, if that is the
smaller).  The search starts from a Cornish-Fisher expansion, widens a bracket
in doubling steps and halves it, so rows in which the expansion is good take a
few evaluations and strongly skewed ones some forty.  All rows of an Arrow
batch are searched together; there is no shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from statistics import NormalDist

import numpy as np

EPS, TINY = 1e-16, 1e-300


def _lgamma(x: np.ndarray) -> np.ndarray:
    return np.fromiter(map(math.lgamma, x.tolist()), float, len(x))


def _until(n: int, step: Callable[[int, np.ndarray], np.ndarray]) -> None:
    """Repeat ``step(i, rows)`` on the rows that it returns, until none is left."""
    rows, i = np.arange(n), 0
    while len(rows):
        i += 1
        rows = rows[step(i, rows)]


def _nonzero(x: np.ndarray) -> np.ndarray:
    return np.where(np.abs(x) < TINY, TINY, x)


def poisson_cdf(k: np.ndarray, m: np.ndarray) -> np.ndarray:
    """P(X <= k), k >= 0: the upper incomplete gamma function Q(k + 1, m)."""
    a, out = k + 1.0, np.zeros(len(k))
    log = a * np.log(m) - m - _lgamma(a)
    low = m < a + 1
    if low.any():                                      # series of the lower function
        x, b = m[low], a[low]
        term = 1 / b
        total = term.copy()

        def add(i, r):
            term[r] *= x[r] / (b[r] + i)
            total[r] += term[r]
            return term[r] > total[r] * EPS
        _until(len(x), add)
        out[low] = 1 - total * np.exp(log[low])
    if (~low).any():                                   # continued fraction of the upper one
        x, b = m[~low], a[~low]
        c, d = np.full(len(x), 1 / TINY), 1 / _nonzero(x + 1 - b)
        h = d.copy()

        def more(i, r):
            an, bn = -i * (i - b[r]), x[r] + 1 - b[r] + 2 * i
            d[r] = 1 / _nonzero(an * d[r] + bn)
            c[r] = _nonzero(bn + an / c[r])
            h[r] *= c[r] * d[r]
            return np.abs(c[r] * d[r] - 1) > 4 * EPS
        _until(len(x), more)
        out[~low] = h * np.exp(log[~low])
    return out


def _beta_fraction(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    c, d = np.ones(len(x)), 1 / _nonzero(1 - (a + b) * x / (a + 1))
    h = d.copy()

    def more(i, r):
        p, q, y = a[r], b[r], x[r]
        for n in (i * (q - i) * y / ((p + 2 * i - 1) * (p + 2 * i)), -(p + i) * (p + q + i) * y / ((p + 2 * i) * (p + 2 * i + 1))):
            d[r] = 1 / _nonzero(1 + n * d[r])
            c[r] = _nonzero(1 + n / c[r])
            h[r] *= c[r] * d[r]
        return np.abs(c[r] * d[r] - 1) > 4 * EPS
    _until(len(x), more)
    return h


def negbin_cdf(k: np.ndarray, m: np.ndarray, size: np.ndarray) -> np.ndarray:
    """P(X <= k), k >= 0, of mean m: the incomplete beta function I_x(size, k + 1) at x = size / (size + m)."""
    a, b = size, k + 1.0
    x, y = size / (size + m), m / (size + m)
    log = _lgamma(a + b) - _lgamma(a) - _lgamma(b) + a * np.log(x) + b * np.log(y)
    front, out = np.exp(log), np.empty(len(k))
    left = x < (a + 1) / (a + b + 2)
    if left.any():
        out[left] = front[left] * _beta_fraction(a[left], b[left], x[left]) / a[left]
    if (~left).any():
        out[~left] = 1 - front[~left] * _beta_fraction(b[~left], a[~left], y[~left]) / b[~left]
    return out


def summed(probs, m: np.ndarray, size: np.ndarray | None, first: np.ndarray, last: np.ndarray) -> list[np.ndarray]:
    """Per probability the number of k in 0..last with CDF(k) < p, summed from pmf(0) = ``first`` on.

    A row leaves the loop when its CDF has reached the largest probability:
    the CDF never falls, so no later term counts.
    """
    pmf, cdf, top = first.copy(), first.copy(), max(probs)
    counts = [(cdf < p).astype(np.int64) for p in probs]
    grows = None if size is None else m / (size + m)

    def add(k, r):
        pmf[r] *= m[r] / k if size is None else (size[r] + k - 1) / k * grows[r]
        cdf[r] += pmf[r]
        for n, p in zip(counts, probs, strict=True):
            n[r] += cdf[r] < p
        return (cdf[r] < top) & (k < last[r])
    _until(len(m), add)
    return counts


def quantile(p: float, m: np.ndarray, size: np.ndarray | None = None) -> np.ndarray:
    """Smallest k >= 0 with CDF(k) >= p, for each mean (and size)."""
    m = np.asarray(m, float)
    cdf = (lambda k, r: poisson_cdf(k, m[r])) if size is None else (lambda k, r: negbin_cdf(k, m[r], size[r]))
    var = m if size is None else m + m * m / size
    sd = np.sqrt(var)
    skew = 1 / sd if size is None else (1 + 2 * m / size) / sd
    z = NormalDist().inv_cdf(p)
    guess = np.maximum(np.floor(m + z * sd + (z * z - 1) / 6 * skew * sd), 0.0)
    # CDF(low) < p <= CDF(high); nothing is below 0
    every = np.arange(len(m))
    reached = cdf(guess, every) >= p
    low, high = np.where(reached, -1.0, guess), np.where(reached, guess, np.inf)
    step = np.ones(len(m))
    open_ = every
    while len(open_):
        down = reached[open_]
        at = np.where(down, high[open_] - step[open_], low[open_] + step[open_])
        inside = at >= 0
        r, at, down = open_[inside], at[inside], down[inside]
        above = cdf(at, r) >= p
        high[r[above]], low[r[~above]] = at[above], at[~above]
        step[r] *= 2
        open_ = r[above == down]                       # the bracket has not closed yet
    open_ = every[high - low > 1]
    while len(open_):
        at = np.floor((low[open_] + high[open_]) / 2)
        above = cdf(at, open_) >= p
        high[open_[above]], low[open_[~above]] = at[above], at[~above]
        open_ = open_[high[open_] - low[open_] > 1]
    return high.astype(np.int64)
