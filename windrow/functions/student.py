"""Two-sided p-values of Student's t, vectorised with numpy.

The incomplete beta function is computed by its continued fraction with the modified
Lentz method, so that very small p-values keep their digits.
"""

from __future__ import annotations

import math

import numpy as np

# The fraction needs about the square root of the degrees of freedom in steps.
MAX_STEPS = 200_000
TINY = 1e-300


def _log_beta_half(a: np.ndarray) -> np.ndarray:
    """log B(a, 1/2), by a series for large a, where log gammas would cancel."""
    distinct, where = np.unique(a, return_inverse=True)
    gain = np.array(
        [
            math.lgamma(v + 0.5) - math.lgamma(v)
            if v < 50
            else 0.5 * math.log(v) - 1 / (8 * v) + 1 / (192 * v**3) - 1 / (640 * v**5)
            for v in distinct
        ]
    )
    return 0.5 * math.log(math.pi) - gain[where]


def _beta_fraction(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Continued fraction of the incomplete beta function, valid for x < (a+1)/(a+b+2)."""
    c = np.ones_like(x)
    d = 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / np.where(np.abs(d) < TINY, TINY, d)
    value = d.copy()
    for m in range(1, MAX_STEPS):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        for term in (even, odd):
            d = 1.0 + term * d
            d = 1.0 / np.where(np.abs(d) < TINY, TINY, d)
            c = 1.0 + term / c
            c = np.where(np.abs(c) < TINY, TINY, c)
            step = c * d
            value *= step
        if np.all(np.abs(step - 1.0) < 1e-15):
            break
    return value


def _beta_half(a: np.ndarray, x: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """Regularised incomplete beta I_x(a, 1/2), with ``rest`` = 1 - x given exactly."""
    b = np.full(a.shape, 0.5)
    with np.errstate(divide="ignore"):
        log_x = np.where(x < 0.5, np.log(x), np.log1p(-rest))
        log_rest = np.where(rest < 0.5, np.log(rest), np.log1p(-x))
        front = np.exp(a * log_x + b * log_rest - _log_beta_half(a))
    low = x < (a + 1.0) / (a + b + 2.0)
    aa, bb, xx = np.where(low, a, b), np.where(low, b, a), np.where(low, x, rest)
    part = front * _beta_fraction(aa, bb, xx) / aa
    result = np.where(low, part, 1.0 - part)
    return np.where(x <= 0, 0.0, np.where(rest <= 0, 1.0, result))


def two_sided_p(t: np.ndarray, df: np.ndarray) -> np.ndarray:
    """P(|T| >= |t|) for df degrees of freedom; nan where either is nan, 0 for infinite t."""
    t, df = np.asarray(t, dtype=float), np.asarray(df, dtype=float)
    result = np.full(t.shape, np.nan)
    known = ~np.isnan(t) & ~np.isnan(df) & (df > 0)
    result[known & np.isinf(t)] = 0.0
    use = known & np.isfinite(t)
    if use.any():
        square, nu = t[use] ** 2, df[use]
        result[use] = _beta_half(nu / 2.0, nu / (nu + square), square / (nu + square))
    return result
