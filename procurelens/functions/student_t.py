"""Student's t for the few aggregated rows of the margin tests.

The two-sided tail is the regularised incomplete beta function I_x(df/2, 1/2) at
x = df / (df + t^2), by its continued fraction (modified Lentz method).
"""

from __future__ import annotations

import sys
from math import lgamma

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# Workers get these functions with the task, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_TINY = 1e-300
_MAX_TERMS = 100_000


def _log_beta_half(a: np.ndarray) -> np.ndarray:
    """log B(a, 1/2); the difference of log-gammas cancels badly for large a, so use its series."""
    big = a > 100
    safe = np.where(big, a, 101.0)
    ratio = 0.5 * np.log(safe) - 1 / (8 * safe) + 1 / (192 * safe**3) - 1 / (640 * safe**5)
    small = np.array([lgamma(x + 0.5) - lgamma(x) for x in np.where(big, 1.0, a)])
    return 0.5 * np.log(np.pi) - np.where(big, ratio, small)


def _beta_fraction(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    c = np.ones_like(x)
    d = 1 - (a + b) * x / (a + 1)
    d = 1 / np.where(np.abs(d) < _TINY, _TINY, d)
    h = d.copy()
    for m in range(1, _MAX_TERMS):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        for term in (even, odd):
            d = 1 + term * d
            d = 1 / np.where(np.abs(d) < _TINY, _TINY, d)
            c = 1 + term / c
            c = np.where(np.abs(c) < _TINY, _TINY, c)
            step = c * d
            h = h * step
        if np.all(np.abs(step - 1) < 1e-15):
            return h
    raise ArithmeticError("the continued fraction did not converge")


def two_sided_tail(t: np.ndarray, df: np.ndarray) -> np.ndarray:
    """P(|T| > |t|) with ``df`` degrees of freedom."""
    a, half = df / 2, np.full_like(df, 0.5)
    square = t * t
    x, rest = df / (df + square), square / (df + square)
    front = np.exp(-a * np.log1p(square / df) + 0.5 * np.log(np.maximum(rest, _TINY)) - _log_beta_half(a))
    direct = x < (a + 1) / (a + 2.5)
    p = np.where(direct, x, rest)
    first, second = np.where(direct, a, half), np.where(direct, half, a)
    part = front * _beta_fraction(first, second, p) / first
    return np.clip(np.where(direct, part, 1 - part), 0.0, 1.0)


def upper_quantile(level: np.ndarray, df: np.ndarray) -> np.ndarray:
    """t with P(T <= t) = level, for level >= 1/2, by bracketing and bisection."""
    tail = 2 * (1 - level)
    low, high = np.zeros_like(df), np.ones_like(df)
    for _ in range(1000):
        short = two_sided_tail(high, df) > tail
        if not short.any():
            break
        low, high = np.where(short, high, low), np.where(short, high * 2, high)
    else:
        raise ArithmeticError("no bound above the quantile")
    for _ in range(200):
        middle = (low + high) / 2
        # The absolute part ends the search at level 1/2, whose quantile is 0.
        if np.all((high - low <= 1e-15 * high + 1e-18) | (middle == low) | (middle == high)):
            return middle
        above = two_sided_tail(middle, df) > tail
        low, high = np.where(above, middle, low), np.where(above, high, middle)
    raise ArithmeticError("the bisection did not converge")


def _rowwise(function, first: pd.Series, df: pd.Series) -> pd.Series:
    out = np.full(len(first), np.nan)
    x, d = first.to_numpy(float), df.to_numpy(float)
    good = np.isfinite(x) & np.isfinite(d) & (d > 0)
    if good.any():
        out[good] = function(x[good], d[good])
    return pd.Series(out).astype(object).where(~np.isnan(out), None)


@F.pandas_udf(DoubleType())
def t_tail(t: pd.Series, df: pd.Series) -> pd.Series:
    return _rowwise(two_sided_tail, t, df)


@F.pandas_udf(DoubleType())
def t_quantile(level: pd.Series, df: pd.Series) -> pd.Series:
    return _rowwise(upper_quantile, level, df)
