"""Special functions for p-values, evaluated on result-sized tables.

Spark SQL has no incomplete gamma / beta functions; these run as vectorised
pandas UDFs over one row per test (never over data rows).  Formulas of the NIST
Digital Library of Mathematical Functions: the power series 8.7.1 and the
continued fractions 8.9.2 and 8.17.22, the latter two evaluated from the last
term back to the first for all rows at once.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

_lgamma = np.vectorize(math.lgamma, otypes=[float])


def _terms(largest: float) -> int:
    """Terms for full precision: near the middle of a distribution they grow with the root of its parameter."""
    return 200 + 20 * math.ceil(math.sqrt(largest))


def _upper_gamma(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Q(a, x) for a > 0, x > 0."""
    n = _terms(a.max(initial=0.0))
    front = np.exp(a * np.log(x) - x - _lgamma(a))
    small = x < a + 1
    term = np.where(small, 1 / a, 0.0)
    series = term.copy()
    y = np.where(small, x, 1.0)
    for i in range(1, n):
        term = term * y / (a + i)
        series += term
    y = np.where(small, a + 1, x)
    tail = y.copy()                      # y + (1-a)/(1 + 1/(y + (2-a)/(1 + 2/(y + ...))))
    for i in range(n, 0, -1):
        tail = y + (i - a) / (1 + i / tail)
    return np.clip(np.where(small, 1 - front * series, front / tail), 0.0, 1.0)


def _beta_ratio(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """I_x(a, b) for 0 < x < (a + 1) / (a + b + 2), where the fraction converges fast."""
    front = np.exp(_lgamma(a + b) - _lgamma(a) - _lgamma(b) + a * np.log(x) + b * np.log1p(-x)) / a
    tail = np.ones_like(x)               # 1 + d1/(1 + d2/(1 + ...))
    for m in range(_terms(max(a.max(initial=0.0), b.max(initial=0.0))), -1, -1):
        even = (m + 1) * (b - m - 1) * x / ((a + 2 * m + 1) * (a + 2 * m + 2))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        tail = 1 + odd / (1 + even / tail)
    return front / tail


def _lower_beta(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """I_x(a, b), by the reflection 8.17.4 where x is large."""
    turn = x >= (a + 1) / (a + b + 2)
    inner = (x > 0) & (x < 1)
    safe = np.where(inner, np.where(turn, 1 - x, x), 0.25)
    got = _beta_ratio(np.where(turn, b, a), np.where(turn, a, b), safe)
    return np.where(inner, np.where(turn, 1 - got, got), np.where(x <= 0, 0.0, 1.0))


def _where_valid(f, *args) -> np.ndarray:
    """``f`` on the rows whose arguments are all finite, NaN elsewhere."""
    cols = [np.atleast_1d(np.asarray(pd.to_numeric(pd.Series(a, dtype="float64")))) for a in args]
    ok = np.isfinite(cols).all(axis=0)
    out = np.full(len(cols[0]), np.nan)
    out[ok] = f(*[c[ok] for c in cols])
    return out


def _chi2(stat: np.ndarray, dof: np.ndarray) -> np.ndarray:
    some = (stat > 0) & (dof > 0)
    got = _upper_gamma(np.where(some, dof, 2.0) / 2, np.where(some, stat, 2.0) / 2)
    return np.where(dof > 0, np.where(some, got, 1.0), np.nan)


def _t(t: np.ndarray, df: np.ndarray) -> np.ndarray:
    d = np.where(df > 0, df, 1.0)
    return np.where(df > 0, _lower_beta(d / 2, np.full_like(d, 0.5), d / (d + t * t)), np.nan)


def chi2_sf(stat: float, dof: float) -> float:
    """P(X > stat) for X ~ chi-square(dof)."""
    return float(_where_valid(_chi2, [stat], [dof])[0])


def t_two_sided_p(t: float, df: float) -> float:
    """Two-sided p of Student's t with ``df`` degrees of freedom."""
    return float(_where_valid(_t, [t], [df])[0])


@F.pandas_udf(DoubleType())
def chi2_sf_udf(stat: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series(_where_valid(_chi2, stat, dof))


@F.pandas_udf(DoubleType())
def t_two_sided_p_udf(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series(_where_valid(_t, t, df))


@F.pandas_udf(DoubleType())
def norm_cdf_udf(z: pd.Series) -> pd.Series:
    return pd.Series([0.5 * math.erfc(-v / math.sqrt(2.0)) if pd.notna(v) else np.nan for v in z],
                     dtype="float64")
