"""Phi_K correlation for mixed column types.

Numeric columns are binned into equal-width bins (the A22 rule); the
contingency counts of every column pair come from one generate + one
grouping (each row emits one cell per pair, partially aggregated before the
shuffle).  The observed chi-square is an aggregate over the cells that
occur; a grouped pandas function gets the two margins of a pair and matches it by the
chi-square that a bivariate normal with correlation rho, cut at the same
margins, would give (Baak et al., arXiv 1811.11440).  Our reading of the
paper's noise correction: the model curve runs from the pedestal
``(r-1)(c-1)`` at rho = 0 to ``n min(r-1, c-1)`` at rho = 1.
"""

from __future__ import annotations

import math
from typing import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

_GL_X, _GL_W = np.polynomial.legendre.leggauss(24)


def _norm_ppf(p: np.ndarray) -> np.ndarray:
    """Inverse normal CDF (Acklam's rational approximation, refined by one
    Newton step)."""
    a = [-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02, 1.383577518672690e+02,
         -3.066479806614716e+01, 2.506628277459239e+00]
    b = [-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02, 6.680131188771972e+01,
         -1.328068155288572e+01]
    c = [-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00, -2.549732539343734e+00,
         4.374664141464968e+00, 2.938163982698783e+00]
    d = [7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00, 3.754408661907416e+00]
    out = np.empty_like(p, dtype=float)
    for i, x in enumerate(p):
        if x <= 0:
            out[i] = -8.0
        elif x >= 1:
            out[i] = 8.0
        else:
            if x < 0.02425:
                q = math.sqrt(-2 * math.log(x))
                z = (((((c[0]*q+c[1])*q+c[2])*q+c[3])*q+c[4])*q+c[5]) / ((((d[0]*q+d[1])*q+d[2])*q+d[3])*q+1)
            elif x > 1 - 0.02425:
                q = math.sqrt(-2 * math.log(1 - x))
                z = -(((((c[0]*q+c[1])*q+c[2])*q+c[3])*q+c[4])*q+c[5]) / ((((d[0]*q+d[1])*q+d[2])*q+d[3])*q+1)
            else:
                q = x - 0.5
                r = q * q
                z = (((((a[0]*r+a[1])*r+a[2])*r+a[3])*r+a[4])*r+a[5])*q / (((((b[0]*r+b[1])*r+b[2])*r+b[3])*r+b[4])*r+1)
            e = 0.5 * math.erfc(-z / math.sqrt(2)) - x
            z = z - e * math.sqrt(2 * math.pi) * math.exp(z * z / 2)
            out[i] = max(-8.0, min(8.0, z))
    return out


_erfc = np.vectorize(math.erfc)


def _bvn_grid(ex: np.ndarray, ey: np.ndarray, rho: float) -> np.ndarray:
    """P(X <= h, Y <= k) of a standard bivariate normal on the grid ex x ey:
    Phi(h)Phi(k) + (1/2pi) int_0^rho exp(-(h^2-2hkr+k^2)/(2(1-r^2)))/sqrt(1-r^2) dr."""
    px = 0.5 * _erfc(-ex / math.sqrt(2.0))
    py = 0.5 * _erfc(-ey / math.sqrt(2.0))
    base = np.outer(px, py)
    if rho == 0:
        return base
    r = np.minimum(0.5 * rho * (_GL_X + 1.0), 1 - 1e-12)
    w = 0.5 * rho * _GL_W
    h = ex[:, None, None]
    k = ey[None, :, None]
    f = np.exp(-(h * h - 2 * h * k * r + k * k) / (2 * (1 - r * r))) / np.sqrt(1 - r * r)
    return base + (f * w).sum(axis=2) / (2 * math.pi)


#: Quadrature points held at once: the cells of a pair are priced in chunks of rows.
_POINTS = 1 << 22


def _bvn_chi2(rho: float, px: np.ndarray, py: np.ndarray, n: float) -> float:
    """Chi-square that the bivariate normal gives on the grid of two margins."""
    ex = np.concatenate([[-8.0], _norm_ppf(np.cumsum(px)[:-1]), [8.0]])
    ey = np.concatenate([[-8.0], _norm_ppf(np.cumsum(py)[:-1]), [8.0]])
    step = max(1, _POINTS // (len(ey) * len(_GL_X)))
    total, above = 0.0, _bvn_grid(ex[:1], ey, rho)
    for lo in range(1, len(ex), step):
        cdf = np.concatenate([above, _bvn_grid(ex[lo:lo + step], ey, rho)])
        cell = np.diff(np.diff(cdf, axis=0), axis=1)
        exp0 = np.outer(px[lo - 1:lo - 1 + step], py)
        total += float(np.sum((cell - exp0) ** 2 / exp0))
        above = cdf[-1:]
    return n * total


def phik_from_margins(rows: np.ndarray, cols: np.ndarray, chi2: float) -> float:
    """phi_k of a table with these (positive) row and column sums and this observed chi2."""
    r, c, n = len(rows), len(cols), float(rows.sum())
    if r < 2 or c < 2:
        return 0.0
    px, py = rows / n, cols / n
    ped = float((r - 1) * (c - 1))
    chi2_max = n * min(r - 1, c - 1)
    if chi2 <= ped:
        return 0.0
    if chi2 >= chi2_max:
        return 1.0
    top = _bvn_chi2(0.9999, px, py, n)

    def model(rho):
        return ped + (1 - ped / chi2_max) * _bvn_chi2(rho, px, py, n) * (chi2_max / max(top, 1e-12))
    lo, hi = 0.0, 0.9999
    for _ in range(40):
        mid = 0.5 * (lo + hi)
        if model(mid) < chi2:
            lo = mid
        else:
            hi = mid
    return 0.5 * (lo + hi)


def phik_from_table(counts: np.ndarray) -> tuple[float, float, int]:
    """(phi_k, observed chi2, dof) of one contingency table."""
    counts = counts[counts.sum(axis=1) > 0][:, counts.sum(axis=0) > 0]
    rows, cols = counts.sum(axis=1), counts.sum(axis=0)
    if min(counts.shape) < 2:
        return 0.0, 0.0, 0
    e = np.outer(rows, cols) / counts.sum()
    chi2 = float(np.sum((counts - e) ** 2 / e))
    return phik_from_margins(rows, cols, chi2), chi2, (len(rows) - 1) * (len(cols) - 1)


def pair_counts(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], bins: int = 10) -> DataFrame:
    """Contingency counts ``(col_a, col_b, a, b, n)`` of every column pair:
    numeric columns cut into ``bins`` equal-width bins, categorical columns
    as text (null is its own level)."""
    cols = list(numeric) + list(categorical)
    mm = df.agg(*[F.min(c).alias(f"mn_{c}") for c in numeric], *[F.max(c).alias(f"mx_{c}") for c in numeric]).first() if numeric else None
    coded = []
    for c in numeric:
        mn, mx = mm[f"mn_{c}"], mm[f"mx_{c}"]
        w = (mx - mn) / bins if mx is not None and mx > mn else 1.0
        coded.append(F.least(F.floor((F.col(c) - F.lit(mn)) / F.lit(w)), F.lit(bins - 1)).cast("string").alias(c))
    coded += [F.coalesce(F.col(c).cast("string"), F.lit("<null>")).alias(c) for c in categorical]
    d = df.select(*coded)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    cells = F.explode(F.array(*[F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"),
                                         F.col(a).alias("a"), F.col(b).alias("b")) for a, b in pairs]))
    return d.select(cells.alias("p")).select("p.*").groupBy("col_a", "col_b", "a", "b").agg(F.count(F.lit(1)).alias("n"))


def _margins_and_chi2(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((col_a, col_b, side, level, m), (col_a, col_b, chi2, dof)) of stored
    pair counts.  A cell that does not occur adds its expected count to chi2, so only cells that do are read."""
    pair = ["col_a", "col_b"]
    side = [counts.groupBy(*pair, x).agg(F.sum("n").alias(f"n_{x}")) for x in ("a", "b")]
    levels = side[0].select(*pair, F.lit("a").alias("side"), F.col("a").alias("level"), F.col("n_a").alias("m")) \
        .unionByName(side[1].select(*pair, F.lit("b").alias("side"), F.col("b").alias("level"), F.col("n_b").alias("m")))
    size = levels.groupBy(*pair).agg(F.count_if(F.col("side") == "a").alias("ra"), F.count_if(F.col("side") == "b").alias("rb"),
                                     F.sum(F.when(F.col("side") == "a", F.col("m"))).alias("total"))
    e = F.col("n_a") * F.col("n_b") / F.col("total")
    cells = counts.join(side[0], [*pair, "a"]).join(side[1], [*pair, "b"]).join(size, pair).withColumn("e", e)
    chi2 = cells.groupBy(*pair, "ra", "rb", "total").agg(F.sum((F.col("n") - F.col("e")) ** 2 / F.col("e")).alias("s"), F.sum("e").alias("se"))
    return levels, chi2.select(*pair, (F.col("s") + F.col("total") - F.col("se")).alias("chi2"), ((F.col("ra") - 1) * (F.col("rb") - 1)).cast("long").alias("dof"))


def pair_chi2(counts: DataFrame) -> DataFrame:
    """``(col_a, col_b, chi2, dof)`` of pair counts: Pearson's chi-square without correction."""
    return _margins_and_chi2(materialize(counts))[1]


def phik_matrix(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], bins: int = 10) -> DataFrame:
    """``(col_a, col_b, phik, chi2, dof)`` for every pair (upper triangle
    in column order), for any number of levels: chi2 is an aggregate over the cells that occur, and
    a pair's task gets its two margins only."""
    levels, chi2 = _margins_and_chi2(materialize(pair_counts(df, numeric, categorical, bins)))

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("level")
        side = [pdf.loc[pdf["side"] == x, "m"].to_numpy(dtype=float) for x in ("a", "b")]
        top = pdf.iloc[0]
        return pd.DataFrame([{"col_a": top["col_a"], "col_b": top["col_b"], "phik": phik_from_margins(*side, float(top["chi2"])),
                              "chi2": float(top["chi2"]), "dof": int(top["dof"])}])
    return (levels.join(chi2, ["col_a", "col_b"]).groupBy("col_a", "col_b")
            .applyInPandas(solve, "col_a string, col_b string, phik double, chi2 double, dof int"))


def top_pairs(phik: DataFrame, n: int = 20) -> DataFrame:
    """The n strongest pairs."""
    return phik.orderBy(F.col("phik").desc(), "col_a", "col_b").limit(n)


def named_pairs(phik: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """The requested pairs in either column order."""
    cond = None
    for a, b in pairs:
        c = ((F.col("col_a") == a) & (F.col("col_b") == b)) | ((F.col("col_a") == b) & (F.col("col_b") == a))
        cond = c if cond is None else cond | c
    return phik.where(cond)
