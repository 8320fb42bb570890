"""Iterative imputation (F5) fitted on one Gram matrix a missingness pattern.

The chained rounds regress each column with missing values on the others, as
they are by then.  An imputed value is a linear function of the row's observed
values (and of 1), and that function is the same for all rows that miss the same
columns.  So one pass over the data builds, for each pattern of missing columns, the Gram
matrix of the observed values; every later regression needs only these matrices
and each pattern's current functions.  The data is read once to fit and once
to fill.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Iterable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

LOCAL_BYTES = 1 << 25       # matrices of up to so many bytes are kept by the driver


def pattern_grams(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(pattern, gram): for each pattern of missing (null or NaN) columns (a text of 0 and 1)
    the upper triangle, row by row, of the Gram matrix of (1, columns), missing
    values taken as 0.  One pass with partial sums; its size is the number of patterns."""
    own = [F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None)) for c in cols]
    x = [F.lit(1.0), *[F.coalesce(c, F.lit(0.0)) for c in own]]
    k = len(x)
    pattern = F.concat(F.lit(""), *[F.when(c.isNull(), "1").otherwise("0") for c in own])
    names = [f"x{i}" for i in range(k)]
    d = df.select(pattern.alias("pattern"), *[v.alias(n) for v, n in zip(x, names)])
    sums = [F.sum(F.col(names[i]) * F.col(names[j])) for i in range(k) for j in range(i, k)]
    return d.groupBy("pattern").agg(F.array(*sums).alias("gram"))


class _State:
    """The current linear functions of some patterns: maps[m, c] gives column
    c of pattern m's rows from (1, observed columns)."""

    def __init__(self, patterns: Sequence[str], grams: Sequence[Sequence[float]], means: np.ndarray):
        k = len(means) + 1
        self.missing = np.zeros((len(patterns), k), bool)
        self.gram = np.zeros((len(patterns), k, k))
        up = np.triu_indices(k)
        for m, (p, g) in enumerate(zip(patterns, grams)):
            self.missing[m, 1:] = [c == "1" for c in p]
            self.gram[m][up] = g
            self.gram[m].T[up] = g
        self.maps = np.tile(np.eye(k), (len(patterns), 1, 1))
        m, c = np.nonzero(self.missing)
        self.maps[m, c] = 0.0
        self.maps[m, c, 0] = means[c - 1]

    def put(self, target: int, beta: np.ndarray) -> None:
        """Fill the column with its prediction, where it is missing."""
        feats = [i for i in range(self.maps.shape[1]) if i != target]
        hit = self.missing[:, target]
        self.maps[hit, target] = np.einsum("f,mfk->mk", beta, self.maps[hit][:, feats])

    def system(self, target: int) -> np.ndarray:
        """Moments of the other columns, and with the target (last column),
        over the rows where the target is observed."""
        feats = [i for i in range(self.maps.shape[1]) if i != target]
        seen = ~self.missing[:, target]
        b = self.maps[seen][:, [*feats, target]]
        return np.einsum("mfk,mkl,mgl->fg", b, self.gram[seen], b)[:-1]


class IterativeImputerFit:
    """chained-equation imputation of numeric columns, most frequent value
    for text columns, fitted on ``train`` and applied to any frame.

    Numeric columns start from their means; each round takes those with missing
    values in turn, the fewest first, fits a ridge regression on the other columns
    over the rows where the column is observed, and refills its missing cells. Rounds stop
    at ``max_iter`` or when no coefficient moves by ``tol``.  Columns without any value in
    ``train`` are dropped from every frame.  Observed cells are never changed."""

    def __init__(self, train: DataFrame, cols: Iterable[str] | None = None, max_iter: int = 10, ridge: float = 1e-6, tol: float = 1e-3,
                 local_bytes: int = LOCAL_BYTES):
        from .features import _split_kinds, most_frequent
        num, cat = _split_kinds(train, cols)
        self.fills = {r["variable"]: r["value"] for r in most_frequent(train, cat).collect()} if cat else {}  # one row a column
        grams = materialize(pattern_grams(train, num)) if num else None
        k = len(num) + 1
        one = 8 * k * k
        local = grams is None or grams.limit(max(1, local_bytes // one) + 1).count() <= max(1, local_bytes // one)
        rows = [(r["pattern"], r["gram"]) for r in grams.collect()] if num and local else []
        if num and not local:
            n = [F.sum(F.when(F.substring("pattern", i + 1, 1) == "0", F.element_at("gram", 1)).otherwise(0.0)) for i in range(len(num))]
            s = [F.sum(F.element_at("gram", i + 2)) for i in range(len(num))]
            got = grams.agg(*[c.alias(f"n{i}") for i, c in enumerate(n)], *[c.alias(f"s{i}") for i, c in enumerate(s)], F.sum(F.element_at("gram", 1)).alias("all")).first()
            n, s = (np.array([got[f"{x}{i}"] for i in range(len(num))], float) for x in "ns")
            total = got["all"]
        else:
            n = np.array([sum(g[0] for p, g in rows if p[i] == "0") for i in range(len(num))], float)
            s = np.array([sum(g[i + 1] for _, g in rows) for i in range(len(num))], float)
            total = sum(g[0] for _, g in rows)
        self.numeric = [c for c, x in zip(num, n) if x]
        self.dropped = [c for c in [*num, *cat] if c not in self.numeric and c not in self.fills]
        keep = [i for i, x in enumerate(n) if x]
        self.means = s[keep] / n[keep] if keep else np.zeros(0)
        order = sorted((total - n[i], at) for at, i in enumerate(keep) if n[i] < total)
        self.targets = [at + 1 for _, at in order]
        self.history: list[tuple[int, np.ndarray]] = []
        if not self.targets:
            return
        part = np.array([0, *[i + 1 for i in keep]])
        place = {ij: at for at, ij in enumerate(zip(*np.triu_indices(k)))}
        chosen = [place[part[i], part[j]] for i in range(len(part)) for j in range(i, len(part))]
        state = lambda found: _State(["".join(p[i] for i in keep) for p, _ in found], [[g[i] for i in chosen] for _, g in found], self.means)
        held = state(rows) if local else None
        before = None
        for _ in range(max_iter):
            for t in self.targets:
                moments = held.system(t) if local else self._gathered(grams, state, t)
                xtx, xty = moments[:, :-1].copy(), moments[:, -1]
                xtx[1:, 1:] += ridge * np.eye(len(xtx) - 1)
                beta = np.linalg.solve(xtx + 1e-12 * np.eye(len(xtx)), xty)
                self.history.append((t, beta))
                if local:
                    held.put(t, beta)
            now = np.concatenate([b for _, b in self.history[-len(self.targets):]])
            if before is not None and np.max(np.abs(now - before)) < tol:
                break
            before = now

    def _gathered(self, grams: DataFrame, state, target: int) -> np.ndarray:
        """The moments where the patterns are too many for the driver: each
        task replays the fitted steps on its patterns and returns one sum."""
        history, shape = list(self.history), (len(self.numeric), len(self.numeric) + 1)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = np.zeros(shape)
            for b in batches:
                s = state(list(zip(b["pattern"], b["gram"])))
                for t, beta in history:
                    s.put(t, beta)
                total += s.system(target)
            yield pd.DataFrame({"cell": np.arange(total.size), "v": total.ravel()})
        got = grams.mapInPandas(run, "cell int, v double").groupBy("cell").agg(F.sum("v").alias("v")).collect()
        out = np.zeros(shape)
        for r in got:
            out.flat[r["cell"]] = r["v"]
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        from .features import apply_fills
        out = apply_fills(df.drop(*[c for c in self.dropped if c in df.columns]), self.fills)
        if not self.numeric:
            return out
        k, means, history = len(self.numeric), self.means, self.history

        @F.pandas_udf(", ".join(f"c{i} double" for i in range(k)))
        def filled(*cols: pd.Series) -> pd.DataFrame:
            x = np.column_stack([c.to_numpy(float) for c in cols])
            gap = np.isnan(x)
            x = np.where(gap, means, x)
            for t, beta in history:
                hit = gap[:, t - 1]
                if hit.any():
                    x[hit, t - 1] = beta[0] + np.delete(x[hit], t - 1, axis=1) @ beta[1:]
            return pd.DataFrame(x, columns=[f"c{i}" for i in range(k)])

        out = out.withColumn("__filled", filled(*[F.col(f"`{c}`").cast("double") for c in self.numeric]))
        return out.withColumns({c: F.col(f"__filled.c{i}") for i, c in enumerate(self.numeric)}).drop("__filled")


def iterative_impute(df: DataFrame, cols: Sequence[str], max_iter: int = 10, ridge: float = 1e-6, tol: float = 1e-3) -> DataFrame:
    """F5 in one call: fitted on ``df`` and applied to it."""
    return IterativeImputerFit(df, cols, max_iter, ridge, tol).transform(df)
