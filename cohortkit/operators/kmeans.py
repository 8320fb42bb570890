"""Many k-means fits in one scan.

All fits (every seed and every k) advance together: one iteration is one read
of the rows, where a task finds the nearest centre under each open fit with
numpy, adds counts and coordinate sums, and sends one row a (fit, cluster);
one aggregate adds the tasks' rows.  The driver holds the centres only
(fits x k x dimensions).
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vectors as V
from ..session import materialize

INIT_ROWS = 4096  # rows that the first centres are drawn from
BLOCK = 2048      # rows whose distances a task holds at once


@dataclass
class KMeansFit:
    """Centres, their cost (sum of squared distances) and the iterations run."""
    k: int
    seed: int
    centres: np.ndarray
    cost: float
    iterations: int

    def clusterCenters(self) -> list[np.ndarray]:
        return list(self.centres)

    def transform(self, df: DataFrame, vec: str, out: str = "cluster") -> DataFrame:
        """Adds the nearest centre's number (equal distances: the lowest); null vectors get null."""
        centres = self.centres

        @F.pandas_udf("int")
        def nearest_centre(v: pd.Series) -> pd.Series:
            there = v.notna()
            got = pd.Series(np.full(len(v), None, dtype=object), index=v.index)
            if there.any():
                got[there] = nearest(np.stack(v[there].to_list()), centres)[0]
            return got.astype("Int32")
        return df.withColumn(out, nearest_centre(V.to_double_array(vec)))


def nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest centre, squared distance to it) of each row."""
    d = (x * x).sum(axis=1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(axis=1)
    at = d.argmin(axis=1)
    return at, np.square(x - centres[at]).sum(axis=1)


def first_centres(sample: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k-means++ on the sample: each next centre is drawn in proportion to the
    squared distance to the nearest one so far (uniformly where all are 0)."""
    rng = np.random.default_rng(seed)
    got = [sample[rng.integers(len(sample))]]
    near = np.square(sample - got[0]).sum(axis=1)
    while len(got) < k:
        p = near / near.sum() if near.sum() > 0 else np.full(len(sample), 1 / len(sample))
        got.append(sample[rng.choice(len(sample), p=p)])
        near = np.minimum(near, np.square(sample - got[-1]).sum(axis=1))
    return np.array(got)


def _pass(rows: DataFrame, centres: dict[int, np.ndarray], with_cost: bool = False) -> dict[int, tuple[np.ndarray, np.ndarray, float]]:
    """Per fit (rows of each cluster, coordinate sums, cost where asked for, else 0) in one
    scan.  The distances to the centres of all fits are one matrix product a block of rows,
    their coordinate sums another."""
    many, first, size = list(centres), {}, 0
    for f in many:
        first[f] = size
        size += len(centres[f])
    every = np.concatenate([centres[f] for f in many])
    half = np.square(every).sum(axis=1) / 2

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, cost = np.zeros(size, dtype=np.int64), np.zeros_like(every), np.zeros(size)
        for b in batches:
            if b.num_rows == 0:
                continue
            whole = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            for x in np.array_split(whole, -(-len(whole) // BLOCK)):
                far = half[:, None] - every @ x.T              # half the squared distance less the row's own half square
                member = np.zeros(far.shape)
                for f in many:
                    low = first[f]
                    at, best = np.full(len(x), low), far[low]
                    for j in range(low + 1, low + len(centres[f])):  # equal distances: the lowest
                        at[far[j] < best] = j
                        best = np.minimum(best, far[j])
                    for j in range(low, low + len(centres[f])):
                        member[j] = at == j
                    if with_cost:
                        cost += np.bincount(at, weights=np.square(x - every[at]).sum(axis=1), minlength=size)
                n += member.sum(axis=1).astype(np.int64)
                total += member @ x
        for f in many:
            own = slice(first[f], first[f] + len(centres[f]))
            k = len(centres[f])
            yield pa.RecordBatch.from_pydict({"fit": pa.array([f] * k, pa.int32()), "cluster": pa.array(range(k), pa.int32()),
                                              "n": pa.array(n[own]), "total": pa.array(list(total[own]), pa.list_(pa.float64())), "cost": pa.array(cost[own])})
    part = rows.mapInArrow(scan, "fit int, cluster int, n long, total array<double>, cost double")
    got = part.groupBy("fit", "cluster").agg(F.sum("n").alias("n"), vector_to_array(Summarizer.sum(array_to_vector("total"))).alias("total"),
                                             F.sum("cost").alias("cost")).collect()  # one row a centre
    out = {f: (np.zeros(len(c), dtype=np.int64), np.zeros_like(c), [0.0] * len(c)) for f, c in centres.items()}
    for r in got:
        n, total, cost = out[r["fit"]]
        n[r["cluster"]], total[r["cluster"]], cost[r["cluster"]] = r["n"], r["total"], r["cost"]
    return {f: (n, t, float(sum(c))) for f, (n, t, c) in out.items()}


def fit_many(df: DataFrame, vec: str, fits: Sequence[tuple[int, int]], max_iter: int = 300, tol: float = 1e-4,
             init_rows: int = INIT_ROWS) -> list[KMeansFit]:
    """One ``KMeansFit`` for each ``(k, seed)``, as if fitted alone.  Null
    vectors take no part.  First centres come from at most ``init_rows`` rows,
    those of the least content hash; every row moves the centres.  A fit rests
    when no centre moves more than ``tol``; a centre without rows stays.  Without
    rows there is nothing to fit: ValueError."""
    rows = materialize(df.select(V.to_double_array(vec).alias("x")).where("x is not null"))
    sample = rows.orderBy(F.xxhash64("x"), "x").limit(init_rows).collect()
    if not sample:
        raise ValueError("no vectors to cluster")
    start = np.array([r["x"] for r in sample])
    centres = {i: first_centres(start, k, seed) for i, (k, seed) in enumerate(fits)}
    done = dict.fromkeys(centres, max_iter)
    open_ = dict(centres)
    for step in range(1, max_iter + 1):
        for f, (n, total, _) in _pass(rows, open_).items():
            moved = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], centres[f])
            still = np.square(moved - centres[f]).sum(axis=1).max() <= tol * tol
            centres[f] = open_[f] = moved
            if still:
                done[f] = step
                del open_[f]
        if not open_:
            break
    last = _pass(rows, centres, with_cost=True)
    return [KMeansFit(k, seed, centres[i], last[i][2], done[i]) for i, (k, seed) in enumerate(fits)]
