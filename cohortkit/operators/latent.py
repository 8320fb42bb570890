"""Latent-vector table operators.

Rows hold ``array<double>`` vectors (one row per item, one column per
view).  Per-row formulas use higher-order array functions; set-level
quantities are aggregations.  No pair of rows is formed: MMD with the linear
kernel reduces exactly to the distance between the two view means, MMD with the
RBF kernel is estimated from random Fourier features with a stated error, and the
supervised contrastive loss, which needs every pair of rows, is not built.
"""

from __future__ import annotations

from typing import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vectors as V


def _d(c):
    return V.to_double_array(F.col(c) if isinstance(c, str) else c)


def product_of_experts(mus: Sequence[str], logvars: Sequence[str], eps: float = 1e-8) -> tuple[Column, Column]:
    """L1: precision-weighted mean and summed precision of the experts."""
    precs = [F.transform(_d(lv), lambda x: 1.0 / (F.exp(x) + eps)) for lv in logvars]
    ptot = precs[0]
    for p in precs[1:]:
        ptot = F.zip_with(ptot, p, lambda a, b: a + b)
    wsum = F.zip_with(_d(mus[0]), precs[0], lambda m, p: m * p)
    for m, p in zip(mus[1:], precs[1:]):
        wsum = F.zip_with(wsum, F.zip_with(_d(m), p, lambda a, b: a * b), lambda a, b: a + b)
    var = F.transform(ptot, lambda p: 1.0 / p)
    mu = F.zip_with(var, wsum, lambda v, s: v * s)
    return mu, F.transform(var, lambda v: F.log(v))


def mixture_of_experts(mus: Sequence[str], logvars: Sequence[str]) -> tuple[Column, Column]:
    """L2: plain averages of the experts' means and log variances."""
    k = float(len(mus))

    def avg(cols):
        acc = _d(cols[0])
        for c in cols[1:]:
            acc = F.zip_with(acc, _d(c), lambda a, b: a + b)
        return F.transform(acc, lambda x: x / k)
    return avg(mus), avg(logvars)


def kl_unit_gaussian(mu: str, logvar: str, free_bits: float = 0.0) -> Column:
    """L3: per row ``sum_d max(free_bits, -0.5 (1 + lv - mu^2 - e^lv))``
    (no floor when ``free_bits`` is 0)."""
    per = F.zip_with(_d(mu), _d(logvar), lambda m, lv: -0.5 * (1 + lv - m * m - F.exp(lv)))
    if free_bits > 0:
        per = F.transform(per, lambda x: F.greatest(x, F.lit(float(free_bits))))
    return V.vsum(per)


def mmd_linear(df: DataFrame, a: str, b: str) -> DataFrame:
    """L4 (linear kernel): ``mean k(a,a') + mean k(b,b') - 2 mean k(a,b)`` =
    ``|mean(a) - mean(b)|^2``, from two vector means."""
    m = df.agg(Summarizer.mean(array_to_vector(_d(a))).alias("ma"), Summarizer.mean(array_to_vector(_d(b))).alias("mb"))
    return m.select(V.sqdist(vector_to_array("ma"), vector_to_array("mb")).alias("mmd2"))


def mmd_linear_sets(a: DataFrame, a_col: str, b: DataFrame, b_col: str) -> DataFrame:
    """L4 (linear kernel) between two separate tables of vectors."""
    ma = a.agg(Summarizer.mean(array_to_vector(_d(a_col))).alias("m")).select(vector_to_array("m").alias("ma"))
    mb = b.agg(Summarizer.mean(array_to_vector(_d(b_col))).alias("m")).select(vector_to_array("m").alias("mb"))
    return ma.withColumn("mb", mb.scalar()).select(V.sqdist("ma", "mb").alias("mmd2"))


def mmd_rbf_sets(a: DataFrame, a_col: str, b: DataFrame, b_col: str, bandwidth: float = 1.0, frequencies: int = 4096,
                 seed: int = 42, delta: float = 1e-3) -> DataFrame:
    """L4 (RBF kernel ``exp(-mean((x - y)^2) / (2 bandwidth))``) between two tables.

    The kernel is the mean of ``cos(w.(x - y))`` over normal w of variance
    ``1 / (dimensions * bandwidth)``, so the MMD is the mean over w of the squared distance
    between the tables' mean ``exp(i w.x)``: one scan, one row of sums a task.
    Returns ``(mmd2, std_error, bound)``: the estimate, its standard error over the
    frequencies, and Hoeffding's bound that holds with probability ``1 - delta`` (each
    frequency's value lies in 0..4).  Null vectors take no part; an empty side gives nulls."""
    rows = a.select(F.lit(0).alias("side"), _d(a_col).alias("x")).unionByName(b.select(F.lit(1).alias("side"), _d(b_col).alias("x"))).where("x is not null")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, n, total = None, [0, 0], np.zeros((2, 2 * frequencies))
        for batch in batches:
            if batch.num_rows == 0:
                continue
            side = batch.column(0).to_numpy()
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            if w is None:
                w = np.random.default_rng(seed).normal(size=(x.shape[1], frequencies)) / np.sqrt(x.shape[1] * bandwidth)
            for at in range(0, len(x), 512):  # 512 rows of features at a time
                p, s = x[at:at + 512] @ w, side[at:at + 512]
                z = np.concatenate([np.cos(p), np.sin(p)], axis=1)
                for v in (0, 1):
                    n[v] += int((s == v).sum())
                    total[v] += z[s == v].sum(axis=0)
        yield pa.RecordBatch.from_pydict({"side": pa.array([0, 1], pa.int32()), "n": pa.array(n, pa.int64()),
                                          "total": pa.array(list(total), pa.list_(pa.float64()))})
    sums = rows.mapInArrow(scan, "side int, n long, total array<double>").groupBy("side").agg(
        F.sum("n").alias("n"), vector_to_array(Summarizer.sum(array_to_vector("total"))).alias("total"))
    mean = F.when(F.col("n") > 0, F.transform("total", lambda v: v / F.col("n")))
    m = sums.agg(F.max(F.when(F.col("side") == 0, mean)).alias("ma"), F.max(F.when(F.col("side") == 1, mean)).alias("mb"))
    d = m.select(F.zip_with("ma", "mb", lambda p, q: (p - q) * (p - q)).alias("d"))
    per = F.zip_with(F.slice("d", 1, frequencies), F.slice("d", frequencies + 1, frequencies), lambda p, q: p + q)
    z = d.select(per.alias("z")).select("z", (V.vsum(F.col("z")) / frequencies).alias("mmd2"))
    var = V.vsum(F.transform("z", lambda v: (v - F.col("mmd2")) * (v - F.col("mmd2")))) / (frequencies - 1)
    return z.select("mmd2", F.sqrt(var / frequencies).alias("std_error"),
                    F.lit(4 * float(np.sqrt(np.log(2 / delta) / (2 * frequencies)))).alias("bound"))


def domain_loss(df: DataFrame, a: str, b: str) -> DataFrame:
    """With m the mean coordinate of a code, logits (-m, m); summed
    cross-entropy against view 0 for ``a`` and view 1 for ``b``."""
    def ce(col, label):
        m = V.vsum(_d(col)) / F.size(col)
        lse = F.log(F.exp(-m) + F.exp(m))
        return lse - (m if label == 1 else -m)
    return df.agg((F.sum(ce(a, 0)) + F.sum(ce(b, 1))).alias("domain_loss"))


def squared_error(pred: str, target: str, weight: float = 1.0) -> Column:
    """Weighted sum of squared differences of two arrays (per row)."""
    return F.lit(float(weight)) * V.sqdist(pred, target)


def total_loss(recon: Column, kl: Column, clf: Column, domain: Column, beta: float = 1.0, gamma: float = 0.0,
               contrastive: Column | None = None, contrastive_weight: float = 0.0) -> Column:
    """``recon + beta kl + 5 clf + gamma domain (+ w contrastive)``."""
    t = recon + F.lit(beta) * kl + F.lit(5.0) * clf + F.lit(gamma) * domain
    if contrastive is not None:
        t = t + F.lit(contrastive_weight) * contrastive
    return t


def latent_stats(df: DataFrame, vec: str) -> DataFrame:
    """Mean, sample std, min, max over all coordinates of all rows."""
    x = df.select(F.explode(_d(vec)).alias("x"))
    return x.agg(F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"), F.min("x").alias("min"),
                 F.max("x").alias("max"), F.count(F.lit(1)).alias("n_values"))


def cross_entropy(logits: str, label: str) -> Column:
    """Per row ``logsumexp(logits) - logits[label]`` (label 0-based)."""
    lg = _d(logits)
    mx = F.array_max(lg)
    lse = mx + F.log(V.vsum(F.transform(lg, lambda x: F.exp(x - mx))))
    return lse - F.element_at(lg, F.col(label) + 1)
