"""Survival analysis (V1-V6).

Data rows are first aggregated to one row per (group, distinct time); risk
sets are reverse running sums over those rows, computed with the skew-safe
two-level running sum.  The Cox model runs Newton steps: each step sums a
gradient (p numbers) and Hessian (p x p) in Spark for the driver to solve; tied
events enter by closed forms, whatever their number.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import windows as Wn
from ..functions.joins import null_safe_join
from ..session import materialize


def event_table(df: DataFrame, duration: str, event: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """V1: per group and distinct time: removed, observed events, censored,
    and at risk (rows with duration >= t)."""
    g = list(group_cols)
    t = df.groupBy(*g, F.col(duration).cast("double").alias("t")).agg(
        F.count(F.lit(1)).alias("n_removed"),
        F.sum(F.col(event).cast("long")).alias("n_events"))
    t = t.withColumn("n_censored", F.col("n_removed") - F.col("n_events"))
    r = Wn.running_sum(t, g, ["t"], {"n_at_risk": F.col("n_removed")}, descending=True)
    return r.withColumn("n_at_risk", F.col("n_at_risk").cast("long"))


def kaplan_meier(df: DataFrame, duration: str, event: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """V2: ``S(t) = prod_{u <= t} (1 - d_u / n_u)`` per group.  The product
    is a running sum of logs of the non-zero factors plus a running count of
    zero factors (a zero factor makes S 0 from there on)."""
    g = list(group_cols)
    et = event_table(df, duration, event, g)
    f = 1.0 - F.col("n_events") / F.col("n_at_risk")
    r = Wn.running_sum(et, g, ["t"], {"__lsum": F.when(f > 0, F.log(f)).otherwise(F.lit(0.0)),
                                       "__zeros": F.when(f <= 0, 1.0).otherwise(0.0)})
    return r.withColumn("survival", F.when(F.col("__zeros") > 0, F.lit(0.0)).otherwise(F.exp("__lsum"))) \
            .drop("__lsum", "__zeros")


def median_survival(km: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """V3: first time with S(t) <= 0.5 per group (null if never)."""
    g = list(group_cols)
    keys = km.select(*g).distinct() if g else None
    m = km.where(F.col("survival") <= 0.5).groupBy(*g).agg(F.min("t").alias("median_time"))
    return null_safe_join(keys, m, g, "left") if g else m


def survival_frame(df: DataFrame, key: str, outcomes: DataFrame, cluster: str, drop_first: bool = True,
                   levels: Sequence | None = None, max_levels: int = 1000) -> DataFrame:
    """V6: attach duration / event by key (J5) and one-hot the cluster,
    dropping the first level (F7)."""
    j = df.join(outcomes, key, "inner")
    if levels is None:  # levels become columns: read at most max_levels + 1 of them
        found = [r[0] for r in j.select(cluster).distinct().limit(max_levels + 1).collect()]
        if len(found) > max_levels:
            raise ValueError(f"{cluster}: more than {max_levels} levels")
        levels = sorted(x for x in found if x is not None)
    lv = list(levels)
    dummies = {f"{cluster}_{x}": (F.col(cluster) == F.lit(x)).cast("int") for x in (lv[1:] if drop_first else lv)}
    return j.withColumns(dummies).drop(cluster)


# ---- Cox proportional hazards --------------------------------------------------

def _grown(x: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums of log(x + i), 1 / (x + i) and 1 / (x + i)**2 over i = 0 .. d - 1,
    as differences of the log-gamma function and its derivatives (asymptotic series).
    Small x are first raised to 16 term by term, so the series hold to 1e-15, and the
    leading differences are written without cancellation."""
    x, d = x.astype(float).copy(), d.astype(float).copy()
    log, one, two = np.zeros(len(x)), np.zeros(len(x)), np.zeros(len(x))
    for _ in range(16):
        low = (x < 16) & (d > 0)
        if not low.any():
            break
        log[low] += np.log(x[low])
        one[low] += 1 / x[low]
        two[low] += 1 / x[low] ** 2
        x[low] += 1
        d[low] -= 1
    y = x + d

    def fall(f):
        return f(x) - f(y)
    more = d * np.log(x) - d + (y - 0.5) * np.log1p(d / x)
    log += np.where(d > 0, more - fall(lambda v: 1 / (12 * v) - 1 / (360 * v**3) + 1 / (1260 * v**5) - 1 / (1680 * v**7)), 0)
    one += np.where(d > 0, np.log1p(d / x) + d / (2 * x * y) + fall(lambda v: 1 / (12 * v**2) - 1 / (120 * v**4) + 1 / (252 * v**6) - 1 / (240 * v**8)), 0)
    two += np.where(d > 0, d / (x * y) + fall(lambda v: 1 / (2 * v**2) + 1 / (6 * v**3) - 1 / (30 * v**5) + 1 / (42 * v**7) - 1 / (30 * v**9)), 0)
    return log, one, two


def _efron_terms(dd: np.ndarray, xb: np.ndarray, x: np.ndarray, own: np.ndarray, risk: np.ndarray, p: int) -> np.ndarray:
    """Log-likelihood, gradient and information (upper triangle) summed over
    event times.  Columns of ``own`` (the events') and ``risk`` (all at risk): the
    sums of w, w z and w z z'.

    With d tied events, mean weight e = D0 / d and c = S0 / e, the denominators are e (c - l)
    for l = 0 .. d - 1, so their logs and inverse powers sum in closed form."""
    c = risk[:, 0] * dd / own[:, 0]
    log, one, two = _grown(np.maximum(c - dd + 1, 1.0), dd)
    v = own[:, 1:] / own[:, :1]
    u = (risk[:, 1:] - c[:, None] * own[:, 1:] / dd[:, None]) * (dd / own[:, 0])[:, None]
    up = np.triu_indices(p)
    u1, v1, u2, v2 = u[:, :p], v[:, :p], u[:, p:], v[:, p:]
    a, b = up
    info = u2 * one[:, None] + v2 * dd[:, None] - u1[:, a] * u1[:, b] * two[:, None] - (u1[:, a] * v1[:, b] + v1[:, a] * u1[:, b]) * one[:, None] - v1[:, a] * v1[:, b] * dd[:, None]
    ll = xb - dd * np.log(own[:, 0] / dd) - log
    grad = x - u1 * one[:, None] - v1 * dd[:, None]
    return np.concatenate([[ll.sum()], grad.sum(axis=0), info.sum(axis=0)])


def _time_blocks(d: DataFrame, blocks: int) -> DataFrame:
    """``d`` (__t, ...) with ``__block``, the number of its range of times."""
    probs = [i / blocks for i in range(1, blocks)]
    cuts = sorted(set(d.agg(F.percentile_approx("__t", probs, 10 * blocks)).first()[0] or [])) if blocks > 1 else []  # a bounded sketch
    return d.withColumn("__block", F.size(F.filter(F.lit(cuts).cast("array<double>"), lambda c: c < F.col("__t"))))


def _efron_step(d: DataFrame, cols: list[str], beta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Efron log partial likelihood, gradient and information at ``beta``.

    ``d`` (__t, __e, cols, and __block where ``_time_blocks`` has been called) is read twice: once for
    each block's sums, which say what is at risk after the block, and once for the rows of each time,
    which are walked from the last time to the first within the block."""
    p = len(cols)
    if "__block" not in d.columns:
        d = _time_blocks(d, 8)
    w = F.exp(sum((F.lit(float(b)) * F.col(c) for b, c in zip(beta, cols)), F.lit(0.0)))
    up = list(zip(*np.triu_indices(p)))
    moments = [F.col("w"), *[F.col("w") * F.col(c) for c in cols], *[F.col("w") * F.col(cols[a]) * F.col(cols[b]) for a, b in up]]
    k, rows = len(moments), d.withColumn("w", w)
    totals = rows.groupBy("__block").agg(F.array(*[F.sum(m) for m in moments]).alias("s")).collect()  # one row a block
    after, run_sum = {}, np.zeros(k)
    for r in sorted(totals, key=lambda r: -r["__block"]):
        after[r["__block"]] = run_sum
        run_sum = run_sum + np.array(r["s"], float)
    ev = F.col("__e") == 1
    none = F.lit(0.0)
    per_t = rows.groupBy("__block", "__t").agg(
        F.array(F.sum(F.col("__e").cast("double")), F.coalesce(F.sum(F.when(ev, F.log("w"))), none), *[F.coalesce(F.sum(F.when(ev, F.col(c))), none) for c in cols],
                *[F.coalesce(F.sum(F.when(ev, m)), none) for m in moments], *[F.sum(m) for m in moments]).alias("s"))
    size = 1 + p + len(up)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, total = None, None, np.zeros(size)
        for b in batches:
            if not b.num_rows:
                continue
            block = b.column(0).to_numpy(zero_copy_only=False)
            s = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            edge = np.flatnonzero(np.diff(block)) + 1
            for lo, hi in zip([0, *edge], [*edge, len(block)]):
                part = s[lo:hi]
                if block[lo] != at:
                    at, held = block[lo], after[int(block[lo])]
                risk = held + np.cumsum(part[:, 2 + p + k:], axis=0)
                held = risk[-1]
                hit = part[:, 0] > 0
                if hit.any():
                    q = part[hit]
                    total = total + _efron_terms(q[:, 0], q[:, 1], q[:, 2:2 + p], q[:, 2 + p:2 + p + k], risk[hit], p)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size), pa.int32()), pa.array(total)], ["cell", "v"])

    walked = per_t.repartition("__block").sortWithinPartitions("__block", F.desc("__t")).select("__block", "s").mapInArrow(walk, "cell int, v double")
    got = np.zeros(size)
    for r in walked.groupBy("cell").agg(F.sum("v").alias("v")).collect():  # 1 + p + p (p + 1) / 2 numbers
        got[r["cell"]] = r["v"]
    info = np.zeros((p, p))
    for (a, b), v in zip(up, got[1 + p:]):
        info[a, b] = info[b, a] = v
    return float(got[0]), got[1:1 + p], info


def cox_ph(df: DataFrame, duration: str, event: str, covariates: Sequence[str], penalizer: float = 0.1,
           max_steps: int = 30, tol: float = 1e-8) -> DataFrame:
    """V4: Cox proportional hazards, Efron ties, ridge penalty.

    Objective (our definition): Efron log partial likelihood on covariates
    standardised by mean and sample std, minus ``n * penalizer / 2 * |beta|^2``.
    Coefficients are reported on the original scale (beta / std) with
    standard errors from the penalised Hessian and two-sided normal p-values.
    The standardised rows are written once, by ranges of time; a Newton step reads
    them twice and shuffles one row a distinct time.
    Returns ``(covariate, coef, exp_coef, se, z, p)``.
    """
    cols = list(covariates)
    stats = df.agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"m_{c}") for c in cols],
                   *[F.stddev_samp(c).alias(f"s_{c}") for c in cols]).first()
    n = stats["n"]
    mean = np.array([stats[f"m_{c}"] for c in cols], dtype=float)
    std = np.array([stats[f"s_{c}"] or 1.0 for c in cols], dtype=float)
    std[std == 0] = 1.0
    z = [f"__z{i}" for i in range(len(cols))]
    d = materialize(df.select(F.col(duration).cast("double").alias("__t"), F.col(event).cast("int").alias("__e"),
                              *[((F.col(c) - mean[i]) / std[i]).alias(z[i]) for i, c in enumerate(cols)]))
    d = _time_blocks(d, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    beta = np.zeros(len(cols))
    for _ in range(max_steps):
        ll, g, H = _efron_step(d, z, beta)
        H = H + n * penalizer * np.eye(len(cols))
        step = np.linalg.solve(H, g - n * penalizer * beta)
        beta = beta + step
        if np.max(np.abs(step)) < tol:
            break
    _, g, H = _efron_step(d, z, beta)
    H = H + n * penalizer * np.eye(len(cols))
    cov = np.linalg.inv(H)
    se_std = np.sqrt(np.diag(cov))
    coef = beta / std
    se = se_std / std
    rows = []
    for i, c in enumerate(cols):
        zval = coef[i] / se[i] if se[i] > 0 else float("nan")
        pval = math.erfc(abs(zval) / math.sqrt(2.0)) if np.isfinite(zval) else float("nan")
        rows.append((c, float(coef[i]), float(math.exp(coef[i])), float(se[i]), float(zval), float(pval)))
    return df.sparkSession.createDataFrame(rows, "covariate string, coef double, exp_coef double, se double, z double, p double")


def breslow_survival(df: DataFrame, duration: str, event: str, covariates: Sequence[str], beta: Sequence[float],
                     profiles: Sequence[tuple[str, dict]]) -> DataFrame:
    """V5: predicted survival curves ``S(t | x) = exp(-H0(t) exp(beta.(x - mean)))``
    with the Breslow baseline ``H0(t) = sum_{u <= t} d_u / sum_{T_j >= u}
    exp(beta.(x_j - mean))``.  ``profiles`` are ``(name, {covariate: value})``
    rows; covariates not given take the column mean.  Returns
    ``(profile, t, survival)`` at every distinct event time."""
    cols = list(covariates)
    means = df.agg(*[F.avg(c).alias(c) for c in cols])
    mcols = {c: means.select(c).scalar() for c in cols}
    xb = sum((F.lit(float(b)) * (F.col(c) - mcols[c]) for b, c in zip(beta, cols)), F.lit(0.0))
    per_t = df.groupBy(F.col(duration).cast("double").alias("t")).agg(
        F.sum(F.col(event).cast("long")).alias("d"), F.sum(F.exp(xb)).alias("w"))
    rs = Wn.running_sum(per_t, [], ["t"], {"risk": F.col("w")}, descending=True)
    h = Wn.running_sum(rs.withColumn("__inc", F.when(F.col("d") > 0, F.col("d") / F.col("risk")).otherwise(0.0)),
                       [], ["t"], {"H0": F.col("__inc")}).where(F.col("d") > 0)
    prof = F.array(*[F.struct(F.lit(name).alias("profile"),
                              sum((F.lit(float(b)) * ((F.lit(float(vals[c])) if c in vals else mcols[c]) - mcols[c])
                                   for b, c in zip(beta, cols)), F.lit(0.0)).alias("xb"))
                     for name, vals in profiles])
    # profiles are a fixed short list: exploded onto every time row (no join)
    out = h.select("t", "H0", F.explode(prof).alias("p"))
    return out.select(F.col("p.profile").alias("profile"), "t",
                      F.exp(-F.col("H0") * F.exp(F.col("p.xb"))).alias("survival"))
