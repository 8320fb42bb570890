"""Parameter search over trees by racing (M2).

All configurations of a generation grow their trees in the same scans (see
``tree.grow``), fold step by fold step.  A configuration leaves the race as
soon as its mean over the folds it has seen lies more than ``margin`` below
the best mean of any trial over those folds.  Later generations are proposed by a
regression forest fitted on the trials so far, with a share of plain draws.
"""

from __future__ import annotations

import json
import random
from typing import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession

from .tree import Binned, Forest, TreeSpec, grow

# The search space of the studied configuration.
SPACE = {
    "max_depth": (3, 15),
    "min_split": (50, 500),
    "min_leaf": (25, 250),
    "min_decrease": (0.0, 0.01),
    "criterion": ["gini", "entropy"],
    "splitter": ["best", "random"],
    "max_features": ["sqrt", "log2", None],
    "class_weight": ["balanced", None],
}


def draw(rng: random.Random) -> dict:
    """One configuration, every axis uniform."""
    def one(axis):
        if isinstance(axis, list):
            return rng.choice(axis)
        return rng.uniform(*axis) if isinstance(axis[0], float) else rng.randint(*axis)
    return {name: one(axis) for name, axis in SPACE.items()}


def _slots(p: dict) -> list[float]:
    return [float(SPACE[k].index(v)) if isinstance(SPACE[k], list) else float(v) for k, v in p.items()]


def _propose(spark: SparkSession, trials: list[dict], count: int, rng: random.Random, pool: int) -> list[dict]:
    """A fifth of plain draws; the rest are the best of ``pool`` draws by the
    forest's prediction (the table is the trials, at most a few hundred rows)."""
    plain = max(1, count // 5)
    cols = list(SPACE)
    asm = VectorAssembler(inputCols=cols, outputCol="x")
    schema = ", ".join(f"{c} double" for c in cols)
    past = spark.createDataFrame([(*_slots(t["params"]), t["mean"]) for t in trials], schema + ", y double")
    model = RandomForestRegressor(featuresCol="x", labelCol="y", numTrees=20, seed=rng.randint(0, 2 ** 31)).fit(asm.transform(past))
    drawn = [draw(rng) for _ in range(pool)]
    scored = model.transform(asm.transform(spark.createDataFrame([(i, *_slots(p)) for i, p in enumerate(drawn)], "i int, " + schema)))
    order = sorted((-r["prediction"], r["i"]) for r in scored.select("i", "prediction").collect())
    return [drawn[i] for _, i in order[:count - plain]] + [draw(rng) for _ in range(plain)]


def _f1(tp: int, fp: int, fn: int) -> float:
    return 2 * tp / (2 * tp + fp + fn) if tp else 0.0


def racing_search(binned: Binned, n_trials: int = 100, folds: int = 5, generations: Sequence[int] | None = None,
                  steps: Sequence[int] = (1, 1, 3), margin: float = 0.02, seed: int = 42, pool: int = 400) -> tuple[DataFrame, Forest | None]:
    """``(trials, best)``: one row a trial (trial, generation, params, cv_f1 =
    mean F1 of the positive class over the folds used, folds_used, best) and
    the best configuration's tree on all rows.  Best is the highest mean
    among the trials that ran on every fold, the earliest of equal ones.
    ``steps`` are the folds added at a time.  Without rows every F1 is 0."""
    if sum(steps) != folds:
        raise ValueError("steps must add up to the folds")
    spark, rng = binned.rows.sparkSession, random.Random(seed)
    generations = list(generations or (n_trials - 3 * (n_trials // 5), *[n_trials // 5] * 3))
    if sum(generations) != n_trials:
        raise ValueError("generations must add up to the trials")
    trials: list[dict] = []
    for g, size in enumerate(generations):
        if size == 0:
            continue
        params = [draw(rng) for _ in range(size)] if not trials else _propose(spark, trials, size, rng, pool)
        fresh = [{"params": p, "generation": g, "f1": []} for p in params]
        trials += fresh
        racing, used = fresh, 0
        for step in steps:
            specs = [TreeSpec(**t["params"], fold=f, seed=seed) for t in racing for f in range(used, used + step)]
            counts = grow(binned, specs).held_out_counts()
            for i, t in enumerate(racing):
                t["f1"] += [_f1(*counts.get(i * step + j, (0, 0, 0))) for j in range(step)]
            used += step
            best = max(sum(t["f1"][:used]) / used for t in trials if len(t["f1"]) >= used)
            racing = [t for t in racing if sum(t["f1"]) / used >= best - margin]
            if not racing:
                break
        for t in fresh:
            t["mean"] = sum(t["f1"]) / len(t["f1"])
    whole = [i for i, t in enumerate(trials) if len(t["f1"]) == folds]
    top = max(whole, key=lambda i: (trials[i]["mean"], -i)) if whole else None
    rows = [(i, t["generation"], json.dumps(t["params"], sort_keys=True), t["mean"], len(t["f1"]), i == top) for i, t in enumerate(trials)]
    table = spark.createDataFrame(rows, "trial int, generation int, params string, cv_f1 double, folds_used int, best boolean")
    return table, None if top is None else grow(binned, [TreeSpec(**trials[top]["params"], seed=seed)])
