"""Feature-group ablation.

Groups and experiments are small tables; an experiment's feature list is
a join of the two, always intersected with the columns that exist.  Each
experiment refits the tree with fixed (baseline) parameters on a slice of
one cached, assembled feature frame; results are long tables.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.ml.feature import VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .evaluate import binary_metrics, roc_auc
from .linkage import compare_counts
from .models import decision_tree
from .stats import mcnemar_of_counts


def group_table(spark: SparkSession, groups: Mapping[str, tuple[Sequence[str], str]]) -> DataFrame:
    """B1: ``(group, feature, category)`` from ``{group: (features, category)}``;
    data-driven groups are added by passing more entries."""
    rows = [(g, f, cat) for g, (feats, cat) in groups.items() for f in feats]
    return spark.createDataFrame(rows, "group string, feature string, category string")


def experiment_list(spark: SparkSession, groups: DataFrame, strategic: Mapping[str, tuple[str, Sequence[str]]],
                    leave_one_out: bool = True) -> DataFrame:
    """``(experiment, mode, group)``: the baseline, the strategic
    experiments (``{name: (include|exclude, groups)}``) and one
    ``without_<group>`` per group."""
    base = spark.createDataFrame([("baseline", "all", None)], "experiment string, mode string, group string")
    strat = spark.createDataFrame([(n, m, g) for n, (m, gs) in strategic.items() for g in gs],
                                  "experiment string, mode string, group string")
    out = base.unionByName(strat)
    if leave_one_out:
        loo = groups.select("group").distinct().select(F.concat(F.lit("without_"), "group").alias("experiment"),
                                                         F.lit("exclude").alias("mode"), "group")
        out = out.unionByName(loo)
    return out


def experiment_features(experiments: DataFrame, groups: DataFrame, available: Sequence[str]) -> DataFrame:
    """B2: ``(experiment, feature)``: ``all`` -> every available feature,
    ``include`` -> the features of the listed groups, ``exclude`` -> every
    available feature outside the listed groups; always intersected with
    the available columns."""
    avail = F.array(*[F.lit(c) for c in available])
    exps = experiments.select("experiment", "mode").distinct()
    inc = experiments.where(F.col("mode") == "include").join(groups, "group").select("experiment", "feature")
    every = exps.where(F.col("mode").isin("all", "exclude")).select("experiment", F.explode(avail).alias("feature"))
    excl = experiments.where(F.col("mode") == "exclude").join(groups, "group").select("experiment", "feature")
    kept = every.join(excl, ["experiment", "feature"], "left_anti")
    return inc.where(F.col("feature").isin(list(available))).unionByName(kept).distinct()


def run_ablation(train: DataFrame, test: DataFrame, features: Sequence[str], label: str,
                 exp_features: DataFrame, params: Mapping, key: str) -> tuple[DataFrame, DataFrame]:
    """For every experiment fit the tree with the baseline
    parameters on its feature slice, evaluate on ``test`` (E1), compare with
    the baseline predictions (J10 + McNemar, T9) and keep importances.
    The test rows are scored by all trees in one pass, and one job each counts
    the metrics, areas and pairs of all experiments.
    A failing experiment becomes a row with its error.  Returns
    ``(results (experiment, metric, value, error), importances)``."""
    spark = train.sparkSession
    asm = VectorAssembler(inputCols=list(features), outputCol="__all", handleInvalid="keep")
    tr = asm.transform(train).select(label, "__all").cache()
    lists = {}
    for row in exp_features.groupBy("experiment").agg(F.collect_list("feature").alias("f")).collect():
        lists[row["experiment"]] = [f for f in features if f in set(row["f"])]  # one row per experiment
    results, imps, fitted = [], [], {}
    order = ["baseline"] + sorted(e for e in lists if e != "baseline")
    try:
        for exp in order:
            feats = lists.get(exp, [])
            try:
                if not feats:
                    raise ValueError("no features")
                sl = VectorSlicer(inputCol="__all", outputCol="features", indices=[list(features).index(f) for f in feats])
                fitted[exp] = sl, decision_tree(label, **params).fit(sl.transform(tr))
            except Exception as e:  # an experiment error is a result row
                results.append((exp, "error", None, str(e)[:500]))
    finally:
        tr.unpersist()
    try:
        found = _evaluated(asm.transform(test).select(key, label, "__all"), fitted, label, key) if fitted else {}
    except Exception as e:
        found, results = {}, results + [(exp, "error", None, str(e)[:500]) for exp in fitted]
    for exp, vals in found.items():
        model, feats = fitted[exp][1], lists[exp]
        vals.update({"tree_leaves": float((model.numNodes + 1) // 2), "n_features": float(len(feats)), "tree_depth": float(model.depth),
                     "tree_nodes": float(model.numNodes)})
        results += [(exp, k, v, None) for k, v in vals.items()]
        imps += [(exp, f, float(v)) for f, v in zip(feats, model.featureImportances.toArray())]
    res = spark.createDataFrame(results, "experiment string, metric string, value double, error string")
    imp = spark.createDataFrame(imps, "experiment string, feature string, importance double")
    return res, imp


def _evaluated(test: DataFrame, fitted: Mapping, label: str, key: str) -> dict[str, dict]:
    """Per experiment its metrics; the first one is what the others are compared with."""
    wide, kept = test, [key, label, "__all"]
    for i, (sl, model) in enumerate(fitted.values()):
        wide = model.transform(sl.transform(wide)).select(*kept, F.col("prediction").cast("int").alias(f"__pred{i}"),
                                                          vector_to_array("probability")[1].alias(f"__score{i}"))
        kept += [f"__pred{i}", f"__score{i}"]
    wide = materialize(wide.drop("__all"))
    long = wide.select(label, F.inline(F.array(*[F.struct(F.lit(e).alias("experiment"), F.col(f"__pred{i}").alias("pred"),
                                                          F.col(f"__score{i}").alias("score")) for i, e in enumerate(fitted)])))
    found = {r["experiment"]: r for r in binary_metrics(long, label, "pred", group_cols=["experiment"]).collect()}  # one row an experiment
    one = next(iter(found.values()), None)
    if one is None:                                  # no test rows
        raise ValueError("no rows to evaluate")
    both = one["tp"] + one["fn"] > 0 and one["fp"] + one["tn"] > 0     # no area where a class is absent
    auc = {r["experiment"]: r["roc_auc"] for r in roc_auc(long, label, "score", group_cols=["experiment"]).collect()} if both else {}
    first, *others = fitted
    classes = list(range(max(model.numClasses for _, model in fitted.values())))
    tests = {}
    if others:
        columns = {e: f"__pred{i}" for i, e in enumerate(fitted) if e != first}
        counts = compare_counts(wide, key, label, "__pred0", columns, classes)
        tests = {r["variant"]: r for r in mcnemar_of_counts(counts).collect()}
    out = {}
    for exp in fitted:
        mc = tests[exp] if exp in tests else {"statistic": 0.0, "p_value": 1.0}
        out[exp] = {k: float(found[exp][k]) for k in ("accuracy", "precision", "recall", "f1")}
        out[exp].update({"roc_auc": float(auc[exp]) if both else None, "mcnemar_statistic": float(mc["statistic"]), "mcnemar_p": float(mc["p_value"])})
    return out


def comparison(results: DataFrame) -> DataFrame:
    """E9 for ablation: one row per experiment with f1 / accuracy / ROC-AUC and their
    deltas from the baseline, McNemar p and a significance mark."""
    w = results.where(F.col("error").isNull()).groupBy("experiment").pivot(
        "metric", ["accuracy", "precision", "recall", "f1", "roc_auc", "n_features", "tree_depth", "tree_leaves", "mcnemar_p"]).agg(F.first("value"))
    base = w.where(F.col("experiment") == "baseline").select(F.col("f1").alias("__bf1"), F.col("accuracy").alias("__bacc"), F.col("roc_auc").alias("__bauc"))
    j = w.withColumn("__bf1", base.select("__bf1").scalar()).withColumn("__bacc", base.select("__bacc").scalar()).withColumn("__bauc", base.select("__bauc").scalar())
    return j.select("*", (F.col("f1") - F.col("__bf1")).alias("f1_delta"),
                    (F.col("accuracy") - F.col("__bacc")).alias("accuracy_delta"),
                    (F.col("roc_auc") - F.col("__bauc")).alias("roc_auc_delta"),
                    F.when(F.col("mcnemar_p") < 0.05, "***").otherwise("").alias("significant")).drop("__bf1", "__bacc", "__bauc")


def importance_shift(imps: DataFrame, top_n: int = 20, baseline: str = "baseline") -> DataFrame:
    """The baseline's top n features x every experiment, importance 0
    where an experiment lacks the feature."""
    top = imps.where(F.col("experiment") == baseline).orderBy(F.col("importance").desc(), F.col("feature")) \
              .limit(top_n).select("feature")
    exps = imps.select(F.collect_set("experiment")).scalar()
    grid = top.select("feature", F.explode(exps).alias("experiment"))
    return grid.join(imps, ["experiment", "feature"], "left") \
               .select("experiment", "feature", F.coalesce("importance", F.lit(0.0)).alias("importance"))


def highlights(comp: DataFrame, drops: int = 3) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Best experiment by f1, significant ones, the largest f1 drops."""
    best = comp.orderBy(F.col("f1").desc(), F.col("experiment")).limit(1)
    sig = comp.where(F.col("significant") == "***")
    worst = comp.where(F.col("experiment") != "baseline").orderBy(F.col("f1_delta").asc(), F.col("experiment")).limit(drops)
    return best, sig, worst


def shared_top_features(imps: DataFrame, a: str, b: str, n: int = 10) -> DataFrame:
    """Features in both experiments' top n, with both importances."""
    def top(e):
        return imps.where(F.col("experiment") == e).orderBy(F.col("importance").desc(), F.col("feature")).limit(n) \
                   .select("feature", F.col("importance").alias(f"importance_{e}"))
    return top(a).join(top(b), "feature")
