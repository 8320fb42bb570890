"""Models and tuning on Spark ML.

Trees and sparse logistic regression are Spark ML estimators; boosting and the
parameter search (sampled parameter maps, a fold column from F15) grow the trees of
Spark ML's estimators over packed rows.  Results (trials, importances, coefficients,
predictions) are DataFrames.
"""

from __future__ import annotations

import json
import random
from typing import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .boosting import BoostedTrees
from .forest_cv import Params, cross_validated_f1


def feature_stages(numeric: Sequence[str], categorical: Sequence[str] = (), one_hot: bool = False,
                   out: str = "features") -> tuple[list, list[str]]:
    """Indexers (unseen -> extra index) and an assembler; returns the
    stages and the slot names of the assembled vector."""
    stages, inputs, names = [], list(numeric), list(numeric)
    for c in categorical:
        stages.append(StringIndexer(inputCol=c, outputCol=f"{c}__idx", handleInvalid="keep",
                                    stringOrderType="alphabetAsc"))
        if one_hot:
            stages.append(OneHotEncoder(inputCol=f"{c}__idx", outputCol=f"{c}__ohe", dropLast=True))
            inputs.append(f"{c}__ohe")
        else:
            inputs.append(f"{c}__idx")
        names.append(c)
    stages.append(VectorAssembler(inputCols=inputs, outputCol=out, handleInvalid="keep"))
    return stages, names


def slot_names(df: DataFrame, vec_col: str = "features") -> list[str]:
    """Names of the vector slots from the column's ML attribute metadata."""
    meta = df.schema[vec_col].metadata.get("ml_attr", {})
    attrs = []
    for kind in ("numeric", "binary", "nominal"):
        attrs += meta.get("attrs", {}).get(kind, [])
    return [a["name"] for a in sorted(attrs, key=lambda a: a["idx"])]


def decision_tree(label: str, max_depth: int = 5, min_leaf: int = 1, min_info_gain: float = 0.0,
                  impurity: str = "gini", weight_col: str | None = None, feature_subset: str | None = None,
                  seed: int = 42, features: str = "features"):
    """M1.  ``feature_subset`` ('sqrt', 'log2', 'all') uses a one-tree forest
    without bootstrap, Spark's way to sample features per split.  The
    minimum split size and the random splitter have no Spark counterpart."""
    if feature_subset and feature_subset != "all":
        est = RandomForestClassifier(labelCol=label, featuresCol=features, numTrees=1, bootstrap=False,
                                     featureSubsetStrategy=feature_subset, maxDepth=max_depth,
                                     minInstancesPerNode=min_leaf, minInfoGain=min_info_gain,
                                     impurity=impurity, seed=seed)
    else:
        est = DecisionTreeClassifier(labelCol=label, featuresCol=features, maxDepth=max_depth,
                                     minInstancesPerNode=min_leaf, minInfoGain=min_info_gain,
                                     impurity=impurity, seed=seed)
    if weight_col:
        est.setWeightCol(weight_col)
    return est


# Search space of the tree tuner (fixed values of the studied configuration):
# depth 3-15, leaf 25-250, impurity decrease 0-0.01, criterion gini/entropy,
# class weight balanced/none, features a split sqrt/log2/all.
SEARCH_SPACE = {"max_depth": (3, 15), "min_leaf": (25, 250), "min_info_gain": (0.0, 0.01),
                "impurity": ["gini", "entropy"], "class_weight": ["balanced", None], "max_features": ["sqrt", "log2", "all"]}


def random_search_cv(df: DataFrame, label: str, fold_col: str, n_trials: int = 100, seed: int = 42, num_folds: int = 5,
                     balanced_weight_col: str = "weight", unit_weight_col: str = "unit_weight",
                     parallelism: int = 4, features: str = "features") -> tuple[DataFrame, object]:
    """M2: random draws from ``SEARCH_SPACE`` as parameter maps, k-fold
    cross-validated F1 of the positive class (folds from ``fold_col``).
    ``df`` must hold the assembled features, the balanced weight column
    (F14) and a unit weight column.  The tree is a one-tree forest without
    bootstrap, as features are sampled per split.  All trees of the cross-validation are
    grown together (``forest_cv``); ``CrossValidator`` takes labels other than 0 and 1 and
    weights that vary by row.  Returns ``(trials, best_model)``."""
    rng = random.Random(seed)
    dt = RandomForestClassifier(labelCol=label, featuresCol=features, numTrees=1, bootstrap=False, seed=seed)
    maps, trials = [], []
    for t in range(n_trials):
        p = {"max_depth": rng.randint(*SEARCH_SPACE["max_depth"]),
             "min_leaf": rng.randint(*SEARCH_SPACE["min_leaf"]),
             "min_info_gain": rng.uniform(*SEARCH_SPACE["min_info_gain"]),
             "impurity": rng.choice(SEARCH_SPACE["impurity"]),
             "class_weight": rng.choice(SEARCH_SPACE["class_weight"]),
             "max_features": rng.choice(SEARCH_SPACE["max_features"])}
        trials.append(p)
        maps.append({dt.maxDepth: p["max_depth"], dt.minInstancesPerNode: p["min_leaf"],
                     dt.minInfoGain: p["min_info_gain"], dt.impurity: p["impurity"],
                     dt.featureSubsetStrategy: p["max_features"],
                     dt.weightCol: balanced_weight_col if p["class_weight"] else unit_weight_col})
    params = [Params(p["max_depth"], p["min_leaf"], p["min_info_gain"], p["impurity"],
                     balanced_weight_col if p["class_weight"] else unit_weight_col, p["max_features"]) for p in trials]
    scores = cross_validated_f1(df, features, label, fold_col, params, num_folds, seed)
    if scores is None:
        ev = MulticlassClassificationEvaluator(labelCol=label, metricName="fMeasureByLabel", metricLabel=1.0)
        cv = CrossValidator(estimator=dt, estimatorParamMaps=maps, evaluator=ev, foldCol=fold_col, numFolds=num_folds,
                            parallelism=parallelism, seed=seed).fit(df)
        means, best = cv.avgMetrics, cv.bestModel
    else:
        means = scores.mean(axis=0)
        best = dt.fit(df, maps[int(means.argmax())])
    rows = [(i, json.dumps(p, sort_keys=True), float(m)) for i, (p, m) in enumerate(zip(trials, means))]
    out = df.sparkSession.createDataFrame(rows, "trial int, params string, cv_f1 double")
    return out, best.trees[0].setFeaturesCol(features)


def importance_table(model, names: Sequence[str], top_n: int | None = None) -> DataFrame:
    """M8: ``(feature, importance)`` sorted descending (top n)."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    imp = model.featureImportances.toArray()
    rows = sorted(zip(names, [float(x) for x in imp]), key=lambda t: (-t[1], t[0]))
    if top_n:
        rows = rows[:top_n]
    return spark.createDataFrame(rows, "feature string, importance double")


FOREST_ROWS = 250_000  # rows a partition of a forest's input


def spread(df: DataFrame, rows: int = FOREST_ROWS) -> DataFrame:
    """``df`` in partitions of about ``rows`` rows, where it has fewer partitions than
    that takes.  A forest keeps the draws of all its trees beside each row (about
    700 bytes for 100 trees), so a task's share must not grow with the table."""
    parts = -(-df.count() // rows)
    return df.repartition(parts) if parts > df.rdd.getNumPartitions() else df


def random_forest(label: str, num_trees: int = 100, seed: int = 42, features: str = "features"):
    """M3."""
    return RandomForestClassifier(labelCol=label, featuresCol=features, numTrees=num_trees, seed=seed)


def gbt_regressor(label: str, max_iter: int = 400, max_depth: int = 5, step_size: float = 0.05,
                  subsampling_rate: float = 0.9, seed: int = 42, features: str = "features") -> BoostedTrees:
    """M4: gradient-boosted trees on an ordinal target: what Spark ML's estimator fits, over packed rows."""
    return BoostedTrees(GBTRegressor(labelCol=label, featuresCol=features, maxIter=max_iter, maxDepth=max_depth,
                                     stepSize=step_size, subsamplingRate=subsampling_rate, seed=seed))


def l1_logistic(label: str, C: float, n_rows: int, features: str = "features"):
    """M5: multinomial logistic regression with an L1 penalty; the inverse
    strength C maps to ``regParam = 1 / (C n)`` (per-row loss scaling)."""
    return LogisticRegression(labelCol=label, featuresCol=features, family="multinomial", elasticNetParam=1.0,
                              regParam=1.0 / (C * n_rows), standardization=False, maxIter=5000)


def coefficient_table(model, names: Sequence[str]) -> DataFrame:
    """M7: ``(class, feature, coef)`` from a fitted logistic model."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    m = model.coefficientMatrix.toArray()
    rows = [(int(k), names[j] if j < len(names) else f"f{j}", float(m[k, j]))
            for k in range(m.shape[0]) for j in range(m.shape[1])]
    return spark.createDataFrame(rows, "class int, feature string, coef double")


def sparsity(coefs: DataFrame) -> DataFrame:
    """M7: non-zero coefficients over all coefficients."""
    return coefs.agg(F.count_if(F.col("coef") != 0).alias("nonzero"), F.count(F.lit(1)).alias("total")) \
                .withColumn("nonzero_share", F.col("nonzero") / F.col("total"))


def save_model(model, spark, meta: dict, path: str | None = None) -> str:
    """Write the model and a one-row JSON metadata table next to it
    (under the shared checkpoint folder unless a path is given)."""
    path = path or scratch_path(spark, "model")
    model.write().overwrite().save(f"{path}/model")
    spark.createDataFrame([(json.dumps(meta, sort_keys=True),)], "meta string").coalesce(1) \
         .write.mode("overwrite").json(f"{path}/meta")
    return path


def load_model(spark, path: str, kind):
    """Load a model saved by ``save_model`` and its metadata dict."""
    model = kind.load(f"{path}/model")
    meta = json.loads(spark.read.json(f"{path}/meta").first()["meta"])
    return model, meta


def tree_nodes(spark, model) -> DataFrame:
    """The fitted tree's node table, read back from its saved form:
    ``(id, prediction, impurity, impurityStats, rawCount, gain, leftChild,
    rightChild, split)``."""
    path = scratch_path(spark, "tree")
    model.write().overwrite().save(path)
    return spark.read.parquet(f"{path}/data")


def tree_shape(nodes: DataFrame, n_features: int) -> DataFrame:
    """Leaves, nodes, depth (from the node table) and features used."""
    from .rules import node_paths
    used = F.countDistinct(F.when(F.col("leftChild") != -1, F.col("split.featureIndex")))
    return node_paths(nodes).agg(F.count_if(F.col("leftChild") == -1).alias("n_leaves"), F.count(F.lit(1)).alias("n_nodes"),
                                 F.max("depth").alias("depth"), used.cast("int").alias("n_features_used")) \
                            .withColumn("n_features_in", F.lit(n_features))
