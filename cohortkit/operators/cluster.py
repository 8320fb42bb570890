"""Clustering and projection."""

from __future__ import annotations

from typing import Sequence

import numpy as np
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vectors as V
from ..session import materialize
from .groups import davies_bouldin, silhouette_sq
from .kmeans import fit_many


def _vec(df: DataFrame, vec: str) -> DataFrame:
    return df.withColumn("__features", array_to_vector(V.to_double_array(vec)))


def kmeans_fit(df: DataFrame, vec: str, k: int, seed: int = 42, n_init: int = 10, out: str = "cluster"):
    """``n_init`` seeds fitted together; the fit with the lowest cost
    wins.  Returns ``(assigned frame, model, cost)``."""
    best = min(fit_many(df, vec, [(k, seed + s) for s in range(n_init)]), key=lambda f: f.cost)
    return best.transform(df, vec, out), best, best.cost


def elbow(df: DataFrame, vec: str, ks: Sequence[int] = range(1, 16), seed: int = 99) -> DataFrame:
    """Within-cluster sum of squares for each k, all fitted together."""
    rows = [(f.k, f.cost) for f in fit_many(df, vec, [(int(k), seed) for k in ks])]
    return df.sparkSession.createDataFrame(rows, "k int, inertia double")


def select_k(df: DataFrame, vec: str, ks: Sequence[int] = range(2, 8), seed: int = 42, n_init: int = 1) -> DataFrame:
    """Per k the inertia, silhouette (squared Euclidean, exact) and
    Davies-Bouldin of its best fit, all k and seeds fitted together; ``best``
    marks the k with the highest silhouette."""
    fits = fit_many(df, vec, [(int(k), seed + s) for k in ks for s in range(n_init)])
    rows = []
    for k in ks:
        fit = min((f for f in fits if f.k == k), key=lambda f: f.cost)
        a = materialize(fit.transform(df, vec))
        _, sil = silhouette_sq(a, vec, "cluster")
        db = davies_bouldin(a, vec, "cluster")
        rows.append((int(k), fit.cost, float(sil.first()["silhouette"]), float(db.first()["davies_bouldin"])))
    best = max(rows, key=lambda r: (r[2], -r[0]))[0]
    return df.sparkSession.createDataFrame([r + (r[0] == best,) for r in rows],
                                           "k int, inertia double, silhouette double, davies_bouldin double, best boolean")


def pca_fit(df: DataFrame, vec: str, k: int = 2):
    """PCA after centring (Spark's PCA does not centre).  Components get
    a fixed sign: the largest-magnitude loading is positive.  Returns
    ``(model-like dict, explained ratio frame, loadings frame)``."""
    d = _vec(df, vec)
    mean = d.agg(Summarizer.mean(F.col("__features")).alias("m")).first()["m"].toArray()
    c = d.withColumn("__c", array_to_vector(F.zip_with(vector_to_array("__features"),
                                                        F.array(*[F.lit(float(x)) for x in mean]), lambda a, b: a - b)))
    model = PCA(k=k, inputCol="__c", outputCol="__pc").fit(c)
    pc = model.pc.toArray()
    signs = np.sign(pc[np.argmax(np.abs(pc), axis=0), range(pc.shape[1])])
    signs[signs == 0] = 1
    pc = pc * signs
    spark = df.sparkSession
    ratio = spark.createDataFrame([(i + 1, float(v)) for i, v in enumerate(model.explainedVariance.toArray())],
                                  "component int, explained_variance_ratio double")
    load = spark.createDataFrame([(i + 1, j, float(pc[j, i])) for i in range(k) for j in range(pc.shape[0])],
                                 "component int, dim int, loading double")
    return {"mean": mean, "components": pc}, ratio, load


def pca_transform(df: DataFrame, vec: str, fit: dict, out: str = "pcs") -> DataFrame:
    """Project rows (or centres) onto the fitted components."""
    mean, pc = fit["mean"], fit["components"]
    x = F.zip_with(V.to_double_array(vec), F.array(*[F.lit(float(m)) for m in mean]), lambda a, b: a - b)
    comps = [V.dot(x, F.array(*[F.lit(float(v)) for v in pc[:, i]])) for i in range(pc.shape[1])]
    return df.withColumn(out, F.array(*comps))


def pca_vs_original(df: DataFrame, vec: str, k: int, n_components: int = 2, seed: int = 42, key: str = "id") -> DataFrame:
    """C11: k-means on the PCA projection vs on the original vectors;
    returns the cross-tab of the two labelings."""
    fit, _, _ = pca_fit(df, vec, n_components)
    p = pca_transform(df, vec, fit)
    a, _, _ = kmeans_fit(p, "pcs", k, seed, 1, out="cluster_pca")
    b, _, _ = kmeans_fit(df.select(key, vec), vec, k, seed, 1, out="cluster_orig")
    j = a.select(key, "cluster_pca").join(b.select(key, "cluster_orig"), key)
    return j.groupBy("cluster_pca", "cluster_orig").agg(F.count(F.lit(1)).alias("count"))
