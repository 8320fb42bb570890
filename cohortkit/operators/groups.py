"""Group profiles and cluster quality on vectors.

Vectors are ``array<double>`` columns.  Per-cluster summaries (size, mean
vector, mean squared norm) are aggregated with Spark ML's ``Summarizer``
(no per-element explode) and, being ``k`` rows of ``d`` numbers, are handed
to the row expressions as one array through a scalar subquery.  No pair of
data rows is ever formed: the silhouette uses squared Euclidean distances,
whose per-cluster means follow from the summaries (the linear form Spark's
``ClusteringEvaluator`` uses).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vectors as V
from ..functions.quantiles import exact_quantiles
from ..session import broadcast_if_small
from .profile import long_values, with_share


# ---- group profiles (A18-A20) ---------------------------------------------

def group_mean_std(df: DataFrame, features: Sequence[str], cluster: str, ddof: int = 1) -> DataFrame:
    """Mean and std (ddof 1 = sample, 0 = population, N10) of each
    feature per cluster, long form."""
    lv = long_values(df, features, [cluster], as_double=True)
    sd = F.stddev_samp("value") if ddof == 1 else F.stddev_pop("value")
    return lv.groupBy(cluster, "variable").agg(F.avg("value").alias("mean"), sd.alias("std"),
                                             F.count("value").alias("n"))


def group_category_shares(df: DataFrame, cols: Sequence[str], cluster: str) -> DataFrame:
    """Share of every level of every column within each cluster, over
    all levels seen anywhere (0 when a cluster lacks a level).  Shares are
    of the non-null values in the cluster (``value_counts(normalize=True)``)."""
    lv = long_values(df, cols, [cluster]).where(F.col("value").isNotNull())
    counts = lv.groupBy(cluster, "variable", "value").agg(F.count(F.lit(1)).alias("n"))
    denom = counts.groupBy(cluster, "variable").agg(F.sum("n").alias("denom"))
    levels = counts.select("variable", "value").distinct()
    clusters = df.select(F.collect_set(cluster)).scalar()  # k values: bounded
    grid = levels.select("variable", "value", F.explode(clusters).alias(cluster))
    g = grid.join(counts, [cluster, "variable", "value"], "left").join(denom, [cluster, "variable"], "left")
    return g.select(cluster, "variable", "value",
                    F.coalesce(F.col("n") / F.col("denom"), F.lit(0.0)).alias("share"))


def compare_named_clusters(profile: DataFrame, cluster: str, names: Sequence) -> DataFrame:
    """The profile rows of the named clusters only."""
    return profile.where(F.col(cluster).isin(list(names)))


# ---- cluster summaries -------------------------------------------------------

def cluster_summaries(df: DataFrame, vec: str, cluster: str) -> DataFrame:
    """``(cluster, n, centroid array, mean_sq_norm)`` per cluster."""
    d = df.select(cluster, array_to_vector(V.to_double_array(vec)).alias("__v"),
                  V.norm2(vec).alias("__q"))
    s = d.groupBy(cluster).agg(Summarizer.mean(F.col("__v")).alias("__m"),
                               F.count(F.lit(1)).alias("n"), F.avg("__q").alias("mean_sq_norm"))
    return s.select(cluster, "n", vector_to_array("__m").alias("centroid"), "mean_sq_norm")


def _summary_array(summ: DataFrame, cluster: str) -> Column:
    """All k summaries as one sorted array (scalar subquery; k x d values)."""
    return summ.select(F.array_sort(F.collect_list(F.struct(
        F.col(cluster).alias("c"), F.col("n").alias("n"), F.col("centroid").alias("m"),
        F.col("mean_sq_norm").alias("q"))))).scalar()


def assign_nearest(df: DataFrame, vec: str, centres: DataFrame, centre_id: str = "cluster",
                   centre_vec: str = "centroid", out: str = "cluster") -> DataFrame:
    """C4: nearest centre (squared Euclidean, ties to the smaller id) and the
    squared distance to it.  Centres are ``k`` rows, passed as one array."""
    arr = centres.select(F.array_sort(F.collect_list(F.struct(
        F.col(centre_id).alias("c"), V.to_double_array(centre_vec).alias("m"))))).scalar()
    # the subquery is projected first: higher-order functions take columns only
    d = df.withColumn("__arr", arr).withColumn("__d", F.transform("__arr", lambda s: F.struct(V.sqdist(vec, s["m"]).alias("d"), s["c"].alias("c"))))
    best = F.array_min("__d")
    return d.withColumn(out, best["c"]).withColumn("dist2", best["d"]).drop("__d", "__arr")


def inertia(assigned: DataFrame, dist_col: str = "dist2") -> DataFrame:
    """C4: sum of squared distances to the assigned centre."""
    return assigned.agg(F.sum(dist_col).alias("inertia"), F.count(F.lit(1)).alias("n"))


def cluster_sizes(df: DataFrame, cluster: str) -> DataFrame:
    """Size and share of each cluster."""
    return with_share(df.groupBy(cluster).agg(F.count(F.lit(1)).alias("count")))


def silhouette_sq(df: DataFrame, vec: str, cluster: str, key: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Silhouette with squared Euclidean distance, exact, linear cost.

    For x in cluster A the mean squared distance to cluster C is
    ``|x|^2 - 2 x.mu_C + q_C``; a = that mean over A scaled by n_A/(n_A-1)
    (self excluded), b = the smallest mean over the other clusters,
    s = (b - a) / max(a, b), 0 for singletons.  Returns per-row scores and
    the mean.
    """
    summ = cluster_summaries(df, vec, cluster)
    arr = _summary_array(summ, cluster)
    x2 = V.norm2(vec)
    d = df.withColumn("__x2", x2).withColumn("__arr", arr).withColumn(
        "__m", F.transform("__arr", lambda s: F.struct(
            s["c"].alias("c"), s["n"].alias("n"),
            (F.col("__x2") - 2 * V.dot(vec, s["m"]) + s["q"]).alias("d"))))
    own = F.filter("__m", lambda s: s["c"] == F.col(cluster))[0]
    others = F.filter("__m", lambda s: s["c"] != F.col(cluster))
    a = own["d"] * own["n"] / (own["n"] - 1)
    b = F.array_min(F.transform(others, lambda s: s["d"]))
    s = F.when((own["n"] <= 1) | b.isNull(), F.lit(0.0)).otherwise((b - a) / F.greatest(a, b))
    rows = d.withColumn("silhouette", s).drop("__x2", "__m", "__arr")
    mean = rows.agg(F.avg("silhouette").alias("silhouette"), F.count(F.lit(1)).alias("n"))
    return rows, mean


def davies_bouldin(df: DataFrame, vec: str, cluster: str) -> DataFrame:
    """``avg_i max_{j != i} (S_i + S_j) / M_ij`` with S_i the mean
    Euclidean distance to the own centroid and M_ij centroid distances."""
    summ = cluster_summaries(df, vec, cluster)
    cent = summ.select(F.map_from_entries(F.collect_list(F.struct(cluster, "centroid")))).scalar()
    spread = (df.select(cluster, vec, cent.alias("__cent"))
                .select(cluster, F.sqrt(V.sqdist(vec, F.element_at("__cent", F.col(cluster)))).alias("__dist"))
                .groupBy(cluster).agg(F.avg("__dist").alias("S")))
    s = spread.join(summ, cluster)
    arr = s.select(F.collect_list(F.struct(F.col(cluster).alias("c"), F.col("S").alias("S"),
                                           F.col("centroid").alias("m")))).scalar()
    per = s.withColumn("__arr", arr).withColumn("__r", F.array_max(F.transform(
        F.filter("__arr", lambda o: o["c"] != F.col(cluster)),
        lambda o: (F.col("S") + o["S"]) / F.sqrt(V.sqdist("centroid", o["m"])))))
    return per.agg(F.avg("__r").alias("davies_bouldin"), F.count(F.lit(1)).alias("k"))


def calinski_harabasz(df: DataFrame, vec: str, cluster: str) -> DataFrame:
    """``(B / (k - 1)) / (W / (n - k))``; W from the summaries
    (``sum |x|^2 - n_i |mu_i|^2``), B = ``sum n_i |mu_i - mu|^2``."""
    summ = cluster_summaries(df, vec, cluster)
    d = df.select(array_to_vector(V.to_double_array(vec)).alias("__v"))
    glob = vector_to_array(d.agg(Summarizer.mean(F.col("__v"))).scalar())
    per = summ.withColumn("__g", glob).select(
        "n", (F.col("n") * F.col("mean_sq_norm") - F.col("n") * V.norm2("centroid")).alias("w"),
        (F.col("n") * V.sqdist("centroid", "__g")).alias("b"))
    t = per.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"), F.sum("w").alias("W"), F.sum("b").alias("B"))
    return t.withColumn("calinski_harabasz",
                        (F.col("B") / (F.col("k") - 1)) / (F.col("W") / (F.col("n") - F.col("k"))))


def inliers(df: DataFrame, vec: str, cluster: str, pct: float = 90.0) -> DataFrame:
    """Rows whose Euclidean distance to the own class centroid is at
    most the class's ``pct`` percentile (linear) of those distances."""
    summ = cluster_summaries(df, vec, cluster)
    cent = summ.select(F.map_from_entries(F.collect_list(F.struct(cluster, "centroid")))).scalar()
    d = df.withColumn("__cent", cent).withColumn(
        "dist", F.sqrt(V.sqdist(vec, F.element_at("__cent", F.col(cluster))))).drop("__cent")
    q = exact_quantiles(d, "dist", [pct / 100.0], [cluster], "linear").select(cluster, F.col("quantile").alias("__cut"))
    return d.join(broadcast_if_small(q), cluster).where(F.col("dist") <= F.col("__cut")).drop("__cut")
