"""Readable rules from trees.

R1 walks a tree's node table (one row per node, at most ``2^(depth+1)``
rows) with a recursive query over its edges, building the root-to-node
condition list of every node in one statement.  Rules are then
ordinary DataFrames: scored on any table (R2), ranked (R3), profiled (R4)
and written as CSV / JSON (R5).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import windows as Wn
from ..functions.quantiles import quantile_columns


_PATHS = """
WITH RECURSIVE p AS (
  SELECT CAST(0 AS LONG) AS id, CAST(array() AS ARRAY<STRING>) AS conditions, CAST(array() AS ARRAY<STRING>) AS path_features, 0 AS depth
  UNION ALL
  SELECT e.child, concat(p.conditions, array(e.condition)), array_union(p.path_features, array(e.name)), p.depth + 1
  FROM p JOIN {edges} e ON p.id = e.parent)
SELECT * FROM p"""


def node_paths(nodes: DataFrame, feature_names: Sequence[str] | None = None) -> DataFrame:
    """Every node with its depth, condition list and the features used on
    its path.  Continuous splits read ``name <= t`` / ``name > t`` (4
    decimals); categorical ones ``name in {..}`` / ``name not in {..}``.
    An empty node table gives no rows."""
    names = F.array(*[F.lit(n) for n in feature_names]) if feature_names else None
    nd = nodes.select(F.col("id").cast("long").alias("id"), "prediction", "impurityStats", "rawCount", "leftChild", "rightChild", "split")
    fi = F.col("split.featureIndex")
    name = F.element_at(names, fi + 1) if names is not None else F.concat(F.lit("f"), fi.cast("string"))
    cats = F.col("split.leftCategoriesOrThreshold")
    listed = F.concat(F.lit("{"), F.array_join(F.transform(cats, lambda x: x.cast("int").cast("string")), ","), F.lit("}"))
    is_cat, thr = F.col("split.numCategories") >= 0, F.element_at(cats, 1)
    left = F.when(is_cat, F.concat(name, F.lit(" in "), listed)).otherwise(F.format_string("%s <= %.4f", name, thr))
    right = F.when(is_cat, F.concat(name, F.lit(" not in "), listed)).otherwise(F.format_string("%s > %.4f", name, thr))
    child = F.explode(F.array(F.struct(F.col("leftChild").cast("long").alias("child"), left.alias("condition")),
                              F.struct(F.col("rightChild").cast("long").alias("child"), right.alias("condition"))))
    edges = nd.where(F.col("leftChild") != -1).select(F.col("id").alias("parent"), name.alias("name"), child.alias("e")) \
              .select("parent", "name", "e.child", "e.condition")
    return nodes.sparkSession.sql(_PATHS, edges=edges).join(nd, "id")


def extract_rules(nodes: DataFrame, feature_names: Sequence[str], min_support: int = 10,
                  class_labels: Sequence[str] | None = None) -> DataFrame:
    """One rule per leaf with ``rawCount >= min_support``:
    ``(rule_id, conditions, num_conditions, prediction_class, prediction,
    support, confidence, samples_per_class, depth)``; confidence is the
    weighted share of the predicted class at the leaf."""
    p = node_paths(nodes, feature_names).where(F.col("leftChild") == -1)
    stats = F.col("impurityStats")
    total = F.aggregate(stats, F.lit(0.0), lambda a, x: a + x)
    cls = F.col("prediction").cast("int")
    labels = F.array(*[F.lit(x) for x in class_labels]) if class_labels else None
    pred = F.element_at(labels, cls + 1) if labels is not None else cls.cast("string")
    keys = labels if labels is not None else F.transform(F.sequence(F.lit(0), F.size(stats) - 1), lambda i: i.cast("string"))
    return p.where(F.col("rawCount") >= min_support).select(
        F.col("id").alias("rule_id"), "conditions", F.size("conditions").alias("num_conditions"),
        cls.alias("prediction_class"), pred.alias("prediction"), F.col("rawCount").alias("support"),
        F.when(total > 0, F.element_at(stats, cls + 1) / total).otherwise(0.0).alias("confidence"),
        F.map_from_arrays(F.slice(keys, 1, F.size(stats)), stats).alias("samples_per_class"), "depth")


def score_rules(df: DataFrame, rules: DataFrame, target: str, positive=1) -> DataFrame:
    """R2: support (rows matching all conditions) and confidence (share of
    ``positive`` among them) of each rule on ``df`` in one pass.  The rule
    list is read to build one ``count_if`` per rule (rules are few: at most
    one per tree leaf)."""
    rs = rules.select("rule_id", "conditions").collect()
    aggs = []
    for rr in rs:
        cond = F.expr(" AND ".join(f"({c})" for c in rr["conditions"])) if rr["conditions"] else F.lit(True)
        aggs += [F.count_if(cond).alias(f"s{rr['rule_id']}"),
                 F.count_if(cond & (F.col(target) == positive)).alias(f"p{rr['rule_id']}")]
    wide = df.agg(*aggs)
    stack = F.stack(F.lit(len(rs)), *[x for rr in rs for x in (F.lit(rr["rule_id"]), F.col(f"s{rr['rule_id']}"), F.col(f"p{rr['rule_id']}"))])
    s = wide.select(stack.alias("rule_id", "support", "n_positive"))
    s = s.withColumn("confidence", F.when(F.col("support") > 0, F.col("n_positive") / F.col("support")).otherwise(0.0))
    return rules.join(s, "rule_id")


def top_rules(rules: DataFrame, by: str = "confidence", n: int = 10, per_prediction: bool = True) -> DataFrame:
    """Best ``n`` rules by confidence (then support), by support (then
    confidence) or by depth (shallow first), per prediction if asked."""
    order = {"confidence": [F.col("confidence").desc(), F.col("support").desc(), F.col("rule_id")],
             "support": [F.col("support").desc(), F.col("confidence").desc(), F.col("rule_id")],
             "depth": [F.col("num_conditions").asc(), F.col("confidence").desc(), F.col("rule_id")]}[by]
    if per_prediction:
        return Wn.top_n_per_group(rules, ["prediction"], order, n, out="rank")
    return rules.orderBy(*order).limit(n)


def rule_patterns(rules: DataFrame, top_features: int = 20) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(feature frequency top n, condition-count statistics,
    per-prediction count and mean confidence)."""
    feats = rules.select(F.explode("conditions").alias("c")).select(F.split("c", " ").getItem(0).alias("feature"))
    freq = feats.groupBy("feature").agg(F.count(F.lit(1)).alias("count")) \
                .orderBy(F.col("count").desc(), F.col("feature")).limit(top_features)
    q = quantile_columns(rules, "num_conditions", {"median": 0.5})
    cs = rules.agg(F.avg("num_conditions").alias("mean"), F.min("num_conditions").alias("min"),
                   F.max("num_conditions").alias("max"), F.count(F.lit(1)).alias("n_rules")) \
              .withColumn("median", q.select("median").scalar())
    pred = rules.groupBy("prediction").agg(F.count(F.lit(1)).alias("n_rules"),
                                           F.coalesce(F.avg("confidence"), F.lit(0.0)).alias("mean_confidence"))
    return freq, cs, pred


def rules_flat(rules: DataFrame) -> DataFrame:
    """CSV-ready rows: conditions joined by `` AND ``."""
    return rules.select("rule_id", F.array_join("conditions", " AND ").alias("conditions"), "num_conditions",
                        "prediction", "support", "confidence")


def export_rules(rules: DataFrame, path: str) -> tuple[str, str]:
    """Write ``path/csv`` (flat) and ``path/json`` (nested conditions and
    class counts)."""
    rules_flat(rules).write.mode("overwrite").option("header", True).csv(f"{path}/csv")
    rules.write.mode("overwrite").json(f"{path}/json")
    return f"{path}/csv", f"{path}/json"
