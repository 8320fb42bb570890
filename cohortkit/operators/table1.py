"""Stratified "Table 1" (A15-A17).

Numbers are computed in long form for the Total and every stratum in one
pass (the stratum null is its own group, separate from Total); the text
cells (``12.3 (4.5)``, ``n (x%)``) and the pivot by stratum are a display
step on the small result.
"""

from __future__ import annotations

from typing import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.quantiles import quantile_columns

TOTAL = "Total"


def _memberships(df: DataFrame, strata_col: str | None, value: Column) -> DataFrame:
    """Each row counted for Total and for its own stratum (like grouping sets
    ``((), (stratum))``; ``is_total`` plays the role of ``grouping()``)."""
    if strata_col is None:
        return df.select(F.lit(True).alias("is_total"), F.lit(TOTAL).alias("stratum"), value.alias("v"))
    g = F.explode(F.array(
        F.struct(F.lit(True).alias("is_total"), F.lit(TOTAL).alias("stratum")),
        F.struct(F.lit(False).alias("is_total"), F.col(strata_col).cast("string").alias("stratum"))))
    return df.select(g.alias("g"), value.alias("v")).select("g.is_total", "g.stratum", "v")


def continuous_block(df: DataFrame, value_col: str, strata_col: str | None, label: str | None = None) -> DataFrame:
    """Per group n, missing n / %, mean, SD (ddof 1), median, Q1, Q3
    (linear), min, max."""
    label = label or value_col
    m = _memberships(df, strata_col, F.col(value_col).cast("double"))
    keys = ["is_total", "stratum"]
    base = m.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("v").alias("n"),
        F.avg("v").alias("mean"), F.stddev_samp("v").alias("sd"),
        F.min("v").alias("min"), F.max("v").alias("max"))
    q = quantile_columns(m.where(F.col("v").isNotNull()), "v",
                         {"q1": 0.25, "median": 0.5, "q3": 0.75}, keys, "linear")
    out = base.join(q, [base.is_total == q.is_total, base.stratum.eqNullSafe(q.stratum)], "left") \
              .select(base.is_total, base.stratum, "n_rows", "n", "mean", "sd", "median", "q1", "q3", "min", "max")
    return out.select(F.lit(label).alias("characteristic"), "*",
                      (F.col("n_rows") - F.col("n")).alias("n_missing"),
                      ((F.col("n_rows") - F.col("n")) * 100.0 / F.col("n_rows")).alias("missing_pct"))


def categorical_block(df: DataFrame, value_col: str, strata_col: str | None, top_k: int | None = 10,
                      other_label: str = "Other", label: str | None = None,
                      transform: Callable[[Column], Column] | None = None) -> DataFrame:
    """N and % of every level per group.  Levels are the ``top_k``
    most frequent overall (ties by value), the rest become ``other_label``;
    ``''`` counts as missing; a Missing row (``is_missing``) closes each
    group.  Empty (group, level) cells are listed with n = 0."""
    label = label or value_col
    v = F.when(F.col(value_col).cast("string") == "", F.lit(None)).otherwise(F.col(value_col).cast("string"))
    if transform is not None:
        v = transform(v)
    d = df.select(*([F.col(strata_col)] if strata_col else []), v.alias("__v"))
    if top_k is not None:
        totals = d.where(F.col("__v").isNotNull()).groupBy("__v").agg(F.count(F.lit(1)).alias("__n"))
        keep = totals.orderBy(F.col("__n").desc(), F.col("__v").asc()).limit(top_k) \
                     .select(F.col("__v").alias("__keep"))
        # at most top_k rows: a broadcast with a proven bound
        d = d.join(F.broadcast(keep), F.col("__v") == F.col("__keep"), "left") \
             .withColumn("__v", F.when(F.col("__v").isNull(), F.lit(None))
                                 .when(F.col("__keep").isNotNull(), F.col("__v"))
                                 .otherwise(F.lit(other_label))).drop("__keep")
    m = _memberships(d, strata_col, F.col("__v"))
    keys = ["is_total", "stratum"]
    counts = m.groupBy(*keys, "v").agg(F.count(F.lit(1)).alias("n"))
    denom = counts.groupBy(*keys).agg(F.sum("n").alias("denom"))
    # level order: by overall count desc then value; other last; Missing after all
    lv = counts.where(F.col("is_total") & F.col("v").isNotNull()).select(
        F.col("v").alias("level"), F.col("n").alias("__tn"))
    lv_arr = lv.select(F.array_sort(F.collect_list(F.struct(
        (F.col("level") == other_label).cast("int").alias("o"), (-F.col("__tn")).alias("c"),
        F.col("level").alias("level"))))).scalar()
    levels = F.transform("__lv", lambda s, i: F.struct(s["level"].alias("level"), (i + 1).alias("level_order"),
                                                       F.lit(False).alias("is_missing")))
    levels = F.concat(levels, F.array(F.struct(F.lit(None).cast("string").alias("level"),
                                               (F.size("__lv") + 1).alias("level_order"),
                                               F.lit(True).alias("is_missing"))))
    # the level list (at most top_k + 1 entries) is projected as a column first
    grid = (denom.withColumn("__lv", lv_arr)
                 .select(*keys, "denom", F.explode(levels).alias("l")).select(*keys, "denom", "l.*"))
    c = counts.withColumnRenamed("is_total", "__t").withColumnRenamed("stratum", "__s")
    j = grid.join(c, (grid.is_total == c.__t) & grid.stratum.eqNullSafe(c.__s) & grid.level.eqNullSafe(c.v), "left")
    return j.select(F.lit(label).alias("characteristic"), "is_total", "stratum", "level", "level_order",
                    "is_missing", F.coalesce("n", F.lit(0)).alias("n"), "denom",
                    (F.coalesce("n", F.lit(0)) * 100.0 / F.col("denom")).alias("pct"))


def make_table1(df: DataFrame, spec: Mapping[str, Mapping], strata_col: str | None = None,
                top_k_default: int = 10) -> tuple[DataFrame, DataFrame, list[str]]:
    """A15-A17 driver: ``spec = {label: {"value_col", "type", ["top_k",
    "other_label", "transform_fn"]}}``.  Returns the continuous block, the
    categorical block and the labels skipped because their column is absent."""
    cont, cat, skipped = [], [], []
    for label, cfg in spec.items():
        col = cfg["value_col"]
        if col not in df.columns:
            skipped.append(label)
            continue
        if cfg["type"] == "continuous":
            cont.append(continuous_block(df, col, strata_col, label))
        else:
            cat.append(categorical_block(df, col, strata_col, cfg.get("top_k", top_k_default),
                                         cfg.get("other_label", "Other"), label, cfg.get("transform_fn")))
    def u(xs):
        if not xs:
            return None
        out = xs[0]
        for x in xs[1:]:
            out = out.unionByName(x)
        return out
    return u(cont), u(cat), skipped


def format_table1(cont: DataFrame | None, cat: DataFrame | None, decimals: int = 1, pct_decimals: int = 1) -> DataFrame:
    """Display step: text cells ``mean (sd)``, ``median [q1, q3]``, ``min, max``,
    ``n (x%)`` in long form ``(characteristic, level, stratum, cell)``."""
    f = f"%.{decimals}f"
    parts = []
    if cont is not None:
        c = cont
        parts.append(c.select("characteristic", F.lit("Mean (SD)").alias("level"), "stratum",
                              F.format_string(f"{f} ({f})", "mean", "sd").alias("cell")))
        parts.append(c.select("characteristic", F.lit("Median [IQR]").alias("level"), "stratum",
                              F.format_string(f"{f} [{f}, {f}]", "median", "q1", "q3").alias("cell")))
        parts.append(c.select("characteristic", F.lit("Min, Max").alias("level"), "stratum",
                              F.format_string(f"{f}, {f}", "min", "max").alias("cell")))
        parts.append(c.select("characteristic", F.lit("Missing").alias("level"), "stratum",
                              F.format_string(f"%d (%.{pct_decimals}f%%)", "n_missing", "missing_pct").alias("cell")))
    if cat is not None:
        parts.append(cat.select("characteristic", F.coalesce("level", F.lit("Missing")).alias("level"), "stratum",
                                F.format_string(f"%d (%.{pct_decimals}f%%)", "n", "pct").alias("cell")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
