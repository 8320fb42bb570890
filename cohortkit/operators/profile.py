"""Profiling and aggregation.

Plan rule: many columns are profiled in one pass by unpivoting to
``(variable, value)`` and grouping once, never one job per column.  Exact
quantiles go through the narrowing search in ``functions.quantiles``.
"""

from __future__ import annotations

import math
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from ..functions import windows as Wn
from ..functions.joins import null_safe_join
from ..functions.quantiles import exact_quantiles, quantile_columns
from ..session import broadcast_if_small, materialize

NUMERIC_KINDS = ("tinyint", "smallint", "int", "bigint", "float", "double")


def _is_numeric(dtype: str) -> bool:
    return dtype in NUMERIC_KINDS or dtype.startswith("decimal")


def kind_of(dtype: str) -> str:
    if _is_numeric(dtype):
        return "numeric"
    if dtype in ("date", "timestamp", "timestamp_ntz"):
        return "datetime"
    if dtype == "boolean":
        return "boolean"
    if dtype == "string":
        return "string"
    return "other"


def long_values(df: DataFrame, cols: Sequence[str], key_cols: Sequence[str] = (),
                as_double: bool = False) -> DataFrame:
    """Unpivot ``cols`` to ``(key..., variable, value)``; values are cast to
    string (or double) so heterogeneous columns share one value column."""
    t = "double" if as_double else "string"
    d = df.select(*key_cols, *[F.col(c).cast(t).alias(c) for c in cols])
    return d.unpivot(list(key_cols) if key_cols else [], list(cols), "variable", "value")


def shape(df: DataFrame) -> DataFrame:
    """A1: rows, columns and column counts per kind as ``(metric, value)``."""
    kinds = {}
    for _, t in df.dtypes:
        k = kind_of(t)
        kinds[k] = kinds.get(k, 0) + 1
    metrics = [("n_columns", len(df.columns))] + [(f"n_{k}", v) for k, v in sorted(kinds.items())]
    n = df.agg(F.count(F.lit(1)).alias("value")).select(F.lit("n_rows").alias("metric"), "value")
    spark = df.sparkSession
    fixed = spark.createDataFrame(metrics, "metric string, value long")
    return n.unionByName(fixed)


def column_profile(df: DataFrame, cols: Sequence[str] | None = None, null_is_value: bool = True) -> DataFrame:
    """A2: per column: type, nulls, null %, distinct values.

    ``null_is_value=True`` counts null as one more distinct value when present
    (polars ``n_unique``, N3); ``False`` ignores it (pandas ``nunique``, N4).
    One unpivot, one ``groupBy(variable, value)`` (partial aggregation collapses
    repeated values before the shuffle), one small ``groupBy(column)``.
    """
    cols = list(cols or df.columns)
    types = dict(df.dtypes)
    lv = long_values(df, cols)
    per_value = lv.groupBy("variable", "value").agg(F.count(F.lit(1)).alias("n"))
    prof = per_value.groupBy("variable").agg(
        F.sum("n").alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("n_null"),
        F.count("value").alias("n_distinct_non_null"))
    unique = F.col("n_distinct_non_null") + (F.when(F.col("n_null") > 0, 1).otherwise(0) if null_is_value else F.lit(0))
    spark = df.sparkSession
    tdf = spark.createDataFrame([(c, types[c]) for c in cols], "variable string, dtype string")
    return (prof.join(F.broadcast(tdf), on="variable")
                .select("variable", "dtype", F.col("n_null").cast("long").alias("n_null"),
                        (F.col("n_null") * 100.0 / F.col("n_rows")).alias("null_pct"),
                        unique.cast("long").alias("n_unique")))


def missing_report(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A3: only the columns with missing values."""
    return column_profile(df, cols).where(F.col("n_null") > 0).select("variable", "n_null", "null_pct")


def describe(df: DataFrame, cols: Sequence[str], flavour: str = "pandas", group_cols: Sequence[str] = ()) -> DataFrame:
    """A4: count, nulls, mean, std (ddof 1), min, 25/50/75 %, max per column.

    ``flavour='pandas'`` interpolates quartiles linearly; ``'polars'`` takes
    the nearest rank (N11b).
    """
    method = "linear" if flavour == "pandas" else "nearest"
    lv = long_values(df, cols, group_cols, as_double=True)
    keys = [*group_cols, "variable"]
    base = lv.groupBy(*keys).agg(
        F.count("value").alias("count"),
        F.count_if(F.col("value").isNull()).alias("null_count"),
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    q = quantile_columns(lv, "value", {"p25": 0.25, "p50": 0.5, "p75": 0.75}, keys, method)
    return null_safe_join(base, q, keys, "left")


def value_counts(df: DataFrame, cols: Sequence[str], top_n: int | None = None,
                 dropna: bool = False) -> DataFrame:
    """A5: ``(column, value, count)`` sorted by count desc, value asc;
    optionally the first ``top_n`` per column.  Many columns in one pass."""
    lv = long_values(df, cols)
    if dropna:
        lv = lv.where(F.col("value").isNotNull())
    vc = lv.groupBy("variable", "value").agg(F.count(F.lit(1)).alias("count"))
    if top_n:
        vc = Wn.top_n_per_group(vc, ["variable"], [F.col("count").desc(), F.col("value").asc_nulls_first()], top_n, out="rank")
    return vc


def with_share(counts: DataFrame, count_col: str = "count", group_cols: Sequence[str] = (),
               out: str = "share") -> DataFrame:
    """Count / total.  Totals per group are a small aggregate joined back
    (no global window on a single partition)."""
    if group_cols:
        tot = counts.groupBy(*group_cols).agg(F.sum(count_col).alias("__tot"))
        return counts.join(tot, on=list(group_cols)).withColumn(out, F.col(count_col) / F.col("__tot")).drop("__tot")
    total = counts.agg(F.sum(count_col)).scalar()
    return counts.withColumn(out, F.col(count_col) / total)


def imbalance(df: DataFrame, cols: Sequence[str], top: int = 3) -> DataFrame:
    """Largest level share per column (nulls ignored, as value_counts);
    the ``top`` most imbalanced columns."""
    vc = value_counts(df, cols, dropna=True)
    sh = with_share(vc, group_cols=["variable"])
    mx = sh.groupBy("variable").agg(F.max("share").alias("max_share"))
    return Wn.top_n_per_group(mx.withColumn("__all", F.lit(1)), ["__all"],
                              [F.col("max_share").desc(), F.col("variable").asc()], top, out="rank").drop("__all")


def common_levels(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Most and least common level per column (nulls ignored).  Order
    is count desc, value asc; most = first, least = last."""
    vc = value_counts(df, cols, dropna=True)
    return vc.groupBy("variable").agg(
        F.min_by("value", F.struct(-F.col("count"), F.col("value"))).alias("most_common"),
        F.max(F.col("count")).alias("most_count"),
        F.max_by("value", F.struct(-F.col("count"), F.col("value"))).alias("least_common"),
        F.min(F.col("count")).alias("least_count"))


def crosstab(df: DataFrame, a: str, b: str, dropna: bool = False) -> DataFrame:
    """``(a, b, count)``."""
    d = df.where(F.col(a).isNotNull() & F.col(b).isNotNull()) if dropna else df
    return d.groupBy(a, b).agg(F.count(F.lit(1)).alias("count"))


def crosstab_row_pct(df: DataFrame, a: str, b: str) -> DataFrame:
    """A10: row-normalised cross-tab in percent (nulls dropped, as pandas)."""
    ct = crosstab(df, a, b, dropna=True)
    w = Window.partitionBy(a)  # over the aggregated table: one row per level pair
    return ct.withColumn("row_pct", F.col("count") * 100.0 / F.sum("count").over(w))


def agreement_overview(df: DataFrame, a: str, b: str) -> DataFrame:
    """Agree / disagree counts and rates over rows where both are present."""
    d = df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    return d.agg(F.count(F.lit(1)).alias("n"),
                 F.count_if(F.col(a) == F.col(b)).alias("n_agree"),
                 F.count_if(F.col(a) != F.col(b)).alias("n_disagree")) \
            .withColumn("agree_rate", F.col("n_agree") / F.col("n")) \
            .withColumn("disagree_rate", F.col("n_disagree") / F.col("n"))


def disagreements(df: DataFrame, a: str, b: str) -> DataFrame:
    """Only the rows where both are present and differ."""
    return df.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))


def magnitude_distribution(df: DataFrame, a: str, b: str) -> DataFrame:
    """Counts per |a - b|."""
    return (df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
              .groupBy(F.abs(F.col(a) - F.col(b)).cast("int").alias("magnitude"))
              .agg(F.count(F.lit(1)).alias("count")))


def table_summary(df: DataFrame, cols: Sequence[str] | None = None, examples: int = 5) -> tuple[DataFrame, DataFrame]:
    """Per column kind, non-null, null, min, max and the ``examples``
    smallest distinct values; plus a long ``(variable, level)`` table of all
    levels of the non-numeric columns (kept as rows, not one array)."""
    cols = list(cols or df.columns)
    types = dict(df.dtypes)
    lv = long_values(df, cols)
    per_value = lv.groupBy("variable", "value").agg(F.count(F.lit(1)).alias("n"))
    spark = df.sparkSession
    tdf = F.broadcast(spark.createDataFrame([(c, kind_of(types[c])) for c in cols], "variable string, kind string"))
    # min / max in the column's own type order: numeric by value, others as text
    num = [c for c in cols if _is_numeric(types[c])]
    ex = Wn.top_n_per_group(per_value.where(F.col("value").isNotNull()).join(tdf, "variable")
                            .withColumn("__num", F.when(F.col("kind") == "numeric", F.col("value").try_cast("double"))),
                            ["variable"], [F.col("__num").asc(), F.col("value").asc()], examples, out="__r")
    exa = ex.groupBy("variable").agg(F.sort_array(F.collect_list(F.struct("__r", "value"))).alias("__ex")) \
            .select("variable", F.transform("__ex", lambda s: s["value"]).alias("examples"))
    agg = per_value.join(tdf, "variable").groupBy("variable", "kind").agg(
        F.sum(F.when(F.col("value").isNotNull(), F.col("n"))).alias("non_null"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("null"),
        F.min_by("value", F.when(F.col("value").isNotNull(),
                                 F.struct(F.col("value").try_cast("double"), F.col("value")))).alias("__nmin"),
        F.max_by("value", F.when(F.col("value").isNotNull(),
                                 F.struct(F.col("value").try_cast("double"), F.col("value")))).alias("__nmax"),
        F.min("value").alias("__smin"), F.max("value").alias("__smax"))
    summary = agg.select("variable", "kind", "non_null", "null",
                         F.when(F.col("kind") == "numeric", F.col("__nmin")).otherwise(F.col("__smin")).alias("min"),
                         F.when(F.col("kind") == "numeric", F.col("__nmax")).otherwise(F.col("__smax")).alias("max")) \
                 .join(exa, "variable", "left")
    levels = per_value.join(tdf, "variable").where((F.col("kind") != "numeric") & F.col("value").isNotNull()) \
                      .select("variable", F.col("value").alias("level"), F.col("n").alias("count"))
    return summary, levels


def iqr_outliers(df: DataFrame, cols: Sequence[str], k: float = 1.5) -> DataFrame:
    """Per column Q1/Q3 (linear), fences, and count / % / min / max of
    the values outside them.  Quartiles are a small table joined back."""
    lv = long_values(df, cols, as_double=True).where(F.col("value").isNotNull())
    q = quantile_columns(lv, "value", {"q1": 0.25, "q3": 0.75}, ["variable"], "linear")
    q = q.withColumn("lower", F.col("q1") - k * (F.col("q3") - F.col("q1"))) \
         .withColumn("upper", F.col("q3") + k * (F.col("q3") - F.col("q1")))
    d = lv.join(broadcast_if_small(q), "variable")
    out = (F.col("value") < F.col("lower")) | (F.col("value") > F.col("upper"))
    return d.groupBy("variable", "q1", "q3", "lower", "upper").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(out).alias("n_outliers"),
        F.min(F.when(out, F.col("value"))).alias("outlier_min"),
        F.max(F.when(out, F.col("value"))).alias("outlier_max")) \
        .withColumn("outlier_pct", F.col("n_outliers") * 100.0 / F.col("n"))


def histogram(df: DataFrame, cols: Sequence[str], bins: int = 30, group_cols: Sequence[str] = (),
              unit_width_if_range_le: float | None = None) -> DataFrame:
    """Equal-width bin counts ``(group..., column, bin, lower, upper, count)``.

    Bin = ``least(floor((v - min) / w), bins - 1)`` (last bin closed on the
    right).  With ``unit_width_if_range_le`` a column whose range is at most
    that value is binned with width 1 starting at its minimum.  Empty bins
    are not listed.
    """
    keys = [*group_cols, "variable"]
    lv = long_values(df, cols, group_cols, as_double=True).where(F.col("value").isNotNull())
    mm = lv.groupBy(*keys).agg(F.min("value").alias("__mn"), F.max("value").alias("__mx"))
    rng = F.col("__mx") - F.col("__mn")
    unit = (rng <= F.lit(unit_width_if_range_le)) if unit_width_if_range_le is not None else F.lit(False)
    mm = mm.withColumn("__unit", unit) \
           .withColumn("__nb", F.when(F.col("__unit"), F.floor(rng).cast("int") + 1).otherwise(F.lit(bins))) \
           .withColumn("__w", F.when(F.col("__unit"), F.lit(1.0))
                       .when(rng > 0, rng / bins).otherwise(F.lit(1.0)))
    d = null_safe_join(lv, broadcast_if_small(mm), keys)
    b = F.least(F.floor((F.col("value") - F.col("__mn")) / F.col("__w")).cast("int"), F.col("__nb") - 1)
    h = d.groupBy(*keys, b.alias("bin"), "__mn", "__w").agg(F.count(F.lit(1)).alias("count"))
    return h.select(*keys, "bin", (F.col("__mn") + F.col("bin") * F.col("__w")).alias("lower"),
                    (F.col("__mn") + (F.col("bin") + 1) * F.col("__w")).alias("upper"), "count")


KDE_TERMS = 12  # Hermite terms a cell; with cells of width h/2 the rest of the series is below 1e-11 a value
KDE_REACH = 9   # bandwidths beyond which a Gaussian is below 3e-18


def kde_grid(df: DataFrame, col: str, points: int = 1000) -> tuple[DataFrame, DataFrame]:
    """Gaussian KDE (Scott bandwidth ``h = sd * n^(-1/5)``) on ``points``
    equally spaced values from min to max, and the span of the densest
    points holding the top 25 % of the density.

    Fast Gauss transform: the values of a cell of width h/2 enter as their first
    12 moments about its centre (one aggregate, one row an occupied cell is
    shuffled), and a cell's Hermite series is summed at the grid points within nine
    bandwidths.  The series of a value v in a cell with centre c has terms below
    ``1.09 * 0.25^k / sqrt(k!)``, so what is left out is below 1e-11 times the
    number of values.  Without a spread (fewer than two different values) there are no
    grid rows.  Returns ``(grid, span)``.
    """
    v = df.select(F.col(col).cast("double").alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    stats = materialize(v.agg(F.count(F.lit(1)).alias("n"), F.stddev_samp("v").alias("sd"), F.min("v").alias("mn"), F.max("v").alias("mx"))
                         .where("sd > 0"))
    n_ = stats.select("n").scalar(); sd = stats.select("sd").scalar()
    mn = stats.select("mn").scalar(); mx = stats.select("mx").scalar()
    h = sd * F.pow(n_.cast("double"), F.lit(-0.2))
    step = (mx - mn) / F.lit(points - 1)
    scale = h * F.lit(2 ** 0.5)
    d = v.where(h.isNotNull()).withColumn("cell", F.floor((F.col("v") - mn) / (h / 2))).withColumn("c", mn + (F.col("cell") + 0.5) * (h / 2)) \
         .withColumn("s", (F.col("v") - F.col("c")) / scale)
    cells = d.groupBy("cell", "c").agg(*[F.sum(F.pow("s", F.lit(k)) / F.lit(float(math.factorial(k)))).alias(f"m{k}") for k in range(KDE_TERMS)])
    lo = F.greatest(F.ceil((F.col("c") - KDE_REACH * h - mn) / step), F.lit(0))
    hi = F.least(F.floor((F.col("c") + KDE_REACH * h - mn) / step), F.lit(points - 1))
    near = cells.where(lo <= hi).select("*", F.explode(F.sequence(lo, hi)).alias("i"))
    t = (mn + F.col("i") * step - F.col("c")) / scale

    def term(acc, m):  # Hermite functions by h(k+1) = 2t h(k) - 2k h(k-1)
        return F.struct(acc["cur"].alias("prev"), (2 * F.col("t") * acc["cur"] - 2 * acc["k"] * acc["prev"]).alias("cur"),
                        (acc["sum"] + m * acc["cur"]).alias("sum"), (acc["k"] + 1).alias("k"))
    start = F.struct(F.lit(0.0).alias("prev"), F.exp(-F.col("t") * F.col("t")).alias("cur"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("k"))
    series = F.aggregate(F.array(*[f"m{k}" for k in range(KDE_TERMS)]), start, term, lambda acc: acc["sum"])
    sums = near.withColumn("t", t).groupBy("i").agg(F.sum(series).alias("__s"))
    grid = df.sparkSession.range(points).select(F.col("id").cast("int").alias("i")).where(h.isNotNull()).withColumn("x", mn + F.col("i") * step)
    dens = grid.join(sums, "i", "left").withColumn("density", F.greatest(F.coalesce("__s", F.lit(0.0)), F.lit(0.0))
                                                   / (n_ * h * F.lit((2 * math.pi) ** 0.5))).drop("__s")
    dens = materialize(dens)  # the fixed grid, read by the span too
    # cumulative share of the density in descending density order; the grid
    # has a fixed number of rows, so one ordered window over it is bounded.
    w = Window.orderBy(F.col("density").desc(), F.col("i").asc()).rowsBetween(Window.unboundedPreceding, 0)
    cum = dens.withColumn("__cum", F.sum("density").over(w) / dens.agg(F.sum("density")).scalar())
    top = cum.where(F.col("__cum") <= 0.25)
    span = top.agg(F.min("x").alias("top25_min"), F.max("x").alias("top25_max"), F.count(F.lit(1)).alias("n_points"))
    span = span.select(F.coalesce("top25_min", mn).alias("top25_min"),
                       F.coalesce("top25_max", mn).alias("top25_max"), "n_points")
    return dens, span


def five_number_by_class(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """Min, Q1, median, Q3, max per (target class, column)."""
    lv = long_values(df, cols, [target], as_double=True).where(F.col("value").isNotNull())
    q = quantile_columns(lv, "value", {"q1": 0.25, "median": 0.5, "q3": 0.75}, [target, "variable"], "linear")
    mm = lv.groupBy(target, "variable").agg(F.min("value").alias("min"), F.max("value").alias("max"))
    return null_safe_join(mm, q, [target, "variable"])


def label_coverage(pairs: DataFrame, label_col: str, expected: DataFrame) -> DataFrame:
    """Per expected label, pairs present and share (0 when missing)."""
    counts = pairs.groupBy(label_col).agg(F.count(F.lit(1)).alias("n_pairs"))
    total = pairs.agg(F.count(F.lit(1))).scalar()
    return (expected.join(counts, label_col, "left")
                    .select(label_col, F.coalesce("n_pairs", F.lit(0)).alias("n_pairs"))
                    .withColumn("share", F.col("n_pairs") / total)
                    .withColumn("missing", F.col("n_pairs") == 0))
