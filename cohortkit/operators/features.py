"""Feature preparation (F1-F15): fit on one frame, apply to another.

A fit returns a small DataFrame (one row of fill values or scaler
statistics, or a dictionary table); apply reads that fitted table.  One-row
fits are read back as literals (their size is one value per column, like
Spark ML's own ``Imputer``); dictionaries are joined (broadcast only under a
checked size).  Nothing iterates over data rows on the driver.
"""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import windows as Wn
from ..functions.joins import null_safe_join
from ..functions.quantiles import quantile_columns
from ..session import broadcast_if_small, materialize
from .profile import _is_numeric, long_values

MISSING_CATEGORY = "MISSING_CATEGORY"  # fixed value: null label before encoding


def _split_kinds(df: DataFrame, cols: Iterable[str] | None):
    types = dict(df.dtypes)
    cols = [c for c in (cols or df.columns) if c in types]
    num = [c for c in cols if _is_numeric(types[c])]
    cat = [c for c in cols if types[c] == "string"]
    return num, cat


def most_frequent(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(variable, value)``: the most frequent non-null value per column,
    ties to the smallest (rule N12).  Values are text."""
    lv = long_values(df, cols).where(F.col("value").isNotNull())
    vc = lv.groupBy("variable", "value").agg(F.count(F.lit(1)).alias("__n"))
    top = Wn.top_n_per_group(vc, ["variable"], [F.col("__n").desc(), F.col("value").asc()], 1)
    return top.select("variable", "value")


def _fills_row(means: DataFrame | None, modes: DataFrame | None) -> dict:
    """Read a fitted fill table (one value per column) into a dict."""
    out = {}
    if means is not None:
        row = means.first()
        out.update({k: v for k, v in row.asDict().items()})
    if modes is not None:
        out.update({r["variable"]: r["value"] for r in modes.collect()})  # one row per column
    return out


def fit_mean_mode(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> dict:
    """mean for numeric columns, mode for categorical ones (one agg + one
    grouped pass); returns ``{column: fill}``."""
    means = df.agg(*[F.avg(c).alias(c) for c in numeric]) if numeric else None
    modes = most_frequent(df, categorical) if categorical else None
    return _fills_row(means, modes)


def apply_fills(df: DataFrame, fills: dict) -> DataFrame:
    """Fill nulls with the fitted values (columns absent from ``df`` skipped)."""
    types = dict(df.dtypes)
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(types[c]))
                           for c, v in fills.items() if c in types and v is not None})


def mean_mode_fill(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """F1 in one call."""
    return apply_fills(df, fit_mean_mode(df, numeric, categorical))


class SimpleImputerFit:
    """median (exact, linear) for numeric columns, most frequent for
    text columns, fitted on the training frame; columns that are entirely
    null in training are dropped (and dropped from test frames too)."""

    def __init__(self, train: DataFrame, cols: Iterable[str] | None = None, numeric_strategy: str = "median"):
        num, cat = _split_kinds(train, cols)
        counts = train.agg(*[F.count(c).alias(c) for c in num + cat]).first().asDict() if num + cat else {}
        self.dropped = [c for c in num + cat if counts.get(c, 0) == 0]
        self.numeric = [c for c in num if c not in self.dropped]
        self.categorical = [c for c in cat if c not in self.dropped]
        fills = {}
        if self.numeric:
            if numeric_strategy == "median":
                lv = long_values(train, self.numeric, as_double=True).where(F.col("value").isNotNull())
                q = quantile_columns(lv, "value", {"median": 0.5}, ["variable"], "linear")
                fills.update({r["variable"]: r["median"] for r in q.collect()})  # one row per column
            else:
                fills.update(train.agg(*[F.avg(c).alias(c) for c in self.numeric]).first().asDict())
        if self.categorical:
            fills.update({r["variable"]: r["value"] for r in most_frequent(train, self.categorical).collect()})
        self.fills = fills

    def transform(self, df: DataFrame) -> DataFrame:
        return apply_fills(df.drop(*[c for c in self.dropped if c in df.columns]), self.fills)


def missing_shares(df: DataFrame, cols: Sequence[str]) -> dict:
    row = df.agg(*[(1.0 - F.count(c) / F.count(F.lit(1))).alias(c) for c in cols]).first()
    return row.asDict()


class DropThenImpute:
    """drop columns whose missing share in training exceeds
    ``threshold`` (0.2), then F2."""

    def __init__(self, train: DataFrame, cols: Sequence[str], threshold: float = 0.2):
        shares = missing_shares(train, cols)
        self.removed = [c for c in cols if shares[c] > threshold]
        self.kept = [c for c in cols if c not in self.removed]
        self.imputer = SimpleImputerFit(train.drop(*self.removed), self.kept)

    def transform(self, df: DataFrame) -> DataFrame:
        return self.imputer.transform(df.drop(*[c for c in self.removed if c in df.columns]))


class IndicatorThenImpute:
    """``<col>_missing`` 0/1 indicators for the columns with nulls in
    training (kept as explicit (column, indicator) pairs), then F2."""

    def __init__(self, train: DataFrame, cols: Sequence[str]):
        shares = missing_shares(train, cols)
        self.pairs = [(c, f"{c}_missing") for c in cols if shares[c] > 0]
        self.imputer = SimpleImputerFit(self._indicators(train), cols)

    def _indicators(self, df: DataFrame) -> DataFrame:
        return df.withColumns({ind: F.col(c).isNull().cast("int") for c, ind in self.pairs if c in df.columns})

    def transform(self, df: DataFrame) -> DataFrame:
        return self.imputer.transform(self._indicators(df))


def fit_label_encoder(train: DataFrame, cols: Sequence[str]) -> DataFrame:
    """dictionary ``(variable, value, code)``: codes are the 0-based
    positions of the distinct values in sorted order, nulls read as
    ``MISSING_CATEGORY``.  The sorted distinct values are range-partitioned
    and checkpointed; positions are the per-partition index plus the counts
    of the earlier partitions (no single-task global window)."""
    lv = long_values(train, cols).select("variable", F.coalesce("value", F.lit(MISSING_CATEGORY)).alias("value"))
    distinct = lv.distinct()
    srt = materialize(distinct.repartitionByRange("variable", "value").sortWithinPartitions("variable", "value")
                              .withColumn("__pid", F.spark_partition_id())
                              .withColumn("__mono", F.monotonically_increasing_id()))
    first = srt.groupBy("__pid", "variable").agg(F.min("__mono").alias("__m0"), F.count(F.lit(1)).alias("__cnt"))
    w = Window.partitionBy("variable").orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    off = first.withColumn("__off", F.coalesce(F.sum("__cnt").over(w), F.lit(0)))
    return (srt.join(broadcast_if_small(off), ["__pid", "variable"])
               .select("variable", "value", (F.col("__off") + F.col("__mono") - F.col("__m0")).cast("int").alias("code")))


def apply_label_encoder(df: DataFrame, codes: DataFrame, cols: Sequence[str]) -> DataFrame:
    """replace each column by its code; unseen values -> -1."""
    out = df
    small = broadcast_if_small(codes)
    for c in cols:
        m = small.where(F.col("variable") == c).select(F.col("value").alias(f"__v_{c}"), F.col("code").alias(f"__c_{c}"))
        out = (out.withColumn(f"__k_{c}", F.coalesce(F.col(c).cast("string"), F.lit(MISSING_CATEGORY)))
                  .join(m, F.col(f"__k_{c}") == F.col(f"__v_{c}"), "left")
                  .withColumn(c, F.coalesce(F.col(f"__c_{c}"), F.lit(-1)))
                  .drop(f"__k_{c}", f"__v_{c}", f"__c_{c}"))
    return out


def one_hot_drop_first(df: DataFrame, cols: Sequence[str], max_levels: int = 1000) -> DataFrame:
    """0/1 column per level except the first (sorted); nulls give all
    zeros.  Levels become columns, so their count is checked first."""
    out = df
    for c in cols:
        levels = [r[0] for r in df.select(c).where(F.col(c).isNotNull()).distinct().limit(max_levels + 1).collect()]
        if len(levels) > max_levels:
            raise ValueError(f"{c}: more than {max_levels} levels")
        levels = sorted(levels)
        out = out.withColumns({f"{c}_{lv}": (F.col(c) == F.lit(lv)).cast("int") for lv in levels[1:]})
        out = out.withColumns({f"{c}_{lv}": F.coalesce(F.col(f"{c}_{lv}"), F.lit(0)) for lv in levels[1:]}).drop(c)
    return out


def one_hot_unseen_ignored(train: DataFrame, cols: Sequence[str]):
    """F8: Spark ML ``StringIndexer(handleInvalid='keep')`` +
    ``OneHotEncoder(dropLast=True)``: the kept (unseen) bucket is the last
    index and is dropped, so unseen levels encode as all zeros.  Returns the
    fitted ``PipelineModel``."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, StringIndexer
    idx = [StringIndexer(inputCol=c, outputCol=f"{c}_idx", handleInvalid="keep", stringOrderType="alphabetAsc")
           for c in cols]
    ohe = OneHotEncoder(inputCols=[f"{c}_idx" for c in cols], outputCols=[f"{c}_ohe" for c in cols], dropLast=True)
    return Pipeline(stages=[*idx, ohe]).fit(train)


def fit_scaler(df: DataFrame, cols: Sequence[str]) -> dict:
    """F9 / F10 fit: mean and population std per column (std 0 -> 1)."""
    row = df.agg(*[F.avg(c).alias(f"m|{c}") for c in cols], *[F.stddev_pop(c).alias(f"s|{c}") for c in cols]).first()
    return {c: (row[f"m|{c}"], row[f"s|{c}"] if row[f"s|{c}"] else 1.0) for c in cols}


def standardise(df: DataFrame, stats: dict, with_mean: bool = True) -> DataFrame:
    """F9 (centre and scale) / F10 (``with_mean=False``: scale only)."""
    return df.withColumns({c: ((F.col(c) - F.lit(m)) if with_mean else F.col(c)) / F.lit(s)
                           for c, (m, s) in stats.items() if c in df.columns})


def hash_rank_key(key: str, seed: int | str) -> Column:
    """52 bits of ``md5(key || seed)`` as a double (exact in a double)."""
    h = F.md5(F.concat(F.col(key).cast("string"), F.lit(str(seed))))
    return F.conv(F.substring(h, 1, 13), 16, 10).cast("long").cast("double")


def stratified_split(df: DataFrame, key: str, label: str, test_size: float = 0.2, seed: int = 42,
                     out: str = "is_test") -> DataFrame:
    """within each class the ``ceil(test_size * n_class)`` rows with the
    smallest hash of (key, seed) form the test set.  The cut is the exact
    order statistic per class (no single-task window), so the result is the
    same on any partitioning.  The hashes are written once: the search reads
    them several times."""
    from ..functions.quantiles import order_statistics
    d = df.withColumn("__h", hash_rank_key(key, seed))
    hashes = materialize(d.select(label, "__h"))
    ranks = (hashes.groupBy(label).agg(F.count(F.lit(1)).alias("__n"))
              .select(label, (F.ceil(F.col("__n") * test_size) - 1).cast("long").alias("__k")))
    cut = order_statistics(hashes, "__h", [label], ranks).select(label, F.col("__val").alias("__cut"))
    j = null_safe_join(d, broadcast_if_small(cut), [label], "left")
    return j.withColumn(out, F.coalesce(F.col("__h") <= F.col("__cut"), F.lit(False))).drop("__h", "__cut")


def class_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """balanced weights ``n / (k * n_class)`` attached to every row."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("__nc"))
    tot = counts.agg(F.sum("__nc").alias("n"), F.count(F.lit(1)).alias("k"))
    w = counts.withColumn(out, tot.select("n").scalar() / (tot.select("k").scalar() * F.col("__nc"))).drop("__nc")
    return df.join(broadcast_if_small(w), label, "left")


def stratified_folds(df: DataFrame, key: str, label: str, k: int = 5, seed: int = 42, out: str = "fold") -> DataFrame:
    """fold = (rank of the hash within its class - 1) mod k; ranks come
    from the skew-safe row number, so a large class is split across tasks."""
    d = df.withColumn("__h", hash_rank_key(key, seed))
    r = Wn.row_number(d, [label], ["__h", key], out="__rank")
    return r.withColumn(out, F.pmod(F.col("__rank") - 1, F.lit(k)).cast("int")).drop("__h", "__rank")


def select_features(df: DataFrame, mode: str = "all", include: Sequence[str] = (), exclude: Sequence[str] = (),
                    exclude_dates: bool = True, groups: dict | None = None) -> tuple[DataFrame, list[str]]:
    """resolve the feature list (``all`` | a named group list |
    ``custom`` = ``include``), remove ``exclude`` and date/timestamp columns,
    and keep the present ones (P1).  Returns the frame and the list."""
    types = dict(df.dtypes)
    if mode == "all":
        cols = list(df.columns)
    elif mode == "custom":
        cols = list(include)
    else:
        cols = list((groups or {}).get(mode, []))
    cols = [c for c in cols if c in types and c not in set(exclude)]
    if exclude_dates:
        cols = [c for c in cols if types[c] not in ("date", "timestamp", "timestamp_ntz")]
    return df.select(*cols), cols


def keep_with_missing(df: DataFrame, features: Sequence[str], suffix: str = "_missing") -> DataFrame:
    """each kept feature followed by its ``_missing`` companion when present."""
    cols = []
    for f in features:
        if f in df.columns:
            cols.append(f)
            if f"{f}{suffix}" in df.columns:
                cols.append(f"{f}{suffix}")
    return df.select(*cols)
