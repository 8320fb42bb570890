"""Exact quantiles by distributed radix selection.

Spark's exact ``percentile`` keeps every value of a group in one aggregation
buffer; for a column of a 100 TB table that is one task holding the column.
Here every double has a 64-bit key in the order of the values, and the wanted
order statistics are found 16 bits at a time: a pass counts the rows of each
digit, for all groups and ranks at once, and the cumulated counts say which digit holds a
rank.  The next pass looks only at rows that begin with such a digit.  A digit whose
rows are all equal ends its ranks, so four passes suffice for any data and columns of
few values take one or two.  A pass shuffles at most 65536 counts for each rank
that is open, whatever the size of its group.

Methods (``n`` values, probability ``p``, ranks 0-based):
  * ``linear``  - pandas/numpy default: position (n-1)p, linear interpolation.
  * ``nearest`` - polars ``describe``: rank floor((n-1)p + 0.5).
  * ``lower`` / ``higher`` - floor / ceil of (n-1)p.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import broadcast_if_small, materialize

DIGIT = 16                                  # bits of a digit
SHIFTS = (48, 32, 16, 0)


def ordered_key(v: Column) -> Column:
    """A long in the order of the doubles of ``v`` (not null, not NaN): their
    64 bits, with the negative key for negative values; both zeros have key 0."""
    bits = F.reflect(F.lit("java.lang.Double"), F.lit("doubleToRawLongBits"), v).cast("long")
    return F.when(bits < 0, -bits.bitwiseAND(F.lit((1 << 63) - 1))).otherwise(bits)


def _targets(counts: DataFrame, group_cols: list[str], probs: Sequence[float], method: str) -> DataFrame:
    rows = []
    for p in probs:
        pos = (F.col("__n") - 1) * F.lit(float(p))
        if method == "linear":
            lo, hi, frac = F.floor(pos), F.ceil(pos), pos - F.floor(pos)
        elif method == "nearest":
            r = F.floor(pos + F.lit(0.5))
            lo, hi, frac = r, r, F.lit(0.0)
        elif method == "lower":
            lo, hi, frac = F.floor(pos), F.floor(pos), F.lit(0.0)
        elif method == "higher":
            lo, hi, frac = F.ceil(pos), F.ceil(pos), F.lit(0.0)
        else:
            raise ValueError(method)
        rows.append(counts.select(*group_cols, F.lit(float(p)).alias("prob"),
                                  lo.cast("long").alias("__klo"), hi.cast("long").alias("__khi"),
                                  frac.alias("__frac")))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def _keyed(df: DataFrame, gk: Column, value_col: str) -> DataFrame:
    """(__gk, __v, __key) of the values that are not null or NaN."""
    d = df.select(gk.alias("__gk"), F.col(value_col).cast("double").alias("__v")).where(F.col("__v").isNotNull() & ~F.isnan("__v"))
    return d.withColumn("__key", ordered_key(F.col("__v")))


def _digits(base: DataFrame, keys: Sequence[str], shift: int) -> DataFrame:
    """Rows of each digit, with the least and largest value that it holds."""
    return base.groupBy(*keys, F.shiftright("__key", shift).alias("__digit")).agg(
        F.count(F.lit(1)).alias("__cnt"), F.min("__v").alias("__mn"), F.max("__v").alias("__mx"))


def _located(open_: DataFrame, digits: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each open rank (``keys``, __k, __rest) in the digit that holds it: its
    prefix, its rank there, and its value where the digit has one value only."""
    w = Window.partitionBy(*keys).orderBy("__digit").rowsBetween(Window.unboundedPreceding, -1)  # at most 65536 rows
    d = digits.withColumn("__below", F.coalesce(F.sum("__cnt").over(w), F.lit(0)))
    here = open_.join(d, list(keys)).where((F.col("__below") <= F.col("__rest")) & (F.col("__rest") < F.col("__below") + F.col("__cnt")))
    return materialize(here.select("__gk", "__k", (F.col("__rest") - F.col("__below")).alias("__rest"), F.col("__digit").alias("__prefix"),
                                   F.when(F.col("__mn") == F.col("__mx"), F.col("__mn")).alias("__val")))


def _search(base: DataFrame, ranks: DataFrame, first: DataFrame) -> DataFrame:
    """(__gk, __k, __val): exact values of the 0-based ``ranks`` (__gk, __k)
    among ``base`` (__gk, __v, __key), given the counts of the first digit."""
    at = _located(ranks.withColumn("__rest", F.col("__k")), first, ["__gk"])
    found = [at.where("__val is not null")]
    for before, shift in zip(SHIFTS, SHIFTS[1:]):
        open_ = at.where("__val is null")
        if open_.isEmpty():
            break
        prefixes = broadcast_if_small(open_.select("__gk", "__prefix").distinct())
        inside = base.withColumn("__prefix", F.shiftright("__key", before)).join(prefixes, ["__gk", "__prefix"])
        at = _located(open_.select("__gk", "__prefix", "__k", "__rest"), _digits(inside, ["__gk", "__prefix"], shift), ["__gk", "__prefix"])
        found.append(at.where("__val is not null"))
    out = found[0]
    for f in found[1:]:
        out = out.union(f)
    return out.select("__gk", "__k", "__val")


def _group_key(user_groups: Sequence[str]):
    # one non-null text key per group; a null group value is a group of its
    # own ("N" marker); a constant key when there are no groups keeps every
    # join an equi-join
    if not user_groups:
        return F.lit("")
    return F.concat_ws("\u0001", *[F.when(F.col(c).isNull(), F.lit("N"))
                                    .otherwise(F.concat(F.lit("V"), F.col(c).cast("string"))) for c in user_groups])


def order_statistics(df: DataFrame, value_col: str, group_cols: Sequence[str] | str, ranks: DataFrame) -> DataFrame:
    """Exact values of given 0-based ranks per group.  ``ranks`` holds the
    group columns and ``__k``; returns the group columns, ``__k``, ``__val``."""
    user_groups = [group_cols] if isinstance(group_cols, str) else list(group_cols)
    gk = _group_key(user_groups)
    base = _keyed(df, gk, value_col)
    rk = ranks.select(gk.alias("__gk"), *user_groups, "__k")
    vals = _search(base, rk.select("__gk", "__k").distinct(), _digits(base, ["__gk"], SHIFTS[0]))
    return rk.join(vals, ["__gk", "__k"], "left").drop("__gk")


def exact_quantiles(df: DataFrame, value_col: str, probs: Sequence[float],
                    group_cols: Sequence[str] = (), method: str = "linear") -> DataFrame:
    """Return ``(group_cols..., prob, quantile)``; nulls and NaN are ignored.
    Groups without values produce no rows."""
    user_groups = list(group_cols)
    gk = _group_key(user_groups)
    base = _keyed(df, gk, value_col)
    # the first digit's counts also say how many values each group has
    named = df.select(gk.alias("__gk"), *user_groups, F.col(value_col).cast("double").alias("__v")).where(F.col("__v").isNotNull() & ~F.isnan("__v"))
    # group columns are keys of the large aggregate, so that its buffer holds numbers only and is hashed, not sorted
    parts = _digits(named.withColumn("__key", ordered_key(F.col("__v"))), ["__gk", *[F.col(c) for c in user_groups]], SHIFTS[0])
    first = materialize(parts.groupBy("__gk", "__digit").agg(
        F.sum("__cnt").alias("__cnt"), F.min("__mn").alias("__mn"), F.max("__mx").alias("__mx"), *[F.first(c).alias(c) for c in user_groups]))
    counts = first.groupBy("__gk").agg(F.sum("__cnt").alias("__n"), *[F.first(c).alias(c) for c in user_groups])
    tg = materialize(_targets(counts, ["__gk", *user_groups], probs, method))
    ranks = (tg.select("__gk", F.col("__klo").alias("__k"))
               .unionByName(tg.select("__gk", F.col("__khi").alias("__k"))).distinct())
    vals = _search(base, ranks, first.drop(*user_groups))
    lo = vals.withColumnRenamed("__k", "__klo").withColumnRenamed("__val", "__vlo")
    hi = vals.withColumnRenamed("__k", "__khi").withColumnRenamed("__val", "__vhi")
    step = F.when(F.col("__frac") == 0, F.lit(0.0)).otherwise((F.col("__vhi") - F.col("__vlo")) * F.col("__frac"))
    return (tg.join(lo, on=["__gk", "__klo"], how="left")
              .join(hi, on=["__gk", "__khi"], how="left")
              .select(*user_groups, "prob", (F.col("__vlo") + step).alias("quantile")))


def quantile_columns(df: DataFrame, value_col: str, probs: dict[str, float],
                     group_cols: Sequence[str] = (), method: str = "linear") -> DataFrame:
    """Wide form: one column per named probability, one row per group."""
    q = exact_quantiles(df, value_col, list(probs.values()), group_cols, method)
    aggs = [F.max(F.when(F.col("prob") == float(p), F.col("quantile"))).alias(name)
            for name, p in probs.items()]
    if group_cols:
        return q.groupBy(*group_cols).agg(*aggs)  # groupBy keeps null keys as groups
    return q.agg(*aggs)
