"""Order, top-k and set operators."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import windows as Wn


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """The first k rows of a total order (planned as TakeOrdered: each
    task keeps k rows, the driver merges k x tasks)."""
    return df.orderBy(*order).limit(k)


def top_k_per_group(df: DataFrame, group_cols: Sequence[str], order: Sequence[Column], k: int,
                    rank_col: str = "rank") -> DataFrame:
    """First k per group (WindowGroupLimit trims before the shuffle)."""
    return Wn.top_n_per_group(df, group_cols, order, k, out=rank_col)


def first_n_per_class(df: DataFrame, label_col: str, key_col: str, n: int) -> DataFrame:
    """Stratified take: the first n rows of every class in key order."""
    return top_k_per_group(df, [label_col], [F.col(key_col).asc()], n, rank_col="class_rank")


def multi_key_sort(df: DataFrame, keys: Sequence[tuple[str, bool]]) -> DataFrame:
    """Sort by several keys, each ascending (True) or descending."""
    return df.orderBy(*[F.col(c).asc() if asc else F.col(c).desc() for c, asc in keys])


def running_share(df: DataFrame, order_cols: Sequence[str], value_col: str, group_cols: Sequence[str] = (),
                  out: str = "cum_share", descending: bool = False) -> DataFrame:
    """Running sum of ``value`` divided by its (group) total."""
    d = Wn.running_sum(df, group_cols, order_cols, {"__cum": F.col(value_col)}, descending=descending)
    if group_cols:
        tot = df.groupBy(*group_cols).agg(F.sum(value_col).alias("__tot"))
        d = d.join(tot, on=list(group_cols))
    else:
        d = d.withColumn("__tot", df.agg(F.sum(value_col)).scalar())
    return d.withColumn(out, F.col("__cum") / F.col("__tot")).drop("__cum", "__tot")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Append by column name (missing columns become null)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def intersect_on(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys present in both, with both sides' other columns."""
    return a.join(b, on=key, how="inner")


def difference_on(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Rows of ``a`` whose key is not in ``b`` (left anti join)."""
    return a.join(b.select(key), on=key, how="left_anti")


def union_distinct(df: DataFrame, group_col: str, member_col: str, groups: Sequence[str]) -> DataFrame:
    """U4: the distinct members of several groups of a ``(group, member)`` table."""
    return df.where(F.col(group_col).isin(list(groups))).select(member_col).distinct()
