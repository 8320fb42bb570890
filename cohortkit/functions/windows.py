"""Skew-safe ordered windows: running sums, row numbers and lag.

A plain ``Window.partitionBy(key).orderBy(t)`` sends every row of a key to
one task; when one key holds a third of all rows that task holds a third of
the table.  These helpers range-partition the rows by key and all order
columns, so a large key spreads over many partitions, run the window inside
each (key, partition) and add what the key's earlier partitions hold.  Only a
key that crosses a partition border has earlier partitions, so there are
fewer such offsets than partitions.  The plan is the same at every size.
"""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .joins import null_safe_join

_BLOCK = "__blk"


def _order_exprs(order_cols: Sequence[str], descending: bool):
    return [F.col(c).desc() if descending else F.col(c).asc() for c in order_cols]


def _ranged(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str], descending: bool) -> DataFrame:
    """``df`` with the number of its range partition; written, so that the
    numbers hold for every later reading."""
    d = df.repartitionByRange(*[F.col(c) for c in group_cols], *_order_exprs(order_cols, descending))
    return materialize(d.withColumn(_BLOCK, F.spark_partition_id()))


def running_sum(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str],
                sums: dict[str, Column], descending: bool = False, inclusive: bool = True) -> DataFrame:
    """Add running sums ``out = sum(expr) over (partition by group order by
    order rows unbounded preceding .. current row)``.

    ``descending`` runs from the largest order value down (reverse running
    sums, e.g. risk sets).  ``inclusive=False`` excludes the current row.
    The order columns should give a total order within a group.
    """
    group_cols = list(group_cols)
    d = _ranged(df.withColumns({f"__val_{o}": e.cast("double") for o, e in sums.items()}), group_cols, order_cols, descending)
    w = (Window.partitionBy(*group_cols, _BLOCK).orderBy(*_order_exprs(order_cols, descending))
         .rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1))
    tot = d.groupBy(*group_cols, _BLOCK).agg(*[F.coalesce(F.sum(f"__val_{o}"), F.lit(0.0)).alias(f"__tot_{o}") for o in sums])
    order = Window.partitionBy(*group_cols).orderBy(_BLOCK)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    off = tot.select(*group_cols, _BLOCK, F.row_number().over(order).alias("__nth"),
                     *[F.coalesce(F.sum(f"__tot_{o}").over(before), F.lit(0.0)).alias(f"__off_{o}") for o in sums])
    off = materialize(off.where("__nth > 1").drop("__nth"))   # fewer rows than partitions
    d = d.withColumns({f"__loc_{o}": F.coalesce(F.sum(f"__val_{o}").over(w), F.lit(0.0)) for o in sums})
    d = null_safe_join(d, F.broadcast(off), [*group_cols, _BLOCK], "left")
    d = d.withColumns({o: F.col(f"__loc_{o}") + F.coalesce(F.col(f"__off_{o}"), F.lit(0.0)) for o in sums})
    return d.drop(_BLOCK, *[f"__{p}_{o}" for o in sums for p in ("val", "loc", "off")])


def row_number(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str],
               out: str = "rn", descending: bool = False) -> DataFrame:
    """Skew-safe ``row_number()`` (1-based) within ``group_cols``."""
    r = running_sum(df, group_cols, order_cols, {out: F.lit(1.0)}, descending)
    return r.withColumn(out, F.col(out).cast("long"))


def lag(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str], value_col: str, out: str) -> DataFrame:
    """Skew-safe ``lag(value, 1)``: the previous row's value within the group."""
    group_cols = list(group_cols)
    d = _ranged(df, group_cols, order_cols, False)
    w = Window.partitionBy(*group_cols, _BLOCK).orderBy(*_order_exprs(order_cols, False))
    key = F.struct(*[F.col(c) for c in order_cols])
    last = d.groupBy(*group_cols, _BLOCK).agg(F.max(F.struct(key.alias("k"), F.col(value_col).alias("v"))).alias("__last"))
    order = Window.partitionBy(*group_cols).orderBy(_BLOCK)
    prev = last.select(*group_cols, _BLOCK, F.lag("__last.v", 1).over(order).alias("__blkprev"), F.row_number().over(order).alias("__nth"))
    prev = materialize(prev.where("__nth > 1").drop("__nth"))   # fewer rows than partitions
    d = d.withColumns({"__lag": F.lag(value_col, 1).over(w), "__rnb": F.row_number().over(w)})
    d = null_safe_join(d, F.broadcast(prev), [*group_cols, _BLOCK], "left")
    d = d.withColumn(out, F.when(F.col("__rnb") == 1, F.col("__blkprev")).otherwise(F.col("__lag")))
    return d.drop(_BLOCK, "__lag", "__rnb", "__blkprev")


def top_n_per_group(df: DataFrame, group_cols: Iterable[str], order: Sequence[Column],
                    n: int, out: str | None = None) -> DataFrame:
    """First ``n`` rows per group.  ``row_number() <= n`` is planned as a
    WindowGroupLimit, which trims each partition to n rows per group before
    the shuffle, so a hot group costs n rows, not its size."""
    w = Window.partitionBy(*group_cols).orderBy(*order)
    rn = out or "__rn"
    r = df.withColumn(rn, F.row_number().over(w)).where(F.col(rn) <= n)
    return r if out else r.drop(rn)
