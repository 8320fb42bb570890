"""Join helpers."""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where null matches null (null group values are
    groups of their own in grouped results)."""
    keys = list(keys)
    r = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = reduce(lambda a, b: a & b, [left[k].eqNullSafe(r[f"__r_{k}"]) for k in keys])
    return left.join(r, cond, how).drop(*[f"__r_{k}" for k in keys])
