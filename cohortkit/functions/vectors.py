"""Array (vector) expressions evaluated JVM-side with higher-order functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def vsum(arr) -> Column:
    return F.aggregate(_c(arr), F.lit(0.0), lambda acc, x: acc + x.cast("double"))


def dot(a, b) -> Column:
    return vsum(F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double")))


def sqdist(a, b) -> Column:
    return vsum(F.zip_with(_c(a), _c(b), lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))))


def norm2(a) -> Column:
    return dot(a, a)


def to_double_array(a) -> Column:
    return F.transform(_c(a), lambda x: x.cast("double"))
