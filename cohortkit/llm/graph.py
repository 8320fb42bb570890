"""Connected components by alternating large-star and small-star steps.

Every step is a grouped minimum and an equi-join on the edge table; the edge
table is written to the shared folder after each round.  A hub's neighbours
are never gathered into one row: only its minimum is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return moved.union(low.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of the edge list (u, v): ``root`` is the
    smallest node reachable.  Self-loops and repeated edges are allowed; an
    empty edge list gives an empty result."""
    e = stored(edges.select(F.col("u"), F.col("v")).where("u <> v").distinct(), "edges")
    mark = None
    for _ in range(max_rounds):
        e = stored(_small_star(_large_star(e)), "edges")
        row = e.agg(F.count("*").alias("n"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40))).alias("h")).first()
        if (row["n"], row["h"]) == mark:
            break
        mark = (row["n"], row["h"])
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
