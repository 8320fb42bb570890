"""Exact top-k search in Hamming space by incremental multi-index hashing.

A code of b bits is cut into m segments, and a table holds every code under
each (segment, value).  The search radius of the segments grows from 0: in
round s each open query looks up the segment values at exactly s flipped bits, an
equi-join on (segment, value).  After segment j of round s (both from 0) every code within m*s + j
bits has been seen, for one not found differs in more than s bits in segments 0 to j and in s or more in the others.
Segments beyond the k-th distance seen so far are not searched.
A query whose k-th verified distance lies within that bound is done and leaves;
the others go on, so the result is exact.

A pair that several segments find counts once: in its nearest segment, the
first of them.  Codes farther than the k-th seen so far are left out at once.  Equal codes are one entry that carries its k smallest ids.  A
segment value with many entries is dealt into parts of bounded size, each
joined by itself, so a frequent value fills no single task.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import broadcast_if_small
from .common import stored


def sign_codes(df: DataFrame, bits: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, code): bit i is set if component i is >= 0 (null components:
    not), packed into 64-bit words.  Rows whose vector is null or not ``bits`` long, or
    whose id is null, have no code and are left out."""
    words = (bits + 63) // 64
    v = F.col("v")

    def word(w: int):
        n = min(64, bits - 64 * w)
        acc = F.lit(0).cast("long")
        for i in range(n):
            bit = F.lit(1 << i if i < 63 else -(1 << 63)).cast("long")
            acc = acc.bitwiseOR(F.when(F.coalesce(F.get(v, F.lit(i + 64 * w)) >= 0, F.lit(False)), bit).otherwise(F.lit(0).cast("long")))
        return acc

    return (df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
            .where((F.size("v") == bits) & F.col("id").isNotNull())
            .select("id", F.array(*[word(w) for w in range(words)]).alias("code")))


def segment_widths(bits: int, rows: int) -> list[int]:
    """Widths of 4 to 30 bits at which a value holds about 16 codes: looking a
    value up costs more than verifying a few codes."""
    m = max(1, round(bits / min(30, max(4, math.log2(max(2, rows)) - 4))), math.ceil(bits / 30))
    return [bits // m + (i < bits % m) for i in range(m)]


def _segments(words: list[Column], widths: list[int]) -> list[Column]:
    """The values of a code's segments."""
    out, at = [], 0
    for width in widths:
        w, off = divmod(at, 64)
        value = F.shiftrightunsigned(words[w], off)
        if off + width > 64:
            value = value.bitwiseOR(F.shiftleft(words[w + 1], 64 - off))
        out.append(value.bitwiseAND(F.lit((1 << width) - 1).cast("long")))
        at += width
    return out


def _probes(live: DataFrame, segments: Column, widths: list[int], radius: int, wanted: Column) -> DataFrame:
    """The rows of ``live`` with (segment, value): for each wanted segment all values that differ from
    the query's in ``radius`` bits.  Bits are flipped from high to low, so that each value comes once."""
    width = F.element_at(F.array(*[F.lit(w) for w in widths]), F.col("segment") + 1)
    out = live.select("*", F.posexplode(segments).alias("segment", "value")).where(wanted).withColumn("below", width)
    for _ in range(radius):
        out = (out.where("below > 0").select(*live.columns, "segment", "value", F.explode(F.sequence(F.lit(0), F.col("below") - 1)).alias("below"))
               .withColumn("value", F.expr("value ^ shiftleft(1L, below)")))
    return out.drop("below")


def hamming_top_k(codes: DataFrame, queries: DataFrame, bits: int, k: int = 10, index_block: int = 4096) -> DataFrame:
    """The k nearest rows of ``codes`` (id, code) for every row of
    ``queries`` (id, code), exactly: query_id, rank (from 1), id, distance; ties go to
    the smaller id.  A query that is itself among the codes finds itself.
    Repeated ids count as often as they occur; fewer than k codes give fewer
    rows; an empty side gives an empty result."""
    w = Window.partitionBy("code").orderBy("id")
    few = codes.withColumn("r", F.row_number().over(w)).where(F.col("r") <= k)     # at most k a code leave each task
    entries = stored(few.groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids")), "codes")
    have = entries.agg(F.count(F.lit(1)).alias("codes"), F.coalesce(F.sum(F.size("ids")), F.lit(0)).alias("ids")).first()
    enough = min(k, have["ids"])          # ids that a finished query has
    widths = segment_widths(bits, have["codes"])
    m = len(widths)

    def words(*cols: str) -> list[Column]:
        """The words of a code, or of the bits in which two differ."""
        return [reduce(Column.bitwiseXOR, [F.get(c, F.lit(i)) for c in cols]) for i in range((bits + 63) // 64)]

    placed = entries.select(F.col("code").alias("entry"), "ids", F.posexplode(F.array(*_segments(words("code"), widths))).alias("segment", "value"))
    crowded = broadcast_if_small(placed.groupBy("segment", "value").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > index_block)
                                 .select("segment", "value", F.ceil(F.col("n") / index_block).cast("int").alias("parts")))

    def parts(df: DataFrame) -> DataFrame:
        return df.join(crowded, ["segment", "value"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))

    index = stored(parts(placed).withColumn("part", F.pmod(F.hash("entry"), "parts")).drop("parts"), "segments")
    asked = stored(queries.select(F.col("id").alias("query_id"), F.col("code").alias("asked")), "queries")

    differ = [F.bit_count(x) for x in _segments(words("asked", "entry"), widths)]
    nearest = Window.partitionBy("asked").orderBy(F.col("distance").asc_nulls_first(), "id")
    whole = Window.partitionBy("asked")
    live = asked.select("asked", F.lit(bits).alias("limit")).distinct()       # limit: no farther code can be among the k nearest
    carried, done = None, []
    for s in range(max(widths) + 1):
        # later segments need no look: the earlier ones cover the k-th distance seen so far
        probes = _probes(live, F.array(*_segments(words("asked"), widths)), widths, s, F.col("segment") <= F.col("limit") - m * s)
        probes = parts(probes).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
        # merged: the planner prices a table of exploded probes by its few queries and would broadcast it
        pairs = probes.join(index.hint("merge"), ["segment", "value", "part"])
        first = F.coalesce(*[F.when(d == s, F.lit(j)) for j, d in enumerate(differ)])
        new = (pairs.where((reduce(Column.__add__, differ) <= F.col("limit")) & (F.least(*differ, F.lit(bits)) == s) & (first == F.col("segment")))
               .select("asked", F.explode("ids").alias("id"), reduce(Column.__add__, differ).alias("distance")))
        seen = [new, live.select("asked", F.lit(None).cast("long").alias("id"), F.lit(None).cast("int").alias("distance"))]   # rank 0: keeps a query that found nothing
        if carried is not None:
            seen.append(carried)
        best = (reduce(DataFrame.unionByName, seen).withColumn("rank", F.row_number().over(nearest) - 1).where(F.col("rank") <= k)
                .withColumns({"got": F.count("id").over(whole), "far": F.coalesce(F.max("distance").over(whole), F.lit(bits))}))
        full = F.col("got") == enough
        covered = full & ((F.col("far") <= m * (s + 1) - 1) | F.lit(enough == have["ids"]))
        best = stored(best.select("asked", "id", "distance", "rank", F.when(full, F.col("far")).otherwise(bits).alias("limit"), covered.alias("done")), "round")
        done.append(best.where("done AND rank > 0"))
        live, carried = best.where("NOT done AND rank = 0").select("asked", "limit"), best.where("NOT done AND rank > 0").select("asked", "id", "distance")
        if live.isEmpty():
            break
    found = broadcast_if_small(reduce(DataFrame.unionByName, done))
    return asked.join(found, "asked").select("query_id", "rank", "id", "distance")
