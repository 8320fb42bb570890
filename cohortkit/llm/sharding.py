"""Sharding by a minimax contiguous partition (DataFrame functions only).

Rows with equal texts form an atomic group.  Groups are laid out in the order
of their text key, and the order is cut into ``shards`` contiguous runs so
that the largest run is as small as possible:  a binary search over the shard
capacity, each capacity checked by greedy filling, then cut at the smallest
feasible one.  A group larger than an even share of what is left gets a shard
of its own first (no cut can help it), which leaves the other shards even.

The greedy check needs prefix sums at a few places only.  The driver keeps a
bounded list of known prefix sums and answers "surely feasible", "surely not" or
"open"; open capacities are settled by asking one Spark job for finer buckets of the gaps
that their checks look into.  Each round narrows those by a constant factor, so the
number of jobs is logarithmic and the driver never holds more than a few thousand numbers a round.
"""

from __future__ import annotations

import bisect

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import blocks_for, id_and_text, stored

FINE = 64       # finer buckets of a gap
COARSE = 4096   # buckets of the first round
KEY_BUCKETS = 4096  # three hexadecimal digits of the text key
SPLITS = 16     # buckets that the rows of one key are split into


class _Known:
    """Known prefix sums: sorted ends, and whether unknown ones lie between
    an end and the one before it."""

    def __init__(self, ends, open_):
        self.ends, self.open = ends, open_

    def floor(self, x: int) -> int:
        """Largest known end <= x."""
        return self.ends[bisect.bisect_right(self.ends, x) - 1]

    def ceiling(self, x: int) -> int:
        """Upper bound of the largest true prefix sum <= x."""
        i = bisect.bisect_right(self.ends, x) - 1
        return x if i + 1 < len(self.ends) and self.open[i + 1] else self.ends[i]

    def chain(self, capacity: int, shards: int, at) -> list[int]:
        """Greedy filling: the ends of the shards."""
        out, p = [], 0
        for _ in range(shards):
            p = min(at(p + capacity), self.ends[-1])
            out.append(p)
        return out


def _search(fetch, total: int, largest: int, shards: int) -> list[int]:
    """The greedy ends at the smallest feasible capacity.  ``fetch`` takes
    gaps (p, q, step) and returns, for each run of ``step`` in each gap that holds prefix
    sums, the smallest and the largest of them and their number."""
    def points(cells):
        for low, high, n in cells:              # nothing unknown lies before the smallest
            yield low, False
            if high > low:
                yield high, n > 2

    found = sorted(points(fetch([(0, total, max(1, -(-total // COARSE)))])))
    known = _Known([0] + [e for e, _ in found], [False] + [o for _, o in found])
    lo, hi = max(-(-total // shards), largest), total

    def smallest(at, lo, hi):
        while lo < hi:
            mid = (lo + hi) // 2
            if known.chain(mid, shards, at)[-1] >= total:
                hi = mid
            else:
                lo = mid + 1
        return lo

    while True:
        hi = smallest(known.floor, lo, hi)          # known cuts prove it feasible
        lo = smallest(known.ceiling, lo, hi)        # anything less is proved infeasible
        gaps = set()
        for c in {lo, hi, (lo + hi) // 2, (3 * lo + hi) // 4, (lo + 3 * hi) // 4}:
            for at in (known.floor, known.ceiling):
                p = 0
                for _ in range(shards):             # the gaps that the check of c looks into
                    i = bisect.bisect_right(known.ends, p + c)
                    if i < len(known.ends) and known.open[i]:
                        gaps.add(i)
                    p = at(p + c)
        if not gaps:
            return known.chain(hi, shards, known.floor)
        spans = [(known.ends[i - 1], known.ends[i]) for i in sorted(gaps)]
        new = dict(zip(known.ends, known.open))
        for _, q in spans:
            del new[q]
        new.update(points(fetch([(p, q, max(1, -(-(q - p) // FINE))) for p, q in spans])))
        ends = sorted(new)
        known = _Known(ends, [new[e] for e in ends])


def _cut_ends(prefix: DataFrame, total: int, largest: int, shards: int) -> list[int]:
    """Prefix sums at which to cut.  ``prefix`` has ``end``, the running
    total of each group."""
    def fetch(gaps):
        key, keep = None, F.lit(False)
        for k, (p, q, step) in enumerate(gaps):
            inside = (F.col("end") > p) & (F.col("end") <= q)
            cell = F.floor((F.col("end") - (p + 1)) / F.lit(step)).cast("long") + F.lit(k * (COARSE + 1)).cast("long")
            key = F.when(inside, cell) if key is None else key.when(inside, cell)
            keep = keep | inside
        rows = prefix.where(keep).groupBy(key.alias("b")).agg(F.min("end").alias("low"), F.max("end").alias("high"), F.count("*").alias("n")).collect()
        return [(r["low"], r["high"], r["n"]) for r in rows]

    return _search(fetch, total, largest, shards)


def _running(df: DataFrame, sums: dict[str, Column], order: list[str], within: list[str] = ()) -> DataFrame:
    """Running totals in the order (within, __bucket, order): a window in
    each bucket, and the totals of the buckets before.  There are KEY_BUCKETS *
    SPLITS buckets at most (for each value of ``within``)."""
    keys = [*within, "__bucket"]
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    tot = df.groupBy(*keys).agg(*[F.sum(e).alias(f"__t_{k}") for k, e in sums.items()])
    before = Window.partitionBy(*within).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    off = tot.select(*keys, *[F.coalesce(F.sum(f"__t_{k}").over(before), F.lit(0)).alias(f"__o_{k}") for k in sums])
    d = df.join(F.broadcast(off), keys)
    return d.select(*[c for c in d.columns if not c.startswith("__")],
                    *[(F.sum(e).over(w) + F.col(f"__o_{k}")).alias(k) for k, e in sums.items()])


def _key_bucket() -> Column:
    """Leading digits of the text key, which is a hash: buckets of like size
    in the order of the key."""
    return F.conv(F.substring("text_key", 1, 3), 16, 10).cast("int")


def shard_documents(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text", rows_per_file: int = 250_000) -> DataFrame:
    """Shard and slot of every row.

    Size of a row: UTF-8 bytes of its text (null: none) plus 1.  Equal texts
    stay together; a null text is one group, the empty text another.  Rows
    without id and repeated rows are placed like any other.  An empty table
    gives an empty result.  Returns doc_id, size, text_crc32, shard, slot
    (gapless from 0 in each shard); columns with other names are ignored."""
    text = F.col("text")
    rows = id_and_text(docs, id_col, text_col).select(
        "doc_id", (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.coalesce(F.sha2(text, 256), F.lit("fff null")).alias("text_key"))
    rows = stored(rows, "shard-rows")
    files = blocks_for(rows.count(), rows_per_file)          # small tables in few files
    groups = rows.groupBy("text_key").agg(F.sum("size").alias("bytes"))
    groups = stored(groups.coalesce(files), "shard-groups")
    top = groups.orderBy(F.desc("bytes"), "text_key").limit(shards).collect()
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    alone, left = [], total
    while len(alone) < shards - 1 and len(alone) < len(top) and top[len(alone)]["bytes"] * (shards - len(alone)) > left:
        left -= top[len(alone)]["bytes"]
        alone.append(top[len(alone)])
    own = [r["text_key"] for r in alone]
    cuts: list[str] = []
    rest = shards - len(own)
    if left > 0 and rest > 1:
        free = groups.where(~F.col("text_key").isin(own)) if own else groups
        prefix = _running(free.withColumn("__bucket", _key_bucket()), {"end": F.col("bytes")}, ["text_key"])
        prefix = stored(prefix.coalesce(files), "shard-prefix")
        ends = _cut_ends(prefix.select("end", "bytes"), left, top[len(own)]["bytes"], rest)
        inner = sorted({e for e in ends[:-1] if 0 < e < left})
        cuts = [r["text_key"] for r in prefix.where(F.col("end").isin(inner)).select("text_key").collect()]
    key = F.col("text_key")
    run = F.lit(len(own))
    for c in cuts:
        run = run + (key > F.lit(c)).cast("int")
    for i, k in enumerate(own):
        run = F.when(key == F.lit(k), F.lit(i)).otherwise(run)
    # a large group is split by a hash of the id, so that no task numbers all of it
    bucket = _key_bucket() * SPLITS + F.pmod(F.xxhash64("doc_id"), F.lit(SPLITS)).cast("int")
    placed = rows.withColumn("shard", run.cast("int")).withColumn("__bucket", bucket)
    placed = _running(placed, {"n": F.lit(1)}, ["text_key", "doc_id"], ["shard"])
    return placed.select("doc_id", "size", "text_crc32", "shard", (F.col("n") - 1).cast("long").alias("slot"))
