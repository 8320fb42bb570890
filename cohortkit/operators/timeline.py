"""Event timelines.

Timelines are long tables ``(id, seq, gap)`` of inter-event gaps (a wide
one is unpivoted by an adapter); cumulative times are skew-safe running sums; the
per-cluster rate table is one aggregation.  (No point-process model is
fitted: the studied analysis computes only these descriptive rates.)
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import windows as Wn
from ..session import broadcast_if_small
from .profile import histogram


def gaps_from_events(events: DataFrame, id_col: str, ts_col: str, tie_col: str,
                     unit_micros: float = 3_600_000_000.0) -> DataFrame:
    """Long gaps ``(id, seq, gap)`` for all events of each entity: gap 1 is
    measured from the earliest time in the table (study start), later gaps
    from the previous event, in ``unit_micros`` units (hours)."""
    r = Wn.row_number(events.select(id_col, ts_col, tie_col), [id_col], [ts_col, tie_col], out="seq")
    prev = Wn.lag(r, [id_col], ["seq"], ts_col, "__prev")
    t0 = events.agg(F.min(ts_col)).scalar()
    start = F.when(F.col("seq") == 1, t0).otherwise(F.col("__prev"))
    gap = F.expr(f"timestampdiff(MICROSECOND, __start, {ts_col})") / F.lit(unit_micros)
    return prev.withColumn("__start", start).select(id_col, F.col("seq").cast("int").alias("seq"), gap.alias("gap"))


def long_from_wide(wide: DataFrame, id_col: str, prefix: str = "time_") -> DataFrame:
    """Adapter: a wide timeline ``(id, time_1, time_2, ..)``, whatever
    ``time_`` columns there are, as long gaps ``(id, seq, gap)``."""
    cols = [c for c in wide.columns if c.startswith(prefix)]
    return (wide.select(id_col, *[F.col(c).cast("double").alias(c[len(prefix):]) for c in cols])
            .unpivot([id_col], [c[len(prefix):] for c in cols], "seq", "gap").withColumn("seq", F.col("seq").cast("int")))


def cumulative_times(gaps: DataFrame, id_col: str) -> DataFrame:
    """``(id, seq, gap, t)`` with t the running sum of gaps; as with numpy
    a null gap makes that and every later time null."""
    r = Wn.running_sum(gaps.select(id_col, "seq", F.col("gap").cast("double").alias("gap")), [id_col], ["seq"],
                       {"__cum": F.coalesce(F.col("gap"), F.lit(0.0)), "__nulls": F.col("gap").isNull().cast("double")})
    return r.withColumn("t", F.when(F.col("__nulls") > 0, F.lit(None)).otherwise(F.col("__cum"))) \
            .drop("__cum", "__nulls")


def event_sequences(gaps: DataFrame, id_col: str, drop_zero_gaps: bool = False) -> tuple[DataFrame, DataFrame]:
    """H1: events = cumulative times > 0 (null never passes); entities with
    none are dropped; ``end_time`` = last event time + 1.  With
    ``drop_zero_gaps`` an event at the time of the one before is left out.
    Returns ``(events (id, seq, t), summary (id, end_time, n_events))``."""
    ct = cumulative_times(gaps, id_col)
    ev = ct.where(F.col("t") > 0)
    if drop_zero_gaps:
        ev = ev.where(F.col("gap") > 0)
    ev = ev.select(id_col, "seq", "t")
    summ = ev.groupBy(id_col).agg((F.max_by("t", "seq") + 1).alias("end_time"),
                                  F.count(F.lit(1)).alias("n_events"))
    return ev, summ


def average_events(summary: DataFrame) -> DataFrame:
    """H2."""
    return summary.agg(F.count(F.lit(1)).alias("n_entities"), F.avg("n_events").alias("avg_events"))


def inter_arrival(events: DataFrame, id_col: str) -> DataFrame:
    """Gap between consecutive event times of an entity (first: none)."""
    r = Wn.lag(events, [id_col], ["seq"], "t", "__prev")
    return r.where(F.col("__prev").isNotNull()).withColumn("gap", F.col("t") - F.col("__prev")).drop("__prev")


def sequences_per_cluster(summary: DataFrame, clusters: DataFrame, id_col: str, cluster: str) -> DataFrame:
    """H3: entities, events and mean events per cluster (entities without a
    cluster label are dropped, J4)."""
    j = summary.join(broadcast_if_small(clusters.select(id_col, cluster)), id_col, "inner")
    return j.groupBy(cluster).agg(F.count(F.lit(1)).alias("n_entities"), F.sum("n_events").alias("n_events"),
                                  F.avg("n_events").alias("mean_events"))


def rate_table(events: DataFrame, summary: DataFrame, clusters: DataFrame, id_col: str, cluster: str) -> DataFrame:
    """H4: per cluster ``event_rate = total events / total end_time`` (0 when
    no time), mean and population std of inter-arrival gaps (0 when none),
    total events and entities."""
    cl = broadcast_if_small(clusters.select(id_col, cluster))
    s = summary.join(cl, id_col, "inner").groupBy(cluster).agg(
        F.sum("n_events").alias("total_events"), F.sum("end_time").alias("total_time"),
        F.count(F.lit(1)).alias("n_patients"))
    g = inter_arrival(events, id_col).join(cl, id_col, "inner").groupBy(cluster).agg(
        F.avg("gap").alias("mean_inter_arrival"), F.stddev_pop("gap").alias("std_inter_arrival"))
    j = s.join(g, cluster, "left")
    return j.select(cluster,
                    F.when(F.col("total_time") > 0, F.col("total_events") / F.col("total_time")).otherwise(0.0).alias("event_rate"),
                    F.coalesce("mean_inter_arrival", F.lit(0.0)).alias("mean_inter_arrival"),
                    F.coalesce("std_inter_arrival", F.lit(0.0)).alias("std_inter_arrival"),
                    "total_events", "n_patients")


def event_histograms(events: DataFrame, clusters: DataFrame, id_col: str, cluster: str, bins: int = 30) -> DataFrame:
    """H5: 30-bin histograms of event times and of gaps per cluster."""
    cl = broadcast_if_small(clusters.select(id_col, cluster))
    times = events.join(cl, id_col).select(cluster, F.col("t").alias("event_time"))
    gaps = inter_arrival(events, id_col).join(cl, id_col).select(cluster, F.col("gap").alias("inter_arrival"))
    return histogram(times, ["event_time"], bins, [cluster]).unionByName(
        histogram(gaps, ["inter_arrival"], bins, [cluster]))
