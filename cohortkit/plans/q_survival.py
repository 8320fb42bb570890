"""Survival and event-timeline queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import survival as Sv
from ..operators import timeline as Tl
from ..session import table
from .common import SQL_USER_DURATIONS, r, user_durations
from .registry import register

_ET_SQL = f"""{SQL_USER_DURATIONS},
et AS (SELECT grp, duration AS t, count(*) AS n_removed, CAST(sum(event) AS BIGINT) AS n_events FROM durations GROUP BY 1, 2),
et2 AS (SELECT *, n_removed - n_events AS n_censored,
  CAST(sum(n_removed) OVER (PARTITION BY grp ORDER BY t DESC ROWS UNBOUNDED PRECEDING) AS BIGINT) AS n_at_risk FROM et),
km AS (SELECT grp, t, product(1 - n_events / n_at_risk) OVER (PARTITION BY grp ORDER BY t ROWS UNBOUNDED PRECEDING) AS survival FROM et2)"""


@register("v1_event_table", sql=f"WITH {_ET_SQL} SELECT grp, t, n_removed, n_events, n_censored, n_at_risk FROM et2")
def v1_event_table(spark, sf):
    return Sv.event_table(user_durations(spark, sf), "duration", "event", ["grp"])


@register("v2_kaplan_meier", sql=f"WITH {_ET_SQL} SELECT grp, t, round(survival, 9) AS survival FROM km")
def v2_kaplan_meier(spark, sf):
    km = Sv.kaplan_meier(user_durations(spark, sf), "duration", "event", ["grp"])
    return km.select("grp", "t", r("survival", 9).alias("survival"))


@register("v3_median_survival", sql=f"""
WITH {_ET_SQL} SELECT g.grp, m.median_time FROM (SELECT DISTINCT grp FROM km) g
LEFT JOIN (SELECT grp, min(t) AS median_time FROM km WHERE survival <= 0.5 GROUP BY grp) m ON g.grp = m.grp""")
def v3_median_survival(spark, sf):
    km = Sv.kaplan_meier(user_durations(spark, sf), "duration", "event", ["grp"])
    return Sv.median_survival(km, ["grp"])


def _cox_frame(spark, sf):
    d = user_durations(spark, sf)
    v = table(spark, sf, "events").groupBy("user_id").agg(F.avg("value").alias("avg_value"))
    return Sv.survival_frame(v, "user_id", d, "grp", levels=[0, 1, 2, 3])


@register("v4_cox_ph")
def v4_cox_ph(spark, sf):
    """Rows-only: Newton-fitted coefficients (invariants in tests)."""
    return Sv.cox_ph(_cox_frame(spark, sf), "duration", "event", ["grp_1", "grp_2", "grp_3", "avg_value"], penalizer=0.1)


_BETA = [0.2, -0.1, 0.3, 0.05]


@register("v5_predicted_survival", sql=f"""
WITH {SQL_USER_DURATIONS}, f AS (SELECT d.*, v.avg_value, CAST(grp = 1 AS INTEGER) AS grp_1, CAST(grp = 2 AS INTEGER) AS grp_2,
  CAST(grp = 3 AS INTEGER) AS grp_3 FROM durations d JOIN (SELECT user_id, avg(value) AS avg_value FROM events GROUP BY 1) v USING (user_id)),
m AS (SELECT avg(grp_1) AS m1, avg(grp_2) AS m2, avg(grp_3) AS m3, avg(avg_value) AS mv FROM f),
pt AS (SELECT duration AS t, sum(event) AS d, sum(exp(0.2 * (grp_1 - m1) + -0.1 * (grp_2 - m2) + 0.3 * (grp_3 - m3) + 0.05 * (avg_value - mv))) AS w FROM f, m GROUP BY 1),
rs AS (SELECT *, sum(w) OVER (ORDER BY t DESC ROWS UNBOUNDED PRECEDING) AS risk FROM pt),
h AS (SELECT *, sum(CASE WHEN d > 0 THEN d / risk ELSE 0 END) OVER (ORDER BY t ROWS UNBOUNDED PRECEDING) AS H0 FROM rs),
p AS (SELECT 'cluster_' || CAST(k AS VARCHAR) AS profile,
  0.2 * ((CASE WHEN k = 1 THEN 1 ELSE 0 END) - m1) + -0.1 * ((CASE WHEN k = 2 THEN 1 ELSE 0 END) - m2)
  + 0.3 * ((CASE WHEN k = 3 THEN 1 ELSE 0 END) - m3) AS xb FROM range(4) t(k), m)
SELECT p.profile, h.t, round(exp(-h.H0 * exp(p.xb)), 9) AS survival FROM h, p WHERE h.d > 0""")
def v5_predicted_survival(spark, sf):
    cov = ["grp_1", "grp_2", "grp_3", "avg_value"]
    profiles = [(f"cluster_{k}", {f"grp_{j}": (1.0 if j == k else 0.0) for j in (1, 2, 3)}) for k in range(4)]
    s = Sv.breslow_survival(_cox_frame(spark, sf), "duration", "event", cov, _BETA, profiles)
    return s.select("profile", "t", r("survival", 9).alias("survival"))


@register("v6_survival_frame", sql=f"""
WITH {SQL_USER_DURATIONS} SELECT d.user_id, v.avg_value, d.duration, d.event, CAST(grp = 1 AS INTEGER) AS grp_1,
  CAST(grp = 2 AS INTEGER) AS grp_2, CAST(grp = 3 AS INTEGER) AS grp_3
FROM durations d JOIN (SELECT user_id, round(avg(value), 6) AS avg_value FROM events GROUP BY 1) v USING (user_id)""")
def v6_survival_frame(spark, sf):
    return _cox_frame(spark, sf).withColumn("avg_value", r("avg_value"))


# ---- timelines ---------------------------------------------------------------

def _gaps(spark, sf):
    e = table(spark, sf, "events")
    g = Tl.gaps_from_events(e, "user_id", "ts", "event_id")
    # interrupted timelines, the same way in both engines
    return g.withColumn("gap", F.when((F.col("user_id") % 9 == 0) & (F.col("seq") == 5), None).otherwise(F.col("gap")))


_TL_SQL = """e AS (SELECT user_id, ts, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS seq,
  lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events),
g0 AS (SELECT user_id, CAST(seq AS INTEGER) AS seq, (epoch_us(ts) - epoch_us(CASE WHEN seq = 1 THEN (SELECT min(ts) FROM events) ELSE prev END)) / 3600000000.0 AS gap
  FROM e),
l AS (SELECT user_id, seq, CASE WHEN user_id % 9 = 0 AND seq = 5 THEN NULL ELSE gap END AS gap FROM g0),
ct AS (SELECT *, CASE WHEN sum(CASE WHEN gap IS NULL THEN 1 ELSE 0 END) OVER w > 0 THEN NULL ELSE sum(coalesce(gap, 0)) OVER w END AS t
  FROM l WINDOW w AS (PARTITION BY user_id ORDER BY seq ROWS UNBOUNDED PRECEDING)),
ev AS (SELECT user_id, seq, t FROM ct WHERE t > 0),
su AS (SELECT user_id, arg_max(t, seq) + 1 AS end_time, count(*) AS n_events FROM ev GROUP BY user_id),
ia AS (SELECT user_id, seq, t, t - lag(t) OVER (PARTITION BY user_id ORDER BY seq) AS gap FROM ev),
cl AS (SELECT c_custkey AS user_id, CAST(c_nationkey % 4 AS INTEGER) AS cluster FROM customer)"""


def _clusters(spark, sf):
    c = table(spark, sf, "customer")
    return c.select(F.col("c_custkey").alias("user_id"), (F.col("c_nationkey") % 4).cast("int").alias("cluster"))


@register("w2_cumulative_times", sql=f"WITH {_TL_SQL} SELECT user_id, seq, round(gap, 6) AS gap, round(t, 6) AS t FROM ct")
def w2_cumulative_times(spark, sf):
    c = Tl.cumulative_times(_gaps(spark, sf), "user_id")
    return c.select("user_id", "seq", r("gap").alias("gap"), r("t").alias("t"))


@register("h1_event_sequences", sql=f"WITH {_TL_SQL} SELECT user_id, seq, round(t, 6) AS t FROM ev")
def h1_event_sequences(spark, sf):
    ev, _ = Tl.event_sequences(_gaps(spark, sf), "user_id")
    return ev.select("user_id", "seq", r("t").alias("t"))


@register("h1_sequences_without_zero_gaps", sql=f"""
WITH {_TL_SQL}, z AS (SELECT ct.user_id, ct.seq, ct.t FROM ct WHERE t > 0 AND gap > 0) SELECT user_id, seq, round(t, 6) AS t FROM z""")
def h1_sequences_without_zero_gaps(spark, sf):
    """H1 with ``drop_zero_gaps``: events at the time of the one before are left out."""
    ev, _ = Tl.event_sequences(_gaps(spark, sf), "user_id", drop_zero_gaps=True)
    return ev.select("user_id", "seq", r("t").alias("t"))


@register("h1_sequence_summary", sql=f"WITH {_TL_SQL} SELECT user_id, round(end_time, 6) AS end_time, n_events FROM su")
def h1_sequence_summary(spark, sf):
    _, su = Tl.event_sequences(_gaps(spark, sf), "user_id")
    return su.select("user_id", r("end_time").alias("end_time"), "n_events")


@register("h2_average_events", sql=f"WITH {_TL_SQL} SELECT count(*) AS n_entities, round(avg(n_events), 6) AS avg_events FROM su")
def h2_average_events(spark, sf):
    _, su = Tl.event_sequences(_gaps(spark, sf), "user_id")
    return Tl.average_events(su).select("n_entities", r("avg_events").alias("avg_events"))


@register("w4_inter_arrival", sql=f"WITH {_TL_SQL} SELECT user_id, seq, round(t, 6) AS t, round(gap, 6) AS gap FROM ia WHERE gap IS NOT NULL")
def w4_inter_arrival(spark, sf):
    ev, _ = Tl.event_sequences(_gaps(spark, sf), "user_id")
    g = Tl.inter_arrival(ev, "user_id")
    return g.select("user_id", "seq", r("t").alias("t"), r("gap").alias("gap"))


@register("h3_sequences_per_cluster", sql=f"""
WITH {_TL_SQL} SELECT cluster, count(*) AS n_entities, CAST(sum(n_events) AS BIGINT) AS n_events, round(avg(n_events), 6) AS mean_events
FROM su JOIN cl USING (user_id) GROUP BY cluster""")
def h3_sequences_per_cluster(spark, sf):
    _, su = Tl.event_sequences(_gaps(spark, sf), "user_id")
    s = Tl.sequences_per_cluster(su, _clusters(spark, sf), "user_id", "cluster")
    return s.select("cluster", "n_entities", "n_events", r("mean_events").alias("mean_events"))


@register("h4_rate_table", sql=f"""
WITH {_TL_SQL}, s AS (SELECT cluster, CAST(sum(n_events) AS BIGINT) AS total_events, sum(end_time) AS total_time, count(*) AS n_patients
  FROM su JOIN cl USING (user_id) GROUP BY cluster),
gg AS (SELECT cluster, avg(gap) AS m, stddev_pop(gap) AS sd FROM ia JOIN cl USING (user_id) WHERE gap IS NOT NULL GROUP BY cluster)
SELECT s.cluster, round(CASE WHEN total_time > 0 THEN total_events / total_time ELSE 0 END, 9) AS event_rate,
  round(coalesce(gg.m, 0), 6) AS mean_inter_arrival, round(coalesce(gg.sd, 0), 6) AS std_inter_arrival, total_events, n_patients
FROM s LEFT JOIN gg USING (cluster)""")
def h4_rate_table(spark, sf):
    ev, su = Tl.event_sequences(_gaps(spark, sf), "user_id")
    t = Tl.rate_table(ev, su, _clusters(spark, sf), "user_id", "cluster")
    return t.select("cluster", r("event_rate", 9).alias("event_rate"), r("mean_inter_arrival").alias("mean_inter_arrival"),
                    r("std_inter_arrival").alias("std_inter_arrival"), "total_events", "n_patients")


@register("h5_event_histograms", sql=f"""
WITH {_TL_SQL}, lv AS (SELECT cluster, 'event_time' AS variable, t AS value FROM ev JOIN cl USING (user_id)
  UNION ALL SELECT cluster, 'inter_arrival', gap FROM ia JOIN cl USING (user_id) WHERE gap IS NOT NULL),
mm AS (SELECT cluster, variable, min(value) AS mn, max(value) AS mx FROM lv GROUP BY 1, 2),
p AS (SELECT cluster, variable, mn, CASE WHEN mx > mn THEN (mx - mn) / 30 ELSE 1.0 END AS w FROM mm),
b AS (SELECT lv.cluster, lv.variable, mn, w, CAST(LEAST(floor((value - mn) / w), 29) AS INTEGER) AS bin FROM lv JOIN p USING (cluster, variable))
SELECT cluster, variable, bin, round(mn + bin * w, 6) AS lower, round(mn + (bin + 1) * w, 6) AS upper, count(*) AS count FROM b GROUP BY cluster, variable, bin, mn, w""")
def h5_event_histograms(spark, sf):
    ev, _ = Tl.event_sequences(_gaps(spark, sf), "user_id")
    h = Tl.event_histograms(ev, _clusters(spark, sf), "user_id", "cluster")
    return h.select("cluster", "variable", "bin", r("lower").alias("lower"), r("upper").alias("upper"), "count")
