"""Profiling, Table 1, tests and cluster-quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import groups as G
from ..operators import profile as Pr
from ..operators import sketches as Sk
from ..operators import stats as St
from ..operators import table1 as T1
from ..session import table
from .common import SQL_GRADED_ORDERS, graded_orders, r
from .q_linkage import _J10_SQL, _J6_SQL, _j10, _pairs
from .registry import register


def _union_sql(cols, src, cast="VARCHAR", keys=""):
    k = f"{keys}, " if keys else ""
    return " UNION ALL ".join(f"SELECT {k}'{c}' AS variable, CAST({c} AS {cast}) AS value FROM {src}" for c in cols)


# ---- lineitem with injected nulls -------------------------------------------

def _li_nulls(spark, sf):
    li = table(spark, sf, "lineitem")
    k = F.col("l_orderkey")
    return li.withColumn("l_quantity", F.when(k % 7 == 0, None).otherwise(F.col("l_quantity"))) \
             .withColumn("l_returnflag", F.when(k % 13 == 0, None).otherwise(F.col("l_returnflag")))


_LI_NULLS = """t AS (SELECT * REPLACE (CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_quantity END AS l_quantity,
  CASE WHEN l_orderkey % 13 = 0 THEN NULL ELSE l_returnflag END AS l_returnflag) FROM lineitem)"""
_A2_COLS = ["l_orderkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate"]


@register("a1_shape", sql="""
SELECT 'n_rows' AS metric, count(*) AS value FROM lineitem
UNION ALL SELECT 'n_columns', count(*) FROM information_schema.columns WHERE table_name = 'lineitem'
UNION ALL SELECT 'n_' || kind, count(*) FROM (SELECT CASE WHEN data_type IN ('BIGINT', 'INTEGER', 'DOUBLE') THEN 'numeric'
  WHEN data_type LIKE 'TIMESTAMP%' OR data_type = 'DATE' THEN 'datetime' WHEN data_type = 'VARCHAR' THEN 'string' ELSE 'other' END AS kind
  FROM information_schema.columns WHERE table_name = 'lineitem') GROUP BY kind""")
def a1_shape(spark, sf):
    return Pr.shape(table(spark, sf, "lineitem"))


@register("a2_column_profile", sql=f"WITH {_LI_NULLS} " + " UNION ALL ".join(
    f"SELECT '{c}' AS variable, count(*) - count({c}) AS n_null, round((count(*) - count({c})) * 100.0 / count(*), 6) AS null_pct, "
    f"count(DISTINCT {c}) + CASE WHEN count(*) > count({c}) THEN 1 ELSE 0 END AS n_unique FROM t" for c in _A2_COLS))
def a2_column_profile(spark, sf):
    p = Pr.column_profile(_li_nulls(spark, sf), _A2_COLS)
    return p.select("variable", "n_null", r("null_pct").alias("null_pct"), "n_unique")


@register("a3_missing_report", sql=f"WITH {_LI_NULLS} SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS variable, count(*) - count({c}) AS n_null, round((count(*) - count({c})) * 100.0 / count(*), 6) AS null_pct FROM t"
    for c in _A2_COLS) + ") WHERE n_null > 0")
def a3_missing_report(spark, sf):
    return Pr.missing_report(_li_nulls(spark, sf), _A2_COLS).withColumn("null_pct", r("null_pct"))


_A4_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_A4_LV = f"{_LI_NULLS}, lv AS ({_union_sql(_A4_COLS, 't', 'DOUBLE')})"
_A4_OUT = ["variable", "count", "null_count", "mean", "std", "min", "p25", "p50", "p75", "max"]


def _a4(spark, sf, flavour):
    d = Pr.describe(_li_nulls(spark, sf), _A4_COLS, flavour)
    return d.select("variable", "count", "null_count", *[r(c, 9 if c == "mean" else 6).alias(c) for c in _A4_OUT[3:]])


@register("a4_describe_pandas", sql=f"""
WITH {_A4_LV}
SELECT variable, count(value) AS count, count(*) - count(value) AS null_count, round(avg(value), 9) AS mean,
  round(stddev_samp(value), 6) AS std, round(min(value), 6) AS min, round(quantile_cont(value, 0.25), 6) AS p25,
  round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.75), 6) AS p75, round(max(value), 6) AS max
FROM lv GROUP BY variable""")
def a4_describe_pandas(spark, sf):
    return _a4(spark, sf, "pandas")


@register("a4_describe_polars", sql=f"""
WITH {_A4_LV},
s AS (SELECT variable, value, row_number() OVER (PARTITION BY variable ORDER BY value) - 1 AS rn,
  count(*) OVER (PARTITION BY variable) AS n FROM lv WHERE value IS NOT NULL)
SELECT a.variable, a.count, a.null_count, a.mean, a.std, a.min, q.p25, q.p50, q.p75, a.max FROM (
  SELECT variable, count(value) AS count, count(*) - count(value) AS null_count, round(avg(value), 9) AS mean,
  round(stddev_samp(value), 6) AS std, round(min(value), 6) AS min, round(max(value), 6) AS max FROM lv GROUP BY variable) a
JOIN (SELECT variable, round(max(CASE WHEN rn = floor((n - 1) * 0.25 + 0.5) THEN value END), 6) AS p25,
  round(max(CASE WHEN rn = floor((n - 1) * 0.5 + 0.5) THEN value END), 6) AS p50,
  round(max(CASE WHEN rn = floor((n - 1) * 0.75 + 0.5) THEN value END), 6) AS p75 FROM s GROUP BY variable) q USING (variable)""")
def a4_describe_polars(spark, sf):
    return _a4(spark, sf, "polars")


_A5_LV = _union_sql(["c_mktsegment", "c_nationkey"], "customer")


@register("a5_value_counts_top", sql=f"""
SELECT * FROM (SELECT variable, value, count, row_number() OVER (PARTITION BY variable ORDER BY count DESC, value NULLS FIRST) AS rank
FROM (SELECT variable, value, count(*) AS count FROM ({_A5_LV}) GROUP BY 1, 2)) WHERE rank <= 3""")
def a5_value_counts_top(spark, sf):
    return Pr.value_counts(table(spark, sf, "customer"), ["c_mktsegment", "c_nationkey"], top_n=3)


@register("a6_share", sql="""
SELECT c_mktsegment, count(*) AS count, round(count(*) / (SELECT count(*) FROM customer), 6) AS share FROM customer GROUP BY 1""")
def a6_share(spark, sf):
    c = table(spark, sf, "customer").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("count"))
    return Pr.with_share(c).withColumn("share", r("share"))


def _a7_input(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderstatus", "o_orderpriority", (F.col("o_custkey") % 10).alias("cust_bucket"),
                    (F.col("o_orderkey") % 3).alias("k3"))


@register("a7_imbalance", sql="""
WITH o AS (SELECT o_orderstatus, o_orderpriority, o_custkey % 10 AS cust_bucket, o_orderkey % 3 AS k3 FROM orders),
lv AS (SELECT 'o_orderstatus' AS variable, CAST(o_orderstatus AS VARCHAR) AS value FROM o UNION ALL
  SELECT 'o_orderpriority', o_orderpriority FROM o UNION ALL SELECT 'cust_bucket', CAST(cust_bucket AS VARCHAR) FROM o
  UNION ALL SELECT 'k3', CAST(k3 AS VARCHAR) FROM o),
c AS (SELECT variable, value, count(*) AS n FROM lv WHERE value IS NOT NULL GROUP BY 1, 2),
m AS (SELECT variable, max(n * 1.0 / tot) AS max_share FROM (SELECT *, sum(n) OVER (PARTITION BY variable) AS tot FROM c) GROUP BY variable)
SELECT variable, round(max_share, 6) AS max_share, rank FROM (SELECT *, row_number() OVER (ORDER BY max_share DESC, variable) AS rank FROM m) WHERE rank <= 3""")
def a7_imbalance(spark, sf):
    i = Pr.imbalance(_a7_input(spark, sf), ["o_orderstatus", "o_orderpriority", "cust_bucket", "k3"])
    return i.select("variable", r("max_share").alias("max_share"), "rank")


@register("a8_common_levels", sql=f"""
WITH c AS (SELECT variable, value, count(*) AS count FROM ({_A5_LV}) WHERE value IS NOT NULL GROUP BY 1, 2),
a AS (SELECT variable, value AS most_common, count AS most_count FROM (SELECT *, row_number() OVER (PARTITION BY variable ORDER BY count DESC, value) AS rn FROM c) WHERE rn = 1),
b AS (SELECT variable, value AS least_common, count AS least_count FROM (SELECT *, row_number() OVER (PARTITION BY variable ORDER BY count, value DESC) AS rn FROM c) WHERE rn = 1)
SELECT * FROM a JOIN b USING (variable)""")
def a8_common_levels(spark, sf):
    return Pr.common_levels(table(spark, sf, "customer"), ["c_mktsegment", "c_nationkey"])


_A14_IN = "cu AS (SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal, c_mktsegment FROM customer)"
_A14_COLS = [("c_custkey", True), ("c_name", False), ("c_nationkey", True), ("c_acctbal", True), ("c_mktsegment", False)]


def _a14_input(spark, sf):
    c = table(spark, sf, "customer")
    return c.withColumn("c_acctbal", F.when(F.col("c_custkey") % 7 == 0, None).otherwise(F.col("c_acctbal")))


def _a14_sql():
    parts = []
    for c, num in _A14_COLS:
        kind = "numeric" if num else "string"
        order = f"{c}" if num else f"CAST({c} AS VARCHAR)"
        parts.append(f"""SELECT '{c}' AS variable, '{kind}' AS kind, count({c}) AS non_null, count(*) - count({c}) AS "null",
  CAST(min({c}) AS VARCHAR) AS min, CAST(max({c}) AS VARCHAR) AS max,
  (SELECT string_agg(CAST(v AS VARCHAR), '|' ORDER BY v) FROM (SELECT DISTINCT {order} AS v FROM cu WHERE {c} IS NOT NULL ORDER BY v LIMIT 5)) AS examples
  FROM cu""")
    return f"WITH {_A14_IN} " + " UNION ALL ".join(parts)


@register("a14_table_summary", sql=_a14_sql())
def a14_table_summary(spark, sf):
    s, _ = Pr.table_summary(_a14_input(spark, sf))
    return s.withColumn("examples", F.array_join("examples", "|"))


@register("a14_levels", sql=f"""
WITH {_A14_IN} SELECT 'c_name' AS variable, c_name AS level, count(*) AS count FROM cu GROUP BY 2
UNION ALL SELECT 'c_mktsegment', c_mktsegment, count(*) FROM cu GROUP BY 2""")
def a14_levels(spark, sf):
    _, lv = Pr.table_summary(_a14_input(spark, sf))
    return lv


@register("a21_iqr_outliers", sql=f"""
WITH {_A4_LV},
q AS (SELECT variable, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM lv WHERE value IS NOT NULL GROUP BY variable),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM q),
j AS (SELECT lv.variable, value, q1, q3, lower, upper, value < lower OR value > upper AS out FROM lv JOIN f USING (variable) WHERE value IS NOT NULL)
SELECT variable, round(q1, 6) AS q1, round(q3, 6) AS q3, round(lower, 6) AS lower, round(upper, 6) AS upper, count(*) AS n,
  count_if(out) AS n_outliers, round(min(CASE WHEN out THEN value END), 6) AS outlier_min,
  round(max(CASE WHEN out THEN value END), 6) AS outlier_max, round(count_if(out) * 100.0 / count(*), 6) AS outlier_pct
FROM j GROUP BY variable, q1, q3, lower, upper""")
def a21_iqr_outliers(spark, sf):
    o = Pr.iqr_outliers(_li_nulls(spark, sf), _A4_COLS)
    return o.select("variable", *[r(c).alias(c) for c in ["q1", "q3", "lower", "upper"]], "n", "n_outliers",
                    r("outlier_min").alias("outlier_min"), r("outlier_max").alias("outlier_max"),
                    r("outlier_pct").alias("outlier_pct"))


@register("a22_histogram", sql=f"""
WITH {_LI_NULLS}, lv AS ({_union_sql(['l_quantity', 'l_extendedprice'], 't', 'DOUBLE')}),
v AS (SELECT * FROM lv WHERE value IS NOT NULL),
mm AS (SELECT variable, min(value) AS mn, max(value) AS mx FROM v GROUP BY variable),
p AS (SELECT variable, mn, CASE WHEN mx - mn <= 100 THEN 1.0 WHEN mx - mn > 0 THEN (mx - mn) / 30 ELSE 1.0 END AS w,
  CASE WHEN mx - mn <= 100 THEN CAST(floor(mx - mn) AS INTEGER) + 1 ELSE 30 END AS nb FROM mm),
b AS (SELECT v.variable, mn, w, CAST(LEAST(floor((value - mn) / w), nb - 1) AS INTEGER) AS bin FROM v JOIN p USING (variable))
SELECT variable, bin, round(mn + bin * w, 6) AS lower, round(mn + (bin + 1) * w, 6) AS upper, count(*) AS count FROM b GROUP BY variable, bin, mn, w""")
def a22_histogram(spark, sf):
    h = Pr.histogram(_li_nulls(spark, sf), ["l_quantity", "l_extendedprice"], bins=30, unit_width_if_range_le=100)
    return h.select("variable", "bin", r("lower").alias("lower"), r("upper").alias("upper"), "count")


_KDE_SQL = """v AS (SELECT l_quantity AS v FROM lineitem WHERE l_quantity IS NOT NULL AND NOT isnan(l_quantity)),
st AS (SELECT count(*) AS n, stddev_samp(v) AS sd, min(v) AS mn, max(v) AS mx, stddev_samp(v) * pow(count(*), -0.2) AS h FROM v),
d AS (SELECT v, count(*) AS w FROM v GROUP BY v),
g AS (SELECT CAST(range AS INTEGER) AS i, st.mn + range * ((st.mx - st.mn) / 999) AS x FROM range(1000), st),
k AS (SELECT g.i, g.x, sum(d.w * exp(-0.5 * ((g.x - d.v) / st.h) * ((g.x - d.v) / st.h))) / (st.n * st.h * sqrt(2 * pi())) AS density
  FROM g, d, st GROUP BY g.i, g.x, st.n, st.h)"""


@register("a23_kde_grid", sql=f"WITH {_KDE_SQL} SELECT i, round(x, 6) AS x, round(density, 9) AS density FROM k")
def a23_kde_grid(spark, sf):
    dens, _ = Pr.kde_grid(table(spark, sf, "lineitem"), "l_quantity")
    return dens.select("i", r("x").alias("x"), r("density", 9).alias("density"))


@register("a23_kde_top25_span", sql=f"""
WITH {_KDE_SQL}, c AS (SELECT *, sum(density) OVER (ORDER BY density DESC, i ROWS UNBOUNDED PRECEDING) / (SELECT sum(density) FROM k) AS cum FROM k)
SELECT round(coalesce(min(x), (SELECT mn FROM st)), 6) AS top25_min, round(coalesce(max(x), (SELECT mn FROM st)), 6) AS top25_max,
  count(*) AS n_points FROM c WHERE cum <= 0.25""")
def a23_kde_top25_span(spark, sf):
    _, span = Pr.kde_grid(table(spark, sf, "lineitem"), "l_quantity")
    return span.select(r("top25_min").alias("top25_min"), r("top25_max").alias("top25_max"), "n_points")


@register("a2_a4_sketch_profile")
def a2_a4_sketch_profile(spark, sf):
    """A2 and A4 from sketches: one table for each return flag, merged over them."""
    li = table(spark, sf, "lineitem")
    parts = Sk.sketch_table(li, ["l_orderkey", "l_quantity", "l_extendedprice", "l_linestatus"], ["l_returnflag"])
    return Sk.profile(Sk.merge(parts.drop("l_returnflag")))


@register("a24_five_numbers_by_class", sql=f"""
WITH {_LI_NULLS}, lv AS ({_union_sql(['l_quantity', 'l_extendedprice'], 't', 'DOUBLE', 'l_returnflag')})
SELECT l_returnflag, variable, round(min(value), 6) AS min, round(quantile_cont(value, 0.25), 6) AS q1,
  round(quantile_cont(value, 0.5), 6) AS median, round(quantile_cont(value, 0.75), 6) AS q3, round(max(value), 6) AS max
FROM lv WHERE value IS NOT NULL GROUP BY 1, 2""")
def a24_five_numbers_by_class(spark, sf):
    f = Pr.five_number_by_class(_li_nulls(spark, sf), ["l_quantity", "l_extendedprice"], "l_returnflag")
    return f.select("l_returnflag", "variable", *[r(c).alias(c) for c in ["min", "q1", "median", "q3", "max"]])


@register("a25_label_coverage", sql=f"""
WITH {_J6_SQL}, c AS (SELECT label, count(*) AS n_pairs FROM p GROUP BY label),
e AS (SELECT CAST(range AS INTEGER) AS label FROM range(12))
SELECT e.label, coalesce(c.n_pairs, 0) AS n_pairs, round(coalesce(c.n_pairs, 0) / (SELECT count(*) FROM p), 6) AS share,
  coalesce(c.n_pairs, 0) = 0 AS missing FROM e LEFT JOIN c USING (label)""")
def a25_label_coverage(spark, sf):
    expected = spark.range(12).select(F.col("id").cast("int").alias("label"))
    return Pr.label_coverage(_pairs(spark, sf), "label", expected).withColumn("share", r("share"))


# ---- Table 1 ---------------------------------------------------------------

def _t1_input(spark, sf):
    c = table(spark, sf, "customer")
    n = table(spark, sf, "nation")
    k = F.col("c_custkey")
    j = c.join(n, c.c_nationkey == n.n_nationkey, "left")
    return j.select(F.when(k % 7 == 0, None).otherwise(F.col("c_mktsegment")).alias("segment"),
                    F.when(k % 11 == 0, None).otherwise(F.col("c_acctbal")).alias("acctbal"),
                    F.when(k % 13 == 0, "").when(k % 17 == 0, None).otherwise(F.col("n_name")).alias("nation"))


_T1_IN = """d AS (SELECT CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_mktsegment END AS segment,
  CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_acctbal END AS acctbal,
  CASE WHEN c_custkey % 13 = 0 THEN '' WHEN c_custkey % 17 = 0 THEN NULL ELSE n_name END AS nation
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)"""


@register("a15_table1_continuous", sql=f"""
WITH {_T1_IN}, g AS (SELECT true AS is_total, 'Total' AS stratum, acctbal AS v FROM d UNION ALL SELECT false, segment, acctbal FROM d)
SELECT 'Account balance' AS characteristic, is_total, stratum, count(*) AS n_rows, count(v) AS n, count(*) - count(v) AS n_missing,
  round((count(*) - count(v)) * 100.0 / count(*), 6) AS missing_pct, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS sd,
  round(quantile_cont(v, 0.5), 6) AS median, round(quantile_cont(v, 0.25), 6) AS q1, round(quantile_cont(v, 0.75), 6) AS q3,
  round(min(v), 6) AS min, round(max(v), 6) AS max FROM g GROUP BY is_total, stratum""")
def a15_table1_continuous(spark, sf):
    c = T1.continuous_block(_t1_input(spark, sf), "acctbal", "segment", "Account balance")
    return c.select("characteristic", "is_total", "stratum", "n_rows", "n", "n_missing",
                    *[r(x).alias(x) for x in ["missing_pct", "mean", "sd", "median", "q1", "q3", "min", "max"]])


@register("a16_table1_categorical", sql=f"""
WITH {_T1_IN}, d1 AS (SELECT segment, NULLIF(nation, '') AS v FROM d),
top AS (SELECT v FROM d1 WHERE v IS NOT NULL GROUP BY v ORDER BY count(*) DESC, v LIMIT 10),
d2 AS (SELECT segment, CASE WHEN v IS NULL THEN NULL WHEN v IN (SELECT v FROM top) THEN v ELSE 'Other' END AS level FROM d1),
g AS (SELECT true AS is_total, 'Total' AS stratum, level FROM d2 UNION ALL SELECT false, segment, level FROM d2),
lv AS (SELECT level, CAST(row_number() OVER (ORDER BY CASE WHEN level = 'Other' THEN 1 ELSE 0 END, count(*) DESC, level) AS INTEGER) AS level_order,
  false AS is_missing FROM d2 WHERE level IS NOT NULL GROUP BY level),
lv2 AS (SELECT * FROM lv UNION ALL SELECT NULL, CAST((SELECT count(*) FROM lv) + 1 AS INTEGER), true),
st AS (SELECT is_total, stratum, count(*) AS denom FROM g GROUP BY 1, 2),
cnt AS (SELECT is_total, stratum, level, count(*) AS n FROM g GROUP BY 1, 2, 3)
SELECT 'Nation' AS characteristic, st.is_total, st.stratum, lv2.level, lv2.level_order, lv2.is_missing, coalesce(cnt.n, 0) AS n, st.denom,
  round(coalesce(cnt.n, 0) * 100.0 / st.denom, 6) AS pct
FROM st CROSS JOIN lv2 LEFT JOIN cnt ON st.is_total = cnt.is_total AND st.stratum IS NOT DISTINCT FROM cnt.stratum
  AND lv2.level IS NOT DISTINCT FROM cnt.level""")
def a16_table1_categorical(spark, sf):
    c = T1.categorical_block(_t1_input(spark, sf), "nation", "segment", 10, "Other", "Nation")
    return c.withColumn("pct", r("pct"))


# ---- tests -----------------------------------------------------------------

def _docs(spark, sf):
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    return d.select("doc_id", "lang", "source", (F.col("n_chars") > 2000).cast("string").alias("long_doc"),
                    "n_chars", "quality")


_DOCS = """dl AS (SELECT doc_id, lang, source, CAST(n_chars > 2000 AS VARCHAR) AS long_doc, n_chars, quality
  FROM documents JOIN labels USING (doc_id))"""


def _chi2_p_sql(stat: str, dof: str) -> str:
    """Upper tail of chi-square by the power series of the lower one, to 6 decimals."""
    return (f"abs(round(1 - CASE WHEN {stat} <= 0 THEN 0.0 ELSE list_sum([exp((n + {dof} / 2.0) * ln({stat} / 2) - {stat} / 2 "
            f"- lgamma(n + {dof} / 2.0 + 1)) FOR n IN range(0, 3000)]) END, 6))")


_T1_SQL = f"""
WITH {_DOCS}, lv AS (SELECT quality AS target, 'lang' AS variable, lang AS value FROM dl UNION ALL
  SELECT quality, 'source', source FROM dl UNION ALL SELECT quality, 'long_doc', lower(long_doc) FROM dl),
obs AS (SELECT variable, value, target, count(*) AS o FROM lv GROUP BY ALL),
rr AS (SELECT variable, value, sum(o) AS r FROM obs GROUP BY ALL),
cc AS (SELECT variable, target, sum(o) AS c FROM obs GROUP BY ALL),
t AS (SELECT variable, sum(r) AS n, count(*) AS nr FROM rr GROUP BY variable),
tc AS (SELECT variable, count(*) AS nc FROM cc GROUP BY variable),
grid AS (SELECT rr.variable, rr.r * cc.c / t.n AS e, coalesce(obs.o, 0) AS o, (t.nr - 1) * (tc.nc - 1) AS dof, t.n
  FROM rr JOIN cc USING (variable) JOIN t USING (variable) JOIN tc USING (variable) LEFT JOIN obs USING (variable, value, target)),
raw AS (SELECT variable, sum(CASE WHEN dof = 1 THEN power(abs(o - e) - least(0.5, abs(o - e)), 2) / e ELSE (o - e) * (o - e) / e END) AS chi2,
  CAST(max(dof) AS BIGINT) AS dof, CAST(max(n) AS BIGINT) AS n FROM grid GROUP BY variable)
SELECT variable, round(chi2, 6) AS chi2, dof, n, {_chi2_p_sql('chi2', 'dof')} AS p_value FROM raw"""


def _t1(t):
    return t.select("variable", r("chi2").alias("chi2"), "dof", F.col("n").cast("long").alias("n"), r("p_value").alias("p_value"))


@register("t1_chi_square", sql=_T1_SQL)
def t1_chi_square(spark, sf):
    t = St.chi_square(_docs(spark, sf), ["lang", "source", "long_doc"], "quality")
    return _t1(t)


@register("t2_top_by_p", sql=_T1_SQL)
def t2_top_by_p(spark, sf):
    t = St.chi_square(_docs(spark, sf), ["lang", "source", "long_doc"], "quality")
    return _t1(St.top_by_p(t, 3))


_T3_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("t3_welch_t", sql=f"""
WITH {_LI_NULLS}, lv AS ({_union_sql(_T3_COLS, 't', 'DOUBLE', 'l_linestatus')}),
s AS (SELECT variable, count(CASE WHEN l_linestatus = 'O' THEN value END) AS n_a, count(CASE WHEN l_linestatus = 'F' THEN value END) AS n_b,
  avg(CASE WHEN l_linestatus = 'O' THEN value END) AS mean_a, avg(CASE WHEN l_linestatus = 'F' THEN value END) AS mean_b,
  var_samp(CASE WHEN l_linestatus = 'O' THEN value END) AS var_a, var_samp(CASE WHEN l_linestatus = 'F' THEN value END) AS var_b
  FROM lv WHERE value IS NOT NULL AND l_linestatus IN ('O', 'F') GROUP BY variable)
SELECT variable, n_a, n_b, round(mean_a, 6) AS mean_a, round(mean_b, 6) AS mean_b,
  round((mean_a - mean_b) / sqrt(var_a / n_a + var_b / n_b), 6) AS t,
  round(power(var_a / n_a + var_b / n_b, 2) / (power(var_a / n_a, 2) / (n_a - 1) + power(var_b / n_b, 2) / (n_b - 1)), 6) AS df FROM s""")
def t3_welch_t(spark, sf):
    t = St.welch_t(_li_nulls(spark, sf), _T3_COLS, "l_linestatus", "O", "F")
    return t.select("variable", "n_a", "n_b", *[r(c).alias(c) for c in ["mean_a", "mean_b", "t", "df"]])


def _t4(spark, sf):
    return St.correlation_matrix(_li_nulls(spark, sf), _T3_COLS)


_T4_SQL = f"""{_LI_NULLS}, cols AS (SELECT * FROM (VALUES ('l_quantity', 0), ('l_extendedprice', 1), ('l_discount', 2), ('l_tax', 3)) v(name, pos)),
pairs AS (SELECT a.name AS f1, b.name AS f2, a.pos AS p1, b.pos AS p2 FROM cols a, cols b),
cm AS (SELECT f1 AS feature_1, f2 AS feature_2, p1, p2, CASE WHEN f1 = f2 THEN 1.0
  WHEN (f1 = 'l_quantity' AND f2 = 'l_extendedprice') OR (f2 = 'l_quantity' AND f1 = 'l_extendedprice') THEN (SELECT corr(l_quantity, l_extendedprice) FROM t)
  WHEN (f1 = 'l_quantity' AND f2 = 'l_discount') OR (f2 = 'l_quantity' AND f1 = 'l_discount') THEN (SELECT corr(l_quantity, l_discount) FROM t)
  WHEN (f1 = 'l_quantity' AND f2 = 'l_tax') OR (f2 = 'l_quantity' AND f1 = 'l_tax') THEN (SELECT corr(l_quantity, l_tax) FROM t)
  WHEN (f1 = 'l_extendedprice' AND f2 = 'l_discount') OR (f2 = 'l_extendedprice' AND f1 = 'l_discount') THEN (SELECT corr(l_extendedprice, l_discount) FROM t)
  WHEN (f1 = 'l_extendedprice' AND f2 = 'l_tax') OR (f2 = 'l_extendedprice' AND f1 = 'l_tax') THEN (SELECT corr(l_extendedprice, l_tax) FROM t)
  ELSE (SELECT corr(l_discount, l_tax) FROM t) END AS r FROM pairs)"""


@register("t4_correlation_matrix", sql=f"WITH {_T4_SQL} SELECT feature_1, feature_2, round(r, 6) AS r FROM cm")
def t4_correlation_matrix(spark, sf):
    return _t4(spark, sf).select("feature_1", "feature_2", r("r").alias("r"))


@register("t5_strong_pairs", sql=f"WITH {_T4_SQL} SELECT feature_1, feature_2, round(r, 6) AS r FROM cm WHERE p1 < p2 AND abs(r) > 0.5")
def t5_strong_pairs(spark, sf):
    return St.strong_pairs(_t4(spark, sf), _T3_COLS, 0.5).select("feature_1", "feature_2", r("r").alias("r"))


@register("t9_mcnemar", sql=f"""
WITH {_J10_SQL}, p AS (SELECT g.grade_b = g.grade_a AS a, v.pv = g.grade_a AS b FROM graded g JOIN v ON g.o_orderkey = v.o_orderkey),
t AS (SELECT count_if(a AND b) AS n11, count_if(a AND NOT b) AS n12, count_if(NOT a AND b) AS n21, count_if(NOT a AND NOT b) AS n22 FROM p)
SELECT n11, n12, n21, n22, n12 + n21 AS n_discordant, CASE WHEN n12 + n21 < 25 THEN 'exact' ELSE 'chi2' END AS method,
  round(CASE WHEN n12 + n21 = 0 THEN 0.0 WHEN n12 + n21 < 25 THEN least(n12, n21) ELSE power(abs(n12 - n21) - 1, 2) / (n12 + n21) END, 6) AS statistic,
  CASE WHEN n12 + n21 = 0 THEN 1.0 WHEN n12 + n21 < 25 THEN round(least(1.0, 2 * list_sum([exp(lgamma(n12 + n21 + 1) - lgamma(i + 1) - lgamma(n12 + n21 - i + 1) - (n12 + n21) * ln(2))
    FOR i IN range(0, CAST(least(n12, n21) + 1 AS BIGINT))])), 6) ELSE {_chi2_p_sql('(power(abs(n12 - n21) - 1, 2) / (n12 + n21))', '1')} END AS p_value FROM t""")
def t9_mcnemar(spark, sf):
    m = St.mcnemar(_j10(spark, sf))
    return m.select("n11", "n12", "n21", "n22", "n_discordant", "method", r("statistic").alias("statistic"), r("p_value").alias("p_value"))


@register("t10_kl_divergence", sql=f"""
WITH {SQL_GRADED_ORDERS}, c AS (SELECT k, (SELECT count(*) FROM graded WHERE grade_a = k) AS p, (SELECT count(*) FROM graded WHERE grade_b = k) AS q
  FROM (SELECT unnest([1, 2, 3, 4, 5]) AS k)),
s AS (SELECT sum(p) AS sp, sum(q) AS sq FROM c)
SELECT (SELECT count(*) FROM graded) AS n_rows,
  round(sum(((p + 1e-12) / (sp + 5e-12)) * ln(((p + 1e-12) / (sp + 5e-12)) / ((q + 1e-12) / (sq + 5e-12)))), 9) AS kl_divergence FROM c, s""")
def t10_kl_divergence(spark, sf):
    k = St.kl_divergence(graded_orders(spark, sf), "grade_a", "grade_b", [1, 2, 3, 4, 5])
    return k.select("n_rows", r("kl_divergence", 9).alias("kl_divergence"))


# ---- group profiles and cluster quality ---------------------------------------

def _a18(spark, sf):
    li = _li_nulls(spark, sf).withColumn("cluster", (F.col("l_orderkey") % 4).cast("int"))
    return G.group_mean_std(li, ["l_quantity", "l_discount", "l_tax"], "cluster")


_A18_SQL = f"""{_LI_NULLS}, lv AS ({_union_sql(['l_quantity', 'l_discount', 'l_tax'], 't', 'DOUBLE', 'CAST(l_orderkey % 4 AS INTEGER) AS cluster')}),
a AS (SELECT cluster, variable, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std, count(value) AS n FROM lv GROUP BY 1, 2)"""


@register("a18_group_mean_std", sql=f"WITH {_A18_SQL} SELECT * FROM a")
def a18_group_mean_std(spark, sf):
    return _a18(spark, sf).select("cluster", "variable", r("mean").alias("mean"), r("std").alias("std"), "n")


@register("a20_named_clusters", sql=f"WITH {_A18_SQL} SELECT * FROM a WHERE cluster IN (3, 1)")
def a20_named_clusters(spark, sf):
    p = G.compare_named_clusters(_a18(spark, sf), "cluster", [3, 1])
    return p.select("cluster", "variable", r("mean").alias("mean"), r("std").alias("std"), "n")


@register("a19_category_shares", sql="""
WITH d AS (SELECT CAST(c_nationkey % 4 AS INTEGER) AS cluster, c_mktsegment, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey),
lv AS (SELECT cluster, 'c_mktsegment' AS variable, c_mktsegment AS value FROM d UNION ALL SELECT cluster, 'n_name', n_name FROM d),
cnt AS (SELECT cluster, variable, value, count(*) AS n FROM lv GROUP BY ALL),
den AS (SELECT cluster, variable, sum(n) AS denom FROM cnt GROUP BY ALL),
grid AS (SELECT l.variable, l.value, k.cluster FROM (SELECT DISTINCT variable, value FROM cnt) l, (SELECT DISTINCT cluster FROM d) k)
SELECT g.cluster, g.variable, g.value, round(coalesce(c.n / den.denom, 0.0), 6) AS share
FROM grid g LEFT JOIN cnt c USING (cluster, variable, value) LEFT JOIN den USING (cluster, variable)""")
def a19_category_shares(spark, sf):
    c = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    c = c.select((F.col("c_nationkey") % 4).cast("int").alias("cluster"), "c_mktsegment", "n_name")
    return G.group_category_shares(c, ["c_mktsegment", "n_name"], "cluster").withColumn("share", r("share"))


_VEC_SQL = """u AS (SELECT vec_id, label, generate_subscripts(embedding, 1) AS pos, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings),
cen AS (SELECT label, pos, avg(x) AS m FROM u GROUP BY label, pos),
dd AS (SELECT u.vec_id, u.label AS own, c.label AS cluster, sum((u.x - c.m) * (u.x - c.m)) AS d2 FROM u JOIN cen c ON u.pos = c.pos GROUP BY ALL)"""


def _emb(spark, sf):
    return table(spark, sf, "embeddings")


def _assigned(spark, sf):
    e = _emb(spark, sf)
    centres = G.cluster_summaries(e, "embedding", "label").withColumnRenamed("label", "cluster")
    return G.assign_nearest(e, "embedding", centres)


@register("c4_nearest_centre", sql=f"""
WITH {_VEC_SQL} SELECT vec_id, cluster, round(d2, 6) AS dist2 FROM (
  SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d2, cluster) AS rn FROM dd) WHERE rn = 1""")
def c4_nearest_centre(spark, sf):
    return _assigned(spark, sf).select("vec_id", "cluster", r("dist2").alias("dist2"))


@register("c4_inertia", sql=f"""
WITH {_VEC_SQL} SELECT round(sum(d2), 4) AS inertia, count(*) AS n FROM (
  SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d2, cluster) AS rn FROM dd) WHERE rn = 1""")
def c4_inertia(spark, sf):
    return G.inertia(_assigned(spark, sf)).select(r("inertia", 4).alias("inertia"), "n")


@register("c5_cluster_sizes", sql="""
SELECT label, count(*) AS count, round(count(*) / (SELECT count(*) FROM embeddings), 6) AS share FROM embeddings GROUP BY label""")
def c5_cluster_sizes(spark, sf):
    return G.cluster_sizes(_emb(spark, sf), "label").withColumn("share", r("share"))


@register("c6_silhouette_sq_euclidean", sql="""
WITH e AS (SELECT vec_id, label, embedding FROM embeddings),
p AS (SELECT a.vec_id, a.label AS la, b.label AS lb,
  list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda z: (CAST(z[1] AS DOUBLE) - CAST(z[2] AS DOUBLE)) * (CAST(z[1] AS DOUBLE) - CAST(z[2] AS DOUBLE)))) AS d2
  FROM e a JOIN e b ON a.vec_id <> b.vec_id),
m AS (SELECT vec_id, la, lb, avg(d2) AS md FROM p GROUP BY ALL),
s AS (SELECT vec_id, max(CASE WHEN la = lb THEN md END) AS a, min(CASE WHEN la <> lb THEN md END) AS b FROM m GROUP BY vec_id)
SELECT round(avg(CASE WHEN a IS NULL OR b IS NULL THEN 0.0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette, count(*) AS n FROM s""")
def c6_silhouette_sq_euclidean(spark, sf):
    _, m = G.silhouette_sq(_emb(spark, sf), "embedding", "label")
    return m.select(r("silhouette").alias("silhouette"), "n")


@register("c7_davies_bouldin", sql=f"""
WITH {_VEC_SQL}, s AS (SELECT own AS label, avg(sqrt(d2)) AS S FROM dd WHERE own = cluster GROUP BY own),
md AS (SELECT a.label AS i, b.label AS j, sqrt(sum((a.m - b.m) * (a.m - b.m))) AS M FROM cen a JOIN cen b ON a.pos = b.pos AND a.label <> b.label GROUP BY 1, 2),
r AS (SELECT md.i, max((si.S + sj.S) / md.M) AS r FROM md JOIN s si ON si.label = md.i JOIN s sj ON sj.label = md.j GROUP BY md.i)
SELECT round(avg(r), 6) AS davies_bouldin, count(*) AS k FROM r""")
def c7_davies_bouldin(spark, sf):
    d = G.davies_bouldin(_emb(spark, sf), "embedding", "label")
    return d.select(r("davies_bouldin").alias("davies_bouldin"), "k")


@register("c8_calinski_harabasz", sql=f"""
WITH {_VEC_SQL}, g AS (SELECT pos, avg(x) AS m FROM u GROUP BY pos),
n AS (SELECT label, count(*) AS n FROM embeddings GROUP BY label),
b AS (SELECT sum(n.n * t.s) AS B FROM n JOIN (SELECT c.label, sum((c.m - g.m) * (c.m - g.m)) AS s FROM cen c JOIN g USING (pos) GROUP BY c.label) t USING (label)),
w AS (SELECT sum(d2) AS W FROM dd WHERE own = cluster)
SELECT (SELECT count(*) FROM embeddings) AS n, (SELECT count(*) FROM n) AS k,
  round((B / ((SELECT count(*) FROM n) - 1)) / (W / ((SELECT count(*) FROM embeddings) - (SELECT count(*) FROM n))), 6) AS calinski_harabasz FROM b, w""")
def c8_calinski_harabasz(spark, sf):
    c = G.calinski_harabasz(_emb(spark, sf), "embedding", "label")
    return c.select("n", "k", r("calinski_harabasz").alias("calinski_harabasz"))


@register("c12_inliers", sql=f"""
WITH {_VEC_SQL}, own AS (SELECT vec_id, own AS label, sqrt(d2) AS dist FROM dd WHERE own = cluster),
q AS (SELECT label, quantile_cont(dist, 0.9) AS cut FROM own GROUP BY label)
SELECT vec_id, label, round(dist, 6) AS dist FROM own JOIN q USING (label) WHERE dist <= cut""")
def c12_inliers(spark, sf):
    i = G.inliers(_emb(spark, sf), "embedding", "label", 90.0)
    return i.select("vec_id", "label", r("dist").alias("dist"))
