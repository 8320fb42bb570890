"""Source/sink round trips (S1-S7), clustering (C1-C3, C9-C11) and phi_K."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clean as C
from ..operators import cluster as Cl
from ..operators import groups as G
from ..operators import phik as Ph
from ..operators import profile as Pr
from ..operators import rules as R
from ..session import scratch_path, table
from ..sources import io as IO
from .common import SQL_GRADED_ORDERS, graded_orders, r
from .registry import register

_CUST_SCHEMA = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


@register("s1_csv_roundtrip", sql="SELECT * FROM customer")
def s1_csv_roundtrip(spark, sf):
    path = IO.write_csv(table(spark, sf, "customer"), scratch_path(spark, "csv"))
    return IO.read_csv(spark, path, _CUST_SCHEMA)


@register("s2_csv_pair", sql="""
WITH f AS (SELECT user_id, count(*) AS n_events, avg(value) AS avg_value FROM events GROUP BY 1),
t AS (SELECT user_id, (epoch_us(min(ts)) - (SELECT epoch_us(min(ts)) FROM events)) / 3600000000.0 AS time_1 FROM events GROUP BY 1)
SELECT user_id, n_events, round(avg_value, 6) AS avg_value, round(time_1, 6) AS time_1 FROM f JOIN t USING (user_id)""")
def s2_csv_pair(spark, sf):
    e = table(spark, sf, "events")
    t0 = e.agg(F.min("ts")).scalar()
    f = e.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_events"), F.avg("value").alias("avg_value"))
    t = e.withColumn("__t0", t0).groupBy("user_id").agg(
        (F.expr("timestampdiff(MICROSECOND, first(__t0), min(ts))") / 3.6e9).alias("time_1"))
    fp, tp = scratch_path(spark, "features"), scratch_path(spark, "timelines")
    IO.write_csv(f, fp, sep=";")
    IO.write_csv(t, tp, sep=";")
    fr, tr = IO.read_csv_pair(spark, fp, tp, "user_id bigint, n_events bigint, avg_value double",
                              "user_id bigint, time_1 double")
    return fr.join(tr, "user_id").select("user_id", "n_events", r("avg_value").alias("avg_value"), r("time_1").alias("time_1"))


@register("s3_arff_read", sql="""
SELECT CAST(c_custkey AS DOUBLE) AS c_custkey, c_name, CAST(c_nationkey AS DOUBLE) AS c_nationkey,
  CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal,
  CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment FROM customer""")
def s3_arff_read(spark, sf):
    c = table(spark, sf, "customer")
    k = F.col("c_custkey")
    c = c.withColumn("c_acctbal", F.when(k % 7 == 0, None).otherwise(F.col("c_acctbal"))) \
         .withColumn("c_mktsegment", F.when(k % 11 == 0, None).otherwise(F.col("c_mktsegment")))
    # all nominal levels go into the header
    levels = sorted(x[0] for x in table(spark, sf, "customer").select("c_mktsegment").distinct().collect())
    head, data = IO.arff_lines(c, "customer", {"c_mktsegment": levels})
    path = scratch_path(spark, "arff")
    head.write.text(f"{path}/header")
    data.write.text(f"{path}/data")
    return IO.read_arff(spark, [f"{path}/header", f"{path}/data"])


@register("s4_label_table_csv", sql="""
SELECT c.c_custkey, n.n_name AS c_nationkey_label FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""")
def s4_label_table_csv(spark, sf):
    n = table(spark, sf, "nation").select(F.lit("c_nationkey").alias("column"), F.col("n_nationkey").cast("string").alias("code"),
                                          F.col("n_name").alias("label"))
    path = IO.write_csv(n, scratch_path(spark, "labels"))
    labels = IO.read_csv(spark, path, "column string, code string, label string")
    out, _ = C.map_values(table(spark, sf, "customer").select("c_custkey", "c_nationkey"), labels, ["c_nationkey"], suffix="_label")
    return out.select("c_custkey", "c_nationkey_label")


@register("s5_csv_write", sql=f"WITH {SQL_GRADED_ORDERS} SELECT grade_a, grade_b, count(*) AS count FROM graded GROUP BY 1, 2")
def s5_csv_write(spark, sf):
    ct = Pr.crosstab(graded_orders(spark, sf), "grade_a", "grade_b")
    path = IO.write_csv(ct, scratch_path(spark, "crosstab"))
    return IO.read_csv(spark, path, "grade_a int, grade_b int, count bigint")


@register("s6_json_write", sql="""
WITH p AS (SELECT *, CAST(p_type = 'ECONOMY' AS INTEGER) AS target FROM part)
SELECT 1 AS rule_id, 'p_size <= 10.0000' AS conditions, count_if(p_size <= 10) AS support FROM p
UNION ALL SELECT 2, 'p_size > 10.0000 AND p_retailprice <= 1500.0000', count_if(p_size > 10 AND p_retailprice <= 1500) FROM p""")
def s6_json_write(spark, sf):
    rules = spark.createDataFrame([(1, ["p_size <= 10.0000"]), (2, ["p_size > 10.0000", "p_retailprice <= 1500.0000"])],
                                  "rule_id int, conditions array<string>")
    p = table(spark, sf, "part").withColumn("target", (F.col("p_type") == "ECONOMY").cast("int"))
    scored = R.score_rules(p, rules, "target")
    path = IO.write_json(scored, scratch_path(spark, "rules"))
    back = spark.read.schema("rule_id int, conditions array<string>, support bigint").json(path)
    return back.select("rule_id", F.array_join("conditions", " AND ").alias("conditions"), "support")


@register("s7_ordered_export", sql="SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders")
def s7_ordered_export(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    path = IO.write_ordered(o, scratch_path(spark, "ordered"), ["o_orderpriority", "o_orderkey"])
    return IO.read_csv(spark, path, "o_orderkey bigint, o_orderpriority string, o_totalprice double")


# ---- clustering ----------------------------------------------------------------

def _emb(spark, sf):
    return table(spark, sf, "embeddings")


@register("c1_kmeans")
def c1_kmeans(spark, sf):
    a, _, _ = Cl.kmeans_fit(_emb(spark, sf), "embedding", k=10, seed=42, n_init=10)
    return a.select("vec_id", "label", "cluster")


@register("c2_elbow")
def c2_elbow(spark, sf):
    return Cl.elbow(_emb(spark, sf), "embedding", range(1, 16), seed=99)


@register("c3_select_k")
def c3_select_k(spark, sf):
    return Cl.select_k(_emb(spark, sf), "embedding", range(2, 8), seed=42, n_init=10)


@register("c9_pca_explained")
def c9_pca_explained(spark, sf):
    _, ratio, _ = Cl.pca_fit(_emb(spark, sf), "embedding", 2)
    return ratio


@register("c9_pca_loadings")
def c9_pca_loadings(spark, sf):
    _, _, load = Cl.pca_fit(_emb(spark, sf), "embedding", 2)
    return load


@register("c10_pca_centres")
def c10_pca_centres(spark, sf):
    e = _emb(spark, sf)
    fit, _, _ = Cl.pca_fit(e, "embedding", 2)
    cent = G.cluster_summaries(e, "embedding", "label")
    return Cl.pca_transform(cent, "centroid", fit).select("label", "pcs")


@register("c11_pca_vs_original")
def c11_pca_vs_original(spark, sf):
    return Cl.pca_vs_original(_emb(spark, sf), "embedding", 10, 2, 42, "vec_id")


# ---- phi_K -------------------------------------------------------------------------

_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_CAT = ["l_returnflag", "l_linestatus"]


_T6_SQL = """
WITH mm AS (SELECT min(l_quantity) AS mn, max(l_quantity) AS mx FROM lineitem),
d AS (SELECT CAST(CAST(LEAST(floor((l_quantity - mn) / ((mx - mn) / 10)), 9) AS BIGINT) AS VARCHAR) AS q, l_returnflag, l_linestatus FROM lineitem, mm)
SELECT 'l_quantity' AS col_a, 'l_returnflag' AS col_b, q AS a, l_returnflag AS b, count(*) AS n FROM d GROUP BY 3, 4
UNION ALL SELECT 'l_quantity', 'l_linestatus', q, l_linestatus, count(*) FROM d GROUP BY 3, 4
UNION ALL SELECT 'l_returnflag', 'l_linestatus', l_returnflag, l_linestatus, count(*) FROM d GROUP BY 3, 4"""


@register("t6_pair_counts", sql=_T6_SQL)
def t6_pair_counts(spark, sf):
    return Ph.pair_counts(table(spark, sf, "lineitem"), ["l_quantity"], _CAT, 10)


@register("t6_pair_chi2", sql=f"""
WITH o AS (SELECT * FROM ({_T6_SQL})),
ra AS (SELECT col_a, col_b, a, sum(n) AS x FROM o GROUP BY ALL), rb AS (SELECT col_a, col_b, b, sum(n) AS y FROM o GROUP BY ALL),
t AS (SELECT col_a, col_b, sum(x) AS total FROM ra GROUP BY ALL),
grid AS (SELECT col_a, col_b, a, b, x * y / total AS e FROM ra JOIN rb USING (col_a, col_b) JOIN t USING (col_a, col_b))
SELECT col_a, col_b, round(sum((coalesce(n, 0) - e) * (coalesce(n, 0) - e) / e), 6) AS chi2,
  CAST((count(DISTINCT a) - 1) * (count(DISTINCT b) - 1) AS BIGINT) AS dof FROM grid LEFT JOIN o USING (col_a, col_b, a, b) GROUP BY col_a, col_b""")
def t6_pair_chi2(spark, sf):
    return Ph.pair_chi2(Ph.pair_counts(table(spark, sf, "lineitem"), ["l_quantity"], _CAT, 10)).withColumn("chi2", r("chi2"))


def _phik(spark, sf):
    return Ph.phik_matrix(table(spark, sf, "lineitem"), _NUM, _CAT, 10)


@register("t6_phik_matrix")
def t6_phik_matrix(spark, sf):
    return _phik(spark, sf).withColumn("phik", r("phik")).withColumn("chi2", r("chi2"))


@register("t7_top_pairs")
def t7_top_pairs(spark, sf):
    return Ph.top_pairs(_phik(spark, sf), 20)


@register("t8_named_pairs")
def t8_named_pairs(spark, sf):
    return Ph.named_pairs(_phik(spark, sf), [("l_extendedprice", "l_quantity"), ("l_returnflag", "l_linestatus")])
