"""Linkage, ordering and set queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from ..operators import linkage as L
from ..operators import ordering as O
from ..session import table
from .common import SQL_GRADED_ORDERS, graded_orders, r
from .registry import register


@register("j1_composite_join", sql="""
SELECT o.o_orderkey, c.c_custkey, c.c_mktsegment FROM orders o JOIN customer c
ON o.o_custkey = c.c_custkey AND o.o_orderkey % 3 = c.c_nationkey % 3""")
def j1_composite_join(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", (F.col("o_orderkey") % 3).alias("entry"))
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", (F.col("c_nationkey") % 3).alias("entry_2"))
    j = L.join_on(o, c, ["o_custkey", "entry"], ["c_custkey", "entry_2"])
    return j.select("o_orderkey", "c_custkey", "c_mktsegment")


_W1_SQL_IN = """t AS (SELECT o_orderkey, o_custkey,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderdate END AS d1,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderdate - INTERVAL 3 DAY END AS d2 FROM orders)"""


@register("w1_visit_number", sql=f"""
WITH {_W1_SQL_IN}
SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey
  ORDER BY coalesce(least(d1, d2), TIMESTAMP '9999-12-31'), o_orderkey) AS visit_number FROM t""")
def w1_visit_number(spark, sf):
    o = table(spark, sf, "orders")
    k = F.col("o_orderkey")
    t = o.select("o_orderkey", "o_custkey",
                 F.when(k % 7 == 0, None).otherwise(F.col("o_orderdate")).alias("d1"),
                 F.when(k % 5 == 0, None).otherwise(F.col("o_orderdate") - F.expr("INTERVAL 3 DAYS")).alias("d2"))
    return L.visit_number(t, "o_custkey", ["d1", "d2"], ["o_orderkey"]).select("o_orderkey", "o_custkey", "visit_number")


_J2_SQL = """l AS (SELECT DISTINCT * FROM orders), rr AS (SELECT DISTINCT * FROM events),
lv AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY coalesce(o_orderdate, TIMESTAMP '9999-12-31'), o_orderkey) AS visit_number FROM l),
rv AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY coalesce(ts, TIMESTAMP '9999-12-31'), event_id) AS visit_number_2 FROM rr),
m AS (SELECT * FROM lv JOIN rv ON lv.o_custkey = rv.user_id AND lv.visit_number = rv.visit_number_2)"""


def _visit_join(spark, sf):
    return L.visit_join(table(spark, sf, "orders"), table(spark, sf, "events"), "o_custkey", "user_id",
                        ["o_orderdate"], ["ts"], ["o_orderkey"], ["event_id"])


@register("j2_visit_join", sql=f"""
WITH {_J2_SQL}
SELECT o_custkey, visit_number, o_orderkey, event_id FROM m""")
def j2_visit_join(spark, sf):
    return _visit_join(spark, sf).select("o_custkey", "visit_number", "o_orderkey", "event_id")


_J3_PAIRS = [("o_custkey", "user_id"), ("order_year", "event_year"), ("prio_digit", "event_digit")]
_J3_SQL = f"""{_J2_SQL},
mm AS (SELECT *, year(o_orderdate) AS order_year, year(ts) AS event_year,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(substr(o_orderpriority, 1, 1) AS INTEGER) END AS prio_digit,
  CAST(event_id % 5 + 1 AS INTEGER) AS event_digit FROM m)"""


def _j3_merged(spark, sf):
    m = _visit_join(spark, sf)
    return m.withColumns({
        "order_year": F.year("o_orderdate"), "event_year": F.year("ts"),
        "prio_digit": F.when(F.col("o_orderkey") % 7 == 0, None)
                       .otherwise(F.substring("o_orderpriority", 1, 1).cast("int")),
        "event_digit": (F.col("event_id") % 5 + 1).cast("int")})


@register("j3_identity_check", sql=f"""
WITH {_J3_SQL}
SELECT n_rows, left_col, right_col, n_mismatch, n_mismatch = 0 AS accepted FROM (
  SELECT count(*) AS n_rows, 'o_custkey' AS left_col, 'user_id' AS right_col, count_if(coalesce(o_custkey <> user_id, true)) AS n_mismatch FROM mm
  UNION ALL SELECT count(*), 'order_year', 'event_year', count_if(coalesce(order_year <> event_year, true)) FROM mm
  UNION ALL SELECT count(*), 'prio_digit', 'event_digit', count_if(coalesce(prio_digit <> event_digit, true)) FROM mm)""")
def j3_identity_check(spark, sf):
    return L.identity_check(_j3_merged(spark, sf), _J3_PAIRS)


@register("u1_mismatch_rows", sql=f"""
WITH {_J3_SQL}
SELECT o_orderkey, event_id, 'order_year' AS left_col, CAST(order_year AS VARCHAR) AS left_value, CAST(event_year AS VARCHAR) AS right_value
  FROM mm WHERE coalesce(order_year <> event_year, true)
UNION ALL SELECT o_orderkey, event_id, 'prio_digit', CAST(prio_digit AS VARCHAR), CAST(event_digit AS VARCHAR)
  FROM mm WHERE coalesce(prio_digit <> event_digit, true)""")
def u1_mismatch_rows(spark, sf):
    return L.mismatch_rows(_j3_merged(spark, sf), _J3_PAIRS[1:], ["o_orderkey", "event_id"])


@register("j4_group_label_inner", sql="""
SELECT e.event_id, e.user_id, CAST(c.c_nationkey % 4 AS INTEGER) AS cluster
FROM events e JOIN customer c ON e.user_id = c.c_custkey + 7""")
def j4_group_label_inner(spark, sf):
    """The whole lookup; its keys are shifted, so that some events have no label."""
    labels = (table(spark, sf, "customer")
              .select((F.col("c_custkey") + 7).alias("user_id"), (F.col("c_nationkey") % 4).cast("int").alias("cluster")))
    return L.attach_label(table(spark, sf, "events").select("event_id", "user_id"), labels, "user_id")


@register("j5_key_attach", sql="""
SELECT o.o_orderkey, c.c_mktsegment FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey + 7""")
def j5_key_attach(spark, sf):
    """The whole lookup; its keys are shifted, so that some orders stay without one."""
    c = table(spark, sf, "customer").select((F.col("c_custkey") + 7).alias("o_custkey"), "c_mktsegment")
    return L.attach_label(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), c, "o_custkey",
                          how="left").select("o_orderkey", "c_mktsegment")


_J6_SQL = """a AS (SELECT vec_id, label, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS pair_rank FROM embeddings WHERE vec_id % 2 = 0),
b AS (SELECT vec_id, label, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS pair_rank FROM embeddings WHERE vec_id % 2 = 1),
p AS (SELECT a.label, a.pair_rank, a.vec_id AS vec_id_a, b.vec_id AS vec_id_b FROM a JOIN b ON a.label = b.label AND a.pair_rank = b.pair_rank)"""


def _pairs(spark, sf):
    e = table(spark, sf, "embeddings")
    a = e.where(F.col("vec_id") % 2 == 0)
    b = e.where(F.col("vec_id") % 2 == 1)
    return L.pair_by_rank(a, b, "label", "vec_id")


@register("j6_pair_by_rank", sql=f"WITH {_J6_SQL} SELECT label, pair_rank, vec_id_a, vec_id_b FROM p")
def j6_pair_by_rank(spark, sf):
    return _pairs(spark, sf).select("label", "pair_rank", "vec_id_a", "vec_id_b")


@register("j7_missing_labels", sql=f"""
WITH {_J6_SQL} SELECT CAST(x AS INTEGER) AS label FROM range(12) t(x) WHERE CAST(x AS INTEGER) NOT IN (SELECT label FROM p)""")
def j7_missing_labels(spark, sf):
    expected = spark.range(12).select(F.col("id").cast("int").alias("label"))
    return L.missing_labels(_pairs(spark, sf), expected, "label")


@register("j8_lookup_default", sql="""
SELECT c.c_custkey, coalesce(n.n_name, 'UNKNOWN') AS nation FROM customer c
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey + 5""")
def j8_lookup_default(spark, sf):
    """The whole lookup; its keys are shifted, so that some customers get the default."""
    n = table(spark, sf, "nation").withColumn("n_nationkey", F.col("n_nationkey") + 5)
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return L.lookup_with_default(c, "c_nationkey", n, "n_nationkey", "n_name", "nation", "UNKNOWN").select("c_custkey", "nation")


_J10_SQL = f"""{SQL_GRADED_ORDERS},
v AS (SELECT o_orderkey, CAST(round_even((grade_a + grade_b) / 2.0, 0) AS INTEGER) AS pv FROM graded)"""


def _j10(spark, sf):
    g = graded_orders(spark, sf)
    v = g.select("o_orderkey", F.bround((F.col("grade_a") + F.col("grade_b")) / 2.0, 0).cast("int").alias("pv"))
    return L.compare_predictions(g, v, "o_orderkey", "grade_a", "grade_b", "pv")


@register("j10_prediction_pairs", sql=f"""
WITH {_J10_SQL}
SELECT g.o_orderkey, g.grade_a, g.grade_b AS pred_base, v.pv AS pred_variant,
  CAST(g.grade_b = g.grade_a AS INTEGER) AS correct_base, CAST(v.pv = g.grade_a AS INTEGER) AS correct_variant
FROM graded g JOIN v ON g.o_orderkey = v.o_orderkey""")
def j10_prediction_pairs(spark, sf):
    return _j10(spark, sf)


_J11_SCHEMA = StructType([StructField("l_quantity", DoubleType()), StructField("l_extra", StringType()),
                          StructField("l_discount", DoubleType()), StructField("l_linenumber", LongType())])


@register("j11_align_columns", sql="""
SELECT l_orderkey, l_quantity, CAST(NULL AS VARCHAR) AS l_extra, l_discount, CAST(l_linenumber AS BIGINT) AS l_linenumber FROM lineitem""")
def j11_align_columns(spark, sf):
    return L.align_columns(table(spark, sf, "lineitem"), _J11_SCHEMA, keep=["l_orderkey"])


@register("a13_dedupe", sql="SELECT DISTINCT * FROM lineitem")
def a13_dedupe(spark, sf):
    return L.dedupe(table(spark, sf, "lineitem"))


@register("a13_duplicated_ids", sql="""
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def a13_duplicated_ids(spark, sf):
    return L.duplicated_ids(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("w3_top_k", sql="SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def w3_top_k(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return O.top_k(o, [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()], 10)


@register("w3_top_k_per_group", sql="""
SELECT * FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank
FROM orders) WHERE rank <= 3""")
def w3_top_k_per_group(spark, sf):
    o = table(spark, sf, "orders")
    t = O.top_k_per_group(o, ["o_custkey"], [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()], 3)
    return t.select("o_custkey", "o_orderkey", "rank")


@register("w5_first_n_per_class", sql="""
SELECT * FROM (SELECT vec_id, label, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS class_rank FROM embeddings) WHERE class_rank <= 5""")
def w5_first_n_per_class(spark, sf):
    return O.first_n_per_class(table(spark, sf, "embeddings").select("vec_id", "label"), "label", "vec_id", 5)


@register("w6_multi_key_sort", sql="SELECT p_brand, p_retailprice, p_partkey FROM part ORDER BY p_brand, p_retailprice DESC, p_partkey DESC")
def w6_multi_key_sort(spark, sf):
    p = table(spark, sf, "part").select("p_brand", "p_retailprice", "p_partkey")
    return O.multi_key_sort(p, [("p_brand", True), ("p_retailprice", False), ("p_partkey", False)])


@register("w7_running_share", sql="""
SELECT o_orderkey, round(sum(o_totalprice) OVER (ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING)
  / (SELECT sum(o_totalprice) FROM orders), 6) AS cum_share FROM orders""")
def w7_running_share(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    s = O.running_share(o, ["o_orderdate", "o_orderkey"], "o_totalprice")
    return s.select("o_orderkey", r("cum_share").alias("cum_share"))


_U2_SQL = """t AS (SELECT o_custkey, sum(o_totalprice) AS spend, count(*) AS n_orders FROM orders GROUP BY 1),
a AS (SELECT o_custkey, spend FROM t ORDER BY spend DESC, o_custkey LIMIT 10),
b AS (SELECT o_custkey, n_orders FROM t ORDER BY n_orders DESC, o_custkey LIMIT 10)"""


@register("u2_top_list_intersection", sql=f"""
WITH {_U2_SQL} SELECT a.o_custkey, round(a.spend, 6) AS spend, b.n_orders FROM a JOIN b ON a.o_custkey = b.o_custkey""")
def u2_top_list_intersection(spark, sf):
    t = table(spark, sf, "orders").groupBy("o_custkey").agg(F.sum("o_totalprice").alias("spend"),
                                                           F.count(F.lit(1)).alias("n_orders"))
    a = O.top_k(t.select("o_custkey", "spend"), [F.col("spend").desc(), F.col("o_custkey")], 10)
    b = O.top_k(t.select("o_custkey", "n_orders"), [F.col("n_orders").desc(), F.col("o_custkey")], 10)
    return O.intersect_on(a, b, "o_custkey").select("o_custkey", r("spend").alias("spend"), "n_orders")


@register("u3_customers_without_orders", sql="""
SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)""")
def u3_customers_without_orders(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey")
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return O.difference_on(c, o, "c_custkey")


@register("u4_union_of_groups", sql="""
SELECT DISTINCT c_nationkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')""")
def u4_union_of_groups(spark, sf):
    return O.union_distinct(table(spark, sf, "customer"), "c_mktsegment", "c_nationkey", ["BUILDING", "MACHINERY"])
