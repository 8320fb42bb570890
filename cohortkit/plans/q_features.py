"""Feature preparation queries."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..operators import features as Fe
from ..operators import impute as Im
from ..session import table
from .common import r
from .registry import register


def _cust(spark, sf):
    c = table(spark, sf, "customer")
    k = F.col("c_custkey")
    return c.select("c_custkey", F.when(k % 7 == 0, None).otherwise(F.col("c_acctbal")).alias("c_acctbal"),
                    F.when(k % 5 == 0, None).otherwise(F.col("c_mktsegment")).alias("c_mktsegment"))


_CUST = """t AS (SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal,
  CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment FROM customer)"""


@register("f1_mean_mode_fill", sql=f"""
WITH {_CUST}, m AS (SELECT c_mktsegment AS v FROM t WHERE c_mktsegment IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, v LIMIT 1)
SELECT c_custkey, round(coalesce(c_acctbal, (SELECT avg(c_acctbal) FROM t)), 6) AS c_acctbal,
  coalesce(c_mktsegment, (SELECT v FROM m)) AS c_mktsegment FROM t""")
def f1_mean_mode_fill(spark, sf):
    f = Fe.mean_mode_fill(_cust(spark, sf), ["c_acctbal"], ["c_mktsegment"])
    return f.select("c_custkey", r("c_acctbal").alias("c_acctbal"), "c_mktsegment")


def _ord(spark, sf):
    o = table(spark, sf, "orders")
    k = F.col("o_orderkey")
    d = o.select("o_orderkey", F.when(k % 7 == 0, None).otherwise(F.col("o_totalprice")).alias("price"),
                 F.when(k % 3 == 0, None).otherwise(F.col("o_orderpriority")).alias("priority"),
                 F.lit(None).cast("double").alias("empty"))
    return d.where(k % 5 != 0), d.where(k % 5 == 0)


_ORD = """d AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS price,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderpriority END AS priority FROM orders),
tr AS (SELECT * FROM d WHERE o_orderkey % 5 <> 0), te AS (SELECT * FROM d WHERE o_orderkey % 5 = 0),
med AS (SELECT quantile_cont(price, 0.5) AS m FROM tr WHERE price IS NOT NULL),
mode AS (SELECT priority AS v FROM tr WHERE priority IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, v LIMIT 1)"""


@register("f2_median_mode_impute", sql=f"""
WITH {_ORD} SELECT o_orderkey, round(coalesce(price, (SELECT m FROM med)), 6) AS price, coalesce(priority, (SELECT v FROM mode)) AS priority FROM te""")
def f2_median_mode_impute(spark, sf):
    tr, te = _ord(spark, sf)
    imp = Fe.SimpleImputerFit(tr, ["price", "priority", "empty"])
    return imp.transform(te).select("o_orderkey", r("price").alias("price"), "priority")


@register("f3_drop_then_impute", sql=f"WITH {_ORD} SELECT o_orderkey, round(coalesce(price, (SELECT m FROM med)), 6) AS price FROM te")
def f3_drop_then_impute(spark, sf):
    tr, te = _ord(spark, sf)
    fit = Fe.DropThenImpute(tr, ["price", "priority", "empty"], 0.2)
    out = fit.transform(te)
    return out.select("o_orderkey", *[r(c).alias(c) for c in fit.kept])


@register("f4_missing_indicators", sql=f"""
WITH {_ORD} SELECT o_orderkey, round(coalesce(price, (SELECT m FROM med)), 6) AS price, coalesce(priority, (SELECT v FROM mode)) AS priority,
  CAST(price IS NULL AS INTEGER) AS price_missing, CAST(priority IS NULL AS INTEGER) AS priority_missing FROM te""")
def f4_missing_indicators(spark, sf):
    tr, te = _ord(spark, sf)
    fit = Fe.IndicatorThenImpute(tr.drop("empty"), ["price", "priority"])
    out = fit.transform(te.drop("empty"))
    return out.select("o_orderkey", r("price").alias("price"), "priority", "price_missing", "priority_missing")


@register("f5_iterative_impute")
def f5_iterative_impute(spark, sf):
    """Rows-only: fitted on two thirds of the orders' lines, applied to all
    (equal to the plain chained loop in tests)."""
    li = table(spark, sf, "lineitem")
    k = F.col("l_orderkey")
    d = li.select("l_orderkey", "l_linenumber",
                  F.when(k % 7 == 0, None).otherwise(F.col("l_quantity")).alias("l_quantity"),
                  F.when(k % 5 == 0, None).otherwise(F.col("l_extendedprice")).alias("l_extendedprice"),
                  "l_discount", "l_tax", F.when(k % 11 == 0, None).otherwise(F.col("l_returnflag")).alias("l_returnflag"),
                  F.lit(None).cast("double").alias("l_never"))
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_never"]
    return Im.IterativeImputerFit(d.where(k % 3 != 0), cols, max_iter=10).transform(d)



def _enc(spark, sf):
    c = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    k = F.col("c_custkey")
    d = c.select("c_custkey", F.when(k % 11 == 0, None).when((k % 5 == 0) & (k % 7 == 0), "NEW")
                 .otherwise(F.col("c_mktsegment")).alias("segment"),
                 F.when((k % 5 == 0) & (k % 3 == 0), "NATION_X").otherwise(F.col("n_name")).alias("nation"))
    return d.where(k % 5 != 0), d.where(k % 5 == 0)


@register("f6_label_encode", sql="""
WITH d AS (SELECT c_custkey, CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 5 = 0 AND c_custkey % 7 = 0 THEN 'NEW' ELSE c_mktsegment END AS segment,
  CASE WHEN c_custkey % 5 = 0 AND c_custkey % 3 = 0 THEN 'NATION_X' ELSE n_name END AS nation
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
tr AS (SELECT * FROM d WHERE c_custkey % 5 <> 0), te AS (SELECT * FROM d WHERE c_custkey % 5 = 0),
cs AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS code FROM (SELECT DISTINCT coalesce(segment, 'MISSING_CATEGORY') AS v FROM tr)),
cn AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS code FROM (SELECT DISTINCT coalesce(nation, 'MISSING_CATEGORY') AS v FROM tr))
SELECT te.c_custkey, coalesce(cs.code, -1) AS segment, coalesce(cn.code, -1) AS nation FROM te
LEFT JOIN cs ON coalesce(te.segment, 'MISSING_CATEGORY') = cs.v LEFT JOIN cn ON coalesce(te.nation, 'MISSING_CATEGORY') = cn.v""")
def f6_label_encode(spark, sf):
    tr, te = _enc(spark, sf)
    codes = Fe.fit_label_encoder(tr, ["segment", "nation"])
    return Fe.apply_label_encoder(te, codes, ["segment", "nation"])


@register("f7_one_hot_drop_first", sql="""
SELECT c_custkey, CAST(c_mktsegment = 'BUILDING' AS INTEGER) AS c_mktsegment_BUILDING,
  CAST(c_mktsegment = 'FURNITURE' AS INTEGER) AS c_mktsegment_FURNITURE, CAST(c_mktsegment = 'HOUSEHOLD' AS INTEGER) AS c_mktsegment_HOUSEHOLD,
  CAST(c_mktsegment = 'MACHINERY' AS INTEGER) AS c_mktsegment_MACHINERY FROM customer""")
def f7_one_hot_drop_first(spark, sf):
    return Fe.one_hot_drop_first(table(spark, sf, "customer").select("c_custkey", "c_mktsegment"), ["c_mktsegment"])


@register("f8_one_hot_unseen", sql="""
WITH d AS (SELECT c_custkey, CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 5 = 0 AND c_custkey % 7 = 0 THEN 'NEW' ELSE c_mktsegment END AS segment,
  CASE WHEN c_custkey % 5 = 0 AND c_custkey % 3 = 0 THEN 'NATION_X' ELSE n_name END AS nation
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
e AS (SELECT c_custkey, coalesce(segment, 'MISSING_CATEGORY') AS segment, nation FROM d),
l AS (SELECT list_sort(list(DISTINCT segment)) AS ls, list_sort(list(DISTINCT nation)) AS ln FROM e WHERE c_custkey % 5 <> 0)
SELECT c_custkey, [CASE WHEN x = segment THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END FOR x IN ls] AS segment_ohe,
  [CASE WHEN x = nation THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END FOR x IN ln] AS nation_ohe FROM e, l WHERE c_custkey % 5 = 0""")
def f8_one_hot_unseen(spark, sf):
    """Spark ML indexer + encoder; unseen levels encode as zeros."""
    tr, te = _enc(spark, sf)
    tr = tr.fillna({"segment": "MISSING_CATEGORY"})
    te = te.fillna({"segment": "MISSING_CATEGORY"})
    model = Fe.one_hot_unseen_ignored(tr, ["segment", "nation"])
    out = model.transform(te)
    return out.select("c_custkey", vector_to_array("segment_ohe").alias("segment_ohe"),
                      vector_to_array("nation_ohe").alias("nation_ohe"))


@register("f9_standardise", sql="""
SELECT l_orderkey, l_linenumber, round((l_quantity - (SELECT avg(l_quantity) FROM lineitem)) / (SELECT stddev_pop(l_quantity) FROM lineitem), 6) AS l_quantity,
  round((l_discount - (SELECT avg(l_discount) FROM lineitem)) / (SELECT stddev_pop(l_discount) FROM lineitem), 6) AS l_discount FROM lineitem""")
def f9_standardise(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")
    s = Fe.standardise(li, Fe.fit_scaler(li, ["l_quantity", "l_discount"]))
    return s.select("l_orderkey", "l_linenumber", r("l_quantity").alias("l_quantity"), r("l_discount").alias("l_discount"))


@register("f10_scale_no_centre", sql="""
SELECT l_orderkey, l_linenumber, round(l_quantity / (SELECT stddev_pop(l_quantity) FROM lineitem), 6) AS l_quantity,
  round(l_discount / (SELECT stddev_pop(l_discount) FROM lineitem), 6) AS l_discount FROM lineitem""")
def f10_scale_no_centre(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")
    s = Fe.standardise(li, Fe.fit_scaler(li, ["l_quantity", "l_discount"]), with_mean=False)
    return s.select("l_orderkey", "l_linenumber", r("l_quantity").alias("l_quantity"), r("l_discount").alias("l_discount"))


_DL = """dl AS (SELECT doc_id, quality, CAST(('0x' || substr(md5(CAST(doc_id AS VARCHAR) || '42'), 1, 13)) AS BIGINT) AS h
  FROM documents JOIN labels USING (doc_id))"""


def _dl(spark, sf):
    return table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id").select("doc_id", "quality")


@register("f11_stratified_split", sql=f"""
WITH {_DL} SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY h, doc_id)
  <= ceil(0.2 * count(*) OVER (PARTITION BY quality)) AS is_test FROM dl""")
def f11_stratified_split(spark, sf):
    return Fe.stratified_split(_dl(spark, sf), "doc_id", "quality", 0.2, 42)


@register("f12_select_features", sql="SELECT l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus FROM lineitem")
def f12_select_features(spark, sf):
    df, _ = Fe.select_features(table(spark, sf, "lineitem"), "all", exclude=["l_orderkey", "l_partkey"])
    return df


@register("f13_keep_with_missing", sql=f"""
WITH {_ORD} SELECT round(coalesce(price, (SELECT m FROM med)), 6) AS price, CAST(price IS NULL AS INTEGER) AS price_missing,
  coalesce(priority, (SELECT v FROM mode)) AS priority, CAST(priority IS NULL AS INTEGER) AS priority_missing FROM te""")
def f13_keep_with_missing(spark, sf):
    tr, te = _ord(spark, sf)
    fit = Fe.IndicatorThenImpute(tr.drop("empty"), ["price", "priority"])
    out = Fe.keep_with_missing(fit.transform(te.drop("empty")), ["price", "priority", "absent"])
    return out.withColumn("price", r("price"))


@register("f14_class_weights", sql="""
WITH dl AS (SELECT doc_id, quality FROM documents JOIN labels USING (doc_id)),
c AS (SELECT quality, count(*) AS nc FROM dl GROUP BY quality)
SELECT doc_id, quality, round((SELECT count(*) FROM dl) / ((SELECT count(*) FROM c) * nc), 6) AS weight FROM dl JOIN c USING (quality)""")
def f14_class_weights(spark, sf):
    return Fe.class_weights(_dl(spark, sf), "quality").select("doc_id", "quality", r("weight").alias("weight"))


@register("f15_stratified_folds", sql=f"""
WITH {_DL} SELECT doc_id, quality, CAST((row_number() OVER (PARTITION BY quality ORDER BY h, doc_id) - 1) % 5 AS INTEGER) AS fold FROM dl""")
def f15_stratified_folds(spark, sf):
    return Fe.stratified_folds(_dl(spark, sf), "doc_id", "quality", 5, 42)
