"""Evaluation and latent-vector queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as S
from ..functions import vectors as V
from ..operators import evaluate as Ev
from ..operators import latent as Lt
from ..operators import linkage as L
from ..session import table
from .common import SQL_GRADED_ORDERS, graded_orders, r
from .registry import register


def _bin(spark, sf):
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    return d.select("doc_id", "quality", "n_chars", (F.col("n_chars") > 2000).cast("int").alias("pred"))


_BIN = "b AS (SELECT doc_id, quality, n_chars, CAST(n_chars > 2000 AS INTEGER) AS pred FROM documents JOIN labels USING (doc_id))"


@register("e1_binary_metrics", sql=f"""
WITH {_BIN}, c AS (SELECT count_if(quality = 1 AND pred = 1) AS tp, count_if(quality <> 1 AND pred = 1) AS fp,
  count_if(quality = 1 AND pred <> 1) AS fn, count_if(quality <> 1 AND pred <> 1) AS tn FROM b)
SELECT tp, fp, fn, tn, round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy,
  round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, 6) AS precision,
  round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END, 6) AS recall,
  round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END, 6) AS f1 FROM c""")
def e1_binary_metrics(spark, sf):
    m = Ev.binary_metrics(_bin(spark, sf), "quality", "pred")
    return m.select("tp", "fp", "fn", "tn", *[r(c).alias(c) for c in ["accuracy", "precision", "recall", "f1"]])


_SC = f"""{_BIN}, sc AS (SELECT CAST(n_chars AS DOUBLE) AS score, count_if(quality = 1) AS pos, count_if(quality <> 1) AS neg FROM b GROUP BY 1)"""


@register("e2_roc_auc", sql=f"""
WITH {_SC}, rr AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb FROM sc)
SELECT round(sum(pos * (nb + neg / 2.0)) / (sum(pos) * sum(neg)), 9) AS roc_auc, CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg FROM rr""")
def e2_roc_auc(spark, sf):
    a = Ev.roc_auc(_bin(spark, sf), "quality", "n_chars")
    return a.select(r("roc_auc", 9).alias("roc_auc"), F.col("n_pos").cast("long").alias("n_pos"),
                    F.col("n_neg").cast("long").alias("n_neg"))


@register("e3_roc_curve", sql=f"""
WITH {_SC}, rr AS (SELECT score, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp FROM sc WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING))
SELECT CAST(NULL AS DOUBLE) AS threshold, 0.0 AS fpr, 0.0 AS tpr
UNION ALL SELECT score, round(fp / (SELECT sum(neg) FROM sc), 9), round(tp / (SELECT sum(pos) FROM sc), 9) FROM rr""")
def e3_roc_curve(spark, sf):
    c = Ev.roc_curve(_bin(spark, sf), "quality", "n_chars")
    return c.select(F.when(F.col("threshold") == float("inf"), None).otherwise(F.col("threshold")).alias("threshold"),
                    r("fpr", 9).alias("fpr"), r("tpr", 9).alias("tpr"))


_GRID = f"""{SQL_GRADED_ORDERS}, lab AS (SELECT CAST(range AS INTEGER) AS k FROM range(1, 6)),
cm AS (SELECT a.k AS actual, p.k AS predicted, (SELECT count(*) FROM graded WHERE grade_a = a.k AND grade_b = p.k) AS count FROM lab a, lab p),
per AS (SELECT c.k AS class, (SELECT sum(count) FROM cm WHERE actual = c.k) AS support, (SELECT sum(count) FROM cm WHERE predicted = c.k) AS npred,
  (SELECT sum(count) FROM cm WHERE actual = c.k AND predicted = c.k) AS tp FROM lab c),
rep AS (SELECT CAST(class AS VARCHAR) AS class, support, CASE WHEN npred > 0 THEN tp / npred ELSE 0 END AS precision,
  CASE WHEN support > 0 THEN tp / support ELSE 0 END AS recall, CASE WHEN support + npred > 0 THEN 2 * tp / (support + npred) ELSE 0 END AS f1 FROM per),
rep2 AS (SELECT * FROM rep UNION ALL SELECT 'macro avg', sum(support), avg(precision), avg(recall), avg(f1) FROM rep
  UNION ALL SELECT 'weighted avg', sum(support), sum(precision * support) / sum(support), sum(recall * support) / sum(support), sum(f1 * support) / sum(support) FROM rep)"""


@register("e4_confusion_matrix", sql=f"WITH {_GRID} SELECT actual, predicted, count FROM cm")
def e4_confusion_matrix(spark, sf):
    return Ev.confusion_matrix(graded_orders(spark, sf), "grade_a", "grade_b", [1, 2, 3, 4, 5])


@register("e5_classification_report", sql=f"""
WITH {_GRID} SELECT class, CAST(support AS BIGINT) AS support, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM rep2""")
def e5_classification_report(spark, sf):
    c = Ev.classification_report(graded_orders(spark, sf), "grade_a", "grade_b", [1, 2, 3, 4, 5])
    return c.select("class", F.col("support").cast("long").alias("support"),
                    *[r(x).alias(x) for x in ["precision", "recall", "f1"]])


@register("e6_weighted_f1", sql=f"WITH {_GRID} SELECT round(f1, 6) AS weighted_f1 FROM rep2 WHERE class = 'weighted avg'")
def e6_weighted_f1(spark, sf):
    return Ev.weighted_f1(graded_orders(spark, sf), "grade_a", "grade_b", [1, 2, 3, 4, 5]).select(r("weighted_f1").alias("weighted_f1"))


@register("e7_ordinal_report", sql=f"""
WITH {_GRID}, c AS (SELECT k, (SELECT count(*) FROM graded WHERE grade_a = k) AS p, (SELECT count(*) FROM graded WHERE grade_b = k) AS q FROM lab),
s AS (SELECT sum(p) AS sp, sum(q) AS sq FROM c),
kl AS (SELECT sum(((p + 1e-12) / (sp + 5e-12)) * ln(((p + 1e-12) / (sp + 5e-12)) / ((q + 1e-12) / (sq + 5e-12)))) AS kl FROM c, s)
SELECT count(*) AS n, round(avg(CAST(grade_a = grade_b AS DOUBLE)), 6) AS accuracy, round(CAST(sum(abs(grade_b - grade_a)) AS DOUBLE), 6) AS total_abs_error,
  round(avg(abs(grade_b - grade_a)), 6) AS mae, round(sqrt(avg((grade_b - grade_a) * (grade_b - grade_a))), 6) AS rmse,
  count_if(grade_a < 1 OR grade_a > 5) AS actual_out_of_range, count_if(grade_b < 1 OR grade_b > 5) AS pred_out_of_range,
  round((SELECT kl FROM kl), 9) AS kl_divergence, round((SELECT f1 FROM rep2 WHERE class = 'weighted avg'), 6) AS weighted_f1 FROM graded""")
def e7_ordinal_report(spark, sf):
    o = Ev.ordinal_report(graded_orders(spark, sf), "grade_a", "grade_b", [1, 2, 3, 4, 5])
    return o.select("n", *[r(c).alias(c) for c in ["accuracy", "total_abs_error", "mae", "rmse"]],
                    "actual_out_of_range", "pred_out_of_range", r("kl_divergence", 9).alias("kl_divergence"),
                    r("weighted_f1").alias("weighted_f1"))


@register("e8_rmse_raw", sql=f"WITH {SQL_GRADED_ORDERS} SELECT round(sqrt(avg(power(o_totalprice / 100000.0 - grade_a, 2))), 6) AS rmse FROM graded")
def e8_rmse_raw(spark, sf):
    g = graded_orders(spark, sf).withColumn("raw", F.col("o_totalprice") / 100000.0)
    return Ev.rmse(g, "grade_a", "raw").select(r("rmse").alias("rmse"))


def _models(spark, sf):
    g = graded_orders(spark, sf).withColumn("pv", F.bround((F.col("grade_a") + F.col("grade_b")) / 2.0, 0).cast("int")) \
        .withColumn("clip", S.clip_round_grade(F.col("o_totalprice") / 100000.0 - 0.5).cast("int"))
    parts = []
    for name, col in [("baseline", "grade_b"), ("variant", "pv"), ("clipped_raw", "clip")]:
        m = g.agg(F.avg((F.col("grade_a") == F.col(col)).cast("double")).alias("accuracy"),
                  F.avg(F.abs(F.col(col) - F.col("grade_a"))).alias("mae"))
        parts.append(m.select(F.lit(name).alias("model"),
                              F.stack(F.lit(2), F.lit("accuracy"), "accuracy", F.lit("mae"), "mae").alias("metric", "value")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("e9_model_comparison", sql=f"""
WITH {SQL_GRADED_ORDERS}, g AS (SELECT *, CAST(round_even((grade_a + grade_b) / 2.0, 0) AS INTEGER) AS pv,
  CAST(round_even(GREATEST(1.0, LEAST(5.0, o_totalprice / 100000.0 - 0.5)), 0) AS INTEGER) AS clip FROM graded),
m AS (SELECT 'baseline' AS model, 'accuracy' AS metric, avg(CAST(grade_a = grade_b AS DOUBLE)) AS value FROM g
  UNION ALL SELECT 'baseline', 'mae', avg(abs(grade_b - grade_a)) FROM g
  UNION ALL SELECT 'variant', 'accuracy', avg(CAST(grade_a = pv AS DOUBLE)) FROM g UNION ALL SELECT 'variant', 'mae', avg(abs(pv - grade_a)) FROM g
  UNION ALL SELECT 'clipped_raw', 'accuracy', avg(CAST(grade_a = clip AS DOUBLE)) FROM g UNION ALL SELECT 'clipped_raw', 'mae', avg(abs(clip - grade_a)) FROM g)
SELECT m.model, m.metric, round(m.value, 6) AS value, round(m.value - b.value, 6) AS delta FROM m JOIN m b ON b.model = 'baseline' AND b.metric = m.metric""")
def e9_model_comparison(spark, sf):
    c = Ev.compare_to_baseline(_models(spark, sf), "baseline")
    return c.select("model", "metric", r("value").alias("value"), r("delta").alias("delta"))


@register("e10_baseline_mask", sql=f"""
WITH {SQL_GRADED_ORDERS} SELECT o_orderkey, grade_a, grade_b FROM graded WHERE o_orderkey % 7 <> 0""")
def e10_baseline_mask(spark, sf):
    g = graded_orders(spark, sf).withColumn("grade_b", F.when(F.col("o_orderkey") % 7 == 0, None).otherwise(F.col("grade_b")))
    return Ev.with_baseline(g, "grade_b").select("o_orderkey", "grade_a", "grade_b")


# ---- latent vectors ------------------------------------------------------------

def _pairs(spark, sf):
    e = table(spark, sf, "embeddings")
    p = L.pair_by_rank(e.where(F.col("vec_id") % 2 == 0), e.where(F.col("vec_id") % 2 == 1), "label", "vec_id")
    return p.withColumn("logvar_a", F.transform("embedding_a", lambda x: -F.abs(x))) \
            .withColumn("logvar_b", F.transform("embedding_b", lambda x: -F.abs(x)))


_PAIRS = """a AS (SELECT vec_id, label, embedding, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS pair_rank FROM embeddings WHERE vec_id % 2 = 0),
bb AS (SELECT vec_id, label, embedding, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS pair_rank FROM embeddings WHERE vec_id % 2 = 1),
p AS (SELECT a.label, a.pair_rank, a.vec_id AS vec_id_a, bb.vec_id AS vec_id_b, a.embedding AS ea, bb.embedding AS eb
  FROM a JOIN bb ON a.label = bb.label AND a.pair_rank = bb.pair_rank),
u AS (SELECT vec_id_a, label, generate_subscripts(ea, 1) - 1 AS pos, CAST(unnest(ea) AS DOUBLE) AS x, CAST(unnest(eb) AS DOUBLE) AS y FROM p)"""


def _long(df, key, arrays):
    z = df.select(key, F.posexplode(F.arrays_zip(*[c.alias(n) for n, c in arrays.items()])).alias("pos", "z"))
    return z.select(key, "pos", *[r(F.col(f"z.{n}")).alias(n) for n in arrays])


@register("l1_product_of_experts", sql=f"""
WITH {_PAIRS}, w AS (SELECT *, 1.0 / (exp(-abs(x)) + 1e-8) AS pa, 1.0 / (exp(-abs(y)) + 1e-8) AS pb FROM u)
SELECT vec_id_a, pos, round((1.0 / (pa + pb)) * (x * pa + y * pb), 6) AS mu, round(ln(1.0 / (pa + pb)), 6) AS logvar FROM w""")
def l1_product_of_experts(spark, sf):
    p = _pairs(spark, sf)
    mu, lv = Lt.product_of_experts(["embedding_a", "embedding_b"], ["logvar_a", "logvar_b"])
    return _long(p, "vec_id_a", {"mu": mu, "logvar": lv})


@register("l2_mixture_of_experts", sql=f"""
WITH {_PAIRS} SELECT vec_id_a, pos, round(0.5 * (x + y), 6) AS mu, round(0.5 * (-abs(x) - abs(y)), 6) AS logvar FROM u""")
def l2_mixture_of_experts(spark, sf):
    p = _pairs(spark, sf)
    mu, lv = Lt.mixture_of_experts(["embedding_a", "embedding_b"], ["logvar_a", "logvar_b"])
    return _long(p, "vec_id_a", {"mu": mu, "logvar": lv})


@register("l3_kl_free_bits", sql=f"""
WITH {_PAIRS} SELECT vec_id_a, round(sum(greatest(0.05, -0.5 * (1 - abs(x) - x * x - exp(-abs(x))))), 6) AS kl FROM u GROUP BY vec_id_a""")
def l3_kl_free_bits(spark, sf):
    p = _pairs(spark, sf)
    return p.select("vec_id_a", r(Lt.kl_unit_gaussian("embedding_a", "logvar_a", 0.05)).alias("kl"))


@register("l4_mmd_linear", sql="""
WITH u AS (SELECT vec_id % 2 AS view, generate_subscripts(embedding, 1) AS pos, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings),
m AS (SELECT pos, avg(CASE WHEN view = 0 THEN x END) AS ma, avg(CASE WHEN view = 1 THEN x END) AS mb FROM u GROUP BY pos)
SELECT round(sum((ma - mb) * (ma - mb)), 9) AS mmd2 FROM m""")
def l4_mmd_linear(spark, sf):
    e = table(spark, sf, "embeddings")
    a = e.where(F.col("vec_id") % 2 == 0).select(F.col("embedding").alias("a"))
    b = e.where(F.col("vec_id") % 2 == 1).select(F.col("embedding").alias("b"))
    return Lt.mmd_linear_sets(a, "a", b, "b").select(r("mmd2", 9).alias("mmd2"))


@register("l4_mmd_rbf")
def l4_mmd_rbf(spark, sf):
    """Embeddings of even against odd ids, by random Fourier features."""
    e = table(spark, sf, "embeddings")
    return Lt.mmd_rbf_sets(e.where(F.col("vec_id") % 2 == 0), "embedding", e.where(F.col("vec_id") % 2 == 1), "embedding", 0.01)


@register("l6_domain_loss", sql=f"""
WITH {_PAIRS}, m AS (SELECT vec_id_a, avg(x) AS ma, avg(y) AS mb FROM u GROUP BY vec_id_a)
SELECT round(sum(ln(exp(-ma) + exp(ma)) + ma) + sum(ln(exp(-mb) + exp(mb)) - mb), 6) AS domain_loss FROM m""")
def l6_domain_loss(spark, sf):
    return Lt.domain_loss(_pairs(spark, sf), "embedding_a", "embedding_b").select(r("domain_loss").alias("domain_loss"))


@register("l7_squared_error", sql=f"WITH {_PAIRS} SELECT vec_id_a, round(1.5 * sum((x - y) * (x - y)), 6) AS sse FROM u GROUP BY vec_id_a")
def l7_squared_error(spark, sf):
    p = _pairs(spark, sf)
    return p.select("vec_id_a", r(Lt.squared_error("embedding_a", "embedding_b", 1.5)).alias("sse"))


# ten logits from the whole vector: sums of every tenth coordinate
_L10 = "[list_sum([CAST(embedding[i] AS DOUBLE) FOR i IN range(j, len(embedding) + 1, 10)]) FOR j IN range(1, 11)]"


def _logits(vec: str):
    def tenth(j: int):
        return F.aggregate(F.filter(vec, lambda x, i: i % 10 == j), F.lit(0.0), lambda a, x: a + x.cast("double"))
    return F.array(*[tenth(j) for j in range(10)])



@register("l8_total_loss", sql=f"""
WITH {_PAIRS}, rk AS (SELECT vec_id_a, sum((x - y) * (x - y)) AS recon, sum(-0.5 * (1 - abs(x) - x * x - exp(-abs(x)))) AS kl, avg(x) AS ma, avg(y) AS mb FROM u GROUP BY vec_id_a),
ce AS (SELECT vec_id AS vec_id_a, ln(list_sum(list_transform({_L10}, lambda v: exp(v - list_max({_L10}))))) + list_max({_L10}) - ({_L10})[label + 1] AS clf FROM embeddings),
t AS (SELECT sum(recon) AS recon, sum(kl) AS kl, sum(clf) AS clf,
  sum(ln(exp(-ma) + exp(ma)) + ma) + sum(ln(exp(-mb) + exp(mb)) - mb) AS domain FROM rk JOIN ce USING (vec_id_a))
SELECT round(recon, 4) AS recon, round(kl, 4) AS kl, round(clf, 4) AS clf, round(domain, 4) AS domain,
  round(recon + 1.0 * kl + 5.0 * clf + 0.5 * domain, 4) AS total FROM t""")
def l8_total_loss(spark, sf):
    p = _pairs(spark, sf).withColumn("label_a", F.col("label"))
    rows = p.select(V.sqdist("embedding_a", "embedding_b").alias("recon"),
                    Lt.kl_unit_gaussian("embedding_a", "logvar_a").alias("kl"),
                    Lt.cross_entropy(_logits("embedding_a"), "label").alias("clf"))
    agg = rows.agg(F.sum("recon").alias("recon"), F.sum("kl").alias("kl"), F.sum("clf").alias("clf"))
    dom = Lt.domain_loss(p, "embedding_a", "embedding_b")
    t = agg.withColumn("domain", dom.scalar())
    t = t.withColumn("total", Lt.total_loss(F.col("recon"), F.col("kl"), F.col("clf"), F.col("domain"), beta=1.0, gamma=0.5))
    return t.select(*[r(c, 4).alias(c) for c in ["recon", "kl", "clf", "domain", "total"]])


@register("l9_latent_stats", sql="""
WITH u AS (SELECT CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings)
SELECT round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS std, round(min(x), 6) AS min, round(max(x), 6) AS max, count(*) AS n_values FROM u""")
def l9_latent_stats(spark, sf):
    s = Lt.latent_stats(table(spark, sf, "embeddings"), "embedding")
    return s.select(*[r(c).alias(c) for c in ["mean", "std", "min", "max"]], "n_values")


@register("l10_cross_entropy", sql=f"""
SELECT vec_id, round(ln(list_sum(list_transform({_L10}, lambda v: exp(v - list_max({_L10}))))) + list_max({_L10}) - ({_L10})[label + 1], 6) AS ce FROM embeddings""")
def l10_cross_entropy(spark, sf):
    e = table(spark, sf, "embeddings")
    return e.select("vec_id", r(Lt.cross_entropy(_logits("embedding"), "label")).alias("ce"))
