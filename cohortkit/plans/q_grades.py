"""Grader disagreement queries: the first slice (P21 + P23 + A11 + A9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import profile as Pr
from .common import (SQL_GRADE_TEXT, SQL_GRADED_ORDERS, grade_text, graded_orders, r,
                     sql_grade_parse)
from .registry import register
from ..session import table


@register("a9_grade_crosstab", sql=f"""
WITH {SQL_GRADED_ORDERS}
SELECT grade_a, grade_b, count(*) AS count,
       round(count(*) / (SELECT count(*) FROM graded), 6) AS share
FROM graded GROUP BY grade_a, grade_b""")
def a9_grade_crosstab(spark, sf):
    """Flagship: where do the two graders disagree? Cross-tab with shares."""
    g = graded_orders(spark, sf)
    ct = Pr.crosstab(g, "grade_a", "grade_b")
    return Pr.with_share(ct).withColumn("share", r("share"))


@register("p21_grade_parse", sql=f"""
WITH t AS (SELECT o_orderkey, o_orderpriority, o_totalprice, {SQL_GRADE_TEXT} AS grade_text FROM orders)
SELECT o_orderkey, grade_text, {sql_grade_parse('grade_text')} AS grade FROM t""")
def p21_grade_parse(spark, sf):
    o = table(spark, sf, "orders")
    t = o.withColumn("grade_text", grade_text(o))
    return t.select("o_orderkey", "grade_text", S.grade_parse("grade_text").alias("grade"))


@register("p22_clip_round_grade", sql="""
SELECT o_orderkey, CAST(round_even(GREATEST(1.0, LEAST(5.0, o_totalprice / 100000.0 - 0.5)), 0) AS DOUBLE) AS grade
FROM orders""")
def p22_clip_round_grade(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", S.clip_round_grade(F.col("o_totalprice") / 100000.0 - 0.5).alias("grade"))


@register("p23_disagreement", sql=f"""
WITH {SQL_GRADED_ORDERS}
SELECT o_orderkey, grade_a, grade_b, CAST(grade_a <> grade_b AS INTEGER) AS disagree,
       CAST(abs(grade_a - grade_b) AS INTEGER) AS magnitude FROM graded""")
def p23_disagreement(spark, sf):
    g = graded_orders(spark, sf)
    return g.select("o_orderkey", "grade_a", "grade_b",
                    S.disagreement_flag("grade_a", "grade_b").alias("disagree"),
                    S.disagreement_magnitude("grade_a", "grade_b").alias("magnitude"))


@register("a11_agreement_overview", sql=f"""
WITH {SQL_GRADED_ORDERS}
SELECT count(*) AS n, count_if(grade_a = grade_b) AS n_agree, count_if(grade_a <> grade_b) AS n_disagree,
       round(count_if(grade_a = grade_b) / count(*), 6) AS agree_rate,
       round(count_if(grade_a <> grade_b) / count(*), 6) AS disagree_rate
FROM graded WHERE grade_a IS NOT NULL AND grade_b IS NOT NULL""")
def a11_agreement_overview(spark, sf):
    g = graded_orders(spark, sf)
    a = Pr.agreement_overview(g, "grade_a", "grade_b")
    return a.withColumn("agree_rate", r("agree_rate")).withColumn("disagree_rate", r("disagree_rate"))


@register("a11_disagreement_rows", sql=f"""
WITH {SQL_GRADED_ORDERS}
SELECT o_orderkey, grade_a, grade_b FROM graded
WHERE grade_a IS NOT NULL AND grade_b IS NOT NULL AND grade_a <> grade_b""")
def a11_disagreement_rows(spark, sf):
    g = graded_orders(spark, sf)
    return Pr.disagreements(g, "grade_a", "grade_b").select("o_orderkey", "grade_a", "grade_b")


@register("a12_magnitude_distribution", sql=f"""
WITH {SQL_GRADED_ORDERS}
SELECT CAST(abs(grade_a - grade_b) AS INTEGER) AS magnitude, count(*) AS count
FROM graded WHERE grade_a IS NOT NULL AND grade_b IS NOT NULL GROUP BY 1""")
def a12_magnitude_distribution(spark, sf):
    return Pr.magnitude_distribution(graded_orders(spark, sf), "grade_a", "grade_b")


@register("a10_crosstab_row_pct", sql=f"""
WITH {SQL_GRADED_ORDERS}, ct AS (SELECT grade_a, grade_b, count(*) AS count FROM graded
  WHERE grade_a IS NOT NULL AND grade_b IS NOT NULL GROUP BY 1, 2)
SELECT grade_a, grade_b, count, round(count * 100.0 / sum(count) OVER (PARTITION BY grade_a), 6) AS row_pct FROM ct""")
def a10_crosstab_row_pct(spark, sf):
    ct = Pr.crosstab_row_pct(graded_orders(spark, sf), "grade_a", "grade_b")
    return ct.withColumn("row_pct", r("row_pct"))
