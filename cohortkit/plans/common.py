"""Shared building blocks for the registered queries and their SQL twins.

Every query derives its inputs from the driver tables the same way in both
engines (see FIXTURES.md roles): two graders from ``orders``, injected nulls
by key modulo, durations from ``events``, vectors from ``embeddings``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..session import table

ROUND = 6  # digits kept on floating outputs in both engines


def r(c, digits: int = ROUND) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, digits)


def inject_nulls(key: str, value: Column, null_mod: int = 7, sentinel_mod: int | None = None,
                 empty_mod: int | None = None, sentinel=S.NEVER_OCCURRED) -> Column:
    k = F.col(key)
    e = F.when(k % null_mod == 0, F.lit(None))
    if sentinel_mod:
        e = e.when(k % sentinel_mod == 0, F.lit(sentinel))
    if empty_mod:
        e = e.when(k % empty_mod == 0, F.lit(""))
    return e.otherwise(value)


def sql_inject(key: str, value: str, null_mod: int = 7, sentinel_mod: int | None = None,
               empty_mod: int | None = None, sentinel=S.NEVER_OCCURRED) -> str:
    s = f"CASE WHEN {key} % {null_mod} = 0 THEN NULL "
    if sentinel_mod:
        s += f"WHEN {key} % {sentinel_mod} = 0 THEN {sentinel} "
    if empty_mod:
        s += f"WHEN {key} % {empty_mod} = 0 THEN '' "
    return s + f"ELSE {value} END"


# ---- grades (P21 on text, A22 equal-width buckets on price) ---------------

def sql_grade_parse(x: str) -> str:
    """The P21 rule as DuckDB SQL."""
    num = f"TRY_CAST(trim({x}) AS DOUBLE)"
    low = f"lower(trim({x}))"
    roman = f"upper(regexp_extract({low}, '(grade|grado)\\s*([ivx]+)', 2))"
    digit = f"regexp_extract({low}, '\\b([1-5])\\b', 1)"
    return (f"CAST(CASE WHEN {x} IS NULL THEN NULL "
            f"WHEN {num} IS NOT NULL AND NOT isnan({num}) AND abs({num}) < 1e18 THEN CAST(round_even({num}, 0) AS INTEGER) "
            f"WHEN {roman} <> '' THEN CASE {roman} WHEN 'I' THEN 1 WHEN 'II' THEN 2 WHEN 'III' THEN 3 "
            f"WHEN 'IV' THEN 4 WHEN 'V' THEN 5 ELSE NULL END "
            f"WHEN {digit} <> '' THEN CAST({digit} AS INTEGER) END AS INTEGER)")


def grade_text(df: DataFrame) -> Column:
    """Mixed grade text exercising every P21 branch."""
    k = F.col("o_orderkey") % 4
    ga = S.grade_parse("o_orderpriority")
    roman = F.element_at(F.array(*[F.lit(x) for x in ["I", "II", "III", "IV", "V"]]), ga)
    return (F.when(k == 0, F.col("o_orderpriority"))
             .when(k == 1, F.concat(F.lit("Grado "), roman))
             .when(k == 2, (F.floor(F.col("o_totalprice") / 10000.0) / 10.0).cast("string"))
             .otherwise(F.concat(F.lit("Level "), (ga + 4).cast("string"))))


SQL_GRADE_TEXT = (
    "CASE WHEN o_orderkey % 4 = 0 THEN o_orderpriority "
    "WHEN o_orderkey % 4 = 1 THEN 'Grado ' || (['I','II','III','IV','V'])[" + sql_grade_parse("o_orderpriority") + "] "
    "WHEN o_orderkey % 4 = 2 THEN CAST(FLOOR(o_totalprice / 10000.0) / 10.0 AS VARCHAR) "
    "ELSE 'Level ' || CAST(" + sql_grade_parse("o_orderpriority") + " + 4 AS VARCHAR) END")


def graded_orders(spark: SparkSession, sf: str) -> DataFrame:
    """orders with grade_a (priority digit, P21) and grade_b (price bucket 1-5)."""
    o = table(spark, sf, "orders")
    stats = o.agg(F.min("o_totalprice").alias("mn"), F.max("o_totalprice").alias("mx"))
    mn = stats.select("mn").scalar()
    mx = stats.select("mx").scalar()
    gb = (F.least(F.floor((F.col("o_totalprice") - mn) / ((mx - mn) / 5)), F.lit(4)) + 1).cast("int")
    return o.withColumn("grade_a", S.grade_parse("o_orderpriority")).withColumn("grade_b", gb)


SQL_GRADED_ORDERS = f"""
graded AS (
  SELECT o.*, {sql_grade_parse('o_orderpriority')} AS grade_a,
         CAST(LEAST(FLOOR((o_totalprice - s.mn) / ((s.mx - s.mn) / 5)), 4) + 1 AS INTEGER) AS grade_b
  FROM orders o, (SELECT min(o_totalprice) AS mn, max(o_totalprice) AS mx FROM orders) s
)"""


# ---- durations from events (V1-V6) -----------------------------------------

def user_durations(spark: SparkSession, sf: str) -> DataFrame:
    """Per user: duration = days first -> last event, event = last type is
    'purchase', grp = user_id % 4."""
    e = table(spark, sf, "events")
    return (e.groupBy("user_id")
             .agg(F.datediff(F.max("ts"), F.min("ts")).cast("double").alias("duration"),
                  (F.max_by("event_type", F.struct("ts", "event_id")) == "purchase").cast("int").alias("event"))
             .withColumn("grp", (F.col("user_id") % 4).cast("int")))


SQL_USER_DURATIONS = """
durations AS (
  SELECT user_id, CAST(date_diff('day', CAST(min(ts) AS DATE), CAST(max(ts) AS DATE)) AS DOUBLE) AS duration,
         CAST(arg_max(event_type, (ts, event_id)) = 'purchase' AS INTEGER) AS event,
         CAST(user_id % 4 AS INTEGER) AS grp
  FROM events GROUP BY user_id
)"""


def sql_normalise(x: str) -> str:
    """The P19 rule as DuckDB SQL (DuckDB's own accent removal)."""
    s = f"trim(CAST({x} AS VARCHAR))"
    s = f"(CASE WHEN lower({s}) IN ('nan', 'none') THEN '' ELSE {s} END)"
    s = f"lower(strip_accents({s}))"
    s = f"regexp_replace({s}, '[\\x{{2010}}\\x{{2011}}\\x{{2012}}\\x{{2013}}\\x{{2014}}\\x{{2212}}-]+', ' ', 'g')"
    s = f"regexp_replace({s}, '[^\\p{{L}}\\p{{N}}_\\s]', ' ', 'g')"
    s = f"regexp_replace({s}, '\\s+', ' ', 'g')"
    return f"trim({s})"
