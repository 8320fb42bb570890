"""Queries of the level-wise tree (M1, M2, M10) and its rules (R1, R4), with
SQL twins that learn the same tree level by level."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import models as M
from ..operators import rules as R
from ..operators import search as Se
from ..operators import tree as T
from ..session import table
from .common import r
from .registry import register

FEATURES = ["o_totalprice", "order_year", "order_month", "c_acctbal", "c_nationkey"]
BINS, DEPTH, MIN_SPLIT, MIN_LEAF, MIN_DECREASE = 16, 4, 60, 20, 0.0001
LABELS = ["Agreement", "Disagreement"]


def _frame(spark, sf):
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    return o.join(c, o.o_custkey == c.c_custkey).select(
        "o_orderkey", "o_totalprice", F.year("o_orderdate").alias("order_year"), F.month("o_orderdate").alias("order_month"),
        "c_acctbal", "c_nationkey", (F.col("o_orderpriority").like("1%") | F.col("o_orderpriority").like("2%")).cast("int").alias("label"))


def _binned(spark, sf, bins=BINS):
    d = _frame(spark, sf).withColumn("fold", F.pmod(F.xxhash64("o_orderkey"), F.lit(5)).cast("int"))
    return T.bin_rows(d, FEATURES, "label", fold_col="fold", bins=bins)


def _nodes(spark, sf):
    spec = T.TreeSpec(max_depth=DEPTH, min_split=MIN_SPLIT, min_leaf=MIN_LEAF, min_decrease=MIN_DECREASE)
    return T.grow(_binned(spark, sf), [spec]).nodes()


def _rules(spark, sf):
    return R.extract_rules(T.saved_form(_nodes(spark, sf)), FEATURES, min_support=10, class_labels=LABELS)


def _gini(p: str, n: str) -> str:
    return f"(1.0 - ((({n} - {p}) / {n}::DOUBLE) * (({n} - {p}) / {n}::DOUBLE) + ({p} / {n}::DOUBLE) * ({p} / {n}::DOUBLE)))"


def _level_sql(d: int) -> str:
    may = "FALSE" if d == DEPTH else f"b < hi AND n >= {MIN_SPLIT} AND nl >= {MIN_LEAF} AND n - nl >= {MIN_LEAF} AND dec >= {MIN_DECREASE} AND g > 0"
    return f"""
h{d} AS (SELECT node, f, b, sum(y) AS p, count(*) AS n FROM at{d} JOIN binned USING (id) GROUP BY ALL),
w{d} AS (SELECT node, f, b, sum(p) OVER up AS pl, sum(n) OVER up AS nl, sum(p) OVER a AS p, sum(n) OVER a AS n, max(b) OVER a AS hi
  FROM h{d} WINDOW up AS (PARTITION BY node, f ORDER BY b), a AS (PARTITION BY node, f)),
g{d} AS (SELECT *, {_gini('p', 'n')} AS g, round((n * {_gini('p', 'n')} - nl * {_gini('pl', 'nl')}
    - (CASE WHEN n > nl THEN (n - nl) * {_gini('(p - pl)', '(n - nl)')} ELSE 0 END)) / (SELECT count(*) FROM at0), 12) AS dec FROM w{d}),
s{d} AS (SELECT node, f, b, dec, row_number() OVER (PARTITION BY node ORDER BY dec DESC, f, b) AS k FROM g{d} WHERE {may}),
n{d} AS (SELECT DISTINCT g.node, {d} AS depth, s.f, s.b, g.p, g.n, g.g, s.dec FROM g{d} g LEFT JOIN s{d} s ON g.node = s.node AND s.k = 1),
at{d + 1} AS (SELECT a.id, a.y, 2 * a.node + 1 + CAST(x.b > n.b AS INTEGER) AS node FROM at{d} a JOIN n{d} n ON a.node = n.node AND n.f IS NOT NULL
  JOIN binned x ON x.id = a.id AND x.f = n.f)"""


_TREE_SQL = f"""
src AS (SELECT o_orderkey AS id, CAST(o_orderpriority LIKE '1%' OR o_orderpriority LIKE '2%' AS INTEGER) AS y,
  [o_totalprice::DOUBLE, year(o_orderdate)::DOUBLE, month(o_orderdate)::DOUBLE, c_acctbal::DOUBLE, c_nationkey::DOUBLE] AS v
  FROM orders JOIN customer ON o_custkey = c_custkey),
long AS (SELECT id, f, v[f + 1] AS x FROM src, range({len(FEATURES)}) t(f)),
ranked AS (SELECT f, x, row_number() OVER (PARTITION BY f ORDER BY x) - 1 AS k, count(*) OVER (PARTITION BY f) AS n, max(x) OVER (PARTITION BY f) AS top
  FROM long WHERE x IS NOT NULL),
cuts AS (SELECT f, x AS c, row_number() OVER (PARTITION BY f ORDER BY x) - 1 AS b FROM (SELECT DISTINCT f, x FROM ranked, range(1, {BINS}) t(i)
  WHERE k = floor((n - 1) * (i / {BINS}.0)) AND x < top)),
binned AS (SELECT l.id, l.f, count(c.c) AS b FROM long l LEFT JOIN cuts c ON c.f = l.f AND c.c < l.x GROUP BY l.id, l.f),
at0 AS (SELECT id, y, 0 AS node FROM src WHERE y IS NOT NULL),{','.join(_level_sql(d) for d in range(DEPTH + 1))},
nodes AS (SELECT u.node, u.depth, ({FEATURES!r})[u.f + 1] AS name, c.c AS threshold, u.p, u.n, u.g, u.dec, CAST(2 * u.p > u.n AS INTEGER) AS prediction
  FROM ({' UNION ALL '.join(f'SELECT * FROM n{d}' for d in range(DEPTH + 1))}) u LEFT JOIN cuts c ON c.f = u.f AND c.b = u.b)"""

_RULES_SQL = f"""{_TREE_SQL},
walk AS (SELECT 0 AS node, []::VARCHAR[] AS conditions UNION ALL
  SELECT 2 * w.node + 1 + s, list_append(w.conditions, printf(CASE s WHEN 0 THEN '%s <= %.4f' ELSE '%s > %.4f' END, n.name, n.threshold))
  FROM walk w JOIN nodes n ON n.node = w.node AND n.name IS NOT NULL, range(2) t(s)),
rules AS (SELECT n.node AS rule_id, w.conditions, len(w.conditions) AS num_conditions, ({LABELS!r})[n.prediction + 1] AS prediction,
  n.n AS support, (CASE n.prediction WHEN 1 THEN n.p ELSE n.n - n.p END) / n.n AS confidence, n.depth
  FROM walk w JOIN nodes n USING (node) WHERE n.name IS NULL AND n.n >= 10)"""


@register("m1_histogram_tree", sql=f"""WITH RECURSIVE {_TREE_SQL}
SELECT node, depth, name, round(threshold, 6) AS threshold, n, p AS n_positive, round(g, 6) AS impurity, round(dec, 6) AS decrease, prediction FROM nodes""")
def m1_histogram_tree(spark, sf):
    """M1 with a minimum split size: the node table."""
    return _nodes(spark, sf).select("node", "depth", "name", r("threshold").alias("threshold"), "n", F.col("counts")[1].alias("n_positive"),
                                    r("impurity").alias("impurity"), r("decrease").alias("decrease"), "prediction")


@register("m1_histogram_tree_predictions", sql=f"""WITH RECURSIVE {_TREE_SQL},
leaf AS ({' UNION ALL '.join(f'SELECT a.id, a.node FROM at{d} a JOIN n{d} n ON a.node = n.node AND n.f IS NULL' for d in range(DEPTH + 1))})
SELECT id AS o_orderkey, node AS leaf, prediction FROM leaf JOIN nodes USING (node)""")
def m1_histogram_tree_predictions(spark, sf):
    return T.predict(_frame(spark, sf), _nodes(spark, sf), DEPTH).select("o_orderkey", "leaf", "prediction")


@register("m2_racing_search")
def m2_racing_search(spark, sf):
    """The studied search on all eight axes: 100 trials, 5 folds, raced."""
    trials, _ = Se.racing_search(_binned(spark, sf, 32))
    return trials.withColumn("cv_f1", r("cv_f1"))


@register("m10_histogram_tree_shape", sql=f"""WITH RECURSIVE {_TREE_SQL}
SELECT count(*) FILTER (name IS NULL) AS n_leaves, count(*) AS n_nodes, max(depth) AS depth, count(DISTINCT name) AS n_features_used,
  {len(FEATURES)} AS n_features_in FROM nodes""")
def m10_histogram_tree_shape(spark, sf):
    return M.tree_shape(T.saved_form(_nodes(spark, sf)), len(FEATURES))


@register("r1_histogram_tree_rules", sql=f"""WITH RECURSIVE {_RULES_SQL}
SELECT rule_id, array_to_string(conditions, ' AND ') AS conditions, num_conditions, prediction, support, round(confidence, 6) AS confidence, depth FROM rules""")
def r1_histogram_tree_rules(spark, sf):
    return _rules(spark, sf).select("rule_id", F.array_join("conditions", " AND ").alias("conditions"), "num_conditions", "prediction",
                                    "support", r("confidence").alias("confidence"), "depth")


@register("r4_tree_rule_features", sql=f"""WITH RECURSIVE {_RULES_SQL}
SELECT split_part(c, ' ', 1) AS feature, count(*) AS count FROM (SELECT unnest(conditions) AS c FROM rules) GROUP BY 1""")
def r4_tree_rule_features(spark, sf):
    return R.rule_patterns(_rules(spark, sf))[0]


@register("r4_condition_counts", sql=f"""WITH RECURSIVE {_RULES_SQL}
SELECT round(avg(num_conditions), 6) AS mean, min(num_conditions) AS min, max(num_conditions) AS max, count(*) AS n_rules,
  quantile_cont(num_conditions, 0.5) AS median FROM rules""")
def r4_condition_counts(spark, sf):
    return R.rule_patterns(_rules(spark, sf))[1].withColumn("mean", r("mean"))
