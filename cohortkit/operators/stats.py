"""Association and difference tests.

Statistics are aggregates over the data (one unpivot + one grouping for
all columns); p-values come from special functions applied to the
result-sized table (one row per test).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import special as SP
from .profile import long_values


def chi_square(df: DataFrame, cols: Sequence[str], target: str, yates: bool = True) -> DataFrame:
    """Pearson chi-square of each categorical column against ``target``
    (rows with a null in either are ignored, like ``crosstab``).

    ``chi2 = sum((o - e)^2 / e) + (n - sum(e))`` over observed cells (an empty
    cell adds its e), so no grid is built, except for 2x2 tables with ``yates``: then every cell
    is corrected by ``min(0.5, |o - e|)`` towards e (scipy's rule), and the
    four cells are completed from the margins.
    Returns ``(column, chi2, dof, n, p_value)``.
    """
    lv = long_values(df, cols, [target]).where(F.col("value").isNotNull() & F.col(target).isNotNull())
    obs = lv.groupBy("variable", "value", target).agg(F.count(F.lit(1)).alias("o"))
    rows = obs.groupBy("variable", "value").agg(F.sum("o").alias("r"))
    colm = obs.groupBy("variable", target).agg(F.sum("o").alias("c"))
    tot = rows.groupBy("variable").agg(F.sum("r").alias("n"), F.count(F.lit(1)).alias("nr"))
    tot = tot.join(colm.groupBy("variable").agg(F.count(F.lit(1)).alias("nc")), "variable")
    tot = tot.withColumn("dof", ((F.col("nr") - 1) * (F.col("nc") - 1)).cast("long"))
    cells = (obs.join(rows, ["variable", "value"]).join(colm, ["variable", target]).join(tot, "variable")
                .withColumn("e", F.col("r") * F.col("c") / F.col("n")))
    plain = cells.groupBy("variable").agg(F.sum((F.col("o") - F.col("e")) * (F.col("o") - F.col("e")) / F.col("e")).alias("s"), F.sum("e").alias("se")) \
                 .join(tot, "variable").select("variable", (F.col("s") + (F.col("n") - F.col("se"))).alias("chi2"), "dof", "n")
    if not yates:
        res = plain
    else:
        t22 = tot.where(F.col("dof") == 1)
        grid = (rows.join(t22, "variable").join(colm, "variable")
                    .withColumn("e", F.col("r") * F.col("c") / F.col("n")))
        g = grid.join(obs, ["variable", "value", target], "left").withColumn("o", F.coalesce("o", F.lit(0)))
        d = F.col("e") - F.col("o")
        corr = F.col("o") + F.signum(d) * F.least(F.lit(0.5), F.abs(d))
        y = g.groupBy("variable").agg(F.sum((corr - F.col("e")) * (corr - F.col("e")) / F.col("e")).alias("chi2_y"))
        res = plain.join(y, "variable", "left").select(
            "variable", F.when(F.col("dof") == 1, F.col("chi2_y")).otherwise(F.col("chi2")).alias("chi2"), "dof", "n")
    return res.withColumn("p_value", SP.chi2_sf_udf(F.col("chi2"), F.col("dof").cast("double")))


def top_by_p(tests: DataFrame, k: int = 3) -> DataFrame:
    """The k tests with the smallest p (ties by column name)."""
    return tests.orderBy(F.col("p_value").asc(), F.col("variable").asc()).limit(k)


def welch_t(df: DataFrame, cols: Sequence[str], target: str, class_a, class_b) -> DataFrame:
    """Welch's t-test per numeric column between two classes.  Nulls are
    dropped per column (the studied code let them turn the result NaN).
    Returns ``(column, n_a, n_b, mean_a, mean_b, t, df, p_value)``."""
    lv = long_values(df, cols, [target], as_double=True).where(
        F.col("value").isNotNull() & F.col(target).isin([class_a, class_b]))
    s = lv.groupBy("variable").agg(
        F.count(F.when(F.col(target) == class_a, F.col("value"))).alias("n_a"),
        F.count(F.when(F.col(target) == class_b, F.col("value"))).alias("n_b"),
        F.avg(F.when(F.col(target) == class_a, F.col("value"))).alias("mean_a"),
        F.avg(F.when(F.col(target) == class_b, F.col("value"))).alias("mean_b"),
        F.var_samp(F.when(F.col(target) == class_a, F.col("value"))).alias("var_a"),
        F.var_samp(F.when(F.col(target) == class_b, F.col("value"))).alias("var_b"))
    sa = F.col("var_a") / F.col("n_a")
    sb = F.col("var_b") / F.col("n_b")
    t = (F.col("mean_a") - F.col("mean_b")) / F.sqrt(sa + sb)
    dof = (sa + sb) * (sa + sb) / (sa * sa / (F.col("n_a") - 1) + sb * sb / (F.col("n_b") - 1))
    out = s.withColumn("t", t).withColumn("df", dof)
    return out.withColumn("p_value", SP.t_two_sided_p_udf(F.col("t"), F.col("df")))


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """T4: pairwise-complete Pearson r for all pairs in one aggregation;
    long form ``(feature_1, feature_2, r)`` for the full square matrix."""
    cols = list(cols)
    aggs = []
    for i, a in enumerate(cols):
        for b in cols[i + 1:]:
            aggs.append(F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}\u0001{b}"))
    if not aggs:
        return df.sparkSession.createDataFrame([(c, c, 1.0) for c in cols], "feature_1 string, feature_2 string, r double")
    wide = df.agg(*aggs)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    stack = F.stack(F.lit(2 * len(pairs) + len(cols)),
                    *[x for a, b in pairs for x in (F.lit(a), F.lit(b), F.col(f"`{a}\u0001{b}`"))],
                    *[x for a, b in pairs for x in (F.lit(b), F.lit(a), F.col(f"`{a}\u0001{b}`"))],
                    *[x for c in cols for x in (F.lit(c), F.lit(c), F.lit(1.0))])
    return wide.select(stack.alias("feature_1", "feature_2", "r"))


def strong_pairs(corr: DataFrame, cols: Sequence[str], threshold: float = 0.5) -> DataFrame:
    """T5: upper-triangle pairs (column order) with |r| > threshold."""
    order = {c: i for i, c in enumerate(cols)}
    pos = F.create_map(*[x for c, i in order.items() for x in (F.lit(c), F.lit(i))])
    return corr.where((pos[F.col("feature_1")] < pos[F.col("feature_2")]) & (F.abs("r") > threshold))


def mcnemar(pairs: DataFrame, correct_a: str = "correct_base", correct_b: str = "correct_variant",
            exact_below: int = 25) -> DataFrame:
    """McNemar test of two classifiers on the same rows.

    n12 = a right / b wrong, n21 = a wrong / b right.  Fewer than
    ``exact_below`` discordant pairs: exact binomial, statistic = min(n12, n21),
    p = min(1, 2 * P(X <= min)).  Otherwise chi-square with continuity
    correction, statistic = (|n12 - n21| - 1)^2 / (n12 + n21), 1 dof.
    """
    a, b = F.col(correct_a) == 1, F.col(correct_b) == 1
    return mcnemar_of_counts(pairs.agg(F.count_if(a & b).alias("n11"), F.count_if(a & ~b).alias("n12"),
                                       F.count_if(~a & b).alias("n21"), F.count_if(~a & ~b).alias("n22")), exact_below)


def mcnemar_of_counts(t: DataFrame, exact_below: int = 25) -> DataFrame:
    """T9 from the counts n11, n12, n21, n22, one test a row."""
    n = F.col("n12") + F.col("n21")
    k = F.least("n12", "n21")
    # exact two-sided binomial(n, 1/2) tail: sum_{i<=k} C(n, i) / 2^n, built term by term
    acc = F.aggregate(F.sequence(F.lit(1), F.greatest(k.cast("int"), F.lit(1))),
                      F.struct(F.pow(F.lit(0.5), n.cast("double")).alias("term"),
                               F.pow(F.lit(0.5), n.cast("double")).alias("total")),
                      lambda s, i: F.struct((s["term"] * (n - i + 1) / i).alias("term"),
                                            (s["total"] + s["term"] * (n - i + 1) / i).alias("total")))
    cdf = F.when(k == 0, F.pow(F.lit(0.5), n.cast("double"))).otherwise(acc["total"])
    exact = n < exact_below
    stat = F.when(n == 0, F.lit(0.0)).when(exact, k.cast("double")) \
            .otherwise((F.abs(F.col("n12") - F.col("n21")) - 1) ** 2 / n)
    out = t.withColumn("n_discordant", n).withColumn("method", F.when(exact, "exact").otherwise("chi2")) \
           .withColumn("statistic", stat)
    p = F.when(n == 0, F.lit(1.0)).when(exact, F.least(F.lit(1.0), 2 * cdf)) \
         .otherwise(SP.chi2_sf_udf(F.col("statistic"), F.lit(1.0)))
    return out.withColumn("p_value", p)


def kl_divergence(df: DataFrame, actual: str, pred: str, labels: Sequence[int], eps: float = 1e-12) -> DataFrame:
    """KL(P_actual || P_pred) of the label distributions on a fixed
    support with additive smoothing ``eps``; values outside the support are
    not counted (their share still enters the totals, as the reference)."""
    k = len(labels)
    lab = F.array(*[F.lit(int(x)) for x in labels])
    c = df.agg(F.count(F.lit(1)).alias("n_rows"),
               *[F.count_if(F.col(actual) == x).alias(f"p{i}") for i, x in enumerate(labels)],
               *[F.count_if(F.col(pred) == x).alias(f"q{i}") for i, x in enumerate(labels)])
    ps = [F.col(f"p{i}") for i in range(k)]
    qs = [F.col(f"q{i}") for i in range(k)]
    psum = sum(ps[1:], ps[0])
    qsum = sum(qs[1:], qs[0])
    terms = []
    for i in range(k):
        p = (ps[i] + eps) / (psum + eps * k)
        q = (qs[i] + eps) / (qsum + eps * k)
        terms.append(p * F.log(p / q))
    return c.select("n_rows", sum(terms[1:], terms[0]).alias("kl_divergence"))
