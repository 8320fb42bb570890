"""Trees grown on packed rows against Spark ML's own."""

import itertools

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from cohortkit.operators import models as M
from cohortkit.operators import packed as P


def rows(spark, n, parts=1):
    """Made-up rows: numbers with repeats and zeros, a category, grades that depend on them."""
    x = [(i * 7919 % 1009 / 10 - 20, float(i * 31 % 12), "abcde"[i * 17 % 23 % 5], i % 97 / 7) for i in range(n)]
    y = [float(1 + int(abs(a) // 25 + b // 4 + (c in "bd") + i * 13 % 3) % 5) for i, (a, b, c, d) in enumerate(x)]
    df = spark.createDataFrame([(i, *r, g) for i, (r, g) in enumerate(zip(x, y))], "k long, a double, b double, c string, d double, y double").coalesce(1)
    df = df.withColumn("label", (F.col("y") > 2).cast("int")).withColumn("fold", F.pmod(F.hash("k"), F.lit(3)))
    df = df.withColumn("weight", F.when(F.col("label") == 1, 0.8).otherwise(1.3)).withColumn("unit_weight", F.lit(1.0))
    if parts > 1:
        df = df.repartitionByRange(parts, "k")
    stages, _ = M.feature_stages(["a", "b", "d"], ["c"])
    return Pipeline(stages=stages).fit(df).transform(df)


@pytest.mark.parametrize("seed", [42, -7, 1 << 40])
def test_random_numbers_are_sparks(spark, seed):
    one = spark._jvm.org.apache.spark.util.random.XORShiftRandom(seed)
    want = [one.nextDouble() for _ in range(700)]
    assert list(itertools.islice(P.doubles(seed), 700)) == want
    for start, n in ((0, 700), (3, 33), (129, 500)):
        assert P.below(seed, start, n, 0.9).tolist() == [v < 0.9 for v in want[start:start + n]]
    assert P.first_int(seed) == spark._jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt()


@pytest.mark.parametrize("parts", [1, 3])
def test_boosting_equals_spark_ml(spark, monkeypatch, parts):
    """Every prediction, with blocks smaller than a partition and a checkpoint on the way."""
    if parts > 1:
        monkeypatch.setattr(P, "BLOCK", 700)
    df = rows(spark, 4000, parts).cache()
    ours = M.gbt_regressor("y", max_iter=12)
    assert not isinstance(ours, GBTRegressor)          # the passes over boxed rows took too long at size
    theirs = GBTRegressor(labelCol="y", maxIter=12, maxDepth=5, stepSize=0.05, subsamplingRate=0.9, seed=42).fit(df)
    both = ours.fit(df).transform(theirs.transform(df).withColumnRenamed("prediction", "want"))
    worst = both.agg(F.max(F.abs(F.col("prediction") - F.col("want"))), F.countDistinct("prediction")).first()
    assert worst[0] < 1e-9 and worst[1] > 20
    df.unpersist()


def test_candidates_of_a_sample_are_sparks(spark):
    """More rows than the sample takes: thresholds found at the root of a one-tree fit."""
    df = rows(spark, 30000, 2).cache()
    model = GBTRegressor(labelCol="y", maxIter=1, maxDepth=5, subsamplingRate=0.9, seed=42).fit(df)
    want = model.transform(df).select("k", F.col("prediction").alias("want"))
    got = M.gbt_regressor("y", max_iter=1).fit(df).transform(df).join(want, "k")
    assert got.count() == 30000 and got.where("abs(prediction - want) > 1e-9").count() == 0
    df.unpersist()


def test_blocks_hold_all_rows_in_order(spark, monkeypatch):
    monkeypatch.setattr(P, "BLOCK", 100)
    df = rows(spark, 1050, 3)
    cuts, = P.candidates(df, "features", 42, 1050, {None: 1050.0})
    blocks = P.pack(df, "features", 4, cuts.bins, ["k", "d"], 1050).collect()
    for part, group in itertools.groupby(sorted(blocks), key=lambda b: b[0]):
        at = 0
        for b in group:
            k = P.widened(b[3])
            assert b[1] == at and len(k) <= 100 and (np.diff(k) > 0).all() and P.bins_of(b, 4).shape == (4, len(k))
            at += len(k)
    assert sorted(int(v) for b in blocks for v in P.widened(b[3])) == list(range(1050))


@pytest.mark.parametrize("values", [[1.0, -3.0], [0.5, 0.1], [300.0, 2.0], []])
def test_narrow_keeps_values(values):
    v = np.array(values)
    assert P.widened(P.narrow(v)).tolist() == values


def test_nulls_are_refused(spark):
    df = rows(spark, 200).withColumn("y", F.when(F.col("k") == 5, None).otherwise(F.col("y")))
    with pytest.raises(Exception, match="finite"):
        M.gbt_regressor("y", max_iter=1).fit(df)
    with pytest.raises(ValueError, match="no rows"):
        M.gbt_regressor("y", max_iter=1).fit(rows(spark, 20).where("k < 0"))


def test_search_equals_cross_validator(spark, monkeypatch):
    """F1 of every trial and the best tree, without a fit a trial and fold; small passes and blocks."""
    from cohortkit.operators import forest_cv as C
    df = rows(spark, 4000, 1).cache()
    monkeypatch.setitem(M.SEARCH_SPACE, "min_info_gain", (0.0, 0.002))
    monkeypatch.setattr(C, "CELLS", 5000)
    with monkeypatch.context() as m:
        m.setattr(M, "cross_validated_f1", lambda *a, **k: None)     # the fits one by one
        want, tree = M.random_search_cv(df, "label", "fold", n_trials=6, num_folds=3)
        want = [r["cv_f1"] for r in want.orderBy("trial").collect()]
    monkeypatch.setattr(M, "CrossValidator", None)
    got, best = M.random_search_cv(df, "label", "fold", n_trials=6, num_folds=3)
    got = [r["cv_f1"] for r in got.orderBy("trial").collect()]
    assert np.allclose(got, want, rtol=0, atol=1e-9) and len(set(want)) > 2
    assert best.toDebugString.split("\n")[1:] == tree.toDebugString.split("\n")[1:]     # but for the uid
    df.unpersist()


def test_search_takes_other_labels_and_weights(spark):
    """Three classes, and weights that vary by row, go to the cross validator."""
    df = rows(spark, 600).withColumn("y", F.pmod(F.col("y"), F.lit(3)))
    assert M.random_search_cv(df, "y", "fold", n_trials=1, num_folds=3)[0].count() == 1
    varied = df.withColumn("weight", 1 + F.col("a") * 0.001)
    assert M.random_search_cv(varied, "label", "fold", n_trials=1, num_folds=3)[0].count() == 1
    with pytest.raises(ValueError, match="fold"):
        M.random_search_cv(df, "label", "fold", n_trials=1, num_folds=2)


def test_features_are_drawn_as_spark_draws_them(spark):
    from cohortkit.operators import forest_cv as C
    seeds, jvm = C._Seeds(42), spark._jvm.java.util.Random(42)
    assert [seeds.long() for _ in range(5)] == [jvm.nextLong() for _ in range(5)]
    for seed in (1, -9):
        got = C.drawn_features(7, 3, seed)
        assert len(set(got)) == 3 and set(got) <= set(range(7)) and got == C.drawn_features(7, 3, seed)


def test_weights_are_added_row_by_row():
    from cohortkit.operators import forest_cv as C
    weigh, total = C._weighed(0.1, 10), 0.0
    for n in range(10):
        assert weigh(np.array([n]))[0] == total
        total += 0.1
