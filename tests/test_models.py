"""Rows-only model queries: shapes and invariants (quick ones)."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from cohortkit.session import materialize
from sf_paths import SF_SMALL

Q = E.queries()
ROWS_ONLY = sorted(set(Q) - set(E.oracle_sql()))
SLOW = {"m2_random_search_cv", "m4_gbt_regressor", "m6_c_sweep_confusion", "m9_apply_full", "b5_ablation_results",
        "b6_importance_shift", "b7_ablation_highlights", "b8_shared_top_features"}


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_rows_only_query_runs(spark, name):
    if name in SLOW and not os.environ.get("RUN_SLOW"):
        pytest.skip("slow model query (set RUN_SLOW=1)")
    assert Q[name](spark, SF_SMALL).count() >= 0


def test_rules_partition_training_rows(spark):
    from cohortkit.plans import q_models as qm
    from cohortkit.operators import models as M, rules as R
    a, names, model = qm._tree(spark, SF_SMALL)
    nodes = M.tree_nodes(spark, model)
    rules = R.extract_rules(nodes, names, min_support=0)
    n_train = a.where(~F.col("is_test")).count()
    assert rules.agg(F.sum("support")).first()[0] == n_train
    shape = M.tree_shape(nodes, len(names)).first()
    assert shape["n_leaves"] == rules.count() and shape["depth"] == model.depth


def test_kmeans_assignment_is_nearest_centre(spark):
    from cohortkit.operators import cluster as Cl, groups as G
    e = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    a, model, cost = Cl.kmeans_fit(e, "embedding", 4, 42, 2)
    cent = spark.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())],
                                 "cluster int, centroid array<double>")
    b = G.assign_nearest(a.withColumnRenamed("cluster", "km"), "embedding", cent)
    assert b.where(F.col("km") != F.col("cluster")).count() == 0
    assert abs(G.inertia(b).first()["inertia"] - cost) / cost < 1e-6


def test_pca_components_orthonormal(spark):
    import numpy as np
    from cohortkit.operators import cluster as Cl
    e = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    fit, ratio, _ = Cl.pca_fit(e, "embedding", 2)
    pc = fit["components"]
    assert np.allclose(pc.T @ pc, np.eye(2), atol=1e-8)
    r = [x["explained_variance_ratio"] for x in ratio.orderBy("component").collect()]
    assert r[0] >= r[1] > 0


def test_random_search_is_whole(spark, monkeypatch):
    import json
    from cohortkit.plans import q_models as qm
    from cohortkit.operators import models as M
    search, seen = M.random_search_cv, {}

    def short(df, label, fold, n_trials, seed):
        seen.update(n=n_trials, folds=df.select(fold).distinct().count())
        trials, seen["best"] = search(df, label, fold, n_trials=4, seed=seed)
        return trials
    monkeypatch.setattr(M, "random_search_cv", lambda *a, **k: (short(*a, **k), None))
    got = [json.loads(r["params"]) for r in qm.m2_random_search_cv(spark, SF_SMALL).collect()]
    assert seen["n"] == 100 and seen["folds"] == 5 and len(got) == 4
    assert {p["max_features"] for p in got} <= {"sqrt", "log2", "all"} and len({p["max_features"] for p in got}) > 1
    assert seen["best"].depth >= 0 and seen["best"].numNodes >= 1


def test_ablation_has_area_and_leaves(spark):
    from cohortkit.operators import ablation as Ab
    res = materialize(Q["b4_single_ablation"](spark, SF_SMALL))
    got = {(r["experiment"], r["metric"]): r["value"] for r in res.collect()}
    for e in ("baseline", "without_price"):
        assert 0 <= got[e, "roc_auc"] <= 1 and got[e, "tree_leaves"] == (got[e, "tree_nodes"] + 1) / 2
    by = {r["experiment"]: r["roc_auc_delta"] for r in Ab.comparison(res).collect()}
    assert by["baseline"] == 0 and abs(by["without_price"] - got["without_price", "roc_auc"] + got["baseline", "roc_auc"]) < 1e-9


def test_forest_is_fitted_on_one_hot_columns(spark):
    names = {r["feature"] for r in Q["m3_random_forest_importance"](spark, SF_SMALL).collect()}
    assert "o_totalprice" in names and "c_mktsegment" not in names and len([n for n in names if n.startswith("c_mktsegment")]) > 1


def test_apply_full_has_the_logistic_prediction(spark, monkeypatch):
    from cohortkit.plans import q_models as qm
    from cohortkit.operators import models as M
    gbt, memo = M.gbt_regressor, dict(qm._MEMO)
    monkeypatch.setattr(M, "gbt_regressor", lambda *a, **k: gbt(*a, max_iter=2, **k))
    monkeypatch.setattr(qm, "_MEMO", {k: v for k, v in memo.items() if k[0] != "_gbt"})
    got = qm.m9_apply_full(spark, SF_SMALL)
    assert got.count() == qm._frame(spark, SF_SMALL).count() and got.where("lr_pred is null or lr_pred not between 1 and 5").count() == 0
    m5 = qm.m5_l1_logistic(spark, SF_SMALL).withColumnRenamed("lr_pred", "one")
    assert got.join(m5, "o_orderkey").where("lr_pred <> one").count() == 0


def test_counted_pairs_equal_joined_pairs(spark):
    """Metrics, areas and pairs of several predictions, counted together."""
    from cohortkit.operators import evaluate as Ev, linkage as L, stats as St
    rows = [(i % 23 if i % 11 else None, None if i % 13 == 0 else 2 if i % 17 == 0 else i % 2, i // 3 % 2, i // 5 % 2, i * 7 % 3 // 2, (i % 6) / 6) for i in range(300)]
    df = spark.createDataFrame(rows, "k int, y int, b int, v int, w int, score double").repartition(3)
    got = {r["variant"]: r for r in St.mcnemar_of_counts(L.compare_counts(df, "k", "y", "b", {"one": "v", "two": "w"}, [0, 1])).collect()}
    for name, col in (("one", "v"), ("two", "w")):
        want = St.mcnemar(L.compare_predictions(df.select("k", "y", "b"), df.select("k", "y", col), "k", "y", "b", col)).first()
        assert [got[name][c] for c in ("n11", "n12", "n21", "n22", "statistic", "p_value")] == [want[c] for c in ("n11", "n12", "n21", "n22", "statistic", "p_value")]
    binary = df.where("y < 2")
    m = {r["w"]: r for r in Ev.binary_metrics(binary, "y", "b", group_cols=["w"]).collect()}
    a = {r["w"]: r for r in Ev.roc_auc(binary, "y", "score", group_cols=["w"]).collect()}
    for w in (0, 1):
        one = binary.where(F.col("w") == w)
        assert m[w]["f1"] == Ev.binary_metrics(one, "y", "b").first()["f1"]
        assert abs(a[w]["roc_auc"] - Ev.roc_auc(one, "y", "score").first()["roc_auc"]) < 1e-12


def test_forest_rows_a_partition_are_bounded(spark, monkeypatch):
    from cohortkit.operators import models as M
    from cohortkit.plans import q_models as qm
    df = spark.range(0, 1000, 1, 2)
    got = M.spread(df, 100)
    assert got.rdd.getNumPartitions() == 10 and got.distinct().count() == 1000
    assert max(got.rdd.glom().map(len).collect()) <= 110
    assert M.spread(df, 600) is df and M.spread(df.where("false"), 100).count() == 0
    seen, spread = [], M.spread
    monkeypatch.setattr(M, "spread", lambda d: seen.append(d) or spread(d))
    assert qm.m3_random_forest_importance(spark, SF_SMALL).count() > 1 and len(seen) == 1


def test_sweep_keeps_only_what_the_fits_read(spark, monkeypatch):
    from cohortkit.operators import models as M
    from cohortkit.plans import q_models as qm
    seen, one = [], M.l1_logistic
    monkeypatch.setattr(M, "l1_logistic", lambda label, C, n, **k: seen.append(C) or one(label, C, n, **k).setMaxIter(1))
    kept, cache = [], type(qm._frame(spark, SF_SMALL)).cache
    monkeypatch.setattr(type(qm._frame(spark, SF_SMALL)), "cache", lambda d: kept.append((d.columns, cache(d))) or kept[-1][1])
    got = qm.m6_c_sweep_confusion(spark, SF_SMALL)
    assert seen == [0.1, 0.2, 0.5, 1.0] and [c for c, _ in kept] == [["grade_class", "features"]]
    assert not kept[0][1].is_cached and got.count() == 100
