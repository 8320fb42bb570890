"""The level-wise tree against a plain learner on the same cut points."""
import bisect
import math
import random
import struct

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from cohortkit.operators import tree as T

FEATURES = ["a", "b", "c", "d"]


def _rows(n=700, seed=3):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        a, b, c, d = rng.random(), rng.randint(0, 5), rng.gauss(0, 2), 1.0
        y = int((a > 0.6 and b < 3) or rng.random() < 0.15)
        out.append((i, None if i % 50 == 0 else a, float(b), float("nan") if i % 70 == 0 else c, d, y, i % 5))
    return out


@pytest.fixture(scope="module")
def data(spark):
    df = spark.createDataFrame(_rows(), "id int, a double, b double, c double, d double, y int, fold int").repartition(7)
    return df, T.bin_rows(df, FEATURES, "y", fold_col="fold", bins=16)


def _hash(*values):
    h = 42
    for v in values:
        h = xxhash.xxh64_intdigest(struct.pack("<q", v), seed=h)
    return h - (1 << 64) if h >= 1 << 63 else h


def _bin(x, cuts):
    return 0 if x is None or math.isnan(x) else bisect.bisect_left(cuts, x)


def _impurity(w, criterion):
    tot = sum(w)
    if tot <= 0:
        return 0.0
    share = [x / tot for x in w]
    return 1 - sum(s * s for s in share) if criterion == "gini" else -sum(s * math.log2(s) for s in share if s > 0)


def plain_tree(rows, cuts, spec):
    """(node -> (feature, bin) or None, n) by recursion over lists of rows."""
    data = [([_bin(v, c) for v, c in zip(r[1:5], cuts)], r[5]) for r in rows if spec.fold is None or r[6] != spec.fold]
    n_class = [sum(y == c for _, y in data) for c in (0, 1)]
    wt = [len(data) / (2 * x) for x in n_class] if spec.class_weight == "balanced" else [1.0, 1.0]
    total = sum(a * b for a, b in zip(n_class, wt))
    out = {}

    def weigh(part):
        return [wt[c] * sum(y == c for _, y in part) for c in (0, 1)]

    def visit(node, part, depth):
        w = weigh(part)
        imp, best = _impurity(w, spec.criterion), None
        vary = [f for f in range(4) if len({b[f] for b, _ in part}) > 1]
        vary.sort(key=lambda f: (_hash(spec.seed, node, f), f))
        if depth < spec.max_depth and len(part) >= spec.min_split and imp > 0:
            for f in vary[:spec.n_features(4)]:
                seen = sorted({b[f] for b, _ in part})
                cand = seen[:-1]
                if spec.splitter == "random":
                    pick = seen[0] + _hash(spec.seed, node, f, 1) % (seen[-1] - seen[0])
                    cand = [max(s for s in seen if s <= pick)]
                for t in cand:
                    lo, hi = [p for p in part if p[0][f] <= t], [p for p in part if p[0][f] > t]
                    if min(len(lo), len(hi)) < spec.min_leaf:
                        continue
                    wl, wr = weigh(lo), weigh(hi)
                    dec = round((sum(w) * imp - sum(wl) * _impurity(wl, spec.criterion) - sum(wr) * _impurity(wr, spec.criterion)) / total, 12)
                    if dec >= spec.min_decrease and (best is None or (dec, -f, -t) > best[0]):
                        best = ((dec, -f, -t), f, t, lo, hi)
        out[node] = (None if best is None else (best[1], best[2]), len(part))
        if best is not None:
            visit(2 * node + 1, best[3], depth + 1)
            visit(2 * node + 2, best[4], depth + 1)
    visit(0, data, 0)
    return out


SPECS = [T.TreeSpec(max_depth=4, min_split=20, min_leaf=5),
         T.TreeSpec(max_depth=6, min_split=60, min_leaf=3, criterion="entropy", fold=2),
         T.TreeSpec(max_depth=5, min_leaf=8, splitter="random", max_features="sqrt", class_weight="balanced", fold=0, seed=7),
         T.TreeSpec(max_depth=7, min_decrease=0.002, max_features="log2", seed=9, splitter="random"),
         T.TreeSpec(max_depth=3, min_split=10_000)]


def test_all_trees_equal_the_plain_learner(data):
    _, binned = data
    forest = T.grow(binned, SPECS)
    for t, spec in enumerate(SPECS):
        got = {r[1]: (None if r[3] is None else (r[3], r[5]), r[9]) for r in forest.rows if r[0] == t}
        assert got == plain_tree(_rows(), binned.cuts, spec), spec
    assert sum(r[0] == 4 for r in forest.rows) == 1 and sum(r[0] == 0 for r in forest.rows) > 5


def test_cut_points_are_order_statistics(data):
    _, binned = data
    a = sorted(r[1] for r in _rows() if r[1] is not None)
    assert binned.cuts[0] == sorted({a[int(math.floor((len(a) - 1) * i / 16))] for i in range(1, 16)})
    assert binned.cuts[1] == [0.0, 1.0, 2.0, 3.0, 4.0] and binned.cuts[3] == []


def test_predict_and_held_out_counts(data):
    df, binned = data
    forest = T.grow(binned, SPECS[1:3])
    counts = forest.held_out_counts()
    for t in (0, 1):
        p = T.predict(df, forest.nodes().where(F.col("tree") == t), 7)
        train = {r["leaf"]: r["count"] for r in p.where(F.col("fold") != SPECS[1 + t].fold).groupBy("leaf").count().collect()}
        assert train == {r[1]: r[9] for r in forest.rows if r[0] == t and r[3] is None}
        held = [(r["y"], r["prediction"]) for r in p.where(F.col("fold") == SPECS[1 + t].fold).collect()]
        assert counts[t] == (held.count((1, 1)), held.count((0, 1)), held.count((1, 0)))


def test_empty_and_one_class(spark, data):
    df, _ = data
    empty = T.bin_rows(df.where("false"), FEATURES, "y", fold_col="fold")
    assert T.grow(empty, [T.TreeSpec()]).rows == []
    one = T.grow(T.bin_rows(df.where("y = 1"), FEATURES, "y"), [T.TreeSpec()])
    assert len(one.rows) == 1 and one.rows[0][-1] == 1
    with pytest.raises(ValueError):
        T.grow(empty, [T.TreeSpec(max_depth=16)])


def test_racing_search_proposes_and_drops(data):
    from cohortkit.operators import search as Se
    _, binned = data
    trials, best = Se.racing_search(binned, 15, generations=(9, 6), margin=0.01, pool=30)
    rows = sorted(trials.collect(), key=lambda r: r["trial"])
    assert [r["generation"] for r in rows] == [0] * 9 + [1] * 6 and {r["folds_used"] for r in rows} <= {1, 2, 5}
    top = [r for r in rows if r["best"]]
    assert len(top) == 1 and top[0]["cv_f1"] == max(r["cv_f1"] for r in rows if r["folds_used"] == 5)
    import json
    for r in (rows[0], top[0]):  # the folds' mean of trees grown alone
        spec = json.loads(r["params"])
        f1 = []
        for f in range(r["folds_used"]):
            tp, fp, fn = T.grow(binned, [T.TreeSpec(**spec, fold=f, seed=42)]).held_out_counts()[0]
            f1.append(2 * tp / (2 * tp + fp + fn) if tp else 0.0)
        assert abs(sum(f1) / len(f1) - r["cv_f1"]) < 1e-12
    assert best.specs[0].fold is None and len(best.rows) >= 1


def test_trees_that_agree_share_their_nodes(data, monkeypatch):
    _, binned = data
    specs = [T.TreeSpec(max_depth=3, min_split=20 + i % 3, min_leaf=5, fold=i % 2) for i in range(40)]
    seen, plain = [], T._histograms
    monkeypatch.setattr(T, "_histograms", lambda b, branches, shared, folds: seen.append(len(shared)) or plain(b, branches, shared, folds))
    forest = T.grow(binned, specs)
    assert seen[0] == 2 and all(n <= 2 * 2 ** d * 3 for d, n in enumerate(seen))
    for t in (0, 7, 39):
        got = {r[1]: (None if r[3] is None else (r[3], r[5]), r[9]) for r in forest.rows if r[0] == t}
        assert got == plain_tree(_rows(), binned.cuts, specs[t])
    monkeypatch.setattr(T, "HELD_CELLS", 10)
    monkeypatch.setattr(T, "PRICED_CELLS", 10)
    monkeypatch.setattr(T, "CHUNK", 50)
    assert sorted(T.grow(binned, specs[:3]).rows, key=str) == sorted((r for r in forest.rows if r[0] < 3), key=str)
    assert T.grow(binned, specs[:3]).held_out_counts() == {t: forest.held_out_counts()[t] for t in range(3)}
