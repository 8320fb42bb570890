"""Invariants for the operators checked rows-only, and the scale helpers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sf_paths import SF_SMALL
from cohortkit.functions import quantiles as Q
from cohortkit.functions import special as SP
from cohortkit.functions import windows as Wn
from cohortkit.operators import features as Fe
from cohortkit.operators import impute as Im
from cohortkit.operators import groups as G
from cohortkit.operators import phik as Ph
from cohortkit.operators import survival as Sv
from cohortkit.session import table


def test_special_functions():
    # chi2 with 1 dof: sf(x) = erfc(sqrt(x/2)); t with df -> inf approaches normal
    for x in (0.5, 3.84, 10.0):
        assert abs(SP.chi2_sf(x, 1) - math.erfc(math.sqrt(x / 2))) < 1e-10
    assert abs(SP.chi2_sf(5.991, 2) - 0.05) < 1e-4
    assert abs(SP.t_two_sided_p(2.228, 10) - 0.05) < 1e-3
    assert abs(SP.t_two_sided_p(1.96, 1e7) - 0.05) < 1e-3


def test_exact_quantiles_with_hot_group(spark):
    rng = np.random.default_rng(1)
    vals = np.concatenate([rng.normal(size=3000), np.full(1500, 0.25), rng.exponential(size=500)])
    groups = np.where(np.arange(len(vals)) < 3500, "hot", "cold")
    pdf = list(zip(groups.tolist(), vals.tolist()))
    df = spark.createDataFrame(pdf, "g string, v double")
    q = Q.exact_quantiles(df, "v", [0.1, 0.5, 0.9], ["g"], "linear").collect()
    for r in q:
        x = vals[groups == r["g"]]
        assert abs(r["quantile"] - np.quantile(x, r["prob"])) < 1e-12
    n = Q.exact_quantiles(df, "v", [0.25], [], "nearest").first()["quantile"]
    s = np.sort(vals)
    assert n == s[int(math.floor((len(s) - 1) * 0.25 + 0.5))]


def test_skew_safe_windows_match_plain(spark, request):
    e = table(spark, SF_SMALL, "events").select("user_id", "ts", "event_id", "value")
    hot = F.col("event_id") % 2 == 0   # one key holds half the rows, all at the same time
    e = e.withColumns({"user_id": F.when(hot, F.lit(0)).otherwise(F.col("user_id")), "ts": F.when(hot, F.lit("2024-01-01").cast(e.schema["ts"].dataType)).otherwise(F.col("ts"))})
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")   # partitions of this size would be merged
    request.addfinalizer(lambda: spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true"))
    spread = Wn._ranged(e, ["user_id"], ["ts", "event_id"], False).where("user_id = 0").groupBy("__blk").count().collect()
    assert len(spread) > 2
    r = Wn.row_number(e, ["user_id"], ["ts", "event_id"], out="rn")
    s = Wn.running_sum(r, ["user_id"], ["ts", "event_id"], {"cum": F.col("value")})
    l = Wn.lag(s, ["user_id"], ["ts", "event_id"], "value", "prev")
    from pyspark.sql import Window
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    ref = e.select("event_id", F.row_number().over(w).alias("rn0"),
                   F.sum("value").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cum0"),
                   F.lag("value").over(w).alias("prev0"))
    j = l.join(ref, "event_id")
    bad = j.where((F.col("rn") != F.col("rn0")) | (F.abs(F.col("cum") - F.col("cum0")) > 1e-6)
                  | ~F.col("prev").eqNullSafe(F.col("prev0"))).count()
    assert bad == 0 and j.count() == e.count()


def test_label_encoder_is_dense_rank(spark):
    df = spark.createDataFrame([(x,) for x in ["b", "a", None, "c", "a"]], "v string")
    codes = {r["value"]: r["code"] for r in Fe.fit_label_encoder(df, ["v"]).collect()}
    assert codes == {"MISSING_CATEGORY": 0, "a": 1, "b": 2, "c": 3}


def test_ordered_keys_are_in_the_order_of_the_doubles(spark):
    rng = np.random.default_rng(9)
    bits = rng.integers(0, 1 << 63, 3000).astype(np.uint64) * 2 + rng.integers(0, 2, 3000).astype(np.uint64)
    v = np.concatenate([bits.view(np.float64), [0.0, -0.0, np.inf, -np.inf, 5e-324, -5e-324, 2.0 ** -1022, np.nextafter(2.0 ** -1022, 0), 1.7976931348623157e308],
                        *[np.array([np.nextafter(x, 0), x, np.nextafter(x, np.inf), -x]) for x in 2.0 ** np.arange(-1021, 1024)]])
    v = v[~np.isnan(v)]
    df = spark.createDataFrame([(float(x),) for x in v], "v double").select("v", Q.ordered_key(F.col("v")).alias("k"))
    for r in df.collect():
        b = int(np.float64(abs(r["v"])).view(np.int64))
        assert r["k"] == (-b if r["v"] < 0 else b), r["v"]


def test_quantiles_that_need_every_digit(spark):
    x = [1.0 + i * 2.0 ** -52 for i in range(40)] + [-3.5] * 7 + [float("inf"), 5e-324, 0.0, -0.0, float("nan"), None]
    df = spark.createDataFrame([(v, "g" if i % 2 else None) for i, v in enumerate(x)], "v double, g string")
    for g in (None, "g"):
        own = np.sort([v for i, v in enumerate(x) if v is not None and v == v and (i % 2 == 1) == (g == "g")])
        for m in ("nearest", "lower", "higher"):
            got = {r["prob"]: r["quantile"] for r in Q.exact_quantiles(df, "v", [0.0, 0.3, 0.5, 0.77, 1.0], ["g"], m).where(F.col("g").eqNullSafe(F.lit(g))).collect()}
            for p, q in got.items():
                pos = (len(own) - 1) * p
                assert q == own[int({"nearest": math.floor(pos + 0.5), "lower": math.floor(pos), "higher": math.ceil(pos)}[m])]
    assert Q.exact_quantiles(df.where("false"), "v", [0.5], ["g"]).count() == 0


def test_iterative_impute_keeps_observed(spark):
    li = table(spark, SF_SMALL, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_tax")
    d = li.withColumn("q", F.when(F.col("l_orderkey") % 7 == 0, None).otherwise(F.col("l_quantity")))
    out = Im.iterative_impute(d, ["q", "l_extendedprice", "l_tax"], max_iter=5)
    assert out.where(F.col("q").isNull()).count() == 0
    # observed cells untouched (the original travels along as l_quantity)
    assert out.where((F.col("l_orderkey") % 7 != 0) & (F.col("q") != F.col("l_quantity"))).count() == 0


def test_iterative_impute_is_chained(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 3)) @ np.array([[1, .5, .2], [0, 1, .7], [0, 0, 1]])
    gap = np.zeros(x.shape, bool)
    gap[:, 0], gap[:, 1] = rng.uniform(size=200) < .3, rng.uniform(size=200) < .2
    rows = [(i, *[None if g else float(v) for v, g in zip(a, m)]) for i, (a, m) in enumerate(zip(x, gap))]
    got = Im.iterative_impute(spark.createDataFrame(rows, "i int, a double, b double, c double"), ["a", "b", "c"], max_iter=2, ridge=0.0)
    want = np.where(gap, 0, x)
    want = np.where(gap, want.sum(axis=0) / (~gap).sum(axis=0), x)
    for _ in range(2):
        for t in sorted((0, 1), key=lambda t: gap[:, t].sum()):     # each column sees those before it
            z = np.column_stack([np.ones(200), np.delete(want, t, axis=1)])
            m = gap[:, t]
            want[m, t] = z[m] @ np.linalg.lstsq(z[~m], want[~m, t], rcond=None)[0]
    assert np.allclose([[r["a"], r["b"], r["c"]] for r in got.orderBy("i").collect()], want, atol=1e-6)


def test_kaplan_meier_monotone(spark):
    d = spark.createDataFrame([(1.0, 1), (2.0, 0), (2.0, 1), (3.0, 1), (5.0, 0), (5.0, 1)], "t double, e int")
    km = Sv.kaplan_meier(d, "t", "e").orderBy("t").collect()
    s = [r["survival"] for r in km]
    # hand values: at risk 6, 5, 3, 2 with one event each
    exp = [5 / 6, 5 / 6 * 4 / 5, 5 / 6 * 4 / 5 * 2 / 3, 5 / 6 * 4 / 5 * 2 / 3 / 2]
    assert np.allclose(s, exp)


def test_cox_gradient_zero_at_optimum(spark):
    rng = np.random.default_rng(3)
    n = 300
    x = rng.normal(size=n)
    t = rng.exponential(scale=np.exp(-0.7 * x))
    e = (rng.uniform(size=n) < 0.8).astype(int)
    df = spark.createDataFrame([(float(a), float(b), int(c)) for a, b, c in zip(x, t, e)], "x double, t double, e int")
    res = Sv.cox_ph(df, "t", "e", ["x"], penalizer=0.0).first()
    assert 0.3 < res["coef"] < 1.2  # hazard exp(+0.7 x) in the simulation
    # gradient of the partial likelihood vanishes at the fitted coefficient
    std = float(np.std(x, ddof=1))
    z = df.select(F.col("t").alias("__t"), F.col("e").alias("__e"), ((F.col("x") - float(np.mean(x))) / std).alias("__z0"))
    _, g, _ = Sv._efron_step(z, ["__z0"], np.array([res["coef"] * std]))
    assert abs(g[0]) < 1e-4


def test_tied_sums_equal_term_by_term():
    rng = np.random.default_rng(5)
    x = np.concatenate([1 + rng.uniform(size=40) * 30, 10 ** rng.uniform(0, 9, size=40)])
    d = rng.integers(1, 400, size=80)
    for i, got in enumerate(Sv._grown(x, d)):
        f = (np.log, lambda v: 1 / v, lambda v: 1 / v**2)[i]
        want = [f(a + np.arange(n)).sum() for a, n in zip(x, d)]
        assert np.allclose(got, want, rtol=1e-11, atol=0)


def test_efron_step_equals_plain_loops(spark):
    rng = np.random.default_rng(6)
    n, beta = 240, np.array([0.4, -0.2])
    z = rng.normal(size=(n, 2))
    t = rng.integers(1, 9, size=n).astype(float)           # many ties; time 3 has a third of the rows
    t[rng.uniform(size=n) < .3] = 3.0
    e = (rng.uniform(size=n) < .6).astype(int)
    ll, g, info = 0.0, np.zeros(2), np.zeros((2, 2))
    w = np.exp(z @ beta)
    for u in np.unique(t[e == 1]):
        at, tied = t >= u, (t == u) & (e == 1)
        d = tied.sum()
        ll += (z[tied] @ beta).sum()
        g += z[tied].sum(axis=0)
        for i in range(d):
            v = np.where(at, w, 0) - i / d * np.where(tied, w, 0)
            m = (v[:, None] * z).sum(axis=0) / v.sum()
            ll -= np.log(v.sum())
            g -= m
            info += (v[:, None, None] * z[:, :, None] * z[:, None, :]).sum(axis=0) / v.sum() - np.outer(m, m)
    rows = [(float(a), int(b), float(c[0]), float(c[1])) for a, b, c in zip(t, e, z)]
    df = spark.createDataFrame(rows, "__t double, __e int, z0 double, z1 double")
    got = Sv._efron_step(Sv._time_blocks(df, 3), ["z0", "z1"], beta)
    for a, b in zip(got, (ll, g, info)):
        assert np.allclose(a, b, rtol=1e-10)


def test_imputer_fits_once_and_applies_to_other_frames(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 4)) @ rng.normal(size=(4, 4)) + 5
    gap = rng.uniform(size=x.shape) < [0.3, 0.2, 0.1, 0.0]
    rows = [(i, *[None if g else float(v) for v, g in zip(a, m)], None, "k" if i % 3 else ("m" if i % 2 else None), None) for i, (a, m) in enumerate(zip(x, gap))]
    df = spark.createDataFrame(rows, "i int, a double, b double, c double, d double, never double, word string, empty string")
    train = df.where("i < 200")
    small = Im.IterativeImputerFit(train, df.columns[1:], max_iter=6, tol=0.0)
    spread = Im.IterativeImputerFit(train, df.columns[1:], max_iter=6, tol=0.0, local_bytes=1)
    assert small.dropped == spread.dropped == ["never", "empty"] and small.fills == {"word": "k"}
    order = [t - 1 for t in small.targets]
    tr, m = x[:200], gap[:200]
    mean = np.where(m, 0, tr).sum(axis=0) / (~m).sum(axis=0)
    want, steps = np.where(m, mean, tr), []
    for _ in range(6):
        for t in order:
            q = np.column_stack([np.ones(200), np.delete(want, t, axis=1)])
            ridge = np.diag([1e-12, *[1e-6 + 1e-12] * 3])
            b = np.linalg.solve(q[~m[:, t]].T @ q[~m[:, t]] + ridge, q[~m[:, t]].T @ want[~m[:, t], t])
            want[m[:, t], t] = q[m[:, t]] @ b
            steps.append(b)
    for fit in (small, spread):
        assert all(np.allclose(b, s, rtol=1e-7, atol=1e-9) for (_, b), s in zip(fit.history, steps))
    every = np.where(gap, mean, x)
    for t, b in zip(order * 6, steps):
        every[gap[:, t], t] = np.column_stack([np.ones(300), np.delete(every, t, axis=1)])[gap[:, t]] @ b
    got = small.transform(df).orderBy("i").collect()
    assert got[0].asDict().keys() == {"i", "a", "b", "c", "d", "word"} and {r["word"] for r in got} == {"k", "m"}
    assert np.allclose([[r[c] for c in "abcd"] for r in got], every, atol=1e-8)
    assert small.transform(df.where("false")).count() == 0


def test_silhouette_matches_bruteforce(spark):
    rng = np.random.default_rng(5)
    pts = rng.normal(size=(60, 3)) + np.repeat(np.eye(3) * 3, 20, axis=0)
    lab = np.repeat([0, 1, 2], 20)
    df = spark.createDataFrame([(i, [float(v) for v in p], int(l)) for i, (p, l) in enumerate(zip(pts, lab))],
                               "id long, v array<double>, c int")
    _, m = G.silhouette_sq(df, "v", "c")
    d2 = ((pts[:, None, :] - pts[None, :, :]) ** 2).sum(-1)
    s = []
    for i in range(60):
        own = lab == lab[i]
        a = d2[i, own & (np.arange(60) != i)].mean()
        b = min(d2[i, lab == k].mean() for k in set(lab) if k != lab[i])
        s.append((b - a) / max(a, b))
    assert abs(m.first()["silhouette"] - np.mean(s)) < 1e-9


def test_phik_extremes():
    rng = np.random.default_rng(0)
    ind = np.histogram2d(rng.integers(0, 5, 2000), rng.integers(0, 5, 2000), bins=5)[0]
    assert Ph.phik_from_table(ind)[0] < 0.1
    same = np.diag([400.0, 400, 400, 400, 400])
    assert Ph.phik_from_table(same)[0] > 0.95


def test_stratified_split_sizes(spark):
    d = table(spark, SF_SMALL, "documents").join(table(spark, SF_SMALL, "labels"), "doc_id")
    s = Fe.stratified_split(d, "doc_id", "quality", 0.2, 42)
    got = {r["quality"]: (r["n"], r["t"]) for r in s.groupBy("quality").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("is_test").alias("t")).collect()}
    for q, (n, t) in got.items():
        assert t == math.ceil(0.2 * n)


def test_phik_sparse(spark, monkeypatch):
    """Columns of more than a thousand levels; chunks do not change the model; the matrix equals dense tables."""
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 1500, 4000), rng.integers(0, 5, 4000)
    df = spark.createDataFrame([(f"a{x}", f"b{y}", f"c{(x + z) % 6}") for x, y, z in zip(a.tolist(), b.tolist(), rng.integers(0, 2, 4000).tolist())], "a string, b string, c string")
    got = {(r["col_a"], r["col_b"]): r for r in Ph.phik_matrix(df, [], ["a", "b", "c"]).collect()}
    pdf = df.toPandas()
    for x, y in (("a", "b"), ("a", "c"), ("b", "c")):
        phik, chi2, dof = Ph.phik_from_table(pdf.groupby([x, y]).size().unstack(fill_value=0).to_numpy(dtype=float))
        r = got[x, y]
        assert abs(r["phik"] - phik) < 1e-6 and abs(r["chi2"] - chi2) < 1e-6 * chi2 and r["dof"] == dof
    px = np.full(40, 1 / 40)
    whole = Ph._bvn_chi2(0.6, px, px, 1000.0)
    monkeypatch.setattr(Ph, "_POINTS", 3000)
    assert abs(Ph._bvn_chi2(0.6, px, px, 1000.0) - whole) < 1e-9 * whole


def test_special_functions_against_closed_forms():
    for x in (0.1, 1.0, 5.0, 40.0):
        assert abs(SP.chi2_sf(x, 1) - math.erfc(math.sqrt(x / 2))) < 1e-12
        assert abs(SP.chi2_sf(x, 6) - math.exp(-x / 2) * (1 + x / 2 + x * x / 8)) < 1e-12
        assert abs(SP.t_two_sided_p(x, 1) - (1 - 2 / math.pi * math.atan(x))) < 1e-12
        assert abs(SP.t_two_sided_p(x, 2) - (1 - x / math.sqrt(2 + x * x))) < 1e-12
    assert SP.chi2_sf(0, 3) == 1 and math.isnan(SP.chi2_sf(None, 1)) and math.isnan(SP.t_two_sided_p(1.0, 0))
