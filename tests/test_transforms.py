"""Density by cell moments and MMD by random features against direct sums."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortkit.operators import latent as Lt
from cohortkit.operators import profile as Pr
from sf_paths import SF_SMALL


@pytest.mark.parametrize("kind", ["normal", "far", "few"])
def test_density_equals_the_direct_sum(spark, kind):
    rng = np.random.default_rng(5)
    v = {"normal": rng.normal(50, 9, 3000), "far": np.r_[rng.normal(0, 1, 2000), 500.0, 501.0], "few": np.repeat([1.0, 2.0, 5.0], [9, 1, 4])}[kind]
    df = spark.createDataFrame([(float(x),) for x in v] + [(None,), (float("nan"),)], "v double").repartition(6)
    grid, span = Pr.kde_grid(df, "v", 200)
    rows = sorted(grid.collect())
    h, x = v.std(ddof=1) * len(v) ** -0.2, np.linspace(v.min(), v.max(), 200)
    want = np.exp(-0.5 * ((x[:, None] - v) / h) ** 2).sum(axis=1) / (len(v) * h * np.sqrt(2 * np.pi))
    assert len(rows) == 200 and np.allclose([r["x"] for r in rows], x)
    assert np.abs(np.array([r["density"] for r in rows]) - want).max() < 1e-9
    assert span.count() == 1


def test_density_without_spread(spark):
    for v in ([], [3.0], [3.0, 3.0]):
        grid, _ = Pr.kde_grid(spark.createDataFrame([(x,) for x in v], "v double"), "v")
        assert grid.count() == 0


@pytest.mark.parametrize("bandwidth", [0.01, 1.0])
def test_rbf_mmd_within_its_error(spark, bandwidth):
    e = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").repartition(5)
    a, b = e.where("vec_id % 2 = 0"), e.where("vec_id % 2 = 1").withColumn("embedding", F.transform("embedding", lambda v: v * 1.5))
    got = Lt.mmd_rbf_sets(a, "embedding", b, "embedding", bandwidth).first()
    x, y = (np.array([r["embedding"] for r in d.collect()], dtype=float) for d in (a, b))

    def k(p, q):
        return np.exp(-((p[:, None] - q[None]) ** 2).mean(axis=2) / (2 * bandwidth)).mean()
    want = k(x, x) + k(y, y) - 2 * k(x, y)
    assert abs(got["mmd2"] - want) <= min(got["bound"], 5 * got["std_error"])
    same = Lt.mmd_rbf_sets(a, "embedding", a, "embedding", bandwidth).first()
    assert abs(same["mmd2"]) < 1e-12
    assert Lt.mmd_rbf_sets(a, "embedding", b.where("false"), "embedding").first()["mmd2"] is None
