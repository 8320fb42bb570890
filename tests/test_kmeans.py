"""Fits that advance together against plain fits; accent removal on all code points."""
import re
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortkit.functions import scalar as S
from cohortkit.operators import kmeans as K
from sf_paths import SF_SMALL


def test_fits_together_equal_plain_fits(spark):
    df = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    df = df.select("embedding").union(spark.createDataFrame([(None,)], df.select("embedding").schema)).repartition(5)
    fits = [(1, 3), (3, 42), (3, 43), (6, 42)]
    got = K.fit_many(df, "embedding", fits)
    x = np.array([r[0] for r in df.where("embedding is not null").collect()], dtype=float)
    hashed = df.where("embedding is not null").select(F.col("embedding").cast("array<double>").alias("x"))
    start = np.array([r[0] for r in hashed.orderBy(F.xxhash64("x"), "x").collect()])
    for (k, seed), fit in zip(fits, got):
        c = K.first_centres(start, k, seed)
        for _ in range(300):
            d = ((x[:, None, :] - c[None]) ** 2).sum(axis=2)
            at = d.argmin(axis=1)
            new = np.array([x[at == j].mean(axis=0) if (at == j).any() else c[j] for j in range(k)])
            moved, c = np.abs(new - c).max(), new
            if moved < 1e-6:
                break
        assert np.allclose(fit.centres, c, atol=1e-3)
        assert abs(fit.cost - ((x[:, None, :] - c[None]) ** 2).sum(axis=2).min(axis=1).sum()) < 1e-6 * fit.cost
    out = got[3].transform(df, "embedding").groupBy("cluster").count().collect()
    assert {r["cluster"] for r in out} <= {None, *range(6)} and [r["count"] for r in out if r["cluster"] is None] == [1]


def test_equal_rows_and_no_rows(spark):
    same = spark.createDataFrame([([1.0, 2.0],)] * 20, "v array<double>")
    fit = K.fit_many(same, "v", [(3, 1)])[0]
    assert fit.cost == 0 and fit.transform(same, "v").select("cluster").distinct().count() == 1
    with pytest.raises(ValueError):
        K.fit_many(same.where("false"), "v", [(2, 1)])


def test_accents_of_every_code_point(spark):
    points = [c for c in range(1, 0x110000) if not 0xD800 <= c <= 0xDFFF and unicodedata.category(chr(c)) not in ("Cn", "Co")]
    df = spark.createDataFrame([(c, chr(c)) for c in points], "c int, t string")
    got = {r["c"]: r["s"] for r in df.select("c", S.strip_accents("t").alias("s")).collect()}
    want = {c: "".join(ch for ch in unicodedata.normalize("NFKD", chr(c)) if not unicodedata.combining(ch)) for c in points}
    assert got == want


def test_normalised_texts(spark):
    texts = ["  España ", "País Vasco—Euskadi", "ﬁn de mes", "nan", "\tNone\n", "Ångström (2²)", "", None, "İİ", "가-中"]
    got = [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
           .orderBy("i").select(S.normalise_text("t")).collect()]

    def plain(t):
        t = t.strip()
        if t.lower() in ("", "nan", "none"):
            return ""
        t = "".join(ch for ch in unicodedata.normalize("NFKD", t) if not unicodedata.combining(ch)).lower()
        t = re.sub("[^\\w\\s]", " ", re.sub("[‐-—−-]+", " ", t))
        return re.sub("\\s+", " ", t).strip()
    assert got == [None if t is None else plain(t) for t in texts]


def test_one_pass_sums_all_fits_and_costs_only_when_asked(spark, monkeypatch):
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(300, 4)), 1)
    rows = spark.createDataFrame([(v.tolist(),) for v in x], "x array<double>").repartition(3)
    centres = {0: x[:2].copy(), 7: np.array([x[0], x[5], x[5], x[9] + 50]), 3: x[10:11].copy()}
    monkeypatch.setattr(K, "BLOCK", 37)
    plain, costed = K._pass(rows, centres), K._pass(rows, centres, with_cost=True)
    for f, c in centres.items():
        d = ((x[:, None, :] - c[None]) ** 2).sum(axis=2)
        at = d.argmin(axis=1)                      # equal centres: the lowest
        for got in (plain[f], costed[f]):
            assert got[0].tolist() == np.bincount(at, minlength=len(c)).tolist()
            assert np.allclose(got[1], [x[at == j].sum(axis=0) for j in range(len(c))])
        assert plain[f][2] == 0 and abs(costed[f][2] - d.min(axis=1).sum()) < 1e-9
