"""Sketch profiles within their error bounds, in one pass and merged."""
import numpy as np
from pyspark.sql import functions as F

from cohortkit.operators import sketches as Sk


def test_profile_and_merge_within_bounds(spark):
    n = 40_000
    df = spark.range(n).select((F.col("id") % 3).alias("g"), F.when(F.col("id") % 11 != 0, F.pow(F.rand(3) * 10, F.lit(3))).alias("x"),
                               (F.col("id") % 9000).cast("string").alias("t"), F.lit(None).cast("int").alias("void")).checkpoint()
    cols = ["x", "t", "void"]
    for groups in ([], ["g"]):
        whole = Sk.sketch_table(df, cols, groups)
        halves = Sk.merge(Sk.sketch_table(df.where("t < '4'"), cols, groups), Sk.sketch_table(df.where("t >= '4'"), cols, groups))
        for table in (whole, halves):
            rows = Sk.profile(table).collect()
            assert len(rows) == 3 * (3 if groups else 1)
            for r in rows:
                part = df.where(F.col("g") == r["g"]) if groups else df
                v = [x[0] for x in part.select(r["variable"]).collect()]
                there = [x for x in v if x is not None]
                assert (r["n_rows"], r["n_null"]) == (len(v), len(v) - len(there))
                true = len(set(there)) + (len(there) < len(v))
                assert abs(r["n_unique"] - true) <= 5 * 1.04 / 2 ** 7 * true
                if r["variable"] != "x":
                    assert r["mn"] is None and r["p50"] is None
                    continue
                s = np.sort(there)
                assert (r["mn"], r["mx"]) == (s[0], s[-1])
                for name, p in Sk.QUANTILES.items():
                    assert abs(np.searchsorted(s, r[name]) / len(s) - p) <= 2 * 2.4 / 800


def test_no_rows(spark):
    none = spark.createDataFrame([], "a int, b string")
    assert Sk.profile(Sk.sketch_table(none, ["a", "b"])).count() == 0
    odd = spark.createDataFrame([(float("nan"), None), (float("nan"), None)], "a double, b string")
    got = {r["variable"]: r for r in Sk.profile(Sk.sketch_table(odd, ["a", "b"])).collect()}
    assert got["a"]["n_unique"] == 1 and got["a"]["p50"] is None and got["b"]["n_unique"] == 1
