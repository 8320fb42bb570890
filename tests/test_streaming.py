import os

from pyspark.sql import functions as F

from sf_paths import SF_SMALL
from cohortkit.functions import scalar as S
from cohortkit.session import scratch_path
from cohortkit.streaming import run_incremental


def test_incremental_grades_equal_batch(spark):
    src = scratch_path(spark, "stream-in")  # a folder of new files arriving
    spark.read.parquet(f"{SF_SMALL}/orders.parquet").repartition(3).write.parquet(src)
    schema = spark.read.parquet(src).schema
    sink = scratch_path(spark, "stream-out")

    def grades(df):
        return df.select("o_orderkey", S.grade_parse("o_orderpriority").alias("grade"))
    run_incremental(spark, src, schema, grades, sink)
    got = spark.read.parquet(sink)
    want = grades(spark.read.parquet(src))
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0
