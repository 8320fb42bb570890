"""Run a stateless operator over new files with Structured Streaming."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path


def run_incremental(spark: SparkSession, source: str, schema, transform: Callable[[DataFrame], DataFrame],
                    sink: str, fmt: str = "parquet", checkpoint: str | None = None) -> str:
    """Read ``source`` files as a stream, apply ``transform`` (any row-level
    operator of this package, e.g. grade parsing or label mapping with a
    static broadcast table) and append the result to ``sink``.  Progress is
    kept in a checkpoint folder under ``spark.checkpoint.dir`` so a restarted
    job continues where it stopped; ``availableNow`` processes what is there
    and stops."""
    ckpt = checkpoint or scratch_path(spark, "stream-ckpt")
    stream = spark.readStream.format(fmt).schema(schema).load(source)
    q = (transform(stream).writeStream.format("parquet").option("path", sink)
         .option("checkpointLocation", ckpt).outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return sink
