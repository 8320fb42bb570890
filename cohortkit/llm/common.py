"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import gc
import math
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder; plain string joining keeps any URI scheme."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: cuts
    the lineage and survives the loss of any executor."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of an Arrow batch: texts are long, and a batch is held by the JVM and by Python at once.
BATCH_ROWS = 512


def small_batches(spark: SparkSession) -> None:
    """Let Python workers get texts in batches of BATCH_ROWS rows, unless the
    session asks for still smaller ones."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only (doc_id long, text string), whatever else the table carries."""
    small_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def discard(df: DataFrame) -> None:
    """Delete a table made by ``stored`` that nothing will read again."""
    files = df.inputFiles()
    if files:
        spark = df.sparkSession
        folder = spark._jvm.org.apache.hadoop.fs.Path(files[0].rsplit("/", 1)[0])
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner remove the shuffle files of steps that are done:
    it does so when the driver has collected their plans as garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def unused(df: DataFrame, name: str) -> str:
    """A column name made of ``name`` that ``df`` does not have."""
    have = {c.lower() for c in df.columns}
    name = f"__{name}"
    while name in have:
        name += "_"
    return name


NO_ID = -(1 << 63)          # stands for the one null document id, which comes first


def row_keys(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with a long column that tells its rows apart, and its name: the
    id where every row has its own, otherwise the place in the order of id (null
    first) and text, in a stored table."""
    row = unused(docs, "row")
    own = F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID))
    if docs.select(own.alias("doc")).groupBy("doc").count().where("count > 1").isEmpty():
        return docs.withColumn(row, own), row
    # rows alike in id and text are dealt by their place in the input, so that they fill no single task
    order = {unused(docs, "doc"): F.col(id_col).cast("long"), unused(docs, "text"): F.xxhash64(F.col(text_col).cast("string")),
             unused(docs, "place"): F.monotonically_increasing_id()}
    dealt = docs.withColumns(order).repartitionByRange(*order).sortWithinPartitions(*order).drop(*order)
    return stored(dealt.withColumn(row, F.monotonically_increasing_id()), "rows"), row


def held_out(id_col: str | Column, mod: int, rest: int) -> Column:
    """crc32 of the id as text, modulo ``mod``, equals ``rest``; a null id is
    never held out."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % mod == rest, F.lit(False))


def blocks_for(rows: int, per_block: int) -> int:
    return max(1, math.ceil(rows / per_block))


def sub_batches(texts: Sequence, max_bytes: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """(from, to) ranges of consecutive texts (bytes or str) of at most
    ``max_bytes`` in all; a longer text is a range of its own."""
    lo, size = 0, 0
    for i, t in enumerate(texts):
        if i > lo and size + len(t) > max_bytes:
            yield lo, i
            lo, size = i, 0
        size += len(t) + 1
    if lo < len(texts):
        yield lo, len(texts)
