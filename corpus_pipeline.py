"""The corpus pipeline: quality classifier, language ID, line de-duplication,
SimHash near-duplicates, best-fit packing.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
one's docs.  All but the last return the columns of ``documents``.  An empty
table goes through every stage as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit.llm import langid, line_dedup, packing, quality_fm, simhash
from cohortkit.llm.common import stored, table

MIN_QUALITY = 0.3
MIN_LANGUAGE = 0.5


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents with a quality score of 0.3 or more."""
    model = quality_fm.fit(docs, table(spark, sf_dir, "labels"))
    return quality_fm.score(docs, model, "__score").where(F.col("__score") >= MIN_QUALITY).select(*docs.columns)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose language is told with a posterior of 0.5 or more;
    without a model (no labelled language) all with a letter stay."""
    model = langid.fit(docs)
    if model is None:
        return docs.where(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    told = langid.predict(docs, model, "__lang", "__score")
    return told.where((F.col("__lang") != langid.UNKNOWN) & (F.col("__score") >= MIN_LANGUAGE)).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove lines that repeat an earlier line; documents of which no word
    is left through that go."""
    got = line_dedup.dedup_lines(docs, out="__out")
    text = F.col("__out.text")
    left = text.rlike(r"[^ \t\n\x0B\f\r]")
    cols = [text.alias(c) if c == "text" else F.coalesce(F.char_length(text), F.lit(0)).cast("long").alias(c) if c == "n_chars" else F.col(c) for c in docs.columns]
    return got.where((F.size("__out.removed") == 0) | left).select(*cols)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group within two SimHash bits stays."""
    return simhash.drop_near_duplicates(docs, shingle=3, max_bits=2)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of what is left, packed into sequences of 1024."""
    return packing.pack_documents(docs, limit=1024)


STAGES = [("quality classifier", quality), ("language id", language), ("line dedup", lines),
          ("simhash near-dedup", near_duplicates), ("best-fit packing", pack)]

#: No SQL: models, hashes and a tokenizer decide; tests hold it against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "stage")
    return docs
