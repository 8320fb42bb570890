"""Token counts through a cache of digests.

A text's count depends on its normalised content and on the tokenizer alone, so
counts are stored under (tokenizer digest, content digest).  A call digests
every text where it lies, looks the distinct digests up in the cache, encodes one text
of each digest that the cache lacks, appends those counts, and joins the
counts back.  Texts move only for digests that are missing, one copy from each
task; a cache that knows all texts moves none.

The cache is a Parquet folder in shared storage with one subfolder a tokenizer.
An append is one Spark write job: its files appear when it commits, so a lost
executor repeats tasks and a lost job leaves nothing behind.  Two jobs that append
the same digest store equal counts, and reading takes one of them.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_and_text, small_batches, stored
from .line_dedup import _may_match
from .packing import _encoder, token_ids

CACHE_SCHEMA = "digest binary, n_tokens long"
PART_CHARS = 1 << 16        # a longer text is encoded in parts of about so many characters
_GAP = re.compile(r"\S(?=[ \n])")


def default_tokenizer() -> tuple[str, tuple[str, str]]:
    """The byte-level file of 50k ids, and the same vocabulary as (rank file,
    split pattern), which gives the same ids several times faster (tests
    compare the two on every code point)."""
    import public_tokenizers as P
    return P.path("byte_bpe_50k.json"), (P.path("byte_bpe_50k.tiktoken"), P.PATTERN)


@functools.lru_cache(maxsize=4)
def _library(path: str) -> Callable[[str], int]:
    """Counts a text's tokens with the library of the file's kind."""
    if path.endswith(".model"):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda text: len(sp.encode(text))
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return lambda text: len(tok.encode(text, add_special_tokens=False))


def _counter(path: str, ranks: tuple[str, str] | None) -> Callable[[str], int]:
    """As ``_library``, with the rank file where one is given.  What its
    matcher refuses (white space of a million characters, say) goes to the library."""
    if ranks is None:
        return _library(path)
    enc = _encoder(*ranks)

    def count(text: str) -> int:
        try:
            return len(token_ids(enc, text))
        except ValueError:
            return _library(path)(text)
    return count


def splits_at_spaces(path: str) -> bool:
    """Whether no token of the file's tokenizer reaches from a non-space
    character into white space, so that a text may be cut there: so for a
    byte-level pre-tokenizer with the usual pattern and added tokens
    without white space, and no normaliser."""
    if path.endswith(".model"):
        return False
    import json
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre = spec.get("pre_tokenizer") or {}
    added = spec.get("added_tokens") or []
    return (spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
            and not any(re.search(r"\s", t["content"]) or t["lstrip"] or t["rstrip"] for t in added))


def text_parts(text: str, size: int = PART_CHARS) -> Iterator[str]:
    """``text`` cut before white space that follows another character, in
    parts of ``size`` characters or, where no such place is near, more."""
    at = 0
    while len(text) - at > size:
        m = _GAP.search(text, at + size - 1)
        if m is None:
            break
        yield text[at:m.end()]
        at = m.end()
    yield text[at:]


def tokenizer_digest(path: str) -> str:
    """SHA-256 of the file and of the version of the library that defines its counts."""
    if path.endswith(".model"):
        import sentencepiece as library
    else:
        import tokenizers as library
    h = hashlib.sha256(f"{library.__name__} {library.__version__}\n".encode())
    with open(path, "rb") as f:
        for block in iter(lambda: f.read(1 << 20), b""):
            h.update(block)
    return h.hexdigest()


def _folder(cache: str, path: str) -> str:
    return f"{cache.rstrip('/')}/tokenizer={tokenizer_digest(path)}"


def read_cache(spark: SparkSession, cache: str, path: str) -> DataFrame:
    """(digest, n_tokens) that ``cache`` holds for the tokenizer file, one
    row a digest; empty where nothing has been stored."""
    at = spark._jvm.org.apache.hadoop.fs.Path(_folder(cache, path))
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], CACHE_SCHEMA)
    return spark.read.schema(CACHE_SCHEMA).parquet(_folder(cache, path)).groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))


def encode_counts(texts: DataFrame, path: str, ranks: tuple[str, str] | None = None) -> DataFrame:
    """(digest, n_tokens) of ``texts`` (digest binary, text string), encoded
    in Python a text at a time; long texts in parts where that is exact."""
    cut = splits_at_spaces(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(path, ranks)
        for b in batches:
            n = [sum(map(count, text_parts(t))) if cut else count(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64())], ["digest", "n_tokens"])
    small_batches(texts.sparkSession)
    return texts.mapInArrow(run, CACHE_SCHEMA)


def token_counts(docs: DataFrame, cache: str, path: str | None = None, ranks: tuple[str, str] | None = None, limit: int = 1024, normalise: Callable[[Column], Column] | None = None,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes (of the text in UTF-8), n_tokens, over_limit (more
    than ``limit`` tokens) of every row, and the rows' content ``digest``.

    ``path`` names a tokenizer file (by default the byte-level one of 50k ids) and
    ``ranks`` the same vocabulary as a rank file, where there is one.  ``cache`` names a
    folder that all machines share; what it lacks is added to it.  ``normalise`` may bring texts to a normal form that has the same tokens (by
    default the text itself).  A null text counts as empty: no byte, no token.
    Special tokens spelled out in a text are one token each, as the library reads them, and
    none are added.  Rows without an id and repeated rows give rows like any
    other; an empty table gives an empty result and leaves the cache alone."""
    if path is None:
        path, ranks = default_tokenizer()
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    key = F.unhex(F.sha2((normalise(text) if normalise else text).cast("binary"), 256))
    whole = id_and_text(docs, id_col, text_col).select("doc_id", text.alias("text"), key.alias("digest"))
    narrow = stored(whole.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "digest"), "token-digests")
    misses = stored(narrow.select("digest").distinct().join(read_cache(spark, cache, path), "digest", "left_anti"), "token-misses")
    if not misses.isEmpty():
        used: list = []
        # a filter of fixed size keeps texts that the cache knows in their tasks; the join then is exact
        near = whole.where(_may_match(misses, F.xxhash64("digest"), used)(F.xxhash64("digest")))
        one = near.groupBy("digest").agg(F.first("text").alias("text")).join(misses, "digest", "left_semi")
        encode_counts(one, path, ranks).write.mode("append").parquet(_folder(cache, path))
        for b in used:
            b.destroy()
    known = read_cache(spark, cache, path)
    return narrow.join(known, "digest").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "digest")
