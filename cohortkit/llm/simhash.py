"""SimHash near-duplicates by deletion-variant signatures.

Fingerprints of 64 bits within ``max_bits`` of each other are found without
comparing pairs:  cut into fewer segments than the usual pigeonhole needs, so
that one of them differs by at most one bit (two segments for two bits).  Every
segment is indexed once per bit with that bit left out; fingerprints with an
equal variant are joined and verified.

Buckets with more than ``bucket_cap`` fingerprints are not expanded into pairs.
Their members go through an exact route for two bits: a fingerprint emits
itself and its 64 one-bit neighbours, and two fingerprints are within two bits
exactly if they share one of these, so each shared value is a link to the
smallest fingerprint that has it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks_for, id_and_text, release, row_keys, stored
from .graph import components


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Unsigned 64-bit SimHash of a text, after lower-casing A-Z, over word
    shingles with repeats (fewer words: the whole sequence; none: zero)."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    n = len(words)
    if not n:
        return 0
    h64 = xxhash.xxh64_intdigest
    if n <= shingle:
        hashes = [h64(b" ".join(words), 42)]
    else:
        line = b" ".join(words)
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = (ends - [len(w) + 1 for w in words])[:n - shingle + 1].tolist()
        hashes = [h64(line[a:b], 42) for a, b in zip(starts, (ends[shingle - 1:] - 1).tolist())]
    total = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 8192):  # a long text needs no large matrix
        part = np.array(hashes[i:i + 8192], ">u8")
        total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(total * 2 > len(hashes)).tobytes(), "big")


def with_fingerprint(docs: DataFrame, out: str, text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``docs`` with a signed long column ``out``, the text's fingerprint."""
    @F.pandas_udf("long")
    def fp(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in texts:
            v = np.array([fingerprint(t, shingle) for t in s], np.uint64)
            yield pd.Series(v.view(np.int64))
    return docs.withColumn(out, fp(F.col(text_col)))


def _bits(a: str, b: str):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def _variants(codes: DataFrame, segments: int) -> DataFrame:
    """One row for each segment and each of its bits left out:
    (key, code).  The key packs segment, bit and the other bits exactly for
    segments of at most 48 bits."""
    width = 64 // segments
    if width * segments != 64 or width > 48:
        raise ValueError("segments must divide 64 into parts of at most 48 bits")
    keys = []
    for s in range(segments):
        part = F.shiftrightunsigned("code", s * width).bitwiseAND(F.lit((1 << width) - 1).cast("long"))
        for b in range(width):
            rest = part.bitwiseAND(F.lit(((1 << width) - 1) ^ (1 << b)).cast("long"))
            keys.append(rest + F.lit((s * width + b) << 48).cast("long"))
    return codes.select(F.explode(F.array(*keys)).alias("key"), "code")


def links(codes: DataFrame, max_bits: int = 2, bucket_cap: int = 32) -> DataFrame:
    """Edges (u, v) between distinct fingerprints in column ``code`` that
    connect all that are within ``max_bits`` of each other (directly or
    through others that are)."""
    if max_bits not in (1, 2):
        raise ValueError("max_bits must be 1 or 2")
    codes = codes.select("code")
    # a fingerprint becomes 64 rows: small tables in enough tasks
    codes = codes.repartition(blocks_for(codes.count(), 8192))
    idx = _variants(codes, 2)
    size = idx.groupBy("key").agg(F.count("*").alias("n"))
    shared = stored(size.where("n > 1"), "simhash-buckets")
    # members of shared buckets; merged at every size, as the buckets grow with the corpus
    hits = stored(idx.join(shared.hint("merge"), "key"), "simhash-hits")
    release(codes.sparkSession)
    few = hits.where(F.col("n") <= bucket_cap).select("key", "code")
    pairs = (few.select("key", F.col("code").alias("u")).join(few.select("key", F.col("code").alias("v")), "key")
             .where((F.col("u") < F.col("v")) & (_bits("u", "v") <= max_bits)).select("u", "v"))
    big = hits.where(F.col("n") > bucket_cap).select("code").distinct()
    if max_bits == 2:
        near = [F.col("code")] + [F.col("code").bitwiseXOR(F.lit(1 << b if b < 63 else -(1 << 63)).cast("long")) for b in range(64)]
    else:  # one bit: a value with one bit left out is shared exactly by neighbours
        near = [F.xxhash64(F.lit(b), F.col("code").bitwiseAND(F.lit(~(1 << b) if b < 63 else (1 << 63) - 1).cast("long"))) for b in range(64)]
    around = big.select(F.explode(F.array(*near)).alias("key"), "code")
    lead = around.groupBy("key").agg(F.min("code").alias("u"), F.max("code").alias("top"))
    star = around.join(lead.where("u < top").select("key", "u"), "key").select("u", F.col("code").alias("v")).where("u <> v")
    if max_bits == 1:
        star = star.where(_bits("u", "v") <= 1)
    return pairs.union(star).distinct()


def classes(fingerprints: DataFrame, max_bits: int = 2, bucket_cap: int = 32) -> DataFrame:
    """(code, component_id) for each distinct fingerprint of
    ``fingerprints`` (doc_id, code): the smallest doc_id reachable."""
    codes = stored(fingerprints.groupBy("code").agg(F.min("doc_id").alias("first")), "simhash-codes")
    comp = components(links(codes, max_bits, bucket_cap))
    rooted = codes.join(comp, codes["code"] == comp["node"], "left").select(
        codes["code"], "first", F.coalesce("root", codes["code"]).alias("root"))
    rooted = stored(rooted, "simhash-rooted")
    low = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return rooted.join(low, "root").select("code", "component_id")


def simhash_classes(docs: DataFrame, shingle: int = 3, max_bits: int = 2, bucket_cap: int = 32,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 lower-case hex digits) and component_id (the
    smallest doc_id reachable over links of ``max_bits`` or fewer differing
    bits, itself included) for every row.

    Null and empty texts have fingerprint zero and link like any other.  Rows
    without id get the component of their fingerprint; a component of only
    such rows has a null component_id.  Repeated rows are returned as often
    as they occur.  An empty table gives an empty result."""
    narrow = stored(with_fingerprint(id_and_text(docs, id_col, text_col), "code", "text", shingle).select("doc_id", "code"), "simhash")
    c = classes(narrow, max_bits, bucket_cap)
    return narrow.join(c, "code").select(
        "doc_id", F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2, bucket_cap: int = 32,
                         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, with one row of each component: the
    one with the smallest id, a null id coming first.  Rows that share an id or
    have none are told apart by a stored key in the order of id and text, so every
    component keeps a row and none keeps two.  An empty table gives an empty result."""
    keyed, row = row_keys(docs, id_col, text_col)
    narrow = stored(with_fingerprint(id_and_text(keyed, row, text_col), "code", "text", shingle).select("doc_id", "code"), "simhash")
    keep = classes(narrow, max_bits, bucket_cap).select(F.col("component_id").alias(row)).distinct()
    return keyed.join(keep, row, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
