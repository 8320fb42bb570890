"""The registered queries: each operator on its whole table with production
parameters, returning the digest columns of its contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import conversations, divergence, edit_fingerprint, langid, line_dedup, packing, quality_fm, sharding, simhash, sp_sampling, token_cache, topk_search, warc
from .common import held_out, table

EMBEDDING_BITS = 64
TOP_K = 10


def op1_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest sign codes of every vector whose id is divisible by
    20, against all vectors (itself included); ties to the smaller id."""
    codes = topk_search.sign_codes(table(spark, sf_dir, "embeddings"), EMBEDDING_BITS)
    found = topk_search.hamming_top_k(codes, codes.where("id % 20 = 0"), EMBEDDING_BITS, TOP_K)
    return found.select("query_id", F.col("rank").cast("long").alias("rank"), F.col("id").alias("vec_id"), F.col("distance").cast("long").alias("distance"))


SQL_OP1 = f"""
WITH v AS (SELECT vec_id, [x >= 0 FOR x IN embedding] AS b FROM embeddings WHERE len(embedding) = {EMBEDDING_BITS} AND vec_id IS NOT NULL),
d AS (SELECT q.vec_id AS query_id, a.vec_id, CAST(list_sum([CASE WHEN q.b[i] = a.b[i] THEN 0 ELSE 1 END FOR i IN range(1, {EMBEDDING_BITS + 1})]) AS BIGINT) AS distance
      FROM v q, v a WHERE q.vec_id % 20 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank, vec_id, distance
FROM d QUALIFY rank <= {TOP_K}"""


def op2_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_fm.fit(docs, table(spark, sf_dir, "labels"))
    return quality_fm.score(docs, model, "score").select(
        "doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op3_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), limit=1024)


def op4_sampled_segmentations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two distinct sampled segmentations of every whole text."""
    got = sp_sampling.sampled_segmentations(table(spark, sf_dir, "documents"), k=2)
    return got.select("doc_id", "sample", "pieces", F.crc32("ids").alias("ids_crc32"), "log_prob", "perturbed", "log_inclusion",
                      F.crc32(F.col("decoded").cast("binary")).alias("decoded_crc32"))


def op5_minimax_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = sharding.shard_documents(table(spark, sf_dir, "documents"), shards=16)
    return got.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: how many lines go (Jaccard similarity of 0.8 or more to
    an earlier line) and the remaining text's digest."""
    got = line_dedup.dedup_lines(table(spark, sf_dir, "documents"), (4, 5), out="__out")
    return got.select("doc_id", F.size("__out.removed").cast("long").alias("removed"),
                      F.sha2(F.col("__out.text"), 256).alias("kept_sha256"))


SQL_OP6 = """
WITH raw AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
lines AS (SELECT doc_id, i - 1 AS line_no, ls[i] AS line,
                 list_sort(list_distinct([w FOR w IN regexp_split_to_array(lower(ls[i]), '[ \\t\\n\\x0B\\f\\r]+') IF w <> ''])) AS ws
          FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM raw)),
solid AS (SELECT * FROM lines WHERE len(ws) > 0),
classes AS (SELECT ws, min((doc_id, line_no)) AS first, len(ws) AS n FROM solid GROUP BY ws),
c AS (SELECT *, row_number() OVER (ORDER BY first) AS c FROM classes),
w AS (SELECT c, n, unnest(ws) AS word FROM c),
o AS (SELECT a.c, a.n AS an, b.n AS bn, count(*) AS shared FROM w a JOIN w b ON a.word = b.word AND b.c < a.c
      AND b.n * 5 >= a.n * 4 AND a.n * 5 >= b.n * 4 GROUP BY a.c, b.c, a.n, b.n),
hit AS (SELECT DISTINCT c FROM o WHERE shared * 5 >= (an + bn - shared) * 4),
gone AS (SELECT s.doc_id, s.line_no, (hit.c IS NOT NULL OR (s.doc_id, s.line_no) <> c.first) AS gone
         FROM solid s JOIN c ON s.ws = c.ws LEFT JOIN hit ON hit.c = c.c),
per AS (SELECT doc_id, count(*) FILTER (gone) AS removed, list(line_no) FILTER (gone) AS nos FROM gone GROUP BY doc_id)
SELECT raw.doc_id, coalesce(per.removed, 0) AS removed,
       sha256(array_to_string([ls[i] FOR i IN range(1, len(ls) + 1) IF per.nos IS NULL OR NOT list_contains(per.nos, i - 1)], chr(10))) AS kept_sha256
FROM raw LEFT JOIN per USING (doc_id)"""


def op7_edit_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_fingerprint.edit_fingerprints(table(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.pages_roundtrip(table(spark, sf_dir, "pages"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_classes(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    got = langid.predict(docs, langid.fit(docs), "lang_pred", "lang_score")
    return got.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (language, source) group against the other sources of its
    language and against the language, over all texts."""
    return divergence.source_divergence(table(spark, sf_dir, "documents"), min_docs=3, top_terms=200)


SQL_OP11 = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
t AS (SELECT r, lang, source, translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
      FROM (SELECT r, lang, source, unnest(regexp_extract_all(text, '[A-Za-z\x{80}-\x{10FFFF}]+')) AS w FROM d)),
kept AS (SELECT lang, term, count(*) AS lang_n FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
langs AS (SELECT lang, count(*) AS v, CAST(sum(lang_n) AS BIGINT) AS total FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY lang, source, term),
g AS (SELECT DISTINCT lang, source FROM d),
tot AS (SELECT lang, source, CAST(sum(n) AS BIGINT) AS total FROM c GROUP BY lang, source),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000 * (coalesce(c.n, 0) + 1)) // (coalesce(tot.total, 0) + l.v) AS p,
             1 + (1000000000 * (k.lang_n + 1)) // (l.total + l.v) AS q
      FROM g JOIN langs l USING (lang) JOIN kept k USING (lang) LEFT JOIN tot USING (lang, source) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (SELECT a.lang, a.source, b.source AS item, CAST(sum((a.p - b.p) * (a.p - b.p) // b.p) AS BIGINT) AS value
          FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
whole AS (SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN pairs x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
terms AS (SELECT lang, source, term AS item, (p - q) * (p - q) // q AS value FROM p WHERE n > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, value, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, encode(item)) AS INTEGER) AS rank FROM whole
UNION ALL
SELECT lang, source, 'term', item, value, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, encode(item)) AS INTEGER) AS rank FROM terms QUALIFY rank <= 200"""


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every whole text, through a cache that begins empty."""
    got = token_cache.token_counts(table(spark, sf_dir, "documents"), scratch_path(spark, "token-cache"), limit=1024)
    return got.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged as the contract says, and the audit and
    digest of its cheapest repair."""
    whole = table(spark, sf_dir, "conversations")
    return conversations.repair_report(conversations.damaged(whole), whole.select("conv_id"))


QUERIES = {f.__name__: f for f in (
    op1_exact_topk, op2_quality_fm, op3_vector_packing, op4_sampled_segmentations, op5_minimax_sharding, op6_line_dedup,
    op7_edit_fingerprints, op8_warc, op9_simhash, op10_langid, op11_source_divergence, op12_token_counts, op13_conversation_repair)}
SQL = {"op1_exact_topk": SQL_OP1, "op6_line_dedup": SQL_OP6, "op11_source_divergence": SQL_OP11}
