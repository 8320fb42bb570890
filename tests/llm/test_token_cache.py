"""Token counts against the tokenizer library, and what the cache does."""

import pytest

from cohortkit.llm import token_cache as T
from cohortkit.session import scratch_path

TEXTS = ["", None, "Hello world, it's fine.", "a<|endoftext|>b <|endoftext|>", " \n\t\n  x", "  ", "é" * 50, "中文 \U0001F600‍ x", "'s 're don't", "1234567 89",
         "word " * 40_000, "x" * 70_000 + "\n" * 70_000 + "y !! ", "a\x85b\xa0c　d\x1ce \x1f", "\x1c" * 70_000 + " a", "Hello world, it's fine."]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(T.default_tokenizer()[0])
    return lambda t: len(tok.encode(t or "", add_special_tokens=False).ids)


def rows(got):
    return sorted(((r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in got.collect()), key=str)


def want(docs, library):
    return sorted(((d, len((t or "").encode()), library(t), library(t) > 1024) for d, t in docs), key=str)


def test_counts_are_the_librarys(spark, docs_of, library):
    docs = [*enumerate(TEXTS), (None, "no id"), (3, TEXTS[3]), (3, "other")]
    d = docs_of(docs).withColumnsRenamed({"score": "digest", "code": "n_tokens"})
    cache = scratch_path(spark, "cache")
    assert rows(T.token_counts(d, cache)) == want(docs, library)
    path, _ = T.default_tokenizer()
    assert rows(T.token_counts(d, scratch_path(spark, "cache"), path)) == want(docs, library)      # the library itself


def test_rank_file_gives_the_librarys_ids_on_every_code_point():
    from tokenizers import Tokenizer
    from cohortkit.llm.packing import _encoder, token_ids
    path, ranks = T.default_tokenizer()
    tok, enc = Tokenizer.from_file(path), _encoder(*ranks)
    points = [c for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    for i in range(0, len(points), 32):
        text = "".join(f"a{chr(c)}a {chr(c)}1{chr(c)}  {chr(c)}! {chr(c)}\n" for c in points[i:i + 32])
        if i % 1024 == 0 or points[i] < 0x30000:
            assert tok.encode(text, add_special_tokens=False).ids == token_ids(enc, text)


def test_only_distinct_misses_are_encoded_and_appended(spark, docs_of, library, monkeypatch):
    cache, path = scratch_path(spark, "cache"), T.default_tokenizer()[0]
    asked = []
    encode = T.encode_counts

    def counted(texts, *a):
        asked.append(sorted(r["text"] for r in texts.select("text").collect()))
        return encode(texts, *a)
    monkeypatch.setattr(T, "encode_counts", counted)
    one, two = [(1, "a b"), (2, "a b"), (3, None), (4, "c")], [(5, "c"), (6, "new"), (7, ""), (8, "new")]
    assert rows(T.token_counts(docs_of(one), cache)) == want(one, library)
    assert rows(T.token_counts(docs_of(two), cache)) == want(two, library)
    assert rows(T.token_counts(docs_of(one + two), cache)) == want(one + two, library)
    assert asked == [["", "a b", "c"], ["new"]]
    assert T.read_cache(spark, cache, path).count() == 4
    T.read_cache(spark, cache, path).write.mode("append").parquet(T._folder(cache, path))           # as if two jobs had added the same
    assert rows(T.token_counts(docs_of(two), cache)) == want(two, library)
    assert T.token_counts(docs_of(one).where("false"), scratch_path(spark, "cache")).count() == 0


def test_stored_counts_are_used(spark, docs_of):
    cache, path = scratch_path(spark, "cache"), T.default_tokenizer()[0]
    spark.sql("SELECT unhex(sha2('known', 256)) AS digest, 77L AS n_tokens").write.parquet(T._folder(cache, path))
    assert rows(T.token_counts(docs_of([(1, "known")]), cache)) == [(1, 5, 77, False)]


def test_other_tokenizers_and_a_normal_form(spark, docs_of):
    import public_tokenizers as P
    import sentencepiece
    from pyspark.sql import functions as F
    from tokenizers import Tokenizer
    docs = [(1, "Some Text here"), (2, "some text HERE")]
    sp = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    cache = scratch_path(spark, "cache")
    got = T.token_counts(docs_of(docs), cache, P.path("piece_bpe_32k.model"))
    assert {r["doc_id"]: r["n_tokens"] for r in got.collect()} == {d: len(sp.encode(t)) for d, t in docs}
    path = P.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    got = T.token_counts(docs_of(docs), cache, path, normalise=F.lower)
    assert {r["doc_id"]: r["n_tokens"] for r in got.collect()} == {d: len(tok.encode(t, add_special_tokens=False).ids) for d, t in docs}
    assert T.read_cache(spark, cache, path).count() == 1 and not T.splits_at_spaces(path)


def test_parts_join_to_the_text():
    for t in TEXTS:
        if t:
            for size in (1, 3, 1000):
                parts = list(T.text_parts(t[:5000], size))
                assert "".join(parts) == t[:5000] and all(p[0] in " \n" for p in parts[1:])
