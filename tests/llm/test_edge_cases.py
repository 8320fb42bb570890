"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing
column names, for every operator and pipeline stage."""

import pytest

import corpus_pipeline
from cohortkit.llm import edit_fingerprint, langid, line_dedup, packing, quality_fm, sharding, simhash, sp_sampling, topk_search, warc

LONG = " ".join(f"w{i % 977}" for i in range(60_000))
ROWS = [(1, "the cat sat on the mat today"), (2, None), (3, ""), (4, "the cat sat on the mat today"), (4, "the cat sat on the mat today"),
        (None, "no id here at all"), (6, " \n\t "), (7, LONG), (8, "aè中\U0001F600 z"), (9, "12345 !!"), (10, "\n\nthe cat sat on the mat today\n")]

OPERATORS = {
    "segmentations": lambda d: sp_sampling.sampled_segmentations(d),
    "shards": lambda d: sharding.shard_documents(d, 4),
    "pieces": lambda d: packing.pack_documents(d, 64),
    "lines": lambda d: line_dedup.dedup_lines(d),
    "edit": lambda d: edit_fingerprint.edit_fingerprints(d, parts=3),
    "simhash": lambda d: simhash.simhash_classes(d),
    "near": lambda d: simhash.drop_near_duplicates(d),
    "language": lambda d: langid.predict(d, langid.fit(d), "told", "told_score"),
    "quality": lambda d: quality_fm.score(d, None, "q"),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_rows_of_every_kind(docs_of, name):
    d = docs_of(ROWS)
    got = OPERATORS[name](d).collect()
    count = {"segmentations": None, "pieces": None, "near": None}.get(name, len(ROWS))
    if count is not None:
        assert len(got) == count
    if name == "pieces":
        assert sum(r["length"] for r in got if r["doc_id"] in (2, 3)) == 2        # the end id alone
        assert max(r["offset"] + r["length"] for r in got) <= 64
    if name == "near":
        ids = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in got)
        # null, empty and blank texts are one group; equal rows and copies another
        assert [i for n, i in ids if not n] == [1, 2, 7, 8, 9] and sum(n for n, _ in ids) == 1
    if name == "language":
        assert {r["told"] for r in got if not (r["text"] or "").strip() or r["doc_id"] == 9} == {"und"}
    if name == "shards":
        by = {}
        for r in got:
            by.setdefault(r["shard"], []).append(r["slot"])
        assert all(sorted(v) == list(range(len(v))) for v in by.values())


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(docs_of, name):
    assert OPERATORS[name](docs_of(ROWS).where("false")).count() == 0


def test_search_edges(spark):
    v = [(0, [1.0] * 8), (20, None), (40, [1.0] * 7), (None, [1.0] * 8), (60, [-1.0] * 8), (60, [-1.0] * 8), (3, [1.0] * 7 + [None])]
    codes = topk_search.sign_codes(spark.createDataFrame(v, "vec_id long, embedding array<double>"), 8)
    got = {(r["query_id"], r["rank"]): (r["id"], r["distance"]) for r in topk_search.hamming_top_k(codes, codes.where("id % 20 = 0"), 8, 3).collect()}
    assert got[0, 1] == (0, 0) and got[0, 2] == (3, 1) and got[60, 1] == got[60, 2] == (60, 0)
    assert {q for q, _ in got} == {0, 60}
    assert topk_search.hamming_top_k(codes.where("false"), codes.where("false"), 8, 3).count() == 0


def test_warc_edges(spark):
    pages = [(1, "http://a/b c\nd", "<p>x</p>\nWARC/1.0\r\nContent-Length: 5\r\n"), (2, None, None), (3, "u", ""), (None, "u", "<p>x</p>"), (5, "u", "y\n\n"), (6, "u", "y\n\n"), (6, "u", "y\n\n")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(2)
    got = sorted(((r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in warc.pages_roundtrip(df).collect()), key=str)
    assert (2, 0, "revisit", 3) in got and (3, 0, "response", None) in got and (5, 3, "revisit", 6) in got
    assert got.count((6, 3, "response", None)) == 2 and len(got) == 7
    assert warc.pages_roundtrip(df.where("false")).count() == 0


def test_pipeline_stages_on_odd_and_empty_tables(spark, docs_of, tmp_path):
    d = docs_of(ROWS)
    spark.createDataFrame([(1, 1, 0), (9, 0, 0), (4, 1, 0), (4, 0, 0), (None, 1, 0), (7, None, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for rows in (d, d.where("false")):
        for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, rows, str(tmp_path))
            if i < len(corpus_pipeline.STAGES) - 1:
                assert out.columns == rows.columns, name
            out.collect()


def test_registered_columns(spark):
    from cohortkit.llm import queries
    assert len(queries.QUERIES) == 13 and set(queries.SQL) <= set(queries.QUERIES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "language id", "line dedup", "simhash near-dedup", "best-fit packing"]


A, B = "alpha beta gamma delta epsilon zeta", "one two three four five six seven"


@pytest.mark.parametrize("rows,texts", [
    ([(3, A), (7, A), (7, B)], [A, B]), ([(7, A), (7, B)], [A, B]), ([(None, A), (None, B), (None, A)], [A, B]), ([(5, A), (5, A), (5, A)], [A]),
    ([(None, A), (2, A), (2, B), (1, B)], [A, B]), ([(1, None), (2, ""), (2, " ")], None)])
def test_one_row_of_each_component_stays(spark, rows, texts):
    d = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'kept' AS __row", "1 AS code", "doc_id AS component_id").repartition(3)
    got = simhash.drop_near_duplicates(d).collect()
    assert sorted(r["text"] for r in got) == sorted(texts) if texts else len(got) == 1
    assert {r["__row"] for r in got} == {"kept"} and got[0].asDict().keys() == {"doc_id", "text", "__row", "code", "component_id"}


def test_line_dedup_leaves_columns_of_its_own_names_alone(spark):
    d = spark.createDataFrame([(1, A), (2, A + "\n" + B), (2, B)], "doc_id long, text string").selectExpr("*", "'keep' AS __row", "true AS __hit", "7 AS __removed")
    got = line_dedup.dedup_lines(d, out="__out").collect()
    assert {(r["__row"], r["__hit"], r["__removed"]) for r in got} == {("keep", True, 7)}
    assert sorted((r["__out"]["text"], len(r["__out"]["removed"])) for r in got) == [("", 1), (A, 0), (B, 1)]


def test_equal_pieces_are_dealt_to_many_groups(spark):
    from cohortkit.llm.common import stored
    p = stored(spark.range(3000).selectExpr("cast(null as long) AS doc_id", "0 AS piece", "1L AS length", "'x' AS __group", "2 AS __spread"), "pieces")
    got = packing.pack(p, limit=8, group_rows=300).collect()
    assert len(got) == 3000 and {(r["__group"], r["__spread"]) for r in got} == {("x", 2)}
    groups = {}
    for r in got:
        groups[r["sequence_id"] >> 32] = groups.get(r["sequence_id"] >> 32, 0) + 1
    assert len(groups) == 10 and max(groups.values()) < 450


def test_white_space_without_end_is_packed(docs_of):
    got = packing.token_pieces(docs_of([(1, " " * 1_500_000 + "x")]), 1 << 21).first()
    from tokenizers import Tokenizer
    want = Tokenizer.from_file(packing.default_tokenizer()[2]).encode(" " * 1_500_000 + "x", add_special_tokens=False).ids
    assert got["length"] == len(want) + 1
