"""Source divergence against plain Python, and its edge cases."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortkit.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, n long, total long, cells string, chunk int"


def plain(rows, min_docs=3, top=200):
    """{(lang, source, part, item): (value, rank)}, every kept term priced for every pair."""
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    docs, count, lang_count, sources = Counter(), Counter(), Counter(), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        sources[lang].add(source)
        words = [w.translate(fold) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        docs.update((lang, w) for w in set(words))
        count.update((lang, source, w) for w in words)
        lang_count.update((lang, w) for w in words)
    out = {}
    for lang, every in sources.items():
        kept = [w for (g, w), n in docs.items() if g == lang and n >= min_docs]
        v = len(kept)

        def prices(n_of):
            n = sum(map(n_of, kept))
            return {w: 1 + 10**9 * (n_of(w) + 1) // (n + v) for w in kept}
        own = {s: prices(lambda w: count[lang, s, w]) for s in every}
        whole = prices(lambda w: lang_count[lang, w])
        for s in every:
            pair = {o: sum((own[s][w] - own[o][w]) ** 2 // own[o][w] for w in kept) for o in every if o != s}
            term = {w: (own[s][w] - whole[w]) ** 2 // whole[w] for w in kept if count[lang, s, w] and own[s][w] > whole[w]}
            for part, found in (("pair", pair), ("term", term)):
                for k, (item, value) in enumerate(sorted(found.items(), key=lambda x: (-x[1], x[0].encode()))[:top if part == "term" else None], 1):
                    out[lang, s, part, item] = (value, k)
    return out


def rows_of(got):
    rows = [((r["lang"], r["source"], r["part"], r["item"]), (r["value"], r["rank"])) for r in got.collect()]
    assert len(dict(rows)) == len(rows)
    return dict(rows)


ODD = [("The cat, the CAT; it's Été été été", "en", "a"), ("cat dog the", "en", "a"), ("the cat é", "en", None), ("the cat dog dog", "en", "b"), ("dog", "en", "c"),
       (None, "en", "d"), ("", None, "a"), ("x x x", None, None), ("x y", None, "b"), ("x", "", "c"), ("9 !! \n", "de", "a"), ("y" * 3_000_000 + " z", "fr", "a"),
       ("dup", "fr", "b"), ("dup", "fr", "b"), ("dup", "fr", "b"), ("kİK K", "en", "b"), ("퟿\U0001F600", "en", "a")]


@pytest.mark.parametrize("chunk_terms,block_sources", [(32768, 16), (2, 1), (3, 2)])
def test_every_kind_of_row(spark, chunk_terms, block_sources):
    d = spark.createDataFrame([(i, *r, 1, 2, "z", 3) for i, r in enumerate(ODD)], SCHEMA).repartition(4)
    got = divergence.source_divergence(d, min_docs=2, top_terms=2, chunk_terms=chunk_terms, block_sources=block_sources)
    assert rows_of(got) == plain(ODD, 2, 2)


def test_many_sources_and_a_hot_one(spark):
    rng = np.random.default_rng(3)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    rows = [(" ".join(rng.choice(words, 40, p=None)), "en", "hot" if i % 3 == 0 else f"s{i % 41}") for i in range(240)]
    d = spark.createDataFrame([(i, *r, 1, 2, "z", 3) for i, r in enumerate(rows)], SCHEMA)
    assert rows_of(divergence.source_divergence(d, chunk_terms=50, block_sources=5)) == plain(rows)


def test_empty_table_and_no_kept_term(spark):
    d = spark.createDataFrame([(1, "once", "en", "a", 1, 2, "z", 3), (2, "more", "en", "b", 1, 2, "z", 3)], SCHEMA)
    assert divergence.source_divergence(d.where("false")).count() == 0
    assert rows_of(divergence.source_divergence(d)) == {("en", "a", "pair", "b"): (0, 1), ("en", "b", "pair", "a"): (0, 1)}


def test_prices_are_exact_for_large_counts(spark):
    rng = np.random.default_rng(1)
    pairs = [(int(c), int(c) + int(t) + 1) for c, t in zip(rng.integers(0, 10**14, 50), rng.integers(0, 10**14, 50))] + [(0, 1), (10**12, 10**12 + 1)]
    want = [1 + 10**9 * (c + 1) // t for c, t in pairs]
    assert [int(divergence._price(np.array([c]), t)[0]) for c, t in pairs] == want
    d = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, c long, t long")
    assert [r["p"] for r in d.select("i", divergence.price(F.col("c"), F.col("t")).alias("p")).orderBy("i").collect()] == want


def test_merge_equals_dense_sum():
    rng = np.random.default_rng(2)
    for size in (0, 1, 40):
        a, b = ({int(i): int(n) for i, n in zip(rng.choice(60, k, replace=False), rng.integers(1, 9, k))} for k in (size, 30))
        total = 70
        group = [(np.array(sorted(g), np.int64), np.array([g[i] for i in sorted(g)], np.int64)) for g in (a, b)]
        group = [(*g, *np.unique(g[1], return_counts=True), total) for g in group]
        p = [{i: 1 + 10**9 * (g.get(i, 0) + 1) // total for i in {*a, *b}} for g in (a, b)]
        want = [sum((x[i] - y[i]) ** 2 // y[i] for i in x) for x, y in (p, p[::-1])]
        assert divergence.merge_pair(*group) == (*want, len({*a, *b}))
