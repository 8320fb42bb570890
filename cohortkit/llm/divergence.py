"""How far the sources of a language diverge in their words, exactly.

Each group (language, source) gives every term that its language keeps a price:
p = 1 + floor(10**9 * (count + 1) / (N + V)), N the group's occurrences of kept terms and V
the number of kept terms.  The divergence of a group from another is the sum of
floor((p - q)**2 / q) over all kept terms, q the other's price.

Pairs are merged sparsely.  A group is a row of sorted (term id, count) arrays, cut by
a hash of the term into chunks of bounded size, and a pair task co-groups two such rows
for each unordered pair (those of two blocks of sources at a time).  A galloping
search of the shorter array in the longer finds the terms that both have, which are
priced both ways; terms of one side only are priced through the counts that occur there,
and absent terms are all alike.  No array of all terms is made for any group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches, stored

SCALE_A, SCALE_B = 31_250, 32_000          # their product is 10**9
CHUNK_TERMS = 32_768                       # terms of a chunk, about
BLOCK_SOURCES = 16                         # sources of a block, about
HELD_TERMS = 500_000                       # counts that a task holds before it emits them
ONE_DOC = 1 << 40                          # a held count is occurrences + ONE_DOC * documents

#: Letters A-Z lower-cased; other ASCII characters than letters separate terms.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))


def price(count: Column, total: Column) -> Column:
    """1 + floor(10**9 * (count + 1) / total), in two steps of a long
    division, so that counts up to 10**14 don't overflow."""
    c = (count + 1) * F.lit(SCALE_A).cast("long")
    return 1 + _div(c, total) * SCALE_B + _div((c % total) * F.lit(SCALE_B).cast("long"), total)


def gap(p: Column, q: Column) -> Column:
    """floor((p - q)**2 / q); prices are at most 10**9 + 1."""
    return _div((p - q) * (p - q), q)


def _div(a: Column, b: Column) -> Column:
    """Floor of the quotient of longs that are not negative."""
    return F.call_function("div", a, b)


def _price(count: np.ndarray, total: int) -> np.ndarray:
    c = (count + 1) * SCALE_A
    return 1 + c // total * SCALE_B + (c % total) * SCALE_B // total


def _gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _words(body: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The terms of a text in lists of bounded size (unless one term is longer)."""
    folded = body.translate(_FOLD)
    at = 0
    while len(folded) - at > size:
        end = folded.find(b" ", at + size)
        if end < 0:
            break
        yield folded[at:end].split()
        at = end
    yield folded[at:].split()


def group_terms(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs) of ``docs`` (lang, source, body: all
    binary): occurrences and documents of each term in each group, added up in the tasks first."""
    types = [pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
    names = ["lang", "source", "term", "n", "docs"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, dict[bytes, int]] = {}
        size = 0

        def out():
            for (lang, source), terms in held.items():
                both = np.fromiter(terms.values(), np.int64, len(terms))
                cols = [[lang] * len(terms), [source] * len(terms), list(terms), both % ONE_DOC, both // ONE_DOC]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

        for b in batches:
            for lang, source, body in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                terms = held.setdefault((lang, source), {})
                before = len(terms)
                seen: dict[bytes, int] = {}
                for words in _words(body):
                    for w in words:
                        seen[w] = seen.get(w, 0) + 1
                for w, k in seen.items():
                    terms[w] = terms.get(w, 0) + k + ONE_DOC
                size += len(terms) - before
                if size > HELD_TERMS:
                    yield from out()
                    held, size = {}, 0
        yield from out()

    small_batches(docs.sparkSession)
    part = docs.mapInArrow(run, "lang binary, source binary, term binary, n long, docs long")
    part = part.select(F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), "term", "n", "docs")
    return part.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def merge_pair(a: tuple, b: tuple) -> tuple[int, int, int]:
    """Of two groups (ids, counts, values, times, total), ids sorted: the sums of
    the gaps of a from b and of b from a over the terms that either has, and the
    number of these terms.  ``values`` and ``times`` say which counts occur in a group
    and how often."""
    ids_a, n_a, val_a, times_a, total_a = a
    ids_b, n_b, val_b, times_b, total_b = b
    none = np.zeros(1, np.int64)
    zero_a, zero_b = _price(none, total_a), _price(none, total_b)
    # terms of one side, as if the other side had none of them
    pa_, pb_ = _price(val_a, total_a), _price(val_b, total_b)
    ab = int((_gap(pa_, zero_b) * times_a).sum()) + int((_gap(zero_a, pb_) * times_b).sum())
    ba = int((_gap(zero_b, pa_) * times_a).sum()) + int((_gap(pb_, zero_a) * times_b).sum())
    # terms of both
    if len(ids_a) <= len(ids_b):
        at = np.searchsorted(ids_b, ids_a)
        hit = np.flatnonzero(ids_b[np.minimum(at, len(ids_b) - 1)] == ids_a) if len(ids_b) else np.zeros(0, np.int64)
        x, y = n_a[hit], n_b[at[hit]]
    else:
        at = np.searchsorted(ids_a, ids_b)
        hit = np.flatnonzero(ids_a[np.minimum(at, len(ids_a) - 1)] == ids_b) if len(ids_a) else np.zeros(0, np.int64)
        x, y = n_a[at[hit]], n_b[hit]
    px, py = _price(x, total_a), _price(y, total_b)
    ab += int((_gap(px, py) - _gap(px, zero_b) - _gap(zero_a, py)).sum())
    ba += int((_gap(py, px) - _gap(zero_b, px) - _gap(py, zero_a)).sum())
    return ab, ba, len(ids_a) + len(ids_b) - len(x)


def _merge_blocks(left: pa.Table, right: pa.Table) -> pa.Table:
    """The pair task: every unordered pair of a source of one block and one of
    the other (or of two sources of one block), over one chunk of the terms."""
    def arrays(t: pa.Table) -> list[tuple]:
        out = []
        for source, total, cells in zip(t["source"].to_pylist(), t["total"].to_pylist(), t["cells"]):
            flat = cells.values
            ids, n = (flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
            out.append((source, (ids, n, *np.unique(n, return_counts=True), total)))
        return sorted(out, key=lambda x: x[0])          # a pair of one block has the same order in every chunk

    rows: list[tuple] = []
    if left.num_rows and right.num_rows:
        lang = left["lang"][0].as_py()
        one = left["block_a"][0] == left["block_b"][0]
        a = arrays(left)
        b = a if one else arrays(right)
        for i, (u, x) in enumerate(a):
            for v, y in (b[i + 1:] if one else b):
                rows.append((lang, u, v, *merge_pair(x, y)))
    kinds = [pa.string()] * 3 + [pa.int64()] * 3
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 6, kinds)], ["lang", "a", "b", "ab", "ba", "either"])


def pair_divergence(cells: DataFrame, groups: DataFrame, chunk_terms: int = CHUNK_TERMS, block_sources: int = BLOCK_SOURCES) -> DataFrame:
    """(lang, source, other, value): the divergence of each group from each
    other source of its language.

    ``cells`` (lang, source, id, n) has the kept terms' counts, ``groups`` (lang, source, v, total) every
    group with its language's number of kept terms and the divisor of its prices."""
    sized = groups.join(groups.groupBy("lang").agg(F.count("*").alias("sources")), "lang").select(
        "lang", "source", "v", "total", F.greatest(F.lit(1), F.ceil(F.col("v") / chunk_terms)).cast("long").alias("chunks"),
        F.ceil(F.col("sources") / block_sources).cast("long").alias("blocks"))
    sized = stored(sized, "divergence-groups")
    none = F.lit(None).cast("struct<id: bigint, n: bigint>")
    key = ["lang", "source", "total", "blocks", "chunk"]
    placed = cells.join(sized, ["lang", "source"]).select(
        "lang", "source", "total", "blocks", F.pmod(F.xxhash64("id"), "chunks").alias("chunk"), F.struct("id", "n").alias("cell"))
    bare = sized.select("lang", "source", "total", "blocks", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"), none.alias("cell"))
    rows = placed.union(bare).groupBy(*key).agg(F.sort_array(F.collect_list("cell")).alias("cells"))
    rows = stored(rows.withColumn("block", F.pmod(F.xxhash64("source"), "blocks")), "divergence-arrays")
    pair = ["lang", "chunk", "block_a", "block_b"]
    left = rows.withColumn("block_a", F.col("block")).withColumn("block_b", F.explode(F.sequence("block", F.col("blocks") - 1)))
    right = rows.withColumn("block_b", F.col("block")).withColumn("block_a", F.explode(F.sequence(F.lit(0).cast("long"), "block")))
    cols = [*pair, "source", "total", "cells"]
    merged = left.select(cols).groupBy(*pair).cogroup(right.select(cols).groupBy(*pair)).applyInArrow(
        _merge_blocks, "lang string, a string, b string, ab long, ba long, either long")
    merged = merged.groupBy("lang", "a", "b").agg(F.sum("ab").alias("ab"), F.sum("ba").alias("ba"), F.sum("either").alias("either"))
    zero = price(F.lit(0).cast("long"), F.col("total"))
    side = {m: groups.select("lang", F.col("source").alias(m), zero.alias("z" + m), "v") for m in ("a", "b")}
    merged = merged.join(side["a"], ["lang", "a"]).join(side["b"].drop("v"), ["lang", "b"])
    absent = F.col("v") - F.col("either")
    both = F.array(*[F.struct(F.col(s).alias("source"), F.col(o).alias("other"), (F.col(s + o) + absent * gap(F.col("z" + s), F.col("z" + o))).alias("value")) for s, o in ("ab", "ba")])
    return merged.select("lang", F.explode(both).alias("x")).select("lang", "x.*")


def source_divergence(docs: DataFrame, min_docs: int = 3, top_terms: int = 200, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
                      chunk_terms: int = CHUNK_TERMS, block_sources: int = BLOCK_SOURCES) -> DataFrame:
    """lang, source, part, item, value, rank.  Part ``pair``: the divergence of
    the group from each other source of its language.  Part ``term``: the terms that
    the group has and prices higher than its language does, by the term's gap, the
    first ``top_terms`` of them.  Ranks start at 1, the larger value first, then the item in
    UTF-8 order.

    A language keeps the terms of ``min_docs`` or more of its rows.  Null texts,
    languages and sources count as empty strings; a group without terms has its
    pairs like any other, and where a language keeps no term the values are 0.  Repeated rows
    count as often as they occur; an empty table gives an empty result."""
    said = [F.coalesce(F.col(c).cast("string"), F.lit("")).cast("binary") for c in (lang_col, source_col, text_col)]
    raw = docs.select(said[0].alias("lang"), said[1].alias("source"), said[2].alias("body"))
    every = raw.select(F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source")).distinct()
    cells = stored(group_terms(raw), "divergence-terms")
    vocabulary = cells.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n")).where(F.col("docs") >= min_docs)
    # ids hold because they are written
    vocabulary = stored(vocabulary.select("lang", "term", "lang_n", F.monotonically_increasing_id().alias("id")), "divergence-vocabulary")
    cells = stored(cells.drop("docs").join(vocabulary, ["lang", "term"]), "divergence-cells")
    langs = vocabulary.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total"))
    own = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    v, n = F.coalesce("v", F.lit(0).cast("long")), F.coalesce("total", F.lit(0).cast("long"))
    groups = every.join(own, ["lang", "source"], "left").join(langs, "lang", "left").select(
        "lang", "source", v.alias("v"), F.greatest(n + v, F.lit(1)).cast("long").alias("total"), (F.col("lang_total") + v).alias("lang_total"))
    groups = stored(groups, "divergence-groups")

    def ranked(rows: DataFrame) -> DataFrame:
        w = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
        return rows.withColumn("rank", F.row_number().over(w))

    pairs = pair_divergence(cells.select("lang", "source", "id", "n"), groups.drop("lang_total"), chunk_terms, block_sources)
    pairs = ranked(pairs.select("lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), "value"))
    priced = cells.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", price(F.col("n"), F.col("total")).alias("p"), price(F.col("lang_n"), F.col("lang_total")).alias("q"))
    terms = priced.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"), gap(F.col("p"), F.col("q")).alias("value"))
    return pairs.unionByName(ranked(terms).where(F.col("rank") <= top_terms))
