"""Line de-duplication by an exact set-similarity join.

A line is the set of its words (lower-cased, split at white space).  Words are
ordered by rarity over the whole corpus; a line is indexed under its rarest
words only (prefix filter), and candidates must agree in length and position so
that the overlap can still suffice.  Candidates are verified on the words
themselves by Jaccard similarity, and a line that matches an earlier one (smaller
document id, then smaller line number) is removed.

Equal word sets are one class.  A class is removed wherever it occurs if an
earlier class matches it, otherwise everywhere but at its first place; so it is
enough to know one earlier match of each class.  Index entries are shuffled by
word once and read in order.  Under a word with few entries all pairs are
candidates.  Under a word with many, each entry is first held against the earliest
entry of each length, which settles groups of alike lines at a cost in proportion to
their size; the classes that this leaves open are then joined with all entries.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textnum as tn
from .common import discard, id_and_text, release, row_keys, stored, sub_batches, unused

RARITY_BITS = 22            # buckets of the word counts
RARITY_BLOCK = 8192
FILTER_BITS = 24            # log2 of the bits of a membership filter
FEW = 512                   # entries under a word up to which all pairs are candidates
MOST_PAIRS = 1 << 18        # pairs that a task holds before it hands them on
EXACT = 1024                # counts from here on are coded by their logarithm, in steps of half a percent
MOST = 4095                 # the largest code: 12 bits of a sort key
_U = np.uint64
_LINES = "doc long, line_no int, k1 long, bits long, bits2 long, n int, prefix array<long>"
_FOUND = "a long, adoc long, b long, bdoc long, entry long"


def _folded(t: str | None) -> bytes:
    return (t or "").lower().encode("utf-8", "replace")


def _tokens(raw: list[bytes]):
    buf, at = tn.join_texts(raw)
    starts, ends = tn.token_spans(buf)
    return buf, at, starts, tn.token_hashes(buf, starts, ends)


def _bucket(h: np.ndarray) -> np.ndarray:
    return (h >> _U(64 - RARITY_BITS)).astype(np.int64)


def rarity_codes(counts: np.ndarray) -> np.ndarray:
    """Codes of 12 bits in the order of the counts, up to 2**32."""
    c = np.maximum(counts, 1).astype(np.float64)
    high = EXACT + np.floor(np.log2(np.maximum(c, EXACT) / EXACT) * ((MOST - EXACT) / 22))
    return np.where(counts < EXACT, counts, np.minimum(high, MOST)).astype(np.uint16)


def line_words(raw: list[bytes], rarity: np.ndarray):
    """The distinct words of each non-blank line of lower-cased texts, the
    rarest first: (text, line number, first word) by line, the words' hashes and
    their counts.  Lines end at line feeds."""
    buf, at, starts, h = _tokens(raw)
    feeds = np.flatnonzero(buf == 10)
    step = np.zeros(len(starts) + 1, np.int64)
    np.add.at(step, np.searchsorted(starts, feeds), 1)
    line = np.cumsum(step)[:-1]                             # number of the line in the buffer
    c = np.minimum(rarity[_bucket(h)], MOST)                # one order for the whole corpus: count, then hash
    low = h >> _U(32)
    order = None
    if len(feeds) < 1 << 20:
        key = (line.astype(_U) << _U(44)) | (c.astype(_U) << _U(32)) | low
        order = np.argsort(key)
        k, x = key[order], h[order]
        if ((k[1:] == k[:-1]) & (x[1:] != x[:-1])).any():   # words that differ in the other half of the hash only
            order = None
    if order is None:
        order = np.lexsort((h, c, line))
    h, line, c = h[order], line[order], c[order]
    first = np.ones(len(h), bool)
    first[1:] = (h[1:] != h[:-1]) | (line[1:] != line[:-1])
    h, line, c = h[first], line[first], c[first]
    new = np.ones(len(line), bool)
    new[1:] = line[1:] != line[:-1]
    lo = np.flatnonzero(new)
    lines = line[lo]
    begin = np.where(lines > 0, feeds[lines - 1] + 1, 0)
    text = np.searchsorted(at, begin, "right") - 1
    return text, lines - np.searchsorted(feeds, at[text]), lo, h, c


def _keys(lo: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each word set a 64-bit sum of hashes and the two halves of a
    parity bitmap of 128 bits (the number of bits in which two bitmaps differ is at most
    the size of the symmetric difference).  The sum and the first half tell the class."""
    if not len(lo):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    k1 = np.add.reduceat(tn.mix(h ^ _U(0x1F83D9ABFB41BD6B)), lo)
    one, side = _U(1) << (h & _U(63)), (h & _U(64)) > 0
    bits = np.bitwise_xor.reduceat(np.where(side, _U(0), one), lo)
    bits2 = np.bitwise_xor.reduceat(np.where(side, one, _U(0)), lo)
    return k1.view(np.int64), bits.view(np.int64), bits2.view(np.int64)


def word_counts(docs: DataFrame) -> np.ndarray:
    """Occurrences of the words over all documents, in hashed buckets: a
    table of fixed size.  Each task counts its texts, and blocks of buckets are added
    up on the executors."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << RARITY_BITS, np.uint32)
        for b in batches:
            raw = [_folded(t) for t in b.column(0).to_pylist()]
            for x, z in sub_batches(raw, 1 << 18):
                np.add.at(total, _bucket(_tokens(raw[x:z])[-1]), np.uint32(1))
        parts = total.reshape(-1, RARITY_BLOCK)
        used = np.flatnonzero(parts.any(axis=1))
        for i in range(0, len(used), 64):
            yield pa.RecordBatch.from_arrays([pa.array(used[i:i + 64].astype(np.int32)), pa.array([_pack(parts[j]) for j in used[i:i + 64]], pa.binary())], ["block", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}      # blocks of this partition only
        for b in batches:
            for k, v in zip(b.column(0).to_pylist(), b.column(1)):
                c = np.frombuffer(_unpack(v.as_buffer()), np.uint32).astype(np.uint64)
                total[k] = total[k] + c if k in total else c
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([np.minimum(c, 2**32 - 1).astype(np.uint32).tobytes() for c in total.values()], pa.binary())], ["block", "counts"])

    blocks = docs.select("text").mapInArrow(count, "block int, counts binary").repartition("block").mapInArrow(add, "block int, counts binary")
    out = np.zeros(1 << RARITY_BITS, np.uint32).reshape(-1, RARITY_BLOCK)
    for r in blocks.collect():                 # 2**RARITY_BITS counts in all
        out[r["block"]] = np.frombuffer(r["counts"], np.uint32)
    return rarity_codes(out.ravel())


def _pack(a: np.ndarray) -> bytes:
    return pa.compress(a.tobytes(), codec="zstd", asbytes=True)


def _unpack(b) -> bytes:
    return pa.decompress(b, decompressed_size=4 * RARITY_BLOCK, codec="zstd")


def _lines(docs: DataFrame, counts, num: int, den: int) -> DataFrame:
    """Every non-blank line: place, class, set size, and its prefix entries
    word(32 bits) | size(16) | position(16).  A class has its entries at its first line
    in each task only.  Sets so small that only equal ones match are not indexed, nor
    are words that occur once in the corpus (a count of hashed buckets is never too small);
    sizes and positions above 65535 saturate, which only loosens the filters."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, seen = counts.value, set()
        for b in batches:
            ids = b.column(0).to_pylist()
            raw = [_folded(t) for t in b.column(1).to_pylist()]
            for x, z in sub_batches(raw, 1 << 18):
                text, number, lo, h, c = line_words(raw[x:z], table)
                if not len(lo):
                    continue
                n = np.diff(np.append(lo, len(h)))
                k1, bits, bits2 = _keys(lo, h)
                fresh = np.zeros(len(lo), bool)
                for i, k in enumerate(np.stack([k1, bits], axis=1).view("V16").ravel().tolist()):
                    if k not in seen:
                        seen.add(k)
                        fresh[i] = True
                line = np.repeat(np.arange(len(lo)), n)
                pos, size = np.arange(len(h)) - lo[line], n[line]
                least = -(-size * num // den)              # overlap with a line of like size
                use = (pos <= size - least) & (size * (den - num) >= num) & fresh[line] & (c > 1)
                entry = (h[use] & _U(0xFFFFFFFF00000000)) | (np.minimum(size[use], 65535).astype(_U) << _U(16)) | np.minimum(pos[use], 65535).astype(_U)
                many = np.bincount(line[use], minlength=len(lo))
                prefix = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(many)]).astype(np.int32)), pa.array(entry.view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array([ids[x + i] for i in text], pa.int64()), pa.array(number.astype(np.int32)), pa.array(k1), pa.array(bits),
                                                  pa.array(bits2), pa.array(n.astype(np.int32)), prefix], [f.split()[0] for f in _LINES.split(", ")])
    return docs.select("doc", "text").mapInArrow(run, _LINES)


def _fits(un, up, vn, vp, num: int, den: int, ceiling, least):
    """Length filter, and positional filter for a word that stands at
    positions up and vp of sets of un and vn words."""
    need = ceiling((un + vn) * num / (num + den))           # overlap that the similarity asks for
    room = least(un - up, vn - vp)                          # this word and those after it
    big = (un >= 65535) | (vn >= 65535)
    return big | ((un * den >= vn * num) & (vn * den >= un * num) & (room >= need))


def _near_bits(ubits, vbits, un, vn, num: int, den: int, ones):
    """Whether two sets' bitmaps (pairs of halves) allow the similarity:
    their symmetric difference is at least the number of differing bits."""
    return ((ones(ubits[0], vbits[0]) + ones(ubits[1], vbits[1])) * (den + num) <= (un + vn) * (den - num)) | (un >= 65535) | (vn >= 65535)


def _candidates(entries: DataFrame, num: int, den: int, few_entries: int, part_rows: int = 65536, most_pairs: int = MOST_PAIRS) -> DataFrame:
    """Rows (a, adoc, b, bdoc) for pairs of lines, each told by bitmap and
    document, and rows (a, adoc, entry) for the entries under words with more than
    ``few_entries``.  ``entries`` (entry, a, adoc, a2) come word by word, the smallest
    document first."""
    names = [f.split()[0] for f in _FOUND.split(", ")]
    empty = np.zeros((4, 0), np.int64)

    def pairs(x, y):
        """Those of the pairs of entries (columns of x and y) that pass."""
        xn, yn = (x[0] >> 16) & 65535, (y[0] >> 16) & 65535
        ok = _fits(xn, x[0] & 65535, yn, y[0] & 65535, num, den, np.ceil, np.minimum)
        x, y, xn, yn = x[:, ok], y[:, ok], xn[ok], yn[ok]
        ok = _near_bits((x[1], x[3]), (y[1], y[3]), xn, yn, num, den, lambda a, b: np.bitwise_count((a ^ b).view(_U)).astype(np.int64))
        return np.stack([x[1][ok], x[2][ok], y[1][ok], y[2][ok]])

    def few(x):
        """All pairs under each word, by size, as far as sizes are alike."""
        w, n = x[0] >> 32, (x[0] >> 16) & 65535
        order = np.lexsort((n, w)) if len(w) else np.zeros(0, np.int64)
        x, w, n = x[:, order], w[order], n[order]
        left, step = np.arange(len(w)), 1
        while len(left):
            left = left[left + step < len(w)]
            to = left + step
            go = (w[to] == w[left]) & ((n[left] * den >= n[to] * num) | (n[to] >= 65535))
            left, to = left[go], to[go]
            yield pairs(x[:, left], x[:, to])
            step += 1

    def handed(some):
        """Batches of the pairs of ``some``, a few at a time: a group of alike lines
        gives the same pairs under many words, and those of a task need not fit."""
        got, held = [], 0
        for ab in some:
            got.append(ab)
            held += ab.shape[1]
            if held >= most_pairs:
                yield out(np.concatenate(got, axis=1))
                got, held = [], 0
        if held:
            yield out(np.concatenate(got, axis=1))

    def out(ab):
        swap = (ab[0] > ab[2]) | ((ab[0] == ab[2]) & (ab[1] > ab[3]))
        ab = np.unique(np.where(swap, ab[[2, 3, 0, 1]], ab), axis=1) if ab.shape[1] else ab
        return pa.RecordBatch.from_arrays([*map(pa.array, ab), pa.nulls(ab.shape[1], pa.int64())], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = empty                                        # the last word, if it has few entries so far
        lead: dict[int, np.ndarray] = {}                    # of a word with many: size -> its earliest entry
        lead_word = None                                    # the last word, if it has many

        def many(x):
            n = (x[0] >> 16) & 65535
            for size, i in zip(*np.unique(n, return_index=True)):
                lead.setdefault(int(size), x[:, i:i + 1])
            yield from handed(pairs(x, np.repeat(y, x.shape[1], axis=1)) for y in lead.values())
            none = pa.nulls(x.shape[1], pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(x[1]), pa.array(x[2]), none, none, pa.array(x[0])], names)

        def parts():
            """The batches, joined to some tens of thousands of rows."""
            wait, rows = [], 0
            for b in batches:
                wait.append(np.stack([c.to_numpy(zero_copy_only=False) for c in b.columns]))
                rows += b.num_rows
                if rows >= part_rows:
                    yield np.concatenate(wait, axis=1)
                    wait, rows = [], 0
            if rows:
                yield np.concatenate(wait, axis=1)

        for x in parts():
            x = np.concatenate([held, x], axis=1)
            w = x[0] >> 32
            start = np.flatnonzero(np.append(True, w[1:] != w[:-1]))
            size = np.diff(np.append(start, len(w)))
            if lead_word == w[0]:                           # goes on from the batch before
                yield from many(x[:, :int(size[0])])
                start, size = start[1:], size[1:]
            keep = len(w)
            if len(start):
                lead_word = None
                lead.clear()
                if size[-1] <= few_entries:                 # may go on in the next batch
                    keep = int(start[-1])
                    start, size = start[:-1], size[:-1]
                else:
                    lead_word = w[-1]
            for s, z in zip(start[size > few_entries].tolist(), size[size > few_entries].tolist()):
                lead.clear()
                yield from many(x[:, s:s + z])
            if lead_word is None:
                lead.clear()
            if len(start):
                sel = int(start[0]) + np.flatnonzero(np.repeat(size <= few_entries, size))
                if len(sel):
                    yield from handed(few(x[:, sel]))
            held = x[:, keep:]
        if held.shape[1]:
            yield from handed(few(held))

    # word, then document (its low half: which entry counts as earliest only decides what is tried first)
    order = F.col("entry").bitwiseAND(F.lit(-1 << 32).cast("long")).bitwiseOR(F.col("adoc").bitwiseAND(F.lit((1 << 32) - 1).cast("long")))
    dealt = entries.repartition(F.shiftrightunsigned("entry", 32)).sortWithinPartitions(order)
    return dealt.select("entry", "a", "adoc", "a2").mapInArrow(run, _FOUND)


def _filter_bits(rows: DataFrame, hashed: Column) -> np.ndarray:
    """A membership filter of fixed size: a bitmap over a hash."""
    at = hashed.bitwiseAND(F.lit((1 << FILTER_BITS) - 1).cast("long")) + 1    # Spark's bitmaps count from 1
    got = rows.select(F.bitmap_bucket_number(at).alias("b"), F.bitmap_bit_position(at).alias("p")).groupBy("b").agg(F.bitmap_construct_agg("p").alias("m"))
    out = np.zeros((1 << FILTER_BITS) // 8 + 4096, np.uint8)
    for r in got.collect():                    # 2**FILTER_BITS bits in all
        lo = (r["b"] - 1) * 4096
        out[lo:lo + 4096] = np.frombuffer(bytes(r["m"]), np.uint8)
    return out


def _inside(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = (h & _U((1 << FILTER_BITS) - 1)).astype(np.int64)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


def _may_match(rows: DataFrame, hashed: Column, used: list) -> Column:
    """Tests a hash (a column of another table, by calling) against those of
    ``rows``: false only if it is not among them.  It spares a join the shuffle of
    most rows that find nothing.  ``used`` collects what was broadcast."""
    sent = rows.sparkSession.sparkContext.broadcast(_filter_bits(rows, hashed))
    used.append(sent)

    @F.arrow_udf("boolean")
    def test(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for a in batches:
            yield pa.array(_inside(sent.value, a.to_numpy(zero_copy_only=False).view(_U)))
    return test


def _class_words(docs: DataFrame, places: DataFrame, counts, used: list) -> DataFrame:
    """(k1, bits, words) of the lines at ``places`` (doc, line_no), read from
    the texts; filters spare the work on most other texts and keep most other lines from
    leaving the tasks.  Both are tested where the texts are read: a filter before it
    would be a second Python worker beside each task."""
    sc = docs.sparkSession.sparkContext
    sent = sc.broadcast((_filter_bits(places, F.xxhash64("doc")), _filter_bits(places, F.xxhash64("doc", "line_no"))))
    used.append(sent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some, lines = sent.value
        for b in batches:
            # as Spark hashes (doc), which it goes on from for (doc, line_no)
            seeds = [xxhash.xxh64_intdigest(struct.pack("<q", d), 42) for d in b.column(0).to_pylist()]
            raw = []
            for i in np.flatnonzero(_inside(some, np.array(seeds, _U))).tolist():
                own, seed = _folded(b.column(1)[i].as_py()).split(b"\n"), seeds[i]
                h = np.array([xxhash.xxh64_intdigest(struct.pack("<i", n), seed) for n in range(len(own))], _U)
                raw += [x for x, hit in zip(own, _inside(lines, h)) if hit and x.strip()]
            for x, z in sub_batches(raw, 1 << 18):
                text, _, lo, words, _ = line_words(raw[x:z], counts.value)
                k1, bits, _ = _keys(lo, words)
                yield pa.RecordBatch.from_arrays([pa.array(k1), pa.array(bits), pa.array([raw[x + i].decode("utf-8", "replace") for i in text], pa.string())], ["k1", "bits", "line"])

    found = docs.select("doc", "text").mapInArrow(run, "k1 long, bits long, line string").groupBy("k1", "bits").agg(F.min("line").alias("line"))
    return found.select("k1", "bits", F.array_distinct(F.filter(F.split("line", r"[ \t\n\x0B\f\r]+"), lambda w: w != "")).alias("words"))


def line_classes(docs: DataFrame, similarity: tuple[int, int] = (4, 5), few_entries: int = FEW, tables: list | None = None) -> tuple[DataFrame, DataFrame]:
    """(lines, marked) of ``docs`` (doc, text): every non-blank line (doc,
    line_no, k1, bits), and the classes (k1, bits) that have several lines or match: the place of the
    first line (first) and ``matched``, whether a class that begins earlier has a
    Jaccard similarity of num/den or more to it."""
    num, den = similarity

    def kept(df: DataFrame, name: str) -> DataFrame:
        t = stored(df, name)
        if tables is not None:
            tables.append(t)                                # for the caller to discard
        return t

    counts = docs.sparkSession.sparkContext.broadcast(word_counts(docs))
    used = [counts]                                         # broadcasts that end with this function
    lines = kept(_lines(docs, counts, num, den), "lines")
    place = F.struct("doc", "line_no")
    # classes of one line need no entry here: it is their first
    repeated = kept(lines.groupBy("k1", "bits").agg(
        F.min(place).alias("first"), F.min(F.when(F.size("prefix") > 0, place)).alias("indexed"), F.count("*").alias("lines")).where("lines > 1").drop("lines"), "line-repeats")
    release(docs.sparkSession)
    # a class is indexed once in the corpus, whatever tasks it is in: only lines that may repeat are joined
    maybe = lines.where(F.size("prefix") > 0).withColumn("again", _may_match(repeated, F.xxhash64("k1", "bits"), used)(F.xxhash64("k1", "bits")))
    cols = ["prefix", "bits", "bits2", "doc"]
    alone = maybe.where(~F.col("again")).select(cols)
    once = maybe.where("again").join(repeated, ["k1", "bits"], "left").where(F.col("indexed").isNull() | (F.col("indexed") == place)).select(cols)
    entries = alone.union(once).select(F.explode("prefix").alias("entry"), F.col("bits").alias("a"), F.col("doc").alias("adoc"), F.col("bits2").alias("a2"))
    found = kept(_candidates(entries, num, den, few_entries), "line-candidates")
    release(docs.sparkSession)

    def named(rows: DataFrame) -> DataFrame:
        """The classes (k1, bits, bits2, first) of lines told by (bits, doc)."""
        test = _may_match(rows, F.xxhash64("bits", "doc"), used)
        own = lines.where(test(F.xxhash64("bits", "doc"))).select("k1", "bits", "bits2", "doc", place.alias("own")).join(rows, ["bits", "doc"], "left_semi")
        rep = repeated.select("k1", "bits", "first")
        return own.join(rep, ["k1", "bits"], "left").select("doc", "k1", "bits", "bits2", F.coalesce("first", "own").alias("first")).distinct()

    def verified(pairs: DataFrame) -> DataFrame:
        """(k1, bits, first) of the classes of ``pairs`` (a, adoc, b, bdoc)
        that match an earlier one."""
        p = kept(pairs.distinct(), "line-found")
        if p.isEmpty():
            return repeated.where("false").select("k1", "bits", "first")
        who = kept(named(p.select(F.col("a").alias("bits"), F.col("adoc").alias("doc")).union(p.select("b", "bdoc")).distinct()), "line-named")
        for side, m in (("a", "u"), ("b", "v")):
            p = p.join(who.select(F.col("bits").alias(side), F.col("doc").alias(side + "doc"), F.struct("k1", "bits").alias(m), F.col("first").alias(m + "first")), [side, side + "doc"])
        p = p.where((F.col("u") != F.col("v")) & (F.col("ufirst") != F.col("vfirst")))
        late = F.col("ufirst") > F.col("vfirst")
        p = kept(p.select(*[F.when(late, F.col(a)).otherwise(F.col(b)).alias(c) for a, b, c in (
            ("u", "v", "x"), ("v", "u", "y"), ("ufirst", "vfirst", "xfirst"), ("vfirst", "ufirst", "yfirst"))]).distinct(), "line-pairs")
        places = kept(p.select("xfirst.*").union(p.select("yfirst.*")).distinct(), "line-places")
        words = kept(_class_words(docs, places, counts, used), "line-words")

        def similar(q: DataFrame) -> DataFrame:
            for m in ("x", "y"):
                q = q.join(words.select(F.struct("k1", "bits").alias(m), F.col("words").alias(m + "words")), m)
            both = F.size(F.array_intersect("xwords", "ywords"))
            return q.where(both * den >= (F.size("xwords") + F.size("ywords") - both) * num).select("x", "xfirst").distinct()

        # one match is enough: the earliest candidate first, the others where it fails
        one = p.groupBy("x").agg(F.min(F.struct("yfirst", "y", "xfirst")).alias("c")).select("x", "c.y", "c.xfirst")
        one = kept(similar(one), "line-one")
        return one.union(similar(p.join(one.select("x"), "x", "left_anti"))).select("x.*", F.col("xfirst").alias("first"))

    settled = kept(verified(found.where("entry is null").select("a", "adoc", "b", "bdoc")), "line-settled")
    # under words with many entries: the open classes against all that begin earlier
    many = kept(found.where("entry is not null").select("entry", F.col("a").alias("bits"), F.col("adoc").alias("doc")), "line-many")
    who = named(many.select("bits", "doc").distinct())
    many = many.join(who, ["bits", "doc"]).groupBy("k1", "bits", "bits2", "first", "entry").agg(F.min("doc").alias("doc")).select(
        F.shiftright("entry", 32).alias("w"), F.shiftright("entry", 16).bitwiseAND(F.lit(65535).cast("long")).alias("n"),
        F.col("entry").bitwiseAND(F.lit(65535).cast("long")).alias("p"), "k1", "bits", "bits2", "first", "doc")
    many = kept(many, "line-many")
    probe = many.join(settled.select("k1", "bits"), ["k1", "bits"], "left_anti").select(
        "w", F.col("n").alias("un"), F.col("p").alias("up"), F.col("bits").alias("a"), F.col("bits2").alias("a2"), F.col("doc").alias("adoc"), F.col("first").alias("ufirst"))
    other = many.select(F.col("w").alias("vw"), F.col("n").alias("vn"), F.col("p").alias("vp"), F.col("bits").alias("b"), F.col("bits2").alias("b2"), F.col("doc").alias("bdoc"), F.col("first").alias("vfirst"))
    near = _fits(F.col("un"), F.col("up"), F.col("vn"), F.col("vp"), num, den, F.ceil, F.least) & _near_bits(
        (F.col("a"), F.col("a2")), (F.col("b"), F.col("b2")), F.col("un"), F.col("vn"), num, den, lambda a, b: F.bit_count(a.bitwiseXOR(b)))
    rest = probe.join(other, (F.col("w") == F.col("vw")) & (F.col("vfirst") < F.col("ufirst")) & near).select("a", "adoc", "b", "bdoc")
    matched = settled.union(verified(rest)).distinct().withColumn("matched", F.lit(True))
    marked = repeated.select("k1", "bits", "first", F.lit(False).alias("matched")).union(matched.select("k1", "bits", "first", "matched"))
    marked = marked.groupBy("k1", "bits").agg(F.min("first").alias("first"), F.max("matched").alias("matched"))
    marked = kept(marked, "line-marked")
    for b in used:
        b.destroy()
    return lines.select("doc", "line_no", "k1", "bits"), marked


def _removed(keyed: DataFrame, row: str, similarity: tuple[int, int], text_col: str, few_entries: int, tables: list | None) -> DataFrame:
    """(doc, removed) of the rows of ``keyed`` (see ``row_keys``) that lose
    lines; doc is the row's key."""
    d = id_and_text(keyed, row, text_col).select(F.col("doc_id").alias("doc"), "text")
    lines, marked = line_classes(d, similarity, few_entries, tables)
    test = _may_match(marked, F.xxhash64("k1", "bits"), [])
    j = lines.where(test(F.xxhash64("k1", "bits"))).join(marked, ["k1", "bits"])
    gone = F.col("matched") | (F.struct("doc", "line_no") != F.col("first"))
    return j.where(gone).groupBy("doc").agg(F.sort_array(F.collect_set("line_no")).alias("removed"))


def removed_lines(docs: DataFrame, similarity: tuple[int, int] = (4, 5), id_col: str = "doc_id", text_col: str = "text",
                  few_entries: int = FEW, tables: list | None = None) -> DataFrame:
    """(doc_id, removed): for each row that loses lines their sorted numbers
    (from 0).

    Later means a larger document id (a null one comes first), then a larger
    line number.  Blank lines are never matched.  Rows without an id or with an
    equal one are documents of their own, ordered by a hash of the text; of
    equal rows any one is the earliest."""
    keyed, row = row_keys(docs, id_col, text_col)
    r = _removed(keyed, row, similarity, text_col, few_entries, tables)
    ids = keyed.select(F.col(row).alias("doc"), F.col(id_col).cast("long").alias("doc_id"))
    return r.join(ids, "doc").select("doc_id", "removed")


def dedup_lines(docs: DataFrame, similarity: tuple[int, int] = (4, 5), id_col: str = "doc_id", text_col: str = "text",
                out: str = "__line_dedup", few_entries: int = FEW) -> DataFrame:
    """``docs``, all rows and columns, with a struct column ``out``: text
    (the text without the removed lines) and removed (their numbers from 0).

    Null and empty texts stay as they are.  A text of which no line is left is
    empty.  An empty table gives an empty result."""
    tables: list[DataFrame] = []
    used: list = []
    keyed, row = row_keys(docs, id_col, text_col)
    r = stored(_removed(keyed, row, similarity, text_col, few_entries, tables), "line-removed")
    for t in tables:                                        # all that the result needs is in r
        discard(t)
    release(docs.sparkSession)
    text = F.col(text_col).cast("string")
    hit, gone = unused(keyed, "hit"), unused(keyed, "removed")
    marked = keyed.withColumn(hit, _may_match(r, F.xxhash64("doc"), used)(F.xxhash64(row)))     # the others need no join
    none = F.array().cast("array<int>")
    same = marked.where(~F.col(hit)).withColumn(out, F.struct(text.alias("text"), none.alias("removed")))
    # merged at every size: both sides grow with the corpus
    r = r.select(F.col("doc").alias(row), F.col("removed").alias(gone)).hint("merge")
    j = marked.where(F.col(hit)).join(r, row, "left").withColumn(gone, F.coalesce(gone, none))
    kept = F.when(F.size(gone) == 0, text).otherwise(F.array_join(F.filter(
        F.split(text, "\n", -1), lambda x, i: ~F.array_contains(gone, i)), "\n"))
    cut = j.withColumn(out, F.struct(kept.alias("text"), F.col(gone).alias("removed")))
    return same.select(*docs.columns, out).union(cut.select(*docs.columns, out))
