"""Document fingerprints by randomised edit embedding.

A shared random walk reads a text's characters: at step j the embedded string
gets the character under the pointer, and the pointer moves on if a shared random bit
for (j, character class) is set.  Texts at a small edit distance get embedded
strings at a small Hamming distance.  The fingerprint samples positions of the
embedded string, one bit each; positions are sampled consistently, so that texts of
like lengths sample mostly the same ones.  Bands of sampled bits give
candidates, which are verified on the whole fingerprint.

The random bits repeat every ``PERIOD`` steps.  The walk over a text is one
pass of table lookups: ``state[c]`` is the state after leaving a character of class c.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from itertools import accumulate
from operator import getitem, itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import id_and_text, stored

BITS = 256
CLASSES = 32
PERIOD = 8192
STRETCH = 3       # steps of the walk for each character
_U = np.uint64
OUT_SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double, shares_band_edited boolean")


@functools.lru_cache(maxsize=1)
def _walk() -> list[list]:
    """The states: entry c is the state reached, entry CLASSES the step."""
    move = np.random.default_rng(11).random((PERIOD, CLASSES)) < 0.5
    move[-1] = True
    after = np.empty((PERIOD, CLASSES), np.int64)
    nxt = np.argmax(move, axis=0) + PERIOD
    for t in range(PERIOD - 1, -1, -1):
        nxt = np.where(move[t], t, nxt)
        after[t] = nxt + 1
    states: list[list] = [[] for _ in range(PERIOD)]
    for t in range(PERIOD):
        states[t].extend(states[int(a) % PERIOD] for a in after[t])
        states[t].append(t)
    return states


@functools.lru_cache(maxsize=1)
def _samples() -> np.ndarray:
    """For each fingerprint bit the steps at which its running minimum of
    random priorities is renewed; the last one below N is a uniform sample of
    the first N steps, and is the same for most N near each other."""
    rng = np.random.default_rng(12)
    out = []
    for _ in range(BITS):
        at, low, rec = 0, rng.random(), [0]
        while at < 1 << 44:
            low *= rng.random()
            at += int(rng.geometric(max(low, 1e-18)))
            rec.append(at)
        out.append(rec)
    width = max(map(len, out))
    return np.array([r + [1 << 62] * (width - len(r)) for r in out], np.int64)


@functools.lru_cache(maxsize=4096)
def sampled_steps(n_chars: int) -> np.ndarray:
    records = _samples()
    return records[np.arange(BITS), (records < max(1, STRETCH * n_chars)).sum(axis=1) - 1]


def char_classes(text: str) -> np.ndarray:
    cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(_U)
    return (((cp + _U(1)) * _U(0x9E3779B97F4A7C15)) >> _U(59)).astype(np.uint8)


def arrivals(classes: np.ndarray, start: int = 0) -> np.ndarray:
    """Step at which the walk reaches each character, and the step after the
    last (one more than characters)."""
    states = _walk()
    path = accumulate(classes.tobytes(), getitem, initial=states[start % PERIOD])
    mod = np.fromiter(map(itemgetter(CLASSES), path), np.int64, len(classes) + 1)
    out = np.empty(len(mod), np.int64)
    out[0] = start
    # a character is left within PERIOD steps, so differences modulo PERIOD are exact
    np.cumsum((np.diff(mod) - 1) % PERIOD + 1, out=out[1:])
    out[1:] += start
    return out


def sample_bits(classes: np.ndarray, reach: np.ndarray) -> np.ndarray:
    """The fingerprint as 0/1 of a text given its walk."""
    steps = sampled_steps(len(classes))
    at = np.searchsorted(reach, steps, "right") - 1
    symbol = np.full(BITS, CLASSES, np.int64)          # past the end
    inside = at < len(classes)
    symbol[inside] = classes[at[inside]]
    h = (steps.astype(_U) * _U(0xD6E8FEB86659FD93)) ^ ((symbol.astype(_U) + _U(1)) * _U(0xA0761D6478BD642F))
    h = (h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return ((h ^ (h >> _U(32))) & _U(1)).astype(np.uint8)


def to_hex(bits: np.ndarray) -> str:
    return np.packbits(bits).tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal sampled characters: half of the bits of different ones
    agree by chance."""
    return float(max(0.0, 1.0 - 2.0 * np.count_nonzero(a != b) / BITS))


def shares_band(a: np.ndarray, b: np.ndarray, bands: int) -> bool:
    return bool((a.reshape(bands, -1) == b.reshape(bands, -1)).all(axis=1).any())


def _with_next(docs: DataFrame, parts: int) -> DataFrame:
    """Rows (bucket, guest, doc_id, text) dealt into range buckets of the id
    and sorted in each; every bucket ends with a copy of the row that follows
    it (``guest``), the last with the first row of all."""
    ids = docs.select("doc_id").where("doc_id is not null")
    qs = ids.approxQuantile("doc_id", [i / parts for i in range(1, parts)], 0.25 / parts) if parts > 1 else []
    bounds = sorted({int(q) for q in qs})
    lit = F.array(*[F.lit(b).cast("long") for b in bounds]) if bounds else F.array().cast("array<bigint>")
    bucket = F.coalesce(F.size(F.filter(lit, lambda b: F.col("doc_id") > b)), F.lit(0))
    own = docs.withColumn("bucket", bucket)
    # the first id of each bucket: as many rows as buckets
    low = [(r["bucket"], r["low"], r["nulls"]) for r in own.groupBy("bucket").agg(
        F.min("doc_id").alias("low"), F.max(F.col("doc_id").isNull()).alias("nulls")).collect()]
    if not low:
        return own.withColumn("guest", F.lit(False))
    low = sorted((b, None if nulls else v) for b, v, nulls in low)
    to = {}
    for i, (_, v) in enumerate(low):
        to.setdefault(v, []).append(low[i - 1][0])       # the bucket before; of the first: the last
    guest = F.lit(None).cast("int")
    for v, (b,) in to.items():
        hit = F.col("doc_id").isNull() if v is None else F.col("doc_id") == F.lit(v)
        guest = F.when(hit, F.lit(b)).otherwise(guest)
    places = F.array(F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("guest")),
                     F.struct(guest.alias("bucket"), F.lit(True).alias("guest")))
    return (docs.withColumn("bucket", bucket).withColumn("__p", F.explode(places)).where("__p.bucket is not null")
            .select("__p.bucket", "__p.guest", "doc_id", "text"))


def edit_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bands: int = 16,
                      parts: int | None = None) -> DataFrame:
    """Fingerprints of every whole text and of its edited text (the last
    quarter of the characters replaced by as many first ones of the next
    document; ascending id, rows without id first, equal ids by text; after the last
    the first), and the likeness of the text's fingerprint to the edited text's and
    to the next document's.

    Equal texts have equal fingerprints.  Null texts count as empty; empty
    texts have the fingerprint of a walk without characters.  A table of one
    row is its own next.  Repeated rows give a row each; an empty table gives
    an empty result."""
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    d = id_and_text(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    dealt = _with_next(d, parts)
    # buckets are numbered from 0 and fewer than partitions: one bucket a partition
    dealt = dealt.repartitionById(parts, F.col("bucket").cast("int")).sortWithinPartitions("bucket", "guest", "doc_id", "text").select("bucket", "guest", "doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib
        names = [f.split()[0] for f in OUT_SCHEMA.split(", ")]
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.bool_()]
        out: list[tuple] = []

        def measure(text: str):
            c = char_classes(text)
            reach = arrivals(c)
            return text, c, reach, sample_bits(c, reach)

        def finish(doc_id, this, nxt):
            text, c, reach, bits = this
            cut = len(c) // 4
            keep = len(c) - cut
            edited = text[:keep] + nxt[0][:cut]
            ec = np.concatenate([c[:keep], nxt[1][:cut]])
            er = np.concatenate([reach[:keep], arrivals(ec[keep:], int(reach[keep]))])
            eb = sample_bits(ec, er)
            out.append((doc_id, len(c), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), to_hex(bits), to_hex(eb),
                        likeness(bits, eb), likeness(bits, nxt[3]), shares_band(bits, eb, bands)))

        def flush():
            rows, out[:] = list(zip(*out)), []
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types)], names)

        wait, done = None, -1     # (id, measured text) whose next row is awaited; bucket that is complete
        for b in batches:
            for bucket, guest, doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3)):
                if bucket == done:                       # further guests with the same id
                    continue
                now = measure(text.as_py())
                if wait is not None:
                    finish(*wait, now)
                wait = None if guest else (doc_id, now)
                if guest:
                    done = bucket
                if len(out) >= 2048:
                    yield flush()
        if out:
            yield flush()

    return dealt.mapInArrow(run, OUT_SCHEMA)


def near_classes(fingerprints: DataFrame, min_likeness: float = 0.8, bands: int = 16, block: int = 1024) -> DataFrame:
    """doc_id and class_id (smallest doc_id reachable) over links between
    fingerprints (doc_id, fingerprint) that share a band of sampled bits and
    whose likeness is ``min_likeness`` or more.

    Equal fingerprints are one; the members of a band bucket are compared in
    blocks of about ``block`` distinct fingerprints, each pair of blocks in a task of its
    own that returns links to connect what matches, not all pairs."""
    import pandas as pd
    from .graph import components

    codes = stored(fingerprints.groupBy("fingerprint").agg(F.min("doc_id").alias("first")).withColumn("node", F.xxhash64("fingerprint")), "edit-codes")
    width = BITS // 4 // bands
    if width * bands * 4 != BITS:
        raise ValueError("bands must divide the fingerprint into whole hex digits")
    idx = codes.select("node", "fingerprint", F.explode(F.array(*[
        F.struct(F.lit(i).alias("band"), F.substring("fingerprint", 1 + i * width, width).alias("value")) for i in range(bands)])).alias("k"))
    idx = idx.select("k.band", "k.value", "node", "fingerprint")
    size = idx.groupBy("band", "value").agg(F.count("*").alias("n")).where("n > 1")
    idx = idx.join(size, ["band", "value"]).withColumn("blocks", F.ceil(F.col("n") / F.lit(block)).cast("int"))
    idx = idx.withColumn("own", F.pmod(F.col("node"), F.col("blocks")).cast("int"))
    pairs = idx.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "band", "value", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "node", "fingerprint")
    limit = (1 - min_likeness) / 2 * BITS

    def link(pdf: pd.DataFrame) -> pd.DataFrame:
        bits = np.stack([np.frombuffer(bytes.fromhex(f), np.uint8) for f in pdf["fingerprint"]])
        node = pdf["node"].to_numpy()
        free, u, v = np.ones(len(node), bool), [], []
        todo = list(range(len(node)))
        while todo:                                      # breadth first: each node is linked once
            q = [todo.pop()]
            if not free[q[0]]:
                continue
            free[q[0]] = False
            while q:
                i = q.pop()
                near = np.flatnonzero(free & (np.bitwise_count(bits ^ bits[i]).sum(axis=1) <= limit))
                free[near] = False
                u += [node[i]] * len(near)
                v += node[near].tolist()
                q += near.tolist()
        return pd.DataFrame({"u": np.array(u, np.int64), "v": np.array(v, np.int64)})

    edges = pairs.groupBy("band", "value", "a", "b").applyInPandas(link, "u long, v long")
    comp = components(edges)
    rooted = codes.join(comp, "node", "left").select("fingerprint", "first", F.coalesce("root", "node").alias("root"))
    low = rooted.groupBy("root").agg(F.min("first").alias("class_id"))
    named = rooted.join(low, "root").select("fingerprint", "class_id")
    return fingerprints.join(named, "fingerprint").select("doc_id", "class_id")
