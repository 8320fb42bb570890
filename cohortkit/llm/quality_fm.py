"""Quality classifier: a factorisation machine over hashed words, structure
statistics and metadata.

A document is a sparse vector: its words hashed into buckets (weights from
term counts, unit length), one-hot bins of structure statistics of the text,
and one-hot bins of metadata columns.  The score is the logistic of

    w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j

whose second-order part is taken in linear time as half of
sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textnum as tn
from .common import held_out, small_batches, sub_batches

WORD_BITS = 15
STATS = 12          # structure statistics
BINS = 16           # bins of each statistic and of each metadata column
_KIND = np.zeros(256, np.uint8)   # byte classes, one bit each
_KIND[65:91] |= 1                                     # A-Z
_KIND[97:123] |= 2                                    # a-z
_KIND[48:58] |= 4                                     # digits
_KIND[[33, 63]] |= 8                                  # ! ?
_KIND[[35, 36, 37, 38, 42, 43, 47, 60, 61, 62, 64, 91, 92, 93, 94, 95, 96, 123, 124, 125, 126]] |= 16  # symbols
_KIND[[34, 39, 40, 41, 44, 45, 46, 58, 59]] |= 32     # , . ; : and the like
_KIND[128:] |= 64                                     # bytes of other characters
_KIND[10] |= 128                                      # line feed


@dataclass
class FactorisationMachine:
    """Weights of a fitted machine.  ``w`` has one weight a feature, ``v``
    one row of factors a feature."""
    w0: float
    w: np.ndarray
    v: np.ndarray
    metadata: int

    def scores(self, indptr: np.ndarray, idx: np.ndarray, val: np.ndarray) -> np.ndarray:
        """Probabilities of label 1 for documents in CSR form (each has one
        feature at least)."""
        if not len(indptr) - 1:
            return np.zeros(0)
        xv = self.v[idx] * val[:, None]
        s = np.add.reduceat(xv, indptr[:-1])
        y = self.w0 + np.add.reduceat(self.w[idx] * val, indptr[:-1])
        y = y + 0.5 * (s ** 2 - np.add.reduceat(xv ** 2, indptr[:-1])).sum(axis=1)
        return 1.0 / (1.0 + np.exp(-np.clip(y, -30, 30)))


def feature_count(metadata: int) -> int:
    return (1 << WORD_BITS) + (STATS + metadata) * BINS


def _bin(x: np.ndarray) -> np.ndarray:
    return np.clip(x, 0, BINS - 1).astype(np.int64)


def features(texts: Sequence[str | None], metadata: Sequence[np.ndarray] = ()) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """CSR arrays (indptr, feature, value) of whole texts.  A null text
    counts as empty; a null in a metadata column has a bin of its own."""
    raw = [(t or "").encode("utf-8", "replace") for t in texts]
    parts = [_features(raw[a:b], [m[a:b] for m in metadata]) for a, b in sub_batches(raw)]
    if not parts:
        return np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32)
    ptr = np.concatenate([[0]] + [p[0][1:] + o for p, o in zip(parts, np.cumsum([0] + [len(p[1]) for p in parts]))])
    return ptr, np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts])


def _features(raw: list[bytes], metadata: list[np.ndarray]):
    n = len(raw)
    buf, at = tn.join_texts(raw)
    lo, hi = at[:-1], at[1:] - 1
    size = np.maximum(hi - lo, 1).astype(float)
    kind = _KIND[buf]
    share = []
    for b in (1, 2, 4, 8, 16, 32, 64, 128):
        c = np.zeros(len(buf) + 1, np.int64)
        np.cumsum((kind & b) > 0, out=c[1:])
        share.append((c[hi] - c[lo]) / size)
    upper, lower, digit, shout, symbol, stop, other, feed = share
    starts, ends = tn.token_spans(buf)
    folded = np.where(kind & 1, buf + 32, buf).astype(np.uint8)   # A-Z only
    h = tn.token_hashes(folded, starts, ends)
    doc = np.searchsorted(at, starts, "right") - 1
    words = np.bincount(doc, minlength=n)
    bucket = (h >> np.uint64(64 - WORD_BITS)).astype(np.int64)
    key, count = np.unique((doc << WORD_BITS) | bucket, return_counts=True)
    kdoc = key >> WORD_BITS
    tf = np.log1p(count)
    norm = np.sqrt(np.bincount(kdoc, tf ** 2, minlength=n))
    distinct = np.bincount(kdoc, minlength=n)
    most = np.zeros(n)
    np.maximum.at(most, kdoc, count)
    same = np.zeros(n)
    if len(h) > 1:
        again = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
        same = np.bincount(doc[1:], again, minlength=n)
    some = np.maximum(words, 1)
    mean_word = np.bincount(doc, ends - starts, minlength=n) / some
    letters = np.maximum(upper + lower, 1e-9)
    stats = [upper / letters * 15.99, digit * 60, np.sqrt(shout) * 30, np.sqrt(symbol) * 30, np.sqrt(stop) * 40,
             other * 40, np.sqrt(feed) * 60, mean_word * 1.5, distinct / some * 15.99, same / some * 15.99,
             np.sqrt(most / some) * 15.99, np.log2(words + 1.0)]
    scale = 1.0 / np.sqrt(STATS + len(metadata))
    cols = [(1 << WORD_BITS) + i * BINS + _bin(s) for i, s in enumerate(stats)]
    for j, m in enumerate(metadata):
        m = np.asarray(m, float)
        b = np.where(np.isfinite(m), 1 + _bin(np.minimum(np.log2(np.maximum(np.nan_to_num(m), 0) + 1) * 0.75, BINS - 2)), 0)
        cols.append((1 << WORD_BITS) + (STATS + j) * BINS + b.astype(np.int64))
    extra = np.stack(cols, axis=1)
    width = extra.shape[1]
    ptr = np.zeros(n + 1, np.int64)
    np.cumsum(distinct + width, out=ptr[1:])
    idx, val = np.empty(ptr[-1], np.int64), np.empty(ptr[-1], np.float32)
    slot = (ptr[:-1, None] + np.arange(width)).ravel()
    idx[slot], val[slot] = extra.ravel(), scale
    rest = np.ones(ptr[-1], bool)
    rest[slot] = False
    idx[rest] = key & ((1 << WORD_BITS) - 1)
    val[rest] = tf / norm[kdoc]
    return ptr, idx, val


def fit_arrays(indptr, idx, val, labels, metadata: int, factors: int = 8, steps: int = 600, batch: int = 128,
               rate: float = 0.05, decay: float = 1e-5, seed: int = 7) -> FactorisationMachine:
    """Logistic loss by AdaGrad on about ``steps`` mini-batches; the order
    is seeded."""
    rng = np.random.default_rng(seed)
    d = feature_count(metadata)
    w, v = np.zeros(d), rng.normal(0, 0.05, (d, factors))
    gw, gv = np.full(d, 1e-6), np.full((d, factors), 1e-6)
    w0, g0 = 0.0, 1e-6
    labels = np.asarray(labels, float)
    n = len(labels)
    for _ in range(-(-steps * batch // n)):
        for at in range(0, n, batch):
            if at == 0:
                order = rng.permutation(n)
            rows = order[at:at + batch]
            length = indptr[rows + 1] - indptr[rows]
            ptr = np.concatenate([[0], np.cumsum(length)])
            take = np.repeat(indptr[rows] - ptr[:-1], length) + np.arange(ptr[-1])
            i, x = idx[take], val[take].astype(float)
            r = np.repeat(np.arange(len(rows)), length)
            xv = v[i] * x[:, None]
            s = np.add.reduceat(xv, ptr[:-1])
            y = w0 + np.add.reduceat(w[i] * x, ptr[:-1]) + 0.5 * (s ** 2 - np.add.reduceat(xv ** 2, ptr[:-1])).sum(axis=1)
            g = (1 / (1 + np.exp(-np.clip(y, -30, 30))) - labels[rows]) / len(rows)
            used, inv = np.unique(i, return_inverse=True)
            dw = np.bincount(inv, g[r] * x) + decay * w[used]
            each = g[r][:, None] * x[:, None] * (s[r] - xv)
            dv = np.stack([np.bincount(inv, each[:, f]) for f in range(factors)], axis=1) + decay * v[used]
            gw[used] += dw ** 2
            gv[used] += dv ** 2
            g0 += g.sum() ** 2
            w[used] -= rate * dw / np.sqrt(gw[used])
            v[used] -= rate * dv / np.sqrt(gv[used])
            w0 -= rate * g.sum() / np.sqrt(g0)
    return FactorisationMachine(float(w0), w.astype(np.float32), v.astype(np.float32), metadata)


def fit(docs: DataFrame, labels: DataFrame, metadata_cols: Sequence[str] = ("n_chars",), max_rows: int = 8000,
        id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        fold: tuple[int, int] = (5, 0), **options) -> FactorisationMachine | None:
    """Fit on at most ``max_rows`` labelled documents outside the fold
    ``crc32(id) mod fold[0] = fold[1]``, taken in the order of a hash of the
    id.  Labels that are null or contradict each other are left out.  None
    if there is no label of either kind."""
    lab = (labels.select(F.col(id_col).cast("long").alias("__id"), F.col(label_col).cast("int").alias("__y"))
           .where("__id is not null and __y in (0, 1)").where(~held_out("__id", *fold))
           .groupBy("__id").agg(F.min("__y").alias("__y"), F.max("__y").alias("__z")).where("__y = __z").drop("__z")
           .orderBy(F.xxhash64("__id"), "__id").limit(max_rows))
    meta = [F.col(c).cast("double").alias(f"__m{i}") for i, c in enumerate(metadata_cols)]
    use = (docs.select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).cast("string").alias("__t"), *meta)
           .join(F.broadcast(lab), "__id"))  # max_rows rows at most
    m = len(meta)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            ptr, idx, val = features(b["__t"].tolist(), [b[f"__m{j}"].to_numpy(float) for j in range(m)])
            yield pd.DataFrame({"id": b["__id"], "y": b["__y"], "idx": [idx[a:z].astype(np.int32).tobytes() for a, z in zip(ptr, ptr[1:])],
                                "val": [val[a:z].tobytes() for a, z in zip(ptr, ptr[1:])]})

    rows = use.mapInPandas(run, "id long, y int, idx binary, val binary").collect()  # sparse rows of the bounded sample
    rows.sort(key=lambda r: (r["id"], r["idx"], r["val"]))
    y = [r["y"] for r in rows]
    if len(set(y)) < 2:
        return None
    idx = [np.frombuffer(r["idx"], np.int32) for r in rows]
    ptr = np.concatenate([[0], np.cumsum([len(i) for i in idx])])
    return fit_arrays(ptr, np.concatenate(idx).astype(np.int64), np.concatenate([np.frombuffer(r["val"], np.float32) for r in rows]),
                      y, m, **options)


def score(docs: DataFrame, model: FactorisationMachine | None, out: str, metadata_cols: Sequence[str] = ("n_chars",),
          text_col: str = "text") -> DataFrame:
    """``docs`` with a double column ``out`` between 0 and 1 for every row,
    empty and null texts too.  Without a model every row has 0.5."""
    small_batches(docs.sparkSession)
    if model is None:
        return docs.withColumn(out, F.lit(0.5))
    if len(metadata_cols) != model.metadata:
        raise ValueError("metadata_cols must be those of the fit")
    sent = docs.sparkSession.sparkContext.broadcast(model)  # fixed size: feature_count x (factors + 1) floats

    @F.pandas_udf("double")
    def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        fm = sent.value
        for cols in batches:
            texts, meta = cols[0].tolist(), [c.to_numpy(float) for c in cols[1:]]
            got = [np.zeros(0)]
            for a in range(0, len(texts), 512):
                got.append(fm.scores(*features(texts[a:a + 512], [m[a:a + 512] for m in meta])))
            yield pd.Series(np.concatenate(got))

    return docs.withColumn(out, run(F.col(text_col).cast("string"), *[F.col(c).cast("double") for c in metadata_cols]))
