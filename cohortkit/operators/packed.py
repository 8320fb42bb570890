"""Rows packed for Spark ML's tree learners, and the parts of a learner (M2, M4).

Spark ML grows every tree with passes over boxed rows.  Here the rows of a fit are cut
into bins once (a byte a value) and kept as blocks of ``BLOCK`` rows; a pass over them is
some numpy calls a block.  The candidate splits, the draws of rows and features and the
choice among equal splits follow Spark ML's rules, so that the same trees come out.
"""

from __future__ import annotations

import gc
import math
import struct
from dataclasses import dataclass
from functools import lru_cache
from typing import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 1 << 15          # rows of a block: its columns of eight bytes stay in a core's cache
TASK_BLOCKS = 64         # blocks a partition holds at most, where there are enough partitions
SAMPLE = 10_000          # rows Spark ML draws for the candidate splits (more from 100 bins on)
MAX_BINS = 256           # a bin number is one byte

# ---- Spark's generator of random numbers ------------------------------------------------

_ALL = (1 << 64) - 1


def _murmur(data: bytes, seed: int) -> int:
    h = seed & 0xFFFFFFFF
    for (k,) in struct.iter_unpack("<I", data):
        k = k * 0xCC9E2D51 & 0xFFFFFFFF
        k = (k << 15 | k >> 17) & 0xFFFFFFFF
        h ^= k * 0x1B873593 & 0xFFFFFFFF
        h = (h << 13 | h >> 19) & 0xFFFFFFFF
        h = (h * 5 + 0xE6546B64) & 0xFFFFFFFF
    h ^= len(data)
    h = (h ^ h >> 16) * 0x85EBCA6B & 0xFFFFFFFF
    h = (h ^ h >> 13) * 0xC2B2AE35 & 0xFFFFFFFF
    return h ^ h >> 16


def _state(seed: int) -> int:
    """The state a seed (a signed long) starts the generator with."""
    data = struct.pack(">q", seed)
    low = _murmur(data, 0x3C074A61)
    return _murmur(data, low) << 32 | low


def _next(x: int) -> int:
    x ^= x << 21 & _ALL
    x ^= x >> 35
    return x ^ (x << 4 & _ALL)


def first_int(seed: int) -> int:
    """The first ``nextInt`` of the seed."""
    x = _next(_state(seed)) & 0xFFFFFFFF
    return x - (1 << 32) if x >> 31 else x


def doubles(seed: int):
    """The ``nextDouble`` values of the seed, one after another."""
    x = _state(seed)
    while True:
        x = _next(x)
        high = x & (1 << 26) - 1
        x = _next(x)
        yield ((high << 27) + (x & (1 << 27) - 1)) * 2.0 ** -53


@lru_cache(maxsize=64)
def _jump(power: int) -> np.ndarray:
    """2^power steps at once: a step is linear in the bits, so the state after many is
    the XOR of one word for each of the state's eight bytes (8 x 256 words)."""
    if power == 0:
        columns = np.array([_next(1 << i) for i in range(64)], dtype=np.uint64)
    else:
        half = _jump(power - 1)
        columns = _jumped(half, _jumped(half, np.left_shift(np.uint64(1), np.arange(64, dtype=np.uint64))))
    words = np.zeros((8, 256), dtype=np.uint64)
    for bit in range(8):
        on = (np.arange(256) >> bit & 1).astype(bool)
        for byte in range(8):
            words[byte, on] ^= columns[8 * byte + bit]
    return words


def _jumped(words: np.ndarray, x: np.ndarray) -> np.ndarray:
    parts = x.astype("<u8").view(np.uint8).reshape(-1, 8)
    out = words[0][parts[:, 0]]
    for byte in range(1, 8):
        out ^= words[byte][parts[:, byte]]
    return out


def below(seed: int, start: int, n: int, rate: float) -> np.ndarray:
    """Whether the ``nextDouble`` values ``start`` to ``start + n`` of the seed lie below
    ``rate``; two steps each, in lanes of 64 steps that begin where the lane before ends."""
    x = np.array([_state(seed)], dtype=np.uint64)
    for power in range((2 * start).bit_length()):
        if 2 * start >> power & 1:
            x = _jumped(_jump(power), x)
    lanes = -(-2 * n // 64)
    for power in range(max(lanes - 1, 0).bit_length()):
        x = np.concatenate([x, _jumped(_jump(6 + power), x)])
    x = x[:lanes]
    moved, out = np.empty_like(x), np.empty((32, lanes), dtype=bool)
    limit = np.uint64(math.ceil(rate * 2.0 ** 53))     # a double is 53 bits over 2^53

    def step():
        np.left_shift(x, np.uint64(21), out=moved)
        np.bitwise_xor(x, moved, out=x)
        np.right_shift(x, np.uint64(35), out=moved)
        np.bitwise_xor(x, moved, out=x)
        np.left_shift(x, np.uint64(4), out=moved)
        np.bitwise_xor(x, moved, out=x)
    x = np.ascontiguousarray(x)
    for i in range(32):
        step()
        value = (x & np.uint64((1 << 26) - 1)) << np.uint64(27)
        step()
        value += x & np.uint64((1 << 27) - 1)
        np.less(value, limit, out=out[i])
    return out.T.ravel()[:n]


# ---- candidate splits -------------------------------------------------------------------

@dataclass
class Candidates:
    """Per feature the thresholds (continuous) or the number of categories; bin ``b`` of a
    continuous feature lies at or below threshold ``b``, a category is its own bin."""
    thresholds: list[np.ndarray]
    arity: list[int]              # 0: continuous

    @property
    def splits(self) -> list[int]:
        return [a - 1 if a else len(t) for t, a in zip(self.thresholds, self.arity)]

    @property
    def width(self) -> int:
        """Bins of the feature that has most."""
        return max(s + 1 for s in self.splits)

    def bins(self, x: np.ndarray) -> np.ndarray:
        """(features, rows) bins of ``x`` (rows, features).  NaN goes right of every threshold."""
        out = np.empty(x.shape[::-1], dtype=np.uint8)
        for f, (t, a) in enumerate(zip(self.thresholds, self.arity)):
            v = x[:, f]
            if a and not ((v >= 0) & (v < a) & (v == np.floor(v))).all():
                raise ValueError(f"feature {f} has a value that is none of its {a} categories")
            out[f] = v if a else np.searchsorted(t, v)
        return out


def arities(df: DataFrame, features: str) -> list[int]:
    """The categories of each slot of the assembled vector (0: continuous)."""
    meta = df.schema[features].metadata.get("ml_attr", {})
    out = [0] * int(meta["num_attrs"]) if "num_attrs" in meta else []
    for kind, attrs in meta.get("attrs", {}).items():
        for a in attrs:
            out += [0] * (a["idx"] + 1 - len(out))
            if kind == "nominal":
                out[a["idx"]] = int(a.get("num_vals", len(a.get("vals", []))))
            elif kind == "binary":
                out[a["idx"]] = 2
    return out


def thresholds(values: np.ndarray, weights: np.ndarray, expected: float, count: int, n_splits: int) -> np.ndarray:
    """Spark ML's thresholds of one feature: midpoints between neighbouring sampled values,
    nearest to equal shares of the ``expected`` weight.  Zeros count as what is missing of it."""
    seen = values != 0.0
    found, slot = np.unique(values[seen], return_inverse=True)
    if len(found) == 0:
        return np.array([])
    weight = np.bincount(slot, weights=weights[seen], minlength=len(found))
    total = float(weight.sum())
    if expected - total > np.finfo(float).eps * count * 100:
        at = int(np.searchsorted(found, 0.0))
        found, weight = np.insert(found, at, 0.0), np.insert(weight, at, expected - total)
    middle = (found[:-1] + found[1:]) / 2.0
    if len(middle) <= n_splits:
        return middle
    stride = expected / (n_splits + 1)
    out, current, target = [], float(weight[0]), stride
    for i in range(1, len(found)):
        before, current = current, current + float(weight[i])
        if abs(before - target) < abs(current - target):
            out.append(middle[i - 1])
            target += stride
    return np.array(out)


def candidates(df: DataFrame, features: str, seed: int, rows: int, weights: dict[str | None, float], max_bins: int = 32) -> list[Candidates]:
    """Spark ML's candidate splits of ``df`` (``rows`` rows), from a sample of about
    ``SAMPLE`` rows drawn by its RDD sampler; one result a weight column (None: each row
    weighs 1), whose sum over ``df`` is given."""
    arity = arities(df, features)
    most = min(max_bins, rows)
    if most > MAX_BINS:
        raise ValueError(f"at most {MAX_BINS} bins")
    if any(a > most for a in arity):
        raise ValueError(f"a feature has more than the {most} categories that bins allow")
    want = max(most * most, SAMPLE)
    fraction = want / rows if want < rows else 1.0
    d = df.select(vector_to_array(features).alias("x"), *[(F.col(c).cast("double") if c else F.lit(1.0)).alias(f"w{i}") for i, c in enumerate(weights)])
    if fraction < 1:
        spark = df.sparkSession
        d = DataFrame(spark._jsparkSession.createDataFrame(d._jdf.rdd().sample(False, fraction, first_int(seed)), d._jdf.schema()), spark)
    got = d.toArrow()
    x = got.column("x").combine_chunks()
    x = (x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x).flatten().to_numpy(zero_copy_only=False).reshape(len(got), len(arity))
    out = []
    for i, total in enumerate(weights.values()):
        w = got.column(f"w{i}").to_numpy()
        out.append(Candidates([np.array([]) if a else thresholds(x[:, f], w, fraction * total, int((x[:, f] != 0).sum()), most - 1) for f, a in enumerate(arity)], arity))
    return out


# ---- packed rows ------------------------------------------------------------------------

def _checked(x: np.ndarray, numbers: list) -> None:
    if not np.isfinite(x).all() or not all(np.isfinite(v).all() for v in numbers):
        raise ValueError("features, labels and weights must be finite numbers")


KEPT = StorageLevel(True, True, False, True)    # blocks are byte arrays, nothing to serialise


def narrow(v: np.ndarray) -> bytes:
    """Doubles in the shortest type that holds them, its code first."""
    for code in ("b", "f"):
        with np.errstate(invalid="ignore", over="ignore"):
            short = v.astype(code)
        if (short == v).all():
            return code.encode() + short.tobytes()
    return b"d" + v.tobytes()


def widened(data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype=data[:1].decode(), offset=1).astype(np.float64)


_frozen = False


def settle() -> None:
    """Spark's Python workers collect garbage after each task, which takes longer than a
    pass over some blocks; what a worker has imported need not be looked through."""
    global _frozen
    if not _frozen:
        gc.freeze()
        _frozen = True


def pack(df: DataFrame, features: str, n_features: int, binned: Callable, numbers: Sequence[str], rows: int):
    """An RDD of blocks ``(partition, first row, bins, *numbers)``: where the rows lay in
    ``df``, what ``binned`` makes of their features (bytes, a column a row) and the columns ``numbers`` (see ``narrow``), in bytes.
    The blocks are dealt evenly and kept."""
    names = list(numbers)
    d = df.select(vector_to_array(features).alias("x"), *[F.col(c).cast("double").alias(c) for c in names])

    def packed(batches):
        part, start, held, size = TaskContext.get().partitionId(), 0, [], 0

        def block():
            x = np.concatenate([h[0] for h in held])
            columns = [np.concatenate([h[i + 1] for h in held]) for i in range(len(names))]
            return x, columns

        def rows_of(x, columns):
            return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "start": pa.array([start], pa.int64()), "bins": pa.array([binned(x).tobytes()], pa.binary())}
                                              | {c: pa.array([narrow(v)], pa.binary()) for c, v in zip(names, columns)})
        for b in batches:
            x = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, n_features)
            columns = [b.column(i + 1).to_numpy(zero_copy_only=False).astype(np.float64) for i in range(len(names))]
            _checked(x, columns)
            held.append((x, *columns))
            size += b.num_rows
            while size >= BLOCK:
                x, columns = block()
                yield rows_of(x[:BLOCK], [v[:BLOCK] for v in columns])
                held, size, start = [(x[BLOCK:], *[v[BLOCK:] for v in columns])], size - BLOCK, start + BLOCK
        if size:
            yield rows_of(*block())
    blocks = d.mapInArrow(packed, "part int, start long, bins binary" + "".join(f", {c} binary" for c in names))
    n = max(1, -(-rows // BLOCK))
    parts = min(n, max(df.sparkSession.sparkContext.defaultParallelism, -(-n // TASK_BLOCKS)))
    return blocks.repartition(parts).rdd.map(lambda r: (r[0], r[1], *[bytes(v) for v in r[2:]])).persist(KEPT)


def bins_of(block: tuple, nf: int) -> np.ndarray:
    """The (features, rows) bins of a block."""
    return np.frombuffer(block[2], dtype=np.uint8).reshape(nf, -1)


# ---- trees ------------------------------------------------------------------------------

class Tree:
    """A growing tree: per node its split feature and the way of each bin, where a leaf
    leads to itself; ``value`` is what a node predicts."""

    def __init__(self, width: int):
        self.width, self.feature, self.way, self.value, self.depth = width, [], [], [], 0
        self._tables = None

    def add(self, value: float) -> int:
        node = len(self.feature)
        self.feature.append(0)
        self.way.append(np.full(self.width, node, dtype=np.int32))
        self.value.append(value)
        self._tables = None
        return node

    def split(self, node: int, feature: int, left: np.ndarray, values: tuple) -> tuple[int, int]:
        """Children of ``node``; ``left`` tells the bins that go to the first."""
        kids = self.add(values[0]), self.add(values[1])
        self.feature[node], self.way[node] = feature, np.where(left, *kids).astype(np.int32)
        return kids

    def tables(self) -> tuple:
        """(feature, way, value, depth) as arrays, in the smallest integers that hold them."""
        if self._tables is None:
            small = np.uint8 if len(self.feature) <= 256 else np.uint16 if len(self.feature) <= 1 << 16 else np.int32
            self._tables = np.array(self.feature, dtype=np.int32), np.array(self.way, dtype=small), np.array(self.value), self.depth
        return self._tables


def descend(tables: tuple, bins: np.ndarray, levels: int | None = None) -> np.ndarray:
    """The node each row reaches after ``levels`` splits (all of them by default)."""
    feature, way, _, depth = tables
    n, width = bins.shape[1], way.shape[1]
    flat, row, steps = bins.ravel(), np.arange(n), feature.astype(np.intp) * n
    way = way.ravel().astype(np.intp)
    node = np.zeros(n, dtype=np.intp)
    for level in range(depth if levels is None else levels):
        if level == 0:
            b = bins[feature[0]]
        else:
            at = steps.take(node)
            at += row
            b = flat.take(at)
        node *= width
        node += b
        node = way.take(node)
    return node


def impurities(stats: np.ndarray, kind: str) -> np.ndarray:
    """Spark ML's impurity of the sums in the last axis: (weight, sum, sum of squares) for
    'variance', the weights of the classes for 'gini' and 'entropy'; 0 without weight."""
    out = np.zeros(stats.shape[:-1])
    total = stats[..., 0] if kind == "variance" else stats.sum(axis=-1)
    on = total != 0
    if kind == "variance":
        n, s, q = (stats[..., i][on] for i in range(3))
        out[on] = (q - s * s / n) / n
        return out
    value = np.ones(int(on.sum())) if kind == "gini" else np.zeros(int(on.sum()))
    for i in range(stats.shape[-1]):
        share = stats[..., i][on] / total[on]
        value -= share * share if kind == "gini" else share * (np.log(share, out=np.zeros_like(share), where=share > 0) / np.log(2.0))
    out[on] = value
    return out


EPSILON = 2.220446049250313e-16   # an impurity below it ends a branch


@dataclass
class Split:
    """The best split of a node: gain, feature, the bins that go left, the children's sums
    and impurities.  ``gain`` is None where no split is allowed."""
    total: np.ndarray
    gain: float | None = None
    feature: int = -1
    left: np.ndarray | None = None
    stats: tuple = ()
    impurity: tuple = ()


def best_splits(h: np.ndarray, raw: np.ndarray, subset: np.ndarray, parent: np.ndarray | None, kind: str, cuts: Candidates,
                min_rows: int = 1, min_gain: float = 0.0) -> list[Split]:
    """Spark ML's choice for each node of ``h`` (node, slot, bin, sums) and ``raw`` (rows);
    ``subset`` (node, slot) names the feature of a slot, ``parent`` the sums of each node as
    its own parent's split gave them (None: the root).  Categories are ordered by their mean
    (or weight of class 1), empty ones last.  Of equal gains the first slot and bin wins."""
    nodes, slots, width, _ = h.shape
    order = np.broadcast_to(np.arange(width), h.shape[:3]).copy()
    arity, n_splits = np.array(cuts.arity)[subset], np.array(cuts.splits)[subset]
    for i, j in zip(*np.nonzero(arity)):
        a, c = arity[i, j], h[i, j, :arity[i, j]]
        n = c[:, 0] if kind == "variance" else c.sum(axis=1)
        mean = np.full(a, np.finfo(float).max)
        mean[n != 0] = c[n != 0, 1] / n[n != 0] if kind == "variance" else c[n != 0, 1]
        order[i, j, :a] = np.argsort(mean, kind="stable")
    cum, rows = (np.cumsum(np.take_along_axis(v, o, axis=2), axis=2) for v, o in ((h, order[..., None]), (raw, order)))
    right, right_rows = cum[:, :, -1:] - cum, rows[:, :, -1:] - rows
    if parent is None:
        first = int(np.argmax(n_splits[0] > 0))
        parent = (cum[:, first, 0] + right[:, first, 0])
    kinds = [impurities(v, kind) for v in (cum, right)]
    weights = [v[..., 0] if kind == "variance" else v.sum(axis=-1) for v in (cum, right)]
    both = weights[0] + weights[1]
    shares = [np.divide(w, both, out=np.zeros_like(both), where=both != 0) for w in weights]
    gain = impurities(parent, kind)[:, None, None] - shares[0] * kinds[0] - shares[1] * kinds[1]
    ok = (np.arange(width) < n_splits[..., None]) & (rows >= min_rows) & (right_rows >= min_rows) & (gain >= min_gain)
    gain = np.where(ok, gain, -np.inf).reshape(nodes, -1)
    out = []
    for i, at in enumerate(np.argmax(gain, axis=1)):
        j, b = divmod(int(at), width)
        if not gain[i, at] > 0:
            out.append(Split(parent[i]))
            continue
        left = np.zeros(width, dtype=bool)
        left[order[i, j, :b + 1]] = True
        out.append(Split(parent[i], float(gain[i, at]), int(subset[i, j]), left, (cum[i, j, b], right[i, j, b]), (kinds[0][i, j, b], kinds[1][i, j, b])))
    return out
