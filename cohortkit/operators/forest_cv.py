"""Cross-validated trees of many parameter maps at once, over packed rows (M2).

Spark ML's ``CrossValidator`` fits each map in each fold by itself, a pass a level.  Here all
trees of a search advance together: a level of all of them is one pass.  Trees of a fold
and weight column whose splits agree so far share the rows they have reached (a path), and a
pass counts the rows of each path by (feature, bin, kind of row) once, whichever trees ask.
The trees are those of a one-tree ``RandomForestClassifier`` without bootstrap: the same
candidate splits, features drawn a node, splits and predictions.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from typing import Iterator, Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .packed import EPSILON, Candidates, Split, best_splits, bins_of, candidates, doubles, pack, settle, widened
from .tree import _branches

CELLS = 1 << 20         # counts of one pass that reach the driver from each task
CHUNK = 1 << 18         # rows that go down the paths at once
COLLECT = 64            # partitions whose counts the driver adds itself
KINDS = 16              # different (label, weights) of rows
ADDED = 1_000_000       # rows of a kind up to which a weight is added row by row, as Spark ML does
GROUP_BYTES = 256 << 20  # Spark ML's maxMemoryInMB: what the nodes taken from a tree's stack at once may hold


@dataclass(frozen=True)
class Params:
    """One tree's parameters, as ``RandomForestClassifier`` names them."""
    max_depth: int
    min_leaf: int
    min_info_gain: float
    impurity: str
    weight_col: str
    max_features: str

    def n_features(self, total: int) -> int:
        if self.max_features == "all":
            return total
        return math.ceil(math.sqrt(total)) if self.max_features == "sqrt" else max(1, math.ceil(math.log(total) / math.log(2)))


class _Seeds:
    """``nextLong`` of a java.util.Random."""

    def __init__(self, seed: int):
        self.state = (seed ^ 0x5DEECE66D) & (1 << 48) - 1

    def _int(self) -> int:
        self.state = (self.state * 0x5DEECE66D + 11) & (1 << 48) - 1
        x = self.state >> 16
        return x - (1 << 32) if x >> 31 else x

    def long(self) -> int:
        x = ((self._int() << 32) + self._int()) & (1 << 64) - 1
        return x - (1 << 64) if x >> 63 else x


def drawn_features(n: int, k: int, seed: int) -> list[int]:
    """``k`` of ``n`` features by Spark's reservoir."""
    out, draw = list(range(k)), doubles(seed)
    for i in range(k, n):
        at = int(next(draw) * (i + 1))
        if at < k:
            out[at] = i
    return out


@dataclass
class _Tree:
    """A growing tree: its stack of (node, path, depth, sums its parent gave it)."""
    params: Params
    group: int
    seeds: _Seeds
    stack: list
    taken: list = field(default_factory=list)

    def take(self, nf: int, bins: Sequence[int]) -> None:
        """Move what one of Spark ML's groups holds from the stack, with the features drawn."""
        self.taken, used, k = [], 0, self.params.n_features(nf)
        while self.stack:
            features = drawn_features(nf, k, self.seeds.long()) if k < nf else list(range(nf))
            size = 16 * sum(bins[f] for f in features)
            if used and used + size > GROUP_BYTES:
                break
            self.taken.append((*self.stack.pop(), features))
            used += size


def _kinds(df: DataFrame, label: str, fold: str, weights: list[str], folds: int):
    """(kinds, counts, weight sums): the different (label, *weights), the rows of each
    (fold, kind); None where the rows are not what this search is for."""
    cols = [F.col(label).cast("double").alias("y"), *[F.col(w).cast("double").alias(f"w{i}") for i, w in enumerate(weights)]]
    found = df.groupBy(F.col(fold).alias("f"), *cols).agg(F.count(F.lit(1)).alias("n")).limit(KINDS * folds + 1).collect()
    if any(r["f"] is None or not 0 <= r["f"] < folds for r in found):
        raise ValueError(f"fold numbers must be in [0, {folds})")
    kinds = sorted({tuple(r[1:-1]) for r in found}, key=str)
    if len(found) > KINDS * folds or len(kinds) > KINDS or any(v is None or not math.isfinite(v) or v < 0 for k in kinds for v in k):
        return None
    n = np.zeros((folds, len(kinds)), dtype=np.int64)
    for r in found:
        n[r["f"], kinds.index(tuple(r[1:-1]))] += r["n"]
    ones = np.array([k[0] == 1 for k in kinds])
    held, train = n[:, ones].sum(axis=1), n.sum(axis=0) - n
    if any(k[0] not in (0, 1) for k in kinds) or not (held > 0).all() or not (train[:, ones].sum(axis=1) > 0).all():
        return None
    return kinds, n


def _weighed(weight: float, most: int):
    """Sums of a weight over 0, 1, ... rows, as adding it row by row gives them."""
    if weight == 1.0:
        return lambda n: n.astype(np.float64)
    sums = np.concatenate([[0.0], np.cumsum(np.full(min(most, ADDED), weight))])
    return lambda n: np.where(n < len(sums), sums[np.minimum(n, len(sums) - 1)], n * weight)


def _chunks(blocks: Iterator[tuple], nc: int) -> Iterator[tuple]:
    """(bins, kind, fold) of many blocks at once."""
    parts, size = [], 0
    for block in blocks:
        parts.append((bins_of(block, nc), widened(block[3]).astype(np.int16), widened(block[4]).astype(np.int16)))
        size += parts[-1][0].shape[1]
        if size >= CHUNK:
            yield tuple(np.concatenate([p[i] for p in parts], axis=-1) for i in range(3))
            parts, size = [], 0
    if size:
        yield tuple(np.concatenate([p[i] for p in parts], axis=-1) for i in range(3))


def _down(branches: dict, bins: np.ndarray, columns: list, roots: dict, wanted: dict) -> Iterator[tuple[int, np.ndarray]]:
    """(path, its row numbers) of the ``wanted`` paths that hold rows; ``roots``: the rows of
    each group's first path; ``columns`` names a group's column of each feature."""
    todo = [(path, path, rows) for path, rows in roots.items()]
    while todo:
        group, path, rows = todo.pop()
        if len(rows) == 0:
            continue
        if path in wanted:
            yield path, rows
        for f, left, low, high in branches.get(path, ()):
            go = np.frombuffer(left, dtype=bool)[bins[columns[group][f]][rows]]
            if low >= 0:
                todo.append((group, low, rows[go]))
            if high >= 0:
                todo.append((group, high, rows[~go]))


def _summed(data, task) -> np.ndarray:
    parts = data.mapPartitions(task)
    return parts.treeReduce(np.add) if data.getNumPartitions() > COLLECT else sum(parts.collect())


def _counts(data, branches: dict, columns: list, nc: int, folds: list, wanted: dict, width: int, k: int) -> np.ndarray:
    """Counts (place, bin, kind) of the training rows; ``wanted``: path -> (first place, columns asked for)."""
    size = sum(len(c) for _, c in wanted.values())

    def count(blocks):
        settle()
        out = np.zeros((size, width * k), dtype=np.int64)
        for bins, kind, fold in _chunks(blocks, nc):
            cells = bins.astype(np.int16) * np.int16(k) + kind
            roots = {g: np.flatnonzero(fold != f) for g, f in enumerate(folds) if g in branches or g in wanted}
            for path, rows in _down(branches, bins, columns, roots, wanted):
                first, asked = wanted[path]
                for i, c in enumerate(asked):
                    out[first + i] += np.bincount(cells[c][rows], minlength=width * k)
        yield out
    return _summed(data, count).reshape(size, width, k)


def _ends(data, branches: dict, columns: list, nc: int, folds: list, wanted: dict, k: int) -> np.ndarray:
    """Counts (place, kind) of the rows held out; ``wanted``: path -> place."""
    def count(blocks):
        settle()
        out = np.zeros((len(wanted), k), dtype=np.int64)
        for bins, kind, fold in _chunks(blocks, nc):
            roots = {g: np.flatnonzero(fold == f) for g, f in enumerate(folds)}
            for path, rows in _down(branches, bins, columns, roots, wanted):
                out[wanted[path]] += np.bincount(kind[rows], minlength=k)
        yield out
    return _summed(data, count)


class _Pricing:
    """Splits of a group's nodes from counts of kinds."""

    def __init__(self, cuts: Candidates, kinds: list, weight: int, most: int):
        self.cuts, self.weigh = cuts, [_weighed(k[1 + weight], most) for k in kinds]
        self.label = [int(k[0]) for k in kinds]

    def splits(self, counts: np.ndarray, features: list, parents: np.ndarray | None, p: Params) -> list[Split]:
        """``counts`` (node, slot, bin, kind)."""
        h = np.zeros((*counts.shape[:3], 2))
        for i, (y, weigh) in enumerate(zip(self.label, self.weigh)):
            h[..., y] += weigh(counts[..., i])
        return best_splits(h, counts.sum(axis=-1), np.array(features), parents, p.impurity, self.cuts, p.min_leaf, p.min_info_gain)


def _class(stats: np.ndarray) -> int:
    total = stats.sum()
    return int(np.argmax(stats / total)) if total else 0


def cross_validated_f1(df: DataFrame, features: str, label: str, fold_col: str, params: Sequence[Params], folds: int, seed: int,
                       max_bins: int = 32) -> np.ndarray | None:
    """(folds, params) F1 of class 1 on each held-out fold.  None where labels are other than
    0 and 1 (class 1 in every fold) or rows have more than ``KINDS`` different weights."""
    weights = sorted({p.weight_col for p in params})
    got = _kinds(df, label, fold_col, weights, folds)
    if got is None:
        return None
    kinds, n = got
    k, train = len(kinds), n.sum(axis=0) - n
    groups = [(f, w) for f in range(folds) for w in range(len(weights))]
    cuts: list[Candidates] = []
    for f in range(folds):
        total = {c: float(sum(m * kind[1 + w] for m, kind in zip(train[f], kinds))) for w, c in enumerate(weights)}
        cuts += candidates(df.where(F.col(fold_col) != f), features, seed, int(train[f].sum()), total, max_bins)
    nf, width = len(cuts[0].arity), max(c.width for c in cuts)
    sources: dict[tuple, int] = {}                   # (feature, its thresholds) -> column: most folds agree on most features
    columns = [[sources.setdefault((f, t.tobytes()), len(sources)) for f, t in enumerate(c.thresholds)] for c in cuts]
    feature_of = [f for f, _ in sources]
    every = Candidates([np.frombuffer(t) for _, t in sources], [cuts[0].arity[f] for f in feature_of])
    cols = [F.col(label).cast("double"), *[F.col(w).cast("double") for w in weights]]
    kind = F.lit(None)
    for i, values in enumerate(kinds):
        same = F.lit(True)
        for c, v in zip(cols, values):
            same = same & (c == F.lit(v))
        kind = F.when(same, F.lit(i)).otherwise(kind)
    nc = len(feature_of)
    data = pack(df.withColumn("__kind", kind).withColumn("__fold", F.col(fold_col)), features, nf, lambda x: every.bins(x[:, feature_of]),
                ["__kind", "__fold"], int(n.sum()))
    pricing = [_Pricing(c, kinds, w, int(train[f].max())) for c, (f, w) in zip(cuts, groups)]
    of_fold = [f for f, _ in groups]
    up: dict = {g: None for g in range(len(groups))}  # path -> (path above, its split, side); the first are the groups
    kids: dict[int, dict] = {}
    trees = [_Tree(p, f * len(weights) + weights.index(p.weight_col), _Seeds(seed), []) for f in range(folds) for p in params]
    ends: dict[int, list] = {}                       # path -> trees that end there and their class
    for t in trees:
        t.stack.append((t.group, 0, None))
    while any(t.stack for t in trees):
        asked: dict[int, set] = {}
        for t in trees:
            t.take(nf, [s + 1 for s in cuts[t.group].splits])
            for path, _, _, feats in t.taken:
                asked.setdefault(path, set()).update(columns[t.group][f] for f in feats)
        found = {}                                   # (tree, place in taken) -> split
        users: dict[int, list] = {}
        for i, t in enumerate(trees):
            for j, (path, *_) in enumerate(t.taken):
                users.setdefault(path, []).append((i, j))
        for part in _parts(asked, width * k):
            h = _counts(data, _branches(kids, up, set(part)), columns, nc, of_fold, part, width, k)
            mine: dict[int, list] = {}
            for path in part:
                for i, j in users[path]:
                    mine.setdefault(i, []).append(j)
            for i, some in mine.items():
                found |= _priced(trees[i], i, sorted(some), h, part, columns, pricing)
        for i, t in enumerate(trees):
            for j, (path, depth, parent, _) in enumerate(t.taken):
                s = found[i, j]
                if s.gain is None or depth == t.params.max_depth:
                    ends.setdefault(path, []).append((i, _class(s.total)))
                    continue
                key = (s.feature, s.left.tobytes())
                if key not in kids.setdefault(path, {}):
                    kids[path][key] = pair = (len(up), len(up) + 1)
                    up |= {p: (path, key, side) for side, p in enumerate(pair)}
                for kid, stats, impurity in zip(kids[path][key], s.stats, s.impurity):
                    if depth + 1 < t.params.max_depth and abs(impurity) >= EPSILON:
                        t.stack.append((kid, depth + 1, stats))
                    else:
                        ends.setdefault(kid, []).append((i, _class(stats)))
    places = {path: i for i, path in enumerate(ends)}
    held = _ends(data, _branches(kids, up, set(ends)), columns, nc, of_fold, places, k)
    data.unpersist()
    ones = np.array([kind[0] == 1 for kind in kinds])
    right, wrong, missed = (np.zeros(len(trees)) for _ in range(3))
    for path, some in ends.items():
        yes = int(held[places[path], ones].sum())
        no = int(held[places[path]].sum()) - yes
        for i, c in some:
            if c == 1:
                right[i] += yes
                wrong[i] += no
            else:
                missed[i] += yes
    out = np.zeros(len(trees))
    for i, (tp, fp, fn) in enumerate(zip(right, wrong, missed)):
        precision, recall = tp / (tp + fp) if tp + fp else 0.0, tp / (tp + fn)
        out[i] = 2.0 * precision * recall / (precision + recall) if precision + recall else 0.0
    return out.reshape(folds, len(params))


def _parts(asked: dict[int, set], cells: int) -> Iterator[dict]:
    """The paths of a level a pass at a time: path -> (first place, columns)."""
    part, size = {}, 0
    for path, cols in asked.items():
        if part and (size + len(cols)) * cells > CELLS:
            yield part
            part, size = {}, 0
        part[path] = (size, sorted(cols))
        size += len(cols)
    if part:
        yield part


def _priced(t: _Tree, i: int, some: list, h: np.ndarray, part: dict, columns: list, pricing: list) -> dict:
    """The splits of the nodes ``some`` of a tree."""
    at = []
    for j in some:
        path, _, _, feats = t.taken[j]
        first, cols = part[path]
        at.append([first + cols.index(columns[t.group][f]) for f in feats])
    parents = None if t.taken[some[0]][2] is None else np.array([t.taken[j][2] for j in some])
    return {(i, j): s for j, s in zip(some, pricing[t.group].splits(h[np.array(at)], [t.taken[j][3] for j in some], parents, t.params))}
