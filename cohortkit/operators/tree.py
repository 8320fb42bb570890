"""Decision trees grown level by level from class histograms (M1, M2).

Spark ML's tree has no minimum split size, no random splitter and no
impurity decrease weighted by the node's share of the rows.  Here a level of
*all* trees is one scan: trees whose splits agree so far share their nodes, so a
task sends a row once down each distinct path, with numpy, and emits class sums by
(path, fold left out, feature, bin); one shuffle brings a node's sums
together, ordered, and its splits are priced there for each of its trees.  What
reaches the driver is one row a grown node, as in Spark ML.

Rows are cut into bins once and equal binned rows are folded into one row
with a count, so a level's cost is bounded by the distinct binned rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.quantiles import exact_quantiles
from ..session import materialize
from .profile import long_values

MAX_BINS = 255  # a bin number is one byte
MAX_DEPTH = 15  # node numbers and the driver's node table stay below 2^16 a tree


@dataclass(frozen=True)
class TreeSpec:
    """One tree.  ``fold``: the fold left out of its rows (None: all rows).
    ``max_features``: 'sqrt', 'log2' or None (all).  ``min_decrease`` is
    compared with ``N_t/N * (impurity - weighted impurity of the children)``."""
    max_depth: int = 5
    min_split: int = 2
    min_leaf: int = 1
    min_decrease: float = 0.0
    criterion: str = "gini"
    splitter: str = "best"
    max_features: str | None = None
    class_weight: str | None = None
    fold: int | None = None
    seed: int = 42

    def n_features(self, total: int) -> int:
        if self.max_features is None:
            return total
        root = np.sqrt(total) if self.max_features == "sqrt" else np.log2(total)
        return max(1, int(root))


@dataclass
class Binned:
    """Folded rows: ``__b0, __b1, ...`` bin numbers, ``__y`` class index,
    ``__fold``, ``__n`` rows; the cut points of each feature."""
    rows: DataFrame
    cuts: list[list[float]]
    features: list[str]
    classes: list
    sizes: dict = field(default_factory=dict)  # (fold, class index) -> rows


def cut_points(df: DataFrame, features: Sequence[str], bins: int = 32) -> list[list[float]]:
    """Per feature at most ``bins - 1`` cut points: exact order statistics at
    ranks ``i/bins`` (the value at or below), without repeats; the largest
    value is no cut."""
    if not 2 <= bins <= MAX_BINS:
        raise ValueError(f"bins must lie between 2 and {MAX_BINS}")
    lv = long_values(df, list(features), [], as_double=True)
    q = exact_quantiles(lv, "value", [i / bins for i in range(1, bins)], ["variable"], "lower")
    top = lv.where(~F.isnan("value")).groupBy("variable").agg(F.max("value").alias("top"))
    got = q.join(top, "variable").where("quantile < top").groupBy("variable").agg(
        F.sort_array(F.collect_set("quantile")).alias("cuts"))  # at most bins - 1 values a feature
    by = {r["variable"]: [float(x) for x in r["cuts"]] for r in got.collect()}
    return [by.get(f, []) for f in features]


def _bin_of(col: str, cuts: Sequence[float]) -> Column:
    """Number of cuts below the value; null and NaN go to bin 0, the left side of
    every split.  A value on a cut stays at or left of it."""
    points = np.array(cuts, dtype=float)

    @F.pandas_udf("short")
    def below(x: pd.Series) -> pd.Series:
        v = x.to_numpy(dtype=float)
        return pd.Series(np.where(np.isnan(v), 0, np.searchsorted(points, v)).astype(np.int16))
    return below(F.col(col).cast("double"))


def bin_rows(df: DataFrame, features: Sequence[str], label: str, classes: Sequence = (0, 1), fold_col: str | None = None,
             bins: int = 32, cuts: list[list[float]] | None = None) -> Binned:
    """Cut, fold and write the rows.  Rows whose label is not in ``classes``
    (null too) are left out, as they can train nothing."""
    features, classes = list(features), list(classes)
    df = materialize(df.select(*dict.fromkeys([*features, label, *([fold_col] if fold_col else [])])))  # read by every pass for the cuts
    cuts = cut_points(df, features, bins) if cuts is None else cuts
    y = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col(label).cast(df.sparkSession.range(1).select(F.lit(classes[0])).schema[0].dataType)) - 1
    keys = [f"__b{i}" for i in range(len(features))] + ["__y", "__fold"]
    d = df.select(*[_bin_of(f, c).alias(f"__b{i}") for i, (f, c) in enumerate(zip(features, cuts))],
                  y.cast("int").alias("__y"), (F.col(fold_col).cast("int") if fold_col else F.lit(-1)).alias("__fold"))
    rows = materialize(d.where("__y >= 0").groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")))
    sizes = {(r["__fold"], r["__y"]): r["n"] for r in rows.groupBy("__fold", "__y").agg(F.sum("__n").alias("n")).collect()}
    return Binned(rows, cuts, features, classes, sizes)


def _class_weights(binned: Binned, spec: TreeSpec) -> np.ndarray:
    k = len(binned.classes)
    n = np.array([sum(v for (f, y), v in binned.sizes.items() if y == c and (spec.fold is None or f != spec.fold))
                  for c in range(k)], dtype=float)
    if spec.class_weight != "balanced":
        return np.ones(k)
    return np.divide(n.sum(), k * n, out=np.zeros(k), where=n > 0)


HELD_CELLS = 4_000_000  # cells a counting task holds before it sends them on
CHUNK = 1 << 18         # rows that go down the paths at once


def _chunks(batches: Iterator[pd.DataFrame], nf: int, folds: list) -> Iterator[tuple]:
    """(columns of bins, class, number of the row's fold in ``folds`` or their count, rows) of many batches at once."""
    def whole(parts):
        pdf = parts[0] if len(parts) == 1 else pd.concat(parts, ignore_index=True)
        fold, at = pdf["__fold"].to_numpy(), np.full(len(pdf), len(folds), dtype=np.int64)
        for i, f in enumerate(folds):
            at[fold == f] = i
        return [pdf[f"__b{i}"].to_numpy(dtype=np.int64) for i in range(nf)], pdf["__y"].to_numpy(dtype=np.int64), at, pdf["__n"].to_numpy()
    parts, size = [], 0
    for pdf in batches:
        parts.append(pdf)
        size += len(pdf)
        if size >= CHUNK:
            yield whole(parts)
            parts, size = [], 0
    if size:
        yield whole(parts)


def _down(branches: dict, bins: list, wanted: dict) -> Iterator[tuple[int, np.ndarray]]:
    """(path, its row numbers) of the ``wanted`` paths that hold rows.  ``branches``:
    path -> (feature, bin, left path or -1, right path or -1) of each split made there."""
    todo = [(0, np.arange(len(bins[0]) if bins else 0))]
    while todo:
        path, rows = todo.pop()
        if len(rows) == 0:
            continue
        if path in wanted:
            yield path, rows
        for f, b, left, right in branches.get(path, ()):
            over = bins[f][rows] > b
            if left >= 0:
                todo.append((left, rows[~over]))
            if right >= 0:
                todo.append((right, rows[over]))


def _added(cells: np.ndarray, counts: np.ndarray):
    if len(cells) and cells.max() < 8 * len(cells):  # few numbers: count without sorting
        total = np.bincount(cells, weights=counts).astype(np.int64)
        found = np.flatnonzero(total)
        return found, total[found]
    found, slot = np.unique(cells, return_inverse=True)
    total = np.zeros(len(found), dtype=np.int64)
    np.add.at(total, slot, counts)
    return found, total


def _histograms(binned: Binned, branches: dict, shared: list, folds: list) -> DataFrame:
    """(place, seed, node, feature, bin, c0, c1, ...) class counts of every node of
    ``shared`` (path, fold left out, seed, node), the rows of a node in one partition and in order."""
    k, nf = len(binned.classes), len(binned.features)
    width = max((len(c) for c in binned.cuts), default=0) + 1
    span = nf * width * k
    names = ["place", "seed", "node", "feature", "bin", *[f"c{i}" for i in range(k)]]
    wanted: dict[int, list] = {}
    for place, (path, fold, seed, node) in enumerate(shared):
        wanted.setdefault(path, []).append((place, len(folds) + 1 if fold is None else folds.index(fold), seed, node))

    def frame(held: dict) -> pd.DataFrame:
        out = []
        for path, parts in held.items():
            sums = np.zeros((len(folds) + 2, span), dtype=np.int64)  # the last row: no row's fold
            for cells, counts in parts:
                np.add.at(sums.ravel(), cells, counts)
            whole = sums.sum(axis=0)
            for place, fold, seed, node in wanted[path]:
                h = (whole - sums[fold]).reshape(-1, k)
                cell = np.flatnonzero(h.any(axis=1))
                out.append((np.repeat([[place], [seed], [node]], len(cell), axis=1), cell, h[cell]))
        fixed, cell, h = (np.concatenate([o[i] for o in out], axis=a) for i, a in ((0, 1), (1, 0), (2, 0)))
        return pd.DataFrame({"place": fixed[0], "seed": fixed[1], "node": fixed[2], "feature": cell // width, "bin": cell % width}
                            | {f"c{i}": h[:, i] for i in range(k)})[names]

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = {}, 0
        for bins, y, fold, n in _chunks(batches, nf, folds):
            cells = np.stack([fold * span + (f * width + b) * k + y for f, b in enumerate(bins)], axis=1)
            for path, rows in _down(branches, bins, wanted):
                part = _added(cells[rows].ravel(), np.repeat(n[rows], nf))
                held.setdefault(path, []).append(part)
                size += len(part[0])
                if size > HELD_CELLS:
                    yield frame(held)
                    held, size = {}, 0
        if held:
            yield frame(held)

    schema = "place int, seed long, node long, feature int, bin int" + "".join(f", c{i} long" for i in range(k))
    part = binned.rows.mapInPandas(count, schema).repartition("place")
    return part.groupBy("place", "seed", "node", "feature", "bin").agg(*[F.sum(f"c{i}").alias(f"c{i}") for i in range(k)]) \
               .sortWithinPartitions("place", "feature", "bin")


def _impurity(parts: np.ndarray, gini: np.ndarray) -> np.ndarray:
    """Gini where ``gini``, else entropy in bits, of the class weights in each row."""
    total = parts.sum(axis=1)
    share = np.divide(parts, total[:, None], out=np.zeros_like(parts), where=total[:, None] > 0)
    logs = np.log2(share, out=np.zeros_like(share), where=share > 0)
    return np.where(total > 0, np.where(gini, 1.0 - (share * share).sum(axis=1), -(share * logs).sum(axis=1)), 0.0)


def split_nodes(h: pd.DataFrame, specs: dict, weights: dict, totals: dict, n_features: int, depth: int) -> pd.DataFrame:
    """One row a node of whole, ordered nodes ``h``: its class counts and, where a
    split is allowed, the best (feature, bin); -1 where none is.  Equal decreases (to 12
    digits) go to the lower feature, then the lower bin.  Features are drawn among
    those not constant at the node.  A random splitter has one candidate a feature, drawn
    between the node's lowest and highest bin (an empty bin splits as the occupied one below)."""
    k = len(next(iter(weights.values())))
    tree, node, feat, bin_ = (h[c].to_numpy() for c in ("tree", "node", "feature", "bin"))
    c = h[[f"c{i}" for i in range(k)]].to_numpy()
    new_node = np.r_[True, (tree[1:] != tree[:-1]) | (node[1:] != node[:-1])]
    new_feat = new_node | np.r_[True, feat[1:] != feat[:-1]]
    start, fs, ns = np.flatnonzero(new_feat), np.cumsum(new_feat) - 1, np.cumsum(new_node) - 1
    end = np.r_[start[1:], len(h)] - 1
    cum = c.cumsum(axis=0)
    left = cum - (cum[start] - c[start])[fs]
    total = np.add.reduceat(c, start, axis=0)[fs]
    lo, hi = bin_[start], bin_[end]

    def of(value):  # one value a tree, at every row
        ids, at = np.unique(tree, return_inverse=True)
        return np.array([value(t) for t in ids.tolist()])[at]
    w = of(lambda t: weights[t])
    gini = of(lambda t: specs[t].criterion == "gini")
    lw, tw, rw = left * w, total * w, (total - left) * w
    impurity = _impurity(tw, gini)
    decrease = np.round((tw.sum(axis=1) * impurity - lw.sum(axis=1) * _impurity(lw, gini) - rw.sum(axis=1) * _impurity(rw, gini))
                        / of(lambda t: totals[t]), 12)
    order = np.lexsort((feat[start], h["drawn"].to_numpy()[start], lo == hi, ns[start]))
    place = np.empty(len(start), dtype=np.int64)
    place[order] = np.arange(len(start)) - np.searchsorted(ns[start][order], ns[start][order])
    pick = lo + h["pick"].to_numpy()[start] % np.maximum(hi - lo, 1)
    above = np.where(np.arange(len(h)) == end[fs], hi[fs] + 1, np.r_[bin_[1:], 0])
    n, n_left = total.sum(axis=1), left.sum(axis=1)
    chosen = of(lambda t: specs[t].splitter == "best") | ((bin_ <= pick[fs]) & (pick[fs] < above))
    leaf = of(lambda t: specs[t].min_leaf)
    ok = chosen & (bin_ < hi[fs]) & (impurity > 0) & (of(lambda t: specs[t].max_depth) > depth) & (n >= of(lambda t: specs[t].min_split)) \
        & (place[fs] < of(lambda t: specs[t].n_features(n_features))) & (n_left >= leaf) & (n - n_left >= leaf) \
        & (decrease >= of(lambda t: specs[t].min_decrease))
    may = np.flatnonzero(ok)
    may = may[np.lexsort((bin_[may], feat[may], -decrease[may], ns[may]))]
    _, first = np.unique(ns[may], return_index=True)
    best, at = may[first], np.flatnonzero(new_node)
    out = pd.DataFrame({"tree": tree[at], "node": node[at], "n": n[at], "w": tw.sum(axis=1)[at], "impurity": impurity[at],
                        **{f"t{i}": total[at, i] for i in range(k)}, "feature": -1, "bin": -1, "decrease": 0.0})
    out.loc[ns[best], ["feature", "bin"]] = np.c_[feat[best], bin_[best]]
    out.loc[ns[best], "decrease"] = decrease[best]
    return out


PRICED_CELLS = 200_000  # cells whose splits are priced at once


def _of_trees(h: pd.DataFrame, users: list) -> Iterator[pd.DataFrame]:
    """The whole nodes ``h`` once for each of their trees, some nodes at a time."""
    place = h["place"].to_numpy()
    start = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    rows, trees, size = [], [], 0
    for a, b in zip(start, np.r_[start[1:], len(h)]):
        for t in users[place[a]]:
            rows.append(np.arange(a, b))
            trees.append(np.full(b - a, t))
            size += b - a
            if size >= PRICED_CELLS:
                yield h.iloc[np.concatenate(rows)].assign(tree=np.concatenate(trees)).reset_index(drop=True)
                rows, trees, size = [], [], 0
    if size:
        yield h.iloc[np.concatenate(rows)].assign(tree=np.concatenate(trees)).reset_index(drop=True)


def _best_splits(hist: DataFrame, users: list, specs: dict, weights: dict, totals: dict, n_features: int, depth: int) -> DataFrame:
    """``split_nodes`` for all trees (``users``, by place) over the partitions as streams: the last
    node of a batch waits for the next one, so a task holds one batch and one node's cells."""
    k = len(next(iter(weights.values())))
    key = [F.col("seed"), F.col("node"), F.col("feature").cast("long")]
    d = hist.withColumn("drawn", F.xxhash64(*key)).withColumn("pick", F.xxhash64(*key, F.lit(1).cast("long")))

    def priced(pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:
        for part in _of_trees(pdf, users):
            yield split_nodes(part, specs, weights, totals, n_features, depth)

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for pdf in batches:
            pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            if len(pdf) == 0:
                continue
            last = (pdf["place"] == pdf["place"].iloc[-1]).to_numpy()
            rest = pdf[last].reset_index(drop=True)
            if not last.all():
                yield from priced(pdf[~last].reset_index(drop=True))
        if rest is not None:
            yield from priced(rest)
    counts = "".join(f"t{i} long, " for i in range(k))
    return d.mapInPandas(split, f"tree int, node long, n long, w double, impurity double, {counts}feature int, bin int, decrease double")


NODE_SCHEMA = ("tree int, node long, depth int, feature int, name string, bin int, threshold double, left long, right long, "
               "n long, weight double, impurity double, decrease double, counts array<long>, prediction int")


def grow(binned: Binned, specs: Sequence[TreeSpec]) -> "Forest":
    """Grow all trees together; level d costs one scan of the folded rows.
    An empty table gives trees without nodes."""
    for s in specs:
        if s.max_depth > MAX_DEPTH:
            raise ValueError(f"max_depth above {MAX_DEPTH}")
    k = len(binned.classes)
    by = dict(enumerate(specs))
    weights = {t: _class_weights(binned, s) for t, s in by.items()}
    total = {t: float(sum(v * weights[t][y] for (f, y), v in binned.sizes.items() if s.fold is None or f != s.fold)) for t, s in by.items()}
    folds = sorted({s.fold for s in specs if s.fold is not None})
    kids: dict[int, dict] = {}                       # path -> {(feature, bin): (left path, right path)}
    up = {0: None}                                   # path -> (path above, its split, side)
    open_ = {(t, 0): 0 for t in by}                  # (tree, node) of this level -> path
    nodes, ends, depth = [], {}, 0
    while open_:
        users: dict[tuple, list] = {}                # trees that share a node, its fold left out and its seed
        for (t, node), path in open_.items():
            users.setdefault((path, by[t].fold, by[t].seed, node), []).append(t)
        hist = _histograms(binned, _branches(kids, up, {u[0] for u in users}), list(users), folds)
        found = _best_splits(hist, list(users.values()), by, weights, total, len(binned.features), depth).collect()  # one row a node of this level
        below = {}
        for r in found:
            counts = [int(r[f"t{i}"]) for i in range(k)]
            t, f, b, path = r["tree"], r["feature"], r["bin"], open_[r["tree"], r["node"]]
            votes = [c * x for c, x in zip(counts, weights[t])]
            prediction, leaf = int(np.argmax(votes)), (None, None, None, None, None, None)
            if f >= 0:
                if (f, b) not in kids.setdefault(path, {}):
                    kids[path][f, b] = pair = (len(up), len(up) + 1)
                    up |= {p: (path, (f, b), side) for side, p in enumerate(pair)}
                for side, p in enumerate(kids[path][f, b]):
                    below[t, 2 * r["node"] + 1 + side] = p
                leaf = (f, binned.features[f], b, binned.cuts[f][b], 2 * r["node"] + 1, 2 * r["node"] + 2)
            else:
                ends.setdefault(path, []).append((t, prediction))
            nodes.append((t, r["node"], depth, *leaf, r["n"], float(r["w"]), float(r["impurity"]),
                          float(r["decrease"]) if f >= 0 else None, counts, prediction))
        open_, depth = below, depth + 1
    return Forest(binned, by, _branches(kids, up, set(ends)), ends, weights, nodes)


def _branches(kids: dict, up: dict, wanted: set) -> dict[int, list]:
    """The splits on the ways from the root to ``wanted``, as ``_down`` reads them."""
    on = set(wanted)
    for path in wanted:
        while up[path] is not None and up[path][0] not in on:
            path = up[path][0]
            on.add(path)
    return {p: some for p in on if p in kids
            and (some := [(f, b, left if left in on else -1, right if right in on else -1) for (f, b), (left, right) in kids[p].items() if left in on or right in on])}


@dataclass
class Forest:
    """Grown trees: their shared paths for the tasks, the trees that end on each path with
    their predictions there, and the node rows."""
    binned: Binned
    specs: dict
    branches: dict
    ends: dict
    weights: dict
    rows: list

    def nodes(self) -> DataFrame:
        """The node table (``NODE_SCHEMA``); leaves have null splits."""
        return self.binned.rows.sparkSession.createDataFrame(self.rows, NODE_SCHEMA)

    def held_out_counts(self, positive: int = 1) -> dict[int, tuple[int, int, int]]:
        """Per tree (true positives, false positives, false negatives) of class
        index ``positive`` on the fold it left out, all trees in one scan."""
        nf, k, branches = len(self.binned.features), len(self.binned.classes), self.branches
        folds = sorted({s.fold for s in self.specs.values() if s.fold is not None})
        ends = {p: [(t, folds.index(self.specs[t].fold), c == positive) for t, c in some if self.specs[t].fold is not None] for p, some in self.ends.items()}
        trees = list(self.specs)

        def score(batches):
            sums = {}
            for bins, y, fold, n in _chunks(batches, nf, folds):
                for path, rows in _down(branches, bins, ends):
                    part = np.bincount(fold[rows] * k + y[rows], weights=n[rows], minlength=(len(folds) + 1) * k)
                    sums[path] = sums.get(path, 0) + part.astype(np.int64).reshape(-1, k)
            out = {t: [0, 0, 0] for t in trees}
            for path, c in sums.items():
                for t, f, yes in ends[path]:
                    right = int(c[f, positive])
                    out[t][0 if yes else 2] += right
                    out[t][1] += (int(c[f].sum()) - right) * yes
            yield pd.DataFrame([(t, *v) for t, v in out.items()], columns=["tree", "tp", "fp", "fn"])
        got = self.binned.rows.mapInPandas(score, "tree int, tp long, fp long, fn long") \
                  .groupBy("tree").agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn")).collect()
        return {r["tree"]: (r["tp"], r["fp"], r["fn"]) for r in got}


def saved_form(nodes: DataFrame) -> DataFrame:
    """One tree's node table with the columns of a saved Spark tree, as the
    rule operators read them."""
    split = F.struct(F.coalesce("feature", F.lit(-1)).alias("featureIndex"), F.array("threshold").alias("leftCategoriesOrThreshold"),
                     F.lit(-1).alias("numCategories"))
    return nodes.select(F.col("node").alias("id"), F.col("prediction").cast("double").alias("prediction"), "impurity",
                        F.transform("counts", lambda c: c.cast("double")).alias("impurityStats"), F.col("n").alias("rawCount"),
                        F.coalesce("decrease", F.lit(-1.0)).alias("gain"), F.coalesce("left", F.lit(-1)).alias("leftChild"),
                        F.coalesce("right", F.lit(-1)).alias("rightChild"), split.alias("split"))


def predict(df: DataFrame, nodes: DataFrame, max_depth: int = MAX_DEPTH, out: str = "prediction", node_out: str = "leaf") -> DataFrame:
    """Route rows down one tree's node table by its thresholds (null and NaN go
    left).  The splits are one array of at most 2^(max_depth+1) entries, read
    once as a scalar; rows are not shuffled."""
    feats = sorted({r["name"] for r in nodes.where("name is not null").select("name").distinct().collect()})
    table = nodes.agg(F.map_from_entries(F.collect_list(F.struct("node", F.struct("name", "threshold", "prediction")))).alias("m")).scalar()
    x = F.create_map(*[z for f in feats for z in (F.lit(f), F.col(f).cast("double"))]) if feats else F.create_map().cast("map<string,double>")

    def step(at, _):
        here = F.col("__tree")[at]
        v = F.col("__x")[here["name"]]
        return F.when(here["name"].isNull(), at).when(v > here["threshold"], F.when(F.isnan(v), 2 * at + 1).otherwise(2 * at + 2)).otherwise(2 * at + 1)
    d = df.withColumn("__tree", table).withColumn("__x", x)
    d = d.withColumn(node_out, F.aggregate(F.sequence(F.lit(1), F.lit(max_depth)), F.lit(0).cast("long"), step))
    return d.withColumn(out, F.col("__tree")[F.col(node_out)]["prediction"]).drop("__tree", "__x")
