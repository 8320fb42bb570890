"""Gradient-boosted regression trees over packed rows (M4).

The boosting of Spark ML's ``GBTRegressor`` (squared error): the same candidate splits, row
draws, splits and leaf values.  A level of a tree is one pass over the packed rows; a task
adds weights, sums and squares by (node, feature, bin) with numpy and the driver adds the
tasks' sums, whose size the rows do not change.  What the trees so far predict is kept
beside the rows, moved on once a tree and written to the checkpoint folder at times.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .packed import EPSILON, KEPT, Candidates, Tree, below, best_splits, bins_of, candidates, descend, pack, settle, widened

COLLECT = 64        # partitions whose sums the driver adds itself; more are added in tasks first


def _drawn(seed: int, rate: float, block: tuple, n: int) -> bytes:
    """Which rows of a block a tree with this seed learns from (Spark ML's draws), in bits."""
    return np.packbits(below(seed + block[0] + 1, block[1], n, rate)).tobytes()


def _started(data, nf: int, seed: int, rate: float):
    """Blocks (partition, first row, bins, label, prediction, drawn) of the first tree."""
    def start(block):
        n = bins_of(block, nf).shape[1]
        return *block, np.zeros(n).tobytes(), _drawn(seed, rate, block, n)
    return data.map(start).persist(KEPT)


def _moved(state, nf: int, tables: tuple, weight: float, seed: int, rate: float):
    """The blocks of the next tree: ``weight`` times what the grown tree predicts is added."""
    def move(block):
        bins, reached = bins_of(block, nf), tables[2] * weight
        prediction = np.frombuffer(block[4]) + reached[descend(tables, bins)]
        return *block[:4], prediction.tobytes(), _drawn(seed, rate, block, bins.shape[1])
    return state.map(move).persist(KEPT)


def _level(state, nf: int, tables: tuple, level: int, places: np.ndarray, n: int, first: bool) -> np.ndarray:
    """(node, feature, bin, 3) sums of the drawn rows in the ``n`` nodes that ``places`` numbers."""
    width = tables[1].shape[1]
    size = (n + 1) * width

    def sums(blocks):
        settle()
        out = np.zeros((nf, 3, size))
        for block in blocks:
            bins, target = bins_of(block, nf), widened(block[3])
            if not first:
                target = 2.0 * (target - np.frombuffer(block[4]))
            square = target * target
            drawn = np.unpackbits(np.frombuffer(block[5], dtype=np.uint8), count=len(target)).astype(bool)
            base = np.where(drawn, places[descend(tables, bins, level)], n) * width
            cell = np.empty_like(base)
            for f in range(nf):
                np.add(base, bins[f], out=cell)
                out[f, 0] += np.bincount(cell, minlength=size)
                out[f, 1] += np.bincount(cell, target, size)
                out[f, 2] += np.bincount(cell, square, size)
        yield out.reshape(nf, 3, n + 1, width)[:, :, :n]
    parts = state.mapPartitions(sums)
    if state.getNumPartitions() > COLLECT:
        total = parts.treeReduce(np.add)
    else:
        total = sum(parts.collect())
    return np.ascontiguousarray(total.transpose(2, 0, 3, 1))


def _mean(stats: np.ndarray) -> float:
    return float(stats[1] / stats[0]) if stats[0] else 0.0


def _grown(state, cuts: Candidates, est: GBTRegressor, first: bool) -> Tree:
    nf, most = len(cuts.arity), est.getMaxDepth()
    tree = Tree(cuts.width)
    tree.add(0.0)
    open_, parents, level = [0], None, 0
    while open_:
        places = np.full(len(tree.feature), len(open_), dtype=np.intp)
        places[open_] = np.arange(len(open_))
        h = _level(state, nf, tree.tables(), level, places, len(open_), first)
        if max(cuts.splits) == 0 or level == most:
            tree.value[0] = _mean(h[0, 0].sum(axis=0))
            break
        found = best_splits(h, h[..., 0], np.broadcast_to(np.arange(nf), (len(open_), nf)), parents, "variance", cuts,
                            est.getMinInstancesPerNode(), est.getMinInfoGain())
        below = []
        for node, split in zip(open_, found):
            if node == 0:
                tree.value[0] = _mean(split.total)
            if split.gain is None:
                continue
            tree.depth = level + 1
            for kid, stats, impurity in zip(tree.split(node, split.feature, split.left, tuple(_mean(s) for s in split.stats)), split.stats, split.impurity):
                if level + 1 < most and abs(impurity) >= EPSILON:
                    below.append((kid, stats))
        open_, parents, level = [k for k, _ in below], np.array([s for _, s in below]), level + 1
    return tree


def _forget(rdd) -> None:
    """Free a state that nothing will read again, and its checkpoint."""
    path = rdd.getCheckpointFile()
    rdd.unpersist()
    if path:
        sc = rdd.ctx
        folder = sc._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(sc._jsc.hadoopConfiguration()).delete(folder, True)


class BoostedTrees:
    """Fits what its ``GBTRegressor`` describes (squared error, all features a split)."""

    def __init__(self, estimator: GBTRegressor):
        self.estimator = estimator

    def fit(self, df: DataFrame) -> "BoostedModel":
        est = self.estimator
        if est.getLossType() != "squared" or est.getFeatureSubsetStrategy() != "all":
            raise ValueError("squared error and all features a split only")
        ensure_checkpoint_dir(df.sparkSession)
        features, seed, rate = est.getFeaturesCol(), est.getSeed(), est.getSubsamplingRate()
        rows = df.count()
        if rows == 0:
            raise ValueError("no rows to learn from")
        cuts, = candidates(df, features, seed, rows, {None: float(rows)}, est.getMaxBins())
        nf, data = len(cuts.arity), pack(df, features, len(cuts.arity), cuts.bins, [est.getLabelCol()], rows)
        state, trees, before = _started(data, nf, seed, rate), [], [data]
        for m in range(est.getMaxIter()):
            tree = _grown(state, cuts, est, m == 0)
            trees.append((tree.tables(), est.getStepSize() if m else 1.0))
            for old in before:
                _forget(old)
            before = [state]
            if m + 1 < est.getMaxIter():
                state = _moved(state, nf, *[tree.tables(), trees[-1][1]], seed + m + 1, rate)
                if (m + 1) % est.getCheckpointInterval() == 0:
                    state.checkpoint()      # else the way back to the first tree grows without end
        for old in before:
            _forget(old)
        return BoostedModel(trees, cuts, features, est.getPredictionCol())


class BoostedModel:
    """Grown trees with their weights; ``transform`` adds the weighted sum of their predictions."""

    def __init__(self, trees: list, cuts: Candidates, features: str, out: str):
        self.trees, self.cuts, self.features, self.out = trees, cuts, features, out

    def transform(self, df: DataFrame) -> DataFrame:
        trees, cuts = self.trees, self.cuts

        @F.arrow_udf("double")
        def predicted(x: pa.Array) -> pa.Array:
            bins = cuts.bins(x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), len(cuts.arity)))
            total = np.zeros(len(x))
            for tables, weight in trees:
                total += tables[2][descend(tables, bins)] * weight
            return pa.array(total)
        return df.withColumn(self.out, predicted(vector_to_array(self.features)))
