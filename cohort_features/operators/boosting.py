"""Boosted regression trees of many fits at once (M7, M12 under M20, M21).

The fits of a grid search read the same rows, and a fit of ``pyspark.ml`` runs
a job per level of every tree: 15 fits of 30 trees are thousands of jobs, each
over all rows. Here a job takes one level of one round for all fits together,
on rows that were cut into bins once. The trees are ``GBTRegressor``'s:
split candidates from the same sample, variance gain, ties to the first feature
and split, squared error, the step size on every tree but the first.

Rows lie in blocks, one table of bins per fold (split candidates come from a
fold's training rows). A block carries every fit's sum of trees for its rows.
Histograms of a level's nodes are added up by (fit, nodes) on the executors and
only the splits found reach the driver, unless all of them are a few MB.

Above ``ROWS`` rows, rows of one key that no split candidate tells apart are
kept as one with their number, sum and spread of labels: squared error depends
on nothing else. At or below it the rows stay apart, in ``pyspark.ml``'s order
of addition, whose last digits decide between equally good splits.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import RDD, StorageLevel, TaskContext
from pyspark.ml import Estimator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: rows that are cut into bins at once, and row groups that a task takes if there are more than cores
ROWS, TASK_ROWS = 50_000, 200_000
#: nodes whose histograms travel as one, bytes of histograms that the driver adds up, smallest impurity of an inner node
NODES, NEAR, EPSILON = 16, 16 << 20, 2.0**-52
#: the sample that split candidates come from has so many rows, or the square of maxBins
SAMPLE = 10_000


@dataclass
class Tree:
    """Nodes by number: the root is 1, node i's children 2i and 2i + 1. A
    feature of -1 is a leaf, or not split yet."""

    depth: int
    feature: np.ndarray = field(init=False)
    split: np.ndarray = field(init=False)
    value: np.ndarray = field(init=False)

    def __post_init__(self):
        n = 2 << self.depth
        self.feature, self.split, self.value = np.full(n, -1), np.zeros(n, int), np.zeros(n)

    def nodes(self, bins: np.ndarray, steps: int) -> np.ndarray:
        n = bins.shape[1]
        node, row, flat = np.ones(n, np.int64), np.arange(n), bins.ravel()
        for _ in range(steps):
            f = self.feature[node]
            down = f >= 0
            if not down.any():
                break
            node = np.where(down, 2 * node + (flat[np.where(down, f, 0) * n + row] > self.split[node]), node)
        return node

    def predict(self, bins: np.ndarray) -> np.ndarray:
        return self.value[self.nodes(bins, self.depth)]


@dataclass(frozen=True)
class Rules:
    step: float
    max_bins: int
    min_rows: int
    min_gain: float
    seed: int


def rules(est: Estimator, df: DataFrame, label: str) -> Rules | None:
    """What an estimator's trees hang on; None if they are not built here:
    other learners, losses and labels, weights, samples of rows or features,
    stops by a validation set, categorical features."""
    if type(est) is not GBTRegressor or est.getLabelCol() != label:
        return None
    attrs = df.schema[est.getFeaturesCol()].metadata.get("ml_attr", {}).get("attrs", {})
    plain = (
        est.getLossType() == "squared" and est.getSubsamplingRate() == 1.0 and est.getFeatureSubsetStrategy() == "all"
        and est.getMinWeightFractionPerNode() == 0.0 and est.getMaxBins() <= 1 << 15
        and not est.isDefined("weightCol") and not est.isDefined("validationIndicatorCol")
        and not {"nominal", "binary"} & set(attrs)
    )
    if not plain:
        return None
    return Rules(est.getStepSize(), est.getMaxBins(), est.getMinInstancesPerNode(), est.getMinInfoGain(), est.getSeed())


# --------------------------------------------------------------------------
# split candidates and bins
# --------------------------------------------------------------------------


def thresholds(values: np.ndarray, expected: float, n_splits: int) -> np.ndarray:
    """Split candidates of one feature from its values in the sample; zeros
    are what is missing of the ``expected`` number of rows."""
    held = values[values != 0.0]
    if not len(held):
        return np.empty(0)
    found, counts = np.unique(held, return_counts=True)
    counts = counts.astype(float)
    if expected - counts.sum() > EPSILON * len(held) * 100:
        at = int(np.searchsorted(found, 0.0))
        found, counts = np.insert(found, at, 0.0), np.insert(counts, at, expected - len(held))
    middles = (found[:-1] + found[1:]) / 2.0
    if len(middles) <= n_splits:
        return middles
    stride = expected / (n_splits + 1)
    out, target, current = [], stride, counts[0]
    for i in range(1, len(found)):
        before, current = current, current + counts[i]
        if abs(before - target) < abs(current - target):
            out.append(middles[i - 1])
            target += stride
    return np.array(out)


def candidates(rows: DataFrame, features: str, n: int, r: Rules) -> list[np.ndarray]:
    """Split candidates of every feature over ``rows``, ``n`` in number, from
    the sample that ``pyspark.ml`` draws: its rows alone reach the driver."""
    spark = rows.sparkSession
    if n < 1:
        raise ValueError("a fit without training rows")
    share = min(1.0, max(r.max_bins**2, SAMPLE) / n)
    vectors = rows.select(F.col(features).alias("x"))
    if share < 1.0:
        draw = spark._jvm.org.apache.spark.util.random.XORShiftRandom(r.seed).nextInt()
        drawn = vectors._jdf.rdd().sample(False, share, draw)
        vectors = DataFrame(spark._jsparkSession.createDataFrame(drawn, vectors._jdf.schema()), spark)
    x = matrix(vectors.select(vector_to_array("x").alias("x")).toArrow().column("x").combine_chunks())
    return [thresholds(x[:, f], share * n, min(r.max_bins, n) - 1) for f in range(x.shape[1])]


def matrix(column: pa.Array) -> np.ndarray:
    """Lists of one length as rows of a matrix of finite numbers."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = pc.unique(pc.list_value_length(column)).to_pylist()
    if len(lengths) > 1 or None in lengths:
        raise ValueError("feature vectors must be there and have one length")
    x = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1 if lengths and lengths[0] else 0)
    return finite(x, "features")


def finite(x: np.ndarray, what: str) -> np.ndarray:
    if not np.isfinite(x).all():
        raise ValueError(f"{what} must not be NULL, NaN or infinite")
    return x


def binned(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """The bins of a matrix, a line per feature."""
    kind = np.uint8 if max((len(c) for c in cuts), default=0) < 256 else np.uint16
    return np.stack([np.searchsorted(c, x[:, f]).astype(kind) for f, c in enumerate(cuts)])


def merged(bins: np.ndarray, key: np.ndarray, fold: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a row of each group, each row's group): rows of one key and fold with
    the same bins."""
    lines = np.concatenate([np.ascontiguousarray(bins.T).view(np.uint8), key[:, None].view(np.uint8), fold[:, None].view(np.uint8)], axis=1)
    whole = np.ascontiguousarray(lines).view(np.dtype((np.void, lines.shape[1]))).ravel()
    _, first, group = np.unique(whole, return_index=True, return_inverse=True)
    return first, group.ravel()


def blocks(rows: DataFrame, label: str, features: str, key: str, sets: dict[int, list[np.ndarray]], merge: bool) -> RDD:
    """((set, block number), arrays) of ``rows`` with their fold in ``_fold``,
    for every set of split candidates: a fold's, or of all rows under -1."""
    size = ROWS
    schema = pa.schema([("which", pa.int32()), ("part", pa.int32()), ("chunk", pa.int32()), ("n", pa.int64()), ("block", pa.binary())])

    def cut(parts: list[tuple]) -> Iterator[tuple]:
        fold, k, y, x = (np.concatenate(p) for p in zip(*parts, strict=True))
        for which, cuts in sets.items():
            bins = binned(x, cuts)
            if merge:
                first, group = merged(bins, k, fold)
                n = np.bincount(group).astype(float)
                s = np.bincount(group, y)
                w = np.bincount(group, (y - (s / n)[group]) ** 2)
                yield which, bins[:, first], fold[first], n, s, w
            else:
                yield which, bins, fold, np.ones(len(y)), y, np.zeros(len(y))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        part, chunk, held, rows_held = TaskContext.get().partitionId(), 0, [], 0

        def flush() -> Iterator[tuple]:
            for which, bins, fold, n, s, w in cut(held):
                yield (which, (part, chunk)), (len(n), (bins, fold, n, s, w))

        for b in batches:
            if not b.num_rows:
                continue
            fold = b.column(0).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
            k = b.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            y = finite(b.column(2).to_numpy(zero_copy_only=False).astype(float), "labels")
            held.append((fold, k, y, matrix(b.column(3))))
            rows_held += b.num_rows
            if rows_held >= size:
                yield from flush()
                chunk, held, rows_held = chunk + 1, [], 0
        if held:
            yield from flush()

    def packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (which, (part, chunk)), (n, arrays) in run(batches):
            columns = zip((which, part, chunk, n, pickle.dumps(arrays, 5)), schema, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in columns], schema=schema)

    given = rows.select("_fold", F.xxhash64(key).alias("k"), F.col(label).cast("double").alias("y"), vector_to_array(features).alias("x"))
    return given.mapInArrow(packed, "which int, part int, chunk int, n long, block binary")


# --------------------------------------------------------------------------
# the state of the fits
# --------------------------------------------------------------------------


def dealt(found: list, cores: int) -> dict[tuple, int]:
    """The task of each block: the blocks in order, by set, in runs of like
    size, one for every core or more if they are large."""
    ordered = sorted((r["which"], r["part"], r["chunk"], r["n"]) for r in found)
    total, before = sum(r[3] for r in ordered), 0
    tasks = min(len(ordered), max(cores, -(-total // TASK_ROWS)))
    out = {}
    for *block, n in ordered:
        out[tuple(block)] = min(tasks - 1, int((before + n / 2) * tasks / total))
        before += n
    numbers = {t: i for i, t in enumerate(sorted(set(out.values())))}
    return {block: numbers[t] for block, t in out.items()}


def start(cut: DataFrame, depths: list[int]) -> tuple[RDD, int]:
    """The rows of each task and set: training rows, validation rows, and the
    sum of trees of each depth for both, 0 at first. With them, how many there are."""
    sc = cut.sparkSession.sparkContext
    task = dealt(cut.select("which", "part", "chunk", "n").collect(), sc.defaultParallelism)

    def joined(found: Iterable[tuple]) -> Iterator[dict]:
        for w, of_set in groupby(sorted(found, key=lambda kv: kv[0]), key=lambda kv: kv[0][0]):
            blocks = [(at[1:], pickle.loads(block)) for at, block in of_set]
            bins, fold, *rest = (np.concatenate([a[i] for _, a in blocks], axis=-1) for i in range(5))
            learn, held = ((fold >= 0) & (fold != w), fold == w) if w >= 0 else (np.ones(len(fold), bool), np.zeros(len(fold), bool))
            sides = [tuple(np.ascontiguousarray(a[..., m]) for a in (bins, *rest)) for m in (learn, held)]
            zero = {d: tuple(np.zeros(int(m.sum())) for m in (learn, held)) for d in depths}
            yield {"set": w, "block": blocks[0][0], "sides": sides, "sums": zero}

    keyed = cut.rdd.map(lambda r: ((r["which"], r["part"], r["chunk"]), bytes(r["block"])))
    rows = keyed.partitionBy(max(task.values()) + 1, lambda k: task[k]).mapPartitions(joined)
    return rows, len({(t, block[0]) for block, t in task.items()})


def residuals(block: dict, depth: int, first: bool) -> tuple[np.ndarray, np.ndarray]:
    """Sum and sum of squares of each row group's residuals: the labels at
    first, then twice what the trees lack."""
    _, n, s, w = block["sides"][0]
    r, spread = (s, w) if first else (2.0 * (s - n * block["sums"][depth][0]), 4.0 * w)
    return r, spread + r * r / n


def histograms(block: dict, depth: int, tree: Tree, nodes: list[int], first: bool, n_bins: int) -> np.ndarray:
    """(3, nodes, features, bins): number, sum and sum of squares."""
    bins, n, *_ = block["sides"][0]
    r, q = residuals(block, depth, first)
    level, k = nodes[0].bit_length() - 1, len(nodes)
    place = np.full(2 << level, k, np.int64)
    place[nodes] = np.arange(k)
    base = place[tree.nodes(bins, level)] * n_bins if level else np.zeros(len(n), np.int64)
    out, at, alone = np.empty((3, k, len(bins), n_bins)), np.empty_like(base), not (n != 1.0).any()
    for f, line in enumerate(bins):
        np.add(base, line, out=at)
        for i, weight in enumerate((None if alone else n, r, q)):
            out[i, :, f] = np.bincount(at, weight, (k + 1) * n_bins)[: k * n_bins].reshape(k, n_bins)
    return out


def variance(n: np.ndarray, s: np.ndarray, q: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(n > 0, (q - s * s / n) / n, 0.0)


def best_splits(hist: np.ndarray, impurity: np.ndarray | None, n_splits: np.ndarray, r: Rules) -> list[tuple]:
    """(feature, split, gain, value, left value and impurity, right ones) of
    each node. ``impurity`` is the nodes' own, None for the root."""
    run = np.cumsum(hist, axis=3)
    total, left = run[..., -1:], run[..., :-1]
    right = total - left
    low, high = variance(*left), variance(*right)
    whole = total[:, :, 0, 0]
    if impurity is None:
        if n_splits.any():
            f = int(np.flatnonzero(n_splits)[0])
            whole = left[:, :, f, 0] + right[:, :, f, 0]
        impurity = variance(*whole)
    n_low, n_high = left[0], right[0]
    share = n_low + n_high
    with np.errstate(invalid="ignore"):  # an empty node: nothing is allowed below
        gain = impurity[:, None, None] - n_low / share * low - n_high / share * high
    allowed = (np.arange(gain.shape[2]) < n_splits[:, None])[None] & (n_low >= r.min_rows) & (n_high >= r.min_rows) & (gain >= r.min_gain)
    gain = np.where(allowed, gain, -np.inf).reshape(len(gain), -1)
    out = []
    for i, at in enumerate(gain.argmax(axis=1)):
        f, b = divmod(int(at), left.shape[3])
        value = whole[1, i] / whole[0, i] if whole[0, i] else 0.0
        if not gain[i, at] > 0:
            out.append((-1, 0, 0.0, value, 0.0, 0.0, 0.0, 0.0))
            continue
        a, z = left[:, i, f, b], right[:, i, f, b]
        out.append((f, b, float(gain[i, at]), value, a[1] / a[0], float(low[i, f, b]), z[1] / z[0], float(high[i, f, b])))
    return out


def added(found: Iterable[tuple]) -> np.ndarray:
    """Histograms of (block, histogram), added up in the blocks' order."""
    total = None
    for _, h in sorted(found, key=lambda x: x[0]):
        total = h if total is None else total + h
    return total


class Boost:
    """Fits (set, depth) over the blocks of ``cut``, a round at a time."""

    def __init__(self, cut: DataFrame, sets: dict[int, list[np.ndarray]], depths: list[int], r: Rules):
        self.sc, self.rules = cut.sparkSession.sparkContext, r
        self.fits = [(w, d) for w in sets for d in depths]
        self.trees: dict[tuple, list[Tree]] = {fit: [] for fit in self.fits}
        self.n_splits = {w: np.array([len(c) for c in cuts]) for w, cuts in sets.items()}
        self.n_bins = 1 + max(int(n.max(initial=0)) for n in self.n_splits.values())
        state, pieces = start(cut, depths)
        self.state, self.pieces = state.persist(StorageLevel.MEMORY_AND_DISK), pieces / len(sets)  # of a set
        self.done: RDD | None = None  # the state before, until the present one is stored

    def close(self) -> None:
        for rdd in (self.state, self.done):
            if rdd is not None:
                rdd.unpersist()

    def _advance(self) -> None:
        """The last round's trees are added to the sums."""
        weight = 1.0 if self.rounds == 1 else self.rules.step
        last = self.sc.broadcast({fit: trees[-1] for fit, trees in self.trees.items()})

        def add(block: dict) -> dict:
            sums = {}
            for d, both in block["sums"].items():
                tree = last.value[block["set"], d]
                sums[d] = tuple(s + tree.predict(side[0]) * weight for s, side in zip(both, block["sides"], strict=True))
            return block | {"sums": sums}

        self.done, self.state = self.state, self.state.map(add).persist(StorageLevel.MEMORY_AND_DISK)

    @property
    def rounds(self) -> int:
        return len(self.trees[self.fits[0]])

    def _level(self, nodes: dict[tuple, dict[int, float]], trees: dict[tuple, Tree], first: bool) -> dict[tuple, tuple]:
        """The best split of each of the fits' ``nodes`` (node: impurity)."""
        groups = {}
        for fit, found in nodes.items():
            ordered = sorted(found)
            for i in range(0, len(ordered), NODES):
                groups[*fit, i // NODES] = ordered[i : i + NODES]
        present = {fit: trees[fit] for fit in nodes}
        n_bins, n_splits, r = self.n_bins, self.n_splits, self.rules

        def of(block: dict) -> Iterator[tuple]:
            for fit, tree in present.items():
                if fit[0] == block["set"]:
                    ordered = sorted(nodes[fit])
                    hist = histograms(block, fit[1], tree, ordered, first, n_bins)
                    for i in range(0, len(ordered), NODES):
                        yield (*fit, i // NODES), (block["block"], hist[:, i : i + NODES])

        def split(group: tuple, found: Iterable[tuple]) -> list[tuple]:
            w, d, _ = group
            some = groups[group]
            own = None if some == [1] else np.array([nodes[w, d][i] for i in some])
            return [((w, d, i), s) for i, s in zip(some, best_splits(added(found), own, n_splits[w], r), strict=True)]

        hists = self.state.flatMap(of)
        size = 24 * n_bins * sum(len(found) * len(n_splits[fit[0]]) for fit, found in nodes.items()) * self.pieces
        if self.pieces == 1:
            return dict(hists.flatMap(lambda kv: split(kv[0], [kv[1]])).collect())
        if size > NEAR:
            parts = min(len(groups), self.sc.defaultParallelism)
            return dict(hists.groupByKey(parts).flatMap(lambda kv: split(*kv)).collect())
        together: dict[tuple, list] = {}
        for group, one in hists.collect():
            together.setdefault(group, []).append(one)
        return dict(chain.from_iterable(split(*kv) for kv in together.items()))

    def round(self) -> None:
        """One more tree for every fit: a job per level."""
        first = self.rounds == 0
        if not first:
            self._advance()
        trees = {fit: Tree(fit[1]) for fit in self.fits}
        nodes = {fit: {1: math.nan} for fit in self.fits}
        while nodes:
            found, below = self._level(nodes, trees, first), {}
            if self.done is not None:  # the state is stored by now
                self.done.unpersist()
                self.done = None
            for (w, d, i), (f, b, _, value, low, low_impurity, high, high_impurity) in found.items():
                tree = trees[w, d]
                if i == 1:
                    tree.value[1] = value
                if f < 0:
                    continue
                tree.feature[i], tree.split[i] = f, b
                tree.value[2 * i], tree.value[2 * i + 1] = low, high
                for child, impurity in ((2 * i, low_impurity), (2 * i + 1, high_impurity)):
                    if child.bit_length() <= d and abs(impurity) >= EPSILON:
                        below.setdefault((w, d), {})[child] = impurity
            nodes = below
        for fit, tree in trees.items():
            self.trees[fit].append(tree)

    def errors(self) -> dict[tuple, float]:
        """Sum of squared errors of every fit over its validation rows, the
        last round's trees included."""
        weight = 1.0 if self.rounds == 1 else self.rules.step
        last = {fit: trees[-1] for fit, trees in self.trees.items()}

        def of(block: dict) -> Iterator[tuple]:
            bins, n, s, w = block["sides"][1]
            for d, (_, sums) in block["sums"].items():
                lacks = s - n * (sums + last[block["set"], d].predict(bins) * weight)
                yield (block["set"], d), (block["block"], float((w + lacks * lacks / n).sum()))

        out: dict[tuple, float] = dict.fromkeys(self.fits, 0.0)
        for fit, (_, e) in sorted(self.state.flatMap(of).collect()):
            out[fit] += e
        return out


def predictions(rows: DataFrame, label: str, features: str, cuts: list[np.ndarray], trees: list[Tree], step: float) -> DataFrame:
    """(label, prediction) of every row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                bins = binned(matrix(b.column(1)), cuts)
                total = trees[0].predict(bins)
                for tree in trees[1:]:
                    total = total + tree.predict(bins) * step
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(total)], [label, "prediction"])

    given = rows.select(F.col(label).cast("double").alias(label), vector_to_array(features).alias("x"))
    return given.mapInArrow(run, f"`{label}` double, prediction double")
