"""A random forest fitted tree by tree.

Spark ML grows all trees at once: every row carries a count per tree, and every task sends the
class counts of all bins of all open nodes through a shuffle, over and over. Up to a size that a
worker holds, rows are better sent to the trees: as one byte per feature, the bin of the value.
Each task gets all of them and grows its share of the trees alone, so one shuffle is all there is.

The trees are those of Spark's rules: thresholds between quantiles of the weighted values, rows
counted as often as a Poisson draw says, a fresh subset of the features per node, the best gain of
the Gini impurity among splits with enough rows on both sides, siblings that predict the same class
merged. Only the random numbers are others. The result is Spark's own model.
"""

from __future__ import annotations

import json
import math
import time
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlens.functions.values import col
from loanlens.session import MOST_ROWS, checkpoint_folder, cut_lineage

# Bytes of bins that a task holds at most; Spark's own fit takes larger tables.
MOST_BIN_BYTES = 128 << 20
# Rows whose bins stay in a core's cache while all features of a node are counted.
BLOCK = 1 << 14

_MODEL = "org.apache.spark.ml.classification.RandomForestClassificationModel"
_TREE = "org.apache.spark.ml.classification.DecisionTreeClassificationModel"


def grows_alone(estimator: RandomForestClassifier, rows: int, features: int) -> bool:
    """Whether the rows are worth the way of this module, and small enough for it."""
    plain = estimator.getImpurity() == "gini" and estimator.getMaxBins() <= 256
    plain = plain and estimator.getFeatureSubsetStrategy() == "sqrt" and estimator.getSubsamplingRate() == 1.0
    plain = plain and estimator.getBootstrap() and estimator.getNumTrees() > 1 and estimator.getMinInfoGain() == 0.0
    return plain and MOST_ROWS < rows and rows * features <= MOST_BIN_BYTES


# --- Bins ------------------------------------------------------------------------


def thresholds(values: np.ndarray, weights: np.ndarray, most: int) -> np.ndarray:
    """Where a feature may be split: between all distinct values, or at ``most`` quantiles.

    ``values`` are distinct and sorted. A quantile's threshold lies behind the value whose
    cumulated weight is nearest to it.
    """
    middles = (values[:-1] + values[1:]) / 2
    if len(middles) <= most:
        return middles
    reached = np.cumsum(weights).tolist()
    stride = reached[-1] / (most + 1)
    target, chosen = stride, []
    for i, (before, now) in enumerate(zip(reached, reached[1:])):
        if abs(before - target) < abs(now - target):
            chosen.append(i)
            target += stride
    return middles[chosen]


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    x = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    if not np.isfinite(x).all():
        raise ValueError("features must not be NaN or infinite")
    return x


def _distinct(values: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    values, place = np.unique(values + 0.0, return_inverse=True)
    return values, np.bincount(place, weights, len(values))


def split_thresholds(rows: DataFrame, width: int, most: int) -> list[np.ndarray]:
    """Thresholds of every feature of ``(x, weight)``; a task sees the distinct values of one."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, weight = _matrix(batch.column("x"), width), batch.column("weight").to_numpy()
            for f in range(width):
                values, weights = _distinct(x[:, f], weight)
                yield pa.RecordBatch.from_pydict({"f": np.full(len(values), f, np.int32), "v": values, "w": weights})

    def choose(found: pa.Table) -> pa.Table:
        values, weights = _distinct(found.column("v").to_numpy(), found.column("w").to_numpy())
        chosen = thresholds(values, weights, most)
        return pa.table({"f": found.column("f").slice(0, 1), "t": pa.array([chosen.tolist()], pa.list_(pa.float64()))})

    counted = rows.select("x", "weight").mapInArrow(count, "f int, v double, w double")
    found = {r["f"]: np.array(r["t"], float) for r in counted.groupBy("f").applyInArrow(choose, "f int, t array<double>").collect()}
    return [found[f] for f in range(width)]


def binned(rows: DataFrame, cuts: list[np.ndarray]) -> DataFrame:
    """Blocks of rows: the bins, row by row, and the labels, as bytes; numbered in their order."""
    width = len(cuts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for i, batch in enumerate(batches):
            x = _matrix(batch.column("x"), width)
            bins = np.empty(x.shape, np.uint8)
            for f, cut in enumerate(cuts):
                bins[:, f] = np.searchsorted(cut, x[:, f])
            label = batch.column("label").to_numpy().astype(np.uint8)
            part = batch.column("part")[0].as_py() if len(x) else 0
            block = {"part": [part], "i": [i], "bins": [bins.tobytes()], "label": [label.tobytes()]}
            schema = [("part", pa.int32()), ("i", pa.int32()), ("bins", pa.binary()), ("label", pa.binary())]
            yield pa.RecordBatch.from_pydict(block, pa.schema(schema))

    dealt = rows.select("x", "label", F.spark_partition_id().alias("part"))
    return dealt.mapInArrow(run, "part int, i int, bins binary, label binary")


# --- A tree ----------------------------------------------------------------------


class Growth(NamedTuple):
    """What a tree is grown by; ``weights`` are those of a good and a bad row."""

    cuts: list[np.ndarray]
    weights: tuple[float, float]
    depth: int
    min_rows: int
    subset: int
    seed: int


class Tree(NamedTuple):
    """Nodes, parents before children: children (-1 of a leaf), split, gain, and counts of good and bad rows."""

    left: np.ndarray
    right: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    gain: np.ndarray
    counts: np.ndarray


def _impurity(good: np.ndarray, bad: np.ndarray) -> np.ndarray:
    total = good + bad
    share = np.divide(good, total, out=np.zeros_like(total), where=total > 0)
    return np.where(total > 0, 1 - share * share - (1 - share) * (1 - share), 0.0)


def _best_bins(counts: np.ndarray, start: np.ndarray, parent: np.ndarray, grow: Growth):
    """Per node the best bin of one feature to end the left side with: gain, bin and left counts.

    ``counts`` are those of the node's bins, of one node after the other from ``start`` on.
    """
    sizes = np.diff(np.append(start, len(counts)))
    node = np.arange(len(start)).repeat(sizes)
    left = np.cumsum(counts, axis=0)
    before = left[start] - counts[start]
    left -= before[node]
    right = parent[node] - left
    a, b = grow.weights
    left_weight, right_weight = left @ (a, b), right @ (a, b)
    whole = (parent @ (a, b))[node]
    gain = _impurity(parent[:, 0] * a, parent[:, 1] * b)[node]
    gain = gain - left_weight / whole * _impurity(left[:, 0] * a, left[:, 1] * b)
    gain -= right_weight / whole * _impurity(right[:, 0] * a, right[:, 1] * b)
    # The last bin leaves no row to the right.
    gain[(left.sum(axis=1) < grow.min_rows) | (right.sum(axis=1) < grow.min_rows)] = -math.inf
    best = np.maximum.reduceat(gain, start)
    hit = np.flatnonzero(gain == best[node])
    first = hit[np.searchsorted(node[hit], np.arange(len(start)))]
    return best, first - start, left[first]


def grow_tree(bins: np.ndarray, label: np.ndarray, tree: int, grow: Growth) -> Tree:
    """One tree on rows of bins, level by level."""
    rng = np.random.default_rng([grow.seed & 0xFFFFFFFF, tree])
    width = bins.shape[1]
    flat = bins.reshape(-1)
    times = rng.poisson(1.0, len(bins))
    rows = np.flatnonzero(times)
    times, label = times[rows].astype(float), label[rows].astype(np.intp)
    at = rows * width
    place = np.zeros(len(rows), np.intp)
    sizes = np.array([len(c) + 1 for c in grow.cuts])
    counts = [np.bincount(label, times, 2)]
    children, splits, gains = [], [], []  # per level
    open_nodes, known = np.zeros(1, np.int64), 1
    for level in range(grow.depth):
        parent = np.concatenate(counts)[:].reshape(-1, 2)[open_nodes]
        k = len(open_nodes)
        subset = rng.random((k, width)).argsort(axis=1)[:, : grow.subset]
        best = np.full(k, -math.inf)
        feature, bin_, kept = np.zeros(k, np.intp), np.zeros(k, np.intp), np.zeros((k, 2))
        index = np.empty(len(rows), np.intp)
        for s in range(grow.subset):
            own = np.ascontiguousarray(subset[:, s])
            size = sizes[own]
            start = np.cumsum(size) - size
            first = 2 * start
            for b in range(0, len(rows), BLOCK):
                here = slice(b, b + BLOCK)
                of = place[here]
                code = flat.take(own.take(of) + at[here]).astype(np.intp)
                code += code
                code += first.take(of)
                np.add(code, label[here], out=index[here])
            found = np.bincount(index, times, 2 * int(size.sum())).reshape(-1, 2)
            gain, bin_s, left = _best_bins(found, start, parent, grow)
            better = gain > best
            best = np.where(better, gain, best)
            feature, bin_ = np.where(better, own, feature), np.where(better, bin_s, bin_)
            kept[better] = left[better]
        split = best > 0
        n = int(split.sum())
        if not n:
            break
        left, right = kept[split], parent[split] - kept[split]
        both = np.stack([left, right], 1).reshape(-1, 2)
        pair = known + 2 * np.arange(n)
        children.append((open_nodes[split], pair))
        splits.append((feature[split], bin_[split]))
        gains.append(best[split])
        counts.append(both.reshape(-1))
        # A node is closed if it is pure or too small for a split.
        closed = (both.min(axis=1) == 0) | (both.sum(axis=1) < 2 * grow.min_rows)
        known += 2 * n
        if level + 1 == grow.depth or closed.all():
            break
        open_nodes = np.repeat(pair, 2)
        open_nodes[1::2] += 1
        number = np.where(closed, -1, np.cumsum(~closed) - 1)
        below = np.full((k, 2), -1, np.intp)
        below[split] = number.reshape(-1, 2)
        goes_right = flat.take(feature.take(place) + at) > bin_.take(place)
        place = below.reshape(-1).take(2 * place + goes_right)
        stays = place >= 0
        rows, at, place, times, label = (a[stays] for a in (rows, at, place, times, label))
        open_nodes = open_nodes[~closed]
    return _pruned(np.concatenate(counts).reshape(-1, 2), children, splits, gains, grow)


def _pruned(counts: np.ndarray, children: list, splits: list, gains: list, grow: Growth) -> Tree:
    """Merge leaves that predict the same class, from the bottom up, and number the nodes that stay."""
    left = np.full(len(counts), -1, np.int64)
    feature, bin_, gain = np.full(len(counts), -1, np.int64), np.zeros(len(counts), np.int64), np.full(len(counts), -1.0)
    bad = counts[:, 1] * grow.weights[1] > counts[:, 0] * grow.weights[0]
    for (node, pair), (f, b), g in zip(children, splits, gains):
        left[node], feature[node], bin_[node], gain[node] = pair, f, b, g
    for node, pair in ((n, p) for n, p in reversed(children)):
        merged = (left[pair] < 0) & (left[pair + 1] < 0) & (bad[pair] == bad[pair + 1])
        left[node[merged]] = -1
    stays = np.zeros(len(counts), bool)
    stays[0] = True
    for node, pair in children:
        own = stays[node] & (left[node] >= 0)
        stays[pair[own]] = stays[pair[own] + 1] = True
    number = np.cumsum(stays) - 1
    leaf = left < 0
    cut = np.array([0.0 if e else grow.cuts[f][b] for e, f, b in zip(leaf, feature, bin_)])
    right = np.where(leaf, -1, number[np.where(leaf, 0, left + 1)])
    left = np.where(leaf, -1, number[np.where(leaf, 0, left)])
    return Tree(*(a[stays] for a in (left, right, np.where(leaf, -1, feature), cut, np.where(leaf, -1.0, gain), counts)))


_NODE = "tree int, id int, left int, right int, feature int, threshold double, gain double, good double, bad double"


def grown(blocks: DataFrame, trees: int, tasks: int, grow: Growth) -> DataFrame:
    """Nodes of all trees. Every task gets all blocks and grows each ``tasks``-th tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [(r["part"], r["i"], r["task"], r["bins"], r["label"]) for b in batches for r in b.to_pylist()]
        if not own:
            return
        own.sort(key=lambda r: r[:2])
        label = np.frombuffer(b"".join(r[4] for r in own), np.uint8)
        bins = np.frombuffer(b"".join(r[3] for r in own), np.uint8).reshape(len(label), -1)
        first = own[0][2]
        del own
        for tree in range(first, trees, tasks):
            found = grow_tree(bins, label, tree, grow)
            n = len(found.left)
            arrays = [np.full(n, tree), np.arange(n), found.left, found.right, found.feature]
            columns = [pa.array(a.astype(np.int32)) for a in arrays]
            columns += [pa.array(a) for a in (found.threshold, found.gain, *found.counts.T.copy())]
            yield pa.RecordBatch.from_arrays(columns, names=[part.split()[0] for part in _NODE.split(", ")])

    dealt = blocks.withColumn("task", F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))))
    return dealt.repartitionById(tasks, F.col("task")).mapInArrow(run, _NODE)


# --- Spark's model ---------------------------------------------------------------


def _node_data(nodes: DataFrame, weights: tuple[float, float]) -> DataFrame:
    """The nodes in the form in which Spark ML stores a forest."""
    good, bad = F.col("good") * weights[0], F.col("bad") * weights[1]
    share = good / (good + bad)
    leaf = F.col("left") < 0
    split = F.struct(
        F.col("feature").alias("featureIndex"),
        F.when(leaf, F.array().cast("array<double>")).otherwise(F.array("threshold")).alias("leftCategoriesOrThreshold"),
        F.lit(-1).alias("numCategories"),
    )
    node = F.struct(
        F.col("id"),
        (bad > good).cast("double").alias("prediction"),
        (1 - share * share - (1 - share) * (1 - share)).alias("impurity"),
        F.array(good, bad).alias("impurityStats"),
        (F.col("good") + F.col("bad")).cast("long").alias("rawCount"),
        F.col("gain"),
        F.col("left").alias("leftChild"),
        F.col("right").alias("rightChild"),
        split.alias("split"),
    )
    return nodes.select(F.col("tree").alias("treeID"), node.alias("nodeData"))


def _facts(kind: str, uid: str, params: dict, defaults: dict, version: str, **more) -> str:
    facts = {"class": kind, "timestamp": int(time.time() * 1000), "sparkVersion": version, "uid": uid}
    return json.dumps(facts | {"paramMap": params, "defaultParamMap": defaults} | more)


def fit_forest(estimator: RandomForestClassifier, rows: DataFrame, weights: tuple[float, float]) -> RandomForestClassificationModel:
    """The model of an estimator with two classes, whose rows weigh as ``weights`` say.

    Its nodes stay where they are written: ``node_path`` of the model.
    """
    spark = rows.sparkSession
    label = col(estimator.getLabelCol())
    values = rows.select(
        vector_to_array(col(estimator.getFeaturesCol())).alias("x"),
        label.cast("int").alias("label"),
        F.when(label == 1, float(weights[1])).otherwise(float(weights[0])).alias("weight"),
    )
    width = len(values.select("x").first()[0])
    cuts = split_thresholds(values, width, estimator.getMaxBins() - 1)
    grow = Growth(
        cuts, weights, estimator.getMaxDepth(), estimator.getMinInstancesPerNode(),
        math.ceil(math.sqrt(width)), estimator.getSeed(),
    )
    trees = estimator.getNumTrees()
    tasks = min(trees, 2 * spark.sparkContext.defaultParallelism)
    path = f"{checkpoint_folder(spark)}/forest-{uuid.uuid4().hex}"
    _node_data(grown(cut_lineage(binned(values, cuts)), trees, tasks, grow), weights).write.parquet(f"{path}/data")

    params = {p.name: v for p, v in estimator._paramMap.items()}
    defaults = {p.name: v for p, v in estimator._defaultParamMap.items()}
    forest_only = {"numTrees", "featureSubsetStrategy", "subsamplingRate", "bootstrap"}
    own = [{k: v for k, v in d.items() if k not in forest_only} for d in (params, defaults)]
    tree_facts = [(i, _facts(_TREE, f"dtc_{uuid.uuid4().hex[:12]}", *own, spark.version), 1.0) for i in range(trees)]
    spark.createDataFrame(tree_facts, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    more = {"numFeatures": width, "numClasses": 2, "numTrees": trees}
    facts = _facts(_MODEL, estimator.uid, params, defaults, spark.version, **more)
    spark.createDataFrame([(facts,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    model = RandomForestClassificationModel.load(path)
    model.node_path = f"{path}/data"
    return model
