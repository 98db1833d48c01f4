"""Attribution for tree ensembles: exact Shapley values along the tree paths.

On the way to a leaf the conditions on one feature merge into one interval and one share:
the part of the training rows that would stay on the way if the feature were unknown. A
known feature i is inside its interval (o = 1) or not (o = 0). A leaf worth v gives feature j

    v (o_j - s_j) * integral over t from 0 to 1 of the product over i <> j of
                    s_i (1 - t) + o_i t

The product is a polynomial in t whose degree is below the depth, so a Gauss-Legendre rule
with half as many nodes as the depth integrates it exactly. A row enters only through the
conditions that it meets. So the rows of a batch are grouped, for every small subtree at the
bottom of a tree, by the conditions on the way to it and its own splits, and the values are
worked out once per combination that occurs: products are carried down from its root, sums
over leaves up again; an edge that meets a feature for a second time takes the earlier
factor out. A row only looks its combination up. That is done in two steps: rows that a larger
subtree does not tell apart are one row for the small ones in it.

The ensemble is a table of nodes that Spark ML writes with the model. Executors turn each
tree into arrays of edges; these are shipped to the tasks in pieces of a checked size; the
rows are partitioned by Spark and never leave their partition.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.functions.values import col
from loanlens.session import checkpoint_folder, cut_lineage

# Edges sent with one pass over the rows; larger ensembles take several passes.
MAX_PASS_BYTES = 64 << 20
# Rows that are worked on together.
MAX_ROW_BYTES = 64 << 20
# Nodes that Spark writes at once.
MAX_WRITE_NODES = 1 << 16
# Splits of the subtrees whose rows are grouped by the conditions that they meet.
CHUNK_SPLITS = 6
# Splits of larger subtrees, in which one row stands for all alike, and rows that are worth it.
REGION_SPLITS = 32
REGION_ROWS = 4096
# Keys of rows are numbered before they pass 2 to this power; through a table if it has no more entries.
REGION_BITS = 18
MOST_TABLE = 1 << 24
# Up to so many conditions, combinations are numbered through a table instead of by sorting.
TABLE_BITS = 16


class Level(NamedTuple):
    """Edges to the nodes of one depth, in pairs: left and right child of a parent.

    ``low, high, share`` are those of the edge's feature so far, ``before_*`` those above
    the edge. ``value`` is that of a leaf, 0 of an inner node.
    """

    parent: np.ndarray
    feature: np.ndarray
    low: np.ndarray
    high: np.ndarray
    share: np.ndarray
    before_low: np.ndarray
    before_high: np.ndarray
    before_share: np.ndarray
    value: np.ndarray


def _runs(sizes: list[tuple[int, int]], most: int) -> Iterator[tuple[int, int]]:
    """First and last tree of runs that stay below a size together."""
    first, last, total = None, None, 0
    for tree, size in sizes:
        if first is not None and total + size > most:
            yield first, last
            first, total = None, 0
        first = tree if first is None else first
        last, total = tree, total + size
    if first is not None:
        yield first, last


def _written_nodes(model) -> DataFrame:
    """The nodes as Spark writes them. It sends a model to a single task for that, so a large
    ensemble is written as several smaller ones, which neither fill the driver nor a message."""
    spark = SparkSession.getActiveSession()
    written = getattr(model, "node_path", None)
    if written is not None:
        return spark.read.parquet(written)
    path = f"{checkpoint_folder(spark)}/ensemble-{uuid.uuid4().hex}"
    if model.totalNumNodes <= MAX_WRITE_NODES:
        model.write().save(path)
        return spark.read.parquet(f"{path}/data")
    whole, java, boosted = model._java_obj, spark._jvm, isinstance(model, GBTClassificationModel)
    trees, weights = list(whole.trees()), list(whole.treeWeights())
    ml = java.org.apache.spark.ml
    kind = ml.regression.DecisionTreeRegressionModel if boosted else ml.classification.DecisionTreeClassificationModel
    make = getattr(ml.classification, type(model).__name__)

    def array(kind, values):
        out = spark.sparkContext._gateway.new_array(kind, len(values))
        for i, value in enumerate(values):
            out[i] = value
        return out

    pieces = []
    for first, last in _runs([(i, tree.numNodes()) for i, tree in enumerate(trees)], MAX_WRITE_NODES):
        arrays = [array(kind, trees[first : last + 1])]
        if boosted:
            arrays.append(array(java.double, weights[first : last + 1]))
        piece = make(whole.uid(), *arrays, whole.numFeatures(), whole.numClasses())
        piece.save(f"{path}/{first}")
        nodes = spark.read.parquet(f"{path}/{first}/data")
        pieces.append(nodes.withColumn("treeID", F.col("treeID") + first))
    return reduce(DataFrame.unionByName, pieces)


def node_table(model) -> DataFrame:
    """Nodes of the ensemble: tree, id, children, split, value and training weight."""
    node = F.col("nodeData")
    stats = node["impurityStats"]
    if isinstance(model, GBTClassificationModel):
        value, weight = node["prediction"], F.get(stats, F.lit(0))
    else:
        # Class weights of a classification node: good, bad.
        good, bad = F.get(stats, F.lit(0)), F.get(stats, F.lit(1))
        value, weight = F.try_divide(bad, good + bad), good + bad
    return _written_nodes(model).select(
        F.col("treeID").alias("tree"),
        node["id"].alias("id"),
        node["leftChild"].alias("left"),
        node["rightChild"].alias("right"),
        node["split"]["featureIndex"].alias("feature"),
        F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"),
        value.alias("value"),
        weight.alias("weight"),
    )


# --- A tree as levels of edges -------------------------------------------------


def tree_levels(nodes: pa.Table, scale: float) -> tuple[float, list[Level]]:
    """Mean margin over the training rows, and the edges of one tree, level by level."""
    nodes = nodes.sort_by("id")
    ids, left, right, feature = (nodes.column(c).to_numpy() for c in ("id", "left", "right", "feature"))
    threshold, value, weight = (
        nodes.column(c).to_numpy().astype(float) for c in ("threshold", "value", "weight")
    )
    names, place = np.unique(feature, return_inverse=True)
    at = np.zeros(1, np.int64)
    low, high = np.full((1, len(names)), -math.inf), np.full((1, len(names)), math.inf)
    share, reach = np.ones((1, len(names))), np.ones(1)
    # A tree of one leaf gives every row its value.
    levels, base = [], scale * value[0] if left[0] < 0 else 0.0
    while (inner := np.flatnonzero(left[at] >= 0)).size:
        node = at[inner]
        child = np.searchsorted(ids, np.stack([left[node], right[node]], 1).ravel())
        parent = inner.repeat(2)
        node = node.repeat(2)
        axis = np.arange(len(node)), place[node]
        cut = threshold[node]
        is_left = np.arange(len(node)) % 2 == 0
        low, high, share = low[parent], high[parent], share[parent]
        before = low[axis], high[axis], share[axis]
        kept = np.divide(weight[child], weight[node], out=np.zeros(len(node)), where=weight[node] > 0)
        low[axis] = np.where(is_left, before[0], np.maximum(before[0], cut))
        high[axis] = np.where(is_left, np.minimum(before[1], cut), before[1])
        share[axis] = before[2] * kept
        reach = reach[parent] * kept
        leaf = np.where(left[child] < 0, scale * value[child], 0.0)
        base += float((leaf * reach).sum())
        levels.append(Level(parent, feature[node], low[axis], high[axis], share[axis], *before, leaf))
        at = child
    return base, levels


_EDGE = np.dtype([(name, "i4" if name in ("parent", "feature") else "f8") for name in Level._fields])
PACKED = "tree int, base double, bytes long, edges array<binary>"


def packed_trees(model) -> DataFrame:
    """One row per tree: its mean margin and the edges of its levels, as bytes.

    A row's margin is the sum of the trees' bases and the row's attributions: log-odds for
    boosted trees, the probability for a forest.
    """
    scales = list(model.treeWeights)
    if isinstance(model, GBTClassificationModel):
        # The probability is the logistic of twice the weighted sum.
        scales = [2 * w for w in scales]
    else:
        scales = [w / sum(scales) for w in scales]

    def pack(nodes: pa.Table) -> pa.Table:
        tree = nodes.column("tree")[0].as_py()
        base, levels = tree_levels(nodes, scales[tree])
        packed = [np.rec.fromarrays(level, dtype=_EDGE).tobytes() for level in levels]
        columns = {"tree": [tree], "base": [base], "bytes": [sum(map(len, packed))], "edges": [packed]}
        schema = [("tree", pa.int32()), ("base", pa.float64()), ("bytes", pa.int64()), ("edges", pa.list_(pa.binary()))]
        return pa.table(columns, schema=pa.schema(schema))

    return cut_lineage(node_table(model).groupBy("tree").applyInArrow(pack, PACKED))


def base_value(trees: DataFrame) -> float:
    """Mean margin over the training rows."""
    return float(trees.agg(F.sum("base")).first()[0])


# --- Shapley values ------------------------------------------------------------


class _Chunk(NamedTuple):
    """Rows told apart by the conditions above a small subtree and by its own splits.

    ``codes`` holds each combination that occurs, ``place`` the combination of every row.
    """

    codes: np.ndarray
    place: np.ndarray


def _combinations(key: np.ndarray, bits: int) -> _Chunk:
    if bits > TABLE_BITS:
        return _Chunk(*np.unique(key, return_inverse=True))
    seen = np.zeros(1 << bits, bool)
    seen[key] = True
    codes = np.flatnonzero(seen)
    number = np.empty(1 << bits, np.intp)
    number[codes] = np.arange(len(codes))
    return _Chunk(codes, number.take(key))


def _tables(level: Level, t: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per edge and kind (in neither interval, in the earlier one, in both): factor and gain."""
    share, before = level.share[:, None, None], level.before_share[:, None, None]
    now = np.array([0.0, 0.0, 1.0])[:, None]
    then = np.array([0.0, 1.0, 1.0])[:, None]
    factor, old = share * (1 - t) + now * t, before * (1 - t) + then * t
    # A factor of 0 belongs to a share of 0, whose difference to o is 0 as well.
    ratio = np.divide(factor, old, out=np.zeros_like(factor), where=old > 0)
    gain = np.divide(now - share, factor, out=np.zeros_like(factor), where=factor > 0)
    gain -= np.divide(then - before, old, out=np.zeros_like(factor), where=old > 0)
    return ratio, gain * w


def _numbered(key: np.ndarray, size: int) -> tuple[int, np.ndarray]:
    """How many of the keys below ``size`` occur, and the number of every row's."""
    if size > MOST_TABLE:
        found, place = np.unique(key, return_inverse=True)
        return len(found), place.astype(np.uint32)
    key = key.astype(np.intp)
    seen = np.zeros(size, bool)
    seen[key] = True
    found = np.flatnonzero(seen)
    number = np.empty(size, np.uint32)
    number[found] = np.arange(len(found))
    return len(found), number.take(key)


def _thresholds(trees: list[list[bytes]], features: int) -> list[np.ndarray]:
    """All bounds of the trees' edges, by feature: rows matter only by their place among them."""
    feature, bound = [], []
    for tree in trees:
        edges = np.concatenate([np.frombuffer(level, _EDGE) for level in tree])
        for side in ("low", "high"):
            kept = np.isfinite(edges[side])
            feature.append(edges["feature"][kept])
            bound.append(edges[side][kept])
    feature, bound = np.concatenate(feature), np.concatenate(bound)
    return [np.unique(bound[feature == f]) for f in range(features)]


def _places(x: np.ndarray, cuts: list[np.ndarray]) -> list[np.ndarray]:
    """Of how many thresholds of a feature a row lies above."""
    return [np.searchsorted(c, x[:, f]).astype(np.min_scalar_type(len(c))) for f, c in enumerate(cuts)]


def _values(trees: list[list[bytes]], cuts: list[np.ndarray], places: list[np.ndarray]) -> np.ndarray:
    out = np.zeros((len(places), len(places[0])))
    for tree in trees:
        _TreeValues(tree, cuts, places, out).add()
    return out


def shapley(trees: list[list[bytes]], x: np.ndarray) -> np.ndarray:
    """Shapley values, rows by features, of the sum of the trees."""
    trees = [tree for tree in trees if tree]
    if not trees or not len(x):
        return np.zeros(x.shape)
    cuts = _thresholds(trees, x.shape[1])
    return _values(trees, cuts, _places(x, cuts)).T


class _TreeValues:
    """Adds the Shapley values of one tree to ``out``; ``x`` and ``out`` are features by rows.

    ``x`` are places among the thresholds ``cuts`` of a feature.
    """

    def __init__(self, tree: list[bytes], cuts: list[np.ndarray], x: list[np.ndarray], out: np.ndarray) -> None:
        edges = [np.frombuffer(level, _EDGE) for level in tree]
        levels = [Level(*(e[f] for f in Level._fields)) for e in edges]
        self.x, self.out, self.levels = x, out, levels
        t, w = np.polynomial.legendre.leggauss((len(levels) + 1) // 2)
        self.t, self.w = (t + 1) / 2, w / 2
        tables = [_tables(level, self.t, self.w) for level in levels]
        # Node 0 is the root; the others are numbered along the levels, children in pairs.
        start = np.cumsum([1, *map(len, edges)])
        above = [np.zeros(1, np.int64), *(s + np.arange(len(e)) for s, e in zip(start, edges))]
        parent = np.concatenate([np.zeros(1, np.int64), *(a[e["parent"]] for a, e in zip(above, edges))])
        self.ratio, self.gain = (np.concatenate([t[i] for t in tables]) for i in (0, 1))
        self.value = [0.0, *np.concatenate([e["value"] for e in edges]).tolist()]
        self.share = [1.0, *np.concatenate([e["share"] for e in edges]).tolist()]
        first = np.zeros(start[-1], np.int64)
        pairs = np.arange(1, start[-1], 2)
        first[parent[pairs]] = pairs
        splits = (first > 0).astype(np.int64)
        for node in range(start[-1] - 1, 0, -1):
            splits[parent[node]] += splits[node]
        self.first, self.splits = first.tolist(), splits.tolist()
        # The right child's interval starts at the threshold, or above it if that cuts nothing off.
        feature, low = (np.concatenate([e[f] for e in edges]) for f in ("feature", "low"))
        self.feature = np.where(first > 0, feature[first - 1], -1).tolist()
        cut = np.where(first > 0, low[np.minimum(first, len(low) - 1)], 0.0)
        self.cut = [int(np.searchsorted(cuts[f], c)) if f >= 0 else 0 for f, c in zip(self.feature, cut)]

    def add(self) -> None:
        rows = len(self.x[0])
        key = np.zeros(rows, np.uint32 if len(self.levels) + CHUNK_SPLITS <= 32 else np.int64)
        most = REGION_SPLITS if rows >= REGION_ROWS else CHUNK_SPLITS
        for part in self._parts((0, key, {}, {}), self.x, most):
            if self.splits[part[0]] <= CHUNK_SPLITS:
                self._add_chunk(*part, self.x, self.out)
            else:
                self._add_region(*part)

    def _parts(self, part: tuple, x, most: int) -> Iterator[tuple]:
        """Down the tree to subtrees of at most so many splits, with what lies above them: bit i
        of a row's key says that it meets all conditions on feature i of the path."""
        todo = [part]
        while todo:
            node, key, bit, share = todo.pop()
            if self.splits[node] <= most:
                yield node, key, bit, share
                continue
            feature, child = self.feature[node], self.first[node]
            is_left = x[feature] <= self.cut[node]
            known = bit.get(feature)
            for down, stays in ((child, is_left), (child + 1, ~is_left)):
                if known is None:
                    new = key | (stays.astype(key.dtype) << len(bit))
                else:
                    new = key & ~((~stays).astype(key.dtype) << known)
                todo.append((down, new, bit | {feature: bit.get(feature, len(bit))}, share | {feature: self.share[down]}))

    def _add_region(self, root: int, key: np.ndarray, bit: dict[int, int], share: dict[int, float]) -> None:
        """One row stands for all that no condition above and in a subtree tells apart."""
        nodes, cuts = [root], {}
        for node in nodes:
            if self.first[node]:
                cuts.setdefault(self.feature[node], set()).add(self.cut[node])
                nodes += [self.first[node], self.first[node] + 1]
        size, place = _numbered(key, 1 << len(bit))
        for feature, own in cuts.items():
            if size * (len(own) + 1) > 1 << REGION_BITS:
                size, place = _numbered(place, size)
            above = np.zeros(len(key), np.uint8)
            for cut in own:
                above += self.x[feature] > cut
            place *= len(own) + 1
            place += above
            size *= len(own) + 1
        size, place = _numbered(place, size)
        place = place.astype(np.intp)
        row = np.empty(size, np.intp)
        row[place] = np.arange(len(place))
        found = {f: np.zeros(size) for f in bit | cuts}
        x = {f: self.x[f].take(row) for f in cuts}
        for part in self._parts((root, key.take(row), bit, share), x, CHUNK_SPLITS):
            self._add_chunk(*part, x, found)
        for feature, values in found.items():
            self.out[feature] += values.take(place)

    def _add_chunk(self, root: int, key: np.ndarray, bit: dict[int, int], share: dict[int, float], x, out) -> None:
        nodes, inner = [root], {}
        for node in nodes:
            if self.first[node]:
                inner[node] = len(bit) + len(inner)
                nodes += [self.first[node], self.first[node] + 1]
        if inner:
            key = key.copy()
        for node, place in inner.items():
            key |= (x[self.feature[node]] <= self.cut[node]).astype(key.dtype) << place
        codes, place = _combinations(key.astype(np.int64), len(bit) + len(inner))
        # Factors and gains of the path's features; those of features not met any more are 1 and 0.
        met = {f: (codes >> i & 1).astype(np.intp) for f, i in bit.items()}
        s, o = np.array(list(share.values()))[:, None, None], np.array([0.0, 1.0])[:, None]
        factor = s * (1 - self.t) + o * self.t
        gain = np.divide(self.w * (o - s), factor, out=np.zeros_like(factor), where=factor > 0)
        product = np.ones((len(codes), len(self.t)))
        for i in range(0, len(share), 3):
            eight = np.ones((1, len(self.t)))
            for two in factor[i : i + 3]:
                eight = (two[:, None] * eight).reshape(-1, len(self.t))
            product *= eight.take(codes >> i & len(eight) - 1, axis=0)
        found: dict[int, np.ndarray] = {}

        def below(node: int, product: np.ndarray, met: dict[int, np.ndarray]) -> np.ndarray:
            """Sum over the leaves under a node; what the edges on the way give their features is found."""
            child = self.first[node]
            if not child:
                return self.value[node] * product
            feature = self.feature[node]
            is_left, then = codes >> inner[node] & 1, met.get(feature, 1)
            total = 0.0
            for down, stays in ((child, is_left), (child + 1, 1 - is_left)):
                now = then & stays
                kind = then + now
                part = below(down, product * self.ratio[down - 1].take(kind, axis=0), met | {feature: now})
                gained = np.einsum("rq,rq->r", part, self.gain[down - 1].take(kind, axis=0))
                found[feature] = found.get(feature, 0.0) + gained
                total = total + part
            return total

        whole = below(root, product, met)
        if share:
            sums = (whole @ gain.reshape(-1, len(self.t)).T).reshape(len(codes), -1, 2)
            for i, feature in enumerate(bit):
                own = np.where(met[feature], sums[:, i, 1], sums[:, i, 0])
                found[feature] = found.get(feature, 0.0) + own
        for feature, values in found.items():
            out[feature] += values.take(place)


# --- As a column -----------------------------------------------------------------


def _shared_values(trees: list[list[bytes]], batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Shapley values of batches, which are taken together up to a size. Only the places of
    their values are held, a byte or two each, and the values that come out."""
    trees = [tree for tree in trees if tree]
    cuts, held, size = [], [], 0

    def found() -> Iterator[pa.Array]:
        lengths = [len(places[0]) for places in held]
        places = [np.concatenate(own) for own in zip(*held)]
        held.clear()
        values = _values(trees, cuts, places)
        first = 0
        for n in lengths:
            own = values[:, first : first + n].T.reshape(-1)
            yield pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * len(values), own)
            first += n

    for batch in batches:
        if not len(batch):
            yield pa.array([], pa.list_(pa.float64()))
            continue
        x = batch.flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
        cuts = cuts or (_thresholds(trees, x.shape[1]) if trees else [np.empty(0)] * x.shape[1])
        held.append(_places(x, cuts))
        size += x.nbytes
        if size >= MAX_ROW_BYTES:
            yield from found()
            size = 0
    if held:
        yield from found()


def attribution_udf(trees: list[list[bytes]]) -> Callable[[Column], Column]:
    """Shapley values of some trees as an Arrow-batched function.

    Their bytes are broadcast, and freed with the plan that uses them. The more rows are
    taken together, the more of them share their values.
    """
    shared = SparkSession.getActiveSession().sparkContext.broadcast(trees)

    @F.arrow_udf("array<double>")
    def attribute(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from _shared_values(shared.value, batches)

    return attribute


def add_tree_attributions(
    df: DataFrame,
    model,
    features: list[str],
    name: str = "attributions",
    scales: list[float] | None = None,
    trees: DataFrame | None = None,
) -> DataFrame:
    """Add an array of Shapley values in feature order: log-odds for boosted trees,
    probability for a forest. Together with the base value they sum to the margin. Features
    are divided by ``scales`` before they meet the trees. ``trees`` are those of
    :func:`packed_trees`, if they are at hand."""
    # A scaler makes 0 of a feature that does not vary.
    scales = scales or [1.0] * len(features)
    values = zip(features, scales)
    x = F.array(*[col(f).cast("double") / s if s else F.lit(0.0) for f, s in values])
    total = F.array(*[F.lit(0.0) for _ in features])
    trees = packed_trees(model) if trees is None else trees
    sizes = [tuple(r) for r in trees.select("tree", "bytes").orderBy("tree").collect()]
    for first, last in _runs(sizes, MAX_PASS_BYTES):
        # Row by row: a piece lies in the driver once.
        piece = trees.where(F.col("tree").between(first, last)).select("edges").toLocalIterator()
        edges = [[bytes(level) for level in r["edges"]] for r in piece]
        total = F.zip_with(total, attribution_udf(edges)(x), lambda a, b: a + b)
    return df.withColumn(name, total)
