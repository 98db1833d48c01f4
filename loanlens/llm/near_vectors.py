"""Near-duplicate vectors by an epsilon grid order join.

Unit vectors with a cosine of c or more lie within epsilon = sqrt(2 - 2 c) of each other.
After a rotation onto principal axes, vectors are sorted by their grid cells (of side
epsilon) along the leading axes and cut into blocks, none of which crosses a cell of the
first axes. Blocks of neighbouring cells meet if the boxes around their vectors are not
further apart than epsilon; a vector goes along only if it is that near to the other box.
A pair of blocks is joined recursively: intervals of the two sequences whose boxes are too
far apart are skipped, small ones are multiplied. The rotation moves the last bits, so
pairs next to the threshold are decided by the vectors as they were.

Equal vectors are one vector with a weight before all this, so copies cost nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from loanlens.llm.common import cut_lineage
from loanlens.llm.graph import components

# Axes whose cells order the vectors, and those whose cells a block does not cross.
ORDER_AXES = 8
KEY_AXES = 2
# Vectors of a block, and of an interval that is multiplied without further cuts.
BLOCK = 4096
LEAF = 256
SLACK = 1e-9  # of distances and cosines, far above rounding
# Pairs next to the threshold that are decided at once.
CLOSE_PAIRS = 1 << 16


def _valid(vector: Column) -> Column:
    infinite = F.lit(float("inf"))
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != infinite))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def scaled_rows(column: pa.Array, width: int) -> np.ndarray:
    """Vectors in double precision; shorter ones end in zeros. Each is divided by a power of
    two, which is exact and keeps squares from overflowing."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(lengths), width))
    out[np.arange(width) < lengths[:, None]] = values
    return np.ldexp(out, -np.frexp(np.abs(out).max(1, initial=0.0))[1][:, None])


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(1))[:, None]


def principal_axes(classes: DataFrame, width: int) -> np.ndarray:
    """Columns are orthogonal axes, by falling second moment of all vectors."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            x = unit(scaled_rows(batch.column(0), width))
            total += x.T @ x
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(total.ravel())], ["i", "j", "m"]
        )

    sums = classes.select("vector").mapInArrow(moments, "i int, j int, m double").groupBy("i", "j")
    matrix = np.zeros((width, width))
    for row in sums.agg(F.sum("m").alias("m")).collect():  # width * width rows
        matrix[row["i"], row["j"]] = row["m"]
    return np.ascontiguousarray(np.linalg.eigh((matrix + matrix.T) / 2)[1][:, ::-1])


def grid_blocks(classes: DataFrame, axes: np.ndarray, epsilon: float, kind: str = "<f8") -> DataFrame:
    """Blocks in epsilon grid order: number, cells of the key axes, box, and the vectors.

    Boxes are of rotated unit vectors; the vectors themselves stay as they were but for a
    power of two, in numbers of ``kind``, which has to hold them exactly.
    """
    width = len(axes)
    n_order, n_key = min(ORDER_AXES, width), min(KEY_AXES, width)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = scaled_rows(batch.column(2), width)
            x = unit(raw) @ axes
            cells = np.floor(x[:, :n_order] / epsilon).astype(np.int64)
            # Big-endian and without a sign, bytes sort as the cells do.
            keys = (cells + (1 << 31)).astype(">u4")
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([k.tobytes() for k in keys], pa.binary()),
                    pa.array([v.tobytes() for v in raw.astype(kind)], pa.binary()),
                ],
                ["id", "weight", "grid", "coordinates"],
            )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, key, rows = TaskContext.get().partitionId(), 0, None, []

        def block() -> pa.RecordBatch:
            packed = b"".join(r[3] for r in rows)
            x = unpacked(packed, kind, axes)[1]
            cells = (np.frombuffer(key, ">u4").astype(np.int64) - (1 << 31)).tolist()
            return pa.RecordBatch.from_pylist(
                [
                    {
                        "block": (part << 32) + number,
                        "cells": cells,
                        "low": x.min(0).tolist(),
                        "high": x.max(0).tolist(),
                        "ids": [r[0] for r in rows],
                        "weights": [r[1] for r in rows],
                        "vectors": packed,
                    }
                ],
                schema,
            )

        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(4))):
                own = row[2][: 4 * n_key]
                if rows and (own != key or len(rows) == BLOCK):
                    yield block()
                    number, rows = number + 1, []
                key = own
                rows.append(row)
        if rows:
            yield block()

    schema = pa.schema(
        [("block", pa.int64()), ("cells", pa.list_(pa.int64())), ("low", pa.list_(pa.float64()))]
        + [("high", pa.list_(pa.float64())), ("ids", pa.list_(pa.int64())), ("weights", pa.list_(pa.int64()))]
        + [("vectors", pa.binary())]
    )
    placed = cut_lineage(
        classes.select("id", "weight", "vector").mapInArrow(
            project, "id long, weight long, grid binary, coordinates binary"
        )
    )
    ordered = placed.repartitionByRange("grid", "id").sortWithinPartitions("grid", "id")
    return cut_lineage(
        ordered.mapInArrow(
            cut,
            "block long, cells array<long>, low array<double>, high array<double>,"
            " ids array<long>, weights array<long>, vectors binary",
        )
    )


def unpacked(packed: bytes, kind: str, axes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of a block, and the same rotated at length one."""
    raw = np.frombuffer(packed, kind).reshape(-1, len(axes)).astype(np.float64)
    return raw, unit(raw) @ axes


def near_blocks(blocks: DataFrame, epsilon: float, n_key: int) -> DataFrame:
    """``owner, other, low, high``: pairs of blocks (a block with itself too) whose boxes are
    near, and the owner's box.

    Found through the cells of the key axes: a block looks up its 3 ** n_key neighbours.
    """
    boxes = blocks.select("block", "cells", "low", "high")
    around = F.array(F.col("cells"))
    for axis in range(n_key):
        steps = F.array(*[F.lit(d).cast("long") for d in (-1, 0, 1)])
        around = F.flatten(F.transform(around, _mover(axis, steps)))
    left = boxes.select(
        F.col("block").alias("a"), F.col("low").alias("low_a"), F.col("high").alias("high_a"), F.explode(around).alias("cells")
    )
    right = boxes.select(F.col("block").alias("b"), F.col("low").alias("low_b"), F.col("high").alias("high_b"), "cells")
    gap_ab = F.zip_with("low_b", "high_a", lambda x, y: F.greatest(x - y, F.lit(0.0)))
    gap_ba = F.zip_with("low_a", "high_b", lambda x, y: F.greatest(x - y, F.lit(0.0)))
    apart = F.aggregate(F.zip_with(gap_ab, gap_ba, lambda x, y: x * x + y * y), F.lit(0.0), lambda s, x: s + x)
    pairs = left.join(right, "cells").where((F.col("a") <= F.col("b")) & (apart <= (epsilon + SLACK) ** 2))
    # Each of two blocks owns about half of its pairs.
    first = F.pmod(F.xxhash64("a", "b"), F.lit(2)) == 0
    return pairs.select(
        F.when(first, F.col("a")).otherwise(F.col("b")).alias("owner"),
        F.when(first, F.col("b")).otherwise(F.col("a")).alias("other"),
        F.when(first, F.col("low_a")).otherwise(F.col("low_b")).alias("low"),
        F.when(first, F.col("high_a")).otherwise(F.col("high_b")).alias("high"),
    )


MET = "owner long, other long, ids array<long>, weights array<long>, vectors binary"


def _within_reach(epsilon: float, kind: str, axes: np.ndarray):
    """Rows (owner, other, low, high, ids, weights, vectors): the part of the vectors that is
    within epsilon of the owner's box."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept: list[list] = [[], [], [], [], []]
            for i in range(batch.num_rows):
                owner, other, low, high, ids, weights, packed = (batch.column(k)[i] for k in range(7))
                raw, x = unpacked(packed.as_buffer(), kind, axes)
                gap = np.maximum(np.maximum(low.values.to_numpy() - x, x - high.values.to_numpy()), 0.0)
                near = (gap * gap).sum(1) <= (epsilon + SLACK) ** 2
                if near.any():
                    row = (owner.as_py(), other.as_py(), ids.values.to_numpy()[near], weights.values.to_numpy()[near])
                    for column, value in zip(kept, (*row, raw[near].astype(kind).tobytes())):
                        column.append(value)
            if kept[0]:
                types = (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary())
                arrays = [pa.array(c, t) for c, t in zip(kept, types)]
                yield pa.RecordBatch.from_arrays(arrays, ["owner", "other", "ids", "weights", "vectors"])

    return run


def _mover(axis: int, steps: Column):
    def moved(cells: Column) -> Column:
        def by(step: Column) -> Column:
            return F.transform(cells, lambda c, i: F.when(i == axis, c + step).otherwise(c))

        return F.transform(steps, by)

    return moved


class Side(NamedTuple):
    ids: np.ndarray
    weights: np.ndarray
    x: np.ndarray
    raw: np.ndarray


def linked_pairs(a: np.ndarray, b: np.ndarray, raw_a: np.ndarray, raw_b: np.ndarray, cosine: float) -> np.ndarray:
    """Which pairs of rows have a cosine of at least ``cosine``."""
    found = a @ b.T
    linked = found >= cosine
    close_a, close_b = np.nonzero(np.abs(found - cosine) <= SLACK)
    for at in range(0, len(close_a), CLOSE_PAIRS):
        i, j = close_a[at : at + CLOSE_PAIRS], close_b[at : at + CLOSE_PAIRS]
        u, v = raw_a[i], raw_b[j]
        norms = np.sqrt((u * u).sum(1)) * np.sqrt((v * v).sum(1))
        linked[i, j] = (u * v).sum(1) / norms >= cosine
    return linked


def _apart(a: np.ndarray, b: np.ndarray) -> float:
    """Square of the distance between the boxes around two sets of vectors."""
    gap = np.maximum(np.maximum(a.min(0) - b.max(0), b.min(0) - a.max(0)), 0.0)
    return float(gap @ gap)


def linked_intervals(a: Side, b: Side, same: bool, cosine: float) -> Iterator[tuple[slice, slice, np.ndarray]]:
    """Intervals of two sequences with links, and which of their pairs are linked."""
    reach = (math.sqrt(2 - 2 * cosine) + SLACK) ** 2
    todo = [(0, len(a.ids), 0, len(b.ids))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        if same and a1 <= b0:
            continue  # the mirrored interval covers it
        if _apart(a.x[a0:a1], b.x[b0:b1]) > reach:
            continue
        if max(a1 - a0, b1 - b0) > LEAF:
            if a1 - a0 >= b1 - b0:
                cut = (a0 + a1) // 2
                todo += [(a0, cut, b0, b1), (cut, a1, b0, b1)]
            else:
                cut = (b0 + b1) // 2
                todo += [(a0, a1, b0, cut), (a0, a1, cut, b1)]
            continue
        linked = linked_pairs(a.x[a0:a1], b.x[b0:b1], a.raw[a0:a1], b.raw[b0:b1], cosine)
        if same:
            # Each pair once: the row after the column.
            linked &= np.arange(a0, a1)[:, None] > np.arange(b0, b1)
        if linked.any():
            yield slice(a0, a1), slice(b0, b1), linked


def local_roots(linked: np.ndarray, a_ids: np.ndarray, b_ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest id that links of this interval lead to, for its rows and columns."""
    rows, columns = a_ids.copy(), b_ids.copy()
    top = np.iinfo(np.int64).max
    while True:
        new_rows = np.minimum(rows, np.where(linked, columns, top).min(1))
        new_columns = np.minimum(columns, np.where(linked, new_rows[:, None], top).min(0))
        if (new_rows == rows).all() and (new_columns == columns).all():
            return rows, columns
        rows, columns = new_rows, new_columns


def _joined(cosine: float, kind: str, axes: np.ndarray):
    """Rows (owner, other, ids, weights, vectors), the owner's own first: links per vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, at = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                owner, other = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                raw, x = unpacked(batch.column(4)[i].as_buffer(), kind, axes)
                ids, weights = (batch.column(k)[i].values.to_numpy() for k in (2, 3))
                side = Side(ids, weights, x, raw)
                if owner != at:
                    own, at = side, owner
                found = []
                for s, t, linked in linked_intervals(own, side, owner == other, cosine):
                    rows, columns = local_roots(linked, own.ids[s], side.ids[t])
                    for ids, roots, links in (
                        (own.ids[s], rows, linked @ side.weights[t]),
                        (side.ids[t], columns, linked.T @ own.weights[s]),
                    ):
                        some = links > 0
                        found.append((ids[some], links[some], roots[some]))
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(c)) for c in zip(*found)], ["id", "links", "root"]
                    )

    return run


def near_vectors(
    df: DataFrame, cosine: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """Per row: id, ``n_links``, ``component_id`` and ``kept``.

    Vectors link when their cosine in double precision is at least ``cosine``. A vector
    that is null, empty or zero, or that holds null or non-finite numbers, links with
    nothing; a shorter vector is compared as if it ended in zeros. ``n_links`` counts the
    other rows linked directly, ``component_id`` is the smallest id that links lead to,
    ``kept`` says that it is the row's own. Rows of a null id link with nothing and are
    not kept. Repeated rows are linked to each other. Ids are whole numbers; an empty
    table gives no rows; other columns are not read.
    """
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    sound = rows.where(F.col("id").isNotNull() & _valid(F.col("vector")))
    # -0.0 and 0.0 are one number.
    sound = sound.withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0)))
    classes = cut_lineage(
        sound.groupBy("vector").agg(F.min("id").alias("id"), F.count("*").alias("weight"))
    )
    width = classes.agg(F.max(F.size("vector"))).first()[0]
    if width is None:
        none = F.lit(0).cast("long")
        return rows.select(
            F.col("id").alias(id_col), none.alias("n_links"), F.col("id").alias("component_id"),
            F.col("id").isNotNull().alias("kept"),
        )
    epsilon = math.sqrt(2 - 2 * cosine)
    axes = principal_axes(classes, width)
    # Single precision holds what came in it, in half the bytes.
    kind = "<f4" if isinstance(df.schema[vector_col].dataType.elementType, FloatType) else "<f8"
    blocks = grid_blocks(classes, axes, epsilon, kind)
    pairs = near_blocks(blocks, epsilon, min(KEY_AXES, width))
    sides = blocks.select(F.col("block").alias("other"), "ids", "weights", "vectors")
    work = pairs.join(sides, "other").select("owner", "other", "low", "high", "ids", "weights", "vectors")
    work = work.mapInArrow(_within_reach(epsilon, kind, axes), MET).withColumn("later", F.col("owner") != F.col("other"))
    work = work.repartition("owner").sortWithinPartitions("owner", "later", "other")
    links = cut_lineage(
        work.select("owner", "other", "ids", "weights", "vectors").mapInArrow(
            _joined(cosine, kind, axes), "id long, links long, root long"
        )
    )
    between = components(links.select(F.col("id").alias("u"), F.col("root").alias("v")))
    of_class = (
        classes.join(links.groupBy("id").agg(F.sum("links").alias("links")), "id", "left")
        .join(between, "id", "left")
        .select(
            "vector",
            (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
            F.coalesce("component", "id").alias("component"),
        )
    )
    plus = F.when(_valid(F.col("vector")) & F.col("id").isNotNull(), F.transform("vector", lambda x: x + F.lit(0.0)))
    found = rows.withColumn("vector", plus).join(of_class, "vector", "left")
    component = F.coalesce("component", "id")
    return found.select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )
