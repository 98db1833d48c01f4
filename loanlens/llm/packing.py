"""Documents cut into token pieces and packed into sequences by vector best fit.

A sequence has three capacities: tokens, documents, and attention cost (the sum of squared
lengths). Pieces are placed longest first; among the open sequences with room in every
dimension the one with the best score takes the piece. The score is the weighted square
norm of what would be left, or the weighted dot product of the piece and what is left;
the smallest wins, so a piece goes where it fills most.

Pieces are dealt to groups of a fixed expected size by a hash of their row, and a task
packs one group after another; a group of tens of thousands of pieces packs about as well
as the whole. A piece of full length is a sequence by itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlens.llm.common import bounded_batches, cut_lineage
from loanlens.llm.tokens import encoded

# Pieces of one group, as expected.
GROUP = 32_768


class Capacity(NamedTuple):
    """Limits of one sequence, weights of the dimensions in the score, and the score.

    ``documents`` and ``cost`` are None where tokens alone limit a sequence; they are then
    what a sequence full of tokens cannot exceed.
    """

    tokens: int = 1024
    documents: int | None = None
    cost: int | None = None
    weights: tuple[float, float, float] = (1.0, 0.001, 0.001)
    score: str = "norm"

    def limits(self) -> np.ndarray:
        documents = self.tokens if self.documents is None else self.documents
        cost = self.tokens**2 if self.cost is None else self.cost
        return np.array([self.tokens, documents, cost], np.float64)


def piece_lengths(n: int, size: int) -> list[int]:
    """A document of ``n`` tokens in pieces of ``size``; the first takes the remainder."""
    if n <= size:
        return [n]
    rest = n % size
    return ([rest] if rest else []) + [size] * (n // size)


def token_pieces(
    df: DataFrame,
    path: str,
    suffix_id: int | None = 2,
    size: int = 1024,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Rows (id, piece, start, length, ids) of every document's pieces.

    ``ids`` are little-endian unsigned 32-bit numbers of the tokenizer file at ``path``,
    which all executors can read, and ``suffix_id`` at the end of each document. Null and
    empty texts consist of the suffix; without one they have no piece. Special tokens in a
    text are plain text. Repeated rows give repeated pieces, an empty table none.
    """
    suffix = b"" if suffix_id is None else int(suffix_id).to_bytes(4, "little")
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, found, bounds in encoded(batches, path, 1, suffix):
            rows, piece, start, length, ids = [], [], [], [], []
            for row, (first, end) in enumerate(zip(bounds, bounds[1:])):
                at = 0
                for i, n in enumerate(piece_lengths(end - first, size) if end > first else []):
                    rows.append(row)
                    piece.append(i)
                    start.append(at)
                    length.append(n)
                    ids.append(found[first + at : first + at + n].tobytes())
                    at += n
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).take(pa.array(rows, pa.int64())),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(ids, pa.binary()),
                ],
                ["id", "piece", "start", "length", "ids"],
            )

    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return bounded_batches(rows).mapInArrow(run, f"id {kind}, piece int, start long, length long, ids binary")


def best_fit(lengths: np.ndarray, capacity: Capacity) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of every piece of a group.

    Raises ValueError for a piece that no empty sequence can take. Equal lengths keep
    their order; of equal scores the oldest sequence wins.
    """
    limits = capacity.limits()
    weights = np.array(capacity.weights)
    lengths = np.asarray(lengths, np.int64)
    if len(lengths) and (lengths.max() > limits[0] or limits[1] < 1 or lengths.max() ** 2 > limits[2]):
        raise ValueError("a piece exceeds the capacity of a sequence")
    order = np.argsort(-lengths, kind="stable")
    sequence = np.zeros(len(lengths), np.int64)
    offset = np.zeros(len(lengths), np.int64)
    full = int((lengths == capacity.tokens).sum())
    sequence[order[:full]] = np.arange(full)
    left = np.empty((3, 1024))
    number = np.empty(1024, np.int64)
    n_open, n_all = 0, full
    least = int(lengths.min(initial=0))
    for i in order[full:].tolist():
        need = np.array([lengths[i], 1.0, float(lengths[i]) ** 2])
        have = left[:, :n_open]
        fits = np.flatnonzero((have[0] >= need[0]) & (have[1] >= 1.0) & (have[2] >= need[2]))
        if len(fits):
            have = have[:, fits] / limits[:, None]
            part = (need / limits)[:, None]
            value = (have - part) ** 2 if capacity.score == "norm" else have * part
            best = int(fits[int(np.argmin(weights @ value))])
        else:
            if n_open == left.shape[1]:
                left = np.concatenate([left, np.empty_like(left)], 1)
                number = np.concatenate([number, np.empty_like(number)])
            best = n_open
            left[:, best], number[best] = limits, n_all
            n_open, n_all = n_open + 1, n_all + 1
        sequence[i] = number[best]
        offset[i] = capacity.tokens - int(left[0, best])
        left[:, best] -= need
        # A sequence without room for the shortest piece is closed; the order stays.
        if left[0, best] < least or left[1, best] < 1:
            left[:, best : n_open - 1] = left[:, best + 1 : n_open]
            number[best : n_open - 1] = number[best + 1 : n_open]
            n_open -= 1
    return sequence, offset


def pack(pieces: DataFrame, capacity: Capacity = Capacity(), group: int = GROUP) -> DataFrame:
    """``pieces`` (with a column ``length``) and their ``sequence_id`` and ``offset``.

    A sequence's pieces lie gapless from offset 0. Carry no payload through this: its rows
    are written once and shuffled once. An empty table gives no rows. Columns of the two
    names are replaced; others may have any names.
    """
    pieces = pieces.drop("sequence_id", "offset")
    # Plain names meanwhile: those of the table may be any.
    names, pieces = pieces.columns, pieces.toDF(*[f"c{i}" for i in range(len(pieces.columns))])
    length = f"c{names.index('length')}"
    rows = cut_lineage(pieces.withColumn("row", F.monotonically_increasing_id()))
    n_groups = max(1, -(-rows.count() // group))
    columns = pieces.columns
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for frame in frames:
            changes = np.flatnonzero(np.diff(frame["group"].to_numpy())) + 1
            for part in np.split(np.arange(len(frame)), changes):
                part = frame.iloc[part]
                if held and len(part) and held[0]["group"].iloc[0] != part["group"].iloc[0]:
                    yield place(held)
                    held = []
                if len(part):
                    held.append(part)
        if held:
            yield place(held)

    def place(parts: list[pd.DataFrame]) -> pd.DataFrame:
        rows = pd.concat(parts, ignore_index=True)
        sequence, offset = best_fit(rows[length].to_numpy(), capacity)
        first = int(rows["group"].iloc[0]) << 40
        return rows[columns].assign(sequence_id=sequence + first, offset=offset)

    grouped = rows.withColumn("group", F.pmod(F.xxhash64("row"), F.lit(n_groups)))
    # A task takes any number of groups, one after the other.
    return (
        grouped.repartition("group")
        .sortWithinPartitions("group", "row")
        .drop("row")
        .mapInPandas(run, f"{ddl}, sequence_id long, offset long")
        .toDF(*names, "sequence_id", "offset")
    )


def sequences(placed: DataFrame) -> DataFrame:
    """Whole sequences (sequence_id, ids) of placed pieces with their ``ids``."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda a, p: F.concat(a, p["ids"]))
    return placed.groupBy("sequence_id").agg(joined.alias("ids"))
