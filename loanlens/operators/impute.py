"""Exact column medians and imputation."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlens.functions.values import col, number
from loanlens.session import cut_lineage

# Bits of a double that one pass decides.
DIGIT_BITS = 11
_SIGN = np.uint64(1 << 63)


def ordered_images(values: np.ndarray) -> np.ndarray:
    """64-bit whole numbers that order like the doubles; both zeros are one, NaN is last."""
    values = np.where(np.isnan(values), np.nan, values + 0.0)
    bits = values.view(np.uint64)
    return np.where(bits & _SIGN, ~bits, bits | _SIGN)


def value_of(image: int) -> float:
    """The double of an ordered image."""
    bits = np.uint64(image)
    return float(np.array(bits ^ _SIGN if bits & _SIGN else ~bits).view(np.float64))


def _digit_counts(values: DataFrame, prefixes: Mapping[int, Sequence[int]], known: int) -> list:
    """``(i, prefix, digit, n)``: how many values of column i begin with ``known`` bits of one
    of its prefixes and go on with the digit. A row is read once for all its columns."""
    bits = min(DIGIT_BITS, 64 - known)
    shift = np.uint64(64 - known - bits)
    mask = np.uint64((1 << bits) - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = {(i, p): np.zeros(1 << bits, np.int64) for i, own in prefixes.items() for p in own}
        for batch in batches:
            for i, own in prefixes.items():
                rest = ordered_images(batch.column(i).drop_null().to_numpy()) >> shift
                digits = (rest & mask).astype(np.int64)
                for p in own:
                    # Before the first digit all values begin alike.
                    chosen = digits[(rest >> np.uint64(bits)) == np.uint64(p)] if known else digits
                    counts[i, p] += np.bincount(chosen, minlength=1 << bits)
        for (i, p), found in counts.items():
            digits = np.flatnonzero(found)
            columns = [np.full(len(digits), i, np.int32), np.full(len(digits), p, np.int64), digits, found[digits]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["i", "prefix", "digit", "n"])

    rows = values.mapInArrow(run, "i int, prefix long, digit long, n long")
    return rows.groupBy("i", "prefix", "digit").agg(F.sum("n").alias("n")).orderBy("i", "prefix", "digit").collect()


def middle_values(values: DataFrame) -> dict[int, tuple[float, float]]:
    """The two middle values (the same one of an odd number) per column that has any.

    Radix selection: each pass counts the next digit of the values that still may be the
    middle ones, and keeps the digit in which they lie. A column needs as many passes as
    a double has digits, whatever its values; the driver sees the counts of one digit.
    """
    wanted: dict[tuple[int, int], tuple[int, int]] = {}  # column, side: prefix, rank in it
    known = 0
    while known < 64:
        if known:
            prefixes: dict[int, list[int]] = {}
            for (i, _), (prefix, _) in sorted(wanted.items()):
                prefixes.setdefault(i, [])
                if prefix not in prefixes[i]:
                    prefixes[i].append(prefix)
        else:
            prefixes = {i: [0] for i in range(len(values.columns))}
        counts: dict[tuple[int, int], list] = {}
        for r in _digit_counts(values, prefixes, known):
            counts.setdefault((r["i"], r["prefix"]), []).append((r["digit"], r["n"]))
        if not known:
            for (i, _), own in counts.items():
                n = sum(c for _, c in own)
                wanted[i, 0], wanted[i, 1] = (0, (n + 1) // 2), (0, n // 2 + 1)
        bits = min(DIGIT_BITS, 64 - known)
        for key, (prefix, rank) in wanted.items():
            for digit, n in counts[key[0], prefix]:
                if rank <= n:
                    wanted[key] = ((prefix << bits) | digit, rank)
                    break
                rank -= n
        if not wanted:
            break
        known += bits
    return {i: (value_of(wanted[i, 0][0]), value_of(wanted[i, 1][0])) for i, side in wanted if side == 0}


def exact_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(feature, median)`` per column; NULL for a column without values.

    The columns are written once, as every pass reads them again. NaN is missing.
    """
    values = df.select([number(df, name).cast("double").alias(f"x{i}") for i, name in enumerate(columns)])
    middle = middle_values(cut_lineage(values)) if columns else {}
    rows = [
        (name, (middle[i][0] + middle[i][1]) / 2 if i in middle else None) for i, name in enumerate(columns)
    ]
    return df.sparkSession.createDataFrame(rows, "feature string, median double")


def median_values(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Medians as a dict (one small row per column); 0 for a column without values."""
    rows = exact_medians(df, columns).collect()
    return {r["feature"]: (r["median"] if r["median"] is not None else 0.0) for r in rows}


def fill(df: DataFrame, values: Mapping[str, float]) -> DataFrame:
    """Replace missing values per column; a column that is not there is added."""
    filled = {}
    for name, value in values.items():
        present = number(df, name) if name in df.columns else F.lit(None).cast("double")
        filled[name] = F.coalesce(present, F.lit(float(value)))
    return df.select(
        *[col(c) for c in df.columns if c not in filled],
        *[value.alias(name) for name, value in filled.items()],
    )
