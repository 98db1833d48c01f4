"""One row, or one value, per loan out of several.

Rows are combined on the map side, so a loan that holds a large share of the rows is
reduced before the shuffle. Places and dates become one number that orders alike; minima
of numbers, and the values that belong to them, are kept in a hash table, where structs
and texts would have all rows sorted first.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlens.config import LOAN_ID, SNAPSHOT_DATE
from loanlens.functions.values import col, time_key, wall_clock
from loanlens.sources.files import INGEST_ORDER

# Values of these types have a fixed width, so hash aggregation can hold them.
FIXED = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
# Below the image of every date and place.
_NOTHING = -(1 << 62)


def _fixed(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, FIXED)


def _images(value: Column, kind: T.DataType) -> list[Column] | None:
    """LONGs that order like ``value``, compared one after the other; NULL is the least."""
    if isinstance(kind, T.StructType):
        parts = [_images(value.getField(f.name), f.dataType) for f in kind.fields]
        return None if None in parts else [image for part in parts for image in part]
    if isinstance(kind, _WHOLE):
        image = value.cast("long")
    elif isinstance(kind, T.DateType):
        image = F.unix_date(value).cast("long")
    elif isinstance(kind, T.TimestampNTZType):
        image = time_key(value)
    else:
        return None
    return [F.coalesce(image, F.lit(_NOTHING))]


def order_image(df: DataFrame, name: str) -> Column | None:
    """One number, a LONG or a DECIMAL(38,0), that orders rows like column ``name``.

    None where two LONGs can't hold the order (texts, three and more fields).
    """
    images = _images(col(name), df.schema[name].dataType)
    if images is None or len(images) > 2:
        return None
    wide = [F.lit(Decimal(1 << 64)) * i.cast("decimal(19,0)") for i in images[:-1]]
    return reduce(lambda a, b: (a + b.cast("decimal(38,0)")).cast("decimal(38,0)"), [*wide, images[-1]])


def first_per_loan(
    df: DataFrame,
    columns: Sequence[str],
    order_by: Sequence[str] | None = None,
    key: str = LOAN_ID,
) -> DataFrame:
    """The first row of each loan, reduced to ``columns``.

    Rows are ordered by ``order_by``, or by their place in the source file, which the
    reader records and no two rows share; a table with neither has no first row and is
    refused. Rows that tie in ``order_by`` are ordered by their values, so the outcome never
    depends on the partitioning.
    """
    if order_by is None:
        if INGEST_ORDER not in df.columns:
            raise ValueError(f"no order of rows: pass order_by or a column {INGEST_ORDER}")
        place = order_image(df, INGEST_ORDER)
        if place is not None:
            return _first_by_place(df, list(columns), place, key)
        order_by = [INGEST_ORDER]
    fields = [col(name).alias(f"o{i}") for i, name in enumerate(order_by)]
    fields += [col(name).alias(f"v{i}") for i, name in enumerate(columns)]
    picked = df.groupBy(key).agg(F.min(F.struct(*fields)).alias("row"))
    return picked.select(
        key, *[F.col(f"row.v{i}").alias(name) for i, name in enumerate(columns)]
    )


def _first_by_place(df: DataFrame, columns: list[str], place: Column, key: str) -> DataFrame:
    """By hash arg-min. Texts are fetched afterwards, by loan and winning place, so the rows
    of a large loan spread over the join."""
    named = {name: f"v{i}" for i, name in enumerate(columns)}
    rows = df.select(
        col(key).alias("k"), place.alias("place"), *[col(c).alias(v) for c, v in named.items()]
    )
    texts = [v for c, v in named.items() if not _fixed(df, c)]
    picks = [F.min_by(v, "place").alias(v) for v in named.values() if v not in texts]
    first = rows.groupBy("k").agg(F.min("place").alias("place"), *picks)
    if texts:
        values = rows.select(F.col("k").alias("k2"), F.col("place").alias("place2"), *texts)
        won = F.col("k").eqNullSafe(F.col("k2")) & (F.col("place") == F.col("place2"))
        first = first.join(values, won)
    return first.select(F.col("k").alias(key), *[F.col(v).alias(c) for c, v in named.items()])


def _extreme(pick, moment: Column, value: Column) -> Column:
    row = F.when(value.isNotNull(), F.struct(moment.alias("t"), value.alias("v")))
    return pick(row).getField("v")


def _known_per_loan(df: DataFrame, columns: Sequence[str], date: str, first: bool) -> DataFrame:
    """One value per loan, date and column; then the one of the first or last date.

    Two hash aggregations, the second over as many rows as a loan has dates. Texts take the
    sorted way, by themselves.
    """
    best, best_by, struct_best = (F.min, F.min_by, F.min) if first else (F.max, F.max_by, F.max)
    moment = wall_clock(col(date))
    named = {name: f"v{i}" for i, name in enumerate(columns)}
    rows = df.select(
        col(LOAN_ID).alias("k"),
        moment.alias("moment"),
        F.coalesce(time_key(moment), F.lit(_NOTHING)).alias("at"),
        *[col(c).alias(v) for c, v in named.items()],
    )
    texts = [v for c, v in named.items() if not _fixed(df, c)]
    numbers = [v for v in named.values() if v not in texts]
    found = None
    if numbers or not texts:
        per_date = rows.groupBy("k", "at").agg(F.lit(0).alias("none"), *[best(v).alias(v) for v in numbers])
        known = [best_by(v, F.when(F.col(v).isNotNull(), F.col("at"))).alias(v) for v in numbers]
        found = per_date.groupBy("k").agg(F.lit(0).alias("none"), *known).drop("none")
    if texts:
        picked = rows.groupBy("k").agg(
            *[_extreme(struct_best, F.col("moment"), F.col(v)).alias(v) for v in texts]
        )
        if found is None:
            found = picked
        else:
            picked = picked.withColumnRenamed("k", "k2")
            found = found.join(picked, F.col("k").eqNullSafe(F.col("k2"))).drop("k2")
    return found.select(F.col("k").alias(LOAN_ID), *[F.col(v).alias(c) for c, v in named.items()])


def first_known_per_loan(
    df: DataFrame, columns: Sequence[str], date: str = SNAPSHOT_DATE
) -> DataFrame:
    """Per loan and column, the first value present over all dates (ties: the smallest)."""
    return _known_per_loan(df, columns, date, True)


def last_known_per_loan(
    df: DataFrame, columns: Sequence[str], date: str = SNAPSHOT_DATE
) -> DataFrame:
    """Per loan and column, the last value present over all dates (ties: the largest)."""
    return _known_per_loan(df, columns, date, False)
