"""Contiguous shards of near equal bytes from global prefix sums.

Rows are ordered by document id. Every range partition of that order adds up its own
bytes; the totals of the partitions, one row each, give every partition its place in
the whole, and so every row its first byte. Shards are cut at equal byte targets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanlens.llm.common import cut_lineage, text_or_empty


def _placed_in_partition(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    part, size, rows = TaskContext.get().partitionId(), 0, 0
    for frame in frames:
        ends = frame["size"].to_numpy().cumsum() + size
        yield frame.assign(
            part=np.int32(part),
            local_start=ends - frame["size"].to_numpy(),
            local_row=np.arange(rows, rows + len(frame), dtype=np.int64),
        )
        if len(frame):
            size, rows = int(ends[-1]), rows + len(frame)


def shard_by_bytes(
    df: DataFrame, n_shards: int = 16, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``df``: id, size, text_crc32, start, shard and slot.

    ``size`` is the UTF-8 bytes of the text plus 1 (null text: 1). A row belongs to the
    shard that holds its middle byte, so shards differ from the equal target by at most
    one row at either end, and a text longer than a target leaves neighbours empty.
    Rows are ordered by id (nulls first), then checksum and size; repeated rows keep all
    their copies and may be split between shards. An empty table gives no rows. Other
    columns of ``df`` are not read.

    Only ids, sizes and checksums are shuffled. A task handles its range of the order as
    a stream; a row number, fixed in a written table, splits ranges of equal rows.
    """
    text = text_or_empty(text_col)
    light = cut_lineage(
        df.select(
            F.col(id_col).alias("id"),
            (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.monotonically_increasing_id().alias("row"),
        )
    )
    order = ["id", "text_crc32", "size", "row"]
    schema = f"{_ddl(light)}, part int, local_start long, local_row long"
    placed = cut_lineage(
        light.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInPandas(_placed_in_partition, schema)
    )
    # One row per partition: a window over all of them is small whatever the input.
    totals = placed.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    totals = totals.select(
        "part",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
        F.sum("bytes").over(whole).alias("total"),
    )
    located = placed.join(F.broadcast(totals), "part").select(
        "id",
        "size",
        "text_crc32",
        (F.col("bytes_before") + F.col("local_start")).alias("start"),
        (F.col("rows_before") + F.col("local_row")).alias("place"),
        "total",
    )
    shard = F.expr(f"cast((2 * start + size) * {int(n_shards)} div (2 * total) as int)")
    sharded = located.withColumn("shard", shard)
    # At most n_shards rows.
    first = sharded.groupBy("shard").agg(F.min("place").alias("first"))
    return sharded.join(F.broadcast(first), "shard").select(
        F.col("id").alias(id_col),
        "size",
        "text_crc32",
        "start",
        "shard",
        (F.col("place") - F.col("first")).alias("slot"),
    )


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)


def write_shards(
    df: DataFrame, path: str, n_shards: int = 16, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Write whole rows, one folder ``shard=i`` per shard, and return their places.

    Rows meet their shard by id and checksum of the text; copies of a row take the shard
    of the first of them, so that each is written once.
    """
    places = shard_by_bytes(df, n_shards, id_col, text_col)
    one = places.groupBy(F.col(id_col).alias("_id"), F.col("text_crc32").alias("_crc")).agg(
        F.min("shard").alias("shard")
    )
    crc = F.crc32(text_or_empty(text_col).cast("binary"))
    rows = df.drop("shard").join(one, F.col(id_col).eqNullSafe(F.col("_id")) & (crc == F.col("_crc")))
    rows.drop("_id", "_crc").write.partitionBy("shard").parquet(path)
    return places
