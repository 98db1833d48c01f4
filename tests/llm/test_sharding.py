import zlib

from loanlens.llm import sharding as op
from tests.llm.helpers import documents, edge_texts, sentence


def expected(rows, n):
    """Rows in order of id and checksum, each in the shard of its middle byte."""
    sized = sorted((i is not None, i or 0, zlib.crc32((t or "").encode()), len((t or "").encode()) + 1) for i, t in rows)
    total, start, out, seen = sum(r[3] for r in sized), 0, [], {}
    for valid, i, crc, size in sized:
        shard = (2 * start + size) * n // (2 * total)
        out.append((i if valid else None, size, crc, start, shard, seen.get(shard, 0)))
        seen[shard] = seen.get(shard, 0) + 1
        start += size
    return out


def test_brute_force(spark):
    texts = [" ".join(sentence(i, i % 50)) for i in range(300)] + edge_texts()
    ids = [(i * 37) % 311 for i in range(len(texts))]
    ids[5] = None
    rows = op.shard_by_bytes(documents(spark, texts, ids).repartition(6), 8).collect()
    key = lambda r: (r[3], r[5])
    assert sorted(map(tuple, rows), key=key) == sorted(expected(zip(ids, texts), 8), key=key)


def test_repeated_rows_are_split(spark):
    rows = op.shard_by_bytes(documents(spark, ["abc"] * 400, [7] * 400), 4).collect()
    assert sorted((r["shard"], r["slot"]) for r in rows) == [(s, k) for s in range(4) for k in range(100)]


def test_empty_table(spark):
    assert op.shard_by_bytes(documents(spark, [])).count() == 0


def test_written_shards_hold_every_row_once(spark, tmp_path):
    texts = [" ".join(sentence(i, 20)) for i in range(80)] + ["same", "same", None]
    df = documents(spark, texts, [*range(80), 5, 5, None]).drop("size")
    op.write_shards(df, str(tmp_path / "shards"), 4)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert sorted((r["text"] or "") for r in back.collect()) == sorted((t or "") for t in texts)
    assert {r["shard"] for r in back.select("shard").distinct().collect()} == {0, 1, 2, 3}
