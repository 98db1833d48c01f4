"""Token ids as files: frequency ranks in byte-aligned variable length, control bytes apart.

The commonest id has rank 0, so most ranks take one byte. Of every four ranks the byte
counts (1 to 4) stand in one control byte, all control bytes before all data bytes, so a
file is decoded by table lookups over whole arrays.

A file holds documents in ascending order of their ids:

    magic "TOKVB001", then four 64-bit numbers: documents, tokens, control bytes and data
    bytes of the counts; the ids (64-bit) and a byte each that is 0 for a null id; the
    token counts in the same coding; then control bytes and data bytes of the ranks.

All numbers are little-endian. The table of ids by rank is a file of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanlens.llm.common import bounded_batches, cut_lineage
from loanlens.llm.shared_files import file_system, new_file, new_folder
from loanlens.llm.tokens import encoded

MAGIC = b"TOKVB001"

# Tokens after which a file is closed.
FILE_TOKENS = 4 << 20
# Numbers that are coded or decoded at once, a multiple of four.
PIECE = 1 << 18

# By control byte: the codes of its four numbers, a byte less than they are long; by the
# width of the numbers, which of their bytes are stored; and how many bytes that are.
CODES = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8)
STORED = {w: (np.arange(w) <= CODES[:, :, None]).reshape(256, 4 * w) for w in (2, 4)}
N_STORED = (CODES + 1).sum(1)


def encode_numbers(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit numbers."""
    values = np.asarray(values).astype(np.uint32, copy=False)
    codes, width = (values > 0xFF).view(np.uint8), 2
    if len(values) and values.max() > 0xFFFF:
        codes, width = codes + (values > 0xFFFF) + (values > 0xFFFFFF), 4
    padded = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    padded[: len(values)] = codes
    four = padded.reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    stored = STORED[width][control].ravel()[: width * len(values)]
    return control.tobytes(), values.astype(f"<u{width}").view(np.uint8)[stored].tobytes()


def decode_numbers(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` numbers of the coding, by lookup of every control byte."""
    # Codes 2 and 3 have the upper one of their two bits.
    width = 4 if (control & 0b10101010).any() else 2
    out = np.zeros(width * n, np.uint8)
    out[STORED[width][control].ravel()[: width * n]] = data
    return out.view(f"<u{width}")


class Coder:
    """The coding of numbers that come piece by piece; holds coded bytes, not numbers."""

    def __init__(self):
        self.control, self.data, self.held = [], [], []
        self.n = self.waiting = 0

    def add(self, values: np.ndarray) -> None:
        self.held.append(values)
        self.n += len(values)
        self.waiting += len(values)
        if self.waiting >= PIECE:
            self._code(last=False)

    def _code(self, last: bool) -> None:
        values = np.concatenate(self.held) if self.held else np.zeros(0, np.uint32)
        whole = len(values) if last else len(values) // 4 * 4
        control, data = encode_numbers(values[:whole])
        self.control.append(control)
        self.data.append(data)
        self.held = [values[whole:].copy()]
        self.waiting = len(values) - whole

    def parts(self) -> list[bytes]:
        """Control bytes, then data bytes."""
        self._code(last=True)
        return [b"".join(self.control), b"".join(self.data)]


def file_parts(ids: list[int | None], counts: list[int], ranks: Coder) -> list[bytes]:
    count_control, count_data = encode_numbers(np.array(counts))
    head = np.array([len(ids), ranks.n, len(count_control), len(count_data)], "<u8").tobytes()
    valid = np.array([i is not None for i in ids], np.uint8).tobytes()
    keys = np.array([i or 0 for i in ids], "<i8").tobytes()
    return [MAGIC, head, keys, valid, count_control, count_data, *ranks.parts()]


def parse_file(blob: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Ids, token counts and ranks of a file."""
    if blob[:8] != MAGIC:
        raise ValueError("not a token file")
    n, tokens, a, b = np.frombuffer(blob, "<u8", 4, 8).tolist()
    at = 40
    keys = np.frombuffer(blob, "<i8", n, at).tolist()
    at += 8 * n
    valid = np.frombuffer(blob, np.uint8, n, at).tolist()
    at += n
    raw = np.frombuffer(blob, np.uint8)
    counts = decode_numbers(raw[at : at + a], raw[at + a : at + a + b], n)
    at += a + b
    control = raw[at : at + -(-tokens // 4)]
    at += len(control)
    ranks = np.empty(tokens, np.uint32)
    for first in range(0, tokens, PIECE):
        own, k = control[first // 4 : (first + PIECE) // 4], min(PIECE, tokens - first)
        # The last control byte may have places that are not used.
        stored = int(N_STORED[own].sum()) - int((CODES[own[-1]] + 1)[(k - 1) % 4 + 1 :].sum())
        ranks[first : first + k] = decode_numbers(own, raw[at : at + stored], k)
        at += stored
    return [k if v else None for k, v in zip(keys, valid)], counts, ranks


def _token_rows(df: DataFrame, path: str, suffix_id: int, id_col: str, text_col: str) -> DataFrame:
    """Rows (id, ids) of documents, and at the end of each task one row of its token counts."""
    suffix = int(suffix_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Packed per document, for it is written once and shuffled once.
        packer = zstandard.ZstdCompressor(level=1)
        total = np.zeros(1, np.int64)
        for part, ids, bounds in encoded(batches, path, 1, suffix):
            own = np.bincount(ids, minlength=len(total))
            own[: len(total)] += total
            total = own
            packed = [packer.compress(_narrow(ids[a:b])) for a, b in zip(bounds, bounds[1:])]
            packed = pa.array(packed, pa.binary())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), packed, pa.nulls(len(packed), pa.binary())], ["id", "ids", "counts"]
            )
        yield pa.RecordBatch.from_pylist([{"counts": total.astype("<i8").tobytes()}], schema)

    schema = pa.schema([("id", pa.int64()), ("ids", pa.binary()), ("counts", pa.binary())])
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return bounded_batches(rows).mapInArrow(run, "id long, ids binary, counts binary")


def _narrow(ids: np.ndarray) -> bytes:
    """Width, then byte planes: the low bytes of all ids, then the next ones; they pack better."""
    width = 4 if ids.max(initial=0) > 0xFFFF else 2
    return bytes([width]) + ids.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T.tobytes()


def _wide(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    width = int(planes[0])
    return np.ascontiguousarray(planes[1:].reshape(width, -1).T).view(f"<u{width}").ravel()


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for blob in batch.column(0).to_pylist():
            total = np.frombuffer(blob, "<i8")
            seen = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["token", "count"])


def write_token_files(
    df: DataFrame,
    path: str,
    folder: str,
    suffix_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    file_tokens: int = FILE_TOKENS,
) -> tuple[DataFrame, str]:
    """Write all documents as token files into ``folder``; a table of the files, and the ranks' file.

    ``path`` is a tokenizer file that all executors can read; ``suffix_id`` ends each
    document, so null and empty texts have one token. Ids are whole numbers; null ids come
    first. Documents with the same id follow each other in the order of reading. Files of
    failed attempts may lie in the folder; only those of the table (file, part, number,
    documents, tokens; in order of part and number) count. An empty table has no file.
    """
    rows = cut_lineage(
        _token_rows(df, path, suffix_id, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
    )
    counts = rows.where("counts IS NOT NULL").select("counts").mapInArrow(_counts, "token long, count long")
    counts = counts.groupBy("token").agg(F.sum("count").alias("count"))
    # One row per token of the vocabulary at most.
    ranked = [r["token"] for r in counts.orderBy(F.desc("count"), "token").select("token").collect()]
    rank_file = new_file(folder, ".ranks")
    system, at = file_system(rank_file)
    with system.open_output_stream(at) as out:
        out.write(np.array(ranked, "<u4").tobytes())
    rank_of = np.zeros(max(ranked, default=0) + 1, np.uint32)
    rank_of[ranked] = np.arange(len(ranked), dtype=np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        ids, counts, ranks = [], [], Coder()

        def close() -> pa.RecordBatch:
            name = new_file(folder, ".tok")
            system, at = file_system(name)
            with system.open_output_stream(at) as out:
                for data in file_parts(ids, counts, ranks):
                    out.write(data)
            return pa.RecordBatch.from_pylist(
                [{"file": name, "part": part, "number": number, "documents": len(ids), "tokens": ranks.n}],
                schema=manifest,
            )

        for batch in batches:
            for i, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = rank_of[_wide(blob.as_py())]
                ids.append(i)
                counts.append(len(own))
                ranks.add(own)
                if ranks.n >= file_tokens:
                    yield close()
                    number += 1
                    ids, counts, ranks = [], [], Coder()
        if ids:
            yield close()

    manifest = pa.schema(
        [("file", pa.string()), ("part", pa.int32()), ("number", pa.int32())]
        + [("documents", pa.int64()), ("tokens", pa.int64())]
    )
    documents = rows.where("counts IS NULL").select("id", "row", "ids")
    ordered = documents.repartitionByRange("id", "row").sortWithinPartitions("id", "row").select("id", "ids")
    files = ordered.mapInArrow(run, "file string, part int, number int, documents long, tokens long")
    # A row per file: one task writes the table, not each of those that write token files.
    return cut_lineage(files.repartition(1)), rank_file


def read_token_files(files: DataFrame, rank_file: str) -> DataFrame:
    """Rows (id, start, ids) of all documents in the files; ``start`` counts the tokens before."""
    # One row per file.
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
    system, at = file_system(rank_file)
    with system.open_input_stream(at) as source:
        id_of = np.frombuffer(source.read(), "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                system, at = file_system(name)
                with system.open_input_stream(at) as source:
                    ids, counts, ranks = parse_file(source.read())
                tokens = id_of[ranks]
                ends = np.cumsum(counts, dtype=np.int64)
                starts = ends - counts
                for a in range(0, len(ids), 500):
                    b = min(len(ids), a + 500)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(ids[a:b], pa.int64()),
                            pa.array(starts[a:b] + start),
                            pa.array([tokens[s:e].tobytes() for s, e in zip(starts[a:b], ends[a:b])], pa.binary()),
                        ],
                        ["id", "start", "ids"],
                    )

    # Rows are too small to tell how much work their files are: a task for so many tokens as
    # close a file, or for every core, and for one file at least.
    n_files, n_tokens = files.agg(F.count("*"), F.coalesce(F.sum("tokens"), F.lit(0))).first()
    tasks = max(-(-n_tokens // FILE_TOKENS), 2 * files.sparkSession.sparkContext.defaultParallelism)
    rows = placed.select("file", "start").repartition(max(1, min(n_files, tasks)))
    return rows.mapInArrow(run, "id long, start long, ids binary")
