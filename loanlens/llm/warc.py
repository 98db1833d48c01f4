"""WARC archives: writing, normalising to a member per record with an index, reading.

Archives are written as one gzip stream each, as some tools do; then a reader has to
inflate everything before a record. The normaliser inflates such a file once, as a
stream, writes every record as a gzip member of its own, and next to the archive an index
of the members' offsets. Readers fetch single members by that index.

An index line has offset, length, record type and record id, parted by spaces.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.llm.common import cut_lineage, text_or_empty
from loanlens.llm.shared_files import file_system, new_file

# Raw bytes after which an archive is closed.
ARCHIVE_BYTES = 32 << 20
READ_BYTES = 1 << 20
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2025-01-01T00:00:00Z"
GZIP = 31  # zlib's window bits for a gzip wrapper


def payload_groups(pages: DataFrame, payload: Column, id_col: str, least: int = 1000) -> DataFrame:
    """``digest, refers_to`` of payloads of ``least`` bytes that several pages have.

    The largest page id of a payload is the one the others refer to. One row per repeated
    payload; a page that a third of all rows repeat is counted before the shuffle.
    """
    digests = pages.select(F.col(id_col).alias("id"), F.sha1(payload).alias("digest"), F.octet_length(payload).alias("n"))
    groups = digests.where(F.col("n") >= least).groupBy("digest")
    return groups.agg(F.max("id").alias("refers_to"), F.count("*").alias("copies")).where(
        "copies > 1 AND refers_to IS NOT NULL"
    ).select("digest", "refers_to")


def with_references(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = 1000
) -> DataFrame:
    """``id, url, payload, refers_to`` of every page; ``refers_to`` is null for responses."""
    payload = F.encode(text_or_empty(html_col), "UTF-8")
    # Written first, so that the planner knows its size and broadcasts it only if small.
    groups = cut_lineage(payload_groups(pages, payload, id_col, least))
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload")
    ).withColumn("digest", F.sha1("payload"))
    refers = F.when(F.col("id").eqNullSafe(F.col("refers_to")), None).otherwise(F.col("refers_to"))
    return rows.join(groups, "digest", "left").select("id", "url", "payload", refers.cast("long").alias("refers_to"))


# -- records ------------------------------------------------------------------------------


def record_id(page: int | None) -> str:
    return f"<urn:page:{'null' if page is None else page}>"


def page_of(record: str | None) -> int | None:
    value = (record or "").removeprefix("<urn:page:").removesuffix(">")
    return None if value in ("", "null") else int(value)


def record_bytes(page: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A response with its payload, or a revisit with the HTTP header alone."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
    ]
    if url:
        # A line break in a url would end the header.
        clean = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
        lines.append(f"WARC-Target-URI: {clean}")
    if refers_to is not None:
        lines += [f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Profile: {REVISIT_PROFILE}"]
    lines += [f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode("utf-8", "replace") + block + b"\r\n\r\n"


def header_fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    pairs = (line.split(":", 1) for line in lines[1:] if ":" in line)
    return {name.strip().lower(): value.strip() for name, value in pairs}


class Record(NamedTuple):
    page: int | None
    url: str | None
    kind: str
    payload: bytes | None
    payload_bytes: int
    digest: str
    refers_to: int | None


def parse_record(blob: bytes) -> Record:
    """A whole record; raises ValueError if a payload does not have its digest."""
    head, _, rest = blob.partition(b"\r\n\r\n")
    fields = header_fields(head)
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"(?im)^content-length:\s*(\d+)", http)[1])
    digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
    kind = fields["warc-type"]
    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"damaged payload in {fields['warc-record-id']}")
    return Record(
        page_of(fields["warc-record-id"]),
        fields.get("warc-target-uri"),
        kind,
        payload if kind == "response" else None,
        size,
        digest,
        page_of(fields.get("warc-refers-to")),
    )


# -- files --------------------------------------------------------------------------------


def write_archives(rows: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write ``id, url, payload, refers_to`` as archives of one gzip stream each; their names.

    A task writes its rows as they come and starts a new archive after ``archive_bytes``.
    Archives of failed attempts may lie in the folder; only those of the table count.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = name = gz = None
        size = records = 0

        def close() -> pa.RecordBatch:
            out.write(gz.flush())
            out.close()
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([records], pa.int64())], ["archive", "records"])

        for batch in batches:
            for i in range(batch.num_rows):
                page, url, payload, refers = (batch.column(k)[i].as_py() for k in range(4))
                if out is None:
                    name = new_file(folder, ".warc.gz")
                    system, at = file_system(name)
                    out, gz = system.open_output_stream(at, compression=None), zlib.compressobj(wbits=GZIP)
                    size = records = 0
                raw = record_bytes(page, url, payload, refers)
                out.write(gz.compress(raw))
                size, records = size + len(raw), records + 1
                if size >= archive_bytes:
                    yield close()
                    out = None
        if out is not None:
            yield close()

    return cut_lineage(rows.select("id", "url", "payload", "refers_to").mapInArrow(run, "archive string, records long"))


class Inflater:
    """The inflated bytes of a gzip file, member after member, as far as they are asked for."""

    def __init__(self, source):
        self.source, self.tail, self.buffer = source, b"", bytearray()
        self.gz = None

    def more(self) -> bool:
        """Inflate another piece of at most READ_BYTES; False at the end of the file."""
        data = self.tail or self.source.read(READ_BYTES)
        if self.gz is None:
            data = data.lstrip(b"\0")  # padding between members
        if not data:
            if self.gz is not None:
                raise ValueError("the archive ends in the middle of a gzip stream")
            return False
        self.gz = self.gz or zlib.decompressobj(wbits=GZIP)
        self.buffer += self.gz.decompress(data, READ_BYTES)
        self.tail = self.gz.unconsumed_tail
        if self.gz.eof:
            self.tail, self.gz = self.gz.unused_data, None
        return True

    def until(self, mark: bytes) -> bytes | None:
        """The bytes up to and with ``mark``; None at the end of the file."""
        seen = 0
        while (at := self.buffer.find(mark, seen)) < 0:
            seen = max(0, len(self.buffer) - len(mark))
            if not self.more():
                if self.buffer.strip():
                    raise ValueError("the archive ends in the middle of a record")
                return None
        return self.take(at + len(mark))

    def take(self, n: int) -> bytes:
        out = bytes(self.buffer[:n])
        del self.buffer[:n]
        return out

    def pieces(self, n: int) -> Iterator[bytes]:
        """The next ``n`` bytes in pieces."""
        while n:
            if not self.buffer and not self.more():
                raise ValueError("the archive ends in the middle of a record")
            piece = self.take(min(n, len(self.buffer)))
            n -= len(piece)
            if piece:
                yield piece


def normalise_archive(source, out) -> Iterator[tuple[int, int, str, str]]:
    """Copy records from an inflated stream to ``out``, a gzip member each.

    Yields offset, length, type and id of every member. A record's block is passed on in
    pieces, so that memory does not grow with the archive or a record.
    """
    stream, offset = Inflater(source), 0
    while (head := stream.until(b"\r\n\r\n")) is not None:
        head = head.lstrip(b"\r\n")
        fields = header_fields(head[:-4])
        gz, length = zlib.compressobj(wbits=GZIP), 0

        def members() -> Iterator[bytes]:
            yield gz.compress(head)
            yield from map(gz.compress, stream.pieces(int(fields["content-length"]) + 4))
            yield gz.flush()

        for data in members():
            out.write(data)
            length += len(data)
        yield offset, length, fields["warc-type"], fields["warc-record-id"]
        offset += length


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """Rewrite every archive (column ``archive``, any gzip members) with an index beside it.

    Returns the index: archive, offset, length, type and record id of every record. The
    index file has the archive's name and ``.idx``. A damaged archive raises ValueError.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for source_name in batch.column(0).to_pylist():
                name = new_file(folder, ".warc.gz")
                system, at = file_system(name)
                source_system, source_at = file_system(source_name)
                with (
                    source_system.open_input_stream(source_at, compression=None) as source,
                    system.open_output_stream(at, compression=None) as out,
                    system.open_output_stream(f"{at}.idx") as index,
                ):
                    rows = []
                    for row in normalise_archive(source, out):
                        index.write((" ".join(map(str, row)) + "\n").encode())
                        rows.append({"archive": name, **dict(zip(("offset", "length", "type", "record"), row))})
                        if len(rows) >= 10_000:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    schema = pa.schema(
        [("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64())]
        + [("type", pa.string()), ("record", pa.string())]
    )
    # A task per archive; the rows are too small to tell how much work they are.
    names = archives.select("archive").repartition(max(1, archives.count()))
    return cut_lineage(
        names.mapInArrow(run, "archive string, offset long, length long, type string, record string")
    )


def read_records(index: DataFrame, payloads: bool = True) -> DataFrame:
    """The records that an index names: id, url, record_type, payload, its bytes, digest, refers_to.

    Members are fetched by offset and length, and payloads are checked against their
    digest. A revisit has the length and digest of the payload, not the payload.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = source = None
        for batch in batches:
            found: list[Record] = []
            size = 0
            for archive, offset, length in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if archive != name:
                    if source is not None:
                        source.close()
                    system, at = file_system(archive)
                    name, source = archive, system.open_input_file(at)
                source.seek(offset)
                record = parse_record(zlib.decompress(source.read(length), wbits=GZIP))
                found.append(record if payloads else record._replace(payload=None))
                size += record.payload_bytes if payloads else 0
                if size > 8 << 20:
                    yield rows_of(found)
                    found, size = [], 0
            if found:
                yield rows_of(found)
        if source is not None:
            source.close()

    def rows_of(found: list[Record]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(column, field.type) for column, field in zip(zip(*found), schema)], schema.names
        )

    schema = pa.schema(
        [("id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload", pa.binary())]
        + [("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64())]
    )
    places = index.select("archive", "offset", "length")
    n = max(1, places.select("archive").distinct().count())
    ordered = places.repartition(n, "archive").sortWithinPartitions("archive", "offset")
    return ordered.mapInArrow(
        run,
        "id long, url string, record_type string, payload binary, payload_bytes long, payload_digest string, refers_to long",
    )


def archive_pages(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least: int = 1000,
) -> DataFrame:
    """Write pages as archives, normalise them, and return the index of their records.

    Of pages with equal payloads of ``least`` bytes and more, the one with the largest id
    (a whole number) is a response and the others revisit it; rows that repeat that id are
    responses too. A null id is never the largest. A null page is an empty payload, a null
    url has no header. Every row is a record; an empty table makes none.
    """
    rows = with_references(pages, id_col, url_col, html_col, least)
    return normalise(write_archives(rows, f"{folder}/raw"), f"{folder}/records")
