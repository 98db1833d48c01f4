import gzip
import hashlib
import io

import pytest

from loanlens.llm import warc as op
from loanlens.llm.shared_files import file_system, new_folder


def pages(spark, rows):
    schema = "page_id long, url string, html string, digest string, archive int"
    return spark.createDataFrame([(*r, "x", 1) for r in rows], schema)


def test_pages_round_trip(spark):
    big, other = "<p>é</p>" * 300, "y" * 999
    rows = [(1, "http://a/1", big), (2, None, big), (5, "http://a/\r\nX: 5", big), (3, "", other), (4, "u", other)]
    rows += [(6, "u", None), (7, "u", ""), (None, "u", big), (8, "u", "z" * 70_000), (9, "u", "z" * 1000), (9, "u", "z" * 1000)]
    folder = new_folder(spark, "test")
    index = op.archive_pages(pages(spark, rows).repartition(3), folder)
    assert index.count() == len(rows)
    found = op.read_records(index).collect()
    html = {i: (h or "").encode() for i, _, h in rows}
    urls = {i: u for i, u, _ in rows}
    assert sorted(r["id"] or 0 for r in found) == sorted(i or 0 for i, _, _ in rows)
    for r in found:
        data = html[r["id"]]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(data), hashlib.sha1(data).hexdigest())
        refers = 5 if r["id"] in (1, 2, None) else None
        assert r["refers_to"] == refers
        assert r["record_type"] == ("response" if refers is None else "revisit")
        assert r["payload"] == (data if refers is None else None)
        assert r["url"] == (urls[r["id"]] or "").replace("\r\n", "%0D%0A").replace(" ", "%20") or r["url"] is None
    # Every archive is a member per record, and its index file says the same as the table.
    for name in {r["archive"] for r in index.collect()}:
        system, at = file_system(name)
        data = system.open_input_stream(at, compression=None).read()
        lines = system.open_input_stream(f"{at}.idx").read().decode().splitlines()
        places = sorted((r["offset"], r["length"]) for r in index.where(index.archive == name).collect())
        assert [tuple(map(int, x.split()[:2])) for x in lines] == places
        assert sum(n for _, n in places) == len(data)
        for offset, length in places:
            assert gzip.decompress(data[offset : offset + length]).startswith(b"WARC/1.1\r\n")


def test_whole_stream_and_members_are_read_alike():
    records = [op.record_bytes(i, "u", b"x" * i * 1000, None) for i in range(5)]
    whole = gzip.compress(b"".join(records))
    members = b"".join(map(gzip.compress, records)) + b"\0" * 20
    for data in (whole, members):
        out = io.BytesIO()
        rows = list(op.normalise_archive(io.BytesIO(data), out))
        found = [op.parse_record(gzip.decompress(out.getvalue()[a : a + n])) for a, n, _, _ in rows]
        assert [f.payload for f in found] == [b"x" * i * 1000 for i in range(5)]
        assert [r[3] for r in rows] == [f"<urn:page:{i}>" for i in range(5)]


@pytest.mark.parametrize("cut", [1, 30, 400])
def test_a_cut_archive_is_an_error(cut):
    data = gzip.compress(b"".join(op.record_bytes(i, "u", bytes(range(256)) * 20, None) for i in range(3)))
    with pytest.raises((ValueError, EOFError)):
        list(op.normalise_archive(io.BytesIO(data[:-cut]), io.BytesIO()))


def test_a_changed_payload_is_an_error():
    blob = op.record_bytes(1, "u", b"hello", None)
    with pytest.raises(ValueError):
        op.parse_record(blob.replace(b"hello", b"hallo"))


def test_empty_table(spark):
    index = op.archive_pages(pages(spark, []), new_folder(spark, "test"))
    assert op.read_records(index).count() == 0
