from __future__ import annotations

import gzip
import hashlib
import io
import os
import zlib

import pytest

from pairloom.llm.warc import ArchiveError, read_archives, read_records, record_bytes, write_archives
from tests.llm import data

PAGES = "page_id long, url string, html string"
LONG = "<p>ü</p>" * 40
ROWS = [
    (5, "http://a/5", LONG),
    (3, "http://a/3", LONG),
    (9, None, LONG),
    (9, None, LONG),
    (1, "http://a/1\r\nX: y %41", "short"),
    (2, "http://a/2", "short"),
    (4, "http://a/4", None),
    (6, "http://a/6", ""),
    (None, "http://a/none", LONG),
    (None, "http://a/none", "x" * 200),
    (7, "http://a/7", "z" * 400_000 + "\r\n\r\nWARC/1.1"),
    (8, "http://a/8", "x" * 99),
    (10, "http://a/10", "x" * 99),
]


def want():
    out = []
    for id_, _, html in ROWS:
        body = (html or "").encode()
        ids = [i for i, _, other in ROWS if other == html and i is not None]
        first = min(ids) if len(body) >= 100 and ids and sum(r[2] == html for r in ROWS) > 1 else None
        revisit = first is not None and id_ != first
        out.append((id_, len(body), hashlib.sha256(body).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=repr)


def test_round_trip(spark):
    pages = spark.createDataFrame(ROWS, PAGES).repartition(3)
    manifest = write_archives(pages)
    back = read_archives(manifest, with_payload=True).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in back), key=repr) == want()
    assert sorted((r.url or "") for r in back) == sorted((r[1] or "") for r in ROWS)
    for row in back:
        if row.record_type == "response":
            assert hashlib.sha256(row.payload).hexdigest() == row.payload_digest and len(row.payload) == row.payload_bytes
        else:
            assert row.payload is None


def test_extra_columns_and_empty_table(spark):
    pages = spark.createDataFrame(ROWS, PAGES)
    have = data.check_table(lambda df: read_archives(write_archives(df)).drop("url"), pages)
    assert have == want()


def test_archives_turn_over(spark):
    pages = spark.createDataFrame([(k, None, f"{k} " * 500) for k in range(50)], PAGES).coalesce(1)
    manifest = write_archives(pages, archive_bytes=2000)
    assert manifest.count() > 3
    assert read_archives(manifest).count() == 50


def test_one_member_per_record(spark):
    manifest = write_archives(spark.createDataFrame(ROWS, PAGES).coalesce(1))
    with open(manifest.first().path.removeprefix("file:"), "rb") as file:
        data_ = file.read()
    members = 0
    while data_:
        unpack = zlib.decompressobj(31)
        text = unpack.decompress(data_)
        assert text.startswith(b"WARC/1.1\r\n") and text.endswith(b"\r\n\r\n")
        data_, members = unpack.unused_data, members + 1
    assert members == len(ROWS)


def _record(body=b"some text"):
    return record_bytes(1, "http://a", body, hashlib.sha256(body).hexdigest(), None, False, "2020-01-01T00:00:00Z")


@pytest.mark.parametrize("chunk", [1, 7, 1 << 16])
def test_reader_does_not_depend_on_chunks(chunk, monkeypatch):
    monkeypatch.setattr("pairloom.llm.warc._CHUNK", chunk)
    records = list(read_records(io.BytesIO(_record() + _record(b"") + _record(b"\r\n\r\n")), keep_payload=True))
    assert [r.payload for r in records] == [b"some text", b"", b"\r\n\r\n"]


def _changed(old: bytes, new: bytes) -> bytes:
    plain = gzip.decompress(_record())
    assert old in plain
    return gzip.compress(plain.replace(old, new))


@pytest.mark.parametrize(
    "broken",
    [
        _record()[:-9],
        _changed(b"some text", b"some test"),
        _changed(b"Content-Length: 9", b"Content-Length: 8"),
        _changed(b"WARC/1.1", b"WORK/1.1"),
        _changed(b"sha256:" + hashlib.sha256(b"some text").hexdigest().encode(), b"sha256:" + b"0" * 64),
        gzip.compress(gzip.decompress(_record()) * 2),
        gzip.compress(gzip.decompress(_record())[:-2]),
        b"not gzip",
    ],
)
def test_broken_archives_fail(broken):
    with pytest.raises((ArchiveError, zlib.error)):
        list(read_records(io.BytesIO(broken)))


def test_a_lost_archive_fails(spark):
    manifest = write_archives(spark.createDataFrame(ROWS, PAGES).coalesce(1))
    path = manifest.first().path.removeprefix("file:")
    with open(path, "ab") as file:
        file.write(_record())
    with pytest.raises(Exception, match="records, not"):
        read_archives(manifest).count()
    os.remove(path)
    with pytest.raises(Exception, match="No such file"):
        read_archives(manifest).count()
