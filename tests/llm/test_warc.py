"""Archives (7): exact round trip."""

from __future__ import annotations

import base64
import hashlib
import struct
from pathlib import Path

import pytest
import zstandard

from trackline.llm import op7_warc as op7
from trackline.llm.common import scratch_dir

PAGES = "page_id long, url string, html string, sha1 string, last string"
ROWS = [(1, "http://a.example/x y\r\nX: 1", "<p>same</p>", "q", "q"), (2, "http://b.example/%41?é", "<p>same</p>", "q", "q"),
        (3, None, None, None, None), (4, "http://c", "", "q", "q"), (None, "http://d", "<p>same</p>", "q", "q"),
        (6, "http://e", "é" * 300_000 + "\r\n\r\nWARC/1.1\r\n", "q", "q"), (7, "http://f", "one", "q", "q"),
        (7, "http://f", "one", "q", "q")]


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


@pytest.fixture
def folder(spark, request):
    return f"{scratch_dir(spark)}/{request.node.name}"


def test_round_trip(spark, folder, monkeypatch):
    pages = spark.createDataFrame(ROWS, PAGES)
    archives = op7.write_archives(pages, folder)
    found = sorted((tuple(row) for row in op7.read_archives(archives).collect()), key=str)
    expected = []
    for page, url, html, _, _ in ROWS:
        ids = [p for p, _, h, *_ in ROWS if (h or "") == (html or "") and p is not None]
        revisit = page != max(ids)
        payload = (html or "").encode()
        expected.append((page, url, len(payload), digest(html), "revisit" if revisit else "response",
                         max(ids) if revisit else None, None if revisit else bytearray(payload)))
    assert found == sorted(expected, key=str)
    assert sum(row.n_records for row in archives.collect()) == len(ROWS)


def test_real_pages(spark, sf_dir, folder):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    archives = op7.write_archives(pages, folder)
    found = {row.page_id: row for row in op7.read_archives(archives).collect()}
    for row in pages.collect():
        record = found[row.page_id]
        payload = record.payload if record.record_type == "response" else found[record.refers_to].payload
        assert bytes(payload).decode() == (row.html or "") and record.url == row.url


def test_frames_stand_alone(spark, sf_dir, folder, monkeypatch):
    archive = op7.write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet").coalesce(1), folder).first()
    data = Path(archive.path.removeprefix("file:")).read_bytes()  # the bytes on disk, whatever pyarrow makes of the name
    magic, size = struct.unpack("<II", data[:8])
    words = zstandard.ZstdCompressionDict(data[8:8 + size])
    assert magic == 0x184D2A5D and words.dict_id() != 0 and len(data) == archive.n_bytes
    frames, rest = 0, data[8 + size:]
    while rest:
        one = zstandard.ZstdDecompressor(dict_data=words).decompressobj()
        assert one.decompress(rest).startswith(b"WARC/1.1\r\n")
        rest = one.unused_data
        frames += 1
    assert frames == archive.n_records


def test_small_payloads_are_responses(spark, folder):
    rows = op7.read_archives(op7.write_archives(spark.createDataFrame(ROWS, PAGES), folder, min_bytes=5)).collect()
    assert {row.record_type for row in rows if row.payload_bytes < 5} == {"response"}
    assert [row.refers_to for row in rows if row.page_id == 1] == [2]


def test_records_are_read_by_offset(spark, sf_dir, folder, monkeypatch):
    archives = op7.write_archives(spark.createDataFrame(ROWS, PAGES), folder)
    every = sorted(map(tuple, op7.read_archives(archives).collect()), key=str)
    index = op7.record_index(archives).collect()
    assert sorted(str(row.page_id) for row in index) == sorted(str(row[0]) for row in ROWS)
    for row in index:
        [(fields, block)] = op7.read_at(row.path, [(row.offset, row.n_bytes)])
        assert op7.page_of(fields["WARC-Record-ID"]) == row.page_id
        assert int(fields["Content-Length"]) == len(block)
    ids = spark.createDataFrame([(6, "a"), (7, "a"), (7, "b"), (None, "a"), (99, "a")], "page_id long, path string")
    found = sorted(map(tuple, op7.fetch_records(archives, ids).collect()), key=str)
    assert found == [row for row in every if row[0] in (6, 7, None)]
    assert op7.fetch_records(archives, ids.limit(0)).count() == 0
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    real = op7.write_archives(pages, folder)
    some = pages.filter("page_id % 20 = 0").select("page_id")
    expected = op7.read_archives(real).join(some, "page_id", "left_semi")
    assert sorted(map(tuple, op7.fetch_records(real, some).collect())) == sorted(map(tuple, expected.collect()))


@pytest.mark.parametrize("path, uri", [
    ("s3a://bucket/a/b.warc.zst", "s3://bucket/a/b.warc.zst"), ("dbfs:/a/b", "/dbfs/a/b"), ("file:/a/b", "/a/b"),
    ("file:///a/b", "/a/b"), ("/a/b", "/a/b"), ("/a:b/c", "/a:b/c"), ("gs://bucket/a", "gs://bucket/a"),
    ("wasbs://c@account/a", "abfss://c@account/a")])
def test_schemes_of_shared_folders(path, uri, monkeypatch):
    class Known:
        from_uri = staticmethod(lambda given: given)

    monkeypatch.setattr(op7, "FileSystem", Known)
    assert op7.place_of(path) == uri


def test_archives_roll_over(spark, sf_dir, folder):
    writer = op7.ArchiveWriter(folder)
    records = [op7.record_bytes(k, f"http://x/{k}", b"y" * k, digest("y" * k), None, False, "1970-01-01T00:00:00Z")
               for k in range(3)]
    for k, record in enumerate(records):
        writer.add(record, k)
    path, first, count, *_ = writer.close()
    assert (first, count) == (0, 3) and [int(f["WARC-Record-ID"].split(":")[2]) for f, _ in op7.read_records(path)] == [0, 1, 2]
    assert op7.read_archives(op7.write_archives(spark.createDataFrame([], PAGES), folder)).count() == 0
