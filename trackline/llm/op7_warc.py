"""WARC archives in Zstandard: a dictionary from the archive's own records leads in a skippable frame, and every
record is a frame of its own, so that any record can be read by its offset."""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from itertools import groupby
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackline.llm.common import arrow_map, scratch_dir, table, written

# Fixed values of the WARC and Zstandard formats.
SKIPPABLE = 0x184D2A5D
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Bytes of records an archive takes before the next is begun; what a dictionary is trained on, and its size; bytes.
ARCHIVE_BYTES, SAMPLE_BYTES, DICTIONARY_BYTES = 64 << 20, 1 << 20, 32 << 10
MIN_REVISIT_BYTES = 0
LEVEL = 3
MANIFEST = ("path string, first_page long, n_records long, n_bytes long, pages array<bigint>, "
            "offsets array<bigint>")
RECORDS = [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
           ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
           ("payload", pa.binary())]
RECORDS_DDL = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
               "refers_to long, payload binary")


def place_of(path: str) -> tuple[FileSystem, str]:
    """The file system of a path as Spark writes it, and the path on it.

    Hadoop's names for object stores are mapped to those pyarrow knows (s3a and s3n are s3, wasb and wasbs abfs and
    abfss), and dbfs:/ is the mount /dbfs.
    """
    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme:
        return FileSystem.from_uri(path)
    if scheme == "dbfs":
        return FileSystem.from_uri("/dbfs/" + rest.lstrip("/"))
    if scheme == "file":
        return FileSystem.from_uri("/" + rest.lstrip("/"))
    known = {"s3a": "s3", "s3n": "s3", "wasb": "abfs", "wasbs": "abfss"}
    return FileSystem.from_uri(f"{known.get(scheme, scheme)}:{rest}")


def record_id(page: int | None, digest: str) -> str:
    return f"<urn:page:{'none' if page is None else page}:{digest}>"


def page_of(name: str) -> int | None:
    page = name.strip("<>").split(":")[2]
    return None if page == "none" else int(page)


def record_bytes(page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None,
                 revisit: bool, date: str) -> bytes:
    """One WARC record; a revisit carries the HTTP header without the payload."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
            .encode())
    block = http if revisit else http + payload
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page, digest)),
              ("WARC-Date", date), ("WARC-Payload-Digest", f"sha1:{digest}"),
              ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    if url is not None:  # characters that would end the header line are escaped, and "%" so that reading undoes it
        fields.append(("WARC-Target-URI", quote(url, safe="!#$&'()*+,/:;=?@[]~")))
    if revisit:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(refers_to, digest))]
    head = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict:
    """Trained on a bounded sample, the archive's first records; too few of them serve as raw content."""
    sample, size = [], 0
    for record in records:
        sample.append(record[:SAMPLE_BYTES - size])
        size += len(sample[-1])
        if size >= SAMPLE_BYTES:
            break
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, sample)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(sample)[-DICTIONARY_BYTES:],
                                             dict_type=zstandard.DICT_TYPE_RAWCONTENT)


class ArchiveWriter:
    """Writes records to one archive; the first ones wait until the dictionary's sample is complete."""

    def __init__(self, folder: str):
        self.path = f"{folder}/{uuid.uuid4().hex}.warc.zst"
        files, place = place_of(self.path)
        files.create_dir(place.rsplit("/", 1)[0], recursive=True)
        self.out = files.open_output_stream(place, compression=None)  # by default the name's .zst adds a second layer
        self.waiting, self.compressor = [], None
        self.pages, self.offsets = [], []
        self.size, self.written, self.held = 0, 0, 0

    def add(self, record: bytes, page: int | None) -> None:
        self.pages.append(page)
        self.size += len(record)
        if self.compressor:
            self._frame(record)
            return
        self.waiting.append(record)
        self.held += len(record)
        if self.held >= SAMPLE_BYTES:
            self._begin()

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.written += len(data)

    def _frame(self, record: bytes) -> None:
        self.offsets.append(self.written)
        self._write(self.compressor.compress(record))

    def _begin(self) -> None:
        words = dictionary(self.waiting)
        self._write(struct.pack("<II", SKIPPABLE, len(words.as_bytes())) + words.as_bytes())
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=words, write_content_size=True)
        for record in self.waiting:
            self._frame(record)
        self.waiting = []

    def close(self) -> tuple:
        """A row of the list of archives."""
        if not self.compressor:
            self._begin()
        self.out.close()
        return self.path, next(iter(self.pages), None), len(self.pages), self.written, self.pages, self.offsets


def _write(batches: Iterator[pa.RecordBatch], folder: str, date: str) -> Iterator[pa.RecordBatch]:
    writer, done = None, []
    for batch in batches:
        for page, url, html, sha1, last, revisit in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            payload = (html or "").encode("utf-8", "surrogatepass")
            digest = base64.b32encode(bytes.fromhex(sha1)).decode()
            writer = writer or ArchiveWriter(folder)
            writer.add(record_bytes(page, url, payload, digest, last, revisit, date), page)
            if writer.size >= ARCHIVE_BYTES:
                done.append(writer.close())
                writer = None
    if writer:
        done.append(writer.close())
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))
    columns = [pa.array(values, kind)
               for values, kind in zip(zip(*done, strict=True) if done else [[]] * len(kinds), kinds, strict=True)]
    yield pa.RecordBatch.from_arrays(columns, names=["path", "first_page", "n_records", "n_bytes", "pages", "offsets"])


def marked(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES, id_col: str = "page_id", url_col: str = "url",
           html_col: str = "html") -> DataFrame:
    """(page_id, url, html, sha1, last, revisit): of equal payloads that with the largest id is the response.

    Digests and ids alone are grouped, with partial sums before the shuffle. Only digests that occur twice meet the
    pages again, in a join whose frequent keys Spark can split.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                        F.col(html_col).alias("html"), F.sha1(F.coalesce(F.col(html_col), F.lit(""))).alias("sha1"))
    equal = rows.groupBy("sha1").agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n"))
    found = rows.join(equal.filter("n > 1").drop("n"), "sha1", "left")
    revisit = (F.octet_length(F.coalesce("html", F.lit(""))) >= min_bytes) & F.col("last").isNotNull() & ~F.col(
        "page_id").eqNullSafe(F.col("last"))
    return found.select("page_id", "url", "html", "sha1", "last", revisit.alias("revisit"))


def write_archives(pages: DataFrame, folder: str, min_bytes: int = MIN_REVISIT_BYTES,
                   date: str = "1970-01-01T00:00:00Z", **columns: str) -> DataFrame:
    """Write every page to archives in `folder` (shared by all executors) and return their list as a table.

    A row names an archive, its first page, its records and bytes, and page and offset of every record in order.
    A task names its files at random and lists them in its result rows. Only the rows of tasks that succeeded are
    kept, so files of a lost or repeated attempt are never read.
    """
    rows = marked(pages, min_bytes, **columns)
    return written(arrow_map(rows, _write, MANIFEST, folder, date), "warc-archives")


def _dictionary_of(source, path: str) -> zstandard.ZstdCompressionDict:
    magic, size = struct.unpack("<II", source.read(8))
    if magic != SKIPPABLE:
        raise ValueError(f"{path} does not begin with a dictionary frame")
    return zstandard.ZstdCompressionDict(source.read(size))


def _parsed(record: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    return fields, rest[:int(fields["Content-Length"])]


def read_at(path: str, places: list[tuple[int, int]]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Fields and block of the records at these (offset, bytes) of one archive; nothing but these is read."""
    files, place = place_of(path)
    with files.open_input_file(place) as source:
        reader = zstandard.ZstdDecompressor(dict_data=_dictionary_of(source, path))
        for offset, size in places:
            source.seek(offset)
            yield _parsed(reader.decompress(source.read(size)))


def read_records(path: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """The fields and the block of every record of one archive, one record in memory at a time."""
    files, place = place_of(path)
    with files.open_input_stream(place, compression=None) as source:
        words = _dictionary_of(source, path)
        reader = zstandard.ZstdDecompressor(dict_data=words).stream_reader(source, read_across_frames=True,
                                                                           read_size=1 << 20)
        held = bytearray()

        def more() -> bool:
            data = reader.read(1 << 20)
            held.extend(data)
            return bool(data)

        while True:
            while (end := held.find(b"\r\n\r\n")) < 0 and more():
                pass
            if end < 0:
                if held:
                    raise ValueError(f"{path} ends inside a record")
                return
            fields = dict(line.split(": ", 1) for line in held[:end].decode().split("\r\n")[1:])
            till = end + 4 + int(fields["Content-Length"])
            while len(held) < till + 4:
                if not more():
                    raise ValueError(f"{path} ends inside a record")
            yield fields, bytes(held[end + 4:till])
            del held[:till + 4]


def _row(fields: dict[str, str], block: bytes, path: str, with_payload: bool) -> tuple:
    """A record as a row of RECORDS, its payload checked against its digest."""
    head, _, payload = block.partition(b"\r\n\r\n")
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    length = int(head.rpartition(b"Content-Length: ")[2])
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != length
                        or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"{path}: the payload of {fields['WARC-Record-ID']} is not what was written")
    url = fields.get("WARC-Target-URI")
    return (page_of(fields["WARC-Record-ID"]), None if url is None else unquote(url), length, digest,
            fields["WARC-Type"], page_of(fields["WARC-Refers-To"]) if revisit else None,
            payload if with_payload and not revisit else None)


def _batched(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 100 + len(row[-1] or b"")
        if size >= 8 << 20:
            yield _batch(held)
            held, size = [], 0
    yield _batch(held)


def _read(batches: Iterator[pa.RecordBatch], with_payload: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column("path").to_pylist():
            yield from _batched(_row(fields, block, path, with_payload) for fields, block in read_records(path))


def _fetch(batches: Iterator[pa.RecordBatch], with_payload: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = zip(*(batch.column(name).to_pylist() for name in ("path", "offset", "n_bytes")), strict=True)
        for path, group in groupby(rows, key=lambda row: row[0]):
            yield from _batched(_row(fields, block, path, with_payload)
                                for fields, block in read_at(path, [row[1:] for row in group]))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(RECORDS)
    return pa.RecordBatch.from_arrays([pa.array(values, kind) for values, (_, kind) in zip(columns, RECORDS,
                                                                                        strict=True)],
                                      names=[name for name, _ in RECORDS])


def read_archives(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """Every record of the listed archives; a response's payload is checked against its digest.

    A revisit has no payload of its own, only its digest and length and, in refers_to, the page that has it.
    """
    dealt = archives.select("path").repartition(max(1, archives.count()), "path")
    return arrow_map(dealt, _read, RECORDS_DDL, with_payload)


def record_index(archives: DataFrame) -> DataFrame:
    """(page_id, path, offset, n_bytes) of every record of the listed archives."""
    ends = F.concat(F.slice("offsets", 2, F.greatest(F.size("offsets") - 1, F.lit(0))), F.array("n_bytes"))
    places = F.explode(F.arrays_zip("pages", "offsets", ends.alias("ends"))).alias("at")
    return archives.select("path", places).select(F.col("at.pages").alias("page_id"), "path",
                                                  F.col("at.offsets").alias("offset"),
                                                  (F.col("at.ends") - F.col("at.offsets")).alias("n_bytes"))


def fetch_records(archives: DataFrame, ids: DataFrame, id_col: str = "page_id", with_payload: bool = True) -> DataFrame:
    """The records of the pages in `ids`, each once, as `read_archives` gives them; other records are not read.

    A null id stands for pages without one. Ids without a record and repeated ids add nothing. Places are sorted in
    the task, so neighbours of one archive are read with one dictionary.
    """
    wanted = ids.select(F.col(id_col).cast("long").alias("wanted")).distinct()
    index = record_index(archives)
    found = index.join(wanted, index["page_id"].eqNullSafe(wanted["wanted"]), "left_semi")
    found = found.select("path", "offset", "n_bytes").sortWithinPartitions("path", "offset")
    return arrow_map(found, _fetch, RECORDS_DDL, with_payload)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive every page and read the archives back.

    A null html is an empty payload, a null url is left out of the record. A null page_id counts as the smallest;
    pages with equal payloads and only null ids are all responses, and so are repeated rows of the largest id. An
    empty table gives no archive and no rows. Other columns play no part.
    """
    archives = write_archives(table(spark, sf_dir, "pages"), f"{scratch_dir(spark)}/warc-{uuid.uuid4().hex}")
    return read_archives(archives, with_payload=False).drop("url", "payload")


SQL = f"""
WITH hashed AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes,
         sha1(coalesce(html, '')) AS h FROM pages
), named AS (
  SELECT page_id, payload_bytes, h, array_to_string(list_transform(range(32), lambda i: substr(
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((('0x' || substr(h, (i // 4) * 5 + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31) + 1, 1)), '') AS payload_digest,
    max(page_id) OVER (PARTITION BY h) AS last
  FROM hashed
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= {MIN_REVISIT_BYTES} AND page_id <> last THEN 'revisit' ELSE 'response' END
         AS record_type,
       CASE WHEN payload_bytes >= {MIN_REVISIT_BYTES} AND page_id <> last THEN last END AS refers_to
FROM named
"""
