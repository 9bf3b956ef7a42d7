"""WARC archives with a Zstandard dictionary.

An archive is a ``.warc.zst`` file: a skippable frame with the dictionary, then
one frame per record, compressed with it. The dictionary is built from archived
records, the same for all archives of a run. Every task writes archives of its
own; the run's manifest, a table that Spark commits, names those of successful
tasks, so files of a task that was lost or ran twice are never read.
"""

from __future__ import annotations

import hashlib
import io
import re
import uuid
from collections.abc import Callable, Iterator
from typing import NamedTuple
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.operators.joins import checked_broadcast
from starmart.session import materialize, scratch_path

# Fixed values of the formats.
DICTIONARY_FRAME = (0x184D2A5D).to_bytes(4, "little")
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MANIFEST_SCHEMA = "path string, n_records long, n_bytes long"
RECORD_SCHEMA = ("id string, url string, record_type string, payload_bytes long, payload_digest string, "
                 "refers_to string, payload binary")


# records

class Page(NamedTuple):
    row_id: int
    id: str | None
    url: str | None
    digest: str
    payload: bytes
    revisits: bool
    first_row: int | None
    first_id: str | None


def _record_id(row_id: int, digest: str) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(f'{row_id}:{digest}'.encode()).digest()[:16], version=4)}>"


def _target(page: Page) -> str:
    """The address as a header value: nothing in it may end the line."""
    if not page.url:
        return "urn:page:" + quote(page.id or "", safe="")
    return re.sub(r"[\x00-\x20\x7f-\x9f  ]", lambda m: quote(m[0]), page.url)


def _framed(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [VERSION, *(f"{k}: {v}".encode("utf-8", "surrogatepass") for k, v in headers),
             b"Content-Length: %d" % len(block)]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def page_record(page: Page, date: str) -> bytes:
    """The bytes of a response, or of a revisit without the payload."""
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
            % len(page.payload))
    headers = [("WARC-Type", "revisit" if page.revisits else "response"),
               ("WARC-Record-ID", _record_id(page.row_id, page.digest)), ("WARC-Date", date),
               ("WARC-Target-URI", _target(page)), ("WARC-Payload-Digest", f"sha256:{page.digest}"),
               ("Content-Type", "application/http; msgtype=response")]
    if page.id is not None:
        headers.append(("Page-ID", quote(page.id, safe="")))
    if page.revisits:
        headers += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", _record_id(page.first_row, page.digest))]
        if page.first_id is not None:
            headers.append(("Refers-To-Page-ID", quote(page.first_id, safe="")))
        return _framed(headers, http)
    return _framed(headers, http + page.payload)


def _info_record(date: str) -> bytes:
    return _framed([("WARC-Type", "warcinfo"), ("WARC-Record-ID", _record_id(-1, date)), ("WARC-Date", date),
                    ("Content-Type", "application/warc-fields")], b"format: WARC file version 1.1\r\n")


# writing

def _open(folder: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder in the shared store, as tasks see it."""
    return pafs.FileSystem.from_uri(folder)


class _Archive:
    """One archive file under way."""

    def __init__(self, folder: str, dictionary: bytes | None, level: int, date: str):
        fs, where = _open(folder)
        fs.create_dir(where, recursive=True)
        self.name = f"pages-{uuid.uuid4().hex}.warc.zst"  # of this attempt alone
        self.file = fs.open_output_stream(f"{where}/{self.name}", compression=None)
        # the length and a checksum stand in every frame
        self.compressor = zstandard.ZstdCompressor(
            level=level, write_checksum=True,
            dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
        self.n_records = self.n_bytes = 0
        if dictionary:
            self._put(DICTIONARY_FRAME + len(dictionary).to_bytes(4, "little") + dictionary)
        self._put(self.compressor.compress(_info_record(date)))

    def _put(self, data: bytes) -> None:
        self.file.write(data)
        self.n_bytes += len(data)

    def add(self, record: bytes) -> None:
        self._put(self.compressor.compress(record))
        self.n_records += 1

    def close(self) -> tuple[str, int, int]:
        self.file.close()
        return self.name, self.n_records, self.n_bytes


def _writer(folder: str, dictionary: bytes | None, level: int, date: str, max_bytes: int
            ) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive: _Archive | None = None
        done = []
        for batch in batches:
            for i in range(batch.num_rows):
                page = Page(**{c: batch.column(c)[i].as_py() for c in Page._fields})
                archive = archive or _Archive(folder, dictionary, level, date)
                archive.add(page_record(page, date))
                if archive.n_bytes >= max_bytes:
                    done.append(archive.close())
                    archive = None
        if archive is not None:
            done.append(archive.close())
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*done, strict=True), (pa.string(), pa.int64(), pa.int64()), strict=True)],
                names=["path", "n_records", "n_bytes"])

    return write


def build_dictionary(records: list[bytes], size: int) -> bytes | None:
    """A dictionary trained on records, None if they are too few or too short."""
    try:
        return zstandard.train_dictionary(size, records).as_bytes()
    except zstandard.ZstdError:
        return None


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", date: str = "2000-01-01T00:00:00Z", min_revisit: int = 100,
                   dictionary_bytes: int = 1 << 16, sample_records: int = 1000, sample_record_bytes: int = 1 << 16,
                   level: int = 3, max_bytes: int = 1 << 30) -> DataFrame:
    """Write one record per row to archives in ``folder`` and return the
    manifest (path, n_records, n_bytes), which is kept in ``<folder>/manifest``.

    Payload is ``payload_col`` in UTF-8, null counts as empty. Of rows with equal
    payloads of at least ``min_revisit`` bytes, the one with the smallest id (null
    last; of equal ids the smallest address, then any one) becomes a response, the
    others revisits of it; shorter payloads are responses always. A null or empty
    address is archived as ``urn:page:<id>``; ``date`` is stated by the caller, as
    the table holds none. An empty table writes no archive.

    The dictionary is trained on about ``sample_records`` records (at most twice as
    many, none with a payload above ``sample_record_bytes``), drawn by hash over the
    whole table; it changes the archives' size, not their records. Too few records
    train none, then archives have no dictionary frame. ``folder`` must be an address
    that all executors reach and pyarrow opens. An archive ends beyond ``max_bytes``.
    """
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary")
    rows = materialize(
        pages.select(F.monotonically_increasing_id().alias("row_id"), F.col(id_col).alias("id"),
                     F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
        .withColumn("digest", F.sha2("payload", 256)).withColumn("n_bytes", F.octet_length("payload")), "warc-rows")
    repeated = materialize(
        rows.where(F.col("n_bytes") >= min_revisit).groupBy("digest")
        .agg(F.count("*").alias("n"), F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "url", "row_id")).alias("first"))
        .where("n > 1").select(F.col("digest").alias("copy_digest"), F.col("first.row_id").alias("first_row"),
                               F.col("first.id").cast("string").alias("first_id")), "warc-repeated")
    # the groups of copies are broadcast if they are few; else rows meet them by digest
    decided = rows.join(checked_broadcast(repeated), F.col("digest") == F.col("copy_digest"), "left").select(
        "row_id", F.col("id").cast("string").alias("id"), "url", "digest",
        F.when(F.coalesce(F.col("first_row") != F.col("row_id"), F.lit(False)), True).otherwise(False).alias("revisits"),
        "first_row", "first_id", "payload")

    one_in = max(1, rows.count() // sample_records)
    sample = (rows.where((F.col("n_bytes") <= sample_record_bytes)
                         & (F.pmod(F.xxhash64("digest", "row_id"), F.lit(one_in)) == 0))
              .select("row_id", F.col("id").cast("string").alias("id"), "url", "digest", "payload")
              .limit(2 * sample_records).collect())
    trained = build_dictionary(
        [page_record(Page(r["row_id"], r["id"], r["url"], r["digest"], bytes(r["payload"]), False, None, None), date)
         for r in sorted(sample, key=lambda r: (r["digest"], r["row_id"]))], dictionary_bytes)

    manifest = f"{folder}/manifest"
    decided.mapInArrow(_writer(folder, trained, level, date, max_bytes), MANIFEST_SCHEMA).write.parquet(manifest)
    return pages.sparkSession.read.parquet(manifest)


# reading

def records_of(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record of an archive, one after another."""
    magic = stream.read(4)
    dictionary = None
    if magic == DICTIONARY_FRAME:
        dictionary = zstandard.ZstdCompressionDict(stream.read(int.from_bytes(stream.read(4), "little")))
        magic = b""
    decompressor = zstandard.ZstdDecompressor(dict_data=dictionary)
    rest = stream if not magic else _After(magic, stream)
    text = io.BufferedReader(decompressor.stream_reader(rest, read_across_frames=True), 1 << 18)
    while line := text.readline():
        if line.strip() != VERSION:
            raise ValueError(f"not the start of a record: {line[:40]!r}")
        headers = {}
        while (line := text.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode("utf-8", "surrogatepass").rstrip("\r\n").partition(": ")
            headers[name] = value
        length = int(headers["Content-Length"])
        block = text.read(length)
        if len(block) < length or text.read(4) != b"\r\n\r\n":
            raise ValueError(f"record {headers.get('WARC-Record-ID')} is cut off")
        yield headers, block


class _After(io.RawIOBase):
    """A stream with some bytes put back before it."""

    def __init__(self, first: bytes, rest: io.BufferedIOBase):
        self.first, self.rest = first, rest

    def readable(self) -> bool:
        return True

    def read(self, size: int = -1) -> bytes:
        if self.first:
            out, self.first = self.first, b""
            return out
        return self.rest.read(size)


def page_of(headers: dict[str, str], block: bytes) -> dict | None:
    """A page record as a row of ``RECORD_SCHEMA``; None for other records. A
    response whose payload doesn't have the stated digest is an error."""
    kind = headers["WARC-Type"]
    if kind not in ("response", "revisit"):
        return None
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
    length = int(re.search(rb"(?im)^Content-Length: (\d+)", http)[1])
    if kind == "response" and (len(payload) != length or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"record {headers['WARC-Record-ID']} holds another payload than it says")

    def name(field: str) -> str | None:
        return unquote(headers[field]) if field in headers else None

    return {"id": name("Page-ID"), "url": headers["WARC-Target-URI"], "record_type": kind, "payload_bytes": length,
            "payload_digest": digest, "refers_to": name("Refers-To-Page-ID"),
            "payload": payload if kind == "response" else None}


def read_archives(spark: SparkSession, folder: str, id_type: str = "string", with_payload: bool = True,
                  rows_a_batch: int = 512, bytes_a_batch: int = 8 << 20) -> DataFrame:
    """One row per page record of the archives named in ``<folder>/manifest``:
    ``RECORD_SCHEMA`` with both ids cast to ``id_type``. ``payload`` is null for
    revisits, and for all rows unless ``with_payload``. Tasks read archive after
    archive as streams and hold one record and one batch."""
    manifest = spark.read.parquet(f"{folder}/manifest").select("path")
    schema = pa.schema([("id", pa.string()), ("url", pa.string()), ("record_type", pa.string()),
                        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.string()),
                        ("payload", pa.binary())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, where = _open(folder)
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows, n_bytes = [], 0
                with fs.open_input_stream(f"{where}/{path}", compression=None) as stream:
                    for record in records_of(stream):
                        row = page_of(*record)
                        if row is None:
                            continue
                        if not with_payload:
                            row["payload"] = None
                        rows.append(row)
                        n_bytes += len(row["payload"] or b"")
                        if len(rows) >= rows_a_batch or n_bytes >= bytes_a_batch:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, n_bytes = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    # one row is a whole archive, so the rows are dealt evenly, whatever their own size
    dealt = manifest.repartition(max(1, min(manifest.count(), 10_000)))
    return dealt.mapInArrow(read, RECORD_SCHEMA).withColumns(
        {"id": F.col("id").cast(id_type), "refers_to": F.col("refers_to").cast(id_type)})


def archive_pages(pages: DataFrame, id_col: str = "page_id", folder: str | None = None, **options) -> DataFrame:
    """Write ``pages`` to archives (``write_archives``) and read them back: per row
    ``id_col``, ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to``.
    Without ``folder`` the archives go below the session's checkpoint folder."""
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    write_archives(pages, folder, id_col, **options)
    found = read_archives(spark, folder, pages.schema[id_col].dataType.simpleString(), with_payload=False)
    return found.select(F.col("id").alias(id_col), "payload_bytes", "payload_digest", "record_type", "refers_to")
