"""Headers of snapshot files, read without reading the files.

A listing (path, time, size; no content) is a DataFrame. Its rows are dealt to
tasks, which open the first block of each file and give back its first line, so
finding the headers costs one small read a file, however large the files are,
and what was found stays a table: only the distinct headers, one per schema
version, reach the driver.
"""

from __future__ import annotations

import bz2
import csv
import re
import zlib
from collections.abc import Callable, Iterator
from functools import cache

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

HEADER_SCHEMA = "file string, header string"
# Compressions whose files Spark cannot split (one task per file),
# and those of them whose first line this module can read.
UNSPLITTABLE = (".gz", ".deflate", ".zst", ".lz4", ".snappy", ".zip")
READABLE = (".gz", ".deflate", ".zst")
UNSPLITTABLE_PATTERN = r"(?i)\.(gz|deflate|zst|lz4|snappy|zip)$"


class NoSnapshotFiles(ValueError):
    """The pattern matched no file."""


def unsplittable(path: str) -> bool:
    return path.lower().endswith(UNSPLITTABLE)


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with its scheme and host, as listings show it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(where).toString()


def list_files(spark: SparkSession, paths: str | list[str], pattern: str | None = None,
               recursive: bool = True) -> DataFrame:
    """(path, file, modified): the files below ``paths``, whose names match the
    glob ``pattern``. ``file`` is the path as ``_metadata.file_path`` spells it.
    With ``recursive=False`` only those directly in the folder ``paths``."""
    # recursiveFileLookup also turns partition discovery off, so folders named
    # like partitions (TimeID=5) are nothing special
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)
    where = paths if recursive or pattern is None else f"{paths.rstrip('/')}/{pattern}"
    try:
        files = reader.load(where).select("path", F.col("_metadata.file_path").alias("file"),
                                          F.col("modificationTime").alias("modified"))
    except AnalysisException as e:  # missing folder, or no file matches
        raise NoSnapshotFiles(f"no files matching {pattern!r} in {paths!r}: {e}") from None
    if not recursive:  # a folder may match the pattern too; its files do not count
        folder = qualified(spark, paths).rstrip("/")
        files = files.where(F.regexp_replace("path", "/[^/]*$", "") == folder)
    return files


# in tasks

@cache
def _file_system(scheme: str, authority: str) -> tuple[pafs.FileSystem, str]:
    if scheme in ("", "file"):
        return pafs.LocalFileSystem(), ""
    fs, base = pafs.FileSystem.from_uri(f"{'s3' if scheme == 's3a' else scheme}://{authority}/")
    return fs, base.rstrip("/")


def open_file(path: str) -> pa.NativeFile:
    """A file by the path a Spark listing shows, as a stream of its bytes."""
    scheme, authority, where = re.fullmatch(r"(?:([A-Za-z][A-Za-z0-9+.-]*):(?://([^/]*))?)?(/.*)", path).groups("")
    fs, base = _file_system(scheme.lower(), authority)
    return fs.open_input_stream(base + where, compression=None)


def _decoder(path: str) -> Callable[[bytes], bytes]:
    name = path.lower()
    if name.endswith((".gz", ".deflate")):
        return zlib.decompressobj(zlib.MAX_WBITS | 32).decompress  # either frame, by its first bytes
    if name.endswith(".bz2"):
        return bz2.BZ2Decompressor().decompress
    if name.endswith(".zst"):
        import zstandard
        return zstandard.ZstdDecompressor().decompressobj().decompress
    if unsplittable(path):
        raise ValueError(f"the first line of {path} cannot be read: unknown compression")
    return lambda data: data


def first_line(path: str, block: int = 1 << 14, longest: int = 1 << 20) -> str:
    """The first line of a file, of which no more blocks than needed are read."""
    decode, text = _decoder(path), b""
    with open_file(path) as stream:
        while b"\n" not in text and b"\r" not in text and len(text) <= longest:
            data = stream.read(block)
            if not data:
                break
            text += decode(data)
    return re.split(rb"\r\n|\n|\r", text, maxsplit=1)[0].decode("utf-8", "replace").lstrip("\ufeff")


def first_lines(files: DataFrame, n_files: int, files_a_task: int = 200) -> DataFrame:
    """(file, header) of each of ``n_files`` ``files`` (path, file): its first line."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 1000):
                part = batch.slice(k, 1000)
                yield pa.RecordBatch.from_arrays(
                    [part.column("file"), pa.array([first_line(p) for p in part.column("path").to_pylist()], pa.string())],
                    names=["file", "header"])

    # a row is a whole file, so the rows are dealt evenly, whatever their own size
    tasks = max(1, min(n_files // files_a_task + 1, 20_000))
    return files.select("path", "file").repartition(tasks).mapInArrow(read, HEADER_SCHEMA)


# versions

def header_names(header: str) -> tuple[str, ...]:
    """Column names of a header line."""
    return tuple(n.strip() for n in next(csv.reader([header]), []))


class Version:
    """One order of the schema's columns, with the header lines that give it."""

    def __init__(self, names: tuple[str, ...]):
        self.names, self.headers = names, []


def versions_of(headers: DataFrame, schema: T.StructType, renames: dict[str, str], most: int = 1000) -> list[Version]:
    """The column orders in a table of (file, header), after the renames. Headers
    are grouped by Spark; a file whose header does not name exactly the schema's
    columns fails the load, and so do more than ``most`` different headers."""
    found = (headers.groupBy("header").agg(F.count("*").alias("n"), F.min("file").alias("example"))
             .orderBy(F.desc("n"), "header").limit(most + 1).collect())
    wanted = sorted(schema.fieldNames())
    bad = {}
    versions: dict[tuple[str, ...], Version] = {}
    for r in found:
        names = tuple(renames.get(n, n) for n in header_names(r.header))
        if sorted(names) != wanted:
            bad[r.example] = r.n
        else:
            versions.setdefault(names, Version(names)).headers.append(r.header)
    if bad:
        raise ValueError(f"{sum(bad.values())} files have no header of the schema {schema.fieldNames()}, "
                         f"e.g. {sorted(bad)[:3]}")
    if len(found) > most:
        raise ValueError(f"more than {most} different headers")
    return list(versions.values())
