"""CSV snapshots: discovery, header-drift-safe multi-file load, stage tables.

The reference reads one file at a time with type inference (two scans per
file) and folds the frames with a positional ``union``, so a renamed column
silently lands under the first file's name, and file order decides whether
the job runs. Here:

* files are listed by the file source itself (``binaryFile`` without its
  content: nothing is read), so the listing works on any Hadoop file system;
* the header of each file comes from its first block, read by tasks
  (``sources/headers.py``); headers stay in a table, of which the driver sees
  the distinct ones, one per schema version;
* all files are then read by ONE text scan, whose lines are parsed with a fixed
  schema in the column order of their file's header. Where all headers have one
  order, whatever the names, no line needs to know its file;
* a file whose header does not name the schema's columns fails the load before
  any data is read;
* columns are matched by name after the rename map, never by position.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart import schemas
from starmart.operators.joins import checked_broadcast
from starmart.session import materialize
from starmart.sources.headers import (UNSPLITTABLE_PATTERN, NoSnapshotFiles, Version, first_lines, header_names,
                                      list_files, unsplittable, versions_of)

PROVENANCE = "_source_file"
PROVENANCE_TYPE = T.StructType([T.StructField("at", T.TimestampType()), T.StructField("path", T.StringType())])


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None,
             infer: bool = False, header: bool = True, mode: str = "PERMISSIVE",
             check_header: bool = False) -> DataFrame:
    """CSV scan. An explicit ``schema`` is the default; ``infer=True`` keeps the
    reference's behaviour (an extra pass over the data to guess types).
    ``mode='FAILFAST'`` aborts on a field that does not fit its type instead
    of reading it as null. ``check_header`` makes Spark compare every file's
    header with the schema's names (by position) and fail on a difference."""
    reader = spark.read.option("header", header).option("mode", mode)
    if check_header:
        reader = reader.option("enforceSchema", False)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def discover_files(spark: SparkSession, directory: str, pattern: str,
                   recursive: bool = False) -> list[str]:
    """Paths of files in ``directory`` (``recursive``: at any depth) whose name
    matches the glob ``pattern``. Sub-folders are ignored unless ``recursive``.
    The whole list comes to the driver; ``load_folder`` and ``read_csv_folder``
    read any number of files without it."""
    paths = [r.path for r in list_files(spark, directory, pattern, recursive).select("path").collect()]
    if not paths:
        raise NoSnapshotFiles(f"no files matching {pattern!r} in {directory!r}")
    return sorted(paths)


def read_csv_folder(spark: SparkSession, directory: str, pattern: str, schema: T.StructType,
                    recursive: bool = False, header: bool = True, mode: str = "PERMISSIVE") -> DataFrame:
    """All files in ``directory`` whose names match ``pattern`` in one scan; the
    listing stays in Spark's file source. No match is an error."""
    if list_files(spark, directory, pattern, recursive).isEmpty():
        raise NoSnapshotFiles(f"no files matching {pattern!r} in {directory!r}")
    reader = (spark.read.schema(schema).option("header", header).option("mode", mode)
              .option("pathGlobFilter", pattern).option("recursiveFileLookup", "true"))
    return reader.csv(directory if recursive else f"{directory.rstrip('/')}/{pattern}")


def canonical_names(header: tuple[str, ...], renames: dict[str, str]) -> list[str]:
    return [renames.get(c, c) for c in header]


def _folder(path: str) -> str:
    return path.rsplit("/", 1)[0]


# ---------------------------------------------------------------- snapshots

def why_bad(line: F.Column, schema: T.StructType) -> F.Column:
    """What is wrong with a CSV line of ``schema``'s columns, as text: the first
    field that does not fit, or the number of fields."""
    n = len(schema.fields)
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    # one column more, so that a line of too many fields shows
    longer = T.StructType([*texts.fields, T.StructField("_more", T.StringType())])
    fields = F.from_csv(line, longer.simpleString(), {"mode": "PERMISSIVE"})
    reason: F.Column = F.lit("not a CSV line of the schema")
    for f in reversed(schema.fields):
        text, kind = fields[f.name], f.dataType.simpleString()
        if isinstance(f.dataType, T.StringType):
            continue
        misfit = text.isNotNull() & text.try_cast(f.dataType).isNull()
        reason = F.when(misfit, F.concat(F.lit(f"{f.name}: \""), text, F.lit(f"\" does not fit {kind}"))).otherwise(reason)
    n_fields = F.size(F.split(line, ","))
    reason = F.when(n_fields < n, F.concat(n_fields.cast("string"), F.lit(f" fields of {n}"))).otherwise(reason)
    return F.when(fields["_more"].isNotNull(), F.lit(f"more than {n} fields")).otherwise(reason)


def _parsed(lines: DataFrame, headers: DataFrame, versions: list[Version], schema: T.StructType,
            options: dict[str, str]) -> DataFrame:
    """``lines`` (value, file, ...) without header and blank lines, with a struct
    ``row`` of ``schema`` and, where lines that do not fit are kept, a ``reason``."""
    by_name = {f.name: f for f in schema.fields}
    # a version's own header lines, of which a byte order mark may be part
    mine = [h for v in versions for h in v.headers]
    lines = lines.where((F.length(F.trim("value")) > 0) & ~F.ltrim("value", F.lit("\ufeff")).isin(mine))

    def row_of(version: Version, corrupt: list[T.StructField]) -> F.Column:
        of_file = T.StructType([*[by_name[n] for n in version.names], *corrupt])
        return F.from_csv("value", of_file.simpleString(), options)

    corrupt = [f for f in schema.fields if f.name == options.get("columnNameOfCorruptRecord")]

    def reason_of(version: Version) -> F.Column:
        return why_bad(F.col("value"), T.StructType([by_name[n] for n in version.names]))

    def reasoned(rows: DataFrame, reason: F.Column) -> DataFrame:
        return rows.withColumn("reason", F.when(F.col("row")[CORRUPT].isNotNull(), reason)) if corrupt else rows

    if len(versions) == 1:
        return reasoned(lines.withColumn("row", row_of(versions[0], corrupt)), reason_of(versions[0]))
    number = {h: k for k, v in enumerate(versions) for h in v.headers}
    # one row a file; 8 bytes of a hash stand for its path
    file_version = materialize(headers.select(
        F.xxhash64("file").alias("of"), F.create_map(*[F.lit(x) for p in number.items() for x in p])[F.col("header")]
        .alias("version")), "file-versions")
    lines = lines.withColumn("of", F.xxhash64("file")).join(checked_broadcast(file_version), "of").drop("of")
    in_order = lambda r: F.struct(*[r[n] for n in schema.fieldNames()])
    row, reason = F.lit(None), F.lit(None)
    for k, v in enumerate(versions):  # the transform parses a line once for all of its fields
        row = F.when(F.col("version") == k, F.transform(F.array(row_of(v, corrupt)), in_order)[0]).otherwise(row)
        reason = F.when(F.col("version") == k, reason_of(v)).otherwise(reason)
    return reasoned(lines.withColumn("row", row), reason).drop("version")


def _spread(spark: SparkSession, read: Callable[[], DataFrame]) -> DataFrame:
    """The lines of ``read()``; those of files that one task must decompress are
    dealt anew, so that one big file does not make one long task."""
    file = F.col("file").rlike(UNSPLITTABLE_PATTERN)  # files are left out by their names, not read
    return read().where(~file).unionByName(
        read().where(file).repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))))


def _load(spark: SparkSession, files: DataFrame, scan: Callable[[], DataFrame], schema: T.StructType,
          renames: dict[str, str], mode: str, provenance: bool, of: str, quarantine: bool = False) -> DataFrame:
    """``files`` (path, file, modified), whose lines ``scan()`` reads, as one frame."""
    n = files.agg(F.count("*").alias("files"), F.count_if(F.col("path").rlike(UNSPLITTABLE_PATTERN)).alias("packed")).first()
    if not n.files:
        raise NoSnapshotFiles(f"no files of {of!r}")
    headers = materialize(first_lines(files, n.files), "file-headers")
    versions = versions_of(headers, schema, renames)
    # without a mode of its own, a field that does not fit aborts the load
    options = {"mode": "PERMISSIVE" if quarantine else mode}
    of_lines = schema
    if quarantine:
        options["columnNameOfCorruptRecord"] = CORRUPT
        of_lines = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])

    def lines() -> DataFrame:
        return scan().select("value", F.col("_metadata.file_path").alias("file"),
                             F.col("_metadata.file_modification_time").alias("at"))

    parsed = _parsed(_spread(spark, lines) if n.packed else lines(), headers, versions, of_lines, options)
    extra = [F.struct("at", F.col("file").alias("path")).alias(PROVENANCE)] if provenance else []
    if quarantine:
        extra += [F.col(f"row.{CORRUPT}").alias(CORRUPT), F.col("file").alias("_file"), F.col("reason").alias("_reason")]
    return parsed.select(*[F.col(f"row.{n}").alias(n) for n in schema.fieldNames()], *extra)


CORRUPT = "_corrupt_record"


def load_folder(spark: SparkSession, directory: str, pattern: str, recursive: bool = False,
                schema: T.StructType = schemas.PAYROLL_SCHEMA, renames: dict[str, str] | None = None,
                mode: str = "FAILFAST", provenance: bool = False, quarantine: bool = False) -> DataFrame:
    """The snapshot files in ``directory`` whose names match the glob ``pattern``
    as one frame with ``schema``'s column names and order; any number of files
    under any mixture of header versions. No row per file reaches the driver.

    ``provenance`` and ``mode`` as in ``load_snapshots``; ``quarantine`` keeps
    lines that do not fit, see ``sources/quarantine.py``."""
    renames = schemas.RENAMES if renames is None else renames
    files = list_files(spark, directory, pattern, recursive)
    reader = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
    if recursive:
        scan = lambda: reader.text(directory)
    else:  # files of a folder that matches the pattern itself are left out by their path, not read
        parent = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "")
        some = files.select(F.regexp_replace("file", "/[^/]*$", "")).first()
        folder = some[0] if some else ""
        scan = lambda: reader.text(f"{directory.rstrip('/')}/{pattern}").where(parent == folder)
    return _load(spark, files, scan, schema, renames, mode, provenance, f"{directory}/{pattern}", quarantine)


def load_snapshots(spark: SparkSession, paths: list[str],
                   schema: T.StructType = schemas.PAYROLL_SCHEMA,
                   renames: dict[str, str] | None = None,
                   infer: bool = False, mode: str = "FAILFAST",
                   probe: str = "each_file", provenance: bool = False) -> DataFrame:
    """All snapshot files as one frame with ``schema``'s column names and order.
    For a list of files the caller holds; ``load_folder`` needs none.

    ``provenance`` adds the column ``PROVENANCE``: the file's modification time
    and path, by which a later file wins over an earlier one.

    Pay that does not fit DECIMAL(10,2), or a non-number in a numeric field,
    fails the load (``mode='FAILFAST'``) rather than turning into a null that
    the fill step would make 0. Empty fields are nulls, not errors.

    ``probe='each_file'`` reads the header of every file; ``'per_folder'``, for
    folders known to hold one schema version each, that of one file per folder,
    and Spark checks the others while reading.

    ``infer=True`` reads each group with type inference and lets
    ``unionByName`` widen (int with double gives double), as the reference
    does; the default reads with the fixed ``schema``.
    """
    renames = schemas.RENAMES if renames is None else renames
    if not paths:
        raise NoSnapshotFiles("no snapshot files given")
    if probe not in ("each_file", "per_folder"):
        raise ValueError(f"probe must be 'each_file' or 'per_folder', not {probe!r}")
    if probe == "each_file" and not infer:
        return _load(spark, list_files(spark, paths), lambda: spark.read.option("recursiveFileLookup", "true").text(paths), schema, renames, mode,
                     provenance, f"{paths[0]}, ...")
    return _load_groups(spark, paths, schema, renames, infer, mode, probe, provenance)


def _load_groups(spark: SparkSession, paths: list[str], schema: T.StructType, renames: dict[str, str],
                 infer: bool, mode: str, probe: str, provenance: bool) -> DataFrame:
    """Files by groups of equal headers, each group one CSV scan, in which Spark
    compares every file's header with the group's."""
    if probe == "per_folder":
        firsts: dict[str, str] = {}
        for p in paths:
            firsts.setdefault(_folder(p), p)
        probed = {p: firsts[_folder(p)] for p in paths}
    else:
        probed = {p: p for p in paths}
    asked = sorted(set(probed.values()))
    headers = materialize(first_lines(list_files(spark, asked).withColumn("file", F.col("path")), len(asked)), "file-headers")
    versions_of(headers, schema, renames)  # fails on a strange one
    header_of = {_plain(r.file): header_names(r.header) for r in headers.collect()}
    groups: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for p in paths:
        groups[header_of[_plain(probed[p])]].append(p)

    by_name = {f.name: f for f in schema.fields}
    frames = []
    for header, files in sorted(groups.items()):
        names = canonical_names(header, renames)
        if infer:
            df = read_csv(spark, files, infer=True, mode=mode, check_header=True)
        else:
            # the files' own names (so Spark can check each header), canonical types
            file_schema = T.StructType([T.StructField(h, by_name[n].dataType)
                                        for h, n in zip(header, names)])
            df = read_csv(spark, files, schema=file_schema, mode=mode, check_header=True)
        extra = []
        if provenance:
            df = df.withColumn(PROVENANCE, F.struct(
                F.col("_metadata.file_modification_time").alias("at"), F.col("_metadata.file_path").alias("path")))
            extra = [PROVENANCE]
        df = df.toDF(*names, *extra).select(*schema.fieldNames(), *extra)
        if any(unsplittable(f) for f in files):
            df = df.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
        frames.append(df)
    return reduce(lambda a, b: a.unionByName(b), frames)


def _plain(path: str) -> str:
    """One spelling of a path: ``file:/x``, ``file:///x`` and ``/x`` are the same."""
    return re.sub(r"^file:/+", "/", path)


def load_master(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A master (a CSV file, or a folder of them) by column name: columns in
    any order, headers checked, a value that does not fit fails the load."""
    files = list_files(spark, path).where(F.col("path").rlike(r"\.csv[^/]*$"))

    def scan() -> DataFrame:
        return (spark.read.option("recursiveFileLookup", "true").text(path)
                .where(F.col("_metadata.file_path").rlike(r"\.csv[^/]*$")))

    return _load(spark, files, scan, schema, {}, "FAILFAST", False, path)


ROW_GROUP = 8 << 20  # bytes of a row group of a partitioned stage table: what one task reads at least


def write_stage(df: DataFrame, path: str, partition_by: list[str] | None = None,
                fmt: str = "parquet", rebalance: bool = False) -> str:
    """Hand-off table between stages; overwritten as a whole.

    ``rebalance`` (with ``partition_by``): for rows not grouped by the
    partition columns, a ``rebalance`` hint first gives each write task one
    folder's rows, so a folder gets about size / advisory-size files rather
    than one small file from every task; AQE splits a large folder's rows
    into advisory-size pieces. Leave it off when the rows already arrive
    grouped (a range-ordered frame), as it costs a shuffle."""
    if partition_by and rebalance:
        df = df.hint("rebalance", *partition_by)
    w = df.write.mode("overwrite")
    if partition_by:
        # a folder has few files while the table is small: its readers share their row groups
        w = w.partitionBy(*partition_by).option("parquet.block.size", ROW_GROUP)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)
    return path


def read_stage(spark: SparkSession, path: str, schema: T.StructType | None = None,
               fmt: str = "parquet") -> DataFrame:
    """Re-read a stage with a fixed schema: no second round of type guessing."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        return reader.option("header", True).csv(path)
    return reader.format(fmt).load(path)
