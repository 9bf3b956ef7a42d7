"""Parquet tables clustered along a Z-order curve, with an index of their files.

Rows that are close in several columns lie in the same files, so a lookup by any
of the columns needs few of them. ``write_clustered`` orders the rows by the
interleaved bits of each column's quantile and keeps, next to the rows, a table
of every file's row count and smallest and largest values. ``lookup`` chooses
files from that table; the others are neither listed nor opened, where a plain
filter would read the footer of every file.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BITS = 8  # of a column's quantile: 256 ranges


def quantile_bounds(df: DataFrame, columns: list[str], bits: int = BITS, accuracy: int = 10_000) -> dict[str, list]:
    """For each column the values that cut its rows into ``2 ** bits`` ranges of
    about equal size. One aggregate, combined map-side from sketches; its result
    is that many values a column, whatever the table's size."""
    n = 1 << bits
    shares = F.array(*[F.lit(i / n) for i in range(1, n)])
    row = df.agg(*[F.percentile_approx(c, shares, accuracy).alias(c) for c in columns]).first()
    return {c: list(row[c] or []) for c in columns}


def z_value(bounds: dict[str, list], bits: int = BITS) -> Column:
    """The place of a row on the curve: bits of its columns' ranges in turn. A null
    lies in a column's first range."""
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(bits))])
    z: Column = F.lit(0).cast("long")
    for j, (column, values) in enumerate(bounds.items()):
        if not values:
            continue
        cuts = F.array(*[F.lit(v) for v in values])
        # binary search: how many cuts are not above the value
        place = F.aggregate(steps, F.lit(0), lambda at, step: at + F.when(  # noqa: B023
            F.col(column) >= F.get(cuts, at + step - 1), step).otherwise(0))  # noqa: B023
        spread = lambda p: reduce(Column.bitwiseOR, [  # noqa: B023, E731
            F.shiftleft(F.shiftright(p, i).bitwiseAND(1).cast("long"), i * len(bounds) + j) for i in range(bits)])  # noqa: B023
        # the transform evaluates a place once for all of its bits
        z = z.bitwiseOR(F.transform(F.array(place), spread)[0])
    return z


@dataclass(frozen=True)
class Clustered:
    """A clustered table below ``path``: rows in ``rows``, its index in ``files``."""
    path: str

    @property
    def rows(self) -> str:
        return f"{self.path.rstrip('/')}/rows"

    @property
    def files(self) -> str:
        return f"{self.path.rstrip('/')}/files"


def write_clustered(df: DataFrame, path: str, columns: list[str], n_files: int) -> Clustered:
    """Write ``df`` in about ``n_files`` files along the curve of ``columns``, then
    the index. The order is by range partitioning, which splits values that repeat
    by the row's other cluster columns; rows equal in all of them stay together."""
    table = Clustered(path)
    bounds = quantile_bounds(df, columns)
    placed = df.withColumn("_z", z_value(bounds))
    (placed.repartitionByRange(n_files, "_z", *columns).sortWithinPartitions("_z", *columns).drop("_z")
     .write.mode("overwrite").parquet(table.rows))
    spark = df.sparkSession
    written = spark.read.parquet(table.rows).withColumn("_file", F.col("_metadata.file_path"))
    stats = written.groupBy("_file").agg(
        F.count("*").alias("_rows"), *[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max))])
    stats.write.mode("overwrite").parquet(table.files)
    return table


def files_for(spark: SparkSession, table: Clustered, **ranges) -> DataFrame:
    """Rows of the index whose files may hold rows of ``ranges``: for each column a
    value, or a pair (low, high) of which either may be None."""
    files = spark.read.parquet(table.files)
    for column, wanted in ranges.items():
        low, high = wanted if isinstance(wanted, tuple) else (wanted, wanted)
        if low is not None:
            files = files.where(F.col(f"max_{column}") >= F.lit(low))
        if high is not None:
            files = files.where(F.col(f"min_{column}") <= F.lit(high))
    return files


def lookup(spark: SparkSession, table: Clustered, most_files: int = 10_000, **ranges) -> DataFrame:
    """The rows of ``ranges`` (as in ``files_for``), read from the files that may
    hold them. A range that needs more than ``most_files`` is no lookup: it reads
    the table, and Spark's filters do the rest."""
    schema = spark.read.parquet(table.rows).schema
    chosen = [r["_file"] for r in files_for(spark, table, **ranges).select("_file").limit(most_files + 1).collect()]
    if len(chosen) > most_files:
        rows = spark.read.schema(schema).parquet(table.rows)
    elif chosen:
        rows = spark.read.schema(schema).parquet(*chosen)
    else:
        rows = spark.createDataFrame([], schema)
    for column, wanted in ranges.items():
        low, high = wanted if isinstance(wanted, tuple) else (wanted, wanted)
        if low is not None:
            rows = rows.where(F.col(column) >= F.lit(low))
        if high is not None:
            rows = rows.where(F.col(column) <= F.lit(high))
    return rows
