"""Dense surrogate keys 1..n in a stated order.

``monotonically_increasing_id()`` (what a quick job reaches for) is unique but
puts the partition number in the high bits, so it neither is dense nor fits a
32-bit key, and it changes between evaluations. Two forms here:

* ``dense_key_small``: ``row_number()`` over the whole frame. One task sorts
  everything, so it is only for frames whose size is bounded by a domain, not
  by the data (distinct fiscal years, a code list).
* ``dense_key``: the scalable form. Range-partition on the order key, sort
  within partitions and write the result once as parquet under the
  checkpoint root: part file ``k`` holds the ``k``-th range, in order. Then
  each row's key is (rows in earlier files) + (its ``_metadata.row_index``
  in its file) + 1. Counting rows per file reads no column data, the offsets
  table has one row per file (broadcast after the size check), and nothing depends on
  how the read is split into tasks. A hot value of the leading order column
  does not land in one task: the order key is unique, so range bounds split
  it across files.

``extend_key_map`` keeps numbers between loads: what has a key keeps it.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmart.operators.joins import checked_broadcast
from starmart.session import materialize


def dense_key_small(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Key = row_number() over the global order; for domain-bounded frames only."""
    w = Window.orderBy(*order)
    return df.withColumn(name, F.row_number().over(w).cast("bigint"))


def file_offsets(counts: DataFrame) -> DataFrame:
    """(_file, _off): rows in the files before each file, from (_file, _n).

    Files are ordered by the task number in their name (``part-<n>-...``), not
    by the name as text: the number has five digits only below 100000, so as
    text ``part-100000`` would sort before ``part-99999``. The whole name
    breaks ties between files one task split (``-c000``, ``-c001``). One row
    per file, so it grows with the file count, not the rows."""
    number = F.nullif(F.regexp_extract("_file", r"^part-(\d+)", 1), F.lit(""))
    part = F.coalesce(number.cast("long"), F.raise_error(F.concat(
        F.lit("dense key: file name without a task number: "), F.col("_file"))))
    w = Window.orderBy("_part", "_file").rowsBetween(Window.unboundedPreceding, -1)
    return (counts.withColumn("_part", part)
            .withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0)))
            .select("_file", "_off"))


def dense_key(df: DataFrame, order: list[str], name: str,
              partitions: int | None = None) -> DataFrame:
    """Key = 1-based position of the row in ``order`` (which must be unique).

    Without ``partitions`` the range count follows the session's shuffle
    partitions and AQE may merge small neighbouring ranges; merged ranges are
    contiguous, so file order is still key order."""
    ranged = (df.repartitionByRange(*order) if partitions is None
              else df.repartitionByRange(partitions, *order))
    ranged = materialize(ranged.sortWithinPartitions(*order), "dense_key")
    tagged = ranged.withColumns({"_file": F.col("_metadata.file_name"),
                                 "_row": F.col("_metadata.row_index")})
    counts = tagged.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))
    # one row per file: broadcast after the size check like any other side
    keyed = tagged.join(checked_broadcast(file_offsets(counts)), "_file")
    return keyed.withColumn(name, (F.col("_off") + F.col("_row") + 1).cast("bigint")) \
        .drop("_file", "_row", "_off")


# ---------------------------------------------------------------- keys kept between loads

def key_map(spark: SparkSession, path: str) -> DataFrame | None:
    """The natural keys with their numbers and ``load``, of all loads so far; None
    before the first."""
    try:
        return spark.read.option("basePath", path).parquet(path)
    except AnalysisException:
        return None


def extend_key_map(found: DataFrame, natural: list[str], path: str, load: int, name: str = "key") -> DataFrame:
    """Number the natural keys of ``found`` that no load before ``load`` numbered:
    dense numbers after the highest one so far, in the order of the keys. Returns
    the whole map (``natural``, ``name``).

    A number once given never changes. The map below ``path`` only grows, by one
    folder a load; a load that is replayed replaces its own folder and gives the
    same numbers. New keys are found by an anti join on the keys (null equals
    null), which broadcasts neither side beyond its checked size. One load at a
    time writes."""
    spark = found.sparkSession
    known = key_map(spark, path)
    new = found.select(*natural).distinct()
    highest = 0
    if known is not None:
        known = known.where(F.col("load") < load)
        old = known.select(*[F.col(c).alias(f"_k_{c}") for c in natural])
        new = new.join(old, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in natural], "left_anti")
        highest = known.agg(F.max(name)).first()[0] or 0
    numbered = dense_key(new, natural, name).withColumn(name, F.col(name) + F.lit(highest))
    numbered.select(*natural, name).write.mode("overwrite").parquet(f"{path.rstrip('/')}/load={load}")
    return key_map(spark, path).where(F.col("load") <= load).select(*natural, name)
