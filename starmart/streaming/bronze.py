"""Bronze table of deduplicated snapshot rows, merged slice by slice.

Rows lie in slices: a fiscal year and a hash bucket of the employee, so all rows
of one key are in one slice. A drop of new rows is deduplicated by itself and
appended to the slices it touches as deltas; nothing else is read or written. A
slice whose deltas have grown to ``merge_share`` of its base is merged: its live
rows and the new ones are deduplicated into a new base. So a small drop costs
what it holds, and a row is rewritten a bounded number of times for every time
that its slice grows by that share.

    <bronze>/layout                    one row: the number of buckets
    <bronze>/rows/batch_id=<n>/slice=<s>
    <bronze>/log/batch_id=<n>          (slice, kind, n_rows): what batch n did

A batch writes its rows first and its log last, each into a folder of its own
that a replay overwrites. Rows that no log names, and rows of a slice before its
last base, are not read.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart import schemas as S
from starmart.operators.joins import checked_broadcast
from starmart.plans.star import dedup_snapshots
from starmart.session import drop_path, materialize
from starmart.sources.csv import PROVENANCE, PROVENANCE_TYPE

ROW_SCHEMA = T.StructType([*S.PAYROLL_SCHEMA.fields, T.StructField(PROVENANCE, PROVENANCE_TYPE),
                           T.StructField("batch_id", T.LongType()), T.StructField("slice", T.StringType())])
LOG_SCHEMA = "slice string, kind string, n_rows long, batch_id long"
COLUMNS = [*S.PAYROLL_COLUMNS, PROVENANCE]


def _path(bronze: str, *names: str) -> str:
    return "/".join([bronze.rstrip("/"), *names])


def _buckets(spark: SparkSession, bronze: str, wanted: int) -> int:
    """The table's own number of buckets; ``wanted`` where it is new."""
    path = _path(bronze, "layout")
    try:
        return spark.read.schema("buckets int").parquet(path).first().buckets
    except AnalysisException:
        spark.range(1).select(F.lit(wanted).cast("int").alias("buckets")).coalesce(1).write.parquet(path)
        return wanted


def _log(spark: SparkSession, bronze: str, before: int | None = None) -> DataFrame:
    try:
        log = spark.read.schema(LOG_SCHEMA).parquet(_path(bronze, "log"))
    except AnalysisException:
        log = spark.createDataFrame([], LOG_SCHEMA)
    return log if before is None else log.where(F.col("batch_id") < before)


def _slices(log: DataFrame) -> DataFrame:
    """(slice, base, n_base, n_delta): the batch of a slice's last base, its rows,
    and those of the deltas since."""
    base = F.max_by(F.struct("batch_id", "n_rows"), F.when(F.col("kind") == "base", F.col("batch_id")))
    based = log.groupBy("slice").agg(base.alias("b"), F.collect_list(
        F.when(F.col("kind") == "delta", F.struct("batch_id", "n_rows"))).alias("deltas"))
    later = F.filter("deltas", lambda d: d["batch_id"] > F.col("b.batch_id"))
    return based.select("slice", F.col("b.batch_id").alias("base"), F.col("b.n_rows").alias("n_base"),
                        F.aggregate(later, F.lit(0).cast("long"), lambda a, d: a + d["n_rows"]).alias("n_delta"))


def _live(log: DataFrame) -> DataFrame:
    """(batch_id, slice, merged): the parts of each slice that count; ``merged``
    where the base is all there is."""
    slices = _slices(log)
    return (log.join(slices, "slice").where(F.col("batch_id") >= F.col("base"))
            .select("batch_id", "slice", (F.col("n_delta") == 0).alias("merged")))


def _rows(spark: SparkSession, bronze: str, parts: DataFrame) -> DataFrame:
    """Rows of ``parts`` (batch_id, slice, ...): by their partition columns, so
    the folders of other slices and batches are not read."""
    try:
        rows = spark.read.schema(ROW_SCHEMA).parquet(_path(bronze, "rows"))
    except AnalysisException:  # no batch yet
        rows = spark.createDataFrame([], ROW_SCHEMA)
    return rows.join(checked_broadcast(parts), ["batch_id", "slice"])


def merge_drop(spark: SparkSession, bronze: str, rows: DataFrame, batch_id: int, buckets: int = 64,
               merge_share: float = 0.2) -> DataFrame:
    """Add ``rows`` (payroll columns and provenance) as batch ``batch_id`` and
    return its log. A batch that is replayed replaces what it wrote before."""
    n_buckets = _buckets(spark, bronze, buckets)
    where = F.concat_ws("-", F.coalesce(F.col("FiscalYear").cast("string"), F.lit("none")),
                        F.pmod(F.xxhash64("EmployeeID"), F.lit(n_buckets)).cast("string"))
    drop = materialize(dedup_snapshots(rows, keep_provenance=True).withColumn("slice", where), "bronze-drop")
    log = _log(spark, bronze, before=batch_id)
    touched = drop.groupBy("slice").agg(F.count("*").alias("n_new")).join(
        checked_broadcast(materialize(_slices(log), "bronze-slices")), "slice", "left")
    grown = F.col("n_base").isNull() | (F.col("n_delta") + F.col("n_new") >= merge_share * F.col("n_base"))
    plan = materialize(touched.select("slice", "base", "n_new", F.when(grown, "base").otherwise("delta").alias("kind")),
                       "bronze-plan")
    # slices that hold nothing yet, and deltas, take the drop's rows as they are
    merges = plan.where((F.col("kind") == "base") & F.col("base").isNotNull())
    as_is = drop
    if not merges.isEmpty():
        side = checked_broadcast(merges.select("slice"))
        live = materialize(_live(log).join(side, "slice", "left_semi").where("batch_id IS NOT NULL"), "bronze-merging")
        old = _rows(spark, bronze, live.where(F.col("batch_id") >= 0)).select(*COLUMNS, "slice")
        both = old.unionByName(drop.join(side, "slice", "left_semi").select(*old.columns))
        merged = dedup_snapshots(both.drop("slice"), keep_provenance=True).withColumn("slice", where)
        as_is = drop.join(side, "slice", "left_anti").select(*old.columns).unionByName(merged.select(*old.columns))
    # the rebalance gives a write task whole slices, a large slice several
    (as_is.select(*COLUMNS, "slice").hint("rebalance", "slice").write.mode("overwrite").partitionBy("slice")
     .parquet(_path(bronze, "rows", f"batch_id={batch_id}")))
    counts = (spark.read.schema(ROW_SCHEMA).parquet(_path(bronze, "rows")).where(F.col("batch_id") == batch_id)
              .groupBy("slice").agg(F.count("*").alias("n_rows")))
    done = plan.select("slice", "kind").join(counts, "slice")
    done.select("slice", "kind", "n_rows").coalesce(1).write.mode("overwrite").parquet(
        _path(bronze, "log", f"batch_id={batch_id}"))
    return _log(spark, bronze).where(F.col("batch_id") == batch_id)


def read_bronze(spark: SparkSession, bronze: str, dedup: bool = True) -> DataFrame:
    """The payroll rows. Merged slices are read as they are; only those with
    deltas are deduplicated (``dedup=False`` leaves that out too)."""
    live = materialize(_live(_log(spark, bronze)), "bronze-live")
    rows = _rows(spark, bronze, live.where(F.col("batch_id") >= 0))
    if not dedup:
        return rows.select(*S.PAYROLL_COLUMNS)
    clean, open_ = (_rows(spark, bronze, live.where(F.col("merged") == flag)) for flag in (True, False))
    return (clean.select(*S.PAYROLL_COLUMNS)
            .unionByName(dedup_snapshots(open_.select(*COLUMNS)).select(*S.PAYROLL_COLUMNS)))


def drop_dead(spark: SparkSession, bronze: str) -> list[str]:
    """Delete the folders of batches of which no slice is live any more. For
    times when nobody reads an older state."""
    log = _log(spark, bronze)
    live = _live(log).select("batch_id").distinct()
    # one row per batch
    dead = [f"{_path(bronze, 'rows')}/batch_id={r.batch_id}" for r in
            log.select("batch_id").distinct().join(live, "batch_id", "left_anti").orderBy("batch_id").collect()]
    for path in dead:
        drop_path(spark, path)
    return dead
