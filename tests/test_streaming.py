"""Incremental ingestion: only new files are taken, replays do not double, and a
drop touches what it holds."""

import os

from pyspark.sql import functions as F
from test_fixtures import ROWS_2020, ROWS_2021, write

from conftest import SF_SMALL
from starmart import schemas as S
from starmart import testmap as tm
from starmart.plans.star import dedup_snapshots
from starmart.session import materialize
from starmart.sources.csv import PROVENANCE
from starmart.streaming.bronze import drop_dead, merge_drop
from starmart.streaming.snapshots import ingest, read_bronze


def test_only_new_files_are_ingested(spark, tmp_path, scratch):
    src = tmp_path / "in"
    src.mkdir()
    bronze, ckpt = f"{scratch}/bronze", f"{scratch}/ckpt"
    write(src / "payroll_2020.csv", ROWS_2020)
    ingest(spark, str(src), bronze, ckpt)
    assert read_bronze(spark, bronze, dedup=False).count() == len(ROWS_2020)

    ingest(spark, str(src), bronze, ckpt)            # nothing new: nothing added
    assert read_bronze(spark, bronze, dedup=False).count() == len(ROWS_2020)

    write(src / "payroll_2021.csv", ROWS_2021, agency_col="AgencyCode")
    ingest(spark, str(src), bronze, ckpt)
    raw = read_bronze(spark, bronze, dedup=False)
    assert raw.where("AgencyID IS NULL").count() == 0  # drifted header handled by name
    # (8, 2021) arrives in both files; the bronze read keeps the lowest payroll number
    d = read_bronze(spark, bronze)
    assert d.count() == len(ROWS_2020) + len(ROWS_2021) - 1
    assert [r.PayrollNumber for r in d.where("EmployeeID = 8").collect()] == [30]


def _from_file(rows, name):
    return rows.withColumn(PROVENANCE, F.struct(F.lit("2024-01-01").cast("timestamp").alias("at"), F.lit(name).alias("path")))


def test_a_small_drop_reads_and_writes_what_it_holds(spark, scratch):
    snap = materialize(tm.snapshot(spark, SF_SMALL), "snap")
    first = snap.where("PayrollNumber % 100 <> 0")
    second = snap.where("PayrollNumber % 100 = 0").unionByName(  # new rows, and some that were sent before
        first.where("PayrollNumber % 1000 = 3").withColumn("LastName", F.lit("SENT AGAIN")))
    log = merge_drop(spark, scratch, _from_file(first, "a"), 0, buckets=2, merge_share=0.5)
    assert {r.kind for r in log.collect()} == {"base"}
    base = f"{scratch}/rows/batch_id=0"
    os.rename(base, f"{scratch}/hidden")  # the base's rows cannot be read while the second drop comes in
    log = merge_drop(spark, scratch, _from_file(second, "b"), 1, merge_share=0.5)
    os.rename(f"{scratch}/hidden", base)
    rows = log.collect()
    assert {r.kind for r in rows} == {"delta"}
    assert sum(r.n_rows for r in rows) == second.select("EmployeeID", "FiscalYear").distinct().count() < 0.02 * first.count()
    want = dedup_snapshots(_from_file(first, "a").unionByName(_from_file(second, "b")))
    assert read_bronze(spark, scratch).exceptAll(want).isEmpty() and want.exceptAll(read_bronze(spark, scratch)).isEmpty()


def test_deltas_merge_into_a_new_base_slice_by_slice(spark, scratch):
    snap = materialize(tm.snapshot(spark, SF_SMALL), "snap")
    parts = [snap.where(f"EmployeeID % 5 = {k}") for k in range(5)] + [snap.where("FiscalYear = 1995")]
    for k, part in enumerate(parts):
        merge_drop(spark, scratch, _from_file(part, f"file{k}"), k, buckets=3, merge_share=0.3)
    # a replay of the last batch replaces it
    before = sorted(read_bronze(spark, scratch).collect(), key=str)
    last = merge_drop(spark, scratch, _from_file(parts[-1], "file5"), 5, buckets=99)
    assert {r.slice.split("-")[0] for r in last.collect()} == {"1995"}  # no other year is touched
    assert sorted(read_bronze(spark, scratch).collect(), key=str) == before
    want = dedup_snapshots(snap).select(*S.PAYROLL_COLUMNS)
    assert before == sorted(want.collect(), key=str)
    drop_dead(spark, scratch)
    assert sorted(read_bronze(spark, scratch).collect(), key=str) == before


def test_rows_without_a_log_are_not_read(spark, scratch):
    snap = materialize(tm.snapshot(spark, SF_SMALL), "snap")
    merge_drop(spark, scratch, _from_file(snap.where("FiscalYear < 1995"), "a"), 0)
    n = read_bronze(spark, scratch).count()
    rows = _from_file(snap.where("FiscalYear >= 1995"), "b").withColumn("slice", F.lit("1996-1"))
    rows.write.partitionBy("slice").parquet(f"{scratch}/rows/batch_id=1")  # the driver was gone before the log
    assert read_bronze(spark, scratch).count() == n


def test_no_rows_at_all(spark, scratch):
    assert read_bronze(spark, scratch).count() == 0
    empty = tm.snapshot(spark, SF_SMALL).limit(0)
    merge_drop(spark, scratch, _from_file(empty, "a"), 0)
    assert read_bronze(spark, scratch).count() == 0
