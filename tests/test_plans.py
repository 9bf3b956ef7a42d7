"""The plans we want at scale: one-scan audit, partition pruning, checked
broadcast, map-side partial aggregation for dedup."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from starmart import testmap as tm
from starmart.functions.clean import null_audit
from starmart.operators.dedup import dedup_by
from starmart.operators.joins import checked_broadcast, small_enough
from starmart.plans import registered as R


def plan(df) -> str:
    """The physical plan text, as ``explain()`` prints it."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_null_audit_is_one_scan(spark):
    p = plan(null_audit(tm.table(spark, SF_SMALL, "customer")))
    assert len(re.findall(r"^\(\d+\) Scan parquet", p, re.M)) == 1


def test_partitioned_read_prunes(spark):
    df = R.partition_pruned_scan(spark, SF_SMALL)
    text = plan(df)
    assert "PartitionFilters: [isnotnull(o_year" in text and "= 1996" in text


def test_checked_broadcast(spark):
    nation = tm.table(spark, SF_SMALL, "nation")
    assert small_enough(nation, 100)
    assert not small_enough(nation, 10)
    assert not small_enough(nation, 100, max_bytes=100)   # 25 rows are more than 100 bytes
    orders = tm.table(spark, SF_SMALL, "orders")
    cust = tm.table(spark, SF_SMALL, "customer")
    j = cust.join(checked_broadcast(nation, 100), cust.c_nationkey == nation.n_nationkey)
    assert "BroadcastHashJoin" in plan(j)
    # over the limit: no hint, the planner (and AQE at run time) decides
    assert checked_broadcast(orders, 10) is orders


def test_dedup_aggregates_map_side(spark):
    o = tm.table(spark, SF_SMALL, "orders")
    d = dedup_by(o, ["o_custkey"], ["o_orderkey"])
    text = plan(d)
    # a partial aggregate below the exchange: a hot key is combined per task
    assert text.count("SortAggregate") + text.count("HashAggregate") >= 2
    assert "Window" not in text


def test_fact_by_id_has_no_join_over_the_payroll_besides_time(spark):
    s = R.star(spark, SF_SMALL)
    text = plan(s.fact_rows())
    assert text.count("SortMergeJoin") == 0


def test_allocation_same_over_published_fact_and_fact_rows(spark):
    from starmart.plans import marts
    s = R.star(spark, SF_SMALL)
    a = marts.allocation_by_agency_year(s.fact, s.agency, s.time)
    b = marts.allocation_by_agency_year(s.fact_rows(), s.agency, s.time)
    assert sorted(a.collect()) == sorted(b.collect())
    assert "Expand" not in plan(b)


def test_merged_stage_writes_few_files_per_year(spark, scratch):
    """The extract stage rebalances on the fiscal year before its partitioned
    write: a write task holds one year, so each year folder gets its own few
    files instead of one file from every task (tasks x years)."""
    import glob

    from starmart.plans import jobs
    root = scratch.replace("file:", "")
    R.write_snapshot_files(spark, tm.snapshot(spark, SF_SMALL), f"{root}/in")
    cfg = jobs.JobConfig(snapshot_dir=f"{root}/in", stage_dir=f"{root}/stage", pattern="*.csv",
                         recursive=True, database="starmart_files")
    # without merging of small shuffle partitions every one of the 8 tasks
    # writes, as the many tasks of a large run do
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        merged = jobs.extract(spark, cfg)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    years = glob.glob(f"{root}/stage/extract-*/payroll_merged/FiscalYear=*")
    files = glob.glob(f"{root}/stage/extract-*/payroll_merged/FiscalYear=*/*.parquet")
    assert len(years) == merged.select("FiscalYear").distinct().count()
    assert len(files) == len(years)  # each year written by one task
