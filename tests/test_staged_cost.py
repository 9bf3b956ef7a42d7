"""What the staged job spends a row: the same rows for less."""
import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from starmart import schemas as S
from starmart import testmap as tm
from starmart.operators.dedup import dedup_by
from starmart.sinks import versions
from starmart.sources import csv as src

ODD = [1.005, 0.615, 2.675, 0.125, 999999.99, -0.0, -3.455, 1e-9, 49.0, 33078.94, 0.07, 1.1e-2, 999999.985,
       float("inf"), float("nan"), None]


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_line_totals_are_the_sums_of_the_cast_amounts(spark):
    rows = [(i % 5, q, p, "RAN"[i % 3], "OF"[i % 2]) for i, q in enumerate(ODD) for p in ODD]
    lines = spark.createDataFrame(rows, "l_orderkey long, l_quantity double, l_extendedprice double, "
                                        "l_returnflag string, l_linestatus string")
    got = tm.line_totals(lines)
    assert "sum(qty" in _plan(got)  # hundredths are added up, not decimals
    q, p = F.col("l_quantity").cast(tm.LINE), F.col("l_extendedprice").cast(tm.LINE)
    want = lines.groupBy("l_orderkey").agg(
        F.sum(q), F.sum(F.when(F.col("l_returnflag") == "R", q)), F.sum(F.when(F.col("l_returnflag") == "R", p)),
        F.sum(F.when(F.col("l_linestatus") == "O", p))).fillna(0)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert [f.dataType for f in got.schema][1:] == [S.MONEY] * 4


@pytest.mark.parametrize("value", [1_000_000.0, 999999.996, -1e12])
def test_line_amounts_that_do_not_fit_fail(spark, value):
    lines = spark.createDataFrame([(1, 1.0, value, "R", "O")], "l_orderkey long, l_quantity double, "
                                  "l_extendedprice double, l_returnflag string, l_linestatus string")
    with pytest.raises(Exception):
        tm.line_totals(lines).collect()


@pytest.mark.parametrize("keep", ["first", "last"])
def test_dedup_carries_its_order_once(spark, keep):
    df = spark.createDataFrame([(1, None, "b", 1), (1, 2, "b", 2), (1, 2, "a", 3), (1, 2, "a", 4), (2, None, None, 5), (2, None, "z", 6)],
                               "k int, number long, path string, v int")
    got = dedup_by(df, ["k"], ["number", "path"], keep)
    struct = _plan(got).split("struct(", 1)[1].split("))", 1)[0]
    assert struct.count("path#") <= 2  # its null flag and itself
    assert got.columns == df.columns
    want = {"first": [(1, 2, "a", 3), (2, None, "z", 6)], "last": [(1, 2, "b", 2), (2, None, "z", 6)]}
    assert sorted(map(tuple, got.collect())) == want[keep]


def test_a_first_publish_starts_no_python(spark, scratch):
    none = versions.versions(spark, scratch)
    assert "RDD" not in _plan(none)
    assert none.count() == 0
    assert none.schema.simpleString() == spark.createDataFrame([], versions.MANIFEST_SCHEMA).schema.simpleString()


def test_readers_share_a_folder_of_one_file(spark, scratch):
    df = spark.range(600_000, numPartitions=1).select(F.lit(2020).alias("year"), *[F.rand(i).alias(f"c{i}") for i in range(8)])
    src.write_stage(df, scratch, partition_by=["year"])
    (file,) = glob.glob(f"{scratch.removeprefix('file:')}/year=2020/*.parquet")
    assert pq.ParquetFile(file).num_row_groups > 1
