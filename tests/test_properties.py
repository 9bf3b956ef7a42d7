"""Property tests (hypothesis) for dedup, dense keys, union order and FK."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from starmart.operators.dedup import dedup_by
from starmart.operators.keys import dense_key, file_offsets
from starmart.operators.quality import check_foreign_key

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

rows_st = st.lists(st.tuples(st.integers(0, 5), st.integers(2019, 2021), st.integers(0, 10**6),
                             st.sampled_from(["a", "b", None])), min_size=1, max_size=40)


def frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, "emp int, year int, num int, tag string").repartition(parts)


@SETTINGS
@given(rows=rows_st)
def test_dedup_is_deterministic_idempotent_and_order_free(spark, rows):
    once = dedup_by(frame(spark, rows), ["emp", "year"], ["num"])
    shuffled = list(rows)
    random.Random(7).shuffle(shuffled)
    other = dedup_by(frame(spark, shuffled, parts=5), ["emp", "year"], ["num"])
    twice = dedup_by(once, ["emp", "year"], ["num"])
    a, b, c = (sorted(d.collect(), key=str) for d in (once, other, twice))
    assert a == b == c
    want = {}
    for r in rows:
        k = (r[0], r[1])
        cand = (r[2], r[3] is not None, r[3] or "")
        if k not in want or cand < want[k][0]:
            want[k] = (cand, r)
    assert len(a) == len(want)
    assert {(r.emp, r.year): r.num for r in a} == {k: v[1][2] for k, v in want.items()}


@SETTINGS
@given(keys=st.sets(st.integers(-10**9, 10**9), min_size=1, max_size=60),
       parts=st.integers(1, 7))
def test_dense_key_is_one_to_n_in_order(spark, keys, parts):
    df = spark.createDataFrame([(k, k % 3) for k in keys], "k long, g long")
    got = dense_key(df, ["g", "k"], "id", partitions=parts)
    ref = df.withColumn("rid", F.row_number().over(Window.orderBy("g", "k")))
    joined = got.join(ref, ["k", "g"])
    assert joined.count() == len(keys)
    assert joined.where("id != rid").count() == 0
    assert sorted(r.id for r in got.collect()) == list(range(1, len(keys) + 1))



def test_file_offsets_follow_the_task_number_past_five_digits(spark):
    """Part files from task 99999 come before task 100000 (as text they would
    not), and the files one task split keep their own order."""
    names = [("part-100000-u-c000.snappy.parquet", 4), ("part-99999-u-c000.snappy.parquet", 3),
             ("part-00002-u-c001.snappy.parquet", 2), ("part-00002-u-c000.snappy.parquet", 5),
             ("part-00000-u-c000.snappy.parquet", 1)]
    counts = spark.createDataFrame(names, "_file string, _n long")
    got = {r._file: r._off for r in file_offsets(counts).collect()}
    assert got == {"part-00000-u-c000.snappy.parquet": 0, "part-00002-u-c000.snappy.parquet": 1,
                   "part-00002-u-c001.snappy.parquet": 6, "part-99999-u-c000.snappy.parquet": 8,
                   "part-100000-u-c000.snappy.parquet": 11}
    odd = spark.createDataFrame([("data-0.parquet", 1)], "_file string, _n long")
    with pytest.raises(Exception, match="without a task number"):
        file_offsets(odd).collect()

@SETTINGS
@given(child=st.lists(st.integers(0, 20), max_size=30),
       parent=st.sets(st.integers(0, 20), max_size=20))
def test_fk_check_empty_iff_inner_join_keeps_all_rows(spark, child, parent):
    c = spark.createDataFrame([(x,) for x in child], "k int")
    p = spark.createDataFrame([(x,) for x in parent], "k int")
    orphans = check_foreign_key(c, p, "k").count()
    kept = c.join(p, "k").count()
    assert (orphans == 0) == (kept == len(child))
    assert orphans == sum(1 for x in child if x not in parent)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(order=st.permutations([0, 1, 2]))
def test_snapshot_load_does_not_depend_on_file_order(spark, tmp_path_factory, order):
    from test_fixtures import ROWS_2020, ROWS_2021, write

    from starmart.plans.star import dedup_snapshots
    from starmart.sources.csv import discover_files, load_snapshots
    d = tmp_path_factory.mktemp("snap")
    write(d / "payroll_a.csv", ROWS_2020)
    write(d / "payroll_b.csv", ROWS_2021, agency_col="AgencyCode")
    write(d / "payroll_c.csv", ROWS_2020[:3])
    paths = discover_files(spark, str(d), "payroll_*.csv")
    shuffled = [paths[i] for i in order]
    a = sorted(dedup_snapshots(load_snapshots(spark, paths)).collect())
    b = sorted(dedup_snapshots(load_snapshots(spark, shuffled)).collect())
    assert a == b


def test_dense_key_in_order_when_tasks_split_their_files(spark):
    """With maxRecordsPerFile a task writes several files (-c000, -c001, ...);
    the key still follows the stated order."""
    df = spark.range(0, 500).select((F.col("id") * 7919 % 500).alias("k"), (F.col("id") % 4).alias("g"))
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "7")
    try:
        got = dense_key(df, ["g", "k"], "id", partitions=3).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    want = sorted((r.g, r.k) for r in df.collect())
    assert [(r.g, r.k) for r in sorted(got, key=lambda r: r.id)] == want
    assert sorted(r.id for r in got) == list(range(1, 501))
