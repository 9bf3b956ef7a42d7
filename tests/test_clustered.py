"""Z-order clustering and lookups, and releases of at least k people."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from conftest import SF_ORACLE, SF_SMALL
from starmart import testmap as tm
from starmart.plans.privacy import ANY, generalize, payroll_levels
from starmart.sinks.clustered import files_for, lookup, quantile_bounds, write_clustered, z_value


@pytest.fixture(scope="module")
def orders(spark, tmp_path_factory):
    df = tm.table(spark, SF_ORACLE, "orders")
    return df, write_clustered(df, str(tmp_path_factory.mktemp("clustered")), ["o_custkey", "o_orderdate"], 100)


def test_a_lookup_opens_few_files(spark, orders):
    df, table = orders
    n_files = files_for(spark, table).count()
    assert n_files >= 60
    for key in (0, 17, 700, 1499, 10**6):
        found = lookup(spark, table, o_custkey=key)
        assert found.exceptAll(df.where(F.col("o_custkey") == key)).isEmpty()
        assert found.count() == df.where(F.col("o_custkey") == key).count()
        assert len(found.inputFiles()) <= 0.25 * n_files  # one column of two
    both = dict(o_custkey=(100, 140), o_orderdate=("1995-01-01", "1995-06-30"))
    found = lookup(spark, table, **both)
    want = df.where("o_custkey BETWEEN 100 AND 140 AND o_orderdate BETWEEN '1995-01-01' AND '1995-06-30'")
    assert found.count() == want.count() > 0 and found.exceptAll(want).isEmpty()
    assert len(found.inputFiles()) <= 0.05 * n_files
    assert lookup(spark, table, most_files=1, **both).count() == want.count()  # reads the table
    assert lookup(spark, table, o_custkey=(None, 5)).count() == df.where("o_custkey <= 5").count()


def test_point_lookups_on_one_column(spark, tmp_path):
    df = tm.table(spark, SF_ORACLE, "orders")
    table = write_clustered(df, str(tmp_path), ["o_custkey"], 60)
    n_files = files_for(spark, table).count()
    for key in (1, 500, 1400):
        found = lookup(spark, table, o_custkey=key)
        assert found.count() == df.where(F.col("o_custkey") == key).count()
        assert len(found.inputFiles()) < 0.05 * n_files


def test_the_curve_interleaves_ranges(spark):
    df = spark.createDataFrame([(i % 16, i // 16) for i in range(256)], "a int, b int")
    bounds = {"a": list(range(1, 16)), "b": list(range(1, 16))}
    rows = df.withColumn("z", z_value(bounds, bits=4)).collect()

    def plain(a, b):
        return sum(((a >> i) & 1) << (2 * i) | ((b >> i) & 1) << (2 * i + 1) for i in range(4))

    assert all(r.z == plain(r.a, r.b) for r in rows)
    assert quantile_bounds(df, ["a"], bits=2)["a"] == [3, 7, 11]


def test_nulls_repeats_and_empty_tables(spark, scratch):
    df = spark.createDataFrame([(None, 1)] * 20 + [(7, None)] * 50 + [(i, i) for i in range(30)], "a int, b int")
    table = write_clustered(df, f"{scratch}/t", ["a", "b"], 8)
    assert lookup(spark, table, a=7).count() == 51 and lookup(spark, table).count() == 100
    empty = write_clustered(df.limit(0), f"{scratch}/e", ["a", "b"], 8)
    assert lookup(spark, empty, a=1).count() == 0


# privacy

def plain_release(rows, levels, k):
    left, out = list(rows), []
    for name, of in levels:
        groups = defaultdict(list)
        for r in left:
            groups[of(r)].append(r)
        left = []
        for key, members in groups.items():
            if len({m["person"] for m in members}) >= k:
                out.append((name, *key, len({m["person"] for m in members}), len(members), sum(m["pay"] for m in members)))
            else:
                left += members
    if left:
        out.append(("suppressed", ANY, ANY, ANY, len({m["person"] for m in left}), len(left), None))
    return sorted(out, key=str)


@pytest.mark.parametrize("k", [1, 3, 10])
def test_release_against_plain_groups(spark, k):
    rng = random.Random(3)
    rows = [{"person": rng.randrange(150), "AgencyName": f"A{int(rng.random() ** 3 * 30)}", "WorkLocationBorough": rng.choice("XYZ"),
             "TitleDescription": f"T{int(rng.random() ** 2 * 8)} {rng.choice(['I', 'II'])}", "FiscalYear": 2020 + rng.randrange(2),
             "pay": rng.randrange(1000)} for _ in range(600)] + [
        {"person": 999, "AgencyName": None, "WorkLocationBorough": None, "TitleDescription": None, "FiscalYear": 1999, "pay": 5}]
    s = lambda x: "" if x is None else str(x)
    levels = [("agency and title", lambda r: (s(r["AgencyName"]), s(r["TitleDescription"]), s(r["FiscalYear"]))),
              ("agency and family", lambda r: (s(r["AgencyName"]), s(r["TitleDescription"]).split(" ")[0], s(r["FiscalYear"]))),
              ("agency", lambda r: (s(r["AgencyName"]), ANY, s(r["FiscalYear"]))),
              ("borough", lambda r: (s(r["WorkLocationBorough"]), ANY, s(r["FiscalYear"]))),
              ("year", lambda r: (ANY, ANY, s(r["FiscalYear"])))]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], "person long, AgencyName string, WorkLocationBorough string, "
                               "TitleDescription string, FiscalYear int, pay long").repartition(4)
    out = generalize(df, "person", payroll_levels(), k, ["pay"])
    got = sorted((tuple(r) for r in out.select("level", "place", "title", "year", "n_people", "n_rows", "pay").collect()), key=str)
    assert got == plain_release(rows, levels, k)
    published = out.where("level <> 'suppressed'")
    assert published.where(F.col("n_people") < k).isEmpty()
    assert out.agg(F.sum("n_rows")).first()[0] == len(rows)
    assert generalize(df.limit(0), "person", payroll_levels(), k, ["pay"]).count() == 0


def test_release_of_shipped_rows(spark):
    from starmart.plans import registered as R

    out = R.public_release(spark, SF_SMALL)
    assert out.where("level <> 'suppressed' AND n_people < 5").isEmpty() and out.count() > 10
