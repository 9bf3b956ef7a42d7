"""Drift between years and broken dependencies, on planted defects."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from starmart.plans import registered as R
from starmart.plans.consistency import broken_dependencies, dependencies, drift, merged, year_sketches

SCHEMA = "year int, id long, name string, code int, pay double"


def rows_of_years(seed=1, n=400):
    rng = random.Random(seed)
    rows = []
    for year in range(2015, 2022):
        for i in range(n):
            pay = rng.gauss(1000, 200) + (400 if year == 2018 else 0)  # pay moves in 2018
            code = None if year == 2020 and i % 3 == 0 else i % 40     # codes go missing in 2020
            name = f"name {i % 40}" if not (year == 2017 and i % 2) else f"other {i}"  # names come apart in 2017
            rows.append((year, i, name, code, pay))
    return rows


@pytest.fixture(scope="module")
def years(spark):
    return spark.createDataFrame(rows_of_years(), SCHEMA).repartition(6).cache()


def test_planted_drift_is_reported_and_nothing_else(spark, years):
    report = drift(year_sketches(years, "year", ["pay"], ["id", "code"]))
    assert report.count() == 6 * 3
    assert sorted((r.year, r.column) for r in report.where("drifted").collect()) == [
        (2018, "pay"), (2019, "pay"), (2020, "code"), (2021, "code")]
    moved = {(r.year, r.column): r for r in report.collect()}
    assert moved[2018, "pay"].spread > 0.5 and moved[2016, "pay"].spread < 0.1
    assert moved[2020, "code"].nulls == pytest.approx(1 / 3, abs=0.01) and moved[2020, "code"].spread is None


def test_sketches_of_parts_merge(spark, years):
    whole = year_sketches(years, "year", ["pay"], ["id"])
    parts = [year_sketches(years.where(F.col("id") % 3 == k), "year", ["pay"], ["id"]) for k in range(3)]
    together = merged(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    for a, b in zip(*(sorted(drift(x).collect(), key=lambda r: (r.year, r.column)) for x in (whole, together))):
        assert (a.year, a.column, a.drifted) == (b.year, b.column, b.drifted)
        assert a.nulls == b.nulls and a.distinct == pytest.approx(b.distinct, abs=0.05)
    assert together.where("column = 'id' AND spread IS NOT NULL").isEmpty()


def test_dependencies_against_plain_groups(spark):
    rng = random.Random(2)
    rows = [(rng.choice([None, 1, 2, 3]), rng.choice([None, "a", "b"]), rng.choice([7, None]), i % 2) for i in range(12)]
    columns = ["w", "x", "y", "z"]
    df = spark.createDataFrame(rows, "w int, x string, y int, z int")
    got = {(r.determinant, r.dependent): (r.n_groups, r.n_broken) for r in dependencies(df, columns).collect()}
    want = {}
    for i, a in enumerate(columns):
        for j, b in enumerate(columns):
            if i != j:
                groups = {}
                for r in rows:
                    if r[i] is not None:
                        groups.setdefault(r[i], set()).add(r[j])
                want[a, b] = (len(groups), sum(len(v) > 1 for v in groups.values()))
    assert got == want
    assert dependencies(df.limit(0), columns).agg(F.sum("n_groups")).first()[0] == 0


def test_planted_breaks_are_reported(spark, years):
    found = broken_dependencies(years, "year", ["code", "name"])
    assert sorted((r.year, r.determinant, r.dependent) for r in found.collect()) == [(2017, "code", "name"), (2020, "name", "code")]


def test_queries_on_shipped_rows(spark):
    assert R.snapshot_drift(spark, SF_SMALL).where("year IS NULL").isEmpty()
    held = {(r.determinant, r.dependent) for r in R.functional_dependencies(spark, SF_SMALL).where("n_broken = 0").collect()}
    assert {("EmployeeID", "LastName"), ("AgencyID", "AgencyName"), ("TitleCode", "TitleDescription")} <= held
    assert ("AgencyID", "EmployeeID") not in held
