"""Versions of employees, facts as of their year, keys kept between loads."""

import random

import pytest
from pyspark.sql import functions as F

from starmart.operators.history import VALIDITY, as_of_join, history_changes, validity_intervals, write_bucketed
from starmart.operators.keys import extend_key_map

ROWS = "emp long, year int, borough string, leave string"


def plain_versions(rows):
    out = []
    for emp in {r[0] for r in rows}:
        of = sorted((r for r in rows if r[0] == emp and r[1] is not None), key=lambda r: r[1])
        runs = []
        for r in of:
            if not runs or runs[-1][-1][2:] != r[2:]:
                runs.append([])
            runs[-1].append(r)
        for k, run in enumerate(runs):
            end = runs[k + 1][0][1] - 1 if k + 1 < len(runs) else None
            out.append((emp, *run[0][2:], k + 1, run[0][1], end, end is None))
    return sorted(out, key=str)


def random_rows(n=60):
    rng = random.Random(4)
    seen = {}
    for _ in range(n * 6):
        emp, year = rng.choice([None, *range(n)]), rng.choice([None, *range(2010, 2022)])
        seen[emp, year] = (emp, year, rng.choice(["A", "B", None]), rng.choice(["on", "off"]))
    return list(seen.values())


def test_intervals_against_plain_runs(spark):
    rows = random_rows()
    got = validity_intervals(spark.createDataFrame(rows, ROWS).repartition(5), ["emp"], "year", ["borough", "leave"])
    assert got.columns == ["emp", "borough", "leave", *VALIDITY]
    assert sorted(map(tuple, got.collect()), key=str) == plain_versions(rows)
    assert got.limit(0).count() == 0


def test_a_fact_keeps_the_version_of_its_year(spark):
    rows = [(1, 2019, "BRONX", "on"), (1, 2020, "BRONX", "on"), (1, 2022, "QUEENS", "on"), (1, 2024, "BRONX", "on")]
    history = validity_intervals(spark.createDataFrame(rows, ROWS), ["emp"], "year", ["borough", "leave"])
    facts = spark.createDataFrame([(1, y, y * 10) for y in range(2018, 2026)] + [(2, 2020, 5), (None, 2020, 6)],
                                  "emp long, year int, pay int")
    got = {(r.emp, r.year): (r.pay, r.borough, r.version) for r in as_of_join(facts, history, ["emp"], "year", ["borough", "version"]).collect()}
    want = {2018: (None, None), 2019: ("BRONX", 1), 2020: ("BRONX", 1), 2021: ("BRONX", 1), 2022: ("QUEENS", 2),
            2023: ("QUEENS", 2), 2024: ("BRONX", 3), 2025: ("BRONX", 3)}
    assert got == {(1, y): (y * 10, *v) for y, v in want.items()} | {(2, 2020): (5, None, None), (None, 2020): (6, None, None)}


def test_every_fact_once_against_plain_lookup(spark):
    rows = random_rows()
    versions = plain_versions(rows)
    history = validity_intervals(spark.createDataFrame(rows, ROWS), ["emp"], "year", ["borough", "leave"])
    facts = [(emp, year) for emp in range(0, 60, 3) for year in range(2008, 2024)]
    got = as_of_join(spark.createDataFrame(facts, "emp long, year int"), history, ["emp"], "year", ["version"])
    want = []
    for emp, year in facts:
        hit = [v for v in versions if v[0] == emp and v[4] <= year and (v[5] is None or year <= v[5])]
        want.append((emp, year, hit[0][3] if hit else None))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_bucketed_tables_join_without_a_shuffle(spark, scratch):
    rows = spark.createDataFrame([(i, 2000 + i % 9, "B", "on") for i in range(500)], ROWS)
    spark.sql("CREATE DATABASE IF NOT EXISTS starmart_buckets")
    facts = write_bucketed(rows.select("emp", "year"), "starmart_buckets.facts", ["emp"], 4, f"{scratch}/facts")
    versions = write_bucketed(validity_intervals(rows, ["emp"], "year", ["borough", "leave"]), "starmart_buckets.versions",
                              ["emp"], 4, f"{scratch}/versions")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = as_of_join(facts, versions, ["emp"], "year", ["version"])
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.where("version = 1").count() == 500
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql("DROP DATABASE starmart_buckets CASCADE")


def test_changes_by_attribute(spark):
    rows = random_rows()
    versions = plain_versions(rows)
    history = validity_intervals(spark.createDataFrame(rows, ROWS), ["emp"], "year", ["borough", "leave"])
    got = {r.attribute: r.changes for r in history_changes(spark, history, ["emp"], ["borough", "leave"]).collect()}
    by = {(v[0], v[3]): v for v in versions}
    want = {"borough": 0, "leave": 0}
    for (emp, n), v in by.items():
        if n > 1:
            want["borough"] += by[emp, n - 1][1] != v[1]
            want["leave"] += by[emp, n - 1][2] != v[2]
    assert got == want


# keys

def numbers(df):
    return {r.name: r.key for r in df.collect()}


def test_keys_are_never_given_anew(spark, scratch):
    def names(*values):
        return spark.createDataFrame([(v,) for v in values], "name string")

    first = numbers(extend_key_map(names("c", "a", "a", None), ["name"], scratch, 0))
    assert first == {None: 1, "a": 2, "c": 3}
    second = numbers(extend_key_map(names("b", "c", None, "d", "a"), ["name"], scratch, 1))
    assert second == first | {"b": 4, "d": 5}
    # a replay gives the same, also if the first try had other rows
    third = numbers(extend_key_map(names("zz"), ["name"], scratch, 2))
    assert third == second | {"zz": 6}
    assert numbers(extend_key_map(names("y", "zz"), ["name"], scratch, 2)) == second | {"y": 6, "zz": 7}
    assert numbers(extend_key_map(names("a"), ["name"], scratch, 3)) == second | {"y": 6, "zz": 7}
    assert numbers(extend_key_map(names("a").limit(0), ["name"], scratch, 4)) == second | {"y": 6, "zz": 7}


@pytest.mark.parametrize("parts", [1, 7])
def test_keys_of_several_columns_over_many_loads(spark, scratch, parts):
    rng = random.Random(5)
    known = {}
    for load in range(4):
        found = [(rng.choice([None, *range(6)]), rng.choice("abc")) for _ in range(12)]
        df = spark.createDataFrame(found, "id long, code string").repartition(parts)
        got = {(r.id, r.code): r.key for r in extend_key_map(df, ["id", "code"], scratch, load).collect()}
        assert set(got) == set(known) | set(found) and sorted(got.values()) == list(range(1, len(got) + 1))
        assert {k: got[k] for k in known} == known
        known = got
