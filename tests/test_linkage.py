"""Code lists matched by name, against all pairs."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from starmart import testmap as tm
from starmart.operators.linkage import candidates, crosswalk, one_to_one, orphan_report, translated
from starmart.plans import registered as R

SAME = {"dept": "department"}


def words(name):
    return {SAME.get(w, w) for w in re.findall("[a-z0-9]+", (name or "").lower())}


def plain_scores(left, right, least):
    sets = [[(i, words(n)) for i, n in rows] for rows in (left, right)]
    every = [w for rows in sets for _, w in rows]
    df = {}
    for w in every:
        for x in w:
            df[x] = df.get(x, 0) + 1
    weight = {x: math.floor(1000 * math.log1p(len(every) / n)) for x, n in df.items()}
    out = {}
    for i, a in sets[0]:
        for j, b in sets[1]:
            shared, total = sum(weight[x] for x in a & b), sum(weight[x] for x in a | b)
            if total and shared / total >= least:
                out[i, j] = shared / total
    return out


def plain_assignment(scores):
    out, taken = {}, set()
    for (i, j), s in sorted(scores.items(), key=lambda x: (-x[1], x[0])):
        if i not in out and j not in taken:
            out[i] = (j, s)
            taken.add(j)
    return out


def lists(n=120):
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(40)] + ["of", "dept", "department", "the"]
    left = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 6)))) for i in range(n)]
    right = []
    for i, name in left:
        w = name.split()
        rng.shuffle(w)
        if rng.random() < 0.5:
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        right.append((1000 + i, ", ".join(w).upper()))
    left += [(5000, None), (5001, ""), (5002, "!!")]
    return left, right + [(6000, None), (6001, "the dept of"), (6002, "the dept of")]


@pytest.mark.parametrize("least", [0.3, 0.5, 0.8])
def test_candidates_and_assignment_against_all_pairs(spark, least):
    left, right = lists()
    dfs = [spark.createDataFrame(x, "id long, name string").repartition(3) for x in (left, right)]
    want = plain_scores(left, right, least)
    found = candidates(*dfs, least, SAME)
    got = {(r.left_id, r.right_id): r.score for r in found.collect()}
    assert found.count() == len(got) and got == pytest.approx(want)
    walk = {r.left_id: (r.right_id, r.score) for r in one_to_one(found).collect()}
    assert {k: v[0] for k, v in walk.items()} == {k: v[0] for k, v in plain_assignment(got).items()}
    assert len({v[0] for v in walk.values()}) == len(walk) > 20


def test_long_chains_of_rivals_end(spark):
    """Every entry's best is already taken by a better pair."""
    pairs = [(i, i + d, 1 - 0.01 * (2 * i + d)) for i in range(30) for d in (0, 1)]
    walk = one_to_one(spark.createDataFrame(pairs, "left_id long, right_id long, score double"))
    assert sorted((r.left_id, r.right_id) for r in walk.collect()) == [(i, i) for i in range(30)]


def test_equal_names_are_paired_by_id(spark):
    rows = spark.createDataFrame([(i, "parks") for i in range(50)], "id long, name string")
    walk = crosswalk(rows, rows.withColumn("id", F.col("id") + 100))
    assert sorted((r.left_id, r.right_id) for r in walk.collect()) == [(i, i + 100) for i in range(50)]


def test_empty_lists(spark):
    rows = spark.createDataFrame([(1, "parks")], "id long, name string")
    for a, b in ((rows.limit(0), rows), (rows, rows.limit(0)), (rows.limit(0), rows.limit(0))):
        assert crosswalk(a, b).count() == 0


def test_recoded_master_on_shipped_rows(spark):
    left, right = tm.employee_names(spark, SF_SMALL), tm.recoded_names(spark, SF_SMALL)
    walk = {r.left_id: r.right_id for r in R.crosswalk_employees(spark, SF_SMALL).collect()}
    there = {r.id for r in right.collect()}
    for r in left.collect():
        if r.id % 10 and r.id + 1_000_000 in there:
            assert walk[r.id] == r.id + 1_000_000
    rows = tm.snapshot(spark, SF_SMALL, ["EmployeeID", "FiscalYear"])
    report = {r.matched_by: r for r in R.crosswalk_orphans(spark, SF_SMALL).collect()}
    assert report["code"].n_orphans == report["code"].n_rows == rows.count()
    assert report["crosswalk"].n_orphans < 0.2 * rows.count()
    by_code = translated(rows, "EmployeeID", R.crosswalk_employees(spark, SF_SMALL), "MasterID")
    assert by_code.where("MasterID IS NULL").count() == report["crosswalk"].n_orphans
    assert orphan_report(rows.limit(0), "EmployeeID", right, R.crosswalk_employees(spark, SF_SMALL)).count() == 2
