"""The shipped payroll CSVs read as data; numbers from FIXTURES.md section 3.
Point STARMART_PAYROLL_DATA at the folder holding them; skipped otherwise."""

import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import REF_DATA
from starmart import schemas as S
from starmart.plans import jobs, marts
from starmart.plans.star import build_star, clean_payroll, dedup_snapshots
from starmart.sources.csv import discover_files, load_snapshots, read_csv

pytestmark = pytest.mark.skipif(not REF_DATA or not os.path.isdir(REF_DATA),
                                reason="STARMART_PAYROLL_DATA not set")
PAYROLL_DIR = f"{REF_DATA}/payroll_data"


@pytest.fixture(scope="module")
def merged(spark):
    return load_snapshots(spark, discover_files(spark, PAYROLL_DIR, "*payroll_*.csv"))


@pytest.fixture(scope="module")
def pay(merged):
    return clean_payroll(dedup_snapshots(merged))


def test_rows_before_and_after_dedup(merged, pay):
    assert merged.count() == 201
    assert pay.count() == 201


def test_no_nulls_and_no_bad_dates(merged, pay):
    from starmart.functions.clean import null_audit
    assert sum(r.null_count for r in null_audit(merged).collect()) == 0
    assert pay.where(F.col("AgencyStartDate").isNull()).count() == 0


def test_dimension_sizes(pay):
    s = build_star(pay)
    assert (s.employee.count(), s.agency.count(), s.jobtitle.count(), s.time.count()) == (200, 25, 44, 4)
    assert s.fact.count() == 201
    assert build_star(pay, natural=True).fact.count() == 201


def test_year_totals(pay):
    got = {r.FiscalYear: r for r in pay.groupBy("FiscalYear").agg(
        F.count(F.lit(1)).alias("n"), F.sum("RegularHours").alias("hours"),
        F.sum("RegularGrossPaid").alias("gross"), F.sum("TotalOtherPay").alias("other")).collect()}
    assert {y: r.n for y, r in got.items()} == {1998: 1, 1999: 1, 2020: 99, 2021: 100}
    assert got[2021].gross == Decimal("16611156.53")
    assert got[2020].hours == Decimal("114673.75")
    assert got[2021].other == Decimal("2988364.37")
    total = pay.agg(F.sum("RegularGrossPaid")).first()[0]
    assert total == Decimal("22884717.30")


def test_pay_basis_and_master_matches(spark, pay):
    basis = {r.PayBasis: r["count"] for r in pay.groupBy("PayBasis").count().collect()}
    assert basis == {"per Annum": 152, "per Day": 41, "per Hour": 8}
    emp = read_csv(spark, f"{REF_DATA}/raw/EmpMaster.csv", schema=S.EMP_MASTER_SCHEMA)
    agency = read_csv(spark, f"{REF_DATA}/raw/AgencyMaster.csv", schema=S.AGENCY_MASTER_SCHEMA)
    assert emp.count() == 1000 and agency.count() == 153
    assert pay.join(emp, ["EmployeeID", "LastName", "FirstName"], "left_semi").count() == 0
    hits = pay.join(agency, ["AgencyID", "AgencyName"], "left_semi")
    assert {r.FiscalYear: r["count"] for r in hits.groupBy("FiscalYear").count().collect()} == {2020: 99, 1998: 1}


def test_top_agencies(pay):
    top = pay.groupBy("AgencyName").agg(F.count(F.lit(1)).alias("n"),
                                        F.sum("RegularGrossPaid").alias("gross")) \
        .orderBy(F.desc("gross")).limit(3).collect()
    assert [(r.AgencyName, r.n, r.gross) for r in top] == [
        ("DEPT OF HEALTH/MENTAL HYGIENE", 30, Decimal("5991593.59")),
        ("OFFICE OF EMERGENCY MANAGEMENT", 87, Decimal("3766887.33")),
        ("OFFICE OF MANAGEMENT & BUDGET", 13, Decimal("2374894.24")),
    ]


def test_staged_job_on_shipped_data(spark, scratch):
    cfg = jobs.JobConfig(snapshot_dir=PAYROLL_DIR, stage_dir=f"{scratch}/stage",
                         emp_master=f"{REF_DATA}/raw/EmpMaster.csv",
                         agency_master=f"{REF_DATA}/raw/AgencyMaster.csv",
                         database="payroll_test")
    tables = jobs.run_all(spark, cfg)
    counts = {n: t.count() for n, t in tables.items()}
    assert counts == {"employee": 200, "agency": 25, "jobtitle": 44, "time": 4, "fact_table": 201}
    assert dict(tables["fact_table"].dtypes)["payrollid"] == "bigint"
    report = {r.check_name: r.violations for r in
              jobs.read_stage_table(spark, cfg, "quality_report", jobs.last_run(spark, cfg)).collect()}
    assert report["emp_master_orphans"] == 201
    assert report["agency_master_orphans"] == 101
    assert report["start_after_fiscal_year"] == 2            # the 1998 and 1999 rows
    assert all(v == 0 for k, v in report.items() if k.startswith(("pk_", "fk_", "length_")))
    assert all(report[f"null_{c}"] == 0 for c in S.PAYROLL_COLUMNS)   # FIXTURES: no empty field
    alloc = spark.table(f"{cfg.database}.{jobs.ALLOCATION_TABLE}")
    assert alloc.agg(F.sum("total_gross")).first()[0] == Decimal("22884717.30")
    assert alloc.agg(F.sum("n_rows")).first()[0] == 201
    public = spark.table(f"{cfg.database}.{marts.PUBLIC_VIEW}")
    assert public.count() == 201
    assert not {"employeeid", "lastname", "firstname"} & {c.lower() for c in public.columns}


def test_inference_path_widens_like_the_reference(spark):
    """infer=True: RegularHours is int in 2021 and double in 2020; the union
    by name widens to double, and the drifted column still lands by name."""
    paths = discover_files(spark, PAYROLL_DIR, "*payroll_*.csv")
    for order in (paths, list(reversed(paths))):
        df = load_snapshots(spark, order, infer=True)
        types = dict(df.dtypes)
        assert types["RegularHours"] == "double" and types["AgencyID"] == "int"
        assert df.count() == 201
        assert df.where("AgencyID IS NULL").count() == 0
