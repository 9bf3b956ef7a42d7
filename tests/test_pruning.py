"""Plans read only what their results need."""

import re

import pytest

from conftest import SF_SMALL
from starmart import testmap as tm
from starmart.operators import joins
from starmart.operators.dedup import assert_total_order
from starmart.plans import registered as R
from starmart.plans.star import BUSINESS_KEY


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", ["dim_time", "dim_agency", "dim_jobtitle", "dim_employee", "distinct_pairs",
                                 "distinct_years"])
def test_small_results_do_not_read_the_lines(spark, key):
    plan = _plan(R.QUERIES[key](spark, SF_SMALL))
    assert "lineitem" not in plan and "l_orderkey" not in plan
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schemas and max(len(s.split(",")) for s in schemas) <= 5


def test_time_reads_two_columns_of_the_orders(spark):
    plan = _plan(R.dim_time(spark, SF_SMALL))
    orders = [s for s in re.findall(r"ReadSchema: struct<([^>]*)>", plan) if "o_orderdate" in s]
    assert orders and all("o_totalprice" not in s and "o_orderpriority" not in s for s in orders)


def test_the_declared_order_is_total(spark):
    assert_total_order(tm.snapshot(spark, SF_SMALL, [*BUSINESS_KEY, "PayrollNumber"]), BUSINESS_KEY, ["PayrollNumber"])


def test_pruned_payroll_keeps_the_same_rows(spark):
    columns = ["EmployeeID", "FiscalYear", "PayrollNumber", "AgencyName", "TotalOTPaid"]
    full = R.payroll(spark, SF_SMALL).select(*columns)
    assert sorted(R.payroll(spark, SF_SMALL, columns).collect()) == sorted(full.collect())


def test_quality_report_scans(spark):
    checks, rows = R.quality_inputs(spark, SF_SMALL)
    from starmart.operators.quality import quality_report
    assert _plan(quality_report(checks, rows)).count("FileScan") < 28


def test_size_check_moves_no_rows(spark, monkeypatch):
    seen = []
    frame = type(spark.range(1))
    first = frame.first

    def spy(self):
        seen.append(_plan(self))
        return first(self)

    monkeypatch.setattr(frame, "first", spy)
    assert joins.small_enough(tm.table(spark, SF_SMALL, "nation"))
    assert not joins.small_enough(tm.table(spark, SF_SMALL, "nation"), limit=10)
    assert not joins.small_enough(tm.table(spark, SF_SMALL, "nation"), max_bytes=100)
    assert len(seen) == 3 and not any("Limit" in p for p in seen)
