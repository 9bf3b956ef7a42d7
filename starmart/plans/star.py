"""Star-schema builders: clean -> dedup -> dimensions -> fact.

Two ways to attach dimension keys to the fact:

* by id (default): the payroll row already carries EmployeeID, AgencyID and
  TitleCode, so the only lookup is FiscalYear -> TimeID against a dimension of
  distinct years (broadcast, its size bounded by the calendar and checked).
  No join over the big side at all.
* ``natural=True``: the reference's way, matching the employee by
  (LastName, FirstName, LeaveStatusasofJune30, WorkLocationBorough), the
  agency by name, the title by description. Kept for parity; each natural key
  is first checked to be unique in its dimension, because a repeated key
  multiplies fact rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart import schemas as S
from starmart.functions.clean import fill_nulls_by_type, parse_dates
from starmart.operators.dedup import dedup_by, distinct_of
from starmart.operators.joins import assert_unique, checked_broadcast, join_dimension
from starmart.operators.keys import dense_key, dense_key_small
from starmart.sources.csv import PROVENANCE

BUSINESS_KEY = ["EmployeeID", "FiscalYear"]


def dedup_snapshots(df: DataFrame, total_order: bool = False, keep_provenance: bool = False) -> DataFrame:
    """At most one payroll row per (EmployeeID, FiscalYear): the lowest
    PayrollNumber (a null one loses). The number names an agency's payroll and
    repeats within it, so ties are usual: where the rows carry their file
    (``load_snapshots(provenance=True)``), the newest file wins a tie, then the
    first path; only rows of one file fall to their other columns.

    ``total_order`` declares that PayrollNumber is unique within the key;
    ``keep_provenance`` keeps the rows' file, for a later dedup with more rows."""
    if PROVENANCE not in df.columns:
        return dedup_by(df, BUSINESS_KEY, ["PayrollNumber"], keep="first", total_order=total_order)
    # what decides after the number, smallest first: newer files are smaller
    aged = df.withColumns({"_age": -F.unix_micros(f"{PROVENANCE}.at"), "_path": F.col(f"{PROVENANCE}.path")})
    one = dedup_by(aged.drop(PROVENANCE), BUSINESS_KEY, ["PayrollNumber", "_age", "_path"], keep="first")
    if keep_provenance:
        one = one.withColumn(PROVENANCE, F.struct(F.timestamp_micros(-F.col("_age")).alias("at"),
                                                  F.col("_path").alias("path")))
    return one.drop("_age", "_path")


def clean_payroll(df: DataFrame, keep_raw_date: bool = False) -> DataFrame:
    """Parse the start date (bad text -> null, row kept), then fill nulls by type.

    The date is parsed before the fill, so a date column is never filled; the
    kept raw text (``keep_raw_date``) is not filled either.
    """
    parsed = parse_dates(df, ["AgencyStartDate"], keep_raw=keep_raw_date)
    return fill_nulls_by_type(parsed, exclude=["AgencyStartDate_raw"])


def build_employee_dim(df: DataFrame) -> DataFrame:
    """One row per employee with the attributes of the latest fiscal year
    (then the highest payroll number)."""
    return _latest(df, "EmployeeID", S.EMPLOYEE_COLS)


def _latest(df: DataFrame, key: str, cols: list[str]) -> DataFrame:
    order = ["FiscalYear", "PayrollNumber"]
    return dedup_by(df.select(*cols, *order), [key], order, keep="last").select(*cols)


def build_agency_dim(df: DataFrame) -> DataFrame:
    """One row per agency, named as in its latest fiscal year; ``renamed`` tells
    which ones had another name before."""
    return _latest(df, "AgencyID", S.AGENCY_COLS)


def build_title_dim(df: DataFrame) -> DataFrame:
    """One row per title code, described as in its latest fiscal year."""
    return _latest(df, "TitleCode", S.TITLE_COLS)


def renamed(df: DataFrame, key: str, name: str) -> DataFrame:
    """Keys that come with more than one name: (key, n_names)."""
    return (distinct_of(df, [key, name]).groupBy(key).agg(F.count(F.lit(1)).alias("n_names"))
            .where("n_names > 1"))


def build_time_dim(df: DataFrame) -> DataFrame:
    """Distinct fiscal years, keyed 1..n in year order (domain-bounded frame)."""
    years = distinct_of(df, ["FiscalYear"])
    return dense_key_small(years, ["FiscalYear"], "TimeID").select(*S.TIME_COLS)


@dataclass
class Star:
    """The four dimensions and the fact. The fact is built on first use: its
    dense key cuts lineage with a checkpoint (an action), which a caller that
    only wants a dimension should not pay for."""
    employee: DataFrame
    agency: DataFrame
    jobtitle: DataFrame
    time: DataFrame
    make_fact: Callable[[], DataFrame] | None = None
    _fact: DataFrame | None = None
    make_fact_rows: Callable[[], DataFrame] | None = None

    @property
    def fact(self) -> DataFrame:
        if self._fact is None:
            self._fact = self.make_fact()
        return self._fact

    def fact_rows(self) -> DataFrame:
        """The fact's rows and dimension keys without PayrollID: for marts that
        aggregate and never read the surrogate key, so they skip the dense-key
        pass (its range shuffle and checkpoint)."""
        if self.make_fact_rows is None:
            return self.fact.drop("PayrollID")
        return self.make_fact_rows()

    def tables(self) -> dict[str, DataFrame]:
        return {"employee": self.employee, "agency": self.agency, "jobtitle": self.jobtitle,
                "time": self.time, "fact_table": self.fact}


def build_fact_rows(df: DataFrame, time_dim: DataFrame, employee_dim: DataFrame | None = None,
                    agency_dim: DataFrame | None = None, title_dim: DataFrame | None = None,
                    natural: bool = False, guard: bool = True) -> DataFrame:
    """Fact columns except PayrollID, plus FiscalYear (the key's leading order)."""
    if not natural:
        keyed = df.join(checked_broadcast(time_dim), ["FiscalYear"], "inner")
        base = keyed.select(*[c for c in S.FACT_COLS if c != "PayrollID"], "FiscalYear")
    else:
        if guard:
            assert_unique(employee_dim, S.EMPLOYEE_NATURAL, "employee dimension")
            assert_unique(agency_dim, ["AgencyName"], "agency dimension")
            assert_unique(title_dim, ["TitleDescription"], "job title dimension")
        j = df.join(employee_dim.alias("e"), S.EMPLOYEE_NATURAL, "inner")
        j = join_dimension(j, agency_dim, ["AgencyName"], "a")
        j = join_dimension(j, title_dim, ["TitleDescription"], "t")
        j = join_dimension(j, time_dim, ["FiscalYear"], "d")
        base = j.select(
            F.col("e.EmployeeID").alias("EmployeeID"), F.col("a.AgencyID").alias("AgencyID"),
            F.col("t.TitleCode").alias("TitleCode"), "TimeID", "PayrollNumber", "BaseSalary",
            "PayBasis", "AgencyStartDate", *S.MEASURES, "FiscalYear")
    return base


FACT_ORDER = ["FiscalYear", "EmployeeID", "PayrollNumber", "AgencyID", "TitleCode"]


def build_fact(df: DataFrame, time_dim: DataFrame, employee_dim: DataFrame | None = None,
               agency_dim: DataFrame | None = None, title_dim: DataFrame | None = None,
               natural: bool = False, guard: bool = True) -> DataFrame:
    """Fact rows with a dense PayrollID in ``FACT_ORDER``."""
    base = build_fact_rows(df, time_dim, employee_dim, agency_dim, title_dim, natural, guard)
    return dense_key(base, FACT_ORDER, "PayrollID").select(*S.FACT_COLS)


def build_star(payroll: DataFrame, natural: bool = False, guard: bool = True,
               materialize=None) -> Star:
    """Dimensions and fact from a cleaned, deduplicated payroll frame.

    ``materialize(name, df) -> df`` (optional) writes a dimension once and
    returns the re-read table, so the fact and every later consumer read the
    same keys instead of re-deriving them from the snapshots.
    """
    keep = materialize or (lambda name, d: d)
    emp = keep("employee", build_employee_dim(payroll))
    agency = keep("agency", build_agency_dim(payroll))
    title = keep("jobtitle", build_title_dim(payroll))
    time = keep("time", build_time_dim(payroll))
    return Star(emp, agency, title, time,
                make_fact=lambda: build_fact(payroll, time, emp, agency, title,
                                             natural=natural, guard=guard),
                make_fact_rows=lambda: build_fact_rows(payroll, time, emp, agency, title,
                                                       natural=natural, guard=guard))
