"""User-level questions over the star: allocation over time, public access."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.operators.dedup import dedup_by
from starmart.operators.joins import checked_broadcast

TOTAL = T.DecimalType(38, 2)


def lookup(dim: DataFrame, key: str) -> DataFrame:
    """A dimension as the side of a lookup: one row per key whatever was passed
    in (of several the greatest), so that it can never multiply the rows it is
    joined to; broadcast behind the size check."""
    rest = [c for c in dim.columns if c != key]
    return checked_broadcast(dedup_by(dim, [key], rest, keep="last"))


def allocation_by_agency_year(fact: DataFrame, agency: DataFrame, time: DataFrame) -> DataFrame:
    """Pay per agency and fiscal year.

    Pay bases differ by row (annum, day, hour), so base salaries are not
    summed; the paid amounts are. Two aggregation levels instead of
    ``countDistinct`` next to sums (which makes Spark copy every row through
    an Expand before the first shuffle): first per (agency, year, employee),
    then per (agency, year), where counting the first level's rows counts
    distinct employees. Both levels combine map-side, so neither a hot agency
    nor a hot employee lands whole in one task. The small dimensions are
    joined to the aggregated rows only.
    """
    paid = F.col("RegularGrossPaid") + F.col("TotalOTPaid") + F.col("TotalOtherPay")
    # fact rows that still carry FiscalYear (Star.fact_rows) group by it
    # directly; the published fact has only TimeID and looks the year up
    year = "FiscalYear" if "FiscalYear" in fact.columns else "TimeID"
    per_employee = fact.groupBy("AgencyID", year, "EmployeeID").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("RegularGrossPaid").alias("gross"),
        F.sum("TotalOTPaid").alias("ot"),
        F.sum("TotalOtherPay").alias("other"),
        F.sum(paid).alias("paid"),
    )
    agg = per_employee.groupBy("AgencyID", year).agg(
        F.sum("n").alias("n_rows"),
        F.count(F.lit(1)).alias("n_employees"),
        F.sum("gross").cast(TOTAL).alias("total_gross"),
        F.sum("ot").cast(TOTAL).alias("total_ot"),
        F.sum("other").cast(TOTAL).alias("total_other"),
        F.sum("paid").cast(TOTAL).alias("total_paid"),
    )
    if year == "TimeID":
        agg = agg.join(lookup(time, "TimeID"), ["TimeID"])
    out = agg.join(lookup(agency, "AgencyID"), ["AgencyID"])
    return out.select("AgencyID", "AgencyName", "FiscalYear", "n_rows", "n_employees",
                      "total_gross", "total_ot", "total_other", "total_paid")


def allocation_year_over_year(alloc: DataFrame) -> DataFrame:
    """Change of total pay against the agency's previous fiscal year.

    The window runs over the already aggregated rows: one partition per agency
    holds one row per year, so no partition grows with the payroll.
    """
    w = Window.partitionBy("AgencyID").orderBy("FiscalYear")
    prev = F.lag("total_paid").over(w)
    return alloc.select(
        "AgencyID", "AgencyName", "FiscalYear", "total_paid",
        prev.alias("prev_total_paid"),
        (F.col("total_paid") - prev).cast(TOTAL).alias("change_paid"),
        F.lag("FiscalYear").over(w).alias("prev_fiscal_year"),
    )


PUBLIC_VIEW = "public_payroll"
PUBLIC_COLUMNS = ["AgencyName", "TitleDescription", "FiscalYear", "PayBasis", "BaseSalary", "RegularHours",
                  "RegularGrossPaid", "OTHours", "TotalOTPaid", "TotalOtherPay"]


def public_view(spark: SparkSession, fact: DataFrame, agency: DataFrame, title: DataFrame,
                time: DataFrame, name: str = PUBLIC_VIEW) -> DataFrame:
    """What a public user may see: pay by agency, title and year, without
    employee id or names and without the fact's key, whose order follows the
    employee. Registered as a temporary view ``name``."""
    pub = (fact.join(lookup(agency, "AgencyID"), ["AgencyID"])
           .join(lookup(title, "TitleCode"), ["TitleCode"])
           .join(lookup(time, "TimeID"), ["TimeID"])
           .select(*PUBLIC_COLUMNS))
    pub.createOrReplaceTempView(name)
    return spark.table(name)


def partition_pruned_scan(spark: SparkSession, path: str, year_col: str, year: int) -> DataFrame:
    """Read one fiscal year of a year-partitioned table: the filter on the
    partition column prunes directories before any file is opened."""
    return spark.read.parquet(path).where(F.col(year_col) == F.lit(year))
