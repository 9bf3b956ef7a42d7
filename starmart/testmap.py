"""The driver's TPC-H-style tables put into payroll shape.

The test tables hold no payroll, so a payroll row is an order of a customer:

  FiscalYear            year(o_orderdate)
  PayrollNumber         o_orderkey
  AgencyID, AgencyName  n_nationkey, n_name          (customer's nation)
  EmployeeID            c_custkey
  LastName, FirstName   c_name, c_mktsegment
  AgencyStartDate       o_orderdate as M/d/yyyy text
  WorkLocationBorough   r_name                       (nation's region)
  TitleCode, -Descr.    leading digit of o_orderpriority, o_orderpriority
  LeaveStatusasofJune30 o_orderstatus                (changes between years)
  BaseSalary            c_acctbal (may be negative)
  PayBasis              by title code: 1-2 per Annum, 3-4 per Day, else per Hour
  RegularHours          sum of the order's l_quantity
  RegularGrossPaid      o_totalprice
  OTHours, TotalOTPaid  quantity, extended price of the order's returned lines
  TotalOtherPay         extended price of the order's open lines

Amounts are cast to decimals before they are summed (line amounts to
decimal(8,2), the rest to decimal(10,2)), so both engines add exact numbers.
Lines are aggregated per order before the join (partial aggregate map-side),
then joined to orders on the order key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart import schemas as S

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "documents"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def money(c) -> F.Column:
    return (F.col(c) if isinstance(c, str) else c).cast(S.MONEY)


# A line's quantity and extended price fit decimal(8,2) (quantity <= 50, price
# below 10^6). A value that does not fit fails the cast (ANSI mode).
LINE = T.DecimalType(8, 2)


def cents(name: str) -> F.Column:
    """Hundredths of a line's amount, as its cast to ``LINE`` gives them. Amounts
    that are whole hundredths, as nearly all are, need no decimal: the double
    nearest to n/100 reads as n/100."""
    amount = F.col(name)
    n = F.rint(amount * 100)
    whole = (n / 100 == amount) & (F.abs(amount) < 1_000_000)
    return F.when(whole, n.cast("long")).otherwise((amount.cast(LINE) * 100).cast("long"))


def line_totals(lineitem: DataFrame) -> DataFrame:
    """Sums of an order's lines, added up as 64-bit hundredths."""
    returned = F.col("l_returnflag") == "R"
    open_ = F.col("l_linestatus") == "O"
    hundredth = F.lit("0.01").cast(T.DecimalType(2, 2))
    lines = lineitem.select("l_orderkey", returned.alias("returned"), open_.alias("open"),
                            cents("l_quantity").alias("qty"), cents("l_extendedprice").alias("price"))
    return lines.groupBy("l_orderkey").agg(
        F.sum("qty").alias("hours"),
        F.sum(F.when(F.col("returned"), F.col("qty"))).alias("ot_hours"),
        F.sum(F.when(F.col("returned"), F.col("price"))).alias("ot_paid"),
        F.sum(F.when(F.col("open"), F.col("price"))).alias("other_pay"),
    ).select("l_orderkey", *[(F.coalesce(F.col(c), F.lit(0)).cast(T.DecimalType(18, 0)) * hundredth)
                             .cast(S.MONEY).alias(c) for c in ["hours", "ot_hours", "ot_paid", "other_pay"]])


# columns that come from the order's lines
FROM_LINES = {"RegularHours", "OTHours", "TotalOTPaid", "TotalOtherPay"}


def snapshot(spark: SparkSession, sf_dir: str, columns: list[str] | None = None) -> DataFrame:
    """Payroll rows (one per order): ``columns`` or all of
    ``schemas.PAYROLL_COLUMNS``, in that order. The lines are read and summed
    only for columns that come from them."""
    columns = S.PAYROLL_COLUMNS if columns is None else [c for c in S.PAYROLL_COLUMNS if c in columns]
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    # region and nation have 5 and 25 rows at every scale factor (fixed by
    # the TPC-H definition), so broadcasting them is bounded without a check
    geo = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_name")
    j = (o.join(c, o.o_custkey == c.c_custkey)
         .join(F.broadcast(geo), c.c_nationkey == geo.n_nationkey))
    if FROM_LINES & set(columns):
        lt = line_totals(table(spark, sf_dir, "lineitem"))
        j = j.join(lt, o.o_orderkey == lt.l_orderkey, "left")
    code = F.substring("o_orderpriority", 1, 1).cast("int")
    zero = F.lit(0).cast(S.MONEY)
    made = [
        F.year("o_orderdate").alias("FiscalYear"),
        F.col("o_orderkey").alias("PayrollNumber"),
        F.col("n_nationkey").alias("AgencyID"),
        F.col("n_name").alias("AgencyName"),
        F.col("c_custkey").alias("EmployeeID"),
        F.col("c_name").alias("LastName"),
        F.col("c_mktsegment").alias("FirstName"),
        F.date_format("o_orderdate", "M/d/yyyy").alias("AgencyStartDate"),
        F.col("r_name").alias("WorkLocationBorough"),
        code.alias("TitleCode"),
        F.col("o_orderpriority").alias("TitleDescription"),
        F.col("o_orderstatus").alias("LeaveStatusasofJune30"),
        money("c_acctbal").alias("BaseSalary"),
        F.when(code <= 2, "per Annum").when(code <= 4, "per Day").otherwise("per Hour").alias("PayBasis"),
        F.coalesce("hours", zero).alias("RegularHours"),
        money("o_totalprice").alias("RegularGrossPaid"),
        F.coalesce("ot_hours", zero).alias("OTHours"),
        F.coalesce("ot_paid", zero).alias("TotalOTPaid"),
        F.coalesce("other_pay", zero).alias("TotalOtherPay"),
    ]
    return j.select(*[m for name, m in zip(S.PAYROLL_COLUMNS, made) if name in columns])


def with_defects(snap: DataFrame) -> DataFrame:
    """The same rows with the defects raw files carry, made by fixed rules so
    the oracle can make the same ones: missing borough, unparsable or empty
    start date, missing hours, missing title code."""
    k = F.col("PayrollNumber")
    return snap.withColumns({
        "WorkLocationBorough": F.when(F.col("EmployeeID") % 7 == 0, F.lit(None).cast("string"))
                                .otherwise(F.col("WorkLocationBorough")),
        "AgencyStartDate": F.when(k % 11 == 0, F.lit("bad"))
                            .when(k % 13 == 0, F.lit(None).cast("string"))
                            .otherwise(F.col("AgencyStartDate")),
        "RegularHours": F.when(k % 17 == 0, F.lit(None).cast(S.MONEY)).otherwise(F.col("RegularHours")),
        "TitleCode": F.when(k % 19 == 0, F.lit(None).cast("int")).otherwise(F.col("TitleCode")),
    })


def emp_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Employee master: customers in good standing (balance >= 0); the rest are
    payroll employees missing from the master."""
    c = table(spark, sf_dir, "customer")
    return c.where(F.col("c_acctbal") >= 0).select(
        F.col("c_custkey").alias("EmployeeID"), F.col("c_name").alias("LastName"),
        F.col("c_mktsegment").alias("FirstName"))


def agency_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Agency master: nations outside region 0; region 0's nations are orphans."""
    n = table(spark, sf_dir, "nation")
    return n.where(F.col("n_regionkey") != 0).select(
        F.col("n_nationkey").alias("AgencyID"), F.col("n_name").alias("AgencyName"))


def title_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title master: the priority list from orders without the MEDIUM title."""
    o = table(spark, sf_dir, "orders")
    return o.where(F.col("o_orderpriority") != "3-MEDIUM").select(
        F.substring("o_orderpriority", 1, 1).cast("int").alias("TitleCode"),
        F.col("o_orderpriority").alias("TitleDescription")).distinct()


def employee_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, name) of the payroll's employees: customer, segment and nation."""
    c, n = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    joined = c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
    return joined.select(F.col("c_custkey").alias("id"), F.concat_ws(" ", "c_name", "c_mktsegment", "n_name").alias("name"))


def recoded_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, name) of a master with codes of its own: words in another order and
    spelling; every tenth lacks the customer's number, every 25th is missing."""
    c, n = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    joined = c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey).where(F.col("c_custkey") % 25 != 7)
    number = F.when(F.col("c_custkey") % 10 != 0, F.substring_index("c_name", "#", -1)).otherwise("-")
    return joined.select((F.col("c_custkey") + 1_000_000).alias("id"),
                         F.concat(F.upper("n_name"), F.lit(", "), F.lower("c_mktsegment"), F.lit(" / "), number,
                                  F.lit(" (CUST.)")).alias("name"))
