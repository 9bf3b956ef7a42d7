"""Fixed schemas, rename map and key declarations of the payroll star."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(10, 2)
TOTAL = T.DecimalType(20, 2)  # what Spark gives for sum(decimal(10,2))

# The 19 snapshot columns in file order, and the header drift
# seen between yearly files (the 2021 file calls column 3 AgencyCode).
PAYROLL_COLUMNS = [
    "FiscalYear", "PayrollNumber", "AgencyID", "AgencyName", "EmployeeID",
    "LastName", "FirstName", "AgencyStartDate", "WorkLocationBorough",
    "TitleCode", "TitleDescription", "LeaveStatusasofJune30", "BaseSalary",
    "PayBasis", "RegularHours", "RegularGrossPaid", "OTHours", "TotalOTPaid",
    "TotalOtherPay",
]
RENAMES = {"AgencyCode": "AgencyID"}

MEASURES = ["RegularHours", "RegularGrossPaid", "OTHours", "TotalOTPaid", "TotalOtherPay"]
PAID = ["RegularGrossPaid", "TotalOTPaid", "TotalOtherPay"]

# Ids that grow with the data are 64-bit; code lists stay 32-bit. The start
# date arrives as M/d/yyyy text and is parsed after the read.
PAYROLL_SCHEMA = T.StructType([
    T.StructField("FiscalYear", T.IntegerType()),
    T.StructField("PayrollNumber", T.LongType()),
    T.StructField("AgencyID", T.IntegerType()),
    T.StructField("AgencyName", T.StringType()),
    T.StructField("EmployeeID", T.LongType()),
    T.StructField("LastName", T.StringType()),
    T.StructField("FirstName", T.StringType()),
    T.StructField("AgencyStartDate", T.StringType()),
    T.StructField("WorkLocationBorough", T.StringType()),
    T.StructField("TitleCode", T.IntegerType()),
    T.StructField("TitleDescription", T.StringType()),
    T.StructField("LeaveStatusasofJune30", T.StringType()),
    T.StructField("BaseSalary", MONEY),
    T.StructField("PayBasis", T.StringType()),
    T.StructField("RegularHours", MONEY),
    T.StructField("RegularGrossPaid", MONEY),
    T.StructField("OTHours", MONEY),
    T.StructField("TotalOTPaid", MONEY),
    T.StructField("TotalOtherPay", MONEY),
])

EMP_MASTER_SCHEMA = T.StructType([
    T.StructField("EmployeeID", T.LongType()),
    T.StructField("LastName", T.StringType()),
    T.StructField("FirstName", T.StringType()),
])
AGENCY_MASTER_SCHEMA = T.StructType([
    T.StructField("AgencyID", T.IntegerType()),
    T.StructField("AgencyName", T.StringType()),
])
TITLE_MASTER_SCHEMA = T.StructType([
    T.StructField("TitleCode", T.IntegerType()),
    T.StructField("TitleDescription", T.StringType()),
])

# Columns of the dimensions in output order, and the attributes
# the fact is matched on in parity mode (the natural key).
EMPLOYEE_COLS = ["EmployeeID", "LastName", "FirstName", "WorkLocationBorough",
                 "LeaveStatusasofJune30"]
EMPLOYEE_NATURAL = ["LastName", "FirstName", "LeaveStatusasofJune30", "WorkLocationBorough"]
AGENCY_COLS = ["AgencyID", "AgencyName"]
TITLE_COLS = ["TitleCode", "TitleDescription"]
TIME_COLS = ["TimeID", "FiscalYear"]

# Columns of the fact in output order.
FACT_COLS = [
    "PayrollID", "EmployeeID", "AgencyID", "TitleCode", "TimeID", "PayrollNumber",
    "BaseSalary", "PayBasis", "AgencyStartDate", "RegularHours", "RegularGrossPaid",
    "OTHours", "TotalOTPaid", "TotalOtherPay",
]

# The columns a payroll row is matched on with each master.
EMP_MASTER_KEYS = ["EmployeeID", "LastName", "FirstName"]
AGENCY_MASTER_KEYS = ["AgencyID", "AgencyName"]
TITLE_MASTER_KEYS = ["TitleCode", "TitleDescription"]

_STAGE_TYPES = {f.name: f.dataType for f in PAYROLL_SCHEMA.fields} | {
    "AgencyStartDate": T.DateType(), "PayrollID": T.LongType(), "TimeID": T.LongType()}

# Stage tables are read back with these, never with guessed types.
STAGE = {name: T.StructType([T.StructField(c, _STAGE_TYPES[c]) for c in cols]) for name, cols in {
    "employee": EMPLOYEE_COLS, "agency": AGENCY_COLS, "jobtitle": TITLE_COLS, "time": TIME_COLS,
    "fact_table": FACT_COLS}.items()} | {
    "payroll_merged": PAYROLL_SCHEMA,
    "quality_report": T.StructType([T.StructField("check_name", T.StringType()),
                                    T.StructField("violations", T.LongType())])}

# The warehouse DDL (table -> columns with types), primary and
# foreign keys, and the VARCHAR limit. Ids that grow with the data are 64-bit
# in the catalog; ``with_int_keys`` gives the 32-bit form for a database whose
# tables were made with INT keys.
VARCHAR_LIMIT = 1000
WAREHOUSE = {
    "employee": T.StructType([
        T.StructField("employeeid", T.LongType(), False),
        T.StructField("lastname", T.StringType()),
        T.StructField("firstname", T.StringType()),
        T.StructField("worklocationborough", T.StringType()),
        T.StructField("leavestatusasofjune30", T.StringType()),
    ]),
    "agency": T.StructType([
        T.StructField("agencyid", T.IntegerType(), False),
        T.StructField("agencyname", T.StringType()),
    ]),
    "jobtitle": T.StructType([
        T.StructField("titlecode", T.IntegerType(), False),
        T.StructField("titledescription", T.StringType()),
    ]),
    "time": T.StructType([
        T.StructField("timeid", T.IntegerType(), False),
        T.StructField("fiscalyear", T.IntegerType()),
    ]),
    "fact_table": T.StructType([
        T.StructField("payrollid", T.LongType(), False),
        T.StructField("employeeid", T.LongType()),
        T.StructField("agencyid", T.IntegerType()),
        T.StructField("titlecode", T.IntegerType()),
        T.StructField("timeid", T.IntegerType()),
        T.StructField("payrollnumber", T.LongType()),
        T.StructField("basesalary", MONEY),
        T.StructField("paybasis", T.StringType()),
        T.StructField("agencystartdate", T.DateType()),
        T.StructField("regularhours", MONEY),
        T.StructField("regulargrosspaid", MONEY),
        T.StructField("othours", MONEY),
        T.StructField("totalotpaid", MONEY),
        T.StructField("totalotherpay", MONEY),
    ]),
}
PRIMARY_KEYS = {"employee": "employeeid", "agency": "agencyid", "jobtitle": "titlecode",
                "time": "timeid", "fact_table": "payrollid"}
FOREIGN_KEYS = {"employeeid": "employee", "agencyid": "agency", "titlecode": "jobtitle",
                "timeid": "time"}
LOAD_ORDER = ["employee", "agency", "jobtitle", "time", "fact_table"]


def with_int_keys(schema: T.StructType) -> T.StructType:
    """``schema`` with 32-bit ids; casting a larger id to it fails the job."""
    return T.StructType([T.StructField(f.name, T.IntegerType() if f.dataType == T.LongType() else f.dataType,
                                       f.nullable) for f in schema.fields])
