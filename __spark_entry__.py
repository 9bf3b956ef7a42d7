"""

the driver's tables; ``oracle_sql()`` gives the same result as DuckDB SQL on
the same parquet views. Column names and types are aliased/cast alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from starmart.plans import registered as R
from starmart.schemas import PAYROLL_COLUMNS

try:  # the training-data operators are an optional part
    import corpus_pipeline
    from starmart.llm.oracles import ORACLE_SQL as LLM_ORACLES
    from starmart.llm.queries import QUERIES as LLM_QUERIES
    LLM_QUERIES = LLM_QUERIES | {"pipeline": corpus_pipeline.run}
except ModuleNotFoundError as e:
    # only where that part is absent: anything else that is missing is an error
    if e.name not in ("corpus_pipeline", "starmart.llm"):
        raise
    LLM_ORACLES, LLM_QUERIES = {}, {}

FLAGSHIP_SF = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: pay allocation by agency and fiscal year over the star."""
    return R.allocation_by_agency_year(spark, FLAGSHIP_SF)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return R.QUERIES | LLM_QUERIES


# --------------------------------------------------------------------------
# DuckDB oracles. The payroll shape of the test tables (starmart.testmap) is
# written once as CTEs and reused.

def _m(x: str) -> str:
    return f"CAST({x} AS DECIMAL(10,2))"


LINE_TOTALS = f"""
lt AS (
  SELECT l_orderkey,
    CAST(coalesce(sum({_m('l_quantity')}), 0) AS DECIMAL(10,2)) AS hours,
    CAST(coalesce(sum(CASE WHEN l_returnflag = 'R' THEN {_m('l_quantity')} END), 0) AS DECIMAL(10,2)) AS ot_hours,
    CAST(coalesce(sum(CASE WHEN l_returnflag = 'R' THEN {_m('l_extendedprice')} END), 0) AS DECIMAL(10,2)) AS ot_paid,
    CAST(coalesce(sum(CASE WHEN l_linestatus = 'O' THEN {_m('l_extendedprice')} END), 0) AS DECIMAL(10,2)) AS other_pay
  FROM lineitem GROUP BY l_orderkey)"""

SNAP = f"""{LINE_TOTALS},
snap AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS FiscalYear,
    o_orderkey AS PayrollNumber,
    n_nationkey AS AgencyID, n_name AS AgencyName,
    c_custkey AS EmployeeID, c_name AS LastName, c_mktsegment AS FirstName,
    strftime(o_orderdate, '%-m/%-d/%Y') AS AgencyStartDate,
    r_name AS WorkLocationBorough,
    CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS TitleCode,
    o_orderpriority AS TitleDescription,
    o_orderstatus AS LeaveStatusasofJune30,
    {_m('c_acctbal')} AS BaseSalary,
    CASE WHEN CAST(substr(o_orderpriority, 1, 1) AS INTEGER) <= 2 THEN 'per Annum'
         WHEN CAST(substr(o_orderpriority, 1, 1) AS INTEGER) <= 4 THEN 'per Day'
         ELSE 'per Hour' END AS PayBasis,
    CAST(coalesce(lt.hours, 0) AS DECIMAL(10,2)) AS RegularHours,
    {_m('o_totalprice')} AS RegularGrossPaid,
    CAST(coalesce(lt.ot_hours, 0) AS DECIMAL(10,2)) AS OTHours,
    CAST(coalesce(lt.ot_paid, 0) AS DECIMAL(10,2)) AS TotalOTPaid,
    CAST(coalesce(lt.other_pay, 0) AS DECIMAL(10,2)) AS TotalOtherPay
  FROM orders
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN lt ON o_orderkey = lt.l_orderkey)"""

# merged -> dedup (lowest PayrollNumber per employee and year) -> parse date
PAY = f"""{SNAP},
pay AS (
  SELECT * REPLACE (CAST(try_strptime(AgencyStartDate, '%m/%d/%Y') AS DATE) AS AgencyStartDate)
  FROM snap
  QUALIFY row_number() OVER (PARTITION BY EmployeeID, FiscalYear ORDER BY PayrollNumber) = 1)"""

# the same snapshot with the defects of raw files (testmap.with_defects),
# deduplicated, then parsed and filled by type
RAW_PAY = f"""{SNAP},
raw AS (
  SELECT * REPLACE (
    CASE WHEN EmployeeID % 7 = 0 THEN NULL ELSE WorkLocationBorough END AS WorkLocationBorough,
    CASE WHEN PayrollNumber % 11 = 0 THEN 'bad' WHEN PayrollNumber % 13 = 0 THEN NULL
         ELSE AgencyStartDate END AS AgencyStartDate,
    CASE WHEN PayrollNumber % 17 = 0 THEN NULL ELSE RegularHours END AS RegularHours,
    CASE WHEN PayrollNumber % 19 = 0 THEN NULL ELSE TitleCode END AS TitleCode)
  FROM snap),
rdedup AS (
  SELECT * FROM raw
  QUALIFY row_number() OVER (PARTITION BY EmployeeID, FiscalYear ORDER BY PayrollNumber) = 1),
rpay AS (
  SELECT * REPLACE (
      CAST(try_strptime(AgencyStartDate, '%m/%d/%Y') AS DATE) AS AgencyStartDate,
      coalesce(WorkLocationBorough, 'Unknown') AS WorkLocationBorough,
      CAST(coalesce(RegularHours, 0) AS DECIMAL(10,2)) AS RegularHours,
      coalesce(TitleCode, 0) AS TitleCode),
    AgencyStartDate AS AgencyStartDate_raw
  FROM rdedup)"""


def star_ctes(src: str, p: str = "") -> str:
    """Dimensions and fact (by id) over the payroll CTE ``src``; names get prefix ``p``."""
    return f"""
{p}time_dim AS (
  SELECT row_number() OVER (ORDER BY FiscalYear) AS TimeID, FiscalYear
  FROM (SELECT DISTINCT FiscalYear FROM {src})),
{p}agency_dim AS (
  SELECT AgencyID, AgencyName FROM {src}
  QUALIFY row_number() OVER (PARTITION BY AgencyID ORDER BY FiscalYear DESC, PayrollNumber DESC) = 1),
{p}title_dim AS (
  SELECT TitleCode, TitleDescription FROM {src}
  QUALIFY row_number() OVER (PARTITION BY TitleCode ORDER BY FiscalYear DESC, PayrollNumber DESC) = 1),
{p}employee_dim AS (
  SELECT EmployeeID, LastName, FirstName, WorkLocationBorough, LeaveStatusasofJune30
  FROM {src}
  QUALIFY row_number() OVER (PARTITION BY EmployeeID ORDER BY FiscalYear DESC, PayrollNumber DESC) = 1),
{p}fact AS (
  SELECT row_number() OVER (ORDER BY s.FiscalYear, s.EmployeeID, s.PayrollNumber, s.AgencyID, s.TitleCode) AS PayrollID,
    s.EmployeeID, s.AgencyID, s.TitleCode, t.TimeID, s.PayrollNumber, s.BaseSalary, s.PayBasis,
    s.AgencyStartDate, s.RegularHours, s.RegularGrossPaid, s.OTHours, s.TotalOTPaid, s.TotalOtherPay
  FROM {src} s JOIN {p}time_dim t ON s.FiscalYear = t.FiscalYear)"""


STAR = PAY + "," + star_ctes("pay")

FACT_NATURAL = STAR + """,
fact_nat AS (
  SELECT row_number() OVER (ORDER BY p.FiscalYear, e.EmployeeID, p.PayrollNumber, a.AgencyID, t.TitleCode) AS PayrollID,
    e.EmployeeID, a.AgencyID, t.TitleCode, d.TimeID, p.PayrollNumber, p.BaseSalary, p.PayBasis,
    p.AgencyStartDate, p.RegularHours, p.RegularGrossPaid, p.OTHours, p.TotalOTPaid, p.TotalOtherPay
  FROM pay p
  JOIN employee_dim e ON p.LastName = e.LastName AND p.FirstName = e.FirstName
    AND p.LeaveStatusasofJune30 = e.LeaveStatusasofJune30 AND p.WorkLocationBorough = e.WorkLocationBorough
  JOIN agency_dim a ON p.AgencyName = a.AgencyName
  JOIN title_dim t ON p.TitleDescription = t.TitleDescription
  JOIN time_dim d ON p.FiscalYear = d.FiscalYear)"""

HISTORY = f"""{PAY},
changed AS (
  SELECT EmployeeID, LastName, FirstName, WorkLocationBorough, LeaveStatusasofJune30, FiscalYear
  FROM pay
  WINDOW w AS (PARTITION BY EmployeeID ORDER BY FiscalYear)
  QUALIFY row_number() OVER w = 1 OR lag(LastName) OVER w IS DISTINCT FROM LastName
    OR lag(FirstName) OVER w IS DISTINCT FROM FirstName
    OR lag(WorkLocationBorough) OVER w IS DISTINCT FROM WorkLocationBorough
    OR lag(LeaveStatusasofJune30) OVER w IS DISTINCT FROM LeaveStatusasofJune30),
history AS (
  SELECT EmployeeID, LastName, FirstName, WorkLocationBorough, LeaveStatusasofJune30,
    CAST(row_number() OVER w AS INTEGER) AS version, FiscalYear AS valid_from,
    CAST(lead(FiscalYear) OVER w - 1 AS INTEGER) AS valid_to, lead(FiscalYear) OVER w IS NULL AS is_current
  FROM changed WINDOW w AS (PARTITION BY EmployeeID ORDER BY FiscalYear))"""

ALLOCATION = f"""{STAR},
alloc AS (
  SELECT f.AgencyID, a.AgencyName, t.FiscalYear,
    count(*) AS n_rows,
    count(DISTINCT f.EmployeeID) AS n_employees,
    CAST(sum(f.RegularGrossPaid) AS DECIMAL(38,2)) AS total_gross,
    CAST(sum(f.TotalOTPaid) AS DECIMAL(38,2)) AS total_ot,
    CAST(sum(f.TotalOtherPay) AS DECIMAL(38,2)) AS total_other,
    CAST(sum(f.RegularGrossPaid + f.TotalOTPaid + f.TotalOtherPay) AS DECIMAL(38,2)) AS total_paid
  FROM fact f JOIN time_dim t USING (TimeID) JOIN agency_dim a USING (AgencyID)
  GROUP BY f.AgencyID, a.AgencyName, t.FiscalYear)"""

MASTERS = """
emp_master AS (SELECT DISTINCT c_custkey AS EmployeeID, c_name AS LastName, c_mktsegment AS FirstName
               FROM customer WHERE c_acctbal >= 0),
agency_master AS (SELECT DISTINCT n_nationkey AS AgencyID, n_name AS AgencyName
                  FROM nation WHERE n_regionkey <> 0),
title_master AS (SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS TitleCode,
                   o_orderpriority AS TitleDescription
                 FROM orders WHERE o_orderpriority <> '3-MEDIUM')"""

EMP_ON = "p.EmployeeID = em.EmployeeID AND p.LastName = em.LastName AND p.FirstName = em.FirstName"
AGENCY_ON = "p.AgencyID = am.AgencyID AND p.AgencyName = am.AgencyName"
TITLE_ON = "p.TitleCode = tm.TitleCode AND p.TitleDescription = tm.TitleDescription"

CUST_NULLS = """cn AS (
  SELECT c_custkey,
    CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_name END AS c_name,
    CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_nationkey END AS c_nationkey,
    CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal,
    c_mktsegment,
    CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE DATE '2020-01-01' END AS c_since
  FROM customer)"""
CUST_NULL_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment", "c_since"]
CUSTOMER_TYPES = [("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"),
                  ("c_acctbal", "double"), ("c_mktsegment", "string")]

CANDIDATES = """
WITH e AS (
  SELECT c.c_custkey AS id, concat_ws(' ', c_name, c_mktsegment, n_name) AS name
  FROM customer c JOIN nation ON c_nationkey = n_nationkey),
m AS (
  SELECT c_custkey + 1000000 AS id, upper(n_name) || ', ' || lower(c_mktsegment) || ' / '
    || CASE WHEN c_custkey % 10 <> 0 THEN split_part(c_name, '#', 2) ELSE '-' END || ' (CUST.)' AS name
  FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 25 <> 7),
w AS (
  SELECT DISTINCT side, id, CASE WHEN word = 'cust' THEN 'customer' ELSE word END AS word
  FROM (SELECT 'l' AS side, id, unnest(regexp_extract_all(lower(name), '[a-z0-9]+')) AS word FROM e
        UNION ALL SELECT 'r', id, unnest(regexp_extract_all(lower(name), '[a-z0-9]+')) FROM m)),
weight AS (
  SELECT word, CAST(floor(1000 * ln(1 + (SELECT count(*) FROM (SELECT DISTINCT side, id FROM w))::DOUBLE / count(*))) AS BIGINT) AS weight
  FROM w GROUP BY word),
t AS (SELECT side, id, sum(weight) AS total FROM w JOIN weight USING (word) GROUP BY side, id),
s AS (
  SELECT l.id AS left_id, r.id AS right_id, sum(weight) AS shared
  FROM w l JOIN w r ON l.word = r.word AND l.side = 'l' AND r.side = 'r' JOIN weight ON l.word = weight.word
  GROUP BY l.id, r.id)
SELECT left_id, right_id, CAST(shared AS DOUBLE) / CAST(lt.total + rt.total - shared AS DOUBLE) AS score
FROM s JOIN t lt ON lt.side = 'l' AND lt.id = left_id JOIN t rt ON rt.side = 'r' AND rt.id = right_id
WHERE CAST(shared AS DOUBLE) / CAST(lt.total + rt.total - shared AS DOUBLE) >= 0.5"""


def _assignment_ctes(rounds: int = 3) -> str:
    """Rounds of pairs that are the best of both sides. SQL has no loop until
    nothing is left; on these tables the first round leaves nothing."""
    parts, left = [f"candidates AS ({CANDIDATES})"], "candidates"
    best = "row_number() OVER (PARTITION BY {} ORDER BY score DESC, left_id, right_id) = 1"
    for i in range(rounds):
        parts.append(f"picked{i} AS (SELECT * FROM {left} QUALIFY {best.format('left_id')} AND {best.format('right_id')})")
        parts.append(f"left{i} AS (SELECT * FROM {left} WHERE left_id NOT IN (SELECT left_id FROM picked{i})"
                     f" AND right_id NOT IN (SELECT right_id FROM picked{i}))")
        left = f"left{i}"
    return ", ".join(parts) + ", walk AS (" + " UNION ALL ".join(f"SELECT * FROM picked{i}" for i in range(rounds)) + ")"


FACT_WAREHOUSE = """SELECT CAST(PayrollID AS BIGINT) AS payrollid, CAST(EmployeeID AS BIGINT) AS employeeid,
  AgencyID AS agencyid, TitleCode AS titlecode, CAST(TimeID AS INTEGER) AS timeid,
  CAST(PayrollNumber AS BIGINT) AS payrollnumber, BaseSalary AS basesalary, PayBasis AS paybasis,
  AgencyStartDate AS agencystartdate, RegularHours AS regularhours, RegularGrossPaid AS regulargrosspaid,
  OTHours AS othours, TotalOTPaid AS totalotpaid, TotalOtherPay AS totalotherpay
FROM fact"""


def _release_sql(k: int) -> str:
    """Level after level: groups of ``k`` people or more, then what is left."""
    levels = [("agency and title", "AgencyName", "TitleDescription"),
              ("agency and family", "AgencyName", "split_part(TitleDescription, ' ', 1)"),
              ("agency", "AgencyName", "'*'"), ("borough", "WorkLocationBorough", "'*'"), ("year", "'*'", "'*'")]
    ctes, outs, left = [PAY.strip()], [], "pay"
    for i, (name, place, title) in enumerate(levels):
        ctes.append(f"g{i} AS (SELECT *, {place} AS place_, {title} AS title_ FROM {left})")
        ctes.append(f"""v{i} AS (SELECT *, count(DISTINCT EmployeeID) OVER (PARTITION BY place_, title_, FiscalYear) AS people FROM g{i})""")
        outs.append(f"""SELECT '{name}' AS level, place_ AS place, title_ AS title, CAST(FiscalYear AS VARCHAR) AS year,
  count(DISTINCT EmployeeID) AS n_people, count(*) AS n_rows, CAST(sum(RegularGrossPaid) AS DECIMAL(20,2)) AS RegularGrossPaid
FROM v{i} WHERE people >= {k} GROUP BY place_, title_, FiscalYear""")
        left = f"l{i}"
        ctes.append(f"{left} AS (SELECT * EXCLUDE (place_, title_, people) FROM v{i} WHERE people < {k})")
    outs.append(f"SELECT 'suppressed', '*', '*', '*', count(DISTINCT EmployeeID), count(*), NULL FROM {left} HAVING count(*) > 0")
    return "WITH " + ",\n".join(ctes) + "\n" + "\nUNION ALL\n".join(outs)


def _dependencies_sql() -> str:
    """Per pair of columns: groups of the first with several values of the second."""
    parts = [f"""SELECT '{x}' AS determinant, '{y}' AS dependent, count(*) AS n_groups, count(*) FILTER (n > 1) AS n_broken
FROM (SELECT {x}, count(DISTINCT {y}) + count(DISTINCT CASE WHEN {y} IS NULL THEN 1 END) AS n FROM raw WHERE {x} IS NOT NULL GROUP BY {x})"""
             for x in R.DEPENDENCY_COLUMNS for y in R.DEPENDENCY_COLUMNS if x != y]
    return f"WITH {RAW_PAY} " + " UNION ALL ".join(parts)


def _count(name: str, body: str) -> str:
    return f"SELECT '{name}' AS check_name, (SELECT count(*) FROM ({body})) AS violations"


def _quality_sql() -> str:
    r = "r_"
    pk = lambda t, k: f"SELECT {k} FROM {r}{t} GROUP BY {k} HAVING count(*) > 1 OR {k} IS NULL"
    too_long = lambda t, cols: f"SELECT * FROM {r}{t} WHERE " + " OR ".join(
        f"length({c}) > 1000" for c in cols)
    fk = lambda col, t: f"SELECT * FROM {r}fact f WHERE f.{col} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {r}{t} d WHERE d.{col} = f.{col})"
    parts = [
        _count("pk_employee", pk("employee_dim", "EmployeeID")),
        _count("length_employee", too_long("employee_dim", ["LastName", "FirstName", "WorkLocationBorough", "LeaveStatusasofJune30"])),
        _count("pk_agency", pk("agency_dim", "AgencyID")),
        _count("length_agency", too_long("agency_dim", ["AgencyName"])),
        _count("pk_jobtitle", pk("title_dim", "TitleCode")),
        _count("length_jobtitle", too_long("title_dim", ["TitleDescription"])),
        _count("pk_time", pk("time_dim", "TimeID")),
        _count("pk_fact_table", pk("fact", "PayrollID")),
        _count("length_fact_table", too_long("fact", ["PayBasis"])),
        _count("fk_employee", fk("EmployeeID", "employee_dim")),
        _count("fk_agency", fk("AgencyID", "agency_dim")),
        _count("fk_jobtitle", fk("TitleCode", "title_dim")),
        _count("fk_time", fk("TimeID", "time_dim")),
        _count("renamed_agency", "SELECT AgencyID FROM rpay GROUP BY AgencyID HAVING count(DISTINCT AgencyName) > 1"),
        _count("renamed_jobtitle", "SELECT TitleCode FROM rpay GROUP BY TitleCode HAVING count(DISTINCT TitleDescription) > 1"),
        _count("null_start_date_text", "SELECT * FROM rpay WHERE AgencyStartDate_raw IS NULL"),
        _count("unparsed_start_date", "SELECT * FROM rpay WHERE AgencyStartDate_raw IS NOT NULL AND AgencyStartDate IS NULL"),
        _count("start_after_fiscal_year", "SELECT * FROM rpay WHERE year(AgencyStartDate) > FiscalYear"),
        _count("negative_pay", "SELECT * FROM rpay WHERE RegularGrossPaid < 0 OR TotalOTPaid < 0 OR TotalOtherPay < 0 OR BaseSalary < 0"),
        _count("emp_master_orphans", f"SELECT * FROM rpay p WHERE NOT EXISTS (SELECT 1 FROM emp_master em WHERE {EMP_ON})"),
        _count("agency_master_orphans", f"SELECT * FROM rpay p WHERE NOT EXISTS (SELECT 1 FROM agency_master am WHERE {AGENCY_ON})"),
        _count("title_master_orphans", f"SELECT * FROM rpay p WHERE NOT EXISTS (SELECT 1 FROM title_master tm WHERE {TITLE_ON})"),
    ]
    parts += [_count(f"null_{c}", f"SELECT * FROM rdedup WHERE {c} IS NULL") for c in PAYROLL_COLUMNS]
    return f"WITH {RAW_PAY},{star_ctes('rpay', r)},{MASTERS}\n" + "\nUNION ALL\n".join(parts)


def oracle_sql() -> dict[str, str]:
    null_audit = "\nUNION ALL\n".join(
        f"SELECT {i + 1} AS ordinal, '{c}' AS column_name, count(*) - count({c}) AS null_count FROM cn"
        for i, c in enumerate(CUST_NULL_COLS))
    profile = "\nUNION ALL\n".join(
        f"SELECT {i + 1} AS ordinal, '{c}' AS column_name, '{t}' AS data_type, "
        f"count({c}) AS non_null_count FROM customer"
        for i, (c, t) in enumerate(CUSTOMER_TYPES))
    q = {
        "scan_csv_infer": "SELECT * FROM nation",
        "scan_csv_schema": "SELECT * FROM supplier",
        "scan_csv_glob": "SELECT * FROM nation",
        "load_snapshots": f"""WITH {SNAP} SELECT * FROM snap
            QUALIFY row_number() OVER (PARTITION BY EmployeeID, FiscalYear ORDER BY PayrollNumber) = 1""",
        "incremental_ingest": f"""WITH {SNAP} SELECT * FROM snap
            QUALIFY row_number() OVER (PARTITION BY EmployeeID, FiscalYear ORDER BY PayrollNumber) = 1""",
        "stage_roundtrip": f"WITH {PAY} SELECT * FROM pay",
        "project_columns": "SELECT c_custkey, c_name, c_mktsegment FROM customer",
        "select_alias_qualified": f"""WITH {STAR}
            SELECT a.AgencyID, p.PayrollNumber, p.FiscalYear
            FROM pay p JOIN agency_dim a ON p.AgencyName = a.AgencyName""",
        "parse_mdy_date": """SELECT o_orderkey, start_text,
              CAST(try_strptime(start_text, '%m/%d/%Y') AS DATE) AS start_date
            FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN 'bad'
                    ELSE strftime(o_orderdate, '%-m/%-d/%Y') END AS start_text FROM orders)""",
        "fill_nulls_by_type": f"""WITH {CUST_NULLS}
            SELECT c_custkey, coalesce(c_name, 'Unknown') AS c_name,
              coalesce(c_nationkey, 0) AS c_nationkey,
              coalesce(c_acctbal, CAST(0 AS DOUBLE)) AS c_acctbal,
              coalesce(c_mktsegment, 'Unknown') AS c_mktsegment, c_since
            FROM cn""",
        "lowercase_columns": "SELECT * FROM nation",
        "null_audit": f"WITH {CUST_NULLS}\n{null_audit}",
        "filter_is_null": f"WITH {CUST_NULLS} SELECT * FROM cn WHERE c_name IS NULL",
        "surrogate_key_small": """SELECT row_number() OVER (ORDER BY FiscalYear) AS TimeID, FiscalYear
            FROM (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS FiscalYear FROM orders)""",
        "surrogate_key_bucketed": """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS o_year,
              row_number() OVER (ORDER BY year(o_orderdate), o_orderkey) AS row_key
            FROM orders""",
        "schema_profile": profile,
        "dedup_business_key": """SELECT *, CAST(year(o_orderdate) AS INTEGER) AS o_year,
              CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey END AS o_number FROM orders
            QUALIFY row_number() OVER (PARTITION BY o_custkey, year(o_orderdate)
              ORDER BY o_number NULLS LAST, o_orderkey) = 1""",
        "dedup_latest": f"""WITH {PAY} SELECT * FROM pay
            QUALIFY row_number() OVER (PARTITION BY EmployeeID ORDER BY FiscalYear DESC, PayrollNumber DESC) = 1""",
        "distinct_pairs": f"WITH {PAY} SELECT DISTINCT AgencyID, AgencyName FROM pay",
        "distinct_years": f"WITH {PAY} SELECT DISTINCT FiscalYear FROM pay",
        "row_count": "SELECT count(*) AS row_count FROM lineitem",
        "left_join_three_keys": f"""WITH {PAY},{MASTERS}
            SELECT p.*, em.EmployeeID IS NOT NULL AS in_emp_master
            FROM pay p LEFT JOIN emp_master em ON {EMP_ON}""",
        "left_join_two_keys": f"""WITH {PAY},{MASTERS}
            SELECT p.*, am.AgencyID IS NOT NULL AS in_agency_master
            FROM pay p LEFT JOIN agency_master am ON {AGENCY_ON}""",
        "left_join_title": f"""WITH {PAY},{MASTERS}
            SELECT p.*, tm.TitleCode IS NOT NULL AS in_title_master
            FROM pay p LEFT JOIN title_master tm ON {TITLE_ON}""",
        "enrich_with_masters": f"""WITH {PAY},{MASTERS}
            SELECT p.*, em.EmployeeID IS NOT NULL AS in_emp_master,
              am.AgencyID IS NOT NULL AS in_agency_master, tm.TitleCode IS NOT NULL AS in_title_master
            FROM pay p LEFT JOIN emp_master em ON {EMP_ON}
            LEFT JOIN agency_master am ON {AGENCY_ON}
            LEFT JOIN title_master tm ON {TITLE_ON}""",
        "inner_join_natural_keys": f"""WITH {STAR}
            SELECT e.EmployeeID, p.PayrollNumber, p.FiscalYear
            FROM pay p JOIN employee_dim e ON p.LastName = e.LastName AND p.FirstName = e.FirstName
              AND p.LeaveStatusasofJune30 = e.LeaveStatusasofJune30
              AND p.WorkLocationBorough = e.WorkLocationBorough""",
        "inner_join_agency": f"""WITH {STAR}
            SELECT a.AgencyID, p.AgencyName, p.PayrollNumber
            FROM pay p JOIN agency_dim a ON p.AgencyName = a.AgencyName""",
        "inner_join_title": f"""WITH {STAR}
            SELECT t.TitleCode, p.TitleDescription, p.PayrollNumber
            FROM pay p JOIN title_dim t ON p.TitleDescription = t.TitleDescription""",
        "inner_join_time": f"""WITH {STAR}
            SELECT t.TimeID, p.FiscalYear, p.PayrollNumber
            FROM pay p JOIN time_dim t ON p.FiscalYear = t.FiscalYear""",
        "union_positional": """SELECT c_custkey, c_name FROM customer
            UNION ALL SELECT s_suppkey, s_name FROM supplier""",
        "union_by_name_drift": """SELECT c_custkey AS id, c_name AS name,
              CAST(c_nationkey AS DOUBLE) AS nation_code, c_acctbal AS balance FROM customer
            UNION ALL
            SELECT s_suppkey, s_name, CAST(s_nationkey AS DOUBLE), s_acctbal FROM supplier""",
        "preview_limit": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 10",
        "dim_employee": f"WITH {STAR} SELECT * FROM employee_dim",
        "dim_agency": f"WITH {STAR} SELECT * FROM agency_dim",
        "dim_jobtitle": f"WITH {STAR} SELECT * FROM title_dim",
        "dim_time": f"WITH {STAR} SELECT * FROM time_dim",
        "fact_payroll": f"WITH {STAR} SELECT * FROM fact",
        "fact_payroll_natural": f"WITH {FACT_NATURAL} SELECT * FROM fact_nat",
        "star_schema_end_to_end": f"""WITH {RAW_PAY},{star_ctes('rpay', 'r_')},{MASTERS}
            SELECT a.AgencyName, t.FiscalYear, j.TitleDescription, e.WorkLocationBorough, count(*) AS n_rows,
              count(*) - count(f.AgencyStartDate) AS n_null_start,
              count(*) - count(em.EmployeeID) AS n_not_in_emp_master,
              count(*) - count(am.AgencyID) AS n_not_in_agency_master,
              count(*) - count(tm.TitleCode) AS n_not_in_title_master,
              CAST(sum(f.RegularHours) AS DECIMAL(38,2)) AS total_hours,
              CAST(sum(f.RegularGrossPaid) AS DECIMAL(38,2)) AS total_gross
            FROM r_fact f JOIN r_time_dim t USING (TimeID) JOIN r_agency_dim a USING (AgencyID)
              JOIN r_title_dim j USING (TitleCode) JOIN r_employee_dim e USING (EmployeeID)
              JOIN rpay p ON p.EmployeeID = f.EmployeeID AND p.FiscalYear = t.FiscalYear
              LEFT JOIN emp_master em ON {EMP_ON} LEFT JOIN agency_master am ON {AGENCY_ON}
              LEFT JOIN title_master tm ON {TITLE_ON}
            GROUP BY a.AgencyName, t.FiscalYear, j.TitleDescription, e.WorkLocationBorough""",
        "dim_employee_history": f"WITH {HISTORY} SELECT * FROM history",
        "fact_employee_version": f"""WITH {HISTORY}
            SELECT p.EmployeeID, p.FiscalYear, p.PayrollNumber, p.RegularGrossPaid, h.version, h.valid_from,
              h.WorkLocationBorough, h.LeaveStatusasofJune30
            FROM pay p LEFT JOIN history h ON p.EmployeeID = h.EmployeeID AND p.FiscalYear >= h.valid_from
              AND (h.valid_to IS NULL OR p.FiscalYear <= h.valid_to)""",
        "employee_history_changes": f"""WITH {HISTORY},
            l AS (SELECT *, lag(LastName) OVER w AS ln, lag(FirstName) OVER w AS fn, lag(WorkLocationBorough) OVER w AS wb,
                lag(LeaveStatusasofJune30) OVER w AS ls
              FROM history WINDOW w AS (PARTITION BY EmployeeID ORDER BY version)),
            c AS (SELECT count(*) FILTER (version > 1 AND ln IS DISTINCT FROM LastName) AS a,
                count(*) FILTER (version > 1 AND fn IS DISTINCT FROM FirstName) AS b,
                count(*) FILTER (version > 1 AND wb IS DISTINCT FROM WorkLocationBorough) AS c,
                count(*) FILTER (version > 1 AND ls IS DISTINCT FROM LeaveStatusasofJune30) AS d FROM l)
            SELECT 'LastName' AS attribute, a AS changes FROM c UNION ALL SELECT 'FirstName', b FROM c
            UNION ALL SELECT 'WorkLocationBorough', c FROM c UNION ALL SELECT 'LeaveStatusasofJune30', d FROM c""",
        "surrogate_key_stable": """WITH e AS (
              SELECT c_custkey AS EmployeeID, min(year(o_orderdate)) <= 1994 AS early
              FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_custkey)
            SELECT EmployeeID, CAST(row_number() OVER (ORDER BY early DESC, EmployeeID) AS BIGINT) AS EmployeeKey FROM e""",
        "crosswalk_candidates": CANDIDATES,
        "crosswalk_employees": f"WITH {_assignment_ctes()} SELECT * FROM walk",
        "crosswalk_orphans": f"""WITH {_assignment_ctes()},
            pay AS (SELECT c_custkey AS id FROM orders JOIN customer ON o_custkey = c_custkey),
            master AS (SELECT c_custkey + 1000000 AS id FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 25 <> 7)
            SELECT 'code' AS matched_by, count(*) AS n_rows, count(*) FILTER (id NOT IN (SELECT id FROM master)) AS n_orphans FROM pay
            UNION ALL SELECT 'crosswalk', count(*), count(*) FILTER (id NOT IN (SELECT left_id FROM walk)) FROM pay""",
        "load_with_quarantine": """
            SELECT CASE WHEN o_orderkey % 1000 = 1 THEN 'FiscalYear: "last year" does not fit int'
                WHEN o_orderkey % 1000 = 2 THEN 'BaseSalary: "1e99" does not fit decimal(10,2)' ELSE 'loaded' END AS reason,
              count(*) AS n_rows
            FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""",
        "sink_parquet": "SELECT * FROM nation",
        "sink_csv": "SELECT * FROM supplier",
        "sink_jdbc": "SELECT * FROM nation",
        "warehouse_tables": f"""WITH {STAR}
            SELECT 'employee' AS table_name, count(*) AS n_rows FROM employee_dim
            UNION ALL SELECT 'agency', count(*) FROM agency_dim
            UNION ALL SELECT 'jobtitle', count(*) FROM title_dim
            UNION ALL SELECT 'time', count(*) FROM time_dim
            UNION ALL SELECT 'fact_table', count(*) FROM fact""",
        "cast_to_warehouse_schema": f"WITH {STAR} {FACT_WAREHOUSE}",
        "check_primary_key": """SELECT o_orderkey, count(*) AS n_rows
            FROM (SELECT o_orderkey FROM orders
                  UNION ALL SELECT o_orderkey FROM orders WHERE o_totalprice > 450000)
            GROUP BY o_orderkey HAVING count(*) > 1 OR o_orderkey IS NULL""",
        "check_foreign_key": """SELECT o_orderkey, o_custkey
            FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN o_custkey END AS o_custkey FROM orders) o
            WHERE o_custkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_acctbal >= 0 AND c.c_custkey = o.o_custkey)""",
        "check_max_length": """SELECT doc_id, CAST(length(text) AS INTEGER) AS text_length
            FROM documents WHERE length(text) > 1000""",
        "full_refresh_twice": "SELECT * FROM nation",
        "staged_job": f"WITH {STAR} {FACT_WAREHOUSE}",
        "quality_report": _quality_sql(),
        "allocation_by_agency_year": f"WITH {ALLOCATION} SELECT * FROM alloc",
        "allocation_year_over_year": f"""WITH {ALLOCATION}
            SELECT AgencyID, AgencyName, FiscalYear, total_paid,
              lag(total_paid) OVER w AS prev_total_paid,
              CAST(total_paid - lag(total_paid) OVER w AS DECIMAL(38,2)) AS change_paid,
              lag(FiscalYear) OVER w AS prev_fiscal_year
            FROM alloc WINDOW w AS (PARTITION BY AgencyID ORDER BY FiscalYear)""",
        "public_view": f"""WITH {STAR}
            SELECT a.AgencyName, t.TitleDescription, d.FiscalYear, f.PayBasis,
              f.BaseSalary, f.RegularHours, f.RegularGrossPaid, f.OTHours, f.TotalOTPaid, f.TotalOtherPay
            FROM fact f JOIN agency_dim a USING (AgencyID) JOIN title_dim t USING (TitleCode)
              JOIN time_dim d USING (TimeID)""",
        "functional_dependencies": _dependencies_sql(),
        "public_release": _release_sql(R.PUBLIC_K),
        "clustered_lookup": """SELECT * FROM orders WHERE o_custkey BETWEEN 100 AND 400
            AND o_orderdate BETWEEN TIMESTAMP '1995-01-01' AND TIMESTAMP '1996-06-30'""",
        "partition_pruned_scan": """SELECT *, CAST(year(o_orderdate) AS INTEGER) AS o_year
            FROM orders WHERE year(o_orderdate) = 1996""",
    }
    return {k: v for k, v in q.items() if k in R.QUERIES} | LLM_ORACLES
