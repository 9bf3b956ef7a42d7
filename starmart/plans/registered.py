"""The queries the driver runs: each operator of the survey put on the test
tables (see ``starmart.testmap``). Every function takes (spark, sf_dir) and
returns a DataFrame over the whole tables. File-sink and file-source keys
write to a fresh folder under the session's checkpoint root and return the
re-read frame.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart import schemas as S
from starmart import testmap as tm
from starmart.functions import clean
from starmart.operators import dedup, history, joins, keys, linkage, quality
from starmart.plans import consistency, jobs, marts, privacy
from starmart.plans.star import (build_agency_dim, build_employee_dim, build_star, build_time_dim,
                                 build_title_dim, clean_payroll, dedup_snapshots, renamed)
from starmart.session import materialize as materialize_table
from starmart.session import scratch_path, scratch_scope
from starmart.sinks import clustered, files, jdbc, versions, warehouse
from starmart.sources import csv as src
from starmart.sources import quarantine


# ---------------------------------------------------------------- payroll base

def payroll(spark: SparkSession, sf_dir: str, columns: list[str] | None = None,
            materialize: bool = False) -> DataFrame:
    """Merged snapshot -> dedup on (EmployeeID, FiscalYear) -> clean.

    With ``columns`` only those are read, deduplicated and returned: the test
    mapping's PayrollNumber is the key of ``orders``, so it orders a key's rows
    totally and no other column is needed to break ties. ``materialize`` writes
    the result once (parquet under the checkpoint root) for callers that read it
    several times.
    """
    if columns is None:
        pay = clean_payroll(dedup_snapshots(tm.snapshot(spark, sf_dir)))
    else:
        needed = [*columns, "EmployeeID", "FiscalYear", "PayrollNumber"]
        pay = dedup_snapshots(tm.snapshot(spark, sf_dir, needed), total_order=True)
        pay = clean.fill_nulls_by_type(pay.select(*columns))
    return materialize_table(pay, "payroll") if materialize else pay


def star(spark: SparkSession, sf_dir: str, natural: bool = False):
    return build_star(payroll(spark, sf_dir, materialize=True), natural=natural)


def dim_input(spark: SparkSession, sf_dir: str, columns: list[str]) -> DataFrame:
    """What a dimension is built from: its columns and the order of years. One
    consumer reads it once, so nothing is written."""
    order = [c for c in ("FiscalYear", "PayrollNumber") if c not in columns]
    return payroll(spark, sf_dir, [*columns, *order])


def write_snapshot_files(spark: SparkSession, snap: DataFrame, root: str, odd: F.Column | None = None) -> str:
    """Snapshot rows as CSV files with a header per file; odd fiscal years (or
    rows that are ``odd``) use the drifted header (AgencyCode for AgencyID), as
    the yearly files do."""
    odd = F.col("FiscalYear") % 2 == 1 if odd is None else odd
    snap = materialize_table(snap, "snapshot")  # two writes read it
    files.write_csv(snap.where(~odd), f"{root}/even")
    files.write_csv(snap.where(odd).withColumnRenamed("AgencyID", "AgencyCode"), f"{root}/odd")
    return root


# ---------------------------------------------------------------- A: sources

def scan_csv_infer(spark, sf_dir):
    path = files.write_csv(tm.table(spark, sf_dir, "nation"), scratch_path(spark, "nation_csv"))
    return src.read_csv(spark, path, infer=True)


def scan_csv_schema(spark, sf_dir):
    sup = tm.table(spark, sf_dir, "supplier")
    path = files.write_csv(sup, scratch_path(spark, "supplier_csv"))
    return src.read_csv(spark, path, schema=sup.schema)


def scan_csv_glob(spark, sf_dir):
    root = scratch_path(spark, "glob")
    nation = tm.table(spark, sf_dir, "nation")
    files.write_csv(nation.repartition(5, "n_regionkey"), f"{root}/nation")
    files.write_csv(tm.table(spark, sf_dir, "region"), f"{root}/decoy", compression="gzip")
    return src.read_csv_folder(spark, root, "*.csv", nation.schema, recursive=True)


def load_snapshots(spark, sf_dir):
    root = write_snapshot_files(spark, tm.snapshot(spark, sf_dir), scratch_path(spark, "snapshots"))
    return dedup_snapshots(src.load_folder(spark, root, "*.csv", recursive=True, provenance=True))


def incremental_ingest(spark, sf_dir):
    """Snapshot files arrive in two drops; each availableNow run of the file
    stream ingests only the new ones; the bronze table is deduplicated."""
    from starmart.streaming.snapshots import ingest, read_bronze
    root = scratch_path(spark, "stream")
    snap = materialize_table(tm.snapshot(spark, sf_dir), "snapshot")
    files.write_csv(snap.where(F.col("FiscalYear") % 2 == 0), f"{root}/in/even")
    ingest(spark, f"{root}/in", f"{root}/bronze", f"{root}/ckpt", "*.csv", recursive=True, buckets=2)
    files.write_csv(snap.where(F.col("FiscalYear") % 2 == 1)
                    .withColumnRenamed("AgencyID", "AgencyCode"), f"{root}/in/odd")
    ingest(spark, f"{root}/in", f"{root}/bronze", f"{root}/ckpt", "*.csv", recursive=True, buckets=2)
    return read_bronze(spark, f"{root}/bronze")


def stage_roundtrip(spark, sf_dir):
    pay = payroll(spark, sf_dir)
    path = src.write_stage(pay, scratch_path(spark, "stage"), partition_by=["FiscalYear"],
                           rebalance=True)
    return src.read_stage(spark, path, pay.schema).select(*pay.columns)


# ---------------------------------------------------------------- B: projections

def project_columns(spark, sf_dir):
    return tm.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")


def select_alias_qualified(spark, sf_dir):
    """Both sides carry AgencyID; the dimension's copy is picked by alias. The
    lookup key is checked unique first, so a row matches at most one row."""
    pay = payroll(spark, sf_dir, [*S.AGENCY_COLS, "PayrollNumber", "FiscalYear"], materialize=True)
    agency = build_agency_dim(pay)
    joins.assert_unique(agency, ["AgencyName"], "agency dimension")
    j = pay.join(joins.checked_broadcast(agency).alias("a"), ["AgencyName"], "inner")
    return j.select(F.col("a.AgencyID").alias("AgencyID"), "PayrollNumber", "FiscalYear")


def parse_mdy_date(spark, sf_dir):
    o = tm.table(spark, sf_dir, "orders")
    text = F.when(F.col("o_orderkey") % 11 == 0, F.lit("bad")) \
        .otherwise(F.date_format("o_orderdate", "M/d/yyyy"))
    return o.select("o_orderkey", text.alias("start_text")) \
        .withColumn("start_date", clean.parse_mdy("start_text"))


def customer_with_nulls(spark, sf_dir) -> DataFrame:
    """customer with nulls by fixed rules in a string, a double and an int
    column, plus a date column that is null on every other row."""
    c = tm.table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.select(
        "c_custkey",
        F.when(k % 7 == 0, F.lit(None).cast("string")).otherwise(F.col("c_name")).alias("c_name"),
        F.when(k % 3 == 0, F.lit(None).cast("int")).otherwise(F.col("c_nationkey")).alias("c_nationkey"),
        F.when(k % 5 == 0, F.lit(None).cast("double")).otherwise(F.col("c_acctbal")).alias("c_acctbal"),
        "c_mktsegment",
        F.when(k % 2 == 0, F.lit(None).cast("date")).otherwise(F.to_date(F.lit("2020-01-01")))
        .alias("c_since"),
    )


def fill_nulls_by_type(spark, sf_dir):
    return clean.fill_nulls_by_type(customer_with_nulls(spark, sf_dir))


def lowercase_columns(spark, sf_dir):
    n = tm.table(spark, sf_dir, "nation")
    return clean.lowercase_columns(n.toDF(*[c.upper() for c in n.columns]))


def null_audit(spark, sf_dir):
    return clean.null_audit(customer_with_nulls(spark, sf_dir))


def filter_is_null(spark, sf_dir):
    return clean.filter_is_null(customer_with_nulls(spark, sf_dir), "c_name")


def surrogate_key_small(spark, sf_dir):
    o = tm.table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("FiscalYear"))
    return build_time_dim(o)


def surrogate_key_bucketed(spark, sf_dir):
    o = tm.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.year("o_orderdate").alias("o_year"))
    return keys.dense_key(o, ["o_year", "o_orderkey"], "row_key")


def schema_profile(spark, sf_dir):
    return clean.schema_profile(tm.table(spark, sf_dir, "customer"))


# ---------------------------------------------------------------- C: dedup, counts

def dedup_business_key(spark, sf_dir):
    """Order numbers are null by rule on some rows: such a row loses against
    any other of its customer and year."""
    o = tm.table(spark, sf_dir, "orders").withColumns({
        "o_year": F.year("o_orderdate"),
        "o_number": F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderkey"))})
    return dedup.dedup_by(o, ["o_custkey", "o_year"], ["o_number", "o_orderkey"], keep="first")


def dedup_latest(spark, sf_dir):
    pay = payroll(spark, sf_dir)
    return dedup.dedup_by(pay, ["EmployeeID"], ["FiscalYear", "PayrollNumber"], keep="last")


def distinct_pairs(spark, sf_dir):
    return dedup.distinct_of(payroll(spark, sf_dir, S.AGENCY_COLS), S.AGENCY_COLS)


def distinct_years(spark, sf_dir):
    return dedup.distinct_of(payroll(spark, sf_dir, ["FiscalYear"]), ["FiscalYear"])


def row_count(spark, sf_dir):
    return dedup.row_count(tm.table(spark, sf_dir, "lineitem"))


# ---------------------------------------------------------------- D: joins

def left_join_three_keys(spark, sf_dir):
    return joins.left_join_master(payroll(spark, sf_dir), tm.emp_master(spark, sf_dir),
                                  ["EmployeeID", "LastName", "FirstName"], "in_emp_master")


def left_join_two_keys(spark, sf_dir):
    return joins.left_join_master(payroll(spark, sf_dir), tm.agency_master(spark, sf_dir),
                                  ["AgencyID", "AgencyName"], "in_agency_master")


def left_join_title(spark, sf_dir):
    return joins.left_join_master(payroll(spark, sf_dir), tm.title_master(spark, sf_dir),
                                  ["TitleCode", "TitleDescription"], "in_title_master")


def enrich_with_masters(spark, sf_dir):
    return joins.enrich_with_masters(payroll(spark, sf_dir), tm.emp_master(spark, sf_dir),
                                     tm.agency_master(spark, sf_dir), tm.title_master(spark, sf_dir))


def inner_join_natural_keys(spark, sf_dir):
    pay = payroll(spark, sf_dir, [*S.EMPLOYEE_COLS, "PayrollNumber", "FiscalYear"], materialize=True)
    emp = build_employee_dim(pay)
    joins.assert_unique(emp, S.EMPLOYEE_NATURAL, "employee dimension")
    j = pay.join(emp.alias("e"), S.EMPLOYEE_NATURAL, "inner")
    return j.select(F.col("e.EmployeeID").alias("EmployeeID"), "PayrollNumber", "FiscalYear")


def inner_join_agency(spark, sf_dir):
    pay = payroll(spark, sf_dir, [*S.AGENCY_COLS, "PayrollNumber", "FiscalYear"], materialize=True)
    agency = build_agency_dim(pay)
    joins.assert_unique(agency, ["AgencyName"], "agency dimension")
    j = joins.join_dimension(pay, agency, ["AgencyName"], "a")
    return j.select(F.col("a.AgencyID").alias("AgencyID"), "AgencyName", "PayrollNumber")


def inner_join_title(spark, sf_dir):
    pay = payroll(spark, sf_dir, [*S.TITLE_COLS, "PayrollNumber", "FiscalYear"], materialize=True)
    title = build_title_dim(pay)
    joins.assert_unique(title, ["TitleDescription"], "job title dimension")
    j = joins.join_dimension(pay, title, ["TitleDescription"], "t")
    return j.select(F.col("t.TitleCode").alias("TitleCode"), "TitleDescription", "PayrollNumber")


def inner_join_time(spark, sf_dir):
    pay = payroll(spark, sf_dir, ["FiscalYear", "PayrollNumber"], materialize=True)
    j = joins.join_dimension(pay, build_time_dim(pay), ["FiscalYear"], "d")
    return j.select("TimeID", "FiscalYear", "PayrollNumber")


# ---------------------------------------------------------------- E: set ops, limits

def union_positional(spark, sf_dir):
    c = tm.table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    s = tm.table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    return c.union(s)


# Fixed values of the fixture: how supplier columns are named on the customer side.
SUPPLIER_RENAMES = {"s_suppkey": "id", "s_name": "name", "s_nationkey": "nation_code",
                    "s_acctbal": "balance"}


def union_by_name_drift(spark, sf_dir):
    c = tm.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nation_code"), F.col("c_acctbal").alias("balance"))
    s = tm.table(spark, sf_dir, "supplier").withColumnsRenamed(SUPPLIER_RENAMES) \
        .select("balance", F.col("nation_code").cast("double"), "name", "id")
    return c.unionByName(s)


def preview_limit(spark, sf_dir):
    return clean.preview(tm.table(spark, sf_dir, "orders"), 10, ["o_orderkey"])


# ---------------------------------------------------------------- F: star

def dim_employee(spark, sf_dir):
    return build_employee_dim(dim_input(spark, sf_dir, S.EMPLOYEE_COLS))


def dim_agency(spark, sf_dir):
    return build_agency_dim(dim_input(spark, sf_dir, S.AGENCY_COLS))


def dim_jobtitle(spark, sf_dir):
    return build_title_dim(dim_input(spark, sf_dir, S.TITLE_COLS))


def dim_time(spark, sf_dir):
    return build_time_dim(payroll(spark, sf_dir, ["FiscalYear"]))


def fact_payroll(spark, sf_dir):
    return star(spark, sf_dir).fact


def fact_payroll_natural(spark, sf_dir):
    return star(spark, sf_dir, natural=True).fact


def write_masters(spark: SparkSession, sf_dir: str, root: str) -> dict[str, str]:
    """The three masters as CSV, the agency master with its columns turned round."""
    agency = tm.agency_master(spark, sf_dir)
    return {"emp": files.write_csv(tm.emp_master(spark, sf_dir), f"{root}/emp"),
            "agency": files.write_csv(agency.select(*reversed(agency.columns)), f"{root}/agency"),
            "title": files.write_csv(tm.title_master(spark, sf_dir), f"{root}/title")}


def dim_employee_history(spark, sf_dir):
    """Versions of each employee: intervals of years with the same attributes."""
    return employee_history(dim_input(spark, sf_dir, [*S.EMPLOYEE_COLS, "FiscalYear"]))


def employee_history(pay: DataFrame) -> DataFrame:
    attributes = [c for c in S.EMPLOYEE_COLS if c != "EmployeeID"]
    return history.validity_intervals(pay, ["EmployeeID"], "FiscalYear", attributes)


def fact_employee_version(spark, sf_dir):
    """Every payroll row with the employee's version valid in its year."""
    columns = [*S.EMPLOYEE_COLS, "FiscalYear", "PayrollNumber", "RegularGrossPaid"]
    pay = payroll(spark, sf_dir, columns, materialize=True)
    facts = pay.select("EmployeeID", "FiscalYear", "PayrollNumber", "RegularGrossPaid")
    return history.as_of_join(facts, employee_history(pay), ["EmployeeID"], "FiscalYear",
                              ["version", "valid_from", "WorkLocationBorough", "LeaveStatusasofJune30"])


def employee_history_changes(spark, sf_dir):
    """How often each attribute of an employee changes."""
    pay = payroll(spark, sf_dir, [*S.EMPLOYEE_COLS, "FiscalYear"])
    attributes = [c for c in S.EMPLOYEE_COLS if c != "EmployeeID"]
    return history.history_changes(spark, employee_history(pay), ["EmployeeID"], attributes)


def surrogate_key_stable(spark, sf_dir):
    """Employee keys over two loads: the years to 1994, then all years. Employees
    of the first load keep their keys, new ones get numbers after them."""
    path = scratch_path(spark, "employee_keys")
    employees = materialize_table(tm.snapshot(spark, sf_dir, ["EmployeeID", "FiscalYear"]), "employee-years")
    keys.extend_key_map(employees.where("FiscalYear <= 1994"), ["EmployeeID"], path, 0, "EmployeeKey")
    return keys.extend_key_map(employees, ["EmployeeID"], path, 1, "EmployeeKey")


# an abbreviation in the master's names
SAME_WORDS = {"cust": "customer"}


def crosswalk_candidates(spark, sf_dir):
    """Scored pairs of the payroll's employees and a master with other codes."""
    return linkage.candidates(tm.employee_names(spark, sf_dir), tm.recoded_names(spark, sf_dir), 0.5, SAME_WORDS)


def crosswalk_employees(spark, sf_dir):
    """The one-to-one crosswalk from those pairs."""
    return linkage.one_to_one(crosswalk_candidates(spark, sf_dir))


def crosswalk_orphans(spark, sf_dir):
    """Payroll rows without a master entry, by code and by crosswalk."""
    rows = tm.snapshot(spark, sf_dir, ["EmployeeID", "FiscalYear"])
    return linkage.orphan_report(rows, "EmployeeID", tm.recoded_names(spark, sf_dir), crosswalk_employees(spark, sf_dir))


def load_with_quarantine(spark, sf_dir):
    """Snapshot files of which some lines are broken: how many rows load, and the
    quarantined lines by reason."""
    root = scratch_path(spark, "broken")
    snap = tm.snapshot(spark, sf_dir)
    as_text = snap.select(*[F.col(c).cast("string").alias(c) for c in snap.columns])
    number = F.col("PayrollNumber").cast("long")
    broken = as_text.withColumns({
        "FiscalYear": F.when(number % 1000 == 1, "last year").otherwise(F.col("FiscalYear")),
        "BaseSalary": F.when(number % 1000 == 2, "1e99").otherwise(F.col("BaseSalary"))})
    write_snapshot_files(spark, broken, root, odd=F.col("PayrollNumber").cast("long") % 2 == 1)
    load = quarantine.load_with_quarantine(spark, root, "*.csv", recursive=True)
    reasons = load.quarantine.groupBy("reason").agg(F.count("*").alias("n_rows"))
    return reasons.unionByName(load.rows.agg(F.count("*").alias("n_rows")).select(F.lit("loaded").alias("reason"), "n_rows"))


def star_schema_end_to_end(spark, sf_dir):
    """Raw text with defects -> CSV files with drifted headers -> discover ->
    load -> dedup -> parse/fill -> enrich with the masters -> star -> fact joined
    to all four dimensions and summed per agency, year, title and borough."""
    raw = tm.with_defects(tm.snapshot(spark, sf_dir))
    root = write_snapshot_files(spark, raw, scratch_path(spark, "raw_snapshots"))
    merged = src.load_folder(spark, root, "*.csv", recursive=True, provenance=True)
    paths = write_masters(spark, sf_dir, scratch_path(spark, "masters"))
    masters = [src.load_master(spark, paths[n], schema) for n, schema in
               (("emp", S.EMP_MASTER_SCHEMA), ("agency", S.AGENCY_MASTER_SCHEMA), ("title", S.TITLE_MASTER_SCHEMA))]
    pay = materialize_table(joins.enrich_with_masters(clean_payroll(dedup_snapshots(merged)), *masters), "payroll")
    s = build_star(pay)
    flags = ["in_emp_master", "in_agency_master", "in_title_master"]
    # the masters' flags stay with the payroll row, of which there is one per
    # employee and year, as in the fact
    facts = s.fact_rows().join(pay.select("EmployeeID", "FiscalYear", *flags), ["EmployeeID", "FiscalYear"])
    f = (facts.drop("FiscalYear")
         .join(s.employee.select("EmployeeID", "WorkLocationBorough"), "EmployeeID")
         .join(marts.lookup(s.agency, "AgencyID"), "AgencyID")
         .join(marts.lookup(s.jobtitle, "TitleCode"), "TitleCode")
         .join(marts.lookup(s.time, "TimeID"), "TimeID"))
    return f.groupBy("AgencyName", "FiscalYear", "TitleDescription", "WorkLocationBorough").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("AgencyStartDate").isNull()).alias("n_null_start"),
        *[F.count_if(~F.col(c)).alias(f"n_not_{c}") for c in flags],
        F.sum("RegularHours").cast(marts.TOTAL).alias("total_hours"),
        F.sum("RegularGrossPaid").cast(marts.TOTAL).alias("total_gross"),
    )


# ---------------------------------------------------------------- G: sinks, checks

def sink_parquet(spark, sf_dir):
    path = files.write_parquet(tm.table(spark, sf_dir, "nation"), scratch_path(spark, "nation_pq"))
    return files.read_parquet(spark, path)


def sink_csv(spark, sf_dir):
    sup = tm.table(spark, sf_dir, "supplier")
    path = files.write_csv(sup, scratch_path(spark, "supplier_out"))
    return files.read_csv_back(spark, path, sup.schema)


def sink_jdbc(spark, sf_dir):
    """Write, then read back in parallel: strides of the key's range, the
    bounds from a one-row min/max of what was written."""
    url, props = jdbc.derby_memory_url()
    nation = tm.table(spark, sf_dir, "nation")
    jdbc.write_jdbc(nation, url, "NATION", props, mode="overwrite")
    b = nation.agg(F.min("n_nationkey").alias("lo"), F.max("n_nationkey").alias("hi")).first()
    return jdbc.read_jdbc(spark, url, "NATION", props, column="n_nationkey", lower=b.lo,
                          upper=b.hi + 1, num_partitions=4)


def _db() -> str:
    return f"starmart_{uuid.uuid4().hex[:8]}"


def warehouse_tables(spark, sf_dir):
    """Row counts of the published tables. The five counts are taken before
    the database and its folders are dropped, so runs leave nothing behind."""
    db, root = _db(), scratch_path(spark, "wh")
    with scratch_scope(spark):
        s = star(spark, sf_dir)
        versions.publish_version(spark, warehouse.to_warehouse(s.tables()), root, db)
    counts = warehouse.table_counts(spark, db, S.LOAD_ORDER)
    rows, schema = counts.collect(), counts.schema
    warehouse.drop_warehouse(spark, db, root)
    return spark.createDataFrame(rows, schema)


def cast_to_warehouse_schema(spark, sf_dir):
    return warehouse.cast_to_schema(clean.lowercase_columns(star(spark, sf_dir).fact),
                                    S.WAREHOUSE["fact_table"])


def check_primary_key(spark, sf_dir):
    o = tm.table(spark, sf_dir, "orders")
    doubled = o.unionByName(o.where(F.col("o_totalprice") > 450000))
    return quality.check_primary_key(doubled, "o_orderkey")


def check_foreign_key(spark, sf_dir):
    """Some orders have no customer by rule: a null key is no orphan."""
    o = tm.table(spark, sf_dir, "orders").withColumn(
        "o_custkey", F.when(F.col("o_orderkey") % 5 != 0, F.col("o_custkey")))
    orphans = quality.check_foreign_key(o, tm.emp_master(spark, sf_dir), "o_custkey", "EmployeeID")
    return orphans.select("o_orderkey", "o_custkey")


def check_max_length(spark, sf_dir):
    d = tm.table(spark, sf_dir, "documents")
    return quality.check_max_length(d, ["text"]).select(
        "doc_id", F.length("text").alias("text_length"))


def full_refresh_twice(spark, sf_dir):
    db, root = _db(), scratch_path(spark, "refresh")
    nation = tm.table(spark, sf_dir, "nation")
    versions.publish_version(spark, {"nation": nation}, root, db, check=False)
    versions.publish_version(spark, {"nation": nation}, root, db, check=False, keep_for=0)
    out = materialize_table(spark.table(f"`{db}`.`nation`"), "refreshed")
    warehouse.drop_warehouse(spark, db, root)
    return out


def staged_job(spark, sf_dir):
    """Snapshots and masters as files -> extract -> transform -> load."""
    db, root = _db(), scratch_path(spark, "staged")
    write_snapshot_files(spark, tm.snapshot(spark, sf_dir), f"{root}/in")
    paths = write_masters(spark, sf_dir, f"{root}/masters")
    cfg = jobs.JobConfig(snapshot_dir=f"{root}/in", stage_dir=f"{root}/stage", pattern="*.csv",
                         recursive=True, database=db, emp_master=paths["emp"],
                         agency_master=paths["agency"], title_master=paths["title"])
    tables = jobs.run_all(spark, cfg)
    out = materialize_table(tables["fact_table"], "published")
    warehouse.drop_warehouse(spark, db, root)
    return out


def quality_inputs(spark, sf_dir):
    """The checks over the defect-carrying snapshot: warehouse constraints on
    the star (frames of violating rows) and row conditions over the payroll
    and its master matches (counted in one scan per frame)."""
    # written once: the null audit reads it, the cleaned payroll is a projection of it
    raw = materialize_table(dedup_snapshots(tm.with_defects(tm.snapshot(spark, sf_dir))), "merged")
    pay = clean_payroll(raw, keep_raw_date=True)
    # dimensions and fact are written once; every check reads what it needs of them
    s = build_star(pay.drop("AgencyStartDate_raw"), materialize=lambda name, d: materialize_table(d, name))
    tables = s.tables()
    tables["fact_table"] = materialize_table(tables["fact_table"], "fact")
    checks, table_rows = warehouse.warehouse_conditions(warehouse.to_warehouse(tables))
    checks |= {"renamed_agency": renamed(pay, "AgencyID", "AgencyName"),
               "renamed_jobtitle": renamed(pay, "TitleCode", "TitleDescription")}
    row_conditions = {
        "null_start_date_text": F.col("AgencyStartDate_raw").isNull(),
        "unparsed_start_date": F.col("AgencyStartDate_raw").isNotNull() & F.col("AgencyStartDate").isNull(),
        "start_after_fiscal_year": F.year("AgencyStartDate") > F.col("FiscalYear"),
        "negative_pay": (F.col("RegularGrossPaid") < 0) | (F.col("TotalOTPaid") < 0)
                        | (F.col("TotalOtherPay") < 0) | (F.col("BaseSalary") < 0),
        "emp_master_orphans": ~F.col("in_emp_master"),
        "agency_master_orphans": ~F.col("in_agency_master"),
        "title_master_orphans": ~F.col("in_title_master"),
    }
    enriched = joins.enrich_with_masters(pay, tm.emp_master(spark, sf_dir),
                                         tm.agency_master(spark, sf_dir),
                                         tm.title_master(spark, sf_dir))
    nulls = {f"null_{c}": F.col(c).isNull() for c in S.PAYROLL_COLUMNS}
    return checks, [*table_rows, (raw, nulls), (enriched, row_conditions)]


def quality_report(spark, sf_dir):
    checks, row_conditions = quality_inputs(spark, sf_dir)
    return quality.quality_report(checks, row_conditions)


# ---------------------------------------------------------------- I: marts

def allocation_by_agency_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact's rows here are the payroll's, with the columns the mart reads."""
    facts = payroll(spark, sf_dir, [*S.AGENCY_COLS, "EmployeeID", "FiscalYear", "PayrollNumber", *S.PAID],
                    materialize=True)
    return marts.allocation_by_agency_year(facts, build_agency_dim(facts), build_time_dim(facts))


def allocation_year_over_year(spark, sf_dir):
    return marts.allocation_year_over_year(allocation_by_agency_year(spark, sf_dir))


def public_view(spark, sf_dir):
    pay = payroll(spark, sf_dir, [*S.AGENCY_COLS, *S.TITLE_COLS, "FiscalYear", "PayrollNumber", "PayBasis",
                                  "BaseSalary", *S.MEASURES], materialize=True)
    time = build_time_dim(pay)
    facts = joins.join_dimension(pay, time, ["FiscalYear"], "d").select(
        "AgencyID", "TitleCode", "TimeID", "PayBasis", "BaseSalary", *S.MEASURES)
    return marts.public_view(spark, facts, build_agency_dim(pay), build_title_dim(pay), time)


def clustered_lookup(spark, sf_dir):
    """Orders of some customers and months, read from the files of a Z-ordered
    table that its index names."""
    table = clustered.write_clustered(tm.table(spark, sf_dir, "orders"), scratch_path(spark, "clustered"),
                                      ["o_custkey", "o_orderdate"], 64)
    return clustered.lookup(spark, table, o_custkey=(100, 400), o_orderdate=("1995-01-01", "1996-06-30"))


# The columns between which dependencies are looked for
DEPENDENCY_COLUMNS = ["EmployeeID", "LastName", "AgencyID", "AgencyName", "WorkLocationBorough", "TitleCode", "TitleDescription"]


def functional_dependencies(spark, sf_dir):
    """For each pair of columns of the raw snapshot: does the first fix the second?"""
    raw = tm.with_defects(tm.snapshot(spark, sf_dir))
    return consistency.dependencies(raw, DEPENDENCY_COLUMNS)


def snapshot_drift(spark, sf_dir):
    """Every year's columns against the year before, from mergeable sketches."""
    raw = tm.with_defects(tm.snapshot(spark, sf_dir))
    sketches = materialize_table(consistency.year_sketches(raw, "FiscalYear", S.MEASURES + ["BaseSalary"],
                                                           ["EmployeeID", "AgencyID", "TitleDescription"]), "year-sketches")
    return consistency.drift(sketches)


PUBLIC_K = 5


def public_release(spark, sf_dir):
    """Pay in groups of at least ``PUBLIC_K`` employees."""
    columns = ["EmployeeID", "AgencyName", "WorkLocationBorough", "TitleDescription", "FiscalYear", "RegularGrossPaid"]
    pay = payroll(spark, sf_dir, columns, materialize=True)
    return privacy.generalize(pay, "EmployeeID", privacy.payroll_levels(), PUBLIC_K, ["RegularGrossPaid"])


PRUNE_YEAR = 1996


def partition_pruned_scan(spark, sf_dir):
    o = tm.table(spark, sf_dir, "orders").withColumn("o_year", F.year("o_orderdate"))
    path = files.write_parquet(o, scratch_path(spark, "orders_by_year"), partition_by=["o_year"],
                               rebalance=True)
    return marts.partition_pruned_scan(spark, path, "o_year", PRUNE_YEAR)


QUERIES = {
    "scan_csv_infer": scan_csv_infer,
    "scan_csv_schema": scan_csv_schema,
    "scan_csv_glob": scan_csv_glob,
    "load_snapshots": load_snapshots,
    "incremental_ingest": incremental_ingest,
    "stage_roundtrip": stage_roundtrip,
    "project_columns": project_columns,
    "select_alias_qualified": select_alias_qualified,
    "parse_mdy_date": parse_mdy_date,
    "fill_nulls_by_type": fill_nulls_by_type,
    "lowercase_columns": lowercase_columns,
    "null_audit": null_audit,
    "filter_is_null": filter_is_null,
    "surrogate_key_small": surrogate_key_small,
    "surrogate_key_bucketed": surrogate_key_bucketed,
    "schema_profile": schema_profile,
    "dedup_business_key": dedup_business_key,
    "dedup_latest": dedup_latest,
    "distinct_pairs": distinct_pairs,
    "distinct_years": distinct_years,
    "row_count": row_count,
    "left_join_three_keys": left_join_three_keys,
    "left_join_two_keys": left_join_two_keys,
    "left_join_title": left_join_title,
    "enrich_with_masters": enrich_with_masters,
    "inner_join_natural_keys": inner_join_natural_keys,
    "inner_join_agency": inner_join_agency,
    "inner_join_title": inner_join_title,
    "inner_join_time": inner_join_time,
    "union_positional": union_positional,
    "union_by_name_drift": union_by_name_drift,
    "preview_limit": preview_limit,
    "dim_employee": dim_employee,
    "dim_agency": dim_agency,
    "dim_jobtitle": dim_jobtitle,
    "dim_time": dim_time,
    "fact_payroll": fact_payroll,
    "fact_payroll_natural": fact_payroll_natural,
    "dim_employee_history": dim_employee_history,
    "fact_employee_version": fact_employee_version,
    "employee_history_changes": employee_history_changes,
    "surrogate_key_stable": surrogate_key_stable,
    "crosswalk_candidates": crosswalk_candidates,
    "crosswalk_employees": crosswalk_employees,
    "crosswalk_orphans": crosswalk_orphans,
    "load_with_quarantine": load_with_quarantine,
    "star_schema_end_to_end": star_schema_end_to_end,
    "sink_parquet": sink_parquet,
    "sink_csv": sink_csv,
    "sink_jdbc": sink_jdbc,
    "warehouse_tables": warehouse_tables,
    "cast_to_warehouse_schema": cast_to_warehouse_schema,
    "check_primary_key": check_primary_key,
    "check_foreign_key": check_foreign_key,
    "check_max_length": check_max_length,
    "full_refresh_twice": full_refresh_twice,
    "staged_job": staged_job,
    "quality_report": quality_report,
    "allocation_by_agency_year": allocation_by_agency_year,
    "allocation_year_over_year": allocation_year_over_year,
    "public_view": public_view,
    "functional_dependencies": functional_dependencies,
    "snapshot_drift": snapshot_drift,
    "public_release": public_release,
    "partition_pruned_scan": partition_pruned_scan,
    "clustered_lookup": clustered_lookup,
}
