"""The three-stage job: extract -> transform -> load.

Each stage is a Spark job function taking the session and a config; it
writes its output as parquet stage tables in a shared folder and returns the
re-read frames. A stage raises on failure (nothing is swallowed), so a
scheduler sees the failure and the next stage never runs on stale data.
Stage outputs are written once and read back, so the keys the fact carries
are the keys the dimensions were published with.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart import schemas as S
from starmart.operators.joins import enrich_with_masters
from starmart.operators.quality import quality_report
from starmart.plans import marts
from starmart.plans.star import Star, build_star, clean_payroll, dedup_snapshots, renamed
from starmart.session import drop_path, scratch_scope
from starmart.sinks import versions, warehouse
from starmart.sinks.jdbc import write_jdbc
from starmart.sources.csv import load_folder, load_master, read_stage, write_stage


@dataclass
class JobConfig:
    snapshot_dir: str
    stage_dir: str
    pattern: str = "*payroll_*.csv"
    recursive: bool = False
    emp_master: str | None = None       # CSV paths of the masters (optional)
    agency_master: str | None = None
    title_master: str | None = None
    natural: bool = False               # reference-parity fact joins
    database: str = "payroll"
    warehouse_dir: str | None = None    # where published tables live
    keep_versions_for: float = versions.DAY  # seconds that a superseded version stays readable
    jdbc_url: str | None = None
    jdbc_properties: dict[str, str] = field(default_factory=dict)
    # connections the database sees per table load: a fact of many thousand
    # partitions is coalesced to this many writers instead of opening one
    # connection per partition
    jdbc_connections: int = 16
    jdbc_int_keys: bool = False         # 32-bit ids in the database
    # runs the statements that swap the staged database tables in
    jdbc_swap: Callable[[list[str]], None] | None = None

    def stage(self, name: str) -> str:
        return f"{self.stage_dir.rstrip('/')}/{name}"

    @property
    def warehouse_root(self) -> str:
        return self.warehouse_dir or self.stage("warehouse")


RUNS_SCHEMA = "run string, finished timestamp"


def _new_run(stage: str) -> str:
    return f"{stage}-{uuid.uuid4().hex[:12]}"


def _finish(spark: SparkSession, cfg: JobConfig, run: str, listing: str) -> None:
    """List a run whose folder is whole. Every run writes below a folder of its
    own and is listed last, so one that died leaves the run before untouched."""
    (spark.range(1).coalesce(1).select(F.lit(run).alias("run"), F.current_timestamp().alias("finished"))
     .write.mode("append").parquet(cfg.stage(listing)))


def _last(spark: SparkSession, cfg: JobConfig, listing: str) -> str:
    runs = spark.read.schema(RUNS_SCHEMA).parquet(cfg.stage(listing))
    return runs.orderBy(F.desc("finished"), "run").first().run


def last_extract(spark: SparkSession, cfg: JobConfig) -> str:
    """The extract that finished last."""
    return _last(spark, cfg, "extracts")


def last_run(spark: SparkSession, cfg: JobConfig) -> str:
    """The transform that finished last."""
    return _last(spark, cfg, "runs")


def read_stage_table(spark: SparkSession, cfg: JobConfig, name: str, run: str | None = None) -> DataFrame:
    """A stage table of ``run`` (the merged payroll: by default of the last
    extract) with its fixed schema, in its column order."""
    if run is None and name == "payroll_merged":
        run = last_extract(spark, cfg)
    path = cfg.stage(f"{run}/{name}" if run else name)
    return read_stage(spark, path, S.STAGE[name]).select(*S.STAGE[name].fieldNames())


def extract(spark: SparkSession, cfg: JobConfig) -> DataFrame:
    """Snapshots -> one table, one row per (EmployeeID, FiscalYear), in a folder
    of this extract; a transform that reads an earlier one is not disturbed."""
    run = _new_run("extract")
    merged = dedup_snapshots(load_folder(spark, cfg.snapshot_dir, cfg.pattern, cfg.recursive, provenance=True))
    # the dedup leaves rows hashed by (employee, year): without the rebalance
    # every write task would hold every year and write a file per year
    write_stage(merged, cfg.stage(f"{run}/payroll_merged"), partition_by=["FiscalYear"],
                rebalance=True)
    _finish(spark, cfg, run, "extracts")
    return read_stage_table(spark, cfg, "payroll_merged", run)


def _masters(spark: SparkSession, cfg: JobConfig) -> dict[str, DataFrame | None]:
    def rd(path, schema):
        return load_master(spark, path, schema) if path else None
    return {"emp": rd(cfg.emp_master, S.EMP_MASTER_SCHEMA),
            "agency": rd(cfg.agency_master, S.AGENCY_MASTER_SCHEMA),
            "title": rd(cfg.title_master, S.TITLE_MASTER_SCHEMA)}


def transform(spark: SparkSession, cfg: JobConfig,
              masters: dict[str, DataFrame | None] | None = None) -> Star:
    """Merged stage -> parse, fill -> dimensions -> fact, plus a quality table."""
    run = _new_run("run")
    merged = read_stage_table(spark, cfg, "payroll_merged")
    payroll = clean_payroll(merged, keep_raw_date=True)
    masters = masters if masters is not None else _masters(spark, cfg)

    def keep(name: str, df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
        write_stage(df, cfg.stage(f"{run}/{name}"), partition_by=partition_by)
        return read_stage_table(spark, cfg, name, run)

    with scratch_scope(spark):  # the dense key's ranges, once the stage holds the fact
        star = build_star(payroll.drop("AgencyStartDate_raw"), natural=cfg.natural, materialize=keep)
        # one folder per fiscal year (TimeID is 1:1 with it): reads of a year prune
        fact = keep("fact_table", star.fact, partition_by=["TimeID"])
    star = Star(star.employee, star.agency, star.jobtitle, star.time, _fact=fact)

    checks, rows = warehouse.warehouse_conditions(star.tables())
    checks |= {"renamed_agency": renamed(payroll, "AgencyID", "AgencyName"),
               "renamed_jobtitle": renamed(payroll, "TitleCode", "TitleDescription")}
    conditions = {
        "unparsed_start_date": F.col("AgencyStartDate_raw").isNotNull() & F.col("AgencyStartDate").isNull(),
        "start_after_fiscal_year": F.year("AgencyStartDate") > F.col("FiscalYear"),
    }
    enriched = enrich_with_masters(payroll, masters.get("emp"), masters.get("agency"),
                                   masters.get("title"))
    for flag, name in [("in_emp_master", "emp"), ("in_agency_master", "agency"),
                       ("in_title_master", "title")]:
        if masters.get(name) is not None:
            conditions[f"{name}_master_orphans"] = ~F.col(flag)
    # the null audit of the merged stage before the fill, and the row
    # conditions: one scan each for all of their checks
    nulls = {f"null_{c}": F.col(c).isNull() for c in S.PAYROLL_COLUMNS}
    report = quality_report(checks, [*rows, (merged, nulls), (enriched, conditions)])
    write_stage(report, cfg.stage(f"{run}/quality_report"))
    _finish(spark, cfg, run, "runs")
    return star


def load(spark: SparkSession, cfg: JobConfig) -> dict[str, DataFrame]:
    """Stage tables of the last finished transform -> warehouse types -> one new
    version of all tables and marts (``sinks/versions.py``), and JDBC when a URL
    is configured, dimensions before the fact. The constraints were checked by
    that run on these very tables; its report gates the load, so they are not
    computed twice. Returns the published tables."""
    run = last_run(spark, cfg)
    warehouse.assert_report_clean(read_stage_table(spark, cfg, "quality_report", run))
    staged = {name: read_stage_table(spark, cfg, name, run) for name in S.LOAD_ORDER}
    tables = warehouse.to_warehouse(staged)
    # the load gate has checked that the dimensions' keys are unique
    tables[ALLOCATION_TABLE] = marts.allocation_by_agency_year(tables["fact_table"], tables["agency"], tables["time"])
    version = versions.publish_version(spark, tables, cfg.warehouse_root, cfg.database, check=False,
                                       keep_for=cfg.keep_versions_for, views={marts.PUBLIC_VIEW: public_sql()})
    if cfg.jdbc_url:
        load_jdbc(spark, cfg, version)
    # the stage tables of runs before have done their work; an earlier extract may
    # still be read by a transform under way
    aged = F.unix_timestamp("finished") < F.unix_timestamp() - int(cfg.keep_versions_for)
    for listing, kept, old in (("runs", run, F.lit(True)), ("extracts", last_extract(spark, cfg), aged)):
        listed = spark.read.schema(RUNS_SCHEMA).parquet(cfg.stage(listing))  # one row a run
        for r in listed.where(old).select("run").distinct().collect():
            if r.run != kept:
                drop_path(spark, cfg.stage(r.run))
    return {name: version.table(name) for name in S.LOAD_ORDER}


def load_jdbc(spark: SparkSession, cfg: JobConfig, version: versions.Version) -> None:
    """Copy the tables of a version to a database, dimensions before the fact.

    With ``cfg.jdbc_swap`` the tables are written under staging names and the
    statements of ``warehouse.jdbc_swap`` (create with keys, fill, rename) are
    handed to it, to be run in one transaction; without it the final tables
    are overwritten."""
    suffix = "_staged" if cfg.jdbc_swap else ""
    for name in S.LOAD_ORDER:
        schema = S.with_int_keys(S.WAREHOUSE[name]) if cfg.jdbc_int_keys else S.WAREHOUSE[name]
        table = warehouse.cast_to_schema(version.table(name), schema)
        write_jdbc(table, cfg.jdbc_url, f"{cfg.database}.{name}{suffix}", cfg.jdbc_properties,
                   mode="overwrite", num_partitions=cfg.jdbc_connections,
                   column_types=warehouse.ddl_columns(schema).replace(" NOT NULL", ""))
    if cfg.jdbc_swap:
        cfg.jdbc_swap(warehouse.jdbc_swap(cfg.database, cfg.jdbc_int_keys))


ALLOCATION_TABLE = "allocation_by_agency_year"


def public_sql() -> str:
    """The view for public users: pay by agency, title and year, but no employee
    id, names or fact key. All four tables are of one version."""
    columns = ", ".join(c.lower() for c in marts.PUBLIC_COLUMNS)
    joins = "".join(f" JOIN parquet.`{{root}}/{name}` {name[0]} ON f.{key} = {name[0]}.{key} AND {name[0]}.version = f.version"
                    for name, key in (("agency", "agencyid"), ("jobtitle", "titlecode"), ("time", "timeid")))
    return f"SELECT {columns} FROM parquet.`{{root}}/fact_table` f{joins} WHERE f.version = {{current}}"


def run_all(spark: SparkSession, cfg: JobConfig,
            masters: dict[str, DataFrame | None] | None = None) -> dict[str, DataFrame]:
    extract(spark, cfg)
    transform(spark, cfg, masters)
    return load(spark, cfg)
