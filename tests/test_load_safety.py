"""Headers of any number of files, the load gate, the swap, masters by name,
stage schemas, and storage that is freed."""

import glob
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F
from test_fixtures import ROWS_2020, ROWS_2021, row, write

from conftest import ROOT, SF_SMALL
from starmart import schemas as S
from starmart.operators import quality
from starmart.plans import jobs, marts
from starmart.plans import registered as R
from starmart.plans.star import build_star, clean_payroll, dedup_snapshots
from starmart.session import free_scratch
from starmart.sinks import versions, warehouse
from starmart.sources import csv as src
from starmart.streaming.snapshots import ingest, read_bronze


# headers

N_FILES = 300


@pytest.fixture(scope="module")
def many_files(tmp_path_factory):
    """One folder with both header versions, file by file in turn."""
    folder = tmp_path_factory.mktemp("many")
    for i in range(N_FILES):
        write(folder / f"payroll_{i:04d}.csv", [row(PayrollNumber=1000 + i, EmployeeID=i)],
              agency_col="AgencyCode" if i % 2 else "AgencyID")
    return folder


def test_any_number_of_mixed_headers_in_one_folder(spark, many_files):
    paths = src.discover_files(spark, str(many_files), "payroll_*.csv")
    assert len(paths) == N_FILES
    rows = src.load_snapshots(spark, paths).collect()
    assert sorted(r.PayrollNumber for r in rows) == list(range(1000, 1000 + N_FILES))
    assert all(r.AgencyID is not None and r.FiscalYear is not None for r in rows)


def test_any_number_of_mixed_headers_in_a_stream(spark, many_files, scratch):
    ingest(spark, str(many_files), f"{scratch}/bronze", f"{scratch}/ckpt")
    rows = read_bronze(spark, f"{scratch}/bronze").collect()
    assert sorted(r.PayrollNumber for r in rows) == list(range(1000, 1000 + N_FILES))
    assert all(r.AgencyID is not None for r in rows)


def test_a_file_without_a_known_header_fails(spark, tmp_path):
    write(tmp_path / "payroll_2020.csv", ROWS_2020)
    (tmp_path / "payroll_2021.csv").write_text("A,B\n1,2\n")
    paths = src.discover_files(spark, str(tmp_path), "payroll_*.csv")
    with pytest.raises(ValueError, match="1 files have no header"):
        src.load_snapshots(spark, paths)


def test_odd_file_names_and_quoted_headers(spark, tmp_path):
    folder = tmp_path / "a b%20c"
    folder.mkdir()
    path = write(folder / "payroll 2020 (1).csv", ROWS_2020)
    lines = open(path).read().split("\n")
    lines[0] = ",".join(f'"{c}"' for c in lines[0].strip().split(","))
    with open(path, "w") as f:
        f.write("\n".join(lines))
    paths = src.discover_files(spark, str(folder), "payroll*.csv")
    assert src.load_snapshots(spark, paths).count() == len(ROWS_2020)


def test_sub_folders_are_ignored_unless_asked_for(spark, tmp_path):
    write(tmp_path / "payroll_2020.csv", ROWS_2020)
    for sub in ("st/TimeID=5", "TimeID=6", "payroll_old.csv"):
        (tmp_path / sub).mkdir(parents=True)
        write(tmp_path / sub / "payroll_2021.csv", ROWS_2021)
    assert len(src.discover_files(spark, str(tmp_path), "payroll_*.csv")) == 1
    assert len(src.discover_files(spark, str(tmp_path), "payroll_*.csv", recursive=True)) == 4
    with pytest.raises(src.NoSnapshotFiles):
        src.discover_files(spark, str(tmp_path), "nothing_*.csv")


def test_inferred_types_widen_by_name(spark, tmp_path):
    """infer=True: hours are int in one file and double in the other."""
    write(tmp_path / "payroll_2020.csv", [row(RegularHours="1.5", PayrollNumber=1)])
    write(tmp_path / "payroll_2021.csv", [row(RegularHours="2", PayrollNumber=2)], agency_col="AgencyCode")
    paths = src.discover_files(spark, str(tmp_path), "payroll_*.csv")
    for order in (paths, paths[::-1]):
        df = src.load_snapshots(spark, order, infer=True)
        assert dict(df.dtypes)["RegularHours"] == "double" and dict(df.dtypes)["AgencyID"] == "int"
        assert {r.PayrollNumber: r.RegularHours for r in df.collect()} == {1: 1.5, 2: 2.0}
        assert df.where("AgencyID IS NULL").count() == 0


def test_csv_stage_reads_back_with_its_schema(spark, scratch):
    """A CSV hand-off loses empty strings; parquet keeps them."""
    df = spark.createDataFrame([(1, ""), (2, None), (3, "x")], "k int, s string")
    path = src.write_stage(df, f"{scratch}/csv_stage", fmt="csv")
    back = src.read_stage(spark, path, df.schema, fmt="csv")
    assert back.dtypes == df.dtypes
    assert {r.k: r.s for r in back.collect()} == {1: None, 2: None, 3: "x"}
    pq = src.write_stage(df, f"{scratch}/pq_stage")
    assert {r.k: r.s for r in src.read_stage(spark, pq, df.schema).collect()}[1] == ""


# ties and nulls

def test_the_newest_file_wins_a_tie(spark, tmp_path):
    old = write(tmp_path / "payroll_z.csv", [row(PayrollNumber=7, EmployeeID=1, LastName="OLD")])
    new = write(tmp_path / "payroll_a.csv", [row(PayrollNumber=7, EmployeeID=1, LastName="NEW")])
    for older, newer, want in ((old, new, "NEW"), (new, old, "OLD")):
        os.utime(older, (1_000_000_000, 1_000_000_000))
        os.utime(newer, (1_500_000_000, 1_500_000_000))
        paths = src.discover_files(spark, str(tmp_path), "payroll_*.csv")
        one = dedup_snapshots(src.load_snapshots(spark, paths, provenance=True)).collect()
        assert [r.LastName for r in one] == [want]
        assert set(one[0].asDict()) == set(S.PAYROLL_COLUMNS)


def test_tied_payroll_numbers_make_no_orphans(spark, tmp_path):
    rows = [row(PayrollNumber=996, EmployeeID=i % 3, FiscalYear=2020 + i % 2, AgencyID=10 + i, AgencyName=f"A{i}",
                TitleCode=100 + i, TitleDescription=f"T{i}") for i in range(12)]
    write(tmp_path / "payroll_2020.csv", rows)
    paths = src.discover_files(spark, str(tmp_path), "payroll_*.csv")
    star = build_star(clean_payroll(dedup_snapshots(src.load_snapshots(spark, paths, provenance=True))))
    checks = warehouse.warehouse_checks(warehouse.to_warehouse(star.tables()))
    assert {n: c.count() for n, c in checks.items() if c.count()} == {}


def test_null_order_value_loses(spark):
    from starmart.operators.dedup import assert_total_order, dedup_by
    df = spark.createDataFrame([(1, None, "a"), (1, 3, "b"), (1, 5, "c"), (2, None, "d")], "k int, o int, v string")
    for total in (False, True):
        first = {r.k: r.v for r in dedup_by(df, ["k"], ["o"], "first", total).collect()}
        last = {r.k: r.v for r in dedup_by(df, ["k"], ["o"], "last", total).collect()}
        assert first == {1: "b", 2: "d"} and last == {1: "c", 2: "d"}
    assert_total_order(df, ["k"], ["o"])
    with pytest.raises(ValueError):
        assert_total_order(df.unionAll(df), ["k"], ["o"])


def test_null_foreign_key_is_no_orphan(spark):
    child = spark.createDataFrame([(1, 1), (2, None), (3, 9)], "id int, k int")
    parent = spark.createDataFrame([(1,), (None,)], "k int")
    assert [r.id for r in quality.check_foreign_key(child, parent, "k").collect()] == [3]
    df, missing = quality.with_parent_flags(child, {"k": parent})
    assert [r.id for r in df.where(missing["k"]).collect()] == [3] and df.count() == 3


# masters

def test_masters_are_read_by_name(spark, tmp_path):
    (tmp_path / "AgencyMaster.csv").write_text("AgencyName,AgencyID\nPARKS,7\n")
    got = src.load_master(spark, str(tmp_path / "AgencyMaster.csv"), S.AGENCY_MASTER_SCHEMA).collect()
    assert [(r.AgencyID, r.AgencyName) for r in got] == [(7, "PARKS")]
    (tmp_path / "AgencyMaster.csv").write_text("AgencyID,AgencyName\nseven,PARKS\n")
    with pytest.raises(Exception):
        src.load_master(spark, str(tmp_path / "AgencyMaster.csv"), S.AGENCY_MASTER_SCHEMA).collect()


# the job

def _config(spark, scratch, rows, db, **more):
    os.makedirs(f"{scratch}/in", exist_ok=True)
    write(f"{scratch}/in/payroll_2020.csv", rows)
    return jobs.JobConfig(snapshot_dir=f"{scratch}/in", stage_dir=f"{scratch}/stage", database=db, **more)


def _published(spark, db):
    return {n: sorted(spark.table(f"{db}.{n}").collect(), key=str) for n in S.LOAD_ORDER}


def test_a_transform_that_dies_is_never_loaded(spark, scratch, monkeypatch):
    db = "starmart_gate"
    cfg = _config(spark, scratch, ROWS_2020, db)
    jobs.run_all(spark, cfg)
    before = _published(spark, db)
    first = jobs.last_run(spark, cfg)
    write(f"{scratch}/in/payroll_2021.csv", ROWS_2021, agency_col="AgencyCode")
    jobs.extract(spark, cfg)
    with monkeypatch.context() as m:
        def die(*a, **k):
            raise RuntimeError("killed")
        m.setattr(jobs, "quality_report", die)
        with pytest.raises(RuntimeError):
            jobs.transform(spark, cfg)
    assert jobs.last_run(spark, cfg) == first
    jobs.load(spark, cfg)
    assert _published(spark, db) == before
    jobs.transform(spark, cfg)
    jobs.load(spark, cfg)
    assert len(_published(spark, db)["fact_table"]) > len(before["fact_table"])
    assert jobs.last_run(spark, cfg) != first


def test_a_dirty_report_stops_the_load(spark, scratch, monkeypatch):
    db = "starmart_dirty"
    cfg = _config(spark, scratch, ROWS_2020, db)
    jobs.run_all(spark, cfg)
    before = _published(spark, db)
    write(f"{scratch}/in/payroll_2021.csv", [row(LastName="X" * 1001, EmployeeID=77, PayrollNumber=77)])
    jobs.extract(spark, cfg)
    jobs.transform(spark, cfg)
    with pytest.raises(warehouse.ConstraintViolation):
        jobs.load(spark, cfg)
    assert _published(spark, db) == before


class Killed(BaseException):
    """Nothing in the library catches this, as nothing outlives a killed driver."""


STEPS = ["write employee", "write agency", "write jobtitle", "write time", "write fact_table",
         f"write {jobs.ALLOCATION_TABLE}", "manifest", "views", "drop"]


def test_a_load_killed_at_any_step_shows_one_whole_version(spark, scratch, monkeypatch):
    db = "starmart_kill"
    cfg = _config(spark, scratch, ROWS_2020, db, keep_versions_for=3600)
    jobs.run_all(spark, cfg)
    old = _published(spark, db)
    public = sorted(spark.table(f"{db}.{marts.PUBLIC_VIEW}").collect(), key=str)
    reader = versions.open_version(spark, cfg.warehouse_root)
    slow = reader.all()  # a reader that started before
    write(f"{scratch}/in/payroll_2021.csv", ROWS_2021, agency_col="AgencyCode")
    jobs.extract(spark, cfg)
    jobs.transform(spark, cfg)
    publish = versions.publish_version
    seen = []
    for die_at in STEPS:
        def on_step(step, die_at=die_at):
            seen.append(step)
            if step == die_at:
                raise Killed

        with monkeypatch.context() as m:
            m.setattr(versions, "publish_version", lambda *a, **k: publish(*a, **k, on_step=on_step))
            with pytest.raises(Killed):
                jobs.load(spark, cfg)
        now, of_views = versions.open_version(spark, cfg.warehouse_root), _published(spark, db)
        if STEPS.index(die_at) <= STEPS.index("manifest"):
            assert now.version == reader.version and of_views == old
            assert sorted(spark.table(f"{db}.{marts.PUBLIC_VIEW}").collect(), key=str) == public
        else:
            assert now.seq > reader.seq and len(of_views["fact_table"]) > len(old["fact_table"])
            assert of_views == {n: sorted(now.table(n).collect(), key=str) for n in S.LOAD_ORDER}
    assert list(dict.fromkeys(seen)) == STEPS
    assert {n: sorted(slow[n].collect(), key=str) for n in S.LOAD_ORDER} == old  # and ends well
    with_views = f"SELECT count(*) FROM {db}.fact_table f JOIN {db}.agency a ON f.agencyid = a.agencyid"
    jobs.load(spark, cfg)
    assert spark.sql(with_views).first()[0] == len(_published(spark, db)["fact_table"])
    # after the grace period one version of each table stays, of dead publishes nothing
    last = versions.open_version(spark, cfg.warehouse_root).version
    versions.drop_expired(spark, cfg.warehouse_root, keep_for=0)
    assert {os.path.basename(p) for p in glob.glob(f"{cfg.warehouse_root}/*/version=*")} == {f"version={last}"}
    assert len(glob.glob(f"{scratch}/stage/run-*")) == 1
    with pytest.raises(Exception):
        slow["fact_table"].collect()


def test_a_driver_that_is_gone_before_the_manifest(spark, scratch):
    """A process of its own, ended without any clean-up."""
    versions.publish_version(spark, {"nation": spark.range(3).toDF("k")}, scratch, check=False)
    code = f"""
import os, sys
sys.path.insert(0, {ROOT!r})
from starmart.session import local_session
from starmart.sinks import versions
spark = local_session(2, 2)
versions.publish_version(spark, {{"nation": spark.range(9).toDF("k"), "region": spark.range(2).toDF("k")}}, {scratch!r},
                         check=False, on_step=lambda step: os._exit(9) if step == "manifest" else None)
"""
    assert subprocess.run([sys.executable, "-c", code], timeout=120, capture_output=True).returncode == 9
    assert glob.glob(f"{scratch}/region/version=*/part-*")  # written, but not published
    now = versions.open_version(spark, scratch)
    assert now.tables == ("nation",) and now.table("nation").count() == 3
    with pytest.raises(versions.NoVersion):
        now.table("region")


def test_versions_by_name_and_views_of_one_version(spark, scratch):
    with pytest.raises(versions.NoVersion):
        versions.open_version(spark, scratch)
    one = versions.publish_version(spark, {"a": spark.range(1).toDF("k"), "b": spark.range(1).toDF("k")}, scratch, check=False)
    two = versions.publish_version(spark, {"a": spark.range(2).toDF("k"), "b": spark.range(2).toDF("k")}, scratch, check=False)
    assert [r.version for r in versions.versions(spark, scratch).orderBy("seq").collect()] == [one.version, two.version]
    versions.open_version(spark, scratch, one.version).as_views("pinned_")
    assert spark.sql("SELECT count(*) FROM pinned_a JOIN pinned_b USING (k)").first()[0] == 1
    assert versions.open_version(spark, scratch).table("a").count() == 2
    # the view's subquery prunes the other versions' folders
    versions.create_views(spark, "starmart_two", scratch, ["a", "b"], {})
    view = spark.table("starmart_two.a")
    assert view.count() == 2
    plan = view._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(version" in plan and "Subquery" in plan


def test_a_renamed_agency_is_reported_and_never_multiplies(spark, scratch):
    db = "starmart_renamed"
    rows = [row(EmployeeID=1, PayrollNumber=1, FiscalYear=2020, AgencyID=5, AgencyName="OLD NAME"),
            row(EmployeeID=2, PayrollNumber=2, FiscalYear=2021, AgencyID=5, AgencyName="NEW NAME")]
    cfg = _config(spark, scratch, rows, db)
    tables = jobs.run_all(spark, cfg)
    assert [r.agencyname for r in tables["agency"].collect()] == ["NEW NAME"]
    report = {r.check_name: r.violations for r in
              jobs.read_stage_table(spark, cfg, "quality_report", jobs.last_run(spark, cfg)).collect()}
    assert report["renamed_agency"] == 1 and report["pk_agency"] == 0
    assert spark.table(f"{db}.{jobs.ALLOCATION_TABLE}").count() == 2
    public = spark.table(f"{db}.{marts.PUBLIC_VIEW}")
    assert public.count() == 2
    assert not {"payrollid", "employeeid", "lastname", "firstname", "payrollnumber"} & set(public.columns)
    # a dimension passed in with two names for an agency still gives each row once
    doubled = tables["agency"].unionByName(tables["agency"].withColumn("agencyname", F.lit("OTHER")))
    alloc = marts.allocation_by_agency_year(tables["fact_table"], doubled, tables["time"])
    assert alloc.count() == 2 and alloc.agg(F.sum("n_rows")).first()[0] == 2
    assert marts.public_view(spark, tables["fact_table"], doubled, tables["jobtitle"], tables["time"]).count() == 2


def test_ids_beyond_32_bits_are_published(spark, scratch):
    big = 3_000_000_000
    cfg = _config(spark, scratch, [row(PayrollNumber=big, EmployeeID=big + 1)], "starmart_big")
    fact = jobs.run_all(spark, cfg)["fact_table"].first()
    assert (fact.payrollnumber, fact.employeeid) == (big, big + 1)


def test_job_with_masters(spark, scratch):
    os.makedirs(f"{scratch}/m")
    r = ROWS_2020[0]
    with open(f"{scratch}/m/agency.csv", "w") as f:
        f.write(f"AgencyName,AgencyID\n\"{r['AgencyName']}\",{r['AgencyID']}\n")
    with open(f"{scratch}/m/emp.csv", "w") as f:
        f.write("EmployeeID,LastName,FirstName\n-1,NO,ONE\n")
    cfg = _config(spark, scratch, ROWS_2020, "starmart_masters", agency_master=f"{scratch}/m/agency.csv",
                  emp_master=f"{scratch}/m/emp.csv")
    jobs.run_all(spark, cfg)
    merged = clean_payroll(jobs.read_stage_table(spark, cfg, "payroll_merged"))
    report = {x.check_name: x.violations for x in
              jobs.read_stage_table(spark, cfg, "quality_report", jobs.last_run(spark, cfg)).collect()}
    n = merged.count()
    hits = merged.where((F.col("AgencyID") == int(r["AgencyID"])) & (F.col("AgencyName") == r["AgencyName"])).count()
    assert hits and report["agency_master_orphans"] == n - hits and report["emp_master_orphans"] == n


def test_stage_tables_keep_their_types(spark, scratch):
    cfg = _config(spark, scratch, ROWS_2020, "starmart_types")
    star = jobs.transform(spark, cfg) if jobs.extract(spark, cfg) else None
    for name, df in star.tables().items():
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in S.STAGE[name]]
    assert dict(star.fact.dtypes)["TimeID"] == "bigint"  # also as the partition column


def test_database_statements():
    ddl = warehouse.jdbc_ddl("payroll")
    assert len(ddl) == 5 and "payrollid BIGINT NOT NULL" in ddl[-1] and ddl[-1].count("REFERENCES") == 4
    assert "payrollid INT NOT NULL" in warehouse.jdbc_ddl("payroll", int_keys=True)[-1]
    swap = warehouse.jdbc_swap("payroll")
    assert swap[0] == "DROP TABLE IF EXISTS payroll.fact_table" and swap[-1] == "DROP TABLE payroll.fact_table_staged"


# storage

def test_runs_leave_nothing_behind(spark):
    from starmart.session import checkpoint_root
    root = f"{checkpoint_root(spark)}/starmart"

    def left():
        free_scratch(spark)
        return (sorted(os.listdir(root)) if os.path.isdir(root) else [],
                sorted(r[0] for r in spark.sql("SHOW DATABASES").collect()))

    for key in ("warehouse_tables", "full_refresh_twice"):
        R.QUERIES[key](spark, SF_SMALL).collect()
    first = left()
    for key in ("warehouse_tables", "full_refresh_twice"):
        R.QUERIES[key](spark, SF_SMALL).collect()
    assert left() == first


def test_publish_fails_without_leftovers(spark, scratch):
    db = "starmart_leftovers"
    bad = {"agency": spark.createDataFrame([(1, "A"), (1, "B")], "agencyid int, agencyname string")}
    with pytest.raises(warehouse.ConstraintViolation):
        warehouse.publish(spark, bad, db, scratch)
    assert glob.glob(f"{scratch}/agency/v=*") == []
    assert not spark.catalog.tableExists(f"{db}.agency")
