"""Headers from first blocks, folders of any number of files, quarantine."""

import bz2
import gzip
import os
import random

import pytest
from pyspark.sql import functions as F
from test_fixtures import ROWS_2020, ROWS_2021, row, write

from starmart import schemas as S
from starmart.sources import csv as src
from starmart.sources import headers as H
from starmart.sources.quarantine import TooManyBadRows, load_with_quarantine


def by_number(df):
    return sorted((r.PayrollNumber, r.AgencyID, r.LastName, r.FiscalYear) for r in df.collect())


def test_first_lines_of_any_file(tmp_path):
    texts = {"a.csv": b"A,B\n1,2\n", "b.csv": b"\xef\xbb\xbfA,B\r\n1,2\r\n", "c.csv": b"A,B", "d.csv": b"",
             "e.csv": "é,日本\n".encode(), "f.csv": b"x" * 40_000 + b"\n1\n", "g.csv": b"A,B\r1,2\r"}
    want = {"a.csv": "A,B", "b.csv": "A,B", "c.csv": "A,B", "d.csv": "", "e.csv": "é,日本", "f.csv": "x" * 40_000, "g.csv": "A,B"}
    for name, data in texts.items():
        for suffix, packed in (("", data), (".gz", gzip.compress(data)), (".bz2", bz2.compress(data))):
            path = tmp_path / (name + suffix)
            path.write_bytes(packed)
            for block in (7, 1 << 14):
                assert H.first_line(f"file:{path}", block) == want[name], (name, suffix, block)
    with pytest.raises(ValueError, match="unknown compression"):
        H.first_line(f"{tmp_path}/x.snappy")


def test_only_the_first_block_is_read(tmp_path, monkeypatch):
    path = tmp_path / "big.csv"
    path.write_bytes(b"A,B\n" + b"1,2\n" * 1_000_000)
    read = []
    open_file = H.open_file

    def counting(p):
        stream = open_file(p)

        class Counted:
            def __enter__(self):
                return self

            def __exit__(self, *a):
                stream.close()

            def read(self, n):
                data = stream.read(n)
                read.append(len(data))
                return data
        return Counted()

    monkeypatch.setattr(H, "open_file", counting)
    assert H.first_line(str(path)) == "A,B"
    assert sum(read) == 1 << 14


def test_a_folder_of_many_versions_in_one_scan(spark, tmp_path):
    """Names drift, and so does the order of the columns."""
    for i in range(60):
        path = write(tmp_path / f"payroll_{i:03d}.csv", [row(PayrollNumber=i, EmployeeID=i, AgencyID=i % 7, LastName=f"N{i}")],
                     agency_col="AgencyCode" if i % 2 else "AgencyID")
        if i % 3 == 0:
            lines = [line.rstrip("\r\n").split(",") for line in open(path)]
            with open(path, "w") as f:
                f.writelines(",".join(reversed(line)) + "\n" for line in lines)
    df = src.load_folder(spark, str(tmp_path), "payroll_*.csv", provenance=True)
    assert df.columns == [*S.PAYROLL_COLUMNS, src.PROVENANCE]
    assert by_number(df) == [(i, i % 7, f"N{i}", int(row()["FiscalYear"])) for i in range(60)]
    assert df.select(f"{src.PROVENANCE}.path").distinct().count() == 60
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("] text") == 1
    paths = src.discover_files(spark, str(tmp_path), "payroll_*.csv")
    assert by_number(src.load_snapshots(spark, random.Random(1).sample(paths, 60))) == by_number(df)


def test_one_order_of_columns_needs_no_join(spark, tmp_path):
    write(tmp_path / "payroll_1.csv", ROWS_2020)
    write(tmp_path / "payroll_2.csv", ROWS_2021, agency_col="AgencyCode")
    df = src.load_folder(spark, str(tmp_path), "payroll_*.csv")
    assert "Join" not in df._jdf.queryExecution().executedPlan().toString()
    assert df.count() == len(ROWS_2020) + len(ROWS_2021)


def test_folders_and_compressed_files(spark, tmp_path):
    write(tmp_path / "payroll_1.csv", ROWS_2020)
    (tmp_path / "payroll_old.csv").mkdir()
    write(tmp_path / "payroll_old.csv" / "payroll_2.csv", ROWS_2021)
    assert src.load_folder(spark, str(tmp_path), "payroll_*.csv").count() == len(ROWS_2020)
    assert src.load_folder(spark, str(tmp_path), "payroll_*.csv", recursive=True).count() == len(ROWS_2020) + len(ROWS_2021)
    packed = tmp_path / "packed"
    packed.mkdir()
    with open(tmp_path / "payroll_1.csv", "rb") as f, gzip.open(packed / "payroll_1.csv.gz", "wb") as g:
        g.write(f.read())
    write(packed / "payroll_2.csv", ROWS_2021, agency_col="AgencyCode")
    assert src.load_folder(spark, str(packed), "payroll_*").count() == len(ROWS_2020) + len(ROWS_2021)
    with pytest.raises(src.NoSnapshotFiles):
        src.load_folder(spark, str(tmp_path), "nothing_*.csv")
    with pytest.raises(src.NoSnapshotFiles):
        src.load_folder(spark, str(tmp_path / "missing"), "payroll_*.csv")


def test_too_many_headers_and_strange_ones(spark, tmp_path):
    headers = spark.createDataFrame([(f"f{i}", "a,b" + " " * i) for i in range(5)], "file string, header string")
    schema = spark.createDataFrame([], "a int, b int").schema
    assert len(H.versions_of(headers, schema, {})) == 1
    with pytest.raises(ValueError, match="more than 3"):
        H.versions_of(headers, schema, {}, most=3)
    with pytest.raises(ValueError, match="5 files have no header"):
        H.versions_of(headers, spark.createDataFrame([], "a int, c int").schema, {})


# quarantine

def test_bad_rows_are_set_aside_with_file_and_reason(spark, tmp_path):
    good = [row(PayrollNumber=i, EmployeeID=i) for i in range(40)]
    write(tmp_path / "payroll_1.csv", good[:20])
    path = write(tmp_path / "payroll_2.csv", [*good[20:], row(PayrollNumber=90, FiscalYear="soon"),
                                             row(PayrollNumber=91, BaseSalary="12345678901.00")], agency_col="AgencyCode")
    with open(path, "a") as f:
        f.write("only,three,fields\n")
    load = load_with_quarantine(spark, str(tmp_path), "payroll_*.csv", max_bad_share=0.1)
    assert (load.n_rows, load.n_bad) == (40, 3) and sorted(r.PayrollNumber for r in load.rows.collect()) == list(range(40))
    bad = sorted(load.quarantine.collect(), key=lambda r: r.reason)
    assert [r.reason for r in bad] == ["3 fields of 19", 'BaseSalary: "12345678901.00" does not fit decimal(10,2)',
                                       'FiscalYear: "soon" does not fit int']
    assert all(os.path.basename(r.file) == "payroll_2.csv" for r in bad) and bad[0].line == "only,three,fields"
    with pytest.raises(TooManyBadRows, match="3 of 43"):
        load_with_quarantine(spark, str(tmp_path), "payroll_*.csv", max_bad_share=0.05)
    with pytest.raises(Exception):  # without a quarantine the load ends
        src.load_folder(spark, str(tmp_path), "payroll_*.csv").collect()


def test_reasons_follow_the_files_own_column_order(spark, tmp_path):
    write(tmp_path / "payroll_1.csv", [row(PayrollNumber=i) for i in range(10)])
    path = write(tmp_path / "payroll_2.csv", [row(PayrollNumber=50, OTHours="many")])
    lines = [line.rstrip("\r\n").split(",") for line in open(path)]
    with open(path, "w") as f:
        f.writelines(",".join(reversed(line)) + "\n" for line in lines)
    load = load_with_quarantine(spark, str(tmp_path), "payroll_*.csv", max_bad_share=0.2)
    assert load.n_rows == 10 and [r.reason for r in load.quarantine.collect()] == ['OTHours: "many" does not fit decimal(10,2)']
    assert load.rows.where(F.col("AgencyID").isNull()).isEmpty()
