"""Typed warehouse tables in the Spark catalog.

``publish`` is a full refresh done safely: every table is written to a new
versioned folder first, the PK/FK checks run on what was written, and only
then the catalog entries are pointed at the new folders, one ``ALTER TABLE
... SET LOCATION`` each, dimensions before the fact: no table is ever missing.
If one of them fails, those already changed are pointed back. A failed run
leaves the previous version in place and drops what it wrote; a run that
succeeds drops the version before.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart import schemas as S
from starmart.functions.clean import lowercase_columns
from starmart.operators.quality import (check_foreign_key, check_max_length, check_primary_key,
                                        quality_report, with_parent_flags)
from starmart.session import drop_path


def cast_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select ``schema``'s columns (matched case-insensitively) cast to its types.

    Under ANSI mode (Spark's default) a value that does not fit - a 64-bit key
    beyond INT, pay beyond DECIMAL(10,2) - fails the job instead of loading
    a wrong number.
    """
    by_lower = {c.lower(): c for c in df.columns}
    missing = [f.name for f in schema.fields if f.name.lower() not in by_lower]
    if missing:
        raise ValueError(f"columns missing for the target schema: {missing}")
    return df.select(*[F.col(by_lower[f.name.lower()]).cast(f.dataType).alias(f.name)
                       for f in schema.fields])


def to_warehouse(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Lower-case names and warehouse types for the five star tables."""
    return {name: cast_to_schema(lowercase_columns(df), S.WAREHOUSE[name])
            for name, df in tables.items()}


def _strings(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def warehouse_checks(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The constraints of the warehouse DDL as Spark checks (violating rows)."""
    checks = {}
    for name, df in tables.items():
        checks[f"pk_{name}"] = check_primary_key(df, S.PRIMARY_KEYS[name])
        if strings := _strings(df):
            checks[f"length_{name}"] = check_max_length(df, strings)
    fact = tables.get("fact_table")
    if fact is not None:
        for col, parent in S.FOREIGN_KEYS.items():
            if parent in tables:
                checks[f"fk_{parent}"] = check_foreign_key(fact, tables[parent], col)
    return checks


def warehouse_conditions(tables: dict[str, DataFrame]) -> tuple[dict[str, DataFrame], list]:
    """The same constraints for ``quality_report`` with one scan per table for
    everything that a row shows on its own: (primary key checks, [(table,
    conditions)]). The fact's foreign keys are looked up in one pass of it."""
    keys, rows = {}, []
    for name, df in tables.items():
        keys[f"pk_{name}"] = check_primary_key(df, S.PRIMARY_KEYS[name])
        conditions = {}
        if name == "fact_table":
            parents = {c: tables[p].select(S.PRIMARY_KEYS[p]) for c, p in S.FOREIGN_KEYS.items() if p in tables}
            df, missing = with_parent_flags(df, parents)
            conditions = {f"fk_{S.FOREIGN_KEYS[c]}": m for c, m in missing.items()}
        if strings := _strings(tables[name]):
            conditions[f"length_{name}"] = reduce(
                lambda a, b: a | b, [F.length(F.col(c)) > S.VARCHAR_LIMIT for c in strings])
        rows.append((df, conditions))
    return keys, rows


class ConstraintViolation(RuntimeError):
    pass


GATING_PREFIXES = ("pk_", "fk_", "length_")


def assert_report_clean(report: DataFrame) -> None:
    """Raise when a quality report has violations of a warehouse constraint
    (primary key, foreign key, text length). Other rows are informational."""
    failed = [r.check_name for r in report.collect()
              if r.check_name.startswith(GATING_PREFIXES) and r.violations]
    if failed:
        raise ConstraintViolation(f"not published, checks failed: {failed}")


def create_database(spark: SparkSession, db: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}`")


def ddl_columns(schema: T.StructType, varchar: int = S.VARCHAR_LIMIT) -> str:
    """Column list in the warehouse's types: strings as VARCHAR(limit), which
    Spark enforces on insert (a longer text fails the write)."""
    def sql_type(dt: T.DataType) -> str:
        return f"VARCHAR({varchar})" if isinstance(dt, T.StringType) else dt.simpleString().upper()
    return ", ".join(f"{f.name} {sql_type(f.dataType)}" + ("" if f.nullable else " NOT NULL")
                     for f in schema.fields)


def jdbc_ddl(db: str, int_keys: bool = False) -> list[str]:
    """CREATE TABLE statements of the five tables for a database, with NOT NULL,
    primary and foreign keys; dimensions before the fact."""
    out = []
    for name in S.LOAD_ORDER:
        schema = S.with_int_keys(S.WAREHOUSE[name]) if int_keys else S.WAREHOUSE[name]
        keys = [f"PRIMARY KEY ({S.PRIMARY_KEYS[name]})"]
        if name == "fact_table":
            keys += [f"FOREIGN KEY ({c}) REFERENCES {db}.{p} ({S.PRIMARY_KEYS[p]})"
                     for c, p in S.FOREIGN_KEYS.items()]
        out.append(f"CREATE TABLE {db}.{name} ({ddl_columns(schema)}, {', '.join(keys)})")
    return out


def jdbc_swap(db: str, int_keys: bool = False) -> list[str]:
    """Statements that replace the five tables by their staged copies: drop
    (fact first), create with keys, fill, drop the copies."""
    columns = {n: ", ".join(S.WAREHOUSE[n].fieldNames()) for n in S.LOAD_ORDER}
    return ([f"DROP TABLE IF EXISTS {db}.{n}" for n in reversed(S.LOAD_ORDER)] + jdbc_ddl(db, int_keys)
            + [f"INSERT INTO {db}.{n} ({columns[n]}) SELECT {columns[n]} FROM {db}.{n}_staged" for n in S.LOAD_ORDER]
            + [f"DROP TABLE {db}.{n}_staged" for n in S.LOAD_ORDER])


def _location(spark: SparkSession, table: str) -> str | None:
    if not spark.catalog.tableExists(table):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
    return rows[0].data_type if rows else None


def _point(spark: SparkSession, table: str, location: str) -> None:
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{location}'")
    spark.catalog.refreshTable(table)


def publish(spark: SparkSession, tables: dict[str, DataFrame], db: str, root: str,
            check: bool = True) -> dict[str, str]:
    """Full refresh of ``db`` from ``tables`` (dims before fact), returns the
    new folder of each table. Only the published version's folders stay."""
    create_database(spark, db)
    version = uuid.uuid4().hex[:12]
    order = [t for t in S.LOAD_ORDER if t in tables] + [t for t in tables if t not in S.LOAD_ORDER]
    written = {name: f"{root.rstrip('/')}/{name}/v={version}" for name in order}
    at = {name: f"`{db}`.`{name}`" for name in order}
    before: dict[str, str | None] = {}
    try:
        for name in order:
            tables[name].write.mode("overwrite").parquet(written[name])
        if check:
            staged = {n: spark.read.parquet(p) for n, p in written.items() if n in S.WAREHOUSE}
            if staged:
                # all checks as one job; the report is one small row per check
                assert_report_clean(quality_report(*warehouse_conditions(staged)))
        for name in order:
            before[name] = _location(spark, at[name])
            if before[name] is None:
                cols = f"({ddl_columns(S.WAREHOUSE[name])}) " if name in S.WAREHOUSE else ""
                spark.sql(f"CREATE TABLE {at[name]} {cols}USING parquet LOCATION '{written[name]}'")
            else:
                _point(spark, at[name], written[name])
    except BaseException:
        for name, location in before.items():
            if location is not None:
                _point(spark, at[name], location)
            else:
                spark.sql(f"DROP TABLE IF EXISTS {at[name]}")
        for path in written.values():
            drop_path(spark, path)
        raise
    for location in before.values():
        if location is not None:
            drop_path(spark, location)
    return written


def drop_warehouse(spark: SparkSession, db: str, root: str) -> None:
    """Drop a database with its tables and the folder they lie in."""
    spark.sql(f"DROP DATABASE IF EXISTS `{db}` CASCADE")
    drop_path(spark, root)


def table_counts(spark: SparkSession, db: str, names: list[str]) -> DataFrame:
    """(table_name, n_rows) for published tables."""
    parts = [spark.table(f"`{db}`.`{n}`").agg(F.count(F.lit(1)).alias("n_rows"))
             .select(F.lit(n).alias("table_name"), "n_rows") for n in names]
    return reduce(DataFrame.unionByName, parts)
