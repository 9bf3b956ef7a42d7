"""Queries with a SQL form against DuckDB, on the shipped tables and on odd rows."""

import duckdb
import pytest

from conftest import SF_SMALL
from helpers import odd_rows, odd_table, rows_of, with_clashes
from starmart.llm.exact_dedup import exact_dedup
from starmart.llm.line_dedup import line_dedup
from starmart.llm.mix import mix_sources
from starmart.llm.oracles import ORACLE_SQL
from starmart.llm.quality import quality_rules
from starmart.llm.queries import QUERIES
from pyspark.sql import functions as F


def _sql_rows(con, sql, columns):
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    assert sorted(names) == sorted(columns)
    at = [names.index(c) for c in sorted(columns)]
    return sorted((tuple(r[i] for i in at) for r in res.fetchall()),
                  key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "labels", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_SMALL}/{table}.parquet')")
    df = QUERIES[name](spark, SF_SMALL)
    assert rows_of(df) == _sql_rows(con, ORACLE_SQL[name], df.columns)


ON_ODD = {
    "op2_mix_sources": lambda d: mix_sources(d).drop("repeats"),
    "op3_exact_dedup": exact_dedup,
    "op6_quality_rules": lambda d: quality_rules(d).drop("clean_text"),
    "op8_line_dedup": lambda d: line_dedup(d).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256")),
}


@pytest.mark.parametrize("name", sorted(ON_ODD))
def test_odd_rows_match_sql(spark, name):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", odd_rows())
    df = ON_ODD[name](with_clashes(odd_table(spark)))
    assert rows_of(df) == _sql_rows(con, ORACLE_SQL[name], df.columns)


@pytest.mark.parametrize("name", sorted(ON_ODD))
def test_empty_table(spark, name):
    empty = odd_table(spark).limit(0)
    out = ON_ODD[name](empty)
    assert out.count() == 0
    assert out.schema == ON_ODD[name](odd_table(spark)).schema
