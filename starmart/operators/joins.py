"""Joins of the payroll star: master enrichment and dimension lookups.

Broadcast is used only behind a size check: ``small_enough`` counts the rows of
the candidate side and adds up their bytes (actual text lengths plus
fixed-width columns) in one aggregate, of which every task sends one row. Above
either bound the
join is left to the planner (sort-merge, or AQE's runtime switch on measured
sizes), and AQE's skew-join handling splits a hot key on the big side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart import schemas as S

BROADCAST_ROWS = 1_000_000       # dimensions of a payroll star are far below this
BROADCAST_BYTES = 64 * 1024 ** 2  # what every executor would hold per broadcast


def _fixed_width(dt: T.DataType) -> int:
    if isinstance(dt, (T.BooleanType, T.ByteType)):
        return 1
    if isinstance(dt, T.ShortType):
        return 2
    if isinstance(dt, (T.IntegerType, T.FloatType, T.DateType)):
        return 4
    if isinstance(dt, (T.LongType, T.DoubleType, T.TimestampType, T.TimestampNTZType)):
        return 8
    return 16  # decimals and anything else: an upper bound for the star's types


def _row_bytes(df: DataFrame) -> F.Column:
    """Bytes of a row: UTF-8 length of text/binary columns, fixed size of the rest."""
    fixed, variable = 0, []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            variable.append(F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)))
        else:
            fixed += _fixed_width(f.dataType)
    total = F.lit(fixed + 8)  # + per-row overhead
    for v in variable:
        total = total + v
    return total


def small_enough(df: DataFrame, limit: int = BROADCAST_ROWS,
                 max_bytes: int = BROADCAST_BYTES) -> bool:
    """True when ``df`` has at most ``limit`` rows that together take at most
    ``max_bytes``. Counts and bytes are added up per task, no row moves; pass a
    written table where evaluating ``df`` twice costs."""
    r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(_row_bytes(df)).alias("b")).first()
    return r.n <= limit and (r.b or 0) <= max_bytes


def checked_broadcast(df: DataFrame, limit: int = BROADCAST_ROWS,
                      max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``broadcast(df)`` if its size is proven under both bounds, else ``df``."""
    return F.broadcast(df) if small_enough(df, limit, max_bytes) else df


def left_join_master(df: DataFrame, master: DataFrame, keys: list[str],
                     flag: str | None = None, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Left join on ``keys`` (USING form). When every master column is a key
    the join adds nothing but a match flag, so the master is reduced to its
    distinct keys first: duplicates in a master cannot multiply payroll rows.
    """
    extra = [c for c in master.columns if c not in keys]
    side = master.select(*keys).distinct() if not extra else master
    if flag:
        side = side.withColumn(flag, F.lit(True))
    joined = df.join(checked_broadcast(side, limit), keys, "left")
    if flag:
        joined = joined.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))
    return joined


def enrich_with_masters(df: DataFrame, emp: DataFrame | None, agency: DataFrame | None,
                        title: DataFrame | None, flags: bool = True) -> DataFrame:
    """The chain employee -> agency -> title master, each a left join."""
    out = df
    if emp is not None:
        out = left_join_master(out, emp, S.EMP_MASTER_KEYS,
                               "in_emp_master" if flags else None)
    if agency is not None:
        out = left_join_master(out, agency, S.AGENCY_MASTER_KEYS,
                               "in_agency_master" if flags else None)
    if title is not None:
        out = left_join_master(out, title, S.TITLE_MASTER_KEYS,
                               "in_title_master" if flags else None)
    return out


class NaturalKeyNotUnique(ValueError):
    """A dimension's natural key maps to more than one row."""


def assert_unique(dim: DataFrame, keys: list[str], what: str = "dimension") -> None:
    """Fail with the offending keys when ``keys`` is not unique in ``dim``."""
    bad = dim.groupBy(*keys).count().where("count > 1").limit(20).collect()
    if bad:
        raise NaturalKeyNotUnique(f"{what}: key {keys} not unique, e.g. {bad[:5]}")


def join_dimension(df: DataFrame, dim: DataFrame, on: list[str], alias: str,
                   how: str = "inner", limit: int = BROADCAST_ROWS) -> DataFrame:
    """Look a dimension up by ``on``; the dim gets ``alias`` so its copy of a
    shared column can be picked as ``F.col(f"{alias}.<col>")``."""
    return df.join(checked_broadcast(dim, limit).alias(alias), on, how)
