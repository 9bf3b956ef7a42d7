"""Checks the warehouse would enforce on insert, run in Spark before publishing.

Each check returns the violating rows (a DataFrame), so a caller can both
count them and show them; ``quality_report`` folds the counts into one table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.operators.joins import checked_broadcast
from starmart.schemas import VARCHAR_LIMIT


def check_primary_key(df: DataFrame, key: str | list[str]) -> DataFrame:
    """Key values held by more than one row, or null: (key..., n_rows).

    groupBy with partial aggregation: a hot key is pre-counted per task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return counted.where((F.col("n_rows") > 1) | null_key)


def check_foreign_key(child: DataFrame, parent: DataFrame, child_key: str | list[str],
                      parent_key: str | list[str] | None = None) -> DataFrame:
    """Child rows whose key has no parent row (``left_anti``). A null key
    refers to nothing, so it is no violation, as in SQL."""
    ck = [child_key] if isinstance(child_key, str) else list(child_key)
    pk = ck if parent_key is None else ([parent_key] if isinstance(parent_key, str) else list(parent_key))
    cond = reduce(lambda a, b: a & b, [child[c] == parent[p] for c, p in zip(ck, pk)])
    refers = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in ck])
    return child.where(refers).join(parent.select(*pk), cond, "left_anti")


def with_parent_flags(child: DataFrame, parents: dict[str, DataFrame]) -> tuple[DataFrame, dict[str, Column]]:
    """``child`` looked up in several parents ({child key: parent's keys, one
    column}) and, per key, the condition that a row refers to no parent: all
    foreign keys are then counted in one scan of the child."""
    conditions = {}
    for i, (key, parent) in enumerate(parents.items()):
        flag, column = f"_has{i}", parent.columns[0]
        side = parent.select(F.col(column).alias(f"_key{i}")).distinct().withColumn(flag, F.lit(True))
        child = child.join(checked_broadcast(side), F.col(key) == F.col(f"_key{i}"), "left").drop(f"_key{i}")
        conditions[key] = F.col(key).isNotNull() & F.col(flag).isNull()
    return child, conditions


def check_max_length(df: DataFrame, cols: list[str], limit: int = VARCHAR_LIMIT) -> DataFrame:
    """Rows where any of ``cols`` is longer than ``limit`` characters."""
    cond = reduce(lambda a, b: a | b, [F.length(F.col(c)) > limit for c in cols])
    return df.where(cond)


def violations(name: str, rows: DataFrame) -> DataFrame:
    """(check_name, violations) for one check."""
    return rows.agg(F.count(F.lit(1)).alias("violations")) \
        .select(F.lit(name).alias("check_name"), "violations")


def condition_counts(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """(check_name, violations) for many row conditions over ONE frame in one
    scan: a ``count_if`` per condition, then the one-row result is turned into
    rows. A condition that is null for a row does not count it (as ``where``)."""
    names = list(conditions)
    wide = df.agg(*[F.count_if(conditions[n]).alias(f"_{i}") for i, n in enumerate(names)])
    pairs = F.array(*[F.struct(F.lit(n).alias("check_name"), F.col(f"_{i}").alias("violations"))
                      for i, n in enumerate(names)])
    return wide.select(F.explode(pairs).alias("c")).select("c.check_name", "c.violations")


def quality_report(checks: dict[str, DataFrame],
                   row_conditions: list[tuple[DataFrame, dict[str, Column]]] | None = None) -> DataFrame:
    """One row per check: ``checks`` are frames of violating rows (counted
    each), ``row_conditions`` are (frame, {name: condition}) counted in one
    scan per frame. The union runs as one job."""
    parts = [violations(name, rows) for name, rows in checks.items()]
    parts += [condition_counts(df, conds) for df, conds in (row_conditions or []) if conds]
    return reduce(DataFrame.unionByName, parts)
