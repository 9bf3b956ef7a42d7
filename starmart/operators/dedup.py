"""Deterministic duplicate removal.

``dropDuplicates(keys)`` keeps an arbitrary row. Here the survivor is chosen
by a stated order, and the choice is a ``min``/``max`` over a struct inside a
``groupBy``: Spark combines it map-side (partial aggregate) before the shuffle,
so a key that holds a third of all rows is reduced to one row per map task
instead of being sorted in one reducer, as a ``row_number()`` window would.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _order(order: list[str], keep: str) -> list[Column]:
    # a null order value loses in both directions: it sorts last for the
    # smallest, first for the largest
    out = []
    for i, c in enumerate(order):
        null_flag = F.col(c).isNull() if keep == "first" else F.col(c).isNotNull()
        out += [null_flag.alias(f"_n{i}"), F.col(c).alias(f"_o{i}")]
    return out


def dedup_by(df: DataFrame, keys: list[str], order: list[str], keep: str = "first",
             total_order: bool = False) -> DataFrame:
    """One row per ``keys``: the smallest (``keep='first'``) or largest
    (``keep='last'``) by ``order``; a null order value loses. Ties are broken
    by the remaining columns, so the pick does not depend on input order.

    ``total_order`` declares that ``order`` is unique within a key (its rows
    then need no tie-break): every other column is picked on its own, so
    Catalyst prunes those that nobody reads, down to the scan. Do not declare
    it for numbers that repeat; ``assert_total_order`` checks it.

    Output keeps the input column order.
    """
    if keep not in ("first", "last"):
        raise ValueError("keep must be 'first' or 'last'")
    rest = [c for c in df.columns if c not in keys]
    if total_order:
        pick_by = F.min_by if keep == "first" else F.max_by
        by = F.struct(*_order(order, keep))
        return df.groupBy(*keys).agg(*[pick_by(F.col(c), by).alias(c) for c in rest]).select(*df.columns)
    pick = F.min if keep == "first" else F.max
    # the order's columns are in the struct once: rows that tie have them in common
    held = {c: f"_o{i}" for i, c in enumerate(order)}
    picked = df.groupBy(*keys).agg(
        pick(F.struct(*_order(order, keep), *[F.col(c) for c in rest if c not in held])).alias("_s"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_s.{held.get(c, c)}").alias(c)
                           for c in df.columns])


def assert_total_order(df: DataFrame, keys: list[str], order: list[str]) -> None:
    """Fail when ``order`` is not unique within ``keys`` (counted map-side)."""
    again = df.groupBy(*keys, *order).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    if not again.isEmpty():
        raise ValueError(f"{order} repeats within {keys}")


def distinct_of(df: DataFrame, cols: list[str]) -> DataFrame:
    """Distinct combinations of ``cols`` (partial + final hash aggregate)."""
    return df.select(*cols).distinct()


def row_count(df: DataFrame, name: str = "row_count") -> DataFrame:
    """Global count as a one-row frame (partial counts per task, then one sum)."""
    return df.agg(F.count(F.lit(1)).alias(name))
