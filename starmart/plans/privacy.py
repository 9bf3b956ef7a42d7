"""Releases in which nobody stands out: k-anonymous pay groups.

The public view hides names, but one person alone in an agency and title is
known by them all the same. ``generalize`` publishes pay per group of people of
at least ``k``: a group that is too small gives up one attribute after another
(an agency becomes its borough, then all; a title its family, then all) until it
is part of a group that is large enough. What stays too small is suppressed, and
counted.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.session import materialize


@dataclass(frozen=True)
class Level:
    """One step of generalisation: the value of each attribute (an expression of
    the rows' columns; None: everything) under the attribute's name."""
    name: str
    values: dict[str, Column | None]


ANY = "*"


def generalize(rows: DataFrame, person: str, levels: list[Level], k: int, sums: list[str]) -> DataFrame:
    """(level, attributes, n_people, n_rows, ``sums``): every row in one group.

    Rows take the first of ``levels`` (finest first) at which their group has ``k``
    different people among the rows that no finer level took; the last level's
    rows that are too few have level ``suppressed``, ``ANY`` for every attribute,
    and no sums. So no published group is of under ``k`` people, and no group
    can be found by taking published ones from each other: a row counts in one
    group only.

    A level counts people by group and person first, combined map-side, so a
    person with many rows, or a group of a third of all rows, is no large task."""
    names = list(levels[0].values)
    left, done = rows, None
    for level in levels:
        here = left.select("*", *[(F.lit(ANY) if v is None else F.coalesce(v.cast("string"), F.lit(""))).alias(f"_g_{n}")
                                  for n, v in level.values.items()])
        groups = [f"_g_{n}" for n in names]
        by_person = here.groupBy(*groups, person).agg(F.count("*").alias("_rows"), *[F.sum(s).alias(s) for s in sums])
        counted = materialize(
            by_person.groupBy(*groups).agg(F.count("*").alias("n_people"), F.sum("_rows").alias("n_rows"),
                                           *[F.sum(s).cast(by_person.schema[s].dataType).alias(s) for s in sums]),
            "privacy-groups")
        large = F.col("n_people") >= k
        part = counted.where(large).select(F.lit(level.name).alias("level"), *[F.col(f"_g_{n}").alias(n) for n in names],
                                           "n_people", "n_rows", *sums)
        done = part if done is None else done.unionByName(part)
        small = counted.where(~large).select(*[F.col(g).alias(f"{g}_") for g in groups])
        # few groups are small, or their rows are few: either way this is what is left
        left = materialize(
            here.join(small, [here[g] == small[f"{g}_"] for g in groups], "left_semi").drop(*groups), "privacy-left")
    rest = left.agg(F.count_distinct(person).alias("n_people"), F.count("*").alias("n_rows")).where("n_rows > 0")
    return done.unionByName(rest.select(
        F.lit("suppressed").alias("level"), *[F.lit(ANY).alias(n) for n in names], "n_people", "n_rows",
        *[F.lit(None).cast(done.schema[s].dataType).alias(s) for s in sums]))


def payroll_levels(agency: str = "AgencyName", borough: str = "WorkLocationBorough",
                   title: str = "TitleDescription", year: str = "FiscalYear") -> list[Level]:
    """Agency and title; agency and title family; agency; borough; the year."""
    family = F.substring_index(F.col(title), " ", 1)  # the first word of a title names its family
    return [Level("agency and title", {"place": F.col(agency), "title": F.col(title), "year": F.col(year)}),
            Level("agency and family", {"place": F.col(agency), "title": family, "year": F.col(year)}),
            Level("agency", {"place": F.col(agency), "title": None, "year": F.col(year)}),
            Level("borough", {"place": F.col(borough), "title": None, "year": F.col(year)}),
            Level("year", {"place": None, "title": None, "year": F.col(year)})]
