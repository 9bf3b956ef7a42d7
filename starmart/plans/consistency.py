"""Is a snapshot like the ones before it?

``year_sketches`` keeps, per year and column, counts and two mergeable sketches
(how many different values, and how values are spread), so a year is read once
and compared with any other later; sketches of parts of a year merge
(``merged``). ``drift`` compares every year with the one before. ``dependencies``
finds which columns fix which others (an id its name, a code its text), and
``broken_dependencies`` the years in which one that holds elsewhere does not.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SHARES = (0.1, 0.25, 0.5, 0.75, 0.9)  # the quantiles that are compared


def year_sketches(df: DataFrame, year: str, numbers: list[str], others: list[str]) -> DataFrame:
    """(year, column, n, n_null, distinct, spread): one row per year and column;
    ``spread`` (of numbers) is null for ``others``. One pass over ``df``, in which
    tasks send a sketch of fixed size per year and column."""
    columns = [*numbers, *others]
    aggregates = [F.count("*").alias("n")]
    for c in columns:
        aggregates += [F.count_if(F.col(c).isNull()).alias(f"null_{c}"),
                       F.hll_sketch_agg(F.col(c).cast("string")).alias(f"distinct_{c}")]
    aggregates += [F.kll_sketch_agg_double(F.col(c).cast("double")).alias(f"spread_{c}") for c in numbers]
    wide = df.groupBy(F.col(year).cast("int").alias("year")).agg(*aggregates)
    no_spread = F.lit(None).cast("binary")
    return wide.select("year", "n", F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"null_{c}").alias("n_null"), F.col(f"distinct_{c}").alias("distinct"),
                 (F.col(f"spread_{c}") if c in numbers else no_spread).alias("spread")) for c in columns])).alias("s")
    ).select("year", "s.column", "n", "s.n_null", "s.distinct", "s.spread")


def merged(sketches: DataFrame) -> DataFrame:
    """One row per year and column of sketches of parts of the years."""
    spread = F.when(F.count("spread") > 0, F.kll_merge_agg_double("spread"))
    return sketches.groupBy("year", "column").agg(
        F.sum("n").alias("n"), F.sum("n_null").alias("n_null"), F.hll_union_agg("distinct").alias("distinct"),
        spread.alias("spread"))


def _percentiles(spread: str) -> Column:
    return F.kll_sketch_get_quantile_double(spread, F.array(*[F.lit(i / 100) for i in range(1, 100)]))


def _distance(a: str, b: str) -> Column:
    """The largest difference of the ranks of two lists of percentiles at
    ``SHARES`` of either, in hundredths."""
    def difference(of: str, other: str, share: float) -> Column:
        at = F.get(F.col(of), round(100 * share) - 1)
        return F.abs(F.size(F.filter(other, lambda q: q <= at)) / F.lit(100.0) - F.lit(share))

    return F.greatest(*[difference(x, y, q) for x, y in ((a, b), (b, a)) for q in SHARES])


def drift(sketches: DataFrame, max_nulls: float = 0.05, max_distinct: float = 0.5, max_spread: float = 0.15) -> DataFrame:
    """(year, before, column, nulls, distinct, spread, drifted): every year against
    the one before. ``nulls`` is the change of the null share, ``distinct`` that of
    the number of different values a row (relative), ``spread`` the distance of
    the distributions; ``drifted`` where one is beyond its limit."""
    of_column = W.partitionBy("column").orderBy("year")  # a row a year
    rows = sketches.withColumns({"null_share": F.col("n_null") / F.col("n"), "kinds": F.hll_sketch_estimate("distinct") / F.col("n")})
    last = {c: F.lag(c).over(of_column) for c in ("year", "null_share", "kinds", "spread")}
    both = rows.withColumns({f"_{c}": v for c, v in last.items()}).where("_year IS NOT NULL")
    # an empty sketch has no quantiles
    has_spread = ((F.col("spread").isNotNull()) & F.col("_spread").isNotNull() & (F.col("null_share") < 1) & (F.col("_null_share") < 1))
    both = both.withColumns({f"{c}p": F.when(has_spread, _percentiles(c)) for c in ("spread", "_spread")})
    measured = both.select(
        "year", F.col("_year").alias("before"), "column", F.abs(F.col("null_share") - F.col("_null_share")).alias("nulls"),
        (F.abs(F.col("kinds") - F.col("_kinds")) / F.greatest("kinds", "_kinds")).alias("distinct"),
        F.when(has_spread, _distance("spreadp", "_spreadp")).alias("spread"))
    beyond = [F.col(c) > limit for c, limit in (("nulls", max_nulls), ("distinct", max_distinct), ("spread", max_spread))]
    return measured.withColumn("drifted", F.coalesce(reduce(lambda a, b: a | b, [F.coalesce(x, F.lit(False)) for x in beyond]), F.lit(False)))


# dependencies

def _many(y: str) -> Column:
    """Whether a group has several values of ``y``, null being one."""
    return (F.min(y) != F.max(y)) | ((F.count(y) > 0) & (F.count(y) < F.count("*")))


def _groups(df: DataFrame, x: str, others: list[str], by: list[str]) -> DataFrame:
    broken = df.where(F.col(x).isNotNull()).groupBy(*by, x).agg(*[F.coalesce(_many(y), F.lit(False)).alias(y) for y in others])
    counted = broken.groupBy(*by).agg(F.count("*").alias("n_groups"), *[F.count_if(y).alias(y) for y in others])
    return counted.select(*by, F.lit(x).alias("determinant"), "n_groups", F.explode(F.array(*[
        F.struct(F.lit(y).alias("dependent"), F.col(y).alias("n_broken")) for y in others])).alias("d")).select(
        *by, "determinant", "d.dependent", "n_groups", "d.n_broken")


def dependencies(df: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """(``by``, determinant, dependent, n_groups, n_broken) for all pairs of
    ``columns``: how many values the determinant has, and how many of them meet
    several values of the dependent (null counts as a value). It holds where
    ``n_broken`` is 0. One grouping per determinant tests all dependents by their
    least and greatest value, combined map-side; a null determinant fixes nothing."""
    columns, by = list(columns), by or []
    return reduce(DataFrame.unionByName, [_groups(df, x, [y for y in columns if y != x], by) for x in columns])


def broken_dependencies(df: DataFrame, year: str, columns: list[str], max_share: float = 0.02) -> DataFrame:
    """(year, determinant, dependent, n_groups, n_broken): years that break a
    dependency which holds in most years, with more than ``max_share`` of the
    determinant's values (fewer are slips)."""
    found = dependencies(df, columns, [year])
    breaks = F.col("n_broken") > max_share * F.col("n_groups")
    of_pair = W.partitionBy("determinant", "dependent")  # a row a year
    return (found.withColumn("_breaks", breaks).withColumn("_bad", F.count_if("_breaks").over(of_pair))
            .withColumn("_all", F.count("*").over(of_pair)).where(F.col("_breaks") & (2 * F.col("_bad") < F.col("_all")))
            .select(F.col(year).alias("year"), "determinant", "dependent", "n_groups", "n_broken"))
