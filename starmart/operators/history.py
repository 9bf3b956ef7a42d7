"""Versions of an entity over time, and facts joined to the version of their time.

``validity_intervals`` turns yearly rows into intervals in which the attributes
did not change (gaps and islands). ``as_of_join`` gives every fact the version
that was valid at its year. Both work within one entity, which has at most one
row a year, so no task's group grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

VALIDITY = ["version", "valid_from", "valid_to", "is_current"]


def validity_intervals(df: DataFrame, keys: list[str], at: str, attributes: list[str]) -> DataFrame:
    """(``keys``, ``attributes``, ``VALIDITY``): one row per run of rows of an entity,
    in order of ``at``, with equal attributes (nulls equal each other).

    ``df`` has at most one row per entity and ``at``. A version holds from its
    first row until the next version's, years without a row included; the last
    one has no end. An attribute that changes and changes back gives three
    versions. Rows without ``at`` are left out."""
    of_entity = W.partitionBy(*keys).orderBy(at)
    values = F.struct(*attributes)
    begins = F.row_number().over(of_entity) == 1
    changed = begins | ~F.lag(values).over(of_entity).eqNullSafe(values)
    return (df.where(F.col(at).isNotNull()).select(*keys, at, *attributes)
            .withColumn("_changed", changed).where("_changed")
            # the same partitioning and order: no second shuffle
            .withColumns({"version": F.row_number().over(of_entity), "valid_to": F.lead(at).over(of_entity) - 1})
            .select(*keys, *attributes, "version", F.col(at).alias("valid_from"), "valid_to",
                    F.col("valid_to").isNull().alias("is_current")))


def as_of_join(facts: DataFrame, history: DataFrame, keys: list[str], at: str, columns: list[str]) -> DataFrame:
    """``facts`` with ``columns`` of the version of their entity valid at ``at``; a
    fact before the first version, or of no entity, keeps nulls.

    Both sides meet on the keys alone, and the interval picks one of the entity's
    few versions, so no fact is repeated. Tables bucketed by the keys
    (``write_bucketed``) are joined where they lie."""
    h = history.select(*[F.col(k).alias(f"_h_{k}") for k in keys], F.col("valid_from").alias("_from"),
                       F.col("valid_to").alias("_to"), *[F.col(c).alias(f"_c_{c}") for c in columns])
    on = [facts[k] == h[f"_h_{k}"] for k in keys]
    on += [facts[at] >= h["_from"], h["_to"].isNull() | (facts[at] <= h["_to"])]
    joined = facts.join(h, on, "left")
    return joined.select(*[facts[c] for c in facts.columns if c not in columns], *[F.col(f"_c_{c}").alias(c) for c in columns])


def write_bucketed(df: DataFrame, table: str, keys: list[str], buckets: int, path: str) -> DataFrame:
    """``df`` as a catalog table in ``buckets`` buckets by ``keys``, sorted in each:
    joins and groupings on the keys read it without a shuffle."""
    (df.repartition(buckets, *keys).write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys)
     .option("path", path).saveAsTable(table))
    return df.sparkSession.table(table)


def history_changes(spark: SparkSession, history: DataFrame, keys: list[str], attributes: list[str]) -> DataFrame:
    """(attribute, changes): how often each attribute differs between a version
    and the one before."""
    of_entity = W.partitionBy(*keys).orderBy("version")
    flags = [(~F.lag(a).over(of_entity).eqNullSafe(F.col(a)) & (F.col("version") > 1)).alias(a) for a in attributes]
    counts = history.select(*flags).agg(*[F.count_if(F.col(a)).alias(a) for a in attributes])
    return counts.select(F.explode(F.array(*[
        F.struct(F.lit(a).alias("attribute"), F.col(a).alias("changes")) for a in attributes])).alias("c")).select("c.*")
