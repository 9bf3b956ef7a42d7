"""Bad rows of a load set aside instead of ending it.

A line whose fields do not fit the schema goes to a table of its own, with its
file and the reason; the others load. A gate on the share of bad lines keeps a
load from passing with most of its data set aside.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart import schemas
from starmart.session import materialize
from starmart.sources.csv import CORRUPT, PROVENANCE, load_folder


class TooManyBadRows(RuntimeError):
    """More rows are in quarantine than the load allows."""


@dataclass
class Load:
    rows: DataFrame        # with the schema's columns (and the provenance)
    quarantine: DataFrame  # (file, line, reason)
    n_rows: int
    n_bad: int


def load_with_quarantine(spark: SparkSession, directory: str, pattern: str, recursive: bool = False,
                         schema: T.StructType = schemas.PAYROLL_SCHEMA, renames: dict[str, str] | None = None,
                         max_bad_share: float = 0.01, provenance: bool = False) -> Load:
    """``load_folder`` without an end at the first bad line. The lines are parsed
    once and written; rows and quarantine are read from there. More than
    ``max_bad_share`` of bad lines raise ``TooManyBadRows``."""
    parsed = load_folder(spark, directory, pattern, recursive, schema, renames, provenance=provenance, quarantine=True)
    kept = materialize(parsed, "parsed-lines")
    columns = [*schema.fieldNames(), *([PROVENANCE] if provenance else [])]
    is_bad = F.col(CORRUPT).isNotNull()
    counts = kept.agg(F.count("*").alias("n"), F.count(CORRUPT).alias("bad")).first()
    if counts.bad > max_bad_share * counts.n:
        raise TooManyBadRows(f"{counts.bad} of {counts.n} lines do not fit the schema")
    bad = kept.where(is_bad).select(F.col("_file").alias("file"), F.col(CORRUPT).alias("line"), F.col("_reason").alias("reason"))
    return Load(kept.where(~is_bad).select(*columns), bad, counts.n - counts.bad, counts.bad)
