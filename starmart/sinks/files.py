"""File sinks: parquet (the default) and CSV (hand-off parity)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None,
                  mode: str = "overwrite", rebalance: bool = False) -> str:
    """Replace ``path`` with ``df``; ``partition_by`` gives one folder per value
    so that reads filtered on it open only the matching folders. ``rebalance``
    as in ``sources.csv.write_stage``: one folder's rows per write task."""
    if partition_by and rebalance:
        df = df.hint("rebalance", *partition_by)
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", header: bool = True,
              compression: str | None = None) -> str:
    """CSV with a header line in every part file. Default mode here is
    overwrite (a re-run replaces the output instead of failing)."""
    w = df.write.mode(mode).option("header", header)
    if compression:
        w = w.option("compression", compression)
    w.csv(path)
    return path


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


def read_csv_back(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(path)
