"""starmart: yearly payroll snapshots -> checked star schema, as Spark jobs.

Sub-packages
  sources    CSV discovery, multi-snapshot load, stage tables
  functions  column-level cleaning (dates, null fill, names, audits)
  operators  dedup, dense keys, checked joins, quality checks
  plans      dimension / fact builders, marts, the three-stage job
  sinks      parquet, CSV, JDBC and catalog publishing
  streaming  incremental snapshot ingestion with Structured Streaming
"""

__version__ = "0.1.0"
