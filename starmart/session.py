"""Session helpers: local session for tests/bench, shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "starmart", memory: str = "8g") -> SparkSession:
    """Session for tests and the bench. On a cluster the caller brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_FALLBACK_ROOT: str | None = None  # only when the session names no checkpoint folder


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session; only when nothing is set (tests, the local bench)
    a private temporary folder is created and registered.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # a Spark Connect session has no context object
        sc = None
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    if not root:
        master = spark.conf.get("spark.master", "") or ""
        if not master.startswith("local"):
            # executors on other machines cannot read a folder on the driver's disk
            raise RuntimeError("set spark.checkpoint.dir to a shared folder: written "
                               "tables must outlive executors and be readable by all")
        global _FALLBACK_ROOT
        if _FALLBACK_ROOT is None:
            _FALLBACK_ROOT = tempfile.mkdtemp(prefix="starmart-ckpt-")
        root = _FALLBACK_ROOT
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the checkpoint root for a written table."""
    path = f"{checkpoint_root(spark)}/starmart/{name}-{uuid.uuid4().hex[:12]}"
    _made.append(path)
    return path


_made: list[str] = []  # scratch folders named and not yet dropped


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder this library wrote, on whatever file system it lies."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def free_scratch(spark: SparkSession, since: int = 0) -> None:
    """Drop the scratch folders made so far (from the ``since``-th on). Frames
    that still read them must have been written elsewhere before."""
    for path in _made[since:]:
        drop_path(spark, path)
    del _made[since:]


def scratch_mark() -> int:
    """Where the scratch folders made from now on begin."""
    return len(_made)


def free_named(spark: SparkSession, since: int, *names: str) -> None:
    """Drop the scratch folders of these names made from the ``since``-th on,
    which nothing reads any more: a job of many steps holds only what is to come."""
    spent = [p for p in _made[since:] if p.rsplit("/", 1)[1].rsplit("-", 1)[0] in names]
    for path in spent:
        drop_path(spark, path)
        _made.remove(path)


@contextmanager
def scratch_scope(spark: SparkSession):
    """Scratch folders made inside are dropped at the end; for jobs whose
    results are written tables."""
    since = len(_made)
    try:
        yield
    finally:
        free_scratch(spark, since)


def materialize(df, name: str):
    """Write ``df`` once as parquet under the checkpoint root and return the
    re-read table: lineage is cut, later reads are columnar (only the columns
    a consumer needs are read) and survive lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)
