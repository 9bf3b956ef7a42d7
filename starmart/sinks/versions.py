"""All tables of a warehouse published under one pointer.

    <root>/<table>/version=<v>/     the rows of a table in a version
    <root>/manifest/                one row per published version

A publish writes every table into folders of a new version, checks them, and
only then adds one row to the manifest: a single file that Spark's commit
renames into place. The newest row is the current version of all tables, so
readers see all of the old version or all of the new one, whenever the driver
dies. Nothing that is being read is changed: versions that were superseded stay
for a grace period, then ``drop_expired`` deletes them and what publishes that
died left behind.

``open_version`` gives a reader one version of every table, also while others
publish. Catalog views read the current version through a subquery on the
manifest, which prunes the other versions' folders; each view is of one version,
and a query over several tables that must agree takes ``open_version``.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart import schemas as S
from starmart.operators.quality import quality_report
from starmart.session import drop_path
from starmart.sinks.warehouse import assert_report_clean, create_database, warehouse_conditions

MANIFEST = "manifest"
MANIFEST_SCHEMA = "seq long, version string, published timestamp, tables array<string>"
DAY = 24 * 3600


class NoVersion(ValueError):
    """Nothing is published, or the version is gone."""


def _path(root: str, *names: str) -> str:
    return "/".join([root.rstrip("/"), *names])


def versions(spark: SparkSession, root: str) -> DataFrame:
    """The manifest: (seq, version, published, tables), one row per publish."""
    try:
        return spark.read.schema(MANIFEST_SCHEMA).parquet(_path(root, MANIFEST))
    except AnalysisException:
        # an empty list would be rows of Python, for which every task starts a worker
        return spark.range(0).select(F.from_json(F.lit("{}"), MANIFEST_SCHEMA).alias("v")).select("v.*")


@dataclass(frozen=True)
class Version:
    spark: SparkSession
    root: str
    seq: int
    version: str
    tables: tuple[str, ...]

    def table(self, name: str) -> DataFrame:
        if name not in self.tables:
            raise NoVersion(f"version {self.version} has no table {name!r}")
        return self.spark.read.parquet(_path(self.root, name, f"version={self.version}"))

    def all(self) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in self.tables}

    def as_views(self, prefix: str = "") -> None:
        """Temporary views of this very version, for SQL over several tables."""
        for name, df in self.all().items():
            df.createOrReplaceTempView(f"{prefix}{name}")


def open_version(spark: SparkSession, root: str, version: str | None = None) -> Version:
    """The current version, or the one named."""
    found = versions(spark, root)
    if version is not None:
        found = found.where(F.col("version") == version)
    row = found.orderBy(F.desc("seq"), F.desc("version")).first()
    if row is None:
        raise NoVersion(f"no version {version or ''} published in {root}")
    return Version(spark, root, row.seq, row.version, tuple(row.tables))


def _new_version() -> str:
    return f"v{int(time.time() * 1000):015d}-{uuid.uuid4().hex[:8]}"


def _written_at(version: str) -> float:
    """Seconds of the clock at which a version's name was made."""
    return int(version[1:].split("-")[0]) / 1000


def publish_version(spark: SparkSession, tables: dict[str, DataFrame], root: str, db: str | None = None,
                    check: bool = True, keep_for: float = DAY, views: dict[str, str] | None = None,
                    on_step: Callable[[str], None] = lambda step: None) -> Version:
    """Publish ``tables`` as one version and return it.

    Order: the tables' rows, the checks (with ``check``, the warehouse's keys and
    text lengths on what was written), the manifest row, the views in ``db``
    (``views``: more of them, by name, as SQL with ``{root}`` and ``{current}``),
    and the drop of versions superseded more than ``keep_for`` seconds ago. A
    publish that fails before the manifest row changes nothing for readers.
    ``on_step`` is told each step before it begins.
    """
    if MANIFEST in tables:
        raise ValueError(f"no table can be named {MANIFEST!r}")
    version = _new_version()
    order = [t for t in S.LOAD_ORDER if t in tables] + [t for t in tables if t not in S.LOAD_ORDER]
    for name in order:
        on_step(f"write {name}")
        tables[name].write.parquet(_path(root, name, f"version={version}"))
    if check:
        on_step("check")
        written = {n: spark.read.parquet(_path(root, n, f"version={version}")) for n in order if n in S.WAREHOUSE}
        if written:
            try:
                assert_report_clean(quality_report(*warehouse_conditions(written)))
            except Exception:
                drop_version(spark, root, version, order)
                raise
    on_step("manifest")
    seq = (versions(spark, root).agg(F.max("seq")).first()[0] or 0) + 1
    # one row, one file: it is there or it is not
    (spark.range(1).coalesce(1)
     .select(F.lit(seq).cast("long").alias("seq"), F.lit(version).alias("version"),
             F.current_timestamp().alias("published"), F.array(*[F.lit(n) for n in order]).alias("tables"))
     .write.mode("append").parquet(_path(root, MANIFEST)))
    if db is not None:
        on_step("views")
        create_views(spark, db, root, order, views or {})
    on_step("drop")
    drop_expired(spark, root, keep_for)
    return Version(spark, root, seq, version, tuple(order))


def _current(root: str) -> str:
    return (f"(SELECT max_by(version, struct(seq, version)) FROM parquet.`{_path(root, MANIFEST)}`)")


def create_views(spark: SparkSession, db: str, root: str, names: list[str], more: dict[str, str]) -> None:
    """Views of the current version. Their text is the same after every publish,
    so making them again changes nothing for readers."""
    create_database(spark, db)
    for name in names:
        schema = spark.read.parquet(_path(root, name)).schema
        columns = ", ".join(f"`{f.name}`" for f in schema if f.name != "version")
        spark.sql(f"CREATE OR REPLACE VIEW `{db}`.`{name}` AS SELECT {columns} "
                  f"FROM parquet.`{_path(root, name)}` WHERE version = {_current(root)}")
    for name, text in more.items():
        spark.sql(f"CREATE OR REPLACE VIEW `{db}`.`{name}` AS {text.format(root=root.rstrip('/'), current=_current(root))}")


def drop_version(spark: SparkSession, root: str, version: str, names: list[str]) -> None:
    for name in names:
        drop_path(spark, _path(root, name, f"version={version}"))


def _folders(spark: SparkSession, root: str) -> list[tuple[str, str]]:
    """(table, version) of every folder below ``root``: a few rows per table."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(_path(root, "*", "version=*"))
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    return [(s.getPath().getParent().getName(), s.getPath().getName().removeprefix("version=")) for s in found or []]


def drop_expired(spark: SparkSession, root: str, keep_for: float = DAY) -> list[str]:
    """Delete versions that were superseded more than ``keep_for`` seconds ago, and
    folders that old which no manifest row names (a publish that died, or one that
    takes longer than the period). The current version always stays."""
    known = versions(spark, root).select(
        "version", "seq", F.unix_micros("published").alias("at")).orderBy("seq", "version").collect()  # one row a publish
    now = time.time()
    superseded = {a.version: b.at / 1e6 for a, b in zip(known, known[1:])}
    current = known[-1].version if known else None
    dropped = set()
    for name, version in _folders(spark, root):
        since = superseded.get(version, _written_at(version))
        if version != current and now - since > keep_for:
            drop_path(spark, _path(root, name, f"version={version}"))
            dropped.add(version)
    return sorted(dropped)
