"""Published tables: versioned Parquet folders behind one append-only commit log.

A publish writes its tables into new folders and then appends one small file to
``<root>/commits`` that names them all.  That file is the commit: it names every table
of the publish or does not exist, and a job that dies before it leaves the last
published state untouched.  The published names are views, each of a catalog table of one version:
they are moved one after another behind the commit, each at once and for all sessions, and
set again from the log whenever a ``Lake`` is opened.  Who reads several of them while a publish
ends may see one moved and another not yet; ``Lake.committed`` reads the tables of one commit together.

There is one writer per lake at a time, as for any full-snapshot load.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from snapfold import schemas
from snapfold.session import configure

_COMMIT = "version BIGINT, table_name STRING, path STRING, buckets INT, committed_at TIMESTAMP"


@dataclass(frozen=True)
class Layout:
    """Columns of a table, and the key it is bucketed by (if any)."""

    columns: tuple[tuple[str, str], ...]
    bucket_by: str | None = None


# Compressed size that a bucket should not exceed.
BUCKET_BYTES = 256 * 1024 * 1024

LAYOUTS = {
    "bronze.employees": Layout(schemas.BRONZE_EMPLOYEES),
    "silver.staged_employees": Layout(schemas.SILVER_EMPLOYEES, bucket_by=schemas.KEY),
    "silver.employees": Layout(schemas.SILVER_EMPLOYEES, bucket_by=schemas.KEY),
    "gold.department_kpi": Layout(schemas.GOLD_DEPARTMENT_KPI),
    "gold.hiring_trends": Layout(schemas.GOLD_HIRING_TRENDS),
}


# The same for tables that outgrow INT keys, counts and cost totals.
WIDE_LAYOUTS = {
    name: Layout(schemas.widened(layout.columns), layout.bucket_by) for name, layout in LAYOUTS.items()
}

# The same for cost totals alone, which outgrow INT long before keys and counts do.
WIDE_TOTAL_LAYOUTS = {
    name: Layout(schemas.widened(layout.columns, ("total_salary_cost",)), layout.bucket_by)
    for name, layout in LAYOUTS.items()
}


class Lake:
    """Tables under ``root``, readable as ``<prefix>bronze.employees`` and so on.

    ``buckets`` is the number of files keyed tables are hashed into; joins on the
    key then read them without a shuffle.  If it is not given, tables start with
    ``spark.sql.shuffle.partitions`` buckets and ``fit_buckets`` adds to them.

    ``layouts`` declares the tables; ``WIDE_LAYOUTS`` lets keys, counts and cost totals
    be BIGINT, which the steps of a cycle then follow.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        prefix: str = "",
        buckets: int | None = None,
        layouts: dict[str, Layout] | None = None,
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.prefix = prefix
        self.fixed_buckets = buckets
        self.layouts = layouts or LAYOUTS
        configure(spark)
        for database in sorted({name.split(".")[0] for name in self.layouts}):
            spark.sql(
                f"CREATE DATABASE IF NOT EXISTS `{prefix}{database}` "
                f"LOCATION '{self.root}/{database}'"
            )
        self._published: dict[str, tuple[str, int]] = {}
        self._fitted: dict[str, int] = {}
        self._version = 0
        for row in self._latest():
            self._version = max(self._version, row.version)
            self._point(row.table_name, row.path, row.buckets)

    def _commits(self) -> DataFrame:
        if not self._version:
            return self.spark.createDataFrame([], _COMMIT)
        return self.spark.read.schema(_COMMIT).parquet(f"{self.root}/commits")

    def _files(self, path: str):
        """The Hadoop file system of a path, and the path for it."""
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def _latest(self) -> list:
        """The last committed folder of every table (one row per table)."""
        path = f"{self.root}/commits"
        file_system, at = self._files(path)
        if not file_system.exists(at):
            return []
        latest = F.max_by(F.struct("path", "buckets"), "version")
        return (
            self.spark.read.schema(_COMMIT)
            .parquet(path)
            .groupBy("table_name")
            .agg(F.max("version").alias("version"), latest.alias("at"))
            .select("table_name", "version", "at.*")
            .collect()
        )

    def catalog_name(self, table: str) -> str:
        database, name = table.split(".")
        return f"`{self.prefix}{database}`.`{name}`"

    def exists(self, table: str) -> bool:
        return table in self._published

    def table(self, table: str) -> DataFrame:
        """The published rows of a table."""
        if table not in self._published:
            raise LookupError(f"{table} has not been published under {self.root}")
        return self.spark.table(self.catalog_name(table))

    def committed(self, *tables: str) -> dict[str, DataFrame]:
        """The given tables as the log has them now, whatever the pointers say."""
        latest = {row.table_name: row.path for row in self._latest()}
        absent = [t for t in tables if t not in latest]
        if absent:
            raise LookupError(f"{', '.join(absent)} not published under {self.root}")
        return {
            t: self.spark.read.schema(schemas.ddl(self.layouts[t].columns)).parquet(latest[t]) for t in tables
        }

    def publish(self, tables: dict[str, DataFrame], verify: Callable[[], None] | None = None) -> int:
        """Replace all the given tables, in one commit; returns its version.

        Rows are inserted by column name into the declared types: overlong texts
        and out-of-range numbers abort, and nothing is published.  ``verify`` is called when the
        rows are written, before the commit: if it raises, nothing is published either.
        """
        version = self._version + 1
        with ThreadPoolExecutor(len(tables)) as pool:
            entries = list(
                pool.map(lambda item: self._write(version, *item), tables.items())
            )
        if verify:
            verify()
        self._commit(entries)
        self._version = version
        for _, table, path, buckets in entries:
            self._point(table, path, buckets)
        return version

    def _write(self, version: int, table: str, rows: DataFrame) -> tuple[int, str, str, int]:
        """Insert the rows into a new folder; returns its entry for the commit."""
        layout = self.layouts[table]
        buckets = self.buckets_of(table) if layout.bucket_by else 0
        own = f"v{version:08d}-{uuid.uuid4().hex[:8]}"
        path = f"{self.root}/{table.replace('.', '/')}/{own}"
        # A name of its own: what a driver that died left in the catalog is in no one's way.
        pending = self._versioned(table, path)
        self._create(pending, layout, path, buckets)
        try:
            columns = schemas.names(layout.columns)
            rows.select(*columns).write.insertInto(self.catalog_name(pending))
        except Exception:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.catalog_name(pending)}")
            raise
        return version, table, path, buckets

    @staticmethod
    def _versioned(table: str, path: str) -> str:
        """The catalog table of one version, named like its folder."""
        return f"{table}__{path.rsplit('/', 1)[-1].replace('-', '_')}"

    def _commit(self, entries: list[tuple[int, str, str, int]]) -> None:
        """Append one file, which appears as a whole or not at all."""
        rows = F.array(
            *[
                F.struct(
                    F.lit(version).cast("bigint").alias("version"),
                    F.lit(table).alias("table_name"),
                    F.lit(path).alias("path"),
                    F.lit(buckets).alias("buckets"),
                    F.current_timestamp().alias("committed_at"),
                )
                for version, table, path, buckets in entries
            ]
        )
        one = self.spark.range(0, 1, 1, numPartitions=1)
        one.select(F.inline(rows)).write.mode("append").parquet(f"{self.root}/commits")

    def by_key(self, table: str, rows: DataFrame) -> DataFrame:
        """``rows`` shuffled the way ``table`` is bucketed: one file per bucket."""
        return rows.repartition(self.buckets_of(table), self.layouts[table].bucket_by)

    def buckets_of(self, table: str) -> int:
        """The number of buckets of the next version of a keyed table."""
        if self.fixed_buckets:
            return self.fixed_buckets
        if table in self._fitted:
            return self._fitted[table]
        if table in self._published:
            return self._published[table][1]
        return int(self.spark.conf.get("spark.sql.shuffle.partitions"))

    def keeps_buckets(self, table: str) -> bool:
        """Whether every present bucket goes to whole buckets of the next version."""
        return self.buckets_of(table) % self._published[table][1] == 0

    def same_buckets(self, table: str, other: str) -> bool:
        """Whether the published ``other`` is dealt and sorted as the next version of ``table``."""
        return self._published[other][1] == self.buckets_of(table) and (
            self.layouts[table].bucket_by == self.layouts[other].bucket_by
        )

    def delete_folder(self, path: str) -> bool:
        file_system, at = self._files(path)
        return file_system.delete(at, True)

    def fit_buckets(self, table: str, like: str) -> int:
        """Let a keyed table have buckets enough for the size of another published one.

        Their number is only ever doubled: what a task holds of the present buckets
        then goes to a few whole new ones, without another shuffle.  Where doubling would
        pass the number that Spark allows, the buckets grow instead.
        """
        most = int(self.spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))
        file_system, at = self._files(self._published[like][0])
        n_bytes = file_system.getContentSummary(at).getLength()
        buckets = self.buckets_of(table)
        while not self.fixed_buckets and n_bytes > buckets * BUCKET_BYTES and 2 * buckets <= most:
            buckets *= 2
        self._fitted[table] = buckets
        return buckets

    def history(self) -> DataFrame:
        """All commits, by version and table."""
        return self._commits().orderBy("version", "table_name")

    def expire(self, keep: int = 1) -> int:
        """Delete all folders but those of the last ``keep`` versions of every table.

        That includes folders of publishes that failed before their commit.
        Returns the number of folders deleted.
        """
        age = F.row_number().over(Window.partitionBy("table_name").orderBy(F.desc("version")))
        kept = (
            self._commits()
            .select("table_name", "path", age.alias("age"))
            .where(F.col("age") <= keep)
            .collect()
        )
        names = {(row.table_name, row.path.rsplit("/", 1)[1]) for row in kept}
        deleted = 0
        for table in {row.table_name for row in kept}:
            file_system, at = self._files(f"{self.root}/{table.replace('.', '/')}")
            for folder in file_system.listStatus(at):
                if (table, folder.getPath().getName()) not in names:
                    old = self._versioned(table, folder.getPath().getName())
                    self.spark.sql(f"DROP TABLE IF EXISTS {self.catalog_name(old)}")
                    deleted += file_system.delete(folder.getPath(), True)
        return deleted

    def _create(self, table: str, layout: Layout, path: str, buckets: int) -> None:
        clustering = (
            f"CLUSTERED BY (`{layout.bucket_by}`) SORTED BY (`{layout.bucket_by}`) "
            f"INTO {buckets} BUCKETS"
            if buckets
            else ""
        )
        self.spark.sql(
            f"CREATE TABLE {self.catalog_name(table)} ({schemas.ddl(layout.columns)}) "
            f"USING parquet {clustering} LOCATION '{path}'"
        )

    def _point(self, table: str, path: str, buckets: int) -> None:
        """Let the published name show a committed folder."""
        if table not in self.layouts:
            return
        version = self._versioned(table, path)
        if not self.spark.catalog.tableExists(self.catalog_name(version)):
            self._create(version, self.layouts[table], path, buckets)
        columns = ", ".join(f"`{c}`" for c in schemas.names(self.layouts[table].columns))
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self.catalog_name(table)} AS "
            f"SELECT {columns} FROM {self.catalog_name(version)}"
        )
        self._published[table] = (path, buckets)
