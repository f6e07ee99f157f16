"""Star tables as parquet folders by day and run, replaced by dynamic partition overwrite.

A batch is a run: it writes the partitions ``run=<batch>`` of each table, the fact's below
``date_id``, and nothing else. So a repeated batch overwrites what it wrote before and
touches no other rows, and what a batch may skip is decided from the rows of earlier batches
only (``batch_id`` is stored with every row).

As runs pile up, ``close`` writes the rows of all runs up to a batch once more, as one run
per day, and then marks that batch as closed. The mark is what readers go by: with batch
``k`` closed, the live runs are those above ``k`` and the closings up to it, a filter on the
partition column alone. A reader therefore sees the tables as before the closing or as after
it, and a closing that died is repeated from where it was. Runs that a closing took over are
deleted by ``sweep``, once nobody reads them any more. The newest batch is never closed, as
its stream may repeat it; repeating a closed one changes nothing.

The customers, the one dimension that grows with the traffic, are a bucketed table over the
same kind of folders: a batch's keys are shuffled to the buckets of the history, which itself
is read in place. Buckets should be no fewer than the shuffle partitions of the sessions
that write, or the engine shuffles the history after all.
"""

from __future__ import annotations

import hashlib
import threading
from collections.abc import Collection, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viewtide import schemas

PARTITIONS = schemas.DAY_TABLES
#: Folder value of rows without a partition value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
MARKS = "closed_batches"
#: Bucketed tables and the key they are bucketed by.
BUCKETED = {"dim_customer": "customer_id"}


def closing_run(batch_id: int) -> int:
    """The run that holds the rows of the batches closed with ``batch_id``."""
    return -batch_id - 1


_switching = threading.Lock()


@contextmanager
def _dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    """SQL that overwrites replaces only the partitions it writes; it has no option for that,
    unlike a writer, so the session's setting is lent for the statement."""
    name = "spark.sql.sources.partitionOverwriteMode"
    with _switching:
        before = spark.conf.get(name)
        spark.conf.set(name, "dynamic")
        try:
            yield
        finally:
            spark.conf.set(name, before)


class Warehouse:
    def __init__(self, spark: SparkSession, root: str, buckets: int = 16):
        """``buckets`` holds for the life of the tables."""
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _folders(self, pattern: str) -> list[str]:
        """Folders that match a pattern below the root."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{pattern}")
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return [status.getPath().toString() for status in fs.globStatus(path) or []]

    def _bucketed(self, table: str, spark: SparkSession) -> str:
        """The catalog's name of a bucketed table; it is entered if it is not known yet."""
        name = f"{table}_{hashlib.md5(self.root.encode()).hexdigest()}"
        if not spark.catalog.tableExists(name):
            fields = schemas.ddl(schemas.stored(table))
            spark.sql(
                f"""CREATE TABLE IF NOT EXISTS {name} ({fields}) USING parquet PARTITIONED BY (run)
                CLUSTERED BY ({BUCKETED[table]}) INTO {self.buckets} BUCKETS LOCATION '{self.path(table)}'"""
            )
            if self._run_folders(table):
                spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
        return name

    # -- reading -------------------------------------------------------------------------

    def closed(self) -> int:
        """The last closed batch, -1 if none is."""
        marks = self._folders(f"{MARKS}/batch_id=*")
        return max((int(mark.rsplit("=", 1)[1]) for mark in marks), default=-1)

    def _live(self, closed: int) -> Column:
        return (F.col("run") > closed) | F.col("run").between(closing_run(closed), -1)

    def with_runs(
        self, table: str, days: Collection[int | None] | None = None, closed: int | None = None
    ) -> DataFrame:
        """Live rows with their ``batch_id`` and ``run``; of some days, only their folders
        are listed and opened (None: undated rows)."""
        fields = schemas.stored(table)
        found = [table]
        if days is not None and table in PARTITIONS:
            key = PARTITIONS[table]
            found = [f"{table}/{key}={NO_VALUE if d is None else d}" for d in sorted(set(days), key=str)]
        paths = [path for name in found for path in self._folders(name)]
        if not paths:
            nulls = ", ".join(f"CAST(NULL AS {kind}) AS `{name}`" for name, kind in fields.items())
            return self.spark.sql(f"SELECT {nulls} WHERE false")
        if table in BUCKETED:
            name = self._bucketed(table, self.spark)
            # Another session, such as a stream's, may have replaced a partition's files.
            self.spark.catalog.refreshTable(name)
            rows = self.spark.table(name)
        else:
            reader = self.spark.read.schema(schemas.ddl(fields)).option("basePath", self.path(table))
            rows = reader.parquet(*paths)
        return rows.where(self._live(self.closed() if closed is None else closed)).select(*fields)

    def with_batches(
        self, table: str, days: Collection[int | None] | None = None, before: int | None = None
    ) -> DataFrame:
        """Rows with their ``batch_id``; ``before``: of earlier batches only."""
        rows = self.with_runs(table, days)
        if before is not None:
            rows = rows.where((F.col("run") < before) & (F.col("batch_id") < before))
        return rows.drop("run")

    def table(self, table: str, days: Collection[int | None] | None = None) -> DataFrame:
        return self.with_batches(table, days).drop("batch_id")

    def before(
        self, table: str, batch_id: int, days: Collection[int | None] | None = None
    ) -> DataFrame:
        """The table as earlier batches left it."""
        return self.with_batches(table, days, batch_id).drop("batch_id")

    # -- writing -------------------------------------------------------------------------

    def _overwrite(self, table: str, rows: DataFrame, run: int) -> None:
        """Write rows (with ``batch_id``) as the whole content of a run's partitions."""
        fields = schemas.stored(table)
        rows = rows.withColumn("run", F.lit(run)).select(
            *[F.col(name).cast(kind).alias(name) for name, kind in fields.items()]
        )
        if table in BUCKETED:
            name, spark = self._bucketed(table, rows.sparkSession), rows.sparkSession
            with _dynamic_overwrite(spark):
                spark.sql(
                    f"INSERT OVERWRITE TABLE {name} PARTITION (run) SELECT * FROM {{rows}}",
                    rows=rows.repartition(self.buckets, BUCKETED[table]),
                )
            return
        keys = ["run"]
        if table in PARTITIONS:
            keys = [PARTITIONS[table], "run"]
            # Few files per day, with large days split over several tasks.
            rows = rows.hint("rebalance", keys[0])
        # Keys are hex digits, which the default codec stores a byte each.
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer = writer.option("compression", "zstd")
        writer.partitionBy(*keys).parquet(self.path(table))

    def write_batch(self, table: str, rows: DataFrame, batch_id: int) -> None:
        """Write the rows as the whole content of one batch of the table."""
        self._overwrite(table, rows.withColumn("batch_id", F.lit(batch_id)), batch_id)

    # -- closing -------------------------------------------------------------------------

    def _run_folders(self, table: str) -> dict[str, int]:
        """The folders of a table's runs, live or not."""
        depth = "*/run=*" if table in PARTITIONS else "run=*"
        return {f: int(f.rsplit("=", 1)[1]) for f in self._folders(f"{table}/{depth}")}

    def runs(self, table: str) -> set[int]:
        return set(self._run_folders(table).values())

    def _drop(self, low: int, high: int) -> None:
        """Delete the runs between two numbers from every table."""
        for table in schemas.TABLES:
            for folder, run in self._run_folders(table).items():
                if low <= run <= high:
                    if table in BUCKETED:
                        name = self._bucketed(table, self.spark)
                        self.spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (run = {run})")
                    path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
                    path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def close(self, upto: int | None = None) -> int:
        """Close the batches up to ``upto`` (all but the newest); the last closed batch."""
        closed = self.closed()
        newest = max((run for table in schemas.TABLES for run in self.runs(table)), default=-1)
        upto = newest - 1 if upto is None else min(upto, newest - 1)
        if upto <= closed:
            return closed
        # What a closing that died before its mark has left would count as closed from now on.
        self._drop(closing_run(newest), closing_run(closed) - 1)
        for table in schemas.TABLES:
            rows = self.with_runs(table, closed=closed).where(F.col("run").between(closed + 1, upto))
            if table not in PARTITIONS:
                rows = rows.hint("rebalance")
            self._overwrite(table, rows.drop("run"), closing_run(upto))
        mark = self.spark.range(1).select(F.current_timestamp().alias("closed_at"), F.lit(upto).alias("batch_id"))
        mark.coalesce(1).write.mode("append").partitionBy("batch_id").parquet(self.path(MARKS))
        return upto

    def sweep(self, upto: int | None = None) -> None:
        """Delete the runs that the closings up to a batch (all) took over."""
        self._drop(0, self.closed() if upto is None else min(upto, self.closed()))
