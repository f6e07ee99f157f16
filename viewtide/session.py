"""Session defaults and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Keyed streaming state lives on disk, not on the executor heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.ui.enabled": "false",
}


def build_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def stateful_session(spark: SparkSession, partitions: int) -> SparkSession:
    """A session of its own for a stateful stream, with its number of state partitions.

    The number holds for the life of the checkpoint; other sessions keep theirs.
    """
    own = spark.newSession()
    for key, value in DEFAULTS.items():
        if key.startswith("spark.sql."):
            own.conf.set(key, value)
    own.conf.set("spark.sql.shuffle.partitions", str(partitions))
    return own


def scratch_root(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    A machine-local folder is used only by a local master with that setting absent.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return tempfile.gettempdir()
    raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")


def new_scratch(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; nothing is created yet."""
    return f"{scratch_root(spark)}/viewtide/{label}-{uuid.uuid4().hex}"


@contextmanager
def written(rows: DataFrame, label: str) -> Iterator[DataFrame]:
    """The rows as a table of their own in the shared folder, emptied afterwards."""
    spark = rows.sparkSession
    path = new_scratch(spark, label)
    try:
        rows.write.parquet(path)
        yield spark.read.schema(rows.schema).parquet(path)
    finally:
        spark.range(0).write.mode("overwrite").parquet(path)
