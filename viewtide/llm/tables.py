"""Written intermediate tables and other helpers that the operators share."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viewtide.operators.lookup import fits_broadcast
from viewtide.session import new_scratch

# The characters that separate words wherever a contract says [^\x20\x09-\x0D]+.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder: later reads need neither its plan nor the
    executors that made it."""
    path = new_scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# A table is sent to every executor only if its rows measure at most this many bytes; as a
# hash table they take two to three times as much. Beyond it, joins shuffle.
SENT_BYTES = 96 * 1024 * 1024


def sent(df: DataFrame, more_bytes: int = 0) -> DataFrame:
    """``df`` marked for broadcast if it measures small enough, else as it is.

    ``more_bytes`` are what the measure cannot see (arrays).
    """
    small = fits_broadcast(df, SENT_BYTES - more_bytes)
    return F.broadcast(df) if small else df


def only(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """The named columns in this order; a missing one is NULL text."""
    have = set(df.columns)
    return df.select(*[
        F.col(f"`{n}`") if n in have else F.lit(None).cast("string").alias(n) for n in names
    ])


def crc_of_id(name: str = "doc_id") -> Column:
    """crc32 of the id written as decimal text."""
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary"))
