"""Left joins against a keyed table that hold when one key has most of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A table is broadcast only when its measured size is at most this many bytes.
BROADCAST_BYTES = 256 * 1024 * 1024
# A key is hot from this many rows on; there are at most rows / HOT_ROWS such keys.
HOT_ROWS = 1_000_000
ROW_OVERHEAD = 32
SPREAD = 4096


def measured_bytes(table: DataFrame) -> int:
    """Size of the rows in memory, measured by one distributed aggregation."""
    width = F.lit(ROW_OVERHEAD + 8 * len(table.columns)).cast("bigint")
    for field in table.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(field.name), F.lit(0))
    return table.agg(F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()["bytes"]


def fits_broadcast(table: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    return measured_bytes(table) <= limit


def hot_entries(
    left: DataFrame, right: DataFrame, key: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """For each key with ``hot_rows`` rows or more in ``left``: its entry of ``right``.

    The rows are counted per key first; at most rows / ``hot_rows`` entries are left.
    """
    counts = left.where(F.col(key).isNotNull()).groupBy(key).count()
    hot_keys = counts.where(F.col("count") >= hot_rows).select(key)
    found = right.join(F.broadcast(hot_keys), key, "left_semi")
    return hot_keys.join(F.broadcast(found), key, "left")


def _slot(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(SPREAD))


def spread_left_join(
    left: DataFrame, right: DataFrame, key: str, hot: DataFrame
) -> DataFrame:
    """``left`` left-joined to ``right`` (unique on ``key``) through a shuffle, skew-proof.

    Rows of hot keys take their match from the broadcast of ``hot`` (see
    ``hot_entries``); only the others are matched in the shuffled join. Hot and NULL keys
    match nothing there and are spread by their map partition, which a retried task
    reproduces.
    """
    values = [c for c in right.columns if c != key]
    hot = hot.select(F.col(key).alias("_hot_key"), F.struct(*values).alias("_hot"))
    cold = right.select(
        F.col(key).alias("_cold_key"),
        _slot(F.col(key)).alias("_cold_slot"),
        F.struct(*values).alias("_cold"),
    )
    routed = left.join(F.broadcast(hot), F.col(key) == F.col("_hot_key"), "left")
    routed = routed.withColumn("_key", F.when(F.col("_hot_key").isNull(), F.col(key)))
    anywhere = F.pmod(F.spark_partition_id(), F.lit(SPREAD)).cast("bigint")
    routed = routed.withColumn(
        "_slot", F.when(F.col("_key").isNull(), anywhere).otherwise(_slot(F.col("_key")))
    )
    joined = routed.join(
        cold,
        (F.col("_key") == F.col("_cold_key")) & (F.col("_slot") == F.col("_cold_slot")),
        "left",
    )
    chosen = [F.coalesce(F.col(f"_hot.{v}"), F.col(f"_cold.{v}")).alias(v) for v in values]
    return joined.select(*[F.col(c) for c in left.columns], *chosen)


def lookup(
    left: DataFrame,
    right: DataFrame,
    key: str,
    limit: int = BROADCAST_BYTES,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Left join to a table unique on ``key``: broadcast when it fits, else spread.

    ``counted`` holds the same keys as ``left`` and is cheaper to read: in a chain of
    lookups, the rows before the first of them.
    """
    if fits_broadcast(right, limit):
        return left.join(F.broadcast(right), key, "left").select(
            *left.columns, *[c for c in right.columns if c != key]
        )
    hot = hot_entries(left if counted is None else counted, right, key)
    return spread_left_join(left, right, key, hot)
