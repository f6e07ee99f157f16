"""Positions and running values inside groups, with groups of any size spread over tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from viewtide.llm.tables import written

Order = Sequence[Column | str]


def running(
    rows: DataFrame, keys: Sequence[str], order: Order, sums: Sequence[str] = (),
    xors: Sequence[str] = (),
) -> DataFrame:
    """``rows`` with ``_at``, their place (0, 1, ...) along ``order`` among equal ``keys``,
    and for each name in ``sums`` and ``xors`` (bigints) ``<name>_before``, the sum or
    exclusive-or over the rows before it.

    The rows are dealt by range over keys and order and written; each task's stretch of a
    group is numbered alone, and what the stretches before it hold is added. Only groups
    that reach over a border between two tasks have such an offset: at most two entries a
    task, so the broadcast is bounded by the number of tasks. Rows equal in keys and order
    may come in any order, but each has a place of its own. NULL keys are one group.
    """
    fields = [F.col(k).asc_nulls_first() for k in keys]
    tied = rows.withColumn("_tie", F.monotonically_increasing_id())
    dealt = written(
        tied.repartitionByRange(*fields, *order, "_tie").withColumn("_part", F.spark_partition_id()),
        "dealt",
    )
    here = Window.partitionBy("_part", *keys).orderBy(*order, "_tie")
    until = here.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    local = dealt.select(
        *dealt.columns, (F.row_number().over(here) - 1).cast("bigint").alias("_at"),
        *[F.coalesce(F.sum(c).over(until), zero).alias(f"{c}_before") for c in sums],
        *[F.coalesce(F.bit_xor(c).over(until), zero).alias(f"{c}_before") for c in xors],
    )
    key = F.struct(*(keys or [F.lit(0).alias("_all")]))
    ends = dealt.groupBy("_part").agg(F.min(key).alias("low"), F.max(key).alias("high"))
    over = (
        ends.select(F.explode(F.array_distinct(F.array("low", "high"))).alias("_key"))
        .groupBy("_key").agg(F.count("*").alias("_n")).where("_n > 1").select("_key")
    )
    stretches = (
        dealt.select(key.alias("_key"), "_part", *sums, *xors)
        .join(F.broadcast(over), "_key", "left_semi")
        .groupBy("_key", "_part")
        .agg(F.count("*").alias("_rows"), *[F.sum(c).alias(c) for c in sums],
             *[F.bit_xor(c).alias(c) for c in xors])
    )
    before = Window.partitionBy("_key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stretches.select(
        F.col("_key").alias("_of"), F.col("_part").alias("_from"),
        F.sum("_rows").over(before).alias("_skip"),
        *[F.sum(c).over(before).alias(f"_{c}") for c in sums],
        *[F.bit_xor(c).over(before).alias(f"_{c}") for c in xors],
    )
    joined = local.join(
        F.broadcast(offsets), (key == F.col("_of")) & (F.col("_part") == F.col("_from")), "left"
    )
    return joined.select(
        *rows.columns,
        (F.col("_at") + F.coalesce("_skip", zero)).alias("_at"),
        *[(F.col(f"{c}_before") + F.coalesce(f"_{c}", zero)).alias(f"{c}_before") for c in sums],
        *[F.col(f"{c}_before").bitwiseXOR(F.coalesce(f"_{c}", zero)).alias(f"{c}_before") for c in xors],
    )
