"""Ranges of addresses that overlap or leave gaps.

``geo.IpLocator`` takes ranges that do not overlap; ``audit`` says where a table breaks that.
It compares a range with what began before it. Ranges are dealt into blocks of ``2**BITS``
addresses by where they begin; a block needs no more of the blocks before it than how far
their ranges reach, one row per block, at most 65,536 of the whole address space.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BITS = 16

def _block(address: Column) -> Column:
    return F.shiftright(address, BITS)


def _reach(ranges: DataFrame) -> DataFrame:
    """Ranges with ``_end``: how far the ranges reach that begin before them (in order of
    beginning and end), -1 before the first."""
    placed = ranges.withColumn("_block", _block(F.col("ip_from")))
    blocks = placed.groupBy("_block").agg(F.max("ip_to").alias("_most"))
    earlier = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    # One row per block of the address space: 65,536 at most, whatever the table holds.
    carried = blocks.select("_block", F.max("_most").over(earlier).alias("_carried"))
    inside = Window.partitionBy("_block").orderBy("ip_from", "ip_to").rowsBetween(
        Window.unboundedPreceding, -1
    )
    joined = placed.withColumn("_before", F.max("ip_to").over(inside)).join(F.broadcast(carried), "_block")
    end = F.coalesce(F.greatest("_before", "_carried"), F.lit(-1).cast("bigint"))
    return joined.withColumn("_end", end).drop("_block", "_before", "_carried")


def audit(ranges: DataFrame) -> DataFrame:
    """kind, ip_from, ip_to: ``inverted`` ranges, stretches that a range shares with earlier
    ones (``overlap``), and stretches between the first and last address that no range has
    (``gap``). A range that repeats another overlaps it whole."""
    bounds = ranges.select("ip_from", "ip_to")
    inverted = bounds.where("ip_from > ip_to").select(F.lit("inverted").alias("kind"), "ip_from", "ip_to")
    reached = _reach(bounds.where("ip_from <= ip_to"))
    overlaps = reached.where("ip_from <= _end").select(
        F.lit("overlap").alias("kind"), "ip_from", F.least("ip_to", "_end").alias("ip_to")
    )
    gaps = reached.where("ip_from > _end + 1 AND _end >= 0").select(
        F.lit("gap").alias("kind"), (F.col("_end") + 1).alias("ip_from"), (F.col("ip_from") - 1).alias("ip_to")
    )
    return inverted.unionByName(overlaps).unionByName(gaps)
