"""IP address to location: a range join turned into equi joins on address blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewtide import schemas
from viewtide.functions import keys, web
from viewtide.operators import lookup

# A stream's rows meet ranges too big to broadcast in this many places per block.
STREAM_SALTS = 16

# Block sizes as powers of two: a /24 holds 2**8 addresses, a /16 holds 2**16.
FINE_BITS = 8
WIDE_BITS = 16


def locations(ranges: DataFrame) -> DataFrame:
    """The ranges with their location packed as ``loc_info``; hashed once per range."""
    key = keys.location_key(F.col("country_name"), F.col("region_name"), F.col("city_name"))
    return ranges.withColumn("location_id", key).select(
        "ip_from", "ip_to", F.struct(*schemas.LOCATION_FIELDS).alias("loc_info")
    )


def _blocks(ranges: DataFrame, bits: int, tag: str) -> DataFrame:
    """One row per range and address block it touches, columns prefixed by ``tag``."""
    first, last = F.shiftright("ip_from", bits), F.shiftright("ip_to", bits)
    return ranges.select(
        F.explode(F.sequence(first, last)).alias(f"{tag}_block"),
        F.col("ip_from").alias(f"{tag}_from"),
        F.col("ip_to").alias(f"{tag}_to"),
        F.col("loc_info").alias(f"{tag}_loc"),
    )


class IpLocator:
    """Looks up non-overlapping inclusive IPv4 ranges.

    Ranges shorter than a /24 are filed under the one or two /24 blocks they touch, the
    others under their /16 blocks. As ranges do not overlap, a block of either kind
    holds at most 257 ranges, so an address meets a bounded number of candidates even if
    one block carries most of the traffic.
    """

    def __init__(self, ranges: DataFrame, broadcast_bytes: int = lookup.BROADCAST_BYTES):
        located = locations(ranges)
        short = (F.col("ip_to") - F.col("ip_from")) < (1 << FINE_BITS)
        self.fine = _blocks(located.where(short), FINE_BITS, "fine")
        self.wide = _blocks(located.where(~short), WIDE_BITS, "wide")
        # Measured as filed, which is what would be sent: a short range is filed twice at
        # most, the others fill 65,536 blocks in all and one more per range.
        self.filed_bytes = sum(
            lookup.measured_bytes(blocks.select(f"{tag}_block", f"{tag}_from", f"{tag}_to", f"{tag}_loc.*"))
            for tag, blocks in (("fine", self.fine), ("wide", self.wide))
        )
        self.broadcasts = self.filed_bytes <= broadcast_bytes
        if self.broadcasts:
            self.fine, self.wide = F.broadcast(self.fine), F.broadcast(self.wide)

    def _match(self, rows: DataFrame) -> DataFrame:
        """Rows having a numeric address ``_ip``, with their ``loc_info``."""
        found = rows
        for tag, bits, blocks in (
            ("fine", FINE_BITS, self.fine),
            ("wide", WIDE_BITS, self.wide),
        ):
            inside = (F.shiftright("_ip", bits) == F.col(f"{tag}_block")) & F.col("_ip").between(
                F.col(f"{tag}_from"), F.col(f"{tag}_to")
            )
            if rows.isStreaming and not self.broadcasts:
                blocks = blocks.withColumn(
                    f"{tag}_salt", F.explode(F.sequence(F.lit(0), F.lit(STREAM_SALTS - 1)))
                )
                salt = F.pmod(F.xxhash64("id", "time_stamp"), F.lit(STREAM_SALTS))
                inside = inside & (salt == F.col(f"{tag}_salt"))
            found = found.join(blocks, inside, "left")
        return found.select(*rows.columns, F.coalesce("fine_loc", "wide_loc").alias("loc_info"))

    def enrich(self, logs: DataFrame, hot_rows: int = lookup.HOT_ROWS) -> DataFrame:
        """Logs with ``loc_info``; NULL when the address is malformed or in no range.

        With ranges too big to broadcast, each distinct address is looked up once and
        the answers are joined back; that reads ``logs`` more than once, so a stream joins
        the ranges row by row instead, each block's rows spread over ``STREAM_SALTS`` keys.
        """
        numbered = logs.withColumn("_ip", web.ipv4_number(F.col("ip")))
        if self.broadcasts or logs.isStreaming:
            return self._match(numbered).drop("_ip")
        addresses = numbered.where(F.col("_ip").isNotNull()).groupBy("_ip").count()
        answers = self._match(addresses)
        hot = answers.where(F.col("count") >= hot_rows).drop("count")
        return lookup.spread_left_join(numbered, answers.drop("count"), "_ip", hot).drop("_ip")


def geo_enrich(logs: DataFrame, ranges: DataFrame) -> DataFrame:
    return IpLocator(ranges).enrich(logs)
