"""IP range tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from viewtide import schemas

# Column order of the common comma-separated form of such tables.
CSV_ORDER = (
    "ip_from bigint, ip_to bigint, country_short string, country_name string, "
    "region_name string, city_name string"
)


def read_ip_ranges(spark: SparkSession, path: str) -> DataFrame:
    """Ranges from parquet, or from CSV when the path ends in ``.csv``."""
    if path.endswith(".csv"):
        rows = spark.read.schema(CSV_ORDER).option("header", "false").csv(path)
        return rows.select(
            "ip_from", "ip_to", "country_name", "country_short", "region_name", "city_name"
        )
    return spark.read.schema(schemas.IP_RANGES).parquet(path)
