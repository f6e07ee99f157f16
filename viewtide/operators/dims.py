"""Dimension rows of a set of logs: one row per key, the first seen.

"First" is the smallest (event time, id), with the attributes as tie-break; undated rows
(no epoch or a zero one) come after all others. Taking the
minimum of one struct combines on the map side, so a key with most of the rows reaches
its reducer as one row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewtide import schemas
from viewtide.functions import dates, keys


def _typed(rows: DataFrame, table: str) -> DataFrame:
    """Columns of the table in order and type; columns never written are NULL."""
    present = set(rows.columns)
    return rows.select(
        *[
            (F.col(name) if name in present else F.lit(None)).cast(kind).alias(name)
            for name, kind in schemas.TABLES[table].items()
        ]
    )


def _first(rows: DataFrame, key: str, attributes: list[str]) -> DataFrame:
    at = dates.dated_time(F.col("time_stamp"))
    order = F.struct(at.isNull().alias("_undated"), at.alias("_at"), "id", *attributes)
    first = rows.groupBy(key).agg(F.min(order).alias("_first"))
    return first.select(key, *[F.col(f"_first.{name}") for name in attributes])


def dim_product(logs: DataFrame) -> DataFrame:
    ids = logs.select(keys.filled(F.col("product_id")).alias("product_id"))
    return _typed(ids.where(F.col("product_id").isNotNull()).distinct(), "dim_product")


def dim_store(logs: DataFrame) -> DataFrame:
    ids = logs.select(keys.filled(F.col("store_id")).alias("store_id"))
    stores = ids.where(F.col("store_id").isNotNull()).distinct()
    return _typed(stores.withColumn("store_name", keys.store_name(F.col("store_id"))), "dim_store")


def dim_location(located: DataFrame) -> DataFrame:
    attributes = [name for name in schemas.LOCATION_FIELDS if name != "location_id"]
    rows = located.select("time_stamp", "id", "loc_info.*")
    rows = rows.where(F.col("location_id").isNotNull())
    return _typed(_first(rows, "location_id", attributes), "dim_location")


def _any_filled(columns: list[str]) -> Column:
    return F.coalesce(*[keys.filled(F.col(name)) for name in columns]).isNotNull()


def dim_customer(logs: DataFrame) -> DataFrame:
    """One customer per device; views without a device share one row."""
    attributes = ["email_address", "user_agent", "user_id_db", "resolution"]
    rows = logs.where(_any_filled(["device_id", *attributes])).select(
        keys.customer_key(F.col("device_id")).alias("customer_id"),
        "time_stamp",
        "id",
        *attributes,
    )
    first = _first(rows, "customer_id", attributes)
    return _typed(
        first.withColumns({name: keys.defined(F.col(name)) for name in attributes}),
        "dim_customer",
    )


def dim_date(logs: DataFrame) -> DataFrame:
    days = logs.select(dates.view_date(F.col("time_stamp")).alias("day"))
    days = days.where(F.col("day").isNotNull()).distinct()
    columns = dates.calendar(F.col("day"))
    return _typed(days.select(*[c.alias(n) for n, c in columns.items()]), "dim_date")


BUILDERS = {
    "dim_product": dim_product,
    "dim_store": dim_store,
    "dim_location": dim_location,
    "dim_customer": dim_customer,
    "dim_date": dim_date,
}
