"""Fixed schemas as DDL text: log messages, star tables, IP ranges and topic offsets.

Times are TIMESTAMP_NTZ: the UTC clock reading of the event, independent of the
session time zone.
"""

from __future__ import annotations

OPTION = "array<struct<option_id:string,option_label:string>>"

LOG_FIELDS = {
    "id": "string",
    "api_version": "string",
    "collection": "string",
    "current_url": "string",
    "device_id": "string",
    "user_id_db": "string",
    "resolution": "string",
    "email_address": "string",
    "ip": "string",
    "local_time": "string",
    "option": OPTION,
    "product_id": "string",
    "referrer_url": "string",
    "store_id": "string",
    "time_stamp": "bigint",
    "user_agent": "string",
}


def ddl(fields: dict[str, str]) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in fields.items())


LOG = ddl(LOG_FIELDS)
# What the JSON parser reads: the epoch may come as text, the e-mail under either name.
MESSAGE = ddl({**LOG_FIELDS, "time_stamp": "string", "email": "string"})

LOCATION_FIELDS = {
    "location_id": "string",
    "country_name": "string",
    "country_short": "string",
    "region_name": "string",
    "city_name": "string",
}

IP_RANGES = (
    "ip_from bigint, ip_to bigint, country_name string, country_short string, "
    "region_name string, city_name string"
)

TOPIC_OFFSETS = "topic string, partition int, end_offset bigint, committed_offset bigint"

# Star tables: business columns only; the warehouse adds batch_id and run.
TABLES: dict[str, dict[str, str]] = {
    "dim_product": {
        "product_id": "string",
        "suffix": "string",
        "product_name": "string",
        "sku": "string",
        "attribute_set_id": "int",
        "type_id": "string",
        "min_price": "decimal(18,2)",
        "max_price": "decimal(18,2)",
        "collection_id": "string",
        "product_type_value": "string",
        "product_subtype_id": "int",
        "store_code": "string",
        "gender": "string",
    },
    "dim_store": {"store_id": "string", "store_name": "string"},
    "dim_location": LOCATION_FIELDS,
    "dim_customer": {
        "customer_id": "string",
        "email_address": "string",
        "user_agent": "string",
        "user_id_db": "string",
        "resolution": "string",
    },
    "dim_date": {
        "date_id": "int",
        "full_date": "date",
        "date_of_week": "string",
        "date_of_week_short": "string",
        "is_weekday_or_weekend": "string",
        "day_of_month": "int",
        "day_of_year": "int",
        "week_of_year": "int",
        "quarter_number": "int",
        "year_number": "int",
        "year_month": "string",
    },
    "fact_product_views": {
        "fact_id": "string",
        "product_id": "string",
        "store_id": "string",
        "location_id": "string",
        "customer_id": "string",
        "date_id": "int",
        "ip_address": "string",
        "time_stamp": "timestamp_ntz",
        "collection": "string",
        "current_url": "string",
        "referrer_url": "string",
    },
    "user_log_raw": {**LOG_FIELDS, "local_time": "timestamp_ntz", "option": "string"},
    "log_rejects": {"value": "string"},
    "user_log_raw_rejects": {"value": "string"},
    "landed_counts": {"row_count": "bigint", "reject_count": "bigint"},
    # Counts of one batch's new views: see plans.partials.
    "view_partials": {
        "part": "string",
        "date_id": "int",
        "view_hour": "int",
        "product_id": "string",
        "store_id": "string",
        "country_name": "string",
        "user_agent": "string",
        "referrer_url": "string",
        "views": "bigint",
        "customer_id": "string",
    },
    "hourly_counts": {"hour_start": "timestamp_ntz", "views": "bigint"},
}

# Tables in folders by day, and the column that tells it.
DAY_TABLES = {"fact_product_views": "date_id", "view_partials": "date_id"}


def stored(table: str) -> dict[str, str]:
    """The columns of a star table as it is stored: its own, the batch and the run."""
    return {**TABLES[table], "batch_id": "bigint", "run": "bigint"}


PRIMARY_KEYS = {
    "dim_product": "product_id",
    "dim_store": "store_id",
    "dim_location": "location_id",
    "dim_customer": "customer_id",
    "dim_date": "date_id",
    "fact_product_views": "fact_id",
}

# Fact column -> dimension it refers to (the column has the dimension's key name).
FOREIGN_KEYS = {
    "product_id": "dim_product",
    "store_id": "dim_store",
    "location_id": "dim_location",
    "customer_id": "dim_customer",
    "date_id": "dim_date",
}
