"""The reports over the star tables.

Each takes a ``Warehouse`` and the day to report on (today when None). The day becomes a
literal date key, so the scan of the fact reads that day's partitions only. Counts are
taken per key before any join to a dimension: a busy key is one row by then.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewtide import schemas
from viewtide.functions import web
from viewtide.sources.warehouse import Warehouse

Day = dt.date | str | None


def query(
    warehouse: Warehouse, sql: str, params: Mapping[str, object] | None = None
) -> DataFrame:
    """Run SQL text over the star tables by name, with ``:name`` parameters."""
    for name in schemas.PRIMARY_KEYS:
        warehouse.table(name).createOrReplaceTempView(name)
    return warehouse.spark.sql(sql, args=dict(params or {}))


def day_of(warehouse: Warehouse, as_of: Day) -> dt.date:
    if as_of is None:
        return warehouse.spark.range(1).select(F.current_date()).first()[0]
    return as_of if isinstance(as_of, dt.date) else dt.date.fromisoformat(as_of)


def key_of(day: dt.date) -> int:
    return day.year * 10_000 + day.month * 100 + day.day


def views_of_day(warehouse: Warehouse, as_of: Day = None) -> DataFrame:
    """Fact rows of one day that is in the date dimension; only its folders are opened."""
    day = day_of(warehouse, as_of)
    key = key_of(day)
    views = warehouse.table("fact_product_views", [key]).where(F.col("date_id") == key)
    # date_id is the dimension's primary key: this side has one row at most.
    known = warehouse.table("dim_date").where(
        (F.col("full_date") == F.lit(day)) & (F.col("date_id") == key)
    )
    return views.join(F.broadcast(known.select("date_id")), "date_id", "left_semi")


def _count(rows: DataFrame, *by: str) -> DataFrame:
    return rows.groupBy(*by).agg(F.count("*").alias("views"))


def ranked(counts: DataFrame, *ties: str) -> DataFrame:
    return counts.orderBy(F.desc("views"), *ties)


def _through(counts: DataFrame, dimension: DataFrame, key: str, *labels: str) -> DataFrame:
    """Counts per key as counts per attribute of the key's dimension."""
    joined = counts.join(dimension.select(key, *labels), key)
    others = [c for c in counts.columns if c not in (key, "views")]
    return joined.groupBy(*others, *labels).agg(F.sum("views").alias("views"))


def _by_hour(views: DataFrame) -> DataFrame:
    return hours_filled(_count(views.select(F.hour("time_stamp").alias("view_hour")), "view_hour"))


def hours_filled(counts: DataFrame) -> DataFrame:
    """Counts (view_hour, views) for each of the 24 hours, zeros filled in; no rows when there
    are no views."""
    # Grouped by hour of day, the counts have 24 rows at most.
    found = counts.agg(F.map_from_entries(F.collect_list(F.struct("view_hour", "views"))).alias("_of"))
    hours = found.where(F.size("_of") > 0).select(
        "_of", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("view_hour")
    )
    views = F.coalesce(F.try_element_at("_of", F.col("view_hour")), F.lit(0).cast("bigint"))
    return hours.select("view_hour", views.alias("views")).orderBy("view_hour")


def top_products(warehouse: Warehouse, as_of: Day = None, limit: int = 10) -> DataFrame:
    views = views_of_day(warehouse, as_of).where(F.col("product_id").isNotNull())
    return ranked(_count(views, "product_id"), "product_id").limit(limit)


def top_countries(warehouse: Warehouse, as_of: Day = None, limit: int = 10) -> DataFrame:
    places = _count(views_of_day(warehouse, as_of), "location_id")
    countries = _through(places, warehouse.table("dim_location"), "location_id", "country_name")
    return ranked(countries, "country_name").limit(limit)


def hourly_traffic(warehouse: Warehouse, as_of: Day = None) -> DataFrame:
    return _by_hour(views_of_day(warehouse, as_of))


def user_agents(warehouse: Warehouse, as_of: Day = None) -> DataFrame:
    customers = _count(views_of_day(warehouse, as_of), "customer_id")
    agents = _through(customers, warehouse.table("dim_customer"), "customer_id", "user_agent")
    return ranked(agents, "user_agent")


def top_referrers(warehouse: Warehouse, as_of: Day = None, limit: int = 5) -> DataFrame:
    counts = _count(views_of_day(warehouse, as_of), "referrer_url")
    return ranked(counts, "referrer_url").limit(limit)


def stores_by_country(warehouse: Warehouse, country: str, as_of: Day = None) -> DataFrame:
    places = warehouse.table("dim_location").where(F.col("country_name") == country)
    counts = _count(views_of_day(warehouse, as_of), "store_id", "location_id")
    stores = _through(counts, places, "location_id", "country_name")
    return ranked(stores.select("store_id", "views"), "store_id")


def product_hourly(warehouse: Warehouse, product_id: str, as_of: Day = None) -> DataFrame:
    return _by_hour(views_of_day(warehouse, as_of).where(F.col("product_id") == product_id))


def browser_os_hourly(warehouse: Warehouse, as_of: Day = None) -> DataFrame:
    """Views per hour, browser family and operating system family."""
    views = views_of_day(warehouse, as_of).withColumn("view_hour", F.hour("time_stamp"))
    customers = _count(views, "view_hour", "customer_id")
    agents = _through(customers, warehouse.table("dim_customer"), "customer_id", "user_agent")
    return by_family(agents)


def by_family(agents: DataFrame) -> DataFrame:
    """Counts (view_hour, user_agent, views) per browser and operating system family."""
    families = agents.select(
        "view_hour",
        web.browser_family(F.col("user_agent")).alias("browser"),
        web.os_family(F.col("user_agent")).alias("os"),
        "views",
    )
    counts = families.groupBy("view_hour", "browser", "os").agg(F.sum("views").alias("views"))
    return counts.orderBy("view_hour", "browser", "os")


def calendar_views(warehouse: Warehouse, chosen: Column, *by: str) -> DataFrame:
    """Views of the days whose calendar attributes meet a condition, such as the weekends of a
    quarter, per columns of the fact and of the date dimension.

    The days are found at run time and prune the fact's folders before they are read. There
    is one row a day to send, so the calendar bounds the broadcast.
    """
    dates = warehouse.table("dim_date")
    days = dates.where(chosen).select("date_id", *[n for n in by if n in dates.columns and n != "date_id"])
    views = warehouse.table("fact_product_views")
    labels = [n for n in by if n in views.columns and n != "date_id"]
    return _count(views.select("date_id", *labels).join(F.broadcast(days), "date_id"), *by)


def domain_log_type_counts(logs: DataFrame) -> DataFrame:
    """Log records per host of the visited URL and log type."""
    typed = logs.select(web.url_host(F.col("current_url")).alias("host"), "collection")
    return _count(typed, "host", "collection")
