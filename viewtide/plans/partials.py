"""The reports kept up to date by every batch, so that a refresh reads no views.

When a batch has written its new facts, it counts them by what the reports group by and
writes these counts beside them, under its own run: a repeated batch replaces its counts,
and since a fact is new in one batch only, the sums over all batches are those of the
fact. Attributes of customers and places are taken when they are counted; a dimension row
never changes. Distinct customers do not add up, so each hour keeps its customers themselves,
a row for each, and the reports count them exactly.

A day's counts lie in that day's folder; ``part`` tells which grouping a row belongs to.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewtide.plans import reports
from viewtide.plans.reports import Day
from viewtide.session import written
from viewtide.sources.warehouse import Warehouse

LABELS = ["view_hour", "product_id", "store_id", "country_name", "user_agent", "referrer_url"]


def _filed(part: str, counts: DataFrame) -> DataFrame:
    """Counts of one grouping as rows of the common table."""
    have = set(counts.columns)
    labels = [F.col(n) if n in have else F.lit(None).alias(n) for n in LABELS]
    customer = F.col("customer_id") if part == "customers" else F.lit(None).cast("string").alias("customer_id")
    return counts.select(F.lit(part).alias("part"), "date_id", *labels, "views", customer)


def counts_per_key(facts: DataFrame) -> DataFrame:
    """Dated views (of one batch) counted by all keys of the reports at once, combined before
    the shuffle.

    Written, this is one pass over the views. Read as it is, a filter on one of the groupings
    goes below the count, and each of them makes a pass of its own.
    """
    dated = facts.where(F.col("date_id").isNotNull()).withColumn("view_hour", F.hour("time_stamp"))
    return dated.sparkSession.sql(
        """SELECT date_id, view_hour, product_id, store_id, location_id, customer_id, referrer_url,
          count(*) AS views,
          grouping(product_id) AS no_product, grouping(location_id) AS no_place,
          grouping(customer_id) AS no_customer, grouping(referrer_url) AS no_referrer
        FROM {views} GROUP BY GROUPING SETS (
          (date_id, view_hour, product_id), (date_id, store_id, location_id),
          (date_id, view_hour, customer_id), (date_id, referrer_url))""",
        views=dated,
    )


def partial_rows(keyed: DataFrame, places: DataFrame, customers: DataFrame) -> DataFrame:
    """The rows to keep of ``counts_per_key``: by hour and product, by store and country, by
    hour and user agent, by referrer, and by hour and customer.

    The dimensions meet counts per key.
    """

    def of(flag: str) -> DataFrame:
        return keyed.where(F.col(flag) == 0)

    def summed(rows: DataFrame, *by: str) -> DataFrame:
        return rows.groupBy("date_id", *by).agg(F.sum("views").alias("views"))

    located = of("no_place").where("location_id IS NOT NULL").join(
        places.select("location_id", "country_name"), "location_id"
    )
    known = of("no_customer").where("customer_id IS NOT NULL").join(
        customers.select("customer_id", "user_agent"), "customer_id"
    )
    filed = [
        _filed("product", of("no_product").drop("store_id", "referrer_url")),
        _filed("place", summed(located, "store_id", "country_name")),
        _filed("agent", summed(known, "view_hour", "user_agent")),
        _filed("referrer", of("no_referrer").drop("view_hour", "product_id", "store_id")),
        _filed("customers", of("no_customer").drop("product_id", "store_id", "referrer_url")),
    ]
    rows = filed[0]
    for more in filed[1:]:
        rows = rows.unionByName(more)
    return rows


def write_partials(warehouse: Warehouse, batch_id: int, days: Collection[int | None]) -> None:
    """Count what a batch has just written; its own files are all that is read of the fact."""
    dated = [day for day in days if day is not None]
    own = warehouse.with_runs("fact_product_views", dated).where(F.col("run") == batch_id)
    with written(counts_per_key(own), "counts") as keyed:
        rows = partial_rows(keyed, warehouse.table("dim_location"), warehouse.table("dim_customer"))
        warehouse.write_batch("view_partials", rows, batch_id)


# -- reports -----------------------------------------------------------------------------


def counts_of_day(warehouse: Warehouse, part: str, as_of: Day = None) -> DataFrame:
    """The counts of one grouping on one day, not yet summed over batches."""
    key = reports.key_of(reports.day_of(warehouse, as_of))
    rows = warehouse.table("view_partials", [key])
    return rows.where((F.col("date_id") == key) & (F.col("part") == part))


def _summed(rows: DataFrame, *by: str) -> DataFrame:
    return rows.groupBy(*by).agg(F.sum("views").alias("views"))


def top_products(warehouse: Warehouse, as_of: Day = None, limit: int = 10) -> DataFrame:
    counts = counts_of_day(warehouse, "product", as_of).where(F.col("product_id").isNotNull())
    return reports.ranked(_summed(counts, "product_id"), "product_id").limit(limit)


def top_countries(warehouse: Warehouse, as_of: Day = None, limit: int = 10) -> DataFrame:
    counts = _summed(counts_of_day(warehouse, "place", as_of), "country_name")
    return reports.ranked(counts, "country_name").limit(limit)


def hourly_traffic(warehouse: Warehouse, as_of: Day = None) -> DataFrame:
    # Any grouping by hour has all views; there are fewer products than customers.
    return reports.hours_filled(_summed(counts_of_day(warehouse, "product", as_of), "view_hour"))


def user_agents(warehouse: Warehouse, as_of: Day = None) -> DataFrame:
    return reports.ranked(_summed(counts_of_day(warehouse, "agent", as_of), "user_agent"), "user_agent")


def top_referrers(warehouse: Warehouse, as_of: Day = None, limit: int = 5) -> DataFrame:
    counts = _summed(counts_of_day(warehouse, "referrer", as_of), "referrer_url")
    return reports.ranked(counts, "referrer_url").limit(limit)


def stores_by_country(warehouse: Warehouse, country: str, as_of: Day = None) -> DataFrame:
    counts = counts_of_day(warehouse, "place", as_of).where(F.col("country_name") == country)
    return reports.ranked(_summed(counts, "store_id"), "store_id")


def product_hourly(warehouse: Warehouse, product_id: str, as_of: Day = None) -> DataFrame:
    counts = counts_of_day(warehouse, "product", as_of).where(F.col("product_id") == product_id)
    return reports.hours_filled(_summed(counts, "view_hour"))


def browser_os_hourly(warehouse: Warehouse, as_of: Day = None) -> DataFrame:
    return reports.by_family(_summed(counts_of_day(warehouse, "agent", as_of), "view_hour", "user_agent"))


def distinct_customers() -> Column:
    """An aggregate over partials: how many customers they hold together, views without one
    left out."""
    return F.count_distinct("customer_id").alias("customers")


def hourly_customers(warehouse: Warehouse, as_of: Day = None) -> DataFrame:
    """Distinct customers of each hour of a day that has views, merged from all batches."""
    counts = counts_of_day(warehouse, "customers", as_of)
    return counts.groupBy("view_hour").agg(distinct_customers()).orderBy("view_hour")


def daily_customers(warehouse: Warehouse) -> DataFrame:
    """Distinct customers per day over the whole history."""
    counts = warehouse.table("view_partials").where(F.col("part") == "customers")
    return counts.groupBy("date_id").agg(distinct_customers())


def all_counts(warehouse: Warehouse) -> DataFrame:
    """The whole of the kept counts, summed over batches."""
    rows = warehouse.table("view_partials")
    return rows.groupBy("part", "date_id", *LABELS).agg(F.sum("views").alias("views"))
