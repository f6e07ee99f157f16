"""The kept reports as SQL table functions, for users who only write SQL.

    table_functions.register(warehouse)
    spark.sql("SELECT * FROM top_products(DATE'2024-05-28')")
    spark.sql("SELECT * FROM stores_by_country('Chile', current_date())")

The functions are temporary and see the tables as they are when they are registered; after
further batches, register them again. Each reads the counts that batches keep, and of these
the day that it is asked for.
"""

from __future__ import annotations

from viewtide.functions import web
from viewtide.sources.warehouse import Warehouse

VIEW = "view_partials"
_DAY = "date_id = year(as_of) * 10000 + month(as_of) * 100 + day(as_of)"


def _top(key: str, part: str, limit: int | None, known: str = "true") -> str:
    last = "" if limit is None else f" LIMIT {limit}"
    return f"""SELECT {key}, sum(views) AS views FROM {VIEW}
      WHERE {_DAY} AND part = '{part}' AND {known}
      GROUP BY {key} ORDER BY views DESC, {key}{last}"""


def _hours(part: str, known: str = "true") -> str:
    """24 hours with zeros filled in, if there are any views."""
    return f"""SELECT hour AS view_hour, coalesce(counts[hour], 0L) AS views
      FROM (SELECT map_from_entries(collect_list(struct(view_hour, views))) AS counts
        FROM (SELECT view_hour, sum(views) AS views FROM {VIEW}
          WHERE {_DAY} AND part = '{part}' AND {known} GROUP BY view_hour))
      LATERAL VIEW explode(sequence(0, 23)) AS hour
      WHERE size(counts) > 0 ORDER BY view_hour"""


def _family(rules: list[tuple[str, str]]) -> str:
    cases = " ".join(f"WHEN user_agent RLIKE '{pattern}' THEN '{name}'" for pattern, name in rules)
    return f"CASE {cases} ELSE 'Other' END"


# Name: parameters, result columns, body.
FUNCTIONS = {
    "top_products": (
        "as_of DATE", "product_id STRING, views BIGINT",
        _top("product_id", "product", 10, "product_id IS NOT NULL"),
    ),
    "top_countries": ("as_of DATE", "country_name STRING, views BIGINT", _top("country_name", "place", 10)),
    "hourly_traffic": ("as_of DATE", "view_hour INT, views BIGINT", _hours("product")),
    "user_agents": ("as_of DATE", "user_agent STRING, views BIGINT", _top("user_agent", "agent", None)),
    "top_referrers": ("as_of DATE", "referrer_url STRING, views BIGINT", _top("referrer_url", "referrer", 5)),
    "stores_by_country": (
        "country STRING, as_of DATE", "store_id STRING, views BIGINT",
        _top("store_id", "place", None, "country_name = country"),
    ),
    "product_hourly": (
        "product STRING, as_of DATE", "view_hour INT, views BIGINT", _hours("product", "product_id = product"),
    ),
    "browser_os_hourly": (
        "as_of DATE", "view_hour INT, browser STRING, os STRING, views BIGINT",
        f"""SELECT view_hour, {_family(web.BROWSERS)} AS browser, {_family(web.SYSTEMS)} AS os,
          sum(views) AS views FROM {VIEW} WHERE {_DAY} AND part = 'agent'
          GROUP BY 1, 2, 3 ORDER BY 1, 2, 3""",
    ),
    "hourly_customers": (
        "as_of DATE", "view_hour INT, customers BIGINT",
        f"""SELECT view_hour, count(DISTINCT customer_id) AS customers
          FROM {VIEW} WHERE {_DAY} AND part = 'customers' GROUP BY view_hour ORDER BY view_hour""",
    ),
}


def register(warehouse: Warehouse) -> None:
    """Define the functions in the warehouse's session."""
    spark = warehouse.spark
    warehouse.table("view_partials").createOrReplaceTempView(VIEW)
    for name, (parameters, columns, body) in FUNCTIONS.items():
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS TABLE ({columns}) RETURN {body}"
        )
