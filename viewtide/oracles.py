"""The registered queries as plain SQL for an independent engine."""

from __future__ import annotations

from viewtide.registry import AS_OF, COUNTRY, PRODUCT
from viewtide.sources.clickstream import MALFORMED_EVERY, REPLAY_EVERY, USER_AGENTS

_AGENT = " ".join(
    f"WHEN {number} THEN '{agent}'" for number, agent in enumerate(USER_AGENTS)
)

_COMMON = f"""
WITH numbers AS (SELECT *, (SELECT count(*) FROM pages) AS pages FROM events),
base AS (
  SELECT cast(e.event_id AS varchar) AS id, '1.0' AS api_version, e.event_type AS collection,
    p.url AS current_url,
    CASE WHEN e.event_id % 19 = 0 THEN '' WHEN e.event_id % 17 = 0 THEN NULL
      ELSE concat('dev-', cast(e.user_id AS varchar)) END AS device_id,
    CASE WHEN e.event_id % 5 = 0 THEN '  ' ELSE cast(e.user_id AS varchar) END AS user_id_db,
    CASE e.event_id % 3 WHEN 0 THEN '1920x1080' WHEN 1 THEN '390x844' END AS resolution,
    CASE WHEN e.event_id % 4 = 0 THEN '' WHEN e.event_id % 47 = 0 THEN concat(chr(9), ' ')
      ELSE concat('u', cast(e.user_id AS varchar), '@example.org') END AS email_address,
    CASE WHEN e.event_id % 59 = 0 THEN '300.1.1.1' WHEN e.event_id % 61 = 0 THEN '190.x.1.2'
      WHEN e.event_id % 29 = 0 THEN NULL
      ELSE concat('10.', cast(e.user_id % 30 AS varchar), '.',
        cast(e.event_id % 256 AS varchar), '.1') END AS ip,
    CASE WHEN e.event_id % 53 = 0 THEN '28/05/2024'
      ELSE strftime(e.ts, '%Y-%m-%d %H:%M:%S') END AS local_time,
    CASE WHEN e.event_id % 7 = 0 THEN NULL
      ELSE [{{'option_id': cast(e.event_id % 7 AS varchar), 'option_label': 'diamond'}}]
        || CASE WHEN e.event_id % 8 = 0
          THEN [{{'option_id': cast(e.event_id % 3 AS varchar), 'option_label': 'ruby'}}]
          ELSE [] END
      END AS "option",
    CASE WHEN e.event_id % 31 = 0 THEN '' WHEN e.event_id % 23 = 0 THEN NULL
      ELSE regexp_extract(e.props, '([0-9]+)', 1) END AS product_id,
    r.url AS referrer_url, cast(e.user_id % 10 AS varchar) AS store_id,
    CASE WHEN e.event_id % 37 = 0 THEN 0 WHEN e.event_id % 41 = 0 THEN NULL
      WHEN e.event_id % 13 = 0 THEN epoch_us(e.ts) // 1000000 * 1000
      ELSE epoch_us(e.ts) // 1000000 END AS time_stamp,
    CASE e.event_id % 6 {_AGENT} END AS user_agent,
    CASE WHEN e.ts < TIMESTAMP '{AS_OF}' THEN 0 ELSE 1 END AS part
  FROM numbers e
  LEFT JOIN pages p ON p.page_id = e.event_id % e.pages
  LEFT JOIN pages r ON r.page_id = (e.event_id * 3) % e.pages),
logs AS (
  SELECT * FROM base
  UNION ALL SELECT * REPLACE (2 AS part) FROM base WHERE cast(id AS bigint) % {REPLAY_EVERY} = 0),
malformed AS (
  SELECT CASE (event_id // {MALFORMED_EVERY}) % 5
    WHEN 0 THEN concat('{{"id":"', cast(event_id AS varchar), '"')
    WHEN 1 THEN concat('not json ', cast(event_id AS varchar))
    WHEN 2 THEN concat('[{{"id":"', cast(event_id AS varchar), '"}},{{"id":"x"}}]')
    WHEN 3 THEN '' ELSE 'null' END AS value
  FROM events WHERE event_id % {MALFORMED_EVERY} = 0),
ranges AS (
  SELECT (10 * 256 + n_nationkey)::bigint * 65536 AS ip_from,
    (10 * 256 + n_nationkey)::bigint * 65536 + 65535 AS ip_to,
    n_name AS country_name, substr(n_name, 1, 2) AS country_short, r_name AS region_name,
    cast(NULL AS varchar) AS city_name
  FROM nation JOIN region ON n_regionkey = r_regionkey),
numbered AS (
  SELECT *, list_reduce(
      list_transform(string_split(ip, '.'), lambda x: try_cast(x AS bigint)),
      lambda a, x: a * 256 + x) AS ip_number,
    CASE WHEN time_stamp > 9999999999 THEN make_timestamp(time_stamp * 1000)
      ELSE make_timestamp(time_stamp * 1000000) END AS viewed
  FROM logs),
located AS (
  SELECT n.*, g.country_name, g.country_short, g.region_name, g.city_name,
    CASE WHEN g.ip_from IS NOT NULL THEN md5(concat(coalesce(g.country_name, ''), '|',
      coalesce(g.region_name, ''), '|', coalesce(g.city_name, ''))) END AS location_id
  FROM numbered n LEFT JOIN ranges g ON n.ip_number BETWEEN g.ip_from AND g.ip_to),
keyed AS (
  SELECT nullif(product_id, '') AS product_id, nullif(store_id, '') AS store_id, location_id,
    nullif(device_id, '') AS customer_id,
    CASE WHEN time_stamp <> 0 THEN cast(strftime(viewed, '%Y%m%d') AS int) END AS date_id,
    ip AS ip_address, viewed AS time_stamp, collection, current_url, referrer_url,
    id AS log_id, time_stamp AS epoch, part
  FROM located),
hashed AS (
  SELECT *, sha256(concat_ws('_', coalesce(product_id, 'NA'), coalesce(store_id, 'NA'),
    coalesce(location_id, 'NA'), coalesce(customer_id, 'NA'),
    coalesce(cast(date_id AS varchar), 'NA'), cast(epoch AS varchar))) AS fact_id
  FROM keyed),
fact AS (
  SELECT fact_id, product_id, store_id, location_id, customer_id, date_id, ip_address,
    time_stamp, collection, current_url, referrer_url
  FROM hashed
  QUALIFY row_number() OVER (PARTITION BY fact_id ORDER BY time_stamp, log_id, part) = 1),
fact_batches AS (
  SELECT fact_id, product_id, store_id, location_id, customer_id, date_id, ip_address,
    time_stamp, collection, current_url, referrer_url, least(part, 1) AS batch
  FROM hashed
  QUALIFY row_number() OVER (PARTITION BY fact_id ORDER BY least(part, 1), log_id, part) = 1),
customers AS (
  SELECT coalesce(nullif(device_id, ''), '-1') AS customer_id, email_address, user_agent,
    user_id_db, resolution, CASE WHEN time_stamp <> 0 THEN viewed END AS viewed, id, part
  FROM located
  WHERE coalesce(nullif(user_agent, ''), nullif(device_id, ''), nullif(email_address, ''),
    nullif(user_id_db, ''), nullif(resolution, '')) IS NOT NULL),
customer_rows AS (
  SELECT customer_id,
    CASE WHEN regexp_matches(email_address, '\\S') THEN email_address
      ELSE 'Not Defined' END AS email_address,
    CASE WHEN regexp_matches(user_agent, '\\S') THEN user_agent
      ELSE 'Not Defined' END AS user_agent,
    CASE WHEN regexp_matches(user_id_db, '\\S') THEN user_id_db
      ELSE 'Not Defined' END AS user_id_db,
    CASE WHEN regexp_matches(resolution, '\\S') THEN resolution
      ELSE 'Not Defined' END AS resolution,
    viewed, id, part
  FROM customers),
dim_customer AS (
  SELECT * EXCLUDE (viewed, id) FROM customer_rows
  QUALIFY row_number() OVER (
    PARTITION BY customer_id ORDER BY viewed NULLS LAST, id, part) = 1),
customer_batches AS (
  SELECT * EXCLUDE (viewed, id, part), least(part, 1) AS batch FROM customer_rows
  QUALIFY row_number() OVER (
    PARTITION BY customer_id ORDER BY least(part, 1), viewed NULLS LAST, id, part) = 1),
dim_location AS (
  SELECT location_id, country_name, country_short, region_name, city_name
  FROM located WHERE location_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY location_id ORDER BY viewed, id, part) = 1),
days AS (
  SELECT DISTINCT cast(viewed AS date) AS day FROM numbered
  WHERE time_stamp IS NOT NULL AND time_stamp <> 0),
dim_date AS (
  SELECT cast(strftime(day, '%Y%m%d') AS int) AS date_id, day AS full_date,
    dayname(day) AS date_of_week, strftime(day, '%a') AS date_of_week_short,
    CASE WHEN isodow(day) >= 6 THEN 'weekend' ELSE 'weekday' END AS is_weekday_or_weekend,
    cast(day(day) AS int) AS day_of_month, cast(dayofyear(day) AS int) AS day_of_year,
    cast(week(day) AS int) AS week_of_year, cast(quarter(day) AS int) AS quarter_number,
    cast(year(day) AS int) AS year_number, strftime(day, '%Y%m') AS year_month
  FROM days),
today AS (
  SELECT f.*, cast(hour(f.time_stamp) AS int) AS view_hour
  FROM fact f JOIN dim_date d ON f.date_id = d.date_id
  WHERE d.full_date = DATE '{AS_OF}'),
offsets AS (
  SELECT event_type AS topic, cast(event_id % 5 AS int) AS partition, count(*) AS end_offset,
    CASE WHEN event_id % 5 < 4
      THEN count(*) FILTER (WHERE ts < TIMESTAMP '{AS_OF}') END AS committed_offset
  FROM events GROUP BY event_type, event_id % 5)
"""

_LOG = """id, api_version, collection, current_url, device_id, user_id_db, resolution,
  email_address, ip, {local_time} AS local_time, {option} product_id, referrer_url, store_id,
  time_stamp, user_agent"""
_OPTION = 'cast(to_json("option") AS varchar) AS "option",'
_LANDED = _LOG.format(
    local_time="try_cast(local_time AS timestamp)", option=_OPTION
)

_RANKED = "SELECT {key}, count(*) AS views FROM {rows} GROUP BY {key} ORDER BY views DESC, {key}"

_HOURS = """, counts AS (SELECT view_hour, count(*) AS views FROM today {where} GROUP BY view_hour)
SELECT cast(h.range AS int) AS view_hour, coalesce(c.views, 0) AS views
FROM range(24) h LEFT JOIN counts c ON c.view_hour = h.range
WHERE EXISTS (SELECT 1 FROM counts)"""

_FACT_BATCHES = "SELECT * EXCLUDE (batch), cast(batch AS {kind}) AS batch_id FROM fact_batches"

# A message's text: fields in their order without NULL ones, compact.
_FIELDS = [
    "id", "api_version", "collection", "current_url", "device_id", "user_id_db", "resolution",
    "email_address", "ip", "local_time", "option", "product_id", "referrer_url", "store_id",
    "time_stamp", "user_agent",
]


def _json(epoch: str, email: str, more: str = "") -> str:
    values = ", ".join(
        f"""'{email if n == "email_address" else n}': {epoch if n == "time_stamp" else f'"{n}"'}"""
        for n in _FIELDS
    )
    return f"cast(json_merge_patch('{{{{}}}}', to_json({{{{{values}{more}}}}})) AS varchar)"


_RELAYED = f"""SELECT CASE WHEN cast(id AS bigint) % 43 = 0
    THEN {_json("cast(time_stamp AS varchar)", "email_address")}
  WHEN cast(id AS bigint) % 67 = 0 AND cast(id AS bigint) % 13 <> 0
    THEN {_json("strftime(make_timestamp(time_stamp * 1000000), '%Y-%m-%dT%H:%M:%SZ')", "email_address")}
  WHEN cast(id AS bigint) % 71 = 0 THEN {_json("time_stamp", "email_address", ", 'campaign': 'spring'")}
  WHEN cast(id AS bigint) % 3 = 1 THEN {_json("time_stamp", "email")}
  ELSE {_json("time_stamp", "email_address")} END AS value
FROM logs UNION ALL SELECT value FROM malformed""".replace("{{", "{").replace("}}", "}")

_EARLY = {
    "product_id": "SELECT product_id FROM hashed WHERE part = 0",
    "store_id": "SELECT store_id FROM hashed WHERE part = 0",
    "location_id": "SELECT location_id FROM hashed WHERE part = 0",
    "customer_id": "SELECT customer_id FROM customers WHERE part = 0",
    "date_id": "SELECT date_id FROM hashed WHERE part = 0",
}

_BROWSER = """CASE WHEN regexp_matches(c.user_agent, 'Edg/') THEN 'Edge'
  WHEN regexp_matches(c.user_agent, 'Firefox/') THEN 'Firefox'
  WHEN regexp_matches(c.user_agent, 'Chrome/') THEN 'Chrome'
  WHEN regexp_matches(c.user_agent, 'Safari/') THEN 'Safari' ELSE 'Other' END"""
_SYSTEM = """CASE WHEN regexp_matches(c.user_agent, 'Windows NT') THEN 'Windows'
  WHEN regexp_matches(c.user_agent, 'iPhone|iPad') THEN 'iOS'
  WHEN regexp_matches(c.user_agent, 'Android') THEN 'Android'
  WHEN regexp_matches(c.user_agent, 'Linux') THEN 'Linux' ELSE 'Other' END"""

_PRODUCT_REST = ", ".join(
    f"cast(NULL AS {kind}) AS {name}"
    for name, kind in {
        "suffix": "varchar", "product_name": "varchar", "sku": "varchar",
        "attribute_set_id": "int", "type_id": "varchar", "min_price": "decimal(18,2)",
        "max_price": "decimal(18,2)", "collection_id": "varchar",
        "product_type_value": "varchar", "product_subtype_id": "int",
        "store_code": "varchar", "gender": "varchar",
    }.items()
)

_SELECTS = {
    "parse_logs": "SELECT "
    + _LOG.format(
        local_time="local_time", option=_OPTION
    )
    + " FROM logs",
    "parse_rejects": r"""SELECT value FROM malformed
        WHERE NOT coalesce(json_valid(value) AND regexp_matches(value, '^\s*\{'), false)""",
    "raw_log_landing": f"SELECT {_LANDED} FROM logs",
    "batch_row_counts": f"""SELECT cast(part AS bigint) AS batch_id,
        cast(count(*) AS bigint) AS row_count, cast(sum(bad) AS bigint) AS reject_count
        FROM (SELECT part, 0 AS bad FROM logs
          UNION ALL SELECT CASE WHEN ts < TIMESTAMP '{AS_OF}' THEN 0 ELSE 1 END, 1
          FROM events WHERE event_id % {MALFORMED_EVERY} = 0)
        GROUP BY part""",
    "geo_enrich": "SELECT id, ip, location_id, country_name, country_short, region_name, "
    "city_name FROM located",
    "dim_product": f"SELECT DISTINCT product_id, {_PRODUCT_REST} FROM hashed "
    "WHERE product_id IS NOT NULL",
    "dim_store": "SELECT DISTINCT store_id, concat('Store ', store_id) AS store_name "
    "FROM hashed WHERE store_id IS NOT NULL",
    "dim_location": "SELECT * FROM dim_location",
    "dim_customer": "SELECT * EXCLUDE (part) FROM dim_customer",
    "dim_date": "SELECT * FROM dim_date",
    "dim_increment": "SELECT * EXCLUDE (batch), cast(batch AS int) AS batch_id "
    "FROM customer_batches",
    "fact_product_views": "SELECT * FROM fact",
    "fact_via_dim_joins": "SELECT * FROM fact",
    "fact_increment": _FACT_BATCHES.format(kind="int"),
    "fact_fk_orphans": " UNION ALL ".join(
        f"""SELECT '{key}' AS foreign_key, count(DISTINCT {key}) AS orphan_keys,
        count(*) AS orphan_rows FROM fact WHERE {key} IS NOT NULL
        AND NOT EXISTS (SELECT 1 FROM ({early}) k WHERE k.{key} = fact.{key})"""
        for key, early in _EARLY.items()
    ),
    "report_top_products": _RANKED.format(
        key="product_id", rows="today WHERE product_id IS NOT NULL"
    )
    + " LIMIT 10",
    "report_top_countries": _RANKED.format(
        key="country_name", rows="today JOIN dim_location USING (location_id)"
    )
    + " LIMIT 10",
    "report_hourly_traffic": _HOURS.format(where=""),
    "report_user_agents": _RANKED.format(
        key="user_agent", rows="today JOIN customer_batches USING (customer_id)"
    ),
    "report_top_referrers": _RANKED.format(key="referrer_url", rows="today") + " LIMIT 5",
    "report_stores_by_country": _RANKED.format(
        key="store_id",
        rows=f"today JOIN dim_location USING (location_id) WHERE country_name = '{COUNTRY}'",
    ),
    "report_product_hourly": _HOURS.format(where=f"WHERE product_id = '{PRODUCT}'"),
    "report_browser_os_hourly": f"""SELECT view_hour, {_BROWSER} AS browser, {_SYSTEM} AS os,
        count(*) AS views FROM today JOIN customer_batches c USING (customer_id)
        GROUP BY 1, 2, 3 ORDER BY 1, 2, 3""",
    "domain_log_type_counts": """SELECT
        regexp_extract(current_url, '^[a-z]+://([^/?#:]+)', 1) AS host, collection,
        count(*) AS views FROM logs GROUP BY 1, 2""",
    "star_sql": """, busy AS (
        SELECT store_id, cast(hour(time_stamp) AS int) AS at_hour, customer_id, count(*) AS seen
        FROM fact WHERE date_id BETWEEN 20240115 AND 20240117 AND customer_id IS NOT NULL
        GROUP BY ALL)
        SELECT concat('Store ', store_id) AS store_name, at_hour, count(*) AS customers,
          max(seen) AS most_views
        FROM busy WHERE store_id IS NOT NULL GROUP BY ALL""",
    "stream_fact": _FACT_BATCHES.format(kind="bigint"),
    "stream_raw": f"SELECT {_LANDED}, cast(part AS bigint) AS batch_id FROM logs",
    "star_compacted_replay": _FACT_BATCHES.format(kind="bigint"),
    "stream_undated": "SELECT id, device_id, product_id, time_stamp FROM logs "
    "WHERE coalesce(time_stamp, 0) = 0",
    "stream_replay_idempotent": _FACT_BATCHES.format(kind="bigint"),
    "stream_hourly_traffic": "SELECT date_trunc('hour', viewed) AS hour_start, count(*) AS views "
    "FROM numbered WHERE time_stamp <> 0 GROUP BY 1",
    "stream_dedup_watermark": "SELECT * FROM fact WHERE date_id IS NOT NULL",
    "stream_first_copies": "SELECT * EXCLUDE (batch) FROM fact_batches",
    "topic_relay": _RELAYED,
    "consumer_lag": "SELECT topic, cast(sum(end_offset - coalesce(committed_offset, 0)) "
    "AS bigint) AS total_lag FROM offsets GROUP BY topic",
    "pipeline_freshness": """SELECT date_id, cast(hour(time_stamp) AS int) AS view_hour,
        count(*) AS views, max(time_stamp) AS last_view,
        date_diff('second', max(time_stamp), TIMESTAMP '2024-03-01 00:00:00') AS gap_seconds
        FROM (SELECT date_id, CASE WHEN date_id IS NOT NULL THEN time_stamp END AS time_stamp
          FROM fact) GROUP BY 1, 2""",
    "missing_partitions": """SELECT t.topic, t.partition
        FROM (SELECT DISTINCT topic, cast(unnest(range(6)) AS int) AS partition FROM offsets) t
        WHERE NOT EXISTS (SELECT 1 FROM offsets o
          WHERE o.topic = t.topic AND o.partition = t.partition)""",
}

for _name in ("top_products", "top_countries", "hourly_traffic", "user_agents", "top_referrers",
              "stores_by_country", "product_hourly", "browser_os_hourly"):
    _SELECTS[f"kept_{_name}"] = _SELECTS[f"report_{_name}"]

_SELECTS["kept_hourly_customers"] = """SELECT view_hour, count(DISTINCT customer_id) AS customers
  FROM today GROUP BY view_hour"""
_SELECTS["range_audit"] = """, suppliers AS (
    SELECT s_suppkey AS n, CASE WHEN s_suppkey % 4 = 0 THEN (11 * 256 + s_suppkey % 200)::bigint * 65536
        ELSE (10 * 256 + s_nationkey)::bigint * 65536 END + s_suppkey * 977 % 60000 AS ip_from,
      CASE WHEN s_suppkey % 10 = 0 THEN -256 ELSE (s_suppkey % 3 + 1) * 256 END AS length
    FROM supplier),
  all_ranges AS (
    SELECT ip_from, ip_to FROM ranges
    UNION ALL SELECT ip_from, ip_from + length - 1 FROM suppliers
    UNION ALL SELECT ip_from, ip_from + length - 1 FROM suppliers WHERE n % 7 = 0),
  reached AS (
    SELECT *, max(ip_to) OVER (ORDER BY ip_from, ip_to ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach
    FROM all_ranges WHERE ip_from <= ip_to)
  SELECT 'inverted' AS kind, ip_from::bigint AS ip_from, ip_to::bigint AS ip_to FROM all_ranges WHERE ip_from > ip_to
  UNION ALL SELECT 'overlap', ip_from, least(ip_to, reach) FROM reached WHERE ip_from <= reach
  UNION ALL SELECT 'gap', reach + 1, ip_from - 1 FROM reached WHERE ip_from > reach + 1"""
_SELECTS["log_key_counts"] = f""", lines AS ({_RELAYED}),
  keys AS (
    SELECT unnest(json_keys(value)) AS key FROM lines
    WHERE coalesce(json_valid(value) AND regexp_matches(value, '^\\s*\\{{'), false))
  SELECT key, key <> 'campaign' AS known, count(*) AS logs FROM keys GROUP BY key"""
_SELECTS["key_violations"] = " UNION ALL ".join(
    f"""SELECT '{name}' AS table_name, count(*) AS rows, count(*) - count({key}) AS null_keys,
      count({key}) - count(DISTINCT {key}) AS repeated_rows FROM ({rows})"""
    for name, key, rows in (
        ("dim_product", "product_id", "SELECT DISTINCT product_id FROM hashed WHERE product_id IS NOT NULL"),
        ("dim_store", "store_id", "SELECT DISTINCT store_id FROM hashed WHERE store_id IS NOT NULL"),
        ("dim_location", "location_id", "SELECT * FROM dim_location"),
        ("dim_customer", "customer_id", "SELECT * FROM dim_customer"),
        ("dim_date", "date_id", "SELECT * FROM dim_date"),
        ("fact_product_views", "fact_id", "SELECT * FROM fact"),
        ("user_log_raw", "id", "SELECT * FROM logs"),
    )
)
_SELECTS["stream_progress"] = "SELECT batch_id, row_count AS input_rows FROM (" + _SELECTS["batch_row_counts"] + ")"
_SELECTS["pipeline_freshness_since"] = _SELECTS["pipeline_freshness"].replace(
    "FROM fact)", "FROM fact WHERE date_id >= 20240115)")
_SELECTS["weekend_views"] = """SELECT d.date_of_week, store_id, count(*) AS views
  FROM fact f JOIN dim_date d ON f.date_id = d.date_id
  WHERE is_weekday_or_weekend = 'weekend' AND quarter_number = 1 GROUP BY 1, 2"""
_SELECTS["kept_daily_customers"] = """SELECT date_id, count(DISTINCT customer_id) AS customers
  FROM fact WHERE date_id IS NOT NULL GROUP BY date_id"""
_SELECTS["kept_counts_after_replays"] = """, dated AS (
    SELECT f.*, cast(hour(time_stamp) AS int) AS view_hour, country_name, user_agent,
      l.location_id IS NOT NULL AS located, c.customer_id IS NOT NULL AS known
    FROM fact f LEFT JOIN dim_location l USING (location_id)
    LEFT JOIN customer_batches c USING (customer_id)
    WHERE date_id IS NOT NULL),
  parts AS (
    SELECT 'product' AS part, date_id, view_hour, product_id, NULL AS store_id, NULL AS country_name,
      NULL AS user_agent, NULL AS referrer_url, count(*) AS views FROM dated GROUP BY ALL
    UNION ALL SELECT 'place', date_id, NULL, NULL, store_id, country_name, NULL, NULL, count(*)
    FROM dated WHERE located GROUP BY ALL
    UNION ALL SELECT 'agent', date_id, view_hour, NULL, NULL, NULL, user_agent, NULL, count(*)
    FROM dated WHERE known GROUP BY ALL
    UNION ALL SELECT 'referrer', date_id, NULL, NULL, NULL, NULL, NULL, referrer_url, count(*)
    FROM dated GROUP BY ALL
    UNION ALL SELECT 'customers', date_id, view_hour, NULL, NULL, NULL, NULL, NULL, count(*)
    FROM dated GROUP BY ALL)
  SELECT part, date_id, view_hour, cast(product_id AS varchar) AS product_id,
    cast(store_id AS varchar) AS store_id, cast(country_name AS varchar) AS country_name,
    cast(user_agent AS varchar) AS user_agent, cast(referrer_url AS varchar) AS referrer_url, views
  FROM parts"""

# The table functions answer what the kept reports do.
for _name in [n for n in _SELECTS if n.startswith("kept_")]:
    if _name not in ("kept_daily_customers", "kept_counts_after_replays"):
        _SELECTS[_name.replace("kept_", "sql_")] = _SELECTS[_name]

ORACLES = {name: _COMMON + select for name, select in _SELECTS.items()}
