"""The registered queries, each over the whole of the given tables."""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewtide import schemas
from viewtide.operators import dims, facts, intervals, merge, parse
from viewtide.operators.geo import IpLocator
from viewtide.plans import health, load, partials, reports, table_functions
from viewtide.session import new_scratch, stateful_session
from viewtide.sources import clickstream
from viewtide.sources.messages import read_message_stream, read_messages, write_messages
from viewtide.sources.warehouse import Warehouse
from viewtide.streaming import jobs, progress

AS_OF = "2024-01-15"
COUNTRY = "NATION_3"
PRODUCT = "42"
AT_ONCE = {"availableNow": True}
# Hourly counts are few: one row per hour and map task reaches the state.
HOURLY_STATE = 8

Query = Callable[[SparkSession, str], DataFrame]


_topics: dict[tuple[str, str], str] = {}
_loaded: dict[tuple[str, str], Warehouse] = {}
_landed: dict[tuple[str, str], Warehouse] = {}
_replayed: dict[tuple[str, str], Warehouse] = {}
_preparing = threading.RLock()


def write_topic(spark: SparkSession, sf_dir: str) -> str:
    """Folder of JSON text messages, a subfolder per part; written once per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    with _preparing:
        if key not in _topics:
            path = new_scratch(spark, "topic")
            for part in clickstream.PARTS:
                write_messages(clickstream.messages(spark, sf_dir, part, AS_OF), f"{path}/{part}")
            _topics[key] = path
        return _topics[key]


def _messages(spark: SparkSession, sf_dir: str, *parts: str) -> DataFrame:
    topic = write_topic(spark, sf_dir)
    return read_messages(spark, *[f"{topic}/{part}" for part in parts or clickstream.PARTS])


def _logs(spark: SparkSession, sf_dir: str, *parts: str) -> DataFrame:
    return parse.parse_logs(_messages(spark, sf_dir, *parts))


def _locator(spark: SparkSession, sf_dir: str) -> IpLocator:
    return IpLocator(clickstream.ip_ranges(spark, sf_dir))


def _located(spark: SparkSession, sf_dir: str, *parts: str) -> DataFrame:
    return _locator(spark, sf_dir).enrich(_logs(spark, sf_dir, *parts))


def load_star(spark: SparkSession, sf_dir: str) -> Warehouse:
    """Star tables written from all messages in two batches, once per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    with _preparing:
        if key not in _loaded:
            warehouse = Warehouse(spark, new_scratch(spark, "star"))
            locator = _locator(spark, sf_dir)
            load.load_table_batch(warehouse, _messages(spark, sf_dir, "early"), locator, 0)
            later = _messages(spark, sf_dir, "late", "replay")
            load.load_table_batch(warehouse, later, locator, 1)
            _loaded[key] = warehouse
        return _loaded[key]


# -- parse ---------------------------------------------------------------------------


def parse_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All fields; the product options, which may be several, as JSON text."""
    return _logs(spark, sf_dir).withColumn("option", F.to_json("option"))


def parse_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.parse_rejects(_messages(spark, sf_dir))


def raw_log_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.raw_log_landing(_logs(spark, sf_dir))


def geo_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _located(spark, sf_dir).select("id", "ip", "loc_info.*")


def range_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.audit(clickstream.odd_ranges(spark, sf_dir))


# -- dimensions and fact ---------------------------------------------------------------


def dim_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.dim_product(_logs(spark, sf_dir))


def dim_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.dim_store(_logs(spark, sf_dir))


def dim_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.dim_location(_located(spark, sf_dir))


def dim_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.dim_customer(_logs(spark, sf_dir))


def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.dim_date(_logs(spark, sf_dir))


def _two_batches(first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """A table after a batch and a second one that overlaps it."""
    new = merge.absent_rows(second, first, key)
    return first.withColumn("batch_id", F.lit(0)).unionByName(
        new.withColumn("batch_id", F.lit(1))
    )


def dim_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bucketed customers after a batch and a second one that overlaps it."""
    warehouse = Warehouse(spark, new_scratch(spark, "star"))
    for batch_id, parts in enumerate((("early",), clickstream.PARTS)):
        load.merge_dimension(warehouse, "dim_customer", _logs(spark, sf_dir, *parts), batch_id)
    return warehouse.with_batches("dim_customer").withColumn("batch_id", F.col("batch_id").cast("int"))


def fact_product_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.fact_product_views(_located(spark, sf_dir))


def fact_via_dim_joins(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = load_star(spark, sf_dir)
    tables = {name: warehouse.table(name) for name in dims.BUILDERS}
    return facts.fact_via_dim_joins(_located(spark, sf_dir), tables)


def fact_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = facts.fact_product_views(_located(spark, sf_dir, "early"))
    return _two_batches(first, facts.fact_product_views(_located(spark, sf_dir)), "fact_id")


def fact_fk_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole fact against the dimensions as the first batch left them."""
    warehouse = load_star(spark, sf_dir)
    tables = {name: warehouse.before(name, 1) for name in dims.BUILDERS}
    return facts.fk_orphans(warehouse.table("fact_product_views"), tables)


# -- reports ---------------------------------------------------------------------------


def report_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_products(load_star(spark, sf_dir), AS_OF)


def report_top_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_countries(load_star(spark, sf_dir), AS_OF)


def report_hourly_traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.hourly_traffic(load_star(spark, sf_dir), AS_OF)


def report_user_agents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.user_agents(load_star(spark, sf_dir), AS_OF)


def report_top_referrers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_referrers(load_star(spark, sf_dir), AS_OF)


def report_stores_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.stores_by_country(load_star(spark, sf_dir), COUNTRY, AS_OF)


def report_product_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.product_hourly(load_star(spark, sf_dir), PRODUCT, AS_OF)


def report_browser_os_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.browser_os_hourly(load_star(spark, sf_dir), AS_OF)


def _kept(report: Callable[..., DataFrame], *args) -> Query:
    """A report answered from the counts that the batches keep."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return report(load_star(spark, sf_dir), *args, AS_OF)

    query.__name__ = f"kept_{report.__name__}"
    return query


KEPT = [
    _kept(partials.top_products), _kept(partials.top_countries), _kept(partials.hourly_traffic),
    _kept(partials.user_agents), _kept(partials.top_referrers),
    _kept(partials.stores_by_country, COUNTRY), _kept(partials.product_hourly, PRODUCT),
    _kept(partials.browser_os_hourly), _kept(partials.hourly_customers),
]


def weekend_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekend views of a quarter per weekday and store."""
    chosen = (F.col("is_weekday_or_weekend") == "weekend") & (F.col("quarter_number") == 1)
    return reports.calendar_views(load_star(spark, sf_dir), chosen, "date_of_week", "store_id")


def _by_function(call: str) -> Query:
    """A kept report asked for in SQL, through its table function."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        table_functions.register(load_star(spark, sf_dir))
        return spark.sql(f"SELECT * FROM {call}")

    query.__name__ = f"sql_{call.split('(')[0]}"
    return query


BY_FUNCTION = [
    _by_function(f"{name}({arguments}DATE'{AS_OF}')")
    for name, arguments in (
        ("top_products", ""), ("top_countries", ""), ("hourly_traffic", ""), ("user_agents", ""),
        ("top_referrers", ""), ("stores_by_country", f"'{COUNTRY}', "), ("product_hourly", f"'{PRODUCT}', "),
        ("browser_os_hourly", ""), ("hourly_customers", ""),
    )
]


def kept_daily_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partials.daily_customers(load_star(spark, sf_dir))


def domain_log_type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.domain_log_type_counts(_logs(spark, sf_dir))


def star_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL text over the star tables with bound parameters: customers per store and hour."""
    return reports.query(
        load_star(spark, sf_dir),
        """WITH busy AS (
          SELECT store_id, hour(time_stamp) AS at_hour, customer_id, count(*) AS seen
          FROM fact_product_views
          WHERE date_id BETWEEN :from_day AND :to_day AND customer_id IS NOT NULL
          GROUP BY ALL)
        SELECT store_name, at_hour, count(*) AS customers, max(seen) AS most_views
        FROM busy JOIN dim_store USING (store_id)
        GROUP BY store_name, at_hour""",
        {"from_day": 20240115, "to_day": 20240117},
    )


# -- streaming -------------------------------------------------------------------------


def _stream_parts(
    spark: SparkSession, sf_dir: str, start: Callable[[DataFrame], object]
) -> None:
    """Let a streaming job read the parts one after another, restarting in between."""
    topic = new_scratch(spark, "topic")
    for part in clickstream.PARTS:
        write_messages(_messages(spark, sf_dir, part), topic)
        start(read_message_stream(spark, topic)).awaitTermination()


def stream_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = Warehouse(spark, new_scratch(spark, "star"))
    locator, checkpoint = _locator(spark, sf_dir), new_scratch(spark, "checkpoint")
    _stream_parts(
        spark,
        sf_dir,
        lambda stream: jobs.start_star(stream, warehouse, locator, checkpoint, AT_ONCE),
    )
    return warehouse.with_batches("fact_product_views")


def _raw_landing(spark: SparkSession, sf_dir: str) -> Warehouse:
    """All messages landed by a stream, once per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    with _preparing:
        if key not in _landed:
            warehouse = Warehouse(spark, new_scratch(spark, "raw"))
            checkpoint = new_scratch(spark, "checkpoint")
            _stream_parts(
                spark, sf_dir, lambda stream: jobs.start_raw(stream, warehouse, checkpoint, AT_ONCE)
            )
            _landed[key] = warehouse
        return _landed[key]


def stream_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw_landing(spark, sf_dir).with_batches("user_log_raw")


def batch_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return health.batch_row_counts(_raw_landing(spark, sf_dir).with_batches("landed_counts"))


def _forget_last_commit(spark: SparkSession, checkpoint: str) -> None:
    """Leave a stream's checkpoint as if it had died before its last batch was committed."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    commits = [s.getPath() for s in fs.listStatus(path) if s.getPath().getName().isdigit()]
    fs.delete(max(commits, key=lambda p: int(p.getName())), False)


def _replayed_star(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The star stream, dying after each of its batches and repeating it when it restarts;
    once per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    with _preparing:
        if key not in _replayed:
            _replayed[key] = _replay_star(spark, sf_dir)
        return _replayed[key]


def _replay_star(spark: SparkSession, sf_dir: str) -> Warehouse:
    warehouse = Warehouse(spark, new_scratch(spark, "star"))
    locator, checkpoint = _locator(spark, sf_dir), new_scratch(spark, "checkpoint")

    def start(stream: DataFrame):
        query = jobs.start_star(stream, warehouse, locator, checkpoint, AT_ONCE)
        query.awaitTermination()
        _forget_last_commit(spark, checkpoint)
        return jobs.start_star(stream, warehouse, locator, checkpoint, AT_ONCE)

    _stream_parts(spark, sf_dir, start)
    return warehouse


def stream_replay_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _replayed_star(spark, sf_dir).with_batches("fact_product_views")


def kept_counts_after_replays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All counts that a stream has kept which repeated each of its batches."""
    return partials.all_counts(_replayed_star(spark, sf_dir))


def star_compacted_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load a batch and an overlapping one, close the first, repeat both, load all once more,
    close again and delete what was closed."""
    warehouse = Warehouse(spark, new_scratch(spark, "star"))
    locator = _locator(spark, sf_dir)
    early, late = (_messages(spark, sf_dir, part) for part in ("early", "late"))
    for batch_id, batch in enumerate((early, late)):
        load.load_table_batch(warehouse, batch, locator, batch_id)
    warehouse.close()
    for batch_id, batch in enumerate((early, late)):
        load.load_table_batch(warehouse, batch, locator, batch_id)
    load.load_table_batch(warehouse, _messages(spark, sf_dir), locator, 2)
    warehouse.close()
    warehouse.sweep()
    return warehouse.with_batches("fact_product_views")


def stream_hourly_traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    checkpoint = new_scratch(spark, "checkpoint")
    warehouse = Warehouse(spark, new_scratch(spark, "hourly"))
    _stream_parts(
        stateful_session(spark, HOURLY_STATE),
        sf_dir,
        lambda stream: jobs.start_hourly_traffic(stream, warehouse, checkpoint, AT_ONCE),
    )
    return jobs.hourly_traffic(warehouse)


def stream_dedup_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A delay far shorter than the data: the replayed views are repeated to state that has
    forgotten most of them, and are late by then."""
    target, checkpoint = new_scratch(spark, "unique"), new_scratch(spark, "checkpoint")
    own = stateful_session(spark, spark.sparkContext.defaultParallelism)
    locator = _locator(own, sf_dir)
    _stream_parts(
        own,
        sf_dir,
        lambda stream: jobs.start_dedup(stream, locator, target, checkpoint, "1 day", AT_ONCE),
    )
    return spark.read.parquet(target)


def stream_first_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All views once each, undated ones too, by state that forgets them a day after arrival."""
    target, checkpoint = new_scratch(spark, "first"), new_scratch(spark, "checkpoint")
    own = stateful_session(spark, spark.sparkContext.defaultParallelism)
    locator = _locator(own, sf_dir)
    _stream_parts(
        own,
        sf_dir,
        lambda stream: jobs.start_first_copies(stream, locator, target, checkpoint, "1 day", AT_ONCE),
    )
    return spark.read.parquet(target)


def stream_undated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The logs that the de-duplication cannot place in time."""
    target, checkpoint = new_scratch(spark, "undated"), new_scratch(spark, "checkpoint")
    _stream_parts(
        spark, sf_dir, lambda stream: jobs.start_undated(stream, target, checkpoint, AT_ONCE)
    )
    return spark.read.parquet(target).select("id", "device_id", "product_id", "time_stamp")


def topic_relay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The relayed messages, text for text."""
    target, checkpoint = new_scratch(spark, "relay"), new_scratch(spark, "checkpoint")
    _stream_parts(
        spark, sf_dir, lambda stream: jobs.start_relay(stream, target, checkpoint, AT_ONCE)
    )
    return read_messages(spark, target)


# -- health ----------------------------------------------------------------------------


def consumer_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return health.consumer_lag(clickstream.topic_offsets(spark, sf_dir, AS_OF), "topic")


def pipeline_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = load_star(spark, sf_dir).table("fact_product_views")
    return health.pipeline_freshness(fact, "2024-03-01 00:00:00")


def pipeline_freshness_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = load_star(spark, sf_dir).table("fact_product_views")
    return health.pipeline_freshness(fact, "2024-03-01 00:00:00", 20240115)


def key_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The star tables, and the raw landing, whose ids are sent again."""
    warehouse, raw = load_star(spark, sf_dir), _raw_landing(spark, sf_dir)
    tables = {name: warehouse.table(name) for name in schemas.PRIMARY_KEYS}
    tables["user_log_raw"] = raw.table("user_log_raw")
    return health.key_violations(tables, {**schemas.PRIMARY_KEYS, "user_log_raw": "id"})


def log_key_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.key_counts(_messages(spark, sf_dir))


def stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each batch of a relay, as its listener wrote them down."""
    target, checkpoint = new_scratch(spark, "relay"), new_scratch(spark, "checkpoint")
    log = progress.ProgressLog(spark, new_scratch(spark, "progress")).add()
    ended = []

    def start(stream: DataFrame):
        query = jobs.start_relay(stream, target, checkpoint, AT_ONCE)
        ended.append(query)
        return query

    try:
        _stream_parts(spark, sf_dir, start)
        for query in ended:
            log.wait_for(query)
    finally:
        log.remove()
    # Other queries of the session may have reported, too.
    return log.read().where(F.col("query") == str(ended[0].id)).select("batch_id", "input_rows")


def missing_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six partitions per topic are expected; the events fill five."""
    observed = clickstream.topic_offsets(spark, sf_dir, AS_OF)
    return health.missing_partitions(health.expected_partitions(observed, 6), observed)


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        parse_logs, parse_rejects, raw_log_landing, batch_row_counts, geo_enrich, range_audit,
        dim_product, dim_store, dim_location, dim_customer, dim_date, dim_increment,
        fact_product_views, fact_via_dim_joins, fact_increment, fact_fk_orphans,
        report_top_products, report_top_countries, report_hourly_traffic,
        report_user_agents, report_top_referrers, report_stores_by_country,
        report_product_hourly, report_browser_os_hourly, domain_log_type_counts, star_sql,
        *KEPT, *BY_FUNCTION, weekend_views, kept_daily_customers, kept_counts_after_replays,
        stream_fact, stream_raw, stream_replay_idempotent, star_compacted_replay,
        stream_hourly_traffic, stream_dedup_watermark, stream_first_copies, stream_undated, topic_relay,
        consumer_lag, pipeline_freshness, pipeline_freshness_since, missing_partitions,
        key_violations, log_key_counts, stream_progress,
    )
}
