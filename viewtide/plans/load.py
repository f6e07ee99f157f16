"""Load one batch of messages into the star tables."""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import ExitStack, contextmanager
from dataclasses import dataclass
from functools import partial

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewtide import schemas
from viewtide.functions import dates
from viewtide.operators import dims, facts, lookup, merge, parse
from viewtide.operators.geo import IpLocator
from viewtide.plans import partials
from viewtide.session import written
from viewtide.sources.warehouse import BUCKETED, Warehouse

STAGED = [
    "id", "collection", "current_url", "referrer_url", "device_id", "user_id_db",
    "resolution", "email_address", "ip", "product_id", "store_id", "time_stamp",
    "user_agent", "loc_info", "accepted", "value",
]
# Hashes of copies and known facts are broadcast only if they measure at most this, which is some
# 800,000 of them: the driver holds the rows, their hash table and what it sends of it at once. A
# batch that is loaded again has as many as facts.
SUSPECT_BYTES = 32 * 1024 * 1024


def _locate(parsed: DataFrame, locator: IpLocator) -> DataFrame:
    """Parsed messages with their location; the text is kept only for rejects."""
    text = F.when(~F.col("accepted"), F.col("value")).alias("value")
    located = locator.enrich(parsed)
    return located.select(*[text if name == "value" else name for name in STAGED])


@contextmanager
def _persisted(rows: DataFrame) -> Iterator[DataFrame]:
    """The rows kept on the executors, memory first, and released afterwards."""
    kept = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()


@dataclass(frozen=True)
class Survey:
    """What one pass over a staged batch tells about it."""

    rows: int
    days: list[int | None]


def _survey(staged: DataFrame) -> Survey:
    """Count the messages and list the days of the logs, None for undated ones.

    The days are bounded by the calendar.
    """
    day = dates.date_key(F.col("time_stamp"))
    found = staged.agg(
        F.count("*").alias("n"),
        F.collect_set(F.when(F.col("accepted"), day)).alias("days"),
        F.coalesce(F.bool_or(F.col("accepted") & day.isNull()), F.lit(False)).alias("undated"),
    ).first()
    return Survey(found["n"], [*found["days"], *([None] if found["undated"] else [])])


def merge_dimension(warehouse: Warehouse, table: str, logs: DataFrame, batch_id: int) -> None:
    """Add the rows of a dimension that earlier batches have not brought."""
    rows, key = dims.BUILDERS[table](logs), schemas.PRIMARY_KEYS[table]
    known = warehouse.before(table, batch_id)
    if table in BUCKETED:
        known = merge.held_in_buckets(known, rows.select(key))
    warehouse.write_batch(table, merge.absent_rows(rows, known, key), batch_id)


@contextmanager
def _new_facts(
    rows: DataFrame, known: DataFrame, broadcast_bytes: int = SUSPECT_BYTES
) -> Iterator[DataFrame]:
    """The first copies of the facts that are not known yet; the rows are kept or written."""
    with _persisted(facts.suspect_hashes(rows, known)) as suspects:
        if lookup.fits_broadcast(suspects, broadcast_bytes):
            yield facts.new_facts(rows, known, suspects)
        else:
            held = merge.held_keys(known, rows.select("fact_id"))
            yield merge.absent_rows(facts.first_per_fact(rows), held, "fact_id")


def _merge_batch(
    warehouse: Warehouse,
    staged: DataFrame,
    batch_id: int,
    survey: Survey,
    broadcast_bytes: int = SUSPECT_BYTES,
) -> None:
    """Rejects and dimensions side by side, then the fact that refers to them."""
    rejects = staged.where(~F.col("accepted")).select("value")
    logs = staged.where("accepted")
    jobs = [lambda: warehouse.write_batch("log_rejects", rejects, batch_id)]
    jobs += [
        partial(merge_dimension, warehouse, table, logs, batch_id)
        for table in dims.BUILDERS
    ]
    inherit = inheritable_thread_target(warehouse.spark)
    with ThreadPoolExecutor(len(jobs)) as pool:
        for done in [pool.submit(inherit(job)) for job in jobs]:
            done.result()
    rows = facts.fact_rows(logs)
    # A fact key contains its date, so no other day can hold the same key.
    known = warehouse.before("fact_product_views", batch_id, survey.days)
    with _new_facts(rows, known, broadcast_bytes) as new:
        warehouse.write_batch("fact_product_views", new, batch_id)
    partials.write_partials(warehouse, batch_id, survey.days)


def load_table_batch(
    warehouse: Warehouse, messages: DataFrame, locator: IpLocator, batch_id: int
) -> int:
    """Load a large batch; returns its number of messages. A closed one is skipped.

    The parsed rows are written once, so the JSON is read once, every table scans only
    its columns, and lost executors cost no re-parsing.
    """
    if batch_id <= warehouse.closed():
        return 0
    with ExitStack() as tables:
        parsed = parse.parse_messages(messages)
        if not locator.broadcasts:
            # The addresses are then read more than once.
            parsed = tables.enter_context(written(parsed, "parsed"))
        staged = tables.enter_context(written(_locate(parsed, locator), "staged"))
        survey = _survey(staged)
        _merge_batch(warehouse, staged, batch_id, survey)
        return survey.rows


def load_micro_batch(
    warehouse: Warehouse, messages: DataFrame, locator: IpLocator, batch_id: int
) -> int:
    """Load a micro-batch; returns its number of messages. An empty or closed one is skipped."""
    if batch_id <= warehouse.closed():
        return 0
    with ExitStack() as kept:
        parsed = parse.parse_messages(messages)
        if not locator.broadcasts:
            # The addresses are then read more than once.
            parsed = kept.enter_context(_persisted(parsed))
        staged = kept.enter_context(_persisted(_locate(parsed, locator)))
        survey = _survey(staged)
        if survey.rows:
            _merge_batch(warehouse, staged, batch_id, survey)
        return survey.rows


def land_micro_batch(warehouse: Warehouse, messages: DataFrame, batch_id: int) -> int:
    """Land a micro-batch flat, without star tables; returns its number of messages."""
    if batch_id <= warehouse.closed():
        return 0
    with _persisted(parse.parse_messages(messages)) as parsed:
        counts = parsed.agg(
            F.count("*").alias("row_count"),
            F.count_if(~F.col("accepted")).alias("reject_count"),
        ).first()
        rows = counts["row_count"]
        if rows:
            counted = warehouse.spark.createDataFrame([counts], "row_count long, reject_count long")
            warehouse.write_batch("landed_counts", counted, batch_id)
            logs = parsed.where("accepted").select(*schemas.LOG_FIELDS)
            warehouse.write_batch("user_log_raw", parse.raw_log_landing(logs), batch_id)
            rejects = parsed.where(~F.col("accepted")).select("value")
            warehouse.write_batch("user_log_raw_rejects", rejects, batch_id)
        return rows
