"""Pipeline health as queries: lag, freshness, missing partitions, batch sizes."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewtide.operators import parse

ENTRIES = "map<string,map<string,bigint>>"


def consumer_lag(offsets: DataFrame, *by: str) -> DataFrame:
    """Messages written but not yet read, in total or per ``by`` columns."""
    behind = F.col("end_offset") - F.coalesce("committed_offset", F.lit(0))
    return offsets.groupBy(*by).agg(F.sum(behind).alias("total_lag"))


def offsets_from_json(progress: DataFrame) -> DataFrame:
    """Topic offsets from the JSON a topic source reports as its progress.

    ``progress`` has the columns ``end_offsets`` and ``committed_offsets``, each
    ``{"topic": {"partition": offset}}``; a partition never committed gets NULL.
    """
    ends = progress.select(
        F.from_json("end_offsets", ENTRIES).alias("ends"),
        F.from_json("committed_offsets", ENTRIES).alias("read"),
    )
    topics = ends.select(F.explode("ends").alias("topic", "parts"), "read")
    parts = topics.select("topic", F.explode("parts").alias("partition", "end_offset"), "read")
    committed = F.try_element_at(F.try_element_at("read", F.col("topic")), F.col("partition"))
    number = F.col("partition").cast("int").alias("partition")
    return parts.select("topic", number, "end_offset", committed.alias("committed_offset"))


def expected_partitions(topics: DataFrame, partitions: int) -> DataFrame:
    """Each topic with every partition number below ``partitions``."""
    numbers = F.sequence(F.lit(0), F.lit(partitions - 1))
    return topics.select("topic").distinct().select("topic", F.explode(numbers).alias("partition"))


def missing_partitions(expected: DataFrame, observed: DataFrame) -> DataFrame:
    """Expected topic partitions that were not observed."""
    seen = observed.select("topic", "partition").distinct()
    return expected.join(seen, ["topic", "partition"], "left_anti")


def pipeline_freshness(fact: DataFrame, as_of: str, since: int | None = None) -> DataFrame:
    """Per hour of the fact: its volume, its last view and the seconds since then.

    With ``since``, a date key, earlier days and undated views are left out and their folders
    not opened, so a check costs the days it looks at and not the history. Views without a date (no epoch, a zero one, or one outside the years 1 to 9999) are in
    no report; they are counted here, in one row without an hour.
    """
    if since is not None:
        fact = fact.where(F.col("date_id") >= since)
    at = F.when(F.col("date_id").isNotNull(), F.col("time_stamp"))
    last = F.max(at)
    gap = F.timestamp_diff("SECOND", last, F.lit(as_of).cast("timestamp_ntz"))
    return fact.groupBy("date_id", F.hour(at).alias("view_hour")).agg(
        F.count("*").alias("views"), last.alias("last_view"), gap.alias("gap_seconds")
    )


def message_counts() -> list[Column]:
    """Aggregates over messages: how many there are, and how many are no log."""
    rejected = ~parse.is_log(F.col("value").cast("string"))
    return [F.count(F.lit(1)).alias("row_count"), F.count_if(rejected).alias("reject_count")]


def batch_row_counts(counts: DataFrame) -> DataFrame:
    """Messages and rejects of each landed batch, as the landing counted them."""
    return counts.groupBy("batch_id").agg(
        F.sum("row_count").alias("row_count"), F.sum("reject_count").alias("reject_count")
    )


def lag_of_query(query) -> list[dict]:
    """Topics, partitions and offsets that a running stream last reported, one entry each.

    ``offsets_from_json`` takes ``end_offsets`` and ``committed_offsets`` of the entries.
    """
    progress = query.lastProgress
    if progress is None:
        return []
    return [
        {"end_offsets": _text(source["latestOffset"]), "committed_offsets": _text(source["endOffset"])}
        for source in (s if isinstance(s, dict) else json.loads(s.json) for s in progress["sources"])
    ]


def _text(offsets) -> str | None:
    return offsets if offsets is None or isinstance(offsets, str) else json.dumps(offsets)


def key_violations(tables: Mapping[str, DataFrame], keys: Mapping[str, str]) -> DataFrame:
    """Per table: its rows, those without a key, and those that repeat another row's key.

    Rows are counted per key, combined before the shuffle, so a key that most rows repeat
    reaches its task as one row per map task.
    """
    checks = None
    for name, rows in tables.items():
        key = keys[name]
        counted = rows.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("n"))
        held = F.col("_key").isNotNull()
        found = counted.agg(
            F.lit(name).alias("table_name"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
            F.coalesce(F.sum(F.when(~held, F.col("n"))), F.lit(0)).alias("null_keys"),
            F.coalesce(F.sum(F.when(held, F.col("n") - 1)), F.lit(0)).alias("repeated_rows"),
        )
        checks = found if checks is None else checks.unionByName(found)
    return checks
