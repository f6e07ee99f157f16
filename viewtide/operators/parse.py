"""JSON messages to log records, rejects and raw landing rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewtide import schemas
from viewtide.functions import dates


def is_log(value: Column) -> Column:
    """True when the text is one complete JSON object (NULL and other JSON are not).

    Listing the outer keys walks every token without building values.
    """
    return F.json_object_keys(value).isNotNull()


def parse_messages(messages: DataFrame) -> DataFrame:
    """Every message as log columns, plus ``accepted`` and the text as ``value``.

    Unknown keys are dropped and missing keys are NULL. A field of the wrong shape is
    NULL while the others stay. An epoch may be written as ISO 8601.
    """
    text = messages.select(F.col("value").cast("string").alias("value"))
    parsed = text.select("value", F.from_json("value", schemas.MESSAGE).alias("data"))
    fields = []
    for name in schemas.LOG_FIELDS:
        field = F.col(f"data.{name}")
        if name == "email_address":
            field = F.coalesce(field, F.col("data.email"))
        elif name == "time_stamp":
            field = dates.epoch_of(field)
        fields.append(field.alias(name))
    return parsed.select(*fields, is_log(F.col("value")).alias("accepted"), "value")


def parse_logs(messages: DataFrame) -> DataFrame:
    return parse_messages(messages).where("accepted").select(*schemas.LOG_FIELDS)


def parse_rejects(messages: DataFrame) -> DataFrame:
    """The messages that are not one JSON object, as they came."""
    value = F.col("value").cast("string")
    return messages.select(value.alias("value")).where(~is_log(F.col("value")))


def raw_log_landing(logs: DataFrame) -> DataFrame:
    """Flat landing rows: local time parsed, product options as JSON text."""
    return logs.withColumns(
        {
            "local_time": dates.local_clock(F.col("local_time")),
            "option": F.to_json("option"),
        }
    )


def key_counts(messages: DataFrame) -> DataFrame:
    """How many logs have each outer key, and whether the schema knows it: what a source has
    begun to send, or stopped sending. Counts combine before the shuffle."""
    value = F.col("value").cast("string")
    keys = messages.select(F.explode(F.array_distinct(F.json_object_keys(value))).alias("key"))
    known = F.col("key").isin(*schemas.LOG_FIELDS, "email").alias("known")
    return keys.groupBy("key").agg(F.count("*").alias("logs")).select("key", known, "logs")
