"""Clickstream messages and IP ranges derived from the given test tables.

Every event becomes one log record; its page and referrer come from the whole pages
table. Some records come twice (replays) and some lines are malformed. Odd values are
spread over the records: epochs that are zero, missing, text or written out, empty and blank texts,
addresses that are none, bad local times, two options, and the other name of the e-mail.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viewtide import schemas

# User agents by event number modulo 6; the sixth is blank.
USER_AGENTS = [
    "Mozilla/5.0 (iPhone; CPU iPhone OS 16_2 like Mac OS X) AppleWebKit/605.1.15 "
    "(KHTML, like Gecko) Version/16.2 Mobile/15E148 Safari/604.1",
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 "
    "(KHTML, like Gecko) Chrome/120.0.0.0 Safari/537.36",
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 "
    "(KHTML, like Gecko) Chrome/120.0.0.0 Safari/537.36 Edg/120.0.0.0",
    "Mozilla/5.0 (X11; Linux x86_64; rv:121.0) Gecko/20100101 Firefox/121.0",
    "Mozilla/5.0 (Linux; Android 13; Pixel 7) AppleWebKit/537.36 "
    "(KHTML, like Gecko) Chrome/119.0.0.0 Mobile Safari/537.36",
    " ",
]
REPLAY_EVERY = 11
MALFORMED_EVERY = 97

PARTS = ("early", "late", "replay")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _epoch(ts: Column) -> Column:
    """Whole seconds of a zone-less time since 1970, free of the session time zone."""
    days = F.unix_date(F.to_date(ts)).cast("bigint")
    return days * 86_400 + F.hour(ts) * 3_600 + F.minute(ts) * 60 + F.floor(F.second(ts))


def _events(spark: SparkSession, sf_dir: str, part: str, split_at: str) -> DataFrame:
    """Events of one part: before ``split_at``, from it on, or those sent again."""
    events = table(spark, sf_dir, "events")
    if part == "replay":
        return events.where(F.col("event_id") % REPLAY_EVERY == 0)
    bound = F.lit(split_at).cast("timestamp_ntz")
    return events.where(F.col("ts") < bound if part == "early" else F.col("ts") >= bound)


def _records(spark: SparkSession, sf_dir: str, events: DataFrame) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    size = table(spark, sf_dir, "pages").agg(F.count("*")).scalar()
    event, user = F.col("event_id"), F.col("user_id")
    numbered = events.select(
        "event_id", "user_id", "ts", "event_type", "props",
        F.pmod(event, size).alias("page"),
        F.pmod(event * 3, size).alias("referrer"),
    )
    pages_seen = numbered.join(
        pages.select(F.col("page_id").alias("page"), F.col("url").alias("current_url")),
        "page", "left",
    ).join(
        pages.select(F.col("page_id").alias("referrer"), F.col("url").alias("referrer_url")),
        "referrer", "left",
    )

    def every(n: int) -> Column:
        return event % n == 0

    text = lambda column: column.cast("string")
    agent = F.when(event % 6 == 0, USER_AGENTS[0])
    for number, value in enumerate(USER_AGENTS[1:], start=1):
        agent = agent.when(event % 6 == number, value)
    seconds = _epoch(F.col("ts"))
    choice = lambda of, label: F.struct(
        text(of).alias("option_id"), F.lit(label).alias("option_label")
    )
    option = F.when(
        every(8), F.array(choice(event % 7, "diamond"), choice(event % 3, "ruby"))
    ).otherwise(F.array(choice(event % 7, "diamond")))
    fields = {
        "id": text(event),
        "api_version": F.lit("1.0"),
        "collection": F.col("event_type"),
        "current_url": F.col("current_url"),
        "device_id": F.when(every(19), "").when(~every(17), F.concat(F.lit("dev-"), text(user))),
        "user_id_db": F.when(every(5), "  ").otherwise(text(user)),
        "resolution": F.when(every(3), "1920x1080").when(event % 3 == 1, "390x844"),
        "email_address": F.when(every(4), "").when(every(47), "\t ").otherwise(
            F.concat(F.lit("u"), text(user), F.lit("@example.org"))
        ),
        "ip": F.when(every(59), "300.1.1.1").when(every(61), "190.x.1.2").when(
            ~every(29),
            F.concat(F.lit("10."), text(user % 30), F.lit("."), text(event % 256), F.lit(".1")),
        ),
        "local_time": F.when(every(53), "28/05/2024").otherwise(F.substring(text(F.col("ts")), 1, 19)),
        "option": F.when(~every(7), option),
        "product_id": F.when(every(31), "").when(~every(23), F.regexp_extract("props", "([0-9]+)", 1)),
        "referrer_url": F.col("referrer_url"),
        "store_id": text(user % 10),
        "time_stamp": F.when(every(37), 0).when(~every(41), F.when(
            every(13), seconds * 1_000
        ).otherwise(seconds)),
        "user_agent": agent,
    }
    return pages_seen.select(*[c.alias(n) for n, c in fields.items()])


def _line() -> Column:
    """A record as JSON: some epochs as text or written out, some e-mails under their other
    name, some records with a key that the schema does not know."""
    digits = F.col("time_stamp").cast("string")
    written = F.date_format(
        F.timestamp_add("SECOND", F.col("time_stamp"), F.expr("timestamp_ntz'1970-01-01 00:00:00'")),
        "yyyy-MM-dd'T'HH:mm:ss'Z'",
    )

    def fields(text_epoch: Column | None, other_name: bool, *more: Column) -> Column:
        email = F.col("email_address").alias("email")
        return F.to_json(F.struct(*[
            text_epoch.alias(name) if name == "time_stamp" and text_epoch is not None
            else email if name == "email_address" and other_name else F.col(name)
            for name in schemas.LOG_FIELDS
        ], *more))

    number = F.col("id").cast("bigint")
    return (
        F.when(number % 43 == 0, fields(digits, False))
        # Milliseconds are not written out.
        .when((number % 67 == 0) & (number % 13 != 0), fields(written, False))
        .when(number % 71 == 0, fields(None, False, F.lit("spring").alias("campaign")))
        .when(number % 3 == 1, fields(None, True))
        .otherwise(fields(None, False))
    )


def _malformed(events: DataFrame) -> DataFrame:
    """Broken lines beside the good ones: cut off, plain text, an array, empty, null."""
    event = F.col("event_id")
    text = event.cast("string")
    kind = F.floor(event / MALFORMED_EVERY) % 5
    line = (
        F.when(kind == 0, F.concat(F.lit('{"id":"'), text, F.lit('"')))
        .when(kind == 1, F.concat(F.lit("not json "), text))
        .when(kind == 2, F.concat(F.lit('[{"id":"'), text, F.lit('"},{"id":"x"}]')))
        .when(kind == 3, "")
        .otherwise("null")
    )
    return events.where(event % MALFORMED_EVERY == 0).select(line.alias("value"))


def messages(spark: SparkSession, sf_dir: str, part: str, split_at: str) -> DataFrame:
    """JSON text messages of one of ``PARTS``, with the malformed lines of that part."""
    events = _events(spark, sf_dir, part, split_at)
    records = _records(spark, sf_dir, events)
    lines = records.select(_line().alias("value"))
    return lines if part == "replay" else lines.unionByName(_malformed(events))


def ip_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One /16 range per nation."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    start = (F.lit(10 * 256) + F.col("n_nationkey").cast("bigint")) * 65_536
    joined = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.select(
        start.alias("ip_from"),
        (start + 65_535).alias("ip_to"),
        F.col("n_name").alias("country_name"),
        F.substring("n_name", 1, 2).alias("country_short"),
        F.col("r_name").alias("region_name"),
        F.lit(None).cast("string").alias("city_name"),
    )


def odd_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ranges of ``ip_ranges`` with narrower ones of the suppliers inside of them, some
    that lie apart, some repeated and some that end before they begin."""
    number, nation = F.col("s_suppkey").cast("bigint"), F.col("s_nationkey").cast("bigint")
    apart = F.when(number % 4 == 0, (F.lit(11 * 256) + number % 200) * 65_536)
    start = F.coalesce(apart, (F.lit(10 * 256) + nation) * 65_536) + number * 977 % 60_000
    length = F.when(number % 10 == 0, -256).otherwise((number % 3 + 1) * 256)
    own = table(spark, sf_dir, "supplier").select(
        start.alias("ip_from"), (start + length - 1).alias("ip_to"), number.alias("_n")
    )
    again = own.where(F.col("_n") % 7 == 0)
    both = own.unionByName(again).drop("_n")
    return ip_ranges(spark, sf_dir).select("ip_from", "ip_to").unionByName(both)


def topic_offsets(spark: SparkSession, sf_dir: str, as_of: str, partitions: int = 5) -> DataFrame:
    """Events as topics: written offsets per partition, and those read by ``as_of``."""
    read = F.col("ts") < F.lit(as_of).cast("timestamp_ntz")
    counted = table(spark, sf_dir, "events").groupBy(
        F.col("event_type").alias("topic"),
        (F.col("event_id") % partitions).cast("int").alias("partition"),
    ).agg(F.count("*").alias("end_offset"), F.count_if(read).alias("read"))
    # The last partition was never committed.
    committed = F.when(F.col("partition") < partitions - 1, F.col("read"))
    return counted.select("topic", "partition", "end_offset", committed.alias("committed_offset"))
