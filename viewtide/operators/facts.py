"""Fact rows: one per fact key, built without joins or through the dimension tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewtide import schemas
from viewtide.functions import dates, keys
from viewtide.operators import lookup, merge

FACT_COLUMNS = list(schemas.TABLES["fact_product_views"])


def _of_types(located: DataFrame, collections: Sequence[str] | None) -> DataFrame:
    if collections is None:
        return located
    return located.where(F.col("collection").isin(*collections))


def _project(rows: DataFrame, key_columns: Mapping[str, Column], *keep: str) -> DataFrame:
    """Fact columns before de-duplication, with the log id that orders copies."""
    epoch = F.col("time_stamp")
    return rows.select(
        F.col("id").alias("_log_id"),
        keys.fact_key(*key_columns.values(), epoch).alias("fact_id"),
        *[column.alias(name) for name, column in key_columns.items()],
        F.col("ip").alias("ip_address"),
        dates.event_time(epoch).alias("time_stamp"),
        "collection",
        "current_url",
        "referrer_url",
        *keep,
    )


def fact_rows(
    located: DataFrame, *keep: str, collections: Sequence[str] | None = None
) -> DataFrame:
    """Every view with its fact key, and the ``keep`` columns as they are.

    A dimension's key is the natural key itself, so looking it up returns what is
    already in the row; the lookups are left out.
    """
    return _project(
        _of_types(located, collections),
        {
            "product_id": keys.filled(F.col("product_id")),
            "store_id": keys.filled(F.col("store_id")),
            "location_id": F.col("loc_info.location_id"),
            "customer_id": keys.filled(F.col("device_id")),
            "date_id": dates.date_key(F.col("time_stamp")),
        },
        *keep,
    )


def first_per_fact(rows: DataFrame) -> DataFrame:
    """Keep the first copy of each fact key.

    Copies share the epoch (it is part of the key), so (event time, id) order is id
    order. The minimum combines on the map side: many copies of one key stay cheap.
    """
    rest = [name for name in FACT_COLUMNS if name != "fact_id"]
    first = rows.groupBy("fact_id").agg(F.min(F.struct("_log_id", *rest)).alias("_first"))
    return first.select("fact_id", *[F.col(f"_first.{name}") for name in rest])


def _hash() -> Column:
    return F.xxhash64("fact_id").alias("_hash")


def suspect_hashes(rows: DataFrame, known: DataFrame) -> DataFrame:
    """The 64-bit hashes ``_hash`` that the fact keys of several rows have, or of a row and a
    known fact: copies, or chance. Only hashes and counts are shuffled."""
    own = rows.select(_hash())
    repeated = own.groupBy("_hash").count().where(F.col("count") > 1).select("_hash")
    return repeated.unionByName(merge.held_keys(known.select(_hash()), own))


def new_facts(rows: DataFrame, known: DataFrame, suspects: DataFrame) -> DataFrame:
    """The first copy of each fact that is not known, of rows that are cheap to read twice.

    A row without one of the ``suspects`` (see ``suspect_hashes``; they are broadcast) has no
    copy and is not known, so it passes as it lies; only the others are sorted and shuffled.
    """

    def of(frame: DataFrame, how: str) -> DataFrame:
        return frame.select("*", _hash()).join(F.broadcast(suspects), "_hash", how)

    copies = first_per_fact(of(rows, "left_semi"))
    absent = merge.absent_rows(copies, of(known, "left_semi"), "fact_id")
    return of(rows, "left_anti").select(*FACT_COLUMNS).unionByName(absent)


def fact_product_views(
    located: DataFrame, collections: Sequence[str] | None = None
) -> DataFrame:
    return first_per_fact(fact_rows(located, collections=collections))


def fact_via_dim_joins(
    located: DataFrame,
    dimensions: Mapping[str, DataFrame],
    broadcast_bytes: int = lookup.BROADCAST_BYTES,
) -> DataFrame:
    """The fact with every key taken from its dimension by a left join.

    A key absent from its dimension table is NULL in the fact.
    """
    source = {
        "product_id": F.col("product_id"),
        "store_id": F.col("store_id"),
        "location_id": F.col("loc_info.location_id"),
        "customer_id": F.col("device_id"),
        "date_id": dates.date_key(F.col("time_stamp")),
    }
    keyed = located.select(
        *located.columns, *[column.alias(f"_{name}") for name, column in source.items()]
    )
    rows = keyed
    for name, table in schemas.FOREIGN_KEYS.items():
        known = dimensions[table].select(
            F.col(name).alias(f"_{name}"), F.col(name).alias(f"_dim_{name}")
        )
        rows = lookup.lookup(rows, known, f"_{name}", broadcast_bytes, keyed)
    return first_per_fact(_project(rows, {name: F.col(f"_dim_{name}") for name in source}))


def fk_orphans(fact: DataFrame, dimensions: Mapping[str, DataFrame]) -> DataFrame:
    """Per foreign key: keys and rows of the fact that its dimension does not hold.

    The fact is counted per key first, so each anti join sees a key once.
    """
    checks = None
    for name, table in schemas.FOREIGN_KEYS.items():
        used = fact.where(F.col(name).isNotNull()).groupBy(name).count()
        lost = used.join(dimensions[table].select(name), name, "left_anti").agg(
            F.lit(name).alias("foreign_key"),
            F.count("*").alias("orphan_keys"),
            F.coalesce(F.sum("count"), F.lit(0)).alias("orphan_rows"),
        )
        checks = lost if checks is None else checks.unionByName(lost)
    return checks
