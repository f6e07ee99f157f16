"""Insert-if-absent: keep the rows of a batch whose key the table does not hold yet."""

from __future__ import annotations

from pyspark.sql import DataFrame


def absent_rows(rows: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Rows (unique on ``key``) whose key is not in ``existing``.

    Rows that were grouped by the key are already partitioned by it.
    """
    return rows.join(existing.select(key), key, "left_anti")


def held_keys(existing: DataFrame, batch_keys: DataFrame) -> DataFrame:
    """The keys of ``existing`` that a batch has too.

    The batch is counted (it is kept or written by then), so the engine sends its keys to
    a long history when they are few and meets them by shuffle when they are many.
    """
    key = batch_keys.columns[0]
    return existing.select(key).join(batch_keys, key, "left_semi")


def held_in_buckets(existing: DataFrame, batch_keys: DataFrame) -> DataFrame:
    """The same for a history bucketed by its key.

    The batch's keys go to the buckets and are looked up there; the history streams past
    them where it lies, neither shuffled nor sorted.
    """
    return held_keys(existing, batch_keys.hint("shuffle_hash"))
