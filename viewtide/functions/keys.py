"""Natural and hashed keys of the star schema."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values written into the star tables.
NO_DEVICE = "-1"
UNDEFINED = "Not Defined"
MISSING_KEY = "NA"


def filled(text: Column) -> Column:
    """The text itself, with the empty string as NULL."""
    return F.nullif(text, F.lit(""))


def customer_key(device_id: Column) -> Column:
    return F.coalesce(filled(device_id), F.lit(NO_DEVICE))


def defined(text: Column) -> Column:
    """The unchanged text, or a placeholder when it is NULL or only white space."""
    return F.when(text.rlike(r"\S"), text).otherwise(F.lit(UNDEFINED))


def store_name(store_id: Column) -> Column:
    return F.concat(F.lit("Store "), store_id)


def location_key(country: Column, region: Column, city: Column) -> Column:
    parts = [F.coalesce(part, F.lit("")) for part in (country, region, city)]
    return F.md5(F.concat_ws("|", *parts))


def fact_key(
    product: Column,
    store: Column,
    location: Column,
    customer: Column,
    date: Column,
    epoch: Column,
) -> Column:
    """SHA-256 over the five dimension keys and the epoch as it was sent.

    ``concat_ws`` leaves a NULL epoch out, so a key without one ends in its date part.
    """
    keys = [
        F.coalesce(key.cast("string"), F.lit(MISSING_KEY))
        for key in (product, store, location, customer, date)
    ]
    return F.sha2(F.concat_ws("_", *keys, epoch.cast("string")), 256)
