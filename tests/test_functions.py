"""Scalar functions on edge values."""

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from viewtide.functions import dates, keys, web


def results(spark, column, values, kind):
    """The function's results for the values, in one job."""
    frame = spark.createDataFrame(list(enumerate(values)), f"n int, x {kind}").coalesce(1)
    got = frame.select("n", column(F.col("x")).alias("y")).collect()
    return [row["y"] for row in sorted(got, key=lambda row: row["n"])]


def check(spark, column, cases, kind="string"):
    values, want = zip(*cases)
    assert dict(zip(values, results(spark, column, values, kind))) == dict(zip(values, want))


EPOCHS = [
    (1716885082, dt.datetime(2024, 5, 28, 8, 31, 22), 20240528),
    (1716885082123, dt.datetime(2024, 5, 28, 8, 31, 22, 123000), 20240528),
    (9_999_999_999, dt.datetime(2286, 11, 20, 17, 46, 39), 22861120),
    (10_000_000_000, dt.datetime(1970, 4, 26, 17, 46, 40), 19700426),
    (0, dt.datetime(1970, 1, 1), None),
    (-86400, dt.datetime(1969, 12, 31), 19691231),
    (None, None, None),
    (2**63 - 1, None, None),
    (-(2**63), None, None),
]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_epochs_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        check(spark, dates.event_time, [(e, time) for e, time, _ in EPOCHS], "bigint")
        check(spark, dates.date_key, [(e, day) for e, _, day in EPOCHS], "bigint")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_calendar_at_year_end(spark):
    day = dt.date(2024, 12, 30)
    frame = spark.createDataFrame([(day,)], "d date")
    got = frame.select(*[c.alias(n) for n, c in dates.calendar(F.col("d")).items()]).first()
    assert got.asDict() == {
        "date_id": 20241230, "full_date": day, "date_of_week": "Monday",
        "date_of_week_short": "Mon", "is_weekday_or_weekend": "weekday", "day_of_month": 30,
        "day_of_year": 365, "week_of_year": 1, "quarter_number": 4, "year_number": 2024,
        "year_month": "202412",
    }


def test_weekend(spark):
    cases = [
        (dt.date(2024, 1, 5), "weekday"), (dt.date(2024, 1, 6), "weekend"),
        (dt.date(2024, 1, 7), "weekend"), (dt.date(2024, 1, 8), "weekday"),
    ]
    check(spark, lambda c: dates.calendar(c)["is_weekday_or_weekend"], cases, "date")


def test_local_clock(spark):
    cases = [
        ("2024-05-28 08:31:22", dt.datetime(2024, 5, 28, 8, 31, 22)),
        ("28/05/2024", None), ("2024-05-28", None), ("2024-13-01 00:00:00", None),
        ("2024-05-28T08:31:22", None), ("", None), (None, None),
    ]
    check(spark, dates.local_clock, cases)


def test_defined_keeps_the_text_unstripped(spark):
    cases = [
        ("\t ", "Not Defined"), ("", "Not Defined"), (None, "Not Defined"), (" a ", " a "),
    ]
    check(spark, keys.defined, cases)


def test_customer_key(spark):
    cases = [("", "-1"), (None, "-1"), (" ", " "), ("d1", "d1")]
    check(spark, keys.customer_key, cases)


def test_location_key_treats_null_as_empty(spark):
    rows = spark.createDataFrame([("Chile", None, "")], "a string, b string, c string")
    got = rows.select(keys.location_key(F.col("a"), F.col("b"), F.col("c")).alias("k")).first()["k"]
    assert got == hashlib.md5(b"Chile||").hexdigest()


@pytest.mark.parametrize("values,text", [
    (("p", "s", "l", "c", 20240528, 1716885082), "p_s_l_c_20240528_1716885082"),
    ((None, None, None, None, None, 0), "NA_NA_NA_NA_NA_0"),
    ((None, "s", None, "c", None, None), "NA_s_NA_c_NA"),
])
def test_fact_key(spark, values, text):
    frame = spark.createDataFrame(
        [values], "a string, b string, c string, d string, e int, f bigint"
    )
    got = frame.select(keys.fact_key(*[F.col(c) for c in "abcdef"]).alias("k")).first()["k"]
    assert got == hashlib.sha256(text.encode()).hexdigest()


def test_ipv4_number(spark):
    cases = [
        ("10.1.2.3", 167838211), ("0.0.0.0", 0), ("255.255.255.255", 4294967295),
        ("190.x.1.2", None), ("300.1.1.1", None), ("", None), (None, None), ("1.2.3", None),
        ("1.2.3.4.5", None), (" 1.2.3.4", None), ("1..3.4", None), ("::1", None),
    ]
    check(spark, web.ipv4_number, cases)


def test_url_host(spark):
    cases = [
        ("https://www.shop.example/a?b=c", "www.shop.example"),
        ("http://shop.example:8080/x", "shop.example"),
        ("http://a b/", None), ("not a url", None), ("", None), (None, None),
    ]
    check(spark, web.url_host, cases)


def test_families(spark):
    cases = [
        ("x (iPhone; like Mac OS X) Version/13.1 Mobile Safari/604.1", "Safari", "iOS"),
        ("x (Windows NT 10.0) Chrome/120 Safari/537.36 Edg/120", "Edge", "Windows"),
        ("x (Windows NT 10.0) Chrome/120 Safari/537.36", "Chrome", "Windows"),
        ("x (X11; Linux x86_64) Firefox/121.0", "Firefox", "Linux"),
        ("x (Linux; Android 13) Chrome/119 Mobile Safari/537.36", "Chrome", "Android"),
        ("Not Defined", "Other", "Other"),
    ]
    check(spark, web.browser_family, [(a, b) for a, b, _ in cases])
    check(spark, web.os_family, [(a, o) for a, _, o in cases])
