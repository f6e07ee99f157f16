"""Parsing, lookup joins, dimensions, fact and merge on small literal rows."""

import datetime as dt
import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from viewtide import schemas
from viewtide.operators import dims, facts, geo, intervals, lookup, merge, parse

SLOW = settings(
    max_examples=5, deadline=None, derandomize=True,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
T0 = 1716885082  # 2024-05-28 08:31:22


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


# -- parse -----------------------------------------------------------------------------


def test_rejects(messages_of):
    values = ["not json", "null", '[{"id":"1"},{"id":"2"}]', '{"id":"1"', "", None, '"x"', "5",
              '{"id":"1",}', '{"a":{"b":[1,2}']
    messages = messages_of(*values, "{}")
    assert parse.parse_logs(messages).count() == 1
    assert rows(parse.parse_rejects(messages)) == sorted([(v,) for v in values], key=str)


def test_parsed_fields(messages_of):
    def log(value):
        return parse.parse_logs(messages_of(value)).first().asDict(recursive=True)

    assert all(v is None for v in log("{}").values())
    assert log('{"id":"1"} tail')["id"] == "1"
    assert log('{"product_id":96672}')["product_id"] == "96672"
    assert log('{"time_stamp":"1716885082"}')["time_stamp"] == T0
    assert log('{"time_stamp":1716885082}')["time_stamp"] == T0
    assert log('{"time_stamp":"soon"}')["time_stamp"] is None
    for text in ("2024-05-28T08:31:22Z", "2024-05-28 08:31:22", "2024-05-28T08:31:22.987Z",
                 "2024-05-28T10:31:22+02:00", "2024-05-28T08:31:22.5"):
        assert log(json.dumps({"time_stamp": text}))["time_stamp"] == T0
    assert log('{"time_stamp":"1969-12-31T23:59:59.5"}')["time_stamp"] == -1
    for text in ("2024-05-28", "2024-05-28T08:31Z", "2024-13-28T08:31:22Z", "28/05/2024 08:31", "2024-05-28T08:31:22 pm"):
        assert log(json.dumps({"time_stamp": text}))["time_stamp"] is None
    assert log('{"email":"a@b.example"}')["email_address"] == "a@b.example"
    both = '{"email":"a@b.example","email_address":"c@d.example"}'
    assert log(both)["email_address"] == "c@d.example"
    odd = log('{"option":"x","id":"7","unknown":1}')
    assert odd["option"] is None and odd["id"] == "7"
    assert log('{"option":[{"option_id":"1","option_label":"gold"}]}')["option"] == [
        {"option_id": "1", "option_label": "gold"}
    ]


def test_written_times_do_not_depend_on_the_session_zone(spark, messages_of):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        messages = messages_of(*[json.dumps({"time_stamp": t}) for t in (
            "2024-05-28T08:31:22", "2024-05-28T08:31:22Z", "2024-05-28T17:31:22+09:00")])
        assert {r["time_stamp"] for r in parse.parse_logs(messages).collect()} == {T0}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_key_counts(messages_of):
    messages = messages_of('{"id":1,"new":2,"id":3}', '{"id":"x","email":"e"}', "[1]", "", '{"new":null}')
    assert rows(parse.key_counts(messages)) == [("email", True, 1), ("id", True, 2), ("new", False, 2)]


def test_binary_messages(spark):
    frame = spark.createDataFrame([(bytearray('{"id":"é"}'.encode()),)], "value binary")
    assert parse.parse_logs(frame).first()["id"] == "é"


@SLOW
@given(st.lists(st.recursive(
    st.none() | st.booleans() | st.integers(-99, 99) | st.text("ab{}[]\" ,:", max_size=4),
    lambda inner: st.lists(inner, max_size=3) | st.dictionaries(st.text("ab", max_size=2), inner, max_size=3),
    max_leaves=6,
), min_size=1, max_size=20), st.integers(0, 5))
def test_is_log_is_being_one_complete_object(spark, messages_of, values, cut):
    texts = [json.dumps(v) for v in values]
    texts += [t[: len(t) - 1 - cut % max(len(t), 1)] for t in texts]

    def whole_object(text):
        try:
            return isinstance(json.loads(text), dict)
        except ValueError:
            return False

    frame = messages_of(*texts).select("value", parse.is_log(F.col("value")).alias("ok"))
    assert {r["value"]: r["ok"] for r in frame.collect()} == {t: whole_object(t) for t in texts}


def test_raw_landing(logs_of):
    logs = logs_of(
        {"id": "1", "local_time": "2024-05-28 08:31:22", "option": [("1", "gold")]},
        {"id": "2", "local_time": "28/05/2024"},
    )
    landed = {r["id"]: r for r in parse.raw_log_landing(logs).collect()}
    assert landed["1"]["local_time"] == dt.datetime(2024, 5, 28, 8, 31, 22)
    assert landed["1"]["option"] == '[{"option_id":"1","option_label":"gold"}]'
    assert landed["2"]["local_time"] is None and landed["2"]["option"] is None


# -- intervals ---------------------------------------------------------------------------


def test_audit_of_ranges(spark):
    wide = 1 << 20
    bounds = [(10, 19), (12, 15), (20, 29), (29, 40), (50, 49), (wide, 3 * wide), (wide + 70_000, wide + 70_009),
              (3 * wide + 5, 3 * wide + 5), (3 * wide + 5, 3 * wide + 5)]
    frame = spark.createDataFrame(bounds, "ip_from long, ip_to long")
    assert rows(intervals.audit(frame)) == sorted([
        ("inverted", 50, 49), ("overlap", 12, 15), ("overlap", 29, 29), ("gap", 41, wide - 1),
        ("overlap", wide + 70_000, wide + 70_009), ("gap", 3 * wide + 1, 3 * wide + 4),
        ("overlap", 3 * wide + 5, 3 * wide + 5)], key=str)
    assert intervals.audit(frame.limit(0)).count() == 0


# -- lookup and geo --------------------------------------------------------------------


def test_spread_left_join_equals_left_join(spark):
    """A third of the rows have one key, another third none."""
    left = spark.range(900, numPartitions=6).select(
        "id",
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id") % 40))
        .alias("k"),
    )
    right = spark.createDataFrame(
        [("hot", 1, None), ("k1", 2, "a"), ("k7", None, None), ("unused", 3, "b")],
        "k string, v int, w string",
    )
    want = left.join(right, "k", "left").select("id", "k", "v", "w")
    for hot_rows in (1, 20, 100, 10_000):
        hot = lookup.hot_entries(left, right, "k", hot_rows)
        got = lookup.spread_left_join(left, right, "k", hot)
        assert rows(got) == rows(want)


def test_spread_left_join_spreads_hot_and_null_keys(spark):
    left = spark.range(8000, numPartitions=40).select(
        "id", F.when(F.col("id") % 2 == 0, "hot").alias("k")
    )
    right = spark.createDataFrame([("hot", 1)], "k string, v int")
    hot = lookup.hot_entries(left, right, "k", 100)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = lookup.spread_left_join(left, right, "k", hot)
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(sizes) == 4 and max(r["count"] for r in sizes) < 4000


def test_measured_bytes_counts_text(spark):
    frame = spark.createDataFrame([("abc", 1), (None, 2)], "t string, n int")
    assert lookup.measured_bytes(frame) == 2 * (32 + 16) + 3
    assert lookup.fits_broadcast(frame, 99) and not lookup.fits_broadcast(frame, 98)
    assert lookup.measured_bytes(frame.where("false")) == 0


def naive(logs, ranges):
    located = geo.locations(ranges)
    number = geo.web.ipv4_number(F.col("ip"))
    return logs.join(located, number.between(F.col("ip_from"), F.col("ip_to")), "left").select(
        "id", "loc_info"
    )


RANGES = st.lists(
    st.tuples(st.integers(0, 3), st.sampled_from([0, 1, 5, 200, 255, 256, 300, 65535, 65536, 200_000])),
    min_size=1, max_size=12,
)


@SLOW
@given(RANGES, st.lists(st.integers(0, 900_000), min_size=1, max_size=40))
def test_locator_equals_range_join(spark, logs_of, gaps, offsets):
    """Narrow, exact and wide ranges, through both join strategies."""
    base, ranges, start = 10 * 2**24 - 70_000, [], 10 * 2**24 - 70_000
    for number, (gap, length) in enumerate(gaps):
        ranges.append((start + gap, start + gap + length, f"C{number}", "C", None, "x"))
        start += gap + length + 1
    edges = [r[0] for r in ranges] + [r[1] for r in ranges] + [r[1] + 1 for r in ranges]
    ips = [base + o for o in offsets] + edges
    text = [".".join(str(ip >> shift & 255) for shift in (24, 16, 8, 0)) for ip in ips]
    text += [None, "", "300.1.1.1", "junk", "junk", "junk"]
    logs = logs_of(*[{"id": str(i), "ip": ip} for i, ip in enumerate(text)])
    table = spark.createDataFrame(ranges, schemas.IP_RANGES)
    want = rows(naive(logs, table))
    near, far = geo.IpLocator(table), geo.IpLocator(table, broadcast_bytes=0)
    assert near.broadcasts and not far.broadcasts
    assert rows(near.enrich(logs).select("id", "loc_info")) == want
    assert rows(far.enrich(logs, hot_rows=2).select("id", "loc_info")) == want


# -- dimensions ------------------------------------------------------------------------


def test_first_write_wins(logs_of):
    logs = logs_of(
        {"id": "2", "device_id": "d", "time_stamp": T0 + 5, "user_agent": "late"},
        {"id": "9", "device_id": "d", "time_stamp": T0 * 1000, "user_agent": "first"},
        {"id": "1", "device_id": "", "time_stamp": T0, "email_address": "\t ", "resolution": "1x1"},
        {"id": "3", "time_stamp": T0 + 1, "user_id_db": "u"},
        {"id": "4", "time_stamp": T0, "device_id": ""},
    )
    assert rows(dims.dim_customer(logs)) == [
        ("-1", "Not Defined", "Not Defined", "Not Defined", "1x1"),
        ("d", "Not Defined", "first", "Not Defined", "Not Defined"),
    ]


def test_key_only_dimensions(logs_of):
    logs = logs_of(
        {"product_id": "p", "store_id": "8", "time_stamp": T0},
        {"product_id": "p", "store_id": "", "time_stamp": 0},
        {"product_id": "", "store_id": None},
    )
    assert [r["product_id"] for r in dims.dim_product(logs).collect()] == ["p"]
    assert rows(dims.dim_store(logs)) == [("8", "Store 8")]
    assert [r["date_id"] for r in dims.dim_date(logs).collect()] == [20240528]


# -- fact ------------------------------------------------------------------------------


def located(spark, logs):
    ranges = spark.createDataFrame(
        [(167772160, 184549375, "Chile", "CL", "R", None)], schemas.IP_RANGES
    )
    return geo.geo_enrich(logs, ranges)


def test_fact_keeps_the_first_copy(spark, logs_of):
    same = {"product_id": "p", "store_id": "s", "device_id": "d", "time_stamp": T0}
    logs = logs_of(
        {"id": "b", "ip": "9.9.9.9", "referrer_url": "second", **same},
        {"id": "a", "ip": "8.8.8.8", "referrer_url": "first", **same},
        {"id": "c", "ip": "10.0.0.1", "referrer_url": "located", **same},
        {"id": None, "time_stamp": T0},
    )
    fact = facts.fact_product_views(located(spark, logs))
    assert fact.count() == 3
    got = {r["referrer_url"]: r for r in fact.collect()}
    assert got["first"]["ip_address"] == "8.8.8.8" and got["first"]["date_id"] == 20240528
    assert got["located"]["location_id"] and got["first"]["location_id"] is None
    assert got[None]["time_stamp"] == dt.datetime(2024, 5, 28, 8, 31, 22)


def test_fact_without_device_has_no_customer(spark, logs_of):
    logs = logs_of({"id": "1", "device_id": "", "user_agent": "x", "time_stamp": 0})
    row = facts.fact_product_views(located(spark, logs)).first()
    assert row["customer_id"] is None and row["date_id"] is None
    assert dims.dim_customer(logs).first()["customer_id"] == "-1"


def test_fact_of_chosen_log_types(spark, logs_of):
    logs = logs_of({"id": "1", "collection": "view"}, {"id": "2", "collection": "click", "store_id": "1"})
    fact = facts.fact_product_views(located(spark, logs), collections=["view"])
    assert [r["collection"] for r in fact.collect()] == ["view"]


IDS = st.sampled_from([None, "", "a", "b", "a_b", "NA"])
LOGS = st.lists(st.fixed_dictionaries({
    "product_id": IDS, "store_id": IDS, "device_id": IDS,
    "ip": st.sampled_from([None, "10.0.0.1", "8.8.8.8", "x"]),
    "time_stamp": st.sampled_from([None, 0, T0, T0 + 1, T0 * 1000]),
    "id": st.sampled_from([None, "1", "2", "3"]), "user_agent": st.sampled_from([None, "", "u", "v"]),
}), min_size=1, max_size=25)


@settings(SLOW, max_examples=3)
@given(LOGS)
def test_fact_properties(spark, logs_of, records):
    logs = logs_of(*records)
    here = located(spark, logs)
    fact = rows(facts.fact_product_views(here))
    # Sending everything twice changes nothing.
    assert rows(facts.fact_product_views(here.unionByName(here))) == fact
    # Taking the keys from the dimension tables gives the same, broadcast or spread.
    tables = {name: build(here) for name, build in dims.BUILDERS.items()}
    assert rows(facts.fact_via_dim_joins(here, tables)) == fact
    orphans = facts.fk_orphans(facts.fact_product_views(here), tables)
    assert all(r["orphan_rows"] == 0 for r in orphans.collect())
    assert rows(dims.dim_customer(here.unionByName(here))) == rows(dims.dim_customer(here))


def test_join_form_through_the_shuffle(spark, logs_of):
    records = [{"id": str(i), "device_id": "d" if i % 3 else None, "store_id": str(i % 4),
                "product_id": str(i), "time_stamp": T0 + i, "ip": "10.0.0.1"} for i in range(40)]
    here = located(spark, logs_of(*records))
    tables = {name: build(here) for name, build in dims.BUILDERS.items()}
    assert rows(facts.fact_via_dim_joins(here, tables, broadcast_bytes=0)) == rows(
        facts.fact_product_views(here)
    )


def test_join_form_leaves_unknown_keys_null(spark, logs_of):
    here = located(spark, logs_of({"id": "1", "product_id": "p", "store_id": "s"}))
    tables = {name: build(here) for name, build in dims.BUILDERS.items()}
    tables["dim_store"] = tables["dim_store"].where("false")
    row = facts.fact_via_dim_joins(here, tables).first()
    assert row["product_id"] == "p" and row["store_id"] is None


# -- merge -----------------------------------------------------------------------------


def test_absent_rows(spark):
    new = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "k string, v int")
    old = spark.createDataFrame([("b", 9), ("z", 9)], "k string, v int")
    held = merge.held_keys(old, new.select("k"))
    assert rows(held) == [("b",)]
    assert rows(merge.absent_rows(new, held, "k")) == [("a", 1), ("c", 3)]


def test_undated_rows_come_last(logs_of):
    logs = logs_of(
        {"id": "1", "device_id": "d", "user_agent": "untimed"},
        {"id": "2", "device_id": "d", "time_stamp": 0, "user_agent": "zero"},
        {"id": "3", "device_id": "d", "time_stamp": T0, "user_agent": "timed"},
        {"id": "4", "device_id": "e", "time_stamp": 0, "user_agent": "zero"},
        {"id": "5", "device_id": "e", "user_agent": "untimed"},
    )
    got = {r["customer_id"]: r["user_agent"] for r in dims.dim_customer(logs).collect()}
    assert got == {"d": "timed", "e": "zero"}


def test_ranges_are_measured_as_filed(spark):
    """What is sent, with its hashes and a row per block, not the ranges as given."""
    table = spark.createDataFrame(
        [(n * 200, n * 200 + 199, "Land", "LA", "Region", "City") for n in range(2000)], schemas.IP_RANGES)
    locator = geo.IpLocator(table)
    assert locator.filed_bytes > 2 * lookup.measured_bytes(table)
    assert not geo.IpLocator(table, broadcast_bytes=locator.filed_bytes - 1).broadcasts
    assert geo.IpLocator(table, broadcast_bytes=locator.filed_bytes).broadcasts
