"""Batch load, replay, streams against batch, reports, health and plan shapes."""

import datetime as dt
import json
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from viewtide import registry, schemas
from viewtide.operators import dims, facts, geo, merge, parse
from viewtide.plans import health, load, partials, reports, table_functions
from viewtide.session import new_scratch, stateful_session
from viewtide.sources.jdbc import JdbcDatabase, Split
from viewtide.sources.messages import KafkaTopic, read_message_stream, read_messages, write_messages
from viewtide.sources.ranges import read_ip_ranges
from viewtide.sources.warehouse import Warehouse
from viewtide.streaming import jobs, progress

T0 = 1716885082  # 2024-05-28 08:31:22
DAY = "2024-05-28"


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def contents(warehouse):
    return {name: rows(warehouse.with_batches(name)) for name in schemas.TABLES}


@pytest.fixture(scope="module")
def locator(spark):
    ranges = [(167772160, 167837695, "Chile", "CL", "R", None), (167837696, 167903231, "Peru", "PE", "R", "Lima")]
    return geo.IpLocator(spark.createDataFrame(ranges, schemas.IP_RANGES))


@pytest.fixture
def warehouse(spark):
    return Warehouse(spark, new_scratch(spark, "test"))


def view(number, **fields):
    base = {"id": str(number), "device_id": f"d{number % 2}", "product_id": str(number % 3), "store_id": "1",
            "ip": f"10.{number % 2}.0.1", "time_stamp": T0 + number, "user_agent": f"agent{number}"}
    return json.dumps({**base, **fields})


@pytest.mark.parametrize("load_batch", [load.load_micro_batch, load.load_table_batch])
def test_replayed_and_overlapping_batches(messages_of, warehouse, locator, load_batch):
    first = messages_of(*[view(n) for n in range(4)], "broken")
    second = messages_of(*[view(n) for n in range(2, 8)], view(9, device_id="d0", user_agent="new"))
    assert load_batch(warehouse, first, locator, 0) == 5
    after_first = contents(warehouse)
    load_batch(warehouse, first, locator, 0)
    assert contents(warehouse) == after_first
    load_batch(warehouse, second, locator, 1)
    after_second = contents(warehouse)
    load_batch(warehouse, second, locator, 1)
    assert contents(warehouse) == after_second
    # An earlier batch may be repeated as well.
    load_batch(warehouse, first, locator, 0)
    assert contents(warehouse) == after_second
    assert warehouse.table("fact_product_views").count() == 9
    customers = {r["customer_id"]: r["user_agent"] for r in warehouse.table("dim_customer").collect()}
    assert customers == {"d0": "agent0", "d1": "agent1"}
    assert rows(warehouse.table("log_rejects")) == [("broken",)]


def test_tables_are_written_in_zstd(spark, messages_of, warehouse):
    load.land_micro_batch(warehouse, messages_of(view(1), "broken"), 0)
    files = list(Path(warehouse.path("user_log_raw")).glob("run=0/part-*"))
    assert files and all(".zstd." in f.name for f in files)


def test_only_suspects_are_shuffled_whole(spark, messages_of):
    """Rows without a copy pass as they lie; copies and known facts meet by the whole key."""
    def of(*values):
        return facts.fact_rows(parse.parse_logs(messages_of(*values)).withColumn("loc_info", place))

    place = F.lit(None).cast("struct<location_id:string>")
    batch = [view(n) for n in range(9)] + [view(3), view(4, ip="10.9.9.9", id="0")]
    batch += [view(20, time_stamp=None), view(21, time_stamp=None, device_id="d0", product_id="2")]
    made, known = of(*batch).persist(), facts.first_per_fact(of(view(5), view(30))).persist()
    suspects = facts.suspect_hashes(made, known).persist()
    # 3 and 4 come again, 5 is known, 20 and 21 have the same keys.
    assert suspects.distinct().count() == 4
    want = rows(merge.absent_rows(facts.first_per_fact(made), known, "fact_id"))
    assert rows(facts.new_facts(made, known, suspects)) == want and len(want) == 9
    # All hashes alike: the keys still decide.
    everything = made.select(F.xxhash64("fact_id").alias("_hash"))
    assert rows(facts.new_facts(made, known, everything)) == want
    for limit in (0, 1 << 20):
        with load._new_facts(made, known, limit) as new:
            assert rows(new) == want


def test_a_batch_loaded_again_sends_no_hashes_of_its_facts(spark):
    """A million known facts: their hashes would fill the driver."""
    fields = schemas.TABLES["fact_product_views"]
    key = F.concat(F.lit("f"), F.col("id").cast("string")).alias("fact_id")
    nulls = [F.lit(None).cast(kind).alias(name) for name, kind in fields.items() if name != "fact_id"]

    def of(n):
        return spark.range(n).select(F.col("id").cast("string").alias("_log_id"), key, *nulls)

    with load._new_facts(of(1_000_100), of(1_000_000).select(*facts.FACT_COLUMNS)) as new:
        assert "_hash" not in plan(new) and new.count() == 100


def test_without_broadcast(spark, messages_of, warehouse, locator):
    far = geo.IpLocator(spark.createDataFrame(
        [(167772160, 167837695, "Chile", "CL", "R", None)], schemas.IP_RANGES), broadcast_bytes=0)
    load.load_table_batch(warehouse, messages_of(view(0), view(1)), far, 0)
    assert warehouse.table("fact_product_views").where("location_id IS NOT NULL").count() == 1


def test_views_without_a_date(messages_of, warehouse, locator):
    batch = messages_of(view(0, time_stamp=0), view(1, time_stamp=None), view(2))
    load.load_micro_batch(warehouse, batch, locator, 0)
    load.load_micro_batch(warehouse, batch, locator, 1)
    fact = warehouse.with_batches("fact_product_views")
    assert rows(fact.select("date_id", "batch_id")) == [(20240528, 0), (None, 0), (None, 0)]


def test_empty_batch_is_skipped(messages_of, warehouse, locator):
    assert load.load_micro_batch(warehouse, messages_of("x").where("false"), locator, 0) == 0
    assert warehouse.table("fact_product_views").count() == 0


def test_failed_batch_releases_its_rows(spark, messages_of, warehouse, locator, monkeypatch):
    def fail(*_):
        raise RuntimeError("no table")

    monkeypatch.setattr(load, "_merge_batch", fail)
    before = set(spark.sparkContext._jsc.getPersistentRDDs())
    with pytest.raises(RuntimeError):
        load.load_micro_batch(warehouse, messages_of(view(0)), locator, 0)
    assert set(spark.sparkContext._jsc.getPersistentRDDs()) <= before


def test_closing_survives_replays(spark, messages_of, warehouse, locator):
    batches = [messages_of(view(n), view(n + 10), view(n, time_stamp=None)) for n in range(4)]
    for number, batch in enumerate(batches[:3]):
        load.load_micro_batch(warehouse, batch, locator, number)
    before = contents(warehouse)
    assert warehouse.close() == 1 and warehouse.close() == 1
    assert contents(warehouse) == before
    fact = warehouse.with_runs("fact_product_views")
    assert {r["run"] for r in fact.select("run").distinct().collect()} == {-2, 2}
    # The newest batch may be repeated by its stream; repeating a closed one changes nothing.
    for number in (2, 0):
        load.load_micro_batch(warehouse, batches[number], locator, number)
        assert contents(warehouse) == before
    warehouse.sweep()
    assert warehouse.runs("fact_product_views") == {-2, 2}
    assert warehouse.runs("dim_customer") <= {-2, 2}
    assert contents(warehouse) == before
    load.load_micro_batch(warehouse, batches[3], locator, 3)
    warehouse.close()
    assert warehouse.runs("fact_product_views") == {-3, -2, 2, 3}
    plain = Warehouse(spark, new_scratch(spark, "plain"))
    for number, batch in enumerate(batches):
        load.load_micro_batch(plain, batch, locator, number)
    sketchless = lambda w: {n: r for n, r in contents(w).items() if n != "view_partials"}
    assert sketchless(warehouse) == sketchless(plain)
    assert rows(partials.all_counts(warehouse)) == rows(partials.all_counts(plain))


@pytest.mark.parametrize("died_at", range(3))
def test_a_closing_that_died_is_not_seen(messages_of, warehouse, locator, monkeypatch, died_at):
    """It has written some tables but no mark; a later one closes more than it would have."""
    for number in range(2):
        load.load_micro_batch(warehouse, messages_of(view(number)), locator, number)
    before, write, done = contents(warehouse), Warehouse._overwrite, []

    def dying(self, table, frame, run):
        if run < 0 and len(done) == died_at * 4:
            raise RuntimeError("died")
        done.append(table)
        write(self, table, frame, run)

    monkeypatch.setattr(Warehouse, "_overwrite", dying)
    with pytest.raises(RuntimeError):
        warehouse.close()
    monkeypatch.setattr(Warehouse, "_overwrite", write)
    assert warehouse.closed() == -1 and contents(warehouse) == before
    load.load_micro_batch(warehouse, messages_of(view(2)), locator, 2)
    before = contents(warehouse)
    assert warehouse.close() == 1 and contents(warehouse) == before
    warehouse.sweep()
    assert contents(warehouse) == before and warehouse.runs("fact_product_views") == {-2, 2}


def test_tables_are_found_by_another_session(spark, messages_of, warehouse, locator):
    """What a session has entered into its catalog another one finds in the folders."""
    load.load_micro_batch(warehouse, messages_of(view(0), view(1)), locator, 0)
    want = rows(warehouse.table("dim_customer"))
    spark.sql(f"DROP TABLE {warehouse._bucketed('dim_customer', spark)}")
    again = Warehouse(spark, warehouse.root)
    assert rows(again.table("dim_customer")) == want
    load.load_micro_batch(again, messages_of(view(0), view(2, device_id="new")), locator, 1)
    assert len(rows(again.table("dim_customer"))) == 3


def test_a_day_opens_its_folders_only(spark, messages_of, warehouse, locator):
    fact = spark.createDataFrame(
        [(f"f{n}", 20240500 + n % 3) for n in range(30)], "fact_id string, date_id int")
    fields = schemas.TABLES["fact_product_views"]
    whole = fact.selectExpr(*[n if n in fact.columns else f"CAST(NULL AS {k}) AS {n}" for n, k in fields.items()])
    for number in range(6):
        warehouse.write_batch(
            "fact_product_views", whole.withColumn("fact_id", F.concat("fact_id", F.lit(number))), number)
    warehouse.close(3)
    day = warehouse.table("fact_product_views", [20240501])
    files = day.inputFiles()
    assert all("date_id=20240501/" in f for f in files)
    live = day.where("date_id = 20240501")
    assert "PartitionFilters" in plan(live) and live.count() == 60
    assert warehouse.table("fact_product_views").count() == 180
    assert warehouse.before("fact_product_views", 5).count() == 150
    assert warehouse.table("fact_product_views", [20200101]).count() == 0


def test_history_of_customers_is_not_shuffled(messages_of, warehouse, locator, spark):
    load.load_micro_batch(warehouse, messages_of(*[view(n, device_id=f"d{n}") for n in range(30)]), locator, 0)
    logs = parse.parse_logs(messages_of(view(3, device_id="d3"), view(99, device_id="new")))
    new = dims.dim_customer(logs)
    held = merge.held_in_buckets(warehouse.before("dim_customer", 1), new.select("customer_id"))
    text = plan(held)
    assert "Bucketed: true" in text and "ShuffledHashJoin" in text and "Sort" not in text
    # The history is the left side, printed first: nothing but its scan stands below the join.
    history = text[text.index("ShuffledHashJoin") : text.index("FileScan")]
    assert "Exchange" not in history
    assert [r["customer_id"] for r in held.collect()] == ["d3"]
    added = merge.absent_rows(new, held, "customer_id")
    assert [r["customer_id"] for r in added.collect()] == ["new"]


# -- kept reports ------------------------------------------------------------------------

KEPT = ["top_products", "top_countries", "hourly_traffic", "user_agents", "top_referrers", "browser_os_hourly"]


@pytest.mark.parametrize("load_batch", [load.load_micro_batch, load.load_table_batch])
def test_kept_reports_equal_those_of_the_fact(messages_of, warehouse, locator, load_batch):
    batches = [
        messages_of(*[view(n) for n in range(6)], "broken"),
        messages_of(*[view(n) for n in range(3, 12)], view(12, device_id="", product_id=None),
                    view(13, ip="8.8.8.8"), view(14, time_stamp=T0 + 90_000), view(15, time_stamp=None)),
        messages_of(view(1), view(20, time_stamp=T0 + 4000, user_agent="Firefox/121")),
    ]

    def check():
        for name in KEPT:
            kept, own = (getattr(m, name)(warehouse, DAY).collect() for m in (partials, reports))
            assert [tuple(r) for r in kept] == [tuple(r) for r in own]
        for arguments in (("Peru",), ("Atlantis",)):
            assert rows(partials.stores_by_country(warehouse, *arguments, DAY)) == rows(
                reports.stores_by_country(warehouse, *arguments, DAY))
        for product in ("1", "no such"):
            assert rows(partials.product_hourly(warehouse, product, DAY)) == rows(
                reports.product_hourly(warehouse, product, DAY))
        views = reports.views_of_day(warehouse, DAY)
        exact = views.groupBy(F.hour("time_stamp").alias("h")).agg(F.countDistinct("customer_id"))
        assert rows(partials.hourly_customers(warehouse, DAY)) == rows(exact)

    check()
    for number, batch in enumerate(batches):
        load_batch(warehouse, batch, locator, number)
        check()
        load_batch(warehouse, batch, locator, number)
        check()
    load_batch(warehouse, batches[0], locator, 0)
    check()
    warehouse.close()
    warehouse.sweep()
    check()


def test_kept_reports_scan_partials_only(spark, sf_dir):
    warehouse = registry.load_star(spark, sf_dir)
    key = registry.AS_OF.replace("-", "")
    for name in [*KEPT, "hourly_customers"]:
        frame = getattr(partials, name)(warehouse, registry.AS_OF)
        assert frame.inputFiles() and all(f"view_partials/date_id={key}/" in f for f in frame.inputFiles())


def test_kept_customers_are_exact(spark, warehouse, locator):
    """Thousands of them in an hour, some in both batches, some views without any."""
    def batch(begin, end):
        number = F.col("id")
        device = F.when(number % 10 > 0, F.concat(F.lit("d"), (number % 5000).cast("string")))
        fields = [number.cast("string").alias("id"), device.alias("device_id"), (F.lit(T0) + number % 5000 % 900).alias("time_stamp")]
        return spark.range(begin, end).select(F.to_json(F.struct(*fields)).alias("value"))

    load.load_table_batch(warehouse, batch(0, 3000), locator, 0)
    load.load_table_batch(warehouse, batch(2500, 6000), locator, 1)
    views = reports.views_of_day(warehouse, DAY)
    hour = F.hour("time_stamp").alias("view_hour")
    exact = rows(views.groupBy(hour).agg(F.countDistinct("customer_id")))
    assert exact == [(8, 4500)]
    assert rows(partials.hourly_customers(warehouse, DAY)) == exact
    table_functions.register(warehouse)
    assert rows(spark.sql(f"SELECT * FROM hourly_customers(DATE'{DAY}')")) == exact
    assert rows(partials.daily_customers(warehouse)) == [(20240528, 4500)]
    assert rows(partials.hourly_traffic(warehouse, DAY)) == rows(reports.hourly_traffic(warehouse, DAY))


def test_counts_are_kept_in_one_pass(spark, messages_of, warehouse, locator, monkeypatch):
    """The views of a batch are read and grouped once for all that is kept of them."""
    plans, write = [], Warehouse.write_batch

    def noted(self, table, frame, batch_id):
        if table == "view_partials":
            plans.append(plan(frame))
        write(self, table, frame, batch_id)

    monkeypatch.setattr(Warehouse, "write_batch", noted)
    load.load_table_batch(warehouse, messages_of(view(0), view(1)), locator, 0)
    assert len(plans) == 1 and plans[0].count("Union") == 1
    assert "Expand" not in plans[0] and "time_stamp" not in plans[0]
    assert plan(partials.counts_per_key(warehouse.table("fact_product_views"))).count("Expand") == 1


# -- streams ---------------------------------------------------------------------------


def test_stream_tables_equal_batch(spark, sf_dir):
    """All star tables after three restarts equal the batch builders."""
    warehouse, locator = Warehouse(spark, new_scratch(spark, "star")), registry._locator(spark, sf_dir)
    checkpoint = new_scratch(spark, "checkpoint")
    registry._stream_parts(
        spark, sf_dir,
        lambda s: jobs.start_star(s, warehouse, locator, checkpoint, registry.AT_ONCE, first_batch=5),
    )
    here = registry._located(spark, sf_dir)
    for name, build in dims.BUILDERS.items():
        assert rows(warehouse.table(name)) == rows(build(here))
    fact = warehouse.with_batches("fact_product_views")
    assert rows(fact.drop("batch_id")) == rows(facts.fact_product_views(here))
    assert {r["batch_id"] for r in fact.select("batch_id").distinct().collect()} == {5, 6}
    rejects = parse.parse_rejects(registry._messages(spark, sf_dir))
    assert rows(warehouse.table("log_rejects")) == rows(rejects)


def test_relay_keeps_every_byte(spark, messages_of):
    source, target = new_scratch(spark, "in"), new_scratch(spark, "out")
    lines = ['{"id":"é", "n": 1}', "not json", "", '{"id":"💍"}']
    messages_of(*lines).write.text(source)
    stream = read_message_stream(spark, source)
    query = jobs.start_relay(stream, target, new_scratch(spark, "cp"), {"availableNow": True})
    query.awaitTermination()
    counts = query.recentProgress[0].observedMetrics["messages"]
    assert (counts["row_count"], counts["reject_count"]) == (4, 2)
    assert sorted(r["value"] for r in spark.read.text(target).collect()) == sorted(lines)


def test_messages_are_written_compressed(spark, messages_of):
    """In files that a task can read whole, and each line as it was."""
    folder, target = new_scratch(spark, "in"), new_scratch(spark, "out")
    lines = [view(n) for n in range(20_001)] + ["", "not json", '{"id":"é"}']
    write_messages(messages_of(*lines).coalesce(1), folder)
    files = sorted(Path(folder).glob("part-*"))
    assert len(files) == 2 and all(f.name.endswith(".gz") for f in files)
    assert sum(f.stat().st_size for f in files) < sum(map(len, lines)) / 4
    assert sorted(r["value"] for r in read_messages(spark, folder).collect()) == sorted(lines)
    jobs.start_relay(
        read_message_stream(spark, folder), target, new_scratch(spark, "cp"), registry.AT_ONCE
    ).awaitTermination()
    assert sorted(r["value"] for r in read_messages(spark, target).collect()) == sorted(lines)


def test_topics_are_compressed(spark, sf_dir):
    topic = registry.write_topic(spark, sf_dir)
    files = list(Path(topic).glob("*/part-*"))
    assert files and all(f.name.endswith(".gz") for f in files)


def test_raw_landing_keeps_rejects(spark, messages_of, warehouse):
    source = new_scratch(spark, "in")
    messages_of(view(1), "broken", view(2)).write.text(source)
    stream = read_message_stream(spark, source)
    jobs.start_raw(stream, warehouse, new_scratch(spark, "cp"), registry.AT_ONCE).awaitTermination()
    assert sorted(r["id"] for r in warehouse.table("user_log_raw").collect()) == ["1", "2"]
    assert rows(warehouse.with_batches("user_log_raw_rejects")) == [("broken", 0)]


def test_stream_reader_limits_files(spark, messages_of):
    source = new_scratch(spark, "in")
    for number in range(3):
        messages_of(view(number)).coalesce(1).write.mode("append").text(source)
    sizes = []
    stream = read_message_stream(spark, source, maxFilesPerTrigger=1)
    query = (stream.writeStream.foreachBatch(lambda df, _: sizes.append(df.count()))
             .option("checkpointLocation", new_scratch(spark, "cp")).trigger(availableNow=True).start())
    query.awaitTermination()
    assert sizes == [1, 1, 1]


def test_a_micro_batch_reads_its_source_once(spark, messages_of, warehouse):
    """Also with ranges too big to broadcast, which need the addresses beforehand."""
    far = geo.IpLocator(spark.createDataFrame(
        [(167772160, 167837695, "Chile", "CL", "R", None)], schemas.IP_RANGES), broadcast_bytes=0)
    source = new_scratch(spark, "in")
    messages_of(*[view(n) for n in range(50)]).write.text(source)
    query = jobs.start_star(
        read_message_stream(spark, source), warehouse, far, new_scratch(spark, "cp"), registry.AT_ONCE)
    query.awaitTermination()
    assert sum(p["numInputRows"] for p in query.recentProgress) == 50
    assert warehouse.table("fact_product_views").count() == 50


def test_state_partitions_leave_other_sessions_alone(spark):
    own = stateful_session(spark, 3)
    assert own.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"


def test_late_copies_and_undated_logs(spark, messages_of, locator):
    """A copy within the delay is dropped by the state, one beyond it as late."""
    source, target, aside = (new_scratch(spark, n) for n in ("in", "out", "aside"))
    marks = new_scratch(spark, "cp")
    day = 86_400
    for batch in ([view(1), view(2, time_stamp=None)], [view(1), view(3, time_stamp=T0 + 9 * day)],
                  [view(1), view(3, time_stamp=T0 + 9 * day), view(4, time_stamp=0)]):
        messages_of(*batch).write.mode("append").text(source)
        jobs.start_dedup(read_message_stream(spark, source), locator, target, marks, "1 day",
                         registry.AT_ONCE).awaitTermination()
        jobs.start_undated(read_message_stream(spark, source), aside, marks + "-aside",
                           registry.AT_ONCE).awaitTermination()
    found = spark.read.parquet(target)
    assert rows(found.select("product_id", "date_id")) == [("0", 20240606), ("1", 20240528)]
    assert found.columns == facts.FACT_COLUMNS
    assert sorted(r["id"] for r in spark.read.parquet(aside).collect()) == ["2", "4"]


def test_first_copies_forget_by_arrival(spark, messages_of, locator):
    """Copies of dated and undated logs are dropped while their key is remembered; the state
    holds no keys that arrived longer ago than that."""
    source, target, marks = (new_scratch(spark, n) for n in ("in", "out", "cp"))
    own = stateful_session(spark, 2)
    batches = [
        [view(1), view(1), view(2, time_stamp=None), view(3, time_stamp=0)],
        [view(1), view(2, time_stamp=None), view(4)],
        *[[view(100 + 10 * n + i) for i in range(3)] for n in range(3)],
    ]

    def run(memory, checkpoint, some):
        held = []
        for batch in some:
            messages_of(*batch).write.mode("append").text(source)
            query = jobs.start_first_copies(
                read_message_stream(own, source), locator, target, checkpoint, memory, registry.AT_ONCE)
            query.awaitTermination()
            held.append([p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress][-1])
            time.sleep(1.2)
        return held

    assert run("1 hour", marks, batches[:2]) == [3, 4]
    found = spark.read.parquet(target)
    assert sorted((r["product_id"], r["date_id"]) for r in found.collect() if r["date_id"]) == [
        ("1", 20240528), ("1", 20240528)]
    assert found.count() == 4 and found.where("date_id IS NULL").count() == 2
    source, target = new_scratch(spark, "in"), new_scratch(spark, "out")
    held = run("1 second", marks + "-short", batches)
    assert max(held) <= 7 and held[-1] <= 6  # of 13 keys; one batch more than the memory


def test_progress_is_kept_as_a_table(spark, messages_of):
    source, target, marks = (new_scratch(spark, n) for n in ("in", "out", "cp"))
    log = progress.ProgressLog(spark, new_scratch(spark, "progress")).add()
    try:
        for lines in (["a", "b", view(1)], [view(2)]):
            messages_of(*lines).coalesce(1).write.mode("append").text(source)
            query = jobs.start_relay(read_message_stream(spark, source), target, marks, registry.AT_ONCE)
            log.wait_for(query)
        # The stream dies before its last commit; the folder has that batch and skips it.
        registry._forget_last_commit(spark, marks)
        again = jobs.start_relay(read_message_stream(spark, source), target, marks, registry.AT_ONCE)
        log.wait_for(again)
    finally:
        log.remove()
    kept = log.read().where(F.col("query") == str(again.id)).orderBy("batch_id").collect()
    assert [(r["batch_id"], r["input_rows"]) for r in kept] == [(0, 3), (1, 1)]
    assert kept[1]["run_id"] == str(query.runId) and kept[0]["duration_ms"] > 0
    assert json.loads(kept[0]["observed"])["messages"] == {"row_count": 3, "reject_count": 2}
    rates = progress.batch_rates(log.read()).where(F.col("query") == str(again.id)).first()
    assert (rates["batches"], rates["input_rows"]) == (2, 4) and rates["rows_per_second"] > 0


def test_jdbc_options():
    database = JdbcDatabase("jdbc:x:y", {"user": "u"})
    assert database.read_options("t") == {"user": "u", "url": "jdbc:x:y", "dbtable": "t"}
    split = database.read_options("t", Split("id", 0, 900, 9))
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"]) == ("id", "0", "900")
    assert split["numPartitions"] == "9"


def test_lag_of_a_running_query(spark):
    class Query:
        lastProgress = {"sources": [{"latestOffset": {"t": {"0": 9, "1": 4}}, "endOffset": '{"t":{"0":5}}'}]}

    frame = spark.createDataFrame(health.lag_of_query(Query), "end_offsets string, committed_offsets string")
    assert rows(health.consumer_lag(health.offsets_from_json(frame), "topic")) == [("t", 8)]
    Query.lastProgress = None
    assert health.lag_of_query(Query) == []


def test_kafka_options():
    topic = KafkaTopic("h1:9092,h2:9092", "views", "SASL_PLAINTEXT", "PLAIN", "jaas")
    assert topic.read_options(fail_on_data_loss=False, max_per_trigger=500) == {
        "kafka.bootstrap.servers": "h1:9092,h2:9092",
        "kafka.security.protocol": "SASL_PLAINTEXT",
        "kafka.sasl.mechanism": "PLAIN",
        "kafka.sasl.jaas.config": "jaas",
        "subscribe": "views",
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": "500",
    }
    assert KafkaTopic("h:1", "t").write_options() == {"kafka.bootstrap.servers": "h:1", "topic": "t"}


# -- reports ---------------------------------------------------------------------------


@pytest.fixture
def star(messages_of, warehouse, locator):
    batch = [view(n) for n in range(6)] + [view(10, device_id=""), view(11, product_id=None),
             view(12, time_stamp=T0 + 86400), view(13, ip="8.8.8.8"), view(14, time_stamp=(T0 + 3600) * 1000)]
    load.load_micro_batch(warehouse, messages_of(*batch), locator, 0)
    return warehouse


def test_ties_are_broken_by_key(star):
    got = [tuple(r) for r in reports.top_products(star, DAY).collect()]
    assert got == [("1", 4), ("2", 3), ("0", 2)]
    assert [tuple(r) for r in reports.top_products(star, DAY, limit=1).collect()] == [("1", 4)]
    assert [tuple(r) for r in reports.top_countries(star, DAY).collect()] == [("Chile", 5), ("Peru", 4)]


def test_hours_are_filled_and_empty_days_are_empty(star):
    hours = [tuple(r) for r in reports.hourly_traffic(star, DAY).collect()]
    assert hours == [(h, {8: 9, 9: 1}.get(h, 0)) for h in range(24)]
    assert reports.hourly_traffic(star, "2024-05-30").collect() == []
    assert reports.product_hourly(star, "no such", DAY).collect() == []
    assert [r["views"] for r in reports.product_hourly(star, "2", dt.date(2024, 5, 28)).collect()][8:10] == [2, 1]
    assert reports.top_products(star).collect() == []  # today


def test_views_without_device_have_no_agent(star):
    assert sum(r["views"] for r in reports.user_agents(star, DAY).collect()) == 9
    families = reports.browser_os_hourly(star, DAY).collect()
    assert sum(r["views"] for r in families) == 9 and {r["browser"] for r in families} == {"Other"}


def test_store_report_and_sql(star):
    assert [tuple(r) for r in reports.stores_by_country(star, "Peru", DAY).collect()] == [("1", 4)]
    assert reports.stores_by_country(star, "Atlantis", DAY).collect() == []
    text = """SELECT country_name, count(DISTINCT product_id) AS products
        FROM dim_location RIGHT JOIN fact_product_views USING (location_id)
        WHERE date_id >= :since GROUP BY ALL ORDER BY country_name NULLS LAST"""
    got = reports.query(star, text, {"since": 20240528}).collect()
    assert [tuple(r) for r in got] == [("Chile", 3), ("Peru", 3), (None, 1)]


# -- health ----------------------------------------------------------------------------


def test_lag(spark):
    offsets = spark.createDataFrame(
        [("a", 0, 10, 4), ("a", 1, 5, None), ("b", 0, 3, 3)], schemas.TOPIC_OFFSETS
    )
    assert rows(health.consumer_lag(offsets)) == [(11,)]
    assert rows(health.consumer_lag(offsets, "topic")) == [("a", 11), ("b", 0)]
    want = health.expected_partitions(spark.createDataFrame([("a",), ("b",)], "topic string"), 2)
    assert rows(health.missing_partitions(want, offsets)) == [("b", 1)]


def test_key_violations(spark):
    frame = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,), ("a",)], "k string")
    got = health.key_violations({"t": frame, "none": frame.limit(0)}, {"t": "k", "none": "k"})
    assert rows(got) == [("none", 0, 0, 0), ("t", 6, 2, 2)]


def test_freshness_since_a_day_opens_these_days_only(spark, sf_dir):
    frame = registry.QUERIES["pipeline_freshness_since"](spark, sf_dir)
    scan = next(line for line in plan(frame).splitlines() if "FileScan" in line)
    assert "PartitionFilters: [isnotnull(date_id" in scan


def test_offsets_from_progress(spark):
    frame = spark.createDataFrame(
        [('{"a":{"0":10,"1":5},"b":{"0":3}}', '{"a":{"0":4}}')],
        "end_offsets string, committed_offsets string",
    )
    assert rows(health.offsets_from_json(frame)) == [("a", 0, 10, 4), ("a", 1, 5, None), ("b", 0, 3, None)]


def test_ranges_from_csv(spark):
    path = new_scratch(spark, "ranges") + ".csv"
    frame = spark.createDataFrame([(0, 9, "CL", "Chile", "R", "Arica")], "a long, b long, c string, d string, e string, f string")
    frame.write.csv(path)
    assert rows(read_ip_ranges(spark, path)) == [(0, 9, "Chile", "CL", "R", "Arica")]


# -- plans -----------------------------------------------------------------------------


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_no_python_and_no_nested_loops(spark, sf_dir, name):
    if name.startswith("stream_") or name in ("topic_relay", "batch_row_counts"):
        pytest.skip("a stream has run by the time its table is returned")
    text = plan(registry.QUERIES[name](spark, sf_dir))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "NestedLoopJoin", "CartesianProduct"):
        assert bad not in text


def test_plans_inside_a_micro_batch(messages_of, warehouse, locator, monkeypatch):
    """What a stream's batches run, which their returned tables no longer show."""
    plans, write = [], Warehouse._overwrite

    def recorded(self, table, rows, *rest):
        plans.append(plan(rows))
        return write(self, table, rows, *rest)

    monkeypatch.setattr(Warehouse, "_overwrite", recorded)
    for number in range(2):
        load.load_micro_batch(warehouse, messages_of(view(number), view(5)), locator, number)
        load.land_micro_batch(warehouse, messages_of(view(number), "broken"), number)
    assert len(plans) >= 2 * (len(dims.BUILDERS) + 5)
    for text in plans:
        for bad in ("BatchEvalPython", "ArrowEvalPython", "NestedLoopJoin", "CartesianProduct"):
            assert bad not in text


@pytest.mark.parametrize("name", [n for n in registry.QUERIES if n.startswith("report_")])
def test_reports_prune_the_fact(spark, sf_dir, name):
    text = plan(registry.QUERIES[name](spark, sf_dir))
    assert "PartitionFilters: [isnotnull(date_id" in text and "current_url" not in text


def test_calendar_attributes_prune_the_fact(spark, sf_dir):
    frame = registry.QUERIES["weekend_views"](spark, sf_dir)
    # The subquery stands below the scan that it prunes.
    lines = plan(frame).splitlines()
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line and "store_id" in line)
    assert "SubqueryAdaptiveBroadcast dynamicpruning" in lines[scan + 1]


@pytest.mark.parametrize("name", [n for n in registry.QUERIES if n.startswith("sql_")])
def test_table_functions_equal_the_kept_reports(spark, sf_dir, name):
    kept = registry.QUERIES[name.replace("sql_", "kept_")](spark, sf_dir)
    frame = registry.QUERIES[name](spark, sf_dir)
    assert [tuple(r) for r in frame.collect()] == [tuple(r) for r in kept.collect()]
    assert "PartitionFilters: [isnotnull(date_id" in plan(frame) and "LateralJoin" not in plan(frame)


def test_today_is_a_literal_partition(spark, sf_dir):
    warehouse = registry.load_star(spark, sf_dir)
    assert not reports.views_of_day(warehouse).inputFiles()
    day = reports.views_of_day(warehouse, registry.AS_OF)
    key = registry.AS_OF.replace("-", "")
    assert f"= {key})" in plan(day).split("PartitionFilters")[1]
    assert all(f"date_id={key}/" in f for f in day.inputFiles() if "fact_" in f)


def test_copies_are_combined_before_the_shuffle(spark, sf_dir):
    text = plan(registry.QUERIES["fact_product_views"](spark, sf_dir))
    assert text.count("partial_min") == 1
