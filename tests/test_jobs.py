"""Features, tags, reports, review, devices and sinks on hand-written rows; the daily job."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pathproof.plans import devices, features, reports, review, tags
from pathproof.plans.daily import Inputs, run_daily
from pathproof.plans.rules import RULES
from pathproof.sources import read_table, replace_days, write_full, write_partitioned
from pathproof.testbed.frames import view
from tests.test_rules import ORDER, PING, T0, order, ping

SF = "/root/testdata/sf0.001"


def seconds(n):
    return T0 + timedelta(seconds=n)


def frames(spark, orders, pings):
    return spark.createDataFrame(orders, ORDER), spark.createDataFrame(pings, PING)


def test_phase_ends_belong_to_the_earlier_phase(spark):
    orders, pings = frames(spark, [order(1)], [ping(s) for s in (-301, -300, 600, 601, 1200, 1201, 1500, 1501)])
    got = review.phase_pings(orders, pings)
    rows = {(int((r.ping_time - T0).total_seconds()), r.period) for r in got.collect()}
    assert rows == {(-300, "early"), (600, "early"), (601, "middle"), (1200, "middle"), (1201, "end"), (1500, "end")}


def test_an_order_without_pings_stays_without_a_phase(spark):
    orders, pings = frames(spark, [order(1), order(2, driver=2)], [ping(5)])
    assert {(r.order_id, r.period) for r in review.phase_pings(orders, pings).collect()} == {(1, "early"), (2, None)}


def test_one_order_of_two_drivers_with_equal_times(spark):
    """Each driver's row keeps its own pings, and stays if it has none."""
    both = [order(1, driver=1), order(1, driver=2)]
    orders, pings = frames(spark, both, [ping(5, driver=1), ping(7, driver=2)])
    got = {(r.driver_id, int((r.ping_time - T0).total_seconds())) for r in review.phase_pings(orders, pings).collect()}
    assert got == {(1, 5), (2, 7)}
    orders, pings = frames(spark, both, [ping(5, driver=1)])
    assert {(r.driver_id, r.period) for r in review.phase_pings(orders, pings).collect()} == {(1, "early"), (2, None)}


def test_copies_of_a_ping_hit_no_same_place_check(spark):
    orders, pings = frames(spark, [order(1)], [ping(5, speed=0.36), ping(5, speed=0.36, device="e"), ping(9, speed=0.72)])
    sample = review.phase_pings(orders, pings)
    assert review.review_check(sample, review.CHECKS["s7"]).count() == 0
    again = frames(spark, [order(1)], [ping(5, speed=0.36), ping(9, speed=0.36)])
    assert review.review_check(review.phase_pings(*again), review.CHECKS["s7"]).count() == 2


def test_a_rule_without_a_behavior_tags_by_its_code(spark):
    orders = spark.createDataFrame([order(1), order(2)], ORDER)
    hits = spark.createDataFrame([(1, "999"), (1, "115")], "order_id long, code string")
    got = {(r.order_id, r.behavior) for r in tags.tag_orders(orders, hits).collect()}
    assert got == {(1, "Rules_999"), (1, tags.BEHAVIORS["115"]), (2, "")}


@pytest.mark.parametrize("delivered", [1200, 600, 500, -250, -400])
def test_complete_orders_equal_the_phase_labels(spark, delivered):
    stops = [-700, -550, -450, -400, -300, -250, -100, 300, 500, 550, 600, 601, 700, 900, 1200, 1300]
    drivers = range(12)
    pings = [ping(s, driver=d) for d in drivers for i, s in enumerate(stops) if (i * 7 + d * 5) % 12 < 8]
    orders, seen = frames(spark, [order(d, driver=d, delivered=delivered) for d in drivers], pings)
    labelled = review.phase_pings(orders, seen).groupBy("order_id").agg(F.countDistinct("period").alias("n"))
    expected = {r.order_id for r in labelled.where("n = 3").collect()}
    got = review.orders_with_all_phases(orders, seen, ["order_id"])
    assert {r.order_id for r in got.collect()} == expected


def test_accept_point_of_an_order_with_two_assignments(spark):
    places = ", accept_latitude double, accept_longitude double, store_latitude double, store_longitude double"
    rows = [(*order(1), 1.0, 1.0, 2.0, 2.0), (*order(1, start=100), 3.0, 3.0, 2.0, 2.0), (*order(2, 2), 4.0, 4.0, 5.0, 5.0)]
    orders = spark.createDataFrame(rows, ORDER + places)
    pings = spark.createDataFrame(
        [ping(-300, lat=7.0), ping(-299, lat=8.0), ping(0, lat=9.0), ping(0, lat=9.5, upload=1), ping(1, lat=10.0)], PING
    )
    seen = features.accept_points(orders, pings).collect()
    assert [(r.order_id, r.accept_latitude) for r in seen] == [(1, 10.0)]
    kept = features.accept_points(orders, pings, keep_unseen=True).collect()
    assert sorted((r.order_id, r.accept_latitude) for r in kept) == [(1, 10.0), (2, 4.0)]
    narrow = features.accept_points(orders.where("accept_latitude = 1.0"), pings.where("latitude < 10")).collect()
    assert [r.accept_latitude for r in narrow] == [9.5]


def test_order_pings_read_a_padded_range_of_days(spark):
    orders, pings = frames(spark, [order(1)], [ping(0), ping(-100)])
    pings = pings.withColumn("ping_date", F.to_date("ping_time"))
    got = features.order_pings(orders, pings, "before", lo=date(2024, 1, 1), hi=date(2024, 1, 1))
    assert got.count() == 2
    assert features.order_pings(orders, pings, "before", lo=date(2024, 1, 5), hi=date(2024, 1, 6)).count() == 0


def test_tampered_app_tags(spark):
    def event(user, result, entities):
        return (user, result, entities, datetime(2024, 1, 1, 3))

    tagged, clean = '{"DFPInfoSZ":{"tags":["x","is_repack"]}}', '{"DFPInfoSZ":{"tags":["x"]}}'
    events = spark.createDataFrame(
        [
            event(1, "P", tagged), event(1, "B00", tagged), event(2, "B00", tagged), event(3, None, tagged),
            event(4, "P", clean), event(5, "P", None), event(6, "P", '{"DFPInfoSZ":{"tags":"is_repack"}}'),
        ],
        "user_id long, sync_event_hit_result string, entities string, event_local_datetime timestamp_ntz",
    )
    orders = spark.createDataFrame([order(i, driver=i) for i in range(1, 7)], ORDER)
    hit = tags.tampered_app_orders(orders, events, {"user_id": "driver_id"}, date(2024, 1, 1), date(2024, 1, 1))
    assert {r.order_id for r in hit.collect()} == {1, 3}
    flags = {(r.user_id, r.is_repack, r.is_blocked) for r in tags.risk_tag_flags(events, ["is_repack"]).collect()}
    assert (3, True, False) in flags and (5, False, False) in flags and (2, True, True) in flags


def test_the_region_with_text_ids(spark):
    c = F.col
    facts = spark.createDataFrame([order(1), order(2, driver=2)], ORDER)
    versions = facts.select("order_id", "driver_id", "create_time", *review._TIMES).withColumns(
        {"order_status": F.lit("ORDER_COMPLETED"), "ingestion_timestamp": c("create_time")}
    )
    undone = versions.withColumns(
        {"order_status": F.lit("ORDER_CANCELLED"), "ingestion_timestamp": c("create_time") + F.expr("interval 1 day")}
    ).where("order_id = 2")
    none = "order_id long, driver_id long, create_time timestamp_ntz, assign_time timestamp_ntz, pickup_time timestamp_ntz, "
    none += "delivery_complete_time timestamp_ntz, service_type int, order_status int"
    done = features.order_facts_versioned(
        versions.unionByName(undone), spark.createDataFrame([], none), {2: "a"}, date(2024, 1, 1)
    )
    # The newest version of order 2 is cancelled: choosing comes before testing.
    assert [(r.order_id, r.driver_id, r.service_type) for r in done.collect()] == [("1", "1", "food")]
    log = spark.createDataFrame(
        [(1, 1, 2.0, 3.0, 4.0, 5.0, 1704110400000, "20240101"), (1, 1, 0.0, 0.0, 0.0, 0.0, 1704110400000, "20231231")],
        "order_id long, driver_id long, store_latitude double, store_longitude double, driver_latitude double, "
        "driver_longitude double, create_time long, dt string",
    )
    placed = features.with_accept_pairs(done, features.accept_pairs(log, date(2024, 1, 1)))
    pings = spark.createDataFrame([ping(-10, lat=7.5)], PING).withColumn("driver_id", c("driver_id").cast("string"))
    near = features.accept_points(placed, pings, keep_unseen=True).first()
    assert (near.accept_latitude, near.store_latitude) == (7.5, 2.0)
    far = features.accept_points(placed, pings.where("false"), keep_unseen=True).first()
    assert (far.accept_latitude, far.accept_longitude) == (4.0, 5.0)
    events = spark.createDataFrame(
        [(1, "P", '{"DFPInfoSZ":{"tags":["is_repack"]}}', T0)],
        "user_id long, sync_event_hit_result string, entities string, event_local_datetime timestamp_ntz",
    )
    hit = tags.tampered_app_orders(done, events, {"user_id": "driver_id"}, date(2024, 1, 1), date(2024, 1, 1))
    assert [r.order_id for r in hit.collect()] == ["1"]


def test_declared_inputs_are_read_without_inference(spark, tmp_path):
    from pathproof.sources import read_input, read_risk_events
    from pathproof.sources.schemas import INPUTS, RISK_EVENT

    events = spark.createDataFrame(
        [(1, 16, "e", T0, date(2024, 1, d), region, None, None, 1) for d in (1, 2) for region in ("X", "Y")], RISK_EVENT
    )
    path = str(tmp_path / "events")
    write_partitioned(events, path, ["grass_date"])
    got = read_risk_events(spark, path, [16], "X", date(2024, 1, 2), date(2024, 1, 3), RISK_EVENT)
    assert [r.grass_date.day for r in got.collect()] == [2]
    assert "PartitionFilters: [isnotnull(grass_date" in got._jdf.queryExecution().executedPlan().toString()
    write_full(spark.createDataFrame([], INPUTS["review"]), str(tmp_path / "r"))
    assert read_input(spark, str(tmp_path / "r"), "review").columns == ["order_id", "is_hit", "pic"]


def test_order_tags_are_long_and_empty_when_clean(spark):
    orders = spark.createDataFrame([(1,), (2,), (3,)], "order_id long")
    hits = spark.createDataFrame([(1, "016"), (1, "017"), (1, "001"), (2, "unknown")], "order_id long, code string")
    got = {(r.order_id, r.behavior) for r in tags.tag_orders(orders, hits).collect()}
    assert got == {(1, tags.SAME_ACCURACY), (1, tags.BEHAVIORS["001"]), (2, "Rules_unknown"), (3, "")}


def test_running_periods_end_yesterday(spark):
    days = spark.sql("select explode(sequence(date '2024-01-30', date '2024-02-20')) as d")
    spans = reports.periods(reports.calendar(days, "d"), date(2024, 1, 30), date(2024, 2, 15)).collect()
    weekly = {(r.period, r.start_date.day, r.end_date.day, r.days) for r in spans if r.period_grp == "2. Weekly"}
    assert ("202405", 29, 4, 7.0) in weekly and ("202407", 12, 14, 3.0) in weekly
    monthly = {(r.period, r.end_date, r.days) for r in spans if r.period_grp == "3. Monthly"}
    assert monthly == {("202401", date(2024, 1, 31), 31.0), ("202402", date(2024, 2, 14), 14.0)}


def test_device_look_back_and_blank_ids(spark):
    orders = spark.createDataFrame(
        [(1, 7, T0, 7, 50, 9), (2, 7, seconds(1), 7, 52, 9), (3, 8, T0, 8, 50, 9), (4, 8, T0, 8, 50, 9)],
        "order_id long, buyer_id long, create_time timestamp_ntz, account_id long, app_type_id int, delivery_id long",
    )
    logins = spark.createDataFrame(
        [(7, seconds(-259200), "old", "is_emulator", 1), (7, seconds(1), "late", None, 1),
         (8, seconds(-259201), "gone", None, 1)],
        "account_id long, date_time timestamp_ntz, device string, tags string, platform int",
    )
    own = spark.createDataFrame(
        [(3, "", 2, "is_fake_deviceinfo")], "order_id long, security_device_id string, platform int, risk_tags string"
    )
    got = {(r.order_id, r.device, r.platform, r.is_high_risk_tag)
           for r in devices.attribute_devices(orders, own, logins).collect()}
    # Order 2 comes from another app, order 4 shares buyer and time with order 3.
    assert got == {(1, "old", 1, 1), (3, "", None, 1)}


def test_replace_days_clears_days_without_rows(spark, tmp_path):
    path = str(tmp_path / "t")

    def days(*rows):
        return spark.createDataFrame([(date(2024, 1, d), v) for d, v in rows], "grass_date date, v int")

    replace_days(days((1, 1), (2, 2), (3, 3), (4, 4)), path, "grass_date", date(2024, 1, 1), date(2024, 1, 4))
    replace_days(days((2, 20), (9, 90)), path, "grass_date", date(2024, 1, 2), date(2024, 1, 3))
    replace_days(days((2, 20), (9, 90)), path, "grass_date", date(2024, 1, 2), date(2024, 1, 3))
    assert sorted((r.grass_date.day, r.v) for r in read_table(spark, path).collect()) == [(1, 1), (2, 20), (4, 4)]


def test_full_and_partitioned_writes(spark, tmp_path):
    df = spark.range(10).select("id", (F.col("id") % 2).cast("string").alias("grass_month"))
    write_full(df, str(tmp_path / "a"))
    write_full(df.where("id < 3"), str(tmp_path / "a"))
    assert read_table(spark, str(tmp_path / "a")).count() == 3
    write_partitioned(df, str(tmp_path / "b"), ["grass_month"])
    assert sorted(p.name for p in (tmp_path / "b").glob("grass_month=*")) == ["grass_month=0", "grass_month=1"]


def test_daily_job_is_repeatable(spark, tmp_path):
    log = view(spark, SF, "assign_log").withColumn("status", F.lit(3))
    events = view(spark, SF, "risk_events").withColumn("user_id", F.col("user_id") + 100000)
    inputs = Inputs(
        pings=view(spark, SF, "raw_pings"),
        orders=view(spark, SF, "raw_orders"),
        profiles=view(spark, SF, "profiles"),
        cities=view(spark, SF, "cities"),
        store_points=view(spark, SF, "store_log"),
        assignments_live=log.where("order_id % 2 = 0"),
        assignments_archive=log.where("order_id % 2 = 1"),
        risk_events=events,
    )
    out, lo, hi = str(tmp_path), date(2024, 1, 10), date(2024, 1, 12)
    rules = [RULES["115"]]

    def tables():
        names = ("pings", "orders", "order_tags")
        return {n: sorted(map(str, read_table(spark, f"{out}/{n}").collect())) for n in names}

    run_daily(spark, inputs, out, lo, hi, rules, phases=("before",))
    first = tables()
    assert first["pings"] and first["orders"]
    assert len(first["order_tags"]) >= len(first["orders"])
    assert any(tags.TAMPERED_APP in row for row in first["order_tags"])
    run_daily(spark, inputs, out, lo, hi, rules, phases=("before",))
    assert tables() == first


def test_same_place_check_asks_for_accuracy_and_heading(spark):
    schema = (
        "order_date date, order_id long, driver_id long, period string, ping_time timestamp_ntz, accuracy double, "
        "latitude double, longitude double, speed_kmh double, head int"
    )

    def row(oid, second, accuracy=5.0, head=4, lat=1.0, speed=0.36, period="early"):
        return (T0.date(), oid, 1, period, seconds(second), accuracy, lat, 2.0, speed, head)

    sample = spark.createDataFrame(
        [
            row(1, 0), row(1, 5, head=3, lat=9.0), row(1, 10, speed=3.6, period="end"), row(1, 20, lat=3.0),
            row(2, 0), row(2, 10, accuracy=4.9),
            row(3, 0), row(3, 10, period="middle"),
            row(4, 0), row(4, 0),
        ],
        schema,
    )
    hit = review.review_check(sample, review.CHECKS["s8"])
    # Pings that fail the condition do not stand between two that meet it; copies are one ping.
    assert {(r.order_id, (r.ping_time - T0).seconds) for r in hit.collect()} == {(1, 0), (1, 10)}
