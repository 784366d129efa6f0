"""Rules on hand-written orders, and against a direct reading of their definition."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from pathproof.operators import DAY, HOUR, MINUTE
from pathproof.plans.measures import with_measures
from pathproof.plans.rules import RULES, accept_at_store, accept_point_repeated, run_rule, run_rules

T0 = datetime(2024, 1, 1, 12)

ORDER = (
    "order_id long, driver_id long, create_time timestamp_ntz, order_date date, service_type string, "
    "delivery_assign_time timestamp_ntz, delivery_pickup_time timestamp_ntz, delivery_delivered_time timestamp_ntz"
)
PING = (
    "driver_id long, ping_time timestamp_ntz, upload_time timestamp_ntz, latitude double, longitude double, "
    "speed_kmh double, head int, accuracy double, device_id string"
)


def order(oid, driver=1, start=0, pickup=600, delivered=1200, service="food"):
    s = lambda x: T0 + timedelta(seconds=x)
    return (oid, driver, T0, T0.date(), service, s(start), s(pickup), s(delivered))


def ping(second, accuracy=9.0, driver=1, upload=None, lat=10.5, lon=106.5, speed=9.0, device="d", head=1):
    t = T0 + timedelta(seconds=second)
    u = T0 + timedelta(seconds=second if upload is None else upload)
    return (driver, t, u, lat, lon, speed, head, accuracy, device)


def hits(spark, orders, pings, code, **options):
    """(order, count, flag) of the hit orders; these hand-written orders have one row each."""
    got = run_rule(
        spark.createDataFrame(orders, ORDER),
        spark.createDataFrame(pings, PING),
        RULES[code],
        one_row_per_order=True,
        **options,
    )
    return {(r.order_id, r[f"cnt_{code}"], r[f"dsys{code}"]) for r in got.collect()}


def drivers(*cases):
    """One driver and one order per case; each case is a list of pings."""
    return [(driver, *p[1:]) for driver, pings in enumerate(cases) for p in pings]


def hit_cases(spark, cases, code, orders=None, **options):
    orders = orders or [order(i, driver=i) for i in range(len(cases))]
    return {oid for oid, _, _ in hits(spark, orders, drivers(*cases), code, **options)}


LONG = [0.10001 + i / 1000 for i in range(10)]


def test_five_matches_need_a_ping_before_them(spark):
    five = [ping(10 * i, LONG[i]) for i in range(5)]
    broken = [ping(0)] + [ping(10 + 10 * i, LONG[i]) for i in range(3)] + [ping(45)]
    broken += [ping(50 + 10 * i, LONG[i]) for i in range(4)]
    cases = [five, [ping(-5)] + five, five + [ping(70, LONG[6])], broken]
    assert hit_cases(spark, cases, "111") == {1, 2}


def test_the_run_must_lie_in_the_window(spark):
    run = [ping(580 + 5 * i, LONG[i], speed=LONG[i]) for i in range(6)]
    early = [ping(-300 + 5 * i, LONG[i], speed=LONG[i]) for i in range(6)]
    orders = [order(0, 0, pickup=605), order(1, 1, pickup=604), order(2, 2), order(3, 3, start=1)]
    assert hit_cases(spark, [run, run, early, early], "211", orders) == {0, 2}
    # The ping at pickup is on the trip as well, where it pardons.
    assert hit_cases(spark, [run, run, early, early], "111", orders) == {2}


def test_tied_and_repeated_pings_change_the_count(spark):
    # Two rows of one time that both match: counts rise by two, no window of five adds up to 5.
    tied = [ping(-5), ping(0, LONG[0]), ping(10, LONG[1]), ping(10, LONG[2]), ping(20, LONG[3]), ping(30, LONG[4])]
    assert hits(spark, [order(1)], tied, "111") == {(1, 1, 1)}
    # A copy that differs only in its device is one row for the run but counts twice.
    copy = [ping(-5)] + [ping(10 * i, LONG[i]) for i in range(5)] + [ping(20, LONG[2], device="e")]
    assert hits(spark, [order(1)], copy, "111") == set()
    # Seen through fewer columns the copy is no other ping.
    assert hits(spark, [order(1)], copy, "111", narrow=True) == {(1, 1, 1)}
    stored = with_measures(spark.createDataFrame(copy, PING)).withColumn("speed_digit", F.col("head") * 0)
    got = run_rule(spark.createDataFrame([order(1)], ORDER), stored, RULES["111"], narrow=True, one_row_per_order=True)
    assert got.count() == 1


def test_a_ping_on_the_trip_pardons(spark):
    run = [ping(-5)] + [ping(10 * i, LONG[i], speed=LONG[i]) for i in range(5)]
    cases = [run + [ping(second, 0.12345)] for second in (600, 1200, 1201)]
    assert hit_cases(spark, cases, "111") == {2}
    assert hit_cases(spark, cases, "211") == {0, 1, 2}


def test_orders_below_the_flag_stay_in_the_result(spark):
    short = [ping(-5)] + [ping(10 * i, 1.5) for i in range(5)]
    orders = [order(1), order(2), order(3, service="fresh")]
    assert hits(spark, orders[:2], short, "016") == {(1, 2, 0), (2, 2, 0)}
    assert hits(spark, orders, short, "016") == {(1, 3, 1), (2, 3, 1), (3, 3, 1)}


def test_jump(spark):
    def jump(gap, accuracy=10.0, lat=10.52):
        return [ping(0), ping(gap, accuracy, lat=lat)]

    cases = [jump(5), jump(6), jump(5, accuracy=20.0), jump(5, lat=10.505), jump(5)]
    orders = [order(i, i) for i in range(4)] + [order(4, 4, pickup=4)]
    assert hit_cases(spark, cases, "006", orders) == {0}
    assert hits(spark, [order(1)], jump(5), "006") == {(1, 1, 0)}


def test_speeds_count_per_group(spark):
    def at(*speeds):
        return [ping(10 * i, speed=s) for i, s in enumerate(speeds)]

    # The same ping reported by another device is the same row.
    twice = at(0.36, 0.36) + [ping(0, speed=0.36, device="e")]
    cases = [at(0.36, 3.6, 0.36), at(0.36, 7.2, 0.36, 0.72), at(10.8, 9.0, 10.8, 0.1, 10.8), twice]
    assert hit_cases(spark, cases, "008") == {0, 2}


def test_accept_point_rules(spark):
    schema = (
        "order_date date, order_id long, driver_id long, service_type string, create_time timestamp_ntz, "
        "accept_latitude double, accept_longitude double, store_latitude double, store_longitude double"
    )
    a, b = 10.1234567, 106.1234567

    def point(oid, lat=a, lon=b, store=(a, b), driver=1):
        return (T0.date(), oid, driver, "food", T0, lat, lon, *store)

    df = spark.createDataFrame(
        [point(1), point(2, a + 1e-9), point(3, 10.12345, 106.5, (10.12345, 106.5)), point(4, store=(a, 106.2))], schema
    )
    assert {(r.order_id, r.cnt_001) for r in accept_at_store(df).collect()} == {(1, 2), (2, 2)}
    assert {(r.order_id, r.cnt_004) for r in accept_point_repeated(df).collect()} == {(1, 3), (2, 3), (4, 3)}


# ---------------------------------------------------------------- against the definition


def fraction(x):
    whole, _, digits = format(Decimal(repr(x)), "f").partition(".")
    return len(digits.rstrip("0"))


MATCH = {
    "016": lambda p: int(p["accuracy"]) == 1 and fraction(p["accuracy"]) < 5,
    "115": lambda p: fraction(p["accuracy"]) >= 5,
    "215": lambda p: fraction(p["accuracy"]) >= 5 and fraction(p["speed_kmh"]) >= 5,
    "010": lambda p: fraction(p["latitude"]) > 7 and fraction(p["longitude"]) > 7,
}
NET = {"016": lambda p: int(p["accuracy"]) == 1, "115": lambda p: fraction(p["accuracy"]) >= 5}
NAMES = [c.split()[0] for c in PING.split(", ")]


def by_definition(orders, pings, code):
    """Order ids hit: running count with peers, distinct rows, difference of five to the fifth next row."""
    row = RULES[code].row
    found = set()
    for oid in {o[0] for o in orders}:
        seen, pardoned = set(), False
        for o in {o for o in orders if o[0] == oid}:
            for p in set(pings):
                if p[0] != o[1]:
                    continue
                if o[5] - timedelta(minutes=5) <= p[1] <= o[6]:
                    seen.add((o, p))
                if o[6] <= p[1] <= o[7] and code in NET and NET[code](dict(zip(NAMES, p))):
                    pardoned = True
        pairs = [dict(zip(NAMES, p)) for _, p in seen]
        when = lambda p: (p["ping_time"], p["upload_time"])
        count = {when(p): sum(MATCH[code](q) for q in pairs if when(q) <= when(p)) for p in pairs}
        rows = sorted({tuple(p[c] for c in row) for p in pairs})
        counts = [count[(r[0], r[1])] for r in rows]
        if not pardoned and any(counts[i + 5] - counts[i] == 5 for i in range(len(counts) - 5)):
            found.add(oid)
    return found


@pytest.mark.parametrize("seed", [1])
def test_random_pings_with_ties_copies_and_repeated_orders(spark, seed):
    rng = random.Random(seed)
    pings = []
    for _ in range(700):
        second = rng.randrange(0, 2400, 4)
        pings.append(
            ping(
                second,
                rng.choice([1.5, 1.25, 1.5, 0.12345, 0.54321]),
                driver=rng.randrange(3),
                upload=second + rng.choice([0, 0, 0, 1]),
                lat=rng.choice([10.123456789, 10.123456789, 10.5]),
                lon=106.123456789,
                speed=rng.choice([0.12345, 0.12345, 4.0]),
                device=rng.choice("de"),
            )
        )
    orders = []
    for oid in range(40):
        start = rng.randrange(0, 2000)
        o = order(oid, rng.randrange(3), start, start + rng.randrange(60, 400), start + rng.randrange(400, 500))
        orders.append(o)
        if oid % 3 == 0:
            orders.append((*o[:5], o[5] + timedelta(seconds=rng.randrange(0, 300)), *o[6:]))
    frames = spark.createDataFrame(orders, ORDER), spark.createDataFrame(pings, PING)
    rules = [RULES[c] for c in MATCH]
    expected = {(oid, c) for c in MATCH for oid in by_definition(orders, pings, c)}
    assert len(expected) > 20
    for width in (MINUTE, DAY):
        got = run_rules(*frames, rules, width_s=width)
        assert {(r.order_id, r.code) for r in got.collect()} == expected
    single = [o for o in orders if o[0] % 3]
    got = run_rules(spark.createDataFrame(single, ORDER), frames[1], rules, one_row_per_order=True, width_s=HOUR)
    assert {(r.order_id, r.code) for r in got.collect()} == {e for e in expected if e[0] % 3}


@pytest.mark.parametrize("seed", [3, 4])
def test_seven_to_ten_rows_of_one_time(spark, seed):
    """Counts of one time are cut before they are packed; the cut must not make or lose a run."""
    rng = random.Random(seed)
    pings = []
    for driver in range(12):
        for step in range(14):
            for k in range(rng.choice([1, 1, 1, 1, 2, 5, 7, 8, 9, 10])):
                long = rng.random() < 0.55
                pings.append(
                    ping(
                        10 * step,
                        round(1 + k * 0.5 + (0.12345 if long else 0), 5),
                        driver=driver,
                        lat=10.123456789 + k / 1e6 if long else 10.5 + k,
                        lon=106.123456789 if long else 106.5,
                        speed=0.12345 if long else 4.0,
                        device=rng.choice("de"),
                    )
                )
    orders = [order(d, d, start=0, pickup=200, delivered=201) for d in range(12)]
    frames = spark.createDataFrame(orders, ORDER), spark.createDataFrame(pings, PING)
    expected = {(oid, c) for c in MATCH for oid in by_definition(orders, pings, c)}
    got = run_rules(*frames, [RULES[c] for c in MATCH], one_row_per_order=True)
    assert {(r.order_id, r.code) for r in got.collect()} == expected
    assert expected
