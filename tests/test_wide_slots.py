"""Keys with few rows share a wide slot; the rules of one run look at the orders once."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from pathproof.operators import HOUR
from pathproof.operators.slots import SLOT, with_wide_slot
from pathproof.plans import rules as plan
from pathproof.plans.measures import distinct_pings
from pathproof.plans.rules import RULES, run_rules
from tests.test_rules import ORDER, PING, order, ping


def test_pings_of_a_quiet_driver_are_one_slot(spark):
    pings = spark.createDataFrame([ping(7200 * i, driver=d) for i in range(20) for d in (1, 2, None)], PING)
    got = distinct_pings(pings, width_s=HOUR).select("driver_id", SLOT).distinct().collect()
    assert sorted(r.driver_id for r in got) == [1, 2]


def test_crowded_blocks_keep_plain_slots_in_order(spark):
    start = datetime(2023, 12, 1)
    rows = [(None if k == 2 else k, start + timedelta(hours=9 * i)) for k in (0, 1, 2) for i in range(300 if k else 40)]
    df = spark.createDataFrame([*rows, (0, None), (2, None)], "k long, t timestamp_ntz")
    plain = (F.unix_seconds(F.col("t").cast("timestamp")) / HOUR).cast("long")
    got = with_wide_slot(df, ["k"], "t", HOUR, most_rows=60).withColumn("plain", plain).collect()
    assert len(got) == 642 and all(r[SLOT] is None for r in got if r.t is None)
    for r in (r for r in got if r.t is not None):
        crowded = sum(x.k == r.k and x.t is not None and x.plain >> 10 == r.plain >> 10 for x in got) > 60
        assert r[SLOT] == (r.plain if crowded else r.plain >> 10 << 10)
    assert len({r[SLOT] for r in got if r.k == 0}) < 4 < len({r[SLOT] for r in got if r.k == 1})
    by_time = [r[SLOT] for r in sorted((r for r in got if r.k == 1), key=lambda r: r.t)]
    assert by_time == sorted(by_time)


def test_narrow_rules_look_at_the_orders_once(spark, monkeypatch):
    steps = []
    monkeypatch.setattr(plan, "made_once", lambda df: steps.append(df.columns) or df)
    pings = [ping(60 * i, accuracy=4.123456) for i in range(8)] + [ping(900 + i, accuracy=4.5, driver=2) for i in range(8)]
    rules = [RULES[c] for c in ("109", "115", "215", "010")]
    got = run_rules(
        spark.createDataFrame([order(1), order(2, driver=2, pickup=1000)], ORDER),
        spark.createDataFrame(pings, PING),
        rules,
        narrow=True,
        one_row_per_order=True,
    )
    assert {(r.order_id, r.code) for r in got.collect()} == {(1, "109"), (1, "115")}
    assert len(steps) == 3  # ends of spans, hits, hits without pardoned ones
