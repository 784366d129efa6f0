"""Operators against brute force on small random frames, for several slot widths."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from pathproof.operators import DAY, HOUR, MINUTE, asof_lookup, beyond_slots, holding, interval_join, latest_by, made_once, neighbours, pick_per_class

ZERO = datetime(2024, 1, 1)
WIDTHS = [MINUTE, HOUR, 400 * DAY]


def at(minute: int) -> datetime:
    return ZERO + timedelta(minutes=minute)


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def world():
    rng = random.Random(7)
    points = [(rng.choice("abc"), at(rng.randrange(300)), i) for i in range(250)]
    spans = []
    for i in range(60):
        lo = rng.randrange(-20, 310)
        spans.append((rng.choice("abcd"), at(lo), at(lo + rng.randrange(-10, 90)), i))
    return points, spans


POINT = "key string, t timestamp_ntz, pid int"
SPAN = "key string, lo timestamp_ntz, hi timestamp_ntz, sid int"


@pytest.mark.parametrize("width", WIDTHS)
def test_interval_join(spark, world, width):
    points, spans = world
    pairs = {(s[3], p[2]) for s in spans for p in points if s[0] == p[0] and s[1] <= p[1] <= s[2]}
    args = (frame(spark, spans, SPAN), frame(spark, points, POINT), "key", "t", "lo", "hi")
    inner = interval_join(*args, width_s=width)
    assert sorted((r.sid, r.pid) for r in inner.collect()) == sorted(pairs)
    left = interval_join(*args, how="left", width_s=width)
    alone = {(s[3], None) for s in spans} - {(s, None) for s, _ in pairs}
    assert {(r.sid, r.pid) for r in left.collect()} == pairs | alone


def test_interval_join_cuts_broken_starts(spark):
    spans = frame(spark, [("a", datetime(1970, 1, 1), at(10), 1)], SPAN)
    points = frame(spark, [("a", at(5), 1), ("a", at(11), 2)], POINT)
    got = interval_join(spans, points, "key", "t", "lo", "hi", width_s=MINUTE, within=(at(0), at(60)))
    assert [r.pid for r in got.collect()] == [1]


@pytest.mark.parametrize("width", WIDTHS)
def test_holding(spark, world, width):
    points, spans = world
    short = [(k, t, t + timedelta(minutes=7)) for k, t, _ in points]
    expected = {s[3] for s in spans for k, a, b in short if s[0] == k and s[1] <= a and b <= s[2]}
    got = holding(
        frame(spark, spans, SPAN),
        frame(spark, short, "key string, start timestamp_ntz, end timestamp_ntz"),
        ["key"],
        "lo",
        "hi",
        width_s=width,
    )
    assert sorted(r.sid for r in got.collect()) == sorted(expected)


@pytest.mark.parametrize("width", WIDTHS)
@pytest.mark.parametrize("direction", ["backward", "forward"])
def test_asof_lookup(spark, world, width, direction):
    points, spans = world
    back = direction == "backward"

    def nearest(key, moment, wanted):
        fit = [(t, pid) for k, t, pid in points if k == key and wanted(pid) and (t <= moment if back else t >= moment)]
        return (max(fit) if back else min(fit))[1] if fit else None

    got = asof_lookup(
        frame(spark, spans, SPAN),
        frame(spark, points, POINT),
        "key",
        "lo",
        "t",
        {"any": F.col("pid"), "rare": F.when(F.col("pid") % 20 == 0, F.col("pid"))},
        direction,
        width,
    )
    rows = {r.sid: (r.any, r.rare) for r in got.collect()}
    assert rows == {
        s[3]: (nearest(s[0], s[1], lambda p: True), nearest(s[0], s[1], lambda p: p % 20 == 0)) for s in spans
    }


def test_asof_lookup_keeps_probes_without_key_or_time(spark):
    probes = frame(spark, [(None, at(1), at(2), 1), ("a", None, at(2), 2)], SPAN)
    points = frame(spark, [("a", at(0), 9), (None, at(0), 8)], POINT)
    got = asof_lookup(probes, points, "key", "lo", "t", {"v": F.col("pid")})
    assert {(r.sid, r.v) for r in got.collect()} == {(1, None), (2, None)}


@pytest.mark.parametrize("width", WIDTHS)
@pytest.mark.parametrize("reach", [1, 3, 5])
def test_neighbours_equal_plain_windows(spark, world, width, reach):
    points = frame(spark, world[0], POINT)
    plain = Window.partitionBy("key").orderBy("t", "pid")
    looks = {
        "ahead": lambda w: F.lead("pid", reach).over(w),
        "sum": lambda w: F.sum("pid").over(w.rowsBetween(1, reach)),
    }
    back = {"behind": lambda w: F.lag("pid", reach).over(w)}
    every = {**looks, **back}
    expected = points.select("*", *[f(plain).alias(n) for n, f in every.items()])
    got = neighbours(points, ["key"], ["t", "pid"], reach, F.lit(True), looks, back, width)
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))
    some = neighbours(points, ["key"], ["t", "pid"], reach, F.col("ahead") > F.col("pid"), looks, back, width)
    assert sorted(map(str, some.collect())) == sorted(map(str, expected.where("ahead > pid").collect()))


def test_latest_by_keeps_ties(spark):
    df = frame(spark, [(1, 5, "a"), (1, 5, "b"), (1, 4, "c"), (2, 1, "d")], "id int, v int, x string")
    assert sorted(r.x for r in latest_by(df, "id", "v").collect()) == ["a", "b", "d"]


def test_pick_per_class_drops_rows_before_the_shuffle(spark):
    df = spark.range(1000).select("id", (F.col("id") % 2).alias("c"))
    picked = pick_per_class(df, "c", 3, [F.col("id")])
    assert sorted(r.id for r in picked.collect()) == [0, 1, 2, 3, 4, 5]
    large = pick_per_class(df.withColumn("c", F.lit(0)).union(df.withColumn("id", F.col("id") + 5000)), "c", 1200, [F.col("id")])
    assert sorted(r.id for r in large.where("c = 0").collect())[-1] == 5398
    assert "WindowGroupLimit" in picked._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("bits", [1, 3, 10])
@pytest.mark.parametrize("later", [True, False])
def test_beyond_slots(spark, bits, later):
    """Slots before and after zero, gaps, nulls, far outliers, against all earlier or later slots."""
    rng = random.Random(bits)
    rows = {(k, s): rng.choice([None, rng.randrange(-50, 50)]) for k in "ab" for s in rng.sample(range(-40, 40), 45)}
    rows |= {("a", -900_000_000): 7, ("a", 4_000_000_000): -60, ("c", 5): None}
    table = [(k, s, v, None if v is None else (s, v)) for (k, s), v in rows.items()]
    df = frame(spark, table, "key string, _slot long, v int, dated struct<_slot:long,value:int>")
    got = {
        (r["key"], r["_slot"]): (r["v"], r["dated"] and r["dated"]["value"])
        for r in beyond_slots(df, ["key"], ["v", "dated"], smallest=later, later=later, fan_bits=bits).collect()
    }
    for (k, s), answer in got.items():
        side = sorted((t, v) for (q, t), v in rows.items() if q == k and v is not None and (t > s if later else t < s))
        nearest = (side[0] if later else side[-1])[1] if side else None
        assert answer == ((min if later else max)((v for _, v in side), default=None), nearest)
    assert len(got) == len(rows)


def test_look_ups_over_many_blocks(spark):
    """Years between neighbours, times before 1970, at slots of a minute."""
    rng = random.Random(3)
    times = [datetime(1960, 1, 1) + timedelta(minutes=rng.randrange(40_000_000)) for _ in range(120)]
    points = [(rng.choice("ab"), t, i) for i, t in enumerate(times)]
    probes = [(rng.choice("abc"), rng.choice(times) + timedelta(minutes=rng.randrange(-9, 9)), i) for i in range(60)]
    answers = asof_lookup(
        frame(spark, probes, "key string, at timestamp_ntz, n int"), frame(spark, points, POINT), "key", "at", "t",
        {"last": F.struct("t", "pid")}, width_s=MINUTE,
    ).collect()
    for r in answers:
        before = [(t, i) for k, t, i in points if k == r["key"] and t <= r["at"]]
        assert (tuple(r["last"]) if r["last"] else None) == max(before, default=None)
    windows = [(k, t, t + timedelta(days=rng.randrange(900)), i) for k, t, i in probes]
    spans = [(k, t, t + timedelta(days=rng.randrange(200))) for k, t, _ in points]
    held = holding(
        frame(spark, windows, SPAN), frame(spark, spans, "key string, start timestamp_ntz, end timestamp_ntz"),
        ["key"], "lo", "hi", width_s=MINUTE,
    ).collect()
    want = {i for k, lo, hi, i in windows if any(q == k and lo <= a and b <= hi for q, a, b in spans)}
    assert {r["sid"] for r in held} == want and 5 < len(want) < 55


def test_made_once_keeps_rows_and_types(spark):
    df = spark.sql(
        "select * from values (1L, timestamp_ntz'2024-01-01 00:00:05.123456', timestamp'1901-01-01', 1.50BD, null, 'a'),"
        " (null, null, timestamp'2024-01-01', null, cast('nan' as double), null), (1L, null, null, 2BD, 0.1D, '')"
        " as t(a, b, c, d, e, f)"
    )
    got = made_once(df)
    assert got.dtypes == df.dtypes
    assert sorted(map(str, got.collect())) == sorted(map(str, df.collect()))
    assert made_once(df.where("false")).count() == 0
