import random
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from pathproof.functions import (
    decimal_fraction_digits,
    double_fraction_digits,
    earth_distance_km,
    fraction_digits,
    json_scalar,
    ping_time,
    round7,
    round7_of,
    speed_kmh,
    split_number,
    tag_list,
    wall_time,
    whole_seconds_between,
)
from pathproof.plans.rules import accept_at_store, accept_point_repeated


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize(
    ("value", "digits"),
    [
        (12.3456, 4),
        (4.0, 0),
        (0.00012, 5),
        (20.0, 0),
        (1.0e-4, 4),
        (12345678.9, 1),
        (106.1234567, 7),
        (3.9000000953674316, 16),
        (1.1 * 3600 / 1000, 16),
        (1.25e-5, 7),
        (0.000001234567890123, 18),
        (1.5e10, 0),
        (1.2345678912e7, 3),
        (7, 0),
        (-10.25, 2),
        (Decimal("1.50000"), 1),
    ],
)
def test_fraction_digits(spark, value, digits):
    assert one(spark, fraction_digits(F.lit(value))) == digits


def test_fraction_digits_of_nothing(spark):
    assert one(spark, fraction_digits(F.lit(None).cast("double"))) is None
    assert one(spark, fraction_digits(F.lit(float("nan")))) is None


def test_round7_touches_only_long_coordinates(spark):
    assert one(spark, round7(F.lit(10.12345678))) == 10.1234568
    assert one(spark, round7(F.lit(10.1234567))) == 10.1234567


def test_typical_speeds_stay_exact(spark):
    speeds = {0.1: 0.36, 0.2: 0.72, 1.0: 3.6, 2.0: 7.2, 3.0: 10.8}
    for metres, kmh in speeds.items():
        assert one(spark, speed_kmh(F.lit(metres))) == kmh


@pytest.mark.parametrize(
    ("upload_ms", "server_s", "expected_s"),
    [
        (10_000_999, 10_000, 10_000),
        (10_000_000, 9_995, 10_000),
        (10_000_000, 9_994, 9_994),
        (10_000_000, 10_020, 10_000),
        (10_000_000, 10_021, 10_021),
    ],
)
def test_ping_time_trusts_a_device_close_to_the_server(spark, upload_ms, server_s, expected_s):
    got = one(spark, ping_time(F.lit(upload_ms), F.lit(server_s)))
    assert (got - datetime(1970, 1, 1)).total_seconds() == expected_s - 3600


def test_wall_time_ignores_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert one(spark, wall_time(F.lit(7200))) == datetime(1970, 1, 1, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_distance(spark):
    quarter = earth_distance_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(90.0))
    assert one(spark, quarter) == pytest.approx(6371.01 * 3.141592653589793 / 2)
    assert one(spark, earth_distance_km(*[F.lit(10.5)] * 4)) == 0


def test_whole_seconds_drop_the_fraction(spark):
    a, b = F.lit(datetime(2024, 1, 1)), F.lit(datetime(2024, 1, 1, 0, 0, 5, 999_999))
    assert one(spark, whole_seconds_between(a, b)) == 5


def test_split_number_of_malformed_text(spark):
    assert one(spark, split_number(F.lit("10.5,106.25"), 2)) == 106.25
    assert one(spark, split_number(F.lit("10.5"), 2)) is None
    assert one(spark, split_number(F.lit("unknown"), 1)) is None


def test_json(spark):
    doc = F.lit('{"D":{"tags":["a","b"],"text":"[x]","n":5,"none":null}}')
    assert one(spark, tag_list(doc, "$.D.tags")) == ["a", "b"]
    assert one(spark, tag_list(doc, "$.D.missing")) is None
    assert one(spark, json_scalar(doc, "$.D.tags")) is None
    assert one(spark, json_scalar(doc, "$.D")) is None
    assert one(spark, json_scalar(doc, "$.D.text")) == "[x]"
    assert one(spark, json_scalar(doc, "$.D.n")) == "5"
    assert one(spark, json_scalar(doc, "$.D.none")) is None
    assert one(spark, json_scalar(F.lit("not json"), "$.D")) is None


def test_digits_of_doubles_equal_digits_of_their_text(spark):
    rng = random.Random(5)
    edges = [0.0, -0.0, 0.01, 0.009999999999999998, 1e-3, 9.999e-4, 5e-324, 1e15, 1e15 + 1, 1e22, 1.7e308, 0.1 + 0.2]
    edges += [float("nan"), float("inf"), float("-inf"), 0.012345678901234568, 123456789.12345679, 3.9600000000000004, None]
    some = [rng.choice((-1, 1)) * rng.random() * 10 ** rng.randint(-12, 18) for _ in range(4000)]
    some += [round(rng.random() * 200, rng.randint(0, 9)) for _ in range(4000)]
    df = spark.createDataFrame([(x,) for x in edges + some], "x double")
    got = df.select("x", double_fraction_digits("x").alias("fast"), fraction_digits("x").alias("plain"))
    assert got.where("not fast <=> plain").collect() == []


def test_digits_of_decimals_equal_digits_of_their_text(spark):
    rng = random.Random(6)
    some = [Decimal(0), Decimal("0.0000001"), Decimal("-0.0000001"), Decimal("1E+5"), Decimal("-7.50"), None]
    some += [Decimal(rng.randint(-(10**17), 10**17)).scaleb(-9) for _ in range(500)]
    some += [Decimal(rng.randint(-(10**5), 10**5)).scaleb(-rng.randint(0, 9)) for _ in range(500)]
    df = spark.createDataFrame([(x,) for x in some], "x decimal(20,9)").withColumn("y", F.col("x").cast("decimal(18,7)"))
    for c in ("x", "y"):
        kind = dict(df.dtypes)[c]
        assert df.where(~decimal_fraction_digits(c).eqNullSafe(fraction_digits(c))).collect() == []
        assert df.where(~round7_of(c, kind).eqNullSafe(round7(c))).collect() == []
    edges = [0.1 + 0.2, 10.12345678, 10.1234567, 1e-9, float("nan"), float("inf"), None]
    doubles = spark.createDataFrame([(x,) for x in edges], "x double")
    assert doubles.where(~round7_of("x", "double").eqNullSafe(round7("x"))).collect() == []


def test_points_given_as_decimals_take_no_lambda(spark):
    """A lambda is not compiled, and casts of empty texts throw: minutes for the points of 20,000 orders."""
    names = [f"{a}_{b}" for a in ("accept", "store") for b in ("latitude", "longitude")]
    points = spark.range(3).selectExpr(
        "id as order_id",
        "7L as driver_id",
        "date'2024-01-01' as order_date",
        "timestamp'2024-01-01' as create_time",
        "'food' as service_type",
        *[f"cast(10.1234567 as decimal(18,7)) as {n}" for n in names],
    )
    for found in (accept_at_store(points), accept_point_repeated(points)):
        assert "lambda" not in found._jdf.queryExecution().optimizedPlan().toString()
        assert found.count() == 3
