"""Scalar column expressions. All are built-in JVM expressions; none is a UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean earth radius in km used by the original spherical distance.
EARTH_RADIUS_KM = 6371.01

# A device clock is trusted when the server saw the ping between
# 5 seconds before and 20 seconds after the device says it was sent.
CLOCK_EARLY_S = -5
CLOCK_LATE_S = 20

# Fixed value: source epochs run one hour ahead of the local wall clock.
SOURCE_SHIFT_S = 3600


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fraction_digits(x: Column | str) -> Column:
    """Number of significant digits after the decimal point, of the shortest text of the number.

    A double counts as it is printed, all digits of its noise included: 1.1 m/s in km/h is
    3.9600000000000004 and has 16. Engines print small and large doubles differently (1.0E-4
    against 0.0001), so the exponent is taken off the digits of the mantissa. NULL when ``x``
    is no finite number.

    The text is the variable of a lambda: stated directly, it would be repeated, and with it
    whatever ``x`` is made of, wherever the optimizer merges projections.
    """
    return F.transform(F.array(F.upper(_col(x).cast("string"))), _digits_of_text)[0]


def _digits_of_text(text: Column) -> Column:
    mantissa, power = (F.split_part(text, F.lit("E"), F.lit(n)) for n in (1, 2))
    digits = F.length(F.rtrim(F.split_part(mantissa, F.lit("."), F.lit(2)), F.lit("0")))
    # only where there is one: an empty text is cast by way of an exception, which costs more than all else here
    exponent = F.coalesce(F.when(power != "", power.try_cast("int")), F.lit(0))
    finite = F.abs(text.try_cast("double")) < float("inf")
    return F.when(finite, F.greatest(F.lit(0), digits - exponent)).cast("bigint")


def double_fraction_digits(x: Column | str) -> Column:
    """``fraction_digits`` of a double, without a lambda wherever its digits fit a decimal of 18 places.

    A double's text has at most 17 significant digits, so from 0.01 on none lies beyond the
    18th place. All else (tiny, huge, not a number) takes the general way.
    """
    c = _col(x)
    plain = F.abs(c).between(0.01, 1e15)
    places = F.split_part(F.when(plain, c).cast("decimal(38,18)").cast("string"), F.lit("."), F.lit(2))
    return (
        F.when(plain, F.length(F.rtrim(places, F.lit("0"))).cast("bigint"))
        .when(c == 0, F.lit(0).cast("bigint"))
        .otherwise(fraction_digits(c))
    )


def decimal_fraction_digits(x: Column | str) -> Column:
    """``fraction_digits`` of a decimal, without a lambda: its text has no exponent, or (without ANSI) takes the general way."""
    text = _col(x).cast("string")
    places = F.length(F.rtrim(F.split_part(text, F.lit("."), F.lit(2)), F.lit("0"))).cast("bigint")
    return F.when(F.contains(text, F.lit("E")), fraction_digits(x)).otherwise(places)


def fraction_digits_of(x: Column | str, kind: str) -> Column:
    """``fraction_digits`` the cheapest way for a column of type ``kind``, as ``DataFrame.dtypes`` names it."""
    if kind == "double":
        return double_fraction_digits(x)
    return decimal_fraction_digits(x) if kind.startswith("decimal(") else fraction_digits(x)


def round7_of(x: Column | str, kind: str) -> Column:
    """``round7`` the cheapest way for a column of type ``kind``; a decimal of at most 7 places has nothing to round."""
    c = _col(x)
    if kind.startswith("decimal(") and int(kind.rstrip(")").rpartition(",")[2]) <= 7:
        return c
    if kind != "double" and not kind.startswith("decimal("):
        return round7(c)
    return F.when(fraction_digits_of(c, kind) > 7, F.round(c, 7)).otherwise(c)


def round7(x: Column | str) -> Column:
    """Round to 7 decimals, but only a coordinate that carries more than 7."""
    return F.transform(F.array(_col(x)), lambda c: F.when(fraction_digits(c) > 7, F.round(c, 7)).otherwise(c))[0]


def speed_kmh(metres_per_second: Column | str) -> Column:
    """m/s to km/h. The order of operations keeps 0.36, 0.72, 3.6, 7.2 and 10.8 exact."""
    return _col(metres_per_second) * 3600 / 1000


def wall_time(epoch_seconds: Column | str, shift_s: int = SOURCE_SHIFT_S) -> Column:
    """Epoch seconds to a zone-less timestamp, independent of the session time zone."""
    since = _col(epoch_seconds) - F.lit(shift_s)
    zero = F.lit(0)
    return F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'") + F.make_dt_interval(zero, zero, zero, since)


def ping_time(upload_ms: Column | str, server_s: Column | str, shift_s: int = SOURCE_SHIFT_S) -> Column:
    """Device time when it agrees with the server clock, server time otherwise."""
    upload_s = _whole_seconds(upload_ms)
    drift = _col(server_s) - upload_s
    return F.when(
        drift.between(CLOCK_EARLY_S, CLOCK_LATE_S), wall_time(upload_s, shift_s)
    ).otherwise(wall_time(server_s, shift_s))


def upload_wall_time(upload_ms: Column | str, shift_s: int = SOURCE_SHIFT_S) -> Column:
    return wall_time(_whole_seconds(upload_ms), shift_s)


def _whole_seconds(ms: Column | str) -> Column:
    c = _col(ms)
    return ((c - c % 1000) / 1000).cast("bigint")


def whole_seconds_between(a: Column | str, b: Column | str) -> Column:
    """Whole elapsed seconds from ``a`` to ``b``."""
    return F.timestamp_diff("SECOND", _col(a), _col(b))


def earth_distance_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in km between two points given in degrees."""
    phi1, phi2 = F.radians(lat1), F.radians(lat2)
    dphi, dlam = F.radians(lat2 - lat1), F.radians(lon2 - lon1)
    h = F.pow(F.sin(dphi / 2), F.lit(2.0)) + F.cos(phi1) * F.cos(phi2) * F.pow(F.sin(dlam / 2), F.lit(2.0))
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.least(F.lit(1.0), F.sqrt(h)))


def split_number(text: Column | str, position: int) -> Column:
    """n-th comma separated number of a text, NULL when absent or malformed."""
    return F.split_part(_col(text), F.lit(","), F.lit(position)).try_cast("double")


def json_scalars(entities: Column | str, **paths: str) -> Column:
    """Array of one struct with the text of a JSON string, number or boolean for each path.

    NULL for arrays and objects. The text is parsed once, whatever the number of paths: the
    lambda's variable stands for the parsed value. Use it with ``inline``; a filter on the
    fields then stays above the generator and does not parse again.
    """

    def scalar(parsed: Column, path: str) -> Column:
        nested = F.coalesce(
            F.try_variant_get(parsed, path, "array<variant>").isNotNull(), F.lit(False)
        ) | F.coalesce(F.try_variant_get(parsed, path, "map<string,variant>").isNotNull(), F.lit(False))
        return F.when(~nested, F.try_variant_get(parsed, path, "string"))

    return F.transform(
        F.array(F.try_parse_json(_col(entities))),
        lambda parsed: F.struct(*[scalar(parsed, path).alias(name) for name, path in paths.items()]),
    )


def json_scalar(entities: Column | str, path: str) -> Column:
    """Text of a JSON string, number or boolean; NULL for arrays and objects."""
    return json_scalars(entities, value=path)[0]["value"]


def tag_list(entities: Column | str, path: str) -> Column:
    """JSON array of strings at ``path``, parsed once; NULL when it is no array."""
    return F.from_json(F.get_json_object(_col(entities), path), "array<string>")
