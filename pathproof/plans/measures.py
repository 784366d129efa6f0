"""Columns every ping rule reads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathproof.functions import fraction_digits, fraction_digits_of
from pathproof.operators.slots import SLOT, with_wide_slot

# What makes two pings of one order different, apart from the order itself.
# Columns a source does not have are left out.
PING_FEATURES = (
    "ping_time",
    "upload_time",
    "latitude",
    "longitude",
    "speed_kmh",
    "head",
    "accuracy",
    "device_id",
    "provider",
)

ORDER_COLUMNS = (
    "order_id",
    "driver_id",
    "create_time",
    "order_date",
    "service_type",
    "delivery_assign_time",
    "delivery_pickup_time",
    "delivery_delivered_time",
)

_MEASURES = {
    "round_accuracy": ("accuracy", F.floor),
    "acc_digit": ("accuracy", fraction_digits),
    "speed_digit": ("speed_kmh", fraction_digits),
    "lat_digit": ("latitude", fraction_digits),
    "lon_digit": ("longitude", fraction_digits),
}

MEASURES = tuple(_MEASURES)


def with_measures(pings: DataFrame) -> DataFrame:
    """Add whole metres of accuracy and the digit counts, where not stored already."""
    kinds = dict(pings.dtypes)
    missing = {
        name: fraction_digits_of(column, kinds[column]) if measure is fraction_digits else measure(F.col(column))
        for name, (column, measure) in _MEASURES.items()
        if name not in pings.columns and column in pings.columns
    }
    return pings.withColumns(missing) if missing else pings


def distinct_pings(
    pings: DataFrame, features: Sequence[str] | None = None, width_s: int | None = None
) -> DataFrame:
    """Distinct feature rows of each driver, with their measures.

    The feature tables are distinct by definition. Doing it here, before pings meet
    orders, gives the same rows, moves narrower ones, and lets copies melt away before
    the shuffle. ``features`` narrows what counts as different: the feature tables of one
    region keep every ping column, the per-rule queries of the other the few they read.

    With ``width_s`` rows have a slot (``in_slots``) and are partitioned by driver and slot:
    one shuffle, which all that looks along a driver's time then shares.
    """
    chosen = list(features or PING_FEATURES)
    if any(m in chosen and m not in pings.columns for m in MEASURES):
        pings = with_measures(pings)
    stored = [m for m, (column, _) in _MEASURES.items() if column in chosen and m not in chosen]
    columns = ["driver_id", *[c for c in (*chosen, *stored) if c in pings.columns]]
    rows = pings.select(*columns).dropna(subset=["driver_id", "ping_time"])
    return with_measures((rows if width_s is None else in_slots(rows, width_s)).distinct())


def in_slots(pings: DataFrame, width_s: int) -> DataFrame:
    """``pings`` with a slot, a wide one for drivers with few pings, partitioned by driver and slot."""
    return with_wide_slot(pings, ["driver_id"], "ping_time", width_s).repartition("driver_id", SLOT)
