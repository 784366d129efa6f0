"""Samples for manual review, checks on the sampled pings, and review outcomes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathproof.operators import HOUR, holding, interval_join, neighbours, pick_per_class
from pathproof.operators.intervals import Range
from pathproof.plans.features import PAD, with_trip_phase
from pathproof.plans.reports import PROXY_PATTERN
from pathproof.plans.tags import LONG_DIGITS, SAME_ACCURACY, TAMPERED_APP

SAMPLED_BEHAVIORS = (LONG_DIGITS, TAMPERED_APP, SAME_ACCURACY)
PER_CLASS = 200

_TIMES = ("delivery_assign_time", "delivery_pickup_time", "delivery_delivered_time")
_PING = ("ping_time", "latitude", "longitude", "speed_kmh", "accuracy", "head")


def phase_pings(
    orders: DataFrame, pings: DataFrame, pad: str = PAD, width_s: int = HOUR, within: Range | None = None
) -> DataFrame:
    """Orders with all their pings and the phase of each; order rows without pings stay.

    Pings are told apart by the columns that reviewers see. ``within`` is the time range
    of the pings: orders with broken times then do not unfold beyond it.
    """
    widen = F.expr(f"interval {pad}")
    rows = orders.withColumns(
        {"_lo": F.col("delivery_assign_time") - widen, "_hi": F.col("delivery_delivered_time") + widen}
    )
    joined = interval_join(
        rows,
        pings.select("driver_id", *[c for c in _PING if c in pings.columns]),
        "driver_id",
        "ping_time",
        "_lo",
        "_hi",
        how="left",
        width_s=width_s,
        within=within,
    )
    return with_trip_phase(joined.drop("_lo", "_hi"), pad).distinct()


def orders_with_all_phases(
    orders: DataFrame, pings: DataFrame, key: Sequence[str], pad: str = PAD, width_s: int = HOUR
) -> DataFrame:
    """Keys of orders that have a ping in each of the three phases.

    Asks only whether a ping exists in each phase. The phases share no instant, since
    an earlier phase takes the shared end; an order delivered before pickup (a clock
    error) can have its last phase in two pieces.
    """
    widen, tick = F.expr(f"interval {pad}"), F.expr("interval 1 microsecond")
    assigned, picked, delivered = (F.col(c) for c in _TIMES)
    start = assigned - widen
    early = start <= picked
    in_turn = delivered >= picked
    pieces = [
        ("early", start, picked),
        ("middle", F.when(early, picked + tick).otherwise(picked), delivered),
        (
            "end",
            F.when(in_turn, delivered + tick).otherwise(delivered),
            F.when(in_turn | ~early, delivered + widen).otherwise(F.least(delivered + widen, start - tick)),
        ),
        ("end", F.when(~in_turn & early, F.greatest(picked + tick, delivered)), delivered + widen),
    ]
    windows = orders.select(
        *key,
        "driver_id",
        F.inline(
            F.array(*[F.struct(F.lit(n).alias("period"), lo.alias("_lo"), hi.alias("_hi")) for n, lo, hi in pieces])
        ),
    )
    instants = pings.select("driver_id", F.col("ping_time").alias("start"), F.col("ping_time").alias("end"))
    return (
        holding(windows, instants, ["driver_id"], "_lo", "_hi", width_s=width_s)
        .groupBy(*key)
        .agg(F.countDistinct("period").alias("cnt_period"))
        .where("cnt_period = 3")
        .select(*key)
    )


def seeded_order(seed: int = 0) -> list[Column]:
    """A shuffled but repeatable order of orders."""
    return [F.xxhash64(F.col("order_id").cast("string"), F.lit(seed)), F.col("order_id")]


def sample_hits(
    tags: DataFrame,
    pings: DataFrame,
    lo: date | None = None,
    hi: date | None = None,
    behaviors: Sequence[str] = SAMPLED_BEHAVIORS,
    per_class: int = PER_CLASS,
    order: Sequence[Column] | None = None,
    pad: str = PAD,
    width_s: int = HOUR,
) -> DataFrame:
    """Up to ``per_class`` complete orders of each proxy behavior, with all their pings."""
    tagged = tags.where(F.col("behavior").like(PROXY_PATTERN) & F.col("behavior").isin(*behaviors))
    if lo is not None:
        tagged = tagged.where(F.col("order_date").between(F.lit(lo), F.lit(hi)))
    key = ["order_id", "behavior"]
    complete = orders_with_all_phases(tagged, pings, key, pad, width_s)
    chosen = pick_per_class(complete, "behavior", per_class, order or seeded_order())
    return phase_pings(tagged.join(chosen, key, "left_semi"), pings, pad, width_s)


def sample_controls(
    tags: DataFrame,
    pings: DataFrame,
    lo: date | None = None,
    hi: date | None = None,
    n: int = PER_CLASS,
    order: Sequence[Column] | None = None,
    pad: str = PAD,
    width_s: int = HOUR,
) -> DataFrame:
    """Up to ``n`` complete clean orders of drivers that were never tagged."""
    clean = untagged_drivers_orders(tags)
    if lo is not None:
        clean = clean.where(F.col("order_date").between(F.lit(lo), F.lit(hi)))
    complete = orders_with_all_phases(clean, pings, ["order_id"], pad, width_s)
    chosen = pick_per_class(complete, None, n, order or seeded_order())
    return phase_pings(clean.join(chosen, "order_id", "left_semi"), pings, pad, width_s)


def untagged_drivers_orders(tags: DataFrame) -> DataFrame:
    """Clean orders whose driver has no tag on any day.

    Order facts have no NULL driver, so the anti join equals ``NOT IN``.
    """
    tagged = tags.where("behavior <> '' and driver_id is not null").select("driver_id").distinct()
    return tags.where("behavior = '' and driver_id is not null").join(tagged, "driver_id", "left_anti")


# ---------------------------------------------------------------- checks


@dataclass(frozen=True)
class FlagCheck:
    """Two pings in a row satisfy ``when``."""

    when: str
    show: tuple[str, ...] = ()


@dataclass(frozen=True)
class SameCheck:
    """Among the pings ``where`` holds for, two in a row agree in ``same``."""

    same: tuple[str, ...]
    where: str = "true"
    show: tuple[str, ...] = ()
    distinct: bool = False


Check = FlagCheck | SameCheck

_POINT = ("latitude", "longitude")

# Thresholds and speeds the reviewers look for.
CHECKS: dict[str, Check] = {
    "s2": FlagCheck("accuracy <= 1 and period in ('early', 'end')"),
    "s3a": FlagCheck("accuracy <= 5 and period in ('early', 'end')"),
    "s3b": FlagCheck("accuracy > 5 and period = 'middle'"),
    "s4": SameCheck(("speed_kmh",), "accuracy <= 5 and period = 'early'", ("speed_kmh",)),
    "s5": SameCheck(_POINT, "accuracy <= 5 and period = 'early'", _POINT),
    "s6": SameCheck(_POINT, show=_POINT),
    "s7": SameCheck(
        ("speed_kmh",),
        "speed_kmh in (0.36, 0.72, 3.6, 7.2, 10.8) and period in ('early', 'end')",
        (*_POINT, "speed_kmh"),
        distinct=True,
    ),
    "s8": SameCheck(
        _POINT,
        "speed_kmh in (0.36, 3.6) and accuracy = 5 and head = 4 and period in ('early', 'end')",
        (*_POINT, "speed_kmh"),
        distinct=True,
    ),
}

_SHOWN = ("order_date", "order_id", "driver_id", "period", "ping_time", "accuracy")


def review_check(sample: DataFrame, check: Check, width_s: int = HOUR) -> DataFrame:
    """Pings of the sample that hit the check together with the ping before or after."""
    shown = [*_SHOWN, *check.show]
    # A time comes first in the order of neighbours; orders without pings have none to show.
    pings = sample.where(F.col("ping_time").isNotNull())
    if isinstance(check, FlagCheck):
        rows = pings.select(
            *shown, F.coalesce(F.expr(check.when), F.lit(False)).cast("int").alias("is_sop")
        )
        tested, mine = ["is_sop"], F.col("is_sop") == 1
        extra = ["is_sop"]
    else:
        rows = pings.where(check.where).select(*shown)
        rows = rows.distinct() if check.distinct else rows
        tested, mine = list(check.same), F.lit(True)
        extra = []

    def equal(side: str) -> Column:
        same = mine
        for c in tested:
            same = same & (F.col(c) == F.col(f"_{side}_{c}"))
        return F.coalesce(same, F.lit(False))

    order = ["ping_time", *[c for c in (*shown, *extra) if c not in ("order_id", "ping_time")]]
    return (
        neighbours(
            rows,
            ["order_id"],
            order,
            1,
            keep=equal("next") | equal("prev"),
            ahead={f"_next_{c}": _shift(F.lead, c) for c in tested},
            behind={f"_prev_{c}": _shift(F.lag, c) for c in tested},
            width_s=width_s,
        )
        .select(*shown, *extra, F.lit(1).alias("is_conti"))
        .distinct()
    )


def _shift(function, column: str):
    return lambda w: function(column, 1).over(w)


def orders_hit_by_all(*checked: DataFrame) -> DataFrame:
    """Orders that every one of the given check results contains."""
    first, *others = (c.select("order_id").distinct() for c in checked)
    for other in others:
        first = first.join(other, "order_id", "left_semi")
    return first


def restrict_to_hits(sample: DataFrame, checked: DataFrame) -> DataFrame:
    """Sample rows of the orders a check hit."""
    return sample.join(checked.select("order_id").distinct(), "order_id", "left_semi")


# ---------------------------------------------------------------- outcomes


def review_rates(hits: DataFrame, controls: DataFrame, reviews: DataFrame, types: Column) -> DataFrame:
    """Reviewed fraud per sample type, by orders and by drivers.

    ``types`` names the sample type from a review row; orders without a review form a
    NULL group.
    """
    key = ["order_id", "driver_id"]
    sampled = hits.select(*key).distinct().unionByName(controls.select(*key).distinct())
    labelled = sampled.join(
        reviews.select(
            F.col("order_id").cast(sampled.schema["order_id"].dataType).alias("order_id"),
            F.col("is_hit").cast("int").alias("is_hit"),
            types.alias("types"),
        ),
        "order_id",
        "left",
    )
    fraud = F.col("is_hit") == 1
    counted = labelled.groupBy("types").agg(
        F.countDistinct("order_id").alias("sample_order_cnt"),
        F.countDistinct("driver_id").alias("sample_driver_cnt"),
        F.countDistinct(F.when(fraud, F.col("order_id"))).alias("fraud_order_cnt"),
        F.countDistinct(F.when(fraud, F.col("driver_id"))).alias("fraud_driver_cnt"),
    )
    return counted.withColumns(
        {
            f"{who}_sample_fraud_rate": F.try_divide(
                F.col(f"fraud_{who}_cnt").cast("double"), F.col(f"sample_{who}_cnt")
            )
            for who in ("order", "driver")
        }
    )
