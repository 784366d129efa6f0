"""The daily detection job: raw logs in, feature tables, flags and order tags out."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime, time, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathproof.operators import HOUR
from pathproof.plans import features, rules, tags
from pathproof.sources.readers import read_between
from pathproof.sources.sinks import replace_days


@dataclass(frozen=True)
class Inputs:
    """Raw tables of one run, already limited to its days with a day of slack."""

    pings: DataFrame
    orders: DataFrame
    profiles: DataFrame
    cities: DataFrame
    store_points: DataFrame
    assignments_live: DataFrame
    assignments_archive: DataFrame
    risk_events: DataFrame


def run_daily(
    spark: SparkSession,
    inputs: Inputs,
    out: str,
    lo: date,
    hi: date,
    rule_set: Sequence[rules.Rule] | None = None,
    phases: Sequence[str] = ("before", "middle", "after"),
    width_s: int = HOUR,
) -> None:
    """Rebuild the days ``[lo, hi]`` of every table under ``out``.

    Each stage reads the tables of the earlier ones from storage, so a stage that fails
    is repeated alone, and the pings are cleaned once. Phases and rules make them distinct
    in the columns they read.
    """
    rule_set = list(rules.RULES.values()) if rule_set is None else list(rule_set)

    def stored(df: DataFrame, name: str, first: date = lo, last: date = hi) -> DataFrame:
        """Replace the run's days of a table and read days of it back, with the known schema."""
        path = f"{out}/{name}"
        replace_days(df, path, "grass_date", lo, hi)
        return read_between(spark, path, "grass_date", first, last, df.schema)

    pings = stored(
        features.clean_pings(inputs.pings, inputs.profiles, inputs.cities, lo, hi).distinct(),
        "pings",
        lo - timedelta(days=1),
    ).drop("grass_date")
    assigned = features.assignments(inputs.assignments_live, inputs.assignments_archive)
    orders = stored(
        features.order_facts(inputs.orders, inputs.profiles, inputs.store_points, assigned, lo, hi), "orders"
    ).drop("grass_date")

    points = stored(features.accept_points(orders, pings, width_s=width_s), "accept_points")
    for phase in phases:
        stored(features.order_pings(orders, pings, phase, width_s=width_s, lo=lo, hi=hi), f"pings_{phase}")

    # Orders with broken times must not unfold beyond the days that have pings.
    within = (datetime.combine(lo - timedelta(days=1), time.min), datetime.combine(hi, time.max))
    flags = rules.run_rules(orders, pings, rule_set, width_s=width_s, within=within)
    flags = stored(flags.withColumn("grass_date", F.col("order_date")), "flags")
    app = tags.tampered_app_orders(orders, inputs.risk_events, {"user_id": "driver_account_id"}, lo, hi)
    hits = tags.all_hits(
        flags,
        _001=rules.accept_at_store(points),
        _004=rules.accept_point_repeated(points),
        app=app,
    )
    stored(tags.tag_orders(orders.withColumn("grass_date", F.col("order_date")), hits), "order_tags")
