"""Risk tags of apps, and the order tag table every report reads."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathproof.functions import tag_list

# Where the event log keeps the tags, the result that marks a blocked
# event, and the tags of a tampered app.
TAGS_PATH = "$.DFPInfoSZ.tags"
BLOCKED = "B00"
TAMPERED_APP_TAGS = (
    "is_repack_v7",
    "is_repack_v6",
    "is_fake_protocol",
    "is_cinfo_lost",
    "is_repack",
    "is_repack_v2",
    "is_repack_v3",
    "is_repack_v4",
    "is_repack_v5",
    "is_lspatch_repack_tag",
    "is_suspicious_so",
    "is_wrong_pkg_name",
    "is_no_deviceid_match",
    "is_fake_df",
    "is_status_code_dex_fail",
    "is_status_code_collect_fail",
    "is_status_code_report_fail",
    "is_fake_android_so",
    "is_df_length_long",
    "is_running_magisk",
    "is_running_magisk_v2",
    "is_faker_edxposed_running",
)


def risk_tag_flags(
    events: DataFrame, tags: Sequence[str] = TAMPERED_APP_TAGS, path: str = TAGS_PATH, blocked: str = BLOCKED
) -> DataFrame:
    """One boolean per tag and ``is_blocked``; the JSON is parsed once, not once per tag."""
    parsed = events.withColumn("_tags", F.coalesce(tag_list("entities", path), F.array().cast("array<string>")))
    return parsed.withColumns(
        {
            "is_blocked": F.coalesce(F.col("sync_event_hit_result") == blocked, F.lit(False)),
            **{tag: F.coalesce(F.array_contains("_tags", tag), F.lit(False)) for tag in tags},
        }
    ).drop("_tags")


def flagged_users(
    events: DataFrame, tags: Sequence[str] = TAMPERED_APP_TAGS, path: str = TAGS_PATH, blocked: str = BLOCKED
) -> DataFrame:
    """Events that were not blocked and carry any of the tags.

    A missing result counts as not blocked; a blocked event elsewhere clears nobody.
    """
    hit = F.arrays_overlap(tag_list("entities", path), F.array(*[F.lit(t) for t in tags]))
    return events.where(~F.col("sync_event_hit_result").eqNullSafe(blocked) & hit)


def tampered_app_orders(
    orders: DataFrame,
    events: DataFrame,
    on: Mapping[str, str],
    lo: date | None = None,
    hi: date | None = None,
    **tagging,
) -> DataFrame:
    """All orders of drivers with a flagged event in the same days.

    ``on`` maps event columns to order columns: the user alone, or the user and the day.
    """
    if lo is not None:
        orders = orders.where(F.col("order_date").between(F.lit(lo), F.lit(hi)))
        events = events.where(F.to_date("event_local_datetime").between(F.lit(lo), F.lit(hi)))
    # One region keeps ids as text: compare in the type of the orders.
    drivers = (
        flagged_users(events, **tagging)
        .select(*[F.col(e).cast(orders.schema[o].dataType).alias(o) for e, o in on.items()])
        .distinct()
    )
    return (
        orders.join(drivers, list(on.values()), "left_semi")
        .select(
            "order_date",
            "order_id",
            "driver_id",
            "service_type",
            F.lit(1).alias("is_proxy_autoblock"),
            F.col("order_date").alias("grass_date"),
        )
        .distinct()
    )


# Behaviors as the reports know them: the prefix tells a confirmed rule from a proxy.
LONG_DIGITS = "Proxy_Repetitive long decimal digit of accuracy and speed"
SAME_ACCURACY = "Proxy_Repetitive same accuracy"
TAMPERED_APP = "Proxy_Repacked App usage"

BEHAVIORS = {
    **{c: SAME_ACCURACY for c in ("016", "017")},
    **{c: LONG_DIGITS for c in ("209", "211", "212", "213", "214", "215")},
    "app": TAMPERED_APP,
    "001": "Rules_Accepted at the store point",
    "004": "Rules_Repeated accept point",
    "006": "Rules_Jump between pings",
    "008": "Rules_Repeated typical speed",
    "010": "Rules_Long coordinates",
    **{c: "Rules_Repetitive long decimal digit of accuracy" for c in ("109", "111", "112", "113", "114", "115")},
}


def tag_orders(orders: DataFrame, hits: DataFrame, behaviors: Mapping[str, str] = BEHAVIORS) -> DataFrame:
    """Orders in long form, one row per behavior, ``''`` for a clean order.

    ``hits`` has ``order_id`` and ``code`` of flagged orders. A code without a behavior
    tags as a rule of its own, ``Rules_`` and the code.
    """
    named = F.coalesce(
        *[
            F.when(F.col("code").isin([c for c, b in behaviors.items() if b == behavior]), F.lit(behavior))
            for behavior in dict.fromkeys(behaviors.values())
        ],
        F.concat(F.lit("Rules_"), "code"),
    )
    tags = hits.select("order_id", named.alias("behavior")).where(F.col("behavior").isNotNull()).distinct()
    return orders.join(tags, "order_id", "left").withColumn("behavior", F.coalesce("behavior", F.lit("")))


def all_hits(flags: DataFrame, **outputs: DataFrame) -> DataFrame:
    """Flagged (order, code) of a rule run and of further outputs given by code."""
    parts = [flags.where("flagged = 1").select("order_id", "code")]
    parts += [df.select("order_id", F.lit(code.lstrip("_")).alias("code")) for code, df in outputs.items()]
    return reduce(DataFrame.unionByName, parts)
