"""One query per operator, over the views of ``frames``.

Pings are hours apart in the test tables, so windows and slots are wider than the
defaults of the jobs.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathproof.functions import fraction_digits, round7
from pathproof.operators import DAY, latest_by
from pathproof.plans import devices, features, reports, review, rules, tags
from pathproof.sources import readers
from pathproof.testbed.frames import view

Query = Callable[[SparkSession, str], DataFrame]

LO, AS_OF = date(2024, 1, 1), date(2024, 1, 25)
PER_CLASS = 40
PARCEL_SERVICES = {2: "parcel_p2p", 3: "parcel_c2c"}

# The exact 5 second jump does not occur in the test tables.
NEAR_JUMP = replace(rules.RULES["006"], gap_s=3600, exact=False)
PROMISES = {"one_row_per_order": True, "pings_are_distinct": True}

QUERIES: dict[str, Query] = {}


def _views(*names: str):
    """Pass the named views to the query."""

    def wrap(function: Callable[..., DataFrame]) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(*[view(spark, sf_dir, n) for n in names])

        return run

    return wrap


def _add(name: str, *names: str):
    def register(function):
        QUERIES[name] = _views(*names)(function)
        return function

    return register


# ---------------------------------------------------------------- columns and sources


@_add("fraction_digits", "pings")
def _(pings):
    return pings.select(
        "device_id",
        fraction_digits("accuracy").alias("acc_digit"),
        fraction_digits("speed_kmh").alias("speed_digit"),
        fraction_digits("latitude").alias("lat_digit"),
        fraction_digits(F.col("latitude") / 1000000).alias("small_digit"),
        round7(F.col("latitude").cast("decimal(18,9)")).cast("decimal(18,9)").alias("lat7"),
    )


@_add("resolve_ping_time", "raw_pings")
def _(pings):
    return features.with_ping_time(pings).select(
        "event_id", "upload_time", "modify_time", "ping_time", "ping_date"
    )


@_add("clean_pings", "raw_pings", "profiles", "cities")
def _(pings, profiles, cities):
    return features.clean_pings(pings, profiles, cities, date(2024, 1, 3), date(2024, 1, 9), with_names=True).select(
        "event_id", "driver_account_id", "driver_id", "driver_name", "driver_city", "ping_time", "upload_time",
        "latitude", "longitude", "accuracy", F.col("round_accuracy").cast("bigint").alias("round_accuracy"),
        "acc_digit", F.round("speed_kmh", 6).alias("speed_kmh"), "speed_digit", "lat_digit", "lon_digit", "head",
        "device_id", "grass_date",
    )


@_add("clean_pings_by_account", "raw_pings")
def _(pings):
    return features.clean_pings_by_account(pings, date(2024, 1, 5)).select(
        "event_id", "driver_id", "ping_time", "acc_digit", F.round("speed_kmh", 6).alias("speed_kmh")
    )


@_add("assignments", "assign_log")
def _(log):
    return features.assignments(log.where("order_id % 2 = 0"), log.where("order_id % 2 = 1"))


@_add("order_facts", "raw_orders", "profiles", "store_log", "assign_log")
def _(orders, profiles, stores, log):
    assigned = features.assignments(log.where("order_id % 2 = 0"), log.where("order_id % 2 = 1"))
    return features.order_facts(orders, profiles, stores, assigned, date(2024, 1, 2), date(2024, 1, 20), True)


@_add("order_facts_union", "food_versions", "parcels")
def _(food, parcels):
    return features.order_facts_versioned(food, parcels, PARCEL_SERVICES)


@_add("accept_pairs", "pair_log")
def _(pairs):
    return features.accept_pairs(pairs)


@_add("latest_version", "ev")
def _(events):
    return latest_by(
        events.select("event_id", "user_id", F.to_date("ts").alias("version")), "user_id", "version"
    )


# ---------------------------------------------------------------- joins of pings and orders


def _interval(phase: str, pad: str):
    def run(orders, pings):
        return features.order_pings(orders, pings, phase, pad, DAY).select(
            "order_id", "driver_id", "device_id", "ping_time", "acc_digit", "speed_digit", "lat_digit",
            "lon_digit", F.col("round_accuracy").cast("bigint").alias("round_accuracy"), "grass_date",
        )

    return run


_add("interval_before", "trips", "pings")(_interval("before", "5 minutes"))
_add("interval_middle", "trips", "pings")(_interval("middle", "5 minutes"))
_add("interval_after", "trips", "pings")(_interval("after", "6 hours"))


@_add("interval_left_full", "trips", "pings")
def _(orders, pings):
    return review.phase_pings(orders, pings, "5 minutes", DAY).select("order_id", "ping_time", "accuracy", "head")


@_add("trip_phase", "trips", "pings")
def _(orders, pings):
    return (
        review.phase_pings(orders, pings, "6 hours", DAY)
        .groupBy("order_id", "period")
        .agg(F.count("ping_time").alias("n"))
    )


@_add("orders_with_all_phases", "trips", "pings")
def _(orders, pings):
    return review.orders_with_all_phases(orders, pings, ["order_id"], "6 hours", DAY)


_ACCEPT = ["order_id", "accept_latitude", "accept_longitude", "store_latitude", "grass_date"]


@_add("asof_accept_point", "trips", "pings")
def _(orders, pings):
    return features.accept_points(orders, pings, "24 hours", width_s=DAY).select(*_ACCEPT)


@_add("asof_accept_point_or_logged", "trips", "pings")
def _(orders, pings):
    return features.accept_points(orders, pings, "24 hours", keep_unseen=True, width_s=DAY).select(*_ACCEPT)


@_add("haversine_lead", "trips", "pings")
def _(orders, pings):
    seen = features.order_pings(orders, pings, "before", width_s=DAY)
    every = replace(NEAR_JUMP, km=0.0, accuracy_below=1000)
    return rules.jumps(seen, "order_id", every, width_s=DAY).select(
        "order_id", "device_id", "next_time", "next_accuracy", F.round("distance_km", 6).alias("km")
    )


# ---------------------------------------------------------------- rules


def _rule(rule):
    def run(orders, pings):
        return rules.run_rule(orders, pings, rule, width_s=DAY, **PROMISES)

    return run


for _code, _spec in rules.RULES.items():
    _add(f"rule_{_code}", "trips", "pings")(_rule(NEAR_JUMP if _code == "006" else _spec))


@_add("rule_001", "trips")
def _(orders):
    return rules.accept_at_store(orders)


@_add("rule_004", "trips")
def _(orders):
    return rules.accept_point_repeated(orders)


def _all_rules(orders, pings):
    every = [NEAR_JUMP if c == "006" else r for c, r in rules.RULES.items()]
    return rules.run_rules(orders, pings, every, width_s=DAY, **PROMISES)


_add("all_rules", "trips", "pings")(_all_rules)


@_add("rules_per_query", "trips", "pings")
def _(orders, pings):
    every = [NEAR_JUMP if c == "006" else r for c, r in rules.RULES.items()]
    return rules.run_rules(orders, pings, every, narrow=True, one_row_per_order=True, width_s=DAY)


@_add("rules_on_repeated_rows", "trips", "pings")
def _(orders, pings):
    again = orders.where("order_id % 3 = 0").withColumn(
        "delivery_assign_time", F.col("delivery_assign_time") + F.expr("interval 20 hours")
    )
    some = [rules.RULES[c] for c in ("010", "017", "115", "215", "008")]
    return rules.run_rules(orders.unionByName(again), pings, some, width_s=DAY)


# ---------------------------------------------------------------- rules and checks with their own thresholds


@_add("dense_all_rules", "dense_trips", "dense_pings")
def _(orders, pings):
    return rules.run_rules(orders, pings, list(rules.RULES.values()))


@_add("dense_rule_006", "dense_trips", "dense_pings")
def _(orders, pings):
    return rules.run_rule(orders, pings, rules.RULES["006"])


@_add("dense_phases", "dense_trips", "dense_pings")
def _(orders, pings):
    seen = review.phase_pings(orders, pings)
    return seen.groupBy("order_id", "period").agg(F.count("ping_time").alias("n"))


def _dense_check(name: str):
    def run(orders, pings):
        return review.review_check(review.phase_pings(orders, pings), review.CHECKS[name])

    return run


for _name in ("s7", "s8"):
    _add(f"dense_check_{_name}", "dense_trips", "dense_pings")(_dense_check(_name))


@_add("dense_check_s3", "dense_trips", "dense_pings")
def _(orders, pings):
    sample = review.phase_pings(orders, pings)
    return review.orders_hit_by_all(*[review.review_check(sample, review.CHECKS[c]) for c in ("s3a", "s3b")])


# ---------------------------------------------------------------- tags


@_add("risk_tag_flags", "risk_events")
def _(events):
    flags = tags.risk_tag_flags(events)
    return flags.groupBy("user_id", "grass_date").agg(
        *[F.count_if(c).alias(c) for c in (*tags.TAMPERED_APP_TAGS, "is_blocked")]
    )


@_add("rule_risk_tags", "trips", "risk_events")
def _(orders, events):
    return tags.tampered_app_orders(
        orders, events, {"user_id": "driver_id", "grass_date": "order_date"}, LO, date(2024, 1, 31)
    )


@_add("rule_risk_tags_any_day", "trips", "risk_events")
def _(orders, events):
    return tags.tampered_app_orders(orders, events, {"user_id": "driver_id"}, LO, date(2024, 1, 7))


@_add("tag_orders", "trips", "pings", "risk_events")
def _(orders, pings, events):
    hits = tags.all_hits(
        _all_rules(orders, pings),
        _001=rules.accept_at_store(orders),
        _004=rules.accept_point_repeated(orders),
        app=tags.tampered_app_orders(orders, events, {"user_id": "driver_id", "grass_date": "order_date"}),
    )
    return tags.tag_orders(orders, hits).select("order_id", "driver_id", "order_date", "behavior")


# ---------------------------------------------------------------- reports


def _periods(events):
    return reports.periods(reports.calendar(events, "ts"), LO, AS_OF)


@_add("calendar", "ev")
def _(events):
    return reports.calendar(events, "ts")


_add("periods", "ev")(_periods)


@_add("behavior_rollup", "tagged")
def _(tagged):
    return reports.daily_behaviors(tagged)


@_add("behavior_report", "tagged", "ev")
def _(tagged, events):
    return reports.behavior_report(tagged, _periods(events))


@_add("monthly_driver_average", "tagged")
def _(tagged):
    return reports.average_drivers(tagged)


@_add("weekly_driver_average", "tagged")
def _(tagged):
    return reports.average_drivers(tagged, reports.PROXY_PATTERN, "week", "week")


@_add("driver_average_of_days", "tagged")
def _(tagged):
    return reports.average_drivers(tagged, lo=date(2024, 1, 3), hi=date(2024, 1, 17))


@_add("calendar_with_gaps", "ev")
def _(events):
    """Only Mondays occur; the days between them come all the same."""
    return reports.calendar(events.withColumn("ts", F.date_trunc("week", "ts")), "ts")


@_add("bad_debt_cases", "bad_debt")
def _(cases):
    counted = reports.bad_debt_cases(cases).groupBy("fraud_code", "fraud_mo", "source")
    return counted.agg(F.count("*").alias("n"), F.count("loss").alias("with_loss"))


@_add("bad_debt_monthly", "bad_debt")
def _(cases):
    monthly = reports.bad_debt_monthly(reports.bad_debt_cases(cases))
    return monthly.select("grass_month", F.round("avg_driver", 6).alias("avg_driver"), F.round("total_loss", 3).alias("total_loss"))


# ---------------------------------------------------------------- review


def _shuffled():
    return [(F.col("order_id") * 7919) % 10007, F.col("order_id")]


_SAMPLE = ["order_id", "behavior", "period", "ping_time", "accuracy", "head"]


@_add("sample_hits", "tagged", "pings")
def _(tagged, pings):
    return review.sample_hits(
        tagged, pings, behaviors=("Proxy_A", "Proxy_B"), per_class=PER_CLASS, order=_shuffled(),
        pad="6 hours", width_s=DAY,
    ).select(*_SAMPLE)


@_add("sample_controls", "trips", "pings", "tagged")
def _(orders, pings, tagged):
    few = _with_few_tags(orders, tagged)
    return review.sample_controls(few, pings, n=PER_CLASS, order=_shuffled(), pad="6 hours", width_s=DAY).select(*_SAMPLE)


def _with_few_tags(orders, tagged):
    """Tags of every seventh driver only: in the test tables nearly all drivers have a tag."""
    return tagged.withColumn(
        "behavior", F.when(F.col("driver_id") % 7 == 0, F.col("behavior")).otherwise("")
    ).distinct()


@_add("anti_join_not_in", "trips", "tagged")
def _(orders, tagged):
    return review.untagged_drivers_orders(_with_few_tags(orders, tagged)).select("order_id", "driver_id")


def _phased(orders, pings):
    return review.phase_pings(orders, pings, "6 hours", DAY)


# The test pings have no accuracy of exactly 5 with heading 4, and no driver whose accuracy
# is at most 5 before and above 5 during a trip.
CHECKS = {
    **review.CHECKS,
    "s3a_wide": replace(review.CHECKS["s3a"], when="accuracy <= 7.5 and period in ('early', 'end')"),
    "s3b_wide": replace(review.CHECKS["s3b"], when="accuracy > 7 and period = 'middle'"),
    "s8": replace(
        review.CHECKS["s8"], where="speed_kmh in (0.36, 3.6) and accuracy < 5 and period in ('early', 'end')"
    ),
}


def _check(name: str):
    def run(orders, pings):
        return review.review_check(_phased(orders, pings), CHECKS[name], DAY)

    return run


for _name in review.CHECKS:
    _add(f"check_{_name}", "trips", "pings")(_check(_name))


@_add("check_s3", "trips", "pings")
def _(orders, pings):
    sample = _phased(orders, pings)
    return review.orders_hit_by_all(*[review.review_check(sample, CHECKS[c], DAY) for c in ("s3a_wide", "s3b_wide")])


@_add("semi_join_check", "trips", "pings")
def _(orders, pings):
    sample = _phased(orders, pings)
    hit = review.restrict_to_hits(sample, review.review_check(sample, CHECKS["s2"], DAY))
    return hit.select("order_id", "ping_time", "accuracy", "period")


@_add("review_rates", "reviewed_orders", "reviews")
def _(orders, reviews):
    return review.review_rates(
        orders.where("order_id % 2 = 0"),
        orders.where("order_id % 2 = 1"),
        reviews,
        F.when(F.col("pic") == "first", "non-proxy").otherwise("proxy"),
    )


# ---------------------------------------------------------------- devices


@_add("device_attribution", "buyer_orders", "accounts", "login_events", "order_risk")
def _(orders, accounts, events, risk):
    bought = devices.buyer_orders(orders, accounts)
    logins = devices.login_devices(events, bought)
    return devices.attribute_devices(bought, risk, logins, width_s=DAY).select(
        "order_id", "delivery_id", "buyer_id", "store_id", "driver_id", "device", "platform", "tags",
        "is_high_risk_tag", "account_df", "vendor_df", "grass_date", "grass_month",
    )


@_add("risk_event_scan", "login_events")
def _(events):
    regions = events.withColumn("grass_region", F.when(F.col("user_id") % 3 == 0, "ID").otherwise("VN"))
    some = readers.risk_events(regions, (151,), "ID", date(2024, 1, 5), date(2024, 1, 12))
    return some.select("user_id", "event_id", "grass_region", "grass_date", "platform")


# ---------------------------------------------------------------- accept points of the other region


def _paired(food, parcels, pairs):
    orders = features.order_facts_versioned(food, parcels, PARCEL_SERVICES)
    return features.with_accept_pairs(orders, features.accept_pairs(pairs))


@_add("id_rule_001", "food_versions", "parcels", "pair_log")
def _(food, parcels, pairs):
    return rules.accept_at_store(_paired(food, parcels, pairs))


@_add("id_rule_004", "food_versions", "parcels", "pair_log")
def _(food, parcels, pairs):
    """Orders are years apart here, so a point counts from its first order on."""
    return rules.accept_point_repeated(_paired(food, parcels, pairs), at_least=1)


@_add("id_all_rules", "trips", "pings")
def _(orders, pings):
    """All rules of the region of self-contained queries: ids are texts, pings distinct in what a rule reads."""
    every = [NEAR_JUMP if c == "006" else r for c, r in rules.RULES.items()]
    orders = orders.withColumns({c: F.col(c).cast("string") for c in ("order_id", "driver_id")})
    pings = pings.withColumn("driver_id", F.col("driver_id").cast("string"))
    return rules.run_rules(orders, pings, every, narrow=True, one_row_per_order=True, width_s=DAY)


@_add("id_rule_app", "food_versions", "parcels", "risk_events")
def _(food, parcels, events):
    orders = features.order_facts_versioned(food, parcels, PARCEL_SERVICES)
    return tags.tampered_app_orders(orders, events, {"user_id": "driver_id"})
