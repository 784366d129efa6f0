"""Period reports over order tags, and the monthly loss summary."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RULES_PATTERN = "Rules_%"
PROXY_PATTERN = "Proxy_%"
TOTAL = "All"


def calendar(days: DataFrame, day: str = "report_date") -> DataFrame:
    """Date dimension of all days between the first and the last of a column: ISO weeks (Monday first) and months.

    Days without a row of the table are days, too. A table without rows has none.
    """
    d = F.col("report_date")
    week, month = F.trunc(d, "week"), F.trunc(d, "month")
    seen = F.col(day).cast("date")
    bounds = days.agg(F.min(seen).alias("first"), F.max(seen).alias("last"))
    return bounds.select(F.explode(F.sequence("first", "last")).alias("report_date")).select(
        d,
        (F.extract(F.lit("YEAROFWEEK"), d) * 100 + F.weekofyear(d)).alias("year_week"),
        week.alias("first_day_of_week"),
        F.date_add(week, 6).alias("last_day_of_week"),
        (F.year(d) * 100 + F.month(d)).alias("year_month"),
        month.alias("first_day_of_month"),
        F.last_day(d).alias("last_day_of_month"),
        F.dayofmonth(F.last_day(d)).alias("num_day_in_month"),
    )


def periods(dates: DataFrame, lo: date, as_of: date) -> DataFrame:
    """Days, weeks and months of ``[lo, as_of)``. A running week or month ends yesterday."""
    yesterday = as_of - timedelta(days=1)
    last = F.lit(yesterday)
    known = dates.where(F.col("report_date").between(F.lit(lo), last))

    def part(name: str, period: str, start: str, end: str, unit: str | None, whole: Column) -> DataFrame:
        running = F.lit(False) if unit is None else F.trunc("report_date", unit) == F.trunc(last, unit)
        passed = F.datediff(last, F.col(start)) + 1
        return known.select(
            F.lit(name).alias("period_grp"),
            F.col(period).cast("string").alias("period"),
            F.col(start).alias("start_date"),
            F.when(running, last).otherwise(F.col(end)).alias("end_date"),
            F.when(running, passed).otherwise(whole).cast("double").alias("days"),
        ).distinct()

    return (
        part("1. Daily", "report_date", "report_date", "report_date", None, F.lit(1))
        .unionByName(
            part("2. Weekly", "year_week", "first_day_of_week", "last_day_of_week", "week", F.lit(7))
        )
        .unionByName(
            part(
                "3. Monthly", "year_month", "first_day_of_month", "last_day_of_month", "month",
                F.col("num_day_in_month"),
            )
        )
    )


def _days_of(spans: DataFrame) -> DataFrame:
    """(day, period) pairs, so that facts meet their periods by an equality on the day.

    Broadcast: three rows per calendar day, whatever the number of facts.
    """
    day = F.explode(F.sequence("start_date", "end_date")).alias("order_date")
    return F.broadcast(spans.select("period_grp", "period", "days", day))


def daily_behaviors(tags: DataFrame) -> DataFrame:
    """Distinct orders per day and behavior, and an ``All`` row that sums the behaviors of a type.

    The total adds up distinct counts: an order with two behaviors counts twice in it.
    """
    ruled = F.col("behavior").like(RULES_PATTERN)
    daily = (
        tags.where(ruled | F.col("behavior").like(PROXY_PATTERN))
        .groupBy("order_date", F.when(ruled, "Rules").otherwise("Proxy").alias("types"), "behavior")
        .agg(F.countDistinct("order_id").alias("cnt_order"))
    )
    return (
        daily.select(
            "order_date", "types", F.explode(F.array("behavior", F.lit(TOTAL))).alias("behavior"), "cnt_order"
        )
        .groupBy("order_date", "types", "behavior")
        .agg(F.sum("cnt_order").alias("cnt_order"))
    )


def behavior_report(tags: DataFrame, spans: DataFrame) -> DataFrame:
    """Tagged orders per period and behavior next to all orders of the period."""
    days = _days_of(spans)
    period = ["period_grp", "period", "days"]
    tagged = (
        daily_behaviors(tags)
        .join(days, "order_date")
        .groupBy(*period, "types", "behavior")
        .agg(F.sum("cnt_order").alias("cnt_order"))
    )
    net = (
        tags.select("order_date", "order_id")
        .distinct()
        .join(days, "order_date")
        .groupBy(*period)
        .agg(F.countDistinct("order_id").alias("net_order"))
    )
    report = tagged.join(net, period).select(*period, "types", "behavior", "cnt_order", "net_order")
    return report.orderBy("period_grp", "period", "types", "behavior")


def average_drivers(
    tags: DataFrame,
    behavior_like: str = RULES_PATTERN,
    by: str = "month",
    unit: str = "month",
    lo: date | None = None,
    hi: date | None = None,
) -> DataFrame:
    """Average over days of the distinct tagged drivers per day, for each month (or week) number.

    Numbers repeat every year: give ``lo`` and ``hi``, the range of days, for tables of more than one.
    """
    number = F.month("order_date") if unit == "month" else F.weekofyear("order_date")
    if lo is not None:
        tags = tags.where(F.col("order_date").between(F.lit(lo), F.lit(hi)))
    return (
        tags.where((F.col("behavior") != "") & F.col("behavior").like(behavior_like))
        .groupBy("order_date")
        .agg(F.countDistinct("driver_id").alias("cnt_driver"))
        .groupBy(number.alias(by))
        .agg(F.avg("cnt_driver").alias("avg_driver"))
        .orderBy(by)
    )


# What a fraud code and a case source stand for.
FRAUD_KINDS = {
    "dc-011": "Driver complete order with delivering food",
    "dc-004": "Driver complete order with delivering food",
    "dc-018": "Improper use of edit order function to change order amount",
    "dc-007": "Collusion / Fake / Suspicious Orders",
    "dc-008": "Collusion / Fake / Suspicious Orders",
    "dc-014": "Collusion / Fake / Suspicious Orders",
    "dc-017": "Collusion / Fake / Suspicious Orders",
}
OTHER_KIND = "Others"
SOURCE_NAMES = {"food": "Delivered Orders"}
CODE_PATTERN = "dc-%"
EXCLUDED_SOURCE = "fresh"


def bad_debt_cases(
    cases: DataFrame,
    lo: date | None = None,
    hi: date | None = None,
    source_names: Mapping[str, str] = SOURCE_NAMES,
    code_pattern: str = CODE_PATTERN,
    excluded_source: str = EXCLUDED_SOURCE,
) -> DataFrame:
    """Cases with the kind of fraud, the name of their source and the loss in currency.

    Pass ``source_names`` for the sources of your own log; others become NULL. A zero
    exchange rate gives a NULL loss.
    """

    def chosen(column: str, names: Mapping[str, str]) -> Column:
        return F.coalesce(*[F.when(F.col(column) == k, F.lit(v)) for k, v in names.items()])

    if lo is not None:
        cases = cases.where(F.col("order_created_date").between(F.lit(lo), F.lit(hi)))
    return cases.where((F.col("source") != excluded_source) & F.col("fraud_code").like(code_pattern)).select(
        F.col("order_created_date").alias("submit_date"),
        F.coalesce(chosen("fraud_code", FRAUD_KINDS), F.lit(OTHER_KIND)).alias("fraud_mo"),
        chosen("source", source_names).alias("source"),
        "fraud_code",
        F.col("driver_id").alias("cheater"),
        F.try_divide(F.col("amount_charge_back") + F.col("balance"), F.col("exchange_rate")).alias("loss"),
    )


def bad_debt_monthly(cases: DataFrame) -> DataFrame:
    """Average drivers per day with cases and total loss, by month number."""
    return (
        cases.groupBy("submit_date")
        .agg(F.countDistinct("cheater").alias("cnt_driver"), F.sum("loss").alias("loss"))
        .groupBy(F.month("submit_date").alias("grass_month"))
        .agg(F.avg("cnt_driver").alias("avg_driver"), F.sum("loss").alias("total_loss"))
        .orderBy("grass_month")
    )
