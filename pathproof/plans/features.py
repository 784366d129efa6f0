"""Clean pings, order facts of both regions, accept points, pings per order phase."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathproof.functions import ping_time, speed_kmh, split_number, upload_wall_time, wall_time
from pathproof.operators import HOUR, asof_lookup, interval_join, latest_by
from pathproof.plans.measures import ORDER_COLUMNS, distinct_pings, with_measures

PAD = "5 minutes"

# Fixed values of the sources.
COMPLETED_STATUS = 7
ACCEPTED_STATUSES = (3, 4)
STORE_CATEGORY = 0
SERVICE_NAMES = {1: "food", 5: "fresh"}
FOOD_DONE = ("ORDER_DELIVERED", "ORDER_COMPLETED")
PARCEL_DONE = (440, 800)
HOME_COUNTRY = 86


def with_ping_time(pings: DataFrame) -> DataFrame:
    """Add upload, server and resolved ping time to raw pings."""
    resolved = pings.withColumns(
        {
            "ping_time": ping_time("upload_time", "mtime"),
            "modify_time": wall_time("mtime"),
            "upload_time": upload_wall_time("upload_time"),
        }
    )
    return resolved.withColumn("ping_date", F.to_date("ping_time"))


def clean_pings(
    pings: DataFrame,
    profiles: DataFrame,
    cities: DataFrame,
    lo: date | None = None,
    hi: date | None = None,
    with_names: bool = False,
) -> DataFrame:
    """Pings with resolved time, km/h, digit counts, driver and city.

    The resolved date is computed, so it cannot prune storage partitions: read the raw
    pings with a day of slack on either side, then pass the exact days here. Driver
    names are personal data and left out unless asked for.
    """
    measured = with_measures(
        with_ping_time(pings.withColumnRenamed("driver_id", "driver_account_id")).withColumn(
            "speed_kmh", speed_kmh("speed")
        )
    )
    if lo is not None:
        measured = measured.where(F.col("ping_date").between(F.lit(lo), F.lit(hi)))
    drivers = _driver_names(profiles, with_names).select(
        F.col("account_id").alias("driver_account_id"),
        F.col("uid").alias("driver_id"),
        "working_city_id",
        *(["driver_name"] if with_names else []),
    )
    # A city abroad gives a NULL name and does not drop the ping. Both dimensions are small:
    # they are joined with each other first, and once with the pings.
    home = cities.where(F.col("country_id") == HOME_COUNTRY).select(
        F.col("id").alias("working_city_id"), F.col("name").alias("driver_city")
    )
    drivers = drivers.join(home, "working_city_id", "left").drop("working_city_id")
    return measured.join(drivers, "driver_account_id", "left").withColumn("grass_date", F.col("ping_date"))


def _driver_names(profiles: DataFrame, with_names: bool) -> DataFrame:
    if not with_names:
        return profiles
    return profiles.withColumn("driver_name", F.concat("last_name", F.lit(" "), "first_name"))


def clean_pings_by_account(pings: DataFrame, day: date | None = None) -> DataFrame:
    """The other region's pings: ids as text, kept when either clock says ``day``."""
    measured = with_measures(
        with_ping_time(pings)
        .withColumn("speed_kmh", speed_kmh("speed"))
        .withColumn("driver_id", F.col("driver_id").cast("string"))
    )
    if day is None:
        return measured
    return measured.where(
        (F.col("ping_date") == F.lit(day)) | (F.to_date("modify_time") == F.lit(day))
    )


def assignments(live: DataFrame, archive: DataFrame) -> DataFrame:
    """Accepted assignments of both logs with time and place, the place from its text."""
    columns = ["order_id", "driver_id", "location", "create_time", "status"]
    return (
        archive.select(*columns)
        .unionByName(live.select(*columns))
        .where(F.col("status").isin(*ACCEPTED_STATUSES))
        .select(
            "order_id",
            "driver_id",
            wall_time("create_time").alias("delivery_assign_time"),
            split_number("location", 1).alias("accept_latitude"),
            split_number("location", 2).alias("accept_longitude"),
        )
    )


def order_facts(
    orders: DataFrame,
    profiles: DataFrame,
    store_points: DataFrame,
    assigned: DataFrame,
    lo: date | None = None,
    hi: date | None = None,
    with_names: bool = False,
) -> DataFrame:
    """Completed orders with driver account, store point and accept point."""
    c = F.col
    done = orders.where((c("order_status_id") == COMPLETED_STATUS) & (c("driver_id") > 0)).select(
        c("id").alias("order_id"),
        "driver_id",
        wall_time("create_timestamp", 0).alias("create_time"),
        c("city_name").alias("order_city"),
        wall_time("pick_timestamp", 0).alias("delivery_pickup_time"),
        wall_time("deliver_timestamp", 0).alias("delivery_delivered_time"),
        "order_status_id",
        F.coalesce(
            *[F.when(c("service_category_id") == k, F.lit(v)) for k, v in SERVICE_NAMES.items()]
        ).alias("service_type"),
    ).withColumn("order_date", F.to_date("create_time"))
    if lo is not None:
        done = done.where(c("order_date").between(F.lit(lo), F.lit(hi)))
    drivers = _driver_names(profiles, with_names).select(
        c("uid").alias("driver_id"),
        c("account_id").alias("driver_account_id"),
        *(["driver_name"] if with_names else []),
    )
    stores = store_points.where(c("ref_order_category") == STORE_CATEGORY).select(
        c("ref_order_id").alias("order_id"),
        c("uid").alias("driver_id"),
        c("pick_latitude").alias("store_latitude"),
        c("pick_longitude").alias("store_longitude"),
    )
    return (
        done.join(drivers, "driver_id", "left")
        .join(stores, ["order_id", "driver_id"], "left")
        .join(assigned, ["order_id", "driver_id"], "left")
        .withColumn("grass_date", c("order_date"))
        .distinct()
    )


def order_facts_versioned(
    food_versions: DataFrame,
    parcels: DataFrame,
    parcel_services: dict[int, str],
    day: date | None = None,
) -> DataFrame:
    """The other region's orders: latest version of each food order, and parcels.

    Status and day are tested on the chosen version, not before choosing it.
    ``parcel_services`` names the parcel service numbers that count.
    """
    c = F.col
    columns = [
        c("order_id").cast("string").alias("order_id"),
        c("driver_id").cast("string").alias("driver_id"),
        "create_time",
        F.to_date("create_time").alias("order_date"),
    ]
    food = (
        latest_by(food_versions, "order_id", "ingestion_timestamp")
        .where(c("order_status").isin(*FOOD_DONE))
        .select(
            *columns,
            "delivery_assign_time",
            "delivery_pickup_time",
            "delivery_delivered_time",
            F.lit("food").alias("service_type"),
        )
    )
    parcel = parcels.where(
        c("order_status").isin(*PARCEL_DONE) & c("service_type").isin(*parcel_services)
    ).select(
        *columns,
        c("assign_time").alias("delivery_assign_time"),
        c("pickup_time").alias("delivery_pickup_time"),
        c("delivery_complete_time").alias("delivery_delivered_time"),
        F.coalesce(
            *[F.when(c("service_type") == k, F.lit(v)) for k, v in parcel_services.items()]
        ).alias("service_type"),
    )
    if day is not None:
        food, parcel = (df.where(c("order_date") == F.lit(day)) for df in (food, parcel))
    return food.distinct().unionByName(parcel.distinct())


def accept_pairs(pairs: DataFrame, day: date | None = None) -> DataFrame:
    """Latest logged store and driver position of each order (``dt`` is the version)."""
    newest = latest_by(pairs, "order_id", "dt")
    if day is not None:
        newest = newest.where(F.to_date(upload_wall_time("create_time")) == F.lit(day))
    return newest.select(
        F.col("order_id").cast("string").alias("order_id"),
        F.col("driver_id").cast("string").alias("driver_id"),
        "store_latitude",
        "store_longitude",
        F.col("driver_latitude").alias("accept_latitude"),
        F.col("driver_longitude").alias("accept_longitude"),
    ).distinct()


def with_accept_pairs(orders: DataFrame, pairs: DataFrame) -> DataFrame:
    """Orders with the logged store and accept place of ``accept_pairs``, where there is one."""
    return orders.join(pairs, ["order_id", "driver_id"], "left")


_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def seconds_of(interval: str) -> int:
    """Seconds of an interval such as ``5 minutes``."""
    number, unit = interval.split()
    return int(number) * _UNITS[unit.lower().removesuffix("s")]


_PLACES = ("accept_latitude", "accept_longitude", "store_latitude", "store_longitude")


def accept_points(
    orders: DataFrame,
    pings: DataFrame,
    look_back: str = PAD,
    keep_unseen: bool = False,
    width_s: int = HOUR,
) -> DataFrame:
    """Where each order was accepted: the last ping of ``(assign - look_back, assign]``.

    One row per order. A ping without coordinates falls back to the logged place. An
    order without a ping is dropped, as one region does, or kept with its logged place
    (``keep_unseen``), as the other does.
    """
    tie = [c for c in ("upload_time",) if c in pings.columns]
    seen = asof_lookup(
        orders.select(*ORDER_COLUMNS, *_PLACES),
        pings.where(F.col("ping_time").isNotNull()),
        "driver_id",
        "delivery_assign_time",
        "ping_time",
        {"_ping": F.struct("ping_time", *tie, "latitude", "longitude")},
        width_s=width_s,
        look_back_s=seconds_of(look_back),
    )
    fresh = F.col("_ping.ping_time") > F.col("delivery_assign_time") - F.expr(f"interval {look_back}")
    seen = seen.withColumn("_ping", F.when(fresh, F.col("_ping")))
    if not keep_unseen:
        seen = seen.where(F.col("_ping").isNotNull())
    # Orders with several assignment rows keep the one with the latest ping.
    row = F.struct(F.col("_ping"), *[c for c in seen.columns if c not in ("_ping", "order_id")])
    best = seen.groupBy("order_id").agg(F.max(row).alias("_row")).select("order_id", "_row.*")
    return (
        best.withColumn("accept_latitude", F.coalesce("_ping.latitude", "accept_latitude"))
        .withColumn("accept_longitude", F.coalesce("_ping.longitude", "accept_longitude"))
        .drop("_ping")
        .withColumn("grass_date", F.col("order_date"))
    )


PHASES = {
    "before": ("delivery_assign_time", "delivery_pickup_time"),
    "middle": ("delivery_pickup_time", "delivery_delivered_time"),
    "after": ("delivery_delivered_time", "delivery_delivered_time"),
}


def order_pings(
    orders: DataFrame,
    pings: DataFrame,
    phase: str,
    pad: str = PAD,
    width_s: int = HOUR,
    lo: date | None = None,
    hi: date | None = None,
) -> DataFrame:
    """Distinct pings of each order before pickup, on the trip, or after delivery.

    With ``lo`` and ``hi`` (order days) the scan of pings is limited to these days and
    one more on the side the phase can reach: that range cannot be derived from the
    interval, so it has to be stated.
    """
    start, end = (F.col(c) for c in PHASES[phase])
    widen = F.expr(f"interval {pad}")
    if phase == "before":
        start = start - widen
    if phase == "after":
        end = end + widen
    rows = orders.select(*ORDER_COLUMNS).distinct().withColumns({"_lo": start, "_hi": end})
    within = None
    if lo is not None:
        first, last = lo - timedelta(days=1), hi + timedelta(days=1 if phase == "after" else 0)
        rows = rows.where(F.col("order_date").between(F.lit(lo), F.lit(hi)))
        pings = pings.where(F.col("ping_date").between(F.lit(first), F.lit(last)))
        within = (datetime.combine(first, datetime.min.time()), datetime.combine(last, datetime.max.time()))
    joined = interval_join(
        rows,
        distinct_pings(pings),
        "driver_id",
        "ping_time",
        "_lo",
        "_hi",
        width_s=width_s,
        within=within,
    )
    return joined.drop("_lo", "_hi").withColumn("grass_date", F.col("order_date"))


def with_trip_phase(df: DataFrame, pad: str = PAD) -> DataFrame:
    """Name the phase of each ping; on a shared end the earlier phase wins, no ping gives NULL."""
    widen = F.expr(f"interval {pad}")
    t, assigned, picked, delivered = (
        F.col(c)
        for c in ("ping_time", "delivery_assign_time", "delivery_pickup_time", "delivery_delivered_time")
    )
    return df.withColumn(
        "period",
        F.when(t.between(assigned - widen, picked), "early")
        .when(t.between(picked, delivered), "middle")
        .when(t.between(delivered, delivered + widen), "end"),
    )
