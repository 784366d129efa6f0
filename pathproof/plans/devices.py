"""Which device placed a buyer's order, and how risky it is."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathproof.functions import json_scalars
from pathproof.operators import HOUR, asof_lookup

# Fixed values of the device log.
DEVICE_PATH = "$.DFPInfoSZ.SecurityDeviceID"
DEVICE_TAGS_PATH = "$.DFPInfoSZ.tags"
LOGIN_EVENTS = (151,)
LOOK_BACK_S = 259200
APP_TYPES = (50, 51)
ORDER_STATUSES = (7, 9)
SECOND_PLATFORM = 2

# Tags of a risky device. They are matched anywhere in the tag text. The
# original pattern wraps lines, so its first entry of each line starts with a line
# break and blanks and never matches; here every entry counts.
RISKY_TAGS = (
    "is_plt_hook",
    "is_inline_hook",
    "is_app_multi_open_system",
    "is_app_multi_open_app",
    "is_app_multi_open_system_vmos",
    "is_emulator",
    "is_system_debuggable",
    "is_debugging",
    "is_auto_framework",
    "is_phone_farm",
    "is_gps_modified",
    "is_cloud_phone",
    "is_repack",
    "is_wrong_pkg_name",
    "is_black_rom",
    "is_fake_protocol",
    "is_fake_df",
    "is_no_deviceinfo",
    "is_fake_deviceinfo",
    "is_suspicious_so",
    "is_newdevice_haverisk",
    "is_ochook",
    "is_fishhook",
    "is_risk_app_running_cheatingapp",
    "is_risk_app_running_automation",
    "is_binder_hook",
    "is_signature_api_hook",
    "is_deviceinfo_lost",
    "is_lsposed_running",
    "is_faker_edxposed_running",
    "is_faker_virtualapp_running",
    "is_faker_lsposed_running",
    "is_app_debuggable",
    "is_java_hook",
    "is_running_acc_autojs",
    "is_lspatch_repack",
)
RISKY_TAGS_SECOND_PLATFORM = ("is_newdevice_haverisk", "is_fake_deviceinfo")


def buyer_orders(
    orders: DataFrame,
    accounts: DataFrame,
    lo: date | None = None,
    hi: date | None = None,
    statuses: Sequence[int] = ORDER_STATUSES,
) -> DataFrame:
    """Finished orders with the buyer's account; an inactive account gives NULL, not a lost order."""
    done = orders.where(F.col("delivery_status").isin(*statuses))
    if lo is not None:
        done = done.where(F.to_date("create_time").between(F.lit(lo), F.lit(hi)))
    active = accounts.where("status = 1").select(F.col("uid").alias("buyer_id"), "account_id")
    return done.join(active, "buyer_id", "left")


def login_devices(
    events: DataFrame,
    orders: DataFrame,
    lo: date | None = None,
    hi: date | None = None,
    event_ids: Sequence[int] = LOGIN_EVENTS,
    device_path: str = DEVICE_PATH,
    tags_path: str = DEVICE_TAGS_PATH,
) -> DataFrame:
    """Device of each login event, on days the account also ordered."""
    wanted = events.where(F.col("event_id").isin(*event_ids))
    if lo is not None:
        wanted = wanted.where(F.col("grass_date").between(F.lit(lo - timedelta(days=4)), F.lit(hi)))
    days = (
        orders.where("account_id is not null")
        .select(F.col("account_id").alias("user_id"), F.to_date("create_time").alias("grass_date"))
        .distinct()
    )
    return (
        wanted.join(days, ["user_id", "grass_date"], "left_semi")
        .select(
            F.col("user_id").try_cast("bigint").alias("account_id"),
            F.col("event_local_datetime").alias("date_time"),
            "platform",
            F.inline(json_scalars("entities", device=device_path, tags=tags_path)),
        )
        .where(F.trim("device") != "")
    )


def attribute_devices(
    orders: DataFrame,
    order_risk: DataFrame,
    logins: DataFrame,
    app_types: Sequence[int] = APP_TYPES,
    look_back_s: int = LOOK_BACK_S,
    risky: Sequence[str] = RISKY_TAGS,
    risky_second: Sequence[str] = RISKY_TAGS_SECOND_PLATFORM,
    width_s: int = HOUR,
) -> DataFrame:
    """Device, tags and risk flag per order, from its own record or the last login before it.

    One order per buyer and time gets the device. Orders without any device are
    dropped; a blank but present device id stays, as in the original condition.
    """
    c = F.col
    keyed = orders.withColumn("_account", F.when(c("app_type_id").isin(*app_types), c("account_id").try_cast("bigint")))
    seen = asof_lookup(
        keyed,
        logins.withColumnRenamed("account_id", "_account"),
        "_account",
        "create_time",
        "date_time",
        {"_login": F.struct("date_time", "device", "tags", "platform")},
        width_s=width_s,
        look_back_s=look_back_s,
    )
    recent = c("_login.date_time") >= c("create_time") - F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), F.lit(look_back_s)
    )
    own = order_risk.select(
        "order_id",
        c("security_device_id").alias("_own_device"),
        c("platform").alias("_own_platform"),
        c("risk_tags").alias("_own_tags"),
    )
    merged = (
        seen.withColumn("_login", F.when(recent, c("_login")))
        .join(own, "order_id", "left")
        .withColumns(
            {
                "device": F.coalesce("_own_device", "_login.device"),
                "platform": F.coalesce(F.when(c("_own_device") != "", c("_own_platform")), c("_login.platform")),
                "tags": F.coalesce(
                    F.when(c("_own_tags") != "[]", c("_own_tags")),
                    F.when(c("_login.tags") != "null", c("_login.tags")),
                ),
                "device_time": F.when(c("_own_device").isNull(), c("_login.date_time")).otherwise(c("create_time")),
            }
        )
    )
    risk = c("tags").rlike("|".join(risky)) | (
        (c("platform") == SECOND_PLATFORM) & c("tags").rlike("|".join(risky_second))
    )
    flagged = merged.withColumn("is_high_risk_tag", F.when(risk, 1).otherwise(0))
    # Latest device per buyer and order time: an aggregate, combined before the shuffle.
    columns = [x for x in flagged.columns if x not in ("buyer_id", "create_time", "device_time", "order_id")
               and not x.startswith("_")]
    best = F.max(F.struct("device_time", "order_id", *columns)).alias("_best")
    return (
        flagged.groupBy("buyer_id", "create_time")
        .agg(best)
        .select("buyer_id", "create_time", "_best.*")
        .where(c("device").isNotNull())
        .drop("device_time", "account_id")
        .withColumns(
            {
                # Two older device sources are gone; their columns stay in the table, empty.
                "account_df": F.lit(None).cast("string"),
                "vendor_df": F.lit(None).cast("string"),
                "grass_date": F.to_date("create_time"),
                "grass_month": F.date_format("create_time", "yyyy-MM"),
            }
        )
    )
