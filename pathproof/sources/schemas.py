"""Schemas of the inputs, by the names the jobs use."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(text: str) -> T.StructType:
    kinds = {
        "long": T.LongType(),
        "int": T.IntegerType(),
        "double": T.DoubleType(),
        "text": T.StringType(),
        "day": T.DateType(),
        "time": T.TimestampNTZType(),
    }
    return T.StructType(
        [T.StructField(name, kinds[kind]) for name, kind in (item.split(":") for item in text.split())]
    )


RAW_PING = _schema(
    "driver_id:long latitude:double longitude:double upload_time:long mtime:long head:int accuracy:double "
    "speed:double altitude:double device_id:text provider:text upload_date:day"
)
ORDER = _schema(
    "id:long driver_id:long buyer_id:long merchant_id:long delivery_id:long create_timestamp:long "
    "pick_timestamp:long deliver_timestamp:long city_name:text order_status_id:int service_category_id:int "
    "app_type_id:int grass_region:text"
)
FOOD_VERSION = _schema(
    "order_id:long driver_id:long create_time:time delivery_assign_time:time delivery_pickup_time:time "
    "delivery_delivered_time:time order_status:text ingestion_timestamp:time"
)
PARCEL = _schema(
    "order_id:long driver_id:long create_time:time assign_time:time pickup_time:time "
    "delivery_complete_time:time service_type:int order_status:int"
)
ASSIGNMENT = _schema("order_id:long driver_id:long location:text create_time:long status:int")
ACCEPT_PAIR = _schema(
    "order_id:long driver_id:long store_latitude:double store_longitude:double driver_latitude:double "
    "driver_longitude:double create_time:long dt:text"
)
STORE_POINT = _schema("ref_order_id:long uid:long pick_latitude:double pick_longitude:double ref_order_category:int")
PROFILE = _schema("uid:long account_id:long last_name:text first_name:text working_city_id:long")
CITY = _schema("id:long name:text country_id:int")
ACCOUNT = _schema("uid:long account_id:long status:int")
RISK_EVENT = _schema(
    "user_id:long event_id:int event_name:text event_local_datetime:time grass_date:day grass_region:text "
    "sync_event_hit_result:text entities:text platform:int"
)
ORDER_DEVICE = _schema("order_id:long security_device_id:text platform:int risk_tags:text")
REVIEW = _schema("order_id:text is_hit:text pic:text")
BAD_DEBT = _schema(
    "order_created_date:day fraud_code:text source:text purpose_en:text order_code:text driver_id:long "
    "balance:double amount_charge_back:double exchange_rate:double"
)
ORDER_TAG = _schema(
    "order_id:long driver_id:long driver_account_id:long order_date:day order_city:text service_type:text "
    "store_latitude:double store_longitude:double accept_latitude:double accept_longitude:double "
    "delivery_assign_time:time delivery_pickup_time:time delivery_delivered_time:time behavior:text grass_date:day"
)

INPUTS = {
    "raw_ping": RAW_PING,
    "order": ORDER,
    "food_version": FOOD_VERSION,
    "parcel": PARCEL,
    "assignment": ASSIGNMENT,
    "accept_pair": ACCEPT_PAIR,
    "store_point": STORE_POINT,
    "profile": PROFILE,
    "city": CITY,
    "account": ACCOUNT,
    "risk_event": RISK_EVENT,
    "order_device": ORDER_DEVICE,
    "order_tag": ORDER_TAG,
    "review": REVIEW,
    "bad_debt": BAD_DEBT,
}
