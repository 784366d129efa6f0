"""Views of the test tables with the columns the jobs expect.

``events`` is the ping log and the order log: ``purchase`` rows are orders, all others
are pings. The view texts run unchanged in Spark and in the engine that checks the
results; only the base views over ``events`` and ``lineitem`` differ by dialect.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_JITTER = "case when user_id % 6 = 0 and event_id % 8 <> 0 then (event_id % 9 + 1) * 0.00000001 else 0 end"
_STORE = "case when event_id % 4 = 0 then 0 else 0.0100001 end"
_TAG = "case k % {n} when 0 then 'is_repack' when 1 then 'is_fake_df' when 2 then 'is_running_magisk' else 'none' end"

VIEWS = {
    "pings": f"""
        select 'e' || cast(event_id as string) as device_id, user_id as driver_id, ts as ping_time, ts as upload_time,
          cast(ts as date) as ping_date,
          cast(cast(10 + (user_id % 50) * 0.01 + (event_id % 7) * 0.0123456 + {_JITTER} as decimal(18,9)) as double)
            as latitude,
          cast(cast(106 + (user_id % 30) * 0.01 + (event_id % 5) * 0.0123456 + {_JITTER} as decimal(18,9)) as double)
            as longitude,
          case when event_id % 24 = 2 then 1.1e0 * 3600 / 1000 when event_id % 24 = 8 then 2.2e0 * 3600 / 1000
               when event_id % 24 = 14 then 8.2e0 * 3600 / 1000 else
            cast(cast(case when event_id % 6 = 0 then k * 0.36 when event_id % 6 = 1 then 0.36
               else event_id % 60 + 0.12345 end as decimal(18,5)) as double) end as speed_kmh,
          cast(cast((case user_id % 5 when 0 then 0 when 1 then 1 when 2 then 3 when 3 then 4 else 7 end)
            + case when (user_id % 4 = 0 and event_id % 10 = 0) or (user_id % 4 <> 0 and event_id % 10 <> 0)
                   then (event_id % 97) * 0.00100 + 0.00012 else (event_id % 9) * 0.10 end as decimal(18,5)) as double)
            as accuracy,
          cast(event_id % 8 as int) as head
        from ev where event_type <> 'purchase'""",
    "trips": f"""
        select event_id as order_id, user_id as driver_id, ts as create_time, cast(ts as date) as order_date,
          ts - interval 72 hours as delivery_assign_time, ts as delivery_pickup_time,
          ts + interval 6 hours as delivery_delivered_time,
          case event_id % 3 when 0 then 'food' when 1 then 'fresh' else 'parcel' end as service_type,
          cast(10.1234567 + (user_id % 10) * 0.01 as decimal(18,7)) as accept_latitude,
          cast(106.1234567 + (user_id % 10) * 0.01 as decimal(18,7)) as accept_longitude,
          cast(10.1234567 + (user_id % 10) * 0.01 + {_STORE} as decimal(18,7)) as store_latitude,
          cast(106.1234567 + (user_id % 10) * 0.01 + {_STORE} as decimal(18,7)) as store_longitude
        from ev where event_type = 'purchase'""",
    # Bursts of pings five seconds apart, with a copy by another device, and orders that end within a burst.
    "dense_pings": f"""
        select case when copied = 1 then 'x' else 'd' end || cast(event_id % 3 as string) as device_id,
          user_id as driver_id, seen_at as ping_time, seen_at as upload_time, cast(seen_at as date) as ping_date,
          cast(cast(10 + (user_id % 50) * 0.01 + {_JITTER}
            + case when event_id % 8 = 0 and n >= 3 then 0.02 else 0 end as decimal(18,9)) as double) as latitude,
          cast(cast(106 + (user_id % 30) * 0.01 + {_JITTER} as decimal(18,9)) as double) as longitude,
          case event_id % 20 when 0 then 1.1e0 * 3600 / 1000 when 4 then 0.36e0 when 8 then 3.6e0
            when 12 then 8.2e0 * 3600 / 1000 else 10.0e0 + n end as speed_kmh,
          case when event_id % 20 in (4, 8) then 5.0e0
               when event_id % 12 = 0 and n in (3, 4) then 7.5e0
               when event_id % 16 = 4 then 1.25e0
               when event_id % 16 = 8 then cast(cast(event_id % 5 + 0.12345 as decimal(18,5)) as double)
               else cast(cast(event_id % 9 * 0.5 as decimal(18,5)) as double) end as accuracy,
          cast(4 + event_id % 3 as int) as head
        from burst_ev where event_type <> 'purchase'""",
    "dense_trips": """
        select event_id as order_id, user_id as driver_id, ts as create_time, cast(ts as date) as order_date,
          ts - interval 1 minutes as delivery_assign_time,
          ts + case when event_id % 8 = 4 then interval 10 seconds else interval 30 seconds end as delivery_pickup_time,
          ts + case when event_id % 8 = 4 then interval 20 seconds else interval 31 seconds end
            as delivery_delivered_time, 'food' as service_type
        from ev where event_type <> 'purchase' and event_id % 4 = 0""",
    "raw_pings": """
        select user_id + 100000 as driver_id, event_id,
          cast(10 + (user_id % 50) * 0.01 + (event_id % 7) * 0.0123456 as decimal(18,9)) as latitude,
          cast(106 + (user_id % 30) * 0.01 + (event_id % 5) * 0.0123456 as decimal(18,9)) as longitude,
          sec * 1000 + event_id % 1000 as upload_time, sec + event_id % 40 - 10 as mtime,
          cast(event_id % 8 as int) as head,
          cast((event_id % 97) * 0.00100 + 0.00012 as decimal(18,5)) as accuracy,
          cast(event_id % 40 as double) / 10 as speed,
          'd' || cast(user_id % 20 as string) as device_id
        from ev where event_type <> 'purchase'""",
    "raw_orders": """
        select event_id as id, case when event_id % 11 = 0 then 0 else user_id end as driver_id,
          user_id as buyer_id, sec as create_timestamp, sec + 600 as pick_timestamp, sec + 3600 as deliver_timestamp,
          'city' || cast(user_id % 5 as string) as city_name,
          case when event_id % 10 = 0 then 9 else 7 end as order_status_id,
          case event_id % 3 when 0 then 1 when 1 then 5 else 2 end as service_category_id
        from ev where event_type = 'purchase'""",
    "assign_log": """
        select event_id as order_id, user_id as driver_id,
          case when event_id % 7 = 0 then 'unknown' when event_id % 13 = 0 then '10.5'
               else cast(10 + user_id % 10 as string) || '.5,' || cast(106 + user_id % 10 as string) || '.25'
          end as location,
          sec + 2700 as create_time, cast(2 + event_id % 4 as int) as status
        from ev where event_type = 'purchase'""",
    "store_log": """
        select event_id as ref_order_id, user_id as uid,
          cast(10 + (user_id % 10) * 0.01 as decimal(18,7)) as pick_latitude,
          cast(106 + (user_id % 10) * 0.01 as decimal(18,7)) as pick_longitude,
          case when event_id % 6 = 0 then 1 else 0 end as ref_order_category
        from ev where event_type = 'purchase'""",
    "profiles": """
        select c_custkey as uid, c_custkey + 100000 as account_id, c_mktsegment as last_name, c_name as first_name,
          c_nationkey as working_city_id from customer""",
    "cities": """
        select n_nationkey as id, n_name as name, case when n_regionkey = 0 then 1 else 86 end as country_id
        from nation""",
    "food_versions": """
        select l_orderkey as order_id, l_suppkey as driver_id, l_shipdate as create_time,
          l_shipdate + interval 5 minutes as delivery_assign_time,
          l_shipdate + interval 20 minutes as delivery_pickup_time,
          l_shipdate + interval 50 minutes as delivery_delivered_time,
          case when l_linestatus = 'O' then 'ORDER_DELIVERED' when l_returnflag = 'A' then 'ORDER_COMPLETED'
               else 'ORDER_CANCELLED' end as order_status,
          l_shipdate as ingestion_timestamp from lineitem""",
    "parcels": """
        select o_orderkey + 10000000 as order_id, o_custkey as driver_id, o_orderdate as create_time,
          o_orderdate + interval 1 hours as assign_time, o_orderdate + interval 2 hours as pickup_time,
          o_orderdate + interval 8 hours as delivery_complete_time, cast(o_orderkey % 4 as int) as service_type,
          case o_orderstatus when 'F' then 800 when 'O' then 440 else 100 end as order_status from orders""",
    "pair_log": """
        select l_orderkey as order_id, l_suppkey as driver_id,
          cast(10.1234567 + l_discount as decimal(18,7)) as store_latitude,
          cast(106.1234567 + l_tax as decimal(18,7)) as store_longitude,
          cast(10.1234567 + l_tax as decimal(18,7)) as driver_latitude,
          cast(106.1234567 + l_discount as decimal(18,7)) as driver_longitude,
          (ship_day * 86400 + 3600) * 1000 as create_time, cast(cast(l_shipdate as date) as string) as dt from li""",
    "risk_events": f"""
        select user_id, 16 as event_id, ts as event_local_datetime, cast(ts as date) as grass_date,
          case k % 10 when 0 then 'B00' when 1 then null else 'P00' end as sync_event_hit_result,
          case when k % 17 = 0 then null
               when k % 13 = 0 then '{{"DFPInfoSZ":{{"tags":null}}}}'
               when k % 11 = 0 then '{{"DFPInfoSZ":{{"tags":"is_repack"}}}}'
               else '{{"DFPInfoSZ":{{"tags":["' || {_TAG.format(n=7)} || '","' || {_TAG.format(n=5)} || '"]}}}}'
          end as entities
        from ev where event_type = 'error'""",
    "login_events": """
        select user_id, 151 as event_id, ts as event_local_datetime, cast(ts as date) as grass_date,
          '{"DFPInfoSZ":{"SecurityDeviceID":"' || case when k % 9 = 0 then ' '
              else 'd' || cast(user_id % 20 as string) || '-' || cast(k % 3 as string) end
            || '","tags":' || case k % 4 when 0 then '"null"' when 1 then '"is_emulator,other"'
                when 2 then '["is_emulator"]' else '"is_fake_deviceinfo"' end || '}}' as entities,
          cast(k % 3 as int) as platform
        from ev where event_type in ('error', 'signup')""",
    "buyer_orders": """
        select event_id as order_id, event_id + 5 as delivery_id, ts as create_time, user_id as buyer_id,
          user_id % 7 as store_id, user_id % 7 as merchant_id, user_id % 30 as driver_id,
          cast(case when event_id % 10 = 3 then 5 else 7 end as int) as delivery_status,
          cast(50 + event_id % 3 as int) as app_type_id
        from ev where event_type = 'purchase'""",
    "accounts": """
        select c_custkey as uid, c_custkey as account_id, cast(case when c_custkey % 12 = 5 then 0 else 1 end as int)
          as status from customer""",
    "order_risk": """
        select event_id as order_id, case when event_id % 6 = 3 then '' else 'own' || cast(user_id as string) end
            as security_device_id, cast(event_id % 3 as int) as platform,
          case when event_id % 2 = 0 then '[]' else 'is_repack' end as risk_tags
        from ev where event_type = 'purchase' and event_id % 3 = 0""",
    "tagged": """
        select t.*, b.behavior from trips t join (
          select event_id as id, case event_id % 5 when 0 then 'Rules_A' when 1 then 'Rules_B' when 2 then 'Proxy_A'
            else '' end as behavior from ev where event_type = 'purchase'
          union all
          select event_id, 'Proxy_B' from ev where event_type = 'purchase' and event_id % 15 = 0
        ) b on t.order_id = b.id""",
    "reviewed_orders": "select doc_id as order_id, doc_id % 50 as driver_id from documents",
    "reviews": """
        select cast(doc_id as string) as order_id, cast(toxic as string) as is_hit,
          case when quality = 1 then 'first' else 'second' end as pic from labels""",
    "bad_debt": """
        select cast(l_shipdate as date) as order_created_date, 'dc-0' || cast(l_linenumber as string) as fraud_code,
          case when l_returnflag = 'R' then 'fresh' else 'food' end as source, l_suppkey as driver_id,
          l_quantity as balance, l_extendedprice * l_tax as amount_charge_back,
          case when l_linenumber = 7 then 0.0e0 else 23000.0e0 end as exchange_rate from lineitem""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        "user_id",
        "event_type",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.expr(
            "cast(unix_date(cast(ts as date)) as bigint) * 86400 + hour(ts) * 3600 + minute(ts) * 60 + second(ts)"
        ).alias("sec"),
    )


def _li(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").withColumn(
        "ship_day", F.unix_date(F.col("l_shipdate").cast("date")).cast("bigint")
    )


def _burst_ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events nine times: at 0, 5 ... 35 seconds, and once more at 10 seconds."""
    each = _ev(spark, sf_dir).withColumn("m", F.explode(F.sequence(F.lit(0), F.lit(8))))
    copied, zero = F.col("m") == 8, F.lit(0)
    n = F.when(copied, 2).otherwise(F.col("m"))
    return each.withColumns(
        {"copied": copied.cast("int"), "n": n, "seen_at": F.col("ts") + F.make_dt_interval(zero, zero, zero, n * 5)}
    ).drop("m")


_BASE = {"ev": _ev, "li": _li, "burst_ev": _burst_ev}
_TABLES = ("customer", "nation", "lineitem", "orders", "documents", "labels")


def sources_of(text: str) -> list[str]:
    """Names a view reads."""
    return [n for n in re.findall(r"(?:from|join)\s+(\w+)", text) if n in VIEWS or n in _BASE or n in _TABLES]


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name in _BASE:
        return _BASE[name](spark, sf_dir)
    if name not in VIEWS:
        return table(spark, sf_dir, name)
    text = VIEWS[name].replace("{", "{{").replace("}", "}}")
    read = {n: view(spark, sf_dir, n) for n in dict.fromkeys(sources_of(VIEWS[name]))}
    for n in read:
        text = re.sub(rf"((?:from|join)\s+){n}\b", rf"\g<1>{{{n}}}", text)
    return spark.sql(text, **read)
