"""The same results in plain SQL, written order by order and ping by ping.

These statements follow the definition of each result, not the plan of the jobs: every
rule looks at all pings of every order with ordinary window functions.
"""

from __future__ import annotations

from pathproof.testbed.frames import VIEWS, sources_of

# Fixed values, written out here: nothing is taken from the code that the statements check.
PER_CLASS = 40
ACCURACY_ROW = "ping_time, upload_time, accuracy"
FULL_ROW = "ping_time, upload_time, latitude, longitude, speed_kmh, accuracy, head"
SPEED_GROUPS = ("0.36, 3.6", "0.72, 7.2", "10.8")
FLAG_AT = {"006": 3, "016": 3, "115": 3}

#: Run rules: columns a row consists of, what five rows in a row match, and what pardons on the trip.
RUNS = {
    "010": (FULL_ROW, "lat_digit > 7 and lon_digit > 7", None),
    "016": (ACCURACY_ROW, "round_accuracy = 1 and acc_digit < 5", "round_accuracy = 1"),
    "017": (ACCURACY_ROW, "round_accuracy = 0 and acc_digit < 5", "round_accuracy = 0"),
    "109": (ACCURACY_ROW, "round_accuracy = 4 and acc_digit >= 5", "acc_digit >= 5"),
    "111": (ACCURACY_ROW, "round_accuracy = 0 and acc_digit >= 5", "acc_digit >= 5"),
    "112": (ACCURACY_ROW, "round_accuracy = 1 and acc_digit >= 5", "acc_digit >= 5"),
    "113": (ACCURACY_ROW, "round_accuracy = 7 and acc_digit >= 5", "acc_digit >= 5"),
    "114": (ACCURACY_ROW, "round_accuracy = 3 and acc_digit >= 5", "acc_digit >= 5"),
    "115": (ACCURACY_ROW, "acc_digit >= 5", "acc_digit >= 5"),
    "209": (ACCURACY_ROW, "round_accuracy = 4 and acc_digit >= 5 and speed_digit >= 5", None),
    "211": (ACCURACY_ROW, "round_accuracy = 0 and acc_digit >= 5 and speed_digit >= 5", None),
    "212": (ACCURACY_ROW, "round_accuracy = 1 and acc_digit >= 5 and speed_digit >= 5", None),
    "213": (ACCURACY_ROW, "round_accuracy = 7 and acc_digit >= 5 and speed_digit >= 5", None),
    "214": (ACCURACY_ROW, "round_accuracy = 3 and acc_digit >= 5 and speed_digit >= 5", None),
    "215": (ACCURACY_ROW, "acc_digit >= 5 and speed_digit >= 5", None),
}
CODES = ("006", "008", *RUNS)

BEHAVIORS = {
    "016": "Proxy_Repetitive same accuracy",
    "017": "Proxy_Repetitive same accuracy",
    "209": "Proxy_Repetitive long decimal digit of accuracy and speed",
    "211": "Proxy_Repetitive long decimal digit of accuracy and speed",
    "212": "Proxy_Repetitive long decimal digit of accuracy and speed",
    "213": "Proxy_Repetitive long decimal digit of accuracy and speed",
    "214": "Proxy_Repetitive long decimal digit of accuracy and speed",
    "215": "Proxy_Repetitive long decimal digit of accuracy and speed",
    "app": "Proxy_Repacked App usage",
    "001": "Rules_Accepted at the store point",
    "004": "Rules_Repeated accept point",
    "006": "Rules_Jump between pings",
    "008": "Rules_Repeated typical speed",
    "010": "Rules_Long coordinates",
    "109": "Rules_Repetitive long decimal digit of accuracy",
    "111": "Rules_Repetitive long decimal digit of accuracy",
    "112": "Rules_Repetitive long decimal digit of accuracy",
    "113": "Rules_Repetitive long decimal digit of accuracy",
    "114": "Rules_Repetitive long decimal digit of accuracy",
    "115": "Rules_Repetitive long decimal digit of accuracy",
}

TAMPERED_APP_TAGS = """is_repack_v7 is_repack_v6 is_fake_protocol is_cinfo_lost is_repack is_repack_v2 is_repack_v3
  is_repack_v4 is_repack_v5 is_lspatch_repack_tag is_suspicious_so is_wrong_pkg_name is_no_deviceid_match is_fake_df
  is_status_code_dex_fail is_status_code_collect_fail is_status_code_report_fail is_fake_android_so is_df_length_long
  is_running_magisk is_running_magisk_v2 is_faker_edxposed_running""".split()

RISKY_TAGS = """is_plt_hook is_inline_hook is_app_multi_open_system is_app_multi_open_app is_app_multi_open_system_vmos
  is_emulator is_system_debuggable is_debugging is_auto_framework is_phone_farm is_gps_modified is_cloud_phone is_repack
  is_wrong_pkg_name is_black_rom is_fake_protocol is_fake_df is_no_deviceinfo is_fake_deviceinfo is_suspicious_so
  is_newdevice_haverisk is_ochook is_fishhook is_risk_app_running_cheatingapp is_risk_app_running_automation
  is_binder_hook is_signature_api_hook is_deviceinfo_lost is_lsposed_running is_faker_edxposed_running
  is_faker_virtualapp_running is_faker_lsposed_running is_app_debuggable is_java_hook is_running_acc_autojs
  is_lspatch_repack""".split()
RISKY_TAGS_SECOND_PLATFORM = ("is_newdevice_haverisk", "is_fake_deviceinfo")

FRAUD_KINDS = {
    "dc-011": "Driver complete order with delivering food",
    "dc-004": "Driver complete order with delivering food",
    "dc-018": "Improper use of edit order function to change order amount",
    "dc-007": "Collusion / Fake / Suspicious Orders",
    "dc-008": "Collusion / Fake / Suspicious Orders",
    "dc-014": "Collusion / Fake / Suspicious Orders",
    "dc-017": "Collusion / Fake / Suspicious Orders",
}

ORACLES: dict[str, str] = {}

_BASE = {
    "ev": """select event_id, ts, user_id, event_type, cast(json_extract_string(props, '$.k') as int) as k,
      cast(epoch(date_trunc('second', ts)) as bigint) as sec from events""",
    "burst_ev": """select * exclude (m), case when m = 8 then 1 else 0 end as copied,
        case when m = 8 then 2 else m end as n, ts + to_seconds(5 * case when m = 8 then 2 else m end) as seen_at
      from (select event_id, ts, user_id, event_type, unnest(range(9)) as m from events)""",
    "li": """select *, cast(date_diff('day', date '1970-01-01', cast(l_shipdate as date)) as bigint) as ship_day
      from lineitem""",
}


def _needed(text: str) -> list[str]:
    names: list[str] = []
    for n in sources_of(text):
        if n not in _BASE and n not in VIEWS:
            continue
        for deeper in _needed(VIEWS[n]) if n in VIEWS else []:
            if deeper not in names:
                names.append(deeper)
        if n not in names:
            names.append(n)
    return names


def _digits(x: str) -> str:
    """Of the number's own text: digits of the mantissa, less the exponent where there is one."""
    text = f"cast({x} as varchar)"
    mantissa, power = f"split_part({text}, 'e', 1)", f"split_part({text}, 'e', 2)"
    fraction = f"length(rtrim(split_part({mantissa}, '.', 2), '0'))"
    return f"greatest(0, {fraction} - cast(coalesce(nullif({power}, ''), '0') as int))"


_MEASURED = f"""floor(accuracy) as round_accuracy, {_digits('accuracy')} as acc_digit,
  {_digits('speed_kmh')} as speed_digit, {_digits('latitude')} as lat_digit, {_digits('longitude')} as lon_digit"""

_ORDER = """o.order_id, o.driver_id, o.create_time, o.order_date, o.delivery_assign_time, o.delivery_pickup_time,
  o.delivery_delivered_time, o.service_type"""


def _phase(lo: str, hi: str, orders: str = "trips", pings: str = "pings") -> str:
    return f"""select distinct {_ORDER}, p.device_id, p.ping_time, p.upload_time, p.latitude, p.longitude,
      p.speed_kmh, p.head, p.accuracy, {_MEASURED}
      from {orders} o join {pings} p on o.driver_id = p.driver_id and p.ping_time between {lo} and {hi}"""


_BEFORE = ("o.delivery_assign_time - interval 5 minutes", "o.delivery_pickup_time")
_MIDDLE = ("o.delivery_pickup_time", "o.delivery_delivered_time")


def _add(name: str, body: str, **ctes: str) -> None:
    """``body`` over ``ctes`` over the views both of them read."""
    text = " ".join([*ctes.values(), body])
    views = _needed(text)
    parts = [f"{n} as ({_BASE.get(n) or VIEWS[n]})" for n in views]
    parts += [f"{n} as ({sql})" for n, sql in ctes.items()]
    ORACLES[name] = (f"with {', '.join(parts)} " if parts else "") + body


# ---------------------------------------------------------------- columns and sources

_add(
    "fraction_digits",
    f"""select device_id, {_digits('accuracy')} as acc_digit, {_digits('speed_kmh')} as speed_digit,
    {_digits('latitude')} as lat_digit, {_digits('(latitude / 1000000)')} as small_digit,
    cast(case when {_digits('latitude')} > 7 then round(cast(latitude as decimal(18,9)), 7)
      else cast(latitude as decimal(18,9)) end as decimal(18,9)) as lat7 from pings""",
)

_UPLOAD = "upload_time // 1000"
_TIMES = f"""make_timestamp(({_UPLOAD} - 3600) * 1000000) as upload_time,
  make_timestamp((mtime - 3600) * 1000000) as modify_time,
  make_timestamp((case when mtime - {_UPLOAD} between -5 and 20 then {_UPLOAD} else mtime end - 3600) * 1000000)
    as ping_time"""

_add(
    "resolve_ping_time",
    "select event_id, upload_time, modify_time, ping_time, cast(ping_time as date) as ping_date from timed",
    timed=f"select event_id, {_TIMES} from raw_pings",
)
_add(
    "clean_pings",
    """select event_id, account_id as driver_account_id, uid as driver_id, last_name || ' ' || first_name as driver_name,
    c.name as driver_city, ping_time, upload_time, latitude, longitude, accuracy,
    cast(round_accuracy as bigint) as round_accuracy, acc_digit, round(speed_kmh, 6) as speed_kmh, speed_digit,
    lat_digit, lon_digit, head, device_id, cast(ping_time as date) as grass_date
    from measured m left join profiles s on m.driver = s.account_id
    left join cities c on s.working_city_id = c.id and c.country_id = 86
    where cast(ping_time as date) between date '2024-01-03' and date '2024-01-09'""".replace(
        "account_id as driver_account_id", "m.driver as driver_account_id"
    ),
    timed=f"""select event_id, driver_id as driver, latitude, longitude, accuracy, head, device_id, {_TIMES},
      speed * 3600 / 1000 as speed_kmh from raw_pings""",
    measured=f"select *, {_MEASURED} from timed",
)
_add(
    "clean_pings_by_account",
    f"""select event_id, cast(driver as varchar) as driver_id, ping_time, {_digits('accuracy')} as acc_digit,
    round(speed_kmh, 6) as speed_kmh from timed
    where cast(ping_time as date) = date '2024-01-05' or cast(modify_time as date) = date '2024-01-05'""",
    timed=f"""select event_id, driver_id as driver, accuracy, {_TIMES}, speed * 3600 / 1000 as speed_kmh
      from raw_pings""",
)

_ASSIGNED = """select order_id, driver_id, make_timestamp((create_time - 3600) * 1000000) as delivery_assign_time,
  try_cast(nullif(split_part(location, ',', 1), '') as double) as accept_latitude,
  try_cast(nullif(split_part(location, ',', 2), '') as double) as accept_longitude
  from assign_log where status in (3, 4)"""
_add("assignments", "select * from assigned", assigned=_ASSIGNED)
_add(
    "order_facts",
    """select distinct o.id as order_id, o.driver_id, make_timestamp(create_timestamp * 1000000) as create_time,
    o.city_name as order_city, make_timestamp(pick_timestamp * 1000000) as delivery_pickup_time,
    make_timestamp(deliver_timestamp * 1000000) as delivery_delivered_time, o.order_status_id,
    case service_category_id when 1 then 'food' when 5 then 'fresh' end as service_type,
    cast(make_timestamp(create_timestamp * 1000000) as date) as order_date, s.account_id as driver_account_id,
    s.last_name || ' ' || s.first_name as driver_name, d.pick_latitude as store_latitude,
    d.pick_longitude as store_longitude, a.delivery_assign_time, a.accept_latitude, a.accept_longitude,
    cast(make_timestamp(create_timestamp * 1000000) as date) as grass_date
    from raw_orders o left join profiles s on o.driver_id = s.uid
    left join (select * from store_log where ref_order_category = 0) d
      on o.id = d.ref_order_id and o.driver_id = d.uid
    left join assigned a on o.id = a.order_id and o.driver_id = a.driver_id
    where o.order_status_id = 7 and o.driver_id > 0
      and cast(make_timestamp(create_timestamp * 1000000) as date) between date '2024-01-02' and date '2024-01-20'""",
    assigned=_ASSIGNED,
)
_add(
    "order_facts_union",
    """select distinct cast(o.order_id as varchar) as order_id, cast(o.driver_id as varchar) as driver_id, create_time,
      cast(create_time as date) as order_date, delivery_assign_time, delivery_pickup_time, delivery_delivered_time,
      'food' as service_type
    from food_versions o join (select order_id, max(ingestion_timestamp) as newest from food_versions group by 1) b
      on o.order_id = b.order_id and o.ingestion_timestamp = b.newest
    where order_status in ('ORDER_DELIVERED', 'ORDER_COMPLETED')
    union all
    select distinct cast(order_id as varchar), cast(driver_id as varchar), create_time, cast(create_time as date),
      assign_time, pickup_time, delivery_complete_time, case service_type when 2 then 'parcel_p2p' else 'parcel_c2c' end
    from parcels where order_status in (440, 800) and service_type in (2, 3)""",
)
_add(
    "accept_pairs",
    """select distinct cast(a.order_id as varchar) as order_id, cast(driver_id as varchar) as driver_id, store_latitude,
      store_longitude, driver_latitude as accept_latitude, driver_longitude as accept_longitude
    from pair_log a join (select order_id, max(dt) as newest from pair_log group by 1) b
      on a.order_id = b.order_id and a.dt = b.newest""",
)
_add(
    "latest_version",
    """select event_id, e.user_id, cast(ts as date) as version from ev e
    join (select user_id, max(cast(ts as date)) as newest from ev group by 1) m
      on e.user_id = m.user_id and cast(ts as date) = m.newest""",
)

# ---------------------------------------------------------------- joins of pings and orders

for _name, _bounds in {
    "before": _BEFORE,
    "middle": _MIDDLE,
    "after": ("o.delivery_delivered_time", "o.delivery_delivered_time + interval 6 hours"),
}.items():
    _add(
        f"interval_{_name}",
        """select order_id, driver_id, device_id, ping_time, acc_digit, speed_digit, lat_digit, lon_digit,
        cast(round_accuracy as bigint) as round_accuracy, order_date as grass_date from seen""",
        seen=_phase(*_bounds),
    )


def _phased(pad: str, orders: str = "trips", extra: str = "", pings: str = "pings") -> str:
    lo, hi = f"o.delivery_assign_time - interval {pad}", f"o.delivery_delivered_time + interval {pad}"
    return f"""select distinct {_ORDER}{extra}, p.ping_time, p.latitude, p.longitude, p.speed_kmh, p.accuracy, p.head,
      case when p.ping_time between {lo} and o.delivery_pickup_time then 'early'
        when p.ping_time between o.delivery_pickup_time and o.delivery_delivered_time then 'middle'
        when p.ping_time between o.delivery_delivered_time and {hi} then 'end' end as period
      from {orders} o left join {pings} p on o.driver_id = p.driver_id and p.ping_time between {lo} and {hi}"""


_add("interval_left_full", "select order_id, ping_time, accuracy, head from phased", phased=_phased("5 minutes"))
_add(
    "trip_phase",
    "select order_id, period, count(ping_time) as n from phased group by 1, 2",
    phased=_phased("6 hours"),
)
_add(
    "orders_with_all_phases",
    "select order_id from phased group by 1 having count(distinct period) = 3",
    phased=_phased("6 hours"),
)

for _name, _kind in {"asof_accept_point": "join", "asof_accept_point_or_logged": "left join"}.items():
    _add(
        _name,
        """select order_id, accept_latitude, accept_longitude, store_latitude, order_date as grass_date
        from ranked where rk = 1""",
        ranked=f"""select o.order_id, o.order_date, o.store_latitude,
          coalesce(p.latitude, o.accept_latitude) as accept_latitude,
          coalesce(p.longitude, o.accept_longitude) as accept_longitude,
          row_number() over (partition by o.order_id
            order by p.ping_time desc, p.upload_time desc, p.latitude desc, p.longitude desc) as rk
          from trips o {_kind} pings p on o.driver_id = p.driver_id
            and p.ping_time > o.delivery_assign_time - interval 24 hours and p.ping_time <= o.delivery_assign_time""",
    )

_KM = """2 * 6371.01 * asin(least(1.0, sqrt(pow(sin(radians(next_lat - lat) / 2), 2)
  + cos(radians(lat)) * cos(radians(next_lat)) * pow(sin(radians(next_lon - lon) / 2), 2))))"""


def _with_next(source: str) -> str:
    w = "over (partition by order_id order by ping_time, upload_time, latitude, longitude, speed_kmh, head, accuracy, device_id)"
    return f"""select *, cast(latitude as double) as lat, cast(longitude as double) as lon,
      lead(accuracy) {w} as next_accuracy, lead(ping_time) {w} as next_time,
      cast(lead(latitude) {w} as double) as next_lat, cast(lead(longitude) {w} as double) as next_lon from {source}"""


_add(
    "haversine_lead",
    f"""select order_id, device_id, next_time, next_accuracy, round({_KM}, 6) as km from led
    where date_sub('second', ping_time, next_time) <= 3600 and {_KM} > 0""",
    before=_phase(*_BEFORE),
    led=_with_next("before"),
)

# ---------------------------------------------------------------- rules

_GROUP = "order_date, order_id, driver_id, service_type"


def _hit_by_order(code: str, gap: str = "<= 3600") -> str:
    """(order, hit) of a rule over ``before`` and ``middle``; the jump rule's own gap is exactly 5 seconds."""
    if code == "006":
        return f"""select {_GROUP}, count(case when {_KM} > 1 and next_accuracy < 20
            and date_sub('second', ping_time, next_time) {gap} then 1 end) >= 1 as hit
          from ({_with_next('before')}) group by all"""
    if code == "008":
        counts = [f"count(case when speed_kmh in ({speeds}) then 1 end) >= 3" for speeds in SPEED_GROUPS]
        return f"""select {_GROUP}, {' or '.join(counts)} as hit from (select distinct {_GROUP}, create_time, latitude,
            longitude, speed_kmh, accuracy, head, upload_time, ping_time from before) group by all"""
    row, match, net = RUNS[code]
    pardons = f"left join (select distinct order_id as pardoned from middle where {net}) n on l.order_id = n.pardoned"
    return f"""select {_GROUP}, count(case when c5 - c = 5 {'and pardoned is null' if net else ''} then 1 end) >= 1
        as hit
      from (select *, lead(c, 5) over (partition by order_id order by ping_time, upload_time) as c5
        from (select distinct {_GROUP}, create_time, {row}, count(case when {match} then order_id end)
          over (partition by order_id order by ping_time, upload_time) as c from before)) l
      {pardons if net else ''} group by all"""


def _flagged(code: str, gap: str = "<= 3600") -> str:
    return f"""select h.*, '{code}' as code, d.cnt, case when d.cnt >= {FLAG_AT.get(code, 1)} then 1 else 0 end as flagged
      from ({_hit_by_order(code, gap)}) h left join (
        select order_date, driver_id, count(distinct case when hit then order_id end) as cnt
        from ({_hit_by_order(code, gap)}) group by all) d on h.order_date = d.order_date and h.driver_id = d.driver_id
      where hit and d.cnt >= 1"""


_SEEN = {"before": _phase(*_BEFORE), "middle": _phase(*_MIDDLE)}

for _code in CODES:
    _add(
        f"rule_{_code}",
        f"""select distinct {_GROUP}, hit as is_{_code}, cnt as cnt_{_code}, flagged as dsys{_code},
        order_date as grass_date from ({_flagged(_code)})""",
        **_SEEN,
    )

_ALL = " union all ".join(f"select {_GROUP}, code, cnt, flagged from ({_flagged(c)})" for c in CODES)
_add("all_rules", _ALL, **_SEEN)
_add("rules_per_query", _ALL, **_SEEN)

_REPEATED = """select * from trips union all
  select * replace (delivery_assign_time + interval 20 hours as delivery_assign_time) from trips where order_id % 3 = 0"""
_add(
    "rules_on_repeated_rows",
    " union all ".join(
        f"select {_GROUP}, code, cnt, flagged from ({_flagged(c)})" for c in ("010", "017", "115", "215", "008")
    ),
    repeated=_REPEATED,
    before=_phase(*_BEFORE, "repeated"),
    middle=_phase(*_MIDDLE, "repeated"),
)


def _seven(x: str) -> str:
    return f"(case when {_digits(x)} > 7 then round({x}, 7) else {x} end)"


_SAME_POINT = f"""select {_GROUP}, {' and '.join(f'{_digits(_seven(x))} = 7' for x in
  ('accept_latitude', 'accept_longitude', 'store_latitude', 'store_longitude'))}
  and accept_latitude = store_latitude and accept_longitude = store_longitude as hit from trips"""
_ACCEPTED_AT_STORE = """select h.*, d.cnt from same_point h join (
  select order_date, driver_id, count(distinct case when hit then order_id end) as cnt from same_point group by all) d
  on h.order_date = d.order_date and h.driver_id = d.driver_id where hit"""
_add(
    "rule_001",
    f"""select distinct {_GROUP}, hit as is_001, cnt as cnt_001, 1 as dsys001, order_date as grass_date
    from accepted""",
    same_point=_SAME_POINT,
    accepted=_ACCEPTED_AT_STORE,
)
_REPEATED_POINT = f"""select distinct {', '.join('o.' + c.strip() for c in _GROUP.split(','))}, cnt from trips o join (
    select order_date, driver_id, accept_latitude, accept_longitude, count(distinct order_id) as cnt from trips
    where {_digits('accept_latitude')} = 7 and {_digits('accept_longitude')} = 7 group by all) d
  on o.order_date = d.order_date and o.driver_id = d.driver_id and o.accept_latitude = d.accept_latitude
    and o.accept_longitude = d.accept_longitude where cnt >= 3"""
_add(
    "rule_004",
    f"select {_GROUP}, cnt as cnt_004, 1 as dsys004, order_date as grass_date from repeated_point",
    repeated_point=_REPEATED_POINT,
)

_DENSE = {
    "before": _phase(*_BEFORE, "dense_trips", "dense_pings"),
    "middle": _phase(*_MIDDLE, "dense_trips", "dense_pings"),
}
_add(
    "dense_all_rules",
    " union all ".join(f"select {_GROUP}, code, cnt, flagged from ({_flagged(c, '= 5')})" for c in CODES),
    **_DENSE,
)
_add(
    "dense_rule_006",
    f"""select distinct {_GROUP}, hit as is_006, cnt as cnt_006, flagged as dsys006, order_date as grass_date
    from ({_flagged('006', '= 5')})""",
    **_DENSE,
)
_DENSE_PHASED = _phased("5 minutes", "dense_trips", pings="dense_pings")
_add(
    "dense_phases", "select order_id, period, count(ping_time) as n from phased group by 1, 2", phased=_DENSE_PHASED
)

# ---------------------------------------------------------------- tags

_PARSED = """select *, case when json_type(entities, '$.DFPInfoSZ.tags') = 'ARRAY'
  then cast(json_extract(entities, '$.DFPInfoSZ.tags') as varchar[]) end as tags from risk_events"""

_add(
    "risk_tag_flags",
    "select user_id, grass_date, "
    + ", ".join(f"count(case when list_contains(tags, '{t}') then 1 end) as {t}" for t in TAMPERED_APP_TAGS)
    + ", count(case when sync_event_hit_result = 'B00' then 1 end) as is_blocked from parsed group by 1, 2",
    parsed=_PARSED,
)

_LISTED = ", ".join(f"'{t}'" for t in TAMPERED_APP_TAGS)
_SUSPECT = f"""select distinct user_id, grass_date from parsed
  where coalesce(sync_event_hit_result, '') <> 'B00' and list_has_any(tags, [{_LISTED}])"""
_add(
    "rule_risk_tags",
    f"""select distinct {_GROUP}, 1 as is_proxy_autoblock, order_date as grass_date from trips o
    join suspect s on o.driver_id = s.user_id and o.order_date = s.grass_date""",
    parsed=_PARSED,
    suspect=_SUSPECT,
)
_add(
    "rule_risk_tags_any_day",
    f"""select distinct {_GROUP}, 1 as is_proxy_autoblock, order_date as grass_date from trips o
    join suspect s on o.driver_id = s.user_id
    where s.grass_date between date '2024-01-01' and date '2024-01-07'
      and o.order_date between date '2024-01-01' and date '2024-01-07'""",
    parsed=_PARSED,
    suspect=_SUSPECT,
)
_BEHAVIOR = "case code " + " ".join(f"when '{c}' then '{b}'" for c, b in BEHAVIORS.items()) + " end"
_add(
    "tag_orders",
    """select o.order_id, o.driver_id, o.order_date, coalesce(b.behavior, '') as behavior
    from trips o left join named b on o.order_id = b.order_id""",
    **_SEEN,
    same_point=_SAME_POINT,
    accepted=_ACCEPTED_AT_STORE,
    repeated_point=_REPEATED_POINT,
    parsed=_PARSED,
    suspect=_SUSPECT,
    hits=f"""select order_id, code from ({_ALL}) where flagged = 1 union all select order_id, '001' from accepted
      union all select order_id, '004' from repeated_point
      union all select order_id, 'app' from trips o join suspect s on o.driver_id = s.user_id
        and o.order_date = s.grass_date""",
    named=f"select distinct order_id, {_BEHAVIOR} as behavior from hits",
)

# ---------------------------------------------------------------- reports

def _calendar(source: str) -> str:
    return f"""select cast(d as date) as report_date, isoyear(d) * 100 + week(d) as year_week,
      cast(date_trunc('week', d) as date) as first_day_of_week, cast(date_trunc('week', d) as date) + 6 as last_day_of_week,
      year(d) * 100 + month(d) as year_month, cast(date_trunc('month', d) as date) as first_day_of_month,
      last_day(cast(d as date)) as last_day_of_month, day(last_day(cast(d as date))) as num_day_in_month
    from (select unnest(generate_series(min(cast(ts as date)), max(cast(ts as date)), interval 1 day)) as d
      from {source}) days"""


_CALENDAR = _calendar("ev")
_DAYS = """select report_date, cast(year_week as int) as year_week, first_day_of_week, last_day_of_week,
    cast(year_month as int) as year_month, first_day_of_month, last_day_of_month,
    cast(num_day_in_month as int) as num_day_in_month from cal"""
_add("calendar", _DAYS, cal=_CALENDAR)
_add("calendar_with_gaps", _DAYS, few="select date_trunc('week', ts) as ts from ev", cal=_calendar("few"))
_KNOWN = "where report_date between date '2024-01-01' and date '2024-01-24'"
_LAST = "date '2024-01-24'"
_PERIODS = f"""select distinct '1. Daily' as period_grp, cast(report_date as varchar) as period, report_date as start_date,
    report_date as end_date, cast(1 as double) as days from cal {_KNOWN}
  union select distinct '2. Weekly', cast(year_week as varchar), first_day_of_week,
    case when date_trunc('week', report_date) = date_trunc('week', {_LAST}) then {_LAST} else last_day_of_week end,
    case when date_trunc('week', report_date) = date_trunc('week', {_LAST}) then isodow({_LAST}) else 7 end from cal {_KNOWN}
  union select distinct '3. Monthly', cast(year_month as varchar), first_day_of_month,
    case when date_trunc('month', report_date) = date_trunc('month', {_LAST}) then {_LAST} else last_day_of_month end,
    case when date_trunc('month', report_date) = date_trunc('month', {_LAST}) then day({_LAST}) else num_day_in_month end
    from cal {_KNOWN}"""
_add("periods", "select * from spans", cal=_CALENDAR, spans=_PERIODS)

_DAILY = """select order_date, case when behavior like 'Rules_%' then 'Rules' else 'Proxy' end as types, behavior,
  count(distinct order_id) as cnt_order from tagged where behavior <> ''
  and (behavior like 'Rules_%' or behavior like 'Proxy_%') group by 1, 2, 3"""
_ROLLED = """select order_date, types, behavior, cnt_order from daily
  union select order_date, types, 'All', sum(cnt_order) from daily group by 1, 2"""
_add(
    "behavior_rollup",
    "select order_date, types, behavior, cast(cnt_order as bigint) as cnt_order from rolled",
    daily=_DAILY,
    rolled=_ROLLED,
)
_add(
    "behavior_report",
    """select a.period_grp, a.period, a.days, types, behavior, cnt_order, net_order from
    (select period_grp, period, days, types, behavior, cast(sum(cnt_order) as bigint) as cnt_order
      from rolled f join spans p on f.order_date between p.start_date and p.end_date group by all) a
    join (select period_grp, period, days, count(distinct order_id) as net_order
      from tagged b join spans p on b.order_date between p.start_date and p.end_date group by all) n
    on a.period_grp = n.period_grp and a.period = n.period and a.days = n.days""",
    cal=_CALENDAR,
    spans=_PERIODS,
    daily=_DAILY,
    rolled=_ROLLED,
)
for _name, _like, _number, _alias in (
    ("monthly_driver_average", "Rules_%", "month", "month"),
    ("weekly_driver_average", "Proxy_%", "week", "week"),
):
    _add(
        _name,
        f"select cast({_number}(order_date) as int) as {_alias}, avg(cnt) as avg_driver from per_day group by 1",
        per_day=f"""select order_date, count(distinct driver_id) as cnt from tagged
          where behavior <> '' and behavior like '{_like}' group by 1""",
    )

_add(
    "driver_average_of_days",
    "select cast(month(order_date) as int) as month, avg(cnt) as avg_driver from per_day group by 1",
    per_day="""select order_date, count(distinct driver_id) as cnt from tagged where behavior like 'Rules_%'
      and order_date between date '2024-01-03' and date '2024-01-17' group by 1""",
)

_KINDS = " ".join(f"when '{c}' then '{kind}'" for c, kind in FRAUD_KINDS.items())
_CASES = f"""select order_created_date as submit_date, case fraud_code {_KINDS} else 'Others' end as fraud_mo,
  case source when 'food' then 'Delivered Orders' end as source, fraud_code, driver_id as cheater,
  (amount_charge_back + balance) / nullif(exchange_rate, 0) as loss
  from bad_debt where source <> 'fresh' and fraud_code like 'dc-%'"""
_add(
    "bad_debt_cases",
    """select fraud_code, fraud_mo, source, count(*) as n, count(loss) as with_loss from cases
    group by 1, 2, 3""",
    cases=_CASES,
)
_add(
    "bad_debt_monthly",
    """select cast(month(submit_date) as int) as grass_month, round(avg(cnt), 6) as avg_driver,
    round(sum(loss), 3) as total_loss from per_day group by 1""",
    cases=_CASES,
    per_day="select submit_date, count(distinct cheater) as cnt, sum(loss) as loss from cases group by 1",
)

# ---------------------------------------------------------------- review

_PICK = "(order_id * 7919) % 10007, order_id"
_add(
    "sample_hits",
    """select a.order_id, a.behavior, period, ping_time, accuracy, head from phased a join chosen c
    on a.order_id = c.order_id and a.behavior = c.behavior""",
    proxied="select * from tagged where behavior like 'Proxy_%'",
    phased=_phased("6 hours", "proxied", ", o.behavior"),
    complete="select order_id, behavior from phased group by 1, 2 having count(distinct period) = 3",
    chosen=f"""select * from (select *, row_number() over (partition by behavior order by {_PICK}) as n from complete)
      where n <= {PER_CLASS}""",
)
_FEW = """select distinct * replace (case when driver_id % 7 = 0 then behavior else '' end as behavior) from tagged"""
_CLEAN = """select * from few where behavior = ''
  and driver_id not in (select distinct driver_id from few where behavior <> '')"""
_add(
    "sample_controls",
    """select a.order_id, a.behavior, period, ping_time, accuracy, head from phased a join chosen c
    on a.order_id = c.order_id""",
    few=_FEW,
    clean=_CLEAN,
    phased=_phased("6 hours", "clean", ", o.behavior"),
    complete="select order_id from phased group by 1 having count(distinct period) = 3",
    chosen=f"select * from complete order by {_PICK} limit {PER_CLASS}",
)
_add("anti_join_not_in", "select order_id, driver_id from clean", few=_FEW, clean=_CLEAN)

_SHOWN = "order_date, order_id, driver_id, period, ping_time, accuracy"
_FLAG = """select distinct {shown}, is_sop, 1 as is_conti from (
    select *, lead(is_sop) {w} as after, lag(is_sop) {w} as before_it
    from (select {shown}, case when {when} then 1 else 0 end as is_sop from phased where ping_time is not null))
  where is_sop = 1 and (after = 1 or before_it = 1)"""
_SAME = """select distinct {shown}, 1 as is_conti from (
    select *, {after} as same_after, {before} as same_before
    from (select {distinct} {shown} from phased where {where} and ping_time is not null))
  where same_after or same_before"""

#: Flag checks: the condition. Same-place checks: equal columns, which pings, shown columns, whether they are distinct.
FLAG_CHECKS = {
    "s2": "accuracy <= 1 and period in ('early', 'end')",
    "s3a": "accuracy <= 5 and period in ('early', 'end')",
    "s3b": "accuracy > 5 and period = 'middle'",
    "s3a_wide": "accuracy <= 7.5 and period in ('early', 'end')",
    "s3b_wide": "accuracy > 7 and period = 'middle'",
}
SAME_CHECKS = {
    "s4": ("speed_kmh", "accuracy <= 5 and period = 'early'", "speed_kmh", ""),
    "s5": ("latitude, longitude", "accuracy <= 5 and period = 'early'", "latitude, longitude", ""),
    "s6": ("latitude, longitude", "true", "latitude, longitude", ""),
    "s7": (
        "speed_kmh",
        "speed_kmh in (0.36, 0.72, 3.6, 7.2, 10.8) and period in ('early', 'end')",
        "latitude, longitude, speed_kmh",
        "distinct",
    ),
    "s8": (
        "latitude, longitude",
        "speed_kmh in (0.36, 3.6) and accuracy < 5 and period in ('early', 'end')",
        "latitude, longitude, speed_kmh",
        "distinct",
    ),
    "s8_original": (
        "latitude, longitude",
        "speed_kmh in (0.36, 3.6) and accuracy = 5 and head = 4 and period in ('early', 'end')",
        "latitude, longitude, speed_kmh",
        "distinct",
    ),
}


def _check(name: str) -> str:
    if name in FLAG_CHECKS:
        w = "over (partition by order_id order by ping_time, order_date, driver_id, period, accuracy, is_sop)"
        return _FLAG.format(shown=_SHOWN, w=w, when=FLAG_CHECKS[name])
    same, where, show, distinct = SAME_CHECKS[name]
    w = f"over (partition by order_id order by ping_time, order_date, driver_id, period, accuracy, {show})"
    sides = {
        side: " and ".join(f"{c} = {function}({c}) {w}" for c in same.split(", "))
        for side, function in (("after", "lead"), ("before", "lag"))
    }
    return _SAME.format(shown=f"{_SHOWN}, {show}", where=where, distinct=distinct, **sides)


for _name in ("s2", "s3a", "s3b", *[c for c in SAME_CHECKS if c != "s8_original"]):
    _add(f"check_{_name}", _check(_name), phased=_phased("6 hours"))
for _name, _rows in {"dense_check_s7": "s7", "dense_check_s8": "s8_original"}.items():
    _add(_name, _check(_rows), phased=_DENSE_PHASED)
_add(
    "dense_check_s3",
    "select distinct a.order_id from first_half a join second_half b on a.order_id = b.order_id",
    phased=_DENSE_PHASED,
    first_half=_check("s3a"),
    second_half=_check("s3b"),
)
_add(
    "check_s3",
    "select distinct a.order_id from first_half a join second_half b on a.order_id = b.order_id",
    phased=_phased("6 hours"),
    first_half=_check("s3a_wide"),
    second_half=_check("s3b_wide"),
)
_add(
    "semi_join_check",
    "select order_id, ping_time, accuracy, period from phased where order_id in (select order_id from hit)",
    phased=_phased("6 hours"),
    hit=_check("s2"),
)
_add(
    "review_rates",
    """select types, count(distinct order_id) as sample_order_cnt, count(distinct driver_id) as sample_driver_cnt,
    count(distinct case when is_hit = 1 then order_id end) as fraud_order_cnt,
    count(distinct case when is_hit = 1 then driver_id end) as fraud_driver_cnt,
    cast(count(distinct case when is_hit = 1 then order_id end) as double) / count(distinct order_id)
      as order_sample_fraud_rate,
    cast(count(distinct case when is_hit = 1 then driver_id end) as double) / count(distinct driver_id)
      as driver_sample_fraud_rate
    from labelled group by 1""",
    labelled="""select s.*, r.is_hit, r.types from reviewed_orders s left join (
      select cast(order_id as bigint) as order_id, cast(is_hit as int) as is_hit,
        case when pic = 'first' then 'non-proxy' else 'proxy' end as types from reviews) r on s.order_id = r.order_id""",
)

# ---------------------------------------------------------------- devices


def _scalar(path: str) -> str:
    return f"""case when json_type(entities, '{path}') not in ('ARRAY', 'OBJECT')
      then json_extract_string(entities, '{path}') end"""


_add(
    "device_attribution",
    """select order_id, delivery_id, buyer_id, store_id, driver_id, device, platform, tags, is_high_risk_tag,
    cast(null as varchar) as account_df, cast(null as varchar) as vendor_df, cast(create_time as date) as grass_date, strftime(create_time, '%Y-%m') as grass_month
    from ranked where rk = 1 and device is not null""",
    bought="""select o.*, a.account_id from buyer_orders o left join accounts a on o.buyer_id = a.uid and a.status = 1
      where delivery_status in (7, 9)""",
    logins=f"""select user_id as account_id, event_local_datetime as date_time,
        {_scalar('$.DFPInfoSZ.SecurityDeviceID')} as device, {_scalar('$.DFPInfoSZ.tags')} as tags, platform
      from login_events e where event_id = 151 and trim({_scalar('$.DFPInfoSZ.SecurityDeviceID')}) <> ''
        and exists (select 1 from bought b where b.account_id = e.user_id and cast(b.create_time as date) = e.grass_date)""",
    merged="""select o.order_id, o.delivery_id, o.buyer_id, o.store_id, o.driver_id, o.create_time,
        coalesce(b.security_device_id, s.device) as device,
        coalesce(case when b.security_device_id <> '' then b.platform end, s.platform) as platform,
        coalesce(case when b.risk_tags <> '[]' then b.risk_tags end, case when s.tags <> 'null' then s.tags end) as tags,
        case when b.security_device_id is null then s.date_time else o.create_time end as device_time,
        s.date_time as login_time
      from bought o left join order_risk b on o.order_id = b.order_id
      left join logins s on o.account_id = s.account_id and o.app_type_id in (50, 51)
        and s.date_time between o.create_time - interval 259200 seconds and o.create_time""",
    ranked=f"""select *, case when regexp_matches(tags, '{'|'.join(RISKY_TAGS)}')
          or (platform = 2 and regexp_matches(tags, '{'|'.join(RISKY_TAGS_SECOND_PLATFORM)}')) then 1 else 0 end
          as is_high_risk_tag,
        row_number() over (partition by buyer_id, create_time order by device_time desc nulls last, order_id desc,
          login_time desc nulls last) as rk from merged""",
)

_add(
    "risk_event_scan",
    """select user_id, event_id, 'ID' as grass_region, grass_date, platform from login_events
    where event_id = 151 and user_id % 3 = 0 and grass_date between date '2024-01-05' and date '2024-01-12'""",
)

# ---------------------------------------------------------------- accept points of the other region

_PAIRED = """select o.*, store_latitude, store_longitude, accept_latitude, accept_longitude
  from facts o left join latest_pairs p on o.order_id = p.order_id and o.driver_id = p.driver_id"""

# Orders and pairs as in order_facts_union and accept_pairs.
_FACTS = ORACLES["order_facts_union"]
_PAIRS = ORACLES["accept_pairs"]


def _add_paired(name: str, body: str, exact: str = "select * from paired") -> None:
    ORACLES[name] = f"""with facts as ({_FACTS}), latest_pairs as ({_PAIRS}), paired as ({_PAIRED}),
      exact as ({exact}) {body}"""


_add_paired(
    "id_rule_001",
    f"""select distinct {_GROUP}, true as is_001, count(*) over (partition by order_date, driver_id) as cnt_001,
      1 as dsys001, order_date as grass_date
    from (select distinct {_GROUP} from paired where {' and '.join(f'{_digits(_seven(x))} = 7' for x in
      ('accept_latitude', 'accept_longitude', 'store_latitude', 'store_longitude'))}
      and accept_latitude = store_latitude and accept_longitude = store_longitude)""",
)
_add_paired(
    "id_rule_004",
    f"""select distinct {', '.join('o.' + c.strip() for c in _GROUP.split(','))}, cnt as cnt_004, 1 as dsys004,
      o.order_date as grass_date from exact o join (
        select cast(create_time as date) as day, driver_id, accept_latitude, accept_longitude,
          count(distinct order_id) as cnt from exact group by all) d
      on o.order_date = d.day and o.driver_id = d.driver_id and o.accept_latitude = d.accept_latitude
        and o.accept_longitude = d.accept_longitude""",
    f"""select * replace ({_seven('accept_latitude')} as accept_latitude, {_seven('accept_longitude')} as accept_longitude)
      from paired where {' and '.join(f'{_digits(_seven(x))} = 7' for x in ('accept_latitude', 'accept_longitude'))}""",
)
_add(
    "id_all_rules",
    _ALL,
    facts="select * replace (cast(order_id as varchar) as order_id, cast(driver_id as varchar) as driver_id) from trips",
    texts="select * replace (cast(driver_id as varchar) as driver_id) from pings",
    before=_phase(*_BEFORE, "facts", "texts"),
    middle=_phase(*_MIDDLE, "facts", "texts"),
)
ORACLES["id_rule_app"] = f"""with orders_of as ({_FACTS}), suspects as (
    with ev as ({_BASE['ev']}), risk_events as ({VIEWS['risk_events']}), parsed as ({_PARSED}) {_SUSPECT})
  select distinct {_GROUP}, 1 as is_proxy_autoblock, order_date as grass_date from orders_of o
  join (select distinct cast(user_id as varchar) as driver from suspects) s on o.driver_id = s.driver"""
