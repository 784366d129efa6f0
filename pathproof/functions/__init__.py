from pathproof.functions.columns import (
    decimal_fraction_digits,
    double_fraction_digits,
    earth_distance_km,
    fraction_digits,
    fraction_digits_of,
    json_scalar,
    json_scalars,
    ping_time,
    round7,
    round7_of,
    speed_kmh,
    split_number,
    tag_list,
    upload_wall_time,
    wall_time,
    whole_seconds_between,
)

__all__ = [
    "decimal_fraction_digits",
    "double_fraction_digits",
    "earth_distance_km",
    "fraction_digits",
    "fraction_digits_of",
    "json_scalar",
    "json_scalars",
    "ping_time",
    "round7",
    "round7_of",
    "speed_kmh",
    "split_number",
    "tag_list",
    "upload_wall_time",
    "wall_time",
    "whole_seconds_between",
]
