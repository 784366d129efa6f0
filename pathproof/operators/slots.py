"""Time slots: the second key that keeps one busy driver from filling one task.

Every operator that would otherwise gather all rows of a driver (or an order) in
one place works on (key, slot) instead. A slot is a fixed-width piece of time, so
the rows per group are bounded by the width and not by the history of the key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

MINUTE = 60
HOUR = 3600
DAY = 86400

SLOT = "_slot"

#: Slots that one summary of slots holds, as a power of two: 1,024 hours are six weeks.
FAN_BITS = 10

#: Rows of a key that may share a wide slot, as many as a window keeps in memory.
MOST_ROWS = 4096


def _seconds(df: DataFrame, time: str) -> Column:
    c = F.col(time)
    if isinstance(df.schema[time].dataType, T.TimestampNTZType):
        # Field arithmetic: no detour over the session zone and its clock changes.
        return (
            F.unix_date(c.cast("date")).cast("bigint") * DAY
            + F.hour(c) * HOUR
            + F.minute(c) * MINUTE
            + F.second(c)
        )
    return F.unix_seconds(c)


def slot(df: DataFrame, time: str, width_s: int) -> Column:
    """Number of the slot ``time`` falls into."""
    return F.floor(_seconds(df, time) / width_s)


def with_slot(df: DataFrame, time: str, width_s: int) -> DataFrame:
    return df.withColumn(SLOT, slot(df, time, width_s))


def with_wide_slot(df: DataFrame, keys: Sequence[str], time: str, width_s: int, most_rows: int = MOST_ROWS) -> DataFrame:
    """``with_slot``, but a key's block of 2 ** ``FAN_BITS`` slots is one slot, its first, where it has few rows.

    Few are ``most_rows`` at most. Slots stay in the order of time, and none holds more than that or than one plain
    slot. Where a key's rows are sparse, hardly any is near the edge of its slot and has to meet the next one.
    Crowded blocks are counted first and broadcast: one row for each ``most_rows`` rows of ``df`` at most.
    """
    slotted = with_slot(df, time, width_s)
    block = F.shiftright(SLOT, FAN_BITS)
    named = {k: f"_crowded_{k}" for k in keys}
    crowded = (
        slotted.groupBy(*keys, block.alias("_crowded"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .where(F.col("_rows") > most_rows)
        .select(*[F.col(k).alias(name) for k, name in named.items()], "_crowded", F.lit(True).alias("_is_crowded"))
    )
    same = reduce(
        lambda a, b: a & b,
        [block.eqNullSafe(F.col("_crowded")), *[F.col(k).eqNullSafe(F.col(name)) for k, name in named.items()]],
    )
    wide = F.when(F.col("_is_crowded"), F.col(SLOT)).otherwise(F.shiftleft(block, FAN_BITS))
    return slotted.join(F.broadcast(crowded), same, "left").select(*df.columns, wide.alias(SLOT))


def beyond_slots(
    summary: DataFrame, keys: Sequence[str], names: Sequence[str], smallest: bool, later: bool, fan_bits: int = FAN_BITS
) -> DataFrame:
    """(keys, slot, ``names``): the smallest or largest of each of ``names`` in all ``later`` (or all earlier) slots.

    ``summary`` has one row per (keys, slot); a column is null where no such slot has a value. No
    group holds a key's history: 2 ** ``fan_bits`` slots make a block, whose rows have a window of
    their own, and only one row for each block meets the other blocks of its key. Slots and blocks are
    rows of one frame, told apart by their level, so that ``summary`` is made once and joined with nothing.
    """
    merge, pick = (F.min, F.least) if smallest else (F.max, F.greatest)
    slots, blocks = F.lit(0), F.lit(1)
    is_slot = F.col("_level") == slots
    levels = (
        summary.withColumn("_level", F.explode(F.array(slots, blocks)))
        .withColumn("_place", F.when(is_slot, F.col(SLOT)).otherwise(F.shiftright(SLOT, fan_bits)))
        .groupBy(*keys, "_level", "_place")
        .agg(*[merge(n).alias(n) for n in names])
    )
    block = F.shiftright("_place", fan_bits)
    order = F.col("_place").desc() if later else F.col("_place").asc()
    among = (
        Window.partitionBy(*keys, "_level", F.when(is_slot, block)).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    )
    running = levels.select(
        *keys, "_level", "_place", *[merge(n).over(among).alias(n) for n in names]
    ).withColumn("_block", F.when(is_slot, block).otherwise(F.col("_place")))
    own_block = Window.partitionBy(*keys, "_block")
    found = running.select(
        *keys,
        "_level",
        F.col("_place").alias(SLOT),
        *[pick(F.col(n), merge(F.when(~is_slot, F.col(n))).over(own_block)).alias(n) for n in names],
    )
    return found.where(is_slot).drop("_level")
