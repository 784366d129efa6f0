"""Joins of time intervals with points and spans."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pathproof.operators.slots import HOUR, SLOT, beyond_slots, slot, with_slot, with_wide_slot


Range = tuple[datetime, datetime]


def _unfold(df: DataFrame, lo: str, hi: str, width_s: int, within: Range | None) -> DataFrame:
    """One row per slot that ``[lo, hi]`` touches; rows with an empty interval vanish."""
    first, last = F.col(lo), F.col(hi)
    if within is not None:
        first = F.greatest(first, F.lit(within[0]).cast(df.schema[lo].dataType))
        last = F.least(last, F.lit(within[1]).cast(df.schema[hi].dataType))
    cut = df.withColumns({"_first": first, "_last": last}).where("_first <= _last")
    slots = F.sequence(slot(cut, "_first", width_s), slot(cut, "_last", width_s))
    return cut.withColumn(SLOT, F.explode(slots)).drop("_first", "_last")


def interval_join(
    spans: DataFrame,
    points: DataFrame,
    key: str,
    time: str,
    lo: str,
    hi: str,
    how: str = "inner",
    width_s: int = HOUR,
    within: Range | None = None,
) -> DataFrame:
    """All pairs with equal ``key`` and ``lo <= time <= hi`` (both ends included).

    Each span is repeated once per slot it touches and the join key is
    (key, slot), so a driver with a third of all pings is spread over as many
    groups as there are slots, and no pair outside a shared slot is compared.
    ``within`` cuts spans to the range of the scanned points; a span with a broken
    start time then cannot unfold over decades. ``points`` that have a slot column of this
    width keep it, and with it their partitioning.

    ``how="left"`` keeps spans without a point. It is an inner join plus the spans it did
    not reach, compared in all their columns: a plain outer join would return one empty
    row per slot.
    """
    slotted = points if SLOT in points.columns else with_slot(points, time, width_s)
    inner = (
        _unfold(spans, lo, hi, width_s, within)
        .join(slotted, [key, SLOT])
        .where(F.col(time).between(F.col(lo), F.col(hi)))
        .drop(SLOT)
    )
    columns = spans.columns + [c for c in points.columns if c not in (key, SLOT)]
    inner = inner.select(*columns)
    if how == "inner":
        return inner
    reached = inner.select(*[F.col(c).alias(f"_r_{c}") for c in spans.columns]).distinct()
    same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in spans.columns])
    empty = spans.join(reached, same, "left_anti").select(
        *spans.columns,
        *[F.lit(None).cast(points.schema[c].dataType).alias(c) for c in columns[len(spans.columns) :]],
    )
    return inner.unionByName(empty)


def holding(
    windows: DataFrame,
    spans: DataFrame,
    on: Sequence[str],
    lo: str,
    hi: str,
    start: str = "start",
    end: str = "end",
    width_s: int = HOUR,
) -> DataFrame:
    """Distinct ``windows`` that hold at least one span: ``lo <= start`` and ``end <= hi``.

    See ``holding_each``, of which this is the case of one kind of span.
    """
    held = holding_each(windows, spans.withColumn("_what", F.lit("")), on, "_what", [""], lo, hi, start, end, width_s)
    return held.drop("_what")


def holding_each(
    windows: DataFrame,
    spans: DataFrame,
    on: Sequence[str],
    what: str,
    names: Sequence[str],
    lo: str,
    hi: str,
    start: str = "start",
    end: str = "end",
    width_s: int = HOUR,
) -> DataFrame:
    """Distinct ``windows`` with the column ``what``: a row for each of ``names`` of which they hold a span.

    A window holds a span exactly when the smallest end among the spans that start at or
    after ``lo`` is at most ``hi``, see ``smallest_ends``.
    """
    ends = [f"_end{i}" for i in range(len(names))]
    marks = spans.where(F.col(what).isin(*names)).select(
        *on, start, *[F.when(F.col(what) == name, F.col(end)).alias(e) for name, e in zip(names, ends, strict=True)]
    )
    held = F.array_compact(
        F.array(*[F.when(F.col(e) <= F.col(hi), F.lit(name)) for name, e in zip(names, ends, strict=True)])
    )
    asked = smallest_ends(windows, marks, on, ends, lo, start, width_s)
    return asked.select(*windows.columns, F.explode(held).alias(what)).distinct()


def smallest_ends(
    windows: DataFrame, marks: DataFrame, on: Sequence[str], ends: Sequence[str], lo: str, start: str, width_s: int = HOUR
) -> DataFrame:
    """``windows`` with the smallest of each of ``ends`` among the ``marks`` whose ``start`` is ``lo`` or later.

    Null where there is no such mark; null keys and times match nothing, and all rows of
    ``windows`` stay. It is a running minimum, taken backwards in time: inside each (keys,
    slot), and over summaries of slots for the later ones. There is one for each of ``ends``, all over the same rows, among which the windows stand themselves:
    they are not unfolded into slots, so a broken time costs nothing, and no window is
    compared with more than one number of each kind.
    """
    asked = windows.select(
        *on,
        F.col(lo).alias("_t"),
        *[F.lit(None).cast(marks.schema[e].dataType).alias(e) for e in ends],
        F.struct(*windows.columns).alias("_window"),
    )
    marked = marks.select(
        *on, F.col(start).alias("_t"), *ends, F.lit(None).cast(asked.schema["_window"].dataType).alias("_window")
    )
    rows = with_wide_slot(marked.dropna(subset=[*on, "_t"]).unionByName(asked), on, "_t", width_s)
    # windows without a time have no slot: they need not meet, and must not be one group
    apart = F.when(F.col(SLOT).isNull(), F.xxhash64("_window"))
    inside = Window.partitionBy(*on, SLOT, apart).orderBy(F.col("_t").desc()).rangeBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    found = rows.select(*on, SLOT, "_window", *[F.min(e).over(inside).alias(e) for e in ends])
    summary = rows.where(F.col(SLOT).isNotNull()).groupBy(*on, SLOT).agg(*[F.min(e).alias(e) for e in ends])
    beyond = beyond_slots(summary, on, ends, smallest=True, later=True).withColumnsRenamed({e: f"{e}_beyond" for e in ends})
    return (
        found.where(F.col("_window").isNotNull())
        .join(beyond, [*on, SLOT], "left")
        .select("_window.*", *[F.least(e, f"{e}_beyond").alias(e) for e in ends])
    )
