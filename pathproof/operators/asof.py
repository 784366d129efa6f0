"""As-of lookup: the nearest row before or after a point in time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pathproof.operators.slots import HOUR, SLOT, beyond_slots, with_slot


def asof_lookup(
    probes: DataFrame,
    points: DataFrame,
    key: str | Sequence[str],
    at: str,
    time: str,
    values: dict[str, Column],
    direction: str = "backward",
    width_s: int = HOUR,
    look_back_s: int | None = None,
) -> DataFrame:
    """Add to each probe the nearest non-null value of each of ``values``.

    ``backward`` takes the last point with ``time <= at``, ``forward`` the first with
    ``time >= at``. Values are looked up independently of each other. Of several
    points at one time, the largest value (backward) or the smallest (forward) wins,
    so put the tie-break first when a value is a struct.

    No probe is paired with more than one point. Probes and points are first reduced
    to one row per (key, time), which also melts away copies. A window per
    (key, slot) finds the neighbour inside the slot; the one beyond comes from
    summaries of slots (``beyond_slots``).

    With ``look_back_s`` only points at most that many seconds away need be found (others
    may be). Slots are then at least that wide, the neighbour beyond lies in the next slot
    on that side, and no window spans the history of a key.
    """
    if look_back_s is not None:
        width_s = max(width_s, look_back_s)
    keys = [key] if isinstance(key, str) else list(key)
    forward = direction == "forward"
    merge = F.min if forward else F.max
    nearest = F.min_by if forward else F.max_by
    names = list(values)

    marks = points.select(*keys, F.col(time).alias("_t"), *[v.alias(n) for n, v in values.items()])
    types = {f.name: f.dataType for f in marks.schema}
    asked = probes.select(
        *keys, F.col(at).alias("_t"), *[F.lit(None).cast(types[n]).alias(n) for n in names]
    )
    both = (
        marks.withColumn("_probe", F.lit(False))
        .unionByName(asked.withColumn("_probe", F.lit(True)))
        .dropna(subset=[*keys, "_t"])
    )
    times = (
        with_slot(both, "_t", width_s)
        .groupBy(*keys, SLOT, "_t")
        .agg(*[merge(n).alias(n) for n in names], F.max("_probe").alias("_probe"))
        .repartition(*keys, SLOT)
    )

    by_time = F.col("_t").desc() if forward else F.col("_t").asc()
    inside = Window.partitionBy(*keys, SLOT).orderBy(by_time).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    found = times.select(
        *keys, SLOT, "_t", "_probe", *[F.last(n, ignorenulls=True).over(inside).alias(n) for n in names]
    ).where("_probe")

    summary = times.groupBy(*keys, SLOT).agg(
        *[nearest(n, F.when(F.col(n).isNotNull(), F.col("_t"))).alias(n) for n in names]
    )
    if look_back_s is not None:
        beyond = summary.select(
            *keys, (F.col(SLOT) + (-1 if forward else 1)).alias(SLOT), *[F.col(n).alias(f"_beyond_{n}") for n in names]
        )
    else:
        dated = summary.select(
            *keys, SLOT, *[F.when(F.col(n).isNotNull(), F.struct(SLOT, F.col(n).alias("value"))).alias(n) for n in names]
        )
        beyond = beyond_slots(dated, keys, names, smallest=forward, later=forward)
        beyond = beyond.select(*keys, SLOT, *[F.col(f"{n}.value").alias(f"_beyond_{n}") for n in names])
    answers = found.join(beyond, [*keys, SLOT], "left").select(
        *keys, F.col("_t").alias(at), *[F.coalesce(F.col(n), F.col(f"_beyond_{n}")).alias(n) for n in names]
    )
    return probes.join(answers, [*keys, at], "left").select(*probes.columns, *names)
