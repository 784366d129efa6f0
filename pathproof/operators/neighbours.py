"""Window functions that look a few rows ahead or behind, without one big group.

``lead`` over a whole driver or order needs all its rows in one task. Here rows are
first handled per (key, slot). Only rows closer than ``reach`` to the edge of their
slot can have a neighbour elsewhere, and all rows between two such edges lie in the
edges themselves. So a second window over the edge rows alone, at most ``2 * reach``
per slot, completes the result exactly.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from pathproof.operators.slots import HOUR, SLOT, with_slot

Looker = Callable[[WindowSpec], Column]


def neighbours(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    reach: int,
    keep: Column,
    ahead: dict[str, Looker] | None = None,
    behind: dict[str, Looker] | None = None,
    width_s: int = HOUR,
) -> DataFrame:
    """Rows of ``df`` with the ``ahead`` and ``behind`` columns that satisfy ``keep``.

    ``order`` starts with the time column and must order the rows of a key totally
    (up to equal rows). Each looker gets a window and returns a column that reads at
    most ``reach`` following (``ahead``) or preceding (``behind``) rows. Rows inside a
    slot that fail ``keep`` are dropped before the second shuffle. A frame that already
    has a slot column keeps it, and with it its partitioning.
    """
    ahead, behind = ahead or {}, behind or {}
    slotted = df if SLOT in df.columns else with_slot(df, order[0], width_s)
    near = Window.partitionBy(*key, SLOT).orderBy(*order)
    local = slotted.select(
        "*",
        *[look(near).alias(name) for name, look in {**ahead, **behind}.items()],
        F.lead(F.lit(1), reach).over(near).isNull().alias("_at_end"),
        F.lag(F.lit(1), reach).over(near).isNull().alias("_at_start"),
    )
    at_edge = F.col("_at_end") | F.col("_at_start")
    # Edge rows of a key form one group (no slot), settled rows stay in their own.
    travelling = local.where(at_edge | keep).withColumn("_group_slot", F.when(~at_edge, F.col(SLOT)))
    far = Window.partitionBy(*key, "_group_slot").orderBy(*order)
    return travelling.select(
        *[c for c in slotted.columns if c != SLOT],
        *[F.when(F.col("_at_end"), look(far)).otherwise(F.col(n)).alias(n) for n, look in ahead.items()],
        *[F.when(F.col("_at_start"), look(far)).otherwise(F.col(n)).alias(n) for n, look in behind.items()],
    ).where(keep)
