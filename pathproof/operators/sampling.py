"""Repeatable samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_SHARES = 256


def pick_per_class(df: DataFrame, by: str | None, per_class: int, order: Sequence[Column]) -> DataFrame:
    """The first ``per_class`` rows of each class in ``order``.

    ``order`` must be total, so that a rerun picks the same rows. Each class is first
    ranked in shares: the first rows of the class are among the first rows of its shares,
    so a class that holds most of the data is never sorted in one task.
    """
    if by is None:
        return df.orderBy(*order).limit(per_class)
    share = F.pmod(F.xxhash64(*df.columns), F.lit(_SHARES))
    shared = _first(df.withColumn("_share", share), [by, "_share"], per_class, order).drop("_share")
    return _first(shared, [by], per_class, order)


def _first(df: DataFrame, by: Sequence[str], n: int, order: Sequence[Column]) -> DataFrame:
    ranked = df.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    return ranked.where(F.col("_n") <= n).drop("_n")
