"""Readers of partitioned Parquet tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pathproof.sources.schemas import INPUTS

SLACK = timedelta(days=1)


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A table with its declared schema; nothing is inferred from the data."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_input(spark: SparkSession, path: str, name: str) -> DataFrame:
    """One of the inputs of ``schemas.INPUTS``."""
    return read_table(spark, path, INPUTS[name])


def read_between(
    spark: SparkSession,
    path: str,
    day: str,
    lo: date,
    hi: date,
    schema: StructType | None = None,
    slack: timedelta = timedelta(0),
) -> DataFrame:
    """Partitions of ``day`` in ``[lo, hi]``, widened by ``slack``.

    Pings carry the upload day in storage and a resolved day in the jobs: read them with
    ``slack=SLACK`` so that partition pruning works and no late ping is lost.
    """
    return read_table(spark, path, schema).where(F.col(day).between(F.lit(lo - slack), F.lit(hi + slack)))


def read_risk_events(
    spark: SparkSession,
    path: str,
    event_ids: Sequence[int],
    region: str,
    lo: date,
    hi: date,
    schema: StructType | None = None,
) -> DataFrame:
    """Rule engine log of some events of one region."""
    return risk_events(read_table(spark, path, schema), event_ids, region, lo, hi)


def risk_events(log: DataFrame, event_ids: Sequence[int], region: str, lo: date, hi: date) -> DataFrame:
    """Events of the given kinds, region and days."""
    return log.where(
        F.col("grass_date").between(F.lit(lo), F.lit(hi))
        & F.col("event_id").isin(*event_ids)
        & (F.col("grass_region") == region)
    )
