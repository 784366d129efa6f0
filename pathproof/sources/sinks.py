"""Writers: full replace, partitioned replace, replace of a range of days."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def write_full(df: DataFrame, path: str) -> None:
    """Replace the whole table."""
    df.write.mode("overwrite").parquet(path)


def write_partitioned(df: DataFrame, path: str, by: list[str]) -> None:
    """Replace the whole table, partitioned by ``by``.

    The rebalance hint groups rows by partition for few files, and lets Spark split the
    partition that holds most of the rows.
    """
    df.hint("rebalance", *[F.col(c) for c in by]).write.mode("overwrite").partitionBy(*by).parquet(path)


def replace_days(df: DataFrame, path: str, day: str, lo: date, hi: date) -> None:
    """Replace the days ``[lo, hi]`` of a table partitioned by ``day``, leave the others.

    Same outcome as deleting the range and inserting: days with rows are overwritten one
    by one, days of the range without rows are removed afterwards. Rerunning it after a
    failure gives the same table; it is not atomic, a reader may see a mix meanwhile.
    """
    days = [lo + timedelta(days=i) for i in range((hi - lo).days + 1)]
    written = Observation()
    (
        df.where(F.col(day).between(F.lit(lo), F.lit(hi)))
        .observe(written, *[F.count_if(F.col(day) == F.lit(d)).alias(d.isoformat()) for d in days])
        .hint("rebalance", F.col(day))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(day)
        .parquet(path)
    )
    empty = [d for d in days if not written.get.get(d.isoformat())]
    _drop_partitions(df, path, [f"{day}={d.isoformat()}" for d in empty])


def _drop_partitions(df: DataFrame, path: str, names: list[str]) -> None:
    spark = df.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for name in names:
        gone = hadoop.Path(root, name)
        if files.exists(gone):
            files.delete(gone, True)
