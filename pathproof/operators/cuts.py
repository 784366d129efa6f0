"""Cuts of a plan: what several steps read is made once and read back."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame


def made_once(df: DataFrame) -> DataFrame:
    """``df`` written below ``spark.checkpoint.dir`` and read back.

    A frame that two steps read is planned and run twice, and those of a chain of such steps
    as often as two to the number of steps. Files stay until the folder is cleared, as those of
    checkpoints. A local session without that setting uses a temporary folder; on a cluster
    without it ``df`` stays as it is: the same rows by a longer plan.
    """
    spark = df.sparkSession
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            return df
        base = "file://" + tempfile.mkdtemp(prefix="run-")
    path = f"{base.rstrip('/')}/step-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
