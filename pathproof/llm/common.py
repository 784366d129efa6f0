"""Shared helpers: tables, scratch storage that all executors see, connected components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of one Arrow batch: texts of a hundred thousand characters still make small batches.
BATCH_ROWS = 256
#: With it, files of a shuffle go when the query that made them ends, not when the driver happens to collect its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A new folder name below ``spark.checkpoint.dir``, which all executors share.

    Only where that setting is missing (tests on one machine) a temporary folder takes its place.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="run-")
        spark.conf.set("spark.checkpoint.dir", base)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: a reliable cut of the lineage with known sizes.

    The files of its shuffles go at once.
    """
    spark = df.sparkSession
    path = scratch(spark)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def forget(*frames: DataFrame) -> None:
    """Removes the files of ``stored`` frames, or of what frames read of them, that nothing needs any more."""
    for path in {f.rpartition("/")[0] for df in frames for f in df.inputFiles()}:
        spark = frames[0].sparkSession
        if "/llm-" in path:
            hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
            hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def map_arrow(
    df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``mapInArrow`` with small input batches, so that long texts stay within a worker's memory."""

    def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pieces() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, BATCH_ROWS):
                    yield batch.slice(at, BATCH_ROWS)

        return work(pieces())

    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(4 * BATCH_ROWS))
    return df.mapInArrow(sliced, schema)


def text_key(text: Column) -> Column:
    """Identity of a text: 32 hex digits; a null text counts as empty."""
    return F.md5(F.coalesce(text, F.lit("")))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected ``edges`` (a, b): rows (node, component), the smallest node of each.

    Alternates the two star operations of large-scale component search: every node hands its smallest neighbour to
    its larger neighbours, then to its smaller ones. Edges never outnumber those given, the steps grow with the
    logarithm of the longest path, and only a count and a checksum reach the driver. Nodes without an edge, loops
    and null ends give no row; an empty frame gives an empty result. Nodes may be of any type that Spark can order.
    """
    scratch(edges.sparkSession)  # sets the checkpoint folder
    high, low = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    edges = edges.where("a <> b").select(high, low).distinct().checkpoint()
    before = None
    while True:
        state = edges.agg(
            F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))
        ).first()
        if state == before or state[0] == 0:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        before = state
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.union(least.select("a", F.col("m").alias("b")))
        edges = small.distinct().checkpoint()
