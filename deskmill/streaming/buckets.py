"""Script metrics over a stream of runs, in a table of buckets that late runs correct.

Each batch writes a new version of the table: the version before it with the batch's runs added. Users are kept as sketches that can be
united, so that weeks come from days. A batch that is run again writes the same version again, from the same one before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from deskmill.operators.aggregates import GRAINS, fill_buckets, metric_window
from deskmill.session import delete_folder

# The sketches' size: a standard error of 1.04 / sqrt(2 ** LG_K), 0.8 percent.
LG_K = 14
# Versions kept, so that a reader of the one before is not disturbed.
KEPT = 2


def versions(spark: SparkSession, path: str) -> list[int]:
    """The versions of a table that were written to their end, in order."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(folder):
        return []
    found = [status.getPath() for status in system.listStatus(folder)]
    done = [p.getName() for p in found if system.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return sorted(int(name.removeprefix("version=")) for name in done if name.startswith("version="))


def _merged(parts: DataFrame) -> DataFrame:
    sums = [F.sum(c).cast("bigint").alias(c) for c in ("total_executions", "failed_executions")]
    return parts.groupBy("start").agg(*sums, F.hll_union_agg("users", F.lit(False)).alias("users"))


def land(runs: DataFrame, number: int, path: str) -> None:
    """Add a batch of runs (``ts, user_id, failed``) to the table at ``path`` as version ``number``."""
    spark = runs.sparkSession
    day = runs.groupBy(metric_window("ts", "DAILY").alias("w")).agg(
        F.count("*").alias("total_executions"), F.count_if("failed").alias("failed_executions"), F.hll_sketch_agg("user_id", LG_K).alias("users")
    )
    parts = day.select(F.col("w.start").cast("timestamp_ntz").alias("start"), "total_executions", "failed_executions", "users")
    before = [v for v in versions(spark, path) if v < number]
    if before:
        parts = parts.unionByName(spark.read.parquet(f"{path}/version={before[-1]}"))
    # A row per day.
    _merged(parts).coalesce(1).write.mode("overwrite").parquet(f"{path}/version={number}")
    for old in before[: 1 - KEPT] if KEPT > 1 else before:
        delete_folder(spark, f"{path}/version={old}")


def stream_buckets(runs: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Keep the table at ``path`` up to date with a stream of runs. No watermark is needed, and no run comes too late."""
    return (
        runs.writeStream.foreachBatch(lambda batch, number: land(batch, number, path))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_buckets(spark: SparkSession, path: str, grain: str = "DAILY") -> DataFrame:
    """``execution_metrics`` of all that has landed: users are estimated, empty buckets in between are zero."""
    (latest,) = versions(spark, path)[-1:] or [None]
    if latest is None:
        raise ValueError(f"no version of a table at {path}")
    length, offset = GRAINS[grain]
    start: Column = F.window("start", length, startTime=offset).alias("w")
    days = spark.read.parquet(f"{path}/version={latest}").select(start, "total_executions", "failed_executions", "users")
    merged = _merged(days.select(F.col("w.start").alias("start"), "total_executions", "failed_executions", "users"))
    return fill_buckets(merged.withColumn("active_users", F.hll_sketch_estimate("users")).drop("users"), grain)
