"""Script metrics over a stream of runs."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from deskmill.operators.aggregates import metric_window
from deskmill.session import configure


def stream_execution_metrics(runs: DataFrame, grain: str = "DAILY", late: str = "1 hour") -> DataFrame:
    """``execution_metrics`` for a streaming table: users are counted approximately, buckets close
    once the watermark has passed them, and empty buckets are not filled in. Rows of a closed bucket
    that arrive after that (a backfill, files out of time order) are left out; ``late_rows`` tells of them.
    Event time must have a zone on a stream, so a timestamp without one is read in the session's, UTC."""
    kind = runs.schema["ts"].dataType
    return (
        runs.withColumn("ts", F.col("ts").cast("timestamp"))
        .withWatermark("ts", late)
        .groupBy(metric_window("ts", grain).alias("w"))
        .agg(
            F.approx_count_distinct("user_id").alias("active_users"),
            F.count("*").alias("total_executions"),
            F.count_if("failed").alias("failed_executions"),
        )
        .select(
            F.col("w.start").cast(kind).alias("start_time"),
            F.col("w.end").cast(kind).alias("end_time"),
            "active_users",
            "total_executions",
            "failed_executions",
        )
    )


def read_run_stream(spark: SparkSession, directory: str, schema: str, files: str = "*.parquet") -> DataFrame:
    """Files of runs as they arrive in a folder."""
    configure(spark)
    return spark.readStream.schema(schema).option("pathGlobFilter", files).parquet(directory)


def write_metrics(metrics: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append closed buckets to a parquet table, with what has arrived so far."""
    return (
        metrics.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def late_rows(query: StreamingQuery) -> int:
    """``numRowsDroppedByWatermark`` of a query's progress: not 0 if rows came too late for their bucket.

    Spark counts rows after partial aggregation, so more runs than that may be missing. It keeps the
    progress of the last ``spark.sql.streaming.numRecentProgressUpdates`` batches, and of this run only.
    """
    return sum(state["numRowsDroppedByWatermark"] for p in query.recentProgress for state in json.loads(p.json)["stateOperators"])
