"""Exports that land file by file: records in one table, what cannot be read in another, each file once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from deskmill.session import configure
from deskmill.sources.exports import CORRUPT, entity_schema, with_defaults

RECORDS, REJECTS = "records", "rejects"


def land_export(spark: SparkSession, directory: str, entity: str, target: str) -> StreamingQuery:
    """Land the JSON files of ``<directory>/<entity>`` that are new since the last time, and end.

    Records with their defaults go to ``<target>/<entity>/records``, lines that cannot be read to ``…/rejects``, with their text in ``record``, their
    file, and the columns that could be read. A folder is written per batch, so that a batch that is run again takes its own place; which
    files are known is kept in ``…/state``.
    """
    configure(spark)
    schema = entity_schema(entity).add(CORRUPT, "string")
    lines = spark.readStream.schema(schema).option("columnNameOfCorruptRecord", CORRUPT).json(f"{directory.rstrip('/')}/{entity}")
    place = f"{target.rstrip('/')}/{entity}"

    def split(batch: DataFrame, number: int) -> None:
        named = batch.withColumn("file", F.input_file_name())
        good = F.col(CORRUPT).isNull()
        with_defaults(named.filter(good).drop(CORRUPT, "file"), entity).write.mode("overwrite").parquet(f"{place}/{RECORDS}/batch={number}")
        named.filter(~good).withColumnRenamed(CORRUPT, "record").write.mode("overwrite").parquet(f"{place}/{REJECTS}/batch={number}")

    return lines.writeStream.foreachBatch(split).option("checkpointLocation", f"{place}/state").trigger(availableNow=True).start()


def read_landed(spark: SparkSession, target: str, entity: str, part: str = RECORDS) -> DataFrame:
    """What has landed of an entity, or with ``REJECTS`` what was turned away, with its ``batch``."""
    schema = entity_schema(entity)
    if part == REJECTS:
        schema = schema.add("record", "string").add("file", "string")
    return spark.read.schema(schema.add("batch", "long")).parquet(f"{target.rstrip('/')}/{entity}/{part}")


def landing_counts(spark: SparkSession, target: str, entities: list[str]) -> DataFrame:
    """``entity, n_read, n_rejected, n_kept`` of what has landed."""
    parts = []
    for entity in entities:
        for part, rejected in ((RECORDS, 0), (REJECTS, 1)):
            parts.append(read_landed(spark, target, entity, part).select(F.lit(entity).alias("entity"), F.lit(rejected).alias("rejected")))
    rows = parts[0]
    for more in parts[1:]:
        rows = rows.unionAll(more)
    counts = rows.groupBy("entity").agg(F.count("*").alias("n_read"), F.count_if(F.col("rejected") == 1).alias("n_rejected"))
    return counts.withColumn("n_kept", F.col("n_read") - F.col("n_rejected"))
