"""Session settings and the two places where a job may cut or size its plan."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every operator relies on. Skewed join partitions are split at
# run time; results are compared and windows are cut in UTC.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to ``spark`` and return it."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if named:
        return named
    if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="deskmill-"))
    return sc.getCheckpointDir()


# Deletes the shuffle files of an execution when it ends; nothing reads those of a finished write again.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def durable_cut(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    The plan starts anew at the table, with its true size known to the optimizer, and an executor
    that is lost takes nothing with it. The shuffle files of the write are deleted with its end.
    """
    spark = df.sparkSession
    # One folder per application, so that what is left of one can be cleared as a whole.
    path = f"{shared_dir(spark).rstrip('/')}/{spark.sparkContext.applicationId}/cut-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    cut = spark.read.schema(df.schema).parquet(path)
    cut.cut_path = path
    for made in _collecting:
        made.append(path)
    return cut


# Lists of the paths written while ``cuts_dropped`` is on.
_collecting: list[list[str]] = []


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever file system it is; one that is gone already does no harm."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def discard(*cuts: DataFrame) -> None:
    """Delete tables of ``durable_cut`` from which nothing will be computed any more, not even anew after a loss."""
    for cut in cuts:
        delete_folder(cut.sparkSession, cut.cut_path)


@contextmanager
def cuts_dropped(spark: SparkSession) -> Iterator[None]:
    """Delete on leaving what ``durable_cut`` writes inside; for work whose result has been written by then."""
    made: list[str] = []
    _collecting.append(made)
    try:
        yield
    finally:
        _collecting.remove(made)
        for path in made:
            delete_folder(spark, path)
