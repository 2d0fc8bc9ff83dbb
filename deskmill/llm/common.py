"""What several operators of the pipeline share."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word is a run of bytes other than ASCII white space; ``bytes.split()`` finds the same words.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or the first of ``name_1``, ``name_2`` … that begins no column of ``df``."""
    taken = [c.lower() for c in df.columns]
    return next(found for i in count() if not any(c.startswith(found := f"{name}_{i}" if i else name) for c in taken))


def word_count(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def bytes_of(values: pa.Array) -> Iterator[bytes]:
    """The values of a string or binary column as bytes, null as empty."""
    data = values.cast(pa.large_binary()) if not pa.types.is_large_binary(values.type) else values
    for value in data:
        yield value.as_py() or b""


def total_bytes(df: DataFrame, column: str) -> int:
    """Bytes of a text column over all rows, to size partitions and buckets by."""
    return df.agg(F.sum(F.octet_length(column))).first()[0] or 0


CHUNK_BYTES = 2 << 20


def chunks(keys: list, texts: Iterator[bytes], size: int = CHUNK_BYTES) -> Iterator[tuple[list, list[bytes]]]:
    """Documents in groups of a few MB, so that what is computed for a group stays small."""
    held: tuple[list, list[bytes]] = ([], [])
    total = 0
    for key, text in zip(keys, texts, strict=True):
        held[0].append(key)
        held[1].append(text)
        total += len(text)
        if total >= size:
            yield held
            held, total = ([], []), 0
    if held[0]:
        yield held
