"""Sort, limit, pages and top rows per group."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deskmill.functions.text import shortened


BROADCAST_ROWS = 10_000


def latest_files(files: DataFrame, mime_type: str, n: int, id_column: str = "id") -> DataFrame:
    """The ``n`` files of a type that were changed last and are not in the bin; ties by id."""
    live = files.filter((F.col("mime_type") == mime_type) & ~F.coalesce(F.col("trashed"), F.lit(False)))
    return live.orderBy(F.col("modified_time").desc(), F.col(id_column)).limit(n)


def page_after(df: DataFrame, key: str, token: Any, n: int) -> DataFrame:
    """The next ``n`` records after ``token`` by a unique key, with ``has_more``.

    The window runs over the at most ``n + 1`` rows the limit leaves.
    """
    rest = df if token is None else df.filter(F.col(key) > F.lit(token))
    ahead = rest.orderBy(key).limit(n + 1)
    counted = ahead.select(
        "*",
        F.row_number().over(Window.orderBy(key)).alias("_place"),
        F.count("*").over(Window.partitionBy()).alias("_seen"),
    )
    return counted.filter(F.col("_place") <= n).select(*df.columns, (F.col("_seen") > n).alias("has_more"))


# Ranges that a directory divides keys into, keys drawn for each border, and the rows of a range that is sorted as a whole.
RANGES, DRAWN, RANGE_ROWS = 64, 16, 1 << 14


def _borders(rows: DataFrame, key: str) -> list[Any]:
    """Keys that part the rows into at most ``RANGES`` ranges of about equal size, from as many keys whatever the table's size."""
    drawn = rows.select(key).orderBy(F.xxhash64(key), key).limit(RANGES * DRAWN)
    found = [r[0] for r in drawn.distinct().orderBy(key).collect()]
    return found[DRAWN::DRAWN] if len(found) > 2 * DRAWN else found[1:]


def _range_number(key: Column, borders: list[Any], low: int, high: int) -> Column:
    """How many borders are not above the key, by halving."""
    if low == high:
        return F.lit(low)
    middle = (low + high) // 2
    return F.when(key < F.lit(borders[middle]), _range_number(key, borders, low, middle)).otherwise(_range_number(key, borders, middle + 1, high))


def key_at(df: DataFrame, key: str, position: int) -> Any:
    """The key at a position, counted from 1 in the order of a unique key; null beyond the end.

    Rows are counted per range of keys, and then only inside the range that holds the position, until that is small enough to be sorted. A
    count of ranges is a few rows; a range is a filter that reaches the scan.
    """
    rows, size = df.filter(F.col(key).isNotNull()), None
    while size is None or size > RANGE_ROWS:
        borders = _borders(rows, key)
        counts = dict(rows.select(_range_number(F.col(key), borders, 0, len(borders)).alias("n")).groupBy("n").count().collect())
        if size is None and position > sum(counts.values()):
            return None
        number = 0
        while position > counts.get(number, 0):
            position -= counts.get(number, 0)
            number += 1
        if number:
            rows = rows.filter(F.col(key) >= F.lit(borders[number - 1]))
        if number < len(borders):
            rows = rows.filter(F.col(key) < F.lit(borders[number]))
        if size == counts[number]:
            break
        size = counts[number]
    return rows.select(key).orderBy(key).limit(position).agg(F.max(key)).first()[0]


def page_positions(df: DataFrame, key: str, start: int, n: int) -> DataFrame:
    """Records ``start … start + n - 1`` (counted from 1) in the order of ``key``, which is unique; rows without a key are left out."""
    first = key_at(df, key, start)
    if first is None or n < 1:
        return df.limit(0)
    page = df.filter(F.col(key) >= F.lit(first))
    if n > RANGE_ROWS and (last := key_at(df, key, start + n - 1)) is not None:
        return page.filter(F.col(key) <= F.lit(last)).orderBy(key)
    return page.orderBy(key).limit(n) if n <= RANGE_ROWS else page.orderBy(key)


def top_per_group(
    messages: DataFrame,
    spaces: DataFrame,
    phrase: str,
    groups: int = 10,
    k: int = 5,
    space: str = "space",
) -> DataFrame:
    """At most ``k`` messages with the phrase, newest first, in each of the first ``groups`` spaces.

    The list of spaces is cut to ``groups`` rows before it is broadcast, and a long one is not.
    """
    chosen = spaces.orderBy(space).limit(groups)
    if groups <= BROADCAST_ROWS:
        chosen = F.broadcast(chosen)
    hits = messages.filter(F.contains(F.lower("text"), F.lit(phrase.lower())))
    newest = Window.partitionBy(space).orderBy(F.col("create_time").desc(), F.col("message_id"))
    return (
        hits.join(chosen, space)
        .withColumn("place", F.row_number().over(newest))
        .filter(F.col("place") <= k)
        .withColumn("text", shortened(F.col("text"), 100))
    )


def preview_with_overflow(df: DataFrame, part: str, order: list[str], n: int) -> DataFrame:
    """The first ``n`` rows of every part, and how many more there are.

    The rank limit is applied before the shuffle and the counts are aggregated apart, so that a
    large part never meets in one task.
    """
    place = F.row_number().over(Window.partitionBy(part).orderBy(*order))
    top = df.withColumn("place", place).filter(F.col("place") <= n)
    counts = df.groupBy(part).agg(F.greatest(F.count("*") - n, F.lit(0)).cast("bigint").alias("n_more"))
    return top.join(counts, part)
