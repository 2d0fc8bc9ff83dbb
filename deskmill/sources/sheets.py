"""Sheet values: delimited text, grid blocks, and writing a rectangle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskmill.functions.addresses import cell_address
from deskmill.functions.text import stripped
from deskmill.operators.intervals import split_by_ranges
from deskmill.session import durable_cut


def read_delimited_tables(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Cells of text tables: ``key, row, col, value``.

    The delimiter is a tab if the text has one, else a comma, else white space (blank cells are then
    left out).
    """
    lines = F.split(stripped(F.col(text)), "\n")
    line = F.col("line")
    words = F.filter(F.split(line, r"\s+"), lambda w: w != "")
    cells = (
        F.when(F.col("by") == "tab", F.split(line, "\t")).when(F.col("by") == "comma", F.split(line, ",")).otherwise(words)
    )
    by = (
        F.when(F.contains(F.col(text), F.lit("\t")), "tab")
        .when(F.contains(F.col(text), F.lit(",")), "comma")
        .otherwise("blank")
    )
    return (
        df.select(key, by.alias("by"), F.posexplode(lines).alias("row", "line"))
        .select(key, "row", F.posexplode(cells).alias("col", "value"))
    )


def flatten_grid(blocks: DataFrame) -> DataFrame:
    """Grid blocks to cells with their address: block offsets are added to the positions.

    ``blocks`` has ``title, start_row, start_col`` and ``rows``, a list of lists of values; missing
    offsets are 0 and cells without a value are dropped.
    """
    zero = F.lit(0)
    return (
        blocks.select("title", "start_row", "start_col", F.posexplode("rows").alias("_r", "_cells"))
        .select("title", "start_row", "start_col", "_r", F.posexplode("_cells").alias("_c", "value"))
        .filter(F.col("value").isNotNull())
        .select(
            "title",
            (F.coalesce("start_row", zero) + F.col("_r")).cast("bigint").alias("row"),
            (F.coalesce("start_col", zero) + F.col("_c")).cast("bigint").alias("col"),
            "value",
        )
        .withColumn("address", cell_address(F.col("title"), F.col("row"), F.col("col")))
    )


def write_range(
    cells: DataFrame, path: str, ranges: DataFrame, updates: DataFrame | None = None, mode: str = "update"
) -> tuple[DataFrame, DataFrame]:
    """Write a new snapshot of ``cells`` in which rectangles are replaced or cleared.

    ``ranges`` has ``sheet_id, r0, r1, c0, c1``. With mode ``update`` the cells of ``updates``
    inside the ranges take the place of the old ones, with ``clear`` nothing does. Returns the
    snapshot as read back, and per sheet the cells, rows and columns updated. The old cells stay as
    they were.
    """
    if mode not in ("update", "clear"):
        raise ValueError(f"unknown mode {mode!r}")
    if (mode == "update") != (updates is not None):
        raise ValueError("updates are given with mode 'update' and only then")
    changed, kept = split_by_ranges(cells, ranges)
    if mode == "update":
        # Read for the snapshot and for the counts.
        changed = durable_cut(split_by_ranges(updates, ranges)[0].select(*cells.columns))
        kept = kept.unionByName(changed)
    kept.write.mode("errorifexists").parquet(path)
    snapshot = cells.sparkSession.read.schema(cells.schema).parquet(path)
    counts = changed.groupBy("sheet_id").agg(
        F.count("*").alias("updated_cells"),
        F.count_distinct("row").alias("updated_rows"),
        F.count_distinct("col").alias("updated_columns"),
    )
    return snapshot, counts
