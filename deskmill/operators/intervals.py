"""Joins on intervals, by equality on the nodes of a tree instead of comparing all pairs.

A sheet is cut into tiles, and rows and columns of tiles are the leaves of a tree each, in which a node has 16 children. A
rectangle is filed at the nodes that cover its rows, times those that cover its columns: a short one at its tiles, a longer one at some
nodes per level, an open one at the nodes up to the next power of 16 and at a tail, which stands for all that lies beyond. A tile
that holds cells looks at its ancestors on the levels that are in use, and meets each rectangle that covers it at one of them; the
cells then meet the rectangles of their tile. On a sheet of few tiles any rectangle is short once it is cut to the sheet, and needs no tree.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows and columns of one tile.
TILE = (1024, 16)
# A node has 2 ** STEP children; LEVELS of them are enough for 2 ** 32 tiles, and places beyond count as the last tile.
STEP, LEVELS = 4, 8
LAST_TILE = (1 << STEP * LEVELS) - 1
# Rectangles over at most so many tiles are filed at the tiles themselves, and so are all on a sheet of at most so many tiles.
SHORT = 16
# The tail of m stands above the nodes, at the level TAIL + m: it covers the tiles with more than m digits to the base 16.
TAIL = LEVELS + 1
# Nodes from this level on hold the cells of many tiles, which are dealt to so many parts; rules are in all of them.
DEALT_LEVEL, PARTS = 2, 8


def _shifted(value: Column, by: Column, left: bool = False) -> Column:
    return F.call_function("shiftleft" if left else "shiftright", value, by.cast("int"))


def _digits(tile: Column) -> Column:
    """Digits of a tile number to the base 16; 0 has none."""
    return F.when(tile == 0, F.lit(0)).otherwise(F.length(F.hex(tile)))


def _tile(place: Column, size: int) -> Column:
    return F.greatest(F.least(F.floor(place / size), F.lit(LAST_TILE)), F.lit(0)).cast("bigint")


def _node(level: Column, node: Column) -> Column:
    return F.struct(level.cast("int").alias("level"), node.cast("bigint").alias("node"))


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value computed once however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _run(low: Column, end: Column) -> Column:
    return F.when(low < end, F.sequence(low, end - 1)).otherwise(F.array().cast("array<bigint>"))


def cover(low: Column, high: Column, size: int) -> Column:
    """Nodes (``level``, ``node``) that together cover the tiles of the places from ``low`` (null: 0) to before ``high`` (null: open) once each."""

    def at(first: Column, end: Column, level: Column) -> Column:
        bits = level * STEP
        lo = _shifted(first + _shifted(F.lit(1).cast("bigint"), bits, True) - 1, bits)

        def nodes(span: Column) -> Column:
            lo, hi = span["lo"], span["hi"]
            # Whole parents are left to the level above, if there is one.
            up, down = _shifted(_shifted(lo + ((1 << STEP) - 1), F.lit(STEP)), F.lit(STEP), True), _shifted(_shifted(hi, F.lit(STEP)), F.lit(STEP), True)
            return F.when((up >= down) | (level == LEVELS - 1), _run(lo, hi)).otherwise(F.concat(_run(lo, up), _run(down, hi)))

        return F.transform(_with(F.struct(lo.alias("lo"), _shifted(end, bits).alias("hi")), nodes), lambda n: _node(level, n))

    def nodes(place: Column) -> Column:
        first, last, digits = place["first"], place["last"], place["digits"]
        # An open range is closed at the next power of 16; the tail has the rest.
        end = F.when(last.isNotNull(), last + 1).otherwise(_shifted(F.lit(1).cast("bigint"), digits * STEP, True))
        levels = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(LEVELS - 1)), lambda level: at(first, end, level)))
        tail = F.array(_node(TAIL + F.when(first == 0, F.lit(-1)).otherwise(digits), F.lit(0)))
        short = F.transform(F.sequence(first, F.coalesce(last, first)), lambda n: _node(F.lit(0), n))
        return F.when(last.isNull(), F.when(first == 0, tail).otherwise(F.concat(levels, tail))).when(last - first < SHORT, short).otherwise(levels)

    first = _tile(F.coalesce(low, F.lit(0)), size)
    last = F.when(high.isNotNull(), _tile(high - 1, size))
    return _with(F.struct(first.alias("first"), last.alias("last"), _digits(first).alias("digits")), nodes)


def ancestor(place: Column, size: int, level: Column) -> Column:
    """The node of a level that holds a place; null where a tail does not."""
    tile = _tile(place, size)
    return F.when(level < LEVELS, _shifted(tile, level * STEP)).when(_digits(tile) > level - TAIL, F.lit(0).cast("bigint"))


def _some() -> Column:
    """A range holds a place."""
    low = F.coalesce("r0", F.lit(0))
    left = F.coalesce("c0", F.lit(0))
    return (F.col("r1").isNull() | (F.col("r1") > F.greatest(low, F.lit(0)))) & (F.col("c1").isNull() | (F.col("c1") > F.greatest(left, F.lit(0))))


def _filed(ranges: DataFrame, sheet: str, carry: Sequence[str]) -> DataFrame:
    """Ranges with a row for each key they are filed under: sheet, node of rows, node of columns, part."""
    rows = ranges.filter(_some()).select(F.col(sheet).alias("_sheet"), "r0", "r1", "c0", "c1", *carry, F.explode(cover(F.col("r0"), F.col("r1"), TILE[0])).alias("_rows"))
    nodes = rows.withColumn("_columns", F.explode(cover(F.col("c0"), F.col("c1"), TILE[1])))
    parts = F.when(F.col("_rows.level") >= DEALT_LEVEL, F.sequence(F.lit(0), F.lit(PARTS - 1))).otherwise(F.array(F.lit(0)))
    return nodes.withColumn("_part", F.explode(parts))


# A node and its part as one number: the level above the node's 32 bits, and those of the part below.
_KEYS = {
    "_row_key": f"(_rows.level * {1 << STEP * LEVELS} + _rows.node) * {PARTS} + _part",
    "_column_key": f"_columns.level * {1 << STEP * LEVELS} + _columns.node",
}


def _used(rules: DataFrame) -> Column:
    """The pairs of levels in use, found while the query runs; there are at most as many as pairs of levels."""
    return rules.agg(F.collect_set(F.struct(F.col("_rows.level").alias("rows"), F.col("_columns.level").alias("columns")))).scalar()


def _looked_up(cells: DataFrame, rules: DataFrame) -> DataFrame:
    """Each cell with a row for each key it may meet ranges at."""
    used = _used(rules)
    dealt = F.pmod(F.xxhash64(_tile(F.col("row"), TILE[0]), _tile(F.col("col"), TILE[1])), F.lit(PARTS)).cast("int")
    levels = cells.withColumn("_used", used).withColumn("_level", F.explode("_used"))
    row, column = F.col("_level.rows"), F.col("_level.columns")
    nodes = levels.select(
        *cells.columns,
        F.struct(row.alias("level"), ancestor(F.col("row"), TILE[0], row).alias("node")).alias("_rows"),
        F.struct(column.alias("level"), ancestor(F.col("col"), TILE[1], column).alias("node")).alias("_columns"),
        F.when(row >= DEALT_LEVEL, dealt).otherwise(F.lit(0)).alias("_part"),
    )
    keys = nodes.select(*cells.columns, *[F.expr(c).alias(k) for k, c in _KEYS.items()])
    return keys.filter(F.col("_row_key").isNotNull() & F.col("_column_key").isNotNull())


def _tiles_of(cells: DataFrame, sheet: str) -> DataFrame:
    """The tiles that hold cells, once each: their numbers, and their first place as ``row`` and ``col``."""
    tiles = cells.select(sheet, _tile(F.col("row"), TILE[0]).alias("_tile_row"), _tile(F.col("col"), TILE[1]).alias("_tile_col")).distinct()
    return tiles.withColumns({"row": F.col("_tile_row") * TILE[0], "col": F.col("_tile_col") * TILE[1]})


def _on_tiles(cells: DataFrame, filed: DataFrame, sheet: str, carry: Sequence[str]) -> DataFrame:
    """Each range with each tile that it covers in whole or in part and that holds cells."""
    rules = filed.select("_sheet", "r0", "r1", "c0", "c1", *carry, *[F.expr(c).alias(k) for k, c in _KEYS.items()])
    same = F.col(f"tiles.{sheet}") == F.col("rules._sheet")
    for k in _KEYS:
        same = same & (F.col(f"tiles.{k}") == F.col(f"rules.{k}"))
    tiles = _looked_up(_tiles_of(cells, sheet), filed).alias("tiles")
    return tiles.join(rules.alias("rules"), same).select("_sheet", "_tile_row", "_tile_col", "r0", "r1", "c0", "c1", *carry)


def _extents(cells: DataFrame, sheet: str) -> DataFrame:
    """Per sheet, its first and last tile of rows and of columns, and whether these are the bounds of few tiles."""
    row, col = _tile(F.col("row"), TILE[0]), _tile(F.col("col"), TILE[1])
    bounds = (F.min(row).alias("_top"), F.max(row).alias("_bottom"), F.min(col).alias("_left"), F.max(col).alias("_right"))
    found = cells.filter(F.col(sheet).isNotNull()).groupBy(F.col(sheet).alias("_sheet")).agg(*bounds)
    tiles = F.expr("cast(_bottom - _top + 1 as double) * (_right - _left + 1)")
    return found.withColumn("_few", tiles <= SHORT)


def _spread(spans: DataFrame, carry: Sequence[str]) -> DataFrame:
    """Each range with each tile from ``_row0`` and ``_col0`` to ``_row1`` and ``_col1``."""
    kept = ("_sheet", "r0", "r1", "c0", "c1", *carry)
    rows = spans.select(*kept, "_col0", "_col1", F.explode(_run(F.col("_row0"), F.col("_row1") + 1)).alias("_tile_row"))
    return rows.select("_sheet", "_tile_row", F.explode(_run(F.col("_col0"), F.col("_col1") + 1)).alias("_tile_col"), *kept[1:])


def _ranges_by_tile(cells: DataFrame, ranges: DataFrame, sheet: str, carry: Sequence[str]) -> DataFrame:
    """Each range with the tiles that it covers in whole or in part: short ones with all of them, others with those of their sheet.

    A range that is long or open is cut to its sheet where that has few tiles; only on larger sheets it is filed in the tree, for which
    ``cells`` are read once more.
    """
    firsts = {"_row0": _tile(F.coalesce("r0", F.lit(0)), TILE[0]), "_col0": _tile(F.coalesce("c0", F.lit(0)), TILE[1])}
    lasts = {"_row1": F.when(F.col("r1").isNotNull(), _tile(F.col("r1") - 1, TILE[0])), "_col1": F.when(F.col("c1").isNotNull(), _tile(F.col("c1") - 1, TILE[1]))}
    spans = ranges.filter(_some()).select(F.col(sheet).alias("_sheet"), "r0", "r1", "c0", "c1", *carry).withColumns(firsts | lasts)
    short = F.coalesce((F.col("_row1") - F.col("_row0") < SHORT) & (F.col("_col1") - F.col("_col0") < SHORT), F.lit(False))
    others, extents = spans.filter(~short), _extents(cells, sheet)
    # ``least`` and ``greatest`` leave out nulls, which are open ends here.
    low = {"_row0": F.greatest("_row0", "_top"), "_col0": F.greatest("_col0", "_left")}
    high = {"_row1": F.least("_row1", "_bottom"), "_col1": F.least("_col1", "_right")}
    cut = others.join(extents.filter("_few"), "_sheet").withColumns(low | high)
    # Without such ranges on a large sheet nothing is read or shuffled for the tree. They are counted by the join above, so that it shares its exchanges.
    large = extents.filter(~F.col("_few")).select("_sheet")
    found = others.join(extents.filter(~F.col("_few")), "_sheet").agg(F.count("*")).scalar()
    on_large = others.filter(F.when(F.col("_sheet").isNotNull(), found) > 0).join(large, "_sheet", "left_semi")
    tree = _on_tiles(cells.filter(F.when(F.col(sheet).isNotNull(), found) > 0), _filed(on_large, "_sheet", carry), sheet, carry)
    return _spread(spans.filter(short), carry).unionByName(_spread(cut, carry)).unionByName(tree)


def _inside(sheet: str) -> Column:
    """A cell of ``cells`` lies in a range of ``rules``, which come by tile; a cell has one tile, so that it travels once."""
    row, col = F.col("cells.row"), F.col("cells.col")
    return (
        (F.col(f"cells.{sheet}") == F.col("rules._sheet"))
        & (_tile(row, TILE[0]) == F.col("rules._tile_row"))
        & (_tile(col, TILE[1]) == F.col("rules._tile_col"))
        & (F.col("rules.r0").isNull() | (row >= F.col("rules.r0")))
        & (F.col("rules.r1").isNull() | (row < F.col("rules.r1")))
        & (F.col("rules.c0").isNull() | (col >= F.col("rules.c0")))
        & (F.col("rules.c1").isNull() | (col < F.col("rules.c1")))
    )


def cells_in_ranges(
    cells: DataFrame,
    ranges: DataFrame,
    sheet: str = "sheet_id",
    carry: Sequence[str] = ("rule_idx",),
) -> DataFrame:
    """Cells inside half-open rectangles ``[r0, r1) x [c0, c1)``; a null bound is open.

    One row per (cell, range that holds it), with the ``carry`` columns of the range. Rows and columns count from 0. Cells meet the
    ranges on their tile, so that a sheet is spread over its tiles and a cell is shuffled once. The tiles of a range are its own if they are
    few, or those of its sheet if these are few; on larger sheets the tiles that hold cells meet the ranges on (sheet, node of the rows,
    node of the columns), however many levels are in use. ``cells`` is read twice, and a third time if there are larger sheets.
    """
    rules = _ranges_by_tile(cells, ranges, sheet, carry).alias("rules")
    met = cells.alias("cells").join(rules, _inside(sheet))
    return met.select(*[F.col(f"cells.{c}") for c in cells.columns], *[F.col(f"rules.{c}") for c in carry])


def split_by_ranges(cells: DataFrame, ranges: DataFrame, sheet: str = "sheet_id") -> tuple[DataFrame, DataFrame]:
    """Cells inside at least one rectangle, and the others; every cell once.

    Ranges filed at single tiles need no look at the tiles that hold cells; without others, ``cells`` go before their first shuffle there.
    """
    filed = _filed(ranges, sheet, ())
    single = (F.col("_rows.level") == 0) & (F.col("_columns.level") == 0)
    others = filed.filter(~single)
    wide = _on_tiles(cells.filter(F.when(F.col(sheet).isNotNull(), F.size(_used(others))) > 0), others, sheet, ())
    places = (F.col("_rows.node").alias("_tile_row"), F.col("_columns.node").alias("_tile_col"))
    on_tiles = filed.filter(single).select("_sheet", *places, "r0", "r1", "c0", "c1").unionByName(wide)
    # Ranges that hold the same part of a tile count once there.
    lo = {c: F.greatest(F.col(c), F.col(tile) * size) for c, tile, size in (("r0", "_tile_row", TILE[0]), ("c0", "_tile_col", TILE[1]))}
    hi = {c: F.when(F.col(c) < (F.col(tile) + 1) * size, F.col(c)) for c, tile, size in (("r1", "_tile_row", TILE[0]), ("c1", "_tile_col", TILE[1]))}
    rules = on_tiles.withColumns(lo | hi).distinct().alias("rules")
    held = _inside(sheet) & F.col("cells.row").isNotNull() & F.col("cells.col").isNotNull()
    return cells.alias("cells").join(rules, held, "left_semi"), cells.alias("cells").join(rules, held, "left_anti")


def overlap_pairs(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_bounds: tuple[str, str],
    right_bounds: tuple[str, str],
    width: int = 4096,
) -> DataFrame:
    """Pairs of half-open intervals that overlap within ``keys``.

    Both sides are cut into buckets of ``width`` and joined on (keys, bucket); a pair that meets
    in several buckets is kept in the first of them only.
    """

    def placed(df: DataFrame, bounds: tuple[str, str], mark: str) -> DataFrame:
        lo, hi = F.col(bounds[0]), F.col(bounds[1])
        first, last = F.floor(lo / width), F.floor((F.greatest(hi, lo + 1) - 1) / width)
        return df.withColumns({f"_first{mark}": first, "_bucket": F.explode(F.sequence(first, last))})

    a, b = placed(left, left_bounds, "_l"), placed(right, right_bounds, "_r")
    joined = a.join(b, [*keys, "_bucket"], "inner")
    meets = (F.col(left_bounds[0]) < F.col(right_bounds[1])) & (F.col(left_bounds[1]) > F.col(right_bounds[0]))
    first_shared = F.col("_bucket") == F.greatest("_first_l", "_first_r")
    return joined.filter(meets & first_shared).drop("_bucket", "_first_l", "_first_r")
