"""Interval joins against all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from deskmill.operators.filters import cell_conditions
from deskmill.operators import intervals
from deskmill.operators.intervals import ancestor, cells_in_ranges, cover, overlap_pairs, split_by_ranges
from deskmill.sources.sheets import write_range

CELL = "sheet_id long, row long, col int, value string"
RANGE = "rule_idx long, sheet_id long, r0 long, r1 long, c0 int, c1 int"


@pytest.fixture(scope="module")
def sheet():
    rng = random.Random(5)
    spots = [0, 1, 63, 64, 65, 4095, 4096, 9000, 262143, 262144, 300000, 900000]
    cells = [(s, r, c, f"{s}-{r}-{c}") for s in (1, 2) for r in spots for c in range(4)]
    ranges = [(0, 1, None, None, None, None), (1, 2, 60, 70, 1, 3), (2, 2, 0, 300000, None, 2), (3, 1, 5, 5, 0, 9)]
    for i in range(4, 60):
        lo = rng.choice([None, *spots])
        size = rng.choice([1, 10, 64, 100, 4096, 5000, 262144, 800000, None])
        hi = None if size is None else (lo or 0) + size
        c0 = rng.choice([None, 0, 1, 2])
        c1 = rng.choice([None, 2, 3, 4])
        ranges.append((i, rng.choice([1, 2, 3]), lo, hi, c0, c1))
    return cells, ranges


def holds(cell, rng):
    s, r, c, _ = cell
    _, rs, r0, r1, c0, c1 = rng
    return (
        s == rs
        and (r0 is None or r >= r0)
        and (r1 is None or r < r1)
        and (c0 is None or c >= c0)
        and (c1 is None or c < c1)
    )


def test_cells_in_ranges(spark, sheet):
    cells, ranges = sheet
    got = cells_in_ranges(spark.createDataFrame(cells, CELL), spark.createDataFrame(ranges, RANGE)).collect()
    want = sorted((c[3], g[0]) for c in cells for g in ranges if holds(c, g))
    assert sorted((r.value, r.rule_idx) for r in got) == want


@pytest.mark.parametrize("first", [0, 1, 4])
def test_split_by_ranges(spark, sheet, first):
    cells, ranges = sheet
    some = ranges[first : first + 5]
    inside, rest = split_by_ranges(spark.createDataFrame(cells, CELL), spark.createDataFrame(some, RANGE))
    want = {c[3] for c in cells if any(holds(c, g) for g in some)}
    got = [r.value for r in inside.collect()]
    assert sorted(got) == sorted(want)
    assert sorted(r.value for r in rest.collect()) == sorted({c[3] for c in cells} - want)


def test_no_ranges(spark, sheet):
    none = spark.createDataFrame([], RANGE)
    cells = spark.createDataFrame(sheet[0], CELL)
    assert cells_in_ranges(cells, none).count() == 0
    assert split_by_ranges(cells, none)[1].count() == cells.count()


def test_overlap_pairs(spark):
    rng = random.Random(11)

    def some(n):
        out = []
        for i in range(n):
            lo = rng.randrange(100)
            out.append((rng.choice(["x", "x", "y"]), i, lo, lo + rng.choice([0, 1, 5, 40])))
        return out

    left, right = some(60), some(60)
    got = overlap_pairs(
        spark.createDataFrame(left, "k string, l int, a int, b int"),
        spark.createDataFrame(right, "k string, r int, c int, d int"),
        ["k"],
        ("a", "b"),
        ("c", "d"),
        width=8,
    ).collect()
    want = sorted((p[1], q[1]) for p in left for q in right if p[0] == q[0] and p[2] < q[3] and p[3] > q[2])
    assert sorted((r.l, r.r) for r in got) == want


def test_conditions(spark):
    cells = spark.createDataFrame(
        [(1, 0, 0, "5"), (1, 1, 0, "abc"), (1, 2, 0, ""), (1, 3, 0, None), (1, 4, 0, "2024-05-01"), (2, 0, 0, "abc")], CELL
    )

    def matched(kind, *values):
        rules = spark.createDataFrame(
            [(0, 1, None, None, None, None, kind, list(values), 2, None, None, None, None)],
            RANGE + ", type string, values array<string>, src_sheet long, src_r0 long, src_r1 long, src_c0 int, src_c1 int",
        )
        return sorted(r.row for r in cell_conditions(cells, rules).collect())

    assert matched("NUMBER_GREATER", "4") == [0]
    assert matched("NUMBER_NOT_EQ", "5") == []
    assert matched("TEXT_CONTAINS", "b") == [1]
    assert matched("TEXT_NOT_CONTAINS", "b") == [0, 2, 4]
    assert matched("DATE_BETWEEN", "2024-01-01", "2024-12-31") == [4]
    assert matched("BLANK") == [2, 3]
    assert matched("NOT_BLANK") == [0, 1, 4]
    assert matched("ONE_OF_RANGE") == [1]
    assert matched("NO_SUCH_KIND") == []


def test_write_range(spark, tmp_path):
    cells = spark.createDataFrame([(1, r, c, "old") for r in range(3) for c in range(3)], CELL)
    ranges = spark.createDataFrame([(0, 1, 0, 2, 0, 2)], RANGE)
    updates = spark.createDataFrame([(1, 0, 0, "new"), (1, 2, 2, "outside")], CELL)
    snapshot, counts = write_range(cells, str(tmp_path / "a"), ranges, updates)
    values = {(r.row, r.col): r.value for r in snapshot.collect()}
    assert values == {(0, 0): "new", (0, 2): "old", (1, 2): "old", (2, 0): "old", (2, 1): "old", (2, 2): "old"}
    assert [tuple(r) for r in counts.collect()] == [(1, 1, 1, 1)]
    cleared, counts = write_range(cells, str(tmp_path / "b"), ranges, mode="clear")
    assert cleared.count() == 5 and [tuple(r) for r in counts.collect()] == [(1, 4, 2, 2)]
    assert cells.filter(F.col("value") == "old").count() == 9
    with pytest.raises(ValueError):
        write_range(cells, str(tmp_path / "c"), ranges, mode="append")


def test_every_place_has_one_ancestor_in_a_cover(spark):
    rng = random.Random(3)
    spots = [0, 1, 15, 16, 17, 255, 256, 300, 4095, 4096, 70_000]
    spans = [(i, lo, None if i % 4 == 0 else lo + rng.choice([1, 2, 15, 16, 17, 200, 256, 5000, 70_000])) for i, lo in enumerate(rng.choice([*spots, rng.randrange(70_000)]) for _ in range(120))]
    spans += [(200, None, None), (201, None, 5), (202, 1 << 41, None), (203, 0, 1 << 50)]
    places = sorted({p + d for p in [*spots, 65_536, 1_000_000, 1 << 41] for d in (-1, 0, 1) if p + d >= 0} | {rng.randrange(150_000) for _ in range(40)})
    df = spark.createDataFrame(spans, "i int, a long, b long").withColumn("n", F.explode(cover(F.col("a"), F.col("b"), 1)))
    assert df.groupBy("i").count().agg(F.max("count")).first()[0] <= 2 * 15 * intervals.LEVELS
    asked = df.crossJoin(spark.createDataFrame([(p,) for p in places], "p long")).filter(ancestor(F.col("p"), 1, F.col("n.level")) == F.col("n.node"))
    got = {(r.i, r.p): r["count"] for r in asked.groupBy("i", "p").count().collect()}
    beyond = intervals.LAST_TILE  # places beyond the last tile count as in it
    want = {(i, p): 1 for i, a, b in spans for p in places if min(p, beyond) >= min(a or 0, beyond) and (b is None or min(p, beyond) <= min(b - 1, beyond))}
    assert got == want


def test_open_rules_of_a_hot_sheet_are_spread(spark):
    cells = spark.range(400_000).selectExpr("7L AS sheet_id", "id * 5 AS row", "CAST(id % 40 AS INT) AS col", "'x' AS value")
    rules = spark.range(10_000).selectExpr("id AS rule_idx", "7L AS sheet_id", "IF(id % 3 = 0, 0, pmod(hash(id), 2000000)) AS r0", "CAST(NULL AS LONG) AS r1", "CAST(NULL AS INT) AS c0", "CAST(NULL AS INT) AS c1")
    spark.sparkContext.setJobGroup("planning", "ranges")
    cells_in_ranges(cells, rules)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("planning")
    spark.sparkContext._jsc.sc().clearJobGroup()
    filed = intervals._filed(rules, "sheet_id", ("rule_idx",))
    keys = list(intervals._KEYS)
    on_rules = filed.select(*[F.expr(c).alias(k) for k, c in intervals._KEYS.items()]).groupBy(*keys).agg(F.count("*").alias("rules"))
    work = intervals._looked_up(cells, filed).groupBy(*keys).agg(F.count("*").alias("cells")).join(on_rules, keys)
    pairs = [r.cells * r.rules for r in work.collect()]
    want = spark.range(400_000).selectExpr("id * 5 AS row").count() * (10_000 // 3) + 0
    assert sum(pairs) > want and len(pairs) > 100 and max(pairs) < 0.1 * sum(pairs)
    # A rule is filed at some nodes per level, not at all its tiles.
    assert filed.count() < 10_000 * 150


def test_cells_are_not_repeated_for_levels(spark, sheet):
    cells, ranges = spark.createDataFrame(sheet[0], CELL), spark.createDataFrame(sheet[1], RANGE)
    inside, rest = split_by_ranges(cells, ranges)
    for found in (cells_in_ranges(cells, ranges), inside, rest):
        plan = found._jdf.queryExecution().executedPlan().toString().splitlines()
        by_level = [line for line in plan if "Generate explode(_used" in line]
        # Only tiles look at the levels; a cell has one row up to the join on its tile.
        assert by_level and all("_tile_row" in line and "value" not in line for line in by_level)


def test_split_keeps_cells_without_a_place(spark):
    cells = spark.createDataFrame([(1, None, 0, "a"), (1, 0, None, "b"), (None, 0, 0, "c"), (1, 5, 5, "d"), (1, 5, 5, "d")], CELL)
    inside, rest = split_by_ranges(cells, spark.createDataFrame([(0, 1, None, None, None, None), (1, 1, 2000, 3000, 0, 40), (2, 1, 0, 9, 0, 9)], RANGE))
    assert sorted(r.value for r in inside.collect()) == ["d", "d"]
    assert sorted(r.value for r in rest.collect()) == ["a", "b", "c"]


def test_conditions_join_the_cells_once(spark):
    import __spark_entry__ as entry

    seen = []

    def counted(df):
        seen.append(df._jdf.queryExecution().executedPlan().toString())
        return cut(df)

    from deskmill.operators import filters

    cut, filters.durable_cut = filters.durable_cut, counted
    try:
        rest = entry.queries()["f8_cell_conditions"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    finally:
        filters.durable_cut = cut
    assert len(seen) == 1 and seen[0].count("_row_key") and "lineitem" not in rest


def test_conditions_do_not_repeat_cells_for_levels(spark, monkeypatch):
    import __spark_entry__ as entry
    from deskmill.operators import filters

    seen = []
    cut = filters.durable_cut
    monkeypatch.setattr(filters, "durable_cut", lambda df: seen.append(df._jdf.queryExecution().executedPlan().toString()) or cut(df))
    entry.queries()["f8_cell_conditions"](spark, "/root/testdata/sf0.001")
    by_level = [line for line in seen[0].splitlines() if "Generate explode(_used" in line]
    assert by_level and all("_tile_row" in line and "value" not in line for line in by_level)


def test_counts_of_a_write_do_not_compute_the_cells_again(spark):
    import __spark_entry__ as entry

    counts = entry.queries()["s4_write_counts"](spark, "/root/testdata/sf0.001")
    assert "lineitem" not in counts._jdf.queryExecution().executedPlan().toString()


def test_ranges_on_sheets_of_all_sizes(spark):
    # Sheets of one tile, of a few, of just more than those filed at their tiles, of a far corner, and one with a cell without a row.
    rng = random.Random(8)
    tops = {1: (700, 9), 2: (4000, 40), 3: (2000, 200), 4: (16_384, 10), 5: (17_000, 40), 6: (300, 7)}
    cells = [(s, rng.randrange(rows), rng.randrange(cols), None) for s, (rows, cols) in tops.items() for _ in range(60)]
    cells += [(7, 5_000_000 + r, 1600 + c, None) for r in (0, 1, 1030) for c in (0, 20)] + [(8, 1023, 15, None), (8, 1024, 16, None)]
    cells = [(s, r, c, f"{i}") for i, (s, r, c, _) in enumerate(cells)]

    def bound(low, size):
        return rng.choice([None, None, low, low + rng.randrange(1, size)])

    ranges = []
    for i in range(240):
        s = rng.choice([*tops, *tops, 7, 8, 9])
        r0, c0 = rng.choice([None, 0, 5, 1023, 1024, 3000]), rng.choice([None, 0, 3, 15, 16, 30])
        ranges.append((i, s, r0, bound((r0 or 0) + 1, rng.choice([50, 3000, 6_000_000])), c0, bound((c0 or 0) + 1, rng.choice([9, 60, 2000]))))
    odd = [(6, None, 0, "no row")]
    got = cells_in_ranges(spark.createDataFrame(cells + odd, CELL), spark.createDataFrame(ranges, RANGE)).collect()
    want = sorted((c[3], g[0]) for c in cells for g in ranges if holds(c, g))
    assert sorted((r.value, r.rule_idx) for r in got if r.value != "no row") == want
    assert len({rule for _, rule in want}) > 50
    # A cell without a row lies in ranges that are open to both ends of the rows.
    everywhere = [g[0] for g in ranges if g[1] == 6 and g[2] is g[3] is None and not g[4] and (g[5] is None or g[5] > 0)]
    assert everywhere and sorted(r.rule_idx for r in got if r.value == "no row") == everywhere


def _records_shuffled(node):
    """What each exchange of a plan that has run has written."""
    kind = node.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return _records_shuffled(node.executedPlan())
    if kind.endswith("QueryStageExec"):
        return _records_shuffled(node.plan())
    own = [node.metrics().apply("shuffleRecordsWritten").value()] if kind == "ShuffleExchangeExec" else []
    return own + [n for i in range(node.children().size()) for n in _records_shuffled(node.children().apply(i))]


def test_open_ranges_of_small_sheets_are_not_copied(spark):
    cells = spark.range(3000).selectExpr("id % 1000 AS sheet_id", "id % 3 AS row", "0 AS col", "'x' AS value")
    rules = spark.range(1000).selectExpr("id AS rule_idx", "id AS sheet_id", "1L AS r0", "CAST(NULL AS LONG) AS r1", "0 AS c0", "CAST(NULL AS INT) AS c1")
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "-1")
    try:
        found = cells_in_ranges(cells, rules)
        assert len(found.collect()) == 2000
    finally:
        for name in names:
            spark.conf.unset(name)
    written = _records_shuffled(found._jdf.queryExecution().executedPlan())
    assert max(written) == 3000 and sum(written) <= 3000 + 3000 + 2 * 1000
