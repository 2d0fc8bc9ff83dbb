"""Threads, calendars and trees, among them hot calendars, deep chains and cycles."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from deskmill.functions.times import literal_instant
from deskmill.operators import trees, windows

START = dt.datetime(2024, 1, 1)


def test_threads(spark):
    messages = spark.createDataFrame(
        [("t", 0, "a", None, "Plan"), ("t", 1, None, "d", "Re: Plan"), ("t", 20000, "b", "d", "Plan"), ("u", 5, "c", "d", None)],
        "thread_id string, pos long, sender string, date string, subject string",
    )
    got = {(r.thread_id, r.pos): r for r in windows.assemble_threads(messages).collect()}
    assert [got["t", p].message_no for p in (0, 1, 20000)] == [1, 2, 3]
    assert got["t", 1].n_messages == 3 and got["t", 20000].thread_subject == "Plan"
    assert got["t", 0].subject is None and got["t", 1].subject == "Re: Plan" and got["t", 20000].subject is None
    assert got["u", 5].thread_subject == "(no subject)" and got["t", 1].sender == "(unknown sender)"


def merged(entries, tmin, tmax):
    out = {}
    for cal in {e[0] for e in entries}:
        spans = sorted((max(s, tmin), min(e, tmax)) for c, _, s, e in entries if c == cal)
        for s, e in spans:
            if s >= e:
                continue
            if cal in out and out[cal] and s <= out[cal][-1][1]:
                out[cal][-1][1] = max(out[cal][-1][1], e)
                out[cal][-1][2] += 1
            else:
                out.setdefault(cal, []).append([s, e, 1])
    return sorted((c, *span) for c, spans in out.items() for span in spans)


@pytest.mark.parametrize("seed", [1, 2])
def test_free_busy(spark, seed):
    rng = random.Random(seed)
    entries = []
    for i in range(500):
        start = START + dt.timedelta(minutes=rng.randrange(60 * 24 * 40))
        length = rng.choice([0, 15, 60, 600, 60 * 24 * 3])
        entries.append((rng.choice([1, 1, 2, 3]), i, start, start + dt.timedelta(minutes=length)))
    entries.append((4, 900, START + dt.timedelta(days=3), START + dt.timedelta(days=3, hours=1)))
    entries.append((4, 901, START + dt.timedelta(days=3, hours=1), START + dt.timedelta(days=3, hours=2)))
    df = spark.createDataFrame(entries, "calendar_id long, event_id long, start_ts timestamp_ntz, end_ts timestamp_ntz")
    tmin, tmax = START + dt.timedelta(days=2), START + dt.timedelta(days=30)
    lo, hi = (literal_instant(t.isoformat() + "Z") for t in (tmin, tmax))
    everyone = spark.createDataFrame([(c,) for c in (1, 2, 3, 4, 5)], "calendar_id long")
    busy = windows.free_busy(df, lo, hi, calendars=everyone)
    rows = busy.collect()
    want = merged(entries, tmin, tmax)
    assert sorted((r.calendar_id, r.start_ts, r.end_ts, r.n_events) for r in rows if r.start_ts) == want
    assert [r.calendar_id for r in rows if r.start_ts is None] == [5]
    gaps = {}
    for r in windows.free_gaps(busy, lo, hi).collect():
        gaps.setdefault(r.calendar_id, []).append((r.free_from, r.free_to))
    assert gaps[5] == [(tmin, tmax)]
    for cal in (1, 2, 3, 4):
        covered = sorted(gaps.get(cal, []) + [(s, e) for c, s, e, _ in want if c == cal])
        assert covered[0][0] == tmin and covered[-1][1] == tmax
        assert all(a[1] == b[0] for a, b in zip(covered, covered[1:]))


TASK = "id string, parent string, position decimal(20,0), status string, due string"


def task(spark, *rows):
    return spark.createDataFrame(
        [(i, p, pos if pos is None else __import__("decimal").Decimal(pos), s, d) for i, p, pos, s, d in rows], TASK
    )


def test_task_order(spark):
    tasks = task(
        spark,
        ("b", None, 2, None, None), ("a", None, 10, None, None), ("late", None, None, None, None),
        ("b2", "b", 9, None, None), ("b1", "b", 1, None, None), ("b1x", "b1", "99999999999999999999", None, None),
        ("orphan", "gone", 1, None, None), ("c1", "c2", 1, None, None), ("c2", "c1", 1, None, None), ("under", "c1", 1, None, None),
    )
    rows = trees.ordered_tree(tasks).filter("root IS NOT NULL").collect()
    assert [(r.id, r.depth) for r in rows] == [
        ("b", 0), ("b1", 1), ("b1x", 2), ("b2", 1), ("a", 0), ("gone", 0), ("orphan", 1), ("late", 0),
    ]
    assert [r.id for r in rows if r.is_placeholder] == ["gone"]
    assert [(r.place, r.n_below) for r in rows] == [(1, 3), (2, 1), (3, 0), (4, 0), (5, 0), (6, 1), (7, 0), (8, 0)]
    cyclic = {r.id: (r.in_cycle, r.below_cycle, r.cycle_id) for r in trees.task_tree(tasks).filter("root IS NULL").collect()}
    assert cyclic == {"c1": (True, False, "c1"), "c2": (True, False, "c1"), "under": (False, True, "c1")}


def test_rollup(spark):
    tasks = task(
        spark,
        ("r", None, 1, "completed", "2024-03-01"), ("k", "r", 1, "needsAction", "2024-02-01"),
        ("g", "k", 1, "completed", None), ("o", "gone", 1, "needsAction", "2024-05-01"),
    )
    got = {r.root: tuple(r)[1:] for r in trees.task_rollup(tasks).collect()}
    assert got == {"r": (2, 2, 0.666667, "2024-02-01", False), "gone": (1, 1, 0.0, "2024-05-01", True)}


def test_deep_chain_takes_few_rounds(spark, monkeypatch):
    cuts = []
    real = trees.durable_cut
    monkeypatch.setattr(trees, "durable_cut", lambda df: cuts.append(1) or real(df))
    chain = spark.range(100_000).select("id", F.when(F.col("id") > 0, F.col("id") - 1).alias("parent"), F.lit("same").alias("sibling"))
    got = trees.tour(chain)
    # Two walks of 17 rounds; a row holds numbers only, however deep it lies.
    assert len(cuts) <= 40 and dict(got.dtypes).keys() == {"id", "root", "depth", "place", "n_below"} and "string" not in dict(got.dtypes).values()
    assert got.filter("depth <> id OR place <> id + 1 OR n_below <> 99999 - id OR root <> 0").count() == 0 and got.count() == 100_000


def _forest(rng, n):
    """Random parents: trees, some chains, and some cycles with trails that lead to them."""
    parents = {}
    for i in range(n):
        parents[i] = rng.choice([None, rng.randrange(n), rng.randrange(i + 1), max(0, i - 1), max(0, i - 1)])
    parents |= {0: None, n - 1: n - 2, n - 2: n - 3, n - 3: n - 1, n - 4: n - 4, n - 5: n - 1, n - 6: n - 5}
    return parents


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_tours_and_cycles_of_random_links(spark, seed):
    rng = random.Random(seed)
    n = 160
    parents, keys = _forest(rng, n), {i: rng.choice("abc") for i in range(n)}
    children = {}
    for i, p in parents.items():
        children.setdefault(p, []).append(i)
    place, want = 0, {}

    def go(i, root, depth):
        nonlocal place
        place += 1
        own = place
        for c in sorted(children.get(i, []), key=lambda c: (keys[c], c)):
            go(c, root, depth + 1)
        want[i] = (root, depth, own, place - own)

    for top in sorted(children.get(None, []), key=lambda c: (keys[c], c)):
        go(top, top, 0)
    on = {}
    for i in range(n):
        seen, at = [], i
        while at is not None and at not in seen:
            seen.append(at)
            at = parents[at]
        if at is not None:
            ring = seen[seen.index(at) :]
            on[i] = (min(ring), i in ring)
    assert on and want and len(on) + len(want) == n
    nodes = spark.createDataFrame([(i, p, keys[i]) for i, p in parents.items()], "id long, parent long, sibling string")
    got = {r.id: (r.root, r.depth, r.place, r.n_below) for r in trees.tour(nodes).collect()}
    assert got == want | {i: (None,) * 4 for i in on}
    lost = nodes.filter(F.col("id").isin(*on)).select("id", "parent")
    assert {r.id: (r.cycle_id, r.on_cycle) for r in trees.cycles(lost).collect()} == on
    assert trees.cycles(lost.limit(0)).count() == 0 and trees.tour(nodes.limit(0)).count() == 0


def test_a_parent_with_most_nodes(spark):
    nodes = spark.range(20_000).selectExpr("id", "IF(id = 0, NULL, IF(id < 15000, 0, id - 14000)) AS parent", "lpad(id, 9, '0') AS sibling")
    found = trees.tour(nodes)
    assert found.agg(F.count_distinct("place"), F.min("place"), F.max("place")).first() == (20_000, 1, 20_000)
    assert found.filter("id = 0").first().n_below == 19_999 and found.filter("id BETWEEN 1000 AND 5999 AND n_below <> 1").count() == 0


def test_calendars_without_events_are_free_over_the_whole_range(spark):
    queries, small = entry.queries(), "/root/testdata/sf0.001"
    idle = {r.calendar_id for r in queries["w4_free_busy"](spark, small).filter("start_ts IS NULL").collect()}
    free = {r.calendar_id: r for r in queries["w5_free_gaps_all_calendars"](spark, small).collect() if r.calendar_id in idle}
    assert idle and free.keys() == idle
    assert {(r.free_from, r.free_to) for r in free.values()} == {(dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 25, 12))}
