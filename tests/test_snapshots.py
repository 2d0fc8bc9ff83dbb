"""Differences of snapshots, batches with repeated keys, grants as bits, late runs of a stream."""

import datetime as dt
import random
import re

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from deskmill.operators import joins, snapshots
from deskmill.session import configure
from deskmill.streaming.buckets import land, read_buckets, stream_buckets, versions

ROW = "id long, a string, b int"


def differences(old, new):
    found = []
    for key in old.keys() | new.keys():
        if key not in new or key not in old:
            found.append((key, "removed" if key in old else "added", None, None, None))
        else:
            text = lambda v: None if v is None else str(v)
            found += [(key, "changed", c, text(x), text(y)) for c, x, y in zip("ab", old[key], new[key], strict=True) if x != y]
    return sorted(found, key=repr)


@pytest.fixture(scope="module")
def pair(spark):
    rng = random.Random(2)
    old = {i: (rng.choice(["x", None, "y"]), rng.choice([None, 1, 2])) for i in range(3000)}
    new = {i + (100_000 if rng.random() < 0.01 else 0): (rng.choice(["x", None]), v[1]) if rng.random() < 0.02 else v for i, v in old.items()}
    # Swapped between two columns, and null against empty.
    new |= {1: (None, 1), 2: ("", None)}
    old |= {1: ("1", None), 2: (None, None)}
    frames = [spark.createDataFrame([(k, *v) for k, v in side.items()], ROW) for side in (old, new)]
    return old, new, frames


def rows_of(df):
    return sorted(map(tuple, df.select("id", "kind", "field", "old", "new").collect()), key=repr)


def test_changes_are_those_of_all_rows(spark, pair):
    old, new, frames = pair
    want = differences(old, new)
    assert {k for _, k, *_ in want} == {"added", "removed", "changed"}
    assert rows_of(snapshots.snapshot_changes(*frames, "id", ["a", "b"])) == want
    assert snapshots.snapshot_changes(frames[0], frames[0], "id", ["a", "b"]).count() == 0
    assert rows_of(snapshots.snapshot_changes(frames[0].limit(0), frames[0].limit(0), "id", ["a", "b"])) == []


def test_written_snapshots_are_read_where_they_differ(spark, pair, tmp_path):
    old, new, frames = pair
    paths = [snapshots.write_snapshot(df, f"{tmp_path}/{i}", "id") for i, df in enumerate(frames)]
    assert rows_of(snapshots.changes_between(spark, *paths, "id")) == differences(old, new)
    one = frames[0].withColumn("b", F.when(F.col("id") == 77, 9).otherwise(F.col("b")))
    third = snapshots.write_snapshot(one, f"{tmp_path}/third", "id")
    leaves = snapshots.differing_leaves(spark, paths[0], third).collect()
    assert len(leaves) == 1
    found = snapshots.changes_between(spark, paths[0], third, "id")
    plan = found._jdf.queryExecution().executedPlan().toString()
    # Both sides read the folder of one node, of LEAVES / FANOUT.
    assert len(re.findall(r"PartitionFilters: \[[^\]]*_node#\d+ = ", plan)) == 2
    assert rows_of(found) == [(77, "changed", "b", str(old[77][1]) if old[77][1] is not None else None, "9")]
    assert rows_of(snapshots.changes_between(spark, paths[0], paths[0], "id")) == []


def test_a_repeated_key_is_an_error_where_it_counts(spark, pair):
    _, _, frames = pair
    twice = frames[0].unionByName(frames[0].filter("id = 5"))
    with pytest.raises(PySparkException, match="several rows of id 5"):
        snapshots.snapshot_changes(frames[0], twice, "id", ["a", "b"]).collect()


def test_repeated_updates_are_reduced_or_refused(spark):
    base = spark.createDataFrame([(1, "e1", "a", "b"), (2, "e2", "c", "d"), (3, None, "e", "f")], "id long, etag string, x string, y string")
    updates = spark.createDataFrame([(1, "n1", None, 1), (1, "n2", None, 2), (2, None, "m", 1), (3, "z", None, 1), (9, "z", None, 1)], "id long, x string, y string, v int")
    got = joins.masked_batch_update(base, updates, "id", "etag", ["x", "y"], latest="v")
    assert sorted(map(tuple, got.collect())) == [(1, "e1", "n2", None, True), (2, "e2", None, "m", True), (3, None, "e", "f", False)]
    with pytest.raises(PySparkException, match="several updates of id 1"):
        joins.masked_batch_update(base, updates, "id", "etag", ["x", "y"]).collect()
    changes = joins.change_report(base, updates, "id", ["x", "y"], latest="v")
    assert sorted(map(tuple, changes.collect())) == [(1, "x", "a", "n2"), (2, "y", "d", "m"), (3, "x", "e", "z")]
    with pytest.raises(PySparkException, match="several updates of id 1"):
        joins.change_report(base, updates, "id", ["x", "y"]).collect()
    spark.sparkContext.setJobGroup("planning", "mask")
    joins.masked_batch_update(base, updates, "id", "etag", ["x", "y"], latest="v")
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("planning")
    spark.sparkContext._jsc.sc().clearJobGroup()


def test_label_changes_of_one_item_are_put_together(spark):
    items = spark.createDataFrame([(1, ["a", "b"]), (2, None)], "id long, labels array<string>")
    changes = spark.createDataFrame([(1, ["c"], None), (1, ["d"], ["a", "c"]), (2, None, ["x"])], "id long, add array<string>, remove array<string>")
    assert sorted((r.id, r.labels) for r in joins.apply_label_changes(items, changes).collect()) == [(1, ["b", "d"]), (2, [])]


def test_grants_as_bits(spark):
    rng = random.Random(8)
    # More scopes than a word has bits, and bits at its ends.
    scopes = [f"s{i:03d}" for i in range(150)]
    hierarchy = {"broad": scopes[60:70], "s001": ["s149", "s063"]}
    grants = [(rng.choice([1, 2, 3, None]), rng.choice([*scopes, "broad", "other", None])) for _ in range(120)]
    required = [(rng.choice([1, 2, 3, 4, None]), rng.choice([*scopes, None])) for _ in range(500)]
    held = {(u, s) for u, g in grants if u is not None and g is not None for s in [g, *hierarchy.get(g, [])]}
    want = sorted({r for r in required if r not in held}, key=repr)
    frames = [spark.createDataFrame(rows, "user long, scope string") for rows in (grants, required)]
    found = joins.missing_scopes(*frames, hierarchy)
    assert sorted(map(tuple, found.collect()), key=repr) == want and 0 < len(want) < len(set(required))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" not in plan
    assert joins.missing_scopes(frames[0], frames[1].limit(0)).count() == 0


RUN = "ts timestamp_ntz, user_id long, failed boolean"


def runs_of(rng, day, n, users=400):
    start = dt.datetime(2024, 1, 1) + dt.timedelta(days=day)
    return [(start + dt.timedelta(seconds=rng.randrange(86_400)), rng.randrange(users), rng.random() < 0.1) for _ in range(n)]


def expected(runs, days):
    table = {}
    for ts, user, failed in runs:
        first = dt.datetime(2024, 1, 1) + dt.timedelta(days=(ts - dt.datetime(2024, 1, 1)).days // days * days)
        n, f, users = table.setdefault(first, [0, 0, set()])
        table[first] = [n + 1, f + failed, users | {user}]
    return table


def check(found, runs, days):
    want = expected(runs, days)
    got = {r.start_time: r for r in found.collect()}
    first, last = min(want), max(want)
    assert got.keys() == {first + dt.timedelta(days=i) for i in range(0, (last - first).days + 1, days)}
    for start, r in got.items():
        n, f, users = want.get(start, [0, 0, set()])
        assert (r.total_executions, r.failed_executions) == (n, f) and r.end_time == start + dt.timedelta(days=days)
        assert abs(r.active_users - len(users)) <= 0.03 * len(users)


def test_late_landings_lose_nothing(spark, tmp_path):
    configure(spark)
    rng = random.Random(1)
    # The newest days land first, a day lies weeks back, and one has no run at all.
    landings = [runs_of(rng, 20, 900) + runs_of(rng, 22, 300), runs_of(rng, 3, 800), runs_of(rng, 20, 700, 5000), runs_of(rng, 2, 50)]
    source, table = f"{tmp_path}/in", f"{tmp_path}/table"
    for landing in landings:
        spark.createDataFrame(landing, RUN).coalesce(1).write.mode("append").parquet(source)
        stream_buckets(spark.readStream.schema(RUN).parquet(source), table, f"{tmp_path}/state").awaitTermination()
    runs = [r for landing in landings for r in landing]
    check(read_buckets(spark, table), runs, 1)
    check(read_buckets(spark, table, "WEEKLY"), runs, 7)
    # A batch that is run again gives the same version; old ones go.
    last = versions(spark, table)
    assert len(last) == 2 and last[-1] == 3
    land(spark.createDataFrame(landings[3], RUN), 3, table)
    check(read_buckets(spark, table), runs, 1)
    # Nothing new: no batch, no version.
    stream_buckets(spark.readStream.schema(RUN).parquet(source), table, f"{tmp_path}/state").awaitTermination()
    assert versions(spark, table) == last
    with pytest.raises(ValueError):
        read_buckets(spark, f"{tmp_path}/nothing")
