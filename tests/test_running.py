"""Chunked ordered computations and percentiles against brute force, with one group holding most rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from deskmill.operators.percentiles import percentile_points
from deskmill.operators.running import CHUNK, Running, by_position, ranged, running
from deskmill.operators.windows import free_busy


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    out = []
    for group, size in (("hot", 400), ("a", 40), ("b", 1)):
        for pos in rng.sample(range(1000), size):
            out.append((group, pos, rng.choice([None, *range(20)])))
    return out


def brute(rows):
    by_group = {}
    for g, p, v in sorted(rows, key=lambda r: (r[0], r[1])):
        by_group.setdefault(g, []).append((p, v))
    want = {}
    for g, items in by_group.items():
        for i, (p, _) in enumerate(items):
            upto = [v for _, v in items[: i + 1] if v is not None]
            before = [v for _, v in items[:i] if v is not None]
            after = [v for _, v in items[i + 1 :] if v is not None]
            want[g, p] = (
                sum(upto) if upto else None,
                max(before) if before else None,
                min(upto) if upto else None,
                items[i - 1][1] if i else None,
                items[i + 1][1] if i + 1 < len(items) else None,
                upto[-1] if upto else None,
                min(after) if after else None,
                len(items),
                items[0][0],
            )
    return want


@pytest.mark.parametrize("chunk", [1, 7, 100, 5000])
def test_all_kinds(spark, rows, chunk):
    df = spark.createDataFrame(rows, "g string, pos long, v long")
    v = F.col("v")
    got = running(
        df,
        ["g"],
        ["pos"],
        by_position("pos", chunk),
        {
            "s": Running("sum", v),
            "mx": Running("max", v, before=True),
            "mn": Running("min", v),
            "lag": Running("lag", v),
            "lead": Running("lead", v),
            "last": Running("last_before", v),
            "nxt": Running("min_after", v),
            "n": Running("group_sum", F.lit(1)),
            "first": Running("group_first", F.col("pos")),
        },
    ).collect()
    assert {(r.g, r.pos): tuple(r)[3:] for r in got} == brute(rows)
    assert len(got) == len(rows)


def test_a_hot_group_is_spread(spark):
    """One group of 400 000 rows ends up in many partitions, none with most of it."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(400_000).select(F.lit("hot").alias("g"), F.col("id").alias("pos"))
        got = running(df, ["g"], ["pos"], by_position("pos"), {"n": Running("sum", F.lit(1))})
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
        assert got.filter(F.col("n") != F.col("pos") + 1).count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(sizes) == 400_000 and len(sizes) >= 4 and max(sizes) < 200_000


def test_a_dense_day_is_spread(spark):
    """A calendar with a third of the events in one day, most of them running when the window begins."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        n = F.col("id")
        start = F.when(n % 3 == 0, F.lit(0)).otherwise(n * 3600)
        events = spark.range(60_000).select(
            F.when(n % 3 == 0, F.lit(0)).otherwise(n % 50).alias("calendar_id"), n.alias("event_id"),
            F.timestamp_seconds(start).alias("start_ts"), F.timestamp_seconds(start + F.when(n % 3 == 0, n + 1).otherwise(60)).alias("end_ts"),
        )
        spread = ranged(events, ["calendar_id"], ["start_ts", "event_id"])
        sizes = [r["count"] for r in spread.filter("start_ts < timestamp_seconds(1)").groupBy(CHUNK).count().collect()]
        assert sum(sizes) == 20_000 and max(sizes) < 12_000
        busy = free_busy(events, F.timestamp_seconds(F.lit(0)), F.timestamp_seconds(F.lit(3600 * 60_000)))
        hot = busy.filter("calendar_id = 0").orderBy("start_ts").first()
        assert hot.n_events == 20_000 and busy.agg(F.sum("n_events")).first()[0] == 60_000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_unknown_kind(spark, rows):
    df = spark.createDataFrame(rows, "g string, pos long, v long")
    with pytest.raises(ValueError):
        running(df, ["g"], ["pos"], by_position("pos"), {"x": Running("median", F.col("v"))})


@pytest.mark.parametrize("coalesced", ["true", "false"])
def test_percentiles_are_exact(spark, coalesced, request):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesced)
    request.addfinalizer(lambda: spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true"))
    rng = random.Random(3)
    data = {"hot": [rng.choice([1.0, 2.5, rng.random(), rng.random() * 1e9]) for _ in range(900)], "one": [4.0], "flat": [3.0] * 50}
    df = spark.createDataFrame([(k, v) for k, vs in data.items() for v in [*vs, None]], "k string, v double")
    fractions = [0.0, 0.25, 0.5, 0.95, 1.0]
    wanted = spark.createDataFrame([(k, f) for k in data for f in fractions], "k string, fraction double")
    got = {(r.k, r.fraction): r.point for r in percentile_points(df, ["k"], "v", wanted).collect()}
    assert len(got) == len(data) * len(fractions)
    for (k, f), point in got.items():
        assert point == pytest.approx(np.percentile(data[k], f * 100), rel=1e-12)
