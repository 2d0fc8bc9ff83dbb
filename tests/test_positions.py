"""Pages by position, exact percentiles, and the text of odd mark-up."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from deskmill.functions.text import visible_text
from deskmill.operators import paging, percentiles


@pytest.mark.parametrize("kind", ["long", "string"])
def test_positions_are_those_of_the_sorted_keys(spark, monkeypatch, kind):
    monkeypatch.setattr(paging, "RANGE_ROWS", 50)
    df = spark.range(0, 60_000, 3).withColumn("k", F.col("id").cast(kind)).withColumn("note", F.col("id") % 7)
    df = df.unionByName(spark.createDataFrame([(None, None, 1)], f"id long, k {kind}, note long"))
    keys = sorted(r.k for r in df.collect() if r.k is not None)
    for start, n in ((1, 5), (9_999, 3), (19_990, 30), (20_000, 1), (20_001, 5), (12, 700), (19_500, 600), (5, 0)):
        page = paging.page_positions(df, "k", start, n)
        assert [r.k for r in page.collect()] == keys[start - 1 : start - 1 + n]
        plan = page._jdf.queryExecution().executedPlan().toString()
        assert "Offset" not in plan and page.columns == df.columns
    assert paging.page_positions(df.limit(0), "k", 1, 5).count() == 0
    assert [paging.key_at(df, "k", p) for p in (1, 777, 20_000, 20_001)] == [keys[0], keys[776], keys[-1], None]


def test_a_position_is_found_by_counts_of_ranges(spark, monkeypatch):
    monkeypatch.setattr(paging, "RANGE_ROWS", 1000)
    sorted_rows = []
    real = paging._borders
    monkeypatch.setattr(paging, "_borders", lambda rows, key: sorted_rows.append(rows.count()) or real(rows, key))
    assert paging.key_at(spark.range(200_000), "id", 123_457) == 123_456
    # Each level looks at a small part of the one before.
    assert sorted_rows[0] == 200_000 and len(sorted_rows) <= 3 and sorted_rows[1] < 0.1 * sorted_rows[0]


@pytest.mark.parametrize("seed", [1, 2])
def test_percentiles_are_exact(spark, seed):
    draw = np.random.default_rng(seed)
    groups = {
        "hot": draw.normal(size=60_000), "ties": draw.integers(0, 4, 30_000) / 1.0, "two values": np.where(draw.random(20_000) < 0.35, 1.0, 9.0), "few": draw.random(7), "one": np.array([3.5]),
        "edge": draw.random(percentiles.SMALL + 1), "skew": np.exp(draw.normal(size=20_000) * 5), "same": np.full(5000, -0.25),
    }
    rows = [(g, float(v)) for g, values in groups.items() for v in values] + [("hot", None), (None, 1.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    fractions = [0.0, 0.001, 0.35, 0.5, 0.95, 0.9999, 1.0]
    wanted = spark.createDataFrame([(g, f) for g in [*groups, "nobody"] for f in fractions], "g string, fraction double")
    found = percentiles.percentile_points(df, ["g"], "v", wanted)
    got = {(r.g, r.fraction): r.point for r in found.collect()}
    want = {(g, f): float(np.quantile(values, f)) for g, values in groups.items() for f in fractions}
    assert got.keys() == want.keys() and all(np.isclose(got[k], want[k], rtol=1e-12, atol=0) for k in want)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan


PAGES = [
    ("<p title='a>b'>x", "x"),
    ('<p title="a>b" data-x=\'c > "d"\'>x</p>', "x"),
    ("a<style>p > q {", "a"),
    ("a<script>if (a < b) '</p>'</script>b", "ab"),
    ("<script src='x'/>shown", "shown"),
    ("<scripted>shown</scripted>", "shown"),
    ("a <!-- > <p> --> b", "a b"),
    ("a <!-- open <p>b</p>", "a"),
    ("1 < 2 and 3 > 2", "1 < 2 and 3 > 2"),
    ("<p title=\"odd>text</p>", "text"),
    ("text <a href='x", "text"),
    ("<STYLE>.x</STYLE >y</ p>z<?php 1 ?>w<!doctype html>", "yzw"),
    ("<style></script>.x</style>y", "y"),
    ("x<b" + " a='1>2'" * 5000 + ">y", "xy"),
    ("<" * 3000 + "1", "<" * 3000 + "1"),
    ("a <z", "a"),
    ("", ""),
    (None, None),
]


def test_text_of_odd_markup(spark):
    df = spark.createDataFrame([(i, h) for i, (h, _) in enumerate(PAGES)], "i int, html string")
    got = {r.i: r.t for r in df.select("i", visible_text(F.col("html")).alias("t")).collect()}
    assert [got[i] for i in range(len(PAGES))] == [t for _, t in PAGES]


def test_the_scan_of_a_page_is_done_once(spark):
    df = spark.createDataFrame([("x",)], "html string").select(visible_text(F.col("html")).alias("t"))
    assert df._jdf.queryExecution().optimizedPlan().toString().count("<!--") == 1


def test_random_markup_does_not_fail(spark):
    rng = random.Random(6)
    bits = ["<", ">", "'", '"', "</", "<!--", "-->", "script", "style", "<script>", "</script>", "a", " ", "=", "p", "/", "&amp;", "&"]
    pages = ["".join(rng.choice(bits) for _ in range(rng.randrange(60))) for _ in range(2000)]
    df = spark.createDataFrame([(p,) for p in pages], "html string")
    assert df.select(visible_text(F.col("html")).alias("t")).filter("t IS NULL").count() == 0
