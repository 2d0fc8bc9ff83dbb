"""Min-max near copies against brute force, small blocks, and hot groups."""

import numpy as np
import pytest

from deskmill.llm import minhash, queries
from tests.llm.test_operators import KINDS, ODD, SMALL, rows_of, texts_of


def sets_of(rows, size=5):
    found = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        n = min(size, len(words))
        found.append({tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set())
    return found


def brute_force(rows, percent):
    """Size of the set and the smallest key reached, of each row."""
    sets = sets_of(rows)
    group = list(range(len(rows)))
    near = 0
    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                near += a != sets[j]
                if group[i] != group[j]:
                    group = [group[j] if g == group[i] else g for g in group]
    least = {g: min((k for (k, _), h in zip(rows, group, strict=True) if h == g and k is not None), default=None) for g in set(group)}
    return sorted([(k, len(s), least[g] if s else k) for (k, _), s, g in zip(rows, sets, group, strict=True)], key=repr), near


def edited(docs, count=60):
    """Rows, and for some of them rows with words replaced: at similarities on both sides of 0.8 and 0.85."""
    rows = texts_of(docs)
    made = []
    for i, (_, text) in enumerate([r for r in rows if len((r[1] or "").split()) > 60][:count]):
        words = text.split()
        places = range(3, len(words), max(6, len(words) // (1 + i % 8)))
        made.append((100_000 + i, " ".join(f"new{i}x{p}" if p in places else w for p, w in enumerate(words))))
    return rows + made


@pytest.mark.parametrize(("percent", "nodes"), [(85, 1024), (85, 5), (80, 7), (100, 3)])
def test_components_are_those_of_brute_force(spark, monkeypatch, percent, nodes):
    queries.ready(spark)
    monkeypatch.setattr(minhash, "BLOCK_NODES", nodes)
    rows = edited(spark.read.parquet(f"{SMALL}/documents.parquet"))
    want, near = brute_force(rows, percent)
    assert near > 20 or percent == 100
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), percent=percent)
    assert rows_of(found, "doc_id", "n_shingles", "component_id") == want


def family(size):
    """Copies of one text with some words of their own each: of many pairs some are links and others are not."""
    draw = np.random.default_rng(size)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(size):
        words = list(base)
        for p in draw.integers(0, 150, draw.integers(0, 5)):
            words[p] = f"x{draw.integers(9)}"
        rows.append((i, " ".join(words)))
    return rows


@pytest.mark.parametrize("nodes", [1024, 16])
def test_a_dense_family(spark, monkeypatch, nodes):
    queries.ready(spark)
    monkeypatch.setattr(minhash, "BLOCK_NODES", nodes)
    rows = family(250)
    want, near = brute_force(rows, 85)
    assert near > 1000
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(minhash.near_duplicates(df), "doc_id", "n_shingles", "component_id") == want
    # A pair of nodes never becomes a row: links are a forest for each block and each two blocks.
    links = []
    monkeypatch.setattr(minhash, "similar_links", lambda *a, real=minhash.similar_links: links.append(real(*a).count()) or real(*a))
    minhash.near_duplicates(df).count()
    assert links[0] <= 250 + (250 if nodes > 250 else 16 * 17 // 2 * 32)


def test_odd_rows(spark):
    queries.ready(spark)
    long = "  ".join(f"w{i % 977}" for i in range(40_000))
    rows = [*ODD, (7, "Same WORDS " * 300, None, "b", 0, None, 1, None), (9, long, "en", "a", 0, "k", 1, "s"), (8, long.upper(), "en", "a", 0, "k", 1, "s"), (10, "x" * 70_000, "de", "a", 1, "k", 1, "s")]
    odd = spark.createDataFrame(rows, KINDS).selectExpr("*", "1 AS node", "text AS component", "2 AS bands", "3 AS cluster")
    found = minhash.near_duplicates(odd)
    assert rows_of(found, "doc_id", "n_shingles", "component_id") == brute_force(texts_of(odd), 85)[0]
    assert found.filter("component IS NULL AND n_shingles > 0").count() == 0
    assert minhash.near_duplicates(odd.limit(0)).count() == 0


def test_a_third_of_the_rows_are_copies(spark):
    queries.ready(spark)
    rows = family(40) + [(1000 + i, "the same text over and over again") for i in range(400)] + [(None, "the same text over and over again"), (None, None)]
    want, _ = brute_force(rows, 85)
    assert rows_of(minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")), "doc_id", "n_shingles", "component_id") == want


def test_groups_of_another_kind_are_candidates(spark, monkeypatch):
    queries.ready(spark)
    rows = family(30)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    # Without bands only the groups given can name candidates.
    monkeypatch.setattr(minhash.Bands, "of", lambda self, found: np.zeros(0, dtype=np.uint64))
    groups = df.selectExpr("xxhash64(text) AS text_hash", "1L AS group")
    assert rows_of(minhash.near_duplicates(df, also=groups), "doc_id", "n_shingles", "component_id") == brute_force(rows, 85)[0]


def test_both_ends_of_a_permutation_estimate_the_similarity():
    draw = np.random.default_rng(5)
    bands = minhash.Bands(85)
    assert bands.permutations == bands.rows * bands.bands // 2
    off = []
    for _ in range(40):
        a = draw.integers(0, 2**63, 300, dtype=np.uint64)
        b = np.concatenate([a[:200], draw.integers(0, 2**63, 100, dtype=np.uint64)])
        off.append((bands.signature(a) == bands.signature(b)).mean() - 200 / 400)
        assert (bands.signature(a)[: bands.permutations] <= bands.signature(a)[bands.permutations :]).all()
    assert abs(np.mean(off)) < 0.03
    for percent in (80, 85, 95):
        made = minhash.Bands(percent)
        assert (1 - (percent / 100) ** made.rows) ** made.bands <= minhash.MISSED
