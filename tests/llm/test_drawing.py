"""Importance resampling and fill-in-middle against brute force, and odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from deskmill.llm import fill_in_middle, importance, queries
from deskmill.llm.common import table
from tests.llm.test_operators import KINDS, ODD, SMALL, rows_of, texts_of
from tests.oracle import connect, difference


def features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return len(words), Counter(" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1))


def brute_resample(rows, target, percent, least_words):
    def bucket(feature):
        return zlib.crc32(feature.encode()) % 10000

    split = [(k, *features(t)) for k, t in rows]
    s, t = Counter(), Counter()
    for _, _, found in split:
        for f, n in found.items():
            s[bucket(f)] += n
    for text in target:
        for f, n in features(text)[1].items():
            t[bucket(f)] += n
    all_s, all_t = sum(s.values()), sum(t.values())
    scored = []
    for key, words, found in split:
        gain = {f: math.floor(1000 * math.log((t[bucket(f)] + 1) * (all_s + 10000) / ((s[bucket(f)] + 1) * (all_t + 10000)))) for f in found}
        weight = sum(gain[f] * n for f, n in found.items())
        h = int(hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        scored.append((key, words, sum(found.values()), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted([r for r in scored if r[1] >= least_words], key=lambda r: (-r[4], r[0] is None, r[0]))
    ranks = {}
    for place, r in enumerate(able[: percent * len(able) // 100]):
        ranks.setdefault(r, []).append(place + 1)
    return sorted([(r[0], *r[2:], ranks[r].pop() if ranks.get(r) else None) for r in scored], key=repr)


COLUMNS = ("doc_id", "n_features", "weight", "score", "rank")


def test_the_draw_is_that_of_brute_force(spark):
    queries.ready(spark)
    rows, target = texts_of(table(spark, SMALL, "documents")), [r.text for r in table(spark, SMALL, "benchmark").collect()]
    want = brute_resample(rows, target, 5, 20)
    assert rows_of(queries.op11_importance_resampling(spark, SMALL), *COLUMNS) == want and sum(r[-1] is not None for r in want) > 3


def test_draws_of_odd_rows(spark, monkeypatch):
    queries.ready(spark)
    monkeypatch.setattr(importance, "SLICE", 7)
    odd = spark.createDataFrame([(*r, 1, 2) for r in [*ODD, (8, "Same WORDS-été 12", None, "b", 0, None, 1, None)]], f"{KINDS}, rank int, weight int")
    target = spark.createDataFrame([("same words",), (None,), ("été",)], "text string")
    found = importance.resample(odd, target, percent=80, least_words=2)
    assert rows_of(found, *COLUMNS) == brute_resample(texts_of(odd), ["same words", None, "été"], 80, 2)
    # A table that is one text, over and over: numbered one after the other.
    same = spark.createDataFrame([(1, "same words " * 20)] * 300, "doc_id long, text string")
    ranks = sorted(r.rank for r in importance.resample(same, target.limit(0), percent=50).collect() if r.rank)
    assert ranks == list(range(1, 151))
    assert importance.resample(odd.limit(0), target).count() == 0


def test_slots_hold_equal_occurrences_only():
    draw = np.random.default_rng(1)
    values = draw.integers(0, 50, 2000).astype(np.uint64)
    assert importance.xxh64_of_numbers(values).tolist() == [xxhash.xxh64_intdigest(int(v).to_bytes(8, "little")) for v in values]
    # All keys alike: only the comparison tells the values apart.
    for keys in (importance.xxh64_of_numbers(values), np.zeros(2000, dtype=np.uint64), np.full(2000, 2**64 - 1, dtype=np.uint64)):
        slots, owner = importance.intern(keys, lambda a, b: values[a] == values[b])
        assert len({(int(s), int(v)) for s, v in zip(slots, values, strict=True)}) == 50 == len(set(slots.tolist())) == (owner >= 0).sum()
    assert len(importance.intern(np.zeros(0, dtype=np.uint64), None)[0]) == 0


@pytest.mark.parametrize("length", [1, 64, 65, 4097])
def test_checksums_of_joined_bytes(length):
    tail = random.Random(length).randbytes(length)
    crc = importance._shifted(importance._crc_shift(length)[None], np.zeros(1, dtype=np.int64), np.array([zlib.crc32(b"head")], dtype=np.uint32))
    assert int(crc[0]) ^ zlib.crc32(tail) == zlib.crc32(b"head" + tail)


def test_units_are_code_points():
    draw = random.Random(1)
    texts = ["".join(draw.choice("aé日\U0001f600 \n\0") for _ in range(draw.randrange(40))) for _ in range(500)] + ["", "a" * 7, "a" * 8, "é" * 4, "日" * 30_000]
    units = fill_in_middle.Units([t.encode() for t in texts])
    assert units.counts().tolist() == list(map(len, texts))
    for _ in range(10):
        cuts = np.array([draw.choice([0, len(t), draw.randint(0, len(t))]) for t in texts])
        assert units.bytes_before(cuts).tolist() == [len(t[:k].encode()) for t, k in zip(texts, cuts, strict=True)]
    assert fill_in_middle.Units([]).counts().tolist() == []


def test_texts_are_rebuilt(spark):
    queries.ready(spark)
    texts = ["<P>", "a<S", ">b<", "<M", "M>", "<<P", "été <S> x", "日本語" * 50, "x" * 100_000]
    odd = spark.createDataFrame([*ODD, *[(10 + i + 100 * j, t, "en", "s", 0, "k", 1, "s") for i, t in enumerate(texts) for j in range(20)]], KINDS).selectExpr("*", "1 AS n", "text AS output", "2 AS form")
    found = fill_in_middle.fill_in_middle(odd, changed=100)
    made = found.withColumn("back", fill_in_middle.restored(found["output"], found["form"])).collect()
    assert sorted(((r.doc_id, r.back) for r in made), key=repr) == sorted(((k, t or "") for k, t in texts_of(odd)), key=repr)
    assert {r.form for r in made} == {"plain", "psm", "spm"}
    for r in made:
        text = r.back
        if text == "" or any(m in text for m in ("<P>", "<S>", "<M>")):
            assert r.form == "plain" and r.output == text and r.prefix_chars is r.middle_chars is None and r.n == len(text)
        else:
            prefix, middle, suffix = text[: r.prefix_chars], text[r.prefix_chars :][: r.middle_chars], text[r.prefix_chars + r.middle_chars :]
            assert r.output == {"psm": f"<P>{prefix}<S>{suffix}<M>{middle}", "spm": f"<S>{suffix}<P>{prefix}<M>{middle}"}[r.form]
    assert fill_in_middle.fill_in_middle(odd.limit(0)).count() == 0
    for marks in (("a", "a", "b"), ("ab", "bc", "d"), ("aa", "b", "c"), ("", "b", "c"), ("xax", "a", "c")):
        with pytest.raises(ValueError):
            fill_in_middle.fill_in_middle(odd, marks=marks)


def test_fill_in_middle_agrees_with_sql(spark):
    assert difference(spark, connect(SMALL), SMALL, "op12_fill_in_middle") is None
