"""The pipeline's operators against brute force, exact round trips and odd rows."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F

from deskmill.llm import blocks, bpe, langid, mixing, pii, quality, queries, simhash, substring_dedup, suffix_dedup, topk, warc
from deskmill.llm.common import WORD, table, word_count
from deskmill.llm.components import components

SMALL = "/root/testdata/sf0.001"
KINDS = "doc_id long, text string, lang string, source string, n_chars long, key string, block long, score string"
ODD = [
    (1, None, "en", "a", 0, "k", 1, "s"),
    (2, "", None, None, 0, None, None, None),
    (None, "no key here", "fr", "a", 11, "k", 1, "s"),
    (3, " \n\t ", "en", "", 4, "k", 1, "s"),
    (4, "same words " * 300, "en", "a", 1, "k", 1, "s"),
    (4, "same words " * 300, "en", "a", 1, "k", 1, "s"),
    (5, "x" * 70_000, "de", "a", 1, "k", 1, "s"),
    (6, "été 'll don't 12345 日本語 \U0001f600   end", "fr", "b", 1, "k", 1, "s"),
]


@pytest.fixture(scope="module")
def odd(spark):
    queries.ready(spark)
    return spark.createDataFrame(ODD, KINDS)


@pytest.fixture(scope="module")
def docs(spark):
    queries.ready(spark)
    return table(spark, SMALL, "documents")


@pytest.fixture(scope="module")
def ranks():
    with open(public_tokenizers.path(queries.RANKS), "rb") as file:
        return bpe.parse_ranks(file.read())


def rows_of(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


def texts_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


@pytest.mark.parametrize("leaf", [1, 3, 50])
def test_joined_halves_are_the_encoding_of_the_whole(ranks, leaf):
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    codec, draw = bpe.Codec(ranks, public_tokenizers.PATTERN, leaf, 4), random.Random(leaf)
    # The last ones are letters and digits in some versions of Unicode only.
    alphabet = ["a", "the", "'", "'re", "s", " ", "  ", "\n", "1", "é", "日", "\U0001f600", "!", " ", "́", "\u088f", "\u0558", "\U00011de0"]
    texts = ["".join(draw.choice(draw.sample(alphabet, draw.choice([2, 15]))) for _ in range(draw.choice([3, 40, 200]))) for _ in range(400)]
    for text in [*texts, "abcdefghij" * 900, "日本" * 900, " " * 3000, "'" * 999, "!#" * 999]:
        ids = codec.encode(text)
        assert ids == own.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()


def test_bpe_of_odd_rows(odd, ranks):
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = bpe.encode(odd, "doc_id", "text", public_tokenizers.path(queries.RANKS), public_tokenizers.PATTERN, leaf=64)
    want = [(k, np.array(own.encode_ordinary(t or ""), dtype="<u4").tobytes(), (t or "").encode()) for k, t, *_ in ODD]
    assert [(k, bytes(i), bytes(d)) for k, i, d in rows_of(found, "doc_id", "ids", "decoded")] == sorted(want, key=repr)


def test_archives_give_back_what_went_in(spark, tmp_path):
    same = "<p>" + "x" * 200
    pages = spark.createDataFrame(
        [(5, "u", same, 0), (3, None, same, 0), (9, "u\r\nWARC-Type: evil", same, 0), (1, "u", None, 0), (2, "u", "short", 0), (4, "u", "short", 0), (None, "u", same, 0), (-7, "é", "é" * 99, 0)],
        "page_id long, url string, html string, payload int",
    )
    found = {r.page_id: r for r in warc.read_archives(spark, warc.write_archives(pages, str(tmp_path / "w"))).collect()}
    assert len(found) == 8 and all(r.error is None for r in found.values())
    assert {k: (r.record_type, r.refers_to) for k, r in found.items() if k != -7} == {
        3: ("response", None), 5: ("revisit", 3), 9: ("revisit", 3), None: ("revisit", 3), 1: ("response", None), 2: ("response", None), 4: ("response", None),
    }
    assert bytes(found[-7].payload) == ("é" * 99).encode() and found[5].payload_bytes == len(same) and found[5].payload is None
    assert all(r.payload_digest == hashlib.sha256(same.encode()).hexdigest() for k, r in found.items() if k in (3, 5, 9, None))
    empty = warc.read_archives(spark, warc.write_archives(pages.limit(0), str(tmp_path / "e")))
    assert empty.count() == 0


def test_broken_archives_give_errors():
    import zstandard

    good = warc.record(1, "u", b"payload", hashlib.sha256(b"payload").hexdigest(), None)
    frame = zstandard.ZstdCompressor().compress
    whole = frame(good) + frame(good.replace(b"payload\r\n", b"pbyload\r\n")) + frame(good[:-3]) + frame(good)
    assert [("error" in r) for r in warc.read_frames(whole)] == [False, True, True, False]
    assert ["error" in r for r in warc.read_frames(frame(good) + frame(good)[:-5])] == [False, True]
    assert ["error" in r for r in warc.read_frames(b"no archive at all")] == [True]


def test_language_of_held_out_texts(spark, docs, odd):
    model = queries.language_model(table(spark, "/root/testdata/sf0.01", "documents"))
    found = langid.with_language(table(spark, "/root/testdata/sf0.01", "documents"), model)
    right = found.filter(queries.held_out()).agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.97
    told = {(r.doc_id, r.text): (r.lang_pred, r.language_score) for r in langid.with_language(odd, model, columns=("lang_pred", "language_score")).collect()}
    assert told[1, None] == told[2, ""] == told[3, " \n\t "] == ("und", 0.0) and len(told) == 7
    assert all(0 <= score <= 1 for _, score in told.values())
    nothing = langid.train(odd.limit(0), ["▁a", "a"])
    assert langid.with_language(odd.select("text"), nothing).filter("lang_pred <> 'und'").count() == 0


def test_forward_sums_all_segmentations():
    pieces = ["a", "ab", "b", "▁", "▁a"]
    shares = np.array([[0.1], [0.2], [0.3], [0.25], [0.15]])

    def brute(word):
        if not word:
            return 1.0
        own = sum(shares[pieces.index(p), 0] * brute(word[len(p) :]) for p in pieces if word.startswith(p))
        return own + langid.UNKNOWN * brute(word[1:])

    for word in ("a", "ab", "abab", "xa"):
        assert np.isclose(langid.word_scores([word], langid.Pieces(pieces), shares)[0, 0], np.log(brute("▁" + word)))


def feistel(key, kind, digits, radix):
    a, b = digits[: len(digits) // 2], digits[len(digits) // 2 :]
    for i in range(pii.ROUNDS):
        noise = hashlib.sha256("|".join([key, f"{kind}{radix}", str(i), f"{len(a)}:{b}"]).encode()).hexdigest()
        a, b = b, "".join(pii.ALPHABET[(int(c, 16) + int(noise[2 * j : 2 * j + 2], 16)) % radix] for j, c in enumerate(a))
    return a + b


def luhn(digits):
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def test_pseudonyms_keep_their_format(spark, odd):
    texts = ["call +1 (743) 555-3824!", "card 4539578763621486 or 4539-5787-6362-1486, not 4539578763621487", "on 1985-03-02, 03/02/1985 not 02.31.1985", "ssn 123-45-6789 not 000-12-3456", "70.23.22.57 not 999.1.1.1", "a.b@c.example.com###", "KEY 9233A8ECF7C5B09FE5949719B6B82BC439E9329B", "v 2.0 of 12 345"]
    out = {r.i: r.text for r in pii.pseudonymise(spark.createDataFrame(list(enumerate(texts)), "i int, text string")).collect()}
    shape = lambda t: re.sub(r"\d", "9", t)
    for i in (0, 1, 2, 3):
        assert shape(out[i]) == shape(texts[i]) and out[i] != texts[i]
    assert feistel(pii.KEY, "phone", "7435553824", 10) == re.sub(r"\D", "", out[0])[1:]
    plain, dashed, kept = re.findall(r"\d[\d-]{15,}", out[1])
    assert plain == dashed.replace("-", "") and luhn(plain) and kept == "4539578763621487"
    assert plain[:-1] == feistel(pii.KEY, "card", "453957876362148", 10)
    iso, slashed, wrong = re.findall(r"\d[\d./-]+", out[2])
    assert iso == "-".join([slashed[6:], slashed[:2], slashed[3:5]]) and wrong == "02.31.1985"
    assert "000-12-3456" in out[3] and "999.1.1.1" in out[4] and "70.23.22.57" not in out[4]
    assert out[5].endswith("@example.invalid###") and re.fullmatch(r"KEY [0-9A-F]{40}", out[6]) and out[6] != texts[6] and out[7] == texts[7]
    assert rows_of(pii.pseudonymise(odd), *odd.columns) == rows_of(odd, *odd.columns)


def test_numbers_are_permuted(spark):
    days = spark.range(189 * 773).select(pii.permuted_number(F.col("id"), pii.DAYS, "k", "date").alias("p"))
    assert tuple(days.agg(F.count_distinct("p"), F.min("p"), F.max("p")).first()) == (146097, 0, 146096)
    digits = spark.range(1000).select(pii.permuted_digits(F.lpad(F.col("id").cast("string"), 3, "0"), 10, "k", "x").alias("p"))
    assert digits.filter("p RLIKE '^[0-9]{3}$'").distinct().count() == 1000


def base_counts(text):
    words = re.findall(WORD, text)
    windows, covered, seen, doubled = Counter(zip(words, words[1:], words[2:], strict=False)), set(), set(), 0
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    for line in text.split("\n"):
        if re.search(WORD, line):
            doubled += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), doubled, len(covered), failed


def test_quality_counts_and_verdicts(spark, docs, odd):
    labels = table(spark, SMALL, "labels")
    for rows in (docs, odd):
        found = quality.rate(rows, labels.filter("quality = 1"))
        counts = rows_of(found, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
        assert counts == sorted([(k, *base_counts(t or "")) for k, t in texts_of(rows)], key=repr)
        assert found.filter("kept <> (NOT base_failed AND score >= -0.4)").count() == 0
    rated = quality.rate(docs, labels.filter("quality = 1")).join(labels, "doc_id").filter("NOT base_failed")
    good, bad = (rated.filter(f"quality = {q}") for q in (1, 0))
    assert good.filter("kept").count() >= 0.98 * good.count() and bad.filter("NOT kept").count() >= 0.9 * bad.count()
    assert quality.rate(odd, labels.limit(0)).filter("score <> 0").count() == 0


def repeats(rows, length):
    data = [(k, (t or "").encode()) for k, t in rows]
    seen = Counter(t[i : i + length] for _, t in data for i in range(len(t) - length + 1))
    for key, text in data:
        gone = bytearray(len(text))
        for i in range(len(text) - length + 1):
            if seen[text[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(text, gone, strict=True) if not g)
        yield key, len(text), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()


def test_the_cover_meets_every_distance():
    assert {(a - b) % suffix_dedup.PERIOD for a in suffix_dedup.COVER for b in suffix_dedup.COVER} == set(range(suffix_dedup.PERIOD))


@pytest.mark.parametrize("block_bytes", [500, 1 << 20])
def test_repeated_bytes(spark, docs, odd, monkeypatch, block_bytes):
    monkeypatch.setattr(blocks.pack, "__defaults__", (block_bytes,))
    passage = "".join(chr(97 + i * i % 26) + str(i) for i in range(150))[:400]
    planted = [(i, f"{i}" * i + passage[i : 260 + i] + f"{i} end" * 9) for i in range(40)] + [(99, passage[:200]), (98, passage[:199]), (97, "ab" * 400)]
    for rows in (docs.limit(60), odd.filter("doc_id <> 5 OR doc_id IS NULL"), spark.createDataFrame(planted, "doc_id long, text string"), docs.limit(0)):
        found = suffix_dedup.remove_repeats(rows, digests=True)
        assert rows_of(found, "doc_id", "n_bytes", "n_removed", "n_spans", "kept") == sorted(repeats(texts_of(rows), 200), key=repr)


def repeated_words(rows, window):
    data, first = [(k, (t or "").encode().split()) for k, t in rows], {}
    order = lambda k: float("inf") if k is None else k
    for key, words in data:
        for i in range(len(words) - window + 1):
            run = tuple(words[i : i + window])
            first[run] = min(first.get(run, float("inf")), order(key))
    for key, words in data:
        gone = set()
        for i in range(len(words) - window + 1):
            if first[tuple(words[i : i + window])] < order(key):
                gone |= set(range(i, i + window))
        yield key, len(words), len(gone), hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest()


@pytest.mark.parametrize("block_bytes", [500, 1 << 20])
def test_repeated_words(docs, odd, monkeypatch, block_bytes):
    monkeypatch.setattr(blocks.pack, "__defaults__", (block_bytes,))
    for rows in (docs, odd, docs.limit(0)):
        found = substring_dedup.remove_repeated_words(rows, digests=True)
        assert rows_of(found, "doc_id", "n_words", "n_removed", "kept") == sorted(repeated_words(texts_of(rows), 13), key=repr)


def thue_morse(size, first, second):
    """Two strings that differ everywhere and that sums of powers modulo 2 to the 64 cannot tell apart."""
    bits = [0]
    while len(bits) < size:
        bits += [1 - b for b in bits]
    return tuple("".join((x, y)[b] for b in bits) for x, y in ((first, second), (second, first)))


def test_structured_strings_stay_apart(spark):
    queries.ready(spark)
    one, other = thue_morse(1024, "a", "b")
    same = [f"w{i}" for i in range(12)]
    rows = spark.createDataFrame([(1, " ".join([one, *same])), (2, " ".join([other, *same]))], "doc_id long, text string")
    found = substring_dedup.remove_repeated_words(rows, digests=True)
    assert rows_of(found, "doc_id", "n_words", "n_removed", "kept") == sorted(repeated_words(texts_of(rows), 13), key=repr)
    assert found.filter("n_removed > 0").count() == 0
    texts = spark.createDataFrame([(1, f"{one} x y {other} x y " * 2), (2, f"{one} x y {other} x y")], "doc_id long, text string")
    rated = quality.rate(texts, spark.createDataFrame([], "doc_id long"))
    assert rows_of(rated, "doc_id", "n_words", "n_repeat_words") == sorted((k, (c := base_counts(t))[0], c[4]) for k, t in texts_of(texts))
    strings = spark.createDataFrame([(1, one), (2, other), (3, one[:512] + "c" + other[:300])], "doc_id long, text string")
    removed = suffix_dedup.remove_repeats(strings, digests=True)
    assert rows_of(removed, "doc_id", "n_bytes", "n_removed", "n_spans", "kept") == sorted(repeats(texts_of(strings), 200), key=repr)


def test_words_that_trade_letters_make_other_windows(spark):
    queries.ready(spark)
    one, other = "x yz w", "x yw z"
    rows = spark.createDataFrame([(1, f"{one} a b c {other} d e f"), (2, "aa ba ba c ab aa ba c")], "doc_id long, text string")
    rated = quality.rate(rows, spark.createDataFrame([], "doc_id long"))
    assert rows_of(rated, "doc_id", "n_words", "n_repeat_words") == [(1, 12, 0), (2, 8, 0)]
    same = " ".join(f"w{i}" for i in range(10))
    texts = spark.createDataFrame([(1, f"{same} {one}"), (2, f"{same} {other}"), (3, f"{same} {one}")], "doc_id long, text string")
    found = substring_dedup.remove_repeated_words(texts, digests=True)
    assert rows_of(found, "doc_id", "n_words", "n_removed", "kept") == sorted(repeated_words(texts_of(texts), 13), key=repr)
    assert rows_of(found, "doc_id", "n_removed") == [(1, 0), (2, 0), (3, 13)]


def test_hashes_of_slices_are_those_of_their_numbers():
    draw = np.random.default_rng(1)
    for values in (draw.integers(0, 256, 70_000, dtype=np.uint8), draw.integers(1, blocks.PRIME, 70_000, dtype=np.uint64)):
        own = blocks.rolling_bytes(values) if values.dtype == np.uint8 else blocks.Rolling(values)
        plus = int(values.dtype == np.uint8)
        for lo, hi in ((0, 0), (0, 9), (65_500, 65_600), (69_900, 70_000)):
            want = sum((int(v) + plus) * pow(blocks._BASE, i, blocks.PRIME) for i, v in enumerate(values[lo:hi])) % blocks.PRIME
            assert int(own.slices(np.array([lo]), np.array([hi]))[0]) == max(1, want)


def test_repeated_vectors_are_dealt_out(spark):
    queries.ready(spark)
    same = spark.range(900).selectExpr("IF(id < 300, 50, id) AS vec_id", "IF(id < 300, array(1D, 2D), array(id / 9D, 1D)) AS embedding")
    packed = topk._packed(same.selectExpr("vec_id AS id", "embedding AS vector"), 9)
    assert max(len(r.ids) // 8 for r in packed.collect()) <= 110


def test_levels_double():
    assert substring_dedup.levels(13, 7) == [7, 13] and substring_dedup.levels(26, 3) == [3, 6, 12, 24, 26]


def test_targets_fill_up_by_weight(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 5), (None, 0), ("é", 400)], "source string, source_size long")
    found = {r.source: r.target for r in mixing.targets(sizes).collect()}
    left = dict(zip(["a", "b", "c", "é", None], [1, 2, 3, 1, 2], strict=True))
    own, want, rest = {r.source: r.source_size for r in sizes.collect()}, {}, 1415.0
    while True:
        level = rest / sum(left.values())
        above = [s for s, w in left.items() if level * w > 3 * own[s]]
        if not above:
            break
        for s in above:
            want[s] = 3.0 * own[s]
            rest -= want[s]
            del left[s]
    want |= {s: level * w for s, w in left.items()}
    assert found.keys() == want.keys() and all(np.isclose(found[s], want[s]) for s in want)


def test_mix_of_odd_rows(odd, docs):
    for rows in (odd, docs, docs.limit(0)):
        found = mixing.mix(rows, "doc_id", word_count(F.col("text")), "source")
        assert rows_of(found, *rows.columns) == rows_of(rows, *rows.columns)
        assert found.filter("mix_times NOT BETWEEN 0 AND 3 OR mix_times IS NULL").count() == 0
        largest = max([r.mix_size for r in found.collect()], default=0)
        for r in found.groupBy("source").agg(F.sum(F.expr("mix_size * mix_times")).alias("taken"), F.first("mix_target").alias("target")).collect():
            assert r.taken <= r.target + 1e-6 and r.target - r.taken <= 2 * largest


def test_best_vectors(spark):
    draw = np.random.default_rng(1)
    made = [(int(i), [float(x) for x in v], "s") for i, v in enumerate(draw.integers(-9, 9, (220, 20)) / 7)]
    made += [(300 + i, made[50][1], "s") for i in range(20)]
    bad = [(None, made[0][1], "s"), (400, None, "s"), (401, [], "s"), (402, [1.0, None] * 10, "s"), (403, [float("nan")] * 20, "s"), (404, [float("inf")] * 20, "s"), (405, [1.0, 2.0], "s"), (450, [3.0, 4.0], "s")]
    vectors = spark.createDataFrame(made + bad, "vec_id long, embedding array<double>, score string")
    found = topk.top_k(vectors, vectors.filter("vec_id % 50 = 0"), candidate_block=40, query_block=3)
    held = [(i, np.floor(256 * np.array(v)).astype(int)) for i, v, _ in made] + [(405, np.array([256, 512])), (450, np.array([768, 1024]))]
    want = []
    for q, v in held:
        if q % 50 == 0:
            best = sorted((-int(v @ w), i) for i, w in held if i != q and len(w) == len(v))[:5]
            want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert rows_of(found, "query_id", "rank", "vec_id", "score") == sorted(want, key=repr)
    assert topk.top_k(vectors.limit(0), vectors.limit(0)).count() == 0


def test_no_matrix_is_broadcast_or_joined(spark):
    # The plan of a table whose packed queries are small enough to be broadcast: each would go there once per block of candidates.
    queries.ready(spark)
    vectors = spark.range(3000).selectExpr("id AS vec_id", "transform(sequence(1, 20), i -> pmod(id * i, 31) / 31D) AS embedding")
    found = topk.top_k(vectors, vectors.filter("vec_id % 50 = 0"), candidate_block=40)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "Join" not in plan
    shares = found.select("query_id", "vec_id").groupBy("query_id").count().collect()
    assert len(shares) == 60 and {r["count"] for r in shares} == {5}


@pytest.mark.parametrize("width", [4, 16, 64])
def test_best_of_a_chunk(monkeypatch, width):
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 70)
    draw = np.random.default_rng(width)
    near = draw.integers(-60, 60, (6, 40))
    kinds = {
        "spread": draw.integers(-60, 60, (900, 40)),
        "grouped": near[draw.integers(0, 6, 900)] + draw.integers(-2, 3, (900, 40)),
        "few": near[draw.integers(0, 6, 900)] // 40,
        "same": np.full((900, 40), 7),
        "rising": draw.integers(0, 9, (900, 40)) * np.arange(900)[:, None],
        "zero": np.zeros((900, 40), int),
        "sizes": draw.integers(-60, 60, (900, 40)) * (1 << draw.choice([0, 0, 0, 9, 18, 22, 30], 900))[:, None],
        "one dimension": draw.integers(-9, 9, (900, 1)),
    }
    for name, made in kinds.items():
        rows = made.astype(np.float64)
        ids = draw.permutation(900).astype(np.int64) // (2 if name == "few" else 1)
        asked = np.concatenate([np.arange(0, 900, 30), [0, 0]])
        order = draw.permutation(rows.shape[1])
        pieces = [(ids[at : at + 333], rows[at : at + 333].T) for at in range(0, 900, 333)]
        best = topk.search(rows[asked][:, order], ids[asked], topk.chunk_of(pieces, order, width), 5, width)
        exact = np.array([[int(x) for x in row] for row in made], dtype=object)
        for place, query in enumerate(asked):
            scores = exact @ exact[query]
            want = sorted((-max(topk.LONG * -1 - 1, min(topk.LONG, s)), i) for s, i in zip(scores, ids.tolist(), strict=True) if i != ids[query])[:5]
            assert list(zip((-best.scores[place]).tolist(), best.ids[place].tolist(), strict=True)) == want, name
    empty = topk.search(rows[:3], ids[:3], topk.chunk_of([(ids[:1], rows[:1].T)], np.arange(1), width), 5, width)
    assert empty.have.tolist() == [0, 1, 1]


def test_packed_blocks_hold_every_row(spark):
    queries.ready(spark)
    rows = spark.range(5000).selectExpr("id", "IF(id % 7 = 0, array(id * 1e5, 1D, 2D), array(id % 100D, -3D)) AS vector")
    held = {}
    for row in topk._packed(rows, 125, 40).collect():
        ids, matrix = topk._unpacked(row.asDict())
        assert len(ids) <= 40 and matrix.shape == (row.dims, len(ids))
        assert not held.keys() & set(ids.tolist())
        held |= dict(zip(ids.tolist(), matrix.T.tolist(), strict=True))
    assert held == {i: [i * 1e5, 1, 2] if i % 7 == 0 else [i % 100, -3] for i in range(5000)}


def test_fingerprints_are_majorities():
    import xxhash

    for text in (b"", b"  ", b"One", b"one TWO", b"a b c d a b c d E", "é É x".encode()):
        words = text.lower().split()
        runs = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
        want = sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes)) if hashes else 0
        assert simhash.fingerprint(text) == want


@pytest.mark.parametrize("count", [0, 1, 2, 300])
def test_the_trie_finds_all_near_pairs(count):
    draw = np.random.default_rng(count)
    centres = draw.integers(0, 2**64, 5, dtype=np.uint64)
    flips = lambda: sum(1 << int(b) for b in draw.integers(0, 64, draw.integers(4)))
    a = np.unique(np.array([int(centres[i % 5]) ^ flips() & (1 << 64) - 1 for i in range(count)], dtype=np.uint64))
    b = a[::2] ^ np.uint64(1 << 40)
    b.sort()
    for left, right, itself in ((a, a, True), (a, b, False)):
        found = {(int(i), int(j)) for x, y in simhash.trie_links(left, right, 2, itself) for i, j in zip(x, y, strict=True)}
        want = {(i, j) for i, x in enumerate(left) for j, y in enumerate(right) if (int(x) ^ int(y)).bit_count() <= 2 and (not itself or i < j)}
        assert found == want


def test_near_duplicates_of_small_nodes(spark, docs, odd, monkeypatch):
    monkeypatch.setattr(simhash.near_links, "__defaults__", (2, 8))
    for rows in (docs, odd, docs.limit(0)):
        data = [(k, simhash.fingerprint((t or "").encode())) for k, t in texts_of(rows)]
        group = list(range(len(data)))
        for i, (_, x) in enumerate(data):
            for j in range(i):
                if (x ^ data[j][1]).bit_count() <= 2 and group[i] != group[j]:
                    old, new = group[i], group[j]
                    group = [new if g == old else g for g in group]
        least = {g: min((k for (k, _), h in zip(data, group, strict=True) if h == g and k is not None), default=None) for g in set(group)}
        want = [(k, f"{x:016x}", least[g]) for (k, x), g in zip(data, group, strict=True)]
        assert rows_of(simhash.near_duplicates(rows), "doc_id", "fingerprint", "component_id") == sorted(want, key=repr)


def test_components_of_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, j) for j in range(200, 260)] + [(5, 5), (300, 7)]
    found = dict(rows_of(components(spark.createDataFrame(links, "a long, b long")), "node", "root"))
    assert all(found[i] == 100 for i in range(100, 161)) and all(found[j] == 7 for j in [7, 300, *range(200, 260)]) and 5 not in found
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_letters_decide_about_und():
    assert langid.split_words("12 !? ́") == [] and langid.split_words("Été 1a") == ["été", "a"]
    assert regex.match(langid.LETTERS, "é")
