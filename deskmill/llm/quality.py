"""Quality rules: counts per text, and a log-likelihood ratio of hashed n-grams.

Two multinomials over hashed n-grams of bytes are counted: one of trusted documents, one of the whole corpus. A text's score
is the mean over its n-grams of the log of the trusted probability over the corpus's. There is no sampling: the
same threshold decides about every document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskmill.llm.blocks import Rolling, rolling_words, words_of
from deskmill.llm.common import bytes_of, chunks

NGRAM = 4
BUCKET_BITS = 14
# Nats per n-gram a text may fall short of the corpus by; a language with a third less of the trusted texts stays within.
THRESHOLD = -0.4
TRUSTED = 10_000
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
SYMBOLS = b"#*$%&|<>"

_IS_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))
_STARTS_CODE_POINT = np.arange(256) & 0xC0 != 0x80


def ngrams(data: np.ndarray, size: int = NGRAM, bits: int = BUCKET_BITS) -> np.ndarray:
    """The bucket of each run of ``size`` bytes."""
    if len(data) < size:
        return np.zeros(0, dtype=np.int64)
    wide, last = data.astype(np.uint32), len(data) - size + 1
    found = wide[:last].copy()
    for step in range(1, size):
        found = found * np.uint32(257) + wide[step : last + step]
    return ((found * np.uint32(0x9E3779B1)) >> np.uint32(32 - bits)).astype(np.int64)


def _laid_out(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(texts), dtype=np.uint8), np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)


def ratios(docs: DataFrame, text: str, trusted: str, size: int = NGRAM, bits: int = BUCKET_BITS) -> np.ndarray:
    """Log of trusted over corpus probability of each bucket, from all rows (``trusted`` marks those of the target)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((2, 1 << bits), dtype=np.int64)
        for batch in batches:
            marks = batch.column("trusted").to_pylist()
            for mark, data in zip(marks, bytes_of(batch.column("text")), strict=True):
                found = np.bincount(ngrams(np.frombuffer(data, dtype=np.uint8), size, bits), minlength=1 << bits)
                totals[0] += found
                if mark:
                    totals[1] += found
        used = np.flatnonzero(totals[0])
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(totals[0][used]), pa.array(totals[1][used])], names=["bucket", "corpus", "target"])

    rows = docs.select(F.col(text).cast("string").alias("text"), F.col(trusted).alias("trusted")).mapInArrow(count, "bucket long, corpus long, target long")
    # As many rows as there are buckets come to the driver.
    sums = rows.groupBy("bucket").agg(F.sum("corpus"), F.sum("target")).collect()
    totals = np.ones((2, 1 << bits))
    for bucket, corpus, target in sums:
        totals[:, bucket] += corpus, target
    shares = totals / totals.sum(axis=1, keepdims=True)
    return np.log(shares[1] / shares[0])


def _measured(texts: list[bytes], model: np.ndarray, size: int, bits: int) -> dict[str, np.ndarray]:
    data, bounds = _laid_out(texts)
    begins, ends, doc = words_of(data, bounds)
    first, n_words = np.searchsorted(doc, np.arange(len(texts))), np.bincount(doc, minlength=len(texts))

    def per_text(values: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(values)))
        return sums[bounds[1:]] - sums[bounds[:-1]]

    space = (data == 32) | ((data >= 9) & (data <= 13))
    windows = rolling_words(data, begins, ends)
    repeated, scores, doubled = [], [], []
    for i, text in enumerate(texts):
        repeated.append(_repeated(windows, int(first[i]), int(n_words[i])))
        grams = ngrams(data[bounds[i] : bounds[i + 1]], size, bits)
        scores.append(float(model[grams].mean()) if len(grams) else 0.0)
        doubled.append(_doubled(text))
    return {
        "n_words": n_words,
        "word_chars": per_text(_STARTS_CODE_POINT[data] & ~space),
        "n_symbols": per_text(_IS_SYMBOL[data]),
        "n_dup_lines": np.array(doubled, dtype=np.int64),
        "n_repeat_words": np.array(repeated, dtype=np.int64),
        "score": np.array(scores),
    }


def _repeated(windows: Rolling, first: int, count: int) -> int:
    """Words that lie in a three-word window found more than once in the text."""
    if count < 4:
        return 0
    at = np.arange(first, first + count - 2)
    _, inverse, counts = np.unique(windows.slices(at, at + 3), return_inverse=True, return_counts=True)
    again = counts[inverse] > 1
    covered = np.zeros(count, dtype=bool)
    for shift in range(3):
        covered[shift : count - 2 + shift] |= again
    return int(covered.sum())


def _doubled(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


def rate(docs: DataFrame, trusted_keys: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, sample: int = TRUSTED, size: int = NGRAM, bits: int = BUCKET_BITS) -> DataFrame:
    """Counts, score and verdict of every whole text.

    Gives ``key``, ``n_words``, ``word_chars`` (code points in words), ``n_symbols``, ``n_dup_lines`` (lines with a word that equal an earlier line),
    ``n_repeat_words`` (words in three-word windows found twice or more), ``score``, ``base_failed`` (under 50 words, or more than half of them
    repeated) and ``kept`` (not failed, and a score of at least ``threshold``).

    ``trusted_keys`` names the target's documents in its column ``key``; at most ``sample`` of them are used, those with the smallest
    hashes, which is why they can be broadcast. The corpus counts are of all rows. A null text has no words; a text shorter than an n-gram,
    and every text where no document is trusted, scores 0. Repeated rows and null keys stay; an empty table gives no rows.
    """
    known = trusted_keys.select(F.col(key).alias("trusted_key")).filter("trusted_key IS NOT NULL").distinct()
    known = known.orderBy(F.xxhash64("trusted_key"), "trusted_key").limit(sample)
    narrow = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    marked = narrow.join(F.broadcast(known), F.col("key") == F.col("trusted_key"), "left").withColumn("trusted", F.col("trusted_key").isNotNull())
    model = ratios(marked, "text", "trusted", size, bits)
    if known.isEmpty():
        model = np.zeros_like(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for keys, texts in chunks(list(range(batch.num_rows)), bytes_of(batch.column("text"))):
                found = _measured(texts, model, size, bits)
                failed = (found["n_words"] < LEAST_WORDS) | (100 * found["n_repeat_words"] > MOST_REPEATED_PERCENT * found["n_words"])
                columns = [pa.array(x.astype(np.int64)) for c, x in found.items() if c != "score"]
                columns += [pa.array(found["score"]), pa.array(failed), pa.array(~failed & (found["score"] >= threshold))]
                yield pa.RecordBatch.from_arrays([batch.column("key").slice(at, len(keys)), *columns], names=["key", *found, "base_failed", "kept"])
                at += len(keys)

    counts = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
    kind = docs.schema[key].dataType.simpleString()
    return narrow.mapInArrow(run, f"key {kind}, {counts}, score double, base_failed boolean, kept boolean").withColumnRenamed("key", key)
