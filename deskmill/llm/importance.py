"""Importance resampling towards a target distribution, by hashed n-grams of words.

The n-grams of a batch are interned in an open-addressed table: a NumPy array of slots, probed in turn from the XXH64 of
what is looked up, which is compared in full before a slot is shared. Words are compared as bytes; a longer n-gram is the slot of the n-gram
without its last word and the slot of that word, so that equal pairs are equal bytes. Each slot has its bucket, computed once, and its count.
One pass over both tables adds the counts up by bucket; a second one gathers the gains of the buckets through the
slots of all occurrences. Noise drawn from the key turns "the highest scores" into a sample by weight.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from math import floor, log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskmill.llm.common import bytes_of, chunks, free_name
from deskmill.operators.running import CHUNK, Running, ranged, running
from deskmill.session import durable_cut

LONGEST = 3
BUCKETS = 10_000
LEAST_WORDS = 20
DRAWN_PERCENT = 5
SEED = 42
# Words whose n-grams are interned at a time.
SLICE = 1 << 16

# ASCII letters in lower case and digits stay, as do all bytes above ASCII; the others part words.
_AS_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
# The multipliers of XXH64 for one 8-byte lane; fixed values.
_PRIMES = tuple(map(np.uint64, (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)))


def words_of_text(text: bytes) -> list[bytes]:
    return text.translate(_AS_WORDS).split()


def _turned(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def xxh64_of_numbers(values: np.ndarray) -> np.ndarray:
    """The XXH64 (seed 0) of each number's eight bytes."""
    one, two, three, four, five = _PRIMES
    found = (five + np.uint64(8)) ^ (_turned(values * two, 31) * one)
    found = _turned(found, 27) * one + four
    found = (found ^ (found >> np.uint64(33))) * two
    found = (found ^ (found >> np.uint64(29))) * three
    return found ^ (found >> np.uint64(32))


def intern(keys: np.ndarray, same: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The slot of each occurrence, and the occurrence that took each slot (-1: free).

    Occurrences are looked for from the place their key names, slot by slot; ``same`` tells of two lists of occurrences which
    pairs are equal. At most half of the slots are taken.
    """
    mask = (1 << max(4, (2 * len(keys)).bit_length())) - 1
    owner = np.full(mask + 1, -1, dtype=np.int32)
    slots = np.empty(len(keys), dtype=np.int32)
    open_, at = np.arange(len(keys), dtype=np.int32), (keys & np.uint64(mask)).astype(np.int32)
    while len(open_):
        free = owner[at] < 0
        owner[at[free]] = open_[free]
        held = owner[at]
        hit = keys[held] == keys[open_]
        hit[hit] = same(held[hit], open_[hit])
        slots[open_[hit]] = at[hit]
        open_, at = open_[~hit], (at[~hit] + 1) & mask
    return slots, owner


@lru_cache(maxsize=4096)
def _crc_shift(length: int) -> np.ndarray:
    """Four tables (by byte) that turn the CRC-32 of something into its part in the CRC-32 of that and ``length`` more bytes."""
    if length > 64:
        half = _crc_shift(length // 2)
        return _shifted(_crc_shift(length - length // 2)[None], np.zeros(half.size, dtype=np.int64), half.ravel()).reshape(half.shape)
    zeros = bytes(length)
    return np.array([[zlib.crc32(zeros, value << 8 * k) ^ zlib.crc32(zeros) for value in range(256)] for k in range(4)], dtype=np.uint32)


def _shifted(tables: np.ndarray, which: np.ndarray, crc: np.ndarray) -> np.ndarray:
    found = np.zeros(len(crc), dtype=np.uint32)
    for k in range(4):
        found ^= tables[which, k, (crc >> np.uint32(8 * k)) & np.uint32(255)]
    return found


@dataclass
class Interned:
    """The n-grams of one length in a slice of a batch: document and slot of each occurrence; bucket and count of each slot."""

    doc: np.ndarray
    slot: np.ndarray
    bucket: np.ndarray
    count: np.ndarray


def interned(texts: list[bytes], longest: int = LONGEST, buckets: int = BUCKETS) -> Iterator[Interned]:
    """All runs of 1 to ``longest`` words of the texts; none reaches from one text into the next."""
    split = [words_of_text(t) for t in texts]
    words, doc = [w for found in split for w in found], np.repeat(np.arange(len(split)), [len(found) for found in split])
    for lo in range(0, len(words), SLICE):
        yield from _interned(words[lo : lo + SLICE + longest - 1], doc[lo : lo + SLICE + longest - 1], min(SLICE, len(words) - lo), longest, buckets)


def _interned(words: list[bytes], doc: np.ndarray, begins: int, longest: int, buckets: int) -> Iterator[Interned]:
    held = np.empty(len(words), dtype=object)
    held[:] = words
    keys = np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))
    word_slot, owner = intern(keys, lambda a, b: (held[a] == held[b]).astype(bool))
    taken = np.flatnonzero(owner >= 0)
    distinct = held[owner[taken]]
    crc = np.zeros(len(owner), dtype=np.uint32)
    crc[taken] = list(map(zlib.crc32, distinct))
    # What a word adds at the end of a longer n-gram: itself behind a space.
    spaced, which = np.zeros(len(owner), dtype=np.uint32), np.zeros(len(owner), dtype=np.int64)
    spaced[taken] = [zlib.crc32(b" " + w) for w in distinct]
    lengths, which[taken] = np.unique([len(w) + 1 for w in distinct], return_inverse=True)
    shifts = np.stack([_crc_shift(int(n)) for n in lengths])

    at, slot = np.arange(len(words)), word_slot
    for n in range(1, longest + 1):
        if n > 1:
            inside = at + n - 1 < len(words)
            at, before = at[inside], slot[inside]
            inside = doc[at + n - 1] == doc[at]
            at, before = at[inside], before[inside]
            last = word_slot[at + n - 1]
            pairs = (before.astype(np.uint64) << np.uint64(32)) | last.astype(np.uint64)
            slot, owner = intern(xxh64_of_numbers(pairs), lambda a, b, pairs=pairs: pairs[a] == pairs[b])
            taken = np.flatnonzero(owner >= 0)
            first = owner[taken]
            longer = np.zeros(len(owner), dtype=np.uint32)
            longer[taken] = _shifted(shifts, which[last[first]], crc[before[first]]) ^ spaced[last[first]]
            crc = longer
        own = at < begins
        bucket = (crc % np.uint32(buckets)).astype(np.int64)
        yield Interned(doc[at[own]], slot[own], bucket, np.bincount(slot[own], minlength=len(crc)))


def bucket_counts(docs: DataFrame, text: str, longest: int = LONGEST, buckets: int = BUCKETS) -> np.ndarray:
    """How many n-grams of all rows fall into each bucket; as many rows as there are buckets come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, texts in chunks(range(batch.num_rows), bytes_of(batch.column("text"))):
                for found in interned(texts, longest, buckets):
                    np.add.at(totals, found.bucket[taken := found.count > 0], found.count[taken])
        used = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(totals[used])], names=["bucket", "n"])

    totals = np.zeros(buckets, dtype=np.int64)
    counted = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(run, "bucket long, n long")
    for bucket, n in counted.groupBy("bucket").agg(F.sum("n")).collect():
        totals[bucket] = n
    return totals


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log of a bucket's share in the target over that in the corpus, one added to each count; rounded down."""
    buckets, all_corpus, all_target = len(corpus), int(corpus.sum()), int(target.sum())
    ratio = [(t + 1) * (all_corpus + buckets) / ((s + 1) * (all_target + buckets)) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)]
    return np.array([floor(1000 * log(x)) for x in ratio], dtype=np.int64)


def weights(docs: DataFrame, key: str, text: str, gain: np.ndarray, longest: int = LONGEST) -> DataFrame:
    """``key``, ``n_words``, ``n_features`` and ``weight`` (the sum of the gains of all n-grams) of each row; no shuffle."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for places, texts in chunks(range(batch.num_rows), bytes_of(batch.column("text"))):
                sums = np.zeros((3, len(texts)), dtype=np.int64)
                for number, found in enumerate(interned(texts, longest, len(gain))):
                    n = np.bincount(found.doc, minlength=len(texts))
                    sums[0] += n if number % longest == 0 else 0
                    sums[1] += n
                    # Occurrences lie in the order of their documents.
                    upto = np.concatenate(([0], np.cumsum(gain[found.bucket][found.slot])))
                    ends = np.cumsum(n)
                    sums[2] += upto[ends] - upto[ends - n]
                yield pa.RecordBatch.from_arrays([batch.column("key").slice(places[0], len(places)), *map(pa.array, sums)], names=["key", "n_words", "n_features", "weight"])

    narrow = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    return narrow.mapInArrow(run, f"key {kind}, n_words long, n_features long, weight long").withColumnRenamed("key", key)


def noise(key: Column, seed: int = SEED) -> Column:
    """Thousandths of a draw from the Gumbel distribution by seed and key, rounded down; a null key is empty."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256), 1, 8)
    share = (F.conv(digits, 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(F.lit(-1000.0) * F.log(-F.log(share)))


def resample(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text", percent: int = DRAWN_PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED, longest: int = LONGEST, buckets: int = BUCKETS) -> DataFrame:
    """``key``, ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank`` of every row.

    Features are all runs of 1 to ``longest`` words (``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z are lower-cased), repeats counted, in
    ``buckets`` buckets by CRC-32. ``weight`` is the sum of their gains, from the counts of all rows of ``docs`` against all of ``target``; ``score`` adds the
    noise of the key. Of the N rows with at least ``least_words`` words the floor(``percent`` * N / 100) highest scores are drawn and
    numbered from 1 in ``rank`` (ties to smaller keys, null keys last), null for the others.

    A null text has no words and weight 0; repeated rows are rows of their own and are numbered one after the other; an empty target
    leaves gains from the corpus alone; an empty table gives no rows. Rows are ranked in ranges that are written, never in one task.
    """
    gain = gains(bucket_counts(docs, text, longest, buckets), bucket_counts(target, target_text, longest, buckets))
    scored = weights(docs, key, text, gain, longest).withColumn("score", F.col("weight") + noise(F.col(key), seed))
    low, late, place, row = (free_name(scored, c) for c in ("low", "late", "place", "row"))
    # The number of a row parts rows that are equal, so that a range can end between them.
    ordered = scored.withColumns({late: F.col("n_words") < least_words, low: -F.col("score"), row: F.monotonically_increasing_id()})
    rated = durable_cut(ordered.withColumn(f"{late}_key", F.col(key).isNull()))
    order = [late, low, f"{late}_key", key, row]
    drawn = rated.filter(~F.col(late)).count() * percent // 100
    ranked = running(ranged(rated, [], order), [], order, F.col(CHUNK), {place: Running("sum", F.lit(1).cast("long"))})
    rank = F.when(~F.col(late) & (F.col(place) <= drawn), F.col(place))
    return ranked.select(key, "n_words", "n_features", "weight", "score", rank.alias("rank"))
