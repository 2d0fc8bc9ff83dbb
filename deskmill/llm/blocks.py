"""Passes over packed blocks of documents that ask which hashed keys occur elsewhere.

Documents are packed into blocks of a few MB and written once. A pass computes keys (hashes of substrings) from each block, and
every block gives each of its keys once, so that a key that fills the corpus comes at most once per block. Keys are dealt to
buckets by their leading bits, sorted there, and the answer goes back as bit masks over the block's sorted keys: no positions
travel. The next pass reads the block again with the masks of the passes before.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskmill.llm.common import bytes_of
from deskmill.session import durable_cut

BLOCK_BYTES = 1 << 20
# Bytes of keys in one bucket, which is what a sorting task holds.
BUCKET_BYTES = 8 << 20
NO_KEY = np.iinfo(np.int64).max
# Hashes are sums of powers of a random base modulo this prime: two different sequences of n values agree for at most n of its bases.
PRIME = (1 << 61) - 1
_P, _LOW31, _LOW30 = np.uint64(PRIME), np.uint64((1 << 31) - 1), np.uint64((1 << 30) - 1)
_BASE = int(np.random.default_rng(20240229).integers(1 << 60, PRIME))
# Sequences of such hashes have a base of their own: with the same one, "x, yz, w" and "x, yw, z" would add up to the same sum.
_SEQUENCE_BASE = int(np.random.default_rng(20240301).integers(1 << 60, PRIME))
# Values taken at a time: few enough for the cache, and for sums of products of a byte and half a power below 2 to the 61.
_SUMS = 1 << 16


def _reduced(x: np.ndarray) -> np.ndarray:
    x = (x & _P) + (x >> np.uint64(61))
    # Below the prime the difference wraps around to a large number.
    return np.minimum(x, x - _P)


def _up31(x: np.ndarray) -> np.ndarray:
    """``x`` times 2 to the 31, for reduced ``x``."""
    return ((x & _LOW30) << np.uint64(31)) | (x >> np.uint64(30))


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of reduced numbers."""
    a_high, a_low, b_high, b_low = a >> np.uint64(31), a & _LOW31, b >> np.uint64(31), b & _LOW31
    middle = a_high * b_low + a_low * b_high
    return _reduced(np.uint64(2) * a_high * b_high + (middle >> np.uint64(30)) + ((middle & _LOW30) << np.uint64(31)) + a_low * b_low)


_powers_held: dict[int, np.ndarray] = {}


def _powers(base: int, count: int) -> np.ndarray:
    """The first powers of a base; kept, as blocks are of about one size."""
    held = _powers_held.get(base, np.ones(1, dtype=np.uint64))
    while len(held) < count:
        held = np.concatenate([held, _times(held, np.full(1, pow(base, len(held), PRIME), dtype=np.uint64))])
    _powers_held[base] = held
    return held[:count]


class Rolling:
    """Hashes of any slices of a sequence of numbers below ``PRIME`` and above 0, from sums over its prefixes."""

    def __init__(self, values: np.ndarray, base: int = _BASE):
        count = len(values)
        powers = _powers(base, count)
        self._back = _powers(pow(base, -1, PRIME), count + 1)
        self._sums = np.zeros(count + 1, dtype=np.uint64)
        small = values.dtype.itemsize < 8
        for at in range(0, count, _SUMS):
            part, here = values[at : at + _SUMS].astype(np.uint64), powers[at : min(at + _SUMS, count)]
            here, part = (here, part) if small else (_times(part, here), np.uint64(1))
            low, high = np.cumsum(part * (here & _LOW31)), np.cumsum(part * (here >> np.uint64(31)))
            self._sums[at + 1 : at + 1 + len(here)] = _reduced(_up31(high) + low + self._sums[at])

    def slices(self, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Numbers below ``PRIME`` and above 0 that are equal for equal slices."""
        found = np.empty(len(begins), dtype=np.uint64)
        for at in range(0, len(begins), _SUMS):
            lo, hi = begins[at : at + _SUMS], ends[at : at + _SUMS]
            found[at : at + _SUMS] = np.maximum(_times(_reduced(self._sums[hi] + (_P - self._sums[lo])), self._back[lo]), np.uint64(1))
        return found


def spread(hashes: np.ndarray) -> np.ndarray:
    """Hashes over all 64 bits, one to one."""
    found = hashes ^ (hashes >> np.uint64(33))
    found = found * np.uint64(0xFF51AFD7ED558CCD)
    return found ^ (found >> np.uint64(29))


def rolling_bytes(data: np.ndarray) -> Rolling:
    return Rolling(data.astype(np.uint16) + np.uint16(1))


def rolling_words(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> Rolling:
    """Hashes of runs of words, from the hashes of the words."""
    return Rolling(rolling_bytes(data).slices(begins, ends), _SEQUENCE_BASE)


def words_of(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and document of each word in texts that lie end to end."""
    space = (data == 32) | ((data >= 9) & (data <= 13))
    begins, ends = ~space, ~space
    begins[1:] &= space[:-1]
    ends[:-1] &= space[1:]
    # Without white space between them two documents still end a word each.
    inner = bounds[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    begins[inner] = ~space[inner]
    ends[inner - 1] = ~space[inner - 1]
    at = np.flatnonzero(begins)
    return at, np.flatnonzero(ends) + 1, np.searchsorted(bounds, at, side="right") - 1


@dataclass
class Block:
    """The texts of one block end to end, and the answers of earlier passes by name."""

    block: int
    keys: list
    bounds: np.ndarray
    data: np.ndarray
    masks: dict[str, np.ndarray] = field(default_factory=dict)


def pack(docs: DataFrame, key: str, text: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` as a written table of blocks; a null text is empty, a text longer than a block is one of its own."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, keys, texts, held = TaskContext.get().partitionId() << 32, [], [], 0

        def row() -> pa.RecordBatch:
            data = zstandard.ZstdCompressor(level=5).compress(b"".join(texts))
            columns = [[made], pa.array([keys], pa.list_(batch.schema.field("key").type)), pa.array([[len(x) for x in texts]], pa.list_(pa.int64())), [data]]
            return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=["block", "keys", "sizes", "data"])

        for batch in batches:
            for doc, data in zip(batch.column("key").to_pylist(), bytes_of(batch.column("text")), strict=True):
                keys.append(doc)
                texts.append(data)
                held += len(data)
                if held >= block_bytes:
                    yield row()
                    made, keys, texts, held = made + 1, [], [], 0
        if keys:
            yield row()

    narrow = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    return durable_cut(narrow.mapInArrow(run, f"block long, keys array<{kind}>, sizes array<long>, data binary"))


def _opened(row: dict) -> Block:
    bounds = np.concatenate(([0], np.cumsum(np.array(row["sizes"], dtype=np.int64))))
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["data"], max_output_size=max(1, int(bounds[-1]))), dtype=np.uint8)
    masks: dict[str, list] = {}
    for part in sorted(row.get("masks") or [], key=lambda x: (x["name"], x["bucket"])):
        masks.setdefault(part["name"], []).append(np.frombuffer(part["bits"], dtype=np.uint8))
    return Block(row["block"], row["keys"], bounds, data, {name: np.concatenate([_held(p) for p in parts]) for name, parts in masks.items()})


def _held(part: np.ndarray) -> np.ndarray:
    """Answers of one bucket: two bits per key, four keys in a byte; the first eight bytes hold the count."""
    count = int(part[:8].view("<i8")[0])
    bits = np.unpackbits(part[8:])[: 2 * count].reshape(-1, 2)
    return bits[:, 0] * np.uint8(2) + bits[:, 1]


def _put(answers: np.ndarray) -> bytes:
    bits = np.stack([answers >> 1, answers & 1], axis=1).astype(np.uint8).ravel()
    return np.array([len(answers)], dtype="<i8").tobytes() + np.packbits(bits).tobytes()


@dataclass(frozen=True)
class Cut:
    """How many bits of a key name its bucket, and how many bytes of the rest travel."""

    bits: int
    width: int

    def keys(self, full: np.ndarray) -> np.ndarray:
        spare = 64 - self.bits - 8 * self.width
        return full >> np.uint64(spare) if spare > 0 else full

    def buckets(self, cut: np.ndarray) -> np.ndarray:
        return (cut >> np.uint64(min(64 - self.bits, 8 * self.width))).astype(np.int64)


def cut_for(expected_keys: int, width: int, bucket_bytes: int = BUCKET_BYTES) -> Cut:
    return Cut(max(6, (-(-expected_keys * width // bucket_bytes)).bit_length()), width)


def with_masks(blocks: DataFrame, answers: list[DataFrame]) -> DataFrame:
    """Each block with what the passes before have found for it."""
    if not answers:
        return blocks
    every = answers[0]
    for more in answers[1:]:
        every = every.unionByName(more)
    # A block's own answers only: two bits for each of its keys.
    return blocks.join(every.groupBy("block").agg(F.collect_list(F.struct("name", "bucket", "bits")).alias("masks")), "block", "left")


def each_block(blocks: DataFrame, work: Callable[[Block], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                yield from work(_opened(batch.slice(at, 1).to_pylist()[0]))

    return blocks.mapInArrow(run, schema)


# What a bucket answers about a key: other blocks have it, and this is the first of its blocks (or no block has a smaller value).
SHARED, FIRST = 2, 1


def ask(blocks: DataFrame, name: str, cut: Cut, emit: Callable[[Block], tuple[np.ndarray, np.ndarray | None]]) -> DataFrame:
    """One pass. ``emit`` gives the sorted distinct keys of a block, already cut, and perhaps a whole number for each.

    The answer for a key has ``SHARED`` if another block gave it too, and ``FIRST`` if this block is the first that did, or,
    where there are numbers, if no other block gave a smaller one. Written, after which the keys' shuffle files go.
    """

    def deal(block: Block) -> Iterator[pa.RecordBatch]:
        keys, values = emit(block)
        if not len(keys):
            return
        buckets = cut.buckets(keys)
        edges = [0, *(np.flatnonzero(np.diff(buckets)) + 1).tolist(), len(keys)]
        raw = np.ascontiguousarray(keys).view(np.uint8).reshape(-1, 8)[:, : cut.width]
        spans = list(zip(edges, edges[1:], strict=False))
        columns = [
            pa.array([int(buckets[a]) for a, _ in spans], pa.int64()),
            pa.array([block.block] * len(spans), pa.int64()),
            pa.array([raw[a:b].tobytes() for a, b in spans], pa.binary()),
            pa.array([None if values is None else values[a:b].astype("<i8").tobytes() for a, b in spans], pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["bucket", "block", "keys", "numbers"])

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A partition's buckets come one after the other, and one is held at a time.
        held, bucket = [], None
        for batch in batches:
            marks = batch.column("bucket").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(marks)) + 1).tolist(), len(marks)]
            for lo, hi in zip(edges, edges[1:], strict=False):
                if lo == hi:
                    continue
                if held and marks[lo] != bucket:
                    yield _settled(name, int(bucket), held, cut.width)
                    held = []
                bucket = marks[lo]
                held.append(batch.slice(lo, hi - lo))
        if held:
            yield _settled(name, int(bucket), held, cut.width)

    dealt = each_block(blocks, deal, "bucket long, block long, keys binary, numbers binary")
    return durable_cut(dealt.repartition("bucket").sortWithinPartitions("bucket", "block").mapInArrow(settle, "name string, block long, bucket long, bits binary"))


def _settled(name: str, bucket: int, parts: list[pa.RecordBatch], width: int) -> pa.RecordBatch:
    """The answers of one bucket, a row per block."""
    rows = pa.Table.from_batches(parts)
    blocks, segments = rows.column("block").to_pylist(), rows.column("keys").to_pylist()
    counts = [len(x) // width for x in segments]
    raw = np.zeros((sum(counts), 8), dtype=np.uint8)
    raw[:, :width] = np.frombuffer(b"".join(segments), dtype=np.uint8).reshape(-1, width)
    keys = raw.view("<u8").ravel()
    found = rows.column("numbers").to_pylist()
    numbers = np.frombuffer(b"".join(found), dtype="<i8") if found[0] is not None else None
    # Blocks are in order, so a stable sort puts the first block of a key first; with numbers the smallest is first.
    order = np.lexsort((numbers, keys)) if numbers is not None else np.argsort(keys, kind="stable")
    ordered = keys[order]
    begins = np.concatenate(([True], ordered[1:] != ordered[:-1]))
    run = np.cumsum(begins) - 1
    shared = np.bincount(run)[run] > 1
    first = numbers[order] == numbers[order][np.flatnonzero(begins)][run] if numbers is not None else begins
    answers = np.zeros(len(keys), dtype=np.uint8)
    answers[order] = shared * np.uint8(SHARED) + first * np.uint8(FIRST)
    bits = [_put(x) for x in np.split(answers, np.cumsum(counts)[:-1])]
    columns = [pa.array([name] * len(blocks)), pa.array(blocks, pa.int64()), pa.array([bucket] * len(blocks), pa.int64()), pa.array(bits, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["name", "block", "bucket", "bits"])
