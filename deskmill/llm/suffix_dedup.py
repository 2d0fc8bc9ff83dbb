"""Removal of byte strings that occur more than once, by a difference cover and buckets of suffixes.

A suffix matters here by its first ``length`` bytes only. Two equal strings of that length share, at the same offset, a position of the
difference cover (modulo ``PERIOD``, counted from the document's begin), whatever their alignment. So the work is blockwise:

1. Every position of the cover gets the name of the ``length - PERIOD + 1`` bytes behind it. A string none of whose cover positions
   has a name that occurs again cannot occur again, and is settled.
2. Cover positions with such a name get a second name, of ``length + PERIOD - 1`` bytes. These resolve the long ties: where such a
   name occurs again, all strings inside it do, and only its first occurrence stands for them in what follows.
3. The strings left are sorted, one bucket at a time; equal neighbours are repeats.

Names take the place of ranks, since equality is all that is asked: a bucket is a range of hashed prefixes, not of the alphabet,
so that a frequent beginning does not fill one bucket.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from deskmill.llm.blocks import FIRST, SHARED, Block, Cut, Rolling, ask, cut_for, each_block, pack, rolling_bytes, spread, with_masks
from deskmill.llm.common import total_bytes
from deskmill.session import durable_cut

# A perfect difference set: every offset modulo PERIOD is the difference of just one ordered pair.
PERIOD = 133
COVER = (0, 1, 25, 30, 40, 46, 53, 96, 100, 114, 122, 131)
LENGTH = 200


def _starts(block: Block, length: int) -> np.ndarray:
    """Whether a string of ``length`` bytes starts at each byte and ends in the same document."""
    ok = np.zeros(len(block.data), dtype=bool)
    for lo, hi in zip(block.bounds, block.bounds[1:], strict=False):
        ok[lo : max(lo, hi - length + 1)] = True
    return ok


def _cover_positions(block: Block, size: int) -> np.ndarray:
    """The cover positions at which a string of ``size`` bytes fits into its document."""
    grid = np.arange(0, max(np.diff(block.bounds), default=0), PERIOD)[:, None] + np.array(COVER)
    found = [(flat := grid[: -(-n // PERIOD)].ravel())[: np.searchsorted(flat, n - size, side="right")] + lo for lo, n in zip(block.bounds, np.diff(block.bounds), strict=False) if n >= size]
    return np.concatenate(found) if found else np.zeros(0, dtype=np.int64)


def _covered(begins: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    """Which of ``size`` places lie in one of the spans."""
    change = np.bincount(begins, minlength=size + 1) - np.bincount(ends, minlength=size + 1)
    return np.cumsum(change[:size]) > 0


class _Work:
    """The passes over one block, each built on the answers of those before; ``cuts`` are theirs."""

    def __init__(self, block: Block, cuts: dict[str, Cut], length: int):
        self.block, self.cuts, self.length = block, cuts, length
        self.hashes: Rolling = rolling_bytes(block.data)

    def _keys(self, name: str, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        keys = self.cuts[name].keys(spread(self.hashes.slices(at, at + size)))
        return np.unique(keys, return_inverse=True, return_counts=True)

    def cover(self) -> tuple[np.ndarray, tuple]:
        size = self.length - PERIOD + 1
        at = _cover_positions(self.block, size)
        return at, self._keys("cover", at, size)

    def long(self) -> tuple[np.ndarray, np.ndarray, tuple]:
        """Cover positions whose name occurs again, and the long names of those that have room."""
        at, (_, inverse, counts) = self.cover()
        again = at[((self.block.masks.get("cover", np.zeros(len(counts), np.uint8)) & SHARED > 0) | (counts > 1))[inverse]] if len(at) else at
        size = self.length + PERIOD - 1
        room = again[_starts(self.block, size)[again]] if len(again) else again
        return again, room, self._keys("long", room, size)

    def windows(self) -> tuple[np.ndarray, np.ndarray, tuple]:
        """Strings proven to occur again, and those still to be sorted with their keys."""
        again, room, (_, inverse, counts) = self.long()
        total = len(self.block.data)
        possible = _starts(self.block, self.length)
        # Back from a cover position, but not beyond the begin of its document.
        begin = self.block.bounds[np.searchsorted(self.block.bounds, again, side="right") - 1]
        left = _covered(np.maximum(again - PERIOD + 1, begin), again + 1, total) & possible
        answers = self.block.masks.get("long", np.zeros(len(counts), np.uint8))
        shared = answers & SHARED > 0
        tied = (shared | (counts > 1))[inverse] if len(room) else np.zeros(0, dtype=bool)
        # The first occurrence of all: in the first block that has the name, the first place there.
        first = np.zeros(len(room), dtype=bool)
        if len(room):
            first[np.unique(inverse, return_index=True)[1]] = True
            first &= (~shared | (answers & FIRST > 0))[inverse]
        # A long name has room for a string at each of PERIOD places, all in its document.
        proven = _covered(room[tied], room[tied] + PERIOD, total)
        others = room[tied & ~first]
        at = np.flatnonzero(left & ~_covered(others, others + PERIOD, total))
        return proven, at, self._keys("windows", at, self.length)

    def repeated(self) -> np.ndarray:
        """Where a string starts that also starts elsewhere."""
        proven, at, (_, inverse, counts) = self.windows()
        if len(at):
            again = (self.block.masks.get("windows", np.zeros(len(counts), np.uint8)) & SHARED > 0) | (counts > 1)
            proven[at[again[inverse]]] = True
        return proven


def _emit(block: Block, name: str, cuts: dict[str, Cut], length: int) -> tuple[np.ndarray, None]:
    work = _Work(block, cuts, length)
    return {"cover": work.cover, "long": work.long, "windows": work.windows}[name]()[-1][0], None


def _results(block: Block, cuts: dict[str, Cut], length: int, digests: bool) -> Iterator[pa.RecordBatch]:
    starts = _Work(block, cuts, length).repeated()
    at = np.flatnonzero(starts)
    gone = _covered(at, at + length, len(starts))
    rows: list[list] = [[], [], [], []]
    for lo, hi in zip(block.bounds.tolist(), block.bounds[1:].tolist(), strict=False):
        out = gone[lo:hi]
        kept = block.data[lo:hi][~out].tobytes()
        rows[0].append(hi - lo)
        rows[1].append(int(out.sum()))
        rows[2].append(int(out[:1].sum() + (out[1:] & ~out[:-1]).sum()))
        rows[3].append(hashlib.sha256(kept).hexdigest() if digests else kept)
    keys = pa.array(block.keys)
    yield pa.RecordBatch.from_arrays([keys.cast(pa.int64()) if pa.types.is_null(keys.type) else keys, *[pa.array(r, pa.int64()) for r in rows[:3]], pa.array(rows[3])], names=["key", "n_bytes", "n_removed", "n_spans", "kept"])


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, digests: bool = False) -> DataFrame:
    """Each text without the bytes of any ``length``-byte string that also starts elsewhere, in the same document or another.

    Gives ``key``, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs) and ``kept`` (the bytes left; with ``digests`` their SHA-256 in
    lower-case hex). One row per row: a null text is empty, texts shorter than ``length`` stay as they are, repeated rows are
    documents of their own, a null key stays null, an empty table gives no rows. Strings are judged on the input. Keys are
    61-bit hashes with a random base; ``length`` must be over ``PERIOD``.
    """
    if length <= PERIOD:
        raise ValueError(f"strings must be longer than {PERIOD} bytes")
    size = total_bytes(docs, text)
    blocks = pack(docs, key, text)
    # A cover name only has to sort out, so part of its bits is enough; a filled bucket at most doubles its share.
    cuts = {"cover": cut_for(size * len(COVER) // PERIOD, 5), "long": cut_for(size * len(COVER) // PERIOD, 8), "windows": cut_for(size // 2, 8)}
    answers: list[DataFrame] = []
    for name, cut in cuts.items():
        answers.append(ask(with_masks(blocks, answers), name, cut, partial(_emit, name=name, cuts=cuts, length=length)))
    kind = docs.schema[key].dataType.simpleString()
    schema = f"key {kind}, n_bytes long, n_removed long, n_spans long, kept {'string' if digests else 'binary'}"
    found = each_block(with_masks(blocks, answers), partial(_results, cuts=cuts, length=length, digests=digests), schema)
    return durable_cut(found.withColumnRenamed("key", key))
