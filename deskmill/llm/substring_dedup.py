"""Removal of repeated runs of words, by doubling the length at which windows are compared.

All windows of the first length are asked for. A window of twice the length can only occur again if its two halves do, so each
level asks for windows made of two that survived, until none survive or the length wanted is reached; the last
step may overlap its halves to end at just that length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from deskmill.llm.blocks import FIRST, NO_KEY, SHARED, Block, Cut, Rolling, ask, cut_for, each_block, pack, rolling_words, spread, with_masks, words_of
from deskmill.llm.common import total_bytes
from deskmill.session import durable_cut

WINDOW = 13
FIRST_LEVEL = 7


def levels(window: int, first: int) -> list[int]:
    """Window lengths from ``first`` doubled up to ``window``."""
    found = [min(first, window)]
    while found[-1] < window:
        found.append(min(2 * found[-1], window))
    return found


class _Words:
    """The words of one block and the windows that survive each level."""

    def __init__(self, block: Block, cuts: dict[str, Cut], lengths: list[int]):
        self.block, self.cuts, self.lengths = block, cuts, lengths
        self.begins, self.ends, self.doc = words_of(block.data, block.bounds)
        self.hashes: Rolling = rolling_words(block.data, self.begins, self.ends)
        # A null key is no smaller than any other.
        self.order = np.array([NO_KEY if k is None else k for k in block.keys], dtype=np.int64)

    def _inside(self, length: int) -> np.ndarray:
        ok = np.zeros(len(self.doc), dtype=bool)
        if len(self.doc) >= length:
            ok[: len(self.doc) - length + 1] = self.doc[: len(self.doc) - length + 1] == self.doc[length - 1 :]
        return ok

    def level(self, step: int) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """The windows of one level that may occur again, with their keys."""
        length = self.lengths[step]
        ok = self._inside(length)
        if step:
            halves, (_, inverse, counts) = self.level(step - 1)
            again = np.zeros(len(ok), dtype=bool)
            if len(halves):
                again[halves] = ((self._answers(step - 1, counts) & SHARED > 0) | (counts > 1))[inverse]
            shift = length - self.lengths[step - 1]
            ok &= again
            ok[: len(ok) - shift] &= again[shift:]
        at = np.flatnonzero(ok)
        keys = self.cuts[f"words{length}"].keys(spread(self.hashes.slices(at, at + length)))
        return at, np.unique(keys, return_inverse=True, return_counts=True)

    def _answers(self, step: int, counts: np.ndarray) -> np.ndarray:
        return self.block.masks.get(f"words{self.lengths[step]}", np.zeros(len(counts), np.uint8))

    def smallest(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The windows of the last level, their keys, and the smallest document of the block for each key."""
        at, (keys, inverse, counts) = self.level(len(self.lengths) - 1)
        least = np.full(len(keys), NO_KEY, dtype=np.int64)
        np.minimum.at(least, inverse, self.order[self.doc[at]])
        return at, keys, inverse, least

    def repeated(self) -> np.ndarray:
        """Where a window starts that also starts in a document with a smaller key."""
        at, keys, inverse, least = self.smallest()
        found = np.zeros(len(self.doc), dtype=bool)
        if len(at):
            answers = self.block.masks.get(f"words{self.lengths[-1]}", np.full(len(keys), FIRST, np.uint8))
            found[at] = (answers & FIRST == 0)[inverse] | (self.order[self.doc[at]] > least[inverse])
        return found


def _emit(block: Block, step: int, cuts: dict[str, Cut], lengths: list[int]) -> tuple[np.ndarray, np.ndarray | None]:
    words = _Words(block, cuts, lengths)
    if step == len(lengths) - 1:
        _, keys, _, least = words.smallest()
        return keys, least
    return words.level(step)[1][0], None


def _results(block: Block, cuts: dict[str, Cut], lengths: list[int], digests: bool) -> Iterator[pa.RecordBatch]:
    words = _Words(block, cuts, lengths)
    at, total = np.flatnonzero(words.repeated()), len(words.doc)
    gone = np.cumsum(np.bincount(at, minlength=total + 1)[:total] - np.bincount(at + lengths[-1], minlength=total + 1)[:total]) > 0
    edges = np.searchsorted(words.doc, np.arange(len(block.keys) + 1))
    data, rows = block.data.tobytes(), [[], [], []]
    for lo, hi in zip(edges.tolist(), edges[1:].tolist(), strict=False):
        left = np.flatnonzero(~gone[lo:hi]) + lo
        kept = b" ".join([data[a:b] for a, b in zip(words.begins[left].tolist(), words.ends[left].tolist(), strict=True)])
        rows[0].append(hi - lo)
        rows[1].append(int(hi - lo - len(left)))
        rows[2].append(hashlib.sha256(kept).hexdigest() if digests else kept.decode())
    keys = pa.array(block.keys)
    yield pa.RecordBatch.from_arrays([keys.cast(pa.int64()) if pa.types.is_null(keys.type) else keys, pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.string())], names=["key", "n_words", "n_removed", "kept"])


def remove_repeated_words(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, first: int = FIRST_LEVEL, digests: bool = False) -> DataFrame:
    """Each text without the words of any ``window``-word run that also starts in a document with a smaller key.

    Gives ``key`` (a whole number), ``n_words``, ``n_removed`` and ``kept`` (the words left, one space between; with ``digests`` its SHA-256 in lower-case
    hex). Words are runs of bytes other than ASCII white space, compared as they are. One row per row: a null text has no words,
    a null key is larger than all others, rows with the same key do not remove each other's words, an empty table gives no rows.
    Windows are judged on the input. Keys are 61-bit hashes with a random base.
    """
    size = total_bytes(docs, text)
    blocks = pack(docs, key, text)
    lengths = levels(window, first)
    # Some six bytes to a word; all but the last level only sort out, for which part of a key's bits is enough.
    cuts = {f"words{n}": cut_for(size // 6, 8 if n == window else 5) for n in lengths}
    answers: list[DataFrame] = []
    for step, (name, cut) in enumerate(cuts.items()):
        answers.append(ask(with_masks(blocks, answers), name, cut, partial(_emit, step=step, cuts=cuts, lengths=lengths)))
    schema = f"key {docs.schema[key].dataType.simpleString()}, n_words long, n_removed long, kept string"
    found = each_block(with_masks(blocks, answers), partial(_results, cuts=cuts, lengths=lengths, digests=digests), schema)
    return durable_cut(found.withColumnRenamed("key", key))
