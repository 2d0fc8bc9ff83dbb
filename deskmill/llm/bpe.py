"""Byte-level BPE as a monoid: halves are encoded apart and joined at the seam.

A text is cut into halves down to leaves. Two encoded neighbours are joined by re-encoding a window
around the seam. The window grows until what lies outside is proven to stay as it is, by one of two facts:

* Between some kinds of characters (a letter and what is no letter, a digit and what is no digit, no
  space and a space) the pattern never matches across. A window that begins and ends at such places
  can be encoded alone, and the tokens beyond them cannot change.
* Inside one long run of a kind there is no such place. There a sequence of tokens is the one that the
  merges give if and only if each two neighbours are: encoding the bytes of both gives the two again.
  So a window may end between two tokens that pass this test.

Decoding joins the bytes of the tokens up the same kind of tree.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAF = 512
FIRST_WINDOW = 64
SLICE = 256
_LETTER, _DIGIT, _SPACE, _SIGN = "LNZS"
_CLASSES = {_LETTER: r"\p{L}", _DIGIT: r"\p{N}", _SPACE: r"\s"}


@lru_cache(maxsize=1)
def _classes() -> dict[str, tiktoken.Encoding]:
    """An encoding per class of characters, which gives tokens for no others.

    The encoder's own engine is asked, as others know the classes of another version of Unicode.
    """
    ranks = {bytes([i]): i for i in range(256)}
    return {kind: tiktoken.Encoding(kind, pat_str=pattern, mergeable_ranks=ranks, special_tokens={}) for kind, pattern in _CLASSES.items()}


@lru_cache(maxsize=65536)
def _kind(char: str) -> str:
    return next((kind for kind, encoding in _classes().items() if encoding.encode_ordinary(char)), _SIGN)


class Codec:
    """Encoder and decoder for one table of ranks; ``ranks`` maps token bytes to ids."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, leaf: int = LEAF, window: int = FIRST_WINDOW):
        self._encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self._bytes = {i: b for b, i in ranks.items()}
        self._leaf, self._window = max(1, leaf), max(4, window)

    def encode(self, text: str) -> list[int]:
        if len(text) <= self._leaf:
            return self._encoding.encode_ordinary(text)
        middle = len(text) // 2
        return self._join(text, middle, self.encode(text[:middle]), self.encode(text[middle:]))

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= self._leaf:
            return b"".join(map(self._bytes.__getitem__, ids))
        middle = len(ids) // 2
        return self.decode(ids[:middle]) + self.decode(ids[middle:])

    def _join(self, text: str, seam: int, left: list[int], right: list[int]) -> list[int]:
        width = self._window
        while True:
            start = 0 if width >= seam else next((i for i in range(seam - width, seam) if _stays(text, i)), None)
            end = len(text) if seam + width >= len(text) else next((i for i in range(seam + width, seam, -1) if i + 1 <= len(text) and _stays(text, i)), None)
            if start is not None and end is not None:
                keep, drop = self._before(left, len(text[start:seam].encode())), self._after(right, len(text[seam:end].encode()))
                return left[:keep] + self._encoding.encode_ordinary(text[start:end]) + right[drop:]
            if start is None and end is None and (joined := self._join_run(text[seam - width : seam + width], width, left, right)):
                return joined
            width *= 4

    def _join_run(self, around: str, width: int, left: list[int], right: list[int]) -> list[int] | None:
        """The join inside one run of a kind that reaches ``width`` characters to both sides."""
        if len({_kind(c) for c in around}) > 1 or "'" in around or _kind(around[0]) == _SPACE:
            return None
        room = [len(around[:width].encode()), len(around[width:].encode())]
        count = 4
        while True:
            i, j = max(1, len(left) - count), min(len(right) - 1, count)
            window = b"".join(map(self._bytes.__getitem__, left[i:] + right[:j]))
            used = (sum(len(self._bytes[t]) for t in left[i - 1 :]), sum(len(self._bytes[t]) for t in right[: j + 1]))
            if used[0] > room[0] or used[1] > room[1]:
                return None
            middle = self._encoding._encode_single_piece(window)
            if self._neighbours(left[i - 1], middle[0]) and self._neighbours(middle[-1], right[j]):
                return left[:i] + middle + right[j:]
            count *= 2

    def _neighbours(self, a: int, b: int) -> bool:
        return self._encoding._encode_single_piece(self._bytes[a] + self._bytes[b]) == [a, b]

    def _before(self, ids: list[int], size: int) -> int:
        """How many tokens stand before the last ``size`` bytes."""
        i = len(ids)
        while size > 0:
            i -= 1
            size -= len(self._bytes[ids[i]])
        assert size == 0, "a window begins inside a token"
        return i

    def _after(self, ids: list[int], size: int) -> int:
        i = 0
        while size > 0:
            size -= len(self._bytes[ids[i]])
            i += 1
        assert size == 0, "a window ends inside a token"
        return i


def _stays(text: str, i: int) -> bool:
    """Whether the pattern breaks before character ``i`` in any text with these two characters."""
    if i == 0 or i >= len(text):
        return True
    a, b = _kind(text[i - 1]), _kind(text[i])
    return a != b and (a in (_LETTER, _DIGIT) or a == _SIGN and b in (_DIGIT, _SPACE))


def parse_ranks(data: bytes) -> dict[bytes, int]:
    """The ranks of a file with a base64 token and its id per line."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in data.splitlines() if line)}


COLUMNS = {"ids": "binary", "decoded": "binary", "ids_sha256": "string", "decoded_sha256": "string"}


def _encoded(batch: pa.RecordBatch, codec: Codec, columns: Sequence[str]) -> pa.RecordBatch:
    counts, found = [], {c: [] for c in COLUMNS}
    for text in batch.column("text").to_pylist():
        ids = codec.encode(text or "")
        values = {"ids": np.array(ids, dtype="<u4").tobytes(), "decoded": codec.decode(ids)}
        counts.append(len(ids))
        for c in columns:
            found[c].append(values[c] if c in values else hashlib.sha256(values[c.removesuffix("_sha256")]).hexdigest())
    kinds = {"binary": pa.binary(), "string": pa.string()}
    return pa.RecordBatch.from_arrays([batch.column("key"), pa.array(counts, pa.int64()), *[pa.array(found[c], kinds[COLUMNS[c]]) for c in columns]], names=["key", "n_tokens", *columns])


def encode(docs: DataFrame, key: str, text: str, ranks_path: str, pattern: str, leaf: int = LEAF, columns: Sequence[str] = ("ids", "decoded")) -> DataFrame:
    """Token ids of each whole text and the bytes they decode to.

    Gives ``key``, ``n_tokens`` and of ``COLUMNS`` those asked for: ``ids`` (little-endian unsigned 32-bit integers), ``decoded``, and the SHA-256 of
    both in lower-case hex. One row per row: a null or empty text has no tokens, a null key stays null, repeated rows
    stay, other columns are left out, an empty table gives no rows. Texts are split inside their task, so memory holds one slice
    of whole texts; no shuffle.
    """
    with open(ranks_path, "rb") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())  # one public vocabulary, a fixed size
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared.value, pattern, leaf)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                yield _encoded(batch.slice(at, SLICE), codec, columns)

    schema = ", ".join(f"{c} {COLUMNS[c]}" for c in columns)
    narrow = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    return narrow.mapInArrow(run, f"key {kind}, n_tokens long, {schema}").withColumnRenamed("key", key)


@lru_cache(maxsize=2)
def _codec(data: bytes, pattern: str, leaf: int) -> Codec:
    return Codec(parse_ranks(data), pattern, leaf)
