"""Fill-in-middle: texts cut into prefix, middle and suffix at drawn code points, and put together in another order.

Cuts are given in code points, texts are bytes. The UTF-8 of many texts is viewed as 64-bit words: a byte ends a code point if the one
after it continues none, which arithmetic on whole words marks in eight bytes at once. Set bits per word, added up, tell the word
that holds a wanted code point; its place among the word's eight marks is then counted inside the word.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskmill.llm.common import bytes_of, chunks

# Prefix, suffix, middle.
MARKS = ("<P>", "<S>", "<M>")
SEED = 1
# Of 100 texts so many are changed, and of 100 changed ones so many begin with the suffix.
CHANGED, SUFFIX_FIRST = 90, 20
PLAIN, PSM, SPM = "plain", "psm", "spm"

_ONES, _HIGH = np.uint64(0x0101010101010101), np.uint64(0x8080808080808080)
# The last byte of a text's last word is filler and ends nothing.
_NOT_LAST = np.uint64(0x00FFFFFFFFFFFFFF)


def _filled(text: bytes) -> bytes:
    """The text in whole words: behind it a byte that begins a code point, then bytes that continue one."""
    return text + b"\0" + b"\x80" * (7 - len(text) % 8)


class Units:
    """The code points of texts that lie end to end in 64-bit words."""

    def __init__(self, texts: Sequence[bytes]):
        words = np.frombuffer(b"".join([_filled(t) for t in texts]), dtype="<u8").astype(np.uint64)
        # The first word of each text, and one beyond the last.
        self._first = np.concatenate(([0], np.cumsum([len(t) // 8 + 1 for t in texts], dtype=np.int64)))
        begins = ~((words >> np.uint64(7)) & (~words >> np.uint64(6))) & _ONES
        following = np.concatenate([begins[1:], np.zeros(min(1, len(begins)), dtype=np.uint64)])
        self._ends = (begins >> np.uint64(8)) | ((following & np.uint64(1)) << np.uint64(56))
        self._ends[self._first[1:] - 1] &= _NOT_LAST
        self._upto = np.concatenate(([0], np.cumsum(np.bitwise_count(self._ends), dtype=np.int64)))

    def counts(self) -> np.ndarray:
        """Code points of each text."""
        return self._upto[self._first[1:]] - self._upto[self._first[:-1]]

    def bytes_before(self, cuts: np.ndarray) -> np.ndarray:
        """Bytes of the first ``cuts[i]`` code points of text ``i``."""
        wanted = self._upto[self._first[:-1]] + cuts
        at = np.maximum(np.searchsorted(self._upto, wanted, side="left") - 1, 0)
        # Byte j of the sums holds the marks up to byte j; those below the wanted number lie before it.
        sums = self._ends[at] * _ONES
        below = (wanted - self._upto[at] - 1).astype(np.uint64)
        before = np.bitwise_count((((below * _ONES) | _HIGH) - sums) & _HIGH)
        return np.where(cuts > 0, 8 * (at - self._first[:-1]) + before + 1, 0)


def draws(key: object, seed: int = SEED) -> tuple[int, int, int, int]:
    """Four numbers below 2 to the 32 from the SHA-256 of seed and key; a null key is empty."""
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).digest()
    return tuple(int.from_bytes(digest[at : at + 4], "big") for at in (0, 4, 8, 12))


def _checked(marks: Sequence[str]) -> list[bytes]:
    found = [m.encode() for m in marks]
    if len(set(found)) != 3 or not all(found):
        raise ValueError("three marks are needed, each another one")
    for a, b in [*permutations(found, 2), *((m, m) for m in found)]:
        if (a != b and a in b) or any(a.endswith(b[:n]) for n in range(1, min(len(a), len(b)))):
            raise ValueError("a mark must not hold another one, nor end as one begins")
    return found


def fill_in_middle(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = SEED, changed: int = CHANGED, suffix_first: int = SUFFIX_FIRST, marks: Sequence[str] = MARKS) -> DataFrame:
    """``key``, ``n`` (code points), ``form``, ``prefix_chars``, ``middle_chars`` and ``output`` of every whole text.

    Two draws by seed and key cut a text of ``n`` code points after any of 0 to ``n`` of them, the smaller one ends the prefix, the larger one
    the middle. ``psm`` is mark, prefix, mark, suffix, mark, middle; ``spm`` has the suffix first; ``plain`` is the text itself: where it is empty,
    holds a mark, or a third draw falls on one of the ``100 - changed`` percent left as they are; lengths are null there. A null text is
    empty, a null key is drawn for as an empty one, rows with the same key and text get the same form, an empty table gives no rows. No
    shuffle; a task holds some MB of texts, or one longer text. Marks must not overlap each other, so that ``restored`` finds them.
    """
    kind = docs.schema[key].dataType.simpleString()
    prefix_mark, suffix_mark, middle_mark = _checked(marks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column("name").to_pylist()
            for places, texts in chunks(range(batch.num_rows), bytes_of(batch.column("text"))):
                at, size = places[0], len(places)
                drawn = np.array([draws(names[i], seed) for i in places], dtype=np.int64).T
                units = Units(texts)
                n = units.counts()
                first, second = drawn[0] % (n + 1), drawn[1] % (n + 1)
                low, high = np.minimum(first, second), np.maximum(first, second)
                plain = (n == 0) | (drawn[2] % 100 >= changed) | np.array([any(m in t for m in (prefix_mark, suffix_mark, middle_mark)) for t in texts])
                suffix_leads = drawn[3] % 100 < suffix_first
                outputs = []
                for t, a, b, same, leads in zip(texts, units.bytes_before(low).tolist(), units.bytes_before(high).tolist(), plain.tolist(), suffix_leads.tolist(), strict=True):
                    if same:
                        outputs.append(t)
                    elif leads:
                        outputs.append(b"".join([suffix_mark, t[b:], prefix_mark, t[:a], middle_mark, t[a:b]]))
                    else:
                        outputs.append(b"".join([prefix_mark, t[:a], suffix_mark, t[b:], middle_mark, t[a:b]]))
                forms = np.where(plain, PLAIN, np.where(suffix_leads, SPM, PSM))
                columns = [batch.column("key").slice(at, size), pa.array(n), pa.array(forms), pa.array(low, mask=plain), pa.array(high - low, mask=plain), pa.array(outputs, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "n", "form", "prefix_chars", "middle_chars", "output"])

    narrow = docs.select(F.col(key).alias("key"), F.col(key).cast("string").alias("name"), F.col(text).cast("string").alias("text"))
    found = narrow.mapInArrow(run, f"key {kind}, n long, form string, prefix_chars long, middle_chars long, output string")
    return found.withColumnRenamed("key", key)


def restored(output: Column, form: Column, marks: Sequence[str] = MARKS) -> Column:
    """The text that ``fill_in_middle`` made ``output`` of; null for a form it does not know."""
    prefix_mark, suffix_mark, middle_mark = (F.lit(m) for m in marks)

    def part(value: Column, mark: Column, number: int) -> Column:
        return F.split_part(value, mark, F.lit(number))

    psm, spm = part(output, suffix_mark, 2), part(output, prefix_mark, 2)
    middle = part(output, middle_mark, 2)
    psm_text = F.concat(part(part(output, suffix_mark, 1), prefix_mark, 2), middle, part(psm, middle_mark, 1))
    spm_text = F.concat(part(spm, middle_mark, 1), middle, part(part(output, prefix_mark, 1), suffix_mark, 2))
    return F.when(form == PLAIN, output).when(form == PSM, psm_text).when(form == SPM, spm_text)
