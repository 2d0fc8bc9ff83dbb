"""Language of a text from unigrams of pieces, summed over all segmentations.

The pieces come from a fixed public vocabulary. Each language has a probability for each piece; that of a word is the sum over
all ways to cut it into pieces, found by the forward algorithm. The probabilities are fitted by expectation and
maximisation, with Spark counting the words and summing what is expected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from deskmill.session import durable_cut

# A word is a run of letters with their marks; longer runs are scored in parts.
LETTERS = r"\p{L}[\p{L}\p{M}]*"
WORD_CHARS = 48
WORD_START = "▁"
UNKNOWN = 1e-7
SMOOTHING = 0.1
ROUNDS = 4
SAMPLE = 1000
CACHE = 400_000
UND = "und"
SLICE = 512
_FIND = regex.compile(LETTERS)


def vocabulary(model_path: str) -> list[str]:
    """Lower-case pieces of a public SentencePiece model, without its control, unknown and byte pieces."""
    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    ids = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    return sorted({p for p in map(model.id_to_piece, ids) if p and p == p.lower()})


class Pieces:
    """A trie of the pieces over arrays, walked for many words at once."""

    def __init__(self, pieces: list[str]):
        self.codes = {c: i + 1 for i, c in enumerate(sorted({c for p in pieces for c in p}))}
        nodes: dict[tuple[int, int], int] = {}
        ends: dict[int, int] = {}
        for number, piece in enumerate(pieces):
            at = 0
            for char in piece:
                at = nodes.setdefault((at, self.codes[char]), len(nodes) + 1)
            ends[at] = number
        self.wide = len(self.codes) + 1
        steps = sorted((at * self.wide + code, to) for (at, code), to in nodes.items())
        self._from, self._to = (np.array(x, dtype=np.int64) for x in zip(*steps, strict=True)) if steps else (np.zeros(0, np.int64),) * 2
        self._end = np.full(len(nodes) + 1, -1, dtype=np.int64)
        self._end[list(ends)] = list(ends.values())
        self._first = np.full(self.wide, -1, dtype=np.int64)
        top = self._from < self.wide
        self._first[self._from[top]] = self._to[top]
        self.longest = max(map(len, pieces), default=0)

    def edges(self, words: list[str]) -> tuple[np.ndarray, list[tuple[int, int, np.ndarray, np.ndarray]]]:
        """Lengths of the words with their start mark, and all pieces in them: from, to, words, pieces (by place and length)."""
        marked = [WORD_START + w for w in words]
        sizes = np.fromiter(map(len, marked), dtype=np.int64, count=len(marked))
        if not len(sizes):
            return sizes, []
        grid = np.zeros((len(marked), sizes.max()), dtype=np.int64)
        flat = np.fromiter((self.codes.get(c, 0) for w in marked for c in w), dtype=np.int64, count=int(sizes.sum()))
        grid[np.arange(grid.shape[1]) < sizes[:, None]] = flat
        found = []
        for start in range(grid.shape[1]):
            rows = np.flatnonzero(sizes > start)
            at = self._first[grid[rows, start]]
            for end in range(start + 1, min(start + self.longest, grid.shape[1]) + 1):
                if end > start + 1:
                    keep = sizes[rows] >= end
                    rows, at = rows[keep], at[keep]
                    steps = at * self.wide + grid[rows, end - 1]
                    place = np.minimum(np.searchsorted(self._from, steps), len(self._from) - 1)
                    known = self._from[place] == steps
                    rows, at = rows[known], self._to[place[known]]
                else:
                    rows, at = rows[at >= 0], at[at >= 0]
                if not len(rows):
                    break
                ended = self._end[at]
                whole = ended >= 0
                if whole.any():
                    found.append((start, end, rows[whole], ended[whole]))
        return sizes, found


@lru_cache(maxsize=2)
def _trie(pieces: tuple[str, ...]) -> Pieces:
    return Pieces(list(pieces))


def _forward(sizes: np.ndarray, edges: list, shares: np.ndarray) -> np.ndarray:
    """Sum over the segmentations of the beginning of each word up to each place, per language."""
    sums = np.zeros((int(sizes.max()) + 1, len(sizes), shares.shape[1]))
    sums[0] = 1.0
    at = 0
    for start in range(sums.shape[0] - 1):
        sums[start + 1] += sums[start] * UNKNOWN  # any one character may stand for itself
        while at < len(edges) and edges[at][0] == start:
            _, end, rows, pieces = edges[at]
            sums[end, rows] += sums[start, rows] * shares[pieces]
            at += 1
    return sums


def word_scores(words: list[str], trie: Pieces, shares: np.ndarray) -> np.ndarray:
    """Log of each word's probability in each language; ``shares`` has a row per piece."""
    if not words:
        return np.zeros((0, shares.shape[1]))
    sizes, edges = trie.edges(words)
    return np.log(_forward(sizes, edges, shares)[sizes, np.arange(len(sizes))])


def _expected(words: list[str], counts: np.ndarray, trie: Pieces, shares: np.ndarray) -> np.ndarray:
    """How often each piece is expected in the words, over all their segmentations."""
    sizes, edges = trie.edges(words)
    ahead = _forward(sizes, edges, shares)[:, :, 0]
    back = np.zeros_like(ahead)
    back[sizes, np.arange(len(sizes))] = 1.0
    at = len(edges) - 1
    for start in range(ahead.shape[0] - 2, -1, -1):
        inside = sizes > start
        back[start, inside] += back[start + 1, inside] * UNKNOWN
        while at >= 0 and edges[at][0] == start:
            _, end, rows, pieces = edges[at]
            back[start, rows] += back[end, rows] * shares[pieces, 0]
            at -= 1
    found, total = np.zeros(len(shares)), ahead[sizes, np.arange(len(sizes))]
    for start, end, rows, pieces in edges:
        weight = counts[rows] * ahead[start, rows] * shares[pieces, 0] * back[end, rows] / total[rows]
        found += np.bincount(pieces, weights=weight, minlength=len(shares))
    return found


@dataclass(frozen=True)
class Model:
    """Languages, the pieces, and the share of each piece (rows) in each language (columns)."""

    languages: list[str]
    pieces: tuple[str, ...]
    shares: np.ndarray


def split_words(text: str) -> list[str]:
    found = _FIND.findall(text.lower())
    if any(len(w) > WORD_CHARS for w in found):
        found = [w[at : at + WORD_CHARS] for w in found for at in range(0, len(w), WORD_CHARS)]
    return found


def train(docs: DataFrame, pieces: list[str], text: str = "text", lang: str = "lang", sample: int = SAMPLE, rounds: int = ROUNDS) -> Model:
    """Fit the shares on about ``sample`` rows per language, chosen by hash of the whole row's text and key.

    Rows without a language, a text or a letter teach nothing. The number of languages bounds what comes to the driver.
    """
    known = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(*docs.columns).alias("draw"))
    sizes = {row["lang"]: row["n"] for row in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Model([], tuple(pieces), np.zeros((len(pieces), 0)))
    share = F.create_map(*[F.lit(x) for name, n in sizes.items() for x in (name, min(1.0, sample / n))])
    drawn = known.filter(F.pmod("draw", F.lit(1 << 31)) < share[F.col("lang")] * float(1 << 31))
    words = drawn.select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(LETTERS), F.lit(0))).alias("word"))
    parts = words.select("lang", F.explode(F.regexp_extract_all("word", F.lit(f"(?s).{{1,{WORD_CHARS}}}"), F.lit(0))).alias("word"))
    counted = durable_cut(parts.groupBy("lang", "word").agg(F.count("*").alias("n")))
    languages, fixed = sorted(sizes), tuple(pieces)
    shares = np.full((len(pieces), len(languages)), 1.0 / max(1, len(pieces)))
    place = {name: i for i, name in enumerate(languages)}
    for _ in range(rounds):
        held = docs.sparkSession.sparkContext.broadcast(shares)  # languages times a fixed vocabulary

        def expect(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            trie, sums = _trie(fixed), np.zeros_like(held.value)
            for batch in batches:
                column = np.array([place[x] for x in batch.column("lang").to_pylist()], dtype=np.int64)
                found, counts = batch.column("word").to_pylist(), batch.column("n").to_numpy().astype(float)
                for language in np.unique(column):
                    rows = np.flatnonzero(column == language)
                    sums[:, language] += _expected([found[i] for i in rows], counts[rows], trie, held.value[:, [language]])
            piece, language = np.nonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array(piece), pa.array(language), pa.array(sums[piece, language])], names=["piece", "language", "expected"])

        sums = np.full_like(shares, SMOOTHING)
        rows = counted.mapInArrow(expect, "piece long, language long, expected double").groupBy("piece", "language").agg(F.sum("expected").alias("expected"))
        for row in rows.collect():
            sums[row["piece"], row["language"]] += row["expected"]
        shares = sums / sums.sum(axis=0)
    return Model(languages, fixed, shares)


class _Scorer:
    """Scores of words, kept for those seen lately."""

    def __init__(self, model: Model):
        self.model, self.trie = model, _trie(model.pieces)
        self.empty()

    def empty(self) -> None:
        self.place: dict[str, int] = {}
        self.scores = np.zeros((0, len(self.model.languages)))

    def texts(self, texts: list[list[str]]) -> np.ndarray:
        """Log-likelihood of each text's words in each language."""
        if len(self.place) > CACHE:
            self.empty()
        fresh = list(dict.fromkeys(w for words in texts for w in words if w not in self.place))
        if fresh:
            self.place.update(zip(fresh, range(len(self.place), len(self.place) + len(fresh)), strict=True))
            self.scores = np.concatenate([self.scores, word_scores(fresh, self.trie, self.model.shares)])
        sizes = [len(words) for words in texts]
        at = np.fromiter((self.place[w] for words in texts for w in words), dtype=np.int64, count=sum(sizes))
        sums = np.concatenate([np.zeros((1, self.scores.shape[1])), np.cumsum(self.scores[at], axis=0)])
        ends = np.cumsum([0, *sizes])
        return sums[ends[1:]] - sums[ends[:-1]]


def with_language(docs: DataFrame, model: Model, text: str = "text", columns: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with the language of every whole text and its posterior under equal priors (0 to 1) in two more ``columns``.

    A text that is null or has no letter gets ``und`` and 0, as does every text when nothing was learned. Ties go to the language that is
    first by name. All rows and columns stay (``columns`` must be new names); an empty table stays empty. No shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        scorer = _Scorer(model)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                words = [split_words(t or "") for t in part.column(text).to_pylist()]
                names, scores = [UND] * len(words), np.zeros(len(words))
                if model.languages:
                    sums = scorer.texts(words)
                    best = sums.argmax(axis=1)
                    scores = 1.0 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
                    scores[[not w for w in words]] = 0.0
                    names = [model.languages[b] if w else UND for b, w in zip(best, words, strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(names, pa.string()), pa.array(scores)], names=[*part.schema.names, *columns])

    more = [StructField(columns[0], StringType()), StructField(columns[1], DoubleType())]
    return docs.mapInArrow(run, StructType([*docs.schema.fields, *more]))
