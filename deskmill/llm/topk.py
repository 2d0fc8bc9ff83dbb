"""Exact top-k inner product search by branch and bound over columns.

Candidates lie in blocks in vertical layout: one row of the matrix per dimension. Against a block of queries the
products are summed up dimension block by dimension block, those with the largest mass first. No score can end above its
partial sum plus the product of the norms that remain (Cauchy-Schwarz); candidates that fall short of
what the query's k-th best is sure to reach are compacted away. Queries whose candidates would nearly all remain get whole products at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deskmill.session import durable_cut

CANDIDATE_BLOCK = 4096
QUERY_BLOCK = 128
DIMENSION_BLOCK = 16
EXACT = float(1 << 53)
LONG = (1 << 63) - 1
# Products of whole numbers up to here are exact in single precision.
EXACT_SINGLE = float(1 << 24)
# Norms below the first are surely multiplied in single precision, below the second in double precision.
CLASSES = (float(1 << 12), float(1 << 26))
# Queries that are multiplied at once, and components that one task holds (candidates) and reads (queries).
LANES = 1024
HELD = 16 << 20
ASKED = 32 << 20
# Products that are looked at while a core's cache still holds them.
TILE = 1 << 19
# Shares of candidates that may remain after the first dimension block for the bounds to pay.
PAYS = 0.02


class Best:
    """The ``k`` best so far of each query of a block: scores and ids in order, how many, and the ``sure`` score of the last."""

    def __init__(self, queries: int, k: int):
        self.k, self.have = k, np.zeros(queries, np.int64)
        self.scores, self.ids = np.zeros((queries, k), np.int64), np.zeros((queries, k), np.int64)
        self.sure = np.full(queries, -np.inf)

    def add(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """More scores of the queries at ``rows``, any number of them."""
        if not len(rows) or not self.k:
            return
        touched, rows = np.unique(rows, return_inverse=True)
        held = np.arange(self.k) < self.have[touched, None]
        rows = np.concatenate([np.nonzero(held)[0], rows])
        scores, ids = np.concatenate([self.scores[touched][held], scores.astype(np.int64)]), np.concatenate([self.ids[touched][held], ids])
        order = np.lexsort((ids, ~scores, rows))
        place = np.arange(len(rows)) - np.searchsorted(rows[order], rows[order])
        order, place = order[place < self.k], place[place < self.k]
        at = touched[rows[order]]
        self.scores[at, place], self.ids[at, place] = scores[order], ids[order]
        self.have[touched] = np.bincount(rows[order], minlength=len(touched))
        self.sure[touched] = np.where(self.have[touched] == self.k, self.scores[touched, self.k - 1], -np.inf)


class Block(NamedTuple):
    """Candidates in vertical layout. Behind the first dimension block stands a row with the norms that remain."""

    ids: np.ndarray
    matrix: np.ndarray
    rest: list[np.ndarray]
    norm: float


def _norms(matrix: np.ndarray, axis: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.sqrt((matrix.astype(np.float64) ** 2).sum(axis=axis))


def _rest(matrix: np.ndarray, width: int, kind: type) -> list[np.ndarray]:
    """Norms of what each step over the rows of ``matrix`` leaves, rounded up so that the bounds hold."""
    with np.errstate(over="ignore"):
        return [(_norms(matrix[at:], 0) * (1 + (1e-6 if kind == np.float32 else 1e-9))).astype(kind) for at in range(width, len(matrix), width)]


def _classed(norms: np.ndarray) -> np.ndarray:
    return np.searchsorted(CLASSES, norms, side="right")


def chunk_of(pieces: list[tuple[np.ndarray, np.ndarray]], order: np.ndarray, width: int = DIMENSION_BLOCK) -> list[list[Block]]:
    """Blocks of the candidates of all ``pieces`` (ids and a vertical matrix), by class of norm and then by id."""
    ids, matrix = np.concatenate([i for i, _ in pieces]), np.concatenate([m for _, m in pieces], axis=1)
    norms = np.concatenate([_norms(m, 0) for _, m in pieces])
    by_id, classes = np.argsort(ids, kind="stable"), _classed(norms)
    found: list[list[Block]] = []
    for n in range(len(CLASSES) + 1):
        places, kind = by_id[classes[by_id] == n], np.float64 if n else np.float32
        found.append([])
        for at in range(0, len(places), CANDIDATE_BLOCK):
            own = places[at : at + CANDIDATE_BLOCK]
            vertical = matrix[:, own][order].astype(np.float64)
            rest = _rest(vertical, width, kind)
            found[-1].append(Block(ids[own], np.concatenate([vertical[:width], *([r] for r in rest[:1]), vertical[width:]]).astype(kind), rest, norms[own].max()))
    return found


def _marked(marks: np.ndarray) -> np.ndarray:
    """Places of the few that are marked, eight looked at together."""
    if len(marks) % 8:
        return np.flatnonzero(marks)
    eights = np.flatnonzero(marks.view(np.uint64))
    which, inner = np.nonzero(marks.reshape(-1, 8)[eights])
    return eights[which] * 8 + inner


def _above(queries: np.ndarray, matrix: np.ndarray, bar: np.ndarray, most: float) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Rows, columns and values of the products above each row's ``bar``, in tiles that a core's cache holds; None for more than ``most``."""
    tiles = max(1, -(-matrix.shape[1] * len(queries) // TILE))
    wide = -(-matrix.shape[1] // tiles // 8) * 8 + 8 * (tiles > 1)
    found, count = [], 0
    sums, marks = np.empty(0), np.empty(0)
    for at in range(0, matrix.shape[1], wide):
        tile = np.ascontiguousarray(matrix[:, at : at + wide])
        if sums.shape != (shape := (len(queries), tile.shape[1])):
            sums, marks = np.empty(shape, queries.dtype), np.empty(shape, bool)
        places = _marked(np.greater(np.matmul(queries, tile, out=sums), bar[:, None], out=marks).reshape(-1))
        if len(places):
            rows, columns = np.divmod(places, tile.shape[1])
            found.append((rows, columns + at, sums.reshape(-1)[places]))
            if (count := count + len(places)) > most:
                return None
    if not found:
        return np.empty(0, int), np.empty(0, int), np.empty(0, queries.dtype)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _highest(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the ``k`` highest scores of each row, of equal ones the first. Minus infinity is no score."""
    if scores.shape[1] <= k:
        return np.nonzero(scores > -np.inf)
    least = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k, None]
    above, level = scores > least, (scores == least) & (least > -np.inf)
    level &= np.cumsum(level, axis=1, dtype=np.int32) <= k - np.count_nonzero(above, axis=1)[:, None]
    return np.nonzero(above | level)


def _whole_numbers(best: Best, places: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, block: Block, vectors: np.ndarray) -> None:
    """Scores that could leave the exactly held range, with whole numbers of any size and clipped to 64 bits."""
    whole = [[int(x) for x in v] for v in vectors.T]
    for place, query, own in zip(places, queries, query_ids, strict=True):
        numbers = [int(x) for x in query]
        exact = [max(-LONG - 1, min(LONG, sum(a * b for a, b in zip(numbers, v, strict=True)))) for v in whole]
        first = sorted((-s, i) for s, i in zip(exact, block.ids.tolist(), strict=True) if i != own)[: best.k]
        best.add(np.full(len(first), place), np.array([-s for s, _ in first], np.int64), np.array([i for _, i in first], np.int64))


def search(queries: np.ndarray, query_ids: np.ndarray, chunk: list[list[Block]], k: int, width: int = DIMENSION_BLOCK) -> Best:
    """The best ``k`` of a chunk for each query. ``queries`` has a row per query, its dimensions in the order of the chunk's.

    All numbers are integers, held so that every sum is exact: in single precision below 2^24, in doubles below 2^53.
    """
    best, norms = Best(len(queries), k), _norms(queries, 1)
    classes = _classed(norms)
    for n in np.unique(classes):
        places = np.flatnonzero(classes == n)
        # Ids ascend within a class of candidates, so that a later one loses a tie; only another class can bring a smaller id.
        ties = False
        for blocks in chunk:
            _search(best, places, queries[places], query_ids[places], norms[places].max(), blocks, ties, width)
            ties |= bool(blocks)
    return best


def _search(best: Best, places: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, norm: float, blocks: list[Block], ties: bool, width: int) -> None:
    kind, prunes = None, np.zeros(len(places), bool)
    for step, block in enumerate(blocks):
        most = max(1.0, norm) * max(1.0, block.norm)
        if not most < EXACT:
            inner = np.delete(block.matrix, width, axis=0) if block.rest else block.matrix
            _whole_numbers(best, places, queries, query_ids, block, inner)
            continue
        if kind is not (kind := np.float32 if block.matrix.dtype == np.float32 and most < EXACT_SINGLE else np.float64):
            rest = _rest(queries.T, width, kind)
            gap = np.zeros((len(queries), len(rest[:1])))
            whole = np.concatenate([queries[:, :width], gap, queries[:, width:]], axis=1).astype(kind)
            first = np.concatenate([queries[:, :width], *(r[:, None] for r in rest[:1])], axis=1).astype(kind)
        matrix = block.matrix.astype(kind, copy=False)
        bar = best.sure[places].astype(kind)
        bar = np.nextafter(bar, kind(-np.inf)) if ties else bar
        # What a bound can be short of by rounding.
        low = bar - kind((width + 4) * 4 * np.finfo(kind).eps * most)
        if block.rest and step & (step - 1) == 0 and not prunes.all():
            asked = np.flatnonzero(~prunes & (bar > -np.inf))
            prunes[asked] = np.mean(first[asked] @ matrix[: width + 1, :512] > low[asked, None], axis=1) < PAYS
        dense = ~prunes
        if prunes.any():
            own = np.flatnonzero(prunes)
            near = _above(first[own], matrix[: width + 1], low[own], PAYS * len(own) * matrix.shape[1] + best.k)
            if near is None:
                dense[own] = True
            else:
                rows, columns = own[near[0]], near[1]
                sums = np.zeros(len(rows), kind)
                for at in range(0, queries.shape[1], width):
                    inner = slice(at + (at >= width), min(at + width, queries.shape[1]) + (at >= width))
                    sums = sums + np.einsum("ij,ji->i", whole[rows, inner], matrix[inner, columns])
                    if at and at + width < queries.shape[1]:
                        keep = sums + rest[at // width][rows] * block.rest[at // width][columns].astype(kind) > low[rows]
                        rows, columns, sums = rows[keep], columns[keep], sums[keep]
                keep = (sums > bar[rows]) & (block.ids[columns] != query_ids[rows])
                best.add(places[rows[keep]], sums[keep], block.ids[columns[keep]])
        if dense.any():
            own = np.flatnonzero(dense)
            asked = whole if len(own) == len(whole) else whole[own]
            above = None if np.isneginf(bar[own]).any() else _above(asked, matrix, bar[own], 4 * best.k * len(own))
            if above is None:
                scores = asked @ matrix
                lows, highs = (np.searchsorted(block.ids, query_ids[own], side=side) for side in ("left", "right"))
                for row in np.flatnonzero(highs > lows):
                    scores[row, lows[row] : highs[row]] = -np.inf
                rows, columns = _highest(scores, best.k)
                sums = scores[rows, columns]
            else:
                rows, columns, sums = above
                keep = block.ids[columns] != query_ids[own[rows]]
                rows, columns, sums = rows[keep], columns[keep], sums[keep]
            best.add(places[own[rows]], sums, block.ids[columns])


def _floor(x: Column) -> Column:
    """The floor as a double; doubles beyond the range of ``floor`` are whole already."""
    return F.when(F.abs(x) < 2.0**62, F.floor(x).cast("double")).otherwise(x)


def _packed(rows: DataFrame, blocks: int, size: int = 0) -> DataFrame:
    """Rows dealt out in turn, whatever they hold, and a row per block and length: ids and one vertical matrix. Written.

    A block is what a task gets, or ``size`` rows of it; few tasks then make many blocks. Components are held in 16 bits where
    they fit, else as doubles.
    """
    tasks = min(blocks, max(64, -(-blocks // 16))) if size else blocks
    # Blocks of a task; numbers of blocks go on from task to task.
    each = -(-blocks // tasks)

    def made(dims: int, block: int, ids: list[np.ndarray], vectors: list[np.ndarray]) -> pa.RecordBatch:
        matrix = np.concatenate(vectors).T
        kind = "<i2" if (np.abs(matrix) < 1 << 15).all() else "<f8"
        found = [[dims], [block], [np.concatenate(ids).astype("<i8").tobytes()], [np.ascontiguousarray(matrix, dtype=kind).tobytes()]]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(found, (pa.int32(), pa.int32(), pa.binary(), pa.binary()), strict=True)], names=["dims", "block", "ids", "matrix"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list, list]] = {}
        number = TaskContext.get().partitionId() * each
        for batch in batches:
            ids, edges = batch.column("id").to_numpy(), batch.column("vector").offsets.to_numpy()
            vectors = batch.column("vector").flatten().to_numpy()
            lengths, starts = np.diff(edges), edges[:-1] - edges[0]
            for dims in np.unique(lengths).tolist():
                rows = np.flatnonzero(lengths == dims)
                own, matrices = held.setdefault(dims, ([], []))
                own.append(ids[rows])
                matrices.append(vectors[starts[rows, None] + np.arange(dims)])
                while size and sum(map(len, own)) >= size:
                    own, matrices = np.concatenate(own), np.concatenate(matrices)
                    yield made(dims, number, [own[:size]], [matrices[:size]])
                    own, matrices = held[dims] = ([own[size:]], [matrices[size:]])
                    number += 1
        for dims, (own, matrices) in held.items():
            if any(map(len, own)):
                yield made(dims, number, own, matrices)

    return durable_cut(rows.repartition(tasks).mapInArrow(pack, "dims int, block int, ids binary, matrix binary"))


def _unpacked(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """Ids and the vertical matrix of a block."""
    ids = np.frombuffer(row["ids"], dtype="<i8")
    kind = "<i2" if len(row["matrix"]) == 2 * row["dims"] * len(ids) else "<f8"
    return ids, np.frombuffer(row["matrix"], dtype=kind).reshape(row["dims"], len(ids))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, key: str = "vec_id", vector: str = "embedding", scale: float = 256.0, candidate_block: int = CANDIDATE_BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """The ``k`` highest integer inner products of each query: ``query_id``, ``rank`` from 1, ``vec_id``, ``score``.

    Components become ``floor(scale * x)``. Ties go to the smaller id; all candidates if there are fewer than ``k``; a query
    does not meet rows with its own id. Vectors that are null, empty, or hold null or non-finite components, and rows with a null
    id, take no part; vectors of different lengths do not meet. Repeated candidate rows are candidates of their own, repeated
    queries with the same id and vector count once. Empty tables give no rows.
    """
    dims = {"candidate": candidate_block, "query": query_block}

    def valid(df: DataFrame) -> DataFrame:
        usable = F.col(key).isNotNull() & (F.size(vector) > 0) & F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
        scaled = F.transform(F.col(vector), lambda c: _floor(F.lit(scale) * c.cast("double")))
        return df.filter(F.coalesce(usable, F.lit(False))).select(F.col(key).cast("long").alias("id"), scaled.alias("vector"))

    given = {"candidate": vectors, "query": queries}
    sides = {"candidate": valid(vectors), "query": valid(queries).dropDuplicates(["id", "vector"])}
    packed, counts, components = {}, {}, {}
    for name, rows in sides.items():
        counts[name] = max(1, -(-given[name].count() // dims[name]))
        packed[name] = _packed(rows, counts[name], dims[name])
        components[name] = (packed[name].agg(F.sum(F.col("dims") * F.octet_length("ids").cast("long"))).first()[0] or 0) // 8
    # The stated query set against all rows: a task holds a part of the candidates while a group of the queries passes by. Blocks go
    # there by number, queries after candidates; no side is broadcast, and none is joined into pairs of matrices.
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    parts = min(counts["candidate"], cores * max(2, -(-components["candidate"] // (HELD * cores))))
    groups = max(1, -(-components["query"] // ASKED))
    part, group = F.pmod("block", F.lit(parts)), F.pmod("block", F.lit(groups))
    every = {name: F.explode(F.sequence(F.lit(0), F.lit(n - 1))) for name, n in (("candidate", groups), ("query", parts))}
    held = packed["candidate"].select("dims", F.lit(False).alias("asked"), "ids", "matrix", part.alias("part"), every["candidate"].alias("group"))
    asked = packed["query"].select("dims", F.lit(True).alias("asked"), "ids", "matrix", every["query"].alias("part"), group.alias("group"))
    cells = held.unionAll(asked).select((F.col("part") * groups + F.col("group")).alias("cell"), "dims", "asked", "ids", "matrix")
    cells = cells.repartitionById(parts * groups, "cell").sortWithinPartitions("cell", "dims", "asked")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def best_of(chunk: list[list[Block]], order: np.ndarray, waiting: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
            ids = np.concatenate([i for i, _ in waiting])
            best = search(np.concatenate([m for _, m in waiting], axis=1)[order].T.astype(np.float64), ids, chunk, k)
            rows, columns = np.nonzero(np.arange(k) < best.have[:, None])
            return pa.RecordBatch.from_arrays([pa.array(c) for c in (ids[rows], best.ids[rows, columns], best.scores[rows, columns])], names=["query_id", "vec_id", "score"])

        rows = (row for batch in batches for row in batch.to_pylist())
        for _, cell in groupby(rows, key=lambda row: (row["cell"], row["dims"])):
            pieces, waiting, chunk, order = [], [], None, None
            for row in cell:
                block = _unpacked(row)
                if not row["asked"]:
                    pieces.append(block)
                    continue
                if not (pieces or chunk):
                    break  # no candidates of this length
                if chunk is None:
                    mass = sum((m.astype(np.float64) ** 2).sum(axis=1) for _, m in pieces) * (block[1].astype(np.float64) ** 2).sum(axis=1)
                    order = np.argsort(-mass, kind="stable")
                    chunk, pieces = chunk_of(pieces, order), []
                waiting.append(block)
                if sum(len(i) for i, _ in waiting) >= LANES:
                    yield best_of(chunk, order, waiting)
                    waiting = []
            if waiting:
                yield best_of(chunk, order, waiting)

    best = cells.mapInArrow(run, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
