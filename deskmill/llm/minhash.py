"""Near copies by word shingles: bands of min-max signatures name the candidates, whole sets of shingles decide.

Each permutation gives two values of a signature, the smallest and the largest hash of a set, so that half the permutations do; both
agree between two sets with a probability that is their Jaccard similarity. Rows of one set are one node. Nodes that share a
band lie in one cluster; clusters are laid out in blocks, and two blocks that share a band with nodes not linked
yet meet in one task. It compares whole sets and gives a spanning forest of the links, so that no pair of nodes becomes a row.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskmill.llm.common import bytes_of, chunks, total_bytes
from deskmill.llm.components import components
from deskmill.session import discard, durable_cut

SEED = 42
# Links need an intersection of at least so many percent of the union.
PERCENT = 85
# Chance that a pair that is just similar enough shares no band.
MISSED = 1e-6
SLICE = 1 << 12
# Nodes and bytes of shingles in one block, and bytes of texts that one task lays out in blocks.
BLOCK_NODES, BLOCK_BYTES, LAID_BYTES = 1024, 2 << 20, 8 << 20
# Bytes of a hash.
_WORD = 8


def shingles(text: bytes, words_per_shingle: int = 5) -> np.ndarray:
    """The XXH64 of each distinct shingle of a text, sorted; a shorter text is one shingle, one without a word has none."""
    words = text.lower().split()
    size = min(words_per_shingle, len(words))
    if not words:
        return np.zeros(0, dtype=np.uint64)
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts, ends = (ends - lengths)[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, ends, strict=True)), dtype=np.uint64, count=len(starts)))


class Bands:
    """Bands of a min-max signature: enough of ``rows`` values each for all but ``MISSED`` of the pairs at ``percent``."""

    def __init__(self, percent: int = PERCENT, rows: int | None = None):
        share = percent / 100
        self.rows = rows or (6 if percent >= 85 else 5 if percent >= 75 else 4)
        needed = 1 if share >= 1 else ceil(log(MISSED) / log(1 - share**self.rows))
        self.permutations = self.rows * -(-needed // 2)
        self.bands = 2 * self.permutations // self.rows
        draw = np.random.default_rng(SEED)
        self._flip, self._odd = (draw.integers(0, 1 << 64, size=self.permutations, dtype=np.uint64) for _ in range(2))
        self._odd |= np.uint64(1)
        self._mix = draw.integers(0, 1 << 64, size=self.rows + 1, dtype=np.uint64) | np.uint64(1)

    def signature(self, found: np.ndarray) -> np.ndarray:
        """The smallest hash under each permutation, then the largest ones."""
        low, high = np.full(self.permutations, np.iinfo(np.uint64).max, dtype=np.uint64), np.zeros(self.permutations, dtype=np.uint64)
        for at in range(0, len(found), SLICE):
            hashes = (found[at : at + SLICE, None] ^ self._flip) * self._odd
            low, high = np.minimum(low, hashes.min(axis=0)), np.maximum(high, hashes.max(axis=0))
        return np.concatenate([low, high])

    def of(self, found: np.ndarray) -> np.ndarray:
        """A number for each band; none for an empty set."""
        if not len(found):
            return np.zeros(0, dtype=np.uint64)
        values = self.signature(found).reshape(self.bands, self.rows)
        mixed = (values ^ (values >> np.uint64(32))) * self._mix[: self.rows]
        return mixed.sum(axis=1, dtype=np.uint64) + np.arange(self.bands, dtype=np.uint64) * self._mix[self.rows]


def _lists(values: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in values]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(values).view(np.int64)))


def sketches(docs: DataFrame, key: str, text: str, bands: Bands, words_per_shingle: int = 5) -> DataFrame:
    """``key``, ``text_hash``, ``node`` (the same for equal sets), ``n`` (shingles) and ``bands`` of each row; no shuffle."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for places, texts in chunks(range(batch.num_rows), bytes_of(batch.column("text"))):
                found = [shingles(x, words_per_shingle) for x in texts]
                nodes = np.array([xxhash.xxh64_intdigest(x.tobytes(), SEED) for x in found], dtype=np.uint64).view(np.int64)
                columns = [*(batch.column(c).slice(places[0], len(places)) for c in ("key", "text_hash")), pa.array(nodes), pa.array([len(x) for x in found], pa.int64()), _lists([bands.of(x) for x in found])]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "text_hash", "node", "n", "bands"])

    narrow = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"), F.xxhash64(text).alias("text_hash"))
    return narrow.mapInArrow(run, f"key {kind}, text_hash long, node long, n long, bands array<long>")


def alike(left: list[np.ndarray], right: list[np.ndarray] | None, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (those of ``right`` count on from ``left``) of all pairs of sets that are similar enough, without pairs inside a list if there are two."""
    sets = left + (right or [])
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    values, owner = np.concatenate([*sets, np.zeros(0, dtype=np.uint64)]), np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    begins = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))) if len(values) else np.zeros(0, dtype=np.int64)
    counts = np.diff(np.append(begins, len(values)))
    group = np.repeat(np.arange(len(begins)), counts)
    # Shingles that only one set has link nothing; the others, by set.
    held = np.flatnonzero((counts > 1)[group]) if len(group) else group
    held = held[np.argsort(owner[held], kind="stable")]
    edges = np.searchsorted(owner[held], np.arange(len(sets) + 1))
    first = 0 if right is None else len(left)
    for i in range(len(left)):
        own = group[held[edges[i] : edges[i + 1]]]
        if 100 * len(own) < percent * sizes[i] or not len(own):
            continue
        lengths = counts[own]
        ends = np.cumsum(lengths)
        places = np.arange(ends[-1]) - np.repeat(ends - lengths, lengths) + np.repeat(begins[own], lengths)
        common = np.bincount(owner[places], minlength=len(sets))
        near = np.flatnonzero(100 * common >= percent * (sizes[i] + sizes - common))
        near = near[near >= max(first, i + 1)]
        if len(near):
            yield np.full(len(near), i), near


def forest(count: int, links: Iterator[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The places that are linked to a smaller one, and the smallest that each reaches."""
    label = np.arange(count)
    for i, j in links:
        # All links of a step are those of one place.
        reached = np.unique(np.concatenate([label[i], label[j]]))
        if len(reached) > 1:
            label[np.isin(label, reached)] = reached[0]
    moved = np.flatnonzero(label != np.arange(count))
    return moved, label[moved]


def _blocks(met: DataFrame, words_per_shingle: int) -> DataFrame:
    """``block``, ``nodes`` and their packed sets (``sizes``, ``data``), laid out by cluster. Written."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, nodes, sets, size = TaskContext.get().partitionId() << 32, [], [], 0

        def row() -> pa.RecordBatch:
            data = zstandard.ZstdCompressor(level=1).compress(np.concatenate(sets).tobytes())
            columns = [pa.array([made], pa.int64()), pa.array([nodes], pa.list_(pa.int64())), pa.array([[len(s) for s in sets]], pa.list_(pa.int64())), pa.array([data], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["block", "nodes", "sizes", "data"])

        for batch in batches:
            for node, text in zip(batch.column("node").to_pylist(), bytes_of(batch.column("text")), strict=True):
                nodes.append(node)
                sets.append(shingles(text, words_per_shingle))
                size += _WORD * len(sets[-1])
                if len(nodes) >= BLOCK_NODES or size >= BLOCK_BYTES:
                    yield row()
                    made, nodes, sets, size = made + 1, [], [], 0
        if nodes:
            yield row()

    # Ranges of a small table are put together again, so that blocks are full.
    tasks = max(1, -(-total_bytes(met, "text") // LAID_BYTES))
    laid = met.repartitionByRange("cluster", "node").sortWithinPartitions("cluster", "node").select("node", "text").coalesce(tasks)
    return durable_cut(laid.mapInArrow(cut, "block long, nodes array<long>, sizes array<long>, data binary"))


def _opened(sizes: list[int], data: bytes) -> list[np.ndarray]:
    values = np.frombuffer(zstandard.ZstdDecompressor().decompress(data, max_output_size=max(1, _WORD * sum(sizes))), dtype=np.uint64)
    return np.split(values, np.cumsum(sizes)[:-1])


def _linked(rows: DataFrame, percent: int) -> DataFrame:
    """Links ``a``, ``b`` that connect all similar nodes of a block, or those of one block with those of another (``l_…``)."""
    two = "l_nodes" in rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                nodes, sets, others = row["nodes"], _opened(row["sizes"], row["data"]), None
                if two:
                    others = _opened(row["l_sizes"], row["l_data"])
                    nodes = nodes + row["l_nodes"]
                names = np.array(nodes, dtype=np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(names[x]) for x in forest(len(names), alike(sets, others, percent))], names=["a", "b"])

    # A task finds few links, so they are written together.
    return rows.mapInArrow(run, "a long, b long").hint("rebalance")


def similar_links(docs: DataFrame, nodes: DataFrame, text: str, percent: int, words_per_shingle: int, also: DataFrame | None = None) -> DataFrame:
    """Links ``a``, ``b`` that connect all nodes that share a band and are similar enough; see ``near_duplicates``."""
    filed = nodes.select("node", F.explode("bands").alias("band"))
    if also is not None:
        # Groups of another kind are bands of their own.
        filed = filed.unionByName(also.join(nodes, "text_hash").select("node", F.xxhash64(F.lit("also"), "group").alias("band")))
    filed = durable_cut(filed)
    shared = filed.groupBy("band").agg(F.count("*").alias("members"), F.min("node").alias("lead")).filter("members > 1").select("band", "lead")
    buckets = durable_cut(filed.join(shared, "band").select("band", "node", "lead"))
    discard(filed)
    clusters = components(buckets.select(F.col("node").alias("a"), F.col("lead").alias("b"))).withColumnRenamed("root", "cluster")

    # One text of each node that shares a band.
    wanted = nodes.join(clusters, "node").select("node", "cluster", F.col("text_hash").alias("wanted"))
    texts = docs.select(F.xxhash64(text).alias("text_hash"), F.col(text).cast("string").alias("text")).groupBy("text_hash").agg(F.any_value("text").alias("text"))
    met = durable_cut(texts.join(wanted, F.col("text_hash") == F.col("wanted")).select("cluster", "node", "text"))
    blocks = _blocks(met, words_per_shingle)
    discard(met)
    within = durable_cut(_linked(blocks, percent))

    # Only blocks that share a band in which some nodes are still apart have to meet.
    places = blocks.select("block", F.explode("nodes").alias("node"))
    roots = components(within).withColumnRenamed("node", "linked")
    placed = places.join(roots, F.col("node") == F.col("linked"), "left").select("node", "block", F.coalesce("root", "node").alias("root"))
    spread = durable_cut(buckets.select("band", "node").join(placed, "node").groupBy("band", "block").agg(F.min("root").alias("low"), F.max("root").alias("high")))
    mixed = spread.groupBy("band").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.count("*").alias("n")).filter("n > 1 AND low < high").select("band")
    apart = spread.join(mixed, "band").select("band", "block")
    pairs = apart.select("band", F.col("block").alias("l_block")).join(apart, "band").filter("l_block < block").select("l_block", "block").distinct()
    left = blocks.select(*[F.col(c).alias(f"l_{c}") for c in blocks.columns])
    across = durable_cut(_linked(pairs.join(left, "l_block").join(blocks, "block"), percent))
    discard(buckets, spread, blocks)
    return within.unionAll(across)


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT, words_per_shingle: int = 5, also: DataFrame | None = None) -> DataFrame:
    """``key``, ``text_hash`` (XXH64 of the text), ``n_shingles``, ``component`` and ``component_id`` of every row.

    ASCII letters are lower-cased; a row's set holds its distinct shingles of ``words_per_shingle`` words, a shorter text is one shingle. Rows are
    linked if 100 times the intersection is at least ``percent`` times the union; ``component`` is a number for the rows that reach each
    other, ``component_id`` the smallest key among them, which a null key never is. Texts without a word (or null) are linked with nothing:
    ``component`` is null, ``component_id`` their own key. Repeated rows stay; an empty table gives no rows. Links are exact (shingles
    are compared as 64-bit hashes); a pair that shares no band is missed, see ``MISSED``. ``also`` may hold a ``group`` for each ``text_hash``:
    rows of one group are candidates too.
    """
    prints = durable_cut(sketches(docs, key, text, Bands(percent), words_per_shingle))
    full = prints.filter("n > 0")
    nodes = durable_cut(full.groupBy("node").agg(F.min("key").alias("first"), F.min("text_hash").alias("text_hash"), F.any_value("bands").alias("bands")))
    roots = components(similar_links(docs, nodes, text, percent, words_per_shingle, also)).withColumnRenamed("node", "linked")
    rooted = durable_cut(nodes.join(roots, F.col("node") == F.col("linked"), "left").select("node", "first", F.coalesce("root", "node").alias("component")))
    smallest = rooted.groupBy("component").agg(F.min("first").alias("component_id"))
    found = rooted.join(smallest, "component").select("node", "component", "component_id")
    columns = [F.col("key").alias(key), "text_hash", F.col("n").alias("n_shingles")]
    empty = prints.filter("n = 0").select(*columns, F.lit(None).cast("long").alias("component"), F.col("key").alias("component_id"))
    return full.join(found, "node").select(*columns, "component", "component_id").unionByName(empty)
