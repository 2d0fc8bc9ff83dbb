"""SimHash near-duplicates: fingerprints, and a self-join of their binary trie."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskmill.llm.common import bytes_of
from deskmill.llm.components import components
from deskmill.session import durable_cut

BITS = 64
SEED = 42
SLICE = 1 << 16
# Fingerprints in one node of the upper trie, and the node pairs a task looks at in one step.
NODE = 4096
FRONTIER = 1 << 20


def fingerprint(text: bytes, words_per_shingle: int = 3) -> int:
    """Majority bits of the XXH64 of all shingles of a text, repeats included; 0 without a word."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    size = min(words_per_shingle, len(words))
    starts, ends = (ends - lengths)[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist()
    digest, counts = xxhash.xxh64_digest, np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(starts), SLICE):
        hashes = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts[at : at + SLICE], ends[at : at + SLICE], strict=True)])
        bits = np.unpackbits(np.frombuffer(hashes, dtype=np.uint8).reshape(-1, BITS // 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(counts * 2 > len(starts)).tobytes(), "big")


def fingerprints(docs: DataFrame, key: str, text: str, words_per_shingle: int = 3) -> DataFrame:
    """``key`` and ``fingerprint`` (as a signed long) of each row; no shuffle."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(x, words_per_shingle) for x in bytes_of(batch.column("text"))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(found.view(np.int64))], names=["key", "fingerprint"])

    narrow = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    return narrow.mapInArrow(run, f"key {kind}, fingerprint long").withColumnRenamed("key", key)


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int64)


def trie_links(a: np.ndarray, b: np.ndarray, budget: int, itself: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of all pairs of two sorted arrays of fingerprints within ``budget`` differing bits.

    A node of the trie is a range of the sorted array. Both tries are gone through together from the root: pairs of nodes
    are split at the next bit, each crossing costs one bit of the budget, and pairs above it are dropped. With ``itself``
    the two arrays are one, and a pair is met once.
    """
    ones = [[np.concatenate(([0], np.cumsum((x >> np.uint64(BITS - 1 - bit)) & np.uint64(1)).astype(np.int64))) for x in (a, b)] for bit in range(BITS)]
    stack = [(0, np.array([[0], [len(a)], [0], [len(b)], [0]], dtype=np.int64))] if len(a) and len(b) else []
    while stack:
        bit, pairs = stack.pop()
        if pairs.shape[1] > FRONTIER:
            stack += [(bit, half) for half in np.array_split(pairs, 2, axis=1)]
            continue
        a_lo, a_hi, b_lo, b_hi, spent = pairs
        single = (a_hi - a_lo == 1) & (b_hi - b_lo == 1)
        i, j = a_lo[single], b_lo[single]
        near = _distance(a[i], b[j]) <= budget
        if itself:
            near &= i < j
        if near.any():
            yield i[near], j[near]
        pairs = pairs[:, ~single]
        if not pairs.shape[1]:
            continue
        a_lo, a_hi, b_lo, b_hi, spent = pairs
        a_mid = a_hi - (ones[bit][0][a_hi] - ones[bit][0][a_lo])
        b_mid = b_hi - (ones[bit][1][b_hi] - ones[bit][1][b_lo])
        children = []
        for left, right, cost in (((a_lo, a_mid), (b_lo, b_mid), 0), ((a_mid, a_hi), (b_mid, b_hi), 0), ((a_lo, a_mid), (b_mid, b_hi), 1), ((a_mid, a_hi), (b_lo, b_mid), 1)):
            keep = (left[0] < left[1]) & (right[0] < right[1]) & (spent + cost <= budget)
            if itself:  # of two mirrored pairs the one with the smaller node first
                keep &= left[0] <= right[0]
            children.append(np.stack([left[0], left[1], right[0], right[1], spent + cost])[:, keep])
        stack.append((bit + 1, np.concatenate(children, axis=1)))


def _forest(count: int, links: Iterator[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """A star forest with the same components as the links: each linked place and the smallest one it reaches."""
    label = np.arange(count)
    for i, j in links:
        while True:
            low = np.minimum(label[i], label[j])
            before = label.copy()
            np.minimum.at(label, label[i], low)
            np.minimum.at(label, label[j], low)
            label = label[label]
            while not np.array_equal(label, label[label]):
                label = label[label]
            if np.array_equal(before, label):
                break
    moved = np.flatnonzero(label != np.arange(count))
    return moved, label[moved]


def near_links(distinct: DataFrame, budget: int = 2, node: int = NODE) -> DataFrame:
    """Links ``a``, ``b`` that connect all fingerprints within ``budget`` bits, as their components are.

    ``distinct`` holds each ``fingerprint`` once. The upper levels of the trie are laid out over the cluster: fingerprints are cut in
    sorted order into nodes of at most ``node`` with a common prefix, and two nodes meet in one task if their prefixes do not spend
    the budget. That task goes through the two subtries and gives a spanning forest of the links it finds, so that a dense group
    does not become all its pairs.
    """
    count = distinct.count()
    top = min(24, max(0, (-(-count // node) - 1).bit_length()))
    parts = max(1, min(4096, count // (4 * node)))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch.column("fingerprint").to_numpy() for batch in batches]
        found = np.sort(np.concatenate(held).view(np.uint64)) if held else np.zeros(0, dtype=np.uint64)
        prefix = found >> np.uint64(BITS - top) if top else np.zeros(len(found), dtype=np.uint64)
        edges = [0, *(np.flatnonzero(np.diff(prefix)) + 1).tolist(), len(found)]
        rows = [found[at : min(at + node, hi)] for lo, hi in zip(edges, edges[1:], strict=False) for at in range(lo, hi, node)]
        rows = [x for x in rows if len(x)]
        fixed = [BITS - int(x[0] ^ x[-1]).bit_length() for x in rows]
        columns = [
            pa.array([int(x[0]) >> (BITS - top) if top else 0 for x in rows], pa.int64()),
            pa.array([int(x[:1].view(np.int64)[0]) for x in rows], pa.int64()),
            pa.array(fixed, pa.int32()),
            pa.array([x.tobytes() for x in rows], pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["prefix", "low", "fixed", "members"])

    # The cut of a partition is written, so that a lost executor cannot shift the borders of the nodes.
    nodes = durable_cut(distinct.select("fingerprint").repartitionByRange(parts, "fingerprint").mapInArrow(cut, "prefix long, low long, fixed int, members binary"))
    masks = [sum(1 << bit for bit in bits) for size in range(budget + 1) for bits in combinations(range(top), size)]
    other = F.explode(F.filter(F.transform(F.array(*[F.lit(m).cast("long") for m in masks]), lambda m: F.col("prefix").bitwiseXOR(m)), lambda p: p >= F.col("prefix")))
    left = nodes.select(other.alias("with"), *[F.col(c).alias(f"l_{c}") for c in nodes.columns])
    met = left.join(nodes, F.col("with") == F.col("prefix")).filter((F.col("l_prefix") < F.col("prefix")) | (F.col("l_low") <= F.col("low")))
    common = F.least("l_fixed", "fixed")
    spent = F.bit_count(F.when(common == 0, 0).otherwise(F.expr("shiftrightunsigned(l_low ^ low, 64 - least(l_fixed, fixed))")))
    pairs = met.filter(spent <= budget).select("l_low", "low", "l_members", "members")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                a, b = (np.frombuffer(row[c], dtype=np.uint64) for c in ("l_members", "members"))
                itself = row["l_low"] == row["low"]
                both = a if itself else np.concatenate([a, b])
                shift = 0 if itself else len(a)
                links = ((i, j + shift) for i, j in trie_links(a, b, budget, itself))
                ends = _forest(len(both), links)
                yield pa.RecordBatch.from_arrays([pa.array(both[x].view(np.int64)) for x in ends], names=["a", "b"])

    return pairs.mapInArrow(walk, "a long, b long")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", budget: int = 2, words_per_shingle: int = 3) -> DataFrame:
    """``key``, ``fingerprint`` (16 hex digits) and ``component_id`` of every row.

    ASCII letters are lower-cased; shingles are ``words_per_shingle`` words, a shorter text is one shingle, a text without words (or null)
    has the fingerprint 0 and is linked like any other. Rows whose fingerprints differ in at most ``budget`` bits are linked;
    ``component_id`` is the smallest key reachable, which a null key never is (it is null if no key is reachable). Repeated rows stay;
    an empty table gives no rows.
    """
    prints = durable_cut(fingerprints(docs, key, text, words_per_shingle))
    # One row per fingerprint from here on: exact copies, however many, are one node.
    firsts = durable_cut(prints.groupBy("fingerprint").agg(F.min(key).alias("first")))
    roots = durable_cut(components(near_links(firsts, budget)))
    rooted = firsts.join(roots, F.col("fingerprint") == F.col("node"), "left").select("fingerprint", "first", F.coalesce("root", "fingerprint").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    found = rooted.join(smallest, "root").select("fingerprint", "component_id")
    shown = F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint")
    return prints.join(found, "fingerprint").select(F.col(key), shown, "component_id")
