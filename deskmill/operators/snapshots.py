"""Differences of two snapshots of a table, found by a tree of digests.

Keys are dealt to leaves by their hash, leaves to nodes. A leaf's digest is made of its rows' hashes and can be added up in any order, a
node's of its leaves. Where two digests are equal so are the rows, and these are neither joined nor, in snapshots written with their digests, read again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Leaves of a tree, and leaves below one node, which is one folder of a written snapshot.
LEAVES, FANOUT = 1 << 12, 1 << 6
DIGEST = ("n", "x", "s")


def _leaf(key: str) -> Column:
    return F.pmod(F.xxhash64(F.lit("leaf"), key), F.lit(LEAVES)).cast("int")


def _node() -> Column:
    return F.floor(F.col("_leaf") / FANOUT).cast("int")


def _hash(key: str, columns: Sequence[str], seed: str) -> Column:
    # A hash passes over nulls, so that each column says whether it has one.
    return F.xxhash64(F.lit(seed), key, *[x for c in columns for x in (F.col(c), F.col(c).isNull())])


def _digested(rows: DataFrame, sign: Column) -> list[Column]:
    """Number, combined hashes, and their sum; all are zero over the rows of two equal sides of opposite sign."""
    half = F.call_function("shiftright", F.col("_h2"), F.lit(24))
    return [F.sum(sign).alias("n"), F.bit_xor("_h1").alias("x"), F.sum(sign * half.cast("decimal(38,0)")).alias("s")]


def _marked(df: DataFrame, key: str, columns: Sequence[str], side: int) -> DataFrame:
    return df.select(key, *columns, F.lit(side).alias("_side"), _leaf(key).alias("_leaf"), _hash(key, columns, "one").alias("_h1"), _hash(key, columns, "two").alias("_h2"))


def _differs() -> Column:
    return (F.col("n") != 0) | (F.col("x") != 0) | (F.col("s") != 0)


def _one_each(rows: DataFrame, key: str, columns: Sequence[str], mark: str) -> DataFrame:
    twice = F.raise_error(F.concat(F.lit(f"several rows of {key} "), F.col(key).cast("string")))
    whole = F.struct(*columns)
    return rows.groupBy(key).agg(F.when(F.count("*") > 1, twice).otherwise(F.first(whole)).alias(mark))


def _changes(old: DataFrame, new: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """``key, kind, field, old, new`` (as text): a row per field that differs, one without a field for a key on one side only."""
    both = _one_each(old, key, columns, "_old").join(_one_each(new, key, columns, "_new"), key, "full")

    def entry(c: str) -> Column:
        a, b = F.col(f"_old.{c}"), F.col(f"_new.{c}")
        return F.when(~a.eqNullSafe(b), F.struct(F.lit("changed").alias("kind"), F.lit(c).alias("field"), a.cast("string").alias("old"), b.cast("string").alias("new")))

    nothing = F.lit(None).cast("string")
    one_side = [F.when(F.col(m).isNull(), F.struct(F.lit(kind).alias("kind"), nothing.alias("field"), nothing.alias("old"), nothing.alias("new"))) for m, kind in (("_old", "added"), ("_new", "removed"))]
    found = F.coalesce(*[F.when(c.isNotNull(), F.array(c)) for c in one_side], F.array_compact(F.array(*[entry(c) for c in columns])))
    return both.select(key, F.explode(found).alias("c")).select(key, "c.*")


def snapshot_changes(old: DataFrame, new: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """What differs between two tables: ``key, kind`` (``added``, ``removed``, ``changed``), ``field, old, new``.

    Only rows of leaves whose digests differ are joined. Keys are unique and not null; a repeated one among these rows is an error.
    """
    rows = _marked(old, key, columns, 1).unionByName(_marked(new, key, columns, -1))
    leaves = rows.groupBy("_leaf").agg(*_digested(rows, F.col("_side"))).filter(_differs()).select("_leaf")
    apart = rows.join(leaves, "_leaf", "left_semi")
    return _changes(apart.filter("_side = 1"), apart.filter("_side = -1"), key, columns)


def write_snapshot(df: DataFrame, path: str, key: str) -> str:
    """Write ``df`` in a folder per node, and the digests of its leaves next to it; returns ``path``."""
    columns = [c for c in df.columns if c != key]
    rows = _marked(df, key, columns, 1)
    rows.select(*df.columns, "_leaf", _node().alias("_node")).repartition("_node", F.floor(F.col("_leaf") / 8)).write.partitionBy("_node").parquet(f"{path}/rows")
    rows.groupBy("_leaf").agg(*_digested(rows, F.lit(1))).coalesce(1).write.parquet(f"{path}/digests")
    return path


def differing_leaves(spark: SparkSession, old: str, new: str) -> DataFrame:
    """``_node, _leaf`` of the leaves that differ: nodes are compared first, then the leaves below those that differ."""
    sides = [spark.read.parquet(f"{p}/digests").withColumns({"_node": _node(), "n": F.col("n") * sign, "s": F.col("s") * sign}) for p, sign in ((old, 1), (new, -1))]
    both = sides[0].unionByName(sides[1])

    def summed(by: Sequence[str], rows: DataFrame) -> DataFrame:
        return rows.groupBy(*by).agg(F.sum("n").alias("n"), F.bit_xor("x").alias("x"), F.sum("s").alias("s")).filter(_differs())

    return summed(["_node", "_leaf"], both.join(summed(["_node"], both).select("_node"), "_node", "left_semi")).select("_node", "_leaf")


def changes_between(spark: SparkSession, old: str, new: str, key: str) -> DataFrame:
    """``snapshot_changes`` of two written snapshots with the same columns; only folders with leaves that differ are read."""
    leaves = differing_leaves(spark, old, new).collect()  # at most LEAVES rows
    nodes = sorted({r["_node"] for r in leaves})
    sides = [spark.read.parquet(f"{p}/rows") for p in (old, new)]
    kept = F.col("_node").isin(nodes) & F.col("_leaf").isin([r["_leaf"] for r in leaves])
    columns = [c for c in sides[0].columns if c not in (key, "_leaf", "_node")]
    return _changes(*[s.filter(kept) for s in sides], key, columns)
