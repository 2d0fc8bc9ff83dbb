"""Mixing sources to target weights by nested hash thresholds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deskmill.session import durable_cut

# Hex digits of the hash that one level of the histogram looks at, and the levels.
DIGITS = 3
LEVELS = 4


def _hash(key: Column) -> Column:
    """Hex digits that depend on nothing but the key; null has its own."""
    return F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, DIGITS * LEVELS)


def _same(a: str, b: str) -> Column:
    return F.col(f"{a}.source").eqNullSafe(F.col(f"{b}.source"))


def targets(sizes: DataFrame, weights: Sequence[int] = (1, 2, 3), most: float = 3.0) -> DataFrame:
    """What each source shall give: ``source``, ``source_size``, ``target``.

    ``sizes`` has a row per source (``source``, ``source_size``). Sources in code point order, null last,
    weigh ``weights`` in turn and share the sum of all sizes; none gets more than ``most`` times its size, and
    what is above goes to the others by weight until none is above. That is one common level: the target is
    the smaller of the limit and weight times level, so the sources are ordered by limit / weight once.
    """
    # The windows run over one row per source, not over documents.
    named = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.row_number().over(named) - 1, F.lit(len(weights))) + 1).cast("int"))
    limited = sizes.withColumn("weight", place).withColumn("limit", most * F.col("source_size"))
    order = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    all_rows = Window.partitionBy()
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(all_rows) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    levelled = limited.withColumn("level", level).withColumn("open", F.col("level") <= F.col("limit") / F.col("weight"))
    reached = F.min(F.when(F.col("open"), F.struct(F.col("limit") / F.col("weight"), "level"))).over(all_rows)["level"]
    target = F.when(F.col("source_size") == 0, 0.0).otherwise(F.least(F.col("limit"), F.coalesce(reached, F.lit(float("inf"))) * F.col("weight")))
    return levelled.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, key: str, size: Column, source: str, weights: Sequence[int] = (1, 2, 3), most: int = 3, prefix: str = "mix") -> DataFrame:
    """How often the mix takes each document: all columns of ``docs`` plus ``mix_*`` (no column of ``docs`` may begin with ``prefix``).

    ``mix_size``, ``mix_source_size``, ``mix_target`` (of the source) and ``mix_times``. Every document is taken
    ``floor(target / source size)`` times, and once more if its hash is below the source's threshold. The thresholds
    come from histograms of sizes by source and leading hash digits; each level refines only the one bucket in which
    the rest of the budget ends, so that nothing is sorted. A bucket that is not refined further stays out: a source
    falls short of its target by less than the last boundary bucket, for keys that differ one document.

    The hash sees only the key: repeated rows are taken alike, a null key counts as an empty one. A null source is a
    source of its own; sizes are never negative, documents of size 0 go with their hash. An empty table stays empty.
    """
    sized = docs.select(F.col(source).alias("source"), _hash(F.col(key)).alias("hash"), size.alias("size"))
    # The first histogram has all that the targets need; it is the only pass that reads the texts for all rows.
    narrow = durable_cut(sized.groupBy("source", "hash").agg(F.sum("size").alias("size")))
    sums = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    goal = targets(sums, weights, most)
    times = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(most))).otherwise(0)
    budget = goal.withColumn("times", times.cast("long")).withColumn("rest", F.col("target") - F.col("times") * F.col("source_size"))
    state = durable_cut(budget.withColumn("prefix", F.lit("")))
    for level in range(1, LEVELS + 1):
        # The prefix is part of the key, so that rows of a large source are spread from the second level on; the first
        # level looks at all rows and needs no join.
        inside = narrow.withColumn("prefix", F.substring("hash", 1, DIGITS * (level - 1)))
        if level > 1:
            inside = inside.alias("n").join(state.alias("s"), _same("n", "s") & (F.col("n.prefix") == F.col("s.prefix"))).select("n.*")
        sums = inside.groupBy("source", F.substring("hash", 1, DIGITS * level).alias("bucket")).agg(F.sum("size").alias("size"))
        # At most 16 ** DIGITS buckets of a source stand in its window.
        running = F.sum("size").over(Window.partitionBy("source").orderBy("bucket"))
        over = sums.withColumn("up_to", running).alias("b").join(state.alias("s"), _same("b", "s")).filter("up_to > rest")
        first = over.groupBy("b.source").agg(F.min(F.struct("bucket", (F.col("up_to") - F.col("size")).alias("below"))).alias("hit"))
        refined = state.alias("s").join(first.alias("f"), _same("s", "f"), "left")
        # Without a bucket over the rest all of the prefix goes in: "g" is above every hex digit.
        refined_prefix = F.when(F.col("hit").isNull(), F.concat("prefix", F.lit("g"))).otherwise(F.col("hit.bucket"))
        rest = F.when(F.col("hit").isNull(), 0.0).otherwise(F.col("rest") - F.col("hit.below"))
        state = durable_cut(refined.select("s.source", "source_size", "target", "times", rest.alias("rest"), refined_prefix.alias("prefix")))
    own = {c: f"{prefix}_{c}" for c in ("size", "source", "source_size", "target", "times", "threshold")}
    named = state.withColumnRenamed("prefix", "threshold")
    plan = named.select(*[F.col(c).alias(own[c]) for c in ("source", "source_size", "target", "times", "threshold")])
    taken = docs.withColumn(own["size"], size).join(plan, F.col(source).eqNullSafe(F.col(own["source"])), "left")
    more = (_hash(F.col(key)) < F.col(own["threshold"])).cast("long")
    times = F.least(F.col(own["times"]) + more, F.lit(most)).cast("long")
    return taken.withColumn(own["times"], times).drop(own["source"], own["threshold"])
