"""Trees kept as parent links: roots and depths, the order of a tour, cycles, task lists, nested tabs.

Every round doubles the distance a node's pointer spans: it takes over what the node it points to knows. A tree of depth ``d`` is done in about
``log2(d)`` joins of the nodes that are still on their way, rows keep their width, and a round in which none arrives proves that the rest lies
on or under a cycle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskmill.operators.running import CHUNK, Running, ranged, running
from deskmill.session import durable_cut


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def resolve_roots(nodes: DataFrame) -> DataFrame:
    """``id, root, depth`` for nodes ``id, parent``, and with a column ``weight`` its sum from the root down in ``total``.

    Nodes on or below a cycle, and below a parent that is not among them, get nulls.
    """
    weighted = "weight" in nodes.columns
    weight = F.col("weight") if weighted else F.lit(0).cast("bigint")
    state = nodes.select("id", F.col("parent").alias("up"), F.when(F.col("parent").isNull(), F.col("id")).alias("root"), F.lit(0).alias("depth"), weight.alias("total"))
    state = durable_cut(state)
    open_ = state.filter("up IS NOT NULL")
    left, arrived = open_.count(), [state.filter("up IS NULL")]
    while left:
        # Those that have arrived tell the rest of the way.
        known = _union([*arrived, open_]).select("id", *[F.col(c).alias(f"_{c}") for c in ("up", "root", "depth", "total")]).withColumnRenamed("id", "_id")
        moved = durable_cut(
            open_.join(known, F.col("up") == F.col("_id"), "left").select(
                "id",
                F.col("_up").alias("up"),
                F.col("_root").alias("root"),
                (F.col("depth") + F.col("_depth") + 1).alias("depth"),
                (F.col("total") + F.col("_total")).alias("total"),
            )
        )
        arrived.append(moved.filter("up IS NULL"))
        rest = moved.filter("up IS NOT NULL")
        still = rest.count()
        if still == left:
            arrived.append(rest.withColumn("depth", F.lit(None).cast("int")).withColumn("total", F.lit(None).cast("bigint")))
            break
        open_, left = rest, still
    return _union(arrived).select("id", "root", "depth", *(["total"] if weighted else []))


def subtree_sizes(nodes: DataFrame) -> DataFrame:
    """``id, size`` for nodes ``id, parent``: the nodes below each one and itself. Without meaning on cycles.

    A node counts those less than 2^k below it; in each round it gets the counts of those just 2^k below.
    """
    open_ = durable_cut(nodes.filter("parent IS NOT NULL").select("id", F.col("parent").alias("up"), F.lit(1).cast("bigint").alias("n")))
    left, parts = open_.count(), [nodes.select("id", F.lit(1).cast("bigint").alias("n"))]
    while left:
        received = open_.groupBy(F.col("up").alias("id")).agg(F.sum("n").alias("n"))
        parts.append(received)
        ahead = open_.select(F.col("id").alias("up"), F.col("up").alias("_up"))
        more = received.withColumnRenamed("n", "_n")
        moved = open_.join(ahead, "up").join(more, "id", "left")
        open_ = durable_cut(moved.select("id", F.col("_up").alias("up"), (F.col("n") + F.coalesce("_n", F.lit(0))).alias("n")))
        still = open_.count()
        if still == left:
            break
        left = still
    return _union(parts).groupBy("id").agg(F.sum("n").alias("size"))


def tour(nodes: DataFrame) -> DataFrame:
    """``id, root, depth, place, n_below``: the tour of all trees, depth first, for nodes ``id, parent, sibling``.

    Siblings, and the roots, follow each other by ``sibling`` and id. ``place`` counts from 1 over all trees; what lies below a node has the
    ``n_below`` places after its own. Nodes without a root have nulls.
    """
    group = F.coalesce(F.concat(F.lit("p"), F.col("parent").cast("string")), F.lit("top"))
    sized = nodes.join(subtree_sizes(nodes), "id").select("id", "parent", "sibling", "size", group.alias("_group"))
    # A parent may have any number of children, so they are added up range by range.
    before = {"_before": Running("sum", F.col("size"), before=True)}
    placed = durable_cut(running(ranged(sized, ["_group"], ["sibling", "id"]), ["_group"], ["sibling", "id"], F.col(CHUNK), before))
    weighted = placed.select("id", "parent", (F.coalesce("_before", F.lit(0)) + 1).alias("weight"))
    found = resolve_roots(weighted).withColumnRenamed("total", "place")
    below = F.when(F.col("place").isNotNull(), F.col("size") - 1).alias("n_below")
    return found.join(placed.select("id", "size"), "id").select("id", "root", "depth", "place", below)


def cycles(nodes: DataFrame) -> DataFrame:
    """``id, cycle_id, on_cycle`` of the nodes ``id, parent`` that all lie on or below a cycle; the id is the smallest one on the cycle.

    After as many steps as there are nodes every pointer is on a cycle, and every node of a cycle has one that points to it; the smallest
    id seen on the way is then that of the whole cycle for the nodes on it.
    """
    state = durable_cut(nodes.select("id", F.col("parent").alias("up"), F.col("id").alias("low")))
    count, steps = state.count(), 1
    while steps < count:
        ahead = state.select(F.col("id").alias("up"), F.col("up").alias("_up"), F.col("low").alias("_low"))
        state, steps = durable_cut(state.join(ahead, "up").select("id", F.col("_up").alias("up"), F.least("low", "_low").alias("low"))), 2 * steps
    on = state.join(state.select(F.col("up").alias("id")).distinct(), "id").select(F.col("id").alias("reached"), F.col("low").alias("cycle_id"))
    named = state.join(on, F.col("up") == F.col("reached")).select("id", "cycle_id")
    return named.join(on.select(F.col("reached").alias("id"), F.lit(True).alias("_on")), "id", "left").select("id", "cycle_id", F.coalesce("_on", F.lit(False)).alias("on_cycle"))


def with_placeholders(tasks: DataFrame) -> DataFrame:
    """Tasks plus one placeholder at top level per parent that is not among them."""
    parents = tasks.filter(F.col("parent").isNotNull()).select(F.col("parent").alias("id")).distinct()
    missing = parents.join(tasks.select("id"), "id", "left_anti").withColumn("is_placeholder", F.lit(True))
    return tasks.withColumn("is_placeholder", F.lit(False)).unionByName(missing, allowMissingColumns=True)


def _sibling_key(position: Column, node: Column) -> Column:
    """Sorts by position, those without one last, ties by id."""
    placed = F.concat(F.lit("0"), F.lpad(position.cast("decimal(20,0)").cast("string"), 20, "0"))
    ident = F.when(node.try_cast("bigint").isNotNull(), F.lpad(node, 20, "0")).otherwise(node)
    return F.concat(F.coalesce(placed, F.lit("1")), F.lit(":"), ident)


def task_tree(tasks: DataFrame) -> DataFrame:
    """Tasks and placeholders with root, depth, ``place`` in the tour of all trees and ``n_below``, and what cycles they belong to.

    ``tasks`` has ``id, parent, position`` and any other columns. Tasks on a cycle and below one never reach the top level; they have no root, depth
    or place but the ``cycle_id``, and ``in_cycle`` or ``below_cycle``.
    """
    full = with_placeholders(tasks)
    sibling = _sibling_key(F.col("position"), F.col("id").cast("string"))
    found = durable_cut(tour(full.select("id", "parent", sibling.alias("sibling"))))
    lost = found.filter("root IS NULL").select("id").join(full.select("id", "parent"), "id")
    on = cycles(lost)
    joined = full.join(found, "id").join(on, "id", "left")
    marks = {"in_cycle": F.coalesce("on_cycle", F.lit(False)), "below_cycle": F.coalesce(~F.col("on_cycle"), F.lit(False))}
    return joined.withColumns(marks).drop("on_cycle")


def ordered_tree(tasks: DataFrame) -> DataFrame:
    """``task_tree`` sorted for display."""
    return task_tree(tasks).orderBy("place")


def task_rollup(tasks: DataFrame) -> DataFrame:
    """Per root: sub-tasks, depth, completed share, earliest due date; orphans under placeholders.

    ``tasks`` also has ``status`` and ``due``. A placeholder is no task and is not counted.
    """
    full = with_placeholders(tasks)
    tree = full.join(resolve_roots(full.select("id", "parent")).filter("root IS NOT NULL"), "id")
    real, top = ~F.col("is_placeholder"), F.col("id") == F.col("root")
    return tree.groupBy("root").agg(
        F.count_if(real & ~top).alias("n_subtasks"),
        F.max("depth").alias("max_depth"),
        F.round(F.count_if(real & (F.col("status") == "completed")) / F.count_if(real), 6).alias("completed_share"),
        F.min("due").alias("earliest_due"),
        F.bool_or("is_placeholder").alias("orphaned"),
    )


def document_tabs_text(docs: DataFrame, tabs: DataFrame) -> DataFrame:
    """Document text followed by its tabs in pre-order, each under a header with its depth shown.

    ``docs`` has ``doc_id, text``; ``tabs`` has ``doc_id, tab_id, parent_id, pos, title, text``. The
    result is one text per document. Blank bodies are left out.
    """

    def node(tab: str) -> Column:
        return F.concat(F.col("doc_id").cast("string"), F.lit("/"), F.col(tab).cast("string"))

    keyed = tabs.withColumn("id", node("tab_id"))
    segment = F.concat(F.lpad(F.col("pos").cast("string"), 20, "0"), F.lit(":"), F.col("tab_id").cast("string"))
    places = tour(keyed.select("id", node("parent_id").alias("parent"), segment.alias("sibling")))
    deep = F.concat(
        F.repeat(F.lit("    "), F.col("depth")), F.col("title"), F.lit(" ( ID: "), F.col("tab_id").cast("string"), F.lit(")")
    )
    name = F.when(F.col("depth") > 0, deep).otherwise(F.col("title"))
    # Tabs that the tour does not reach come last, without a depth.
    place = F.coalesce(F.concat(F.lit("1"), F.lpad(F.col("place").cast("string"), 20, "0")), F.concat(F.lit("2"), segment))
    parts = (
        keyed.join(places.select("id", "depth", "place"), "id")
        .select(
            "doc_id",
            place.alias("place"),
            F.concat(F.lit("\n--- TAB: "), name, F.lit(" ---\n"), F.coalesce("text", F.lit(""))).alias("part"),
        )
    )
    bodies = docs.filter(F.trim("text") != "").select("doc_id", F.lit("0").alias("place"), F.col("text").alias("part"))
    return (
        bodies.unionByName(parts)
        .groupBy("doc_id")
        .agg(F.expr("listagg(part, '') WITHIN GROUP (ORDER BY place)").alias("text"))
    )
