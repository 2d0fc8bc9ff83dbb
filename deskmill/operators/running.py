"""Ordered computations over groups of any size.

A plain window puts a whole group into one task. Here every group is cut into chunks by a
monotone expression of its order column (for example ``position div 8192`` or the day of a
timestamp). Rows are windowed inside ``(group, chunk)`` only; one aggregate row per chunk is
windowed over the group, and that carry is joined back. A group holding a third of the table
is therefore spread over as many tasks as it has chunks.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deskmill.session import durable_cut

CHUNK = "_chunk"
CHUNK_ROWS = 8192


@dataclass(frozen=True)
class Running:
    """One ordered computation.

    ``kind`` is one of

    * ``sum``, ``max``, ``min``: over the rows up to and including this one,
      or only the rows before it (``before=True``);
    * ``lag``, ``lead``: value of the neighbouring row;
    * ``last_before``: last non-null value in the rows up to and including this one;
    * ``min_after``: smallest value in the rows after this one;
    * ``group_sum``, ``group_first``: the same value for all rows of the group.
    """

    kind: str
    value: Column
    before: bool = False


def by_position(column: str, rows: int = CHUNK_ROWS) -> Column:
    """Chunk number of an integer position."""
    return F.floor(F.col(column) / rows)


def by_time(column: str, unit: str = "day") -> Column:
    """Chunk of a timestamp: its hour, day, week ..."""
    return F.date_trunc(unit, F.col(column))


def ranged(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``df`` written in ranges of about equal size along ``keys`` and ``order``, numbered in ``CHUNK``.

    The borders come from a sample of the rows, so a group that is dense at one place is cut there
    more finely. Written, so that every pass sees the same borders.
    """
    return durable_cut(df.repartitionByRange(*keys, *order).withColumn(CHUNK, F.spark_partition_id()))


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    chunk: Column,
    computations: dict[str, Running],
) -> DataFrame:
    """``df`` with one column per computation, ordered by ``order`` inside ``keys``.

    ``order`` must be unique inside a group, ``chunk`` must not decrease along it, and the keys
    must not be null.
    """
    rows = df.withColumn(CHUNK, chunk)
    groups = [F.col(k) for k in keys]
    inner = Window.partitionBy(*groups, CHUNK).orderBy(*order)
    outer = Window.partitionBy(*groups).orderBy(CHUNK)
    sort_key = F.struct(*order)
    so_far = (Window.unboundedPreceding, Window.currentRow)
    earlier = (Window.unboundedPreceding, -1)
    later = (1, Window.unboundedFollowing)

    local, totals, carries = {}, {}, {}
    for name, c in computations.items():
        boxed = F.struct(c.value.alias("v"))
        if c.kind in ("sum", "max", "min"):
            fold = {"sum": F.sum, "max": F.max, "min": F.min}[c.kind]
            local[name] = fold(c.value).over(inner.rowsBetween(*(earlier if c.before else so_far)))
            totals[name] = fold(c.value)
            carries[name] = fold(F.col(name)).over(outer.rowsBetween(*earlier))
        elif c.kind == "lag":
            local[name] = F.lag(boxed).over(inner)
            totals[name] = F.max_by(boxed, sort_key)
            carries[name] = F.lag(F.col(name)).over(outer)
        elif c.kind == "lead":
            local[name] = F.lead(boxed).over(inner)
            totals[name] = F.min_by(boxed, sort_key)
            carries[name] = F.lead(F.col(name)).over(outer)
        elif c.kind == "last_before":
            local[name] = F.last(c.value, ignorenulls=True).over(inner.rowsBetween(*so_far))
            totals[name] = F.max_by(c.value, F.when(c.value.isNotNull(), sort_key))
            carries[name] = F.last(F.col(name), ignorenulls=True).over(outer.rowsBetween(*earlier))
        elif c.kind == "min_after":
            local[name] = F.min(c.value).over(inner.rowsBetween(*later))
            totals[name] = F.min(c.value)
            carries[name] = F.min(F.col(name)).over(outer.rowsBetween(*later))
        elif c.kind == "group_sum":
            totals[name] = F.sum(c.value)
            carries[name] = F.sum(F.col(name)).over(Window.partitionBy(*groups))
        elif c.kind == "group_first":
            totals[name] = F.min_by(boxed, sort_key)
            carries[name] = F.first(F.col(name)).over(
                outer.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
            )
        else:
            raise ValueError(f"unknown computation {c.kind!r}")

    carried = (
        rows.groupBy(*groups, CHUNK)
        .agg(*[expr.alias(name) for name, expr in totals.items()])
        .select(*groups, CHUNK, *[expr.alias(f"_carry_{name}") for name, expr in carries.items()])
    )
    windowed = rows.select("*", *[expr.alias(f"_local_{name}") for name, expr in local.items()])
    joined = windowed.join(carried, [*keys, CHUNK], "left")

    outputs = []
    for name, c in computations.items():
        here, carry = F.col(f"_local_{name}") if name in local else None, F.col(f"_carry_{name}")
        if c.kind == "sum":
            value = F.when(
                here.isNotNull() | carry.isNotNull(),
                F.coalesce(here, F.lit(0)) + F.coalesce(carry, F.lit(0)),
            )
        elif c.kind == "max":
            value = F.greatest(here, carry)
        elif c.kind in ("min", "min_after"):
            value = F.least(here, carry)
        elif c.kind in ("lag", "lead"):
            value = F.coalesce(here, carry)["v"]
        elif c.kind == "last_before":
            value = F.coalesce(here, carry)
        elif c.kind == "group_sum":
            value = carry
        else:
            value = carry["v"]
        outputs.append(value.alias(name))
    return joined.select(*df.columns, *outputs)
