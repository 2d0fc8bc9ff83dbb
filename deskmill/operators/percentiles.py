"""Exact percentiles of groups of any size.

The built-in exact aggregate keeps all distinct values of a group in one buffer. Here a sketch that tasks can merge brackets each wanted rank by two
values, a second one does so inside the bracket, and only what lies in the last brackets is counted value by value and added up. Values are
read three times, and neither sorted nor written as a whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Quantiles of one sketch, and its accuracy: a quantile's rank is off by at most one in ACCURACY of the values.
GRID, ACCURACY = 256, 8192
# Groups of at most so many values are not bracketed.
SMALL = 4 * GRID


def _sketch(value: Column) -> Column:
    return F.percentile_approx(value, [i / GRID for i in range(GRID + 1)], ACCURACY)


def _bracket(low_rank: Column, high_rank: Column, n: Column, low: Column, high: Column) -> list[Column]:
    """The two values around the ranks (from 0) among ``n`` values between ``low`` and ``high``, from their ``grid``: two quantiles further out than needed."""
    first = F.floor(low_rank / n * GRID).cast("int") - 2
    last = F.ceil((high_rank + 1) / n * GRID).cast("int") + 2
    small = n <= SMALL
    return [
        F.when(small | (first < 0), low).otherwise(F.get("grid", F.greatest(first, F.lit(0)))).alias("lo"),
        F.when(small | (last > GRID), high).otherwise(F.get("grid", F.least(last, F.lit(GRID)))).alias("hi"),
    ]


def percentile_points(df: DataFrame, keys: Sequence[str], value: str, wanted: DataFrame) -> DataFrame:
    """Percentiles by linear interpolation: ``keys, fraction, point``.

    ``wanted`` has the keys and a ``fraction`` between 0 and 1; ``value`` is a double, nulls are
    left out.
    """
    asked = wanted.select(*keys, "fraction").distinct()
    rows = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_v"))
    v, same = F.col("_v"), [*keys, "fraction"]

    sketched = rows.join(asked.select(*keys).distinct(), list(keys), "left_semi").groupBy(*keys)
    sketched = sketched.agg(F.count("*").alias("n"), F.min(v).alias("low"), F.max(v).alias("high"), _sketch(v).alias("grid"))
    rank = F.col("fraction") * (F.col("n") - 1)
    ranked = sketched.join(asked, list(keys)).withColumns({"low_rank": F.floor(rank), "high_rank": F.ceil(rank), "part": rank - F.floor(rank)})
    carried = ["low_rank", "high_rank", "part"]
    brackets = ranked.select(*same, *carried, *_bracket(F.col("low_rank"), F.col("high_rank"), F.col("n"), F.col("low"), F.col("high")))

    inside = F.when(v >= F.col("lo"), v)
    again = rows.join(brackets, list(keys)).filter(v <= F.col("hi")).groupBy(*same, *carried, "lo", "hi")
    again = again.agg(F.count_if(v < F.col("lo")).alias("below"), F.count(inside).alias("n"), _sketch(inside).alias("grid"))
    narrow = _bracket(F.col("low_rank") - F.col("below"), F.col("high_rank") - F.col("below"), F.col("n"), F.col("lo"), F.col("hi"))
    narrowed = again.select(*same, *carried, *narrow)

    # Values below the bracket are one group, without a value.
    counted = rows.join(narrowed, list(keys)).filter(v <= F.col("hi")).groupBy(*same, *carried, F.when(v >= F.col("lo"), v).alias("_v")).agg(F.count("*").alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy(*same).orderBy(F.col("_v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow))

    def holds(place: str) -> Column:
        return (F.col(place) < F.col("_upto")) & (F.col(place) >= F.col("_upto") - F.col("_n"))

    near = counted.withColumn("_upto", upto).filter(holds("low_rank") | holds("high_rank"))
    ends = near.groupBy(*same).agg(
        F.min(F.when(holds("low_rank"), F.col("_v"))).alias("_low"),
        F.max(F.when(holds("high_rank"), F.col("_v"))).alias("_high"),
        F.max("part").alias("_part"),
    )
    missed = F.col("_low").isNull() | F.col("_high").isNull()
    point = F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("_part")
    return ends.select(*same, F.when(missed, F.raise_error(F.lit("a rank lies outside its bracket"))).otherwise(point).alias("point"))
