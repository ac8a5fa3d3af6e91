"""Running totals and average ranks that do not gather a group in one task.

An ordered window over a whole group runs in a single task. Here the order values
are first cut into ranges of about equal size, each range is summed on its own, and
the totals of the lower ranges are added as an offset.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinfold.operators.merge import join_on

_RANGE = "__range"
_BOUNDS = "__bounds"
MAX_RANGES = 1024
_STEP = 32


def _range_count(df: DataFrame) -> int:
    return max(2, min(MAX_RANGES, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


def count_below(values: Column, value: Column) -> Column:
    """How many entries of an array are below a value; 0 for a missing value.

    Never null, so that a join on it adds no filter Spark would evaluate on every source row.
    """
    return F.coalesce(F.size(F.filter(values, lambda b: b < value)), F.lit(0))


def _with_range(df: DataFrame, bounds: DataFrame, value: Column) -> DataFrame:
    """Add the number of bounds below a value.

    ``bounds`` is one row with a sorted array. Every 32nd bound is looked at first and
    then one block of 32, some 60 comparisons for 1,000 bounds.
    """
    marks = F.filter("every", lambda _, i: i % _STEP == 0)
    held = df.withColumn(_BOUNDS, bounds.select(F.struct("every", marks.alias("marks"))).scalar())
    held = held.withColumn(_RANGE, count_below(F.col(f"{_BOUNDS}.marks"), value))
    before = (F.col(_RANGE) - 1) * _STEP
    block = F.slice(F.col(f"{_BOUNDS}.every"), before + 1, F.lit(_STEP))
    below = F.when(F.col(_RANGE) == 0, 0).otherwise(before + count_below(block, value))
    return held.withColumn(_RANGE, below).drop(_BOUNDS)


def running_totals(df: DataFrame, group: Sequence[str], order: str, values: Sequence[str], *,
                   descending: bool = False, ranges: int | None = None) -> DataFrame:
    """Add ``cum_<v>`` (inclusive) and ``all_<v>`` (group total) for each value column.

    ``df`` has one row per group and order value; collapse it first. The ranges come
    from quantiles over all groups together, so no (group, range) holds more than
    about 1/ranges of all rows, whatever the group sizes are. Totals of whole numbers and
    decimals are exact; doubles are added range by range, so their last digits depend on
    the number of ranges. A NaN has no place in an order: filter it first.
    """
    ranges = ranges or _range_count(df)
    key = F.col(order).cast("double")
    key = -key if descending else key
    points = [i / ranges for i in range(1, ranges)]
    # One row with fewer than MAX_RANGES numbers, as a scalar subquery. The bounds only
    # balance the ranges, so a rough quantile is good enough. Touching every value column
    # keeps the subquery's input the same as the main query's, whose shuffle it then shares.
    usable = reduce(and_, [~F.isnan(F.col(v).cast("double")) for v in values])
    rough = F.percentile_approx(F.when(usable, key), points, 4 * ranges)
    bounds = df.agg(F.coalesce(rough, F.array().cast("array<double>")).alias("every"))
    cut = _with_range(df, bounds, key)

    group = list(group)
    totals = cut.groupBy(*group, _RANGE).agg(*[F.sum(v).alias(f"__t_{v}") for v in values])
    # At most `ranges` rows per group.
    ordered = Window.partitionBy(*group).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    offsets = totals.select(
        *group, _RANGE,
        *[F.coalesce(F.sum(f"__t_{v}").over(ordered), F.lit(0)).alias(f"__o_{v}") for v in values],
        *[F.sum(f"__t_{v}").over(whole).alias(f"all_{v}") for v in values],
    )
    direction = F.col(order).desc() if descending else F.col(order).asc()
    within = Window.partitionBy(*group, _RANGE).orderBy(direction).rowsBetween(Window.unboundedPreceding, 0)
    summed = cut.withColumns({f"__w_{v}": F.sum(v).over(within) for v in values})
    # Both sides are spread by group and range already; a missing group name meets itself.
    joined = join_on(summed, offsets, [*group, _RANGE], "inner", null_safe=True, split_hot=False)
    return joined.select(
        *df.columns,
        *[(F.col(f"__w_{v}") + F.col(f"__o_{v}")).alias(f"cum_{v}") for v in values],
        *[F.col(f"all_{v}") for v in values],
    )


def average_rank(df: DataFrame, group: Sequence[str], value: str, *, descending: bool, name: str = "rank",
                 ranges: int | None = None) -> DataFrame:
    """Rank within the group, ties sharing the mean of their places; a missing value has no rank."""
    ties = df.filter(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count("*").alias("__n"))
    placed = running_totals(ties, group, value, ["__n"], descending=descending, ranges=ranges)
    # Places cum-n+1 … cum, whose mean is cum - (n-1)/2.
    ranks = placed.select(*group, value, (F.col("cum___n") - (F.col("__n") - 1) / F.lit(2.0)).alias(name))
    return join_on(df, ranks, [*group, value], "left", null_safe=True)
