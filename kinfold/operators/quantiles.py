"""Weighted quantile groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.operators.cumulative import count_below, running_totals
from kinfold.operators.exact import DIGITS, digits, sign_of_sum, top_place

_PLACE = "__place"


def weighted_cuts(df: DataFrame, score: str, weight: str, groups: int = 5, ranges: int | None = None) -> DataFrame:
    """One row with the array ``cuts`` of ``groups - 1`` weighted quantiles.

    A cut is the least score whose cumulated weight passes its share of the total,
    or the mean of that score and the one that meets the share exactly. Both are decided on exact sums, so
    the cuts do not depend on how the rows are spread, and weights may have any size: a weight counts as the decimal number it
    is written as, to 54 places from the largest one's first. A NaN score counts as missing, and so does a weight that is not finite.
    """
    w = F.col(weight).cast("double")
    usable = F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")) & w.isNotNull() & ~F.isnan(w) & (F.abs(w) < float("inf"))
    rows = df.filter(usable).select(score, w.alias("w"))
    parts = [f"w{i}" for i in range(DIGITS)]
    held = rows.withColumn(_PLACE, top_place(rows, "w").scalar())
    by_score = held.select(score, *[d.alias(n) for d, n in zip(digits(F.col("w"), F.col(_PLACE)), parts)]).groupBy(score).agg(
        *[F.sum(n).cast("decimal(38,0)").alias(n) for n in parts])
    running = running_totals(by_score, [], score, parts, ranges=ranges)

    def cut(p: int) -> Column:
        # Whether what is cumulated lies beyond, at or before the share.
        beyond = sign_of_sum([F.col(f"cum_{n}") * groups - F.col(f"all_{n}") * p for n in parts])
        passed = F.min(F.when(beyond > 0, F.col(score)))
        met = F.min(F.when(beyond == 0, F.col(score)))
        return F.coalesce((met + passed) / F.lit(2.0), passed)

    return running.agg(F.array(*[cut(p) for p in range(1, groups)]).alias("cuts"))


def weighted_quantile_group(df: DataFrame, score: str, weight: str, name: str, groups: int = 5,
                            ranges: int | None = None) -> DataFrame:
    """Group 1..``groups`` of each row; equal scores share a group, a missing score has none.

    The rows themselves do not move: the cuts reach them as a scalar subquery.
    """
    cuts = weighted_cuts(df, score, weight, groups, ranges).scalar()
    # Held in a column first: Spark allows no subquery inside the array function.
    held = df.withColumn("__cuts", cuts)
    known = F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double"))
    group = F.when(known, count_below(F.col("__cuts"), F.col(score)) + 1)
    return held.withColumn(name, group).drop("__cuts")
