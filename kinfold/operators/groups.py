"""Group values kept on every row.

All of them aggregate first (partial sums on the map side) and join the result
back; a window would pull every row of a household into one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.functions.missing import col
from kinfold.operators.exact import age_order
from kinfold.operators.merge import join_on


def attach(df: DataFrame, keys: Sequence[str], aggregates: Mapping[str, Column],
           null_safe: bool = False, source: DataFrame | None = None) -> DataFrame:
    """Add aggregates of each group to all of the group's rows.

    ``source`` is the frame to aggregate when it is cheaper than ``df``, for example
    the same rows before they were joined to something.
    """
    groups = (df if source is None else source).groupBy(*keys).agg(*[a.alias(name) for name, a in aggregates.items()])
    return join_on(df, groups, list(keys), "left", null_safe=null_safe)


def value_where(condition: Column, value) -> Column:
    """Aggregate: the largest value among rows meeting the condition."""
    return F.max(F.when(condition, col(value)))


def only_where(condition: Column, value: Column) -> Column:
    """A group value written only to the rows that meet the condition."""
    return F.when(condition, value)


def category_totals(category: str, names: Sequence[str], amount, prefix: str = "exp_") -> list[Column]:
    """Aggregates: one total per category, missing where the group has no row of it.

    A missing amount counts as zero.
    """
    filled = F.coalesce(col(amount).cast("double"), F.lit(0.0))
    return [F.sum(F.when(F.col(category) == name, filled)).alias(prefix + name) for name in names]


def oldest(age, member_id, eligible: Column, *attributes: str) -> Column:
    """Aggregate: struct of id and attributes of the oldest eligible member, lowest id on a tie.

    Ids may be any long, ages any double; a negative age or NaN is no age and makes a member not eligible. Age and id
    become one decimal to order by, and every attribute is taken on its own, so the buffers of numeric attributes are
    numbers and Spark adds up in hash tables.
    """
    known = col(age).cast("double")
    order = F.when(eligible & (known >= 0) & (known < float("inf")), age_order(col(age), col(member_id)))
    return F.struct(F.min_by(col(member_id), order).alias("id"), *[F.min_by(F.col(a), order).alias(a) for a in attributes])


def frequency(df: DataFrame, *columns: str) -> DataFrame:
    """Frequency table."""
    return df.groupBy(*columns).agg(F.count("*").alias("n"))
