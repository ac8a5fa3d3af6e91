"""Row filters on missing values."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_counts_row(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: number of nulls of every column, from one pass."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns or df.columns])


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Nulls per column, most first."""
    counts = null_counts_row(df, columns)
    long = counts.unpivot([], counts.columns, "column_name", "n_null")
    return long.orderBy(F.desc("n_null"), "column_name")


def drop_minor_nulls(df: DataFrame, limit: int | None = 100, columns: Sequence[str] | None = None,
                     share: float | None = None) -> DataFrame:
    """Drop rows with a null in a column that has some nulls, but fewer than ``limit``.

    ``share`` states the limit as a share of all rows instead, which means the same at every
    size; of both the lower one counts. The null counts reach the rows as a scalar subquery of one row.
    """
    names = list(columns or df.columns)
    few = F.struct(*[
        (F.count_if(F.col(c).isNull()) < F.least(F.lit(limit).cast("double"), F.count("*") * F.lit(share).cast("double")))
        .alias(f"c{i}") for i, c in enumerate(names)])
    held = df.withColumn("__few", df.agg(few.alias("few")).scalar())
    return held.filter(reduce(and_, [F.col(c).isNotNull() | ~F.col(f"__few.c{i}") for i, c in enumerate(names)])).drop("__few")


def drop_all_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.na.drop(how="all", subset=list(columns))


def drop_any_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.na.drop(how="any", subset=list(columns))
