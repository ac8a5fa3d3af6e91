"""Ranks and best-cell flags for small report tables, and feature rankings.

Windows here run over one row per model or column; anything with a row per record
or per feature goes through ``average_rank``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinfold.functions.missing import col
from kinfold.operators.cumulative import average_rank
from kinfold.operators.groups import attach
from kinfold.session import cut_lineage


def shared_rank(value: Column, partition: Sequence[str], descending: bool) -> Column:
    """Average-tie rank over a window of report rows; a missing value has no rank."""
    order = value.desc_nulls_last() if descending else value.asc_nulls_last()
    first = F.rank().over(Window.partitionBy(*partition).orderBy(order))
    ties = F.count(value).over(Window.partitionBy(*partition, value))
    return F.when(value.isNotNull(), first + (ties - 1) / F.lit(2.0))


def flag_smallest_abs(df: DataFrame, columns: Sequence[str], whole_table: bool = False,
                      prefix: str = "is_min_") -> DataFrame:
    """Flag the cells whose absolute value is smallest in their column, or in the whole table."""
    smallest = df.agg(*[F.min(F.abs(c)).alias(c) for c in columns])
    if whole_table:
        overall = F.least(*columns) if len(columns) > 1 else F.col(columns[0])
        smallest = smallest.select(*[overall.alias(c) for c in columns])
    # A single row; as scalar subqueries it reaches the cells without moving them.
    return df.withColumns({
        prefix + c: F.coalesce(F.abs(F.col(c)) == smallest.select(c).scalar(), F.lit(False)) for c in columns
    })


def importance_table(spark: SparkSession, values: Sequence[float], features: Sequence[str] | None = None,
                     sort: bool = True) -> DataFrame:
    """A fitted model's importances as (feature, importance); features are numbered when not named."""
    names = [str(i) for i in range(len(values))] if features is None else list(features)
    table = spark.createDataFrame(list(zip(names, map(float, values), strict=True)), "feature string, importance double")
    return sorted_importances(table, "importance", "feature") if sort else table


def sorted_importances(df: DataFrame, importance: str = "importance", *then: str) -> DataFrame:
    """Importances, largest first."""
    return df.orderBy(F.desc(importance), *then)


def feature_ranks(importances: DataFrame) -> DataFrame:
    """(model, feature, rank): largest value first, from ``importance`` or else ``abs`` of the model."""
    columns = importances.columns
    if "importance" in columns and "abs" in columns:
        sized = attach(importances, ["model"], {"__has": F.max(F.col("importance").isNotNull())})
        chosen = F.when(F.col("__has"), F.col("importance")).otherwise(F.col("abs"))
    else:
        sized, chosen = importances, col("importance" if "importance" in columns else "abs")
    # Ranking reads the values three times: for the bounds, the ties and the result.
    values = cut_lineage(sized.select("model", "feature", chosen.cast("double").alias("value")))
    return average_rank(values, ["model"], "value", descending=True).select("model", "feature", "rank")


def feature_ranking(importances: DataFrame, models: Sequence[str]) -> DataFrame:
    """Features by mean rank: a rank column per model, ``mean_rank`` and ``count``, best first."""
    ranks = feature_ranks(importances)
    table = ranks.groupBy("feature").agg(
        *[F.max(F.when(F.col("model") == m, F.col("rank"))).alias(m) for m in models],
        F.avg("rank").alias("mean_rank"),
        F.count("rank").alias("count"),
    )
    return table.orderBy("mean_rank", "feature")
