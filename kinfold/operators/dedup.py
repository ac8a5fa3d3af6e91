"""Deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_ORDER = "__order"


def first_per_key(df: DataFrame, keys: Sequence[str], tiebreak: Sequence) -> DataFrame:
    """One whole row per key: the first by ``tiebreak``, which has no default.

    Spark limits each key to one row before the shuffle (window group limit), so a
    key with very many copies does not gather in one task.
    """
    if not tiebreak:
        raise ValueError("a tiebreak is needed: tables have no row order")
    window = Window.partitionBy(*keys).orderBy(*tiebreak)
    return df.withColumn(_ORDER, F.row_number().over(window)).filter(F.col(_ORDER) == 1).drop(_ORDER)


def least_row(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One whole row per key, the least by all other columns: for tables without a natural order."""
    return first_per_key(df, keys, [c for c in df.columns if c not in keys])


def distinct_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return (df.select(*columns) if columns else df).distinct()
