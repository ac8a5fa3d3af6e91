"""Recodes: value maps, bands, code sets to groups, one-hot columns, label text."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from kinfold.functions.missing import col, is_true


def swap(c, changes: Mapping) -> Column:
    """Replace the listed values, keep all others."""
    c = col(c)
    out = c
    for old, new in changes.items():
        out = F.when(c == F.lit(old), F.lit(new)).otherwise(out)
    return out


def grouped(c, groups: Mapping[object, Iterable[int]], open_top: tuple[object, int] | None = None) -> Column:
    """Code sets to group values; ``open_top`` is (value, lowest code) of an open upper group.

    Codes outside every set, and missing codes, stay missing.
    """
    c = col(c)
    out = F.lit(None)
    if open_top is not None:
        out = F.when(c >= open_top[1], F.lit(open_top[0]))
    for value, codes in groups.items():
        out = F.when(c.isin(*codes), F.lit(value)).otherwise(out)
    return out


def banded(c, bands: Sequence[tuple[object, float | None, float | None]]) -> Column:
    """Closed ranges to values: ``(value, low, high)``, None for an open end."""
    c = col(c)
    out = F.lit(None)
    for value, low, high in bands:
        inside = c.isNotNull()
        if low is not None:
            inside = inside & (c >= low)
        if high is not None:
            inside = inside & (c <= high)
        out = F.when(inside, F.lit(value)).otherwise(out)
    return out


def flag(condition: Column) -> Column:
    """1/0 with unknown as 0."""
    return is_true(condition).cast("int")


def flag_known(condition: Column, *known) -> Column:
    """1/0, missing when one of ``known`` is missing."""
    out = condition.cast("int")
    for c in known:
        out = F.when(col(c).isNotNull(), out)
    return out


def flag_or_missing(condition: Column) -> Column:
    """1 where the condition holds, else missing."""
    return F.when(condition, F.lit(1))


def one_hot(c, levels: Iterable, prefix: str) -> list[Column]:
    """One 0/1 column per level; all missing where the source is missing."""
    c = col(c)
    return [F.when(c.isNotNull(), (c == F.lit(v)).cast("int")).alias(f"{prefix}{v}") for v in levels]


def equals_any(c, others: Iterable) -> Column:
    """1 if the value is the same as any of the other columns (missing equals missing), else missing."""
    hit = F.lit(False)
    for other in others:
        hit = hit | col(c).eqNullSafe(col(other))
    return F.when(hit, F.lit(1))


def label_text(c, labels: Mapping[int, str]) -> Column:
    """Text of a code for a handful of fixed labels; no text for other codes."""
    c = col(c)
    out = F.lit(None).cast("string")
    for code, text in labels.items():
        out = F.when(c == F.lit(code), F.lit(text)).otherwise(out)
    return out
