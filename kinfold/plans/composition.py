"""Household size, adults, children, elderly and equivalence scales."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.functions import household as hf
from kinfold.functions.missing import group_total

SCALES = ["total_hh_member", "aes1", "aes2"]


def composition_counts(age: str) -> dict[str, Column]:
    """Aggregates over the members of a household."""
    return {
        "total_hh_member": F.count("*"),
        "total_adult": group_total(hf.adult(age)),
        "total0_17": group_total(hf.child(age)),
        "num_elderly": group_total(hf.elderly(age)),
    }


def composition_scales() -> dict[str, Column]:
    """Columns derived from the counts."""
    counts = ("total_hh_member", "total_adult", "total0_17")
    return {
        "gr_total0_17": hf.child_group("total0_17"),
        "aes1": hf.equivalence_scale(*counts, hf.SCALE_NEW),
        "aes2": hf.equivalence_scale(*counts, hf.SCALE_OLD),
    }


def household_composition(members: DataFrame, household: str, age: str, **more: Column) -> DataFrame:
    """One row per household; ``more`` are further aggregates taken in the same pass."""
    aggregates = {**composition_counts(age), **more}
    grouped = members.groupBy(household).agg(*[a.alias(name) for name, a in aggregates.items()])
    return grouped.withColumns(composition_scales())
