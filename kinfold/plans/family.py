"""Head, oldest adults, parents and beneficiaries of a household."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.functions.household import ADULT_AGE
from kinfold.operators.dedup import first_per_key
from kinfold.operators.filters import drop_all_missing
from kinfold.operators.groups import oldest, value_where
from kinfold.operators.reshape import to_long, to_wide

FEMALE, MALE, HEAD = 1, 0, 1


def head_value(relation: str, value: str) -> Column:
    """Aggregate: attribute of the household head."""
    return value_where(F.col(relation) == HEAD, value)


def oldest_adult(gender: str, sex: int, age: str, member_id: str, attributes: Sequence[str],
                 among: Column | None = None) -> Column:
    """Aggregate: the oldest adult of one sex, lowest id on a tie."""
    eligible = (F.col(gender) == sex) & (F.col(age) >= ADULT_AGE)
    return oldest(age, member_id, eligible if among is None else among & eligible, *attributes)


def oldest_flag(picked: str, member_id: str) -> Column:
    """1 for the member that was picked, else missing."""
    return F.when(F.col(member_id) == F.col(f"{picked}.id"), F.lit(1))


def beneficiary_list(programme: DataFrame, household: str, stub: str, suffixes: Sequence[str], out: str) -> DataFrame:
    """Member ids listed for a programme, each once per household, one column per list place."""
    listed = drop_all_missing(programme, [f"{stub}{s}" for s in suffixes])
    long = to_long(listed, [household], {stub: out}, suffixes, "place")
    once = first_per_key(long, [household, out], ["place"])
    return to_wide(once, [household], "place", [out], suffixes, validate=False)


def most_severe(shocks: DataFrame, household: str, code: str, rank: str, tiebreak: Sequence, name: str) -> DataFrame:
    """The shock ranked first by each household."""
    first = first_per_key(shocks.filter(F.col(rank) == 1), [household], tiebreak)
    return first.select(household, F.col(code).alias(name))
