"""Hours of farm work per household member."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.operators.dedup import least_row

# Farm tasks by question number, and the number of workers asked for.
TASKS = {"landprep": "ag_d42", "weed": "ag_d43", "harvest": "ag_d44"}
WORKERS = 13
# Bits of a long that hold packed cells; those above stay 0, so that longs compare as their cells do.
PACKED_BITS = 62
WHOLE = {"tinyint", "smallint", "int", "bigint"}


def _least_packed(plots: DataFrame, keys: list[str], groups: Mapping[str, list[str]]) -> tuple[DataFrame, dict[str, Column]] | None:
    """The least row of each key with its values packed, and where each value is; None where values don't pack.

    Rows are sorted to find the least, and hundreds of numbers make them wide. So every value becomes a number of as few
    bits as its group's range in the table asks for (0 for a missing one), and cells are put together in ``words`` in the order
    of the columns: words compare as the columns do. Ranges are taken in a pass before, two numbers for each group.
    """
    kinds = dict(plots.dtypes)
    if any(kinds[c] not in WHOLE for columns in groups.values() for c in columns):
        return None
    found = plots.agg(F.array(*[F.struct(F.min(F.least(own[0], *own)).cast("bigint").alias("low"), F.max(F.greatest(own[0], *own)).cast("bigint").alias("high"))
                                for own in groups.values()])).head()[0]
    low = {g: r.low or 0 for g, r in zip(groups, found)}
    bits = {g: 0 if r.low is None else (r.high - r.low + 1).bit_length() for g, r in zip(groups, found)}
    if max(bits.values()) > PACKED_BITS:
        return None
    words, places, free = [[F.lit(0).cast("bigint")]], {}, PACKED_BITS
    for g, columns in groups.items():
        for c in columns:
            if free < bits[g]:
                words.append([])
                free = PACKED_BITS
            free -= bits[g]
            if bits[g]:
                words[-1].append(F.shiftleft(F.coalesce(F.col(c).cast("bigint") - F.lit(low[g]) + 1, F.lit(0)).cast("bigint"), free))
            places[c] = F.struct(F.lit(len(words) - 1).alias("word"), F.lit(free).alias("shift"),
                                 F.lit((1 << bits[g]) - 1).cast("bigint").alias("mask"), F.lit(low[g]).cast("bigint").alias("low"))
    packed = F.array(*[reduce(Column.bitwiseOR, cells) for cells in words])
    return least_row(plots.select(*keys, packed.alias("words")), keys), places


def _value(place: str) -> Column:
    """What stands at a place of ``words``."""
    cell = F.expr(f"shiftright(words[{place}.word], {place}.shift) & {place}.mask")
    return F.when(cell > 0, cell - 1 + F.col(f"{place}.low"))


def labour_hours(plots: DataFrame, household: str, member_id: str, tasks: Mapping[str, str] = TASKS,
                 workers: int = WORKERS, prefix: str = "total_rainy_labor_", plot: str | None = None) -> DataFrame:
    """Hours per household member and task over all plots.

    For each task the columns ``<stub>a1 …`` hold worker ids and ``b``, ``c``, ``d``
    the factors of the hours. All tasks and workers are unpivoted together, so one
    aggregation on (household, member) gives every total. A member who is not listed
    for a task has no total there; unknown hours of a listed one count as zero.

    ``plot`` names the plot id if plots may be repeated: the least row of each counts. Building the frame then runs a pass for
    the ranges of whole numbers, by which rows are packed before they are sorted.
    Columns are packed into one array per task and role and unpivoted from there; 39
    spelled-out cells would make a method too long for the JVM to compile.
    """
    numbers = range(1, workers + 1)
    kinds = {"a": dict(plots.dtypes)[f"{next(iter(tasks.values()))}a1"], "b": "double", "c": "double", "d": "double"}
    groups = {f"{role}_{task}": [f"{stub}{role}{n}" for n in numbers] for task, stub in tasks.items() for role in kinds}
    least = _least_packed(plots, [household, plot], groups) if plot is not None else None
    if least is not None:
        rows, places = least
        # One row per task and worker, with the places of its values.
        cells = F.array(*[F.struct(F.lit(t).alias("task"), *[places[f"{stub}{role}{n}"].alias(role) for role in kinds])
                          for t, stub in tasks.items() for n in numbers])
        long = rows.select(household, "words", F.inline(cells)).select(
            household, "task", *[_value(role).cast(kind).alias(role) for role, kind in kinds.items()])
    else:
        packed = [F.array(*[F.col(c).cast(kinds[name[0]]) for c in own]).alias(name) for name, own in groups.items()]
        rows = plots.select(household, *packed) if plot is None else least_row(
            plots.select(household, plot, *packed), [household, plot])
        by_task = rows.select(household, F.inline(F.array(*[
            F.struct(F.lit(t).alias("task"), *[F.col(f"{role}_{t}").alias(role) for role in kinds]) for t in tasks])))
        long = by_task.select(household, "task", F.inline(F.arrays_zip(*kinds)))
    hours = F.coalesce(F.col("d") * F.col("c") * F.col("b"), F.lit(0.0))
    return long.filter(F.col("a").isNotNull()).groupBy(household, F.col("a").alias(member_id)).agg(*[
        F.sum(F.when(F.col("task") == t, hours)).alias(prefix + t) for t in tasks])
