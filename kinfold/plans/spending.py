"""Deflated household spending per equivalent adult and per head.

Item rows are reduced to one row per household before anything is joined; the
household lookups have one row per household too, so no later join meets a hot key.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.functions.missing import col, group_total, row_total
from kinfold.functions.money import inflator, monthly, per_unit
from kinfold.functions.recode import banded
from kinfold.operators.groups import category_totals
from kinfold.operators.merge import merge, require_unique
from kinfold.session import cut_lineage

UNITS = {"aes1": "aes1", "aes2": "aes2", "pc": "total_hh_member"}

# Food item code ranges of each category.
FOOD_CATEGORIES = [
    ("cereals", 101, 117), ("roots", 201, 209), ("nuts", 301, 313), ("veggie", 401, 414),
    ("meat", 501, 515), ("fruit", 601, 610), ("cooked", 820, 837), ("milk", 701, 709),
    ("sugar", 801, 804), ("beverage", 901, 916), ("spice", 810, 818),
]


def price_lookup(df: DataFrame, prices: DataFrame, month: str = "month", index: str = "cpi") -> DataFrame:
    """Add the price index of the row's month, missing where the month has none.

    Any text can be a month; one that is listed twice stops the job. An index table of months
    is small, so Spark broadcasts it, but nothing depends on that.
    """
    return df.join(require_unique(prices.select(month, index).filter(F.col(month).isNotNull()), month), month, "left")


def with_inflator(df: DataFrame, prices: DataFrame, month: str = "month", index: str = "cpi") -> DataFrame:
    return price_lookup(df, prices, month, index).withColumn("inflator", inflator(index))


def food_totals(items: DataFrame, household: str, item: str, amount: str,
                categories: Sequence[tuple[str, int, int]] = FOOD_CATEGORIES, *more) -> DataFrame:
    """Total and per-category amounts, one row per household, from one aggregation."""
    names = [name for name, _, _ in categories]
    coded = items.withColumn("category", banded(item, categories))
    return coded.groupBy(household).agg(
        group_total(F.col(amount).cast("double")).alias("total_exp_food"),
        *category_totals("category", names, amount), *more,
    )


def _priced(totals: DataFrame, scales: DataFrame, prices: DataFrame, household: str, month) -> DataFrame:
    """Totals with sizes and inflator; both sides have one row per household."""
    joined = merge(totals, scales, household, validate=False, split_hot=False).withColumn("month", col(month))
    return with_inflator(joined, prices)


def food_spending(items: DataFrame, scales: DataFrame, prices: DataFrame, *, household: str, item: str,
                  amount: str, month="month", categories=FOOD_CATEGORIES, carry: Sequence[Column] = (),
                  only: Collection[str] | None = None) -> DataFrame:
    """Deflated food spending per scale, total and by category.

    ``scales`` has one row per household with its sizes. ``month`` is an expression
    over its columns and over ``carry``, further aggregates of the item rows. ``only``
    limits the amounts to names among it.
    """
    totals = food_totals(items, household, item, amount, categories, *carry)
    priced = _priced(totals, scales, prices, household, month)
    return priced.select(
        household,
        *per_unit(["total_exp_food"], UNITS, only=only),
        *per_unit([f"exp_{name}" for name, _, _ in categories], UNITS, suffix="2", only=only),
    )


def recall_spending(items: DataFrame, scales: DataFrame, prices: DataFrame, *, household: str, amount: str,
                    tag: str, periods: Mapping[str, str], month="month", carry: Sequence[Column] = (),
                    only: Collection[str] | None = None) -> DataFrame:
    """Deflated monthly non-food spending per recall period, one row per household.

    ``tag`` is the column telling which questionnaire part an item row comes from and
    ``periods`` the recall period of each part. All parts are totalled in a single
    aggregation; a part without any row of the household stays missing. ``month`` is one
    expression for all parts, or a mapping with one for each part.
    """
    totals = items.groupBy(household).agg(*category_totals(tag, list(periods), amount, prefix="period_"), *carry)
    names = {t: f"total_exp_non_food_{t}" for t in periods}
    if isinstance(month, Mapping):
        priced = merge(totals, scales, household, validate=False, split_hot=False)
        rates = {t: f"inflator_{t}" for t in periods}
        for t, rate in rates.items():
            priced = with_inflator(priced.withColumn("month", month[t]), prices).withColumnRenamed("inflator", rate).drop(
                "month", "cpi")
    else:
        priced, rates = _priced(totals, scales, prices, household, month), dict.fromkeys(periods, "inflator")
    priced = priced.withColumns({names[t]: monthly(f"period_{t}", period) for t, period in periods.items()})
    return priced.select(
        household,
        *[F.col(names[t]).alias(f"nonfood_exp_monthly_{t}") for t in periods],
        *[c for t in periods for c in per_unit([names[t]], UNITS, rate=rates[t], only=only)],
    )


def combined_spending(items: DataFrame, scales: DataFrame, prices: DataFrame, *, household: str, item: str, amount: str,
                      tag: str, periods: Mapping[str, str], month="month", categories=FOOD_CATEGORIES,
                      only: Collection[str] | None = None) -> DataFrame:
    """What ``food_spending`` and ``recall_spending`` give, for item rows that count for both, from one aggregation.

    The rows are read, priced and joined to the household's sizes once. The index is aggregated from what may be a large
    table, so it is written before it is checked and looked up.
    """
    names = [name for name, _, _ in categories]
    kept = [n for n in names if only is None or any(f"{u}_exp_{n}2" in only for u in UNITS)]
    coded = items.withColumn("category", banded(item, categories)) if kept else items
    totals = coded.groupBy(household).agg(
        group_total(F.col(amount).cast("double")).alias("total_exp_food"), *category_totals("category", kept, amount),
        *category_totals(tag, list(periods), amount, prefix="period_"))
    priced = _priced(totals, scales, cut_lineage(prices), household, month)
    parts = {t: f"total_exp_non_food_{t}" for t in periods}
    priced = priced.withColumns({parts[t]: monthly(f"period_{t}", period) for t, period in periods.items()})
    return priced.select(
        household, *per_unit(["total_exp_food"], UNITS, only=only), *per_unit([f"exp_{n}" for n in kept], UNITS, suffix="2", only=only),
        *per_unit(list(parts.values()), UNITS, only=only))


def total_spending(food: str, parts: Sequence[str]) -> dict[str, Column]:
    """Non-food and overall spending per equivalent adult; missing parts count as zero."""
    return {"total_aes1_nonfood_exp_inf": row_total(*parts), "total_aes1_exp_inf": row_total(food, *parts)}
