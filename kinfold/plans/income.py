"""Other income and assistance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.functions.missing import group_total, ratio, row_total
from kinfold.functions.money import monthly


def other_income(items: DataFrame, household: str, transfers: Sequence[str], other: str) -> DataFrame:
    """Monthly income from transfers and other sources, one row per household, from 12-month amounts."""
    year = items.groupBy(household).agg(
        group_total(row_total(*transfers)).alias("__transfers"),
        group_total(F.col(other).cast("double")).alias("__other"),
    )
    total = monthly(row_total("__transfers", "__other"), "year")
    return year.select(household, total.alias("other_income_monthly"))


def assistance(items: DataFrame, household: str, cash: str, in_kind: str) -> DataFrame:
    """Cash and in-kind assistance of twelve months, one row per household."""
    return items.groupBy(household).agg(
        group_total(F.col(cash).cast("double")).alias("cash_assistance_12month"),
        group_total(F.col(in_kind).cast("double")).alias("inkind_assistance_12month"),
    )


def assistance_per_adult(scale: str = "aes1") -> dict[str, Column]:
    cash = ratio(monthly("cash_assistance_12month", "year"), scale)
    in_kind = ratio(monthly("inkind_assistance_12month", "year"), scale)
    return {"aes1_monthly_cash_assist": cash, "aes1_monthly_inkind_assist": in_kind,
            "total_assist_invalue": row_total(cash, in_kind)}
