"""Money: price deflation, recall periods, amounts per equivalent adult and per head."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from kinfold.functions.missing import col, ratio

# Price index of the base month, and months per recall period
# (a week is spent four times a month).
BASE_INDEX = 90.3225806451613
PER_MONTH = {"week": 4.0, "month": 1.0}
MONTHS = {"quarter": 3, "year": 12}


def inflator(index, base: float = BASE_INDEX) -> Column:
    return ratio(F.lit(base), index)


def monthly(amount, period: str) -> Column:
    """An amount recalled over ``period`` as an amount per month."""
    amount = col(amount).cast("double")
    if period in PER_MONTH:
        return amount * F.lit(PER_MONTH[period])
    return amount / F.lit(float(MONTHS[period]))


def per_unit(amounts: Sequence[str], scales: Mapping[str, str], rate: str = "inflator",
             suffix: str = "", only: Collection[str] | None = None) -> list[Column]:
    """``(amount * rate) / scale`` for every amount and scale, named ``<prefix>_<amount><suffix>``.

    ``only`` limits the result to names among it.
    """
    return [
        ratio(F.col(amount) * F.col(rate), scale).alias(f"{prefix}_{amount}{suffix}")
        for amount in amounts
        for prefix, scale in scales.items()
        if only is None or f"{prefix}_{amount}{suffix}" in only
    ]
