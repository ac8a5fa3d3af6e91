"""Exact numbers from doubles: sums that do not depend on the order of rows, and an order over (double, id) as one number.

Plain column expressions. A double stands for the decimal number it is written as (0.1 is a tenth), which is a whole number of
at most 17 digits times a power of ten. Cut at fixed places it is a few whole digits to the base 10^18; sums of digits are
whole numbers, which any order of rows gives alike.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Three digits reach 54 decimal places below the largest value: all doubles down to 1e-37 of it are held in full.
DIGITS, PLACES = 3, 18
BASE = 10**PLACES
_WHOLE = "decimal(38,0)"


def _power(exponent: Column) -> Column:
    return F.pow(F.lit(2.0), exponent.cast("double"))


def binary_exponent(value: Column) -> Column:
    """The whole e with 2^e <= value < 2^(e + 1), for a positive finite double; -1074 at least."""
    # A logarithm may be off by one near a power of two.
    e = F.floor(F.log2(value))
    e = F.when(value < _power(e), e - 1).when((e < 1023) & (value >= _power(e + 1)), e + 1).otherwise(e)
    return F.greatest(e, F.lit(-1074))


def _written(value: Column) -> tuple[Column, Column]:
    """The whole number of a double's digits, and the power of ten it is to be multiplied by."""
    text = F.abs(value.cast("double")).cast("string")
    mantissa, power = F.split_part(text, F.lit("E"), F.lit(1)), F.split_part(text, F.lit("E"), F.lit(2))
    places = F.length(F.split_part(mantissa, F.lit("."), F.lit(2)))
    exponent = F.when(power == "", 0).otherwise(F.try_to_number(power, F.lit("S999")).cast("int")) - places
    return F.replace(mantissa, F.lit("."), F.lit("")).cast("bigint"), exponent


def top_place(df: DataFrame, value: str) -> DataFrame:
    """One row with the decimal place above the largest magnitude of a column, where digits begin; 0 without any."""
    whole, exponent = _written(F.col(value))
    place = F.when(whole > 0, F.length(whole.cast("string")) + exponent)
    return df.agg(F.coalesce(F.max(place), F.lit(0)).alias("place"))


def _ten_to(exponent: Column) -> Column:
    """10 to a power from 0 to 18, as a decimal."""
    powers = F.array(*[F.lit(Decimal(10**k)).cast(_WHOLE) for k in range(PLACES + 1)])
    return F.get(powers, exponent)


def digits(value, place) -> list[Column]:
    """Whole digits of a finite double to the base 10^18, highest first, signed like the value; ``place`` is from ``top_place``.

    What lies below the last digit is cut off.
    """
    whole, exponent = _written(value)
    # The number of places between the value's last digit and the lowest one that is kept.
    shift = exponent - (place - DIGITS * PLACES)
    kept = F.when(shift >= 0, whole.cast(_WHOLE)).when(shift < -PLACES, F.lit(0).cast(_WHOLE)).otherwise(
        F.floor(whole.cast(_WHOLE) / _ten_to(-shift)).cast(_WHOLE))
    shift = F.greatest(shift, F.lit(0))
    moved = kept * _ten_to(shift % PLACES)
    low = F.pmod(moved, F.lit(Decimal(BASE)).cast(_WHOLE))
    high = ((moved - low) / F.lit(Decimal(BASE)).cast(_WHOLE)).cast(_WHOLE)
    at, sign = F.floor(shift / PLACES), F.when(value < 0, F.lit(-1)).otherwise(F.lit(1))
    return [(F.when(at == k, low).when(at + 1 == k, high).otherwise(F.lit(0).cast(_WHOLE)) * sign).cast("decimal(28,0)")
            for k in range(DIGITS - 1, -1, -1)]


def sign_of_sum(parts: Sequence[Column]) -> Column:
    """-1, 0 or 1: the sign of a number given by whole digits to the base 10^18 of any size, highest first."""
    base = F.lit(Decimal(BASE)).cast(_WHOLE)
    carry, rests = F.lit(0).cast("decimal(38,0)"), []
    for part in reversed(parts[1:]):
        total = part.cast("decimal(38,0)") + carry
        rest = F.pmod(total, base)
        rests.append(rest)
        carry = ((total - rest) / base).cast("decimal(38,0)")
    top = parts[0].cast("decimal(38,0)") + carry
    more = F.lit(False)
    for rest in rests:
        more = more | (rest > 0)
    return F.when(top < 0, -1).when((top > 0) | more, 1).otherwise(0)


def order_bits(value: Column) -> Column:
    """A long that orders nonnegative finite doubles as they are, from 0 to 2^63: their bits read as a number."""
    e = binary_exponent(value)
    normal = e >= -1022
    # 2^52 steps for each power of two; below the least normal number the steps are 2^-1074.
    steps = F.when(normal, (value / _power(e) - 1) * F.lit(float(1 << 52))).otherwise(value / F.lit(2.0**-1022) * F.lit(float(1 << 52)))
    bits = F.when(normal, e + 1023).otherwise(0).cast("bigint") * F.lit(1 << 52) + F.floor(steps)
    return F.when(value > 0, bits).otherwise(F.lit(0))


def age_order(age: Column, member_id: Column) -> Column:
    """A decimal that is least for the greatest age and, among equal ages, for the least id.

    Any long can be an id, any nonnegative finite double an age. The number has 127 bits, so it fits a decimal, which
    a hash aggregation can hold where a struct of both would make it sort.
    """
    behind = (F.lit((1 << 62) - 1) - order_bits(age.cast("double"))).cast("decimal(38,0)")
    return behind * F.lit(Decimal(1 << 64)).cast("decimal(38,0)") + member_id.cast("decimal(38,0)") + F.lit(Decimal(1 << 63)).cast("decimal(38,0)")
