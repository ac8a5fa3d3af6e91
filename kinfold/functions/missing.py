"""Missing-value rules of survey data, as Spark expressions.

Surveys treat a missing number as larger than every number, as equal to another
missing number, and as nothing in totals. SQL nulls do none of that, so the rules
are spelled out here once and used everywhere else.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def above(c, bound) -> Column:
    """``c > bound`` where a missing ``c`` counts as above."""
    return col(c).isNull() | (col(c) > bound)


def at_least(c, bound) -> Column:
    """``c >= bound`` where a missing ``c`` counts as above."""
    return col(c).isNull() | (col(c) >= bound)


def differs(c, value) -> Column:
    """``c != value``, true for a missing ``c``."""
    return ~same(c, F.lit(value) if not isinstance(value, Column) else value)


def same(a, b) -> Column:
    """Equality in which two missing values are equal."""
    return col(a).eqNullSafe(col(b))


def is_true(condition: Column) -> Column:
    """A condition with unknown turned into false."""
    return F.coalesce(condition, F.lit(False))


def any_missing(*cols) -> Column:
    return reduce(or_, [col(c).isNull() for c in cols])


def fill_zero(c) -> Column:
    return F.coalesce(col(c), F.lit(0))


def row_total(*cols) -> Column:
    """Sum across columns, a missing cell counting as zero."""
    return reduce(add, [F.coalesce(col(c).cast("double"), F.lit(0.0)) for c in cols])


def row_max(*cols) -> Column:
    """Largest non-missing cell."""
    return F.greatest(*[col(c) for c in cols]) if len(cols) > 1 else col(cols[0])


def group_total(c) -> Column:
    """Aggregate: total of a group, 0 when every value is missing."""
    return F.coalesce(F.sum(col(c)), F.lit(0))


def ratio(a, b) -> Column:
    """Division that gives missing, not an error, for a zero divisor."""
    return F.try_divide(col(a).cast("double"), col(b).cast("double"))


def last_match(rules: Sequence[tuple[Column, object]], otherwise=None) -> Column:
    """Value of the last rule whose condition holds.

    Rules are listed in the order an analyst would run them, each overwriting the
    ones before, also when the later value is missing.
    """
    expression = None
    for condition, value in reversed(rules):
        value = value if isinstance(value, Column) else F.lit(value)
        expression = F.when(condition, value) if expression is None else expression.when(condition, value)
    return expression.otherwise(otherwise if isinstance(otherwise, Column) else F.lit(otherwise))


def blank_as_missing(c, *sentinels: str) -> Column:
    """Empty text and the given sentinel texts become null."""
    c = col(c)
    return F.when(c.isin("", *sentinels), F.lit(None)).otherwise(c)


def codes_as_missing(c, *codes: int) -> Column:
    c = col(c)
    return F.when(c.isin(*codes), F.lit(None)).otherwise(c)
