"""Interview dates kept as ``yyyy-mm-dd`` text with sentinels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kinfold.functions.missing import col, last_match

# Fixed value: text the survey writes for an interview that did not happen.
NO_DATE = "##N/A##"


def month_key(date) -> Column:
    return F.substring(col(date).cast("string"), 1, 7)


def month_number(date) -> Column:
    """Months since year 0 of a ``yyyy-mm…`` text, missing for any other text.

    Aggregates over many rows should take the maximum of this and not of the text:
    Spark adds up numbers in hash tables, but has to sort the rows for text.
    """
    text = col(date).cast("string")
    year, month = F.substring(text, 1, 4).try_cast("int"), F.substring(text, 6, 2).try_cast("int")
    return F.when((F.substring(text, 5, 1) == "-") & month.between(1, 12), year * 12 + month - 1)


def month_text(number) -> Column:
    """The ``yyyy-mm`` text of a month number."""
    number = col(number)
    year = F.floor(number / 12).cast("int").cast("string")
    month = (number % 12 + 1).cast("string")
    return F.concat(F.lpad(year, 4, "0"), F.lit("-"), F.lpad(month, 2, "0"))


def interview_or_first_visit(interview, visit1) -> Column:
    """The interview date, or the first visit where the sentinel stands in its place."""
    return F.when(col(interview) == NO_DATE, col(visit1)).otherwise(col(interview))


def visit_date(group, visit1, visit2) -> Column:
    """Date on which a household of visit group 1 or 2 answered.

    Blank falls back to the second visit, and only then the sentinel to the first.
    """
    group, visit1, visit2 = col(group), col(visit1), col(visit2)
    by_group = F.when(group == 1, visit1).when(group == 2, visit2)
    filled = F.when(F.coalesce(by_group, F.lit("")) == "", visit2).otherwise(by_group)
    return last_match([(filled == NO_DATE, visit1)], otherwise=filled)
