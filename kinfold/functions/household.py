"""Household and member formulas, all parameterised by column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from kinfold.functions.missing import above, any_missing, at_least, col, last_match, ratio, same
from kinfold.functions.recode import banded

# Age limits, equivalence scales, score weights and score bands.
ADULT_AGE = 18
ELDERLY_ABOVE = 60
SCALE_NEW = {"adult": 0.5, "child": 0.3}
SCALE_OLD = {"adult": 0.7, "child": 0.5}
CHILD_GROUPS = [(1, 1, 2), (2, 3, 4), (3, 5, None)]
FOOD_WEIGHTS = {"staples": 2.0, "pulses": 3.0, "vegetables": 1.0, "fruit": 1.0,
                "meat_fish": 4.0, "milk": 4.0, "sugar": 0.5, "oil": 0.5}
FOOD_LIMITS = (21, 35)
COPING_WEIGHTS = {"less_expensive": 1, "portion": 1, "reduce_meals": 1, "child": 3, "borrow": 2}
ABSENT_PARENT = (97, 98, 99)
UNEMPLOYED = 6
METRES = {1: 1.0, 2: 1000.0, 3: 1609.344}
PRIMARY_GRADES = (1, 8)


def age_with_fallback(latest, first) -> Column:
    return F.coalesce(col(latest), col(first))


def adult(age) -> Column:
    return (col(age) >= ADULT_AGE).cast("int")


def child(age) -> Column:
    return col(age).between(0, ADULT_AGE - 1).cast("int")


def elderly(age) -> Column:
    """An unknown age counts as elderly."""
    return above(age, ELDERLY_ABOVE).cast("int")


def child_group(children) -> Column:
    return banded(children, CHILD_GROUPS)


def equivalence_scale(members, adults, children, weights: Mapping[str, float]) -> Column:
    """Adult-equivalent size; missing for a lone member who is no adult."""
    members, adults, children = col(members), col(adults), col(children)
    size = F.lit(1.0) + (adults - 1) * F.lit(weights["adult"]) + children * F.lit(weights["child"])
    return F.when(members > 1, size).when((members == 1) & (adults == 1), F.lit(1.0))


def weighted_sum(weights: Mapping[str, float]) -> Column:
    """Sum of column times weight, missing if any column is missing."""
    return reduce(add, [col(c).cast("double") * F.lit(float(w)) for c, w in weights.items()])


def staples(a, b) -> Column:
    """Mean of two day counts, or the known one where one is missing."""
    a, b = col(a).cast("double"), col(b).cast("double")
    return F.when(any_missing(a, b), F.greatest(a, b)).otherwise((a + b) / F.lit(2.0))


def food_score(**days) -> Column:
    """Food consumption score from day counts named as in FOOD_WEIGHTS."""
    return reduce(add, [col(days[name]).cast("double") * F.lit(w) for name, w in FOOD_WEIGHTS.items()])


def food_band(score) -> Column:
    score = col(score)
    poor, borderline = FOOD_LIMITS
    return F.when(score <= poor, 0).when(score <= borderline, 1).when(score > borderline, 2)


def coping_index(**answers) -> Column:
    return reduce(add, [col(answers[name]).cast("double") * F.lit(float(w)) for name, w in COPING_WEIGHTS.items()])


def coping_flags(index) -> dict[str, Column]:
    """Secure, moderate and severe flags; a fraction between two bands is in neither."""
    index = col(index)

    def band(inside: Column) -> Column:
        return F.when(index.isNotNull(), inside.cast("int"))

    return {
        # A negative index satisfies neither side of the first flag.
        "food_secure": F.when(index.between(0, 4), 1).when(index > 4, 0),
        "mod_insecure": band(index.between(5, 10)),
        "sev_insecure": band(index >= 11),
    }


def to_metres(distance, unit, present=None, units: Sequence[int] = (2, 3, 1),
              zero_distance: bool = True, zero_unit: bool = False) -> Column:
    """Distance to a service in metres.

    A service that is present, or at distance 0, is at 0; a unit rule applied later
    overwrites that, also with a missing distance.
    """
    distance, unit = col(distance).cast("double"), col(unit)
    rules = []
    if zero_unit:
        rules.append((unit == 0, F.lit(0.0)))
    at_hand = []
    if present is not None:
        at_hand.append(F.coalesce(col(present) == 1, F.lit(False)))
    if present is not None and zero_distance:
        at_hand.append(F.coalesce(distance == 0, F.lit(False)))
    if at_hand:
        rules.append((reduce(lambda a, b: a | b, at_hand), F.lit(0.0)))
    rules += [(unit == u, distance * F.lit(METRES[u])) for u in units]
    return last_match(rules, otherwise=F.lit(None).cast("double"))


def to_minutes(duration, unit) -> Column:
    duration, unit = col(duration).cast("double"), col(unit)
    return F.when(unit == 2, duration * F.lit(60.0)).when(unit == 1, duration)


def most_frequent(options: Sequence, counts: Sequence) -> Column:
    """Option with the largest count; the last one wins a tie, also when no count is known."""
    top = F.greatest(*[col(c) for c in counts])
    out = F.lit(None)
    for option, count in zip(options, counts):
        out = F.when(same(count, top), col(option)).otherwise(out)
    return out


def parent_absent(parent_id) -> Column:
    return col(parent_id).isNull() | col(parent_id).isin(*ABSENT_PARENT)


def parent_education(parent_id, own_answer, stand_in) -> Column:
    """The answer given for the parent; an absent parent is replaced by the oldest adult."""
    return F.when(parent_absent(parent_id), F.coalesce(col(stand_in), col(own_answer))).otherwise(col(own_answer))


def parent_job(parent_id, parent_value, head_value, default=UNEMPLOYED) -> Column:
    chosen = F.when(parent_absent(parent_id), col(head_value)).otherwise(col(parent_value))
    return F.coalesce(chosen, F.lit(default))


def per_adult(amount, adults) -> Column:
    """Amount per adult, the plain amount where there is no adult."""
    adults = col(adults)
    return F.when(adults == 0, col(amount).cast("double")).otherwise(ratio(amount, adults))


def better_off(own, other) -> Column:
    return (col(own) > col(other)).cast("int")


def left_school(attends1, grade1, entry1, attends2, left2, reason2) -> Column:
    """1 for a primary pupil of the first wave who left by the second, 0 for one who stayed.

    An unknown year of entry counts as late enough (missing is above any year).
    """
    pupil = (col(attends1) == 1) & col(grade1).between(*PRIMARY_GRADES)
    stayed = F.coalesce(col(left2) == 1, F.lit(False)) | F.coalesce(col(attends2) == 1, F.lit(False))
    left = (col(attends2) == 2) & (col(left2) == 2) & at_least(entry1, 2015) & col(reason2).isNotNull()
    return F.when(pupil & stayed, 0).when(pupil & left, 1)
