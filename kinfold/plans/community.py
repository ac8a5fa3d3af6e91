"""Community tables: most frequent answers, distances in metres, shocks; one row per community."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.functions.household import most_frequent, to_metres
from kinfold.operators.dedup import least_row
from kinfold.operators.merge import merge
from kinfold.operators.reshape import to_wide_flags

COMMUNITY = "ea_id"

# Question pairs (answer, household count) of the three most frequent
# answers, and the distance questions with their unit, presence and own rules.
FREQUENT = {
    "freq_religion": [("com_cc04a", "com_cc04b"), ("com_cc04c", "com_cc04d"), ("com_cc04e", "com_cc04f")],
    "freq_language": [("com_cc05a", "com_cc05b"), ("com_cc05c", "com_cc05d"), ("com_cc05e", "com_cc05f")],
    "freq_marriage": [("com_cc07a", "com_cc07b"), ("com_cc07c", "com_cc07d"), ("com_cc07e", "com_cc07f")],
}
BASIC_KEPT = ["com_cc01", "com_cc02", "com_cc03", "com_cc06", "com_cc08", "com_cc09", "com_cc10", "com_cc11",
              "com_cc12", "com_cc13", "com_cc14"]
NO_METRES = {"units": (2, 3)}
ZERO_UNIT = {"units": (1, 2), "zero_unit": True}
DISTANCES = {
    "com_cd02a_meter": ("com_cd02a", "com_cd02b", None, {}),
    "com_cd07a_meter": ("com_cd07a", "com_cd07b", "com_cd06", {}),
    "com_cd10a_meter": ("com_cd10a", "com_cd10b", "com_cd09", NO_METRES),
    "com_cd13a_meter": ("com_cd13a", "com_cd13b", "com_cd12", NO_METRES),
    "com_cd16_meter": ("com_cd16", "com_cd16b", "com_cd15", {}),
    "com_cd18a_meter": ("com_cd18a", "com_cd18b", "com_cd17", {}),
    "com_cd20a_meter": ("com_cd20a", "com_cd20b", "com_cd19", {}),
    "com_cd22a_meter": ("com_cd22a", "com_cd22b", "com_cd21", {}),
    "com_cd24a_meter": ("com_cd24a", "com_cd24b", "com_cd23", {}),
    "com_cd27a_meter": ("com_cd27a", "com_cd27b", None, ZERO_UNIT),
    "com_cd36a_meter": ("com_cd36a", "com_cd36b", None, {}),
    "com_cd40a_meter": ("com_cd40a", "com_cd40b", None, ZERO_UNIT),
    "com_cd49a_meter": ("com_cd49a", "com_cd49b", "com_cd48", {}),
    "com_cd51a_meter": ("com_cd51a", "com_cd51b", "com_cd50", {}),
    "com_cd67a_meter": ("com_cd67a", "com_cd67b", "com_cd66", {}),
    "com_cd69a_meter": ("com_cd69a", "com_cd69b", "com_cd68", {}),
}
SHOCK_CODES = [2, 3, 4, 5, 6, 7, 8, 9, 10, 12, 19, 20]
# Codes of the same question that no column is kept for.
OTHER_SHOCKS = [0, 1, 11, 13, 14, 15, 16, 17, 18]


def community_basic(df: DataFrame) -> DataFrame:
    answers = least_row(df, [COMMUNITY])
    frequent = [most_frequent([a for a, _ in pairs], [n for _, n in pairs]).alias(name) for name, pairs in FREQUENT.items()]
    return answers.select(COMMUNITY, *[c for c in BASIC_KEPT if c in df.columns], *frequent)


def community_services(df: DataFrame) -> DataFrame:
    metres = {name: to_metres(d, unit, present, **rules)
              for name, (d, unit, present, rules) in DISTANCES.items() if d in df.columns}
    return least_row(df, [COMMUNITY]).withColumns(metres)


def community_shocks(df: DataFrame, compat: bool = False) -> DataFrame:
    """1/missing per shock; ``compat`` leaves code 7 as it is, as if it had not been recoded."""
    known = df.filter(F.col("com_cg35c").isNotNull()).select(COMMUNITY, "com_cg35c").distinct()
    return to_wide_flags(known, [COMMUNITY], "com_cg35c", SHOCK_CODES, "com_shocks", keep_code=[7] if compat else (),
                         ignored=OTHER_SHOCKS)


def community_table(basic: DataFrame, services: DataFrame, economy: DataFrame, changes: DataFrame | None = None,
                    compat: bool = False) -> DataFrame:
    """All community tables side by side.

    Households can come from communities that only some of the tables know, so the
    join starts from every community named in any of them.
    """
    tables = [community_basic(basic), community_services(services), least_row(economy, [COMMUNITY])]
    if changes is not None:
        tables.append(community_shocks(changes, compat))
    out = tables[0].select(COMMUNITY)
    for table in tables[1:]:
        out = out.union(table.select(COMMUNITY))
    out = out.distinct()
    for table in tables:
        out = merge(out, table, COMMUNITY, validate=False, split_hot=False)
    return out
