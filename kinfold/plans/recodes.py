"""Group recodes and label texts of the modelling table."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kinfold.functions.recode import grouped, label_text

# Code sets of the grouped variables, open upper groups, and texts.
ROAD = {1: [1, 2], 0: [3, 4]}
WATER = {1: [1, 2, 3], 2: [4, 5, 6, 7], 3: [8]}
WATER_OTHER = (4, 9)
MARRIAGE = {1: [1, 2, 3], 2: [4, 5]}
EDUCATION = {1: [1], 2: [2, 3], 3: [4]}
EDUCATION_TOP = (4, 5)
INCOME = {1: [1, 2], 2: [3], 3: [4, 5]}
WEALTH_STEPS = {1: "1-poor", 2: "2", 3: "3", 4: "4", 5: "5", 6: "6-rich"}

VALUE_LABELS = {
    "gender": {0: "Male", 1: "Female"},
    "hh_head_gender": {0: "Male", 1: "Female"},
    "mother_presence": {0: "No", 1: "Yes"},
    "father_presence": {0: "No", 1: "Yes"},
    "gr_total0_17": {1: "1-2", 2: "3-4", 3: "5 or more"},
    "food_score_ctg": {0: "Poor food consumption", 1: "Borderline food consumption",
                       2: "Acceptable food consumption"},
    "freq_religion": {1: "Traditional", 2: "Islam", 3: "Christian", 4: "Other religion", 5: "None"},
    "freq_marriage": {1: "Matrilineal and neolocal", 2: "Matrilineal and matrilocal",
                      3: "Matrilineal and patrilocal", 4: "Patrilineal and neolocal",
                      5: "Patrilineal and patrilocal"},
    "mother_educ": {1: "NONE", 2: "PSLC", 3: "JCE", 4: "MSCE", 5: "NON-UNIV DIPLOMA",
                    6: "UNIVER DIPLOMA, DEGREE", 7: "POST-GRAD DEGREE"},
    "father_educ": {1: "NONE", 2: "PSLC", 3: "JCE", 4: "MSCE", 5: "NON-UNIV DIPLOMA",
                    6: "UNIVER DIPLOMA, DEGREE", 7: "POST-GRAD DEGREE"},
    "father_job": {1: "WAGE EMPLOYMENT EXCLUDING GANYU", 2: "HOUSEHOLD BUSINESS (NONAG)",
                   3: "UNPAID HOUSEHOLD LABOR(AGRIC)", 4: "UNPAID APPRENTICESHIP", 5: "GANYU", 6: "UNEMPLOYED"},
    "school_feed_beneficiary": {0: "No", 1: "Yes"},
    "wellbeing_better_neighbors": {0: "No", 1: "Yes"},
    "wellbeing_better_friends": {0: "No", 1: "Yes"},
    "dropout": {1: "Yes", 0: "No"},
    "road_type": {1: "Asphalt/graded graveled", 0: "Dirt road/dirt track"},
    "drink_water_type": {1: "Pipe", 2: "Well", 3: "Borehole", 4: "Other"},
    "freq_marriage_type2": {1: "Matrilineal", 2: "Patrilineal"},
    "father_educ_type2": {1: "None", 2: "PSLC/JCE", 3: "MSCE", 4: "NonUni/Uni Diploma"},
    "mother_educ_type2": {1: "None", 2: "PSLC/JCE", 3: "MSCE", 4: "NonUni/Uni Diploma"},
    "hh_t08_type2": {1: "Allow to save", 2: "Only just meet expenses", 3: "Not sufficient"},
}


def road_type(c) -> Column:
    return grouped(c, ROAD)


def drink_water_type(c) -> Column:
    return grouped(c, WATER, WATER_OTHER)


def marriage_type(c) -> Column:
    return grouped(c, MARRIAGE)


def education_type(c) -> Column:
    return grouped(c, EDUCATION, EDUCATION_TOP)


def income_type(c) -> Column:
    return grouped(c, INCOME)


def wealth_step(c) -> Column:
    return label_text(c, WEALTH_STEPS)


def yes_no(dummy) -> Column:
    return label_text(dummy, {1: "Yes", 0: "No"})


def quintile_dummies(quintile: str, prefix: str) -> dict[str, Column]:
    """0/1 columns of quintiles 1 to 5, missing for a missing quintile."""
    q = F.col(quintile)
    return {f"{prefix}{k}": F.when(q.isNotNull(), (q == k).cast("int")) for k in range(1, 6)}
