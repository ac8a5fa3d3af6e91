"""From survey tables to one row per primary-school child with a 0/1 target.

Shape of the plan. Member tables are joined on the member id, household tables on
the household id, community tables on the community id, each time with one row per
key on both sides. Only then does the household row meet its members, in one join
that AQE can split on a hot household.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from contextlib import nullcontext
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.functions import household as hf
from kinfold.functions.dates import NO_DATE, month_key, month_number, month_text, visit_date
from kinfold.functions.missing import group_total
from kinfold.functions.recode import equals_any, flag, swap
from kinfold.operators.groups import value_where
from kinfold.operators.merge import MATCHED, merge, parent_lookup, require_unique, with_suffix
from kinfold.operators.quantiles import weighted_quantile_group
from kinfold.operators.reshape import to_wide
from kinfold.operators.wealth import asset_index
from kinfold.plans import recodes
from kinfold.plans.community import COMMUNITY, community_table
from kinfold.plans.composition import household_composition
from kinfold.plans.family import FEMALE, HEAD, MALE, beneficiary_list, head_value, most_severe, oldest_adult, oldest_flag
from kinfold.plans.income import assistance, assistance_per_adult, other_income
from kinfold.plans.labour import labour_hours
from kinfold.plans.spending import food_spending, recall_spending, total_spending
from kinfold.session import Steps, cut_lineage, freed_shuffles, written_tables
from kinfold.sources.labels import dictionary_rows, with_captions
from kinfold.sources.tables import read_table, write_table

HH, PID, MEMBER = "y3_hhid", "PID", "id_code"
WAVES = "_merge_hhc_2019"

# Survey tables, their columns and codes, and the modelling table.
SURVEY_TABLES = {
    "roster": "hh_mod_b_16", "household_id": "hh_mod_a_filt_16", "education": "hh_mod_c_16", "health": "hh_mod_d_16",
    "labour": "hh_mod_e_16", "housing": "hh_mod_f_16", "food_items": "hh_mod_g1_16", "food_days": "hh_mod_g2_16",
    "food_security": "hh_mod_h_16", "nonfood_week": "hh_mod_i1_16", "nonfood_month": "hh_mod_i2_16",
    "nonfood_quarter": "hh_mod_j_16", "nonfood_year": "hh_mod_k1_16", "assets": "hh_mod_l_16",
    "enterprise": "hh_mod_n1_16", "other_income": "hh_mod_p_16", "safety_nets": "hh_mod_r_16",
    "wellbeing": "hh_mod_t_16", "shocks": "hh_mod_u_16", "community_basic": "com_cc_16",
    "community_services": "com_cd_16", "community_economy": "com_ce_16", "community_changes": "com_cg_16",
    "plots": "ag_mod_d_16", "follow_up": "hh_mod_c_19", "prices": "price_index",
}
NONFOOD = {"nonfood_week": ("i1", "hh_i03"), "nonfood_month": ("i2", "hh_i06"), "nonfood_quarter": ("j", "hh_j03"),
           "nonfood_year": ("k", "hh_k03")}
PERIODS = {"i1": "week", "i2": "month", "j": "quarter", "k": "year"}
FOLLOW_UP = ["PID", "y4_hhid", "hh_c06", "hh_c08", "hh_c09", "hh_c11", "hh_c12", "hh_c13", "hh_c14", "hh_c14_oth",
             "hh_c15", "hh_c20", "hh_c21"]
ASSET_CODES = [*range(501, 533), 5081]
FATHER_FACTS = ["hh_b23", "hh_c05a", "hh_c05b", "hh_c06", "hh_c08", "hh_c09", "hh_d33", "hh_e06_8a"]
MOTHER_FACTS = ["hh_b23", "hh_b24", "hh_c05a", "hh_c05b", "hh_c06", "hh_c08", "hh_c09", "hh_d33", "hh_e06_8a"]
OLDEST_FACTS = {"religion": "hh_b23", "lang1": "hh_c05a", "lang2": "hh_c05b", "attend": "hh_c06", "edu": "hh_c09",
                "ill": "hh_d33", "job": "hh_e06_8a"}
OLDEST_FEMALE_FACTS = {**OLDEST_FACTS, "marital": "hh_b24"}
SCHOOL_FEEDING = 105
LIST_PLACES = ["a", "b", "c", "d", "e"]
HOUSEHOLD_FACTS = ["ea_id", "panelweight_2016", "interviewdate_v1", "interviewdate_v2"]

FINAL = """
    y3_hhid PID ea_id dropout panelweight_2016
    gender hh_c12 hh_head_gender hh_c05a hh_c05b hh_c17 school_travel_min hh_c22j hh_d13 hh_d33 hh_e05 hh_e06 hh_e06_1a
    hh_e06_1b hh_e06_1c hh_e06_2 hh_e06_3 hh_e06_4 hh_e06_5 hh_e06_6 mother_presence father_presence father_job
    father_educ_type2 mother_educ_type2
    hh_f01 hh_f08 hh_f09 hh_f11 hh_f12 hh_f19 phone_per_adult hh_f41 hh_f44 hh_f48 total0_17 num_elderly
    total_aes1_exp_inf food_consumption_score r_csi asset_q2_recoded asset_q3_recoded asset_q4_recoded asset_q5_recoded
    hh_n01 hh_n02 hh_n03 hh_n04 hh_n05 hh_n06 hh_n07 hh_n08 total_assist_invalue school_feed_beneficiary hh_t02 hh_t03
    hh_t04 cat_hh_t05 wellbeing_better_neighbors wellbeing_better_friends hh_u0a_most_severe drink_water_type
    hh_t08_type2
    com_cc02 freq_religion com_cc08 com_cc09 com_cc14 com_cd16_meter com_cd18a_meter com_cd20a_meter com_cd22a_meter
    com_cd24a_meter com_cd25 com_cd26 com_cd27a_meter com_cd28 com_cd29 com_cd30 com_cd32 com_cd35 com_cd49a_meter
    com_cd51a_meter com_cd55 com_cd67a_meter com_cd69a_meter com_ce01a com_ce02 com_ce06 com_ce08_1 com_ce09 road_type
    freq_marriage_type2
""".split()
# Columns that only serve to compute those: of members, of households, of communities.
MEMBER_IN = [
    PID, MEMBER, WAVES, *MOTHER_FACTS, "age", "hh_b04", "hh_b16b", "hh_b18", "hh_b19b", "hh_b21", "hh_c11", "hh_c15",
    "hh_c19a", "hh_c19b", "hh_c11_19", "hh_c13_19", "hh_c15_19", "interviewdate_v1", "interviewdate_v2",
]
HOUSEHOLD_IN = [
    "total_hh_member", "total_adult", "aes1", "aes2", "oldest_female", "oldest_male", "hh_head_job", "n_both_waves",
    "interviewdate_v1", "interviewdate_v2", "hh_f34", "hh_f36", *[f"hh_g08{x}" for x in "abcdefghi"],
    *[f"hh_h02{x}" for x in "abcde"], "aes1_total_exp_food", *[f"aes1_total_exp_non_food_{t}" for t in PERIODS],
    "cash_assistance_12month", "inkind_assistance_12month", *[f"food_feed_hhline{p}" for p in LIST_PLACES],
    "hh_t05", "hh_t06", "hh_t07", "hh_t08", "asset_q",
]
COMMUNITY_IN = ["com_cd01", "freq_marriage"]
CAPTIONS = {
    "gender": "1 for women and girls, 0 for men and boys", "total0_17": "Members below 18 in the household",
    "num_elderly": "Members above 60, or of unknown age, in the household",
    "father_job": "Work of the father, or of the household's head where the father lives elsewhere",
    "dropout": "1 if the child left primary school between the two waves",
    "road_type": "1 for a paved or good road to the community", "drink_water_type": "Where the household's drinking water comes from",
    "freq_marriage_type2": "Descent that most marriages of the community follow",
    "father_educ_type2": "Schooling of the father or the oldest man", "mother_educ_type2": "Schooling of the mother or the oldest woman",
    "hh_t08_type2": "Whether income covers more or less than the household's needs",
    "school_travel_min": "Way to school in minutes", "phone_per_adult": "Mobile phones for each adult",
    "total_aes1_exp_inf": "Monthly spending at base prices for each equivalent adult",
    "food_consumption_score": "Weighted days on which food groups were eaten in a week",
    "r_csi": "Weighted days on which the household had to cope with too little food",
    "total_assist_invalue": "Monthly assistance in cash and kind for each equivalent adult",
    "school_feed_beneficiary": "1 if the child is fed at school", "cat_hh_t05": "Step of the wealth ladder the household sees itself on",
    "wellbeing_better_neighbors": "1 if better off than the neighbours, in its own view",
    "wellbeing_better_friends": "1 if better off than its friends, in its own view",
    "hh_u0a_most_severe": "Code of the shock that hit the household hardest",
    "mother_presence": "1 if the mother lives in the household", "father_presence": "1 if the father lives in the household",
    **{f"asset_q{k}_recoded": f"Whether the household is in wealth quintile {k}" for k in range(2, 6)},
}


# What the member table has besides, described by rule.
_UNIT_TEXTS = {"aes1": "for each equivalent adult", "aes2": "for each equivalent adult on the older scale", "pc": "for each member"}
_FOOD_TEXTS = {"cereals": "cereals", "roots": "roots and tubers", "nuts": "nuts and pulses", "veggie": "vegetables", "meat": "meat, fish and eggs",
               "fruit": "fruit", "cooked": "cooked food", "milk": "milk", "sugar": "sugar, fat and oil", "beverage": "drinks", "spice": "spices"}
_PERIOD_TEXTS = {"i1": "a week", "i2": "a month", "j": "three months", "k": "a year"}
_FACT_TEXTS = {"religion": "Religion", "lang1": "Whether reading and writing in the first language is possible",
               "lang2": "Whether reading and writing in the second language is possible", "attend": "Whether school was ever attended",
               "edu": "Highest schooling", "ill": "Illness", "job": "Main work", "marital": "Marital status"}
MEMBER_CAPTIONS = {
    **CAPTIONS,
    "age": "Age in years, from the later answer or else the earlier one", "total_hh_member": "Members of the household",
    "total_adult": "Members of 18 years and more", "gr_total0_17": "Band of the number of members below 18",
    "aes1": "Equivalent adults of the household", "aes2": "Equivalent adults of the household on the older scale",
    "hh_head_gender": "Sex of the household's head", "hh_head_job": "Main work of the household's head",
    "total_aes1_nonfood_exp_inf": "Monthly spending on other things than food at base prices for each equivalent adult",
    **{f"{u}_total_exp_food": f"Monthly spending on food at base prices {text}" for u, text in _UNIT_TEXTS.items()},
    **{f"{u}_exp_{c}2": f"Monthly spending on {food} at base prices {text}"
       for c, food in _FOOD_TEXTS.items() for u, text in _UNIT_TEXTS.items()},
    **{f"nonfood_exp_monthly_{t}": f"Monthly spending on what is remembered for {span}" for t, span in _PERIOD_TEXTS.items()},
    **{f"{u}_total_exp_non_food_{t}": f"Monthly spending on what is remembered for {span}, at base prices {text}"
       for t, span in _PERIOD_TEXTS.items() for u, text in _UNIT_TEXTS.items()},
    **{f"total_rainy_labor_{t}": f"Hours of {work} on all plots in the rainy season" for t, work in (
        ("landprep", "preparing land"), ("weed", "weeding"), ("harvest", "harvesting"))},
    "food_score_ctg": "Band of the food consumption score", "other_income_monthly": "Monthly income from transfers and other sources",
    "cash_assistance_12month": "Assistance in cash over twelve months", "inkind_assistance_12month": "Assistance in kind over twelve months",
    "aes1_monthly_cash_assist": "Monthly assistance in cash for each equivalent adult",
    "aes1_monthly_inkind_assist": "Monthly assistance in kind for each equivalent adult",
    "asset_sale_value": "What the household's assets would sell for", "assetindex": "First component of the assets owned",
    "asset_q": "Wealth quintile of the household", "school_feed": "1 if listed for feeding at school",
    "mother_educ": "Schooling of the mother or the oldest woman, as coded", "father_educ": "Schooling of the father or the oldest man, as coded",
    "oldest_female_hh": "1 for the oldest woman of the household", "oldest_male_hh": "1 for the oldest man of the household",
    **{f"oldest_{sex}_{n}": f"{_FACT_TEXTS[n]} of the household's oldest {who}"
       for sex, who, facts in (("female", "woman", OLDEST_FEMALE_FACTS), ("male", "man", OLDEST_FACTS)) for n in facts},
    "freq_religion": "Religion of most households of the community", "freq_language": "Language of most households of the community",
    "freq_marriage": "Kind of marriage of most households of the community",
}


def load_survey(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The survey's tables from Parquet files named as the survey names them."""
    return {name: read_table(spark, f"{folder.rstrip('/')}/{file}.parquet") for name, file in SURVEY_TABLES.items()}


def people_table(tables: Mapping[str, DataFrame], validate: bool = True) -> DataFrame:
    """Members with education, health, labour and the follow-up wave (indicator 1 or 3).

    Member ids are unique in all of them, so every merge is one-to-one; the roster is checked once.
    """
    people = require_unique(tables["roster"], PID) if validate else tables["roster"]
    for name in ("education", "health", "labour"):
        people = merge(people, tables[name], PID, validate=validate, split_hot=False, one_to_one="known", name=name)
    later = tables["follow_up"]
    later = with_suffix(later.select(*[c for c in FOLLOW_UP if c in later.columns]), "_19", except_for=[PID, "y4_hhid"])
    people = merge(people, later, PID, indicator=WAVES, validate=validate, split_hot=False, one_to_one="known", name="follow_up")
    return people.withColumns({
        "gender": F.when(F.col("hh_b03") == 1, MALE).when(F.col("hh_b03") == 2, FEMALE),
        "mother_presence": flag(F.col("hh_b19a") == 1),
        "father_presence": flag(F.col("hh_b16a") == 1),
        "age": hf.age_with_fallback("hh_b06_3a", "hh_b05a"),
    })


def _only(df: DataFrame, key: str, columns: Sequence[str] | None) -> DataFrame:
    return df if columns is None else df.select(key, *[c for c in df.columns if c in columns and c != key])


def _household_base(tables: Mapping[str, DataFrame], people: DataFrame, validate: bool = True) -> DataFrame:
    """Sizes, head and oldest adults, and what the household questionnaire identifies.

    Sizes count every member of the first wave; the oldest adults and the head's job
    come from the members seen in both.
    """
    both = F.col(WAVES) == MATCHED
    female = oldest_adult("gender", FEMALE, "age", MEMBER, list(OLDEST_FEMALE_FACTS.values()), among=both)
    male = oldest_adult("gender", MALE, "age", MEMBER, list(OLDEST_FACTS.values()), among=both)
    own = [c for c in HOUSEHOLD_FACTS if c in people.columns]
    counted = household_composition(
        people, HH, "age", hh_head_gender=head_value("hh_b04", "gender"), oldest_female=female, oldest_male=male,
        hh_head_job=value_where(both & (F.col("hh_b04") == HEAD), "hh_e06_8a"), n_both_waves=F.count_if(both),
        **{c: F.max(c) for c in own})
    return merge(counted, tables["household_id"], HH, validate=validate, split_hot=False, one_to_one="known", name="household_id")


def _asset_table(tables: Mapping[str, DataFrame], base: DataFrame, validate: bool = True) -> DataFrame:
    """Assets owned (1/0), their value, the asset index and its weighted quintiles.

    The index counts a household once per member seen in both waves, the quintiles
    weigh those members by the panel weight.
    """
    assets = tables["assets"]
    owned = to_wide(assets.filter(F.col("hh_l02").isNotNull()), [HH], "hh_l02", ["hh_l01"], ASSET_CODES,
                    validate=validate)
    columns = [f"hh_l01{code}" for code in ASSET_CODES]
    owned = owned.withColumns({c: swap(c, {2: 0}) for c in columns})
    values = assets.groupBy(HH).agg(group_total(F.col("hh_l05").cast("double")).alias("asset_sale_value"))
    sized = base.select(HH, F.col("n_both_waves").cast("double").alias("n"),
                        (F.col("n_both_waves") * F.col("panelweight_2016")).alias("w"))
    # Fit, cuts and result all read this table.
    unique = {"validate": False, "split_hot": False, "one_to_one": "known"}
    wide = cut_lineage(merge(merge(values, owned, HH, **unique, name="assets_owned"), sized, HH, **unique, name="asset_sizes"))
    scored = asset_index(wide.filter("n > 0"), columns, "assetindex", weight="n")
    return weighted_quantile_group(scored, "assetindex", "w", "asset_q").drop("n", "w")


def household_table(tables: Mapping[str, DataFrame], people: DataFrame, *, with_assets: bool = True,
                    with_shocks: bool = False, compat: bool = False, validate: bool = True,
                    columns: Sequence[str] | None = None) -> DataFrame:
    """One row per household with every household and community value, or those among ``columns``."""
    # Sizes feed the spending and asset parts as well as the result.
    base = cut_lineage(_only(_household_base(tables, people, validate), HH, columns))
    nonfood = reduce(DataFrame.unionByName, [
        tables[name].select(HH, "qx_type", F.lit(tag).alias("tag"), F.col(amount).cast("double").alias("amount"))
        for name, (tag, amount) in NONFOOD.items()])
    food = food_spending(
        tables["food_items"], base, tables["prices"].withColumnRenamed("int_date_hhmod", "month"), household=HH,
        item="hh_g02", amount="hh_g05", carry=[
            F.max(month_number("interviewDate")).alias("interview_month"),
            F.max(F.when(F.col("interviewDate") == NO_DATE, 1)).alias("no_interview")],
        # The first visit stands in only where the sentinel says there was no interview.
        month=F.coalesce(month_text("interview_month"),
                         F.when(F.col("no_interview") == 1, month_key("interviewdate_v1"))), only=columns)
    recall = recall_spending(
        nonfood, base, tables["prices"].withColumnRenamed("int_date_hhmod", "month"), household=HH, amount="amount",
        tag="tag", periods=PERIODS, 
        # Each part of the questionnaire was asked at a visit of its own.
        carry=[F.max(F.when(F.col("tag") == t, F.col("qx_type"))).alias(f"visit_group_{t}") for t in PERIODS],
        month={t: month_key(visit_date(f"visit_group_{t}", "interviewdate_v1", "interviewdate_v2")) for t in PERIODS},
        only=columns)
    nets = tables["safety_nets"]
    # Answered once per household; the other parts are aggregates.
    once = {name: require_unique(tables[name], HH) if validate else tables[name]
            for name in ("housing", "food_days", "food_security", "enterprise", "wellbeing")}
    parts = {
        "housing": once["housing"], "food_spending": food, "food_days": once["food_days"], "food_security": once["food_security"],
        "nonfood_spending": recall, "enterprise": once["enterprise"],
        "other_income": other_income(tables["other_income"], HH, ["hh_p03a", "hh_p03b", "hh_p03c"], "hh_p02"),
        "assistance": assistance(nets, HH, "hh_r02a", "hh_r02b"),
        "school_feeding": beneficiary_list(nets.filter(F.col("hh_r0a") == SCHOOL_FEEDING), HH, "hh_r04", LIST_PLACES, "food_feed_hhline"),
        "wellbeing": once["wellbeing"],
        "shocks": most_severe(tables["shocks"], HH, "hh_u0a", "hh_u02", ["hh_u0a"], "hh_u0a_most_severe"),
    }
    if with_assets:
        parts["assets"] = _asset_table(tables, base, validate)
    out = base
    for name, part in parts.items():
        out = merge(out, _only(part, HH, columns), HH, validate=False, split_hot=False, one_to_one="known", name=name)
    communities = community_table(tables["community_basic"], tables["community_services"], tables["community_economy"],
                                  tables["community_changes"] if with_shocks else None, compat)
    # Once written its size is known, so Spark itself decides whether it may be broadcast.
    out = merge(out, cut_lineage(_only(communities, COMMUNITY, columns)), COMMUNITY, validate=False, name="community")
    return out.withColumns({
        "food_consumption_score": hf.food_score(
            staples=hf.staples("hh_g08a", "hh_g08b"), pulses="hh_g08c", vegetables="hh_g08d", meat_fish="hh_g08e",
            fruit="hh_g08f", milk="hh_g08g", oil="hh_g08h", sugar="hh_g08i"),
        "r_csi": hf.coping_index(less_expensive="hh_h02a", portion="hh_h02b", reduce_meals="hh_h02c",
                                 child="hh_h02d", borrow="hh_h02e"),
        "phone_per_adult": hf.per_adult("hh_f34", "total_adult"),
        "cat_hh_t05": recodes.wealth_step("hh_t05"),
        "wellbeing_better_neighbors": hf.better_off("hh_t05", "hh_t06"),
        "wellbeing_better_friends": hf.better_off("hh_t05", "hh_t07"),
        **total_spending("aes1_total_exp_food", [f"aes1_total_exp_non_food_{t}" for t in PERIODS]),
        **assistance_per_adult("aes1"),
        **(recodes.quintile_dummies("asset_q", "asset_q") if with_assets else {}),
    }).withColumns({
        "food_score_ctg": hf.food_band("food_consumption_score"),
        **{f"rcsi_{name}": c for name, c in hf.coping_flags("r_csi").items()},
        **({f"asset_q{k}_recoded": recodes.yes_no(f"asset_q{k}") for k in range(2, 6)} if with_assets else {}),
    })


def _member_values(members: DataFrame) -> DataFrame:
    """Values of the member that need the household row as well."""
    fed = equals_any(MEMBER, [f"food_feed_hhline{p}" for p in LIST_PLACES])
    return members.withColumns({
        "school_feed": fed, "school_feed_beneficiary": F.coalesce(fed, F.lit(0)),
        "oldest_female_hh": oldest_flag("oldest_female", MEMBER), "oldest_male_hh": oldest_flag("oldest_male", MEMBER),
        **{f"oldest_female_{n}": F.col(f"oldest_female.{c}") for n, c in OLDEST_FEMALE_FACTS.items()},
        **{f"oldest_male_{n}": F.col(f"oldest_male.{c}") for n, c in OLDEST_FACTS.items()},
        "school_travel_min": hf.to_minutes("hh_c19a", "hh_c19b"),
        "dropout": hf.left_school("hh_c11", "hh_c12", "hh_c15", "hh_c11_19", "hh_c13_19", "hh_c15_19"),
    }).withColumns({
        "mother_educ": hf.parent_education("hh_b19b", "hh_b21", "oldest_female_edu"),
        "father_educ": hf.parent_education("hh_b16b", "hh_b18", "oldest_male_edu"),
        "father_job": hf.parent_job("hh_b16b", "hh_e06_8a_father", "hh_head_job"),
    }).drop("oldest_female", "oldest_male")


def member_table(tables: Mapping[str, DataFrame], *, with_assets: bool = True, with_shocks: bool = True,
                 with_mothers: bool = True, with_hours: bool = True, compat: bool = False, validate: bool = True,
                 columns: Sequence[str] | None = None, in_steps: bool = False) -> DataFrame:
    """Every member seen in both waves with all values, before the modelling columns are chosen.

    The ``with_`` switches leave out parts nobody will read, so their tables are not
    read either; ``columns`` leaves out columns. ``in_steps`` writes members and households after each merge, which
    needs least disk where the whole table is wanted; without it, later selections still leave out what only others need.
    """
    with freed_shuffles(tables["roster"].sparkSession) if in_steps else nullcontext():
        return _member_table(tables, with_assets, with_shocks, with_mothers, with_hours, compat, validate, columns, in_steps)


def _member_table(tables, with_assets, with_shocks, with_mothers, with_hours, compat, validate, columns, in_steps):
    steps = Steps()

    def settled(df: DataFrame, *replaced: DataFrame) -> DataFrame:
        return steps.cut(df, *replaced) if in_steps else df

    # Read four times below: by household, by member, as fathers and as mothers.
    people = steps.cut(_only(people_table(tables, validate), HH, columns))
    households = settled(household_table(tables, people, with_assets=with_assets, with_shocks=with_shocks, compat=compat,
                                         validate=validate, columns=columns))
    seen = members = people.filter(F.col(WAVES) == MATCHED).drop(WAVES)
    done = []
    facts = [("hh_b16b", FATHER_FACTS, "_father")] + ([("hh_b19b", MOTHER_FACTS, "_mother")] if with_mothers else [])
    for parent, attributes, suffix in facts:
        # Fathers and mothers are looked up among the members themselves.
        known = [c for c in attributes if c in seen.columns]
        members = settled(parent_lookup(members, HH, MEMBER, parent, known, suffix, tiebreak=[PID], name=f"parent{suffix}",
                                        among=seen), *done)
        done = [members]
    if with_hours:
        # Both sides have one row per member, so no key is hot, and check and join share one exchange.
        hours = settled(labour_hours(tables["plots"], HH, MEMBER, plot="gardenid"))
        members = settled(merge(members, hours, [HH, MEMBER], validate=validate, one_to_one=True, split_hot=False,
                                name="plot_hours"), people, hours, *done)
    return _member_values(merge(members, households, HH, validate=False, name="households"))


def model_rows(members: DataFrame, columns: Sequence[str] = FINAL) -> DataFrame:
    """Children with a known target and community, group recodes, and the modelling columns."""
    children = members.filter(F.col("dropout").isNotNull() & F.col("com_cc02").isNotNull())
    return children.withColumns({
        "road_type": recodes.road_type("com_cd01"), "drink_water_type": recodes.drink_water_type("hh_f36"),
        "freq_marriage_type2": recodes.marriage_type("freq_marriage"),
        "father_educ_type2": recodes.education_type("father_educ"),
        "mother_educ_type2": recodes.education_type("mother_educ"), "hh_t08_type2": recodes.income_type("hh_t08"),
    }).select(*columns)


def child_sample(tables: Mapping[str, DataFrame], *, with_assets: bool = True, compat: bool = False,
                 validate: bool = True) -> DataFrame:
    """The modelling table, one row per child.

    Building the frame already runs jobs: members, household sizes, assets and communities are written to the
    shared folder, and the wealth index is fitted. ``session.written_tables`` removes what was written.
    """
    members = member_table(tables, with_assets=with_assets, with_shocks=False, with_mothers=False, with_hours=False,
                           compat=compat, validate=validate,
                           columns=[*FINAL, *MEMBER_IN, *HOUSEHOLD_IN, *COMMUNITY_IN])
    return model_rows(members, [c for c in FINAL if with_assets or not c.startswith("asset_q")])


def write_child_sample(spark: SparkSession, folder: str, out: str) -> None:
    """Read the survey's tables; write the modelling table with captions, and the texts of its codes.

    The texts go to ``<out>_labels``, as ``load_labelled`` reads them. Tables written on the way are removed.
    """
    with written_tables(spark):
        write_table(with_captions(child_sample(load_survey(spark, folder)), CAPTIONS), out)
    write_table(dictionary_rows(spark, {c: t for c, t in recodes.VALUE_LABELS.items() if c in FINAL}), f"{out}_labels")


def write_member_table(spark: SparkSession, folder: str, out: str, **parts) -> None:
    """Read the survey's tables; write the member table with captions. ``parts`` are the switches of ``member_table``."""
    with written_tables(spark):
        members = member_table(load_survey(spark, folder), **parts)
        write_table(with_captions(members, {c: t for c, t in MEMBER_CAPTIONS.items() if c in members.columns}), out)
