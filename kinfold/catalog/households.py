"""Household composition, spending, income, and values shared by a household's members."""

from __future__ import annotations

from pyspark.sql import functions as F

from kinfold.catalog.base import (MEMBERS_SQL, PRICES_SQL, SCALES_SQL, StandIn, members, prices, query,
                                  rounded_doubles)
from kinfold.functions import household as hf
from kinfold.functions.dates import interview_or_first_visit, month_key, month_number, month_text, visit_date
from kinfold.functions.recode import equals_any
from kinfold.operators.groups import attach, oldest, only_where
from kinfold.operators.merge import merge, parent_lookup
from kinfold.plans.composition import household_composition
from kinfold.plans.family import (FEMALE, MALE, beneficiary_list, head_value, most_severe, oldest_adult, oldest_flag)
from kinfold.plans.income import assistance, assistance_per_adult, other_income
from kinfold.plans.spending import combined_spending, food_spending, recall_spending, total_spending
from kinfold.sources.tables import read_driver_table

# The eleven item categories as ranges over the 50 part sizes.
CATEGORIES = [
    ("cereals", 1, 5), ("roots", 6, 9), ("nuts", 10, 14), ("veggie", 15, 18), ("meat", 19, 23), ("fruit", 24, 27),
    ("cooked", 28, 31), ("milk", 32, 35), ("sugar", 36, 39), ("beverage", 40, 43), ("spice", 44, 48),
]
UNIT_SQL = {"aes1": "aes1", "aes2": "aes2", "pc": "total_hh_member"}

# Questionnaire parts with their recall period, and each as a factor per month.
PERIODS = {"i1": "week", "i2": "month", "j": "quarter", "k": "year"}
MONTHLY_SQL = {"i1": "* 4", "i2": "* 1", "j": "/ 3", "k": "/ 12"}

# Lines as survey item rows: the part they belong to, and amounts with gaps.
ITEMS = StandIn("lineitem", (
    "l_orderkey", "l_partkey",
    "CASE WHEN l_linenumber <= 2 THEN 'i1' WHEN l_linenumber = 3 THEN 'i2'"
    " WHEN l_linenumber <= 5 THEN 'j' ELSE 'k' END AS part_tag",
    "CASE WHEN l_linenumber = 3 THEN NULL ELSE l_extendedprice END AS amount",
    "CASE WHEN l_returnflag = 'R' THEN NULL ELSE sqrt(l_extendedprice) END AS transfer_a",
    "CASE WHEN l_linestatus = 'F' THEN NULL ELSE sqrt(l_quantity) END AS transfer_b",
    "CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_quantity * 3 END AS transfer_c",
))
ITEMS_SQL = f"""SELECT o_custkey AS hh, i.* FROM {ITEMS.sql} i JOIN orders ON i.l_orderkey = o_orderkey"""


def scales(spark, sf):
    sizes = household_composition(members(spark, sf), "hh", "age", last=F.max(month_number("month")))
    return sizes.withColumn("month", month_text("last")).drop("last")


def items(spark, sf):
    orders = read_driver_table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("hh"))
    lines = ITEMS.frame(spark, sf)
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey)


def food_items(spark, sf):
    parts = read_driver_table(spark, sf, "part").select("p_partkey", F.col("p_size").alias("item"))
    lines = items(spark, sf)
    return lines.join(parts, lines.l_partkey == parts.p_partkey).select("hh", "item", "amount", "part_tag")


def _deflated(amount, scale, name):
    return f"({amount} * (90.3225806451613e0 / nullif(cpi, 0))) / nullif({scale}, 0) AS {name}"


FOOD_COLUMNS = ([f"{p}_total_exp_food" for p in UNIT_SQL]
                + [f"{p}_exp_{n}2" for n, _, _ in CATEGORIES for p in UNIT_SQL])
RECALL_COLUMNS = ([f"nonfood_exp_monthly_{t}" for t in PERIODS]
                  + [f"{p}_total_exp_non_food_{t}" for t in PERIODS for p in UNIT_SQL])
FOOD_SQL = f"""
    SELECT hh, {", ".join(_deflated("total_exp_food", s, f"{p}_total_exp_food") for p, s in UNIT_SQL.items())},
           {", ".join(_deflated(f"exp_{n}", s, f"{p}_exp_{n}2") for n, _, _ in CATEGORIES
                      for p, s in UNIT_SQL.items())}
    FROM (SELECT hh, coalesce(sum(amount), 0) AS total_exp_food,
                 {", ".join(f"sum(CASE WHEN p_size BETWEEN {lo} AND {hi} THEN coalesce(amount, 0) END) AS exp_{n}"
                            for n, lo, hi in CATEGORIES)}
          FROM ({ITEMS_SQL}) i JOIN part ON l_partkey = p_partkey GROUP BY hh) t
    LEFT JOIN ({SCALES_SQL}) s USING (hh) LEFT JOIN ({PRICES_SQL}) p USING (month)"""
RECALL_SQL = f"""
    SELECT hh, {", ".join(f"exp_{t} AS nonfood_exp_monthly_{t}" for t in PERIODS)},
           {", ".join(_deflated(f"exp_{t}", s, f"{p}_total_exp_non_food_{t}") for t in PERIODS
                      for p, s in UNIT_SQL.items())}
    FROM (SELECT hh, {", ".join(f"sum(CASE WHEN part_tag = '{t}' THEN coalesce(amount, 0) END) {f} AS exp_{t}"
                                for t, f in MONTHLY_SQL.items())}
          FROM ({ITEMS_SQL}) i GROUP BY hh) t
    LEFT JOIN ({SCALES_SQL}) s USING (hh) LEFT JOIN ({PRICES_SQL}) p USING (month)"""


@query("household_food_spend", sql=f"""
    SELECT hh, {", ".join(f"round({c}, 4) AS {c}" for c in FOOD_COLUMNS)} FROM ({FOOD_SQL}) f""")
def household_food_spend(spark, sf):
    spent = food_spending(food_items(spark, sf), scales(spark, sf), prices(spark, sf), household="hh", item="item",
                          amount="amount", month="month", categories=CATEGORIES)
    return rounded_doubles(spent)


@query("recall_period_spend", sql=f"""
    SELECT hh, {", ".join(f"round({c}, 4) AS {c}" for c in RECALL_COLUMNS)} FROM ({RECALL_SQL}) r""")
def recall_period_spend(spark, sf):
    spent = recall_spending(items(spark, sf), scales(spark, sf), prices(spark, sf), household="hh", amount="amount",
                            tag="part_tag", periods=PERIODS)
    return rounded_doubles(spent)


@query("total_spending", sql=f"""
    SELECT hh, round({" + ".join(f"coalesce(aes1_total_exp_non_food_{t}, 0)" for t in PERIODS)}, 4)
               AS total_aes1_nonfood_exp_inf,
           round(coalesce(aes1_total_exp_food, 0) + {" + ".join(f"coalesce(aes1_total_exp_non_food_{t}, 0)"
                                                                for t in PERIODS)}, 4) AS total_aes1_exp_inf
    FROM ({FOOD_SQL}) f LEFT JOIN ({RECALL_SQL}) r USING (hh)""")
def spending_in_all(spark, sf):
    parts = [f"aes1_total_exp_non_food_{t}" for t in PERIODS]
    both = combined_spending(food_items(spark, sf), scales(spark, sf), prices(spark, sf), household="hh", item="item", amount="amount",
                             tag="part_tag", periods=PERIODS, categories=CATEGORIES, only=["aes1_total_exp_food", *parts])
    totals = total_spending("aes1_total_exp_food", parts)
    return rounded_doubles(both.select("hh", *[c.alias(n) for n, c in totals.items()]))


@query("household_composition", sql=f"""
    SELECT hh, total_hh_member, total_adult, total0_17, num_elderly, gr_total0_17,
           round(aes1, 4) AS aes1, round(aes2, 4) AS aes2 FROM ({SCALES_SQL}) s""")
def composition(spark, sf):
    return rounded_doubles(household_composition(members(spark, sf), "hh", "age"))


@query("other_income", sql=f"""
    SELECT hh, round((coalesce(sum(coalesce(transfer_a, 0) + coalesce(transfer_b, 0) + coalesce(transfer_c, 0)), 0)
                      + coalesce(sum(amount), 0)) / 12, 4) AS other_income_monthly
    FROM ({ITEMS_SQL}) i GROUP BY hh""")
def income_from_other_sources(spark, sf):
    return rounded_doubles(other_income(items(spark, sf), "hh", ["transfer_a", "transfer_b", "transfer_c"], "amount"))


@query("assistance_per_adult", sql=f"""
    SELECT hh, round(cash, 4) AS aes1_monthly_cash_assist, round(kind, 4) AS aes1_monthly_inkind_assist,
           round(coalesce(cash, 0) + coalesce(kind, 0), 4) AS total_assist_invalue
    FROM (SELECT hh, coalesce(a, 0) / 12 / nullif(aes1, 0) AS cash, coalesce(b, 0) / 12 / nullif(aes1, 0) AS kind
          FROM (SELECT hh, sum(transfer_a) AS a, sum(transfer_b) AS b FROM ({ITEMS_SQL}) i GROUP BY hh) t
          LEFT JOIN ({SCALES_SQL}) s USING (hh)) x""")
def assistance_for_each_adult(spark, sf):
    received = assistance(items(spark, sf), "hh", "transfer_a", "transfer_b")
    sized = merge(received, scales(spark, sf), "hh", split_hot=False)
    return rounded_doubles(sized.select("hh", *[c.alias(n) for n, c in assistance_per_adult().items()]))


@query("group_broadcast", sql=f"""
    SELECT pid, hh, count(*) OVER w AS total_hh_member,
           CAST(coalesce(sum(CASE WHEN age >= 18 THEN 1 WHEN age IS NOT NULL THEN 0 END) OVER w, 0) AS BIGINT)
               AS total_adult,
           round(coalesce(sum(income) OVER w, 0), 2) AS total_income, max(age) OVER w AS max_age,
           min(age) OVER w AS min_age
    FROM {MEMBERS_SQL} m WINDOW w AS (PARTITION BY hh)""")
def group_broadcast(spark, sf):
    from kinfold.functions.missing import group_total

    people = members(spark, sf).select("pid", "hh", "age", "income")
    out = attach(people, ["hh"], {
        "total_hh_member": F.count("*"), "total_adult": group_total(hf.adult("age")),
        "total_income": group_total("income"), "max_age": F.max("age"), "min_age": F.min("age"),
    })
    return rounded_doubles(out.drop("age", "income"), 2)


@query("conditional_broadcast", sql=f"""
    SELECT pid, hh, max(CASE WHEN relation = 1 THEN gender END) OVER w AS hh_head_gender,
           max(CASE WHEN relation = 1 THEN job END) OVER w AS hh_head_job,
           CASE WHEN gender = 1 THEN max(CASE WHEN gender = 1 THEN age END) OVER w END AS x_age_female,
           CASE WHEN gender = 0 THEN max(CASE WHEN gender = 0 THEN age END) OVER w END AS x_age_male
    FROM {MEMBERS_SQL} m WINDOW w AS (PARTITION BY hh)""")
def conditional_broadcast(spark, sf):
    from kinfold.operators.groups import value_where

    people = members(spark, sf).select("pid", "hh", "relation", "gender", "job", "age")
    female, male = F.col("gender") == FEMALE, F.col("gender") == MALE
    out = attach(people, ["hh"], {
        "hh_head_gender": head_value("relation", "gender"), "hh_head_job": head_value("relation", "job"),
        "f": value_where(female, "age"), "m": value_where(male, "age"),
    })
    return out.select("pid", "hh", "hh_head_gender", "hh_head_job",
                      only_where(female, F.col("f")).alias("x_age_female"),
                      only_where(male, F.col("m")).alias("x_age_male"))


OLDEST_SQL = f"""
    SELECT *, min(CASE WHEN female = 1 THEN educ END) OVER (PARTITION BY hh) AS oldest_female_edu,
           min(CASE WHEN male = 1 THEN educ END) OVER (PARTITION BY hh) AS oldest_male_edu,
           min(CASE WHEN male = 1 THEN job END) OVER (PARTITION BY hh) AS oldest_male_job
    FROM (SELECT *, CASE WHEN gender = 1 AND age > 17 AND place = 1 THEN 1 END AS female,
                 CASE WHEN gender = 0 AND age > 17 AND place = 1 THEN 1 END AS male
          FROM (SELECT *, row_number() OVER (PARTITION BY hh, gender ORDER BY age DESC NULLS LAST, pid) AS place
                FROM {MEMBERS_SQL} m) a) b"""


def with_oldest(people):
    return attach(people, ["hh"], {
        "of": oldest_adult("gender", FEMALE, "age", "pid", ["educ"]),
        "om": oldest_adult("gender", MALE, "age", "pid", ["educ", "job"]),
    })


@query("oldest_member_flag", sql=f"""
    SELECT pid, hh, female AS oldest_female_hh, male AS oldest_male_hh, oldest_female_edu, oldest_male_edu,
           oldest_male_job FROM ({OLDEST_SQL}) o""")
def oldest_member_flag(spark, sf):
    people = with_oldest(members(spark, sf).select("pid", "hh", "gender", "age", "educ", "job"))
    return people.select(
        "pid", "hh", oldest_flag("of", "pid").alias("oldest_female_hh"), oldest_flag("om", "pid").alias("oldest_male_hh"),
        F.col("of.educ").alias("oldest_female_edu"), F.col("om.educ").alias("oldest_male_edu"),
        F.col("om.job").alias("oldest_male_job"))


# Ids spread over all longs, and ages with fractions that whole years would hide.
SPREAD = StandIn("orders", (
    "o_custkey AS hh", "(o_orderkey * 2654435761 % 1000003 - 500000) * 18446744073709 + o_orderkey AS member",
    "CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE 18 + floor(o_totalprice) % 3 + (o_orderkey % 4) / 4e0 END AS age",
    "o_orderkey AS pid",
))
# The same id in Spark, where the number may leave the longs: what lies beyond one end goes on at the other, as it does in 64 bits.
_SPREAD_ID = ("CAST(pmod(CAST(o_orderkey % 1000003 * 2654435761 % 1000003 - 500000 AS DECIMAL(38, 0)) * 18446744073709 + o_orderkey"
              " + 9223372036854775808, 18446744073709551616) - 9223372036854775808 AS BIGINT) AS member")


def spread(orders):
    """The rows of ``SPREAD`` for order keys of any size."""
    return orders.selectExpr(*[_SPREAD_ID if c.endswith(" AS member") else c for c in SPREAD.columns])


@query("oldest_of_any_id", sql=f"""
    SELECT hh, min(member) FILTER (place = 1) AS oldest, min(age) FILTER (place = 1) AS oldest_age,
           min(pid) FILTER (place = 1) AS oldest_pid
    FROM (SELECT *, row_number() OVER (PARTITION BY hh ORDER BY age DESC NULLS LAST, member) AS place
          FROM {SPREAD.sql} s WHERE age IS NOT NULL) o GROUP BY hh""")
def oldest_of_any_id(spark, sf):
    people = spread(read_driver_table(spark, sf, "orders")).filter("age IS NOT NULL")
    return people.groupBy("hh").agg(oldest("age", "member", F.lit(True), "age", "pid").alias("o")).select(
        "hh", F.col("o.id").alias("oldest"), F.col("o.age").alias("oldest_age"), F.col("o.pid").alias("oldest_pid"))


FATHERS_SQL = f"""
    SELECT hh, id_code AS father_id, job AS job_father, educ AS educ_father
    FROM {MEMBERS_SQL} m QUALIFY row_number() OVER (PARTITION BY hh, id_code ORDER BY pid) = 1"""


@query("parent_fallback", sql=f"""
    SELECT o.pid, o.hh,
           CASE WHEN o.father_id IS NULL OR o.father_id IN (97, 98, 99) THEN coalesce(oldest_male_edu, o.educ)
                ELSE o.educ END AS father_educ,
           coalesce(CASE WHEN o.father_id IS NULL OR o.father_id IN (97, 98, 99) THEN head_job ELSE job_father END, 6)
               AS father_job
    FROM (SELECT *, max(CASE WHEN relation = 1 THEN job END) OVER (PARTITION BY hh) AS head_job
          FROM ({OLDEST_SQL}) x) o
    LEFT JOIN ({FATHERS_SQL}) f ON o.hh = f.hh AND o.father_id = f.father_id""")
def parent_fallback(spark, sf):
    people = members(spark, sf).select("pid", "hh", "id_code", "father_id", "relation", "gender", "age", "educ", "job")
    known = parent_lookup(people, "hh", "id_code", "father_id", ["job", "educ"], "_father", tiebreak=["pid"])
    people = attach(known, ["hh"], {
        "om": oldest_adult("gender", MALE, "age", "pid", ["educ"]), "hh_head_job": head_value("relation", "job"),
    }, source=people)
    return people.select(
        "pid", "hh", hf.parent_education("father_id", "educ", F.col("om.educ")).alias("father_educ"),
        hf.parent_job("father_id", "job_father", "hh_head_job").alias("father_job"))


@query("visit_month_key", sql=f"""
    SELECT pid, age, substr(CASE WHEN interview = '##N/A##' THEN visit1 ELSE interview END, 1, 7) AS month_interview,
           substr(CASE WHEN d = '##N/A##' THEN visit1 ELSE d END, 1, 7) AS month_visit
    FROM (SELECT *, CASE WHEN visit_group = 1 AND visit1 <> '' THEN visit1 ELSE visit2 END AS d
          FROM {MEMBERS_SQL} m) x""")
def visit_month_key(spark, sf):
    return members(spark, sf).select(
        "pid", "age", month_key(interview_or_first_visit("interview", "visit1")).alias("month_interview"),
        month_key(visit_date("visit_group", "visit1", "visit2")).alias("month_visit"))


# One programme row per household with up to five listed members.
PROGRAMME = StandIn("customer", (
    "c_custkey AS hh",
    "CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE CAST(c_custkey % 16 + 1 AS INT) END AS line_a",
    "CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE CAST(c_custkey * 3 % 16 + 1 AS INT) END AS line_b",
    "CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN NULL ELSE CAST(c_custkey * 5 % 16 + 1 AS INT) END AS line_c",
    "CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN CAST(c_custkey % 16 + 1 AS INT) END AS line_d",
    "CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN CAST(c_custkey * 11 % 16 + 1 AS INT) END AS line_e",
))


@query("membership_any", sql=f"""
    SELECT m.pid, m.hh, m.id_code,
           CASE WHEN m.id_code IN (line_a, line_b, line_c, line_d, line_e) THEN 1 END AS school_feed,
           CASE WHEN m.id_code IN (line_a, line_b, line_c, line_d, line_e) THEN 1 ELSE 0 END AS school_feed_beneficiary
    FROM {MEMBERS_SQL} m LEFT JOIN {PROGRAMME.sql} p ON m.hh = p.hh""")
def membership_any(spark, sf):
    places = ["a", "b", "c", "d", "e"]
    listed = beneficiary_list(PROGRAMME.frame(spark, sf), "hh", "line_", places, "listed_")
    people = merge(members(spark, sf).select("pid", "hh", "id_code"), listed, "hh")
    fed = equals_any("id_code", [f"listed_{p}" for p in places])
    return people.select("pid", "hh", "id_code", fed.alias("school_feed"),
                         F.coalesce(fed, F.lit(0)).alias("school_feed_beneficiary"))


@query("beneficiary_list", sql=f"""
    WITH long AS (
        UNPIVOT {PROGRAMME.sql} ON line_a, line_b, line_c, line_d, line_e INTO NAME place VALUE line),
    every AS (SELECT p.hh, s.place, l.line FROM {PROGRAMME.sql} p
              CROSS JOIN (VALUES ('line_a'), ('line_b'), ('line_c'), ('line_d'), ('line_e')) s(place)
              LEFT JOIN long l ON l.hh = p.hh AND l.place = s.place
              WHERE coalesce(line_a, line_b, line_c, line_d, line_e) IS NOT NULL),
    once AS (SELECT * FROM every QUALIFY row_number() OVER (PARTITION BY hh, line ORDER BY place) = 1)
    SELECT hh, {", ".join(f"max(CASE WHEN place = 'line_{p}' THEN line END) AS listed_{p}" for p in "abcde")}
    FROM once GROUP BY hh""")
def beneficiaries(spark, sf):
    return beneficiary_list(PROGRAMME.frame(spark, sf), "hh", "line_", ["a", "b", "c", "d", "e"], "listed_")


SHOCKS = StandIn("events", (
    "user_id AS hh", "event_id", "ts", "event_type AS shock",
    "CASE WHEN event_type IN ('error', 'signup') AND value > 5 THEN 1 WHEN value > 2 THEN 2 END AS severity",
))


@query("severe_first", sql=f"""
    SELECT hh, shock AS shock_most_severe FROM {SHOCKS.sql} s WHERE severity = 1
    QUALIFY row_number() OVER (PARTITION BY hh ORDER BY ts, event_id) = 1""")
def severe_first(spark, sf):
    return most_severe(SHOCKS.frame(spark, sf), "hh", "shock", "severity", ["ts", "event_id"], "shock_most_severe")
