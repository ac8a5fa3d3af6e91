"""The whole survey job on survey-shaped views of the given tables.

Households are customers, members their orders, item rows their order lines,
communities nations. The views only fill the survey's columns with codes derived
from keys, with gaps, unmatched rows and repeated keys; both engines read the same
text. The modelling table is then computed by Spark and, separately, by plain SQL.
"""

from __future__ import annotations

from kinfold.catalog.base import PRICES_SQL, query, rounded_doubles
from kinfold.catalog.scores import QUINTILE_CTES, component_ctes
from kinfold.operators.merge import merge_report
from kinfold.plans.child_sample import (
    ASSET_CODES, FATHER_FACTS, FINAL, MOTHER_FACTS, OLDEST_FACTS, OLDEST_FEMALE_FACTS, child_sample, member_table,
)
from kinfold.plans.community import DISTANCES, FREQUENT, SHOCK_CODES
from kinfold.session import freed_shuffles, written_tables
from kinfold.sources.tables import read_driver_table


def _code(name, key, factor, levels, start=1, gap=0):
    """A coded column from a key; ``gap`` leaves one row in so many without an answer."""
    value = f"CAST(({key} * {factor} + {levels}) % {levels} + {start} AS INT)"
    return f"CASE WHEN ({key} + {factor}) % {gap} = 0 THEN NULL ELSE {value} END AS {name}" if gap else f"{value} AS {name}"


def _codes(names, key, levels, gap=0):
    return ", ".join(_code(n, key, i + 3, levels, gap=gap + i if gap else 0) for i, n in enumerate(names))


_O, _C, _N = "o_orderkey", "c_custkey", "n_nationkey"
_DAY = "SUBSTR(CAST(o_orderdate AS STRING), 1, 10)"
_ITEM_ROWS = "{lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey"
# A household's least and greatest member stand for parents; every order is a member.
_FAMILIES = """(SELECT o_custkey, min(o_orderkey) AS least_key, max(o_orderkey) AS greatest_key
                FROM {orders} GROUP BY o_custkey) f"""


def _item_rows(amount, where, gap):
    """Item rows of one questionnaire part; each part has other households without a visit group."""
    return f"""SELECT o_custkey AS y3_hhid,
                      CASE WHEN o_custkey % {gap} = 0 THEN NULL ELSE CAST(o_custkey % 2 + 1 AS INT) END AS qx_type,
                      CASE WHEN l_linenumber = 5 THEN NULL ELSE l_extendedprice END AS {amount}
               FROM {_ITEM_ROWS} WHERE {where}"""


VIEWS = {
    "roster": f"""
        SELECT o_custkey AS y3_hhid, o_orderkey AS PID, o_orderkey AS id_code,
               {_code("hh_b03", _O, 5, 2, gap=31)},
               CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 3 END AS hh_b04,
               CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) % 70 AS INT) END AS hh_b05a,
               CASE WHEN o_orderpriority = '5-LOW' THEN NULL
                    ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) % 80 AS INT) END AS hh_b06_3a,
               {_code("hh_b16a", _O, 3, 2, gap=9)}, {_code("hh_b19a", _O, 7, 2, gap=8)},
               CASE WHEN o_orderpriority = '1-URGENT' THEN NULL WHEN o_orderkey % 10 = 3 THEN 98
                    WHEN o_orderkey % 7 = 1 THEN o_orderkey + 1 ELSE least_key END AS hh_b16b,
               CASE WHEN o_orderpriority = '2-HIGH' THEN NULL WHEN o_orderkey % 10 = 7 THEN 97
                    WHEN o_orderkey % 7 = 2 THEN o_orderkey + 1 ELSE greatest_key END AS hh_b19b,
               {_codes(["hh_b18", "hh_b21", "hh_b23", "hh_b24"], _O, 7, gap=11)}
        FROM {{orders}} JOIN {_FAMILIES} USING (o_custkey)""",
    "household_id": f"""
        SELECT c_custkey AS y3_hhid, c_nationkey AS ea_id, CAST(c_custkey % 5 + 1 AS DOUBLE) / 10e0 AS panelweight_2016,
               CASE WHEN c_custkey % 9 = 0 THEN '' WHEN c_custkey % 9 = 1 THEN '1996-05-10'
                    ELSE concat('199', CAST(c_custkey % 4 + 5 AS STRING), '-0', CAST(c_custkey % 9 AS STRING), '-11')
                    END AS interviewdate_v1,
               CASE WHEN c_custkey % 6 = 0 THEN '##N/A##' WHEN c_custkey % 6 = 1 THEN ''
                    ELSE concat('199', CAST(c_custkey % 5 + 5 AS STRING), '-0', CAST(c_custkey % 6 AS STRING), '-21')
                    END AS interviewdate_v2
        FROM {{customer}}""",
    "education": f"""
        SELECT o_orderkey AS PID, {_codes(["hh_c05a", "hh_c05b", "hh_c06"], _O, 2, gap=13)},
               {_codes(["hh_c08", "hh_c09", "hh_c17", "hh_c22j"], _O, 7, gap=15)},
               CASE WHEN o_orderpriority = '3-MEDIUM' THEN 2 ELSE 1 END AS hh_c11, {_code("hh_c12", _O, 3, 10)},
               CASE WHEN o_orderkey % 4 = 1 THEN NULL ELSE CAST(2013 + o_orderkey % 5 AS INT) END AS hh_c15,
               {_code("hh_c19a", _O, 7, 40, gap=10)}, {_code("hh_c19b", _O, 5, 3, gap=12)}
        FROM {{orders}} WHERE o_totalprice > 3000""",
    "health": f"SELECT o_orderkey AS PID, {_codes(['hh_d13', 'hh_d33'], _O, 3, gap=7)} FROM {{orders}}",
    "labour": f"""
        SELECT o_orderkey AS PID,
               {_codes(["hh_e05", "hh_e06", "hh_e06_1a", "hh_e06_1b", "hh_e06_1c", "hh_e06_2", "hh_e06_3", "hh_e06_4",
                        "hh_e06_5", "hh_e06_6", "hh_e06_8a"], _O, 6, gap=9)}
        FROM {{orders}} WHERE o_totalprice < 490000""",
    "follow_up": f"""
        SELECT o_orderkey AS PID, o_custkey + 1000 AS y4_hhid, {_codes(["hh_c06", "hh_c08", "hh_c09"], _O, 5)},
               CASE WHEN o_orderstatus = 'F' THEN 1 WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE 2 END AS hh_c11,
               {_code("hh_c12", _O, 5, 12)}, {_code("hh_c13", _O, 7, 2, gap=9)}, {_code("hh_c15", _O, 3, 9, gap=6)}
        FROM {{orders}} WHERE o_totalprice > 60000""",
    "housing": f"""
        SELECT c_custkey AS y3_hhid, {_codes(["hh_f01", "hh_f08", "hh_f09", "hh_f11", "hh_f12", "hh_f19", "hh_f41",
                                              "hh_f44", "hh_f48"], _C, 6, gap=17)},
               {_code("hh_f34", _C, 3, 4, start=0, gap=19)}, {_code("hh_f36", _C, 7, 14, gap=23)}
        FROM {{customer}}""",
    "food_items": f"""
        SELECT o_custkey AS y3_hhid, CAST(101 + l_partkey % 816 AS INT) AS hh_g02,
               CASE WHEN l_linenumber = 4 THEN NULL ELSE l_extendedprice END AS hh_g05,
               CASE WHEN o_custkey % 8 = 0 THEN '##N/A##'
                    ELSE concat('199', CAST(o_custkey % 5 + 5 AS STRING), '-0', CAST(o_custkey % 7 + 1 AS STRING), '-15')
                    END AS interviewDate
        FROM {_ITEM_ROWS} WHERE l_returnflag <> 'R'""",
    "nonfood_week": _item_rows("hh_i03", "l_returnflag = 'R' AND l_linestatus = 'F'", 7),
    "nonfood_month": _item_rows("hh_i06", "l_returnflag = 'R' AND l_linestatus = 'O'", 5),
    "nonfood_quarter": _item_rows("hh_j03", "l_returnflag = 'A' AND l_quantity > 25", 3),
    "nonfood_year": _item_rows("hh_k03", "l_returnflag = 'N' AND l_quantity > 25", 11),
    "food_days": f"""
        SELECT c_custkey AS y3_hhid, {", ".join(_code(f"hh_g08{x}", _C, i + 2, 8, start=0, gap=29 + i)
                                                for i, x in enumerate("abcdefghi"))}
        FROM {{customer}}""",
    "food_security": f"""
        SELECT c_custkey AS y3_hhid, {", ".join(_code(f"hh_h02{x}", _C, i + 2, 3, start=0, gap=23 + i)
                                                for i, x in enumerate("abcde"))}
        FROM {{customer}}""",
    "assets": f"""
        SELECT y3_hhid, hh_l02,
               CASE WHEN y3_hhid % 41 = 0 AND hh_l02 = 505 THEN NULL
                    WHEN (y3_hhid * (hh_l02 % 37) + hh_l02) % 11 < wealth THEN 1 ELSE 2 END AS hh_l01,
               CASE WHEN y3_hhid % 3 = 0 THEN NULL ELSE CAST(hh_l02 % 100 AS DOUBLE) END AS hh_l05
        FROM (SELECT c_custkey AS y3_hhid, CAST(floor((c_acctbal + 1000) / 1100) AS BIGINT) AS wealth,
                     {{explode}}({{array}}({", ".join(map(str, ASSET_CODES))})) AS hh_l02 FROM {{customer}}) a""",
    "enterprise": f"""
        SELECT c_custkey AS y3_hhid, {_codes([f"hh_n0{i}" for i in range(1, 9)], _C, 2, gap=21)} FROM {{customer}}""",
    "other_income": f"""
        SELECT o_custkey AS y3_hhid, CASE WHEN l_returnflag = 'A' THEN NULL ELSE l_extendedprice END AS hh_p02,
               CASE WHEN l_linestatus = 'F' THEN NULL ELSE l_quantity END AS hh_p03a, l_quantity * 2 AS hh_p03b,
               CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_quantity * 3 END AS hh_p03c
        FROM {_ITEM_ROWS}""",
    "safety_nets": f"""
        SELECT c_custkey AS y3_hhid, hh_r0a, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE sqrt(abs(c_acctbal)) END AS hh_r02a,
               CASE WHEN hh_r0a = 105 THEN sqrt(c_acctbal + 1000) END AS hh_r02b,
               {", ".join(f"CASE WHEN (c_custkey + {i}) % {3 + i % 2} = 0 THEN NULL ELSE {k} END AS hh_r04{x}" for i, (x, k) in enumerate(
                   zip("abcde", ["least_key", "greatest_key", "least_key", "greatest_key + 1", "least_key + 2"])))}
        FROM (SELECT *, {{explode}}({{array}}(101, 105)) AS hh_r0a FROM {{customer}}) s
        LEFT JOIN {_FAMILIES} ON c_custkey = o_custkey""",
    "wellbeing": f"""
        SELECT c_custkey AS y3_hhid, {_codes(["hh_t02", "hh_t03", "hh_t04"], _C, 3, gap=17)},
               {_codes(["hh_t05", "hh_t06", "hh_t07"], _C, 6, gap=14)}, {_code("hh_t08", _C, 9, 5, gap=16)}
        FROM {{customer}}""",
    "shocks": """
        SELECT user_id AS y3_hhid, CAST(event_id % 23 + 101 AS INT) AS hh_u0a,
               CASE WHEN value > 5 THEN CAST(event_id % 3 + 1 AS INT) END AS hh_u02 FROM {events}""",
    "community_basic": f"""
        SELECT n_nationkey AS ea_id, CASE WHEN n_nationkey = 7 THEN NULL ELSE n_nationkey * 13 + 5 END AS com_cc02,
               {_codes(["com_cc08", "com_cc09", "com_cc14"], _N, 4)},
               {", ".join(_codes([f"com_cc0{q}{x}" for x in "abcdef"], _N, 5, gap=6 + q) for q in (4, 5, 7))}
        FROM {{nation}}""",
    "community_services": f"""
        SELECT n_nationkey AS ea_id, {_code("com_cd01", _N, 3, 5)},
               {_codes(["com_cd25", "com_cd26", "com_cd28", "com_cd29", "com_cd30", "com_cd32", "com_cd35", "com_cd55"], _N, 9)},
               {", ".join(sorted({_code(d, _N, i + 2, 7, start=0, gap=9) for i, (d, _, _, _) in enumerate(DISTANCES.values())}
                                 | {_code(u, _N, i + 3, 4, start=0, gap=13) for i, (_, u, _, _) in enumerate(DISTANCES.values())}
                                 | {_code(p, _N, i + 1, 2, gap=11) for i, (_, _, p, _) in enumerate(DISTANCES.values()) if p}))}
        FROM {{nation}}""",
    "community_economy": f"""
        SELECT n_nationkey AS ea_id, {_codes(["com_ce01a", "com_ce02", "com_ce06", "com_ce08_1", "com_ce09"], _N, 6)}
        FROM {{nation}}""",
    "community_changes": f"""
        SELECT s_nationkey AS ea_id, CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE CAST(s_suppkey % 21 AS INT) END AS com_cg35c
        FROM {{supplier}}""",
    "plots": f"""
        SELECT o_custkey AS y3_hhid, CAST(l_linenumber AS INT) AS gardenid, {", ".join(
            f"CASE WHEN (l_partkey + {n}) % 5 = 0 THEN NULL ELSE {['least_key', 'o_orderkey', 'greatest_key'][n % 3]} END AS {t}a{n}, "
            f"CAST(l_quantity AS INT) % 7 AS {t}b{n}, "
            f"CAST(l_partkey % 5 AS INT) AS {t}c{n}, CASE WHEN l_returnflag = 'A' THEN NULL ELSE CAST(l_suppkey % 4 AS INT) END AS {t}d{n}"
            for t in ("ag_d42", "ag_d43", "ag_d44") for n in range(1, 14))}
        FROM {_ITEM_ROWS} JOIN {_FAMILIES} USING (o_custkey)""",
    "prices": PRICES_SQL.replace("SELECT month, avg", "SELECT month AS int_date_hhmod, avg").replace("lineitem", "{lineitem}"),
}
_NAMES = ["orders", "lineitem", "customer", "nation", "supplier", "events"]


def _in_sql(name):
    return VIEWS[name].format(**{n: n for n in _NAMES}, explode="unnest", array="list_value")


def survey_tables(spark, sf):
    given = {n: read_driver_table(spark, sf, n) for n in _NAMES}
    out = {}
    for name, text in VIEWS.items():
        used = {n: f for n, f in given.items() if "{" + n + "}" in text}
        out[name] = spark.sql(text.replace("{explode}", "explode").replace("{array}", "array"), **used)
    return out


def _metres_sql(name):
    distance, unit, present, rules = DISTANCES[name]
    cases = [f"WHEN {unit} = {u} THEN {distance} * {f}" for u, f in ((1, "1"), (2, "1000"), (3, "1609.344e0"))
             if u in rules.get("units", (1, 2, 3))]
    if rules.get("zero_unit"):
        cases.append(f"WHEN {unit} = 0 THEN 0")
    if present:
        cases.append(f"WHEN {present} = 1 OR {distance} = 0 THEN 0")
    return f"CAST(CASE {' '.join(cases)} END AS DOUBLE) AS {name}"


def _frequent_sql(name):
    (a1, n1), (a2, n2), (a3, n3) = FREQUENT[name]
    top = f"greatest({n1}, {n2}, {n3})"
    return (f"CASE WHEN {n3} IS NOT DISTINCT FROM {top} THEN {a3} WHEN {n2} IS NOT DISTINCT FROM {top} THEN {a2} "
            f"ELSE {a1} END AS {name}")


_ABSENT_F = "(hh_b16b IS NULL OR hh_b16b IN (97, 98, 99))"
_ABSENT_M = "(hh_b19b IS NULL OR hh_b19b IN (97, 98, 99))"
_FOOD_CUT = "SUM(coalesce(hh_g05, 0))"
_RECALL = [("nonfood_week", "hh_i03", "* 4"), ("nonfood_month", "hh_i06", "* 1"), ("nonfood_quarter", "hh_j03", "/ 3"),
           ("nonfood_year", "hh_k03", "/ 12")]
_BASE = "90.3225806451613e0"


def _oldest_sql(sex, name):
    return f"""{name} AS (
        SELECT * FROM both_waves WHERE gender = {sex} AND age > 17
        QUALIFY row_number() OVER (PARTITION BY y3_hhid ORDER BY age DESC, id_code) = 1)"""


CTES = ",\n".join([f"{name} AS ({_in_sql(name)})" for name in VIEWS] + [
    """people AS (
        SELECT r.*, e.* EXCLUDE (PID), h.* EXCLUDE (PID), w.* EXCLUDE (PID), f.hh_c11 AS hh_c11_19, f.hh_c13 AS hh_c13_19,
               f.hh_c15 AS hh_c15_19, f.PID IS NOT NULL AS seen, CAST(hh_b03 - 1 AS INT) AS gender,
               coalesce(hh_b06_3a, hh_b05a) AS age
        FROM roster r LEFT JOIN education e ON r.PID = e.PID LEFT JOIN health h ON r.PID = h.PID
        LEFT JOIN labour w ON r.PID = w.PID LEFT JOIN follow_up f ON r.PID = f.PID)""",
    "both_waves AS (SELECT * FROM people WHERE seen)",
    """sizes AS (
        SELECT y3_hhid, count(*) AS members, count(CASE WHEN age >= 18 THEN 1 END) AS adults,
               count(CASE WHEN age <= 17 THEN 1 END) AS children,
               count(CASE WHEN age > 60 OR age IS NULL THEN 1 END) AS elderly,
               max(CASE WHEN hh_b04 = 1 THEN gender END) AS hh_head_gender,
               max(CASE WHEN hh_b04 = 1 AND seen THEN hh_e06_8a END) AS head_job
        FROM people GROUP BY y3_hhid)""",
    """hh AS (
        SELECT *, CASE WHEN members > 1 THEN 1 + (adults - 1) * 0.5e0 + children * 0.3e0
                       WHEN adults = 1 THEN 1 END AS aes1,
               CASE WHEN members > 1 THEN 1 + (adults - 1) * 0.7e0 + children * 0.5e0
                    WHEN adults = 1 THEN 1 END AS aes2
        FROM sizes LEFT JOIN household_id USING (y3_hhid))""",
    f"""food AS (
        SELECT y3_hhid, total * ({_BASE} / nullif(cpi, 0)) / nullif(aes1, 0) AS spent,
               total * ({_BASE} / nullif(cpi, 0)) / nullif(aes2, 0) AS spent_aes2,
               total * ({_BASE} / nullif(cpi, 0)) / nullif(members, 0) AS spent_pc
        FROM (SELECT y3_hhid, sum(coalesce(hh_g05, 0)) AS total, max(interviewDate) AS day FROM food_items GROUP BY 1) t
        LEFT JOIN hh USING (y3_hhid)
        LEFT JOIN prices ON int_date_hhmod = substr(CASE WHEN day = '##N/A##' THEN interviewdate_v1 ELSE day END, 1, 7))""",
    *[f"""{name}_spent AS (
        SELECT y3_hhid, (total {factor}) * ({_BASE} / nullif(cpi, 0)) / nullif(aes1, 0) AS spent,
               (total {factor}) * ({_BASE} / nullif(cpi, 0)) / nullif(aes2, 0) AS spent_aes2,
               (total {factor}) * ({_BASE} / nullif(cpi, 0)) / nullif(members, 0) AS spent_pc
        FROM (SELECT *, CASE WHEN d = '##N/A##' THEN interviewdate_v1 ELSE d END AS day
              FROM (SELECT *, CASE WHEN q = 1 AND interviewdate_v1 <> '' THEN interviewdate_v1
                                   ELSE interviewdate_v2 END AS d
                    FROM (SELECT y3_hhid, sum(coalesce({amount}, 0)) AS total, max(qx_type) AS q FROM {name} GROUP BY 1) t
                    LEFT JOIN hh USING (y3_hhid)) a) b
        LEFT JOIN prices ON int_date_hhmod = substr(day, 1, 7))""" for name, amount, factor in _RECALL],
    f"""aid AS (
        SELECT y3_hhid, coalesce(sum(hh_r02a), 0) / 12 AS cash, coalesce(sum(hh_r02b), 0) / 12 AS kind
        FROM safety_nets GROUP BY 1)""",
    """worst AS (SELECT y3_hhid, min(hh_u0a) AS hh_u0a_most_severe FROM shocks WHERE hh_u02 = 1 GROUP BY 1)""",
    f"""community AS (
        SELECT n.ea_id, c.* EXCLUDE (ea_id), s.* EXCLUDE (ea_id), e.* EXCLUDE (ea_id)
        FROM (SELECT n_nationkey AS ea_id FROM nation) n
        LEFT JOIN (SELECT *, {", ".join(_frequent_sql(f) for f in FREQUENT)} FROM community_basic) c USING (ea_id)
        LEFT JOIN (SELECT *, {", ".join(_metres_sql(d) for d in DISTANCES)} FROM community_services) s USING (ea_id)
        LEFT JOIN community_economy e USING (ea_id))""",
    _oldest_sql(1, "old_women"), _oldest_sql(0, "old_men"),
])

_SPENT = ["food"] + [f"{name}_spent" for name, _, _ in _RECALL]
_DERIVED = {
    "dropout": """CASE WHEN m.hh_c11 = 1 AND m.hh_c12 BETWEEN 1 AND 8 AND (m.hh_c13_19 = 1 OR m.hh_c11_19 = 1) THEN 0
                       WHEN m.hh_c11 = 1 AND m.hh_c12 BETWEEN 1 AND 8 AND m.hh_c11_19 = 2 AND m.hh_c13_19 = 2
                            AND (m.hh_c15 IS NULL OR m.hh_c15 >= 2015) AND m.hh_c15_19 IS NOT NULL THEN 1 END""",
    "school_travel_min": "CAST(CASE m.hh_c19b WHEN 1 THEN m.hh_c19a WHEN 2 THEN m.hh_c19a * 60 END AS DOUBLE)",
    "mother_presence": "CASE WHEN m.hh_b19a = 1 THEN 1 ELSE 0 END",
    "father_presence": "CASE WHEN m.hh_b16a = 1 THEN 1 ELSE 0 END",
    "father_job": f"coalesce(CASE WHEN {_ABSENT_F.replace('hh_b16b', 'm.hh_b16b')} THEN head_job ELSE f.hh_e06_8a END, 6)",
    "father_educ_type2": "CASE WHEN fe = 1 THEN 1 WHEN fe <= 3 THEN 2 WHEN fe = 4 THEN 3 WHEN fe >= 5 THEN 4 END",
    "mother_educ_type2": "CASE WHEN me = 1 THEN 1 WHEN me <= 3 THEN 2 WHEN me = 4 THEN 3 WHEN me >= 5 THEN 4 END",
    "phone_per_adult": "round(CASE WHEN adults = 0 THEN hh_f34 ELSE hh_f34 / nullif(adults, 0) END, 4)",
    "total0_17": "children", "num_elderly": "elderly",
    "total_aes1_exp_inf": "round(" + " + ".join(f"coalesce({s}.spent, 0)" for s in _SPENT) + ", 4)",
    "food_consumption_score": """round(2 * CASE WHEN hh_g08a IS NULL THEN hh_g08b WHEN hh_g08b IS NULL THEN hh_g08a
                                           ELSE (hh_g08a + hh_g08b) / 2e0 END
                                      + 3 * hh_g08c + hh_g08d + hh_g08f + 4 * hh_g08e + 4 * hh_g08g
                                      + 0.5e0 * hh_g08i + 0.5e0 * hh_g08h, 4)""",
    "r_csi": "CAST(hh_h02a + hh_h02b + hh_h02c + 3 * hh_h02d + 2 * hh_h02e AS DOUBLE)",
    "total_assist_invalue": "round(coalesce(cash / nullif(aes1, 0), 0) + coalesce(kind / nullif(aes1, 0), 0), 4)",
    "school_feed_beneficiary": "CASE WHEN m.id_code IN (hh_r04a, hh_r04b, hh_r04c, hh_r04d, hh_r04e) THEN 1 ELSE 0 END",
    "cat_hh_t05": "CASE hh_t05 WHEN 1 THEN '1-poor' WHEN 6 THEN '6-rich' ELSE CAST(hh_t05 AS VARCHAR) END",
    "wellbeing_better_neighbors": "CAST(hh_t05 > hh_t06 AS INT)", "wellbeing_better_friends": "CAST(hh_t05 > hh_t07 AS INT)",
    "drink_water_type": "CASE WHEN hh_f36 <= 3 THEN 1 WHEN hh_f36 <= 7 THEN 2 WHEN hh_f36 = 8 THEN 3 WHEN hh_f36 >= 9 THEN 4 END",
    "hh_t08_type2": "CASE WHEN hh_t08 <= 2 THEN 1 WHEN hh_t08 = 3 THEN 2 WHEN hh_t08 <= 5 THEN 3 END",
    "road_type": "CASE WHEN com_cd01 IN (1, 2) THEN 1 WHEN com_cd01 IN (3, 4) THEN 0 END",
    "freq_marriage_type2": "CASE WHEN freq_marriage <= 3 THEN 1 WHEN freq_marriage <= 5 THEN 2 END",
}
_PLAIN = {"y3_hhid": "m.y3_hhid", "PID": "m.PID", "ea_id": "hh.ea_id"}
_MEMBER = {c: f"m.{c}" for c in FINAL if c.startswith(("hh_c", "hh_d", "hh_e")) or c == "gender"}
_COLUMNS = [c for c in FINAL if not c.startswith("asset_q")]

# Households with an answer for every asset, each counted once per member seen in both waves.
ASSET_CTES = f"""
    complete AS (SELECT y3_hhid FROM assets GROUP BY 1 HAVING count(hh_l01) = {len(ASSET_CODES)}),
    counted AS (SELECT y3_hhid, CAST(count(*) AS DOUBLE) AS n FROM both_waves GROUP BY 1),
    {component_ctes("""SELECT a.y3_hhid AS id, hh_l02 AS i, CASE hh_l01 WHEN 2 THEN 0e0 ELSE 1e0 END AS x, n AS w
                       FROM assets a JOIN complete c ON a.y3_hhid = c.y3_hhid JOIN counted d ON a.y3_hhid = d.y3_hhid""")},
    h AS (SELECT c.id AS y3_hhid, round(score, 9) AS score, c.n AS counted_n, CAST(round(d.n * panelweight_2016, 1) AS DECIMAL(18, 1)) AS weight
          FROM component c JOIN counted d ON c.id = d.y3_hhid JOIN household_id i ON c.id = i.y3_hhid),
    {QUINTILE_CTES},
    quintile AS (SELECT y3_hhid, 1 + (SELECT count(*) FROM cuts WHERE cut < score) AS asset_q FROM h)"""
_QUINTILE = {f"asset_q{k}_recoded": f"CASE WHEN asset_q = {k} THEN 'Yes' WHEN asset_q IS NOT NULL THEN 'No' END"
             for k in range(2, 6)}


def sample_sql(with_assets: bool) -> str:
    columns = FINAL if with_assets else _COLUMNS
    expressions = {**_MEMBER, **_PLAIN, **_DERIVED, **_QUINTILE}
    return f"""
    WITH RECURSIVE {CTES}{f", {ASSET_CTES}" if with_assets else ""}
    SELECT * FROM (
        SELECT {", ".join(f"{expressions.get(c, c)} AS {c}" for c in columns)}
        FROM (SELECT b.*, CASE WHEN {_ABSENT_F.replace("hh_b16b", "b.hh_b16b")} THEN coalesce(om.hh_c09, b.hh_b18)
                               ELSE b.hh_b18 END AS fe,
                     CASE WHEN {_ABSENT_M.replace("hh_b19b", "b.hh_b19b")} THEN coalesce(ow.hh_c09, b.hh_b21)
                          ELSE b.hh_b21 END AS me
              FROM both_waves b LEFT JOIN old_men om ON b.y3_hhid = om.y3_hhid
              LEFT JOIN old_women ow ON b.y3_hhid = ow.y3_hhid) m
        LEFT JOIN both_waves f ON m.y3_hhid = f.y3_hhid AND m.hh_b16b IS NOT DISTINCT FROM f.id_code
        LEFT JOIN hh ON m.y3_hhid = hh.y3_hhid
        LEFT JOIN housing ON m.y3_hhid = housing.y3_hhid
        LEFT JOIN food_days ON m.y3_hhid = food_days.y3_hhid
        LEFT JOIN food_security ON m.y3_hhid = food_security.y3_hhid
        LEFT JOIN enterprise ON m.y3_hhid = enterprise.y3_hhid
        LEFT JOIN wellbeing ON m.y3_hhid = wellbeing.y3_hhid
        LEFT JOIN aid ON m.y3_hhid = aid.y3_hhid
        LEFT JOIN worst ON m.y3_hhid = worst.y3_hhid
        LEFT JOIN (SELECT * FROM safety_nets WHERE hh_r0a = 105) n ON m.y3_hhid = n.y3_hhid
        {" ".join(f"LEFT JOIN {s} ON m.y3_hhid = {s}.y3_hhid" for s in _SPENT)}
        {"LEFT JOIN quintile ON m.y3_hhid = quintile.y3_hhid" if with_assets else ""}
        LEFT JOIN community ON hh.ea_id = community.ea_id) t
    WHERE dropout IS NOT NULL AND com_cc02 IS NOT NULL"""


@query("child_sample", sql=sample_sql(with_assets=True))
def sample(spark, sf):
    return rounded_doubles(child_sample(survey_tables(spark, sf)))


@query("child_sample_without_assets", sql=sample_sql(with_assets=False))
def sample_without_assets(spark, sf):
    return rounded_doubles(child_sample(survey_tables(spark, sf), with_assets=False))


_TASKS = ["ag_d42", "ag_d43", "ag_d44"]
HOURS = ["total_rainy_labor_landprep", "total_rainy_labor_weed", "total_rainy_labor_harvest"]


HOURS_CTES = f"""
    plot AS (
        SELECT * FROM plots QUALIFY row_number() OVER (PARTITION BY y3_hhid, gardenid ORDER BY {", ".join(
            f"{t}{x}{n} NULLS FIRST" for t in _TASKS for x in "abcd" for n in range(1, 14))}) = 1),
    hours AS (
        SELECT y3_hhid, id_code, {", ".join(f"sum(CASE WHEN task = '{t}' THEN coalesce(h, 0) END) AS {name}"
                                            for t, name in zip(_TASKS, HOURS))}
        FROM ({" UNION ALL ".join(f"SELECT y3_hhid, '{t}' AS task, {t}a{n} AS id_code, "
                                  f"CAST({t}d{n} AS DOUBLE) * {t}c{n} * {t}b{n} AS h FROM plot" for t in _TASKS for n in range(1, 14))}) l
        WHERE id_code IS NOT NULL GROUP BY 1, 2),
    shocked AS (SELECT ea_id, {", ".join(f"max(CASE WHEN com_cg35c = {c} THEN 1 END) AS com_shocks{c}" for c in SHOCK_CODES)}
                FROM community_changes GROUP BY 1)"""

_PERIODS = {"food": "food", "nonfood_week": "non_food_i1", "nonfood_month": "non_food_i2", "nonfood_quarter": "non_food_j",
            "nonfood_year": "non_food_k"}
_SCORE, _COPING = _DERIVED["food_consumption_score"], _DERIVED["r_csi"]
# Every column of a member that the modelling table does not show, as SQL over the same joins.
MEMBER_COLUMNS = {
    "PID": "m.PID", "y3_hhid": "m.y3_hhid", "id_code": "m.id_code",
    **{f"oldest_female_{n}": f"ow.{c}" for n, c in OLDEST_FEMALE_FACTS.items()},
    **{f"oldest_male_{n}": f"om.{c}" for n, c in OLDEST_FACTS.items()},
    "oldest_female_hh": "CASE WHEN m.id_code = ow.id_code THEN 1 END", "oldest_male_hh": "CASE WHEN m.id_code = om.id_code THEN 1 END",
    **{f"{c}_father": f"f.{c}" for c in FATHER_FACTS}, **{f"{c}_mother": f"mo.{c}" for c in MOTHER_FACTS},
    "father_educ": "fe", "mother_educ": "me",
    **{f"{unit}_total_exp_{n}": f"round({v}{'_spent' if v != 'food' else ''}.{column}, 4)" for v, n in _PERIODS.items()
       for unit, column in (("aes1", "spent"), ("aes2", "spent_aes2"), ("pc", "spent_pc"))},
    "asset_sale_value": "worth.asset_sale_value", "other_income_monthly": "round(earned.other_income_monthly, 4)",
    "gr_total0_17": "CASE WHEN children BETWEEN 1 AND 2 THEN 1 WHEN children BETWEEN 3 AND 4 THEN 2 WHEN children >= 5 THEN 3 END",
    "food_score_ctg": f"CASE WHEN {_SCORE} <= 21 THEN 0 WHEN {_SCORE} <= 35 THEN 1 WHEN {_SCORE} > 35 THEN 2 END",
    "rcsi_food_secure": f"CASE WHEN {_COPING} BETWEEN 0 AND 4 THEN 1 WHEN {_COPING} > 4 THEN 0 END",
    "rcsi_mod_insecure": f"CAST({_COPING} BETWEEN 5 AND 10 AS INT)", "rcsi_sev_insecure": f"CAST({_COPING} >= 11 AS INT)",
    "freq_language": "freq_language", **{d: d for d in DISTANCES if d not in FINAL},
    "assetindex": "round(h.score * sqrt((h.counted_n - 1) / h.counted_n), 4)", **{f"asset_q{k}": f"CAST(asset_q = {k} AS INT)" for k in range(1, 6)},
    **{h: f"hours.{h}" for h in HOURS}, **{f"com_shocks{c}": f"com_shocks{c}" for c in SHOCK_CODES},
}


@query("member_table", sql=f"""
    WITH RECURSIVE {CTES}, {ASSET_CTES}, {HOURS_CTES},
    worth AS (SELECT y3_hhid, coalesce(sum(hh_l05), 0) AS asset_sale_value FROM assets GROUP BY 1),
    earned AS (SELECT y3_hhid, (coalesce(sum(coalesce(hh_p03a, 0) + coalesce(hh_p03b, 0) + coalesce(hh_p03c, 0)), 0)
                                + coalesce(sum(hh_p02), 0)) / 12 AS other_income_monthly FROM other_income GROUP BY 1)
    SELECT {", ".join(f"{e} AS {c}" for c, e in MEMBER_COLUMNS.items())}
    FROM (SELECT b.*, CASE WHEN {_ABSENT_F.replace("hh_b16b", "b.hh_b16b")} THEN coalesce(x.hh_c09, b.hh_b18)
                           ELSE b.hh_b18 END AS fe,
                 CASE WHEN {_ABSENT_M.replace("hh_b19b", "b.hh_b19b")} THEN coalesce(y.hh_c09, b.hh_b21)
                      ELSE b.hh_b21 END AS me
          FROM both_waves b LEFT JOIN old_men x ON b.y3_hhid = x.y3_hhid LEFT JOIN old_women y ON b.y3_hhid = y.y3_hhid) m
    LEFT JOIN old_men om ON m.y3_hhid = om.y3_hhid
    LEFT JOIN old_women ow ON m.y3_hhid = ow.y3_hhid
    LEFT JOIN both_waves f ON m.y3_hhid = f.y3_hhid AND m.hh_b16b IS NOT DISTINCT FROM f.id_code
    LEFT JOIN both_waves mo ON m.y3_hhid = mo.y3_hhid AND m.hh_b19b IS NOT DISTINCT FROM mo.id_code
    LEFT JOIN hours ON m.y3_hhid = hours.y3_hhid AND m.id_code = hours.id_code
    LEFT JOIN hh ON m.y3_hhid = hh.y3_hhid
    LEFT JOIN food_days ON m.y3_hhid = food_days.y3_hhid
    LEFT JOIN food_security ON m.y3_hhid = food_security.y3_hhid
    LEFT JOIN worth ON m.y3_hhid = worth.y3_hhid
    LEFT JOIN earned ON m.y3_hhid = earned.y3_hhid
    LEFT JOIN h ON m.y3_hhid = h.y3_hhid
    LEFT JOIN quintile ON m.y3_hhid = quintile.y3_hhid
    {" ".join(f"LEFT JOIN {s} ON m.y3_hhid = {s}.y3_hhid" for s in _SPENT)}
    LEFT JOIN community ON hh.ea_id = community.ea_id
    LEFT JOIN shocked ON hh.ea_id = shocked.ea_id""")
def whole_member_table(spark, sf):
    return rounded_doubles(member_table(survey_tables(spark, sf)).select(*MEMBER_COLUMNS))


@query("member_table_labour", sql=f"""
    WITH {CTES}, {HOURS_CTES}
    SELECT m.PID, m.y3_hhid, m.id_code, {", ".join(HOURS)}, f.hh_c09 AS hh_c09_mother, f.hh_b24 AS hh_b24_mother,
           {", ".join(f"s.com_shocks{c}" for c in SHOCK_CODES)}
    FROM both_waves m LEFT JOIN hours h ON m.y3_hhid = h.y3_hhid AND m.id_code = h.id_code
    LEFT JOIN both_waves f ON m.y3_hhid = f.y3_hhid AND m.hh_b19b IS NOT DISTINCT FROM f.id_code
    LEFT JOIN household_id i ON m.y3_hhid = i.y3_hhid
    LEFT JOIN (SELECT ea_id, {", ".join(f"max(CASE WHEN com_cg35c = {c} THEN 1 END) AS com_shocks{c}"
                                        for c in SHOCK_CODES)} FROM community_changes GROUP BY 1) s ON i.ea_id = s.ea_id""")
def member_table_labour(spark, sf):
    members = member_table(survey_tables(spark, sf), with_assets=False)
    return members.select("PID", "y3_hhid", "id_code", *HOURS, "hh_c09_mother", "hh_b24_mother",
                          *[f"com_shocks{c}" for c in SHOCK_CODES])


def _count_sql(name, base, lookup, keys, unique_base=True, checked=False, checked_base=False):
    """Match counts of one merge: two inputs and their join, counted one by one."""
    on = " AND ".join(f"b.{k} IS NOT DISTINCT FROM l.{k}" if k.endswith("b") else f"b.{k} = l.{k}" for k in keys)
    matched = f"(SELECT count(*) FROM ({base}) b JOIN ({lookup}) l ON {on})"
    base_rows, lookup_rows = f"(SELECT count(*) FROM ({base}) x)", f"(SELECT count(*) FROM ({lookup}) x)"
    only = f"{lookup_rows} - {matched}" if unique_base else "CAST(NULL AS BIGINT)"
    zero = lambda known: "CAST(0 AS BIGINT)" if known else "CAST(NULL AS BIGINT)"
    return f"""SELECT '{name}' AS merge, {base_rows} AS base_rows, {lookup_rows} AS lookup_rows, {matched} AS matched,
                      {base_rows} - {matched} AS base_only, {only} AS lookup_only, {zero(checked_base)} AS base_repeats,
                      {zero(checked)} AS lookup_repeats"""


_HOUSEHOLDS = "SELECT DISTINCT y3_hhid FROM roster"
_HOUSEHOLD_PARTS = {
    **{n: f"SELECT y3_hhid FROM {n}" for n in ("housing", "food_days", "food_security", "enterprise", "wellbeing")},
    "food_spending": "SELECT DISTINCT y3_hhid FROM food_items",
    "nonfood_spending": " UNION ".join(f"SELECT y3_hhid FROM {n}" for n, _, _ in _RECALL),
    "other_income": "SELECT DISTINCT y3_hhid FROM other_income", "assistance": "SELECT DISTINCT y3_hhid FROM safety_nets",
    "school_feeding": "SELECT DISTINCT y3_hhid FROM safety_nets WHERE hh_r0a = 105 AND "
                      "coalesce(hh_r04a, hh_r04b, hh_r04c, hh_r04d, hh_r04e) IS NOT NULL",
    "shocks": "SELECT DISTINCT y3_hhid FROM shocks WHERE hh_u02 = 1",
}
_PARENT = "SELECT DISTINCT y3_hhid, id_code AS {0} FROM both_waves"
MERGE_COUNTS = [
    *[(n, "SELECT PID FROM roster", f"SELECT PID FROM {n}", ["PID"], {"checked": True})
      for n in ("education", "health", "labour", "follow_up")],
    ("household_id", _HOUSEHOLDS, "SELECT y3_hhid FROM household_id", ["y3_hhid"], {"checked": True}),
    *[(n, _HOUSEHOLDS, lookup, ["y3_hhid"], {}) for n, lookup in _HOUSEHOLD_PARTS.items()],
    ("community", "SELECT ea_id FROM hh", "SELECT n_nationkey AS ea_id FROM nation", ["ea_id"], {"unique_base": False}),
    *[(f"parent_{who}", f"SELECT y3_hhid, {key} FROM both_waves", _PARENT.format(key), ["y3_hhid", key], {"unique_base": False})
      for who, key in (("father", "hh_b16b"), ("mother", "hh_b19b"))],
    ("plot_hours", "SELECT y3_hhid, id_code FROM both_waves", "SELECT y3_hhid, id_code FROM hours", ["y3_hhid", "id_code"],
     {"checked": True, "checked_base": True}),
    ("households", "SELECT y3_hhid FROM both_waves", _HOUSEHOLDS, ["y3_hhid"], {"unique_base": False}),
]


@query("merge_report", sql=f"WITH {CTES}, {HOURS_CTES} " + " UNION ALL ".join(
    _count_sql(*fixed, **rules) for *fixed, rules in MERGE_COUNTS))
def merge_counts(spark, sf):
    """Match counts of every merge of the survey job, from the job's own run."""
    with merge_report() as report, written_tables(spark), freed_shuffles(spark):
        member_table(survey_tables(spark, sf), with_assets=False, with_shocks=False, in_steps=True).write.format(
            "noop").mode("overwrite").save()
    return report.frame(spark)
