"""Scores, conversions, recodes, weighted quintiles, asset index."""

from __future__ import annotations

from pyspark.sql import functions as F

from kinfold.catalog.base import MEMBERS, StandIn, query, rounded, rounded_doubles
from kinfold.functions import household as hf
from kinfold.functions.missing import codes_as_missing
from kinfold.functions.recode import flag, one_hot, swap
from kinfold.operators.quantiles import weighted_quantile_group
from kinfold.operators.reshape import to_wide
from kinfold.operators.wealth import asset_index
from kinfold.plans import recodes
from kinfold.plans.labour import labour_hours
from kinfold.sources.tables import read_driver_table

# Days on which a food was eaten, long: a part as household, the supplier giving the food.
FOOD_DAYS = StandIn("lineitem", (
    "l_partkey AS hh", "CAST(l_suppkey % 9 AS INT) AS food", "CAST(l_suppkey % 5 AS INT) AS strategy",
    "CAST(CAST(l_quantity AS BIGINT) % 8 AS INT) AS days", "(CAST(l_quantity AS BIGINT) % 3) * 0.5e0 AS answer",
))
FOODS = ["a", "b", "c", "d", "e", "f", "g", "h", "i"]


def _days_sql(columns, item, value):
    cells = ", ".join(f"max(CASE WHEN {item} = {i} THEN {value} END) AS {c}" for i, c in enumerate(columns))
    return f"(SELECT hh, {cells} FROM {FOOD_DAYS.sql} d GROUP BY hh)"


FOOD_SCORE_SQL = f"""
    SELECT hh, 2 * staples + 3 * c + d + f + 4 * e + 4 * g + 0.5e0 * i + 0.5e0 * h AS food_consumption_score
    FROM (SELECT *, CASE WHEN a IS NULL THEN b WHEN b IS NULL THEN a ELSE (a + b) / 2e0 END AS staples
          FROM {_days_sql(FOODS, "food", "days")} x) y"""


@query("weighted_score_bands", sql=f"""
    SELECT *, CASE WHEN food_consumption_score <= 21 THEN 0 WHEN food_consumption_score <= 35 THEN 1
                   WHEN food_consumption_score > 35 THEN 2 END AS food_score_ctg
    FROM (SELECT hh, round(food_consumption_score, 4) AS food_consumption_score FROM ({FOOD_SCORE_SQL}) s) t""")
def weighted_score_bands(spark, sf):
    # The stand-in repeats answers; the greatest counts, here and in SQL.
    days = to_wide(FOOD_DAYS.frame(spark, sf), ["hh"], "food", ["days"], range(9), validate=False)
    d = dict(zip(FOODS, (f"days{i}" for i in range(9))))
    score = hf.food_score(staples=hf.staples(d["a"], d["b"]), pulses=d["c"], vegetables=d["d"], fruit=d["f"],
                          meat_fish=d["e"], milk=d["g"], sugar=d["i"], oil=d["h"])
    scored = days.select("hh", F.round(score, 4).alias("food_consumption_score"))
    return scored.withColumn("food_score_ctg", hf.food_band("food_consumption_score"))


@query("coping_index", sql=f"""
    SELECT hh, r_csi, CASE WHEN r_csi BETWEEN 0 AND 4 THEN 1 WHEN r_csi > 4 THEN 0 END AS food_secure,
           CASE WHEN r_csi BETWEEN 5 AND 10 THEN 1 WHEN r_csi < 5 OR r_csi > 10 THEN 0 END AS mod_insecure,
           CASE WHEN r_csi >= 11 THEN 1 WHEN r_csi < 11 THEN 0 END AS sev_insecure
    FROM (SELECT hh, a + b + c + 3 * d + 2 * e AS r_csi FROM {_days_sql(FOODS[:5], "strategy", "answer")} x) y""")
def coping(spark, sf):
    answers = to_wide(FOOD_DAYS.frame(spark, sf), ["hh"], "strategy", ["answer"], range(5), validate=False)
    index = hf.coping_index(less_expensive="answer0", portion="answer1", reduce_meals="answer2", child="answer3",
                            borrow="answer4")
    return (answers.select("hh", index.alias("r_csi"))
            .withColumns(hf.coping_flags("r_csi")))


SERVICES = StandIn("part", (
    "p_partkey", "CASE WHEN p_type = 'ECONOMY' THEN NULL ELSE p_size % 7 * 0.25e0 END AS distance",
    "CASE WHEN p_type = 'PROMO' THEN NULL ELSE CAST(p_partkey % 5 AS INT) END AS unit",
    "CASE WHEN p_brand = 'Brand#2' THEN NULL ELSE p_size % 2 + 1 END AS present",
))


@query("unit_conversion", sql=f"""
    SELECT p_partkey,
           round(CASE WHEN unit = 1 THEN distance WHEN unit = 3 THEN distance * 1609.344e0
                      WHEN unit = 2 THEN distance * 1000 WHEN present = 1 OR distance = 0 THEN 0 END, 4) AS usual_meter,
           round(CASE unit WHEN 1 THEN distance WHEN 3 THEN distance * 1609.344e0 WHEN 2 THEN distance * 1000 END, 4)
               AS no_zero_meter,
           round(CASE WHEN unit = 3 THEN distance * 1609.344e0 WHEN unit = 2 THEN distance * 1000
                      WHEN present = 1 OR distance = 0 THEN 0 END, 4) AS no_metre_meter,
           round(CASE unit WHEN 2 THEN distance * 1000 WHEN 1 THEN distance WHEN 0 THEN 0 END, 4) AS unit_zero_meter,
           round(CASE unit WHEN 1 THEN distance WHEN 2 THEN distance * 60 END, 4) AS travel_min
    FROM {SERVICES.sql} s""")
def unit_conversion(spark, sf):
    return rounded_doubles(SERVICES.frame(spark, sf).select(
        "p_partkey",
        hf.to_metres("distance", "unit", "present").alias("usual_meter"),
        hf.to_metres("distance", "unit").alias("no_zero_meter"),
        hf.to_metres("distance", "unit", "present", units=(2, 3)).alias("no_metre_meter"),
        hf.to_metres("distance", "unit", units=(1, 2), zero_unit=True).alias("unit_zero_meter"),
        hf.to_minutes("distance", "unit").alias("travel_min")))


_LEVELS = [("low", "s_acctbal < 2000"), ("mid", "s_acctbal >= 2000 AND s_acctbal < 6000"), ("high", "s_acctbal >= 6000")]


@query("most_frequent_option", sql=f"""
    SELECT nation, CASE WHEN high = top OR top IS NULL THEN nation % 3 + 7 WHEN mid = top THEN nation % 4 + 3
                        ELSE nation % 2 END AS freq_option
    FROM (SELECT *, greatest(coalesce(low, 0), coalesce(mid, 0), coalesce(high, 0)) AS top
          FROM (SELECT s_nationkey AS nation,
                       {", ".join(f"nullif(count(CASE WHEN {c} THEN 1 END), 0) AS {n}" for n, c in _LEVELS)}
                FROM supplier GROUP BY s_nationkey) c) t""")
def most_frequent_option(spark, sf):
    suppliers = read_driver_table(spark, sf, "supplier").select(F.col("s_nationkey").alias("nation"), "s_acctbal")
    counts = suppliers.groupBy("nation").agg(*[codes_as_missing(F.count_if(F.expr(c)), 0).alias(n) for n, c in _LEVELS])
    options = [F.col("nation") % 2, F.col("nation") % 4 + 3, F.col("nation") % 3 + 7]
    return counts.select("nation", hf.most_frequent(options, [n for n, _ in _LEVELS]).alias("freq_option"))


# Lines as plots: three numbered workers for each of two tasks.
PLOTS = StandIn("lineitem", ("l_orderkey AS hh",) + tuple(
    column for task, shift in (("t1", 0), ("t2", 4)) for n in (1, 2, 3) for column in (
        f"CASE WHEN l_linenumber = {n + shift // 4} THEN NULL ELSE CAST((l_partkey + {n * 3 + shift}) % 8 + 1 AS INT) END"
        f" AS {task}a{n}",
        f"l_quantity AS {task}b{n}",
        f"CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN NULL ELSE l_tax * {n} END AS {task}c{n}",
        f"l_discount AS {task}d{n}",
    )))


@query("plot_labour_hours", sql=f"""
    SELECT hh, id_code, round(sum(CASE WHEN task = 't1' THEN coalesce(hours, 0) END), 4) AS total_hours_t1,
           round(sum(CASE WHEN task = 't2' THEN coalesce(hours, 0) END), 4) AS total_hours_t2
    FROM ({" UNION ALL ".join(f"SELECT hh, '{t}' AS task, {t}a{n} AS id_code, {t}b{n} * {t}c{n} * {t}d{n} AS hours "
                              f"FROM {PLOTS.sql} p" for t in ("t1", "t2") for n in (1, 2, 3))}) l
    WHERE id_code IS NOT NULL GROUP BY hh, id_code""")
def plot_labour_hours(spark, sf):
    hours = labour_hours(PLOTS.frame(spark, sf), "hh", "id_code", {"t1": "t1", "t2": "t2"}, 3, "total_hours_")
    return rounded_doubles(hours)


@query("recode_groups", sql=f"""
    SELECT pid, CASE WHEN educ IN (1, 2) THEN 1 WHEN educ IN (3, 4) THEN 0 END AS road_type,
           CASE WHEN id_code <= 3 THEN 1 WHEN id_code <= 7 THEN 2 WHEN id_code = 8 THEN 3 WHEN id_code >= 9 THEN 4 END
               AS drink_water_type,
           CASE WHEN job <= 3 THEN 1 WHEN job <= 5 THEN 2 END AS freq_marriage_type2,
           CASE WHEN educ = 1 THEN 1 WHEN educ <= 3 THEN 2 WHEN educ = 4 THEN 3 WHEN educ >= 5 THEN 4 END
               AS father_educ_type2,
           CASE WHEN job <= 2 THEN 1 WHEN job = 3 THEN 2 WHEN job <= 5 THEN 3 END AS hh_t08_type2,
           CASE WHEN educ > job THEN 1 WHEN educ <= job THEN 0 END AS wellbeing_better_neighbors,
           CASE job WHEN 1 THEN '1-poor' WHEN 6 THEN '6-rich' ELSE CAST(job AS VARCHAR) END AS cat_hh_t05,
           CASE WHEN father_id = 98 THEN 1 ELSE 0 END AS father_presence,
           CASE WHEN job = 2 THEN 0 ELSE job END AS owned,
           round(CASE WHEN visit_group = 1 THEN CAST(age_latest AS DOUBLE) ELSE age_latest / (visit_group - 1e0) END, 4)
               AS phone_per_adult,
           {", ".join(f"CASE WHEN educ IS NOT NULL THEN CASE WHEN educ = {k} THEN 1 ELSE 0 END END AS q{k}"
                      for k in range(1, 6))},
           CASE WHEN educ = 2 THEN 'Yes' WHEN educ IS NOT NULL THEN 'No' END AS q2_recoded
    FROM {MEMBERS.sql} m""")
def recode_groups(spark, sf):
    people = MEMBERS.frame(spark, sf)
    out = people.select(
        "pid", recodes.road_type("educ").alias("road_type"), recodes.drink_water_type("id_code").alias("drink_water_type"),
        recodes.marriage_type("job").alias("freq_marriage_type2"), recodes.education_type("educ").alias("father_educ_type2"),
        recodes.income_type("job").alias("hh_t08_type2"), hf.better_off("educ", "job").alias("wellbeing_better_neighbors"),
        recodes.wealth_step("job").alias("cat_hh_t05"), flag(F.col("father_id") == 98).alias("father_presence"),
        swap("job", {2: 0}).alias("owned"), hf.per_adult("age_latest", F.col("visit_group") - 1).alias("phone_per_adult"),
        *one_hot("educ", range(1, 6), "q"))
    return rounded(out.withColumn("q2_recoded", recodes.yes_no("q2")), "phone_per_adult")


QUINTILE_CTES = """
    v AS (SELECT score, sum(weight) AS w FROM h WHERE score IS NOT NULL GROUP BY score),
    c AS (SELECT score, sum(w) OVER (ORDER BY score) AS cum, (SELECT sum(w) FROM v) AS tot FROM v),
    cuts AS (SELECT p, CASE WHEN max(CASE WHEN cum * 5 = tot * p THEN score END) IS NOT NULL
                            THEN (max(CASE WHEN cum * 5 = tot * p THEN score END)
                                  + min(CASE WHEN cum * 5 > tot * p THEN score END)) / 2e0
                            ELSE min(CASE WHEN cum * 5 > tot * p THEN score END) END AS cut
             FROM c, (VALUES (1), (2), (3), (4)) t(p) GROUP BY p)"""
QUINTILE_SQL = f"""
    WITH h AS (SELECT c_custkey, CASE WHEN c_acctbal < -900 THEN NULL ELSE floor(c_acctbal / 100) END AS score,
                      CAST((1 + c_custkey % 5) / 10.0 AS DECIMAL(18, 1)) AS weight FROM customer),
    {QUINTILE_CTES}
    SELECT c_custkey, CASE WHEN score IS NOT NULL
                           THEN CAST(1 + (SELECT count(*) FROM cuts WHERE cut < score) AS INT) END AS asset_q
    FROM h"""


@query("weighted_quintiles", sql=f"""
    SELECT c_custkey, asset_q,
           {", ".join(f"CASE WHEN asset_q IS NOT NULL THEN CASE WHEN asset_q = {k} THEN 1 ELSE 0 END END AS asset_q{k}"
                      for k in range(1, 6))}
    FROM ({QUINTILE_SQL}) q""")
def weighted_quintiles(spark, sf):
    households = read_driver_table(spark, sf, "customer").select(
        "c_custkey", F.when(F.col("c_acctbal") >= -900, F.floor(F.col("c_acctbal") / 100)).alias("score"),
        ((F.col("c_custkey") % 5 + 1) / F.lit(10.0)).alias("weight"))
    grouped = weighted_quantile_group(households, "score", "weight", "asset_q")
    return grouped.select("c_custkey", "asset_q").withColumns(recodes.quintile_dummies("asset_q", "asset_q"))


# Weights that add up to about 1e-10 over all rows, as weights scaled to a sum do; whole multiples of a power of two.
@query("weighted_quintiles_tiny", sql=f"""
    WITH h AS (SELECT c_custkey, floor(c_acctbal / 100) AS score,
                      CAST(1 + c_custkey % 5 AS DECIMAL(18, 1)) AS weight FROM customer),
    {QUINTILE_CTES}
    SELECT c_custkey, CAST(1 + (SELECT count(*) FROM cuts WHERE cut < score) AS INT) AS asset_q FROM h""")
def weighted_quintiles_tiny(spark, sf):
    households = read_driver_table(spark, sf, "customer").select(
        "c_custkey", F.floor(F.col("c_acctbal") / 100).alias("score"),
        ((F.col("c_custkey") % 5 + 1) * F.lit(2.0**-60)).alias("weight"))
    return weighted_quantile_group(households, "score", "weight", "asset_q").select("c_custkey", "asset_q")


def component_ctes(cells: str) -> str:
    """Common table expressions ending in ``component(id, score, n)`` from ``cells(id, i, x, w)`` of complete rows.

    The correlation matrix is squared thirty times; every column of that power is the
    first component, scaled.
    """
    return f"""
    cells AS ({cells}),
    centre AS (SELECT i, sum(w * x) / sum(w) AS m, sum(w) AS n FROM cells GROUP BY i),
    spread AS (SELECT c.i, max(m) AS m, max(n) AS n, sqrt(sum(w * (x - m) * (x - m)) / max(n)) AS s
               FROM cells c JOIN centre t ON c.i = t.i GROUP BY c.i),
    z AS (SELECT id, c.i, w, n, CASE WHEN s > 1e-9 THEN (x - m) / s ELSE 0e0 END AS z
          FROM cells c JOIN spread t ON c.i = t.i),
    power AS (
        SELECT 0 AS k, a.i, b.i AS j, sum(a.w * a.z * b.z) / max(a.n) AS v FROM z a JOIN z b ON a.id = b.id GROUP BY a.i, b.i
        UNION ALL
        SELECT k, i, j, v / max(abs(v)) OVER () FROM (
            SELECT a.k + 1 AS k, a.i, b.j, sum(a.v * b.v) AS v FROM power a JOIN power b ON a.j = b.i
            WHERE a.k < 30 GROUP BY a.k, a.i, b.j) s),
    scaled AS (SELECT i, v FROM power WHERE k = 30
               AND j = (SELECT i FROM power WHERE k = 30 AND i = j ORDER BY v DESC LIMIT 1)),
    loading AS (SELECT i, v / sqrt((SELECT sum(v * v) FROM scaled))
                          * sign((SELECT v FROM scaled ORDER BY abs(v) DESC LIMIT 1)) AS v FROM scaled),
    component AS (SELECT id, sum(z * v) AS score, max(n) AS n FROM z JOIN loading ON z.i = loading.i GROUP BY id)"""


@query("asset_index", sql=f"""
    WITH RECURSIVE {component_ctes("""SELECT vec_id AS id, i, CAST(embedding[i] AS DOUBLE) AS x, 1e0 AS w
                                      FROM embeddings, (SELECT unnest(range(1, 65)) AS i) r""")}
    SELECT vec_id, round(score * sqrt((n - 1) / n), 6) AS asset_index
    FROM embeddings LEFT JOIN component ON vec_id = id""")
def asset_scores(spark, sf):
    vectors = read_driver_table(spark, sf, "embeddings")
    columns = [f"item{i}" for i in range(64)]
    assets = vectors.select("vec_id", *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(columns)])
    return rounded(asset_index(assets, columns).select("vec_id", "asset_index"), "asset_index", digits=6)
