"""Merges, deduplication and the two-wave target."""

from __future__ import annotations

from pyspark.sql import functions as F

from kinfold.catalog.base import MEMBERS_SQL, PRICES_SQL, StandIn, members, prices, query
from kinfold.functions import household as hf
from kinfold.operators.dedup import distinct_rows, first_per_key
from kinfold.operators.groups import frequency
from kinfold.operators.merge import duplicate_keys, merge, parent_lookup, with_suffix
from kinfold.plans.spending import with_inflator
from kinfold.sources.tables import read_driver_table

# Base table: orders of the two most urgent priorities. Lookup: returned lines per order.
RETURNS_SQL = """SELECT l_orderkey AS o_orderkey, count(*) AS n_returned, round(sum(l_quantity), 2) AS quantity
                 FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey"""
URGENT_SQL = """SELECT o_orderkey, o_custkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')"""


def urgent(spark, sf):
    orders = read_driver_table(spark, sf, "orders")
    return orders.filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select("o_orderkey", "o_custkey")


def returns(spark, sf):
    lines = read_driver_table(spark, sf, "lineitem").filter(F.col("l_returnflag") == "R")
    return lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count("*").alias("n_returned"), F.round(F.sum("l_quantity"), 2).alias("quantity"))


MERGED_SQL = f"""
    SELECT coalesce(b.o_orderkey, r.o_orderkey) AS o_orderkey, o_custkey, n_returned, quantity,
           CASE WHEN b.o_orderkey IS NULL THEN 2 WHEN r.o_orderkey IS NULL THEN 1 ELSE 3 END AS _merge
    FROM ({URGENT_SQL}) b FULL JOIN ({RETURNS_SQL}) r ON b.o_orderkey = r.o_orderkey"""


@query("merge_indicator", sql=MERGED_SQL)
def merge_indicator(spark, sf):
    return merge(urgent(spark, sf), returns(spark, sf), "o_orderkey", keep="all", indicator="_merge")


@query("merge_frequency", sql=f"SELECT _merge, count(*) AS n FROM ({MERGED_SQL}) m GROUP BY _merge")
def merge_frequency(spark, sf):
    return frequency(merge_indicator(spark, sf), "_merge")


@query("merge_left", sql=f"""
    SELECT b.*, n_returned, quantity, CASE WHEN r.o_orderkey IS NULL THEN 1 ELSE 3 END AS _merge
    FROM ({URGENT_SQL}) b LEFT JOIN ({RETURNS_SQL}) r ON b.o_orderkey = r.o_orderkey""")
def merge_left(spark, sf):
    return merge(urgent(spark, sf), returns(spark, sf), "o_orderkey", indicator="_merge", validate=True)


@query("merge_matched", sql=f"""
    SELECT b.*, n_returned, quantity FROM ({URGENT_SQL}) b JOIN ({RETURNS_SQL}) r ON b.o_orderkey = r.o_orderkey""")
def merge_matched(spark, sf):
    return merge(urgent(spark, sf), returns(spark, sf), "o_orderkey", keep="matched")


@query("merge_unique_contract", sql="""
    SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY l_orderkey, l_linenumber
    HAVING count(*) > 1""")
def merge_unique_contract(spark, sf):
    return duplicate_keys(read_driver_table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


# Columns on both sides: the segment of the base wins over that of the lookup.
@query("merge_overlap", sql="""
    SELECT o_orderkey, c_custkey, o_orderpriority AS segment, c_acctbal
    FROM (SELECT o_orderkey, o_custkey AS c_custkey, o_orderpriority FROM orders) o LEFT JOIN customer USING (c_custkey)
    """)
def merge_overlap(spark, sf):
    base = read_driver_table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("c_custkey"), F.col("o_orderpriority").alias("segment"))
    lookup = read_driver_table(spark, sf, "customer").select(
        "c_custkey", F.col("c_mktsegment").alias("segment"), "c_acctbal")
    return merge(base, lookup, "c_custkey")


@query("community_lookup", sql="""
    SELECT c_custkey, c_nationkey, n_name, r_name
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""")
def community_lookup(spark, sf):
    nations = read_driver_table(spark, sf, "nation").withColumnsRenamed({"n_nationkey": "c_nationkey"})
    regions = read_driver_table(spark, sf, "region").withColumnsRenamed({"r_regionkey": "n_regionkey"})
    communities = merge(nations, regions, "n_regionkey", split_hot=False)
    people = read_driver_table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return merge(people, communities, "c_nationkey").drop("n_regionkey")


@query("price_month_lookup", sql=f"""
    SELECT pid, month, round(cpi, 4) AS cpi, round(90.3225806451613e0 / nullif(cpi, 0), 6) AS inflator
    FROM {MEMBERS_SQL} m LEFT JOIN ({PRICES_SQL}) p USING (month)""")
def price_month_lookup(spark, sf):
    people = members(spark, sf).select("pid", "month")
    priced = with_inflator(people, prices(spark, sf))
    return priced.withColumns({"cpi": F.round("cpi", 4), "inflator": F.round("inflator", 6)})


# Member ids with gaps, so that missing meets missing.
GAPPED_SQL = f"""(SELECT pid, hh, CASE WHEN relation = 1 AND gender = 1 THEN NULL ELSE id_code END AS id_code,
                         CASE WHEN father_id = 98 THEN NULL ELSE father_id END AS father_id, educ, job
                  FROM {MEMBERS_SQL} m)"""


@query("merge_null_safe_keys", sql=f"""
    SELECT g.pid, g.hh, g.father_id, f.educ AS educ_father, f.job AS job_father
    FROM {GAPPED_SQL} g
    LEFT JOIN (SELECT * FROM {GAPPED_SQL} x QUALIFY row_number() OVER (PARTITION BY hh, id_code ORDER BY pid) = 1) f
      ON g.hh = f.hh AND g.father_id IS NOT DISTINCT FROM f.id_code""")
def merge_null_safe_keys(spark, sf):
    people = members(spark, sf).select(
        "pid", "hh", F.when(~((F.col("relation") == 1) & (F.col("gender") == 1)), F.col("id_code")).alias("id_code"),
        F.when(F.coalesce(F.col("father_id") != 98, F.lit(False)), F.col("father_id")).alias("father_id"),
        "educ", "job")
    found = parent_lookup(people, "hh", "id_code", "father_id", ["educ", "job"], "_father", tiebreak=["pid"])
    return found.select("pid", "hh", "father_id", "educ_father", "job_father")


_LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
         "l_returnflag", "l_linestatus", "l_shipdate"]
_LINE_TEXT = ["SUBSTR(CAST(l_shipdate AS STRING), 1, 10) AS l_shipdate" if c == "l_shipdate" else c for c in _LINE]


@query("dedup_first", sql=f"""
    SELECT {", ".join(_LINE)} FROM (SELECT {", ".join(_LINE_TEXT)} FROM lineitem) l
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {", ".join(_LINE[2:])}) = 1""")
def dedup_first(spark, sf):
    lines = read_driver_table(spark, sf, "lineitem").selectExpr(*_LINE_TEXT)
    return first_per_key(lines, _LINE[:2], _LINE[2:])


@query("dedup_distinct", sql="SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def dedup_distinct(spark, sf):
    return distinct_rows(read_driver_table(spark, sf, "lineitem"),
                         ["l_suppkey", "l_returnflag", "l_linestatus", "l_linenumber"])


# The two waves: a household's last order of 1998, and its last order of 1999.
WAVE = StandIn("orders", (
    "o_custkey AS pid", "o_orderkey", "SUBSTR(CAST(o_orderdate AS STRING), 1, 4) AS year",
    "CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 2 END AS attends",
    "CASE WHEN o_orderpriority = '5-LOW' THEN 1 ELSE 2 END AS stays",
    "CAST(o_orderkey % 12 AS INT) AS grade",
    "CASE WHEN o_orderpriority = '3-MEDIUM' THEN NULL ELSE CAST(2010 + o_orderkey % 7 AS INT) END AS entry",
))


def _wave_sql(year):
    return f"""(SELECT * FROM {WAVE.sql} w WHERE year = '{year}'
                QUALIFY row_number() OVER (PARTITION BY pid ORDER BY o_orderkey DESC) = 1)"""


@query("panel_target", sql=f"""
    SELECT * FROM (
        SELECT a.pid, a.grade, a.entry, b.entry AS entry_19,
               CASE WHEN a.attends = 1 AND a.grade BETWEEN 1 AND 8 AND (b.stays = 1 OR b.attends = 1) THEN 0
                    WHEN a.attends = 1 AND a.grade BETWEEN 1 AND 8 AND b.attends = 2 AND b.stays = 2
                         AND (a.entry IS NULL OR a.entry >= 2015) AND b.entry IS NOT NULL THEN 1 END AS dropout
        FROM {_wave_sql(1998)} a JOIN {_wave_sql(1999)} b ON a.pid = b.pid) t
    WHERE dropout IS NOT NULL""")
def panel_target(spark, sf):
    people = WAVE.frame(spark, sf)

    def wave(year):
        return first_per_key(people.filter(F.col("year") == year), ["pid"], [F.desc("o_orderkey")])

    follow_up = with_suffix(wave("1999"), "_19", except_for=["pid"])
    panel = merge(wave("1998"), follow_up, "pid", keep="matched", split_hot=False)
    target = hf.left_school("attends", "grade", "entry", "attends_19", "stays_19", "entry_19")
    return (panel.select("pid", "grade", "entry", "entry_19", target.alias("dropout"))
            .filter(F.col("dropout").isNotNull()))


@query("panel_match_counts", sql=f"""
    SELECT CASE WHEN b.pid IS NULL THEN 1 WHEN a.pid IS NULL THEN 2 ELSE 3 END AS _merge, count(*) AS n
    FROM {_wave_sql(1998)} a FULL JOIN {_wave_sql(1999)} b ON a.pid = b.pid GROUP BY 1""")
def panel_match_counts(spark, sf):
    people = WAVE.frame(spark, sf)
    first, second = (distinct_rows(people.filter(F.col("year") == y), ["pid"]) for y in ("1998", "1999"))
    return frequency(merge(first, second, "pid", keep="all", indicator="_merge", split_hot=False), "_merge")
