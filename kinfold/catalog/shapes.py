"""Reshapes, null handling, labelled loading, histograms."""

from __future__ import annotations

from pyspark.sql import functions as F

from kinfold.catalog.base import MEMBERS, StandIn, query, rounded_doubles
from kinfold.functions.missing import group_total, row_total
from kinfold.operators.dedup import first_per_key
from kinfold.operators.evaluate import histogram, split_features
from kinfold.operators.filters import drop_all_missing, drop_any_missing, drop_minor_nulls, null_counts
from kinfold.operators.groups import frequency
from kinfold.operators.merge import merge
from kinfold.operators.reshape import to_long, to_wide, to_wide_flags
from kinfold.sources.labels import dictionary_rows, load_labelled
from kinfold.sources.tables import read_driver_table

EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
FIRST_EVENT_SQL = """(SELECT * FROM events
                      QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1)"""


@query("reshape_wide_items", sql=f"""
    SELECT user_id, round(sum(v), 2) AS asset_sale_value,
           {", ".join(f"max(CASE WHEN event_type = '{t}' THEN value END) AS value{t}" for t in EVENT_TYPES)}
    FROM {FIRST_EVENT_SQL} f JOIN (SELECT user_id AS u, event_type AS t, sum(value) AS v FROM events GROUP BY 1, 2) s
      ON user_id = u AND event_type = t
    GROUP BY user_id""")
def reshape_wide_items(spark, sf):
    events = read_driver_table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")
    firsts = first_per_key(events, ["user_id", "event_type"], ["ts", "event_id"])
    wide = to_wide(firsts, ["user_id"], "event_type", ["value"], EVENT_TYPES, validate=True)
    totals = events.groupBy("user_id").agg(F.round(group_total("value"), 2).alias("asset_sale_value"))
    return merge(wide, totals, "user_id", split_hot=False)


@query("reshape_wide_indicator", sql=f"""
    SELECT user_id, {", ".join(f"max(CASE WHEN event_type = '{t}' THEN 1 END) AS shock_{t}" for t in EVENT_TYPES)}
    FROM events WHERE value > 5 GROUP BY user_id""")
def reshape_wide_indicator(spark, sf):
    shocks = read_driver_table(spark, sf, "events").filter("value > 5").select("user_id", "event_type").distinct()
    return to_wide_flags(shocks, ["user_id"], "event_type", EVENT_TYPES, "shock_")


# Two workers and their hours per line, as a plot with numbered columns.
PLOTS = StandIn("lineitem", (
    "l_orderkey AS hh", "l_linenumber AS garden",
    "CAST(l_partkey % 9 AS INT) AS worker1", "l_quantity * l_tax AS hours1",
    "CASE WHEN l_returnflag = 'A' THEN NULL ELSE CAST(l_suppkey % 9 AS INT) END AS worker2",
    "CASE WHEN l_linestatus = 'F' THEN NULL ELSE l_quantity * l_discount END AS hours2",
))


@query("reshape_long_multi", sql=f"""
    SELECT hh, id_code, round(coalesce(sum(hours), 0), 4) AS total_hours
    FROM (SELECT hh, worker1 AS id_code, hours1 AS hours FROM {PLOTS.sql} a
          UNION ALL SELECT hh, worker2, hours2 FROM {PLOTS.sql} b) l
    WHERE id_code IS NOT NULL GROUP BY hh, id_code""")
def reshape_long_multi(spark, sf):
    long = to_long(PLOTS.frame(spark, sf), ["hh", "garden"], {"worker": "id_code", "hours": "hours"}, [1, 2], "number")
    workers = drop_any_missing(long, ["id_code"])
    return rounded_doubles(workers.groupBy("hh", "id_code").agg(group_total("hours").alias("total_hours")))


@query("reshape_round_trip", sql=f"""
    SELECT c_custkey, round(c_acctbal, 2) AS value1, CAST(NULL AS DOUBLE) AS value2,
           round(c_acctbal * 2, 2) AS value3 FROM customer""")
def reshape_round_trip(spark, sf):
    wide = read_driver_table(spark, sf, "customer").select(
        "c_custkey", F.round("c_acctbal", 2).alias("value1"), F.lit(None).cast("double").alias("value2"),
        F.round(F.col("c_acctbal") * 2, 2).alias("value3"))
    long = to_long(wide, ["c_custkey"], {"value": "value"}, [1, 2, 3], "j")
    return to_wide(long, ["c_custkey"], "j", ["value"], [1, 2, 3])


@query("row_totals", sql="""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
           round((CASE WHEN l_returnflag = 'R' THEN 0 ELSE l_quantity END) + l_discount
                 + (CASE WHEN l_linestatus = 'F' THEN 0 ELSE l_tax END), 4) AS row_total
    FROM lineitem""")
def row_totals(spark, sf):
    lines = read_driver_table(spark, sf, "lineitem")
    gapped = row_total(F.when(F.col("l_returnflag") != "R", F.col("l_quantity")), "l_discount",
                       F.when(F.col("l_linestatus") != "F", F.col("l_tax")))
    return lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
                        F.round(gapped, 4).alias("row_total"))


NULL_COLUMNS = ["age_latest", "age_first", "father_id", "educ", "job", "visit_group"]


@query("null_counts", sql=f"""
    SELECT column_name, n_null FROM (
        {" UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) - count({c}) AS n_null FROM {MEMBERS.sql} m"
                            for c in NULL_COLUMNS)}) t""")
def null_counts_report(spark, sf):
    return null_counts(MEMBERS.frame(spark, sf).select(*NULL_COLUMNS))


# Few gaps in `reason`, many in `rank`: only the former lose their rows.
GAPS = StandIn("orders", (
    "o_orderkey", "CASE WHEN o_totalprice > 499500 THEN NULL ELSE o_orderpriority END AS reason",
    "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS rank",
))


@query("drop_minor_nulls", sql=f"""
    SELECT o.* FROM {GAPS.sql} o,
         (SELECT count(*) AS n, count(*) - count(reason) AS a, count(*) - count(rank) AS b FROM {GAPS.sql} x) n
    WHERE NOT (reason IS NULL AND a > 0 AND a < n.n * 0.05e0) AND NOT (rank IS NULL AND b > 0 AND b < n.n * 0.05e0)""")
def drop_minor(spark, sf):
    return drop_minor_nulls(GAPS.frame(spark, sf), limit=None, share=0.05)


@query("drop_all_missing", sql=f"""
    SELECT pid, age_first, educ, job FROM {MEMBERS.sql} m
    WHERE age_first IS NOT NULL OR educ IS NOT NULL OR job IS NOT NULL""")
def drop_empty(spark, sf):
    people = MEMBERS.frame(spark, sf).select("pid", "age_first", "educ", "job")
    return drop_all_missing(people, ["age_first", "educ", "job"])


# Fixed labels; status P and class 7 have none.
LABELS = {
    "status": {1: "filled", 2: "open"},
    "level": {1: "none", 2: "primary", 3: "junior", 4: "middle", 5: "diploma", 6: "degree"},
}
CODED = StandIn("orders", (
    "o_orderkey",
    "CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 WHEN 'P' THEN 3 END AS status",
    "CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE CAST(o_orderkey % 7 + 1 AS INT) END AS level",
    "CASE WHEN o_totalprice < 1100 THEN NULL ELSE o_totalprice END AS price",
))


def case_sql(column):
    cases = " ".join(f"WHEN {code} THEN '{text}'" for code, text in LABELS[column].items())
    return f"CASE {column} {cases} END"


@query("labelled_load", sql=f"""
    SELECT o_orderkey, {case_sql("status")} AS status, {case_sql("level")} AS level, price
    FROM {CODED.sql} c,
         (SELECT count(*) - count(status) AS a, count(*) - count(level) AS b, count(*) - count(price) AS c
          FROM {CODED.sql} x) n
    WHERE (status IS NULL OR status IN (1, 2)) AND (level IS NULL OR level <= 6)
      AND NOT (status IS NULL AND n.a BETWEEN 1 AND 99) AND NOT (level IS NULL AND n.b BETWEEN 1 AND 99)
      AND NOT (price IS NULL AND n.c BETWEEN 1 AND 99)""")
def labelled_load(spark, sf):
    return load_labelled(CODED.frame(spark, sf), dictionary_rows(spark, LABELS), ["status", "level"],
                         index=["o_orderkey"], drop_minor=True)


SCORED_SQL = """(SELECT d.doc_id, n_chars, quality, toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""


def scored_documents(spark, sf):
    documents = read_driver_table(spark, sf, "documents").select("doc_id", "n_chars")
    return merge(documents, read_driver_table(spark, sf, "labels"), "doc_id", keep="matched", split_hot=False)


@query("histogram_by_target", sql=f"""
    SELECT quality, CAST(floor(n_chars / 100) AS BIGINT) AS bin, count(*) AS n FROM {SCORED_SQL} s
    GROUP BY 1, 2""")
def histogram_by_target(spark, sf):
    documents = scored_documents(spark, sf).withColumn("hundreds", F.col("n_chars") / 100)
    return histogram(documents, "hundreds", "quality")


@query("histogram_compat", sql=f"""
    SELECT quality, CAST(CASE WHEN x = top THEN top - 1 ELSE floor(x) END AS BIGINT) AS bin, count(*) AS n
    FROM (SELECT quality, n_chars / 100 AS x FROM {SCORED_SQL} s) v,
         (SELECT ceil(max(n_chars / 100)) - 2 AS top FROM {SCORED_SQL} t) m
    WHERE x BETWEEN -1 AND top GROUP BY 1, 2""")
def histogram_compat(spark, sf):
    documents = scored_documents(spark, sf).withColumn("hundreds", F.col("n_chars") / 100)
    return histogram(documents, "hundreds", "quality", compat_edges=True)


@query("split_features", sql=f"SELECT doc_id, n_chars FROM {SCORED_SQL} s")
def features_only(spark, sf):
    return split_features(scored_documents(spark, sf), weights=["toxic"], labels=["quality"])[0]


@query("split_labels", sql="SELECT l.quality FROM labels l JOIN documents d ON l.doc_id = d.doc_id")
def labels_only(spark, sf):
    return split_features(scored_documents(spark, sf), weights=["toxic"], labels=["quality"])[1]


@query("split_weights", sql="SELECT l.toxic FROM labels l JOIN documents d ON l.doc_id = d.doc_id")
def weights_only(spark, sf):
    return split_features(scored_documents(spark, sf), weights=["toxic"], labels=["quality"])[2]


@query("frequency_table", sql="""
    SELECT event_type, count(*) AS n FROM events GROUP BY event_type""")
def frequency_table(spark, sf):
    return frequency(read_driver_table(spark, sf, "events"), "event_type")
