"""Queries through files: labelled survey files and tables that replace themselves."""

from __future__ import annotations

from pyspark.sql import functions as F

from kinfold.catalog.base import MEMBERS, StandIn, query
from kinfold.catalog.shapes import CODED, LABELS, case_sql
from kinfold.session import own_folder
from kinfold.sources.dta import read_survey_file, value_labels, write_survey_file
from kinfold.sources.labels import load_labelled
from kinfold.sources.tables import overwrite_table, read_table, write_table

# Every storage type of the format: whole numbers, doubles, dates and texts, all with gaps.
STORED = StandIn("orders", (
    "o_orderkey AS pid",
    "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_custkey AS INT) END AS hh",
    "CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE CAST(o_orderkey % 7 - 3 AS SMALLINT) END AS level",
    "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus = 'F' END AS closed",
    "CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_totalprice END AS price",
    "CASE WHEN o_orderpriority = '2-HIGH' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS day",
    "CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE o_orderpriority END AS reason",
))


@query("survey_file_round_trip", sql=f"""
    SELECT pid, hh, CAST(level AS INT) AS level, CAST(closed AS INT) AS closed, price, CAST(day AS STRING) AS day, nullif(reason, '') AS reason
    FROM {STORED.sql} s""")
def survey_file_round_trip(spark, sf):
    path = own_folder(spark, "survey")
    write_survey_file(STORED.frame(spark, sf), path, {"hh": "household", "price": "total price"})
    # Long integers come back as doubles, which hold them up to 2^53.
    return read_survey_file(spark, path).withColumns({"pid": F.col("pid").cast("bigint"), "day": F.col("day").cast("string")})


@query("survey_file_filters", sql=f"""
    SELECT pid, price FROM {STORED.sql} s WHERE level IN (-3, 0, 2) AND price > 50000 AND hh IS NOT NULL AND reason <> ''""")
def survey_file_filters(spark, sf):
    path = own_folder(spark, "survey")
    write_survey_file(STORED.frame(spark, sf), path)
    found = read_survey_file(spark, path, ["pid", "price", "level", "hh", "reason"], partition_bytes=1 << 20)
    wanted = found.filter("level IN (-3, 0, 2) AND price > 50000 AND hh IS NOT NULL AND reason IS NOT NULL")
    return wanted.select(F.col("pid").cast("bigint").alias("pid"), "price")


@query("survey_file_labelled", sql=f"""
    SELECT o_orderkey, {case_sql("status")} AS status, {case_sql("level")} AS level, price FROM {CODED.sql} c
    WHERE (status IS NULL OR status IN (1, 2)) AND (level IS NULL OR level <= 6)""")
def survey_file_labelled(spark, sf):
    """Codes to texts by the labels that the file itself brings."""
    path = own_folder(spark, "survey")
    write_survey_file(CODED.frame(spark, sf), path, labels=LABELS)
    loaded = load_labelled(read_survey_file(spark, path), value_labels(spark, path), ["status", "level"], index=["o_orderkey"])
    return loaded.withColumn("o_orderkey", F.col("o_orderkey").cast("bigint"))


@query("overwrite_own_table", sql=f"""
    SELECT pid, hh, least(coalesce(age_latest, age_first) + 10, 99) AS age FROM {MEMBERS.sql} m
    WHERE coalesce(age_latest, age_first) >= 18""")
def overwrite_own_table(spark, sf):
    """A running table that is read, changed and written back to its own place twice."""
    path = own_folder(spark, "running")
    write_table(MEMBERS.frame(spark, sf), path)
    people = read_table(spark, path)
    people = overwrite_table(people.withColumn("age", F.coalesce("age_latest", "age_first")).filter("age >= 18"), path)
    people = overwrite_table(people.withColumn("age", F.least(F.col("age") + 10, F.lit(99))), path)
    return people.select("pid", "hh", "age")
