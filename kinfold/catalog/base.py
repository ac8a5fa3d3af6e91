"""Registry of queries, and stand-ins that give the given tables a survey's shape.

A stand-in is a projection of one table, written in expressions that both engines
read. It only prepares input columns (ages, ids, dates, nulls); every operator
works on top of it, separately in Spark and in SQL.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.sources.tables import read_driver_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function
    return register


@dataclass(frozen=True)
class StandIn:
    table: str
    columns: tuple[str, ...]

    def frame(self, spark: SparkSession, folder: str) -> DataFrame:
        return read_driver_table(spark, folder, self.table).selectExpr(*self.columns)

    @property
    def sql(self) -> str:
        return f"(SELECT {', '.join(self.columns)} FROM {self.table})"


def rounded(df: DataFrame, *columns: str, digits: int = 4) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def rounded_doubles(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round every double, since the two engines add in different orders."""
    doubles = {name for name, kind in df.dtypes if kind == "double"}
    return df.select(*[F.round(c, digits).alias(c) if c in doubles else F.col(c) for c in df.columns])


def date_text(c: str) -> Column:
    return F.substring(F.col(c).cast("string"), 1, 10)


# Households are customers, members their orders.
MEMBERS = StandIn("orders", (
    "o_custkey AS hh",
    "o_orderkey AS pid",
    "CAST(o_orderkey % 16 + 1 AS INT) AS id_code",
    "CASE WHEN o_orderpriority IN ('1-URGENT', '3-MEDIUM') THEN 1 ELSE 0 END AS gender",
    "CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 2 END AS relation",
    "CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'O' THEN NULL"
    " ELSE CAST(CAST(FLOOR(o_totalprice) AS BIGINT) % 90 AS INT) END AS age_latest",
    "CASE WHEN o_orderkey % 2 = 0 THEN NULL"
    " ELSE CAST(CAST(FLOOR(o_totalprice) AS BIGINT) % 80 AS INT) END AS age_first",
    "CASE WHEN o_orderpriority = '2-HIGH' THEN NULL"
    " WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'F' THEN 98"
    " ELSE CAST((o_orderkey + 3) % 16 + 1 AS INT) END AS father_id",
    "CASE WHEN o_orderstatus = 'O' AND o_orderpriority = '1-URGENT' THEN NULL"
    " ELSE CAST(o_orderkey % 7 + 1 AS INT) END AS educ",
    "CASE WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'F' THEN NULL"
    " ELSE CAST(o_orderkey % 6 + 1 AS INT) END AS job",
    "CASE WHEN o_orderstatus = 'F' THEN 1 WHEN o_orderstatus = 'O' THEN 2 END AS visit_group",
    "CASE WHEN o_orderpriority = '1-URGENT' THEN '' ELSE SUBSTR(CAST(o_orderdate AS STRING), 1, 10) END AS visit1",
    "CASE WHEN o_orderpriority = '5-LOW' THEN '##N/A##' WHEN o_orderpriority = '2-HIGH' THEN ''"
    " ELSE SUBSTR(CAST(o_orderdate AS STRING), 1, 10) END AS visit2",
    "CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '##N/A##'"
    " ELSE SUBSTR(CAST(o_orderdate AS STRING), 1, 10) END AS interview",
    "SUBSTR(CAST(o_orderdate AS STRING), 1, 7) AS month",
    "SUBSTR(CAST(o_orderdate AS STRING), 1, 4) AS year",
    "o_totalprice AS income",
))

# Household composition in SQL, for queries that build on it.
COMPOSITION_SQL = f"""
    SELECT hh, count(*) AS total_hh_member,
           CAST(coalesce(sum(CASE WHEN age >= 18 THEN 1 WHEN age < 18 THEN 0 END), 0) AS BIGINT) AS total_adult,
           CAST(coalesce(sum(CASE WHEN age BETWEEN 0 AND 17 THEN 1 WHEN age IS NOT NULL THEN 0 END), 0) AS BIGINT)
               AS total0_17,
           CAST(sum(CASE WHEN age IS NULL OR age > 60 THEN 1 ELSE 0 END) AS BIGINT) AS num_elderly,
           max(month) AS month
    FROM (SELECT *, coalesce(age_latest, age_first) AS age FROM {MEMBERS.sql}) m
    GROUP BY hh"""
SCALES_SQL = f"""
    SELECT *, CASE WHEN total0_17 BETWEEN 1 AND 2 THEN 1 WHEN total0_17 BETWEEN 3 AND 4 THEN 2
                   WHEN total0_17 >= 5 THEN 3 END AS gr_total0_17,
           CASE WHEN total_hh_member > 1 THEN 1e0 + (total_adult - 1) * 0.5e0 + total0_17 * 0.3e0
                WHEN total_adult = 1 THEN 1e0 END AS aes1,
           CASE WHEN total_hh_member > 1 THEN 1e0 + (total_adult - 1) * 0.7e0 + total0_17 * 0.5e0
                WHEN total_adult = 1 THEN 1e0 END AS aes2
    FROM ({COMPOSITION_SQL}) c"""

# Monthly price index from the lines shipped; the months of early 1996 have no entry.
PRICES = StandIn("lineitem", (
    "SUBSTR(CAST(l_shipdate AS STRING), 1, 7) AS month",
    "l_extendedprice AS price",
    "l_quantity AS quantity",
))
PRICES_SQL = f"""
    SELECT month, avg(price / quantity) / 10 AS cpi FROM {PRICES.sql} p
    WHERE month NOT IN ('1996-01', '1996-02', '1996-03') GROUP BY month"""


def prices(spark: SparkSession, folder: str) -> DataFrame:
    lines = PRICES.frame(spark, folder).filter(~F.col("month").isin("1996-01", "1996-02", "1996-03"))
    return lines.groupBy("month").agg((F.avg(F.col("price") / F.col("quantity")) / 10).alias("cpi"))


def members(spark: SparkSession, folder: str) -> DataFrame:
    from kinfold.functions.household import age_with_fallback

    return MEMBERS.frame(spark, folder).withColumn("age", age_with_fallback("age_latest", "age_first"))


MEMBERS_SQL = f"(SELECT *, coalesce(age_latest, age_first) AS age FROM {MEMBERS.sql} m)"
