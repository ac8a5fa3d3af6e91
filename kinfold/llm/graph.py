"""Connected components of an edge table by alternating stars, entirely in joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.llm.shared import cut_lineage
from kinfold.operators.merge import join_on


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")),
                                          F.struct(F.col("b").alias("u"), F.col("a").alias("v")))).alias("e")).select("e.*")


def _star(arcs: DataFrame, larger_only: bool) -> DataFrame:
    """Hang neighbours on the least one: of each node's larger neighbours, or of the node with its smaller ones."""
    arcs = arcs if larger_only else arcs.filter("v < u")
    least = arcs.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    joined = join_on(arcs, least, "u", "inner")
    if larger_only:
        moved = joined.filter("v > u").select(F.col("m").alias("a"), F.col("v").alias("b"))
    else:
        moved = joined.select(F.col("m").alias("a"), F.explode(F.array("u", "v")).alias("b"))
    return moved.filter("a < b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); a component is named by its least node.

    Rounds of the large and the small star run until nothing moves, each written to the shared folder. A hub with
    very many edges is split by its join; of each round only one row, or none, reaches the driver.
    """
    edges = cut_lineage(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                        .filter("a < b").distinct())
    while True:
        # Done when every node hangs on one other, which hangs on none: then components are stars.
        sides = edges.select(F.explode(F.array(F.struct(F.col("a").alias("u"), F.lit(0).alias("hangs")),
                                               F.struct(F.col("b").alias("u"), F.lit(1).alias("hangs")))).alias("e"))
        odd = sides.groupBy("e.u").agg(F.sum("e.hangs").alias("up"), F.count("*").alias("n")).filter(
            "up > 1 OR up = 1 AND n > 1")
        if not odd.head(1):
            break
        large = _star(_both_ways(edges), larger_only=True)
        edges = cut_lineage(_star(_both_ways(large), larger_only=False))
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(
        edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
