"""Connected components by alternating stars, on written edge tables.

A large star hangs every larger neighbour of a node on the smallest one around it, a small star
hangs the smaller neighbours together; both keep the components, and they end in one star per
component around its smallest node. Each round is written, so lineage stays short. Minima are
combined on the map side and hubs meet one row per node in a join, which adaptive execution can
split; no group of edges is ever gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from procurelens.llm.common import saved


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    hung = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hung.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of the links (a, b) reaches. Other nodes are absent."""
    mark = [F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))]
    edges = saved(spark, _small_star(edges), "links")
    before, after = None, edges.agg(*mark).first()
    while after != before:
        edges = saved(spark, _small_star(_large_star(edges)), "stars")
        before, after = after, edges.agg(*mark).first()
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
