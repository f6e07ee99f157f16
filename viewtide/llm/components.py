"""Connected components of a link table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewtide.llm.tables import written


def components(links: DataFrame) -> DataFrame:
    """node and component (its smallest node) of every node in ``links`` (a, b).

    Every round points each node's larger neighbours, then its smaller ones, at the
    smallest node near it. Rounds grow with the logarithm of the longest chain. A node with
    many neighbours is aggregated before it is joined, and its rows may be split.
    """
    edges = written(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("u <> v").distinct(),
        "edges",
    )
    before = None
    while True:
        state = edges.agg(
            F.count("*").alias("n"), F.sum(F.hash("u", "v").cast("bigint")).alias("h"),
            F.sum(F.xxhash64("v", "u") % 1_000_003).alias("g"),
        ).first()
        if state == before or not state["n"]:
            break
        before = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(
            F.explode(F.array(
                F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
            )).alias("e")
        ).select("e.*").where("u <> v").distinct()
        edges = written(small, "edges")
    nodes = edges.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
    roots = edges.select(F.col("v").alias("node")).distinct()
    return nodes.unionByName(
        roots.join(nodes, "node", "left_anti").withColumn("component", F.col("node"))
    )
