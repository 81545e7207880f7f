"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from corpusloom.llm.common import staged


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40))).alias("h")).first()
    return row["n"], row["h"]


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of all nodes of the edges (a, b), the root being the least node of its component.

    Large and small stars in turn until nothing changes; each step is written, so it survives lost executors. Loops and
    repeated edges do no harm; no edges give no rows. A node of very many edges is combined before its shuffle in the large
    star; after it, a node only has edges to the least neighbours of its own ones.
    """
    edges = staged(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct())
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b")
        small = large.withColumn("m", F.min("b").over(W.partitionBy("a")))
        small = small.select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*").filter("a != b")
        edges = staged(small.distinct())
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
