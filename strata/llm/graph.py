"""Connected components of a distributed edge list by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import checkpointed


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], int(row["h"] or 0)


def components(edges: DataFrame) -> DataFrame:
    """u, root for every vertex u of edges (u, v) that is not its component's smallest vertex, which is root.

    Minima are aggregated before the shuffle, so that the hub of a star sends one row per task; each round is cut off by a
    checkpoint in the shared folder; rounds go on until nothing changes, which takes about log2 of the longest path. An empty
    list of edges gives an empty result.
    """
    edges = checkpointed(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = _state(edges)
    while state[0]:
        # large star: each larger neighbour of a vertex points to the smallest vertex that is near it
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: a vertex and its smaller neighbours point to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        edges = checkpointed(small.distinct())
        new = _state(edges)
        if new == state:
            break
        state = new
    return edges.select("u", F.col("v").alias("root"))
