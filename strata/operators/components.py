"""Connected components by rounds of minimum labels with pointer jumping, cut off by shared checkpoints."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def durable(df: DataFrame) -> DataFrame:
    """A checkpoint in the shared folder that the cluster names; a folder of our own only where none is set."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir. Only a driver that is its own executor may use another."""
    context = spark.sparkContext
    found = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not found and not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return found or f"/tmp/checkpoints/{context.applicationId}"


def components(pairs: DataFrame) -> DataFrame:
    """item, component (its smallest member) for every item in pairs (a, b).

    A round takes the smallest label among neighbours (aggregated before the shuffle), then the label of the label, so that
    chains shorten by doubling. Rounds go on until nothing changes; labels only ever fall, so they end.
    """
    pairs = pairs.where("a is not null and b is not null")
    edges = durable(pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = durable(edges.select(F.col("a").alias("item")).distinct().withColumn("component", F.col("item")))
    changed = 1
    while changed:
        near = edges.join(labels, F.col("b") == F.col("item")).groupBy("a").agg(F.min("component").alias("near"))
        low = labels.join(near, F.col("item") == F.col("a")).select("item", F.col("component").alias("old"), F.least("component", "near").alias("component"))
        jump = low.select(F.col("item").alias("_i"), F.col("component").alias("_c"))
        labels_new = durable(low.join(jump, F.col("component") == F.col("_i"), "left").select("item", "old", F.coalesce("_c", "component").alias("component")))
        changed = labels_new.where("component <> old").limit(1).count()
        labels = labels_new.select("item", "component")
    return labels
