"""Parent trees, consistency of levels, and nested snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.components import durable


def roots(nodes: DataFrame) -> DataFrame:
    """id, root, depth (a root has 1) by following parents, however deep; a parent that does not exist ends the walk. What
    lies on a cycle or hangs on one has no root: each such node is its own, with depth 1. nodes: id (distinct), parent_id.

    A round joins each node's highest known ancestor to that ancestor's own, so that paths double: about log2 of the depth
    rounds, each cut off by a checkpoint. A cycle shows in that more rounds have nodes on their way than the nodes could fill.
    """
    ids = nodes.select(F.col("id").alias("up"))
    walk = nodes.select("id", F.col("parent_id").alias("up")).join(ids, "up", "left_semi").select("id", "up")
    walk = durable(nodes.select("id").join(walk, "id", "left").select("id", F.col("id").alias("root"), F.lit(1).alias("depth"), "up"))
    rounds = walk.count().bit_length() + 1
    for _ in range(rounds):
        going = walk.where("up is not null")
        if going.isEmpty():
            break
        above = walk.select(F.col("id").alias("up"), F.col("root").alias("_root"), F.col("depth").alias("_depth"), F.col("up").alias("_up"))
        further = going.join(above, "up").select("id", F.col("_root").alias("root"), (F.col("depth") + F.col("_depth")).alias("depth"), F.col("_up").alias("up"))
        walk = durable(walk.where("up is null").unionByName(further))
    cyclic = F.col("up").isNotNull()
    return walk.select("id", F.when(cyclic, F.col("id")).otherwise(F.col("root")).alias("root"), F.when(cyclic, 1).otherwise(F.col("depth")).alias("depth"))


def consistency(events: DataFrame) -> DataFrame:
    """Share of events whose gold topic has exactly one predicted root. events: gold_topic, root."""
    good = events.groupBy("gold_topic").agg(F.countDistinct("root").alias("k"), F.count("*").alias("n"))
    return good.agg(F.coalesce(F.try_divide(F.sum(F.when(F.col("k") == 1, F.col("n")).otherwise(0)).cast("double"), F.sum("n")), F.lit(0.0)).alias("consistency"), F.coalesce(F.sum("n"), F.lit(0)).alias("events"))


def nested(parents: DataFrame, children: DataFrame, key: str, fields: list[str], order: list[str], name: str) -> DataFrame:
    """Each parent with its children as an ordered array of structs; an empty array for none."""
    one = F.struct(*order, *[f for f in fields if f not in order])
    lists = children.groupBy(key).agg(F.array_sort(F.collect_list(one)).alias(name))
    out = parents.join(lists, key, "left")
    return out.withColumn(name, F.coalesce(name, F.array().cast(lists.schema[name].dataType)))


def snapshot(topics: DataFrame, events: DataFrame, articles: DataFrame, min_event: int = 0, limit: int | None = None) -> DataFrame:
    """Topics with their events with their article ids, all in id order. topics: topic_id, title; events: event_id,
    topic_id, title; articles: event_id, article_id. Only events with an id above min_event, the first `limit` of them."""
    events = events.where(F.col("event_id") > min_event)
    if limit is not None:
        events = events.orderBy("event_id").limit(limit)
    ids = articles.groupBy("event_id").agg(F.array_sort(F.collect_set("article_id")).alias("article_ids"))
    full = events.join(ids, "event_id", "left").withColumn("article_ids", F.coalesce("article_ids", F.array().cast("array<long>")))
    return nested(topics, full, "topic_id", ["event_id", "title", "article_ids"], ["event_id"], "events")


def cluster_map(snapshots: DataFrame) -> DataFrame:
    """item, cluster from a nested snapshot: articles to events; of several events the last wins."""
    rows = snapshots.select(F.explode("events").alias("e")).select(F.col("e.event_id").alias("cluster"), F.explode("e.article_ids").alias("item"))
    return rows.groupBy("item").agg(F.max("cluster").alias("cluster"))
