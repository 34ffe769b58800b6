"""Must-link and cannot-link constraints: satisfaction, gates, structure, and why a constraint is broken."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.operators.components import components

# Why a must-link is broken.
CAUSES = ["A", "B", "C", "D", "no-log"]


def evaluate_pairs(pairs: DataFrame, clusters: DataFrame) -> DataFrame:
    """pairs (kind, a, b) with ca, cb (clusters of the ends) and status: satisfied, violated or unknown."""
    c = clusters.select(F.col("item"), F.col("cluster"))
    out = pairs.join(c.select(F.col("item").alias("a"), F.col("cluster").alias("ca")), "a", "left").join(c.select(F.col("item").alias("b"), F.col("cluster").alias("cb")), "b", "left")
    same = F.col("ca") == F.col("cb")
    good = F.when(F.col("kind") == "must", same).otherwise(~same)
    return out.withColumn("status", F.when(F.col("ca").isNull() | F.col("cb").isNull(), "unknown").when(good, "satisfied").otherwise("violated"))


def satisfaction(evaluated: DataFrame, by: list[str]) -> DataFrame:
    """Counts by status and the rate among known pairs, null if there are none."""
    out = evaluated.groupBy(*by).agg(F.count("*").alias("total"), F.count_if(F.col("status") == "satisfied").alias("satisfied"), F.count_if(F.col("status") == "violated").alias("violated"), F.count_if(F.col("status") == "unknown").alias("unknown"))
    return out.withColumn("rate", F.try_divide(F.col("satisfied").cast("double"), F.col("satisfied") + F.col("violated")))


def gate(current: DataFrame, baseline: DataFrame, key: str = "kind", tolerance: float = 0.0) -> DataFrame:
    """Rates against a baseline: regression if the rate fell by more than the tolerance, not comparable if either is null."""
    both = current.select(key, F.col("rate").alias("rate")).join(baseline.select(key, F.col("rate").alias("base")), key, "full")
    delta = F.col("rate") - F.col("base")
    return both.withColumn("delta", delta).withColumn("verdict", F.when(delta.isNull(), "not comparable").when(delta < -tolerance, "regression").when(delta > tolerance, "improved").otherwise("same"))


def usable(pairs: DataFrame, clusters: DataFrame) -> DataFrame:
    """The pairs whose two different ends both have a cluster."""
    ends = clusters.select("item").distinct()
    return pairs.where("a is not null and b is not null and a <> b").join(ends.withColumnRenamed("item", "a"), "a", "left_semi").join(ends.withColumnRenamed("item", "b"), "b", "left_semi")


def must_components(pairs: DataFrame) -> DataFrame:
    """item, component: the smallest item that must-links reach, for items that occur in a pair."""
    return components(pairs.where("kind = 'must'").select("a", "b"))


def contradictions(pairs: DataFrame, linked: DataFrame) -> DataFrame:
    """Cannot-links inside one must-component."""
    x, y = linked.select(F.col("item").alias("a"), F.col("component").alias("x")), linked.select(F.col("item").alias("b"), F.col("component").alias("y"))
    return pairs.where("kind = 'cannot'").join(x, "a").join(y, "b").where("x = y").select("a", "b", F.col("x").alias("component"))


def ideal(clusters: DataFrame, linked: DataFrame) -> DataFrame:
    """Clusters in which must-components stand for the clusters of their items: the upper bound of satisfaction."""
    joined = clusters.join(linked, "item", "left")
    return joined.select("item", F.coalesce(F.concat(F.lit("gold:"), F.col("component").cast("string")), F.col("cluster").cast("string")).alias("cluster"))


def crosstab(clusters: DataFrame, linked: DataFrame) -> DataFrame:
    """One row: clusters that mix components, components that are split, items and groups."""
    cells = clusters.join(linked, "item").groupBy("cluster", "component").agg(F.count("*").alias("n"))
    merged = cells.groupBy("cluster").agg(F.count("*").alias("k")).agg(F.count("*").alias("clusters"), F.count_if(F.col("k") > 1).alias("over_merged"))
    split = cells.groupBy("component").agg(F.count("*").alias("k")).agg(F.count("*").alias("components"), F.count_if(F.col("k") > 1).alias("over_split"))
    return merged.crossJoin(split).crossJoin(cells.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("items")))


def size_histogram(clusters: DataFrame) -> DataFrame:
    return clusters.groupBy("cluster").agg(F.count("*").alias("size")).groupBy("size").agg(F.count("*").alias("clusters"))


def move_tradeoff(pairs: DataFrame, clusters: DataFrame) -> DataFrame:
    """For each violated must-link (a, b): what moving a into b's cluster gains and loses among a's must-links."""
    must = evaluate_pairs(usable(pairs.where("kind = 'must'"), clusters), clusters)
    broken = must.where("status = 'violated'").select("a", "b", "ca", "cb")
    both = must.select("a", F.col("cb").alias("near")).unionByName(must.select(F.col("b").alias("a"), F.col("ca").alias("near")))
    out = broken.join(both, "a").groupBy("a", "b", "ca", "cb").agg(F.count_if(F.col("near") == F.col("cb")).alias("gained"), F.count_if(F.col("near") == F.col("ca")).alias("lost"))
    return out.withColumn("net", F.col("gained") - F.col("lost"))


def _entry(candidates: Column, target: Column) -> Column:
    """The first candidate with that id."""
    return F.get(F.filter(candidates, lambda c: c["candidate_id"] == target), F.lit(0))


def violation_causes(broken: DataFrame, logs: DataFrame, clusters: DataFrame) -> DataFrame:
    """Why the later item of a violated must-link did not join the earlier one's cluster.

    logs: item, seq (order of processing), candidates (array of candidate_id, distance, shown), action, target_id,
    overridden. A: the cluster was no candidate; B: a candidate, but not shown; D: chosen, then overridden; C: shown and
    not chosen; no-log: either end has no log. Adds later, earlier, target and cause.
    """
    seq = logs.select("item", "seq")
    out = broken.join(seq.select(F.col("item").alias("a"), F.col("seq").alias("sa")), "a", "left").join(seq.select(F.col("item").alias("b"), F.col("seq").alias("sb")), "b", "left")
    a_later = F.col("sa") > F.col("sb")
    out = out.withColumn("later", F.when(a_later, F.col("a")).otherwise(F.col("b"))).withColumn("earlier", F.when(a_later, F.col("b")).otherwise(F.col("a")))
    out = out.join(clusters.select(F.col("item").alias("earlier"), F.col("cluster").alias("target")), "earlier", "left")
    out = out.join(logs.select(F.col("item").alias("later"), "candidates", "action", "target_id", "overridden"), "later", "left")
    entry = _entry(F.col("candidates"), F.col("target"))
    cause = (
        F.when(F.col("sa").isNull() | F.col("sb").isNull(), "no-log")
        .when(entry.isNull(), "A")
        .when(~entry["shown"], "B")
        .when(F.coalesce(F.col("overridden"), F.lit(False)) & (F.col("action") == "assign") & (F.col("target_id") == F.col("target")), "D")
        .otherwise("C")
    )
    return out.select("a", "b", "later", "earlier", "target", cause.alias("cause"), entry["distance"].alias("distance"))


def cause_histogram(causes: DataFrame) -> DataFrame:
    """Counts of all causes, zeros included."""
    codes = causes.sparkSession.createDataFrame([(c,) for c in CAUSES], "cause string")
    return codes.join(causes.groupBy("cause").agg(F.count("*").alias("n")), "cause", "left").select("cause", F.coalesce("n", F.lit(0)).alias("n"))


def cannot_evidence(broken: DataFrame, logs: DataFrame) -> DataFrame:
    """Score and distance with which the two ends of a violated cannot-link were put into their cluster."""
    chosen = logs.where("final_action = 'assign'").select("item", F.col("score"), _entry(F.col("candidates"), F.col("target_id"))["distance"].alias("distance"))
    x, y = (chosen.select(F.col("item").alias(e), F.col("score").alias(f"score_{e}"), F.col("distance").alias(f"distance_{e}")) for e in ("a", "b"))
    return broken.join(x, "a", "left").join(y, "b", "left")


def guardrail_saves(evaluated: DataFrame, logs: DataFrame) -> DataFrame:
    """Satisfied cannot-links that hold only because an assignment of one end to the other's cluster was overridden."""
    held = logs.where("overridden and action = 'assign'").select("item", "target_id")
    good = evaluated.where("kind = 'cannot' and status = 'satisfied'")
    x = good.join(held, (F.col("a") == F.col("item")) & (F.col("cb") == F.col("target_id"))).select("a", "b", F.col("a").alias("saved"))
    y = good.join(held, (F.col("b") == F.col("item")) & (F.col("ca") == F.col("target_id"))).select("a", "b", F.col("b").alias("saved"))
    return x.unionByName(y)


def simulate_thresholds(overrides: DataFrame, current: float, steps: int = 5, width: float = 0.05) -> DataFrame:
    """Overridden assignments by score: what lower score thresholds would let through. overrides: score, kind ('must': a
    broken must-link would be rescued, 'cannot': a kept cannot-link would break)."""
    levels = overrides.sparkSession.range(steps).select(F.round(F.lit(current) - F.col("id") * width, 4).alias("threshold"))
    # a handful of levels by construction
    joined = F.broadcast(levels).join(overrides, F.col("score") >= F.col("threshold"), "left")
    out = joined.groupBy("threshold").agg(F.count_if(F.col("kind") == "must").alias("rescued"), F.count_if(F.col("kind") == "cannot").alias("broken"))
    return out.withColumn("net", F.col("rescued") - F.col("broken"))


def last_wins(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The row with the largest order for each key."""
    w = Window.partitionBy(key).orderBy(F.desc(order))
    return rows.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
