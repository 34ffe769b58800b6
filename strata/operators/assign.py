"""Assign-or-create decisions with deterministic guardrails, centroids and event chains."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.functions.text import clean_string

# A reason that holds one of these contradicts an assignment.
EVENT_MARKERS = ["무관", "관련성이 없어", "관련성이 없다", "연관성이 없어", "연관성이 없다", "직접적인 연관성이 없어", "직접적인 연관성이 없다", "일치하지 않", "동일한 사건으로 볼 수 없", "새로운 사건", "새로운 사안"]
TOPIC_MARKERS = ["무관", "관련성이 없어", "관련성이 없다", "연관성이 없어", "연관성이 없다", "직접적인 연관성이 없어", "직접적인 연관성이 없다", "일치하지 않", "후보가 없음", "새로운 사건", "새로운 사안"]


def reason_rejects(reason: Column, markers: list[str] = EVENT_MARKERS) -> Column:
    """True if the reason, white space collapsed and lower-cased, holds a marker; null is false."""
    text = F.lower(clean_string(reason))
    return F.exists(F.array(*[F.lit(m) for m in markers]), lambda m: F.contains(text, m))


def guarded(decisions: DataFrame, least: float = 0.80, markers: list[str] = EVENT_MARKERS) -> DataFrame:
    """Adds final_action and overridden to (candidate_count, action, target_id, score text, reason, candidate_ids).

    No candidates: create. An unknown action, or an assignment to an id that was no candidate, is an error row. An
    assignment below the least score or with a contradicting reason becomes a creation. An unreadable score is 0.
    """
    score = F.coalesce(F.try_to_number(F.col("score"), F.lit("9.99")).cast("double"), F.expr("try_cast(score as double)"), F.lit(0.0))
    assign = F.col("action") == "assign"
    weak = assign & ((score < least) | reason_rejects(F.col("reason"), markers))
    action = (
        F.when(F.col("candidate_count") == 0, "create")
        .when(F.col("action").isNull() | ~F.col("action").isin("assign", "create"), "error")
        .when(weak, "create")
        .when(assign & ~F.coalesce(F.array_contains("candidate_ids", F.col("target_id")), F.lit(False)), "error")
        .otherwise(F.col("action"))
    )
    return decisions.withColumn("final_action", action).withColumn("overridden", (F.col("candidate_count") > 0) & F.coalesce(weak, F.lit(False)))


def nearest_group(found: DataFrame, least: float = 0.55) -> DataFrame:
    """The best group of each item (ties to the smaller group) and whether it is near enough: item_id, group_id, similarity
    (rows of found) -> item_id, group_id, similarity, action. A NaN similarity never assigns."""
    clean = found.where(F.col("similarity").isNotNull() & ~F.isnan("similarity"))
    per = clean.groupBy("item_id", "group_id").agg(F.max("similarity").alias("similarity"))
    best = per.groupBy("item_id").agg(F.max(F.struct("similarity", (-F.col("group_id")).alias("g"))).alias("b"))
    out = best.select("item_id", (-F.col("b.g")).alias("group_id"), F.col("b.similarity").alias("similarity"))
    return out.withColumn("action", F.when(F.col("similarity") >= least, "assign").otherwise("create"))


def centroids(members: DataFrame, key: str = "group_id", vector: str = "vector") -> DataFrame:
    """Mean vector of each group, null vectors left out; a group without any is absent. key, centroid (array<double>)."""
    spread = members.where(F.col(vector).isNotNull()).select(key, F.posexplode(vector).alias("pos", "x"))
    means = spread.groupBy(key, "pos").agg(F.avg(F.col("x").cast("double")).alias("m"))
    return means.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "m"))), lambda p: p["m"]).alias("centroid"))


def chain(events: DataFrame, topic: str = "topic_id", created: str = "created_at", key: str = "event_id") -> DataFrame:
    """prev_event_id and next_event_id inside each topic by (created, id)."""
    w = Window.partitionBy(topic).orderBy(created, key)
    return events.withColumn("prev_event_id", F.lag(key).over(w)).withColumn("next_event_id", F.lead(key).over(w))


def insert_position(events: DataFrame, new: DataFrame) -> DataFrame:
    """Where each new event goes in its topic's chain: (topic_id, created_at, event_id) -> prev and next among `events`."""
    old = events.select("topic_id", F.struct("created_at", "event_id").alias("at"))
    joined = new.withColumn("at", F.struct("created_at", "event_id")).alias("n").join(old.alias("o"), "topic_id", "left")
    before, after = F.col("o.at") < F.col("n.at"), F.col("o.at") > F.col("n.at")
    out = joined.groupBy("topic_id", F.col("n.event_id").alias("event_id")).agg(F.max(F.when(before, F.col("o.at"))).alias("p"), F.min(F.when(after, F.col("o.at"))).alias("q"))
    return out.select("topic_id", "event_id", F.col("p.event_id").alias("prev_event_id"), F.col("q.event_id").alias("next_event_id"))


def decision_log(candidates: DataFrame, decisions: DataFrame, shown: int = 8) -> DataFrame:
    """One JSON line for each item: its candidates in rank order (distance to 4 places, title to 60 characters, whether the
    first `shown`), the decision and the outcome. candidates: item_id, rank, candidate_id, distance, title."""
    one = F.struct(F.col("rank"), F.col("candidate_id"), F.round(F.coalesce("distance", F.lit(0.0)), 4).alias("distance"), (F.col("rank") <= shown).alias("shown"), F.substring(F.coalesce("title", F.lit("")), 1, 60).alias("title"))
    lists = candidates.groupBy("item_id").agg(F.array_sort(F.collect_list(one)).alias("candidates"))
    joined = decisions.join(lists, "item_id", "left").withColumn("candidates", F.coalesce("candidates", F.array().cast(lists.schema["candidates"].dataType)))
    joined = joined.withColumn("candidate_count", F.size("candidates"))
    body = F.struct("item_id", "candidate_count", "candidates", F.struct("action", "target_id", "score", "reason").alias("decision"), "overridden", "final_action")
    return joined.select("item_id", "candidate_count", F.to_json(body, {"ignoreNullFields": "false"}).alias("line"))
