"""Rubric checks, reviewer worklists and verdicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.text import is_attribute_title, is_category_title, is_time_title

WEAK_DISTANCE, ANCHOR_LEAST, ANCHOR_SHARE = 0.40, 3, 0.6


def check(rows: DataFrame, name: str, violated: Column) -> DataFrame:
    """One row: check, total, violations, ratio (0 for no rows)."""
    out = rows.agg(F.count("*").alias("total"), F.count_if(violated).alias("violations"))
    return out.select(F.lit(name).alias("check"), "total", "violations", F.coalesce(F.try_divide(F.col("violations").cast("double"), F.col("total")), F.lit(0.0)).alias("ratio"))


def member_counts(parents: DataFrame, children: DataFrame, key: str) -> DataFrame:
    """n children for every parent, zeros included."""
    n = children.groupBy(key).agg(F.count("*").alias("n"))
    return parents.select(key).join(n, key, "left").select(key, F.coalesce("n", F.lit(0)).alias("n"))


def title_checks(subtopics: DataFrame, topics: DataFrame) -> DataFrame:
    return check(subtopics, "R-S2", is_time_title(F.col("title"))).unionByName(check(subtopics, "R-S3", is_attribute_title(F.col("title")))).unionByName(check(topics, "R-T2", is_category_title(F.col("title"))))


def hierarchy_check(events: DataFrame, topics: DataFrame, depths: DataFrame) -> DataFrame:
    """R-S5: events that hang on a topic with children, and topics deeper than two levels."""
    inner = topics.where("parent_id is not null").select(F.col("parent_id").alias("topic_id")).distinct()
    wrong = events.join(inner, "topic_id", "left_semi").agg(F.count("*").alias("on_inner"))
    deep = depths.agg(F.count_if(F.col("depth") > 2).alias("too_deep"), F.count("*").alias("topics"))
    return wrong.crossJoin(deep)  # one row each


def assign_distances(logs: DataFrame) -> DataFrame:
    """item, cluster, distance of each item's last assignment. logs: item, seq, final_action, target_id, candidates."""
    chosen = F.get(F.filter("candidates", lambda c: c["candidate_id"] == F.col("target_id")), F.lit(0))
    rows = logs.where("final_action = 'assign'").select("item", "seq", F.col("target_id").alias("cluster"), chosen["distance"].alias("distance"))
    return rows.groupBy("item").agg(F.max_by(F.struct("cluster", "distance"), "seq").alias("x")).select("item", "x.cluster", "x.distance")


def suspicion(members: DataFrame, weak: float = WEAK_DISTANCE) -> DataFrame:
    """Per cluster: size, known, weak_count, max_distance, anchor_suspect. members: cluster, item, distance (null: unknown)."""
    out = members.groupBy("cluster").agg(F.count("*").alias("size"), F.count("distance").alias("known"), F.count_if(F.col("distance") >= weak).alias("weak_count"), F.max("distance").alias("max_distance"))
    return out.withColumn("anchor_suspect", (F.col("known") >= ANCHOR_LEAST) & (F.coalesce(F.try_divide(F.col("weak_count").cast("double"), F.col("known")), F.lit(0.0)) > ANCHOR_SHARE))


def sample(scored: DataFrame, targeted: int = 20, control: int = 5, seed: str = "0") -> DataFrame:
    """The most suspicious clusters of two or more, of those with a weak member, and a control sample of the others in the
    order of a seeded hash."""
    pool = scored.where("size >= 2")
    top = pool.where("weak_count > 0").orderBy(F.desc("weak_count"), F.desc_nulls_last("max_distance"), F.desc("size"), "cluster").limit(targeted)
    rest = pool.join(top.select("cluster"), "cluster", "left_anti")
    other = rest.orderBy(F.md5(F.concat(F.lit(f"{seed}|"), F.col("cluster").cast("string"))), "cluster").limit(control)
    return top.withColumn("selection", F.lit("targeted")).unionByName(other.withColumn("selection", F.lit("control")))


def verdict_pairs(items: DataFrame) -> DataFrame:
    """Pairs (kind, a < b) from reviewed groups: id, members (array), verdict, excluded (array).

    correct: all pairs must; exclude: excluded with kept cannot, kept pairs must; else none. Pairs are generated inside one
    reviewed group, whose size a reviewer bounds.
    """
    rows = items.where("verdict in ('correct', 'exclude')").withColumn("out", F.when(F.col("verdict") == "exclude", F.coalesce("excluded", F.array().cast("array<long>"))).otherwise(F.array().cast("array<long>")))
    one = rows.select("id", "out", F.explode("members").alias("x"), "members")
    two = one.select("out", "x", F.explode("members").alias("y")).where("x < y")
    ex, ey = F.array_contains("out", F.col("x")), F.array_contains("out", F.col("y"))
    kind = F.when(ex & ey, F.lit(None)).when(ex | ey, "cannot").otherwise("must")
    return two.select(kind.alias("kind"), F.col("x").alias("a"), F.col("y").alias("b")).where("kind is not null").distinct()


def merge_constraints(existing: DataFrame, added: DataFrame) -> DataFrame:
    """Sorted distinct union of pairs (kind, a, b), with a flag on pairs that are both must and cannot."""
    both = existing.unionByName(added).select("kind", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    kinds = both.groupBy("a", "b").agg(F.array_sort(F.collect_set("kind")).alias("kinds"))
    return kinds.select("a", "b", F.element_at("kinds", 1).alias("kind"), (F.size("kinds") > 1).alias("conflict"))


def verdict_counts(items: DataFrame) -> DataFrame:
    return items.groupBy(F.coalesce(F.col("verdict"), F.lit("(unfilled)")).alias("verdict")).agg(F.count("*").alias("n"))


def backfill_targets(rows: DataFrame, text: str, low: int = 80, high: int = 700) -> DataFrame:
    """Rows whose text, spaces trimmed, lies outside the band of lengths, and the length."""
    n = F.char_length(F.trim(F.coalesce(text, F.lit(""))))
    return rows.withColumn("n", n).where((n > high) | (n < low))
