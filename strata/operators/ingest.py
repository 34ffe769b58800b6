"""Admission, work queues, upserts and resets. Each function returns the table's next state; nothing is changed in place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def first_by(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key."""
    return rows.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_rn = 1").drop("_rn")


def admit(new: DataFrame, existing: DataFrame, order: list[str]) -> DataFrame:
    """New rows whose guid and link are both unknown, each once. existing: guid, link. Null guids or links match nothing."""
    out = new.join(existing.where("guid is not null").select("guid").distinct(), "guid", "left_anti").join(existing.where("link is not null").select("link").distinct(), "link", "left_anti")
    by_guid = out.withColumn("_k", F.coalesce("guid", F.col("link"), F.expr("uuid()")))
    once = first_by(by_guid, ["_k"], order).drop("_k")
    has, none = once.where("link is not null"), once.where("link is null")
    return first_by(has, ["link"], order).unionByName(none)


def admission_status(link: Column) -> Column:
    return F.when(link.isNull() | (link == ""), "crawl_failed").otherwise("needs_crawl")


def with_ids(rows: DataFrame, existing: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Ids after the largest existing one, in a total order. A range sort, then offsets by partition: no single task."""
    start = existing.agg(F.coalesce(F.max(key), F.lit(0)).alias("m")).first()["m"]
    ranged = rows.orderBy(*order).withColumn("_p", F.spark_partition_id()).withColumn("_i", F.monotonically_increasing_id())
    from strata.operators.components import durable

    ranged = durable(ranged)  # the partitions must not move between the two reads
    sizes = sorted((r["_p"], r["n"]) for r in ranged.groupBy("_p").agg(F.count("*").alias("n")).collect())
    offsets, total = {}, start
    for p, n in sizes:
        offsets[p] = total
        total += n
    if not offsets:
        return rows.withColumn(key, F.lit(None).cast("long")).limit(0)
    place = F.create_map(*[F.lit(x) for pair in offsets.items() for x in pair])
    return ranged.withColumn(key, (F.element_at(place, F.col("_p")) + F.col("_i").bitwiseAND(F.lit((1 << 33) - 1)) + 1).cast("long")).drop("_p", "_i")


def enqueue(jobs: DataFrame, articles: DataFrame) -> DataFrame:
    """Jobs and a pending one for every ready article without."""
    fresh = articles.where("status = 'ready'").select("article_id").distinct().join(jobs.select("article_id"), "article_id", "left_anti")
    return jobs.select("article_id", "status", "attempts").unionByName(fresh.select("article_id", F.lit("pending").alias("status"), F.lit(0).alias("attempts")))


def pending(jobs: DataFrame, articles: DataFrame, results: DataFrame, limit: int) -> DataFrame:
    """The oldest pending jobs of articles with content, with any summary they already have."""
    out = jobs.where("status = 'pending'").join(articles.where("content is not null"), "article_id").join(results.select("article_id", "summary"), "article_id", "left")
    return out.orderBy("created_at", "article_id").limit(limit)


def route(jobs: DataFrame) -> DataFrame:
    """Whether a job needs analysis: one with a summary is sent as it is."""
    return jobs.withColumn("route", F.when(F.trim(F.coalesce("summary", F.lit(""))) != "", "sent").otherwise("analyse"))


def upsert(table: DataFrame, changes: DataFrame, key: str, order: str) -> DataFrame:
    """The newest row of each key, changes before the table among equals. changes and table share their columns."""
    both = table.withColumn("_src", F.lit(0)).unionByName(changes.withColumn("_src", F.lit(1)), allowMissingColumns=True)
    w = Window.partitionBy(key).orderBy(F.desc(order), F.desc("_src"))
    return both.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn", "_src")


def mark_sent(jobs: DataFrame, sent: DataFrame) -> DataFrame:
    hit = sent.select("article_id").distinct().withColumn("_hit", F.lit(True))
    out = jobs.join(hit, "article_id", "left")
    return out.withColumn("status", F.when(F.col("_hit"), "sent").otherwise(F.col("status"))).withColumn("last_error", F.when(F.col("_hit"), F.lit(None).cast("string")).otherwise(F.col("last_error"))).drop("_hit")


def mark_failed(jobs: DataFrame, failures: DataFrame, most: int = 3) -> DataFrame:
    """One more attempt for each failed job; failed for good at the most-th. failures: article_id, error."""
    out = jobs.join(failures.groupBy("article_id").agg(F.max("error").alias("_error")), "article_id", "left")
    tries, hit = F.coalesce("attempts", F.lit(0)) + 1, F.col("_error").isNotNull()
    return out.select(
        "article_id",
        F.when(hit, F.when(tries >= most, "failed").otherwise("pending")).otherwise(F.col("status")).alias("status"),
        F.when(hit, tries).otherwise(F.col("attempts")).alias("attempts"),
        F.when(hit, F.col("_error")).otherwise(F.col("last_error")).alias("last_error"),
    )


def backfill(rows: DataFrame, dim: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Nulls filled from the dimension's row."""
    side = dim.select(key, *[F.col(c).alias(f"_{c}") for c in columns])
    out = rows.join(side, key, "left")
    return out.select(*[F.coalesce(c, f"_{c}").alias(c) if c in columns else F.col(c) for c in rows.columns])


def resync_counts(parents: DataFrame, children: DataFrame, key: str, name: str) -> DataFrame:
    counts = children.groupBy(key).agg(F.count("*").alias("_n"))
    return parents.drop(name).join(counts, key, "left").withColumn(name, F.coalesce("_n", F.lit(0))).drop("_n")


def counters(links: DataFrame, key: str, bias: str, values: dict[str, str]) -> DataFrame:
    """Members of each group, all and by bias: values maps a column's name to the bias it counts."""
    return links.groupBy(key).agg(F.count("*").alias("article_count"), *[F.count_if(F.col(bias) == v).alias(c) for c, v in values.items()])


def keywords(raw: Column) -> Column:
    """Keywords from a JSON list or plain text: white space collapsed, empty ones dropped."""
    parsed = F.when(F.trim(raw).startswith("["), F.from_json(raw, "array<string>")).otherwise(F.array(raw))
    clean = F.transform(F.coalesce(parsed, F.array().cast("array<string>")), lambda w: F.trim(F.regexp_replace(F.coalesce(w, F.lit("")), r"(?U)\s+", " ")))
    return F.filter(clean, lambda w: w != "")


def round_robin(rows: DataFrame, group: str, order: str, quota: int) -> DataFrame:
    """One row of each group in turn until the quota is full: turn, then group. The window runs inside groups, and only
    rows of the first `quota` turns can be chosen."""
    ranked = rows.withColumn("turn", F.row_number().over(Window.partitionBy(group).orderBy(order))).where(F.col("turn") <= quota)
    return ranked.orderBy("turn", group).limit(quota)


def missing_columns(required: dict[str, set[str]], found: dict[str, set[str]]) -> list[str]:
    """Sorted table names and table.column names that are required and not there."""
    out = []
    for t, columns in required.items():
        out += [f"{t}.{c}" for c in columns - found[t]] if t in found else [t]
    return sorted(out)


def dummy_articles(events: DataFrame, hours: int = 3) -> DataFrame:
    """One row for each planned article: guid, time, publisher and bias in turn. events: event_id, base_date, num_articles,
    publishers (array), biases (array)."""
    rows = events.where("num_articles > 0").select("*", F.explode(F.sequence(F.lit(0), F.col("num_articles") - 1)).alias("i"))
    turn = lambda a: F.element_at(a, (F.col("i") % F.size(a) + 1).cast("int"))
    return rows.select(
        "event_id",
        F.concat(F.lit("dummy-"), F.col("event_id").cast("string"), F.lit("-"), F.col("i").cast("string")).alias("guid"),
        (F.col("base_date") + F.make_dt_interval(hours=F.col("i") * hours)).alias("published_at"),
        turn("publishers").alias("publisher"),
        turn("biases").alias("bias"),
    )
