"""Vector search, assignment and decision queries."""

from pyspark.sql import functions as F

from strata.functions import vector
from strata.operators import assign, candidates, constraints
from strata.plans.registry import query, table

#: In `embeddings`, every tenth vector is a new item; the others are known and grouped by label. Distances there are near 1.
NEAR, WIDE = 0.75, 0.80

_COS = "1 - list_cosine_similarity(q.embedding::DOUBLE[], e.embedding::DOUBLE[])"


def _sides(spark, d):
    e = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), "label")
    return e.where("id % 10 = 0"), e.where("id % 10 <> 0")


def _found(spark, d, k=500, most=2.1):
    new, old = _sides(spark, d)
    return candidates.nearest(new.withColumn("since", F.lit(0.0)), old.withColumn("until", F.lit(0.0)), k, most)


_LABELLED = f"""SELECT q.vec_id AS query_id, e.vec_id AS event_id, e.label, {_COS} AS distance
FROM embeddings q JOIN embeddings e ON e.vec_id % 10 <> 0 WHERE q.vec_id % 10 = 0"""


@query(f"""WITH f AS ({_LABELLED}), g AS (SELECT query_id, label, max(1 - distance) AS s FROM f GROUP BY 1, 2),
b AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(s, 9) DESC, label) AS rn FROM g)
SELECT query_id AS item_id, CAST(label AS BIGINT) AS group_id, round(s, 6) AS similarity, CASE WHEN s >= 0.3 THEN 'assign' ELSE 'create' END AS action FROM b WHERE rn = 1""")
def nearest_group_assign(spark, d):
    new, old = _sides(spark, d)
    near = candidates.nearest(new.withColumn("since", F.lit(0.0)), old.withColumn("until", F.lit(0.0)), 12, 2.1)
    found = near.join(old.select(F.col("id").alias("event_id"), "label"), "event_id").select(F.col("query_id").alias("item_id"), F.col("label").cast("long").alias("group_id"), F.round(1 - F.col("distance"), 9).alias("similarity"))
    return assign.nearest_group(found, 0.3).withColumn("similarity", F.round("similarity", 6))


@query(f"""WITH p AS (SELECT q.vec_id AS query_id, e.vec_id AS event_id, {_COS} AS distance
FROM embeddings q JOIN embeddings e ON e.vec_id % 10 <> 0 AND (e.vec_id % 30) + 7 >= (q.vec_id // 10) % 45 WHERE q.vec_id % 10 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, event_id) AS rank FROM p WHERE distance <= {WIDE})
SELECT query_id, event_id, round(distance, 6) AS distance, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 12""")
def knn_event_candidates(spark, d):
    new, old = _sides(spark, d)
    found = candidates.nearest(new.withColumn("since", F.floor(F.col("id") / 10) % 45), old.withColumn("until", F.col("id") % 30 + 7), 12, WIDE)
    return found.select("query_id", "event_id", F.round("distance", 6).alias("distance"), "rank")


@query(f"""WITH f AS ({_LABELLED}), c AS (SELECT query_id, count(*) FILTER (WHERE distance <= {NEAR}) AS n FROM f GROUP BY 1),
w AS (SELECT f.query_id, event_id, distance, n < 3 AS widened FROM f JOIN c USING (query_id) WHERE distance <= CASE WHEN n < 3 THEN {WIDE} ELSE {NEAR} END),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, event_id) AS rank FROM w)
SELECT query_id, event_id, round(distance, 6) AS distance, widened, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 12""")
def knn_widened_search(spark, d):
    out = candidates.widened(_found(spark, d, 5000, WIDE).drop("rank"), NEAR, WIDE, 3, 12)
    return out.select("query_id", "event_id", F.round("distance", 6).alias("distance"), "widened", "rank")


_TOPICS = f"""WITH n AS (SELECT q.vec_id AS query_id, e.label AS topic_id, e.vec_id AS cause_id, {_COS} AS distance
FROM embeddings q JOIN embeddings e ON e.vec_id % 10 <> 0 AND q.label % 4 = e.label % 4 {{scope}} WHERE q.vec_id % 10 = 0),
m AS (SELECT *, min(distance) OVER (PARTITION BY query_id, topic_id) AS topic_distance, row_number() OVER (PARTITION BY query_id, topic_id ORDER BY distance, cause_id) AS cause_rank FROM n WHERE distance <= 0.9),
r AS (SELECT *, dense_rank() OVER (PARTITION BY query_id ORDER BY topic_distance, topic_id) AS topic_rank FROM m)
SELECT query_id, CAST(topic_id AS BIGINT) AS topic_id, cause_id, round(distance, 6) AS distance, round(topic_distance, 6) AS topic_distance, CAST(topic_rank AS INTEGER) AS topic_rank, CAST(cause_rank AS INTEGER) AS cause_rank
FROM r WHERE topic_rank <= 2 AND cause_rank <= 5"""


def _ranked(spark, d, **scope):
    new, old = _sides(spark, d)
    q = new.select(F.col("id").alias("query_id"), (F.col("label") % 4).alias("category"), "vector")
    c = old.select(F.col("id").alias("cause_id"), F.col("label").cast("long").alias("topic_id"), (F.col("label") % 4).alias("category"), "vector", F.when(F.col("label") >= 5, F.col("label") - 5).alias("parent_id"))
    out = candidates.ranked_topics(q, c, 2, 0.9, **scope)
    return out.select("query_id", "topic_id", "cause_id", F.round("distance", 6).alias("distance"), F.round("topic_distance", 6).alias("topic_distance"), "topic_rank", "cause_rank")


@query(_TOPICS.format(scope=""))
def ranked_topic_candidates(spark, d):
    return _ranked(spark, d)


@query(_TOPICS.format(scope="AND e.label < 5"))
def ranked_root_topic_candidates(spark, d):
    return _ranked(spark, d, roots_only=True)


@query("""WITH u AS (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings)
SELECT CAST(label AS BIGINT) AS group_id, CAST(pos - 1 AS INTEGER) AS pos, round(avg(x::DOUBLE), 6) AS mean FROM u GROUP BY 1, 2""")
def centroid_recenter(spark, d):
    e = table(spark, d, "embeddings").select(F.col("label").cast("long").alias("group_id"), F.col("embedding").alias("vector"))
    return assign.centroids(e).select("group_id", F.posexplode("centroid").alias("pos", "m")).select("group_id", "pos", F.round("m", 6).alias("mean"))


@query("""SELECT vec_id, round(sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x))), 6) AS norm,
round(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x)) / (list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x))), 6) AS unit_norm, 80 AS padded_size, 0.0::DOUBLE AS padded_distance FROM embeddings""")
def vector_scalars(spark, d):
    e = table(spark, d, "embeddings")
    wide = vector.padded(F.col("embedding"), 80)
    return e.select("vec_id", F.round(vector.norm(F.col("embedding")), 6).alias("norm"), F.round(vector.norm(vector.normalised(F.col("embedding"))), 6).alias("unit_norm"), F.size(wide).alias("padded_size"), F.abs(F.round(vector.cosine_distance(wide, wide), 6)).alias("padded_distance"))


_DECISIONS = f"""WITH f AS ({_LABELLED}), n AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, event_id) AS rank FROM f WHERE distance <= {WIDE}),
l AS (SELECT query_id AS item, min(CASE WHEN rank = 1 THEN event_id END) AS best, min(CASE WHEN rank = 1 THEN round(1 - distance, 4) END) AS best_score, count(*) AS k FROM n WHERE rank <= 12 GROUP BY 1),
i AS (SELECT vec_id AS item, COALESCE(k, 0) AS k, best, best_score FROM embeddings LEFT JOIN l ON item = vec_id WHERE vec_id % 10 = 0),
dec AS (SELECT item, k, best, CASE WHEN item % 40 = 30 THEN 'create' WHEN item % 170 = 50 THEN 'merge' ELSE 'assign' END AS action,
CASE WHEN item % 130 = 20 THEN -1 ELSE best END AS target_id, CASE WHEN item % 110 = 40 THEN 'high' ELSE CAST(round(0.5 + COALESCE(best_score, 0) , 4) AS VARCHAR) END AS score,
CASE WHEN item % 90 = 10 THEN '이 후보와  무관 하다' ELSE 'same case' END AS reason FROM i),
o AS (SELECT *, action = 'assign' AND (COALESCE(TRY_CAST(score AS DOUBLE), 0) < 0.72 OR contains(reason, '무관')) AS weak FROM dec)"""


def _decisions(spark, d):
    """Decisions derived from the nearest candidates, with some of every odd kind."""
    found = _found(spark, d, 12, WIDE)
    per = found.groupBy("query_id").agg(F.min_by("event_id", "rank").alias("best"), F.min_by(F.round(1 - F.col("distance"), 4), "rank").alias("best_score"), F.count("*").alias("candidate_count"), F.collect_list("event_id").alias("candidate_ids"))
    items = table(spark, d, "embeddings").where("vec_id % 10 = 0").select(F.col("vec_id").alias("item_id"))
    out = items.join(per, F.col("item_id") == F.col("query_id"), "left").drop("query_id")
    i = F.col("item_id")
    return out.select(
        "item_id",
        F.coalesce("candidate_count", F.lit(0)).alias("candidate_count"),
        F.when(i % 40 == 30, "create").when(i % 170 == 50, "merge").otherwise("assign").alias("action"),
        F.when(i % 130 == 20, F.lit(-1)).otherwise(F.col("best")).alias("target_id"),
        F.when(i % 110 == 40, "high").otherwise(F.round(0.5 + F.coalesce("best_score", F.lit(0.0)), 4).cast("string")).alias("score"),
        F.when(i % 90 == 10, "이 후보와  무관 하다").otherwise("same case").alias("reason"),
        F.coalesce("candidate_ids", F.array().cast("array<long>")).alias("candidate_ids"),
    ), found


@query(_DECISIONS + """ SELECT item AS item_id, CAST(k AS BIGINT) AS candidate_count, CASE WHEN k = 0 THEN 'create' WHEN action NOT IN ('assign', 'create') THEN 'error' WHEN weak THEN 'create' WHEN action = 'assign' AND target_id = -1 THEN 'error' ELSE action END AS final_action, k > 0 AND weak AS overridden FROM o""")
def assign_guardrail(spark, d):
    rows, _ = _decisions(spark, d)
    return assign.guarded(rows, 0.72).select("item_id", "candidate_count", "final_action", "overridden")


def _logs(spark, d):
    rows, found = _decisions(spark, d)
    lists = found.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct(F.col("rank"), F.col("event_id").alias("candidate_id"), F.round("distance", 4).alias("distance"), (F.col("rank") <= 8).alias("shown")))).alias("candidates"))
    out = assign.guarded(rows, 0.72).join(lists, F.col("item_id") == F.col("query_id"), "left")
    return out.select(F.col("item_id").alias("item"), F.col("item_id").alias("seq"), "candidates", "action", "target_id", "overridden", "final_action", F.expr("try_cast(score as double)").alias("score"))


@query(_DECISIONS + f""", c AS (SELECT query_id, count(*) AS n, count(*) FILTER (WHERE rank <= 8) AS shown, round(sum(round(distance, 4)), 4) AS total FROM n WHERE rank <= 12 GROUP BY 1)
SELECT item AS item_id, CAST(k AS INTEGER) AS candidate_count, CAST(COALESCE(n, 0) AS INTEGER) AS logged, CAST(COALESCE(shown, 0) AS INTEGER) AS shown, COALESCE(total, 0) AS total_distance, action FROM o LEFT JOIN c ON c.query_id = item""")
def decision_log_roundtrip(spark, d):
    """Decision lines are written as JSON, scanned back as text lines, and summed up."""
    from strata.sources.logs import parse_lines

    rows, found = _decisions(spark, d)
    cand = found.select(F.col("query_id").alias("item_id"), "rank", F.col("event_id").alias("candidate_id"), "distance", F.lit("t").alias("title"))
    lines = assign.decision_log(cand, assign.guarded(rows, 0.72))
    back = parse_lines(lines.select(F.col("item_id").alias("seq"), F.col("line").alias("value")))
    total = F.aggregate("candidates", F.lit(0.0), lambda s, c: s + c["distance"])
    return back.select("item_id", "candidate_count", F.size("candidates").alias("logged"), F.size(F.filter("candidates", lambda c: c["shown"])).alias("shown"), F.round(total, 4).alias("total_distance"), F.col("decision.action").alias("action"))


def _violations(spark, d):
    """Must-links between each new item and the next; the known items' own ids are the clusters of new items' targets."""
    logs = _logs(spark, d)
    clusters = logs.select("item", F.when(F.col("final_action") == "assign", F.col("target_id")).otherwise(F.col("item")).alias("cluster"))
    pairs = logs.select(F.lit("must").alias("kind"), F.col("item").alias("a"), (F.col("item") + 10).alias("b"))
    broken = constraints.evaluate_pairs(pairs, clusters).where("status = 'violated'").select("a", "b")
    return broken, logs, clusters


_FINAL = _DECISIONS + """, fin AS (SELECT item, k, action, target_id, k > 0 AND weak AS overridden, CASE WHEN k = 0 THEN 'create' WHEN action NOT IN ('assign', 'create') THEN 'error' WHEN weak THEN 'create' WHEN action = 'assign' AND target_id = -1 THEN 'error' ELSE action END AS final_action, TRY_CAST(score AS DOUBLE) AS score FROM o),
cl AS (SELECT item, CASE WHEN final_action = 'assign' THEN target_id ELSE item END AS cluster FROM fin)"""


@query(_FINAL + """, br AS (SELECT x.item AS earlier, y.item AS later, x.cluster AS target FROM cl x JOIN cl y ON y.item = x.item + 10 AND x.cluster <> y.cluster),
j AS (SELECT br.*, n.rank, f.action, f.target_id, f.overridden FROM br JOIN fin f ON f.item = later LEFT JOIN n ON n.query_id = later AND n.event_id = target AND n.rank <= 12),
z AS (SELECT CASE WHEN rank IS NULL THEN 'A' WHEN rank > 8 THEN 'B' WHEN overridden AND action = 'assign' AND target_id = target THEN 'D' ELSE 'C' END AS cause FROM j),
codes AS (SELECT unnest(['A', 'B', 'C', 'D', 'no-log']) AS cause)
SELECT codes.cause, CAST(count(z.cause) AS BIGINT) AS n FROM codes LEFT JOIN z USING (cause) GROUP BY 1""")
def violation_causes(spark, d):
    broken, logs, clusters = _violations(spark, d)
    return constraints.cause_histogram(constraints.violation_causes(broken, logs, clusters))


@query(_FINAL + """, s AS (SELECT score, CASE WHEN item % 20 = 0 THEN 'must' ELSE 'cannot' END AS kind FROM fin WHERE overridden AND score IS NOT NULL), t AS (SELECT round(0.72 - i * 0.05, 4) AS threshold FROM range(5) r(i))
SELECT CAST(threshold AS DOUBLE) AS threshold, CAST(count(*) FILTER (WHERE kind = 'must') AS BIGINT) AS rescued, CAST(count(*) FILTER (WHERE kind = 'cannot') AS BIGINT) AS broken,
CAST(count(*) FILTER (WHERE kind = 'must') - count(*) FILTER (WHERE kind = 'cannot') AS BIGINT) AS net FROM t LEFT JOIN s ON score >= threshold GROUP BY 1""")
def threshold_simulation(spark, d):
    over = _logs(spark, d).where("overridden and score is not null").select("score", F.when(F.col("item") % 20 == 0, "must").otherwise("cannot").alias("kind"))
    return constraints.simulate_thresholds(over, 0.72)


@query(_FINAL + """, pr AS (SELECT x.item AS a, y.item AS b, x.cluster AS ca, y.cluster AS cb FROM cl x JOIN cl y ON y.item = x.item + 10 AND x.cluster <> y.cluster), h AS (SELECT item, target_id FROM fin WHERE overridden AND action = 'assign')
SELECT a, b, a AS saved FROM pr JOIN h ON h.item = a AND h.target_id = cb UNION ALL SELECT a, b, b AS saved FROM pr JOIN h ON h.item = b AND h.target_id = ca""")
def guardrail_saves(spark, d):
    _, logs, clusters = _violations(spark, d)
    pairs = logs.select(F.lit("cannot").alias("kind"), F.col("item").alias("a"), (F.col("item") + 10).alias("b"))
    return constraints.guardrail_saves(constraints.evaluate_pairs(pairs, clusters), logs)


@query(_FINAL + """, ds AS (SELECT f.item, f.target_id AS cluster, round(n.distance, 4) AS distance FROM fin f LEFT JOIN n ON n.query_id = f.item AND n.event_id = f.target_id WHERE final_action = 'assign'),
s AS (SELECT cluster, count(*) AS size, count(distance) AS known, count(*) FILTER (WHERE distance >= 0.7) AS weak_count, max(distance) AS max_distance FROM ds GROUP BY 1)
SELECT cluster, CAST(size AS BIGINT) AS size, CAST(known AS BIGINT) AS known, CAST(weak_count AS BIGINT) AS weak_count, max_distance, known >= 3 AND COALESCE(weak_count / NULLIF(known, 0), 0) > 0.6 AS anchor_suspect FROM s""")
def worklist_suspicion(spark, d):
    from strata.operators import review

    return review.suspicion(review.assign_distances(_logs(spark, d)), 0.7)
