"""Intake, queue, chain, snapshot and review queries."""

from pyspark.sql import functions as F

from strata.operators import assign, hierarchy, ingest, review
from strata.plans.registry import query, table
from strata.sources import schema


@query("WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM events) SELECT event_id, user_id, event_type FROM r WHERE rn = 1")
def dedup_by_key(spark, d):
    return ingest.first_by(table(spark, d, "events"), ["user_id", "event_type"], ["ts", "event_id"]).select("event_id", "user_id", "event_type")


_ART = "a AS (SELECT event_id AS id, CASE WHEN event_id % 19 = 0 THEN NULL ELSE 'g' || CAST(user_id AS VARCHAR) || event_type END AS guid, CASE WHEN event_id % 23 = 0 THEN NULL ELSE 'l' || CAST(event_id % 701 AS VARCHAR) END AS link FROM events)"


def _articles(spark, d):
    e = table(spark, d, "events")
    i = F.col("event_id")
    return e.select(i.alias("id"), F.when(i % 19 != 0, F.concat(F.lit("g"), F.col("user_id").cast("string"), F.col("event_type"))).alias("guid"), F.when(i % 23 != 0, F.concat(F.lit("l"), (i % 701).cast("string"))).alias("link"))


@query(f"""WITH {_ART}, ex AS (SELECT * FROM a WHERE id % 4 = 0), n AS (SELECT * FROM a WHERE id % 4 <> 0 AND (guid IS NULL OR guid NOT IN (SELECT guid FROM ex WHERE guid IS NOT NULL)) AND (link IS NULL OR link NOT IN (SELECT link FROM ex WHERE link IS NOT NULL))),
k AS (SELECT *, COALESCE(guid, link, 'u' || CAST(id AS VARCHAR)) AS k FROM n), g AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY id) AS rn FROM k) WHERE rn = 1),
o AS (SELECT id, guid, link FROM (SELECT *, row_number() OVER (PARTITION BY link ORDER BY id) AS r2 FROM g) WHERE r2 = 1 OR link IS NULL) SELECT id, guid, link, CASE WHEN link IS NULL THEN 'crawl_failed' ELSE 'needs_crawl' END AS status FROM o""")
def admit_new_articles(spark, d):
    a = _articles(spark, d)
    new = ingest.admit(a.where("id % 4 <> 0"), a.where("id % 4 = 0").select("guid", "link"), ["id"])
    return new.select("id", "guid", "link", ingest.admission_status(F.col("link")).alias("status"))


@query("""WITH b AS (SELECT user_id AS article_id, ts, value, event_id, CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END AS src FROM events), r AS (SELECT *, row_number() OVER (PARTITION BY article_id ORDER BY ts DESC, src DESC, event_id DESC) AS rn FROM b) SELECT article_id, round(value, 6) AS value FROM r WHERE rn = 1""")
def upsert_latest(spark, d):
    e = table(spark, d, "events").select(F.col("user_id").alias("article_id"), F.struct("ts", F.when(F.col("event_type") == "signup", 1).otherwise(0).alias("s"), "event_id").alias("at"), "value", "event_type")
    old, new = e.where("event_type <> 'signup'").drop("event_type"), e.where("event_type = 'signup'").drop("event_type")
    return ingest.upsert(old, new, "article_id", "at").select("article_id", F.round("value", 6).alias("value"))


_JOBS = "j AS (SELECT o_orderkey AS article_id, CASE WHEN o_orderkey % 5 = 0 THEN 'sent' ELSE 'pending' END AS status, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_orderkey % 4 AS INTEGER) END AS attempts, NULL::VARCHAR AS last_error, o_orderdate AS created_at FROM orders)"


def _jobs(spark, d):
    o, k = table(spark, d, "orders"), F.col("o_orderkey")
    return o.select(k.alias("article_id"), F.when(k % 5 == 0, "sent").otherwise("pending").alias("status"), F.when(k % 7 != 0, (k % 4).cast("int")).alias("attempts"), F.lit(None).cast("string").alias("last_error"), F.col("o_orderdate").alias("created_at"))


@query(f"""WITH {_JOBS} SELECT article_id, CASE WHEN article_id % 3 = 0 THEN CASE WHEN COALESCE(attempts, 0) + 1 >= 3 THEN 'failed' ELSE 'pending' END ELSE status END AS status, CASE WHEN article_id % 3 = 0 THEN COALESCE(attempts, 0) + 1 ELSE attempts END AS attempts, CASE WHEN article_id % 3 = 0 THEN 'Request timed out.' END AS last_error FROM j""")
def retry_state(spark, d):
    jobs = _jobs(spark, d)
    failed = jobs.where("article_id % 3 = 0").select("article_id", F.lit("Request timed out.").alias("error"))
    return ingest.mark_failed(jobs, failed, 3)


@query(f"WITH {_JOBS} SELECT article_id, CASE WHEN article_id % 4 = 1 THEN 'sent' ELSE status END AS status, last_error FROM j")
def mark_sent(spark, d):
    jobs = _jobs(spark, d)
    return ingest.mark_sent(jobs, jobs.where("article_id % 4 = 1")).select("article_id", "status", "last_error")


@query(f"""WITH {_JOBS} SELECT article_id, CASE WHEN c_acctbal < 3000 THEN 'short' END AS summary, CASE WHEN c_acctbal < 3000 THEN 'sent' ELSE 'analyse' END AS route
FROM j JOIN orders ON o_orderkey = article_id LEFT JOIN customer ON c_custkey = o_custkey WHERE status = 'pending' AND o_totalprice IS NOT NULL ORDER BY created_at, article_id LIMIT 200""")
def pending_jobs(spark, d):
    o, c = table(spark, d, "orders"), table(spark, d, "customer")
    articles = o.select(F.col("o_orderkey").alias("article_id"), F.col("o_totalprice").cast("string").alias("content"))
    results = o.join(c.where("c_acctbal < 3000"), F.col("o_custkey") == F.col("c_custkey")).select(F.col("o_orderkey").alias("article_id"), F.lit("short").alias("summary"))
    return ingest.route(ingest.pending(_jobs(spark, d), articles, results, 200)).select("article_id", "summary", "route")


@query("""SELECT o_orderkey AS article_id, 'pending' AS status FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 3 <> 0 UNION ALL SELECT o_orderkey, 'sent' FROM orders WHERE o_orderkey % 3 = 0""")
def enqueue_jobs(spark, d):
    o, k = table(spark, d, "orders"), F.col("o_orderkey")
    jobs = o.where(k % 3 == 0).select(k.alias("article_id"), F.lit("sent").alias("status"), F.lit(0).alias("attempts"))
    return ingest.enqueue(jobs, o.select(k.alias("article_id"), F.when(F.col("o_orderstatus") == "F", "ready").otherwise("needs_crawl").alias("status"))).select("article_id", "status")


@query("SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority IS NOT NULL ORDER BY o_orderdate, o_orderkey LIMIT 20")
def crawl_batch(spark, d):
    return table(spark, d, "orders").where("o_orderstatus = 'O' and o_orderpriority is not null").orderBy("o_orderdate", "o_orderkey").select("o_orderkey", "o_orderdate").limit(20)


@query("""SELECT c_custkey, COALESCE(CASE WHEN c_custkey % 3 <> 0 THEN 'c' || CAST(c_custkey % 9 AS VARCHAR) END, n_name) AS publisher, COALESCE(CASE WHEN c_custkey % 4 <> 0 THEN c_mktsegment END, n_name) AS segment FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey""")
def backfill_from_dim(spark, d):
    c, n = table(spark, d, "customer"), table(spark, d, "nation")
    rows = c.select("c_custkey", F.col("c_nationkey").alias("feed"), F.when(F.col("c_custkey") % 3 != 0, F.concat(F.lit("c"), (F.col("c_custkey") % 9).cast("string"))).alias("publisher"), F.when(F.col("c_custkey") % 4 != 0, F.col("c_mktsegment")).alias("segment"))
    dim = n.select(F.col("n_nationkey").alias("feed"), F.col("n_name").alias("publisher"), F.col("n_name").alias("segment"))
    return ingest.backfill(rows, dim, "feed", ["publisher", "segment"]).drop("feed")


@query("SELECT c_custkey, CAST(COALESCE(n, 0) AS BIGINT) AS order_count FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON o_custkey = c_custkey")
def count_resync(spark, d):
    return ingest.resync_counts(table(spark, d, "customer").select("c_custkey"), table(spark, d, "orders").withColumnRenamed("o_custkey", "c_custkey"), "c_custkey", "order_count")


@query("""SELECT l_orderkey AS event_id, CAST(count(*) AS BIGINT) AS article_count, CAST(count(*) FILTER (WHERE l_returnflag = 'A') AS BIGINT) AS left_count, CAST(count(*) FILTER (WHERE l_returnflag = 'N') AS BIGINT) AS mid_count, CAST(count(*) FILTER (WHERE l_returnflag = 'R') AS BIGINT) AS right_count FROM lineitem GROUP BY 1""")
def bias_counters(spark, d):
    return ingest.counters(table(spark, d, "lineitem").withColumnRenamed("l_orderkey", "event_id"), "event_id", "l_returnflag", {"left_count": "A", "mid_count": "N", "right_count": "R"})


@query("SELECT event_id, 10000 + row_number() OVER (ORDER BY ts, event_id) AS id FROM events WHERE event_type = 'error'")
def insert_ids(spark, d):
    e = table(spark, d, "events")
    return ingest.with_ids(e.where("event_type = 'error'"), spark.createDataFrame([(10000,)], "id long"), "id", ["ts", "event_id"]).select("event_id", "id")


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'done' ELSE 'pending' END AS status, NULL::BIGINT AS topic_id FROM orders WHERE NOT (o_orderpriority LIKE '1-%')""")
def layered_reset(spark, d):
    """Scoped delete, then summaries kept as done and topics unset."""
    o = table(spark, d, "orders").where(~F.col("o_orderpriority").like("1-%"))
    return o.select("o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, "done").otherwise("pending").alias("status"), F.lit(None).cast("long").alias("topic_id"))


@query("""SELECT doc_id, source, CAST(turn AS INTEGER) AS turn FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS turn FROM documents) ORDER BY turn, source LIMIT 100""")
def round_robin_quota(spark, d):
    return ingest.round_robin(table(spark, d, "documents").select("doc_id", "source"), "source", "doc_id", 100).select("doc_id", "source", "turn")


@query("""SELECT event_id, 'dummy-' || CAST(event_id AS VARCHAR) || '-' || CAST(i AS VARCHAR) AS guid, ts + i * INTERVAL 3 HOUR AS published_at, ['p1', 'p2', 'p3'][i % 3 + 1] AS publisher, ['진보', '중도'][i % 2 + 1] AS bias
FROM (SELECT event_id, ts, unnest(range(event_id % 4)) AS i FROM events)""")
def dummy_generator(spark, d):
    e = table(spark, d, "events").select("event_id", F.col("ts").alias("base_date"), (F.col("event_id") % 4).cast("int").alias("num_articles"), F.array(*map(F.lit, ("p1", "p2", "p3"))).alias("publishers"), F.array(F.lit("진보"), F.lit("중도")).alias("biases"))
    return ingest.dummy_articles(e)


@query("""SELECT event_id, array_to_string(list_filter(list_transform(string_split(event_type || ',  ' || CAST(user_id AS VARCHAR) || ' x ,', ','), lambda w: trim(w)), lambda w: w <> ''), '|') AS keywords FROM events""")
def keyword_adapter(spark, d):
    e = table(spark, d, "events")
    raw = F.to_json(F.array(F.col("event_type"), F.concat(F.lit("  "), F.col("user_id").cast("string"), F.lit(" x ")), F.lit("")))
    return e.select("event_id", F.array_join(ingest.keywords(raw), "|").alias("keywords"))


@query("SELECT unnest(['documents.guid', 'labels.note', 'topics']) AS missing")
def schema_validation(spark, d):
    found = {t: set(table(spark, d, t).columns) for t in ("documents", "labels")}
    out = ingest.missing_columns({"documents": {"doc_id", "text", "guid"}, "labels": {"doc_id", "note"}, "topics": {"id"}}, found)
    return spark.createDataFrame([(x,) for x in out], "missing string")


@query("SELECT o_orderstatus AS status, CAST(count(*) AS BIGINT) AS n FROM orders WHERE o_orderstatus NOT IN ('F', 'O') GROUP BY 1")
def domain_check(spark, d):
    return schema.bad_domains(table(spark, d, "orders").withColumnRenamed("o_orderstatus", "status"), "status", ["F", "O"])


@query("SELECT vec_id FROM embeddings WHERE len(embedding) <> 64")
def dimension_check(spark, d):
    return schema.bad_dimensions(table(spark, d, "embeddings"), "embedding", 64).select("vec_id")


@query("SELECT user_id, event_id, lag(event_id) OVER w AS prev_event_id, lead(event_id) OVER w AS next_event_id FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)")
def timeline_chain(spark, d):
    e = table(spark, d, "events").withColumnRenamed("ts", "created_at")
    return assign.chain(e, "user_id").select("user_id", "event_id", "prev_event_id", "next_event_id")


@query("""WITH o AS (SELECT * FROM events WHERE event_id % 20 <> 0), n AS (SELECT * FROM events WHERE event_id % 20 = 0)
SELECT n.user_id AS topic_id, n.event_id, arg_max(o.event_id, (o.ts, o.event_id)) FILTER (WHERE (o.ts, o.event_id) < (n.ts, n.event_id)) AS prev_event_id, arg_min(o.event_id, (o.ts, o.event_id)) FILTER (WHERE (o.ts, o.event_id) > (n.ts, n.event_id)) AS next_event_id
FROM n LEFT JOIN o ON o.user_id = n.user_id GROUP BY 1, 2""")
def late_insert_chain(spark, d):
    e = table(spark, d, "events").select(F.col("user_id").alias("topic_id"), F.col("ts").alias("created_at"), "event_id")
    return assign.insert_position(e.where("event_id % 20 <> 0"), e.where("event_id % 20 = 0"))


@query("""WITH l AS (SELECT l_orderkey, list_sort(list(DISTINCT l_partkey)) AS ids FROM lineitem GROUP BY 1), e AS (SELECT o_custkey, o_orderkey, COALESCE(array_to_string(ids, ','), '') AS ids FROM orders LEFT JOIN l ON l_orderkey = o_orderkey)
SELECT c_custkey AS topic_id, COALESCE(string_agg(CAST(o_orderkey AS VARCHAR) || ':' || ids, ';' ORDER BY o_orderkey), '') AS events FROM customer LEFT JOIN e ON o_custkey = c_custkey GROUP BY 1""")
def nested_snapshot(spark, d):
    c, o, l = (table(spark, d, t) for t in ("customer", "orders", "lineitem"))
    out = hierarchy.snapshot(
        c.select(F.col("c_custkey").alias("topic_id"), F.col("c_name").alias("title")),
        o.select(F.col("o_orderkey").alias("event_id"), F.col("o_custkey").alias("topic_id"), F.col("o_orderpriority").alias("title")),
        l.select(F.col("l_orderkey").alias("event_id"), F.col("l_partkey").alias("article_id")),
        min_event=-1,
    )
    flat = F.transform("events", lambda e: F.concat(e["event_id"].cast("string"), F.lit(":"), F.array_join(F.transform(e["article_ids"], lambda a: a.cast("string")), ",")))
    return out.select("topic_id", F.array_join(flat, ";").alias("events"))


@query("SELECT l_partkey AS item, max(l_orderkey) AS cluster FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders) GROUP BY 1")
def snapshot_cluster_map(spark, d):
    o, l = table(spark, d, "orders"), table(spark, d, "lineitem")
    snap = hierarchy.snapshot(o.select((F.col("o_custkey") % 10).alias("topic_id")).distinct().withColumn("title", F.lit("t")), o.select(F.col("o_orderkey").alias("event_id"), (F.col("o_custkey") % 10).alias("topic_id"), F.lit("e").alias("title")), l.select(F.col("l_orderkey").alias("event_id"), F.col("l_partkey").alias("article_id")), min_event=-1)
    return hierarchy.cluster_map(snap)


@query("""WITH n AS (SELECT c_custkey, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1)
SELECT 'R-E1' AS "check", CAST(count(*) AS BIGINT) AS total, CAST(count(*) FILTER (WHERE n = 1) AS BIGINT) AS violations, round(count(*) FILTER (WHERE n = 1) / count(*), 6) AS ratio FROM n
UNION ALL SELECT 'R-E0', CAST(count(*) AS BIGINT), CAST(count(*) FILTER (WHERE n = 0) AS BIGINT), round(count(*) FILTER (WHERE n = 0) / count(*), 6) FROM n""")
def rubric_single_member(spark, d):
    n = review.member_counts(table(spark, d, "customer"), table(spark, d, "orders").withColumnRenamed("o_custkey", "c_custkey"), "c_custkey")
    return review.check(n, "R-E1", F.col("n") == 1).unionByName(review.check(n, "R-E0", F.col("n") == 0)).withColumn("ratio", F.round("ratio", 6))


@query("""WITH n AS (SELECT o_orderkey, count(l_linenumber) AS n FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1) SELECT CASE WHEN n = 0 THEN 'none' WHEN n = 1 THEN 'single' ELSE 'multi' END AS kind, CAST(count(*) AS BIGINT) AS n FROM n GROUP BY 1""")
def member_classes(spark, d):
    from strata.functions.text import member_class

    n = review.member_counts(table(spark, d, "orders"), table(spark, d, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey")
    return n.groupBy(member_class(F.col("n")).alias("kind")).agg(F.count("*").alias("n"))


_TITLES = "t AS (SELECT CASE p_partkey % 6 WHEN 0 THEN p_name || ' 3일차' WHEN 1 THEN '첫째 날 ' || p_name WHEN 2 THEN '반대 여론 ' || p_name WHEN 3 THEN '부정선거 ' || p_name WHEN 4 THEN '경제 뉴스' ELSE p_name END AS title FROM part)"


@query(f"""WITH {_TITLES}, c AS (SELECT 'R-S2' AS "check", regexp_matches(title, '(첫째|둘째|셋째|넷째|다섯째|여섯째|일곱째|여덟째|아홉째|열째)\\s*(날|일)|[0-9]+\\s*(일차|일째|주차|차)($|[^\\p{{L}}\\p{{N}}_])') AS v FROM t
UNION ALL SELECT 'R-S3', regexp_matches(title, '(^|\\s)(찬성|반대|긍정|부정|옹호|비판)(측|파|론|층|여론|입장|쪽|적)?($|\\s)') FROM t UNION ALL SELECT 'R-T2', regexp_matches(trim(title), '^(정치|경제|사회|국제|문화|스포츠|IT|연예)\\s*(뉴스|소식|이슈|전체|종합)?$') FROM t)
SELECT "check", CAST(count(*) AS BIGINT) AS total, CAST(count(*) FILTER (WHERE v) AS BIGINT) AS violations, round(count(*) FILTER (WHERE v) / count(*), 6) AS ratio FROM c GROUP BY 1""")
def rubric_title_patterns(spark, d):
    p, k = table(spark, d, "part"), F.col("p_partkey") % 6
    n = F.col("p_name")
    t = p.select(F.when(k == 0, F.concat(n, F.lit(" 3일차"))).when(k == 1, F.concat(F.lit("첫째 날 "), n)).when(k == 2, F.concat(F.lit("반대 여론 "), n)).when(k == 3, F.concat(F.lit("부정선거 "), n)).when(k == 4, "경제 뉴스").otherwise(n).alias("title"))
    return review.title_checks(t, t).withColumn("ratio", F.round("ratio", 6))


_SCORED = "s AS (SELECT user_id AS cluster, count(*) AS size, count(CASE WHEN event_id % 3 <> 0 THEN value END) AS known, count(*) FILTER (WHERE event_id % 3 <> 0 AND value >= 60) AS weak_count, max(CASE WHEN event_id % 3 <> 0 THEN value END) AS max_distance FROM events GROUP BY 1)"


@query(f"""WITH {_SCORED}, p AS (SELECT * FROM s WHERE size >= 2), t AS (SELECT * FROM p WHERE weak_count > 0 ORDER BY weak_count DESC, max_distance DESC NULLS LAST, size DESC, cluster LIMIT 20), c AS (SELECT * FROM p WHERE cluster NOT IN (SELECT cluster FROM t) ORDER BY md5('7|' || CAST(cluster AS VARCHAR)), cluster LIMIT 5)
SELECT cluster, 'targeted' AS selection FROM t UNION ALL SELECT cluster, 'control' FROM c""")
def worklist_sample(spark, d):
    e = table(spark, d, "events").select(F.col("user_id").alias("cluster"), F.col("event_id").alias("item"), F.when(F.col("event_id") % 3 != 0, F.col("value")).alias("distance"))
    return review.sample(review.suspicion(e, 60.0), 20, 5, "7").select("cluster", "selection")


_ITEMS = "it AS (SELECT l_orderkey AS id, list_sort(list(DISTINCT l_partkey)) AS members, CASE l_orderkey % 4 WHEN 0 THEN 'correct' WHEN 1 THEN 'exclude' WHEN 2 THEN 'unsure' END AS verdict, min(l_partkey) AS out FROM lineitem GROUP BY 1)"
_VP = "vp AS (SELECT DISTINCT CASE WHEN verdict = 'exclude' AND (x = out OR y = out) THEN 'cannot' ELSE 'must' END AS kind, x AS a, y AS b FROM (SELECT *, unnest(members) AS y FROM (SELECT *, unnest(members) AS x FROM it WHERE verdict IN ('correct', 'exclude'))) WHERE x < y)"


def _items(spark, d):
    k = F.col("id") % 4
    rows = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.array_sort(F.collect_set("l_partkey")).alias("members"), F.array(F.min("l_partkey")).alias("excluded"))
    return rows.withColumn("verdict", F.when(k == 0, "correct").when(k == 1, "exclude").when(k == 2, "unsure"))


@query(f"WITH {_ITEMS}, {_VP} SELECT kind, a, b FROM vp")
def verdict_pairs(spark, d):
    return review.verdict_pairs(_items(spark, d))


@query(f"""WITH {_ITEMS}, {_VP}, al AS (SELECT kind, a, b FROM vp UNION SELECT 'must', p_partkey, p_partkey + 1 FROM part), g AS (SELECT a, b, list_sort(list(DISTINCT kind)) AS k FROM al GROUP BY 1, 2) SELECT a, b, k[1] AS kind, len(k) > 1 AS conflict FROM g""")
def merge_constraints(spark, d):
    old = table(spark, d, "part").select(F.lit("must").alias("kind"), (F.col("p_partkey") + 1).alias("a"), F.col("p_partkey").alias("b"))
    return review.merge_constraints(old, review.verdict_pairs(_items(spark, d)))


@query(f"WITH {_ITEMS} SELECT COALESCE(verdict, '(unfilled)') AS verdict, CAST(count(*) AS BIGINT) AS n FROM it GROUP BY 1")
def verdict_counts(spark, d):
    return review.verdict_counts(_items(spark, d))


@query("""SELECT doc_id, CAST(length(trim(text, ' ')) AS INTEGER) AS n FROM documents WHERE length(trim(text, ' ')) > 700 OR length(trim(text, ' ')) < 80""")
def backfill_targets(spark, d):
    return review.backfill_targets(table(spark, d, "documents"), "text").select("doc_id", "n")


@query("""SELECT 'both' AS part, CAST(count(*) AS BIGINT) AS n FROM (SELECT c_custkey FROM customer INTERSECT SELECT o_custkey FROM orders) UNION ALL SELECT 'only_left', CAST(count(*) AS BIGINT) FROM (SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders)
UNION ALL SELECT 'any', CAST(count(*) AS BIGINT) FROM (SELECT c_custkey FROM customer UNION SELECT o_custkey FROM orders) UNION ALL SELECT 'symmetric', CAST(count(*) AS BIGINT) FROM ((SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders) UNION ALL (SELECT o_custkey FROM orders EXCEPT SELECT c_custkey FROM customer))""")
def set_operations(spark, d):
    a, b = table(spark, d, "customer").select("c_custkey"), table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"))
    parts = {"both": a.intersect(b), "only_left": a.subtract(b), "any": a.union(b).distinct(), "symmetric": a.exceptAll(b.distinct()).union(b.distinct().exceptAll(a))}
    out = None
    for name, rows in parts.items():
        one = rows.agg(F.count("*").alias("n")).select(F.lit(name).alias("part"), "n")
        out = one if out is None else out.unionByName(one)
    return out


@query("""SELECT o_orderpriority AS title, CAST(count(*) AS BIGINT) AS copies FROM orders o WHERE EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_returnflag = 'R') GROUP BY 1 HAVING count(*) >= 2""")
def exists_filter(spark, d):
    o, l = table(spark, d, "orders"), table(spark, d, "lineitem").where("l_returnflag = 'R'")
    return o.join(l, F.col("l_orderkey") == F.col("o_orderkey"), "left_semi").groupBy(F.col("o_orderpriority").alias("title")).agg(F.count("*").alias("copies")).where("copies >= 2")


@query("""SELECT c_custkey AS topic_id, CAST(count(*) AS BIGINT) AS members FROM customer JOIN orders ON o_custkey = c_custkey OR o_custkey = -c_custkey GROUP BY 1""")
def or_join_as_equi(spark, d):
    """A child hangs on its parent or is the parent itself: one equi-join on the parent's id, else its own."""
    c, o = table(spark, d, "customer"), table(spark, d, "orders")
    rows = o.select(F.abs("o_custkey").alias("k"))
    return c.join(rows, F.col("c_custkey") == F.col("k")).groupBy(F.col("c_custkey").alias("topic_id")).agg(F.count("*").alias("members"))
