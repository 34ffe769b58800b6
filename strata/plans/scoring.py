"""Clustering metrics, constraints and hierarchy queries."""

from pyspark.sql import functions as F

from strata.operators import constraints, hierarchy, metrics, review, runs
from strata.plans.registry import query, table

_L = "l AS (SELECT c_custkey AS item, CASE WHEN c_custkey % 11 <> 0 THEN 'p' || CAST((c_nationkey + c_custkey % 3) % 13 AS VARCHAR) END AS pred, CASE WHEN c_custkey % 17 <> 0 THEN 'g' || CAST(c_nationkey AS VARCHAR) END AS gold FROM customer)"


def _labels(spark, d):
    """Customers: gold is the nation, the prediction mixes nations; some lack either."""
    c, k = table(spark, d, "customer"), F.col("c_custkey")
    pred = F.when(k % 11 != 0, F.concat(F.lit("p"), ((F.col("c_nationkey") + k % 3) % 13).cast("string")))
    return c.select(k.alias("item"), pred.alias("pred"), F.when(k % 17 != 0, F.concat(F.lit("g"), F.col("c_nationkey").cast("string"))).alias("gold"))


_CELLS = "c AS (SELECT pred, gold, count(*) AS n FROM {src} WHERE pred IS NOT NULL AND gold IS NOT NULL GROUP BY 1, 2), m AS (SELECT *, sum(n) OVER (PARTITION BY pred) AS a, sum(n) OVER (PARTITION BY gold) AS b, sum(n) OVER () AS t FROM c)"
_MISS = "w AS (SELECT item, COALESCE(pred, '__missing_' || CAST(item AS VARCHAR)) AS pred, gold FROM l WHERE gold IS NOT NULL)"
_B3 = "SELECT sum(n * n / a) / sum(n) AS p, sum(n * n / b) / sum(n) AS r FROM m"
_ARI = "SELECT (s - sp * sg / tot) / ((sp + sg) / 2 - sp * sg / tot) AS ari FROM (SELECT sum(n * (n - 1) / 2) AS s, max(t) * (max(t) - 1) / 2 AS tot FROM m), (SELECT sum(a * (a - 1) / 2) AS sp FROM (SELECT DISTINCT pred, a FROM m)), (SELECT sum(b * (b - 1) / 2) AS sg FROM (SELECT DISTINCT gold, b FROM m))"
_INF = "SELECT mi, hp, hg, 2 * mi / (hp + hg) AS nmi, 1 - hgp / hg AS h, 1 - hpg / hp AS c FROM (SELECT sum(n / t * ln(n * t / (a * b))) AS mi, -sum(n / t * ln(a / t)) AS hp, -sum(n / t * ln(b / t)) AS hg, -sum(n / t * ln(n / a)) AS hgp, -sum(n / t * ln(n / b)) AS hpg FROM m)"


@query(f"WITH {_L} SELECT pred, gold, CAST(count(*) AS BIGINT) AS n FROM l WHERE pred IS NOT NULL AND gold IS NOT NULL GROUP BY 1, 2")
def cluster_contingency(spark, d):
    return metrics.contingency(_labels(spark, d))


@query(f"WITH {_L}, {_CELLS.format(src='l')}, x AS ({_B3}) SELECT round(p, 6) AS precision, round(r, 6) AS recall, round(2 * p * r / (p + r), 6) AS f1 FROM x")
def bcubed(spark, d):
    return metrics.b_cubed(_labels(spark, d)).select(*[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")])


@query(f"WITH {_L}, {_CELLS.format(src='l')} SELECT round(ari, 6) AS ari FROM ({_ARI})")
def ari(spark, d):
    return metrics.adjusted_rand(_labels(spark, d)).select(F.round("ari", 6).alias("ari"))


@query(f"WITH {_L}, {_CELLS.format(src='l')} SELECT round(mi, 6) AS mi, round(hp, 6) AS h_pred, round(hg, 6) AS h_gold, round(nmi, 6) AS nmi, round(h, 6) AS homogeneity, round(c, 6) AS completeness, round(2 * h * c / (h + c), 6) AS v_measure FROM ({_INF})")
def nmi_vmeasure(spark, d):
    x = metrics.information(_labels(spark, d))
    return x.select(*[F.round(c, 6).alias(c) for c in ("mi", "h_pred", "h_gold", "nmi", "homogeneity", "completeness", "v_measure")])


@query(f"""WITH {_L}, {_MISS}, {_CELLS.format(src='w')}, p AS (SELECT pred, sum(n) AS size, count(*) AS k, min(gold) AS only_gold FROM c GROUP BY 1), g AS (SELECT gold, count(*) AS k FROM c GROUP BY 1),
u AS (SELECT only_gold, count(*) AS k FROM p WHERE p.k = 1 GROUP BY 1)
SELECT CAST(count(*) AS BIGINT) AS clusters, CAST(count(*) FILTER (WHERE size = 1) AS BIGINT) AS singletons, CAST(count(*) FILTER (WHERE k > 1) AS BIGINT) AS over_merge, (SELECT CAST(count(*) FILTER (WHERE k > 1) AS BIGINT) FROM g) AS over_split,
(SELECT CAST(COALESCE(sum(k - 1) FILTER (WHERE k > 1), 0) AS BIGINT) FROM u) AS duplicate_pred, round(count(*) FILTER (WHERE size = 1) / count(*), 6) AS singleton_rate FROM p""")
def cluster_diagnostics(spark, d):
    x = metrics.diagnostics(metrics.with_missing(_labels(spark, d)))
    return x.select("clusters", "singletons", "over_merge", "over_split", "duplicate_pred", F.round("singleton_rate", 6).alias("singleton_rate"))


@query(f"""WITH {_L}, {_MISS}, {_CELLS.format(src='w')}, b AS ({_B3}), a AS ({_ARI}), i AS ({_INF}), v AS (SELECT count(*) AS gold_items, count(pred) AS covered FROM l WHERE gold IS NOT NULL)
SELECT CAST(gold_items AS BIGINT) AS gold_items, CAST(covered AS BIGINT) AS covered, round(covered / gold_items, 6) AS coverage, round(p, 6) AS precision, round(r, 6) AS recall, round(2 * p * r / (p + r), 6) AS f1, round(ari, 6) AS ari, round(nmi, 6) AS nmi, round(2 * h * c / (h + c), 6) AS v_measure FROM v, b, a, i""")
def evaluate_level(spark, d):
    x = metrics.evaluate_level(_labels(spark, d))
    return x.select("gold_items", "covered", *[F.round(c, 6).alias(c) for c in ("coverage", "precision", "recall", "f1", "ari", "nmi", "v_measure")])


@query(f"WITH {_L}, {_CELLS.format(src='l')}, x AS ({_B3}) SELECT round(p, 6) AS covered_precision, round(r, 6) AS covered_recall, round(2 * p * r / (p + r), 6) AS covered_f1 FROM x")
def covered_only(spark, d):
    return metrics.evaluate_level(_labels(spark, d)).select(*[F.round(c, 6).alias(c) for c in ("covered_precision", "covered_recall", "covered_f1")])


@query(f"WITH {_L} SELECT 1.0::DOUBLE AS precision, 1.0::DOUBLE AS recall, 1.0::DOUBLE AS f1, 1.0::DOUBLE AS ari, 1.0::DOUBLE AS nmi FROM (SELECT count(*) FROM l)")
def oracle_selfcheck(spark, d):
    """Gold as its own prediction scores 1 everywhere."""
    x = metrics.evaluate_level(_labels(spark, d).withColumn("pred", F.col("gold")))
    return x.select(*[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1", "ari", "nmi")])


@query("""WITH c AS (SELECT user_id, event_type, count(*) AS n, min(event_id) AS f FROM events GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, f) AS rn, count(*) OVER (PARTITION BY user_id) AS k FROM c)
SELECT user_id, event_type AS majority, CAST(n AS BIGINT) AS votes, k > 1 AS mixed FROM r WHERE rn = 1""")
def majority_label_first_wins(spark, d):
    return metrics.majority(table(spark, d, "events"), "user_id", "event_type", "event_id")


_TREE = """tree AS (SELECT r_regionkey::BIGINT AS id, NULL::BIGINT AS parent_id FROM region UNION ALL SELECT 100 + n_nationkey, n_regionkey FROM nation UNION ALL SELECT 1000 + c_custkey, CASE WHEN c_custkey % 50 = 0 THEN NULL WHEN c_custkey % 49 = 0 THEN -5 ELSE 100 + c_nationkey END FROM customer)"""


def _tree(spark, d):
    r, n, c = (table(spark, d, t) for t in ("region", "nation", "customer"))
    k = F.col("c_custkey")
    rows = r.select(F.col("r_regionkey").cast("long").alias("id"), F.lit(None).cast("long").alias("parent_id")).unionByName(n.select((F.col("n_nationkey") + 100).cast("long").alias("id"), F.col("n_regionkey").cast("long").alias("parent_id")))
    return rows.unionByName(c.select((k + 1000).alias("id"), F.when(k % 50 == 0, F.lit(None)).when(k % 49 == 0, F.lit(-5)).otherwise(F.col("c_nationkey") + 100).cast("long").alias("parent_id")))


@query(f"""WITH RECURSIVE {_TREE}, w AS (SELECT id, id AS root, parent_id, 1 AS depth FROM tree UNION ALL SELECT w.id, t.id, t.parent_id, w.depth + 1 FROM w JOIN tree t ON t.id = w.parent_id)
SELECT id, arg_max(root, depth) AS root, CAST(max(depth) AS INTEGER) AS depth FROM w GROUP BY 1""")
def hierarchy_root(spark, d):
    return hierarchy.roots(_tree(spark, d))


@query(f"""WITH RECURSIVE {_TREE}, w AS (SELECT id, parent_id, 1 AS depth FROM tree UNION ALL SELECT w.id, t.parent_id, w.depth + 1 FROM w JOIN tree t ON t.id = w.parent_id), q AS (SELECT id, max(depth) AS depth FROM w GROUP BY 1)
SELECT (SELECT CAST(count(*) AS BIGINT) FROM orders WHERE 100 + o_custkey % 30 IN (SELECT parent_id FROM tree)) AS on_inner, CAST(count(*) FILTER (WHERE depth > 2) AS BIGINT) AS too_deep, CAST(count(*) AS BIGINT) AS topics FROM q""")
def rubric_hierarchy(spark, d):
    tree = _tree(spark, d)
    events = table(spark, d, "orders").select((F.col("o_custkey") % 30 + 100).alias("topic_id"))
    return review.hierarchy_check(events, tree, hierarchy.roots(tree))


@query("""WITH e AS (SELECT o_custkey % 40 AS gold_topic, CASE WHEN o_custkey % 40 < 25 THEN o_custkey % 5 ELSE o_orderkey % 5 END AS root FROM orders), g AS (SELECT gold_topic, count(DISTINCT root) AS k, count(*) AS n FROM e GROUP BY 1)
SELECT round(sum(CASE WHEN k = 1 THEN n ELSE 0 END) / sum(n), 6) AS consistency, CAST(sum(n) AS BIGINT) AS events FROM g""")
def hierarchy_consistency(spark, d):
    k = F.col("o_custkey") % 40
    e = table(spark, d, "orders").select(k.alias("gold_topic"), F.when(k < 25, F.col("o_custkey") % 5).otherwise(F.col("o_orderkey") % 5).alias("root"))
    return hierarchy.consistency(e).select(F.round("consistency", 6).alias("consistency"), "events")


_PAIRS = """cl AS (SELECT o_orderkey AS item, o_custkey % 97 AS cluster FROM orders WHERE o_orderkey % 13 <> 0),
pr AS (SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'must' ELSE 'cannot' END AS kind, o_orderkey AS a, CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey + 1 ELSE o_orderkey + 97 END AS b FROM orders),
ev AS (SELECT pr.*, x.cluster AS ca, y.cluster AS cb, CASE WHEN x.cluster IS NULL OR y.cluster IS NULL THEN 'unknown' WHEN (x.cluster = y.cluster) = (kind = 'must') THEN 'satisfied' ELSE 'violated' END AS status FROM pr LEFT JOIN cl x ON x.item = a LEFT JOIN cl y ON y.item = b)"""


def _pairs(spark, d):
    o, k = table(spark, d, "orders"), F.col("o_orderkey")
    clusters = o.where(k % 13 != 0).select(k.alias("item"), (F.col("o_custkey") % 97).alias("cluster"))
    return o.select(F.when(k % 2 == 0, "must").otherwise("cannot").alias("kind"), k.alias("a"), F.when(k % 3 == 0, k + 1).otherwise(k + 97).alias("b")), clusters


_SAT = "SELECT kind, CAST(count(*) AS BIGINT) AS total, CAST(count(*) FILTER (WHERE status = 'satisfied') AS BIGINT) AS satisfied, CAST(count(*) FILTER (WHERE status = 'violated') AS BIGINT) AS violated, CAST(count(*) FILTER (WHERE status = 'unknown') AS BIGINT) AS unknown, round(count(*) FILTER (WHERE status = 'satisfied') / NULLIF(count(*) FILTER (WHERE status <> 'unknown'), 0), 6) AS rate FROM ev GROUP BY 1"


@query(f"WITH {_PAIRS} {_SAT}")
def pair_constraints(spark, d):
    pairs, clusters = _pairs(spark, d)
    out = constraints.satisfaction(constraints.evaluate_pairs(pairs, clusters), ["kind"])
    return out.withColumn("rate", F.round("rate", 6))


@query(f"""WITH {_PAIRS}, c AS ({_SAT}), b AS (SELECT * FROM (VALUES ('must', 0.5::DOUBLE), ('cannot', 0.2::DOUBLE), ('gone', 0.9::DOUBLE)) t(kind, base))
SELECT kind, rate, base, round(rate - base, 6) AS delta, CASE WHEN rate IS NULL OR base IS NULL THEN 'not comparable' WHEN rate - base < -0.01 THEN 'regression' WHEN rate - base > 0.01 THEN 'improved' ELSE 'same' END AS verdict FROM c FULL JOIN b USING (kind)""")
def constraint_baseline_gate(spark, d):
    base = spark.createDataFrame([("must", 0.5), ("cannot", 0.2), ("gone", 0.9)], "kind string, rate double")
    out = constraints.gate(pair_constraints(spark, d), base, tolerance=0.01)
    return out.withColumn("delta", F.round("delta", 6))


_MUST = """ml AS (SELECT p_partkey AS a, p_partkey + p_size AS b FROM part WHERE p_size BETWEEN 1 AND 12 AND p_partkey + p_size <= (SELECT max(p_partkey) FROM part)),
bi AS (SELECT a, b FROM ml UNION SELECT b, a FROM ml), comp AS (SELECT item, min(r) AS component FROM (WITH RECURSIVE reach(item, r) AS (SELECT a, a FROM bi UNION SELECT reach.item, bi.b FROM reach JOIN bi ON bi.a = reach.r) SELECT * FROM reach) GROUP BY 1)"""


def _parts(spark, d):
    p = table(spark, d, "part")
    top = p.agg(F.max("p_partkey").alias("top"))
    must = p.crossJoin(top).where("p_size between 1 and 12 and p_partkey + p_size <= top").select(F.lit("must").alias("kind"), F.col("p_partkey").alias("a"), (F.col("p_partkey") + F.col("p_size")).alias("b"))
    return p, must


@query(f"WITH {_MUST} SELECT item, component FROM comp")
def must_link_components(spark, d):
    return constraints.must_components(_parts(spark, d)[1])


@query(f"WITH {_MUST}, cn AS (SELECT p_partkey AS a, p_partkey + 7 AS b FROM part WHERE p_partkey % 5 = 0) SELECT a, b, x.component FROM cn JOIN comp x ON x.item = a JOIN comp y ON y.item = b WHERE x.component = y.component")
def contradictions(spark, d):
    p, must = _parts(spark, d)
    cannot = p.where("p_partkey % 5 = 0").select(F.lit("cannot").alias("kind"), F.col("p_partkey").alias("a"), (F.col("p_partkey") + 7).alias("b"))
    return constraints.contradictions(cannot, constraints.must_components(must))


_CLP = "cl AS (SELECT p_partkey AS item, p_partkey % 50 AS cluster FROM part)"


@query(f"""WITH {_MUST}, {_CLP}, id AS (SELECT cl.item, COALESCE('gold:' || CAST(component AS VARCHAR), CAST(cluster AS VARCHAR)) AS cluster FROM cl LEFT JOIN comp USING (item))
SELECT CAST(count(*) AS BIGINT) AS total, CAST(count(*) FILTER (WHERE x.cluster = y.cluster) AS BIGINT) AS satisfied FROM ml JOIN id x ON x.item = a JOIN id y ON y.item = b""")
def ideal_assignment(spark, d):
    p, must = _parts(spark, d)
    clusters = p.select(F.col("p_partkey").alias("item"), (F.col("p_partkey") % 50).alias("cluster"))
    best = constraints.ideal(clusters, constraints.must_components(must))
    return constraints.evaluate_pairs(must, best).agg(F.count("*").alias("total"), F.count_if(F.col("status") == "satisfied").alias("satisfied"))


@query(f"""WITH {_MUST}, {_CLP}, c AS (SELECT cluster, component, count(*) AS n FROM cl JOIN comp USING (item) GROUP BY 1, 2)
SELECT (SELECT CAST(count(*) AS BIGINT) FROM (SELECT cluster FROM c GROUP BY 1)) AS clusters, (SELECT CAST(count(*) AS BIGINT) FROM (SELECT cluster FROM c GROUP BY 1 HAVING count(*) > 1)) AS over_merged,
(SELECT CAST(count(*) AS BIGINT) FROM (SELECT component FROM c GROUP BY 1)) AS components, (SELECT CAST(count(*) AS BIGINT) FROM (SELECT component FROM c GROUP BY 1 HAVING count(*) > 1)) AS over_split, (SELECT CAST(sum(n) AS BIGINT) FROM c) AS items""")
def crosstab(spark, d):
    p, must = _parts(spark, d)
    clusters = p.select(F.col("p_partkey").alias("item"), (F.col("p_partkey") % 50).alias("cluster"))
    return constraints.crosstab(clusters, constraints.must_components(must))


@query(f"""WITH {_MUST}, {_CLP}, u AS (SELECT a, b, x.cluster AS ca, y.cluster AS cb FROM ml JOIN cl x ON x.item = a JOIN cl y ON y.item = b), s AS (SELECT a, cb AS near FROM u UNION ALL SELECT b, ca FROM u)
SELECT u.a, b, ca, cb, CAST(count(*) FILTER (WHERE near = cb) AS BIGINT) AS gained, CAST(count(*) FILTER (WHERE near = ca) AS BIGINT) AS lost, CAST(count(*) FILTER (WHERE near = cb) - count(*) FILTER (WHERE near = ca) AS BIGINT) AS net FROM u JOIN s ON s.a = u.a WHERE ca <> cb GROUP BY 1, 2, 3, 4""")
def move_tradeoff(spark, d):
    p, must = _parts(spark, d)
    return constraints.move_tradeoff(must, p.select(F.col("p_partkey").alias("item"), (F.col("p_partkey") % 50).alias("cluster")))


@query("WITH s AS (SELECT o_custkey AS c, count(*) AS size FROM orders GROUP BY 1) SELECT CAST(size AS BIGINT) AS size, CAST(count(*) AS BIGINT) AS clusters FROM s GROUP BY 1")
def cluster_size_histogram(spark, d):
    return constraints.size_histogram(table(spark, d, "orders").select(F.col("o_custkey").alias("cluster")))


@query("""WITH p AS (SELECT p_brand AS block, p_partkey AS a, p_partkey + p_size AS b FROM part), s AS (SELECT block, string_agg(DISTINCT least(a, b) || '-' || greatest(a, b), '|') AS x, list_sort(list(DISTINCT least(a, b) || '-' || greatest(a, b))) AS l, count(*) AS n FROM p GROUP BY 1)
SELECT block, substr(sha1(array_to_string(l, '|')), 1, 12) AS fingerprint, CAST(n AS BIGINT) AS pairs, CASE WHEN n < 100 THEN 'few' ELSE 'ok' END AS warning FROM s""")
def gold_fingerprint(spark, d):
    p = table(spark, d, "part").select(F.col("p_brand").alias("block"), F.col("p_partkey").alias("a"), (F.col("p_partkey") + F.col("p_size")).alias("b"))
    return runs.gold_warnings(runs.fingerprint(p, ["block"]))


_RUNS = """h AS (SELECT CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS seq, strftime(ts, '%Y-%m-%d') AS run, count(*)::DOUBLE AS events, count(*) FILTER (WHERE event_type = 'purchase')::DOUBLE AS must, count(DISTINCT user_id)::DOUBLE AS cannot, count(*) FILTER (WHERE value < 20)::DOUBLE AS singles FROM events GROUP BY 1, 2)"""


def _history(spark, d):
    e = table(spark, d, "events")
    return e.groupBy(F.date_format("ts", "yyyyMMdd").cast("int").alias("seq"), F.date_format("ts", "yyyy-MM-dd").alias("run")).agg(
        F.count("*").cast("double").alias("events"), F.count_if(F.col("event_type") == "purchase").cast("double").alias("must"), F.countDistinct("user_id").cast("double").alias("cannot"), F.count_if(F.col("value") < 20).cast("double").alias("singles")
    )


@query(f"""WITH {_RUNS}, l AS (UNPIVOT (SELECT seq, run, events, must, cannot FROM h) ON events, must, cannot INTO NAME metric VALUE value), p AS (SELECT *, lag(value) OVER (PARTITION BY metric ORDER BY seq) AS previous FROM l)
SELECT seq, run, metric, value, previous, value - previous AS delta, CASE WHEN previous IS NULL THEN 'first' WHEN value = previous THEN 'same' WHEN metric = 'events' THEN 'changed' WHEN value > previous THEN 'better' ELSE 'worse' END AS verdict FROM p""")
def run_history_diff(spark, d):
    return runs.compare_runs(_history(spark, d), {"events": "any", "must": "up", "cannot": "up"})


@query(f"""WITH {_RUNS}, p AS (SELECT *, lag(events) OVER (ORDER BY seq) AS pe, lag(must) OVER (ORDER BY seq) AS pm, lag(cannot) OVER (ORDER BY seq) AS pc FROM h)
SELECT seq, run, array_to_string(list_filter([CASE WHEN singles / events > 0.4 THEN 'fragmented' END, CASE WHEN must > pm AND events < pe * 0.8 THEN 'collapsed' END, CASE WHEN must > pm AND cannot < pc THEN 'over-merged' END], lambda x: x IS NOT NULL), ',') AS warnings FROM p""")
def structural_warnings(spark, d):
    return runs.warnings(_history(spark, d), singles_most=0.4)


@query("""WITH t AS (SELECT * FROM (VALUES ('a', 10.0::DOUBLE), ('b', 50.0::DOUBLE), ('c', 90.0::DOUBLE), ('none', -1.0::DOUBLE)) t(tag, threshold))
SELECT tag, threshold, CAST(count(value) AS BIGINT) AS passed, round(avg(value), 6) AS mean_score FROM t LEFT JOIN events ON value <= threshold GROUP BY 1, 2""")
def param_sweep(spark, d):
    p = spark.createDataFrame([("a", 10.0), ("b", 50.0), ("c", 90.0), ("none", -1.0)], "tag string, threshold double")
    return runs.sweep(table(spark, d, "events"), p, F.col("value")).withColumn("mean_score", F.round("mean_score", 6))


@query("SELECT event_id, event_type, CAST((row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1) // 50 + 1 AS BIGINT) AS pass FROM events")
def drain_batches(spark, d):
    return runs.batches(table(spark, d, "events"), ["ts", "event_id"], 50, "event_type").select("event_id", "event_type", "pass")


@query("""SELECT event_id, TRY_CAST(NULLIF(trim(regexp_extract(props, '"k": *([^}]*)', 1)), '') AS DOUBLE) AS number, CASE WHEN value IS NULL THEN 'N/A' WHEN value BETWEEN 0 AND 1 THEN 'share' ELSE 'plain' END AS kind FROM events""")
def csv_coerce(spark, d):
    e = table(spark, d, "events")
    shown = runs.as_percent(F.col("value"))
    return e.select("event_id", runs.coerce(F.regexp_extract("props", '"k": *([^}]*)', 1)).alias("number"), F.when(shown == "N/A", "N/A").when(shown.endswith("%"), "share").otherwise("plain").alias("kind"))
