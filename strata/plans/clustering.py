"""Grouping, membership and alignment queries."""

from pyspark.sql import functions as F

from strata.operators import components, grouping
from strata.plans.registry import query, table


@query("""WITH e AS (SELECT a.label AS topic, a.vec_id AS x, b.vec_id AS y FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id < b.vec_id WHERE list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) >= 0.25),
bi AS (SELECT x AS a, y AS b FROM e UNION SELECT y, x FROM e), reach AS (WITH RECURSIVE r(item, m) AS (SELECT a, a FROM bi UNION SELECT r.item, bi.b FROM r JOIN bi ON bi.a = r.m) SELECT item, min(m) AS cluster FROM r GROUP BY 1)
SELECT CAST(label AS INTEGER) AS topic, vec_id AS label_id, COALESCE(cluster, vec_id) AS cluster FROM embeddings LEFT JOIN reach ON item = vec_id""")
def label_clusters(spark, d):
    e = table(spark, d, "embeddings").select(F.col("label").alias("topic"), F.col("vec_id").alias("label_id"), F.col("embedding").alias("vector"))
    return grouping.label_clusters(e, 0.25)


@query()
def average_linkage(spark, d):
    """Average-linkage clusters inside each label block."""
    e = table(spark, d, "embeddings").select(F.col("label").cast("long").alias("block"), F.col("vec_id").alias("item"), F.col("embedding").alias("vector"))
    return grouping.cluster_blocks(e, 0.1, 20)


_LINKS = "lk AS (SELECT DISTINCT l_suppkey % 10 AS topic, 'n' || CAST(l_quantity::INTEGER % 12 AS VARCHAR) AS name, l_partkey % 200 AS item FROM lineitem WHERE l_orderkey % 2 = 0), va AS (SELECT DISTINCT l_suppkey % 10 AS topic, l_partkey % 200 AS item FROM lineitem)"


def _links(spark, d):
    l = table(spark, d, "lineitem")
    topic, item = (F.col("l_suppkey") % 10).alias("topic"), (F.col("l_partkey") % 200).alias("item")
    return l.select(topic, item).distinct(), l.where("l_orderkey % 2 = 0").select(topic, F.concat(F.lit("n"), (F.col("l_quantity").cast("int") % 12).cast("string")).alias("name"), item).distinct()


@query(f"""WITH {_LINKS}, it AS (SELECT topic, count(*) AS items FROM va GROUP BY 1), h AS (SELECT topic, item, count(*) AS k FROM lk GROUP BY 1, 2), hh AS (SELECT topic, count(*) FILTER (WHERE k > 1) AS multi_home, count(*) AS housed, sum(k) AS links FROM h GROUP BY 1),
s AS (SELECT topic, name, count(*) AS size FROM lk GROUP BY 1, 2), w AS (SELECT s.topic, count(*) AS groups, max(size) AS widest, count(*) FILTER (WHERE size / items >= 0.6) AS wide, count(*) FILTER (WHERE size = 1) AS singles FROM s JOIN it ON it.topic = s.topic GROUP BY 1),
sh AS (SELECT x.topic, x.name, y.name AS other, count(*) AS n FROM lk x JOIN lk y ON x.topic = y.topic AND x.item = y.item AND x.name <> y.name GROUP BY 1, 2, 3), ns AS (SELECT sh.topic, count(DISTINCT sh.name) AS nested FROM sh JOIN s a ON a.topic = sh.topic AND a.name = sh.name JOIN s b ON b.topic = sh.topic AND b.name = other WHERE sh.n = a.size AND b.size > a.size GROUP BY 1)
SELECT it.topic, CAST(items AS BIGINT) AS items, CAST(COALESCE(multi_home, 0) AS BIGINT) AS multi_home, CAST(COALESCE(links, 0) AS BIGINT) AS links, CAST(COALESCE(groups, 0) AS BIGINT) AS groups, CAST(COALESCE(widest, 0) AS BIGINT) AS widest, CAST(COALESCE(wide, 0) AS BIGINT) AS wide, CAST(COALESCE(singles, 0) AS BIGINT) AS singles, CAST(COALESCE(nested, 0) AS BIGINT) AS nested, CAST(items - COALESCE(housed, 0) AS BIGINT) AS standalone
FROM it LEFT JOIN hh USING (topic) LEFT JOIN w USING (topic) LEFT JOIN ns USING (topic)""")
def membership_measures(spark, d):
    return grouping.measures(*_links(spark, d))


@query(f"WITH {_LINKS} SELECT topic, item FROM va EXCEPT SELECT topic, item FROM lk")
def standalone_items(spark, d):
    return grouping.standalone(*_links(spark, d))


_RIGHT = "rk AS (SELECT DISTINCT l_suppkey % 10 AS topic, 'm' || CAST(l_quantity::INTEGER % 9 AS VARCHAR) AS name, l_partkey % 200 AS item FROM lineitem WHERE l_orderkey % 2 = 1)"
_JAC = "j AS (SELECT a.topic, a.name AS a, b.name AS b, count(*) AS both_n FROM lk a JOIN rk b ON a.topic = b.topic AND a.item = b.item GROUP BY 1, 2, 3), na AS (SELECT topic, name, count(*) AS n FROM lk GROUP BY 1, 2), nb AS (SELECT topic, name, count(*) AS n FROM rk GROUP BY 1, 2), jj AS (SELECT j.topic, a, b, both_n / (na.n + nb.n - both_n) AS jaccard FROM j JOIN na ON na.topic = j.topic AND na.name = a JOIN nb ON nb.topic = j.topic AND nb.name = b)"


def _right(spark, d):
    return table(spark, d, "lineitem").where("l_orderkey % 2 = 1").select((F.col("l_suppkey") % 10).alias("topic"), F.concat(F.lit("m"), (F.col("l_quantity").cast("int") % 9).cast("string")).alias("name"), (F.col("l_partkey") % 200).alias("item"))


@query(f"WITH {_LINKS}, {_RIGHT}, {_JAC} SELECT topic, a, b, round(jaccard, 6) AS jaccard FROM jj")
def group_jaccard(spark, d):
    return grouping.jaccards(_links(spark, d)[1], _right(spark, d)).withColumn("jaccard", F.round("jaccard", 6))


@query(f"""WITH {_LINKS}, {_RIGHT}, {_JAC}, f AS (SELECT na.topic, avg(COALESCE(m, 0)) AS x FROM na LEFT JOIN (SELECT topic, a, max(jaccard) AS m FROM jj GROUP BY 1, 2) q ON q.topic = na.topic AND q.a = na.name GROUP BY 1), g AS (SELECT nb.topic, avg(COALESCE(m, 0)) AS y FROM nb LEFT JOIN (SELECT topic, b, max(jaccard) AS m FROM jj GROUP BY 1, 2) q ON q.topic = nb.topic AND q.b = nb.name GROUP BY 1)
SELECT topic, round((x + y) / 2, 3) AS alignment FROM f JOIN g USING (topic)""")
def grouping_alignment(spark, d):
    return grouping.alignment(_links(spark, d)[1], _right(spark, d))


_GROUPS = "gr AS (SELECT o_custkey % 20 AS topic, o_orderkey AS pos, CASE o_orderkey % 9 WHEN 0 THEN '  ' WHEN 1 THEN NULL ELSE ' name' || CAST(o_orderkey % 30 AS VARCHAR) || ' ' END AS name, [o_orderkey % 50, o_orderkey % 70, 60] AS members FROM orders), vd AS (SELECT t AS topic, i AS item FROM range(20) x(t), range(55) y(i))"


@query(f"""WITH {_GROUPS}, f AS (SELECT *, trim(name) AS nm, row_number() OVER (PARTITION BY topic, trim(name) ORDER BY pos) AS rn FROM gr WHERE trim(COALESCE(name, '')) <> ''), r AS (SELECT DISTINCT topic, pos, nm, m FROM (SELECT topic, pos, nm, unnest(members) AS m FROM f WHERE rn = 1) WHERE m < 55)
SELECT topic, pos, nm AS name, array_to_string(list_sort(list(m)), ',') AS members FROM r GROUP BY 1, 2, 3""")
def membership_validation(spark, d):
    o, k = table(spark, d, "orders"), F.col("o_orderkey")
    name = F.when(k % 9 == 0, "  ").when(k % 9 == 1, F.lit(None)).otherwise(F.concat(F.lit(" name"), (k % 30).cast("string"), F.lit(" ")))
    groups = o.select((F.col("o_custkey") % 20).alias("topic"), k.alias("pos"), name.alias("name"), F.array(k % 50, k % 70, F.lit(60).cast("long")).alias("members"))
    valid = spark.range(20).select(F.col("id").alias("topic"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(54).cast("long"))).alias("item"))
    return grouping.validate(groups, valid).withColumn("members", F.array_join(F.transform("members", lambda m: m.cast("string")), ","))


@query(f"WITH {_LINKS}, {_RIGHT} SELECT topic, name, CAST(count(*) AS BIGINT) AS members FROM (SELECT * FROM lk UNION SELECT topic, replace(name, 'm', 'n') AS name, item FROM rk) GROUP BY 1, 2")
def incremental_application(spark, d):
    steps = _right(spark, d).withColumn("name", F.replace("name", F.lit("m"), F.lit("n")))
    return grouping.apply_increments(_links(spark, d)[1], steps).groupBy("topic", "name").agg(F.count("*").alias("members"))


@query("""WITH o AS (SELECT p_size % 10 AS topic, p_brand AS name, min(p_partkey) AS group_id FROM part WHERE p_partkey % 3 <> 0 GROUP BY 1, 2), n AS (SELECT DISTINCT p_size % 10 AS topic, p_brand AS name FROM part WHERE p_partkey % 3 <> 1)
SELECT topic, name, group_id, CASE WHEN n.name IS NULL THEN 'delete' WHEN o.name IS NULL THEN 'insert' ELSE 'keep' END AS action FROM (SELECT topic, name, name AS k FROM o UNION SELECT topic, name, name FROM n) a LEFT JOIN (SELECT topic, name, group_id FROM o) o USING (topic, name) LEFT JOIN n USING (topic, name)""")
def name_keyed_upsert(spark, d):
    p = table(spark, d, "part").select((F.col("p_size") % 10).alias("topic"), F.col("p_brand").alias("name"), "p_partkey")
    old = p.where("p_partkey % 3 <> 0").groupBy("topic", "name").agg(F.min("p_partkey").alias("group_id"))
    return grouping.upsert_by_name(old, p.where("p_partkey % 3 <> 1"))


@query("""WITH e AS (SELECT DISTINCT l_partkey AS a, l_suppkey + 1000000 AS b FROM lineitem), bi AS (SELECT a, b FROM e UNION SELECT b, a FROM e), r AS (WITH RECURSIVE w(item, m) AS (SELECT a, a FROM bi UNION SELECT w.item, bi.b FROM w JOIN bi ON bi.a = w.m) SELECT item, min(m) AS component FROM w GROUP BY 1)
SELECT component, CAST(count(*) AS BIGINT) AS members FROM r GROUP BY 1""")
def graph_components(spark, d):
    l = table(spark, d, "lineitem")
    pairs = l.select(F.col("l_partkey").alias("a"), (F.col("l_suppkey") + 1000000).alias("b"))
    return components.components(pairs).groupBy("component").agg(F.count("*").alias("members"))
