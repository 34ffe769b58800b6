"""Hand-computed cases and properties of the operators."""

import difflib
import math
import random
from urllib.parse import urljoin

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.functions import html, similarity, text, vector, web
from strata.operators import assign, candidates, components, constraints, grouping, hierarchy, ingest, metrics, review, runs
from strata.sources import feeds, logs, schema
from strata.streaming import online


def labels(spark, pred, gold):
    items = sorted({*pred, *gold})
    return spark.createDataFrame([(i, pred.get(i), gold.get(i)) for i in items], "item string, pred string, gold string")


PRED, GOLD = {"a": "0", "b": "0", "c": "1"}, {"a": "0", "b": "1", "c": "1"}


def test_metrics_by_hand(spark):
    x = labels(spark, PRED, GOLD)
    b = metrics.b_cubed(x).first()
    assert [round(v, 9) for v in b] == [round(2 / 3, 9)] * 3
    assert metrics.adjusted_rand(x).first()[0] == pytest.approx(-0.5)
    want = ((2 / 3) * math.log(1.5) + (1 / 3) * math.log(0.75)) / ((2 / 3) * math.log(1.5) + (1 / 3) * math.log(3))
    assert metrics.information(x).first()["nmi"] == pytest.approx(want)


def test_metrics_extremes(spark):
    three = labels(spark, {"a": "1", "b": "2", "c": "3"}, {"a": "x", "b": "x", "c": "x"})
    d = metrics.diagnostics(three).first().asDict()
    assert (d["singleton_rate"], d["over_split"], d["duplicate_pred"]) == (1.0, 1, 2)
    merged = metrics.information(labels(spark, {"a": "1", "b": "1", "c": "1"}, {"a": "x", "b": "y", "c": "z"})).first()
    assert (merged["completeness"], merged["homogeneity"], merged["v_measure"]) == (1.0, 0.0, 0.0)
    cover = metrics.evaluate_level(labels(spark, {"a": "1", "b": "1"}, {"a": "x", "b": "x", "c": "x"})).first()
    assert cover["coverage"] == pytest.approx(2 / 3) and cover["f1"] < 1
    empty = labels(spark, {"a": None}, {"a": None})
    assert metrics.b_cubed(empty).first()["f1"] == 0 and metrics.adjusted_rand(empty).first()[0] == 0
    assert metrics.adjusted_rand(labels(spark, {"a": "1"}, {"a": "x"})).first()[0] == 1


def test_components_and_moves(spark):
    got = {r["item"]: r["component"] for r in components.components(spark.createDataFrame([(7, 3), (3, 5), (20, 21)], "a long, b long")).collect()}
    assert got == {3: 3, 5: 3, 7: 3, 20: 20, 21: 20}
    line = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert components.components(line).select("component").distinct().count() == 1
    clusters = spark.createDataFrame([(1, 500), (2, 501), (3, 501)], "item long, cluster long")
    must = spark.createDataFrame([("must", 1, 2), ("must", 1, 3), ("must", 2, 3)], "kind string, a long, b long")
    rows = constraints.move_tradeoff(must, clusters).collect()
    assert len(rows) == 2 and sum(r["gained"] for r in rows) == 4 and sum(r["lost"] for r in rows) == 0
    clusters = spark.createDataFrame([(1, 500), (2, 500), (3, 500), (4, 501)], "item long, cluster long")
    must = spark.createDataFrame([("must", 1, 2), ("must", 1, 3), ("must", 1, 4)], "kind string, a long, b long")
    r = constraints.move_tradeoff(must, clusters).first()
    assert (r["gained"], r["lost"], r["net"]) == (1, 2, -1)


def test_causes(spark):
    c = "candidates array<struct<candidate_id: long, distance: double, shown: boolean>>"
    rows = [(1, 1, [], "create", None, False), (2, 2, [(9, 0.1, True)], "create", None, False), (3, 3, [], "create", None, False), (4, 4, [(9, 0.1, False)], "create", None, False), (5, 5, [(9, 0.1, True)], "assign", 9, True)]
    log = spark.createDataFrame(rows, f"item long, seq long, {c}, action string, target_id long, overridden boolean")
    clusters = spark.createDataFrame([(1, 9), (2, 2), (3, 3), (4, 4), (5, 5), (6, 6)], "item long, cluster long")
    broken = spark.createDataFrame([(1, k) for k in (2, 3, 4, 5, 6)], "a long, b long")
    got = {r["b"]: r["cause"] for r in constraints.violation_causes(broken, log, clusters).collect()}
    assert got == {2: "C", 3: "A", 4: "B", 5: "D", 6: "no-log"}


def test_vectors(spark):
    row = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0], [0.0, 0.0])], "a array<float>, b array<float>, z array<float>")
    got = row.select(vector.cosine_distance(F.col("a"), F.col("b")), vector.cosine_distance(F.col("a"), F.col("z")), vector.norm(vector.normalised(F.col("a"))), F.size(vector.padded(F.col("a"), 5)), vector.literal(F.col("a"))).first()
    assert got[0] == pytest.approx(0.04) and got[1] is None and got[2] == pytest.approx(1) and got[3] == 5 and got[4] == "[3.0,4.0]"
    with pytest.raises(Exception, match="longer"):
        row.select(vector.padded(F.col("a"), 1)).collect()


@pytest.mark.parametrize("block", [1, 4096])
def test_nearest_matches_brute_force(spark, block):
    r = np.random.default_rng(3)
    x = r.normal(size=(60, 8))
    rows = [(i, [float(v) for v in x[i]]) for i in range(60)] + [(60, None)]
    table = spark.createDataFrame(rows, "id long, vector array<float>")
    q, e = table.where("id < 6").withColumn("since", F.lit(0)), table.where("id >= 6").withColumn("until", F.col("id") - 20)
    got = {(r["query_id"], r["event_id"]) for r in candidates.nearest(q, e, 5, 1.2, block).collect()}
    u = x.astype(np.float32).astype(float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    want = set()
    for i in range(6):
        near = sorted((1 - u[i] @ u[j], j) for j in range(20, 60))
        want |= {(i, j) for d, j in near[:5] if d <= 1.2}
    assert got == want


def test_guardrail(spark):
    rows = [(1, 0, "assign", 5, "0.9", "", []), (2, 1, "assign", 5, "0.9", "ok", [5]), (3, 1, "assign", 5, "0.5", "ok", [5]), (4, 1, "assign", 5, "x", "ok", [5]), (5, 1, "assign", 6, "0.9", None, [5]), (6, 1, "merge", 5, "1", "", [5]), (7, 1, "assign", 5, "1", "서로 무관 하다", [5]), (8, 1, "create", None, None, None, [5])]
    d = spark.createDataFrame(rows, "item_id long, candidate_count int, action string, target_id long, score string, reason string, candidate_ids array<long>")
    got = {r["item_id"]: (r["final_action"], r["overridden"]) for r in assign.guarded(d).collect()}
    assert got == {1: ("create", False), 2: ("assign", False), 3: ("create", True), 4: ("create", True), 5: ("error", False), 6: ("error", False), 7: ("create", True), 8: ("create", False)}


def test_nan_never_assigns(spark):
    f = spark.createDataFrame([(1, 1, float("nan")), (1, 2, 0.6), (2, 1, 0.3)], "item_id long, group_id long, similarity double")
    got = {r["item_id"]: (r["group_id"], r["action"]) for r in assign.nearest_group(f).collect()}
    assert got == {1: (2, "assign"), 2: (1, "create")}


def test_text(spark):
    x = spark.createDataFrame([("  a  b.  C d! e? f. g. ", "x" * 130 + " 제보는 카카오톡 저작권자 (c)", "“첫째 날” 회의", None)], "a string, b string, c string, n string")
    got = x.select(text.clean_string(F.col("a")), text.first_sentences(F.col("a"), 2), text.strip_footer(F.col("b")), text.is_time_title(F.col("c")), text.clean_string(F.col("n")), text.normalize_summary(F.col("n")), text.normalize_title(F.lit("'A long title, that goes on and on without an end'")), F.size(text.cleanup_reasons(F.col("n")))).first()
    assert list(got) == ["a b. C d! e? f. g.", "a b. C d!", "x" * 130, True, "", "", "A long title, that goes on", 0]
    assert spark.createDataFrame([("부정선거 논란",), ("반대 여론",)], "t string").select(text.is_attribute_title(F.col("t"))).collect() == [(False,), (True,)]


def test_similarity(spark):
    x = spark.createDataFrame([("tide", "diet"), ("diet", "tide"), (None, None)], "a string, b string")
    got = x.select(similarity.title_similarity("a", "b"), similarity.length_bound(F.col("a"), F.col("b")), similarity.multiset_bound(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in got] == [0.25, 0.5, 1.0]
    assert all(r[0] <= r[1] + 1e-9 and r[0] <= r[2] + 1e-9 for r in got)


PAGE = '<html><head><meta property="og:image" content="/og.jpg"></head><body><nav>menu</nav><div class="ad">buy</div>{}<footer>end</footer></body></html>'


def test_pages():
    long = "word " * 60
    assert html.body(PAGE.format(f"<article><p>{long}</p></article>"))[0] == "scored"
    assert html.body(PAGE.format(f'<div id="articleBody">{long}<div class="share">x</div></div>')) == ("declared", long.strip())
    assert html.body(PAGE.format(f'<div class="news_view">{long}</div>'), "https://www.donga.com/1")[0] == "publisher"
    assert html.body(PAGE.format(f'<div class="news_view">{long}</div>'), "https://notdonga.com/1")[0] == "scored"
    assert html.body(PAGE.format("<p>short</p>")) == ("whole", "short")
    assert html.body(f'<script>Fusion.globalContent={{"content_elements":[{{"type":"text","content":"<b>{long}</b>"}}]}};</script>')[0] == "embedded"
    assert html.image(PAGE.format('<article><img src="/logo.png"><img data-src="a.jpg"></article>'), "https://x.org/n/1") == ("article", "https://x.org/n/a.jpg")
    assert html.image(PAGE.format(""), "https://x.org/n/1") == ("meta", "https://x.org/og.jpg")
    assert html.image(PAGE.format('<article><img src="a.jpg" width="20" height="20"></article>'), "https://x.org/")[0] == "meta"
    assert html.to_text("https://x.org/a") == "" and html.to_text("<p>a<script>b</script> c</p>") == "a c" and html.to_text(None) == ""
    assert html.body(None) == ("empty", "") and html.body("<div><p>unclosed")[1] == "unclosed"


def test_urls(spark):
    bad = ["https://x.org/logo01.png", "https://x.org/a.svg", "https://x.org/reporter/kim.jpg", "https://x.org/white_12.png"]
    good = ["https://x.org/white-house.jpg", "https://x.org/writer-column.jpg", "https://x.org/news/a.jpg"]
    rows = spark.createDataFrame([(u,) for u in bad + good], "u string").select("u", web.unwanted_image(F.col("u"))).collect()
    assert [r[1] for r in rows] == [True] * 4 + [False] * 3 == [html.unwanted(u) for u in bad + good]
    got = spark.range(1).select(web.publisher(F.lit("https://www.hani.co.kr/rss"))["publisher"], web.category(F.lit("x/world/")), web.category(F.lit("x")), web.srcset_first(F.lit(", a.jpg 1x, b.jpg 2x"))).first()
    assert list(got) == ["한겨레", "국제", "사회", "a.jpg"]


def test_intake(spark):
    new = spark.createDataFrame([(1, "g1", "l1"), (2, "g1", "l2"), (3, "g3", "l1"), (4, None, None), (5, "old", "l5"), (6, "g6", "seen")], "id long, guid string, link string")
    old = spark.createDataFrame([("old", "x"), (None, "seen")], "guid string, link string")
    assert sorted(r["id"] for r in ingest.admit(new, old, ["id"]).collect()) == [1, 4]
    jobs = spark.createDataFrame([(1, "pending", None, None), (2, "pending", 2, None), (3, "sent", 0, None)], "article_id long, status string, attempts int, last_error string")
    failed = spark.createDataFrame([(1, "e"), (2, "e")], "article_id long, error string")
    assert sorted(map(tuple, ingest.mark_failed(jobs, failed).collect())) == [(1, "pending", 1, "e"), (2, "failed", 3, "e"), (3, "sent", 0, None)]
    ids = ingest.with_ids(spark.range(100).select((99 - F.col("id")).alias("k")).repartition(7), spark.createDataFrame([(40,)], "id long"), "id", ["k"])
    assert sorted((r["k"], r["id"]) for r in ids.collect()) == [(k, 41 + k) for k in range(100)]
    assert ingest.with_ids(spark.range(0).withColumnRenamed("id", "k"), spark.createDataFrame([(4,)], "id long"), "id", ["k"]).count() == 0
    words = spark.createDataFrame([('["a  b", "", " c "]',), ("plain",), (None,)], "r string").select(ingest.keywords(F.col("r"))).collect()
    assert [r[0] for r in words] == [["a b", "c"], ["plain"], []]
    with pytest.raises(ValueError, match="missing: a.y, b"):
        schema.validate({"a": spark.createDataFrame([(1,)], "x int")}, {"a": {"x", "y"}, "b": {"z"}})


def test_hierarchy(spark):
    nodes = spark.createDataFrame([(1, None), (2, 1), (3, 2), (4, 99), (5, 6), (6, 5)], "id long, parent_id long")
    got = {r["id"]: (r["root"], r["depth"]) for r in hierarchy.roots(nodes).collect()}
    assert got[1] == (1, 1) and got[2] == (1, 2) and got[3] == (1, 3) and got[4] == (4, 1) and got[5][0] in (5, 6)


def test_review(spark):
    items = spark.createDataFrame([(1, [1, 2, 3], "correct", None), (2, [4, 5, 6], "exclude", [6]), (3, [7, 8], "unsure", None)], "id long, members array<long>, verdict string, excluded array<long>")
    got = sorted(map(tuple, review.verdict_pairs(items).collect()))
    assert got == [("cannot", 4, 6), ("cannot", 5, 6), ("must", 1, 2), ("must", 1, 3), ("must", 2, 3), ("must", 4, 5)]
    merged = review.merge_constraints(spark.createDataFrame([("cannot", 2, 1)], "kind string, a long, b long"), review.verdict_pairs(items))
    assert [tuple(r) for r in merged.where("conflict").collect()] == [(1, 2, "cannot", True)]


def test_grouping(spark):
    v = np.array([[1, 0], [0.99, 0.1], [0, 1], [0.1, 0.99]])
    assert grouping.average_linkage(v, 0.5, 10) == [[0, 1], [2, 3]]
    assert grouping.average_linkage(v, 0.5, 1) == [[0], [1], [2], [3]]
    assert grouping.average_linkage(np.zeros((0, 2)), 0.5, 5) == []


def test_runs(spark):
    left = [7]
    assert runs.drain(lambda: left.__setitem__(0, max(0, left[0] - 3)) or 0, lambda: left[0]) == (3, 0, "done")
    assert runs.drain(lambda: 0, lambda: 5) == (1, 5, "no progress")
    assert runs.parse_plan("a:K=1,L=2;b:") == [("a", {"K": "1", "L": "2"}), ("b", {})]
    with pytest.raises(ValueError):
        runs.parse_plan("a:;a:")


def test_sources(spark, tmp_path):
    (tmp_path / "f.json").write_text('﻿{"feeds": ["u1", "u2", "u1"]}', encoding="utf-8")
    assert [r["url"] for r in feeds.feed_list(spark, str(tmp_path / "f.json")).orderBy("pos").collect()] == ["u1", "u2"]
    doc = '<rss><channel><item><title>T</title><link>http://a/1</link><pubDate>Mon, 01 Jan 2024 10:00:00 +0900</pubDate><enclosure url="http://a/i.jpg"/></item></channel></rss>'
    row = feeds.parse_feeds(spark.createDataFrame([("f", doc), ("g", "<broken"), ("h", None)], "feed string, document string")).collect()
    assert len(row) == 1 and (row[0]["guid"], row[0]["published"], row[0]["image"]) == ("http://a/1", "2024-01-01T01:00:00Z", "http://a/i.jpg")
    assert feeds.published("nonsense") == "nonsense" and feeds.published("") is None
    (tmp_path / "log.txt").write_text('start\n{"item_id": 1, "final_action": "create"}\n{bad\n{"item_id": 1, "final_action": "assign"}\n{"other": 2}\n')
    got = logs.parse_lines(logs.scan(spark, str(tmp_path / "log.txt"))).collect()
    assert [(r["item_id"], r["final_action"]) for r in got] == [(1, "create")]


def test_stream_equals_batch(spark, tmp_path):
    r = np.random.default_rng(5)
    rows = [(int(i % 2), int(i), float(i), [float(v) for v in r.normal(size=4)]) for i in range(80)]
    table = spark.createDataFrame(rows, "key long, item long, at double, vector array<float>")
    for k in range(4):
        table.where((F.col("at") >= 20 * k) & (F.col("at") < 20 * k + 20)).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    import os
    import time

    files = sorted((f for f in os.listdir(tmp_path / "in") if f.endswith(".parquet")), key=lambda f: spark.read.parquet(str(tmp_path / "in" / f)).agg(F.min("at")).first()[0])
    for k, f in enumerate(files):
        os.utime(tmp_path / "in" / f, (time.time() - 1000 + k, time.time() - 1000 + k))
    online.drain(online.online_clusters(online.read_table(spark, str(tmp_path / "in")), 30.0, 0.5), str(tmp_path / "out"), str(tmp_path / "cp"))
    got = sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect()))
    assert got == sorted(map(tuple, online.batch_clusters(table, 30.0, 0.5).collect()))


def test_image_urls(spark):
    page = "https://x.org/news/2024/a.html?p=1#top"
    values = ["../b/c.jpg", "./d.jpg", "../../../e.jpg", "?q=1", "#part", "f.jpg?w=2", "/g/../h.jpg", "..", "i/./j/", "//cdn.org/k.jpg", "ftp://x.org/l.jpg", "data:x", None]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, v string").select("i", web.normalize_image_url(F.col("v"), F.lit(page)).alias("u"))
    got = {r["i"]: r["u"] for r in rows.collect()}
    assert [got[i] for i in range(10)] == [urljoin(page, v) for v in values[:10]]
    assert [got[i] for i in range(10, 13)] == ["", "", ""]
    sizes = spark.createDataFrame([("100px", "400", True), ("640", "60px", True), ("640px", "480px", False), ("auto", "10", False), (None, "10", False), ("9" * 40, "10", True)], "w string, h string, small boolean")
    assert sizes.where(web.small_image(F.col("w"), F.col("h")) != F.col("small")).count() == 0


def test_deep_hierarchy(spark):
    """A chain far deeper than any cap, and cycles, whose nodes are their own roots."""
    nodes = [(i, i - 1 if i else None) for i in range(70)] + [(100, 101), (101, 100), (102, 101), (103, 103)]
    got = {r["id"]: (r["root"], r["depth"]) for r in hierarchy.roots(spark.createDataFrame(nodes, "id long, parent_id long")).collect()}
    assert got == {**{i: (0, i + 1) for i in range(70)}, **{i: (i, 1) for i in (100, 101, 102, 103)}}
    assert hierarchy.roots(spark.createDataFrame([], "id long, parent_id long")).count() == 0


def test_targeted_needs_a_weak_member(spark):
    scored = spark.createDataFrame([(1, 3, 2, 0.5), (2, 9, 0, 0.3), (3, 2, 1, 0.6), (4, 2, 0, None), (5, 1, 1, 0.9)], "cluster long, size long, weak_count long, max_distance double")
    got = {r["cluster"]: r["selection"] for r in review.sample(scored, 20, 5).collect()}
    assert got == {1: "targeted", 2: "control", 3: "targeted", 4: "control"}


def test_similar_pairs_by_brute_force(spark):
    r = random.Random(5)
    titles = [(i, f"b{i % 3}", "".join(r.choice("abcd ") for _ in range(r.randint(0, 9)))) for i in range(90)] + [(90, "b0", None), (91, "b0", "")]
    rows = spark.createDataFrame(titles, "id long, bucket string, title string")
    got = {(x["a"], x["b"]): x["similarity"] for x in similarity.similar_pairs(rows, "bucket", "id", "title", 0.7).collect()}
    ratio = lambda x, y: difflib.SequenceMatcher(None, x or "", y or "").ratio()
    assert got == {(a, b): s for a, p, x in titles for b, q, y in titles if a < b and p == q and (s := ratio(x, y)) >= 0.7} and got
    best = {x["id"]: (x["existing_id"], x["similarity"]) for x in similarity.find_duplicate(rows.where("id % 5 = 0"), rows.where("id % 5 <> 0"), "bucket", 0.7).collect()}
    want = {a: max(((s, -b) for b, q, y in titles if b % 5 and p == q and (s := ratio(x, y)) >= 0.7), default=None) for a, p, x in titles if a % 5 == 0}
    assert best == {a: (-k, s) for a, found in want.items() if found for s, k in [found]}


def test_cleanup_reasons(spark):
    rows = spark.createDataFrame([("구독 공유하기  URL 복사 페이스북",), ("Copyright 관련기사 관련 기사",), ("",), (None,), ("a" * 8001,), ("plain",)], "t string")
    got = [x[0] for x in rows.select(text.cleanup_reasons(F.col("t"))).collect()]
    assert got[2:] == [[], [], ["too_long"], []]
    assert got[0] == ["boilerplate_keywords:구독,페이스북,url 복사,공유하기", "strong_boilerplate:url 복사", "share_ui_noise"]
    assert got[1] == ["boilerplate_keywords:관련기사,관련 기사,copyright", "strong_boilerplate:copyright", "repeated_related_articles"]
