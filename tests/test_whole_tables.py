"""Queries take every row of their tables: small fixtures with rows beyond the bounds that queries once had."""

import random
from collections import defaultdict

import duckdb

from strata import plans


def same_as_sql(spark, name, path, *tables):
    """The query's rows, after a check that its SQL gives the same."""
    con = duckdb.connect()
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}/{t}.parquet/*.parquet'")
    got = plans.QUERIES[name](spark, str(path))
    order = sorted(got.columns)
    mine = sorted((tuple(r[c] for c in order) for r in got.collect()), key=repr)
    theirs = sorted(con.execute(f"SELECT {', '.join(order)} FROM ({plans.ORACLE_SQL[name]})").fetchall(), key=repr)
    assert [tuple(map(str, r)) for r in mine] == [tuple(map(str, r)) for r in theirs]
    return [dict(zip(order, r)) for r in mine]


def save(spark, path, table, columns, rows):
    spark.createDataFrame(rows, columns).write.parquet(f"{path}/{table}.parquet")


def groups(nodes, links):
    """Smallest member of each node's component."""
    near, out = defaultdict(set), {}
    for a, b in links:
        near[a].add(b)
        near[b].add(a)
    for start in sorted(nodes):
        todo = [start]
        while todo:
            x = todo.pop()
            if x not in out:
                out[x] = start
                todo += near[x]
    return out


def test_graph_components_take_all_orders(spark, tmp_path):
    r = random.Random(1)
    rows = [(k, r.randrange(1, 60), r.randrange(1, 40)) for k in range(1, 50)]
    save(spark, tmp_path, "lineitem", "l_orderkey long, l_partkey long, l_suppkey long", rows)
    links = [(p, s + 1000000) for _, p, s in rows]
    want = defaultdict(int)
    for c in groups({x for link in links for x in link}, links).values():
        want[c] += 1
    got = same_as_sql(spark, "graph_components", tmp_path, "lineitem")
    assert len(want) > 1 and {x["component"]: x["members"] for x in got} == want


def test_label_clusters_take_all_vectors(spark, tmp_path):
    from pyspark.sql import functions as F

    from strata.operators import grouping

    r = random.Random(2)
    rows = [(k, k % 3, [r.gauss(0, 1) for _ in range(12)]) for k in range(450, 650)]
    save(spark, tmp_path, "embeddings", "vec_id long, label int, embedding array<float>", rows)
    names = {x["label_id"]: x["cluster"] for x in same_as_sql(spark, "label_clusters", tmp_path, "embeddings")}
    assert len(names) == 200
    table = spark.read.parquet(f"{tmp_path}/embeddings.parquet")
    labels = table.select(F.col("label").alias("topic"), F.col("vec_id").alias("label_id"), F.col("embedding").alias("vector"))
    vectors = {x["vec_id"]: (x["label"], x["embedding"]) for x in table.collect()}

    def cosine(x, y):
        dot = lambda p, q: sum(a * b for a, b in zip(p, q))
        return dot(x, y) / (dot(x, x) * dot(y, y)) ** 0.5

    for least in (0.25, 0.6):
        links = [(a, b) for a in vectors for b in vectors if a < b and vectors[a][0] == vectors[b][0] and cosine(vectors[a][1], vectors[b][1]) >= least]
        want = groups(vectors, links)
        if least == 0.25:
            assert names == want
        for block in (7, 1000):
            assert {x["label_id"]: x["cluster"] for x in grouping.label_clusters(labels, least, block).collect()} == want


def test_footer_strip_takes_whole_texts(spark, tmp_path):
    import math
    import re

    from strata.functions import text

    def strip(t):
        m = re.compile(text.FOOTER).search(t, math.floor(len(t) * 0.6))
        if not m:
            return t
        at = re.compile(text.FOOTER).search(t, max(0, m.start() - 150), m.start())
        kept = t[: (at or m).start()].rstrip(" \t\n·-—,")
        return kept if len(kept) >= 100 else t

    long = "a plain sentence of the body. " * 60
    texts = [long, long + "제보는 okjebo <저작권자(c) 연합뉴스, 재배포 금지>", "copyright law. " + long + "- Copyright ⓒ 서울신문 All\trights reserved", "© is a sign. " + long, long + "\nⓒ 매일신문", "short. all rights reserved", "", long[:450] + "기사 문의"]
    rows = [(3 * k + 1, t) for k, t in enumerate(texts)] + [(3 * k, t) for k, t in enumerate(texts)]
    save(spark, tmp_path, "documents", "doc_id long, text string", rows)
    got = {x["doc_id"]: x["body"] for x in same_as_sql(spark, "footer_strip", tmp_path, "documents")}
    assert got == {k: strip(t if k % 3 else t + " — 저작권자 (c) all rights reserved") for k, t in rows}
    assert sum(got[k] != t for k, t in rows if k % 3) == 4


def test_verdicts_take_all_orders(spark, tmp_path):
    r = random.Random(3)
    rows = [(k, r.randrange(1, 30)) for k in range(295, 330) for _ in range(4)]
    save(spark, tmp_path, "lineitem", "l_orderkey long, l_partkey long", rows)
    save(spark, tmp_path, "part", "p_partkey long", [(k,) for k in range(1, 30)])
    want, members = set(), defaultdict(set)
    for k, p in rows:
        members[k].add(p)
    for k, m in members.items():
        if k % 4 < 2:
            want |= {("cannot" if k % 4 == 1 and min(m) == a else "must", a, b) for a in m for b in m if a < b}
    got = same_as_sql(spark, "verdict_pairs", tmp_path, "lineitem")
    assert {(x["kind"], x["a"], x["b"]) for x in got} == want and len(got) == len(want)
    counts = same_as_sql(spark, "verdict_counts", tmp_path, "lineitem")
    assert sum(x["n"] for x in counts) == len(members)
    merged = same_as_sql(spark, "merge_constraints", tmp_path, "lineitem", "part")
    assert len(merged) == len({(a, b) for _, a, b in want} | {(k, k + 1) for k in range(1, 30)})


def test_dummies_and_or_join_take_all_rows(spark, tmp_path):
    from datetime import datetime

    save(spark, tmp_path, "events", "event_id long, ts timestamp_ntz", [(k, datetime(2024, 1, 1)) for k in range(390, 420)])
    got = same_as_sql(spark, "dummy_generator", tmp_path, "events")
    assert len(got) == sum(k % 4 for k in range(390, 420))
    save(spark, tmp_path, "customer", "c_custkey long", [(k,) for k in range(90, 130)])
    save(spark, tmp_path, "orders", "o_custkey long", [(k * (-1) ** (k % 2),) for k in range(95, 140)] * 2)
    got = same_as_sql(spark, "or_join_as_equi", tmp_path, "customer", "orders")
    assert {x["topic_id"]: x["members"] for x in got} == {k: 2 for k in range(95, 130)}


def test_groupings_take_all_orders(spark, tmp_path):
    r = random.Random(4)
    rows = [(k, r.randrange(1, 40), r.randrange(1, 30), r.randrange(1, 50)) for k in range(2, 400) if k % 4 > 1]
    save(spark, tmp_path, "lineitem", "l_orderkey long, l_partkey long, l_suppkey long, l_quantity int", rows)
    side = lambda k, n: {(s % 10, f"{'nm'[k]}{q % n}", p % 200) for o, p, s, q in rows if o % 2 == k}
    left, right = side(0, 12), side(1, 9)
    got = {name: same_as_sql(spark, name, tmp_path, "lineitem") for name in ("membership_measures", "standalone_items", "group_jaccard", "grouping_alignment", "incremental_application")}
    assert sum(x["links"] for x in got["membership_measures"]) == len({(t, n, i) for t, n, i in left})
    assert len(got["standalone_items"]) == len({(s % 10, p % 200) for _, p, s, _ in rows} - {(t, i) for t, _, i in left})
    assert {(x["topic"], x["a"], x["b"]) for x in got["group_jaccard"]} == {(t, n, m) for t, n, i in left for u, m, j in right if (t, i) == (u, j)}
    assert len(got["grouping_alignment"]) == len({t for t, _, _ in left} & {t for t, _, _ in right})
    assert sum(x["members"] for x in got["incremental_application"]) == len(left | {(t, m.replace("m", "n"), i) for t, m, i in right})


NUMBERED = "0 zero 0. 1 one 1. 2 two 2. 3 three 3. 4 four 4. 5 five 5."


def test_first_sentences_keep_their_digits(spark, tmp_path):
    save(spark, tmp_path, "documents", "doc_id long, text string", [(1, NUMBERED), (2, "A. pin 4111"), (3, "A.\n28.6 b. c  "), (4, None)])
    got = {x["doc_id"]: x["head"] for x in same_as_sql(spark, "first_sentences", tmp_path, "documents")}
    assert got == {1: "0 zero 0. 1 one 1. 2 two 2. 3 three 3.", 2: "A. pin 4111", 3: "A. 28.6 b. c", 4: ""}


def test_image_filter_leaves_out_the_host_of_the_page(spark, tmp_path):
    save(spark, tmp_path, "pages", "page_id long, url string", [(k, f"https://m.ads-track.example.com/en/{k}#top") for k in range(10)])
    got = {x["page_id"]: x["unwanted"] for x in same_as_sql(spark, "image_url_filter", tmp_path, "pages")}
    assert got == {k: k in (0, 3, 4, 5, 7) for k in range(10)}


def test_summaries_keep_their_digits(spark, tmp_path):
    long = "1 " + "word " * 40 + "1. 2 " + "more " * 30 + "end 2."
    save(spark, tmp_path, "documents", "doc_id long, text string", [(1, NUMBERED), (2, "A. pin 4111"), (3, "First. " + long)])
    got = {x["doc_id"]: x["summary"] for x in same_as_sql(spark, "normalize_summary", tmp_path, "documents")}
    assert got == {1: "0 zero 0. 1 one 1. 2 two 2. 3 three 3.", 2: "A. pin 4111", 3: "First. 1 " + "word " * 40 + "1."}


def test_titles_are_compared_once_whatever_their_copies(spark, monkeypatch):
    import difflib

    import pandas as pd
    from pyspark.sql import functions as F

    from strata.functions import similarity

    calls = spark.sparkContext.accumulator(0)

    @F.pandas_udf("double")
    def counted(a: pd.Series, b: pd.Series) -> pd.Series:
        calls.add(len(a))
        return pd.Series([difflib.SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b)])

    monkeypatch.setattr(similarity, "title_similarity", counted)
    names = ["old ring", "old rings", "cold ring", "hot plate"]
    rows = [(k, "s", names[k % 4]) for k in range(1, 401)]
    items = spark.createDataFrame(rows, "id long, scope string, title string")
    ratio = {(x, y): difflib.SequenceMatcher(None, x, y).ratio() for x in names for y in names}
    best = {x["id"]: x["existing_id"] for x in similarity.find_duplicate(items.where("id % 10 = 0"), items.where("id % 10 <> 0"), "scope", 0.85).collect()}
    assert best == {a: max((ratio[x, y], -b) for b, _, y in rows if b % 10)[1] * -1 for a, _, x in rows if a % 10 == 0}
    assert calls.value <= 16
    got = {(x["a"], x["b"]): x["similarity"] for x in similarity.similar_pairs(items, "scope", "id", "title", 0.8).collect()}
    assert got == {(a, b): ratio[x, y] for a, _, x in rows for b, _, y in rows if a < b and ratio[x, y] >= 0.8}
    assert calls.value <= 32


def test_length_bound_of_empty_and_missing_names(spark, tmp_path):
    names = ["", "", None, None, "a", "b", "ab", "abcdefghi", "abcdefghij"]
    save(spark, tmp_path, "part", "p_partkey long, p_brand string, p_type string, p_name string", [(k, "x", "y", t) for k, t in enumerate(names)] + [(5, "x", "y", "ab"), (9, None, "y", "a"), (10, "x", "z", "a")])
    assert len(same_as_sql(spark, "similarity_length_bound", tmp_path, "part")) == 4


def test_average_linkage_of_a_large_block(spark):
    import numpy as np

    from strata.operators import grouping

    def greedy(v, least, most_size):
        size = np.linalg.norm(v, axis=1)
        s = v @ v.T / np.outer(size, size)
        parts = [[i] for i in range(len(v))]
        while True:
            pairs = [(-round(s[np.ix_(p, q)].mean(), 12), p[0], q[0], p, q) for i, p in enumerate(parts) for q in parts[i + 1 :] if len(p) + len(q) <= most_size]
            best = min(pairs, default=(-least,))
            if not -best[0] > least:
                return parts
            parts = sorted([p for p in parts if p not in best[3:]] + [sorted(best[3] + best[4])])

    r = np.random.default_rng(7)
    for least, most_size in ((0.1, 5), (0.3, 40), (-2, 7)):
        v = r.normal(size=(40, 6))
        v = np.concatenate([v, v[[3, 3, 3, 8]] + 0])
        assert grouping.average_linkage(v, least, most_size) == greedy(v, least, most_size)
    rows = [(1, k, [float(x) for x in r.normal(size=4)]) for k in range(5100)]
    got = grouping.cluster_blocks(spark.createDataFrame(rows, "block long, item long, vector array<float>"), 0.5, 10).toPandas()
    assert sorted(got["item"]) == list(range(5100)) and got.groupby("cluster").size().max() == 10
    assert (got.groupby("cluster")["item"].min() == got.groupby("cluster")["cluster"].min()).all()


def test_ranked_topics_by_brute_force_without_a_join_of_all_pairs(spark, monkeypatch):
    import numpy as np
    import pytest
    from pyspark.sql import functions as F

    from strata.operators import candidates

    r = np.random.default_rng(11)
    v = r.normal(size=(260, 5)).astype(np.float32).astype(float)
    v[100:140], v[200] = v[100], 0
    rows = [(k, k % 7, k % 3, [float(x) for x in v[k]], None if k % 7 < 4 else 1) for k in range(260)] + [(260, 1, None, [1.0] * 5, None), (261, 1, 1, None, None)]
    table = spark.createDataFrame(rows, "id long, topic_id long, category int, vector array<float>, parent_id long")
    q = table.where("id < 40 or id > 259").select(F.col("id").alias("query_id"), "category", "vector")
    c = table.where("id >= 40").withColumnRenamed("id", "cause_id")

    def distance(a, b):
        return 1 - float(a @ b) / float((a @ a) * (b @ b)) ** 0.5 if a.any() and b.any() else 9.0

    want = {}
    for i in range(40):
        topics = {}
        for j in range(40, 260):
            if i % 3 == j % 3 and (d := round(distance(v[i], v[j]), 12)) <= 0.9:
                topics.setdefault(j % 7, []).append((d, j))
        for rank, (_, t, near) in enumerate(sorted((min(x)[0], t, sorted(x)) for t, x in topics.items())[:3], 1):
            want |= {(i, t, j): (rank, n, pytest.approx(d), pytest.approx(near[0][0])) for n, (d, j) in enumerate(near[:2], 1)}
    for strip, block in ((2048, 4096), (9, 7)):
        monkeypatch.setattr(candidates, "STRIP", strip)
        out = candidates.ranked_topics(q, c, 3, 0.9, 2, **({} if block == 4096 else {"block": block}))
        got = {(x["query_id"], x["topic_id"], x["cause_id"]): (x["topic_rank"], x["cause_rank"], x["distance"], x["topic_distance"]) for x in out.collect()}
        assert got == want
        assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()
