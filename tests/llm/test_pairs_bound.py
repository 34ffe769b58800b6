"""Rows between the stages of line dedup and of the near-duplicate stage do not grow with the square of a group."""

import random

import numpy as np

from strata.llm import linededup, simhash


def test_frequent_tokens_join_no_row(spark):
    """The classes of frequent tokens are values in the plan; each row keeps its buckets."""
    docs = spark.createDataFrame([(i, f"one two three four five six {i}", i) for i in range(20)], "doc_id long, text string, key long")
    p = linededup.prefixes(linededup.lines(docs))
    tokens = [r["prefix"][0] for r in p.collect()]
    frequent = linededup.Frequent({t: n for n, t in enumerate(sorted(set(tokens)), 5)})
    ranked = p.select("h", frequent.rank(p["prefix"][0]).alias("rank"))
    assert "Join" not in ranked._jdf.queryExecution().executedPlan().toString()
    ranks = [r["rank"] for r in ranked.collect()]  # of two tokens in a cell the rarer one has no class
    assert max(ranks) <= linededup.RANKS and sum(k > 0 for k in ranks) > len(ranks) / 2
    met = linededup.buckets(p, {t: 5 for t in set(tokens)})
    assert met.where("heavy").count() >= sum(k > 0 for k in ranks)


def test_lines_move_once(spark):
    """Of a line with copies, only its first place is named and moved."""
    docs = spark.createDataFrame([(None, "z y x"), *[(i, "same line here\nown " + str(i)) for i in range(30)]], "doc_id long, text string").selectExpr("doc_id", "text", "coalesce(doc_id, -1) AS key")
    same = linededup.lines(docs).where("line IN ('same line here', 'z y x')")
    wanted = linededup.stored(same.groupBy("h").agg({"doc_id": "min"}).toDF("h", "doc_id"))
    got = sorted((r["line"], r["doc_id"], r["at"]) for r in linededup._lines_of(docs, wanted).collect())
    assert got == [("same line here", 0, 0), ("z y x", None, 0)]


def test_parity_bounds_difference():
    r = np.random.default_rng(3)
    for _ in range(50):
        base = r.integers(0, 2**63, 400, dtype=np.uint64)
        a, b = base[: r.integers(1, 300)], base[r.integers(0, 200) :]
        bits = int(np.bitwise_count((simhash.parity(a) ^ simhash.parity(b)).view(np.uint64)).sum())
        assert bits <= len(np.setxor1d(a, b))


def test_less_similar_texts_make_no_pairs(spark, monkeypatch):
    """Sets that share bands but cannot be similar are not paired, whatever the size of the band."""
    r = random.Random(5)
    base = [f"w{i}" for i in range(150)]
    texts = []
    for i in range(60):
        words = list(base)
        for at in r.sample(range(150), 6):
            words[at] = f"x{i}y{at}"
        texts.append(" ".join(words))
    texts += [" ".join(base), " ".join([*base, "tail"])]
    made, check = [], simhash._similar
    monkeypatch.setattr(simhash, "_similar", lambda docs, keys, pairs, *a: (made.append(pairs.count()), check(docs, keys, pairs, *a))[1])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    groups = {x["doc_id"]: x["root"] for x in simhash.similar_groups(docs, 5, 0.8).collect()}
    sets = [{tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for t in texts]
    near = [(i, j) for i in range(62) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    assert near and all(groups[i] == groups[j] for i, j in near)
    assert sum(made) < 300
