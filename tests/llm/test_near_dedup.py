"""The near-duplicate stage of the pipeline against all pairs of sets of shingles."""

import random

import corpus_pipeline


def sets(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def kept(rows):
    """Ids of the first row of each group of rows that links of at least 0.8 connect."""
    found, parent = [sets(t) for _, t in rows], list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(found):
        for j, b in enumerate(found[:i]):
            if a == b or len(a & b) >= 0.8 * len(a | b) > 0:
                parent[max(find(i), find(j))] = min(find(i), find(j))
    return sorted(rows[i][0] for i in range(len(rows)) if find(i) == i)


def test_near_copies_that_differ_in_single_words(spark):
    r = random.Random(5)
    rows = []
    for k in range(40):
        words = [f"w{r.randrange(500)}" for _ in range(r.randint(30, 300))]
        rows.append(" ".join(words))
        for _ in range(3):
            edited = list(words)
            for at in r.sample(range(len(words)), r.randint(1, max(1, len(words) // 40))):
                edited[at] = "zz"
            rows.append(" ".join(edited).upper() if k % 3 == 0 else " ".join(edited))
    # a chain: neighbours are similar, its ends are not
    chain = [f"c{r.randrange(500)}" for _ in range(200)]
    rows += [" ".join([*(f"x{i}" for i in range(10 * k)), *chain[10 * k :]]) for k in range(6)]
    rows += ["", None, "  ", "one two", "One  two", "one three"]
    r.shuffle(rows)
    rows = list(enumerate(rows))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = kept(rows)
    assert len(want) < len(rows) - 60
    got = corpus_pipeline.simhash_near_dedup(spark, docs, "")
    assert got.columns == docs.columns
    assert sorted(x["doc_id"] for x in got.collect()) == want
