"""Brute-force versions, exact round trips, held-out accuracy and odd inputs of the training-data operators."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from strata.llm import bpe, chat, decontaminate, langid, linededup, pii, quality, simhash, suffixes, toxicity, trees

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LOWER = {i: i + 32 for i in range(65, 91)}
WORDS = [a + b for a in ("ka", "lo", "mi", "tu", "re", "so", "ne") for b in ("n", "r", "sti", "la", "do")]


def prose(r, n):
    return " ".join(r.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    """Copies, near copies, shared passages, repeated lines, nulls, empties, repeated rows, one long text, null ids."""
    r = random.Random(11)
    base = [prose(r, r.randint(5, 160)) for _ in range(40)]
    shared = prose(r, 120)
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(100 + i, base[i]) for i in range(10)]
    rows += [(200 + i, base[i].replace(" ", " x ", 1)) for i in range(10)]
    rows += [(300 + i, f"{prose(r, 20)} {shared} {prose(r, 20)}") for i in range(12)]
    rows += [(400 + i, "\n".join([prose(r, 8), "the very same line of text here", prose(r, 12), shared])) for i in range(8)]
    words = shared.split()
    rows += [(500 + i, "\n".join([" ".join(words[:i] + ["zz"] + words[i + 1 :]), "short"])) for i in range(40)]
    rows += [(600, None), (601, ""), (602, " \n\t "), (603, "ab " * 700), (604, "x" * 900), (605, prose(r, 9000)), (606, "É ñ ß"), (None, base[3]), (None, None), (0, base[0]), (0, base[0])]
    return spark.createDataFrame([(i, t, "en", "s", len(t) if t else None) for i, t in rows], DOCS).repartition(5).cache()


def rows_of(docs):
    return [(x["doc_id"], x["text"]) for x in docs.collect()]


def counted(rows):
    return collections.Counter(map(tuple, rows))


def test_decontamination(spark, docs):
    have = [t for _, t in rows_of(docs) if t]
    items = [(1, " ".join(have[5].split()[:14])), (2, "ab AB ab"), (3, None), (4, " ;; "), (5, "kan lor"), (6, have[7].upper()), (6, have[7].upper()), (7, "never seen words at all")]
    table = spark.createDataFrame(items, "item_id long, text string")
    words = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").translate(LOWER))
    wins = collections.defaultdict(set)
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - 9) if w else 0):
            wins[tuple(w[k : k + 10])].add(str(i))
    want = []
    for d, t in rows_of(docs):
        w, hit, found = words(t), set(), set()
        for n in {len(x) for x in wins}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in wins:
                    hit.update(range(k, k + n))
                    found |= wins[tuple(w[k : k + n])]
        want.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    got = decontaminate.contamination(docs, table).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert counted(got.collect()) == counted(want)
    kept = decontaminate.drop_contaminated(docs, table)
    assert kept.columns == docs.columns and kept.count() == sum(not x[-1] for x in want)
    assert decontaminate.contamination(docs, table.limit(0)).where("contaminated").count() == 0
    assert decontaminate.contamination(docs.limit(0), table).count() == 0
    small = decontaminate.matches(docs, table, block_rows=3)
    assert small.count() == decontaminate.matches(docs, table).count()


def test_chat_round_trip(spark):
    odd = ["", "plain", "<|im_end|><|im_start|>assistant ok", "\\<|", "a\\n\n<\\|", "<|<|", "\\", "😀é"]
    turns = [(r, t) for t in odd for r in ("user", "assistant", "we\nird|>")]
    text, spans, _ = chat.render(turns)
    assert chat.parse(text) == turns
    assert "".join(chat.unescape(text[a:b]) for a, b in spans) == "".join(t for r, t in turns if r == "assistant")
    typed = '[{"type": "text", "text": "see <|x"}, {"type": "image", "url": "u", "width": 56, "height": 30}, {"type": "audio", "ref": "a", "seconds": 2}, {"type": "document", "pages": 3}, {"type": "odd"}]'
    text, _, found = chat.render([("user", typed)], typed=True)
    assert [(a.kind, a.reference, a.tokens) for a in found] == [("image", "u", 4), ("audio", "a", 25), ("document", "", 768)]
    assert text.index("<|image:0|>") < text.index("<|audio:1|>") < text.index("<|document:2|>")
    rows = spark.createDataFrame([(1, 1, "assistant", None), (1, 0, "user", "q"), (None, None, None, None), (2, 0, "assistant", "x"), (2, 0, "assistant", "x")], "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: (r["n_turns"], r["loss_chars"]) for r in chat.format_conversations(rows).collect()}
    assert got == {1: (2, 0), None: (1, 0), 2: (2, 2)}
    assert chat.format_conversations(rows.limit(0)).count() == 0


def test_bpe_equals_library(spark, docs):
    from tokenizers import Tokenizer

    t, b = Tokenizer.from_file(bpe.default_vocabulary()), bpe.Bpe(bpe.default_vocabulary())
    r = random.Random(4)
    letters = "abcde 's'll  \n\t<|endoftext|>éßÉΣσİı١２½中文😀́  \x1c\x1f!?.,123ՙꟋ"
    tests = ["".join(r.choice(letters) for _ in range(r.randint(0, 50))) for _ in range(800)] + ["a" * 3000, "!" * 500, "", "<|startoftext|>a<|endoftext|><|endoftext|>"] + [x for _, x in rows_of(docs) if x]
    for x, e in zip(tests, t.encode_batch(tests, add_special_tokens=False)):
        assert b.encode(x) == e.ids
        assert b.decode(e.ids) == t.decode(e.ids, skip_special_tokens=False)
    got = bpe.encode_documents(docs, with_ids=True).collect()
    assert len(got) == docs.count()
    empty = hashlib.sha256(b"").hexdigest()
    assert all((r["n_tokens"] == len(r["ids"])) and (r["n_tokens"] > 0 or r["ids_sha256"] == r["decoded_sha256"] == empty) for r in got)


def test_line_dedup(spark, docs):
    tokens = lambda x: frozenset(tuple(x.split(" ")[i : i + 5]) for i in range(max(1, len(x.split(" ")) - 4)))
    rows = sorted(rows_of(docs), key=lambda x: (x[0] is not None, x[0] or 0, x[1] or ""))
    first, order = {}, []
    for d, t in rows:
        for i, x in enumerate((t or "").split("\n")):
            if x.strip(" "):
                at = (d is not None, d or 0, i)
                if x not in first:
                    order.append(x)
                first[x] = min(first.get(x, at), at)
    order.sort(key=lambda x: first[x])
    sets, gone = [tokens(x) for x in order], set()
    for k in range(len(order)):
        if any(len(sets[k] & sets[j]) * 1.8 >= 0.8 * (len(sets[k]) + len(sets[j])) - 1e-9 and first[order[j]] < first[order[k]] for j in range(k)):
            gone.add(order[k])
    want = []
    for d, t in rows:
        parts = (t or "").split("\n")
        kept = [x for i, x in enumerate(parts) if not x.strip(" ") or (x not in gone and first[x] == (d is not None, d or 0, i))]
        want.append((d, None if t is None else "\n".join(kept), sum(bool(x.strip(" ")) for x in parts), len(parts) - len(kept)))
    got = linededup.dedup_lines(docs.withColumn("line", F.lit(1)).withColumn("bad", F.lit(2)).withColumn("n", F.lit(3)))
    assert counted(got.select("doc_id", "text", "n_lines", "n_removed").collect()) == counted(want)
    assert got.columns[: len(docs.columns)] == docs.columns and gone
    assert linededup.dedup_lines(docs.limit(0)).count() == 0


def test_line_dedup_second_round(spark, monkeypatch):
    """With no neighbours in the first round, the second alone still finds every partner."""
    monkeypatch.setattr(linededup, "NEAR", 1)
    monkeypatch.setattr(linededup, "COPIES", 2)
    r = random.Random(9)
    left, right = [prose(r, 25) for _ in range(6)], [prose(r, 25) for _ in range(6)]
    rows = [(6 * i + j + 100 * k, f"{left[i]} {right[j]}" + " tail" * k) for i in range(6) for j in range(6) for k in range(2)]
    rows += [(300, rows[3][1]), (301, rows[3][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    test_line_dedup(spark, docs.withColumn("x", F.lit(1)))


@pytest.mark.parametrize(("busy", "busiest", "rounds"), [(2, 1000, 3), (3, 2, 2), (2, 1000, 1)])
def test_line_dedup_frequent_tokens(spark, docs, monkeypatch, busy, busiest, rounds):
    """Frequent tokens go to later rounds, to the end of the order or to split buckets; the rows stay the same."""
    for name, value in (("BUSY", busy), ("HEAVY", busy), ("BUSIEST", busiest), ("ROUNDS", rounds), ("NEAR", 1), ("PARTS", 3)):
        monkeypatch.setattr(linededup, name, value)
    test_line_dedup(spark, docs)


def test_line_dedup_clashing_names(spark):
    rows = [(1, "a b c d e f\nx", "mine", 1, "p"), (2, "a b c d e f", "mine", 2, "q"), (2, "a b c d e f", "mine", 3, "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, N_REMOVED string, h long, `a.b` string")
    got = linededup.dedup_lines(docs)
    assert got.columns == ["doc_id", "text", "h", "a.b", "n_lines", "n_removed"]
    assert sorted(map(tuple, got.collect())) == [(1, "a b c d e f\nx", 1, "p", 2, 0), (2, "", 2, "q", 1, 1), (2, "", 3, "q", 1, 1)]


def test_suffixes(spark, docs):
    def brute(rows, n):
        seen = collections.Counter(b[i : i + n] for b in rows for i in range(len(b) - n + 1))
        out = []
        for b in rows:
            mark = np.zeros(len(b) + 1, int)
            for i in range(len(b) - n + 1):
                if seen[b[i : i + n]] > 1:
                    mark[i] += 1
                    mark[i + n] -= 1
            c = np.cumsum(mark)[:-1] > 0
            out.append((len(b), int(c.sum()), int((np.diff(np.concatenate([[0], c.astype(int)])) == 1).sum()), hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~c]) if len(b) else b"").hexdigest()))
        return out

    rows = rows_of(docs)
    want = [(d, *x) for (d, _), x in zip(rows, brute([(t or "").encode() for _, t in rows], 400))]
    got = suffixes.remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert counted(got.collect()) == counted(want)
    assert sum(w[2] for w in want) > 10000
    # anchors that are never gathered give the same intervals
    keyed = docs.select(F.xxhash64("doc_id", "text").alias("key"), F.lit(7).cast("long").alias("key2"), F.coalesce("text", F.lit("")).alias("text"))

    def points(most):
        return {(r["key"], p) for r in suffixes.covered(keyed, group_most=most).collect() for p in range(r["start"], r["end"])}

    assert points(1) == points(2000)
    assert suffixes.remove_repeats(docs.limit(0)).count() == 0


def test_suffix_pieces(spark, monkeypatch):
    """A long text is taken in pieces; its windows are the same."""
    monkeypatch.setattr(suffixes, "_PIECE", 1000)
    r = random.Random(2)
    a = prose(r, 900)
    data = np.frombuffer(a.encode(), np.uint8)
    pieces = list(suffixes._pieces(np.array([0, len(data)]), 400))
    starts = [s for part in pieces for _, lo, hi in part for s in range(lo, hi - 399)]
    assert starts == list(range(len(data) - 399))


def test_simhash(spark, docs):
    def fp(t):
        w = re.findall("[^\x20\x09-\x0d]+", (t or "").translate(LOWER))
        if not w:
            return 0
        s = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
        c = [0] * 64
        for x in s:
            h = xxhash.xxh64_intdigest(x.encode(), 42)
            for b in range(64):
                c[b] += h >> b & 1
        return sum(1 << b for b in range(64) if 2 * c[b] > len(s))

    rows = rows_of(docs)
    prints = [fp(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                parent[max(find(i), find(j))] = min(find(i), find(j))
    least = collections.defaultdict(list)
    for i, (d, _) in enumerate(rows):
        least[find(i)].append(d)
    name = {k: min((x for x in v if x is not None), default=None) for k, v in least.items()}
    want = [(d, "%016x" % prints[i], name[find(i)]) for i, (d, _) in enumerate(rows)]
    got = simhash.near_groups(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")), "component_id")
    assert counted(got.collect()) == counted(want)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len(least)
    assert simhash.near_groups(docs.limit(0)).count() == 0


@pytest.mark.parametrize("most", [4, 1024])
def test_gray_index(spark, most):
    """Near fingerprints around few centers, in groups that have to be dealt out again."""
    r = random.Random(most)
    values = set()
    for _ in range(3):
        c = r.getrandbits(64)
        for _ in range(60):
            x = c
            for _ in range(r.randint(0, 4)):
                x ^= 1 << r.randrange(64)
            values.add(x)
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    table = spark.createDataFrame([(v,) for v in signed], "fp long")
    got = [(x["u"], x["v"]) for x in simhash.links(table, 2, most).collect()]
    label = {v: v for v in signed}

    def close(pairs):
        lab = {v: v for v in signed}
        changed = True
        while changed:
            changed = False
            for a, b in pairs:
                m = min(lab[a], lab[b])
                if lab[a] != m or lab[b] != m:
                    lab[a] = lab[b] = m
                    changed = True
        return lab

    want = [(a, b) for k, a in enumerate(signed) for b in signed[:k] if ((a ^ b) & (2**64 - 1)).bit_count() <= 2]
    assert close(got) == close(want) and label
    assert all(((a ^ b) & (2**64 - 1)).bit_count() <= 64 for a, b in got)


def test_gray_rank():
    codes = np.array([k ^ (k >> 1) for k in range(4096)], np.uint64)
    assert (simhash.gray_rank(codes) == np.arange(4096)).all()


KINDS = ["email", "ip", "card", "phone"]


def brute_spans(t):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m.group())
        if 12 <= len(d) <= 19 and pii.luhn(d):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return sorted(out)


def test_pii(spark):
    r = random.Random(6)
    for _ in range(20000):
        t = "".join(r.choice("a1.2@-+ ()3%b.@9é") for _ in range(r.randint(0, 40)))
        assert pii.base_spans(t) == brute_spans(t)
    assert pii.base_spans("a" * 200_000 + "1" * 200_000) == []  # linear
    texts = ["mail joe@x.org or +1 (988) 555-2485", "card 4111 1111 1111 1111 at 10.0.0.1", "write to ann [at] example [dot] com please", "isbn 978 3 16 148410 0", "call 030 1234 5678 now", None, "", "nothing"] * 6
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = pii.train(docs)
    got = {r["doc_id"]: r for r in pii.find_spans(docs, model).collect()}
    for i, t in enumerate(texts):
        base = brute_spans(t or "")
        assert [got[i][c] for c in pii.COUNTS] == [sum(s[1] == k for s in base) for k in range(4)]
        joined = ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in base)
        assert got[i]["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert set(filter(None, joined.split(","))) <= set(got[i]["spans"].split(","))
    assert pii.find_spans(docs.limit(0), pii.train(docs.limit(0))).count() == 0


def test_reliabilities():
    r = np.random.default_rng(1)
    truth = r.random(4000) < 0.3
    votes = np.stack([np.where(r.random(4000) < acc, truth, ~truth) * 2 - 1 for acc in (0.95, 0.8, 0.7)], 1)
    patterns, inverse, n = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    table, p = pii.reliabilities(patterns, n.astype(float))
    assert abs(table[1, 0, 2] - 0.95) < 0.06 and table[1, 0, 2] > table[1, 2, 2]
    assert ((p[inverse.ravel()] > 0.5) == truth).mean() > 0.93


def test_quality(spark, docs):
    def brute(t):
        w = re.findall("[^\x20\x09-\x0d]+", t or "")
        where = collections.defaultdict(list)
        for i in range(len(w) - 7):
            where[tuple(w[i : i + 8])].append(i)
        cover = {k for v in where.values() if len(v) > 1 for i in v for k in range(i, i + 8)}
        lines = [x for x in (t or "").split("\n") if re.search("[^\x20\x09-\x0d]", x)]
        return len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(cover)

    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(40)] + [(None, 1, 1), (3, 0, 0)], "doc_id long, quality int, toxic int")
    judged = quality.judge(docs.withColumn("kept", F.lit("clash")), quality.train(docs, labels))
    want = counted((d, *brute(t)) for d, t in rows_of(docs))
    assert counted(judged.select("doc_id", *quality.COUNTS).collect()) == want
    for r in judged.collect():
        failed = r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"]
        assert r["base_failed"] == failed and not (failed and r["kept"])
    assert quality.filter_documents(docs, labels.limit(0)).columns == docs.columns
    assert quality.judge(docs.limit(0), trees.constant()).count() == 0


def test_trees_monotone():
    r = np.random.default_rng(0)
    x = r.random((3000, 3))
    y = ((x[:, 0] + 0.5 * np.sin(9 * x[:, 1]) + 0.2 * r.random(3000)) > 0.7).astype(float)
    f = trees.fit(x, y, np.array([1, 0, -1]))
    assert ((f.score(x) > 0.5) == y).mean() > 0.9
    grid = np.repeat(r.random((50, 3)), 40, 0)
    grid[:, 0] = np.tile(np.linspace(0, 1, 40), 50)
    assert (np.diff(f.score(grid).reshape(50, 40), axis=1) >= -1e-12).all()


def test_toxicity(spark):
    r = random.Random(8)
    rows = []
    for i in range(900):
        words = prose(r, 60).split()
        bad = i % 6 == 0
        if bad:
            for k in range(3):
                words.insert(r.randrange(50), r.choice(["scoundrel", "wretched", "vilox" + r.choice(["a", "en", "tu", "ri"])]))
        rows.append((i, " ".join(words), int(bad)))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(5000, None), (5001, ""), (5002, "a scoundral and wretchad man")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, labels)
    assert {x[0] for x in model.lexicon.entries} >= {"scoundrel", "wretched"}
    got = {r["doc_id"]: r for r in toxicity.score_documents(docs, model).collect()}
    held = [i for i, _, _ in rows if got[i]["held_out"]]
    assert len(held) > 100 and np.mean([got[i]["predicted"] == rows[i][2] for i in held]) > 0.98
    assert got[5002]["score"] > got[5000]["score"] and got[5001]["score"] == got[5000]["score"] < 0.5
    quiet = toxicity.train(docs, labels.limit(0))
    assert toxicity.score_documents(docs.limit(0), quiet).count() == 0


def edits(a: str, b: str) -> int:
    """Levenshtein distance by the whole table."""
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, d in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (c != d))
    return row[-1]


def test_edit_automaton():
    """Against the distance table: any letter may be edited, the first one too."""
    lex = toxicity.Lexicon([("idiot", False, 1.0), ("disgusting", False, 1.0), ("vequ", True, 1.0), ("cat", False, 1.0), ("idioms", False, 1.0)]).build()
    r = random.Random(11)
    words = ["idiot", "idiott", "idot", "iddiot", "adiot", "diot", "xidiot", "idxxt", "disgustng", "disgsting", "dixgustinq", "zisgustin", "vequx", "vequ", "veqx", "cat", "cut", "cats", "zzz", ""]
    for text, _, _ in lex.entries * 60:
        for _ in range(r.randint(0, 3)):
            at = r.randrange(len(text) + 1)
            text = text[:at] + r.choice(["", "d", "i", "q"]) + text[at + r.randint(0, 1) :]
        words.append(text)
    hit, entry, typo = lex.match(words)
    found = {words[h]: (int(e), bool(t)) for h, e, t in zip(hit, entry, typo)}
    want = {}
    for w in words:
        near = [(0 if stem else edits(w, text), e) for e, (text, stem, _) in enumerate(lex.entries) if (w.startswith(text) if stem else edits(w, text) <= (2 if len(text) >= 9 else 1 if len(text) >= 5 else 0))]
        if near:
            want[w] = (min(near)[1], min(near)[0] > 0)
    assert found == want and found["adiot"] == (0, True)


def test_language(spark):
    r = random.Random(3)
    parts = {"aa": ["the", "ing", "tion", "er", "an"], "bb": ["ción", "que", "ar", "os", "ñ"], "cc": ["sch", "ung", "keit", "ein", "ü"]}
    rows = [(i, (lang := "aabbcc"[2 * (i % 3) : 2 * (i % 3) + 2]), " ".join("".join(r.choice(parts[lang]) for _ in range(r.randint(1, 3))) for _ in range(40))) for i in range(300)]
    docs = spark.createDataFrame([*rows, (900, "aa", None), (901, "aa", "12 !?"), (902, None, "the thing"), (903, "aa", "")], "doc_id long, lang string, text string")
    models = langid.train(docs)
    got = {r["doc_id"]: r for r in langid.identify(docs, models).collect()}
    assert all(got[i]["lang_pred"] == lang for i, lang, _ in rows)
    assert [got[i]["lang_pred"] for i in (900, 901, 903)] == ["und"] * 3 and got[902]["lang_pred"] == "aa"
    assert all(0 <= r["score"] <= 1 for r in got.values())
    none = langid.train(docs.limit(0))
    assert {r["lang_pred"] for r in langid.identify(docs, none).collect()} == {"und"}


def test_language_probabilities_sum_to_one():
    gram, offsets, _ = langid.stream(["the thing and that", "la que una cosa"])
    language = np.repeat([0, 1], np.diff(offsets))
    key, n = np.unique(np.stack([language, gram], 1), axis=0, return_counts=True)
    m = langid.estimate(["a", "b"], key[:, 0], key[:, 1].astype(np.int64), n.astype(float))
    for context in (gram[3] >> 6, 12345):
        every = ((int(context) << 6) + np.arange(64)).astype(np.int32)
        assert np.allclose(np.exp(m.log_probability(every).astype(float)).sum(0), 1, atol=1e-4)
    one = langid.stream(["the thing"])[0]
    both = langid.stream(["xx", "the thing"])
    assert (both[0][both[1][1] :] == one).all()


def test_pipeline(spark, docs, tmp_path):
    """Each stage against a brute-force version of its decision, on its own input."""
    import corpus_pipeline

    spark.createDataFrame([(i, int(i % 7 > 0), 0) for i in range(60)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, "kan lor nothing here at all"), (2, " ".join([t for i, t in rows_of(docs) if i == 20][0].split()[:15]))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "simhash_near_dedup", "decontamination", "bpe_encoding"]
    table = spark.read.parquet(str(tmp_path / "documents.parquet"))
    counts = [table.count()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, table, str(tmp_path)).write.parquet(str(tmp_path / f"out{k}"))
        table = spark.read.parquet(str(tmp_path / f"out{k}"))
        counts.append(table.count())
        if k < 4:
            assert table.columns == docs.columns
    assert counts[0] > counts[1] == counts[2] > counts[3] >= counts[4] == counts[5]
    assert table.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert counted(corpus_pipeline.run(spark, str(tmp_path)).collect()) == counted(table.collect())
