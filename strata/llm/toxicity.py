"""Toxicity scores from a learned lexicon, with misspellings and context.

The lexicon is learned from labelled documents: whole terms, and stems that match any ending, whose document frequency in
toxic documents is far above that in others; every entry with enough evidence is in it. It becomes a trie. The trie is
intersected with the Levenshtein automaton of each term (one edit from MIN_TYPO letters on, two from MIN_TWO on, the first
letter included; stems take none) by running both as one automaton over all words of a batch: a state is a set of (trie node,
edits so far), and numpy steps all words of a batch at a time. A transition is worked out when a word first takes it, so the
table holds what texts reach and not what a large lexicon could; beyond MOST_STATES states it starts anew. Words fall out as
soon as no entry is in reach.

Around every hit a window of words tells quotation from abuse: an open quotation mark on the line, or a reporting word
before it, makes a hit quoted; a word of address makes it direct; hits close together raise the window's score. A logistic
model over these scores gives the probability. Inputs of a score are the text alone. An empty or null text has no hits and
gets the score of a text without hits. Without labels of both kinds, all scores are the share of label 1 (0 if none).

A document with several labels is toxic if one of them says so; of equal evidence the entry first in the alphabet counts.
Repeated rows get equal scores; very long texts count in full, in time that grows with their length. Only doc_id and text
are read, whatever other columns are named; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import held_out, small_batches, texts

#: The model is fitted on at most so many labelled documents, those with the smallest hashed ids.
FIT_ROWS = 20_000
#: States of the joint automaton that are held at once.
MOST_STATES = 50_000
STEM_FROM, STEM_TO = 4, 6
MIN_TYPO, MIN_TWO = 5, 9
#: Words on either side of a hit that its context takes in.
CONTEXT = 8
_WORD = regex.compile(r"[^\W_]+(?:[@$*!'][^\W_]+)*")
# An apostrophe between letters is none of them.
_QUOTE = regex.compile(r"[\"“”„«»]|(?<!\w)[‘’](?=\w)|(?<=\w)’(?!\w)")
_REPORT = frozenset("said says quote quoted quotes wrote writes called term word cites dit cite mot écrit sagte schrieb wort zitat dijo palabra cita".split())
_ADDRESS = frozenset("you your youre u ur yourself tu toi vous te ton ta du dich dein deine ihr usted tú ti".split())
FEATURES = 7


@dataclass
class Lexicon:
    """entries: text, whether it is a stem, and its weight (log odds of a document)."""

    entries: list[tuple[str, bool, float]]
    classes: dict[str, int] = field(default_factory=dict)
    nodes: list[dict[str, int]] = field(default_factory=list)  # of the trie, by letter
    ends: list[int] = field(default_factory=list)  # entry that ends in a node, or -1
    edits: list[int] = field(default_factory=list)  # most edits that an entry in or below a node takes

    def build(self) -> Lexicon:
        self.nodes, self.ends, self.edits = [{}], [-1], [0]
        for e, (text, _, _) in enumerate(self.entries):
            at, most = 0, self._most(e)
            self.edits[0] = max(self.edits[0], most)
            for c in text:
                if c not in self.nodes[at]:
                    self.nodes[at][c] = len(self.nodes)
                    self.nodes.append({})
                    self.ends.append(-1)
                    self.edits.append(0)
                at = self.nodes[at][c]
                self.edits[at] = max(self.edits[at], most)
            if self.ends[at] < 0:
                self.ends[at] = e
        self.classes = {c: k + 1 for k, c in enumerate(sorted({c for t, _, _ in self.entries for c in t}))}  # class 0: any other
        self._forget()
        return self

    def _most(self, entry: int) -> int:
        text, stem, _ = self.entries[entry]
        return 0 if stem else 2 if len(text) >= MIN_TWO else 1 if len(text) >= MIN_TYPO else 0

    def _forget(self) -> None:
        """Only the dead state 0 and the start 1 are known."""
        self._sets, self._index = [], {}
        self._step = np.full((64, len(self.classes) + 1), -1, np.int32)  # state x class -> state, -1 where not yet worked out
        self._best, self._typo = np.full(64, -1, np.int32), np.zeros(64, bool)  # what a word that ends here matches, and whether with an edit
        self._state(frozenset())
        self._state(self._closed({0: 0}))
        self._step[0] = 0

    def _state(self, active: frozenset) -> int:
        if active in self._index:
            return self._index[active]
        k = self._index[active] = len(self._sets)
        self._sets.append(active)
        if k == len(self._best):
            self._step = np.concatenate([self._step, np.full_like(self._step, -1)])
            self._best, self._typo = np.concatenate([self._best, np.full_like(self._best, -1)]), np.concatenate([self._typo, np.zeros_like(self._typo)])
        found = []
        for node, used in active:
            if node < 0:  # a stem that has been matched takes any ending
                found.append((0, -1 - node))
            elif self.ends[node] >= 0 and used <= self._most(self.ends[node]):
                found.append((used, self.ends[node]))
        low = min(found, default=(0, -1))
        self._best[k], self._typo[k] = low[1], low[0] > 0
        return k

    def _closed(self, active: dict[int, int]) -> frozenset:
        """Adds what skipping letters of the entry reaches."""
        todo = list(active.items())
        while todo:
            node, used = todo.pop()
            if node < 0:
                continue
            for child in self.nodes[node].values():
                if used + 1 <= self.edits[child] and used + 1 < active.get(child, 9):
                    active[child] = used + 1
                    todo.append((child, used + 1))
        return frozenset(active.items())

    def _follow(self, state: frozenset, c: str | None) -> frozenset:
        out: dict[int, int] = {}

        def put(node: int, used: int) -> None:
            if used < out.get(node, 9):
                out[node] = used

        for node, used in state:
            if node < 0:
                put(node, 0)
                continue
            if c is not None and c in self.nodes[node]:
                child = self.nodes[node][c]
                put(child, used)
                if used == 0 and self.ends[child] >= 0 and self.entries[self.ends[child]][1]:
                    put(-1 - self.ends[child], 0)
            if used + 1 <= self.edits[node]:
                put(node, used + 1)  # an added letter
            for child in self.nodes[node].values():
                if used + 1 <= self.edits[child]:
                    put(child, used + 1)  # another letter
        return self._closed(out)

    def _known(self, state: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """The states that follow, worked out where they are not known yet."""
        out = self._step[state, kind]
        if (out < 0).any():
            letters = [None, *self.classes]
            new = np.unique(state[out < 0].astype(np.int64) * len(letters) + kind[out < 0])
            for k, c in zip((new // len(letters)).tolist(), (new % len(letters)).tolist()):
                after = self._state(self._follow(self._sets[k], letters[c]))  # may move the table
                self._step[k, c] = after
            out = self._step[state, kind]
        return out

    def match(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which of the words match, their entries, and whether with an edit."""
        if len(self._sets) > MOST_STATES:
            self._forget()
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        code = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        table = np.zeros(0x110000, np.uint16)
        for c, k in self.classes.items():
            table[ord(c)] = k
        kind = table[code]
        starts = np.cumsum(lengths) - lengths
        who, k = np.flatnonzero(lengths > 0), 0
        state = np.ones(len(who), np.int32)
        out = np.full(len(words), 0, np.int32)
        while len(who):
            state = self._known(state, kind[starts[who] + k])
            k += 1
            over = lengths[who] == k
            out[who[over]] = state[over]
            go = ~over & (state > 0)
            who, state = who[go], state[go]
        hit = np.flatnonzero(self._best[out] >= 0)
        return hit, self._best[out[hit]], self._typo[out[hit]]


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def features(batch: list[str], lexicon: Lexicon) -> np.ndarray:
    """A row of scores for each text."""
    out = np.zeros((len(batch), FEATURES))
    split = [words_of(t) for t in batch]
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    ends = np.cumsum(sizes)
    hit, entry, typo = lexicon.match([w for x in split for w in x])
    weight = np.array([w for _, _, w in lexicon.entries] or [0.0])
    doc = np.searchsorted(ends, hit, side="right")
    found, begins = np.unique(doc, return_index=True)
    for d, a, z in zip(found.tolist(), begins.tolist(), [*begins[1:].tolist(), len(doc)]):
        words = split[d]
        places = (hit[a:z] - (ends[d] - sizes[d])).tolist()
        quoted_by_marks = _inside_quotes(batch[d].lower(), places)
        direct, quoted, spelt, closest, addressed, low, high = 0.0, 0.0, 0, 0.0, 0, 0, 0
        for at, value, odd, marked in zip(places, weight[entry[a:z]].tolist(), typo[a:z].tolist(), quoted_by_marks):
            if marked or not _REPORT.isdisjoint(words[max(0, at - CONTEXT) : at]):
                quoted += value
            else:
                direct += value
                addressed += not _ADDRESS.isdisjoint(words[max(0, at - CONTEXT) : at + CONTEXT + 1])
                while places[low] < at - CONTEXT:
                    low += 1
                while high < len(places) and places[high] <= at + CONTEXT:
                    high += 1
                closest = max(closest, value * (high - low))
            spelt += odd
        kinds = len(np.unique(entry[a:z]))
        out[d] = [math.log1p(direct), math.log1p(quoted), math.log1p(spelt), math.log1p(closest), math.log1p(addressed), math.log1p(kinds), 100 * len(places) / (len(words) + 50)]
    return out


def _inside_quotes(text: str, places: list[int]) -> list[bool]:
    """For the words at these places, in order, whether an odd number of quotation marks stands before them on their line."""
    marks = [m.start() for m in _QUOTE.finditer(text)]
    if not marks:
        return [False] * len(places)
    breaks = [m.start() for m in regex.finditer("\n", text)]
    begins = [m.start() for m in _WORD.finditer(text)]
    out = []
    for at in places:
        line = bisect_left(breaks, begins[at])
        out.append((bisect_left(marks, begins[at]) - bisect_left(marks, breaks[line - 1] if line else 0)) % 2 == 1)
    return out


def _evidence(t: np.ndarray, c: np.ndarray, toxic: int, clean: int) -> np.ndarray:
    """Log-likelihood ratio of counts t and c against one common rate, 0 where toxic documents do not have more."""
    n, rate = t + c, toxic / (toxic + clean)
    p = t / n
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = t * np.log(p / rate) + np.where(c > 0, c * np.log(np.where(c > 0, (1 - p) / (1 - rate), 1)), 0)
    return np.where(p > rate, gain, 0)


def learn_lexicon(counts: dict[str, tuple[int, int]], stems: dict[str, tuple[int, int]], toxic: int, clean: int) -> Lexicon:
    """From document counts (toxic, other) of words and of stems."""
    found = []
    bar = math.log(max(len(counts) + len(stems), 2)) + 2
    for table, stem in ((counts, False), (stems, True)):
        if not table:
            continue
        names = sorted(table)
        t, c = (np.array([table[x][k] for x in names], float) for k in (0, 1))
        gain = _evidence(t, c, toxic, clean)
        odds = np.log((t + 0.5) / (toxic + 1)) - np.log((c + 0.5) / (clean + 1))
        for k in np.flatnonzero((gain > bar) & (odds > 2) & (t >= 3)):
            found.append((float(gain[k]) * (1 if stem else 1.1), names[k], stem, float(odds[k])))  # a stem has to add other endings
    # the strongest first; what a chosen stem covers adds nothing, and a stem weaker than an entry that it covers is left out
    chosen: dict[tuple[str, bool], float] = {}
    under: dict[str, list[tuple[str, bool]]] = {}
    for _, name, stem, odds in sorted(found, key=lambda x: (-x[0], x[1])):
        if any((name[:k], True) in chosen for k in range(STEM_FROM, STEM_TO + 1)) or (stem and under.get(name)):
            continue
        chosen[(name, stem)] = odds
        for k in range(STEM_FROM, STEM_TO + 1):
            if len(name) >= k:
                under.setdefault(name[:k], []).append((name, stem))
    return Lexicon([(name, stem, odds) for (name, stem), odds in chosen.items()]).build()


@dataclass
class Model:
    lexicon: Lexicon
    weights: np.ndarray
    bias: float
    center: np.ndarray
    scale: np.ndarray

    def score(self, batch: list[str]) -> np.ndarray:
        x = (features(batch, self.lexicon) - self.center) / self.scale
        return 1 / (1 + np.exp(-np.clip(x @ self.weights + self.bias, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, l2: float = 1.0, rounds: int = 50) -> tuple[np.ndarray, float]:
    """Newton steps on the penalised likelihood; labels may be probabilities."""
    a = np.concatenate([x, np.ones((len(x), 1))], 1)
    w, weight = np.zeros(a.shape[1]), np.ones(len(x)) if weight is None else weight
    penalty = np.append(np.full(x.shape[1], l2), 1e-3)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = (a * (weight * p * (1 - p))[:, None]).T @ a + np.diag(penalty)
        change = np.linalg.solve(h, a.T @ (weight * (y - p)) - penalty * w)
        w += np.clip(change, -4, 4)
        if np.abs(change).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def train(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """From labelled documents that are not held out."""
    small_batches(docs.sparkSession)
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    sample = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("text", "toxic")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            table: dict[str, list[int]] = {}
            for text, toxic in zip(texts(b.column(0)), b.column(1).to_pylist()):
                own = set(words_of(text))
                for name in [*own, *{w[:k] + "~" for w in own for k in range(STEM_FROM, STEM_TO + 1) if len(w) > k}, "#"]:
                    table.setdefault(name, [0, 0])[1 - toxic] += 1
            yield pa.RecordBatch.from_arrays([pa.array(list(table), pa.string()), pa.array([x[0] for x in table.values()], pa.int64()), pa.array([x[1] for x in table.values()], pa.int64())], names=["name", "t", "c"])

    rows = sample.mapInArrow(count, "name string, t long, c long").groupBy("name").agg(F.sum("t").alias("t"), F.sum("c").alias("c")).where("t >= 3 and 10 * t > c or name = '#'").toPandas()
    total = rows[rows["name"] == "#"]
    toxic, clean = (int(total["t"].iloc[0]), int(total["c"].iloc[0])) if len(total) else (0, 0)
    flat_model = lambda p: Model(Lexicon([]).build(), np.zeros(FEATURES), math.log(p / (1 - p)), np.zeros(FEATURES), np.ones(FEATURES))
    if not toxic or not clean:
        return flat_model(min(max(toxic / max(toxic + clean, 1), 1e-6), 1 - 1e-6))
    counts = {n: (t, c) for n, t, c in zip(rows["name"], rows["t"], rows["c"]) if n != "#" and not n.endswith("~")}
    stems = {n[:-1]: (t, c) for n, t, c in zip(rows["name"], rows["t"], rows["c"]) if n.endswith("~")}
    lexicon = learn_lexicon(counts, stems, toxic, clean)
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = features(texts(b.column(0)), shared.value)
            yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.list_(pa.float64())), b.column(1)], names=["x", "y"])

    fit = sample.mapInArrow(scores, "x array<double>, y int").limit(fit_rows).toPandas()
    x, y = np.stack(fit["x"].to_numpy()), fit["y"].to_numpy().astype(float)
    center, scale = x.mean(0), np.maximum(x.std(0), 1e-6)
    weights, bias = logistic((x - center) / scale, y)
    return Model(lexicon, weights, bias, center, scale)


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted for every row."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    key = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            score = shared.value.score(texts(b.column(1)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], names=["doc_id", "score", "predicted"])

    out = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {key}, score double, predicted int")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
