"""Language identification by interpolated Kneser-Ney character models, one for each language.

Letters are folded to 63 symbols (a to z, then classes of the others by code point); all else is a space, symbol 0, and
spaces do not repeat. An n-gram of ORDER symbols is an integer of 6 bits a symbol, so a model has at most 64**ORDER entries
whatever the corpus; counts are taken over all training texts, added up before the shuffle. The highest order uses counts,
lower orders the number of distinct symbols to the left. Entries lie in sorted arrays with one column for each language and
are found by binary search; an n-gram that no language has seen backs off through the orders.

The language with the lowest cross-entropy a symbol wins. The score is its posterior, lowered where the cross-entropy lies
far above what training texts of that language have. Null texts and texts without a letter are `und` with score 0; without
any training text all others are `und` too.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import held_out, small_batches, texts

ORDER, BITS = 4, 6
#: Cross-entropies of all training texts are counted by bins of this width, in which their medians are found.
BIN = 1 / 4096
#: Symbols beyond so many add no more to the posterior; a long text is not surer than this.
EVIDENCE = 120
#: Standard deviations above a language's mean cross-entropy at which the score is halved.
REJECT_AT = 6.0


def _symbols() -> np.ndarray:
    table = np.zeros(0x110000, np.uint8)
    for cp in range(0x30000):
        if not 0xD800 <= cp < 0xE000 and chr(cp).isalpha():
            table[cp] = cp - 96 if 97 <= cp <= 122 else 27 + cp % 37
    return table


_TABLE: list[np.ndarray] = []


def stream(batch: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """n-grams of all texts, the offset of each text's first (len + 1 of them), and whether a text has a letter."""
    if not _TABLE:
        _TABLE.append(_symbols())
    # three leading spaces give each text its own history
    parts = [t.lower() for t in batch]
    joined = "".join("\x00" * (ORDER - 1) + t + " " for t in parts)
    code = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts)) + ORDER
    symbol = _TABLE[0][code]
    keep = (symbol > 0) | (code == 0)
    keep[1:] |= (symbol[:-1] > 0) & (symbol[1:] == 0)
    text = np.repeat(np.arange(len(parts)), sizes)[keep]
    symbol = symbol[keep].astype(np.int32)
    if len(symbol) < ORDER:
        return np.zeros(0, np.int32), np.zeros(len(parts) + 1, np.int64), np.zeros(len(parts), bool)
    gram = symbol[: len(symbol) - ORDER + 1].copy()
    for k in range(1, ORDER):
        gram = (gram << BITS) | symbol[k : len(symbol) - ORDER + 1 + k]
    whole = text[: len(gram)] == text[ORDER - 1 :]
    whole &= gram > 0
    counts = np.bincount(text[: len(gram)][whole], minlength=len(parts))
    letters = np.bincount(text, symbol > 0, len(parts)) > 0
    return gram[whole], np.concatenate([[0], np.cumsum(counts)]), letters


@dataclass
class Models:
    """Sorted n-grams of each order and their log probabilities, a column for each language."""

    languages: list[str]
    grams: list[np.ndarray]  # [order - 1]
    logs: list[np.ndarray]  # [order - 1] grams x languages
    backs: list[np.ndarray]  # [order - 1] log weight that the context, a gram of this order, leaves to the next lower order
    mean: np.ndarray
    deviation: np.ndarray

    @staticmethod
    def _at(table: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(table, wanted)
        at[at == len(table)] = 0
        return at, table[at] == wanted if len(table) else np.zeros(len(wanted), bool)

    def log_probability(self, gram: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Natural logarithm for each n-gram and language."""
        if order == 0:
            return np.full((len(gram), len(self.languages)), -np.log(1 << BITS), np.float32)
        at, seen = self._at(self.grams[order - 1], gram)
        out = self.logs[order - 1][at] if len(self.grams[order - 1]) else np.zeros((len(gram), len(self.languages)), np.float32)
        if not seen.all():
            missing = gram[~seen]
            lower = self.log_probability(missing & ((1 << BITS * (order - 1)) - 1), order - 1)
            if order > 1:
                at, known = self._at(self.grams[order - 2], missing >> BITS)
                if len(self.grams[order - 2]):
                    lower = lower + np.where(known[:, None], self.backs[order - 2][at], 0)
            else:
                lower = lower + self.backs[-1]
            out = out.copy()
            out[~seen] = lower
        return out

    def entropies(self, batch: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cross-entropy a symbol for each text and language, n-grams of each text, whether it has letters."""
        gram, offsets, letters = stream(batch)
        n = np.diff(offsets)
        total = np.zeros((len(batch), len(self.languages)))
        filled = np.flatnonzero(n > 0)
        if len(filled) and self.languages:
            total[filled] = np.add.reduceat(self.log_probability(gram), offsets[:-1][filled], axis=0, dtype=np.float64)
        return -total / np.maximum(n, 1)[:, None], n, letters

    def predict(self, batch: list[str]) -> tuple[list[str], np.ndarray]:
        entropy, n, letters = self.entropies(batch)
        if not self.languages:
            return ["und"] * len(batch), np.zeros(len(batch))
        best = entropy.argmin(1)
        rows = np.arange(len(batch))
        margin = (entropy - entropy[rows, best][:, None]) * np.minimum(n, EVIDENCE)[:, None]
        score = 1 / np.exp(-margin).sum(1)
        # short texts scatter more
        odd = (entropy[rows, best] - self.mean[best]) / (self.deviation[best] * np.sqrt(1 + 200 / np.maximum(n, 1)))
        score = np.clip(score / (1 + np.exp(np.clip(odd - REJECT_AT, -30, 30))), 0, 1)
        return [self.languages[k] if ok else "und" for k, ok in zip(best, letters)], np.where(letters, score, 0.0)


def estimate(languages: list[str], language: np.ndarray, gram: np.ndarray, count: np.ndarray) -> Models:
    """Kneser-Ney estimates from counts of n-grams of the highest order."""
    width = len(languages)
    grams, logs, backs = [], [], []
    table = np.unique(gram)
    counts = np.zeros((len(table), width))
    counts[np.searchsorted(table, gram), language] = count
    tables, tallies = [table], [counts]
    for order in range(ORDER - 1, 0, -1):
        lower = tables[0] & ((1 << BITS * order) - 1)
        own = np.unique(lower)
        tally = np.zeros((len(own), width))
        np.add.at(tally, np.searchsorted(own, lower), tallies[0] > 0)
        tables.insert(0, own)
        tallies.insert(0, tally)
    uniform = 1 / (1 << BITS)
    below = None
    for order in range(1, ORDER + 1):
        table, tally = tables[order - 1], tallies[order - 1]
        once, twice = (tally == 1).sum(0), (tally == 2).sum(0)
        discount = np.clip(once / np.maximum(once + 2 * twice, 1), 0.1, 0.95)
        context = table >> BITS
        names, place = np.unique(context, return_inverse=True)
        total, kinds = np.zeros((len(names), width)), np.zeros((len(names), width))
        np.add.at(total, place, tally)
        np.add.at(kinds, place, tally > 0)
        share = np.where(total > 0, discount * kinds / np.maximum(total, 1e-12), 1.0)
        if order == 1:
            lower = np.full((len(table), width), uniform)
        else:
            lower = below[np.searchsorted(tables[order - 2], table & ((1 << BITS * (order - 1)) - 1))]
        p = np.where(total[place] > 0, np.maximum(tally - discount, 0) / np.maximum(total[place], 1e-12), 0) + share[place] * lower
        below = p
        grams.append(table.astype(np.int32))
        logs.append(np.log(p).astype(np.float32))
        # weights by context: of order 1 the empty context, else a gram of the order below
        if order == 1:
            empty = np.log(share[0]).astype(np.float32) if len(names) else np.zeros(width, np.float32)
        else:
            weight = np.zeros((len(tables[order - 2]), width), np.float32)
            at = np.searchsorted(tables[order - 2], names)
            at[at == len(tables[order - 2])] = 0
            same = tables[order - 2][at] == names
            weight[at[same]] = np.log(share[same])
            backs.append(weight)
    backs.append(empty)
    return Models(languages, grams, logs, backs, np.zeros(width), np.ones(width))


def train(docs: DataFrame) -> Models:
    """From all texts with a language that are not held out."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs = b.column(0).to_pylist()
            names = sorted(set(langs))
            gram, offsets, _ = stream(texts(b.column(1)))
            code = {x: k for k, x in enumerate(names)}
            own = np.repeat(np.array([code[x] for x in langs], np.int64), np.diff(offsets))
            key, n = np.unique((own << 32) | gram, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.DictionaryArray.from_arrays(pa.array((key >> 32).astype(np.int32)), pa.array(names, pa.string())).cast(pa.string()), pa.array((key & 0xFFFFFFFF).astype(np.int32)), pa.array(n.astype(np.int64))], names=["lang", "gram", "n"])

    # at most 64**ORDER n-grams for each language, whatever the corpus
    counts = rows.mapInArrow(count, "lang string, gram int, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    if not counts.num_rows:
        return Models([], [np.zeros(0, np.int32)] * ORDER, [np.zeros((0, 0), np.float32)] * ORDER, [np.zeros((0, 0), np.float32)] * ORDER, np.zeros(0), np.ones(0))
    encoded = counts.column("lang").combine_chunks().dictionary_encode()
    found = encoded.dictionary.to_pylist()
    languages = sorted(found)
    place = np.array([languages.index(x) for x in found])[encoded.indices.to_numpy()]
    models = estimate(languages, place, counts.column("gram").to_numpy().astype(np.int64), counts.column("n").to_numpy().astype(float))
    return _calibrated(models, rows, spark)


def _calibrated(models: Models, rows: DataFrame, spark) -> Models:  # noqa: ANN001
    """Median and deviation of the cross-entropies of all training texts, language by language; batches send counts by bins."""
    shared = spark.sparkContext.broadcast(models)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place_of = {x: k for k, x in enumerate(shared.value.languages)}
        for b in batches:
            entropy, n, _ = shared.value.entropies(texts(b.column(1)))
            place = np.array([place_of[x] for x in b.column(0).to_pylist()], np.int64)
            ok = n >= 100
            if not ok.any():
                continue
            place, entropy = place[ok], entropy[np.arange(len(place)), place][ok]
            key, at = np.unique(np.stack([place, np.floor(entropy / BIN).astype(np.int64)]), axis=1, return_inverse=True)
            at = at.reshape(-1)
            tally = [np.bincount(at, w, key.shape[1]) for w in (np.ones(len(at)), entropy, entropy**2)]
            yield pa.RecordBatch.from_arrays([pa.array(key[0].astype(np.int32)), pa.array(key[1].astype(np.int32)), pa.array(tally[0].astype(np.int64)), *map(pa.array, tally[1:])], names=["place", "bin", "n", "total", "squares"])

    # at most as many rows as there are bins, whatever the corpus
    found = rows.mapInArrow(measure, "place int, bin int, n long, total double, squares double").groupBy("place", "bin").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.sum("squares").alias("squares")).toPandas()
    mean, deviation = np.full(len(models.languages), np.inf), np.ones(len(models.languages))
    for k in range(len(models.languages)):
        own = found[found["place"] == k].sort_values("bin")
        n = int(own["n"].sum())
        upto = own["n"].cumsum().to_numpy()
        middle = [own["bin"].iloc[int(np.searchsorted(upto, r, side="right"))] for r in ((n - 1) // 2, n // 2)] if n else []
        mean[k] = (np.mean(middle) + 0.5) * BIN if n else 3.0
        average = own["total"].sum() / max(n, 1)
        deviation[k] = max(max(own["squares"].sum() / n - average**2, 0.0) ** 0.5 if n > 1 else 0.5, 0.05)
    models.mean, models.deviation = mean, deviation
    return models


def identify(docs: DataFrame, models: Models) -> DataFrame:
    """doc_id, held_out, lang_pred and score for every row."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(models)
    key = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lang, score = shared.value.predict(texts(b.column(1)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lang, pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"])

    out = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {key}, lang_pred string, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
