"""Quality rules: document statistics, fixed base rules, and a verdict by gradient-boosted trees.

Words are maximal runs of bytes other than space and the control characters 9 to 13. All statistics are computed for a
whole Arrow batch at once on the flat UTF-8 buffer. A document without words (null, empty or blank text) fails the base
rules. Repeated rows each get their own equal result; extra columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType

from strata.llm import trees
from strata.llm.common import columns_of, flat, mix64, small_batches, whole_row

#: Fixed values of the base rules.
WINDOW, MIN_WORDS, MAX_REPEAT_PERCENT = 8, 20, 30
#: The trees are fitted on at most so many labelled documents, those with the smallest hashed ids.
FIT_ROWS = 20_000
#: The trees reject a document if label 1 is less likely than this.
KEEP_AT = 0.5

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_HEAD = (np.arange(256) & 0xC0) != 0x80  # first byte of a code point
_DIGIT = (np.arange(256) >= 48) & (np.arange(256) <= 57)
_UPPER = (np.arange(256) >= 65) & (np.arange(256) <= 90)
_PUNCT = np.zeros(256, bool)
_PUNCT[list(b".,!?;:")] = True

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = ["log_words", "word_length", "symbols", "dup_lines", "repeats", "digits", "upper", "punctuation", "lines", "distinct", "long_words"]
#: Label 1 (good) may only get less likely with these.
MONOTONE = np.array([0, 0, -1, -1, -1, 0, -1, 0, 0, 0, 0])


def statistics(column: pa.Array) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Counts by name and the matrix of features, a row for each text."""
    data, offsets = flat(column)
    n, raw = len(column), data.tobytes()
    per = lambda table: np.diff(np.concatenate([[0], np.cumsum(table[data], dtype=np.int64)])[offsets])
    chars, spaces, symbols = per(_HEAD), per(_SPACE), per(_SYMBOL)
    ids, doc, lengths = [], [], []
    seen: dict[bytes, int] = {}
    n_words, dup_lines, n_lines = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i in range(n):
        text = raw[offsets[i] : offsets[i + 1]]
        words = text.split()
        n_words[i] = len(words)
        ids += [seen.setdefault(w, len(seen)) for w in words]
        lines = [x for x in text.split(b"\n") if x and not x.isspace()]
        n_lines[i], dup_lines[i] = len(lines), len(lines) - len(set(lines))
    word, starts = np.array(ids, np.int64), np.concatenate([[0], np.cumsum(n_words)])
    doc = np.repeat(np.arange(n), n_words)
    lengths = np.array([len(w) for w in seen] or [0])
    repeat = np.zeros(n, np.int64)
    total = len(word)
    if total >= WINDOW:
        # a window's key: its words and its document, mixed into 64 bits
        base = mix64(word + 1)
        key = mix64(doc[: total - WINDOW + 1] + 0x51ED27)
        for k in range(WINDOW):
            key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + base[k : total - WINDOW + 1 + k])
        whole = np.flatnonzero(doc[: total - WINDOW + 1] == doc[WINDOW - 1 :])
        order = whole[np.argsort(key[whole], kind="stable")]
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(total + 1, np.int64)
        twice[order[1:][same]] = 1
        twice[order[:-1][same]] = 1
        sums = np.concatenate([np.zeros(WINDOW, np.int64), np.cumsum(twice[:total])])
        covered = sums[WINDOW:] - sums[:-WINDOW] > 0  # a window that starts at most WINDOW - 1 words before
        repeat = np.bincount(doc, covered, n).astype(np.int64)
    distinct = np.bincount(np.unique(doc * max(len(seen), 1) + word) // max(len(seen), 1), minlength=n) if total else np.zeros(n, np.int64)
    long_words = np.bincount(doc, lengths[word] > 12, n) if total else np.zeros(n)
    counts = {"n_words": n_words, "word_chars": chars - spaces, "n_symbols": symbols, "n_dup_lines": dup_lines, "n_repeat_words": repeat}
    w, c = np.maximum(n_words, 1), np.maximum(chars, 1)
    x = np.stack([np.log1p(n_words), (chars - spaces) / w, symbols / w, dup_lines / np.maximum(n_lines, 1), repeat / w, per(_DIGIT) / c, per(_UPPER) / c, per(_PUNCT) / w, n_lines / w, distinct / np.sqrt(w), long_words / w], 1)
    return counts, x.astype(np.float64)


def base_failed(counts: dict[str, np.ndarray]) -> np.ndarray:
    return (counts["n_words"] < MIN_WORDS) | (100 * counts["n_repeat_words"] > MAX_REPEAT_PERCENT * counts["n_words"])


def train(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> trees.Forest:
    """Trees for label quality over statistics of labelled docs; without labels of both kinds, a constant that keeps all."""
    small_batches(docs.sparkSession)
    known = labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            _, x = statistics(b.column("text"))
            yield pa.RecordBatch.from_arrays([pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(FEATURES)).cast(pa.list_(pa.float64())), b.column("quality")], names=["x", "quality"])

    # at most fit_rows ids: the broadcast has a fixed bound
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("text", F.col("quality").cast("int").alias("quality")).mapInArrow(run, "x array<double>, quality int").limit(fit_rows).toPandas()
    if not len(rows) or rows["quality"].nunique() < 2:
        return trees.constant(1.0)
    return trees.fit(np.stack(rows["x"].to_numpy()), rows["quality"].to_numpy().astype(float), MONOTONE)


_ADDED = [*COUNTS, "base_failed", "quality_score", "kept"]


def _judged(docs: DataFrame, forest: trees.Forest) -> DataFrame:
    """row (all columns of docs as one), then the counts and base_failed and quality_score."""
    small_batches(docs.sparkSession)
    rows = docs.select(whole_row(docs.columns).alias("row"), F.col("text"))
    schema = StructType([rows.schema["row"], *[StructField(c, LongType()) for c in COUNTS], StructField("base_failed", BooleanType()), StructField("quality_score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts, x = statistics(b.column("text"))
            yield pa.RecordBatch.from_arrays([b.column("row"), *(pa.array(counts[c]) for c in COUNTS), pa.array(base_failed(counts)), pa.array(forest.score(x))], names=["row", *_ADDED[:-1]])

    return rows.mapInArrow(run, schema)


def judge(docs: DataFrame, forest: trees.Forest, keep_at: float = KEEP_AT) -> DataFrame:
    """All columns of docs, then COUNTS, base_failed, quality_score and kept (columns of docs with these names, in any case,
    are replaced)."""
    keep = [c for c in docs.columns if c.lower() not in _ADDED]
    verdict = (~F.col("base_failed") & (F.col("quality_score") >= keep_at)).alias("kept")
    return _judged(docs, forest).select(*columns_of("row", keep), *_ADDED[:-1], verdict)


def filter_documents(docs: DataFrame, labels: DataFrame, keep_at: float = KEEP_AT) -> DataFrame:
    """The documents that pass, with the columns of docs as they are."""
    judged = _judged(docs, train(docs, labels))
    return judged.where(~F.col("base_failed") & (F.col("quality_score") >= keep_at)).select(*columns_of("row", docs.columns))
