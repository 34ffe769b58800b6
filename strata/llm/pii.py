"""Personal data: fixed base patterns, then spans that a classifier adds, trained by weak supervision.

Candidates of five kinds are found by wide patterns: written-out or broken-up forms of the base kinds, and secrets (keys and
tokens). Labelers vote on each candidate: the base pattern, a gazetteer of words near it, its structure (checksum, ranges,
known endings, entropy), its grouping or the assignment it stands in, and words near it that speak against it. A vote is for,
against or no opinion; the base pattern votes for or has no opinion, as a written-out form that it does not know is no sign
against one. Expectation-maximisation over the counts of all vote patterns in the corpus estimates each labeler's reliability
from the votes it casts, and every pattern's probability; with these as soft labels a logistic classifier over votes and
shape is fitted. Both work on counts of patterns, at most 5 * 3**5 * 16 rows however large the corpus, added up before the
shuffle.

Base spans always stay. A candidate that overlaps no base span is added if the classifier's probability reaches ADD_AT; of
candidates that overlap each other the one that starts first counts, the longer one of two that start together.

Null text is empty and has no spans. Very long texts count in full, in time that grows with their length. Equal rows get equal
spans. Only doc_id and text are read, whatever other columns are named; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import sha, small_batches, texts
from strata.llm.toxicity import logistic

KINDS = ["email", "ip", "card", "phone"]
#: Kinds of spans: those of the base patterns, then those that only the classifier finds.
ALL_KINDS = [*KINDS, "secret"]
COUNTS = ["n_email", "n_ip", "n_card", "n_phone"]
ADD_AT = 0.9
LABELERS = 5
_SHAPES = 4

# The base patterns. The look-behinds start a match only where the leftmost match can start, which keeps
# long runs of digits or letters linear.
_DOMAIN = regex.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = regex.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = regex.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = regex.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = regex.compile(r"[0-9]")
_NOT_DIGITS = regex.compile(r"[^0-9]+")

# Wide patterns of candidates. 64 and 63 are the greatest lengths of a mailbox and of a domain's label; no other length is capped.
_AT = regex.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\s?(?:@|[\[({]\s?(?:at|@)\s?[\])}]|\s(?:at|AT)\s)\s?(?:[A-Za-z0-9-]{1,63}+(?:\.|\s\.\s|\s?[\[({]\s?(?:dot|DOT|\.)\s?[\])}]\s?|\s(?:dot|DOT)\s))++[A-Za-z]{2,63}+(?![A-Za-z0-9])")
# What any match of _AT holds.
_AT_SIGN = regex.compile(r"@|[\[({]\s?at\s?[\])}]|\s(?:at|AT)\s\s?[A-Za-z0-9-]{1,63}+\s?(?:[.\[({]|\s?(?:dot|DOT)\s)")
_NUMBERS = regex.compile(r"(?<![0-9])[(+]?[0-9](?:[\x20().:/-]{0,2}[0-9])++(?![0-9])")
_DOTTED = regex.compile(r"(?<![0-9.])[0-9]{1,3}+(?:\s?(?:\[\.\]|\(\.\)|\[dot\]|,)\s?[0-9]{1,3}+){3}(?![0-9])")
_SECRET = regex.compile(r"(?<![A-Za-z0-9_+-])[A-Za-z0-9_+-]{20,}+")

_NEAR = {
    "email": frozenset("email e-mail mail contact write reply address correo courriel mailto".split()),
    "ip": frozenset("ip host server address login from ipv4 adresse".split()),
    "card": frozenset("card visa mastercard credit debit amex payment karte carte tarjeta kreditkarte".split()),
    "phone": frozenset("phone tel telephone call mobile cell fax telefon telefono teléfono téléphone whatsapp sms".split()),
    "secret": frozenset("token secret password passwd pwd passphrase key apikey api_key api-key access_key auth authorization bearer credential credentials passwort contraseña clave".split()),
}
_AGAINST = frozenset("isbn issn version order page pages section build invoice id ref doi total sum year figure table chapter".split())
_HASHES = frozenset("commit sha sha1 sha256 md5 checksum digest hash uuid guid etag revision".split())
_ENDINGS = frozenset("com org net edu gov io info de fr es uk eu ch at it nl be us ca biz dev app me co".split())


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's place in KINDS, end) of the base patterns, sorted."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > free and text[begin - 1] in _LOCAL:
            begin -= 1
        m = _DOMAIN.match(text, at + 1) if begin < at else None
        if m:
            out.append((begin, 0, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = _NOT_DIGITS.sub("", m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NOT_DIGITS.sub("", m.group())) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


@dataclass
class Candidate:
    start: int
    end: int
    kind: int
    votes: tuple[int, ...]
    shape: int


def _code(votes: tuple[int, ...]) -> int:
    code = 0
    for v in votes:
        code = 3 * code + v + 1
    return code


_ASSIGNED = regex.compile(r"[:=]>?\s*[\"'`]?$")


def _entropy(span: str) -> float:
    """Bits a character."""
    n = len(span)
    return -sum(c / n * math.log2(c / n) for c in Counter(span).values())


def _votes(text: str, start: int, end: int, kind: int, strict: bool) -> Candidate:
    span = text[start:end]
    digits = _NOT_DIGITS.sub("", span)
    before = regex.findall(r"[\w-]+", text[max(0, start - 40) : start].lower())[-5:]
    if kind == 0:
        ending = regex.findall(r"[A-Za-z]+", span)[-1:]
        structure = 1 if ending and ending[0].lower() in _ENDINGS else -1
        grouped = 1 if "@" in span else 0
    elif kind == 1:
        parts = regex.findall(r"[0-9]+", span)
        structure = 1 if len(parts) == 4 and all(int(p) <= 255 for p in parts) else -1
        grouped = 1 if "." in span and " " not in span else -1
    elif kind == 2:
        structure = 1 if luhn(digits) else -1
        groups = [len(x) for x in regex.split(r"[^0-9]+", span) if x]
        grouped = 0 if len(groups) == 1 else 1 if groups in ([4, 4, 4, 4], [4, 6, 5]) else -1
    elif kind == 4:
        structure = 1 if _entropy(span) >= 3 and len(digits) * 10 >= len(span) else -1
        grouped = 1 if _ASSIGNED.search(text, max(0, start - 8), start) else -1
    else:
        structure = 1 if 9 <= len(digits) <= 13 else -1
        grouped = 1 if span[0] in "+(" else 0 if regex.search(r"[0-9][ .-][0-9]", span) else -1
    near = 1 if not _NEAR[ALL_KINDS[kind]].isdisjoint(before) else 0
    against = -1 if not (_HASHES if kind == 4 else _AGAINST).isdisjoint(before) else 0
    shape = (len(digits) >= 10) + 2 * (" " in span) + 4 * (not span[-1:].isalnum() or not span[:1].isalnum()) + 8 * (len(span) > 24)
    return Candidate(start, end, kind, (1 if strict else 0, near, structure, grouped, against), shape)


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[Candidate]:
    """Every base span and every wide match that overlaps none, with votes."""
    out = [_votes(text, s, e, k, True) for s, k, e in base]
    wide = []
    if ("@" in text or "at" in text or "AT" in text) and _AT_SIGN.search(text):
        wide += [(m.start(), -m.end(), 0) for m in _AT.finditer(text)]
    if _DIGIT.search(text):
        wide += [(m.start(), -m.end(), 1) for m in _DOTTED.finditer(text)]
        for m in _NUMBERS.finditer(text):
            n = len(_NOT_DIGITS.sub("", m.group()))
            if 7 <= n <= 19:
                wide.append((m.start(), -m.end(), 2 if n >= 13 else 3))
        wide += [(m.start(), -m.end(), 4) for m in _SECRET.finditer(text) if not m.group().isdigit() and _DIGIT.search(m.group())]
    # base spans sorted by start, and the furthest end up to each
    starts, furthest = [s for s, _, _ in base], []
    for _, _, e in base:
        furthest.append(max(e, furthest[-1]) if furthest else e)
    free = 0
    for s, e, k in sorted(wide):
        before = bisect_right(starts, -e - 1)  # base spans that start before this one ends
        if s >= free and not (before and furthest[before - 1] > s):
            out.append(_votes(text, s, -e, k, False))
            free = -e
    return out


@dataclass
class Model:
    reliability: dict[int, np.ndarray] = field(default_factory=dict)  # kind -> class x labeler x vote
    weights: dict[int, tuple[np.ndarray, float]] = field(default_factory=dict)

    def probability(self, c: Candidate) -> float:
        if c.kind not in self.weights:
            return 0.0
        w, b = self.weights[c.kind]
        return float(1 / (1 + np.exp(-np.clip(_row(c.votes, c.shape) @ w + b, -30, 30))))


def _row(votes: tuple[int, ...], shape: int) -> np.ndarray:
    return np.array([*(v == 1 for v in votes), *(v == -1 for v in votes), *(shape >> k & 1 for k in range(_SHAPES))], float)


def reliabilities(votes: np.ndarray, count: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """EM for independent labelers: (class x labeler x vote) probabilities of a vote that is cast, and each pattern's
    probability of class 1. No opinion says nothing about the class."""
    p = 1 / (1 + np.exp(-1.5 * votes.sum(1)))
    cast = votes != 0
    table = np.zeros((2, votes.shape[1], 3))
    for _ in range(rounds):
        share = np.stack([(1 - p) * count, p * count])
        # as much as one vote for each value; a labeler is taken to be right more often than not
        table[:, :, 0], table[:, :, 2] = share @ (votes == -1) + [[1.5], [0.5]], share @ (votes == 1) + [[0.5], [1.5]]
        table /= table.sum(2, keepdims=True)
        prior = (share.sum(1) + 1) / (count.sum() + 2)
        logs = np.stack([np.log(prior[c]) + np.where(cast, np.log(np.where(cast, table[c][np.arange(votes.shape[1]), votes + 1], 1)), 0).sum(1) for c in (0, 1)])
        new = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -30, 30)))
        if np.abs(new - p).max() < 1e-6:
            break
        p = new
    return table, p


def train(docs: DataFrame) -> Model:
    small_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table: dict[tuple[int, int, int], int] = {}
        for b in batches:
            for text in texts(b.column(0)):
                for c in candidates(text, base_spans(text)):
                    key = (c.kind, _code(c.votes), c.shape)
                    table[key] = table.get(key, 0) + 1
        keys = list(table)
        yield pa.RecordBatch.from_arrays([*(pa.array([k[i] for k in keys], pa.int32()) for i in range(3)), pa.array(list(table.values()), pa.int64())], names=["kind", "code", "shape", "n"])

    rows = docs.select("text").mapInArrow(count, "kind int, code int, shape int, n long").groupBy("kind", "code", "shape").agg(F.sum("n").alias("n")).orderBy("kind", "code", "shape").toPandas()
    model = Model()
    for kind, own in rows.groupby("kind"):
        votes = np.array([[code // 3 ** (LABELERS - 1 - k) % 3 - 1 for k in range(LABELERS)] for code in own["code"]])
        n = own["n"].to_numpy(float)
        table, p = reliabilities(votes, n)
        x = np.stack([_row(tuple(v), s) for v, s in zip(votes, own["shape"])])
        model.reliability[int(kind)] = table
        model.weights[int(kind)] = logistic(x, p, n)
    return model


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{ALL_KINDS[k]}:{s}:{e}" for s, k, e in spans)


def find_spans(docs: DataFrame, model: Model, add_at: float = ADD_AT) -> DataFrame:
    """doc_id, counts and digest of the base spans, all spans, and how many were added or are there at all, for every row."""
    small_batches(docs.sparkSession)
    key = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple, float] = {}
        for b in batches:
            counts, digest, joined, added, total = [[] for _ in KINDS], [], [], [], []
            for text in texts(b.column(1)):
                base = base_spans(text)
                more = []
                for c in candidates(text, base)[len(base) :]:
                    pattern = (c.kind, c.votes, c.shape)
                    if pattern not in known:
                        known[pattern] = model.probability(c)
                    if known[pattern] >= add_at:
                        more.append((c.start, c.kind, c.end))
                for k in range(len(KINDS)):
                    counts[k].append(sum(1 for s in base if s[1] == k))
                digest.append(sha(_joined(base)))
                joined.append(_joined(sorted(base + more)))
                added.append(len(more))
                total.append(len(base) + len(more))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(digest, pa.string()), pa.array(joined, pa.string()), pa.array(added, pa.int64()), pa.array(total, pa.int64())], names=["doc_id", *COUNTS, "base_sha256", "spans", "n_added", "n_spans"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {key}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long, n_spans long")
