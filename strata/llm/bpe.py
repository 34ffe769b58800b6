"""BPE encoding and decoding with batched merge rounds in numpy.

The vocabulary comes from a tokenizer file of the kind "BPE with word ends, lower case, white space dropped"; the driver
reads it once and ships its arrays. The distinct words of a batch that are not yet known to a worker are laid out as one
flat array of symbol ids. Each round forms the keys of all adjacent pairs, finds their ranks by binary search in the sorted
pair keys, and merges every leftmost non-overlapping pair that has its word's lowest rank, in all words at once. A known
word is never merged again while it stays in the worker's bounded table.

Null text counts as empty; an empty text has no tokens and decodes to an empty string.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from strata.llm.common import sha, small_batches, texts

#: A worker's table of known words is emptied when it has grown to so many.
TABLE_WORDS = 300_000
#: Code points that have long been assigned, so that all libraries agree on their classes.
_SETTLED = r"\u0000-\u052f\u1e00-\u1eff\u2010-\u2027\u2030-\u205e\u20ac\u2122\u3001-\u3011\u4e00-\u9fa5\uac00-\ud7a3"
_NONE = np.iinfo(np.int64).max


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_letters() -> list[str]:
    """The printable stand-in of every byte: itself if printable in Latin-1, else the next code point from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = (chr(256 + i) for i in range(256))
    return [chr(b) if b in printable else next(rest) for b in range(256)]


class Bpe:
    """Encoder and decoder over one vocabulary; plain arrays and dictionaries, so that it can be broadcast."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab: dict[str, int] = spec["model"]["vocab"]
        self.end = spec["model"]["end_of_word_suffix"] or ""
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        letters = _byte_letters()
        self.inner = np.array([vocab[x] for x in letters], np.int64)
        self.last = np.array([vocab[x + self.end] for x in letters], np.int64)
        self.size = max([*vocab.values(), *self.special.values()]) + 1
        self.token = [""] * self.size
        for t, i in [*vocab.items(), *self.special.items()]:
            self.token[i] = t
        pairs = [x if isinstance(x, list) else x.split(" ") for x in spec["model"]["merges"]]
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        first = np.sort(np.unique(keys, return_index=True)[1])
        order = first[np.argsort(keys[first], kind="stable")]
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made[order]
        # Merging all pairs of a rank at once is right only if what a merge makes takes part in later merges alone.
        newest = np.full(self.size, -1, np.int64)
        np.maximum.at(newest, made, np.arange(len(made)))
        rank = np.arange(len(keys))
        self.in_order = bool((newest[keys // self.size] < rank).all() and (newest[keys % self.size] < rank).all())
        self.known: dict[str, tuple[int, str, str]] = {}
        self._ready = False

    def __getstate__(self) -> dict:
        return self.__dict__ | {"known": {}, "_ready": False}

    def _prepare(self) -> None:
        if not self._ready:
            self._words = regex.compile(self.pattern)
            self._parts = regex.compile("(" + "|".join(regex.escape(x) for x in self.special) + ")") if self.special else None
            self._other = regex.compile(f"[^{_SETTLED}]")
            self._ready = True

    def words(self, text: str) -> list[str]:
        """The words that are merged one by one, special strings among them as they are."""
        self._prepare()
        if self._parts is not None and "<|" in text:
            out: list[str] = []
            for part in self._parts.split(text):
                out += [part] if part in self.special else self._split(part)
            return out
        return self._split(text)

    def _split(self, text: str) -> list[str]:
        if not text.isascii():
            if self._other.search(text):
                return self._split_by_library(text)
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # lower-casing goes by single characters
        return self._words.findall(text.lower())

    def _split_by_library(self, text: str) -> list[str]:
        """For characters whose class depends on the edition of Unicode: the library's own normaliser and splitter."""
        from tokenizers import Regex, normalizers, pre_tokenizers

        steps = normalizers.Sequence([normalizers.NFC(), normalizers.Replace(Regex(r"\s+"), " "), normalizers.Lowercase()])
        return [w for w, _ in pre_tokenizers.Split(Regex(self.pattern), "removed", invert=True).pre_tokenize_str(steps.normalize_str(text))]

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all words in one array, and the len(words) + 1 offsets."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        lengths = np.array([len(x) for x in raw], np.int64)
        data = np.frombuffer(b"".join(raw), np.uint8)
        owner = np.repeat(np.arange(len(words)), lengths)
        symbol = self.inner[data]
        ends = np.cumsum(lengths)[lengths > 0] - 1
        symbol[ends] = self.last[data[ends]]
        done_owner, done_place, done_symbol = [], [], []
        place = np.arange(len(symbol))
        while len(symbol):
            key = symbol[:-1] * self.size + symbol[1:]
            at = np.searchsorted(self.keys, key)
            at[at == len(self.keys)] = 0
            hit = (self.keys[at] == key) & (owner[:-1] == owner[1:])
            rank = np.where(hit, self.ranks[at], _NONE)
            starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            lowest = np.minimum.reduceat(np.append(rank, _NONE), starts)
            sizes = np.diff(np.append(starts, len(symbol)))
            # the last symbol of a word holds no pair of the word, so the next word's pairs stay out
            low = np.repeat(lowest, sizes)
            finished = low == _NONE
            if finished.any():
                done_owner.append(owner[finished])
                done_place.append(place[finished])
                done_symbol.append(symbol[finished])
            take = np.append((rank == low[:-1]) & (rank != _NONE), False)
            if not take.any():
                break
            if self.in_order:
                chosen = np.flatnonzero(take)
                new_run = np.concatenate([[True], np.diff(chosen) != 1])
                run_start = chosen[new_run][np.cumsum(new_run) - 1]
                chosen = chosen[(chosen - run_start) % 2 == 0]
            else:
                chosen = np.flatnonzero(take)
                chosen = chosen[np.concatenate([[True], owner[chosen][1:] != owner[chosen][:-1]])]
            symbol = symbol.copy()
            symbol[chosen] = self.made[at[chosen]]
            stay = ~finished
            stay[chosen + 1] = False
            symbol, owner, place = symbol[stay], owner[stay], place[stay]
        if not done_symbol:
            return np.zeros(0, np.int64), np.zeros(len(words) + 1, np.int64)
        all_place = np.concatenate(done_place)
        order = np.argsort(all_place, kind="stable")
        ids = np.concatenate(done_symbol)[order]
        counts = np.bincount(np.concatenate(done_owner), minlength=len(words))
        return ids, np.concatenate([[0], np.cumsum(counts)])

    def learn(self, words: set[str]) -> None:
        """Puts words into the table: how many tokens, their ids as text, the tokens as text."""
        if len(self.known) + len(words) > TABLE_WORDS:
            self.known = {}
        fresh = []
        for w in words:
            if w in self.special:
                self.known[w] = (1, str(self.special[w]), w)
            elif w not in self.known:
                fresh.append(w)
        ids, offsets = self.merge(fresh)
        ids_list, at = ids.tolist(), offsets.tolist()
        for k, w in enumerate(fresh):
            own = ids_list[at[k] : at[k + 1]]
            self.known[w] = (len(own), " ".join(map(str, own)), " ".join([self.token[i] for i in own]))

    def encode(self, text: str) -> list[int]:
        words = self.words(text)
        self.learn(set(words))
        return [int(i) for w in words for i in self.known[w][1].split()]

    def decode(self, ids: list[int]) -> str:
        """As the file's library does without a decoder: the tokens, special ones too, joined by a space."""
        return " ".join(self.token[i] for i in ids)

    def batch(self, texts_: list[str]) -> Iterator[tuple[int, str, str]]:
        """For every text: number of tokens, ids joined by a space, decoded text."""
        split = [self.words(t) for t in texts_]
        distinct = {w for x in split for w in x}
        missing = {w for w in distinct if w not in self.known}
        if missing:
            if len(self.known) + len(missing) > TABLE_WORDS:
                missing = distinct
            self.learn(missing)
        known = self.known
        for own in split:
            rows = [known[w] for w in own]
            yield sum([r[0] for r in rows]), " ".join([r[1] for r in rows]), " ".join([r[2] for r in rows])


def encode_documents(docs: DataFrame, vocabulary: str | None = None, text: str = "text", with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 for every row, and on request the ids as an array (an empty one for no text)."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(Bpe(vocabulary or default_vocabulary()))
    key = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = shared.value
        for b in batches:
            n, ids, back, lists = [], [], [], []
            for count, as_ids, decoded in bpe.batch(texts(b.column(1))):
                n.append(count)
                ids.append(sha(as_ids))
                back.append(sha(decoded))
                if with_ids:
                    lists.append(np.array(as_ids.split(), np.int32))
            columns = [b.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(back, pa.string())]
            yield pa.RecordBatch.from_arrays([*columns, *([pa.array(lists, pa.list_(pa.int32()))] if with_ids else [])], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *(["ids"] if with_ids else [])])

    return docs.select("doc_id", text).mapInArrow(run, f"doc_id {key}, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if with_ids else ""))
