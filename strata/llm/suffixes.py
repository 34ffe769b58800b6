"""Removal of every byte that a repeated string of LENGTH bytes covers, by a depth-limited radix sort of suffixes.

Two suffixes matter only through their first LENGTH bytes, and only if these are equal. The first digit of a suffix is its
anchor: of the GRAM-byte strings in its first LENGTH bytes the one with the smallest hash, leftmost among equals. It is a
function of those bytes alone, so equal windows have equal anchors at equal offsets, and neighbouring suffixes share theirs;
one row for each run of suffixes with one anchor stands for about 170 of them. The first pass deals these rows out by
anchor and drops anchors that occur once. A run whose bytes are repeated as a whole, by their 128-bit digest, is settled.
Runs that are left get their bytes, are gathered by anchor, and their suffixes are ordered by most-significant-digit passes
over the bytes themselves, DIGIT bytes a pass; a suffix that is alone in its group drops out after each pass. Suffixes that
share a group after the last pass agree in every byte: they are exactly the repeated windows.

An anchor with more than GROUP_MOST different runs is never gathered: its suffixes go on as rows, and are grouped by the
128-bit digests of their first LENGTH bytes, with counts that are added up before the shuffle. A run goes to every worker
with its own bytes only, so neither path needs more memory for a larger corpus.

Null text is empty; a text of fewer than LENGTH bytes keeps all. A very long text is taken in pieces that overlap by
LENGTH - 1 bytes. Rows may repeat; equal rows repeat each other's text and lose it. An empty table gives an empty result.
Of the columns of docs only doc_id and text are read, whatever the others are named.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import flat, free, maybe_in, mix64, sha, small_batches, stored

LENGTH, GRAM, DIGIT = 400, 64, 8
GROUP_MOST = 2000
#: Bytes that a worker looks at together; longer texts are taken in pieces that overlap by LENGTH - 1.
_PIECE = 1 << 20
_PLACE = 28  # bits for a place in a piece; the other bits of a value to be minimised come from the hash
_KEY = ["key", "key2"]
_P = 0x9E3779B97F4A7C15 | 1
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """p**i and p**-i modulo 2**64 for i below n."""
    if len(_POWERS.get("up", ())) < n:
        size = max(n, 2 * _PIECE)
        for name, factor in (("up", _P), ("down", pow(_P, -1, 1 << 64))):
            x = np.full(size, factor, np.uint64)
            x[0] = 1
            _POWERS[name] = np.multiply.accumulate(x)
    return _POWERS["up"][:n], _POWERS["down"][:n]


class Hashes:
    """Hashes of any substring of one piece of bytes, the same wherever the substring stands."""

    def __init__(self, data: np.ndarray) -> None:
        up, self.down = _powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=self.sums[1:])

    def of(self, start: np.ndarray | slice, end: np.ndarray | slice) -> np.ndarray:
        return mix64((self.sums[end] - self.sums[start]) * self.down[start])


def anchors(data: np.ndarray, hashes: Hashes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """For every start of a window in data: the anchor's place; and the hash of the gram at every place."""
    n, wide = len(data), length - gram + 1
    own = hashes.of(slice(0, n - gram + 1), slice(gram, n + 1))
    value = (own >> np.uint64(_PLACE) << np.uint64(_PLACE)) | np.arange(len(own), dtype=np.uint64)
    blocks = -(-len(value) // wide)
    padded = np.full(blocks * wide, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(value)] = value
    grid = padded.reshape(blocks, wide)
    ahead = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(grid, axis=1).ravel()
    least = np.minimum(ahead[: n - length + 1], behind[wide - 1 : wide - 1 + n - length + 1])
    return (least & np.uint64((1 << _PLACE) - 1)).astype(np.int64), own


def _pieces(offsets: np.ndarray, length: int) -> Iterator[list[tuple[int, int, int]]]:
    """Lists of (row, start, end) in the flat buffer, about _PIECE bytes each."""
    held, size = [], 0
    for row in range(len(offsets) - 1):
        at, end = int(offsets[row]), int(offsets[row + 1])
        while end - at >= length:
            stop = min(end, at + _PIECE)
            held.append((row, at, stop))
            size += stop - at
            if size >= _PIECE:
                yield held
                held, size = [], 0
            if stop == end:
                break
            at = stop - length + 1
    if held:
        yield held


def _digests(data: bytes, starts: list[int], ends: list[int]) -> np.ndarray:
    """128 bits for each part of data, as two columns of longs."""
    digest = xxhash.xxh3_128_digest
    return np.frombuffer(b"".join([digest(data[a:z]) for a, z in zip(starts, ends)]), np.int64).reshape(-1, 2)


def _runs(length: int, gram: int):  # noqa: ANN202
    names = ["akey", "c1", "c2", *_KEY, "s1", "s2"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            key, key2, (data, offsets) = b.column(0).to_numpy(), b.column(1).to_numpy(), flat(b.column(2))
            for pieces in _pieces(offsets, length):
                part = np.concatenate([data[a:z] for _, a, z in pieces])
                sizes = np.array([z - a for _, a, z in pieces])
                begins = np.cumsum(sizes) - sizes
                place, own = anchors(part, Hashes(part), length, gram)
                piece = np.repeat(np.arange(len(pieces)), sizes)
                inside = np.flatnonzero(piece[: len(place)] == piece[length - 1 :])
                # a run: neighbouring starts with one anchor in one piece
                first = np.concatenate([[True], (np.diff(inside) != 1) | (place[inside][1:] != place[inside][:-1])])
                s1 = inside[first]
                s2 = inside[np.append(np.flatnonzero(first)[1:] - 1, len(inside) - 1)]
                akey = own[place[s1]]
                whole = _digests(part.tobytes(), s1.tolist(), (s2 + length).tolist())
                of = piece[s1]
                row = np.array([r for r, _, _ in pieces])[of]
                shift = np.array([a for _, a, _ in pieces])[of] - begins[of] - offsets[row]
                columns = (akey.view(np.int64), whole[:, 0], whole[:, 1], key[row], key2[row], (s1 + shift).astype(np.int64), (s2 + shift).astype(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    return run


_CONTEXT = {"akey": pa.int64(), "key": pa.int64(), "key2": pa.int64(), "s1": pa.int64(), "open": pa.bool_(), "hot": pa.bool_(), "bytes": pa.binary()}


def _contexts(length: int):  # noqa: ANN202
    """From (keys, text, runs of this text that are needed) the bytes of each run."""

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(_CONTEXT.values())], names=list(_CONTEXT))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            size = 0
            for key, key2, text, needed in zip(*(b.column(k).to_pylist() for k in range(4))):
                raw = (text or "").encode()
                for x in needed:
                    out.append((x["akey"], key, key2, x["s1"], x["open"], x["hot"], raw[x["s1"] : x["s2"] + length]))
                    size += len(out[-1][-1])
                    if size > 4 * _PIECE:
                        yield batch(out)
                        out, size = [], 0
            yield batch(out)

    return run


class Suffixes:
    """All windows of some contexts: the context of each, its place in the joined bytes, and these."""

    def __init__(self, contexts: list[bytes], length: int) -> None:
        sizes = np.array([len(c) for c in contexts], np.int64)
        self.begins = np.cumsum(sizes) - sizes
        counts = sizes - length + 1
        self.member = np.repeat(np.arange(len(contexts)), counts)
        self.place = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts) + self.begins[self.member]
        self.raw = b"".join(contexts)
        self.data = np.frombuffer(self.raw, np.uint8)

    def words(self) -> np.ndarray:
        """The DIGIT bytes from every place on, as a big-endian number; zeros follow the end."""
        padded = np.concatenate([self.data, np.zeros(DIGIT, np.uint8)])
        out = np.zeros(len(self.data), np.uint64)
        for k in range(DIGIT):
            out = out << np.uint64(8) | padded[k : k + len(out)].astype(np.uint64)
        return out


def repeated(group: np.ndarray, place: np.ndarray, words: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Rows whose windows have a partner with equal bytes in their group, by passes from the most significant digit on."""
    alive = np.argsort(group, kind="stable")
    group = group[alive]
    for at in (None, *range(0, max(length - DIGIT, 0), DIGIT), max(length - DIGIT, 0)):  # the last digit may overlap the one before
        if at is not None:
            digit = words[place[alive] + at]
            if length < DIGIT:
                digit = digit >> np.uint64(8 * (DIGIT - length))
            new = np.concatenate([[True], group[1:] != group[:-1]])
            of = np.cumsum(new) - 1
            odd = digit != digit[new][of]
            if not odd.any():
                continue
            # only groups whose digits differ are sorted; the others stay as they are
            rows = np.flatnonzero(np.bincount(of, odd)[of] > 0)
            order = rows[np.lexsort((digit[rows], of[rows]))]
            alive[rows], digit[rows], of[rows] = alive[order], digit[order], of[order]
            group = np.cumsum(np.concatenate([[True], (of[1:] != of[:-1]) | (digit[1:] != digit[:-1])])) - 1
        else:
            group = np.cumsum(np.concatenate([[True], group[1:] != group[:-1]])) - 1 if len(group) else group
        many = np.bincount(group)[group] > 1 if len(group) else np.zeros(0, bool)
        alive, group = alive[many], group[many]
        if not len(alive):
            break
    return alive


def _first_digit(own: Suffixes, length: int, gram: int) -> np.ndarray:
    """Anchor and the window's offset from it, found again from the window itself. Groups that meet here by chance part later."""
    at, grams = anchors(own.data, Hashes(own.data), length, gram)
    return mix64(grams[at[own.place]] ^ mix64(at[own.place] - own.place + 1))


def _radix(length: int, gram: int):  # noqa: ANN202
    def settle(rows: list[tuple]) -> pa.RecordBatch:
        own = Suffixes([r[4] for r in rows], length)
        hit = np.sort(repeated(_first_digit(own, length, gram), own.place, own.words(), length))
        hit = hit[np.array([r[5] for r in rows], bool)[own.member[hit]]]
        key, key2, s1 = (np.array([r[k] for r in rows], np.int64) for k in (1, 2, 3))
        of = own.member[hit]
        start = own.place[hit] - own.begins[of] + s1[of]
        first = np.concatenate([[True], (of[1:] != of[:-1]) | (start[1:] != start[:-1] + 1)]) if len(hit) else np.zeros(0, bool)
        last = np.append(np.flatnonzero(first)[1:] - 1, len(hit) - 1) if len(hit) else np.zeros(0, np.int64)
        columns = (key[of[first]], key2[of[first]], start[first].astype(np.int64), (start[last] + length).astype(np.int64))
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[*_KEY, "start", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for b in batches:
            for r in zip(*(b.column(k).to_pylist() for k in range(6))):
                if size > _PIECE and r[0] != held[-1][0]:
                    yield settle(held)
                    held, size = [], 0
                held.append(r)
                size += len(r[4])
        if held:
            yield settle(held)

    return run


def _window_rows(length: int):  # noqa: ANN202
    names = ["d1", "d2", *_KEY, "start", "open"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 256):
                part = b.slice(k, 256)
                own = Suffixes(part.column(4).to_pylist(), length)
                whole = _digests(own.raw, own.place.tolist(), (own.place + length).tolist())
                key, key2, s1, is_open = (part.column(c).to_numpy(zero_copy_only=False) for c in (1, 2, 3, 5))
                start = own.place - own.begins[own.member] + s1[own.member]
                columns = (whole[:, 0], whole[:, 1], key[own.member], key2[own.member], start.astype(np.int64), is_open[own.member].astype(bool))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    return run


def covered(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, group_most: int = GROUP_MOST) -> DataFrame:
    """key, key2, start, end: intervals of bytes to remove, for rows (key, key2, text) of docs; the intervals may overlap. The
    two keys are longs that stand for the row's content."""
    small_batches(docs.sparkSession)
    end = F.col("s2") + length
    runs = stored(docs.where(F.octet_length("text") >= length).select(*_KEY, "text").mapInArrow(_runs(length, gram), "akey long, c1 long, c2 long, key long, key2 long, s1 long, s2 long"))
    # any run of a kind can stand for it: their bytes are equal
    kinds = stored(runs.groupBy("akey", "c1", "c2").agg(F.count("*").alias("n"), *[F.first(c).alias(c) for c in (*_KEY, "s1", "s2")]))
    twice = stored(kinds.where("n > 1").select("akey", "c1", "c2"))
    whole = stored(maybe_in(runs, twice, ["c1", "c2"]).join(twice, ["akey", "c1", "c2"], "left_semi").select(*_KEY, F.col("s1").alias("start"), end.alias("end")))
    free(runs, twice)
    # anchors with several different runs, some of which occur once
    shared = stored(kinds.groupBy("akey").agg(F.count("*").alias("d"), F.min("n").alias("least")).where("d > 1 and least = 1").select("akey", "d"))
    need = maybe_in(kinds, shared, ["akey"]).join(shared, "akey")
    need = need.select(*_KEY, F.struct("akey", "s1", "s2", (F.col("n") == 1).alias("open"), (F.col("d") > group_most).alias("hot")).alias("x"))
    need = stored(need.groupBy(*_KEY).agg(F.collect_list("x").alias("needed")))  # at most as many as the text has bytes
    free(kinds, shared)
    texts = maybe_in(docs.select(*_KEY, "text"), need, _KEY).join(need, _KEY).dropDuplicates(_KEY)
    kinds_of = "akey long, key long, key2 long, s1 long, open boolean, hot boolean, bytes binary"
    contexts = stored(texts.select(*_KEY, "text", "needed").mapInArrow(_contexts(length), kinds_of))
    columns = ["akey", *_KEY, "s1", "bytes", "open"]
    settled = contexts.where("not hot").select(*columns).repartition("akey").sortWithinPartitions("akey").mapInArrow(_radix(length, gram), "key long, key2 long, start long, end long")
    rows = contexts.where("hot").select(*columns).mapInArrow(_window_rows(length), "d1 long, d2 long, key long, key2 long, start long, open boolean")
    again = rows.groupBy("d1", "d2").agg(F.count("*").alias("n")).where("n > 1").select("d1", "d2")
    hot = rows.where("open").join(again, ["d1", "d2"], "left_semi").select(*_KEY, "start", (F.col("start") + length).alias("end"))
    rest = stored(settled.unionByName(hot))
    free(need, contexts)
    return whole.unionByName(rest)


_RESULT = "kept binary, n_bytes long, n_removed long, n_spans long, spans array<struct<start: long, end: long>>, kept_sha256 string"


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """For each row of docs: doc_id, kept (bytes), n_bytes, n_removed, n_spans, spans (start, end), kept_sha256."""
    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    # 128 bits for a row's content
    keyed = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("key"), F.xxhash64(F.lit(1), "doc_id", "text").alias("key2"), F.coalesce("text", F.lit("")).alias("text"))
    # intervals of one document, at most as many as it has bytes
    spans = stored(covered(keyed, length).groupBy(*_KEY).agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("spans")))
    marked = maybe_in(keyed, spans, _KEY, flag="hit")  # only texts that may lose something are shuffled
    hit = marked.where("hit").join(spans, _KEY, "left").select("doc_id", "text", "spans")
    joined = hit.unionByName(marked.where("not hit").select("doc_id", "text", F.lit(None).cast(spans.schema["spans"].dataType).alias("spans")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[] for _ in range(6)]
            for text, found in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                raw, merged = text.encode(), []
                for x in found or ():
                    if merged and x["start"] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], x["end"])
                    else:
                        merged.append([x["start"], x["end"]])
                left, at = [], 0
                for s, e in merged:
                    left.append(raw[at:s])
                    at = e
                kept = b"".join([*left, raw[at:]])
                for column, value in zip(out, (kept, len(raw), len(raw) - len(kept), len(merged), [{"start": s, "end": e} for s, e in merged], sha(kept))):
                    column.append(value)
            types = (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, t) for c, t in zip(out, types))], names=["doc_id", "kept", "n_bytes", "n_removed", "n_spans", "spans", "kept_sha256"])

    return joined.mapInArrow(run, f"doc_id {kind}, {_RESULT}")
