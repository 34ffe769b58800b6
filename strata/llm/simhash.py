"""SimHash near-dedup: fingerprints, and links between them by a Gray-order hierarchical index.

Distinct fingerprints are dealt to groups by exact agreement on one of distance + 1 blocks of bits: two fingerprints that
differ in at most `distance` bits agree on a block. The members of a group are sorted by the Gray rank of the remaining
bits, so that runs of neighbours share masked patterns. The upper nodes of the index are these runs at a few depths; pairs
of nodes are compared from the top, with the differences in their shared patterns added up, and a pair of nodes that exceeds
the distance drops with everything below it. A group reports a spanning forest of its links, never all pairs.

A group with more than GROUP_MOST members is dealt out again by sub-blocks of its remaining bits, which again loses no
link; with every level the bits that are left shrink, so a group ends up bounded whatever the data are.

A text without words (or null) has fingerprint zero and is linked like any other. Equal fingerprints collapse before any
grouping, so a group of exact copies is one member. Rows may repeat; a null doc_id is never a component's id unless the
component has no other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm import minhash
from strata.llm.common import checkpointed, columns_of, flat, free, maybe_in, row_key, same_row, small_batches, stored, whole_row
from strata.llm.graph import components

SHINGLE, SEED, DISTANCE = 3, 42, 2
#: A larger group of distinct fingerprints is dealt out again.
GROUP_MOST = 1024
#: Rows that a worker gathers before it builds an index over their groups.
_ROWS = 1 << 16
#: Bits of a set's parity: each counts the tokens that fall on it, modulo 2.
PARITY = 512
#: Pairs of nodes that a worker compares at once.
_PAIRS = 1 << 20


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    words = text.lower().split()  # bytes: A-Z alone are lower-cased, and exactly 0x20 and 0x09 to 0x0D separate
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, seed)]
    else:
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = (ends - np.array([len(w) + 1 for w in words])).tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], seed) for a, b in zip(starts, (ends[shingle - 1 :] - 1).tolist())]
    return majority(np.array(hashes, np.uint64))


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes."""
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    ones = np.zeros(64, np.int64)
    for k in range(0, len(bits), 255):  # sums of a byte cannot overflow
        ones += bits[k : k + 255].sum(axis=0, dtype=np.uint8)
    return int.from_bytes(np.packbits(2 * ones > len(bits)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """All columns of docs and fp, the fingerprint as a signed long."""
    small_batches(docs.sparkSession)
    keep = [c for c in docs.columns if c != "fp"]
    docs = docs.select(*keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = flat(b.column("text"))
            raw = data.tobytes()
            found = [fingerprint(raw[offsets[i] : offsets[i + 1]], shingle) for i in range(len(offsets) - 1)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.array(found, np.uint64).view(np.int64))], names=[*b.schema.names, "fp"])

    return docs.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + (", " if keep else "") + "fp long")


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Place of a code word in Gray order: bit i is the parity of the bits from i up."""
    x = x.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(shift)
    return x


def _count(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).astype(np.int64)


class GrayIndex:
    """Index over many groups at once: `group` (sorted) and `code` (uint64 with the bits that vary inside a group)."""

    def __init__(self, group: np.ndarray, code: np.ndarray, depths: tuple[int, ...] = (52, 40, 28, 14, 0)) -> None:
        order = np.lexsort((gray_rank(code), group))
        self.order, self.group, self.code = order, group[order], code[order]
        # a node of a depth is a run with equal group and equal upper bits; child[d] has the nodes' first children below
        self.pattern, self.child = [], []
        change = np.concatenate([[True], self.group[1:] != self.group[:-1]]) if len(code) else np.zeros(0, bool)
        firsts = [np.flatnonzero(change)]
        for depth in depths:
            upper = self.code >> np.uint64(depth)
            change = change | np.concatenate([[True], upper[1:] != upper[:-1]])
            firsts.append(np.flatnonzero(change))
            self.pattern.append(upper[firsts[-1]])
        for above, below in zip(firsts, firsts[1:]):
            self.child.append(np.searchsorted(below, np.append(above, len(code))))
        self.leaf = firsts[-1]

    def links(self, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of rows of the input within the distance; equal codes of a group come as one leaf, linked by the caller."""
        roots = np.arange(len(self.child[0]) - 1) if self.child else np.zeros(0, np.int64)
        todo = [(0, roots, roots)]
        while todo:
            level, a, b = todo.pop()
            if level == len(self.child):
                apart = a != b
                yield self.order[self.leaf[a[apart]]], self.order[self.leaf[b[apart]]]
                continue
            child = self.child[level]
            wide, high = child[a + 1] - child[a], child[b + 1] - child[b]
            sizes = wide * high
            total = int(sizes.sum())
            if total > _PAIRS and len(a) > 1:
                half = max(1, min(len(a) - 1, int(np.searchsorted(np.cumsum(sizes), total // 2)) or 1))
                todo += [(level, a[:half], b[:half]), (level, a[half:], b[half:])]
                continue
            pair = np.repeat(np.arange(len(a)), sizes)
            at = np.arange(total) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            left, right = child[a][pair] + at // high[pair], child[b][pair] + at % high[pair]
            pattern = self.pattern[level]
            near = (left <= right) & (_count(pattern[left] ^ pattern[right]) <= distance)
            if near.any():
                todo.append((level + 1, left[near], right[near]))


def forest(n: int, links: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """For each of n rows the smallest row that the links reach."""
    label = np.arange(n)
    for a, b in links:
        while True:
            la, lb = label[a], label[b]
            if (la == lb).all():
                break
            np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
            while (label[label] != label).any():
                label = label[label]
    while (label[label] != label).any():
        label = label[label]
    return label


def _search(distance: int):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps = [], []

        def found(key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
            # bits on which a group agrees cancel out in every difference
            label = forest(len(fp), GrayIndex(key, fp).links(distance))
            other = label != np.arange(len(fp))
            signed = fp.view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(signed[other]), pa.array(signed[label[other]])], names=["u", "v"])

        for b in batches:
            keys.append(b.column(0).to_numpy())
            fps.append(b.column(1).to_numpy().view(np.uint64))
            if sum(map(len, keys)) < _ROWS:
                continue
            key, fp = np.concatenate(keys), np.concatenate(fps)
            cut = int(np.flatnonzero(key != key[-1])[-1]) + 1 if key[0] != key[-1] else 0  # the last group may go on
            keys, fps = [key[cut:]], [fp[cut:]]
            if cut:
                yield found(key[:cut], fp[:cut])
        if sum(map(len, keys)):
            yield found(np.concatenate(keys), np.concatenate(fps))

    return run


def _parts(bits: list[int], n: int) -> list[list[int]]:
    return [bits[len(bits) * k // n : len(bits) * (k + 1) // n] for k in range(n)]


def _mask(bits: list[int]) -> int:
    value = sum(1 << b for b in bits)
    return value - (1 << 64) if value >= 1 << 63 else value


def links(fps: DataFrame, distance: int = DISTANCE, group_most: int = GROUP_MOST) -> DataFrame:
    """u, v: links between distinct fingerprints (column fp) that connect all within the distance."""
    spark = fps.sparkSession
    # each entry: bits that the group agrees on
    paths = [[]]
    rows = fps.select("fp", F.lit(0).alias("path"))
    out: list[DataFrame] = []
    while paths:
        nexts: list[list[int]] = []
        options: list[Column] = []
        for k, fixed in enumerate(paths):
            for part in _parts([b for b in range(64) if b not in fixed], distance + 1):
                path = F.lit(len(nexts))
                nexts.append(sorted([*fixed, *part]))
                key = F.xxhash64(path, F.col("fp").bitwiseAND(F.lit(_mask(nexts[-1]))))
                options.append(F.when(F.col("path") == k, F.struct(path.alias("path"), key.alias("key"))))
        rows = rows.select("fp", F.explode(F.filter(F.array(*options), lambda x: x.isNotNull())).alias("to")).select("fp", "to.path", "to.key")
        sizes = rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
        rows = checkpointed(rows.join(sizes, "key"))
        small = rows.where(F.col("n") <= group_most).select("key", "fp")
        out.append(small.repartition("key").sortWithinPartitions("key").mapInArrow(_search(distance), "u long, v long"))
        rows = rows.where(F.col("n") > group_most).select("fp", "path")
        left = sorted(r["path"] for r in rows.select("path").distinct().collect())  # at most as many as there are choices of blocks
        if not left or all(64 - len(nexts[p]) <= distance for p in left):
            break
        place = F.create_map(*[F.lit(x) for k, p in enumerate(left) for x in (p, k)])
        rows, paths = rows.select("fp", F.element_at(place, F.col("path")).alias("path")), [nexts[p] for p in left]
    edges = out[0]
    for more in out[1:]:
        edges = edges.unionByName(more)
    return edges


def near_groups(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """doc_id, key (of doc_id and text), fp (long), root (a fingerprint that names the group) and component_id, the smallest
    doc_id that links reach from the row; a row for each row of docs."""
    keyed = docs.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("key"), "text")
    marked = checkpointed(fingerprints(keyed, shingle).select("doc_id", "key", "fp"))
    fps = checkpointed(marked.groupBy("fp").agg(F.min("doc_id").alias("least")))
    # a vertex begins with its smallest doc_id, a null one last, so that the smallest vertex of a component names it
    vertex = F.struct(F.col("least").isNull().alias("none"), "least", "fp")
    edges = links(fps, distance)
    for side in ("u", "v"):
        edges = edges.withColumnRenamed(side, "fp").join(fps.select("fp", vertex.alias(side)), "fp").drop("fp")
    roots = components(edges)
    classes = fps.join(roots.select(F.col("u.fp").alias("fp"), F.struct("root.fp", "root.least").alias("root")), "fp", "left")
    classes = checkpointed(classes.select("fp", F.coalesce("root", F.struct("fp", "least")).alias("root")))
    return marked.join(classes, "fp").select("doc_id", "key", "fp", F.col("root.fp").alias("root"), F.col("root.least").alias("component_id"))


def parity(found: np.ndarray) -> np.ndarray:
    """PARITY / 64 longs. Two sets differ in at least as many tokens as their parities in bits."""
    odd = np.bincount((found % np.uint64(PARITY)).astype(np.int64), minlength=PARITY) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _sets(docs: DataFrame, shingle: int, whole: bool) -> DataFrame:
    """doc_id, key, vertex (hash of the set of tokens), n, its size, fp, its fingerprint, parity, and the bands, or the tokens if whole
    (and then no fingerprint and no parity)."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = flat(b.column("text"))
            raw = data.tobytes()
            sets = [minhash.tokens(raw[offsets[i] : offsets[i + 1]], shingle, SEED) for i in range(b.num_rows)]
            vertex = np.array([xxhash.xxh64_intdigest(s.tobytes(), SEED) for s in sets], np.uint64).view(np.int64)
            fp = np.array([0 if whole else majority(s) for s in sets], np.uint64).view(np.int64)
            odd = np.concatenate([np.zeros(0, np.int64), *([] if whole else map(parity, sets))])
            odd = pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * (0 if whole else PARITY // 64)), pa.array(odd))
            out = [(s if whole else minhash.bands(s)).view(np.int64) for s in sets]
            ends = np.cumsum([0, *map(len, out)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int64), *out])))
            columns = [b.column("doc_id"), b.column("key"), pa.array(vertex), pa.array([len(s) for s in sets], pa.int32()), pa.array(fp), odd, lists]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "key", "vertex", "n", "fp", "parity", "hashes"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "key", "text").mapInArrow(run, f"doc_id {kind}, key long, vertex long, n int, fp long, parity array<long>, hashes array<long>")


def _similar(docs: DataFrame, keys: DataFrame, pairs: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """The rows (u, v) of pairs whose sets of tokens are similar, stored. keys: vertex and the key of one row that has it."""
    pairs = stored(pairs)
    wanted = stored(pairs.select(F.col("u").alias("vertex")).unionByName(pairs.select(F.col("v").alias("vertex"))).distinct().join(keys, "vertex"))
    rows = maybe_in(docs, wanted, ["key"]).join(wanted.select("key"), "key", "left_semi").dropDuplicates(["key"])
    sets = stored(_sets(rows, shingle, True).select(F.col("vertex").alias("u"), F.col("hashes").alias("a")))
    both = pairs.join(sets, "u").join(sets.select(F.col("u").alias("v"), F.col("a").alias("b")), "v")
    shared = F.size(F.array_intersect("a", "b"))
    out = stored(both.where(shared >= (F.size("a") + F.size("b") - shared) * similarity - 1e-9).select("u", "v"))
    free(pairs, wanted, sets)
    return out


def similar_groups(docs: DataFrame, shingle: int, similarity: float, distance: int = DISTANCE) -> DataFrame:
    """doc_id, key (of doc_id and text) and root (a vertex that names the group); a row for each row of docs. Links are Jaccard
    similarities of sets of shingles, checked on full sets; texts with equal sets are one vertex.

    First the Gray-order index links fingerprints within the distance. A 64-bit fingerprint misses most pairs just above 0.8,
    so bands of minima bring more candidates: each vertex meets the smallest one of its bands that is in another group, and
    where a band still holds several groups, those outside its largest one meet all of it that are in other groups than
    theirs and whose sizes and parities leave the similarity possible. So a large group of near copies costs a check or two a member, and no link between groups is left out.
    """
    keyed = docs.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("key"), "text")
    marked = stored(_sets(keyed, shingle, False))
    vertices = stored(marked.groupBy("vertex").agg(F.min("key").alias("key"), F.min("n").alias("n"), F.min("fp").alias("fp"), F.first("parity").alias("parity"), F.first("hashes").alias("hashes")))
    keys = vertices.select("vertex", "key")
    near = lambda n, m: F.least(n, m) >= F.greatest(n, m) * similarity - 1e-9

    def ordered(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()

    # equal fingerprints meet their smallest vertex; linked ones meet by theirs
    prints = stored(vertices.groupBy("fp").agg(F.min("vertex").alias("v")))
    pairs = vertices.select("fp", F.col("vertex").alias("u")).join(prints, "fp").select("u", "v")
    forest_ = links(prints.select("fp"), distance)
    for side in ("u", "v"):
        forest_ = forest_.withColumnRenamed(side, "fp").join(prints.withColumnRenamed("v", f"{side}_"), "fp").drop("fp")
    found = _similar(keyed, keys, ordered(pairs.unionByName(forest_.select(F.col("u_").alias("u"), F.col("v_").alias("v")))), shingle, similarity)

    def named(found: DataFrame) -> DataFrame:
        roots = components(found).withColumnRenamed("u", "vertex")
        return vertices.select("vertex").join(roots, "vertex", "left").select("vertex", F.coalesce("root", "vertex").alias("root"))

    rows = vertices.select("vertex", "n", F.explode("hashes").alias("band"))
    shared = stored(rows.groupBy("band").agg(F.count("*").alias("k")).where("k > 1").select("band"))
    rows = stored(maybe_in(rows, shared, ["band"]).join(shared, "band"))
    grouped = stored(rows.join(stored(named(found)), "vertex"))
    first = grouped.groupBy("band").agg(F.min(F.struct("vertex", "n", "root")).alias("first"), F.max("root").alias("a"), F.min("root").alias("z")).where("a <> z").select("band", "first")
    met = grouped.join(first, "band").where((F.col("root") != F.col("first.root")) & near(F.col("n"), F.col("first.n")))
    tried = stored(ordered(met.groupBy(F.col("vertex").alias("u")).agg(F.min("first.vertex").alias("v"))))
    found = found.unionByName(_similar(keyed, keys, tried, shingle, similarity))
    grouped = stored(rows.join(stored(named(found)), "vertex"))
    most = grouped.groupBy("band", "root").agg(F.count("*").alias("k")).groupBy("band").agg(F.count("*").alias("groups"), F.max(F.struct("k", "root")).alias("most"))
    open_ = stored(grouped.join(most.where("groups > 1").select("band", F.col("most.root").alias("big")), "band"))
    # a band also gathers less similar sets: as many of their parities' bits differ as tokens may, or the pair drops within the join
    bits = vertices.join(open_.select("vertex").distinct(), "vertex").select("vertex", *[F.get("parity", F.lit(k)).alias(f"p{k}") for k in range(PARITY // 64)])
    open_ = stored(open_.join(bits, "vertex"))
    other = open_.select("band", F.col("vertex").alias("w"), F.col("n").alias("m"), F.col("root").alias("side"), *[F.col(f"p{k}").alias(f"q{k}") for k in range(PARITY // 64)])
    size = F.col("n") + F.col("m")
    apart = sum((F.bit_count(F.col(f"p{k}").bitwiseXOR(F.col(f"q{k}"))) for k in range(PARITY // 64)), F.lit(0))
    close = apart <= size - 2 * F.ceil(size * (similarity / (1 + similarity)) - 1e-9)
    met = open_.where("root <> big").join(other, "band").where((F.col("root") != F.col("side")) & near(F.col("n"), F.col("m")) & close)
    met = stored(ordered(met.select(F.col("vertex").alias("u"), F.col("w").alias("v"))).join(tried, ["u", "v"], "left_anti"))
    if not met.isEmpty():
        found = found.unionByName(_similar(keyed, keys, met, shingle, similarity))
    roots = stored(named(found))
    return marked.select("doc_id", "key", "vertex").join(roots, "vertex").select("doc_id", "key", "root")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, similarity: float | None = None) -> DataFrame:
    """One row of docs for each group: the one with the smallest doc_id (a null one counts as smallest). Groups are those of
    near fingerprints, or, with a similarity, those of similar sets of shingles. Of rows equal in doc_id and text, the one
    whose content as JSON has the smallest hash stays."""
    groups = near_groups(docs, shingle, distance) if similarity is None else similar_groups(docs, shingle, similarity, distance)
    groups = stored(groups.select("doc_id", "key", "root"))
    # no row meets its group: minima are combined before the shuffle, and all others are later rows
    stays = groups.groupBy("root").agg(F.min(F.struct("doc_id", "key")).alias("x")).select("x.doc_id", "x.key")
    rows = groups.groupBy("doc_id", "key").agg(F.count("*").alias("n"))
    touched = stored(same_row(rows, stored(stays.withColumn("stays", F.lit(True))), "left").where("stays is null or n > 1"))
    keyed = docs.select(whole_row(docs.columns).alias("row"), "doc_id", row_key(F.col("doc_id"), F.col("text")).alias("key"))
    marked = maybe_in(keyed, touched, ["key"], flag="hit")
    left = same_row(marked.where("hit").select("row", "doc_id", "key"), touched.where("stays is null").select("doc_id", "key"), "left_anti")
    once = left.groupBy("doc_id", "key").agg(F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row"))
    return marked.where("not hit").select("row").unionByName(once.select("row")).select(*columns_of("row", docs.columns))
