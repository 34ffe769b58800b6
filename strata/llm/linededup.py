"""Line dedup as an exact set-similarity join, with DataFrame functions only.

A line's words are what single spaces separate; its tokens are its shingles of SHINGLE words (a shorter line is one token).
A line is removed if an earlier line of the corpus, by doc_id and place, has a Jaccard similarity of at least SIMILARITY to
it; that line may itself be removed. Lines without a word stay. Lines with equal text are one line from the start: the first
stays unless it has an earlier partner, the others go.

Similar lines share a token in their prefixes of any total order of tokens. In a bucket, the lines that have a token in their
prefixes, a line meets the first line and the NEAR lines before it, so candidates grow with the rows and not with the square
of a bucket. Length, position and parity filters drop candidates; the rest are verified, first by hashes of their tokens,
then on the words themselves. A line that found no partner and has more lines before it in a bucket meets all of them in a
second pass, so that none is missed, if the bucket holds BUSY lines at most.

Larger buckets have frequent tokens. They lead to another round with another order, in which these tokens come last, the most
frequent at the very end: the lines of the buckets that still hold a line without a partner, and only they, are dealt out
again. Two lines that share such a bucket are both dealt out again, so none of their pairs is lost. In the last round lines
without a partner meet all earlier lines of their buckets, whatever the size. A sketch over all prefixes tells which tokens
are too frequent to be gathered: their buckets are split by line hash, and the bucket's first line goes to all parts.
Lines with many copies are dealt out once, not once a copy.

A null or empty text has no lines to remove; a null text stays null. Equal (doc_id, text) rows repeat each other's lines:
both are the same place, so the first copy of a line stays in each. A null doc_id orders first. Very long texts and lines
count in full. Columns beside doc_id and text pass through, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.llm.common import columns_of, free, maybe_in, row_key, same_row, stored, whole_row

SHINGLE, SIMILARITY = 5, 0.8
#: Partners before a line that it meets in a bucket in the first pass.
NEAR = 7
#: A bucket with more lines has a frequent token; so many of the most frequent come last, in RANKS classes.
BUSY, BUSIEST, RANKS = 512, 16384, 7
ROUNDS = 3
#: The sketch over prefixes tracks so many tokens and reports so many; those with more lines than HEAVY have split buckets.
TRACKED, REPORTED, HEAVY = 1 << 16, 1024, 1024
#: Cells at most of the table that finds a frequent token by its hash.
CELLS = 1 << 17
#: So many lines with the most copies are dealt out once.
COPIED, COPIES = 16384, 4
#: Parts of a frequent token's bucket in the last round.
PARTS = 64
_LINE, _PLACE, _PAIR = ["h", "h2"], ["h", "doc_id", "at"], ["h", "g"]


def lines(docs: DataFrame) -> DataFrame:
    """key, doc_id, at (place), line, and h, h2 (128 bits that stand for its text) for every line that has a word."""
    out = docs.select("key", "doc_id", F.posexplode(F.split("text", "\n")).alias("at", "line"))
    return out.where(F.trim("line") != "").withColumn("h", F.xxhash64("line")).withColumn("h2", F.xxhash64(F.lit(1), "line"))


def _each_shingle(words: str, make) -> Column:  # noqa: ANN001
    """make(the words of it; null beyond the end) for each shingle; a line of fewer words is one."""
    every = F.transform(words, lambda w, i: make([w, *[F.get(words, i + k) for k in range(1, SHINGLE)]]))
    return F.slice(every, F.lit(1), F.greatest(F.size(words) - (SHINGLE - 1), F.lit(1)))


def with_tokens(rows: DataFrame) -> DataFrame:
    """rows and t, the distinct tokens of its line as sorted 60-bit hashes."""
    own = rows.columns
    hashed = rows.select("*", F.transform(F.split("line", " "), lambda w: F.xxhash64(w)).alias("_words"))  # each word is hashed once
    return hashed.select(*own, F.sort_array(F.array_distinct(_each_shingle("_words", lambda w: F.shiftrightunsigned(F.xxhash64(*w), 4)))).alias("t"))


class Frequent:
    """Frequent tokens as two arrays that the plan holds as values: a token stands in its hash's cell, with its class; of two in
    a cell the more frequent one. A token that finds no place only stays early in the order."""

    def __init__(self, found: dict[int, int]) -> None:
        size = min(CELLS, 1 << (8 * len(found)).bit_length())
        cells, ranks = [0] * size, [0] * size
        for k, (_, t) in enumerate(sorted((n, t) for t, n in found.items())):
            cells[t & (size - 1)], ranks[t & (size - 1)] = t, k * RANKS // len(found) + 1
        listed = lambda x, kind: F.split(F.lit(",".join(map(str, x))), ",").cast(f"array<{kind}>")
        self.last, self.cells, self.ranks = size - 1, listed(cells, "bigint"), listed(ranks, "int")

    def rank(self, token: Column) -> Column:
        at = token.bitwiseAND(F.lit(self.last)).cast("int")
        return F.coalesce(F.when(F.get(self.cells, at) == token, F.get(self.ranks, at)), F.lit(0))


def prefixes(rows: DataFrame, frequent: Frequent | None = None) -> DataFrame:
    """h, doc_id, at, n (tokens), bits, and prefix: the tokens that a similar line may share as its first one, in order."""
    own = with_tokens(rows.select(*_PLACE, "line"))
    # parities of token counts by the hash's last bits: lines that differ in few tokens differ in few bits
    bit = lambda x: F.call_function("shiftleft", F.lit(1).cast("long"), x.bitwiseAND(F.lit(63)).cast("int"))
    own = own.withColumn("n", F.size("t")).withColumn("bits", F.aggregate("t", F.lit(0).cast("long"), lambda s, x: s.bitwiseXOR(bit(x))))
    size = (F.col("n") - F.ceil(F.col("n") * SIMILARITY - 1e-9).cast("int") + 1).cast("int")
    if frequent is None:
        return own.select(*_PLACE, "n", "bits", F.slice("t", F.lit(1), size).alias("prefix"))
    ranked = F.sort_array(F.transform("t", lambda x: F.struct(frequent.rank(x).alias("rank"), x.alias("x"))))
    return own.select(*_PLACE, "n", "bits", F.transform(F.slice(ranked, F.lit(1), size), lambda s: s["x"]).alias("prefix"))


def _sketch(p: DataFrame) -> dict[int, int]:
    """Tokens that are frequent in the prefixes, with their counts as a bounded sketch has them."""
    top = p.select(F.explode("prefix").alias("t")).agg(F.expr(f"approx_top_k(t, {REPORTED}, {TRACKED})").alias("top")).first()["top"]
    return {x["item"]: x["count"] for x in top or [] if x["count"] > HEAVY}


def _possible(n: Column, i: Column, bits: Column, m: Column, j: Column, other: Column) -> Column:
    """Length, position and parity filters: the sizes are near enough; if the token is the first that both have (as it is
    in one of a similar pair's buckets), what follows in the shorter rest still suffices; no more bits differ than tokens may."""
    need = F.ceil((n + m) * (SIMILARITY / (1 + SIMILARITY)) - 1e-9)  # tokens that similar lines share at least
    return (F.least(n, m) >= F.greatest(n, m) * SIMILARITY - 1e-9) & (F.least(n - i, m - j) >= need) & (F.bit_count(bits.bitwiseXOR(other)) <= n + m - 2 * need)


def _those(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows whose h is in wanted (distinct, stored)."""
    return maybe_in(rows, wanted, ["h"]).join(wanted, "h").select(*rows.columns)


def _lines_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """h, h2, doc_id, at, line of the lines named by wanted (h and the doc_id of the text that has it first; a stored table),
    each once, at its first place. Its copies in other texts are not moved."""
    texts = stored(wanted.select("doc_id").distinct())
    docs = maybe_in(docs, texts, ["doc_id"])  # other texts are not taken apart
    near = maybe_in(lines(docs).select(*_LINE, "doc_id", "at", "line"), wanted, ["h", "doc_id"])
    # an inner join (wanted is distinct), as a semi join would be pushed below the bitmap and move all lines
    near = near.join(wanted.select(F.col("h").alias("_h"), F.col("doc_id").alias("_d")), (F.col("h") == F.col("_h")) & F.col("doc_id").eqNullSafe(F.col("_d")))
    return near.groupBy(*_LINE).agg(F.min(F.struct("doc_id", "at", "line")).alias("x")).select(*_LINE, "x.*")


def buckets(p: DataFrame, heavy: dict[int, int]) -> DataFrame:
    """For lines in a bucket with others: token, h, its first place o, n, i, bits, size and rank (of the bucket, or of its part
    if it is heavy), heavy, and partners (g, and e, a doc_id): earlier lines that the filters let through. heavy: tokens whose
    buckets are split. Lines of a small bucket that have no partner there are left out."""
    part, me = F.lit(0), F.struct("h", "o", "n", "i", "bits")
    if heavy:
        part = F.when(Frequent(heavy).rank(F.col("token")) > 0, F.pmod("h", F.lit(PARTS)) + 1).otherwise(0)
    # dealt by token and part alone; nearly all rows are alone with their token and drop out first
    w = Window.partitionBy("token", "part")
    shared = lambda rows: rows.withColumn("part", part.cast("int")).withColumn("a", F.min("h").over(w)).withColumn("z", F.max("h").over(w)).where("a <> z or part > 0")
    # most lines share no token: they are told by rows of token and hash, before the others are dealt out with all that they have
    some = stored(shared(p.select("h", F.explode("prefix").alias("token"))).select("h").distinct())
    rows = shared(maybe_in(p, some, ["h"]).select(*_PLACE, "n", "bits", F.posexplode("prefix").alias("i", "token")))
    rows = rows.groupBy("token", "part", "h").agg(F.min(F.struct("doc_id", "at")).alias("o"), F.min("n").alias("n"), F.min("i").alias("i"), F.min("bits").alias("bits"))
    first = w.orderBy("o", "h")
    rows = rows.withColumn("size", F.count("*").over(w)).withColumn("rank", F.row_number().over(first)).withColumn("first", F.first(me).over(first))
    rows = rows.withColumn("before", F.collect_list(me).over(first.rowsBetween(-NEAR, -1)))
    partners = F.filter(F.array_distinct(F.concat(F.array("first"), "before")), lambda x: _earlier(x))
    rows = rows.select("token", "h", "o", "n", "i", "bits", "size", "rank", (F.col("part") > 0).alias("heavy"), F.transform(partners, lambda x: F.struct(x["h"].alias("g"), x["o"]["doc_id"].alias("e"))).alias("partners"))
    # in a smaller bucket all lines have met
    return rows.where((F.col("size") > NEAR + 1) | F.col("heavy") | (F.size("partners") > 0))


def _earlier(x: Column) -> Column:
    """x stands before the row's line, and the filters let the pair through."""
    return (x["o"] < F.col("o")) & _possible(F.col("n"), F.col("i"), F.col("bits"), x["n"], x["i"], x["bits"])


def _first_pairs(met: DataFrame) -> DataFrame:
    """h, g and doc_ids d, e of lines and their partners; in a heavy bucket the first line of all parts is one more."""
    pairs = met.select("h", F.col("o.doc_id").alias("d"), F.explode("partners").alias("x")).select("h", "d", "x.*")
    hot = met.where("heavy")
    # combined before the shuffle; at most REPORTED rows
    tops = hot.groupBy("token").agg(F.min(F.struct("o", "h", "n", "i", "bits")).alias("top"))
    more = hot.join(F.broadcast(tops), "token").where(_earlier(F.col("top"))).select("h", F.col("o.doc_id").alias("d"), F.col("top.h").alias("g"), F.col("top.o.doc_id").alias("e"))
    return pairs.unionByName(more)


def _exact(line: str, other: str) -> Column:
    """Jaccard similarity on the words themselves."""
    def own(x: str) -> Column:
        n = F.greatest(F.size(x) - (SHINGLE - 1), F.lit(1))
        each = F.arrays_zip(*[F.slice(x, k + 1, n).alias(f"w{k}") for k in range(SHINGLE)])
        return F.array_distinct(F.transform(each, lambda s: F.concat_ws(" ", *[s[f"w{k}"] for k in range(SHINGLE)])))

    # shingles are made once a pair: as elements of an array they are values, not expressions that the filter repeats
    enough = lambda s: F.size(F.array_intersect(s["a"], s["b"])) >= (F.size(s["a"]) + F.size(s["b"])) * (SIMILARITY / (1 + SIMILARITY)) - 1e-9
    return F.exists(F.array(F.struct(own(line).alias("a"), own(other).alias("b"))), enough)


def _similar(near_lines: DataFrame, pairs: DataFrame) -> DataFrame:
    """h, h2 of the lines that are similar to an earlier line by a row of pairs (h, g), a stored table; stored. near_lines: h,
    h2, doc_id, at and line of all lines in pairs."""
    wanted = stored(pairs.select("h").unionByName(pairs.select(F.col("g").alias("h"))).distinct())
    sets = stored(with_tokens(_those(near_lines, wanted).select(*_LINE, F.struct("doc_id", "at").alias("o"), "line")))
    names = {"h": "g", "h2": "g2", "o": "p", "line": "other", "t": "u"}
    other = sets.withColumnsRenamed(names)
    shared = F.size(F.array_intersect("t", "u"))
    both = pairs.select(*_PAIR).join(sets.drop("line"), "h").join(other.drop("other"), "g").where(F.col("p") < F.col("o"))
    near = stored(both.where(shared >= (F.size("t") + F.size("u")) * (SIMILARITY / (1 + SIMILARITY)) - 1e-9).select(*_LINE, "g", "g2"))

    def exact(rows: DataFrame) -> DataFrame:
        both = rows.join(sets.select(*_LINE, "line"), _LINE).join(other.select("g", "g2", "other"), ["g", "g2"])
        return both.select(*_LINE, F.split("line", " ").alias("a"), F.split("other", " ").alias("b")).where(_exact("a", "b")).select(*_LINE)

    # one partner a line is enough, if it is one on its words
    out = stored(exact(near.groupBy(*_LINE).agg(F.min(F.struct("g", "g2")).alias("x")).select(*_LINE, "x.*")).distinct())
    open_ = stored(near.join(out, _LINE, "left_anti"))
    if not open_.isEmpty():
        out = stored(out.unionByName(exact(open_)).distinct())
    free(wanted, sets, near, open_)
    return out


def _all_earlier(left: DataFrame, met: DataFrame) -> DataFrame:
    """h, g, d, e: every earlier line of its buckets that the filters let through, for the rows of left."""
    full = met.select("token", F.col("h").alias("g"), F.col("o").alias("p"), F.col("n").alias("m"), F.col("i").alias("j"), F.col("bits").alias("other"))
    both = left.select("token", "h", "o", "n", "i", "bits").join(full, "token")
    return both.where((F.col("p") < F.col("o")) & _possible(F.col("n"), F.col("i"), F.col("bits"), F.col("m"), F.col("j"), F.col("other"))).select("h", "g", F.col("o.doc_id").alias("d"), F.col("p.doc_id").alias("e"))


def later_lines(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """For rows (key, doc_id, text): (h, h2, first, copies) of lines with copies, and (h, h2) of those with an earlier similar line."""
    rows = lines(docs)
    firsts = stored(rows.groupBy(*_LINE).agg(F.min(F.struct("doc_id", "at")).alias("first"), F.count("*").alias("copies")).where("copies > 1"))
    often = stored(firsts.where(F.col("copies") >= COPIES).orderBy(F.desc("copies"), *_LINE).limit(COPIED).select(*_LINE, "first"))
    work = rows.join(F.broadcast(often), _LINE, "left").where(F.col("first").isNull() | (F.struct("doc_id", "at") == F.col("first")))  # COPIED rows at most
    gone, tried, searching, rest, near_lines, found = None, None, None, None, None, {}
    for k in range(ROUNDS):
        p = stored(prefixes(work, Frequent(found) if found else None))
        heavy = _sketch(p)
        met = stored(buckets(p, heavy))
        if near_lines is None:  # later rounds deal out lines of these buckets only
            named = met.select("h", F.col("o.doc_id").alias("doc_id"))
            named = named.unionByName(_first_pairs(met).select(F.col("g").alias("h"), F.col("e").alias("doc_id")))
            near_lines = stored(_lines_of(docs, stored(named.distinct())))
        # all copies of a line share its buckets, so a bucket's order is that of first places: each partner is earlier
        pairs = _first_pairs(met)
        if searching is not None:
            pairs = pairs.join(searching, "h", "left_semi")
        pairs = (pairs if rest is None else pairs.unionByName(rest)).dropDuplicates(_PAIR)
        pairs = stored(pairs if tried is None else pairs.join(tried, _PAIR, "left_anti"))
        tried = pairs.select(*_PAIR) if tried is None else tried.unionByName(pairs.select(*_PAIR))
        now = _similar(near_lines, pairs)
        gone = now if gone is None else stored(gone.unionByName(now).distinct())
        left = met.where((F.col("rank") > NEAR + 1) | F.col("heavy")).join(gone.select("h"), "h", "left_anti")
        left = stored(left if searching is None else left.join(searching, "h", "left_semi"))
        busy = left.where((F.col("size") > BUSY) | F.col("heavy")).groupBy("token").agg(F.max("size").alias("n")).orderBy(F.desc("n"), "token").limit(BUSIEST)
        new = {} if k == ROUNDS - 1 else {r["token"]: heavy.get(r["token"], r["n"]) for r in busy.collect() if r["token"] not in found}
        if not new:
            rest = stored(_all_earlier(left, met).dropDuplicates(_PAIR).join(tried, _PAIR, "left_anti"))
            break
        # frequent tokens wait for the next round; the lines of their buckets are dealt out again
        frequent = Frequent(new)
        calm = left.where(frequent.rank(F.col("token")) == 0)
        rest = stored(_all_earlier(calm, met))
        again = stored(met.where(frequent.rank(F.col("token")) > 0).select("h").distinct())
        searching = stored(left.select("h").distinct())
        work = stored(_those(near_lines, again))
        found = {**found, **new}
        free(p, met, left, again)
    if not rest.isEmpty():
        gone = stored(gone.unionByName(_similar(near_lines, rest)).distinct())
    return firsts, gone


def _cut(docs: DataFrame) -> DataFrame:
    """row (all columns of docs as one), text cut to the lines that stay, and n_lines and n_removed (lines with a word)."""
    # the row travels as one column, so that no name of its own can clash
    keyed = docs.select(whole_row(docs.columns).alias("row"), "doc_id", "text", row_key(F.col("doc_id"), F.col("text")).alias("key"))
    small = keyed.select("key", "doc_id", "text")
    firsts, gone = later_lines(small)
    marks = stored(firsts.select(*_LINE, "first").join(gone.withColumn("gone", F.lit(True)), _LINE, "full"))
    free(firsts, gone)
    rows = maybe_in(lines(small).select("key", "doc_id", "at", *_LINE), marks, ["h"]).join(marks, _LINE)
    bad = rows.where(F.coalesce("gone", F.lit(False)) | (F.struct("doc_id", "at") != F.col("first"))).groupBy("doc_id", "key").agg(F.collect_set("at").alias("bad"))
    bad = stored(bad)
    marked = maybe_in(keyed.select("row", "doc_id", "key"), bad, ["key"], flag="hit")  # other texts are not moved
    out = same_row(marked.where("hit").drop("hit"), bad, "left")
    out = out.select("row", "bad").unionByName(marked.where("not hit").select("row", F.lit(None).cast("array<int>").alias("bad")))
    body = F.col("row").getField("text")
    parts = F.split(body, "\n")
    kept = F.filter(parts, lambda x, i: ~F.array_contains("bad", i))
    n = F.size(F.filter(parts, lambda x: F.trim(x) != ""))
    text = F.when(F.col("bad").isNull(), body).otherwise(F.array_join(kept, "\n"))
    return out.select("row", text.alias("text"), F.when(body.isNull(), 0).otherwise(n).cast("long").alias("n_lines"), F.coalesce(F.size("bad"), F.lit(0)).cast("long").alias("n_removed"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """The rows of docs with text cut to the lines that stay, and n_lines and n_removed (lines with a word). If docs has
    columns of these two names, in any case, ours take their place."""
    keep = [c for c in docs.columns if c.lower() not in ("n_lines", "n_removed")]
    return _cut(docs).select(*[F.col("text").alias(c) if c.lower() == "text" else x for c, x in zip(keep, columns_of("row", keep))], "n_lines", "n_removed")


def cut_lines(docs: DataFrame, length: str = "n_chars") -> DataFrame:
    """The rows of docs with text cut to the lines that stay and all other columns as they are, but for a column named by
    length, which is set to the code points of a text that has lost lines."""
    def value(c: str, x: Column) -> Column:
        if c.lower() == "text":
            return F.col("text").alias(c)
        if c.lower() == length:
            return F.when(F.col("n_removed") > 0, F.char_length("text").cast(docs.schema[c].dataType)).otherwise(F.col("row").getField(c)).alias(c)
        return x

    return _cut(docs).select(*[value(c, x) for c, x in zip(docs.columns, columns_of("row", docs.columns))])
