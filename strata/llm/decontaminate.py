"""Benchmark decontamination as a prefix-filtered set join, with DataFrame functions only.

An item is the set of its windows: WINDOW consecutive words each, or all its words if it has fewer. A window's tokens are its
word shingles. Containment of a whole window needs every shingle, so a prefix of one, the rarest in all documents, is
enough to find candidates. Length and position bounds follow from the shingle's offset: a candidate starts where that offset
says and must end inside the document. Candidates are verified word by word.

Documents are scanned twice, once to count shingles and once to join; neither scan shuffles texts. The windows of the
benchmark are broadcast in blocks of about BLOCK_ROWS rows and BLOCK_BYTES bytes, so that a larger benchmark means more
blocks, not a larger block; each further block, and each size of shingle, is one more scan of the documents.

Null or wordless texts have no words and no hits. Items that are null or wordless have no windows. Very long texts count in
full. Rows that repeat an id and a text all get the same result; extra columns are not looked at and, when documents are
filtered, pass through whatever their names. An empty table gives an empty result, an empty benchmark no hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.llm.common import columns_of, maybe_in, row_key, same_row, stored, whole_row

WINDOW, SHINGLE = 10, 3
#: Rows of the benchmark side in one broadcast; a row has at most WINDOW words and its items.
BLOCK_ROWS = 200_000
#: And bytes, however long the words or however many the items are.
BLOCK_BYTES = 64 << 20
#: What separates words once A-Z are lower-cased.
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lowered(text: Column) -> Column:
    """A-Z lower-cased, nothing else; pure ASCII takes the fast way."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def split_words(text: Column) -> Column:
    """Words with an empty string possibly at either end, so that no second pass over the array is needed."""
    return F.split(lowered(F.coalesce(text, F.lit(""))), _SEPARATORS)


def count_words(words: Column) -> Column:
    n = F.size(words)
    return (n - (F.get(words, F.lit(0)) == "").cast("int") - ((n > 1) & (F.get(words, n - 1) == "")).cast("int")).cast("long")


def _shingle(words: Column, at: Column, size: int) -> Column:
    return F.xxhash64(*[F.get(words, at + k) for k in range(size)])


def windows(items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """Distinct windows: words, n, items (all that have it), size (of its shingles) and shingles (hashes by offset)."""
    words = F.filter(split_words(F.col("text")), lambda x: x != "")
    items = items.select(F.col("item_id").cast("string").alias("item"), words.alias("all")).where("size(all) > 0")
    start = F.explode(F.sequence(F.lit(0), F.greatest(F.size("all") - window, F.lit(0))))
    cut = items.select("item", "all", start.alias("at")).select("item", F.slice("all", F.col("at") + 1, window).alias("words"))
    out = cut.groupBy("words").agg(F.array_sort(F.collect_set("item")).alias("items")).withColumn("n", F.size("words"))
    out = out.withColumn("size", F.least("n", F.lit(shingle)))
    one = lambda at: F.when(F.col("size") == 1, _shingle(F.col("words"), at, 1)).when(F.col("size") == 2, _shingle(F.col("words"), at, 2)).otherwise(_shingle(F.col("words"), at, shingle))
    return out.withColumn("shingles", F.transform(F.sequence(F.lit(0), F.col("n") - F.col("size")), one))


def _positions(docs: DataFrame, size: int) -> DataFrame:
    """Every position of every document where a shingle of that size starts. The words stay beside it inside one stage."""
    out = docs.select("doc_id", "key", "words", F.posexplode("words").alias("at", "word")).where(F.col("at") <= F.size("words") - size)
    return out.select("doc_id", "key", "words", "at", _shingle(F.col("words"), F.col("at"), size).alias("token"))


def _blocks(rows: DataFrame, by: Column, block_rows: int, size: Column) -> list[DataFrame]:
    """rows in parts of about block_rows rows and BLOCK_BYTES bytes at most. size: the bytes of a row."""
    n, total = rows.agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
    n = max(1, -(-n // block_rows), -(-int(total) // BLOCK_BYTES))
    return [rows] if n == 1 else [rows.where(F.pmod(F.xxhash64(by), F.lit(n)) == k) for k in range(n)]


def matches(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """doc_id, key, start (a position in split_words), n, items: every occurrence of every window."""
    docs = docs.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("key"), split_words(F.col("text")).alias("words"))
    index = stored(windows(items, window, shingle))
    parts = []
    for size in [r["size"] for r in index.select("size").distinct().collect()]:
        own = index.where(F.col("size") == size)
        tokens = own.select(F.explode("shingles").alias("token")).distinct()
        counts = None
        for block in _blocks(tokens, F.col("token"), block_rows, F.lit(8)):
            found = _positions(docs, size).select("token").join(F.broadcast(block), "token").groupBy("token").agg(F.count("*").alias("df"))
            counts = found if counts is None else counts.unionByName(found)
        # the rarest shingle of each window; a window that lacks one in all documents occurs nowhere
        spread = own.select("words", "n", "items", F.posexplode("shingles").alias("offset", "token")).join(counts, "token", "left")
        prefix = spread.groupBy("words").agg(F.first("n").alias("n"), F.first("items").alias("items"), F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "token", "offset")).alias("rarest"))
        prefix = stored(prefix.where("rarest.df > 0").select(F.col("rarest.token").alias("token"), F.col("rarest.offset").alias("offset"), F.col("words").alias("window"), "n", "items"))
        for block in _blocks(prefix, F.col("window"), block_rows, F.octet_length(F.concat_ws(" ", "window")) + F.octet_length(F.concat_ws(" ", "items"))):
            start = F.col("at") - F.col("offset")
            fits = (start >= 0) & (start + F.col("n") <= F.size("words")) & (F.slice("words", F.greatest(start, F.lit(0)) + 1, F.col("n")) == F.col("window"))
            candidate = _positions(docs, size).alias("d").join(F.broadcast(block).alias("w"), (F.col("d.token") == F.col("w.token")) & fits)
            parts.append(candidate.select("doc_id", "key", start.alias("start"), "n", "items"))
    if not parts:
        return docs.where("false").select("doc_id", "key", F.lit(0).alias("start"), F.lit(0).alias("n"), F.array().cast("array<string>").alias("items"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """For each row of docs: doc_id, n_words, n_hit, n_items, item_ids (sorted strings), items_sha256, contaminated."""
    found = matches(docs, items, window)
    before = Window.partitionBy("doc_id", "key").orderBy("start", "n").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("n")
    new = F.greatest(end - F.greatest("start", F.coalesce(F.max(end).over(before), F.col("start"))), F.lit(0))
    # occurrences of one document only meet here, and there are fewer of them than positions in it
    per = found.withColumn("new", new).groupBy("doc_id", "key").agg(F.sum("new").alias("n_hit"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("item_ids"))
    rows = docs.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("key"), count_words(split_words(F.col("text"))).alias("n_words"))
    joined = rows.alias("a").join(per.alias("b"), (F.col("a.key") == F.col("b.key")) & F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")), "left")
    ids = F.coalesce("item_ids", F.array().cast("array<string>"))
    hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return joined.select("a.doc_id", "a.n_words", hit.alias("n_hit"), F.size(ids).cast("long").alias("n_items"), ids.alias("item_ids"), F.sha2(F.concat_ws(",", ids), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of docs in which no window of any item occurs."""
    bad = stored(matches(docs, items, window).select("doc_id", "key").distinct())
    keyed = docs.select(whole_row(docs.columns).alias("row"), "doc_id", row_key(F.col("doc_id"), F.col("text")).alias("key"))
    marked = maybe_in(keyed, bad, ["key"], flag="hit")  # only texts that may go are shuffled
    clean = same_row(marked.where("hit").select("row", "doc_id", "key"), bad, "left_anti").select("row")
    return marked.where("not hit").select("row").unionByName(clean).select(*columns_of("row", docs.columns))
