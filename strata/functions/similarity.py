"""Title similarity by matching blocks: a vectorised UDF behind lossless native bounds."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Keys of one block; two blocks meet in one row, which then lists their pairs.
BLOCK = 200


@F.pandas_udf(T.DoubleType())
def title_similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """2M/T over matching blocks; null counts as empty, two empty titles are equal; the order of arguments matters."""
    return pd.Series([difflib.SequenceMatcher(None, x or "", y or "").ratio() for x, y in zip(a, b)], dtype="float64")


def length_bound(a: Column, b: Column) -> Column:
    """An upper bound of the similarity from lengths alone."""
    m, n = F.char_length(F.coalesce(a, F.lit(""))), F.char_length(F.coalesce(b, F.lit("")))
    return F.when(m + n == 0, F.lit(1.0)).otherwise(F.try_divide(2.0 * F.least(m, n), m + n))


def _letters(x: Column) -> Column:
    return F.filter(F.split(F.coalesce(x, F.lit("")), ""), lambda c: c != "")


def numbered_letters(x: Column) -> Column:
    """Each letter with the number of its occurrence: two titles share as many of these as letters with their counts."""
    return F.get(F.transform(F.array(F.array_sort(_letters(x))), lambda s: F.transform(s, lambda c, i: F.concat(c, (i + 1 - F.array_position(s, c)).cast("string")))), 0)


def letters_bound(x: Column, y: Column) -> Column:
    """An upper bound of the similarity from the numbered letters of both titles."""
    total = F.size(x) + F.size(y)
    return F.when(total == 0, F.lit(1.0)).otherwise(F.try_divide(2.0 * F.size(F.array_intersect(x, y)), total))


def multiset_bound(a: Column, b: Column) -> Column:
    """An upper bound from the letters that both titles have, with their counts."""
    return letters_bound(numbered_letters(a), numbered_letters(b))


def blocks(rows: DataFrame, by: list[str], key: str, size: int = BLOCK) -> DataFrame:
    """by, block, lo, hi, keys: the keys of each group in lists of about `size`, with the smallest and the largest of a list."""
    sizes = rows.groupBy(*[F.col(c).alias(f"_of_{c}") for c in by]).agg(F.ceil(F.count("*") / size).cast("int").alias("_blocks"))
    dealt = rows.join(sizes, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in by]).withColumn("block", F.pmod(F.xxhash64(key), F.col("_blocks")).cast("int"))
    return dealt.groupBy(*by, "block").agg(F.min(key).alias("lo"), F.max(key).alias("hi"), F.collect_list(key).alias("keys"))


def spread(pairs: DataFrame) -> DataFrame:
    """Pairs of blocks over all cores, whatever their bytes: what they list is far larger than they are."""
    return pairs.repartition(8 * pairs.sparkSession.sparkContext.defaultParallelism)


def similar_pairs(items: DataFrame, bucket: str, key: str, title: str, least: float) -> DataFrame:
    """Pairs (a before b by key) in one bucket whose titles are at least `least` similar.

    Rows of one bucket and title are one group, so that bounds and similarity are computed once for two titles and not for each
    pair of their rows. The bucket is the equi-join key; both bounds are part of the join, before the UDF, which sees only what
    they leave. Every pair of rows is listed.
    """
    rows = items.select(F.col(bucket).alias("_bucket"), F.col(key).alias("_key"), F.col(title).alias("_title")).where("_bucket is not null and _key is not null")
    groups = blocks(rows, ["_bucket", "_title"], "_key").withColumn("_letters", numbered_letters(F.col("_title")))
    side = lambda name: groups.select(*[F.col(c).alias(f"{c}_{name}") for c in groups.columns])
    same = (F.col("_bucket_a") == F.col("_bucket_b")) & (F.col("lo_a") < F.col("hi_b"))
    bounds = (length_bound(F.col("_title_a"), F.col("_title_b")) >= least) & (letters_bound(F.col("_letters_a"), F.col("_letters_b")) >= least)
    near = side("a").join(side("b"), same & bounds).select(F.col("_bucket_a").alias(bucket), F.col("_title_a").alias("title_a"), F.col("_title_b").alias("title_b"), "keys_a", "keys_b")
    near = spread(near.withColumn("similarity", title_similarity("title_a", "title_b")).where(F.col("similarity") >= least))
    listed = near.withColumn("a", F.explode("keys_a")).withColumn("b", F.explode("keys_b")).where("a < b")
    return listed.select(bucket, "a", "title_a", "b", "title_b", "similarity")


def find_duplicate(new: DataFrame, existing: DataFrame, scope: str, least: float = 0.85) -> DataFrame:
    """For each new (id, scope, title) the most similar existing title of its scope; the smaller existing id wins ties.

    Titles of a scope are compared once, whatever number of rows has them: of equal existing titles the smallest id stands for all.
    """
    title = F.coalesce(F.col("title"), F.lit("")).alias("title")
    e = existing.select(F.col(scope), "id", title).groupBy(scope, F.col("title").alias("existing_title")).agg(F.min("id").alias("existing_id")).withColumn("_theirs", numbered_letters(F.col("existing_title")))
    own = new.select("id", F.col(scope), title)
    near = own.select(scope, "title").distinct().withColumn("_own", numbered_letters(F.col("title"))).join(e, scope)
    near = near.where((length_bound(F.col("title"), F.col("existing_title")) >= least) & (letters_bound(F.col("_own"), F.col("_theirs")) >= least))
    near = near.withColumn("similarity", title_similarity("title", "existing_title")).where(F.col("similarity") >= least)
    best = F.max(F.struct("similarity", (-F.col("existing_id")).alias("k"))).alias("best")
    found = own.join(near.groupBy(scope, "title").agg(best), [scope, "title"]).groupBy("id").agg(F.max("best").alias("best"))
    return found.select("id", (-F.col("best.k")).alias("existing_id"), F.col("best.similarity").alias("similarity"))
