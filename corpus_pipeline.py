"""A corpus pipeline of five stages over `documents`; each stage takes the rows that the one before has kept.

All stages but the last return the columns of `documents`, the last one doc_id, n_tokens and digests of ids and decoded
text. Line dedup changes texts (and n_chars with them); a document that it leaves without a line stays, empty. Nulls, very long
texts, repeated rows, ties and further columns are treated as each operator states; an empty table gives an empty result, and
columns keep their names, order and values, whatever they are called.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import bpe, decontaminate, linededup, quality, simhash
from strata.llm.common import stored, table

#: Words of a shingle in the near-duplicate stage, and the Jaccard similarity of shingles that links two documents.
NEAR_SHINGLE, NEAR_SIMILARITY = 5, 0.8


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.filter_documents(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return linededup.cut_lines(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, NEAR_SHINGLE, similarity=NEAR_SIMILARITY)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(docs)


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("simhash_near_dedup", simhash_near_dedup), ("decontamination", decontamination), ("bpe_encoding", bpe_encoding)]

#: The trees of the first stage cannot be expressed in SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs)
    return docs
