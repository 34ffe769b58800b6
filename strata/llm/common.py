"""Helpers that the training-data operators share: table access, Arrow batches as flat byte arrays, digests."""

from __future__ import annotations

import atexit
import contextlib
import hashlib
import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of one Arrow batch; with texts of a few kB a batch takes a few MB, and one very long text cannot drag thousands along.
BATCH_ROWS = 1000
#: Bytes of one Arrow batch; a single longer text is a batch of its own.
BATCH_BYTES = 32 << 20
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bounds what a Python worker holds at once. The settings are read when the plan runs, so they stay in the session."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def mod5(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5


def held_out(doc_id: Column) -> Column:
    return mod5(doc_id) == 0


def row_key(*cols: Column) -> Column:
    """64-bit key of a row's content; rows that agree in it get the same result, so repeated rows are safe to group. Joins
    take the doc_id along, so that only rows of one id can ever be mistaken for each other."""
    return F.xxhash64(*cols)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def whole_row(columns: list[str]) -> Column:
    """All columns as one struct, so that none of their names can clash with a name of ours or be read as a path."""
    return F.struct(*[F.col(quoted(c)).alias(c) for c in columns])


def columns_of(row: str, columns: list[str]) -> list[Column]:
    return [F.col(row).getField(c).alias(c) for c in columns]


def same_row(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join on doc_id (null equals null) and key; the right side's doc_id and key go."""
    other = right.withColumnRenamed("doc_id", "_doc_id").withColumnRenamed("key", "_key")
    return left.join(other, F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("key") == F.col("_key")), how).drop("_doc_id", "_key")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir. Only a driver that is its own executor may use another."""
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if found:
        return found
    if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return f"/tmp/checkpoints/{context.applicationId}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialises df in the shared checkpoint folder and cuts its lineage; a lost executor does not lose it."""
    context = df.sparkSession.sparkContext
    folder = shared_folder(df.sparkSession)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


_STORED: set[str] = set()


def stored(df: DataFrame) -> DataFrame:
    """A table written to the shared checkpoint folder and read again: compressed, and safe from lost executors. The shuffles
    behind it are removed when it is written; the table itself goes with free(), or when the driver's Python ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEAN, None)
    spark.conf.set(_CLEAN, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEAN, before) if before is not None else spark.conf.unset(_CLEAN)
    out = spark.read.schema(df.schema).parquet(path)
    if not _STORED:
        atexit.register(_free_all, spark)
    _STORED.add(path)
    out._stored = path
    return out


def free(*tables: DataFrame) -> None:
    """Deletes stored tables that no later action reads."""
    for df in tables:
        if (path := getattr(df, "_stored", None)) in _STORED:
            _STORED.discard(path)
            _delete(df.sparkSession, path)


def _delete(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def _free_all(spark: SparkSession) -> None:
    with contextlib.suppress(Exception):  # the session may have ended first
        for path in _STORED:
            _delete(spark, path)


def _bit(columns: list[str], bits: int) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(bits))


def maybe_in(rows: DataFrame, wanted: DataFrame, columns: list[str], flag: str | None = None) -> DataFrame:
    """The rows whose columns agree with a row of wanted (a stored table), and a few others: a bitmap of 16 bits for each
    wanted row, 1 MB at least and 16 MB at most, is broadcast. It keeps the bulk of rows out of a shuffle; a join must settle
    the rest. With flag, all rows and a column of that name that tells them apart."""
    n = wanted.count()
    bits = min(max(1 << 23, 1 << (16 * n).bit_length()), 1 << 27)
    maps = wanted.select(_bit(columns, bits).alias("b")).groupBy(F.floor(F.col("b") / 32768).alias("_k")).agg(F.expr("bitmap_construct_agg(b % 32768)").alias("_m"))
    at = _bit(columns, bits)
    bit = at % 32768
    byte = F.conv(F.hex(F.substring("_m", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.call_function("shiftright", byte, (bit % 8).cast("int")).bitwiseAND(F.lit(1)) == 1
    rows = rows.withColumn("_k", F.floor(at / 32768)).join(F.broadcast(maps), "_k", "left" if flag else "inner")
    return (rows.withColumn(flag, F.coalesce(is_set, F.lit(False))) if flag else rows.where(is_set)).drop("_k", "_m")


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the n + 1 offsets of its rows; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if buffers[2] is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(buffers[2], np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def texts(column: pa.Array) -> list[str]:
    return ["" if x is None else x for x in column.to_pylist()]


def sha(data: bytes | str) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on uint64, so that every bit of the result depends on every bit of x."""
    x = x.astype(np.uint64)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))
