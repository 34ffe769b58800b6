"""Streaming queries, run to the end of what is there."""

import uuid

from pyspark.sql import functions as F

from strata.operators.components import shared_folder
from strata.plans.registry import query, table
from strata.streaming import online


def _folder(spark):
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


def _stream(spark, d, name):
    """A one-file table as a stream: its folder, filtered to the file."""
    path = f"{d}/{name}.parquet"
    return spark.readStream.schema(spark.read.parquet(path).schema).option("pathGlobFilter", "*.parquet").parquet(f"{path}*")


@query("SELECT user_id, event_type, CAST(1 AS BIGINT) AS admitted FROM events GROUP BY 1, 2")
def stream_dedup_admit(spark, d):
    folder = _folder(spark)
    rows = _stream(spark, d, "events").select("user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    online.drain(online.admit(rows, ["user_id", "event_type"], "ts", "3650 days"), f"{folder}/out", f"{folder}/checkpoint")
    return spark.read.parquet(f"{folder}/out").groupBy("user_id", "event_type").agg(F.count("*").alias("admitted"))


@query("SELECT event_type, CAST(count(*) AS BIGINT) AS n, round(sum(value), 4) AS total FROM events WHERE event_type <> 'error' GROUP BY 1")
def stream_drain(spark, d):
    folder = _folder(spark)
    online.drain(_stream(spark, d, "events"), f"{folder}/out", f"{folder}/checkpoint", lambda s: s.where("event_type <> 'error'"))
    return spark.read.parquet(f"{folder}/out").groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


def _items(rows):
    return rows.select((F.col("label") % 2).cast("long").alias("key"), F.col("vec_id").alias("item"), (F.col("vec_id") % 50).cast("double").alias("at"), F.col("embedding").alias("vector"))


@query()
def batch_online_clusters(spark, d):
    """Order-dependent assignment over a bounded table."""
    return online.batch_clusters(_items(table(spark, d, "embeddings")), 20.0, 0.8)


@query()
def stream_state_cluster(spark, d):
    """The same through keyed state; the tests hold both against each other."""
    folder = _folder(spark)
    online.drain(online.online_clusters(_items(_stream(spark, d, "embeddings")), 20.0, 0.8), f"{folder}/out", f"{folder}/checkpoint")
    return spark.read.parquet(f"{folder}/out")
