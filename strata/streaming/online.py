"""Structured Streaming: exactly-once admission, queue state, drains, and order-dependent clustering."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def admit(stream: DataFrame, keys: list[str], time: str, delay: str = "7 days") -> DataFrame:
    """Each key once while it may still come again: state goes with the watermark."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def drain(stream: DataFrame, path: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Runs what is there through a transformation into a Parquet table, batch by batch, and stops. A batch that is
    repeated after a failure is written once."""
    out = transform(stream) if transform else stream
    out.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).outputMode("append").start().awaitTermination()


def assign_one(vector: np.ndarray, at: float, centers: list[list], window: float, most: float) -> tuple[int, float]:
    """The nearest live center within the distance, or -1. centers: id, sum, n, updated."""
    best, best_distance = -1, float("inf")
    size = np.linalg.norm(vector)
    for k, (_, total, _, updated) in enumerate(centers):
        if updated + window < at:
            continue
        norm = np.linalg.norm(total)
        distance = 1 - float(vector @ total) / (size * norm) if size and norm else float("nan")
        if distance <= most and distance < best_distance:
            best, best_distance = k, distance
    return best, best_distance


def cluster_batch(rows: pd.DataFrame, centers: list[list], window: float, most: float) -> list[tuple[int, int, bool]]:
    """(item, event, created) for rows in (at, item) order; centers grow and move as in one pass over all rows."""
    out = []
    for item, at, vector in rows.sort_values(["at", "item"])[["item", "at", "vector"]].itertuples(index=False):
        v = np.asarray(vector, np.float64)
        k, _ = assign_one(v, at, centers, window, most)
        if k < 0:
            centers.append([int(item), v.copy(), 1, float(at)])
            out.append((int(item), int(item), True))
        else:
            c = centers[k]
            c[1], c[2], c[3] = c[1] + v, c[2] + 1, max(c[3], float(at))
            out.append((int(item), c[0], False))
    return out


def online_clusters(stream: DataFrame, window: float, most: float) -> DataFrame:
    """key, item, event, created: order-dependent assignment inside each key. Exact for one key; more keys run side by side,
    as separate collections. Centers that the window has passed leave the state. stream: key, item, at (double), vector."""

    def run(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        centers = [[i, np.frombuffer(s, np.float64).copy(), n, u] for i, s, n, u in zip(*state.get)] if state.exists else []
        rows = pd.concat(list(parts), ignore_index=True)
        done = cluster_batch(rows, centers, window, most)
        last = float(rows["at"].max())
        live = [c for c in centers if c[3] + window >= last]
        state.update(([c[0] for c in live], [c[1].tobytes() for c in live], [c[2] for c in live], [c[3] for c in live]))
        yield pd.DataFrame([(key[0], *r) for r in done], columns=["key", "item", "event", "created"])

    return stream.groupBy("key").applyInPandasWithState(run, "key long, item long, event long, created boolean", "ids array<long>, sums array<binary>, ns array<long>, updated array<double>", "append", GroupStateTimeout.NoTimeout)


def batch_clusters(rows: DataFrame, window: float, most: float) -> DataFrame:
    """The same for a bounded table."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([(pdf["key"].iloc[0], *r) for r in cluster_batch(pdf, [], window, most)], columns=["key", "item", "event", "created"])

    return rows.groupBy("key").applyInPandas(run, "key long, item long, event long, created boolean")


def read_table(spark: SparkSession, path: str, per_batch: int = 1) -> DataFrame:
    """A Parquet table, or a folder of its files, as a stream."""
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).parquet(path)
