"""Run history: comparison, warnings, sweeps, fingerprints and batch drains."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def compare_runs(history: DataFrame, directions: dict[str, str]) -> DataFrame:
    """Each run's metrics against the run before: run, metric, value, previous, delta, verdict. directions: up, down or
    any by metric. history: seq, run, metric columns. Runs are few; their window is over metrics."""
    long = history.unpivot(["seq", "run"], list(directions), "metric", "value")
    w = Window.partitionBy("metric").orderBy("seq")
    out = long.withColumn("previous", F.lag("value").over(w)).withColumn("delta", F.col("value") - F.col("previous"))
    way = F.create_map(*[F.lit(x) for p in directions.items() for x in p])[F.col("metric")]
    up = F.col("delta") > 0
    verdict = F.when(F.col("delta").isNull(), "first").when(F.col("delta") == 0, "same").when(way == "any", "changed").when((way == "up") == up, "better").otherwise("worse")
    return out.withColumn("verdict", verdict)


def warnings(history: DataFrame, singles_most: float = 0.70, shrink: float = 0.80) -> DataFrame:
    """Structural warnings of each run: too many single-member events; must-links up while events shrink; must-links up and
    cannot-links down. history: seq, run, events, singles, must, cannot."""
    w = Window.orderBy("seq")  # one row a run
    h = history.withColumn("p_events", F.lag("events").over(w)).withColumn("p_must", F.lag("must").over(w)).withColumn("p_cannot", F.lag("cannot").over(w))
    found = F.array_compact(
        F.array(
            F.when(F.try_divide(F.col("singles").cast("double"), F.col("events")) > singles_most, F.lit("fragmented")),
            F.when((F.col("must") > F.col("p_must")) & (F.col("events") < F.col("p_events") * shrink), F.lit("collapsed")),
            F.when((F.col("must") > F.col("p_must")) & (F.col("cannot") < F.col("p_cannot")), F.lit("over-merged")),
        )
    )
    return h.select("seq", "run", F.array_join(found, ",").alias("warnings"))


def fingerprint(pairs: DataFrame, by: list[str]) -> DataFrame:
    """First 12 hex digits of the SHA-1 of the sorted canonical pairs of each block."""
    one = F.concat(F.least("a", "b").cast("string"), F.lit("-"), F.greatest("a", "b").cast("string"))
    return pairs.groupBy(*by).agg(F.substring(F.sha1(F.array_join(F.array_sort(F.collect_set(one)), "|").cast("binary")), 1, 12).alias("fingerprint"), F.count("*").alias("pairs"))


def gold_warnings(counts: DataFrame, few: int = 100) -> DataFrame:
    return counts.withColumn("warning", F.when(F.col("pairs") == 0, "none").when(F.col("pairs") < few, "few").otherwise("ok"))


def sweep(rows: DataFrame, parameters: DataFrame, score: Column, by: str = "tag") -> DataFrame:
    """Every parameter set over the same rows in one pass: how many rows pass its threshold, and their mean score.
    parameters (tag, threshold) is a plan written by hand; it is broadcast."""
    joined = rows.select(score.alias("_s")).join(F.broadcast(parameters), F.col("_s") <= F.col("threshold"), "right")
    return joined.groupBy(by, "threshold").agg(F.count("_s").alias("passed"), F.avg("_s").alias("mean_score"))


def parse_plan(text: str) -> list[tuple[str, dict[str, str]]]:
    """`tag:K=V,K=V;tag:K=V` as a list; a tag may stand once."""
    out: dict[str, dict[str, str]] = {}
    for part in filter(None, (p.strip() for p in text.split(";"))):
        tag, _, rest = part.partition(":")
        if tag in out:
            raise ValueError(f"tag {tag} stands twice")
        out[tag] = dict(x.split("=", 1) for x in filter(None, rest.split(",")))
    return list(out.items())


def coerce(x: Column) -> Column:
    """A CSV cell as a number: empty is null."""
    return F.when(F.trim(x) == "", F.lit(None)).otherwise(x.try_cast("double"))


def as_percent(x: Column) -> Column:
    return F.when(x.isNull(), F.lit("N/A")).when((x >= 0) & (x <= 1), F.concat(F.format_number(x * 100, 1), F.lit("%"))).otherwise(F.format_number(x, 2))


def drain(step: Callable[[], int], remaining: Callable[[], int], least: int = 50) -> tuple[int, int, str]:
    """Repeats step until nothing remains, a pass makes no progress, or max(least, twice the start) passes were made.
    Returns passes, what is left, and why it stopped."""
    left = remaining()
    most, passes = max(least, 2 * left), 0
    while left:
        if passes >= most:
            return passes, left, "cap"
        step()
        passes += 1
        now = remaining()
        if now >= left:
            return passes, now, "no progress"
        left = now
    return passes, 0, "done"


def batches(rows: DataFrame, order: list[str], size: int, by: str) -> DataFrame:
    """The pass in which each row of a queue would be drained, per partition of the queue."""
    w = Window.partitionBy(by).orderBy(*order)
    return rows.withColumn("pass", F.floor((F.row_number().over(w) - 1) / size) + 1)
