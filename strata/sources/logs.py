"""Decision logs: JSON lines mixed with other output, and log directories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

LINE = "item_id long, candidate_count int, candidates array<struct<rank: int, candidate_id: long, distance: double, shown: boolean, title: string>>, decision struct<action: string, target_id: long, score: string, reason: string>, overridden boolean, final_action string"


def parse_lines(lines: DataFrame, schema: str = LINE, key: str = "item_id") -> DataFrame:
    """Rows of (seq, value) that are JSON objects with the key; of several lines for a key the first stays."""
    rows = lines.where(F.ltrim("value").startswith("{")).select("seq", F.from_json("value", schema).alias("x")).where(F.col(f"x.{key}").isNotNull())
    w = Window.partitionBy(key).orderBy("seq")
    return rows.select("seq", "x.*").withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def scan(spark: SparkSession, path: str) -> DataFrame:
    """(seq, value) of text logs: file by file in order of names, lines in order inside a file."""
    rows = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.posexplode(F.split("value", "\n")).alias("line", "value"))
    return rows.select(F.struct("file", "line").alias("seq"), "value")
