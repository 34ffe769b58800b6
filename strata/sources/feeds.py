"""Feed lists, feed documents and tables: what comes in, and where it goes."""

from __future__ import annotations

import email.utils
import xml.etree.ElementTree as ET
from collections.abc import Iterator
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.ingest import first_by

ENTRY = "feed string, pos int, guid string, link string, title string, summary string, published string, image string"


def feed_list(spark: SparkSession, path: str) -> DataFrame:
    """url, pos from JSON files that hold a list or {"feeds": [...]}; a byte order mark is skipped, the first of equals stays."""
    raw = spark.read.text(path, wholetext=True).select(F.regexp_replace("value", "^\\uFEFF", "").alias("v"))
    urls = F.coalesce(F.from_json("v", "array<string>"), F.from_json("v", "feeds array<string>")["feeds"])
    return first_by(raw.select(F.posexplode(urls).alias("pos", "url")), ["url"], ["pos"])


def published(value: str | None) -> str | None:
    """A date as UTC ISO text; what cannot be read stays as it is."""
    if not value:
        return None
    for read in (email.utils.parsedate_to_datetime, lambda v: datetime.fromisoformat(v.replace("Z", "+00:00"))):
        try:
            at = read(value)
        except (TypeError, ValueError):
            continue
        return (at if at.tzinfo else at.replace(tzinfo=timezone.utc)).astimezone(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    return value


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1].lower()


def entries(document: str) -> Iterator[dict[str, str | None]]:
    """Entries of an RSS or Atom document; a broken document has none."""
    try:
        root = ET.fromstring(document)
    except ET.ParseError:
        return
    for item in root.iter():
        if _local(item.tag) not in ("item", "entry"):
            continue
        found: dict[str, str | None] = {}
        for c in item:
            name, text = _local(c.tag), (c.text or "").strip()
            if name == "link":
                rel = c.get("rel", "alternate")
                if rel == "alternate":
                    found.setdefault("link", text or c.get("href"))
                elif rel == "enclosure" and (c.get("type") or "").startswith("image"):
                    found.setdefault("image", c.get("href"))
            elif name in ("guid", "id"):
                found.setdefault("guid", text)
            elif name in ("title", "description", "summary", "content"):
                if name == "content" and c.get("url"):
                    found.setdefault("image", c.get("url"))
                else:
                    found.setdefault("title" if name == "title" else "summary", text)
            elif name in ("pubdate", "published", "updated"):
                found.setdefault("published", published(text))
            elif name in ("thumbnail", "enclosure") and c.get("url"):
                found.setdefault("image", c.get("url"))
        found["guid"] = found.get("guid") or found.get("link")
        yield found


def parse_feeds(documents: DataFrame) -> DataFrame:
    """ENTRY rows of (feed, document) rows."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in ENTRY.split(", ")]
        for pdf in parts:
            rows = [{"feed": f, "pos": k, **e} for f, d in zip(pdf["feed"], pdf["document"]) for k, e in enumerate(entries(d or ""))]
            if rows:
                yield pd.DataFrame({n: pd.Series([r.get(n) for r in rows], dtype="int32" if n == "pos" else object) for n in names})

    return documents.select("feed", "document").mapInPandas(run, ENTRY)


def fetch_plan(feeds: DataFrame, landed: DataFrame) -> DataFrame:
    """What each landed response changes: a 304 only touches the feed, else its document is parsed. feeds: feed, etag,
    modified; landed: feed, status, etag, modified, document."""
    out = feeds.select("feed", F.col("etag").alias("old_etag")).join(landed, "feed", "left")
    return out.withColumn("action", F.when(F.col("status").isNull(), "skip").when((F.col("status") == 304) | (F.col("etag") == F.col("old_etag")), "touch").otherwise("parse"))


def write(df: DataFrame, path: str, kind: str = "parquet", mode: str = "overwrite") -> None:
    """Parquet, JSON or CSV sink; CSV carries a header."""
    writer = df.write.mode(mode)
    if kind == "csv":
        writer = writer.option("header", "true")
    writer.format(kind).save(path)
