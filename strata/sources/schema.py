"""Expected tables and checks of what is there."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.ingest import missing_columns

# Domains.
DOMAINS = {"bias_type": ["진보", "중도", "보수"], "category": ["정치", "경제", "사회", "국제"], "status": ["needs_crawl", "ready", "crawl_failed", "event_assigned"]}
REQUIRED = {
    "articles": {"id", "feed_url", "guid", "link", "category", "title", "content", "publisher", "published_at", "bias_type", "status", "embedding"},
    "article_ai_results": {"article_id", "summary", "status"},
    "events": {"id", "topic_id", "category", "title", "summary", "article_count", "created_at", "updated_at", "prev_event_id", "next_event_id", "embedding"},
    "event_articles": {"event_id", "article_id", "reason"},
    "topics": {"id", "category", "title", "summary", "parent_topic_id"},
    "topic_causes": {"topic_id", "cause_text", "cause_embedding"},
}


def validate(tables: dict[str, DataFrame], required: dict[str, set[str]] | None = None) -> None:
    """Raises with the sorted list of what is missing."""
    found = missing_columns(required or REQUIRED, {n: set(t.columns) for n, t in tables.items()})
    if found:
        raise ValueError("missing: " + ", ".join(found))


def bad_domains(rows: DataFrame, column: str, allowed: list[str]) -> DataFrame:
    """Values outside the domain and how often they occur; null is allowed."""
    return rows.where(F.col(column).isNotNull() & ~F.col(column).isin(allowed)).groupBy(column).agg(F.count("*").alias("n"))


def bad_dimensions(rows: DataFrame, column: str, size: int) -> DataFrame:
    """Rows whose vector has another size; a size of -1 means unknown and checks nothing."""
    return rows.where(F.lit(size != -1) & F.col(column).isNotNull() & (F.size(column) != size))
