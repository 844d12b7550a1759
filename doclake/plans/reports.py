"""The queries users run on the layers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from doclake.functions.text import truncate_text


def report_bronze(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        "file_name", "content_type", "author", "language", "num_pages", "ingested_at"
    )


def report_silver(silver: DataFrame) -> DataFrame:
    return silver.select("file_name", "text_length", "processed_at")


def report_enriched(enriched: DataFrame) -> DataFrame:
    """Enriched documents, newest first.

    The name as second key spreads the rows of one run over all sort tasks.
    """
    return enriched.select("file_name", "topic", "summary", "enriched_at").orderBy(
        F.desc("enriched_at"), "file_name"
    )


def report_topics(mart: DataFrame) -> DataFrame:
    """Topic statistics by size, one row per document of the mart."""
    return mart.orderBy(F.desc("topic_total_docs"), "file_name").select(
        "topic", "topic_total_docs", "topic_avg_text_length"
    )


def preview(bronze: DataFrame, rows: int = 10) -> DataFrame:
    """The first documents by name with text length and the start of the text."""

    return (
        bronze.orderBy("file_name")
        .limit(rows)
        .select(
            "file_name",
            "content_type",
            F.length("text_content").alias("text_len"),
            truncate_text("text_content", "table_preview").alias("text_preview"),
        )
    )
