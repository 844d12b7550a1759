"""Staging and analytic marts over the enriched documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from doclake.constants import UNKNOWN_AUTHOR
from doclake.operators.cleaning import filter_summary_length


def _or_null(column: str) -> Column:
    """A trimmed string, NULL when blank."""
    return F.nullif(F.trim(column), F.lit(""))


def stg_normalise(enriched: DataFrame) -> DataFrame:
    """Staging: blanks become NULL or a default, counts become numbers.

    A page count that is no number becomes NULL instead of failing the mart.
    """
    return enriched.filter(F.col("file_name").isNotNull()).select(
        "file_name",
        F.coalesce(_or_null("title"), F.col("file_name")).alias("document_title"),
        F.coalesce(_or_null("author"), F.lit(UNKNOWN_AUTHOR)).alias("document_author"),
        _or_null("language").alias("language"),
        _or_null("num_pages").try_cast("int").alias("num_pages"),
        F.col("text_length").try_cast("int").alias("text_length"),
        F.trim("topic").alias("topic"),
        F.trim("summary").alias("summary"),
        "content_type",
        "ingested_at",
        "processed_at",
        "enriched_at",
    )


def topic_stats(staging: DataFrame) -> DataFrame:
    """One row per topic; a missing page count is one page."""
    return staging.groupBy("topic").agg(
        F.count(F.lit(1)).alias("total_documents"),
        F.avg("text_length").alias("avg_text_length"),
        F.avg(F.coalesce("num_pages", F.lit(1))).alias("avg_pages"),
        F.min("ingested_at").alias("first_ingested_at"),
        F.max("ingested_at").alias("last_ingested_at"),
    )


def mart_by_topic(staging: DataFrame) -> DataFrame:
    """Every document with the statistics of its topic; NULL topics get none.

    The statistics are a few narrow rows; adaptive execution broadcasts them by
    their size at run time, or splits the rows of a frequent topic.
    """
    stats = topic_stats(staging).select(
        "topic",
        F.col("total_documents").alias("topic_total_docs"),
        F.col("avg_text_length").alias("topic_avg_text_length"),
        F.col("avg_pages").alias("topic_avg_pages"),
    )
    joined = staging.join(stats.filter(F.col("topic").isNotNull()), "topic", "left")
    return joined.select(
        "file_name",
        "document_title",
        "document_author",
        "language",
        "num_pages",
        "text_length",
        "topic",
        "summary",
        "content_type",
        "ingested_at",
        "enriched_at",
        "topic_total_docs",
        "topic_avg_text_length",
        "topic_avg_pages",
    )


def mart_summaries(staging: DataFrame) -> DataFrame:
    """Documents with a telling summary. The stored table has no order of its own."""
    return filter_summary_length(staging).select(
        "file_name",
        "document_title",
        "document_author",
        "topic",
        "language",
        "summary",
        "text_length",
        "num_pages",
        "enriched_at",
    )


def newest_first(mart: DataFrame) -> DataFrame:
    """Reading order of the summaries mart."""
    return mart.orderBy(F.desc("enriched_at"), "file_name")
