"""Counts and quality rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The quality rules of the analytic models.
NOT_NULL_RULES = {
    "stg_documents_enriched": ("file_name", "topic"),
    "mart_documents_by_topic": ("file_name", "topic"),
    "mart_document_summaries": ("file_name", "summary"),
}
UNIQUE_RULES = {"stg_documents_enriched": ("file_name",)}


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


def check_unique(df: DataFrame, key: str) -> DataFrame:
    """Key values that occur more than once, with their count."""
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
    )


def check_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column with the number of NULLs; one pass for all columns."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "failures")


def check_models(models: Mapping[str, DataFrame]) -> DataFrame:
    """All rules over the given models: ``model, rule, column_name, failures``."""
    parts = []
    for model, columns in NOT_NULL_RULES.items():
        if model in models:
            failures = check_not_null(models[model], columns)
            parts.append(failures.select(F.lit(model).alias("model"), F.lit("not_null").alias("rule"), "*"))
    for model, columns in UNIQUE_RULES.items():
        for column in columns if model in models else ():
            parts.append(
                check_unique(models[model], column)
                .agg(F.count(F.lit(1)).alias("failures"))
                .select(
                    F.lit(model).alias("model"),
                    F.lit("unique").alias("rule"),
                    F.lit(column).alias("column_name"),
                    "failures",
                )
            )
    return reduce(DataFrame.unionByName, parts)
