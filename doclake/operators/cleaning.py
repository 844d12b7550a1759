"""Schema-driven cleaning and the length rule of the feature layer."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from doclake.constants import MIN_CLEAN_CHARS, MIN_SUMMARY_BYTES
from doclake.functions.text import clean_text, lower_trim, removed_characters


def typed_clean(df: DataFrame, timestamp_cols: Iterable[str] = ()) -> DataFrame:
    """Trim every string column and parse the named timestamp columns that exist.

    A value that is no timestamp becomes NULL. One projection for all columns.
    """
    wanted = set(timestamp_cols)

    def cleaned(field):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, StringType):
            column = F.trim(column)
        if field.name in wanted:
            column = F.try_to_timestamp(column.cast("string"))
        return column.alias(field.name)

    return df.select(*[cleaned(field) for field in df.schema.fields])


def with_clean_text(
    df: DataFrame, source: str = "text_content", target: str = "text_clean"
) -> DataFrame:
    """Add the cleaned lower-case text and its length."""
    return df.withColumn(target, lower_trim(clean_text(source))).withColumn(
        "text_length", F.length(target)
    )


def filter_min_length(df: DataFrame, column: str = "text_length", chars: int = MIN_CLEAN_CHARS):
    """Keep texts strictly longer than ``chars``."""
    return df.filter(F.col(column) > chars)


def clean_long_texts(
    df: DataFrame,
    source: str = "text_content",
    target: str = "text_clean",
    chars: int = MIN_CLEAN_CHARS,
) -> DataFrame:
    """``with_clean_text`` and ``filter_min_length`` in one step.

    A filter on the length would be moved below the cleaning with a copy of
    it, and each text cleaned twice. Exploding the list of the one text, empty
    if it is too short, cleans it once.
    """
    long_enough = F.filter(
        F.array(lower_trim(clean_text(source))), lambda t: F.length(t) > chars
    )
    kept = df.select("*", F.explode(long_enough).alias(target))
    return kept.withColumn("text_length", F.length(target))


def filter_not_null(df: DataFrame, *columns: str) -> DataFrame:
    """Keep rows where all the columns have a value; an empty string is a value."""
    return df.dropna(how="any", subset=list(columns))


def filter_summary_length(
    df: DataFrame, column: str = "summary", size: int = MIN_SUMMARY_BYTES
) -> DataFrame:
    """Keep summaries longer than ``size`` bytes (not characters)."""
    return df.filter(F.octet_length(column) > size)


def empty_text_rows(df: DataFrame, column: str = "text_content") -> DataFrame:
    return df.filter(F.col(column).isNull() | (F.length(column) == 0))


def lost_characters(df: DataFrame, raw: str, cleaned: str) -> DataFrame:
    """``character, texts``: every character that cleaning removes, and from how many texts.

    The number of rows is bounded by the alphabet; counts are combined before
    the shuffle.
    """
    lost = df.select(F.explode(removed_characters(raw, cleaned)).alias("character"))
    return lost.groupBy("character").agg(F.count(F.lit(1)).alias("texts"))
