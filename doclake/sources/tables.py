"""Parquet, CSV, catalog tables and literal rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def scan_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    multi_line: bool = False,
) -> DataFrame:
    """CSV with a header and doubled quotes as escapes.

    The ``schema`` saves a pass over the data. ``multi_line`` allows line breaks
    within quotes, at the price that one file is one task.
    """
    reader = spark.read.options(header=True, escape='"', multiLine=multi_line)
    return reader.schema(schema).csv(path)


def scan_catalog(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)


def from_rows(spark: SparkSession, rows: Iterable, schema: StructType | str) -> DataFrame:
    """A small literal table, such as a label list; not a way to load data."""
    return spark.createDataFrame(list(rows), schema)
